"""The registered queries: those with SQL against it, the others against their contracts."""

import json
import subprocess
import sys
import zlib

import pytest

import __spark_entry__ as entry
from roster.llm.oracles import ORACLES
from roster.llm.queries import QUERIES
from tests.compare import assert_same, duck
from tests.llm.conftest import SF

# The columns and types that the contracts name.
COLUMNS = {
    "op1_suffix_dedup": "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string",
    "op2_language_id": "doc_id long, held_out boolean, lang_pred string, score double",
    "op3_packing": "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long",
    "op4_jaccard_join": "doc_id long, n_shingles long, component_id long",
    "op7_sharding": "doc_id long, size long, text_crc32 long, law string, shard int, slot long, grown_shard int",
    "op8_quality_classifier": "doc_id long, held_out boolean, score double, predicted int",
    "op9_fingerprints": "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double",
    "op11_token_alignment": "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string",
    "op12_conversation_repair": "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string",
    "op13_minhash_dedup": "doc_id long, n_shingles long, component_id long, kept boolean",
}

# Rows at the smallest scale, where they are not the documents.
ROWS = {"op12_conversation_repair": 20}


@pytest.mark.parametrize("name", ORACLES)
def test_against_sql(spark, name):
    assert assert_same(QUERIES[name](spark, SF), duck(SF), ORACLES[name]) == ROWS.get(name, 200)


@pytest.mark.parametrize("name", COLUMNS)
def test_columns(spark, name):
    kinds = {"bigint": "long"}
    found = {column: kinds.get(kind, kind) for column, kind in QUERIES[name](spark, SF).dtypes}
    wanted = dict(column.split() for column in COLUMNS[name].split(", "))
    assert {column: found.get(column) for column in wanted} == wanted


def test_digests(spark, documents):
    texts = {r.doc_id: r.text or "" for r in documents.collect()}
    for r in QUERIES["op7_sharding"](spark, SF).collect():
        raw = texts[r.doc_id].encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(raw) + 8, zlib.crc32(raw), "bytes", None)
        assert 0 <= r.shard < 24
    for name, divisor, part in (("op2_language_id", 4, 2), ("op8_quality_classifier", 5, 0)):
        rows = QUERIES[name](spark, SF).collect()
        assert len(rows) == len(texts)
        assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % divisor == part) for r in rows)
    assert all(r.predicted == (r.score >= 0.3) for r in QUERIES["op8_quality_classifier"](spark, SF).collect())


def test_all_are_registered():
    assert set(QUERIES) <= set(entry.queries()) and "pipeline" in entry.queries()
    assert {f"op{n}" for n in range(1, 14)} == {name.split("_")[0] for name in QUERIES}
    assert set(ORACLES) <= set(entry.oracle_sql())


def test_workers_get_the_package(tmp_path):
    """A session started elsewhere, whose workers cannot import the package from a folder."""
    code = f"""
import sys, json
sys.path.insert(0, {json.dumps(sys.path[0])}); sys.path.insert(0, {json.dumps(entry.__file__.rpartition('/')[0])})
import __spark_entry__ as entry
from roster.session import local_session
print("ROWS", entry.queries()["op2_language_id"](local_session("2"), {json.dumps(SF)}).count())
"""
    import os

    bare = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    said = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=bare, capture_output=True, text=True, timeout=240)
    assert "ROWS 200" in said.stdout, said.stderr[-2000:]


def test_token_output_covers_resets_and_padding(spark):
    rows = QUERIES["op5_token_output"](spark, SF).collect()
    assert rows
    for r in rows:
        length = r.cu_seqlens[-1]
        assert list(r.position_resets) == [at for at in r.cu_seqlens if at < r.width] and length <= r.width
        assert r.padding_crc32 == zlib.crc32(bytes(2 * (r.width - length)))
    assert any(r.cu_seqlens[-1] < r.width for r in rows)
