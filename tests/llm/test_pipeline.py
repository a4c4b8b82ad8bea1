"""The pipeline: stages in order, each against a brute-force version on what it is given."""

import numpy as np
import pytest

import corpus_pipeline
from roster.llm.queries import END, TOKENIZER
from tests.llm.conftest import SF
from tests.llm.test_decontamination import plain_search
from tests.llm.test_jaccard_join import expected as expected_groups
from tests.llm.test_suffix_dedup import LENGTH


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Every stage's rows, written and read again."""
    top, docs = tmp_path_factory.mktemp("stages"), spark.read.parquet(f"{SF}/documents.parquet")
    kept = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(str(top / name))
        docs = kept[name] = spark.read.parquet(str(top / name))
    return kept


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages_and_columns(stages):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "repeated_strings", "benchmark_leaks", "packing"]
    columns = stages["documents"].dtypes
    assert all(stages[name].dtypes == columns for name in list(stages)[:-1])


def test_quality_drops_what_is_labelled_bad_and_little_else(spark, stages):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    before, after = texts(stages["documents"]), texts(stages["quality"])
    assert all(after[i] == before[i] for i in after)
    good, bad = ([i for i in before if labels.get(i) == q] for q in (1, 0))
    assert sum(i in after for i in good) >= 0.97 * len(good) and sum(i in after for i in bad) <= 0.1 * len(bad)


def test_one_of_each_group_stays(stages):
    before, after = texts(stages["quality"]), texts(stages["near_duplicates"])
    groups = expected_groups(list(before.items()), 5, 80)
    assert set(after) == {c for _, _, c in groups} and all(after[i] == before[i] for i in after)


def without_repeats(rows):
    seen, cut = set(), {}
    for i, text in sorted(rows.items()):
        raw = text.encode()
        gone = np.zeros(len(raw) + 1, bool)
        for at in range(len(raw) - LENGTH + 1):
            window = raw[at : at + LENGTH]
            if window in seen:
                gone[at : at + LENGTH] = True
            seen.add(window)
        # A letter goes when all its bytes go.
        at, letters = 0, []
        for letter in text:
            size = len(letter.encode())
            if not gone[at : at + size].all():
                letters.append(letter)
            at += size
        cut[i] = "".join(letters)
    return cut


def test_repeated_strings_are_cut(stages):
    rows = stages["repeated_strings"].collect()
    assert {r.doc_id: r.text for r in rows} == without_repeats(texts(stages["near_duplicates"]))
    assert all(r.n_chars == len(r.text) for r in rows)


def test_documents_with_benchmark_items_go(spark, stages):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    before, after = texts(stages["repeated_strings"]), texts(stages["benchmark_leaks"])
    found = {i for i, _ in plain_search(before.items(), items)}
    assert found and set(after) == set(before) - found and all(after[i] == before[i] for i in after)


def test_everything_kept_is_packed(stages):
    from tokenizers import Tokenizer

    plain, pieces = Tokenizer.from_file(TOKENIZER), {}
    for r in stages["packing"].orderBy("doc_id", "start").collect():
        pieces.setdefault(r.doc_id, []).extend(np.frombuffer(bytes(r.ids), "<u4").tolist())
    want = {i: plain.encode(t, add_special_tokens=False).ids + [END] for i, t in texts(stages["benchmark_leaks"]).items()}
    assert pieces == want


def test_run_gives_the_rows_of_the_last_stage(spark, stages):
    def content(df):
        return sorted((r.doc_id, r.start, r.length, bytes(r.ids)) for r in df.collect())

    got, want = content(corpus_pipeline.run(spark, SF)), content(stages["packing"])
    assert {r[0] for r in got} == {r[0] for r in want} and sum(r[2] for r in got) == sum(r[2] for r in want)
