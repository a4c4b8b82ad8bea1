"""The registered queries of the training-data operators. Each takes (spark, sf_dir)."""

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roster.llm import chosen_path
from roster.llm.conversations import damaged, repair_conversations
from roster.llm.decontamination import find_leaks
from roster.llm.fingerprints import likeness, with_fingerprints, with_next
from roster.llm.jaccard_join import similar_documents
from roster.llm.language_id import fit_languages, identify
from roster.llm.oracles import ORACLES as ORACLES
from roster.llm.packing import pack_documents
from roster.llm.quality import fit_quality, score_quality
from roster.llm.sharding import shard_documents
from roster.llm.ship import send_package
from roster.llm.suffix_dedup import repeats_report
from roster.llm.token_alignment import Pair, align_documents
from roster.llm.token_output import read_sequences, write_tokens
from roster.llm.word_scoring import score_by_words
from roster.session import scratch_path

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
END = 2
PAIR = Pair(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, public_tokenizers.path("piece_bpe_32k.model"))
SHARDS = 24
QUALITY_THRESHOLD = 0.3


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    send_package(spark)
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _remainder(divisor: int) -> Column:
    """CRC-32 of the id as text, modulo ``divisor``; -1 for a NULL id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % divisor, F.lit(-1))


def op1_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return repeats_report(_table(spark, sf, "documents")).drop("spans")


def op2_language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents")
    model = fit_languages(docs, _remainder(4) != 2)
    return identify(docs, model).withColumn("held_out", _remainder(4) == 2)


def op3_packing(spark: SparkSession, sf: str) -> DataFrame:
    pieces = pack_documents(_table(spark, sf, "documents"), TOKENIZER, END)
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op4_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    return similar_documents(_table(spark, sf, "documents"), words=4, percent=85).drop("mark", "first")


def op5_token_output(spark: SparkSession, sf: str) -> DataFrame:
    """The files written, read back: one row per sequence with its documents."""
    path = scratch_path(spark, "tokens")
    write_tokens(_table(spark, sf, "documents"), path, TOKENIZER, END)
    sequences = read_sequences(spark, path)
    crcs = [F.crc32(name).alias(f"{name}_crc32") for name in ("ids", "padding")]
    return sequences.select("sequence_id", "doc_ids", "doc_starts", "cu_seqlens", "width", "position_resets", *crcs)


def op6_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    """Documents that hold a benchmark item, and the item; other documents have no row."""
    return find_leaks(_table(spark, sf, "documents"), _table(spark, sf, "benchmark"))


def op7_sharding(spark: SparkSession, sf: str) -> DataFrame:
    rows = shard_documents(_table(spark, sf, "documents"), SHARDS)
    crc = F.crc32(F.coalesce("text", F.lit("")))
    return rows.select(
        "doc_id",
        "size",
        crc.alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op8_quality_classifier(spark: SparkSession, sf: str) -> DataFrame:
    model = fit_quality(_table(spark, sf, "documents"), _table(spark, sf, "labels"), "quality", _remainder(5) != 0)
    scores = score_quality(_table(spark, sf, "documents"), model)
    return scores.withColumns({"held_out": _remainder(5) == 0, "predicted": (F.col("score") >= QUALITY_THRESHOLD).cast("int")})


def op9_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    rows = with_next(_table(spark, sf, "documents")).withColumn("n_chars", F.char_length("text").cast("long"))
    half = F.expr("cast(n_chars div 2 as int)")
    edited = F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - half), F.substring("next_text", F.lit(1), half))
    prints = with_fingerprints(
        rows.withColumn("edited", edited), fingerprint="text", edited_fingerprint="edited", next_fingerprint="next_text"
    )
    return prints.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )


def op10_lm_scoring(spark: SparkSession, sf: str) -> DataFrame:
    """The target is what is labelled as good and not toxic, the background is every document."""
    docs = _table(spark, sf, "documents")
    targets = _table(spark, sf, "labels").where((F.col("quality") == 1) & (F.col("toxic") == 0))
    return score_by_words(docs, targets)


def op11_token_alignment(spark: SparkSession, sf: str) -> DataFrame:
    """The first tokenizer is read from its file of ranks, which gives the ids of the contract's file."""
    return align_documents(_table(spark, sf, "documents"), PAIR)


def op12_conversation_repair(spark: SparkSession, sf: str) -> DataFrame:
    return repair_conversations(damaged(_table(spark, sf, "conversations")))


def op13_minhash_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return chosen_path.near_duplicates(_table(spark, sf, "documents"), words=2, percent=80).drop("mark")


QUERIES = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_language_id": op2_language_id,
    "op3_packing": op3_packing,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_token_output": op5_token_output,
    "op6_decontamination": op6_decontamination,
    "op7_sharding": op7_sharding,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_fingerprints": op9_fingerprints,
    "op10_lm_scoring": op10_lm_scoring,
    "op11_token_alignment": op11_token_alignment,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_minhash_dedup": op13_minhash_dedup,
}


