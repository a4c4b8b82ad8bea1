"""A training-data pipeline over ``documents``: STAGES in order, each on what the one before it kept.

Every stage but the last returns the columns of ``documents``. Rows go when the quality classifier rejects
them, when they are not the first of a group of similar documents, or when they hold a benchmark item; what
repeats elsewhere is cut from the texts, and ``n_chars`` follows.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roster.llm import decontamination, jaccard_join, packing, suffix_dedup
from roster.llm.quality import fit_quality, keep_quality
from roster.llm.queries import END, QUALITY_THRESHOLD, TOKENIZER
from roster.llm.ship import send_package
from roster.session import scratch_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    send_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on labelled ones, does not reject."""
    model = fit_quality(docs, _table(spark, sf_dir, "labels"), "quality", F.lit(True))
    return keep_quality(docs, model, QUALITY_THRESHOLD)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group that shares 80 per cent of its shingles of five words."""
    send_package(spark)
    return jaccard_join.keep_first(docs)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings of 100 bytes that an earlier text, or an earlier place, has."""
    send_package(spark)
    cut = suffix_dedup.drop_repeats(docs)
    return cut.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a question of the benchmark, in its own or other words for its values."""
    return decontamination.drop_leaks(docs, _table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in windows of 4096 tokens, with their ids."""
    send_package(spark)
    return packing.pack_documents(docs, TOKENIZER, END)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_strings", repeated_strings),
    ("benchmark_leaks", benchmark_leaks),
    ("packing", packed),
]

ORACLE_SQL = None  # a classifier is fitted and texts are tokenised; tests hold the stages against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; what each stage keeps is written to the shared folder and read again."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
