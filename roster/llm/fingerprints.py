"""Document fingerprints: a Merkle tree over sentences, paragraphs and sections, in native functions only.

A paragraph is a line, cut into sentences before the white space behind ``.``, ``!`` or ``?``; nothing is
dropped by the cuts. A section is a run of paragraphs that ends behind a paragraph whose last hash ends in
0 or 1, so that sections are found by content and an edit moves no boundary far from it. Every level is
hashed from the hashes below it, up to the root.

A fingerprint is the root, ``:``, and the tree's leaves: sections parted by ``|``, paragraphs by ``/``,
sentences by ``.``. Roots test equality; ``likeness`` and ``differing_sections`` compare two trees.

Defined results: NULL is fingerprinted as the empty text, which has one empty sentence. In
``with_next`` a NULL id comes last, and rows with equal ids follow each other by the hash of their text.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET_BYTES = 32 << 20
MOST_BUCKETS = 8192
_SENTENCE_END = r"(?<=[.!?])(?=\s)"
_LOWEST = -(1 << 63)


def _tree(text: Column) -> Column:
    """All leaves with full hashes, in their sections and paragraphs."""
    leaves = F.transform(
        F.split(text, "\n"),
        lambda line: F.array_join(F.transform(F.split(line, _SENTENCE_END), lambda sentence: F.md5(sentence)), "."),
    )
    return F.regexp_replace(F.array_join(leaves, "/"), "([01])/", "$1|")


def _root(tree: Column) -> Column:
    paragraphs = lambda section: F.transform(F.split(section, "/"), lambda paragraph: F.sha2(paragraph, 256))
    sections = F.transform(F.split(tree, r"\|"), lambda section: F.sha2(F.array_join(paragraphs(section), "/"), 256))
    return F.sha2(F.array_join(sections, "|"), 256)


def with_fingerprints(rows: DataFrame, **columns: str) -> DataFrame:
    """``rows`` with the fingerprint of each text column: ``fingerprint="text"``."""
    trees = {f"_tree_{name}": _tree(F.coalesce(text, F.lit(""))) for name, text in columns.items()}
    prints = {
        name: F.concat(_root(F.col(f"_tree_{name}")), F.lit(":"), F.regexp_replace(f"_tree_{name}", "([0-9a-f]{16})[0-9a-f]{16}", "$1"))
        for name in columns
    }
    return rows.withColumns(trees).withColumns(prints).drop(*trees)


def _leaves(fingerprint: Column) -> Column:
    return F.array_distinct(F.split(F.substring_index(fingerprint, ":", -1), "[./|]"))


def likeness(first: Column, second: Column) -> Column:
    """Twice the sentences in both over the sentences in each, repeated ones once: 0 to 1."""
    a, b = _leaves(first), _leaves(second)
    return F.when(first == second, 1.0).otherwise(2.0 * F.size(F.array_intersect(a, b)) / (F.size(a) + F.size(b)))


def differing_sections(first: Column, second: Column) -> Column:
    """Numbers, from 0, of the sections of the first fingerprint that are not in the second."""
    theirs = F.split(F.substring_index(second, ":", -1), r"\|")
    ours = F.transform(F.split(F.substring_index(first, ":", -1), r"\|"), lambda s, i: F.struct(i.alias("i"), s.alias("s")))
    return F.transform(F.filter(ours, lambda x: ~F.array_contains(theirs, x.s)), lambda x: x.i)


def with_next(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``doc_id``, ``text`` and ``next_text``, the text of the document next in descending ``doc_id``; the first comes after the last.

    Rows go to ranges of ids between quantiles, one shuffle. A quantile is an id itself, so the document
    that follows a range is known beforehand and is put behind that range a second time.
    """
    rows = docs.select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce("doc_id", F.lit(_LOWEST)).alias("_id")
    )
    size = F.sum(F.octet_length("text").cast("long")).alias("size")
    buckets = min(MOST_BUCKETS, max(64, (rows.agg(size).first()["size"] or 0) // bucket_bytes))
    shares = [i / buckets for i in range(1, buckets + 1)]
    quantiles = rows.agg(F.percentile_approx("_id", shares, 100 * buckets).alias("q"), F.max("_id").alias("top")).first()
    splits = sorted(set(quantiles.q or []) - {quantiles.top})
    placed = _place(rows, splits)
    after = F.when(F.get(_longs(splits), F.col("_at").cast("int")) == F.col("_id"), F.array(F.col("_at") + 1)) if splits else None
    first = F.when(F.col("_id") == quantiles.top, F.array(F.lit(-1))) if quantiles.top is not None else None
    own = F.array("_at")
    none = F.array().cast("array<int>")
    also = [F.coalesce(extra, none) for extra in (after, first) if extra is not None]
    copies = placed.withColumn("_to", F.explode(F.concat(own, *also)))
    # -1 marks the first document, which stands behind range 0 as the one after the last.
    ordered = copies.withColumns({"_bucket": F.greatest("_to", F.lit(0)), "_copy": F.col("_to") != F.col("_at")})
    order = Window.partitionBy("_bucket").orderBy((F.col("_to") < 0).asc(), F.col("_id").desc(), F.xxhash64("text"))
    led = ordered.withColumn("next_text", F.lead("text").over(order))
    return led.where(~F.col("_copy")).select("doc_id", "text", "next_text")


def _longs(values: list[int]) -> Column:
    return F.array(*[F.lit(v).cast("long") for v in values])


def _place(rows: DataFrame, splits: list[int]) -> DataFrame:
    """``_at``: how many splits lie below the id, by binary search."""
    placed = rows.withColumn("_at", F.lit(0))
    for bit in reversed(range(len(splits).bit_length())):
        split = F.get(_longs(splits), F.col("_at") + F.lit((1 << bit) - 1))
        placed = placed.withColumn("_at", F.col("_at") + F.when(split < F.col("_id"), 1 << bit).otherwise(0))
    return placed
