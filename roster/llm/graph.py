"""Connected components of an edge table by alternating stars."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roster.session import freeze


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b); the root is the smallest node of its component.

    Every round hangs nodes on the smallest neighbour, first those above a node, then those below; rounds
    are written down. A node with many neighbours is a join of its edges with one row. That row comes from
    a table that is written down too: Spark can split the edges of such a node only if both sides of the
    join come straight from a shuffle or a scan.
    """
    links = edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links = freeze(links.distinct(), "links")
    before = None
    while (state := _state(links)) != before:
        before = state
        links = freeze(_lower(_upper(links)), "links")
    return links.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _upper(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = freeze(both.groupBy("a").agg(F.least("a", F.min("b")).alias("least")), "least")
    hung = both.join(least, "a").where(F.col("b") > F.col("a"))
    return hung.select(F.col("b").alias("a"), F.col("least").alias("b")).where(F.col("a") != F.col("b")).distinct()


def _lower(links: DataFrame) -> DataFrame:
    least = freeze(links.groupBy("a").agg(F.min("b").alias("least")), "least")
    hung = links.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).where(F.col("a") != F.col("b"))
    return hung.unionByName(least.withColumnRenamed("least", "b")).distinct()


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
