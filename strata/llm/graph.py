"""Connected components of an edge table by alternating star contractions.

Each round replaces edges by edges to smaller nodes (large star, then small
star) with two group-bys and two joins; nothing is gathered per node, so a
hub is only a skewed join key. Rounds grow with the logarithm of a chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.session import scratch_path, shuffles_go


def saved(df: DataFrame, name: str) -> DataFrame:
    """The table written to the shared scratch folder and read again; its shuffle files go."""
    path = scratch_path(df.sparkSession, name)
    with shuffles_go(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return (both.join(least, "a").where("b > a and b > m")
            .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def _mark(edges: DataFrame) -> tuple:
    with shuffles_go(edges.sparkSession):
        return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")),
                               F.sum(F.xxhash64("b", "a").cast("decimal(20,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)``; root is the least node reached.

    Self edges and repeats are allowed; null ends are dropped."""
    current = saved(edges.where("a <> b").select(F.greatest("a", "b").alias("a"),
                                                 F.least("a", "b").alias("b")).distinct(), "edges")
    before = _mark(current)
    while before[0]:
        current = saved(_small_star(_large_star(current)), "edges")
        now = _mark(current)
        if now == before:
            break
        before = now
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def merged(groups: DataFrame, edges: DataFrame) -> DataFrame:
    """``(node, root)`` of ``groups`` after more ``edges(a, b)``, between any nodes.

    Only the roots that the edges touch (and nodes new in them) make up the graph whose
    components are looked for."""
    ends = edges
    for c in "ab":
        of = groups.select(F.col("node").alias(f"{c}_node"), F.col("root").alias(f"{c}_root"))
        ends = ends.join(of, F.col(c) == F.col(f"{c}_node"), "left").withColumn(f"{c}_top", F.coalesce(f"{c}_root", c))
    over = saved(components(ends.select(F.col("a_top").alias("a"), F.col("b_top").alias("b"))), "merged")
    known = groups.join(over.select(F.col("node").alias("old"), F.col("root").alias("top")), F.col("root") == F.col("old"), "left")
    new = over.join(groups.select("node"), "node", "left_anti")
    return saved(known.select("node", F.coalesce("top", "root").alias("root")).unionByName(new.select("node", "root")), "groups")


__all__ = ["components", "merged", "saved"]
