"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripguard.llm.common import discard, shuffles_removed, written


def _toward_least(edges: DataFrame, *, up: bool) -> DataFrame:
    """Each node links its larger (``up``) or smaller neighbours to the least node it sees; links may repeat."""
    both = edges.union(edges.select("v", "u"))
    least = both.groupBy(F.col("u").alias("n")).agg(F.min("v").alias("least"))
    least = least.select("n", F.least("n", "least").alias("m"))
    joined = both.join(least, F.col("u") == F.col("n"))
    if up:
        linked = joined.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        linked = joined.filter(F.col("v") < F.col("u")).select(
            F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e")
        ).select(F.col("e.v").alias("u"), F.col("e.m").alias("v"))
    return linked.filter(F.col("u") != F.col("v"))


def components(edges: DataFrame) -> DataFrame:
    """``(id, root)`` for every node of ``edges (u, v)``; root is the least id reachable.

    Large-star and small-star rounds (Kiveris et al., 2014): a round is joins
    and pre-aggregated minima, so a hub is no single task; the number of rounds
    grows with the logarithm of the longest path. Each round is a table, and
    that before it goes with its shuffles. Nulls and loops are ignored; an
    empty table gives an empty table. The result can be given to ``discard``.
    """
    kept = edges.toDF("u", "v").filter("u != v")
    now = written(kept.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    while not _stars(now):
        before = now
        now = written(_toward_least(_toward_least(before, up=True), up=False).distinct(), "edges")
        discard(before)
    roots = now.select(F.col("v").alias("id"), F.col("v").alias("root")).distinct()
    out = now.toDF("id", "root").union(roots)
    out.scratch_path = now.scratch_path
    return out


def _stars(edges: DataFrame) -> bool:
    """Whether each node is linked to one lesser node, which is linked to none: then all are linked to their root."""
    with shuffles_removed(edges.sparkSession):
        ends = edges.selectExpr("u as n", "1 as below", "0 as above").union(edges.selectExpr("v", "0", "1"))
        nodes = ends.groupBy("n").agg(F.sum("below").alias("below"), F.max("above").alias("above"))
        return not nodes.filter("below > 1 or below + above > 1").agg(F.count(F.lit(1))).first()[0]
