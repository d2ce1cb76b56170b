"""Connected components by alternating large-star and small-star rounds, with checkpoints between them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lawloom.llm.common import cut

ROUNDS = 60


def _large(links: DataFrame) -> DataFrame:
    """Every node's larger neighbours move to its least neighbour."""
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small(links: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours move to the least of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b")))


def _tidy(links: DataFrame) -> DataFrame:
    return links.where("a <> b").distinct()


def _mark(links: DataFrame) -> tuple:
    """Links, and a sum that changes when they do."""
    r = links.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
    return r["n"], r["s"]


def components(links: DataFrame) -> DataFrame:
    """node, root: every node of the links a, b and the least node of its component. Self-links are ignored."""
    now = cut(_tidy(links.select("a", "b")))
    was = _mark(now)
    for _ in range(ROUNDS):
        if not was[0]:
            break
        now = cut(_tidy(_small(_tidy(_large(now)))))
        mark = _mark(now)
        if mark == was:
            break
        was = mark
    else:
        raise RuntimeError(f"components did not settle in {ROUNDS} rounds")
    star = now.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root"))
    return star.union(star.select("root", "root").distinct()).toDF("node", "root")
