"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerlight.llm.stage import stage


def _large_star(edges: DataFrame) -> DataFrame:
    """Every vertex links its larger neighbours to the smallest vertex among itself and its neighbours."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .filter("u <> v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Every vertex links itself and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    return (down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct())


def connected_components(edges: DataFrame) -> DataFrame:
    """(id, component) for every vertex of ``edges`` (u, v) that is not the smallest of its component.

    Each round is written to the shared folder, so a lost executor costs one round at
    most.  Rounds end when an alternation changes no edge.
    """
    current = stage(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                    .distinct(), "edges")
    mark = F.struct(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u")))
    before = current.agg(mark.alias("m")).first().m
    while before[0]:
        current = stage(_small_star(_large_star(current)), "edges")
        after = current.agg(mark.alias("m")).first().m
        if after == before:
            break
        before = after
    return current.select(F.col("u").alias("id"), F.col("v").alias("component"))
