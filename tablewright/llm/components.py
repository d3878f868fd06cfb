"""Connected components of links, by joins and grouping alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import materialize_few


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """node and component (its smallest reachable node) for every node of ``links`` (a, b).

    Each round every node hooks all its neighbours onto the smallest node it
    sees, and drops what that makes redundant; the links turn into stars in
    about log(n) rounds. Minima are taken before the shuffle. The links of a node
    meet its minimum in an inner join, whose large partitions adaptive execution
    splits; below its threshold (256 MB by default) those of one node are read by one task. Every round is written down, which cuts lineage. Links of a node
    to itself and repeated links are harmless; no links give no rows.
    """
    edges = materialize_few(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct(),
        "links",
    )
    for _ in range(max_rounds):
        # large star: the larger neighbours of a node go to the smallest of its neighbours and itself
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(
            F.col("u").alias("x"), F.least("u", "m").alias("m")
        )
        large = (
            both.filter("v > u")
            .join(low, F.col("u") == F.col("x"))
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        large = materialize_few(large, "large-star")
        # small star: a node and its smaller neighbours go to the smallest of these
        low = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "x")
        joined = large.join(low, F.col("u") == F.col("x"))
        small = (
            joined.select(F.explode(F.array("u", "v")).alias("u"), "m")
            .select("u", F.col("m").alias("v"))
            .filter("u != v")
            .distinct()
        )
        small = materialize_few(small, "small-star")
        changed = (
            small.select("u", "v", F.lit(1).alias("side"))
            .unionByName(edges.select("u", "v", F.lit(-1).alias("side")))
            .groupBy("u", "v")
            .agg(F.sum("side").alias("side"))
            .filter("side != 0")
        )
        done = changed.isEmpty()
        edges = small
        if done:
            break
    else:
        raise RuntimeError("links did not settle")
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )
