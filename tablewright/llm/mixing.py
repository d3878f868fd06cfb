"""Mix sources to target weights by capped water-filling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.llm.common import WORD, fresh, materialize, take

#: Weights of the sources in order of their names, repeating.
WEIGHTS = (5, 2, 1)
#: Runs of hash order by which a source is summed before one run is ordered row by row.
RUNS = 4096


def n_words(text: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def water_fill(
    sources: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = 1.5, max_epochs: float = 2.0
) -> DataFrame:
    """Targets of sources: ``share`` of all sizes by weight, at most ``max_epochs`` of each.

    ``sources`` has source and source_size, one row per source. Those that hit
    their ceiling are clamped, and the excess goes to the rest by weight until
    nobody is above. Sources fill up in the order of ceiling per weight, so the
    water level follows from running sums: it is the one of the first source
    that isn't full at the level left by those before it. Returns source,
    source_size, weight and target. The windows see one row per source.
    """
    # code points order as UTF-8 bytes do, which is how Spark compares strings
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    s = sources.select("source", "source_size", weight.alias("weight"))
    s = s.withColumn("ceiling", F.col("source_size") * F.lit(float(max_epochs)))
    s = s.withColumn("full_at", F.col("ceiling") / F.col("weight"))
    all_of_them = Window.partitionBy(F.lit(0))
    fuller = Window.orderBy("full_at", F.col("source").asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, -1
    )
    s = s.select(
        "*",
        (
            (F.sum("source_size").over(all_of_them) * F.lit(float(share)) - F.coalesce(F.sum("ceiling").over(fuller), F.lit(0.0)))
            / (F.sum("weight").over(all_of_them) - F.coalesce(F.sum("weight").over(fuller), F.lit(0.0)))
        ).alias("level_left"),
    )
    level = F.max(F.when(F.col("level_left") <= F.col("full_at"), F.col("level_left"))).over(all_of_them)
    return s.select(
        "source",
        "source_size",
        "weight",
        F.least("ceiling", F.coalesce(level, F.lit(float("inf"))) * F.col("weight")).alias("target"),
    )


def mix_sources(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share: float = 1.5,
    max_epochs: float = 2.0,
    seed: str = "mix",
) -> DataFrame:
    """How often each row enters the mix.

    A source that needs r epochs gives every row floor(r) times, and once more
    the rows that come first in a seeded order (md5 of seed and doc_id), as
    long as their running size, less half of the row, stays below the missing
    part. So a source misses its target by at most half of one row. The
    running sums go over per-run totals (4096 runs of hash order for each
    source); only the run in which the target ends is ordered row by row.

    Size is the number of words. Returns doc_id, source, size, source_size,
    target (double), epochs (int) and taken (epochs times size). Null texts
    and texts without words have size 0; null sources make one source, the
    last. Rows that repeat count each; those that repeat a doc_id in a source
    are neighbours in the order and may fall on both sides of its end. Null
    ids share one place in the order. No rows give no rows.
    """
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))).cast("binary"))
    rows = take(docs, "doc_id", "text", "source").select(
        F.col("doc_id"), F.col("source"), n_words("text").alias("size"), key.alias("hash")
    )
    rows = materialize(rows.withColumn("run", F.conv(F.substring("hash", 1, 3), 16, 10).cast("int")), "mix-sizes")

    runs = rows.groupBy("source", "run").agg(F.sum("size").alias("run_size"))
    sources = runs.groupBy("source").agg(F.sum("run_size").alias("source_size"))
    targets = water_fill(sources, weights, share, max_epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    targets = targets.withColumn("whole", whole.cast("int")).withColumn(
        "rest", F.col("target") - F.col("whole") * F.col("source_size")
    )
    # at most RUNS rows of each source
    before = Window.partitionBy("source").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("before", F.coalesce(F.sum("run_size").over(before), F.lit(0)))
    runs = runs.withColumnRenamed("source", "s").join(targets, F.col("s").eqNullSafe(F.col("source"))).select(
        F.col("s"), F.col("run").alias("r"), "source_size", "target", "whole",
        # what of the rest is left for this run, and whether it ends here
        (F.col("rest") - F.col("before")).alias("left"),
        ((F.col("rest") > F.col("before")) & (F.col("rest") < F.col("before") + F.col("run_size"))).alias("ends"),
    )
    rows = rows.join(runs, F.col("source").eqNullSafe(F.col("s")) & (F.col("run") == F.col("r")))
    out = ["doc_id", "source", "size", "source_size", F.col("target").cast("double"), "whole"]
    plain = rows.filter(~F.col("ends")).select(*out, F.when(F.col("left") > 0, 1).otherwise(0).alias("more"))
    order = Window.partitionBy("source", "run").orderBy("hash", "doc_id", "size")
    middle = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size") / 2
    last = rows.filter("ends").select(*out, F.when(middle < F.col("left"), 1).otherwise(0).alias("more"))
    return plain.unionByName(last).select(
        "doc_id", "source", "size", "source_size", "target",
        (F.col("whole") + F.col("more")).cast("int").alias("epochs"),
        (F.col("size") * (F.col("whole") + F.col("more"))).cast("long").alias("taken"),
    )


def repeat_rows(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as ``mix_sources`` takes it.

    Rows that repeat a doc_id in one source are taken together, as often as
    the one of them that is taken most.
    """
    epochs = mix_sources(docs, **options).groupBy("doc_id", "source").agg(F.max("epochs").alias("epochs"))
    epochs = epochs.filter("epochs > 0").toDF("mix_id", "mix_source", "mix_epochs")
    columns = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(columns))])
    at = {c: F.col(f"c{columns.index(c)}") for c in ("doc_id", "source")}
    joined = plain.join(
        epochs, at["doc_id"].eqNullSafe(F.col("mix_id")) & at["source"].eqNullSafe(F.col("mix_source"))
    )
    copy = fresh(docs, "copy")
    copies = joined.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col("mix_epochs"))))
    return copies.select(*plain.columns).toDF(*columns)
