"""Row numbers, batches and rankings that no single task has to compute alone."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.functions.values import clean_value, quoted
from tablewright.operators.profile import column_types
from tablewright.session import materialize

_ROW_BITS = 33  # monotonically_increasing_id: partition number above, row number below


def with_row_number(
    df: DataFrame,
    order_by: Sequence[str | Column],
    partition_by: Sequence[str] = (),
    name: str = "rn",
) -> DataFrame:
    """Number rows from 1 in ``order_by`` order, within ``partition_by`` if given.

    A plain window would send each group, or without groups the whole table,
    through one task. Here a global sort spreads every group over many tasks,
    rows are numbered inside their task, and the group's count in earlier
    tasks is added. That offset table has at most one row per task plus one
    per group.
    """
    ordered = df.orderBy(*partition_by, *order_by).withColumn("__mid", F.monotonically_increasing_id())
    placed = materialize(
        ordered.withColumn("__task", F.shiftright("__mid", _ROW_BITS)), "ranked"
    )
    groups = [*partition_by]
    per_task = placed.groupBy(*[quoted(g) for g in groups], "__task").agg(
        F.min("__mid").alias("__task_first"), F.count(F.lit(1)).alias("__task_rows")
    )
    earlier = Window.partitionBy(*[quoted(g) for g in groups]).orderBy("__task").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = per_task.select(
        *[F.col(quoted(g)).alias(f"__g{i}") for i, g in enumerate(groups)],
        F.col("__task").alias("__t"),
        "__task_first",
        F.coalesce(F.sum("__task_rows").over(earlier), F.lit(0)).alias("__before"),
    )
    # one row per task and group: adaptive execution broadcasts it while it measures small,
    # which spares the numbered table a second shuffle
    match = F.col("__task") == F.col("__t")
    for i, g in enumerate(groups):
        match &= F.col(quoted(g)).eqNullSafe(F.col(f"__g{i}"))
    number = F.col("__before") + F.col("__mid") - F.col("__task_first") + 1
    return placed.join(offsets, match).select(
        *[quoted(c) for c in df.columns], number.alias(name)
    )


def plan_batches(
    ids: DataFrame,
    batch_size: int,
    batches_per_cycle: int,
    db: str = "db",
    order_by: Sequence[str] | None = None,
) -> DataFrame:
    """Number the IDs of each database into batches and batches into cycles, from 0.

    Without ``order_by`` the order of the input decides.
    """
    if order_by is None:
        ids = ids.withColumn("__position", F.monotonically_increasing_id())
    numbered = with_row_number(ids, order_by or ["__position"], [db], "__rn")
    batch = F.floor((F.col("__rn") - 1) / batch_size)
    return numbered.select(
        *[quoted(c) for c in ids.columns if c != "__position"],
        batch.alias("batch"),
        F.floor(batch / batches_per_cycle).alias("cycle"),
    )


def pending_ids(requested: DataFrame, landed: DataFrame, on: Sequence[str] = ("db", "id")) -> DataFrame:
    """Requested IDs that have not landed yet."""
    return requested.join(landed.select(*on).distinct(), list(on), "left_anti")


def preview(df: DataFrame, n: int = 5, order_by: Sequence[str] = ()) -> DataFrame:
    """The first ``n`` rows; give ``order_by`` for a stable answer."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)


def prioritize_studies(
    df: DataFrame,
    study: str,
    k: int | None = None,
    weights: Mapping[str, float] | None = None,
) -> DataFrame:
    """Rank studies by mean record completeness, then record count, then id.

    A record's completeness is the weighted share of its other columns that
    hold a value. The weights are decimals, so that sums are exact and ranks do
    not depend on the order of addition. Empty strings count as missing.
    """
    types = column_types(df)
    weights = weights or {name: 1 for name in df.columns if name != study}
    whole = sum(Decimal(str(w)) for w in weights.values())

    def weighed(name: str, weight: float) -> Column:
        filled = clean_value(name, types[name])
        if types[name].simpleString() == "string":
            filled = F.nullif(filled, F.lit(""))
        return F.when(filled.isNotNull(), F.lit(Decimal(str(weight))).cast("decimal(18,6)")).otherwise(
            F.lit(0).cast("decimal(18,6)")
        )

    total = sum((weighed(n, w) for n, w in list(weights.items())), F.lit(0).cast("decimal(18,6)"))
    scored = (
        df.where(F.col(quoted(study)).isNotNull())
        .groupBy(F.col(quoted(study)).alias("study"))
        .agg(F.sum(total.cast("decimal(24,6)")).alias("__sum"), F.count(F.lit(1)).alias("n_records"))
        .select(
            "study",
            "n_records",
            (F.col("__sum").cast("double") / (F.col("n_records") * F.lit(float(whole)))).alias("score"),
        )
    )
    order = [F.desc("score"), F.desc("n_records"), F.asc("study")]
    if k is None:
        return with_row_number(scored, order, name="rank").select("rank", "study", "n_records", "score")
    # the top k come from per-task heads; ranking them then touches k rows
    top = scored.orderBy(*order).limit(k)
    rank = F.row_number().over(Window.orderBy(*order))
    return top.select(rank.alias("rank"), "study", "n_records", "score")
