"""Contiguous shards of nearly equal bytes, from prefix sums over per-partition totals."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablewright.llm.common import materialize, take

#: Bytes that a row counts beside its text.
ROW_BYTES = 16


def shard_by_bytes(docs: DataFrame, shards: int = 40, order_parts: int | None = None) -> DataFrame:
    """Deal all rows to ``shards`` contiguous runs of nearly equal bytes.

    Rows stand in one global order: by the CRC-32 of their text, then doc_id,
    so that equal texts are neighbours. Each range partition of that order
    reports one total, the prefix sums of these totals place every partition
    on the axis of bytes, and the axis is cut into equal lengths; a row goes to
    the length in which its middle lies. Hence a shard misses the mean by less
    than the largest row. A text that fills a third of all rows is cut like any
    other run, since doc_id is part of the order.

    Returns doc_id, size (UTF-8 bytes of the text, null: none, plus 16),
    text_crc32 (of the empty text for null), law ``bytes``, shard, slot
    (gapless from 0 in each shard, in the global order) and grown_shard (null:
    the law is not ``key``). Repeated rows each keep their place; a null doc_id
    sorts first. An empty table gives no rows; with fewer rows than shards some
    shards stay empty.
    """
    text = F.coalesce("text", F.lit(""))
    rows = take(docs, "doc_id", "text").select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + F.lit(ROW_BYTES)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    by = ("text_crc32", "doc_id", "size")
    ranged = rows.repartitionByRange(order_parts, *by) if order_parts else rows.repartitionByRange(*by)
    # The part of a row must not change when a task runs again: write it down.
    rows = materialize(ranged.withColumn("part", F.spark_partition_id()), "shard-order")

    # one row per part: a window over all of them is small
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(0))
    parts = rows.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    parts = parts.select(
        "part",
        F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"),
        F.sum("bytes").over(everything).alias("all_bytes"),
    )
    inside = Window.partitionBy("part").orderBy(*by)
    end = F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    placed = rows.select("*", end.alias("end"), F.row_number().over(inside).alias("place"))
    placed = placed.join(parts, "part").select(
        "doc_id",
        "size",
        "text_crc32",
        # the middle of the row, in half bytes, so that all numbers stay whole
        F.expr(
            f"cast(((bytes_before + end) * 2 - size) * {int(shards)} div (all_bytes * 2) as int)"
        ).alias("shard"),
        (F.col("rows_before") + F.col("place") - 1).alias("position"),
    )
    first = placed.groupBy("shard").agg(F.min("position").alias("first"))
    return placed.join(first, "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("position") - F.col("first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
