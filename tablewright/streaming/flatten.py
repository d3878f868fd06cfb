"""Flattening a dump folder while it fills."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructField, StructType

from tablewright.functions.values import quoted
from tablewright.operators.cleaning import standardize_text
from tablewright.operators.schema_ops import split_xml_columns
from tablewright.operators.xml_ops import first_value, flatten_xml_columns, fragment_pairs, repaired_rows, repaired_value
from tablewright.session import materialize, spread
from tablewright.sources.readers import CSV_OPTIONS
from tablewright.sources.staging import add_files, hidden_folder, read_note, write_note


def stream_flatten(
    spark: SparkSession,
    folder: str,
    schema: StructType | str,
    out: str,
    checkpoint: str,
    keys: Sequence[str] | None = None,
    id: str = "id",
    suffix: str = ".tsv",
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Append each new record of the folder to ``out`` once, flattened and standardised.

    Files are read as ``read_csv_with_xml`` reads them, and malformed fragments
    are repaired; of a micro-batch only those reach Python. With ``keys`` the
    output has these XML keys. Without, each micro-batch finds its own:
    all keys so far are kept beside the checkpoint, later batches have all their columns,
    and ``read_flattened`` reads earlier rows with nulls in columns that came later.

    A record whose ``id`` has landed before is skipped, also after a restart.
    What has landed is what ``out`` holds: each micro-batch meets it in an
    anti join on the id column alone, dealt out by hash, so nothing is held in
    memory from one batch to the next, however long the stream lives. Of
    records with one id in a micro-batch any one stays; null counts as an id.

    A micro-batch is written to a hidden folder first and then moved into
    ``out`` under its number. If it fails and is run again, it takes away what it
    had moved before and does not count that as landed, so every record comes once.
    """
    stream = (
        spark.readStream.schema(schema)
        .options(**CSV_OPTIONS)
        .option("multiLine", True)
        .option("pathGlobFilter", f"*{suffix}")
    )
    if files_per_batch is not None:
        stream = stream.option("maxFilesPerTrigger", files_per_batch)

    def land(batch: DataFrame, number: int) -> None:
        own = f"batch-{number:09d}-"
        batch = materialize(spread(batch), "stream-batch")
        if keys is None:
            flat = flatten_xml_columns(batch)
        else:
            flat = flatten_known(batch, keys, by_row=False)
        flat = standardize_text(flat, in_place=True)
        flat = _with_all_columns(batch.sparkSession, flat, checkpoint, grow=keys is None)
        fresh = flat.dropDuplicates([id])
        landed = landed_ids(batch.sparkSession, out, fresh.schema[id], own)
        if landed is not None:
            fresh = not_landed(fresh, landed, id)
        staged = hidden_folder(out, own)
        fresh.write.mode("overwrite").parquet(staged)
        add_files(batch.sparkSession, staged, out, own)

    query = (
        stream.csv(folder)
        .writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    return query.start()


def landed_ids(spark: SparkSession, out: str, id: StructField, but: str) -> DataFrame | None:
    """``__landed``: the ids in ``out``, without those of the batch that is being written; None before the first."""
    try:
        files = spark.read.schema(StructType([id])).parquet(out)
    except Exception as e:
        if "PATH_NOT_FOUND" in str(e):
            return None
        raise
    other = ~F.startswith(F.col("_metadata.file_name"), F.lit(but))
    return files.where(other).select(F.col(quoted(id.name)).alias("__landed"))


def not_landed(fresh: DataFrame, landed: DataFrame, id: str) -> DataFrame:
    """The rows of ``fresh`` whose id is not among ``landed``."""
    # the ids' compressed files look small enough to be sent through the driver to every task, so the way is given
    return fresh.join(landed.hint("merge"), F.col(quoted(id)).eqNullSafe(F.col("__landed")), "left_anti")


def _notes(checkpoint: str) -> str:
    return f"{checkpoint.rstrip('/')}/columns.json"


def known_columns(spark: SparkSession, checkpoint: str) -> StructType:
    """All columns of the output so far, in order of their appearance."""
    note = read_note(spark, _notes(checkpoint))
    return StructType.fromJson(json.loads(note)) if note else StructType([])


def _with_all_columns(spark: SparkSession, df: DataFrame, checkpoint: str, grow: bool) -> DataFrame:
    """``df`` with the columns of all batches so far, and its own new ones noted for those to come."""
    if not grow:
        return df
    known = known_columns(spark, checkpoint)
    place = {f.name.lower(): f for f in known}
    new = [f for f in df.schema if f.name.lower() not in place]
    if new:
        known = StructType([*known, *[StructField(f.name, f.dataType) for f in new]])
        write_note(spark, _notes(checkpoint), known.json())
    own = {c.lower(): c for c in df.columns}
    cells = [
        (F.col(quoted(own[f.name.lower()])) if f.name.lower() in own else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in known
    ]
    return df.select(*cells)


def read_flattened(spark: SparkSession, out: str, checkpoint: str) -> DataFrame:
    """What a stream without given keys has written: rows have nulls in columns found after them."""
    return spark.read.schema(known_columns(spark, checkpoint)).parquet(out)


def flatten_known(df: DataFrame, keys: Sequence[str], suffix: str = "Xml", by_row: bool = True) -> DataFrame:
    """Plain columns plus one column per given XML key, taken from any XML column.

    ``by_row`` repairs malformed fragments in place, as a stream must; else
    rows that have any are split off, and only they reach Python.
    """
    plain, xml = split_xml_columns(df, suffix)
    if not by_row:
        df = repaired_rows(df, xml)
    read = repaired_value if by_row else lambda fragment: fragment
    # parsed in a projection of their own, once for all keys
    parsed = df.select(
        *[quoted(name) for name in plain],
        *[fragment_pairs(read(F.col(quoted(c)))).alias(f"__p{i}") for i, c in enumerate(xml)],
    )
    cells = [F.col(quoted(name)) for name in plain if name not in keys]
    for key in keys:
        layers = [first_value(F.col(f"__p{i}"), key) for i in reversed(range(len(xml)))]
        if key in plain:
            layers.append(F.col(quoted(key)).cast("string"))
        cells.append(F.coalesce(*layers).alias(key))
    return parsed.select(*cells)
