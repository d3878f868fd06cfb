"""Writers for delimited text, ID lists and cycle dumps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tablewright.operators.ranking import pending_ids, plan_batches
from tablewright.operators.schema_ops import column_mapping, short_names
from tablewright.sources.staging import add_folders, hidden_folder

# Doubled quotes inside quoted cells; edge spaces are part of the value.
_CSV = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def write_tsv(df: DataFrame, path: str, mode: str = "error") -> None:
    df.write.options(**_CSV).mode(mode).csv(path, sep="\t")


def write_csv(df: DataFrame, path: str, mode: str = "error") -> None:
    df.write.options(**_CSV).mode(mode).csv(path)


def write_with_column_mapping(
    df: DataFrame,
    path: str,
    threshold: float = 0.20,
    format: str = "parquet",
    removed: Sequence[str] = (),
) -> DataFrame:
    """Write the table under shortened names and, beside it, old and new names.

    Columns that are gone stand in the mapping without a new name.
    """
    if format not in ("parquet", "tsv"):
        raise ValueError(f"unknown format {format!r}")
    names = short_names(df.columns, threshold)
    renamed = df.toDF(*names)
    mapping = column_mapping(df.sparkSession, df.columns, names, removed).select("original", "renamed")
    for table, name in ((renamed, "MetaData"), (mapping, "ColumnMapping")):
        if format == "parquet":
            table.write.parquet(f"{path}/{name}")
        else:
            write_tsv(table, f"{path}/{name}")
    return renamed


def write_id_list(ids: DataFrame, path: str, landed: DataFrame | None = None) -> None:
    """JSON lines per database; databases that already have a list are left alone.

    Lists are written to a hidden folder, and each database's folder is then
    moved into place in one step: what is there is complete. A run that was
    stopped can be run again, and writes the lists that are missing, so every id comes once.
    """
    if landed is not None:
        ids = pending_ids(ids, landed, ["db"])
    staged = hidden_folder(path, "ids")
    ids.write.mode("overwrite").partitionBy("db").json(staged)
    add_folders(ids.sparkSession, staged, path)


def write_cycle_dumps(
    ids: DataFrame,
    path: str,
    batch_size: int,
    batches_per_cycle: int,
    order_by: list[str] | None = None,
    db: str = "db",
) -> None:
    """One folder per fetch cycle.

    Rows move by (cycle, batch), so that a cycle, however large, is written by
    as many tasks as it has batches. Cycles are staged and moved as ``write_id_list`` does it: those of
    an earlier run stay as they are.
    """
    planned = plan_batches(ids, batch_size, batches_per_cycle, db, order_by)
    staged = hidden_folder(path, "cycles")
    planned.repartition(db, "cycle", "batch").write.mode("overwrite").partitionBy("cycle").options(**_CSV).csv(staged)
    add_folders(ids.sparkSession, staged, path)
