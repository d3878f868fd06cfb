"""The composed jobs a user runs from files to files."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from tablewright.operators.cleaning import (
    drop_identical_columns,
    drop_similar_columns,
    drop_sparse_columns,
    standardize_text,
)
from tablewright.operators.joins import merge_and_reclean, merge_many
from tablewright.operators.profile import column_counts
from tablewright.operators.ranking import preview
from tablewright.operators.relations import Relations, Star, find_relations, star_schema
from tablewright.operators.schema_ops import drop_columns
from tablewright.operators.xml_ops import flatten_xml_columns
from tablewright.session import materialize, spread
from tablewright.sources.readers import read_folder_union, read_typed_csv
from tablewright.sources.writers import write_csv, write_tsv, write_with_column_mapping


class Cleaned(NamedTuple):
    """What cleaning one table yields."""

    star: Star
    relations: Relations
    sparse: list[str]
    identical: list[str]


class Merged(NamedTuple):
    """The joined table, and what is left of it after recleaning."""

    table: DataFrame
    star: Star


def _write_star(star: Star, path: str, removed: Sequence[str] = ()) -> None:
    removed = [*removed, *[c for c in star.columns if c not in star.fact.columns]]
    write_with_column_mapping(star.fact, f"{path}/fact", removed=removed)
    for keeper, lookup in star.lookups.items():
        lookup.write.parquet(f"{path}/lookup_{star.columns.index(keeper)}")


def clean_table(
    df: DataFrame,
    path: str | None = None,
    threshold: float = 0.95,
    in_place: bool = False,
    stage: bool = False,
) -> Cleaned:
    """Drop sparse and identical columns, find keys and relations, split off lookups.

    Columns are compared in standardised form; the table itself keeps its text
    unless ``in_place``. With ``path`` the fact table, its column mapping and
    the lookups are written there.

    The input is scanned a handful of times. ``stage`` writes it out once
    first, which pays for text files and joins; scans of columnar files are
    cheaper as they are.
    """
    if stage:
        df = materialize(df, "input")
    # standardising changes no value to or from null, so one count serves all steps
    counts = column_counts(df)
    slim, sparse = drop_sparse_columns(df, threshold, "floor", counts=counts)
    shadow = standardize_text(slim, in_place=True)
    (shadow, slim), identical = drop_identical_columns(shadow, slim, counts=counts)
    relations = find_relations(shadow, counts)
    star = star_schema(shadow if in_place else slim, relations, confirm=not in_place)
    if path is not None:
        _write_star(star, path, [c for c in df.columns if c not in star.columns])
    return Cleaned(star, relations, sparse, identical)


def merge_tables(
    spark: SparkSession, paths: Sequence[str], out: str | None = None, sep: str = "\t", **options
) -> Merged:
    """Read delimited tables, join them on the keys found, and clean the result again.

    Each text is parsed once and staged as a columnar table, which the search
    for keys then reads column by column.
    """
    tables = [materialize(read_typed_csv(spark, path, sep), "parsed") for path in paths]
    merged = merge_many(tables, **options)
    merged = materialize(merged, "merged")
    star = merge_and_reclean([merged])
    if out is not None:
        write_csv(merged, f"{out}/merged")
        _write_star(star, out)
    return Merged(merged, star)


def flatten_folder(
    spark: SparkSession,
    folder: str,
    out: str | None = None,
    suffix: str = ".tsv",
    drop: Sequence[str] = ("Item",),
    partitions: int | None = None,
) -> DataFrame:
    """Read a dump folder with differing headers, flatten its XML columns, write one table.

    ``drop`` names plain columns of the dump; what the XML holds is never dropped.
    """
    # the files are read once, and with ``out`` the fragments are flattened once
    dump = materialize(spread(drop_columns(read_folder_union(spark, folder, suffix), drop)), "dump")
    table = flatten_xml_columns(dump, partitions=partitions)
    if out is not None:
        table = materialize(table, "flat")
        write_tsv(table, out)
    return table


def aggregate_and_process(
    dfs: Sequence[DataFrame], path: str | None = None, threshold: float = 0.95, **options
) -> Cleaned:
    """Merge first, clean second."""
    merged = materialize(merge_many(dfs, **options), "merged")
    return clean_table(merged, path, threshold)


class Slim(NamedTuple):
    table: DataFrame
    sparse: list[str]
    similar: list[str]
    sample: DataFrame


def slim_table(
    df: DataFrame, path: str | None = None, threshold: float = 0.95, similarity: float = 0.9
) -> Slim:
    """Drop sparse columns, then columns nearly equal to an earlier one."""
    counts = column_counts(df)
    dense, sparse = drop_sparse_columns(df, threshold, "floor", counts=counts)
    table, similar = drop_similar_columns(dense, similarity, counts)
    if path is not None:
        write_tsv(table, path)
    return Slim(table, sparse, similar, preview(table))
