"""Dropping sparse and repeated columns, normalising text and nulls."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.functions.text import lower_strip
from tablewright.functions.values import STRING, family_of, quoted
from tablewright.operators.profile import (
    ColumnCounts,
    column_counts,
    identical_classes,
    similar_pairs,
)

# The texts read as missing by the tabular reader whose results
# are to be matched.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
)


class Slimmed(NamedTuple):
    """A table and the names of the columns it lost."""

    table: DataFrame
    removed: list[str]


def keep_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.select(*[quoted(name) for name in names])


def without_columns(df: DataFrame, removed: Sequence[str]) -> Slimmed:
    gone = set(removed)
    kept = [name for name in df.columns if name not in gone]
    return Slimmed(keep_columns(df, kept), [name for name in df.columns if name in gone])


def _map_strings(df: DataFrame, change) -> DataFrame:
    """Apply ``change(column)`` to every string column, in place and in order."""
    cells: list[Column] = []
    for field in df.schema.fields:
        value = F.col(quoted(field.name))
        if family_of(field.dataType) == STRING:
            value = change(value).alias(field.name)
        cells.append(value)
    return df.select(*cells)


def sparse_columns(
    counts: ColumnCounts,
    threshold: float = 0.95,
    mode: str = "floor",
    threshold_percentage: float = 5,
) -> list[str]:
    """Names of the columns with too few values, see ``drop_sparse_columns``."""
    rows = counts.rows
    if mode == "fraction":
        least = (1 - Decimal(str(threshold))) * rows
    elif mode == "floor":
        least = int((1 - threshold) * rows)
    elif mode == "percent":
        least = Decimal(str(threshold_percentage)) * rows / 100
    else:
        raise ValueError(f"unknown mode {mode!r}")
    present = counts.filled if mode == "percent" else counts.non_null
    return [name for name, n in present.items() if rows and n < least]


def drop_sparse_columns(
    df: DataFrame,
    threshold: float = 0.95,
    mode: str = "floor",
    threshold_percentage: float = 5,
    counts: ColumnCounts | None = None,
) -> Slimmed:
    """Drop columns with too few values. An empty table is left as it is.

    ``fraction``: keep if non-null >= (1 - threshold) * rows, in exact decimals.
    ``floor``: keep if non-null >= int((1 - threshold) * rows), in floats.
    ``percent``: empty strings become null; drop if the filled share is
    strictly below ``threshold_percentage``.
    """
    sparse = sparse_columns(counts or column_counts(df), threshold, mode, threshold_percentage)
    return without_columns(empty_to_null(df) if mode == "percent" else df, sparse)


def empty_to_null(df: DataFrame) -> DataFrame:
    return _map_strings(df, lambda value: F.nullif(value, F.lit("")))


def normalize_na(df: DataFrame, tokens: Sequence[str] = NA_TOKENS) -> DataFrame:
    """Cells that hold exactly one of ``tokens`` become null."""
    return _map_strings(df, lambda value: F.when(~value.isin(*tokens), value))


def drop_all_null_columns(df: DataFrame) -> Slimmed:
    counts = column_counts(df)
    return without_columns(
        df, [name for name in df.columns if counts.rows and counts.non_null[name] == 0]
    )


def drop_all_null_rows(df: DataFrame) -> DataFrame:
    return df.dropna(how="all")


def standardize_text(df: DataFrame, in_place: bool = False) -> DataFrame:
    """Lower-case and strip every string column.

    By default the table is kept and standardised copies are added with the
    suffix ``_std`` for comparing; ``in_place`` replaces the columns.
    """
    if in_place:
        return _map_strings(df, lower_strip)
    copies = [
        lower_strip(F.col(quoted(f.name))).alias(f"{f.name}_std")
        for f in df.schema.fields
        if family_of(f.dataType) == STRING
    ]
    return df.select("*", *copies)


def drop_incomplete_and_duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows without any null, each once; copies combine before the shuffle."""
    return df.dropna(how="any").dropDuplicates()


def drop_identical_columns(
    df: DataFrame,
    *others: DataFrame,
    null_safe: bool = False,
    counts: ColumnCounts | None = None,
) -> tuple[list[DataFrame], list[str]]:
    """Keep the first of each group of identical columns, in every given table."""
    extra = {name for group in identical_classes(df, null_safe, counts) for name in group[1:]}
    removed = [name for name in df.columns if name in extra]
    return [without_columns(table, removed).table for table in (df, *others)], removed


def drop_similar_columns(
    df: DataFrame, threshold: float = 0.9, counts: ColumnCounts | None = None
) -> Slimmed:
    """Drop the later column of every pair equal in more than ``threshold`` of the rows.

    Similarity is not transitive: a column similar only to one that is itself
    dropped still goes.
    """
    return without_columns(df, [later for _, later, _ in similar_pairs(df, threshold, counts)])
