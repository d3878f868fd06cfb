"""Column profiles: completeness, distinct counts, keys, pairwise equality."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions.text import percentage
from tablewright.functions.values import (
    KEY,
    NESTED,
    STRING,
    clean_value,
    comparable,
    family_of,
    has_key,
    quoted,
    value_hash,
    value_key,
)

PAIRS_PER_PASS = 500
HISTOGRAM_BUCKETS = 256


class ColumnCounts(NamedTuple):
    """Row count, and per column how many cells are non-null and non-empty."""

    rows: int
    non_null: dict[str, int]
    filled: dict[str, int]


def column_types(df: DataFrame) -> dict[str, T.DataType]:
    return {field.name: field.dataType for field in df.schema.fields}


def stack_rows(rows: Sequence[Sequence[Column]], names: Sequence[str]) -> Column:
    """Turn one wide row into ``len(rows)`` narrow ones inside the same task."""
    cells = [cell for row in rows for cell in row]
    return F.stack(F.lit(len(rows)), *cells).alias(*names)


def _count_row(df: DataFrame) -> DataFrame:
    """One row: ``n``, and per column i ``c<i>`` non-null and ``f<i>`` non-empty cells."""
    counts = [F.count(F.lit(1)).alias("n")]
    for i, (name, dtype) in enumerate(column_types(df).items()):
        value = clean_value(name, dtype)
        filled = F.nullif(value, F.lit("")) if family_of(dtype) == STRING else value
        counts += [F.count(value).alias(f"c{i}"), F.count(filled).alias(f"f{i}")]
    return df.agg(*counts)


def column_counts(df: DataFrame) -> ColumnCounts:
    """One scan, one row back: what every sparse-column decision needs."""
    row = _count_row(df).first()
    return ColumnCounts(
        row["n"],
        {name: row[f"c{i}"] for i, name in enumerate(df.columns)},
        {name: row[f"f{i}"] for i, name in enumerate(df.columns)},
    )


def completeness_profile(df: DataFrame) -> DataFrame:
    """Per column: valid, empty and null cells, as counts and percentages."""
    cells = [
        (
            F.lit(name),
            F.col("n"),
            F.col(f"f{i}"),
            F.col(f"c{i}") - F.col(f"f{i}"),
            F.col("n") - F.col(f"c{i}"),
        )
        for i, name in enumerate(df.columns)
    ]
    long = _count_row(df).select(
        stack_rows(cells, ["column", "n", "valid", "empty", "missing"])
    )
    return long.select(
        "*",
        percentage(F.col("valid"), F.col("n")).alias("valid_pct"),
        percentage(F.col("empty"), F.col("n")).alias("empty_pct"),
        percentage(F.col("missing"), F.col("n")).alias("missing_pct"),
    )


def non_null_percentage(df: DataFrame) -> DataFrame:
    """Per column: 100 * non-null cells / rows, null for an empty table."""
    cells = [(F.lit(name), F.col(f"c{i}"), F.col("n")) for i, name in enumerate(df.columns)]
    return _count_row(df).select(stack_rows(cells, ["column", "non_null", "n"])).select(
        "column", "non_null", percentage(F.col("non_null"), F.col("n")).alias("pct")
    )


def names_frame(spark: SparkSession, names: Iterable[str]) -> DataFrame:
    """Column names with their position; as long as the schema, never as the data."""
    return spark.createDataFrame(list(enumerate(names)), "position int, column string")


# Some questions ("does a value repeat", "does a value meet two others") are
# settled by one witness, whichever rows it is found in. A slice of the rows
# finds one for nearly everything that has one, at a fraction of the shuffle:
# all rows of one value in SLICES, for values that are rare, and one row in
# SLICES, for values that are not. Both are chosen by hash. Whatever has no
# witness in the slice is then checked on all rows.
SLICES = 64


def stack_values(
    df: DataFrame, columns: Sequence[str], payload: Sequence[Column] = (), slice_only: bool = False
) -> DataFrame:
    """``(*payload, position, num, dbl, txt)``, one row per cell of ``columns``.

    The expressions that are stacked stay trivial, since all of them end up in
    one generated method; whatever can be is computed on the stacked rows.
    """
    types = column_types(df)
    cells = [(F.lit(i), *value_key(name, types[name])) for i, name in enumerate(columns)]
    floats = any(isinstance(types[name], (T.FloatType, T.DoubleType)) for name in columns)
    known = lambda dbl: F.when(~F.isnan(dbl), dbl) if floats else dbl
    if not slice_only:
        long = df.select(*payload, stack_rows(cells, ["position", *KEY]))
        return long.withColumn("dbl", known(F.col("dbl"))) if floats else long
    # what isn't in the slice is dropped before it gets a row of its own with all the payload
    flat = [c for c in columns if family_of(types[c]) != NESTED]
    row = F.xxhash64(*[quoted(c) for c in flat]) if flat else F.lit(1).cast("bigint")
    every = F.array(*[F.struct(*[c.alias(n) for c, n in zip(cell, ["position", *KEY])]) for cell in cells])
    staged = df.select(
        *[c.alias(f"__p{i}") for i, c in enumerate(payload)],
        (F.pmod(row, F.lit(SLICES)) == 0).alias("__by_row"),
        every.alias("__cells"),
    )
    in_slice = F.filter(
        "__cells",
        lambda c: F.col("__by_row") | (F.pmod(F.xxhash64(c["num"], known(c["dbl"]), c["txt"]), F.lit(SLICES)) == 0),
    )
    long = staged.select(*[f"__p{i}" for i in range(len(payload))], F.inline(in_slice))
    names = df.select(*payload).columns if payload else []
    return long.toDF(*names, "position", *KEY).withColumn("dbl", known(F.col("dbl")))


def long_values(df: DataFrame, columns: Sequence[str], slice_only: bool = False) -> DataFrame:
    """``(position, num, dbl, txt)`` for every non-null cell; comparable within one position."""
    return stack_values(df, columns, slice_only=slice_only).where(has_key())


def distinct_value_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Exact distinct non-null values per column, all columns in one shuffle.

    Grouping by (column, value) combines repeats before the shuffle, so a hot
    value costs one row per task; many ``count_distinct`` in one aggregate
    would instead copy every row once per column into the shuffle.
    """
    columns = list(columns or df.columns)
    values = long_values(df, columns).groupBy("position", *KEY).count()
    counts = values.groupBy("position").agg(F.count(F.lit(1)).alias("ndv"))
    return (
        names_frame(df.sparkSession, columns)
        .join(counts, "position", "left")
        .select("column", F.coalesce("ndv", F.lit(0).cast("bigint")).alias("ndv"))
    )


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> dict[str, int]:
    if not columns:
        return {}
    return {r["column"]: r["ndv"] for r in distinct_value_counts(df, columns).collect()}


def _repeating(values: DataFrame, columns: Sequence[str]) -> set[str]:
    """Columns with a value that occurs more than once."""
    repeats = values.groupBy("position", *KEY).count().where("count > 1")
    return {columns[r["position"]] for r in repeats.select("position").distinct().collect()}


def unique_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """The columns without a repeated value, checked on all rows.

    Columns with few values combine before the shuffle; only columns that are
    unique or nearly so are shuffled whole.
    """
    if not columns:
        return []
    repeating = _repeating(long_values(df, columns), columns)
    return [name for name in columns if name not in repeating]


def primary_key_candidates(
    df: DataFrame, allow_empty: bool = True, counts: ColumnCounts | None = None
) -> list[str]:
    """Columns without nulls whose values are all distinct.

    Columns with a null fall out by their counts, most others by a repeat in
    the slice, and the rest is checked exactly.
    """
    counts = counts or column_counts(df)
    rows = counts.rows
    per_column = counts.non_null if allow_empty else counts.filled
    likely = [name for name in df.columns if per_column[name] == rows]
    if rows == 0 or not likely:
        return likely
    repeating = _repeating(long_values(df, likely, slice_only=True), likely)
    return unique_columns(df, [name for name in likely if name not in repeating])


def pairwise_equality(
    df: DataFrame,
    pairs: Sequence[tuple[str, str]] | None = None,
    null_safe: bool = False,
) -> DataFrame:
    """Per column pair the number and ratio of rows holding equal values.

    Few pairs are sums of comparisons, one row per task. Many, which would not
    fit in one aggregate, are counted batch by batch in a single scan
    (``_equal_by_codes``). Both count every row.
    """
    spark, types = df.sparkSession, column_types(df)
    if pairs is None:
        pairs = list(combinations(df.columns, 2))
    pairs = list(pairs)
    if not pairs:
        return spark.createDataFrame(
            [], "col1 string, col2 string, n bigint, n_equal bigint, ratio double, identical boolean"
        )
    counted = _equal_by_codes if len(pairs) > PAIRS_PER_PASS else _equal_by_sums
    names = spark.createDataFrame(
        [(-1, None, None), *((i, a, b) for i, (a, b) in enumerate(pairs))], "pair int, col1 string, col2 string"
    )
    # pair -1 counts the rows; one row per pair of columns
    rows = F.max(F.when(F.col("pair") == -1, F.col("n_equal"))).over(Window.partitionBy(F.lit(0)))
    found = names.join(counted(df, pairs, null_safe), "pair", "left").select(
        "pair", "col1", "col2", F.coalesce(rows, F.lit(0)).cast("bigint").alias("n"),
        F.coalesce("n_equal", F.lit(0)).cast("bigint").alias("n_equal"),
    )
    return found.where("pair >= 0").select(
        "col1",
        "col2",
        "n",
        "n_equal",
        F.try_divide(F.col("n_equal").cast("double"), F.col("n")).alias("ratio"),
        ((F.col("n") > 0) & (F.col("n_equal") == F.col("n"))).alias("identical"),
    )


def _equal_by_sums(df: DataFrame, pairs: Sequence[tuple[str, str]], null_safe: bool) -> DataFrame:
    """(pair, n_equal) by one comparison a pair.

    Columns are cleaned once in a projection, so that a comparison is two column names.
    """
    types = column_types(df)
    place = {name: i for i, name in enumerate(df.columns)}

    def value(name: str) -> Column:
        cleaned = clean_value(name, types[name])
        return F.to_json(cleaned) if family_of(types[name]) == NESTED else cleaned

    def equal(a: str, b: str) -> str:
        left, right = f"v{place[a]}", f"v{place[b]}"
        if family_of(types[a]) == family_of(types[b]):
            return f"{left} {'<=>' if null_safe else '='} {right}"
        return f"{left} IS NULL AND {right} IS NULL" if null_safe else "false"

    used = sorted({place[name] for pair in pairs for name in pair})
    cleaned = df.select(*[value(df.columns[i]).alias(f"v{i}") for i in used])
    counts = cleaned.selectExpr(
        f"array(count(1), {', '.join(f'count_if({equal(a, b)})' for a, b in pairs)}) AS equals"
    )
    return counts.selectExpr("posexplode(equals) AS (at, n_equal)").selectExpr("at - 1 AS pair", "n_equal")


def _equal_by_codes(df: DataFrame, pairs: Sequence[tuple[str, str]], null_safe: bool) -> DataFrame:
    """(pair, n_equal) from one scan, however many pairs.

    Within an Arrow batch every value gets the code of its first appearance
    among all columns of its kind (in their ``comparable`` form), so that
    a pair is one comparison of two arrays of small numbers. A task sends one row for
    each pair that was ever equal.
    """
    types = column_types(df)
    wanted = {name for pair in pairs for name in pair}
    kinds: dict[int, list[str]] = {}
    for name in df.columns:
        if name in wanted:
            kinds.setdefault(family_of(types[name]), []).append(name)
    used = [name for members in kinds.values() for name in members]
    at = {name: i for i, name in enumerate(used)}
    sizes = [len(members) for members in kinds.values()]
    columns = []
    for members in kinds.values():
        like = comparable([types[m] for m in members])
        columns += [like(m, types[m]).alias(f"v{at[m]}") for m in members]
    c = len(used)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, equal = 0, np.zeros((c, c), dtype=np.int64)
        for batch in batches:
            n = batch.num_rows
            if n == 0:
                continue
            rows += n
            codes = np.empty((c, n), dtype=np.int32)
            begin = used_codes = 0
            for size in sizes:
                values = pa.concat_arrays([batch.column(begin + k) for k in range(size)])
                if pa.types.is_floating(values.type):
                    values = pc.add(values, 0.0)  # -0.0 is 0.0
                found = values.dictionary_encode()
                own = pc.fill_null(found.indices, -1).to_numpy(zero_copy_only=False).reshape(size, n)
                codes[begin : begin + size] = np.where(own < 0, -1, own + used_codes)
                used_codes += len(found.dictionary)
                begin += size
            if not null_safe:  # nulls equal nothing
                codes = np.where(codes < 0, -1 - np.arange(c, dtype=np.int32)[:, None], codes)
            for i in range(c - 1):
                equal[i, i + 1 :] += np.count_nonzero(codes[i + 1 :] == codes[i], axis=1)
        if rows:
            i, j = np.nonzero(equal)
            code = np.concatenate([[-1], i * c + j])
            yield pa.RecordBatch.from_arrays(
                [pa.array(code.astype(np.int64)), pa.array(np.concatenate([[rows], equal[i, j]]))], ["code", "n"]
            )

    met = df.select(*columns).mapInArrow(count, "code long, n long").groupBy("code").agg(F.sum("n").alias("n_equal"))
    places = [tuple(sorted((at[a], at[b]))) for a, b in pairs]
    wanted_codes = [(-1, -1), *((k, i * c + j) for k, (i, j) in enumerate(places))]
    return df.sparkSession.createDataFrame(wanted_codes, "pair int, c long").join(met, F.col("c") == F.col("code")).select("pair", "n_equal")


def identical_classes(
    df: DataFrame, null_safe: bool = False, counts: ColumnCounts | None = None
) -> list[list[str]]:
    """Groups of columns equal in every row, each in column order.

    One scan computes a row-sensitive fingerprint per column (the hash of its
    value mixed with the hash of the whole row), then only columns with equal
    fingerprints are compared. The work grows with the columns, not with
    their pairs.
    """
    types = column_types(df)
    counts = counts or column_counts(df)
    if counts.rows == 0:
        return []
    columns = [c for c in df.columns if null_safe or counts.non_null[c] == counts.rows]
    if len(columns) < 2:
        return []
    hashed = df.select(
        *[F.coalesce(value_hash(c, types[c]), F.lit(0)).alias(f"h{i}") for i, c in enumerate(columns)]
    )
    hashed = hashed.withColumn("row", F.xxhash64(*hashed.columns))
    prints = []
    for i in range(len(columns)):
        mixed = F.xxhash64(F.col(f"h{i}"), F.col("row"))
        # the masked sum keeps what the xor loses to repeated rows, without overflow
        prints += [
            F.bit_xor(mixed).alias(f"x{i}"),
            F.sum(mixed.bitwiseAND(F.lit(0xFFFFF))).alias(f"s{i}"),
        ]
    row = hashed.agg(*prints).first()
    by_print: dict[tuple, list[str]] = {}
    for i, name in enumerate(columns):
        by_print.setdefault((row[f"x{i}"], row[f"s{i}"]), []).append(name)
    candidates = [
        pair for group in by_print.values() if len(group) > 1 for pair in combinations(group, 2)
    ]
    if not candidates:
        return []
    verified = pairwise_equality(df, candidates, null_safe).where("identical").collect()
    return merge_pairs(df.columns, [(r["col1"], r["col2"]) for r in verified])


def merge_pairs(order: Sequence[str], pairs: Iterable[tuple[str, str]]) -> list[list[str]]:
    """Classes of an equivalence relation given by its pairs, in column order."""
    leader = {name: name for name in order}

    def find(name: str) -> str:
        while leader[name] != name:
            name = leader[name]
        return name

    place = {name: i for i, name in enumerate(order)}
    for a, b in pairs:
        first, second = sorted((find(a), find(b)), key=place.__getitem__)
        leader[second] = first
    classes: dict[str, list[str]] = {}
    for name in order:
        classes.setdefault(find(name), []).append(name)
    return [members for members in classes.values() if len(members) > 1]


def equality_bounds(df: DataFrame, columns: Sequence[str]) -> dict[tuple[str, str], int]:
    """An upper bound on the equal rows of every column pair, from one scan.

    Values are hashed into buckets and counted per column. Rows where two
    columns agree fall into the same bucket on both sides, so the sum of the
    smaller bucket counts can only be too high.
    """
    types = column_types(df)
    cells = [
        (F.lit(i), F.pmod(value_hash(c, types[c]), F.lit(HISTOGRAM_BUCKETS)).cast("int"))
        for i, c in enumerate(columns)
    ]
    counts = (
        df.select(stack_rows(cells, ["position", "bucket"]))
        .where(F.col("bucket").isNotNull())
        .groupBy("position", "bucket")
        .count()
    )
    # at most len(columns) * HISTOGRAM_BUCKETS rows, whatever the table holds
    histogram: list[dict[int, int]] = [{} for _ in columns]
    for r in counts.collect():
        histogram[r["position"]][r["bucket"]] = r["count"]
    return {
        (columns[i], columns[j]): sum(
            min(n, histogram[j].get(bucket, 0)) for bucket, n in histogram[i].items()
        )
        for i, j in combinations(range(len(columns)), 2)
    }


def similar_pairs(
    df: DataFrame, threshold: float = 0.9, counts: ColumnCounts | None = None
) -> list[tuple[str, str, int]]:
    """Column pairs equal in strictly more than ``threshold`` of the rows."""
    counts = counts or column_counts(df)
    if counts.rows == 0:
        return []
    columns = [c for c in df.columns if counts.non_null[c] / counts.rows > threshold]
    if len(columns) < 2:
        return []
    bounds = equality_bounds(df, columns)
    possible = [pair for pair, most in bounds.items() if most / counts.rows > threshold]
    if not possible:
        return []
    exact = pairwise_equality(df, possible).collect()
    return [
        (r["col1"], r["col2"], r["n_equal"])
        for r in exact
        if r["n_equal"] / counts.rows > threshold
    ]


def name_part_counts(names: DataFrame, column: str = "name") -> DataFrame:
    """How often each underscore-separated part occurs over all names."""
    bare = F.ltrim(F.col(column), F.lit("_"))
    return names.select(F.explode(F.split(bare, "_", -1)).alias("part")).groupBy("part").agg(
        F.count(F.lit(1)).alias("n")
    )
