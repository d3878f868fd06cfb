"""Which values columns share, within one table or across tables.

Every distinct value is grouped once, together with a bit mask of the columns
it occurs in. Counting the masks answers all pair questions (shared values,
equal sets, containment) from a single shuffle of (family, value): repeats of
a hot value combine before it, and no two rows are ever paired. In tables with
decimals, equal ones of a type are grouped before that as well.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Sequence
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions.values import (
    KEY,
    canonical_key,
    canonical_text,
    decimal_keys,
    family_of,
    has_key,
    quoted,
    value_hash,
    value_key,
)
from tablewright.operators.profile import column_types, stack_rows, stack_values

_BITS = 62  # columns per mask word; the sign bit stays clear

Source = tuple[DataFrame, Sequence[str]]


def _mask_words(total: int) -> int:
    return (total + _BITS - 1) // _BITS


def value_masks(sources: Sequence[Source]) -> DataFrame:
    """``(family, num, dbl, txt, m0, m1, …)``: each distinct value and the columns holding it."""
    words = _mask_words(sum(len(columns) for _, columns in sources))
    masks = [f"m{w}" for w in range(words)]
    either = [F.bit_or(m).alias(m) for m in masks]
    parts, offset = [], 0
    for df, columns in sources:
        types = column_types(df)
        families = F.array(*[F.lit(family_of(types[name])) for name in columns])
        family = F.element_at(families, F.col("position") + 1).alias("family")
        bits = []
        for w in range(words):
            place = f"position + {offset - w * _BITS}"
            bits.append(F.expr(f"CASE WHEN {place} BETWEEN 0 AND {_BITS - 1} THEN shiftleft(1L, {place}) ELSE 0L END AS m{w}"))
        decimals = list(dict.fromkeys(types[c] for c in columns if isinstance(types[c], T.DecimalType)))
        if decimals:
            stacked, own = _stacked_as_they_are(df, columns, decimals)
            # decimals take long to bring into form, so that is done once for each value
            filled = reduce(Column.__or__, [F.col(c).isNotNull() for c in (*KEY, *own)])
            found = stacked.where(filled).select(family, *KEY, *own, *bits).groupBy("family", *KEY, *own).agg(*either)
            # not filtered again: the filter would repeat all these steps below them
            parts.append(canonical_key(decimal_keys(found, own)))
        else:
            parts.append(canonical_key(stack_values(df, columns)).where(has_key()).select(family, *KEY, *bits))
        parts[-1] = parts[-1].select("family", *KEY, *masks)
        offset += len(columns)
    return reduce(DataFrame.union, parts).groupBy("family", *KEY).agg(*either)


def _stacked_as_they_are(
    df: DataFrame, columns: Sequence[str], decimals: Sequence[T.DecimalType]
) -> tuple[DataFrame, list[str]]:
    """``stack_values`` with decimals in columns of their own, one for each of these types; and the names of these."""
    types = column_types(df)
    own = [f"dec{k}" for k in range(len(decimals))]
    none = ("bigint", "double", "string")
    cells = []
    for i, name in enumerate(columns):
        value = F.col(quoted(name))
        if types[name] in decimals:
            key = [F.lit(None).cast(t) for t in none]
        else:
            key = value_key(name, types[name])
        cells.append((F.lit(i), *key, *[value if types[name] == d else F.lit(None).cast(d) for d in decimals]))
    stacked = df.select(stack_rows(cells, ["position", *KEY, *own]))
    return stacked.withColumn("dbl", F.when(~F.isnan("dbl"), F.col("dbl"))), own


def shared_value_counts(sources: Sequence[Source], across: bool = False) -> DataFrame:
    """``(i, j, n)`` with i <= j: how many distinct values columns i and j share.

    Columns are numbered through all sources; ``i == j`` gives the distinct
    count. With ``across`` only pairs from different sources (and i == j) come out.
    """
    total = sum(len(columns) for _, columns in sources)
    owner = [s for s, (_, columns) in enumerate(sources) for _ in columns]
    masks = value_masks(sources)
    words = [name for name in masks.columns if name.startswith("m")]
    # equal masks collapse first; what follows depends on the schema alone
    patterns = masks.groupBy(*words).agg(F.count(F.lit(1)).alias("n"))
    members = F.array_compact(
        F.array(
            *[
                F.when(F.getbit(F.col(f"m{i // _BITS}"), F.lit(i % _BITS)) == 1, F.lit(i))
                for i in range(total)
            ]
        )
    )
    left = patterns.select("n", members.alias("members")).select(
        "n", "members", F.explode("members").alias("i")
    )
    both = left.select("i", F.explode("members").alias("j"), "n").where("i <= j")
    if across:
        source_of = F.array(*[F.lit(s) for s in owner])
        both = both.where(
            (F.col("i") == F.col("j"))
            | (F.element_at(source_of, F.col("i") + 1) != F.element_at(source_of, F.col("j") + 1))
        )
    return both.groupBy("i", "j").agg(F.sum("n").alias("n"))


class Sketch(NamedTuple):
    """The smallest hashes of a column's distinct values; all of them if it has fewer than SKETCH."""

    hashes: np.ndarray
    family: int

    @property
    def complete(self) -> bool:
        return len(self.hashes) < SKETCH


#: Hashes in a sketch, and the odds that a bound is wrong.
SKETCH = 2048
ODDS = 1e-12


def column_sketches(df: DataFrame, columns: Sequence[str]) -> dict[str, Sketch]:
    """A bottom-k sketch of each column, from one scan that shuffles SKETCH hashes for each task and column.

    Hashes are equal for equal values of a family, also across tables. Each
    task keeps the smallest ones it has met; the smallest of all tasks' are
    those of the whole column. What reaches the driver is bounded by the number of columns.
    """
    if not columns:
        return {}
    types = column_types(df)
    size, names = SKETCH, [f"h{i}" for i in range(len(columns))]

    def smallest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = [np.zeros(0, dtype=np.int64) for _ in names]
        for batch in batches:
            for i, name in enumerate(names):
                new = batch.column(name).drop_null().to_numpy()
                if len(kept[i]) == size:
                    new = new[new < kept[i][-1]]
                if len(new):
                    kept[i] = np.unique(np.concatenate([kept[i], np.unique(new)[:size]]))[:size]
        position = np.repeat(np.arange(len(names), dtype=np.int32), [len(k) for k in kept])
        yield pa.RecordBatch.from_arrays([pa.array(position), pa.array(np.concatenate(kept))], ["position", "hash"])

    hashed = df.select(*[value_hash(c, types[c]).alias(n) for c, n in zip(columns, names)])
    of_tasks = hashed.mapInArrow(smallest, "position int, hash long")
    # at most SKETCH rows for each task and column, and as many for each column on the driver
    order = Window.partitionBy("position").orderBy("hash")
    of_all = of_tasks.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= size)
    found: dict[int, list[int]] = {}
    for position, value in of_all.select("position", "hash").collect():
        found.setdefault(position, []).append(value)
    return {
        c: Sketch(np.array(sorted(found.get(i, [])), dtype=np.int64), family_of(types[c])) for i, c in enumerate(columns)
    }


def similarity_bounds(a: Sketch, b: Sketch) -> tuple[float, float]:
    """Least and most that shared values may be of all values of two columns.

    Below the smaller of their largest hashes both sketches are whole, and
    what they hold there is a random sample of all values of both columns. Where both are
    complete it is all of them; else the bounds are those of Chernoff and Hoeffding, at odds of ODDS.
    """
    if a.family != b.family or not len(a.hashes) or not len(b.hashes):
        return 0.0, 0.0
    ends = [s.hashes[-1] for s in (a, b) if not s.complete]
    x, y = (s.hashes[s.hashes <= min(ends)] if ends else s.hashes for s in (a, b))
    shared = len(np.intersect1d(x, y, assume_unique=True))
    seen = len(x) + len(y) - shared
    share = shared / seen if seen else 0.0
    if not ends:
        return share, share
    allowed = math.log(1 / ODDS) / max(seen, 1)

    def off(p: float) -> float:
        parts = [(share, p), (1 - share, 1 - p)]
        return sum(q * math.log(q / r) if r > 0 else math.inf for q, r in parts if q > 0)

    def edge(inside: float, outside: float) -> float:
        for _ in range(60):
            middle = (inside + outside) / 2
            inside, outside = (middle, outside) if off(middle) <= allowed else (inside, middle)
        return outside

    return edge(share, 0.0), edge(share, 1.0)


def value_set_equal_pairs(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Column pairs whose sets of distinct non-null values are equal.

    Equal sets have the same smallest and largest hash, so one scan without a
    wide shuffle leaves only the columns worth an exact comparison.
    """
    spark = df.sparkSession
    schema = "col1 string, col2 string, ndv bigint"
    columns = list(columns or df.columns)
    types = column_types(df)
    ends = []
    for i, name in enumerate(columns):
        hashed = value_hash(name, types[name])
        ends += [F.min(hashed).alias(f"a{i}"), F.max(hashed).alias(f"b{i}")]
    row = df.agg(*ends).first()
    groups: dict[tuple, list[str]] = {}
    for i, name in enumerate(columns):
        if row[f"a{i}"] is not None:
            key = (family_of(types[name]), row[f"a{i}"], row[f"b{i}"])
            groups.setdefault(key, []).append(name)
    chosen = [name for name in columns if any(name in g for g in groups.values() if len(g) > 1)]
    if not chosen:
        return spark.createDataFrame([], schema)
    shared = {(r["i"], r["j"]): r["n"] for r in shared_value_counts([(df, chosen)]).collect()}
    pairs = [
        (chosen[i], chosen[j], n)
        for (i, j), n in sorted(shared.items())
        if i < j
        and n == shared[i, i] == shared[j, j]
        and family_of(types[chosen[i]]) == family_of(types[chosen[j]])
    ]
    return spark.createDataFrame(pairs, schema)


def key_match_percentages(
    df1: DataFrame, keys1: Sequence[str], df2: DataFrame, keys2: Sequence[str]
) -> DataFrame:
    """For every pair of columns: distinct values on each side, shared ones, percentages.

    The percentage of a side without values is null.
    """
    schema = (
        "key1 string, key2 string, ndv1 bigint, ndv2 bigint, common bigint,"
        " pct_of_1 double, pct_of_2 double"
    )
    keys1 = [k for k in keys1 if k in df1.columns]
    keys2 = [k for k in keys2 if k in df2.columns]
    if not keys1 or not keys2:
        return df1.sparkSession.createDataFrame([], schema)
    counts = shared_value_counts([(df1, keys1), (df2, keys2)], across=True)
    shared = {(r["i"], r["j"]): r["n"] for r in counts.collect()}
    rows = []
    for i, key1 in enumerate(keys1):
        for j, key2 in enumerate(keys2, len(keys1)):
            n1, n2, n = shared.get((i, i), 0), shared.get((j, j), 0), shared.get((i, j), 0)
            rows.append(
                (key1, key2, n1, n2, n, 100.0 * n / n1 if n1 else None, 100.0 * n / n2 if n2 else None)
            )
    return df1.sparkSession.createDataFrame(rows, schema)


def value_membership(df_a: DataFrame, a: str, df_b: DataFrame, b: str) -> bool:
    """Whether every non-null value of ``a`` occurs in ``b``."""
    missing = distinct_values(df_a, a).subtract(distinct_values(df_b, b))
    return missing.isEmpty()


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-null values in comparable form: ``(family, value)``."""
    dtype = column_types(df)[column]
    return (
        df.select(F.lit(family_of(dtype)).alias("family"), canonical_text(column, dtype).alias("value"))
        .where(F.col("value").isNotNull())
        .distinct()
    )


def common_values(df1: DataFrame, k1: str, df2: DataFrame, k2: str) -> DataFrame:
    return distinct_values(df1, k1).intersect(distinct_values(df2, k2))


