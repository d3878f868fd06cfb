"""Finding the columns to join on, and joining."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.functions.values import NESTED, clean_value, family_of, quoted
from tablewright.operators.overlap import column_sketches, key_match_percentages, similarity_bounds
from tablewright.operators.profile import column_types, primary_key_candidates
from tablewright.operators.relations import Star, find_relations, star_schema
from tablewright.operators.cleaning import drop_identical_columns
from tablewright.operators.schema_ops import distinct_names
from tablewright.session import materialize


class JoinChoice(NamedTuple):
    key1: str
    key2: str
    how: str
    ndv1: int
    ndv2: int
    common: int


def join_type(ndv1: int, ndv2: int, common: int, nulls1: bool = False, nulls2: bool = False) -> str:
    """Equal sets join inner; a subset keeps the larger side; otherwise full outer.

    A side with rows without a key (null or NaN) is kept as well: they match
    nothing, so another join would lose them.
    """
    keep1 = common < ndv1 or nulls1
    keep2 = common < ndv2 or nulls2
    return {(False, False): "inner", (True, False): "left", (False, True): "right"}.get((keep1, keep2), "outer")


def has_rows_without(df: DataFrame, key: str) -> bool:
    """Whether some row has a null or NaN as ``key``; reads this column alone."""
    missing = clean_value(key, column_types(df)[key]).isNull()
    return not df.select(missing.alias("missing")).where("missing").isEmpty()


def choose_join(
    df1: DataFrame,
    keys1: Sequence[str],
    df2: DataFrame,
    keys2: Sequence[str],
    prefer: str | None = None,
) -> JoinChoice | None:
    """The best matching pair of columns and the join it calls for, no row of either side lost.

    Pairs are ranked by how close their value sets are to identical: shared
    values over all values of both. Containment alone would favour a column of
    small integers that happens to lie inside a wide one. Names matching
    ``prefer`` win before that. None if no pair shares a value.

    Sketches of all columns bound how alike each pair can be; only columns of
    pairs that may still win have their values shuffled and counted exactly.
    """
    keys1, keys2 = list(keys1), list(keys2)
    liked = lambda k1, k2: sum(bool(prefer and re.search(prefer, k)) for k in (k1, k2))
    hopeful = _may_win(df1, keys1, df2, keys2, liked)
    few1, few2 = ([k for k in keys if any(k == pair[i] for pair in hopeful)] for i, keys in enumerate((keys1, keys2)))
    matches = [r for r in key_match_percentages(df1, few1, df2, few2).collect() if r["common"]]
    if not matches:
        return None

    def rank(r):
        alike = r["common"] / (r["ndv1"] + r["ndv2"] - r["common"])
        return (-liked(r["key1"], r["key2"]), -alike, -r["common"], keys1.index(r["key1"]), keys2.index(r["key2"]))

    best = min(matches, key=rank)
    n1, n2, n = best["ndv1"], best["ndv2"], best["common"]
    how = join_type(n1, n2, n, has_rows_without(df1, best["key1"]), has_rows_without(df2, best["key2"]))
    return JoinChoice(best["key1"], best["key2"], how, n1, n2, n)


def _may_win(df1: DataFrame, keys1: list[str], df2: DataFrame, keys2: list[str], liked) -> list[tuple[str, str]]:
    """The pairs that can be the best one: none of their rank, or of a better one, is sure to be more alike."""
    pairs = [(a, b) for a in keys1 for b in keys2 if a in df1.columns and b in df2.columns]
    if len(pairs) < 2:
        return pairs
    own = column_sketches(df1, [k for k in keys1 if k in df1.columns])
    other = column_sketches(df2, [k for k in keys2 if k in df2.columns])
    bounds = {(a, b): similarity_bounds(own[a], other[b]) for a, b in pairs}
    out: list[tuple[str, str]] = []
    for rank in sorted({liked(*p) for p in pairs}, reverse=True):
        level = [p for p in pairs if liked(*p) == rank and bounds[p][1] > 0]
        least = max((bounds[p][0] for p in level), default=0.0)
        out += [p for p in level if bounds[p][1] >= least]
        if least > 0:  # some pair of this rank does share values
            break
    return out


def merge_pair(
    df1: DataFrame,
    df2: DataFrame,
    k1: str,
    k2: str,
    how: str = "outer",
    *,
    suffixes: tuple[str, str] = ("_x", "_y"),
    coalesce: bool = False,
    null_safe: bool = False,
    unique1: bool = False,
    unique2: bool = False,
) -> DataFrame:
    """Join on ``k1 = k2``; the key comes out once, under the name ``k1``. NaN keys count as null.

    Other columns both sides have get the suffixes, or with ``coalesce`` come
    out once, filled from the second table where the first has none.

    Adaptive execution splits a hot key on both sides of an inner join and on
    the preserved side of a left join, but never in a full join. Unless both
    keys are unique, right and full joins are therefore put together from a
    join it can split and the rows without a partner.
    """
    if how not in ("inner", "left", "right", "outer"):
        raise ValueError(f"unknown join {how!r}")
    types1, types2 = column_types(df1), column_types(df2)
    if family_of(types1[k1]) != family_of(types2[k2]):
        raise ValueError(f"{k1} and {k2} hold values of different kinds, which never match")
    left = df1.toDF(*[f"l{i}" for i in range(len(df1.columns))])
    right = df2.toDF(*[f"r{i}" for i in range(len(df2.columns))])
    at1 = {name: f"l{i}" for i, name in enumerate(df1.columns)}
    at2 = {name: f"r{i}" for i, name in enumerate(df2.columns)}
    lk, rk = at1[k1], at2[k2]

    shared = [n for n in df1.columns if n in at2 and n != k1 and n != k2]
    cells = []
    for name in df1.columns:
        value = F.col(at1[name])
        if name == k1:
            value = F.coalesce(value, F.col(rk))
        elif name in shared and coalesce:
            value = F.coalesce(value, F.col(at2[name]))
        cells.append((name + suffixes[0] if name in shared and not coalesce else name, value))
    for name in df2.columns:
        if name == k2 or (name in shared and coalesce):
            continue
        clash = name in at1
        cells.append((name + suffixes[1] if clash else name, F.col(at2[name])))
    names = distinct_names(name for name, _ in cells)

    # matching goes by the key with NaN as null, the output keeps the key as it was
    left = left.select("*", clean_value(lk, types1[k1]).alias("lkey"))
    right = right.select("*", clean_value(rk, types2[k2]).alias("rkey"))
    joined = _joined(left, right, "lkey", "rkey", how, null_safe, unique1, unique2)
    return joined.select(*[v.alias(n) for n, (_, v) in zip(names, cells, strict=True)])


def _joined(left, right, lk, rk, how, null_safe, unique1, unique2) -> DataFrame:
    match = F.col(lk).eqNullSafe(F.col(rk)) if null_safe else F.col(lk) == F.col(rk)
    whole = (unique1 and unique2) or how == "inner"
    if whole or (how == "left" and unique2) or (how == "right" and unique1):
        return left.join(right, match, how)

    def lonely(side: DataFrame, key: str, other: DataFrame, other_key: str) -> DataFrame:
        # distinct keys on the other side: its hot keys combine before the shuffle
        partners = other.select(other_key).distinct()
        return side.join(partners, match, "left_anti")

    parts = []
    if how in ("left", "outer") and unique2:
        parts.append(left.join(right, match, "left"))
    elif how in ("right", "outer") and unique1:
        parts.append(left.join(right, match, "right"))
    else:
        parts.append(left.join(right, match, "inner"))
    if how in ("left", "outer") and not unique2:
        parts.append(lonely(left, lk, right, rk))
    if how in ("right", "outer") and not (unique1 and not unique2):
        parts.append(lonely(right, rk, left, lk))
    filled = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return filled


def merge_many(
    dfs: Sequence[DataFrame],
    keys: Sequence[tuple[str, str]] | None = None,
    prefer: str | None = None,
    coalesce: bool = False,
) -> DataFrame:
    """Join tables from left to right, finding the keys against what has been joined so far.

    The second table's key must be unique, the first table's may be any
    column. ``keys`` forces them. Each step is written out before the next one
    profiles it. Where one side has no rows, all rows of the other come out: joined
    on the given keys or on the first columns of one name and kind, else with the columns
    side by side. Tables with rows that share no value raise.
    """
    merged = dfs[0]
    for step, df in enumerate(dfs[1:]):
        unique2 = primary_key_candidates(df)
        if keys is not None:
            keys1, keys2 = [keys[step][0]], [keys[step][1]]
        else:
            types, types2 = column_types(merged), column_types(df)
            keys2 = [c for c in unique2 if family_of(types2[c]) != NESTED]
            kinds = {family_of(types2[c]) for c in keys2}
            keys1 = [c for c in merged.columns if family_of(types[c]) in kinds]
        choice = choose_join(merged, keys1, df, keys2, prefer)
        if choice is None and (df.isEmpty() or merged.isEmpty()):
            pair = keys[step] if keys is not None else _same_named(merged, keys1, df, keys2)
            merged = merge_pair(merged, df, *pair, "outer", coalesce=coalesce) if pair else _beside(merged, df)
            continue
        if choice is None:
            raise ValueError(f"table {step + 2} shares no key values with the tables before it")
        merged = merge_pair(
            merged,
            df,
            choice.key1,
            choice.key2,
            choice.how,
            coalesce=coalesce,
            unique2=choice.key2 in unique2,
        )
        if step < len(dfs) - 2:
            merged = materialize(merged, "merged")
    return merged


def _same_named(df1: DataFrame, keys1: Sequence[str], df2: DataFrame, keys2: Sequence[str]) -> tuple[str, str] | None:
    types1, types2 = column_types(df1), column_types(df2)
    return next(((k, k) for k in keys1 if k in keys2 and family_of(types1[k]) == family_of(types2[k])), None)


def _beside(df1: DataFrame, df2: DataFrame) -> DataFrame:
    """All rows of two tables without a common column; names that both have get a suffix."""
    both = set(df1.columns) & set(df2.columns)
    names = [[c + suffix if c in both else c for c in df.columns] for df, suffix in ((df1, "_x"), (df2, "_y"))]
    names = distinct_names([*names[0], *names[1]])
    n = len(df1.columns)
    return df1.toDF(*names[:n]).unionByName(df2.toDF(*names[n:]), allowMissingColumns=True)


def coalesced_merge(df1: DataFrame, df2: DataFrame, k1: str, k2: str, how: str = "outer", **options) -> DataFrame:
    """Join and fill the gaps of the first table from the second."""
    return merge_pair(df1, df2, k1, k2, how, coalesce=True, **options)


def merge_and_reclean(dfs: Sequence[DataFrame], **options) -> Star:
    """Merge, then drop repeated columns and split off lookups once more."""
    merged = merge_many(dfs, **options)
    if len(dfs) > 1:
        merged = materialize(merged, "merged")
    (slim,), _ = drop_identical_columns(merged)
    return star_schema(slim, find_relations(slim))


def map_column(df: DataFrame, column: str, mapping: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """``df`` with what ``mapping`` says for the value of ``column``, null where it says nothing.

    The keys of ``mapping`` must be unique; null and NaN are no keys.
    """
    types = column_types(df)
    wanted = clean_value(column, types[column])
    known = mapping.select(
        clean_value(key, column_types(mapping)[key]).alias("__key"), F.col(quoted(value)).alias("__value")
    )
    numbered = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    joined = df.select("*", wanted.alias("__wanted")).toDF(*numbered.columns, "__wanted").join(
        known, F.col("__wanted") == F.col("__key"), "left"
    )
    return joined.select(*numbered.columns, "__value").toDF(*df.columns, name)


def union_by_name(dfs: Sequence[DataFrame]) -> DataFrame:
    """All rows of all tables; columns a table lacks are null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def removed_columns(before: DataFrame, after: DataFrame) -> list[str]:
    kept = set(after.columns)
    return [name for name in before.columns if name not in kept]
