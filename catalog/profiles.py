"""Completeness, distinct counts, keys and pairwise equality."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from catalog.registry import (
    LINEITEM_COPIES,
    LINEITEM_COPIES_COLUMNS,
    ORDERS_GAPS,
    ORDERS_GAPS_COLUMNS,
    Tables,
    derived,
    query,
)
from tablewright.operators.overlap import distinct_values
from tablewright.operators.profile import (
    completeness_profile,
    distinct_value_counts,
    identical_classes,
    name_part_counts,
    names_frame,
    non_null_percentage,
    pairwise_equality,
    primary_key_candidates,
    similar_pairs,
)

_STRINGS = {"o_orderstatus", "o_orderpriority", "tenth", "edge", "rare", "half_empty", "mostly_empty", "never"}


def _profile_sql(source: str, columns, strings) -> str:
    parts = []
    for c in columns:
        filled = f"nullif({c}, '')" if c in strings else c
        parts.append(
            f"SELECT '{c}' AS \"column\", count(*) AS n, count({filled}) AS valid,"
            f" count({c}) - count({filled}) AS empty, count(*) - count({c}) AS missing FROM {source}"
        )
    return (
        'SELECT "column", n, valid, empty, missing, round(100.0 * valid / n, 6) AS valid_pct,'
        " round(100.0 * empty / n, 6) AS empty_pct, round(100.0 * missing / n, 6) AS missing_pct"
        f" FROM ({' UNION ALL '.join(parts)})"
    )


def _rounded(df, *names):
    return df.withColumns({n: F.round(n, 6) for n in names})


_ORDERS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")


@query(_profile_sql("orders", _ORDERS, {"o_orderstatus", "o_orderpriority"}))
def completeness_of_orders(t: Tables):
    return _rounded(completeness_profile(t("orders")), "valid_pct", "empty_pct", "missing_pct")


@query(_profile_sql(ORDERS_GAPS.sql, ORDERS_GAPS_COLUMNS, _STRINGS))
def completeness_with_gaps(t: Tables):
    return _rounded(completeness_profile(ORDERS_GAPS.frame(t)), "valid_pct", "empty_pct", "missing_pct")


@query(
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count({c}) AS non_null, round(100.0 * count({c}) / count(*), 6) AS pct"
        f" FROM {ORDERS_GAPS.sql}"
        for c in ORDERS_GAPS_COLUMNS
    )
)
def non_null_share(t: Tables):
    return _rounded(non_null_percentage(ORDERS_GAPS.frame(t)), "pct")


_KEYED = {
    "nation": ("n_nationkey", "n_name", "n_regionkey"),
    "customer": ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"),
    "part": ("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"),
    "supplier": ("s_suppkey", "s_name", "s_nationkey", "s_acctbal"),
    "orders": ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"),
}


@query(
    " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{c}' AS \"column\" FROM {table}"
        f" HAVING count({c}) = count(*) AND count(DISTINCT {c}) = count(*)"
        for table, columns in _KEYED.items()
        for c in columns
    )
)
def key_candidates(t: Tables):
    rows = [(table, name) for table in _KEYED for name in primary_key_candidates(t(table))]
    return t.spark.createDataFrame(rows, "table_name string, column string")


@query(
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS ndv FROM {source}"
        for source, columns in (
            (ORDERS_GAPS.sql, ORDERS_GAPS_COLUMNS),
            ("part", _KEYED["part"]),
            ("lineitem", ("l_orderkey", "l_partkey", "l_quantity", "l_discount", "l_shipdate", "l_linestatus")),
        )
        for c in columns
    )
)
def distinct_counts_per_column(t: Tables):
    lineitem = t("lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_discount", "l_shipdate", "l_linestatus"
    )
    return (
        distinct_value_counts(ORDERS_GAPS.frame(t))
        .unionAll(distinct_value_counts(t("part")))
        .unionAll(distinct_value_counts(lineitem))
    )


_KIND = {
    "l_returnflag": "s", "l_flag_close": "s", "l_flag_far": "s",
}


def _equality_sql(source: str, columns) -> str:
    parts = []
    for a, b in combinations(columns, 2):
        same = _KIND.get(a, "n") == _KIND.get(b, "n")
        equal = f"coalesce(sum(CASE WHEN {a} = {b} THEN 1 ELSE 0 END), 0)" if same else "0"
        parts.append(f"SELECT '{a}' AS col1, '{b}' AS col2, count(*) AS n, {equal} AS n_equal FROM {source}")
    return (
        "SELECT col1, col2, CAST(n AS BIGINT) AS n, CAST(n_equal AS BIGINT) AS n_equal,"
        " round(CAST(n_equal AS DOUBLE) / n, 6) AS ratio, n > 0 AND n_equal = n AS identical"
        f" FROM ({' UNION ALL '.join(parts)})"
    )


@query(_equality_sql(LINEITEM_COPIES.sql, LINEITEM_COPIES_COLUMNS))
def column_equality(t: Tables):
    return _rounded(pairwise_equality(LINEITEM_COPIES.frame(t)), "ratio")


# Lineitem with more pairs of columns than one aggregate takes: numbers and texts of few values, with gaps.
_MANY = {
    **{f"r{k}": f"CASE WHEN l_linenumber <> {k % 5} THEN l_orderkey % {k} END AS r{k}" for k in range(2, 22)},
    **{f"s{k}": f"CAST((l_partkey + l_linenumber) % {k} AS VARCHAR(9)) AS s{k}" for k in range(2, 16)},
}
LINEITEM_MANY = derived("lineitem", *_MANY.values())


def _many_sql() -> str:
    pairs = ", ".join(
        "{'col1': '%s', 'col2': '%s', 'n_equal': %s}"
        % (a, b, f"count(*) FILTER (WHERE {a} = {b})" if a[0] == b[0] else "CAST(0 AS BIGINT)")
        for a, b in combinations(_MANY, 2)
    )
    return (
        "SELECT p.col1, p.col2, n, p.n_equal, round(CAST(p.n_equal AS DOUBLE) / n, 6) AS ratio, p.n_equal = n AS identical"
        f" FROM (SELECT count(*) AS n, unnest([{pairs}]) AS p FROM {LINEITEM_MANY.sql})"
    )


@query(_many_sql())
def column_equality_of_many_columns(t: Tables):
    return _rounded(pairwise_equality(LINEITEM_MANY.frame(t)), "ratio")


@query(
    f"SELECT col1, col2 FROM ({_equality_sql(LINEITEM_COPIES.sql, LINEITEM_COPIES_COLUMNS)}) WHERE identical"
)
def identical_column_pairs(t: Tables):
    groups = identical_classes(LINEITEM_COPIES.frame(t))
    pairs = [pair for group in groups for pair in combinations(group, 2)]
    return t.spark.createDataFrame(pairs, "col1 string, col2 string")


@query(
    "SELECT col1, col2, n_equal FROM"
    f" ({_equality_sql(LINEITEM_COPIES.sql, LINEITEM_COPIES_COLUMNS)}) WHERE n_equal > 0.9 * n"
)
def similar_column_pairs(t: Tables):
    pairs = similar_pairs(LINEITEM_COPIES.frame(t), 0.9)
    return t.spark.createDataFrame(pairs, "col1 string, col2 string, n_equal bigint")


@query(
    "SELECT part, count(*) AS n FROM (SELECT unnest(string_split(ltrim('_' || replace(p_name, ' ', '_')"
    " || '_' || p_brand, '_'), '_')) AS part FROM part) GROUP BY part"
)
def name_parts(t: Tables):
    names = t("part").selectExpr("'_' || replace(p_name, ' ', '_') || '_' || p_brand AS name")
    return name_part_counts(names)


@query(
    "SELECT DISTINCT CAST(l_quantity AS BIGINT) AS quantity FROM lineitem WHERE l_quantity IS NOT NULL"
)
def distinct_quantities(t: Tables):
    values = distinct_values(t("lineitem"), "l_quantity")
    return values.select(F.col("value").cast("bigint").alias("quantity"))


@query(
    f"SELECT 'o_orderkey' AS \"column\", count(o_orderkey) AS n FROM {ORDERS_GAPS.sql}"
    f" UNION ALL SELECT 'tenth', count(tenth) FROM {ORDERS_GAPS.sql}"
)
def profile_of_chosen_columns(t: Tables):
    frame = ORDERS_GAPS.frame(t).select("o_orderkey", "tenth")
    wanted = names_frame(t.spark, frame.columns)
    return wanted.join(non_null_percentage(frame), "column").select("column", F.col("non_null").alias("n"))
