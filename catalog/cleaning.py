"""Sparse and repeated columns, nulls and text."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import (
    CUSTOMER_TOKENS,
    CUSTOMER_UNTIDY,
    LINEITEM_COPIES,
    NA_LIST,
    ORDERS_GAPS,
    Tables,
    derived,
    query,
)
from tablewright.functions import (
    comma_join,
    drop_prefix,
    is_filled,
    lower_strip,
    strip_underscores,
)
from tablewright.operators.cleaning import (
    drop_all_null_columns,
    drop_all_null_rows,
    drop_identical_columns,
    drop_incomplete_and_duplicate_rows,
    drop_similar_columns,
    drop_sparse_columns,
    empty_to_null,
    normalize_na,
    standardize_text,
)
from tablewright.operators.joins import removed_columns

_FULL = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority"


@query(f"SELECT {_FULL}, tenth, edge, half_empty, mostly_empty FROM {ORDERS_GAPS.sql}")
def sparse_by_fraction(t: Tables):
    return drop_sparse_columns(ORDERS_GAPS.frame(t), 0.95, "fraction").table


@query(f"SELECT {_FULL}, tenth, edge, half_empty, mostly_empty FROM {ORDERS_GAPS.sql}")
def sparse_by_floor(t: Tables):
    return drop_sparse_columns(ORDERS_GAPS.frame(t), 0.95, "floor").table


@query(
    f"SELECT {_FULL}, tenth, edge, nullif(half_empty, '') AS half_empty FROM {ORDERS_GAPS.sql}"
)
def sparse_by_percent(t: Tables):
    return drop_sparse_columns(ORDERS_GAPS.frame(t), mode="percent").table


@query(
    " UNION ALL ".join(
        f"SELECT '{c}' AS removed FROM {ORDERS_GAPS.sql}"
        f" HAVING 20 * count(nullif(CAST({c} AS VARCHAR), '')) < count(*)"
        for c in ("o_orderkey", "o_orderstatus", "tenth", "edge", "rare", "half_empty", "mostly_empty", "never")
    )
)
def sparse_column_names(t: Tables):
    frame = ORDERS_GAPS.frame(t)
    slim = drop_sparse_columns(frame, mode="percent").table
    return t.spark.createDataFrame([(n,) for n in removed_columns(frame, slim)], "removed string")


@query(
    "SELECT o_orderkey, nullif(half_empty, '') AS half_empty, nullif(mostly_empty, '') AS mostly_empty"
    f" FROM {ORDERS_GAPS.sql}"
)
def empty_strings_to_null(t: Tables):
    return empty_to_null(ORDERS_GAPS.frame(t).select("o_orderkey", "half_empty", "mostly_empty"))


@query(
    f"SELECT c_custkey, CASE WHEN c_mktsegment NOT IN ({NA_LIST}) THEN c_mktsegment END AS c_mktsegment"
    f" FROM {CUSTOMER_TOKENS.sql}"
)
def missing_tokens_to_null(t: Tables):
    return normalize_na(CUSTOMER_TOKENS.frame(t))


@query(
    f"SELECT {_FULL}, tenth, edge, rare, half_empty, mostly_empty FROM {ORDERS_GAPS.sql}"
)
def without_all_null_columns(t: Tables):
    return drop_all_null_columns(ORDERS_GAPS.frame(t)).table


_NULL_ROWS = derived(
    "orders",
    "CASE WHEN o_orderkey % 7 <> 0 THEN o_orderkey END AS k",
    "CASE WHEN o_orderkey % 14 <> 0 THEN o_orderstatus END AS s",
)


@query(f"SELECT k, s FROM {_NULL_ROWS.sql} WHERE k IS NOT NULL OR s IS NOT NULL")
def without_all_null_rows(t: Tables):
    return drop_all_null_rows(_NULL_ROWS.frame(t))


_TIDY = (
    "lower(trim(c_name, ' \u00a0\u3000' || chr(9) || chr(10)))",
    "lower(trim(c_mktsegment, ' \u00a0\u3000' || chr(9) || chr(10)))",
)


@query(
    f"SELECT c_custkey, {_TIDY[0]} AS c_name, {_TIDY[1]} AS c_mktsegment, c_acctbal FROM {CUSTOMER_UNTIDY.sql}"
)
def standardized_in_place(t: Tables):
    return standardize_text(CUSTOMER_UNTIDY.frame(t), in_place=True)


@query(
    "SELECT c_custkey, c_name, c_mktsegment, c_acctbal,"
    f" {_TIDY[0]} AS c_name_std, {_TIDY[1]} AS c_mktsegment_std FROM {CUSTOMER_UNTIDY.sql}"
)
def standardized_copy(t: Tables):
    return standardize_text(CUSTOMER_UNTIDY.frame(t))


_REPEATS = derived(
    "lineitem",
    "l_returnflag",
    "l_linestatus",
    "CASE WHEN l_linenumber > 1 THEN l_linenumber END AS line",
    "l_discount",
)


@query(
    f"SELECT DISTINCT l_returnflag, l_linestatus, line, l_discount FROM {_REPEATS.sql} WHERE line IS NOT NULL"
)
def complete_distinct_rows(t: Tables):
    return drop_incomplete_and_duplicate_rows(_REPEATS.frame(t))


@query(
    "SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag, l_flag_close, l_flag_far, l_line_gaps"
    f" FROM {LINEITEM_COPIES.sql}"
)
def without_identical_columns(t: Tables):
    (slim,), _ = drop_identical_columns(LINEITEM_COPIES.frame(t))
    return slim


@query(
    "SELECT l_orderkey, l_linenumber, l_quantity, upper(l_returnflag) AS l_returnflag,"
    " upper(l_flag_close) AS l_flag_close, upper(l_flag_far) AS l_flag_far, l_line_gaps"
    f" FROM {LINEITEM_COPIES.sql}"
)
def identical_columns_of_companion(t: Tables):
    frame = LINEITEM_COPIES.frame(t)
    flags = ("l_returnflag", "l_flag_close", "l_flag_far")
    companion = frame.withColumns({c: F.upper(c) for c in flags})
    (_, slim), _ = drop_identical_columns(frame, companion)
    return slim


@query(
    f"SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag, l_flag_far FROM {LINEITEM_COPIES.sql}"
)
def without_similar_columns(t: Tables):
    return drop_similar_columns(LINEITEM_COPIES.frame(t), 0.9).table


@query(
    "SELECT c_custkey, lower(c_name) AS lowered, ltrim('__' || c_name, '_') AS bare,"
    " substring(c_name, 10) AS number, string_split(c_name, '#')[2] AS tail,"
    " c_name LIKE 'Customer%' AS starts, c_name LIKE '%7' AS ends, substring(c_name, 1, 3) AS head,"
    " c_mktsegment || ',' || c_name AS joined, c_mktsegment <> '' AS filled,"
    " CAST(ceil(c_custkey / 7.0) AS BIGINT) AS up, CAST(floor(c_custkey / 7.0) AS BIGINT) AS down,"
    " least(c_custkey, 100) AS least_of, c_mktsegment IN ('BUILDING', 'MACHINERY') AS member,"
    " '{\"k\":' || c_custkey || '}' AS json, c_custkey AS from_json, c_name AS decoded, c_name AS from_xml,"
    " round(100.0 * c_nationkey / nullif(c_custkey, 0), 6) AS share"
    " FROM customer"
)
def scalar_functions(t: Tables):
    name, key = F.col("c_name"), F.col("c_custkey")
    return t("customer").select(
        "c_custkey",
        lower_strip(name).alias("lowered"),
        strip_underscores(F.concat(F.lit("__"), name)).alias("bare"),
        drop_prefix(name, "Customer#").alias("number"),
        F.split(name, "#")[1].alias("tail"),
        name.startswith("Customer").alias("starts"),
        name.endswith("7").alias("ends"),
        F.substring(name, 1, 3).alias("head"),
        comma_join(F.array("c_mktsegment", name)).alias("joined"),
        is_filled(F.col("c_mktsegment")).alias("filled"),
        F.ceil(key / 7).alias("up"),
        F.floor(key / 7).alias("down"),
        F.least(key, F.lit(100)).alias("least_of"),
        F.col("c_mktsegment").isin("BUILDING", "MACHINERY").alias("member"),
        F.to_json(F.struct(key.alias("k"))).alias("json"),
        F.from_json(F.to_json(F.struct(key.alias("k"))), "k bigint")["k"].alias("from_json"),
        F.try_validate_utf8(F.decode(F.encode(name, "UTF-8"), "UTF-8")).alias("decoded"),
        F.xpath_string(F.concat(F.lit("<a><b>"), name, F.lit("</b></a>")), F.lit("/a/b")).alias("from_xml"),
        F.round(F.try_divide(100.0 * F.col("c_nationkey"), key), 6).alias("share"),
    )
