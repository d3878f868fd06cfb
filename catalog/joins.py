"""Key matching, join choice, merging, set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import Tables, derived, query
from tablewright.operators.joins import (
    choose_join,
    coalesced_merge,
    merge_and_reclean,
    merge_many,
    merge_pair,
    union_by_name,
)
from tablewright.operators.overlap import common_values, key_match_percentages, value_membership
from tablewright.operators.profile import primary_key_candidates
from tablewright.session import scratch_path
from tablewright.plans.flows import aggregate_and_process, clean_table, merge_tables, slim_table
from tablewright.sources.writers import write_tsv
from catalog.registry import LINEITEM_COPIES, ORDERS_GAPS, ORDERS_GAPS_COLUMNS


def match_sql(t1: str, keys1, t2: str, keys2) -> str:
    parts = [
        f"SELECT '{a}' AS key1, '{b}' AS key2, (SELECT count(DISTINCT {a}) FROM {t1}) AS ndv1,"
        f" (SELECT count(DISTINCT {b}) FROM {t2}) AS ndv2,"
        f" (SELECT count(*) FROM (SELECT {a} FROM {t1} INTERSECT SELECT {b} FROM {t2}) WHERE {a} IS NOT NULL) AS common"
        for a in keys1
        for b in keys2
    ]
    return (
        "SELECT key1, key2, ndv1, ndv2, common, round(100.0 * common / ndv1, 6) AS pct_of_1,"
        f" round(100.0 * common / ndv2, 6) AS pct_of_2 FROM ({' UNION ALL '.join(parts)})"
    )


_PAIRS = (
    ("nation", ("n_nationkey", "n_regionkey"), "region", ("r_regionkey",)),
    ("orders", ("o_orderkey", "o_custkey"), "customer", ("c_custkey", "c_nationkey")),
    ("labels", ("doc_id", "quality"), "documents", ("doc_id", "n_chars")),
    ("lineitem", ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"), "orders", ("o_orderkey",)),
    ("pages", ("page_id",), "documents", ("doc_id",)),
)


@query(" UNION ALL ".join(match_sql(*pair) for pair in _PAIRS))
def key_matches(t: Tables):
    parts = [key_match_percentages(t(a), keys1, t(b), keys2) for a, keys1, b, keys2 in _PAIRS]
    return union_by_name(parts).withColumns(
        {n: F.round(n, 6) for n in ("pct_of_1", "pct_of_2")}
    )


def choice_sql(t1: str, keys1, t2: str, keys2) -> str:
    return (
        "SELECT key1, key2, CASE WHEN common = ndv1 AND common = ndv2 THEN 'inner' WHEN common = ndv1 THEN 'right'"
        " WHEN common = ndv2 THEN 'left' ELSE 'outer' END AS how, common FROM"
        f" ({match_sql(t1, keys1, t2, keys2)}) WHERE common > 0"
        " ORDER BY common / (ndv1 + ndv2 - common) DESC, common DESC, key1, key2 LIMIT 1"
    )


_LATER_IDS = derived("documents", "doc_id + 100 AS doc_id", "lang")
_CHOICES = (
    ("nation", ("n_nationkey", "n_regionkey"), "region", ("r_regionkey",)),
    ("orders", ("o_orderkey", "o_custkey"), "customer", ("c_custkey",)),
    ("labels", ("doc_id", "quality"), "documents", ("doc_id",)),
    ("documents", ("doc_id",), "labels", ("doc_id",)),
    ("pages", ("page_id",), _LATER_IDS.sql, ("doc_id",)),
)


@query(" UNION ALL ".join(f"(SELECT * FROM ({choice_sql(*pair)}))" for pair in _CHOICES))
def chosen_joins(t: Tables):
    def frame(name: str):
        return _LATER_IDS.frame(t) if name == _LATER_IDS.sql else t(name)

    rows = []
    for a, keys1, b, keys2 in _CHOICES:
        choice = choose_join(frame(a), keys1, frame(b), keys2)
        if choice is not None:
            rows.append((choice.key1, choice.key2, choice.how, choice.common))
    return t.spark.createDataFrame(rows, "key1 string, key2 string, how string, common bigint")


_ORDERS = derived("orders", "CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_custkey END AS cust", "o_orderkey AS id", "o_orderstatus AS kind")
_CUSTOMERS = derived("customer", "c_custkey + 100 AS c_custkey", "c_custkey AS id", "c_mktsegment AS kind", "c_acctbal")
_JOINED = "SELECT coalesce(l.cust, r.c_custkey) AS cust, l.id AS id_x, l.kind AS kind_x, r.id AS id_y, r.kind AS kind_y, c_acctbal"


def _merge(t: Tables, how: str, **options):
    return merge_pair(_ORDERS.frame(t), _CUSTOMERS.frame(t), "cust", "c_custkey", how, **options)


def _join_sql(how: str) -> str:
    return f"{_JOINED} FROM {_ORDERS.sql} l {how} JOIN {_CUSTOMERS.sql} r ON l.cust = r.c_custkey"


@query(_join_sql("INNER"))
def merged_inner(t: Tables):
    return _merge(t, "inner")


@query(_join_sql("LEFT"))
def merged_left(t: Tables):
    return _merge(t, "left", unique2=True)


@query(_join_sql("RIGHT"))
def merged_right(t: Tables):
    return _merge(t, "right", unique2=True)


@query(_join_sql("FULL"))
def merged_outer(t: Tables):
    return _merge(t, "outer", unique2=True)


@query(
    f"{_JOINED} FROM {_ORDERS.sql} l FULL JOIN (SELECT CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE c_custkey END"
    f" AS c_custkey, id, kind, c_acctbal FROM {_CUSTOMERS.sql}) r"
    " ON l.cust = r.c_custkey"
)
def merged_outer_many_to_many(t: Tables):
    right = _CUSTOMERS.frame(t).withColumn("c_custkey", F.expr("CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE c_custkey END"))
    return merge_pair(_ORDERS.frame(t), right, "cust", "c_custkey", "outer")


@query(
    "SELECT coalesce(l.k, r.k) AS k, l.v AS v_x, r.v AS v_y FROM"
    " (SELECT CASE WHEN n_nationkey > 0 THEN n_nationkey END AS k, n_name AS v FROM nation) l FULL JOIN"
    " (SELECT CASE WHEN c_custkey > 5 THEN c_custkey END AS k, c_name AS v FROM customer) r"
    " ON l.k IS NOT DISTINCT FROM r.k"
)
def merged_null_safe(t: Tables):
    left = t("nation").selectExpr("CASE WHEN n_nationkey > 0 THEN n_nationkey END AS k", "n_name AS v")
    right = t("customer").selectExpr("CASE WHEN c_custkey > 5 THEN c_custkey END AS k", "c_name AS v")
    return merge_pair(left, right, "k", "k", "outer", null_safe=True)


@query(
    "SELECT coalesce(l.doc_id, r.doc_id) AS doc_id, coalesce(l.lang, r.lang) AS lang, r.quality FROM"
    " (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN lang END AS lang FROM documents) l FULL JOIN"
    " (SELECT doc_id, quality, 'xx' AS lang FROM labels) r ON l.doc_id = r.doc_id"
)
def coalesced_records(t: Tables):
    left = t("documents").selectExpr("doc_id", "CASE WHEN doc_id % 2 = 0 THEN lang END AS lang")
    right = t("labels").selectExpr("doc_id", "quality", "'xx' AS lang")
    return coalesced_merge(left, right, "doc_id", "doc_id")


# Which join fits depends on the data, but without null keys all of them give
# the rows of the full one.
_CHAIN = (
    "SELECT o_orderkey, coalesce(o_custkey, c_custkey) AS o_custkey, o_orderstatus, o_totalprice, c_name,"
    " coalesce(c_nationkey, n_nationkey) AS c_nationkey, c_mktsegment, n_name, n_regionkey FROM orders"
    " FULL JOIN customer ON o_custkey = c_custkey FULL JOIN nation ON c_nationkey = n_nationkey"
)
_CHAIN_COLUMNS = (
    "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "c_name", "c_nationkey",
    "c_mktsegment", "n_name", "n_regionkey",
)


def _chain(t: Tables):
    return [
        t("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"),
        t("customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment"),
        t("nation"),
    ]


@query(_CHAIN)
def merged_chain(t: Tables):
    return merge_many(_chain(t))


@query(_CHAIN)
def merged_chain_with_given_keys(t: Tables):
    return merge_many(_chain(t), keys=[("o_custkey", "c_custkey"), ("c_nationkey", "n_nationkey")])


@query(_CHAIN)
def merged_and_recleaned(t: Tables):
    return merge_and_reclean(_chain(t)).rebuild().select(*_CHAIN_COLUMNS)


@query(
    "SELECT 'labels in documents' AS what, NOT EXISTS (SELECT 1 FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)) AS held"
    " UNION ALL SELECT 'documents in labels', NOT EXISTS (SELECT 1 FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels))"
    " UNION ALL SELECT 'lines in orders', NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders))"
)
def memberships(t: Tables):
    labels, documents = t("labels"), t("documents")
    rows = [
        ("labels in documents", value_membership(labels, "doc_id", documents, "doc_id")),
        ("documents in labels", value_membership(documents, "doc_id", labels, "doc_id")),
        ("lines in orders", value_membership(t("lineitem"), "l_orderkey", t("orders"), "o_orderkey")),
    ]
    return t.spark.createDataFrame(rows, "what string, held boolean")


@query("SELECT l_orderkey AS key FROM lineitem INTERSECT SELECT o_custkey FROM orders")
def values_in_both(t: Tables):
    both = common_values(t("lineitem"), "l_orderkey", t("orders"), "o_custkey")
    return both.select(F.col("value").cast("bigint").alias("key"))


@query(
    "SELECT doc_id, lang, source, NULL AS page_id, NULL AS url FROM documents"
    " UNION ALL SELECT NULL, NULL, 'web', page_id, url FROM pages"
)
def rows_of_both_tables(t: Tables):
    documents = t("documents").select("doc_id", "lang", "source")
    pages = t("pages").select("page_id", "url", F.lit("web").alias("source"))
    return union_by_name([documents, pages])


_CLEANED = [c for c in ORDERS_GAPS_COLUMNS if c not in ("rare", "never")]


@query(f"SELECT {', '.join(_CLEANED)} FROM {ORDERS_GAPS.sql}")
def cleaned_orders(t: Tables):
    return clean_table(ORDERS_GAPS.frame(t)).star.rebuild()


@query("SELECT * FROM lineitem")
def cleaned_lineitem(t: Tables):
    return clean_table(t("lineitem")).star.rebuild()


@query(
    "SELECT 'fact' AS part, count(*) AS n FROM customer UNION ALL"
    " SELECT 'lookup of nation', count(DISTINCT c_nationkey) FROM customer"
)
def cleaned_sizes(t: Tables):
    frame = t("customer").join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    star = clean_table(frame.select("c_custkey", "c_nationkey", "n_name", "n_regionkey")).star
    fact = star.fact.agg(F.lit("fact").alias("part"), F.count(F.lit(1)).alias("n"))
    lookup = star.lookups["c_nationkey"].agg(
        F.lit("lookup of nation").alias("part"), F.count(F.lit(1)).alias("n")
    )
    return fact.unionAll(lookup)


@query(_CHAIN)
def merged_from_files(t: Tables):
    paths = []
    for frame in _chain(t):
        paths.append(scratch_path(t.spark, "merge-input"))
        write_tsv(frame, paths[-1])
    merged = merge_tables(t.spark, paths, scratch_path(t.spark, "merge-output"))
    types = dict(o_orderkey="bigint", o_custkey="bigint")
    return merged.star.rebuild().select(*_CHAIN_COLUMNS).withColumns(
        {name: F.col(name).cast(kind) for name, kind in types.items()}
    )


@query(_CHAIN)
def merged_then_cleaned(t: Tables):
    return aggregate_and_process(_chain(t)).star.rebuild().select(*_CHAIN_COLUMNS)


@query(
    f"SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag, l_flag_far FROM {LINEITEM_COPIES.sql}"
)
def slimmed_lineitem(t: Tables):
    return slim_table(LINEITEM_COPIES.frame(t), scratch_path(t.spark, "slim")).table


@query(
    "SELECT 'orders' AS table_name, count(*) AS n_keys FROM (SELECT 1 FROM orders"
    " HAVING count(DISTINCT o_orderkey) = count(*))"
)
def unique_keys_used(t: Tables):
    keys = primary_key_candidates(t("orders").select("o_orderkey", "o_custkey"))
    return t.spark.createDataFrame([("orders", len(keys))], "table_name string, n_keys bigint")
