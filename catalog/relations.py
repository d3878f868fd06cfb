"""Columns that determine each other, lookups, rankings and batches."""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import functions as F

from catalog.registry import DENORMAL_COLUMNS, DENORMAL_SQL, Tables, denormal, derived, query
from tablewright.operators.overlap import value_set_equal_pairs
from tablewright.operators.ranking import (
    pending_ids,
    plan_batches,
    preview,
    prioritize_studies,
    with_row_number,
)
from tablewright.operators.relations import (
    bijective_mapping,
    column_relationships,
    lookup_table,
    positional_mapping,
    star_schema,
)

_PERMUTED = derived(
    "nation",
    "n_nationkey",
    "(n_nationkey + 7) % 25 AS shifted",
    "n_nationkey * 1.0 AS wide",
    "n_regionkey",
    "n_regionkey + 0 AS region_again",
    "n_name",
)
_PERMUTED_NUMBERS = ("n_nationkey", "shifted", "wide", "n_regionkey", "region_again")


def _equal_sets_sql(source: str, columns) -> str:
    parts = []
    for i, a in enumerate(columns):
        for b in columns[i + 1 :]:
            parts.append(
                f"SELECT '{a}' AS col1, '{b}' AS col2, (SELECT count(DISTINCT {a}) FROM {source}) AS ndv"
                f" WHERE NOT EXISTS (SELECT {a} FROM {source} WHERE {a} IS NOT NULL"
                f" AND {a} NOT IN (SELECT {b} FROM {source} WHERE {b} IS NOT NULL))"
                f" AND NOT EXISTS (SELECT {b} FROM {source} WHERE {b} IS NOT NULL"
                f" AND {b} NOT IN (SELECT {a} FROM {source} WHERE {a} IS NOT NULL))"
            )
    return " UNION ALL ".join(parts)


@query(_equal_sets_sql(_PERMUTED.sql, _PERMUTED_NUMBERS))
def equal_value_sets(t: Tables):
    return value_set_equal_pairs(_PERMUTED.frame(t))


_ORDER_SETS = derived(
    "orders",
    "o_orderkey",
    "o_custkey",
    "o_orderkey AS o_key_again",
    "CASE WHEN o_orderkey % 2 = 0 THEN NULL ELSE o_custkey END AS o_cust_half",
    "o_custkey * 1.0 AS o_cust_wide",
)


@query(
    _equal_sets_sql(
        _ORDER_SETS.sql, ("o_orderkey", "o_custkey", "o_key_again", "o_cust_half", "o_cust_wide")
    )
)
def equal_value_sets_of_orders(t: Tables):
    return value_set_equal_pairs(_ORDER_SETS.frame(t))


def relation_sql(source: str, columns, text=()) -> str:
    """Every ordered pair, by counting distinct values on rows where both are present."""
    parts = []
    for a, b in permutations(columns, 2):
        same = f"count_if({a} = {b})" if (a in text) == (b in text) else "0"
        both = f"{a} IS NOT NULL AND {b} IS NOT NULL"
        parts.append(
            f"SELECT '{a}' AS col_a, '{b}' AS col_b, {same} AS same, count(*) AS n,"
            f" count(DISTINCT CASE WHEN {both} THEN {a} END) AS na,"
            f" count(DISTINCT CASE WHEN {both} THEN {b} END) AS nb,"
            f" count(DISTINCT CASE WHEN {both} THEN concat({a}, '|', {b}) END) AS nab FROM {source}"
        )
    return (
        "SELECT col_a, col_b, na > 0 AND nab = na AS determines,"
        " CASE WHEN same = n THEN 'identical' WHEN na = 0 OR nab <> na THEN 'none'"
        " WHEN nab = nb THEN 'bijective' ELSE 'surjective' END AS kind"
        f" FROM ({' UNION ALL '.join(parts)})"
    )


@query(relation_sql("nation", ("n_nationkey", "n_name", "n_regionkey"), {"n_name"}))
def relations_of_nation(t: Tables):
    return column_relationships(t("nation"))


@query(
    relation_sql(
        "part",
        ("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"),
        {"p_name", "p_brand", "p_type"},
    )
)
def relations_of_part(t: Tables):
    return column_relationships(t("part"))


@query(
    relation_sql(DENORMAL_SQL, DENORMAL_COLUMNS, {"o_orderstatus", "o_orderpriority", "c_name", "c_mktsegment", "n_name"})
)
def relations_of_denormal(t: Tables):
    return column_relationships(denormal(t))


_GAPPY = derived(
    "orders",
    "o_custkey",
    "CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_custkey % 50 END AS fifty",
    "CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_custkey % 10 END AS ten",
    "CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE -1 * (o_custkey % 50) END AS minus_fifty",
    "CASE WHEN o_orderkey < 0 THEN 1 END AS never",
)
_GAPPY_COLUMNS = ("o_custkey", "fifty", "ten", "minus_fifty", "never")


@query(relation_sql(_GAPPY.sql, _GAPPY_COLUMNS))
def relations_with_nulls(t: Tables):
    return column_relationships(_GAPPY.frame(t))


@query(
    "SELECT a.rank, a.v AS l_partkey, b.v AS l_suppkey FROM"
    " (SELECT v, row_number() OVER (ORDER BY first, v) AS rank FROM (SELECT l_partkey AS v,"
    "  min(l_orderkey * 10 + l_linenumber) AS first FROM lineitem GROUP BY 1)) a JOIN"
    " (SELECT v, row_number() OVER (ORDER BY first, v) AS rank FROM (SELECT l_suppkey AS v,"
    "  min(l_orderkey * 10 + l_linenumber) AS first FROM lineitem GROUP BY 1)) b ON a.rank = b.rank"
)
def values_paired_by_position(t: Tables):
    lines = t("lineitem").withColumn("place", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    return positional_mapping(lines, "l_partkey", "l_suppkey", "place")


@query(f"SELECT DISTINCT c_nationkey, n_name FROM {DENORMAL_SQL} WHERE c_nationkey IS NOT NULL AND n_name IS NOT NULL")
def one_to_one_mapping(t: Tables):
    return bijective_mapping(denormal(t), "c_nationkey", "n_name")


@query(f"SELECT DISTINCT c_custkey, c_name FROM {DENORMAL_SQL}")
def customer_lookup(t: Tables):
    return lookup_table(denormal(t), "c_custkey", "c_name").lookup


@query(f"SELECT {', '.join(c for c in DENORMAL_COLUMNS if c != 'c_name')} FROM {DENORMAL_SQL}")
def table_beside_lookup(t: Tables):
    return lookup_table(denormal(t), "c_custkey", "c_name").table


@query(f"SELECT {', '.join(DENORMAL_COLUMNS)} FROM {DENORMAL_SQL}")
def star_schema_rebuilt(t: Tables):
    return star_schema(denormal(t)).rebuild()


@query(f"SELECT {', '.join(_GAPPY_COLUMNS)} FROM {_GAPPY.sql}")
def star_schema_with_nulls_rebuilt(t: Tables):
    return star_schema(_GAPPY.frame(t)).rebuild()


@query("SELECT * FROM orders ORDER BY o_orderkey LIMIT 5")
def first_orders(t: Tables):
    return preview(t("orders"), 5, ["o_orderkey"])


_GAPPY_TALK = derived(
    "conversations",
    "conv_id",
    "turn",
    "CASE WHEN turn % 3 = 0 THEN NULL ELSE role END AS role",
    "CASE WHEN conv_id % 4 = 0 AND turn % 2 = 0 THEN '' ELSE text END AS text",
)
_SCORES = (
    "SELECT conv_id AS study, count(*) AS n_records, (count(turn) + count(role) + count(nullif(text, '')))"
    f" / (count(*) * 3.0) AS score FROM {_GAPPY_TALK.sql} GROUP BY conv_id"
)


@query(
    "SELECT row_number() OVER (ORDER BY score DESC, n_records DESC, study) AS rank, study, n_records,"
    f" round(score, 9) AS score FROM ({_SCORES}) ORDER BY score DESC, n_records DESC, study LIMIT 20"
)
def best_studies(t: Tables):
    best = prioritize_studies(_GAPPY_TALK.frame(t), "conv_id", 20)
    return best.select(F.col("rank").cast("bigint").alias("rank"), "study", "n_records", F.round("score", 9).alias("score"))


@query(
    "SELECT row_number() OVER (ORDER BY score DESC, n_records DESC, study) AS rank, study, n_records,"
    " round(score, 9) AS score FROM (SELECT source AS study, count(*) AS n_records,"
    " (2 * count(text) + count(CASE WHEN n_chars % 3 <> 0 THEN lang END)) / (count(*) * 3.0) AS score"
    " FROM documents GROUP BY source)"
)
def all_studies_weighted(t: Tables):
    documents = t("documents").selectExpr(
        "source", "text", "CASE WHEN n_chars % 3 <> 0 THEN lang END AS lang"
    )
    ranked = prioritize_studies(documents, "source", weights={"text": 2, "lang": 1})
    return ranked.withColumn("score", F.round("score", 9))


@query(
    "SELECT db, id, (rn - 1) // 7 AS batch, (rn - 1) // 7 // 3 AS cycle FROM"
    " (SELECT lang AS db, doc_id AS id, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS rn FROM documents)"
)
def batches_and_cycles(t: Tables):
    ids = t("documents").select(F.col("lang").alias("db"), F.col("doc_id").alias("id"))
    return plan_batches(ids, 7, 3, order_by=["id"])


@query(
    "SELECT 'documents' AS db, doc_id AS id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)"
)
def ids_still_to_fetch(t: Tables):
    requested = t("documents").select(F.lit("documents").alias("db"), F.col("doc_id").alias("id"))
    landed = t("labels").select(F.lit("documents").alias("db"), F.col("doc_id").alias("id"))
    return pending_ids(requested, landed)


@query(
    "SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS overall FROM orders"
)
def numbered_orders(t: Tables):
    return with_row_number(
        t("orders").select("o_orderkey", "o_totalprice"), ["o_totalprice", "o_orderkey"], name="overall"
    ).select("o_orderkey", "overall")
