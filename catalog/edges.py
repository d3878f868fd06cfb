"""Legal but awkward input: nulls and NaN in keys, breaks in cells, broken and nested XML."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import DENORMAL_SQL, EVENTS_BROKEN, Tables, denormal, derived, query
from tablewright.operators.joins import map_column, merge_many, merge_pair
from tablewright.operators.overlap import key_match_percentages
from tablewright.operators.ranking import plan_batches
from tablewright.operators.relations import star_schema
from tablewright.operators.schema_ops import drop_columns
from tablewright.operators.xml_ops import (
    flatten_xml_columns,
    malformed_fragments,
    nested_xml_columns,
    xml_fragment_to_long,
)
from tablewright.plans.flows import clean_table, flatten_folder, merge_tables
from tablewright.session import scratch_path, spread
from tablewright.sources import read_id_list, read_text_table, read_typed_csv, write_csv, write_tsv
from tablewright.streaming import stream_flatten

_NULL_KEYS = derived(
    "orders", "o_orderkey", "CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_custkey END AS cust"
)
_PARTNERS = f"(SELECT DISTINCT cust AS ck, 'c' || CAST(cust AS VARCHAR(20)) AS label FROM {_NULL_KEYS.sql} WHERE cust IS NOT NULL)"


@query(
    f"SELECT o_orderkey, coalesce(cust, ck) AS cust, label FROM {_NULL_KEYS.sql} FULL JOIN {_PARTNERS} ON cust = ck"
)
def merged_with_null_keys_and_equal_sets(t: Tables):
    left = _NULL_KEYS.frame(t)
    right = left.where("cust IS NOT NULL").selectExpr("cust AS ck", "'c' || CAST(cust AS STRING) AS label").distinct()
    return merge_many([left, right], keys=[("cust", "ck")])


@query(
    f"SELECT o_orderkey, coalesce(cust, c_custkey) AS cust, c_name FROM {_NULL_KEYS.sql} FULL JOIN customer ON cust = c_custkey"
)
def merged_with_null_keys_and_subset(t: Tables):
    return merge_many([_NULL_KEYS.frame(t), t("customer").select("c_custkey", "c_name")])


# Keys of which only some have a partner on the other side.
_SHIFTED_ORDERS = derived(
    "orders", "o_orderkey", "CASE WHEN o_custkey % 2 = 0 THEN o_custkey ELSE -o_custkey END AS o_custkey"
)
_SHIFTED_CUSTOMERS = derived(
    "customer", "CASE WHEN c_custkey % 3 = 0 THEN c_custkey ELSE 1000000000 + c_custkey END AS c_custkey", "c_name", "c_nationkey"
)


@query(
    "SELECT o_orderkey, coalesce(o_custkey, c_custkey) AS o_custkey, c_name,"
    " coalesce(c_nationkey, n_nationkey) AS c_nationkey, n_name FROM"
    f" {_SHIFTED_ORDERS.sql} FULL JOIN {_SHIFTED_CUSTOMERS.sql} ON o_custkey = c_custkey"
    " FULL JOIN (SELECT n_nationkey, n_name FROM nation) ON c_nationkey = n_nationkey"
)
def merged_twice_with_gaps(t: Tables):
    tables = [_SHIFTED_ORDERS.frame(t), _SHIFTED_CUSTOMERS.frame(t), t("nation").select("n_nationkey", "n_name")]
    return merge_many(tables, keys=[("o_custkey", "c_custkey"), ("c_nationkey", "n_nationkey")])


@query(
    "SELECT o_orderkey, o_custkey, c_name, c_nationkey, n_name FROM orders LEFT JOIN customer ON o_custkey = c_custkey"
    " LEFT JOIN (SELECT n_nationkey AS c_nationkey, n_name FROM nation) USING (c_nationkey)"
    " UNION ALL SELECT NULL, c_custkey, c_name, c_nationkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey"
    " WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)"
    " UNION ALL SELECT NULL, NULL, NULL, n_nationkey, n_name FROM nation WHERE n_nationkey NOT IN (SELECT c_nationkey FROM customer)"
)
def merged_with_an_empty_table(t: Tables):
    """Tables without rows stand first and in between: what has rows comes out whole."""
    orders = t("orders").select("o_orderkey", "o_custkey")
    customers = t("customer").select("c_custkey", "c_name", "c_nationkey")
    nothing = orders.where("o_orderkey < 0")
    tables = [nothing, orders, nothing.select("o_orderkey"), customers, t("nation").select("n_nationkey", "n_name")]
    return merge_many(tables, coalesce=True)


def _match_sql(a: str, b: str, source: str) -> str:
    values = f"SELECT DISTINCT CAST({{}} AS DOUBLE) AS v FROM {source}"
    left, right = values.format(a), values.format(b)
    return (
        f"SELECT '{a}' AS key1, '{b}' AS key2, (SELECT count(*) FROM ({left})) AS ndv1, (SELECT count(*) FROM ({right})) AS ndv2,"
        f" (SELECT count(*) FROM ({left}) JOIN ({right}) USING (v)) AS common"
    )


# The same numbers as decimals of several scales, doubles and whole numbers.
_DECIMALS = derived(
    "lineitem", "CAST(l_discount AS DECIMAL(12,2)) AS narrow", "CAST(l_extendedprice AS DECIMAL(18,4)) AS wide",
    "CAST(l_discount AS DOUBLE) AS discount", "CAST(l_tax AS DOUBLE) AS tax", "CAST(l_extendedprice AS DOUBLE) AS price",
    "CAST(l_quantity AS BIGINT) AS quantity",
)


@query(
    "SELECT *, 100.0 * common / nullif(ndv1, 0) AS pct_of_1, 100.0 * common / nullif(ndv2, 0) AS pct_of_2 FROM ("
    + " UNION ALL ".join(
        _match_sql(a, b, _DECIMALS.sql) for a in ("narrow", "wide", "quantity") for b in ("discount", "tax", "price", "narrow")
    )
    + ")"
)
def key_matches_of_decimals(t: Tables):
    df = _DECIMALS.frame(t)
    return key_match_percentages(df, ["narrow", "wide", "quantity"], df, ["discount", "tax", "price", "narrow"])


_NAN_LEFT = derived(
    "orders", "o_orderkey",
    "CASE WHEN o_orderkey % 5 = 0 THEN CAST('NaN' AS DOUBLE) ELSE CAST(o_custkey AS DOUBLE) END AS cust",
)
_NAN_RIGHT = derived(
    "customer", "c_name",
    "CASE WHEN c_custkey % 7 = 0 THEN CAST('NaN' AS DOUBLE) ELSE CAST(c_custkey AS DOUBLE) END AS ck",
)


@query(
    f"SELECT o_orderkey, coalesce(cust, ck) AS cust, c_name FROM {_NAN_LEFT.sql}"
    f" FULL JOIN {_NAN_RIGHT.sql} ON cust = ck AND NOT isnan(cust)"
)
def merged_with_nan_keys(t: Tables):
    return merge_pair(_NAN_LEFT.frame(t), _NAN_RIGHT.frame(t), "cust", "ck", "outer")


_NAN_AND_NULL = derived(
    "lineitem", "l_orderkey", "l_linenumber", "l_returnflag",
    "CASE WHEN l_returnflag = 'A' THEN 1.5e0 WHEN l_returnflag = 'R' THEN 2.5e0"
    " WHEN l_orderkey % 2 = 0 THEN CAST('NaN' AS DOUBLE) END AS x",
)


@query(
    "SELECT l_orderkey, l_linenumber, l_returnflag, coalesce(isnan(x), false) AS is_nan,"
    f" CASE WHEN NOT isnan(x) THEN x END AS x FROM {_NAN_AND_NULL.sql}"
)
def star_schema_with_nan_rebuilt(t: Tables):
    table = star_schema(_NAN_AND_NULL.frame(t)).rebuild()
    is_nan = F.coalesce(F.isnan("x"), F.lit(False))
    return table.select("l_orderkey", "l_linenumber", "l_returnflag", is_nan.alias("is_nan"), F.when(~is_nan, F.col("x")).alias("x"))


def _parts(t: Tables, star):
    """What a star consists of: columns of the fact table, and rows of each lookup by column."""
    parts = t.spark.createDataFrame([("fact", c, None) for c in star.fact.columns], "keeper string, name string, n long")
    for keeper, lookup in star.lookups.items():
        counted = lookup.agg(F.count(F.lit(1)).alias("n"))
        for name in lookup.columns:
            if name != keeper:
                parts = parts.unionAll(counted.select(F.lit(keeper).alias("keeper"), F.lit(name).alias("name"), "n"))
    return parts


_STAR_PARTS = (
    "SELECT 'fact' AS keeper, unnest(['o_orderkey', 'o_custkey', 'o_orderstatus', 'o_orderpriority']) AS name, NULL AS n"
    " UNION ALL SELECT 'o_custkey', unnest(['c_custkey', 'c_name', 'c_nationkey', 'c_mktsegment']),"
    f" (SELECT count(DISTINCT o_custkey) FROM {DENORMAL_SQL})"
    " UNION ALL SELECT 'c_nationkey', unnest(['n_nationkey', 'n_name', 'n_regionkey']),"
    f" (SELECT count(DISTINCT c_nationkey) FROM {DENORMAL_SQL})"
)


@query(_STAR_PARTS)
def star_schema_parts(t: Tables):
    return _parts(t, star_schema(denormal(t)))


# The exact copies of a key are dropped before anything is split off.
_CLEAN_PARTS = _STAR_PARTS.replace("'c_custkey', ", "").replace("'n_nationkey', ", "")


@query(_CLEAN_PARTS)
def cleaned_parts(t: Tables):
    return _parts(t, clean_table(denormal(t)).star)


@query("SELECT CAST(doc_id AS VARCHAR) AS doc_id, text FROM documents")
def texts_with_breaks_through_tsv(t: Tables):
    path = scratch_path(t.spark, "texts")
    write_tsv(t("documents").select("doc_id", "text"), path)
    return read_text_table(t.spark, path)


@query("SELECT doc_id, text FROM documents")
def texts_with_breaks_through_csv(t: Tables):
    path = scratch_path(t.spark, "texts")
    write_csv(t("documents").select("doc_id", "text"), path)
    return read_typed_csv(t.spark, path).withColumn("doc_id", F.col("doc_id").cast("bigint"))


@query(
    "SELECT o_orderkey, d.doc_id AS doc_id, text FROM (SELECT o_orderkey, o_orderkey AS doc_id FROM orders) o"
    " FULL JOIN documents d ON o.doc_id = d.doc_id WHERE d.doc_id IS NOT NULL"
)
def texts_with_breaks_merged_from_files(t: Tables):
    paths = [scratch_path(t.spark, "texts") for _ in range(2)]
    write_tsv(t("documents").select("doc_id", "text"), paths[0])
    write_tsv(t("orders").selectExpr("o_orderkey AS doc_id_of_order", "o_orderkey"), paths[1])
    merged = merge_tables(t.spark, paths, keys=[("doc_id", "doc_id_of_order")]).table
    return merged.join(t("documents").select(F.col("doc_id").alias("known")), F.col("doc_id") == F.col("known"), "left_semi").select(
        F.col("o_orderkey").cast("bigint").alias("o_orderkey"), F.col("doc_id").cast("bigint").alias("doc_id"), "text"
    )


def _awkward(t: Tables):
    # spelt in both engines' own way: backslashes differ in string literals
    url, n = F.col("url"), F.col("page_id")
    value = (
        F.when(n % 6 == 0, F.concat(url, F.lit(" x, y")))
        .when(n % 6 == 1, F.concat(F.lit("["), url, F.lit("]")))
        .when(n % 6 == 2, F.concat(F.lit("é\\ "), url))
        .when(n % 6 == 3, F.concat(F.lit('"'), url, F.lit('"')))
        .when(n % 6 == 4, F.concat(url, F.lit('",')))
        .otherwise(F.concat(F.lit("[]"), n.cast("string")))
    )
    return t("pages").select("page_id", value.alias("id"))


_AWKWARD_SQL = (
    "CASE page_id % 6 WHEN 0 THEN url || ' x, y' WHEN 1 THEN '[' || url || ']' WHEN 2 THEN 'é' || chr(92) || ' ' || url"
    " WHEN 3 THEN '\"' || url || '\"' WHEN 4 THEN url || '\",' ELSE '[]' || page_id END"
)


def _id_arrays(t: Tables, ids):
    path = scratch_path(t.spark, "awkward-ids")
    named = ids.select(F.lit("pages").alias("db"), "id")
    arrays = plan_batches(named, 20, 10, order_by=["id"]).groupBy("batch").agg(
        F.to_json(F.collect_list("id")).alias("value")
    )
    arrays.repartition(2).select("value").write.text(f"{path}/pages")
    return read_id_list(t.spark, f"{path}/pages")


@query(f"SELECT 'pages' AS db, {_AWKWARD_SQL} AS id FROM pages")
def id_list_with_any_characters(t: Tables):
    return _id_arrays(t, _awkward(t))


@query(f"SELECT 'pages' AS db, CASE WHEN page_id % 6 = 4 THEN 'id ' || page_id ELSE {_AWKWARD_SQL} END AS id FROM pages")
def id_list_split_between_ids(t: Tables):
    # without IDs that look like a break between two, lists are read piece by piece
    plain = F.when(F.col("page_id") % 6 == 4, F.concat(F.lit("id "), "page_id")).otherwise(F.col("id"))
    return _id_arrays(t, _awkward(t).withColumn("id", plain))


@query(
    "SELECT c_custkey, CASE WHEN c_custkey % 4 <> 0 THEN c_nationkey END AS c_nationkey, 'int' AS kind FROM customer"
)
def typed_csv_with_missing_tokens(t: Tables):
    path = scratch_path(t.spark, "typed")
    nation = F.when(F.col("c_custkey") % 4 == 0, "NA").otherwise(F.col("c_nationkey").cast("string"))
    write_csv(t("customer").select("c_custkey", nation.alias("c_nationkey")), path)
    table = read_typed_csv(t.spark, path)
    return table.select(
        F.col("c_custkey").cast("bigint").alias("c_custkey"), F.col("c_nationkey").alias("c_nationkey"),
        F.typeof("c_nationkey").alias("kind"),
    )


@query(
    "SELECT c_custkey, coalesce(k, n_nationkey) AS c_nationkey, n_name FROM"
    " (SELECT c_custkey, CASE WHEN c_custkey % 4 <> 0 THEN c_nationkey END AS k FROM customer)"
    " FULL JOIN nation ON k = n_nationkey"
)
def merged_over_missing_tokens(t: Tables):
    paths = [scratch_path(t.spark, "typed") for _ in range(2)]
    nation = F.when(F.col("c_custkey") % 4 == 0, "NA").otherwise(F.col("c_nationkey").cast("string"))
    write_tsv(t("customer").select("c_custkey", nation.alias("c_nationkey")), paths[0])
    write_tsv(t("nation").select("n_nationkey", "n_name"), paths[1])
    merged = merge_tables(t.spark, paths, keys=[("c_nationkey", "n_nationkey")]).table
    return merged.select(*[F.col(c).cast("bigint").alias(c) for c in ("c_custkey", "c_nationkey")], "n_name")


@query(
    "SELECT CAST(event_id AS VARCHAR) AS event_id, '0' || user_id AS item, event_type AS kind FROM events"
)
def folder_flattened_by_default(t: Tables):
    path = scratch_path(t.spark, "dumps")
    xml = F.concat(F.lit("<Item>0"), "user_id", F.lit("</Item><Kind>"), "event_type", F.lit("</Kind>"))
    write_csv(t("events").select("event_id", F.lit("gone").alias("Item"), xml.alias("InfoXml")), path)
    return flatten_folder(t.spark, path, suffix=".csv")


@query("SELECT event_id, event_type AS item FROM events")
def columns_dropped_by_exact_name(t: Tables):
    frame = t("events").select("event_id", F.col("event_type").alias("item"), "user_id")
    return drop_columns(frame, ["Item", "EVENT_ID", "user_id"])


_SCRIPT = derived(
    "events", "event_id",
    "'<Script>a<Id>' || CAST(user_id AS VARCHAR(20)) || '</Id><Title>' || event_type AS InfoXml",
)


@query(
    "SELECT event_id, InfoXml, '<Script>a<Id>' || user_id || '</Id><Title>' || event_type || '</Title></Script>' AS repaired"
    f" FROM {_SCRIPT.sql} JOIN (SELECT event_id AS e, user_id, event_type FROM events) ON event_id = e"
)
def repaired_with_content_and_case(t: Tables):
    return malformed_fragments(_SCRIPT.frame(t), "event_id", "InfoXml")


@query(
    "SELECT event_id, 'item' AS key, 0 AS pos, 'v' || user_id AS value FROM events"
    " UNION ALL SELECT event_id, 'item@type', 0, event_type FROM events"
)
def malformed_xml_in_long_form(t: Tables):
    return xml_fragment_to_long(EVENTS_BROKEN.frame(t), "event_id", "InfoXml")


_BROKEN_LINES = derived(
    "events", "event_id",
    "'<Item type=\"' || event_type || '\">v' || chr(10) || CAST(user_id AS VARCHAR(20))"
    " || CASE WHEN event_id % 10 = 0 THEN '' ELSE '</Item>' END AS InfoXml",
)


@query(
    "SELECT CAST(event_id AS VARCHAR) AS event_id, 'v' || chr(10) || user_id AS item, lower(event_type) AS \"item@type\" FROM events"
)
def streamed_with_breaks_and_repair(t: Tables):
    path, out = scratch_path(t.spark, "stream-in"), scratch_path(t.spark, "stream-out")
    write_csv(spread(_BROKEN_LINES.frame(t)), path)
    state = scratch_path(t.spark, "stream-state")
    keys = ["item", "item@type"]
    run = stream_flatten(
        t.spark, path, "event_id string, InfoXml string", out, state, keys, id="event_id", suffix=".csv"
    )
    run.awaitTermination()
    return t.spark.read.parquet(out)


# Fragments cut off within an end tag, a start tag, the value of an attribute, or not at all.
_TRUNCATED = derived(
    "events", "event_id",
    "'<Item>v' || CAST(user_id AS VARCHAR(20)) || CASE event_id % 4 WHEN 0 THEN '</Item' WHEN 1 THEN '</Item><Tag n=\"1\"'"
    " WHEN 2 THEN '</Item><Tag n=\"1' ELSE '</Item>' END AS InfoXml",
)


@query("SELECT event_id, 'v' || user_id AS item FROM events")
def truncated_xml_flattened(t: Tables):
    return flatten_xml_columns(_TRUNCATED.frame(t))


@query(
    "SELECT event_id, 'v' || user_id AS Item, 'v' || user_id AS item_2, event_type AS s_kind, '1' AS s_kind_2 FROM events"
)
def nested_xml_with_clashing_names(t: Tables):
    """Elements named like a plain column but for its case, and like each other once they are flat."""
    info = "concat('<ITEM>v', user_id, '</ITEM><S><Kind>', event_type, '</Kind></S><s_kind>1</s_kind>')"
    frame = t("events").selectExpr("event_id", "concat('v', user_id) AS Item", f"{info} AS InfoXml")
    return nested_xml_columns(frame, "InfoXml")


_NESTED = derived(
    "events", "event_id",
    "CASE WHEN event_id % 5 = 0 THEN NULL ELSE '<S a=\"1\"><T>x' || CAST(user_id AS VARCHAR(20)) || '</T><U><V>'"
    " || event_type || '</V><W>w</W></U></S>' END AS InfoXml",
)


@query(
    "SELECT event_id, CASE WHEN event_id % 5 <> 0 THEN '1' END AS \"s@a\","
    " CASE WHEN event_id % 5 <> 0 THEN 'x' || user_id END AS s_t,"
    " CASE WHEN event_id % 5 <> 0 THEN event_type END AS s_u_v, CASE WHEN event_id % 5 <> 0 THEN 'w' END AS s_u_w FROM events"
)
def nested_xml_flattened(t: Tables):
    return nested_xml_columns(_NESTED.frame(t), "InfoXml")


@query("SELECT c_custkey, c_nationkey, n_name AS nation FROM customer JOIN nation ON c_nationkey = n_nationkey")
def values_looked_up(t: Tables):
    frame = t("customer").select("c_custkey", "c_nationkey")
    return map_column(frame, "c_nationkey", t("nation"), "n_nationkey", "n_name", "nation")


@query(
    "SELECT 'n_nationkey' AS key1, 'r_regionkey' AS key2, 0 AS ndv1, count(DISTINCT r_regionkey) AS ndv2, 0 AS common,"
    " CAST(NULL AS DOUBLE) AS pct_of_1, 0.0 AS pct_of_2 FROM region"
)
def key_matches_of_an_empty_table(t: Tables):
    return key_match_percentages(t("nation").where("n_nationkey < 0"), ["n_nationkey"], t("region"), ["r_regionkey"])
