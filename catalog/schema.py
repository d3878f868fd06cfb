"""Names, nested columns and XML cells."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import EVENTS_BROKEN, EVENTS_XML, Tables, query
from tablewright.operators.profile import non_null_percentage
from tablewright.operators.schema_ops import (
    column_mapping,
    drop_columns,
    flatten_nested,
    replaced_names,
    select_pair,
    short_names,
    split_xml_columns,
    strip_common_name_prefixes,
)
from tablewright.operators.xml_ops import (
    flatten_xml_columns,
    malformed_fragments,
    repair_xml,
    xml_fragment_to_long,
)


@query(f"SELECT event_id, item FROM {EVENTS_XML.sql}")
def plain_columns(t: Tables):
    frame = EVENTS_XML.frame(t)
    plain, _ = split_xml_columns(frame)
    return frame.select(*plain)


@query(f"SELECT InfoXml, MoreXml FROM {EVENTS_XML.sql}")
def xml_columns(t: Tables):
    frame = EVENTS_XML.frame(t)
    _, xml = split_xml_columns(frame)
    return frame.select(*xml)


@query(
    "SELECT event_id, 'item' AS key, 0 AS pos, '0' || user_id AS value FROM events"
    " UNION ALL SELECT event_id, 'item@type', 0, event_type FROM events"
    " UNION ALL SELECT event_id, 'user', 0, '' || user_id FROM events"
)
def xml_in_long_form(t: Tables):
    return xml_fragment_to_long(EVENTS_XML.frame(t), "event_id", "InfoXml")


@query(
    "SELECT event_id, 'tag@n' AS key, 0 AS pos, '1' AS value FROM events WHERE event_id % 3 = 1"
    " UNION ALL SELECT event_id, 'tag@n', 1, '2' FROM events WHERE event_id % 3 = 1"
    " UNION ALL SELECT event_id, 'tag@n', 0, '9' FROM events WHERE event_id % 3 = 2"
    " UNION ALL SELECT event_id, 'tag', 0, 't' || event_id FROM events WHERE event_id % 3 = 2"
)
def xml_repeats_in_long_form(t: Tables):
    return xml_fragment_to_long(EVENTS_XML.frame(t), "event_id", "MoreXml")


@query(
    "SELECT event_id, '0' || user_id AS item, event_type AS \"item@type\", '' || user_id AS \"user\","
    " CASE WHEN event_id % 3 = 2 THEN 't' || event_id END AS tag,"
    " CASE event_id % 3 WHEN 1 THEN '1' WHEN 2 THEN '9' END AS \"tag@n\" FROM events"
)
def xml_flattened(t: Tables):
    return flatten_xml_columns(EVENTS_XML.frame(t), partitions=t.spark.sparkContext.defaultParallelism)


@query(
    "SELECT event_id, ['0' || user_id] AS item, [event_type] AS \"item@type\", ['' || user_id] AS \"user\","
    " CASE WHEN event_id % 3 = 2 THEN ['t' || event_id] END AS tag,"
    " CASE event_id % 3 WHEN 1 THEN ['1', '2'] WHEN 2 THEN ['9'] END AS \"tag@n\" FROM events"
)
def xml_flattened_with_repeats(t: Tables):
    return flatten_xml_columns(EVENTS_XML.frame(t), mode="all")


@query("SELECT event_id, 'v' || user_id AS item, event_type AS \"item@type\" FROM events")
def malformed_xml_flattened(t: Tables):
    return flatten_xml_columns(EVENTS_BROKEN.frame(t))


@query(
    "SELECT event_id, '<Item type=\"' || event_type || '\">v' || user_id || '</Item>' AS InfoXml FROM events"
)
def xml_repaired(t: Tables):
    return repair_xml(EVENTS_BROKEN.frame(t), "InfoXml")


@query(
    f"SELECT event_id, InfoXml, '<Item type=\"' || event_type || '\">v' || user_id || '</Item>' AS repaired FROM"
    f" (SELECT b.*, e.event_type, e.user_id FROM {EVENTS_BROKEN.sql} b JOIN events e USING (event_id))"
    " WHERE event_id % 10 = 0"
)
def malformed_xml(t: Tables):
    return malformed_fragments(EVENTS_BROKEN.frame(t), "event_id", "InfoXml")


@query(
    "SELECT conv_id, turn AS info_turn, role AS info_who_role, text AS info_who_text FROM conversations"
)
def nested_structs_flattened(t: Tables):
    nested = t("conversations").selectExpr(
        "conv_id", "named_struct('turn', turn, 'who', named_struct('role', role, 'text', text)) AS info"
    )
    return flatten_nested(nested)


@query(
    "SELECT vec_id, label, unnest(embedding) AS embedding FROM embeddings"
)
def arrays_exploded(t: Tables):
    return flatten_nested(t("embeddings"), arrays="explode")


@query("SELECT vec_id, label, embedding[1] AS embedding FROM embeddings")
def arrays_first_element(t: Tables):
    return flatten_nested(t("embeddings"), arrays="first")


@query(
    "SELECT doc_id, '[\"' || lang || '\",\"' || source || '\"]' AS tags FROM documents"
)
def arrays_as_json(t: Tables):
    return flatten_nested(t("documents").selectExpr("doc_id", "array(lang, source) AS tags"), arrays="json")


@query("SELECT event_id, ts, user_id, event_type, value FROM events")
def dropped_columns(t: Tables):
    return drop_columns(t("events"), ["props", "not_there"])


@query(
    "SELECT o_orderkey AS orderkey, o_custkey AS custkey, o_orderstatus AS orderstatus, o_totalprice AS totalprice,"
    " o_orderdate AS orderdate, o_orderpriority AS orderpriority FROM orders"
)
def shortened_names(t: Tables):
    return strip_common_name_prefixes(t("orders"))


_NAMES = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")


@query(
    " UNION ALL ".join(
        f"SELECT '{c}' AS original, '{c[2:]}' AS renamed, false AS removed, count({c}) AS non_null FROM orders"
        for c in _NAMES
    )
)
def name_mapping(t: Tables):
    orders = t("orders")
    names = short_names(orders.columns)
    counts = non_null_percentage(orders.toDF(*names)).select(
        F.col("column").alias("renamed"), "non_null"
    )
    return column_mapping(t.spark, orders.columns, names).join(counts, "renamed").select(
        "original", "renamed", "removed", "non_null"
    )


@query(
    " UNION ALL ".join(
        f"SELECT '{c}' AS original, count({c}) AS non_null FROM orders" for c in _NAMES
    )
)
def replaced_column_names(t: Tables):
    orders = t("orders")
    gone = replaced_names(orders.columns, short_names(orders.columns))
    return non_null_percentage(orders.select(*gone)).select(F.col("column").alias("original"), "non_null")


@query("SELECT c_custkey, c_name FROM customer")
def selected_pair(t: Tables):
    return select_pair(t("customer"), "c_custkey", "c_name")
