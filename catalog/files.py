"""Round trips through every source and sink, and the streaming job."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import CUSTOMER_TOKENS, EVENTS_XML, NA_LIST, Tables, query
from tablewright.operators.ranking import plan_batches
from tablewright.plans.flows import flatten_folder
from tablewright.session import scratch_path, spread
from tablewright.sources import (
    read_csv_with_xml,
    read_delimited,
    read_folder_union,
    read_id_list,
    read_id_response_log,
    read_text_table,
    read_typed_csv,
    read_xml_batches,
    records_to_table,
    write_csv,
    write_cycle_dumps,
    write_id_list,
    write_tsv,
    write_with_column_mapping,
)
from tablewright.sources.staging import hidden_folder
from tablewright.streaming import read_flattened, stream_flatten


@query(
    f"SELECT '' || c_custkey AS c_custkey, CASE WHEN c_mktsegment NOT IN ({NA_LIST}) THEN c_mktsegment END"
    f" AS c_mktsegment FROM {CUSTOMER_TOKENS.sql}"
)
def text_table(t: Tables):
    path = scratch_path(t.spark, "text")
    write_tsv(CUSTOMER_TOKENS.frame(t), path)
    return read_text_table(t.spark, path)


@query("SELECT '' || c_custkey AS c_custkey, 'é ' || c_name AS c_name FROM customer")
def text_table_in_latin1(t: Tables):
    path = scratch_path(t.spark, "latin1")
    frame = t("customer").select("c_custkey", F.concat(F.lit("é "), "c_name").alias("c_name"))
    frame.write.options(header=True, sep="\t", encoding="ISO-8859-1").csv(path)
    return read_text_table(t.spark, path)


@query("SELECT * FROM part")
def typed_csv(t: Tables):
    path = scratch_path(t.spark, "typed")
    write_csv(t("part"), path)
    return read_typed_csv(t.spark, path).withColumns({"p_partkey": F.col("p_partkey").cast("bigint")})


@query(f"SELECT '' || event_id AS event_id, item, InfoXml, MoreXml FROM {EVENTS_XML.sql}")
def csv_with_xml(t: Tables):
    path = scratch_path(t.spark, "xml-cells")
    write_csv(EVENTS_XML.frame(t), path)
    return read_csv_with_xml(t.spark, path)


@query(
    "SELECT '' || doc_id AS doc_id, text, source, CASE WHEN contains(text, chr(10)) THEN [lang, '' || n_chars]"
    " WHEN lang = 'en' THEN ['' || n_chars] END AS rest FROM documents"
)
def csv_with_surplus_cells(t: Tables):
    """Texts with line breaks, some followed by one or two cells that the header doesn't name."""
    path = scratch_path(t.spark, "surplus")
    cell = lambda name: F.concat(F.lit('"'), F.replace(F.col(name), F.lit('"'), F.lit('""')), F.lit('"'))
    more = F.when(F.contains("text", F.lit("\n")), F.concat(F.lit(","), "lang", F.lit(","), "n_chars"))
    more = more.when(F.col("lang") == "en", F.concat(F.lit(","), "n_chars")).otherwise("")
    lines = t("documents").select(F.concat("doc_id", F.lit(","), cell("text"), F.lit(","), "source", more).alias("value"))
    lines = lines.select(F.lit(1).alias("place"), "value", (F.crc32(F.col("value").cast("binary")) % 16).alias("file"))
    # a header in front of the lines of each file
    head = lines.select(F.lit(0).alias("place"), F.lit("doc_id,text,source").alias("value"), "file").distinct()
    rows = lines.unionByName(head).repartition("file").sortWithinPartitions("file", "place")
    rows.select("file", "value").write.partitionBy("file").text(path)
    return read_delimited(t.spark, [path], ",", surplus="rest")


_UNION = (
    "SELECT '' || c_custkey AS key, c_name AS name, NULL AS balance FROM customer"
    " UNION ALL SELECT '' || s_suppkey, NULL, '' || CAST(s_acctbal * 100 AS BIGINT) FROM supplier"
)


@query(_UNION)
def folder_with_two_headers(t: Tables):
    path = scratch_path(t.spark, "folder")
    write_csv(t("customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name")), path, "append")
    supplier = t("supplier").select(
        F.round(F.col("s_acctbal") * 100).cast("bigint").alias("balance"), F.col("s_suppkey").alias("key")
    )
    write_csv(supplier, path, "append")
    return read_folder_union(t.spark, path, ".csv")


@query("SELECT 'documents' AS db, '' || doc_id AS id FROM documents")
def id_list(t: Tables):
    path = scratch_path(t.spark, "ids")
    ids = t("documents").select(F.lit("documents").alias("db"), F.col("doc_id").cast("string").alias("id"))
    arrays = plan_batches(ids, 100, 10, order_by=["id"]).groupBy("batch").agg(
        F.to_json(F.collect_list("id")).alias("value")
    )
    arrays.write.partitionBy("batch").text(f"{path}/documents")
    return read_id_list(t.spark, f"{path}/documents", "documents")


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_records(t: Tables):
    path = scratch_path(t.spark, "records")
    line = F.expr("concat('{\"event_id\":', event_id, ',', substring(props, 2))")
    t("events").select(line.alias("value")).write.text(path)
    return records_to_table(t.spark, path)


@query("SELECT c_custkey AS _key, c_name AS name, c_nationkey AS nation FROM customer")
def xml_batches(t: Tables):
    path = scratch_path(t.spark, "batches")
    rows = t("customer").select(
        F.col("c_custkey").alias("_key"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation")
    )
    rows.write.format("xml").option("rowTag", "Customer").option("rootTag", "Set").save(path)
    return read_xml_batches(t.spark, path, "Customer", "_key bigint, name string, nation int")


@query(
    "SELECT (row_number() OVER (ORDER BY doc_id) - 1) // 50 AS page, 'D' || doc_id AS id FROM documents"
)
def id_response_log(t: Tables):
    path = scratch_path(t.spark, "log")
    ids = t("documents").select(F.lit("d").alias("db"), "doc_id")
    pages = (
        plan_batches(ids, 50, 1, order_by=["doc_id"])
        .groupBy("batch")
        .agg(F.sort_array(F.collect_list("doc_id")).alias("ids"))
        .select("batch", F.transform("ids", lambda i: F.concat(F.lit("D"), i.cast("string"))).alias("IdList"))
    )
    answer = F.struct(F.size("IdList").cast("string").alias("Count"), "IdList")
    document = F.to_json(answer, {"pretty": "true"})
    log = pages.orderBy("batch").select(document.alias("value"))
    log.write.option("lineSep", "\n\n").text(path)
    return read_id_response_log(t.spark, path)


@query("SELECT c_custkey, c_name, c_acctbal FROM customer")
def tsv_written(t: Tables):
    path = scratch_path(t.spark, "tsv")
    write_tsv(t("customer").select("c_custkey", "c_name", "c_acctbal"), path)
    return read_typed_csv(t.spark, path, "\t", "c_custkey bigint, c_name string, c_acctbal double")


@query("SELECT doc_id, text, lang FROM documents")
def csv_written(t: Tables):
    path = scratch_path(t.spark, "csv")
    write_csv(t("documents").select("doc_id", "text", "lang"), path)
    return read_csv_with_xml(t.spark, path).withColumn("doc_id", F.col("doc_id").cast("bigint"))


@query(
    "SELECT o_orderkey AS orderkey, o_custkey AS custkey, o_totalprice AS totalprice FROM orders"
)
def table_written_with_short_names(t: Tables):
    path = scratch_path(t.spark, "mapped")
    write_with_column_mapping(t("orders").select("o_orderkey", "o_custkey", "o_totalprice"), path)
    return t.spark.read.parquet(f"{path}/MetaData")


@query(
    " UNION ALL ".join(
        f"SELECT 'o_{c}' AS original, '{c}' AS renamed, count(o_{c}) AS non_null FROM orders"
        for c in ("orderkey", "custkey", "totalprice")
    )
)
def mapping_written_beside_table(t: Tables):
    path = scratch_path(t.spark, "mapped")
    write_with_column_mapping(
        t("orders").select("o_orderkey", "o_custkey", "o_totalprice"), path, format="tsv"
    )
    mapping = read_typed_csv(t.spark, f"{path}/ColumnMapping", "\t")
    data = read_typed_csv(t.spark, f"{path}/MetaData", "\t")
    counts = data.agg(*[F.count(c).alias(c) for c in data.columns]).unpivot([], data.columns, "renamed", "non_null")
    return mapping.join(counts, "renamed").select("original", "renamed", "non_null")


@query("SELECT lang AS db, doc_id AS id FROM documents")
def id_lists_written(t: Tables):
    path = scratch_path(t.spark, "id-lists")
    ids = t("documents").select(F.col("lang").alias("db"), F.col("doc_id").alias("id"))
    write_id_list(ids.where("db = 'en'"), path)
    landed = t.spark.read.json(path).select("db")
    write_id_list(ids, path, landed)
    return t.spark.read.schema("id bigint, db string").json(path).select("db", "id")


@query(
    "SELECT db, id, (rn - 1) // 20 AS batch, (rn - 1) // 20 // 4 AS cycle FROM"
    " (SELECT 'documents' AS db, doc_id AS id, row_number() OVER (ORDER BY doc_id) AS rn FROM documents)"
)
def cycle_dumps_written(t: Tables):
    path = scratch_path(t.spark, "cycles")
    ids = t("documents").select(F.lit("documents").alias("db"), F.col("doc_id").alias("id"))
    write_cycle_dumps(ids, path, 20, 4, order_by=["id"])
    back = t.spark.read.schema("db string, id bigint, batch bigint, cycle bigint").option("header", True).csv(path)
    return back.select("db", "id", "batch", "cycle")


_FLAT = (
    "SELECT '' || event_id AS event_id, '0' || user_id AS item, event_type AS \"item@type\", '' || user_id AS \"user\","
    " CASE WHEN event_id % 3 = 2 THEN 't' || event_id END AS tag,"
    " CASE event_id % 3 WHEN 1 THEN '1' WHEN 2 THEN '9' END AS \"tag@n\", kind FROM"
)


@query(
    f"{_FLAT} (SELECT event_id, user_id, event_type, 'first' AS kind FROM events UNION ALL"
    " SELECT event_id, user_id, event_type, NULL FROM events)"
)
def folder_flattened(t: Tables):
    path = scratch_path(t.spark, "dumps")
    frame = EVENTS_XML.frame(t).withColumn("Thing", F.lit("x"))
    write_csv(spread(frame.withColumn("kind", F.lit("first"))), path, "append")
    write_csv(spread(frame), path, "append")  # the same records under another header
    out = scratch_path(t.spark, "flat")
    return flatten_folder(t.spark, path, out, ".csv", drop=["Thing"])


@query(
    "SELECT '' || event_id AS event_id, '0' || user_id AS item, lower(event_type) AS \"item@type\" FROM events"
)
def streamed_and_flattened(t: Tables):
    path = scratch_path(t.spark, "stream-in")
    frame = EVENTS_XML.frame(t).select("event_id", "InfoXml")
    write_csv(spread(frame), path)
    write_csv(spread(frame), path, "append")  # landed twice
    out = scratch_path(t.spark, "stream-out")
    run = stream_flatten(
        t.spark,
        path,
        "event_id string, InfoXml string",
        out,
        scratch_path(t.spark, "stream-state"),
        ["item", "item@type"],
        id="event_id",
        suffix=".csv",
    )
    run.awaitTermination()
    return t.spark.read.parquet(out)


@query(
    "SELECT '' || event_id AS event_id, '0' || user_id AS item, lower(event_type) AS \"item@type\", '' || user_id AS \"user\","
    " CASE WHEN event_id % 3 = 2 THEN 't' || event_id END AS tag,"
    " CASE event_id % 3 WHEN 1 THEN '1' WHEN 2 THEN '9' END AS \"tag@n\" FROM events"
)
def streamed_with_keys_found(t: Tables):
    """Every lot of files is a micro-batch; those without a key are read with nulls for it."""
    path, out, state = (scratch_path(t.spark, f"stream-{what}") for what in ("in", "out", "state"))
    files = t.spark.sparkContext.defaultParallelism  # a file with line breaks in cells is read by one task
    frame = EVENTS_XML.frame(t).select("event_id", "InfoXml", "MoreXml")
    for rest in (0, 1, 2, 1):  # the second lot lands twice
        write_csv(frame.where(F.col("event_id") % 3 == rest).repartition(files), path, "append")
    schema = "event_id string, InfoXml string, MoreXml string"
    run = stream_flatten(t.spark, path, schema, out, state, id="event_id", suffix=".csv", files_per_batch=files)
    run.awaitTermination()
    return read_flattened(t.spark, out, state)


@query("SELECT lang AS db, doc_id AS id FROM documents")
def id_lists_of_a_stopped_run(t: Tables):
    """A run that had moved one list and staged another is run again."""
    path = scratch_path(t.spark, "stopped")
    ids = t("documents").select(F.col("lang").alias("db"), F.col("doc_id").alias("id"))
    write_id_list(ids.where("db = 'en'"), path)
    ids.where("db <> 'en'").write.partitionBy("db").json(hidden_folder(path, "ids"))
    write_id_list(ids, path)
    return t.spark.read.schema("id bigint, db string").json(path).select("db", "id")
