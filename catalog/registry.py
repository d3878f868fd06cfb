"""Where the examples are collected, and the derived tables they share."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The given tables of one scale factor, read on demand."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder

    def __call__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


class Derived(NamedTuple):
    """A projection of a given table, written once in SQL both engines read."""

    table: str
    columns: tuple[str, ...]

    def frame(self, t: Tables) -> DataFrame:
        return t(self.table).selectExpr(*self.columns)

    @property
    def sql(self) -> str:
        return f"(SELECT {', '.join(self.columns)} FROM {self.table})"


def derived(table: str, *columns: str) -> Derived:
    return Derived(table, columns)


def query(sql: str | None = None):
    """Register a function of the tables under its name, with its SQL if there is one."""

    def register(fn: Callable[[Tables], DataFrame]):
        QUERIES[fn.__name__] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


# Orders with injected gaps: the given tables hold neither nulls nor empty strings.
ORDERS_GAPS = derived(
    "orders",
    "o_orderkey",
    "o_custkey",
    "o_orderstatus",
    "o_totalprice",
    "o_orderpriority",
    "CASE WHEN o_orderkey % 10 = 0 THEN o_orderstatus END AS tenth",
    "CASE WHEN o_orderkey % 20 = 0 THEN o_orderpriority END AS edge",
    "CASE WHEN o_orderkey % 25 = 0 THEN o_orderpriority END AS rare",
    "CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE o_orderstatus END AS half_empty",
    "CASE WHEN o_orderkey % 40 = 0 THEN o_orderstatus ELSE '' END AS mostly_empty",
    "CASE WHEN o_orderkey < 0 THEN o_orderstatus END AS never",
)

ORDERS_GAPS_COLUMNS = (
    "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority",
    "tenth", "edge", "rare", "half_empty", "mostly_empty", "never",
)

# Lineitem with an exact copy, two nearly equal columns and one with nulls.
LINEITEM_COPIES = derived(
    "lineitem",
    "l_orderkey",
    "l_linenumber",
    "l_quantity",
    "l_returnflag",
    "l_orderkey AS l_orderkey_again",
    "CAST(l_quantity AS BIGINT) AS l_quantity_whole",
    "CASE WHEN l_orderkey % 20 = 0 THEN 'other' ELSE l_returnflag END AS l_flag_close",
    "CASE WHEN l_orderkey % 8 = 0 THEN 'other' ELSE l_returnflag END AS l_flag_far",
    "CASE WHEN l_orderkey % 20 = 0 THEN NULL ELSE l_linenumber END AS l_line_gaps",
)

LINEITEM_COPIES_COLUMNS = (
    "l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_orderkey_again",
    "l_quantity_whole", "l_flag_close", "l_flag_far", "l_line_gaps",
)

# Customers with untidy text.
CUSTOMER_UNTIDY = derived(
    "customer",
    "c_custkey",
    "'  ' || c_name || chr(9) AS c_name",
    "'\u00a0' || upper(c_mktsegment) || '\u3000' || chr(10) AS c_mktsegment",
    "c_acctbal",
)

# Customers with texts that read as missing, and some that only look like it.
CUSTOMER_TOKENS = derived(
    "customer",
    "c_custkey",
    "CASE c_custkey % 24 WHEN 0 THEN '' WHEN 1 THEN '#N/A' WHEN 2 THEN '#N/A N/A' WHEN 3 THEN '#NA'"
    " WHEN 4 THEN '-1.#IND' WHEN 5 THEN '-1.#QNAN' WHEN 6 THEN '-NaN' WHEN 7 THEN '-nan'"
    " WHEN 8 THEN '1.#IND' WHEN 9 THEN '1.#QNAN' WHEN 10 THEN '<NA>' WHEN 11 THEN 'N/A'"
    " WHEN 12 THEN 'NA' WHEN 13 THEN 'NULL' WHEN 14 THEN 'NaN' WHEN 15 THEN 'None'"
    " WHEN 16 THEN 'n/a' WHEN 17 THEN 'nan' WHEN 18 THEN 'null' WHEN 19 THEN 'Na'"
    " WHEN 20 THEN ' NA ' ELSE c_mktsegment END AS c_mktsegment",
)

# The texts read as missing.
NA_LIST = (
    "'','#N/A','#N/A N/A','#NA','-1.#IND','-1.#QNAN','-NaN','-nan','1.#IND','1.#QNAN',"
    "'<NA>','N/A','NA','NULL','NaN','None','n/a','nan','null'"
)

# Events with XML in two columns, one key of which overrides a plain column.
EVENTS_XML = derived(
    "events",
    "event_id",
    "event_type AS item",
    "'<Item type=\"' || event_type || '\"> 0' || CAST(user_id AS VARCHAR(20)) || ' </Item>'"
    " || '<User><Id>' || CAST(user_id AS VARCHAR(20)) || '</Id></User>' AS InfoXml",
    "CASE WHEN event_id % 3 = 0 THEN NULL WHEN event_id % 3 = 1 THEN '<Tag n=\"1\"/><Tag n=\"2\"/>'"
    " ELSE '<Pair><A>1</A><B>2</B></Pair><Tag n=\"9\">t' || CAST(event_id AS VARCHAR(20)) || '</Tag>' END AS MoreXml",
)

# The same with an unclosed element in every tenth row.
EVENTS_BROKEN = derived(
    "events",
    "event_id",
    "'<Item type=\"' || event_type || '\">v' || CAST(user_id AS VARCHAR(20))"
    " || CASE WHEN event_id % 10 = 0 THEN '' ELSE '</Item>' END AS InfoXml",
)

DENORMAL_SQL = (
    "(SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, c_custkey, c_name, c_nationkey,"
    " c_mktsegment, n_nationkey, n_name, n_regionkey FROM orders"
    " JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"
)
DENORMAL_COLUMNS = (
    "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "c_custkey", "c_name",
    "c_nationkey", "c_mktsegment", "n_nationkey", "n_name", "n_regionkey",
)


def denormal(t: Tables) -> DataFrame:
    orders, customer, nation = t("orders"), t("customer"), t("nation")
    joined = orders.join(customer, orders.o_custkey == customer.c_custkey).join(
        nation, customer.c_nationkey == nation.n_nationkey
    )
    return joined.select(*DENORMAL_COLUMNS)


def pct(part: str, whole: str) -> str:
    return f"100.0 * {part} / nullif({whole}, 0)"
