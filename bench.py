"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from catalog.registry import EVENTS_XML, LINEITEM_COPIES, Tables, denormal
from tablewright import build_session
from tablewright.operators.cleaning import drop_similar_columns
from tablewright.operators.joins import merge_many
from tablewright.operators.overlap import key_match_percentages, value_set_equal_pairs
from tablewright.operators.profile import (
    completeness_profile,
    distinct_value_counts,
    pairwise_equality,
    primary_key_candidates,
)
from tablewright.operators.ranking import plan_batches, prioritize_studies
from tablewright.operators.relations import column_relationships, star_schema
from tablewright.operators.xml_ops import flatten_xml_columns
from tablewright.plans.flows import clean_table


def headline(cpus: int):
    return {
        "completeness_profile": lambda t: completeness_profile(t("lineitem")),
        "distinct_value_counts": lambda t: distinct_value_counts(t("lineitem")),
        "primary_key_candidates": lambda t: t.spark.createDataFrame(
            [(n,) for n in primary_key_candidates(t("orders"))], "name string"
        ),
        "pairwise_equality": lambda t: pairwise_equality(denormal(t)),
        "drop_similar_columns": lambda t: drop_similar_columns(LINEITEM_COPIES.frame(t)).table,
        "value_set_equal_pairs": lambda t: value_set_equal_pairs(t("lineitem")),
        "column_relationships": lambda t: column_relationships(denormal(t)),
        "star_schema": lambda t: star_schema(denormal(t)).rebuild(),
        "clean_table": lambda t: clean_table(t("lineitem")).star.fact,
        "key_match_percentages": lambda t: key_match_percentages(
            t("orders"), ["o_orderkey", "o_custkey"], t("customer"), ["c_custkey", "c_nationkey"]
        ),
        "merge_many": lambda t: merge_many([t("orders"), t("customer"), t("nation")]),
        "flatten_xml_columns": lambda t: flatten_xml_columns(EVENTS_XML.frame(t), partitions=cpus),
        "plan_batches": lambda t: plan_batches(
            t("orders").selectExpr("'orders' AS db", "o_orderkey AS id"), 10000, 16, order_by=["id"]
        ),
        "prioritize_studies": lambda t: prioritize_studies(t("conversations"), "conv_id", 100),
    }


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(
        f"local[{cpus}]",
        "bench",
        spark__sql__shuffle__partitions=str(cpus),
        spark__driver__memory="8g",
        # small inputs: let a file be cut into enough pieces for all cores
        spark__sql__files__openCostInBytes=str(256 * 1024),
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    tables, runs = Tables(spark, folder), headline(cpus)
    small = Path(folder).parent / "sf0.001"
    if small.is_dir() and small != Path(folder):
        for run in runs.values():  # load classes and compile hot paths
            run(Tables(spark, str(small))).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name, run in runs.items():
        start = time.perf_counter()
        run(tables).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(folder).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
