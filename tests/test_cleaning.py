from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tablewright.functions.text import strip_whitespace
from tablewright.functions.values import canonical_text
from tablewright.operators.cleaning import (
    NA_TOKENS,
    drop_all_null_columns,
    drop_all_null_rows,
    drop_identical_columns,
    drop_similar_columns,
    drop_sparse_columns,
    normalize_na,
    standardize_text,
)
from tablewright.operators.relations import find_relations
from tablewright.operators.profile import (
    completeness_profile,
    equality_bounds,
    non_null_percentage,
    pairwise_equality,
    primary_key_candidates,
    similar_pairs,
)


@pytest.mark.parametrize(
    ("n", "k", "fraction", "floor", "percent"),
    [
        (10, 0, False, True, False),
        (19, 0, False, True, False),
        (20, 1, True, True, True),
        (20, 0, False, False, False),
        (21, 1, False, True, False),
        (100, 5, True, True, True),
        (100, 4, False, False, False),
    ],
)
def test_sparse_edges(spark, n, k, fraction, floor, percent):
    df = spark.range(n).selectExpr("id", f"CASE WHEN id < {k} THEN 'v' END AS v")
    for mode, kept in (("fraction", fraction), ("floor", floor), ("percent", percent)):
        table, removed = drop_sparse_columns(df, 0.95, mode)
        assert ("v" in table.columns) == kept, mode
        assert removed == ([] if kept else ["v"])


def test_percent_reads_empty_as_null(spark, rows):
    df = spark.createDataFrame([("", "a"), ("", "")], "x string, y string")
    table, removed = drop_sparse_columns(df, mode="percent")
    assert removed == ["x"]
    assert rows(table) == [("a",), (None,)]


def test_empty_tables_keep_everything(spark):
    df = spark.createDataFrame([], "a string, b int")
    for mode in ("fraction", "floor", "percent"):
        assert drop_sparse_columns(df, mode=mode).table.columns == ["a", "b"]
    assert drop_all_null_columns(df).removed == []
    assert drop_identical_columns(df)[1] == []
    assert drop_similar_columns(df).removed == []
    profile = completeness_profile(df).collect()
    assert [r.valid_pct for r in profile] == [None, None]
    assert [r.pct for r in non_null_percentage(df).collect()] == [None, None]
    assert similar_pairs(df) == []
    assert [r.identical for r in pairwise_equality(df).collect()] == [False]


def test_one_row(spark):
    df = spark.createDataFrame([("x", "x", None)], "a string, b string, c string")
    assert drop_identical_columns(df)[1] == ["b"]
    assert primary_key_candidates(df) == ["a", "b"]
    assert drop_all_null_columns(df).removed == ["c"]


@pytest.mark.parametrize("space", [" ", "\t", "\n", " ", "　", "\x1c", "\x85", " "])
def test_strip(spark, space):
    value = f"{space}a {space}b{space}"
    df = spark.createDataFrame([(value,)], "v string")
    assert df.select(strip_whitespace(F.col("v"))).first()[0] == value.strip() == f"a {space}b"


def test_standardize(spark, rows):
    df = spark.createDataFrame([(" Ab ", 1), (None, 2)], "s string, n int")
    assert rows(standardize_text(df, in_place=True)) == [("ab", 1), (None, 2)]
    assert standardize_text(df).columns == ["s", "n", "s_std"]


def test_na_tokens(spark):
    values = [*NA_TOKENS, "Na", " NA ", "x"]
    df = spark.createDataFrame([(v, v) for v in values], "raw string, v string")
    cleaned = normalize_na(df.withColumn("keep", F.concat(F.lit(">"), "raw")))
    left = {r.keep[1:] for r in cleaned.where("v IS NOT NULL").collect()}
    assert left == {"Na", " NA ", "x"}
    assert len(NA_TOKENS) == 19


def test_null_rows(spark, rows):
    df = spark.createDataFrame([(None, None), (1, None)], "a int, b int")
    assert rows(drop_all_null_rows(df)) == [(1, None)]


def test_identity_needs_every_row_and_no_null(spark):
    df = spark.createDataFrame(
        [(1, 1.0, "1", 1, None), (2, 2.0, "2", 2, 2), (2, 2.0, "2", 3, 2)],
        "a int, b double, c string, d int, e int",
    )
    _, removed = drop_identical_columns(df)
    assert removed == ["b"]  # 1 equals 1.0, but neither "1" nor a null
    swapped = spark.createDataFrame([(1, 2), (2, 1)], "a int, b int")
    assert drop_identical_columns(swapped)[1] == []  # same values in another order
    gaps = spark.createDataFrame([(None, None), (2, 2)], "a int, b int")
    assert drop_identical_columns(gaps)[1] == []
    assert drop_identical_columns(gaps, null_safe=True)[1] == ["b"]


def test_similarity_is_not_transitive(spark):
    # b is close to a, c is close to b only; both go
    df = spark.range(100).selectExpr(
        "0 AS a", "CASE WHEN id < 8 THEN 1 ELSE 0 END AS b", "CASE WHEN id < 16 THEN 1 ELSE 0 END AS c"
    )
    assert drop_similar_columns(df, 0.9).removed == ["b", "c"]
    assert {(a, b) for a, b, _ in similar_pairs(df, 0.9)} == {("a", "b"), ("b", "c")}


def test_similarity_threshold_is_strict(spark):
    df = spark.range(10).selectExpr("1 AS a", "CASE WHEN id = 0 THEN 0 ELSE 1 END AS b")
    assert drop_similar_columns(df, 0.9).removed == []
    assert drop_similar_columns(df, 0.89).removed == ["b"]


def test_bounds_are_never_too_low(spark):
    df = spark.range(500).selectExpr("id % 7 AS a", "id % 5 AS b", "'x' AS c", "CAST(id % 7 AS DOUBLE) AS d")
    bounds = equality_bounds(df, df.columns)
    for r in pairwise_equality(df).collect():
        assert bounds[r.col1, r.col2] >= r.n_equal


def test_canonical_text(spark):
    df = spark.createDataFrame(
        [(1, 1.0, 1.5, float("nan"), True)], "i int, d double, f double, n double, b boolean"
    )
    types = {f.name: f.dataType for f in df.schema.fields}
    row = df.select(*[canonical_text(c, types[c]).alias(c) for c in df.columns]).first()
    assert tuple(row) == ("1", "1", "1.5", None, "true")


def test_wide_integers_stay_apart(spark):
    big = 2**60
    df = spark.range(2000).selectExpr(f"{big} + id AS k")
    assert primary_key_candidates(df) == ["k"]


def test_many_columns(spark):
    df = spark.range(50).selectExpr(*[f"CASE WHEN id < {i} THEN NULL ELSE id + {i} END AS c{i}" for i in range(80)])
    assert primary_key_candidates(df) == ["c0"]
    assert pairwise_equality(df).count() == 80 * 79 // 2


def test_nested_columns_take_part(spark):
    df = spark.range(30).selectExpr("map('k', id % 3) AS m", "map('k', id % 3) AS m2", "array(id) AS a", "id % 3 AS n")
    assert drop_identical_columns(df)[1] == ["m2"]
    relations = find_relations(df)
    assert ("m", "n") in relations.dependencies and ("n", "m") in relations.dependencies
    assert relations.keys == ["a"]
