from __future__ import annotations

import random

import numpy as np
import pytest

from tablewright.functions.values import value_hash
from tablewright.operators import joins, overlap
from tablewright.operators.joins import choose_join, join_type, merge_many, merge_pair
from tablewright.operators.overlap import (
    Sketch,
    column_sketches,
    key_match_percentages,
    shared_value_counts,
    similarity_bounds,
    value_membership,
)
from tablewright.operators.ranking import (
    plan_batches,
    prioritize_studies,
    with_row_number,
)
from tablewright.operators.schema_ops import (
    column_mapping,
    distinct_names,
    replaced_names,
    short_names,
)


@pytest.mark.parametrize(
    ("counts", "how"),
    [((3, 3, 3), "inner"), ((2, 3, 2), "right"), ((3, 2, 2), "left"), ((3, 3, 2), "outer")],
)
def test_join_type(counts, how):
    assert join_type(*counts) == how


def brute_join(left, right, how, null_safe=False):
    """Rows (key, l, r) of the join of (key, value) lists, by nested loops."""
    result, used = [], set()
    for k, v in left:
        partners = [
            j for j, (k2, _) in enumerate(right) if (k == k2 and (k is not None or null_safe))
        ]
        used.update(partners)
        result += [(k, v, right[j][1]) for j in partners]
        if not partners and how in ("left", "outer"):
            result.append((k, v, None))
    if how in ("right", "outer"):
        result += [(k, None, v) for j, (k, v) in enumerate(right) if j not in used]
    return sorted(result, key=repr)


@pytest.mark.parametrize("null_safe", [False, True])
@pytest.mark.parametrize("how", ["inner", "left", "right", "outer"])
@pytest.mark.parametrize("unique", [(False, False), (True, False), (False, True), (True, True)])
def test_merge_pair_matches_brute_force(spark, rows, how, unique, null_safe):
    rng = random.Random(f"{how}{unique}")

    def side(is_unique):
        # a third of the rows under one key unless the key is unique
        keys = rng.sample(range(30), 12) if is_unique else [rng.choice([0, 0, *range(20)]) for _ in range(40)]
        keys = [*keys, None] if is_unique else [*keys, None, None]
        return [(k, i) for i, k in enumerate(keys)]

    left, right = side(unique[0]), side(unique[1])
    merged = merge_pair(
        spark.createDataFrame(left, "k int, v int"),
        spark.createDataFrame(right, "q bigint, w int"),
        "k",
        "q",
        how,
        null_safe=null_safe,
        unique1=unique[0],
        unique2=unique[1],
    )
    assert merged.columns == ["k", "v", "w"]
    assert rows(merged) == brute_join(left, right, how, null_safe)


def test_suffixes_and_kinds(spark):
    a = spark.createDataFrame([(1, "x", "p")], "k int, v string, v_y string")
    b = spark.createDataFrame([(1, "y")], "k int, v string")
    assert merge_pair(a, b, "k", "k").columns == ["k", "v_x", "v_y", "v_y_2"]
    with pytest.raises(ValueError):
        merge_pair(a, b, "k", "v")


def test_values_match_by_kind_not_by_spelling(spark):
    a = spark.createDataFrame([(1, "1", 1.0), (2, "2", 2.5)], "i int, s string, d double")
    counts = {(r.key1, r.key2): r.common for r in key_match_percentages(a, a.columns, a, a.columns).collect()}
    assert counts["i", "d"] == 1
    assert counts["i", "s"] == 0 and counts["s", "d"] == 0
    assert counts["s", "s"] == 2


def test_more_columns_than_a_mask_word(spark):
    df = spark.range(5).selectExpr(*[f"id + {i} AS c{i}" for i in range(130)])
    shared = {(r.i, r.j): r.n for r in shared_value_counts([(df, df.columns)]).collect()}
    assert all(shared[i, i] == 5 for i in range(130))
    assert shared[0, 1] == 4 and shared[60, 64] == 1 and shared[125, 129] == 1
    assert (0, 5) not in shared


def test_empty_side_has_no_match(spark):
    a = spark.createDataFrame([], "k int")
    b = spark.createDataFrame([(1,)], "k int")
    assert choose_join(a, ["k"], b, ["k"]) is None
    row = key_match_percentages(a, ["k"], b, ["k"]).first()
    assert (row.pct_of_1, row.pct_of_2) == (None, 0.0)
    # without rows on one side, those of the other come out
    assert [tuple(r) for r in merge_many([a, b]).collect()] == [(1,)]
    assert [tuple(r) for r in merge_many([b, a.withColumnRenamed("k", "z")]).collect()] == [(1, None)]
    with pytest.raises(ValueError, match="shares no key values"):
        merge_many([b, spark.createDataFrame([(2,)], "k int")])


def test_identity_beats_containment(spark):
    """A small code inside a wide number range is not preferred to the true key."""
    facts = spark.range(1000).selectExpr("id AS fact", "id % 99 AS ref")
    refs = spark.range(100).selectExpr("id AS ref_id")
    choice = choose_join(facts, ["fact", "ref"], refs, ["ref_id"])
    assert (choice.key1, choice.how) == ("ref", "right")
    assert choose_join(facts, ["fact", "ref"], refs, ["ref_id"], prefer="fact").key1 == "fact"


def test_row_numbers_match_brute_force(spark):
    rng = random.Random(1)
    data = [(rng.choice("aaab") if rng.random() > 0.05 else None, i, rng.random()) for i in range(3000)]
    df = spark.createDataFrame(data, "g string, i int, v double").repartition(7)
    got = {r.i: r.rn for r in with_row_number(df, ["v", "i"], ["g"]).collect()}
    for group in ("a", "b", None):
        members = sorted((v, i) for g, i, v in data if g == group)
        for n, (_, i) in enumerate(members, 1):
            assert got[i] == n


def test_batches_in_input_order(spark):
    ids = spark.range(0, 25, numPartitions=3).selectExpr("'d' AS db", "CAST(24 - id AS STRING) AS id")
    planned = {int(r.id): (r.batch, r.cycle) for r in plan_batches(ids, 4, 3).collect()}
    assert planned == {24 - n: (n // 4, n // 4 // 3) for n in range(25)}


def test_studies_are_ranked_by_completeness(spark):
    df = spark.createDataFrame(
        [("s1", "a", None), ("s1", "a", "b"), ("s2", "a", "b"), ("s3", "", None), ("s4", "a", "b"), ("s4", "a", "b")],
        "study string, x string, y string",
    )
    ranked = [(r.rank, r.study) for r in prioritize_studies(df, "study").orderBy("rank").collect()]
    assert ranked == [(1, "s4"), (2, "s2"), (3, "s1"), (4, "s3")]
    assert [r.study for r in prioritize_studies(df, "study", 2).orderBy("rank").collect()] == ["s4", "s2"]


def test_names():
    names = ["_Sample_id", "Sample_name", "Sample_id2", "Run_acc", "size"]
    assert short_names(names) == ["id", "name", "id2", "Run_acc", "size"]
    assert short_names(["Sample_x", "Sample_y", "Sample_z", "x"]) == ["x", "y", "z", "x_2"]
    assert distinct_names(["a", "a", "a_2", "a"]) == ["a", "a_3", "a_2", "a_4"]
    assert replaced_names(names, short_names(names)) == ["_Sample_id", "Sample_name", "Sample_id2"]


def test_mapping_table(spark, rows):
    assert rows(column_mapping(spark, ["o_a"], ["a"], ["gone"])) == [
        ("gone", None, True), ("o_a", "a", False),
    ]


# ---- one normal form for numbers, and sketches

NUMBERS = [
    ("0.5", 0.5, True), ("0.1", 0.1, True), ("-3.00", -3.0, True), ("7", 7.0, True), ("0.00001", 1e-5, True), ("0", -0.0, True),
    ("123456789012345678901234", 123456789012345678901234.0, False), ("100000000000000000000", 1e20, True),
    ("0.1000000000000000055", 0.1, False), ("0.30000000000000004", 0.1 + 0.2, True), ("0.3", 0.1 + 0.2, False),
]


@pytest.mark.parametrize("text, real, same", NUMBERS)
def test_decimals_meet_doubles(spark, text, real, same):
    scale = len(text.partition(".")[2])
    a = spark.createDataFrame([(text,)], "t string").selectExpr(f"CAST(t AS DECIMAL(38,{scale})) AS k")
    b = spark.createDataFrame([(real,)], "k double")
    assert key_match_percentages(a, ["k"], b, ["k"]).first().common == same
    assert value_membership(a, "k", b, "k") == same
    wider = a.selectExpr(f"CAST(k AS DECIMAL(38,{min(scale + 2, 14) if scale < 12 else scale})) AS k")
    assert key_match_percentages(a, ["k"], wider, ["k"]).first().common == 1


def test_all_ways_of_joining_agree_on_decimals(spark):
    a = spark.sql("SELECT CAST(id / 4 AS DECIMAL(10,2)) AS k, id + 5000 AS a FROM range(40)")
    b = spark.sql("SELECT CAST(id / 2 AS DOUBLE) AS k, id + 1000 AS b FROM range(30)")
    assert key_match_percentages(a, ["k"], b, ["k"]).first().common == 20
    merged = merge_many([a, b])
    assert merged.count() == merge_pair(a, b, "k", "k", "outer").count() == 50


def sketch(values, family=0, k=64):
    hashes = np.unique(np.array([hash((v, "salt")) for v in values], dtype=np.int64))
    return Sketch(hashes[:k], family)


@pytest.mark.parametrize("seed", range(20))
def test_bounds_hold(monkeypatch, seed):
    monkeypatch.setattr(overlap, "SKETCH", 64)
    rng = random.Random(seed)
    sizes = [rng.choice([0, 3, 40, 500, 5000]) for _ in range(3)]
    left, both, right = (range(1000000 * i, 1000000 * i + n) for i, n in enumerate(sizes))
    low, high = similarity_bounds(sketch([*left, *both]), sketch([*both, *right]))
    total = sum(sizes)
    assert low <= (len(both) / total if total else 0) <= high
    if total and max(len(left), len(right)) + len(both) < 64:
        assert low == high


def test_sketches_are_those_of_the_whole_column(spark):
    df = spark.range(50_000).selectExpr("id % 9000 AS many", "id % 7 AS few", "CAST(NULL AS INT) AS none", "CAST(id % 9000 AS DOUBLE) AS real")
    got = column_sketches(df.repartition(7), df.columns)
    hashes = sorted(r[0] for r in df.select(value_hash("many", df.schema["many"].dataType)).distinct().collect())
    assert got["many"].hashes.tolist() == hashes[: overlap.SKETCH] and not got["many"].complete
    assert got["real"].hashes.tolist() == got["many"].hashes.tolist()
    assert len(got["few"].hashes) == 7 and got["few"].complete and len(got["none"].hashes) == 0
    assert column_sketches(df, []) == {}


def test_hopeless_columns_are_not_counted(spark, monkeypatch):
    """Only columns of pairs that may win are shuffled, and the choice is the one that counting all makes."""
    facts = spark.range(20_000).selectExpr(
        "id AS fact", "id % 5000 AS ref", *[f"id * {i} + 10000000 * {i + 1} AS other{i}" for i in range(1, 9)]
    )
    refs = spark.range(6000).selectExpr("id AS ref_id", "id + 900000000 AS code", "id % 3 AS kind")
    counted = []
    count = joins.key_match_percentages
    monkeypatch.setattr(joins, "key_match_percentages", lambda a, k1, b, k2: counted.append((k1, k2)) or count(a, k1, b, k2))
    choice = choose_join(facts, facts.columns, refs, ["ref_id", "code"])
    assert counted == [(["ref"], ["ref_id"])]
    monkeypatch.setattr(joins, "_may_win", lambda df1, keys1, df2, keys2, liked: [(a, b) for a in keys1 for b in keys2])
    assert choice == choose_join(facts, facts.columns, refs, ["ref_id", "code"])


def test_one_shared_value_is_found(spark):
    """A pair that is hardly alike wins if no other shares anything."""
    a = spark.range(30_000).selectExpr("id AS x", "id + 1000000 AS y")
    b = spark.range(30_000).selectExpr("id + 29999 AS z")
    assert choose_join(a, ["x", "y"], b, ["z"])[:2] == ("x", "z")
    assert choose_join(a, ["y", "x"], b, ["z"], prefer="^y$")[:2] == ("x", "z")


def test_decimals_are_brought_into_form_once_for_each_value(spark):
    df = spark.range(300_000).selectExpr(
        "CAST(id % 7 / 4 AS DECIMAL(12,2)) AS a", "CAST(id % 9 AS DECIMAL(18,4)) AS b", "id % 9 / 2 AS c",
        "IF(id % 3 = 0, NULL, CAST(9200000000000000000 + id % 2 AS DECIMAL(38,10))) AS d", "id % 5 AS e", "CAST(id % 5 AS STRING) AS f",
    )
    got = key_match_percentages(df, ["a", "b", "d"], df, ["c", "e", "f"]).collect()
    assert {(r.key1, r.key2): (r.ndv1, r.ndv2, r.common) for r in got} == {
        ("a", "c"): (7, 9, 4), ("a", "e"): (7, 5, 2), ("a", "f"): (7, 5, 0),
        ("b", "c"): (9, 9, 5), ("b", "e"): (9, 5, 5), ("b", "f"): (9, 5, 0),
        ("d", "c"): (2, 9, 0), ("d", "e"): (2, 5, 0), ("d", "f"): (2, 5, 0),
    }
    masks = overlap.value_masks([(df, df.columns)])
    plan = masks._jdf.queryExecution().optimizedPlan().toString()
    # below the first grouping nothing is spelt out, and the steps above it aren't repeated within each other
    assert "regexp_replace" not in plan[plan.rindex("Aggregate") :]
    assert plan.count("regexp_replace") < 20
