"""The worked example with columns A to H, and dependencies against brute force."""

from __future__ import annotations

import datetime
import random
from decimal import Decimal
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from tablewright.operators import relations as rel
from tablewright.operators.overlap import value_set_equal_pairs
from tablewright.operators import profile
from tablewright.operators.profile import (
    distinct_counts,
    identical_classes,
    pairwise_equality,
    primary_key_candidates,
    unique_columns,
)

LETTERS = list("ABCDEFGH")
EXAMPLE = [
    (1, 8, 1, 3, 1, 1, 100, 1),
    (2, 7, 2, 1, 1, 1, 101, 2),
    (3, 6, 2, 4, 2, 2, 102, 3),
    (4, 5, 3, 2, 2, 2, 103, 4),
    (5, 4, 3, 8, 3, 3, 104, 5),
    (6, 3, 3, 5, 3, 3, 105, 6),
    (7, 2, 4, 7, 4, 4, 106, 7),
    (8, 1, 4, 6, 4, 4, 107, 1),
]


@pytest.fixture(scope="module")
def example(spark):
    return spark.createDataFrame(EXAMPLE, ", ".join(f"{c} int" for c in LETTERS)).cache()


def test_keys_and_counts(example):
    assert primary_key_candidates(example) == ["A", "B", "D", "G"]
    assert distinct_counts(example, LETTERS) == dict(
        A=8, B=8, C=4, D=8, E=4, F=4, G=8, H=7
    )


def test_identical_and_equal_sets(example):
    assert identical_classes(example) == [["E", "F"]]
    pairs = {(r.col1, r.col2) for r in value_set_equal_pairs(example).collect()}
    assert pairs == {("A", "B"), ("A", "D"), ("B", "D"), ("C", "E"), ("C", "F"), ("E", "F")}


def test_kinds(example):
    kinds = {(r.col_a, r.col_b): r.kind for r in rel.column_relationships(example).collect()}
    one_to_one = {("A", "B"), ("A", "D"), ("A", "G"), ("B", "D"), ("B", "G"), ("D", "G")}
    for a, b in permutations(LETTERS, 2):
        if (a, b) in one_to_one or (b, a) in one_to_one:
            want = "bijective"
        elif {a, b} == {"E", "F"}:
            want = "identical"
        elif a in "ABDG" and b in "CEFH":
            want = "surjective"
        else:
            want = "none"
        assert kinds[a, b] == want, (a, b)


def brute_force(table, a, b):
    """(does a fix b on rows with both, is it lossless) by plain loops."""
    seen, lossless = {}, True
    gaps = set()
    for row in table:
        if row[a] is None:
            lossless &= row[b] is None
        elif row[b] is None:
            gaps.add(row[a])
        else:
            seen.setdefault(row[a], set()).add(row[b])
    holds = bool(seen) and all(len(v) == 1 for v in seen.values())
    return holds, lossless and not (gaps & seen.keys())


@pytest.mark.parametrize("seed", range(4))
def test_dependencies_match_brute_force(spark, seed):
    rng = random.Random(seed)
    table = []
    for i in range(400):
        base = rng.randrange(40)
        table.append(
            (
                base,
                f"t{base % 7}" if rng.random() > 0.1 else None,
                float(base % 7),
                base // 2 if base % 5 else None,
                rng.choice([None, 1.5, float("nan")]),
                i if i != 13 else 12,
                i // 2 * 1.0,
                f"v{i // 2 % 11}",
            )
        )
    schema = "a int, b string, c double, d bigint, e double, f int, g double, h string"
    df = spark.createDataFrame(table, schema)
    clean = [tuple(None if v != v else v for v in row) for row in table]
    relations = rel.find_relations(df)
    for i, j in permutations(range(8), 2):
        pair = (df.columns[i], df.columns[j])
        holds, lossless = brute_force(clean, i, j)
        assert (pair in relations.dependencies) == holds, pair
        if holds:
            assert relations.dependencies[pair].lossless == lossless, pair
    star = rel.star_schema(df, relations)
    again = sorted(map(repr, star.rebuild().collect()))
    assert again == sorted(map(repr, df.collect()))
    assert all(name not in star.fact.columns for name in star.keeper_of)


def test_slice_never_decides_alone(spark):
    """A single repeat outside the slice is still found."""
    n = 5000
    df = spark.range(n).selectExpr("id", "CASE WHEN id = 77 THEN 78 ELSE id END AS nearly")
    assert primary_key_candidates(df) == ["id"]
    assert unique_columns(df, ["id", "nearly"]) == ["id"]
    relations = rel.find_relations(df)
    assert ("nearly", "id") not in relations.dependencies
    assert ("id", "nearly") in relations.dependencies


def test_hot_value_dependency(spark):
    """A third of the rows under one value."""
    df = spark.range(3000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS k", "CASE WHEN id % 3 = 0 THEN 'x' ELSE 'y' END AS v"
    )
    relations = rel.find_relations(df)
    assert ("k", "v") in relations.dependencies
    assert ("v", "k") not in relations.dependencies
    assert relations.keys == []


def test_empty_table(spark):
    df = spark.createDataFrame([], "a int, b string")
    relations = rel.find_relations(df)
    assert relations.keys == [] and relations.dependencies == {}
    star = rel.star_schema(df)
    assert star.lookups == {} and star.fact.columns == ["a", "b"]
    assert rel.column_relationships(df).where("kind <> 'none'").isEmpty()


def test_lossy_pair_stays_in_fact(spark):
    df = spark.createDataFrame(
        [(1, "x", 9), (1, None, 9), (2, "y", 8), (2, "y", 8), (None, "z", 7)], "a int, b string, c int"
    )
    star = rel.star_schema(df)
    assert "b" not in star.keeper_of
    assert sorted(map(repr, star.rebuild().collect())) == sorted(map(repr, df.collect()))


def test_positional_mapping_by_first_appearance(spark, rows):
    df = spark.createDataFrame(
        [(1, "p", "x"), (2, "q", "x"), (3, "p", None), (4, "r", "z"), (5, None, "y")],
        "n int, a string, b string",
    )
    assert rows(rel.positional_mapping(df, "a", "b", "n")) == [
        (1, "p", "x"), (2, "q", "z"), (3, "r", "y"),
    ]


def test_equality_of_eighty_columns(spark):
    from tablewright.operators.profile import pairwise_equality

    wide = spark.range(50).select(*[(F.col("id") % (i % 7 + 1)).alias(f"w{i}") for i in range(80)])
    found = {(r.col1, r.col2): r for r in pairwise_equality(wide).collect()}
    assert len(found) == 80 * 79 // 2
    for i, j in ((0, 7), (3, 79), (1, 2)):
        same = sum(n % (i % 7 + 1) == n % (j % 7 + 1) for n in range(50))
        assert found[f"w{i}", f"w{j}"].n_equal == same
        assert found[f"w{i}", f"w{j}"].identical == (same == 50)


#: Values of each kind of column; equal ones across kinds of numbers.
MIXED = {
    "bigint": [1, 2, None], "int": [1, 2, 3], "double": [1.0, 2.5, float("nan"), -0.0, None], "string": ["1", "a", None],
    "boolean": [True, False, None], "decimal(10,2)": [Decimal("1.00"), Decimal("2.50"), None],
    "date": [datetime.date(2020, 1, 1), None], "array<int>": [[1], [2], None],
}


def mixed_table(spark, columns, rows, seed=4):
    rng, kinds = random.Random(seed), list(MIXED)
    data = [tuple(rng.choice(MIXED[kinds[i % len(kinds)]]) for i in range(columns)) for _ in range(rows)]
    return spark.createDataFrame(data, ", ".join(f"c{i} {kinds[i % len(kinds)]}" for i in range(columns))).repartition(3)


@pytest.mark.parametrize("null_safe", [False, True])
def test_many_pairs_are_counted_as_few_are(spark, monkeypatch, null_safe):
    df = mixed_table(spark, 36, 300)
    assert 36 * 35 // 2 > profile.PAIRS_PER_PASS
    many = {tuple(r) for r in pairwise_equality(df, null_safe=null_safe).collect()}
    monkeypatch.setattr(profile, "PAIRS_PER_PASS", 1000)
    assert many == {tuple(r) for r in pairwise_equality(df, null_safe=null_safe).collect()}
    none = pairwise_equality(df.limit(0), null_safe=null_safe).collect()
    assert len(none) == 630 and all((r.n, r.n_equal, r.ratio, r.identical) == (0, 0, None, False) for r in none)


def test_many_columns_are_read_in_one_scan(spark, tmp_path):
    spark.range(2000).select(*[(F.xxhash64("id", F.lit(i // 3)) % (i % 9 + 2)).alias(f"c{i}") for i in range(138)]).write.parquet(
        str(tmp_path / "wide")
    )
    equal = pairwise_equality(spark.read.parquet(str(tmp_path / "wide")))
    plan = equal._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 1
    assert equal.count() == 138 * 137 // 2


@pytest.mark.parametrize("seed", range(12))
def test_units_hold_each_pair_once(seed):
    rng = random.Random(seed)
    names = [f"c{i}" for i in range(rng.randrange(2, 50))]
    share = rng.choice([0.02, 0.2, 1.0])
    pairs = [p for p in permutations(names, 2) if rng.random() < share]
    real = {n: rng.random() < 0.3 for n in names}
    if not pairs:
        return
    units = rel._units(pairs, real)
    assert sorted((u.determinant, b) for u in units for b in [*u.wholes, *u.reals]) == sorted(pairs)
    assert all(not real[b] for u in units for b in u.wholes) and all(real[b] for u in units for b in u.reals)
    width = sum(max(len(u[k]) for u in units) for k in (1, 2))
    most = sum(max(sum(a == n and real[b] is kind for a, b in pairs) for n in names) for kind in (False, True))
    assert width <= most and len(units) <= len(pairs)


def test_few_live_pairs_of_many_columns(spark):
    """Of 60 columns few fix others; the full pass carries just those."""
    names = [f"c{i}" for i in range(60)]
    # blocks of three: a finer column fixes a coarser one, by hash otherwise
    df = spark.range(4000).select(
        *[(F.floor(F.pmod(F.xxhash64("id", F.lit(i // 3)), F.lit(96)) / 2 ** (i % 3)) + 0.5 * (i % 2)).alias(n) for i, n in enumerate(names)]
    )
    pairs = list(permutations(names, 2))
    live = [p for p in pairs if int(p[0][1:]) // 3 == int(p[1][1:]) // 3 and p[0] < p[1]]
    live += [(names[i], names[(i + 7) % 60]) for i in range(60)]
    real = dict.fromkeys(names, True)
    cells = sum(max(len(u.reals) for u in rel._units(live, real)) for _ in rel._units(live, real))
    assert cells < 4 * len(live)
    found = rel.exact_dependencies(df, live)
    assert set(found) == {p for p in live if int(p[0][1:]) // 3 == int(p[1][1:]) // 3 and int(p[0][1:]) < int(p[1][1:])}


def test_mixed_dependencies_against_brute_force(spark):
    df = mixed_table(spark, 16, 40, seed=8).withColumn("id", F.monotonically_increasing_id())
    df = df.withColumn("half", (F.col("c1") * 2.5).cast("double")).withColumn("day", F.expr("date_add(DATE'2020-01-01', c1)")).cache()
    flat = [c for c, t in df.dtypes if not t.startswith("array")]
    rows = [r.asDict() for r in df.collect()]
    clean = lambda v: None if v != v else v

    def holds(a, b):
        met, any_ = {}, False
        for r in rows:
            x, y = clean(r[a]), clean(r[b])
            if x is not None and y is not None:
                any_ = True
                if met.setdefault(x, y) != y:
                    return False
        return any_

    pairs = list(permutations(flat, 2))
    assert set(rel.exact_dependencies(df, pairs)) == {p for p in pairs if holds(*p)}
    df.unpersist()
