from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tablewright.functions.fragments import balance_fragment
from tablewright.operators import xml_ops
from tablewright.operators.schema_ops import flatten_nested
from tablewright.operators.xml_ops import (
    find_shapes,
    flatten_xml_columns,
    nested_xml_columns,
    repair_xml,
    xml_fragment_to_long,
)

FRAGMENTS = [
    ('<Id type="x">012</Id><Name> bob </Name>', {"id": ["012"], "id@type": ["x"], "name": ["bob"]}),
    ('<A b="1"/><A b="2"/>', {"a@b": ["1", "2"]}),
    ("<Id>1</Id><Id>2</Id><N>x</N>", {"id": ["1", "2"], "n": ["x"]}),
    ("<S><T>x</T></S>", {"s": ["x"]}),
    ("<S><T>x</T><U>y</U></S>", {}),
    ("<S><T>x</T><U/></S>", {}),
    ("<S> <T>x</T></S>", {}),
    ('<S q="1"><T z="2">x</T></S>', {"s": ["x"], "s@q": ["1"]}),
    ('<S><T a="1"><U b="2">0042</U></T></S>', {"s": ["0042"]}),
    ("<S>pre<T>x</T>post</S>", {}),
    ("<Id>a &lt; b &amp; \"c\\d</Id>", {"id": ['a < b & "c\\d']}),
    ("<S>&lt;T&gt;x&lt;/T&gt;</S>", {"s": ["<T>x</T>"]}),
    ("<Id><![CDATA[0012]]></Id>", {"id": ["0012"]}),
    ('<Id e=""/>', {"id@e": [""]}),
    ("<Id>  </Id><Id/>", {}),
    ("<Ok>true</Ok><D>2020-01-01</D><F>1e3</F>", {"ok": ["true"], "d": ["2020-01-01"], "f": ["1e3"]}),
    ("plain text", {}),
    ("", {}),
    (None, {}),
]


def test_long_form(spark):
    df = spark.createDataFrame([(i, f) for i, (f, _) in enumerate(FRAGMENTS)], "i int, x string")
    found: dict[int, dict[str, dict[int, str]]] = {}
    for r in xml_fragment_to_long(df, "i", "x").collect():
        found.setdefault(r.i, {}).setdefault(r.key, {})[r.pos] = r.value
    for i, (fragment, want) in enumerate(FRAGMENTS):
        got = {k: [v[p] for p in sorted(v)] for k, v in found.get(i, {}).items()}
        assert got == want, fragment


DEEP = {'<S><T a="1"><U b="2">0042</U></T></S>'}


@pytest.mark.parametrize("deep", [False, True])
def test_flat_form_agrees_with_long_form(spark, deep):
    """The cheap way and the general way, over all fragments together."""
    chosen = [f for f, _ in FRAGMENTS if deep or f not in DEEP]
    df = spark.createDataFrame(list(enumerate(chosen)), "i int, aXml string")
    shapes, broken = find_shapes(df, ["aXml"])
    assert shapes[0].general == deep and broken == []
    flat = flatten_xml_columns(df, mode="all")
    wanted = dict(FRAGMENTS)
    keys = {k for f in chosen for k in wanted[f]}
    assert set(flat.columns) == {"i", *keys}
    for r in flat.collect():
        got = {k: r[k] for k in keys if r[k] is not None}
        assert got == wanted[chosen[r.i]], chosen[r.i]


@pytest.mark.parametrize("fragment", [f for f, _ in FRAGMENTS if f])
def test_keys_of_one_fragment(spark, fragment):
    df = spark.createDataFrame([(1, fragment)], "i int, aXml string")
    flat = flatten_xml_columns(df, mode="all")
    want = dict(FRAGMENTS)[fragment]
    assert set(flat.columns) == {"i", *want}
    assert {k: flat.first()[k] for k in want} == want


def test_later_xml_overrides(spark, rows):
    df = spark.createDataFrame(
        [("z", "<Name>q</Name><K>1</K>", "<K>2</K>"), ("z", None, None)],
        "name string, aXml string, bXml string",
    )
    flat = flatten_xml_columns(df)
    assert flat.columns == ["name", "k"]
    assert rows(flat) == [("q", "2"), ("z", None)]
    every = flatten_xml_columns(df, mode="all")
    assert rows(every) == [(["q"], ["2"]), (["z"], None)]


def test_malformed_is_repaired(spark, rows):
    df = spark.createDataFrame([(1, "<Id>7"), (2, "<Id>8</Id>")], "i int, aXml string")
    assert rows(flatten_xml_columns(df)) == [(1, "7"), (2, "8")]
    assert rows(flatten_xml_columns(df, repair=False)) == [(1, None), (2, "8")]
    fine = df.where("i = 2")
    assert repair_xml(fine, "aXml") is fine


def test_no_keys_and_no_rows(spark):
    df = spark.createDataFrame([], "i int, aXml string")
    assert flatten_xml_columns(df).columns == ["i"]
    bad = spark.createDataFrame([(1, "<"), (2, None)], "i int, aXml string")
    assert flatten_xml_columns(bad).columns == ["i"]


def test_names_that_differ_by_case(spark):
    df = spark.createDataFrame([("z", "<Name>q</Name>")], "Name string, aXml string")
    flat = flatten_xml_columns(df)
    assert flat.columns == ["Name", "name_2"]
    assert tuple(flat.first()) == ("z", "q")


@pytest.mark.parametrize(
    ("broken", "whole"),
    [
        ("<Id>7", "<Id>7</Id>"),
        ("<Script>a<Id>7</Id>", "<Script>a<Id>7</Id></Script>"),
        ("<Title>x<b Q=1>y", '<Title>x<b Q="1">y</b></Title>'),
        ("<a><![CDATA[1 < 2]]><b>", "<a>1 &lt; 2<b></b></a>"),
        ("<a><b>1</a>", "<a><b>1</b></a>"),
        ("</x><a q=3>5 < 6</a>", '<a q="3">5 &lt; 6</a>'),
        ("<a>\x01&amp;", "<a>&amp;</a>"),
        ("<Id>2</Id", "<Id>2</Id>"),
        ("<Id>2</", "<Id>2</Id>"),
        ("<Id>2<", "<Id>2</Id>"),
        ('<A>1</A><B x="2"', "<A>1</A>"),
        ('<A>1</A><B x="2', "<A>1</A>"),
        ('<A>1</A><B x="2>3', "<A>1</A>"),
        ("<A>1</A><B", "<A>1</A>"),
        ("<A>1<!-- so", "<A>1</A>"),
        ("<A>1 < 2", "<A>1 &lt; 2</A>"),
        ("<", ""),
    ],
)
def test_balance(broken, whole):
    assert balance_fragment(broken) == whole


def test_flatten_nested(spark, rows):
    df = spark.sql(
        "SELECT 1 AS i, named_struct('t', 'x', 'u', named_struct('v', 2)) AS s, array(1, 2) AS a,"
        " array('p') AS b, map('k', 1) AS m"
    )
    assert rows(flatten_nested(df, arrays="explode")) == [
        (1, "x", 2, 1, "p", '{"k":1}'),
        (1, "x", 2, 2, None, '{"k":1}'),
    ]
    assert flatten_nested(df).columns == ["i", "s_t", "s_u_v", "a", "b", "m"]
    assert rows(flatten_nested(df, arrays="first"))[0][3:5] == (1, "p")


def test_only_broken_rows_need_python(spark, capsys):
    df = spark.createDataFrame([(1, "<Id>7</Id>")], "i int, aXml string")
    flatten_xml_columns(df).explain()
    assert "Python" not in capsys.readouterr().out


@pytest.mark.parametrize("exact", ["true", "false"])
def test_nested_names_that_clash(spark, rows, exact):
    before = spark.conf.get("spark.sql.caseSensitive")
    spark.conf.set("spark.sql.caseSensitive", exact)
    try:
        df = spark.createDataFrame([(1, "<Id>2</Id><S><T>3</T></S><s_t>4</s_t>")], "id int, aXml string")
        flat = nested_xml_columns(df, "aXml")
        assert flat.columns == ["id", "id_2", "s_t", "s_t_2"]
        assert sorted(rows(flat)[0][1:]) == ["2", "3", "4"] and rows(flat)[0][:2] == (1, "2")
        both = spark.sql("SELECT 1 AS i, named_struct('X', 2, 'x', 3) AS a")
        flat = flatten_nested(both)
        assert flat.columns == (["i", "a_X", "a_x"] if exact == "true" else ["i", "a_X", "a_x_2"])
        assert rows(flat) == [(1, 2, 3)]
    finally:
        spark.conf.set("spark.sql.caseSensitive", before)


def test_truncated_ends_leave_no_text_behind(spark, rows):
    df = spark.createDataFrame([(1, "<Id>2</Id"), (2, '<Id>3</Id><B x="2"'), (3, "<Id>4</Id>")], "i int, aXml string")
    assert flatten_xml_columns(df).columns == ["i", "id"]
    assert rows(flatten_xml_columns(df)) == [(1, "2"), (2, "3"), (3, "4")]


def awkward_rows():
    """Good, bad and missing fragments in two columns; repeated bad rows; a map, which can't be grouped."""
    out = [(i, f"t{i}", f"<N>{i}</N><M a='{i}'/>" if i % 7 else None, f"<K>{i}</K>" if i % 5 else "<K>5<L") for i in range(60)]
    return out + [(100, "same", "<N>bad", "<K>1</K>"), (100, "same", "<N>bad", "<K>1</K>"), (101, "x", "<N>a<!-- c -->b</N>", None)]


@pytest.mark.parametrize("with_map", [False, True])
@pytest.mark.parametrize("mode", ["first", "all"])
def test_bad_rows_are_read_apart(spark, rows, with_map, mode):
    schema = "i int, `a-b` string, aXml string, bXml string"
    df = spark.createDataFrame(awkward_rows(), schema).repartition(3)
    mended = repair_xml(df, "aXml", "bXml")
    if with_map:
        # rows with maps can't be written down beside the shapes, and go the longer way
        df, mended = (x.withColumn("m", F.create_map(F.lit("k"), F.col("i"))) for x in (df, mended))
    got, want = (sorted(map(str, flatten_xml_columns(x, mode=mode).collect())) for x in (df, mended))
    assert got == want and len(got) == 63
    bare = flatten_xml_columns(df, mode=mode, repair=False)
    assert bare.count() == 63 and bare.where("k IS NULL").count() == 13


def test_good_rows_are_parsed_once(spark, tmp_path):
    """With malformed fragments the table is scanned once for shapes, and once to be read, as without."""
    spark.createDataFrame(awkward_rows()[:62], "i int, t string, aXml string, bXml string").write.parquet(str(tmp_path / "t"))
    flat = flatten_xml_columns(spark.read.parquet(str(tmp_path / "t")))
    plan = flat._jdf.queryExecution().executedPlan().toString()
    assert plan.count(f"{tmp_path}/t") == 1
    optimized = flat._jdf.queryExecution().optimizedPlan().toString()
    assert optimized.count("from_xml") + optimized.count("xmltostructs") <= 4  # two columns of good rows, two of bad ones


def test_fragments_of_one_task_are_dealt_to_all(spark):
    frame = spark.range(0, 20_000, 1, 1).selectExpr("id", "concat('<Item>', array_join(transform(sequence(1, 20), i -> sha2(concat(id, ' ', i), 256)), ''), '</Item>') AS InfoXml")
    long = xml_fragment_to_long(frame, "id", "InfoXml", repair=False)
    assert long.rdd.getNumPartitions() > 1
    assert long.count() == 20_000


@pytest.mark.parametrize("fragment", ["<a>", "<a/></b>", "x", "", "<a>1</a><a", "<a b=1/>", "&", "<!-- c --><a/>", "<![CDATA[<]]>", "<a>é</a>"])
def test_the_check_agrees_with_the_parse(spark, fragment):
    row = spark.createDataFrame([(fragment,)], "f string")
    checked, corrupt = row.select(xml_ops.is_malformed(F.col("f")), xml_ops._parsed(F.col("f"))["_corrupt_record"]).first()
    assert checked == (corrupt is not None)


# Fragments that regular expressions can read, and those that they must leave to the parser.
COMMON = [
    '<Id type="x">012</Id><Name> bob </Name>', '<A b="1"/><A b="2"/>', "<S><T>x</T><U>y</U></S>", "<S> <T>x</T></S>",
    '<S q="1"><T z="2">x</T></S>', '<S><T a="1"><U b="2">0042</U></T></S>', "<S>pre<T>x</T></S>", "<a>x\ny</a >", "<a></a>",
    '<a b="c=d"/>', '<a b="x/y"/>', "<a>it's \"q\"</a>", "<a><b/></a>", '<a><b c="1"/></a>', "<a>1</a><a/><a>2</a>",
    '<a b="1" B2="2"/>', "<r>1</r><q>2</q>", "<a>\u00a0x\u3000</a>", '<a b=""/>', "<a>é \U0001f600</a>", "<a.b-c_d>1</a.b-c_d>",
]
OTHER = [
    "<tag>1</tag><Tag>2</Tag>", '<a B="1" b="2"/>', '<a b="1" b="2"/>', '<a b="1 b=" c="x"/>', '<a b="= "/>', "<a b='1'>2</a>",
    '<a b="&amp;"/>', '<a b="x\ty"/>', "<a>\r\nx</a>", '<a xmlns="u">1</a>', '<a xml:lang="e">1</a>', "<p:a>1</p:a>", "<é>1</é>",
    "<a>1</b>", "<a>", "<a/>x", " <a>1</a>", "<a><b><c><d>5</d></c></b></a>", "<a>\x01</a>", "<a>\ue000x</a>", "<1a>x</1a>",
    '<a b=" x"/>', "<a><![CDATA[1]]></a>", "<a>1<!-- c --></a>", "", "text", None, "<a>" + "<b/>" * 5000 + "</a>",
]


def test_common_fragments_are_read_as_the_parser_reads_them(spark):
    df = spark.createDataFrame([(f,) for f in COMMON + OTHER], "f string")
    fragment = F.col("f")
    for r in df.select("f", xml_ops.fragment_pairs(fragment).alias("a"), xml_ops._pairs(xml_ops._parsed(fragment)).alias("b")).collect():
        a, b = (None if p is None else sorted(p, key=lambda q: q.key) for p in (r.a, r.b))
        assert a == b, r.f


def test_common_fragments_need_no_parser(spark, monkeypatch):
    none = F.lit(None).cast("array<struct<key:string,value:string>>")
    monkeypatch.setattr(xml_ops, "_pairs", lambda parsed: none)
    read = xml_ops.fragment_pairs(F.col("f")).isNotNull()
    assert spark.createDataFrame([(f,) for f in COMMON], "f string").where(read).count() == len(COMMON)
    assert spark.createDataFrame([(f,) for f in OTHER], "f string").where(read).count() == 0


@pytest.mark.parametrize(
    ("fragment", "skeleton"),
    [
        ("x<a/>", "x<a/>"),
        (" <a b='1'>it's</a>y's", '\ue000<a b="">x</a>x'),
        ("<a b=\"1>2\" c='x'>q > r</a>", '<a b="" c="">x</a>'),
        ("<a/><a/><a/><b><c>1</c><c>2</c><c>3</c></b>", "<a/><a/><b><c>x</c><c>x</c></b>"),
        ('<a>\u00a0</a><b></b><c x=\'"\'/>', '<a>\ue000</a><b></b><c x=""/>'),
        ('<a>"x"</a><b>"</b>\n<c>$1\\</c>', "<a>x</a><b>x</b>\ue000<c>x</c>"),
    ],
)
def test_skeleton(spark, fragment, skeleton):
    assert spark.createDataFrame([(fragment,)], "f string").select(xml_ops._skeleton(F.col("f"))).first()[0] == skeleton
