from __future__ import annotations

import csv
import json
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tablewright.plans import clean_table, flatten_folder, merge_tables, slim_table
from tablewright import session as sessions
from tablewright.session import clear_stages, materialize, scratch_root
from tablewright.sources import (
    read_delimited,
    read_folder_union,
    read_id_list,
    read_id_response_log,
    read_text_table,
    read_xml_batches,
    write_csv,
    write_cycle_dumps,
    write_id_list,
    write_tsv,
)
from tablewright.sources.delimited import BlockReader, LineEnds, _cut
from tablewright.sources.staging import add_folders, folders_in, hidden_folder, read_note, write_note
from tablewright.streaming import flatten, read_flattened, stream_flatten


def test_scratch_folder_is_the_one_the_session_names(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")
    df = spark.range(3).select("id", F.lit("x").alias("tag@attr"))
    assert materialize(df).where("`tag@attr` = 'x'").count() == 3


def test_stages_can_be_deleted(spark, monkeypatch):
    monkeypatch.setattr(sessions, "_WRITTEN", [])
    before = materialize(spark.range(3))
    (file,) = {f.rpartition("/")[0] for f in before.inputFiles()}
    assert clear_stages(spark) == 1 and clear_stages(spark) == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(file)


def test_folder_with_mixed_headers(spark, tmp_path, rows):
    (tmp_path / "a.tsv").write_text('x,y\n1,"p ""q"", r"\n')
    (tmp_path / "b.tsv").write_text('y,z\n2,"line\nbreak"\n')
    (tmp_path / "c.txt").write_text("x\n9\n")
    table = read_folder_union(spark, str(tmp_path))
    assert rows(table.select("x", "y", "z")) == [("1", 'p "q", r', None), (None, "2", "line\nbreak")]
    with pytest.raises(FileNotFoundError):
        read_folder_union(spark, str(tmp_path), ".none")


def test_encoding_is_decided_per_file(spark, tmp_path, rows):
    (tmp_path / "utf8.tsv").write_bytes("k\tv\n1\tä\n".encode())
    (tmp_path / "latin.tsv").write_bytes("k\tv\n2\tö\n3\tNA\n".encode("latin-1"))
    assert rows(read_text_table(spark, str(tmp_path))) == [("1", "ä"), ("2", "ö"), ("3", None)]


def test_id_lists(spark, tmp_path, rows):
    for db, ids in (("sra", ["1", "2"]), ("gds", ["7"])):
        (tmp_path / db).mkdir()
        (tmp_path / db / f"{db}_Hs_Ids.json").write_text(json.dumps(ids, indent=2 if db == "sra" else None))
    paths = [str(tmp_path / db / f"{db}_Hs_Ids.json") for db in ("sra", "gds")]
    assert rows(read_id_list(spark, paths)) == [("gds", "7"), ("sra", "1"), ("sra", "2")]


def test_response_log(spark, tmp_path, rows):
    pages = [{"Count": "3", "IdList": ["5", "4"]}, {"Count": "3", "IdList": ["6"]}]
    (tmp_path / "log.json").write_text("".join(json.dumps(p, indent=2) + "\n\n" for p in pages))
    assert rows(read_id_response_log(spark, str(tmp_path / "log.json"))) == [(0, "4"), (0, "5"), (1, "6")]


def test_xml_batches(spark, tmp_path):
    (tmp_path / "batch_0.xml").write_text('<Set><R a="1"><N>x</N></R><R a="2"><N>y</N></R></Set>')
    table = read_xml_batches(spark, str(tmp_path), "R")
    assert {(r["_a"], r["N"]) for r in table.collect()} == {(1, "x"), (2, "y")}


def test_existing_id_lists_are_left_alone(spark, tmp_path):
    path = str(tmp_path / "ids")
    ids = spark.createDataFrame([("a", "1"), ("b", "2")], "db string, id string")
    write_id_list(ids.where("db = 'a'"), path)
    landed = spark.read.json(path).select("db")
    write_id_list(ids.unionAll(ids.where("db = 'a'")), path, landed)
    assert sorted((r.db, r.id) for r in spark.read.json(path).collect()) == [("a", 1), ("b", 2)] or sorted(
        (r.db, r.id) for r in spark.read.json(path).collect()
    ) == [("a", "1"), ("b", "2")]


def test_cycle_dumps(spark, tmp_path):
    path = str(tmp_path / "cycles")
    write_cycle_dumps(spark.range(10).selectExpr("'d' AS db", "id"), path, 2, 2, ["id"])
    assert sorted(p.name for p in (tmp_path / "cycles").glob("cycle=*")) == ["cycle=0", "cycle=1", "cycle=2"]


def test_clean_table_writes_star(spark, tmp_path):
    df = spark.range(200).selectExpr(
        "id",
        "concat(' City ', id % 5, ' ') AS city",
        "concat('CITY ', id % 5) AS town",
        "id % 5 AS city_id",
        "CAST(NULL AS STRING) AS empty",
    )
    cleaned = clean_table(df, str(tmp_path / "out"))
    assert cleaned.sparse == ["empty"]
    assert cleaned.identical == ["town"]  # equal once lower-cased and stripped
    assert cleaned.relations.keys == ["id"]
    assert cleaned.star.fact.columns == ["id", "city"]
    assert spark.read.parquet(str(tmp_path / "out" / "fact" / "MetaData")).count() == 200
    assert spark.read.parquet(str(tmp_path / "out" / "lookup_1")).count() == 5


def test_text_variants_are_not_lost(spark):
    """Relations found on tidied text only split columns that also hold as written."""
    df = spark.createDataFrame(
        [(1, "A", "x"), (2, "a", "y"), (3, "B", "z"), (4, "b", "z")] * 2, "id int, k string, v string"
    )
    df = df.selectExpr("id", "k", "v", "lower(k) AS low", "CASE WHEN k = 'A' THEN 'U' ELSE 'u' END AS flag")
    star = clean_table(df).star
    kept = [c for c in df.columns if c in star.columns]
    assert sorted(map(repr, star.rebuild().collect())) == sorted(map(repr, df.select(*kept).collect()))


def test_merge_and_flatten_files(spark, tmp_path, rows):
    write_tsv(spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), str(tmp_path / "l"))
    write_tsv(spark.createDataFrame([(2, "c"), (3, "d")], "k2 int, w string"), str(tmp_path / "r"))
    merged = merge_tables(spark, [str(tmp_path / "l"), str(tmp_path / "r")], str(tmp_path / "m"))
    assert rows(merged.table) == [(1, "a", None), (2, "b", "c"), (3, None, "d")]
    dumps = tmp_path / "dumps"
    dumps.mkdir()
    (dumps / "one.tsv").write_text('Id,Item,ExtraXml\n1,drop,"<N a=""2"">x</N>"\n')
    flat = flatten_folder(spark, str(dumps), str(tmp_path / "flat"))
    assert flat.columns == ["Id", "n", "n@a"]
    assert rows(flat) == [("1", "x", "2")]


def test_slim_table(spark):
    df = spark.range(100).selectExpr("id", "id AS again", "CAST(NULL AS INT) AS none")
    slim = slim_table(df)
    assert (slim.sparse, slim.similar, slim.table.columns) == (["none"], ["again"], ["id"])
    assert slim.sample.count() == 5


def test_stream_resumes_without_repeats(spark, tmp_path, rows):
    folder = tmp_path / "in"
    folder.mkdir()

    def land(name, ids):
        lines = [f'{i},"<N>V{i}</N>"' for i in ids]
        (folder / name).write_text("id,aXml\n" + "\n".join(lines) + "\n")

    def run():
        stream_flatten(
            spark, str(folder), "id string, aXml string", str(tmp_path / "out"), str(tmp_path / "state"), ["n"]
        ).awaitTermination()
        return rows(spark.read.parquet(str(tmp_path / "out")))

    land("a.tsv", [1, 2])
    assert run() == [("1", "v1"), ("2", "v2")]
    land("b.tsv", [2, 3])
    assert run() == [("1", "v1"), ("2", "v2"), ("3", "v3")]


# ---- quoted files in pieces

CELLS = ["plain", 'with "quotes"', "line\nbreak", "", "a\r\n\"b\"\n\n,c", "x" * 300, '"', "\n\n", "é", ",", " \"pad\""]


@pytest.fixture
def small_blocks(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]
    for n in names:
        spark.conf.set(n, "200")
    yield
    for n, v in zip(names, before):
        spark.conf.set(n, v)


def quoted_file(path, header, rows, sep=",", end="\n", encoding="utf-8"):
    with open(path, "w", newline="", encoding=encoding) as f:
        writer = csv.writer(f, delimiter=sep, lineterminator=end)
        writer.writerow(header)
        writer.writerows(rows)


def test_quoted_files_are_cut_into_blocks(spark, tmp_path, small_blocks):
    rng = random.Random(1)
    rows = [(str(i), rng.choice(CELLS), rng.choice(CELLS), "z") for i in range(500)]
    rows.append(("big", "two\nlines\n" * 400, '"' * 500, "z"))  # a cell longer than many blocks
    quoted_file(tmp_path / "a.csv", ["id", "te\nxt", "more", "end"], rows)
    got = read_delimited(spark, [str(tmp_path / "a.csv")], ",")
    assert got.columns == ["id", "te\nxt", "more", "end"]
    assert {tuple(r) for r in got.collect()} == {tuple(c or None for c in r) for r in rows}
    assert got.count() == len(rows)
    # as Spark's own reader has it, which keeps the file in one task
    whole = spark.read.options(header=True, multiLine=True, escape='"').csv(str(tmp_path / "a.csv"))
    normal = lambda df: sorted(tuple((c or "").replace("\r\n", "\n") for c in r) for r in df.collect())
    assert normal(got) == normal(whole)
    lines = spark.read.option("lineSep", "\n").text(str(tmp_path / "a.csv"))
    assert lines.rdd.getNumPartitions() > 50


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_files_with_headers_of_their_own(spark, tmp_path, small_blocks, end):
    one = [(str(i), "v\n" * (i % 4)) for i in range(60)]
    two = [(f"é{i}", str(i), "") for i in range(60)]
    quoted_file(tmp_path / "1.tsv", ["id", "text"], one, "\t", end)
    quoted_file(tmp_path / "2.tsv", ["text", "id", "last"], two, "\t", end, "latin-1")
    (tmp_path / "3.tsv").write_bytes(b"\xef\xbb\xbfid\ttext" + end.encode())
    (tmp_path / "4.tsv").write_bytes(end.encode() * 3)
    got = read_text_table(spark, str(tmp_path))
    assert got.columns == ["id", "text", "last"]
    want = [(a, b or None, None) for a, b in one] + [(b, a, None) for a, b, _ in two]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_cells_beyond_the_header(spark, tmp_path, rows):
    (tmp_path / "a.csv").write_text('x,y\n1,2\n3\n4,"5\n",6,"7,8"\n\n9,10,\n')
    path = [str(tmp_path / "a.csv")]
    with pytest.raises(Exception, match="more cells than the header"):
        read_delimited(spark, path, ",").count()
    assert rows(read_delimited(spark, path, ",", surplus=None)) == [("1", "2"), ("3", None), ("4", "5\n"), ("9", "10")]
    named = {r.x: r.rest for r in read_delimited(spark, path, ",", surplus="rest").collect()}
    assert named == {"1": None, "3": None, "4": ["6", "7,8"], "9": [""]}
    with pytest.raises(ValueError):
        read_delimited(spark, path, ",", surplus="Y")


def test_headers_with_repeated_and_missing_names(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,X,,y\n1,2,3,4\n")
    own = spark.read.options(header=True).csv(str(tmp_path / "a.csv"))
    assert read_delimited(spark, [str(tmp_path / "a.csv")], ",").columns == own.columns
    (tmp_path / "none.csv").write_text("")
    assert read_delimited(spark, [str(tmp_path / "none.csv")], ",").columns == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text('a",\n', max_size=6), min_size=1, max_size=12), st.lists(st.integers(0, 60), max_size=5))
def test_blocks_agree_with_reading_in_one_go(parts, cuts):
    """However lines are dealt to blocks, the case that holds cuts the records that one reader cuts."""
    lines = "\n".join(parts).encode().split(b"\n")
    ends = LineEnds(",")
    want, inside = [], False
    for line in lines:
        want = want + [line] if not inside else [*want[:-1], want[-1] + b"\n" + line]
        inside = ends.open_after(line, inside)
    edges = sorted({0, len(lines), *(min(c, len(lines)) for c in cuts)})
    got, inside, is_open = [], False, False
    for a, b in zip(edges, edges[1:]):
        reader = BlockReader(ends, a == 0)
        pieces = [p for p in (reader.feed(x, True) for x in lines[a:b]) if p]
        *rest, last = reader.end()
        case = 3 if inside else 1
        for piece in [*pieces, *rest]:
            if piece[case] == piece[0]:
                got.append(piece[5])
            else:
                got[-1] += b"\n" + piece[5]
        inside = not last[case + 1]
    drop = lambda records: [r for r in records if r]
    assert drop(got) == drop(want)


# ---- streams without state, and writes that can be repeated


@pytest.fixture
def landing(spark, tmp_path):
    """Functions that land a file of records, run the stream, and read what it wrote."""
    folder = tmp_path / "in"
    folder.mkdir()
    out, state = str(tmp_path / "out"), str(tmp_path / "state")

    def land(name, records):
        quoted_file(folder / name, ["id", "aXml"], records)

    def run(keys=None, **options):
        stream_flatten(spark, str(folder), "id string, aXml string", out, state, keys, **options).awaitTermination()
        return read_flattened(spark, out, state) if keys is None else spark.read.parquet(out)

    return land, run, tmp_path


def test_keys_are_found_while_streaming(landing):
    land, run, _ = landing
    land("a.tsv", [("1", "<N>V1</N>")])
    land("b.tsv", [("2", "<N>V2</N>")])
    assert run(files_per_batch=1).columns == ["id", "n"]
    land("c.tsv", [("3", '<N>V3</N><Late a="X">y</Late>'), ("1", "<N>again</N>")])
    land("d.tsv", [("4", "<Late>z")])  # truncated, and without the first key
    got = run(files_per_batch=1)
    assert got.columns == ["id", "n", "late", "late@a"]
    want = [("1", "v1", None, None), ("2", "v2", None, None), ("3", "v3", "y", "x"), ("4", None, "z", None)]
    assert sorted(map(tuple, got.collect())) == want


def test_a_batch_that_failed_halfway_is_run_again(landing, monkeypatch):
    land, run, where = landing
    land("a.tsv", [(str(i), f"<N>{i}</N>") for i in range(20)])
    assert run(["n"]).count() == 20
    land("b.tsv", [(str(i), f"<N>{i}</N>") for i in range(10, 40)])
    move = flatten.add_files

    def die(*args):
        move(*args)
        raise RuntimeError("killed behind the move")

    monkeypatch.setattr(flatten, "add_files", die)
    with pytest.raises(Exception, match="killed"):
        run(["n"])
    monkeypatch.setattr(flatten, "add_files", move)
    assert sorted(int(r.id) for r in run(["n"]).collect()) == list(range(40))
    assert not (where / "out" / "_staging" / "batch-000000001").exists()


def test_streams_keep_no_state(landing):
    land, run, where = landing
    for k in range(6):
        land(f"{k}.tsv", [(str(i), f"<N>{i}</N>") for i in range(5 * k, 5 * k + 10)] + [("", "<N>x</N>")])
    assert sorted(int(r.id or -1) for r in run(["n"], files_per_batch=1).collect()) == [-1, *range(35)]
    assert not (where / "state" / "state").exists()
    assert len(list((where / "out").glob("batch-*.parquet"))) >= 6


def test_lists_of_a_stopped_run_come_once(spark, tmp_path):
    path = str(tmp_path / "ids")
    ids = spark.range(100).selectExpr("concat('d', id % 4) AS db", "id")
    write_id_list(ids.where("db IN ('d0', 'd1')"), path)
    # a run that died while it wrote, and one that died between two moves
    ids.where("db = 'd2'").write.partitionBy("db").json(hidden_folder(path, "ids"))
    write_id_list(ids, path)
    write_id_list(ids, path)
    back = spark.read.json(path)
    assert sorted((r.db, r.id) for r in back.collect()) == sorted((r.db, r.id) for r in ids.collect())
    assert folders_in(spark, path) == ["db=d0", "db=d1", "db=d2", "db=d3"]
    write_cycle_dumps(ids, str(tmp_path / "cycles"), 5, 2, ["id"])
    write_cycle_dumps(ids, str(tmp_path / "cycles"), 5, 2, ["id"])
    assert spark.read.options(header=True).csv(str(tmp_path / "cycles")).count() == 100
    assert folders_in(spark, str(tmp_path / "none")) == [] and add_folders(spark, str(tmp_path / "none"), path) == []


def test_notes_survive_a_cut_short_move(spark, tmp_path):
    path = str(tmp_path / "note")
    assert read_note(spark, path) is None
    write_note(spark, path, "one é")
    write_note(spark, path, "two")
    assert read_note(spark, path) == "two"
    (tmp_path / "note").rename(tmp_path / "note.new")
    assert read_note(spark, path) == "two"


def _events(spark, path, n=20_000):
    """One file of records with line breaks in cells, which one task reads."""
    text = "array_join(transform(sequence(1, 20), i -> sha2(concat(id, ' ', i), 256)), '\n')"
    frame = spark.range(n).selectExpr("CAST(id AS STRING) AS id", f"concat('<Info>', {text}, '</Info>') AS aXml")
    write_csv(frame.coalesce(1), path)


def test_the_one_file_of_a_batch_is_dealt_to_all(spark, tmp_path, monkeypatch):
    _events(spark, f"{tmp_path}/in")
    staged = {}

    def noted(df, label="stage"):
        out = materialize(df, label)
        staged[label] = len(out.inputFiles())
        return out

    monkeypatch.setattr(flatten, "materialize", noted)
    out, state = f"{tmp_path}/out", f"{tmp_path}/state"
    stream_flatten(spark, f"{tmp_path}/in", "id string, aXml string", out, state, ["info"], suffix=".csv").awaitTermination()
    assert staged["stream-batch"] > 1
    assert spark.read.parquet(out).where("info IS NOT NULL").count() == 20_000


def test_a_folder_is_flattened_once(spark, tmp_path):
    _events(spark, f"{tmp_path}/in", 100)
    flat = flatten_folder(spark, f"{tmp_path}/in", f"{tmp_path}/flat", ".csv")
    assert "from_xml" not in flat._jdf.queryExecution().optimizedPlan().toString()  # what was written is read
    assert flat.where("info IS NOT NULL").count() == 100


def test_landed_ids_are_not_sent_to_every_task(spark, tmp_path, rows):
    spark.range(1000).selectExpr("cast(id AS string) AS id", "'x' AS v").write.parquet(f"{tmp_path}/out")
    fresh = spark.createDataFrame([("5",), ("1000",), (None,)], "id string")
    landed = flatten.landed_ids(spark, f"{tmp_path}/out", fresh.schema["id"], "batch-")
    left = flatten.not_landed(fresh, landed, "id")
    assert "Broadcast" not in left._jdf.queryExecution().executedPlan().toString()
    assert rows(left) == [("1000",), (None,)]


def test_a_record_is_parsed_once_for_all_its_cells(spark, tmp_path, rows):
    (tmp_path / "a.csv").write_text('a,b,c\n1,"x\ny",3\n4,5\n')
    (tmp_path / "b.csv").write_text("a,c\n6,7\n")
    table = read_folder_union(spark, str(tmp_path), ".csv")
    plan = table._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_csv(") + plan.count("csvtostructs(") == 2  # one for each width of a header
    assert rows(table) == [("1", "x\ny", "3"), ("4", "5", None), ("6", None, "7")]


def test_lines_of_many_blocks_in_one_task():
    import pyarrow as pa

    lines = [("f", 0, b"\xef\xbb\xbfa,b"), ("f", 0, b'1,"x'), ("f", 9, b'y"'), ("g", 0, b"a"), ("g", 0, b"\xff")]
    fields = [*map(list, zip(*lines)), [True, True, True, True, False]]
    kinds = [pa.string(), pa.int64(), pa.binary(), pa.bool_()]
    batch = pa.RecordBatch.from_arrays([pa.array(f, k) for f, k in zip(fields, kinds)], ["file", "block", "value", "ok"])
    for cuts in ([batch], [batch.slice(i, 1) for i in range(5)]):
        pieces = [r for b in _cut(",")(iter(cuts)) for r in b.to_pylist()]
        texts = [(r["file"], r["block"], r["text"]) for r in pieces if r["seq"] >= 0]
        assert texts == [("f", 0, b"a,b"), ("f", 0, b'1,"x'), ("f", 9, b'y"'), ("g", 0, b"a"), ("g", 0, b"\xff")]
        ends = [(r["file"], r["block"], r["valid"], r["first"]) for r in pieces if r["seq"] < 0]
        assert ends == [("f", 0, True, b"a,b"), ("f", 9, True, None), ("g", 0, False, b"a")]
