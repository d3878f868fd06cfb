"""Shared lines, spelling variants and filter audits against brute force."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import permutations
from pathlib import Path

import numpy as np
import oracle
import pytest
from conftest import AWKWARD, FOLDER
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tablewright.llm import filter_audit, line_dedup
from tablewright.llm.filter_audit import audit_filters, counting_sketch, mask_counts, possible_repeats, without
from tablewright.llm.line_dedup import DROP, HOLDER, OPEN, kept_lines, line_bitmaps
from tablewright.llm.queries import ORACLES, QUERIES
from tablewright.llm.spelling import count_words, letter_runs, near_words, slipped, spelling_forms

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}


@pytest.mark.skipif(not Path(FOLDER).is_dir(), reason="no test tables here")
@pytest.mark.parametrize("name", ["op11_spelling_forms", "op12_line_dedup", "op13_filter_audit"])
def test_query_matches_sql(spark, name):
    columns, got = oracle.of_frame(QUERIES[name](spark, FOLDER))
    want_columns, want = oracle.of_sql(oracle.connect(FOLDER), ORACLES[name])
    assert columns == want_columns
    assert got == want


# ---- lines


def lines_brute(rows, min_chars=20, min_docs=3):
    """doc_id, n_lines, n_dropped and text of every row."""
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    least = -(1 << 63)
    holders = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(least if doc is None else doc)
    out = Counter()
    for doc, text in rows:
        lines = (text or "").split("\n")
        own = least if doc is None else doc
        kept = [x for x in lines if len(holders.get(key(x), ())) < min_docs or own == max(holders[key(x)])]
        out[doc, len(lines), len(lines) - len(kept), "\n".join(kept)] += 1
    return out


def shared_lines():
    rng = random.Random(3)
    common = [f"this is the common line number {i} of the corpus" for i in range(8)]
    rows = []
    for doc in range(90):
        lines = [common[0]] * rng.randrange(3) + rng.choices(common, k=rng.randrange(6))
        lines += [f"a line that only document {doc} has in it", "short", "", "  " + common[0].upper() + "\r"]
        rng.shuffle(lines)
        rows.append((doc * 7 % 90, "\n".join(lines)))
    return rows


def lines_of(df, **options):
    kept = kept_lines(df, line_bitmaps(df, **options))
    return Counter((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in kept.collect())


@pytest.mark.parametrize("parts", [1, 7, 40])
def test_shared_lines_over_many_partitions(spark, parts):
    rows = shared_lines()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert lines_of(df, parts=parts) == lines_brute(rows)


def test_lines_of_awkward_rows(spark, make_docs, awkward, no_rows):
    assert lines_of(awkward, min_chars=1) == lines_brute([(r[0], r[1]) for r in AWKWARD], 1)
    assert lines_of(no_rows) == Counter()
    line = "one line that is in all of these documents"
    rows = [(1, line), (1, line), (1, "other\n" + line), (2, line), (None, line), (None, line), (None, None), (3, "\n\n"), (4, line + "x" * 300_000)]
    df = make_docs([(*r, None, None, None) for r in rows])
    assert lines_of(df) == lines_brute(rows)
    assert lines_of(df, min_docs=2) == lines_brute(rows, min_docs=2)
    with pytest.raises(ValueError):
        line_bitmaps(df, min_docs=1)


def test_bitmaps_say_which_lines_stay(spark):
    long = "\n".join(["a line that three documents have in common"] + [f"line {i} of the longest text" for i in range(20_000)])
    rows = [(1, long), (2, "a line that three documents have in common"), (3, "A line that three documents have in common ")]
    got = {r.doc: r for r in line_bitmaps(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    bits = np.unpackbits(np.frombuffer(zlib.decompress(got[1].keep), np.uint8), count=20_001)
    assert got[1].n_dropped == 1 and bits[0] == 0 and bits[1:].all() and len(got[1].keep) < 100
    assert (got[2].n_dropped, got[3].n_dropped) == (1, 0)


@settings(max_examples=60, deadline=None)
@given(
    st.lists(st.tuples(st.integers(0, 3), st.integers(0, 6), st.integers(0, 2)), max_size=40),
    st.lists(st.integers(0, 40), max_size=6),
    st.lists(st.integers(0, 40), max_size=6),
    st.integers(2, 4),
)
def test_streams_agree_however_lines_are_cut(lines, cuts, batches, min_docs):
    """Any cut into partitions and batches leads to the lines that counting all documents leads to."""
    rows = sorted({(key, doc, pos) for key, doc, pos in lines}, key=lambda r: (r[0], -r[1], r[2]))
    told = []
    edges = sorted({0, len(rows), *(min(c, len(rows)) for c in cuts)})
    for a, b in zip(edges, edges[1:]):
        stream = line_dedup._Stream(min_docs)
        inner = sorted({a, b, *(min(max(c, a), b) for c in batches)})
        for i, j in zip(inner, inner[1:]):
            told += stream.feed(np.array([(k, 0, d, 0, p) for k, d, p in rows[i:j]], dtype=np.int64).T)
        told += stream.finish()
    holders = defaultdict(set)
    for kind, r in told:
        if kind == HOLDER:
            for x in r.T.tolist():
                holders[x[0]].add(x[2])
    got = Counter()
    for kind, r in told:
        for k, _, d, _, p in r.T.tolist():
            if kind == DROP or kind == OPEN and len(holders[k]) >= min_docs and d != max(holders[k]):
                got[k, d, p] += 1
    docs = defaultdict(set)
    for k, d, _ in rows:
        docs[k].add(d)
    assert got == Counter(r for r in rows if len(docs[r[0]]) >= min_docs and r[1] != max(docs[r[0]]))


# ---- spelling


def near_brute(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def forms_brute(counts):
    near = {w: [v for v in counts if near_brute(w, v)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * counts[w] else None
    out = set()
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, counts[w], len(near[w]), None if form[w] is None else counts[form[w]]))
    return out


def forms_of(spark, counts, **options):
    rows = spelling_forms(spark.createDataFrame(counts, "word string, n long"), **options).collect()
    assert len(rows) == len({r.word for r in rows})
    return {tuple(r) for r in rows}


@settings(max_examples=12, deadline=None)
@given(st.dictionaries(st.text("abé", max_size=5), st.integers(1, 40), max_size=25))
def test_forms_of_any_words(spark, counts):
    assert forms_of(spark, list(counts.items())) == forms_brute(counts)


def test_forms_along_a_chain_and_with_ties(spark):
    # each word is half as frequent as the next, one letter further on
    counts = {"a" * (12 - i) + "b" * i: 2**i for i in range(13)}
    counts |= {"mouse": 50, "house": 50, "rouse": 20, "mousse": 3, "louse": 100}
    counts |= {f"w{c}rds": 5 + i for i, c in enumerate("abcdefghijklmnopqrstuvwxyzàáâãäåæçèéêëìíîïðñòóôõö÷øùúûüýþÿ")}
    got = forms_of(spark, list(counts.items()), parts=5)
    assert got == forms_brute(counts)
    assert {r[2] for r in got if set(r[0]) <= {"a", "b"}} == {"b" * 12}


def test_forms_of_awkward_words(spark):
    rows = [("hello", 3), ("hello", 4), (None, 3), ("help", None), ("hallo", 20), ("", 9), ("x", 30), ("a\x00b", 5), ("ab", 50), ("y" * 5000, 4), ("y" * 4999, 1)]
    want = forms_brute({"hello": 7, "hallo": 20, "": 9, "x": 30, "ab": 50, "y" * 5000: 4, "y" * 4999: 1})
    want |= {("a\x00b", None, "a\x00b", 5, 0, None)}
    want = {(*r[:4], 0, None) if r[0] == "a\x00b" else r for r in want}
    # the end mark keeps a word from being near; nothing else changes
    assert forms_of(spark, rows) == want
    assert spelling_forms(spark.createDataFrame([], "word string, n long, extra int")).count() == 0
    with pytest.raises(ValueError):
        spelling_forms(spark.createDataFrame([], "word string, n long"), ratio=1)


def test_runs_slips_and_counts(spark, awkward, no_rows):
    want = Counter()
    slips = 0
    rows = [(r[0], r[1]) for r in AWKWARD] + [(i, "Straße naïve coöperate ÀÉ " * 2) for i in range(60)]
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'null' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                slips += 1
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            want[run] += 1
    assert slips
    df = spark.createDataFrame(rows, "doc_id long, text string")
    words = letter_runs(df).select(slipped(F.col("doc_id"), F.col("run")).alias("word"))
    got = {r.word: r.n for r in count_words(words, 1, 1).collect()}
    assert got == {w: n for w, n in want.items() if w}
    assert {r.word: r.n for r in count_words(words).collect()} == {w: n for w, n in want.items() if len(w) >= 5 and n >= 3}
    assert letter_runs(no_rows).count() == 0
    assert letter_runs(awkward).filter("run = 'quick'").count() == 4


def test_pairs_are_never_written_out(spark):
    """A word's row for a prefix stands for all its neighbours there."""
    words = [(f"wor{a}s", i + 1) for i, a in enumerate("abcdefghijklmnopqrstuvwxyz")]
    got = near_words(spark.createDataFrame(words, "word string, n long")).collect()
    assert {(r.n_near, r.best.n) for r in got} == {(25, 26), (25, 25)}


# ---- filters


def masks_brute(rows, labels):
    good, toxic = ({d for d, *x in labels if d is not None and x[i] == 1} for i in (0, 1))
    first = {}
    for doc, text, _ in rows:
        if doc is not None:
            first[text or ""] = min(first.get(text or "", doc), doc)
    out = defaultdict(Counter)
    for doc, text, source in rows:
        text = text or ""
        words = WORD.findall(text)
        mask = (len(words) < 50) + 2 * (100 * len(set(words)) < 65 * len(words))
        mask += 4 * (100 * len(re.findall("[A-Z]", text)) > 5 * len(text)) + 8 * bool(re.search(r"[#$%&*|]", text))
        mask += 16 * (doc is not None and doc > first[text])
        out[source or ""][mask, doc in good, doc in toxic] += 1
    return out


def audit_brute(rows, labels):
    out = set()
    for part, masks in masks_brute(rows, labels).items():
        removed_in_all, found = Counter(), []
        for order in permutations(range(5)):
            left = Counter(masks)
            for step, bit in enumerate(order):
                gone = Counter({m: n for m, n in left.items() if m[0] >> bit & 1})
                left -= gone
                n = sum(gone.values())
                fail = sum(c for m, c in masks.items() if m[0] >> bit & 1)
                only = sum(c for m, c in masks.items() if m[0] == 1 << bit)
                removed_in_all[bit] += n
                found.append((part, "".join("ABCDE"[b] for b in order), step + 1, sum(left.values()), n, fail - n, only,
                              sum(c for m, c in gone.items() if m[1]), sum(c for m, c in gone.items() if m[2]), bit))
        out |= {(*r[:-1], removed_in_all[r[-1]]) for r in found}
    return out


def filter_rows():
    rng = random.Random(9)
    long = lambda k: " ".join(rng.choice("abcdefgh") * rng.randrange(1, 9) for _ in range(k))
    rows = [(r[0], r[1], r[3]) for r in AWKWARD]
    for i in range(200):
        text = rng.choice([long(60), long(8), " ".join(f"w{j}" for j in range(70)), " ".join(f"W{j}" for j in range(70)), "# " + long(55), ""])
        rows.append((1000 + i, text, rng.choice(["s", "t", "", None])))
    rows += [(5000 - i, "many copies of one text", "s") for i in range(80)]
    rows.append((1, "x " * 200_000, "long"))
    return rows


LABELS = [(i, i % 3 % 2, i % 5 == 0) for i in range(1000, 1100)] + [(1001, 0, 1), (1001, 1, 0), (None, 1, 1), (7, 1, None), (99999, 1, 1)]
LABELS = [(d, q, None if t is None else int(t)) for d, q, t in LABELS]


@pytest.mark.parametrize("most_bytes", [1 << 26, 1])
def test_audit_of_awkward_rows(spark, make_docs, most_bytes):
    rows = filter_rows()
    if most_bytes == 1:  # one block for all texts: nearly all look like repeats
        rows += [(10_000 + i, f"text {i}", "s") for i in range(6000)]
    docs = make_docs([(d, t, None, s, None) for d, t, s in rows])
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    got = [tuple(r) for r in audit_filters(docs, labels, most_bytes).collect()]
    assert len(got) == len(set(got))
    assert set(got) == audit_brute(rows, LABELS)


def test_audit_without_rows_or_labels(spark, no_rows, awkward):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit_filters(no_rows, labels).count() == 0
    got = {tuple(r) for r in audit_filters(awkward, labels).collect()}
    assert got == audit_brute([(r[0], r[1], r[3]) for r in AWKWARD], [])
    n = mask_counts(awkward, labels).agg(F.sum("n")).first()[0]
    assert n == len(AWKWARD)


def test_sketch_clears_only_unique_texts(spark):
    values = [f"t{i}" for i in range(3000)] + [f"t{i}" for i in range(0, 3000, 10)] + ["hot"] * 500
    rows = spark.createDataFrame([(v,) for v in values], "text string").repartition(6)
    rows = rows.select("text", *filter_audit._hashes(F.col("text")))
    sketch, blocks = counting_sketch(rows, len(values))
    assert blocks * filter_audit.BLOCK >= len(values) * filter_audit.COUNTERS_PER_TEXT
    cleared = Counter(r.text for r in possible_repeats(rows, sketch, blocks).filter("not maybe").collect())
    counts = Counter(values)
    assert all(counts[t] == 1 for t in cleared)
    assert len(cleared) > 0.85 * sum(n == 1 for n in counts.values())


def test_rows_are_dropped_by_key(spark):
    rows = spark.range(5000).select((F.col("id") % 4000).alias("k"), F.col("id").alias("v"))
    gone = spark.range(0, 4000, 7).select(F.col("id").alias("g"))
    got = sorted(tuple(r) for r in without(rows, F.col("k"), gone).collect())
    assert got == sorted((i % 4000, i) for i in range(5000) if i % 4000 % 7)
    assert without(rows, F.col("k"), gone.limit(0)).count() == 5000 and without(rows.limit(0), F.col("k"), gone).count() == 0
