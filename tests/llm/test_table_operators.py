"""Operators on whole tables against brute force: vectors, shingle sets, mixes, shards, the pipeline."""

from __future__ import annotations

import base64
import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import corpus_pipeline
import numpy as np
import oracle
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import tiktoken
from conftest import AWKWARD, FOLDER, SCHEMA, near_copies
from hypothesis import given, settings
from hypothesis import strategies as st

from tablewright.llm import embedding_dedup, jaccard_join
from tablewright.llm.common import materialize
from tablewright.llm.components import components
from tablewright.llm.embedding_dedup import multi_sequence, near_duplicates
from tablewright.llm.jaccard_join import jaccard_groups
from tablewright.llm.mixing import mix_sources, repeat_rows, water_fill
from tablewright.llm.pseudonyms import pseudonymize_text
from tablewright.llm.queries import KEY, ORACLES, QUERIES, RANKS
from tablewright.llm.sharding import shard_by_bytes

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}
has_tables = pytest.mark.skipif(not Path(FOLDER).is_dir(), reason="no test tables here")


class Union:
    def __init__(self):
        self.of = {}

    def find(self, x):
        while self.of.setdefault(x, x) != x:
            x = self.of[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.of[max(a, b)] = min(a, b)


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), max_size=40))
def test_components(spark, links):
    union = Union()
    for a, b in links:
        union.join(a, b)
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert got == {x: union.find(x) for x in linked}


def test_components_of_a_long_chain(spark):
    got = components(spark.range(400).selectExpr("id a", "id + 1 b")).collect()
    assert len(got) == 401 and {r.component for r in got} == {0}


# ---- vectors


def expected_links(rows, cosine):
    usable = []
    for k, (_, v) in enumerate(rows):
        if v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            usable.append((k, np.array(v, dtype=float)))
    union, counts = Union(), Counter()
    for i, (a, v) in enumerate(usable):
        for b, w in usable[:i]:
            if len(v) == len(w) and v @ w / np.linalg.norm(v) / np.linalg.norm(w) >= cosine:
                counts[a] += 1
                counts[b] += 1
                union.join(a, b)
    return counts, union


def vector_rows():
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=16)) for i in range(300)]
    for i in range(300, 500):  # copies of ten vectors, near and exact
        v = rows[i % 10][1]
        rows.append((i, v if i % 4 == 0 else v + rng.normal(size=16) * 0.08))
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in rows]
    rows += [(600, None), (601, []), (602, [0.0] * 16), (603, [float("nan")] * 16), (604, [float("inf")] + [1.0] * 15)]
    rows += [(605, [None] + [1.0] * 15), (606, [1.0] * 5), (607, [2.0] * 5), (608, [1e30] * 16), (609, [1e-30] * 16)]
    rows += [rows[3], rows[3]]
    return rows


def test_vectors_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "PER_CELL", 8)
    monkeypatch.setattr(embedding_dedup, "CHUNK", 16)
    rows = vector_rows()
    counts, union = expected_links(rows, 0.9)
    df = spark.createDataFrame([(*r, 1, 0.0) for r in rows], "vec_id long, embedding array<float>, label int, links double")
    got = near_duplicates(df).collect()
    assert len(got) == len(rows)
    want = defaultdict(list)
    for k, (i, _) in enumerate(rows):
        want[i].append(counts[k])
    for r in got:
        assert r.n_links <= max(want[r.vec_id])
        assert r.kept == (r.vec_id == r.component_id)
    assert sum(r.n_links for r in got) >= 0.97 * sum(counts.values())
    smallest = {}
    for k, (i, _) in enumerate(rows):
        smallest[union.find(k)] = min(i, smallest.get(union.find(k), i))
    same = [r.component_id == smallest[union.find([i for i, _ in rows].index(r.vec_id))] for r in got]
    assert sum(same) >= 0.98 * len(same)
    assert {r.vec_id: r.n_links for r in got if 600 <= r.vec_id < 608} == {**dict.fromkeys(range(600, 606), 0), 606: 1, 607: 1}


def test_vectors_of_empty_tables(spark):
    schema = "vec_id long, embedding array<float>"
    assert near_duplicates(spark.createDataFrame([], schema)).count() == 0
    only_null = near_duplicates(spark.createDataFrame([(1, None)], schema)).collect()
    assert [tuple(r) for r in only_null] == [(1, 0, 1, True)]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 50), min_size=1, max_size=8), st.lists(st.integers(0, 50), min_size=1, max_size=8), st.integers(1, 70))
def test_multi_sequence_visits_nearest_cells_first(first, second, depth):
    a, b = np.array(first, dtype=float), np.array(second, dtype=float)
    cells = multi_sequence(a, b, depth)
    assert len(set(cells)) == len(cells) == min(depth, len(a) * len(b))
    sums = [a[i] + b[j] for i, j in cells]
    assert sums == sorted(x + y for x in a for y in b)[: len(cells)]


# ---- shingles


def shingles(text, size):
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) < size:
        return frozenset([tuple(words)] if words else [])
    return frozenset(zip(*[words[k:] for k in range(size)]))


def expected_groups(rows, percent, size):
    sets = [shingles(r[1], size) for r in rows]
    union = Union()
    for i, a in enumerate(sets):
        union.find(i)
        for j in range(i):
            b = sets[j]
            if a and b:
                both = len(a & b)
                if 100 * both >= percent * (len(a) + len(b) - both):
                    union.join(i, j)
    named = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            named[union.find(i)] = min(r[0], named.get(union.find(i), r[0]))
    return sorted(((r[0], len(s), named.get(union.find(i))) for i, (r, s) in enumerate(zip(rows, sets))), key=repr)


@pytest.mark.parametrize(("percent", "size", "chunk"), [(90, 3, 192), (90, 3, 16), (80, 5, 16), (50, 3, 192)])
def test_groups_match_brute_force(make_docs, monkeypatch, percent, size, chunk):
    monkeypatch.setattr(jaccard_join, "CHUNK_SETS", chunk)
    monkeypatch.setattr(jaccard_join, "PIVOTS", 2)  # leaves work for the pairs of parts
    rows = AWKWARD + near_copies()
    got = sorted((tuple(r) for r in jaccard_groups(make_docs(rows), percent, size).collect()), key=repr)
    assert got == expected_groups(rows, percent, size)


def test_groups_of_no_rows(no_rows):
    assert jaccard_groups(no_rows).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.sampled_from([50, 80, 90, 95]))
def test_linked_sets_share_a_segment(seed, percent):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 2**63, rng.integers(1, 120), dtype=np.uint64)
    other = np.concatenate([base[: len(base) - rng.integers(0, max(1, len(base) // 8) + 1)], rng.integers(0, 2**63, rng.integers(0, 6), dtype=np.uint64)])
    a, b = np.unique(base), np.unique(other)
    if len(b) and jaccard_join.links(a, b, percent) and not np.array_equal(a, b):
        doc = np.repeat([0, 1], [len(a), len(b)])
        shared = []
        for d, k, spare in jaccard_join.segment_keys(doc, np.concatenate([a, b]), 2, percent):
            shared.append((set(k[d == 0].tolist()), set(k[d == 1].tolist()), spare))
        # under the scheme of the smaller one's band, more keys than either may pass over
        mine, yours = (shared[0], shared[1])
        alike = [
            (len(x & y), spare_x, spare_y)
            for x, spare_x in ((mine[0], mine[2][0]), (yours[0], yours[2][0]))
            for y, spare_y in ((mine[1], mine[2][1]), (yours[1], yours[2][1]))
        ]
        assert any(n > max(p, q) for n, p, q in alike)


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 60))
def test_tree_finds_what_connects(seed, n):
    rng = np.random.default_rng(seed)
    bases = [rng.integers(0, 2**63, 60, dtype=np.uint64) for _ in range(4)]
    sets = []
    for _ in range(n):
        s = bases[rng.integers(4)].copy()
        s[rng.permutation(60)[: rng.integers(0, 8)]] = rng.integers(0, 2**63, 1, dtype=np.uint64)
        sets.append(np.unique(s))
    tree, known = jaccard_join.SignatureTree(sets), jaccard_join.Labels(list(range(n)))
    numbers = np.array(tree.order)
    found = jaccard_join.connect(tree, tree, known, (numbers, numbers))
    one, two = Union(), Union()
    for i in range(n):
        for j in range(i):
            if jaccard_join.links(sets[i], sets[j]):
                one.join(i, j)
    for a, b in found:
        assert jaccard_join.links(sets[a], sets[b])
        two.join(int(a), int(b))
    assert [one.find(i) for i in range(n)] == [two.find(i) for i in range(n)]


# ---- mixes


def fill(sizes, weights, share, most):
    """Clamp and reshare until nobody is above."""
    left, out = share * sum(sizes), [0.0] * len(sizes)
    open_ = list(range(len(sizes)))
    while open_:
        total = sum(weights[i] for i in open_)
        over = [i for i in open_ if left * weights[i] / total > most * sizes[i]]
        if not over:
            for i in open_:
                out[i] = left * weights[i] / total
            break
        for i in over:
            out[i] = most * sizes[i]
        left -= sum(out[i] for i in over)
        open_ = [i for i in open_ if i not in over]
    return out


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(0, 1000), min_size=1, max_size=9))
def test_targets_match_reshared_excess(spark, sizes):
    names = [None if i == len(sizes) - 1 else f"s{i}" for i in range(len(sizes))]
    got = {r.source: r.target for r in water_fill(spark.createDataFrame(list(zip(names, sizes)), "source string, source_size long")).collect()}
    weights = [(5, 2, 1)[i % 3] for i in range(len(sizes))]
    assert np.allclose([got[n] for n in names], fill(sizes, weights, 1.5, 2.0), rtol=1e-9, atol=1e-6)


def expected_mix(rows):
    sized = [(r[0], r[3], len(WORD.findall(r[1] or ""))) for r in rows]
    names = sorted({s for _, s, _ in sized if s is not None}) + ([None] if any(s is None for _, s, _ in sized) else [])
    sizes = [sum(n for _, s, n in sized if s == name) for name in names]
    targets = dict(zip(names, fill(sizes, [(5, 2, 1)[i % 3] for i in range(len(names))], 1.5, 2.0)))
    out = []
    for name, source_size in zip(names, sizes):
        own = [(hashlib.md5(f"mix:{'null' if i is None else i}".encode()).hexdigest(), -1 if i is None else i, n, i) for i, s, n in sized if s == name]
        whole = targets[name] // source_size if source_size else 0
        rest, run = targets[name] - whole * source_size, 0
        for _, _, n, i in sorted(own, key=lambda x: x[:3]):
            run += n
            out.append((i, n, source_size, round(targets[name], 6), int(n * (whole + (run - n / 2 < rest)))))
    return sorted(out, key=repr)


def test_mix_matches_brute_force(make_docs, no_rows):
    for rows in (AWKWARD, near_copies(), AWKWARD + near_copies()):
        got = mix_sources(make_docs(rows)).select("doc_id", "size", "source_size", "target", "taken").collect()
        assert sorted(((*r[:3], round(r.target, 6), r.taken) for r in got), key=repr) == expected_mix(rows)
        assert all(r.taken <= 2 * r.size for r in got)
    assert mix_sources(no_rows).count() == 0 and repeat_rows(no_rows).count() == 0


def test_rows_repeat_as_often_as_they_are_taken(make_docs):
    rows = near_copies()
    epochs = {r.doc_id: r.epochs for r in mix_sources(make_docs(rows)).collect()}
    out = repeat_rows(make_docs(rows))
    assert out.columns == make_docs(rows).columns
    got = Counter(r[0] for r in out.collect())
    assert got == Counter({i: n for i, n in epochs.items() if n})


@has_tables
def test_mix_matches_sql(spark):
    got = oracle.of_frame(QUERIES["op2_source_mix"](spark, FOLDER))
    assert got == oracle.of_sql(oracle.connect(FOLDER), ORACLES["op2_source_mix"])


# ---- shards


def check_shards(rows, got, shards):
    size = lambda t: len((t or "").encode()) + 16
    crc = lambda t: zlib.crc32((t or "").encode())
    order = sorted(((crc(r[1]), -(10**9) if r[0] is None else r[0], size(r[1]), r[0]) for r in rows), key=lambda x: x[:3])
    total, run, want, slots = sum(o[2] for o in order), 0, [], Counter()
    for c, _, n, i in order:
        shard = (2 * run + n) * shards // (2 * total)
        want.append((i, n, c, "bytes", shard, slots[shard], None))
        slots[shard] += 1
        run += n
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_shards_match_brute_force(make_docs, no_rows):
    rows = AWKWARD + near_copies() + [(900 + i, "the same text " * 20, None, None, 1) for i in range(200)]
    check_shards(rows, shard_by_bytes(make_docs(rows), 40).collect(), 40)
    check_shards(rows, shard_by_bytes(make_docs(rows), 7, order_parts=5).collect(), 7)
    check_shards(AWKWARD, shard_by_bytes(make_docs(AWKWARD), 40).collect(), 40)
    assert shard_by_bytes(no_rows).count() == 0


@has_tables
def test_shards_of_the_tables(spark):
    rows = [(d["doc_id"], d["text"]) for d in pq.read_table(f"{FOLDER}/documents.parquet").to_pylist()]
    check_shards(rows, QUERIES["op10_byte_shards"](spark, FOLDER).collect(), 40)


# ---- pipeline


def test_stages_of_awkward_rows(spark, make_docs):
    rows = AWKWARD + near_copies()
    docs = spark.createDataFrame(rows, SCHEMA + "")
    docs = docs.selectExpr("*", "'x' AS copy", "'y' AS found", "'z' AS mix_id")
    kept = corpus_pipeline.language(spark, docs, "").cache()
    assert kept.columns == docs.columns
    has_letter = lambda t: t is not None and any(c.isalpha() for c in t)
    rejected = {r[0] for r in rows} - {r.doc_id for r in kept.collect()}
    assert {r[0] for r in rows if not has_letter(r[1])} - {None} <= rejected
    groups = expected_groups([tuple(r) for r in docs.collect()], 80, 5)
    near = corpus_pipeline.near_copies(spark, docs, "")
    assert near.columns == docs.columns
    ids = sorted(r.doc_id for r in near.collect() if r.doc_id is not None)
    assert ids == sorted({i for i, _, c in groups if i is not None and i == c})
    private = corpus_pipeline.private(spark, docs, "")
    assert private.count() == len(rows) and "4532015112830366" not in str(private.collect())
    mixed = corpus_pipeline.mixture(spark, docs, "")
    assert mixed.columns == docs.columns and mixed.count() > 0
    assert corpus_pipeline.tokens(spark, docs, "").count() == len(rows)


def test_language_rejects_what_is_not_taught(spark, make_docs):
    en = "the of and to in is that was he for it with as his on be at by had not are but from or have an they which one you"
    de = "der die und in den von zu das mit sich des auf ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach"
    rng = random.Random(3)
    mix = lambda words, n: " ".join(rng.choice(words.split()) for _ in range(n))
    taught = [(i, mix((en, de)[i % 2], (3, 8, 30, 120)[i // 2 % 4]), ("en", "de")[i % 2], "a", 1) for i in range(240)]
    clean = [(1000 + i, mix((en, de)[i % 2], (8, 30, 120)[i // 2 % 3]), None, "a", 1) for i in range(60)]
    foreign = [
        "vaka vanha väinämöinen itse tuon sanoiksi virkkoi mieleni minun tekevi aivoni ajattelevi lähteäni laulamahan",
        "litwo ojczyzno moja ty jesteś jak zdrowie ile cię trzeba cenić ten tylko się dowie kto cię stracił",
        "мой дядя самых честных правил когда не в шутку занемог он уважать себя заставил",
        "吾輩は猫である 名前はまだ無い どこで生れたかとんと見当がつかぬ",
        " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(7)) for _ in range(25)),
        "".join(rng.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/") for _ in range(300)),
    ]
    junk = [(2000 + i, text, None, "a", 1) for i, text in enumerate(foreign)]
    kept = corpus_pipeline.language(spark, make_docs(taught + clean + junk), "").collect()
    assert sorted(r.doc_id for r in kept) == [r[0] for r in taught + clean]


@has_tables
def test_language_keeps_the_labelled_tables(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    more = docs.selectExpr("doc_id + 1000000 AS doc_id", "translate(lower(text), 'aeionrst', 'qxzjwkvy') AS text")
    more = more.selectExpr("*", "CAST(NULL AS STRING) AS lang", "'a' AS source", "1L AS n_chars").filter("length(text) > 300")
    kept = corpus_pipeline.language(spark, docs.unionByName(more.select(docs.columns), allowMissingColumns=True), "")
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in docs.collect()}


def test_near_copies_tell_rows_apart(spark, make_docs):
    text = lambda k, n=40: " ".join(f"w{k}x{i}" for i in range(n))
    rows = [
        (1, text(1), "en", "a", 1), (1, text(2), "en", "a", 2),  # two texts of one doc_id
        (2, text(3), "en", "a", 3), (3, text(3), "en", "a", 4), (3, text(4), "en", "a", 5),  # one of two copies a smaller id
        (None, text(5), "en", "a", 6), (None, text(5), "en", "a", 6), (None, text(1), "en", "a", 7), (None, text(6), "en", "a", 8),
        (4, text(7), "en", "a", 9), (4, text(7), "en", "a", 9), (5, None, "en", "a", 10), (None, None, "en", "a", 11),
    ]
    kept = corpus_pipeline.near_copies(spark, make_docs(rows), "")
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr)
    want = [
        (1, text(1)), (1, text(2)), (2, text(3)), (3, text(4)), (None, text(5)), (None, text(6)), (4, text(7)), (5, None), (None, None),
    ]
    assert got == sorted(want, key=repr)
    alone = corpus_pipeline.near_copies(spark, make_docs([(8, text(1), "en", "a", 1), (9, text(1), "en", "a", 1)], False), "")
    assert [r.doc_id for r in alone.collect()] == [8]


def test_stages_of_no_rows(spark):
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
        assert docs.count() == 0
        docs = docs if "text" in docs.columns else spark.createDataFrame([], SCHEMA)


@has_tables
def test_pipeline_keeps_clean_documents(spark):
    docs = pq.read_table(f"{FOLDER}/documents.parquet").to_pylist()
    out = corpus_pipeline.run(spark, FOLDER)
    assert out.columns == ["doc_id", "ids"]
    groups = expected_groups([(d["doc_id"], d["text"]) for d in docs], 80, 5)
    stay = {i for i, _, c in groups if i == c}
    taken = Counter(r.doc_id for r in out.collect())
    assert set(taken) <= stay and max(taken.values()) <= 2
    # the mix leaves out part of the sources of small weight, and nothing else is lost
    assert len(taken) >= 0.55 * len(stay)


@has_tables
def test_pipeline_stage_by_stage(spark):
    """Every stage on what its predecessor kept, against brute force of its decisions and texts."""
    ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in open(RANKS, "rb") if line.strip())}
    library = tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    before = {}
    for name in ("language", "near_copies", "private", "mixture"):
        rows = [r.asDict() for r in docs.collect()]
        before[name] = rows
        docs = materialize(stages[name](spark, docs, FOLDER), f"test-{name}")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    before["tokens"] = [r.asDict() for r in docs.collect()]
    whole = {r["doc_id"]: r for r in before["language"]}
    # labelled prose stays
    kept = {r["doc_id"]: r for r in before["near_copies"]}
    clean = {i for i, r in whole.items() if r["lang"] and len((r["text"] or "").split()) >= 20}
    assert len(clean - set(kept)) <= 0.01 * len(clean) and all(kept[i] == whole[i] for i in kept)
    groups = expected_groups([(i, r["text"]) for i, r in kept.items()], 80, 5)
    assert {r["doc_id"] for r in before["private"]} == {i for i, _, c in groups if i == c}
    for r in before["mixture"]:
        old = kept[r["doc_id"]]
        assert r["text"] == pseudonymize_text(old["text"], KEY.encode()) and {**r, "text": old["text"]} == old
    private = spark.createDataFrame([tuple(r.values()) for r in before["mixture"]], SCHEMA)
    epochs = {r.doc_id: r.epochs for r in mix_sources(private).collect() if r.epochs}
    assert Counter(r["doc_id"] for r in before["tokens"]) == epochs
    texts = {r["doc_id"]: r["text"] for r in before["tokens"]}
    got = stages["tokens"](spark, docs, FOLDER).collect()
    assert Counter(r.doc_id for r in got) == epochs
    wanted = {i: library.encode_ordinary(t) for i, t in texts.items()}
    assert all(list(r.ids) == wanted[r.doc_id] for r in got)
