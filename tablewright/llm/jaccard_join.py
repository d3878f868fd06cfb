"""Exact Jaccard join of shingle sets, with signature trees."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablewright.llm.common import materialize, materialize_few, mix, release, slices, take, words_of
from tablewright.llm.components import components
from tablewright.llm.filter_audit import counting_sketch, possible_repeats

#: Words in a shingle, and the similarity from which sets link, in hundredths.
SHINGLE = 3
PERCENT = 90
#: Bits of a set's signature.
BITS = 4096
#: Sets under one leaf, and nodes under one inner node.
FANOUT = 8
#: A group of candidates of more sets, or more shingles, is dealt to several tasks.
CHUNK_SETS = 192
CHUNK_SHINGLES = 1 << 17
#: Sets of a dealt group that go to all of its tasks, about.
PIVOTS = 32
#: Segments that sets that link agree in, at least: so many, and one for so many differences.
#: All but one of these may be passed over.
AGREE, AGREE_PER = 6, 4
#: Most spare keys of a set that are told.
MOST_SPARE = 4095

#: Distinct sets that a task remembers to have told.
MOST_TOLD = 1 << 18

_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Text number and hash of all distinct shingles, sorted by both.

    A text with fewer words than a shingle has one, of all its words; one
    without words has none.
    """
    words = words_of(data, offsets)
    doc, counts = words.doc, words.counts
    m = max(len(words.hashes) - size + 1, 0)
    at = np.flatnonzero(doc[:m] == doc[size - 1 :][:m]) if m else np.zeros(0, np.int64)
    key = np.full(len(at), size, dtype=np.uint64)
    for k in range(size):
        key = mix(key * _ODD[0] + words.hashes[at + k])
    docs, keys = [doc[at]], [key]
    for n in range(1, size):
        short = np.flatnonzero(counts == n)
        key = np.full(len(short), n, dtype=np.uint64)
        for k in range(n):
            key = mix(key * _ODD[0] + words.hashes[words.first[short] + k])
        docs.append(short)
        keys.append(key)
    doc, key = np.concatenate(docs), np.concatenate(keys)
    order = np.lexsort((key, doc))
    doc, key = doc[order], key[order]
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (key[1:] != key[:-1])
    return doc[new], key[new]


@lru_cache(maxsize=8)
def _schemes(percent: int, largest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower sizes of the bands, in how many segments each deals its sets, and in how many linked sets agree.

    Let a pair link whose smaller set is below the next band's lower size, L.
    Then they differ in d = (L - 1) * (100 - percent) / percent shingles at
    most, so of d + k segments of the hash range at least k are alike.
    Smaller sets than the first band's link only if they are equal.
    """
    first = -(-percent // (100 - percent)) if percent < 100 else 1 << 62
    lows = [first]
    while lows[-1] <= largest:
        lows.append(max(lows[-1] + 1, lows[-1] * 3 // 2))
    lows.append(max(lows[-1] + 1, lows[-1] * 3 // 2))
    lows = np.array(lows, dtype=np.int64)
    differ = (lows[1:] - 1) * (100 - percent) // percent
    agree = AGREE + differ // AGREE_PER
    return lows[:-1], differ + agree, agree


def segment_keys(
    doc: np.ndarray, key: np.ndarray, n_docs: int, percent: int = PERCENT
) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Keys of the segments that texts must share to link: by the scheme of their own band, and of the one below.

    Pigeonhole instead of chance: two sets that link agree in so many segments
    of the scheme of the smaller one's band, by which both are dealt. Empty
    segments only count for sets that have as many of them or more. For
    each scheme: text numbers and keys, by text, and for each text how many of
    its keys may be passed over so that it still shares one with each partner.
    """
    sizes = np.bincount(doc, minlength=n_docs)
    lows, segments, agree = _schemes(percent, int(sizes.max(initial=1)))
    band = np.searchsorted(lows, sizes, side="right") - 1
    out = []
    for step in (0, 1):
        scheme = band - step
        used = scheme >= 0
        if step:
            # the largest partner of the largest set of the band below
            used &= sizes * percent <= (lows[np.maximum(band, 0)] - 1) * 100
        here = used[doc]
        d, k = doc[here], key[here]
        spare = np.zeros(n_docs, dtype=np.int64)
        if len(d) == 0:
            out.append((d, k, spare))
            continue
        count = segments[scheme[d]].astype(np.uint64)
        segment = ((k >> np.uint64(32)) * count) >> np.uint64(32)
        new = np.ones(len(d), dtype=bool)
        new[1:] = (d[1:] != d[:-1]) | (segment[1:] != segment[:-1])
        begin = np.flatnonzero(new)
        total = np.add.reduceat(mix(k + _ODD[1]), begin)
        d, segment = d[begin], segment[begin]
        name = mix(scheme[d].astype(np.uint64) * _ODD[2] + segment)
        docs, keys = [d], [mix(total * _ODD[0] + name)]
        empties = segments[np.maximum(scheme, 0)] - np.bincount(d, minlength=n_docs)
        enough = agree[np.maximum(scheme, 0)]
        # a partner may agree in all the empty segments, which have no key here
        spare = np.where(used & (empties < enough), np.clip(enough - 1 - empties, 0, MOST_SPARE), 0)
        for x in np.flatnonzero(used & (empties >= enough)):
            empty = np.setdiff1d(np.arange(segments[scheme[x]], dtype=np.uint64), segment[d == x])
            docs.append(np.full(len(empty), x))
            keys.append(mix(mix(scheme[x : x + 1].astype(np.uint64) * _ODD[2] + empty)))
        d, k = np.concatenate(docs), np.concatenate(keys)
        order = np.argsort(d, kind="stable")
        out.append((d[order], k[order], spare))
    return out


def _lists(doc: np.ndarray, values: np.ndarray, n_docs: int) -> pa.ListArray:
    ends = np.searchsorted(doc, np.arange(n_docs + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.view(np.int64)))


class SignatureTree:
    """Sets under nodes that hold the OR of their bitmaps, the range of their sizes, and the least overlap of bits.

    Sets are sorted so that alike ones are neighbours (by their smallest
    hashes, then size). A set of n shingles and p bits shares at least
    p - n * (100 - percent) / 100 bits with any partner: whatever is not shared
    has a shingle of its own behind it.
    """

    def __init__(self, sets: list[np.ndarray], percent: int = PERCENT) -> None:
        self.percent = percent
        self.order = sorted(range(len(sets)), key=lambda i: (tuple(sets[i][:2].tolist()), len(sets[i])))
        self.sets = [sets[i] for i in self.order]
        bitmap = np.zeros((len(sets), BITS), dtype=bool)
        for i, s in enumerate(self.sets):
            bitmap[i, (s & np.uint64(BITS - 1)).astype(np.int64)] = True
        sizes = np.array([len(s) for s in self.sets], dtype=np.int64)
        needs = bitmap.sum(axis=1) - sizes * (100 - percent) // 100
        packed = np.packbits(bitmap, axis=1).view(np.uint64)
        #: from the leaves up; each level: bitmaps, smallest and largest size, need, range of sets
        place = np.arange(len(sets))
        self.levels = [(packed, sizes, sizes, needs, place, place + 1)]
        while len(self.levels[-1][0]) > 1:
            bits, low, high, need, begin, end = self.levels[-1]
            cut = np.arange(0, len(bits), FANOUT)
            self.levels.append(
                (
                    np.bitwise_or.reduceat(bits, cut, axis=0),
                    np.minimum.reduceat(low, cut),
                    np.maximum.reduceat(high, cut),
                    np.minimum.reduceat(need, cut),
                    begin[cut],
                    end[np.minimum(cut + FANOUT, len(bits)) - 1],
                )
            )

    def may_link(self, level: int, x: np.ndarray, other: SignatureTree, y: np.ndarray) -> np.ndarray:
        """Which pairs of nodes may hold a pair that links."""
        bits, low, high, need, _, _ = self.levels[level]
        bits2, low2, high2, need2, _, _ = other.levels[level]
        ok = (high[x] * 100 >= low2[y] * self.percent) & (high2[y] * 100 >= low[x] * self.percent)
        x, y = x[ok], y[ok]
        shared = np.bitwise_count(bits[x] & bits2[y]).sum(axis=1, dtype=np.int64)
        ok[ok] = shared >= np.maximum(need[x], need2[y])
        return ok


class Labels:
    """Which sets are known to be connected; by number."""

    def __init__(self, labels: list[int]) -> None:
        self.of = np.array(labels, dtype=np.int64)

    def join(self, a: int, b: int) -> None:
        x, y = self.of[a], self.of[b]
        self.of[self.of == max(x, y)] = min(x, y)


def links(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    """Whether two sorted sets link: 100 * intersection >= percent * union."""
    both = np.concatenate([a, b])
    both.sort(kind="stable")
    shared = int((both[1:] == both[:-1]).sum())
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def connect(one: SignatureTree, two: SignatureTree, known: Labels, numbers: tuple[np.ndarray, np.ndarray]) -> list[tuple[int, int]]:
    """Links between the sets of two trees (or within one), as far as they connect what wasn't connected.

    Dual traversal from the roots: a pair of nodes goes on to the pairs of its
    children unless sizes or bits rule out every link between them, or all
    their sets are connected already. What is left at the leaves is compared
    exactly.
    """
    found: list[tuple[int, int]] = []
    deep = min(len(one.levels), len(two.levels)) - 1
    tops = np.arange(len(one.levels[deep][0])), np.arange(len(two.levels[deep][0]))
    start = [(int(x), int(y)) for x in tops[0] for y in tops[1] if one is not two or x <= y]
    stack = [(deep, x, y) for x, y in reversed(start)]
    while stack:
        level, x, y = stack.pop()
        if level == 0:
            a, b = numbers[0][x], numbers[1][y]
            if known.of[a] != known.of[b] and links(one.sets[x], two.sets[y], one.percent):
                known.join(a, b)
                found.append((a, b))
            continue
        same = one is two and x == y
        begin, end = one.levels[level][4][x], one.levels[level][5][x]
        begin2, end2 = two.levels[level][4][y], two.levels[level][5][y]
        la, lb = known.of[numbers[0][begin:end]], known.of[numbers[1][begin2:end2]]
        if la.min() == la.max() == lb.min() == lb.max():
            continue
        below = level - 1
        xs = np.arange(x * FANOUT, min((x + 1) * FANOUT, len(one.levels[below][0])))
        ys = np.arange(y * FANOUT, min((y + 1) * FANOUT, len(two.levels[below][0])))
        px, py = (p.ravel() for p in np.meshgrid(xs, ys, indexing="ij"))
        if same:
            keep = px < py if below == 0 else px <= py
            px, py = px[keep], py[keep]
        ok = one.may_link(below, px, two, py)
        # nodes on the diagonal come off the stack first: they connect the most
        pairs = sorted(zip(px[ok].tolist(), py[ok].tolist()), key=lambda p: -abs(p[0] - p[1]))
        stack += [(below, i, j) for i, j in pairs]
    return found


def _first_of_each(fp: np.ndarray, told: set[int]) -> np.ndarray:
    """Which of these sets a task sees first; ``told`` remembers up to MOST_TOLD, so later copies may be told again."""
    out = np.zeros(len(fp), dtype=bool)
    out[np.unique(fp, return_index=True)[1]] = True
    for i in np.flatnonzero(out).tolist():
        x = int(fp[i])
        if x in told:
            out[i] = False
        elif len(told) < MOST_TOLD:
            told.add(x)
    return out


def _connect_groups(table: pa.Table, percent: int) -> pa.Table:
    """One group of candidates: (fp, set, label, side) to links (a, b)."""
    fp = table.column("fp").to_numpy()
    if len(fp) < 2:
        return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
    lists = table.column("shingles").combine_chunks()
    ends = lists.offsets.to_numpy()
    values = lists.values.to_numpy().view(np.uint64)
    sets = [values[i:j] for i, j in zip(ends[:-1].tolist(), ends[1:].tolist())]
    side = table.column("side").to_numpy()
    known = Labels(table.column("label").to_pylist())
    if side.min() == side.max():
        tree = SignatureTree(sets, percent)
        numbers = np.array(tree.order)
        found = connect(tree, tree, known, (numbers, numbers))
    else:
        parts = [np.flatnonzero(side == s) for s in (side.min(), side.max())]
        trees = [SignatureTree([sets[i] for i in p.tolist()], percent) for p in parts]
        numbers = [p[np.array(t.order)] for p, t in zip(parts, trees)]
        found = connect(trees[0], trees[1], known, (numbers[0], numbers[1]))
    return pa.table(
        {"a": pa.array([int(fp[a]) for a, _ in found], pa.int64()), "b": pa.array([int(fp[b]) for _, b in found], pa.int64())}
    )


def jaccard_groups(docs: DataFrame, percent: int = PERCENT, size: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles and component_id of every row: connected components of the exact Jaccard join.

    1. A set's fingerprint stands for all its copies; each task tells the keys
       of a distinct set once, so copies aren't shuffled however many there are.
    2. Sets that link share segments of their hash range (``segment_keys``),
       also after each passed over its most frequent ones. Sets that share
       a segment, directly or over others, are one group of candidates; most
       sets share none and are done.
    3. The sets of a group meet in a signature tree, whose dual traversal
       finds links that connect them. A group too large for one task is dealt
       to several by fingerprint, with some pivot sets in all of them; if that
       leaves it in several components, every two parts meet, too. So no
       link between different components is lost and no task gets more than
       two parts.

    Shingles are told apart by 64-bit hashes, sets by 64-bit fingerprints. A
    row without words has no shingles and its own doc_id as component. Rows
    with a null doc_id get the component of what they link with, null if that
    is nameless. Rows that repeat, or share a doc_id, link by their texts.
    No rows give no rows.
    """

    def sets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told: set[int] = set()
        for batch in batches:
            for at, to, data, offsets in slices(batch.column("text")):
                n = to - at
                doc, key = shingle_sets(data, offsets, size)
                counts = np.bincount(doc, minlength=n)
                total = np.zeros(n, dtype=np.uint64)
                if len(doc):
                    begin = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
                    total[doc[begin]] = np.add.reduceat(mix(key + _ODD[2]), begin)
                fp = mix(total + counts.astype(np.uint64)).view(np.int64)
                first = _first_of_each(fp, told)[doc]
                (d0, k0, spare0), (d1, k1, spare1) = segment_keys(doc[first], key[first], n, percent)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(at, n),
                        pa.array(counts.astype(np.int64)),
                        pa.array(fp, mask=counts == 0),
                        _lists(d0, k0, n),
                        _lists(d1, k1, n),
                        pa.array(spare0.astype(np.int64)),
                        pa.array(spare1.astype(np.int64)),
                    ],
                    ["doc_id", "n_shingles", "fp", "keys0", "keys1", "spare0", "spare1"],
                )

    rows = take(docs, "doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    made = rows.mapInArrow(
        sets,
        f"doc_id {kind}, n_shingles long, fp long, keys0 array<long>, keys1 array<long>, spare0 long, spare1 long",
    )
    # rows get a number that is written down with them; numbers of neighbours are alike, which
    # keeps the large shuffle by key at little more than the keys
    head = materialize(made.withColumn("row", F.monotonically_increasing_id()), "shingle-sets")
    distinct_sets = head.filter("fp is not null").groupBy("fp").agg(F.min("doc_id").alias("first_doc"))

    # a slot is a row under one of its schemes, together with its number of spare keys
    slot = lambda k: F.expr(f"(row * 2 + {k}) * {MOST_SPARE + 1} + spare{k}").alias("slot")
    keys = head.select(slot(0), F.explode("keys0").alias("key")).unionAll(
        head.select(slot(1), F.explode("keys1").alias("key"))
    )
    # one shuffle by key serves both the count and the rows: both sides must read the same columns
    # under the same filters, or each is shuffled for itself
    keys = keys.repartition("key")
    counted = keys.groupBy("key").agg(F.count("slot").alias("n")).filter("n > 1")
    met = keys.join(counted.hint("merge"), "key")
    # The most frequent keys come from passages that many texts share. Each row passes over its
    # spare ones: of all the keys two partners share, the rarest stays with both.
    by_frequency = Window.partitionBy("slot").orderBy(F.desc("n"), F.desc("key"))
    met = met.withColumn("rank", F.row_number().over(by_frequency)).filter(f"rank > coalesce(slot % {MOST_SPARE + 1}, 0)")
    met = materialize(met.select(F.expr(f"slot div {2 * (MOST_SPARE + 1)}").alias("row"), "key"), "shared-segments")
    del keys, counted
    release(docs.sparkSession)
    lowest = met.groupBy("key").agg(F.min("row").alias("low"), F.max("row").alias("high")).filter("low < high")
    pairs = met.join(lowest, "key").select(F.col("low").alias("a"), F.col("row").alias("b"))
    group_of = materialize_few(components(pairs), "candidate-groups")
    del met, lowest, pairs
    release(docs.sparkSession)

    # the texts of the candidates, one for each distinct set; copies share all keys and so a group
    known = (
        head.select("row", "fp", "n_shingles", "doc_id")
        .join(group_of, F.col("row") == F.col("node"))
        .groupBy("fp")
        .agg(F.min("component").alias("group"), F.max("n_shingles").alias("n"), F.min("doc_id").alias("first_doc"))
    )
    known = materialize_few(known, "candidates")
    sizes = known.groupBy("group").agg(
        F.count("*").alias("sets"),
        F.greatest(
            F.ceil(F.count("*") / CHUNK_SETS), F.ceil(F.sum("n") / CHUNK_SHINGLES), F.lit(1)
        ).cast("int").alias("parts"),
    ).filter("sets > 1")
    known = known.join(sizes, "group")
    candidates = materialize(
        _sets_of(rows, known, size).join(known.select("fp", "group", "sets", "parts"), "fp"),
        "candidate-sets",
    )
    release(docs.sparkSession)
    part = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    pivot = F.pmod(F.xxhash64("fp", F.lit("pivot")), F.col("sets")) < PIVOTS
    everywhere = F.sequence(F.lit(0), F.col("parts") - 1)
    first = candidates.select(
        "group", "fp", "shingles", F.lit(0).alias("side"), F.xxhash64("fp").alias("label"),
        F.explode(F.when((F.col("parts") > 1) & pivot, everywhere).otherwise(F.array(part))).alias("part"),
    )
    match = lambda table: _connect_groups(table, percent)
    found = materialize_few(first.groupBy("group", "part").applyInArrow(match, "a long, b long"), "links")
    if not candidates.filter("parts > 1").isEmpty():
        found = found.unionByName(_between_parts(candidates, found, part, match))
    component = components(found)

    named = distinct_sets.join(component, F.col("fp") == F.col("node"), "left").select(
        "fp", F.coalesce("component", "fp").alias("component"), "first_doc"
    )
    named = materialize(named, "components")
    smallest = named.groupBy("component").agg(F.min("first_doc").alias("component_id"))
    of_set = named.join(smallest, "component").select(F.col("fp").alias("set"), "component_id")
    return head.join(of_set, F.col("fp") == F.col("set"), "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("fp").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def _sets_of(rows: DataFrame, known: DataFrame, size: int) -> DataFrame:
    """fp and sorted shingles of the wanted sets, from the text of one document of each."""

    def sets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to, data, offsets in slices(batch.column("text")):
                n = to - at
                doc, key = shingle_sets(data, offsets, size)
                total = np.zeros(n, dtype=np.uint64)
                counts = np.bincount(doc, minlength=n)
                if len(doc):
                    begin = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
                    total[doc[begin]] = np.add.reduceat(mix(key + _ODD[2]), begin)
                fp = mix(total + counts.astype(np.uint64)).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(fp), _lists(doc, key, n)], ["fp", "shingles"])

    # null-safe: a set may belong to nameless documents alone
    named = known.select(F.col("first_doc").alias("d")).distinct()
    # a sketch of the wanted ids, bounded in size, keeps most other texts from being shuffled
    hashes = lambda c: [F.xxhash64(c).alias("h1"), F.xxhash64(F.lit(1), c).alias("h2")]
    sketch, blocks = counting_sketch(named.select(*hashes(F.col("d"))), known.count())
    sketch = materialize_few(sketch, "wanted-ids")
    rows = possible_repeats(rows.select("doc_id", "text", *hashes(F.col("doc_id"))), sketch, blocks, least=1)
    rows = rows.filter("maybe").select("doc_id", "text")
    # candidates grow with the corpus: a merge join is the plan at every size
    texts = rows.join(named.hint("merge"), F.col("doc_id").eqNullSafe(F.col("d")), "left_semi").select("text")
    # documents that share a doc_id may bring a set twice, or one that isn't wanted
    return texts.mapInArrow(sets, "fp long, shingles array<long>").dropDuplicates(["fp"])


def _between_parts(candidates: DataFrame, found: DataFrame, part, match) -> DataFrame:
    """Links between parts of dealt groups that the links so far leave in several components."""
    so_far = materialize_few(components(found), "components-so-far")
    dealt = candidates.filter("parts > 1").join(so_far, F.col("fp") == F.col("node"), "left").select(
        "group", "fp", "shingles", "parts", part.alias("part"), F.coalesce("component", "fp").alias("label")
    )
    dealt = materialize_few(dealt, "dealt")
    split = dealt.groupBy("group").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    split = split.filter("low < high").select(F.col("group").alias("g"))
    other = F.sequence(F.lit(0), F.col("parts") - 1)
    both = (
        dealt.join(split, F.col("group") == F.col("g"), "left_semi")
        .withColumn("other", F.explode(other))
        .filter("part != other")
        .select(
            "group", "fp", "shingles", "label", F.least("part", "other").alias("i"),
            F.greatest("part", "other").alias("j"), F.when(F.col("part") < F.col("other"), 0).otherwise(1).alias("side"),
        )
    )
    return both.groupBy("group", "i", "j").applyInArrow(match, "a long, b long")
