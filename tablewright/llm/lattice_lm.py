"""Likelihood of texts: word counts of the corpus, and a lattice of subword segmentations."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import Substrings, Words, materialize, mix, slices, take, words_of

#: A word counts as frequent if it makes at least this share of all training tokens.
#: So there are at most FREQUENT of them, however large the corpus.
FREQUENT = 1 << 18
#: Cells of the forward recursion that are held at a time.
MATRIX_CELLS = 1 << 20
#: Bytes from which a word goes through the recursion alone, and places that are looked up at a time then.
LONG_WORD = 256
STRETCH = 1 << 16
#: Bytes of words and counts that a task holds.
HELD_BYTES = 64 << 20
#: Fixed value: the mark of a word's start in the vocabulary.
WORD_START = "▁".encode()
#: Bytes of the character that begins with a byte.
CHARACTER_BYTES = np.repeat([1, 2, 3, 4], [0xC0, 0x20, 0x10, 0x10])
#: Rounds of expectation and maximization in which the pieces' probabilities are learned.
ROUNDS = 2
#: Pieces that the vocabulary's own probabilities count for, beside those of the training words.
PRIOR = 1000.0
_LN10 = math.log(10)


def read_pieces(path: str) -> dict[str, float]:
    """Natural log probabilities of the pieces of an existing vocabulary.

    A unigram model's scores are these already. In a merge vocabulary the
    scores are ranks below zero; they become probabilities by Zipf's law,
    1 / (rank + 10), made to sum to one. Control pieces are left out, byte
    pieces are named as in the file (<0x00> to <0xFF>).
    """
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    kept = {
        model.id_to_piece(i): model.get_score(i)
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
    }
    scores = np.array(list(kept.values()))
    if np.all(scores == np.round(scores)):
        rank = np.argsort(np.argsort(-scores, kind="stable"), kind="stable")
        scores = -np.log(rank + 10.0)
    scores = scores - np.log(np.exp(scores).sum())
    return dict(zip(kept, scores.tolist()))


class Lattice:
    """Marginal probabilities of words over all their segmentations into pieces."""

    def __init__(self, pieces: dict[str, float]) -> None:
        spelt = {p for p in pieces if len(p) == 6 and p.startswith("<0x")}
        least = min(pieces.values(), default=0.0)
        self.byte = np.array([pieces.get(f"<0x{b:02X}>", least) for b in range(256)])
        kept = {p.encode(): s for p, s in pieces.items() if p not in spelt}
        self.longest = max(map(len, kept), default=1)
        data = np.frombuffer(b"".join(kept), dtype=np.uint8)
        ends = np.cumsum([len(k) for k in kept]) if kept else np.zeros(0, np.int64)
        starts = ends - [len(k) for k in kept] if kept else ends
        keys = Substrings(data).hashes(starts, ends)
        order = np.argsort(keys)
        self.keys, self.scores = keys[order], np.array(list(kept.values()))[order]
        names = list(kept)
        self.names = [names[i].decode() for i in order] + [f"<0x{b:02X}>" for b in range(256)]
        # most strings are no piece: a bit for each of 2**20 hash values says so at once
        self.maybe = np.zeros(1 << 20, dtype=bool)
        self.maybe[(self.keys >> np.uint64(44)).astype(np.int64)] = True

    def log_probabilities(self, words: list[bytes]) -> np.ndarray:
        """Natural log of the sum, over all segmentations of a word, of the product of their pieces.

        A word is read with the mark of a word's start before it. Forward
        recursion in log space, for all words of one length at once: what
        reaches a place adds up, by log-sum-exp, all pieces that end there. A
        character that is no piece is spelt by its bytes.
        """
        out = np.zeros(len(words))
        for some, size in self._of_one_length(words, MATRIX_CELLS):
            if size >= LONG_WORD:
                out[some[0]] = self._forward_long(WORD_START + words[some[0]])
            else:
                out[some] = self._forward(b"".join(WORD_START + words[i] for i in some.tolist()), len(some), size)
        return out

    def expected_counts(self, words: list[bytes]) -> np.ndarray:
        """How often each piece of ``names`` is expected in these words, over all their segmentations by probability."""
        counts = np.zeros(len(self.names))
        for some, size in self._of_one_length(words, MATRIX_CELLS // 4):
            if size >= LONG_WORD:
                self._expect_long(WORD_START + words[some[0]], counts)
            else:
                self._expect(b"".join(WORD_START + words[i] for i in some.tolist()), len(some), size, counts)
        return counts

    @staticmethod
    def _of_one_length(words: list[bytes], cells: int) -> Iterator[tuple[np.ndarray, int]]:
        """Places of words that take as many bytes, and how many with the mark; so many that ``cells`` hold them, or a long one."""
        lengths = np.fromiter(map(len, words), np.int64, len(words)) + len(WORD_START)
        order = np.argsort(lengths, kind="stable")
        cuts = np.flatnonzero(np.diff(lengths[order])) + 1
        for group in np.split(order, cuts) if len(order) else []:
            size = int(lengths[group[0]])
            rows = 1 if size >= LONG_WORD else max(1, cells // (size + 1))
            for at in range(0, len(group), rows):
                yield group[at : at + rows], size

    def _forward(self, joined: bytes, n: int, size: int, alpha: np.ndarray | None = None, edges: list | None = None) -> np.ndarray:
        """Natural logs of the words' sums; ``alpha`` takes what reaches each place, ``edges`` the pieces it comes by."""
        data = np.frombuffer(joined, dtype=np.uint8)
        text = Substrings(data)
        base = np.arange(n, dtype=np.int64) * size
        grid = data.reshape(n, size)
        begins = (grid & 0xC0) != 0x80  # a character begins here
        wide = CHARACTER_BYTES[grid]
        alpha = np.empty((size + 1, n)) if alpha is None else alpha
        alpha[:] = -np.inf
        alpha[0] = 0.0
        for i in range(size):
            reached = np.flatnonzero(alpha[i] > -np.inf)
            if len(reached) == 0:
                continue
            here, start = alpha[i][reached], base[reached] + i
            single = np.zeros(len(reached), dtype=bool)
            for j in range(i + 1, min(i + self.longest, size) + 1):
                whole = begins[reached, j] if j < size else np.ones(len(reached), dtype=bool)
                keys = text.hashes(start, start + (j - i))
                hit = np.flatnonzero(self.maybe[(keys >> np.uint64(44)).astype(np.int64)] & whole)
                if len(hit) == 0:
                    continue
                place = np.minimum(np.searchsorted(self.keys, keys[hit]), len(self.keys) - 1)
                same = self.keys[place] == keys[hit]
                hit, place = hit[same], place[same]
                single[hit] |= wide[reached[hit], i] == j - i
                to = reached[hit]
                alpha[j, to] = np.logaddexp(alpha[j, to], here[hit] + self.scores[place])
                if edges is not None:
                    edges.append((i, j, to, place, self.scores[place]))
            left = np.flatnonzero(~single)
            if len(left):  # spell one character by its bytes
                row = reached[left]
                end = np.minimum(i + wide[row, i], size)
                run = np.concatenate([np.zeros((len(left), 1)), np.cumsum(self.byte[grid[row, i:]], axis=1)], axis=1)
                cost = here[left] + run[np.arange(len(left)), end - i]
                alpha[end, row] = np.logaddexp(alpha[end, row], cost)
                if edges is not None:
                    edges.append((i, end, row, None, cost - here[left]))
        return alpha[size]

    def _expect(self, joined: bytes, n: int, size: int, counts: np.ndarray) -> None:
        """Add what is expected in words of one length: forward recursion, then the same backward over its pieces."""
        grid = np.frombuffer(joined, dtype=np.uint8).reshape(n, size)
        alpha, edges = np.empty((size + 1, n)), []
        total = self._forward(joined, n, size, alpha, edges)
        beta = np.full((size + 1, n), -np.inf)
        beta[size] = 0.0
        for i, j, row, place, score in reversed(edges):
            on = score + beta[j, row]
            beta[i, row] = np.logaddexp(beta[i, row], on)
            share = np.exp(alpha[i, row] + on - total[row])
            if place is not None:
                counts += np.bincount(place, weights=share, minlength=len(counts)) if len(place) > 4096 else 0.0
                if len(place) <= 4096:
                    np.add.at(counts, place, share)
                continue
            for k in range(int((j - i).max())):
                inside = i + k < j
                np.add.at(counts, len(self.keys) + grid[row[inside], i + k].astype(np.int64), share[inside])

    def _pieces_from(self, data: np.ndarray, text: Substrings, begins: np.ndarray, low: int, high: int):
        """start, end, score and place in ``names`` of all pieces that begin at places from ``low`` to ``high``, by start."""
        starts = low + np.flatnonzero(begins[low:high])
        found = []
        for length in range(1, self.longest + 1):
            at = starts[: np.searchsorted(starts, len(data) - length, side="right")]
            at = at[begins[at + length]]
            keys = text.hashes(at, at + length)
            hit = np.flatnonzero(self.maybe[(keys >> np.uint64(44)).astype(np.int64)])
            place = np.minimum(np.searchsorted(self.keys, keys[hit]), len(self.keys) - 1)
            same = self.keys[place] == keys[hit]
            hit, place = hit[same], place[same]
            found.append((at[hit], at[hit] + length, place))
        start, end, place = (np.concatenate(x) for x in zip(*found))
        order = np.argsort(start, kind="stable")
        return start[order].tolist(), end[order].tolist(), self.scores[place[order]].tolist(), place[order].tolist()

    def _forward_long(self, word: bytes, alpha: list | None = None, edges: list | None = None) -> float:
        """The same recursion for one long word: its pieces are looked up for many places at once."""
        data = np.frombuffer(word, dtype=np.uint8)
        size, text = len(data), Substrings(data)
        begins = np.ones(size + 1, dtype=bool)
        begins[:size] = (data & 0xC0) != 0x80
        wide = CHARACTER_BYTES[data]
        spelt = np.concatenate([[0.0], np.cumsum(self.byte[data])])
        alpha = [] if alpha is None else alpha
        alpha[:] = [-math.inf] * (size + 1)
        alpha[0] = 0.0

        def reach(end: int, x: float) -> None:
            y = alpha[end]
            low, top = (x, y) if x < y else (y, x)
            alpha[end] = top if low == -math.inf else top + math.log1p(math.exp(low - top))

        for low in range(0, size, STRETCH):
            high = min(low + STRETCH, size)
            starts, ends, scores, places = self._pieces_from(data, text, begins, low, high)
            k = 0
            for i in (low + np.flatnonzero(begins[low:high])).tolist():
                here, single = alpha[i], False
                width = int(wide[i])
                while k < len(starts) and starts[k] == i:
                    if here > -math.inf:
                        reach(ends[k], here + scores[k])
                        if edges is not None:
                            edges.append((i, ends[k], scores[k], places[k]))
                        single |= ends[k] - i == width
                    k += 1
                if here > -math.inf and not single:  # spell one character by its bytes
                    end = min(i + width, size)
                    cost = float(spelt[end] - spelt[i])
                    reach(end, here + cost)
                    if edges is not None:
                        edges.append((i, end, cost, -1))
        return alpha[size]

    def _expect_long(self, word: bytes, counts: np.ndarray) -> None:
        """``_expect`` for one long word."""
        alpha: list[float] = []
        edges: list[tuple[int, int, float, int]] = []
        total = self._forward_long(word, alpha, edges)
        beta = [-math.inf] * (len(word) + 1)
        beta[-1] = 0.0
        for i, j, score, place in reversed(edges):
            on = score + beta[j]
            if on == -math.inf:
                continue
            low, top = sorted((on, beta[i]))
            beta[i] = top if low == -math.inf else top + math.log1p(math.exp(low - top))
            share = math.exp(alpha[i] + on - total)
            for p in (place,) if place >= 0 else (len(self.keys) + b for b in word[i:j]):
                counts[p] += share


_END = int(mix(np.array([0x456E64], dtype=np.uint64))[0].view(np.int64))


def count_words(rows: DataFrame) -> DataFrame:
    """token (a 64-bit hash), word and n of all words: how often each stands in rows that aren't held out.

    Words of held-out rows alone have 0. One end, without a word, for each row that isn't held out.
    Tasks add up what they read, then all tasks' counts meet by token.
    """

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Counted] = []
        size = ends = 0
        for batch in batches:
            out = batch.column("held_out").fill_null(True).to_numpy(zero_copy_only=False)
            ends += int((~out).sum())
            for at, to, data, offsets in slices(batch.column("text"), size=1 << 22):
                words = words_of(data, offsets)
                token, first, which = np.unique(words.hashes.view(np.int64), return_index=True, return_inverse=True)
                taught = np.bincount(which, weights=~out[at:to][words.doc], minlength=len(token)).astype(np.int64)
                held.append(Counted(token, _spelt(words, first), taught))
                size += held[-1].size
                if size > HELD_BYTES:
                    held = [_added(held)]
                    if held[0].size > HELD_BYTES // 2:  # bounds the memory
                        yield _batch(held.pop())
                    size = sum(h.size for h in held)
        if held:
            yield _batch(_added(held))
        yield _batch(Counted(np.array([_END]), pa.nulls(1, pa.large_binary()), np.array([ends])))

    counted = rows.select("text", "held_out").mapInArrow(count, "token long, word binary, n long")
    return counted.groupBy("token", "word").agg(F.sum("n").alias("n"))


class Counted(NamedTuple):
    """Distinct tokens in order, their words and their counts."""

    token: np.ndarray
    word: pa.LargeBinaryArray
    n: np.ndarray

    @property
    def size(self) -> int:
        return self.token.nbytes + self.word.nbytes + self.n.nbytes


def _spelt(words: Words, at: np.ndarray) -> pa.LargeBinaryArray:
    """The words at these places."""
    n = len(words.start)
    bounds = np.empty(2 * n + 1, dtype=np.int64)  # words, and what is between them
    bounds[0 : 2 * n : 2], bounds[1 : 2 * n : 2] = words.start, words.end
    bounds[2 * n] = words.end[-1] if n else 0
    every = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), 2 * n, [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(words.data))]
    )
    return every.take(pa.array(2 * at))


def _added(held: list[Counted]) -> Counted:
    token, first, which = np.unique(np.concatenate([h.token for h in held]), return_index=True, return_inverse=True)
    n = np.bincount(which, weights=np.concatenate([h.n for h in held]), minlength=len(token)).astype(np.int64)
    return Counted(token, pa.concat_arrays([h.word for h in held]).take(pa.array(first)), n)


def _batch(found: Counted) -> pa.RecordBatch:
    columns = [pa.array(found.token), found.word.cast(pa.binary()), pa.array(found.n)]
    return pa.RecordBatch.from_arrays(columns, ["token", "word", "n"])


def learn_pieces(words: DataFrame, pieces: dict[str, float], rounds: int = ROUNDS) -> dict[str, float]:
    """Natural log probabilities of the same pieces, as all distinct ``word`` of a table teach them.

    Expectation and maximization: each round adds up over all words how often
    a piece is expected in them. It learns from words, not from their repeats,
    since it has to spell the ones that were never seen. The probabilities
    given count like PRIOR pieces, so none falls to zero. What reaches the driver is one
    number for each piece.
    """
    for _ in range(rounds):
        shared = words.sparkSession.sparkContext.broadcast(pieces)

        def expect(batches: Iterable[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            lattice = _lattice(shared.value)
            counts = np.zeros(len(lattice.names))
            for batch in batches:
                counts += lattice.expected_counts(batch.column("word").to_pylist())
            some = np.flatnonzero(counts)
            names = pa.array([lattice.names[i] for i in some.tolist()], pa.string())
            yield pa.RecordBatch.from_arrays([names, pa.array(counts[some])], ["piece", "n"])

        found = words.select("word").mapInArrow(expect, "piece string, n double").groupBy("piece").agg(F.sum("n").alias("n"))
        counts = dict(found.toPandas().itertuples(index=False))
        # in order of the pieces, so that sums agree
        known = {p: counts.get(p, 0.0) + PRIOR * math.exp(s) for p, s in pieces.items()}
        bottom = math.log(math.fsum(known.values()))
        pieces = {p: math.log(n) - bottom for p, n in known.items()}
    return pieces


def score_words(counts: DataFrame, pieces: dict[str, float], new: float, n_words: int) -> DataFrame:
    """token, n and own: the natural log probability of a word, worked out once for each.

    Its share of ``n_words`` has the weight 1 - ``new``, and its probability by pieces the weight ``new``.
    """
    shared = counts.sparkSession.sparkContext.broadcast(pieces)

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = _lattice(shared.value)
        for batch in batches:
            own = lattice.log_probabilities(batch.column("word").to_pylist())
            if new < 1:
                n = batch.column("n").to_numpy()
                with np.errstate(divide="ignore"):
                    own = np.logaddexp(own + math.log(new), np.log((1 - new) * n / n_words))
            yield pa.RecordBatch.from_arrays([batch.column("token"), batch.column("n"), pa.array(own)], ["token", "n", "own"])

    return counts.mapInArrow(score, "token long, n long, own double")


def score_texts(docs: DataFrame, held_out: Column, vocabulary: str, learn: bool = False) -> DataFrame:
    """Base and lattice log10 probabilities of every row.

    The base is add-one smoothed word counts of the rows that aren't held out.
    The model's score is the marginal probability of the text over all ways to
    write it as pieces of ``vocabulary`` (a sentencepiece file). Pieces don't
    cross words, so the probability of a text is the product of those of its
    words and of its end, which the training rows teach: one end to so many words.

    The pieces' probabilities are those of the file, or with ``learn`` the ones
    that the distinct words of the training rows teach (``learn_pieces``). Each
    word of these rows then is a way of its own through the lattice, by its
    share of them; pieces have what new words make of all (Witten and Bell:
    distinct words to all words and distinct ones).

    Counts of all words are gathered from the whole corpus, and each word is
    scored once. Those of frequent words (at least 1 in 2**18 of all tokens,
    so no more than 2**18 words) are sent to all tasks; the other words of a
    document are looked up by a join.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score and
    score. Null and empty texts have one token, the end. Repeated rows are
    scored each, also if they share a doc_id, null or not. A word of any length
    takes time in proportion to it. If all rows are
    held out, nothing is known and every token has the base 1 / (V + 1).
    """
    spark = docs.sparkSession
    rows = take(docs, "doc_id", "text").withColumn("held_out", held_out)
    words = materialize(count_words(rows), "token-counts")
    is_end = F.col("token") == _END
    total = words.agg(
        F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum(F.when(F.col("n") > 0, 1)), F.lit(0)),
        F.coalesce(F.sum(F.when(is_end, F.col("n"))), F.lit(0)),
    ).first()
    n_train, n_distinct, n_ends = int(total[0]), int(total[1]), int(total[2])
    words = words.filter(~is_end)
    pieces, new = read_pieces(vocabulary), 1.0
    if learn and n_train > n_ends:
        taught, seen = n_distinct - (n_ends > 0), n_train - n_ends
        pieces, new = learn_pieces(words.filter("n > 0"), pieces), taught / (taught + seen)
    counts = materialize(score_words(words, pieces, new, n_train - n_ends), "word-scores")
    least = max(1, -(-n_train // FREQUENT))
    frequent = counts.filter(F.col("n") >= least).toPandas().sort_values("token")
    lookup = spark.sparkContext.broadcast(tuple(frequent[c].to_numpy() for c in ("token", "n", "own")))
    bottom = n_train + n_distinct + 1
    end_base = math.log10((n_ends + 1) / bottom)
    # a text goes on or ends after each word
    p_end = (n_ends + 1) / (n_train + 2)
    log_end, log_on = math.log(p_end), math.log(1 - p_end)
    base_of = lambda c: np.log10((c + 1) / bottom)

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, known, logs = lookup.value
        for batch in batches:
            for at, to, data, offsets in slices(batch.column("text"), size=1 << 22):
                words = words_of(data, offsets)
                n_docs, doc = to - at, words.doc
                distinct, which = np.unique(words.hashes.view(np.int64), return_inverse=True)
                place = np.minimum(np.searchsorted(tokens, distinct), max(len(tokens) - 1, 0))
                hit = tokens[place] == distinct if len(tokens) else np.zeros(len(distinct), bool)
                base, own = np.zeros(len(distinct)), np.zeros(len(distinct))
                base[hit], own[hit] = base_of(known[place[hit]]), logs[place[hit]]
                in_frequent = hit[which]
                weight = lambda w: np.bincount(doc, weights=w, minlength=n_docs)
                # the rest, as lists of distinct tokens and how often they stand in the text
                rare = np.flatnonzero(~in_frequent)
                pair, times = np.unique(
                    np.stack([doc[rare], which[rare]], axis=1), axis=0, return_counts=True
                ) if len(rare) else (np.zeros((0, 2), np.int64), np.zeros(0, np.int64))
                ends = pa.array(np.searchsorted(pair[:, 0], np.arange(n_docs + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(at, n_docs),
                        batch.column("held_out").slice(at, n_docs),
                        pa.array(words.counts.astype(np.int64) + 1),
                        pa.array(weight(in_frequent).astype(np.int64)),
                        pa.array(weight(base[which])),
                        pa.array(weight(own[which]) + words.counts * log_on + log_end),
                        pa.ListArray.from_arrays(ends, pa.array(distinct[pair[:, 1]])),
                        pa.ListArray.from_arrays(ends, pa.array(times.astype(np.int32))),
                    ],
                    ["doc_id", "held_out", "n_tokens", "hits", "base", "own", "tokens", "times"],
                )

    kind = rows.schema["doc_id"].dataType.simpleString()
    scored = rows.mapInArrow(
        score,
        f"doc_id {kind}, held_out boolean, n_tokens long, hits long, base double, own double,"
        " tokens array<long>, times array<int>",
    )
    # a number for each row, so that rows that share an id stay apart
    scored = materialize(scored.withColumn("row", F.monotonically_increasing_id()), "scored")
    rare = scored.select("row", F.explode(F.arrays_zip("tokens", "times")).alias("x")).select(
        "row", F.col("x.tokens").alias("token"), F.col("x.times").alias("times")
    )
    unknown = math.log10(1 / bottom)
    found = (
        rare.join(counts.withColumnRenamed("own", "log"), "token")
        .groupBy("row")
        .agg(
            F.sum(F.when(F.col("n") > 0, F.col("times"))).alias("known"),
            # what the found words have above unknown ones
            F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("above"),
            F.sum(F.col("times") * F.col("log")).alias("more"),
        )
    )
    none = F.coalesce(F.aggregate("times", F.lit(0), lambda a, x: a + x), F.lit(0))
    ends_known = int(n_ends > 0)
    return scored.join(found.withColumnRenamed("row", "r"), F.col("row") == F.col("r"), "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("hits") + F.coalesce("known", F.lit(0)) + ends_known).cast("long").alias("n_known"),
        F.lit(n_train).cast("long").alias("train_tokens"),
        (F.col("base") + none * F.lit(unknown) + F.coalesce("above", F.lit(0.0)) + F.lit(end_base)).alias("base_score"),
        ((F.col("own") + F.coalesce("more", F.lit(0.0))) / F.lit(_LN10)).alias("score"),
    )


_LATTICES: dict[int, Lattice] = {}


def _lattice(pieces: dict[str, float]) -> Lattice:
    """The lattice of this Python worker, kept from one task to the next."""
    key = hash(frozenset(pieces.items()))
    if key not in _LATTICES:
        _LATTICES.clear()
        _LATTICES[key] = Lattice(pieces)
    return _LATTICES[key]
