"""Drop lines that many documents share: range partitions in order, streamed once, keep bitmaps."""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import materialize, take

#: Code points of a key from which its lines count, and documents it must be in to lose them.
MIN_CHARS = 20
MIN_DOCS = 3
#: Stands for a null doc_id: the smallest document.
NAMELESS = -(1 << 63)

#: What a row of the streamed pass is: a line to drop, one to judge later, or a document that holds a key.
DROP, OPEN, HOLDER = 0, 1, 2

_BLANKS = "".join(map(chr, (32, *range(9, 14))))
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_COLUMNS = ("h1", "h2", "doc", "fp", "pos")


def line_key(line: Column) -> Column:
    """A line without ASCII white space at both ends, in lower case as far as A to Z go."""
    return F.translate(F.btrim(line, F.lit(_BLANKS)), _UPPER, _UPPER.lower())


def _identified(docs: DataFrame, *more: Column) -> DataFrame:
    """doc, fp: which document a row is, and which text of it. Rows that repeat both hold the same lines."""
    rows = take(docs, "doc_id", "text")
    text = F.coalesce("text", F.lit(""))
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(NAMELESS))
    return rows.select(doc.alias("doc"), F.xxhash64(text).alias("fp"), *more)


class _Stream:
    """Reads the sorted lines of one range partition and says which to drop.

    Lines come by key, then from the largest document down, so the first
    document of a key keeps its lines, and those of the third and all later
    ones go (for ``min_docs`` of three). Only lines of those between are held
    back until one more turns up or the key ends: at most ``min_docs`` - 2
    documents'. A key at either end of the partition
    may go on in the next one: what the partition can't decide alone stays open.
    """

    def __init__(self, min_docs: int) -> None:
        self.min_docs = min_docs
        self.last: np.ndarray | None = None  # h1, h2, doc of the row before
        self.in_first = True  # still in the partition's first key
        self.n_docs = 0  # documents of the current key so far
        self.held: list[np.ndarray] = []
        self.holders: list[int] = []

    def _holder_rows(self) -> np.ndarray:
        out = np.zeros((5, len(self.holders)), dtype=np.int64)
        out[:2] = self.last[:2, None]
        out[2] = self.holders
        return out

    def _run_end(self) -> list[tuple[int, np.ndarray]]:
        """What to write when the first key of the partition ends."""
        return [(HOLDER, self._holder_rows())]

    def feed(self, rows: np.ndarray) -> list[tuple[int, np.ndarray]]:
        """rows: h1, h2, doc, fp, pos as five lines of a matrix."""
        out: list[tuple[int, np.ndarray]] = []
        n = rows.shape[1]
        if not n:
            return out
        before = np.concatenate([rows[:3, :1] if self.last is None else self.last[:, None], rows[:3, :-1]], axis=1)
        new_key = (rows[:2] != before[:2]).any(axis=0)
        new_doc = new_key | (rows[2] != before[2])
        if self.last is None:
            new_doc[0] = True  # the partition begins
        if new_key[0]:
            out += self._close()
        # number of the document within its key, from 1
        run = np.cumsum(new_key)
        if new_key[0]:
            run -= 1
        count = np.cumsum(new_doc)
        starts = np.flatnonzero(np.r_[True, run[1:] != run[:-1]])
        base = count[starts] - new_doc[starts]
        base[0] -= self.n_docs
        ordinal = count - base[run]
        ends = np.r_[starts[1:], n] - 1
        total = ordinal[ends]
        first = (run == 0) & self.in_first
        last = run == run[-1]
        many = total[run] >= self.min_docs
        if self.held and total[0] >= self.min_docs:
            out += [(DROP, h) for h in self.held]
            self.held = []
        if len(starts) > 1 and self.in_first:  # the first key of the partition ends within these rows
            self._note(rows, new_doc, run == 0)
            self.last = rows[:3, ends[0]]
            out += self._run_end()
            self.holders, self.in_first = [], False
        elif len(starts) > 1:
            self.holders, self.held = [], []
        # the documents up to the last one that may be too few
        later = ordinal >= 2
        wait = later & ~many & last & ~first
        out += [(OPEN, rows[:, first]), (DROP, rows[:, later & many & ~first])]
        if wait.any():
            self.held.append(rows[:, wait])
        self._note(rows, new_doc, last)
        self.n_docs = int(total[-1])
        self.last = rows[:3, -1]
        return [(kind, r) for kind, r in out if r.shape[1]]

    def _note(self, rows: np.ndarray, new_doc: np.ndarray, where: np.ndarray) -> None:
        room = self.min_docs - len(self.holders)
        if room > 0:
            self.holders += rows[2, np.flatnonzero(new_doc & where)[:room]].tolist()

    def _close(self) -> list[tuple[int, np.ndarray]]:
        """The current key ended exactly with the rows before."""
        out = self._run_end() if self.in_first and self.last is not None else []
        self.n_docs, self.held, self.holders, self.in_first = 0, [], [], False
        return out

    def finish(self) -> list[tuple[int, np.ndarray]]:
        if self.last is None:
            return []
        return [(OPEN, h) for h in self.held] + [(HOLDER, self._holder_rows())]


def _judge(min_docs: int):
    def judge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream = _Stream(min_docs)

        def told(found: list[tuple[int, np.ndarray]]) -> Iterator[pa.RecordBatch]:
            for kind, rows in found:
                arrays = [pa.array(np.full(rows.shape[1], kind, dtype=np.int8)), *(pa.array(r) for r in rows)]
                yield pa.RecordBatch.from_arrays(arrays, ["kind", *_COLUMNS])

        for batch in batches:
            rows = np.stack([batch.column(c).cast(pa.int64()).to_numpy(zero_copy_only=False) for c in _COLUMNS])
            yield from told(stream.feed(rows))
        yield from told(stream.finish())

    return judge


def _bitmaps(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep, dropped = [], []
        for n, lost in zip(batch.column("n_lines").to_pylist(), batch.column("lost")):
            bits = np.ones(n, dtype=bool)
            if lost.is_valid:
                bits[lost.values.to_numpy(zero_copy_only=False)] = False
            keep.append(zlib.compress(np.packbits(bits).tobytes()))
            dropped.append(n - int(bits.sum()))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc"), batch.column("fp"), batch.column("n_lines"), pa.array(dropped, pa.int64()), pa.array(keep, pa.binary())],
            ["doc", "fp", "n_lines", "n_dropped", "keep"],
        )


def line_bitmaps(
    docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, parts: int | None = None
) -> DataFrame:
    """Which lines of each text stay: doc, fp, n_lines, n_dropped and keep.

    A line's key is the line without ASCII white space at both ends, A to Z in
    lower case. A key of ``min_chars`` code points or more that is in
    ``min_docs`` (2 or more) documents or more loses all its lines but those in
    the largest doc_id that holds it.

    Two hashes of each key (128 bits) with document and position are dealt out
    by range, over all these columns, and sorted: a key that is in a third of
    all lines takes as many partitions as it needs. Each partition is read once
    in order, with the lines of ``min_docs`` - 2 documents in memory at most. It reports up
    to ``min_docs`` holders of its first and its last key; only the lines of
    those keys are judged in a second step, against a table of two keys for
    each task at most. Texts are never shuffled, and what comes back is small:
    ``keep`` has one bit for each line, first line first, compressed by zlib.

    ``doc`` is the doc_id, the least long for null: rows without a doc_id are
    one document, the smallest. ``fp`` is the hash of the text; rows that share
    a doc_id are one document, with a bitmap for each of their texts. A null or
    empty text is one empty line. There are no rows for an empty table. Long
    texts are cut into lines by the JVM and may have any number of them.
    """
    if min_docs < 2:
        raise ValueError("a line of a single document is no repeat")
    text = F.coalesce("text", F.lit(""))
    lines = _identified(docs, F.posexplode(F.split(text, "\n")).alias("pos", "line"))
    key = line_key(F.col("line"))
    lines = lines.select("doc", "fp", "pos", key.alias("key")).filter(F.char_length("key") >= min_chars)
    lines = lines.select(
        F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), F.col("key")).alias("h2"), "doc", "fp", "pos"
    )
    order = ["h1", "h2", F.desc("doc"), "pos", "fp"]
    ranged = lines.repartitionByRange(parts, *order) if parts else lines.repartitionByRange(*order)
    schema = "kind byte, " + ", ".join(f"{c} long" for c in _COLUMNS)
    # a second run of a range partition may cut elsewhere: what it said is written down
    told = materialize(ranged.sortWithinPartitions(*order).mapInArrow(_judge(min_docs), schema), "shared-lines")

    holders = told.filter(f"kind = {HOLDER}").groupBy("h1", "h2").agg(
        F.max("doc").alias("top"), F.size(F.collect_set("doc")).alias("n")
    )
    # at most two keys a task
    edges = F.broadcast(holders.filter(f"n >= {min_docs}"))
    lost = told.filter(f"kind = {DROP}").select("doc", "fp", "pos").unionAll(
        told.filter(f"kind = {OPEN}").join(edges, ["h1", "h2"]).filter("doc != top").select("doc", "fp", "pos")
    )
    # the lines of one text; a set, since rows may repeat
    lost = lost.groupBy(F.col("doc").alias("d"), F.col("fp").alias("f")).agg(F.collect_set("pos").alias("lost"))
    n_lines = (F.char_length(text) - F.char_length(F.translate(text, "\n", "")) + 1).cast("long")
    texts = _identified(docs, n_lines.alias("n_lines")).distinct()
    joined = texts.join(lost, (F.col("doc") == F.col("d")) & (F.col("fp") == F.col("f")), "left")
    return joined.select("doc", "fp", "n_lines", "lost").mapInArrow(
        _bitmaps, "doc long, fp long, n_lines long, n_dropped long, keep binary"
    )


def kept_lines(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped and text: the lines that ``keep`` of ``line_bitmaps`` leaves, joined by line feeds.

    Of a row that keeps no line the text is empty. Rows that repeat each come
    back. This is where texts are shuffled, once, to meet their bitmaps.
    """

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, lost = [], batch.column("n_dropped").to_pylist()
            for text, keep, n in zip(batch.column("text").to_pylist(), batch.column("keep").to_pylist(), lost):
                if n:
                    lines = text.split("\n")
                    bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8), count=len(lines))
                    text = "\n".join([lines[i] for i in np.flatnonzero(bits).tolist()])
                texts.append(text)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_lines"), batch.column("n_dropped"), pa.array(texts, pa.string())],
                ["doc_id", "n_lines", "n_dropped", "text"],
            )

    text = F.coalesce("text", F.lit(""))
    rows = _identified(docs, F.col("doc_id"), text.alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    found = bitmaps.select(F.col("doc").alias("d"), F.col("fp").alias("f"), "n_lines", "n_dropped", "keep")
    met = rows.join(found, (F.col("doc") == F.col("d")) & (F.col("fp") == F.col("f")))
    return met.select("doc_id", "text", "n_lines", "n_dropped", "keep").mapInArrow(
        cut, f"doc_id {kind}, n_lines long, n_dropped long, text string"
    )
