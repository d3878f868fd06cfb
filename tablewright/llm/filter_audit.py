"""What each filter of a cascade removes, in every order: counting-Bloom prepass and additive mask counts."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import WORD, materialize, materialize_few, take

#: Counters for each text, counters of a block, and the most bytes all counters may take (four to a byte).
COUNTERS_PER_TEXT = 8
BLOCK = 1 << 12
SKETCH_BYTES = 1 << 26
#: Cells that a task gathers before it writes a partial sketch.
FLUSH = 1 << 22

#: The filters, and the bit of each in a mask.
FILTERS = "ABCDE"

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_SYMBOLS = "#$%&*|"


def text_filters(text: Column) -> Column:
    """Bits of filters A to D that a text (not null) fails.

    A: fewer than 50 words; B: under 65 % of the words are distinct; C: over
    5 % of the code points are A to Z; D: holds one of ``#$%&*|``.
    """
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    chars = F.char_length(text)
    upper = chars - F.char_length(F.translate(text, _UPPER, ""))
    symbols = chars - F.char_length(F.translate(text, _SYMBOLS, ""))
    fails = [n < 50, distinct * 100 < n * 65, upper * 100 > chars * 5, symbols > 0]
    bits = [F.when(fail, 1 << i).otherwise(0) for i, fail in enumerate(fails)]
    return (bits[0] + bits[1] + bits[2] + bits[3]).alias("mask")


# ---- counting Bloom filter, in blocks


def _hashes(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2")]


def _cells(h2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two counters of a text within its block; they may be one."""
    return h2 & (BLOCK - 1), (h2 >> 12) & (BLOCK - 1)


def _partial_sketches(blocks: int):
    """Counters of the rows of one task, up to 2, as (block, cells, counts)."""

    def flush(cells: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        block = cells // BLOCK
        begin = np.flatnonzero(np.r_[True, block[1:] != block[:-1]]) if len(cells) else np.zeros(0, np.int64)
        ends = np.r_[begin[1:], len(cells)]
        inside, counts = (cells % BLOCK).astype(np.uint16), counts.astype(np.uint8)
        for at in range(0, len(begin), 1 << 12):
            pairs = list(zip(begin[at : at + (1 << 12)].tolist(), ends[at : at + (1 << 12)].tolist()))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(block[begin[at : at + (1 << 12)]]),
                    pa.array([inside[i:j].tobytes() for i, j in pairs], pa.binary()),
                    pa.array([counts[i:j].tobytes() for i, j in pairs], pa.binary()),
                ],
                ["block", "cells", "counts"],
            )

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            h1, h2 = (batch.column(c).to_numpy() for c in ("h1", "h2"))
            one, two = _cells(h2)
            at = h1 % blocks * BLOCK
            more = np.concatenate([at + one, (at + two)[one != two]])
            cells, back = np.unique(np.concatenate([cells, more]), return_inverse=True)
            counts = np.bincount(back, weights=np.concatenate([counts, np.ones(len(more))]), minlength=len(cells))
            counts = np.minimum(counts, 2).astype(np.int64)
            if len(cells) > FLUSH:
                yield from flush(cells, counts)
                cells, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        yield from flush(cells, counts)

    return count


def _merge(table: pa.Table) -> pa.Table:
    """The partial sketches of one block (at most BLOCK cells from each task) to its counters, four to a byte."""
    total = np.zeros(BLOCK, dtype=np.uint8)
    for cells, counts in zip(table.column("cells"), table.column("counts")):
        at = np.frombuffer(cells.as_py(), np.uint16)
        total[at] = np.minimum(total[at] + np.frombuffer(counts.as_py(), np.uint8), 2)
    four = total.reshape(-1, 4)
    packed = (four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6).view(np.int8)
    return pa.table({"block": table.column("block").slice(0, 1), "counters": pa.array([packed], pa.list_(pa.int8()))})


def counting_sketch(hashes: DataFrame, n: int, most_bytes: int = SKETCH_BYTES) -> tuple[DataFrame, int]:
    """block and counters of a counting Bloom filter over ``hashes`` (h1, h2), and the number of blocks.

    Counters stop at 2. There are COUNTERS_PER_TEXT for each of the ``n`` rows,
    but never more than fit in ``most_bytes``: that bounds what is broadcast.
    Beyond it counters fill up, and more texts look like possible repeats,
    which costs shuffle but never a result.
    """
    blocks = 1
    while blocks * BLOCK < n * COUNTERS_PER_TEXT and blocks * BLOCK // 4 < most_bytes:
        blocks *= 2
    partial = hashes.select("h1", "h2").mapInArrow(_partial_sketches(blocks), "block long, cells binary, counts binary")
    return partial.groupBy("block").applyInArrow(_merge, "block long, counters array<tinyint>"), blocks


def possible_repeats(rows: DataFrame, sketch: DataFrame, blocks: int, least: int = 2) -> DataFrame:
    """``rows`` (with h1, h2) and a boolean column ``maybe``: false if the sketch has seen them less than ``least`` times.

    With 2, what is false has no other row with its text; with 1, it isn't in the sketch. Both are certain.
    """
    counters = F.broadcast(sketch.select(F.col("block").alias("sketch_block"), "counters"))
    met = rows.join(counters, F.expr(f"pmod(h1, {blocks}L)") == F.col("sketch_block"), "left")
    met = met.withColumn("one", F.expr(f"cast(h2 & {BLOCK - 1} as int)"))
    met = met.withColumn("two", F.expr(f"cast(shiftright(h2, 12) & {BLOCK - 1} as int)"))
    held = [f"(shiftright(cast(counters[shiftright({c}, 2)] as int), ({c} & 3) * 2) & 3) >= {least}" for c in ("one", "two")]
    maybe = F.coalesce(F.expr(" and ".join(held)), F.lit(False))
    return met.withColumn("maybe", maybe).drop("counters", "sketch_block", "one", "two")


def without(rows: DataFrame, key: Column, gone: DataFrame) -> DataFrame:
    """``rows`` whose ``key`` (not null) isn't among those of ``gone``, a written frame of one column.

    A sketch of ``gone`` says for most rows that they stay; only those that may
    go are shuffled, and met with ``gone`` itself. ``rows`` must have no columns h1, h2 and maybe.
    """
    (name,) = gone.columns
    hashes = lambda c: [F.xxhash64(c).alias("h1"), F.xxhash64(F.lit(1), c).alias("h2")]
    sketch, blocks = counting_sketch(gone.select(*hashes(F.col(name))), gone.count())
    judged = possible_repeats(rows.select("*", *hashes(key)), materialize_few(sketch, "gone-ids"), blocks, least=1)
    maybe = judged.filter("maybe").join(gone, key == F.col(name), "left_anti")
    return judged.filter("not maybe").select(*rows.columns).unionAll(maybe.select(*rows.columns))


def _later_copies(docs: DataFrame, flagged: DataFrame, most_bytes: int) -> DataFrame:
    """``flagged`` with ``copy``: whether a smaller doc_id has the same text."""
    sketch, blocks = counting_sketch(flagged, flagged.count(), most_bytes)
    sketch = materialize(sketch, "text-sketch")
    text = F.coalesce("text", F.lit(""))
    texts = take(docs, "doc_id", "text").select(
        F.col("doc_id").cast("long").alias("doc"), text.alias("text"), *_hashes(text)
    )
    # copies of a text meet within each task first, so a text that fills a third of all rows is one row a task
    first = possible_repeats(texts, sketch, blocks).filter("maybe").groupBy("h1", "h2", "text").agg(
        F.min("doc").alias("first"), F.count("*").alias("n")
    )
    first = first.filter("n > 1").select(F.col("h1").alias("a"), F.col("h2").alias("b"), "first")
    judged = possible_repeats(flagged, sketch, blocks)
    checked = judged.filter("maybe").join(first, (F.col("h1") == F.col("a")) & (F.col("h2") == F.col("b")), "left")
    out = ("doc", "part", "mask")
    return judged.filter("not maybe").select(*out, F.lit(False).alias("copy")).unionAll(
        checked.select(*out, F.coalesce(F.col("doc") > F.col("first"), F.lit(False)).alias("copy"))
    )


def mask_counts(docs: DataFrame, labels: DataFrame, most_bytes: int = SKETCH_BYTES) -> DataFrame:
    """part, mask, n, good and toxic: documents of each source that fail exactly the filters of ``mask``.

    ``part`` is the source, the empty string for null. Bits 0 to 3 of the mask
    are ``text_filters``; bit 4 is filter E, which a row fails if a smaller
    doc_id has an identical text, in whatever source.

    For E a counting Bloom filter is taken of the hashes of all texts: each
    task counts its own rows, and partial sketches are merged block by block. A text
    one of whose counters says 1 is unique and done with. Only what may repeat
    is shuffled, and grouped by the whole text for its smallest doc_id; that
    meets the rows again by 128 bits of hash. The merged sketch is broadcast:
    two bits for each of eight counters a text, at most ``most_bytes``, beyond
    which fewer texts are cleared and the results stay the same.

    ``good`` and ``toxic`` count documents that ``labels`` (doc_id, quality,
    toxic) give quality 1 or toxic 1; of repeated labels one suffices. A null
    or empty text has no words and fails A; empty texts are copies of each other. A
    row without a doc_id is never a copy nor has copies, and has no label; rows
    that share a doc_id aren't each other's copies. All counts can be added up
    over parts. An empty table gives no rows. Long texts are read by the JVM, whole.
    """
    text = F.coalesce("text", F.lit(""))
    rows = take(docs, "doc_id", "text", "source").select(
        F.col("doc_id").cast("long").alias("doc"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        text_filters(text),
        *_hashes(text),
    )
    rows = materialize(rows, "text-flags")
    flagged = _later_copies(docs, rows, most_bytes)
    mask = (F.col("mask") + F.when(F.col("copy"), 1 << 4).otherwise(0)).alias("mask")
    marks = take(labels, "doc_id", "quality", "toxic").groupBy(F.col("doc_id").cast("long").alias("id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    joined = flagged.select("doc", "part", mask).join(marks, F.col("doc") == F.col("id"), "left")
    return joined.groupBy("part", "mask").agg(
        F.count("*").alias("n"),
        F.coalesce(F.sum("good"), F.lit(0)).alias("good"),
        F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"),
    )


def audit_filters(docs: DataFrame, labels: DataFrame, most_bytes: int = SKETCH_BYTES) -> DataFrame:
    """A row for each part, order of the five filters, and step: what its filter removes there, and what that costs.

    part, filter_order, step (1 to 5), and long counts of documents: kept after
    the step, removed by it, redundant (failing its filter, removed earlier),
    unique_fails (failing its filter alone), good_lost and toxic_lost (removed here,
    so labelled), shapley (removed by its filter, summed over all 120 orders).
    Steps that remove nothing have their row too. All follow from
    ``mask_counts``, which see for null, empty, repeated and nameless rows: a
    part has 32 masks at most, whatever its size. A document that fails k
    filters is removed by each of them in 120 / k orders.
    """
    counts = mask_counts(docs, labels, most_bytes)
    # 32 masks at most in each part
    parts = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("masks"))
    orders = ["".join(p) for p in permutations(FILTERS)]
    rows = parts.select("part", "masks", F.explode(F.lit(orders)).alias("filter_order"))
    rows = rows.select("*", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))
    bits = lambda letters: " + ".join(
        f"if(instr({letters}, '{c}') > 0, {1 << i}, 0)" for i, c in enumerate(FILTERS)
    )
    rows = rows.withColumn("bit", F.expr(bits("substr(filter_order, step, 1)")))
    rows = rows.withColumn("before", F.expr(bits("substr(filter_order, 1, step - 1)")))
    here = "(m.mask & bit) != 0 and (m.mask & before) = 0"

    def total(value: str, where: str) -> Column:
        return F.expr(f"aggregate(filter(masks, m -> {where}), 0L, (s, m) -> s + m.{value})")

    share = "aggregate(filter(masks, m -> (m.mask & bit) != 0), 0L, (s, m) -> s + m.n * 120 div bit_count(m.mask))"
    return rows.select(
        "part",
        "filter_order",
        "step",
        total("n", "(m.mask & (before | bit)) = 0").alias("kept"),
        total("n", here).alias("removed"),
        total("n", "(m.mask & bit) != 0 and (m.mask & before) != 0").alias("redundant"),
        total("n", "m.mask = bit").alias("unique_fails"),
        total("good", here).alias("good_lost"),
        total("toxic", here).alias("toxic_lost"),
        F.expr(share).alias("shapley"),
    )
