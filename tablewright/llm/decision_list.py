"""Quality rules: statistics of texts, and decision lists learned from labels."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import materialize, mix, slices, take, words_of

WINDOW = 5
SYMBOLS = b"#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_chars")
#: Labelled rows the rules are fitted on, at most; taken in the order of a hash of doc_id.
TRAINING_ROWS = 20_000


def count_texts(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The statistics of COUNTS for texts that stand one after the other in ``data``."""
    n = len(offsets) - 1
    words = words_of(data, offsets, lower=False)
    counts, doc = words.counts, words.doc

    def per_text(mask: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
        return sums[offsets[1:]] - sums[offsets[:-1]]

    point = (data & 0xC0) != 0x80  # bytes that begin a code point
    sums = np.concatenate([[0], np.cumsum(point, dtype=np.int64)])
    word_chars = np.bincount(doc, weights=sums[words.end] - sums[words.start], minlength=n).astype(np.int64)

    # lines are numbered through; those with words get a hash over their own bytes
    break_ = data == 10
    begins = np.zeros(len(data) + 1, dtype=bool)
    begins[offsets] = True
    begins[1:] |= break_
    line_start = np.flatnonzero(begins[:-1]) if len(data) else np.zeros(0, np.int64)
    line_doc = np.searchsorted(offsets, line_start, side="right") - 1
    wordy = np.zeros(len(line_start), dtype=bool)
    wordy[np.searchsorted(line_start, words.start, side="right") - 1] = True
    lines = words_of(data, offsets, separators=_LINE_BREAK, lower=False)  # whole lines as words
    # an empty line is no word here, and has no words either
    place = np.searchsorted(line_start, lines.start)
    keys = np.stack([line_doc[place], lines.hashes.view(np.int64)])[:, wordy[place]]
    dup_lines = _repeats_after_first(keys[0], keys[1], n)

    # windows of words, and the words that repeated windows cover
    repeat = np.zeros(n, dtype=np.int64)
    m = len(words.hashes) - WINDOW + 1
    if m > 0:
        same_text = doc[:m] == doc[WINDOW - 1 :]
        at = np.flatnonzero(same_text)
        key = np.zeros(len(at), dtype=np.uint64)
        for k in range(WINDOW):
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + words.hashes[at + k])
        found = _found_twice(doc[at], key)
        cover = np.zeros(len(words.hashes) + 1, dtype=np.int64)
        np.add.at(cover, at[found], 1)
        np.add.at(cover, at[found] + WINDOW, -1)
        repeat = np.bincount(doc, weights=np.cumsum(cover[:-1]) > 0, minlength=n).astype(np.int64)
    return {
        "n_words": counts.astype(np.int64),
        "word_chars": word_chars,
        "n_symbols": per_text(_IS_SYMBOL[data]),
        "n_dup_lines": dup_lines,
        "n_repeat_words": repeat,
        "n_lines": np.bincount(line_doc[wordy], minlength=n).astype(np.int64),
        "n_chars": per_text(point),
    }


_IS_SYMBOL = np.zeros(256, dtype=bool)
_IS_SYMBOL[list(SYMBOLS)] = True
_LINE_BREAK = np.zeros(256, dtype=bool)
_LINE_BREAK[10] = True


def _order(group: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((key, group))
    g, k = group[order], key[order]
    return order, (g[1:] == g[:-1]) & (k[1:] == k[:-1])


def _found_twice(group: np.ndarray, key: np.ndarray) -> np.ndarray:
    out = np.zeros(len(key), dtype=bool)
    if len(key) > 1:
        order, same = _order(group, key)
        out[order[1:][same]] = True
        out[order[:-1][same]] = True
    return out


def _repeats_after_first(group: np.ndarray, key: np.ndarray, n: int) -> np.ndarray:
    if len(key) < 2:
        return np.zeros(n, dtype=np.int64)
    order, same = _order(group, key)
    return np.bincount(group[order[1:][same]], minlength=n).astype(np.int64)


def text_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and the statistics of every row; null and empty texts have zeros."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to, data, offsets in slices(batch.column("text")):
                found = count_texts(data, offsets)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(at, to - at), *[pa.array(found[c], pa.int64()) for c in COUNTS]],
                    ["doc_id", *COUNTS],
                )

    rows = take(docs, "doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(count, f"doc_id {kind}, " + ", ".join(f"{c} long" for c in COUNTS))


def ratios() -> dict[str, Column]:
    """What the rules look at: counts, and counts per word, line or character."""
    per = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1))
    return {
        "n_words": F.col("n_words").cast("double"),
        "mean_word_chars": per("word_chars", "n_words"),
        "symbols_per_word": per("n_symbols", "n_words"),
        "dup_line_share": per("n_dup_lines", "n_lines"),
        "repeat_share": per("n_repeat_words", "n_words"),
        "words_per_line": per("n_words", "n_lines"),
        "word_share": per("word_chars", "n_chars"),
    }


class Test(NamedTuple):
    feature: str
    above: bool
    threshold: float

    def column(self, features: dict[str, Column]) -> Column:
        c = features[self.feature]
        return c > self.threshold if self.above else c <= self.threshold

    def holds(self, data: dict[str, np.ndarray]) -> np.ndarray:
        x = data[self.feature]
        return x > self.threshold if self.above else x <= self.threshold


class Rule(NamedTuple):
    """If all tests hold, ``label``; ``support`` and ``hits`` count its training rows."""

    tests: tuple[Test, ...]
    label: int
    support: int
    hits: int

    def __str__(self) -> str:
        return " and ".join(f"{t.feature} {'>' if t.above else '<='} {t.threshold:g}" for t in self.tests)


def _holds(tests: Sequence[Test], data: dict[str, np.ndarray], n: int) -> np.ndarray:
    out = np.ones(n, dtype=bool)
    for t in tests:
        out &= t.holds(data)
    return out


def _best_test(data, label, alive) -> tuple[float, Test] | None:
    """The threshold with the largest information gain, times the hits kept."""
    y = label[alive]
    p0, n0 = y.sum(), len(y) - y.sum()
    if p0 == 0 or n0 == 0:
        return None
    before, best = np.log2(p0 / (p0 + n0)), None
    for name in data:
        x = data[name][alive]
        order = np.argsort(x, kind="stable")
        xs, hits = x[order], np.cumsum(y[order])
        cut = np.flatnonzero(xs[1:] > xs[:-1])
        for above in (False, True):
            p = (p0 - hits[cut]) if above else hits[cut]
            n = (len(y) - cut - 1 if above else cut + 1) - p
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(p > 0, p * (np.log2(p / (p + n)) - before), -np.inf)
            if len(gain) and (best is None or gain.max() > best[0] + 1e-12):
                k = int(gain.argmax())
                best = float(gain[k]), Test(name, above, float((xs[cut[k]] + xs[cut[k] + 1]) / 2))
    return best


def learn_decision_list(
    data: dict[str, np.ndarray],
    label: np.ndarray,
    target: int = 0,
    max_tests: int = 4,
    max_rules: int = 12,
    least_precision: float = 0.95,
) -> list[Rule]:
    """Rules for ``target``, by sequential covering; what no rule covers has the other label.

    Each round splits the rows not yet covered two to one by position. On the larger
    part a rule grows test by test, each with the largest gain; on the smaller part it is pruned from
    its end as long as that doesn't worsen (hits - misses) / (hits + misses). A rule that is right
    for less than ``least_precision`` of what it covers ends the list: what is clean must stay. No rows, or rows of one label,
    give an empty list.
    """
    is_target = (label == target).astype(np.int64)
    left = np.ones(len(label), dtype=bool)
    rules: list[Rule] = []
    while len(rules) < max_rules and is_target[left].sum() > 0 and (1 - is_target[left]).sum() > 0:
        at = np.flatnonzero(left)
        to_prune = at[np.arange(len(at)) % 3 == 2]
        to_grow = at[np.arange(len(at)) % 3 != 2]
        grow = {k: v[to_grow] for k, v in data.items()}
        tests: list[Test] = []
        while len(tests) < max_tests:
            found = _best_test(grow, is_target[to_grow], _holds(tests, grow, len(to_grow)))
            if found is None or found[0] <= 1e-9:
                break
            tests.append(found[1])
        prune = {k: v[to_prune] for k, v in data.items()}

        def worth(k: int, tests=tests, prune=prune, to_prune=to_prune) -> float:
            y = is_target[to_prune][_holds(tests[:k], prune, len(to_prune))]
            return (2 * y.sum() - len(y)) / len(y) if len(y) else -1.0

        if not tests:
            break
        keep = max(range(1, len(tests) + 1), key=lambda k: (worth(k), -k))
        tests = tests[:keep]
        covered = left & _holds(tests, data, len(label))
        hits = int(is_target[covered].sum())
        if covered.sum() == 0 or hits < least_precision * covered.sum():
            break
        rules.append(Rule(tuple(tests), target, int(covered.sum()), hits))
        left &= ~covered
    return rules


def decision_column(rules: Sequence[Rule], otherwise: int, features: dict[str, Column]) -> Column:
    """The rules as one ordered conditional expression; the first that holds decides."""
    out = None
    for rule in rules:
        when = rule.tests[0].column(features)
        for t in rule.tests[1:]:
            when = when & t.column(features)
        out = F.when(when, F.lit(rule.label)) if out is None else out.when(when, F.lit(rule.label))
    return F.lit(otherwise) if out is None else out.otherwise(F.lit(otherwise))


def fit_quality_rules(statistics: DataFrame, labels: DataFrame, max_rows: int = TRAINING_ROWS) -> list[Rule]:
    """A decision list for low quality (0), from statistics of labelled rows.

    At most ``max_rows`` labelled rows reach the driver: those that come first
    by xxhash64 of doc_id. Rows without quality or doc_id teach nothing; a
    doc_id labelled twice counts twice. Of documents that share a labelled doc_id
    the one with the smallest statistics teaches, so no more than ``max_rows`` rows are
    ever joined to labels.
    """
    labels = take(labels, "doc_id", "quality").filter("quality in (0, 1) and doc_id is not null")
    chosen = labels.orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(max_rows)
    wanted = ratios()
    named = chosen.select(F.col("doc_id").alias("labelled")).distinct()
    known = statistics.join(named, F.col("doc_id") == F.col("labelled"), "left_semi")
    features = F.struct(*[c.alias(k) for k, c in wanted.items()])
    known = known.groupBy(F.col("doc_id").alias("known")).agg(F.min(features).alias("features"))
    rows = (
        chosen.join(known, F.col("doc_id") == F.col("known"))
        .select(F.xxhash64("doc_id").alias("place"), "doc_id", "quality", *[F.col(f"features.{k}").alias(k) for k in wanted])
        .toPandas()
        .sort_values(["place", "doc_id", *wanted], kind="stable")
    )
    return learn_decision_list({k: rows[k].to_numpy(float) for k in wanted}, rows["quality"].to_numpy(int))


def judge_quality(docs: DataFrame, labels: DataFrame, max_rows: int = TRAINING_ROWS) -> DataFrame:
    """Statistics, base_failed and kept of every row of ``docs``.

    base_failed: fewer than 10 words, or over 20 % of the words in repeated
    windows of five. Rows that pass it are kept unless a learned rule holds.
    Null and empty texts have zeros, so they fail. Without labels no rule is
    learned, and what passes the base is kept. Repeated rows are judged each.
    """
    statistics = materialize(text_statistics(docs), "text-statistics")
    rules = fit_quality_rules(statistics, labels, max_rows)
    failed = (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)
    verdict = decision_column(rules, 1, ratios()) == 1
    return statistics.select("*", failed.alias("base_failed"), (~failed & verdict).alias("kept"))
