"""Language identification with hyperdimensional profiles."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from tablewright.llm.common import mix, slices, take

#: Length of all vectors, and letters bound into one n-gram.
DIMENSIONS = 1024
LETTERS = 3
BLANK = 32
#: Distinct n-grams that are bound at a time, and bytes of text that are read at a time.
BLOCK = 2048
READ_BYTES = 1 << 19
UNDETERMINED = "und"
#: A text is in a language if it agrees with it half as well as 99 % of the labelled texts of its length do.
LOWEST = 0.01
SHARE = 0.5
#: Labelled texts of a length that tell its level, and n-grams that a text needs not to scatter.
ENOUGH = 100
SCATTER = 64
#: Agreement is counted in such steps.
STEPS = 8192


def _fold() -> np.ndarray:
    """Of each code point: itself in lower case if it is a letter, a blank if not."""
    # beyond the first plane the rare alphabets keep their case
    out = np.full(0x10000, BLANK, dtype=np.int32)
    for p in range(0x10000):
        c = chr(p)
        if c.isalpha():
            low = c.lower()
            out[p] = ord(low) if len(low) == 1 else p
    return out


_TABLES: dict[str, np.ndarray] = {}


def letter_runs(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Letters of all texts, runs of others as one blank, and where each text begins.

    Each text stands between blanks, so that no n-gram crosses texts.
    """
    if "fold" not in _TABLES:
        _TABLES["fold"] = _fold()
    joined = np.frombuffer(
        "\n".join(["", *[t or "" for t in texts], ""]).encode("utf-32-le", "surrogatepass"), dtype=np.uint32
    )
    lengths = np.array([len(t or "") + 1 for t in texts], dtype=np.int64)
    begin = np.concatenate([[0], np.cumsum(lengths)])
    letters = _TABLES["fold"][np.minimum(joined, 0xFFFF)].astype(np.int64)
    if (high := np.flatnonzero(joined >= 0x10000)).size:
        letters[high] = [p if chr(p).isalpha() else BLANK for p in joined[high]]
    blank = letters == BLANK
    keep = np.ones(len(letters), dtype=bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    keep[begin] = True
    place = np.cumsum(keep) - 1
    return letters[keep], place[begin]


def trigrams(letters: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct trigrams around a letter, which of them stand in the text, and around which place."""
    none = np.zeros(0, np.int64)
    at = np.flatnonzero(letters[1:-1] != BLANK) + 1 if len(letters) > 2 else none
    if len(at) == 0:
        return np.zeros((0, LETTERS), np.int64), none, none
    points = np.flatnonzero(np.bincount(letters)) if letters.max() < 0x10000 else np.unique(letters)
    k = len(points)
    small = np.searchsorted(points, letters)
    codes = (small[at - 1] * k + small[at]) * k + small[at + 1]
    if k <= 160:  # few letters: a table is quicker than sorting
        seen = np.bincount(codes, minlength=1) > 0
        distinct = np.flatnonzero(seen)
        which = (np.cumsum(seen) - 1)[codes]
    else:
        distinct, which = np.unique(codes, return_inverse=True)
    return points[np.stack([distinct // (k * k), distinct // k % k, distinct % k], axis=1)], which, at


def letter_vectors(points: np.ndarray, dimensions: int = DIMENSIONS) -> np.ndarray:
    """Random vectors of -1 and 1, one for each code point, the same everywhere."""
    words = -(-dimensions // 64)
    seed = mix(points.astype(np.uint64) + np.uint64(0x51ED27))
    lanes = mix(seed[:, None] * np.uint64(0x9E3779B97F4A7C15) + np.arange(1, words + 1, dtype=np.uint64))
    bits = np.unpackbits(lanes.view(np.uint8).reshape(len(points), -1), axis=1)[:, :dimensions]
    return bits.astype(np.int8) * 2 - 1


def ngram_vectors(grams: np.ndarray, dimensions: int = DIMENSIONS) -> np.ndarray:
    """Bind the letters of each n-gram: the product of their vectors, rotated by their place."""
    out = np.ones((len(grams), dimensions), dtype=np.int8)
    for k in range(grams.shape[1]):
        points, at = np.unique(grams[:, k], return_inverse=True)
        out *= np.roll(letter_vectors(points, dimensions), grams.shape[1] - 1 - k, axis=1)[at]
    return out


def bundle(texts: list[str | None], dimensions: int = DIMENSIONS) -> np.ndarray:
    """One vector for each text: the sum of the vectors of its n-grams. Zero without letters."""
    return counted_bundle(texts, dimensions)[0]


def counted_bundle(texts: list[str | None], dimensions: int = DIMENSIONS) -> tuple[np.ndarray, np.ndarray]:
    """``bundle``, and how many n-grams each text has."""
    letters, begin = letter_runs(texts)
    grams, which, at = trigrams(letters)
    out = np.zeros((len(texts), dimensions), dtype=np.float32)
    if len(at) == 0:
        return out, np.zeros(len(texts), dtype=np.int64)
    doc = np.searchsorted(begin, at, side="right") - 1
    for low in range(0, len(grams), BLOCK):  # bounds the memory
        high = min(low + BLOCK, len(grams))
        here = slice(None) if high - low == len(grams) else (which >= low) & (which < high)
        counts = np.bincount(
            doc[here] * (high - low) + which[here] - low, minlength=len(texts) * (high - low)
        ).reshape(len(texts), high - low)
        vectors = ngram_vectors(grams[low:high], dimensions)
        out += counts.astype(np.float32) @ vectors.astype(np.float32)
    return out, np.bincount(doc, minlength=len(texts))


def _texts(batch_column: pa.Array) -> Iterator[list[str | None]]:
    for at, to, _, _ in slices(batch_column, READ_BYTES, rows=256):
        yield batch_column.slice(at, to - at).to_pylist()


def learn_profiles(labelled: DataFrame, dimensions: int = DIMENSIONS) -> dict[str, np.ndarray]:
    """``learn_whole_profiles`` without what all of them share."""
    return set_apart(learn_whole_profiles(labelled, dimensions))


def set_apart(profiles: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """``profiles`` less what all of them share, so that only differences between languages count."""
    if len(profiles) > 1:
        shared = sum(profiles.values()) / len(profiles)
        profiles = {k: v - shared for k, v in profiles.items()}
        profiles = {k: v / max(np.linalg.norm(v), 1e-12) for k, v in profiles.items()}
    return profiles


def learn_whole_profiles(labelled: DataFrame, dimensions: int = DIMENSIONS) -> dict[str, np.ndarray]:
    """One unit vector for each language of ``labelled`` (text, lang): all its n-grams bundled.

    Every document weighs the same. Tasks bundle what they read, so one vector
    for each task and language is all that is shuffled, and one for each
    language reaches the driver. Null langs and texts without letters teach
    nothing.
    """

    def sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            done = 0
            for texts in _texts(batch.column("text")):
                vectors = bundle(texts, dimensions)
                norms = np.linalg.norm(vectors, axis=1, keepdims=True)
                vectors = np.divide(vectors, norms, out=np.zeros_like(vectors), where=norms > 0)
                here = np.array(langs[done : done + len(texts)], dtype=object)
                for lang in {x for x in here if x is not None}:
                    total[lang] = total.get(lang, 0) + vectors[here == lang].sum(axis=0, dtype=np.float64)
                done += len(texts)
        for lang, vector in total.items():
            # whole numbers add up the same in any order
            vector = np.round(vector * 2**30).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * dimensions),
                    pa.array(np.arange(dimensions, dtype=np.int32)),
                    pa.array(vector),
                ],
                ["lang", "place", "value"],
            )

    rows = take(labelled, "text", "lang").filter("lang is not null and text is not null")
    sums_of = rows.mapInArrow(sums, "lang string, place int, value long")
    # dimensions times languages
    found = sums_of.groupBy("lang", "place").agg(F.sum("value").alias("value")).collect()
    profiles: dict[str, np.ndarray] = {}
    for lang, place, value in found:
        profiles.setdefault(lang, np.zeros(dimensions))[place] = value
    return {k: v / np.linalg.norm(v) for k, v in sorted(profiles.items()) if np.any(v)}


def predict_language(text: Column, profiles: dict[str, np.ndarray], dimensions: int = DIMENSIONS) -> Column:
    """struct<lang, score> of a text: the profile with the largest cosine, and that cosine from 0 to 1.

    ``und`` and 0 for null and for texts without a letter, or if nothing was
    learned. Of equal cosines the first language in order of name wins.
    """
    names = list(profiles)
    matrix = np.stack([profiles[n] for n in names]).astype(np.float32) if names else None

    @arrow_udf("struct<lang: string, score: double>")
    def predict(column: pa.Array) -> pa.Array:
        langs: list[str] = []
        scores: list[float] = []
        for texts in _texts(column):
            vectors = bundle(texts, dimensions)
            norms = np.linalg.norm(vectors, axis=1)
            if matrix is None:
                cosines = np.zeros((len(texts), 1), np.float32)
                norms[:] = 0
            else:
                cosines = (vectors @ matrix.T) / np.maximum(norms, 1e-12)[:, None]
            best = cosines.argmax(axis=1)
            top = np.clip(cosines[np.arange(len(texts)), best], 0, 1)
            for i in range(len(texts)):
                langs.append(names[best[i]] if norms[i] > 0 else UNDETERMINED)
                scores.append(float(top[i]) if norms[i] > 0 else 0.0)
        return pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["lang", "score"])

    return predict(text)


class Agreement:
    """How well texts agree with the language they look most like."""

    def __init__(self, whole: dict[str, np.ndarray]) -> None:
        self.names = list(whole)
        self.dimensions = len(whole[self.names[0]]) if whole else DIMENSIONS
        self.whole = np.array([whole[n] for n in self.names], dtype=np.float32).reshape(-1, self.dimensions)
        self.apart = np.array(list(set_apart(whole).values()), dtype=np.float32).reshape(-1, self.dimensions)

    def of(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Language, class of length (number of n-grams, by powers of two) and agreement of each text, with it and with all.

        ``und`` as in ``predict_language``. Agreement is the mean product of an
        n-gram of the text with the whole profile: how frequent its n-grams
        are in the language. It is about 0 for n-grams that the language
        doesn't have, and can fail, as nothing is taken off the profile.
        """
        vectors, sizes = counted_bundle(texts, self.dimensions)
        known = (sizes > 0) & bool(self.names)
        if not known.any():
            none = np.zeros((len(texts), len(self.names)))
            return [UNDETERMINED] * len(texts), np.zeros(len(texts), np.int64), np.zeros(len(texts)), none
        best = (vectors @ self.apart.T).argmax(axis=1)
        agreement = (vectors @ self.whole.T) / (np.maximum(sizes, 1) * np.sqrt(self.dimensions))[:, None]
        steps = np.floor(np.clip(agreement, 0, 1) * STEPS) / STEPS * known[:, None]
        length = np.log2(np.maximum(sizes, 1)).astype(np.int64)
        names = [self.names[b] if k else UNDETERMINED for b, k in zip(best, known)]
        return names, length, steps[np.arange(len(texts)), best], steps


def learn_levels(labelled: DataFrame, whole: dict[str, np.ndarray]) -> dict[str, dict[int | None, float]]:
    """For each language and class of length (null for all), the agreement that a text must reach.

    Learned from all labelled texts that are found in their own language; one
    number for each language and length reaches the driver.
    """
    measure = Agreement(whole)

    def agree(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, done = batch.column("lang").to_pylist(), 0
            for texts in _texts(batch.column("text")):
                names, lengths, steps, _ = measure.of(texts)
                own = np.array([n == x for n, x in zip(names, langs[done:])], dtype=bool)
                done += len(texts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([n for n, x in zip(names, own) if x], pa.string()),
                        pa.array(lengths[own], pa.int32()),
                        pa.array(steps[own], pa.float64()),
                    ],
                    ["lang", "length", "agreement"],
                )

    rows = take(labelled, "text", "lang").filter("lang is not null and text is not null")
    # a filter on what a function found would have it called twice
    found = rows.mapInArrow(agree, "lang string, length int, agreement double")
    level = F.percentile(F.col("agreement"), F.lit(LOWEST)) * SHARE
    learned = found.rollup("lang", "length").agg(level.alias("level"), F.count("*").alias("n")).collect()
    levels: dict[str, dict[int | None, float]] = {r.lang: {None: r.level} for r in learned if r.lang is not None}
    for r in learned:
        if r.length is not None:
            least = _of_few(levels[r.lang][None], r.length)
            levels[r.lang][r.length] = r.level if r.n >= ENOUGH else min(r.level, least)
    return levels


def _of_few(level: float, length: int) -> float:
    """The level of a length that few labelled texts have: that of all, less if the text is short."""
    return level * min(1.0, (2**length / SCATTER) ** 0.5)


def in_a_language(text: Column, whole: dict[str, np.ndarray], levels: dict[str, dict[int | None, float]]) -> Column:
    """Whether a text agrees with one of the languages; false for null and for texts without a letter."""
    measure = Agreement(whole)

    def reached(name: str, length: int, agreement: float) -> bool:
        known = levels.get(name)
        if not known:
            return False
        return agreement > 0 and agreement >= known.get(length, _of_few(known[None], length))

    @arrow_udf("boolean")
    def within(column: pa.Array) -> pa.Array:
        out: list[bool] = []
        for texts in _texts(column):
            _, lengths, _, steps = measure.of(texts)
            # a short text may look most like another language than its own
            out += [any(reached(n, k, x) for n, x in zip(measure.names, row)) for k, row in zip(lengths.tolist(), steps.tolist())]
        return pa.array(out, pa.bool_())

    return within(text)


def identify_languages(docs: DataFrame, held_out: Column) -> DataFrame:
    """doc_id, held_out, lang_pred and score of all rows of ``docs``.

    Learns from the rows that aren't held out and have a lang; predicts every
    row from its text alone. Null and empty texts are ``und`` with score 0, as
    is all if no row teaches. Repeated rows are predicted each.
    """
    rows = take(docs, "doc_id", "text", "lang").withColumn("held_out", held_out)
    profiles = learn_profiles(rows.filter(~F.col("held_out")))
    found = rows.select("doc_id", "held_out", predict_language(F.col("text"), profiles).alias("found"))
    return found.select(
        "doc_id", "held_out", F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score")
    )
