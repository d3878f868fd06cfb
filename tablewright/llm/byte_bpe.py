"""Byte-level BPE: exact encoding by longest matches and backtracking, and decoding."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator
from itertools import chain, islice

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute
import regex
from pyspark.sql import DataFrame

from tablewright.llm.common import slices, take

#: Distinct pieces whose ids a task remembers, and pairs of neighbours.
REMEMBERED = 200_000
#: Longer texts are split into pieces as they are read, not at once.
LONG_TEXT = 1 << 20


def read_ranks(path: str) -> list[bytes]:
    """Tokens in order of rank, from a file of lines ``base64 rank``; ranks are 0, 1, 2, ..."""
    with open(path, "rb") as lines:
        ranked = sorted((int(r), base64.b64decode(t)) for t, r in map(bytes.split, filter(bytes.strip, lines)))
    if [r for r, _ in ranked] != list(range(len(ranked))):
        raise ValueError("ranks must run from 0 without gaps")
    return [t for _, t in ranked]


class Vocabulary:
    """Tokens, and how each was last merged.

    ``halves[t]`` are the two tokens whose merge makes t; a single byte is its
    own half. A token that merging its bytes doesn't give can only stand for a
    whole piece; it has no halves.
    """

    def __init__(self, tokens: list[bytes]) -> None:
        self.tokens = tokens
        self.rank = {t: i for i, t in enumerate(tokens)}
        if missing := [b for b in range(256) if bytes([b]) not in self.rank]:
            raise ValueError(f"bytes without a token: {missing[:5]}")
        self.halves: list[tuple[int, int] | None] = [self._last_merge(i) for i in range(len(tokens))]
        self.merged = {h: i for i, h in enumerate(self.halves) if h and len(tokens[i]) > 1}

    def _last_merge(self, i: int) -> tuple[int, int] | None:
        parts = [bytes([b]) for b in self.tokens[i]]
        if len(parts) == 1:
            return i, i
        rank = self.rank
        while len(parts) > 2:
            found = min(
                ((rank.get(a + b, i), k) for k, (a, b) in enumerate(zip(parts, parts[1:]))),
                default=(i, 0),
            )
            if found[0] >= i:
                return None
            k = found[1]
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        return rank[parts[0]], rank[parts[1]]


class _Pieces(dict):
    """Ids of pieces met before; others are encoded when they are asked for."""

    def __init__(self, encode) -> None:
        super().__init__()
        self.encode = encode

    def __missing__(self, text: str) -> tuple[int, ...]:
        ids = self.encode(text.encode("utf-8", "surrogatepass"))
        if len(self) >= REMEMBERED:
            self.clear()
        self[text] = ids
        return ids


class Encoder:
    """Ids of pieces of text, one instance in each Python worker."""

    def __init__(self, vocabulary: Vocabulary, pattern: str) -> None:
        self.v = vocabulary
        self.pattern = regex.compile(pattern)
        self.length = [len(t) for t in vocabulary.tokens]
        # byte b is character b of Latin-1, so byte strings are strings of the automaton
        self.automaton = ahocorasick.Automaton()
        for i, token in enumerate(vocabulary.tokens):
            if vocabulary.halves[i]:
                self.automaton.add_word(token.decode("latin-1"), (i, len(token)))
        self.automaton.make_automaton()
        self.shorter = [self._prefix(t) for t in vocabulary.tokens]
        self.fits: dict[tuple[int, int], bool] = {}
        self.pieces = _Pieces(self.encode_bytes)

    def _prefix(self, token: bytes) -> int:
        """The longest other token that ``token`` begins with, or -1."""
        for n in range(len(token) - 1, 0, -1):
            i = self.v.rank.get(token[:n], -1)
            if i >= 0 and self.v.halves[i]:
                return i
        return -1

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging would ever leave these two side by side.

        It would unless some merge across the border comes before the merges
        that close the border off. Undo the merges of both tokens from the
        last one backwards: at each step the two tokens at the border were
        neighbours until the later of the two merges made one of them larger,
        so a merge of the two that ranks below that one would have come first.
        """
        if (known := self.fits.get((left, right))) is not None:
            return known
        a, b, bound = left, right, len(self.v.tokens)
        merged, halves, answer = self.v.merged, self.v.halves, True
        while True:
            if merged.get((a, b), bound) < bound:
                answer = False
                break
            inner_a, inner_b = halves[a][1], halves[b][0]
            if inner_a == a and inner_b == b:
                break
            # undo the later merge; of equal ones the left came first
            if inner_b == b or (inner_a != a and a > b):
                bound, a = a, inner_a
            else:
                bound, b = b + 1, inner_b
        if len(self.fits) >= REMEMBERED:
            self.fits.clear()
        self.fits[left, right] = answer
        return answer

    def encode_bytes(self, data: bytes) -> tuple[int, ...]:
        whole = self.v.rank.get(data)
        if whole is not None:
            return (whole,)
        longest = [0] * len(data)
        for end, (token, n) in self.automaton.iter(data.decode("latin-1")):
            longest[end - n + 1] = token  # ends rise, so the longest comes last
        length, shorter, compatible = self.length, self.shorter, self.compatible
        dead = set()  # ends from which the rest was found impossible
        out: list[int] = []
        at, token, size = 0, longest[0], len(data)
        while True:
            end = at + length[token]
            if end not in dead and (not out or compatible(out[-1], token)):
                out.append(token)
                if end == size:
                    return tuple(out)
                at, token = end, longest[end]
                continue
            token = shorter[token]
            while token < 0:  # nothing fits here: take back the token before
                dead.add(at)
                token = out.pop()
                at -= length[token]
                token = shorter[token]

    def encode(self, text: str) -> list[int]:
        if len(text) <= LONG_TEXT:
            return self._flat(self.pattern.findall(text))
        out, found = [], (m.group() for m in self.pattern.finditer(text))
        while block := list(islice(found, 100_000)):
            out += self._flat(block)
        return out

    def _flat(self, pieces: list[str]) -> list[int]:
        return list(chain.from_iterable(map(self.pieces.__getitem__, pieces)))


_ENCODERS: dict[tuple[str, int], Encoder] = {}


def _encoder(vocabulary: Vocabulary, pattern: str) -> Encoder:
    """The encoder of this Python worker, kept from one task to the next."""
    key = pattern, hash(tuple(vocabulary.tokens[-50:])) ^ len(vocabulary.tokens)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(vocabulary, pattern)
    return _ENCODERS[key]


def _encoded(encoder: Encoder, batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, pa.ListArray]]:
    """Runs of rows, and the ids of their texts."""
    for at, to, _, _ in slices(batch.column("text")):
        part = batch.slice(at, to - at)
        flat, ends = [], [0]
        for text in part.column("text").to_pylist():
            ids = encoder.encode(text) if text else []
            flat.append(np.array(ids, dtype=np.int32))
            ends.append(ends[-1] + len(ids))
        yield part, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(flat)))


def encode_documents(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and ids (array of int) of every row.

    ``path`` is a file of ranks, read on the driver and broadcast (its size is
    that of the vocabulary); ``pattern`` splits texts into pieces, which are
    encoded one by one as merging their bytes by rank would. No special tokens.
    Null and empty texts have no ids. Rows that repeat are encoded each; null
    doc_ids are passed on. No rows give no rows.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(Vocabulary(read_ranks(path)))

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared.value, pattern)
        for batch in batches:
            for part, ids in _encoded(encoder, batch):
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), ids], ["doc_id", "ids"])

    rows = take(docs, "doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(encode, f"doc_id {kind}, ids array<int>")


def decode_column(tokens: pa.BinaryArray, ids: pa.ListArray) -> pa.BinaryArray:
    """The bytes of each list of ids. A null list gives null, an empty one no bytes."""
    offsets = ids.offsets.to_numpy().astype(np.int64)
    values = ids.values.slice(offsets[0], offsets[-1] - offsets[0])  # the list may be part of a longer one
    offsets = offsets - offsets[0]
    _, ends, data = tokens.take(values).cast(pa.large_binary()).buffers()
    ends = np.frombuffer(ends, np.int64) if ends is not None else np.zeros(1, np.int64)
    where = pa.py_buffer(np.ascontiguousarray(ends[offsets]))
    mask = ids.is_valid().to_numpy(zero_copy_only=False) if ids.null_count else None
    out = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ids), [None, where, data])
    return out if mask is None else pa.compute.if_else(pa.array(mask), out, None)


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id, ids and data (binary) of every row of ``encode_documents``."""
    shared = encoded.sparkSession.sparkContext.broadcast(read_ranks(path))

    def decode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = pa.array(shared.value, pa.binary())
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                ids = part.column("ids")
                data = decode_column(tokens, ids)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), ids, data.cast(pa.binary())], ["doc_id", "ids", "data"]
                )

    rows = take(encoded, "doc_id", "ids")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(decode, f"doc_id {kind}, ids array<int>, data binary")


def digest_documents(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of the decimal ids, joined by commas) and decoded_sha256 of every row.

    Encodes as ``encode_documents`` does and decodes what came out, in one pass, so that
    neither ids nor texts leave the task. Null and empty texts have the digests of nothing.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary(read_ranks(path)))

    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared.value, pattern)
        tokens = pa.array(shared.value.tokens, pa.binary())
        for batch in batches:
            for part, ids in _encoded(encoder, batch):
                data = decode_column(tokens, ids)
                joined = pa.compute.binary_join(
                    pa.ListArray.from_arrays(ids.offsets, ids.values.cast(pa.string())), ","
                )
                columns = [part.column("doc_id"), pa.compute.list_value_length(ids).cast(pa.int64())]
                columns += [pa.array([_sha256(x) for x in column]) for column in (joined, data)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = take(docs, "doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(digest, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _sha256(value: pa.Scalar) -> str:
    return hashlib.sha256(value.as_buffer() or b"").hexdigest()
