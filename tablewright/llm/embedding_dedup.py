"""Near-duplicate vectors with an inverted multi-index."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import materialize, take
from tablewright.llm.components import components

#: Vectors the codebooks are fitted on, at most; taken in the order of a hash.
FIT_ROWS = 20_000
#: Vectors in a cell of the product grid, about, as long as MOST_WORDS allows.
PER_CELL = 128
MOST_WORDS = 1024
#: Share of links at exactly the least cosine that the traversal is made to find.
TARGET_RECALL = 0.98
#: Vectors of a cell, and visitors to it, that meet in one task.
CHUNK = 256


def fit_codebook(vectors: np.ndarray, words: int, rounds: int = 12, seed: int = 7) -> np.ndarray:
    """k-means centres of the rows of ``vectors``."""
    rng = np.random.default_rng(seed)
    centres = vectors[rng.permutation(len(vectors))[:words]].copy()
    for _ in range(rounds):
        nearest = _distances(vectors, centres).argmin(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, vectors)
        counts = np.bincount(nearest, minlength=len(centres))
        centres[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return centres


def _distances(vectors: np.ndarray, centres: np.ndarray) -> np.ndarray:
    d = (vectors**2).sum(axis=1)[:, None] - 2 * vectors @ centres.T + (centres**2).sum(axis=1)[None]
    return np.maximum(d, 0)


def multi_sequence(first: np.ndarray, second: np.ndarray, depth: int) -> list[tuple[int, int]]:
    """The ``depth`` cells of a grid with the smallest sums of row and column distance, nearest first."""
    rows, columns = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    a, b = first[rows].tolist(), second[columns].tolist()
    out: list[tuple[int, int]] = []
    heap, seen = [(a[0] + b[0], 0, 0)], {(0, 0)}
    while heap and len(out) < depth:
        _, i, j = heapq.heappop(heap)
        out.append((int(rows[i]), int(columns[j])))
        for x, y in ((i + 1, j), (i, j + 1)):
            if x < len(a) and y < len(b) and (x, y) not in seen:
                seen.add((x, y))
                heapq.heappush(heap, (a[x] + b[y], x, y))
    return out


class MultiIndex:
    """Two codebooks, one for each half of a vector, and how many cells a vector visits.

    The depth is measured, not guessed: sample vectors get a partner in a
    random direction at exactly the least cosine, and the depth is the one at
    which ``recall`` of these pairs meet, as the one visits the other's cell.
    Closer pairs meet earlier.
    """

    def __init__(self, sample: np.ndarray, words: int, cosine: float, recall: float, seed: int = 11) -> None:
        self.half = sample.shape[1] // 2
        self.books = [fit_codebook(part, words) for part in self._halves(sample)]
        words = len(self.books[0])
        rng = np.random.default_rng(seed)
        some = sample[:2000]
        noise = rng.normal(size=some.shape)
        noise -= (noise * some).sum(axis=1, keepdims=True) * some
        noise /= np.maximum(np.linalg.norm(noise, axis=1, keepdims=True), 1e-12)
        partner = cosine * some + math.sqrt(max(0.0, 1 - cosine**2)) * noise
        one, two = self.distances(some), self.distances(partner)
        ranks = np.minimum(self._rank(one, two), self._rank(two, one))
        self.depth = min(words * words, int(np.ceil(np.quantile(ranks, recall)))) if len(ranks) else 1

    def _halves(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return vectors[:, : self.half], vectors[:, self.half :]

    def distances(self, vectors: np.ndarray) -> list[np.ndarray]:
        return [_distances(part, book) for part, book in zip(self._halves(vectors), self.books)]

    def _rank(self, of: list[np.ndarray], cell: list[np.ndarray]) -> np.ndarray:
        """When vectors with distances ``of`` visit the home cells of those with distances ``cell``."""
        homes = [d.argmin(axis=1) for d in cell]
        out = np.zeros(len(of[0]), dtype=np.int64)
        for i in range(len(out)):
            total = of[0][i][:, None] + of[1][i][None, :]
            out[i] = (total < total[homes[0][i], homes[1][i]]).sum() + 1
        return out

    def visits(self, vectors: np.ndarray) -> list[list[int]]:
        """Cells each vector visits; the first is its home."""
        words = len(self.books[1])
        first, second = self.distances(vectors)
        return [[i * words + j for i, j in multi_sequence(a, b, self.depth)] for a, b in zip(first, second)]


def unit_vectors(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a column of lists, in double precision, scaled to length one."""
    v = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), width)
    v = v / np.abs(v).max(axis=1, keepdims=True)  # so that no square overflows or vanishes
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _split(vectors: DataFrame, id_column: str, vector_column: str) -> tuple[DataFrame, DataFrame]:
    """id and v of the vectors that can link, and id of the others."""
    v = take(vectors, id_column, vector_column).toDF("id", "v")
    if v.schema["v"].dataType.simpleString() != "array<float>":
        v = v.withColumn("v", F.col("v").cast("array<double>"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.coalesce(finite & F.exists("v", lambda x: x != 0), F.lit(False))
    return v.filter(usable), v.filter(~usable).select("id")


def near_duplicates(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    cosine: float = 0.9,
    recall: float = TARGET_RECALL,
    fit_rows: int = FIT_ROWS,
) -> DataFrame:
    """Links between vectors with a cosine of at least ``cosine``, counted, and their components.

    Equal vectors are one class from the start. A bounded sample fits the
    codebooks; every class is indexed in its home cell, the nearest of the
    product grid, and visits the nearest cells in multi-sequence order, which
    is as deep as ``recall`` asks for. Whom it meets there is verified by
    cosine in double precision. A pair that meets twice counts once: the
    smaller id's visit counts. Large cells are dealt to tasks in chunks of
    members and of visitors, so that every pair still meets.

    Returns vec_id, n_links (other rows linked directly), component_id
    (smallest vec_id reachable) and kept (vec_id = component_id). Vectors that
    are null, empty, zero, or hold a component that is null or not finite link with
    nothing. Vectors of another length than another link only among their like.
    Rows that repeat a vec_id and vector are rows of their own. A null vec_id is
    counted as a link but never names a component; its kept is false if it is alone. No rows give no rows.
    """
    usable, others = _split(vectors, id_column, vector_column)
    kind = usable.schema["id"].dataType.simpleString()
    keyed = materialize(
        usable.select("id", "v", F.xxhash64("v").alias("k1"), F.xxhash64(F.lit("second"), "v").alias("k2")),
        "vectors",
    )
    # the vector of a class is that of any of its rows: they are equal
    classes = materialize(
        keyed.groupBy("k1", "k2").agg(
            F.min("id").alias("first_id"), F.count("*").alias("rows"), F.first("v").alias("v")
        ).withColumn("node", F.xxhash64("k1", "k2")),
        "vector-classes",
    )
    parts = [
        _links_of_width(classes.filter(F.size("v") == width), n, width, cosine, recall, fit_rows)
        for width, n in classes.groupBy(F.size("v").alias("width")).count().orderBy("width").collect()
    ]
    everything = take(vectors, id_column).toDF("id")
    if not parts:
        return everything.select(
            F.col("id").alias("vec_id"), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"),
            F.lit(True).alias("kept"),
        )
    met = parts[0]
    for p in parts[1:]:
        met = met.unionByName(p)
    met = materialize(met, "links")
    counted = met.groupBy("node").agg(F.sum("links").alias("links"))
    joined = components(met.select(F.col("node").alias("a"), F.col("root").alias("b")))
    named = (
        classes.select("node", "k1", "k2", "first_id", "rows")
        .join(counted, "node", "left")
        .join(joined, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
    )
    named = materialize(named, "named-classes")
    smallest = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = named.join(smallest, "component").select(
        F.col("k1").alias("c1"), F.col("k2").alias("c2"), "component_id",
        (F.coalesce("links", F.lit(0)) + F.col("rows") - 1).alias("n_links"),
    )
    linked = keyed.join(named, (F.col("k1") == F.col("c1")) & (F.col("k2") == F.col("c2"))).select(
        "id", "n_links", "component_id"
    )
    rest = others.select(
        "id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id")
    )
    return linked.unionByName(rest).select(
        F.col("id").cast(kind).alias("vec_id"),
        F.col("n_links").cast("long").alias("n_links"),
        "component_id",
        F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"),
    )


def _links_of_width(classes: DataFrame, n: int, width: int, cosine: float, recall: float, fit_rows: int) -> DataFrame:
    """node, links (rows it links with, copies counted) and root (a node it is connected with)."""
    sample = classes.orderBy("node").limit(fit_rows).select("v").toArrow()  # nodes are hashes
    sample = unit_vectors(sample.column("v").combine_chunks(), width)
    words = max(1, min(MOST_WORDS, math.ceil(math.sqrt(n / PER_CELL)), len(sample)))
    index = classes.sparkSession.sparkContext.broadcast(MultiIndex(sample, words, cosine, recall))

    def visit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                cells = index.value.visits(unit_vectors(part.column("v"), width))
                cells = pa.array(cells, pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [part.column("node"), part.column("rows"), part.column("v"), cells], ["node", "rows", "v", "cells"]
                )

    kind = classes.schema["v"].dataType.simpleString()
    schema = f"node long, rows long, v {kind}, cells array<int>"
    visits = materialize(classes.select("node", "rows", "v").mapInArrow(visit, schema), "visits")
    cell_of = visits.select(F.posexplode("cells").alias("place", "cell"))
    sizes = cell_of.groupBy("cell").agg(
        F.count("*").alias("visitors"), F.sum((F.col("place") == 0).cast("int")).alias("members")
    )
    sizes = sizes.filter("members > 0").select(
        "cell",
        F.ceil(F.col("visitors") / CHUNK).cast("int").alias("v_parts"),
        F.ceil(F.col("members") / CHUNK).cast("int").alias("m_parts"),
    )
    spread = visits.select("node", "rows", "v", "cells", F.posexplode("cells").alias("place", "cell"))
    spread = spread.join(sizes, "cell")
    upto = lambda c: F.sequence(F.lit(0), F.col(c) - 1)
    own = lambda c: F.pmod(F.xxhash64("node"), F.col(c)).cast("int")
    columns = ["cell", "node", "rows", "v", "cells"]
    visitors = spread.select(
        *columns, F.lit(False).alias("member"), own("v_parts").alias("v_part"), F.explode(upto("m_parts")).alias("m_part")
    )
    members = spread.filter("place = 0").select(
        *columns, F.lit(True).alias("member"), own("m_parts").alias("m_part"), F.explode(upto("v_parts")).alias("v_part")
    )

    def verify(table: pa.Table) -> pa.Table:
        member = table.column("member").to_numpy()
        node, rows = table.column("node").to_numpy(), table.column("rows").to_numpy()
        v = unit_vectors(table.column("v").combine_chunks(), width)
        # every row visits as many cells; the first is its home
        cells = table.column("cells").combine_chunks().flatten().to_numpy().reshape(len(node), -1)
        m, s = np.flatnonzero(member), np.flatnonzero(~member)
        links = np.zeros(len(node), dtype=np.int64)
        root = np.arange(len(node))
        if len(m) and len(s):
            hit = v[s] @ v[m].T >= cosine
            # a pair that also meets in the visitor's home counts there or here, not twice
            i, j = np.nonzero(hit)
            both = (cells[m[j]] == cells[s[i], 0][:, None]).any(axis=1)
            hit[i, j] = (node[s[i]] < node[m[j]]) | ~both
            links[s] += hit @ rows[m]
            links[m] += hit.T @ rows[s]
            # connect what meets here: labels sink to the smallest node until they rest
            label = node.copy()
            while True:
                low = np.where(hit, label[m][None, :], np.iinfo(np.int64).max).min(axis=1)
                new = np.minimum(label[s], low)
                back = np.where(hit, new[:, None], np.iinfo(np.int64).max).min(axis=0)
                after = np.minimum(label[m], back)
                if (new == label[s]).all() and (after == label[m]).all():
                    break
                label[s], label[m] = new, after
            root = label
        keep = links > 0
        return pa.table({"node": node[keep], "links": links[keep], "root": root[keep] if keep.any() else node[keep]})

    return (
        visitors.unionByName(members)
        .groupBy("cell", "v_part", "m_part")
        .applyInArrow(verify, "node long, links long, root long")
    )
