"""Nearest neighbours by a few stable projections, kd-trees and a chi-square test.

Gaussian projections are 2-stable: of two vectors at distance d, the squared
distance of their projections to ``m`` dimensions is d^2 times a chi-square
variable of m degrees. A search walks the projected points away from the
query's projection and verifies each by its real distance. It may stop at the
projected distance r once chi-square's distribution at r^2 / d^2, d being the
distance of the k-th nearest found, reaches ``sure``: a nearer vector would
then lie within r with that probability.

Cells come from the upper levels of a kd-tree over the projections of a bounded
sample; every row is in a cell, and a large cell is dealt by hash to slices, so
an index block holds about ``block_rows`` rows whatever the data (a third of
all rows may be one vector). A block keeps its own kd-tree. A query first
searches its own block; the distance found there bounds its search, and the
query goes on to the blocks of the cells that the test does not rule out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import exp

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from . import exchange as ex
from .common import materialise

PROJECTIONS = 8
SAMPLE = 8192  # rows that the cells are fitted on, in expectation
BLOCK_ROWS = 4096
LEAF_ROWS = 32
QUERIES = 512  # searched together
SURE = 0.95


def chi_square(x: float, m: int) -> float:
    """The chi-square distribution of ``m`` degrees, an even number."""
    term = total = 1.0
    for i in range(1, m // 2):
        term *= x / 2 / i
        total += term
    return 1 - exp(-x / 2) * total


def chi_square_quantile(p: float, m: int) -> float:
    low, high = 0.0, 1.0
    while chi_square(high, m) < p:
        high *= 2
    for _ in range(100):
        low, high = (low, (low + high) / 2) if chi_square((low + high) / 2, m) >= p else ((low + high) / 2, high)
    return high


def projection(dimension: int, m: int) -> np.ndarray:
    return np.random.default_rng([7, dimension, m]).standard_normal((dimension, m))


def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten(), np.float64).reshape(-1, dimension)


# ------------------------------------------------------------- kd-trees --
def _split(points: np.ndarray) -> tuple[int, float, np.ndarray]:
    """The widest dimension, its middle value and which points lie above."""
    dim = int(np.argmax(points.max(axis=0) - points.min(axis=0)))
    middle = float(np.median(points[:, dim]))
    return dim, middle, points[:, dim] > middle


@dataclass
class Cells:
    """The upper levels of a kd-tree: inner nodes in heap order, node 1 on top."""

    dims: np.ndarray
    middles: np.ndarray

    @classmethod
    def fit(cls, sample: np.ndarray, wanted: int) -> Cells:
        levels = 0
        while 2 << levels <= min(wanted, len(sample) // 16):
            levels += 1
        dims, middles = np.zeros(1 << levels, np.int64), np.zeros(1 << levels)
        held = {1: sample}
        for node in range(1, 1 << levels):
            points = held.pop(node)
            above = np.zeros(len(points), bool)
            if len(points):
                dims[node], middles[node], above = _split(points)
            held[2 * node], held[2 * node + 1] = points[~above], points[above]
        return cls(dims, middles)

    def of(self, points: np.ndarray) -> np.ndarray:
        node = np.ones(len(points), np.int64)
        for _ in range(len(self.dims).bit_length() - 1):
            node = 2 * node + (points[np.arange(len(points)), self.dims[node]] > self.middles[node])
        return node - len(self.dims)


def _leaves(points: np.ndarray, rows: int) -> list[np.ndarray]:
    """Positions of the points in each leaf of a kd-tree with at most ``rows`` points to a leaf."""
    done, held = [], [np.arange(len(points))]
    while held:
        at = held.pop()
        if len(at) <= rows:
            done.append(at)
            continue
        _, _, above = _split(points[at])
        if not above.any():  # all alike in the middle: cut anywhere
            above = np.arange(len(at)) >= len(at) // 2
        held += [at[above], at[~above]]
    return done


@dataclass
class Block:
    """A block's vectors, their projections and the leaves of its kd-tree."""

    ids: np.ndarray
    vectors: np.ndarray
    points: np.ndarray
    leaves: np.ndarray  # positions by leaf, -1 where a leaf has fewer
    low: np.ndarray
    high: np.ndarray

    @classmethod
    def build(cls, ids: np.ndarray, vectors: np.ndarray, stable: np.ndarray, leaf_rows: int) -> Block:
        points = vectors @ stable
        found = _leaves(points, leaf_rows)
        leaves = np.full((len(found), leaf_rows), -1)
        for i, at in enumerate(found):
            leaves[i, :len(at)] = at
        return cls(ids, vectors, points, leaves, np.stack([points[at].min(axis=0) for at in found]),
                   np.stack([points[at].max(axis=0) for at in found]))

    def packed(self) -> bytes:
        return ex.frame([ex.pack(x.reshape(-1)) for x in
                         (self.ids, self.vectors, self.points, self.leaves, self.low, self.high)])

    @classmethod
    def unpacked(cls, data: bytes, dimension: int, m: int) -> Block:
        ids, vectors, points, leaves, low, high = map(ex.unpack, ex.unframe(data))
        low = low.reshape(-1, m)
        return cls(ids, vectors.reshape(-1, dimension), points.reshape(-1, m), leaves.reshape(len(low), -1), low,
                   high.reshape(-1, m))

    def search(self, names: np.ndarray, vectors: np.ndarray, points: np.ndarray, bounds: np.ndarray, k: int,
               quantile: float) -> tuple[np.ndarray, np.ndarray]:
        """(vec_id, distance) of the ``k`` nearest found for each query, infinite where there are fewer.

        ``bounds``: distances within which the query already has k others. A
        query's own row takes no part.
        """
        frontier = box_distances(points, self.low, self.high)
        order = np.argsort(frontier, axis=1, kind="stable")
        slack = 1e-9 * (1 + (points ** 2).sum(axis=1))  # rounding of the projections
        best = np.full((len(names), k), np.inf)
        near = np.full((len(names), k), np.iinfo(np.int64).max)
        for step in range(len(self.leaves)):
            limit = quantile * np.minimum(bounds, best[:, -1]) ** 2 + slack
            leaf = order[:, step]
            active = np.flatnonzero(frontier[np.arange(len(names)), leaf] <= limit)
            if not len(active):
                break  # the next leaves are farther and the limits no wider
            at = self.leaves[leaf[active]]
            apart = ((self.points[at] - points[active, None]) ** 2).sum(axis=2)
            rows, columns = np.nonzero((at >= 0) & (apart <= limit[active, None])
                                       & (self.ids[at] != names[active, None]))
            real = np.full(at.shape, np.inf)
            real[rows, columns] = np.sqrt(((self.vectors[at[rows, columns]] - vectors[active[rows]]) ** 2).sum(axis=1))
            real[real > bounds[active, None]] = np.inf
            ids = np.where(np.isfinite(real), self.ids[at], np.iinfo(np.int64).max)
            every, whose = np.concatenate([best[active], real], 1), np.concatenate([near[active], ids], 1)
            first = np.lexsort((whose, every))[:, :k]
            best[active], near[active] = np.take_along_axis(every, first, 1), np.take_along_axis(whose, first, 1)
        return near, best


def box_distances(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distances of points from boxes."""
    out = np.zeros((len(points), len(low)))
    for j in range(points.shape[1]):
        p = points[:, j, None]
        out += np.maximum(np.maximum(low[None, :, j] - p, p - high[None, :, j]), 0) ** 2
    return out


# ------------------------------------------------------------ the index --
@dataclass
class Index:
    """(block, cell, ids, payload, low, high), and what the search needs to know of it."""

    blocks: DataFrame
    dimension: int
    projections: int


def valid(embeddings: DataFrame) -> DataFrame:
    """(vec_id, embedding) that take part: one per vec_id, the smaller vector of different ones."""
    read = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"),
                             F.col("embedding").cast("array<double>").alias("embedding"))
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    kept = read.where(F.col("vec_id").isNotNull() & fine & F.exists("embedding", lambda x: x != 0))
    return kept.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))


def build(embeddings: DataFrame, projections: int = PROJECTIONS, sample: int = SAMPLE, block_rows: int = BLOCK_ROWS,
          leaf_rows: int = LEAF_ROWS) -> Index | None:
    """The index of all valid vectors of the most frequent dimension; None without any.

    Only the shape of the cells comes from a sample, of ``sample`` rows in
    expectation; every row is indexed.
    """
    spark = embeddings.sparkSession
    rows = materialise(valid(embeddings), "vectors")
    sizes = rows.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if sizes is None:
        return None
    dimension, n = sizes["d"], sizes["count"]
    rows = rows.where(F.size("embedding") == dimension)
    stable = projection(dimension, projections)
    share = min(1.0, sample / n)
    chosen = rows.where(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 30)) < int(share * (1 << 30)) + 1) \
        .select("embedding").toArrow()
    cells = Cells.fit(_matrix(chosen.column(0), dimension) @ stable, -(-n // block_rows))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = cells.of(_matrix(batch.column(1), dimension) @ stable)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own, pa.int32())],
                                             names=["vec_id", "embedding", "cell"])

    placed = materialise(rows.mapInArrow(assign, "vec_id long, embedding array<double>, cell int"), "cells")
    counts = placed.groupBy("cell").count().orderBy("cell").collect()  # at most sample / 16 cells
    slices = [(r["cell"], -(-r["count"] // block_rows)) for r in counts]
    firsts = np.cumsum([0, *[s for _, s in slices]]).tolist()
    listed = spark.createDataFrame([(c, s, f) for (c, s), f in zip(slices, firsts)], "cell int, slices long, first long")
    dealt = placed.join(F.broadcast(listed), "cell") \
        .withColumn("block", F.col("first") + F.pmod(F.xxhash64("vec_id", F.lit(11)), F.col("slices")))
    schema = pa.schema([("block", pa.int64()), ("cell", pa.int32()), ("ids", pa.list_(pa.int64())), ("payload", pa.binary()),
                        ("low", pa.list_(pa.float64())), ("high", pa.list_(pa.float64()))])

    def index(table: pa.Table) -> pa.Table:
        table = table.sort_by("vec_id")
        block = Block.build(np.asarray(table.column("vec_id")), _matrix(table.column("embedding"), dimension), stable,
                            leaf_rows)
        return pa.Table.from_pydict({
            "block": [table.column("block")[0].as_py()], "cell": [table.column("cell")[0].as_py()],
            "ids": [block.ids.tolist()], "payload": [block.packed()], "low": [block.low.min(axis=0).tolist()],
            "high": [block.high.max(axis=0).tolist()]}, schema=schema)

    blocks = dealt.select("block", "cell", "vec_id", "embedding").groupBy("block").applyInArrow(
        index, "block long, cell int, ids array<long>, payload binary, low array<double>, high array<double>")
    return Index(materialise(blocks, "index", "uncompressed"), dimension, projections)


_RESULT = "query_id long, rank int, vec_id long, score double"


def nearest(embeddings: DataFrame, is_query: Column, k: int = 10, sure: float = SURE, index: Index | None = None,
            **shape) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found for the rows with ``is_query`` (a column over vec_id).

    score is the Euclidean distance of the vectors, nearest first, ties to the
    smaller vec_id; all candidates where there are fewer than ``k``. The index
    is built over ``embeddings`` with the arguments ``shape`` unless given.

    Vectors that are null, zero, or hold null or non-finite components take no
    part, nor do rows without a vec_id or of another than the most frequent
    dimension (the larger of equally frequent ones). Of rows that repeat a
    vec_id one takes part, the smallest vector. Other columns are not read. An
    empty table, or one without queries, gives an empty result.
    """
    spark = embeddings.sparkSession
    index = index or build(embeddings, **shape)
    if index is None:
        return spark.createDataFrame([], _RESULT)
    dimension, m = index.dimension, index.projections
    stable = projection(dimension, m)
    quantile = chi_square_quantile(sure, m)
    found = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64()), ("block", pa.int64()),
                       ("bound", pa.float64()), ("vector", pa.list_(pa.float64()))])
    found_type = "query_id long, vec_id long, score double, block long, bound double, vector array<double>"

    # the members of a block among the queries search it first
    members = index.blocks.select("block", "payload")
    asked = index.blocks.select("block", F.explode("ids").alias("vec_id")).where(is_query) \
        .groupBy("block").agg(F.collect_list("vec_id").alias("asked"))  # at most a block's rows

    def at_home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, data, wanted in zip(*(batch.column(i) for i in range(3))):
                block = Block.unpacked(data.as_py(), dimension, m)
                own = np.searchsorted(block.ids, np.sort(np.asarray(wanted.values)))
                for lo in range(0, len(own), QUERIES):
                    at = own[lo:lo + QUERIES]
                    ids, apart = block.search(block.ids[at], block.vectors[at], block.points[at],
                                              np.full(len(at), np.inf), k, quantile)
                    rows, columns = np.nonzero(np.isfinite(apart))
                    bounds, queries = apart[:, -1], block.ids[at]
                    # one row with the query itself, and its neighbours so far
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.concatenate([queries, queries[rows]])),
                        pa.array([None] * len(at) + ids[rows, columns].tolist(), pa.int64()),
                        pa.array([None] * len(at) + apart[rows, columns].tolist(), pa.float64()),
                        pa.array([number.as_py()] * (len(at) + len(rows)), pa.int64()),
                        pa.array(np.concatenate([bounds, np.full(len(rows), np.nan)])),
                        pa.array(block.vectors[at].tolist() + [None] * len(rows), found.field("vector").type),
                    ], schema=found)

    home = materialise(asked.join(members, "block").select("block", "payload", "asked").mapInArrow(
        at_home, found_type), "home")
    queries = home.where("vec_id IS NULL")

    # cells are at most sample / 16: their boxes and blocks go to every task
    boxes = index.blocks.groupBy("cell").agg(
        F.min("block").alias("first"), (F.max("block") - F.min("block") + 1).alias("n"),
        *[F.min(F.col("low")[j]).alias(f"l{j}") for j in range(m)],
        *[F.max(F.col("high")[j]).alias(f"h{j}") for j in range(m)]).orderBy("cell").collect()
    low = np.array([[r[f"l{j}"] for j in range(m)] for r in boxes])
    high = np.array([[r[f"h{j}"] for j in range(m)] for r in boxes])
    first, slices = [r["first"] for r in boxes], [r["n"] for r in boxes]

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, QUERIES):
                batch = whole.slice(lo, QUERIES)
                ids, home_block, bounds = (np.asarray(batch.column(i)) for i in range(3))
                vectors = _matrix(batch.column(3), dimension)
                points = vectors @ stable
                slack = 1e-9 * (1 + (points ** 2).sum(axis=1))
                near = box_distances(points, low, high) <= (quantile * bounds ** 2 + slack)[:, None]
                for cell in np.flatnonzero(near.any(axis=0)).tolist():
                    for block in range(first[cell], first[cell] + slices[cell]):
                        at = np.flatnonzero(near[:, cell] & (home_block != block))
                        if len(at):
                            payload = ex.frame([ex.pack(ids[at]), ex.pack(bounds[at]), ex.pack(vectors[at].reshape(-1))])
                            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()),
                                                              pa.array([payload], pa.binary())], names=["block", "asked"])

    routed = materialise(queries.select("query_id", "block", "bound", "vector")
                         .mapInArrow(route, "block long, asked binary"), "routed", "uncompressed")
    answer = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, block = None, None
        for batch in batches:
            for number, data, asked in zip(*(batch.column(i) for i in range(3))):
                if at != number.as_py():
                    at, block = number.as_py(), Block.unpacked(data.as_py(), dimension, m)
                ids, bounds, vectors = map(ex.unpack, ex.unframe(asked.as_py()))
                vectors = vectors.reshape(-1, dimension)
                near, apart = block.search(ids, vectors, vectors @ stable, bounds, k, quantile)
                rows, columns = np.nonzero(np.isfinite(apart))
                yield pa.RecordBatch.from_arrays([pa.array(ids[rows]), pa.array(near[rows, columns]),
                                                  pa.array(apart[rows, columns])], schema=answer)

    visited = routed.join(members, "block").select("block", "payload", "asked") \
        .mapInArrow(visit, "query_id long, vec_id long, score double")
    every = home.where("vec_id IS NOT NULL").select("query_id", "vec_id", "score").unionByName(visited)
    rank = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return every.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")
