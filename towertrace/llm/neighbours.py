"""Approximate nearest neighbours by collision-counting hashing.

Nearness is the inner product.  Vectors get one more coordinate that brings
them all to the length of the longest one (queries are scaled to it), so that
the largest inner product is the smallest Euclidean distance.

A hash function is a projection on one direction (rows of random rotations),
and its table is the sorted array of the projections.  A query opens a window
around its own projection in every array; a vector inside it collides under
that function.  Virtual rehashing widens all windows by one factor until enough
vectors collide under at least `share` of the functions; collisions are counted
from the vectors' places in the arrays.  All of these, however many, are verified with their
inner products on the original vectors.

Distribution.  Equal vectors are one node that keeps its k + 1 smallest ids (a
query needs no more of them), so a vector that fills a third of the table is
indexed and searched once.  Nodes are dealt by hash into blocks of about
`block`; every block builds its sorted arrays once, and the query nodes are
streamed past it.  A block gives its best k + 1 nodes per query, and the best
over all blocks are taken by a window that is limited before its shuffle.

Defined results
---------------
* Rows without an id, and vectors null, empty, zero or with null or non-finite
  components take no part, as query or as candidate.
* Rows with the same id and vector are one row.  An id with several vectors is
  several rows: as a query each is searched, and the others are candidates.
* Vectors of different length have no inner product and are no candidates of
  each other.
* The score is the sum in double precision from the first to the last
  component.  Ties go to the smaller id.
* With fewer than k candidates all of them are returned.  An empty table gives
  an empty result.
* Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import cut

SEED = 42


class Block:
    """The sorted arrays of one block's vectors, and the search in them."""

    def __init__(self, vectors: np.ndarray, longest: float, functions: int, share: float, verify: float, widen: float):
        self.vectors, self.longest, self.widen = vectors, longest, widen
        self.directions = directions(vectors.shape[1] + 1, functions)
        rest = np.sqrt(np.maximum(longest ** 2 - np.einsum("ij,ij->i", vectors, vectors), 0.0))
        projected = np.column_stack([vectors, rest]) @ self.directions.T
        size = len(vectors)
        order = np.argsort(projected, axis=0, kind="stable").T
        # the sorted arrays one behind the other, each moved past the last one
        self.reach = 1.5 * max(float(np.abs(projected).max()), 1e-300)
        self.moved = 3 * self.reach * np.arange(functions)
        self.sorted = (np.take_along_axis(np.ascontiguousarray(projected.T), order, 1) + self.moved[:, None]).ravel()
        self.begin = size * np.arange(functions)
        # the place of every vector in each sorted array: it is inside a window
        # [low, high) of places when place - low < high - low, without sign
        self.places = np.empty(order.shape, np.uint16 if size < 1 << 16 else np.uint32)
        np.put_along_axis(self.places, order, np.arange(size, dtype=self.places.dtype)[None, :], 1)
        self.shifted, self.inside = np.empty_like(self.places), np.empty(order.shape, bool)
        self.count_type = np.uint8 if functions < 1 << 8 else np.uint16
        self.threshold = int(np.ceil(share * functions))
        self.verify = verify
        self.radius = longest / 8

    def colliding(self, query: np.ndarray, least: int) -> np.ndarray:
        """Rows over the collision threshold: eight times the `least` that are
        wanted and a share of the block, or more."""
        size, functions = len(self.vectors), len(self.directions)
        least = min(size, max(8 * least, int(np.ceil(self.verify * size))))
        centre = self.directions[:, :-1] @ (query * (self.longest / np.linalg.norm(query)))
        low, high = (np.empty((functions, 1), self.places.dtype) for _ in range(2))
        radius = self.radius
        while True:
            low[:, 0] = self._place(centre - radius, "left")
            high[:, 0] = self._place(centre + radius, "right")
            np.subtract(self.places, low, out=self.shifted)
            np.less(self.shifted, high - low, out=self.inside)
            counts = np.add.reduce(self.inside.view(np.uint8), axis=0, dtype=self.count_type)
            found = np.flatnonzero(counts >= self.threshold)
            if len(found) >= least or int((high - low).sum(dtype=np.int64)) == size * functions:
                # the next query starts a little below where this one ended
                self.radius = radius / self.widen ** 2
                return found
            radius *= self.widen

    def _place(self, values: np.ndarray, side: str) -> np.ndarray:
        """Where each value stands in its function's sorted array."""
        return self.sorted.searchsorted(values.clip(-self.reach, self.reach) + self.moved, side) - self.begin

    def nearest(self, query: np.ndarray, names: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(rows, scores) of the best k verified rows, ties by `names`."""
        rows = self.colliding(query, k)
        rough = self.vectors[rows] @ query
        if len(rows) > k:
            slack = 1e-9 * self.longest * np.linalg.norm(query)
            rows = rows[rough >= np.partition(rough, -k)[-k] - slack]
        scores = (self.vectors[rows] * query).cumsum(axis=1)[:, -1]
        best = np.lexsort((names[rows], -scores))[:k]
        return rows[best], scores[best]


def directions(size: int, functions: int) -> np.ndarray:
    """Rows of random rotations, scaled to the length of normal vectors."""
    rng = np.random.default_rng(SEED)
    turns = [np.linalg.qr(rng.standard_normal((size, size)))[0] for _ in range(-(-functions // size))]
    return np.concatenate(turns)[:functions] * np.sqrt(size)


def usable(table: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """`(vec_id, vec)` of the rows that take part, without repeats."""
    fine = (F.col("vec_id").isNotNull()
            & F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
            & F.exists("vec", lambda x: x != 0))
    return (table.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("vec"))
            .where(fine).distinct())


def nodes_of(rows: DataFrame, k: int) -> DataFrame:
    """`(node, vec, dim, first, ids)`, written: one row per different vector
    with its k + 1 smallest ids."""
    w = Window.partitionBy("vec").orderBy("vec_id")
    some = rows.withColumn("r", F.row_number().over(w)).where(F.col("r") <= k + 1)
    groups = some.groupBy("vec").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    return cut(groups.select(F.monotonically_increasing_id().alias("node"), "vec", F.size("vec").alias("dim"),
                             F.element_at("ids", 1).alias("first"), "ids"), "ann-nodes")


def search(nodes: DataFrame, queries: DataFrame, k: int, functions: int = 96, share: float = 0.7, verify: float = 0.05,
           widen: float = 1.1, block: int = 8192) -> DataFrame:
    """`(query, node, first, score)`: for each of the nodes `queries (node,
    vec, dim)` the best k nodes of every block."""
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    count, longest = nodes.agg(F.count(F.lit(1)), F.max(norm)).first()
    parts = max(1, -(-count // block))
    longest = longest or 1.0
    vec = F.col("vec").cast("array<double>").alias("vec")
    indexed = nodes.select("dim", F.pmod(F.xxhash64("node"), F.lit(parts)).cast("int").alias("part"),
                           F.lit(0).alias("kind"), "node", "first", vec)
    asked = queries.select("dim", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"),
                           F.lit(1).alias("kind"), "node", F.lit(0).cast("long").alias("first"), vec)

    def run(batches):
        key, held, index, names, firsts = None, [], None, None, None
        for batch in batches:
            # runs of one block and kind
            marks = [batch.column(i).to_numpy() for i in range(3)]
            edge = np.flatnonzero(np.any([m[1:] != m[:-1] for m in marks], axis=0)) + 1
            for start, stop in zip([0, *edge.tolist()], [*edge.tolist(), batch.num_rows]):
                part = batch.slice(start, stop - start)
                dim, number, kind = (int(m[start]) for m in marks)
                vectors = part.column(5).flatten().to_numpy().reshape(-1, dim)
                if kind == 0:
                    if key != (dim, number):
                        key, held, index = (dim, number), [], None
                    held.append((vectors, part.column(3).to_numpy(), part.column(4).to_numpy()))
                    continue
                if key != (dim, number):
                    continue  # no vector of this length in the block
                if index is None:
                    whole, names, firsts = (np.concatenate(x) for x in zip(*held))
                    index, held = Block(whole, longest, functions, share, verify, widen), []
                out = []
                for query, vector in zip(part.column(3).to_pylist(), vectors):
                    rows, scores = index.nearest(vector, firsts, k)
                    out.append((np.full(len(rows), query), names[rows], firsts[rows], scores))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out)],
                                                 names=["query", "node", "first", "score"])

    return (indexed.union(asked).repartition("dim", "part").sortWithinPartitions("dim", "part", "kind", "node")
            .mapInArrow(run, "query bigint, node bigint, first bigint, score double"))


def nearest_neighbours(table: DataFrame, k: int = 20, every: int = 20, **parameters) -> DataFrame:
    """`(query_id, rank, vec_id, score)`: for the rows whose id is divisible
    by `every` the k nearest found among all others, nearest first."""
    rows = cut(usable(table), "ann-rows")
    nodes = nodes_of(rows, k)
    asked = cut(rows.where(F.col("vec_id") % every == 0).join(nodes.select("vec", "node"), "vec")
                .select(F.col("vec_id").alias("query_id"), "node"), "ann-queries")
    wanted = nodes.join(asked.select("node").distinct(), "node", "left_semi")
    found = search(nodes, wanted, k + 1, **parameters)
    w = Window.partitionBy("query").orderBy(F.desc("score"), "first", "node")
    best = found.withColumn("r", F.row_number().over(w)).where(F.col("r") <= k + 1)
    ids = (best.join(nodes.select("node", "ids"), "node")
           .select("query", "node", "score", F.explode("ids").alias("vec_id")))
    w = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id", "node")
    lists = cut(ids.withColumn("r", F.row_number().over(w)).where(F.col("r") <= k + 1)
                .select("query", F.col("node").alias("of"), "vec_id", "score"), "ann-lists")
    others = asked.join(lists, asked["node"] == lists["query"]).where("vec_id <> query_id OR of <> node")
    w = Window.partitionBy("query_id", "node").orderBy(F.desc("score"), "vec_id", "of")
    return (others.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
