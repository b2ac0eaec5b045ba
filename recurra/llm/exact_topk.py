"""Exact top-k search by inner product, with a KD-tree per shard.

Vectors are dealt to shards of a bounded size by a hash of their id, queries to blocks. A unit is one shard with one
block of queries; it builds the shard's tree (median splits of the widest side, a tight bounding box
per node) and searches it best-first: a heap orders the open nodes by the upper bound of the inner product over their
box, and a node whose bound is below the query's k-th score is never opened.

The k-th score travels between shards: the units of the first shard run first, and their k-th score is the floor
with which every other shard starts. A bound equal to the floor is still opened, since ties go to the smaller id.

Vectors of integers give exact scores, decimal(38, 0): in floating point where the largest product allows (below 2**53), else in 64-bit or
Python integers, with bounds rounded outwards. Scores beyond 38 digits are cut to 38 nines, after ranking within a shard. Other vectors give doubles.

Defined results: a vector that is null, empty or holds a null or non-finite component takes no part, nor does a row without id.
An id that occurs several times counts once, with its smallest vector. Vectors of another length than the query's are no candidates.
Fewer than k candidates give fewer rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recurra.llm.shared import checkpoint

SHARD_ROWS = 4096
BLOCK_QUERIES = 1024
LEAF_ROWS = 64

EXACT_FLOATS = 2**53
EXACT_LONGS = 2**63
MOST = 10**38 - 1


def scaled(vector: str, scale: int):
    """Each component x as floor(scale * x), x as double."""
    return F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long"))


def usable(vector: str):
    """Whether a vector has components, and none of them is null or not finite."""
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return F.coalesce(F.col(vector).isNotNull() & (F.size(vector) > 0) & sound, F.lit(False))


class Tree:
    """A KD-tree over the rows of ``points``; nodes are ranges of ``order``."""

    def __init__(self, points: np.ndarray, leaf: int):
        self.order = np.arange(len(points))
        self.ranges: list[tuple[int, int]] = []
        self.children: list[tuple[int, int] | None] = []
        low, high = [], []
        todo = [(0, len(points), -1, 0)]
        while todo:
            start, end, parent, side = todo.pop()
            node = len(self.ranges)
            if parent >= 0:
                pair = self.children[parent]
                self.children[parent] = (node, pair[1]) if side == 0 else (pair[0], node)
            rows = self.order[start:end]
            box = points[rows]
            low.append(box.min(axis=0))
            high.append(box.max(axis=0))
            self.ranges.append((start, end))
            widths = high[-1] - low[-1]
            if end - start <= leaf or widths.max() == 0:
                self.children.append(None)
                continue
            middle = (end - start) // 2
            self.order[start:end] = rows[np.argpartition(box[:, widths.argmax()], middle)]
            self.children.append((-1, -1))
            todo.append((start, start + middle, node, 0))
            todo.append((start + middle, end, node, 1))
        self.low, self.high = np.array(low, np.float64), np.array(high, np.float64)
        self.points = points[self.order]
        self.floats = self.points.astype(np.float64)
        self.whole = points.dtype.kind == "i"
        self.largest = max(map(abs, (int(points.min()), int(points.max())))) if self.whole else 0

    def reach(self, query: np.ndarray) -> int:
        """No product of this query, and no sum of its products, has a larger size; for integers."""
        return self.largest * max(map(abs, (int(query.min()), int(query.max())))) * len(query)

    def bounds(self, query: np.ndarray) -> np.ndarray:
        """For every node the largest inner product that any point of its box could have, or a little more."""
        floats = query.astype(np.float64)
        corner = np.where(floats > 0, self.high, self.low)
        bounds = corner @ floats
        if self.whole and self.reach(query) >= EXACT_FLOATS:
            bounds += np.abs(corner) @ np.abs(floats) * (len(query) + 4) * 2.0**-52
        return bounds

    def scores(self, start: int, end: int, query: np.ndarray) -> np.ndarray:
        """The inner products of these points; exact for integers."""
        reach = self.reach(query) if self.whole else 0
        if reach < EXACT_FLOATS:
            return self.floats[start:end] @ query.astype(np.float64)
        kind = np.int64 if reach < EXACT_LONGS else object
        return self.points[start:end].astype(kind) @ query.astype(kind)


def search(tree: Tree, ids: np.ndarray, query: np.ndarray, own: int, k: int, floor) -> list[tuple]:
    """The k best (score, id) of one tree, scores below ``floor`` left out; ``own`` is no candidate."""
    number = int if tree.whole else float

    def below(value) -> float:
        """A floor for the bounds: no larger than the value."""
        near = float(value)
        return near if abs(value) < EXACT_FLOATS or not tree.whole else np.nextafter(near, -np.inf)

    bounds = tree.bounds(query)
    best: list[tuple] = []
    least = below(floor)
    open_nodes = [(-bounds[0], 0)]
    while open_nodes:
        bound, node = heapq.heappop(open_nodes)
        if -bound < least:
            break
        children = tree.children[node]
        if children is not None:
            for child in children:
                if bounds[child] >= least:
                    heapq.heappush(open_nodes, (-bounds[child], child))
            continue
        start, end = tree.ranges[node]
        scores, here = tree.scores(start, end, query), ids[start:end]
        good = np.flatnonzero((scores >= floor) & (here != own))
        if not len(good):
            continue
        if len(good) > k:
            good = good[np.lexsort((here[good], -scores[good]))[:k]]
        best = sorted(best + [(-number(scores[i]), int(here[i])) for i in good])[:k]
        if len(best) == k:
            floor = max(floor, -best[-1][0])
            least = below(floor)
    return [(-score, vec_id) for score, vec_id in best]


def _matrix(table: pa.Table, name: str) -> list[np.ndarray]:
    lists = table.column(name).combine_chunks()
    offsets, flat = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
    return [flat[a:b] for a, b in zip(offsets[:-1], offsets[1:])]


def _unit(shard: pa.Table, queries: pa.Table, k: int, leaf: int) -> Iterator[tuple]:
    ids, vectors = shard.column("vec_id").to_numpy(), _matrix(shard, "vector")
    query_ids, floors = queries.column("query_id").to_numpy(), queries.column("floor").to_pylist()
    asked = _matrix(queries, "query")
    length = np.array([len(v) for v in vectors], np.int64)
    for size in np.unique(length).tolist():
        rows = np.flatnonzero(length == size)
        if not any(len(q) == size for q in asked):
            continue
        tree = Tree(np.stack([vectors[i] for i in rows]), leaf)
        sorted_ids = ids[rows][tree.order]
        for query_id, query, floor in zip(query_ids.tolist(), asked, floors):
            if len(query) == size:
                floor = float("-inf") if floor is None else int(floor) if tree.whole else floor
                for score, vec_id in search(tree, sorted_ids, query, query_id, k, floor):
                    yield query_id, vec_id, score


def _searched(shard: pa.Table, queries: pa.Table, k: int, leaf: int) -> pa.Table:
    rows = list(_unit(shard, queries, k, leaf)) if shard.num_rows and queries.num_rows else []
    score = queries.schema.field("floor").type
    if pa.types.is_decimal(score):
        rows = [(query_id, vec_id, Decimal(max(-MOST, min(MOST, found)))) for query_id, vec_id, found in rows]
    kinds = (pa.int64(), pa.int64(), score)
    columns = zip(*rows) if rows else ((), (), ())
    return pa.table(dict(zip(("query_id", "vec_id", "score"), map(pa.array, map(list, columns), kinds))))


def _wave(vectors: DataFrame, queries: DataFrame, shards: int, blocks: int, k: int, leaf: int, first: bool) -> DataFrame:
    """The best of each query in each shard of this wave: the first shard, or all others."""
    span = F.sequence(F.lit(0), F.lit(0)) if first else F.sequence(F.lit(1), F.lit(shards - 1))
    held = vectors.where(F.col("shard") == 0 if first else F.col("shard") > 0)
    left = held.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    right = queries.withColumn("shard", F.explode(span))
    return (
        left.groupBy("shard", "block")
        .cogroup(right.groupBy("shard", "block"))
        .applyInArrow(
            lambda shard, asked: _searched(shard, asked, k, leaf),
            f"query_id long, vec_id long, score {queries.schema['floor'].dataType.simpleString()}",
        )
    )


def _best(found: DataFrame, k: int) -> DataFrame:
    """The k best of all shards: a list per query, merged shard by shard before and after the shuffle."""
    order = F.struct("score", F.bitwise_not("vec_id").alias("turned"))
    return found.groupBy("query_id").agg(F.slice(F.sort_array(F.collect_list(order), asc=False), 1, k).alias("best"))


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 5,
    shard_rows: int = SHARD_ROWS,
    block_queries: int = BLOCK_QUERIES,
    leaf_rows: int = LEAF_ROWS,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for each query its k largest inner products, ties to the smaller vec_id.

    ``vectors`` and ``queries`` hold vec_id and vector (numbers). A query is no candidate for itself. Scores are
    exact, as decimals, where both hold integers, and doubles otherwise.
    """
    if k < 1:
        raise ValueError("k must be 1 or more")
    whole = all(isinstance(df.schema["vector"].dataType.elementType, T.IntegralType) for df in (vectors, queries))
    kind, score = ("array<long>", "decimal(38,0)") if whole else ("array<double>", "double")
    sound = [
        df.where(F.col("vec_id").isNotNull() & usable("vector"))
        .groupBy(F.col("vec_id").cast("long").alias("vec_id"))
        .agg(F.min(F.col("vector").cast(kind)).alias("vector"))
        for df in (vectors, queries)
    ]
    n, asked = (df.count() for df in sound)
    shards, blocks = max(1, -(-n // shard_rows)), max(1, -(-asked // block_queries))
    held = sound[0].withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int"))
    posed = sound[1].select(
        F.col("vec_id").alias("query_id"),
        F.col("vector").alias("query"),
        F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks)).cast("int").alias("block"),
    )
    found = checkpoint(_wave(held, posed.withColumn("floor", F.lit(None).cast(score)), shards, blocks, k, leaf_rows, True))
    if shards > 1:
        ends = _best(found, k).where(F.size("best") == k).select("query_id", F.col("best")[k - 1]["score"].alias("floor"))
        started = posed.join(ends, "query_id", "left")
        found = found.union(_wave(held, started, shards, blocks, k, leaf_rows, False))
    return _best(found, k).select(
        "query_id", F.posexplode("best").alias("place", "entry")
    ).select(
        "query_id",
        (F.col("place") + 1).cast("int").alias("rank"),
        F.bitwise_not("entry.turned").alias("vec_id"),
        F.col("entry.score").alias("score"),
    )
