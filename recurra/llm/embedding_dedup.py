"""Near-duplicate embeddings by randomly rotated binary codes.

Each vector is brought to length 1, rotated by one random rotation, and stored as the signs of its coordinates together with
its correction factor f = <code / sqrt(d), rotated vector>. For a rotated query q, <code / sqrt(d), q> / f is an unbiased
estimate of <vector, q> over the rotations, and its error stays below ``EPSILON`` * sqrt((1 - f^2) / (f^2 (d - 1))) but for
a probability that falls as exp(-EPSILON^2 / 2). Only pairs whose estimate plus that bound reaches the threshold are
recomputed, exactly, in double precision.

The codes stand in inverted lists. Centroids are fitted on at most ``SAMPLE_ROWS`` vectors (smallest hashes); every vector has
its home in the list of its best centroid, and asks every list whose centroid is as near as the home centroid of
a linked vector can be expected to be: ``REACH`` standard deviations of a random direction are allowed for. A pair is found
if either one asks the other's home, and counted once. Lists are dealt to blocks of bounded size, and any
two blocks of a list are a unit of work, so that a list with a third of all vectors is spread over many tasks. A unit
returns a count per vector and the components of its links, never its pairs.

Equal vectors fall together first and are expanded at the end. Defined results: a vector that is null, empty, zero or holds null or
non-finite components links with nothing; vectors of different length don't link; a row without vec_id has no
component and is kept; rows that repeat a vec_id count as one, with its smallest vector.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recurra.llm.exact_topk import usable
from recurra.llm.minhash_dedup import _stars
from recurra.llm.shared import checkpoint, components

THRESHOLD = 0.95
EPSILON = 3.5
REACH = 3.0
SAMPLE_ROWS = 16_384
MOST_LISTS = 2_048
BLOCK_ROWS = 2_048
SEED = 20_240_901

PLACED = "rep long, copies long, vector array<double>, home int, asked array<int>"


def rotation(d: int, seed: int = SEED) -> np.ndarray:
    """A random rotation of d dimensions, the same in every process."""
    q, r = np.linalg.qr(np.random.default_rng(seed + d).standard_normal((d, d)))
    return q * np.sign(np.diag(r))


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    """The rows (none zero) at length 1. Powers of two come off first, which is exact, so that no square is too large or too small."""
    near_one = np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=-1, keepdims=True))[1])
    return near_one / np.linalg.norm(near_one, axis=-1, keepdims=True)


def codes(unit: np.ndarray, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Packed signs of the rotated vectors, and their correction factors."""
    turned = unit @ rotation(unit.shape[1], seed)
    return np.packbits(turned > 0, axis=1), np.abs(turned).sum(axis=1) / np.sqrt(unit.shape[1])


def estimates(packed: np.ndarray, factor: np.ndarray, queries: np.ndarray, epsilon: float, seed: int = SEED):
    """Estimated inner products of coded unit vectors (rows) with unit queries (columns), and the bound of each row's error."""
    d = queries.shape[1]
    signs = np.unpackbits(packed, axis=1, count=d).astype(np.float32) * 2 - 1
    turned = (queries @ rotation(d, seed)).astype(np.float32)
    products = (signs @ turned.T) / (np.sqrt(d) * factor[:, None].astype(np.float32))
    return products, epsilon * np.sqrt(np.maximum(0, 1 - factor**2) / (factor**2 * max(1, d - 1)))


def _rows(lists: pa.Array) -> list[np.ndarray]:
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    offsets, flat = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
    return [flat[a:b] for a, b in zip(offsets[:-1], offsets[1:])]


def _centroids(unit: np.ndarray, lists: int, rounds: int = 4) -> np.ndarray:
    """Spherical k-means on the sample, started from evenly spaced rows of it."""
    centres = unit[np.linspace(0, len(unit) - 1, lists).astype(int)]
    for _ in range(rounds):
        home = (unit @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, home, unit)
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(length > 1e-9, sums / np.maximum(length, 1e-9), centres)
    return centres


def _place(batches: Iterator[pa.RecordBatch], centres: np.ndarray, threshold: float, reach: float) -> Iterator[pa.RecordBatch]:
    """Each vector with the list it lives in and the lists it asks."""
    slack = reach * np.sqrt((1 - threshold**2) / max(1, centres.shape[1]))
    for batch in batches:
        homes, asked = [], []
        for vector in _rows(batch.column("vector")):
            if len(vector) != centres.shape[1]:
                homes.append(-len(vector))
                asked.append(np.array([-len(vector)], np.int32))
                continue
            near = centres @ unit_rows(vector)
            home = int(near.argmax())
            wanted = near >= threshold * near[home] - slack
            wanted[home] = True
            homes.append(home)
            asked.append(np.flatnonzero(wanted).astype(np.int32))
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(homes, pa.int32()), pa.array(asked, pa.list_(pa.int32()))],
            ["rep", "copies", "vector", "home", "asked"],
        )


def _links_of(table: pa.Table, threshold: float, epsilon: float) -> Iterator[tuple[int, int, int]]:
    """rep, number of its links found here, smallest member of its component here; one list, two of its blocks.

    The left block lives in the list. The right one is a block of those who live there as well (``guest`` false),
    or of those who ask the list from elsewhere.
    """
    left, guest = (table.column(name).to_numpy(zero_copy_only=False).astype(bool) for name in ("left", "guest"))
    ids, copies, homes = (table.column(name).to_numpy() for name in ("rep", "copies", "home"))
    vectors, asked = _rows(table.column("vector")), _rows(table.column("asked"))
    own = np.flatnonzero(left)
    other = own if left.all() and not guest.any() else np.flatnonzero(~left)
    if not len(own) or not len(other) or len({len(v) for v in vectors}) > 1:
        return
    unit = unit_rows(np.stack(vectors))
    packed, factor = codes(unit[own])
    found_a, found_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for start in range(0, len(other), 1024):
        asking = other[start : start + 1024]
        guess, error = estimates(packed, factor, unit[asking], epsilon)
        i, j = np.nonzero(guess + error[:, None] >= threshold)
        a, b = own[i], asking[j]
        # a pair with a guest is counted in the list of the larger id if the smaller one asks it, else in the other list
        twice = np.fromiter((homes[y] in asked[x] if guest[y] and ids[x] < ids[y] else False for x, y in zip(a, b)), bool, len(a))
        counted = ~twice & ((ids[a] < ids[b]) if other is own else True)
        a, b = a[counted], b[counted]
        linked = np.einsum("ij,ij->i", unit[a], unit[b]) >= threshold
        found_a.append(a[linked])
        found_b.append(b[linked])
    a, b = np.concatenate(found_a), np.concatenate(found_b)
    if not len(a):
        return
    some, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    counts = np.bincount(place, weights=np.concatenate([copies[b], copies[a]]), minlength=len(some)).astype(np.int64)
    matrix = np.zeros((len(some), len(some)), bool)
    matrix[place[: len(a)], place[len(a) :]] = True
    least = dict(_stars(matrix, ids[some]))
    for row, n in zip(ids[some].tolist(), counts.tolist()):
        yield row, n, least.get(row, row)


def _searched(table: pa.Table, threshold: float, epsilon: float) -> pa.Table:
    columns = list(zip(*_links_of(table, threshold, epsilon))) or [(), (), ()]
    return pa.table({n: pa.array(list(c), pa.int64()) for n, c in zip(("rep", "links", "least"), columns)})


def _blocks(placed: DataFrame, block_rows: int) -> DataFrame:
    """The rows of every unit (list, x, y): block x of those who live in the list, and block y of its members or guests."""
    homes = placed.withColumn("list", F.col("home")).withColumn("guest", F.lit(False))
    asks = placed.withColumn("list", F.explode("asked")).where(F.col("list") != F.col("home")).withColumn("guest", F.lit(True))
    sizes = (
        homes.select("list", "guest")
        .union(asks.select("list", "guest"))
        .groupBy("list")
        .agg(F.count_if(~F.col("guest")).alias("live"), F.count_if("guest").alias("ask"))
        .where("live > 0")
        .select(
            "list",
            F.ceil(F.col("live") / block_rows).cast("int").alias("homes"),
            F.ceil(F.col("ask") / block_rows).cast("int").alias("guests"),
        )
    )
    columns = ["list", "x", "y", "rep", "copies", "vector", "home", "asked", "left", "guest"]
    own = F.pmod(F.xxhash64("rep"), F.col("homes")).cast("int")
    lives = homes.join(sizes, "list").withColumn("own", own)
    left = (
        lives.withColumn("x", F.col("own"))
        .withColumn("y", F.explode(F.sequence(F.col("own"), F.col("homes") + F.col("guests") - 1)))
        .withColumn("left", F.lit(True))
    )
    right = (
        lives.where("own > 0")
        .withColumn("y", F.col("own"))
        .withColumn("x", F.explode(F.sequence(F.lit(0), F.col("own") - 1)))
        .withColumn("left", F.lit(False))
    )
    guests = (
        asks.join(sizes, "list")
        .withColumn("y", F.col("homes") + F.pmod(F.xxhash64("rep"), F.col("guests")).cast("int"))
        .withColumn("x", F.explode(F.sequence(F.lit(0), F.col("homes") - 1)))
        .withColumn("left", F.lit(False))
    )
    return left.select(columns).union(right.select(columns)).union(guests.select(columns))


def links(classes: DataFrame, threshold: float = THRESHOLD, epsilon: float = EPSILON, reach: float = REACH) -> DataFrame:
    """rep, links (copies counted), least: a row for each unit of work in which a vector has links.

    ``classes`` holds rep, copies and vector (doubles, not zero), each vector once.
    """
    sample = classes.orderBy(F.xxhash64("rep"), "rep").limit(SAMPLE_ROWS).select("vector").toPandas()["vector"]
    n = classes.count()
    lengths = np.array([len(v) for v in sample], np.int64)
    common = int(np.bincount(lengths).argmax()) if len(lengths) else 1
    unit = np.array([v for v in sample if len(v) == common], np.float64).reshape(-1, common)
    unit = unit_rows(unit) if len(unit) else unit
    centres = _centroids(unit, min(MOST_LISTS, len(unit), int(np.sqrt(n)))) if len(unit) else np.ones((1, 1))
    placed = checkpoint(classes.mapInArrow(partial(_place, centres=centres, threshold=threshold, reach=reach), PLACED))
    return (
        _blocks(placed, BLOCK_ROWS)
        .groupBy("list", "x", "y")
        .applyInArrow(lambda table: _searched(table, threshold, epsilon), "rep long, links long, least long")
    )


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id (smallest vec_id reachable by links, itself included) and kept, a row per vec_id.

    ``vectors`` holds vec_id and vector; pairs found link at a cosine of ``threshold`` or more, none below it.
    """
    given = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("vector").cast("array<double>").alias("vector"))
    once = given.where(F.col("vec_id").isNotNull()).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    some = F.exists("vector", lambda x: x != 0)
    sound = checkpoint(once.withColumn("sound", usable("vector") & F.coalesce(some, F.lit(False))))
    classes = checkpoint(
        sound.where("sound").groupBy("vector").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
        .select("rep", "copies", "vector")
    )
    found = checkpoint(links(classes, threshold))
    joined = components(found.select(F.col("rep").alias("a"), F.col("least").alias("b"))).toDF("rep", "component")
    counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
    of_class = (
        classes.join(counts, "rep", "left")
        .join(joined, "rep", "left")
        .select("vector", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n"), F.coalesce("component", "rep").alias("c"))
    )
    own = sound.where("sound").join(of_class, "vector").select("vec_id", "n", "c")
    alone = sound.where("not sound").select("vec_id", F.lit(0).cast("long").alias("n"), F.col("vec_id").alias("c"))
    unnamed = given.where(F.col("vec_id").isNull()).select("vec_id", F.lit(0).cast("long").alias("n"), F.col("vec_id").alias("c"))
    return own.union(alone).union(unnamed).select(
        "vec_id",
        F.col("n").alias("n_links"),
        F.col("c").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.col("c"), F.lit(True)).alias("kept"),
    )
