"""Near-duplicate documents by bottom-k sketches of their word shingles.

One hash function gives every shingle a value; a document keeps its ``SKETCH`` smallest ones.

1. Documents with equal shingle sets fall together (by a 128-bit digest of the whole set).
2. Inverted lists of retained values give the candidates. Two sketches that pass step 3 share at
   least ``LEAST_SHARE`` of their values, so it is enough to list each document under its rarest
   values: all but ``LEAST_SHARE`` of the sketch, values of one document aside. That keeps the
   values of widespread passages out of the lists of documents that are mostly their own text.
3. Pairs from a short list are compared by the estimate on the union sketch: of the k smallest values
   of both documents, the share that both hold. At a true similarity of 0.75 and k = 64 that share is
   below 0.4 with a probability of about 1e-9. Sets of at most k shingles are compared exactly here.
4. A long list isn't paired out. Its members are tied to its first member, a row each, which only puts
   them into one family for step 5.
5. Families (components of these ties) are verified on full shingle sets, all pairs of a family in
   blocks of a bounded number of shingles, as a matrix product. A block gives a row per linked member,
   never its pairs. The components of the verified links are the result.

No list, family or group is capped: what doesn't fit one block goes to several, in different tasks.

Defined results: a null or blank text has no shingles, is linked with nothing and is kept; a row without doc_id
has no component and is kept. Equal rows are one document for the links, and each gets its row. Rows that share a doc_id but not the
text are documents of their own, each linked by its own text; both carry the same doc_id.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recurra.llm.shared import checkpoint, components
from recurra.llm.words import chunks, numbered, shingle_hashes, split_words, word_hashes

SHINGLE = 5
SIMILARITY_PCT = 75
SKETCH = 64
LEAST_SHARE = 0.4
SHORT_LIST = 48
BLOCK_SHINGLES = 64_000

SKETCHED = "doc_id long, n_shingles long, digest binary, sketch array<long>"


def _sets(batch: pa.RecordBatch, width: int) -> Iterator[np.ndarray]:
    words, offsets = split_words(batch.column("text"))
    index, distinct = numbered(words)
    return shingle_hashes(word_hashes(distinct)[index], offsets, width)


def _digest(values: np.ndarray) -> bytes | None:
    """128 bits of a whole set, None if it is empty."""
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest() if len(values) else None


def _sketches(batches: Iterator[pa.RecordBatch], width: int, k: int) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches, "text"):
        sizes, digests, sketches = [], [], []
        for values in _sets(batch, width):
            sizes.append(len(values))
            digests.append(_digest(values))
            sketches.append(values[:k])
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(sizes, pa.int64()),
                pa.array(digests, pa.binary()),
                pa.array(sketches, pa.list_(pa.int64())),
            ],
            ["doc_id", "n_shingles", "digest", "sketch"],
        )


def _full_sets(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches, "text"):
        rest = [name for name in batch.schema.names if name != "text"]
        sets = list(_sets(batch, width))
        columns = [pa.array([_digest(values) for values in sets], pa.binary()), pa.array(sets, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(name) for name in rest), *columns], [*rest, "digest", "shingles"]
        )


def sketches(docs: DataFrame, width: int = SHINGLE, k: int = SKETCH) -> DataFrame:
    """doc_id, n_shingles, digest of the whole set (null if empty) and the k smallest values."""
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(partial(_sketches, width=width, k=k), SKETCHED)


def _classes(sketched: DataFrame) -> DataFrame:
    """One row per distinct shingle set: its digest, its smallest doc_id and a number that no other set has (once it is written)."""
    return (
        sketched.where(F.col("digest").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("digest")
        .agg(F.min("doc_id").alias("doc_id"))
        .withColumn("rep", F.monotonically_increasing_id())
    )


def _listed(reps: DataFrame) -> DataFrame:
    """value, rep, n_shingles, holders: each document under those of its rarest values that others hold."""
    held = reps.select("rep", "n_shingles", F.size("sketch").alias("kept"), F.explode("sketch").alias("value"))
    shared = held.groupBy("value").agg(F.count("*").alias("holders")).where("holders > 1")
    per_doc = (
        held.join(shared, "value")
        .groupBy("rep", "n_shingles", "kept")
        .agg(F.sort_array(F.collect_list(F.struct("holders", "value"))).alias("values"))
    )
    alone = F.col("kept") - F.size("values")
    length = F.col("kept") - F.ceil(F.col("kept") * F.lit(LEAST_SHARE)).cast("int") + 1 - alone
    return (
        per_doc.where(length > 0)
        .select("rep", "n_shingles", F.explode(F.slice("values", F.lit(1), length.cast("int"))).alias("v"))
        .select("v.value", "rep", "n_shingles", "v.holders")
    )


def _estimated(pairs: DataFrame, reps: DataFrame, k: int) -> DataFrame:
    """The pairs whose share of common values in the union sketch is at least ``LEAST_SHARE``."""
    a = reps.select(F.col("rep").alias("a"), F.col("sketch").alias("sa"))
    b = reps.select(F.col("rep").alias("b"), F.col("sketch").alias("sb"))
    union = F.slice(F.array_sort(F.array_union("sa", "sb")), 1, k)
    both = F.array_intersect(F.array_intersect("sa", "sb"), union)
    return (
        pairs.join(a, "a")
        .join(b, "b")
        .where(F.size(both) >= F.lit(LEAST_SHARE) * F.size(union))
        .select("a", "b")
    )


def _families(reps: DataFrame, k: int) -> DataFrame:
    """rep, family: documents that may be linked are in one family; a document alone has no row."""
    listed = checkpoint(_listed(reps))
    short, long = listed.where(F.col("holders") <= SHORT_LIST), listed.where(F.col("holders") > SHORT_LIST)
    left = short.select("value", F.col("rep").alias("a"), F.col("n_shingles").alias("na"))
    right = short.select("value", F.col("rep").alias("b"), F.col("n_shingles").alias("nb"))
    fits = 100 * F.least("na", "nb") >= SIMILARITY_PCT * F.greatest("na", "nb")
    pairs = left.join(right, "value").where((F.col("a") < F.col("b")) & fits).select("a", "b").distinct()
    first = long.groupBy("value").agg(F.min("rep").alias("a"))
    ties = long.join(first, "value").where(F.col("rep") != F.col("a")).select("a", F.col("rep").alias("b")).distinct()
    joined = components(_estimated(pairs, reps, k).union(ties))
    families = joined.select(F.col("node").alias("rep"), F.col("component").alias("family"))
    return families.union(joined.select(F.col("component"), F.col("component")).distinct())


def _linked(sets: list[np.ndarray], side: np.ndarray, k: int, pct: int) -> np.ndarray:
    """Which of these sets are linked, as a matrix; only pairs across sides (0 and 1), or all pairs if there is one side."""
    n, sizes = len(sets), np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(n), sizes)
    values, index, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    wanted = np.less.outer(np.arange(n), np.arange(n)) if side.min() == side.max() else np.not_equal.outer(side, side)
    wanted &= 100 * np.minimum.outer(sizes, sizes) >= pct * np.maximum.outer(sizes, sizes)
    if n > 8:
        wanted &= _may_link(sets, k)
    if not wanted.any():
        return wanted
    common = np.zeros((n, n), np.int64)
    column = np.cumsum(counts > 1) - 1
    own = counts[index] > 1
    rows, columns = owner[own], column[index[own]]
    order = np.argsort(columns, kind="stable")
    rows, columns = rows[order], columns[order]
    step = max(256, 8_000_000 // max(1, n))
    for start in range(0, int(column[-1]) + 1, step):
        a, b = np.searchsorted(columns, [start, start + step])
        held = np.zeros((n, min(step, int(column[-1]) + 1 - start)), np.float32)
        held[rows[a:b], columns[a:b] - start] = 1
        common += (held @ held.T).astype(np.int64)
    union = sizes[:, None] + sizes[None, :] - common
    return wanted & (100 * common >= pct * union)


def _may_link(sets: list[np.ndarray], k: int) -> np.ndarray:
    """The upper bound of step 3 for all pairs: the sketches share at least ``LEAST_SHARE`` of the larger one."""
    heads = [s[:k] for s in sets]
    lengths = np.array([len(s) for s in heads])
    _, index, counts = np.unique(np.concatenate(heads), return_inverse=True, return_counts=True)
    owner, column = np.repeat(np.arange(len(sets)), lengths), np.cumsum(counts > 1) - 1
    own = counts[index] > 1
    common = np.zeros((len(sets), len(sets)), np.float32)
    for start in range(0, int(column[-1]) + 1, 4096):
        held = np.zeros((len(sets), 4096), np.float32)
        here = own & (column[index] >= start) & (column[index] < start + 4096)
        held[owner[here], column[index[here]] - start] = 1
        common += held @ held.T
    return common >= LEAST_SHARE * np.maximum.outer(lengths, lengths) - 1e-6


def _stars(linked: np.ndarray, ids: np.ndarray) -> Iterator[tuple[int, int]]:
    """The components of a link matrix: each member with the smallest id of its component."""
    linked = linked | linked.T
    left = np.ones(len(ids), bool)
    for start in range(len(ids)):
        if left[start] and linked[start].any():
            inside = np.zeros(len(ids), bool)
            inside[start] = True
            front = inside
            while front.any():
                front = linked[front].any(axis=0) & ~inside
                inside = inside | front
            left &= ~inside
            members = ids[inside]
            yield from ((int(m), int(members.min())) for m in members if m != members.min())


def _verify(table: pa.Table, k: int, pct: int) -> pa.Table:
    """Links within each unit of a group, as stars."""
    units = table.column("unit").to_numpy()
    ids, sides = table.column("rep").to_numpy(), table.column("side").to_numpy()
    lists = table.column("shingles").combine_chunks()
    offsets, flat = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
    order = np.argsort(units, kind="stable")
    found: list[tuple[int, int]] = []
    for member in np.split(order, np.flatnonzero(np.diff(units[order])) + 1):
        if len(member) > 1:
            sets = [flat[offsets[i] : offsets[i + 1]] for i in member]
            found.extend(_stars(_linked(sets, sides[member], k, pct), ids[member]))
    return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})


def _units(families: DataFrame, reps: DataFrame) -> DataFrame:
    """rep, family, unit, side, bucket: the blocks in which a family is verified.

    A family of up to ``BLOCK_SHINGLES`` shingles is one unit. A larger one is dealt into as many blocks as
    its shingles ask for, and each two blocks (and each block with itself) are a unit. Units of small families share a
    bucket, which is what one group of the verification reads.
    """
    sized = families.join(reps.select("rep", "doc_id", "digest", "n_shingles"), "rep")
    totals = sized.groupBy("family").agg(F.sum("n_shingles").alias("total"))
    parted = sized.join(totals, "family").withColumn("blocks", F.ceil(F.col("total") / BLOCK_SHINGLES).cast("int"))
    own = parted.withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    met = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    small, large = F.least("own", "other"), F.greatest("own", "other")
    return met.select(
        "rep",
        "doc_id",
        "digest",
        "family",
        F.xxhash64("family", small, large).alias("unit"),
        (F.col("own") > F.col("other")).cast("int").alias("side"),
        (F.col("blocks") > 1).alias("large"),
        "total",
    )


def links(docs: DataFrame, reps: DataFrame, width: int = SHINGLE, k: int = SKETCH, pct: int = SIMILARITY_PCT) -> DataFrame:
    """a, b: verified links between distinct shingle sets, enough of them to hold every component together."""
    units = checkpoint(_units(_families(reps, k), reps))
    work = units.where(~F.col("large")).select("family", "total").distinct().agg(F.sum("total")).first()[0] or 0
    buckets = int(work // BLOCK_SHINGLES) + 1
    bucket = F.when(F.col("large"), F.col("unit")).otherwise(F.pmod("family", F.lit(buckets)))
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = narrow.join(units.select("doc_id").distinct(), "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    sets = texts.mapInArrow(partial(_full_sets, width=width), "doc_id long, digest binary, shingles array<long>")
    # a set that comes twice, from texts of one doc_id that differ in blanks or case, only links with itself
    return (
        units.withColumn("bucket", bucket)
        .join(sets, ["doc_id", "digest"])
        .select("bucket", "unit", "rep", "side", "shingles")
        .groupBy("bucket")
        .applyInArrow(lambda table: _verify(table, k, pct), "a long, b long")
    )


def near_duplicates(docs: DataFrame, width: int = SHINGLE, k: int = SKETCH, pct: int = SIMILARITY_PCT) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links) and kept, a row per row of ``docs``."""
    if pct < 60:
        raise ValueError("the sketch's margin holds for a similarity of 60 % or more")
    sketched = checkpoint(sketches(docs, width, k))
    classes = checkpoint(_classes(sketched))
    reps = checkpoint(
        sketched.where(F.col("digest").isNotNull())
        .join(classes, ["doc_id", "digest"])
        .select("rep", "doc_id", "digest", "n_shingles", "sketch")
        .dropDuplicates(["rep"])
    )
    joined = components(links(docs, reps, width, k, pct)).toDF("rep", "component")
    linked = joined.union(joined.select("component", "component").distinct())
    members = classes.select("rep", "doc_id").join(linked, "rep")
    least = members.groupBy("component").agg(F.min("doc_id").alias("least"))
    ends = linked.join(least, "component").select("rep", "least")
    of_class = classes.join(ends, "rep", "left").select("digest", F.coalesce("least", "doc_id").alias("component"))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return (
        sketched.select("doc_id", "n_shingles", "digest")
        .join(of_class, "digest", "left")
        .select(
            F.col("doc_id").cast(T.LongType()),
            "n_shingles",
            component.alias("component_id"),
            F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
        )
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents without all but one of each near-duplicate group, whole rows; equal texts of one doc_id count once.

    A doc_id with several texts keeps them all where one of them is kept.
    """
    kept = near_duplicates(docs).where(F.col("kept") & F.col("doc_id").isNotNull()).select("doc_id").distinct()
    unnamed = docs.where(F.col("doc_id").isNull())
    return docs.join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"]).unionByName(unnamed)
