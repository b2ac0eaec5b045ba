"""How the filters of a corpus interact: what each removes, repeats or alone would have caught, in every order.

Filters (letter: a document fails if):

    A  it has under ``LEAST_WORDS`` words
    B  its distinct words are under ``LEAST_VARIETY`` % of its words
    C  over ``MOST_CAPITALS`` % of its code points are A-Z
    D  it holds one of ``#$%&*|``
    E  its text is identical to that of a smaller doc_id, anywhere in the table

A and B are decided by a sparse document-term matrix. Tasks cut their documents into shards of about ``SHARD_BYTES`` of text and
write each as CSR cells (gaps in row-major order, counts) with codes of the shard's own dictionary, in the shared folder. Then every
shard's distinct words are numbered globally: dealt once by a hash bucket, ranked within the bucket (of so many buckets that few hold two
words), the number being rank * ``BUCKETS`` + bucket, the same for a word whatever the shards. A word is one row per shard that holds it,
never one per occurrence, so that the most frequent word is as rare a row as any other. The numbers go back to their shards
and replace the local codes; row sums are words, nonzero counts distinct words.

C and D are columns of the first scan. E compares digests (SHA-256): the smallest doc_id of every digest that stands more than once,
combined before the shuffle, joined back. Rows with labels are then counted by part and the set of filters they fail, at most 32 a part, and only
these counts meet the 120 orders.

Defined results: a null text is empty; it fails A, not B, C or D. Rows without doc_id are counted and never fail E. Rows
that repeat a doc_id are counted each and aren't smaller than one another. A doc_id labelled several times is good, or
toxic, if one of its labels says so. Parts are the values of lang; a null lang joins the part of the empty string. A part has all of its 600
rows; an empty table has no parts. Other columns are ignored.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from recurra.llm.words import chunks, split_words
from recurra.sources.scratch import shared_path

FILTERS = "ABCDE"
LEAST_WORDS = 100
LEAST_VARIETY = 80
MOST_CAPITALS = 10
MARKS = "[#$%&*|]"
NO_CAPITAL = "[^A-Z]+"

SHARD_BYTES = 16_000_000
BUCKETS = 1 << 48

DOCUMENT = "doc_id long, part string, digest string, c boolean, d boolean"
DOCUMENTS = f"rows array<struct<{DOCUMENT.replace(' ', ': ').replace(',:', ',')}>>"
SHARD = f"shard long, {DOCUMENTS}, words array<string>, gaps binary, counts binary"
MATRIX = f"shard long, {DOCUMENTS}, starts array<int>, numbers array<long>, counts array<long>"
COUNTED = f"{DOCUMENT}, n_words long, n_distinct long"


def packed(values: np.ndarray) -> bytes:
    """Numbers from 0 to 2**63, compressed: their count and width, then all lowest bytes, all second ones and so on."""
    most = int(values.max()) if len(values) else 0
    width = next(k for k in (1, 2, 4, 8) if most < 256**k)
    planes = values.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T
    return struct.pack("<QB", len(values), width) + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpacked(data: bytes) -> np.ndarray:
    """What :func:`packed` was given."""
    n, width = struct.unpack_from("<QB", data)
    planes = np.frombuffer(pa.decompress(data[9:], n * width, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(width, n).T).view(f"<u{width}").reshape(n).astype(np.int64)


def csr(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct words of some texts, and the cells of the matrix with a row per text: places in row-major order, counts."""
    flat, offsets = split_words(texts, lower=False)
    coded = flat.dictionary_encode()
    owner = np.repeat(np.arange(len(texts), dtype=np.int64), np.diff(offsets))
    cells = owner * len(coded.dictionary) + coded.indices.to_numpy()
    return coded.dictionary, *np.unique(cells, return_counts=True)


def shards(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, part, digest, c, d, text) as CSR shards with local codes, a row per shard."""
    kind = pa.struct([("doc_id", pa.int64()), ("part", pa.string()), ("digest", pa.string()), ("c", pa.bool_()), ("d", pa.bool_())])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for k, batch in enumerate(chunks(batches, "text", SHARD_BYTES)):
            words, cells, counts = csr(batch.column("text"))
            rows = pa.StructArray.from_arrays([batch.column(name) for name in kind.names], fields=list(kind))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([(task << 32) + k], pa.int64()),
                    pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows),
                    pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words),
                    pa.array([packed(np.diff(cells, prepend=0))], pa.binary()),
                    pa.array([packed(counts)], pa.binary()),
                ],
                ["shard", "rows", "words", "gaps", "counts"],
            )

    return docs.select("doc_id", "part", "digest", "c", "d", "text").mapInArrow(build, SHARD)


def dictionary(stored: DataFrame) -> DataFrame:
    """shard, place, number: the global number of every word of every shard's dictionary."""
    words = stored.select("shard", F.posexplode("words").alias("place", "word"))
    bucket = F.pmod(F.xxhash64("word"), F.lit(BUCKETS))
    rank = F.dense_rank().over(Window.partitionBy(bucket).orderBy("word")).cast("long")
    # dealt by the expression, so that words travel without their buckets
    return words.repartition(bucket).select("shard", "place", ((rank - 1) * BUCKETS + bucket).alias("number"))


def document_terms(stored: DataFrame) -> DataFrame:
    """The matrix with global numbers: a row per shard with rows, starts, numbers and counts."""
    def renumber(left: pa.Table, right: pa.Table) -> pa.Table:
        place, number = (right.column(name).to_numpy() for name in ("place", "number"))
        numbers = np.empty(len(place), np.int64)
        numbers[place] = number
        gaps, counts = (unpacked(left.column(name)[0].as_py()) for name in ("gaps", "counts"))
        cells, size, n = np.cumsum(gaps), max(1, len(place)), len(left.column("rows")[0])
        starts = np.searchsorted(cells, np.arange(n + 1, dtype=np.int64) * size)
        return pa.table(
            [
                *(left.column(name) for name in ("shard", "rows")),
                pa.array([starts], pa.list_(pa.int32())),
                pa.array([numbers[cells % size]], pa.list_(pa.int64())),
                pa.array([counts], pa.list_(pa.int64())),
            ],
            ["shard", "rows", "starts", "numbers", "counts"],
        )

    heads = stored.drop("words").groupBy("shard")
    return heads.cogroup(dictionary(stored).groupBy("shard")).applyInArrow(renumber, MATRIX)


def word_counts(matrix: DataFrame) -> DataFrame:
    """The documents of :func:`document_terms` with row sum and nonzero count."""

    names = [*(part.split()[0] for part in DOCUMENT.split(", ")), "n_words", "n_distinct"]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                rows, starts, counts = (batch.column(name).slice(k, 1).flatten() for name in ("rows", "starts", "counts"))
                starts = starts.to_numpy()
                total = np.concatenate([[0], np.cumsum(counts.to_numpy(), dtype=np.int64)])
                facts = [pa.array(total[starts[1:]] - total[starts[:-1]]), pa.array(np.diff(starts), pa.int64())]
                yield pa.RecordBatch.from_arrays([*rows.flatten(), *facts], names)

    return matrix.select("rows", "starts", "counts").mapInArrow(sums, COUNTED)


def flagged(docs: DataFrame) -> DataFrame:
    """doc_id, part, n_words, n_distinct and fails (the letters of the filters a row fails, in order), for every row of ``docs``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    given = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("lang") if "lang" in docs.columns else F.lit(None), F.lit("")).alias("part"),
        F.sha2(text, 256).alias("digest"),
        (100 * F.length(F.regexp_replace(text, NO_CAPITAL, "")) > MOST_CAPITALS * F.length(text)).alias("c"),
        text.rlike(MARKS).alias("d"),
        text.alias("text"),
    )
    folder = shared_path(docs.sparkSession, "document-terms")
    shards(given).write.option("parquet.enable.dictionary", "false").parquet(folder)
    stored = docs.sparkSession.read.schema(SHARD).parquet(folder)
    twins = (
        stored.select(F.inline("rows")).groupBy("digest").agg(F.count("*").alias("n"), F.min("doc_id").alias("first"))
        .where(F.col("n") > 1).select("digest", "first")
    )
    rows = word_counts(document_terms(stored)).join(twins, "digest", "left")
    tests = {
        "A": F.col("n_words") < LEAST_WORDS,
        "B": 100 * F.col("n_distinct") < LEAST_VARIETY * F.col("n_words"),
        "C": F.col("c"),
        "D": F.col("d"),
        "E": F.col("doc_id") > F.col("first"),
    }
    fails = F.concat(*(F.when(test, letter).otherwise("") for letter, test in tests.items()))
    return rows.select("doc_id", "part", "n_words", "n_distinct", fails.alias("fails"))


def _marked(labels: DataFrame) -> DataFrame:
    """doc_id, good, toxic: a row per labelled doc_id."""
    return labels.groupBy("doc_id").agg(
        F.max(F.coalesce((F.col("quality") == 1).cast("int"), F.lit(0))).alias("good"),
        F.max(F.coalesce((F.col("toxic") == 1).cast("int"), F.lit(0))).alias("toxic"),
    )


def audited(flags: DataFrame, labels: DataFrame) -> DataFrame:
    """part, filter_order, step and the counts of the module, from part and fails of each document and its labels."""
    counts = (
        flags.join(_marked(labels), "doc_id", "left")
        .groupBy("part", "fails")
        .agg(
            F.count("*").alias("n"),
            F.sum(F.coalesce("good", F.lit(0))).alias("good"),
            F.sum(F.coalesce("toxic", F.lit(0))).alias("toxic"),
        )
    )
    orders = ["".join(order) for order in permutations(FILTERS)]
    steps = (
        counts.withColumn("filter_order", F.explode(F.array(*map(F.lit, orders))))
        # the failing filters in the order they come
        .withColumn("hits", F.expr(f"translate(filter_order, translate('{FILTERS}', fails, ''), '')"))
        .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    )
    letter = F.substring("filter_order", F.col("step"), F.lit(1))
    fails_here = F.contains("fails", letter)
    removed = F.startswith("hits", letter)
    kept = (F.col("hits") == "") | (F.instr("filter_order", F.left("hits", F.lit(1))) > F.col("step"))

    def total(which: Column, what: str = "n") -> Column:
        return F.sum(F.when(which, F.col(what)).otherwise(0))

    # of all orders, a failing filter comes first among the failing ones in one of as many as these are
    share = F.when(fails_here, F.col("n") * F.expr(f"{len(orders)} div length(fails)")).otherwise(0)
    return steps.groupBy("part", "filter_order", "step").agg(
        total(kept).alias("kept"),
        total(removed).alias("removed"),
        total(fails_here & ~removed).alias("redundant"),
        total(F.col("fails") == letter).alias("unique_fails"),
        total(removed, "good").alias("good_lost"),
        total(removed, "toxic").alias("toxic_lost"),
        F.sum(share).alias("shapley"),
    )


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of ``docs`` (doc_id, text, lang) with ``labels`` (doc_id, quality, toxic)."""
    return audited(flagged(docs), labels)
