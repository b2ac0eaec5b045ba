"""Byte-level BPE encoding and decoding by a rank queue over linked-list positions.

A pre-token starts as its bytes in a doubly linked list; the new pre-tokens of a batch share one. Every adjacent pair that has a rank
stands in the bucket of that rank, by the position of its left part. A bitmap of three levels with 64 bits a word marks the buckets
that aren't empty, so the next rank is three find-first-set steps away, however long the list is. A bucket is taken from left to
right, unless a merge opens a lower one, which goes first; an entry whose position is gone, or whose pair has changed meanwhile, is
stale and skipped. A merge adds at most two entries, so a list of n bytes takes O(n) steps besides the heaps of its buckets.

Pre-tokens repeat, so a task remembers the ids of short ones, in a table that is emptied when it is full. The table ends with its task:
the worker process goes on to other stages, which would hold it in memory beside their own. Texts are split, encoded, joined and
decoded whole. Ranks are read on the driver and sent once; the file is of fixed size.

Defined results: a null text is empty; an empty text has no tokens. Characters that UTF-8 can't hold don't occur in Spark strings.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from heapq import heappop, heappush
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recurra.llm.shared import widened
from recurra.llm.words import chunks

REMEMBERED = 400_000
REMEMBERED_CHARS = 64
MERGED_BYTES = 1 << 16

Ranks = dict[bytes, int]


def read_ranks(path: str) -> Ranks:
    """Token bytes and ranks from lines of base64 text and rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class RankQueue:
    """The non-empty buckets by rank: a bit for each rank, for each 64 ranks and for each 4096 ranks. A bucket is a heap of positions."""

    def __init__(self, size: int):
        self.words = [0] * ((size >> 6) + 1)
        self.pages = [0] * ((size >> 12) + 1)
        self.top = 0
        self.buckets: dict[int, list[int]] = {}

    def open(self, rank: int, positions: list[int]) -> None:
        """Sets up the bucket of a rank that has none, from ascending positions."""
        self.buckets[rank] = positions
        word, page = rank >> 6, rank >> 12
        if not self.words[word]:
            self.pages[page] |= 1 << (word & 63)
            self.top |= 1 << page
        self.words[word] |= 1 << (rank & 63)

    def lowest(self) -> int:
        """The lowest rank that has a bucket, by three find-first-set steps."""
        page = (self.top & -self.top).bit_length() - 1
        bits = self.pages[page]
        word = (page << 6) + (bits & -bits).bit_length() - 1
        bits = self.words[word]
        return (word << 6) + (bits & -bits).bit_length() - 1

    def close(self, rank: int) -> None:
        """Takes an emptied bucket out of the bitmap."""
        del self.buckets[rank]
        word, page = rank >> 6, rank >> 12
        self.words[word] ^= 1 << (rank & 63)
        if not self.words[word]:
            self.pages[page] ^= 1 << (word & 63)
            if not self.pages[page]:
                self.top ^= 1 << page


class Codec:
    """Encodes and decodes whole texts; remembers the ids of short pre-tokens."""

    def __init__(self, ranks: Ranks, pattern: str):
        self.ranks = ranks
        self.find = regex.compile(pattern).findall
        self.queue = RankQueue(max(ranks.values()) + 1)
        self.bytes_of = [b""] * (max(ranks.values()) + 1)
        self.single, self.double = np.full(1 << 8, -1), np.full(1 << 16, -1)
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
            if len(token) == 1:
                self.single[token[0]] = rank
            elif len(token) == 2:
                self.double[token[0] << 8 | token[1]] = rank
        self.text_of = list(map(str, range(len(self.bytes_of))))
        self.memory: dict[str, tuple[int, ...]] = {}

    def _merged(self, tokens: list[bytes]) -> list[tuple[int, ...]]:
        """The ids of pre-tokens that lie one behind the other in one linked list; the queue is empty before and after.

        A pair never reaches over the start of a pre-token, so one bucket serves all pre-tokens that have its rank.
        """
        data, rank_of, queue = b"".join(tokens), self.ranks.get, self.queue
        n, buckets = len(data), queue.buckets
        starts = [0, *accumulate(map(len, tokens))]
        first = bytearray(n + 1)
        for start in starts:
            first[start] = 1
        points = np.frombuffer(data, np.uint8).astype(np.int64)
        pairs = np.full(n, -1)
        pairs[:-1] = np.where(np.frombuffer(first, np.uint8)[1:n], -1, self.double[points[:-1] << 8 | points[1:]])
        own, current = self.single[points].tolist(), pairs.tolist()
        order = np.argsort(pairs, kind="stable")
        order = order[np.searchsorted(pairs[order], 0) :]
        there, cuts = np.unique(pairs[order], return_index=True)
        order = order.tolist()
        for rank, start, end in zip(there.tolist(), cuts.tolist(), [*cuts[1:].tolist(), len(order)]):
            queue.open(rank, order[start:end])
        # a part lies at the position of its first byte; ``after`` is where it ends and the next one begins
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while queue.top:
            rank = queue.lowest()
            bucket = buckets[rank]
            while bucket:
                i = heappop(bucket)
                if current[i] != rank:
                    continue
                j = after[i]
                k = after[i] = after[j]
                own[i], own[j], current[j] = rank, -1, -1
                least = rank
                if first[k]:
                    current[i] = -1
                else:
                    before[k] = i
                    current[i] = new = rank_of(data[i : after[k]], -1)
                    if new >= 0:
                        if new in buckets:
                            heappush(buckets[new], i)
                        else:
                            queue.open(new, [i])
                        if new < least:
                            least = new
                if not first[i]:
                    h = before[i]
                    current[h] = new = rank_of(data[h:k], -1)
                    if new >= 0:
                        if new in buckets:
                            heappush(buckets[new], h)
                        else:
                            queue.open(new, [h])
                        if new < least:
                            least = new
                if least < rank:
                    break
            else:
                queue.close(rank)
        return [tuple([x for x in own[a:b] if x >= 0]) for a, b in zip(starts, starts[1:])]

    def _learn(self, parts: list[str]) -> None:
        """Puts the ids of distinct pre-tokens into the memory."""
        memory, rank_of, some, size = self.memory, self.ranks.get, {}, 0
        for part in parts:
            token = part.encode("utf-8")
            rank = rank_of(token)
            if rank is not None:
                memory[part] = (rank,)
                continue
            some[part] = token
            size += len(token)
            if size >= MERGED_BYTES:
                memory.update(zip(some, self._merged(list(some.values()))))
                some, size = {}, 0
        if some:
            memory.update(zip(some, self._merged(list(some.values()))))

    def encode_all(self, texts: list[str]) -> list[list[int]]:
        """The ids of each text; pre-tokens that aren't remembered are merged together."""
        memory, parts = self.memory, list(map(self.find, texts))
        distinct = set().union(*parts)
        unknown = distinct.difference(memory)
        if len(memory) + len(unknown) > REMEMBERED:
            memory.clear()
            unknown = distinct
        self._learn(list(unknown))
        ids = [list(chain.from_iterable(map(memory.__getitem__, found))) for found in parts]
        for part in unknown:
            if len(part) > REMEMBERED_CHARS:
                del memory[part]
        if len(memory) > REMEMBERED:
            memory.clear()
        return ids

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[0]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def decimal(self, ids: list[int]) -> str:
        return " ".join(map(self.text_of.__getitem__, ids))


def shared_ranks(spark: SparkSession, path: str, pattern: str) -> Broadcast:
    """Ranks and pattern for :func:`encoded` and :func:`decoded`; a vocabulary file has a fixed size."""
    return spark.sparkContext.broadcast((read_ranks(path), pattern))


def encoded(docs: DataFrame, shared: Broadcast, text: str = "text", into: str = "ids") -> DataFrame:
    """``docs`` with the token ids of each whole text in the column ``into`` (array of int)."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(*shared.value)
        for batch in chunks(batches, text):
            ids = codec.encode_all([value or "" for value in batch.column(text).to_pylist()])
            yield batch.append_column(into, pa.array(ids, pa.list_(pa.int32())))

    rest = docs.drop(into)
    return rest.mapInArrow(encode, widened(rest, f"{into} array<int>"))


def decoded(docs: DataFrame, shared: Broadcast, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """``docs`` with the bytes of each id list in the column ``into`` (null where the list is null)."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(*shared.value)
        for batch in batches:
            found = [None if row is None else codec.decode(row) for row in batch.column(ids).to_pylist()]
            yield batch.append_column(into, pa.array(found, pa.binary()))

    rest = docs.drop(into)
    return rest.mapInArrow(decode, widened(rest, f"{into} binary"))


def tokenised(docs: DataFrame, shared: Broadcast) -> DataFrame:
    """``docs`` with n_tokens, ids and exact (whether the ids decode to the text), in one pass over the texts."""
    rest = docs.drop("n_tokens", "ids", "exact")

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(*shared.value)
        for batch in chunks(batches, "text"):
            texts = [value.as_py() or "" for value in batch.column("text")]
            ids = codec.encode_all(texts)
            exact = [codec.decode(row) == text.encode("utf-8") for row, text in zip(ids, texts)]
            columns = [pa.array(list(map(len, ids)), pa.int64()), pa.array(ids, pa.list_(pa.int32())), pa.array(exact)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, "n_tokens", "ids", "exact"])

    return rest.mapInArrow(tokenise, widened(rest, "n_tokens long, ids array<int>, exact boolean"))


def digests(docs: DataFrame, shared: Broadcast) -> DataFrame:
    """doc_id, n_tokens, and the SHA-256 of the ids and of the bytes decoded from them, in one pass over the texts."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(*shared.value)
        for batch in chunks(batches, "text"):
            counts, of_ids, of_bytes = [], [], []
            for ids in codec.encode_all([value or "" for value in batch.column("text").to_pylist()]):
                counts.append(len(ids))
                of_ids.append(hashlib.sha256(codec.decimal(ids).encode()).hexdigest())
                of_bytes.append(hashlib.sha256(codec.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(of_ids), pa.array(of_bytes)],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(digest, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
