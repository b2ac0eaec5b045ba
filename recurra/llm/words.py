"""Whole texts as columns of words, in Arrow and numpy, inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 2_000_000


def chunks(batches: Iterator[pa.RecordBatch], text: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of about ``limit`` bytes of text, so that memory follows bytes, not rows."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(size, dtype=np.int64) // limit
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for start, end in zip(cuts, cuts[1:]):
            if end > start:
                yield batch.slice(start, end - start)


def split_words(texts: pa.Array, lower: bool = True) -> tuple[pa.Array, np.ndarray]:
    """All words of all texts in one column, and the n + 1 offsets of the texts in it.

    Words are the maximal runs without ASCII white space; A-Z are lower-cased on request. A null
    text counts as empty, and an empty text has no words.
    """
    texts = pc.fill_null(texts, "")
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts)
    flat = lists.flatten()
    counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    empty = pc.equal(flat, "").to_numpy(zero_copy_only=False)
    if empty.any():
        owner = np.repeat(np.arange(len(counts)), counts)
        counts = np.bincount(owner[~empty], minlength=len(counts))
        flat = flat.filter(pa.array(~empty))
    return flat, np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])


def numbered(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The index of every word among the distinct words, and the distinct words as objects."""
    coded = words.dictionary_encode()
    return coded.indices.to_numpy(), coded.dictionary.to_numpy(zero_copy_only=False)


def word_hashes(distinct: np.ndarray) -> np.ndarray:
    """A 64-bit hash (SipHash) of each word, the same in every process."""
    if not len(distinct):
        return np.zeros(0, np.uint64)
    return pd.util.hash_array(distinct, categorize=False)


def mixed(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: every bit of the input reaches every bit of the output."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Odd multipliers that tell the places of a shingle apart.
PLACES = mixed(np.arange(1, 65, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def shingle_hashes(hashes: np.ndarray, offsets: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its ``width``-word shingles, as signed 64-bit.

    A text of fewer words gives its whole word sequence as one shingle; one without words gives none.
    """
    total = np.zeros(max(0, len(hashes) - width + 1), np.uint64)
    for k in range(width):
        total += hashes[k : k + len(total)] * PLACES[k]
    total = mixed(total).view(np.int64)
    for start, end in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        if end - start >= width:
            yield np.unique(total[start : end - width + 1])
        elif end > start:
            whole = (hashes[start:end] * PLACES[: end - start]).sum(dtype=np.uint64) + np.uint64(end - start)
            yield mixed(np.array([whole], np.uint64)).view(np.int64)
        else:
            yield np.zeros(0, np.int64)
