"""Fill-in-the-middle texts by rotating blocks in place, and back.

A text of n code points is cut at two of them into prefix, middle and suffix. Its UTF-8 bytes stay in one bytearray throughout: the
cuts are found by a scan for the bytes that start a code point, sentinels are inserted at the cuts, and neighbouring blocks change places by
the three-reversal rotation (each block reversed, then both together), in slices of ``STEP`` bytes, so that no second copy
of the text is made. :func:`restored` finds the sentinels, undoes the rotation by the same three reversals and cuts the sentinels out.

    plain  the text itself
    psm    <P>prefix<S>suffix<M>middle
    spm    <S>suffix<P>prefix<M>middle

Form and cuts come from the SHA-256 of ``1:`` and the decimal doc_id, so that a row always gives the same result, wherever and
however often its task runs. A text that is empty or holds a sentinel stays plain: in every other output each sentinel stands
once, since none of them can overlap another, and :func:`restored` needs nothing but output and form.

Defined results: a null text is empty and therefore plain; a null doc_id counts as an empty number. Equal rows give equal rows. An empty table
gives no rows. Columns of the input that bear the name of a result column are replaced, others stay. Bytes that aren't valid
UTF-8 are moved as they are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from recurra.llm.shared import widened
from recurra.llm.words import chunks

# The sentinels of prefix, suffix and middle, and the shares of the forms in percent.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
TRANSFORMED, SUFFIX_FIRST = 90, 20
# End of fixed values.
PLAIN, PSM, SPM = "plain", "psm", "spm"
STEP = 1 << 16

TRANSFORMED_COLUMNS = "n long, form string, prefix_chars long, middle_chars long, output string"
RESTORED_COLUMNS = "restored string"


def reverse(buffer: bytearray, start: int, end: int) -> None:
    """Reverses ``buffer[start:end]`` in place, exchanging slices of ``STEP`` bytes from both ends."""
    view = np.frombuffer(buffer, np.uint8)
    while end - start > 1:
        size = min(STEP, (end - start) // 2)
        head = view[start : start + size].copy()
        view[start : start + size] = view[end - size : end][::-1]
        view[end - size : end] = head[::-1]
        start, end = start + size, end - size


def rotate(buffer: bytearray, start: int, middle: int, end: int) -> None:
    """Exchanges the blocks ``[start, middle)`` and ``[middle, end)`` of ``buffer``."""
    reverse(buffer, start, middle)
    reverse(buffer, middle, end)
    reverse(buffer, start, end)


def draws(doc_id: int | None) -> tuple[int, int, int, int]:
    """The four numbers that decide cuts and form of a document."""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(digest[k : k + 4], "big") for k in (0, 4, 8, 12))


def _blocks(buffer: bytearray) -> np.ndarray:
    """How many code points start in each slice of ``STEP`` bytes."""
    view = np.frombuffer(buffer, np.uint8) if buffer else np.zeros(0, np.uint8)
    return np.array([np.count_nonzero((view[k : k + STEP] & 0xC0) != 0x80) for k in range(0, len(view), STEP)], np.int64)


def _place(buffer: bytearray, before: np.ndarray, cut: int) -> int:
    """The byte at which code point number ``cut`` starts; ``before`` holds the code points up to the end of each slice."""
    if cut >= before[-1]:
        return len(buffer)
    k = int(np.searchsorted(before, cut, side="right"))
    view = np.frombuffer(buffer, np.uint8)[k * STEP : (k + 1) * STEP]
    return k * STEP + int(np.flatnonzero((view & 0xC0) != 0x80)[cut - (before[k - 1] if k else 0)])


def transform(buffer: bytearray, doc_id: int | None) -> tuple[int, str, int | None, int | None]:
    """Turns the text in ``buffer`` into its output; returns code points, form, and those of prefix and middle."""
    before = np.cumsum(_blocks(buffer))
    n = int(before[-1]) if len(before) else 0
    h1, h2, h3, h4 = draws(doc_id)
    if not n or h3 % 100 >= TRANSFORMED or any(mark in buffer for mark in (PREFIX, SUFFIX, MIDDLE)):
        return n, PLAIN, None, None
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = _place(buffer, before, first), _place(buffer, before, second)
    buffer[b:b] = SUFFIX
    buffer[a:a] = MIDDLE
    buffer[0:0] = PREFIX
    a, b = a + len(PREFIX), b + len(PREFIX) + len(MIDDLE)  # now prefix, middle, suffix, each behind its sentinel
    if h4 % 100 < SUFFIX_FIRST:
        rotate(buffer, 0, b, len(buffer))
        return n, SPM, first, second - first
    rotate(buffer, a, b, len(buffer))
    return n, PSM, first, second - first


def restore(buffer: bytearray, form: str) -> None:
    """Turns the output in ``buffer`` back into its text."""
    if form == PLAIN:
        return
    if form == PSM:
        rotate(buffer, buffer.index(SUFFIX), buffer.index(MIDDLE), len(buffer))
    elif form == SPM:
        rotate(buffer, 0, buffer.index(PREFIX), len(buffer))
    else:
        raise ValueError(f"unknown form {form!r}")
    for mark in (SUFFIX, MIDDLE, PREFIX):  # from the back, so that no place shifts before it is used
        at = buffer.index(mark)
        del buffer[at : at + len(mark)]


def _buffers(column: pa.Array) -> Iterator[bytearray]:
    """The bytes of each text, one at a time."""
    for value in column.cast(pa.binary()):
        yield bytearray(value.as_py() or b"")


def _texts(values: list[bytearray]) -> pa.Array:
    return pa.array(values, pa.binary()).cast(pa.string(), safe=False)


def _mapped(rows: DataFrame, text: str, ddl: str, made: Callable[[pa.RecordBatch], list[pa.Array]]) -> DataFrame:
    """``rows`` with the columns of ``ddl``, which ``made`` returns for every batch; those of the same names are replaced."""
    added = [part.split()[0] for part in ddl.split(", ")]
    rest = [name for name in rows.columns if name not in added]
    schema = widened(rows.select(*(f"`{name}`" for name in rest)), ddl)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, text):
            yield pa.RecordBatch.from_arrays([*(batch.column(name) for name in rest), *made(batch)], [*rest, *added])

    needed = dict.fromkeys([*rest, *(name for name in (text, "form") if name in rows.columns)])
    return rows.select(*(f"`{name}`" for name in needed)).mapInArrow(add, schema)


def transformed(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text and any others) with n, form, prefix_chars, middle_chars and output."""

    def made(batch: pa.RecordBatch) -> list[pa.Array]:
        facts, outputs = [], []
        for doc_id, buffer in zip(batch.column("doc_id").to_pylist(), _buffers(batch.column("text"))):
            facts.append(transform(buffer, doc_id))
            outputs.append(buffer)
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64())
        return [*(pa.array(column, kind) for column, kind in zip(zip(*facts), kinds)), _texts(outputs)]

    return _mapped(docs, "text", TRANSFORMED_COLUMNS, made)


def restored(rows: DataFrame) -> DataFrame:
    """``rows`` (output, form and any others) with the text rebuilt from these two alone."""

    def made(batch: pa.RecordBatch) -> list[pa.Array]:
        texts = []
        for form, buffer in zip(batch.column("form").to_pylist(), _buffers(batch.column("output"))):
            restore(buffer, form)
            texts.append(buffer)
        return [_texts(texts)]

    return _mapped(rows, "output", RESTORED_COLUMNS, made)
