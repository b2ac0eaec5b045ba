"""Identifier rendering."""

from __future__ import annotations


def padded_id(prefix: str, key: str, width: int = 10) -> str:
    """SQL text of ``prefix`` plus the key with leading zeros.

    A bare ``lpad`` cuts keys wider than ``width``, which would merge them;
    here they are kept whole.
    """
    digits = f"CAST({key} AS STRING)"
    return f"concat('{prefix}', lpad({digits}, greatest(length({digits}), {width}), '0'))"
