"""Words of whole texts as bytes, for Arrow functions.

Both word classes used here are defined on ASCII characters only, so they can be
cut from UTF-8 bytes: one table lookup per byte, then one split."""

from __future__ import annotations

import pyarrow as pa


def _table(keep) -> bytes:
    out = bytearray()
    for b in range(256):
        low = b + 32 if 65 <= b <= 90 else b
        out.append(low if keep(low) else 32)
    return bytes(out)


#: A-Z folded; every byte outside ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]`` becomes a space.
FOLD_WORDS = _table(lambda b: b >= 128 or 48 <= b <= 57 or 97 <= b <= 122)
#: A-Z folded; ASCII white space (\x09-\x0D) becomes a space.
FOLD_SPACE = _table(lambda b: not 9 <= b <= 13)

#: As FOLD_SPACE, but the newline stays.
FOLD_LINES = _table(lambda b: b == 10 or not 9 <= b <= 13)


def texts(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of each value (None for null)."""
    if pa.types.is_large_string(column.type):
        return column.cast(pa.large_binary()).to_pylist()
    return column.cast(pa.binary()).to_pylist()


def batches_by_bytes(values: list[bytes | None], limit: int = 4 << 20, most: int = 1 << 30):
    """(first, end) index pairs of neighbouring values, of about ``limit`` bytes and
    at most ``most`` values together; a longer value stands alone."""
    first = size = 0
    for i, v in enumerate(values):
        n = len(v or b"")
        if i > first and (size + n > limit or i - first == most):
            yield first, i
            first, size = i, 0
        size += n
    if first < len(values):
        yield first, len(values)
