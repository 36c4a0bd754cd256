"""Golomb code (with a power of two as divisor) of sorted distinct numbers."""

from __future__ import annotations

import numpy as np


def encode(values: np.ndarray, span_bits: int) -> tuple[int, bytes, bytes]:
    """Code of sorted distinct unsigned 64-bit numbers below ``2 ** span_bits``.

    The gaps between neighbours are written as a quotient in unary and a remainder
    of ``width`` bits; the width follows the mean gap. Returns the width, the
    quotients and the remainders.
    """
    n = len(values)
    if n == 0:
        return 0, b"", b""
    width = max(0, min(63, span_bits - n.bit_length()))
    gaps = np.diff(values, prepend=np.uint64(0))
    quotients = (gaps >> np.uint64(width)).astype(np.int64)
    ends = np.cumsum(quotients + 1)
    unary = np.zeros(int(ends[-1]), dtype=np.uint8)
    unary[ends - 1] = 1
    rest = (gaps & np.uint64((1 << width) - 1)).astype(">u8").view(np.uint8).reshape(n, 8)
    bits = np.unpackbits(rest, axis=1)[:, 64 - width:]
    return width, np.packbits(unary).tobytes(), np.packbits(bits).tobytes()


def decode(n: int, width: int, unary: bytes, rest: bytes) -> np.ndarray:
    """The numbers again."""
    if n == 0:
        return np.zeros(0, dtype=np.uint64)
    ends = np.flatnonzero(np.unpackbits(np.frombuffer(unary, np.uint8)))[:n]
    quotients = np.diff(ends, prepend=-1) - 1
    bits = np.zeros((n, 64), dtype=np.uint8)
    if width:
        bits[:, 64 - width:] = np.unpackbits(np.frombuffer(rest, np.uint8))[: n * width].reshape(n, width)
    low = np.packbits(bits, axis=1).view(">u8").ravel().astype(np.uint64)
    return np.cumsum((quotients.astype(np.uint64) << np.uint64(width)) + low, dtype=np.uint64)
