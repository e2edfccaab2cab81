"""Golomb-Rice coding of sorted hashes: quotients in unary, remainders in a fixed number of bits."""

from __future__ import annotations

import struct

import numpy as np


def encode(hashes: np.ndarray) -> bytes:
    """Sorted distinct uint64; the remainder width follows the mean gap."""
    n = len(hashes)
    if not n:
        return struct.pack("<IBQ", 0, 0, 0)
    gaps = np.diff(hashes)
    mean = (int(hashes[-1]) - int(hashes[0])) // max(1, n - 1)
    bits = max(0, int(mean * 0.69).bit_length() - 1)
    head = struct.pack("<IBQ", n, bits, int(hashes[0]))
    stops = np.cumsum((gaps >> np.uint64(bits)).astype(np.int64) + 1) - 1
    unary = np.zeros(int(stops[-1]) + 1 if n > 1 else 0, np.uint8)
    unary[stops] = 1
    rest = np.unpackbits(gaps.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)[:, 64 - bits :]
    first = np.packbits(unary).tobytes()
    return head + struct.pack("<I", len(first)) + first + np.packbits(rest.ravel()).tobytes()


def decode(blob: bytes) -> np.ndarray:
    n, bits, start = struct.unpack_from("<IBQ", blob)
    if n < 2:
        return np.full(n, start, np.uint64)
    (size,) = struct.unpack_from("<I", blob, 13)
    stops = np.flatnonzero(np.unpackbits(np.frombuffer(blob, np.uint8, size, 17)))[: n - 1]
    quotients = np.diff(stops, prepend=-1) - 1
    packed = np.unpackbits(np.frombuffer(blob, np.uint8, offset=17 + size))[: (n - 1) * bits]
    wide = np.zeros((n - 1, 64), np.uint8)
    wide[:, 64 - bits :] = packed.reshape(n - 1, bits)
    gaps = np.packbits(wide, axis=1).view(">u8").ravel().astype(np.uint64)
    gaps += quotients.astype(np.uint64) << np.uint64(bits)
    return np.cumsum(np.concatenate([np.array([start], np.uint64), gaps]), dtype=np.uint64)
