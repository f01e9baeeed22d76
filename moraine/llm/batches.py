"""Texts of an Arrow batch as numpy arrays, in slices of bounded size."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE = 1 << 22
PIECE = 1 << 19  # bytes whose words and hashes a task holds at once; several times as much memory
LONG_SPAN = 64


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not (pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)):
        column = column.cast(pa.large_binary() if pa.types.is_binary(column.type) else pa.large_string())
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_large_binary(column.type) else "")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    body = np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]] if data is not None and len(at) else np.zeros(0, np.uint8)
    return body, at - at[0]


def slices(offsets: np.ndarray, most: int = SLICE) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``most`` bytes; a longer row is a range of its own."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + most, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, in place."""
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


# Random 64-bit value of each byte, and the base of the rolling sums.
BYTE = np.random.default_rng(20250301).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = {}


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, 1 << 16), base, dtype=np.uint64)
        have[0] = 1
        have = _powers[base] = np.cumprod(have, dtype=np.uint64)
    return have[:n]


def span_hashes(body: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes: from one running sum, and of spans over ``LONG_SPAN`` bytes
    from the bytes themselves, as regular texts of some length have equal sums whatever the base."""
    total = np.zeros(len(body) + 1, dtype=np.uint64)
    np.cumsum(BYTE[body] * _power(_BASE, len(body)), out=total[1:])
    out = (total[ends] - total[starts]) * _power(_INVERSE, len(body) + 1)[starts]
    out += (ends - starts).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    out = mix(out)
    for k in np.flatnonzero(ends - starts > LONG_SPAN):
        digest = hashlib.blake2b(body[starts[k] : ends[k]].tobytes(), digest_size=8).digest()
        out[k] = int.from_bytes(digest, "little")
    return out


def word_spans(body: np.ndarray, offsets: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, row) of the longest runs of ``member`` bytes; runs end with their row."""
    inside = member[body]
    before, after = np.empty_like(inside), np.empty_like(inside)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    if len(body):
        before[0] = after[-1] = False
        edges = offsets[1:-1]
        edges = edges[(edges > 0) & (edges < len(body))]
        before[edges] = False
        after[edges - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


# ASCII white space as the contracts name it, and A-Z lower-cased.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
