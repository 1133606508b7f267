"""Whole texts as numpy arrays: word bounds, rolling hashes and sliding minima over a batch."""

from __future__ import annotations

import ctypes
import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BATCH_BYTES = 1 << 20  # texts are taken in batches of about this size; a longer text is its own batch
SPACE = np.ones(256, bool)  # bytes of words that end at ASCII white space
SPACE[[9, 10, 11, 12, 13, 32]] = False
ALNUM = np.zeros(256, bool)  # digits, lower-case letters and every byte of a non-ASCII character
ALNUM[48:58] = ALNUM[97:123] = ALNUM[128:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_BASE = np.uint64(0x9E3779B97F4A7C55)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_PRIME = np.uint64((1 << 61) - 1)
_HALF = np.uint64((1 << 31) - 1)
_EXACT_BASE = 0x0A3C59AC2B7F1E4D


def batches(column: pa.Array, limit: int = BATCH_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, texts as UTF-8) in runs of about ``limit`` bytes; a null text is empty."""
    texts = column.cast(pa.large_binary()).to_pylist()
    first, size = 0, 0
    for i, text in enumerate(texts):
        if text is None:
            texts[i] = text = b""
        if size and size + len(text) > limit:
            yield first, texts[first:i]
            first, size = i, 0
        size += len(text) + 1
    if first < len(texts):
        yield first, texts[first:]


def joined(texts: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """One buffer with a line feed after each text, as bytes and array, and where texts start and end."""
    raw = b"\n".join(texts) + b"\n"
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(lengths + 1) - 1
    return raw, np.frombuffer(raw, np.uint8), ends - lengths, ends


def word_bounds(data: np.ndarray, kind: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of maximal runs of word bytes; ``data`` must end in a byte of no word."""
    inside = kind[data]
    edge = np.empty(len(data), bool)
    edge[:1] = inside[:1]
    np.not_equal(inside[1:], inside[:-1], out=edge[1:])
    at = np.flatnonzero(edge)
    return at[0::2], at[1::2]


def worker_cache() -> dict:
    """What a Python worker keeps from task to task."""
    return vars(sys.modules.setdefault("_feldspark_worker", types.ModuleType("_feldspark_worker")))


def release() -> None:
    """Give freed memory back to the system, as a worker stays for the tasks of later stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def _powers(size: int, base: np.uint64) -> np.ndarray:
    held = worker_cache()
    key = f"powers{base}"
    if key not in held or len(held[key]) < size:
        out = np.full(size, base)
        out[0] = 1
        held[key] = np.multiply.accumulate(out)
    return held[key]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse, for positions below ``n``."""
    size = max(1 << 16, 1 << int(n).bit_length())
    return _powers(size, _BASE), _powers(size, _INVERSE)


def prefix_hash(values: np.ndarray) -> np.ndarray:
    """Prefix sums from which the hash of any slice follows; entry i covers values before i."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * powers(len(values))[0][: len(values)], out=out[1:])
    return out


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xA0761D6478BD642F)
    h ^= h >> np.uint64(32)
    return h


def slice_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the slices; equal slices have equal hashes wherever they stand."""
    return mix((prefix[ends] - prefix[starts]) * powers(len(prefix))[1][starts])


def _fold(x: np.ndarray) -> np.ndarray:
    x = (x & _PRIME) + (x >> np.uint64(61))
    return np.where(x >= _PRIME, x - _PRIME, x)


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of numbers below 2**61 - 1, modulo 2**61 - 1, from halves of 30 and 31 bits."""
    one, half = np.uint64(31), np.uint64(30)
    a1, a0, b1, b0 = a >> one, a & _HALF, b >> one, b & _HALF
    mid = a1 * b0 + a0 * b1
    return _fold((a1 * b1 << np.uint64(1)) + (mid >> half) + ((mid & np.uint64((1 << 30) - 1)) << one) + a0 * b0)


def _exact_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    held = worker_cache()
    size = max(1 << 16, 1 << int(n).bit_length())
    if "exact powers" not in held or len(held["exact powers"][0]) < size:
        out = []
        for base in (_EXACT_BASE, pow(_EXACT_BASE, -1, int(_PRIME))):
            table = np.ones(1, np.uint64)
            while len(table) < size:
                table = np.append(table, _times(table, np.full(1, pow(base, len(table), int(_PRIME)), np.uint64)))
            out.append(table)
        held["exact powers"] = tuple(out)
    return held["exact powers"]


def exact_prefix(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As ``prefix_hash``, modulo a prime, for hashes that stand for their slices: two sums of half products.

    Modulo a power of two, whatever the base, there are short words of two letters with equal hashes.
    """
    n = len(values)
    up = _exact_powers(n)[0][:n]
    high, low = np.zeros(n + 1, np.uint64), np.zeros(n + 1, np.uint64)
    if values.dtype == np.uint8 and n <= 1 << 24:  # sums of small factors fit as they are
        v = values.astype(np.uint64) + np.uint64(1)
        np.cumsum(v * (up >> np.uint64(31)), out=high[1:])
        np.cumsum(v * (up & _HALF), out=low[1:])
    else:
        x = _times(_fold(_fold(values.astype(np.uint64)) + np.uint64(1)), up)
        np.cumsum(x >> np.uint64(31), out=high[1:])
        np.cumsum(x & _HALF, out=low[1:])
    return high, low


def exact_hash(prefix: tuple[np.ndarray, np.ndarray], starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """61-bit hashes, spread over 64 bits, of the slices of an ``exact_prefix``."""
    high, low = (p[ends] - p[starts] for p in prefix)
    whole = _fold(_times(_fold(high), np.full(1, 1 << 31, np.uint64)) + _fold(low))
    return mix(_times(whole, _exact_powers(len(prefix[0]))[1][starts]))


def window_hash(values: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` consecutive values."""
    n = len(values) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    prefix = prefix_hash(values)
    return mix((prefix[size:] - prefix[:n]) * powers(len(prefix))[1][:n])


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` consecutive values."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


def counts_by(bounds_start: np.ndarray, bounds_end: np.ndarray, sorted_at: np.ndarray) -> np.ndarray:
    """How many of the sorted positions fall in each [start, end)."""
    return np.searchsorted(sorted_at, bounds_end) - np.searchsorted(sorted_at, bounds_start)


def covered(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which of n places lie in any [start, end)."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, ends, -1)
    return np.cumsum(step[:n]) > 0


def repeated(keys: np.ndarray) -> np.ndarray:
    """Which keys occur twice or more."""
    ordered = np.sort(keys)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return np.zeros(len(keys), bool)
    at = np.searchsorted(twice, keys)
    at[at == len(twice)] = 0
    return twice[at] == keys
