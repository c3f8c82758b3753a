"""Words of whole texts as 64-bit numbers, computed on the bytes of an Arrow column.

A word is a run of bytes other than space and 0x09-0x0D, with A-Z lower-cased. Its
number is a polynomial over random byte values modulo 2**64, mixed with its length; two
different words meet with probability about 2**-60. Nothing here makes a Python object
per word. Texts are taken in slices, so that the working arrays stay small; a text that
is longer than a slice is cut between words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20
BASE = 0x9E3779B97F4A7C55
INVERSE = pow(BASE, -1, 1 << 64)
_random = np.random.default_rng(20240229)
BYTE_VALUES = _random.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SPACE = np.zeros(256, bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True
# For words of letters and digits only: every other ASCII byte parts words too.
NOT_ALNUM = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
LOWER_VALUES = BYTE_VALUES[LOWER]
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        steps = np.full(max(n, SLICE_BYTES + 4096), base, np.uint64)
        steps[0] = 1
        known = np.multiply.accumulate(steps)
        if n <= SLICE_BYTES + 4096:
            _powers[base] = known
    return known[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers, one to one."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    kind = np.int64 if wide else np.int32
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    bounds = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


def _slices(data: np.ndarray, offsets: np.ndarray, breaks: np.ndarray):
    """(byte start, byte end) of slices that end between texts or between words."""
    at, end = 0, int(offsets[-1])
    while at < end:
        to = at + SLICE_BYTES
        if to >= end:
            yield at, end
            return
        cut = int(offsets[np.searchsorted(offsets, to, "right") - 1])
        if cut > at:
            to = cut
        else:  # inside one long text
            while to < end and not breaks[data[to]] and to not in offsets:
                near = np.flatnonzero(breaks[data[to : to + 65536]])
                stop = int(offsets[np.searchsorted(offsets, to, "left")])
                to = min(stop, to + int(near[0]) if len(near) else to + 65536)
        yield at, to
        at = to


def word_spans(
    data: np.ndarray, offsets: np.ndarray, lo: int, hi: int, breaks: np.ndarray = SPACE
) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (relative to lo) of the words in data[lo:hi]; no word crosses a text."""
    space = breaks[data[lo:hi]]
    begins = ~space
    begins[1:] &= space[:-1]
    ends = ~space
    ends[:-1] &= space[1:]
    cuts = offsets[np.searchsorted(offsets, lo, "right") : np.searchsorted(offsets, hi, "left")] - lo
    cuts = cuts[(cuts > 0) & (cuts < hi - lo)]
    if len(cuts):
        begins[cuts] = ~space[cuts]
        ends[cuts - 1] = ~space[cuts - 1]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Numbers of the byte spans, given a random number for each byte."""
    n = len(values)
    sums = np.empty(n + 1, np.uint64)
    sums[0] = 0
    np.cumsum(values * powers(BASE, n), out=sums[1:])
    found = (sums[ends] - sums[starts]) * powers(INVERSE, n + 1)[starts]
    return mix(found + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def word_hashes(column: pa.Array, lower: bool = True, breaks: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """(number of every word, offsets by text): text i has words offsets[i]:offsets[i+1]."""
    data, offsets = buffers(column)
    values = LOWER_VALUES if lower else BYTE_VALUES
    parts, places = [], []
    for lo, hi in _slices(data, offsets, breaks):
        starts, ends = word_spans(data, offsets, lo, hi, breaks)
        parts.append(span_hashes(values[data[lo:hi]], starts, ends))
        places.append(starts + lo)
    hashes = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    at = np.concatenate(places) if places else np.zeros(0, np.int64)
    return hashes, np.searchsorted(at, offsets, "left")


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Numbers of the runs of `size` words of one text; a shorter text is one run."""
    n = len(words)
    if n == 0:
        return words
    width = min(size, n)
    weights = powers(0xC2B2AE3D27D4EB4F, size + 1)
    found = np.zeros(n - width + 1, np.uint64)
    for j in range(width):
        found += words[j : n - width + 1 + j] * weights[j]
    return mix(found + np.uint64(width))
