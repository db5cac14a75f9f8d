"""Vectorised handling of batches of texts inside a task (numpy only, no Spark)."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

#: Texts are handled in slices of about this many bytes, so a task's memory does not
#: depend on how many rows an Arrow batch holds.
SLICE_BYTES = 1 << 20

_U = np.uint64
_CACHED = 1 << 15  # values that run_hashes works on at a time: they stay in the CPU cache


def mix(x: np.ndarray) -> np.ndarray:
    """Invertible mixing of 64-bit values: every input bit reaches every output bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _mixed(x: np.ndarray) -> np.ndarray:
    """:func:`mix` in place."""
    y = x >> _U(30)
    x ^= y
    x *= _U(0xBF58476D1CE4E5B9)
    np.right_shift(x, _U(27), out=y)
    x ^= y
    x *= _U(0x94D049BB133111EB)
    np.right_shift(x, _U(31), out=y)
    x ^= y
    return x


def release() -> None:
    """Give back the memory that a task leaves behind in its worker, which later tasks of
    other operators share."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def run_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of ``values[start:end]`` for every run; equal content, equal hash
    whatever the position. Runs must ascend, values be below 2**32. Every value is mixed
    with its place in the run before the sum is taken, so that no pattern of values (as in
    a sum of powers modulo 2**64) cancels out. Lengths enter the hash."""
    length = ends - starts
    sums = np.zeros(len(starts), _U)
    total = np.r_[0, np.cumsum(length)]
    at = 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(total, total[at] + _CACHED, "right")) - 1)
        if to == at + 1:  # perhaps a very long run
            parts = [np.zeros(1, _U)]
            for a in range(int(starts[at]), int(ends[at]), SLICE_BYTES):
                part = values[a:min(a + SLICE_BYTES, int(ends[at]))].astype(_U)
                parts.append(mix(part << _U(32) | np.arange(a - starts[at], a - starts[at] + len(part), dtype=_U)))
            sums[at:to] = sum(p.sum(dtype=_U, keepdims=True) for p in parts)
        else:
            n = length[at:to]
            first = total[at:to] - total[at]
            place = np.arange(total[to] - total[at]) - np.repeat(first, n)
            x = values[place + np.repeat(starts[at:to], n)].astype(_U)
            x <<= _U(32)
            x |= place.view(_U)
            run = np.empty(len(x) + 1, _U)
            run[0] = 0
            np.cumsum(_mixed(x), out=run[1:])
            sums[at:to] = run[first + n] - run[first]
        at = to
    return mix(sums + length.astype(_U) * _U(0xA0761D6478BD642F))


def text_bytes(texts: Sequence[str | None]) -> list[bytes]:
    """UTF-8 bytes of each text; null is empty."""
    return [t.encode("utf-8", "surrogatepass") if t is not None else b"" for t in texts]


def slices(texts: Sequence[str | None], limit: int = SLICE_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """Consecutive (first index, byte texts) groups of about ``limit`` bytes."""
    first, held, size = 0, [], 0
    for i, b in enumerate(text_bytes(texts)):
        if held and size + len(b) > limit:
            yield first, held
            first, held, size = i, [], 0
        held.append(b)
        size += len(b) + 1
    if held:
        yield first, held


def joined(parts: Sequence[bytes], sep: bytes = b" ") -> tuple[np.ndarray, np.ndarray]:
    """One byte array of all parts, each preceded and the last followed by ``sep``, and
    the start of every part in it."""
    buf = np.frombuffer(sep + sep.join(parts) + sep, np.uint8)
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    return buf, np.cumsum(lengths + 1) - lengths


def words(buf: np.ndarray, word_byte: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of word bytes; ``buf`` must begin and end
    with a byte that is none."""
    edges = np.flatnonzero(np.diff(word_byte[buf].view(np.int8))) + 1
    return edges[::2], edges[1::2]


def ascii_lower() -> np.ndarray:
    """Byte table that lowers A-Z only."""
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    return t


def expand(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of all elements of the runs ``start .. start+length``, run after run."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.cumsum(lengths) - lengths
    return np.arange(total) + np.repeat(starts - before, lengths)


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of half-open intervals as maximal, ascending, disjoint intervals."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    s, e = starts[order], np.maximum.accumulate(ends[order])
    new = np.flatnonzero(np.r_[True, s[1:] > e[:-1]])
    return s[new], e[np.r_[new[1:] - 1, len(e) - 1]]
