"""Splitting texts into the pieces that a tokenizer encodes one by one, in bulk.

The public vocabularies split a text by a pattern of letter runs, digits, other runs and
English contractions. Inside the code-point ranges of ``_LATIN`` the pattern's outcome
follows from the class of each character and its neighbours, so a whole batch is split
with array operations; a text with any other character goes through the pattern itself.
Distinct pieces are encoded once per worker process and looked up by a 64-bit hash.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np

from tablecraft.llm import arrays

#: Code points handled by class: ASCII, and the Latin-1 letters, which are all letters
#: with one-to-one lower case and are unchanged by NFC.
_OTHER, _LETTER, _DIGIT, _SPACE = 0, 1, 2, 3
_CLASS = np.full(256, _OTHER, np.uint8)
_CLASS[[9, 10, 11, 12, 13, 32]] = _SPACE
_CLASS[48:58] = _DIGIT
_CLASS[65:91] = _CLASS[97:123] = _LETTER
_CLASS[0xC0:0x100] = _LETTER
_CLASS[[0xD7, 0xF7]] = _OTHER
_KNOWN = np.ones(256, bool)
_KNOWN[0x80:0xC0] = False
_KNOWN[0] = False  # parts texts below
_KNOWN[0x1C:0x20] = False  # separators that some pattern engines count as white space
_LOWER = np.arange(256, dtype=np.uint32)
_LOWER[65:91] += 32
_LOWER[0xC0:0xDF] += 32
_LOWER[0xD7] = 0xD7
_SUFFIXES = ("s", "t", "re", "ve", "m", "ll", "d")  # after an apostrophe


def simple(text: str) -> bool:
    """Whether every character of ``text`` can be split by class."""
    try:
        raw = text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return bool(_KNOWN[np.frombuffer(raw, np.uint8)].all())


def code_points(texts: Sequence[str], lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Latin-1 codes of the texts, each preceded and the last followed by a NUL, and the
    start of each text."""
    parts = [t.encode("latin-1") for t in texts]
    buf, begin = arrays.joined(parts, b"\0")
    return (_LOWER[buf].astype(np.uint8) if lower else buf), begin


def _contractions(codes: np.ndarray, cls: np.ndarray, run_start: np.ndarray, keep_after_space: bool) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of contractions: an apostrophe that begins a run of other
    characters, is alone in it, and is followed by one of the suffixes."""
    at = np.flatnonzero(codes[:-3] == 39)
    at = at[run_start[at] & (cls[at + 1] == _LETTER)]
    if keep_after_space:
        at = at[codes[at - 1] != 32]
    if not len(at):
        return at, at
    end = np.zeros(len(at), np.int64)
    for s in _SUFFIXES:
        hit = np.ones(len(at), bool)
        for k, c in enumerate(s):
            hit &= codes[at + 1 + k] == ord(c)
        end = np.where(hit & (end == 0), at + 1 + len(s), end)
    return at[end > 0], end[end > 0]


def word_pieces(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pieces of lower-cased texts without white space: letter runs, single digits, other
    runs, contractions. Returns starts and ends into ``codes`` (which holds NUL between
    texts)."""
    cls = _CLASS[codes]
    cls = np.where(codes == 0, np.uint8(4), cls)
    run_start = np.r_[True, cls[1:] != cls[:-1]]
    at, end = _contractions(codes, cls, run_start, keep_after_space=False)
    cut = run_start | (cls == _DIGIT)
    cut[end] = True
    starts = np.flatnonzero(cut)
    ends = np.r_[starts[1:], len(codes)]
    if len(at):
        # the letters of a contraction belong to the piece that its apostrophe began
        inner = np.zeros(len(codes), bool)
        inner[at + 1] = True
        joined = ~inner[starts]
        starts = starts[joined]
        ends = np.r_[starts[1:], len(codes)]
    keep = (cls[starts] != _SPACE) & (cls[starts] != 4)
    return starts[keep], ends[keep]


def byte_pieces(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pieces that cover the whole texts: contractions; letter, digit or other runs with
    one leading blank; white space, whose last character before a run stands alone (or
    joins the run, if it is a blank)."""
    cls = _CLASS[codes]
    cls = np.where(codes == 0, np.uint8(4), cls)
    run_start = np.r_[True, cls[1:] != cls[:-1]]
    at, end = _contractions(codes, cls, run_start, keep_after_space=True)
    cut = run_start.copy()
    if len(at):
        cut[end] = True
        cut[at + 1] = False
    # a run (not of white space) that follows white space: the last of it is split off,
    # and if that is a blank, it begins the run's piece
    follows = np.flatnonzero(run_start & (cls != _SPACE) & (cls != 4))
    follows = follows[cls[follows - 1] == _SPACE]
    cut[follows - 1] = True
    cut[follows[codes[follows - 1] == 32]] = False
    starts = np.flatnonzero(cut)
    ends = np.r_[starts[1:], len(codes)]
    keep = cls[starts] != 4
    return starts[keep], ends[keep]


class PieceTable:
    """Results for every distinct run of codes met so far, found by hash. ``make`` gets
    the new distinct runs (codes, starts, ends) and returns their results, concatenated,
    and the length of each. Beyond ``limit`` bytes the table starts anew, which costs time
    only."""

    def __init__(self, make: Callable[[np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]],
                 dtype: type = np.int32, limit: int = 24 << 20):
        self.make, self.dtype, self.limit = make, dtype, limit
        self.clear()

    def clear(self) -> None:
        self.hashes = np.zeros(0, np.uint64)
        self.first = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int32)
        self.flat = np.zeros(0, self.dtype)

    def lookup(self, codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Results of all the runs, concatenated, and the length of each."""
        if not len(starts):
            return np.zeros(0, self.dtype), np.zeros(0, np.int32)
        h = arrays.run_hashes(codes, starts, ends)
        distinct, one, back = np.unique(h, return_index=True, return_inverse=True)
        if (len(self.hashes) + len(distinct)) * 20 + self.flat.nbytes > self.limit:
            self.clear()
        at = np.searchsorted(self.hashes, distinct)
        known = np.zeros(len(distinct), bool)
        inside = at < len(self.hashes)
        known[inside] = self.hashes[at[inside]] == distinct[inside]
        fresh = np.flatnonzero(~known)
        if len(fresh):
            made, count = self.make(codes, starts[one[fresh]], ends[one[fresh]])
            first = len(self.flat) + np.cumsum(count) - count
            self.flat = np.concatenate([self.flat, made.astype(self.dtype)])
            where = at[fresh]
            self.hashes = np.insert(self.hashes, where, distinct[fresh])
            self.first = np.insert(self.first, where, first)
            self.count = np.insert(self.count, where, count)
            at = np.searchsorted(self.hashes, distinct)
        first, count = self.first[at][back], self.count[at][back]
        return self.flat[arrays.expand(first, count.astype(np.int64))], count


def latin_pieces(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[str]:
    """The texts of runs of Latin-1 codes."""
    raw = codes.tobytes().decode("latin-1")
    return [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist())]


def per_text(count: np.ndarray, starts: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Number of ids of each text, from the number of ids of each piece."""
    total = np.r_[0, np.cumsum(count)]
    cut = np.append(np.searchsorted(starts, begin), len(starts))
    return total[cut[1:]] - total[cut[:-1]]
