"""Benchmark decontamination with an FM-index per training shard.

The benchmark gives phrases: every run of ``window`` consecutive words of an item (an
item with fewer words is one phrase). Each task cuts its documents into shards of a few
MB. Words that occur in no phrase end a match, so a shard's index holds only the runs of
benchmark words that are long enough for the shortest phrase. The index is the
Burrows-Wheeler transform of those runs in a wavelet matrix: backward search narrows all
phrases at once to suffix ranges by rank queries, and every occurrence is located by
following the LF mapping to the next sampled suffix position. Overlapping occurrences
merge into removal spans.

Documents never move between tasks. The benchmark reaches the tasks in blocks of at most
``block_bytes`` of item text, each a broadcast of that bounded size, so a larger benchmark
means more passes over a shard, not larger broadcasts.

Edge cases. Null or wordless texts have no words, spans or items, and null or wordless
items no phrases. Equal phrases of several items count for each item; repeated item rows
count once. A null item id is reported as an empty string. An empty benchmark or document
table gives no hits or no rows. Extra columns pass through untouched.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablecraft.llm import arrays
from tablecraft.llm.frames import small_batches

_SHARD_BYTES = 4 << 20
_SAMPLE = 8  # every 8th position of a run, and its first, is a sampled suffix position
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[65:91] = _WORD[97:123] = _WORD[128:] = True

RESULT = "n_words long, n_hit long, spans array<long>, items array<string>"


class FMIndex:
    """Backward search and location over an integer text. ``text`` holds symbols from 1
    on, with 0 before and after every run; phrases never contain 0."""

    def __init__(self, text: np.ndarray, symbols: int):
        n = len(text)
        gaps = np.flatnonzero(text == 0)
        # every separator is a symbol of its own, so no two suffixes agree past a run
        rank = text.astype(np.int64) + len(gaps)
        rank[gaps] = np.arange(len(gaps))
        step = 1
        while True:
            after = np.full(n, -1, np.int64)
            after[:n - step] = rank[step:]
            key = rank * (n + len(gaps) + symbols + 1) + after + 1
            order = np.argsort(key, kind="stable")
            s = key[order]
            new = np.empty(n, np.int64)
            new[order] = np.cumsum(np.r_[0, s[1:] != s[:-1]])
            rank = new
            if n == 0 or rank[order[-1]] == n - 1:
                break
            step *= 2
        bwt = text[order - 1]
        # positions of a run, counted from its start; the starts are always sampled
        inside = np.arange(n) - np.maximum.accumulate(np.where(text == 0, np.arange(n), -1)) - 1
        self.sampled = (inside[order] % _SAMPLE == 0) | (text[order] == 0)
        self.position = order
        self.before = np.r_[0, np.cumsum(np.bincount(text, minlength=symbols + 1))]
        self.bits = max(1, int(symbols).bit_length())
        self.levels = []
        seq = bwt
        for b in range(self.bits - 1, -1, -1):
            bit = (seq >> b) & 1
            ones = np.r_[0, np.cumsum(bit)].astype(np.int32)
            self.levels.append((b, ones, n - int(ones[-1])))
            seq = np.concatenate([seq[bit == 0], seq[bit == 1]])
        self.bwt = bwt

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Occurrences of ``symbol`` among the first ``i`` symbols of the transform."""
        lo = np.zeros_like(i)
        for b, ones, zeros in self.levels:
            bit = ((symbol >> b) & 1).astype(bool)
            one_lo, one_hi = ones[lo], ones[i]
            lo = np.where(bit, zeros + one_lo, lo - one_lo)
            i = np.where(bit, zeros + one_hi, i - one_hi)
        return i - lo

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix range (from, to) of every phrase; a row of ``phrases`` ends at its length."""
        lo = np.zeros(len(phrases), np.int64)
        hi = np.full(len(phrases), len(self.bwt), np.int64)
        for k in range(1, int(lengths.max(initial=0)) + 1):
            live = np.flatnonzero((lengths >= k) & (lo < hi))
            c = phrases[live, lengths[live] - k]
            lo[live] = self.before[c] + self.rank(c, lo[live])
            hi[live] = self.before[c] + self.rank(c, hi[live])
        return lo, np.maximum(lo, hi)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffixes given by their rank."""
        out = np.empty(len(rows), np.int64)
        live, at, steps = np.arange(len(rows)), rows.copy(), 0
        while len(live):
            done = self.sampled[at]
            out[live[done]] = self.position[at[done]] + steps
            live, at = live[~done], at[~done]
            c = self.bwt[at]
            at = self.before[c] + self.rank(c, at)
            steps += 1
        return out


class Phrases:
    """The distinct phrases of a block of items, as symbols of their sorted word hashes."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int):
        names = sorted({n or "" for n, _ in items})
        number = {n: i for i, n in enumerate(names)}
        self.names = np.array(names, dtype=object)
        buf, begin = arrays.joined(arrays.text_bytes([t for _, t in items]))
        starts, ends = arrays.words(buf, _WORD)
        h = arrays.run_hashes(arrays.ascii_lower()[buf], starts, ends)
        self.vocabulary = np.unique(h)
        symbol = np.searchsorted(self.vocabulary, h) + 1
        cut = np.append(np.searchsorted(starts, begin), len(starts))
        # one row per window, in arrays: no Python object per window
        first, last = cut[:-1], cut[1:]
        count = np.maximum(np.where(last > first, 1, 0), last - first - window + 1)
        at = arrays.expand(first, count)
        length = np.minimum(window, np.repeat(last, count) - at)
        rows = np.zeros((len(at), window), np.int32)
        for k in range(window):
            inside = np.flatnonzero(length > k)
            rows[inside, k] = symbol[at[inside] + k]
        self.symbols, phrase = np.unique(rows, axis=0, return_inverse=True)
        self.symbols = self.symbols.astype(np.int64)
        self.lengths = np.count_nonzero(self.symbols, axis=1)
        of_item = np.array([number[n or ""] for n, _ in items], np.int64)
        pairs = np.unique(phrase.ravel() * len(names) + np.repeat(of_item, count))
        self.items = pairs % max(len(names), 1)
        self.n_items = np.bincount(pairs // max(len(names), 1), minlength=len(self.lengths))
        self.first_item = np.cumsum(self.n_items) - self.n_items


def search_shard(texts: list[bytes], phrases: Phrases) -> pd.DataFrame:
    """Words, hit words, merged spans and items of every text of one shard. A span is four
    numbers: its words (from, to) and its bytes (from, to)."""
    buf, begin = arrays.joined(texts)
    starts, ends = arrays.words(buf, _WORD)
    cut = np.append(np.searchsorted(starts, begin), len(starts))
    n_words = np.diff(cut)
    n_hit = np.zeros(len(texts), np.int64)
    spans = [np.zeros(0, np.int64)] * len(texts)
    items = [np.zeros(0, object)] * len(texts)
    out = {"n_words": n_words, "n_hit": n_hit, "spans": spans, "items": items}
    if not len(starts) or not len(phrases.lengths):
        return pd.DataFrame(out)
    h = arrays.run_hashes(arrays.ascii_lower()[buf], starts, ends)
    at = np.searchsorted(phrases.vocabulary, h)
    at[at == len(phrases.vocabulary)] = 0
    known = phrases.vocabulary[at] == h
    # runs of benchmark words, within a document
    opens = np.zeros(len(h) + 1, bool)
    opens[cut] = True
    run_start = np.flatnonzero(known & (opens[:-1] | ~np.r_[False, known[:-1]]))
    run_end = np.flatnonzero(known & (opens[1:] | ~np.r_[known[1:], False])) + 1
    long = run_end - run_start >= phrases.lengths.min()
    run_start, length = run_start[long], (run_end - run_start)[long]
    if not len(run_start):
        return pd.DataFrame(out)
    words = arrays.expand(run_start, length)
    text = np.zeros(len(words) + len(run_start) + 1, np.int64)
    place = np.arange(len(words)) + np.repeat(np.arange(len(run_start)), length) + 1
    text[place] = at[words] + 1
    word_at = np.zeros(len(text), np.int64)
    word_at[place] = words

    index = FMIndex(text, len(phrases.vocabulary))
    lo, hi = index.search(phrases.symbols, phrases.lengths)
    found = np.flatnonzero(hi > lo)
    phrase = np.repeat(found, (hi - lo)[found])
    first = word_at[index.locate(arrays.expand(lo[found], (hi - lo)[found]))]
    doc = np.searchsorted(cut, first, "right") - 1

    s, e = arrays.merged(first, first + phrases.lengths[phrase])
    # neighbouring documents' spans can touch in word numbers
    edge = cut[np.searchsorted(cut, s, "right")]
    while (e > edge).any():
        over = e > edge
        s, e = np.r_[np.where(over, s, s), edge[over]], np.r_[np.where(over, edge, e), e[over]]
        edge = cut[np.searchsorted(cut, s, "right")]
    order = np.argsort(s)
    s, e = s[order], e[order]
    of = np.searchsorted(cut, s, "right") - 1
    np.add.at(n_hit, of, e - s)
    rows = np.stack([s - cut[of], e - cut[of], starts[s] - begin[of], ends[e - 1] - begin[of]], 1)
    for d in np.unique(of):
        spans[d] = rows[of == d].ravel() if len(rows) < 64 else rows[np.searchsorted(of, d):np.searchsorted(of, d, "right")].ravel()
    seen = np.unique(doc * len(phrases.lengths) + phrase)
    doc, phrase = seen // len(phrases.lengths), seen % len(phrases.lengths)
    item = phrases.items[arrays.expand(phrases.first_item[phrase], phrases.n_items[phrase])]
    pair = np.unique(np.repeat(doc, phrases.n_items[phrase]) * len(phrases.names) + item)
    doc, item = pair // len(phrases.names), pair % len(phrases.names)
    for d in np.unique(doc):
        items[d] = phrases.names[item[np.searchsorted(doc, d):np.searchsorted(doc, d, "right")]]
    return pd.DataFrame(out)


def merge_spans(lists: list[np.ndarray]) -> np.ndarray:
    """Union of several span lists of one text."""
    rows = np.concatenate([np.asarray(x, np.int64) for x in lists]).reshape(-1, 4)
    s, e = arrays.merged(rows[:, 0], rows[:, 1])
    at = np.searchsorted(s, rows[:, 0], "right") - 1
    lo, hi = np.full(len(s), np.iinfo(np.int64).max), np.zeros(len(s), np.int64)
    np.minimum.at(lo, at, rows[:, 2])
    np.maximum.at(hi, at, rows[:, 3])
    return np.stack([s, e, lo, hi], 1).ravel()


def contamination(text: Column | str, benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text",
                  window: int = 10, block_bytes: int = 4 << 20) -> Column:
    """Struct column ``RESULT`` with what of ``benchmark`` occurs in a text column."""
    spark = benchmark.sparkSession
    small_batches(spark)
    items = benchmark.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(size / block_bytes))
    found = []
    for b in range(blocks):
        part = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == b)
        phrases = spark.sparkContext.broadcast(Phrases([tuple(r) for r in part.collect()], window))
        found.append(_search(phrases)(text))
    return found[0] if blocks == 1 else _union(F.array(*found))


def _search(phrases):
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in batches:
            shards = [search_shard(t, phrases.value) for _, t in arrays.slices(s.tolist(), _SHARD_BYTES)]
            yield pd.concat(shards, ignore_index=True) if shards else search_shard([], phrases.value)
        arrays.release()

    return F.pandas_udf(run, RESULT)


def _union(found: Column) -> Column:
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in batches:
            spans = [merge_spans([r["spans"] for r in rows]) for rows in s]
            yield pd.DataFrame({
                "n_words": [rows[0]["n_words"] for rows in s],
                "n_hit": [int((x[1::4] - x[::4]).sum()) for x in spans],
                "spans": spans,
                "items": [sorted({i for r in rows for i in r["items"]}) for rows in s],
            })

    return F.pandas_udf(run, RESULT)(found)


def without_spans(text: Column | str, spans: Column | str) -> Column:
    """The text without the bytes of its spans (null stays null)."""

    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, lists in batches:
            out = []
            for t, x in zip(texts, lists):
                if t is not None and x is not None and len(x):
                    raw, keep, at = t.encode("utf-8", "surrogatepass"), [], 0
                    for a, b in zip(x[2::4], x[3::4]):
                        keep.append(raw[at:a])
                        at = b
                    t = b"".join([*keep, raw[at:]]).decode("utf-8", "surrogatepass")
                out.append(t)
            yield pd.Series(out, dtype=object)

    small_batches()
    return F.pandas_udf(run, "string")(text, spans)
