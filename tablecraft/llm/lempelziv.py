"""Removal of repeated passages by relative Lempel-Ziv parsing, in words.

A word is removed when a window of ``width`` words that covers it also starts anywhere
else. Documents are factored greedily against blocks of reference text: a factor is the
longest string at the current place that the reference holds too (at another place, as the
reference is the corpus itself), and the next factor begins behind it. All windows inside a
factor of ``width`` words or more are repeated. A window that no factor holds straddles a
boundary between factors; those are checked one by one. All others are unique, since a
factor can't be extended.

A document need not meet every block, only those that can hold a long factor. So reference
text goes to its block by content:

1. Every window has a seed, its ``_Q``-word string of least hash, and the windows of one
   occurrence of a seed form a segment of ``width`` to ``2 * width - _Q`` words. Equal windows
   have equal seeds, so a long factor of a segment lies in segments of the same seed.
   A seed that occurs once settles its windows as unique.
2. Equal segments are one entry of the reference with a count; where it is above one, the
   segment is one factor from end to end. Counting combines before the shuffle, so a passage
   that a third of the corpus holds is one row a task.
3. Entries whose seed has others go to reference blocks by seed. A block is indexed by a
   suffix array of its words, and its segments are factored against it. A block takes whole
   seeds up to ``_BLOCK_WORDS`` words and is cut from a stream sorted by seed, so its memory
   doesn't depend on the partition.
4. A seed with more than ``_SPLIT`` different entries (a phrase as common as a licence line in
   ever other surroundings) would fill a block alone. Its windows become references of their
   own: their blocks are named by the hash of the whole window, which spreads them evenly,
   and factoring there is the comparison of that name.

No pairs of documents are made anywhere; every step passes at most a few rows per segment.

Edge cases. Words are runs of bytes other than blank and 0x09-0x0D; null text has none.
Texts with fewer words than ``width`` keep everything. Copies of a text remove each other
wholly. Repeated rows (equal id and text) count as two documents and share their result.
Long texts are handled in parts of ``_PART`` windows. Matches never cross documents. Empty
table: empty result. Other columns are ignored. Words, seeds and windows are compared by
64-bit hashes, within a seed, so a false match needs several hashes to collide at once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructType

from tablecraft.llm import arrays
from tablecraft.llm.frames import KEY, default_parallelism, small_batches, stored, text_key

_U = np.uint64
WIDTH = 35
_Q = 8  # words of a seed
_HALF = 32  # words of the strings whose hashes make up those of longer ones
_PART = 1 << 18  # windows of a text handled together
_BLOCK_WORDS = 1 << 18
_SPLIT = 256
_PLACE = _U((1 << 21) - 1)  # low bits of a seed's sort key hold its place
_WORD = np.ones(256, bool)
_WORD[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
_A, _B, _C, _D = (_U(x) for x in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3))


def _word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, and where each text's words begin (and end)."""
    buf, begin = arrays.joined(texts)
    starts, ends = arrays.words(buf, _WORD)
    return arrays.run_hashes(buf, starts, ends), np.append(np.searchsorted(starts, begin), len(starts))


def _parts(cuts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Texts given by their word ranges, as groups of parts (text number, first word, number
    of words). Parts of a text overlap so that every window lies in exactly one."""
    of, at, n, size = [], [], [], 0
    for i, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())):
        for s in range(a, b - WIDTH + 1, _PART):
            length = min(_PART + WIDTH - 1, b - s)
            if of and size + length > _PART + WIDTH:
                yield tuple(np.asarray(x, np.int64) for x in (of, at, n))
                of, at, n, size = [], [], [], 0
            of.append(i)
            at.append(s)
            n.append(length)
            size += length
    if of:
        yield tuple(np.asarray(x, np.int64) for x in (of, at, n))


def _doubled(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the ``_Q`` and of the ``_HALF`` words from every place on."""
    depth, low = 1, h
    while depth < _HALF:
        if depth == _Q:
            low = h
        later = np.zeros_like(h)
        later[:max(0, len(h) - depth)] = h[depth:]
        h = arrays.mix(h * _A ^ later * _B)
        depth *= 2
    return low, h


def _string(half: np.ndarray, start: np.ndarray, length: np.ndarray | int, salt: np.ndarray | np.uint64) -> np.ndarray:
    """Hash of the strings of ``_HALF`` to 2 * ``_HALF`` words at ``start``."""
    length = np.asarray(length, np.int64)
    x = half[start] * _A ^ half[start + length - _HALF] * _B
    return arrays.mix(arrays.mix(x ^ salt) + length.astype(_U) * _D)


def _seed_places(h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place of the seed of every window in the word hashes ``h`` (parts laid end to end;
    windows across the joints are among them), and the hashes of :func:`_doubled`."""
    low, half = _doubled(h)
    key = (low & ~_PLACE) | np.arange(len(h), dtype=_U)
    width, reach = 1, WIDTH - _Q + 1
    while 2 * width <= reach:
        key = np.minimum(key[:len(key) - width], key[width:])
        width *= 2
    key = np.minimum(key[:len(key) - (reach - width)], key[reach - width:])
    seed = (key[:len(h) - WIDTH + 1] & _PLACE).astype(np.int64)
    return seed, low, half


_ROWS = "_k1 long, _k2 long, seed long, string long, lo int, n short"


def _seeds(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The segments of every text."""
    for df in batches:
        k1, k2 = df["_k1"].to_numpy(), df["_k2"].to_numpy()
        for first, texts in arrays.slices(df["text"].tolist()):
            h, cuts = _word_hashes(texts)
            for of, at, n in _parts(cuts):
                begin = np.cumsum(n) - n
                seed, low, half = _seed_places(h[arrays.expand(at, n)])
                p = arrays.expand(begin, n - WIDTH + 1)  # windows, none across a joint
                a = seed[p]
                new = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (p[1:] != p[:-1] + 1)])
                lo, count, a = p[new], np.diff(np.r_[new, len(p)]), a[new]
                text = np.searchsorted(begin, lo, "right") - 1
                doc = first + of[text]
                string = _string(half, lo, count + WIDTH - 1, (a - lo).astype(_U))
                yield pd.DataFrame({
                    "_k1": k1[doc], "_k2": k2[doc], "seed": low[a].view(np.int64), "string": string.view(np.int64),
                    "lo": (lo - begin[text] + at[text] - cuts[of[text]]).astype(np.int32), "n": count.astype(np.int16)})
    arrays.release()


_ENTRY = "seed long, _k1 long, _k2 long, lo int, name long, words array<long>"


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The segments that a text's row names, with their words; of a split seed, the windows
    with their names."""
    for batch in batches:
        t = pa.Table.from_batches([batch])
        k1, k2 = t["_k1"].to_numpy(), t["_k2"].to_numpy()
        lists = {c: t[c].combine_chunks() for c in ("seeds", "splits", "los", "ns")}
        bounds = lists["los"].offsets.to_numpy().astype(np.int64)
        bounds -= bounds[0]
        seeds, splits, los, ns = (x.flatten().to_numpy(zero_copy_only=False).astype(np.int64) for x in lists.values())
        for first, texts in arrays.slices(t["text"].to_pylist()):
            h, cuts = _word_hashes(texts)
            mine = slice(bounds[first], bounds[first + len(texts)])
            doc = np.repeat(np.arange(len(texts)), np.diff(bounds[first:first + len(texts) + 1]))
            whole = splits[mine] == 0
            lo, n, at = los[mine], ns[mine], los[mine] + cuts[doc]
            length = n + WIDTH - 1
            w = np.flatnonzero(whole)
            yield _entry_rows(
                seeds[mine][w], k1[first + doc[w]], k2[first + doc[w]], lo[w], np.zeros(len(w), np.int64),
                pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(length[w])], pa.int32()), pa.array(h[arrays.expand(at[w], length[w])].view(np.int64))))
            rest = np.flatnonzero(~whole)
            for g in (rest[i:i + 4096] for i in range(0, len(rest), 4096)):
                _, half = _doubled(h[arrays.expand(at[g], length[g])])
                p = arrays.expand(np.cumsum(length[g]) - length[g], n[g])
                of = np.repeat(first + doc[g], n[g])
                yield _entry_rows(
                    _string(half, p, WIDTH, _C).view(np.int64), k1[of], k2[of], arrays.expand(lo[g], n[g]),
                    _string(half, p, WIDTH, _D).view(np.int64) | 1, pa.nulls(len(p), pa.list_(pa.int64())))
    arrays.release()


def _entry_rows(seed, k1, k2, lo, name, words) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(seed), pa.array(k1), pa.array(k2), pa.array(lo.astype(np.int32)), pa.array(name), words],
        ["seed", "_k1", "_k2", "lo", "name", "words"])


class Reference:
    """A block of segments (word hashes laid end to end, ``length`` of each) and the index
    of their suffixes."""

    def __init__(self, words: np.ndarray, length: np.ndarray):
        self.end = np.cumsum(length + 1) - 1
        self.begin = self.end - length
        n = int(self.end[-1]) + 1
        _, symbol = np.unique(words, return_inverse=True)
        text = np.empty(n, np.int64)
        text[arrays.expand(self.begin, length)] = symbol
        text[self.end] = len(words) + np.arange(len(length))  # a mark of its own ends every segment
        self.ranks, depth = [], 1
        rank = np.unique(text, return_inverse=True)[1]
        while True:
            self.ranks.append(rank)
            if rank.max() == n - 1:
                break
            later = np.zeros(n, np.int64)
            later[:n - depth] = rank[depth:] + 1
            rank = np.unique(rank * (n + 1) + later, return_inverse=True)[1]
            depth *= 2
        self.order = np.empty(n, np.int64)
        self.order[rank] = np.arange(n)

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common beginning of the suffixes at ``a`` and ``b``."""
        out = np.zeros(len(a), np.int64)
        last = len(self.order) - 1
        for k in range(len(self.ranks) - 1, -1, -1):
            x, y = a + out, b + out
            inside = (x <= last) & (y <= last)
            same = inside & (self.ranks[k][np.minimum(x, last)] == self.ranks[k][np.minimum(y, last)])
            out += same << k
        return out

    def longest(self, at: np.ndarray) -> np.ndarray:
        """Length of the longest string at each place that the block holds at another:
        that with a neighbour in the order of suffixes."""
        rank, out = self.ranks[-1][at], np.zeros(len(at), np.int64)
        for step in (-1, 1):
            near = rank + step
            some = np.flatnonzero((near >= 0) & (near < len(self.order)))
            out[some] = np.maximum(out[some], self.common(at[some], self.order[near[some]]))
        return out

    def repeated(self) -> np.ndarray:
        """Flags of the places where a repeated window starts, by greedy factors."""
        flag = np.zeros(len(self.order) + 1, np.int64)
        at, end = self.begin.copy(), self.end
        live = np.flatnonzero(at + WIDTH <= end)
        straddling = []
        while len(live):
            p = at[live]
            length = self.longest(p)
            long = length >= WIDTH  # a factor with whole windows in it
            np.add.at(flag, p[long], 1)
            np.add.at(flag, p[long] + length[long] - WIDTH + 1, -1)
            after = p + np.maximum(length, 1)
            # windows that begin in the factor and end behind it, but in the segment
            lo = np.maximum(p + 1, after - WIDTH + 1)
            straddling.append(arrays.expand(lo, np.maximum(np.minimum(after, end[live] - WIDTH + 1) - lo, 0)))
            at[live] = after
            live = live[after + WIDTH <= end[live]]
        out = np.cumsum(flag[:-1]) > 0
        if straddling:
            check = np.concatenate(straddling)
            out[check[self.longest(check) >= WIDTH]] = True
        return out


def _factored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of repeated windows of the segments, which come in order of their seed."""

    def block(t: pa.Table) -> pa.RecordBatch:
        words = t["words"].combine_chunks()
        length = np.diff(words.offsets.to_numpy()).astype(np.int64)
        ref = Reference(words.flatten().to_numpy(), length)
        hit = np.r_[False, ref.repeated(), False]  # a segment's last window never touches the next's first
        edges = np.flatnonzero(hit[1:] != hit[:-1])
        lo, hi = edges[::2], edges[1::2] - 1
        row = np.searchsorted(ref.begin, lo, "right") - 1
        shift = t["lo"].to_numpy()[row] - ref.begin[row]
        return pa.RecordBatch.from_arrays([
            pa.array(t["_k1"].to_numpy()[row]), pa.array(t["_k2"].to_numpy()[row]),
            pa.array((lo + shift).astype(np.int32)), pa.array((hi + shift).astype(np.int32))], ["_k1", "_k2", "lo", "hi"])

    held, size = [], 0
    for b in batches:
        if not b.num_rows:
            continue
        held.append(b)
        size += len(b.column(b.schema.get_field_index("words")).flatten())
        if size < _BLOCK_WORDS:
            continue
        t = pa.Table.from_batches(held).combine_chunks()
        seed = t["seed"].to_numpy()
        cut = int(np.searchsorted(seed, seed[-1]))  # the last seed may go on
        if cut:
            yield block(t.slice(0, cut).combine_chunks())
            held = t.slice(cut).combine_chunks().to_batches()
            size = sum(len(x.column(x.schema.get_field_index("words")).flatten()) for x in held)
    if held:
        yield block(pa.Table.from_batches(held).combine_chunks())
    arrays.release()


def repeated_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row key, lo, hi): runs of word places at which repeated windows start."""
    small_batches(docs.sparkSession)
    n = default_parallelism(docs.sparkSession)
    texts = docs.select(*text_key(id_col, text_col), F.col(text_col).alias("text")).where(F.octet_length("text") >= 2 * WIDTH - 1)
    # joined sides are written first: adaptive execution can then split a hot seed
    rows = stored(texts.mapInPandas(_seeds, _ROWS), "segments")
    company = stored(rows.groupBy("seed").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("seed"), "seeds")
    rows = stored(rows.join(company, "seed", "left_semi"), "segments-shared")
    entries = stored(rows.groupBy("seed", "string").agg(
        F.count(F.lit(1)).alias("copies"), F.min(F.struct(*KEY, "lo", "n")).alias("w")), "entries")
    whole = rows.join(entries.where("copies > 1").select("seed", "string"), ["seed", "string"], "left_semi")
    whole = whole.select(*KEY, "lo", (F.col("lo") + F.col("n") - 1).cast("int").alias("hi"))

    mixed = stored(entries.groupBy("seed").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select(
        "seed", (F.col("c") > _SPLIT).alias("split")), "seeds-mixed")
    wanted = stored(entries.join(mixed, "seed").select("seed", "split", "w.*"), "entries-mixed")
    wanted = stored(wanted.groupBy(*KEY).agg(F.collect_set(F.struct("seed", "split", "lo", "n")).alias("w")).select(
        *KEY, *[F.col(f"w.{c}").alias(f"{c}s") for c in ("seed", "split", "lo", "n")]), "entries-by-text")
    once = texts.join(wanted, KEY).dropDuplicates(KEY)  # a repeated row is one entry here
    found = stored(once.mapInArrow(_entries, _ENTRY), "reference")

    blocks = found.where("name = 0").select("seed", *KEY, "lo", "words").repartition(n, "seed").sortWithinPartitions("seed")
    # written by itself, as a stage that also joins could not have the join's hot keys split
    factored = stored(blocks.mapInArrow(_factored, "_k1 long, _k2 long, lo int, hi int"), "factored")
    windows = found.where("name <> 0").select("seed", "name", *KEY, "lo")
    twice = stored(windows.groupBy("seed", "name").agg(F.count(F.lit(1)).alias("c")).where("c > 1"), "windows")
    split = windows.join(twice, ["seed", "name"], "left_semi").select(*KEY, "lo", F.col("lo").alias("hi"))
    return whole.unionByName(factored).unionByName(split)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words that stay, and their digest."""
    for batch in batches:
        n_words, n_removed, spans, kept = [], [], [], []
        lists = (batch.column(batch.schema.get_field_index(c)) for c in ("text", "los", "his"))
        for text, los, his in zip(*lists):
            digest, total, some = hashlib.sha256(), 0, False
            s = e = np.zeros(0, np.int64)
            if los.is_valid:
                s, e = arrays.merged(los.values.to_numpy().astype(np.int64), his.values.to_numpy().astype(np.int64) + WIDTH)
            for words in _words_of(arrays.text_bytes([text.as_py()])[0]):
                kept_words = words
                if len(s):
                    edge = np.zeros(len(words) + 1, np.int64)
                    np.add.at(edge, np.clip(s - total, 0, len(words)), 1)
                    np.add.at(edge, np.clip(e - total, 0, len(words)), -1)
                    kept_words = list(compress(words, (np.cumsum(edge[:-1]) == 0).tolist()))
                total += len(words)
                if kept_words:
                    digest.update(b" " * some + b" ".join(kept_words))
                    some = True
            n_words.append(total)
            n_removed.append(int((e - s).sum()))
            spans.append(np.stack([s, e], 1).ravel())
            kept.append(digest.hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(spans, pa.list_(pa.int64())), pa.array(kept, pa.string())],
            ["id", "n_words", "n_removed", "spans", "kept_sha256"])
    arrays.release()


def _words_of(text: bytes, limit: int = 1 << 20) -> Iterator[list[bytes]]:
    """Words of a text, a list for about every ``limit`` bytes."""
    at = 0
    while at < len(text):
        to = min(len(text), at + limit)
        while to < len(text) and _WORD[text[to]]:
            to += 1
        yield text[at:to].split()
        at = to


def removed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_removed, spans, kept_sha256) of every row: ``spans`` are the removed
    runs of words as flat (from, to) pairs; the digest is of the other words, joined by
    blanks."""
    runs = stored(repeated_windows(docs, id_col, text_col).groupBy(*KEY).agg(
        F.collect_set(F.struct("lo", "hi")).alias("w")).select(*KEY, F.col("w.lo").alias("los"), F.col("w.hi").alias("his")), "runs")
    rows = docs.select(F.col(id_col).alias("id"), *text_key(id_col, text_col), F.col(text_col).alias("text"))
    schema = StructType().add("id", docs.schema[id_col].dataType).add("n_words", LongType()).add("n_removed", LongType())
    schema = schema.add("spans", ArrayType(LongType())).add("kept_sha256", StringType())
    return rows.join(runs, KEY, "left").select("id", "text", "los", "his").mapInArrow(_cut, schema)


def without_repeats(text: str | None, spans) -> str:
    """A text's words outside of ``spans``, joined by blanks."""
    words = [w for part in _words_of((text or "").encode()) for w in part]
    keep = np.ones(len(words), bool)
    for a, b in zip(spans[::2], spans[1::2]):
        keep[a:b] = False
    return b" ".join(compress(words, keep.tolist())).decode()
