"""Removal of long repeated substrings by distributed bucket-pointer refinement.

A byte is removed when a ``width``-byte string that covers it also starts anywhere else.
That asks for the buckets of the suffix array at depth ``width``: two positions share a
bucket when their suffixes agree that far. The refinement starts from q-gram buckets and
sorts them further by the bucket identifiers of later offsets; identifiers of depth 2k are
made of those at depth k of an offset and of the offset k later, and every later round
reuses them. An identifier is a 64-bit hash of the string, so all partitions agree on it
without a global sort, and Spark's grouping by identifiers is the sort of a round.

A position's bucket needs looking at only if it can have company, so most of the suffix
array is never made:

1. Each ``width``-byte window has an anchor, its q-gram of least identifier. Neighbouring
   windows share anchors, which leaves about one row in 130 bytes. An anchor whose
   q-gram occurs once settles all its windows as unique. An anchor whose windows together
   span a string that another anchor has too settles them all as repeated; one of equal
   anchors stays in the comparison for all of them.
2. The windows of the remaining anchors are cut into blocks of 17 by their distance from
   the anchor. The string that all windows of a block share is its bucket: a block alone
   in its bucket is unique, a block whose whole span is repeated is repeated.
3. Only blocks that a match begins or ends in are left. Their windows are compared one by
   one.

So a repeated passage costs a few rows per occurrence, whatever its length, and a string
with a million occurrences is a million narrow rows in counted groups, never pairs.
Rounds read the texts from a table bucketed by row key, so texts are shuffled once.

Edge cases. Null text: empty. Texts shorter than ``width`` keep everything. Copies of a
text remove each other wholly. Repeated rows (equal id and text) count as two documents
and share their result. Texts of any length are handled in segments of 1 MB. Matches never
cross documents. Empty table: empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablecraft.llm import arrays
from tablecraft.llm.frames import KEY, default_parallelism, small_batches, stored, text_key
from tablecraft.sources.scratch import scratch_path

_U = np.uint64
WIDTH, _Q, _BLOCK = 400, 128, 17
_SEGMENT = 1 << 20  # window starts of one segment
_PLACE = _U((1 << 21) - 1)  # low bits of an anchor's sort key hold its place
_BYTES = arrays.mix(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15))
_A, _B, _C, _D = (_U(x) for x in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3))


def _segments(texts: list[bytes]) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """Groups of segments (text number, offset, bytes) of about ``_SEGMENT`` bytes. Segments
    of a text overlap, so that every window lies in exactly one."""
    of, at, held, size = [], [], [], 0
    for i, t in enumerate(texts):
        for s in range(0, len(t) - WIDTH + 1, _SEGMENT):
            part = t[s:s + _SEGMENT + WIDTH - 1]
            if held and size + len(part) > _SEGMENT + WIDTH:
                yield of, at, held
                of, at, held, size = [], [], [], 0
            of.append(i)
            at.append(s)
            held.append(part)
            size += len(part)
    if held:
        yield of, at, held


def _identifiers(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket identifiers of every offset at depth 128 and 256, by doubling."""
    h, depth = _BYTES[buf], 1
    low = h
    while depth < 256:
        if depth == _Q:
            low = h
        later = np.zeros_like(h)
        later[:len(h) - depth] = h[depth:]
        h = h * _A
        later *= _B
        h ^= later
        h ^= h >> _U(29)
        depth *= 2
    return low, h


def _span(h: np.ndarray, start: np.ndarray, length: np.ndarray | int, salt: np.uint64) -> np.ndarray:
    """Identifier of the strings of 256 to 768 bytes at ``start``, from those at depth 256
    of their begin, middle and end."""
    length = np.asarray(length, np.int64)
    x = h[start] * _A + h[start + np.minimum(256, length - 256)] * _B + h[start + length - 256] * _C
    return arrays.mix((x ^ salt) + length.astype(_U) * _D)


def _anchored(buf: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> pd.DataFrame:
    """Anchors of all windows of the segments in ``buf``: anchor, lo and hi (first and last
    window) as places in ``buf``, core and outer identifiers."""
    low, high = _identifiers(buf)
    key = (low & ~_PLACE) | np.arange(len(buf), dtype=_U)
    width, reach = 1, WIDTH - _Q + 1
    while 2 * width <= reach:
        key = np.minimum(key[:len(key) - width], key[width:])
        width *= 2
    key = np.minimum(key[:len(key) - (reach - width)], key[reach - width:])
    p = arrays.expand(starts, lengths - WIDTH + 1)
    a = (key[p] & _PLACE).astype(np.int64)
    new = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (p[1:] != p[:-1] + 1)])
    lo, hi, a = p[new], p[np.r_[new[1:] - 1, len(p) - 1]], a[new]
    outer = _span(high, lo, hi - lo + WIDTH, (a - lo).astype(_U))
    return pd.DataFrame({"anchor": a, "lo": lo, "hi": hi, "core": low[a].view(np.int64), "outer": outer.view(np.int64)})


def _blocks(buf: np.ndarray, a: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> pd.DataFrame:
    """The windows lo..hi of each anchor a in blocks by distance from it."""
    _, high = _identifiers(buf)
    first = (a - hi) // _BLOCK
    n = (a - lo) // _BLOCK - first + 1
    row = np.repeat(np.arange(len(a)), n)
    j = arrays.expand(first, n)
    a, lo, hi = a[row], np.maximum(lo[row], a[row] - (j + 1) * _BLOCK + 1), np.minimum(hi[row], a[row] - j * _BLOCK)
    core = _span(high, a - j * _BLOCK, WIDTH - _BLOCK + 1, j.astype(_U) + _D)
    outer = _span(high, lo, hi - lo + WIDTH, (a - lo).astype(_U))
    return pd.DataFrame({"row": row, "lo": lo, "hi": hi, "core": core.view(np.int64), "outer": outer.view(np.int64)})


def _windows(buf: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> pd.DataFrame:
    """The windows lo..hi one by one."""
    _, high = _identifiers(buf)
    p = arrays.expand(lo, hi - lo + 1)
    ids = [_span(high, p, WIDTH, salt).view(np.int64) for salt in (_A, _B)]
    return pd.DataFrame({"row": np.repeat(np.arange(len(lo)), hi - lo + 1), "lo": p, "hi": p, "core": ids[0], "outer": ids[1]})


_ROWS = "_k1 long, _k2 long, anchor long, lo long, hi long, core long, outer long"


def _start(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for df in batches:
        texts, k1, k2 = arrays.text_bytes(df["text"].tolist()), df["_k1"].to_numpy(), df["_k2"].to_numpy()
        for of, at, parts in _segments(texts):
            length = np.fromiter(map(len, parts), np.int64, len(parts))
            starts = np.cumsum(length) - length
            out = _anchored(np.frombuffer(b"".join(parts), np.uint8), starts, length)
            seg = np.searchsorted(starts, out["lo"].to_numpy(), "right") - 1
            shift = np.asarray(at)[seg] - starts[seg]
            out[["anchor", "lo", "hi"]] += shift[:, None]
            doc = np.asarray(of)[seg]
            yield out.assign(_k1=k1[doc], _k2=k2[doc])[[c.split()[0] for c in _ROWS.split(", ")]]
    arrays.release()


def _next(refine: str):
    """Rows of the next round for documents with open windows (anchor, lo, hi)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in batches:
            texts, k1, k2 = arrays.text_bytes(df["text"].tolist()), df["_k1"].to_numpy(), df["_k2"].to_numpy()
            wanted = [np.stack([np.asarray(x, np.int64) for x in (a, lo, hi)], 1)
                      for a, lo, hi in zip(df["anchors"], df["los"], df["his"])]
            for of, at, parts in _segments(texts):
                length = np.fromiter(map(len, parts), np.int64, len(parts))
                starts = np.cumsum(length) - length
                mine, doc = [], []
                for i, s, b, n in zip(of, at, starts, length):
                    w = wanted[i]
                    w = w[(w[:, 1] >= s) & (w[:, 1] <= s + n - WIDTH)]
                    mine.append(w + (b - s))
                    doc.append(np.full((len(w), 2), (i, s - b)))
                mine, doc = np.concatenate(mine), np.concatenate(doc)
                if not len(mine):
                    continue
                buf = np.frombuffer(b"".join(parts), np.uint8)
                out = _blocks(buf, *mine.T) if refine == "blocks" else _windows(buf, mine[:, 1], mine[:, 2])
                row = out.pop("row").to_numpy()
                out["lo"] += doc[row, 1]
                out["hi"] += doc[row, 1]
                yield out.assign(anchor=mine[row, 0] + doc[row, 1], _k1=k1[doc[row, 0]], _k2=k2[doc[row, 0]])[
                    [c.split()[0] for c in _ROWS.split(", ")]]

    return run


def _settled(rows: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """Two sets of rows: those whose whole string repeats, and those to refine. Rows alone
    with their core are unique and in neither. Of equal strings one goes on for all, as
    others may agree with a part of it."""
    # what is joined with the rows is stored first: a join whose sides are both shuffled for
    # it can have a hot core split by adaptive execution, one on top of a grouping can't
    rows = stored(rows, name)
    company = stored(rows.groupBy("core").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("core"), f"{name}-company")
    rows = stored(rows.join(company, "core", "left_semi"), f"{name}-shared")
    classes = stored(rows.groupBy("core", "outer").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct(*KEY, "anchor", "lo", "hi")).alias("w")), f"{name}-classes")
    repeated = rows.join(classes.where("n > 1").select("core", "outer"), ["core", "outer"], "left_semi")
    mixed = stored(classes.groupBy("core").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("core"), f"{name}-mixed")
    refine = classes.join(mixed, "core", "left_semi").select("w.*")
    return repeated.select(*KEY, "lo", "hi"), refine


def _per_text(rows: DataFrame) -> DataFrame:
    """Open windows of every text; a repeated row brings them once."""
    w = F.collect_set(F.struct("anchor", "lo", "hi"))
    return rows.groupBy(*KEY).agg(w.alias("w")).select(
        *KEY, F.col("w.anchor").alias("anchors"), F.col("w.lo").alias("los"), F.col("w.hi").alias("his"))


def repeated_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, str]:
    """(row key, lo, hi): runs of window starts whose windows repeat; and the name of the
    temporary table, bucketed by row key, with the texts that have any."""
    spark = docs.sparkSession
    small_batches(spark)
    texts = docs.select(*text_key(id_col, text_col), F.col(text_col).alias("text")).where(F.octet_length("text") >= WIDTH)
    whole, refine = _settled(texts.mapInPandas(_start, _ROWS), "anchors")

    name = f"texts_{uuid.uuid4().hex[:12]}"
    n = default_parallelism(spark)
    (texts.join(whole.select(*KEY).unionByName(refine.select(*KEY)).distinct(), KEY, "left_semi").repartition(n, *KEY).write
     .bucketBy(n, *KEY).option("path", scratch_path(spark, name)).saveAsTable(name))
    held = spark.table(name)
    in_blocks, refine = _settled(held.join(_per_text(refine), KEY).mapInPandas(_next("blocks"), _ROWS), "blocks")
    windows = held.join(_per_text(refine), KEY).mapInPandas(_next("windows"), _ROWS)
    windows = stored(windows.select(*KEY, "lo", "core", "outer"), "windows")
    twice = stored(windows.groupBy("core", "outer").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "twice")
    single = windows.join(twice, ["core", "outer"], "left_semi").select(*KEY, "lo", F.col("lo").alias("hi"))
    return whole.unionByName(in_blocks).unionByName(single), name


def removed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", texts: bool = True) -> DataFrame:
    """(row key, spans, n_removed, n_spans, kept, kept_sha256): for every text that loses
    bytes, the removed byte runs as flat (from, to) pairs and the remaining bytes (null
    without ``texts``). Repeated rows have one row here."""
    spark = docs.sparkSession
    windows, name = repeated_windows(docs, id_col, text_col)
    runs = windows.groupBy(*KEY).agg(F.collect_list(F.struct("lo", "hi")).alias("w")).select(
        *KEY, F.col("w.lo").alias("los"), F.col("w.hi").alias("his"))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in batches:
            out = {"spans": [], "n_removed": [], "n_spans": [], "kept": [], "kept_sha256": []}
            for t, lo, hi in zip(arrays.text_bytes(df["text"].tolist()), df["los"], df["his"]):
                s, e = arrays.merged(np.asarray(lo, np.int64), np.asarray(hi, np.int64) + WIDTH)
                kept = b"".join(t[a:b] for a, b in zip(np.r_[0, e].tolist(), np.r_[s, len(t)].tolist()))
                out["spans"].append(np.stack([s, e], 1).ravel())
                out["n_removed"].append(int((e - s).sum()))
                out["n_spans"].append(len(s))
                out["kept"].append(kept if texts else None)
                out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
            yield df[KEY].assign(**out)

    held = spark.table(name).dropDuplicates(KEY)
    out = stored(held.join(runs, KEY).mapInPandas(
        cut, "_k1 long, _k2 long, spans array<long>, n_removed long, n_spans long, kept binary, kept_sha256 string"), "kept")
    spark.sql(f"drop table if exists {name}")
    return out
