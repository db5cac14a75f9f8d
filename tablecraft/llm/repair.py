"""Token-id output compressed by Re-Pair grammars, with random access.

Documents are range-partitioned and sorted by id. Every task encodes its documents with a
tokenizers-library vocabulary, joins the ids (each document followed by an end id) into
shards of about ``shard_ids`` ids, and compresses every shard by itself: count all pairs
of neighbouring symbols, give the most frequent ones new symbols (nonterminals), replace
their occurrences, and repeat on the shorter sequence. A round handles many pairs at
once; where occurrences overlap, the more frequent pair wins, and the rest waits for the
next round. It ends when symbols run out, no pair is frequent enough or a round no
longer pays.

File format: one row per shard (Parquet, so any store Spark writes to), in this order:
``part`` and ``chunk`` (shards ascend by both, and so do the documents), ``ids`` (document
ids), ``offsets`` (first expanded id of each document, and the total), ``base`` (symbols
from it on are rules), ``rules`` (two little-endian 16-bit symbols per rule), ``lengths``
(little-endian 32-bit expansion length per rule), ``symbols`` (16-bit symbols). The
expansion lengths locate any id range without expanding what comes before it.

Encoding looks at distinct pieces only: the vocabulary's pattern splits a text, and equal
pieces have equal ids, so each worker passes a piece to the library once. Texts with
characters outside ASCII and the Latin-1 letters, or with the string of an added token
(<|endoftext|>, which gets its own id), go through the library whole.

Edge cases. Null text: empty, so only the end id. Rows with equal ids are ordered by a
hash of their text; a null id sorts first. Empty table: no files' rows, empty result. A
document longer than a shard gets a shard of its own. Extra columns are ignored.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablecraft.llm import arrays, tokens
from tablecraft.llm.frames import small_batches

SHARD_IDS = 1 << 22
_SYMBOLS = 1 << 16  # symbols are stored in 16 bits


class _Encoder:
    """A vocabulary of the tokenizers library and the pieces met so far."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path) as f:
            spec = json.load(f)
        self.size = self.library.get_vocab_size()
        # splitting by class stands for exactly this normalizer and pattern
        split = json.dumps([spec["normalizer"], spec["pre_tokenizer"]])
        self.by_class = all(x in split for x in ('"Lowercase"', '"NFC"', r"[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"))
        suffix = spec["model"].get("end_of_word_suffix")
        self.by_class = self.by_class and bool(suffix)
        # texts with an added token's string go through the library whole; the lines of
        # pieces that _make sends must never hold one
        added = self.library.get_added_tokens_decoder().values()
        self.added = [t.content for t in added]
        self.by_class = self.by_class and not any(t.normalized or t.content in self._line(t.content) for t in added)
        self.word_end = np.zeros(self.size, bool)
        self.word_end[[i for t, i in self.library.get_vocab().items() if suffix and t.endswith(suffix)]] = True
        self.table = tokens.PieceTable(self._make)

    @staticmethod
    def _line(text: str) -> str:
        """The pieces of a text as a blank-separated line; empty if it can't be split by class."""
        if not tokens.simple(text):
            return ""
        codes, _ = tokens.code_points([text], lower=True)
        return " ".join(tokens.latin_pieces(codes, *tokens.word_pieces(codes)))

    def _make(self, codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pieces go to the library in blank-separated lines; ids are cut where a word ends."""
        pieces = tokens.latin_pieces(codes, starts, ends)
        lines = [" ".join(pieces[i:i + 256]) for i in range(0, len(pieces), 256)]
        ids, _ = self._whole(lines)
        ends_at = np.flatnonzero(self.word_end[ids]) + 1
        return ids, np.diff(np.r_[0, ends_at]).astype(np.int32)

    def _whole(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        lists = [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]
        count = np.fromiter(map(len, lists), np.int32, len(lists))
        return np.fromiter((i for x in lists for i in x), np.int32, int(count.sum())), count

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        out: list[np.ndarray] = [np.zeros(0, np.int32)] * len(texts)
        easy = [i for i, t in enumerate(texts) if self.by_class and tokens.simple(t) and not any(a in t for a in self.added)]
        codes, begin = tokens.code_points([texts[i] for i in easy], lower=True)
        starts, ends = tokens.word_pieces(codes)
        ids, count = self.table.lookup(codes, starts, ends)
        for i, x in zip(easy, np.split(ids, np.cumsum(tokens.per_text(count, starts, begin))[:-1])):
            out[i] = x
        rest = sorted(set(range(len(texts))) - set(easy))
        if rest:
            ids, count = self._whole([texts[i] for i in rest])
            for i, x in zip(rest, np.split(ids, np.cumsum(count)[:-1])):
                out[i] = x
        return out


_loaded: dict[str, _Encoder] = {}


def encoder(path: str) -> _Encoder:
    """The encoder of this process, loaded once."""
    if path not in _loaded:
        _loaded[path] = _Encoder(path)
    return _loaded[path]


def compress(ids: np.ndarray, base: int, min_count: int = 16, per_round: int = 4096,
             least_gain: float = 0.01) -> tuple[np.ndarray, np.ndarray]:
    """(rules, symbols) of a sequence of ids below ``base``: rule r replaces the two
    symbols rules[r] by the symbol base + r. Symbols have 16 bits; more ids than these can
    tell apart are refused."""
    if base >= _SYMBOLS or len(ids) and not 0 <= int(ids.min()) <= int(ids.max()) < base:
        raise ValueError(f"ids must be below the base {base}, and that below {_SYMBOLS}")
    seq = ids.astype(np.uint16)
    rules = np.zeros((0, 2), np.uint16)
    while len(seq) > 1 and base + len(rules) < _SYMBOLS:
        pair = seq[:-1].astype(np.uint32) << np.uint32(16) | seq[1:]
        order = np.sort(pair)
        first = np.flatnonzero(np.r_[True, order[1:] != order[:-1]])
        count = np.diff(np.r_[first, len(order)])
        often = np.flatnonzero(count >= min_count)
        often = often[np.argsort(-count[often], kind="stable")][:min(per_round, _SYMBOLS - base - len(rules))]
        if not len(often):
            break
        chosen = order[first[often]]  # most frequent first
        by_value = np.argsort(chosen)
        known = chosen[by_value]
        left, right = np.zeros(_SYMBOLS, bool), np.zeros(_SYMBOLS, bool)
        left[chosen >> 16], right[chosen & 0xFFFF] = True, True
        maybe = np.flatnonzero(left[seq[:-1]] & right[seq[1:]])
        at = np.searchsorted(known, pair[maybe])
        at[at == len(known)] = 0
        hit = known[at] == pair[maybe]
        # rank + 1 of the chosen pair at each position; less is more frequent
        rank = np.full(len(seq) + 1, len(chosen) + 1, np.int32)
        rank[1:][maybe[hit]] = by_value[at[hit]] + 1
        here, before, after = rank[1:-1], rank[:-2], rank[2:]
        take = np.flatnonzero((here <= len(chosen)) & (here < before) & (here <= after))
        symbol = (base + len(rules) + rank[1:][take] - 1).astype(np.uint16)
        new = seq.copy()
        new[take] = symbol
        keep = np.ones(len(seq), bool)
        keep[take + 1] = False
        rules = np.concatenate([rules, np.stack([chosen >> 16, chosen & 0xFFFF], 1).astype(np.uint16)])
        seq = new[keep]
        if len(take) < least_gain * len(new):
            break
    return rules, seq


def expansion_lengths(rules: np.ndarray, base: int) -> np.ndarray:
    """Number of ids that each rule stands for. Rules only use symbols made before them."""
    out = np.ones(base + len(rules), np.int64)
    for r, (a, b) in enumerate(rules.tolist()):
        out[base + r] = out[a] + out[b]
    return out[base:]


def expand_symbols(symbols: np.ndarray, rules: np.ndarray, base: int) -> np.ndarray:
    """Ids of a run of symbols."""
    seq = symbols
    while True:
        inner = seq >= base
        if not inner.any():
            return seq.astype(np.int64)
        two = rules[seq[inner].astype(np.int64) - base]
        at = np.cumsum(1 + inner) - 1 - inner
        out = np.empty(len(seq) + int(inner.sum()), np.uint16)
        out[at] = seq
        out[at[inner]], out[at[inner] + 1] = two[:, 0], two[:, 1]
        seq = out


class Shard:
    """One row of the file format, decoded on demand."""

    def __init__(self, row: dict):
        self.base = row["base"]
        self.rules = np.frombuffer(row["rules"], "<u2").reshape(-1, 2)
        self.symbols = np.frombuffer(row["symbols"], "<u2")
        self.offsets = np.asarray(row["offsets"], np.int64)
        lengths = np.ones(_SYMBOLS, np.int64)
        lengths[self.base:self.base + len(self.rules)] = np.frombuffer(row["lengths"], "<u4")
        self.ends = np.cumsum(lengths[self.symbols])

    def ids(self, start: int, stop: int) -> np.ndarray:
        """The ids from ``start`` to ``stop``, expanding only the symbols that cover them."""
        if stop <= start:
            return np.zeros(0, np.int64)
        a = int(np.searchsorted(self.ends, start, "right"))
        b = int(np.searchsorted(self.ends, stop, "left")) + 1
        skip = start - (int(self.ends[a - 1]) if a else 0)
        return expand_symbols(self.symbols[a:b], self.rules, self.base)[skip:skip + stop - start]

    def document(self, k: int) -> np.ndarray:
        return self.ids(int(self.offsets[k]), int(self.offsets[k + 1]))


def write_shards(docs: DataFrame, path: str, vocabulary: str, end_id: int, id_col: str = "doc_id",
                 text_col: str = "text", shard_ids: int = SHARD_IDS) -> None:
    """Encode ``docs`` in ascending id order and write them as compressed shards."""
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    narrow = narrow.orderBy(F.col("id").asc_nulls_first(), F.xxhash64("text")).select("id", "text")
    if encoder(vocabulary).size > _SYMBOLS - 1:
        raise ValueError(f"symbols have 16 bits: the vocabulary must have fewer than {_SYMBOLS} ids")
    if not 0 <= end_id < encoder(vocabulary).size:
        raise ValueError("end_id is no id of the vocabulary")
    small_batches(docs.sparkSession)
    id_type = narrow.schema["id"].dataType.simpleString()
    schema = (f"part int, chunk int, ids array<{id_type}>, offsets array<long>, base int, "
              "rules binary, lengths binary, symbols binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        part, chunk = TaskContext.get().partitionId(), 0
        names: list[pa.Array] = []
        held: list[np.ndarray] = []
        size = 0

        def row() -> pa.RecordBatch:
            length = np.fromiter(map(len, held), np.int64, len(held))
            rules, symbols = compress(np.concatenate(held), enc.size)
            name = pa.concat_arrays(names)
            return pa.RecordBatch.from_arrays([
                pa.array([part], pa.int32()), pa.array([chunk], pa.int32()),
                pa.ListArray.from_arrays(pa.array([0, len(name)], pa.int32()), name),
                pa.array([np.r_[0, np.cumsum(length)]], pa.list_(pa.int64())),
                pa.array([enc.size], pa.int32()),
                pa.array([rules.astype("<u2").tobytes()], pa.binary()),
                pa.array([expansion_lengths(rules, enc.size).astype("<u4").tobytes()], pa.binary()),
                pa.array([symbols.astype("<u2").tobytes()], pa.binary()),
            ], ["part", "chunk", "ids", "offsets", "base", "rules", "lengths", "symbols"])

        end = np.array([end_id], np.int32)
        for batch in batches:
            texts = ["" if t is None else t for t in batch.column(1).to_pylist()]
            first = 0
            while first < len(texts):
                last, n = first, 0
                while last < len(texts) and (n == 0 or n + len(texts[last]) <= 2 * arrays.SLICE_BYTES):
                    n += len(texts[last]) + 1
                    last += 1
                for ids in enc.encode(texts[first:last]):
                    held += [np.concatenate([ids, end])]
                    size += len(ids) + 1
                names.append(batch.column(0).slice(first, last - first))
                first = last
                if size >= shard_ids:
                    yield row()
                    names, held, size, chunk = [], [], 0, chunk + 1
        if held:
            yield row()

    narrow.mapInArrow(run, schema).write.parquet(path)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """(id, start, n_tokens, ids) of every document in the files at ``path``; ``start``
    counts the ids of all documents before it."""
    small_batches(spark)
    shards = spark.read.parquet(path)
    total = F.element_at("offsets", -1)
    # one narrow row per shard
    before = shards.select("part", "chunk", total.alias("n")).select("part", "chunk", F.coalesce(
        F.sum("n").over(Window.orderBy("part", "chunk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    id_type = shards.schema["ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {k: batch.column(k)[i].as_py() for k in ("part", "chunk", "base", "rules", "lengths", "symbols", "offsets")}
                shard, n = Shard(row), len(batch.column("ids")[i])
                names = batch.column("ids")[i].values
                step = max(1, n * arrays.SLICE_BYTES // max(1, int(shard.offsets[-1])))
                for a in range(0, n, step):
                    b = min(n, a + step)
                    off = shard.offsets[a:b + 1]
                    ids = shard.ids(int(off[0]), int(off[-1])).astype(np.int32)
                    yield pa.RecordBatch.from_arrays([
                        pa.array([row["part"]] * (b - a), pa.int32()), pa.array([row["chunk"]] * (b - a), pa.int32()),
                        names.slice(a, b - a), pa.array(off[:-1]), pa.array(np.diff(off)),
                        pa.ListArray.from_arrays(pa.array((off - off[0]).astype(np.int32)), pa.array(ids)),
                        pa.array([zlib.crc32(ids[x:y].astype("<u4").tobytes()) for x, y in zip((off[:-1] - off[0]).tolist(), (off[1:] - off[0]).tolist())], pa.int64()),
                    ], ["part", "chunk", "id", "local", "n_tokens", "ids", "ids_crc32"])

    rows = shards.mapInArrow(run, f"part int, chunk int, id {id_type}, local long, n_tokens long, ids array<int>, ids_crc32 long")
    return rows.join(before, ["part", "chunk"]).select(
        "id", (F.col("before") + F.col("local")).alias("start"), "n_tokens", "ids", "ids_crc32")
