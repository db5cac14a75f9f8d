"""Byte-level BPE encoding and decoding by recursive DuckDB queries inside tasks.

Every task splits its texts by the vocabulary's pattern and hands the distinct pieces it
has not met before to an in-process DuckDB. There a piece is a set of (word, position,
token id) rows; each step of a recursive query joins neighbouring rows with the merge
table, finds every word's pair of least rank (the leftmost of equals) and contracts it,
until a word has no pair in the table and leaves the recursion. A piece that is itself a
token is taken whole first, as the tiktoken library does. Decoding joins token rows with
the vocabulary and aggregates the bytes of each text in position order.

Spark partitions the texts; no row leaves its task. The vocabulary file is read once per
Python worker from ``vocabulary`` (a path that every worker can open, like any installed
package data). Memory per worker: two tables of known pieces (at most ``PieceTable.limit``
bytes each, kept for the worker's next task) and one DuckDB of at most 250 MB that may not spill.

Edge cases. Null and empty texts have no ids and decode to no bytes. Ids and bytes of a
text never depend on its neighbours in the batch. A piece of n bytes without white space
takes up to n steps over its rows, so a single unbroken run of n letters costs n * n / 2.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from tablecraft.llm import arrays, tokens
from tablecraft.llm.frames import small_batches

#: Distinct pieces per recursive query, and bytes (token rows at the start).
_WORDS, _ROWS = 20_000, 250_000

_MERGE = """
with recursive t(word, pos, id, open) as (
  select word, pos, id, true from pieces
  union all
  select word, pos, case when pos = (best & 4294967295) then best >> 32 else id end, best is not null
  from (
    select word, pos, id, before, min(pair) over (partition by word) as best
    from (
      select n.word, n.pos, n.id, n.before, (m.rank::bigint << 32) | n.pos as pair
      from (
        select word, pos, id, lead(id) over w as after, lag(pos) over w as before
        from t where open window w as (partition by word order by pos)) n
      left join merges m on m.pair = ((n.id::bigint << 20) | n.after)))
  where best is null or before is distinct from (best & 4294967295))
select word, pos, id::integer as id from t where not open order by word, pos
"""

_DECODE = """
select r.text, string_agg(v.bytes, '' order by r.pos) as decoded
from ids r join vocabulary v on v.id = r.id group by r.text order by r.text
"""


class _Bpe:
    """Vocabulary, merge table and piece table of one worker process."""

    def __init__(self, path: str, pattern: str):
        import regex

        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(t): int(r) for t, r in (line.split() for line in f if line.strip())}
        self.byte = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self.pattern = regex.compile(pattern)
        self.opened = None
        self.begins = np.zeros(max(self.ranks.values()) + 1, bool)
        self.begins[[r for t, r in self.ranks.items() if t[:1] == b" "]] = True
        self.table = tokens.PieceTable(lambda *runs: self.encode_pieces([p.encode() for p in tokens.latin_pieces(*runs)]))
        self.words = tokens.PieceTable(self.decode_runs, np.uint8)

    @property
    def db(self):
        """The DuckDB of the running task, with the merge table and the vocabulary."""
        if self.opened is None:
            import duckdb

            pairs = np.array([
                (self.ranks[t[:i]] << 20 | self.ranks[t[i:]], rank)
                for t, rank in self.ranks.items() for i in range(1, len(t))
                if t[:i] in self.ranks and t[i:] in self.ranks
            ], np.int64)
            self.opened = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "250MB", "temp_directory": ""})
            self.opened.register("m", pa.table({"pair": pairs[:, 0], "rank": pairs[:, 1].astype(np.int32)}))
            # every byte is one character here, so that text aggregation puts bytes together
            self.opened.register("v", pa.table({
                "id": np.array(list(self.ranks.values()), np.int32), "bytes": [t.decode("latin-1") for t in self.ranks]}))
            self.opened.execute("create table merges as from m; create table vocabulary as from v")
        return self.opened

    def close(self) -> None:
        """End of a task: the vocabulary and the bounded tables of pieces stay in the worker,
        for its next task."""
        if self.opened is not None:
            self.opened.close()
            self.opened = None
        arrays.release()

    def encode_pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all the pieces, concatenated, and the number of ids of each."""
        whole = np.fromiter((self.ranks.get(p, -1) for p in pieces), np.int32, len(pieces))
        out: list[np.ndarray] = [None] * len(pieces)
        rest = np.flatnonzero(whole < 0)
        size = np.fromiter((len(pieces[i]) for i in rest), np.int64, len(rest))
        group = np.maximum(np.cumsum(size) // _ROWS, np.arange(len(rest)) // _WORDS)
        for part in np.split(rest, np.flatnonzero(np.diff(group)) + 1):
            if not len(part):
                continue
            length = np.fromiter((len(pieces[i]) for i in part), np.int64, len(part))
            raw = np.frombuffer(b"".join(pieces[i] for i in part), np.uint8)
            rows = pa.table({
                "word": np.repeat(np.arange(len(part), dtype=np.int32), length),
                "pos": arrays.expand(np.zeros(len(part), np.int64), length).astype(np.int32),
                "id": self.byte[raw],
            })
            self.db.register("pieces", rows)
            got = self.db.execute(_MERGE).fetchnumpy()
            self.db.unregister("pieces")
            cuts = np.searchsorted(got["word"], np.arange(1, len(part)))
            for i, ids in zip(part, np.split(got["id"], cuts)):
                out[i] = ids
        for i in np.flatnonzero(whole >= 0):
            out[i] = whole[i:i + 1]
        count = np.fromiter(map(len, out), np.int32, len(out))
        return (np.concatenate(out) if out else np.zeros(0, np.int32)), count

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        out: list[np.ndarray] = [np.zeros(0, np.int32)] * len(texts)
        easy = [i for i, t in enumerate(texts) if tokens.simple(t)]
        codes, begin = tokens.code_points([texts[i] for i in easy])
        starts, ends = tokens.byte_pieces(codes)
        ids, count = self.table.lookup(codes, starts, ends)
        for i, x in zip(easy, np.split(ids, np.cumsum(tokens.per_text(count, starts, begin))[:-1])):
            out[i] = x
        for i in sorted(set(range(len(texts))) - set(easy)):
            pieces = [p.encode("utf-8", "surrogatepass") for p in self.pattern.findall(texts[i])]
            distinct = list(dict.fromkeys(pieces))
            ids, count = self.encode_pieces(distinct)
            by_piece = dict(zip(distinct, np.split(ids, np.cumsum(count)[:-1])))
            out[i] = np.concatenate([by_piece[p] for p in pieces]) if pieces else out[i]
        return out

    def decode_runs(self, ids: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of runs of ids, concatenated, and the number of bytes of each."""
        length = ends - starts
        rows = pa.table({
            "text": np.repeat(np.arange(len(starts), dtype=np.int32), length),
            "pos": arrays.expand(np.zeros(len(starts), np.int64), length).astype(np.int32),
            "id": ids[arrays.expand(starts, length)],
        })
        self.db.register("ids", rows)
        parts = [s.encode("latin-1") for _, s in self.db.execute(_DECODE).fetchall()]
        self.db.unregister("ids")
        return np.frombuffer(b"".join(parts), np.uint8), np.fromiter(map(len, parts), np.int32, len(parts))

    def decode(self, texts: list[np.ndarray]) -> list[bytes]:
        """Bytes of each text. The ids are cut before every token that begins with a
        blank (roughly words), so that equal runs are decoded once."""
        length = np.fromiter(map(len, texts), np.int64, len(texts))
        if not length.sum():
            return [b""] * len(texts)
        ids = np.concatenate(texts).astype(np.int32)
        begin = np.cumsum(length) - length
        cut = self.begins[ids]
        cut[begin[length > 0]] = True
        starts = np.flatnonzero(cut)
        raw, count = self.words.lookup(ids, starts, np.r_[starts[1:], len(ids)])
        ends = np.cumsum(tokens.per_text(count, starts, begin))
        whole = raw.tobytes()
        return [whole[a:b] for a, b in zip(np.r_[0, ends[:-1]].tolist(), ends.tolist())]


_loaded: dict[tuple[str, str], _Bpe] = {}


def bpe(path: str, pattern: str) -> _Bpe:
    """The coder of this process, loaded once."""
    if (path, pattern) not in _loaded:
        _loaded[path, pattern] = _Bpe(path, pattern)
    return _loaded[path, pattern]


def _groups(sizes: list[int], limit: int) -> Iterator[slice]:
    first, held = 0, 0
    for i, n in enumerate(sizes):
        if i > first and held + n > limit:
            yield slice(first, i)
            first, held = i, 0
        held += n
    if first < len(sizes):
        yield slice(first, len(sizes))


def _encoded(s: pd.Series, vocabulary: str, pattern: str) -> list[np.ndarray]:
    texts = ["" if t is None else t for t in s.tolist()]
    out: list[np.ndarray] = []
    for part in _groups([len(t) for t in texts], arrays.SLICE_BYTES):
        out += bpe(vocabulary, pattern).encode(texts[part])
    return out


def _decoded(lists: list[np.ndarray], vocabulary: str, pattern: str) -> list[bytes]:
    out: list[bytes] = []
    for part in _groups([len(x) for x in lists], arrays.SLICE_BYTES // 2):
        out += bpe(vocabulary, pattern).decode(lists[part])
    return out


def encoded(text: Column | str, vocabulary: str, pattern: str) -> Column:
    """Token ids (array of int) of a text column."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield pd.Series(_encoded(s, vocabulary, pattern), dtype=object)
        bpe(vocabulary, pattern).close()

    small_batches()
    return F.pandas_udf(run, "array<int>")(text)


def decoded(ids: Column | str, vocabulary: str, pattern: str) -> Column:
    """Bytes of the texts whose ids a column holds; null is no ids."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            lists = [np.zeros(0, np.int32) if x is None else np.asarray(x, np.int32) for x in s.tolist()]
            yield pd.Series(_decoded(lists, vocabulary, pattern), dtype=object)
        bpe(vocabulary, pattern).close()

    small_batches()
    return F.pandas_udf(run, "binary")(ids)


def round_trip(text: Column | str, vocabulary: str, pattern: str) -> Column:
    """Struct of the ids of a text column and the bytes that these decode to, in one pass,
    so that a task needs one Python worker."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in batches:
            ids = _encoded(s, vocabulary, pattern)
            yield pd.DataFrame({"ids": ids, "decoded": _decoded(ids, vocabulary, pattern)})
        bpe(vocabulary, pattern).close()

    small_batches()
    return F.pandas_udf(run, "ids array<int>, decoded binary")(text)
