"""Ranked lexical search by NRA: sorted reads only, with score intervals per document.

Every query term has a list of the documents that hold it, in falling order of impact (its
share of a score before the term's weight). NRA (no random access) reads the lists of a
query side by side from the top. What it has read of a document is the lower end of the
document's score; the upper end adds, for every list that the document was not met in, the
impact at which that list stands. Reading goes on until no document outside the best ``k``
can reach them, ties included, and the scores of the best are no intervals any more.

Spark partitions the documents. A task takes its documents in shards of ``shard``, orders
their lists by impact and runs NRA for every query; a document's score depends on corpus
totals that were counted over all documents before, so shards need nothing of each other.
Two passes share the work between them: the first reads the tops of the lists and returns
lower ends, whose k-th best of all shards is a floor that no result can fall under; the
second runs to the end, and a shard without a document above the floor stops at once. What
leaves a shard is at most ``k`` rows a query, so nothing gathers in a hot term or query.

Queries go through in blocks of at most ``_BLOCK_BYTES`` of text (a larger one is a block
of its own), so what is broadcast (the block's terms and weights) is bounded; the documents
are tokenised once a block.

Scores are 64-bit integers (see :func:`search`).

Edge cases. Null or empty texts have no terms: such documents are never found and do not
count in N, such queries find nothing. Repeated documents or queries are rows of their own;
documents of equal score and id are ordered at will, as they do not differ. A null id sorts
before all others. Very long texts are split into words by parts. Empty tables: empty
result. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructType

from tablecraft.llm import arrays
from tablecraft.llm.frames import small_batches, stored

_SHARD = 4096  # documents whose lists are read together
_TOP = 32  # entries of every list in the first round; each round reads twice as many
_BLOCK_BYTES = 1 << 20
_PART = 1 << 20  # bytes of a text that are split at a time
_BLANK = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms(text: str | None) -> Iterator[list[bytes]]:
    """The words of a text in order: runs of ASCII letters and digits (A-Z lowered) and
    of characters beyond ASCII. Long texts come in several lists."""
    raw = (text or "").encode("utf-8", "surrogatepass").translate(_BLANK)
    at = 0
    while at < len(raw):
        to = raw.find(b" ", at + _PART)
        to = len(raw) if to < 0 else to
        yield raw[at:to].split()
        at = to


def weight(n_docs: int, df: int) -> int:
    """A term's weight: floor(1000 * ln((2 N + 2) / (2 df + 1)))."""
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _forward(docs: DataFrame, id_col: str, text_col: str, number: dict[bytes, int]) -> DataFrame:
    """(id, n, terms, tfs): number of terms of every document, and those of ``number``."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(number)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = shared.value.get
        for batch in batches:
            n, found, tfs, cuts = [], [np.zeros(0, np.int32)], [np.zeros(0, np.int64)], [0]
            for text in batch.column(1):
                total, parts = 0, []
                for words in terms(text.as_py()):
                    total += len(words)
                    parts.append(np.fromiter(map(get, words, repeat(-1)), np.int32, len(words)))
                ids, tf = np.unique(np.concatenate(parts) if parts else np.zeros(0, np.int32), return_counts=True)
                first = int(np.searchsorted(ids, 0))
                n.append(total)
                found.append(ids[first:])
                tfs.append(tf[first:])
                cuts.append(cuts[-1] + len(ids) - first)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(n, pa.int64()),
                pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(np.concatenate(found), pa.int32())),
                pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(np.concatenate(tfs), pa.int64())),
            ], ["id", "n", "terms", "tfs"])
        arrays.release()

    schema = StructType().add("id", docs.schema[id_col].dataType).add("n", LongType())
    schema = schema.add("terms", ArrayType(IntegerType())).add("tfs", ArrayType(LongType()))
    return docs.select(id_col, text_col).mapInArrow(run, schema)


class _Lists:
    """Impact-sorted lists of a shard's documents."""

    def __init__(self, n: np.ndarray, counts: np.ndarray, term: np.ndarray, tf: np.ndarray, n_terms: int, n_docs: int, total: int):
        m = 100 - 75 + (75 * n * n_docs) // max(total, 1)
        doc = np.repeat(np.arange(len(n)), counts)
        impact = (1_000_000_000 * tf) // (1000 * tf + 8 * m[doc])
        order = np.lexsort((-impact, term))
        self.doc, self.impact = doc[order].astype(np.int32), impact[order]
        self.cut = np.searchsorted(term[order], np.arange(n_terms + 1))
        self.n_docs = len(n)

    def search(self, query: np.ndarray, factor: np.ndarray, k: int, floor: int, rounds: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Documents and lower score ends: after ``rounds`` rounds the best ``k``, else
        all that are among the best ``k`` of the shard and reach ``floor``, their scores final."""
        at, end = self.cut[query], self.cut[query + 1]
        live = (end > at) & (factor > 0)
        at, end, factor = at[live], end[live], factor[live]
        lower = np.zeros(self.n_docs, np.int64)
        met_doc, met_list = [], []
        step, best = _TOP, floor
        while len(at):
            to = np.minimum(at + step, end)
            read = arrays.expand(at, to - at)
            met_doc.append(self.doc[read])
            met_list.append(np.repeat(np.arange(len(at)), to - at))
            np.add.at(lower, met_doc[-1], self.impact[read] * factor[met_list[-1]])
            at, step = to, 2 * step
            # no unread entry of a list is above its last read one
            bound = np.where(at < end, self.impact[at - 1] * factor, 0)
            if self.n_docs > k:
                best = max(floor, int(np.partition(lower, -k)[-k]))
            rounds = rounds and rounds - 1
            if rounds == 0 or not bound.any():
                break
            if bound.sum() < best:  # a document that was not met stays below the best
                rest = np.full(self.n_docs, bound.sum())
                np.subtract.at(rest, np.concatenate(met_doc), bound[np.concatenate(met_list)])
                if not ((lower + rest >= best) & (rest > 0)).any():
                    break
        found = np.flatnonzero((lower >= best) & (lower > 0))
        return found, lower[found]


def _shards(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.Table]:
    held, rows = [], 0
    for b in batches:
        held.append(b)
        rows += b.num_rows
        if rows >= size:
            yield pa.Table.from_batches(held).combine_chunks()
            held, rows = [], 0
    if rows:
        yield pa.Table.from_batches(held).combine_chunks()


def _pass(index: DataFrame, queries: list[tuple[int, np.ndarray, np.ndarray]], n_terms: int, n_docs: int, total: int,
          k: int, floors: np.ndarray | None, shard: int) -> DataFrame:
    """(query, id, score) from every shard: with ``floors`` the results, else lower ends."""
    shared = index.sparkSession.sparkContext.broadcast((queries, floors))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, floors = shared.value
        for t in _shards(batches, shard):
            term, tf = (t[c].combine_chunks() for c in ("terms", "tfs"))
            counts = np.diff(term.offsets.to_numpy())
            lists = _Lists(t["n"].to_numpy(), counts, term.flatten().to_numpy(), tf.flatten().to_numpy(), n_terms, n_docs, total)
            query, doc, score = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for q, numbers, factor in queries:
                d, s = lists.search(numbers, factor, k, 0 if floors is None else int(floors[q]), 2 if floors is None else None)
                if len(d) > k:  # ties at the end: the smallest ids
                    rows = pa.table({"s": s, "id": t["id"].take(pa.array(d))})
                    first = pc.sort_indices(rows, sort_keys=[("s", "descending"), ("id", "ascending")], null_placement="at_start")
                    first = first.to_numpy()[:k]
                    d, s = d[first], s[first]
                query.append(np.full(len(d), q))
                doc.append(d)
                score.append(s)
            query, doc, score = map(np.concatenate, (query, doc, score))
            yield pa.RecordBatch.from_arrays([pa.array(query), t["id"].combine_chunks().take(pa.array(doc)), pa.array(score)], ["query", "id", "score"])
        arrays.release()

    schema = StructType().add("query", LongType()).add("id", index.schema["id"].dataType).add("score", LongType())
    return index.mapInArrow(run, schema)


def _blocks(items: DataFrame) -> Iterator[list[tuple]]:
    """Rows (item, text) in blocks of bounded text; one partition at a time is here."""
    held, size = [], 0
    for row in items.toLocalIterator():
        n = len(row[1] or "")
        if held and size + n > _BLOCK_BYTES:
            yield held
            held, size = [], 0
        held.append((row[0], row[1]))
        size += n
    if held:
        yield held


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_first("id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text", shard: int = _SHARD) -> DataFrame:
    """(item, rank, id, score): the ``k`` best documents of every item, by score, then id.

    With N documents that have terms, L terms in all, df documents holding a term, and n
    terms in a document, tf of them a given term: the document's score sums, over the item's
    terms with repeats, ``weight(N, df) * (10**9 * tf // (1000 * tf + 8 * m))`` where
    ``m = 25 + 75 * n * N // L``."""
    spark = docs.sparkSession
    small_batches(spark)
    out = None
    for block in _blocks(items.select(item_col, item_text_col)):
        counted = [(item, Counter(chain.from_iterable(terms(text)))) for item, text in block]
        number = {t: i for i, t in enumerate(sorted({t for _, c in counted for t in c}))}
        index = stored(_forward(docs, id_col, text_col, number), "postings")
        n_docs, total = index.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
        # one row per term of the block
        df = dict(index.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1))).collect())
        w = np.array([weight(n_docs, df[i]) if i in df else 0 for i in range(len(number))], np.int64)
        queries = []
        for q, (_, c) in enumerate(counted):
            at = np.array([number[t] for t in c], np.int64)
            queries.append((q, at, w[at] * np.array(list(c.values()), np.int64)))
        tops = _best(_pass(index, queries, len(number), n_docs, total, k, None, shard).select("query", "id", "score"), k)
        floors = np.zeros(len(block), np.int64)
        for q, s in tops.where(F.col("rank") == k).select("query", "score").collect():  # one row per item
            floors[q] = s
        best = _best(_pass(index, queries, len(number), n_docs, total, k, floors, shard), k)
        names = spark.createDataFrame(
            [(q, item) for q, (item, _) in enumerate(block)],
            StructType().add("query", LongType()).add("item", items.schema[item_col].dataType))
        rows = best.join(F.broadcast(names), "query").select("item", "rank", "id", "score")
        out = rows if out is None else out.unionByName(rows)
    if out is None:
        schema = StructType().add("item", items.schema[item_col].dataType).add("rank", IntegerType())
        out = spark.createDataFrame([], schema.add("id", docs.schema[id_col].dataType).add("score", LongType()))
    return out
