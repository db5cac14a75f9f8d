"""Near-duplicate documents by min-max hashing, confirmed on full shingle sets.

Method. Every document becomes the set of its distinct word shingles (64-bit hashes).
One multiplication per permutation and shingle gives two signature values, the minimum
and the maximum under that permutation, so ``permutations`` hash evaluations yield
``2 * permutations`` values. Bands of ``rows`` values name buckets; documents that share
a bucket are candidates. With 64 permutations and 4 rows there are 32 bands, and a pair at
similarity 0.8 is missed with probability (1 - 0.8**4)**32 = 5e-8.

Equal sets collapse to one node first, so exact copies cost one row each. The smallest
document of a bucket is its hub, and all documents that share a bucket meet again under
its hub, where the full sets are compared. A hub's documents are cut into blocks of a few
MB of shingles, and every pair of blocks is one work item, so no task holds more than two
blocks. Within an item a document is compared with all others at once; documents that
are already connected need no comparison, and an item returns only the links that connect
its components (fewer than its documents), never all pairs. No candidate pair that could
change the components is left out. Links then join in rounds (``components``).

Edge cases. Null or blank text: the empty set, linked with nothing, its own component.
Fewer words than the shingle length: the whole sequence is one shingle. Repeated rows and
equal texts: one node; ties go to the smallest id. Null id: kept in the output; it never
becomes the name of a component that has another id (its component is null only when all
members lack an id). Empty table: empty result. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablecraft.llm import arrays
from tablecraft.llm.components import components
from tablecraft.llm.frames import small_batches, stored, unused

_U = np.uint64
_SPACE = np.ones(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
_BLOCK = 1 << 19  # shingles of a block of documents that are compared in one task
_CHUNK = 1 << 15  # shingles hashed at a time: the work array stays in the CPU cache


def shingle_sets(texts: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of every text, sorted within the text, and the number of
    shingles of every text."""
    low, is_word = arrays.ascii_lower(), _SPACE
    buf, begin = arrays.joined(texts)
    starts, ends = arrays.words(buf, is_word)
    hashed = arrays.run_hashes(low[buf], starts, ends)
    first = np.searchsorted(starts, begin)
    n_words = np.diff(np.append(first, len(starts)))
    n = np.maximum(n_words - size + 1, np.minimum(n_words, 1))
    at = arrays.expand(first, n)
    length = np.repeat(np.minimum(n_words, size), n)
    out = length.astype(_U)
    for k in range(size):
        inside = k < length
        step = np.where(inside, hashed[np.minimum(at + k, max(len(hashed) - 1, 0))], _U(0)) if len(hashed) else out
        out = arrays.mix(out * _U(0xD6E8FEB86659FD93) + step)
    ends_at = np.cumsum(n)
    counts = np.empty(len(texts), np.int64)
    keep = []
    for i, (s, e) in enumerate(zip(ends_at - n, ends_at)):
        u = np.unique(out[s:e])
        counts[i] = len(u)
        keep.append(u)
    return (np.concatenate(keep) if keep else out), counts


def multipliers(n: int, seed: int = 5) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 63, n, dtype=_U) * _U(2) + _U(1)


def min_max(shingles: np.ndarray, counts: np.ndarray, mult: np.ndarray) -> np.ndarray:
    """Signature matrix (texts x 2 * permutations): minima, then maxima. Rows of texts
    without shingles are left at the neutral values."""
    n = len(mult)
    out = np.empty((len(counts), 2 * n), _U)
    out[:, :n], out[:, n:] = _U(0xFFFFFFFFFFFFFFFF), _U(0)
    full = np.flatnonzero(counts)
    ends = np.cumsum(counts)[full]
    starts = ends - counts[full]
    at = 0
    while at < len(full):
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + _CHUNK)))
        lo, hi = int(starts[at]), int(ends[to - 1])
        for a in range(lo, hi, 32 * _CHUNK):  # a very long text comes in pieces
            b = min(hi, a + 32 * _CHUNK)
            part, cuts = shingles[a:b], np.maximum(starts[at:to] - a, 0)
            work = np.empty_like(part)
            for p in range(n):
                np.multiply(part, mult[p], out=work)
                rows = full[at:to]
                out[rows, p] = np.minimum(out[rows, p], np.minimum.reduceat(work, cuts))
                out[rows, n + p] = np.maximum(out[rows, n + p], np.maximum.reduceat(work, cuts))
        at = to
    return out


def _signed(s: pd.Series, size: int, permutations: int, rows: int) -> pd.DataFrame:
    mult = multipliers(permutations)
    n_bands = 2 * permutations // rows
    out = []
    for _, texts in arrays.slices(s.tolist()):
        sh, counts = shingle_sets(texts, size)
        sig = min_max(sh, counts, mult)
        total = np.concatenate([np.zeros((1, 2), _U), np.cumsum(
            np.stack([arrays.mix(sh), arrays.mix(sh ^ _U(0x5851F42D4C957F2D))], 1), axis=0, dtype=_U)])
        ends = np.cumsum(counts)
        sums = total[ends] - total[ends - counts]  # order-free hash of the whole set
        band = np.repeat(np.arange(1, n_bands + 1, dtype=_U)[None], len(counts), 0)
        for r in range(rows):
            band = arrays.mix(band * _U(0xD6E8FEB86659FD93) + sig[:, r:n_bands * rows:rows])
        raw = sums.astype(">u8").tobytes()
        out.append(pd.DataFrame({
            "n_shingles": counts,
            "node": [raw[16 * i:16 * i + 16] for i in range(len(counts))],
            "bands": list(band.view(np.int64)),
        }))
    return pd.concat(out, ignore_index=True) if out else pd.DataFrame({"n_shingles": [], "node": [], "bands": []})


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5,
               permutations: int = 64, rows: int = 4) -> DataFrame:
    """(id, row_key, n_shingles, node, bands) per row of ``docs``; ``node`` names the
    shingle set, ``row_key`` hashes id and text."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in batches:
            yield _signed(s, shingle, permutations, rows)
        arrays.release()

    udf = F.pandas_udf(run, "n_shingles long, node binary, bands array<long>")
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return narrow.select("id", _row_key(), udf("text").alias("_s")).select("id", "row_key", "_s.*")


def _row_key(id_col: str = "id", text_col: str = "text"):
    """128 bits that name a row by its id and whole text."""
    halves = F.xxhash64(F.lit(1), F.col(id_col), F.col(text_col)), F.xxhash64(F.lit(2), F.col(text_col), F.col(id_col))
    return F.unhex(F.concat(*[F.lpad(F.hex(h), 16, "0") for h in halves])).alias("row_key")


def _sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(node, shingles) of the documents whose row_key is in ``wanted`` (node, row_key)."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            out = []
            for _, texts in arrays.slices(s.tolist()):
                sh, counts = shingle_sets(texts, shingle)
                out += np.split(sh.view(np.int64), np.cumsum(counts)[:-1])
            yield pd.Series(out, dtype=object)
        arrays.release()

    udf = F.pandas_udf(run, "array<long>")
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).select(_row_key(), "text")
    found = narrow.join(wanted, "row_key").dropDuplicates(["row_key"])
    return found.select("node", udf("text").alias("shingles"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5,
                    similarity_pct: int = 80, permutations: int = 64, rows: int = 4) -> DataFrame:
    """(id, row_key, n_shingles, component, kept) per row of ``docs``. Documents are linked
    when 100 * |A and B| >= similarity_pct * |A or B|; ``component`` is the smallest id
    reachable over links."""
    return _grouped(docs, id_col, text_col, shingle, similarity_pct, permutations, rows).drop("root")


def _grouped(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5,
             similarity_pct: int = 80, permutations: int = 64, rows: int = 4) -> DataFrame:
    """``near_duplicates`` with the node ``root`` that names a row's component whatever the
    ids in it; null for rows without words, which are in no component."""
    small_batches(docs.sparkSession)
    sig = stored(signatures(docs, id_col, text_col, shingle, permutations, rows), "signatures")
    nodes = stored(
        sig.where("n_shingles > 0").groupBy("node").agg(
            F.min("id").alias("id"), F.min("row_key").alias("row_key"), F.count(F.lit(1)).alias("copies"),
            F.first("n_shingles").alias("n"), F.first("bands").alias("bands")), "nodes")
    members = nodes.select("node", "id", "n", F.explode("bands").alias("bucket"))
    # stored first, so that adaptive execution can split a hot bucket in the join
    shared = stored(members.groupBy("bucket").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("bucket"), "shared")
    members = stored(members.join(shared, "bucket", "left_semi"), "members")
    if members.isEmpty():
        roots = members.select("node", F.col("node").alias("root"))
    else:
        wanted = nodes.select("node", "row_key").join(members.select("node").distinct(), "node", "left_semi")
        sets = stored(_sets(docs, wanted, id_col, text_col, shingle), "sets")
        roots = _linked(members, sets, similarity_pct)
    in_group = nodes.join(roots, "node", "left").where("copies > 1 or root is not null").select(
        "node", "id", F.coalesce("root", "node").alias("root"))
    # a root has no row of its own in ``roots`` when it has no copies
    in_group = in_group.unionByName(
        nodes.join(roots.select(F.col("root").alias("node")).distinct(), "node", "left_semi")
        .where("copies = 1").select("node", "id", F.col("node").alias("root")))
    smallest = in_group.groupBy("root").agg(F.min("id").alias("component"))
    named = stored(in_group.join(smallest, "root").select("node", "root", "component"), "classes")
    out = sig.select("id", "row_key", "n_shingles", "node").join(named, "node", "left")
    return out.select("id", "row_key", "n_shingles", F.coalesce("component", "id").alias("component"),
                      F.expr("coalesce(component, id) <=> id").alias("kept"),
                      F.when(F.col("n_shingles") > 0, F.coalesce("root", "node")).alias("root"))


def survivors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one document of every group: the one with the smallest id, one row of
    it. Documents without an id give way to any other of their group. Of several texts
    under the smallest id (or all without one) the least by hash of id and text stays."""
    out = stored(_grouped(docs, id_col, text_col, **options), "groups")
    key = unused(docs, "row_key")
    kept = out.where("kept and root is not null")
    several = kept.groupBy("root").agg(F.min("row_key").alias("least"), F.max("row_key").alias("most")).where("least < most")
    others = kept.join(several, "root").where("row_key <> least").select("row_key")
    gone = out.where("not kept").select("row_key").unionByName(others).select(F.col("row_key").alias(key)).distinct()
    kept = docs.withColumn(key, _row_key(id_col, text_col)).join(gone, key, "left_anti")
    repeated = out.where("kept").groupBy("row_key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if not repeated.isEmpty():
        kept = kept.dropDuplicates([key])
    return kept.select(*docs.columns)


def _linked(members: DataFrame, sets: DataFrame, pct: int) -> DataFrame:
    """(node, root) for the nodes of ``members`` that are linked with a smaller one."""
    # the smallest id of a bucket is its hub; documents that share a bucket share its hub
    hubs = stored(members.groupBy("bucket").agg(F.min(F.struct("id", "node"))["node"].alias("hub")), "bucket-hubs")
    pairs = stored(members.join(hubs, "bucket").select("hub", "node", "n").distinct(), "hubs")
    blocks = pairs.groupBy("hub").agg(F.ceil(F.sum("n") / _BLOCK).cast("int").alias("blocks"))
    mine = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    dealt = pairs.join(blocks, "hub").select("hub", "node", mine.alias("i"), F.explode(
        F.sequence(F.lit(0), F.col("blocks") - 1)).alias("j"))
    dealt = dealt.select("hub", "node", F.least("i", "j").alias("i"), F.greatest("i", "j").alias("j"))
    rows = dealt.join(sets, "node").select("hub", "i", "j", "node", "shingles")
    rows = rows.repartition("hub", "i", "j").sortWithinPartitions("hub", "i", "j", "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for nodes, shingles in _groups(batches):
            links = spanning_links(shingles, pct)
            if links:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([nodes[x] for x, _ in links], pa.binary()), pa.array([nodes[y] for _, y in links], pa.binary())],
                    ["a", "b"])

    return components(stored(rows.mapInArrow(run, "a binary, b binary"), "links"))


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[bytes], list[np.ndarray]]]:
    """Nodes and shingle sets of each (hub, i, j), from rows sorted by them."""
    key, nodes, sets = None, [], []
    for batch in batches:
        keys = list(zip(*(batch.column(c).to_pylist() for c in ("hub", "i", "j"))))
        names = batch.column("node").to_pylist()
        lists = batch.column("shingles")
        flat, at = lists.flatten().to_numpy(), np.r_[0, np.cumsum(lists.value_lengths().to_numpy())]
        for r, k in enumerate(keys):
            if k != key:
                if len(nodes) > 1:
                    yield nodes, sets
                key, nodes, sets = k, [], []
            nodes.append(names[r])
            sets.append(flat[at[r]:at[r + 1]].copy())
    if len(nodes) > 1:
        yield nodes, sets


def spanning_links(sets: list[np.ndarray], pct: int) -> list[tuple[int, int]]:
    """Links between members of a group that connect all its components: one member after
    the other is compared with all the rest, until those not compared are connected."""
    size = np.fromiter(map(len, sets), np.int64, len(sets))
    first = np.cumsum(size) - size
    distinct, ids = np.unique(np.concatenate(sets), return_inverse=True)
    inside = np.zeros(len(distinct), np.int32)
    label = np.arange(len(sets))
    fresh = np.ones(len(sets), bool)
    links: list[tuple[int, int]] = []
    pivot = 0
    while True:
        own = ids[first[pivot]:first[pivot] + size[pivot]]
        inside[own] = 1
        shared = np.add.reduceat(inside[ids], first)
        inside[own] = 0
        like = (100 * shared >= pct * (size + size[pivot] - shared)) & (label != label[pivot])
        for other in np.unique(label[like]):
            links.append((pivot, int(np.flatnonzero(like & (label == other))[0])))
            label[label == other] = label[pivot]
        fresh[pivot] = False
        rest = np.flatnonzero(fresh)
        if not len(rest):
            return links
        counts = np.bincount(label[rest])
        if np.count_nonzero(counts) == 1:
            return links
        # the largest component is left for last
        pivot = int(rest[label[rest] != np.argmax(counts)][0])


