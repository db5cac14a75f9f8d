"""SimHash fingerprints and Hamming-radius search, in DataFrame expressions only.

Terms are word 5-grams (a shorter text is one term). Every occurrence of a term votes on
128 signed bits with the bits of its hash, so a term's weight is its frequency. Votes are
counted as packed lanes: one 64-bit sum holds the ones of four bits in 16-bit lanes, which
makes 32 sums of a whole-stage-generated aggregation do for 128 counters. A lane holds
30,000 votes at most; longer texts are summed in chunks and the chunks in 32-bit lanes.

``within_radius`` finds fingerprints at Hamming distance ``radius`` or less, all of them:
cut into m blocks with allowances that add up to radius + 1 - m, two such fingerprints
differ in at least one block by no more than its allowance. There is one table per block,
keyed by the block that its permutation brings to the front, and a query looks up every key
within the allowance. A pair is made in the first table that has it only. Equal
fingerprints are searched once, with the number of their documents. ``radius_for`` derives
the radius from a similarity of texts.

Edge cases. Null and wordless texts have no votes and the all-zero fingerprint. Equal texts
have equal fingerprints. Repeated rows and equal ids are ordered by a hash of their text;
a null id comes last in descending order. A single document is its own next document.
Empty table: empty result. Other columns are ignored.
"""

from __future__ import annotations

import itertools
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablecraft.llm.frames import default_parallelism, stored

BITS = 128
_LANES = 0x0001000100010001
_WIDE = 0x0000FFFF0000FFFF
_CHUNK = 30_000  # below 2**15, so that the highest lane stays out of the sign
_TERM = 5
_TABLES = 8  # at most; more radius than tables goes into allowances of the 16-bit blocks


def terms(text: Column | str) -> Column:
    """Hashes of all word 5-grams of a text, with repeats."""
    text = F.col(text) if isinstance(text, str) else text
    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    # computed once per text: the word hashes are the accumulator-free input of one transform
    grams = F.transform(F.array(hashes), lambda h: F.when(F.size(h) > 0, F.transform(
        F.sequence(F.lit(0), F.greatest(F.size(h) - _TERM, F.lit(0))),
        lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(_TERM)]))))
    return grams[0]


def voted(rows: DataFrame, keys: list[str], terms_col: str) -> DataFrame:
    """``keys`` with the fingerprint columns f1, f2 of the terms of each row. ``keys`` must
    name a row; grouping stays where the rows are if they are partitioned by some key."""
    one = rows.select(*keys, F.posexplode_outer(terms_col).alias("_pos", "_h"))
    one = one.select(*keys, F.floor(F.col("_pos") / _CHUNK).alias("_chunk"), F.col("_h").alias("_h1"),
                     F.when(F.col("_h").isNotNull(), F.xxhash64(F.lit(1), "_h")).alias("_h2"))
    packed = one.groupBy(*keys, "_chunk").agg(F.count("_h1").alias("_n"), *[
        F.sum(F.shiftrightunsigned(h, k).bitwiseAND(F.lit(_LANES))).alias(f"{h}_{k}")
        for h in ("_h1", "_h2") for k in range(16)])
    wide = packed.groupBy(*keys).agg(F.sum("_n").alias("_n"), *[
        F.sum(F.shiftrightunsigned(f"{h}_{k}", shift).bitwiseAND(F.lit(_WIDE))).alias(f"{h}_{k}_{shift}")
        for h in ("_h1", "_h2") for k in range(16) for shift in (0, 16)])

    def bits(h: str) -> Column:
        # bit k + 16 * lane of the hash was counted in lane ``lane`` of the sum k
        out = F.lit(0).cast("long")
        for k in range(16):
            for shift in (0, 16):
                for half in (0, 32):
                    ones = F.shiftrightunsigned(F.col(f"{h}_{k}_{shift}"), half).bitwiseAND(F.lit(0xFFFFFFFF))
                    bit = F.shiftleft(F.lit(1).cast("long"), k + shift + half)
                    out = out.bitwiseOR(F.when(2 * ones > F.col("_n"), bit).otherwise(F.lit(0).cast("long")))
        return out

    return wide.select(*keys, bits("_h1").alias("f1"), bits("_h2").alias("f2"))


def as_text(f1: Column | str, f2: Column | str) -> Column:
    return F.lower(F.concat(F.lpad(F.hex(f1), 16, "0"), F.lpad(F.hex(f2), 16, "0")))


def distance(a1: str, a2: str, b1: str, b2: str) -> Column:
    return F.bit_count(F.col(a1).bitwiseXOR(F.col(b1))) + F.bit_count(F.col(a2).bitwiseXOR(F.col(b2)))


def likeness(a1: str, a2: str, b1: str, b2: str) -> Column:
    """Share of equal bits."""
    return 1 - distance(a1, a2, b1, b2) / BITS


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text_hash, f1, f2) of every distinct row of id and text."""
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    return voted(rows.select("id", "text_hash", terms("text").alias("terms")).dropDuplicates(["id", "text_hash"]),
                 ["id", "text_hash"], "terms")


def radius_for(similarity: float, recall: float = 0.95) -> int:
    """The least radius within which two texts of that Jaccard similarity of terms fall with
    probability ``recall``. A bit differs with probability angle / pi; texts of equal length
    have the widest angle of all with that similarity."""
    p = math.acos(2 * similarity / (1 + similarity)) / math.pi
    reached, radius = (1 - p) ** BITS, 0
    while reached < recall:
        radius += 1
        reached += math.comb(BITS, radius) * p ** radius * (1 - p) ** (BITS - radius)
    return radius


def _layout(radius: int) -> list[tuple[list[tuple[int, int, int]], int]]:
    """Per table the pieces (fingerprint column, shift, width) of its block and the bits in
    which a key may differ."""
    n = min(radius + 1, _TABLES)
    spare, out = radius + 1 - n, []
    for t in range(n):
        lo, hi = t * BITS // n, (t + 1) * BITS // n
        cut = [(c, max(lo, 64 * c) - 64 * c, min(hi, 64 * c + 64) - max(lo, 64 * c)) for c in (0, 1)]
        out.append(([x for x in cut if x[2] > 0], spare // n + (t < spare % n)))
    return out


def _piece(value: Column, shift: int, width: int) -> Column:
    out = F.shiftrightunsigned(value, shift)
    return out if width == 64 else out.bitwiseAND(F.lit((1 << width) - 1))


def _blocks(fps: DataFrame, radius: int, lookup: bool) -> DataFrame:
    """A row per fingerprint and table: the table's number and the block it is keyed by; for
    ``lookup`` a row for every key within the table's allowance."""
    out = []
    for t, (cut, allowed) in enumerate(_layout(radius)):
        parts = [_piece(F.col(("f1", "f2")[c]), shift, width) for c, shift, width in cut]
        block = parts[0] if len(parts) == 1 else F.xxhash64(*parts)
        keys = F.array(block)
        if lookup and allowed:
            # only the layout with most tables has allowances; its blocks lie in one column
            width = cut[0][2]
            flips = [sum(1 << i for i in x) for k in range(allowed + 1) for x in itertools.combinations(range(width), k)]
            keys = F.transform(F.lit(flips).cast("array<long>"), block.bitwiseXOR)
        out.append(F.struct(F.lit(t).alias("table"), keys.alias("keys")))
    rows = fps.select("*", F.explode(F.array(*out)).alias("_b"))
    return rows.select("*", "_b.table", F.explode("_b.keys").alias("block")).drop("_b")


def within_radius(fps: DataFrame, queries: DataFrame, radius: int = 3) -> DataFrame:
    """(q1, q2, f1, f2, distance) for every distinct fingerprint of ``queries`` and every
    distinct one of ``fps`` at most ``radius`` bits away; both have columns f1, f2."""
    left = _blocks(queries.select("f1", "f2").distinct(), radius, True).select(
        F.col("f1").alias("q1"), F.col("f2").alias("q2"), F.col("table").alias("_t"), F.col("block").alias("_k"))
    right = _blocks(fps.select("f1", "f2").distinct(), radius, False)
    other = [F.col("q1").bitwiseXOR(F.col("f1")), F.col("q2").bitwiseXOR(F.col("f2"))]
    first = None
    for t, (cut, allowed) in enumerate(_layout(radius)):
        bits = sum((F.bit_count(_piece(other[c], shift, width)) for c, shift, width in cut[1:]),
                   F.bit_count(_piece(other[cut[0][0]], *cut[0][1:])))
        first = (F if first is None else first).when(bits <= allowed, t)
    # one condition of the join, so that candidates which are none never become rows; merged,
    # as the planner's size estimate leaves out the keys that a query looks up
    near = left.hint("merge").join(right, (F.col("_t") == F.col("table")) & (F.col("_k") == F.col("block"))
                     & (distance("q1", "q2", "f1", "f2") <= radius) & (first == F.col("table")))
    return near.select("q1", "q2", "f1", "f2", distance("q1", "q2", "f1", "f2").alias("distance"))


def _ranges(ids: DataFrame, n: int) -> tuple[Column, int]:
    """Number of the id range (0 holds the largest ids) as an expression over ``id``, and
    the number of ranges. The bounds are approximate quantiles."""
    bounds = sorted(set(ids.agg(F.percentile_approx("id", [k / n for k in range(1, n)], 100 * n)).first()[0] or [])) if n > 1 else []
    if not bounds:
        return F.when(F.col("id").isNull(), 1).otherwise(0), 2
    step = max(1, round(len(bounds) ** 0.5))
    groups = [bounds[i:i + step] for i in range(0, len(bounds), step)]
    # two short searches instead of a long one: the group of bounds, then the bound
    group = F.size(F.filter(F.lit([g[-1] for g in groups]), lambda b: b < F.col("id")))
    inner = F.element_at(F.array(*[F.lit(g) for g in groups], F.array().cast("array<long>")), group + 1)
    below = group * step + F.size(F.filter(inner, lambda b: b < F.col("id")))
    return F.when(F.col("id").isNull(), len(bounds) + 1).otherwise(len(bounds) - below), len(bounds) + 2


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(range, place, id, text, next_text): documents in descending id order, each with the
    text of the next one (after the last: the first). Ranges of ids are sorted apart; the
    head of the following range stands behind each range's last document."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    number, _ = _ranges(rows.select("id"), default_parallelism(docs.sparkSession))
    rows = rows.withColumn("range", number).withColumn("hash", F.xxhash64("text"))
    heads = rows.groupBy("range").agg(F.max(F.struct("id", F.bitwise_not("hash").alias("h"))).alias("m")).select(
        "range", F.col("m.id").alias("hid"), F.bitwise_not("m.h").alias("hhash"))
    # one narrow row per range; the head of a range goes to the range before it
    around = Window.orderBy("range")
    last = F.last("range").over(around.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    heads = stored(heads.withColumn("before", F.coalesce(F.lag("range").over(around), last)), "heads")
    found = rows.withColumnRenamed("range", "_range").join(
        heads, F.col("id").eqNullSafe(F.col("hid")) & (F.col("hash") == F.col("hhash")) & (F.col("_range") == F.col("range")))
    found = found.dropDuplicates(["range"]).select(F.col("before").alias("range"), "id", "text", "hash", F.lit(1).alias("extra"))
    both = rows.select("range", "id", "text", "hash", F.lit(0).alias("extra")).unionByName(found)
    w = Window.partitionBy("range").orderBy("extra", F.col("id").desc_nulls_last(), "hash")
    both = both.withColumn("place", F.row_number().over(w)).withColumn("next_text", F.lead("text").over(w))
    return both.where("extra = 0").select("range", "place", "id", "text", "next_text")


def half_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every document, of its edited text (the last half of its code points
    replaced by the first of the next document) and of the next document: (id, n_chars,
    edited_sha256, f1, f2, e1, e2, n1, n2), a row per row of ``docs``."""
    rows = with_next(docs, id_col, text_col).withColumn("n_chars", F.length("text"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.col("n_chars") - half), F.substring("next_text", F.lit(1), half))
    rows = rows.select("range", "place", "id", F.col("n_chars").cast("long").alias("n_chars"), "text", edited.alias("edited"))
    rows = rows.withColumn("edited_sha256", F.sha2("edited", 256))
    keys = ["range", "place", "id", "n_chars", "edited_sha256", "which"]
    both = rows.select(*keys[:-1], F.explode(F.array(
        F.struct(F.lit(0).alias("which"), F.col("text").alias("t")),
        F.struct(F.lit(1).alias("which"), F.col("edited").alias("t")))).alias("b"))
    votes = voted(both.select(*keys[:-1], "b.which", terms("b.t").alias("terms")), keys, "terms")
    of = lambda which, f: F.max(F.when(F.col("which") == which, F.col(f)))
    own = stored(votes.groupBy(*keys[:-1]).agg(
        of(0, "f1").alias("f1"), of(0, "f2").alias("f2"), of(1, "f1").alias("e1"), of(1, "f2").alias("e2")), "fingerprints")
    # the place of the next document: the next in the range, or the first of the next range
    sizes = own.groupBy("range").agg(F.max("place").alias("size"))
    around = Window.orderBy("range")
    first = F.first("range").over(around.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    sizes = stored(sizes.withColumn("after", F.coalesce(F.lead("range").over(around), first)), "ranges")
    here = own.join(sizes, "range").withColumn("_r", F.when(F.col("place") < F.col("size"), F.col("range")).otherwise(F.col("after")))
    here = here.withColumn("_p", F.when(F.col("place") < F.col("size"), F.col("place") + 1).otherwise(1))
    nxt = own.select(F.col("range").alias("_r"), F.col("place").alias("_p"), F.col("f1").alias("n1"), F.col("f2").alias("n2"))
    return here.join(nxt, ["_r", "_p"]).select("id", "n_chars", "edited_sha256", "f1", "f2", "e1", "e2", "n1", "n2")
