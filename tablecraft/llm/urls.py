"""URL filter: rules first, gradient-boosted trees on lexical features for the rest.

Rules name a host and a path beginning; the longest rule that fits decides. The URLs that a
rule decides are the labelled ones: they train boosted trees (logistic loss, histogram
splits, numpy) on lexical features, and the trees judge the URLs that no rule fits.
Features: lengths of URL, host and path, depth, number of host labels, digit ratio,
character entropy, number of parameters, fragment, hyphens, and smoothed block rates of
the top-level domain, of the file suffix and of the first path segment, counted over all
labelled URLs (for a URL that trains: over the other four fifths of them).

Training takes at most ``max_training`` labelled rows, the first by a hash of the URL; the
rates cover all of them. Rate tables join by key; Spark broadcasts them when their measured
size allows.

Edge cases. A null URL or one without "://" has an empty host and path, fits no rule and is
judged by the trees like any other. Without labels of both kinds the trees give the share
of the kind there is (no labels: allow). Repeated rows are judged alike. Empty table:
empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablecraft.llm.frames import stored

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RATES = ("tld", "suffix", "head")
_FOLDS = 5


@dataclass(frozen=True)
class Rule:
    verdict: str  # block or allow
    host: str
    path: str  # begins with /

    @property
    def text(self) -> str:
        return self.host + self.path


def rules(lines: Sequence[str]) -> list[Rule]:
    """Rules written like ``block example.com/de/``."""
    out = []
    for line in lines:
        verdict, rest = line.split()
        host, _, path = rest.partition("/")
        out.append(Rule(verdict, host, f"/{path}"))
    return out


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lowered) and path; empty for null or without ://."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.translate(host, _UPPER, _LOWER), path


def fitting(host: Column, path: Column, known: list[Rule]) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, or null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(known, key=lambda r: len(r.text)):
        fits = ((host == r.host) | host.endswith(f".{r.host}")) & path.startswith(r.path)
        out = F.when(fits, F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(out)
    return out


def _lexical(urls: list[str | None], hosts: list[str], paths: list[str]) -> np.ndarray:
    """Feature rows that need nothing but the URL."""
    raw = [(u or "").encode("utf-8", "surrogatepass") for u in urls]
    n = np.fromiter(map(len, raw), np.int64, len(raw))
    flat = np.frombuffer(b"".join(raw), np.uint8).astype(np.int64)
    row = np.repeat(np.arange(len(raw)), n)
    entropy, digits, counts = np.zeros(len(raw)), np.zeros(len(raw)), {}
    for a in range(0, len(raw), 4096):  # a count table of 4096 x 256 at a time
        b = min(a + 4096, len(raw))
        inside = (row >= a) & (row < b)
        table = np.bincount((row[inside] - a) * 256 + flat[inside], minlength=(b - a) * 256).reshape(b - a, 256)
        share = table / np.maximum(n[a:b, None], 1)
        entropy[a:b] = -(share * np.log2(np.where(share > 0, share, 1))).sum(1)
        digits[a:b] = table[:, 48:58].sum(1)
        for c in b"=&#-.":
            counts.setdefault(c, []).append(table[:, c])
    count = {c: np.concatenate(x) if x else np.zeros(0) for c, x in counts.items()}
    if not raw:
        return np.zeros((0, 10))
    return np.stack([
        n, np.fromiter(map(len, hosts), float, len(raw)), np.fromiter(map(len, paths), float, len(raw)),
        np.fromiter((sum(map(bool, p.split("/"))) for p in paths), float, len(raw)),
        np.fromiter((h.count(".") for h in hosts), float, len(raw)),
        digits / np.maximum(n, 1), entropy,
        np.where(count[61] > 0, count[38] + 1, 0), count[35] > 0, count[45],
    ], 1).astype(float)


class Trees:
    """Boosted regression trees for the logistic loss, on features cut into quantile bins."""

    def __init__(self, trees: int = 40, depth: int = 3, rate: float = 0.2, bins: int = 32, l2: float = 1.0):
        self.n, self.depth, self.rate, self.bins, self.l2 = trees, depth, rate, bins, l2
        self.start, self.cuts, self.trees = 0.0, [], []

    def fit(self, x: np.ndarray, y: np.ndarray) -> "Trees":
        share = float(np.clip(y.mean() if len(y) else 0.0, 0.01, 0.99))
        self.start = float(np.log(share / (1 - share)))
        if len(np.unique(y)) < 2:
            return self
        self.cuts = [np.unique(np.quantile(c, np.linspace(0, 1, self.bins + 1)[1:-1])) for c in x.T]
        binned = self._binned(x)
        f = np.full(len(y), self.start)
        for _ in range(self.n):
            p = 1 / (1 + np.exp(-f))
            tree = np.zeros((2 ** (self.depth + 1), 3))  # feature, bin, value; nodes as in a heap
            tree[:, 0] = -1
            node = np.ones(len(y), np.int64)
            for level in range(self.depth):
                for k in range(2 ** level, 2 ** (level + 1)):
                    rows = np.flatnonzero(node == k)
                    best = self._split(binned[rows], y[rows] - p[rows], p[rows] * (1 - p[rows])) if len(rows) > 1 else None
                    if best:
                        tree[k, :2] = best
                        node[rows] = 2 * k + (binned[rows, best[0]] > best[1])
            g, h = np.bincount(node, y - p, len(tree)), np.bincount(node, p * (1 - p), len(tree))
            tree[:, 2] = self.rate * g / (h + self.l2)
            self.trees.append(tree)
            f += tree[node, 2]
        return self

    def _binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, v) for c, v in zip(self.cuts, x.T)], 1)

    def _split(self, binned: np.ndarray, g: np.ndarray, h: np.ndarray) -> tuple[int, int] | None:
        total_g, total_h = g.sum(), h.sum()
        gain, at = 1e-6 + total_g ** 2 / (total_h + self.l2), None
        for j in range(binned.shape[1]):
            left_g = np.cumsum(np.bincount(binned[:, j], g, self.bins))[:-1]
            left_h = np.cumsum(np.bincount(binned[:, j], h, self.bins))[:-1]
            now = left_g ** 2 / (left_h + self.l2) + (total_g - left_g) ** 2 / (total_h - left_h + self.l2)
            b = int(np.argmax(now))
            if now[b] > gain:
                gain, at = now[b], (j, b)
        return at

    def predict(self, x: np.ndarray) -> np.ndarray:
        f = np.full(len(x), self.start)
        if self.trees:
            binned = self._binned(x)
            for tree in self.trees:
                node = np.ones(len(x), np.int64)
                for _ in range(self.depth):
                    feature = tree[node, 0].astype(np.int64)
                    right = binned[np.arange(len(x)), np.maximum(feature, 0)] > tree[node, 1]
                    node = np.where(feature >= 0, 2 * node + right, node)
                f += tree[node, 2]
        return 1 / (1 + np.exp(-f))


def _rate_keys(df: DataFrame) -> DataFrame:
    name = F.element_at(F.split("path", "/"), -1)
    return df.withColumns({
        "tld": F.element_at(F.split("host", r"\."), -1),
        "suffix": F.regexp_extract(name, r"\.([A-Za-z0-9]{1,8})$", 1),
        "head": F.coalesce(F.get(F.split("path", "/"), F.lit(1)), F.lit("")),
    })


def judged(pages: DataFrame, known: list[Rule], id_col: str = "page_id", url_col: str = "url",
           max_training: int = 50_000, threshold: float = 0.5, smoothing: float = 20.0,
           held_out: Column | None = None) -> DataFrame:
    """(id, host, path, rule, verdict, block_score) per row of ``pages``; the score is the
    trees' probability of block. Labels count only where ``held_out`` (over the column
    ``id``) is not true."""
    host, path = parts(F.col(url_col))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), host.alias("host"), path.alias("path"))
    rows = _rate_keys(rows.withColumn("r", fitting(F.col("host"), F.col("path"), known)))
    label = (F.col("r.verdict") == "block").cast("int")
    rows = rows.withColumn("label", label if held_out is None else F.when(~F.coalesce(held_out, F.lit(False)), label))
    labelled = rows.where("label is not null")
    n, blocked = labelled.agg(F.count("label"), F.coalesce(F.sum("label"), F.lit(0))).first()
    prior = blocked / n if n else 0.0
    # training URLs take rates from the other folds, so a label never enters its own features
    fold = F.pmod(F.xxhash64("url", F.lit(32)), F.lit(_FOLDS)).cast("int")
    rows = rows.withColumn("fold", F.when(F.col("label").isNotNull(), fold))
    for key in RATES:
        sums = [F.array(*[F.sum(F.when(F.col("fold") == f, x).otherwise(0)) for f in range(_FOLDS)]) for x in (F.lit(1), F.col("label"))]
        counts = stored(rows.where("label is not null").groupBy(key).agg(
            F.count("label").alias("n"), F.sum("label").alias("b"), sums[0].alias("n_of"), sums[1].alias("b_of")), f"rate-{key}")
        rows = rows.join(counts, key, "left")
        n_used, b_used = (F.coalesce(F.col(x) - F.coalesce(F.get(f"{x}_of", "fold"), F.lit(0)), F.lit(0)) for x in ("n", "b"))
        rows = rows.withColumn(f"{key}_rate", (b_used + smoothing * prior) / (n_used + smoothing)).drop("n", "b", "n_of", "b_of")
    share = F.pmod(F.xxhash64("url", F.lit(31)), F.lit(1_000_000)) < int(min(1.0, 2 * max_training / max(n, 1)) * 1_000_000 + 1)
    sample = rows.where("label is not null").where(share).orderBy(F.xxhash64("url"), "id").limit(max_training)
    columns = ["url", "host", "path", *(f"{k}_rate" for k in RATES)]
    train = sample.select(*columns, "label").toPandas()
    trees = Trees().fit(_features(train), train["label"].to_numpy(float))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        for df in batches:
            yield pd.Series(trees.predict(_features(df)))

    scored = rows.withColumn("block_score", F.pandas_udf(run, "double")(F.struct(*columns)))
    verdict = F.coalesce(F.col("r.verdict"), F.when(F.col("block_score") >= threshold, "block").otherwise("allow"))
    return scored.select("id", "host", "path", F.col("r.rule").alias("rule"), verdict.alias("verdict"), "block_score")


def _features(df: pd.DataFrame) -> np.ndarray:
    lexical = _lexical(df["url"].tolist(), df["host"].tolist(), df["path"].tolist())
    return np.concatenate([lexical, df[[f"{k}_rate" for k in RATES]].to_numpy(float).reshape(len(df), len(RATES))], 1)
