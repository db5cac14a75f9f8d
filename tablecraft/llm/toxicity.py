"""Toxicity scores by non-negative positive-unlabelled learning.

Training sees two samples: confirmed toxic documents, and unlabelled documents (which hold
toxic ones too, in the proportion ``prior``). A linear classifier on the presence of
hashed byte n-grams of words minimises the class-prior-corrected risk

    prior * E_P[loss(+)] + max(0, E_U[loss(-)] - prior * E_P[loss(-)]),

whose second term estimates the risk on the non-toxic documents; when a batch makes it
negative, the step goes back up instead, which keeps the classifier from explaining away
the unlabelled toxic documents. The prior is the toxic share of the labelled training rows.

Fitting uses at most ``max_positive`` and ``max_unlabelled`` documents, the first by a hash
of their text, so the driver's work does not grow with the corpus. Scoring is a
vectorised pass over every whole text; documents never move.

Edge cases. Null and empty texts have no n-grams and get the score of the intercept.
Repeated label rows count once; contradictory labels of an id make it toxic. Without a toxic
training document every score is the prior (0 when nothing is labelled). Null ids and null
labels never train. Empty tables give empty results; extra columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablecraft.llm import arrays
from tablecraft.llm.frames import small_batches

BITS = 20
_GRAM, _PREFIX = 5, 7  # bytes
_LETTER = np.zeros(256, bool)
_LETTER[48:58] = _LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True


def grams(texts: list[bytes], wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct feature buckets of every text, concatenated, and their number per text. A
    feature is an n-gram that lies in one word and its two boundaries, or the beginning
    of a word. ``wanted`` limits the buckets."""
    if len(texts) > 1 << (32 - BITS):
        half = len(texts) // 2
        (a, m), (b, n) = grams(texts[:half], wanted), grams(texts[half:], wanted)
        return np.concatenate([a, b]), np.concatenate([m, n])
    buf, begin = arrays.joined(texts)
    low = arrays.ascii_lower()[buf]
    letter = _LETTER[low]
    # accented capitals of two UTF-8 bytes
    low[1:][(low[:-1] == 0xC3) & (low[1:] >= 0x80) & (low[1:] <= 0x9E)] += 32
    low = np.where(letter, low, np.uint8(32))
    n = len(low) - _GRAM + 1
    if n <= 0:
        return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
    inside = letter[1:1 + n].copy()
    for k in range(2, _GRAM - 1):
        inside &= letter[k:k + n]
    at = np.flatnonzero(inside)
    code = np.zeros(len(at), np.uint64)
    for k in range(_GRAM):
        code = code << np.uint64(8) | low[at + k]
    start = np.flatnonzero(letter[1:] & ~letter[:-1]) + 1
    prefix = np.ones(len(start), np.uint64)
    alive = np.ones(len(start), bool)
    for k in range(_PREFIX):
        here = np.minimum(start + k, len(low) - 1)
        alive &= letter[here]
        prefix = prefix << np.uint64(8) | np.where(alive, low[here], np.uint8(0))
    at, code = np.concatenate([at, start]), np.concatenate([code, prefix])
    bucket = (arrays.mix(code) >> np.uint64(64 - BITS)).astype(np.uint32)
    if wanted is not None:
        hit = wanted[bucket]
        at, bucket = at[hit], bucket[hit]
    text = (np.searchsorted(begin, at + 1, "right") - 1).astype(np.uint32)
    key = np.sort(text << np.uint32(BITS) | bucket)
    key = key[np.r_[True, key[1:] != key[:-1]]] if len(key) else key
    count = np.bincount(key >> np.uint32(BITS), minlength=len(texts))
    return key & np.uint32((1 << BITS) - 1), count


@dataclass
class Model:
    weights: np.ndarray  # per bucket
    bias: float

    def scores(self, texts: list[bytes]) -> np.ndarray:
        bucket, count = grams(texts, self.weights != 0)
        total = np.r_[0.0, np.cumsum(self.weights[bucket], dtype=np.float64)]
        ends = np.cumsum(count)
        return _sigmoid(total[ends] - total[ends - count] + self.bias)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def _features(texts: list[str | None], used: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Columns and row bounds of the texts' presence matrix over the buckets ``used``."""
    wanted = np.zeros(1 << BITS, bool)
    wanted[used] = True
    got = [grams(part, wanted) for _, part in arrays.slices(texts)]
    col = np.searchsorted(used, np.concatenate([b for b, _ in got]))
    return col, np.r_[0, np.cumsum(np.concatenate([c for _, c in got]))]


def _frequencies(texts: list[str | None]) -> np.ndarray:
    """Number of texts that hold each bucket."""
    return sum(np.bincount(grams(part)[0], minlength=1 << BITS) for _, part in arrays.slices(texts))


def fit(positive: list[str | None], unlabelled: list[str | None], prior: float, epochs: int = 60, batches: int = 4,
        step: float = 0.01, least_z: float = 5.0, l2: float = 1e-4, decision: float = 0.7,
        seed: int = 3) -> Model:
    """Train on texts. Only buckets whose share of texts differs between the two samples by
    at least ``least_z`` standard errors, and 15 % of the largest such number, become features. The intercept is then set so that
    the score ``decision`` separates the classes at the least corrected zero-one risk."""
    weights = np.zeros(1 << BITS)
    bias = float(np.log(max(prior, 1e-6) / max(1 - prior, 1e-6)))
    if not positive or not unlabelled or prior <= 0:
        return Model(weights, bias)
    df, n = [_frequencies(positive), _frequencies(unlabelled)], [len(positive), len(unlabelled)]
    mean = (df[0] + df[1]) / (n[0] + n[1])
    error = np.sqrt(mean * (1 - mean) * (1 / n[0] + 1 / n[1])) + 1e-12
    z = np.abs(df[0] / n[0] - df[1] / n[1]) / error
    used = np.flatnonzero(z >= max(least_z, 0.15 * z.max()))
    parts = [_features(positive, used), _features(unlabelled, used)]
    w = np.zeros(len(used) + 1)  # the last is the bias
    w[-1] = bias
    m, v, t = np.zeros_like(w), np.zeros_like(w), 0
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        order = [np.array_split(rng.permutation(len(p[1]) - 1), batches) for p in parts]
        for b in range(batches):
            (cp, np_, fp), (cu, nu, fu) = (_margins(parts[k], order[k][b], w) for k in (0, 1))
            if not len(fp) or not len(fu):
                continue
            up, uu = prior / len(fp), 1 / len(fu)
            negative = uu * np.logaddexp(0, fu).sum() - up * np.logaddexp(0, fp).sum()
            gu, gp_minus = uu * _sigmoid(fu), -up * _sigmoid(fp)
            if negative >= 0:
                gp = gp_minus - up * _sigmoid(-fp)
            else:
                gu, gp = -gu, -gp_minus
            g = np.zeros(len(w))
            for c, each in ((cp, np.repeat(gp, np_)), (cu, np.repeat(gu, nu))):
                g += np.bincount(c, each, len(w))
            g[-1] = gp.sum() + gu.sum()
            g[:-1] += l2 * w[:-1]
            t += 1
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            w -= step * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-9)
    margins = [_margins(p, np.arange(len(p[1]) - 1), w)[2] for p in parts]
    weights[used] = w[:-1]
    return Model(weights, float(w[-1]) + float(np.log(decision / (1 - decision))) - _cut(*margins, prior))


def _cut(fp: np.ndarray, fu: np.ndarray, prior: float) -> float:
    """The middle of the margins at which the non-negative corrected zero-one risk is as
    good as at its minimum, up to 2 % of the prior."""
    cuts = np.unique(np.r_[fp, fu])
    cuts = (cuts[1:] + cuts[:-1]) / 2 if len(cuts) > 1 else cuts
    over_p = 1 - np.searchsorted(np.sort(fp), cuts) / len(fp)
    over_u = 1 - np.searchsorted(np.sort(fu), cuts) / len(fu)
    risk = prior * (1 - over_p) + np.maximum(0, over_u - prior * over_p)
    best = cuts[risk <= risk.min() + 0.02 * prior]
    return float((best[0] + best[-1]) / 2)


def _margins(part: tuple[np.ndarray, np.ndarray], rows: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of the rows, their number per row, and the rows' margins."""
    col, cut = part
    n = cut[rows + 1] - cut[rows]
    c = col[arrays.expand(cut[rows], n)]
    total = np.r_[0.0, np.cumsum(w[c])]
    ends = np.cumsum(n)
    return c, n, total[ends] - total[ends - n] + w[-1]


def train(docs: DataFrame, labels: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", max_positive: int = 3000, max_unlabelled: int = 6000, **options) -> Model:
    """Fit on ``docs``. Labels count only where ``held_out`` (over the column ``id``) is not
    true. The unlabelled sample comes from all documents whatever their labels, which is the
    distribution the risk estimator asks for."""
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("label")).where("id is not null and label is not null")
    known = known.where(~F.coalesce(held_out, F.lit(False))).groupBy("id").agg(F.max("label").alias("label"))
    n, toxic = known.agg(F.count("label"), F.sum("label")).first()
    if not toxic:
        return fit([], [], 0.0)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    chosen = known.where("label = 1").select("id").orderBy(F.xxhash64("id", F.lit(11))).limit(max_positive)
    # at most max_positive ids, so the broadcast is bounded
    positive = texts.join(F.broadcast(chosen), "id").groupBy("id").agg(F.min("text").alias("text")).select("text")
    total = texts.count()
    # about twice the sample by hash of the row, of which the first by another hash; with the
    # id in it copies of a text are sampled in proportion (the id chooses rows and nothing else)
    share = F.pmod(F.xxhash64("id", "text", F.lit(12)), F.lit(1_000_000)) < int(min(1.0, 2 * max_unlabelled / max(total, 1)) * 1_000_000 + 1)
    unlabelled = texts.where(share).orderBy(F.xxhash64("id", "text", F.lit(13))).limit(max_unlabelled).select("text")
    # sorted by text: an order that no id decides
    samples = [sorted(r.text or "" for r in df.toLocalIterator()) for df in (positive, unlabelled)]
    model = fit(*samples, float(toxic) / n, **options)
    del samples
    arrays.release()
    return model


def score(text: Column | str, model: Model) -> Column:
    """Score of a text column, 0 to 1."""
    used = np.flatnonzero(model.weights)
    values, bias = model.weights[used], model.bias

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        weights = np.zeros(1 << BITS)
        weights[used] = values
        here = Model(weights, bias)
        for s in batches:
            parts = [here.scores(t) for _, t in arrays.slices(s.tolist())]
            yield pd.Series(np.concatenate(parts) if parts else np.zeros(0))
        arrays.release()

    small_batches()
    return F.pandas_udf(run, "double")(text)
