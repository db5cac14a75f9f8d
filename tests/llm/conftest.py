"""Fixtures of the corpus operators: small tables with the awkward cases in them."""

from __future__ import annotations

import random

import pytest

WORDS = "ab cde the of fgh ij Éa x1 klm nop qr stu vw xyz one two".split()


def sentence(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Documents with nulls, empty, long, equal and nearly equal texts, repeated rows, and
    extra columns named like those that operators add."""
    rng = random.Random(7)
    base = sentence(rng, 300)
    texts = [None, "", " \n\t ", "one", "one two", base, base, base.replace("cde", "zzz", 1), base + " tail",
             sentence(rng, 30_000), "x" * 3000, "漢字 é ß İ 😀 " * 40, "a\nb\n\na\nb", base[:800] + sentence(rng, 50)]
    texts += [sentence(rng, rng.randint(1, 120)) for _ in range(40)]
    rows = [(i, t, "en" if i % 2 else None, f"src{i % 3}" if i % 5 else None, len(t or ""), 9, 9, "z") for i, t in enumerate(texts)]
    rows += [rows[5], rows[12], (None, base, "en", "src0", len(base), 9, 9, "z"), (None, None, None, None, None, 9, 9, "z")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score int, _k1 int, row_key string").repartition(3)
