import random

import numpy as np

from tablecraft.llm import arrays


def thue_morse(n):
    t = np.zeros(1, np.uint8)
    while len(t) < n:
        t = np.concatenate([t, 1 - t])
    return t


def test_patterned_words_have_different_hashes():
    for n in (64, 1024, 2048, 4096):
        t = thue_morse(n)
        v = np.concatenate([97 + t, 97 + (1 - t), 97 + t])
        h = arrays.run_hashes(v, np.array([0, n, 2 * n]), np.array([n, 2 * n, 3 * n]))
        assert h[0] != h[1] and h[0] == h[2]


def test_equal_content_equal_hash(monkeypatch):
    rng = random.Random(3)
    parts = [bytes(rng.choice(b"abc") for _ in range(rng.randint(0, 5))) for _ in range(3000)]
    parts += [b"x" * 5000, b"y" * 5000, b"x" * 5000, b"x" * 4999]
    buf, starts = arrays.joined(parts)
    ends = starts + np.fromiter(map(len, parts), np.int64, len(parts))
    whole = arrays.run_hashes(buf, starts, ends)
    assert len(set(whole.tolist())) == len(set(parts))
    assert len({(p, h) for p, h in zip(parts, whole.tolist())}) == len(set(parts))
    monkeypatch.setattr(arrays, "SLICE_BYTES", 1000)
    monkeypatch.setattr(arrays, "_CACHED", 64)
    assert (arrays.run_hashes(buf, starts, ends) == whole).all()
    assert len(arrays.run_hashes(buf, starts[:0], ends[:0])) == 0
