"""Parts of operator 8 that need no Spark: words by Arrow, stored classes, one batch of training against a plain loop."""

import numpy as np
import pyarrow as pa

from minutesmith.llm import lm_score


def test_split_and_encoded():
    texts = [None, "", " \n", "ÀB\x0b\x0cAb  x\x1cY\x85z Q ", "a"]
    column = pa.array(["skipped", *texts])[1:]
    words, before = lm_score.split(column)
    want = [lm_score.words_of(x) for x in texts]
    assert words.to_pylist() == [x for w in want for x in w] and np.diff(before).tolist() == [len(w) for w in want]
    for size in (200, 5000, 70_000):
        classes, start = np.arange(12) * (size // 12), np.array([0, 3, 6, 9])
        got, at = lm_score.decoded(lm_score.encoded(classes, start, size)[1:], size)
        assert got.tolist() == classes[3:].tolist() and at.tolist() == [0, 3, 6]


def test_train_step():
    """One batch: gradients summed pair by pair, and noise by noise, then one adaptive step."""
    g = np.random.default_rng(1)
    q = np.full(9, 1 / 9)
    x = g.normal(0, 0.5, (27, 5)).astype(np.float32)
    x[:18, -1] = 1
    h, t, c = np.sort(g.integers(0, 18, 40)), g.integers(0, 9, 40), g.integers(1, 5, 40).astype(float)
    got, gx = x.copy(), np.full(x.shape, 1e-2, np.float32)
    lm_score.train_nce(got, gx, q, h, t, c, np.random.default_rng(0), 0.2)
    rng = np.random.default_rng(0)
    lm_score.dealt(h.astype(np.uint8), rng, lm_score.TOGETHER)
    noise = np.searchsorted(np.cumsum(q), rng.random((1, lm_score.SHARED)))[0].clip(0, 8)
    d, kq = np.zeros(x.shape), np.log(lm_score.NOISE / 9)
    for a, b, n in zip(h, t, c / c.sum() * 50, strict=True):
        for y, f in [(b, lambda s, n=n: n / (1 + np.exp(s - kq)))] + [(y, lambda s, n=n: -n * lm_score.NOISE / lm_score.SHARED / (1 + np.exp(kq - s))) for y in noise]:
            k = f(float(x[a] @ x[18 + y]))
            d[a] += k * x[18 + y]
            d[18 + y] += k * x[a]
    d[:18, -1] = 0
    assert np.allclose(got, x + 0.2 * d / np.sqrt(1e-2 + d * d), atol=1e-3)
