"""The gated model: scores word by word against a plain recurrence, and long documents in bounded memory."""

import tracemalloc

import numpy as np

from tillstar.llm import gru


def model(seed=0):
    rng = np.random.default_rng(seed)
    flat = gru.start(rng.integers(1, 1000, gru.WORDS).astype(float), 500.0, seed)
    return flat + rng.standard_normal(len(flat)).astype(np.float32) * 0.2


def plain(flat, ids):
    """One word after the other, in double precision."""
    p = {k: v.astype(float) for k, v in gru.views(flat).items()}
    state, prev, total, H = np.zeros(gru.HIDDEN), gru.START, 0.0, gru.HIDDEN
    for i in ids:
        x, u = p["x"][prev], state @ p["h"]
        z, r = (1 / (1 + np.exp(-(x[k * H:(k + 1) * H] + u[k * H:(k + 1) * H]))) for k in (0, 1))
        n = np.tanh(x[2 * H:] + r * u[2 * H:])
        state = n + z * (state - n)
        logits = state @ p["c"] + p["cb"]
        c = i // gru.CLASS_WORDS
        total += logits[c] - np.log(np.exp(logits - logits.max()).sum()) - logits.max()
        if c < gru.CLASSES:
            inner = state @ p["w"][c] + p["wb"][c]
            total += inner[i - c * gru.CLASS_WORDS] - np.log(np.exp(inner - inner.max()).sum()) - inner.max()
        prev = i
    return total


def test_scores_equal_a_plain_recurrence(monkeypatch):
    flat, rng = model(), np.random.default_rng(1)
    lengths = np.array([1, 5, 70, 300, 2, 129, 64, 1000])
    tokens = rng.integers(0, gru.WORDS + 1, lengths.sum()).astype(np.int16)
    ends = np.cumsum(lengths)
    want = [plain(flat, tokens[e - n:e].tolist()) for e, n in zip(ends, lengths)]
    for long in (10**9, 200, 64, 0):            # none, some and all documents as lanes of their own
        monkeypatch.setattr(gru, "LONG", long)
        assert np.allclose(gru.score(flat, tokens, lengths), want, rtol=1e-4)


def test_a_very_long_document_takes_bounded_memory():
    flat, rng = model(), np.random.default_rng(2)
    lengths = np.array([400_000] + [50] * 40)
    tokens = rng.integers(0, gru.WORDS + 1, lengths.sum()).astype(np.int16)
    tracemalloc.start()
    out = gru.score(flat, tokens, lengths)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert np.isfinite(out).all() and peak < 40 << 20, peak
