"""The network against plain loops, finite differences, and passages that lie across window edges."""

import random

import numpy as np
import pytest

from stocklens.llm import toxicity


def small_run(seed=3):
    rnd = random.Random(seed)
    words = [bytes(rnd.choice(b"abcdef") for _ in range(rnd.randrange(1, 6))) for _ in range(30)]
    return toxicity.Run([b" ".join(rnd.choice(words) for _ in range(n)) for n in (5, 31, 32, 33, 70, 0)])


def plain_logit(p, x, words, mask):
    """One window, word by word."""
    h, sig = toxicity.HIDDEN, lambda v: 1 / (1 + np.exp(-v))
    states = np.zeros((len(words), 2 * h))
    for s, order, at in (("f", range(len(words)), 0), ("b", range(len(words) - 1, -1, -1), h)):
        now = np.zeros(h)
        for t in order:
            if mask[t]:
                a, b = x[words[t]] @ p[f"w{s}"] + p[f"c{s}"], now @ p[f"u{s}"]
                z, r = sig(a[:h] + b[:h]), sig(a[h:2 * h] + b[h:2 * h])
                now = (1 - z) * now + z * np.tanh(a[2 * h:] + r * b[2 * h:])
            states[t, at:at + h] = now
    if not mask.any():
        return p["bias"][0]
    e = np.tanh(states @ p["att"]) @ p["attv"]
    w = np.where(mask, np.exp(e - e[mask].max()), 0)
    return (w / w.sum()) @ states @ p["out"] + p["bias"][0]


def test_forward_equals_plain_loop():
    net, run = toxicity.Network(1), small_run()
    x = net.inputs(run)
    want = [plain_logit(net.p, x.astype(float), w, m) for w, m in zip(run.words, run.mask)]
    assert np.allclose(net.forward(x, run.words, run.mask), want, atol=1e-5)


@pytest.mark.parametrize("name", ["wf", "wb", "uf", "ub", "cf", "cb", "att", "attv", "out", "bias", "x"])
def test_gradient_by_finite_differences(name):
    net, run = toxicity.Network(2), small_run()
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    x, y = net.inputs(run).astype(np.float64) * 5, np.arange(len(run.words)) % 2.0
    g, dx = net.gradient(x, run.words, run.mask, y)
    of, grad = (x, dx) if name == "x" else (net.p[name], g[name])

    def loss():
        s = np.array([plain_logit(net.p, x, w, m) for w, m in zip(run.words, run.mask)])
        return (np.log1p(np.exp(s)) - y * s).mean()

    rnd = random.Random(name)
    for _ in range(6):
        at = tuple(rnd.randrange(n) for n in of.shape)
        if name == "x" and at[0] == len(x) - 1:
            continue
        kept, step = of[at], 1e-5
        of[at] = kept + step
        up = loss()
        of[at] = kept - step
        slope, of[at] = (up - loss()) / (2 * step), kept
        assert abs(slope - grad[at]) < 2e-4 * max(1, abs(slope)) + 2e-5


def test_word_numbers_in_parts(monkeypatch):
    texts = [b"the cat sat", None, b"", b"on the Mat, the cat!", bytes(range(32, 127)) * 3]
    whole = toxicity.Run(texts)
    monkeypatch.setattr(toxicity, "WORDS_AT_ONCE", 2)
    parts = toxicity.Run(texts)
    for name in ("flat", "own", "grams", "first", "words", "mask"):
        assert np.array_equal(getattr(whole, name), getattr(parts, name))
    net = toxicity.Network(4)
    assert np.array_equal(net.inputs(whole), net.inputs(parts))


def test_short_passages_lie_whole_in_a_window():
    n, most = 200, toxicity.WINDOW - toxicity.STRIDE + 1
    _, start = toxicity.windows(np.array([n]))
    for at in range(n - most + 1):
        assert any(s <= at and at + most <= s + toxicity.WINDOW for s in start)


def test_passage_found_wherever_it_stands():
    rnd = random.Random(8)
    plain = ["".join(rnd.choice("aeioust") for _ in range(5)) for _ in range(300)]
    vile = ["vile", "foul", "scum", "rot", "filth", "vermin", "curse", "spite", "wretch", "loathe", "slime", "grub"]

    def text(at=None, size=120):
        w = [rnd.choice(plain) for _ in range(size)]
        if at is not None:
            w[at:at + 12] = rnd.sample(vile, 12)
        return " ".join(w).encode()

    y = np.array([i % 2 for i in range(300)])
    net = toxicity.train([text(rnd.randrange(100) if v else None) for v in y], y)
    assert (net([text(at) for at in range(100)]) >= 0.5).mean() >= 0.98
    assert (net([text() for _ in range(100)]) < 0.5).mean() >= 0.98
