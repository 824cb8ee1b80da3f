import random
import re
import zlib

import numpy as np
import pytest

from cartwheel.llm import gru, toxicity
from cartwheel.llm.words import Words


def test_gradients_match_finite_differences():
    rng = np.random.Generator(np.random.PCG64(1))
    v = gru.Vocabulary(np.arange(1, 9, dtype=np.uint64) * np.uint64(1 << 50))
    net = gru.Net.new(v, v, np.zeros(len(v)), np.zeros(len(v)))
    net.p = {k: x.astype(np.float64) for k, x in net.p.items()}
    x = rng.standard_normal((6, gru.INPUT, 3))
    length, y, weight = np.array([6, 3, 1]), np.array([1.0, 0, 1]), np.ones(3)

    def loss():
        states = np.zeros((6, 2 * gru.HIDDEN, 3))
        for i, s in enumerate("fb"):
            now = np.zeros((gru.HIDDEN, 3))
            for t in range(6) if s == "f" else range(5, -1, -1):
                new = net._cell(s, net.p["wx" + s] @ x[t] + net.p["b" + s], now)[0]
                now = np.where(t < length, new, now)
                states[t, i * gru.HIDDEN : (i + 1) * gru.HIDDEN] = now
        out = 0
        for k, n in enumerate(length):
            e = states[:n, :, k] @ net.p["att"]
            a = np.exp(e - e.max())
            z = (a / a.sum()) @ (states[:n, :, k] @ net.p["out"]) + net.p["bias"][0]
            q = 1 / (1 + np.exp(-z))
            out -= np.log(q if y[k] else 1 - q)
        return out

    g, dx = net.gradients(x, length, y, weight)
    for name in ("wxf", "whf", "bf", "wxb", "whb", "att", "out", "bias"):
        p = net.p[name]
        for _ in range(3):
            at = tuple(rng.integers(0, n) for n in p.shape)
            p[at] += 1e-5
            up = loss()
            p[at] -= 2e-5
            down = loss()
            p[at] += 1e-5
            assert g[name][at] == pytest.approx((up - down) / 2e-5, rel=2e-3, abs=2e-4)
    x[2, 1, 1] += 1e-5
    up = loss()
    x[2, 1, 1] -= 2e-5
    assert dx[2, 1, 1] == pytest.approx((up - loss()) / 2e-5, rel=2e-3, abs=2e-4)


def sample(n, seed):
    r = random.Random(seed)
    words = [f"{a}{b}{c}" for a in "bdfgklm" for b in "aeiou" for c in ("n", "r", "st", "ling", "ton")]
    bad = ["vilescum", "grubworm", "dolthead"]
    out = []
    for i in range(n):
        text = [r.choice(words) for _ in range(r.choice([0, 5, 40, 150]) if i % 4 else 60)]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(2):
                text.insert(r.randrange(len(text) + 1), r.choice(bad) + r.choice(["", "s", "ing"]))
        out.append((" ".join(text), int(toxic)))
    return out


@pytest.fixture(scope="module")
def model():
    rows = sample(500, 1)
    return toxicity.train([t.encode() for t, _ in rows], np.array([y for _, y in rows]))


def test_held_out_accuracy(model):
    rows = sample(300, 2)
    p = model.score([t.encode() for t, _ in rows]) >= 0.5
    y = np.array([y for _, y in rows], dtype=bool)
    assert (p == y).mean() > 0.95


def test_every_window_counts(model):
    clean = [t for t, y in sample(400, 8) if not y and t]
    scores = model.score([t.encode() for t in clean])
    filler = " ".join([t for t, s in zip(clean, scores) if s < 0.01][:25])
    for at in (0, len(filler) // 2, len(filler)):
        text = filler[:at] + " grubworm vilescum " + filler[at:]
        assert model.score([text.encode(), filler.encode()]).tolist() == sorted(
            model.score([text.encode(), filler.encode()]).tolist(), reverse=True
        )
        assert model.score([text.encode()])[0] >= 0.5 > model.score([filler.encode()])[0]


def test_length_does_not_make_a_text_toxic(model):
    clean = [t for t, y in sample(1200, 9) if not y and t]
    scores = model.score([t.encode() for t in clean])
    clean = [t for t, s in zip(clean, scores) if s < 0.1]
    r = random.Random(1)
    for words in (1000, 5000, 20_000):
        for _ in range(3):
            parts = []
            while sum(len(p.split()) for p in parts) < words:
                parts.append(r.choice(clean))
            at = r.randrange(len(parts))
            hidden = " ".join([*parts[:at], "dolthead you vilescum grubworm", *parts[at:]])
            low, high = model.score([" ".join(parts).encode(), hidden.encode()])
            assert low < 0.5 <= high


def plain_score(net, text):
    """The highest window logit, word by word and step by step."""
    folded = bytes(32 if gru.BREAKS[b] else b + 32 if 65 <= b <= 90 else b for b in text)
    padded = b" " + folded + b"    "
    xs = []
    for m in re.finditer(rb"[^ ]+", folded):
        a, e = m.span()
        word = net.words.find(Words([text[a:e]], gru.BREAKS).hashes())[0]
        codes = [int.from_bytes(padded[i : i + 4], "little") for i in range(a, max(e - 1, a + 1))]
        at = net.grams.find(np.array(codes, dtype=np.uint64))
        xs.append(np.concatenate((net.p["ew"][word], net.p["ec"][at].mean(axis=0), [net.evidence[at].max()])))
    h, best = gru.HIDDEN, -np.inf
    for start in range(0, max(len(xs), 1), gru.STRIDE):
        window = xs[start : start + gru.WINDOW]
        states = np.zeros((len(window), 2 * h))
        for i, s in enumerate("fb"):
            now = np.zeros(h)
            for t in range(len(window)) if s == "f" else range(len(window) - 1, -1, -1):
                a, u = net.p["wx" + s] @ window[t] + net.p["b" + s][:, 0], net.p["wh" + s] @ now
                z, r = 1 / (1 + np.exp(-a[:h] - u[:h])), 1 / (1 + np.exp(-a[h : 2 * h] - u[h : 2 * h]))
                c = np.tanh(a[2 * h :] + r * u[2 * h :])
                now = (1 - z) * c + z * now
                states[t, i * h : i * h + h] = now
        logit = net.p["bias"][0]
        if window:
            energy = states @ net.p["att"]
            weight = np.exp(energy - energy.max())
            logit = logit + (weight / weight.sum()) @ (states @ net.p["out"])
        best = max(best, logit)
    return best


def test_scores_equal_plain_loops(model):
    texts = [t for t, _ in sample(30, 6)] + ["", " . ", "A", "b-C d", "Ünder grubworms " * 11, "x " * 33]
    got = model.net.score(Words([t.encode() for t in texts], gru.BREAKS))
    assert np.allclose(got, [plain_score(model.net, t.encode()) for t in texts], atol=1e-3)


def test_calibration_never_rewards_length():
    r = np.random.Generator(np.random.PCG64(2))
    y = (r.random(400) < 0.5).astype(float)
    x = np.stack((3 * y - 1.5 + r.standard_normal(400), 2 * y + r.random(400), np.ones(400)), axis=1)
    a, b, _ = toxicity._calibrate(x, y)
    assert a > 0 and b == 0
    x[:, 1] = 3 * (1 - y) + r.random(400)
    a, b, _ = toxicity._calibrate(x, y)
    assert a > 0 and b < 0


def test_scores_do_not_depend_on_the_batch(model):
    texts = [t.encode() for t, _ in sample(40, 3)]
    together = model.score(texts)
    alone = np.array([model.score([t])[0] for t in texts])
    assert np.allclose(together, alone, atol=1e-5)


def test_windows_cover_every_word():
    blocks, length = gru.windows(np.array([0, 1, 16, 17, 100]))
    assert blocks.tolist() == [1, 1, 1, 2, 7]
    assert length[:5].tolist() == [0, 1, 16, 17, 1]
    w = Words([b"a-b c"], gru.BREAKS)
    assert w.counts.tolist() == [3]


def test_constant_models():
    assert toxicity.train([], np.zeros(0)).score([b"x"]).tolist() == [0.0]
    assert toxicity.train([b"x", b"y"], np.ones(2)).score([b"x"]).tolist() == [1.0]


def test_table(spark, make_docs, odd_rows):
    rows = [(i, t) for i, (t, _) in enumerate(sample(240, 4), start=1000)]
    docs = make_docs(rows + odd_rows)
    labels = [(i, y) for (i, _), (_, y) in zip(rows, sample(240, 4))]
    labels = spark.createDataFrame([*labels, (None, 1), (1, None), (999_999, 1)], "doc_id long, toxic int")
    got = toxicity.score(docs, labels).collect()
    assert len(got) == len(rows) + len(odd_rows)
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    clean = toxicity.keep_clean(docs, labels)
    assert clean.columns == docs.columns and clean.count() == sum(r.predicted == 0 for r in got)
    none = labels.where("toxic = 5")
    assert {r.score for r in toxicity.score(docs, none).collect()} == {0.0}
    assert toxicity.score(make_docs([]), labels).count() == 0


def test_training_sample_is_bounded(spark, make_docs, monkeypatch):
    rows = [(i, f"text of {i}") for i in range(60)] + [(7, f"another {j}") for j in range(200)] + [(8, "long " * 1000)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    ids = {i for i in range(60) if zlib.crc32(str(i).encode()) % 5}
    taken = []
    monkeypatch.setattr(toxicity, "train", lambda texts, y: taken.append((texts, y)))
    toxicity.fit(make_docs(rows), labels)
    toxicity.fit(make_docs(rows[::-1]), labels)
    assert len(taken[0][0]) == len(ids) == len(taken[0][1]) and taken[0][0] == taken[1][0]
    monkeypatch.setattr(toxicity, "SAMPLE_BYTES", 200)
    toxicity.fit(make_docs(rows), labels)
    texts, y = taken[2]
    assert 0 < sum(map(len, texts)) <= 200 and set(y) == {0, 1} and set(texts) <= set(taken[0][0])
