import random

import numpy as np
import pytest

from cartwheel.llm import relative_lz
from cartwheel.llm.words import Words


def brute(rows, window=13):
    """Every window against the smallest id that has it."""
    split = [(i, (t or "").encode().split()) for i, t in rows]
    first = {}
    for i, w in split:
        if i is None:
            continue
        for a in range(len(w) - window + 1):
            key = tuple(w[a : a + window])
            first[key] = min(first.get(key, i), i)
    out = []
    for i, w in split:
        gone = set()
        for a in range(len(w) - window + 1 if i is not None else 0):
            if first[tuple(w[a : a + window])] < i:
                gone.update(range(a, a + window))
        out.append((i, len(w), len(gone), b" ".join(x for j, x in enumerate(w) if j not in gone).decode()))
    return sorted(out, key=repr)


def corpus(n, seed, vocabulary=400):
    """Texts that share passages of all lengths around the window, whole
    copies, edited copies and repeats of their own."""
    r = random.Random(seed)
    word = lambda: f"w{r.randrange(vocabulary)}"
    passages = [[word() for _ in range(r.choice([5, 12, 13, 14, 30, 90]))] for _ in range(12)]
    out = []
    for i in range(n):
        t = [word() for _ in range(r.randrange(60))]
        for _ in range(r.randrange(4)):
            p = r.choice(passages)
            a, b = sorted((r.randrange(len(p) + 1), r.randrange(len(p) + 1)))
            at = r.randrange(len(t) + 1)
            t[at:at] = p if r.random() < 0.5 else p[a:b]
        if out and r.random() < 0.25:
            t = list(r.choice(out)[1])
            if t and r.random() < 0.5:
                t[r.randrange(len(t))] = word()
        out.append((r.randrange(10_000), t))
    sep = lambda: r.choice([" ", "\n", "  ", "\t "])
    return [(i, "".join(w + sep() for w in t)) for i, t in out]


@pytest.mark.parametrize("seed,vocabulary", [(1, 400), (2, 400), (3, 3)])
def test_equals_every_window(spark, make_docs, seed, vocabulary):
    rows = corpus(150, seed, vocabulary)
    got = relative_lz.remove_repeats(make_docs(rows))
    assert sorted([tuple(r) for r in got.collect()], key=repr) == brute(rows)


def test_shuffled_joins_give_the_same(spark, make_docs, monkeypatch):
    rows = corpus(80, 4)
    monkeypatch.setattr(relative_lz, "BROADCAST_BYTES", 0)
    got = relative_lz.remove_repeats(make_docs(rows).repartition(5))
    assert sorted([tuple(r) for r in got.collect()], key=repr) == brute(rows)


def test_odd_rows(spark, make_docs, odd_rows):
    tail = " ".join(f"p{i}" for i in range(20))
    rows = odd_rows + [
        (None, tail), (40, tail), (40, tail), (40, "x " + tail), (41, tail), (41, "y y " + tail + " z"), (None, tail),
        (42, "Case " + tail.upper()), (43, tail + " " + tail), (-5, "q　r " + tail[3:]),
    ]
    got = relative_lz.remove_repeats(make_docs(rows))
    assert sorted([tuple(r) for r in got.collect()], key=repr) == brute(rows)
    assert relative_lz.remove_repeats(make_docs([])).count() == 0


@pytest.mark.parametrize("hot", [None, 100])
def test_hot_copies_and_passage(spark, make_docs, monkeypatch, hot):
    if hot:
        monkeypatch.setattr(relative_lz, "HOT_WINDOWS", hot)
    passage = " ".join(f"license{i % 7}of{i}" for i in range(60))
    rows = [(i, f"{passage} own{i} " + " ".join(f"d{i}x{j}" for j in range(30))) for i in range(300)]
    rows += [(1000 + i, "copied " + " ".join(f"c{j}" for j in range(40))) for i in range(300)]
    got = sorted([tuple(r) for r in relative_lz.remove_repeats(make_docs(rows)).collect()], key=repr)
    assert got == brute(rows)


def test_factors_are_copies_of_their_reference(spark, make_docs):
    rows = {i: t for i, t in corpus(120, 6)}
    parse = relative_lz.Parse(make_docs(list(rows.items())))
    words = {i: t.split() for i, t in rows.items()}
    found = parse.factors.collect()
    assert found
    for r in found:
        assert [f.start for f in r.factors] == sorted({f.start for f in r.factors})
        for f in r.factors:
            assert f.ref_id < r.doc_id and f.length >= 13
            own = words[r.doc_id][f.start : f.start + f.length]
            assert own == words[f.ref_id][f.ref_start : f.ref_start + f.length]


def test_equal_windows_have_equal_anchors():
    r = random.Random(8)
    texts = [" ".join(f"v{r.randrange(4)}" for _ in range(200)).encode() for _ in range(5)]
    w = Words(texts)
    owner, pos, anchor, key = relative_lz.windows(w)
    by_text = {}
    split = [t.split() for t in texts]
    for o, p, a, k in zip(owner, pos, anchor, key):
        own = tuple(split[o][p : p + 13])
        assert by_text.setdefault(own, (a, k)) == (a, k)
    assert len(owner) == 5 * 188 and len(set(by_text.values())) == len(by_text)
    assert all(len(x) == 0 for x in relative_lz.windows(Words([b"a b", b""])))
    assert np.array_equal(relative_lz.windows(Words([b"x"] * 30))[0], [])
