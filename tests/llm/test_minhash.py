import random
import re

import numpy as np
from pyspark.sql import functions as F

from cartwheel.llm import minhash
from cartwheel.llm.components import connected_components
from cartwheel.llm.words import Words, shingle_sets

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", (text or "").translate(FOLD)) if x]
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    """doc_id -> (set size, component)."""
    sets = {i: shingles(t) for i, t in rows}
    up = {i: i for i in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                    x, y = root(a), root(b)
                    up[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in sets}


def corpus(seed=1):
    """Families of edited copies, so that links chain, plus unrelated texts."""
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows, next_id = [], 0
    for size in (1, 1, 2, 3, 40):
        for _ in range(3 if size < 10 else 1):
            base = [r.choice(vocabulary) for _ in range(r.choice([3, 6, 30, 120]) if size < 10 else 100)]
            for _ in range(size):
                text = list(base)
                for _ in range(r.randrange(0, max(1, len(text) // 18))):
                    text[r.randrange(len(text))] = r.choice(vocabulary)
                rows.append((next_id, r.choice([" ", "  ", "\n"]).join(text)))
                next_id += 1
    r.shuffle(rows)
    return rows


def test_components_match_brute_force(make_docs, monkeypatch):
    rows = corpus()
    want = brute(rows)
    got = {r.doc_id: r for r in minhash.near_duplicates(make_docs(rows)).collect()}
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == want
    assert all(r.kept == (i == r.component_id) for i, r in got.items())


def test_large_groups_are_cut_into_blocks(make_docs, monkeypatch):
    rows = corpus(2)
    monkeypatch.setattr(minhash, "BLOCK", 7)
    monkeypatch.setattr(minhash, "BROADCAST_MEMBERS", 0)
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(make_docs(rows)).collect()}
    assert got == {i: c for i, (_, c) in brute(rows).items()}


def test_odd_rows(make_docs, odd_rows):
    docs = make_docs(odd_rows)
    got = minhash.near_duplicates(docs).collect()
    assert len(got) == len(odd_rows)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append((r.n_shingles, r.component_id, r.kept))
    assert by[1] == by[1][:1] == [(0, 1, True)] and by[2] == [(0, 2, True)] and by[3] == [(0, 3, True)]
    assert by[5] == [(1, 5, True)] * 2 and by[6] == [(1, 5, False)]
    assert by[8][0][1:] == (7, False)
    assert all(c is None and k for _, c, k in by[None])
    kept = minhash.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 0, 1, 2, 3, 5, 7]


def test_columns_of_any_name_stay(make_docs, odd_rows):
    names = ["_gone", "_odd", "_rows", "_ROWS_", "doc", "component_id"]
    docs = make_docs(odd_rows)
    for i, name in enumerate(names):
        docs = docs.withColumn(name, F.lit(i))
    kept = minhash.keep_first(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert sorted((r.doc_id or 0) for r in rows) == [0, 0, 1, 2, 3, 5, 7]
    assert all([r[n] for n in names] == list(range(len(names))) for r in rows)


def test_lots_by_shingles(make_docs, monkeypatch):
    rows = corpus(3)
    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", 200)
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(make_docs(rows)).collect()}
    assert got == {i: c for i, (_, c) in brute(rows).items()}


def test_empty_table(make_docs):
    assert minhash.near_duplicates(make_docs([])).count() == 0
    assert minhash.keep_first(make_docs([])).count() == 0


def test_circulant_coordinates_estimate_similarity():
    texts = [b" ".join(b"v%d" % i for i in range(a, a + 600)) for a in (0, 60)]
    a, b = shingle_sets(Words(texts))
    exact = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    same = (minhash.signature(a) == minhash.signature(b)).mean()
    assert abs(same - exact) < 0.12
    place, slices = minhash._permutations()
    at = place[a & np.uint64(minhash.UNIVERSE - 1)]
    for k in (0, 1, 254):  # coordinate k is the first one over shifted slots
        assert minhash.signature(a)[k] == slices[(at + k) % minhash.UNIVERSE, 0].min()


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 90), (90, 100), (95, 90), (7, 7)]
    links += [(500, i) for i in range(501, 560)]
    got = dict(connected_components(spark.createDataFrame(links, "u long, v long")).collect())
    assert got == {**{i: 0 for i in range(41)}, 100: 90, 95: 90, 90: 90, **{i: 500 for i in range(500, 560)}}
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0
