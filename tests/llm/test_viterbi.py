import random

import numpy as np
import pytest

from cartwheel.llm import viterbi
from cartwheel.llm.scratch import tokenizer_path

FILE = "piece_bpe_32k.model"
TEXTS = [
    "",
    " ",
    "   ",
    "a",
    "Hello  world\n  x\té",
    "日本語のテキスト mixed text ½ﬁ 👍🏽 \x00",
    "a" * 70 + " " * 33 + "b",
    "<s></s><unk><0x0A> internationalization antidisestablishmentarianism",
    "Übergrößenträger naïve façade привет мир ελληνικά",
]


@pytest.fixture(scope="module")
def data():
    with open(tokenizer_path(FILE), "rb") as f:
        return f.read()


def as_unigram(data):
    """The same pieces as a unigram model: trainer field 3 becomes 1."""
    at = 0
    out = b""

    def varint(i):
        v = s = 0
        while True:
            b = data[i]
            v |= (b & 127) << s
            i, s = i + 1, s + 7
            if b < 128:
                return v, i

    while at < len(data):
        begin = at
        key, at = varint(at)
        assert key & 7 == 2
        n, at = varint(at)
        body = data[at : at + n]
        at += n
        if key >> 3 == 2:
            body += b"\x18\x01"  # the last value of a field holds
            n, size = len(body), b""
            while True:
                size += bytes([n & 127 | (128 if n > 127 else 0)])
                n >>= 7
                if not n:
                    break
            out += bytes([key]) + size + body
        else:
            out += data[begin:at]
    return out


def ids(x):
    return np.frombuffer(x, dtype="<u4").tolist()


def noise(n, seed):
    r = random.Random(seed)
    return ["".join(r.choices("abcdeilnorst  \n.'éßя▁", k=r.randrange(1, 60))) for _ in range(n)]


def test_bpe_ids_equal_the_library(data):
    sp = pytest.importorskip("sentencepiece").SentencePieceProcessor(model_proto=data)
    encoder = viterbi.Encoder(data)
    texts = TEXTS + noise(400, 1)
    for t, got in zip(texts, encoder.encode(texts)):
        assert ids(got) == sp.encode(t), repr(t)
        assert encoder.decode(got) == t.replace("▁", " ")
        assert sp.decode(ids(got)) == encoder.decode(got)


def test_unigram_ids_equal_the_library(data):
    model = as_unigram(data)
    sp = pytest.importorskip("sentencepiece").SentencePieceProcessor(model_proto=model)
    encoder = viterbi.Encoder(model)
    assert encoder.model.kind == viterbi.UNIGRAM
    texts = TEXTS + noise(200, 2)
    score = lambda x: sum(encoder.model.scores[i] for i in x)
    for t, got in zip(texts, encoder.encode(texts)):
        want = sp.encode(t)
        # equal sums may be reached by different pieces
        assert ids(got) == want or score(ids(got)) == pytest.approx(score(want), rel=1e-6), repr(t)


def test_best_sum_by_brute_force(data):
    encoder = viterbi.Encoder(as_unigram(data))
    rank = encoder.rank
    low = encoder.unknown_score

    def best(s):
        sums = [0.0] + [-1e18] * len(s)
        for i in range(1, len(s) + 1):
            for j in range(i):
                v = rank.get(s[j:i], low if i - j == 1 else None)
                if v is not None:
                    sums[i] = max(sums[i], sums[j] + v)
        return sums[-1]

    for unit in ["▁the", "▁strawberries", "xyzzy", "▁▁▁é", "▁日本"]:
        path = encoder._batch([unit])[0].tolist()
        total = sum(rank.get(encoder._string(p), low) for p in path)
        assert total == pytest.approx(best(unit))
        assert "".join(encoder._string(p) for p in path) == unit


def test_a_full_cache_begins_anew(data, monkeypatch):
    encoder = viterbi.Encoder(data)
    want = encoder.encode(TEXTS)
    monkeypatch.setattr(viterbi, "KNOWN_UNITS", 3)
    monkeypatch.setattr(viterbi, "KNOWN_PAIRS", 5)
    fresh = viterbi.Encoder(data)
    assert fresh.encode(TEXTS) == want and fresh.encode(TEXTS[::-1]) == want[::-1]


def test_tables(make_docs, odd_rows, data):
    docs = make_docs(odd_rows)
    path = tokenizer_path(FILE)
    encoded = viterbi.encode(docs, path)
    back = {(r.doc_id, r.text) for r in viterbi.decode(encoded, path).collect()}
    assert back == {(i, t or "") for i, t in odd_rows}
    got = viterbi.round_trip(docs, path).collect()
    assert len(got) == len(odd_rows) and all(r.exact for r in got)
    assert {r.n_pieces for r in got if r.doc_id in (1, 2)} == {0}
    assert viterbi.encode(make_docs([]), path).count() == 0 and viterbi.round_trip(make_docs([]), path).count() == 0


def test_units_of_all_lengths_advance_together(data, monkeypatch):
    units = {u for t in TEXTS + noise(200, 3) + ["".join(random.Random(4).choices("aeimnrst", k=700))] for u in t.split()}
    for model in (data, as_unigram(data)):
        encoder = viterbi.Encoder(model)
        alone = {u: encoder._batch([u])[0].tolist() for u in units}
        parts = list(encoder._batches(units))
        assert sorted(u for p in parts for u in p) == sorted(units) and len(parts) < len({len(u) for u in units})
        for part in parts:
            assert [x.tolist() for x in encoder._batch(part)] == [alone[u] for u in part]
        # a batch's arrays stay bounded
        monkeypatch.setattr(viterbi, "BATCH_CELLS", 100)
        small = list(encoder._batches(units))
        assert all(len(p) == 1 or len(p) * len(p[-1]) <= 100 for p in small)
        assert [x.tolist() for p in small for x in encoder._batch(p)] == [alone[u] for p in small for u in p]
        monkeypatch.undo()


def test_pairs_are_told_as_by_the_merge_loop(data):
    encoder = viterbi.Encoder(data)
    r = random.Random(5)
    pieces = r.sample([encoder.model.pieces[i] for i in encoder.ids.tolist()], 300) + list("aetß日")
    pairs = [(a, b) for a in pieces[::3] for b in pieces[::2]]
    got = [encoder._stay(a, b) for a, b in pairs]
    assert got == [encoder.merge(a + b) == [a, b] for a, b in pairs] and {*got} == {True, False}
