import random
import zlib

import numpy as np
import pytest
from pyspark.sql import Row

from cartwheel.llm import packing
from cartwheel.llm.scratch import tokenizer_path

FILE = "word_bpe_49k.json"


@pytest.fixture(scope="module")
def tokenizer():
    tokenizers = pytest.importorskip("tokenizers")
    return tokenizers.Tokenizer.from_file(tokenizer_path(FILE))


def test_word_ids_equal_whole_texts(tokenizer):
    texts = [
        "Hello  WORLD it's\n\ttabs\x0b\x0c done",
        "<|endoftext|> <|ENDOFTEXT|> a<|startoftext|>B",
        "ΣΑΣ Σας İstanbul ÉÀ é ́x ñ nbsp em\x1cfs\x85nel",
        "日本語 123 45.6 $$$ ***### 👍🏽 don't I'LL we'VE",
        "",
        " \n ",
    ]
    known = packing.WordIds(tokenizer)
    assert known.cut
    texts += ["naïve Œuvre ÀÉ’s l'été x\x7fy \x01 İI ŉ ﬁ ½ ² ٣", "e.g. (x) y), z'. don't. it's! \u00e9, \u20ac, a\u0301. 3. b2;", "x<|endoftext|>."]
    texts += [" ".join(f"w{i}x{c}" for i in range(700)) for c in ("", ",", "\u2026")]
    for group in (texts, [" ".join(texts)], texts):
        for t, got in zip(group, known.ids([x.encode() for x in group])):
            want = tokenizer.encode(t, add_special_tokens=False).ids
            assert np.frombuffer(got, dtype="<u4").tolist() == want, t


def test_a_full_cache_begins_anew(tokenizer, monkeypatch):
    texts = [f"alpha beta {i} gamma, delta".encode() for i in range(30)]
    want = packing.WordIds(tokenizer).ids(texts)
    monkeypatch.setattr(packing, "KNOWN_WORDS", 8)
    known = packing.WordIds(tokenizer)
    assert known.ids(texts) == want
    assert [known.ids([t])[0] for t in texts] == want


def check_plan(histogram, length=2048):
    packs = packing.patterns(histogram, length)
    used = {}
    for count, pack in packs:
        assert count > 0 and sum(s * n for s, n in pack) <= length
        for s, n in pack:
            used[s] = used.get(s, 0) + n * count
    assert used == {s: n for s, n in histogram.items() if n}
    plan = packing.Plan(packs)
    filled = {}
    for s, n in histogram.items():
        seq, off = plan.place(np.full(n, s), np.arange(n))
        for a, b in zip(seq.tolist(), off.tolist()):
            filled.setdefault(a, []).append((b, s))
    assert len(filled) == plan.sequences
    for parts in filled.values():
        at = 0
        for off, s in sorted(parts):
            assert off == at
            at += s
        assert at <= length
    return plan.sequences


def test_patterns_hold_every_piece_once():
    r = random.Random(1)
    assert check_plan({}) == 0
    assert check_plan({2048: 3}) == 3
    assert check_plan({1: 5000}) == 3
    assert check_plan({1025: 4, 1023: 4}) == 4
    for _ in range(20):
        h = {}
        for _ in range(r.randrange(1, 3000)):
            s = r.choice([1, 2048, 17, r.randrange(1, 2049), r.randrange(1, 300)])
            h[s] = h.get(s, 0) + 1
        n = check_plan(h)
        total = sum(s * k for s, k in h.items())
        assert n <= total / 2048 * 1.25 + 2


def test_long_before_short_and_emptiest_pack_first():
    # 1500 and 1400 open packs; 500 goes to the one with more room
    packs = packing.patterns({1500: 1, 1400: 1, 500: 1})
    assert sorted(p for _, p in packs) == [[(1400, 1), (500, 1)], [(1500, 1)]]


def numbers(ids):
    return np.frombuffer(ids, dtype="<u4").tolist()


def test_tasks_number_their_pieces():
    given = packing._Numbers(9)
    r = random.Random(4)
    seen = {}
    for n in (0, 1, 50, 200):
        sizes = [r.choice([1, 2, 9]) for _ in range(n)]
        for s, nth in zip(sizes, given.next(np.array(sizes, dtype=np.int64))):
            assert nth == seen.get(s, 0)
            seen[s] = nth + 1


def test_shuffled_counts_give_whole_sequences(make_docs, monkeypatch):
    monkeypatch.setattr(packing, "BROADCAST_COUNTS", 0)
    docs = make_docs([(i, "a few words of text " * (i % 40)) for i in range(400)]).repartition(7)
    got = packing.pack(docs, tokenizer_path(FILE), with_ids=False).toPandas()
    assert "ids" not in got.columns and got.doc_id.nunique() == 400
    for _, s in got.sort_values("offset").groupby("sequence_id"):
        assert s["offset"].tolist() == [0, *(s["offset"] + s["length"]).tolist()[:-1]]
        assert (s["offset"] + s["length"]).max() <= 2048


def test_pack_table(make_docs, odd_rows, tokenizer):
    rows = odd_rows + [(100 + i, "same words here") for i in range(300)]
    docs = make_docs(rows)
    got = packing.pack(docs, tokenizer_path(FILE), with_ids=True).toPandas()
    assert len(got.groupby(["sequence_id", "offset"])) == len(got)
    for _, s in got.sort_values("offset").groupby("sequence_id"):
        assert s["offset"].tolist() == [0, *(s["offset"] + s["length"]).tolist()[:-1]]
        assert (s["offset"] + s["length"]).max() <= 2048
    want = tokenizer.encode(dict(odd_rows)[7], add_special_tokens=False).ids + [1]
    parts = got[got.doc_id == 7].sort_values("start")
    assert [x for ids in parts["ids"] for x in numbers(ids)] == want
    assert set(parts["doc_tokens"]) == {len(want)}
    for _, p in parts.iterrows():
        assert p.ids_crc32 == zlib.crc32(p["ids"]) and len(p["ids"]) == 4 * p["length"]
    for empty in (1, 2, 3):
        e = got[got.doc_id == empty]
        assert e[["start", "length", "doc_tokens"]].values.tolist() == [[0, 1, 1]]
    assert (got.doc_id.isna()).sum() == 2 and (got.doc_id == 5).sum() == 2
    total = got["length"].sum()
    assert got.sequence_id.nunique() == -(-total // 2048) or total / (got.sequence_id.nunique() * 2048) > 0.9


def test_sequences_hold_the_token_ids(make_docs, odd_rows, tokenizer):
    rows = odd_rows + [(100 + i, "same words here") for i in range(300)]
    packed = packing.pack(make_docs(rows), tokenizer_path(FILE))
    assert "ids" in packed.columns
    docs = {}
    whole = packing.sequences(packed).collect()
    assert len({s.sequence_id for s in whole}) == len(whole) == packed.select("sequence_id").distinct().count()
    for s in whole:
        s = Row(**{**s.asDict(), "ids": numbers(s.ids)})
        assert len(s.ids) <= 2048 and [p.offset for p in s.pieces] == [0, *np.cumsum([p.length for p in s.pieces])[:-1]]
        assert len(s.ids) == sum(p.length for p in s.pieces)
        for p in s.pieces:
            docs.setdefault(p.doc_id, []).append((p.start, s.ids[p.offset : p.offset + p.length]))
    for doc_id in (6, 7, 8, 100, 399):
        want = tokenizer.encode(dict(rows)[doc_id], add_special_tokens=False).ids + [1]
        assert [x for _, ids in sorted(docs[doc_id]) for x in ids] == want


def test_empty_table(make_docs):
    assert packing.pack(make_docs([]), tokenizer_path(FILE)).count() == 0
