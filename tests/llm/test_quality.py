import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from cartwheel.llm import quality
from cartwheel.llm.words import Words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    n = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if n[w] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        len(covered),
        failed,
    )


def js(p, q):
    p, q = [x / sum(p) for x in p], [x / sum(q) for x in q]
    d = 0
    for a, b in zip(p, q):
        m = (a + b) / 2
        d += (a * math.log2(a / m) if a else 0) / 2 + (b * math.log2(b / m) if b else 0) / 2
    return math.sqrt(max(d, 0))


SAMPLES = [
    "",
    None,
    "a b c a b c a b c",
    "un été à la plage\nun été à la plage\n\n \nx",
    "a a a a a",
    "tab\tvt\x0bff\x0ccr\rnbsp\xa0joined \x1cfs",
    "#x *y | z < q >" + " deux" * 60,
    "日本 語 日本 語 日本",
]


@pytest.mark.parametrize("text", SAMPLES)
def test_base_counts(text):
    ref = {None: quality.Reference(np.ones(quality.CLASSES), np.array([], dtype=np.uint64), np.array([], dtype=int), 0)}
    m = quality.measure([(text or "").encode()], ["en"], ref)
    got = tuple(
        m[c][0] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    )
    assert got == base(text)


def test_texts_of_a_chunk_do_not_mix():
    texts = [(t or "").encode() for t in SAMPLES]
    w = Words(texts)
    assert quality.repeated_words(w).tolist() == [base(t)[4] for t in SAMPLES]


def test_jensen_shannon():
    p, q = [3, 0, 5, 2], [1, 4, 5, 0]
    assert quality.jensen_shannon(np.array([p, [0] * 4]), np.array(q))[0] == pytest.approx(js(p, q))
    assert quality.jensen_shannon(np.array([p, [0] * 4]), np.array(q))[1] == 0
    assert quality.jensen_shannon(np.array([[1, 0]]), np.array([0, 1]))[0] == pytest.approx(1)


def prose(i, n=220):
    common = "the of and to in is that it was for".split()
    return " ".join(common[(i * 7 + j * 3) % 10] if j % 2 else f"{'abcdefghij'[j % 10]}lon{'aeiou'[(i + j) % 5]}r" for j in range(n))


def test_verdicts(make_docs):
    rows = [(i, prose(i) + f" tail{i}") for i in range(99)]
    # no repeats here: unusual characters, and no common word
    rows.append((100, " ".join(f"{'XQZ'[i % 3]}{i}***###" for i in range(200))))
    rows.append((101, " ".join(f"alon{'abcdefghij'[i % 10]}r{'klmnopqrst'[i // 10 % 10]}{'uvwxyzabcd'[i // 100]}" for i in range(200))))
    rows.append((102, "too short"))
    got = {r.doc_id: r for r in quality.score(make_docs(rows)).collect()}
    assert all(got[i][1:7] == base(t) for i, t in rows)
    assert not got[100].kept and not got[100].base_failed and not got[101].kept and not got[102].kept
    assert got[100].class_distance > 0.3 and got[101].word_distance > 0.4


def test_odd_rows(make_docs, odd_rows):
    docs = make_docs([(*r, lang) for r, lang in zip(odd_rows, ["en", None, "xx"] * 4)])
    got = quality.score(docs)
    assert got.columns[:1] == ["doc_id"] and got.count() == len(odd_rows)
    assert all(r.base_failed and not r.kept for r in got.where("n_words < 50").collect())
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns and kept.count() == got.where("kept").count()
    assert quality.score(make_docs([])).count() == 0 and quality.keep_good(make_docs([])).count() == 0


@pytest.mark.parametrize("broadcast", [1000, 1])
def test_small_languages_have_their_own_reference(make_docs, monkeypatch, broadcast):
    monkeypatch.setattr(quality, "BROADCAST_LANGUAGES", broadcast)
    monkeypatch.setattr(quality, "MIN_REFERENCE", 4_000)
    r = random.Random(1)
    vocabulary = ["".join(r.choices("aeioulnrst", k=r.randrange(2, 8))) for _ in range(60)]
    prose = lambda i: " ".join(r.choices(vocabulary, k=220))
    cyrillic = str.maketrans("abcdefghijklmnopqrstuvwxyz", "абцдефгхийклмнопярстувщхыз")
    rows = [(i, prose(i) + f" tail{i}", "en" if i % 5 else None) for i in range(400)]
    rows += [(1000 + i, prose(i).translate(cyrillic) + f" к{i}", "ru") for i in range(25)]
    rows += [(2000 + i, prose(i).translate(cyrillic) + f" к{i}", "el") for i in range(5)]
    rows.append((3000, " ".join(f"{'XQZ'[i % 3]}{i}***###" for i in range(200)), "ru"))
    docs = make_docs(rows).selectExpr("*", "1 AS _lang", "2 AS _Reference")
    got = {r.doc_id: r for r in quality.score(docs).collect()}
    assert len(got) == len(rows)
    assert all(got[i].kept == (not got[i].base_failed) for i in got if i != 3000)
    assert sum(got[i].kept for i in range(1000, 1025)) == 25
    # judged by its own language, the others by the base rule
    assert not got[3000].kept and not got[3000].base_failed
    assert got[1000].class_distance > 0 and got[0].class_distance == 0 and got[2000].class_distance == 0
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    assert {(r.doc_id, r._lang, r._Reference) for r in kept.collect()} == {(i, 1, 2) for i in got if got[i].kept}
