import hashlib
import random
import re

import numpy as np
import pytest

from cartwheel.llm import infill

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def texts(n, seed):
    r = random.Random(seed)
    out = ["", " ", "\t\n ", "a", " a", "a ", "é", "日本 語　x", "a" * 1000, " " * 700 + "b" + "\n" * 600]
    for _ in range(n):
        words = ["".join(r.choice("abé日😀.") for _ in range(r.choice([1, 3, 40, 300]))) for _ in range(r.randrange(40))]
        out.append("".join(w + r.choice([" ", "\n", "  \t", " \x0b"]) for w in words))
    return out


@pytest.mark.parametrize("block", [1, 2, 7, 64, 256])
def test_cuts_are_those_of_the_units(block):
    own = texts(40, 1)
    trees = infill.BlockTrees([t.encode() for t in own], block)
    units = [UNIT.findall(t) for t in own]
    assert trees.n_units.tolist() == [len(u) for u in units]
    which = np.array([i for i, u in enumerate(units) for _ in range(len(u) + 1)])
    k = np.array([j for u in units for j in range(len(u) + 1)])
    n_bytes, n_chars = trees.cut(which, k)
    for i, j, b, c in zip(which, k, n_bytes, n_chars):
        head = "".join(units[i][:j])
        assert (len(head.encode()), len(head)) == (b, c)


def test_trees_hold_sums_of_blocks():
    t = b"ab cd  efg " * 50
    trees = infill.BlockTrees([b"", t, b"x"], 8)
    for j in range(1, -(-len(t) // 8) + 1):
        lo, hi = (j - (j & -j)) * 8, j * 8
        ends = [m.end() for m in re.finditer(rb"[ ]*[^ ]+|[ ]+", t)]
        assert trees.units[j - 1] == sum(lo < e <= hi for e in ends)
        assert trees.chars[j - 1] == min(hi, len(t)) - lo


def brute(doc_id, text, seed, percent, suffix_first):
    text = text or ""
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    units = UNIT.findall(text)
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= percent:
        return (doc_id, n, "plain", None, None, text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < suffix_first:
        return (doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}")
    return (doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


@pytest.mark.parametrize("seed,percent,suffix_first", [(42, 50, 80), (7, 100, 50)])
def test_table(spark, make_docs, odd_rows, seed, percent, suffix_first):
    rows = odd_rows + list(enumerate(texts(120, 2), start=100))
    rows += [(900, "has <P> in it"), (901, "x <M>y"), (902, "a < <S b <P c <M d"), (902, "a < <S b <P c <M d"), (903, "< < < < < <S <P <")]
    got = infill.transform(make_docs(rows), seed, percent, suffix_first).withColumn("text", infill.restore()).collect()
    key = lambda r: repr(r)
    assert sorted([tuple(r)[:-1] for r in got], key=key) == sorted(
        [brute(i, t, seed, percent, suffix_first) for i, t in rows], key=key
    )
    assert sorted(r.text for r in got) == sorted(t or "" for _, t in rows)
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    assert infill.transform(make_docs([])).count() == 0
