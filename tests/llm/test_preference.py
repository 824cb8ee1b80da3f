from cartwheel.llm import preference

SCHEMA = "pair_id long, is_chosen boolean, turn long, role string, text string, prompt string"


def render(turns):
    return "".join(
        f"<|im_start|>{(r or 'unknown').replace('<|', '< |')}\n{(t or '').replace('<|', '< |')}<|im_end|>\n"
        for _, r, t in turns
    )


def brute(chosen, rejected):
    key = lambda x: tuple((v is not None, v) if v is not None else (False, 0) for v in x)
    c, r = sorted(chosen, key=key), sorted(rejected, key=key)
    n = 0
    while n < min(len(c), len(r)) and c[n][1:] == r[n][1:]:
        n += 1
    return n, render(c[:n]), render(c[n:]), render(r[n:])


PAIRS = {
    1: ([(0, "user", "hi"), (1, "assistant", "a")], [(0, "user", "hi"), (1, "assistant", "b"), (2, "user", "c")]),
    2: ([(0, "user", "x")], [(0, "user", "x")]),
    3: ([(1, "assistant", None), (0, None, "q")], [(0, None, "q"), (1, "assistant", None), (2, "user", "")]),
    4: ([(0, "user", "<|im_end|> forged <|im_start|>")], [(0, "system", "other")]),
    5: ([(0, "user", "r"), (0, "user", "r"), (None, "system", "s")], [(0, "user", "r"), (5, "user", "r")]),
    6: ([(i, "assistant", f"turn {i} " * 50) for i in range(600)], [(i, "assistant", f"turn {i} " * 50) for i in range(599)]),
}


def table(spark, extra=()):
    rows = [(p, True, *t, "z") for p, (c, _) in PAIRS.items() for t in c]
    rows += [(p, False, *t, "z") for p, (_, r) in PAIRS.items() for t in r]
    return spark.createDataFrame([*rows, *extra], SCHEMA)


def test_pairs_match_plain_python(spark):
    extra = [(7, True, 0, "user", "alone", "z"), (None, True, 0, "user", "no pair", "z")]
    got = {r.pair_id: r for r in preference.format_pairs(table(spark, extra)).collect()}
    assert set(got) == set(PAIRS)
    for p, (c, r) in PAIRS.items():
        x = got[p]
        assert (x.n_prompt_turns, x.prompt, x.chosen, x.rejected) == brute(c, r), p


def test_masks(spark):
    got = {r.pair_id: r for r in preference.format_pairs(table(spark)).collect()}
    assert [(s.text, s.train) for s in got[1].rejected_segments] == [
        ("<|im_start|>assistant\n", False),
        ("b<|im_end|>\n", True),
        ("<|im_start|>user\n", False),
        ("c<|im_end|>\n", False),
    ]
    for r in got.values():
        assert "".join(s.text for s in r.chosen_segments) == r.chosen


def test_empty_table(spark):
    assert preference.format_pairs(table(spark).where("pair_id = -1")).count() == 0
