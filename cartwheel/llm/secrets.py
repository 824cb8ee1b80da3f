"""Secret scan: base patterns plus a randomness test battery, in SQL functions.

*Base kinds*, leftmost non-overlapping per kind over the whole text: ``assign``
(a password-like name, ``:`` or ``=``, a value of 6 or more characters),
``access`` (``AKIA`` and upper-case letters or digits, 20 or more characters)
and ``hex`` (24 or more lower-case hex digits).

*Battery.*  Every maximal run of 20 or more characters of ``[A-Za-z0-9+/_-]``
that lies in no base span is a candidate.  Its encoding is the smallest alphabet
that has all its characters (digits, hex, lower or upper case, base32, these with
digits, letters, alphanumeric, base64).  Under the hypothesis
"uniform random symbols of that alphabet" three tests give p-values: the
chi-squared statistic of the symbol counts (Wilson-Hilferty), the runs test of
symbols above and below the alphabet's middle, and the lag-1 serial
correlation.  Fisher's method combines them.

*False discoveries.*  Calling a random string "text" is the error to control:
within each band of lengths the Benjamini-Hochberg step-up rule at ``FDR``
over all candidates of the table decides which are not random; short strings,
where the tests are weak, so never borrow from long ones.  The counts behind it are a
histogram of at most 5 x ``BINS`` cells.  Candidates not rejected are spans of
kind ``random``.

Positions are code points, end exclusive.  Defined cases: null text is empty
and has no spans; null ids and repeated rows are scanned row by row; an empty
table gives an empty result; ``redact`` leaves other columns as they are
(``n_chars``, if there, follows the new text).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.scratch import stage

#: Fixed patterns of the base kinds, in the order of ties.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}"
KINDS = ["assign", "access", "hex", "random"]
MIN_VALUE = 6

FDR, BINS, BIN_WIDTH = 0.05, 400, 0.125
#: Lower ends of the length bands.
BANDS = [20, 28, 40, 64, 128]

#: Alphabets in the order they are tried: pattern of the whole run, symbols.
DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ALPHABETS = [
    ("^[0-9]+$", DIGITS),
    ("^[0-9a-f]+$", DIGITS + "abcdef"),
    ("^[0-9A-F]+$", DIGITS + "ABCDEF"),
    ("^[a-z]+$", LOWER),
    ("^[A-Z]+$", UPPER),
    ("^[A-Z2-7]+$", UPPER + "234567"),
    ("^[0-9a-z]+$", DIGITS + LOWER),
    ("^[0-9A-Z]+$", DIGITS + UPPER),
    ("^[A-Za-z]+$", UPPER + LOWER),
    ("^[0-9A-Za-z]+$", UPPER + LOWER + DIGITS),
    ("^[0-9A-Za-z+/]+$", UPPER + LOWER + DIGITS + "+/"),
    ("", UPPER + LOWER + DIGITS + "-_"),
]

_BLOCK = 256


def _found(text: str, pattern: str, name: str) -> list[Column]:
    """The matches of a pattern and the pieces between them (null: none)."""
    hit = F.col(text).rlike(pattern)
    return [
        F.when(hit, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).alias(f"{name}_m"),
        F.when(hit, F.split(text, pattern, -1)).alias(f"{name}_p"),
    ]


def _starts(name: str) -> list[Column]:
    """Where each match starts.  Lengths are summed in blocks, so the work is
    near linear in the number of matches."""
    return [
        F.expr(
            f"transform({name}_m, (m, i) -> cast(length({name}_p[i]) + length(m) as bigint))"
        ).alias(f"{name}_len"),
    ]


def _prefix(name: str) -> Column:
    total = "aggregate({}, 0L, (a, x) -> a + x)"
    blocks = f"sequence(0, (size({name}_len) - 1) div {_BLOCK})"
    sums = f"transform({blocks}, j -> " + total.format(f"slice({name}_len, j * {_BLOCK} + 1, {_BLOCK})") + ")"
    return F.expr(f"transform({sums}, (s, j) -> s)").alias(f"{name}_sum")


def _before(name: str) -> Column:
    total = "aggregate({}, 0L, (a, x) -> a + x)"
    return F.expr(f"transform({name}_sum, (s, j) -> " + total.format(f"slice({name}_sum, 1, j)") + ")").alias(
        f"{name}_before"
    )


def _spans(name: str, kind: int, keep: str = "true") -> str:
    """Spans (start, kind, end) of the matches."""
    inside = f"aggregate(slice({name}_len, (i div {_BLOCK}) * {_BLOCK} + 1, i % {_BLOCK}), 0L, (a, x) -> a + x)"
    start = f"{name}_before[i div {_BLOCK}] + {inside} + length({name}_p[i])"
    return f"""filter(transform({name}_m, (m, i) -> named_struct(
        'start', {start}, 'kind', {kind}, 'end', {start} + length(m), 'ok', {keep}, 'token', m)), s -> s.ok)"""


def _tail(z: str) -> str:
    """Upper tail of the normal distribution (Abramowitz and Stegun 26.2.17)."""
    t = f"(1 / (1 + 0.2316419 * abs({z})))"
    poly = (
        f"{t} * (0.319381530 + {t} * (-0.356563782 + {t} * (1.781477937 + {t} * (-1.821255978 + {t} * 1.330274429))))"
    )
    upper = f"(0.3989422804014327 * exp(-({z}) * ({z}) / 2) * {poly})"
    return f"greatest(1e-300D, if(({z}) >= 0, {upper}, 1 - {upper}))"


def battery(token: str) -> str:
    """SQL for the combined p-value of a token column or lambda variable."""
    choice = " ".join(f"when {token} rlike '{p}' then '{a}'" if p else f"else '{a}'" for p, a in ALPHABETS)
    # nested one-element transforms name the intermediate values
    return f"""transform(transform(transform(transform(array(named_struct('t', {token}, 'a', case {choice} end)), v ->
        named_struct('n', double(length(v.t)), 'k', double(length(v.a)),
            'x', transform(filter(split(v.t, ''), c -> c <> ''), c -> double(locate(c, v.a))),
            'q', aggregate(transform(filter(split(v.a, ''), c -> c <> ''),
                     c -> double(length(v.t) - length(replace(v.t, c, '')))), 0D, (s, y) -> s + y * y))), v ->
        named_struct('n', v.n, 'k', v.k, 'chi', v.q * v.k / v.n - v.n,
            'up', aggregate(v.x, 0D, (s, y) -> s + if(y > v.k / 2, 1, 0)),
            'mean', aggregate(v.x, 0D, (s, y) -> s + y) / v.n,
            'runs', 1 + aggregate(zip_with(slice(v.x, 1, size(v.x) - 1), slice(v.x, 2, size(v.x) - 1),
                     (y, w) -> if((y > v.k / 2) <> (w > v.k / 2), 1D, 0D)), 0D, (s, y) -> s + y),
            'x', v.x)), v ->
        named_struct('n', v.n,
            'z1', (pow(v.chi / (v.k - 1), 1D / 3) - (1 - 2 / (9 * (v.k - 1)))) / sqrt(2 / (9 * (v.k - 1))),
            'z2', if(v.up = 0 or v.up = v.n, sqrt(v.n),
                 (v.runs - 2 * v.up * (v.n - v.up) / v.n - 1) / sqrt(greatest(1e-9D,
                     (2 * v.up * (v.n - v.up) / v.n) * (2 * v.up * (v.n - v.up) / v.n - 1) / (v.n - 1)))),
            'z3', sqrt(v.n) * aggregate(zip_with(slice(v.x, 1, size(v.x) - 1), slice(v.x, 2, size(v.x) - 1),
                     (y, w) -> (y - v.mean) * (w - v.mean)), 0D, (s, y) -> s + y)
                 / greatest(1e-9D, aggregate(v.x, 0D, (s, y) -> s + (y - v.mean) * (y - v.mean))))), v ->
        -ln({_tail('v.z1')}) - ln(least(1D, 2 * {_tail('abs(v.z2)')})) - ln(least(1D, 2 * {_tail('abs(v.z3)')})))[0]"""


def _scan(docs: DataFrame, text_column: str, *keep: str) -> DataFrame:
    """``keep`` and the spans: ``base`` and ``candidates`` with their band and
    p-value bin."""
    names = ["assign", "access", "hex", "run"]
    # columns get private names first: those of ``docs`` may clash with ours
    df = docs.select(
        *[F.col(c).alias(f"_{i}") for i, c in enumerate(keep)], F.coalesce(F.col(text_column), F.lit("")).alias("_text")
    )
    own = [f"_{i}" for i in range(len(keep))]
    df = df.select(
        *own,
        *_found("_text", ASSIGN, "assign"),
        F.when(F.col("_text").rlike(ASSIGN), F.regexp_extract_all("_text", F.lit(ASSIGN), F.lit(2))).alias("values"),
        *_found("_text", ACCESS, "access"),
        *_found("_text", HEX, "hex"),
        *_found("_text", CANDIDATE, "run"),
    )
    df = df.select("*", *[c for n in names for c in _starts(n)])
    df = df.select("*", *[_prefix(n) for n in names])
    df = df.select("*", *[_before(n) for n in names])
    none = "cast(array() as array<struct<start: bigint, kind: int, end: bigint, ok: boolean, token: string>>)"
    listed = [
        _spans("assign", 0, f"length(values[i]) >= {MIN_VALUE}"),
        _spans("access", 1),
        _spans("hex", 2),
        _spans("run", 3),
    ]
    spans = [f"if({n}_m is null, {none}, {s})" for n, s in zip(names, listed)]
    df = df.select(
        *own,
        F.expr(
            f"transform(array_sort(concat({', '.join(spans[:3])})), "
            "s -> named_struct('start', s.start, 'kind', s.kind, 'end', s.end))"
        ).alias("base"),
        F.expr(spans[3]).alias("runs"),
    )
    df = df.select(
        *own,
        "base",
        F.expr(
            "filter(runs, r -> not exists(base, b -> b.start < r.end and r.start < b.end))"
        ).alias("runs"),
    )
    bands = " ".join(f"when length(r.token) >= {b} then {i}" for i, b in reversed(list(enumerate(BANDS))))
    df = df.select(
        *own,
        "base",
        F.expr(
            f"""transform(runs, r -> named_struct('start', r.start, 'kind', 3, 'end', r.end,
                'band', case {bands} else 0 end, 'x', {battery('r.token')}))"""
        ).alias("candidates"),
    )
    # Fisher: x = -sum(ln p) has a Gamma(3) tail, p = exp(-x) (1 + x + x^2 / 2)
    return df.select(
        *own,
        "base",
        F.expr(
            f"""transform(candidates, c -> named_struct('start', c.start, 'kind', c.kind, 'end', c.end, 'band', c.band,
                'bin', cast(least({BINS - 1}, floor((c.x - ln(1 + c.x + c.x * c.x / 2)) / {BIN_WIDTH})) as int)))"""
        ).alias("candidates"),
    )


def _cuts(scanned: DataFrame) -> list[int]:
    """Per length band the smallest bin of p-values that is rejected."""
    cells = (
        scanned.select(F.explode("candidates").alias("c"))
        .groupBy(F.col("c.band").alias("band"), F.col("c.bin").alias("bin"))
        .count()
        .collect()  # at most len(BANDS) * BINS cells
    )
    cuts = [BINS] * len(BANDS)
    for band in range(len(BANDS)):
        counts = {r["bin"]: r["count"] for r in cells if r["band"] == band}
        total, below = sum(counts.values()), 0
        for b in range(BINS - 1, -1, -1):  # from the smallest p-values
            below += counts.get(b, 0)
            if counts.get(b) and 2.718281828459045 ** (-b * BIN_WIDTH) <= FDR * below / total:
                cuts[band] = b
    return cuts


def _judged(scanned: DataFrame, own: list[str]) -> DataFrame:
    cuts = ", ".join(map(str, _cuts(scanned)))
    added = f"""transform(filter(candidates, c -> c.bin < array({cuts})[c.band]),
        c -> named_struct('start', c.start, 'kind', c.kind, 'end', c.end))"""
    return scanned.select(*own, "base", F.expr(f"array_sort(concat(base, {added}))").alias("spans"))


def _text(spans: str) -> Column:
    names = ", ".join(f"'{k}'" for k in KINDS)
    return F.expr(
        f"array_join(transform({spans}, s -> concat(array({names})[s.kind], ':', s.start, ':', s.end)), ',')"
    )


def scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: id, counts of the base kinds and of ``random``, the digest of
    the base spans, and all spans as text ``kind:start:end``."""
    found = _judged(stage(_scan(docs, text_column, id_column), "secrets"), ["_0"])
    count = lambda spans, kind: F.expr(f"cast(size(filter({spans}, s -> s.kind = {kind})) as bigint)")
    return found.select(
        F.col("_0").alias(id_column),
        count("base", 0).alias("n_assign"),
        count("base", 1).alias("n_access"),
        count("base", 2).alias("n_hex"),
        count("spans", 3).alias("n_random"),
        F.sha2(_text("base"), 256).alias("base_sha256"),
        _text("spans").alias("spans"),
    )


def redact(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """``docs`` with every span (touching ones as one) replaced by
    ``[secret]``."""
    cols = docs.columns
    at = cols.index(text_column)
    own = [f"_{i}" for i in range(len(cols))]
    found = _judged(stage(_scan(docs, text_column, *cols), "secrets_redact"), own)
    # spans are sorted by start: those that overlap become one
    merged = """aggregate(spans, cast(array() as array<struct<start: bigint, end: bigint>>), (done, s) ->
        if(size(done) > 0 and element_at(done, -1).end >= s.start,
           concat(slice(done, 1, size(done) - 1), array(named_struct('start', element_at(done, -1).start,
                  'end', greatest(element_at(done, -1).end, s.end)))),
           concat(done, array(named_struct('start', s.start, 'end', s.end)))))"""
    t = f"_{at}"
    between = f"""concat(array_join(transform(cut, (s, i) -> concat(
        substring({t}, int(if(i = 0, 0L, cut[i - 1].end)) + 1, int(s.start - if(i = 0, 0L, cut[i - 1].end))),
        '[secret]')), ''), substring({t}, int(element_at(cut, -1).end) + 1))"""
    found = found.select(*own, F.expr(merged).alias("cut"))
    clean = found.select(*own, F.expr(f"if(size(cut) = 0, {t}, {between})").alias("_clean"))
    out = []
    for i, c in enumerate(cols):
        if i == at:
            out.append(F.col("_clean").alias(c))
        elif c == "n_chars":
            kept = F.col("_clean").eqNullSafe(F.col(t))
            new = F.length("_clean").cast(docs.schema[c].dataType)
            out.append(F.when(kept, F.col(f"_{i}")).otherwise(new).alias(c))
        else:
            out.append(F.col(f"_{i}").alias(c))
    return clean.select(*out)
