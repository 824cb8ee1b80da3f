"""Quality rules: base counts and divergence from the language's own text.

*Words* are runs of characters other than ``\\x20`` and ``\\x09``-``\\x0D``.

*Base rule.*  A document fails with fewer than 50 words, or when more than
half of its words lie in three-word windows that the text has twice or more.

*Divergence rule.*  Two histograms of a document are compared to those of all
documents of its language by Jensen-Shannon distance (base 2, 0 to 1): the
character classes below, and the language's common words (every word with a
share of at least 1/``COMMON_SHARE`` of the language's words, lower-cased,
plus one bin for the rest).  A distance above its limit rejects the document.
The limits widen with ``slack / sqrt(n)`` for short texts, and below
``MIN_CHARS`` characters or ``MIN_WORDS`` words the histogram is not judged.

*References* are counted over all documents.  Every language with at least
``MIN_REFERENCE`` words has its own.  Documents of other languages and of none
are judged by the base rule only.  A reference has at most ``COMMON_SHARE`` words
(7 KB); up to ``BROADCAST_LANGUAGES`` of them, those of the languages with most
words, are broadcast, and documents of any further ones are joined with theirs.

Defined cases: null text counts as empty (no words, base rule fails); null ids
and repeated rows are judged row by row; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.scratch import free_names, stage
from cartwheel.llm.words import SPACE, Words, chunks, mix, to_bytes

MIN_BASE_WORDS, MAX_REPEAT_PERCENT = 50, 50
COMMON_SHARE, MIN_REFERENCE, BROADCAST_LANGUAGES = 400, 20_000, 1000
MIN_CHARS, MIN_WORDS = 300, 60
CLASS_LIMIT, CLASS_SLACK = 0.25, 2.0
WORD_LIMIT, WORD_SLACK = 0.40, 1.0

#: Character classes by (lead) byte of UTF-8; continuation bytes count nothing.
VOWEL, CONSONANT, UPPER, DIGIT, BLANK, NEWLINE, STOP, SYMBOL, BRACKET, OTHER_ASCII, LATIN, OTHER, NONE = range(13)
CLASSES = NONE


def _classes() -> np.ndarray:
    c = np.full(256, OTHER, dtype=np.uint8)
    c[:128] = OTHER_ASCII
    c[ord("a") : ord("z") + 1] = CONSONANT
    c[[ord(x) for x in "aeiou"]] = VOWEL
    c[ord("A") : ord("Z") + 1] = UPPER
    c[ord("0") : ord("9") + 1] = DIGIT
    c[[9, 11, 12, 13, 32]] = BLANK
    c[10] = NEWLINE
    c[[ord(x) for x in ".,;:!?"]] = STOP
    c[[ord(x) for x in "#*$%&|<>"]] = SYMBOL
    c[[ord(x) for x in "()[]{}\"'"]] = BRACKET
    c[0x80:0xC0] = NONE
    c[0xC3:0xCA] = LATIN
    return c


_CLASS = _classes()


def class_counts(words: Words) -> np.ndarray:
    """Characters per class for each text of the chunk."""
    cls = _CLASS[words.data]
    at = words.offsets.tolist()
    return np.stack([np.bincount(cls[a : b - 1], minlength=CLASSES + 1)[:CLASSES] for a, b in zip(at, at[1:])])


def repeated_words(words: Words) -> np.ndarray:
    """Per text the words that lie in a three-word window the text has more
    than once (the first one included)."""
    h = words.hashes(lower=False)
    owner = words.owners()
    covered = np.zeros(len(h), dtype=bool)
    inside = np.flatnonzero(owner[:-2] == owner[2:])
    if len(inside):
        key = h[:-2] * np.uint64(3) + mix(h[1:-1] + np.uint64(1)) * np.uint64(5) + mix(h[2:] ^ np.uint64(77))
        key = mix(key[inside] + owner[inside].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        order = np.argsort(key, kind="stable")
        same = key[order][1:] == key[order][:-1]
        twice = np.concatenate((same, [False])) | np.concatenate(([False], same))
        at = inside[order[twice]]
        for j in range(3):
            covered[at + j] = True
    return np.bincount(owner[covered], minlength=len(words.texts))


def duplicate_lines(text: bytes) -> int:
    """Lines holding a word that equal an earlier line."""
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(lines) - len(set(lines))


def jensen_shannon(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Distance (square root of the base-2 divergence) of each row of ``p``
    from ``q``; rows are normalised, an empty row is at distance 0."""
    total = p.sum(axis=1, keepdims=True)
    p = p / np.maximum(total, 1)
    q = q / max(q.sum(), 1)
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        d = np.where(p > 0, p * np.log2(p / m), 0) + np.where(q > 0, q * np.log2(q / m), 0)
    return np.where(total[:, 0] > 0, np.sqrt(np.maximum(d.sum(axis=1) / 2, 0)), 0.0)


@dataclass
class Reference:
    """Of one language: characters per class, common words (hash, ascending)
    with their counts, and all its words."""

    classes: np.ndarray
    hashes: np.ndarray
    counts: np.ndarray
    words: int

    def word_histogram(self) -> np.ndarray:
        return np.concatenate((self.counts, [self.words - self.counts.sum()])).astype(float)


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per language of the partition: words and characters per class."""
    sums: dict[str | None, np.ndarray] = {}
    for batch in batches:
        texts, langs = to_bytes(batch.column(0)), batch.column(1).to_pylist()
        for lo, hi in chunks(texts):
            w = Words(texts[lo:hi])
            rows = np.column_stack((w.counts, class_counts(w)))
            for lang, row in zip(langs[lo:hi], rows):
                sums[lang] = sums[lang] + row if lang in sums else row
    if sums:
        flat = np.concatenate(list(sums.values())).astype(np.int64)
        offsets = np.arange(0, len(flat) + 1, CLASSES + 1, dtype=np.int32)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.string()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))],
            names=["lang", "counts"],
        )


def _word_counts(flush: int = 2_000_000) -> Callable:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: dict[str, int] = {}
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        size = 0

        def merged():
            g, h, n = (np.concatenate(x) for x in zip(*held))
            order = np.lexsort((h, g))
            g, h, n = g[order], h[order], n[order]
            new = np.flatnonzero(np.concatenate(([True], (g[1:] != g[:-1]) | (h[1:] != h[:-1]))))
            return g[new], h[new], np.add.reduceat(n, new)

        def rows(g, h, n):
            lang = pa.array(list(index), pa.string()).take(pa.array(g))
            return pa.RecordBatch.from_arrays(
                [lang, pa.array(h.view(np.int64)), pa.array(n.astype(np.int64))], names=["lang", "word", "n"]
            )

        for batch in batches:
            texts = to_bytes(batch.column(0))
            group = np.array([index.setdefault(x, len(index)) for x in batch.column(1).to_pylist()], dtype=np.int32)
            for lo, hi in chunks(texts):
                w = Words(texts[lo:hi])
                h = w.hashes()
                if len(h):
                    held.append((np.repeat(group[lo:hi], w.counts), h, np.ones(len(h), dtype=np.int32)))
                    size += len(h)
                if size > flush:
                    held, size = [merged()], 0
                    if len(held[0][0]) > flush:
                        yield rows(*held.pop())
        if held:
            yield rows(*merged())

    return count


def references(docs: DataFrame) -> tuple[dict[str, Reference], DataFrame | None]:
    """The references of the languages with most words, and a table
    ``_lang, _reference`` of the others', if there are any."""
    source = docs.select("text", "lang")
    totals = stage(
        source.where("lang is not null")
        .mapInArrow(_totals, "lang string, counts array<long>")
        .groupBy("lang")
        .agg(*[F.sum(F.col("counts")[i]).alias(f"c{i}") for i in range(CLASSES + 1)])
        .where(F.col("c0") >= MIN_REFERENCE),
        "quality_totals",
    )
    large = totals.orderBy(F.desc("c0"), "lang").limit(BROADCAST_LANGUAGES)
    own = {r["lang"]: np.array(r[1:], dtype=np.int64) for r in large.collect()}
    if not own:
        return {}, None
    whole = totals.select("lang", F.ceil(F.col("c0") / COMMON_SHARE).alias("least"), F.array(*totals.columns[1:]).alias("totals"))
    common = (
        source.join(totals.select("lang"), "lang", "left_semi")
        .select("text", "lang")
        .mapInArrow(_word_counts(), "lang string, word long, n long")
        .groupBy("lang", "word")
        .agg(F.sum("n").alias("n"))
        .join(whole.select("lang", "least"), "lang")
        .where("n >= least")
        # at most COMMON_SHARE words a language
        .groupBy("lang")
        .agg(F.sort_array(F.collect_list(F.struct("word", "n"))).alias("words"))
    )
    made = stage(
        whole.join(common, "lang", "left").select(
            F.col("lang").alias("_lang"),
            F.struct(
                "totals",
                F.expr("coalesce(words.word, array())").alias("words"),
                F.expr("coalesce(words.n, array())").alias("counts"),
            ).alias("_reference"),
        ),
        "quality_references",
    )
    if len(own) < BROADCAST_LANGUAGES:
        return {r["_lang"]: _reference(*r["_reference"]) for r in made.collect()}, None
    names = docs.sparkSession.createDataFrame([(x,) for x in own], "_lang string")
    sent = made.join(F.broadcast(names), "_lang", "left_semi").collect()
    return {r["_lang"]: _reference(*r["_reference"]) for r in sent}, made.join(F.broadcast(names), "_lang", "left_anti")


def _reference(totals: list[int], words: list[int], counts: list[int]) -> Reference:
    h = np.array(words, dtype=np.int64).view(np.uint64)
    order = np.argsort(h)
    return Reference(
        np.array(totals[1:], dtype=np.int64), h[order], np.array(counts, dtype=np.int64)[order], int(totals[0])
    )


def _with_references(docs: DataFrame) -> tuple[DataFrame, dict[str, Reference], bool]:
    """``docs``, what is broadcast, and whether a last column ``_reference``
    holds that of other languages."""
    refs, rest = references(docs)
    if rest is None:
        return docs, refs, False
    # the large languages are not in it, so no language has many rows here
    key = F.when(~F.col("lang").isin(list(refs)), F.col("lang"))
    lang, reference = free_names(docs, "_lang", "_reference")
    rest = rest.withColumnsRenamed({"_lang": lang, "_reference": reference})
    keyed = docs.select(*docs.columns, key.alias(lang))
    far = keyed.where(F.col(lang).isNotNull()).join(rest, lang, "left").select(*docs.columns, reference)
    kind = rest.schema[reference].dataType.simpleString()
    near = keyed.where(F.col(lang).isNull()).select(*docs.columns, F.lit(None).cast(kind).alias(reference))
    return near.union(far), refs, True


def _all_references(batch: pa.RecordBatch, langs: list, refs: dict[str, Reference], joined: bool) -> dict[str, Reference]:
    if not joined:
        return refs
    found = batch.column(batch.num_columns - 1)
    mine: dict[str, Reference] = {}
    for i, lang in enumerate(langs):
        if lang not in refs and lang not in mine and found[i].is_valid:
            mine[lang] = _reference(*found[i].as_py().values())
    return {**refs, **mine}


def measure(texts: list[bytes], langs: list[str | None], refs: dict[str, Reference]) -> dict[str, np.ndarray]:
    """Counts, distances and verdicts of some texts."""
    w = Words(texts)
    classes = class_counts(w)
    n = w.counts
    chars = classes.sum(axis=1)
    symbols = classes[:, SYMBOL]
    repeat = repeated_words(w)
    failed = (n < MIN_BASE_WORDS) | (100 * repeat > MAX_REPEAT_PERCENT * n)
    class_js, word_js = np.zeros(len(texts)), np.zeros(len(texts))
    hashes = w.hashes()
    for lang in refs.keys() & set(langs):
        ref = refs[lang]
        mine = np.array([i for i, k in enumerate(langs) if k == lang])
        class_js[mine] = jensen_shannon(classes[mine], ref.classes)
        if len(ref.hashes):
            hist = np.zeros((len(mine), len(ref.hashes) + 1))
            for row, i in enumerate(mine.tolist()):
                h = hashes[w.first[i] : w.first[i + 1]]
                at = np.minimum(np.searchsorted(ref.hashes, h), len(ref.hashes) - 1)
                at = np.where(ref.hashes[at] == h, at, len(ref.hashes))
                hist[row] = np.bincount(at, minlength=len(ref.hashes) + 1)
            word_js[mine] = jensen_shannon(hist, ref.word_histogram())
    class_js[chars < MIN_CHARS] = 0
    word_js[n < MIN_WORDS] = 0
    odd = (class_js > CLASS_LIMIT + CLASS_SLACK / np.sqrt(np.maximum(chars, 1))) | (
        word_js > WORD_LIMIT + WORD_SLACK / np.sqrt(np.maximum(n, 1))
    )
    space = np.add.reduceat(SPACE[w.data].astype(np.int64), w.offsets[:-1]) - 1
    return {
        "n_words": n,
        "word_chars": chars - space,
        "n_symbols": symbols,
        "n_dup_lines": np.array([duplicate_lines(t) for t in texts]),
        "n_repeat_words": repeat,
        "base_failed": failed,
        "kept": ~failed & ~odd,
        "class_distance": class_js,
        "word_distance": word_js,
    }


_LONGS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def score(docs: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """One row per document: its id, the base counts, the two distances,
    ``base_failed`` and ``kept``.  Reads ``text`` and ``lang`` of ``docs``."""
    rows, found, joined = _with_references(docs.select(F.col(id_column).alias("id"), "text", "lang"))
    refs = docs.sparkSession.sparkContext.broadcast(found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, langs = to_bytes(batch.column(1)), batch.column(2).to_pylist()
            known = _all_references(batch, langs, refs.value, joined)
            for lo, hi in chunks(texts):
                m = measure(texts[lo:hi], langs[lo:hi], known)
                cols = [pa.array(m[c].astype(np.int64)) for c in _LONGS]
                cols += [pa.array(m[c]) for c in ("base_failed", "kept", "class_distance", "word_distance")]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), *cols],
                    names=["id", *_LONGS, "base_failed", "kept", "class_distance", "word_distance"],
                )

    kind = docs.schema[id_column].dataType.simpleString()
    schema = (
        f"id {kind}, {', '.join(f'{c} long' for c in _LONGS)}, base_failed boolean, kept boolean, "
        "class_distance double, word_distance double"
    )
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_column)


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns."""
    rows, found, joined = _with_references(docs)
    refs = docs.sparkSession.sparkContext.broadcast(found)
    text, lang = docs.columns.index("text"), docs.columns.index("lang")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, langs = to_bytes(batch.column(text)), batch.column(lang).to_pylist()
            known = _all_references(batch, langs, refs.value, joined)
            if joined:
                batch = batch.select(range(batch.num_columns - 1))
            for lo, hi in chunks(texts):
                m = measure(texts[lo:hi], langs[lo:hi], known)
                yield batch.slice(lo, hi - lo).filter(pa.array(m["kept"]))

    return rows.mapInArrow(run, docs.schema)
