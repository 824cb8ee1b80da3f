"""Repeated passages by relative Lempel-Ziv parsing.

Every document is parsed greedily into factors, copies of word runs that
earlier documents (smaller ``doc_id``) hold.  Factors of at least ``WINDOW``
words are its duplicate spans.

*Index.*  The reference blocks are the windows of ``WINDOW`` consecutive words
of all documents.  A window's key is a pair of 64-bit hashes: of its anchor,
the five-word gram with the least hash in it (the first of equals), and of all
its words.  Equal windows have equal anchors, so only windows whose anchor is
in two documents are indexed; the others can't repeat.  The index holds for
each key the first place of it, smallest document and then first position.

*Parse.*  A factor starts at a window that the index places in an earlier
document.  It runs on as long as the next window follows the same copy, so
every window in it is looked up and none is taken on trust.  Where a copy
ends, the windows across its end are looked up like all others: one that
another document holds starts the next factor there.

*Copies.*  Only the first document of equal texts is indexed and parsed, a
later one is one factor as a whole.  Such a group, however large, adds one
row per document to two counts and nothing else.

All steps are scans, aggregations with partial sums, and joins of many rows to
one row a key.  Keys of very many windows (``HOT_WINDOWS``) are dealt out over
``SALTS`` tasks in the join.  The lists that meet the texts are broadcast up
to ``BROADCAST_BYTES``, shuffled beyond; the rows are the same.

Defined cases: null text has no words; rows with a null id are never removed
from and never a reference; rows that repeat an id are documents of that id
each, and no reference for one another; repeated words in one document do not
count as repeats; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.scratch import stage
from cartwheel.llm.words import Words, chunks, mix, to_bytes

WINDOW, GRAM = 13, 5
BROADCAST_BYTES = 48 << 20
#: A key of this many windows is salted; at most ``MAX_HOT`` keys are.
HOT_WINDOWS, MAX_HOT, SALTS = 5_000, 1_000_000, 32

_rng = np.random.Generator(np.random.PCG64(1303))
_WEIGHTS = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)


def _rolled(h: np.ndarray, width: int, lead: int) -> np.ndarray:
    """Hash of every ``width`` consecutive word hashes."""
    out = np.zeros(max(len(h) - width + 1, 0), dtype=np.uint64)
    for j in range(width if len(out) else 0):
        out += h[j : j + len(out)] * _WEIGHTS[lead + j]
    return mix(out)


def windows(words: Words, window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(text, position in it, anchor, key) of every window of the texts."""
    h = words.hashes(lower=False)
    if len(h) < window:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none.view(np.uint64), none.view(np.uint64)
    keys, grams = _rolled(h, window, 0), _rolled(h, gram, 128)
    owner = words.owners()
    inside = np.flatnonzero(owner[: len(keys)] == owner[window - 1 :])
    per_window = np.lib.stride_tricks.sliding_window_view(grams, window - gram + 1)
    anchors = grams[inside + per_window.argmin(axis=1)[inside]]
    return owner[inside], inside - words.first[owner[inside]], anchors, keys[inside]


def _small(df: DataFrame, name: str, row_bytes: int) -> DataFrame:
    """``df`` staged, to be broadcast if its rows fit."""
    staged = stage(df, name)
    return F.broadcast(staged) if staged.count() * row_bytes <= BROADCAST_BYTES else staged


def _runs(owner: np.ndarray, anchor: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one anchor in one text: (starts a run, number of
    the run in its text, number of the text's first run among all)."""
    new = np.ones(len(owner), dtype=bool)
    new[1:] = (owner[1:] != owner[:-1]) | (anchor[1:] != anchor[:-1])
    first = np.concatenate(([0], np.cumsum(np.bincount(owner[new], minlength=texts))))
    return new, np.cumsum(new) - 1 - first[owner], first


def _kind(docs: DataFrame) -> str:
    return docs.schema["doc_id"].dataType.simpleString()


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


class Parse:
    """The staged tables of one run: ``texts`` (every row of the documents
    with ``first``, the smallest id that has its text) and ``factors`` of the
    first documents of each text."""

    def __init__(self, docs: DataFrame, window: int = WINDOW, gram: int = GRAM):
        self.window, self.gram, self.kind = window, gram, _kind(docs)
        rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).select(
            "doc_id", "text", F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(1), "text").alias("t2")
        )
        copied = (
            rows.where("doc_id is not null")
            .groupBy("t1", "t2")
            .agg(F.min("doc_id").alias("_first"), F.max("doc_id").alias("_last"))
            .where("_first < _last")
            .select("t1", "t2", "_first")
        )
        self.texts = rows.join(_small(copied, "copied_texts", 24), ["t1", "t2"], "left").select(
            "doc_id", "text", "t1", F.coalesce("_first", "doc_id").alias("first")
        )
        self.factors = self._factors()

    def _anchors(self) -> DataFrame:
        """``doc_id, t1, run, anchor`` of the first documents: windows in a row
        that share their anchor are a run, numbered within the text."""
        kind, window, gram = self.kind, self.window, self.gram

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = to_bytes(batch.column(2))
                for lo, hi in chunks(texts):
                    owner, _, anchor, _ = windows(Words(texts[lo:hi]), window, gram)
                    new, number, _ = _runs(owner, anchor, hi - lo)
                    at = pa.array(owner[new] + lo)
                    columns = [batch.column(0).take(at), batch.column(1).take(at)]
                    columns += [pa.array(number[new].astype(np.int32)), _signed(anchor[new])]
                    yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "t1", "run", "anchor"])

        first = self.texts.where("doc_id = first").select("doc_id", "t1", "text")
        return first.mapInArrow(run, f"doc_id {kind}, t1 long, run int, anchor long")

    def _windows(self, marked: DataFrame) -> DataFrame:
        """``doc_id, t1, pos, anchor, key``: the windows of the first documents
        in the ``runs`` that ``marked`` lists."""
        kind, window, gram = self.kind, self.window, self.gram

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = to_bytes(batch.column(2))
                listed = batch.column(3)
                for lo, hi in chunks(texts):
                    owner, pos, anchor, key = windows(Words(texts[lo:hi]), window, gram)
                    _, number, first = _runs(owner, anchor, hi - lo)
                    mine = listed.slice(lo, hi - lo)
                    text = np.repeat(np.arange(hi - lo), np.diff(mine.offsets.to_numpy()))
                    wanted = np.zeros(first[-1] + 1, dtype=bool)
                    wanted[first[text] + mine.flatten().to_numpy(zero_copy_only=False)] = True
                    kept = wanted[first[owner] + number]
                    at = pa.array(owner[kept] + lo)
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).take(at),
                            batch.column(1).take(at),
                            pa.array(pos[kept].astype(np.int32)),
                            _signed(anchor[kept]),
                            _signed(key[kept]),
                        ],
                        names=["doc_id", "t1", "pos", "anchor", "key"],
                    )

        first = self.texts.where("doc_id = first").select("doc_id", "t1", "text")
        return first.join(marked, ["doc_id", "t1"]).select("doc_id", "t1", "text", "runs").mapInArrow(
            run, f"doc_id {kind}, t1 long, pos int, anchor long, key long"
        )

    def _placed(self, found: DataFrame) -> DataFrame:
        """The windows found with the first place of their key."""
        place = F.struct(F.col("doc_id").alias("ref_id"), F.col("pos").alias("ref_pos"))
        index = (
            found.groupBy("anchor", "key")
            .agg(F.min(place).alias("_place"), F.max("doc_id").alias("_last"), F.count(F.lit(1)).alias("_n"))
            .where("_place.ref_id < _last")
            .select("anchor", "key", "_place", "_n")
        )
        index = stage(index, "window_index")
        hot_from = max(HOT_WINDOWS, (index.agg(F.sum("_n")).first()[0] or 0) // MAX_HOT)
        hot = index.where(F.col("_n") >= hot_from).select("anchor", "key", F.lit(SALTS).alias("_salts"))
        if not hot.limit(1).count():
            return found.join(index.drop("_n"), ["anchor", "key"])
        salts = F.when(F.col("_n") >= hot_from, F.lit(SALTS)).otherwise(F.lit(1))
        dealt = index.withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("_n")
        # at most MAX_HOT rows
        salted = found.join(F.broadcast(hot), ["anchor", "key"], "left").withColumn(
            "_salt", F.pmod(F.xxhash64("doc_id", "t1"), F.coalesce("_salts", F.lit(1))).cast("int")
        )
        return salted.join(dealt, ["anchor", "key", "_salt"])

    def _factors(self) -> DataFrame:
        """``doc_id, t1, factors`` (start, length, reference id and position)."""
        kind, window = self.kind, self.window
        shared = (
            self._anchors()
            .groupBy("anchor")
            .agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b"))
            .where("a < b")
            .select("anchor")
        )
        marks = (
            self._anchors()
            .join(_small(shared, "shared_anchors", 16), "anchor")
            .groupBy("doc_id", "t1")
            .agg(F.collect_set("run").alias("runs"))
        )
        marks = stage(marks, "marked_runs")
        volume = marks.agg(F.sum(F.size("runs") * 4 + 40)).first()[0] or 0
        found = self._windows(F.broadcast(marks) if volume <= BROADCAST_BYTES else marks)
        seeds = (
            self._placed(found)
            .where("_place.ref_id < doc_id")
            .groupBy("doc_id", "t1")
            # at most one seed per word of one text, however often it is repeated
            .agg(F.collect_set(F.struct("pos", "_place.ref_id", "_place.ref_pos")).alias("seeds"))
        )

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                lists = batch.column(2)
                pos, ref, at = lists.flatten().flatten()
                n = np.diff(lists.offsets.to_numpy())
                owner = np.repeat(np.arange(len(n)), n)
                pos, at = (c.to_numpy(zero_copy_only=False).astype(np.int64) for c in (pos, at))
                order = np.lexsort((pos, owner))
                owner, pos, at = owner[order], pos[order], at[order]
                ref = ref.take(pa.array(order))
                codes = ref.dictionary_encode().indices.to_numpy(zero_copy_only=False)
                new = np.ones(len(pos), dtype=bool)
                new[1:] = (
                    (owner[1:] != owner[:-1])
                    | (pos[1:] != pos[:-1] + 1)
                    | (codes[1:] != codes[:-1])
                    | (at[1:] != at[:-1] + 1)
                )
                starts = np.flatnonzero(new)
                length = np.diff(np.append(starts, len(pos))) + window - 1
                struct = pa.StructArray.from_arrays(
                    [pa.array(pos[starts]), pa.array(length), ref.take(pa.array(starts)), pa.array(at[starts])],
                    names=["start", "length", "ref_id", "ref_start"],
                )
                bounds = np.searchsorted(owner[starts], np.arange(len(n) + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.ListArray.from_arrays(pa.array(bounds), struct)],
                    names=["doc_id", "t1", "factors"],
                )

        schema = (
            f"doc_id {kind}, t1 long, "
            f"factors array<struct<start: long, length: long, ref_id: {kind}, ref_start: long>>"
        )
        return stage(seeds.mapInArrow(run, schema), "factors")

    def _parsed(self) -> DataFrame:
        """Every row with the spans (start * 2**32 + length) of its own factors,
        or the mark of a copy."""
        spans = F.transform("factors", lambda f: F.shiftleft(f["start"], 32) + f["length"]).alias("spans")
        own = self.factors.select(F.col("doc_id").alias("_own"), "t1", spans)
        volume = own.agg(F.sum(F.size("spans") * 8 + 40)).first()[0] or 0
        copy = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False)).alias("copy")
        rows = self.texts.withColumn("_own", F.when(F.col("doc_id") == F.col("first"), F.col("doc_id")))
        own = F.broadcast(own) if volume <= BROADCAST_BYTES else own
        return rows.join(own, ["_own", "t1"], "left").select("doc_id", "text", copy, "spans")

    def deduplicated(self) -> DataFrame:
        """``doc_id, n_words, n_removed, kept`` (the words left, joined by one
        space) for every row of the documents."""
        kind, window = self.kind, self.window

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts, copy = to_bytes(batch.column(1)), batch.column(2).to_pylist()
                for lo, hi in chunks(texts):
                    removed, kept = [], []
                    spans = batch.column(3).slice(lo, hi - lo).to_pylist()
                    counts = []
                    for i, text in enumerate(texts[lo:hi]):
                        words = text.split()
                        counts.append(len(words))
                        if copy[lo + i] and len(words) >= window:
                            removed.append(len(words))
                            kept.append(b"")
                            continue
                        left, upto = [], 0
                        for span in spans[i] or ():
                            start, length = divmod(span, 1 << 32)
                            left += words[upto:start]
                            upto = max(upto, start + length)
                        left += words[upto:]
                        removed.append(len(words) - len(left))
                        kept.append(b" ".join(left))
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).slice(lo, hi - lo),
                            pa.array(counts, pa.int64()),
                            pa.array(removed, pa.int64()),
                            pa.array(kept, pa.binary()).cast(pa.string(), safe=False),
                        ],
                        names=["doc_id", "n_words", "n_removed", "kept"],
                    )

        return self._parsed().mapInArrow(run, f"doc_id {kind}, n_words long, n_removed long, kept string")


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, n_words, n_removed, kept`` for every row of ``docs``."""
    return Parse(docs, window).deduplicated()
