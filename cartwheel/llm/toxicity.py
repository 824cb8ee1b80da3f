"""Toxicity scores from a bidirectional gated recurrent network.

The network (``gru``) scores windows of 32 words, 16 apart, over the whole
text (words are runs of ASCII letters and digits and other characters); the
document's score is a calibrated logistic of its highest window logit and the
logarithm of its number of windows: the highest of many clean windows is higher
than that of few.  A text without words has one empty window.

*Training.*  Labels come from labelled rows whose ``crc32(doc_id as text) mod
5`` is not 0, at most ``POSITIVES`` toxic and ``NEGATIVES`` other ones, chosen
by a hash of the id, with one text each (that of the least hash, if the id repeats);
nothing but the text is an input.  Whole texts are taken, in the order of the
hash, as far as they fit: at most ``SAMPLE_BYTES``, half of it for either label
if they do not all fit.  Words in at least
``MIN_WORD_DOCS`` and four-grams in at least ``MIN_GRAM_DOCS`` of these texts
get an embedding.  The first passes take all windows of a toxic text as
toxic; later passes only its highest window (multiple-instance learning).
Clean texts are also joined, ``JOINED`` at a time in a random order, so that
windows across texts and those of long texts are learned as clean.  One fifth
of the sample is held back to calibrate, alone and joined (``JOIN_SIZES`` at a
time), every second joined text around a toxic one.

Defined cases: null text is empty; a null id is scored and not held out;
labels that are null or without a document are ignored, of several labels of a
document the highest counts; with no toxic or no other label every score is
the share of toxic labels (0 without labels); an empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.gru import (
    BREAKS,
    CHAR_DIM,
    INPUT,
    STRIDE,
    WINDOW,
    WORD_DIM,
    Adam,
    Net,
    Vocabulary,
    grams,
    sigmoid,
    spread,
    windows,
)
from cartwheel.llm.scratch import stage
from cartwheel.llm.words import Words, chunks, to_bytes

POSITIVES, NEGATIVES = 1000, 2000
#: Bytes of all training texts together.
SAMPLE_BYTES = 64 << 20
MIN_WORD_DOCS, MIN_GRAM_DOCS = 3, 4
#: Training windows of one text in a pass, steps at least, windows in a step.
DOC_WINDOWS, MIN_STEPS, BATCH, RATE, DECAY = 12, 500, 256, 0.01, 1e-4
#: Clean texts joined into one for training, and for calibration.
JOINED, JOIN_SIZES = 10, (4, 16, 64)


class Model:
    """A trained network with its calibration (or a constant score)."""

    def __init__(self, net: Net | None, weights: tuple[float, float, float] = (1.0, 0.0, 0.0), constant: float = 0.0):
        self.net, self.weights, self.constant = net, weights, constant

    def features(self, texts: list[bytes]) -> np.ndarray:
        """Highest logit, logarithm of the number of windows, 1; by text."""
        words = Words(texts, BREAKS)
        return np.stack((self.net.score(words), np.log(windows(words.counts)[0]), np.ones(len(texts))), axis=1)

    def score(self, texts: list[bytes]) -> np.ndarray:
        if self.net is None:
            return np.full(len(texts), self.constant)
        return sigmoid(self.features(texts) @ np.array(self.weights))


class _Counts:
    """Texts of either label that have a code, gathered chunk by chunk."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def add(self, codes: np.ndarray, owner: np.ndarray, y: np.ndarray) -> None:
        order = np.lexsort((owner, codes))
        c, o = codes[order], owner[order]
        new = np.ones(len(c), dtype=bool)
        new[1:] = (c[1:] != c[:-1]) | (o[1:] != o[:-1])
        values, at, n = np.unique(c[new], return_inverse=True, return_counts=True)
        self.parts.append((values, n, np.bincount(at, weights=y[o[new]], minlength=len(values))))

    def evidence(self, least: int, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes that at least ``least`` texts have, and their evidence for
        label 1: the log odds ratio of having them, in standard errors, beyond
        two of them."""
        codes, n, pos = (np.concatenate(x) for x in zip(*self.parts))
        values, at = np.unique(codes, return_inverse=True)
        n, pos = np.bincount(at, weights=n), np.bincount(at, weights=pos)
        keep = n >= least
        values, n, pos = values[keep], n[keep], pos[keep]
        neg = n - pos
        total = max(y.sum(), 1), max((1 - y).sum(), 1)
        odds = np.log((pos + 0.5) / (total[0] - pos + 0.5)) - np.log((neg + 0.5) / (total[1] - neg + 0.5))
        z = np.clip(odds / np.sqrt(1 / (pos + 0.5) + 1 / (neg + 0.5)), -8, 8)
        return values, np.sign(z) * np.maximum(np.abs(z) - 2, 0) / 2


def _calibrate(x: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """Logistic regression of labels on ``Model.features``, slightly
    regularised; more windows never raise a score."""
    prior, strength = np.array([1.0, 0.0, 0.0]), np.array([0.1, 0.1, 0.01])
    free = np.ones(3, dtype=bool)
    while True:
        weights = np.where(free, prior, 0.0)
        for _ in range(60):
            q = sigmoid(x @ weights)
            curve = x.T @ (x * (q * (1 - q) + 1e-6)[:, None]) + np.diag(strength)
            step = np.zeros(3)
            slope = x.T @ (y - q) - strength * (weights - prior)
            step[free] = np.linalg.solve(curve[np.ix_(free, free)], slope[free])
            weights = weights + np.clip(step, -1, 1)
        if weights[1] <= 0:
            return float(max(weights[0], 0.05)), float(weights[1]), float(weights[2])
        free[1] = False


def _joined(texts: list[bytes], size: int, rng: np.random.Generator) -> list[list[bytes]]:
    """The texts in a random order, dealt out ``size`` at a time."""
    order = rng.permutation(len(texts))
    return [[texts[i] for i in order[a : a + size]] for a in range(0, len(order), size)]


def _held_texts(texts: list[bytes], y: np.ndarray, rng: np.random.Generator) -> tuple[list[bytes], np.ndarray]:
    """The texts to calibrate on with their labels: alone and joined."""
    clean, toxic = ([t for t, v in zip(texts, y) if v == label] for label in (0, 1))
    out, labels = list(texts), list(y)
    for size in JOIN_SIZES:
        for i, group in enumerate(_joined(clean, size, rng)):
            if i % 2:
                group.insert(int(rng.integers(len(group) + 1)), toxic[int(rng.integers(len(toxic)))])
            out.append(b" ".join(group))
            labels.append(float(i % 2))
    return out, np.array(labels)


def _gram_rows(bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions of all grams of the words, the number of each word)."""
    n = np.diff(bounds)[0::2]
    return np.repeat(bounds[0::2] - (np.cumsum(n) - n), n) + np.arange(n.sum()), n


class _Sample:
    """Training texts: word and gram rows, windows and their owners.  The
    vocabulary is that of the first ``own`` texts; the others are joined."""

    def __init__(self, texts: list[bytes], y: np.ndarray, own: int):
        self.texts, self.y = texts, y
        words, found = _Counts(), _Counts()
        for lo, hi in chunks(texts[:own]):
            w = Words(texts[lo:hi], BREAKS)
            packed, bounds = grams(w)
            at, n = _gram_rows(bounds)
            words.add(w.hashes(), w.owners(), y[lo:hi])
            found.add(packed[at], np.repeat(w.owners(), n), y[lo:hi])
        word, word_weight = words.evidence(MIN_WORD_DOCS, y[:own])
        gram, gram_weight = found.evidence(MIN_GRAM_DOCS, y[:own])
        known, known_grams = Vocabulary(word), Vocabulary(gram)
        lookup = lambda v, keys, values: np.concatenate(
            ([0], values[np.searchsorted(keys, v.hashes[1:])])
        )
        self.net = Net.new(
            known, known_grams, lookup(known, word, word_weight), lookup(known_grams, gram, gram_weight)
        )
        word_at, gram_at, counts, per_word = [], [], [], []
        for lo, hi in chunks(texts):
            w = Words(texts[lo:hi], BREAKS)
            packed, bounds = grams(w)
            at, n = _gram_rows(bounds)
            word_at.append(known.find(w.hashes()))
            gram_at.append(known_grams.find(packed[at]))
            counts.append(w.counts)
            per_word.append(n)
        self.word_at, self.gram_at = np.concatenate(word_at), np.concatenate(gram_at)
        counts = np.concatenate(counts)
        self.gram_first = np.concatenate(([0], np.cumsum(np.concatenate(per_word))))
        self.blocks, self.length = windows(counts)
        self.owner = np.repeat(np.arange(len(texts)), self.blocks)
        nth = np.arange(len(self.owner)) - np.repeat(np.cumsum(self.blocks) - self.blocks, self.blocks)
        self.start = (np.cumsum(counts) - counts)[self.owner] + nth * STRIDE
        self.live = np.flatnonzero(self.length > 0)

    def logits(self, net: Net) -> np.ndarray:
        """The logit of every window."""
        ends = np.cumsum(self.blocks)
        out = np.zeros(len(self.owner), dtype=np.float32)
        for lo, hi in chunks(self.texts):
            out[ends[lo] - self.blocks[lo] : ends[hi - 1]] = net.window_logits(Words(self.texts[lo:hi], BREAKS))
        return out

    def step(self, net: Net, adam: Adam, chosen: np.ndarray, balance: float) -> None:
        n = self.length[chosen]
        lead = np.cumsum(n) - n
        at = np.repeat(self.start[chosen] - lead, n) + np.arange(n.sum())
        k = self.gram_first[at + 1] - self.gram_first[at]
        gram_lead = np.cumsum(k) - k
        rows = self.gram_at[np.repeat(self.gram_first[at] - gram_lead, k) + np.arange(k.sum())]
        chars = np.add.reduceat(net.p["ec"][rows], gram_lead, axis=0) / k[:, None]
        most = np.maximum.reduceat(net.evidence[rows], gram_lead)
        x = np.zeros((len(chosen), WINDOW, INPUT), dtype=np.float32)
        column = np.repeat(np.arange(len(chosen)), n)
        step = np.arange(n.sum()) - np.repeat(lead, n)
        x[column, step] = np.concatenate((net.p["ew"][self.word_at[at]], chars, most[:, None]), axis=1)
        y = self.y[self.owner[chosen]]
        weights = np.where(y == 1, balance, 1.0)
        weights = (weights / weights.sum()).astype(np.float32)
        g, dx = net.gradients(np.ascontiguousarray(x.transpose(1, 2, 0)), n, y, weights)
        dx = dx.transpose(2, 0, 1)[column, step]
        g["ew"] = spread(self.word_at[at], dx[:, :WORD_DIM], len(net.words)) + DECAY * net.p["ew"]
        chars = np.repeat(dx[:, WORD_DIM : WORD_DIM + CHAR_DIM] / k[:, None], k, axis=0)
        g["ec"] = spread(rows, chars, len(net.grams)) + DECAY * net.p["ec"]
        g["ew"][0] = g["ec"][0] = 0
        adam.step(net.p, g)


def train(texts: list[bytes], labels: np.ndarray, seed: int = 5) -> Model:
    """Fit the network on texts in a given order with labels 0 and 1."""
    labels = np.asarray(labels, dtype=np.float32)
    if len(labels) == 0 or labels.min() == labels.max():
        return Model(None, constant=float(labels.mean()) if len(labels) else 0.0)
    rng = np.random.Generator(np.random.PCG64(seed))
    held = rng.random(len(texts)) < 0.2
    if (labels[held] == 1).sum() < 20 or (labels[held] == 0).sum() < 20:
        held[:] = False  # too few to set aside
    fitted = np.flatnonzero(~held)
    own = [texts[i] for i in fitted]
    joined = [b" ".join(g) for g in _joined([texts[i] for i in fitted if not labels[i]], JOINED, rng)]
    sample = _Sample([*own, *joined], np.concatenate((labels[fitted], np.zeros(len(joined), dtype=np.float32))), len(own))
    if not len(sample.live):
        return Model(None, constant=float(labels.mean()))
    net = sample.net
    adam = Adam(net.p, RATE)
    y = sample.y[sample.owner]
    steps, late = 0, False
    while steps < 2 * MIN_STEPS:
        order = rng.permutation(sample.live)
        if late:  # a toxic text's highest window, the other texts' highest ones
            logit = sample.logits(net)
            order = sample.live[np.argsort(-logit[sample.live], kind="stable")]
        by_text = order[np.argsort(sample.owner[order], kind="stable")]
        rank = np.arange(len(by_text)) - np.searchsorted(sample.owner[by_text], sample.owner[by_text])
        most = np.where(sample.owner[by_text] < len(own), DOC_WINDOWS, DOC_WINDOWS * JOINED // 2)
        if late:
            most[y[by_text] == 1] = 1
        chosen = rng.permutation(by_text[rank < most])
        balance = min(10.0, (1 - y[chosen]).sum() / max(y[chosen].sum(), 1))
        for i in range(0, len(chosen), BATCH):
            sample.step(net, adam, chosen[i : i + BATCH], balance)
            steps += 1
        late = steps >= MIN_STEPS // 2
        if steps > MIN_STEPS:
            adam.rate *= 0.8
    model = Model(net)
    kept = np.flatnonzero(held) if held.any() else fitted
    own, y = _held_texts([texts[i] for i in kept], labels[kept], rng)
    model.weights = _calibrate(np.concatenate([model.features(own[lo:hi]) for lo, hi in chunks(own)]), y)
    return model


def _held_out(column: str):
    return F.coalesce(F.crc32(F.col(column).cast("string")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES) -> Model:
    """Train on the bounded sample of labelled rows described above."""
    known = (
        labels.where("doc_id is not null and toxic is not null")
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
        .where(~_held_out("doc_id"))
    )
    # ids first (a few bytes a row), then the texts of the chosen ones
    mine = known.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    picks = [
        mine.where(F.col("toxic") == t).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
        for t, n in ((1, positives), (0, negatives))
    ]
    chosen = picks[0].union(picks[1]).toPandas()
    if not len(chosen):
        return train([], np.zeros(0))
    sample = docs.sparkSession.createDataFrame(chosen)
    # one text an id, however often the id repeats: at most positives + negatives rows
    one = (
        docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
        .join(F.broadcast(sample), "doc_id")
        .groupBy("doc_id", "toxic")
        .agg(F.min_by("text", F.struct(F.xxhash64("text"), F.length("text"), "text")).alias("text"))
    )
    one = stage(one.withColumn("size", F.octet_length("text").cast("long")), "toxicity_sample")
    sizes = one.select("doc_id", "toxic", "size").orderBy(F.xxhash64("doc_id"), "doc_id").toPandas()
    if sizes["size"].sum() > SAMPLE_BYTES:
        room = {t: SAMPLE_BYTES // 2 for t in (0, 1)}
        fits = []
        for t, n in zip(sizes["toxic"], sizes["size"]):
            fits.append(n <= room[t])
            room[t] -= n if fits[-1] else 0
        ids = docs.sparkSession.createDataFrame([(x,) for x in sizes["doc_id"][fits].tolist()], one.select("doc_id").schema)
        one = one.join(F.broadcast(ids), "doc_id", "left_semi")
    rows = one.orderBy(F.xxhash64("doc_id"), "doc_id").toPandas()
    texts = [t.encode() for t in rows["text"]]
    return train(texts, rows["toxic"].to_numpy())


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = to_bytes(batch.column(1))
            for lo, hi in chunks(texts):
                s = model.value.score(texts[lo:hi])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(s)], names=["doc_id", "score"]
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return (
        docs.select("doc_id", "text")
        .mapInArrow(run, f"doc_id {kind}, score double")
        .select("doc_id", _held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
    )


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` not predicted toxic, with all their columns."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))
    text = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = to_bytes(batch.column(text))
            for lo, hi in chunks(texts):
                yield batch.slice(lo, hi - lo).filter(pa.array(model.value.score(texts[lo:hi]) < 0.5))

    return docs.mapInArrow(run, docs.schema)
