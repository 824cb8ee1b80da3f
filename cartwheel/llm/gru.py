"""A bidirectional gated recurrent network with attention pooling, in numpy.

Inputs per word: an embedding of the word, the mean embedding of its character
four-grams, and the largest evidence weight among them.  The states of both
directions over a window of words are pooled by a learned attention, and a
linear layer gives the window's logit.  Arrays are laid out feature by window,
so every gate is one contiguous block.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

from cartwheel.llm.words import Words

WORD_DIM, CHAR_DIM, HIDDEN = 6, 4, 8
INPUT = WORD_DIM + CHAR_DIM + 1
#: Words of a window; the next window begins ``STRIDE`` words later.
WINDOW, STRIDE = 32, 16

F32 = np.float32


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Vocabulary:
    """Known hashes, found through two slot tables and an equality test;
    index 0 is any unknown one.  A hash that loses both its slots is dropped
    from the vocabulary."""

    def __init__(self, hashes: np.ndarray):
        hashes = np.unique(hashes.astype(np.uint64))
        hashes = hashes[hashes != 0]
        self.bits = max(12, int(len(hashes)).bit_length() + 3)
        for _ in (0, 1):
            self.hashes = np.concatenate((np.zeros(1, dtype=np.uint64), hashes))
            self.slots = np.zeros((2, 1 << self.bits), dtype=np.int32)
            for side in (0, 1):
                self.slots[side, self._at(hashes, side)] = np.arange(1, len(hashes) + 1, dtype=np.int32)
            hashes = hashes[self.find(hashes) > 0]

    def _at(self, h: np.ndarray, side: int) -> np.ndarray:
        k = np.uint64(0x9E3779B97F4A7C15 if side else 0xD6E8FEB86659FD93)
        return (h * k) >> np.uint64(64 - self.bits)

    def find(self, h: np.ndarray) -> np.ndarray:
        a = self.slots[0, self._at(h, 0)]
        out = np.where(self.hashes[a] == h, a, 0)
        miss = np.flatnonzero(out == 0)
        b = self.slots[1, self._at(h[miss], 1)]
        out[miss] = np.where(self.hashes[b] == h[miss], b, 0)
        return out

    def __len__(self) -> int:
        return len(self.hashes)


#: All ASCII but letters and digits stands between words here.
BREAKS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[BREAKS] = 32


def grams(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(four bytes from every position as one number, bounds): the grams of
    word ``w`` are those from ``bounds[2 w]`` to ``bounds[2 w + 1]``.  A word
    counts what stands around it as a blank."""
    d = np.concatenate(([32], _FOLD[words.data], [32, 32, 32])).astype(np.uint64)
    packed = d[:-3] | d[1:-2] << np.uint64(8) | d[2:-1] << np.uint64(16) | d[3:] << np.uint64(24)
    bounds = np.empty(2 * len(words.starts), dtype=np.int64)
    bounds[0::2] = words.starts  # the padded position before the word
    bounds[1::2] = np.maximum(words.ends - 1, words.starts + 1)
    return packed, bounds


def windows(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Blocks of ``STRIDE`` words per text (at least one), and the words from
    each block's start to the window's end within the text."""
    blocks = np.maximum(-(-counts // STRIDE), 1)
    nth = np.arange(blocks.sum()) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    return blocks, np.clip(np.repeat(counts, blocks) - nth * STRIDE, 0, WINDOW)


@dataclass
class Net:
    words: Vocabulary
    grams: Vocabulary
    evidence: np.ndarray  # of each gram
    p: dict[str, np.ndarray] = field(default_factory=dict)

    @classmethod
    def new(cls, words: Vocabulary, grams_: Vocabulary, word_evidence: np.ndarray, evidence: np.ndarray, seed: int = 11) -> Net:
        rng = np.random.Generator(np.random.PCG64(seed))

        def normal(*shape: int, scale: float) -> np.ndarray:
            return (rng.standard_normal(shape) * scale).astype(F32)

        h = HIDDEN
        p = {
            "ew": normal(len(words), WORD_DIM, scale=0.02),
            "ec": normal(len(grams_), CHAR_DIM, scale=0.02),
            "att": normal(2 * h, scale=0.3),
            "out": normal(2 * h, scale=0.3),
            "bias": np.full(1, -1.0, dtype=F32),
        }
        for s in "fb":
            p["wx" + s] = normal(3 * h, INPUT, scale=0.4)
            p["wh" + s] = normal(3 * h, h, scale=0.3)
            p["b" + s] = np.zeros((3 * h, 1), dtype=F32)
        p["ew"][:, 0] = word_evidence
        p["ew"][0] = p["ec"][0] = 0
        return cls(words, grams_, evidence.astype(F32), p)

    def inputs(self, words: Words) -> np.ndarray:
        """The input vector of each word."""
        if not len(words.starts):
            return np.zeros((0, INPUT), dtype=F32)
        packed, bounds = grams(words)
        at = self.grams.find(packed)
        n = np.diff(bounds)[0::2].astype(F32)[:, None]
        chars = np.add.reduceat(self.p["ec"][at], bounds, axis=0)[0::2] / n
        most = np.maximum.reduceat(self.evidence[at], bounds)[0::2]
        return np.concatenate((self.p["ew"][self.words.find(words.hashes())], chars, most[:, None]), axis=1)

    def _cell(self, s: str, a: np.ndarray, now: np.ndarray):
        h = HIDDEN
        u = self.p["wh" + s] @ now
        zr = a[: 2 * h] + u[: 2 * h]
        np.negative(zr, out=zr)
        np.minimum(zr, F32(30), out=zr)
        np.exp(zr, out=zr)
        zr += F32(1)
        np.reciprocal(zr, out=zr)
        z, r, un = zr[:h], zr[h:], u[2 * h :]
        c = np.tanh(a[2 * h :] + r * un)
        return c + z * (now - c), z, r, c, un

    def score(self, words: Words) -> np.ndarray:
        """The highest window logit of each text; a text without words has the
        logit of an empty window."""
        blocks = windows(words.counts)[0]
        return np.maximum.reduceat(self.window_logits(words), np.cumsum(blocks) - blocks).astype(float)

    def window_logits(self, words: Words, columns: int = 2048) -> np.ndarray:
        """The logits of all windows, text by text."""
        x = self.inputs(words)
        blocks, length = windows(words.counts)
        n = len(length)
        # words in blocks: padded position of each word
        first = (np.cumsum(blocks) - blocks) * STRIDE
        at = np.arange(len(x)) + np.repeat(first - words.first[:-1], words.counts)
        laid = np.zeros(((n + WINDOW // STRIDE) * STRIDE, INPUT), dtype=F32)
        laid[at] = x
        laid = np.ascontiguousarray(laid.reshape(-1, STRIDE, INPUT).transpose(1, 2, 0))
        logit = np.empty(n, dtype=F32)
        for lo in range(0, n, columns):
            hi = min(n, lo + columns)
            logit[lo:hi] = self._windows(laid, lo, hi, length[lo:hi])
        return logit

    def _windows(self, laid: np.ndarray, lo: int, hi: int, length: np.ndarray) -> np.ndarray:
        p, h = self.p, HIDDEN
        tail = WINDOW // STRIDE
        energy = np.zeros((WINDOW, hi - lo), dtype=F32)
        value = np.zeros((WINDOW, hi - lo), dtype=F32)
        live = np.arange(WINDOW)[:, None] < length
        whole = live.all(axis=1)
        for i, s in enumerate("fb"):
            proj = np.matmul(p["wx" + s], laid[:, :, lo : hi + tail]) + p["b" + s]
            head = np.stack((p["att"][i * h : i * h + h], p["out"][i * h : i * h + h]))
            now = np.zeros((h, hi - lo), dtype=F32)
            for t in range(WINDOW) if s == "f" else range(WINDOW - 1, -1, -1):
                a = proj[t % STRIDE][:, t // STRIDE : t // STRIDE + hi - lo]
                new = self._cell(s, a, now)[0]
                now = new if whole[t] else np.where(live[t], new, now)
                e, v = head @ now
                energy[t] += e
                value[t] += v
        energy = np.where(live, energy, F32(-1e9))
        weight = np.exp(energy - energy.max(axis=0)) * live
        return (weight * value).sum(axis=0) / np.maximum(weight.sum(axis=0), F32(1e-9)) + p["bias"][0]

    def gradients(self, x: np.ndarray, length: np.ndarray, target: np.ndarray, weights: np.ndarray):
        """(gradients of the weighted cross entropy, that of the inputs) of
        windows ``x`` laid out step, feature, window."""
        p, h, steps = self.p, HIDDEN, len(x)
        live = (np.arange(steps)[:, None] < length)[:, None, :]
        both = np.zeros((steps, 2 * h, x.shape[2]), dtype=F32)
        held: dict = {"f": {}, "b": {}}
        for i, s in enumerate("fb"):
            now = np.zeros((h, x.shape[2]), dtype=F32)
            proj = np.matmul(p["wx" + s], x) + p["b" + s]
            for t in range(steps) if s == "f" else range(steps - 1, -1, -1):
                new, z, r, c, un = self._cell(s, proj[t], now)
                held[s][t] = (now, z, r, c, un)
                now = np.where(live[t], new, now)
                both[t, i * h : i * h + h] = now
        energy = np.where(live[:, 0], np.einsum("k,tkn->tn", p["att"], both), F32(-1e9))
        weight = np.exp(energy - energy.max(axis=0)) * live[:, 0]
        weight /= np.maximum(weight.sum(axis=0), F32(1e-9))
        value = np.einsum("k,tkn->tn", p["out"], both)
        logit = (weight * value).sum(axis=0) + p["bias"][0]
        d = ((sigmoid(logit) - target) * weights).astype(F32)
        g = {"bias": np.array([d.sum()], dtype=F32), "out": np.einsum("tn,tkn->k", weight * d, both)}
        de = weight * (value - (weight * value).sum(axis=0)) * d
        g["att"] = np.einsum("tn,tkn->k", de, both)
        dboth = (weight * d)[:, None] * p["out"][:, None] + de[:, None] * p["att"][:, None]
        dx = np.zeros_like(x)
        for i, s in enumerate("fb"):
            gh, gb = np.zeros_like(p["wh" + s]), np.zeros_like(p["b" + s])
            das = np.zeros((steps, 3 * h, x.shape[2]), dtype=F32)
            carry = np.zeros((h, x.shape[2]), dtype=F32)
            for t in range(steps - 1, -1, -1) if s == "f" else range(steps):
                before, z, r, c, un = held[s][t]
                dh = carry + dboth[t, i * h : i * h + h]
                dnew = dh * live[t]
                dc = dnew * (1 - z) * (1 - c * c)
                dz = dnew * (before - c) * z * (1 - z)
                dr = dc * un * r * (1 - r)
                das[t] = np.concatenate((dz, dr, dc))
                du = np.concatenate((dz, dr, dc * r))
                carry = np.where(live[t], dnew * z, dh) + p["wh" + s].T @ du
                gh += du @ before.T
                gb += das[t].sum(axis=1, keepdims=True)
            g["wh" + s], g["b" + s] = gh, gb
            g["wx" + s] = np.matmul(das, x.transpose(0, 2, 1)).sum(axis=0)
            dx += np.matmul(p["wx" + s].T, das)
        return g, dx


class Adam:
    def __init__(self, p: dict[str, np.ndarray], rate: float):
        self.rate, self.t = rate, 0
        self.m = {k: np.zeros_like(v) for k, v in p.items()}
        self.v = {k: np.zeros_like(v) for k, v in p.items()}

    def step(self, p: dict[str, np.ndarray], g: dict[str, np.ndarray]) -> None:
        self.t += 1
        fix = F32(self.rate * np.sqrt(1 - 0.999**self.t) / (1 - 0.9**self.t))
        for k, d in g.items():
            m, v = self.m[k], self.v[k]
            m += F32(0.1) * (d - m)
            v += F32(0.001) * (d * d - v)
            p[k] -= fix * m / (np.sqrt(v) + F32(1e-7))


def spread(rows: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sum of ``values`` per row index."""
    return np.stack([np.bincount(rows, weights=v, minlength=n) for v in values.T], axis=1).astype(F32)
