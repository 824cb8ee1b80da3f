"""SentencePiece encoding and decoding by batched Viterbi in numpy.

*Units.*  A text gets the dummy prefix, blanks become ``\\u2581``, and it is cut
before every run of ``\\u2581``: no piece of a word-based model spans such a
place (if one does, the whole text is one unit).  Each distinct unit is encoded
once per worker and kept.

*Viterbi.*  Units of similar length advance together: for every piece length
the rolling hashes of all substrings probe the sorted hashes of the pieces; then,
end position by end position, the highest sum of scores over the lengths is kept
with its backpointer (the length) and its last piece.

*Unigram models* are just that.  *BPE models* need one thing more: the ids of
their merge order are not those of the best score.  But a segmentation is the
merge result exactly if each of its adjacent pairs is (merging the two pieces'
characters gives back the two pieces), so transitions are restricted to such
pairs; the pair test is the merge loop on one pair, kept per worker.  The ids
then equal the library's.

Characters without a piece become the byte pieces of their UTF-8, or the
unknown id (once for neighbours) if the model has none.

Defined cases: null text is empty and has no ids; a ``\\u2581`` in a text
decodes to a blank; repeated rows and null ids are encoded row by row; an
empty table gives an empty result; other columns are ignored.  Models that
rewrite characters (a compiled character map) are refused.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

SPACE = "▁"
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
KNOWN_UNITS, KNOWN_PAIRS, BATCH_CELLS = 800_000, 2_000_000, 400_000
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of the fields of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        elif kind == 2:
            n = varint()
            yield key >> 3, data[at : at + n]
            at += n
        else:
            n = 4 if kind == 5 else 8
            yield key >> 3, data[at : at + n]
            at += n


class Model:
    """Pieces, scores and settings of a SentencePiece model file."""

    def __init__(self, data: bytes):
        self.pieces: list[str] = []
        self.scores: list[float] = []
        self.types: list[int] = []
        self.kind, self.prefix, self.squeeze = UNIGRAM, True, True
        for number, value in _fields(data):
            if number == 1:
                piece = dict(_fields(value))
                self.pieces.append(piece[1].decode())
                self.scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
                self.types.append(piece.get(3, NORMAL))
            elif number == 2:
                self.kind = dict(_fields(value)).get(3, UNIGRAM)
            elif number == 3:
                spec = dict(_fields(value))
                self.prefix, self.squeeze = bool(spec.get(3, 1)), bool(spec.get(4, 1))
                if spec.get(2):
                    raise ValueError("models with a character map are not supported")
        self.bytes = {int(p[3:5], 16): i for i, p in enumerate(self.pieces) if self.types[i] == BYTE}
        self.unknown = next((i for i, t in enumerate(self.types) if t == UNKNOWN), 0)

    def raw(self) -> list[bytes]:
        """What each id stands for when decoding (blanks still marked)."""
        out = []
        for p, t in zip(self.pieces, self.types):
            if t == BYTE:
                out.append(bytes([int(p[3:5], 16)]))
            elif t == CONTROL:
                out.append(b"")
            else:
                out.append(" ⁇ ".encode() if t == UNKNOWN else p.encode())
        return out


class Encoder:
    def __init__(self, data: bytes):
        m = self.model = Model(data)
        self.size = len(m.pieces)
        self.rank = {p: s for p, s, t in zip(m.pieces, m.scores, m.types) if t in (NORMAL, USER)}
        usable = [i for i, t in enumerate(m.types) if t in (NORMAL, USER)]
        if m.kind == BPE:  # pieces their own merges never give cannot appear
            usable = [i for i in usable if len(m.pieces[i]) == 1 or self.merge(m.pieces[i]) == [m.pieces[i]]]
        self.longest = max((len(m.pieces[i]) for i in usable), default=1)
        keys = np.array([_string_hash(m.pieces[i]) for i in usable], dtype=np.uint64)
        order = np.argsort(keys)
        self.keys, self.ids = keys[order], np.array(usable, dtype=np.int64)[order]
        self.lengths = np.array([len(m.pieces[i]) for i in usable], dtype=np.int64)[order]
        # most substrings are no piece: a table of the keys' low bits tells so
        self.marks = np.zeros(1 << 20, dtype=bool)
        self.marks[self.keys & np.uint64((1 << 20) - 1)] = True
        self.scores = np.array([m.scores[i] for i in usable])[order]
        self.unknown_score = (float(self.scores.min()) if len(usable) else 0.0) - 10.0
        self.whole = any(SPACE in m.pieces[i].lstrip(SPACE) for i in usable)
        self.units: dict[str, bytes] = {}
        # pairs tested so far: sorted ones (the first is none) and recent ones
        self.pairs, self.pairs_apart = np.array([-1], dtype=np.int64), np.zeros(1, dtype=bool)
        self.recent_pairs: dict[int, bool] = {}

    # --- BPE pairs ---

    def merge(self, text: str) -> list[str]:
        """The merge loop: the best scored neighbours first, leftmost of
        equals."""
        parts, rank, none = list(text), self.rank.get, -np.inf
        scores = [rank(a + b, none) for a, b in zip(parts, parts[1:])]
        while scores and (best := max(scores)) > none:
            i = scores.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del scores[i]
            if i < len(scores):
                scores[i] = rank(parts[i] + parts[i + 1], none)
            if i:
                scores[i - 1] = rank(parts[i - 1] + parts[i], none)
        return parts

    def _stay(self, a: str, b: str) -> bool:
        """``merge(a + b) == [a, b]`` for two strings that merge to themselves:
        no merge joins them before all others are done, or then."""
        parts, rank, none = list(a + b), self.rank.get, -np.inf
        scores = [rank(x + y, none) for x, y in zip(parts, parts[1:])]
        at = len(a) - 1
        while (best := max(scores)) > none:
            i = scores.index(best)
            if i == at:
                return False
            at -= i < at
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del scores[i]
            if i < len(scores):
                scores[i] = rank(parts[i] + parts[i + 1], none)
            if i:
                scores[i - 1] = rank(parts[i - 1] + parts[i], none)
        return True

    def _string(self, i: int) -> str:
        return self.model.pieces[i] if i < self.size else chr(i - self.size)

    def _apart(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether merging leaves each pair of ids as it is."""
        key = left * (self.size + 0x110000) + right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        out = self.pairs_apart[at]
        new = np.flatnonzero(self.pairs[at] != key)
        if len(new):
            fresh, recent = self.recent_pairs, []
            for k in key[new].tolist():
                ok = fresh.get(k)
                if ok is None:
                    a, b = divmod(k, self.size + 0x110000)
                    ok = fresh[k] = self._stay(self._string(a), self._string(b))
                recent.append(ok)
            out[new] = recent
            if len(fresh) > 1000 + len(self.pairs) // 8:
                self._settle()
        return out

    def _settle(self) -> None:
        """Move the recent pairs to the sorted ones (all go when full)."""
        if len(self.pairs) > KNOWN_PAIRS:
            self.pairs, self.pairs_apart = self.pairs[:1], self.pairs_apart[:1]
        keys = np.concatenate((self.pairs, np.fromiter(self.recent_pairs, dtype=np.int64)))
        apart = np.concatenate((self.pairs_apart, np.fromiter(self.recent_pairs.values(), dtype=bool)))
        order = np.argsort(keys, kind="stable")
        self.pairs, self.pairs_apart = keys[order], apart[order]
        self.recent_pairs.clear()

    # --- Viterbi ---

    def _hits(self, prefix: np.ndarray, sizes: np.ndarray, k: int, power: np.uint64, lo: int, hi: int) -> tuple[np.ndarray, ...]:
        """Rows, ids and scores of the pieces of length ``k`` that end at ``lo``
        to ``hi - 1`` in the units, by end, and where those of each end begin."""
        first = max(lo, k)
        key = (prefix[first:hi] - prefix[first - k : max(hi - k, 0)] * power).ravel()
        cell = np.flatnonzero(self.marks[key & np.uint64((1 << 20) - 1)])
        key = key[cell]
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = (self.keys[at] == key) & (self.lengths[at] == k)
        end, rows = np.divmod(cell[hit], prefix.shape[1])
        end += first
        inside = end <= sizes[rows]
        end, rows, at = end[inside], rows[inside], at[hit][inside]
        return rows, self.ids[at], self.scores[at], np.searchsorted(end, np.arange(lo, hi + 1))

    def _batch(self, units: list[str]) -> list[np.ndarray]:
        """Ids of units, given from the shortest to the longest; ids past the
        vocabulary are characters without a piece."""
        n, m = len(units[-1]), len(units)
        sizes = np.array([len(u) for u in units])
        chars = np.zeros((m, n), dtype=np.uint64)
        chars[np.arange(n) < sizes[:, None]] = np.frombuffer("".join(units).encode("utf-32-le"), dtype="<u4")
        chars = np.ascontiguousarray(chars.T)
        prefix = np.zeros((n + 1, m), dtype=np.uint64)
        for i in range(n):
            prefix[i + 1] = prefix[i] * _BASE + chars[i] + np.uint64(1)
        best = np.full((n + 1, m), -np.inf)
        best[0] = 0
        last = np.full((n + 1, m), -1, dtype=np.int64)
        back = np.zeros((n + 1, m), dtype=np.int32)
        powers = np.cumprod(np.full(self.longest, _BASE), dtype=np.uint64)
        bpe = self.model.kind == BPE
        shortest = np.searchsorted(sizes, np.arange(n + 1)).tolist()
        step = max(1, BATCH_CELLS // m)
        for i in range(1, n + 1):
            lo = i - (i - 1) % step
            if i == lo:
                hi = min(lo + step, n + 1)
                hits = [self._hits(prefix, sizes, k, powers[k - 1], lo, hi) for k in range(1, self.longest + 1)]
                # every character is a piece or unknown
                single, single_score = self.size + chars[lo - 1 : hi - 1].astype(np.int64), np.full((hi - lo, m), self.unknown_score)
                rows, piece, score, begin = hits[0]
                end = np.repeat(np.arange(hi - lo), np.diff(begin))
                single[end, rows], single_score[end, rows] = piece, score
            for k in range(1, min(self.longest, i) + 1):
                if k == 1:
                    rows = np.arange(shortest[i], m)
                    piece, score = single[i - lo, shortest[i] :], single_score[i - lo, shortest[i] :]
                else:
                    rows, piece, score, begin = hits[k - 1]
                    here = slice(begin[i - lo], begin[i - lo + 1])
                    if here.start == here.stop:
                        continue
                    rows, piece, score = rows[here], piece[here], score[here]
                total = best[i - k, rows] + score
                keep = np.flatnonzero(total > best[i, rows])
                if bpe and i > k and len(keep):
                    keep = keep[self._apart(last[i - k, rows[keep]], piece[keep])]
                rows = rows[keep]
                best[i, rows] = total[keep]
                last[i, rows], back[i, rows] = piece[keep], k
        # all paths back at once, written from the right of each row
        ids = np.zeros((m, n), dtype="<u4")
        at, begin, live = sizes.copy(), np.full(m, n), np.arange(m)
        while len(live):
            begin[live] -= 1
            ids[live, begin[live]] = last[at[live], live]
            at[live] -= back[at[live], live]
            live = live[at[live] > 0]
        return [row[b:] for row, b in zip(ids, begin.tolist())]

    def _batches(self, units: set[str]) -> Iterator[list[str]]:
        """The units by length, those together of which the longest has at most
        twice the shortest's characters and some."""
        part: list[str] = []
        for u in sorted(units, key=len):
            if part and ((len(part) + 1) * len(u) > BATCH_CELLS or len(u) > 2 * len(part[0]) + 8):
                yield part
                part = []
            part.append(u)
        if part:
            yield part

    def _learn(self, units: set[str]) -> None:
        if len(self.units) + len(units) > KNOWN_UNITS:
            self.units.clear()
        m = self.model
        for part in self._batches(units):
            paths = self._batch(part)
            ends = np.cumsum([len(x) for x in paths])
            flat = np.concatenate(paths)
            odd = np.logical_or.reduceat(flat >= self.size, np.append(0, ends[:-1])).tolist()
            raw, lo = flat.tobytes(), 0
            for u, path, hi, unknown in zip(part, paths, (4 * ends).tolist(), odd):
                if not unknown:
                    self.units[u] = raw[lo:hi]
                else:
                    ids: list[int] = []
                    for p in path.tolist():
                        if p < self.size:
                            ids.append(p)
                        elif m.bytes:
                            ids += [m.bytes[b] for b in chr(p - self.size).encode()]
                        elif not ids or ids[-1] != m.unknown:
                            ids.append(m.unknown)
                    self.units[u] = np.array(ids, dtype="<u4").tobytes()
                lo = hi

    def _units(self, text: str) -> list[str]:
        if self.model.prefix and not self.whole and SPACE not in text and "" not in (parts := text.split(" ")):
            return [SPACE + x for x in parts]
        if self.model.squeeze:
            text = " ".join(x for x in text.split(" ") if x)
        if not text:
            return []
        text = ((SPACE if self.model.prefix else "") + text).replace(" ", SPACE)
        if self.whole:
            return [text]
        out, run = [], ""
        for part in text.split(SPACE)[1:] if text[0] == SPACE else text.split(SPACE):
            run += SPACE if out or run or text[0] == SPACE else ""
            if part:
                out.append(run + part)
                run = ""
        if run:
            out.append(run)
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit numbers."""
        units = [self._units(t) for t in texts]
        used = set().union(*units)
        new = used.difference(self.units)
        if new:
            held = len(self.units)
            self._learn(new)
            if len(self.units) < held + len(new):  # began anew: learn the others again
                self._learn(used.difference(self.units))
        known = self.units.__getitem__
        return [b"".join(map(known, x)) for x in units]

    def decode(self, ids: bytes) -> str:
        raw = self.raw_pieces
        text = b"".join([raw[i] for i in np.frombuffer(ids, dtype="<u4").tolist()]).decode("utf-8", "replace")
        text = text.replace(SPACE, " ")
        return text[1:] if self.model.prefix and text.startswith(" ") else text

    @property
    def raw_pieces(self) -> list[bytes]:
        if not hasattr(self, "_raw"):
            self._raw = self.model.raw()
        return self._raw


def _string_hash(s: str) -> int:
    h = 0
    for c in s:
        h = (h * int(_BASE) + ord(c) + 1) & 0xFFFFFFFFFFFFFFFF
    return h


_LOADED: dict[int, Encoder] = {}


def _encoder(data: bytes) -> Encoder:
    key = zlib.crc32(data)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Encoder(data)
    return _LOADED[key]


def _parts(texts: list[str], limit: int = 1 << 22) -> Iterator[tuple[int, int]]:
    lo = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > limit:
            yield lo, i
            lo, size = i, 0
        size += len(t)
    if lo < len(texts):
        yield lo, len(texts)


def _model(docs: DataFrame, model_file: str):
    with open(model_file, "rb") as f:
        return docs.sparkSession.sparkContext.broadcast(f.read())


def encode(docs: DataFrame, model_file: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id, ids`` per row."""
    data = _model(docs, model_file)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(data.value)
        for batch in batches:
            texts = [x or "" for x in batch.column(1).to_pylist()]
            for lo, hi in _parts(texts):
                ids = [np.frombuffer(x, dtype="<u4").astype(np.int32) for x in encoder.encode(texts[lo:hi])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(ids, pa.list_(pa.int32()))], names=[id_column, "ids"]
                )

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(id_column, text_column).mapInArrow(run, f"`{id_column}` {kind}, ids array<int>")


def decode(encoded: DataFrame, model_file: str, id_column: str = "doc_id") -> DataFrame:
    """``id, text`` per row of ``id, ids``; null ids give an empty text."""
    data = _model(encoded, model_file)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(data.value)
        for batch in batches:
            ids = [np.array(x or [], dtype="<u4").tobytes() for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([encoder.decode(x) for x in ids], pa.string())], names=[id_column, "text"]
            )

    kind = encoded.schema[id_column].dataType.simpleString()
    return encoded.select(id_column, "ids").mapInArrow(run, f"`{id_column}` {kind}, text string")


def round_trip(docs: DataFrame, model_file: str) -> DataFrame:
    """``doc_id, n_pieces, ids_crc32, exact``: of each text the number and
    checksum (of little-endian unsigned 32-bit ids) of its ids, and whether
    they decode to the text (with ``\\u2581`` read as a blank)."""
    data = _model(docs, model_file)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(data.value)
        for batch in batches:
            texts = [x or "" for x in batch.column(1).to_pylist()]
            for lo, hi in _parts(texts):
                ids = encoder.encode(texts[lo:hi])
                exact = [encoder.decode(x) == t.replace(SPACE, " ") for x, t in zip(ids, texts[lo:hi])]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, hi - lo),
                        pa.array([len(x) // 4 for x in ids], pa.int64()),
                        pa.array([zlib.crc32(x) for x in ids], pa.int64()),
                        pa.array(exact, pa.bool_()),
                    ],
                    names=["doc_id", "n_pieces", "ids_crc32", "exact"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_pieces long, ids_crc32 long, exact boolean"
    )
