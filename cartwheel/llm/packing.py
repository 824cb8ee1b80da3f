"""Token sequences of a fixed length, packed shortest-pack-first.

A document is its token ids followed by one end id; null text has the end id
only.  It is cut into pieces of the sequence length and a remainder.  The
histogram of piece lengths (at most ``length`` cells) goes to the driver,
where lengths are placed longest first, each into the packs with the most room
left ("shortest-pack-first histogram packing", Krell et al.): the plan is a
list of packing patterns with counts, never of pieces.  Back on the cluster
every piece gets its rank among those of its length; the plan turns the rank
into a sequence and an offset.  Ranks need no sort: each tokenising task
numbers its pieces of a length as it writes them, and the counts of the tasks
before it are added.  The ids go with their piece all the way, as one binary
value of little-endian 32-bit numbers; ``sequences`` puts the pieces of each
sequence together.

Defined cases: repeated rows and null ids are documents of their own; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
import os
import re
import sys
import unicodedata
from array import array
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.llm.scratch import arrow_rows, stage
from cartwheel.llm.words import chunks, to_bytes

LENGTH, END_ID = 2048, 1
#: Words whose ids a worker keeps (those met lately and as many met before
#: them), and parts of words; about 100 bytes each.  On the given texts one word
#: in fourteen is not among them, with 120,000 one in eight.
KNOWN_WORDS = 500_000
#: Texts that are sent to a worker, and turned into bytes there, at once.
BATCH_ROWS = 1000
#: Rows of the table of counts (one per task and length) that are broadcast.
BROADCAST_COUNTS = 2_000_000


#: Printable ASCII and the Latin letters up to U+017F, but for the dotted
#: capital I (whose lower case is two characters): words of these are in normal
#: form, their lower case is that of each character.
_PLAIN = re.compile("[!-~\xa1-\u012f\u0131-\u017f]+")
_LETTERS, _DIGITS = (
    "".join(chr(c) for c in range(0x21, 0x180) if unicodedata.category(chr(c))[0] == kind) for kind in "LN"
)
#: How the given tokenizer cuts a lower-case word of these (its own pattern);
#: the pattern is held against the tokenizer before it is used.
_CUT = re.compile(f"'(?:s|t|re|ve|m|ll|d)|[{_LETTERS}]+|[{_DIGITS}]|[^{_LETTERS}{_DIGITS}]+")
_PROBES = (
    "don't 'tis it's x'' ''s we'll i'd they've 3d a1b22c #a_b-c *** (x), e.g.: a/b $9.50 ~'~ ``re' !\"%&<=>?@[]^{|}\\ +; "
    "éa Él'été ÀB.c «ŵé» ñ1½x ²ª× ßß'll Œuvre,&&& ÿŸ ſt µm£5 ¿qué? naïve's Þór·ĳ"
)


def _bytes(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit numbers."""
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


class WordIds(dict):
    """Ids (as bytes) of the words of a tokenizer that never joins across
    white space: a text's ids are those of its words, one after the other.

    A word that is not known yet goes through the tokenizer's own steps:
    normalizer, pre-tokenizer, model.  For plain words the first two are a
    pattern, if the tokenizer agrees with it on the probes, and the ids of
    their parts are kept too; words with a special token's first characters are
    encoded as a whole.  When it is full, the words become the older ones and
    those older before are forgotten, so frequent words stay."""

    def __init__(self, tokenizer, limit: int | None = None):
        super().__init__()
        self.tokenizer, self.limit = tokenizer, limit or KNOWN_WORDS
        self.older: dict[bytes, bytes] = {}
        self.parts: dict[str, bytes] = {}
        self.cut = True
        self.cut = all(self._ids(w) == _bytes(self._whole(w)) for w in _PROBES.split())

    def _whole(self, word: str) -> list[int]:
        return self.tokenizer.encode(word, add_special_tokens=False).ids

    def _part(self, part: str) -> bytes:
        found = self.parts.get(part)
        if found is None:
            t = self.tokenizer
            if len(self.parts) >= self.limit:
                self.parts.clear()
            mapped = part if part.isascii() else "".join(p for p, _ in t.pre_tokenizer.pre_tokenize_str(part))
            found = self.parts[part] = _bytes([x.id for x in t.model.tokenize(mapped)])
        return found

    def _ids(self, word: str) -> bytes:
        t = self.tokenizer
        if self.cut and _PLAIN.fullmatch(word):
            return b"".join(map(self._part, _CUT.findall(word.lower())))
        if t.normalizer and t.pre_tokenizer:
            parts = [p for p, _ in t.pre_tokenizer.pre_tokenize_str(t.normalizer.normalize_str(word))]
            return _bytes([x.id for p in parts for x in t.model.tokenize(p)])
        return _bytes(self._whole(word))

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= self.limit:
            self.older = dict(self)
            self.clear()
        ids = self.older.get(word)
        if ids is None:
            ids = _bytes(self._whole(word.decode())) if b"<|" in word else self._ids(word.decode())
        self[word] = ids
        return ids

    def ids(self, texts: list[bytes]) -> list[bytes]:
        # ASCII letters lose their case anyhow, but not in special tokens
        known = self.__getitem__
        return [b"".join(map(known, (t if b"<|" in t else t.lower()).split())) for t in texts]


_LOADED: dict[str, WordIds] = {}


def _word_ids(source: str, limit: int) -> WordIds:
    if source not in _LOADED:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        _LOADED.clear()
        _LOADED[source] = WordIds(Tokenizer.from_str(source), limit)
    _LOADED[source].limit = limit
    return _LOADED[source]


class _Numbers:
    """Numbers the pieces of each length in the order they come."""

    def __init__(self, length: int):
        self.given = np.zeros(length + 1, dtype=np.int64)

    def next(self, size: np.ndarray) -> np.ndarray:
        order = np.argsort(size, kind="stable")
        same = size[order]
        nth = np.empty(len(size), dtype=np.int64)
        nth[order] = self.given[same] + np.arange(len(size)) - np.searchsorted(same, same)
        self.given += np.bincount(size, minlength=len(self.given))
        return nth


def tokenize(docs: DataFrame, tokenizer_file: str, length: int = LENGTH, known_words: int = KNOWN_WORDS) -> DataFrame:
    """One row per piece: ``doc_id, start, length, doc_tokens, ids, task, nth``
    (the task that writes it, and its number among that task's pieces of the
    length).  The last two hold once the rows are written."""
    with open(tokenizer_file, encoding="utf-8") as f:
        source = docs.sparkSession.sparkContext.broadcast(f.read())
    end = np.array([END_ID], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, numbers, task = _word_ids(source.value, known_words), _Numbers(length), TaskContext.get().partitionId()
        for batch in batches:
            texts = to_bytes(batch.column(1))
            for lo, hi in chunks(texts):
                owner, rows, pieces = [], [], []
                for i, ids in enumerate(known.ids(texts[lo:hi]), start=lo):
                    n = len(ids) // 4 + 1
                    ids += end
                    for a in range(0, n, length):
                        owner.append(i)
                        rows.append((a, min(length, n - a), n))
                        pieces.append(ids[4 * a : 4 * (a + length)])
                start, size, total = np.array(rows, dtype=np.int64).reshape(-1, 3).T
                columns = [start, size, total, pieces, np.full(len(size), task, dtype=np.int32), numbers.next(size)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(owner, pa.int64())), *[pa.array(c) for c in columns]],
                    names=["doc_id", "start", "length", "doc_tokens", "ids", "task", "nth"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, start long, length long, doc_tokens long, ids binary, task int, nth long"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def patterns(histogram: dict[int, int], length: int = LENGTH) -> list[tuple[int, list[tuple[int, int]]]]:
    """Packing patterns for the pieces counted in ``histogram``: (how often,
    [(piece length, how many in the pack)]).  Longest pieces first, each into
    the open packs with the most room."""
    open_packs: dict[int, list[list]] = defaultdict(list)  # room -> [[count, pack]]
    rooms: list[int] = []  # heap of rooms, largest first
    closed = []

    def put(room: int, count: int, pack: list) -> None:
        if room == 0:
            closed.append((count, pack))
            return
        if not open_packs[room]:
            heapq.heappush(rooms, -room)
        open_packs[room].append([count, pack])

    for size in sorted(histogram, reverse=True):
        left = histogram[size]
        while left:
            while rooms and not open_packs[-rooms[0]]:
                heapq.heappop(rooms)
            room = -rooms[0] if rooms else 0
            if room < size:
                # a new pack takes as many of this length as fit
                each = length // size
                full, rest = divmod(left, each)
                for count, n in ((full, each), (1 if rest else 0, rest)):
                    if count:
                        put(length - n * size, count, [(size, n)])
                break
            entry = open_packs[room].pop()
            # the emptiest packs take one each, several if there are plenty
            each = max(1, min(room // size, left // entry[0]))
            used = min(entry[0], left // each)
            if used < entry[0]:
                open_packs[room].append([entry[0] - used, entry[1]])
                if len(open_packs[room]) == 1:
                    heapq.heappush(rooms, -room)
            put(room - each * size, used, [*entry[1], (size, each)])
            left -= used * each
    for packs in open_packs.values():
        closed += [(count, pack) for count, pack in packs]
    return closed


class Plan:
    """Turns (length, rank) into (sequence, offset)."""

    SHIFT = 1 << 48

    def __init__(self, packs: list[tuple[int, list[tuple[int, int]]]]):
        used: dict[int, int] = defaultdict(int)
        rows, first = [], 0
        for count, pack in packs:
            at = 0
            for size, each in pack:
                rows.append((size * self.SHIFT + used[size], each, first, at))
                used[size] += count * each
                at += size * each
            first += count
        self.sequences = first
        self.rows = np.array(sorted(rows), dtype=np.int64).reshape(-1, 4)

    def place(self, size: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = size * self.SHIFT + rank
        low, each, first, at = self.rows[np.searchsorted(self.rows[:, 0], key, side="right") - 1].T
        nth = key - low
        return first + nth // each, at + nth % each * size


def pack(
    docs: DataFrame, tokenizer_file: str, length: int = LENGTH, with_ids: bool = True, known_words: int = KNOWN_WORDS
) -> DataFrame:
    """The pieces of ``tokenize`` with ``sequence_id`` and ``offset``;
    ``ids_crc32`` is taken of the ids as placed.  Without ``with_ids`` the ids
    are left out of the result, not out of the work.  ``known_words`` bounds a
    worker's memory and changes no result."""
    with arrow_rows(docs.sparkSession, BATCH_ROWS):
        pieces = stage(tokenize(docs, tokenizer_file, length, known_words), "pieces")
    counts = stage(pieces.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n")), "piece_counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = docs.sparkSession.sparkContext.broadcast(Plan(patterns(histogram, length)))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    ahead = counts.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_ahead"))
    ranked = pieces.join(F.broadcast(ahead) if counts.count() <= BROADCAST_COUNTS else ahead, ["task", "length"])

    # only numbers go to Python here, the ids stay where they are
    @F.arrow_udf("sequence_id long, `offset` long")
    def place(size: pa.Array, rank: pa.Array) -> pa.Array:
        found = plan.value.place(size.to_numpy(zero_copy_only=False), rank.to_numpy(zero_copy_only=False))
        return pa.StructArray.from_arrays([pa.array(x) for x in found], names=["sequence_id", "offset"])

    at = place.asNondeterministic()(F.col("length"), F.col("_ahead") + F.col("nth")).alias("_at")  # once a row
    placed = ranked.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "ids", at)
    kept = ["ids"] if with_ids else []
    return placed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", *kept, "_at.sequence_id", "_at.offset")


def sequences(pieces: DataFrame) -> DataFrame:
    """One row per sequence of ``pack``'s pieces: ``sequence_id, ids`` (binary,
    at most the sequence length) and ``pieces``, the bounds of each document in it
    (``offset, length, doc_id, start``), by offset."""
    # a sequence has at most ``length`` pieces, however large the table
    part = F.struct("offset", "length", "doc_id", "start", "ids")
    whole = pieces.groupBy("sequence_id").agg(F.array_sort(F.collect_list(part)).alias("_parts"))
    return whole.select(
        "sequence_id",
        F.expr("aggregate(_parts, X'', (a, p) -> concat(a, p.ids))").alias("ids"),
        F.expr(
            "transform(_parts, p -> named_struct('offset', p.`offset`, 'length', p.length, 'doc_id', p.doc_id, "
            "'start', p.start))"
        ).alias("pieces"),
    )
