"""Fill-in-the-middle texts, cut at token units through block trees.

A text is a row of units (white space and the word after it; white space at
the end is a unit of its own).  Two cuts, drawn from the SHA-256 of the
document's id, part it into prefix, middle and suffix, which are written with
markers in one of two orders (prefix-suffix-middle or suffix-prefix-middle) or
left plain.

*Cuts.*  A text is divided into blocks of ``BLOCK`` bytes.  A Fenwick tree over
its blocks holds how many units end in them and how many code points start in
them.  The block of the k-th unit is found by binary lifting down that tree,
which adds up the code points on its way; only the block found is then
searched for the unit's end.  The trees of all texts of a chunk lie in one array and
all cuts of the chunk descend together, one step of the lifting at a time.

Defined cases: null text is empty (plain, 0 units); a null id is hashed as no
digits; repeated rows give repeated results; texts that contain a marker stay
plain, so ``restore`` is exact; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.words import SPACE, chunks, to_bytes

BLOCK = 256
#: Cuts whose blocks are searched at once.
SLICE = 8192
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED, PERCENT, SUFFIX_FIRST_PERCENT = 42, 50, 80


class BlockTrees:
    """Fenwick trees of unit and code-point counts over the blocks of texts."""

    def __init__(self, texts: list[bytes], block: int = BLOCK):
        data = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
        size = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        self.block = block
        self.first_byte = np.cumsum(size + 1) - size - 1
        space = SPACE[data]
        ends = np.zeros(len(data), dtype=bool)
        ends[:-1] = ~space[:-1] & space[1:]
        last = (self.first_byte + size - 1)[size > 0]
        ends[last] = True  # a word's end already, or white space at the end
        starts = (data & 0xC0) != 0x80
        starts[self.first_byte + size] = False  # the line feeds between texts
        self.unit_ends, self.char_starts = ends, starts

        self.blocks = -(-size // block)
        self.first_block = np.cumsum(self.blocks) - self.blocks
        owner = np.repeat(np.arange(len(texts)), self.blocks)
        nth = np.arange(len(owner)) - self.first_block[owner]
        at = self.first_byte[owner] + nth * block
        # node j of a tree covers the (j & -j) blocks up to the j-th
        low = nth + 1 - ((nth + 1) & -(nth + 1))
        self.units, self.chars = (self._tree(flags, at, owner, low) for flags in (ends, starts))
        self.n_units = np.add.reduceat(np.append(ends, False), self.first_byte, dtype=np.int64)

    def _tree(self, flags: np.ndarray, at: np.ndarray, owner: np.ndarray, low: np.ndarray) -> np.ndarray:
        counts = np.add.reduceat(flags, at, dtype=np.int64) if len(at) else np.zeros(0, dtype=np.int64)
        before = np.concatenate(([0], np.cumsum(counts)))
        return before[1:] - before[self.first_block[owner] + low]

    def _descend(self, text: np.ndarray, k: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the k-th unit (k > 0): its block, its rank among the units that
        end there, and the code points before that block."""
        base, blocks = self.first_block[text], self.blocks[text]
        pos, rank, chars = np.zeros_like(k), k.copy(), np.zeros_like(k)
        step = 1 << int(blocks.max(initial=0)).bit_length()
        while step := step >> 1:
            node = base + np.minimum(pos + step, blocks) - 1
            down = (pos + step <= blocks) & (self.units[node] < rank)
            pos += step * down
            rank -= self.units[node] * down
            chars += self.chars[node] * down
        return pos, rank, chars

    def cut(self, text: np.ndarray, k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes, code points) of the first ``k`` units of each named text."""
        n_bytes, n_chars = np.zeros_like(k), np.zeros_like(k)
        some = np.flatnonzero(k)
        for lo in range(0, len(some), SLICE):
            mine = some[lo : lo + SLICE]
            block, rank, chars = self._descend(text[mine], k[mine])
            at = block[:, None] * self.block + np.arange(self.block)
            at = np.minimum(at + self.first_byte[text[mine], None], len(self.unit_ends) - 1)
            end = (np.cumsum(self.unit_ends[at], axis=1) >= rank[:, None]).argmax(axis=1)
            inside = np.arange(self.block) <= end[:, None]
            n_bytes[mine] = block * self.block + end + 1
            n_chars[mine] = chars + (self.char_starts[at] & inside).sum(axis=1)
        return n_bytes, n_chars


def draws(doc_id: str | Column, seed: int = SEED) -> list[Column]:
    """Four unsigned 32-bit numbers from the SHA-256 of ``seed:doc_id``."""
    digits = F.coalesce(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id, F.lit(""))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), digits), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]


def transform(
    docs: DataFrame, seed: int = SEED, percent: int = PERCENT, suffix_first_percent: int = SUFFIX_FIRST_PERCENT
) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output``: the unit count,
    ``plain``, ``psm`` or ``spm``, the code points of prefix and middle (null
    if plain) and the text written in that form.

    The cuts follow ``min`` and ``max`` of two draws modulo ``n + 1`` units;
    ``percent`` of the texts are cut, ``suffix_first_percent`` of these as spm.
    """
    markers = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]
    p, s, m = markers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = to_bytes(batch.column(1))
            h = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns[2:]])
            for lo, hi in chunks(texts):
                own, (h1, h2, h3, h4) = texts[lo:hi], h[:, lo:hi]
                trees = BlockTrees(own)
                n = trees.n_units
                every = np.arange(len(own))
                a, b = h1 % (n + 1), h2 % (n + 1)
                (b1, c1), (b2, c2) = trees.cut(every, np.minimum(a, b)), trees.cut(every, np.maximum(a, b))
                cut = (n > 0) & (h3 % 100 < percent)
                suffix_first = h4 % 100 < suffix_first_percent
                forms, outputs = [], []
                for i, t in enumerate(own):
                    if not cut[i] or any(x in t for x in markers):
                        cut[i] = False
                        forms.append("plain")
                        outputs.append(t)
                        continue
                    prefix, middle, suffix = t[: b1[i]], t[b1[i] : b2[i]], t[b2[i] :]
                    forms.append("spm" if suffix_first[i] else "psm")
                    head = (s, suffix, p, prefix) if suffix_first[i] else (p, prefix, s, suffix)
                    outputs.append(b"".join((*head, m, middle)))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, hi - lo),
                        pa.array(n),
                        pa.array(forms),
                        pa.array(c1, mask=~cut),
                        pa.array(c2 - c1, mask=~cut),
                        pa.array(outputs, pa.binary()).cast(pa.string(), safe=False),
                    ],
                    names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output string"
    return docs.select("doc_id", "text", *draws("doc_id", seed)).mapInArrow(run, schema)


def restore(output: str = "output", form: str = "form") -> Column:
    """The text that ``output`` was written from: parted at its markers (each
    occurs once) and put together in the order of the text."""
    part = lambda c, at, i: F.substring_index(c, at, i)
    whole = F.col(output)
    head, middle = part(whole, MIDDLE, 1), part(whole, MIDDLE, -1)
    psm = F.concat(part(part(head, SUFFIX, 1), PREFIX, -1), middle, part(head, SUFFIX, -1))
    spm = F.concat(part(head, PREFIX, -1), middle, part(part(head, PREFIX, 1), SUFFIX, -1))
    return F.when(F.col(form) == "psm", psm).when(F.col(form) == "spm", spm).otherwise(whole)
