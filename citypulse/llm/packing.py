"""Packing token sequences into fixed windows by the sum-of-squares rule.

Each partition keeps an array N of levels: N[h] is the number of open
windows that hold h tokens. A document goes to the level h for which the sum
of N[h]^2 after placing it is least (h = 0 opens a window); ties go to the
fullest level. Documents longer than a window first fill whole windows; only
the rest is placed. When the ids held in open windows pass a byte bound, and
when the input of a partition ends, the open windows are emptied from the
emptiest into the fullest, cutting documents: all become full but one, which
stays open or, at the end, is the partition's only partly filled window.
Nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citypulse.llm import common
from citypulse.llm.tokens import default_vocabulary, encoder

PIECES = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64()),
    ("sequence_id", pa.int64()), ("offset", pa.int64()), ("sequence_length", pa.int64()),
    ("padded_length", pa.int64()), ("token_ids", pa.binary())])
PIECES_DDL = ("doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, "
              "sequence_length long, padded_length long, token_ids binary")


class Packer:
    """The level array and open windows of one partition.

    A piece is (doc_id, start, ids as bytes, tokens of the document); a
    finished window is a list of pieces."""

    def __init__(self, size: int, most_open: int = 32 << 20):
        self.size, self.most_open = size, most_open
        self.held = 0  # bytes of ids in open windows
        self.count = np.zeros(size + 1, np.int64)  # N[h]; index 0 and size stay 0
        self.open: list[list[list[tuple]]] = [[] for _ in range(size + 1)]

    def level_for(self, length: int) -> int:
        """The level h <= size - length whose choice gives the least sum of
        squared counts after moving a window from h to h + length."""
        top = self.size - length
        change = 2 * self.count[length:self.size + 1] + 1  # a window more at h + length
        change[top] = 0  # a full window is closed and no longer counts
        here = self.count[:top + 1]
        change[1:] -= 2 * here[1:] - 1  # a window less at h
        change[1:][here[1:] == 0] = np.iinfo(np.int64).max
        return top - int(np.argmin(change[::-1]))

    def add(self, doc_id, ids: bytes) -> Iterator[list[tuple]]:
        total = len(ids) // 4
        whole = total // self.size
        for k in range(whole):
            yield [(doc_id, k * self.size, ids[4 * k * self.size:4 * (k + 1) * self.size], total)]
        start = whole * self.size
        rest = total - start
        if rest:
            level = self.level_for(rest)
            window = []
            if level:
                window = self.open[level].pop()
                self.count[level] -= 1
            window.append((doc_id, start, ids[4 * start:], total))
            if level + rest == self.size:
                self.held -= 4 * level
                yield window
            else:
                self.put(level + rest, window)
                self.held += 4 * rest
                if self.held > self.most_open:
                    yield from self.close(last=False)

    def put(self, level: int, window: list[tuple]) -> None:
        self.open[level].append(window)
        self.count[level] += 1

    def close(self, last: bool = True) -> Iterator[list[tuple]]:
        """Fill the fullest windows from the emptiest; at most one is left
        partly filled, which stays open unless this is the ``last`` call."""
        left = [(h, w) for h in range(self.size, 0, -1) for w in self.open[h]]
        self.open, self.held = [[] for _ in range(self.size + 1)], 0
        self.count[:] = 0
        i, j = 0, len(left) - 1
        while i <= j:
            level, window = left[i]
            while level < self.size and j > i:
                need = self.size - level
                donor_level, donor = left[j]
                doc_id, start, ids, total = donor.pop()
                have = len(ids) // 4
                if have > need:
                    donor.append((doc_id, start, ids[:4 * (have - need)], total))
                    start, ids, have = start + have - need, ids[4 * (have - need):], need
                window.append((doc_id, start, ids, total))
                level += have
                left[j] = (donor_level - have, donor)
                if donor_level == have:
                    j -= 1
            if level < self.size and not last:
                self.put(level, window)
                self.held = 4 * level
            else:
                yield window
            i += 1


def _rows(windows: Iterator[list[tuple]], size: int, base: int) -> Iterator[tuple]:
    for n, window in enumerate(windows):
        filled = sum(len(p[2]) for p in window) // 4
        padded = 1 << (filled - 1).bit_length()  # a power of two is not padded further
        at = 0
        for doc_id, start, ids, total in window:
            length = len(ids) // 4
            yield (doc_id, start, length, total, base + n, at, filled, min(size, padded), ids)
            at += length


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 2048,
         end_id: int = 1, vocabulary: str | None = None, remembered: int = 900_000,
         added: bool = False, most_open: int = 32 << 20) -> DataFrame:
    """Pieces of all documents, packed into windows of ``size`` tokens.

    Columns: doc_id, start (the document's ids before the piece), length,
    doc_tokens (with the end id), sequence_id, offset (in the window, gapless
    from 0), sequence_length (filled), padded_length (``size``, or for the
    partition's last window the next power of two if smaller), token_ids
    (unsigned 32-bit little-endian).

    A null or empty text is its end id alone. A null id stays null and
    repeated rows are packed each for itself. An empty table gives no rows.
    Further columns are not read. ``remembered``: pieces whose ids a worker
    keeps (about 250 bytes each, also between tasks). ``added``: strings of the
    vocabulary's added tokens in a text are those tokens (see ``Encoder``). Window ids are unique, not consecutive
    (partition number times 2^33, plus a count). Memory per task: the open
    windows, held to ``most_open`` bytes of ids (with what Python keeps around them
    about twice that for documents of a few hundred tokens).
    """
    path = vocabulary or default_vocabulary()
    end = np.array([end_id], "<u4").tobytes()

    def run(batches_in):
        packer, enc = Packer(size, most_open), encoder(path, remembered, added)

        def windows():
            for batch in batches_in:
                for part in common.by_bytes(batch, "text", 10 << 20):
                    each = enc.encode_each(part.column("text"))
                    for doc_id, ids in zip(part.column("doc_id").to_pylist(), each):
                        yield from packer.add(doc_id, ids.tobytes() + end)
            yield from packer.close()

        rows = []
        for row in _rows(windows(), size, TaskContext.get().partitionId() << 33):
            rows.append(row)
            if len(rows) == 2000:
                yield common.batches(rows, PIECES)
                rows = []
        if rows:
            yield common.batches(rows, PIECES)

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), common.text_of(text_col).alias("text"))
    return common.map_arrow(source, run, PIECES_DDL)
