"""Packing documents into token windows by the sum-of-squares rule, online.

A document's ids, ended by a stop id, first fill whole windows of their own.
Its remainder goes to the fill level (0: a new window) that leaves the smallest
sum of squares of the counts of partly filled windows per level. The counts
stand in a level array, so a choice costs one pass over the levels. A window is
given out when it is full. At the end of a partition the windows still open are
refilled from one another by cutting, which leaves at most one short run of
ids; that run is cut into windows whose lengths are powers of two, which need
no padding.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from storeloom.llm import pieces
from storeloom.llm.common import groups, text_of

#: Sequence numbers of a partition start at its number times this.
PER_PARTITION = 1 << 36

Piece = tuple[object, int, int, np.ndarray]  # document, start, document's ids, ids of the piece


class Packer:
    """Windows of one partition. ``add`` and ``close`` give ``(sequence, offset, piece)``."""

    def __init__(self, window: int, first: int = 0):
        self.window, self.next = window, first
        self.counts = np.zeros(window + 1, dtype=np.int64)  # partly filled windows per level
        self.open: list[list[list[Piece]]] = [[] for _ in range(window + 1)]

    def level_for(self, size: int) -> int:
        """The level whose choice leaves the least sum of squares; of equals the fullest.

        Moving a window from level h to h + size changes the sum by
        1 - 2 n(h) + 1 + 2 n(h + size); levels 0 and ``window`` do not count.
        """
        last = self.window - size
        change = 1 + 2 * self.counts[size:].copy()
        change[last] = 0
        change[1:] += 1 - 2 * self.counts[1:last + 1]
        usable = self.counts[:last + 1] > 0
        usable[0] = True
        change[~usable] = np.iinfo(np.int64).max
        return last - int(np.argmin(change[::-1]))

    def add(self, doc, ids: np.ndarray) -> Iterator[tuple[int, int, Piece]]:
        whole = len(ids) // self.window * self.window
        for start in range(0, whole, self.window):
            yield self._number(), 0, (doc, start, len(ids), ids[start:start + self.window])
        if whole < len(ids):
            yield from self._place((doc, whole, len(ids), ids[whole:]))

    def _number(self) -> int:
        self.next += 1
        return self.next - 1

    def _place(self, piece: Piece) -> Iterator[tuple[int, int, Piece]]:
        size = len(piece[3])
        level = self.level_for(size)
        held = self.open[level].pop() if level else []
        self.counts[level] -= bool(level)
        held.append(piece)
        if level + size == self.window:
            yield from self._give_out(held)
        else:
            self.open[level + size].append(held)
            self.counts[level + size] += 1

    def _give_out(self, held: list[Piece]) -> Iterator[tuple[int, int, Piece]]:
        number, offset = self._number(), 0
        for piece in held:
            yield number, offset, piece
            offset += len(piece[3])

    def close(self) -> Iterator[tuple[int, int, Piece]]:
        """Refill the open windows, the fullest first; the last ids go to powers of two."""
        rest = [p for level in reversed(self.open) for held in level for p in held]
        left = sum(len(p[3]) for p in rest)
        rest.reverse()
        while left:
            space = self.window if left >= self.window else 1 << (left.bit_length() - 1)
            left -= space
            held: list[Piece] = []
            while space:
                doc, start, total, ids = rest.pop()
                if len(ids) > space:
                    rest.append((doc, start + space, total, ids[space:]))
                    ids = ids[:space]
                held.append((doc, start, total, ids))
                space -= len(ids)
            yield from self._give_out(held)
        self.counts[:] = 0
        self.open = [[] for _ in range(self.window + 1)]


def pack(docs: DataFrame, tokenizer: str, window: int = 1024, stop_id: int = 0,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: ``doc_id``, ``start``, ``ids``, ``doc_tokens``, ``sequence_id``, ``offset``.

    ``ids`` are little-endian unsigned 32-bit ids; ``start`` counts the
    document's ids before the piece. Every id lies in one piece, and the pieces
    of a sequence follow one another from offset 0. Sequences are full or a
    power of two long, so nothing is padded. Null and empty texts are the stop
    id alone. Null and repeated ids stay, row by row; an empty table gives an
    empty result; other columns are ignored.

    Every task packs the documents of its partition: no shuffle, and a task
    that runs again on the same input gives the same windows.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    ddl = f"doc_id {kind}, start long, ids binary, doc_tokens long, sequence_id long, offset long"
    schema = to_arrow_schema(StructType.fromDDL(ddl))

    def rows(found) -> list:
        doc, start, tokens, ids, sequence, offset = [], [], [], [], [], []
        for number, at, (d, s, n, some) in found:
            doc.append(d)
            start.append(s)
            tokens.append(n)
            ids.append(some.astype("<u4").tobytes())
            sequence.append(number)
            offset.append(at)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip((doc, start, ids, tokens, sequence, offset), schema)],
            schema=schema)

    def run(batches):
        packer = Packer(window, TaskContext.get().partitionId() * PER_PARTITION)
        encoder = pieces.encoder(tokenizer)
        stop = np.array([stop_id], dtype=np.uint32)

        def added(docs_, texts):
            for doc, ids in zip(docs_, encoder.encode(texts)):
                yield from packer.add(doc, np.concatenate([ids, stop]))

        for batch in batches:
            names, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for some in groups(map(len, texts)):
                yield rows(added(names[some], texts[some]))
        yield rows(packer.close())

    return docs.select(F.col(id_col), text_of(text_col)).mapInArrow(run, ddl)
