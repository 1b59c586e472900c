"""Token windows of a fixed capacity with little padding.

A document's ids are cut into whole windows; what is left over, less than one
window, is cut into pieces of at most `piece` ids. Pieces are gathered in
groups as a task streams its documents, and each group is divided into windows
of near-equal sums by Karmarkar-Karp differencing, the number of windows rising
whenever one would be over capacity. A group has a bounded number of pieces, so
a task holds little whatever its documents are; nothing is shuffled, and at
most one group of each task is smaller than the rest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakebars.llm.common import slices
from lakebars.llm.differencing import near_equal_windows
from lakebars.llm.tokens import END_ID, byte_level_encoder

CAPACITY = 2048
PIECE = 512
GROUP = 1024  # pieces divided together
BATCH_DOCS = 512
BATCH_IDS = 1 << 20

_FIELDS = {
    "doc_tokens": T.LongType(),
    "start": T.LongType(),
    "length": T.LongType(),
    "sequence_id": T.LongType(),
    "offset": T.LongType(),
    "ids": T.BinaryType(),
}


class _Windows:
    """The windows of one task, and the rows that wait to be sent on."""

    def __init__(self, capacity: int, piece: int, group: int) -> None:
        self.capacity, self.piece, self.group = capacity, piece, group
        self.sequence = TaskContext.get().partitionId() << 32
        self.pending: list[tuple] = []
        self.rows: list[tuple] = []
        self.waiting = 0

    def add(self, doc_id: object, ids: np.ndarray) -> None:
        total, cut = len(ids), len(ids) - len(ids) % self.capacity
        for start in range(0, cut, self.capacity):
            self._emit(doc_id, total, start, ids[start : start + self.capacity], self.sequence, 0)
            self.sequence += 1
        for start in range(cut, total, self.piece):
            self.pending.append((doc_id, total, start, ids[start : min(start + self.piece, total)]))
        while len(self.pending) >= self.group:
            self._divide(self.pending[: self.group])
            self.pending = self.pending[self.group :]

    def close(self) -> None:
        if self.pending:
            self._divide(self.pending)
            self.pending = []

    def _divide(self, pieces: list[tuple]) -> None:
        place = near_equal_windows(np.array([len(piece[-1]) for piece in pieces], np.int64), self.capacity)
        filled: dict[int, int] = {}
        for window, (doc_id, total, start, ids) in zip(place.tolist(), pieces, strict=True):
            offset = filled.get(window, 0)
            self._emit(doc_id, total, start, ids, self.sequence + window, offset)
            filled[window] = offset + len(ids)
        self.sequence += int(place.max()) + 1

    def _emit(self, doc_id: object, total: int, start: int, ids: np.ndarray, sequence: int, offset: int) -> None:
        self.rows.append((doc_id, total, start, len(ids), sequence, offset, ids.astype("<u4").tobytes()))
        self.waiting += len(ids)

    def sent(self, schema: pa.Schema) -> pa.RecordBatch:
        columns = list(zip(*self.rows, strict=True)) or [[] for _ in schema]
        self.rows, self.waiting = [], 0
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def pack(
    docs: DataFrame,
    tokenizer: str,
    doc_id: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    piece: int = PIECE,
    group: int = GROUP,
    end_id: int = END_ID,
) -> DataFrame:
    """One row per piece: `doc_id, doc_tokens, start, length, sequence_id, offset, ids`.

    `ids` are little-endian unsigned 32-bit ids; each document ends with
    `end_id`, so a null or empty text is that one id. The pieces of a sequence
    lie one after another from offset 0 and never pass `capacity`. Rows are
    packed one by one, also where they repeat an id or have none; other columns
    take no part. No rows in, no rows out.
    """
    id_type = docs.schema[doc_id].dataType
    schema = T.StructType([T.StructField("doc_id", id_type), *(T.StructField(n, t) for n, t in _FIELDS.items())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, windows, out = byte_level_encoder(tokenizer), _Windows(capacity, piece, group), None
        for batch in slices(batches, BATCH_DOCS):
            out = out or pa.schema([("doc_id", batch.schema.field(0).type), *_ARROW])
            for key, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                windows.add(key, np.append(encode(content.as_py() or ""), np.uint32(end_id)))
                if windows.waiting >= BATCH_IDS:
                    yield windows.sent(out)
        windows.close()
        if out is not None:
            yield windows.sent(out)

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, schema)


_ARROW = [(n, pa.binary() if isinstance(t, T.BinaryType) else pa.int64()) for n, t in _FIELDS.items()]
