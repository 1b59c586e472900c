"""Byte-level BPE by corpus-level merge replay.

All distinct pieces of a stretch of corpus lie side by side as one sequence of
bytes. An inverted index holds, for each merge, the positions where its pair
stands; merges are applied in rank order, each to all its positions at once,
and only the pairs next to a merged one are looked up again and posted anew. A
piece met before is not replayed, so common pieces cost one look-up.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from lakebars.llm.common import slices
from lakebars.llm.tokens import pattern, ranks_of

BATCH_DOCS = 256
STRETCH_CHARS = 8 << 20  # corpus replayed together, unless one text is longer
KNOWN_PIECES = 1 << 20  # pieces a worker remembers; beyond that it starts again

_NONE = np.int64(1 << 40)


class MergeTable:
    """Ranks of the merges of a vocabulary, by the ids of the two sides."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = [
            (ranks[token[:cut]] << 32 | ranks[token[cut:]], rank)
            for token, rank in ranks.items()
            for cut in range(1, len(token))
            if token[:cut] in ranks and token[cut:] in ranks
        ]
        pairs.sort()
        self._keys = np.array([key for key, _ in pairs] + [np.iinfo(np.int64).max], np.int64)
        self._ranks = np.array([rank for _, rank in pairs] + [_NONE], np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        at = np.searchsorted(self._keys, key)
        return np.where(self._keys[at] == key, self._ranks[at], _NONE)

    def replay(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces one after another, and the number of ids of each."""
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        ids = self.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
        size, ends = len(ids), np.cumsum(lengths)
        after, before = np.arange(1, size + 1), np.arange(-1, size - 1)
        after[ends - 1] = -1
        before[ends - lengths] = -1
        alive = np.ones(size, bool)
        rank = np.full(size, _NONE)  # of the pair that begins at a position
        postings: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def post(places: np.ndarray) -> None:
            following = after[places]
            found = np.where(following >= 0, self.rank(ids[places], ids[following]), _NONE)
            rank[places] = found
            hit = found < _NONE
            places, found = places[hit], found[hit]
            order = np.argsort(found, kind="stable")
            places, found = places[order], found[order]
            cuts = np.flatnonzero(np.diff(found)) + 1
            bounds = [0, *cuts.tolist(), len(found)]
            for low, high in zip(bounds, bounds[1:], strict=False):
                if low == high:
                    continue
                merge = int(found[low])
                if merge in postings:
                    postings[merge].append(places[low:high])
                else:
                    postings[merge] = [places[low:high]]
                    heapq.heappush(heap, merge)

        post(np.arange(size))
        while heap:
            merge = heapq.heappop(heap)
            places = np.unique(np.concatenate(postings.pop(merge)))
            places = places[alive[places]]
            places = places[rank[places] == merge]
            if not places.size:
                continue
            if places.size > 1:
                places = _leftmost(places, after)
            gone = after[places]
            ids[places] = merge
            alive[gone] = False
            beyond = after[gone]
            after[places] = beyond
            inside = beyond >= 0
            before[beyond[inside]] = places[inside]
            previous = before[places]
            post(np.concatenate([places, previous[previous >= 0]]))
        starts = ends - lengths
        counts = np.add.reduceat(alive.astype(np.int64), starts) if len(pieces) else lengths
        return ids[alive], counts


def _leftmost(places: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Of pairs that overlap, as in a run of one letter, every second one from the left."""
    chained = np.concatenate([[False], after[places[:-1]] == places[1:]])
    if not chained.any():
        return places
    index = np.arange(len(places))
    begin = np.maximum.accumulate(np.where(chained, 0, index))
    return places[(index - begin) % 2 == 0]


class _Numbers(dict):
    """Numbers pieces as they are first met."""

    def __missing__(self, piece: str) -> int:
        self[piece] = number = len(self)
        return number


class CorpusEncoder:
    """Ids of texts, a stretch of corpus at a time."""

    def __init__(self, path: str) -> None:
        self.merges = MergeTable(ranks_of(path))
        self._pieces = regex.compile(pattern())
        self._forget()

    def _forget(self) -> None:
        self._numbers = _Numbers()
        self._ids = np.zeros(0, np.int32)
        self._starts = np.zeros(0, np.int64)
        self._counts = np.zeros(0, np.int64)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, and the number of ids of each."""
        if len(self._numbers) > KNOWN_PIECES:
            self._forget()
        known = len(self._numbers)
        find, number = self._pieces.findall, self._numbers.__getitem__
        used = [np.array(list(map(number, find(text))), np.int32) for text in texts]
        fresh = list(self._numbers)[known:] if len(self._numbers) > known else []
        if fresh:
            ids, counts = self.merges.replay([piece.encode() for piece in fresh])
            self._starts = np.concatenate([self._starts, len(self._ids) + np.cumsum(counts) - counts])
            self._ids = np.concatenate([self._ids, ids.astype(np.int32)])
            self._counts = np.concatenate([self._counts, counts])
        sizes = np.fromiter((self._counts[of].sum() for of in used), np.int64, len(used))
        return np.concatenate([self._spread(of) for of in used] or [self._ids[:0]]), sizes

    def _spread(self, used: np.ndarray) -> np.ndarray:
        counts = self._counts[used]
        first = np.cumsum(counts) - counts
        return self._ids[np.repeat(self._starts[used] - first, counts) + np.arange(counts.sum())]


@lru_cache
def corpus_encoder(path: str) -> CorpusEncoder:
    return CorpusEncoder(path)


@lru_cache
def token_bytes(path: str) -> dict[int, bytes]:
    return {rank: token for token, rank in ranks_of(path).items()}


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
    keys: list = []
    texts: list[str] = []
    chars = 0
    for batch in slices(batches, BATCH_DOCS):
        keys += batch.column(0).to_pylist()
        new = [text or "" for text in batch.column(1).to_pylist()]
        texts += new
        chars += sum(map(len, new))
        if chars >= STRETCH_CHARS:
            yield keys, texts
            keys, texts, chars = [], [], 0
    if keys:
        yield keys, texts


def encode(docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`doc_id, ids`: the ids of each whole text, as the tiktoken library gives them without special tokens.

    A null or empty text has no ids. Each row is encoded by itself, also where
    ids repeat or are null; other columns take no part. No rows in, no rows out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = corpus_encoder(vocabulary)
        for keys, texts in _stretches(batches):
            ids, sizes = encoder.encode(texts)
            offsets = np.concatenate([[0], np.cumsum(sizes)])
            for low in range(0, len(texts), BATCH_DOCS):
                high = min(low + BATCH_DOCS, len(texts))
                values = pa.array(ids[offsets[low] : offsets[high]])
                lists = pa.ListArray.from_arrays(pa.array((offsets[low : high + 1] - offsets[low]).astype(np.int32)), values)
                yield pa.RecordBatch.from_arrays([pa.array(keys[low:high], key_type), lists], ["doc_id", "ids"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    key = rows.schema["doc_id"].dataType
    key_type = to_arrow_type(key)
    return rows.mapInArrow(run, f"doc_id {key.simpleString()}, ids array<int>")


def decode(rows: DataFrame, vocabulary: str, ids: str = "ids") -> DataFrame:
    """`rows` with `decoded`: the bytes of the ids. Null ids give null, no ids give no bytes; an unknown id is an error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = token_bytes(vocabulary).__getitem__
        for batch in slices(batches, BATCH_DOCS):
            lists = batch.column(batch.schema.get_field_index(ids)).to_pylist()
            data = [None if x is None else b"".join(map(token, x)) for x in lists]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(data, pa.binary())], [*batch.schema.names, "decoded"])

    return rows.mapInArrow(run, rows.withColumn("decoded", F.lit(None).cast("binary")).schema)
