"""How two tokenizers cut the same texts: groups of tokens that end together, and links of tokens that overlap.

Each distinct text is tokenised and aligned once. Texts are gathered by their
full content, with a count of their copies before the shuffle, and aligned in
chunks of a bounded size. A chunk keeps its links as numbers into a dictionary
of its distinct id pairs, so what is counted over the corpus, and what the
counts are joined back to, is one row for each pair of a chunk and not one for
each link. A pair is at most one row a chunk, however frequent it is; a text's
copies count as the weight of its links.

Both tokenizers are read from public vocabulary files: a byte-level BPE (A) that
gets the text behind one space, and a sentencepiece BPE (B) that adds that space
itself.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakebars.llm.common import looked_up, slices, written
from lakebars.llm.tokens import byte_alphabet, pattern

CHUNK_BYTES = 8 << 20
SLICE_TEXTS = 64
SLICE_CHARS = 1 << 19  # tokenised together: a few dozen bytes a character at most are held for these

MEASURES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")

_CHUNKED = (
    "chunk long, text_key string, copies long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "groups string, places binary, pairs array<long>, weights array<long>"
)
_CHUNKED_ARROW = pa.schema(
    [
        *(("chunk", pa.int64()), ("text_key", pa.string()), ("copies", pa.int64())),
        *((name, pa.int64()) for name in MEASURES[:4]),
        *((name, pa.string()) for name in ("groups_sha256", "groups")),
        *(("places", pa.binary()), ("pairs", pa.list_(pa.int64())), ("weights", pa.list_(pa.int64()))),
    ]
)
_SUMS = "text_key string, copies long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string, groups string"


class Alignment(NamedTuple):
    documents: DataFrame  # one row per document, see `align`
    pairs: DataFrame  # a_id, b_id, count, best: every linked pair of ids of the corpus


class _Tokens(NamedTuple):
    """The two tokenizers, and the bytes of their tokens."""

    encode_a: object
    encode_b: object
    bytes_a: list[bytes]
    bytes_b: list[bytes]
    length_a: np.ndarray
    length_b: np.ndarray
    # The decimal id and what follows it: a comma within a group, then "|" after A and ";" after B.
    shown_a: np.ndarray
    shown_b: np.ndarray


def _shown(ids: int, last: str) -> np.ndarray:
    table = np.empty(2 * ids, object)
    table[:] = [f"{i},".encode() for i in range(ids)] + [f"{i}{last}".encode() for i in range(ids)]
    return table


def byte_level_bytes(path: str) -> list[bytes]:
    """The bytes of each id of a byte-level BPE but its special tokens; an error if ids are not the ranks of its merges."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    alphabet = byte_alphabet()
    special = {token["content"] for token in spec["added_tokens"]}
    ids = {token: i for token, i in spec["model"]["vocab"].items() if token not in special}
    pairs = [merge.split(" ") if isinstance(merge, str) else merge for merge in spec["model"]["merges"]]
    if sorted(ids.values()) != list(range(len(ids))) or any(
        ids["".join(pair)] != len(alphabet) + rank for rank, pair in enumerate(pairs)
    ):
        raise ValueError(f"the ids of {path} are not the ranks of its merges")
    found = [b""] * len(ids)
    for token, i in ids.items():
        found[i] = bytes(alphabet[c] for c in token)
    return found


@lru_cache
def _tokens(a_path: str, b_path: str) -> _Tokens:
    import sentencepiece
    import tiktoken

    bytes_a = byte_level_bytes(a_path)
    ranks = {token: i for i, token in enumerate(bytes_a)}
    # Without special tokens their strings in a text are plain text.
    a = tiktoken.Encoding("a", pat_str=pattern(), mergeable_ranks=ranks, special_tokens={})
    b = sentencepiece.SentencePieceProcessor(model_file=b_path)
    bytes_b = [
        bytes([int(b.id_to_piece(i)[1:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
        for i in range(b.get_piece_size())
    ]
    lengths = [np.array([len(token) for token in table], np.int64) for table in (bytes_a, bytes_b)]
    return _Tokens(
        lambda text: a.encode_to_numpy(" " + text, disallowed_special=()).astype(np.int64),
        lambda texts: b.encode(texts, num_threads=1),
        *(bytes_a, bytes_b, *lengths, _shown(len(bytes_a), "|"), _shown(len(bytes_b), ";")),
    )


class _Aligned(NamedTuple):
    """Some texts aligned: counts by text, the groups as text, and the id pair of each link in order."""

    counts: np.ndarray  # n_a, n_b, n_groups, n_links
    groups: list[bytes]
    pairs: np.ndarray


def _aligned(tokens: _Tokens, texts: list[str]) -> _Aligned:
    """All texts at once, their token ids one after another."""
    a = [tokens.encode_a(text) for text in texts]
    b = tokens.encode_b(texts)
    whole = [b" " + text.encode() for text in texts]
    # Texts that A or B does not give back byte by byte have no tokens.
    kept = [
        b"".join(map(tokens.bytes_b.__getitem__, ids_b)) == content
        and b"".join(map(tokens.bytes_a.__getitem__, ids_a.tolist())) == content
        for ids_a, ids_b, content in zip(a, b, whole, strict=True)
    ]
    n_a = np.array([len(ids) if keep else 0 for ids, keep in zip(a, kept, strict=True)], np.int64)
    n_b = np.array([len(ids) if keep else 0 for ids, keep in zip(b, kept, strict=True)], np.int64)
    ids_a = np.concatenate([np.empty(0, np.int64), *(ids for ids, keep in zip(a, kept, strict=True) if keep)])
    ids_b = np.fromiter(chain.from_iterable(ids for ids, keep in zip(b, kept, strict=True) if keep), np.int64, n_b.sum())
    ends_a, ends_b = np.cumsum(tokens.length_a[ids_a]), np.cumsum(tokens.length_b[ids_b])

    # Every place where a token ends; between two of them lies one link.
    marks = np.zeros(int(ends_a[-1]) + 1 if len(ends_a) else 1, np.uint8)
    marks[ends_a] |= 1
    marks[ends_b] |= 2
    at = np.flatnonzero(marks)
    is_a, is_b = (marks[at] & 1).astype(np.int64), (marks[at] >> 1).astype(np.int64)
    linked_a, linked_b = ids_a[np.cumsum(is_a) - is_a], ids_b[np.cumsum(is_b) - is_b]

    sizes = np.array([len(content) if keep else 0 for content, keep in zip(whole, kept, strict=True)], np.int64)
    ends = np.searchsorted(at, np.cumsum(sizes), "right")  # links up to each text's end
    n_groups = np.diff(np.concatenate([[0], np.cumsum(is_a & is_b)])[ends], prepend=0)
    groups = _groups(tokens, ids_a, ids_b, marks[ends_a] == 3, marks[ends_b] == 3, np.cumsum(n_a + n_b))
    return _Aligned(np.stack([n_a, n_b, n_groups, np.diff(ends, prepend=0)]), groups, (linked_a << 32) | linked_b)


def _groups(
    tokens: _Tokens, ids_a: np.ndarray, ids_b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray, ends: np.ndarray
) -> list[bytes]:
    """Each text's groups as `a1,a2|b1;a3|b2,b3`: every token as text, put where it is written, a group's A ids before its B ids."""
    group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
    b_before = np.concatenate([[0], np.flatnonzero(last_b) + 1])
    a_until = np.flatnonzero(last_a) + 1
    out = np.empty(len(ids_a) + len(ids_b), object)
    out[np.arange(len(ids_a)) + b_before[group_a]] = tokens.shown_a[ids_a + last_a * len(tokens.bytes_a)]
    out[np.arange(len(ids_b)) + a_until[group_b]] = tokens.shown_b[ids_b + last_b * len(tokens.bytes_b)]
    shown, starts = out.tolist(), [0, *ends[:-1].tolist()]
    return [b"".join(shown[start:end])[:-1] for start, end in zip(starts, ends.tolist(), strict=True)]


class _Chunk:
    """The texts of one chunk as they are aligned, some at a time; of them only numbers are kept."""

    def __init__(self, tokens: _Tokens, number: int, keep_groups: bool) -> None:
        self.tokens, self.number, self.keep_groups = tokens, number, keep_groups
        self.keys: list[str] = []
        self.copies: list[int] = []
        self.shas: list[str] = []
        self.groups: list[str | None] = []
        self.counts: list[np.ndarray] = []
        self.pairs: list[np.ndarray] = []

    def add(self, rows: list[tuple]) -> None:
        keys, texts, copies = zip(*rows, strict=True)
        found = _aligned(self.tokens, list(texts))
        self.keys += keys
        self.copies += copies
        self.shas += [hashlib.sha256(text).hexdigest() if text else "" for text in found.groups]
        self.groups += [text.decode() if self.keep_groups else None for text in found.groups]
        self.counts.append(found.counts)
        self.pairs.append(found.pairs)

    def batch(self) -> pa.RecordBatch:
        """A row per text, and one with the chunk's pairs."""
        counts, n = np.concatenate(self.counts, axis=1), len(self.keys)
        codes, pairs = pd.factorize(np.concatenate(self.pairs))
        # Whole numbers below 2^53, so the sums are exact.
        weights = np.bincount(codes, np.repeat(self.copies, counts[3]), len(pairs)).astype(np.int64)
        ends, codes = np.cumsum(counts[3]).tolist(), codes.astype("<i4")
        pack = zstandard.ZstdCompressor(level=1).compress
        places = [pack(codes[start:end].tobytes()) for start, end in zip([0, *ends[:-1]], ends, strict=True)]
        columns = [
            [self.number] * (n + 1),
            [*self.keys, None],
            [*self.copies, None],
            *([*of.tolist(), None] for of in counts),
            [*self.shas, None],
            [*self.groups, None],
            [*places, None],
            [*([None] * n), pairs],
            [*([None] * n), weights],
        ]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _CHUNKED_ARROW, strict=True)], schema=_CHUNKED_ARROW)


def _chunked(texts: DataFrame, a_path: str, b_path: str, chunk_bytes: int, keep_groups: bool) -> DataFrame:
    """`texts` (`text_key, text, copies`) aligned: a row per text and one per chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, number = _tokens(a_path, b_path), TaskContext.get().partitionId() << 32
        chunk, size = _Chunk(tokens, number, keep_groups), 0
        waiting: list[tuple] = []
        held = 0
        for batch in slices(batches, SLICE_TEXTS):
            for row in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                waiting.append(row)
                held += len(row[1])
                if held < min(SLICE_CHARS, chunk_bytes):
                    continue
                chunk.add(waiting)
                size += held
                waiting, held = [], 0
                if size >= chunk_bytes:
                    yield chunk.batch()
                    number += 1
                    chunk, size = _Chunk(tokens, number, keep_groups), 0
        if waiting:
            chunk.add(waiting)
        if chunk.keys:
            yield chunk.batch()

    return texts.select("text_key", "text", "copies").mapInArrow(run, _CHUNKED)


def _measured(texts: pa.Table, known: pa.Table) -> pa.Table:
    """The sums over each text's links; `known` holds the counts of the chunk's pairs."""
    place = known.column("place").to_numpy()
    counts, best = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
    counts[place] = known.column("count").to_numpy()
    best[place] = known.column("best").to_numpy(zero_copy_only=False)
    unpack = zstandard.ZstdDecompressor()
    n_best, count_sum = [], []
    for content in texts.column("places"):
        links = np.frombuffer(unpack.decompress(content.as_py()), "<i4")
        n_best.append(int(best[links].sum()))
        count_sum.append(int(counts[links].sum()))
    found = dict(zip(texts.column_names, texts.columns, strict=True)) | {"n_best": pa.array(n_best, pa.int64()), "count_sum": pa.array(count_sum, pa.int64())}
    return pa.table({name.split()[0]: found[name.split()[0]] for name in _SUMS.split(", ")})


def align(
    docs: DataFrame,
    a_path: str,
    b_path: str,
    doc_id: str = "doc_id",
    text: str = "text",
    chunk_bytes: int = CHUNK_BYTES,
    keep_groups: bool = False,
) -> Alignment:
    """The tokens of A and B over the same bytes, for each row of `docs`.

    `documents` has `doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256`, and with `keep_groups` also `groups`, the text whose hash
    that is. Places where tokens of both end cut the text into groups; an A and a
    B token are linked when they share a byte. `count_sum` adds, over a
    document's links, how many links of the corpus join the same two ids;
    `n_best` counts the links for which no other A id is joined more often to
    their B id.

    A text that is null or empty, or that A or B does not give back byte by byte,
    has no tokens: its numbers are zero, its hash and groups empty. Rows that
    repeat an id or a text, and rows without an id, each count and each get a
    row. Other columns take no part. No rows in, no rows out.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    there = F.col("text") != ""
    key = F.sha2(F.col("text").cast("binary"), 256)
    ids = written(rows.select("doc_id", F.when(there, key).alias("text_key")), "text-keys")
    texts = rows.filter(there).groupBy("text").agg(F.count("*").alias("copies")).select(key.alias("text_key"), "text", "copies")
    chunked = written(_chunked(texts, a_path, b_path, chunk_bytes, keep_groups), "aligned")

    both = F.arrays_zip("pairs", "weights")
    words = chunked.filter("pairs is not null").select("chunk", F.posexplode(both).alias("place", "of"))
    words = words.select("chunk", "place", F.col("of.pairs").alias("pair"), F.col("of.weights").alias("weight"))
    counts = words.groupBy("pair").agg(F.sum("weight").alias("count"))
    counts = written(counts.withColumn("b_id", F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))), "pair-counts")
    most = counts.groupBy("b_id").agg(F.max("count").alias("most"))
    # Bounded by the vocabulary of B.
    pairs = counts.join(F.broadcast(most), "b_id").withColumn("best", F.col("count") == F.col("most")).drop("most")
    pairs = written(pairs, "pairs")

    known = words.select(F.col("chunk").alias("of_chunk"), "place", "pair").join(pairs.select("pair", "count", "best"), "pair").drop("pair")
    of_texts = chunked.filter("text_key is not null").drop("pairs", "weights")
    sums = of_texts.groupBy("chunk").cogroup(known.groupBy("of_chunk")).applyInArrow(_measured, _SUMS)
    found = looked_up(ids, written(sums, "text-measures"), "text_key", "copies")
    names = ["groups_sha256", *(["groups"] if keep_groups else [])]
    return Alignment(
        found.select(
            "doc_id",
            *(F.coalesce(name, F.lit(0)).cast("long").alias(name) for name in MEASURES),
            *(F.coalesce(name, F.lit("")).alias(name) for name in names),
        ),
        pairs.select(F.shiftright("pair", 32).alias("a_id"), "b_id", "count", "best"),
    )
