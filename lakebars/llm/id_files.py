"""Files of token ids: documents in ascending order of their ids, coded in checksummed blocks.

A file holds whole documents: a header, the documents' ids and lengths, and
blocks of a fixed number of token ids, each with its distinct ids, coded by
itself (see `mixing_coder`), with a checksum of its token ids. Header numbers are big-endian,
so that Spark can read them without a decoder; everything else is little-endian.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from lakebars.llm.common import slices, written
from lakebars.llm.files import read_files, write_files
from lakebars.llm.mixing_coder import decode_blocks, digits_for, encode_blocks
from lakebars.llm.tokens import END_ID, word_encoder

BLOCK_IDS = 1024
FILE_IDS = 4 << 20  # token ids at which a file ends; a longer document has a file of its own
BATCH_DOCS = 256
MAGIC, ENDING = b"LBIDS001", b"LBIDSEND"
_HEAD = struct.Struct(">8sqqqqqq")  # magic, part, file of the part, token ids, bytes of documents, of distinct ids, blocks
_BLOCK = struct.Struct("<IIII")  # token ids, distinct ones, bytes, checksum


def pack_file(part: int, number: int, keys: list, counts: list[int], ids: np.ndarray, block: int = BLOCK_IDS) -> bytes:
    """The bytes of a file, without `ENDING`."""
    cuts = [ids[start : start + block] for start in range(0, len(ids), block)]
    parted = [np.unique(cut, return_inverse=True) for cut in cuts]
    digits = np.array([digits_for(len(distinct)) for distinct, _ in parted], np.int64)
    coded: list[bytes] = [b""] * len(cuts)
    for wanted in np.unique(digits).tolist():  # blocks of as many digits run together
        places = np.flatnonzero(digits == wanted).tolist()
        for place, code in zip(places, encode_blocks([parted[p][1] for p in places], wanted), strict=True):
            coded[place] = code
    steps = [np.diff(distinct, prepend=np.uint32(0)).astype("<u4").tobytes() for distinct, _ in parted]
    directory = zlib.compress(json.dumps([keys, counts], separators=(",", ":")).encode())
    distinct = zlib.compress(b"".join(steps))
    table = b"".join(
        _BLOCK.pack(len(cut), len(step) // 4, len(code), zlib.crc32(cut.astype("<u4").tobytes()))
        for cut, step, code in zip(cuts, steps, coded, strict=True)
    )
    head = _HEAD.pack(MAGIC, part, number, len(ids), len(directory), len(distinct), len(coded))
    return b"".join([head, directory, distinct, table, *coded])


def unpack_file(content: bytes) -> tuple[int, int, list, list[int], np.ndarray]:
    """Part, file number, document ids, their lengths, and all token ids; a wrong checksum is an error."""
    magic, part, number, total, directory, distinct, blocks = _HEAD.unpack_from(content)
    if magic != MAGIC or content[-len(ENDING) :] != ENDING:
        raise ValueError("not a file of token ids, or cut short")
    at = _HEAD.size + directory
    keys, counts = json.loads(zlib.decompress(content[_HEAD.size : at]))
    steps = np.frombuffer(zlib.decompress(content[at : at + distinct]), "<u4")
    at += distinct
    table = list(_BLOCK.iter_unpack(content[at : at + _BLOCK.size * blocks]))
    at += _BLOCK.size * blocks
    known, coded, used = [], [], 0
    for _, count, length, _ in table:
        known.append(np.cumsum(steps[used : used + count], dtype=np.uint32))
        coded.append(content[at : at + length])
        used, at = used + count, at + length
    digits = np.array([digits_for(len(of)) for of in known], np.int64)
    cuts: list[np.ndarray] = [np.zeros(0, np.uint32)] * blocks
    for wanted in np.unique(digits).tolist():
        places = np.flatnonzero(digits == wanted).tolist()
        numbers = decode_blocks([coded[p] for p in places], np.array([table[p][0] for p in places]), wanted)
        for place, found in zip(places, numbers, strict=True):
            cuts[place] = known[place][np.minimum(found, len(known[place]) - 1)]
            if zlib.crc32(cuts[place].astype("<u4").tobytes()) != table[place][3]:
                raise ValueError(f"checksum of block {place} does not match")
    ids = np.concatenate(cuts) if cuts else np.zeros(0, np.uint32)
    if len(ids) != total or sum(counts) != total:
        raise ValueError("lengths do not add up")
    return part, number, keys, counts, ids


def write_ids(
    docs: DataFrame, path: str, tokenizer: str, doc_id: str = "doc_id", text: str = "text", end_id: int = END_ID, file_ids: int = FILE_IDS
) -> None:
    """Write the token ids of all documents below `path`, ordered by id.

    Each document ends with `end_id`; a null or empty text is that one id. A
    null id stands before all others; rows that repeat an id are kept, in the
    order of their texts. Ids must be numbers or strings. Other columns take no
    part; no rows, no files.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, number = word_encoder(tokenizer), TaskContext.get().partitionId(), 0
        end = np.array([end_id], "<u4").tobytes()
        keys, held, total = [], [], 0

        def file() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(held), "<u4")
            content = pack_file(part, number, keys, [len(x) // 4 for x in held], ids)
            return pa.RecordBatch.from_arrays([pa.array([content], pa.binary())], ["content"])

        for batch in slices(batches, BATCH_DOCS):
            texts = [content or "" for content in batch.column(1).to_pylist()]
            for key, ids in zip(batch.column(0).to_pylist(), encoder.encode(texts), strict=True):
                if total and total + len(ids) // 4 + 1 > file_ids:
                    yield file()
                    keys, held, total, number = [], [], 0, number + 1
                keys.append(key)
                held.append(ids + end)
                total += len(held[-1]) // 4
        if keys:
            yield file()

    write_files(ordered.mapInArrow(run, "content binary"), "content", path, ENDING)


def read_ids(spark: SparkSession, path: str, id_type: str = "bigint") -> DataFrame:
    """`doc_id, start, n_tokens, ids` of every document below `path`.

    `ids` are little-endian unsigned 32-bit integers, `start` the number of
    token ids of all documents before this one.
    """
    files = read_files(spark, path).select("content")
    number = lambda place: F.conv(F.hex(F.substring("content", place, 8)), 16, 10).cast("long")
    heads = files.select(number(9).alias("part"), number(17).alias("file"), number(25).alias("n"))
    parts = heads.groupBy("part").agg(F.sum("n").alias("n"))
    # One row for each partition of the write, whatever it holds.
    before = lambda over: F.coalesce(F.sum("n").over(over.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select("part", before(Window.orderBy("part")).alias("part_start"))
    heads = heads.select("part", "file", before(Window.partitionBy("part").orderBy("file")).alias("file_start"))
    starts = heads.join(parts, "part").select("part", "file", (F.col("part_start") + F.col("file_start")).alias("base"))
    starts = written(starts, "file-starts")  # of known size, so that the ids need not be shuffled to join it

    schema = f"part long, file long, place long, doc_id {id_type}, n_tokens long, ids binary"
    rows = spark.createDataFrame([], schema)
    key_type = to_arrow_type(rows.schema["doc_id"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            part, file, keys, counts, ids = unpack_file(batch.column(0)[0].as_py())
            ends = np.cumsum(counts)
            for low in range(0, len(keys), BATCH_DOCS):
                high = min(low + BATCH_DOCS, len(keys))
                spans = [(int(ends[i]) - counts[i], int(ends[i])) for i in range(low, high)]
                columns = [
                    pa.array([part] * len(spans), pa.int64()),
                    pa.array([file] * len(spans), pa.int64()),
                    pa.array([a for a, _ in spans], pa.int64()),
                    pa.array(keys[low:high], key_type),
                    pa.array(counts[low:high], pa.int64()),
                    pa.array([ids[a:b].astype("<u4").tobytes() for a, b in spans], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["part", "file", "place", "doc_id", "n_tokens", "ids"])

    docs = files.mapInArrow(run, schema).join(starts, ["part", "file"])
    return docs.select("doc_id", (F.col("base") + F.col("place")).alias("start"), "n_tokens", "ids")
