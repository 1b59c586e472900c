"""Groups of documents whose word shingles are similar, exact for every pair.

1. A document's set is its distinct shingles, as 64-bit hashes. Equal sets are
   one from here on, so copies cost nothing more.
2. Sets that may be similar share a key; those that share one meet in the group
   of the smallest of them. Up to a similarity of `SEGMENTS_FROM` the keys are
   shingles: two sets of similarity t share one among the first (1 - t) n + 1 of
   each, in any order that is the same for all (by hash, with the shingles that
   a sample finds frequent put last). From there on, where similar sets differ in
   few members, the keys are segments: the hashes are cut into more ranges than
   the members in which similar sets of this size can differ, so some ranges
   hold the same members. Such a key stands for several shingles, so sets that
   only share a passage or common phrases do not meet.
3. A group is divided into blocks of a bounded size; each block, and each two
   blocks of one group, are joined by signature trees in a task of their own,
   from the bitmaps of the sets alone. What has a possible partner goes on.
4. The members of those sets are taken from the texts again, and the trees joined
   once more with the overlap counted exactly. A task returns only as many
   links as connect what it finds linked.
5. Links become components.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakebars.llm.common import filtered, hashed_share, release, slices, text_of, written
from lakebars.llm.components import components
from lakebars.llm.signature_tree import bitmaps, bits_for, candidates, links

WORDS = 5
SIMILARITY = (4, 5)  # numerator and denominator
ORDER_SAMPLE = 8_000  # documents that tell which shingles are frequent
FREQUENT_FROM = 4  # documents of the sample
FREQUENT_KEPT = 1 << 16
BLOCK_BITMAPS = 512
BLOCK_SETS = 512
BLOCK_SHINGLES = 1 << 20
BATCH_DOCS = 256
KNOWN_WORDS = 1 << 15  # words a task remembers; those met often soon return
SEGMENTS_FROM = (9, 10)

_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], np.uint64)


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


class Shingler:
    """The set of a text: sorted hashes of its distinct shingles of `width` words."""

    def __init__(self, width: int) -> None:
        self.width = width
        self._words = _Words()

    def __call__(self, text: str | None) -> np.ndarray:
        # Of bytes, both functions know ASCII only: A-Z, and the blanks 0x20 and 0x09 to 0x0D.
        words = (text or "").encode().lower().split()
        if not words:
            return np.zeros(0, np.uint64)
        hashes = np.fromiter(map(self._words.__getitem__, words), np.uint64, len(words))
        width = min(self.width, len(words))
        mixed = np.full(len(words) - width + 1, width, np.uint64)
        for place in range(width):
            mixed = (mixed ^ hashes[place : place + len(mixed)]) * _ODD[place % len(_ODD)]
            mixed ^= mixed >> np.uint64(32)
        mixed *= _ODD[0]
        return np.unique(mixed ^ (mixed >> np.uint64(29)))


def _key(members: np.ndarray) -> tuple[int, int]:
    digest = xxhash.xxh128_digest(members.astype("<u8").tobytes())
    return tuple(np.frombuffer(digest, "<i8").tolist())


def _first(members: np.ndarray, frequent: np.ndarray, num: int, den: int) -> np.ndarray:
    """The shingles of which similar sets share at least one."""
    count = len(members) - (-(-len(members) * num // den)) + 1
    if not len(members):
        return members
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, members), len(frequent) - 1)
        members = members[np.argsort(frequent[at] == members, kind="stable")]
    return members[:count]


class Segments:
    """Keys of sets by the contents of hash ranges; the number of ranges depends on the size of the set."""

    def __init__(self, num: int, den: int) -> None:
        self.num, self.den = num, den
        self._tops: list[int] = []  # largest size of each band

    def _bands(self, n: int) -> list[int]:
        """The band of size `n`, and those below whose sets may have a similar one of this size."""
        while not self._tops or self._tops[-1] < n:
            low = (self._tops[-1] if self._tops else 0) + 1
            self._tops.append(max(low, low * self.den**3 // self.num**3))
        own = bisect.bisect_left(self._tops, n)
        found = [own]
        while found[-1] and n <= self._tops[found[-1] - 1] * self.den // self.num:
            found.append(found[-1] - 1)
        return found

    def keys(self, members: np.ndarray) -> np.ndarray:
        if not len(members):
            return members
        found = []
        high = members >> np.uint64(32)
        mixed = (members ^ (members >> np.uint64(31))) * _ODD[1]
        for band in self._bands(len(members)):
            top = self._tops[band]
            # At most so many members are in one of two similar sets only, the smaller being of this band.
            differing = (top + top * self.den // self.num) * (self.den - self.num) // (self.den + self.num)
            ranges = differing + 1 + (2 + differing // 16 if differing else 0)
            place = (high * np.uint64(ranges)) >> np.uint64(32)
            starts = np.concatenate([[0], np.flatnonzero(np.diff(place)) + 1])
            content = np.add.reduceat(mixed, starts)
            place = place[starts]
            if ranges - len(place) >= ranges - differing:
                # So many ranges are empty that all that two sets agree on may be empty ones: these count too.
                empty = np.setdiff1d(np.arange(ranges, dtype=np.uint64), place)
                place, content = np.append(place, empty), np.append(content, np.zeros(len(empty), np.uint64))
            key = (content ^ (place * _ODD[2] + np.uint64((band + 1) * int(_ODD[3]) % (1 << 64)))) * _ODD[0]
            found.append(key ^ (key >> np.uint64(29)))
        return np.concatenate(found)


def frequent_shingles(docs: DataFrame, width: int, text: str, doc_id: str, sample: int = ORDER_SAMPLE) -> np.ndarray:
    """Up to `FREQUENT_KEPT` shingles that several documents of a bounded sample share; they only order the work."""
    total = docs.count()
    some = docs.filter(hashed_share([doc_id, text], seed=4) < min(1.0, sample / max(1, total)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(width)
        for batch in slices(batches, BATCH_DOCS):
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([shingler(t) for t in batch.column(0).to_pylist()]).view(np.int64))], ["s"])

    counts = some.select(text).mapInArrow(run, "s long").groupBy("s").count().filter(F.col("count") >= FREQUENT_FROM)
    best = counts.orderBy(F.desc("count"), "s").limit(FREQUENT_KEPT).select("s").toPandas()
    return np.sort(best["s"].to_numpy(np.int64).view(np.uint64))


def _summaries(docs: DataFrame, width: int, frequent: np.ndarray | None, num: int, den: int) -> DataFrame:
    """`row, doc_id, text_hash, n, d1, d2, keys, bitmap`: a document's set, without its members."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.xxhash64("text").alias("text_hash"), "text")
    kept = rows.drop("text").schema
    schema = T.StructType([*kept, *T.StructType.fromDDL("n long, d1 long, d2 long, keys array<long>, bitmap binary")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, segments = Shingler(width), Segments(num, den)
        for batch in slices(batches, BATCH_DOCS):
            sets = [shingler(t) for t in batch.column(3).to_pylist()]
            names = [_key(s) for s in sets]
            keys = [segments.keys(s) if frequent is None else _first(s, frequent, num, den) for s in sets]
            columns = [[len(s) for s in sets], [k[0] for k in names], [k[1] for k in names]]
            arrays = [pa.array(c, pa.int64()) for c in columns]
            lists = pa.array([k.view(np.int64) for k in keys], pa.list_(pa.int64()))
            bits = pa.array([bitmaps([s], bits_for(len(s))).tobytes() for s in sets], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *arrays, lists, bits], schema.names)

    return written(rows.mapInArrow(run, schema), "set-summaries")


def _members(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """`set, n, members` of the sets in `wanted` (`set, doc_id, n, d1, d2`), from the texts again."""
    keys = wanted.select("set", F.col("doc_id").alias("_doc"), "n", "d1", "d2")
    docs = filtered(docs, F.col("doc_id"), keys, F.col("_doc"))  # most texts need not be moved
    rows = docs.join(keys, docs["doc_id"].eqNullSafe(keys["_doc"])).select("text", "set", "n", "d1", "d2")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(width)
        for batch in slices(batches, BATCH_DOCS):
            texts, *columns = (c.to_pylist() for c in batch.columns)
            found = []
            for text, name, n, d1, d2 in zip(texts, *columns, strict=True):
                members = shingler(text)
                if (len(members), *_key(members)) == (n, d1, d2):  # another text of the same id has another set
                    found.append((name, n, members.astype("<u8").tobytes()))
            if found:
                name, n, data = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(name, pa.int64()), pa.array(n, pa.int64()), pa.array(data, pa.binary())], ["set", "n", "members"])

    return rows.mapInArrow(run, "set long, n long, members binary").dropDuplicates(["set"])


def _dealt(groups: DataFrame, blocks: DataFrame) -> DataFrame:
    """`leader, i, j, side, set`: each set of a group with every block (`leader, blocks`) of its group, its own included."""
    dealt = groups.join(blocks, "leader").withColumn("side", F.pmod(F.xxhash64("set"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    low, high = F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j")
    return written(dealt.select("leader", low, high, "side", "set"), "dealt-sets")


def _one_sided(pair: pd.DataFrame) -> bool:
    """A part with nothing to join: one set, or only one of its two blocks."""
    return len(pair) < 2 or (pair["i"].iat[0] != pair["j"].iat[0] and pair["side"].nunique() < 2)


def _possible(groups: DataFrame, sketches: DataFrame, num: int, den: int) -> DataFrame:
    """The rows of `groups` (`leader, set`) that may have a partner, by `sketches` (`set, n, bitmap`)."""
    sizes = groups.groupBy("leader").count().filter("count > 1")
    sizes = written(sizes.select("leader", F.ceil(F.col("count") / BLOCK_BITMAPS).cast("int").alias("blocks")), "group-blocks")
    rows = _dealt(groups, sizes).join(sketches, "set")

    def run(pair: pd.DataFrame) -> pd.DataFrame:
        if _one_sided(pair):
            return pd.DataFrame({"leader": [], "set": []}, dtype="int64")
        words = [np.frombuffer(data, "<u8") for data in pair["bitmap"]]
        a, b = candidates(words, pair["n"].to_numpy(), pair["side"].to_numpy(), num, den)
        return pair.iloc[np.unique(np.concatenate([a, b]))][["leader", "set"]]

    return rows.groupBy("leader", "i", "j").applyInPandas(run, "leader long, set long").distinct()


def _links(groups: DataFrame, members: DataFrame, num: int, den: int) -> DataFrame:
    """`a, b`: links between sets of a group, each group divided into blocks."""
    sizes = groups.join(members.select("set", "n"), "set").groupBy("leader").agg(F.count("*").alias("sets"), F.sum("n").alias("all"))
    blocks = F.greatest(F.ceil(F.col("sets") / BLOCK_SETS), F.ceil(F.col("all") / BLOCK_SHINGLES)).cast("int")
    sizes = written(sizes.filter("sets > 1").select("leader", blocks.alias("blocks")), "group-blocks")
    rows = _dealt(groups, sizes).join(members.select("set", "members"), "set")

    def run(pair: pd.DataFrame) -> pd.DataFrame:
        if _one_sided(pair):
            return pd.DataFrame({"a": [], "b": []}, dtype="int64")
        pair = pair.sort_values("set")
        sets = [np.frombuffer(data, "<u8") for data in pair["members"]]
        found = links(pair["set"].to_numpy(), sets, pair["side"].to_numpy(), num, den)
        return pd.DataFrame(list(found), columns=["a", "b"], dtype="int64")

    return rows.groupBy("leader", "i", "j").applyInPandas(run, "a long, b long")


def similar_groups(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS, similarity: tuple[int, int] = SIMILARITY
) -> DataFrame:
    """`doc_id, text_hash, n_shingles, component_id`: one row for each row of `docs`.

    A-Z are lowered and words are runs of anything but blanks. A text of fewer
    than `words` words is one shingle; a text without words, or null, has none
    and is linked with nothing. Two rows link when the overlap of their sets is
    at least `similarity` of their union. `component_id` is the smallest id
    reachable by links, its own included; ids that are null are reached but
    never smallest, so a group of them alone has null. `text_hash` is Spark's
    `xxhash64` of the text, which tells rows apart that repeat an id. Other
    columns take no part; no rows in, no rows out.
    """
    num, den = similarity
    docs = docs.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("text"))
    frequent = None if num * SEGMENTS_FROM[1] >= SEGMENTS_FROM[0] * den else frequent_shingles(docs, words, "text", "doc_id")
    summaries = _summaries(docs, words, frequent, num, den)
    rows = written(summaries.drop("keys", "bitmap"), "set-names")
    key = ["n", "d1", "d2"]
    sets = rows.filter("n > 0").groupBy(*key).agg(F.min("row").alias("set"), F.min("doc_id").alias("lowest"))
    sets = written(sets, "sets")

    own = summaries.select(F.col("row").alias("set"), "n", "keys", "bitmap").join(sets.select("set"), "set")
    own = written(own, "set-keys")
    release(summaries)
    keyed = own.select("set", F.explode("keys").alias("k"))
    shared = keyed.groupBy("k").agg(F.min("set").alias("leader"), F.max("set").alias("_last"))
    shared = written(shared.filter(F.col("leader") != F.col("_last")).drop("_last"), "shared-keys")
    groups = written(keyed.join(shared, "k").select("leader", "set").distinct(), "set-groups")
    release(shared)
    groups = written(_possible(groups, own.select("set", "n", "bitmap"), num, den), "possible-groups")
    release(own)

    named = rows.select(F.col("row").alias("set"), "doc_id", *key)
    wanted = written(named.join(groups.select("set").distinct(), "set", "left_semi"), "wanted-sets")
    members = written(_members(docs, wanted, words), "set-members")
    found = written(_links(groups, members, num, den), "set-links")
    joined = written(components(found), "set-components")

    lowest = joined.join(sets.select(F.col("set").alias("node"), "lowest"), "node")
    lowest = lowest.groupBy("component").agg(F.min("lowest").alias("component_id"))
    named = written(joined.join(lowest, "component").select(F.col("node").alias("set"), "component_id"), "set-names")
    named = sets.join(named, "set", "left").select(*key, F.coalesce("component_id", "lowest").alias("component_id"))
    named = written(named, "named-sets")
    labelled = rows.select("doc_id", "text_hash", *key).join(named, key, "left")
    component = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return labelled.select("doc_id", "text_hash", F.col("n").alias("n_shingles"), component.alias("component_id"))


def one_of_each_group(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **how: object) -> DataFrame:
    """The rows of `docs` whose id is the smallest of their group; all columns.

    Rows without words, and rows of groups without an id, all stay.
    """
    found = similar_groups(docs, doc_id, text, **how)
    gone = found.filter(F.col("component_id").isNotNull() & ~F.col("doc_id").eqNullSafe(F.col("component_id")))
    gone = written(gone.select(F.col("doc_id").alias("_doc"), F.col("text_hash").alias("_hash")).distinct(), "near-copies")
    same = docs[doc_id].eqNullSafe(gone["_doc"]) & (F.xxhash64(text_of(text)) == gone["_hash"])
    return docs.join(gone, same, "left_anti")
