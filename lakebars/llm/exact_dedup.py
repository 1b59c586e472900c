"""Exact duplicates by deterministic block naming, in DataFrame functions only.

A text is cut into blocks of a fixed number of bytes. Equal blocks get equal
integer names and different blocks different ones: the distinct blocks are
sorted, and a block's name is its number in that order. Then adjacent names are
named again: the distinct pairs are sorted and numbered, which halves the names
of a text each time, until every text has one. Equality of that name and of the
number of rounds is equality of the texts.

Blocks are sorted by a 64-bit digest and, where one digest stands for several
contents, by content. Names are free of collisions whatever the digest does; a poor
digest only costs time. Equal contents and equal pairs collapse before a
shuffle, so a large group of copies costs no more than its names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakebars.llm.common import SPACE, fresh, text_of, written

BLOCK_BYTES = 512

Digest = Callable[..., Column]


def normalised(text: str) -> Column:
    """Null as empty; every run of white space as one space.

    The pattern leaves out the run that is one space already, so that most of
    the text is not rewritten.
    """
    return F.regexp_replace(text_of(text), r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+", " ")


def _blocks(docs: DataFrame, text: str, size: int, digest: Digest) -> DataFrame:
    """`docs` with `text_sha256`, `pos`, `n`, `content` and `digest`, one row per block; an empty text is one empty block."""
    data = docs.withColumn("_bytes", normalised(text).cast("binary"))
    data = data.withColumn("text_sha256", F.sha2("_bytes", 256))
    data = data.withColumn("n", F.greatest(F.lit(1), F.ceil(F.octet_length("_bytes") / size)).cast("int"))
    cut = F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.substring(F.col("_bytes"), i * size + 1, size))
    kept = [c for c in data.columns if c not in (text, "_bytes")]  # the whole text must not ride on every block
    rows = data.select(*kept, F.posexplode(cut).alias("pos", "content"))
    return rows.withColumn("digest", digest(F.col("content")))


def _ties(contents: DataFrame) -> DataFrame:
    """`digest, content, tie`: the contents of each digest, numbered in their order from 0."""
    # Only contents that clash reach this window: one row for each, copies left out.
    order = Window.partitionBy("digest").orderBy("content")
    return contents.withColumn("tie", F.row_number().over(order) - 1)


def _numbered(keys: DataFrame, columns: list[str], table: str) -> DataFrame:
    """The distinct rows of `keys` with `name`, integers from 0 that rise in their order, not always by one."""
    order = keys.select(*columns).distinct().orderBy(*columns)
    # Written once, so that a name stays what it is when an executor is lost.
    return written(order.withColumn("name", F.monotonically_increasing_id()), table)


def document_names(
    docs: DataFrame, text: str = "text", block_bytes: int = BLOCK_BYTES, digest: Digest = F.xxhash64
) -> DataFrame:
    """`docs` without its text, plus `level, name`, the identity of the text, and `text_sha256`."""
    keep = [c for c in docs.columns if c != text]
    docs = docs.withColumn("_row", F.monotonically_increasing_id())
    blocks = _blocks(docs, text, block_bytes, digest)
    first = F.when(F.col("pos") == 0, F.col("text_sha256")).alias("text_sha256")
    names = written(blocks.select("_row", *keep, "pos", "n", "digest", first), "block-names")

    # Equal contents collapse in each task before this shuffle; where no digest has two contents, they are not needed again.
    contents = _blocks(docs.select(text), text, block_bytes, digest).select("digest", "content").distinct()
    clashes = contents.groupBy("digest").count().filter("count > 1").select("digest")
    clashes = written(clashes, "clashing-digests")
    tie = F.lit(0).alias("tie")
    if not clashes.isEmpty():
        # Names that need the content: written once more, with it at hand.
        ties = written(_ties(contents.join(clashes, "digest", "left_semi")), "block-ties")
        tied = blocks.join(ties, ["digest", "content"], "left").withColumn("tie", F.coalesce("tie", F.lit(0)))
        names = written(tied.select("_row", *keep, "pos", "n", "digest", first, "tie"), "block-names")
        tie = F.col("tie")
    names = names.withColumn("tie", tie)
    whole = names.filter("pos = 0").select("_row", *keep, "text_sha256")
    block = ["digest", "tie"]
    named = names.join(_numbered(names, block, "block-numbers"), block).select("_row", "pos", "n", "name")
    named = written(named, "named-blocks")
    done = named.filter("n = 1").select("_row", F.lit(0).alias("level"), "name")
    left = named.filter("n > 1")
    level = 0
    while not left.isEmpty():
        level += 1
        named = _paired(left, level)
        done = done.unionByName(named.filter("n = 1").select("_row", F.lit(level).alias("level"), "name"))
        left = named.filter("n > 1")
    return whole.join(done, "_row").drop("_row")


def _paired(names: DataFrame, level: int) -> DataFrame:
    """One name for each two neighbours; the last of an odd number is paired with none, here -1."""
    even = F.col("pos") % 2 == 0
    side = lambda on: F.coalesce(F.max(F.when(on, F.col("name"))), F.lit(-1).cast("long"))
    pairs = names.groupBy("_row", F.expr("pos div 2").cast("int").alias("pos"), "n")
    pairs = written(pairs.agg(side(even).alias("l"), side(~even).alias("r")), f"pairs-{level}")
    named = pairs.join(_numbered(pairs, ["l", "r"], f"pair-numbers-{level}"), ["l", "r"])
    return written(named.select("_row", "pos", F.expr("(n + 1) div 2").cast("int").alias("n"), "name"), f"pair-names-{level}")


def exact_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **naming: object) -> DataFrame:
    """`doc_id, keep_id, group_size, kept, text_sha256`: one row for each row of `docs`.

    Texts are equal when identical after each run of white space has become one
    space; null counts as empty. The smallest id of a group stays; a null id
    stands after all others. Rows that repeat an id and its text count in the
    group's size, and all rows with the smallest id are `kept`. Other columns
    take no part. No rows in, no rows out.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    identity = ["level", "name"]
    names = written(document_names(rows, **naming), "document-names")
    groups = names.groupBy(*identity).agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    # Only groups of several rows: a copy group may be hot, and Spark splits a skewed side that is a plain table.
    several = written(groups.filter("group_size > 1"), "copy-groups")
    joined = names.join(several, identity, "left")
    alone = F.col("group_size").isNull()
    keep = F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id"))
    return joined.select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"),
        "text_sha256",
    )


def without_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **naming: object) -> DataFrame:
    """The rows of `docs` that stay: all columns, one row for each text.

    A row that repeats an id and its text is a copy too: one of them stays.
    """
    found = written(exact_dedup(docs, doc_id, text, **naming), "copies")
    gone = found.filter(~F.col("kept")).select("doc_id", "text_sha256").distinct()
    repeats = found.filter("kept").groupBy("doc_id", "text_sha256").count().filter("count > 1").drop("count")
    repeats = written(repeats, "repeated-rows")
    sha = fresh(docs.columns, "_sha")
    rows = docs.withColumn(sha, F.sha2(normalised(text).cast("binary"), 256))
    same = lambda other: rows[doc_id].eqNullSafe(other["doc_id"]) & (rows[sha] == other["text_sha256"])
    rows = rows.join(gone, same(gone), "left_anti")
    if repeats.isEmpty():
        return rows.drop(sha)
    once = rows.join(repeats, same(repeats), "left_anti")
    twice = rows.join(repeats, same(repeats), "left_semi").dropDuplicates([doc_id, sha])
    return once.unionByName(twice).drop(sha)
