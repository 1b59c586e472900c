"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakebars.operators.scratch import scratch_path

SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write `df` below the shared checkpoint folder and read it back.

    Ends the lineage: what reads the result starts at files that outlive a lost
    executor, and Spark knows their size when it chooses a join.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(df: DataFrame) -> None:
    """Delete a table made by `written` that nothing reads any more.

    What was made from it must be written already, so that a lost executor
    never needs it again.
    """
    files = df.inputFiles()
    if files:
        jvm = df.sparkSession.sparkContext._jvm
        folder = jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        folder.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def text_of(name: str) -> Column:
    """A text column, null as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def crc_bucket(doc_id: str, buckets: int) -> Column:
    """`crc32` of the id as text, modulo `buckets`; null ids fall in bucket 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % buckets, F.lit(0))


def hashed_share(key: Iterable[str], seed: int) -> Column:
    """A number from 0 to below 1 that depends on `key` only; equal keys get equal numbers."""
    return F.pmod(F.xxhash64(F.lit(seed), *key), F.lit(1 << 30)) / F.lit(float(1 << 30))


def sampled(df: DataFrame, key: Iterable[str], rows: int, of: int, seed: int) -> DataFrame:
    """About `rows` of the `of` rows, chosen by a hash of `key`; all of them if there are no more."""
    return df if of <= rows else df.filter(hashed_share(key, seed) < rows / of)


FILTER_BITS = 1 << 25


def filtered(rows: DataFrame, key: Column, wanted: DataFrame, wanted_key: Column, bits: int = FILTER_BITS) -> DataFrame:
    """`rows` without most of those whose `key` is not in `wanted`, and with all of those whose key is.

    A bitmap of the hashes of the wanted keys goes to every task: `bits` / 8
    bytes at most, however many keys there are. It only lightens the join that
    must follow; beyond some `bits` wanted keys it lets most rows through.
    """
    place = lambda of: F.pmod(F.xxhash64(of), F.lit(bits))
    marks = wanted.select(place(wanted_key).alias("_place"))
    marks = marks.groupBy(F.expr("_place div 32768").alias("_bucket"))
    marks = marks.agg(F.bitmap_construct_agg(F.col("_place") % 32768).alias("_bitmap"))
    hashed = rows.withColumn("_place", place(key)).withColumn("_bucket", F.expr("_place div 32768"))
    byte = "cast(conv(hex(substring(_bitmap, cast(_place % 32768 div 8 AS int) + 1, 1)), 16, 10) AS int)"
    there = F.expr(f"({byte} & shiftleft(1, cast(_place % 8 AS int))) <> 0")
    # Bounded: one row of 4 KB for each 32768 bits.
    met = hashed.join(F.broadcast(written(marks, "key-bitmap")), "_bucket").filter(there)
    return met.select(*rows.columns)


def slices(batches: Iterator, rows: int) -> Iterator:
    """Arrow batches cut to at most `rows` rows each, to bound what a task holds."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def fresh(columns: Iterable[str], name: str) -> str:
    """`name`, or `name` with underscores behind it, so that no column is called that; names ignore case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


OFTEN = 1000


def looked_up(rows: DataFrame, found: DataFrame, key: str, times: str, often: int = OFTEN) -> DataFrame:
    """`rows` with the columns of `found`, nulls where there is none.

    `found` has one row for each `key`, and in `times` how many of `rows` have
    that key. At most `often` keys can each be more than an `often`-th of all
    rows: these are broadcast, so a key with a third of the rows is not shuffled;
    of the others none weighs more than that share in the join that follows. Both
    tables are read twice and should be written ones.
    """
    total = found.agg(F.sum(times)).first()[0] or 0
    heavy = F.col(times) * often > total
    # Bounded: at most `often` rows.
    hot = F.broadcast(found.filter(heavy))
    there = rows.filter(F.col(key).isNotNull())
    light = there.join(F.broadcast(found.filter(heavy).select(key)), key, "left_anti").join(found.filter(~heavy), key, "left")
    none = rows.filter(F.col(key).isNull())
    return there.join(hot, key).unionByName(light).unionByName(none, allowMissingColumns=True)
