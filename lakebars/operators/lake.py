"""Partitioned tables: replace whole partitions, read pruned."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakebars.operators import versions
from lakebars.operators.scratch import settle
from lakebars.sources.files import directories, scan_or_empty

ROWS_PER_FILE = 5_000_000
# Input of no more than this is not counted: spread over one file a partition, none can be large.
SMALL_BYTES = 64 << 20

# Characters Spark writes as %XX in the name of a partition directory.
_ESCAPED = frozenset('"#%\'*/:=?\\\x7f{[]^') | frozenset(map(chr, range(1, 32)))


def _tasks(spark: SparkSession, files: int) -> int:
    """Tasks to write so many files: some sixteen each, but the session's shuffle partitions at least."""
    return min(files, max(int(spark.conf.get("spark.sql.shuffle.partitions")), files // 16))


def _bytes(df: DataFrame) -> int:
    """Spark's estimate, from the sizes of the files read."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def by_partition(
    df: DataFrame, keys: Sequence[str], rows_per_file: int = ROWS_PER_FILE, scratch: str | None = None, sizes: DataFrame | None = None
) -> DataFrame:
    """`df` dealt so that each table partition is written as one file for each `rows_per_file` of its rows, begun.

    The rows of a partition are counted first, unless `sizes`, a written table,
    holds their numbers `n` by `keys`, or the input is small. A large one is spread over
    several tasks by a hash of the row; small ones share tasks. The number of
    tasks follows the rows and is never below the session's shuffle partitions,
    unless there are fewer files.
    """
    spark = df.sparkSession
    if sizes is None and rows_per_file == ROWS_PER_FILE and _bytes(df) <= SMALL_BYTES:
        return df.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), *keys)
    files = lambda n: F.ceil(n / F.lit(rows_per_file)).cast("int").alias("_files")
    if sizes is None:
        sizes = settle(df.groupBy(*keys).agg(files(F.count("*"))), "sizes", scratch)
    else:
        sizes = sizes.groupBy(*keys).agg(files(F.sum("n")))
    total = sizes.agg(F.sum("_files").alias("n"), F.max("_files").alias("most")).first()
    if total.n is None:
        return df
    tasks = _tasks(spark, total.n)
    if total.most == 1:
        return df.repartition(tasks, *keys)
    named = sizes.withColumnsRenamed({key: f"_of_{key}" for key in keys})
    same = reduce(and_, (F.col(key).eqNullSafe(F.col(f"_of_{key}")) for key in keys))
    salted = df.withColumn("_row", F.xxhash64(*df.columns)).join(named.filter("_files > 1"), same, "left")
    salted = salted.withColumn("_file", F.pmod("_row", F.coalesce("_files", F.lit(1))))
    return salted.repartition(tasks, *keys, "_file").select(*df.columns)


def write_partitions(
    df: DataFrame,
    path: str,
    keys: Sequence[str],
    fmt: str = "parquet",
    replace: bool = True,
    gather: bool = True,
    rows_per_file: int = ROWS_PER_FILE,
    scratch: str | None = None,
    sort: Sequence[str] = (),
    sizes: DataFrame | None = None,
    **options: str,
) -> None:
    """Replace the partitions present in `df`, or add files to them; leave all others alone.

    Rows are gathered by `by_partition`, which reads `df` once more to count
    unless it is given `sizes`. Partitions are deleted before new files stand in
    their place; `commit_partitions` replaces them at once.
    Without `gather` rows are not moved at all, for input whose files already
    hold one partition each. `sort` orders the rows of a file, for filters that
    skip by its statistics. No session setting is touched.
    """
    df = by_partition(df, keys, rows_per_file, scratch, sizes) if gather else df
    (
        (df.sortWithinPartitions(*keys, *sort) if sort else df)
        .write.format(fmt)
        .mode("overwrite" if replace else "append")
        .option("partitionOverwriteMode", "dynamic")
        .options(**options)
        .partitionBy(*keys)
        .save(path)
    )


def commit_partitions(
    df: DataFrame,
    path: str,
    keys: Sequence[str],
    fmt: str = "parquet",
    replaces: bool = True,
    gather: bool = True,
    sizes: DataFrame | None = None,
    sort: Sequence[str] = (),
    options: Mapping[str, str] | None = None,
    **entry: object,
) -> int:
    """Replace the partitions present in `df`, or add to them, in one step (`versions`); how many they are.

    Readers of the lake see all of it or nothing. `entry` goes to `versions.commit`.
    """
    versions.begin(df.sparkSession, path, keys)
    made, folder = versions.new_folder(path)
    write_partitions(df, folder, keys, fmt, replace=False, gather=gather, sizes=sizes, sort=sort, **(options or {}))
    return versions.commit(df.sparkSession, path, keys, made, replaces, **entry)[1]


def commit_small_partitions(df: DataFrame, path: str, keys: Sequence[str], **entry: object) -> int:
    """`commit_partitions` for partitions that hold a few rows by their nature: each is one file."""
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return commit_partitions(df.repartition(tasks, *keys), path, keys, gather=False, **entry)


def read_partitions(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", **options: str
) -> DataFrame:
    """The table at `path` as it is now, with no rows if nothing was written yet."""
    now = versions.snapshot(spark, path)
    if now is not None:
        return versions.read(spark, path, schema, now, fmt=fmt, **options)
    return scan_or_empty(spark, path, schema, fmt, **options)


def partition_name(key: str, value: object) -> str:
    """Name of a partition's directory."""
    text = "".join(f"%{ord(c):02X}" if c in _ESCAPED else c for c in str(value))
    return f"{key}={text}"


def _literal(name: str) -> str:
    """`name` in a path pattern, standing for itself."""
    return "".join(f"\\{c}" if c in "\\*?[]{}^" else c for c in name)


def read_named(
    spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], partitions: Sequence[Mapping[str, object]]
) -> DataFrame:
    """Only the directories of `partitions`; no other directory is listed.

    `keys` are the table's partition columns from the first on; a key that a
    partition does not name matches all. Directories that do not exist have no
    rows.
    """
    now = versions.snapshot(spark, path)
    if now is not None:
        return versions.read(spark, path, schema, now, _matching(now, keys, partitions))
    found = []
    for partition in partitions:
        names = [_literal(partition_name(key, partition[key])) if key in partition else f"{key}=*" for key in keys]
        found += directories(spark, "/".join([path.rstrip("/"), *names]))
    return scan_or_empty(spark, found, schema, basePath=path) if found else read_partitions(spark, f"{path}/_none", schema)


def _matching(now: versions.Snapshot, keys: Sequence[str], partitions: Sequence[Mapping[str, object]]) -> set[str]:
    """The live partitions that one of `partitions` names."""
    asked: dict[tuple[int, ...], set[tuple[str, ...]]] = {}
    for partition in partitions:
        places = tuple(i for i, key in enumerate(keys) if key in partition)
        asked.setdefault(places, set()).add(tuple(partition_name(keys[i], partition[keys[i]]) for i in places))
    found = set()
    for name in now.live:
        parts = name.split("/")
        if any(tuple(parts[i] for i in places) in wanted for places, wanted in asked.items()):
            found.add(name)
    return found


def read_month(spark: SparkSession, path: str, schema: T.StructType, year_month: str, keys: Sequence[str] = ("year", "month")) -> DataFrame:
    """One month of a table partitioned by `keys` first; only that month's directories are listed and read."""
    year, month = year_month.split("-")
    return read_named(spark, path, schema, keys, [{"year": year, "month": month}])


def distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The partitions that rows of `df` belong to, kept as a DataFrame."""
    return df.select(*keys).distinct()
