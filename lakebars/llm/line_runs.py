"""Lines that many documents share, by levelled sorted runs of line hashes.

A run is a table of line hashes, each with a number of documents, bucketed by
hash and sorted within a bucket. Each batch of documents becomes a run: it
merge-anti-joins the runs that are there, so that a line which one of them
already knows to be in enough documents is not counted again, and adds what is
left. Runs of one length that lie side by side are compacted into one of the
next level, so a store of b batches has some `fan_out * log(b)` runs, and a hash
is written again once a level. Joins read the buckets of a run in place; only
the batch is shuffled.

A run's name says which batches it covers. One that is not written completely
does not count, nor does one that lies within a longer one: so a compaction takes
effect with the marker Spark writes last, and a crash before it, or before the
shorter runs are deleted, changes nothing.
"""

from __future__ import annotations

import hashlib
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakebars.llm.common import OFTEN, filtered, text_of, written
from lakebars.operators.scratch import remove, scratch_path
from lakebars.sources.files import directories

DOCUMENTS = 10
CHARS = 1
FAN_OUT = 3
BATCHES = 6
LINES_PER_BUCKET = 2_000_000
LEAST_BUCKETS = 8

_BLANK = " \t\n\x0b\f\r"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


_RUN = "line binary, documents long"


class Run(NamedTuple):
    first: int
    last: int
    path: str

    @property
    def batches(self) -> int:
        return self.last - self.first + 1


def lines_of(text: str) -> Column:
    """The lines of a text; null and empty are one empty line."""
    return F.split(text_of(text), "\n", -1)


def line_key(line: Column) -> Column:
    """The line without blanks at its ends, A to Z in lower case."""
    bare = F.trim(line, F.lit(_BLANK))
    # Letters beyond ASCII keep their case.
    return F.when(F.octet_length(bare) == F.char_length(bare), F.lower(bare)).otherwise(
        F.translate(bare, _UPPER, _UPPER.lower())
    )


def line_hash(line: Column, chars: int = CHARS) -> Column:
    """128 bits of the key's SHA-256; null for a key of fewer than `chars` code points, which never counts."""
    key = line_key(line)
    digest = F.unhex(F.substring(F.sha2(key.cast("binary"), 256), 1, 32))
    return F.when(F.char_length(key) >= chars, digest)


class LineRuns:
    """A store of runs below `path`, a folder that all executors share.

    `documents` is the number of documents from which on a line is frequent, and
    belongs to the store: with 1, a line is known from its first document on. All
    its runs have `buckets` buckets, some for each two million lines to come. One
    writer at a time. `close` forgets the tables that this session has opened;
    the files stay and another session goes on with them.
    """

    def __init__(self, spark: SparkSession, path: str, documents: int = DOCUMENTS, fan_out: int = FAN_OUT, buckets: int = LEAST_BUCKETS) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self.documents, self.fan_out, self.buckets = documents, fan_out, buckets
        self._name = "line_runs_" + hashlib.md5(self.path.encode()).hexdigest()[:16]
        self._opened: set[str] = set()

    def runs(self) -> list[Run]:
        """The complete runs, without those within a longer one, in the order of their batches."""
        found = []
        for marker in _files(self.spark, f"{self.path}/run-*/_SUCCESS"):
            folder = marker.rsplit("/", 1)[0]
            first, last, _buckets = map(int, folder.rsplit("/run-", 1)[1].split("-"))
            found.append(Run(first, last, folder))
        within = lambda a, b: a != b and b.first <= a.first and a.last <= b.last
        return sorted(run for run in found if not any(within(run, other) for other in found))

    def add(self, hashes: DataFrame) -> None:
        """Add a batch: `line`, one row for each document and each distinct hash of its lines; nulls do not count."""
        runs = self.runs()
        buckets = int(runs[0].path.rsplit("-", 1)[1]) if runs else self.buckets
        counts = hashes.filter("line is not null").groupBy("line").agg(F.count("*").alias("documents"))
        counts = counts.repartition(buckets, "line")
        for run in runs:
            known = self._table(run).filter(F.col("documents") >= self.documents).select("line")
            counts = counts.join(known.hint("merge"), "line", "left_anti")
        number = runs[-1].last + 1 if runs else 0
        self._write(counts, number, number, buckets)
        self._compact()

    def frequent(self) -> DataFrame:
        """`line`: the hashes of lines in at least `documents` documents of all batches."""
        return self._merged(self.runs()).filter(F.col("documents") >= self.documents).select("line")

    def close(self) -> None:
        for name in self._opened:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self._opened.clear()

    def _compact(self) -> None:
        """Fold the last runs into one while there are `fan_out` of one length side by side."""
        while True:
            runs = self.runs()[-self.fan_out :]
            if len(runs) < self.fan_out or len({run.batches for run in runs}) > 1:
                break
            buckets = int(runs[0].path.rsplit("-", 1)[1])
            self._write(self._merged(runs).repartition(buckets, "line"), runs[0].first, runs[-1].last, buckets)
        self._clear()

    def _clear(self) -> None:
        """Delete what the complete runs make superfluous."""
        wanted = {run.path for run in self.runs()}
        for folder in directories(self.spark, f"{self.path}/run-*"):
            if folder not in wanted:
                self.spark.sql(f"DROP TABLE IF EXISTS {self._table_name(folder)}")
                remove(self.spark, folder)

    def _merged(self, runs: list[Run]) -> DataFrame:
        if not runs:
            return self.spark.range(0).select(F.lit(b"").alias("line"), F.lit(0).cast("long").alias("documents"))
        # Read as plain files: Spark 4.1 takes a union of bucketed tables as dealt by their key even where it reads them
        # without their buckets, and then merges only within a task.
        rows = reduce(DataFrame.unionByName, (self.spark.read.schema(_RUN).parquet(run.path) for run in runs))
        return rows.groupBy("line").agg(F.sum("documents").alias("documents"))

    def _table_name(self, folder: str) -> str:
        return f"{self._name}_{folder.rsplit('/run-', 1)[1].replace('-', '_')}"

    def _table(self, run: Run) -> DataFrame:
        name = self._table_name(run.path)
        if name not in self._opened:
            buckets = run.path.rsplit("-", 1)[1]
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {name} (line BINARY, documents BIGINT) USING parquet "
                f"CLUSTERED BY (line) SORTED BY (line) INTO {buckets} BUCKETS LOCATION '{run.path}'"
            )
            self._opened.add(name)
        return self.spark.table(name)

    def _write(self, rows: DataFrame, first: int, last: int, buckets: int) -> None:
        """`rows` are dealt by hash into as many partitions as there are buckets, so each bucket is one file."""
        folder = f"{self.path}/run-{first:09d}-{last:09d}-{buckets}"
        name = self._table_name(folder)
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        remove(self.spark, folder)  # what a crash left
        writer = rows.select("line", "documents").write.bucketBy(buckets, "line").sortBy("line")
        # Hashes do not compress.
        writer.option("compression", "uncompressed").option("path", folder).saveAsTable(name)
        self._opened.add(name)


def _files(spark: SparkSession, pattern: str) -> list[str]:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    return [status.getPath().toString() for status in found or []]


def _text_key(doc_id: str, text: str) -> list[Column]:
    """Equal for rows of one id and text; what is dropped depends on the text alone, the id only deals copies out."""
    return [
        F.xxhash64(F.col(doc_id)).alias("_id_hash"),
        F.unhex(F.substring(F.sha2(text_of(text).cast("binary"), 256), 1, 32)).alias("_text_hash"),
    ]


def hashed_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", chars: int = CHARS, batches: int = 1) -> DataFrame:
    """`_id_hash, _text_hash, lines, _batch`: the hash of each line of each row, written.

    Rows are dealt into batches by id and text, so copies, and the lines they
    share, are in all batches alike; a batch is a directory of its own.
    """
    hashes = F.transform(lines_of(text), lambda line: line_hash(line, chars)).alias("lines")
    rows = docs.select(*_text_key(doc_id, text), hashes)
    rows = rows.withColumn("_batch", F.pmod(F.xxhash64("_id_hash", "_text_hash"), F.lit(batches)).cast("int"))
    path = scratch_path(docs.sparkSession, "line-hashes")
    rows.write.partitionBy("_batch").option("compression", "uncompressed").parquet(path)
    return docs.sparkSession.read.schema(rows.schema).parquet(path)


def document_lines(hashed: DataFrame) -> DataFrame:
    """`line`: what `LineRuns.add` takes; a line that a document repeats is one row."""
    return hashed.select(F.explode(F.array_distinct("lines")).alias("line"))


def dropped_places(hashed: DataFrame, frequent: DataFrame) -> DataFrame:
    """`_id_hash, _text_hash, dropped`: the places of the frequent lines of each text that has any.

    Most lines that are not frequent are left out before anything is shuffled.
    Lines that are then each more than a thousandth of what is left, a thousand
    at most, are broadcast; the others are joined, none weighing more than that.
    """
    frequent = written(frequent, "frequent-lines")
    lines = hashed.select("_id_hash", "_text_hash", F.posexplode("lines").alias("place", "line")).filter("line is not null")
    hits = written(filtered(lines, F.col("line"), frequent, F.col("line")), "line-hits")
    total = hits.count()
    often = written(hits.groupBy("line").count().filter(F.col("count") * OFTEN > total).select("line"), "hot-lines")
    hot = hits.join(F.broadcast(often.join(frequent, "line", "left_semi")), "line", "left_semi")
    rest = hits.join(F.broadcast(often), "line", "left_anti").join(frequent, "line", "left_semi")
    found = hot.unionByName(rest).groupBy("_id_hash", "_text_hash")
    return written(found.agg(F.collect_set("place").alias("dropped")), "dropped-lines")


def drop_lines(docs: DataFrame, dropped: DataFrame, doc_id: str = "doc_id", text: str = "text", prefix: str = "") -> DataFrame:
    """`docs` without the lines in `dropped`, and with `n_lines`, their number before, and `n_dropped`.

    The lines that stay are joined by line feeds as they were; a text that loses
    all is empty, and so is a null text, which is one empty line. `prefix` stands
    before the two names; columns of `docs` that have them already are replaced.
    """
    counted = {f"{prefix}n_lines".lower(), f"{prefix}n_dropped".lower()}
    if {doc_id.lower(), text.lower()} & counted:
        raise ValueError(f"{doc_id} and {text} cannot be replaced; choose a prefix")
    names = [c for c in docs.columns if c.lower() not in counted]
    row = F.struct(*(F.col(f"`{c}`") for c in names)).alias("_row")
    rows = docs.select(row, *_text_key(doc_id, text)).join(dropped, ["_id_hash", "_text_hash"], "left")
    lines = F.split(F.coalesce(F.col(f"_row.`{text}`"), F.lit("")), "\n", -1)
    n = F.size(lines)
    # By places and not by line, so that equal lines that stay are all kept.
    places = F.array_except(F.sequence(F.lit(0), n - 1), F.col("dropped"))
    kept = F.array_join(F.transform(places, lambda place: F.get(lines, place)), "\n")
    content = F.when(F.col("dropped").isNull(), F.coalesce(F.col(f"_row.`{text}`"), F.lit(""))).otherwise(kept)
    return rows.select(
        *(content.alias(c) if c.lower() == text.lower() else F.col(f"_row.`{c}`").alias(c) for c in names),
        n.cast("long").alias(f"{prefix}n_lines"),
        F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias(f"{prefix}n_dropped"),
    )


def line_dedup(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    documents: int = DOCUMENTS,
    chars: int = CHARS,
    batches: int = BATCHES,
    store: str | None = None,
    prefix: str = "",
) -> DataFrame:
    """`docs` without the lines that at least `documents` rows share, as `drop_lines` returns it.

    Lines are equal when their keys are: without blanks at the ends, A to Z in
    lower case. A key of fewer than `chars` code points never counts. Every row is
    a document, also one without an id and one that repeats another. The rows are
    dealt into `batches` by their text, and each is added to the runs in `store`,
    a fresh folder below `spark.checkpoint.dir` unless given; lines that earlier
    calls have added to a given store count as well. Other columns stay as they
    are. No rows in, no rows out.
    """
    spark = docs.sparkSession
    hashed = hashed_lines(docs, doc_id, text, chars, batches)
    lines = hashed.agg(F.sum(F.size("lines"))).first()[0] or 0
    buckets = max(LEAST_BUCKETS, lines // LINES_PER_BUCKET)
    runs = LineRuns(spark, store or scratch_path(spark, "line-runs"), documents, buckets=buckets)
    try:
        for number in range(batches):
            runs.add(document_lines(hashed.filter(F.col("_batch") == number)))
        dropped = dropped_places(hashed, runs.frequent())
    finally:
        runs.close()
    return drop_lines(docs, dropped, doc_id, text, prefix)
