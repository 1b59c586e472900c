"""Lines shared by many documents, against counting them in Python; and the store of runs by itself."""

from __future__ import annotations

import os
from collections import Counter

import pytest
from odd_documents import LONG, ODD, nothing, odd  # noqa: F401  fixtures
from pyspark.sql import functions as F

from lakebars.llm.line_runs import LineRuns, document_lines, hashed_lines, line_dedup, line_key
from lakebars.operators.scratch import scratch_path

BLANK = " \t\n\x0b\f\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def key(line):
    return line.strip(BLANK).translate(LOWER)


def brute(texts, documents, chars=1):
    found = Counter(k for text in texts for k in {key(line) for line in (text or "").split("\n")})
    often = {k for k, n in found.items() if n >= documents and len(k) >= chars}
    rows = []
    for text in texts:
        lines = (text or "").split("\n")
        kept = [line for line in lines if key(line) not in often]
        rows.append(("\n".join(kept), len(lines), len(lines) - len(kept)))
    return rows


def check(spark, texts, documents, **options):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.text, r.n_lines, r.n_dropped) for r in line_dedup(docs, documents=documents, **options).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts, documents, options.get("chars", 1))


def test_keys(spark):
    lines = ["", " ", "\x1f x\x1f", "\xa0É A\r", "İ Σ ẞ Z", "\x0b\x0cab\t", "漢 A", " Q"]
    got = spark.createDataFrame([(line,) for line in lines], "line string").select("line", line_key(F.col("line")).alias("k")).collect()
    assert {r.line: r.k for r in got} == {line: key(line) for line in lines}


TEXTS = [
    *(f"Shared line\nown {i}\n\n  SHARED LINE \nown {i}" for i in range(12)),
    *(f"nine times\n{i}" for i in range(9)),
    *("ten times" for _ in range(9)),
    "Ten Times\n\n",
    None,
    "",
    "\n",
    "\n".join(f"line {i % 700}" for i in range(5000)),
    "a\r\nb\r\n",
]


@pytest.mark.parametrize("batches", [1, 2, 7])
def test_against_counting(spark, batches):
    check(spark, TEXTS, 10, batches=batches)


def test_short_keys_and_other_thresholds(spark):
    check(spark, TEXTS, 2, chars=5)
    check(spark, TEXTS, 1)


def test_odd_documents(spark, odd):  # noqa: F811
    found = line_dedup(odd, documents=2)
    assert found.columns == [*odd.columns, "n_lines", "n_dropped"]
    want = [(d.doc_id, *row) for d, row in zip(ODD, brute([d.text for d in ODD], 2), strict=True)]
    got = [(r.doc_id, r.text, r.n_lines, r.n_dropped) for r in found.collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert line_dedup(odd.withColumn("N_Lines", F.lit(1)), documents=2).columns == [*odd.columns, "n_lines", "n_dropped"]


def test_nothing_in_nothing_out(nothing):  # noqa: F811
    assert line_dedup(nothing).collect() == []


def test_a_line_of_a_third_of_all_documents(spark):
    hot = ["Accept all cookies" if i % 3 == 0 else f"row {i % 400}" for i in range(6000)]
    check(spark, [f"{line}\nown {i}" for i, line in enumerate(hot)], 10)


def add(runs, texts):
    docs = runs.spark.createDataFrame([(i, text) for i, text in enumerate(texts)], "doc_id long, text string")
    runs.add(document_lines(hashed_lines(docs)))


def test_runs_are_compacted_by_level(spark):
    runs = LineRuns(spark, scratch_path(spark, "test-runs"), documents=4, fan_out=3)
    seen = []
    for batch in range(10):
        add(runs, ["always", f"batch {batch}", f"pair {batch // 2}"])
        seen.append([run.batches for run in runs.runs()])
    assert seen == [[1], [1, 1], [3], [3, 1], [3, 1, 1], [3, 3], [3, 3, 1], [3, 3, 1, 1], [9], [9, 1]]
    assert runs.frequent().count() == 1
    rows = {run.batches: runs._table(run).count() for run in runs.runs()}
    assert rows == {9: 15, 1: 1 + 1}  # what the long run knows to be frequent is not in the last one
    runs.close()
    # Another session goes on from the files.
    again = LineRuns(spark, runs.path, documents=4, fan_out=3)
    assert [run.batches for run in again.runs()] == [9, 1] and again.frequent().count() == 1
    again.close()


def test_counts_add_up_over_runs_of_all_levels(spark):
    runs = LineRuns(spark, scratch_path(spark, "test-runs"), documents=10, fan_out=3)
    for batch in range(10):
        add(runs, ["once a batch", "in nine" if batch else "other"])
    assert runs.frequent().count() == 1
    runs.close()


def test_half_written_and_superfluous_runs_do_not_count(spark):
    runs = LineRuns(spark, scratch_path(spark, "test-runs"), documents=2, fan_out=4)
    add(runs, ["a", "b"])
    add(runs, ["b", "c"])
    want = sorted(bytes(r.line) for r in runs.frequent().collect())
    whole = runs.runs()
    # A compaction that died before its marker, and one that died before it deleted what it had folded.
    buckets = whole[0].path.rsplit("-", 1)[1]
    half = f"{runs.path}/run-000000000-000000001-{buckets}"
    runs._write(runs._merged(whole), 0, 1, int(buckets))
    os.remove(f"{half.removeprefix('file:')}/_SUCCESS")
    assert runs.runs() == whole
    assert sorted(bytes(r.line) for r in runs.frequent().collect()) == want
    runs._write(runs._merged(whole), 0, 1, int(buckets))
    assert [run.batches for run in runs.runs()] == [2]
    assert sorted(bytes(r.line) for r in runs.frequent().collect()) == want
    add(runs, ["c", "d"])
    assert len(os.listdir(runs.path.removeprefix("file:"))) == 2
    assert runs.frequent().count() == 2
    runs.close()


def test_a_store_counts_over_calls(spark):
    store = scratch_path(spark, "test-store")
    one = spark.createDataFrame([(i, "again") for i in range(6)], "doc_id long, text string")
    assert {r.n_dropped for r in line_dedup(one, store=store).collect()} == {0}
    assert {r.n_dropped for r in line_dedup(one, store=store).collect()} == {1}


@pytest.mark.parametrize("buckets", [4, 8, 32])
def test_joins_leave_the_runs_in_place(spark, buckets):
    runs = LineRuns(spark, scratch_path(spark, "test-runs"), documents=2, buckets=buckets)
    add(runs, ["a", "b"])
    counts = spark.createDataFrame([(b"x", 1)], "line binary, documents long").repartition(buckets, "line")
    plan = counts.join(runs._table(runs.runs()[0]).hint("merge"), "line", "left_anti")._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan ==") :]
    assert "SortMergeJoin" in physical and physical.count("Exchange") == 1
    files = [name for name in os.listdir(runs.runs()[0].path.removeprefix("file:")) if name.startswith("part-")]
    assert len(files) <= buckets
    runs.close()


def test_very_long_texts(spark):
    check(spark, [LONG, LONG + "\nx", "\n".join(["x", LONG] * 3)], 3)
