from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lakebars.llm.common import filtered, hashed_share, release, sampled, written


@pytest.mark.parametrize("bits", [1 << 15, 1 << 20])
def test_filter_keeps_every_wanted_row_and_few_others(spark, bits):
    rows = spark.range(20_000).select(F.when(F.col("id") % 50 != 0, F.col("id")).alias("k"), F.lit("x").alias("_bitmapped"))
    wanted = spark.range(0, 20_000, 40).select(F.when(F.col("id") > 0, F.col("id")).alias("w"))
    got = filtered(rows, F.col("k"), wanted, F.col("w"), bits)
    assert got.columns == rows.columns
    keys = [r.k for r in got.collect()]
    assert {k for k in keys if k is not None} >= {k for k in range(0, 20_000, 40) if k % 50}
    assert keys.count(None) == 400  # null is wanted too
    assert len(keys) < 400 + 500 + 20_000 * 500 / bits * 3


def test_filter_with_nothing_wanted(spark):
    rows = spark.range(10)
    assert filtered(rows, F.col("id"), spark.range(0), F.col("id")).count() == 0


def test_samples_are_about_as_large_as_asked(spark):
    rows = spark.range(10_000)
    assert 900 < sampled(rows, ["id"], 1000, 10_000, seed=1).count() < 1100
    assert sampled(rows, ["id"], 10_000, 10_000, seed=1).count() == 10_000
    assert rows.filter(~hashed_share(["id"], 1).between(0, 1)).count() == 0


def test_a_released_table_is_gone(spark):
    table = written(spark.range(5), "test")
    assert table.count() == 5
    release(table)
    with pytest.raises(Exception, match="(?i)exist|found"):
        spark.read.schema(table.schema).parquet(table.inputFiles()[0]).count()
