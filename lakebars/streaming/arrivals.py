"""The incremental rebuild as a stream over what has landed."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakebars.operators import versions
from lakebars.plans.feeds import Feed
from lakebars.plans.incremental import rebuild_named, rebuild_touched

NO_LIMIT = "36500d"
ENTRY = "partitions array<string>, gone array<string>, same boolean"


def process_arrivals(
    spark: SparkSession, feed: Feed, checkpoint: str, files_per_batch: int | None = None
) -> int:
    """Rebuild every month that got new rows since the last call, then stop; the number of partitions rebuilt.

    Where bronze is written by landings the stream reads the entries of its log,
    one small file a landing, and no file or directory of bronze. Where bronze is
    plain files it reads those: its checkpoint then keeps the name of every file
    seen on the driver. Either reader would forget, and skip, files a week older
    than the newest, so its limit of age is lifted. Each touched month is rebuilt
    from bronze as a whole, which makes a repeated batch harmless.
    """
    rebuilt: list[int] = []
    logged = versions.snapshot(spark, feed.bronze) is not None

    def rebuild(batch: DataFrame, _batch_id: int) -> None:
        if logged:
            names = batch.filter("not same").select(F.explode(F.concat("partitions", "gone")).alias("name")).distinct()
            rebuilt.append(rebuild_named(batch.sparkSession, feed, [row.name for row in names.collect()]))
        else:
            rebuilt.append(rebuild_touched(batch.sparkSession, feed, batch))

    # A file replaced by a later landing may be gone when its batch runs; its replacement is new itself.
    reader = spark.readStream.option("ignoreMissingFiles", "true").option("maxFileAge", NO_LIMIT)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    try:
        if logged:
            arrivals = reader.schema(ENTRY).json(f"{versions.log_of(feed.bronze)}/*/entry.json")
        else:
            arrivals = reader.schema(feed.bronze_schema).parquet(feed.bronze).select(*feed.silver_keys)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0
    query = (
        arrivals.writeStream.foreachBatch(rebuild)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return sum(rebuilt)
