"""Incremental ingest: new files of a folder are appended once, or merged into the sessions they touch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import publish


def ingest(spark: SparkSession, source: str, schema: str, target: str, checkpoint: str, key: str, event_time: str, late: str = "1 day") -> None:
    """Append the rows of files not seen before, without repeats of ``key`` inside the watermark, then stop."""
    rows: DataFrame = spark.readStream.schema(schema).parquet(source)
    fresh = rows.withWatermark(event_time, late).dropDuplicatesWithinWatermark([key])
    q = fresh.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


def latest_rows(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Of rows with the same keys the one with the largest ``order`` (ties: the largest row), whatever order they come in."""
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.max(F.struct(order, *[c for c in rest if c != order])).alias("_x")).select(*keys, "_x.*").select(*rows.columns)


def merge_batch(batch: DataFrame, batch_id: int, target: str, marks: str, keys: list[str], session: str, order: str, whole: bool = False) -> bool:
    """Publish a batch: the sessions that it touches are written anew, all others stay. False if it was published before.

    The rows of a touched session are those published and those of the batch, the latest of each key (``whole``: a batch
    brings whole lists, and of a session only the latest list stays). Merging twice gives the same rows, so a batch that
    comes again after a failure half-way does no harm; once it is done, a mark by its id in ``marks`` keeps it from being
    merged again.
    """
    spark = batch.sparkSession
    jvm = spark._jvm
    mark = jvm.org.apache.hadoop.fs.Path(f"{marks}/{batch_id}")
    table = jvm.org.apache.hadoop.fs.Path(target)
    fs = mark.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(mark):
        return False
    batch = batch.persist()  # read for its sessions and for its rows
    try:
        rows = batch
        if fs.exists(table):
            # sessions are few and read from the batch; the join prunes partitions when it runs
            touched = batch.select(session).distinct()
            old = spark.read.schema(batch.schema).parquet(target).join(touched, session, "left_semi")
            rows = old.select(*batch.columns).unionByName(batch)
        if whole:
            last = rows.groupBy(session).agg(F.max(order).alias(order))
            rows = rows.join(last, [session, order], "left_semi").select(*batch.columns)
        publish(latest_rows(rows, [session, *keys], order), target, [session])
    finally:
        batch.unpersist()
    fs.create(mark).close()
    return True


def publish_stream(spark: SparkSession, source: str, schema: str, target: str, checkpoint: str, keys: list[str], session: str, order: str, whole: bool = False) -> None:
    """Merge the files of ``source`` not seen before into ``target``, partitioned by session, then stop."""
    rows = spark.readStream.schema(schema).parquet(source)
    q = rows.writeStream.foreachBatch(lambda df, i: merge_batch(df, i, target, f"{checkpoint}/merged", keys, session, order, whole)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
