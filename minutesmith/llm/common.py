"""Helpers shared by the training-data operators: table access, scratch tables, ASCII folding."""

from __future__ import annotations

import ctypes
import tempfile
import uuid

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: DuckDB SQL: crc32 of decimal digits, step by step over their bytes.
CRC_SQL = "xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({x}, ''), lambda c: ascii(c)::BIGINT)), lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda r, z: xor(r >> 1, (r & 1) * 3988292384))), 4294967295)"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``; a fresh temporary one only where it is unset (tests)."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = "file://" + tempfile.mkdtemp(prefix="minutesmith-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root


class Scratch:
    """Tables written to the shared folder: they cut lineage and survive lost executors.

    ``drop`` deletes the ones that no returned plan reads any more; the others go when the application ends.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.root, self.paths = spark, f"{scratch_dir(spark)}/minutesmith-{uuid.uuid4().hex}", {}
        p = spark._jvm.org.apache.hadoop.fs.Path(self.root)
        fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
        fs.mkdirs(p)
        fs.deleteOnExit(p)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.option("compression", "zstd").parquet(path)
        self.paths[name] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        jvm = self.spark._jvm
        for name in names:
            p = jvm.org.apache.hadoop.fs.Path(self.paths.pop(name))
            p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)


def ranked(s: Scratch, df: DataFrame, group: list[str], order: list[str], what: str) -> DataFrame:
    """``df`` with ``idx``, each row's place (from 0) in its group by ``order`` (nulls first), and ``n``, the group's rows.

    Rows are dealt out by ranges of group and order, so that a group with a third of all rows is spread over many tasks. A
    place is the one inside its range plus the group's rows in earlier ranges; only counts by range meet by group. Group
    columns hold no nulls; ``df`` has no columns ``_at``, ``_tie``, ``idx`` and ``n``.
    """
    keys = [F.col(c).asc_nulls_first() for c in [*group, *order]]
    df = s.keep(df, f"{what}_rows")  # read twice, for the ranges' bounds and for the rows
    rows = df.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*keys, "_tie").sortWithinPartitions(*keys, "_tie")
    rows = s.keep(rows.drop("_tie").withColumn("_at", F.monotonically_increasing_id()), what)
    s.drop(f"{what}_rows")
    part, all_parts = F.shiftright("_at", 33), Window.partitionBy(*group)
    spans = rows.groupBy(*group, part.alias("_part")).agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    spans = spans.select(
        *group,
        "_part",
        "_first",
        (F.sum("_rows").over(all_parts.orderBy("_part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_rows")).alias("_before"),
        F.sum("_rows").over(all_parts).alias("n"),
    )
    return rows.withColumn("_part", part).join(spans, [*group, "_part"]).withColumn("idx", F.col("_at") - F.col("_first") + F.col("_before")).drop("_at", "_part", "_first", "_before")


def small_batches(spark: SparkSession, mb: int = 2) -> None:
    """Bound the bytes of an Arrow batch: texts may be long, and a batch is held in a task's memory.

    Plans read the setting when they run, after a query has returned, so it stays set for the session; it never changes a
    result.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(mb << 20))


_HELD: dict = {}


def lean(owner: str = "") -> dict:
    """Called as a task of an operator begins: what other operators keep in this worker process goes, and freed memory
    is handed back, for workers live on through all stages of a job. Returns what ``owner`` keeps between its tasks."""
    for name in [k for k in _HELD if k != owner]:
        del _HELD[name]
    pa.default_memory_pool().release_unused()
    if hasattr(ctypes.CDLL(None), "malloc_trim"):
        ctypes.CDLL(None).malloc_trim(0)
    return _HELD.setdefault(owner, {}) if owner else {}


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only, as the contracts ask (``lower`` would fold other letters as well)."""
    return F.translate(c, UPPER, UPPER.lower())


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` is called so."""
    while name.lower() in {c.lower() for c in df.columns}:
        name = "_" + name
    return name


def maybe_in(keys: DataFrame, bits: int = 1 << 24):
    """A test on 64-bit columns: true for every value in the one column of ``keys``, and for few others.

    It is a bitmap of fixed size that tasks fill chunk by chunk, so it may be sent to all tasks whatever ``keys`` holds.
    Returns the test and the broadcast, which the caller destroys once the rows are written.
    """
    import numpy as np

    chunk = 1 << 16

    def pack(t: pa.Table) -> pa.Table:
        x = np.zeros(chunk, np.uint8)
        x[t.column("bit").to_numpy() % chunk] = 1
        return pa.table({"chunk": t.column("chunk")[:1], "bits": pa.array([np.packbits(x).tobytes()], pa.binary())})

    place = F.pmod(F.xxhash64(F.col(keys.columns[0])), F.lit(bits))
    rows = keys.select(place.alias("bit")).distinct().withColumn("chunk", F.floor(F.col("bit") / chunk)).groupBy("chunk").applyInArrow(pack, "chunk long, bits binary").collect()
    held = np.zeros((bits // chunk, chunk // 8), np.uint8)
    for r in rows:
        held[r["chunk"]] = np.frombuffer(r["bits"], np.uint8)
    sent = keys.sparkSession.sparkContext.broadcast(held.ravel())

    @F.pandas_udf("boolean")
    def test(bit: pd.Series) -> pd.Series:
        b = bit.to_numpy()
        return pd.Series((sent.value[b >> 3] >> (7 - (b & 7)).astype(np.uint8)) & 1 == 1)

    return (lambda c: test(F.pmod(F.xxhash64(c), F.lit(bits)))), sent
