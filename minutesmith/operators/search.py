"""Substring search by a table of grams, and deep pages by ranges: both written once and read in part.

The gram table holds (gram, key, hay, pos) for every place of every text: the two characters that begin there (one at a
text's end). A term is in a text exactly if its grams stand at consecutive places, so hits need no look at the texts. Rows are
ordered by gram, so that a read with a term's grams skips all other row groups; a gram that most texts hold is spread over
many rows and files, never one list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

GRAM = 2


def grams(text: Column) -> Column:
    """The gram at each place of a text."""
    at = F.when(F.length(text) > 0, F.sequence(F.lit(0), F.length(text) - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.substring(text, i + 1, F.lit(GRAM)))


def write_grams(df: DataFrame, path: str, key: str, variants: str | None = None) -> None:
    """The gram table of each row's key (a string) and variants."""
    hays = F.array(F.col(key)) if variants is None else F.array_distinct(F.concat(F.array(F.col(key)), F.coalesce(variants, F.array().cast("array<string>"))))
    rows = df.select(F.col(key).alias("key"), F.posexplode(F.filter(hays, lambda h: h.isNotNull())).alias("hay", "text"))
    rows = rows.select("key", "hay", F.posexplode(grams(F.col("text"))).alias("pos", "gram"))
    rows.select("gram", "key", "hay", "pos").repartitionByRange("gram", "key").sortWithinPartitions("gram", "key", "hay", "pos").write.mode("overwrite").parquet(path)


def gram_hits(spark: SparkSession, path: str, term: str) -> DataFrame:
    """key: the distinct keys of rows whose key or a variant holds the term; an empty term has none."""
    rows, term = spark.read.parquet(path), term.strip()
    if len(term) < GRAM:  # every place begins a gram, so one character is a gram's beginning
        return rows.where(F.col("gram").startswith(term) if term else F.lit(False)).select("key").distinct()
    parts = [term[i : i + GRAM] for i in range(len(term) - GRAM + 1)]
    places = F.array(*[F.struct(F.lit(g).alias("g"), F.lit(i).alias("i")) for i, g in enumerate(parts)])
    # a gram may stand at several places of the term
    found = rows.where(F.col("gram").isin(parts)).select("key", "hay", "pos", F.explode(F.filter(places, lambda p: p["g"] == F.col("gram"))["i"]).alias("i"))
    whole = found.groupBy("key", "hay", (F.col("pos") - F.col("i")).alias("start")).agg(F.count("*").alias("n")).where(F.col("n") == len(parts))
    return whole.select("key").distinct()


def gram_search(spark: SparkSession, path: str, term: str, offset: int = 0, limit: int = 20) -> DataFrame:
    """A page of the hits: the exact key first, then in key order."""
    return gram_hits(spark, path, term).orderBy(F.when(F.col("key") == term.strip(), 0).otherwise(1), "key").offset(offset).limit(min(limit, 100))


def write_pages(df: DataFrame, path: str, order: list[Column], ranges: int) -> None:
    """``df`` in ``ranges`` ranges of ``order``, each row with its place in its range, and the rows before each range."""
    x = df.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    x = x.withColumns({"_range": F.spark_partition_id(), "_idx": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))})
    x.write.mode("overwrite").partitionBy("_range").parquet(f"{path}/rows")
    x.limit(0).drop("_range").coalesce(1).write.mode("overwrite").parquet(f"{path}/schema")  # an empty table has no other file
    n = _page_rows(df.sparkSession, path).groupBy("_range").agg(F.count("*").alias("n"))
    upto = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, 0)  # over one row a range
    n.select("_range", "n", (F.sum("n").over(upto) - F.col("n")).alias("_before"), F.sum("n").over(Window.partitionBy()).alias("total")).coalesce(1).write.mode("overwrite").parquet(f"{path}/ranges")


def _page_rows(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(spark.read.parquet(f"{path}/schema").schema.add("_range", IntegerType())).parquet(f"{path}/rows")


def read_page(spark: SparkSession, path: str, offset: int = 0, limit: int = 100) -> DataFrame:
    """The rows of a page in order, with ``place`` (from 0) and ``total``: only ranges that the page touches are read."""
    first, last = max(0, offset), max(0, offset) + min(limit, 1000)
    ranges = spark.read.parquet(f"{path}/ranges").where((F.col("_before") < last) & (F.col("_before") + F.col("n") > first)).drop("n")
    place = F.col("_before") + F.col("_idx")
    rows = _page_rows(spark, path).join(F.broadcast(ranges), "_range").withColumn("place", place)
    return rows.where(F.col("place").between(first, last - 1)).drop("_range", "_idx", "_before").coalesce(1).sortWithinPartitions("place")
