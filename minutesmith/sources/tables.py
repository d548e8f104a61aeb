"""JSON lists and details: read with a schema, split good rows from bad ones, publish by partition."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def sessions(df: DataFrame, column: str = "session") -> DataFrame:
    """The session numbers present, ascending; names that are no integers are left out."""
    s = F.col(column).cast("string").try_cast("int")
    return df.select(s.alias("session")).where("session IS NOT NULL").distinct().orderBy("session")


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Records of multi-line JSON files; a record that doesn't fit keeps its text in ``_bad``."""
    return spark.read.schema(f"{schema}, _bad string").option("multiLine", "true").option("recursiveFileLookup", "true").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_bad").json(path)


PATH_KEYS = ("dataset", "house", "session", "entity")


def read_details(spark: SparkSession, root: str, schema: str, sessions: list[int] | None = None) -> DataFrame:
    """Detail documents below ``root``, with dataset, house, session and entity from the path (`.../221/x.json`, `.../session=221/x.json`).

    Only files of ``sessions`` are opened: the condition is on the path alone, so it is met when files are listed. A document
    that doesn't fit keeps its text in ``_bad``.
    """
    parts = F.reverse(F.split(F.col("_metadata.file_path"), "/"))
    at = lambda i: F.regexp_replace(F.try_element_at(parts, F.lit(i)), "^[A-Za-z_]+=", "")
    files = spark.read.schema(f"{schema}, _bad string").option("multiLine", "true").option("recursiveFileLookup", "true").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_bad").json(root)
    if sessions is not None:
        files = files.where(at(2).isin([str(s) for s in sessions]))
    return files.select(at(4).alias("dataset"), at(3).alias("house"), at(2).try_cast("int").alias("session"), F.regexp_replace(at(1), "[.][^.]*$", "").alias("entity"), *[c for c in files.columns if c not in PATH_KEYS])


def items(df: DataFrame, keys: list[str], column: str = "items") -> DataFrame:
    """The list's entries with their position."""
    return df.select(*keys, F.posexplode(column).alias("pos", "x")).select(*keys, "pos", "x.*")


def valid(required: list[str]) -> Column:
    """Whether every required column is filled."""
    ok = F.lit(True)
    for c in required:
        ok = ok & F.col(c).isNotNull()
    return ok


def quarantine(df: DataFrame, required: list[str]) -> tuple[DataFrame, DataFrame]:
    """(good rows, bad rows)."""
    return df.where(valid(required)), df.where(~valid(required))


def publish(df: DataFrame, path: str, partitions: list[str]) -> None:
    """Overwrite only the partitions that ``df`` holds."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path)


def publish_checked(df: DataFrame, path: str, partitions: list[str], skip: dict[str, Column], stop: dict[str, Column]) -> dict[str, int]:
    """Check and write in one pass. A row that breaks a rule of ``skip`` is left out and counted; the first one that breaks a
    rule of ``stop`` ends the write, which names the rule and the row, and nothing is published.

    Returns the numbers of rows read, written and left out by each rule, as seen by the write itself.
    """
    seen = Observation()
    x = df.withColumn("_fault", first_fault(skip))
    x = x.observe(seen, F.count(F.lit(1)).alias("read"), F.count_if(F.col("_fault") == "").alias("written"), *[F.count_if(F.col("_fault") == name).alias(name) for name in skip])
    row = F.to_json(F.struct(*df.columns))
    fault = first_fault(stop)
    x = x.where("_fault = ''").where(F.when(fault != "", F.raise_error(F.concat(fault, F.lit(": "), row))).otherwise(F.lit(True)))
    publish(x.select(*df.columns), path, partitions)
    return dict(seen.get)


def published_meta(spark: SparkSession, tables: dict[str, str], built: str, house: str = "house", session: str = "session") -> DataFrame:
    """dataset, house, sessions (sorted), n and the latest ``built`` of published tables, without reading a row of them.

    Houses and sessions are partitions; counts and latest values come from the Parquet footers (a numeric or date column), as
    aggregates pushed into the scan, so the work grows with the number of files.
    """
    s = spark.newSession()  # its own settings; the caller's stay
    s.conf.set("spark.sql.sources.useV1SourceList", "")
    s.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    out = None
    for name, path in tables.items():
        by = s.read.parquet(path).groupBy(house, session).agg(F.count("*").alias("n"), F.max(built).alias(built)).select(F.lit(name).alias("dataset"), "*")
        out = by if out is None else out.unionByName(by)
    return out.groupBy("dataset", house).agg(F.array_sort(F.collect_list(session)).alias("sessions"), F.sum("n").alias("n"), F.max(built).alias(built))


def to_json(keep_nulls: bool) -> Column:
    """The row as JSON, with nulls kept or dropped."""
    return F.to_json(F.struct("*"), {"ignoreNullFields": "false" if keep_nulls else "true"})


def read_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Records of JSON lines; a record that doesn't fit keeps its text in ``_bad``."""
    return spark.read.schema(f"{schema}, _bad string").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_bad").json(path)


def publish_details(df: DataFrame, path: str, keep_nulls: bool) -> None:
    """One row an entity: a table with nested columns, and the same as lines of JSON."""
    df.write.mode("overwrite").parquet(f"{path}/table")
    df.write.mode("overwrite").option("ignoreNullFields", "false" if keep_nulls else "true").json(f"{path}/json")


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share (spark.checkpoint.dir); a fresh temporary one only where it is unset, as in tests."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    return root or "file://" + tempfile.mkdtemp(prefix="minutesmith-")


def first_fault(rules: dict[str, Column]) -> Column:
    """The name of the first rule that a row breaks (null counts as broken), an empty text if none: rows with one go to quarantine."""
    return F.coalesce(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()], F.lit(""))


HOUSES = ["shugiin", "sangiin"]


def known_house(c: Column) -> Column:
    return c.isin(HOUSES)


def houses_of(c: Column) -> Column:
    """`all` is both houses, a house itself; anything else has none."""
    return F.when(c == "all", F.array(*map(F.lit, HOUSES))).when(known_house(c), F.array(c)).otherwise(F.expr("cast(array() as array<string>)"))
