"""Entity history, canonical rows, nesting, the people index and detail assembly."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import person_id


def history(df: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """key, first, last, n, history: distinct (order, value) of each key in order."""
    return df.groupBy(key).agg(F.array_sort(F.collect_set(F.struct(order, value))).alias("history")).withColumn("n", F.size("history"))


def latest(df: DataFrame, key: str, order: list[str], where: Column | None = None) -> DataFrame:
    """The whole row of each key that comes last in ``order``, of those that meet ``where``."""
    rows = df if where is None else df.where(where)
    return rows.groupBy(key).agg(F.max_by(F.struct(*[c for c in df.columns if c != key]), F.struct(*order)).alias("x")).select(key, "x.*")


def first_filled(df: DataFrame, key: str, order: str, value: str) -> DataFrame:
    return df.where(F.col(value).isNotNull()).groupBy(key).agg(F.min_by(value, order).alias(value))


def mode_first(df: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """The most frequent value of each key; ties go to the one seen first."""
    counts = df.groupBy(key, value).agg(F.count("*").alias("n"), F.min(order).alias("first"))
    return counts.groupBy(key).agg(F.max_by(value, F.struct("n", -F.col("first"))).alias(value))


def nest(df: DataFrame, key: str, fields: list[str], name: str) -> DataFrame:
    """Children as one sorted array of structs; the first field orders them."""
    return df.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(*fields))).alias(name))


def exists_flag(df: DataFrame, keys: DataFrame, on: list[str], name: str) -> DataFrame:
    return df.join(keys.select(*on).distinct().withColumn(name, F.lit(True)), on, "left").withColumn(name, F.coalesce(name, F.lit(False)))


def relations(parts: list[DataFrame]) -> DataFrame:
    """One long table of relations; absent columns become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def entity_index(rel: DataFrame, types: list[str]) -> DataFrame:
    """person_key, detail_id (its sha256), names, one count for each relation type, total: two shuffles, of relations and of
    what is left of them.

    Relations are distinct by (person_key, type, entity_id); names are the sorted distinct variants.
    """
    once = rel.groupBy("person_key", "type", "entity_id").agg(F.collect_set("name").alias("names"))
    counts = [F.count_if(F.col("type") == t).alias(f"n_{t}") for t in types]
    index = once.groupBy("person_key").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("names")))).alias("names"), *counts, F.count("*").alias("total"))
    return index.select("person_key", person_id(F.col("person_key")).alias("detail_id"), *[c for c in index.columns if c != "person_key"])


def entity_relations(rel: DataFrame, types: list[str], natural: list[str], order: list[str]) -> DataFrame:
    """person_key and an array for each relation type: relations distinct by ``natural``, sorted by ``order``.

    Of relations with the same natural key the largest stays.
    """
    keys = ["person_key", "type", *natural]
    rest = [c for c in rel.columns if c not in keys]
    once = rel.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("_rest")).select(*keys, "_rest.*") if rest else rel.dropDuplicates()
    fields = [*order, *(c for c in rel.columns if c not in ("person_key", "type", *order))]
    return once.groupBy("person_key").agg(*[F.array_sort(F.collect_list(F.when(F.col("type") == t, F.struct(*fields)))).alias(t) for t in types])


def assemble(rows: DataFrame, pages: DataFrame, key: str, policy: str) -> DataFrame:
    """List rows with their pages: 'inner' skips rows without one, 'left' keeps them, 'misses' keeps those alone, and 'strict'
    fails on the first of them, naming its key, in the very job that reads the rows."""
    if policy != "strict":
        return rows.join(pages, key, {"inner": "inner", "left": "left", "misses": "left_anti"}[policy])
    found = rows.join(pages.withColumn("_page", F.lit(True)), key, "left")
    miss = F.raise_error(F.concat(F.lit(f"no page for {key} "), F.coalesce(F.col(key).cast("string"), F.lit("null"))))
    return found.where(F.when(F.col("_page").isNull(), miss).otherwise(F.lit(True))).drop("_page")


def pending(wanted: DataFrame, done: DataFrame, failed: DataFrame, on: list[str]) -> DataFrame:
    """Targets that are neither published nor blocked by a failure."""
    return wanted.join(done, on, "left_anti").join(failed, on, "left_anti")
