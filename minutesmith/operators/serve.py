"""Lists, pages, searches and grouped views."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import person_key

PAGE, MOST = 100, 1000


def page(df: DataFrame, order: list[Column], offset: int = 0, limit: int = PAGE) -> DataFrame:
    return df.orderBy(*order).offset(max(0, offset)).limit(min(limit, MOST))


def with_total(part: DataFrame, whole: DataFrame) -> DataFrame:
    """A page with the number of all rows it is from."""
    return part.withColumn("total", F.lit(whole.count()))


def people_page(df: DataFrame, key: str, total: str | None = None, offset: int = 0, limit: int = 20) -> DataFrame:
    """People by key, or by their number of relations and then the key."""
    return df.orderBy(*([total] if total else []), key).offset(max(0, offset)).limit(min(limit, 100))


def search_hits(df: DataFrame, term: str, key: str, variants: str) -> DataFrame:
    """Rows whose key or a variant holds the term."""
    return df.where(F.col(key).contains(term) | F.exists(variants, lambda v: v.contains(term)))


def search(df: DataFrame, term: str, key: str, variants: str, offset: int = 0, limit: int = 20) -> DataFrame:
    """A page of the hits: the exact key first, then in key order."""
    return search_hits(df, term, key, variants).orderBy(F.when(F.col(key) == term, 0).otherwise(1), key).offset(offset).limit(min(limit, 100))


def first_seen_groups(df: DataFrame, group: Column, order: str, default: str, **counts: Column) -> DataFrame:
    """label, n, first, and how many rows meet each of ``counts``, in the order in which labels are first seen; missing and
    empty ones are ``default``."""
    label = F.coalesce(F.nullif(group.cast("string"), F.lit("")), F.lit(default)).alias("label")
    return df.groupBy(label).agg(F.count("*").alias("n"), F.min(order).alias("first"), *[F.count_if(c).alias(n) for n, c in counts.items()]).orderBy("first")


def top_groups(df: DataFrame, group: Column, order: str, k: int, default: str, **counts: Column) -> DataFrame:
    """The ``k`` labels with most rows, ties as first seen."""
    return first_seen_groups(df, group, order, default, **counts).orderBy(F.desc("n"), "first").limit(k)


def two_level(df: DataFrame, outer: Column, inner: Column, order: str) -> DataFrame:
    return df.groupBy(outer.alias("section"), inner.alias("role")).agg(F.count("*").alias("n"), F.min(order).alias("first"))


def group_by_session(df: DataFrame, keys: list[str], session: str, order: str, item: str) -> DataFrame:
    """keys, session, items (in ``order``): the newest session first, rows without a session last."""
    items = F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(item).alias("x")))), lambda p: p["x"])
    return df.groupBy(*keys, session).agg(items.alias("items")).orderBy(*keys, F.desc_nulls_last(session))


def lookup(df: DataFrame, key: str, value: str | int) -> DataFrame:
    """The rows of one key; none where it is absent."""
    return df.where(F.col(key) == value)


def details_of(index: DataFrame, details: DataFrame, ident: str, key: str | None = None, value: str | None = None) -> DataFrame:
    """The index's rows (or those of one key) with their details."""
    return (index if key is None else lookup(index, key, value)).join(details, ident)


def named_groups(df: DataFrame, outer: str, inner: list[str], name: str, order: str, default_outer: str, default_inner: str) -> DataFrame:
    """section, role, names, n, rank: people of each role of each section in first-seen order; missing ones get the defaults.

    ``rank`` orders sections, and roles inside them, by where they are first seen.
    """
    outer_, role = F.coalesce(F.col(outer), F.lit(default_outer)), F.concat_ws(" ", *inner)
    role = F.when(role == "", default_inner).otherwise(role)
    names = F.transform(F.array_sort(F.collect_list(F.struct(order, name))), lambda x: x[name])
    x = df.groupBy(outer_.alias("section"), role.alias("role")).agg(names.alias("names"), F.count("*").alias("n"), F.min(order).alias("first"))
    top = x.groupBy("section").agg(F.min("first").alias("section_first"))
    return x.join(top, "section").orderBy("section_first", "first")


def labelled_groups(df: DataFrame, group: Column, order: str, default: str, **counts: Column) -> DataFrame:
    """label, n, first, and how many rows meet each of ``counts``; missing labels are ``default``; most rows first, ties as first seen."""
    label = F.coalesce(F.nullif(group, F.lit("")), F.lit(default)).alias("label")
    return df.groupBy(label).agg(F.count("*").alias("n"), F.min(order).alias("first"), *[F.count_if(c).alias(n) for n, c in counts.items()]).orderBy(F.desc("n"), "first")


def meeting_overview(df: DataFrame, house: str, day: str) -> DataFrame:
    """house, n, latest: meetings and the last day of each house, and of all (house null)."""
    return df.rollup(house).agg(F.count("*").alias("n"), F.max(day).alias("latest"))


def newest_meetings(df: DataFrame, *by: str) -> DataFrame:
    """The latest first by all of ``by``; missing values count as empty texts."""
    return df.orderBy(*[F.coalesce(F.col(c).cast("string"), F.lit("")).desc() for c in by])


def dataset_meta(parts: dict[str, DataFrame], session: str, built: str) -> DataFrame:
    """dataset, built_at (the latest), sessions (sorted), n: one row for each dataset."""
    rows = [p.select(F.lit(n).alias("dataset"), F.col(session).cast("int").alias("session"), F.col(built).cast("timestamp").alias("built")) for n, p in parts.items()]
    return reduce(DataFrame.unionByName, rows).groupBy("dataset").agg(F.max("built").alias("built_at"), F.array_sort(F.collect_set("session")).alias("sessions"), F.count("*").alias("n"))


def first_distinct(df: DataFrame, value: str, order: str) -> DataFrame:
    """Distinct values in the order in which they are first seen."""
    return df.groupBy(value).agg(F.min(order).alias("first")).orderBy("first")


def availability(sets: dict[str, DataFrame], on: str, counted: tuple[str, ...] = (), base: DataFrame | None = None) -> DataFrame:
    """One row for each value of ``on`` in any set (or, with ``base``, for each of its own), with a flag for each set and the
    number of rows (null without any) of those ``counted``: one union and one grouping, no joins."""
    parts = None
    for name, df in (sets if base is None else sets | {"_base": base}).items():
        p = df.select(on).groupBy(on).agg(F.count("*").alias("_n")).withColumn("_set", F.lit(name))
        parts = p if parts is None else parts.unionByName(p)
    flags = [F.max(F.col("_set") == name).alias(f"has_{name}") for name in sets]
    counts = [F.sum(F.when(F.col("_set") == name, F.col("_n"))).alias(f"n_{name}") for name in counted]
    if base is None:
        return parts.groupBy(on).agg(*flags, *counts)
    return parts.groupBy(on).agg(*flags, *counts, F.max(F.col("_set") == "_base").alias("_in")).where("_in").drop("_in")


#: Fixed value: the speaker of a meeting's information record.
INFORMATION = "会議録情報"


def speaker_summary(df: DataFrame, meeting: str, speaker: str, order: str, carried: tuple[str, ...] = ()) -> DataFrame:
    """One row for each meeting and person key: the name as first seen, speeches, the first place, and the first value of each
    of ``carried`` (roles, positions) that is filled; the information record is no speaker."""
    key = person_key(F.col(speaker))
    first = [F.min_by(c, F.when(F.length(c) > 0, F.col(order))).alias(c) for c in carried]
    spoken = df.where((F.col(speaker) != INFORMATION) & (key != ""))
    return spoken.groupBy(meeting, key.alias("person_key")).agg(F.min_by(speaker, order).alias("name"), F.count("*").alias("n"), F.min(order).alias("first"), *first)
