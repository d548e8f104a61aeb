"""Which targets a run reads, fetches, reuses and publishes: all as joins of target tables, no loop."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_sessions(df: DataFrame, session: str = "session", n: int = 2) -> DataFrame:
    """The latest ``n`` sessions."""
    return df.select(session).where(F.col(session).isNotNull()).distinct().orderBy(F.desc(session)).limit(n)


def targets(known: DataFrame, session: str = "session", wanted: list[int] | None = None, everything: bool = False, n: int = 2) -> DataFrame:
    """The sessions of a run: an explicit list (those that are known), all, or the latest ``n``."""
    if wanted is not None:
        return known.select(session).where(F.col(session).isin(wanted)).distinct()
    return known.select(session).distinct() if everything else latest_sessions(known, session, n)


def restrict(details: DataFrame, sessions: DataFrame, session: str = "session") -> DataFrame:
    """The details of target sessions only: a semi join, which prunes partitions where ``details`` has any by session."""
    return details.join(sessions.select(session).distinct(), session, "left_semi")


def _meet(df: DataFrame, other: DataFrame, on: list[str], how: str) -> DataFrame:
    """Semi or anti join in which null equals null: a dataset that isn't kept by house has none in its targets."""
    keys = other.select(*[F.col(c).alias(f"_{c}") for c in on]).distinct()
    return df.join(keys, reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in on]), how)


def to_publish(wanted: DataFrame, done: DataFrame, failed: DataFrame, on: list[str], force: bool = False, parse_only: bool = False, stored: DataFrame | None = None) -> DataFrame:
    """Targets to publish: what is there stays unless a run is forced or only parses; a failed target is held back, the others
    go on. With ``stored``, only targets whose sources are stored: a run that only parses has nothing else to read."""
    left = wanted if force or parse_only else _meet(wanted, done, on, "left_anti")
    left = left if stored is None else _meet(left, stored, on, "left_semi")
    return _meet(left, failed, on, "left_anti")


def index_if_sound(index: DataFrame, failed: DataFrame) -> DataFrame:
    """The people index, or no rows of it while any target has failed: the published one then stays."""
    sound = failed.agg(F.count("*").alias("_failures"))
    return index.join(F.broadcast(sound), F.col("_failures") == 0).drop("_failures")


def finished(details: DataFrame, pages: DataFrame, key: str, kind: str, kinds: list[str], answered: Column) -> DataFrame:
    """Keys that are answered and have a page of every kind: they are not fetched again."""
    whole = pages.where(F.col(kind).isin(kinds)).groupBy(key).agg(F.count_distinct(kind).alias("n")).where(F.col("n") == len(kinds)).select(key)
    return details.where(answered).select(key).distinct().join(whole, key, "left_semi")


def fetch_plan(rows: DataFrame, key: str, urls: dict[str, str], stored: DataFrame) -> DataFrame:
    """key, kind, url of every page still to fetch: the url columns as rows, without nulls and without pages already stored."""
    entries = F.array(*[F.struct(F.lit(kind).alias("kind"), F.col(c).alias("url")) for c, kind in urls.items()])
    plan = rows.select(key, F.explode(entries).alias("x")).select(key, "x.*").where("url IS NOT NULL")
    return plan.join(stored.select(key, "kind").distinct(), [key, "kind"], "left_anti")


def reuse(wanted: DataFrame, pages: DataFrame, order: str, content: str, url: str = "url") -> DataFrame:
    """``wanted`` with the content of the first stored page of its url, null where it has to be fetched."""
    first = pages.where(F.col(content).isNotNull()).groupBy(url).agg(F.min_by(content, order).alias(content), F.min(order).alias("stored_as"))
    return wanted.join(first, url, "left")


def outer_assemble(rows: DataFrame, key: str, parts: dict[str, DataFrame]) -> DataFrame:
    """List rows with their pages of each kind, every one optional: one struct column a kind, null without a page."""
    packed = [p.select(key, F.struct(*[c for c in p.columns if c != key]).alias(n)) for n, p in parts.items()]
    return reduce(lambda a, b: a.join(b, key, "left"), packed, rows)
