"""Linking of free text to titles: exact, two-way prefix, with precedence; first title in index order wins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import bill_title_key, petition_title_key


def title_index(titles: DataFrame, key: str, ident: str, title: str, ordinal: str, scope: tuple[str, ...] = ()) -> DataFrame:
    """One row for each key: the id and title that come first in ``ordinal``."""
    first = F.min_by(F.struct(F.col(ident).alias("id"), F.col(title).alias("title")), F.col(ordinal))
    return titles.where(F.length(key) > 0).groupBy(*scope, F.col(key).alias("key")).agg(first.alias("x"), F.min(ordinal).alias("ordinal")).select(*scope, "key", "x.id", "x.title", "ordinal")


def exact_link(keys: DataFrame, index: DataFrame, key: str, scope: tuple[str, ...] = ()) -> DataFrame:
    """Distinct ``keys`` with the id and title of the equal index key."""
    return keys.join(index.withColumnRenamed("key", key), [*scope, key]).select(*scope, key, "id", "title")


def _begins(short: DataFrame, long: DataFrame, key: str, text: str, scope: tuple[str, ...]) -> DataFrame:
    """The rows of ``long`` with the rows of ``short`` whose ``key`` begins their ``text``.

    Texts are cut at the lengths that keys have (no more than the longest key has characters), which a subquery gives in the
    same job, so both sides meet on whole, equal keys.
    """
    lengths = short.agg(F.collect_set(F.length(key))).scalar()
    cut = F.filter("_lengths", lambda n: (n > 0) & (n <= F.length(text)))
    starts = long.withColumn("_lengths", lengths).withColumn(key, F.explode(F.transform(cut, lambda n: F.substring(F.col(text), F.lit(1), n))))
    return starts.drop("_lengths").join(short, [*scope, key])


def prefix_link(keys: DataFrame, index: DataFrame, key: str, scope: tuple[str, ...] = ()) -> DataFrame:
    """Keys that begin a title or that a title begins, with the first such title in index order."""
    titles, texts = index.withColumnRenamed("key", "_title_key"), keys.select(*scope, key).distinct()
    hits = _begins(titles, texts, "_title_key", key, scope).unionByName(_begins(texts, titles, key, "_title_key", scope))
    return hits.groupBy(*scope, key).agg(F.min_by(F.struct("id", "title", "ordinal"), "ordinal").alias("x")).select(*scope, key, "x.*")


def _texts(items: DataFrame, text: str, scope: tuple[str, ...], keys: dict[str, Callable[[Column], Column] | None]) -> DataFrame:
    """Distinct texts with their keys.

    A key depends on the count of its text, which is never 0: so no filter on a key moves below the grouping, where every
    item's text would be normalised instead of every distinct one.
    """
    counted = items.groupBy(*scope, text).agg(F.count("*").alias("_n"))
    return counted.select(*scope, text, *[F.when(F.col("_n") > 0, f(F.col(text)) if f else F.col(text)).alias(k) for k, f in keys.items()])


def title_link(items: DataFrame, index: DataFrame, text: str, normalize: Callable[[Column], Column] | None = None, scope: tuple[str, ...] = ()) -> DataFrame:
    """The items with id, title and kind ('exact', 'prefix' or null).

    Only distinct texts are normalised and linked; the items, of which many may share a text, meet them again. Nothing is
    held: the shuffles of distinct texts and keys are reused by all branches.
    """
    keyed = _texts(items, text, scope, {"_key": normalize}).where(F.length("_key") > 0)
    keys = keyed.select(*scope, "_key").distinct()
    exact = exact_link(keys, index, "_key", scope).withColumn("kind", F.lit("exact"))
    rest = keys.join(exact, [*scope, "_key"], "left_anti")
    found = exact.unionByName(prefix_link(rest, index, "_key", scope).drop("ordinal").withColumn("kind", F.lit("prefix")))
    return items.join(keyed.join(found, [*scope, "_key"]).drop("_key"), [*scope, text], "left")


def precedence_link(items: DataFrame, text: str, bills: DataFrame, petitions: DataFrame, scope: tuple[str, ...] = ()) -> DataFrame:
    """The items with item_type, id, title: an equal bill, else an equal petition, else a bill or else a petition that begins
    the text or that it begins; of several the first in index order. Both indexes are of the item's ``scope`` (its house)."""
    raw = _texts(items, text, scope, {"_bill": bill_title_key, "_petition": petition_title_key})
    out = None
    for p, (kind, index, key, link) in enumerate((("bill", bills, "_bill", exact_link), ("petition", petitions, "_petition", exact_link), ("bill", bills, "_bill", prefix_link), ("petition", petitions, "_petition", prefix_link))):
        keys = raw.select(*scope, key).where(F.length(key) > 0).distinct()
        hit = raw.join(link(keys, index, key, scope).select(*scope, key, "id", "title"), [*scope, key])
        hit = hit.select(*scope, text, F.struct(F.lit(p).alias("priority"), F.lit(kind).alias("item_type"), F.col("id").cast("string").alias("id"), "title").alias("x"))
        out = hit if out is None else out.unionByName(hit)
    best = out.groupBy(*scope, text).agg(F.min_by("x", "x.priority").alias("x"))
    return items.join(best.select(*scope, text, "x.item_type", "x.id", "x.title"), [*scope, text], "left")


def reverse_links(links: DataFrame, target: str, source: str, text: str, order: list[str], day: str) -> DataFrame:
    """target, n, refs: the sources that mention each target, the last mention's text, in order of day and source."""
    last = links.groupBy(target, source).agg(F.max_by(text, F.struct(*order)).alias("text"), F.min(day).alias("day"))
    return last.groupBy(target).agg(F.count("*").alias("n"), F.array_sort(F.collect_list(F.struct("day", source, "text"))).alias("refs"))


def row_rank(df: DataFrame, by: list[str], order: list) -> DataFrame:
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
