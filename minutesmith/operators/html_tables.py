"""Tables of cells to typed rows: picking tables, header roles, label and value pairs, stitched rows, links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pick_by_header(tables: Column, words: list[str]) -> Column:
    """A page's first table whose first row holds every word, null without one."""

    def holds(t: Column) -> Column:
        head, ok = F.array_join(F.transform(t["rows"][0], lambda c: c["text"]), " "), F.lit(True)
        for w in words:
            ok = ok & head.contains(w)
        return ok

    return F.get(F.filter(tables, holds), 0)


def cells_of(table: Column) -> Column:
    """All cells of a table, row by row."""
    return F.array_compact(F.flatten(table["rows"]))


def pick_by_caption(cells: DataFrame, suffix: str) -> DataFrame:
    """The cells of tables whose caption ends in ``suffix``; what stands before it becomes ``category``."""
    return cells.where(F.col("caption").endswith(suffix)).withColumn("category", F.regexp_replace("caption", f"{suffix}$", ""))


def header_roles(cells: DataFrame, key: str, roles: dict[str, str], needed: list[str] | None = None) -> DataFrame:
    """One row for each body row, one column for each role; a header has the first role whose word it holds.

    Of several headers of one role the last one counts. A table without a header for each of ``needed`` gives an error.
    """
    role = F.coalesce(*[F.when(F.col("text").contains(w), F.lit(r)) for w, r in roles.items()])
    head = cells.where("row_no = 0").withColumn("role", role).where("role IS NOT NULL").groupBy(key, "table_no", "role").agg(F.max("col_no").alias("col_no"))
    if needed:
        have = head.groupBy(key, "table_no").agg(F.collect_set("role").alias("roles"))
        lacks = F.size(F.array_except(F.array(*map(F.lit, needed)), F.col("roles"))) > 0
        whole = have.select(key, "table_no", F.when(lacks, F.raise_error(F.concat(F.lit("no header for all of: "), F.lit(", ".join(needed))))).cast("string").alias("_error"))
        head = head.join(whole, [key, "table_no"]).where("_error IS NULL").drop("_error")
    body = cells.where("row_no > 0").join(head, [key, "table_no", "col_no"])
    return body.groupBy(key, "table_no", "row_no").pivot("role", sorted(set(roles.values()))).agg(F.first(F.nullif("text", F.lit(""))))


def role_rows(tables: DataFrame, roles: dict[str, str]) -> DataFrame:
    """One row for each body row of ``tables`` (a row each, with the cells in ``rows``) that has a cell below a header with a
    role: ``row_no``, the row's cells as ``cells``, and one column for each role, in place of ``rows``.

    As in ``header_roles``: a header has the first role whose word it holds, of several headers of one role the last one counts.
    """
    rest, names = [c for c in tables.columns if c != "rows"], sorted(set(roles.values()))
    role = lambda c: F.coalesce(*[F.when(c["text"].contains(w), F.lit(r)) for w, r in roles.items()])
    head = F.transform(F.get("rows", 0), role)
    x = tables.select(*rest, F.slice("rows", 2, F.size("rows")).alias("rows"), head.alias("_head"))
    last = lambda n: F.array_max(F.transform("_head", lambda r, i: F.when(r == n, i)))
    x = x.select(*rest, "rows", F.struct(*[last(n).alias(n) for n in names]).alias("_at")).select(*rest, "_at", F.posexplode("rows").alias("row_no", "cells"))
    cell = lambda n: F.get("cells", F.col("_at")[n])
    found = F.lit(False)
    for n in names:
        found = found | cell(n).isNotNull()
    return x.where(found).select(*rest, (F.col("row_no") + 1).alias("row_no"), "cells", *[F.nullif(cell(n)["text"], F.lit("")).alias(n) for n in names])


def rows_of(cells: DataFrame, key: str, least: int) -> DataFrame:
    """cell: the texts of each row that has at least ``least`` cells, in column order."""
    x = cells.groupBy(key, "table_no", "row_no").agg(F.array_sort(F.collect_list(F.struct("col_no", "text"))).alias("c"))
    return x.where(F.size("c") >= least).withColumn("cell", F.transform("c", lambda y: y["text"])).drop("c")


def label_values(cells: DataFrame, key: str, labels: list[str], skip: list[str]) -> DataFrame:
    """One row a page, one column a label: a row's first cell is the label, the others joined its value; the last one counts."""
    x = rows_of(cells, key, 2).withColumn("label", F.col("cell")[0]).where(~F.col("label").isin(skip))
    x = x.withColumn("value", F.array_join(F.slice("cell", 2, F.size("cell")), " "))
    return x.groupBy(key).pivot("label", labels).agg(F.max_by("value", F.struct("table_no", "row_no")))


def stitch(rows: DataFrame, key: str, starts: Column, height: int = 3) -> DataFrame:
    """record: the cells of ``height`` rows that make one record, found greedily: after a record comes the row below it.

    ``starts`` tells on (key, row_no, cell) whether a row may begin one.
    """
    t = rows.withColumn("ok", starts).groupBy(key).agg(F.array_sort(F.collect_list(F.struct("row_no", "ok", "cell"))).alias("r"))
    none = F.struct(F.lit(0).alias("next"), F.expr("cast(array() as array<int>)").alias("at"))

    def step(acc, i):
        fits = (i >= acc["next"]) & (i + height <= F.size("r")) & F.element_at("r", i + 1)["ok"]
        return F.when(fits, F.struct((i + height).alias("next"), F.array_append(acc["at"], i).alias("at"))).otherwise(acc)

    at = F.aggregate(F.sequence(F.lit(0), F.size("r") - 1), none, step, lambda a: a["at"])
    return t.select(key, F.posexplode(F.transform(at, lambda i: F.transform(F.slice("r", i + 1, height), lambda y: y["cell"]))).alias("record_no", "record"))


def first_link(hrefs: Column, pattern: str = "") -> Column:
    """The first link that holds ``pattern``, null without one."""
    return F.try_element_at(F.filter(hrefs, lambda x: x.contains(pattern)), F.lit(1))


def absolute(url: Column, base: Column) -> Column:
    """A link resolved against the page's url: with a scheme, from the host or the root, below the page's folder, or folders up."""
    root = F.regexp_extract(base, "^([a-z]+://[^/?#]+)", 1)
    page = F.regexp_replace(base, "[?#].*$", "")
    folders = F.filter(F.split(F.regexp_extract(page, "^[a-z]+://[^/]+/(.*)/[^/]*$", 1), "/"), lambda x: x != "")
    plain = F.regexp_replace(url, r"^(\./)+", "")
    up = F.length(F.regexp_extract(plain, r"^((?:\.\./)*)", 1)) / 3
    kept = F.slice(folders, F.lit(1), F.greatest(F.size(folders) - up.cast("int"), F.lit(0)))
    below = F.array_join(F.concat(F.array(root), kept, F.array(F.regexp_replace(plain, r"^(\.\./)+", ""))), "/")
    return (
        F.when(url.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), url)
        .when(url.startswith("//"), F.concat(F.regexp_extract(base, "^[a-z]+:", 0), url))
        .when(url.startswith("/"), F.concat(root, url))
        .when(url == "", base)
        .when(url.startswith("#"), F.concat(F.regexp_replace(base, "#.*$", ""), url))
        .when(url.startswith("?"), F.concat(page, url))
        .when(url.isNotNull(), below)
    )


def zip_longest(df: DataFrame, key: str, left: str, right: str) -> DataFrame:
    """Names and parties in pairs, the shorter list filled with nulls; pairs without a name go."""
    return df.select(key, F.posexplode(F.arrays_zip(left, right)).alias("pos", "x")).select(key, "pos", "x.*").where(F.coalesce(F.col(left), F.lit("")) != "")


def presenters(text: Column) -> Column:
    """struct(number, name) of every line `受理番号 N番 name` or `N号 name`."""
    p = "(?:受理番号 *)?([0-9０-９]+)[番号] *(.+?)君?$"
    rows = F.filter(F.split(text, "\n"), lambda x: x.rlike(p))
    return F.transform(rows, lambda x: F.struct(F.translate(F.regexp_extract(x, p, 1), "０１２３４５６７８９", "0123456789").try_cast("int").alias("number"), F.trim(F.regexp_extract(x, p, 2)).alias("name")))


def compact_lines(text: Column) -> Column:
    """Trimmed lines; runs of blank ones become one, and those at both ends go."""
    lines = F.transform(F.split(text, "\r?\n"), lambda x: F.trim(x))
    return F.regexp_replace(F.regexp_replace(F.array_join(lines, "\n"), "\n{3,}", "\n\n"), "^\n+|\n+$", "")


def filled_lines(text: Column) -> Column:
    """Trimmed lines without blank ones; a text of blank lines is one blank line."""
    lines = F.transform(F.split(text, "\r?\n"), lambda x: F.trim(x))
    return F.array_join(F.filter(lines, lambda x: x != ""), "\n")
