"""Nested JSON records by a strict schema: aliases renamed at any depth, unknown fields and wrong values named.

A schema is a list of ``Field``s, and a field may be a list of records with a schema of its own. A record comes as a variant,
so that nothing of it is lost before it is checked: ``project`` gives its typed columns, and in ``_faults`` every field that
is missing, unknown or of a wrong kind, with its path. A record with a fault anywhere is unfit as a whole; the others stay.
Everything is one expression over the variant: no Python worker, no shuffle, one pass.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TEXT = "array<string>"


@dataclass(frozen=True)
class Field:
    """``kind``: int, string, date, timestamp, url, or records (a list of records of the schema ``of``)."""

    name: str
    kind: str = "string"
    alias: str | None = None
    required: bool = False
    of: tuple[Field, ...] = ()

    @property
    def names(self) -> list[str]:
        return list(dict.fromkeys([self.alias or self.name, self.name]))


def read_pages(spark: SparkSession, path: str, whole: bool = True) -> DataFrame:
    """path, page (a variant; null where the text is no JSON): one row a file, or (not ``whole``) one a line."""
    rows = spark.read.text(path, wholetext=whole, recursiveFileLookup=True)
    return rows.select(F.col("_metadata.file_path").alias("path"), F.try_parse_json("value").alias("page"))


def _typed(v: Column, kind: str) -> Column:
    """The value as its Spark type; null where it isn't of the kind (whole numbers may come as text)."""
    is_text = F.schema_of_variant(v) == "STRING"
    text = F.when(is_text, F.try_variant_get(v, "$", "string"))
    if kind == "int":
        number = F.try_variant_get(v, "$", "double")
        return F.when(number == F.floor(number), F.try_variant_get(v, "$", "int"))
    if kind == "date":
        return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), text.try_cast("date"))
    if kind == "timestamp":
        return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}"), text.try_cast("timestamp"))
    if kind == "url":
        return F.when(F.try_parse_url(text, F.lit("PROTOCOL")).isin("http", "https") & F.try_parse_url(text, F.lit("HOST")).isNotNull(), text)
    return text


MEMBERS = "map<string,variant>"


def _each(kids: Column, fields: tuple[Field, ...], at: str) -> Column:
    return F.transform(F.transform(kids, lambda x: F.try_variant_get(x, "$", MEMBERS)), lambda m: project(m, fields, at))


def project(members: Column, fields: tuple[Field, ...] | list[Field], at: str = "") -> Column:
    """struct of the fields by their own names, and ``_faults``: `path: missing`, `path: unknown` or `path: <kind>`.

    ``members``: the record as a map of variants, null if it is no record.
    """
    known = [n for f in fields for n in f.names]
    faults = [
        F.when(members.isNull(), F.array(F.lit(f"{at or '.'}: record"))),
        F.transform(F.array_except(F.map_keys(members), F.array(*map(F.lit, known))), lambda k: F.concat(F.lit(at), k, F.lit(": unknown"))),
    ]
    out = []
    for f in fields:
        raw = F.coalesce(*[F.try_element_at(members, F.lit(n)) for n in f.names])
        filled = raw.isNotNull() & ~F.is_variant_null(raw)
        if f.required:
            faults.append(F.when(members.isNotNull() & ~F.coalesce(filled, F.lit(False)), F.array(F.lit(f"{at}{f.name}: missing"))))
        if f.kind == "records":
            kids = F.try_variant_get(raw, "$", "array<variant>")
            read = _each(kids, f.of, f"{at}{f.name}[].")
            out.append(F.coalesce(F.transform(read, lambda x: x.dropFields("_faults")), F.expr("array()")).alias(f.name))
            faults += [F.when(raw.isNotNull() & kids.isNull(), F.array(F.lit(f"{at}{f.name}: records"))), F.flatten(F.transform(read, lambda x: x["_faults"]))]
        else:
            value = F.when(filled, _typed(raw, f.kind))
            out.append(value.alias(f.name))
            faults.append(F.when(filled & value.isNull(), F.array(F.lit(f"{at}{f.name}: {f.kind}"))))
    none = F.array().cast(TEXT)
    return F.struct(*out, F.array_distinct(F.concat(*[F.coalesce(x, none) for x in faults])).alias("_faults"))


def scan(pages: DataFrame, items: str, fields: tuple[Field, ...] | list[Field]) -> DataFrame:
    """path, pos, record, faults: one row for each entry of the list ``items`` of every page; a page that is no JSON or has
    a list of another kind gives one row with pos and record null."""
    kids = F.try_variant_get("page", f"$.{items}", "array<variant>")
    missing = F.col("page").isNotNull() & F.try_variant_get("page", f"$.{items}", "variant").isNull()
    rows = pages.select("path", F.when(F.col("page").isNull(), "page: json").when(kids.isNull() & ~missing, f"page.{items}: records").alias("bad"), F.posexplode_outer(kids).alias("pos", "v")).where("pos IS NOT NULL OR bad IS NOT NULL")
    rows = rows.select("path", "pos", "bad", F.try_variant_get("v", "$", MEMBERS).alias("members"))
    rows = rows.select("path", "pos", "bad", F.when(F.col("pos").isNotNull(), project(F.col("members"), fields)).alias("r"))
    return rows.select("path", "pos", F.col("r").dropFields("_faults").alias("record"), F.coalesce(F.col("r._faults"), F.array("bad")).alias("faults"))


def fit(scanned: DataFrame) -> DataFrame:
    """The columns of the records without faults, behind path and pos."""
    return scanned.where(F.size("faults") == 0).select("path", "pos", "record.*")


def unfit(scanned: DataFrame) -> DataFrame:
    """path, pos, reason: one row for each fault."""
    return scanned.select("path", "pos", F.explode("faults").alias("reason"))
