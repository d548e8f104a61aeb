"""The scalar functions for users of ``spark.sql``: temporary SQL functions with the same expressions.

A function's body is the text of its column expression, so both give the same plan, without a Python worker. The text names
operators like functions, which SQL takes in backquotes.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from . import documents as D
from . import minutes as M
from . import text as T

#: Name: parameters and their types, and the expression.
FUNCTIONS: dict[str, tuple[dict[str, str], Callable[..., Column]]] = {
    "normalize_text": ({"s": "string"}, T.normalize_text),
    "agenda_prefix": ({"s": "string"}, T.agenda_prefix),
    "bill_title_key": ({"s": "string"}, T.bill_title_key),
    "petition_title_key": ({"s": "string"}, T.petition_title_key),
    "person_key": ({"s": "string"}, T.person_key),
    "person_id": ({"s": "string"}, T.person_id),
    "indexable_name": ({"s": "string"}, T.indexable_name),
    "clean_names": ({"names": "array<string>"}, T.clean_names),
    "name_and_count": ({"s": "string"}, T.name_and_count),
    "name_and_role": ({"s": "string"}, M.name_and_role),
    "first_int": ({"s": "string"}, T.parse_int),
    "kanji_number": ({"s": "string"}, T.kanji_number),
    "era_date": ({"s": "string"}, T.era_date),
    "month_day_near": ({"s": "string", "reference": "date"}, T.month_day_near),
    "month_day_default": ({"s": "string", "y": "int"}, T.month_day_default),
    "clock_time": ({"s": "string"}, T.clock_time),
    "date_and_text": ({"s": "string"}, T.date_and_text),
    "split_list": ({"s": "string"}, T.split_list),
    "number_and_type": ({"s": "string"}, T.number_and_type),
    "closing_note": ({"s": "string"}, T.closing_note),
    "session_of_id": ({"id": "string"}, T.session_of_id),
    "bill_id": ({"category": "string", "session": "int", "number": "int", "title": "string", "subcategory": "string"}, T.bill_id),
    "label_slug": ({"s": "string"}, lambda s: T.slug(s, T.LABELS)),
    "section_slug": ({"s": "string"}, D.section_slug),
    "document_key": ({"url": "string"}, D.url_key),
    "document_class": ({"s": "string"}, D.classify_document),
    "text_lines": ({"s": "string"}, M.lines_of),
}
OPERATORS = re.compile(r"('(?:[^'\\]|\\.)*')|(?<![\w`])(<=>|>=|<=|<>|[=<>+*/%!-]|and|or|not|rlike|like)\(", re.IGNORECASE)


def text_of(c: Column) -> str:
    """A column expression as SQL."""
    shown = str(c).removeprefix("Column<'").removesuffix("'>")
    return OPERATORS.sub(lambda m: m[1] or f"`{m[2]}`(", shown)


def register(spark: SparkSession, prefix: str = "") -> list[str]:
    """Make every function known to ``spark.sql`` of this session, under its name behind ``prefix``; returns the names."""
    for name, (params, f) in FUNCTIONS.items():
        body = f(*[F.col(p) for p in params])
        one = spark.createDataFrame([], ", ".join(f"{p} {t}" for p, t in params.items()))
        kind = one.select(body.alias("x")).schema["x"].dataType.simpleString()
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{name}({', '.join(f'{p} {t.upper()}' for p, t in params.items())}) RETURNS {kind} RETURN {text_of(body)}")
    return [prefix + n for n in FUNCTIONS]
