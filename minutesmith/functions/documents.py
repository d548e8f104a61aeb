"""Expressions over document pages: classes, page metadata, question and answer bodies, keys and addresses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import blank_to_null, bound, era_date, lookup, normalize_text, person_key, slug

# Addresses of question lists; sessions up to 147 are in the older series.
QUESTION_LIST = "https://www.shugiin.go.jp/internet/%s.nsf/html/shitsumon/kaiji%03d_l.htm"
OLDER_SERIES, NEWER_SERIES, LAST_OLDER_SESSION = "itdb_shitsumona", "itdb_shitsumon", 147
BILL_LIST = "https://www.shugiin.go.jp/internet/itdb_gian.nsf/html/gian/kaiji%d.htm"
# The upper house's lists of questions and petitions.
UPPER_LIST = "https://www.sangiin.go.jp/japanese/joho1/kousei/%s/%d/%s.htm"
UPPER_KINDS, UPPER_FILES = {"questions": "syuisyo", "petitions": "seigan"}, {"questions": "syuisyo", "petitions": "seigan"}
# Labels of role codes.
ROLE_LABELS = {"submitter": "提出者", "supporter": "賛成者", "presenter": "紹介議員", "answerer": "答弁者"}


def _found(text: Column, pattern: str, group: int = 1) -> Column:
    """The group's text, null where the pattern isn't found."""
    return blank_to_null(F.regexp_extract(text, pattern, group))


# What tells a document's class in its label, the class, and the title it gets.
CLASSES = [("%提出時法律案%", "original_bill", "提出時法律案"), ("%要綱%", "outline", "要綱"), ("修正案%", "amendment", None)]
# Labels on a bill's text page, and what ends the last value.
PAGE_LABELS, PAGE_END = ["提出回次", "議案種類", "議案名"], "照会できる情報の一覧"


def classify_document(label: Column) -> Column:
    """struct(type, title, note): what stands in parentheses at the end is the note; the first class whose test fits counts.

    An amendment's title ends at a colon; other documents keep their own.
    """
    t = normalize_text(label)
    at = F.when(t.endswith(")"), F.instr(t, "(")).otherwise(0)
    note = F.when(at > 0, F.substring(t, at + 1, F.length(t) - at - 1))
    base = F.trim(F.when(note != "", F.substring(t, F.lit(1), at - 1)).otherwise(t))
    fits = F.filter(F.array(*[F.struct(F.lit(like).alias("like"), F.lit(kind).alias("type"), F.lit(title).cast("string").alias("title")) for like, kind, title in CLASSES]), lambda x: F.like(base, x["like"]))
    first = F.try_element_at(fits, F.lit(1))
    return F.struct(F.coalesce(first["type"], F.lit("other")).alias("type"), F.coalesce(first["title"], blank_to_null(F.substring_index(base, "：", 1))).alias("title"), blank_to_null(note).alias("note"))


def labelled_values(text: Column, labels: list[str], end: str) -> Column:
    """Map of the first value that follows each label and a colon, up to the next label or ``end``."""
    parts = F.split(F.regexp_replace(text, f"({'|'.join(labels)})\\s*[:：]|{end}", "\n$1\t"), "\n")
    pairs = F.transform(F.filter(parts, lambda x: F.instr(x, "\t") > 1), lambda x: F.struct(F.substring_index(x, "\t", 1).alias("label"), normalize_text(F.substring_index(x, "\t", -1)).alias("value")))
    return F.map_from_entries(F.filter(F.transform(F.array(*map(F.lit, labels)), lambda k: F.struct(k.alias("label"), F.try_element_at(F.filter(pairs, lambda p: p["label"] == k), F.lit(1))["value"].alias("value"))), lambda p: p["value"].isNotNull()))


def text_meta(text: Column) -> Column:
    """struct(session, type, number, title) of a bill's text page; parts that aren't found are null."""

    def read(v):
        words = F.split(F.try_element_at(v, F.lit("議案種類")), " ")
        number = F.try_element_at(words, F.lit(2))
        return F.struct(
            F.try_element_at(F.split(F.try_element_at(v, F.lit("提出回次")), " "), F.lit(1)).alias("session"),
            blank_to_null(words[0]).alias("type"),
            F.when(number.rlike("^[0-9]+号$"), number).alias("number"),
            blank_to_null(F.try_element_at(v, F.lit("議案名"))).alias("title"),
        )

    return bound(labelled_values(text, PAGE_LABELS, PAGE_END), read)


def _from_line(lines: Column, at: Column) -> Column:
    return blank_to_null(F.array_join(F.slice(lines, F.coalesce(at, F.lit(0)) + 1, F.greatest(F.size(lines), F.lit(0))), "\n"))


def _ends(lines: Column, ending: str) -> Column:
    """The positions of lines that end so, null for the others."""
    return F.transform(lines, lambda x, i: F.when(x.endswith(ending), i))


def _first(lines: Column, pattern: str) -> Column:
    return F.try_element_at(F.filter(lines, lambda x: x.rlike(pattern)), F.lit(1))


def question_document(text: Column) -> Column:
    """struct(date, body): the body starts at the last line that ends in 質問主意書, else at the first line."""
    lines = F.split(text, "\n")
    return F.struct(era_date(_first(lines, "(令和|平成|昭和).*日$")).alias("date"), _from_line(lines, F.array_max(_ends(lines, "質問主意書"))).alias("body"))


def answer_document(text: Column) -> Column:
    """struct(date, answerer, body): the body starts at the first line that ends in 答弁書, else at the first line."""
    lines = F.split(text, "\n")
    who = F.regexp_replace(_first(lines, "^内閣総理大臣"), "^内閣総理大臣", "")
    return F.struct(
        era_date(_first(lines, "(令和|平成|昭和).*日$")).alias("date"),
        blank_to_null(normalize_text(who)).alias("answerer"),
        _from_line(lines, F.array_min(_ends(lines, "答弁書"))).alias("body"),
    )


def url_key(url: Column, known: dict[str, str] | None = None) -> Column:
    """A document's file key: the slugs of the last folder and of the file name without its ending."""
    parts = F.filter(F.split(F.try_parse_url(url, F.lit("PATH")), "/"), lambda x: x != "")
    stem = F.regexp_replace(F.try_element_at(parts, F.lit(-1)), r"(?<=.)\.[^.]+$", "")
    return F.concat(slug(F.coalesce(F.try_element_at(parts, F.lit(-2)), F.lit("document")), known or {}), F.lit("_"), slug(F.coalesce(stem, F.lit("item")), known or {}), F.lit(".html"))


def section_slug(label: Column) -> Column:
    """An anchor: ASCII letters and digits, kana and kanji; the rest as hyphens; `section` where nothing is left."""
    words = F.split(person_key(label), "[^0-9A-Za-z\\p{IsHiragana}\\p{IsKatakana}\\p{IsHan}]+")
    return F.coalesce(blank_to_null(F.lower(F.array_join(F.filter(words, lambda x: x != ""), "-"))), F.lit("section"))


def label_of(code: Column, labels: dict[str, str]) -> Column:
    """A code's label; unknown codes pass through."""
    return F.coalesce(F.try_element_at(lookup(labels), code), code)


def question_list_url(session: Column) -> Column:
    s = session.cast("int")
    return F.format_string(QUESTION_LIST, F.when(s <= LAST_OLDER_SESSION, OLDER_SERIES).otherwise(NEWER_SERIES), s)


def upper_list_url(kind: str, session: Column) -> Column:
    """Address of the upper house's list of ``kind``."""
    return F.format_string(UPPER_LIST, F.lit(UPPER_KINDS[kind]), session.cast("int"), F.lit(UPPER_FILES[kind]))


def bill_list_url(session: Column) -> Column:
    return F.format_string(BILL_LIST, session.cast("int"))
