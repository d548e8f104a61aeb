"""Normalisers and parsers of Japanese parliamentary text: Column -> Column, no Python on the rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Eras with the year before their first, numerals, and units.
ERAS = {"明治": 1867, "大正": 1911, "昭和": 1925, "平成": 1988, "令和": 2018}
NUMERALS = {"〇": 0, "零": 0, "一": 1, "二": 2, "三": 3, "四": 4, "五": 5, "六": 6, "七": 7, "八": 8, "九": 9}
UNITS = {"十": 10, "百": 100, "千": 1000}
WIDE, NARROW = "０１２３４５６７８９", "0123456789"
NUMBER = "[0-9０-９〇零一二三四五六七八九十百千元]+"
CATEGORIES = {"衆法": "shu_law", "参法": "san_law", "閣法": "cab_law", "予算": "budget", "承認": "approval", "決算その他": "settlement", "決算": "settlement"}
LABELS = {"決算": "kessan", "国有財産": "kokuyu_zaisan", "国庫債務": "kokko_saimu", "ｎｈｋ決算": "nhk_kessan", "nhk決算": "nhk_kessan"}


def lookup(values: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in values.items() for x in kv])


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def normalize_text(c: Column) -> Column:
    """Runs of any Unicode white space become one space; ends are trimmed."""
    return F.trim(F.regexp_replace(c, r"(?U)[\s ]+", " "))


def without_space(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)[\s ]+", "")


def agenda_prefix(c: Column) -> Column:
    """Leading circles, item numbering and order-of-the-day marks go."""
    n = "[一二三四五六七八九十百千0-9０-９]+"
    c = F.regexp_replace(normalize_text(c), "^○*(?:[一二三四五六七八九十百千]+、)?", "")
    return F.trim(F.regexp_replace(c, f"^日程第{n}(及び第{n})*", ""))


def bill_title_key(c: Column) -> Column:
    """A bill's title without its submission notes, explanation marks and white space."""
    c = F.regexp_replace(agenda_prefix(c), "（[^）]*(提出|衆法|参法|閣法)[^）]*）|（趣旨説明）|（予）", "")
    return without_space(c)


def petition_title_key(c: Column) -> Column:
    c = F.regexp_replace(agenda_prefix(c), "外[〇零一二三四五六七八九十百千0-9０-９]+件の請願$", "請願")
    return without_space(F.regexp_replace(c, "（第[^）]*号[^）]*）", ""))


def strip_honorific(c: Column) -> Column:
    return F.trim(F.regexp_replace(normalize_text(c), "君(?=外)|君$", ""))


def person_key(c: Column) -> Column:
    return without_space(strip_honorific(c))


def clean_names(c: Column) -> Column:
    """The distinct names of an array without honorifics, in first-seen order; blank ones go."""
    return F.array_distinct(F.filter(F.transform(c, strip_honorific), lambda x: x != ""))


def person_id(c: Column) -> Column:
    return F.sha2(F.encode(c, "UTF-8"), 256)


def indexable_name(c: Column) -> Column:
    return (F.length(person_key(c)) > 0) & ~normalize_text(c).rlike("^(その)?補欠として")


def narrow_digits(c: Column) -> Column:
    return F.translate(c, WIDE, NARROW)


def parse_int(c: Column) -> Column:
    """The first run of digits, wide or narrow."""
    return F.regexp_extract(narrow_digits(c), "[0-9]+", 0).try_cast("int")


def kanji_number(c: Column) -> Column:
    """Arabic, positional kanji, unit kanji, or 元; null for anything else, Arabic and kanji mixed among it."""
    t = narrow_digits(normalize_text(c))
    digit = F.translate(t, "".join(NUMERALS), "".join(map(str, NUMERALS.values())))
    zero = F.struct(F.lit(0).alias("sum"), F.lit(0).alias("now"))

    def step(acc, x):
        unit = F.try_element_at(lookup(UNITS), x)
        grown = F.struct((acc["sum"] + F.greatest(acc["now"], F.lit(1)) * unit).alias("sum"), F.lit(0).alias("now"))
        return F.when(unit.isNotNull(), grown).otherwise(F.struct(acc["sum"].alias("sum"), x.try_cast("int").alias("now")))

    units = F.aggregate(F.filter(F.split(digit, ""), lambda x: x != ""), zero, step, lambda a: a["sum"] + a["now"])
    plain = t.rlike("^([0-9]+|[〇零一二三四五六七八九]+)$")
    return F.when(t == "元", 1).when(plain, digit.try_cast("int")).when(t.rlike("^[〇零一二三四五六七八九十百千]+$"), units)


def _date(y: Column, m: Column, d: Column) -> Column:
    year = F.when(y.between(0, 9999), F.lpad(y.cast("string"), 4, "0"))
    return F.concat(year, F.lit("-"), m.cast("string"), F.lit("-"), d.cast("string")).try_cast("date")


def small_numbers(c: Column) -> Column:
    """Text in which kanji numerals below a hundred, and 元, are digits: one pass of replacements, no numeral by numeral reading.

    Where digits stand beside a ten, the numeral is neither, and it stays as it is.
    """
    t = F.regexp_replace(narrow_digits(without_space(c)), "(?<![〇零一二三四五六七八九十百千0-9])元(?=年)", "1")
    t = F.regexp_replace(t, "(?<![0-9〇零一二三四五六七八九十百千])十(?![0-9百千])", "一十")
    t = F.regexp_replace(t, "(?<=[一二三四五六七八九])十(?![0-9〇零一二三四五六七八九十百千])", "〇")
    t = F.regexp_replace(t, "(?<=[一二三四五六七八九])十(?=[一二三四五六七八九])", "")
    return F.translate(t, "".join(NUMERALS), "".join(map(str, NUMERALS.values())))


def bound(c: Column, f) -> Column:
    """f(c), with ``c`` worked out once however often ``f`` uses it."""
    return F.transform(F.array(c), f)[0]


WESTERN = "[0-9]{4}年[0-9]{1,2}月[0-9]{1,2}日"


def era_date(c: Column) -> Column:
    """A western date if there is one, else an era date; null for placeholders and impossible days."""
    plain = narrow_digits(without_space(c))
    east = F.regexp_extract(small_numbers(c), f"({'|'.join(ERAS)})[0-9]+年[0-9]+月[0-9]+日", 0)
    day = lambda m: F.translate(m, "年月日", "--")

    def read(m):
        n = F.substring_index(F.substring(m, 3, 20), "-", 1).try_cast("int")
        year = F.try_element_at(lookup(ERAS), F.substring(m, 1, 2)) + F.when(n.between(0, 7000), n)
        return F.concat(year.cast("string"), F.substring(m, F.instr(m, "-"), F.length(m))).try_cast("date")

    west = day(F.regexp_extract(plain, WESTERN, 0)).try_cast("date")
    return F.when(plain.rlike(WESTERN), west).otherwise(bound(day(east), read))


def _month_day(c: Column) -> Column:
    """[month, day] of the first such pair, [null] without one."""
    m = F.regexp_extract(small_numbers(c), "(?<![0-9])[0-9]{1,2}月[0-9]{1,2}日", 0)
    return F.transform(F.slice(F.split(m, "[月日]"), 1, 2), lambda x: x.try_cast("int"))


def month_day_near(c: Column, reference: Column) -> Column:
    """Month and day in the year nearest to the reference date; ties: the same year, then the one before."""

    def nearest(p):
        days = F.transform(F.array(F.lit(0), F.lit(-1), F.lit(1)), lambda k, i: F.struct(i.alias("o"), _date(F.year(reference) + k, p[0], F.get(p, F.lit(1))).alias("day")))
        options = F.transform(F.filter(days, lambda x: x["day"].isNotNull()), lambda x: F.struct(F.abs(F.datediff(x["day"], reference)).alias("gap"), x["o"], x["day"].alias("day")))
        return F.array_min(options)["day"]

    return bound(_month_day(c), nearest)


def month_day_default(c: Column, year: Column) -> Column:
    """A whole date if there is one, else month and day in the default year; null for impossible days."""
    return F.coalesce(era_date(c), bound(_month_day(c), lambda p: _date(year.cast("int"), p[0], F.get(p, F.lit(1)))))


def clock_time(c: Column) -> Column:
    """HH:MM of noon, or of morning and afternoon hours; afternoon hours from 12 on stand as they are; null out of range."""

    def read(m):
        p = F.transform(F.split(F.substring(m, 3, 20), "[時分]"), lambda x: x.try_cast("int"))
        h, minute = p[0], F.coalesce(F.try_element_at(p, F.lit(2)), F.lit(0))
        hour = F.when(m.startswith("午後") & (h < 12), h + 12).when(m.startswith("午前") & (h == 12), 0).otherwise(h)
        return F.when((hour < 24) & (minute < 60), F.format_string("%02d:%02d", hour, minute))

    found = F.regexp_extract(small_numbers(c), "(午前|午後)[0-9]{1,2}時([0-9]{1,2}分)?", 0)
    return F.when(without_space(c).contains("正午"), F.lit("12:00")).otherwise(bound(found, read))


def name_and_count(c: Column) -> Column:
    """struct(name, total, more) of `X君外N名`."""
    t = without_space(c)
    p = f"^(.+?)君?外({NUMBER})名$"
    more = t.rlike(p)
    return F.struct(F.when(more, F.regexp_extract(t, p, 1)).otherwise(strip_honorific(c)).alias("name"), F.when(more, kanji_number(F.regexp_extract(t, p, 2)) + 1).alias("total"), more.alias("more"))


def slug(c: Column, known: dict[str, str]) -> Column:
    """A known label's slug, else its ASCII letters and digits, else a stable hash."""
    ascii_ = F.regexp_replace(F.regexp_replace(F.lower(normalize_text(c)), "[^a-z0-9]+", "_"), "^_+|_+$", "")
    found = F.try_element_at(lookup(known), normalize_text(c)) if known else F.lit(None).cast("string")
    return F.coalesce(found, blank_to_null(ascii_), F.concat(F.lit("label_"), F.substring(F.sha1(F.encode(normalize_text(c), "UTF-8")), 1, 8)))


def house_id(prefix: str, session: Column, number: Column, width: int = 3) -> Column:
    return F.format_string(f"{prefix}-%d-%0{width}d", session.cast("int"), number.cast("int"))


def bill_id(category: Column, session: Column, number: Column, title: Column, subcategory: Column) -> Column:
    """session-category-number; without a number the subcategory's slug and a hash of the title stand for it."""
    code = F.coalesce(F.try_element_at(lookup(CATEGORIES), category), slug(F.lower(category), LABELS))
    sub = slug(F.lower(F.coalesce(blank_to_null(subcategory), F.lit("unknown"))), LABELS)
    rest = F.concat_ws("-", sub, F.substring(F.sha1(F.encode(normalize_text(title), "UTF-8")), 1, 8))
    return F.concat_ws("-", F.coalesce(session.cast("string"), F.lit("unknown")), code, F.coalesce(number.cast("string"), rest))


def session_of_id(c: Column) -> Column:
    p = F.split(c, "-")
    return F.when(F.size(p) >= 3, F.try_element_at(p, F.lit(2)).try_cast("int"))


def date_and_text(c: Column) -> Column:
    """struct(day, text) of `date ／ text`; a left side that is no date is the text if there is no other."""
    p = F.split(c, "／", 2)
    left, right = normalize_text(F.try_element_at(p, F.lit(1))), blank_to_null(normalize_text(F.try_element_at(p, F.lit(2))))
    day = era_date(left)
    return F.struct(day.alias("day"), F.coalesce(right, F.when(day.isNull(), blank_to_null(left))).alias("text"))


def split_list(c: Column) -> Column:
    return F.filter(F.transform(F.split(c, "[;；]"), normalize_text), lambda x: x != "")


def number_and_type(c: Column) -> Column:
    p = "第([0-9０-９]+)回"
    t = without_space(c)
    return F.struct(F.coalesce(narrow_digits(F.regexp_extract(t, p, 1)).try_cast("int"), parse_int(t)).alias("number"), blank_to_null(F.regexp_extract(t, "（([^）]*)）", 1)).alias("type"))


def closing_note(c: Column) -> Column:
    t = F.regexp_replace(normalize_text(c), f"({'|'.join(ERAS)})? ?{NUMBER}年 ?{NUMBER}月 ?{NUMBER}日", "")
    return blank_to_null(F.trim(F.translate(t, "（）()", "")))
