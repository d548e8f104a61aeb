import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from minutesmith.functions import text as T
from minutesmith.operators import serve

CASES = [
    (T.kanji_number, "二十三", 23), (T.kanji_number, "百", 100), (T.kanji_number, "千二百三十四", 1234), (T.kanji_number, "二〇二四", 2024), (T.kanji_number, "１２", 12),
    (T.kanji_number, "元", 1), (T.kanji_number, "十", 10), (T.kanji_number, "abc", None), (T.kanji_number, "", None),
    (T.era_date, "令和8年2月18日", dt.date(2026, 2, 18)), (T.era_date, "平成元年一月八日", dt.date(1989, 1, 8)), (T.era_date, "昭和二十二年五月二十日", dt.date(1947, 5, 20)),
    (T.era_date, "2024年 3月 1日", dt.date(2024, 3, 1)), (T.era_date, "未定", None), (T.era_date, "令和8年2月30日", None),
    (T.era_date, "令和二一四七四八三六四七年一月一日", None), (T.era_date, "平成二年一月一日（2024年2月30日）", None), (T.era_date, "令和元年5月1日（2024年2月3日）", dt.date(2024, 2, 3)), (T.era_date, "0999年1月2日", dt.date(999, 1, 2)),
    (T.clock_time, "午前十時四分", "10:04"), (T.clock_time, "午後一時三十分", "13:30"), (T.clock_time, "正午", "12:00"), (T.clock_time, "午前十二時", "00:00"), (T.clock_time, "午後二十五時", None),
    (T.person_key, "山田　太郎君", "山田太郎"), (T.agenda_prefix, "○一、日程第二 刑法", "刑法"), (T.bill_title_key, "日程第一 刑法の一部を改正する法律案（内閣提出第三号）（趣旨説明）", "刑法の一部を改正する法律案"),
    (T.agenda_prefix, "十三、刑法", "刑法"), (T.bill_title_key, "趣旨説明聴取の件", "趣旨説明聴取の件"), (T.petition_title_key, "外二件の請願に関する件", "外二件の請願に関する件"),
    (T.kanji_number, "2十", None), (T.kanji_number, "二三十", 30), (T.clock_time, "午後十三時", "13:00"), (T.clock_time, "正午から午後一時", "12:00"), (T.era_date, "平成三十一年四月三十日", dt.date(2019, 4, 30)),
    (T.petition_title_key, "保育に関する外二件の請願", "保育に関する請願"), (T.closing_note, "令和6年10月9日（解散）", "解散"), (T.parse_int, "第２２１回", 221),
]


@pytest.mark.parametrize("f,given,want", CASES)
def test_values(spark, f, given, want):
    assert spark.createDataFrame([(given,)], "x string").select(f(F.col("x"))).first()[0] == want


def test_structs(spark):
    d = spark.createDataFrame([("山田太郎君外一名", "内閣", "令和8年2月18日 ／ 法務委員会", "撤回", "第221回（特別会）")], "a string, b string, c string, d string, e string")
    r = d.select(T.name_and_count(F.col("a")).alias("a"), T.name_and_count(F.col("b")).alias("b"), T.date_and_text(F.col("c")).alias("c"), T.date_and_text(F.col("d")).alias("d"), T.number_and_type(F.col("e")).alias("e")).first()
    assert tuple(r["a"]) == ("山田太郎", 2, True) and tuple(r["b"]) == ("内閣", None, False)
    assert tuple(r["c"]) == (dt.date(2026, 2, 18), "法務委員会") and tuple(r["d"]) == (None, "撤回") and tuple(r["e"]) == (221, "特別会")


def test_near_date(spark):
    d = spark.createDataFrame([("十二月二十八日", dt.date(2026, 1, 20))], "x string, r date")
    assert d.select(T.month_day_near(F.col("x"), F.col("r"))).first()[0] == dt.date(2025, 12, 28)


def test_names_ids_default_year(spark):
    d = spark.createDataFrame([(["山田 太郎君", "", "山田 太郎", None, "鈴木君外一名"], "十二月 十六日", "令和八年二月三日", "二月三十日")], "n array<string>, a string, b string, c string")
    day = [T.month_day_default(F.col(x), F.lit(2024)) for x in "abc"]
    bill = T.bill_id(F.lit("決算"), F.lit(None).cast("int"), F.lit(None).cast("int"), F.lit(" 題 "), F.lit(None).cast("string"))
    r = d.select(T.clean_names(F.col("n")), *day, bill, T.person_id(F.lit("山田"))).first()
    assert tuple(r[:4]) == (["山田 太郎", "鈴木外一名"], dt.date(2024, 12, 16), dt.date(2026, 2, 3), None)
    assert r[4] == "unknown-settlement-unknown-" + hashlib.sha1("題".encode()).hexdigest()[:8] and r[5] == hashlib.sha256("山田".encode()).hexdigest()


def test_sessions_newest_first(spark):
    d = spark.createDataFrame([("p", 1, 1, "a"), ("p", None, 2, "b"), ("p", 3, 4, "d"), ("p", 3, 3, "c")], "k string, s int, o int, x string")
    assert [(r.s, r["items"]) for r in serve.group_by_session(d, ["k"], "s", "o", "x").collect()] == [(3, ["c", "d"]), (1, ["a"]), (None, ["b"])]
