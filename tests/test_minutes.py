import datetime as dt

from pyspark.sql import functions as F

from minutesmith.operators import minutes as O

DAY = dt.date(2026, 1, 20)


def changes(spark, lines):
    rows = [(1, i, x, DAY) for i, x in enumerate(lines)]
    got = O.changes(spark.createDataFrame(rows, "k int, pos int, line string, day date"), "k", "day").orderBy("pos").collect()
    return [(r["changed_at"], r["resigned"], r["appointed"]) for r in got]


def test_change_dates(spark):
    pair = "  山田 太郎君  田中 花子君"
    a, b = "山田太郎", "田中花子"
    assert changes(spark, ["十二月二十八日", pair, "同月 八日", pair, "同日", pair]) == [(dt.date(2025, 12, 28), a, b), (dt.date(2026, 1, 8), a, b), (dt.date(2026, 1, 8), a, b)]
    assert changes(spark, [pair, "同日", pair, "一月十九日", pair]) == [(None, a, b), (DAY, a, b), (dt.date(2026, 1, 19), a, b)]


def test_changes_of_null_and_empty_lines(spark):
    assert changes(spark, [None, "", "山田 太郎君"]) == []


SAMPLE = """令和八年二月十八日（水曜日）
    午前十時開議
 出席委員
   委員長 山田　太郎君
   理事 鈴木　一郎君 理事 佐藤　花子君
      高橋　次郎君
 国務大臣
   法務大臣 田中　三郎君
――――◇―――――
委員の異動
二月十八日
 辞任 補欠選任
  伊藤　四郎君 渡辺　五郎君
――――◇―――――
本日の会議に付した案件
　刑法の一部を改正する法律案（内閣提出第三号）
　　（趣旨説明）
○請願審査の件
――――◇―――――"""
HELD = dt.date(2026, 2, 18)


def entries(spark, text, **how):
    df = spark.createDataFrame([(1, text, HELD)], "k int, text string, day date")
    got = O.entries(df, "k", "text", F.col("day"), **{"default_role": "委員", "default_section": "出席委員", **how}).collect()
    out = {s: [] for s in ("attendance", "membership", "referred", "agenda")}
    for r in sorted(got, key=lambda r: (r.pos, r.n)):
        out[r.state].append((r.section, r.role, r.title, r.name) if r.state == "attendance" else (r.day, r.name, r.other) if r.state == "membership" else r.name)
    return out


def test_sample(spark):
    lines = O.text_lines(spark.createDataFrame([(1, SAMPLE)], "k int, text string"), "k")
    head = O.first_match(lines, "k").first()
    assert (head.meeting_date, head.opening_line, head.opening_time) == (HELD, "午前十時開議", "10:00")
    assert entries(spark, SAMPLE) == {
        "attendance": [("出席委員", "委員長", None, "山田太郎"), ("出席委員", "理事", None, "鈴木一郎"), ("出席委員", "理事", None, "佐藤花子"), ("出席委員", "委員", None, "高橋次郎"), ("国務大臣", "法務大臣", None, "田中三郎")],
        "membership": [(HELD, "伊藤四郎", "渡辺五郎")],
        "referred": [],
        "agenda": ["刑法の一部を改正する法律案（内閣提出第三号）（趣旨説明）", "請願審査の件"],
    }


def test_upper_house_and_wrapped_roles(spark):
    text = "会議録\n 出席者は左のとおり。\n   委員長 山田　太郎君\n   理　事\n    鈴木　一郎君\n    高橋　次郎君\n  国務大臣\n    内閣府特命\n    担当大臣 田中　三郎君\n    （防災担当） 原　四郎君\n――――◇―――――\n 森　五郎君"
    got = entries(spark, text, default_role=None, default_section=None)
    assert got["attendance"] == [(None, "委員長", None, "山田太郎"), (None, "理事", None, "鈴木一郎"), (None, "理事", None, "高橋次郎"), ("国務大臣", "内閣府特命担当大臣", None, "田中三郎"), ("国務大臣", "国務大臣", "（防災担当）", "原四郎")]


def test_changes_inside_attendance(spark):
    """A day that resignations follow moves on from the attendance; 同日 and 同月 carry its date on."""
    text = " 出席委員\n   委員長 山田　太郎君\n二月十日\n 辞任 補欠選任\n  伊藤　四郎君 渡辺　五郎君\n同日\n  石田　一君 岡　二郎君\n同月十七日\n  井上　三君 江川　四君\n――――"
    a, b = dt.date(2026, 2, 10), dt.date(2026, 2, 17)
    got = entries(spark, text)
    assert got["membership"] == [(a, "伊藤四郎", "渡辺五郎"), (a, "石田一", "岡二郎"), (b, "井上三", "江川四")] and len(got["attendance"]) == 1
    assert entries(spark, text.replace("二月十日", "二月十日付"))["membership"][0][0] is None  # no day above: none is made up


def test_referred(spark):
    text = "会議録\n二月十七日\n　刑法の一部を改正する法律案（内閣提出第三号）\n\n　　及び民法の一部を改正する法律案\n　予算の件\nは本委員会に付託された。\n　あとの話の件\n本日の会議に付した案件\n○請願審査の件\n午後一時開議\n　発言の件"
    got = entries(spark, text)
    assert got["referred"] == ["刑法の一部を改正する法律案（内閣提出第三号）", "及び民法の一部を改正する法律案", "予算の件"] and got["agenda"] == ["請願審査の件"]
    assert entries(spark, text, has_date=F.lit(False))["referred"] == []
    late = "二月十七日\n" + "　何かの件\n" * 11 + "は本委員会に付託された。"
    assert entries(spark, late)["referred"] == []  # too far ahead


def test_closings(spark):
    for word, line in (("散会", "　　　午後三時三十分散会"), ("休憩", "午後零時一分休憩"), ("延会", "  午後五時　延会 ")):
        lines = O.text_lines(spark.createDataFrame([(1, f"前\n午前九時散会\n{line}\n――")], "k int, text string"), "k")
        got = O.first_match(lines, "k").first()
        assert word in got.closing_line and got.closing_line == got.closing_line.strip() and got.closing_time in ("15:30", "12:01", "17:00")


def test_odd_texts(spark):
    for text in (None, "", "\n\n", "――――\n" * 50, "君\n" * 40, " 出席委員\n" + "  理事\n" * 30):
        assert entries(spark, text) == {"attendance": [], "membership": [], "referred": [], "agenda": []}


def test_same_as_windows(spark):
    """The fold gives what the operators over lines give, on shuffled lines of all kinds."""
    import random

    r, parts = random.Random(4), [*SAMPLE.split("\n"), "同日", "同月八日", "は本委員会に付託された。", "  理事", "   長い役職の", "", "○", "二月三日", "  辞任 補欠選任"]
    texts = [(i, "\n".join(r.choice(parts) for _ in range(40)), HELD) for i in range(60)]
    df = spark.createDataFrame(texts, "id int, text string, day date")
    fold = O.entries(df, "id", "text", F.col("day"), "委員", "出席委員")
    s = O.sections(O.text_lines(df.select(F.struct("id", "day").alias("k"), "text"), "k"), "k")
    people = O.attendance(s, "k", "委員", "出席委員").select("k.id", "pos", "n", "section", "role", "title", "name")
    assert sorted(map(repr, people.collect())) == sorted(map(repr, fold.where("state = 'attendance'").select("id", "pos", "n", "section", "role", "title", "name").collect()))
    moved = O.changes(s, "k", "k.day").select("k.id", "pos", F.col("changed_at").alias("day"), F.col("resigned").alias("name"), F.col("appointed").alias("other"))
    assert sorted(map(repr, moved.collect())) == sorted(map(repr, fold.where("state = 'membership'").select("id", "pos", "day", "name", "other").collect()))
    for state in ("referred", "agenda"):
        items = O.wrapped_items(s.where((F.col("state") == state) & ~F.col("control")), "k").select("k.id", F.col("item").alias("name"))
        assert sorted(map(repr, items.collect())) == sorted(map(repr, fold.where(F.col("state") == state).select("id", "name").collect()))


def test_one_pass(spark):
    df = spark.createDataFrame([(1, SAMPLE, HELD)], "k int, text string, day date")
    plan = O.entries(df, "k", "text", F.col("day"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan and plan.count("Generate") == 1
