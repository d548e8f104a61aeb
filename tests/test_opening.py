import datetime as dt
import time

from pyspark.sql import functions as F

from minutesmith.functions import minutes as M
from minutesmith.functions import opening
from minutesmith.functions import text as T
from minutesmith.operators import minutes as O

DAY = dt.date(2026, 1, 20)
ODD = ["委員長 山田　太郎君 理事 森　一君", "理事 林君理事 原君", "君", " 君", "〔森君〕", "山田太郎君外 二名", "国立大学教授 ジョン スミス君", "（防災担当） 原　六君", "田中​三郎君", "森\x1c一君 林\x85二君", "  ", "　高　三君 谷　四君", "代表 川局長 山田太郎七君", "同月三十一日", "十二月二十八日", "一月 十 日", "２月３０日", "2月二十日", "元月一日", "百二月三日", "１月５日"]


def test_strings_are_read_as_columns_are(spark):
    df = spark.createDataFrame([(x, DAY) for x in ODD], "x string, d date")
    one = lambda f: [r[0] for r in df.select(f(F.col("x"))).collect()]
    assert one(T.normalize_text) == [opening.normal(x) for x in ODD] and one(T.person_key) == [opening.person_key(x) for x in ODD]
    assert one(M.names_in) == [opening.names_in(x) for x in ODD] and [r and tuple(r) for r in one(M.name_and_role)] == [opening.name_and_role(x) for x in ODD]
    days = [opening.month_day_near(opening.BLANK.sub("", x), DAY) for x in ODD]
    near = lambda c: T.month_day_near(F.regexp_replace(T.without_space(c), "^同月", "1月"), F.col("d"))
    assert one(near) == [None if d is None else dt.date(1970, 1, 1) + dt.timedelta(d) for d in days]


def test_cost_grows_with_lines_alone(spark):
    n = 20_000
    text = " 出席委員\n" + "".join(f"   高橋　{'一二三四五六七八九'[i % 9]}君\n" for i in range(n))
    df = spark.createDataFrame([(1, text, DAY)] * 2 + [(2, None, None)], "k int, text string, day date")
    began = time.time()
    got = O.entries(df, "k", "text", F.col("day"), "委員", "出席委員").groupBy("role", "section").count().collect()
    assert [tuple(r) for r in got] == [("委員", "出席委員", 2 * n)] and time.time() - began < 30
