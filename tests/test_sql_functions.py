"""Every function called from SQL gives what its column expression gives."""

import pytest
from pyspark.sql import functions as F

from minutesmith.functions import sql

TEXTS = [
    "令和八年二月十八日　午前十時四分", "平成元年一月八日", "2024年2月30日", "十二月二十八日", "正午", "千二百三十四", "元", "２１", "第220回（特別会）", "日程第一及び第二　刑法の一部を改正する法律案（内閣提出第三号）（趣旨説明）", "○一、請願外二件の請願（第一二号）",
    "山田　太郎君外二名", "法務大臣 田中　三郎君", "補欠として 森君", "二月三日 ／ 法務委員会", "a; b；;c", "it's a \\ \"test\" 'x'\\n", "修正案：第一(可決)", "提出時法律案(衆)", "https://x.y/a/B-1.htm?z=1", "shugiin-221-007", "ＮＨＫ決算", "line one \r\nline two　", "", None,
]
OTHER = {"date": "DATE'2026-01-20'", "int": "221"}


@pytest.fixture(scope="module")
def named(spark):
    return sql.register(spark, "ms_")


@pytest.mark.parametrize("name", sorted(sql.FUNCTIONS))
def test_function(spark, named, name):
    assert f"ms_{name}" in named
    params, f = sql.FUNCTIONS[name]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, t string")
    args = {"string": "t", "array<string>": "array(t, t, 'x')"} | OTHER
    df = df.select("i", *[F.expr(args[k]).alias(p) for p, k in params.items()])
    df.createOrReplaceTempView("texts")
    want = df.select("i", f(*[F.col(p) for p in params]).alias("x")).orderBy("i").collect()
    got = spark.sql(f"SELECT i, ms_{name}({', '.join(params)}) AS x FROM texts ORDER BY i")
    assert got.collect() == want and "Python" not in got._jdf.queryExecution().executedPlan().toString()
