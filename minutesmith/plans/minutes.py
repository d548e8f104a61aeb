"""Queries on minutes. Their text is made in Spark from table rows; reading it gives the rows back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import minutes as M
from ..operators import minutes as O
from .catalog import KEY, kanji, query


@query("SELECT conv_id, turn, count(*) AS n, sum(length(rtrim(line))) AS chars FROM (SELECT conv_id, turn, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM conversations) GROUP BY 1, 2")
def text_lines(t):
    x = t.conversations.select(F.struct("conv_id", "turn").alias("k"), F.regexp_replace("text", "\n", "\r\n").alias("text"))
    return O.text_lines(x, "k").groupBy("k").agg(F.count("*").alias("n"), F.sum(F.length("line")).alias("chars")).select("k.*", "n", "chars")


@query("SELECT o_orderkey, CAST(o_orderdate AS DATE) AS meeting_date, '午前十時四分開議 ' || o_orderstatus AS opening_line, '10:04' AS opening_time, '午後三時三十分散会' AS closing_line, '15:30' AS closing_time FROM orders")
def first_match(t):
    text = F.concat(F.lit("会議録\n"), F.date_format("o_orderdate", "yyyy年M月d日"), F.lit("（水曜日）\n　  午前十時四分開議　 "), "o_orderstatus", F.lit(" \n午後零時一分休憩\n平成元年一月八日\n　　　午後三時三十分散会\n――"))
    lines = O.text_lines(t.orders.select("o_orderkey", text.alias("text")), "o_orderkey")
    return O.first_match(lines, "o_orderkey").select("o_orderkey", "meeting_date", "opening_line", "opening_time", "closing_line", "closing_time")


@query("""
WITH l AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS pos FROM (SELECT l_orderkey, l_linenumber, bool_or(l_returnflag = 'R') AS r, bool_or(l_returnflag = 'A') AS a FROM lineitem GROUP BY 1, 2))
SELECT l_orderkey, count(*) FILTER (WHERE EXISTS (SELECT 1 FROM l b WHERE b.l_orderkey = x.l_orderkey AND b.pos BETWEEN x.pos + 1 AND x.pos + 2 AND b.r
AND NOT EXISTS (SELECT 1 FROM l c WHERE c.l_orderkey = x.l_orderkey AND c.pos > x.pos AND c.pos < b.pos AND c.a))) AS n FROM l x GROUP BY 1""")
def lookahead(t):
    x = t.lineitem.groupBy("l_orderkey", F.col("l_linenumber").alias("pos")).agg(F.max((F.col("l_returnflag") == "R").cast("int")).alias("r"), F.max((F.col("l_returnflag") == "A").cast("int")).alias("a"))
    full = O.ahead(x, "l_orderkey", F.col("r") == 1, F.col("a") == 1, 2, "ok")
    return full.groupBy("l_orderkey").agg(F.count_if("ok").alias("n"))


@query("SELECT o_orderkey, CAST(i AS INTEGER) AS item_no, CASE i WHEN 1 THEN o_orderpriority || '（' || o_orderstatus || '）' ELSE '二、' || o_orderstatus END AS item FROM orders, (SELECT unnest([1, 2]) AS i)")
def wrap_join(t):
    text = F.concat(F.lit("――――\n○"), "o_orderpriority", F.lit("\n　　（"), "o_orderstatus", F.lit("）\n二、"), "o_orderstatus", F.lit("\n"))
    lines = O.text_lines(t.orders.select("o_orderkey", text.alias("text")), "o_orderkey")
    return O.wrapped_items(lines, "o_orderkey").select("o_orderkey", F.col("item_no").cast("int").alias("item_no"), "item")


K_SQL = "translate(CAST(%s AS VARCHAR), '0123456789', '零一二三四五六七八九')"


def _k(c):
    """A key as a name's letters: its digits in kanji."""
    return F.translate(c.cast("string"), "0123456789", "零一二三四五六七八九")


@query(f"""WITH c AS (SELECT c_custkey, {K_SQL % "c_custkey"} AS k, c_mktsegment AS seg FROM customer)
SELECT c_custkey, '国務大臣' AS section, seg || '大臣' AS role, NULL AS title, '谷' || k || '四郎' AS name FROM c UNION ALL SELECT c_custkey, NULL, '理事', NULL, '森' || k || '一' FROM c
UNION ALL SELECT c_custkey, NULL, '理事', NULL, '林' || k || '二' FROM c UNION ALL SELECT c_custkey, NULL, '委員', NULL, '高' || k || '三' FROM c
UNION ALL SELECT c_custkey, '国務大臣', seg || '附属研究所' || '所長', NULL, '川' || k || '五' FROM c UNION ALL SELECT c_custkey, '国務大臣', '国務大臣', '（' || seg || '担当）', '原' || k || '六' FROM c""")
def attendance_rows(t):
    k = _k(F.col(KEY))
    text = F.concat(F.lit("　理事 森"), k, F.lit("　一君 理事 林"), k, F.lit("　二君\n　　高"), k, F.lit("　三君\n国務大臣\n　"), "c_mktsegment", F.lit("大臣 谷"), k, F.lit("　四郎君\n　"), "c_mktsegment", F.lit("附属研究所\n　　　所長 川"), k, F.lit("　五君\n　（"), "c_mktsegment", F.lit("担当） 原"), k, F.lit("　六君"))
    lines = O.text_lines(t.customer.select(KEY, text.alias("text")), KEY)
    return O.attendance(lines, KEY, "委員").select(KEY, "section", "role", "title", "name")


@query(f"""WITH o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, {K_SQL % "o_custkey"} AS k FROM orders)
SELECT o_orderkey, d AS changed_at, '伊' || k || '四郎' AS resigned, '渡' || k || '五郎' AS appointed FROM o UNION ALL SELECT o_orderkey, d, '石' || k || '一', '岡' || k || '二' FROM o""")
def change_rows(t):
    d, k = F.col("o_orderdate").cast("date"), _k(F.col("o_custkey"))
    text = F.concat(F.lit("委員の異動\n"), kanji(F.month(d)), F.lit("月"), kanji(F.dayofmonth(d)), F.lit("日\n辞任 補欠選任\n　伊"), k, F.lit("　四郎君 渡"), k, F.lit("　五郎君\n平成元年一月一日付の文書\n同日\n　石"), k, F.lit("　一君 岡"), k, F.lit("　二君"))
    lines = O.text_lines(t.orders.select(F.struct("o_orderkey", F.date_add(d, 5).alias("day")).alias("k"), text.alias("text")), "k")
    return O.changes(lines, "k", "k.day").select("k.o_orderkey", "changed_at", "resigned", "appointed")


@query(f"""WITH c AS (SELECT c_custkey, {K_SQL % "c_custkey"} AS k, c_mktsegment AS seg FROM customer)
SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN '国立大学教授' WHEN 1 THEN seg || '大臣' WHEN 2 THEN '' ELSE seg || '代表 ' || k || '局長' END AS role,
CASE c_custkey % 4 WHEN 0 THEN 'ジョンスミス' WHEN 1 THEN '田' || k || '三郎' WHEN 2 THEN '田中' || k || '三郎' ELSE '山田太郎' || k END AS name FROM c""")
def name_role_split(t):
    m, k = F.col(KEY) % 4, _k(F.col(KEY))
    c = F.when(m == 0, F.lit("国立大学教授 ジョン スミス君")).when(m == 1, F.concat("c_mktsegment", F.lit("大臣 田"), k, F.lit(" 三郎君"))).when(m == 2, F.concat(F.lit("田中"), k, F.lit("三郎君")))
    c = c.otherwise(F.concat("c_mktsegment", F.lit("代表 "), k, F.lit("局長 山田太郎"), k, F.lit("君")))
    return t.customer.select(KEY, M.name_and_role(c).alias("x")).select(KEY, "x.*")


@query(f"""WITH o AS (SELECT o_orderkey, o_orderkey % 2 = 1 AS odd, o_orderpriority AS p, {K_SQL % "o_custkey"} AS k FROM orders), n AS (SELECT unnest(['attendance', 'attendance', 'attendance', 'membership', 'referred', 'agenda', 'agenda']) AS state, generate_subscripts([1, 2, 3, 4, 5, 6, 7], 1) AS i)
SELECT o_orderkey, state, CASE i WHEN 1 THEN '委員長' WHEN 2 THEN '委員' WHEN 3 THEN replace(p, ' ', '') || '大臣' WHEN 4 THEN '伊' || k || '四郎' END AS a,
CASE i WHEN 1 THEN '山' || k || '太郎' WHEN 2 THEN '高' || k || '三' WHEN 3 THEN '谷' || k || '六' WHEN 4 THEN '渡' || k || '五郎' WHEN 5 THEN p || '法律案（第' || k || '号）' WHEN 6 THEN p || 'の一部を改正する法律案（趣旨説明）' ELSE k || '審査の件' END AS b
FROM o, n WHERE i <> 5 OR NOT odd""")
def section_state(t):
    d, k, p = F.col("o_orderdate").cast("date"), _k(F.col("o_custkey")), F.col("o_orderpriority")
    odd, day = F.col("o_orderkey") % 2 == 1, F.concat(kanji(F.month(d)), F.lit("月"), kanji(F.dayofmonth(d)), F.lit("日"))
    present = F.concat(F.lit("会議録\n 出席委員\n   委員長 山"), k, F.lit("　太郎君\n      高"), k, F.lit("　三君\n 国務大臣\n   "), p, F.lit("\n      大臣 谷"), k, F.lit("　六君\n"))
    # half of the meetings change members inside the attendance, and a day there is no section of referrals
    change = F.concat(F.when(odd, F.lit("")).otherwise("――――◇―――――\n委員の異動\n"), day, F.lit("\n　辞任 補欠選任\n　伊"), k, F.lit("　四郎君 渡"), k, F.lit("　五郎君\n――――◇―――――\n"))
    refer = F.when(odd, F.lit("")).otherwise(F.concat(day, F.lit("\n　"), p, F.lit("法律案（第"), k, F.lit("号）\nは本委員会に付託された。\n")))
    agenda = F.concat(F.lit("――――◇―――――\n本日の会議に付した案件\n　"), p, F.lit("の一部を改正する法律案\n　　（趣旨説明）\n○"), k, F.lit("審査の件\n――――◇―――――\n午前十時開議\n　発言"))
    meetings = t.orders.select("o_orderkey", F.date_add(d, 3).alias("day"), F.concat(present, change, refer, agenda).alias("text"))
    x = O.entries(meetings, "o_orderkey", "text", F.col("day"), "委員", "出席委員")
    person, moved = F.col("state") == "attendance", F.col("state") == "membership"
    return x.select("o_orderkey", "state", F.when(person, F.col("role")).when(moved, F.col("name")).alias("a"), F.when(moved, F.col("other")).otherwise(F.col("name")).alias("b"))


@query("""
WITH s AS (SELECT conv_id, role, min(turn) AS f FROM conversations GROUP BY 1, 2), n AS (SELECT conv_id, string_agg(role, ',' ORDER BY f, role) AS speakers FROM s GROUP BY 1)
SELECT conv_id, any_value(speakers) AS speakers, count(*) AS speech_count, length(arg_min(text, turn)) AS intro, length(arg_max(text, turn)) AS closing FROM conversations JOIN n USING (conv_id) GROUP BY 1""")
def meeting_rollup(t):
    x = O.rollup(t.conversations, "conv_id", "turn", "role", "text")
    return x.select("conv_id", F.array_join("speakers", ",").alias("speakers"), "speech_count", F.length("intro").cast("long").alias("intro"), F.length("closing").cast("long").alias("closing"))


@query("""SELECT conv_id, count(*) AS speech_count, count(*) FILTER (WHERE role = 'user' AND turn > 0) AS matched_item_count FROM conversations GROUP BY 1""")
def meeting_publish(t):
    meetings = O.publish_detail(O.rollup(t.conversations, "conv_id", "turn", "role", "text"))
    return O.publish_list(meetings, t.conversations.where("role = 'user' AND turn > 0"), "conv_id", ["speech_count"])
