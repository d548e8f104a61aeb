"""The library's own queries over the driver's tables, and the SQL that gives the same rows.

The tables hold no parliamentary data; their columns stand for it (orders for sessions and listings, parts for bills,
customers and suppliers for people, conversations for meetings). Text operators run on text that Spark decorates from
table values; undoing the decoration must give the values back.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import entity, incremental, link, minutes, serve

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = lambda spark, d: f(Tables(spark, d))
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")


KEY = "c_custkey"
SPACE = "　"


@query("SELECT c_custkey, c_name || ' ' || c_mktsegment AS text FROM customer")
def normalize_text(t):
    c = F.concat(F.lit(" \t　"), "c_name", F.lit("　\n "), "c_mktsegment", F.lit("  "))
    return t.customer.select(KEY, T.normalize_text(c).alias("text"))


@query("SELECT c_custkey, c_name AS text FROM customer")
def agenda_prefix(t):
    number = F.concat(F.lit("○"), kanji(F.col(KEY) % 99 + 1), F.lit("、"))
    c = F.concat(F.when(F.col(KEY) % 3 == 0, F.lit("")).otherwise(number), F.lit("日程第二及び第十 "), "c_name")
    return t.customer.select(KEY, T.agenda_prefix(c).alias("text"))


@query("""SELECT p_partkey, replace(p_name, ' ', '') || CASE WHEN p_partkey % 2 = 0 THEN '趣旨説明聴取の件' ELSE '' END AS bill,
replace(p_name, ' ', '') || CASE WHEN p_partkey % 2 = 0 THEN '外二件の請願に関する件' ELSE '請願' END AS petition FROM part""")
def title_key(t):
    even = F.col("p_partkey") % 2 == 0
    bill = F.concat(F.lit("日程第一　"), "p_name", F.when(even, "趣旨説明聴取の件").otherwise("（内閣提出第三号）（趣旨説明）"))
    petition = F.concat("p_name", F.when(even, "外二件の請願に関する件（第一二号）").otherwise("外二件の請願"))
    return t.part.select("p_partkey", T.bill_title_key(bill).alias("bill"), T.petition_title_key(petition).alias("petition"))


@query("SELECT s_suppkey, s_name AS key, s_suppkey % 3 <> 0 AS indexable FROM supplier")
def person_key(t):
    c = F.concat("s_name", F.lit(SPACE + "君"))
    c = F.when(F.col("s_suppkey") % 3 == 0, F.concat(F.lit("補欠として"), c)).otherwise(c)
    return t.supplier.select("s_suppkey", F.regexp_replace(T.person_key(c), "^補欠として", "").alias("key"), T.indexable_name(c).alias("indexable"))


@query("SELECT c_custkey, c_name AS name, CASE WHEN c_custkey % 2 = 0 THEN c_nationkey + 2 END AS total, c_custkey % 2 = 0 AS more FROM customer")
def name_count_split(t):
    more = F.concat("c_name", F.lit("君外"), (F.col("c_nationkey") + 1).cast("string"), F.lit("名"))
    x = T.name_and_count(F.when(F.col(KEY) % 2 == 0, more).otherwise(F.col("c_name")))
    return t.customer.select(KEY, x.alias("x")).select(KEY, "x.*")


@query("SELECT o_orderkey, CAST(o_orderkey AS INTEGER) AS n FROM orders")
def parse_int(t):
    wide = F.translate(F.col("o_orderkey").cast("string"), T.NARROW, T.WIDE)
    return t.orders.select("o_orderkey", T.parse_int(F.concat(F.lit("第"), wide, F.lit("号"))).alias("n"))


def kanji(n):
    """Unit numerals of 1 to 99."""
    tens, ones = F.floor(n / 10).cast("int"), (n % 10).cast("int")
    name = F.array(*[F.lit(x) for x in ["", *"一二三四五六七八九"]])
    return F.concat(F.when(tens == 0, "").when(tens == 1, "十").otherwise(F.concat(F.element_at(name, tens + 1), F.lit("十"))), F.element_at(name, ones + 1))


@query("SELECT CASE WHEN l_linenumber = 7 THEN NULL WHEN l_linenumber = 6 THEN 30 WHEN l_linenumber = 5 THEN CAST(l_quantity AS INTEGER) * 100 + 5 ELSE CAST(l_quantity AS INTEGER) END AS n, count(*) AS rows FROM lineitem GROUP BY 1")
def kanji_number(t):
    q, line = F.col("l_quantity").cast("int"), F.col("l_linenumber")
    positional = F.translate(F.concat((q * 100 + 5).cast("string")), "0123456789", "〇一二三四五六七八九")
    c = F.when(line == 7, F.concat(F.lit("2"), kanji(q), F.lit("十"))).when(line == 6, "二三十").when(line == 5, positional).when(line == 4, q.cast("string")).otherwise(kanji(q))
    return t.lineitem.select(T.kanji_number(c).alias("n")).groupBy("n").agg(F.count("*").alias("rows"))


@query("SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders")
def era_date(t):
    d = F.col("o_orderdate").cast("date")
    east = F.concat(F.lit("平成"), F.when(F.year(d) == 1989, "元").otherwise(kanji(F.year(d) - 1988)), F.lit("年"), kanji(F.month(d)), F.lit("月"), kanji(F.dayofmonth(d)), F.lit("日"))
    west = F.date_format(d, "yyyy年 M月 d日")
    return t.orders.select("o_orderkey", T.era_date(F.when(F.year(d) >= 1989, east).otherwise(west)).alias("day"))


@query("SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders")
def month_day_near(t):
    d = F.col("o_orderdate").cast("date")
    c = F.concat(kanji(F.month(d)), F.lit("月"), kanji(F.dayofmonth(d)), F.lit("日"))
    return t.orders.select("o_orderkey", T.month_day_near(c, F.date_add(d, (F.col("o_orderkey") % 300 - 150).cast("int"))).alias("day"))


@query("SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders")
def month_day_default(t):
    d = F.col("o_orderdate").cast("date")
    c = F.concat(kanji(F.month(d)), F.lit("月 "), kanji(F.dayofmonth(d)), F.lit("日"))
    whole = F.concat(F.year(d).cast("string"), F.lit("年"), F.month(d).cast("string"), F.lit("月"), F.dayofmonth(d).cast("string"), F.lit("日"))
    odd = F.col("o_orderkey") % 2 == 1
    return t.orders.select("o_orderkey", T.month_day_default(F.when(odd, whole).otherwise(c), F.when(odd, 1900).otherwise(F.year(d))).alias("day"))


@query("SELECT c_custkey, c_name || '|' || c_mktsegment AS names, sha256(c_name) AS id FROM customer")
def clean_names(t):
    c = F.array(F.concat("c_name", F.lit(" 君")), F.concat(F.lit("　"), "c_mktsegment", F.lit("君")), F.lit(" 君"), F.col("c_name"))
    return t.customer.select(KEY, F.array_join(T.clean_names(c), "|").alias("names"), T.person_id(F.col("c_name")).alias("id"))


@query("""
SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN 'unknown' ELSE CAST(p_size AS VARCHAR) END || CASE WHEN p_partkey % 3 = 0 THEN '-san_law-' ELSE '-other_kind-' END
|| CASE WHEN p_partkey % 2 = 0 THEN CAST(p_partkey AS VARCHAR) ELSE CASE WHEN p_partkey % 7 = 0 THEN 'unknown' ELSE 'kessan' END || '-' || left(sha1(p_name), 8) END AS id FROM part""")
def bill_id(t):
    k = F.col("p_partkey")
    category, sub = F.when(k % 3 == 0, "参法").otherwise("Other Kind"), F.when(k % 7 != 0, "決算")
    return t.part.select("p_partkey", T.bill_id(category, F.when(k % 5 != 0, F.col("p_size")), F.when(k % 2 == 0, k), F.concat(F.lit(" "), "p_name"), sub).alias("id"))


@query("SELECT event_id, strftime(ts, '%H:%M') AS clock FROM events")
def clock_time(t):
    h, m = F.hour("ts"), F.minute("ts")
    half = F.when(h < 12, "午前").otherwise("午後")
    odd = F.col("event_id") % 2 == 1  # afternoon hours also come as 13 to 23, and a line may hold noon and another time
    hour = F.when(odd & (h > 12), h.cast("string")).otherwise(F.when(odd, kanji(h % 12)).otherwise((h % 12).cast("string")))
    hour = F.when(hour == "", "〇").otherwise(hour)
    c = F.when((h == 12) & (m == 0), "正午 午後一時").otherwise(F.concat(half, hour, F.lit("時"), m.cast("string"), F.lit("分")))
    return t.events.select("event_id", T.clock_time(c).alias("clock"))


@query("SELECT DISTINCT o_orderpriority AS label, CASE o_orderpriority WHEN '1-URGENT' THEN 'first' ELSE trim(regexp_replace(lower(o_orderpriority), '[^a-z0-9]+', '_', 'g'), '_') END AS slug FROM orders")
def slug(t):
    return t.orders.select(F.col("o_orderpriority").alias("label")).distinct().select("label", T.slug(F.col("label"), {"1-URGENT": "first"}).alias("slug"))


@query("SELECT o_orderkey, 'shu-' || year(o_orderdate) || '-' || lpad(CAST(o_orderkey % 900 AS VARCHAR), 3, '0') AS id, CAST(year(o_orderdate) AS INTEGER) AS session FROM orders")
def stable_id(t):
    i = T.house_id("shu", F.year("o_orderdate"), F.col("o_orderkey") % 900)
    return t.orders.select("o_orderkey", i.alias("id"), T.session_of_id(i).alias("session"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN CAST(o_orderdate AS DATE) END AS day, CASE WHEN o_orderkey % 3 = 1 THEN NULL ELSE o_orderpriority END AS text FROM orders")
def date_text_split(t):
    d = F.date_format("o_orderdate", "yyyy年M月d日")
    k = F.col("o_orderkey") % 3
    c = F.when(k == 0, F.concat(F.lit("／ "), "o_orderpriority")).when(k == 1, F.concat(d, F.lit(" ／"))).otherwise(F.concat(d, F.lit(" ／ "), "o_orderpriority"))
    return t.orders.select("o_orderkey", T.date_and_text(c).alias("x")).select("o_orderkey", "x.*")


@query("SELECT c_custkey, c_name || '|' || c_mktsegment AS parts FROM customer")
def list_split(t):
    c = F.concat(F.lit("; "), "c_name", F.lit("；　; "), "c_mktsegment", F.lit(";"))
    return t.customer.select(KEY, F.array_join(T.split_list(c), "|").alias("parts"))


@query("SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS number, o_orderstatus AS type, o_orderpriority AS note FROM orders")
def number_type(t):
    c = F.concat(F.lit("第"), F.year("o_orderdate").cast("string"), F.lit("回（"), "o_orderstatus", F.lit("）"))
    n = F.concat(F.date_format("o_orderdate", "yyyy年M月d日"), F.lit("（"), "o_orderpriority", F.lit("）"))
    return t.orders.select("o_orderkey", T.number_and_type(c).alias("x"), T.closing_note(n).alias("note")).select("o_orderkey", "x.*", "note")


@query("SELECT replace(p_name, ' ', '') AS key, min(p_partkey) AS id FROM part GROUP BY 1")
def title_index(t):
    p = t.part.withColumn("key", T.bill_title_key(F.col("p_name")))
    return link.title_index(p, "key", "p_partkey", "p_name", "p_partkey").select("key", "id")


def _items(t, lines=None):
    c = F.concat(F.lit("日程第一　"), "p_name", F.when(F.col("l_linenumber") % 2 == 1, "に関する件").otherwise(""), F.lit("（閣法第3号）"))
    lines = t.lineitem.select("l_partkey", "l_linenumber", "l_orderkey") if lines is None else lines
    rest = [x for x in lines.columns if x not in ("l_partkey", "l_linenumber")]
    items = lines.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(*rest, c.alias("text"))
    p = t.part.withColumn("key", T.bill_title_key(F.col("p_name")))
    return items, link.title_index(p, "key", "p_partkey", "p_name", "p_partkey")


ITEMS_SQL = """
WITH idx AS (SELECT replace(p_name, ' ', '') AS k, min(p_partkey) AS id FROM part GROUP BY 1),
it AS (SELECT l_orderkey, l_linenumber, l_suppkey, replace(p_name, ' ', '') || CASE WHEN l_linenumber % 2 = 1 THEN 'に関する件' ELSE '' END AS key FROM lineitem JOIN part ON l_partkey = p_partkey),
keys AS (SELECT DISTINCT key FROM it),
ex AS (SELECT key, id, 'exact' AS kind FROM keys JOIN idx ON key = k),
pre AS (SELECT key, min(id) AS id, 'prefix' AS kind FROM keys JOIN idx ON starts_with(key, k) OR starts_with(k, key) WHERE key NOT IN (SELECT key FROM ex) GROUP BY key),
linked AS (SELECT it.*, f.id, f.kind FROM it LEFT JOIN (SELECT * FROM ex UNION ALL SELECT * FROM pre) f USING (key))
"""


@query(ITEMS_SQL + "SELECT key, id, kind, count(*) AS n FROM linked GROUP BY ALL")
def title_link(t):
    lines = t.lineitem.groupBy("l_partkey", (F.col("l_linenumber") % 2).alias("l_linenumber")).agg(F.count("*").alias("n"))
    items, index = _items(t, lines)  # lines are counted by part before the join, so that only counts meet titles
    counts = items.groupBy("text").agg(F.sum("n").alias("n"))
    return link.title_link(counts, index, "text", T.bill_title_key).groupBy(T.bill_title_key(F.col("text")).alias("key"), "id", "kind").agg(F.sum("n").alias("n"))


@query(ITEMS_SQL + "SELECT l_orderkey, count(*) AS items, count(*) FILTER (WHERE kind = 'exact') AS matched FROM linked GROUP BY 1")
def match_count(t):
    items, index = _items(t)
    x = link.title_link(items, index, "text", T.bill_title_key)
    return x.groupBy("l_orderkey").agg(F.count("*").alias("items"), F.count_if(F.col("kind") == "exact").alias("matched"))


@query("""
WITH part_ AS (SELECT *, replace(p_name, ' ', '') AS k, CASE WHEN p_size % 2 = 0 THEN 'shugiin' ELSE 'sangiin' END AS house FROM part),
b AS (SELECT house, k, min(p_partkey) AS id FROM part_ WHERE p_partkey % 3 = 0 GROUP BY 1, 2), p AS (SELECT house, k, min(p_partkey) AS id FROM part_ WHERE p_partkey % 3 = 1 GROUP BY 1, 2),
it AS (SELECT house, p_partkey, p_partkey % 4 AS m, k || CASE p_partkey % 4 WHEN 1 THEN 'に関する件' WHEN 2 THEN '請願' ELSE '' END AS t FROM part_),
c AS (SELECT p_partkey, 0 AS r, id, 'bill' AS item_type FROM it JOIN b USING (house) WHERE k = t UNION ALL SELECT p_partkey, 1, id, 'petition' FROM it JOIN p USING (house) WHERE k = t
UNION ALL SELECT p_partkey, 2, id, 'bill' FROM it JOIN b USING (house) WHERE starts_with(t, k) OR starts_with(k, t) UNION ALL SELECT p_partkey, 3, id, 'petition' FROM it JOIN p USING (house) WHERE starts_with(t, k) OR starts_with(k, t))
SELECT it.p_partkey, it.house, x.item_type, CAST(x.id AS VARCHAR) AS id FROM it LEFT JOIN (SELECT p_partkey, arg_min(item_type, (r, id)) AS item_type, arg_min(id, (r, id)) AS id FROM c GROUP BY 1) x ON x.p_partkey = it.p_partkey""")
def precedence_link(t):
    k, m = F.col("p_partkey"), F.col("p_partkey") % 4
    text = F.concat(F.lit("二、"), "p_name", F.when(m == 1, "に関する件（閣法第1号）").when(m == 2, "外三件の請願").when(m == 3, "（第一号）").otherwise(""))
    text = F.when(m == 3, F.concat(F.lit("○"), "p_name")).otherwise(text)
    house = F.when(F.col("p_size") % 2 == 0, "shugiin").otherwise("sangiin").alias("house")
    index = lambda rest: link.title_index(t.part.where(k % 3 == rest).select("p_partkey", "p_name", house, T.bill_title_key(F.col("p_name")).alias("key")), "key", "p_partkey", "p_name", "p_partkey", ("house",))
    return link.precedence_link(t.part.select("p_partkey", house, text.alias("text")), "text", index(0), index(1), ("house",)).select("p_partkey", "house", "item_type", "id")


@query("""
SELECT l_partkey, count(*) AS n, string_agg(CAST(l_orderkey AS VARCHAR) || ':' || last, ',' ORDER BY day, l_orderkey) AS refs FROM (
SELECT l_partkey, l_orderkey, CAST(max(l_linenumber) AS VARCHAR) AS last, min(CAST(o_orderdate AS DATE)) AS day FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2) GROUP BY 1""")
def reverse_refs(t):
    x = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select("l_partkey", "l_orderkey", "l_linenumber", F.col("l_linenumber").cast("string").alias("line"), F.col("o_orderdate").cast("date").alias("day"))
    r = link.reverse_links(x, "l_partkey", "l_orderkey", "line", ["l_linenumber"], "day")
    return r.select("l_partkey", "n", F.array_join(F.transform("refs", lambda y: F.concat_ws(":", y["l_orderkey"], y["text"])), ",").alias("refs"))


def _relations(t):
    person = lambda k, n: (F.concat(F.lit("p"), k % 700).alias("person_key"), n.alias("name"))
    return entity.relations(
        [
            t.customer.select(*person(F.col("c_custkey"), F.col("c_name")), F.lit("bill").alias("type"), F.col("c_nationkey").cast("long").alias("entity_id")),
            t.supplier.select(*person(F.col("s_suppkey"), F.col("s_name")), F.lit("question").alias("type"), F.col("s_nationkey").cast("long").alias("entity_id")),
            t.orders.select(*person(F.col("o_custkey"), F.col("o_orderpriority")), F.lit("petition").alias("type"), F.col("o_orderkey").alias("entity_id")),
            t.lineitem.select(*person(F.col("l_suppkey"), F.col("l_returnflag")), F.lit("attendance").alias("type"), F.col("l_orderkey").alias("entity_id")),
            t.events.select(*person(F.col("user_id"), F.col("event_type")), F.lit("speech").alias("type"), F.col("event_id").alias("entity_id")),
        ]
    )


@query("""
WITH r AS (SELECT 'p' || c_custkey % 700 AS person_key, c_name AS name, 'bill' AS type, c_nationkey AS e FROM customer
UNION ALL SELECT 'p' || s_suppkey % 700, s_name, 'question', s_nationkey FROM supplier
UNION ALL SELECT 'p' || o_custkey % 700, o_orderpriority, 'petition', o_orderkey FROM orders
UNION ALL SELECT 'p' || l_suppkey % 700, l_returnflag, 'attendance', l_orderkey FROM lineitem
UNION ALL SELECT 'p' || user_id % 700, event_type, 'speech', event_id FROM events)
SELECT person_key, sha256(person_key) AS detail_id, string_agg(DISTINCT name, '|' ORDER BY name) AS names, count(DISTINCT e) FILTER (WHERE type = 'bill') AS n_bill, count(DISTINCT e) FILTER (WHERE type = 'question') AS n_question,
count(DISTINCT e) FILTER (WHERE type = 'petition') AS n_petition, count(DISTINCT e) FILTER (WHERE type = 'attendance') AS n_attendance, count(DISTINCT e) FILTER (WHERE type = 'speech') AS n_speech, count(DISTINCT (type, e)) AS total FROM r GROUP BY 1""")
def entity_index(t):
    return entity.entity_index(_relations(t), ["bill", "question", "petition", "attendance", "speech"]).withColumn("names", F.array_join("names", "|"))


@query("""
WITH r AS (SELECT DISTINCT 'p' || c_custkey % 700 AS person_key, 'bill' AS type, c_nationkey AS e FROM customer
UNION SELECT 'p' || s_suppkey % 700, 'question', s_nationkey FROM supplier UNION SELECT 'p' || o_custkey % 700, 'petition', o_orderkey FROM orders
UNION SELECT 'p' || l_suppkey % 700, 'attendance', l_orderkey FROM lineitem UNION SELECT 'p' || user_id % 700, 'speech', event_id FROM events)
SELECT person_key, coalesce(string_agg(CAST(e AS VARCHAR), ',' ORDER BY e) FILTER (WHERE type = 'bill'), '') AS bill, coalesce(string_agg(CAST(e AS VARCHAR), ',' ORDER BY e) FILTER (WHERE type = 'petition'), '') AS petition,
coalesce(string_agg(CAST(e AS VARCHAR), ',' ORDER BY e) FILTER (WHERE type = 'attendance'), '') AS attendance FROM r GROUP BY 1""")
def entity_relations(t):
    types = ["bill", "petition", "attendance"]
    x = entity.entity_relations(_relations(t), types, ["entity_id"], ["entity_id"])
    return x.select("person_key", *[F.array_join(F.transform(k, lambda r: r["entity_id"].cast("string")), ",").alias(k) for k in types])


@query("""
SELECT o_custkey, CASE WHEN o_orderkey % 7 <> 0 THEN CAST(year(o_orderdate) AS INTEGER) END AS session, string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderkey) AS items FROM orders GROUP BY 1, 2""")
def group_by_session(t):
    x = t.orders.withColumn("session", F.when(F.col("o_orderkey") % 7 != 0, F.year("o_orderdate")))
    return serve.group_by_session(x, ["o_custkey"], "session", "o_orderkey", "o_orderkey").withColumn("items", F.array_join(F.transform("items", lambda i: i.cast("string")), ","))


@query("SELECT l_partkey, string_agg(DISTINCT CAST(year(l_shipdate) AS VARCHAR), ',' ORDER BY CAST(year(l_shipdate) AS VARCHAR)) AS sessions, CAST(count(DISTINCT year(l_shipdate)) AS INTEGER) AS n FROM lineitem GROUP BY 1")
def entity_history(t):
    x = entity.history(t.lineitem.withColumn("y", F.year("l_shipdate")).withColumn("v", F.lit(1)), "l_partkey", "y", "v")
    return x.select("l_partkey", F.array_join(F.transform("history", lambda h: h["y"].cast("string")), ",").alias("sessions"), "n")


@query("SELECT o_custkey, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS o_orderstatus FROM orders GROUP BY 1")
def latest_canonical(t):
    return entity.latest(t.orders, "o_custkey", ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey", "o_orderstatus")


@query("SELECT o_custkey, arg_min(o_orderstatus, o_orderkey) AS status FROM orders WHERE o_orderstatus <> 'O' GROUP BY 1")
def first_nonempty(t):
    x = t.orders.withColumn("status", F.when(F.col("o_orderstatus") != "O", F.col("o_orderstatus")))
    return entity.first_filled(x, "o_custkey", "o_orderkey", "status")


@query("SELECT o_custkey, arg_max(o_orderstatus, (n, -f)) AS o_orderstatus FROM (SELECT o_custkey, o_orderstatus, count(*) AS n, min(o_orderkey) AS f FROM orders GROUP BY 1, 2) GROUP BY 1")
def mode_first(t):
    return entity.mode_first(t.orders, "o_custkey", "o_orderstatus", "o_orderkey")


@query("SELECT c_custkey, coalesce(string_agg(CAST(o_orderkey AS VARCHAR) || o_orderstatus, ',' ORDER BY o_orderkey), '') AS children FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY 1")
def nest_children(t):
    kids = entity.nest(t.orders, "o_custkey", ["o_orderkey", "o_orderstatus"], "kids").withColumnRenamed("o_custkey", "c_custkey")
    x = t.customer.join(kids, "c_custkey", "left")
    return x.select("c_custkey", F.coalesce(F.array_join(F.transform("kids", lambda k: F.concat(k["o_orderkey"].cast("string"), k["o_orderstatus"])), ","), F.lit("")).alias("children"))


@query("SELECT c_custkey, y, EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND year(o_orderdate) = y) AS has_progress FROM customer CROSS JOIN (SELECT CAST(unnest([1995, 1996, 1997]) AS INTEGER) AS y)")
def exists_flags(t):
    rows = t.customer.select("c_custkey", F.explode(F.array(F.lit(1995), F.lit(1996), F.lit(1997))).alias("y"))
    return entity.exists_flag(rows, t.orders.select(F.col("o_custkey").alias("c_custkey"), F.year("o_orderdate").alias("y")), ["c_custkey", "y"], "has_progress")


@query("""
SELECT 'inner' AS policy, count(*) AS n FROM customer JOIN orders ON c_custkey = o_custkey AND o_orderstatus = 'F'
UNION ALL SELECT 'left', count(*) FROM customer LEFT JOIN orders ON c_custkey = o_custkey AND o_orderstatus = 'F'
UNION ALL SELECT 'misses', count(*) FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')
UNION ALL SELECT 'strict', count(*) FROM orders WHERE o_orderstatus = 'F'""")
def detail_assembly(t):
    """Strictly, too: of the customers that have a page."""
    pages = t.orders.where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey")
    rows = t.customer.select("c_custkey")
    policies = {p: rows for p in ("inner", "left", "misses")} | {"strict": rows.join(pages, "c_custkey", "left_semi")}
    out = [entity.assemble(r, pages, "c_custkey", p).agg(F.count("*").alias("n")).select(F.lit(p).alias("policy"), "n") for p, r in policies.items()]
    return reduce(DataFrame.unionAll, out)


@query("SELECT DISTINCT year(o_orderdate) AS session FROM orders WHERE year(o_orderdate) NOT IN (SELECT year(l_shipdate) FROM lineitem WHERE l_quantity > 49 AND year(l_shipdate) % 2 = 0) AND year(o_orderdate) <> 1995")
def pending_targets(t):
    done = t.lineitem.where("l_quantity > 49").select(F.year("l_shipdate").alias("session")).where("session % 2 = 0").distinct()
    wanted = t.orders.select(F.year("o_orderdate").alias("session")).distinct()
    return entity.pending(wanted, done, wanted.where("session = 1995"), ["session"]).select(F.col("session").cast("long").alias("session"))


@query("SELECT 'customer' AS house, c_custkey AS id, c_name AS name FROM customer UNION ALL SELECT 'supplier', s_suppkey, s_name FROM supplier")
def union_sources(t):
    return entity.relations([t.customer.select(F.lit("customer").alias("house"), F.col("c_custkey").alias("id"), F.col("c_name").alias("name")), t.supplier.select(F.lit("supplier").alias("house"), F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))])


@query("SELECT c_custkey AS id, (SELECT count(*) FROM customer) AS total FROM customer ORDER BY CAST(c_custkey AS VARCHAR) LIMIT 100 OFFSET 50")
def page_ids(t):
    x = t.customer.select(F.col("c_custkey").alias("id"))
    return serve.with_total(serve.page(x, [F.col("id").cast("string")], 50, 100), x)


@query("SELECT c_custkey, c_name, count(*) OVER () AS total FROM customer WHERE contains(c_name, '12') ORDER BY c_name LIMIT 20")
def people_search(t):
    x = t.customer.select("c_custkey", "c_name", F.array(F.concat(F.lit("x "), "c_name")).alias("v"))
    return serve.with_total(serve.search(x, "12", "c_name", "v"), serve.search_hits(x, "12", "c_name", "v")).drop("v")


@query("SELECT CASE WHEN o_orderpriority IN ('5-LOW', '1-URGENT') THEN '分類不明' ELSE o_orderpriority END AS label, count(*) AS n, min(o_orderkey) AS first FROM orders GROUP BY 1")
def group_first_seen(t):
    """Bills by category: missing and empty categories are one group."""
    group = F.when(F.col("o_orderpriority") == "1-URGENT", "").when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority"))
    return serve.first_seen_groups(t.orders, group, "o_orderkey", "分類不明")


@query("SELECT CASE WHEN p_brand = 'Brand#11' THEN '提出者不明' ELSE p_brand END AS label, count(*) AS n, min(p_partkey) AS first, count(*) FILTER (WHERE p_size % 3 = 0) AS answered FROM part GROUP BY 1 ORDER BY n DESC, first LIMIT 8")
def top_k_groups(t):
    """The eight submitters with most questions, and how many of these are answered."""
    return serve.top_groups(t.part, F.when(F.col("p_brand") != "Brand#11", F.col("p_brand")), "p_partkey", 8, "提出者不明", answered=F.col("p_size") % 3 == 0)


@query("SELECT c_mktsegment AS section, CAST(c_nationkey AS VARCHAR) AS role, count(*) AS n, min(c_custkey) AS first FROM customer GROUP BY 1, 2")
def two_level_group(t):
    return serve.two_level(t.customer, F.col("c_mktsegment"), F.col("c_nationkey").cast("string"), "c_custkey")


@query("""WITH s AS (SELECT DISTINCT CAST(year(o_orderdate) + x AS INTEGER) AS session FROM orders, (SELECT unnest([0, 2, 60]) AS x)), o AS (SELECT year(o_orderdate) AS y, o_orderstatus AS st FROM orders), l AS (SELECT year(l_shipdate) AS y, l_returnflag AS f FROM lineitem)
SELECT session, session IN (SELECT y FROM o WHERE st = 'F') AS has_gian, session IN (SELECT y FROM l WHERE f = 'N') AS has_kaigiroku, session IN (SELECT y FROM l WHERE f = 'R') AS has_seigan_shugiin, session IN (SELECT y FROM l WHERE f = 'A') AS has_seigan_sangiin,
session IN (SELECT y FROM o WHERE st = 'P') AS has_shitsumon_shugiin, session IN (SELECT y FROM o WHERE st = 'O') AS has_shitsumon_sangiin, (SELECT nullif(count(*), 0) FROM l WHERE f = 'N' AND y = session) AS n_kaigiroku FROM s""")
def availability_matrix(t):
    """The sessions and which of six sets have something of each, with the number of meetings."""
    o, li = t.orders.select(F.year("o_orderdate").alias("session"), "o_orderstatus"), t.lineitem.select(F.year("l_shipdate").alias("session"), "l_returnflag")
    sets = {"gian": o.where("o_orderstatus = 'F'"), "kaigiroku": li.where("l_returnflag = 'N'"), "seigan_shugiin": li.where("l_returnflag = 'R'"), "seigan_sangiin": li.where("l_returnflag = 'A'"), "shitsumon_shugiin": o.where("o_orderstatus = 'P'"), "shitsumon_sangiin": o.where("o_orderstatus = 'O'")}
    base = o.select(F.explode(F.array(F.col("session"), F.col("session") + 2, F.col("session") + 60)).alias("session")).distinct()
    return serve.availability(sets, "session", ("kaigiroku",), base)


@query("""WITH c AS (SELECT conv_id, turn, role, CASE WHEN turn % 3 = 1 THEN 'p' || turn END AS position FROM conversations WHERE turn % 5 <> 4)
SELECT conv_id, 'x' || role AS person_key, arg_min('x ' || role || CASE WHEN turn % 2 = 0 THEN '君' ELSE '' END, turn) AS name, count(*) AS n, min(turn) AS first, arg_min(position, turn) AS position FROM c GROUP BY 1, 2""")
def speaker_summary(t):
    turn = F.col("turn")
    name = F.when(turn % 5 == 4, serve.INFORMATION).otherwise(F.concat(F.lit("x "), "role", F.when(turn % 2 == 0, "君").otherwise("")))
    x = t.conversations.select("conv_id", "turn", name.alias("speaker"), F.when(turn % 3 == 1, F.concat(F.lit("p"), turn.cast("string"))).alias("position"))
    return serve.speaker_summary(x, "conv_id", "speaker", "turn", ("position",))


@query("SELECT conv_id, arg_min(length(text), turn) AS first_chars, arg_max(length(text), turn) AS last_chars FROM conversations GROUP BY 1")
def first_last(t):
    x = minutes.first_last(t.conversations, "conv_id", "turn", "text")
    return x.select("conv_id", F.length("intro").cast("long").alias("first_chars"), F.length("closing").cast("long").alias("last_chars"))


@query("SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS session FROM orders ORDER BY 1 DESC LIMIT 2")
def latest_n(t):
    return incremental.targets(t.orders.select(F.year("o_orderdate").alias("session")))


@query("SELECT c_custkey, c_name, o_orderkey FROM customer JOIN orders ON c_custkey = o_custkey WHERE c_name LIKE '%1'")
def point_lookup(t):
    index = t.customer.select("c_custkey", "c_name", F.right("c_name", F.lit(1)).alias("last"))
    return serve.details_of(index, t.orders.select(F.col("o_custkey").alias("c_custkey"), "o_orderkey"), "c_custkey", "last", "1").drop("last")


def _load():
    from . import documents, minutes, more, pages  # noqa: F401  (they add their queries to this catalogue)


def queries():
    _load()
    return dict(QUERIES)


def oracle_sql():
    _load()
    return dict(SQL)
