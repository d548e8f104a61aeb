"""Queries on document pages. Labels and page texts are made in Spark from table rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import documents as D
from ..sources import html
from .catalog import KEY, query


@query("""SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'original_bill' WHEN 1 THEN 'outline' WHEN 2 THEN 'amendment' ELSE 'other' END AS type,
CASE o_orderkey % 4 WHEN 0 THEN '提出時法律案' WHEN 1 THEN '要綱' WHEN 2 THEN '修正案' ELSE o_orderpriority END AS title, CASE WHEN o_orderkey % 4 = 0 THEN o_orderstatus END AS note FROM orders""")
def doc_classify(t):
    k, p = F.col("o_orderkey") % 4, F.col("o_orderpriority")
    label = F.when(k == 0, F.concat(F.lit(" 提出時法律案　("), "o_orderstatus", F.lit(")"))).when(k == 1, F.concat(p, F.lit("要綱"))).when(k == 2, F.concat(F.lit("修正案："), p)).otherwise(p)
    return t.orders.select("o_orderkey", D.classify_document(label).alias("d")).select("o_orderkey", "d.*")


@query("SELECT c_custkey, '第' || c_nationkey || '回' AS session, c_mktsegment AS type, CASE WHEN c_custkey % 2 = 0 THEN c_custkey || '号' END AS number, c_name AS title FROM customer")
def text_meta(t):
    number = F.when(F.col(KEY) % 2 == 0, F.concat(F.lit(" "), F.col(KEY).cast("string"), F.lit("号"))).otherwise("")
    text = F.concat(F.lit("提出回次："), F.lit("第"), F.col("c_nationkey").cast("string"), F.lit("回 議案種類: "), "c_mktsegment", number, F.lit(" 議案名： "), "c_name", F.lit(" 照会できる情報の一覧 本文"))
    return t.customer.select(KEY, D.text_meta(text).alias("m")).select(KEY, "m.*")


@query("""SELECT o_orderkey, CAST(o_orderdate AS DATE) AS question_date, o_orderpriority || '質問主意書' || chr(10) || o_orderstatus AS question,
CAST(o_orderdate AS DATE) AS answer_date, o_orderpriority AS answerer, '答弁書' || chr(10) || o_orderstatus || '答弁書' AS answer FROM orders""")
def doc_sections(t):
    day = F.concat(F.lit("平成"), (F.year("o_orderdate") - 1988).cast("string"), F.date_format("o_orderdate", "年M月d日"))
    q = F.concat(F.lit("第一号質問主意書\n"), day, F.lit("\n"), "o_orderpriority", F.lit("質問主意書\n"), "o_orderstatus")
    a = F.concat(day, F.lit("\n内閣総理大臣 "), "o_orderpriority", F.lit("\n答弁書\n"), "o_orderstatus", F.lit("答弁書"))
    x = t.orders.select("o_orderkey", D.question_document(q).alias("q"), D.answer_document(a).alias("a"))
    return x.select("o_orderkey", F.col("q.date").alias("question_date"), F.col("q.body").alias("question"), F.col("a.date").alias("answer_date"), F.col("a.answerer").alias("answerer"), F.col("a.body").alias("answer"))


@query("SELECT c_custkey, lower(regexp_replace(c_name, '[^A-Za-z0-9]+', '_', 'g')) || '_b_' || c_custkey || '.html' AS key FROM customer")
def url_key(t):
    url = F.concat(F.lit("https://x.y/a/"), F.replace("c_name", F.lit("#"), F.lit("+")), F.lit("/B-"), F.col(KEY).cast("string"), F.lit(".htm?z=1"))
    return t.customer.select(KEY, D.url_key(url).alias("key"))


@query("SELECT c_custkey, lower(regexp_replace(c_name, '[^A-Za-z0-9]+', '-', 'g')) AS slug FROM customer")
def section_slug(t):
    return t.customer.select(KEY, D.section_slug(F.concat("c_name", F.lit("君"))).alias("slug"))


@query("SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN '提出者' WHEN 'O' THEN '答弁者' ELSE o_orderstatus END AS label FROM orders")
def label_lookup(t):
    code = F.when(F.col("o_orderstatus") == "F", "submitter").when(F.col("o_orderstatus") == "O", "answerer").otherwise(F.col("o_orderstatus"))
    return t.orders.select("o_orderkey", D.label_of(code, D.ROLE_LABELS).alias("label"))


@query("""SELECT o_orderkey, 'https://www.shugiin.go.jp/internet/' || CASE WHEN o_orderkey % 300 <= 147 THEN 'itdb_shitsumona' ELSE 'itdb_shitsumon' END || '.nsf/html/shitsumon/kaiji' || lpad(CAST(o_orderkey % 300 AS VARCHAR), 3, '0') || '_l.htm' AS questions,
'https://www.shugiin.go.jp/internet/itdb_gian.nsf/html/gian/kaiji' || (o_orderkey % 300) || '.htm' AS bills FROM orders""")
def source_url(t):
    session = F.col("o_orderkey") % 300
    return t.orders.select("o_orderkey", D.question_list_url(session).alias("questions"), D.bill_list_url(session).alias("bills"))


@query("")
def html_text(t):
    return t.pages.select("page_id", html.text_of(F.col("html")).alias("text"))


@query("SELECT c_custkey, 'Title & more' || chr(10) || c_name || chr(10) || c_mktsegment || ' end' || chr(10) || 'line' || chr(10) || c_custkey AS text FROM customer")
def html_text_parts(t):
    """Text nodes of pages with scripts, comments, references and empty elements, a line each."""
    page = F.concat(F.lit("<html><head><title>Title &amp; more</title><script>var a = '<p>no</p>';</script><style>p {}</style></head><body><!-- no --><p>  "), "c_name", F.lit(" <b></b>\n\n<i>"), "c_mktsegment", F.lit(" end</i><br/>line\n</p><template>no</template><div>"), F.col(KEY).cast("string"), F.lit("</div></body>"))
    return t.customer.select(KEY, html.text_of(page).alias("text"))


@query("""SELECT o_orderkey, o_orderpriority || chr(10) || '答弁書' AS preamble, o_orderstatus || chr(10) || o_orderkey AS body FROM orders""")
def document_halves(t):
    page = F.concat(F.lit("<html><body>top<h1 id='TopContents'>"), "o_orderpriority", F.lit("</h1><div><a href='x'>links</a> menu</div><p>答弁書</p><hr/><p> "), "o_orderstatus", F.lit(" </p><div><p><a href='y'>back</a></p></div><div>"), F.col("o_orderkey").cast("string"), F.lit("</div></body></html>"))
    return t.orders.select("o_orderkey", html.halves_of(page).alias("h")).select("o_orderkey", "h.*")
