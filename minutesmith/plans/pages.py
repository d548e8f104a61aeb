"""Queries on pages and sources. Tables in HTML are made in Spark from table rows; reading them gives the rows back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import html_tables as H
from ..sources import html, tables
from .catalog import KEY, query


def _tr(*cells, tag="td"):
    return F.concat(F.lit("<tr>"), *[x for c in cells for x in (F.lit(f"<{tag}>"), c.cast("string"), F.lit(f"</{tag}>"))], F.lit("</tr>"))


def _rows_by_customer(t, row):
    rows = t.orders.groupBy(F.col("o_custkey").alias(KEY)).agg(F.array_sort(F.collect_list(F.struct("o_orderkey", row.alias("tr")))).alias("r"))
    return rows.select(KEY, F.size("r").alias("n"), F.array_join(F.transform("r", lambda x: x["tr"]), "").alias("body"))


@query("""
WITH o AS (SELECT o_custkey, o_orderkey, o_orderstatus, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS INTEGER) AS row_no FROM orders)
SELECT o_custkey AS c_custkey, row_no, 0 AS col_no, 'c' || o_custkey AS text FROM o UNION ALL SELECT o_custkey, row_no, 1, CAST(o_orderkey AS VARCHAR) FROM o UNION ALL SELECT o_custkey, row_no, 2, o_orderstatus FROM o""")
def html_cells(t):
    x = _rows_by_customer(t, _tr(F.col("o_orderkey"), F.col("o_orderstatus")))
    head = F.concat(F.lit('<table><tr><td rowspan="'), F.col("n").cast("string"), F.lit('">c'), F.col(KEY).cast("string"), F.lit("</td>"), F.substr("body", F.lit(5)))
    return html.html_cells(x.select(KEY, F.concat(head, F.lit("</table>")).alias("html")), KEY).select(KEY, "row_no", "col_no", "text")


@query("SELECT o_orderkey, 1 AS table_no, o_orderstatus AS text FROM orders")
def html_table_pick(t):
    page = F.concat(F.lit("<table>"), _tr(F.lit("その他"), tag="th"), F.lit("</table><table>"), _tr(F.lit("番号"), F.lit("議案件名"), tag="th"), _tr(F.col("o_orderkey"), F.col("o_orderstatus")), F.lit("</table>"))
    x = html.page_tables(t.orders.select("o_orderkey", page.alias("html")))
    x = x.select("o_orderkey", H.pick_by_header(F.col("tables"), ["番号", "件名"]).alias("t"))
    return x.select("o_orderkey", "t.table_no", F.get(F.get("t.rows", 1), 1).alias("cell")).where("cell IS NOT NULL").select("o_orderkey", "table_no", "cell.text")


@query("SELECT o_custkey AS c_custkey, CAST(o_orderkey AS VARCHAR) AS number, o_orderstatus AS title FROM orders")
def header_role_pivot(t):
    odd = F.col("o_custkey") % 2 == 1
    x = _rows_by_customer(t, F.when(odd, _tr(F.col("o_orderstatus"), F.col("o_orderkey"))).otherwise(_tr(F.col("o_orderkey"), F.col("o_orderstatus"))))
    head = F.when(F.col(KEY) % 2 == 1, _tr(F.lit("議案件名"), F.lit("番号"), tag="th")).otherwise(_tr(F.lit("番号"), F.lit("議案件名"), tag="th"))
    cells = html.html_cells(x.select(KEY, F.concat(F.lit("<table>"), head, "body", F.lit("</table>")).alias("html")), KEY)
    return H.header_roles(cells, KEY, {"番号": "number", "件名": "title"}).select(KEY, "number", "title")


@query("SELECT o_orderkey, o_orderpriority AS title, o_orderstatus AS result FROM orders")
def label_value_pivot(t):
    page = F.concat(F.lit("<table>"), _tr(F.lit("項目"), F.lit("内容")), _tr(F.lit("件名"), F.lit("old")), _tr(F.lit("件名"), F.col("o_orderpriority")), _tr(F.lit("結果"), F.col("o_orderstatus")), F.lit("</table>"))
    cells = html.html_cells(t.orders.select("o_orderkey", page.alias("html")), "o_orderkey", spans=False)
    return H.label_values(cells, "o_orderkey", ["件名", "結果"], ["項目"]).select("o_orderkey", F.col("件名").alias("title"), F.col("結果").alias("result"))


@query("SELECT o_orderkey, o_orderstatus AS status, o_orderpriority AS priority FROM orders")
def row_project(t):
    page = F.concat(F.lit("<table>"), _tr(F.lit("x")), _tr(F.col("o_orderkey"), F.col("o_orderstatus"), F.col("o_orderpriority")), F.lit("</table>"))
    rows = H.rows_of(html.html_cells(t.orders.select("o_orderkey", page.alias("html")), "o_orderkey"), "o_orderkey", 3)
    return rows.select("o_orderkey", F.col("cell")[1].alias("status"), F.col("cell")[2].alias("priority"))


@query("SELECT o_custkey AS c_custkey, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS INTEGER) AS record_no, CAST(o_orderkey AS VARCHAR) AS number, o_orderstatus AS status, o_orderpriority AS priority FROM orders")
def row_stitch(t):
    row = F.concat(F.when(F.col("o_orderkey") % 2 == 0, _tr(F.lit("-"))).otherwise(""), _tr(F.col("o_orderkey")), _tr(F.col("o_orderstatus")), _tr(F.col("o_orderpriority")))
    x = _rows_by_customer(t, row)
    rows = H.rows_of(html.html_cells(x.select(KEY, F.concat(F.lit("<table>"), "body", F.lit("</table>")).alias("html")), KEY), KEY, 1)
    r = H.stitch(rows, KEY, F.col("cell")[0].rlike("^[0-9]+$"))
    return r.select(KEY, "record_no", *[F.col("record")[i][0].alias(n) for i, n in enumerate(("number", "status", "priority"))])


@query("""SELECT page_id, len(l) AS n, replace(array_to_string(l, ' '), '&amp;', '&') AS urls, list_filter(l, lambda x: contains(x, '/'))[1] AS first FROM (SELECT page_id, regexp_extract_all(html, '<a [^>]*href="([^"]*)"', 1) AS l FROM pages)""")
def page_links(t):
    x = t.pages.select("page_id", html.links_of(F.col("html")).alias("l"))
    return x.select("page_id", F.size("l").cast("long").alias("n"), F.array_join("l", " ").alias("urls"), H.first_link(F.col("l"), "/").alias("first"))


@query("SELECT page_id, regexp_extract(url, '^([a-z]+://[^/?#]+)', 1) || '/a' AS root, 'http://x.y/z' AS whole FROM pages")
def link_absolute(t):
    u = F.col("url")
    return t.pages.select("page_id", H.absolute(F.lit("/a"), u).alias("root"), H.absolute(F.lit("http://x.y/z"), u).alias("whole"))


@query("SELECT c_custkey, CAST(i AS INTEGER) AS pos, c_name || i AS name, CASE WHEN i < 1 THEN c_mktsegment END AS party FROM customer, (SELECT unnest([0, 1]) AS i)")
def zip_longest(t):
    n = F.array(F.concat("c_name", F.lit("0")), F.concat("c_name", F.lit("1")), F.lit(""))
    return H.zip_longest(t.customer.select(KEY, n.alias("name"), F.array("c_mktsegment").alias("party")), KEY, "name", "party")


@query("SELECT c_custkey, CAST(c_nationkey + 1 AS INTEGER) AS number, c_name AS name FROM customer")
def presenters_lines(t):
    text = F.concat(F.lit("紹介議員一覧\n受理番号 "), (F.col("c_nationkey") + 1).cast("string"), F.lit("番 "), "c_name", F.lit("君\n"))
    return t.customer.select(KEY, F.explode(H.presenters(text)).alias("p")).select(KEY, "p.*")


@query("SELECT c_custkey, c_name || chr(10) || chr(10) || c_mktsegment AS text FROM customer")
def line_compact(t):
    return t.customer.select(KEY, H.compact_lines(F.concat(F.lit("\n \n "), "c_name", F.lit(" \n\n \n\n"), "c_mktsegment", F.lit("\n\n"))).alias("text"))


@query("SELECT o_orderkey % 7 <> 0 AND o_orderstatus <> 'P' AS good, count(*) AS n FROM orders GROUP BY 1")
def quarantine_split(t):
    x = t.orders.select(F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderkey")).alias("id"), F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("status"))
    return x.groupBy(tables.valid(["id", "status"]).alias("good")).agg(F.count("*").alias("n"))


@query("SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS session FROM orders WHERE o_orderstatus <> 'P' ORDER BY 1")
def session_list(t):
    return tables.sessions(t.orders.select(F.when(F.col("o_orderstatus") == "P", F.lit("tmp")).otherwise(F.year("o_orderdate").cast("string")).alias("session")))


@query("""SELECT c_custkey, '{"id":' || c_custkey || CASE WHEN c_custkey % 2 = 0 THEN ',"name":"' || c_name || '"' ELSE ',"name":null' END || '}' AS kept,
'{"id":' || c_custkey || CASE WHEN c_custkey % 2 = 0 THEN ',"name":"' || c_name || '"' ELSE '' END || '}' AS dropped FROM customer""")
def json_nulls(t):
    x = t.customer.select(F.col(KEY).alias("id"), F.when(F.col(KEY) % 2 == 0, F.col("c_name")).alias("name"))
    return x.select(F.col("id").alias(KEY), tables.to_json(True).alias("kept"), tables.to_json(False).alias("dropped"))


@query("SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN '議案の理' WHEN 1 THEN '国 ' WHEN 2 THEN 'あ' WHEN 3 THEN chr(65533) || ' ' ELSE '<meta charset=x-none>国 ' END || c_name AS html FROM customer")
def page_decode(t):
    """Pages in cp932, in EUC-JP (declared, or not), in UTF-8, and in none of these."""

    @F.pandas_udf("binary")
    def written(text, kind):
        kinds = {0: ("議案の理", "cp932"), 1: ("国 ", "euc_jp"), 2: ("あ", "utf-8"), 4: ("<meta charset=x-none>国 ", "euc_jp")}
        return text.combine(kind, lambda x, k: b"\xe3 " + x.encode() if k == 3 else (kinds[k][0] + x).encode(kinds[k][1]))

    k = F.col(KEY) % 5
    x = t.customer.select(KEY, F.when(k == 1, "EUC-JP").alias("declared"), written("c_name", k).alias("content"))
    return html.decode_pages(x, declared="declared").select(KEY, "html")


@query("SELECT url, min(page_id) AS page_id FROM pages GROUP BY 1")
def url_reuse(t):
    return t.pages.groupBy("url").agg(F.min("page_id").alias("page_id"))
