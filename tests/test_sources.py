import datetime as dt
import json

from pyspark.sql import functions as F

from minutesmith.functions import documents as D
from minutesmith.operators import html_tables as H
from minutesmith.sources import html, tables
from minutesmith.streaming.ingest import ingest


def test_page_scan_and_decode(spark, tmp_path):
    d = tmp_path / "gian" / "shugiin" / "221"
    d.mkdir(parents=True)
    (d / "list.html").write_bytes("議案".encode("cp932"))
    (tmp_path / "gian" / "shugiin" / "tmp").mkdir()
    (tmp_path / "gian" / "shugiin" / "tmp" / "detail.v2.html").write_bytes(b'<meta charset="euc_jp">\x81\n')
    pages = html.decode_pages(html.page_scan(spark, str(tmp_path))).orderBy("kind").collect()
    assert [(r["dataset"], r["house"], r["session"], r["kind"]) for r in pages] == [("gian", "shugiin", None, "detail.v2"), ("gian", "shugiin", 221, "list")]
    assert pages[1]["html"] == "議案" and "�" in pages[0]["html"]


def test_read_json_keeps_bad_records_apart(spark, tmp_path):
    (tmp_path / "1.json").write_text(json.dumps({"session": 1, "items": [{"id": 5}, {"id": 7}]}))
    (tmp_path / "2.json").write_text('{"session": "x", "items": 3}')
    (tmp_path / "3.json").write_text("{")
    (tmp_path / "4.json").write_text(json.dumps({"session": 4, "items": []}))
    x = tables.read_json(spark, str(tmp_path), "session int, items array<struct<id:int>>").cache()
    assert x.where("_bad IS NOT NULL").count() == 2
    got = tables.items(x.where("_bad IS NULL"), ["session"]).orderBy("pos").collect()
    assert [tuple(r) for r in got] == [(1, 0, 5), (1, 1, 7)]
    good, bad = tables.quarantine(x, ["session"])
    assert good.where("_bad IS NULL").count() == 2 and bad.where("session IS NOT NULL").count() == 0


def test_publish_replaces_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "out")
    tables.publish(spark.createDataFrame([(1, "a"), (2, "b")], "session int, v string"), path, ["session"])
    tables.publish(spark.createDataFrame([(2, "c"), (3, "d")], "session int, v string"), path, ["session"])
    assert sorted(map(tuple, spark.read.parquet(path).select("session", "v").collect())) == [(1, "a"), (2, "c"), (3, "d")]


def test_ingest_reads_each_file_once(spark, tmp_path):
    src, out, mark = (str(tmp_path / n) for n in ("src", "out", "mark"))
    schema = "id int, at timestamp"
    rows = lambda *ids: spark.createDataFrame([(i, dt.datetime(2026, 1, 1, i)) for i in ids], schema)
    rows(1, 2, 2).write.parquet(src)
    ingest(spark, src, schema, out, mark, "id", "at")
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == [1, 2]
    rows(2, 3).write.mode("append").parquet(src)
    ingest(spark, src, schema, out, mark, "id", "at")
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == [1, 2, 3]


def test_spans_captions_and_nested_tables(spark):
    page = '<table><caption> 衆法の一覧 </caption><tr><th colspan=2>a</th><th rowspan="2">b</th></tr><tr><td>c<td><a href="./x">d</a></tr><tr><td> </td></tr></table><table><tr><td>e</table>'
    df = spark.createDataFrame([(1, page), (2, None), (3, ""), (4, "<td>loose<tr>")], "k int, html string")
    cells = html.html_cells(df, "k").cache()
    got = sorted((r["table_no"], r["row_no"], r["col_no"], r["text"], tuple(r["hrefs"])) for r in cells.collect())
    assert got == [(0, 0, 0, "a", ()), (0, 0, 1, "a", ()), (0, 0, 2, "b", ()), (0, 1, 0, "c", ()), (0, 1, 1, "d", ("./x",)), (0, 1, 2, "b", ()), (1, 0, 0, "e", ())]
    assert {(r["table_no"], r["category"]) for r in H.pick_by_caption(cells, "の一覧").collect()} == {(0, "衆法")}


def test_relative_links(spark):
    cases = [("./a.htm", "http://h/x/y/m.htm", "http://h/x/y/a.htm"), ("../a.htm", "http://h/x/y/m.htm", "http://h/x/a.htm"), ("a.htm", "http://h", "http://h/a.htm"), ("../a", "http://h/m", "http://h/a"), ("../../a", "http://h/x/y/z/m", "http://h/x/a"), ("../../../a", "http://h/x/m", "http://h/a"), ("mailto:a@b", "http://h/x", "mailto:a@b"), ("//o/p", "https://h/x", "https://o/p"), ("#f", "http://h/x#e", "http://h/x#f"), ("?q=1", "http://h/x/y?z#e", "http://h/x/y?q=1"), ("/r", "https://h/x?q=/z", "https://h/r"), ("https://o/p", "http://h/x", "https://o/p")]
    df = spark.createDataFrame(cases, "u string, b string, want string")
    assert [(r["u"], r["got"]) for r in df.select("u", "want", H.absolute(F.col("u"), F.col("b")).alias("got")).collect()] == [(u, w) for u, _, w in cases]


def test_clean_text_edges(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "a &lt; b<br>c<template>t</template>\n\n d ")], "k int, h string")
    assert [r[0] for r in df.orderBy("k").select(html.text_of(F.col("h"))).collect()] == ["", "", "a < b\nc\nd"]


def test_document_edges(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "x\ny")], "k int, t string").orderBy("k")
    r = df.select(D.question_document(F.col("t")).alias("q"), D.answer_document(F.col("t")).alias("a"), D.url_key(F.col("t")).alias("u"), D.text_meta(F.col("t")).alias("m")).collect()
    assert [x["q"]["body"] for x in r] == [None, None, "x\ny"] and [x["a"]["answerer"] for x in r] == [None] * 3
    assert r[1]["u"] == "document_item.html" and all(v is None for x in r for v in x["m"])
