import random
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

import __spark_entry__
from minutesmith.operators import extract
from minutesmith.operators import html_tables as H
from minutesmith.sources import html


class Events(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.said = []

    def handle_starttag(self, tag, attrs):
        self.said.append(("open", tag, attrs))

    def handle_endtag(self, tag):
        self.said.append(("close", tag))

    def handle_comment(self, data):
        self.said.append(("comment", data))

    def handle_data(self, data):
        self.said.append(("data", data))


def test_plain_pages_give_the_events_of_the_parser():
    r = random.Random(7)
    parts = ["<table>", "</table>", "<TR>", "<td rowspan=\"2\" Class='a b'>", "</td >", "<br/>", "<br />", "<td nowrap>", "<a href=\"./x?a=1&amp;b\">", "<a href='y>z'>", "<td colspan=2>", "a &lt; b &amp", "&nbsp;", "a < b", " > ", "<", ">", "<!-- <td> -->", "<!DOCTYPE html>", "<script>if (a<b) '</td>'</script>", "<title>a<b>c</title>", "<p\n id=\"x\"\n>", "</>", "</td x=\"1\">", "<1>", "<td\r\nid=\"q\">", "字\n", "&#x5b57;&", "<a b = \"c\">", "<x-y>"]
    for n in range(4000):
        few = parts if n % 2 else parts[:9] + parts[11:13] + parts[-4:-3]
        page = "".join(r.choice(few) for _ in range(r.randint(0, 12)))
        want = Events()
        want.feed(page)
        want.close()
        assert html.parse(Events(), page).said == want.said, page


def test_pages_are_looked_at_some_at_a_time():
    import pyarrow as pa

    b = pa.RecordBatch.from_arrays([pa.array(range(600)), pa.array(map(str, range(600)))], names=["k", "html"])
    got = list(html._slices(b))
    assert max(len(x) for _, x in got) <= html.PAGES and [int(y) for at, x in got for y in x] == list(range(600)) and [at for at, _ in got] == [0, 256, 512]


#: Exchanges that a query needs to make its pages; reading them takes none, and each page is parsed once.
PLANS = {"upper_petition": 1, "html_table_pick": 0, "table_attributes": 0, "extract_bills": 1, "extract_progress": 0, "status_case": 0, "petition_detail": 0}


@pytest.mark.parametrize("name", PLANS)
def test_pages_are_parsed_once_and_stay_whole(spark, name):
    df = __spark_entry__.queries()[name](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == PLANS[name] and "Join" not in plan and plan.count("MapInArrow") == (2 if name == "petition_detail" else 1)


def tr(*cells):
    return "<tr>" + "".join(f"<td>{x}</td>" for x in cells) + "</tr>"


def test_upper_petition_by_page(spark):
    """A page that comes twice, or without a key, is read as any other; lists without text don't count."""
    page = '<table class="list_c"></table><table class="x list_c">' + tr("新件番号", "1", "件数", "3件", "署名", "1,234名") + tr("5号", "森　一君<br>林君", "甲", "2024年1月5日", "令和六年一月六日", "採択") + tr("6号", "原君", "", "", "", "") + "</table>"
    df = spark.createDataFrame([(1, page), (1, page), (None, page), (2, "<table>" + tr("x") + "</table>"), (3, None)], "k int, html string")
    got = extract.upper_petition(html.page_tables(df, spans=False, more=("lines",))).collect()
    assert sorted(map(repr, (r.k for r in got))) == ["1", "1", "None"]
    for r in got:
        assert (r.accepted_count, r.signer_count, r.outcome) == (3, 1234, "採択") and [(p.number, p.name, p.party, str(p.received_at), str(p.referred_at)) for p in r.presenters] == [(5, "森一", "甲", "2024-01-05", "2024-01-06"), (5, "林", None, "2024-01-05", "2024-01-06"), (6, "原", None, "None", "None")]


def test_first_table_whose_header_holds_all_words(spark):
    page = "<table>" + tr("番号", "x") + "</table><table>" + tr("番号", "議案件名") + tr("1", "a") + "</table><table>" + tr("番号", "件名") + tr("2", "b") + "</table>"
    x = html.page_tables(spark.createDataFrame([(1, page), (1, page), (None, page), (2, None), (3, "<table></table>")], "k int, html string"))
    got = x.select("k", H.pick_by_header(F.col("tables"), ["番号", "件名"]).alias("t")).collect()
    assert [(r.k, r.t and (r.t.table_no, r.t.rows[1][1].text)) for r in got] == [(1, (1, "a")), (1, (1, "a")), (None, (1, "a")), (2, None), (3, None)]


def test_tables_by_id_class_and_heading(spark):
    page = '<table id="list"><tr><td colspan="2">a<td rowspan=2>b</tr><tr><td>c</table><table class="list_c"><tr><td></table><a name="n"></a><h2>請願</h2><table class="z list_c">' + tr("d") + "</table>"
    x = html.page_tables(spark.createDataFrame([(1, page), (2, "")], "k int, html string"))
    t = F.col("tables")
    of = [extract.pick_by_id(t, "list"), extract.pick_last_of_class(t, "list_c"), extract.pick_after_heading(t, "請願")]
    r, none = x.select(*[F.transform(y, H.cells_of).alias(f"c{i}") for i, y in enumerate(of)], of[2].alias("h")).collect()
    assert [[[c.text for c in cells] for cells in r[i]] for i in range(3)] == [[["a", "a", "b", "c", "b"]], [["d"]], [["d"]]]
    assert r.h[0].code == "n" and list(none) == [[], [], [], []]


def test_roles_of_rows(spark):
    """The last header of a role counts; gaps that spans leave have no cell; a row without a cell of any role goes."""
    page = "<table>" + tr("x", "番号", "旧件名", "件名") + tr("0", "1", "a", "b") + '<tr><td>5<td>2<td>c<td rowspan="2">s</tr><tr><td>9</tr>' + tr("only") + "</table>"
    x = html.page_tables(spark.createDataFrame([(1, page)], "k int, html string")).select("k", F.explode("tables").alias("t")).select("k", "t.rows")
    got = [(r.row_no, r.number, r.title) for r in H.role_rows(x, {"番号": "number", "件名": "title"}).collect()]
    assert got == [(1, "1", "b"), (2, "2", "s"), (3, None, "s")]


def test_labels_of_pages(spark):
    page = "<table>" + tr("a", "1") + tr("alone") + tr("", "no label") + tr("a", "2", "3") + "</table><table>" + tr("b", "4") + "</table>"
    df = spark.createDataFrame([(1, page), (1, page), (None, "<p>"), (2, "<table>" + tr("", "x") + "</table>")], "k int, html string")
    read = lambda first: [(r.k, r.v, r.alone, r.filled) for r in html.page_labels(df, first=first).collect()]
    rest = [(None, {}, [], False), (2, {}, [], True)]
    assert read(False) == [(1, {"a": "2 3", "b": "4"}, ["alone"], True)] * 2 + rest
    assert read(True) == [(1, {"a": "2 3"}, ["alone"], True)] * 2 + rest
    assert [r.k for r in extract.progress(html.page_labels(df, first=True)).collect()] == [1, 1]


def test_status_of_questions(spark):
    page = lambda *rows: "<table>" + "".join(rows) + "</table>"
    late = page(tr("提出日", "2024年2月1日"), tr("答弁延期"), tr("1月5日内閣から通知書受領 3月9日まで答弁延期"))
    df = spark.createDataFrame([(1, late), (1, late), (2, page(tr("提出日", ""))), (3, page(tr("答弁書受領日", "2024年2月1日"))), (4, page(tr("", "x"))), (5, "")], "k int, html string")
    got = [(r.k, r.status, str(r.answer_due_at)) for r in extract.question_progress(html.page_labels(df)).collect()]
    assert got == [(1, "答弁延期", "2024-03-09")] * 2 + [(2, "未答弁", "None"), (3, "答弁受理", "None"), (4, "未答弁", "None")]


def test_petition_and_its_summary(spark):
    one, two = "<table>" + tr("件数", "12件") + tr("結果", "") + tr("議員", "1番 森君 2番 林君") + "</table>", "<table>" + tr("総件数", "x") + tr("1,200", "y") + tr("7", "z") + "</table>"
    df = spark.createDataFrame([(1, one, two), (1, one, two), (2, "", two), (3, one, "")], "k int, html string, table string")
    x = extract.petition(html.page_labels(df), "件数", "署名", "結果", "議員")
    assert [r.k for r in x.collect()] == [1, 1, 3]
    got = extract.summary_row(html.page_tables(x, "table"), {"件数": "n"}).collect()
    assert [(r.k, r.receipt_count, r.signer_count, r.outcome, [p.name for p in r.presenters], r.n) for r in got] == [(1, 12, None, None, ["森", "林"], 1200)] * 2
