"""Page outlines and what is read from them."""

from pyspark.sql import functions as F

from minutesmith.operators import extract
from minutesmith.sources import html


def test_outline(spark):
    page = '<h1>A &amp; B</h1><a href="x">one<br>two</a><h3>c</h3><table><caption>t\n1</caption><tr><td><a href="">in</a><table></table></td></tr></table><h2>d</h2><a name="n">none</a><a href="y"><img></a><h2>e<a href="#">f</a></h2><table></table>'
    rows = [(1, page), (2, None), (3, ""), (4, "<a href='z'>never closed"), (1, "<table>")]
    got = html.outline(spark.createDataFrame(rows, "k int, html string"), "k").collect()
    assert sorted(map(tuple, got), key=repr) == sorted([
        (1, 0, "link", ["A & B"], None, "one two", "x"), (1, 1, "table", ["A & B", "c"], 0, "t 1", None), (1, 2, "link", ["A & B", "c"], None, "in", ""), (1, 3, "table", ["A & B", "c"], 1, "", None),
        (1, 4, "link", ["A & B", "d"], None, "", "y"), (1, 5, "link", ["A & B"], None, "f", "#"), (1, 6, "table", ["A & B", "ef"], 2, "", None), (4, 0, "link", [], None, "", "z"), (1, 0, "table", [], 0, "", None),
    ], key=repr)


def test_document_list(spark):
    page = '<a href="../up.htm">up</a><h2>一覧</h2><a href="./a/b-1.htm">修正案第一号：甲<br>乙 (可決)</a><a href="./c.htm"></a>'
    got = extract.document_list(html.outline(spark.createDataFrame([(1, page)], "k int, html string"), "k"), "k", F.lit("https://x.y/d/e.htm")).orderBy("pos").collect()
    assert [(r.section, r.label, r.type, r.title, r.note, r.url, r.file_key) for r in got] == [("一覧", "修正案第一号：甲 乙 (可決)", "amendment", "修正案第一号", "可決", "https://x.y/d/a/b-1.htm", "a_b_1.html"), ("一覧", "", "other", None, None, "https://x.y/d/c.htm", "d_c.html")]


def test_extra_sections(spark):
    tr = lambda *c: "<tr>" + "".join(f"<td>{x}</td>" for x in c) + "</tr>"
    main = f"<table>{tr('項目', '内容')}{tr('議案提出者一覧', 'main')}</table>"
    pages = [(1, main), (2, f"{main}<table><caption>議案提出者</caption>{tr('議案提出者一覧', '甲; 乙')}</table><table>{tr('', 'x')}</table>"), (3, f"{main}<table>{tr('議案提出の賛成者', '丙', '丁')}{tr('other', '')}</table>"), (4, f"{main}<table>{tr('議案提出者一覧', '')}</table>")]
    cells = html.html_cells(spark.createDataFrame(pages, "k int, html string"), "k", spans=False)
    x = extract.extra_sections(cells, "k")
    got = {r.k: r for r in x.select("k", "sections", extract.member_law(F.col("sections")).alias("m")).collect()}
    assert set(got) == {2, 3, 4} and got[4].m is None
    assert [(s.section_name, [tuple(e) for e in s.entries]) for s in got[2].sections] == [("議案提出者", [("議案提出者一覧", "甲; 乙")])]
    assert tuple(got[2].m) == (["甲", "乙"], []) and tuple(got[3].m) == ([], ["丙 丁"])
    assert [tuple(e) for e in got[3].sections[0].entries] == [("議案提出の賛成者", "丙 丁"), ("other", "")]
