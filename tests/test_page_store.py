from pyspark.sql import functions as F

import __spark_entry__
from minutesmith.plans import more
from minutesmith.sources import html


def test_roots_of_one_session_are_all_kept(spark, tmp_path):
    """Two roots with pages of one session, whose keys look like numbers of different kinds: none replaces the other's."""
    for root, entities in (("a", ("1", "2")), ("b", ("3", "9999999999", "x"))):
        for e in entities:
            f = tmp_path / root / "dataset=gian" / "house=shugiin" / "session=7" / f"entity={e}"
            f.mkdir(parents=True)
            (f / "page.html").write_bytes(e.encode() * 3)
    path = str(tmp_path / "pages")
    html.store_roots(spark, [str(tmp_path / "a"), str(tmp_path / "b")], path)
    got = spark.read.parquet(path).select("session", "entity", F.octet_length("content")).collect()
    assert sorted(map(tuple, got)) == [(7, "1", 3), (7, "2", 3), (7, "3", 3), (7, "9999999999", 30), (7, "x", 3)]


def test_page_scan_in_several_roots(spark, monkeypatch):
    """The driver lists a bounded number of files at a time; all pages come through, with few tasks for the many small files."""
    monkeypatch.setattr(more, "FILES", 20)
    sf, seen = "/root/testdata/sf0.001", []
    scan = html.scan_pages
    monkeypatch.setattr(html, "scan_pages", lambda s, root: seen.append(scan(s, root)) or seen[-1])
    got = __spark_entry__.queries()["page_scan"](spark, sf)
    pages = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", (F.octet_length(F.regexp_replace(F.coalesce("html", F.lit("")), "[\r\n]+", " ")) + 1).alias("bytes"))
    assert sorted(map(tuple, got.select("entity", "bytes").collect())) == sorted(map(tuple, pages.collect()))
    assert len(seen) == 3 and max(x.rdd.getNumPartitions() for x in seen) <= 8


def test_page_scan_of_no_pages(spark, tmp_path):
    spark.read.parquet("/root/testdata/sf0.001/pages.parquet").limit(0).write.parquet(str(tmp_path / "pages.parquet"))
    assert __spark_entry__.queries()["page_scan"](spark, str(tmp_path)).collect() == []
