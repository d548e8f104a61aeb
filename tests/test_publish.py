"""Publishing: merged streams, checks inside the write, strict assembly, metadata from footers, details by path."""

import shutil

import pytest
from pyspark.sql import functions as F

from minutesmith.operators import entity
from minutesmith.sources import tables
from minutesmith.streaming import ingest

SCHEMA = "id int, session int, v string, built int"


def put(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/in")


def run(spark, folder, whole=False):
    ingest.publish_stream(spark, f"{folder}/in", SCHEMA, f"{folder}/out", f"{folder}/state", ["id"], "session", "built", whole)
    return sorted(tuple(r) for r in spark.read.parquet(f"{folder}/out").select("id", "session", "v", "built").collect())


def test_stream_merges_touched_sessions(spark, tmp_path):
    put(spark, tmp_path, [(1, 10, "a", 1), (2, 10, "b", 1), (3, 11, "c", 1), (4, 12, "d", 1)])
    assert len(run(spark, tmp_path)) == 4
    still = {p: p.stat().st_mtime_ns for p in (tmp_path / "out" / "session=11").iterdir()}
    put(spark, tmp_path, [(2, 10, "new", 2), (5, 12, "e", 2), (5, 12, "older", 1), (1, 10, "too old", 0), (6, 13, None, None)])
    want = [(1, 10, "a", 1), (2, 10, "new", 2), (3, 11, "c", 1), (4, 12, "d", 1), (5, 12, "e", 2), (6, 13, None, None)]
    assert run(spark, tmp_path) == want
    assert {p: p.stat().st_mtime_ns for p in (tmp_path / "out" / "session=11").iterdir()} == still  # not written again
    assert run(spark, tmp_path) == want  # no new files
    # the batch was merged but not committed: it comes again, with or without its mark
    for mark in (True, False):
        for p in (tmp_path / "state" / "commits").glob("*1*"):
            p.unlink()
        if not mark:
            for p in (tmp_path / "state" / "merged").glob("*1*"):
                p.unlink()
        assert run(spark, tmp_path) == want
    # in one run, from nothing: the same rows
    shutil.rmtree(tmp_path / "out")
    shutil.rmtree(tmp_path / "state")
    assert run(spark, tmp_path) == want


def test_stream_of_whole_lists(spark, tmp_path):
    put(spark, tmp_path, [(1, 10, "a", 1), (2, 10, "b", 1), (3, 11, "c", 1)])
    run(spark, tmp_path, True)
    put(spark, tmp_path, [(2, 10, "b2", 5), (9, 11, "stale", 0)])
    assert run(spark, tmp_path, True) == [(2, 10, "b2", 5), (3, 11, "c", 1)]


def test_strict_assembly_names_the_miss(spark):
    rows, pages = spark.createDataFrame([("x",), ("y",)], "k string"), spark.createDataFrame([("x", 1)], "k string, page int")
    assert entity.assemble(rows, pages, "k", "inner").count() == 1 and entity.assemble(rows, pages, "k", "misses").collect()[0].k == "y"
    with pytest.raises(Exception, match="no page for k y"):
        entity.assemble(rows, pages, "k", "strict").collect()
    assert entity.assemble(rows.where("k = 'x'"), pages, "k", "strict").collect() == [("x", 1)]


def test_checks_inside_the_write(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, 10, "https://x.y/a"), (2, 10, None), (3, 11, "no address"), (4, 11, "http://x.y/b")], "id int, session int, url string")
    skip = {"no url": F.col("url").isNotNull(), "bad url": F.try_parse_url("url", F.lit("HOST")).isNotNull()}
    assert tables.publish_checked(rows, path, ["session"], skip, {"no id": F.col("id").isNotNull()}) == {"read": 4, "written": 2, "no url": 1, "bad url": 1}
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [1, 4]
    more = rows.unionAll(spark.createDataFrame([(None, 12, "https://x.y/c")], rows.schema))
    with pytest.raises(Exception, match=r"no id: \{\"session\":12"):
        tables.publish_checked(more, path, ["session"], skip, {"no id": F.col("id").isNotNull()})
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [1, 4]


def test_meta_from_footers(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, "shugiin", 10, 5), (2, "shugiin", 11, 9), (3, "sangiin", 10, 7)], "id int, house string, session int, built int")
    tables.publish(rows, path, ["house", "session"])
    meta = tables.published_meta(spark, {"bills": path}, "built")
    assert sorted(map(tuple, meta.collect())) == [("bills", "sangiin", [10], 1, 7), ("bills", "shugiin", [10, 11], 2, 9)]
    plan = meta._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*), MAX(built)]" in plan and "PushedGroupBy: [house, session]" in plan
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


def test_details_by_path(spark, tmp_path):
    for where, text in {"bills/shugiin/10/a.json": '{"title": "x", "house": "other"}', "bills/sangiin/session=11/b.json": '{"title": "y"}', "bills/shugiin/10/bad.json": "{", "bills/shugiin/tmp/c.json": '{"title": "z"}'}.items():
        p = tmp_path / where
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_text(text)
    read = lambda *s: sorted((tuple(r) for r in tables.read_details(spark, str(tmp_path), "title string", *s).where("_bad IS NULL").drop("_bad").collect()), key=repr)
    assert read() == [("bills", "sangiin", 11, "b", "y"), ("bills", "shugiin", 10, "a", "x"), ("bills", "shugiin", None, "c", "z")]
    assert read([11]) == [("bills", "sangiin", 11, "b", "y")] and read([12]) == []
    # of four files the one of the session is opened
    plan = tables.read_details(spark, str(tmp_path), "title string", [11])
    plan.collect()
    scan = plan._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert scan.metrics().get("numFiles").get().value() == 1
