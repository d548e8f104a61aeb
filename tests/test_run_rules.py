"""Runs over published tables: which targets are written again, which keep what they have, and when the index stays."""

from pyspark.sql import functions as F

from minutesmith.operators import incremental
from minutesmith.sources import tables

ON = ["dataset", "session", "house"]
TARGET = "dataset string, session int, house string"
WANTED = [("gian", 221, None), ("kaigiroku", 221, None), ("seigan", 221, "shugiin"), ("seigan", 221, "sangiin"), ("seigan", 220, "sangiin")]
DONE = [("gian", 221, None), ("seigan", 221, "sangiin")]
STORED = [x for x in WANTED if x != ("seigan", 220, "sangiin")]


def targets(spark, rows):
    return spark.createDataFrame(rows, TARGET)


def chosen(spark, failed=(), **how):
    x = incremental.to_publish(targets(spark, WANTED), targets(spark, DONE), targets(spark, list(failed)), ON, **how)
    assert x.columns == ON
    return {tuple(r) for r in x.collect()}


def test_published_targets_stay_unless_only_parsed_or_forced(spark):
    stored = targets(spark, STORED)
    assert chosen(spark) == set(WANTED) - set(DONE)
    assert chosen(spark, stored=stored) == set(STORED) - set(DONE)
    assert chosen(spark, stored=stored, parse_only=True) == chosen(spark, stored=stored, force=True) == set(STORED)


def test_failed_target_without_house_is_held_back_alone(spark):
    failed = [("kaigiroku", 221, None), ("seigan", 221, "shugiin")]
    assert chosen(spark, failed) == {("seigan", 220, "sangiin")}
    assert chosen(spark, failed, parse_only=True) == set(WANTED) - set(failed)


def test_rebuild_replaces_tables_and_keeps_failed_ones_and_the_index(spark, tmp_path):
    out, index = str(tmp_path / "out"), str(tmp_path / "index")
    old = spark.createDataFrame([(220, "old"), (221, "old")], "session int, v string")
    tables.publish(old, out, ["session"])
    old.select("v").write.parquet(index)
    fresh = spark.createDataFrame([(220, "new"), (221, "new"), (222, "new")], "session int, v string")
    wanted, failed = fresh.select("session"), fresh.select("session").where("session = 221")
    go = incremental.to_publish(wanted, old.select("session"), failed, ["session"], parse_only=True)
    tables.publish(incremental.restrict(fresh, go), out, ["session"])
    assert {(r.session, r.v) for r in spark.read.parquet(out).collect()} == {(220, "new"), (221, "old"), (222, "new")}
    assert incremental.index_if_sound(fresh, failed).count() == 0
    assert incremental.index_if_sound(fresh, failed.where(F.lit(False))).count() == 3
