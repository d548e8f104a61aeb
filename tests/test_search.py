"""Search by grams equals a scan, and pages equal a sorted list; both read a part of what is written."""

import random

from pyspark.sql import functions as F

from minutesmith.operators import search

r = random.Random(9)


def test_gram_search(spark, tmp_path):
    names = ["".join(r.choice("山田太郎一ab") for _ in range(r.randint(0, 6))) for _ in range(150)]
    rows = [(f"{n}{i}", [r.choice(names), None] if i % 3 else None) for i, n in enumerate(names)] + [("aaaa", ["aaaaaa"]), ("", [])]
    df, path = spark.createDataFrame(rows, "k string, v array<string>"), str(tmp_path / "grams")
    search.write_grams(df, path, "k", "v")
    terms = ["山", "aa", "aaa", "aaaaa", "a山", "", " 太郎 ", "太郎一", "x", *["".join(r.choice("山田太郎ab1") for _ in range(r.randint(1, 3))) for _ in range(12)]]
    for term in terms:
        want = {k for k, v in rows if term.strip() and any(term.strip() in h for h in [k, *[x for x in v or [] if x is not None]])}
        assert {x.key for x in search.gram_hits(spark, path, term).collect()} == want, term
    first = search.gram_search(spark, path, "aaaa", 0, 2).collect()
    assert first[0].key == "aaaa"
    plan = search.gram_hits(spark, path, "山田太")._jdf.queryExecution().executedPlan().toString()
    assert "In(gram, [" in plan  # row groups of other grams are skipped


def test_pages(spark, tmp_path):
    rows = [(i, r.choice("abcde"), r.random()) for i in range(1000)]
    df, path = spark.createDataFrame(rows, "id int, a string, b double").repartition(5), str(tmp_path / "pages")
    order = [F.desc("a"), F.col("id").cast("string")]
    search.write_pages(df, path, order, 16)
    want = [x[0] for x in sorted(rows, key=lambda x: (-ord(x[1]), str(x[0])))]
    for offset, limit in ((0, 100), (730, 100), (995, 100), (1000, 100), (-5, 3), (0, 5000)):
        page = search.read_page(spark, path, offset, limit)
        got = page.collect()
        at = max(0, offset)
        assert [x.id for x in got] == want[at : at + min(limit, 1000)] and {x.total for x in got} <= {1000}
        assert [x.place for x in got] == list(range(at, at + len(got)))
    page = search.read_page(spark, path, 730, 100)
    page.collect()
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan and "Exchange rangepartitioning" not in plan
    search.write_pages(df.limit(0), path, order, 4)
    assert search.read_page(spark, path).count() == 0
