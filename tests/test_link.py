"""Links of texts to titles against a plain search of all pairs."""

import random

from pyspark.sql import functions as F

from minutesmith.operators import link

rng = random.Random(5)
TITLES = [(i, "".join(rng.choice("ab") for _ in range(rng.randint(1, 6)))) for i in range(25)] + [(90, ""), (91, None)]
TEXTS = ["".join(rng.choice("ab") for _ in range(rng.randint(0, 8))) for _ in range(120)] + [None, "zz"]


def best(text):
    if not text:
        return None, None
    for kind, hit in (("exact", lambda t: t == text), ("prefix", lambda t: t.startswith(text) or text.startswith(t))):
        ids = [i for i, t in TITLES if t and hit(t)]
        if ids:
            return min(ids), kind
    return None, None


def test_title_link_and_its_plan(spark):
    titles = spark.createDataFrame(TITLES, "i int, t string").withColumn("key", F.upper("t"))
    items = spark.createDataFrame(list(enumerate(TEXTS)), "n int, text string")
    linked = link.title_link(items, link.title_index(titles, "key", "i", "t", "i"), "text", F.upper)
    assert {r.n: (r.id, r.kind) for r in linked.collect()} == {n: best(x) for n, x in enumerate(TEXTS)}
    assert len(TEXTS) == linked.count()
    plan = linked._jdf.queryExecution().executedPlan().toString()
    assert "InMemory" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan
    none = link.title_link(items, link.title_index(titles.where("false"), "key", "i", "t", "i"), "text", F.upper)
    assert none.where("id IS NULL").count() == len(TEXTS)
