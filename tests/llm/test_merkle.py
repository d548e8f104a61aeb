"""The Merkle manifest against a plain one that keeps whole trees in memory."""

import hashlib
import random
import zlib

import pytest

from minutesmith.llm import merkle

r = random.Random(13)
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf string, idx int, n int"
TEXTS = [None, "", "a", "ÀB\n🙂", "x" * 300_000, *["".join(r.choice("abc ") for _ in range(30)) for _ in range(8)]]
ROWS = [(i, r.choice(TEXTS), r.choice(["en"] * 6 + ["de", None, "ü", ""]), r.choice(["s", None, "-"]), r.choice([None, -1, 0, 2**63 - 1, 17]), "leaf", 1, 2) for i in r.sample(range(10**6), 300)]
ROWS += [ROWS[0], ROWS[1], ROWS[2], (ROWS[3][0], "other", *ROWS[3][2:]), (None, "a", "en", None, None, None, None, None), (None, None, None, None, 3, None, None, None), (5, "only", "zz", "s", 4, None, None, None)]


def H(*p):
    return hashlib.sha256("".join(p).encode()).hexdigest()


def tree(hashes):
    out = [hashes]
    while len(out[-1]) > 1:
        out.append([H(*out[-1][i : i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


def brute(rows):
    leaf = lambda *f: H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in f))
    langs = {}
    for d, text, lang, source, n, *_ in rows:
        langs.setdefault(lang, []).append((d is not None, d or 0, leaf(d, source, lang, n, text), d, leaf(d, source, lang, None if n is None else n + 1, text)))
    trees = {x: (sorted(v), tree([e[2] for e in sorted(v)])) for x, v in langs.items()}
    order = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    top = tree([trees[x][1][-1][0] for x in order])
    for k, x in enumerate(order):
        for i, (_, _, h, d, other) in enumerate(trees[x][0]):
            proof, now = [], other if d is not None and zlib.crc32(str(d).encode()) % 7 == 0 else h
            for lv, at in ((trees[x][1], i), (top, k)):
                for row in lv[:-1]:
                    if at ^ 1 < len(row):
                        proof.append(row[at ^ 1])
                        now = H(row[at ^ 1], now) if at & 1 else H(now, row[at ^ 1])
                    else:
                        now = H(now)
                    at >>= 1
            yield d, h, trees[x][1][-1][0], top[-1][0], H(*proof), now, now == top[-1][0]


def by_null(rows):
    return sorted(map(tuple, rows), key=lambda t: (t[0] is None, t[0] or 0, *t[1:]))


@pytest.mark.parametrize("band", [8, 2, 1])
def test_manifest(spark, band):
    out = merkle.manifest(spark.createDataFrame(ROWS, SCHEMA).repartition(3), band)
    assert out.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    got = by_null(out.collect())
    assert got == by_null(brute(ROWS))
    assert {bool(g[-1]) for g in got} == {True, False}


def test_small(spark):
    assert merkle.manifest(spark.createDataFrame([], SCHEMA)).count() == 0
    many = [(i, "t", f"l{i:03}", None, 1, None, None, None) for i in range(70)]  # more languages than a subtree has leaves
    for rows in (ROWS[:1], many):
        assert by_null(merkle.manifest(spark.createDataFrame(rows, SCHEMA), 3).collect()) == by_null(brute(rows))
