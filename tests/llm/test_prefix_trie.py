"""The prefix trie against one built in memory from rebuilt conversations."""

import hashlib
import random
import re
import zlib

import pytest

from minutesmith.llm import prefix_trie

r = random.Random(11)
SCHEMA = "conv_id long, turn long, role string, text string, depth int, c string, k0 long"
SAID = ["a b", "a  b\tc", None, "", "x", "é é \x0b\x0c y", "w " * 9]


def conversation(c, n, first=0):
    return [(c, first + i, r.choice(["user", "assistant", None]), r.choice(SAID[:3] if i < 3 else SAID), 1, "z", 2) for i in range(n)]


def table():
    rows = []
    for c in [*range(0, 90), *range(121, 130), 200, 203, -7, -40]:
        rows += conversation(c, r.choice([0, 1, 2, 3, 4, 5, 9]))
    rows += conversation(300, 70)
    long = conversation(320, 45)
    rows += long + [(321 + k, t, *x) for k in range(3) for _, t, *x in long[: 40 - 5 * k]]  # copies and prefixes of a long one
    rows += [(400 + k, t, *x) for k in range(19) for _, t, *x in conversation(400, 1)] + [(420 + i, 0, "user", "same", 1, None, 3) for i in range(50)]
    rows += [(500, None, "user", "no turn", 1, None, 3), (500, 0, "user", "a", 1, None, 3), (500, None, "user", "no turn", 1, None, 3), (None, 0, "user", "nobody", 1, None, 3), (501, 0, "user", "y " * 50_000, 1, None, 3)]
    return rows


def brute(rows):
    own = {}
    sha = lambda role, text: hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
    for c, turn, role, text, *_ in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, sha(role or "", text or ""), (role or "", text or "")))
    own = {c: [x[-1] for x in sorted(v)] for c, v in own.items()}
    built = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        built[c] = tuple(own.get(base, [])[:h] + v[h:])
    nodes = {}
    for c, v in built.items():
        for d in range(len(v) + 1):
            nodes.setdefault(v[:d], []).append(c)
    kids, below = {}, {}
    for p in nodes:
        if p:
            kids[p[:-1]] = kids.get(p[:-1], 0) + 1
        for d in range(len(p) + 1):
            below.setdefault(p[:d], []).append(p)
    words = lambda p: len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
    for p, members in nodes.items():
        ends = ",".join(map(str, sorted(c for c in members if len(built[c]) == len(p))))
        yield (min(members), len(p), min(nodes[p[:-1]]) if p else None, len(members), kids.get(p, 0), sum(q not in kids for q in below[p]), sum((len(nodes[q]) - 1) * words(q) for q in below[p]), hashlib.sha256(ends.encode()).hexdigest())


@pytest.mark.parametrize("height,piece", [(32, 1 << 14), (3, 4)])
def test_trie(spark, height, piece):
    rows = table()
    out = prefix_trie.prefix_trie(spark.createDataFrame(rows, SCHEMA).repartition(5), height, piece)
    assert out.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert sorted(map(tuple, out.collect()), key=str) == sorted(brute(rows), key=str)


def test_small(spark):
    assert prefix_trie.prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    for rows in ([(25, 0, "user", "a", 1, None, 3)], [(c, 0, "user", "a", 1, None, 3) for c in range(1, 6)]):  # base absent
        out = prefix_trie.prefix_trie(spark.createDataFrame(rows, SCHEMA))
        assert sorted(map(tuple, out.collect()), key=str) == sorted(brute(rows), key=str)
