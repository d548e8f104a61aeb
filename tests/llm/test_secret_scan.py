"""The secret scan against the contract's patterns and a plain pairwise version of the links."""

import hashlib
import random
import re

import pytest

from minutesmith.llm import secret_scan

KEY = "AKIA" + "Q7" * 9
MIXED = "aZ3" * 12
PARTS = [
    "password: hunter22", "token = 'abc'", 'api_key="q/w+e.r-t=_y"', "SECRET:x", "secret=token: abcdefgh", "ToKen :  abcdef", "apikey='12345", KEY, "AKIASHORT", "xx" + KEY, "0123456789abcdef" * 2, "deadbeef" * 2, "beef" * 9 + "G",
    MIXED, "z" * 30, MIXED + "==", "user = alice", "login:'bob.b'", "client_id=c17", "key_id: ab", "pwd: rosebud", "pass=abc", "host = db.example.net", "https://api.example.net/v1?x=1", "jdbc:pg://h/x", "bucket: raw-data", "\n\n", "\n \t\n", "\f", "ü" * 40, "plain words here", "\n", "🙂", "user=" + KEY, "token=" + MIXED,
]


def base(t):
    out = [("assign", m.start(), m.end()) for m in re.finditer(r"""(?ia)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t) if len(m[2]) >= 6]
    out += [("access", m.start(), m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    return out + [("hex", m.start(), m.end()) for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 24]


def brute(t):
    """Every pair of parts in a scope is looked at."""
    t = t or ""
    strong, weak = base(t), []
    finds = lambda p: re.finditer(p.replace("(?i)", "(?ia)"), t)
    weak += [("identifier", m.start(), m.end()) for m in finds(secret_scan.IDENTIFIER) if len(m[2]) >= 3]
    weak += [("weak", m.start(), m.end()) for m in finds(secret_scan.WEAK) if all(re.search(c, m[0]) for c in ("[a-z]", "[A-Z]", "[0-9]"))]
    weak += [("weak", m.start(), m.end()) for m in finds(secret_scan.PHRASE) if len(m[2]) >= 4]
    weak += [("endpoint", m.start(), m.end()) for m in finds(secret_scan.ENDPOINT)]
    weak = [w for w in weak if not any(b[1] < w[2] and w[1] < b[2] for b in strong)]
    cuts = [m.start() for m in re.finditer(secret_scan.CUT, t)]
    scope = lambda x: sum(c < x[1] for c in cuts)
    parts = strong + weak

    def near(x, *kinds):
        return any(y is not x and y[0] in kinds and scope(x) == scope(y) and y[1] - x[2] <= secret_scan.REACH and x[1] - y[2] <= secret_scan.REACH for y in parts)

    out = list(strong)
    for w in weak:
        if w[0] == "weak":
            ok = near(w, "access") or near(w, "identifier") and near(w, "endpoint")
        elif w[0] == "identifier":
            ok = near(w, "assign") or near(w, "weak", "hex") and near(w, "endpoint")
        else:
            ok = near(w, "access", "identifier") and near(w, "assign", "weak", "hex")
        out += [w] if ok else []
    write = lambda xs: ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted((a, secret_scan.KINDS.index(k), k, b) for k, a, b in xs))
    return (*[sum(k == n for n, *_ in strong) for k in secret_scan.BASE], hashlib.sha256(write(strong).encode()).hexdigest(), write(out))


@pytest.fixture(scope="module")
def rows():
    r = random.Random(12)
    texts = [None, "", "\n\n", *PARTS]
    texts += ["".join(r.choice(PARTS) + r.choice([" ", "\n", " " * 200, ", "]) for _ in range(r.randint(1, 14))) for _ in range(400)]
    texts += ["words " * 60_000 + f"user=anna host=db.x.org pass: {'rosebud'}" + " words" * 1000, "token=abcdefg " * 3000]
    return [(i, t, "en", i, "x", 1) for i, t in enumerate(texts)] + [(4, texts[4], None, None, None, None), (None, PARTS[0], None, None, None, None)]


SCHEMA = "doc_id long, text string, lang string, start long, kind string, rid int"


def test_secret_scan(spark, rows):
    out = secret_scan.secret_scan(spark.createDataFrame(rows, SCHEMA).repartition(3))
    assert out.columns == ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted(map(tuple, out.collect()), key=key) == sorted([(d, *brute(t)) for d, t, *_ in rows], key=key)
    assert secret_scan.secret_scan(spark.createDataFrame([], SCHEMA)).count() == 0


def test_links(spark):
    """Weak parts are told only beside their complements, in one scope and within reach."""
    texts = [f"{KEY} {MIXED}", MIXED, f"{KEY}\n\n{MIXED}", f"{KEY}{' ' * 400}{MIXED}", "user=anna pass=rosebud", "user=anna pass=rosebud host=db.example.net", "see https://example.net/a and user=anna"]
    out = secret_scan.secret_scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    kinds = {r.doc_id: [x.split(":")[0] for x in r.spans.split(",") if x] for r in out.collect()}
    assert kinds == {0: ["access", "weak"], 1: [], 2: ["access"], 3: ["access"], 4: [], 5: ["identifier", "weak", "endpoint"], 6: []}


def test_no_python_workers(spark, rows):
    plan = secret_scan.secret_scan(spark.createDataFrame(rows, SCHEMA))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
