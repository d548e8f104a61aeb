"""Each operator against brute force on small tables with nulls, empty and long texts, ties, repeats and odd columns."""

import hashlib
import random
import zlib

import duckdb
import numpy as np
import pytest

from minutesmith.llm import ann, bpe, exact_dedup, html_extract, jaccard_join, license_scan, lm_score, packing, suffix_dedup, toxicity

rng = random.Random(3)
WORDS = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(60)]


def prose(n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def edited(text):
    w = text.split()
    w[len(w) // 2] = "edit"
    return " ".join(w)


BASE = [prose(rng.randint(1, 120)) for _ in range(40)]
PASSAGE = prose(30)
TEXTS = [*BASE, *BASE[:6], *[edited(x) for x in BASE[6:14]], PASSAGE + " " + prose(20), prose(9) + " " + PASSAGE, None, "", " \n", "ÀB àb", "x" * 3000, BASE[0].upper()]
ROWS = [(i, t, "en", 1.5) for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], "en", 1.5), (None, BASE[1], None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string, lang string, score double").repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, score double")


def test_bpe(docs, empty):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(bpe.vocabulary_path(None))
    for limit in (bpe.LONG_CHARS, 300):
        got = sorted((r.doc_id is None, r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.bpe_roundtrip(docs, long_chars=limit).collect())
        want = []
        for d, x, *_ in ROWS:
            ids = t.encode(x or "", add_special_tokens=False).ids
            want.append((d is None, d, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
        assert got == sorted(want)
    assert bpe.bpe_roundtrip(empty).count() == 0


def test_bpe_tree():
    e = bpe.Encoder(leaf=16)
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(bpe.vocabulary_path(None))
    for _ in range(30):
        x = "".join(rng.choice("theinаr") for _ in range(rng.randint(1, 400)))
        assert e.encode(x) == t.encode(x, add_special_tokens=False).ids


def test_bpe_letters():
    """Every code point of the first blocks alone between letters, and random strings below U+0250."""
    from tokenizers import Tokenizer

    e, t, r = bpe.Encoder(), Tokenizer.from_file(bpe.vocabulary_path(None)), random.Random(5)
    for at in range(0, 0x3000, 64):
        x = " ".join(f"{chr(c)} a{chr(c)}B {chr(c)}{chr(c)}" for c in range(at, at + 64))
        assert e.encode(x) == t.encode(x, add_special_tokens=False).ids, hex(at)
    for _ in range(10_000):
        x = "".join(chr(r.randrange(0x20, 0x250)) if r.random() < 0.5 else r.choice("abIE 1.") for _ in range(r.randint(1, 30)))
        assert e.encode(x) == t.encode(x, add_special_tokens=False).ids, x


def test_html(spark):
    h = '<html><head><title>t</title><script>var a="</p>";</script></head><body><nav><a href=x>Home</a></nav><div class="cookie-notice">We use cookies</div><article><h1>A &amp; B</h1><p>One two\n three.<div class="ad">Buy now</div><p>Four <b>five</b> six seven.</article><section id="comments"><p>nice words here</p></section><footer>&copy; me</footer></body></html>'
    rows = [(1, "u", h), (2, None, None), (3, "u", ""), (1, "u", h), (4, "u", "<p>Only some plain words.")]
    out = sorted((r.page_id, r.text, r.n_chars) for r in html_extract.html_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect())
    want = "A & B\nOne two three.\nFour five six seven."
    assert out == [(1, want, len(want))] * 2 + [(2, "", 0), (3, "", 0), (4, "Only some plain words.", 22)]


@pytest.mark.parametrize("tag", ["<div>", '<div class="story k">', '<article class="a">'])
def test_html_nesting(tag):
    """Cost grows in proportion to nesting, with classes as well, and so does the text that is found."""
    import time

    took = []
    for n in (4_000, 32_000):
        page = f"{tag}word " * n + "</div>" * n
        t = time.process_time()
        assert html_extract.extract(page).count("word") == n
        took.append(time.process_time() - t)
    assert took[1] < 20 * took[0] and took[1] < 5


def test_html_words_by_feature(spark):
    """A feature counts the words below its elements once, however often it is nested."""
    page = '<div class="a b"><p>one two</p><div class="a" id="b c"><article><p class="a d">three <b class="e">four</b></p></article></div></div><p class="e">five'
    got = {r.feature: (r.yes, r.no) for r in html_extract.evidence(spark.createDataFrame([(page,), (page,)], "html string")).collect()}
    assert got == {"": (4, 6), ".a": (4, 4), ".b": (4, 4), ".c": (4, 0), "article": (4, 0), ".d": (4, 0), ".e": (0, 2)}  # a block belongs where it begins


def test_html_learned(spark):
    """A class with much inside content and far more outside is boilerplate, one with far more inside is content, and rare
    classes of many sites count as well."""
    page = '<div class="quux">%s</div><article><p>%s</p><div class="quux">%s</div></article><div class="rim">%s</div>'
    rows = [(i, "u", page % ("menu " * 300, "word " * 900, "more " * 20, "x " * 20)) for i in range(30)]
    rows += [(i, "u", f'<div class="own{"abcdefghij"[i % 10]}{"klmnopqrst"[i // 10 % 10]}{"uvwxyz"[i // 100 % 6]}">some menu here</div><article class="prose"><p>one two</p></article>') for i in range(6000)]
    rows += [(9001, "u", '<p>Plain words come first.</p><div class="quux">all of this is menu</div>'), (9002, "u", '<div class="ownakv">rare menu words</div><p>Plain words of a text that is longer.')]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    out = {r.page_id: r.text for r in html_extract.html_text(pages).where("page_id > 9000").collect()}
    assert out == {9001: "Plain words come first.", 9002: "Plain words of a text that is longer."}


def fold(x):
    return (x or "").encode().lower().decode()


@pytest.mark.parametrize("block,bits", [(4096, 64), (7, 3)])
def test_exact(docs, empty, block, bits):
    low = lambda d: -1 if d is None else d
    groups = {}
    for d, x, *_ in ROWS:
        groups.setdefault(fold(x), []).append(d)
    got = exact_dedup.exact_dedup(docs, block, bits).collect()
    for r in got:
        assert r.group_size == sum(len(g) for k, g in groups.items() if hashlib.sha256(k.encode()).hexdigest() == r.text_sha256)
    assert sorted((low(r.doc_id), low(r.keep_id)) for r in got) == sorted((low(d), max(low(y) for y in groups[fold(x)])) for d, x, *_ in ROWS)
    assert sum(r.kept for r in got) == len(groups)
    assert exact_dedup.exact_dedup(empty).count() == 0
    assert exact_dedup.keep_first_of_copies(docs).count() == len(groups)


@pytest.mark.parametrize("width,gram", [(50, 24), (12, 5)])
def test_suffix(docs, empty, width, gram):
    big = suffix_dedup.NULL_ID
    first = {}
    for d, x, *_ in ROWS:
        b = (x or "").encode()
        for i in range(len(b) - width + 1):
            first[b[i : i + width]] = min(first.get(b[i : i + width], big), big if d is None else d)
    want = []
    for d, x, *_ in ROWS:
        b, gone = (x or "").encode(), bytearray(len(x.encode()) if x else 0)
        for i in range(len(b) - width + 1):
            if first[b[i : i + width]] < (big if d is None else d):
                gone[i : i + width] = b"\1" * width
        runs = sum(1 for i in range(len(gone)) if gone[i] and not (i and gone[i - 1]))
        want.append((-1 if d is None else d, len(b), sum(gone), runs, hashlib.sha256(bytes(c for c, g in zip(b, gone) if not g)).hexdigest()))
    got = [(-1 if r.doc_id is None else r.doc_id, *tuple(r)[1:]) for r in suffix_dedup.suffix_dedup(docs, width, gram, 1 << 12).collect()]
    assert sorted(got) == sorted(want)
    assert suffix_dedup.suffix_dedup(empty).count() == 0


def test_packing(docs, empty):
    got = packing.pack(docs, window=64, step=4).collect()
    e, seqs = bpe.Encoder(), {}
    for r in got:
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for s in seqs.values():
        s.sort()
        assert s[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(s, s[1:])) and sum(n for _, n in s) <= 64
    want = []
    for d, x, *_ in ROWS:
        ids = [*e.encode(x), 2]
        want += [(-1 if d is None else d, i, len(ids[i : i + 64]), zlib.crc32(np.array(ids[i : i + 64], "<u4").tobytes()), len(ids)) for i in range(0, len(ids), 64)]
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got) == sorted(want)
    assert packing.pack(empty).count() == 0


def test_license():
    a = license_scan.automaton()
    s = license_scan.scan("Under the MIT-License; see\nSPDX-License-Identifier: (Apache-2.0 OR GPL-2.0-only) AND BSD-3-Clause\nmit license", a)
    assert s[1:6] == (2, 2, s[0] - 2, "mit", "apache,bsd,gpl,mit")
    assert s[7:] == ("bsd", "apache,gpl")
    assert license_scan.scan("", a) == (0, 0, None, None, "", "", 0.0, "", "")
    assert license_scan.evaluate("mit or gpl-2.0") == (set(), {"mit", "gpl"})
    assert license_scan.evaluate("mit and gpl-2.0") == ({"mit", "gpl"}, {"mit", "gpl"})
    assert license_scan.evaluate("mit and bsd or mit") == ({"mit"}, {"mit", "bsd"})
    assert license_scan.evaluate("gpl-2.0 with classpath or mit") == (set(), {"gpl", "gpl-exception", "mit"})
    assert license_scan.evaluate("mit or") == (set(), {"mit"}) and license_scan.evaluate("") == (set(), set())
    assert license_scan.postfix("a or b and c") == ["a", "b", "c", "and", "or"] and license_scan.postfix("a or") is None


def test_license_table(docs, empty):
    assert license_scan.license_scan(docs).count() == len(ROWS) and license_scan.license_scan(empty).count() == 0


def test_license_base(spark):
    """Base columns of whole tables against SQL."""
    path, upper = "/root/testdata/sf0.01/documents.parquet", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    phrases = ", ".join(f"('{p}', '{label}', {len(p.split())})" for p, label in license_scan.BASE.items())
    want = duckdb.sql(f"""
        WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM '{path}'),
        p AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d),
        m AS (SELECT doc_id, i - 1 AS k, label FROM p JOIN (VALUES {phrases}) AS b(phrase, label, n) ON array_to_string(w[i:i + n - 1], ' ') = phrase),
        s AS (SELECT doc_id, count(*) AS n, min(k) AS a, max(k) AS z, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM m GROUP BY doc_id)
        SELECT doc_id, len(w), coalesce(n, 0), a, z, coalesce(labels, '') FROM d LEFT JOIN s USING (doc_id)""").fetchall()
    got = license_scan.license_scan(spark.read.parquet(path)).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels").collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str) and sum(x[2] for x in want) > 0


def test_toxicity(spark, empty):
    rows = [(i, prose(12) + (" scumbag" if i % 7 == 0 else "")) for i in range(300)]
    d = spark.createDataFrame([*rows, (None, "scumbag"), (900, None)], "doc_id long, text string")
    y = spark.createDataFrame([(i, 1, int(i % 7 == 0)) for i in range(250)], "doc_id long, quality int, toxic int")
    for r in toxicity.toxicity(d, y).collect():
        if r.doc_id is not None and r.doc_id < 300:
            assert r.predicted == int(r.doc_id % 7 == 0)
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
    assert toxicity.toxicity(empty, y).count() == 0
    assert toxicity.keep_clean(spark.createDataFrame(ROWS, "doc_id long, text string, lang string, score double"), y).columns == ["doc_id", "text", "lang", "score"]


def test_label_model():
    """Rates of simulated voters come back from a poor start with few labels; a voter that fires anywhere is rated so."""
    g = np.random.default_rng(4)
    n, hit, alarm = 20_000, [0.5, 0.4, 0.6, 0.3, 0.9], [0.02, 0.05, 0.01, 0.1, 0.9]
    y = g.random(n) < 0.2
    x = g.random((n, 5)) < np.where(y[:, None], hit, alarm)
    votes = [(*np.flatnonzero(r).tolist(),) if r[:4].any() else (*np.flatnonzero(r).tolist(), 5) for r in x]
    counts = {}
    for v, k, r in zip(votes, y, g.random(n), strict=True):
        v = v, int(k) if r < 0.4 else None
        counts[v] = counts.get(v, 0) + 1
    found = toxicity.label_model([(list(v), k, c) for (v, c), k in counts.items()], np.array([[0.3, 0.1]] * 4 + [[0.5, 0.4], [0.3, 0.6]]))
    right = [0.2 * h / (0.2 * h + 0.8 * a) for h, a in zip(hit, alarm, strict=True)]
    assert all(abs(a - r) < 0.25 for a, r in zip(found["accuracy"], right, strict=False)) and np.argsort(found["accuracy"][:5]).tolist() == np.argsort(right).tolist()
    assert found["accuracy"][4] < 0.3 and found["accuracy"][5] > 0.9


def test_toxic_held_out(spark):
    """Held-out accuracy on the driver's table: no clean document goes, and toxic ones with words seen in training are found."""
    from pyspark.sql import functions as F

    d = "/root/testdata/sf0.01"
    out = toxicity.toxicity(spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet"))
    y = spark.read.parquet(f"{d}/labels.parquet").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n = {(r.toxic, r.predicted): r.n for r in out.where("held_out").join(y, "doc_id").groupBy("toxic", "predicted").agg(F.count("*").alias("n")).collect()}
    assert n.get((0, 1), 0) <= 1 and n[1, 1] >= 9


def test_lm(docs, empty):
    got = lm_score.lm_score(docs, heavy=20, classes=12).collect()
    from collections import Counter
    from math import isclose, log10

    c = Counter()
    out = lambda d: d is not None and zlib.crc32(str(d).encode()) % 10 == 0
    for d, x, *_ in ROWS:
        if not out(d):
            c.update([*lm_score.words_of(x), b""])
    n, v = sum(c.values()), len(c)
    want = []
    for d, x, *_ in ROWS:
        w = [*lm_score.words_of(x), b""]
        want.append((-1 if d is None else d, out(d), len(w), sum(c[k] > 0 for k in w), n, sum(log10((c[k] + 0.1) / (n + 0.1 * (v + 1))) for k in w)))
    rows = sorted((-1 if r.doc_id is None else r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got)
    for a, b in zip(rows, sorted(want), strict=True):
        assert a[:5] == b[:5] and isclose(a[5], b[5], rel_tol=1e-9)
    assert all(r.score < 0 for r in got) and lm_score.lm_score(empty).count() == 0


def test_lm_brute(docs):
    """Scores by a plain loop over tokens and classes; probabilities of all classes, and of a class's words, sum to 1."""
    one = docs.coalesce(1)
    learn = one.where(~lm_score.held_out(one.doc_id))
    counts = {bytes(r.word): r.c for r in lm_score.count_words(learn).collect()}
    of, n, v = lm_score.vocabulary(lm_score.count_words(learn), 20, 12)
    q = of.unigram()
    r, w, z, weights = lm_score.train(learn, of, q)
    assert of.class_count.sum() == n == sum(counts.values()) and of.class_words[of.own + 1 :].sum() == v - of.own - 1

    def after(before):
        p = weights[0] * q
        for d, h in enumerate(before):
            e = np.exp(r[d * of.size + h].astype(float) @ w.T.astype(float))
            p = p + weights[d + 1] * e / e.sum()
        return p

    named = [b"", *[x for x in of.words if x][: of.own]]
    kind = lambda x: named.index(x) if x in named else of.hashed(x)
    want, inside = [], {}
    for y, c in counts.items():
        inside.setdefault(kind(y), []).append(c)
    for d, x, *_ in ROWS:
        before, total = [0] * lm_score.CONTEXT, 0.0
        for word in [*lm_score.words_of(x), b""]:
            k, p = kind(word), after(before)
            assert abs(p.sum() - 1) < 1e-4
            members = inside.get(k, [])
            total += np.log10(p[k]) + (np.log10((counts.get(word, 0) + 0.1) / (sum(members) + 0.1 * (len(members) + 1))) if k > of.own else 0)
            before = [k, *before[:-1]]
        want.append((-1 if d is None else d, total))
    got = sorted((-1 if x.doc_id is None else x.doc_id, x.score) for x in lm_score.lm_score(one, 20, 12).collect())
    assert np.allclose(got, sorted(want), rtol=1e-3)


def test_lm_held_out(spark):
    """On texts it hasn't learned from, the model is better than smoothed counts."""
    out = lm_score.lm_score(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).where("held_out").selectExpr("sum(score) - sum(base_score) as gain", "sum(n_tokens) as n").first()
    assert out.gain / out.n > 0.1


@pytest.mark.parametrize("group_sets", [250, 2])
def test_jaccard(docs, empty, group_sets):
    sets = []
    for _, x, *_ in ROWS:
        w = (x or "").encode().lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    label = list(range(len(ROWS)))
    for i in range(len(ROWS)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                label = [label[j] if x == label[i] else x for x in label]
    want = []
    for i, (d, *_r) in enumerate(ROWS):
        ids = [ROWS[k][0] for k in range(len(ROWS)) if label[k] == label[i] and ROWS[k][0] is not None]
        want.append((-1 if d is None else d, len(sets[i]), min(ids, default=-1)))
    got = [(-1 if r.doc_id is None else r.doc_id, r.n_shingles, -1 if r.component_id is None else r.component_id) for r in jaccard_join.shingle_join(docs, group_sets).collect()]
    assert sorted(got) == sorted(want)
    assert jaccard_join.shingle_join(empty).count() == 0


def test_join_group():
    g = np.random.default_rng(5)
    base = g.integers(0, 1 << 60, 60).astype(np.uint64)
    sets = []
    for _ in range(120):
        x = base.copy()
        x[g.integers(0, 60, g.integers(0, 14))] = g.integers(0, 1 << 60)
        sets.append(np.unique(x))
    label = list(range(120))
    for i in range(120):
        for j in range(i):
            n = len(np.intersect1d(sets[i], sets[j]))
            if 100 * n >= 80 * (len(sets[i]) + len(sets[j]) - n):
                label = [label[j] if x == label[i] else x for x in label]
    got = jaccard_join.join_group(sets)
    assert len(set(zip(got, label))) == len(set(label)) == len(set(got))


def versions(seed):
    """Trees of versions, and each one's component by brute force."""
    rng = random.Random(seed)
    k, n = rng.choice([8, 12, 20, 30, 60]), rng.choice([30, 60, 100])
    sets = [set(rng.sample(range(1 << 40), n))]
    while len(sets) < k:
        x = set(rng.choice(sets[-6:]))
        x -= set(rng.sample(sorted(x), rng.randint(1, n // 9)))
        sets.append(x | set(rng.sample(range(1 << 40), rng.randint(0, n // 9))))
    rng.shuffle(sets)
    label = list(range(k))
    for i in range(k):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]) and label[i] != label[j]:
                lo, hi = sorted((label[i], label[j]))
                label = [lo if x == hi else x for x in label]
    return [np.array(sorted(x), np.uint64) for x in sets], label


VERSIONS = [*range(40), 214, 253, 821, 1343, 1348, 1466]  # the last six once lost a link


@pytest.mark.parametrize("seed", VERSIONS)
def test_join_group_versions(seed):
    sets, label = versions(seed)
    assert jaccard_join.join_group(sets) == label


def test_join_large(spark):
    from minutesmith.llm.common import Scratch

    rows, want = [], {}
    for seed in VERSIONS:
        sets, label = versions(seed)
        for i, (x, c) in enumerate(zip(sets, label, strict=True)):
            rows.append((seed, seed * 100 + i, len(x), bytearray(x.tobytes())))
            want[seed * 100 + i] = seed * 100 + c
    df = spark.createDataFrame(rows, "comp long, rid long, n long, shingles binary")
    got = {r.rid: r.label for r in jaccard_join.join_large(df, Scratch(spark), 1, 4, 7).collect()}
    assert got == want


def test_keep_one_of_each(spark, empty):
    a, b = prose(30), prose(31)
    rows = [(3, a, "x"), (5, a, "x"), (5, b, "x"), (7, b + " end", "x"), (7, b + " end", "x"), (9, None, "x"), (9, None, "x"), (None, a, "x"), (None, prose(40), "x")]
    d = spark.createDataFrame(rows, "doc_id long, text string, _rid string")
    out = jaccard_join.keep_one_of_each(d)
    assert out.columns == d.columns
    assert sorted(map(repr, out.collect())) == sorted(repr(r) for r in d.collect() if (r.doc_id, r.text) in ((3, a), (5, b), (9, None), rows[-1][:2]))
    assert jaccard_join.keep_one_of_each(empty).count() == 0


def test_remove_repeats_names(spark, empty):
    x = prose(40)
    d = spark.createDataFrame([(1, x, 1, "s", "d", 2), (2, "begin " + x, 1, "s", "d", 2), (2, None, 1, None, "d", 2)], "doc_id long, text string, _doc int, _spans string, _text string, _rk int")
    out = suffix_dedup.remove_repeats(d)
    assert out.schema == d.schema and sorted((r.doc_id, r.text, r._doc, r._text, r._rk) for r in out.collect() if r.text is not None) == [(1, x, 1, "d", 2), (2, "begin ", 1, "d", 2)]
    assert suffix_dedup.remove_repeats(empty).count() == 0


def test_pipeline(spark, tmp_path):
    """All five stages against brute force, on rows with repeated ids, nulls and clashing names."""
    import corpus_pipeline
    from tokenizers import Tokenizer

    near = [prose(60) for _ in range(12)]
    passage = prose(40)
    texts = [(i, prose(25) + (" scumbag" if i % 7 == 0 else "")) for i in range(280)]
    texts += [(300 + i, x) for i, x in enumerate(near)] + [(330 + i, edited(x)) for i, x in enumerate(near)]
    texts += [(400, near[0].upper()), (401, passage + " " + prose(30)), (402, prose(28) + " " + passage), (403, None), (404, ""), (500, texts[1][1]), (500, prose(33)), (501, texts[3][1]), (501, texts[3][1]), (None, prose(21))]
    rows = [(d, x, "en", "src", len(x or ""), i, "a", 1.5) for i, (d, x) in enumerate(texts)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, _rid int, _text string, _score double"
    docs = spark.createDataFrame(rows, schema)
    docs.repartition(3).write.parquet(f"{tmp_path}/a/documents.parquet")
    labels = spark.createDataFrame([(i, 1, int(i % 7 == 0)) for i in range(250)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/a/labels.parquet")
    kept = [(d, x) for d, x in texts if "scumbag" not in (x or "")]
    last = {}
    for d, x in kept:
        k = fold(x)
        if k not in last or (d is not None and (last[k][0] is None or d >= last[k][0])):
            last[k] = (d, x)
    kept, out = list(last.values()), []
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if (w := fold(x).split()) else set() for _, x in kept]
    for i, (d, x) in enumerate(kept):
        if not any(sets[i] and 100 * len(sets[i] & y) >= 80 * len(sets[i] | y) and e is not None and (d is None or e < d) for y, (e, _) in zip(sets, kept, strict=True)):
            out.append((d, x))
    t, want = Tokenizer.from_file(bpe.vocabulary_path(None)), []
    for d, x in out:
        b = (x or "").encode()
        seen = {y[i : i + 50] for e, z in out if e is not None and (d is None or e < d) for y in [(z or "").encode()] for i in range(len(y) - 49)}
        gone = {j for i in range(len(b) - 49) if b[i : i + 50] in seen for j in range(i, i + 50)}
        ids = [*t.encode(bytes(c for i, c in enumerate(b) if i not in gone).decode(), add_special_tokens=False).ids, 2]
        want.append((-1 if d is None else d, 0, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), len(ids)))
    got = corpus_pipeline.run(spark, f"{tmp_path}/a").collect()
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got) == sorted(want)
    docs.limit(0).write.parquet(f"{tmp_path}/b/documents.parquet")
    labels.limit(0).write.parquet(f"{tmp_path}/b/labels.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/b").count() == 0


def test_ann(spark):
    g = np.random.default_rng(2)
    v = g.normal(size=(700, 16)).astype(np.float32)
    v[100:160] = v[100]
    rows = [(i, [float(x) for x in v[i]], 1) for i in range(700)] + [(800, None, 1), (900, [0.0] * 16, 1), (1000, [float("nan")] * 16, 1), (1100, [None] * 16, 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = {}
    for r in ann.nearest(df, shard=300).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert sorted(got) == [0, 100, 200, 300, 400, 500, 600]
    hit = 0
    for q, rows in got.items():
        d = np.sqrt(((v.astype(float) - v[q].astype(float)) ** 2).sum(1))
        d[q] = np.inf
        want = np.lexsort((np.arange(700), d))[:10]
        rows.sort()
        assert [r[0] for r in rows] == list(range(1, 11))
        hit += len(set(want.tolist()) & {r[1] for r in rows})
    assert hit >= 63 and [r[1] for r in sorted(got[100])] == list(range(101, 111))
    assert ann.nearest(df.limit(0)).count() == 0
