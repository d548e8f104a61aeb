"""Operator 7: toxicity by weak supervision.

Voters are whole words (a lexicon), word stems and forms of writing (patterns). Which features may vote is decided by
evidence in the labelled training rows: a bound on the chance that so many of its rows are toxic (or so few), and the
ratio of its rates; rows count once for each distinct neighbourhood of the feature, so that words of a much copied text
aren't evidence. A text in which no voter for "toxic" fires is a vote of its own, for "clean".

How often each voter is right is then estimated by a generative model of the votes given a hidden label:
expectation-maximisation over the counted vote patterns of a sample of the training fold estimates both rates of every
voter, hits and false alarms, freely between 0 and 1. Rows of the sample without a label have a hidden one; those with
one keep it, so that the model can't drift to another class. Votes that come together more than the label explains are
discounted by that correlation. A linear (logistic) classifier over
hashed word features and the votes' sum is fitted to the posterior labels and gives the score.

Labels are read only from rows whose crc32(doc_id as text) mod 4 is not 2. A score never sees labels, lang, source or
doc_id. Documented bounds: ``LABEL_ROWS`` labelled rows that fitting reads (a share of all by a hash of doc_id, so the
sample is the same on every run; its ids and labels are few enough to send to every task, so that no text is shuffled),
and about ``FIT_ROWS`` rows that the label model and the classifier are fitted on (a share of all, by a hash). Voters are
not bounded in number. Every row is scored.

Defined results: null and empty texts get the classifier's score for a text without words; rows with a null doc_id are
not in the held-out fold and join no label; repeated rows each give a row; labels that contradict each other for one
doc_id count as toxic; without evidence for any voter every score is the same, below the threshold; empty tables give no
rows; texts may be of any length and are read whole; further columns may have any name.
"""

from __future__ import annotations

import re
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import fresh, lean

THRESHOLD = 0.3
FIT_ROWS = 8_000
LABEL_ROWS = 400_000
#: A feature may vote if chance explains its rows less often than ``CHANCE``, and if its rates differ ``TIMES`` times.
CHANCE = 1e-3
TIMES = 8
STEMS = (4, 5, 6)
WORD = re.compile(r"[^\W\d_]+")
LOUD = re.compile(r"[^\W\d_]+[^\w\s]*!")
DIM = 1 << 12
SHARES = (0.05, 0.2, 0.5)
RUNS = (3, 6, 12)


def forms(text: str, words: list[str]) -> list[str]:
    """How a text is written: shares of words in capitals, of words before exclamation marks, of words said before, and runs of one word."""
    n = len(words)
    if n < 4:
        return []
    low = [w.lower() for w in words]
    upper = sum(w.isupper() and len(w) > 1 for w in words) / n
    loud = len(LOUD.findall(text)) / n if "!" in text else 0.0
    again = 1 - len(set(low)) / n
    run = most = 1
    for a, b in zip(low, low[1:], strict=False):
        run = run + 1 if a == b else 1
        most = max(most, run)
    out = [f"#{name}{t}" for name, x in (("capitals", upper), ("loud", loud)) for t in SHARES if x >= t]
    return out + [f"#same{t}" for t in (0.5, 0.8) if again >= t] + [f"#run{k}" for k in RUNS if most >= k]


def read(text: str | None) -> tuple[set[str], set[str]]:
    """(words, features): whole words, their stems with a star (two if several words have it), and the forms."""
    found = WORD.findall(text or "")
    words = {w.lower() for w in found}
    stems, twice = set(), set()
    for w in words:
        for n in STEMS:
            if len(w) > n:
                s = w[:n] + "*"
                (twice if s in stems else stems).add(s)
    return words, words | stems | {s + "*" for s in twice} | set(forms(text or "", found))


def neighbours(text: str | None) -> dict[str, int]:
    """Of each word and stem a 64-bit sketch of the words around it; for forms ('') one of the text's first words."""
    low = [w.lower() for w in WORD.findall(text or "")]
    out = {"": 1 << (zlib.crc32(" ".join(low[:9]).encode()) & 63)}
    for before, w, after in zip(["", *low], low, [*low[1:], ""], strict=False):
        bit = 1 << (zlib.crc32(f"{before} {after}".encode()) & 63)
        for f in (w, *(w[:n] + "*" for n in STEMS if len(w) > n)):
            out[f] = out.get(f, 0) | bit
    return out


def held_out(c):
    return F.coalesce(F.crc32(F.encode(c.cast("string"), "UTF-8")) % 4 == 2, F.lit(False))


def _count(df: DataFrame, only: set[str] | None) -> DataFrame:
    """feature, n: in how many rows each feature occurs, partly summed in each task; '' counts the rows; marks: a 64-bit
    sketch of the words around it, for an estimate of how many rows are no copies."""

    def count(batches):
        lean()
        c: dict = {}
        for b in batches:
            for text in b.column(0).to_pylist():
                f = read(text)[1]
                near = neighbours(text) if only is None else {}
                for x in {"", *(f if only is None else f & only)}:
                    t = c.setdefault(x, [0, 0])
                    t[0] += 1
                    t[1] |= near.get(x.removesuffix("*") if x.endswith("**") else x, near.get("", 0))
            if len(c) > 200_000:
                yield out(c)
                c = {}
        yield out(c)

    def out(c):
        marks = [x[1] - (1 << 64) if x[1] >> 63 else x[1] for x in c.values()]
        return pa.RecordBatch.from_pydict({"feature": list(c), "n": [x[0] for x in c.values()], "marks": marks}, pa.schema([("feature", pa.string()), ("n", pa.int64()), ("marks", pa.int64())]))

    return df.select("text").mapInArrow(count, "feature string, n long, marks long").groupBy("feature").agg(F.sum("n").alias("n"), F.bit_or("marks").alias("marks"))


def _columns(df: DataFrame):
    t = df.select("feature", "n", "marks").toArrow()
    return zip(*(t.column(i).to_pylist() for i in range(3)), strict=True)


def distinct(n: int, marks: int) -> float:
    """At most how many of n rows have neighbourhoods of their own, from the sketch (a full one tells nothing)."""
    import math

    k = bin(marks & (1 << 64) - 1).count("1")
    return float(n) if k >= 62 else min(n, max(1.0, -64 * math.log(1 - k / 64)))


def surprise(hits: float, rows: float, share: float) -> float:
    """Minus the log of a bound (Chernoff's) on the chance of so extreme a share of hits."""
    import math

    x = hits / rows
    return rows * ((x * math.log(x / share) if x > 0 else 0) + ((1 - x) * math.log((1 - x) / (1 - share)) if x < 1 else 0))


def propose_voters(labelled: DataFrame) -> tuple[dict[str, tuple[float, float]], dict[str, tuple[float, float]]]:
    """Voters for toxic and for clean with their rates in toxic and in clean training rows."""
    import math

    sizes = {r["y"]: r["n"] for r in labelled.groupBy("y").agg(F.count("*").alias("n")).collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not clean:
        return {}, {}
    share, enough = toxic / (toxic + clean), -math.log(CHANCE)
    least = enough / -math.log(share)  # fewer rows than these are no evidence, even if none is clean
    form = F.col("feature").startswith("#")
    # columns, not rows, come to the driver: what can vote is bounded by LABEL_ROWS
    pos = {f: distinct(n, m) for f, n, m in _columns(_count(labelled.where("y = 1"), None).where((F.col("n") >= least) | form)) if f}
    names = {f"#{n}{t}" for n in ("capitals", "loud") for t in SHARES} | {f"#same{t}" for t in (0.5, 0.8)} | {f"#run{k}" for k in RUNS}
    neg = {f: n for f, n, _ in _columns(_count(labelled.where("y = 0"), set(pos) | names))}
    rate = lambda f: ((pos.get(f, 0) + 0.1) / (toxic + 1), (neg.get(f, 0) + 0.2) / (clean + 1))
    good, bad = [], {}
    for f in set(pos) | names:
        p, q = pos.get(f, 0.0), neg.get(f, 0)
        a, b = rate(f)
        if p + q and surprise(p, p + q, share) >= enough:
            if a >= TIMES * b:
                good.append(f)
            elif f[0] == "#" and b >= 3 * a:
                bad[f] = (a, b)
    kept: dict[str, tuple[float, float]] = {}
    inside: dict[str, list[float]] = {}  # of a stem: rows of the kept features that begin with it
    worth = {f: rate(f)[0] * math.log(rate(f)[0] / rate(f)[1]) for f in good}
    for f in sorted(good, key=lambda f: (-worth[f], len(f), f)):
        word = f.rstrip("*")
        if f[0] != "#":
            if any(word[:n] + "*" * k in kept for n in STEMS if n < len(word) or f.endswith("**") and n == len(word) for k in (1, 2)):
                continue  # a kept stem stands for what begins with it
            p, q = (max(0.0, x - y) for x, y in zip((pos[f], neg.get(f, 0)), inside.get(word, (0, 0)), strict=True))
            if not p or surprise(p, p + q, share) < enough or (p + 0.1) / (toxic + 1) < TIMES * (q + 0.2) / (clean + 1):
                continue  # nothing of its own beyond the kept features inside it
            for n in STEMS:
                if n < len(word) or f.endswith("*") and n == len(word):
                    t = inside.setdefault(word[:n], [0.0, 0.0])
                    t[0], t[1] = t[0] + pos[f], t[1] + neg.get(f, 0)
        kept[f] = rate(f)
    return kept, bad


def label_model(patterns: list[tuple[list[int], int, int | None]], start, rounds: int = 40) -> dict:
    """Expectation-maximisation over counted vote patterns: (voters that fire, rows, their label or None if it is hidden).

    start: both rates of each voter to begin with, (m, 2). on: a voter's log odds when it fires, divided by the number of
    voters that fire with it beyond what the hidden label explains (its correlation); post: each pattern's posterior;
    accuracy: how often a vote is for the likelier label, given that the voter fires. A voter that doesn't fire says
    nothing (most know one language only); that none fires is a voter itself.
    """
    import numpy as np

    n = np.array([c for _, c, _ in patterns], float)
    known = np.array([-1 if y is None else y for _, _, y in patterns])
    x = np.zeros((len(patterns), len(start)))
    for i, (v, _, _) in enumerate(patterns):
        x[i, v] = 1
    a, b = np.array(start, float).T
    prior, cluster = 0.1, np.ones(len(start))
    for k in range(rounds + 1):
        on = np.log(a / b) / cluster
        z = np.log(prior / (1 - prior)) + x @ on
        post = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        if k == rounds:
            break
        label = np.where(known < 0, post, known)
        w1, w0 = n * label, n * (1 - label)
        prior = np.clip(w1.sum() / n.sum(), 1e-3, 0.9)
        # one row's worth of what was known before keeps voters that hardly fire where they were
        a = (w1 @ x + start[:, 0]) / (w1.sum() + 1)
        b = (w0 @ x + start[:, 1]) / (w0.sum() + 1)
        fires = np.maximum(w1 @ x, 1e-9)
        both = (x * w1[:, None]).T @ x / fires[:, None]
        extra = np.clip((both - a[None, :]) / np.maximum(1 - a[None, :], 1e-9) - 0.5, 0, 0.5) / 0.5
        np.fill_diagonal(extra, 1)
        cluster = np.maximum(1, np.where(fires > 0.5, extra.sum(1), 1))
    right = prior * a / (prior * a + (1 - prior) * b)
    return {"on": on, "post": post, "accuracy": np.where(a >= b, right, 1 - right), "correlation": cluster}


def hashed(words: set[str]) -> list[int]:
    return sorted({zlib.crc32(w.encode()) % (DIM - 2) for w in words})


def fit_linear(rows: list[tuple[list[int], float, float]], steps: int = 40):
    """Logistic regression on posterior labels: Newton steps for votes and constant, gradient steps for words (numpy)."""
    import numpy as np

    idx = np.concatenate([np.array([*r[0], DIM - 2, DIM - 1], np.int64) for r in rows])
    val = np.concatenate([np.array([*[word_weight(len(r[0]))] * len(r[0]), r[1], 1.0]) for r in rows])
    rep = np.repeat(np.arange(len(rows)), [len(r[0]) + 2 for r in rows])
    y = np.array([r[2] for r in rows])
    words, top = idx < DIM - 2, np.array([[r[1], 1.0] for r in rows])
    w, sq = np.zeros(DIM), np.bincount(idx, val**2, DIM) + 1

    def gap():
        p = 1 / (1 + np.exp(-np.clip(np.bincount(rep, val * w[idx], len(y)), -30, 30)))
        return p - y, p * (1 - p)

    for _ in range(steps):
        g, h = gap()  # Newton's step for the votes' weight and the constant
        w[DIM - 2 :] -= np.linalg.solve((top * h[:, None]).T @ top + 1e-2 * np.eye(2), top.T @ g + 1e-2 * w[DIM - 2 :])
        g, _ = gap()  # a gradient step for the words
        w[: DIM - 2] -= (np.bincount(idx[words], (val * g[rep])[words], DIM)[: DIM - 2] + 1e-2 * w[: DIM - 2]) / sq[: DIM - 2]
    return w


def word_weight(n: int) -> float:
    return 0.1 / max(1, n) ** 0.5


def fire(features: set[str], index: dict[str, int], toxic: int) -> list[int]:
    """The voters that fire: the first ``toxic`` vote toxic, those behind vote clean, and the last one if none of the first fires."""
    if len(index) < len(features):
        votes = sorted(i for f, i in index.items() if f in features)
    else:
        votes = sorted(index[f] for f in features if f in index)
    return votes if votes and votes[0] < toxic else [*votes, len(index)]


def _sample(docs: DataFrame, y: DataFrame, index: dict[str, int], toxic: int, rows: int) -> list:
    """About ``rows`` rows of the training fold, labelled or not, as votes, hashed words and label: a share by a hash of the
    row, rows that repeat once. The filter stands before Python, so little is read there and sent to the driver."""

    def code(batches):
        lean()
        for b in batches:
            x = [read(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([fire(f, index, toxic) for _, f in x], pa.list_(pa.int32())), pa.array([hashed(w) for w, _ in x], pa.list_(pa.int32())), b.column(2)], names=["h", "votes", "words", "y"])

    fold = docs.where(~held_out(F.col("doc_id"))).select("doc_id", F.xxhash64("doc_id", "text").alias("h"), "text")
    n = fold.count()
    if n > rows:
        fold = fold.where(F.pmod("h", F.lit(1 << 40)) < F.lit(rows * (1 << 40) // n))
    coded = fold.join(F.broadcast(y), "doc_id", "left").select("h", "text", "y").mapInArrow(code, "h long, votes array<int>, words array<int>, y int")
    return coded.groupBy("h").agg(F.first("votes").alias("votes"), F.first("words").alias("words"), F.first("y").alias("y")).orderBy("h").limit(2 * rows).collect()


def training_labels(labels: DataFrame, rows: int = LABEL_ROWS) -> DataFrame:
    """doc_id, y of the training fold: all of them, or beyond ``rows`` the share of them that gives about ``rows``."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("y")).where(F.col("doc_id").isNotNull() & F.col("y").isNotNull() & ~held_out(F.col("doc_id")))
    n = known.count()
    if n > rows:
        known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) < F.lit(rows * (1 << 40) // n))
    return known.groupBy("doc_id").agg(F.max("y").alias("y"))


def train(df: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, label_rows: int = LABEL_ROWS) -> dict:
    """The model as plain data, from labels of the training fold only."""
    import numpy as np

    y = training_labels(labels, label_rows)
    docs = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    labelled = docs.where(~held_out(F.col("doc_id"))).join(F.broadcast(y), "doc_id").select("text", "y")
    good, bad = propose_voters(labelled)
    voters, m = [*good, *bad], len(good)
    empty = {"voters": [], "toxic": 0, "gain": [0.0], "w": [0.0] * (DIM - 1) + [-3.0], "accuracy": [], "correlation": []}
    if not good:
        return empty
    index = {v: i for i, v in enumerate(voters)}
    sample = _sample(docs, y, index, m, fit_rows)
    rates = [*good.values(), *bad.values()]
    silent = np.prod([1 - min(0.9, a) for a, _ in good.values()]), np.prod([1 - min(0.9, b) for _, b in good.values()])
    start = np.array([*rates, (max(0.02, silent[0]), max(0.3, silent[1]))])
    votes = [tuple(r["votes"]) for r in sample]
    counts: dict = {}
    for v, r in zip(votes, sample, strict=True):
        counts[v, r["y"]] = counts.get((v, r["y"]), 0) + 1
    patterns = sorted(counts.items(), key=repr)
    model = label_model([(list(v), n, k) for (v, k), n in patterns], start)
    post = {v: float(p) for ((v, _), _), p in zip(patterns, model["post"], strict=True)}
    gain = model["on"]
    w = fit_linear([(r["words"], vote_sum(v, gain), post[v]) for r, v in zip(sample, votes, strict=True)])
    del sample, patterns, votes, counts
    lean()
    return {"voters": voters, "toxic": m, "gain": gain.tolist(), "w": w.tolist(), "accuracy": model["accuracy"].tolist(), "correlation": model["correlation"].tolist()}


def vote_sum(votes: list[int], gain) -> float:
    return max(-2.0, min(2.0, float(sum(gain[v] for v in votes)) / 5))


def score(df: DataFrame, model: dict, name: str = "score") -> DataFrame:
    """The columns of ``df`` and the score: one linear pass over each text; nothing is shuffled."""
    text = fresh(df, "_text")

    def run(batches):
        import numpy as np

        lean()
        index, gain, w = {v: i for i, v in enumerate(model["voters"])}, model["gain"], np.array(model["w"])
        for b in batches:
            out = []
            for x in b.column(b.num_columns - 1).to_pylist():
                words, features = read(x)
                h = hashed(words)
                votes = fire(features, index, model["toxic"])
                z = w[h].sum() * word_weight(len(h)) + w[DIM - 2] * vote_sum(votes, gain) + w[DIM - 1]
                out.append(float(1 / (1 + np.exp(-np.clip(z, -30, 30)))))
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(b.num_columns - 1)), pa.array(out, pa.float64())], names=[*b.schema.names[:-1], name])

    schema = StructType([*df.schema.fields, StructField(name, DoubleType())])
    return df.withColumn(text, F.coalesce(F.col("text").cast("string"), F.lit(""))).mapInArrow(run, schema)


def keep_clean(df: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``df`` whose score is below the threshold."""
    name = fresh(df, "_score")
    return score(df, train(df, labels), name).where(F.col(name) < THRESHOLD).drop(name)


def toxicity(df: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return score(rows, train(df, labels)).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
