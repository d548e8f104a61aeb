"""Operator 8: scores of a log-bilinear language model trained with noise-contrastive estimation.

Classes: the most frequent words and the end have a class each; every other word, known or not, shares one of as many
hashed classes, and its probability is its class's times its smoothed share of the class. There are ``CLASSES`` plus
twice the root of the number of different training words, so the model grows with the corpus.

Context: ``CONTEXT`` words before. For each distance the log-bilinear model gives class w after class h the score
r(distance, h) . q_w + b_w, and batched matrix products over all classes normalise it. The token's probability is a
mixture of the distances and of the class's own frequency, so it is normalised too; the mixture's weights are estimated
by expectation-maximisation. Training is numpy inside Spark tasks: in each of ``PASSES`` passes every task goes through
all pairs of its own training texts by noise-contrastive estimation, from the parameters of the last pass; Spark then
averages each vector over the tasks, weighted by its number of pairs. Steps grow with tokens, nothing is sampled but the
noise. Only the parameters, whose number grows with the root of the vocabulary, travel to the driver and back.
Every task takes its own pairs in its own order, so scores (not counts or ``base_score``) depend a little on how the table
is split into tasks.

``base_score`` uses the exact count of every token: frequent words travel to the tasks as a table of at most ``HEAVY``
words; the others are joined with their counts.

Defined results: null and empty texts are one end token; a null doc_id belongs to training; repeated rows each count
and each give a row; with no training token at all every class is equally likely; long texts are scored whole; other
columns, whatever they are called, are not read.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass
from math import isqrt

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, lean

HEAVY = 1 << 17
CLASSES = 1024
CONTEXT = 2
DIM = 32
PASSES = 2
#: Noise samples for each pair, and how many are drawn for a batch, whose pairs share them.
NOISE, SHARED = 16, 64
BATCH = 256
#: So many pairs of one context, at most, are dealt to batches together; they meet the same noise.
TOGETHER = 8
#: Pairs are counted over so many tokens of a task, and one that comes more often than ``REPEAT`` times counts as several.
TOKENS, REPEAT = 1 << 19, 8
#: So many texts, at most, are looked at together in training and scoring, so that their pairs stay in the processor's cache.
PIECE = 256
#: Words are counted together in a task until they take so many bytes.
COUNTED = 1 << 25
RATE = 0.2
END = b""


def words_of(text: str | None) -> list[bytes]:
    """Runs without ASCII white space, A-Z lower-cased, as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def split(texts):
    """The words of all texts of an Arrow array, one after the other, as ``words_of`` finds them, and how many come before
    each text, and in all."""
    import numpy as np

    parts = pc.ascii_split_whitespace(pc.ascii_lower(texts.cast(pa.string()).fill_null("")))
    words = parts.flatten()
    some = pc.greater(pc.binary_length(words), 0)  # white space at a text's ends leaves empty parts
    at = np.append(0, np.cumsum(pc.list_value_length(parts).to_numpy()))
    return words.filter(some).cast(pa.binary()), np.append(0, np.cumsum(some.to_numpy(zero_copy_only=False)))[at]


def held_out(c):
    return F.coalesce(F.crc32(F.encode(c.cast("string"), "UTF-8")) % 10 == 0, F.lit(False))


def count_words(df: DataFrame) -> DataFrame:
    """word (binary; empty: the end), c: exact counts, partly summed in each task."""
    schema = pa.schema([("word", pa.binary()), ("c", pa.int64())])

    def counted(held, texts):
        c = pa.chunked_array(held, pa.binary()).value_counts()
        words, n = pa.concat_arrays([c.field(0), pa.array([END], pa.binary())]), pa.concat_arrays([c.field(1), pa.array([texts], pa.int64())])
        return pa.RecordBatch.from_arrays([words, n], schema=schema)

    def run(batches):
        held, texts, size = [], 0, 0
        for b in batches:
            words, _ = split(b.column(0))
            held.append(words)
            texts += len(b)
            size += words.nbytes
            if size > COUNTED:
                yield counted(held, texts)
                held, texts, size = [], 0, 0
        if texts:
            yield counted(held, texts)

    return df.select("text").mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


@dataclass
class Vocabulary:
    """Frequent words, their counts and the classes: 0 is the end, then the words of their own, then the hashed ones."""

    words: list
    known: object
    own: int
    size: int
    class_count: object
    class_words: object

    def __post_init__(self):
        import numpy as np

        self.frequent = pa.array(self.words, pa.binary())
        names = [w for w in self.words if w != END][: self.own]
        named = {w: i + 1 for i, w in enumerate(names)}
        self.class_of = np.array([0 if w == END else named.get(w) or self.hashed(w) for w in self.words], np.int64)

    def hashed(self, word: bytes) -> int:
        return self.own + 1 + zlib.crc32(word) % (self.size - self.own - 1)

    def shares(self):
        """log10 of each hashed class's smoothed total, by which the smoothed count of one of its words is divided."""
        import numpy as np

        out = np.log10(self.class_count + 0.1 * (self.class_words + 1))
        out[: self.own + 1] = 0
        return out

    def unigram(self):
        q = self.class_count + 0.5
        return q / q.sum()

    def read(self, texts):
        """Places (``len(words)``: not frequent) and classes of all tokens of the texts, ``CONTEXT`` ends before each text
        and one after it, where each text starts, and its rare words with the number of the text that holds each."""
        import numpy as np

        miss, (words, before) = len(self.words), split(texts)
        found = pc.index_in(words, value_set=self.frequent)
        lone = found.is_null()
        found, lone = found.fill_null(miss).to_numpy(), words.filter(lone).dictionary_encode()
        n = np.diff(before)
        text = np.repeat(np.arange(len(n)), n)
        at = np.arange(len(found)) + text * (CONTEXT + 1) + CONTEXT
        start = before[:-1] + np.arange(len(n)) * (CONTEXT + 1)
        places, classes = np.full(len(found) + len(n) * (CONTEXT + 1), -1), np.zeros(len(found) + len(n) * (CONTEXT + 1), np.int64)
        places[at], known = found, found < miss
        classes[at[known]] = self.class_of[found[known]]
        hashed = np.array([self.hashed(x) for x in lone.dictionary.to_pylist()], np.int64)
        classes[at[~known]] = hashed[lone.indices.to_numpy()]
        return places, classes, start, lone, text[~known]


def encoded(classes, start, size: int):
    """The classes of each text, with the ends around it, as an Arrow array of bytes."""
    import numpy as np

    data = classes.astype(np.min_scalar_type(size))
    at = (np.append(start, len(data)) * data.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(at), pa.py_buffer(data)])


def decoded(column, size: int):
    """Classes and starts, of which ``encoded`` made the column."""
    import numpy as np

    if not len(column):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    kind, (_, at, data) = np.min_scalar_type(size), column.cast(pa.binary()).buffers()
    at = np.frombuffer(at, np.int32)[column.offset : column.offset + len(column) + 1] // kind.itemsize
    return np.frombuffer(data, kind)[at[0] : at[-1]].astype(np.int64), at[:-1].astype(np.int64) - at[0]


def vocabulary(counts: DataFrame, heavy: int, classes: int) -> tuple[Vocabulary, int, int]:
    """The vocabulary, and the numbers of all and of different training tokens."""
    import numpy as np

    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    n, v = total["n"], total["v"]
    size = classes + 2 * isqrt(v)
    top = counts.orderBy(F.desc("c"), "word").limit(heavy).toArrow()
    words, known = top.column("word").to_pylist(), np.array(top.column("c").to_pylist(), np.int64)
    own = min(size // 2, len(words))
    of = Vocabulary(words, known, own, size, np.zeros(size), np.zeros(size))
    # totals of the hashed classes over all words, less the words that have a class of their own
    slots = size - own - 1
    for r in counts.groupBy((F.crc32("word") % slots).alias("slot")).agg(F.sum("c").alias("c"), F.count("*").alias("v")).toArrow().to_pylist():
        of.class_count[own + 1 + r["slot"]], of.class_words[own + 1 + r["slot"]] = r["c"], r["v"]
    for w, c, k in zip(words, known.tolist(), of.class_of.tolist(), strict=True):
        if k <= own:
            h = of.hashed(w)
            of.class_count[h] -= c
            of.class_words[h] -= 1
            of.class_count[k] = c
    if END not in words:
        end = counts.where(F.length("word") == 0).select("c").first()
        if end:
            of.class_count[0] = end["c"]
            h = of.hashed(END)
            of.class_count[h] -= end["c"]
            of.class_words[h] -= 1
    return of, n, v


def contexts(classes, at, size: int):
    """Row of r for each distance (one column each) and each place."""
    import numpy as np

    return np.stack([classes[at - d] + (d - 1) * size for d in range(1, CONTEXT + 1)], 1)


def targets(n: int, start):
    """Places of tokens that are predicted: all but the ends before a text."""
    import numpy as np

    keep = np.ones(n, bool)
    for d in range(CONTEXT):
        keep[start + d] = False
    return np.flatnonzero(keep)


def components(r, w, z, q, h, t):
    """Probability of class t by its frequency and by each distance's model, one column each."""
    import numpy as np

    out = np.empty((len(t), CONTEXT + 1))
    out[:, 0] = q[t]
    for a in range(0, len(t), 1 << 12):  # so many rows stay in the processor's cache
        v = w.take(t[a : a + (1 << 12)], 0)
        for d in range(CONTEXT):
            x = h[a : a + (1 << 12), d]
            out[a : a + (1 << 12), d + 1] = np.exp(np.einsum("ij,ij->i", r.take(x, 0), v) - z[x])
    return out


def starts(rows):
    """Where, along the last axis, a run of equal rows begins."""
    import numpy as np

    new = np.ones(rows.shape, bool)
    new[..., 1:] = rows[..., 1:] != rows[..., :-1]
    return new


def move(x, gx, rows, old, d, rate: float):
    """One adaptive step along d of the given rows of x, which are old and whose squares add up in gx."""
    import numpy as np

    size = gx.take(rows, 0)
    size += d * d
    gx[rows] = size
    np.sqrt(size, out=size)
    d /= size
    d *= rate
    d += old
    x[rows] = d


def dealt(h, rng, together: int):
    """A random order of the pairs in which up to ``together`` pairs of one context stand next to each other."""
    import numpy as np

    order = rng.permutation(len(h))
    order = order[np.argsort(h[order], kind="stable")]
    first = np.flatnonzero(starts(h[order]))
    at = np.arange(len(h)) - np.repeat(first, np.diff(np.append(first, len(h))))
    begin = np.flatnonzero(at % together == 0)
    size = np.diff(np.append(begin, len(h)))
    mixed = rng.permutation(len(begin))
    begin, size = begin[mixed], size[mixed]
    return order[np.repeat(begin - np.cumsum(size) + size, size) + np.arange(len(h))]


def train_nce(x, gx, q, h, t, c, rng, rate: float = RATE, batch: int = BATCH, together: int = TOGETHER):
    """One pass of noise-contrastive estimation over pairs (h, t) that occur c times; changes x, the rows of r and then those
    of w, and its step sizes.

    Contexts of a batch meet the same noise. A batch is a matrix of scores of its different words (rows) by its different
    contexts (columns), so scores and both gradients are matrix products. The last place of every r is 1, so that the last
    one of w is the bias."""
    import numpy as np

    base = len(x) - len(q)
    logkq, cum, rate = np.log(NOISE * q).astype(np.float32), np.cumsum(q), np.float32(rate)
    short = np.min_scalar_type(len(x))  # numbers of 16 bits are sorted fast
    h, t = h.astype(short), t.astype(short)
    order = dealt(h, rng, together)
    whole = len(order) // batch * batch
    for block in (order[:whole].reshape(-1, batch), order[None, whole:]):
        for a in range(0, len(block) if block.size else 0, 256):
            i = block[a : a + 256]
            # what doesn't depend on the parameters is worked out for many batches at once
            i = np.take_along_axis(i, np.argsort(h[i], axis=1, kind="stable"), 1)
            hs, ts, cs = h[i], t[i], c[i]
            cs = (cs / cs.sum(1, keepdims=True) * 50).astype(np.float32)
            ns = np.sort(np.minimum(np.searchsorted(cum, rng.random((len(i), SHARED))), len(q) - 1).astype(short), axis=1)
            both = np.concatenate([ts, ns], 1)
            by = np.argsort(both, axis=1, kind="stable")
            both = np.take_along_axis(both, by, 1)
            # different contexts, noise words and words, of all batches in a row, and where each batch's begin
            runs, noise, words = starts(hs), starts(ns), starts(both)
            ends = [np.append(0, y.sum(1).cumsum()) for y in (runs, noise, words)]
            column, line = runs.cumsum(1) - 1, np.empty(both.shape, np.int64)
            np.put_along_axis(line, by, words.cumsum(1) - 1, 1)
            width, of_noise = np.diff(ends[0]), line[:, -SHARED:][noise]
            cells = line[:, :-SHARED] * width[:, None] + column
            load = np.add.reduceat(cs.ravel(), np.flatnonzero(runs)) * np.float32(-NOISE / SHARED)
            times = np.diff(np.append(np.flatnonzero(noise), noise.size)).astype(np.float32)
            contexts, words, kt, kn = hs[runs].astype(np.int64), both[words] + np.int64(base), logkq[ts], logkq[ns[noise]]
            for k, n in enumerate(width.tolist()):
                (h0, n0, w0), (h1, n1, w1) = ([int(y[k + j]) for y in ends] for j in (0, 1))
                rows = np.concatenate([contexts[h0:h1], words[w0:w1]])
                old = x.take(rows, 0)
                r, w = old[:n], old[n:]
                s = w @ r.T.copy()
                g = s.take(cells[k])
                g -= kt[k]
                np.exp(np.minimum(g, 30, out=g), out=g)
                g += 1
                np.divide(cs[k], g, out=g)
                m = of_noise[n0:n1]
                e = np.subtract(kn[n0:n1, None], s.take(m, 0))
                np.exp(np.minimum(e, 30, out=e), out=e)
                e += 1
                np.divide(times[n0:n1, None] * load[h0:h1], e, out=e)
                s.fill(0)
                s[m] = e
                np.add.at(s.reshape(-1), cells[k], g)
                d = np.empty_like(old)
                np.matmul(s.T, w, out=d[:n])
                np.matmul(s, r, out=d[n:])
                d[:n, -1] = 0
                move(x, gx, rows, old, d, rate)


def mix(p, weights, rounds: int):
    """Weights of the mixture after rounds of expectation-maximisation over the components' probabilities."""
    for _ in range(rounds):
        weights = weights * ((1 / (p @ weights)) @ p) / len(p)
    return weights


def train(learn: DataFrame, of: Vocabulary, q):
    """``fit`` on the column text."""

    def run(batches):
        for b in batches:
            _, classes, start, *_ = of.read(b.column(0))
            yield pa.RecordBatch.from_arrays([encoded(classes, start, of.size)], names=["classes"])

    return fit(learn.select("text").mapInArrow(run, "classes binary"), q)


def fit(learn: DataFrame, q):
    """r, w, log normalisers z of r's rows, and the mixture's weights; learn has the column classes (``encoded``)."""
    import numpy as np

    sc, size = learn.sparkSession.sparkContext, len(q)
    rng = np.random.default_rng(11)
    r, w = (rng.normal(0, 0.1, (k * size, DIM + 1)).astype(np.float32) for k in (CONTEXT, 1))
    r[:, -1], w[:, -1] = 1, np.log(q)
    weights, z = np.full(CONTEXT + 1, 1 / (CONTEXT + 1)), None
    names = [f"d{i}" for i in range(DIM + 1)]
    for step in range(PASSES):
        sent = sc.broadcast((r, w, z, weights))

        def run(batches, sent=sent, step=step):
            lean("lm")
            r0, w0, z, weights = sent.value
            rng = np.random.default_rng(step)
            x = np.concatenate([r0, w0])
            gx = np.full(x.shape, 1e-2, np.float32)
            seen, mixed, tokens = np.zeros(len(x)), np.zeros(CONTEXT + 1), 0
            held, n, short = [], 0, np.min_scalar_type(len(r0) * size)

            def learn_held():
                key, c = np.unique(np.concatenate(held), return_counts=True)
                parts = -(-c // REPEAT)
                key, c = np.repeat(key, parts), np.repeat(c / parts, parts)
                h, t = np.divmod(key, key.dtype.type(size))
                train_nce(x, gx, q, h, t, c, rng, RATE / (step + 1))
                seen[: len(r0)] += np.bincount(h, c, len(r0))
                seen[len(r0) :] += np.bincount(t, c, size)

            for texts in (b.column(0)[a : a + PIECE] for b in batches for a in range(0, len(b), PIECE)):
                classes, start = decoded(texts, size)
                at = targets(len(classes), start)
                if not len(at):
                    continue
                h, t = contexts(classes, at, size), classes[at]
                if z is not None:
                    mixed += len(t) * mix(components(r0, w0, z, q, h, t), weights, 10)
                    tokens += len(t)
                held.append((h * size + t[:, None]).astype(short).ravel())
                n += len(t)
                if n >= TOKENS:
                    learn_held()
                    held, n = [], 0
            if held:
                learn_held()
            rows = np.flatnonzero(seen)
            values = x[rows]
            weight = seen[rows]
            if tokens:
                rows, weight = np.append(rows, -1), np.append(weight, tokens)
                last = np.zeros((1, DIM + 1))
                last[0, : CONTEXT + 1] = mixed / tokens
                values = np.concatenate([values, last])
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(weight), *(pa.array(values[:, i].astype(np.float32)) for i in range(DIM + 1))], names=["row", "weight", *names])

        parts = learn.select("classes").mapInArrow(run, "row long, weight double, " + ", ".join(f"{x} float" for x in names))
        mean = parts.groupBy("row").agg(F.sum("weight").alias("weight"), *[(F.sum(F.col(x) * F.col("weight")) / F.sum("weight")).cast("float").alias(x) for x in names]).toArrow()
        rows = mean.column("row").to_numpy()
        values = np.stack([mean.column(x).to_numpy() for x in names], 1) if len(rows) else np.zeros((0, DIM + 1), np.float32)
        both, ok = np.concatenate([r, w]), rows >= 0
        both[rows[ok]] = values[ok]
        if not ok.all():
            weights = values[~ok][0, : CONTEXT + 1].astype(float)
        r, w = both[: len(r)], both[len(r) :]
        sent.destroy()
        z = normalisers(learn.sparkSession, r, w)
    return r, w, z, weights / weights.sum()


def normalisers(spark, r, w):
    """log of the sum over all classes of exp(score), for every row of r: batched matrix products, dealt over tasks."""
    import numpy as np

    sent = spark.sparkContext.broadcast((r, w))

    def run(batches):
        r, w = sent.value
        for b in batches:
            rows, out = b.column(0).to_numpy(), []
            for a in range(0, len(rows), 256):
                s = r[rows[a : a + 256]] @ w.T
                m = s.max(1, keepdims=True)
                out.append(np.log(np.exp(s - m).sum(1)) + m[:, 0])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.concatenate(out).astype(float) if out else [], pa.float64())], names=["id", "z"])

    found = spark.range(0, len(r), 1, 1 + len(r) * len(w) // (1 << 25)).mapInArrow(run, "id long, z double").toArrow()
    z = np.zeros(len(r))
    z[found.column("id").to_numpy()] = found.column("z").to_numpy()
    sent.destroy()
    return z


def lm_score(df: DataFrame, heavy: int = HEAVY, classes: int = CLASSES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row."""
    import numpy as np

    s = Scratch(df.sparkSession)
    docs = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    learn = docs.where(~held_out(F.col("doc_id")))
    counts = s.keep(count_words(learn), "counts")
    of, n, v = vocabulary(counts, heavy, classes)
    q = of.unigram()
    base_log = float(np.log10(n + 0.1 * (v + 1)))
    end_log = float(np.log10(of.class_count[0] + 0.1))
    end_known = int(of.class_count[0] > 0)
    vocab = df.sparkSession.sparkContext.broadcast(of)
    fields = "rid long, doc_id long, n_tokens long, n_seen long, base double, inside double, rare array<struct<word:binary,tf:long>>, classes binary"
    rare_type = pa.list_(pa.struct([("word", pa.binary()), ("tf", pa.int64())]))

    def read(batches):
        lean("lm")
        of = vocab.value
        shares, log_c, miss = of.shares(), np.log10(np.append(of.known, 1) + 0.1), len(of.words)
        for b in batches:
            places, c, start, rare, holder = of.read(b.column(2))
            at = targets(len(c), start)
            if not len(start):
                continue
            first = start - CONTEXT * np.arange(len(start))
            p, t = places[at], c[at]
            logs = np.where((p >= 0) & (p < miss), log_c[p], 0.0)
            inside = np.where(t > of.own, logs - shares[t], 0.0)
            base = np.where(p < 0, end_log, logs) - np.where(p == miss, 0.0, base_log)
            seen = np.where(p < 0, end_known, p < miss)
            sizes = np.diff(np.append(first, len(at)))
            width = max(1, len(rare.dictionary))
            key, tf = np.unique(holder * width + rare.indices.to_numpy(), return_counts=True)
            found = pa.StructArray.from_arrays([rare.dictionary.take(pa.array(key % width)), pa.array(tf, pa.int64())], fields=list(rare_type.value_type))
            found = pa.ListArray.from_arrays(pa.array(np.searchsorted(key, np.arange(len(start) + 1) * width), pa.int32()), found)
            sums = [pa.array(np.add.reduceat(x, first), k) for x, k in ((seen.astype(np.int64), pa.int64()), (base, pa.float64()), (inside, pa.float64()))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(sizes), *sums, found, encoded(c, start, of.size)], names=["rid", "doc_id", "n_tokens", "n_seen", "base", "inside", "rare", "classes"])

    # texts are read once: both passes and the scores need only their classes
    texts = s.keep(docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", "text").mapInArrow(read, fields), "texts")
    vocab.destroy()
    sent = df.sparkSession.sparkContext.broadcast((q, *fit(texts.where(~held_out(F.col("doc_id"))), q)))

    def run(batches):
        lean("lm")
        q, r, w, z, weights = sent.value
        for b in (b[a : a + PIECE] for b in batches for a in range(0, len(b), PIECE)):
            c, start = decoded(b.column(6), len(q))
            at = targets(len(c), start)
            if not len(start):
                continue
            lm = np.log10(components(r, w, z, q, contexts(c, at, len(q)), c[at]) @ weights)
            lm = np.add.reduceat(lm, start - CONTEXT * np.arange(len(start))) + b.column(5).to_numpy()
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(lm)], names=["rid", "doc_id", "n_tokens", "n_seen", "base", "lm"])

    scored = s.keep(texts.drop("rare").mapInArrow(run, "rid long, doc_id long, n_tokens long, n_seen long, base double, lm double"), "scored")
    sent.destroy()
    rare = texts.select("rid", F.explode("rare").alias("x")).select("rid", "x.word", "x.tf")
    c = F.coalesce(F.col("c"), F.lit(0))
    sums = rare.join(counts, "word", "left").groupBy("rid").agg(F.sum(F.col("tf") * F.log10(c + 0.1)).alias("logs"), F.sum("tf").alias("tf"), F.sum(F.when(F.col("c") > 0, F.col("tf")).otherwise(0)).alias("known"))
    logs, tf = F.coalesce("logs", F.lit(0.0)), F.coalesce("tf", F.lit(0))
    return scored.join(sums, "rid", "left").select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "n_tokens",
        (F.col("n_seen") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + logs - tf * F.lit(base_log)).alias("base_score"),
        (F.col("lm") + logs).alias("score"),
    )
