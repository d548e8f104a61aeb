"""Operator 10: approximate nearest neighbours in robust-pruned directed graphs.

Distinct vectors are dealt to shards by their hash. In each shard a graph is built in batches: greedy searches over the
graph so far propose neighbours, pruning with a relaxed distance keeps a diverse few, and reverse edges are pruned the
same way. Beam searches then run each block of queries on each shard's graph, and the best of all shards are kept.

Equal vectors share one node; of their ids the ``TOP + 1`` smallest are kept, which is all that ten neighbours without
the query's own row can need, so a vector that a third of all rows hold is no heavier than another.

Defined results: vectors that are null, empty, zero, or hold null or non-finite components take no part, neither as
queries nor as candidates; vectors of another length are no candidates; rows without an id take no part; repeated ids
count once for each distinct vector; fewer candidates than ten give fewer rows; an empty table gives none.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch

TOP = 10
EVERY = 100
SHARD = 2500
BLOCK = 256
DEGREE = 24
BUILD_BEAM = 48
BEAM = 64
RELAX = 1.2
#: Shards up to this size are scanned whole.
SCAN = 128


def distances(v, a, b):
    """Squared distances between rows ``a`` (n) of v and rows ``b`` (n, k) of v, or between vectors a (n, d) and rows b."""
    import numpy as np

    x = v[b] - (a if a.ndim == 2 else v[a])[:, None, :]
    return np.einsum("nkd,nkd->nk", x, x)


def beam_search(v, graph, entry: int, q, beam: int):
    """(ids, squared distances), (len(q), beam): the nearest that greedy beam search reaches; -1 and inf where fewer."""
    import numpy as np

    n, k = len(q), graph.shape[1]
    ids, dist, done = np.full((n, beam), -1), np.full((n, beam), np.inf, np.float32), np.ones((n, beam), bool)
    seen = np.zeros((n, len(v)), bool)
    ids[:, 0], done[:, 0], seen[:, entry] = entry, False, True
    dist[:, 0] = ((q - v[entry]) ** 2).sum(1)
    act = np.arange(n)
    while len(act):
        open_d = np.where(done[act], np.inf, dist[act])
        at = open_d.argmin(1)
        more = np.isfinite(open_d[np.arange(len(act)), at])
        act, at = act[more], at[more]
        if not len(act):
            break
        done[act, at] = True
        near = graph[ids[act, at]]
        bad = (near < 0) | seen[act[:, None], near]
        d = distances(v, q[act], np.where(bad, 0, near)).astype(np.float32)
        d[bad] = np.inf
        r, c = np.nonzero(~bad)
        seen[act[r], near[r, c]] = True
        all_i, all_d = np.concatenate([ids[act], near], 1), np.concatenate([dist[act], d], 1)
        all_f = np.concatenate([done[act], np.zeros((len(act), k), bool)], 1)
        o = np.argsort(all_d, 1, kind="stable")[:, :beam]
        rows = np.arange(len(act))[:, None]
        ids[act], dist[act], done[act] = all_i[rows, o], all_d[rows, o], all_f[rows, o] | ~np.isfinite(all_d[rows, o])
    return np.where(np.isfinite(dist), ids, -1), dist


def prune(v, p, cand, degree: int, relax: float):
    """Of candidates (n, c; -1: none) keep those not nearer, relaxed, to a kept one than to the point itself."""
    import numpy as np

    n = len(p)
    d = distances(v, p, np.maximum(cand, 0))
    d[(cand < 0) | (cand == p[:, None])] = np.inf
    o = np.argsort(d, 1, kind="stable")
    rows = np.arange(n)[:, None]
    cand, d = cand[rows, o], d[rows, o]
    d[:, 1:][cand[:, 1:] == cand[:, :-1]] = np.inf
    x = v[np.maximum(cand, 0)]
    sq = np.einsum("ncd,ncd->nc", x, x)
    between = np.maximum(sq[:, :, None] + sq[:, None, :] - 2 * x @ x.transpose(0, 2, 1), 0) * relax**2
    out, alive, r = np.full((n, degree), -1), np.isfinite(d), np.arange(n)
    for k in range(degree):
        at = alive.argmax(1)
        ok = alive[r, at]
        if not ok.any():
            break
        out[ok, k] = cand[ok, at[ok]]
        alive &= ~((between[r, at] <= d) & ok[:, None])
        alive[r, at] = False
    return out


def build(v, degree: int = DEGREE, beam: int = BUILD_BEAM, relax: float = RELAX):
    """(graph (n, degree), entry) over the rows of v, float32."""
    import numpy as np

    n = len(v)
    graph = np.full((n, degree), -1)
    entry = int(((v - v.mean(0)) ** 2).sum(1).argmin())
    order = np.random.default_rng(7).permutation(n)
    order = np.concatenate([[entry], order[order != entry]])
    for sweep in (1.0, relax):
        i = 1
        while i < n:
            size = min(max(1, i if sweep == 1.0 else 256), 256, n - i)
            p = order[i : i + size]
            found, _ = beam_search(v, graph, entry, v[p], beam)
            graph[p] = prune(v, p, np.concatenate([found, graph[p]], 1), degree, sweep)
            src, dst = np.repeat(p, degree), graph[p].ravel()
            src, dst = src[dst >= 0], dst[dst >= 0]
            o = np.argsort(dst, kind="stable")
            src, dst = src[o], dst[o]
            to, first, count = np.unique(dst, return_index=True, return_counts=True)
            new = np.full((len(to), int(count.max())), -1)
            new[np.repeat(np.arange(len(to)), count), np.arange(len(dst)) - np.repeat(first, count)] = src
            if new.shape[1] > 2 * degree:  # the nearest of many
                d = np.where(new < 0, np.inf, distances(v, to, np.maximum(new, 0)))
                new = np.take_along_axis(new, np.argsort(d, 1, kind="stable")[:, : 2 * degree], 1)
            graph[to] = prune(v, to, np.concatenate([graph[to], new], 1), degree, sweep)
            i += size
    return graph, entry


def valid(df: DataFrame) -> DataFrame:
    """vec_id, v (array<double>) of the rows that take part."""
    v = F.col("embedding").cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return df.where(F.col("embedding").isNotNull() & F.col("vec_id").isNotNull()).where(finite & F.exists(v, lambda x: x != 0)).select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(v, lambda x: x + F.lit(0.0)).alias("v"))


def index(rows: DataFrame, s: Scratch, shard: int = SHARD) -> DataFrame:
    """dim, shard, n, vectors, ids, graph, entry: one row a shard."""
    first = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    kept = rows.withColumn("k", first).where(F.col("k") <= TOP + 1)
    nodes = s.keep(kept.groupBy("v").agg(F.array_sort(F.collect_set("vec_id")).alias("ids")), "nodes")
    shards = max(1, -(-nodes.count() // shard))
    schema = pa.schema([("dim", pa.int32()), ("shard", pa.int64()), ("n", pa.int64()), ("vectors", pa.binary()), ("ids", pa.binary()), ("graph", pa.binary()), ("entry", pa.int64())])

    def make(t: pa.Table) -> pa.Table:
        import numpy as np

        t = t.take(pa.array(np.argsort(np.array([x[0] for x in t.column("ids").to_pylist()]), kind="stable")))
        v = np.array(t.column("v").to_pylist(), np.float64)
        ids = np.full((len(v), TOP + 1), -(1 << 63), np.int64)
        for i, x in enumerate(t.column("ids").to_pylist()):
            ids[i, : len(x)] = x
        graph, entry = build(v.astype(np.float32)) if len(v) > SCAN else (np.zeros((0, 1), np.int64), 0)
        return pa.Table.from_pydict({"dim": [v.shape[1]], "shard": [t.column("shard")[0].as_py()], "n": [len(v)], "vectors": [v.tobytes()], "ids": [ids.tobytes()], "graph": [graph.astype(np.int32).tobytes()], "entry": [entry]}, schema)

    dealt = nodes.select(F.size("v").alias("dim"), F.pmod(F.xxhash64("v"), F.lit(shards)).alias("shard"), "v", "ids")
    return s.keep(dealt.groupBy("dim", "shard").applyInArrow(make, "dim int, shard long, n long, vectors binary, ids binary, graph binary, entry long"), "index")


def nearest(df: DataFrame, every: int = EVERY, top: int = TOP, shard: int = SHARD) -> DataFrame:
    """query_id, rank, vec_id, score: each query's ``top`` nearest found (at most ``TOP``)."""
    s = Scratch(df.sparkSession)
    rows = s.keep(valid(df), "rows")
    built = index(rows, s, shard)
    queries = rows.where(F.pmod(F.col("vec_id"), F.lit(every)) == 0)
    blocks = max(1, -(-queries.count() // BLOCK))
    asked = queries.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks))).groupBy(F.size("v").alias("dim"), "block").agg(F.collect_list(F.struct("vec_id", "v")).alias("q"))
    pairs = built.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))).join(asked, ["dim", "block"])
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def search(batches):
        import numpy as np

        for b in batches:
            for r in b.to_pylist():
                v = np.frombuffer(r["vectors"]).reshape(r["n"], r["dim"])
                ids = np.frombuffer(r["ids"], np.int64).reshape(r["n"], TOP + 1)
                qid, q = np.array([x["vec_id"] for x in r["q"]]), np.array([x["v"] for x in r["q"]])
                if r["n"] > SCAN:
                    graph = np.frombuffer(r["graph"], np.int32).reshape(r["n"], -1)
                    found, _ = beam_search(v.astype(np.float32), graph, r["entry"], q.astype(np.float32), BEAM)
                else:
                    found = np.tile(np.arange(r["n"]), (len(q), 1))
                out = []
                for i in range(len(q)):
                    at = found[i][found[i] >= 0]
                    d = np.sqrt(((v[at] - q[i]) ** 2).sum(1))
                    who, dist = ids[at].ravel(), np.repeat(d, TOP + 1)
                    ok = (who != -(1 << 63)) & (who != qid[i])
                    who, dist = who[ok], dist[ok]
                    o = np.lexsort((who, dist))[:top]
                    out += [(int(qid[i]), int(w), float(x)) for w, x in zip(who[o], dist[o], strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), schema.types, strict=True)], schema=schema) if out else pa.RecordBatch.from_pylist([], schema)

    spread = pairs.select("n", "dim", "vectors", "ids", "graph", "entry", "q")
    hits = spread.mapInArrow(search, "query_id long, vec_id long, score double").dropDuplicates(["query_id", "vec_id", "score"])
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return hits.withColumn("rank", rank).where(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")
