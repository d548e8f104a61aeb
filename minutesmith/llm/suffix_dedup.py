"""Operator 4: removal of repeated passages by deep-shallow suffix sorting.

A byte goes if some ``WIDTH``-byte string that covers it also starts in a document with a smaller id. Equal strings have
to meet in one task: each window of ``WIDTH`` bytes is dealt by its anchor, the smallest-hashed ``GRAM``-gram inside it,
which its content alone decides. A first pass finds the anchors that two documents share; a second pass ships only the
text around those. In its task every window is a suffix, sorted by multikey refinement of eight-byte words to a shallow
depth; groups that are still together have long common prefixes and are ordered by blind tries, built level by level:
each suffix is compared once with its group's first one and only the place and byte of the mismatch branch the trie.

A bitmap of fixed size tells the second pass which anchors are shared; where bits collide, more is shipped and the sort
decides, so the outcome is exact at any size.

Defined results: null text counts as empty; texts below ``WIDTH`` bytes lose nothing; rows that repeat an id are no
smaller than one another; a null id ranks above all others; repeated rows each give a row.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, fresh, lean

WIDTH = 50
GRAM = 24
SHALLOW = 16
BITS = 1 << 27
BUCKET_BYTES = 1 << 20
FLUSH = 400_000
SUFFIXES = 100_000
#: Bytes of text whose anchors are computed at a time.
STRETCH = 1 << 19
NULL_ID = (1 << 63) - 1


def scramble(x):
    import numpy as np

    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def gram_hashes(b, gram: int = GRAM):
    """A 64-bit hash of the ``gram`` bytes from each place on, by doubling."""
    import numpy as np

    base, out, length, done = 0x9E3779B97F4A7C15, None, 1, 0
    h = scramble(b.astype(np.uint64) + np.uint64(1))
    power = base
    rest = gram
    while rest:
        if rest & 1:
            if out is None:
                out, done = h.copy(), length
            else:  # what is done stands before this block
                n = len(b) - done - length + 1
                out = out[:n] * np.uint64(power) + h[done : done + n] if n > 0 else out[:0]
                done += length
        rest >>= 1
        if rest:
            n = max(0, len(h) - length)
            h = h[:n] * np.uint64(power) + h[length : length + n]
            power = power * power % (1 << 64)
            length *= 2
    return scramble(out)


def anchors(b, begin, width: int = WIDTH, gram: int = GRAM, stretch: int = STRETCH):
    """(anchor hash, document, first window, last window): runs of windows of one document with one anchor.

    b: the bytes of all texts; begin: where each text begins, and the end. Memory is bounded by ``stretch``, however long
    the texts are: a run that crosses from one stretch into the next is told as two.
    """
    import numpy as np

    found = []
    for lo in range(0, max(1, len(b) - width + 1), stretch):
        hi = min(len(b), lo + stretch + width - 1)
        d0, d1 = int(np.searchsorted(begin, lo, "right")) - 1, int(np.searchsorted(begin, hi, "left"))
        h, doc, w0, w1 = _anchors(b[lo:hi], np.clip(begin[max(0, d0) : d1 + 1] - lo, 0, hi - lo), width, gram)
        found.append((h, doc + max(0, d0), w0 + lo, w1 + lo))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _anchors(b, begin, width: int, gram: int):
    import numpy as np

    none = np.zeros(0, np.int64)
    span = width - gram + 1
    if len(b) < width:
        return none.astype(np.uint64), none, none, none
    v = gram_hashes(b, gram)
    p = np.arange(len(v), dtype=np.int32)
    have = 1
    while have < span:
        s = min(have, span - have)
        take = v[s:] < v[:-s]
        v, p = np.where(take, v[s:], v[:-s]), np.where(take, p[s:], p[:-s])
        have += s
    n = len(b) - width + 1
    v, p = v[:n], p[:n]
    doc = np.repeat(np.arange(len(begin) - 1, dtype=np.int32), np.diff(begin))
    ok = doc[:n] == doc[width - 1 :]
    at = np.flatnonzero(ok)
    if not len(at):
        return none.astype(np.uint64), none, none, none
    pa_, da = p[at], doc[at]
    new = np.flatnonzero(np.concatenate([[True], (pa_[1:] != pa_[:-1]) | (da[1:] != da[:-1])]))
    last = np.concatenate([new[1:] - 1, [len(at) - 1]])
    return v[at[new]], da[new].astype(np.int64), at[new], at[last]


def text_bytes(col):
    """(all bytes, begins) of an Arrow string column without copying."""
    import numpy as np

    col = col.cast(pa.large_string()) if not pa.types.is_large_string(col.type) else col
    begin = np.frombuffer(col.buffers()[1], np.int64, len(col) + 1, col.offset * 8)
    data = col.buffers()[2]
    b = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return b[begin[0] : begin[-1]], begin - begin[0]


def _find_shared(docs: DataFrame, buckets: int, width: int, gram: int, bits: int):
    """The bitmap of anchors that two documents share; each bucket fills its own stretch of it."""
    import numpy as np

    own = bits // buckets // 8 * 8

    def emit(batches):
        lean()
        held, size = [], 0

        def flush():
            h, d = (np.concatenate(x) for x in zip(*held, strict=True))
            k = ((h >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
            o = np.lexsort((d, h, k))
            k, h, d = k[o], h[o], d[o]
            new = np.concatenate([[True], h[1:] != h[:-1]])
            ends = new | np.append(new[1:], True)  # of an anchor's documents the smallest and the largest are enough
            k, h, d = k[ends], h[ends].astype(np.uint32), d[ends]
            first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
            end = np.append(first[1:], len(k))
            rows = [(int(k[i]), h[i:j].tobytes(), d[i:j].tobytes()) for i, j in zip(first, end, strict=True)]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.binary(), pa.binary()), strict=True)], names=["bucket", "h", "d"])

        for b in batches:
            text, begin = text_bytes(b.column(2))
            h, doc, _, _ = anchors(text, begin, width, gram)
            if len(h):
                ids = b.column(0).to_numpy()[doc]
                held.append((h, ids))
                size += len(h)
            if size >= FLUSH:
                yield flush()
                held, size = [], 0
        if held:
            yield flush()

    def shared(t: pa.Table) -> pa.Table:
        h = np.frombuffer(b"".join(t.column("h").to_pylist()), np.uint32)
        d = np.frombuffer(b"".join(t.column("d").to_pylist()), np.int64)
        o = np.argsort(h, kind="stable")
        h, d = h[o], d[o]
        first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        two = np.minimum.reduceat(d, first) != np.maximum.reduceat(d, first)
        bitmap = np.zeros(own, np.uint8)
        bitmap[h[first[two]] % own] = 1
        return pa.table({"bucket": t.column("bucket")[:1], "bits": pa.array([np.packbits(bitmap).tobytes()], pa.binary())})

    rows = docs.mapInArrow(emit, "bucket long, h binary, d binary").groupBy("bucket").applyInArrow(shared, "bucket long, bits binary").collect()
    out = np.zeros((buckets, own // 8), np.uint8)
    for r in rows:
        out[r["bucket"]] = np.frombuffer(r["bits"], np.uint8)
    return out.ravel(), own


def sort_classes(text, start, width: int, shallow: int = SHALLOW):
    """The class (first equal suffix in sorted order) of each suffix text[start : start + width], by deep-shallow sorting.

    Returns (order, class number by place in ``order``).
    """
    import numpy as np

    n, words = len(start), -(-width // 8)
    grid = np.zeros((n, words * 8), np.uint8)
    grid[:, :width] = np.lib.stride_tricks.sliding_window_view(text, width)[start]
    w = grid.view(">u8").astype(np.uint64)
    # shallow: refine groups word by word
    order, group = np.arange(n), np.zeros(n, np.int64)
    for k in range(max(1, shallow // 8)):
        o = np.lexsort((w[order, k], group))
        order, group = order[o], group[o]
        x = w[order, k]
        group = np.cumsum(np.concatenate([[0], (x[1:] != x[:-1]) | (group[1:] != group[:-1])]))
    # deep: a blind trie for each group, all groups one level at a time
    open_ = np.arange(n)
    while len(open_):
        g = group[open_]
        head = np.concatenate([[True], g[1:] != g[:-1]])
        first = open_[np.maximum.accumulate(np.where(head, np.arange(len(open_)), 0))]
        a, b = grid[order[open_]], grid[order[first]]
        differs = a != b
        place = np.where(differs.any(1), differs.argmax(1), words * 8)
        at = np.minimum(place, words * 8 - 1)
        byte, ref = a[np.arange(len(a)), at].astype(np.int64), b[np.arange(len(a)), at]
        if (place == words * 8).all():
            break
        # smaller than the first: before it, the nearest mismatch first; greater: after it, the nearest mismatch last
        side = np.where(place == words * 8, 0, np.where(byte < ref, -1, 1))
        depth = np.where(side < 0, place, -place)
        o = np.lexsort((byte, depth, side, g))
        order[open_] = order[open_][o]
        key = np.stack([g[o], side[o], depth[o], np.where(side[o] == 0, 0, byte[o])], 1)
        cut = np.concatenate([[False], (key[1:] != key[:-1]).any(1)])
        new = np.zeros(n, np.int64)
        edges = np.concatenate([[False], group[1:] != group[:-1]])
        edges[open_[cut]] = True
        new = np.cumsum(edges)
        same = np.zeros(n, bool)
        same[open_] = side[o] == 0
        group = new
        size = np.bincount(group)
        open_ = open_[(~same[open_]) & (size[group[open_]] > 1)]
    return order, group


def _sort_bucket(h, d, s0, size, blob, width: int):
    """(context, first byte, end) of the bytes to remove, contexts given by arrays of equal length.

    Contexts of different anchors share no window, so they are sorted apart, ``SUFFIXES`` windows or one anchor at a time.
    """
    import numpy as np

    begin = np.cumsum(size) - size
    o = np.argsort(h, kind="stable")
    ends = np.flatnonzero(np.concatenate([h[o][1:] != h[o][:-1], [True]])) + 1
    load = np.cumsum(size[o] - width + 1)
    out, at = [], 0
    while at < len(o):
        want = (load[at - 1] if at else 0) + SUFFIXES
        i = np.searchsorted(ends, max(np.searchsorted(load, want, side="right"), at + 1), side="right")
        end = ends[max(i - 1, np.searchsorted(ends, at, side="right"))]
        out.append(_sort_some(o[at:end], d, s0, begin, size, blob, width))
        at = end
    return [np.concatenate(x) for x in zip(*out, strict=True)]


def _sort_some(part, d, s0, begin, size, blob, width: int):
    import numpy as np

    most = int(size[part].max())
    grid = blob[np.minimum(begin[part][:, None] + np.arange(most), len(blob) - 1)]
    grid[np.arange(most) >= size[part][:, None]] = 0
    rows = np.concatenate([grid, size[part].astype(np.uint8)[:, None]], 1)
    _, one, copy = np.unique(np.ascontiguousarray(rows).view(f"V{most + 1}").ravel(), return_index=True, return_inverse=True)
    del grid, rows
    least_of = np.full(len(one), NULL_ID)
    np.minimum.at(least_of, copy, d[part])  # equal contexts are sorted once, under their smallest document
    src = part[one]
    wins = size[src] - width + 1
    base = np.cumsum(wins) - wins
    ctx = np.repeat(np.arange(len(one)), wins)
    order, group = sort_classes(blob, begin[src][ctx] + np.arange(len(ctx)) - base[ctx], width)
    doc = least_of[ctx][order]
    first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    least = np.empty(len(ctx), np.int64)
    least[order] = np.repeat(np.minimum.reduceat(doc, first), np.diff(np.append(first, len(doc))))
    n = wins[copy]
    own = np.repeat(np.arange(len(part)), n)
    k = np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n)
    at = np.flatnonzero(d[part][own] > least[base[copy][own] + k])
    if not len(at):
        return at, at, at
    new = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1] + 1) | (own[at[1:]] != own[at[:-1]])]))
    last = at[np.append(new[1:] - 1, len(at) - 1)]
    a = at[new]
    c = part[own[a]]
    return c, s0[c] + k[a], s0[c] + k[last] + width


def _cover(docs: DataFrame, held, own: int, buckets: int, width: int, gram: int) -> DataFrame:
    """doc, rk, a, z: intervals of repeated bytes, some rows for each document that has any."""

    def emit(batches):
        import numpy as np
        import zstandard

        lean()
        pack = zstandard.ZstdCompressor(level=1).compress
        bits = held.value
        stock, size = [], 0

        def flush():
            k, h, doc, rk, s0, n = (np.concatenate([x[i] for x in stock]) for i in range(6))
            texts = np.concatenate([x[6] for x in stock])
            begin = np.cumsum(n) - n
            o = np.lexsort((h, k))
            k = k[o]
            first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
            rows = []
            for i, j in zip(first, np.append(first[1:], len(k)), strict=True):
                x = o[i:j]
                m = n[x]
                idx = np.repeat(begin[x] - (np.cumsum(m) - m), m) + np.arange(m.sum())
                rows.append((int(k[i]), h[x].astype(np.uint32).tobytes(), doc[x].tobytes(), rk[x].tobytes(), s0[x].astype(np.int32).tobytes(), m.astype(np.uint8).tobytes(), pack(texts[idx].tobytes())))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), *[pa.binary()] * 6), strict=True)], names=["bucket", "h", "doc", "rk", "s0", "size", "blob"])

        for b in batches:
            text, begin = text_bytes(b.column(2))
            h, doc, w0, w1 = anchors(text, begin, width, gram)
            if not len(h):
                continue
            k = ((h >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
            bit = k * own + (h & np.uint64(0xFFFFFFFF)).astype(np.int64) % own
            hit = np.flatnonzero((bits[bit >> 3] >> (7 - (bit & 7)).astype(np.uint8)) & 1 == 1)
            for at in np.array_split(hit, -(-len(hit) // (FLUSH // 4))) if len(hit) else ():
                n = w1[at] - w0[at] + width
                idx = np.repeat(w0[at] - (np.cumsum(n) - n), n) + np.arange(n.sum())
                stock.append((k[at], h[at], b.column(0).to_numpy()[doc[at]], b.column(1).to_numpy()[doc[at]], w0[at] - begin[doc[at]], n, text[idx]))
                size += len(at)
                if size >= FLUSH // 4:
                    yield flush()
                    stock, size = [], 0
        if stock:
            yield flush()

    def find(t: pa.Table) -> pa.Table:
        import numpy as np
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        read = lambda c, kind: np.frombuffer(b"".join(t.column(c).to_pylist()), kind)
        doc, rk, s0, size = read("doc", np.int64), read("rk", np.int64), read("s0", np.int32).astype(np.int64), read("size", np.uint8).astype(np.int64)
        blob = np.frombuffer(b"".join([unpack(x) for x in t.column("blob").to_pylist()]), np.uint8)
        c, a, z = _sort_bucket(read("h", np.uint32), doc, s0, size, blob, width)
        span = np.stack([a, z], 1).astype(np.int32) if len(c) else np.zeros((0, 2), np.int32)
        return pa.table({"doc": doc[c], "rk": rk[c], "a": span[:, 0], "z": span[:, 1]})

    rows = docs.mapInArrow(emit, "bucket long, h binary, doc binary, rk binary, s0 binary, size binary, blob binary")
    return rows.groupBy("bucket").applyInArrow(find, "doc long, rk long, a int, z int")


def merge(spans):
    """Maximal runs of sorted (begin, end) pairs; touching ones unite."""
    out: list[list[int]] = []
    for a, z in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], z)
        else:
            out.append([a, z])
    return out


def _with_spans(df: DataFrame, width: int, gram: int, bits: int) -> tuple[DataFrame, str, str]:
    """(the columns of ``df``, the text without nulls, and the spans to remove), and the names of the last two."""
    s = Scratch(df.sparkSession)
    doc, rk, text, spans = (fresh(df, n) for n in ("_doc", "_rk", "_text", "_spans"))
    ranked = df.withColumns({doc: F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)), text: F.coalesce(F.col("text").cast("string"), F.lit(""))}).withColumn(rk, F.xxhash64(text))
    docs = ranked.select(F.col(doc).alias("doc"), F.col(rk).alias("rk"), F.col(text).alias("text"))
    total = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    buckets = max(16, min(1 << 20, total // BUCKET_BYTES))
    bitmap, own = _find_shared(docs, buckets, width, gram, bits)
    held = df.sparkSession.sparkContext.broadcast(bitmap)
    cover = s.keep(_cover(docs, held, own, buckets, width, gram), "cover")
    held.destroy()
    found = cover.groupBy(F.col("doc").alias(doc), F.col("rk").alias(rk)).agg(F.collect_set(F.struct("a", "z")).alias(spans))
    return ranked.join(found, [doc, rk], "left"), text, spans


def _cut(text: str, spans) -> tuple[bytes, int, int, int]:
    raw = text.encode("utf-8", "surrogatepass")
    runs = merge([(x["a"], x["z"]) for x in spans or ()])
    kept, at = [], 0
    for a, z in runs:
        kept.append(raw[at:a])
        at = z
    kept.append(raw[at:])
    return b"".join(kept), len(raw), sum(z - a for a, z in runs), len(runs)


def suffix_dedup(df: DataFrame, width: int = WIDTH, gram: int = GRAM, bits: int = BITS) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])

    def run(batches):
        lean()
        for b in batches:
            out = [_cut(t, x) for t, x in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x[1] for x in out], pa.int64()), pa.array([x[2] for x in out], pa.int64()), pa.array([x[3] for x in out], pa.int64()), pa.array([hashlib.sha256(x[0]).hexdigest() for x in out], pa.string())], schema=schema)

    rows, text, spans = _with_spans(df, width, gram, bits)
    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), text, spans).mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def remove_repeats(df: DataFrame, width: int = WIDTH, gram: int = GRAM, bits: int = BITS) -> DataFrame:
    """The columns of ``df`` with repeated bytes cut out of text. A character of which a byte goes, goes whole."""

    def run(batches):
        lean()
        for b in batches:
            at = b.schema.get_field_index("text")
            text = [None if t is None else _cut(t, x)[0].decode("utf-8", "ignore") for t, x in zip(b.column(at).to_pylist(), b.column(b.num_columns - 1).to_pylist(), strict=True)]
            keep = [i for i in range(b.num_columns) if i < b.num_columns - 1]
            yield pa.RecordBatch.from_arrays([pa.array(text, pa.string()) if i == at else b.column(i) for i in keep], names=[b.schema.names[i] for i in keep])

    rows, _, spans = _with_spans(df, width, gram, bits)
    return rows.select(*df.columns, spans).mapInArrow(run, df.schema)


SQL = """
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
g AS MATERIALIZED (SELECT rid, doc_id, p, hash(substr(h, 2 * p + 1, 100)) AS k, substr(h, 2 * p + 1, 100) AS x FROM (SELECT rid, doc_id, h, unnest(range(0, len(h) // 2 - 49)) AS p FROM d)),
hits AS (
  SELECT rid, p FROM (SELECT rid, doc_id, p, min(doc_id) OVER (PARTITION BY k, x) AS f FROM g) WHERE f < doc_id),
runs AS (
  SELECT rid, min(p) AS a, max(p) + 50 AS z FROM (
    SELECT rid, p, sum(CASE WHEN p - q <= 50 THEN 0 ELSE 1 END) OVER (PARTITION BY rid ORDER BY p) AS run
    FROM (SELECT rid, p, lag(p) OVER (PARTITION BY rid ORDER BY p) AS q FROM hits))
  GROUP BY rid, run),
pieces AS (
  SELECT rid, a, z, coalesce(lag(z) OVER (PARTITION BY rid ORDER BY a), 0) AS b FROM runs),
cut AS (
  SELECT rid, sum(z - a) AS n_removed, count(*) AS n_spans, max(z) AS z, string_agg(substr(h, 2 * b + 1, 2 * (a - b)), '' ORDER BY a) AS head
  FROM pieces JOIN d USING (rid) GROUP BY rid)
SELECT doc_id, len(h) // 2 AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(z, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN cut USING (rid)
"""
