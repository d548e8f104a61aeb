"""Operator 11: the prefix trie of conversations, rolled up by bands of depth.

A conversation's turns are numbered by ranges of (conversation, turn), so that one that holds a third of all rows is spread
over many tasks. Its first turns may come from another conversation (``heads``: three turns at most). A prefix is known by
the exclusive or of its turns' marks, three 64-bit hashes of (depth, sha256 of role and text) each: a running sum that needs
no rounds, and the parent's key is the key without the last turn's marks.

Subtree totals: every node explodes only to its ancestors inside its band of ``HEIGHT`` depths (in a window over the path of
one of its conversations, so the explosion is a running sum). The topmost nodes of the bands form a trie ``HEIGHT`` times
lower; the same step completes their totals, and a completed total is handed once to the nodes of the band above. So there
are log(depth) rounds to the base ``HEIGHT``, and no row explodes to more than ``HEIGHT`` others.

The ids at a node's end may be a third of all conversations: they are ordered by ranges of (node, id), written in pieces of
``PIECE`` ids, and the pieces are streamed through the hash. Other values at nodes are counts and smallest ids, which are
aggregated before they are shuffled.

Defined results: a null role or text counts as empty; turns are ordered by turn (null first), ties by the sha256 of role and
text, and rows that repeat are turns each; rows without conv_id are left out; the conversation that lends its first turns to
c is c - c % 20 with the remainder's sign that of c; a conversation whose rebuilt form has no turn is a member of the root
only; an empty table gives no rows, not even a root; texts of any length are hashed and counted whole, by built-in
functions; columns beyond the four are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import CRC_SQL, Scratch, ranked

HEIGHT = 32
PIECE = 1 << 14
HEAD, EVERY = 4, 20
K = ["k0", "k1", "k2"]
WORD = r"[^\x20\x09-\x0D]+"


def _marks() -> list[Column]:
    return [F.xxhash64(F.lit(i), "depth", "turn_sha") for i in range(3)]


def rebuilt(s: Scratch, df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(c, depth, turn_sha, words) of every rebuilt turn, and (c, length) of every conversation."""
    role, text = (F.coalesce(F.col(x).cast("string"), F.lit("")) for x in ("role", "text"))
    rows = df.select(F.col("conv_id").cast("long").alias("c"), F.col("turn").cast("long").alias("turn"), F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)).alias("turn_sha"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))
    turns = ranked(s, rows.where(F.col("c").isNotNull()), ["c"], ["turn", "turn_sha"], "ordered")
    turns = s.keep(turns.select("c", F.col("n").alias("own"), (F.col("idx") + 1).alias("pos"), "turn_sha", "words"), "turns")
    heads = turns.where((F.col("c") % EVERY == 0) & (F.col("pos") < HEAD)).groupBy("c").agg(F.sort_array(F.collect_list(F.struct("pos", "turn_sha", "words"))).alias("head"))
    convs = turns.groupBy("c").agg(F.first("own").alias("own")).withColumn("h", F.pmod(F.crc32(F.col("c").cast("string").cast("binary")), F.lit(HEAD)).cast("int"))
    convs = convs.join(heads.withColumnRenamed("c", "base"), F.col("c") - F.col("c") % EVERY == F.col("base"), "left")
    head = F.slice(F.coalesce("head", F.array().cast(heads.schema["head"].dataType)), F.lit(1), F.col("h"))
    convs = s.keep(convs.select("c", "h", head.alias("head"), F.size(head).alias("taken"), (F.size(head) + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("length")), "convs")
    first = convs.select("c", F.explode("head").alias("t")).select("c", F.col("t.pos").alias("depth"), "t.turn_sha", "t.words")
    rest = turns.join(convs.select("c", "h", "taken"), "c").where("pos > h").select("c", (F.col("pos") - F.col("h") + F.col("taken")).alias("depth"), "turn_sha", "words")
    return s.keep(first.unionByName(rest), "rebuilt"), convs.select("c", "length")


def _keyed(s: Scratch, turns: DataFrame, height: int) -> DataFrame:
    """c, depth, words, the key of each prefix and its parent's key (p0, p1, p2)."""
    band = F.floor((F.col("depth") - 1) / height).alias("band")
    marks = turns.select("c", "depth", band, "words", *[m.alias(f"m{i}") for i, m in enumerate(_marks())])
    inside = Window.partitionBy("c", "band").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    runs = s.keep(marks.select("c", "depth", "band", "words", *[f"m{i}" for i in range(3)], *[F.expr(f"bit_xor(m{i})").over(inside).alias(f"r{i}") for i in range(3)]), "runs")
    # what a conversation's earlier bands give: only conversations of several bands have any
    past = Window.partitionBy("c").orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
    bands = runs.groupBy("c", "band").agg(*[F.expr(f"bit_xor(m{i})").alias(f"m{i}") for i in range(3)])
    carry = bands.select("c", "band", *[F.expr(f"bit_xor(m{i})").over(past).alias(f"y{i}") for i in range(3)]).where("band > 0")
    low = runs.where("band = 0").withColumns({f"y{i}": F.lit(0).cast("long") for i in range(3)})
    high = runs.where("band > 0").join(carry, ["c", "band"])
    every = low.unionByName(high)
    keys = [F.col(f"r{i}").bitwiseXOR(F.col(f"y{i}")) for i in range(3)]
    return s.keep(every.select("c", "depth", "words", *[k.alias(n) for k, n in zip(keys, K, strict=True)], *[k.bitwiseXOR(F.col(f"m{i}")).alias(f"p{i}") for i, k in enumerate(keys)]), "paths")


def _sums(paths: DataFrame, nodes: DataFrame, band: Column, order: Column | None) -> DataFrame:
    """key, leaves, saved: what ``nodes`` (c, depth, leaves, saved) give to the prefixes of their conversation's path in the
    same band: those at their depth and above (``order``), or all of the band."""
    none = F.lit(None).cast("long")
    path = paths.select("c", "depth", *K, none.alias("leaves"), none.alias("saved"))
    own = nodes.select("c", "depth", *[none.alias(k) for k in K], "leaves", "saved")
    w = Window.partitionBy("c", "band")
    if order is not None:
        w = w.orderBy(order).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    both = path.unionByName(own).withColumn("band", band)
    both = both.select(*K, F.sum("leaves").over(w).alias("leaves"), F.sum("saved").over(w).alias("saved"))
    return both.where(F.col(K[0]).isNotNull() & F.col("leaves").isNotNull())


def rollup(s: Scratch, paths: DataFrame, nodes: DataFrame, height: int, level: int = 0) -> DataFrame:
    """key, leaves, saved over each node's subtree.

    ``paths``: c, depth (from 1), key; ``nodes``: c (one conversation through the node), depth, key, leaves, saved.
    """
    band = F.floor((F.col("depth") - 1) / height)
    inside = _sums(paths, nodes, band, F.col("depth").desc()).groupBy(*K).agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    if (paths.agg(F.max("depth")).first()[0] or 0) <= height:
        return inside
    inside = s.keep(inside, f"inside{level}")
    long = paths.groupBy("c").agg(F.max("depth").alias("last")).where(F.col("last") > height).select("c")
    long = s.keep(paths.select("c", "depth", *K).join(long, "c"), f"long{level}")
    tops = long.where((F.col("depth") - 1) % height == 0).select("c", (F.floor((F.col("depth") - 1) / height) + 1).alias("depth"), *K)
    roots = tops.groupBy("depth", *K).agg(F.min("c").alias("c")).join(inside, K)
    total = rollup(s, tops, roots, height, level + 1)
    down = roots.where("depth > 1").select("c", "depth", *K).join(total, K)
    # a band's completed total goes to the band above: depth becomes that of the band's first prefix
    below = _sums(long, down.select("c", ((F.col("depth") - 2) * height + 1).alias("depth"), "leaves", "saved"), band, None)
    return s.keep(inside.select(*K, "leaves", "saved").unionByName(below.select(*K, "leaves", "saved")).groupBy(*K).agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")), f"total{level}")


def _pieces(piece: int):
    """Runs of one key in rows ordered by key and c: (key, first c, its ids joined), ``piece`` ids at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, out = None, [], []
        for b in batches:
            for *k, c in zip(*[x.to_pylist() for x in b.columns], strict=True):
                if k != key or len(ids) == piece:
                    if ids:
                        out.append((*key, ids[0], ",".join(map(str, ids))))
                    key, ids = k, []
                ids.append(c)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), [*[pa.int64()] * 4, pa.string()], strict=True)], [*K, "c", "ids"])
                out = []
        if ids:
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((*key, ids[0], ",".join(map(str, ids))), [*[pa.int64()] * 4, pa.string()], strict=True)], [*K, "c", "ids"])

    return run


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hash of each key's pieces, joined by commas; only its state is held."""
    key, h, out = None, None, []
    types, names = [*[pa.int64()] * 3, pa.string()], [*K, "ends_sha256"]
    for b in batches:
        for *k, _, ids in zip(*[x.to_pylist() for x in b.columns], strict=True):
            if k == key:
                h.update(b",")
            else:
                if key:
                    out.append((*key, h.hexdigest()))
                key, h = k, hashlib.sha256()
            h.update(ids.encode())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), types, strict=True)], names)
            out = []
    if key:
        yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((*key, h.hexdigest()), types, strict=True)], names)


def _ends(s: Scratch, ends: DataFrame, piece: int) -> DataFrame:
    """key, ends_sha256 of the conversations (key, c) that end at each node."""
    pieces = ends.repartitionByRange(*K, "c").sortWithinPartitions(*K, "c").mapInArrow(_pieces(piece), ", ".join(f"{k} long" for k in K) + ", c long, ids string")
    pieces = s.keep(pieces, "pieces")
    return pieces.repartition(*K).sortWithinPartitions(*K, "c").mapInArrow(_hashes, ", ".join(f"{k} long" for k in K) + ", ends_sha256 string")


def prefix_trie(df: DataFrame, height: int = HEIGHT, piece: int = PIECE) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of every node."""
    s = Scratch(df.sparkSession)
    turns, convs = rebuilt(s, df)
    paths = _keyed(s, turns, height)
    last = F.col("depth") == F.col("length")
    stops = paths.join(convs, "c").select("c", "depth", "words", *K, "p0", "p1", "p2", last.alias("last"))
    stops = s.keep(stops, "stops")
    # a node is childless if all of its members end there
    nodes = stops.groupBy(*K, "depth").agg(F.min("c").alias("c"), F.count("*").alias("n_convs"), F.bool_and("last").alias("leaf"), F.first("words").alias("words"), *[F.first(p).alias(p) for p in ("p0", "p1", "p2")])
    nodes = s.keep(nodes.select(*K, "depth", "c", "n_convs", F.col("leaf").cast("long").alias("leaves"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved"), "p0", "p1", "p2"), "nodes")
    totals = rollup(s, paths, nodes, height)
    children = nodes.where("depth > 1").groupBy("p0", "p1", "p2").agg(F.count("*").alias("n_children")).toDF(*K, "n_children")
    # nodes of one smallest member follow one another down to its end: only the first has another conversation's parent
    first = nodes.groupBy("c").agg(F.min("depth").alias("depth")).where("depth > 1")
    first = nodes.select(*K, "depth", "c", "p0", "p1", "p2").join(first, ["c", "depth"], "left_semi")
    parents = first.join(nodes.select(*[F.col(k).alias(p) for k, p in zip(K, ("p0", "p1", "p2"), strict=True)], F.col("c").alias("parent")), ["p0", "p1", "p2"]).select(*K, "parent")
    ends = _ends(s, stops.where("last").select(*K, "c"), piece)
    all_of = nodes.select(*K, "depth", "c", "n_convs")
    for more in (children, totals.select(*K, "leaves", "saved"), parents, ends):
        all_of = all_of.unionByName(more, allowMissingColumns=True)
    out = all_of.groupBy(*K).agg(*[F.max(x).alias(x) for x in ("depth", "c", "n_convs", "n_children", "leaves", "saved", "parent", "ends_sha256")])
    root = _root(s, nodes, convs, piece)
    nothing = F.sha2(F.lit(""), 256)
    found = out.select(
        F.col("c").alias("conv_id"),
        "depth",
        F.when(F.col("depth") == 1, F.lit(root["conv_id"] if root else None)).otherwise(F.coalesce("parent", "c")).cast("long").alias("parent_conv_id"),
        "n_convs",
        F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", nothing).alias("ends_sha256"),
    )
    return found if root is None else found.unionByName(df.sparkSession.createDataFrame([root], found.schema))


def _root(s: Scratch, nodes: DataFrame, convs: DataFrame, piece: int) -> dict | None:
    """The textless root's row; None without conversations."""
    c = convs.agg(F.min("c"), F.count("*")).first()
    if not c[1]:
        return None
    n = nodes.agg(F.count(F.when(F.col("depth") == 1, 1)), F.sum("leaves"), F.sum("saved")).first()
    zero = [F.lit(0).cast("long").alias(k) for k in K]
    turnless = s.keep(convs.where("length = 0").select(*zero, "c"), "turnless")
    ends = _ends(Scratch(s.spark), turnless, piece).first()
    return {"conv_id": c[0], "depth": 0, "parent_conv_id": None, "n_convs": c[1], "n_children": n[0], "n_leaves": n[1] or 1, "saved_tokens": n[2] or 0, "ends_sha256": ends["ends_sha256"] if ends else hashlib.sha256(b"").hexdigest()}


SQL = rf"""
WITH o AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS s,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, s) AS pos FROM conversations WHERE conv_id IS NOT NULL),
v AS (SELECT c, {CRC_SQL.format(x="c::VARCHAR")} % 4 AS h FROM o GROUP BY c),
b AS (SELECT v.c, o.pos AS d, o.s, o.text FROM v JOIN o ON o.c = v.c - v.c % 20 AND o.pos <= v.h),
k AS (SELECT c, count(*) AS k FROM b GROUP BY c),
r AS (SELECT c, d, s, text FROM b UNION ALL SELECT o.c, o.pos - v.h + coalesce(k.k, 0), o.s, o.text FROM o JOIN v USING (c) LEFT JOIN k USING (c) WHERE o.pos > v.h),
p AS (SELECT c, 0 AS d, '' AS key, 0 AS w FROM v UNION ALL SELECT c, d, string_agg(s, '') OVER (PARTITION BY c ORDER BY d), len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) FROM r),
q AS (SELECT *, lag(key) OVER (PARTITION BY c ORDER BY d) AS up, d = max(d) OVER (PARTITION BY c) AS ends FROM p),
n AS (SELECT key, any_value(d) AS depth, any_value(up) AS up, min(c) AS conv_id, count(*) AS n_convs, bool_and(ends) AS leaf, (count(*) - 1) * any_value(w) AS saved,
  sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE ends), '')) AS ends_sha256 FROM q GROUP BY key),
t AS (SELECT q.key, count(*) FILTER (WHERE n.leaf) AS n_leaves, sum(n.saved) AS saved_tokens FROM n JOIN q ON q.c = n.conv_id AND q.d <= n.depth GROUP BY q.key),
m AS (SELECT up AS key, count(*) AS n_children FROM n GROUP BY up)
SELECT n.conv_id, n.depth::BIGINT AS depth, u.conv_id AS parent_conv_id, n.n_convs, coalesce(m.n_children, 0) AS n_children, t.n_leaves, t.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM n JOIN t USING (key) LEFT JOIN m USING (key) LEFT JOIN n AS u ON u.key = n.up
"""
