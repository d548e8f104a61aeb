"""Operator 13: a Merkle manifest of a dataset, by checkpoint and recompute.

Every row is a leaf; the leaves of one language, in order of doc_id, are folded in pairs to a subroot, and the subroots, in
order of language, to the root. Only every ``BAND``-th level is written, as rows of aligned subtrees (``2 ** BAND``
neighbours at most). Going up, a task folds a subtree to its top and forgets what lies between; going down, it makes the
levels between again from the stored ones, hands each stored node the siblings on its way up, and forgets them once more.
So a leaf's proof comes from as many joins by subtree as there are bands, and no task ever holds more than a few subtrees.

Places of leaves are found by ranges of (language, doc_id), so a language that holds most rows is spread over many tasks.
The subroots are folded by the same steps, however many languages there are; only the root itself reaches the driver.

Defined results: a null field is written ``-``; a null language is one of its own and comes first, a null doc_id comes first
in its language and is never tampered with; rows that repeat a doc_id are ordered by their leaf, and equal rows are leaves
each; an only leaf is its language's subroot, an only subroot the root, and its proof is the hash of nothing; an empty table
gives no rows; texts of any length are hashed whole, by built-in functions; columns beyond the five are not read.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import CRC_SQL, Scratch, ranked

BAND = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def _written(c: Column) -> Column:
    """A field as it enters a hash: UTF-8 byte count, colon, value; ``-`` if null."""
    s = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def leaf_hash(fields: dict[str, Column]) -> Column:
    return F.sha2(F.concat(*[_written(fields[f]) for f in FIELDS]), 256)


def join_hash(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def levels(hashes: list[str], band: int | None) -> list[list[str]]:
    """A subtree's levels from its stored nodes up: ``band`` folds, or (None) until one node is left."""
    out = [hashes]
    while len(out) <= band if band is not None else len(out[-1]) > 1:
        below = out[-1]
        out.append([join_hash(*below[i : i + 2]) for i in range(0, len(below), 2)])
    return out


def siblings(rows: list[list[str]], i: int) -> list[str]:
    """The siblings on the way up from stored node ``i``: ``<`` (stands left) or ``>`` before the hash, empty if none."""
    out = []
    for row in rows[:-1]:
        j = i ^ 1
        out.append(("<" if j < i else ">") + row[j] if j < len(row) else "")
        i >>= 1
    return out


def fold(leaf: str, way: list[str]) -> str:
    """The root that a leaf and its siblings give."""
    for x in way:
        leaf = join_hash(leaf) if not x else join_hash(x[1:], leaf) if x[0] == "<" else join_hash(leaf, x[1:])
    return leaf


def _climb(band: int):
    def run(batches):
        for b in batches:
            n = b.column("n").to_pylist()
            tops = [levels(kids, None if k <= 1 << band else band)[-1][0] for k, kids in zip(n, b.column("kids").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("tree"), pa.array([-(-k >> band) for k in n], pa.int64()), b.column("block"), pa.array(tops, pa.string())], ["tree", "n", "idx", "hash"])

    return run


def _up(s: Scratch, rows: DataFrame, tag: str, band: int, payload: tuple = ()) -> tuple[list[DataFrame], DataFrame]:
    """The stored levels (tree, n, block, kids) and each tree's top (tree, hash, last: its last stored level).

    ``rows``: tree, n (its nodes), idx, hash and ``payload`` (kept in the lowest level only).
    """
    bands, tops = [], None
    while True:
        block = F.shiftright("idx", band).alias("block")
        bands.append(s.keep(rows.groupBy("tree", "n", block).agg(F.sort_array(F.collect_list(F.struct("idx", "hash", *payload))).alias("kids")), f"{tag}{len(bands)}"))
        up = s.keep(bands[-1].select("tree", "n", "block", F.col("kids.hash").alias("kids")).mapInArrow(_climb(band), "tree string, n long, idx long, hash string"), f"{tag}{len(bands)}_tops")
        done = up.where("n = 1").select("tree", "hash", F.lit(len(bands) - 1).alias("last"))
        tops = done if tops is None else tops.unionAll(done)
        rows, payload = up.where("n > 1"), ()
        if rows.isEmpty():
            return bands, tops


def _above(bands: list[DataFrame], heads: DataFrame, band: int) -> DataFrame:
    """The lowest stored level with ``way``, ``subroot`` and ``root``: the siblings above each of its subtrees.

    ``heads``: tree, last, way, subroot, root of each tree's top.
    """

    def down(batches):
        for b in batches:
            tree, idx, way, sub, root = [], [], [], [], []
            for r in b.to_pylist():
                rows = levels(r["kids"], None if r["n"] <= 1 << band else band)
                for i in range(len(r["kids"])):
                    tree.append(r["tree"])
                    idx.append((r["block"] << band) + i)
                    way.append(siblings(rows, i) + r["way"])
                    sub.append(r["subroot"])
                    root.append(r["root"])
            yield pa.RecordBatch.from_arrays([pa.array(tree, pa.string()), pa.array(idx, pa.int64()), pa.array(way, pa.list_(pa.string())), pa.array(sub, pa.string()), pa.array(root, pa.string())], ["tree", "block", "way", "subroot", "root"])

    nodes = None
    for m in range(len(bands) - 1, -1, -1):
        above = heads.where(F.col("last") == m).select("tree", F.lit(0).cast("long").alias("block"), "way", "subroot", "root")
        above = above if nodes is None else above.unionAll(nodes)
        joined = bands[m].join(above, ["tree", "block"])
        if m == 0:
            return joined
        nodes = joined.select("tree", "n", "block", F.col("kids.hash").alias("kids"), "way", "subroot", "root").mapInArrow(down, "tree string, block long, way array<string>, subroot string, root string")


SCHEMA = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def manifest(df: DataFrame, band: int = BAND, tamper: int = 7) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every row.

    The proof is folded again from the row's leaf; where ``tamper`` divides the crc32 of the doc_id, from a leaf whose
    n_chars is one more.
    """
    s = Scratch(df.sparkSession)
    fields = {f: F.col(f) for f in FIELDS} | {f: F.col(f).cast("long") for f in ("doc_id", "n_chars")}
    wrong = F.crc32(fields["doc_id"].cast("string").cast("binary")) % tamper == 0
    other = leaf_hash(fields | {"n_chars": fields["n_chars"].cast("decimal(20,0)") + 1})
    leaves = df.select(_written(fields["lang"]).alias("tree"), fields["lang"].cast("string").alias("lang"), fields["doc_id"].alias("doc_id"), leaf_hash(fields).alias("hash"), F.when(wrong, other).alias("other"))
    leaves = ranked(s, leaves, ["tree"], ["doc_id", "hash"], "leaves")
    bands, tops = _up(s, leaves, "band", band, ("doc_id", "other", "lang"))
    langs = tops.join(bands[0].where("block = 0").select("tree", F.col("kids")[0]["lang"].alias("lang")), "tree")
    subroots = ranked(s, langs.select(F.lit("").alias("all"), "lang", F.col("tree").alias("name"), "last", "hash"), ["all"], ["lang"], "subroots")
    subroots = subroots.select(F.col("all").alias("tree"), "n", "idx", "hash", "name", "last")
    roots, top = _up(s, subroots, "root", band, ("name", "last"))
    root = top.select("hash").first()
    end = df.sparkSession.createDataFrame([("", len(roots) - 1, [], "", root[0] if root else "")], "tree string, last int, way array<string>, subroot string, root string")

    def tell(batches):
        """The siblings of each subroot up to the root."""
        for b in batches:
            out = []
            for r in b.to_pylist():
                rows = levels([k["hash"] for k in r["kids"]], None if r["n"] <= 1 << band else band)
                out += [(k["name"], k["last"], siblings(rows, i) + r["way"], k["hash"], r["root"]) for i, k in enumerate(r["kids"])]
            cols = list(zip(*out, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int32(), pa.list_(pa.string()), pa.string(), pa.string()), strict=True)], ["tree", "last", "way", "subroot", "root"])

    heads = s.keep(_above(roots, end, band).select("n", "kids", "way", "root").mapInArrow(tell, "tree string, last int, way array<string>, subroot string, root string"), "heads")

    def prove(batches):
        for b in batches:
            out = []
            for r in b.to_pylist():
                rows = levels([k["hash"] for k in r["kids"]], None if r["n"] <= 1 << band else band)
                for i, k in enumerate(r["kids"]):
                    way = siblings(rows, i) + r["way"]
                    folded = fold(k["other"] or k["hash"], way)
                    out.append((k["doc_id"], k["hash"], r["subroot"], r["root"], join_hash(*[x[1:] for x in way]), folded, folded == r["root"]))
            cols = list(zip(*out, strict=True)) or [()] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), *[pa.string()] * 5, pa.bool_()), strict=True)], ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])

    found = _above(bands, heads, band)
    kids = F.transform("kids", lambda k: F.struct(k["hash"].alias("hash"), k["doc_id"].alias("doc_id"), k["other"].alias("other")))
    return found.select("n", kids.alias("kids"), "way", "subroot", "root").mapInArrow(prove, SCHEMA)


SQL = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, lang, {", ".join(f"coalesce(strlen({f}::VARCHAR) || ':' || {f}::VARCHAR, '-') AS w{i}" for i, f in enumerate(FIELDS))}, coalesce(strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1)::VARCHAR, '-') AS more FROM documents),
l AS (SELECT doc_id, lang, w2 AS tree, sha256(w0 || w1 || w2 || w3 || w4) AS leaf, sha256(w0 || w1 || w2 || more || w4) AS other FROM w),
p AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY tree) AS n FROM l),
t AS (SELECT tree, lang, 0 AS lvl, i, n, leaf AS h FROM p
  UNION ALL SELECT tree, min(lang), lvl + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM t WHERE n > 1 GROUP BY tree, lvl, i // 2, n),
s AS (SELECT tree, lvl AS height, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM t WHERE n = 1),
u AS (SELECT 0 AS lvl, i, n, subroot AS h FROM s UNION ALL SELECT lvl + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM u WHERE n > 1 GROUP BY lvl, i // 2, n),
a AS (
  SELECT p.doc_id, p.leaf, p.other, p.tree, x.lvl AS lvl, xor(p.i >> x.lvl, 1) AS j, p.i, s.i AS si, s.height, s.subroot, true AS low
  FROM p JOIN s USING (tree), range(64) AS x(lvl) WHERE x.lvl < s.height
  UNION ALL SELECT p.doc_id, p.leaf, p.other, p.tree, x.lvl, xor(s.i >> x.lvl, 1), p.i, s.i, s.height, s.subroot, false
  FROM p JOIN s USING (tree), range(64) AS x(lvl) WHERE x.lvl < (SELECT max(lvl) FROM u)),
b AS (SELECT a.*, CASE WHEN low THEN t.h ELSE u.h END AS sib, CASE WHEN low THEN (a.i >> a.lvl) & 1 ELSE (a.si >> a.lvl) & 1 END AS bit
  FROM a LEFT JOIN t ON low AND t.tree = a.tree AND t.lvl = a.lvl AND t.i = a.j LEFT JOIN u ON NOT low AND u.lvl = a.lvl AND u.i = a.j),
c AS (SELECT tree, i, coalesce(string_agg(sib, '' ORDER BY low DESC, lvl), '') AS proof,
  list(CASE WHEN sib IS NULL THEN '' WHEN bit = 1 THEN '<' || sib ELSE '>' || sib END ORDER BY low DESC, lvl) AS way FROM b GROUP BY tree, i),
d AS (SELECT p.doc_id, p.leaf, s.subroot, (SELECT h FROM u WHERE n = 1) AS root, sha256(coalesce(c.proof, '')) AS proof_sha256,
  list_reduce(list_prepend(CASE WHEN {CRC_SQL.format(x="p.doc_id::VARCHAR")} % 7 = 0 THEN p.other ELSE p.leaf END, coalesce(c.way, [])),
    lambda q, x: CASE WHEN x = '' THEN sha256(q) WHEN x[1] = '<' THEN sha256(x[2:] || q) ELSE sha256(q || x[2:]) END) AS folded_root
  FROM p JOIN s USING (tree) LEFT JOIN c ON c.tree = p.tree AND c.i = p.i)
SELECT *, folded_root = root AS verified FROM d
"""
