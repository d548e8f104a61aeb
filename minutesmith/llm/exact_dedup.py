"""Operator 3: exact deduplication by deterministic block naming (DataFrame operations only).

Every normalised text is cut into blocks of ``BLOCK`` bytes. Equal blocks get one integer name; then names of adjacent
pairs are named again, until each document has one name. Documents of equal byte length have equal texts exactly if
their last names are equal: no fingerprint decides, so there are no collisions.

How names are given: distinct blocks are grouped (each text byte is shuffled once), sorted within their partition and
numbered in that order with consecutive integers. A block finds its name by a 64-bit key of its content; where two different
blocks share a key, those blocks are named by content instead (``collided``), so the outcome is exact at any key width.
Joins back to the names read written tables on both sides, so that adaptive execution can split a name that a third of
all rows carry.

Defined results: null text counts as empty; empty texts equal one another; a null doc_id ranks below all others;
repeated rows with one doc_id each give a row and all rows of the winning id stay apart only by id: a row is kept if its
doc_id is the group's largest, and of rows that repeat that id one is kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, ascii_lower, fresh

BLOCK = 4096
BITS = 1 << 24


def _blocks(b: str, block: int) -> Column:
    """The array of a text's blocks; an empty text has one empty block."""
    n = F.greatest(F.lit(1), F.ceil(F.octet_length(b) / F.lit(block)).cast("int"))
    return F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.substring(F.col(b), i * block + 1, F.lit(block)))


def _key(c: Column, key_bits: int) -> Column:
    return F.xxhash64(c) if key_bits >= 64 else F.pmod(F.xxhash64(c), F.lit(1 << key_bits))


def identities(df: DataFrame, s: Scratch, block: int = BLOCK, key_bits: int = 64) -> DataFrame:
    """rid, doc_id, n_bytes, sha, name: one row a document; (n_bytes, name) is its text's identity."""
    text = df.select(
        F.monotonically_increasing_id().alias("rid"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.encode(ascii_lower(F.coalesce(F.col("text").cast("string"), F.lit(""))), "UTF-8").alias("b"),
    )
    keys = F.transform(_blocks("b", block), lambda x: _key(x, key_bits))
    docs = s.keep(text.select("rid", "doc_id", F.octet_length("b").cast("long").alias("n_bytes"), F.sha2("b", 256).alias("sha"), keys.alias("keys")), "docs")
    blocks = text.select(F.explode(_blocks("b", block)).alias("block"))
    names = s.keep(
        blocks.groupBy("block").agg(F.count("*").alias("n")).sortWithinPartitions("block").select(_key(F.col("block"), key_bits).alias("key"), F.monotonically_increasing_id().alias("name")),
        "names",
    )
    by_key = s.keep(names.groupBy("key").agg(F.min("name").alias("name"), F.count("*").alias("n")), "by_key")
    occ = docs.select("rid", F.size("keys").alias("n_blocks"), F.posexplode("keys").alias("pos", "key"))
    occ = occ.join(by_key.select("key", "name"), "key").select("rid", "n_blocks", F.col("pos").cast("long").alias("pos"), "name")
    if by_key.where("n > 1").limit(1).count():
        occ = _by_content(df, s, docs, by_key, occ, block, key_bits)
    level = s.keep(occ, "level0")
    most = docs.agg(F.max(F.size("keys"))).first()[0] or 1
    done = [level.where("n_blocks = 1").select("rid", "name")]
    j = 1
    while (1 << (j - 1)) < most:
        pairs = s.keep(
            level.where(F.col("n_blocks") > (1 << (j - 1)))
            .groupBy("rid", "n_blocks", F.floor(F.col("pos") / 2).alias("pos"))
            .agg(F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("l"), F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(-1)).alias("r")),
            f"pairs{j}",
        )
        names = s.keep(pairs.groupBy("l", "r").agg(F.count("*").alias("n")).sortWithinPartitions("l", "r").select("l", "r", F.monotonically_increasing_id().alias("name")), f"names{j}")
        level = s.keep(pairs.join(names, ["l", "r"]).select("rid", "n_blocks", "pos", "name"), f"level{j}")
        s.drop(f"pairs{j}", f"names{j}")
        done.append(level.where(F.col("n_blocks") <= (1 << j)).select("rid", "name"))
        j += 1
    ends = done[0]
    for d in done[1:]:
        ends = ends.unionAll(d)
    return docs.select("rid", "doc_id", "n_bytes", "sha").join(ends, "rid")


def _by_content(df, s, docs, by_key, occ, block, key_bits):
    """Names for blocks whose key two different blocks share: those blocks meet by their whole content."""
    text = df.select(F.encode(ascii_lower(F.coalesce(F.col("text").cast("string"), F.lit(""))), "UTF-8").alias("b"), F.col("doc_id").cast("long").alias("doc_id"))
    shared = by_key.where("n > 1").select("key")
    found = text.select("doc_id", F.sha2("b", 256).alias("sha"), F.posexplode(_blocks("b", block)).alias("pos", "block"))
    found = s.keep(found.withColumn("key", _key(F.col("block"), key_bits)).join(shared, "key", "left_semi").dropDuplicates(["doc_id", "sha", "pos"]), "shared")
    exact = s.keep(found.groupBy("block").agg(F.count("*").alias("n")).select("block", (-2 - F.monotonically_increasing_id()).alias("exact")), "exact")
    named = found.join(exact, "block").select(F.coalesce("doc_id", F.lit(-(1 << 62))).alias("d"), "sha", "pos", "exact")
    named = docs.select("rid", F.coalesce("doc_id", F.lit(-(1 << 62))).alias("d"), "sha").join(named, ["d", "sha"]).select("rid", "pos", "exact")
    return occ.join(named, ["rid", "pos"], "left").select("rid", "n_blocks", "pos", F.coalesce("exact", "name").alias("name"))


def exact_dedup(df: DataFrame, block: int = BLOCK, key_bits: int = 64) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row."""
    s = Scratch(df.sparkSession)
    ids = s.keep(identities(df, s, block, key_bits), "identities")
    low = F.coalesce("doc_id", F.lit(-(1 << 63)))
    best = F.max(F.struct(low.alias("d"), F.col("rid")))
    groups = s.keep(ids.groupBy("n_bytes", "name").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"), best.getField("rid").alias("keep_rid")), "groups")
    for name in [n for n in s.paths if n not in ("identities", "groups")]:
        s.drop(name)
    return ids.join(groups, ["n_bytes", "name"]).select("doc_id", "keep_id", F.col("group_size").cast("long").alias("group_size"), (F.col("rid") == F.col("keep_rid")).alias("kept"), F.col("sha").alias("text_sha256"))


def keep_first_of_copies(df: DataFrame, block: int = BLOCK) -> DataFrame:
    """The rows of ``df`` that stay: of equal texts the one with the largest doc_id; of rows that repeat that id, one."""
    key, low = fresh(df, "_sha"), F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    found = exact_dedup(df, block)
    s = Scratch(df.sparkSession)
    gone = s.keep(found.where(~F.col("kept")).select(F.coalesce("doc_id", F.lit(-(1 << 63))).alias("d"), "text_sha256", (~F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("other")), "gone")
    rows = df.withColumn(key, F.sha2(F.encode(ascii_lower(F.coalesce(F.col("text").cast("string"), F.lit(""))), "UTF-8"), 256))
    lost = gone.where("other").select("d", "text_sha256").dropDuplicates()
    # a bitmap of fixed size (``BITS`` in words of 64, so at most BITS / 64 rows) goes to all tasks: only rows that may be
    # lost are shuffled with their texts
    bit, word = fresh(df, "_bit"), fresh(df, "_word")
    place = F.pmod(F.xxhash64("d", "text_sha256"), F.lit(BITS))
    marks = lost.select(place.alias("b")).groupBy(F.shiftright("b", 6).alias(word)).agg(F.bit_or(F.expr("shiftleft(1L, cast(b % 64 as int))")).alias(bit))
    at = F.pmod(F.xxhash64(low, F.col(key)), F.lit(BITS))
    rows = rows.withColumn(word, F.shiftright(at, 6)).join(F.broadcast(s.keep(marks, "marks")), word, "left")
    rows = rows.withColumn(bit, F.getbit(F.coalesce(bit, F.lit(0).cast("long")), (at % 64).cast("int")))
    unsure = rows.where(F.col(bit) == 1).join(lost, (low == lost["d"]) & (F.col(key) == lost["text_sha256"]), "left_anti")
    rows = rows.where(F.col(bit) == 0).unionByName(unsure)
    if gone.where("not other").limit(1).count():  # the winning id itself repeats
        rows = rows.dropDuplicates(["doc_id", key])
    return rows.select(*df.columns)


SQL = """
WITH t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS x FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, sha256(x) AS text_sha256
FROM t WINDOW w AS (PARTITION BY x)
"""
