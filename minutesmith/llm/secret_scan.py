"""Operator 12: secret scans with multipart credential linking (DataFrame operations only).

Three base patterns give spans by themselves. Beside them a credential has parts that alone mean little: identifiers (user
names, client and key ids), weak secrets (bare runs of mixed letters and digits, short passwords) and endpoints (addresses
and hosts). Such weak candidates are reported only when complementary parts stand near, by an interval join: every part
opens an interval of ``REACH`` code points to both sides, cut at the ends of its scope (a stretch between blank lines), and
a candidate is linked if the intervals it needs contain it:

- a weak secret: an access identifier; or an identifier and an endpoint;
- an identifier: an assigned secret; or a weak secret or hex run and an endpoint;
- an endpoint: an identifier of either kind and a secret of any kind.

The join is a sweep: parts and scope ends of a document are ordered by place, and windows carry the nearest part of each
role from both sides, so no pairs are formed. Texts are read once, where they lie; only places of matches are shuffled.
Weak candidates and scope ends are looked for only in texts that hold an identifier and a secret.

Places come from the lengths of matches and of what lies between them (``split`` by the same pattern), summed in order.

Defined results: null text counts as empty; a text without spans has counts 0, the hash of the empty string and empty
spans; weak candidates that overlap a base span are dropped (their part of the credential is reported already); repeated
rows each give a row; an empty table gives no rows; texts are scanned whole at any length, and the places of one text are
gathered in one row of the result; columns beyond doc_id and text are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch

REACH = 300
VALUE = r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: The base patterns. Runs that are too short can't hide a longer one, so their lengths are part of the pattern.
ASSIGN = r"(?i)(password|passwd|secret|token|api_?key)" + VALUE
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
IDENTIFIER = r"(?i)(?<![a-z0-9])(user(?:_?name|_?id)?|login|account|client_?id|(?:access_?)?key_?id|access_?key)" + VALUE
WEAK = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}"
PHRASE = r"(?i)(?<![a-z0-9])(pwd|pass|pin|auth|credentials?|private_?key)" + VALUE
ENDPOINT = r"(?i)(?<![a-z0-9])(?:[a-z][a-z0-9+.-]{1,15}://[^\s\"'<>]{3,}|(?:host(?:_?name)?|server|endpoint|bucket)" + VALUE.replace("(", "(?:") + ")"
CUT = r"\n[ \t\r]*\n|\f"
#: In the order that breaks ties of places.
KINDS = ("assign", "access", "hex", "weak", "identifier", "endpoint")
BASE = KINDS[:3]
PLACES = "array<struct<gap:int,len:int,held:boolean>>"


def _places(t: Column, pattern: str, keep=None) -> Column:
    """Of each match in order: code points between it and the one before, its own, and whether it holds."""
    m = F.regexp_extract_all(t, F.lit(pattern), F.lit(0))
    gaps = F.split(t, pattern, -1)
    if keep is None:
        held = F.transform(m, lambda x: F.lit(True))
    else:
        held = keep(m)
    return F.transform(F.arrays_zip(m.alias("m"), F.slice(gaps, 1, F.size(m)).alias("gap"), held.alias("held")), lambda x: F.struct(F.length(x["gap"]).alias("gap"), F.length(x["m"]).alias("len"), x["held"].alias("held")))


def _assigned(t: Column, pattern: str, least: int):
    """Matches whose value (group 2) has ``least`` code points."""
    return lambda m: F.transform(F.regexp_extract_all(t, F.lit(pattern), F.lit(2)), lambda v: F.length(v) >= least)


def _mixed(m: Column) -> Column:
    return F.transform(m, lambda x: x.rlike("[a-z]") & x.rlike("[A-Z]") & x.rlike("[0-9]"))


def _found(df: DataFrame) -> DataFrame:
    """rid, doc_id and the places of every kind in each text; nothing else of the text."""
    t, none = F.col("t"), F.lit(None).cast(PLACES)
    rows = df.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("t"))
    rows = rows.select(
        "*",
        F.when(t.rlike(ASSIGN), _places(t, ASSIGN, _assigned(t, ASSIGN, 6))).otherwise(none).alias("assign"),
        F.when(t.contains("AKIA") & t.rlike(ACCESS), _places(t, ACCESS)).otherwise(none).alias("access"),
        F.when(t.rlike(HEX), _places(t, HEX)).otherwise(none).alias("hex"),
        F.when(t.rlike(IDENTIFIER), _places(t, IDENTIFIER, _assigned(t, IDENTIFIER, 3))).otherwise(none).alias("identifier"),
    )
    named = F.col("access").isNotNull() | F.col("identifier").isNotNull()
    rows = rows.select(
        "*",
        F.when(named & t.rlike(WEAK), _places(t, WEAK, _mixed)).otherwise(none).alias("weak"),
        F.when(named & t.rlike(PHRASE), _places(t, PHRASE, _assigned(t, PHRASE, 4))).otherwise(none).alias("phrase"),
    )
    both = named & F.coalesce("assign", "hex", "weak", "phrase").isNotNull()
    return rows.select(
        "rid",
        "doc_id",
        *BASE,
        F.when(both, F.col("identifier")).alias("identifier"),
        F.when(both, F.col("weak")).alias("weak"),
        F.when(both, F.col("phrase")).alias("phrase"),
        F.when(both & t.rlike(ENDPOINT), _places(t, ENDPOINT)).otherwise(none).alias("endpoint"),
        F.when(both & t.rlike(CUT), _places(t, CUT)).otherwise(none).alias("cut"),
    )


def _spans(found: DataFrame) -> DataFrame:
    """rid, kind, start, stop of every match that holds; ``cut`` rows end scopes."""
    kinds = (*BASE, "identifier", "weak", "phrase", "endpoint", "cut")

    def of(k: str) -> Column:
        return F.transform(F.coalesce(F.col(k), F.array().cast(PLACES)), lambda x, i: F.struct(F.lit(k).alias("kind"), i.alias("pos"), x["gap"].alias("gap"), x["len"].alias("len"), x["held"].alias("held")))

    one = F.concat(*map(of, kinds))
    rows = found.where(F.coalesce(*kinds).isNotNull()).select("rid", F.explode(one).alias("x")).select("rid", "x.*")
    w = Window.partitionBy("rid", "kind").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    stop = F.sum(F.col("gap").cast("long") + F.col("len")).over(w)
    return rows.repartition("rid").select("rid", "kind", "held", (stop - F.col("len")).alias("start"), stop.alias("stop")).where("held").drop("held")


def _linked(spans: DataFrame, reach: int) -> DataFrame:
    """rid, kind, start, stop of what is reported: base spans, and weak candidates beside their complements."""
    kind = F.when(F.col("kind") == "phrase", "weak").otherwise(F.col("kind"))
    rows = spans.select("rid", kind.alias("kind"), "start", "stop", F.col("kind").isin(*BASE).alias("base"))
    order = [F.col("start"), F.col("stop"), F.col("kind")]
    before = Window.partitionBy("rid").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy("rid").orderBy(*order).rowsBetween(1, Window.unboundedFollowing)
    behind = F.max(F.when(F.col("base"), F.col("stop"))).over(before)
    ahead = F.first(F.when(F.col("base"), F.col("start")), ignorenulls=True).over(after)
    rows = rows.withColumn("hit", ~F.col("base") & (F.col("kind") != "cut") & ((F.coalesce(behind, F.lit(0)) > F.col("start")) | F.coalesce(ahead < F.col("stop"), F.lit(False))))
    rows = rows.where(~F.col("hit")).withColumn("scope", F.count(F.when(F.col("kind") == "cut", 1)).over(before)).where("kind != 'cut'")
    scope = Window.partitionBy("rid", "scope").orderBy(*order)
    prev, next_ = scope.rowsBetween(Window.unboundedPreceding, -1), scope.rowsBetween(1, Window.unboundedFollowing)

    def near(*kinds: str) -> Column:
        """Whether a part of one of these kinds is within reach on either side."""
        part = F.col("kind").isin(*kinds)
        left = F.col("start") - F.max(F.when(part, F.col("stop"))).over(prev) <= reach
        right = F.first(F.when(part, F.col("start")), ignorenulls=True).over(next_) - F.col("stop") <= reach
        return F.coalesce(left, F.lit(False)) | F.coalesce(right, F.lit(False))

    rows = rows.withColumns({"access_": near("access"), "assign_": near("assign"), "run_": near("weak", "hex"), "identifier_": near("identifier"), "endpoint_": near("endpoint")})
    linked = (
        F.when(F.col("base"), True)
        .when(F.col("kind") == "weak", F.col("access_") | F.col("identifier_") & F.col("endpoint_"))
        .when(F.col("kind") == "identifier", F.col("assign_") | F.col("run_") & F.col("endpoint_"))
        .otherwise((F.col("access_") | F.col("identifier_")) & (F.col("assign_") | F.col("run_")))
    )
    return rows.where(linked).select("rid", "kind", "start", "stop")


def secret_scan(df: DataFrame, reach: int = REACH) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans of every row."""
    s = Scratch(df.sparkSession)
    found = s.keep(_found(df), "found")
    rank = F.element_at(F.create_map(*[F.lit(x) for i, k in enumerate(KINDS) for x in (k, i)]), F.col("kind"))
    spans = _linked(_spans(found), reach).groupBy("rid").agg(
        *[F.count(F.when(F.col("kind") == k, 1)).alias(f"n_{k}") for k in BASE],
        F.sort_array(F.collect_list(F.struct("start", rank.alias("rank"), "kind", "stop"))).alias("x"),
    )
    write = lambda x: F.array_join(F.transform(x, lambda e: F.concat(e["kind"], F.lit(":"), e["start"].cast("string"), F.lit(":"), e["stop"].cast("string"))), ",")
    told = spans.select("rid", *[f"n_{k}" for k in BASE], F.sha2(write(F.filter("x", lambda e: e["rank"] < len(BASE))), 256).alias("base_sha256"), write(F.col("x")).alias("spans"))
    return (
        found.select("rid", "doc_id")
        .join(told, "rid", "left")
        .select("doc_id", *[F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in BASE], F.coalesce("base_sha256", F.sha2(F.lit(""), 256)).alias("base_sha256"), F.coalesce("spans", F.lit("")).alias("spans"))
    )
