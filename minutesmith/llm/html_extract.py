"""Operator 2: main text of HTML pages by maximum-scoring subsequence.

A page is a sequence of words and tags. Tags score negative; a word scores positive unless the elements around it speak
against content. A linear scan finds the contiguous region with the largest sum; blocks of the region whose own score is
negative (an advert inside the article) are left out.

Weights are log odds of element names and class or id words, from their rates inside and outside of content over all
pages whose own markup labels it (``article``, ``main``), on top of fixed counts. A name whose pages don't agree on a
side keeps its fixed weight, and so do names that mark boilerplate everywhere: adverts stand in articles too.

Defined results: null html counts as empty; a page without content has an empty text; unclosed and stray tags are
tolerated; repeated rows each give a row; a null url stays null.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from functools import lru_cache
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch

#: Elements that break text into blocks, that have no end tag, and whose text is never content.
BLOCKS = set("address article aside blockquote body center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main nav ol option p pre section summary table tbody td tfoot th thead tr ul".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
SILENT = set("script style head title noscript template iframe object svg math button select textarea datalist canvas audio video".split())
#: Names (of elements, or words of class, id and role) that mark boilerplate, and content.
BOILERPLATE = set(
    "nav navbar navigation menu menubar header masthead banner footer foot colophon aside sidebar side widget ad ads adv advert advertisement advertorial adbox sponsor sponsored promo promotion cookie cookies consent gdpr notice notices alert popup modal overlay dialog form search newsletter subscribe subscription signup login signin register share sharing social related recommended recommendations trending popular comment comments commentary reply replies respond disqus discussion breadcrumb breadcrumbs pagination pager toolbar copyright legal disclaimer skip hidden toc tags contentinfo complementary feedback rating".split()
)
CONTENT = set("article main content post entry story articlebody maincontent body-text prose".split())
PRIOR = 40
SLOTS = 1 << 22
CHUNK = 1 << 16
HELD = 100_000
CLOSES = {"p": BLOCKS, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"}}
NAME = re.compile(r"[a-z]+(?=[A-Z_\-\s\d]|$)|[A-Z]+(?![a-z])|[A-Z][a-z]+")


@lru_cache(maxsize=4096)
def names(value: str) -> frozenset[str]:
    return frozenset("." + w.lower() for w in NAME.findall(value))


def features(tag: str, attrs) -> list[str]:
    out = [tag]
    for key, value in attrs:
        if key in ("class", "id", "role") and value:
            out += names(value)
        if key == "hidden" or (key == "aria-hidden" and value == "true") or (key == "style" and value and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value)):
            out.append(".hidden")
    return out


class Around:
    """An element with features: the one above it, its features in order, those that no element above has, and the words inside
    and outside labelled content below it. Blocks share these, so a page's cost grows with its elements, however nested."""

    __slots__ = ("up", "added", "first", "words", "state")

    def __init__(self, up: Around | None, added: tuple[str, ...], first: tuple[str, ...]):
        self.up, self.added, self.first, self.words, self.state = up, added, first, [0, 0], None


class Blocks(HTMLParser):
    """Blocks of a page: [text parts, the nearest element with features, tags before the block, inside labelled content]."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack, self.blocks, self.tags, self.silent, self.link = [], [], 0, 0, 0
        self.open, self.around = Counter(), [None]  # open elements by name; the element with features around each
        self.elements, self.within = [], set()  # all elements with features, upper ones first; the features of open ones
        self.fresh()

    def fresh(self):
        self.now = None

    def handle_starttag(self, tag, attrs):
        self.tags += 1
        if tag in BLOCKS:
            for open_tag in ("p", "li", "dt", "dd", "td", "th", "tr", "option"):
                if self.open[open_tag] and tag in CLOSES[open_tag]:
                    self.close_to(open_tag, {"ul", "ol", "dl", "table", "article", "main", "section", "div"})
            self.fresh()
        elif tag == "br":
            self.handle_data(" ")
        if tag in VOID:
            return
        added = tuple(f for f in features(tag, attrs) if f not in NEUTRAL)
        self.stack.append(tag)
        self.open[tag] += 1
        if added:
            first = tuple(f for f in dict.fromkeys(added) if f not in self.within)
            self.within.update(first)
            self.elements.append(Around(self.around[-1], added, first))
            self.around.append(self.elements[-1])
        else:
            self.around.append(self.around[-1])
        self.silent += tag in SILENT
        self.link += tag == "a"

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def close_to(self, tag, stops):
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i] == tag:
                for t in self.stack[i:]:
                    self.silent -= t in SILENT
                    self.link -= t == "a"
                    self.open[t] -= 1
                for up, now in zip(self.around[i:], self.around[i + 1 :], strict=False):
                    if now is not up:
                        self.within.difference_update(now.first)
                del self.stack[i:], self.around[i + 1 :]
                return
            if self.stack[i] in stops:
                return

    def handle_endtag(self, tag):
        self.tags += 1
        if tag in BLOCKS:
            self.fresh()
        if not self.open[tag]:
            return
        self.close_to(tag, {"article", "main", "body"} - {tag} if tag not in ("html", "body") else set())

    def handle_data(self, data):
        if self.silent:
            return
        if self.now is None:
            if not data.strip():
                return
            self.now = [[], self.around[-1], self.tags, bool(self.open["article"] or self.open["main"]), 0]
            self.blocks.append(self.now)
            self.tags = 0
        self.now[0].append(data)
        if self.link:
            self.now[4] += len(data.split())


def blocks_of(html: str) -> tuple[list[tuple[str, Around | None, int, bool, int]], list[Around]]:
    """(text, nearest element with features, tags before, labelled as content, words in links) of each block; all elements."""
    p = Blocks()
    p.feed(html)
    p.close()
    out = [(" ".join("".join(parts).split()), around, tags, inside, link) for parts, around, tags, inside, link in p.blocks]
    return [b for b in out if b[0]], p.elements


def fixed_weight(feature: str) -> tuple[float, float]:
    """Fixed counts: (words in content, words outside)."""
    name = feature.lstrip(".")
    if name in CONTENT:
        return PRIOR, 1
    if name in BOILERPLATE:
        return 1, PRIOR * PRIOR
    return 1, 1


NEUTRAL = {"html", "body", "p", "b", "i", "em", "strong", "span", "div", "h1", "h2", "h3", "h4", "h5", "h6", "br", "section", "table", "tbody", "tr", "td", "th", "thead", "blockquote", "pre", "code", "u", "small", "sup", "sub", "figure", "figcaption", "a", "ul", "ol", "li", "dl", "dt", "dd", "font", "center", "mark", "abbr", "time", "q", "cite"}


class Verdicts:
    """Learned weights in a table of fixed size: 30 bits of a name's hash and its verdict in each slot.

    Names that share a slot leave it to the one with most words; the others keep their fixed weights.
    """

    def __init__(self, slots):
        self.slots, self.cache = slots, {}

    def get(self, feature: str) -> float | None:
        import xxhash

        if feature not in self.cache:
            if len(self.cache) >= HELD:
                self.cache = {}
            h = xxhash.xxh64_intdigest(feature.encode("utf-8", "surrogatepass"), seed=42)
            v = int(self.slots[h & (SLOTS - 1)])
            self.cache[feature] = {1: -4.0, 2: 0.0, 3: 4.0}.get(v & 3) if v >> 2 == h >> 34 else None
        return self.cache[feature]


def evidence(pages: DataFrame) -> DataFrame:
    """feature, yes, no (words inside and outside labelled content), plus, minus (pages where the rate is higher inside,
    outside); the feature '' has all words."""
    schema = pa.schema([("feature", pa.string()), ("yes", pa.int64()), ("no", pa.int64()), ("plus", pa.int64()), ("minus", pa.int64())])

    def flush(c):
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip([list(c), *zip(*c.values(), strict=True)], schema.types, strict=True)], schema=schema)

    def count(batches):
        c: dict[str, list[int]] = {}
        for b in batches:
            for html in b.column(0).to_pylist():
                found, elements = blocks_of(html or "")
                if not any(x[3] for x in found):
                    continue
                page: dict[str, list[int]] = {"": [0, 0]}
                for text, around, _, inside, _ in found:
                    n = text.count(" ") + 1
                    page[""][not inside] += n
                    if around:
                        around.words[not inside] += n
                for e in reversed(elements):  # lower ones before those above them
                    yes, no = e.words
                    if yes or no:
                        if e.up:
                            e.up.words[0] += yes
                            e.up.words[1] += no
                        for f in e.first:
                            t = page.setdefault(f, [0, 0])
                            t[0] += yes
                            t[1] += no
                yes, no = page[""]
                for f, (y, n) in page.items():
                    t = c.setdefault(f, [0, 0, 0, 0])
                    t[0] += y
                    t[1] += n
                    t[2] += y * no > n * yes
                    t[3] += y * no < n * yes
            if len(c) > HELD:
                yield flush(c)
                c = {}
        if c:
            yield flush(c)

    rows = pages.select(F.col("html").cast("string").alias("html")).mapInArrow(count, "feature string, yes long, no long, plus long, minus long")
    return rows.groupBy("feature").agg(*(F.sum(x).alias(x) for x in ("yes", "no", "plus", "minus")))


def learn_weights(pages: DataFrame) -> Verdicts:
    """Verdicts on all names: log odds of -1 or less, of 1 or more, or between, where the pages agree on a side.

    The larger side is scaled down to the smaller one, so counts are rates and no evidence is overstated. Pages agree on a
    side if a fair coin would be two standard deviations off.
    """
    import numpy as np

    s = Scratch(pages.sparkSession)
    seen = s.keep(evidence(pages), "evidence")
    whole = seen.where("feature = ''").collect()
    held = np.zeros(SLOTS, np.uint32)
    if whole and whole[0]["yes"] and whole[0]["no"]:
        yes, no = whole[0]["yes"], whole[0]["no"]
        least = min(yes, no)
        a = F.when(F.ltrim(F.lit("."), F.col("feature")).isin(*CONTENT), float(PRIOR)).otherwise(1.0)
        w = F.log((F.col("yes") * (least / yes) + a) / (F.col("no") * (least / no) + 1))
        side = F.col("plus") - F.col("minus")
        sure = (side * side > 4 * (F.col("plus") + F.col("minus"))) & (side * w > 0)
        code = F.when(w <= -1, 1).when(w >= 1, 3).otherwise(2)
        h = F.xxhash64("feature")
        named = seen.where((F.col("feature") != "") & ~F.ltrim(F.lit("."), F.col("feature")).isin(*BOILERPLATE) & sure)
        marks = named.select(h.bitwiseAND(F.lit(SLOTS - 1)).alias("slot"), (F.shiftrightunsigned(h, 34) * 4 + code).alias("mark"), F.struct(F.col("yes") + F.col("no"), "feature").alias("most"))

        def pack(t: pa.Table) -> pa.Table:
            x = np.zeros(CHUNK, np.uint32)
            x[t.column("slot").to_numpy() % CHUNK] = t.column("mark").to_numpy()
            return pa.table({"chunk": t.column("chunk")[:1], "marks": pa.array([x.tobytes()], pa.binary())})

        best = marks.groupBy("slot").agg(F.max_by("mark", "most").alias("mark"))
        for r in best.withColumn("chunk", F.floor(F.col("slot") / CHUNK)).groupBy("chunk").applyInArrow(pack, "chunk long, marks binary").collect():
            held[r["chunk"] * CHUNK : (r["chunk"] + 1) * CHUNK] = np.frombuffer(r["marks"], np.uint32)
    s.drop("evidence")
    return Verdicts(held)


def feature_weight(f: str, weights: dict[str, float] | Verdicts) -> float:
    if f in NEUTRAL:
        return 0.0
    w = weights.get(f)
    if w is None:
        yes, no = fixed_weight(f)
        w = math.log(yes / no)
    return w


def standing(around: Around | None, weights: dict[str, float] | Verdicts) -> tuple[float, float]:
    """(inner, outer) of a place: the weight of boilerplate and of content around it; each element is looked at once."""
    new = []
    while around is not None and around.state is None:
        new.append(around)
        around = around.up
    inner, outer = around.state if around else (0.0, 0.0)
    for e in reversed(new):  # from the outside in: what is nearest decides, content can't undo boilerplate inside it
        for f in e.added:
            w = feature_weight(f, weights)
            if w <= -1:
                inner = min(inner, w)
            elif w >= 1:
                outer = max(outer, w)
                if f in ("article", "main", ".article", ".main"):
                    inner = 0.0
        e.state = inner, outer
    return inner, outer


def extract(html: str | None, weights: dict[str, float] | Verdicts | None = None) -> str:
    """The region with the largest sum of word and tag scores, without its negative blocks."""
    weights = {} if weights is None else weights
    found, _ = blocks_of(html or "")
    score = []
    for text, around, tags, _, link in found:
        n = text.count(" ") + 1
        inner, outer = standing(around, weights)
        word = -1.0 if inner <= -1 else 1.0 if outer else 0.6
        if word > 0 and link > n / 2 and not outer:
            word = -0.5
        score.append((word * n - (0.0 if outer and inner > -1 else 0.3) * tags, word > 0))
    best, best_span, run, start = 0.0, None, 0.0, 0
    for i, (s, _) in enumerate(score):
        if run <= 0:
            run, start = 0.0, i
        run += s
        if run > best:
            best, best_span = run, (start, i + 1)
    if best_span is None:
        return ""
    return "\n".join(found[i][0] for i in range(*best_span) if score[i][1])


def html_text(pages: DataFrame, weights: dict[str, float] | Verdicts | None = None) -> DataFrame:
    """page_id, url, text, n_chars of every page; weights are learned from ``pages`` unless given."""
    sent = pages.sparkSession.sparkContext.broadcast(learn_weights(pages) if weights is None else weights)
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def run(batches):
        for b in batches:
            text = [extract(h, sent.value) for h in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64())], schema=schema)

    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")).mapInArrow(run, "page_id long, url string, text string, n_chars long")
