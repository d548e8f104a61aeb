"""Raw pages: scan by path, charset-resolving decode, and one pass from HTML to a table of cells.

Everything after the cells is DataFrame work (``operators.html_tables``).
"""

from __future__ import annotations

import re
from html import unescape
from html.parser import HTMLParser
from itertools import accumulate

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import publish

CELL = "table_no int, caption string, table_id string, table_class string, heading_before string, anchor_before string, row_no int, col_no int, tag string, text string, hrefs array<string>, lines array<string>"
ABOUT = ["table_id", "table_class", "heading_before", "anchor_before"]
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
# The charsets tried before and after the declared one.
FIRST_CHARSETS, LAST_CHARSETS = ("cp932",), ("utf-8", "shift_jis", "euc_jp")
# Pages looked at, and rows or pages handed over at once: a task holds no more of either.
PAGES, ROWS = 256, 4096
# Between two angle brackets: a plain tag with quoted values and without references. Elements whose content is no markup are none.
PLAIN = re.compile(r"""(/?)([A-Za-z][A-Za-z0-9]*)((?:[ \t\n]+[A-Za-z][A-Za-z0-9_-]*(?:="[^"&]*"|='[^'&]*')?)*)[ \t\n]*(/?)""")
VALUE = re.compile(r"""([A-Za-z][A-Za-z0-9_-]*)(?:="([^"]*)"|='([^']*)')?""")
RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes", "noscript", "plaintext"}
BRACKETS = re.compile("<([^<>]*)>")


def page_scan(spark: SparkSession, root: str) -> DataFrame:
    """dataset, house, session, kind, content of every file below ``root``; the key is read from the path."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    part = F.split(F.col("path"), "/")
    at = lambda i: F.try_element_at(part, F.lit(i))
    return files.select(at(-4).alias("dataset"), at(-3).alias("house"), at(-2).try_cast("int").alias("session"), F.regexp_replace(at(-1), "[.][^.]*$", "").alias("kind"), "content")


def scan_pages(spark: SparkSession, root: str) -> DataFrame:
    """path, content and the keys (dataset, house, session, entity ...) of files in folders named `key=value`."""
    s = spark.newSession()  # its own settings; the caller's stay
    s.conf.set("spark.sql.sources.parallelPartitionDiscovery.parallelism", "32")  # else a task for each folder
    s.conf.set("spark.sql.files.openCostInBytes", "16k")  # else a task for each few small files
    return s.read.format("binaryFile").load(root).drop("modificationTime", "length")


def store_pages(pages: DataFrame, path: str, append: bool = False) -> None:
    """Scanned pages as a table by dataset, house and session: a few large files instead of one for each page.

    Sessions that come again are replaced, or with ``append`` added to.
    """
    x, keys = pages.select("dataset", "house", "session", F.col("entity").cast("string").alias("entity"), "path", "content"), ["dataset", "house", "session"]
    if append:
        x.write.mode("append").partitionBy(*keys).parquet(path)
    else:
        publish(x, path, keys)


def store_roots(spark: SparkSession, roots: list[str], path: str) -> None:
    """The pages below all roots as a new table, one root after the other: the driver knows the files of one root at a time."""
    for root in roots:
        store_pages(scan_pages(spark, root), path, append=True)


def decode_page(content: bytes | None, declared: str | None) -> str:
    """The first charset that decodes without an error; else UTF-8 with replacement characters."""
    content = content or b""
    meta = re.search(rb"charset\s*=\s*[\"']?([A-Za-z0-9_-]+)", content[:4096])
    for name in (*FIRST_CHARSETS, declared, meta and meta[1].decode("ascii"), *LAST_CHARSETS):
        try:
            if name:
                return content.decode(name)
        except (UnicodeDecodeError, LookupError):
            continue
    return content.decode("utf-8", "replace")


def decode_pages(df: DataFrame, content: str = "content", declared: str | None = None) -> DataFrame:
    """``df`` with an ``html`` column in place of ``content``."""
    keep = [c for c in df.columns if c != content]

    def run(batches):
        for b in batches:
            body = b.column(len(keep)).to_pylist()
            said = b.column(len(keep) + 1).to_pylist()
            html = [decode_page(c, d) for c, d in zip(body, said, strict=True)]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(keep))), pa.array(html, pa.string())], names=[*keep, "html"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema)
    said = F.col(declared) if declared else F.lit(None).cast("string")
    return df.select(*keep, content, said.alias("_declared")).mapInArrow(run, f"{schema}, html string")


class _Tags(dict):
    """(kind, name, attributes) of what stands between two brackets, null if it is no plain tag; kind 0 opens, 1 closes, 2 both."""

    def __missing__(self, text):
        m, out = PLAIN.fullmatch(text), None
        if m and m[2].lower() not in RAW and not (m[1] and (m[3] or m[4])):
            out = (1 if m[1] else 2 if m[4] else 0, m[2].lower(), [(a[1].lower(), a[2] if a[2] is not None else a[3]) for a in VALUE.finditer(m[3])])
        if len(self) >= 1 << 14:
            self.clear()
        self[text] = out
        return out


_TAGS = _Tags()


def parse(p: HTMLParser, text: str | None) -> HTMLParser:
    """``p`` with all of the page's events. A page of plain tags and text alone is cut at its brackets, and each tag is looked
    up; any other page is fed to the parser."""
    text = text or ""
    parts = BRACKETS.split(text)
    tags = [*map(_TAGS.__getitem__, parts[1::2])]
    if None in tags or text.count("<") != len(tags):
        p.feed(text)
        p.close()
        return p
    data, opens, closes = p.handle_data, p.handle_starttag, p.handle_endtag
    for said, (kind, tag, attrs) in zip(parts[::2], tags):
        if said:
            data(unescape(said) if "&" in said else said)
        if kind == 0:
            opens(tag, attrs)
        elif kind == 1:
            closes(tag)
        else:
            p.handle_startendtag(tag, attrs)
    if parts[-1]:
        data(unescape(parts[-1]))
    return p


def _slices(b: pa.RecordBatch):
    """(number of the first page, texts) of a batch's last column, some pages at a time."""
    for at in range(0, b.num_rows, PAGES):
        yield at, b.column(b.num_columns - 1).slice(at, PAGES).to_pylist()


class _Cells(HTMLParser):
    """Collects the rows of every table; a cell is [tag, rowspan, colspan, text pieces, links]."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.tables, self.open, self.cell, self.caption = [], [], None, False
        self.heading, self.anchor, self.in_heading = "", "", False

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        if tag == "table":
            about = {"table_id": a.get("id") or "", "table_class": a.get("class") or "", "heading_before": " ".join(self.heading.split()), "anchor_before": self.anchor}
            self.tables.append({"caption": "", "rows": []} | about)
            self.open.append(self.tables[-1])
        elif not self.open and tag in HEADINGS:
            self.heading, self.in_heading = "", True
        elif not self.open and tag == "a" and (a.get("name") or a.get("id")):
            self.anchor = a.get("name") or a.get("id")
        elif not self.open:
            return
        elif tag == "caption":
            self.caption = True
        elif tag == "tr":
            self.open[-1]["rows"].append([])
            self.cell = None
        elif tag in ("td", "th") and self.open[-1]["rows"]:
            span = [int(a[k]) if (a.get(k) or "").isdigit() and int(a[k]) else 1 for k in ("rowspan", "colspan")]
            self.cell = [tag, *span, [], []]
            self.open[-1]["rows"][-1].append(self.cell)
        elif tag == "a" and self.cell and a.get("href"):
            self.cell[4].append(a["href"])

    def handle_endtag(self, tag):
        if tag == "table" and self.open:
            self.open.pop()
            self.cell = None
        elif tag in HEADINGS:
            self.in_heading = False
        elif tag == "caption":
            self.caption = False
        elif tag in ("td", "th", "tr"):
            self.cell = None

    def handle_data(self, data):
        if self.caption and self.open:
            self.open[-1]["caption"] += data
        elif self.in_heading:
            self.heading += data
        elif self.cell:
            self.cell[3].append(data)


def _lines(rows: list, spans: bool):
    """The rows that hold any text, cells by column, None where a row has none; spanned cells are repeated where they reach."""
    below: dict[int, tuple] = {}
    for row in rows:
        if not below and (not spans or all(c[1] == 1 == c[2] for c in row)):
            line = row
        else:
            at, col, cells = {}, 0, list(reversed(row))
            while cells or any(c >= col for c in below):
                if col in below:
                    left, at[col] = below.pop(col)
                    if left > 1:
                        below[col] = (left - 1, at[col])
                    col += 1
                elif cells:
                    cell = cells.pop()
                    for _ in range(cell[2] if spans else 1):
                        at[col] = cell
                        if spans and cell[1] > 1:
                            below[col] = (cell[1] - 1, cell)
                        col += 1
                else:
                    col += 1
            line = [at.get(c) for c in range(max(at, default=-1) + 1)]
        if any(piece and not piece.isspace() for c in line if c for piece in c[3]):
            yield line


def _words(x: str) -> str:
    return " ".join(x.split())


#: What may be told of a cell.
OF_CELL = {"tag": lambda x: x[0], "text": lambda x: _words("".join(x[3])), "hrefs": lambda x: x[4], "lines": lambda x: [_words(y) for piece in x[3] for y in piece.splitlines() if y.strip()]}
CELL_TYPES = {"tag": ("string", pa.string()), "text": ("string", pa.string()), "hrefs": ("array<string>", pa.list_(pa.string())), "lines": ("array<string>", pa.list_(pa.string()))}


def _ddl(df: DataFrame, columns: list[str]) -> str:
    return "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in df.select(*columns).schema)


def html_cells(df: DataFrame, key: str, html: str = "html", spans: bool = True) -> DataFrame:
    """``key`` and one row for each cell of each table of each page; ``lines`` are the lines of its text nodes, which a line
    break ends. Null and empty pages give none."""

    def run(batches):
        types = [pa.int32(), *[pa.string()] * 5, pa.int32(), pa.int32(), *(t for _, t in CELL_TYPES.values())]
        names = [key, "table_no", "caption", *ABOUT, "row_no", "col_no", *CELL_TYPES]
        for b in batches:
            keys, out = [], []

            def made():
                cols = list(zip(*out, strict=True)) if out else [[]] * 12
                return pa.RecordBatch.from_arrays([b.column(0).take(pa.array(keys, pa.int32())), *(pa.array(c, t) for c, t in zip(cols, types, strict=True))], names=names)

            for at, texts in _slices(b):
                for i, text in enumerate(texts, at):
                    for t, table in enumerate(parse(_Cells(), text).tables):
                        about = (t, _words(table["caption"]), *(table[k] for k in ABOUT))
                        for r, line in enumerate(_lines(table["rows"], spans)):
                            out += [(*about, r, c, *(f(x) for f in OF_CELL.values())) for c, x in enumerate(line) if x]
                            keys += [i] * (len(out) - len(keys))
                            if len(out) >= ROWS:
                                yield made()
                                keys, out = [], []
            yield made()

    return df.select(key, html).mapInArrow(run, f"{_ddl(df, [key])}{CELL}")


def _nested(lengths: list[int], values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array([0, *accumulate(lengths)], pa.int32()), values)


def page_tables(df: DataFrame, html: str = "html", spans: bool = True, more: tuple[str, ...] = ()) -> DataFrame:
    """``df`` with ``tables`` in place of ``html``: one row a page, so that nothing has to be brought together again.

    Of each table that holds any text, in page order: table_no, caption, id, class, heading and anchor before it, and ``rows``,
    an array of cells by column for each row with text (null where spans leave a gap). A cell has its text, and ``more``
    (tag, hrefs, lines).
    """
    keep, parts = [c for c in df.columns if c != html], ["text", *more]
    cell = "struct<" + ",".join(f"{k}:{CELL_TYPES[k][0]}" for k in parts) + ">"
    about = ["caption", *ABOUT]

    def made(b, at, n, texts):
        cells, gaps, rows, lines, tables, pages = {k: [] for k in parts}, [], [], [], {k: [] for k in ("table_no", *about)}, []
        for text in texts:
            here = len(lines)
            for t, table in enumerate(parse(_Cells(), text).tables):
                first = len(rows)
                for line in _lines(table["rows"], spans):
                    rows.append(len(line))
                    gaps += [x is None for x in line]
                    for k in parts:
                        cells[k] += [None if x is None else OF_CELL[k](x) for x in line]
                if len(rows) > first:
                    lines.append(len(rows) - first)
                    for k, v in zip(tables, (t, _words(table["caption"]), *(table[k] for k in ABOUT)), strict=True):
                        tables[k].append(v)
            pages.append(len(lines) - here)
        x = pa.StructArray.from_arrays([pa.array(cells[k], CELL_TYPES[k][1]) for k in parts], parts, mask=pa.array(gaps, pa.bool_()))
        x = _nested(lines, _nested(rows, x))
        x = pa.StructArray.from_arrays([pa.array(tables["table_no"], pa.int32()), *(pa.array(tables[k], pa.string()) for k in about), x], [*tables, "rows"])
        return pa.RecordBatch.from_arrays([*(b.column(i).slice(at, n) for i in range(len(keep))), _nested(pages, x)], names=[*keep, "tables"])

    def run(batches):
        for b in batches:
            for at, texts in _slices(b):
                yield made(b, at, len(texts), texts)

    table = "struct<table_no:int," + "".join(f"{k}:string," for k in about) + f"rows:array<array<{cell}>>>"
    return df.select(*keep, html).mapInArrow(run, f"{_ddl(df, keep)}tables array<{table}>")


def page_labels(df: DataFrame, html: str = "html", first: bool = False) -> DataFrame:
    """``df`` with what its pages' tables (or the ``first`` of each alone) tell by label, in place of ``html``: one row a page.

    ``v``: each label's value; the label is a row's first cell, the value its others joined, and the last one counts.
    ``alone``: the texts of rows of one cell; ``filled``: whether there is any text at all.
    """
    keep = [c for c in df.columns if c != html]

    def run(batches):
        for b in batches:
            for at, texts in _slices(b):
                sizes, labels, values, single, alone, filled = [], [], [], [], [], []
                for text in texts:
                    v, some, here = {}, False, len(alone)
                    for table in parse(_Cells(), text).tables[: 1 if first else None]:
                        for line in _lines(table["rows"], False):
                            cells, some = [_words("".join(x[3])) for x in line], True
                            if len(cells) == 1:
                                alone += cells
                            elif cells[0]:
                                v[cells[0]] = " ".join(cells[1:])
                    labels += v
                    values += v.values()
                    sizes.append(len(v))
                    single.append(len(alone) - here)
                    filled.append(some)
                v = pa.MapArray.from_arrays(pa.array([0, *accumulate(sizes)], pa.int32()), pa.array(labels, pa.string()), pa.array(values, pa.string()))
                told = [v, _nested(single, pa.array(alone, pa.string())), pa.array(filled, pa.bool_())]
                yield pa.RecordBatch.from_arrays([*(b.column(i).slice(at, len(texts)) for i in range(len(keep))), *told], names=[*keep, "v", "alone", "filled"])

    return df.select(*keep, html).mapInArrow(run, f"{_ddl(df, keep)}v map<string,string>, alone array<string>, filled boolean")


class _Outline(HTMLParser):
    """Links and tables in page order, each with the headings above it, outermost first."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.found, self.above, self.tables = [], [], 0
        self.heading, self.link, self.caption, self.open = None, None, None, []

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        if tag in HEADINGS:
            self.above = [x for x in self.above if x[0] < tag]
            self.heading = (tag, [])
        elif tag == "a" and a.get("href") is not None:
            self.link = [len(self.found), []]
            self.found.append(["link", self.path(), None, "", a["href"]])
        elif tag == "table":
            self.open.append(len(self.found))
            self.found.append(["table", self.path(), self.tables, "", None])
            self.tables += 1
        elif tag == "caption" and self.open:
            self.caption = []

    def path(self):
        return [x[1] for x in self.above]

    def handle_endtag(self, tag):
        if self.heading and tag == self.heading[0]:
            self.above.append((tag, " ".join("".join(self.heading[1]).split())))
            self.heading = None
        elif tag == "a" and self.link:
            self.found[self.link[0]][3] = " ".join(" ".join(self.link[1]).split())
            self.link = None
        elif tag == "caption" and self.caption is not None:
            self.found[self.open[-1]][3] = " ".join("".join(self.caption).split())
            self.caption = None
        elif tag == "table" and self.open:
            self.open.pop()

    def handle_data(self, data):
        if self.heading:
            self.heading[1].append(data)
        if self.link:
            self.link[1].append(data)
        if self.caption is not None:
            self.caption.append(data)


def outline(df: DataFrame, key: str, html: str = "html") -> DataFrame:
    """key, pos, kind (link or table), headings (above it, outermost first), table_no, label (the link's text, the table's
    caption), href: one row for each link and table of each page, in one pass; null and empty pages give none."""
    kind = df.schema[key].dataType.simpleString()
    types = [pa.int32(), pa.string(), pa.list_(pa.string()), pa.int32(), pa.string(), pa.string()]

    def run(batches):
        for b in batches:
            keys, out = [], []
            for i, text in enumerate(b.column(1).to_pylist()):
                p = parse(_Outline(), text)
                keys += [i] * len(p.found)
                out += [(n, *x) for n, x in enumerate(p.found)]
            cols = list(zip(*out, strict=True)) if out else [[]] * 6
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(keys, pa.int32())), *(pa.array(c, t) for c, t in zip(cols, types, strict=True))], names=[key, "pos", "kind", "headings", "table_no", "label", "href"])

    return df.select(key, html).mapInArrow(run, f"`{key}` {kind}, pos int, kind string, headings array<string>, table_no int, label string, href string")


class _Text(HTMLParser):
    """Collects text nodes; those of scripts, styles and templates, and comments, are left out."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.nodes, self.skip = [""], 0

    def handle_starttag(self, tag, attrs):
        self.skip += tag in ("script", "style", "template")
        self.nodes.append("")

    def handle_endtag(self, tag):
        self.skip = max(0, self.skip - (tag in ("script", "style", "template")))
        self.nodes.append("")

    def handle_startendtag(self, tag, attrs):
        self.nodes.append("")

    def handle_comment(self, data):
        self.nodes.append("")

    def handle_data(self, data):
        if not self.skip:
            self.nodes[-1] += data


def clean_text(html: str | None) -> str:
    """The text nodes, each on a line of its own, trimmed; blank lines go."""
    p = _Text()
    p.feed(html or "")
    p.close()
    lines = (line.strip() for node in p.nodes for line in node.splitlines())
    return "\n".join(line for line in lines if line)


def text_of(html: Column) -> Column:
    """``clean_text`` of every row; null and empty pages give an empty text."""

    @F.pandas_udf("string")
    def run(x: pd.Series) -> pd.Series:
        return x.map(clean_text)

    return run(html)


class _Links(HTMLParser):
    """The targets of all links, in page order; character references are decoded, names of tags may be of any case."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.found = []

    def handle_starttag(self, tag, attrs):
        if tag == "a" and (href := dict(attrs).get("href")) is not None:
            self.found.append(href)


def links_of(html: Column) -> Column:
    """All link targets of every row's page; null pages have none."""

    def read(text: str | None) -> list[str]:
        p = _Links()
        p.feed(text or "")
        p.close()
        return p.found

    @F.pandas_udf("array<string>")
    def run(x: pd.Series) -> pd.Series:
        return x.map(read)

    return run(html)


class _Halves(HTMLParser):
    """Text lines before and after the first rule; blocks that hold a link are left out, and so is what stands before the start."""

    def __init__(self, start: str):
        super().__init__(convert_charrefs=True)
        self.start, self.begun, self.after = start, not start, False
        self.halves, self.divs, self.inside = ([], []), [], 0

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        if not self.begun:
            self.begun, self.inside = a.get("id") == self.start, 1
            return
        if tag == "hr":
            self.after = True
        elif tag == "div":
            self.divs.append((len(self.halves[0]), len(self.halves[1])))
        elif tag == "a" and a.get("href") and self.divs:  # the whole outermost block goes
            self.divs = [self.divs[0]] + [None] * (len(self.divs) - 1)
            self.divs[0] = (*self.divs[0][:2], True)

    def handle_endtag(self, tag):
        if tag == "div" and self.divs:
            d = self.divs.pop()
            if not self.divs and d and len(d) == 3:
                del self.halves[0][d[0] :], self.halves[1][d[1] :]

    def handle_data(self, data):
        if self.begun:
            self.halves[self.after].extend(line.strip() for line in data.splitlines() if line.strip())


def halves_of(html: Column, start: str = "TopContents") -> Column:
    """struct(preamble, body): lines before and after the page's rule, from the element ``start`` on, without blocks of links."""

    @F.pandas_udf("preamble string, body string")
    def run(x: pd.Series) -> pd.DataFrame:
        out = []
        for text in x:
            p = _Halves(start)
            p.feed(text or "")
            p.close()
            out.append(["\n".join(h) for h in p.halves])
        return pd.DataFrame(out, columns=["preamble", "body"])

    return run(html)
