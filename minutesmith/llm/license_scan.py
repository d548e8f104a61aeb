"""Operator 6: licence scans with Aho-Corasick and licence expressions.

One automaton finds notice phrases and identifier tags in the words of a text; the expression after an
``SPDX-License-Identifier:`` tag is parsed by the shunting-yard method (and, or, with, brackets) and evaluated to its
licence labels: those that bind whichever side of an `or` is taken (``required``), and those that a choice can avoid
(``choices``). Words are runs of ASCII digits and letters (A-Z lower-cased) and of non-ASCII characters.

Defined results: null text counts as empty; an empty text has no words, null first and last places, empty labels and
score 0; an expression that does not parse gives the labels of its known identifiers, none of them required; a label that
one tag requires is no choice, whatever other tags say; repeated rows each give a row; texts are scanned whole, however
long; an empty table gives none; other columns, whatever they are called, are not read.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Phrases whose places count, and their labels.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
#: Further notice phrases.
NOTICES = {
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "bsd license": "bsd",
    "isc license": "isc",
    "creative commons": "cc",
    "redistribution and use in source and binary forms": "bsd",
    "permission is hereby granted free of charge": "mit",
    "licensed under the apache license": "apache",
    "this is free and unencumbered software": "unlicense",
    "all rights reserved": "proprietary",
    "public domain": "public-domain",
}
#: Families of licence identifiers by their first letters.
FAMILIES = {"apache": "apache", "mit": "mit", "gpl": "gpl", "lgpl": "lgpl", "agpl": "agpl", "bsd": "bsd", "mpl": "mpl", "epl": "epl", "isc": "isc", "unlicense": "unlicense", "cc0": "cc0", "cc-by": "cc-by", "zlib": "zlib", "bsl": "bsl", "artistic": "artistic", "ofl": "ofl"}
TAG = "spdx license identifier"
SPACES = bytes(b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))
EXPRESSION = re.compile(r"spdx-license-identifier:[ \t]*([^\r\n]*)", re.ASCII)
PIECE = re.compile(r"[()]|[a-z0-9][a-z0-9.+-]*")
BINDS = {"or": 1, "and": 2, "with": 3}


def identifier_label(name: str) -> str | None:
    return next((FAMILIES[f] for f in sorted(FAMILIES, key=len, reverse=True) if re.match(re.escape(f) + r"(?![a-z])", name)), None)


def postfix(expression: str) -> list[str] | None:
    """Shunting-yard: the expression's pieces in postfix order; None if it does not parse. It ends where a name follows a name."""
    out, held, operand = [], [], True
    for piece in PIECE.findall(expression):
        if piece == "(":
            if not operand:
                break
            held.append(piece)
        elif piece == ")":
            while held and held[-1] != "(":
                out.append(held.pop())
            if operand or not held:
                return None
            held.pop()
        elif piece in BINDS:
            if operand:
                return None
            while held and held[-1] != "(" and BINDS[held[-1]] >= BINDS[piece]:
                out.append(held.pop())
            held.append(piece)
            operand = True
        else:
            if not operand:
                break
            out.append(piece)
            operand = False
    if operand or "(" in held:
        return None
    return out + held[::-1]


def evaluate(expression: str) -> tuple[set[str], set[str]]:
    """(labels required under every choice, all labels): `and` requires what either side does, `or` what both sides do,
    `with` adds an exception to its licence."""
    pieces = postfix(expression)
    if pieces is None:
        return set(), {x for p in PIECE.findall(expression) if p not in BINDS and (x := identifier_label(p))}
    stack: list[tuple[set[str], set[str]]] = []
    for p in pieces:
        if p in BINDS:
            right, left = stack.pop(), stack.pop()
            if p == "with":
                stack.append(tuple(side | {f"{x}-exception" for x in side} for side in left))
            else:
                stack.append((left[0] & right[0] if p == "or" else left[0] | right[0], left[1] | right[1]))
        else:
            x = {identifier_label(p)} - {None}
            stack.append((x, x))
    return stack[-1] if stack else (set(), set())


def automaton():
    import ahocorasick

    a = ahocorasick.Automaton()
    for phrase, label in [*NOTICES.items(), *BASE.items(), (TAG, TAG)]:
        a.add_word(f" {phrase} ", (phrase, label))
    a.make_automaton()
    return a


def scan(text: str, a) -> tuple:
    low = text.encode("utf-8", "surrogatepass").lower()
    words = low.translate(SPACES).split()
    if not words:
        return 0, 0, None, None, "", "", 0.0, "", ""
    # Latin-1 letters stand for bytes: no decoding is needed, and places stay those of bytes
    joined = (b" " + b" ".join(words) + b" ").decode("latin-1")
    base, places, labels, found, tagged, at, word = set(), [], set(), 0, False, 0, 0
    required, stated = set(), set()
    for end, (phrase, label) in a.iter(joined):
        if label == TAG:
            tagged = True
            continue
        labels.add(label)
        if phrase in BASE:
            base.add(label)
            start = end - len(phrase)  # words are counted on from the place before, so that many places stay cheap
            word += joined.count(" ", at, start) if start >= at else -joined.count(" ", start, at)
            at = start
            places.append(word - 1)
        found += len(phrase.split())
    if tagged:
        for m in EXPRESSION.finditer(low.decode("latin-1")):
            must, every = evaluate(m[1])
            required |= must
            stated |= every
    labels |= base | stated
    score = 0.0 if not labels else min(1.0, 0.5 + 5.0 * found / len(words))
    return len(words), len(places), min(places, default=None), max(places, default=None), *(",".join(sorted(x)) for x in (base, labels)), score, *(",".join(sorted(x)) for x in (required, stated - required))


SCHEMA = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, required string, choices string"


def license_scan(df: DataFrame) -> DataFrame:
    """One pass over whole texts, no shuffle: n_words, n_base, first_word, last_word, base_labels, labels, score, required, choices by doc_id."""
    types = pa.schema([("doc_id", pa.int64()), *((n, pa.int64()) for n in ("n_words", "n_base", "first_word", "last_word")), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()), ("required", pa.string()), ("choices", pa.string())])

    def run(batches):
        a = automaton()
        for b in batches:
            rows = [scan(t or "", a) for t in b.column(1).to_pylist()]
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 9
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, t) for c, t in zip(cols, types.types[1:], strict=True))], schema=types)

    return df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, SCHEMA)
