"""Operator 1: BPE encoding and decoding by tree concatenation.

A text is cut at white space into runs, each run by the vocabulary's own normaliser and pre-tokenizer into pre-tokens.
A pre-token is cut into leaves of at most ``LEAF`` symbols; leaves are encoded each for itself, and neighbours are joined
pairwise, as a tree: the tokens around a join are encoded anew in a window that doubles until its outermost tokens are
those that both sides already had. A token sequence is the encoding of its text exactly if every adjacent pair is, so
agreement on the outermost tokens proves the joined sequence exact. Nothing in this depends on how long a text is; leaves
of texts with over ``LONG_CHARS`` characters are only dealt to many tasks, and the same joins meet them again.

Runs that come again are looked up: each worker keeps a bounded table of runs and their ids.

Defined results: null text counts as empty; an empty text has no ids; the strings of special tokens give their ids, as
the library does it; repeated rows and repeated ids each give a row; an empty table gives none; other columns of the
input are not read and may have any name. Texts may be of any length.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean

VOCABULARY = "word_bpe_49k.json"
#: Symbols in a leaf of the tree.
LEAF = 12
#: Texts over this many characters are dealt to several tasks, in rows of about ``PIECE_CHARS``.
LONG_CHARS = 1 << 20
PIECE_CHARS = 1 << 16
#: Runs (half as many where their strings are kept), and half as many pre-tokens, that a worker keeps, twice (a younger and an older table); longer ones than
#: ``KEPT_CHARS`` aren't kept.
CACHE = 500_000
KEPT_CHARS = 64
#: White space as the vocabulary's patterns know it (Python's own has four more control characters).
SPACES = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


#: Characters below this one need no normaliser but for their lower case (U+0250 ends the Latin letters with one).
LATIN = 0x250


def byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte: itself if printable, else from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return [chr(b) if b in plain else chr(256 + rest.index(b)) for b in range(256)]


def vocabulary_path(path: str | None) -> str:
    if path:
        return path
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


class Runs(dict):
    """The ids of runs, worked out when first asked for; at ``most`` runs the table starts anew beside its older self."""

    def __init__(self, make, most: int):
        super().__init__()
        self.make, self.most, self.old = make, most, {}

    def __missing__(self, run: str):
        e = self.old.get(run)
        if e is None:
            e = self.make(run)
        if len(run) <= KEPT_CHARS:
            if len(self) >= self.most:
                self.old = self.copy()
                self.clear()
            self[run] = e
        return e


class Encoder:
    """Encodes whole texts exactly as the tokenizers library does; learns nothing."""

    def __init__(self, path: str | None = None, leaf: int = LEAF, strings: bool = True):
        from tokenizers import Tokenizer, models

        path = vocabulary_path(path)
        lib = Tokenizer.from_file(path)
        self.model, self.leaf, self.strings = lib.model, leaf, strings
        self.normal, self.pretokens = lib.normalizer.normalize_str, lib.pre_tokenizer.pre_tokenize_str
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        m = spec["model"]
        self.end = m["end_of_word_suffix"]
        self.inner = models.BPE(vocab=m["vocab"], merges=[tuple(x) for x in m["merges"]])  # symbols inside a word: no end mark
        self.ids = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = [""] * (max([*m["vocab"].values(), *self.ids.values()]) + 1)
        for t, i in [*m["vocab"].items(), *self.ids.items()]:
            self.tokens[i] = t
        self.decimal = [str(i) for i in range(len(self.tokens))]
        self.special = re.compile("(" + "|".join(map(re.escape, self.ids)) + ")").split
        self.odd = re.compile("[\x1c-\x1f]").search
        self.split = re.compile(f"[^{SPACES}]+").findall
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        kind = {k: "".join(re.escape(chr(c)) for c in range(LATIN) if unicodedata.category(chr(c))[0] == k) for k in "LN"}
        self.plain = re.compile(pattern.replace(r"[\p{L}]", f"[{kind['L']}]").replace(r"[\p{N}]", f"[{kind['N']}]").replace(r"\p{L}\p{N}", kind["L"] + kind["N"])).findall
        self.foreign = re.compile(f"[^!-~\xa1-\xac\xae-{chr(LATIN - 1)}]").search
        self.letters = dict(enumerate(byte_letters()))
        self.found = Runs(self._run, CACHE // 2 if strings else CACHE)
        self.young, self.aged = {}, {}

    # one pre-token

    def encode_leaf(self, symbols: str, last: bool) -> list[int]:
        return [t.id for t in (self.model if last else self.inner).tokenize(symbols)] if symbols else []

    def join(self, left: list[int], right: list[int], last: bool) -> list[int]:
        """The ids of the two sides' text, from the sides' ids; ``last``: the right side ends the word."""
        k = 1
        while left and right:
            a, b = left[-k:], right[:k]
            ends = last and k >= len(right)
            s = "".join([self.tokens[i] for i in a + b])
            w = self.encode_leaf(s.removesuffix(self.end) if ends else s, ends)
            if (k >= len(left) or w[0] == a[0]) and (k >= len(right) or w[-1] == b[-1]):
                return left[:-k] + w + right[k:]
            k *= 2
        return left + right

    def tree(self, parts: list[list[int]], last: bool = True) -> list[int]:
        """Join neighbours' ids pairwise until one sequence is left; ``last``: the last part ends the word."""
        while len(parts) > 1:
            n = len(parts)
            parts = [self.join(parts[i], parts[i + 1], last and i + 2 >= n) if i + 1 < n else parts[i] for i in range(0, n, 2)]
        return parts[0] if parts else []

    def encode_symbols(self, symbols: str, last: bool = True) -> list[int]:
        """The ids of a pre-token, or of a stretch inside it, through the tree of its leaves."""
        if len(symbols) <= self.leaf:
            return self.encode_leaf(symbols, last)
        leaves = [symbols[i : i + self.leaf] for i in range(0, len(symbols), self.leaf)]
        return self.tree([self.encode_leaf(x, last and i + 1 == len(leaves)) for i, x in enumerate(leaves)], last)

    # texts

    def runs(self, text: str) -> list[str]:
        return self.split(text) if self.odd(text) else text.split()

    def parts(self, text: str) -> Iterator[tuple[bool, str]]:
        """(is a special token, text) in order."""
        if "<|" not in text:
            yield False, text
            return
        for p in self.special(text):
            yield p in self.ids, p

    def words(self, run: str) -> list[str]:
        """The pre-tokens of a run without white space, as symbols.

        Printable characters below ``LATIN`` whose lower case is below it as well have no marks to order or compose, so that
        the same pattern over an explicit list of letters and digits gives what the library's normaliser and pre-tokenizer
        give. Other runs go through the library's own (some capitals there, as U+0196, have a lower case above it).
        """
        low = run.lower()
        if self.foreign(run) or not low.isascii() and self.foreign(low):
            return [x[0] for x in self.pretokens(self.normal(run))]
        if low.isascii():
            return self.plain(low)
        return [w if w.isascii() else w.encode().decode("latin-1").translate(self.letters) for w in self.plain(low)]

    def entry(self, ids: list[int]):
        """ids as bytes, or with ``strings`` (ids as bytes, decimal ids, decoded text)."""
        packed = array("I", ids).tobytes()
        return (packed, " ".join([self.decimal[i] for i in ids]), " ".join([self.tokens[i] for i in ids])) if self.strings else packed

    def word(self, symbols: str):
        """A pre-token's entry, looked up if it was seen before."""
        e = self.young.get(symbols)
        if e is None:
            e = self.aged.get(symbols)
            if e is None:
                e = self.entry(self.encode_symbols(symbols))
            if len(symbols) <= KEPT_CHARS:
                if len(self.young) >= self.found.most // 2:
                    self.young, self.aged = {}, self.young
                self.young[symbols] = e
        return e

    def _run(self, run: str):
        parts = [self.word(w) for w in self.words(run)]
        if len(parts) == 1:
            return parts[0]
        if not self.strings:
            return b"".join(parts)
        return b"".join([p[0] for p in parts]), " ".join([p[1] for p in parts]), " ".join([p[2] for p in parts])

    def entries(self, text: str) -> list:
        """The entry of each run, in order."""
        out = []
        for special, part in self.parts(text):
            if special:
                out.append(self.entry([self.ids[part]]))
            else:
                found = self.found
                out += [found[run] for run in self.runs(part)]
        return out

    def encode_bytes(self, text: str | None) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        e = self.entries(text or "")
        return b"".join([x[0] for x in e] if self.strings else e)

    def encode(self, text: str | None) -> list[int]:
        import numpy as np

        return np.frombuffer(self.encode_bytes(text), "<u4").tolist()

    def decode(self, ids) -> str:
        """As the library decodes without a decoder: tokens joined by one space, special tokens kept."""
        return " ".join([self.tokens[i] for i in ids])

    def pieces(self, text: str, chars: int = PIECE_CHARS) -> Iterator[tuple[str, str]]:
        """(kind, piece): 'text' ends at white space, 'special' is such a token; 'mid' and 'last' are stretches of one long pre-token."""
        for special, part in self.parts(text):
            if special:
                yield "special", part
                continue
            held, size = [], 0
            for run in self.runs(part):
                if len(run) <= chars:
                    held.append(run)
                    size += len(run)
                    if size >= chars:
                        yield "text", " ".join(held)
                        held, size = [], 0
                    continue
                if held:
                    yield "text", " ".join(held)
                held, size = [], 0
                for w in self.words(run):
                    for i in range(0, len(w), chars):
                        yield ("last" if i + chars >= len(w) else "mid"), w[i : i + chars]
            if held:
                yield "text", " ".join(held)


def encoder(path: str | None = None, strings: bool = False) -> Encoder:
    """One encoder for each worker process; ``strings``: entries also hold decimal ids and decoded text."""
    kept = lean("bpe")
    if (path, strings) not in kept:
        kept.clear()
        kept[path, strings] = Encoder(path, strings=strings)
    return kept[path, strings]


def digest(entries: list[tuple]) -> tuple[int, str, str]:
    n = sum(len(e[0]) for e in entries) // 4
    full = [e for e in entries if e[0]]
    return n, hashlib.sha256(" ".join([e[1] for e in full]).encode()).hexdigest(), hashlib.sha256(" ".join([e[2] for e in full]).encode()).hexdigest()


def encode_long(df: DataFrame, path: str | None) -> DataFrame:
    """doc_id, ids (binary) of long texts: pieces become rows, are encoded apart, and are joined by document."""

    def cut(batches):
        enc = encoder(path)
        for b in batches:
            for rid, doc, text in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                for seq, (kind, piece) in enumerate(enc.pieces(text)):
                    yield pa.RecordBatch.from_pylist([{"rid": rid, "doc_id": doc, "seq": seq, "kind": kind, "piece": piece}], pa.schema([("rid", pa.int64()), ("doc_id", pa.int64()), ("seq", pa.int64()), ("kind", pa.string()), ("piece", pa.string())]))

    def code(batches):
        enc = encoder(path)
        for b in batches:
            x = b.to_pydict()
            ids = [enc.encode_bytes(piece) if kind in ("text", "special") else array("I", enc.encode_symbols(piece, kind == "last")).tobytes() for kind, piece in zip(x["kind"], x["piece"], strict=True)]
            yield pa.RecordBatch.from_pydict({"rid": x["rid"], "doc_id": x["doc_id"], "seq": x["seq"], "kind": x["kind"], "ids": ids}, pa.schema([("rid", pa.int64()), ("doc_id", pa.int64()), ("seq", pa.int64()), ("kind", pa.string()), ("ids", pa.binary())]))

    def join(t: pa.Table) -> pa.Table:
        import numpy as np

        enc, out, parts = encoder(path), [], []
        x = t.sort_by("seq").to_pydict()
        for kind, ids in zip(x["kind"], x["ids"], strict=True):
            if kind in ("text", "special"):
                out.append(ids)
            else:
                parts.append(np.frombuffer(ids, "<u4").tolist())
                if kind == "last":
                    out.append(array("I", enc.tree(parts)).tobytes())
                    parts = []
        return pa.Table.from_pydict({"doc_id": [x["doc_id"][0]], "ids": [b"".join(out)]}, pa.schema([("doc_id", pa.int64()), ("ids", pa.binary())]))

    rows = df.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    cutup = rows.mapInArrow(cut, "rid long, doc_id long, seq long, kind string, piece string").repartition("rid", "seq")
    coded = cutup.mapInArrow(code, "rid long, doc_id long, seq long, kind string, ids binary")
    # an empty text has no piece and so no row here, but such a text is never long
    return coded.groupBy("rid").applyInArrow(join, "doc_id long, ids binary")


def per_document(df: DataFrame, path: str | None, make, schema: str, long_chars: int = LONG_CHARS, strings: bool = False) -> DataFrame:
    """Rows that ``make(encoder, doc_id, entries)`` yields for each document, whole texts of any length."""
    docs = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def short(batches):
        enc = encoder(path, strings)
        for b in batches:
            rows = [r for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) for r in make(enc, doc, enc.entries(text))]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), arrow.types, strict=True)], schema=arrow) if rows else pa.RecordBatch.from_pylist([], arrow)

    def whole(batches):
        import numpy as np

        enc = encoder(path, strings)
        for b in batches:
            for doc, ids in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                rows = make(enc, doc, [enc.entry(np.frombuffer(ids, "<u4").tolist())])
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), arrow.types, strict=True)], schema=arrow)

    size = F.length("text")
    return docs.where(size <= long_chars).mapInArrow(short, schema).unionAll(encode_long(docs.where(size > long_chars), path).mapInArrow(whole, schema))


def bpe_roundtrip(df: DataFrame, path: str | None = None, long_chars: int = LONG_CHARS) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document."""
    return per_document(df, path, lambda enc, doc, entries: [(doc, *digest(entries))], "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", long_chars, strings=True)
