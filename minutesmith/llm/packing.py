"""Operator 5: packing by non-negative least squares.

A document's ids (with the end id) are cut into full windows and a rest. Rests fall into classes of ``STEP`` tokens
(rounded up). Shallow combinations of classes that fill a window are enumerated; repeat counts are solved against the
class histogram by non-negative least squares and rounded down; what is left is packed greedily. The plan depends on the
histogram alone (at most ``window / STEP`` numbers), and every piece finds its place by its rank in its class, so no
task ever holds more than its own pieces.

Defined results: null and empty texts are one end id; repeated rows are packed each for itself; a null doc_id is
packed like any other; an empty table gives no rows.
"""

from __future__ import annotations

import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import per_document
from .common import Scratch

WINDOW = 4096
STEP = 32
END = 2


def nnls(a, b, rounds: int | None = None):
    """Lawson and Hanson's active-set method: x >= 0 with the least |a x - b|."""
    import numpy as np

    m, n = a.shape
    x, on = np.zeros(n), np.zeros(n, bool)
    grad = a.T @ b
    for _ in range(rounds or 3 * m):
        free = np.where(on, -np.inf, grad)
        j = int(free.argmax())
        if free[j] <= 1e-7 * max(1.0, float(np.abs(b).max())):
            break
        on[j] = True
        while True:
            s = np.zeros(n)
            s[on] = np.linalg.lstsq(a[:, on], b, rcond=None)[0]
            if s[on].min() > 1e-12:
                break
            low = on & (s <= 1e-12)
            step = (x[low] / np.maximum(x[low] - s[low], 1e-300)).min()
            x = x + step * (s - x)
            on &= x > 1e-12
            if not on.any():
                break
        x = np.where(on, s, 0.0)
        grad = a.T @ (b - a @ x)
    return x


def combinations(classes: list[int], room: int) -> list[dict[int, int]]:
    """Shallow fillings of ``room``: some of one class, as many of a second as fit, and one class for the gap."""
    have, out = set(classes), {}
    for a in classes:
        for m in {1, room // a, max(1, room // a - 1), max(1, room // (2 * a))}:
            left = room - m * a
            for b in classes:
                if b > a:
                    break
                n = left // b
                gap = left - n * b
                use = {a: m}
                if n:
                    use[b] = use.get(b, 0) + n
                if gap and gap not in have:
                    gap = max((c for c in (gap - 1, gap - 2) if c in have), default=0)
                if gap:
                    use[gap] = use.get(gap, 0) + 1
                if sum(k * v for k, v in use.items()) >= room - 2:
                    out[tuple(sorted(use.items()))] = use
    return [out[k] for k in sorted(out)]


def plan(histogram: dict[int, int], room: int) -> list[tuple[dict[int, int], int]]:
    """[(pieces of each class in a sequence, repeats)] that uses every piece of the histogram exactly once."""
    import numpy as np

    left = {c: n for c, n in sorted(histogram.items()) if n}
    out = []
    if left:
        classes = sorted(left)
        combos = combinations(classes, room)
        if combos:
            place = {c: i for i, c in enumerate(classes)}
            a = np.zeros((len(classes), len(combos)))
            for j, use in enumerate(combos):
                for c, n in use.items():
                    a[place[c], j] = n
            scale = np.array([left[c] for c in classes], float)
            x = nnls(a, scale)
            for j in np.argsort(-x, kind="stable"):
                use = combos[j]
                k = min(int(x[j]), *(left[c] // n for c, n in use.items()))
                if k > 0:
                    out.append((use, k))
                    for c, n in use.items():
                        left[c] -= n * k
    while any(left.values()):
        use, free = {}, room
        for c in sorted((c for c, n in left.items() if n), reverse=True):
            n = min(left[c], free // c)
            if n:
                use[c] = n
                free -= n * c
        k = min(left[c] // n for c, n in use.items())
        out.append((use, k))
        for c, n in use.items():
            left[c] -= n * k
    return out


def pieces(df: DataFrame, path: str | None, window: int) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens: full windows and a rest of each document."""
    end = END.to_bytes(4, "little")

    def cut(enc, doc, entries):
        ids = b"".join(entries) + end
        n = len(ids) // 4
        return [(doc, s, min(window, n - s), zlib.crc32(ids[4 * s : 4 * (s + window)]), n) for s in range(0, n, window)]

    return per_document(df, path, cut, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long")


def pack(df: DataFrame, path: str | None = None, window: int = WINDOW, step: int = STEP) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset of every piece."""
    import numpy as np

    s = Scratch(df.sparkSession)
    own = pieces(df, path, window).withColumns({"uid": F.monotonically_increasing_id(), "part": F.spark_partition_id()})
    own = s.keep(own.withColumn("class", F.when(F.col("length") < window, F.ceil(F.col("length") / step)).otherwise(0).cast("int")), "pieces")
    histogram = {r["class"]: r["n"] for r in own.where(F.col("class") > 0).groupBy("class").agg(F.count("*").alias("n")).collect()}
    found = plan(histogram, window // step)
    first, sequences, table = 0, [], {c: [] for c in histogram}
    taken = dict.fromkeys(histogram, 0)
    for use, k in found:
        slot = 0
        for c, n in sorted(use.items(), reverse=True):
            table[c].append((taken[c], n, first, slot))
            taken[c] += n * k
            slot += n
        sequences.append(slot)
        first += k
    table = {c: np.array(rows, np.int64) for c, rows in table.items()}

    rests = own.where(F.col("class") > 0)
    counts = rests.groupBy("class", "part").agg(F.count("*").alias("n"))
    before = counts.select("class", "part", (F.sum("n").over(Window.partitionBy("class").orderBy("part")) - F.col("n")).alias("before"))
    local = F.row_number().over(Window.partitionBy("class", "part").orderBy("uid")) - 1
    ranked = rests.withColumn("local", local).join(before, ["class", "part"]).withColumn("rank", F.col("before") + F.col("local"))
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]

    def place(batches):
        for b in batches:
            c, r = b.column(5).to_numpy(), b.column(6).to_numpy()
            seq, slot = np.zeros(len(c), np.int64), np.zeros(len(c), np.int64)
            for k in np.unique(c):
                at = np.flatnonzero(c == k)
                t = table[int(k)]
                row = t[np.searchsorted(t[:, 0], r[at], side="right") - 1]
                seq[at] = row[:, 2] + (r[at] - row[:, 0]) // row[:, 1]
                slot[at] = row[:, 3] + (r[at] - row[:, 0]) % row[:, 1]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(5)), pa.array(seq), pa.array(slot)], names=[*names, "sequence_id", "slot"])

    placed = ranked.select(*names, "class", "rank").mapInArrow(place, ", ".join(f"{n} long" for n in [*names, "sequence_id", "slot"]))
    within = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("offset", F.coalesce(F.sum("length").over(within), F.lit(0)))
    full = own.where(F.col("class") == 0).select(*names, (F.lit(first) + F.col("uid")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return placed.select(*names, "sequence_id", "offset").unionAll(full)
