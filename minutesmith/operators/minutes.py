"""Meeting minutes: lines, first and last matches, look-ahead, wrapped items, attendance, membership changes, rollup."""

from __future__ import annotations

from collections.abc import Callable
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import minutes as M
from ..functions import text as T
from ..functions.opening import Opening

# Headers of attendance sections and of roles.
SECTIONS = ["委員外の出席者", "委員以外の出席者", "委員外出席者", "国務大臣", "副大臣", "大臣政務官", "事務局側", "参考人", "政府参考人", "政府特別補佐人"]
ROLES = ["理事", "委員", "委員長", "事務局側", "政府参考人", "政府特別補佐人", "大臣政務官"]
# Lines that open the attendance, the changes of members, and the agenda.
PRESENT = ["出席委員", "出席者は左のとおり。"]
CHANGES = "委員の異動"
AGENDA = ["本日の会議に付した案件", "本日の会議に付した事件", "本日の開議に付した事件"]
# What an item of its own ends in.
ITEM_ENDS = ["法律案", "予算", "決算", "条約", "承認", "請求", "同意", "請願", "の件", "関する件", "互選", "選任", "選挙", "辞職", "挨拶", "祝辞", "謝辞", "報告聴取"]


def text_lines(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """key, pos, line: every line of every text."""
    return df.select(key, F.posexplode(M.lines_of(F.col(text))).alias("pos", "line"))


def first_last(speeches: DataFrame, key: str, order: str, text: str) -> DataFrame:
    """key, intro, closing: the texts of each meeting's first and last speech. Only the latest and the earliest of a task's
    speeches leave it."""
    return speeches.groupBy(key).agg(F.min_by(text, order).alias("intro"), F.max_by(text, order).alias("closing"))


def first_match(lines: DataFrame, key: str) -> DataFrame:
    """meeting_date, opening_line, opening_time, closing_line, closing_time of each meeting; lines without outer white space
    and with single spaces inside."""
    x = lines.select(key, "pos", T.normalize_text(F.col("line")).alias("_line"))
    day, line = T.era_date(F.col("_line")), F.col("_line")
    opening, closing = line.rlike("開議|開会"), line.rlike("散会|休憩|延会")
    x = x.groupBy(key).agg(
        F.min_by(F.when(day.isNotNull(), day), F.when(day.isNotNull(), F.col("pos"))).alias("meeting_date"),
        F.min_by("_line", F.when(opening, F.col("pos"))).alias("opening_line"),
        F.max_by("_line", F.when(closing, F.col("pos"))).alias("closing_line"),
    )
    return x.withColumn("opening_time", T.clock_time(F.col("opening_line"))).withColumn("closing_time", T.clock_time(F.col("closing_line")))


def ahead(lines: DataFrame, key: str, hit: Column, stop: Column, rows: int, name: str) -> DataFrame:
    """``name``: whether a line that ``hit`` holds for comes within ``rows`` lines, before one that ``stop`` holds for."""
    w = Window.partitionBy(key).orderBy("pos").rowsBetween(1, rows)
    h, s = F.min(F.when(hit, F.col("pos"))).over(w), F.min(F.when(stop, F.col("pos"))).over(w)
    return lines.withColumn(name, h.isNotNull() & (s.isNull() | (h <= s)))


def wrapped_items(lines: DataFrame, key: str, ends: list[str] = ITEM_ENDS) -> DataFrame:
    """key, item_no, item: lines joined to the item they carry on (indented by two, and opened by a bracket or a conjunction)."""
    text = F.regexp_replace(T.normalize_text(F.col("line")), "^○+", "")
    own = F.col("line").rlike("^[\\s　]*○") | text.rlike("^[一二三四五六七八九十百千]+、|^日程第[一二三四五六七八九十百千0-9０-９]+")
    for e in ends:
        own = own | text.endswith(e)
    goes_on = ~own & F.col("line").rlike("^[\\s　]{2,}") & text.rlike("^(（|[(]|及び|並びに)")
    kept = lines.where((text != "") & ~M.is_rule(F.col("line")))
    w = Window.partitionBy(key).orderBy("pos")
    kept = kept.withColumn("_own", F.when(goes_on & F.lag("pos").over(w).isNotNull(), 0).otherwise(1))  # the first line carries on nothing
    n = F.sum("_own").over(w)
    item = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "text"))), lambda x: x["text"]), "")
    return kept.withColumn("text", text).withColumn("item_no", n).groupBy(key, "item_no").agg(item.alias("item"))


def next_lines(lines: DataFrame, key: str, rows: int, name: str) -> DataFrame:
    """``name``: the array of the ``rows`` lines below each line, without white space."""
    w = Window.partitionBy(key).orderBy("pos").rowsBetween(1, rows)
    return lines.withColumn(name, F.collect_list(T.without_space(F.col("line"))).over(w))


def before_stop(below: Column, stop: Callable[[Column], Column]) -> Column:
    """The lines of an array up to the first that stops, that one included."""
    at = F.array_min(F.filter(F.transform(below, lambda x, i: F.when(stop(x), i + 1)), lambda i: i.isNotNull()))
    return F.slice(below, F.lit(1), F.coalesce(at, F.size(below)))


def sections(lines: DataFrame, key: str, has_date: Column | None = None) -> DataFrame:
    """Every filled line with its state, and whether it is a control line: the section of the minutes that it stands in.

    States: attendance, membership, referred, agenda, or null. Only control lines change the state, so they alone (a few
    a meeting) are folded, in order; the state then holds for the lines below. What a line is, may depend on lines ahead:
    a day may begin a section of referrals or of changes of members.
    """
    raw, flat = F.col("line"), T.without_space(F.col("line"))
    opens = lambda x: x.contains("開議") | x.contains("開会")
    agenda = lambda x: F.regexp_replace(x, "^[○●]+", "").isin(AGENDA)
    x = next_lines(next_lines(lines, key, 11, "_far"), key, 7, "_near")
    # blank lines fill the frame but tell nothing
    far = F.filter(F.transform(before_stop(F.col("_far"), lambda y: opens(y) | (y == CHANGES) | y.endswith(AGENDA[0]) | y.endswith("付託された。")), lambda y: y), lambda y: y != "")
    near = F.array_join(before_stop(F.col("_near"), lambda y: opens(y) | agenda(y)), "")
    sub = near.contains("補欠") | near.contains("当選") | near.contains("選任")
    day, relative = flat.rlike(f"^{T.NUMBER}月{T.NUMBER}日$"), flat.rlike(f"^同日$|^同月{T.NUMBER}日$")
    dated = F.lit(True) if has_date is None else has_date
    moved = flat.contains("辞任") & (flat.contains("補欠") | flat.contains("当選") | flat.contains("選任"))
    x = x.where(flat != "").select(
        *lines.columns,
        (day | relative).alias("_day"),
        F.struct(
            F.col("pos"),
            M.is_rule(raw).alias("rule"),
            flat.isin(PRESENT).alias("present"),
            (flat == CHANGES).alias("changes"),
            ((dated & day & near.contains("辞任") & sub) | relative | moved).alias("moves"),
            agenda(flat).alias("agenda"),
            (dated & day & F.coalesce(F.try_element_at(far, F.lit(-1)).endswith("付託された。"), F.lit(False))).alias("refers"),
            flat.endswith("付託された。").alias("referred"),
            opens(flat).alias("opens"),
        ).alias("_m"),
    )
    m = F.col("_m")
    control = m["rule"] | m["present"] | m["changes"] | m["moves"] | m["agenda"] | m["refers"] | m["referred"] | m["opens"]
    marks = x.where(control).groupBy(key).agg(F.array_sort(F.collect_list("_m")).alias("_marks"))

    def step(acc, c):
        at = F.element_at(acc, -1)["state"]
        state = (
            F.when(c["rule"], "none")
            .when(c["present"], "attendance")
            .when(c["changes"], "membership")
            .when(c["moves"] & (at == "attendance"), "membership")
            .when(c["agenda"], "agenda")
            .when(c["refers"] & (at == "none"), "referred")
            .when(c["referred"] & (at == "referred"), "none")
            .when(c["opens"] & (at == "agenda"), "none")
            .otherwise(at)
        )
        # a line that opens or ends a section has no item of its own; a day inside a section of changes is one of its lines
        own = c["rule"] | c["present"] | c["changes"] | c["agenda"] | (c["refers"] & (at == "none")) | (c["referred"] & (at == "referred")) | (c["opens"] & (at == "agenda"))
        return F.array_append(acc, F.struct(c["pos"].cast("int").alias("pos"), state.alias("state"), own.alias("control")))

    none = F.array(F.struct(F.lit(-1).alias("pos"), F.lit("none").alias("state"), F.lit(False).alias("control")))
    folded = marks.select(key, F.explode(F.aggregate("_marks", none, step)).alias("s")).select(key, "s.*")
    w = Window.partitionBy(key).orderBy("pos")
    y = x.drop("_m").join(folded, [key, "pos"], "left")
    return y.withColumns({"state": F.nullif(F.last("state", ignorenulls=True).over(w), F.lit("none")), "control": F.coalesce("control", F.lit(False)), "is_day": F.col("_day")}).drop("_day")


def attendance(lines: DataFrame, key: str, default_role: str | None = None, default_section: str | None = None) -> DataFrame:
    """key, pos, n, section, role, title, name: section and role headers hold for the lines below; a line may name several people.

    Lines without a name that are no headers are the wrapped beginning of the next line with one. What stands in brackets
    before a name is a title, under the role or else the section above. Of a line nothing counts from the first piece on
    that is no person. Lines may come from ``sections`` (then only the section of attendance counts) or from anywhere.
    """
    flat, text = T.without_space(F.col("line")), T.normalize_text(F.col("line"))
    x = lines.where(flat != "")
    if "state" in lines.columns:
        x = x.where("state = 'attendance' OR control")
    reset = M.is_rule(F.col("line")) | flat.isin(PRESENT) | (F.col("control") if "control" in lines.columns else F.lit(False))
    bare = ~F.col("line").contains("君") & ~text.startswith("〔") & ~reset
    head = bare & (flat.isin(SECTIONS) | flat.endswith("委員会"))
    role = bare & ~head & flat.isin(ROLES)
    pending = bare & ~head & ~role
    w = Window.partitionBy(key).orderBy("pos")
    section = F.when(flat.isin(PRESENT), F.lit(default_section).cast("string")).when(head, flat)
    x = x.withColumns({"_reset": reset, "_head": head, "_pending": pending})
    named = F.struct(F.coalesce(section, F.lit("")).alias("v"))  # a struct tells "no section" from "no header here"
    x = x.withColumn("section", T.blank_to_null(F.last(F.when(head | reset, named), ignorenulls=True).over(w)["v"]))
    x = x.withColumn("header", T.blank_to_null(F.last(F.when(head | reset, F.lit("")).when(role, flat), ignorenulls=True).over(w)))
    x = x.withColumn("_group", F.sum(F.when(pending, 0).otherwise(1)).over(w) - F.when(pending, 0).otherwise(1))
    carried = F.array_join(F.collect_list(F.when(F.col("_pending"), text)).over(Window.partitionBy(key, "_group").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)), " ")
    x = x.withColumn("_whole", F.trim(F.concat_ws(" ", carried, text))).where(~F.col("_pending") & ~F.col("_head") & ~F.col("_reset"))
    pieces = F.filter(F.split("_whole", "(?<!^)(?=(?:委員長|理事) )"), lambda p: F.trim(p) != "")
    people = F.transform(pieces, lambda p: F.transform(M.names_in(p), M.name_and_role))
    known = F.transform(people, lambda p: F.slice(p, F.lit(1), F.coalesce(F.array_min(F.filter(F.transform(p, lambda y, i: F.when(y.isNull(), i)), lambda i: i.isNotNull())), F.size(p))))
    x = x.select(key, "pos", "section", "header", F.posexplode(F.flatten(known)).alias("n", "p"))
    prefix = F.replace(F.col("p.role"), F.lit(" "))
    titled = prefix.rlike("^[（(]") & F.coalesce("header", "section").isNotNull()
    usual = F.coalesce("header", F.lit(default_role).cast("string"))
    who = F.when(titled, F.coalesce("header", "section")).otherwise(F.coalesce(T.blank_to_null(prefix), usual))
    return x.select(key, "pos", "n", "section", who.alias("role"), F.when(titled, prefix).alias("title"), F.col("p.name").alias("name"))


def changes(lines: DataFrame, key: str, meeting_date: str) -> DataFrame:
    """key, pos, changed_at, resigned, appointed of lines with two names; a date line holds for the lines below it.

    `同月D日` is a day of the meeting's month; `同日` is the date above it, or the meeting's date where there is none.
    """
    w, held, line = Window.partitionBy(key).orderBy("pos"), F.col(meeting_date), T.without_space(F.col("line"))
    whole = line.rlike(f"^({T.NUMBER}月|同月){T.NUMBER}日$")  # the whole line is a day
    named = F.regexp_replace(line, "^同月", F.concat(F.month(held).cast("string"), F.lit("月")))
    x = lines.withColumn("changed_at", F.coalesce(F.last(F.when(whole, T.month_day_near(named, held)), ignorenulls=True).over(w), F.when(F.max(line == "同日").over(w), held)))
    if "state" in lines.columns:
        x = x.where("state = 'membership'")
    x = x.withColumn("p", M.names_in(F.col("line")))
    return x.where(F.size("p") >= 2).select(key, "pos", "changed_at", T.person_key(F.col("p")[0]).alias("resigned"), T.person_key(F.col("p")[1]).alias("appointed"))


ENTRY = {"state": pa.string(), "pos": pa.int32(), "n": pa.int32(), "section": pa.string(), "role": pa.string(), "title": pa.string(), "name": pa.string(), "other": pa.string(), "day": pa.date32()}
TEXTS = 256  # looked at by a task at once


def entries(df: DataFrame, key: str, text: str, held: Column, default_role: str | None = None, default_section: str | None = None, has_date: Column | None = None) -> DataFrame:
    """key, state, pos, n, section, role, title, name, other, day: all that the minutes' opening text lists, in one pass.

    attendance: section, role, title, name; membership: day, name (resigned), other (appointed); referred and agenda: name
    (the item), pos (its number). One walk over a text's lines (``functions.opening``), in Python because a fold of built-in
    functions is interpreted line by line; its entries are exploded once. The table is read once and not shuffled.
    ``held``: the day of the meeting. A null text has no entries; a text's cost grows with its lines.
    """
    dated = F.coalesce(F.lit(True) if has_date is None else has_date, F.lit(False))
    x = df.select(key, held.cast("date").alias("_held"), dated.alias("_dated"), F.col(text).alias("_text"))
    field, name = x.schema[0], x.columns[0]

    def run(batches):
        read = Opening(SECTIONS, ROLES, PRESENT, CHANGES, AGENDA, ITEM_ENDS, default_role, default_section)
        for whole in batches:
            for b in (whole.slice(i, TEXTS) for i in range(0, whole.num_rows, TEXTS)):
                days = b.column(1).cast(pa.int32()).to_pylist()
                found = [read.entries(t, d, ok) for t, d, ok in zip(b.column(3).to_pylist(), days, b.column(2).to_pylist(), strict=True)]
                cols = list(zip(*(e for es in found for e in es), strict=True)) or [[]] * len(ENTRY)
                values = [pa.array(c, pa.int32()).cast(t) if t == pa.date32() else pa.array(c, t) for c, t in zip(cols, ENTRY.values(), strict=True)]
                offsets = pa.array([0, *accumulate(map(len, found))], pa.int32())
                listed = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(values, list(ENTRY)))
                yield pa.RecordBatch.from_arrays([b.column(0), listed], names=[name, "_e"])

    kinds = ",".join(f"{k}:{ {pa.string(): 'string', pa.int32(): 'int', pa.date32(): 'date'}[t] }".replace(" ", "") for k, t in ENTRY.items())
    made = x.mapInArrow(run, f"`{name}` {field.dataType.simpleString()}, _e array<struct<{kinds}>>")
    return made.select(name, F.explode("_e").alias("_e")).select(name, "_e.*")


def publish_list(meetings: DataFrame, matched: DataFrame, key: str, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of every meeting, and matched_item_count: its rows in ``matched``."""
    n = matched.groupBy(key).agg(F.count("*").alias("matched_item_count"))
    return meetings.select(key, *keep).join(n, key, "left").withColumn("matched_item_count", F.coalesce("matched_item_count", F.lit(0)))


def publish_detail(meetings: DataFrame) -> DataFrame:
    """Meetings without the texts of the first and last speech, referred items and membership changes."""
    return meetings.drop("intro", "closing", "referred_items", "membership_changes")


def rollup(speeches: DataFrame, key: str, order: str, speaker: str, text: str) -> DataFrame:
    """One row a meeting: speeches, distinct speakers in first-seen order, the first and the last speech."""
    who = speeches.groupBy(key, speaker).agg(F.min(order).alias("first"), F.count("*").alias("n"))
    names = who.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("first", speaker))), lambda x: x[speaker]).alias("speakers"), F.sum("n").alias("speech_count"))
    return names.join(first_last(speeches, key, order, text), key)
