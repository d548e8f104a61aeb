"""Typed rows from cells: sessions, bills, progress of bills, questions and petitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import documents as D
from ..functions import text as T
from . import html_tables as H

# Words in headers of the session table and of bill tables, and the columns they name.
SESSION_ROLES = {"回次": "number", "召集日": "convocation_date", "会期終了日": "closing_date", "当初会期": "initial_duration_days", "延長": "extension_days", "会期": "duration_days"}
BILL_ROLES = {"議案件名": "title", "件名": "title", "提出回次": "submitted_session", "番号": "bill_number", "審議状況": "status", "区分": "subcategory"}
# Labels on a bill's progress page (with %s for the house), and the fields they fill.
BILL_LABELS = {"議案種類": "bill_type", "議案提出回次": "bill_submit_session", "議案番号": "bill_number", "議案件名": "bill_title", "議案提出者": "submitter", "議案提出会派": "submitter_group"}
DATE_LABELS = {"%s予備審査議案受理年月日": "pre_review_received_at", "%s議案受理年月日": "bill_received_at"}
PAIR_LABELS = {"%s予備付託年月日／%s予備付託委員会": "pre_referral", "%s付託年月日／%s付託委員会": "referral", "%s審査終了年月日／%s審査結果": "review_finished", "%s審議終了年月日／%s審議結果": "plenary_finished"}
LOWER, UPPER, PROMULGATION = "衆議院", "参議院", "公布年月日／法律番号"
STANCE, FOR, AGAINST = "衆議院審議時会派態度", "衆議院審議時賛成会派", "衆議院審議時反対会派"
# A question's states, the remark on a delayed answer, and the section of petitions that weren't referred.
ANSWERED, OPEN, DELAYED, NOT_REFERRED = "答弁受理", "未答弁", "答弁延期", "付託に至らなかった請願"
NOTICE, DUE = "([0-9]+月[0-9]+日)内閣から通知書受領", "([0-9]+月[0-9]+日)まで答弁延期"


def pick_by_id(tables: Column, ident: str) -> Column:
    """Those of a page's tables that have the id."""
    return F.filter(tables, lambda t: t["table_id"] == ident)


def of_class(tables: Column, name: str) -> Column:
    """Those of a page's tables that have the class, in page order."""
    return F.filter(tables, lambda t: F.array_contains(F.split(t["table_class"], " +"), name))


def pick_last_of_class(tables: Column, name: str) -> Column:
    """A page's last table of a class, as an array of one; empty without one."""
    of = of_class(tables, name)
    return F.slice(of, F.greatest(F.size(of), F.lit(1)), 1)


def pick_after_heading(tables: Column, word: str) -> Column:
    """The tables below a heading that holds ``word``; the anchor before a table is its ``code``."""
    of = F.filter(tables, lambda t: t["heading_before"].contains(word))
    return F.transform(of, lambda t: t.withField("code", T.blank_to_null(t["anchor_before"])))


def sessions(cells: DataFrame, key: str, roles: dict[str, str] = SESSION_ROLES) -> DataFrame:
    """Typed rows of the session table; rows without a number go."""
    x = H.header_roles(cells, key, roles)
    n = T.number_and_type(F.col("number"))
    days = [T.parse_int(F.col(c)).alias(c) for c in ("duration_days", "initial_duration_days", "extension_days")]
    out = x.select(key, "row_no", n.alias("n"), T.era_date(F.col("convocation_date")).alias("convocation_date"), T.era_date(F.col("closing_date")).alias("closing_date"), T.closing_note(F.col("closing_date")).alias("closing_note"), *days)
    return out.where("n.number IS NOT NULL").select(key, "n.number", F.col("n.type").alias("session_type"), *[c for c in out.columns if c not in (key, "n", "row_no")])


def bills(pages: DataFrame, base: Column, suffix: str = "の一覧", roles: dict[str, str] = BILL_ROLES) -> DataFrame:
    """Typed rows of captioned bill tables (pages from ``html.page_tables`` with hrefs): category from the caption, blank fields
    null, links resolved; rows without a title go. The pages' other columns stay."""
    rest = [c for c in pages.columns if c != "tables"]
    own = F.filter("tables", lambda t: t["caption"].endswith(suffix))
    t = pages.select(*rest, F.explode(own).alias("t")).select(*rest, "t.table_no", F.regexp_replace("t.caption", f"{suffix}$", "").alias("category"), "t.rows")
    x = H.role_rows(t, roles).where(F.length("title") > 0)
    links = F.transform(F.filter("cells", lambda c: F.size(c["hrefs"]) > 0), lambda c: c["hrefs"][0])
    x = x.withColumn("l", links)
    urls = [H.absolute(F.try_element_at(F.col("l"), F.lit(i)), base).alias(n) for i, n in ((1, "progress_url"), (2, "text_url"))]
    return x.select(*rest, "table_no", "row_no", "category", "subcategory", T.parse_int(F.col("submitted_session")).alias("submitted_session"), T.parse_int(F.col("bill_number")).alias("bill_number"), "title", "status", *urls)


def _told(pages: DataFrame) -> list[str]:
    """The columns of ``html.page_labels`` but those it adds."""
    return [c for c in pages.columns if c not in ("v", "alone", "filled")]


def progress(pages: DataFrame) -> DataFrame:
    """A bill's progress from the labels of its page's first table: its fields, one struct for each house, and the promulgation;
    only the lower house has stance and groups. Pages without a label go."""
    v = lambda label: T.blank_to_null(F.try_element_at("v", F.lit(label)))
    own = [(T.parse_int(v(x)) if n in ("bill_submit_session", "bill_number") else v(x)).alias(n) for x, n in BILL_LABELS.items()]

    def house(name: str) -> Column:
        lower = name == LOWER
        dates = [T.era_date(v(x % name)).alias(n) for x, n in DATE_LABELS.items()]
        pairs = [T.date_and_text(v(x % (name, name))).alias(n) for x, n in PAIR_LABELS.items()]
        groups = [(F.coalesce(T.split_list(v(x)), F.expr("cast(array() as array<string>)")) if lower else F.expr("cast(array() as array<string>)")).alias(n) for x, n in ((FOR, "supporting_groups"), (AGAINST, "opposing_groups"))]
        return F.struct(*dates, *pairs, (v(STANCE) if lower else F.lit(None).cast("string")).alias("stance"), *groups)

    made = T.date_and_text(v(PROMULGATION))
    return pages.where(F.size("v") > 0).select(*_told(pages), *own, house(LOWER).alias("house_of_reps"), house(UPPER).alias("house_of_councillors"), made["day"].alias("promulgated_at"), made["text"].alias("law_number"))


# Labels in the further tables of a member's bill.
SUBMITTERS, SUPPORTERS = "議案提出者一覧", "議案提出の賛成者"


def extra_sections(cells: DataFrame, key: str) -> DataFrame:
    """key, sections: the tables below a progress page's first, each with its caption (null without) and its labels and values
    in order; tables without a label are left out."""
    x = cells.where("table_no > 0").groupBy(key, "table_no", "row_no").agg(F.first("caption").alias("caption"), F.array_sort(F.collect_list(F.struct("col_no", "text"))).alias("c"))
    x = x.withColumn("t", F.transform("c", lambda y: y["text"])).withColumn("label", F.get("t", F.lit(0))).where(F.length("label") > 0)
    value = F.array_join(F.slice("t", F.lit(2), F.size("t")), " ")
    one = x.groupBy(key, "table_no").agg(F.first("caption").alias("caption"), F.array_sort(F.collect_list(F.struct("row_no", "label", value.alias("value")))).alias("e"))
    entries = F.transform("e", lambda y: F.struct(y["label"].alias("label"), y["value"].alias("value")))
    sections = F.array_sort(F.collect_list(F.struct("table_no", T.blank_to_null(F.col("caption")).alias("section_name"), entries.alias("entries"))))
    return one.groupBy(key).agg(F.transform(sections, lambda y: y.dropFields("table_no")).alias("sections"))


def member_law(sections: Column) -> Column:
    """struct(submitter_list, supporters) of a page's further tables; null where both are empty. The last value of a label counts."""
    entries = F.flatten(F.transform(sections, lambda y: y["entries"]))

    def people(label: str) -> Column:
        last = F.try_element_at(F.filter(entries, lambda e: e["label"] == label), F.lit(-1))["value"]
        return F.coalesce(T.split_list(last), F.array().cast("array<string>"))

    mine, theirs = people(SUBMITTERS), people(SUPPORTERS)
    return F.when((F.size(mine) > 0) | (F.size(theirs) > 0), F.struct(mine.alias("submitter_list"), theirs.alias("supporters")))


def document_list(outline: DataFrame, key: str, base: Column) -> DataFrame:
    """key, pos, section, label, type, title, note, url, file_key: the documents that a bill's text page links below its own
    folder (`./`), in page order, with the heading they stand under."""
    links = outline.where("kind = 'link'").where(F.col("href").startswith("./"))
    x = links.select(key, "pos", F.try_element_at("headings", F.lit(-1)).alias("section"), T.normalize_text(F.col("label")).alias("label"), H.absolute(F.col("href"), base).alias("url"))
    return x.select(key, "pos", "section", "label", D.classify_document(F.col("label")).alias("d"), "url", D.url_key(F.col("url")).alias("file_key")).select(key, "pos", "section", "label", "d.*", "url", "file_key")


def question_progress(pages: DataFrame) -> DataFrame:
    """A question's dates and status. A remark in a row of one cell tells of a delay; its days are of the year of submission."""
    rest = _told(pages)
    note = F.try_element_at(F.filter("alone", lambda x: x.contains("内閣から通知書受領") | x.contains("答弁延期")), F.lit(-1))
    day = lambda label: T.era_date(F.try_element_at("v", F.lit(label)))
    x = pages.where("filled").select(*rest, note.alias("note"), day("提出日").alias("submitted_at"), day("転送日").alias("cabinet_sent_at"), day("答弁書受領日").alias("answer_received_at"))
    said = lambda p: T.month_day_default(F.regexp_extract("note", p, 1), F.year("submitted_at"))
    x = x.withColumns({"answer_delay_notice_received_at": said(NOTICE), "answer_due_at": said(DUE)})
    status = F.when(F.col("answer_received_at").isNotNull(), ANSWERED).when(F.col("answer_due_at").isNotNull(), DELAYED).otherwise(OPEN)
    return x.withColumn("status", status).drop("note")


def is_referred(section: Column) -> Column:
    """Petitions are referred unless their section says otherwise."""
    return ~section.eqNullSafe(F.lit(NOT_REFERRED))


def petition(pages: DataFrame, count: str, signers: str, outcome: str, presenters: str) -> DataFrame:
    """receipt_count, signer_count (thousands separators go), outcome and presenters of a petition's page, by its labels; pages
    without a label go."""
    v = lambda label: F.try_element_at("v", F.lit(label))
    n = lambda label: T.parse_int(F.regexp_replace(v(label), "[,，]", ""))
    return pages.where(F.size("v") > 0).select(*_told(pages), n(count).alias("receipt_count"), n(signers).alias("signer_count"), T.blank_to_null(v(outcome)).alias("outcome"), H.presenters(F.regexp_replace(v(presenters), "君 ", "君\n")).alias("presenters"))


# First cells of rows of the upper house's page on similar petitions, and its table's class.
NEW_NUMBER, RECEIPT, SUBJECT, LIST_CLASS = "新件番号", "受理番号", "件名", "list_c"


def upper_petition(pages: DataFrame) -> DataFrame:
    """accepted_count, signer_count, outcome and presenters of the upper house's page on similar petitions (pages from
    ``html.page_tables`` without spans, with lines); the pages' other columns stay, pages without a row of six cells go.

    Of its first list, the row of the new numbers gives the counts, and every row that begins with a receipt's number one
    presenter for each line of its second cell, with the party on the same line of the third (null where there is none). The
    outcome is the presenters' most frequent result, of several the one seen first.
    """
    rest = [c for c in pages.columns if c != "tables"]
    rows = F.filter(F.get(of_class(F.col("tables"), LIST_CLASS), 0)["rows"], lambda r: F.size(r) >= 6)
    x = pages.select(*rest, rows.alias("rows")).where(F.size("rows") > 0)
    own = F.try_element_at(F.filter("rows", lambda r: r[0]["text"] == NEW_NUMBER), F.lit(-1))
    body = F.filter("rows", lambda r: ~r[0]["text"].isin(NEW_NUMBER, RECEIPT, SUBJECT))
    at = lambda r, i: r[i]["text"]
    read = lambda r: F.struct(T.parse_int(at(r, 0)).alias("number"), F.arrays_zip(r[1]["lines"].alias("name"), r[2]["lines"].alias("party")).alias("pairs"), T.era_date(at(r, 3)).alias("received_at"), T.era_date(at(r, 4)).alias("referred_at"), T.blank_to_null(at(r, 5)).alias("result"))
    x = x.select(*rest, own.alias("own"), F.filter(F.transform(body, read), lambda r: r["number"].isNotNull()).alias("read"))

    def people(r: Column) -> Column:  # days and numbers are read once a row, whatever its people
        named = F.filter(r["pairs"], lambda p: F.coalesce(p["name"], F.lit("")) != "")
        return F.transform(named, lambda p: F.struct(r["number"].alias("number"), T.person_key(p["name"]).alias("name"), T.blank_to_null(p["party"]).alias("party"), r["received_at"].alias("received_at"), r["referred_at"].alias("referred_at"), r["result"].alias("result")))

    accepted, signers = T.parse_int(F.col("own")[3]["text"]), T.parse_int(F.regexp_replace(F.col("own")[5]["text"], "[,，]", ""))
    x = x.select(*rest, accepted.alias("accepted_count"), signers.alias("signer_count"), F.flatten(F.transform("read", people)).alias("presenters"))
    x = x.withColumn("_results", F.filter(F.transform("presenters", lambda p: p["result"]), lambda r: r.isNotNull()))
    ranked = F.transform(F.array_distinct("_results"), lambda r, i: F.struct(F.size(F.filter("_results", lambda y: y == r)).alias("n"), (-i).alias("i"), r.alias("result")))
    return x.select(*rest, "accepted_count", "signer_count", F.array_max(ranked)["result"].alias("outcome"), "presenters")


def summary_row(pages: DataFrame, words: dict[str, str]) -> DataFrame:
    """Numbers in the second row of each table whose header cells hold ``words``; the pages' other columns stay."""
    rest = [c for c in pages.columns if c != "tables"]
    t = pages.select(*rest, F.explode("tables").alias("t")).select(*rest, F.slice("t.rows", 1, 2).alias("rows"))
    return H.role_rows(t, words).select(*rest, *[T.parse_int(F.regexp_replace(F.col(n), "[,，]", "")).alias(n) for n in sorted(set(words.values()))])
