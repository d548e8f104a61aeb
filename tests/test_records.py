"""Nested records: aliases, unknown fields, kinds; a bad speech drops its meeting only."""

import datetime as dt
import json

from minutesmith.sources import meetings, records

GOOD = {"issueID": "a", "session": 200, "nameOfHouse": "衆議院", "nameOfMeeting": "本会議", "issue": "第1号", "date": "2024-02-18"}


def scanned(spark, tmp_path, *pages):
    for i, p in enumerate(pages):
        (tmp_path / f"{i}.json").write_text(p if isinstance(p, str) else json.dumps(p, ensure_ascii=False, indent=1), encoding="utf-8")
    return meetings.scan_meetings(spark, str(tmp_path))


def reasons(df):
    return sorted((r.pos, r.reason) for r in records.unfit(df).collect())


def test_aliases_at_both_depths(spark, tmp_path):
    by_name = {"issue_id": "b", "session": "201", "name_of_house": "参議院", "name_of_meeting": "委員会", "issue": "第2号", "date": "2024-03-01", "speechRecord": [{"speech_order": 1, "speech": "二"}, {"speechOrder": 2, "createTime": "2024-03-02 10:00:00", "speechURL": "https://x.y/1"}]}
    df = scanned(spark, tmp_path, {"numberOfRecords": 2, "meetingRecord": [GOOD, by_name]})
    got = {r.issue_id: r for r in meetings.meetings(df).collect()}
    assert (got["a"].session, got["a"].name_of_house, got["a"].date) == (200, "衆議院", dt.date(2024, 2, 18)) and got["b"].session == 201
    said = sorted((r.meeting_id, r.n, r.speech_order, r.speech, r.speech_url) for r in meetings.speeches(df).collect())
    assert said == [("b", 0, 1, "二", None), ("b", 1, 2, None, "https://x.y/1")]
    assert reasons(df) == []


def test_faults_drop_their_meeting_only(spark, tmp_path):
    bad = [
        GOOD | {"session": "x"},
        GOOD | {"session": 1.5},
        {k: v for k, v in GOOD.items() if k != "issue"},
        GOOD | {"issue": None},
        GOOD | {"extra": 1},
        GOOD | {"date": "2024-02-30"},
        GOOD | {"issueID": 7},
        GOOD | {"pdfURL": "no address"},
        GOOD | {"speechRecord": [{"speech": "ok"}, {"speechOrder": "one", "mood": "good"}]},
        GOOD | {"speechRecord": "none"},
        GOOD | {"speechRecord": ["text"]},
        "text",
    ]
    df = scanned(spark, tmp_path, {"meetingRecord": [GOOD, *bad, GOOD | {"issueID": "z"}]})
    assert sorted(r.issue_id for r in meetings.meetings(df).collect()) == ["a", "z"]
    assert reasons(df) == [
        (1, "session: int"), (2, "session: int"), (3, "issue: missing"), (4, "issue: missing"), (5, "extra: unknown"), (6, "date: date"), (7, "issue_id: string"), (8, "pdf_url: url"),
        (9, "speech_record[].mood: unknown"), (9, "speech_record[].speech_order: int"), (10, "speech_record: records"), (11, "speech_record[].: record"), (12, ".: record"),
    ]


def test_pages(spark, tmp_path):
    df = scanned(spark, tmp_path, "{ no json", {"numberOfRecords": 0}, {"meetingRecord": {}}, {"meetingRecord": []}, {"meetingRecord": [GOOD]}, '{"meetingRecord": [], "meetingRecord": []}')
    assert meetings.meetings(df).count() == 1
    assert sorted(r.reason for r in records.unfit(df).collect()) == ["page.meetingRecord: records", "page: json", "page: json"]


def test_no_shuffle_and_no_python(spark, tmp_path):
    plan = scanned(spark, tmp_path, {"meetingRecord": [GOOD]})._jdf.queryExecution().toString()
    assert "Exchange" not in plan and "Python" not in plan
