"""Meeting records as the meeting service gives them: pages of JSON with camel-case names and nested speeches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .records import Field, fit, read_pages, scan

# The service's fields, their kinds and the names they get.
SPEECH = (
    Field("speech_id", alias="speechID"),
    Field("issue_id", alias="issueID"),
    Field("image_kind", alias="imageKind"),
    Field("search_object", "int", "searchObject"),
    Field("session", "int"),
    Field("name_of_house", alias="nameOfHouse"),
    Field("name_of_meeting", alias="nameOfMeeting"),
    Field("issue"),
    Field("date", "date"),
    Field("closing"),
    Field("speech_order", "int", "speechOrder"),
    Field("speaker"),
    Field("speaker_yomi", alias="speakerYomi"),
    Field("speaker_group", alias="speakerGroup"),
    Field("speaker_position", alias="speakerPosition"),
    Field("speaker_role", alias="speakerRole"),
    Field("speech"),
    Field("start_page", "int", "startPage"),
    Field("create_time", "timestamp", "createTime"),
    Field("update_time", "timestamp", "updateTime"),
    Field("speech_url", "url", "speechURL"),
)
MEETING = (
    Field("issue_id", alias="issueID", required=True),
    Field("image_kind", alias="imageKind"),
    Field("search_object", "int", "searchObject"),
    Field("session", "int", required=True),
    Field("name_of_house", alias="nameOfHouse", required=True),
    Field("name_of_meeting", alias="nameOfMeeting", required=True),
    Field("issue", required=True),
    Field("date", "date", required=True),
    Field("closing"),
    Field("speech_record", "records", "speechRecord", of=SPEECH),
    Field("meeting_url", "url", "meetingURL"),
    Field("pdf_url", "url", "pdfURL"),
)


def scan_meetings(spark: SparkSession, path: str, whole: bool = True) -> DataFrame:
    """path, pos, record, faults of every meeting in the pages below ``path``: a fault drops its meeting, not its page."""
    return scan(read_pages(spark, path, whole), "meetingRecord", MEETING)


def meetings(scanned: DataFrame) -> DataFrame:
    """The good meetings without their speeches."""
    return fit(scanned).drop("speech_record")


def speeches(scanned: DataFrame) -> DataFrame:
    """The speeches of the good meetings, with the meeting's id and their place; a meeting without any has none."""
    return fit(scanned).select(F.col("issue_id").alias("meeting_id"), F.posexplode("speech_record").alias("n", "s")).select("meeting_id", "n", "s.*")
