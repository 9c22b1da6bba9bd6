"""JSON parsing, ids and casts on malformed input."""

from pyspark.sql import functions as F

from livetable.functions.ids import id_number, id_text, ids_to_text
from livetable.functions.json import json_fields, parse_json, split_valid
from livetable.functions.timefns import parse_event_line

GOOD = ('{"student_id":"学生ID_8","textbook_id":"教材ID_4","grade_id":"年级ID_2",'
        '"subject_id":"科目ID_5_地理","chapter_id":"章节ID_chapter_9","question_id":"题目ID_77",'
        '"score":4,"answer_time":"2023-06-02 08:15:09","ts":"Jun 2, 2023 8:15:09 AM"}')


def test_parse_answer_message(spark):
    df = spark.createDataFrame([(GOOD,)], "value string")
    r = parse_json(df).first()
    assert r["student_id"] == "学生ID_8" and r["score"] == 4
    assert str(r["ts"]) == "2023-06-02 08:15:09"


def test_malformed_and_missing_fields(spark):
    rows = [(GOOD,), ("{not json",), ('{"student_id":"学生ID_1","question_id":"题目ID_2"}',), (None,)]
    df = spark.createDataFrame(rows, "value string")
    good, bad = split_valid(parse_json(df, raw=True), ["student_id", "question_id"])
    assert good.count() == 2
    assert bad.count() == 2
    missing_score = good.filter(F.col("student_id") == "学生ID_1").first()
    assert missing_score["score"] is None  # null, not 0


def test_json_fields_try_cast(spark):
    rows = [('{"device":"d1","deviceType":"kafka","signal":"abc"}',),
            ('{"device":"d2","deviceType":"kafka","signal":77.5}',),
            ('{"device":"d3"}',)]
    df = spark.createDataFrame(rows, "value string")
    out = json_fields(df, {"device_id": "$.device", "signal": "$.signal"}, types={"signal": "double"})
    got = {r["device_id"]: r["signal"] for r in out.collect()}
    assert got == {"d1": None, "d2": 77.5, "d3": None}


def test_id_number_and_text(spark):
    df = spark.createDataFrame([("学生ID_31",), ("科目ID_2_语文",), ("noid",), ("x_abc",),
                                ("q_ 5",), ("q_5 ",), ("q_5.0",), ("q_+5",), ("q_-5",),
                                ("q_05",), ("q_2147483648",), ("a__5",), ("a_5_",)], "s string")
    got = [r[0] for r in df.select(id_number("s")).collect()]
    # As the JVM's integer parse: no blanks, no decimals, sign allowed, range checked.
    assert got == [31, 2, None, None, None, None, None, 5, -5, 5, None, None, 5]
    assert df.select(id_text("题目ID_", F.lit(5))).first()[0] == "题目ID_5"


def test_ids_to_text_keeps_rank_order(spark):
    df = spark.createDataFrame([(5, [(40, 1.5), (9, 1.25), (300, 0.5)])],
                               "student_id int, recommendations array<struct<question_id:int,rating:float>>")
    assert df.select(ids_to_text("recommendations", "题目ID_")).first()[0] == \
        "题目ID_40,题目ID_9,题目ID_300"


def test_event_line_bad_rows(spark):
    rows = [("2019-10-10 12:00:07,dog",), (" 2019-10-10 12:00:08,owl ",), ("garbage",),
            ("2019-13-45 99:00:00,cat",), ("2019-10-10 12:00:09",),
            # Timestamp.valueOf also takes a fraction and one-digit fields
            ("2019-10-10 12:00:07.25,fox",), ("2019-1-5 2:03:04,elk",),
            ("2019-10-10 12:00,yak",), ("2019-10-10 12:00:07.1234567891,emu",)]
    df = spark.createDataFrame(rows, "value string")
    ts, word = parse_event_line("value")
    got = [(str(r[0]) if r[0] else None, r[1]) for r in df.select(ts, word).collect()]
    assert got == [("2019-10-10 12:00:07", "dog"), ("2019-10-10 12:00:08", "owl"),
                   (None, None), (None, "cat"), ("2019-10-10 12:00:09", None),
                   ("2019-10-10 12:00:07.250000", "fox"), ("2019-01-05 02:03:04", "elk"),
                   (None, "yak"), (None, "emu")]


def test_event_lines_keep_wall_clock_in_any_zone(spark):
    """Times inside both clock changes of a zone stay what the text says."""
    rows = [("2021-03-14 02:30:00,a",), ("2021-03-14 03:30:00,b",), ("2021-11-07 01:30:00,c",)]
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        ts, word = parse_event_line("value")
        got = [(str(r[0]), r[1]) for r in spark.createDataFrame(rows, "value string").select(ts, word).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == [("2021-03-14 02:30:00", "a"), ("2021-03-14 03:30:00", "b"), ("2021-11-07 01:30:00", "c")]
