"""Declared schemas.  Streaming file sources need an explicit schema, and
declared schemas keep JSON parsing free of inference passes."""

from pyspark.sql.types import (ArrayType, BinaryType, DoubleType, FloatType, IntegerType,
                               LongType, StringType, StructField, StructType,
                               TimestampNTZType, TimestampType)


def _s(*fields):
    return StructType([StructField(n, t, True) for n, t in fields])


LINE = _s(("value", StringType()))
RATE = _s(("timestamp", TimestampType()), ("value", LongType()))
PERSON_HOBBY = _s(("name", StringType()), ("age", IntegerType()), ("hobby", StringType()))
IOT = _s(("device", StringType()), ("deviceType", StringType()),
         ("signal", DoubleType()), ("time", LongType()))
STATION_LOG = _s(("stationId", StringType()), ("callOut", StringType()),
                 ("callIn", StringType()), ("callStatus", StringType()),
                 ("callTime", LongType()), ("duration", LongType()))
EVENT_WORD = _s(("timestamp", TimestampNTZType()), ("word", StringType()))
USER_EVENT = _s(("eventTime", StringType()), ("eventType", StringType()),
                ("userID", StringType()))
# Student answer; ``ts`` is text such as "Jan 9, 2021 2:53:28 PM".
ANSWER = _s(("student_id", StringType()), ("textbook_id", StringType()),
            ("grade_id", StringType()), ("subject_id", StringType()),
            ("chapter_id", StringType()), ("question_id", StringType()),
            ("score", IntegerType()), ("answer_time", StringType()),
            ("ts", TimestampNTZType()))
RATING = _s(("student_id", LongType()), ("question_id", LongType()),
            ("rating", FloatType()))
ANSWER_RECS = StructType(ANSWER.fields + [StructField("recommendations", StringType(), True)])
RECS = StructType([
    StructField("student_id", IntegerType(), False),
    StructField("recommendations", ArrayType(StructType([
        StructField("question_id", IntegerType(), True),
        StructField("rating", FloatType(), True)])), True)])
KAFKA = StructType([
    StructField("key", BinaryType(), True),
    StructField("value", BinaryType(), True),
    StructField("topic", StringType(), True),
    StructField("partition", IntegerType(), True),
    StructField("offset", LongType(), True),
    StructField("timestamp", TimestampType(), True),
    StructField("timestampType", IntegerType(), True)])

# Text format of the answer ``ts`` field (US locale, 12-hour clock).
ANSWER_TS_FORMAT = "MMM d, yyyy h:mm:ss a"
