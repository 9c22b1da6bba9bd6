"""Inputs of the reference's programs, derived by Spark from the test tables.

The reference reads text lines, IoT JSON, call-log lines, ``timestamp,word``
lines, user-event JSON and student-answer JSON from sockets and Kafka.  Each
function here builds the same message shape from one of the given tables, as
a DataFrame (batch or streaming), so the work grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from livetable import schemas
from livetable.session import shared_dir
from livetable.functions.text import lines_of
from livetable.functions.timefns import epoch_millis
from livetable.operators.recommend import QUESTION_PREFIX, STUDENT_PREFIX
from livetable.operators.ranking import top_items_per_key
from livetable.sources.files import batch_bytes, read_table, stream_table
from livetable.streaming.sinks import start_query, wait_query

# Id prefixes of the other answer fields (textbook, grade,
# subject, chapter), as in the answer messages.
TEXTBOOK_PREFIX = "教材ID_"
GRADE_PREFIX = "年级ID_"
SUBJECT_PREFIX = "科目ID_"
CHAPTER_PREFIX = "章节ID_chapter_"

SECOND_FORMAT = "yyyy-MM-dd HH:mm:ss"
DAY_FORMAT = "yyyy-MM-dd"
HOUR_FORMAT = "yyyy-MM-dd HH:00:00"


def _src(spark: SparkSession, base: str, name: str, stream: bool) -> DataFrame:
    """The fact table a stand-in is built from (spread for per-row work)."""
    if stream:
        return stream_table(spark, base, name, max_bytes_per_trigger=batch_bytes(spark))
    return read_table(spark, base, name, spread=True)


def doc_lines(spark: SparkSession, base: str, stream: bool = False) -> DataFrame:
    """(doc_id, value): one row per ``\\n`` line of every document."""
    docs = _src(spark, base, "documents", stream).select("doc_id", "text")
    return lines_of(docs, "text", "value", keep=["doc_id"])


def doc_pieces(spark: SparkSession, base: str, stream: bool = False) -> DataFrame:
    """(doc_id, value): documents cut at every ``.``; pieces may be empty or
    blank (text after the last full stop, space after a stop)."""
    docs = _src(spark, base, "documents", stream).select("doc_id", "text")
    return docs.select("doc_id", F.explode(F.split("text", r"\.", -1)).alias("value"))


def iot_lines(events: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """IoT JSON: device, deviceType, signal, time (epoch ms)."""
    return events.select(*(keep or []), F.to_json(F.struct(
        F.concat(F.lit("device_"), F.col("event_id").cast("string")).alias("device"),
        F.col("event_type").alias("deviceType"),
        F.col("value").alias("signal"),
        epoch_millis("ts").alias("time"))).alias("value"))


def call_log_line() -> Column:
    """Comma-joined call-log text: station, caller, status, time."""
    return F.concat_ws(
        ",", F.concat(F.lit("station_"), F.col("user_id").cast("string")),
        F.col("event_id").cast("string"), F.col("event_type"),
        F.date_format("ts", SECOND_FORMAT))


def call_log_lines(events: DataFrame) -> DataFrame:
    return events.select(call_log_line().alias("value"))


def event_word_lines(events: DataFrame) -> DataFrame:
    """``yyyy-MM-dd HH:mm:ss,<word>`` lines (the word is the event type)."""
    return events.select(F.concat(F.date_format("ts", SECOND_FORMAT), F.lit(","),
                                  F.col("event_type")).alias("value"))


def user_event_lines(events: DataFrame, fmt: str = DAY_FORMAT) -> DataFrame:
    """User-event JSON with string fields; event time cut to the day (the raw
    triple never repeats, the day form does)."""
    return events.select(F.to_json(F.struct(
        F.date_format("ts", fmt).alias("eventTime"),
        F.col("event_type").alias("eventType"),
        F.col("user_id").cast("string").alias("userID"))).alias("value"))


def _answer_dims(spark: SparkSession, base: str) -> tuple[DataFrame, DataFrame]:
    orders = read_table(spark, base, "orders").select("o_orderkey", "o_custkey",
                                                      "o_orderdate", "o_orderpriority")
    part = read_table(spark, base, "part").select("p_partkey", "p_brand", "p_type")
    return orders, part


def _answers_of(li: DataFrame, orders: DataFrame, part: DataFrame) -> DataFrame:
    j = (li.select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
         .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
         .join(part, F.col("l_partkey") == F.col("p_partkey")))
    return j.select(
        F.concat(F.lit(STUDENT_PREFIX), F.col("o_custkey").cast("string")).alias("student_id"),
        F.concat(F.lit(TEXTBOOK_PREFIX), F.col("p_type")).alias("textbook_id"),
        F.concat(F.lit(GRADE_PREFIX), F.substring("o_orderpriority", 1, 1)).alias("grade_id"),
        F.concat(F.lit(SUBJECT_PREFIX), F.col("p_brand")).alias("subject_id"),
        F.concat(F.lit(CHAPTER_PREFIX), F.col("l_linenumber").cast("string")).alias("chapter_id"),
        F.concat(F.lit(QUESTION_PREFIX), F.col("l_partkey").cast("string")).alias("question_id"),
        (F.floor("l_quantity").cast("int") % 11).alias("score"),
        F.date_format("o_orderdate", SECOND_FORMAT).alias("answer_time"),
        F.col("o_orderdate").alias("ts"))


def answers(spark: SparkSession, base: str, stream: bool = False) -> DataFrame:
    """Student answers: lineitem joined to its order and part.

    customer -> student, part -> question, brand -> subject (a function of the
    part, as subject is of the question), order priority -> grade, line number
    -> chapter, quantity mod 11 -> score, order date -> answer time.
    Column order and types are those of ``schemas.ANSWER``.

    ``stream=True``: the rows there are now, as a live topic (see
    :func:`start_answer_topic`).
    """
    if not stream:
        return _answers_of(_src(spark, base, "lineitem", False), *_answer_dims(spark, base))
    topic, q = start_answer_topic(spark, base, trigger={"availableNow": True})
    wait_query(q)
    return read_answer_topic(spark, base, topic)


def start_answer_topic(spark: SparkSession, base: str, root: str | None = None,
                       trigger: dict | None = None, max_files: int | None = None):
    """Start the query that feeds the answer topic; returns (topic folder, query).

    A stateless stream joins ``lineitem`` with orders and part and appends finished
    answers to the folder, at every size of the tables: AQE plans each micro-batch (join
    choice, skew split), and stateful statistics read the folder without a join of
    their own.  Rows that arrive in ``lineitem`` later reach the topic with the next
    micro-batch.  ``root`` keeps topic and checkpoint across restarts.
    """
    root = root or shared_dir(spark, "topics", "answers", unique=True)
    orders, part = _answer_dims(spark, base)
    li = stream_table(spark, base, "lineitem", max_files_per_trigger=max_files,
                      max_bytes_per_trigger=None if max_files else batch_bytes(spark))
    q = start_query(_answers_of(li, orders, part), "parquet", f"{root}/checkpoint", "append",
                    path=f"{root}/topic", trigger=trigger)
    return f"{root}/topic", q


def read_answer_topic(spark: SparkSession, base: str, topic: str,
                      max_bytes: int | None = None) -> DataFrame:
    """The answer topic as a stream."""
    schema = _answers_of(read_table(spark, base, "lineitem"), *_answer_dims(spark, base)).schema
    return (spark.readStream.schema(schema)
            .option("maxBytesPerTrigger", str(max_bytes or batch_bytes(spark))).parquet(topic))


def answer_json_lines(ans: DataFrame) -> DataFrame:
    """Answers as JSON text, ``ts`` written as ``MMM d, yyyy h:mm:ss a``."""
    cols = [c for c in ans.columns if c != "ts"]
    return ans.select(F.to_json(F.struct(
        *cols, F.date_format("ts", schemas.ANSWER_TS_FORMAT).alias("ts"))).alias("value"))


def fixed_recs(spark: SparkSession, base: str, k: int = 3) -> DataFrame:
    """Recommendation table of the ``RECS`` shape without a model: per
    customer the k parts with the largest total quantity (ties: smaller part),
    rating = that total.  Lets the join/format steps be checked exactly."""
    li = read_table(spark, base, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    orders = read_table(spark, base, "orders").select("o_orderkey", "o_custkey")
    j = li.join(orders, li.l_orderkey == orders.o_orderkey)
    top = top_items_per_key(j, "o_custkey", "l_partkey", "l_quantity", k=k)
    # At most k rows per customer reach collect_list.
    grouped = top.groupBy("o_custkey").agg(F.sort_array(F.collect_list(F.struct(
        F.col("rank"), F.col("l_partkey").cast("int").alias("question_id"),
        F.col("total").cast("float").alias("rating")))).alias("r"))
    return grouped.select(
        F.col("o_custkey").cast("int").alias("student_id"),
        F.transform("r", lambda x: F.struct(x["question_id"].alias("question_id"),
                                            x["rating"].alias("rating"))).alias("recommendations"))
