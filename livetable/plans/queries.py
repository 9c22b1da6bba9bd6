"""Keyed queries over the driver's tables: ``name -> f(spark, base_dir)``.

Streaming keys run the operator on ``readStream`` with an ``availableNow``
trigger into a sink under the shared folder and return the sink's table;
batch keys return the lazy DataFrame.  Every key reads whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from livetable import session
from livetable.functions.ids import id_number
from livetable.functions.json import json_fields, parse_json
from livetable.functions.text import contains_text, lines_of, nonblank, split_words
from livetable.functions.timefns import from_utc_micros, parse_event_line, to_utc_instant
from livetable.operators import aggregate as agg
from livetable.operators import published
from livetable.operators import recommend as rec
from livetable.operators.integrity import missing_id_xor, missing_ids, missing_ids_by_range
from livetable.operators.joins import attach
from livetable.operators.products import top_products
from livetable.operators.ranking import lowest_items_per_key
from livetable.operators.registry import latest_per_key
from livetable.operators.split import hash_bucket, hash_split
from livetable.plans import apps
from livetable.plans import standins as st
from livetable.sources.files import batch_bytes, read_delimited, read_json_lines, read_table, table_path
from livetable.sources.kafka import kafka_rows, kafka_value
from livetable.sources.topic import append_topic, read_topic
from livetable.streaming.committed import committed_sink, read_committed
from livetable.streaming.eventtime import (dedup_counts, dedup_within, run_in_time_order,
                                           windowed_count)
from livetable.streaming.late import final_windows, late_rows, open_windows, start_windows_with_late
from livetable.streaming.state import counts_in_state
from livetable.streaming.joins import read_join_output, start_stream_static_join
from livetable.streaming.sinks import (foreach_batch_outputs, latest_updates, read_snapshot,
                                       run_available_now, snapshot_path_writer, start_query, updates_path_writer,
                                       wait_query)
from livetable.streaming.sinks import _fs

# Parameters of the event-time keys (window length, slide, watermark delay).
WINDOW_LENGTH = "1 hour"
WINDOW_SLIDE = "30 minutes"
WATERMARK = "10 minutes"
# Answers from this time on wait for the second model (key ``serve_published``).
SECOND_MODEL_FROM = "1998-06-01 00:00:00"


def _run_dir(spark: SparkSession, name: str) -> str:
    return session.shared_dir(spark, "runs", name, unique=True)


def _stream_to(spark: SparkSession, name: str, df: DataFrame, sink: str,
               mode: str) -> str:
    d = _run_dir(spark, name)
    run_available_now(df, sink, f"{d}/checkpoint", mode, path=f"{d}/out")
    return f"{d}/out"


# --- text lines and words -------------------------------------------------

def words(spark, base, stream=False) -> DataFrame:
    return split_words(st.doc_lines(spark, base, stream), "value", "word")


def q_wordcount_dsl(spark, base):
    counts = agg.count_by(words(spark, base), "word", "count")
    return counts.orderBy(F.desc("count"), F.asc("word"))


def q_wordcount_sql(spark, base):
    """Word count as SQL over a streaming temp view, complete mode, sorted."""
    d = _run_dir(spark, "wordcount_sql")
    view = "t_words_" + d.rsplit("/", 1)[-1]
    split_words(st.doc_lines(spark, base, stream=True), "value", "value") \
        .createOrReplaceTempView(view)
    counts = spark.sql(f"""
        SELECT value, COUNT(*) AS counts
        FROM {view}
        GROUP BY value
        ORDER BY counts DESC, value""")
    run_available_now(counts, "snapshot", f"{d}/checkpoint", "complete", path=f"{d}/out")
    return read_snapshot(spark, f"{d}/out")


def q_wordcount_stream_memory(spark, base):
    """Streaming word count by the document's language, complete mode, in a memory
    table (a driver-held table: the result is a row per language)."""
    docs = st._src(spark, base, "documents", stream=True).select("lang", "text")
    words_ = split_words(lines_of(docs, "text", "value", keep=["lang"]), "value", "word", keep=["lang"])
    d = _run_dir(spark, "wordcount_stream_memory")
    name = "t_result_" + d.rsplit("/", 1)[-1]
    run_available_now(agg.count_by(words_, "lang", "count"), "memory", f"{d}/checkpoint", "complete",
                      query_name=name)
    return spark.table(name)


def _foreach_batch(spark, base, name: str) -> str:
    """Streaming word count; one foreachBatch writes the counts and how many words
    have each count, both from one persisted batch."""
    counts = agg.count_by(words(spark, base, stream=True), "word", "count")
    d = _run_dir(spark, name)
    write_full, write_sizes = snapshot_path_writer(f"{d}/full"), snapshot_path_writer(f"{d}/sizes")

    def sizes(batch, batch_id):
        write_sizes(batch.groupBy("count").agg(F.count(F.lit(1)).alias("words")), batch_id)

    fn = foreach_batch_outputs([write_full, sizes], skip_empty=False)
    run_available_now(counts, "foreach_batch", f"{d}/checkpoint", "complete", batch_fn=fn)
    return d


def q_foreach_batch_snapshot(spark, base):
    return read_snapshot(spark, _foreach_batch(spark, base, "foreach_batch_snapshot") + "/full")


def q_foreach_batch_second_output(spark, base):
    return read_snapshot(spark, _foreach_batch(spark, base, "foreach_batch_second_output") + "/sizes")


def q_split_words_append(spark, base):
    w = split_words(st.doc_lines(spark, base, stream=True), "value", "word", keep=["doc_id"])
    return spark.read.parquet(_stream_to(spark, "split_words_append", w, "parquet", "append"))


def q_nonblank_filter(spark, base):
    return nonblank(st.doc_pieces(spark, base), "value")


# --- JSON, IoT, call logs ---------------------------------------------------

def iot(spark, base, stream=False) -> DataFrame:
    ev = st._src(spark, base, "events", stream)
    lines = nonblank(st.iot_lines(ev), "value")
    return json_fields(lines, apps.IOT_FIELDS, "value", apps.IOT_TYPES)


def q_json_extract_fields(spark, base):
    return iot(spark, base)


def q_iot_stats_sql(spark, base):
    iot(spark, base).createOrReplaceTempView("signals")
    return spark.sql("""
        SELECT deviceType, COUNT(*) AS counts, ROUND(AVG(signal), 6) AS mean_signal
        FROM signals
        WHERE signal > 30
        GROUP BY deviceType""")


def q_iot_stats_stream(spark, base):
    """The live form: complete mode, a snapshot for each batch."""
    stats = agg.filtered_stats(iot(spark, base, stream=True), F.col("signal") > 30, "deviceType",
                               "signal", count_col="device_id", avg_name="mean_signal")
    return read_snapshot(spark, _stream_to(spark, "iot_stats_stream", stats, "snapshot", "complete"))


def q_iot_stats_dsl(spark, base):
    return agg.filtered_stats(iot(spark, base), F.col("signal") > 30, "deviceType",
                              "signal", count_col="device_id", avg_name="mean_signal")


def q_etl_contains_filter(spark, base):
    """Kafka-shaped records -> text -> lines containing "error" -> sink."""
    ev = st._src(spark, base, "events", stream=True)
    records = kafka_rows(ev, st.call_log_line(), "stationTopic", F.col("event_id"),
                         to_utc_instant("ts"))
    out = contains_text(kafka_value(records), "error")
    return spark.read.parquet(_stream_to(spark, "etl_contains_filter", out, "parquet", "append"))


def _broken(lines: DataFrame, key: str) -> DataFrame:
    """The lines, every fifth (by ``key``) cut in the middle, as a broken feed has them."""
    return lines.select(F.when(F.col(key) % 5 == 0, F.expr("substring(value, 1, 12)"))
                        .otherwise(F.col("value")).alias("value"))


def parse_with_quarantine(spark, lines: DataFrame, parse, required: list[str], name: str) -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantined lines) of ``lines``; both outputs are written from one
    parse of the input."""
    d = _run_dir(spark, name)
    ok = F.lit(True)
    for c in required:
        ok = ok & F.col(c).isNotNull()
    with session.open_writers(spark, 2):
        parse(lines).withColumn("ok", ok).write.partitionBy("ok").parquet(d)
    rows = spark.read.schema(parse(lines).withColumn("ok", F.lit(True)).schema).parquet(d)
    return rows.filter("ok").drop("ok", "_raw"), rows.filter("not ok").select(F.col("_raw").alias("value"))


def parse_event_rows(lines: DataFrame) -> DataFrame:
    ts, word = parse_event_line("value")
    return lines.select(F.col("value").alias("_raw"), ts.alias("timestamp"), word.alias("word"))


def _event_lines(spark, base) -> tuple[DataFrame, DataFrame]:
    lines = st.event_word_lines(read_table(spark, base, "events"))
    return parse_with_quarantine(spark, lines, parse_event_rows, ["timestamp", "word"], "event_line_parse")


def q_event_line_parse(spark, base):
    return _event_lines(spark, base)[0]


def q_event_line_quarantine(spark, base):
    """Lines that cannot be parsed, from a feed in which every fifth line is cut."""
    ev = read_table(spark, base, "events")
    lines = _broken(ev.select("event_id", F.concat(F.date_format("ts", st.SECOND_FORMAT), F.lit(","),
                                                   F.col("event_type")).alias("value")), "event_id")
    return parse_with_quarantine(spark, lines, parse_event_rows, ["timestamp", "word"], "event_line_quarantine")[1]


def _answer_rows(spark, base) -> tuple[DataFrame, DataFrame]:
    lines = st.answer_json_lines(st.answers(spark, base))
    return parse_with_quarantine(spark, lines, lambda x: parse_json(x, raw=True), ["student_id", "question_id"],
                                 "json_struct_parse")


def q_json_struct_parse(spark, base):
    return _answer_rows(spark, base)[0]


def q_json_quarantine(spark, base):
    """IoT messages that cannot be parsed, from a feed in which every fifth is cut."""
    ev = read_table(spark, base, "events")
    lines = st.iot_lines(ev, keep=["event_id"])
    schema = "device string, deviceType string, signal double, time bigint"
    return parse_with_quarantine(spark, _broken(lines, "event_id"), lambda x: parse_json(x, T.StructType.fromDDL(schema), raw=True),
                                 ["device", "signal"], "json_quarantine")[1]


def q_json_lines_batch_read(spark, base):
    """Answers written as JSON-lines files, read back with the declared schema."""
    d = _run_dir(spark, "json_lines_batch_read")
    st.answer_json_lines(st.answers(spark, base)).write.mode("overwrite").text(f"{d}/in")
    return read_json_lines(spark, f"{d}/in")


def q_delimited_stream_read(spark, base):
    """A table written as ';'-separated text without header, streamed back
    with an explicit schema."""
    d = _run_dir(spark, "delimited_stream_read")
    cust = read_table(spark, base, "customer")
    cust.write.mode("overwrite").option("sep", ";").option("header", "false").csv(f"{d}/in")
    s = read_delimited(spark, f"{d}/in", cust.schema, sep=";", stream=True,
                       max_bytes_per_trigger=batch_bytes(spark))
    run_available_now(s, "parquet", f"{d}/checkpoint", "append", path=f"{d}/out")
    return spark.read.parquet(f"{d}/out")


# --- answers: aggregates and top-k -------------------------------------------

def q_top10_questions(spark, base):
    c = agg.count_by(st.answers(spark, base), "question_id", "count")
    return agg.top_n(c, [F.desc("count"), F.asc("question_id")], 10)


def q_top10_grades(spark, base):
    c = agg.count_by(st.answers(spark, base), "grade_id", "count")
    return agg.top_n(c, [F.desc("count"), F.asc("grade_id")], 10)


def q_top10_questions_with_subject(spark, base):
    return agg.top_n_with_attr(st.answers(spark, base), "question_id", "subject_id", 10)


def q_lowest_score_students(spark, base):
    return agg.lowest_by(st.answers(spark, base), "student_id", "score", "question_id", 10)


def q_lowest_questions_per_student(spark, base):
    return lowest_items_per_key(st.answers(spark, base), "student_id", "question_id",
                                "score", k=10)


def _live_statistic(spark, base, statistic: str) -> DataFrame:
    """One of the four answer statistics as a live query: complete mode, snapshot sink."""
    top = apps.answer_statistics(st.answers(spark, base, stream=True))[statistic]
    return read_snapshot(spark, _stream_to(spark, f"{statistic}_stream", top, "snapshot", "complete"))


def q_top10_questions_stream(spark, base):
    return _live_statistic(spark, base, "top10_questions")


def q_top10_grades_stream(spark, base):
    return _live_statistic(spark, base, "top10_grades")


def q_top10_questions_with_subject_stream(spark, base):
    return _live_statistic(spark, base, "top10_questions_with_subject")


def q_lowest_score_students_stream(spark, base):
    return _live_statistic(spark, base, "lowest_score_students")


# --- event time -----------------------------------------------------------

def event_words(spark, base, stream=False) -> DataFrame:
    lines = st.event_word_lines(st._src(spark, base, "events", stream))
    ts, word = parse_event_line("value")
    return lines.select(ts.alias("timestamp"), word.alias("word")) \
        .filter(F.col("timestamp").isNotNull())


def _sliding(spark, base, stream=True, watermark: str | None = None):
    """Sliding counts.  Files of a table are in no time order, so the complete and
    update forms set no watermark (state: a row for each window and word); a feed whose
    disorder is bounded passes that bound."""
    return windowed_count(event_words(spark, base, stream), "timestamp", "word",
                          WINDOW_LENGTH, WINDOW_SLIDE, watermark)


def slices_of(spark, base, name: str) -> int:
    """Time slices in which a table is replayed: each about one micro-batch."""
    path, fs = _fs(spark, table_path(base, name))
    return max(1, -(-fs.getContentSummary(path).getLength() // batch_bytes(spark)))


def q_window_sliding_complete(spark, base):
    return read_snapshot(spark, _stream_to(spark, "window_sliding_complete",
                                           _sliding(spark, base), "snapshot", "complete"))


def q_window_sliding_update(spark, base):
    path = _stream_to(spark, "window_sliding_update", _sliding(spark, base),
                      "updates", "update")
    return latest_updates(spark, path, ["window_start", "window_end", "word"], ["count"])


def q_window_sliding_append(spark, base, slices: int | None = None):
    """Final windows in append mode: the table replayed in event-time order, so that the
    watermark drops nothing."""
    d = _run_dir(spark, "window_sliding_append")
    ev = read_table(spark, base, "events").select("ts", "event_type")

    def run(stream):
        lines = st.event_word_lines(stream)
        ts, word = parse_event_line("value")
        rows = lines.select(ts.alias("timestamp"), word.alias("word")).filter(F.col("timestamp").isNotNull())
        counts = windowed_count(rows, "timestamp", "word", WINDOW_LENGTH, WINDOW_SLIDE, WATERMARK)
        return run_available_now(counts, "parquet", f"{d}/checkpoint", "append", path=f"{d}/out")

    run_in_time_order(spark, ev, "ts", f"{d}/in", slices or slices_of(spark, base, "events"), run)
    return spark.read.parquet(f"{d}/out")


def q_window_tumbling_daily(spark, base):
    return windowed_count(event_words(spark, base), "timestamp", "word", "1 day")


def q_window_tumbling_daily_stream(spark, base):
    """Counts per event day on a stream, whatever the arrival order: tumbling
    one-day windows without a watermark (state: a row for each day and word), update
    mode, newest value per key."""
    counts = windowed_count(event_words(spark, base, stream=True), "timestamp", "word", "1 day")
    path = _stream_to(spark, "window_tumbling_daily_stream", counts, "updates", "update")
    return latest_updates(spark, path, ["window_start", "window_end", "word"], ["count"])


def user_events(spark, base, stream=False) -> DataFrame:
    lines = nonblank(st.user_event_lines(st._src(spark, base, "events", stream)), "value")
    return json_fields(lines, apps.USER_EVENT_FIELDS)


def q_dedup_user_counts(spark, base):
    res = dedup_counts(user_events(spark, base, stream=True),
                       ["userID", "eventTime", "eventType"], "userID")
    return read_snapshot(spark, _stream_to(spark, "dedup_user_counts", res,
                                           "snapshot", "complete"))


def q_dedup_user_counts_staged(spark, base):
    """Same result as ``dedup_user_counts``; copies are collapsed per
    micro-batch by a batch aggregate before the stateful de-duplication."""
    from livetable.streaming.dedup import read_batch_distinct, start_batch_distinct
    keys = ["userID", "eventTime", "eventType"]
    d = _run_dir(spark, "dedup_user_counts_staged")
    ue = user_events(spark, base, stream=True)
    start_batch_distinct(ue, keys, f"{d}/distinct", f"{d}/checkpoint1",
                         trigger={"availableNow": True}).awaitTermination()
    stage2 = dedup_counts(read_batch_distinct(spark, f"{d}/distinct", ue, keys), keys, "userID")
    run_available_now(stage2, "snapshot", f"{d}/checkpoint2", "complete", path=f"{d}/out")
    return read_snapshot(spark, f"{d}/out")


def q_dedup_within_watermark(spark, base, slices: int | None = None):
    """User events (event time cut to the hour) de-duplicated on user, time and type
    with bounded state, replayed in event-time order."""
    d = _run_dir(spark, "dedup_within_watermark")
    ev = read_table(spark, base, "events").select("ts", "user_id", "event_type")
    keys = ["userID", "eventTime", "eventType"]

    def run(stream):
        ue = json_fields(st.user_event_lines(stream, st.HOUR_FORMAT), dict(apps.USER_EVENT_FIELDS))
        at, _ = parse_event_line(F.concat(F.col("eventTime"), F.lit(",")))
        res = dedup_within(ue.withColumn("at", at), "at", keys, WATERMARK)
        return run_available_now(res, "parquet", f"{d}/checkpoint", "append", path=f"{d}/out")

    run_in_time_order(spark, ev, "ts", f"{d}/in", slices or slices_of(spark, base, "events"), run)
    return spark.read.parquet(f"{d}/out")


# --- ids, ratings, splits ------------------------------------------------------

def q_id_to_number(spark, base):
    a = st.answers(spark, base)
    return a.select("student_id", id_number("student_id").alias("student_num"),
                    "question_id", id_number("question_id").alias("question_num"))


def q_rating_bucket(spark, base):
    a = st.answers(spark, base).filter(F.col("score").isNotNull())
    return a.groupBy("score").agg(F.first(rec.rating_weight("score")).alias("rating"),
                                  F.count(F.lit(1)).alias("n"))


def q_ratings_extract(spark, base):
    return rec.extract_ratings(st.answers(spark, base))


def q_rmse_aggregate(spark, base):
    r = rec.extract_ratings(st.answers(spark, base))
    return agg.rmse_vs_group_mean(r, "question_id", "rating", digits=6)


def q_rmse_predictions(spark, base):
    """RMSE of a prediction (a line through the score) against the rating."""
    a = st.answers(spark, base).select(rec.rating_weight("score").alias("rating"),
                                       (F.lit(3.0) - F.col("score") / 5.0).alias("prediction"))
    return agg.rmse(a, "rating", "prediction", digits=6)


def q_hash_split_counts(spark, base):
    r = rec.extract_ratings(st.answers(spark, base))
    b = hash_bucket("student_id", "question_id", buckets=10, seed=rec.SPLIT_SEED)
    return (r.select(F.when(b < 8, "train").otherwise("test").alias("split"))
            .groupBy("split").agg(F.count(F.lit(1)).alias("n")))


# --- recommendations: formatting, joins, registry -----------------------------

def recs_text(spark, base) -> DataFrame:
    return rec.recs_to_text(st.fixed_recs(spark, base))


def q_recs_to_string(spark, base):
    return recs_text(spark, base)


def q_answers_join_recs(spark, base):
    return attach(st.answers(spark, base), recs_text(spark, base), "student_id")


def q_serve_batches(spark, base, batches: int = 3):
    """The serving path: answers in several micro-batches -> recommendations of their
    students -> text -> joined -> appended by batch."""
    d = _run_dir(spark, "serve_batches")
    st.fixed_recs(spark, base).write.parquet(f"{d}/recs")
    recs = spark.read.parquet(f"{d}/recs")
    topic, q = st.start_answer_topic(spark, base, f"{d}/answers", {"availableNow": True})
    wait_query(q)
    path, fs = _fs(spark, topic)
    size = -(-fs.getContentSummary(path).getLength() // batches)
    answers = st.read_answer_topic(spark, base, topic, max_bytes=min(size, batch_bytes(spark)))

    def recommender(students):
        return recs.join(students.distinct(), "student_id", "left_semi")

    fn = rec.serve_batch(recommender, updates_path_writer(f"{d}/served"))
    run_available_now(answers, "foreach_batch", f"{d}/checkpoint", "append", batch_fn=fn)
    return spark.read.parquet(f"{d}/served").drop("batch_id")


def q_serve_published(spark, base):
    """Train, gate, publish and serve as one run: a model of the answers before the middle
    of their time serves these, then one of all answers is published and the same query,
    restarted, serves the rest.  Each answer with the version that served it."""
    d = _run_dir(spark, "serve_published")
    answers = st.answers(spark, base).withColumn("early", F.coalesce(F.col("ts") < F.lit(SECOND_MODEL_FROM).cast("timestamp_ntz"), F.lit(False)))
    with session.open_writers(spark, 2):
        answers.write.partitionBy("early").parquet(f"{d}/answers")
    parts = [spark.read.parquet(f"{d}/answers/early={e}") for e in ("true", "false")]
    schema = parts[0].schema
    fn = published.serve_versioned(spark, f"{d}/registry", updates_path_writer(f"{d}/served"))
    for number, known in enumerate((parts[0], parts[0].unionByName(parts[1])), 1):
        published.train_and_publish(spark, rec.extract_ratings(known), f"{d}/models/{number}", f"{d}/registry")
        # The files of the second half reach the stream's glob only once its model is there.
        folder = f"{d}/answers/early={'{true,false}' if number == 2 else 'true'}"
        stream = spark.readStream.schema(schema).option("maxBytesPerTrigger", str(batch_bytes(spark))).parquet(folder)
        run_available_now(stream, "foreach_batch", f"{d}/checkpoint", "append", batch_fn=fn)
    served = spark.read.parquet(f"{d}/served")
    return served.select("student_id", "question_id", "answer_time", "score", F.col("model_version").cast("long"),
                         F.size(F.split("recommendations", ",")).cast("long").alias("n_recs"))


def q_stream_static_join(spark, base):
    """Answers as a stream joined with a static recommendation table (AQE plans each
    micro-batch)."""
    recs_path = _run_dir(spark, "stream_static_recs")
    recs_text(spark, base).write.mode("overwrite").parquet(recs_path)
    recs = spark.read.parquet(recs_path)
    d = _run_dir(spark, "stream_static_join")
    wait_query(start_stream_static_join(
        st.answers(spark, base, stream=True), recs, "student_id", f"{d}/out",
        f"{d}/checkpoint", trigger={"availableNow": True}))
    return read_join_output(spark, f"{d}/out")


def q_registry_latest(spark, base):
    """Newest entry per (model, item) of a registry built from ``orders``:
    each order is one publication (status -> model, priority -> item, order
    key -> path, order date -> time)."""
    o = read_table(spark, base, "orders")
    registry = o.select(F.concat(F.lit("model_"), F.col("o_orderstatus")).alias("model"),
                        F.col("o_orderpriority").alias("item"),
                        F.concat(F.lit("models/"), F.col("o_orderkey").cast("string")).alias("path"),
                        F.col("o_totalprice").alias("rmse"),
                        F.col("o_orderdate").alias("created_at"))
    return latest_per_key(registry, ["model", "item"], "created_at", "path", extra=["rmse"])


# --- ALS: what any model must give (which rows are scored, list lengths and order);
# the numbers themselves have no SQL form and are unit-tested ------------------------

def _als_table(spark, base, name: str, result, *keep: str) -> DataFrame:
    """Train on the 80% split and write ``result(model, numbers, test)`` as a
    table.  ``numbers``, the answers as :func:`recommend.number_answers` gives them with the
    columns ``keep``, come from a three-table join: they are persisted for all that reads
    them, on disk, and released once the table is written."""
    numbers = rec.number_answers(st.answers(spark, base), *keep).persist(StorageLevel.DISK_ONLY)
    d = _run_dir(spark, name)
    try:
        train, test = hash_split(rec.rated(numbers), ["student_id", "question_id"], 8, 10, rec.SPLIT_SEED)
        model = rec.train(train)
        result(model, numbers, test).write.parquet(d)
    finally:
        numbers.unpersist()
    return spark.read.parquet(d)


def _list_shape(recs: DataFrame) -> DataFrame:
    """Per student: length of the list, whether ratings fall and questions differ."""
    r = F.col("recommendations")
    ratings, items = F.transform(r, lambda x: x["rating"]), F.transform(r, lambda x: x["question_id"])
    falls = F.sort_array(ratings, asc=False) == ratings
    return recs.select(F.col("student_id").cast("long").alias("student_id"), F.size(r).cast("long").alias("n"),
                       falls.alias("descending"), (F.size(F.array_distinct(items)) == F.size(r)).alias("distinct_items"))


def q_als_predict(spark, base):
    """The held-out ratings that are scored: cold-start rows are dropped."""
    return _als_table(spark, base, "als_predict", lambda m, n, te: rec.predict(m, te).select(
        F.col("student_id").cast("long").alias("student_id"), F.col("question_id").cast("long").alias("question_id"),
        "rating", (F.col("prediction").isNotNull() & ~F.isnan("prediction")).alias("scored")))


def q_als_recommend_all(spark, base):
    return _als_table(spark, base, "als_recommend_all",
                      lambda m, n, te: _list_shape(rec.recommend_all(m, rec.TOP_ALL)))


def q_als_recommend_subset(spark, base):
    """Lists for the students of one micro-batch: the answers of the newest day."""
    def result(model, numbers, test):
        day = F.to_date("ts")
        newest = numbers.agg(F.max(day).alias("day")).first()["day"]
        students = numbers.filter(day == F.lit(newest)).select("student_id")
        return _list_shape(rec.recommend_subset(model, students, rec.TOP_SUBSET))
    return _als_table(spark, base, "als_recommend_subset", result, "ts")


# --- missing ids ----------------------------------------------------------------

def q_missing_id_xor(spark, base):
    return missing_id_xor(read_table(spark, base, "labels"), "doc_id")


def q_missing_ids_anti(spark, base):
    labels = read_table(spark, base, "labels")
    b = labels.agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).first()
    if b["lo"] is None:
        return spark.range(0).withColumnRenamed("id", "missing_id")
    return missing_ids(spark, labels, "doc_id", int(b["lo"]), int(b["hi"]))


def q_missing_ids_ranges(spark, base):
    """The same ids through bitmaps of ranges; no id is shuffled."""
    labels = read_table(spark, base, "labels")
    b = labels.agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).first()
    if b["lo"] is None:
        return spark.range(0).withColumnRenamed("id", "missing_id")
    return missing_ids_by_range(spark, labels, "doc_id", int(b["lo"]), int(b["hi"]))


# --- topics with offsets, committed sinks, state, late rows -----------------------

def q_topic_replay(spark, base, batches: int = 4):
    """Events as a topic of four partitions, read in micro-batches of bounded offsets;
    the second half is appended after the first query ended, and a new query goes on at
    the checkpoint's offsets."""
    d = _run_dir(spark, "topic_replay")
    ev = read_table(spark, base, "events")
    b = ev.agg(F.min("event_id").alias("lo"), F.max("event_id").alias("hi")).first()
    middle = (b["lo"] + b["hi"]) // 2 if b["lo"] is not None else 0
    rows = kafka_rows(ev, st.call_log_line(), "stationTopic", F.col("event_id"), to_utc_instant("ts"))
    size = max(4, ((b["hi"] or 0) - (b["lo"] or 0) + 1) // batches)
    for part in (F.col("offset") <= middle, F.col("offset") > middle):
        append_topic(rows.filter(part), f"{d}/topic")
        q = start_query(read_topic(spark, f"{d}/topic", size, f"{d}/position"), "parquet", f"{d}/checkpoint", path=f"{d}/out")
        try:
            q.processAllAvailable()
        finally:
            q.stop()
    return spark.read.parquet(f"{d}/out").select("partition", "offset", F.col("value").cast("string").alias("value"),
                                                 from_utc_micros("timestamp").alias("timestamp"))


def q_two_phase_sink(spark, base):
    """Events through the sink with a commit for each micro-batch."""
    d = _run_dir(spark, "two_phase_sink")
    ev = st._src(spark, base, "events", stream=True).select("event_id", "user_id", "event_type", "value")
    run_available_now(ev, committed_sink(spark), f"{d}/checkpoint", path=f"{d}/out")
    return read_committed(spark, f"{d}/out", ev.schema)


def q_wordcount_state(spark, base):
    """The streaming word count, read from its state in the checkpoint."""
    d = _run_dir(spark, "wordcount_state")
    counts = agg.count_by(words(spark, base, stream=True), "word", "count")
    run_available_now(counts, "noop", f"{d}/checkpoint", "update")
    return counts_in_state(spark, f"{d}/checkpoint", "word")


#: Every event whose number leaves this remainder comes last in the late-row feed.
DELAYED = 50, 7


def q_windows_with_late_rows(spark, base):
    """Hourly windows over a feed in which every fiftieth event comes a month late:
    final windows, open windows and the late rows, counted by hour."""
    d = _run_dir(spark, "windows_with_late_rows")
    ev = read_table(spark, base, "events").select("event_id", "ts", "event_type")
    delayed = F.col("event_id") % DELAYED[0] == DELAYED[1]
    day = F.dayofmonth("ts")
    for part in (~delayed & (day <= 10), ~delayed & (day > 10) & (day <= 20), ~delayed & (day > 20), delayed):
        ev.filter(part).write.mode("append").parquet(f"{d}/in")
        stream = spark.readStream.schema(ev.schema).parquet(f"{d}/in")
        wait_query(start_windows_with_late(stream, "ts", "event_type", WINDOW_LENGTH, WATERMARK, f"{d}/out",
                                           f"{d}/checkpoint", {"availableNow": True}))
    late = late_rows(spark, f"{d}/out").groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("window_start"), "event_type") \
        .agg(F.count(F.lit(1)).alias("count"))
    out = late.select(F.lit("late").alias("kind"), "window_start", "event_type", "count")
    for kind, rows in (("final", final_windows), ("open", open_windows)):
        out = out.union(rows(spark, f"{d}/out", "event_type", WINDOW_LENGTH)
                        .select(F.lit(kind), "window_start", "event_type", "count"))
    return out


def q_als_topk_exact(spark, base):
    """Every student's top list by the exact search; whether each rating is the product of
    the two factors."""
    def result(model, numbers, test):
        found = top_products(model.userFactors, model.itemFactors, rec.TOP_ALL)
        lists = found.select(F.col("id").alias("student_id"), F.transform("best", lambda x: F.struct(
            x["id"].alias("question_id"), x["score"].alias("rating"))).alias("recommendations"))
        users = model.userFactors.select(F.col("id").alias("student_id"), F.col("features").alias("u"))
        items = model.itemFactors.select(F.col("id").alias("question_id"), F.col("features").alias("v"))
        pairs = lists.select("student_id", F.explode("recommendations").alias("r")).select("student_id", "r.*") \
            .join(users, "student_id").join(items, "question_id")
        product = F.aggregate(F.zip_with("u", "v", lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)
        right = pairs.groupBy("student_id").agg(F.min(F.abs(product - F.col("rating")) < 1e-6).alias("products_match"))
        return _list_shape(lists).join(right, "student_id")
    return _als_table(spark, base, "als_topk_exact", result)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "wordcount_dsl": q_wordcount_dsl,
    "wordcount_sql": q_wordcount_sql,
    "wordcount_stream_memory": q_wordcount_stream_memory,
    "foreach_batch_snapshot": q_foreach_batch_snapshot,
    "foreach_batch_second_output": q_foreach_batch_second_output,
    "iot_stats_stream": q_iot_stats_stream,
    "event_line_quarantine": q_event_line_quarantine,
    "json_quarantine": q_json_quarantine,
    "top10_grades_stream": q_top10_grades_stream,
    "top10_questions_with_subject_stream": q_top10_questions_with_subject_stream,
    "lowest_score_students_stream": q_lowest_score_students_stream,
    "rmse_predictions": q_rmse_predictions,
    "serve_batches": q_serve_batches,
    "serve_published": q_serve_published,
    "split_words_append": q_split_words_append,
    "nonblank_filter": q_nonblank_filter,
    "json_extract_fields": q_json_extract_fields,
    "iot_stats_sql": q_iot_stats_sql,
    "iot_stats_dsl": q_iot_stats_dsl,
    "etl_contains_filter": q_etl_contains_filter,
    "event_line_parse": q_event_line_parse,
    "json_struct_parse": q_json_struct_parse,
    "json_lines_batch_read": q_json_lines_batch_read,
    "delimited_stream_read": q_delimited_stream_read,
    "top10_questions": q_top10_questions,
    "top10_grades": q_top10_grades,
    "top10_questions_with_subject": q_top10_questions_with_subject,
    "lowest_score_students": q_lowest_score_students,
    "lowest_questions_per_student": q_lowest_questions_per_student,
    "top10_questions_stream": q_top10_questions_stream,
    "window_sliding_complete": q_window_sliding_complete,
    "window_sliding_update": q_window_sliding_update,
    "window_sliding_append": q_window_sliding_append,
    "window_tumbling_daily": q_window_tumbling_daily,
    "window_tumbling_daily_stream": q_window_tumbling_daily_stream,
    "dedup_user_counts": q_dedup_user_counts,
    "dedup_user_counts_staged": q_dedup_user_counts_staged,
    "dedup_within_watermark": q_dedup_within_watermark,
    "id_to_number": q_id_to_number,
    "rating_bucket": q_rating_bucket,
    "ratings_extract": q_ratings_extract,
    "rmse_aggregate": q_rmse_aggregate,
    "hash_split_counts": q_hash_split_counts,
    "recs_to_string": q_recs_to_string,
    "answers_join_recs": q_answers_join_recs,
    "stream_static_join": q_stream_static_join,
    "registry_latest": q_registry_latest,
    "als_predict": q_als_predict,
    "als_recommend_all": q_als_recommend_all,
    "als_recommend_subset": q_als_recommend_subset,
    "missing_id_xor": q_missing_id_xor,
    "missing_ids_anti": q_missing_ids_anti,
    "missing_ids_ranges": q_missing_ids_ranges,
    "topic_replay": q_topic_replay,
    "two_phase_sink": q_two_phase_sink,
    "wordcount_state": q_wordcount_state,
    "windows_with_late_rows": q_windows_with_late_rows,
    "als_topk_exact": q_als_topk_exact,
}
