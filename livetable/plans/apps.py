"""The reference's programs as parameterised Spark applications.

Each function wires a source, operators and sinks and returns the started
``StreamingQuery`` objects (or a result for the offline job).  Sources are
DataFrames so the caller chooses Kafka, socket, files or a table replay; sinks
default to parquet/snapshot folders under the shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from livetable import session
from livetable.functions.json import json_fields, parse_json, split_valid
from livetable.functions.text import contains_text, nonblank, split_words
from livetable.functions.timefns import parse_event_line
from livetable.operators import aggregate as agg
from livetable.operators import recommend as rec
from livetable.streaming.dedup import read_batch_distinct, start_batch_distinct
from livetable.streaming.eventtime import dedup_counts, windowed_count
from livetable.streaming.sinks import (drop_versions, foreach_batch_outputs, list_versions,
                                       snapshot_path_writer, start_query)


def _dirs(spark: SparkSession, app: str, name: str) -> tuple[str, str]:
    d = session.shared_dir(spark, "apps", app, name)
    return f"{d}/checkpoint", f"{d}/out"


def word_count(spark: SparkSession, lines: DataFrame, app: str = "word_count",
               trigger: dict | None = None, top: int | None = None) -> StreamingQuery:
    """Live word count, sorted by count; complete mode into a snapshot table."""
    counts = agg.count_by(split_words(lines, "value", "word"), "word", "count")
    result = counts.orderBy(F.desc("count"), F.asc("word"))
    if top:
        result = result.limit(top)
    ck, out = _dirs(spark, app, "counts")
    return start_query(result, "snapshot", ck, "complete", path=out, trigger=trigger)


def etl_filter(spark: SparkSession, records: DataFrame, needle: str = "success",
               app: str = "etl", trigger: dict | None = None) -> StreamingQuery:
    """Kafka records -> text -> lines containing ``needle`` -> parquet (or a
    Kafka topic via ``sources.kafka.write_kafka``)."""
    from livetable.sources.kafka import kafka_value
    out_df = contains_text(kafka_value(records), needle)
    ck, out = _dirs(spark, app, "filtered")
    return start_query(out_df, "parquet", ck, "append", path=out, trigger=trigger)


IOT_FIELDS = {"device_id": "$.device", "deviceType": "$.deviceType",
              "signal": "$.signal", "time": "$.time"}
IOT_TYPES = {"signal": "double", "time": "bigint"}


def device_stats(spark: SparkSession, lines: DataFrame, threshold: float = 30.0,
                 app: str = "device_stats", trigger: dict | None = None) -> list[StreamingQuery]:
    """Count and average signal per device type over signals above the
    threshold, in the SQL form and the DSL form (two named queries)."""
    iot = json_fields(nonblank(lines), IOT_FIELDS, types=IOT_TYPES)
    view = f"signals_{app}"
    iot.createOrReplaceTempView(view)
    sql_form = spark.sql(f"""
        SELECT deviceType, COUNT(*) AS counts, ROUND(AVG(signal), 6) AS mean_signal
        FROM {view} WHERE signal > {float(threshold)} GROUP BY deviceType""")
    dsl_form = agg.filtered_stats(iot, F.col("signal") > threshold, "deviceType", "signal",
                                  count_col="device_id", avg_name="mean_signal")
    qs = []
    for name, df in (("sql", sql_form), ("dsl", dsl_form)):
        ck, out = _dirs(spark, app, name)
        qs.append(start_query(df, "snapshot", ck, "complete", path=out, trigger=trigger))
    return qs


def event_windows(spark: SparkSession, lines: DataFrame, length: str = "10 seconds",
                  slide: str = "5 seconds", watermark: str = "10 seconds",
                  mode: str = "update", app: str = "event_windows",
                  trigger: dict | None = None) -> list[StreamingQuery]:
    """``timestamp,word`` lines -> sliding-window counts with a watermark.  Lines that
    do not parse are appended to ``quarantine_<mode>`` by a query of their own.  Both
    queries, the counts first."""
    ts, word = parse_event_line("value")
    parsed = lines.select("value", ts.alias("timestamp"), word.alias("word"))
    ok = F.col("timestamp").isNotNull()
    ck, out = _dirs(spark, app, f"quarantine_{mode}")
    bad = start_query(parsed.filter(~ok).select("value"), "parquet", ck, "append", path=out, trigger=trigger)
    ev = parsed.filter(ok)
    counts = windowed_count(ev, "timestamp", "word", length, slide, watermark)
    ck, out = _dirs(spark, app, mode)
    sink = {"update": "updates", "append": "parquet", "complete": "snapshot"}[mode]
    part = None
    if mode == "append":
        # Final windows accumulate over time: lay them out per day so that
        # readers prune by date.
        counts = counts.withColumn("window_day", F.to_date("window_start"))
        part = ["window_day"]
    return [start_query(counts, sink, ck, mode, path=out, trigger=trigger, partition_by=part), bad]


USER_EVENT_FIELDS = {"eventTime": "$.eventTime", "eventType": "$.eventType",
                     "userID": "$.userID"}
USER_EVENT_KEYS = ["userID", "eventTime", "eventType"]


def user_dedup(spark: SparkSession, lines: DataFrame, app: str = "user_dedup",
               trigger: dict | None = None) -> StreamingQuery:
    """User events de-duplicated on (user, time, type), counted per user."""
    ue = json_fields(nonblank(lines), USER_EVENT_FIELDS)
    res = dedup_counts(ue, USER_EVENT_KEYS, "userID")
    ck, out = _dirs(spark, app, "counts")
    return start_query(res, "snapshot", ck, "complete", path=out, trigger=trigger)


def user_dedup_staged(spark: SparkSession, lines: DataFrame, app: str = "user_dedup_staged",
                      trigger: dict | None = None) -> list[StreamingQuery]:
    """:func:`user_dedup` for streams with hot groups of copies: stage 1
    collapses copies per micro-batch, stage 2 de-duplicates the reduced stream
    (see ``streaming.dedup``).  Same counts; two named queries."""
    ue = json_fields(nonblank(lines), USER_EVENT_FIELDS)
    d = session.shared_dir(spark, "apps", app)
    q1 = start_batch_distinct(ue, USER_EVENT_KEYS, f"{d}/distinct", f"{d}/checkpoint1",
                              trigger=trigger)
    if trigger and trigger.get("availableNow"):
        q1.awaitTermination()  # a one-off run: stage 2 reads stage 1's whole output
    res = dedup_counts(read_batch_distinct(spark, f"{d}/distinct", ue, USER_EVENT_KEYS),
                       USER_EVENT_KEYS, "userID")
    ck, out = _dirs(spark, app, "counts")
    return [q1, start_query(res, "snapshot", ck, "complete", path=out, trigger=trigger)]


def answer_statistics(answers: DataFrame) -> dict[str, DataFrame]:
    """The four top-10 statistics, batch or stream."""
    return {
        "top10_questions": agg.top_n(agg.count_by(answers, "question_id"),
                                     [F.desc("count"), F.asc("question_id")], 10),
        "top10_grades": agg.top_n(agg.count_by(answers, "grade_id"),
                                  [F.desc("count"), F.asc("grade_id")], 10),
        "top10_questions_with_subject": agg.top_n_with_attr(answers, "question_id",
                                                            "subject_id", 10),
        "lowest_score_students": agg.lowest_by(answers, "student_id", "score",
                                               "question_id", 10),
    }


def answer_stats(spark: SparkSession, json_lines: DataFrame, app: str = "answer_stats",
                 trigger: dict | None = None) -> list[StreamingQuery]:
    """Four live top-10 statistics over answer messages, each its own named
    query with its own checkpoint (complete mode, snapshot tables), and before them a
    query that appends messages without student or question to ``quarantine``."""
    answers, bad = split_valid(parse_json(json_lines, raw=True), ["student_id", "question_id"])
    ck, out = _dirs(spark, app, "quarantine")
    qs = [start_query(bad.select("_raw"), "parquet", ck, "append", path=out,
                      query_name=f"{app}_quarantine", trigger=trigger)]
    for name, df in answer_statistics(answers).items():
        ck, out = _dirs(spark, app, name)
        qs.append(start_query(df, "snapshot", ck, "complete", path=out,
                              query_name=f"{app}_{name}", trigger=trigger))
    return qs


# Per statistic: batch partial aggregate, merge of (previous state + partial),
# and the top-10 read from the merged state.  Counts add up and minimums take
# the minimum, so merging partials equals aggregating all rows.
def _merges() -> dict:
    return {
        "questions": (
            ["question_id"],
            lambda b: b.groupBy("question_id").agg(F.count(F.lit(1)).alias("count"),
                                                   F.min("subject_id").alias("subject_id")),
            [F.sum("count").alias("count"), F.min("subject_id").alias("subject_id")]),
        "grades": (
            ["grade_id"],
            lambda b: b.groupBy("grade_id").agg(F.count(F.lit(1)).alias("count")),
            [F.sum("count").alias("count")]),
        "students": (
            ["student_id"],
            lambda b: b.filter(F.col("score").isNotNull()).groupBy("student_id").agg(
                F.min("score").alias("minscore"),
                F.min_by("question_id", F.struct("score", "question_id")).alias("question_id")),
            [F.min("minscore").alias("minscore"),
             F.min_by("question_id", F.struct("minscore", "question_id")).alias("question_id")]),
    }


def _tops(state: dict[str, DataFrame]) -> dict[str, DataFrame]:
    q, g, s = state["questions"], state["grades"], state["students"]
    return {
        "top10_questions": agg.top_n(q.select("question_id", "count"),
                                     [F.desc("count"), F.asc("question_id")], 10),
        "top10_grades": agg.top_n(g, [F.desc("count"), F.asc("grade_id")], 10),
        "top10_questions_with_subject": agg.top_n(q, [F.desc("count"), F.asc("question_id")], 10),
        "lowest_score_students": agg.top_n(s, [F.asc("minscore"), F.asc("student_id")], 10),
    }


def answer_stats_per_batch(spark: SparkSession, json_lines: DataFrame,
                           app: str = "answer_stats_batch",
                           trigger: dict | None = None) -> StreamingQuery:
    """The four statistics from one read and one parse per micro-batch.

    The parsed batch is persisted once and feeds: the answers table, the
    quarantine of unparseable rows, and one state table per statistic.  State
    version ``v=<batch_id>`` = previous version merged with the batch's
    partial aggregate (work per batch grows with the batch and the number of
    keys, not with history); a replayed batch rewrites its own version.  The
    four top-10 tables are snapshots of the newest version (read them with
    ``streaming.sinks.read_snapshot``).
    """
    d = session.shared_dir(spark, "apps", app)
    parsed = parse_json(json_lines, raw=True)

    def keep(batch, batch_id):
        ok = F.col("student_id").isNotNull() & F.col("question_id").isNotNull()
        for rows, name in ((batch.filter(ok).drop("_raw"), "answers"),
                           (batch.filter(~ok).select("_raw"), "quarantine")):
            (rows.withColumn("batch_id", F.lit(batch_id).cast("long"))
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("batch_id").parquet(f"{d}/{name}"))

    def stats(batch, batch_id):
        good = batch.filter(F.col("student_id").isNotNull() & F.col("question_id").isNotNull())
        state = {}
        for name, (keys, partial, merge) in _merges().items():
            root = f"{d}/state_{name}"
            prev = [v for v in list_versions(spark, root, committed=True) if v < batch_id]
            part = partial(good)
            if prev:
                old = spark.read.parquet(f"{root}/v={prev[-1]}")
                part = old.unionByName(part).groupBy(*keys).agg(*merge)
            part.write.mode("overwrite").parquet(f"{root}/v={batch_id}")
            state[name] = spark.read.parquet(f"{root}/v={batch_id}")
            if prev:
                drop_versions(spark, root, prev[-1])
        for name, df in _tops(state).items():
            snapshot_path_writer(f"{d}/{name}")(df, batch_id)

    fn = foreach_batch_outputs([keep, stats])
    return start_query(parsed, "foreach_batch", f"{d}/checkpoint", "append", batch_fn=fn,
                       query_name=f"{app}_q", trigger=trigger)


def train_recommender(spark: SparkSession, answers: DataFrame, app: str = "recommender",
                      gate: float = rec.RMSE_GATE, **als_kw) -> dict:
    """Offline: answers -> ratings -> ALS -> gate -> model + registry row +
    top-20 table.  Returns RMSE, path and split sizes."""
    root = session.shared_dir(spark, "apps", app)
    return rec.train_evaluate_publish(spark, rec.extract_ratings(answers), f"{root}/models",
                                      f"{root}/registry", f"{root}/recommend_all",
                                      gate=gate, **als_kw)


def serve_recommendations(spark: SparkSession, json_lines: DataFrame,
                          app: str = "recommender", output=None,
                          trigger: dict | None = None) -> list[StreamingQuery]:
    """Online: each micro-batch of answers gets its students' top-10 from the
    current registered model, joined to the answers and appended (keyed by
    batch id so a replay replaces its own rows).  Before the first publication the
    query fails and, started again, serves the same batch; messages without student
    or question go to ``quarantine``.  Both queries, the serving one first."""
    root = session.shared_dir(spark, "apps", app)
    answers, bad = split_valid(parse_json(json_lines, raw=True), ["student_id", "question_id"])
    apart = start_query(bad.select("_raw"), "parquet", f"{root}/quarantine_checkpoint", "append",
                        path=f"{root}/quarantine", trigger=trigger)
    answers = answers.drop("_raw")
    cache = rec.ModelCache(spark, f"{root}/registry")
    if output is None:
        out = f"{root}/served"

        def output(df, batch_id):
            (df.withColumn("batch_id", F.lit(batch_id).cast("long"))
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("batch_id").parquet(out))
    served = start_query(answers, "foreach_batch", f"{root}/serve_checkpoint", "append",
                         batch_fn=rec.serve_batch(rec.model_recommender(cache), output), trigger=trigger)
    return [served, apart]
