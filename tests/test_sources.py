"""Source factories: delimited files with a schema, text lines, Kafka-shaped
records, one-file parquet tables as streams."""

import os

from pyspark.sql import functions as F

from livetable import schemas
from livetable.sources.files import read_delimited, read_lines, read_table, stream_table
from livetable.sources.kafka import kafka_rows, kafka_value
from livetable.streaming.sinks import run_available_now

from conftest import SF0001

# Our own copy of a persons sample: name;age;hobby, no header.
PERSONS = "jack;23;running\nlucy;32;running\ntom;21;basketball\nbad;x;swim\n"


def test_delimited_batch_and_stream(spark, tmp):
    src = os.path.join(tmp, "persons")
    os.makedirs(src)
    for i in range(3):
        with open(os.path.join(src, f"file{i}.csv"), "w") as f:
            f.write(PERSONS)
    batch = read_delimited(spark, src, schemas.PERSON_HOBBY, sep=";")
    assert batch.count() == 12
    assert batch.filter(F.col("age").isNull()).count() == 3  # "x" is not an int
    stream = read_delimited(spark, src, schemas.PERSON_HOBBY, sep=";", stream=True,
                            max_files_per_trigger=1)
    out = os.path.join(tmp, "out")
    q = run_available_now(stream, "parquet", os.path.join(tmp, "ck"), path=out)
    assert spark.read.parquet(out).count() == 12
    assert len([p for p in q.recentProgress if p["numInputRows"] > 0]) == 3


def test_text_lines(spark, tmp):
    p = os.path.join(tmp, "t.txt")
    with open(p, "w") as f:
        f.write("hello me\n\nhello")
    assert [r.value for r in read_lines(spark, p).collect()] == ["hello me", "", "hello"]


def test_kafka_shaped_rows_decode(spark):
    ev = read_table(spark, SF0001, "events")
    recs = kafka_rows(ev, F.col("event_type"), "t", F.col("event_id"), F.current_timestamp())
    assert [f.name for f in recs.schema.fields] == [f.name for f in schemas.KAFKA.fields]
    assert dict((f.name, f.dataType) for f in recs.schema.fields)["value"].typeName() == "binary"
    decoded = kafka_value(recs)
    assert sorted(r.value for r in decoded.distinct().collect()) == \
        sorted(r.event_type for r in ev.select("event_type").distinct().collect())


def test_one_file_table_streams(spark, tmp):
    s = stream_table(spark, SF0001, "events")
    assert s.isStreaming
    out = os.path.join(tmp, "o")
    run_available_now(s.select("event_id"), "parquet", os.path.join(tmp, "ck"), path=out)
    assert spark.read.parquet(out).count() == read_table(spark, SF0001, "events").count()


def test_answer_topic_follows_the_table(spark, tmp):
    """Rows that reach ``lineitem`` after the start reach the topic and what reads it,
    with the static tables broadcast and joined by shuffle."""
    import shutil

    from livetable.operators.aggregate import count_by
    from livetable.plans import standins as st
    from livetable.streaming.sinks import read_snapshot
    li = read_table(spark, SF0001, "lineitem")
    for i, limit in enumerate((None, "-1")):
        base = os.path.join(tmp, f"base{i}")
        os.makedirs(base)
        for t in ("orders", "part"):
            shutil.copy(f"{SF0001}/{t}.parquet", base)
        old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
        if limit:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        try:
            def run():
                topic, q = st.start_answer_topic(spark, base, os.path.join(tmp, f"topic{i}"), {"availableNow": True})
                q.awaitTermination()
                counts = count_by(st.read_answer_topic(spark, base, topic), "grade_id")
                run_available_now(counts, "snapshot", os.path.join(tmp, f"ck{i}"), "complete",
                                  path=os.path.join(tmp, f"out{i}"))
                return sum(r["count"] for r in read_snapshot(spark, os.path.join(tmp, f"out{i}")).collect())

            li.filter("l_orderkey % 2 = 0").write.parquet(f"{base}/lineitem.parquet")
            first = run()
            li.filter("l_orderkey % 2 = 1").write.mode("append").parquet(f"{base}/lineitem.parquet")
            assert 0 < first < run() == st.answers(spark, SF0001).count()
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_kafka_sink_takes_value_and_key_only(spark):
    import pytest
    from livetable.sources.kafka import write_kafka
    rows = spark.readStream.format("rate").load().selectExpr("cast(value as string) word")
    with pytest.raises(ValueError, match="value"):
        write_kafka(rows, "localhost:1", "t", "/nowhere")


def test_stream_backlog_is_read_in_bounded_batches(spark, tmp):
    """With maxBytesPerTrigger an availableNow run splits a backlog into
    several micro-batches and still reads every row once."""
    from livetable.sources.files import batch_bytes
    ev = read_table(spark, SF0001, "events")
    ev.repartition(6).write.parquet(os.path.join(tmp, "ev.parquet"))
    s = stream_table(spark, tmp, "ev", max_bytes_per_trigger=1)
    q = run_available_now(s, "parquet", os.path.join(tmp, "ck"), path=os.path.join(tmp, "out"))
    batches = [p for p in q.recentProgress if p["numInputRows"] > 0]
    assert len(batches) == 6
    got = spark.read.parquet(os.path.join(tmp, "out"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, ev.collect()))
    assert batch_bytes(spark) == spark.sparkContext.defaultParallelism * 512 * 1024 * 1024


def test_kafka_factory_reaches_the_connector(spark):
    """The factory builds its options; only the missing connector jar stops
    it here (no broker is contacted)."""
    import pytest
    from livetable.sources.kafka import read_kafka
    with pytest.raises(Exception, match="(?i)kafka"):
        read_kafka(spark, "localhost:1", "t", max_offsets_per_trigger=1000)


def test_cluster_checkpoint_dir_wins(spark, tmp):
    """A folder passed by the caller never replaces the session's own."""
    from livetable.session import shared_dir, use_checkpoint_dir
    before = shared_dir(spark, "x")
    use_checkpoint_dir(spark, os.path.join(tmp, "other"))
    assert shared_dir(spark, "x") == before
    assert not os.path.exists(os.path.join(tmp, "other"))
