"""Every keyed query against its DuckDB SQL at sf0.01 (the driver's gate)."""

import pytest

from livetable.plans.oracle import ORACLE
from livetable.plans.queries import QUERIES
from oracle_compare import compare

from conftest import SF001


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, name):
    r = compare(spark, name, QUERIES[name], ORACLE[name], SF001)
    assert r["cols_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["values_match"], r


def test_every_key_has_sql():
    assert set(QUERIES) == set(ORACLE)


EVENT_KEYS = ["window_sliding_complete", "window_sliding_update", "window_sliding_append",
              "window_tumbling_daily_stream", "dedup_within_watermark", "dedup_user_counts",
              "iot_stats_stream"]


@pytest.fixture(scope="module")
def six_files(spark, tmp_path_factory):
    """The events table as six files in no time order, read one per micro-batch."""
    base = str(tmp_path_factory.mktemp("six"))
    spark.read.parquet(f"{SF001}/events.parquet").repartition(6).write.parquet(f"{base}/events.parquet")
    return base


@pytest.mark.parametrize("name", EVENT_KEYS)
def test_event_keys_do_not_depend_on_micro_batch_cuts(spark, six_files, monkeypatch, name):
    import livetable.plans.queries as q
    import livetable.plans.standins as st
    monkeypatch.setattr(st, "batch_bytes", lambda spark: 1)  # one file for each batch
    fn = QUERIES[name]
    if name in ("window_sliding_append", "dedup_within_watermark"):
        fn = lambda s, base: getattr(q, f"q_{name}")(s, base, slices=6)
    import duckdb
    import oracle_compare
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{six_files}/events.parquet/*.parquet')")
    monkeypatch.setattr(oracle_compare, "duck", lambda base: con)
    r = compare(spark, name, fn, ORACLE[name], six_files)
    assert r["cols_match"] and r["values_match"] and r["spark_rows"] == r["oracle_rows"] > 0, r


def test_good_and_quarantined_rows_are_the_input(spark):
    import livetable.plans.queries as q
    from pyspark.sql import functions as F
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    n = ev.count()
    for make in (q._event_lines, q._answer_rows):
        good, bad = make(spark, SF001)
        assert bad.count() == 0 < good.count()
    lines = q._broken(ev.select("event_id", F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit(","),
                                                     F.col("event_type")).alias("value")), "event_id")
    good, bad = q.parse_with_quarantine(spark, lines, q.parse_event_rows, ["timestamp", "word"], "test_quarantine")
    assert good.count() + bad.count() == n and 0 < bad.count() < n


def test_entry_contract(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


TIME_KEYS = ["event_line_parse", "window_sliding_complete", "window_tumbling_daily",
             "json_struct_parse", "json_extract_fields"]


@pytest.mark.parametrize("name", TIME_KEYS)
def test_time_keys_do_not_depend_on_session_zone(spark, name):
    """A caller's session may use any zone, even one with clock changes."""
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        r = compare(spark, name, QUERIES[name], ORACLE[name], SF001)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert r["cols_match"] and r["values_match"], r
    assert r["spark_rows"] == r["oracle_rows"]
