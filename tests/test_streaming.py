"""Streams from files: restart, replay, K-slack."""

from __future__ import annotations

from datetime import UTC, datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidewell.streaming import pipeline

SCHEMA = "k string, v string, ingested_at timestamp"


def test_names():
    assert pipeline.checkpoint_path("/c/", "A b.c", "Q") == "/c/q/a_b_c/v1"
    with pytest.raises(ValueError):
        pipeline.checkpoint_path("/c", " ", "q")


def test_days_by_type(spark):
    t = datetime(2026, 7, 16, tzinfo=UTC)
    s = spark.createDataFrame([("2026-07-16T01:30:00+03:30", t), ("07/08/2026 10:00:00", t), ("junk", t), (None, t)], "x string, ingested_at timestamp")
    assert sorted(str(r.ingest_date) for r in pipeline.with_day(s, "x").collect()) == ["2026-07-15", "2026-07-16", "2026-07-16", "2026-07-16"]
    n = spark.createDataFrame([(1_752_000_000, t), (1_752_000_000_000, t)], "x bigint, ingested_at timestamp")
    assert {str(r.ingest_date) for r in pipeline.with_day(n, "x").collect()} == {"2025-07-08"}


def test_restart_and_replay_write_nothing_twice(spark, tmp_path):
    src, out, cp = (str(tmp_path / x) for x in ("src", "out", "cp"))
    t = datetime(2025, 1, 1, tzinfo=UTC)
    run = lambda: pipeline.start_topic(pipeline.with_day(spark.readStream.schema(SCHEMA).parquet(src), "ingested_at"), out, cp, "q", True).awaitTermination()
    spark.createDataFrame([("a", "1", t)], SCHEMA).write.mode("append").parquet(src)
    run()
    spark.createDataFrame([("b", "2", t)], SCHEMA).write.mode("append").parquet(src)
    run()
    run()
    assert rows(spark.read.parquet(out), "k") == [("a",), ("b",)]
    batch = pipeline.with_day(spark.createDataFrame([("b", "2", t)], SCHEMA), "ingested_at")
    pipeline.idempotent_writer(out)(batch, 1)
    assert rows(spark.read.parquet(out), "k") == [("a",), ("b",)]


def test_supervisor_skips_what_fails():
    said = []

    def build(t):
        if t == "bad":
            raise RuntimeError("x")
        return None if t == "none" else object()

    assert len(pipeline.supervise(None, ["bad", "none", "ok"], build, said.append)) == 1 and len(said) == 2
    with pytest.raises(RuntimeError):
        pipeline.supervise(None, ["bad"], build, said.append)


def test_k_slack_stream_closes_days(spark, tmp_path):
    src = str(tmp_path / "s")
    t = datetime(2025, 1, 1, 12, tzinfo=UTC)
    send = lambda x: spark.createDataFrame(x, "k string, at timestamp").write.mode("append").parquet(src)
    send([("a", t)])
    stream = spark.readStream.schema("k string, at timestamp").option("maxFilesPerTrigger", 1).parquet(src)
    q = pipeline.k_slack_stream(stream, "at", "k").writeStream.outputMode("append").format("memory").queryName("kslack").option("checkpointLocation", str(tmp_path / "c")).start()
    try:
        q.processAllAvailable()
        for x in ([("b", t + timedelta(days=2))], [("c", t), ("a", t)], [("d", t + timedelta(days=9))], [("late", t)], [("e", t + timedelta(days=10))]):
            send(x)
            q.processAllAvailable()
        got = {str(r.day)[:10]: r.events for r in spark.sql("select * from kslack").select(F.date_format("day", "yyyy-MM-dd").alias("day"), "events").collect()}
        assert got["2025-01-01"] == 2
    finally:
        q.stop()


def test_event_data_packs_present_fields(spark):
    df = spark.createDataFrame([("u", "o", 1)], "user_id string, order_id string, kafka_offset int")
    out = pipeline.pack_event_data(df, ["user_id"], ["order_id", "rating"], ["kafka_offset"])
    assert out.columns == ["kafka_offset", "user_id", "event_data"] and out.first().event_data.order_id == "o"


def test_event_data_unpacks_to_columns(spark):
    df = spark.createDataFrame([("u", ("q", 1))], "user_id string, event_data struct<query: string, user_id: int>")
    out = pipeline.unpack_event_data(df, rename={"query": "search_query"})
    assert out.columns == ["user_id", "search_query"] and tuple(out.first()) == ("u", "q")


def test_a_replay_with_fewer_days_leaves_none_behind(spark, tmp_path):
    out = str(tmp_path / "o")
    t = datetime(2025, 1, 1, tzinfo=UTC)
    day = lambda *xs: pipeline.with_day(spark.createDataFrame([(k, "1", at) for k, at in xs], SCHEMA), "ingested_at")
    write = pipeline.idempotent_writer(out)
    write(day(("a", t), ("b", t + timedelta(days=1))), 7)
    write(day(("a", t)), 7)
    assert rows(spark.read.parquet(out), "k", "batch_id") == [("a", 7)]


def test_one_clock_in_the_future_does_not_end_the_buffer(spark, tmp_path):
    src = str(tmp_path / "s")
    t = datetime(2025, 1, 1, 12, tzinfo=UTC)
    kind = "k string, at timestamp, came timestamp"
    send = lambda *x: spark.createDataFrame(list(x), kind).write.mode("append").parquet(src)
    send(("future", t + timedelta(days=365), t))
    stream = spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).parquet(src)
    q = pipeline.k_slack_stream(stream, "at", "k", arrival="came").writeStream.outputMode("append").format("memory").queryName("clamped").option("checkpointLocation", str(tmp_path / "c")).start()
    try:
        q.processAllAvailable()
        for n, k in enumerate(["a", "b", "c"]):
            at = t + timedelta(days=5 * n)
            send((k, at, at))
            q.processAllAvailable()
        got = {str(r.day)[:10]: r.events for r in spark.sql("select * from clamped").select(F.date_format("day", "yyyy-MM-dd").alias("day"), "events").collect()}
        assert got["2025-01-01"] == 2
    finally:
        q.stop()


def test_a_topic_from_source_to_sink(spark, tmp_path):
    src, out, cp = (str(tmp_path / x) for x in ("src", "out", "cp"))
    t = datetime(2025, 1, 1, tzinfo=UTC)
    spark.createDataFrame([("a", "1", t)], SCHEMA).write.parquet(src)
    read = lambda _: spark.readStream.schema(SCHEMA).parquet(src)
    q = pipeline.build_stream("t.x", read, lambda df, _: df, out, cp, group=lambda df: df.withColumn("g", F.lit(1)), available_now=True)
    q.awaitTermination()
    assert rows(spark.read.parquet(out), "k", "g") == [("a", 1)]
    assert pipeline.build_stream("t", read, lambda *_: None, out, cp) is None
    with pytest.raises(ValueError, match="topic"):
        pipeline.build_stream(" ", read, lambda df, _: df, out, cp)


def test_sessions_of_a_stream_end_after_a_pause(spark, tmp_path):
    src = str(tmp_path / "s")
    t = datetime(2025, 1, 1, 12, tzinfo=UTC)
    send = lambda *x: spark.createDataFrame(list(x), "u string, at timestamp").coalesce(1).write.mode("append").parquet(src)
    send(("a", t), ("a", t + timedelta(minutes=10)), ("a", t + timedelta(hours=2)))
    stream = spark.readStream.schema("u string, at timestamp").option("maxFilesPerTrigger", 1).parquet(src)
    q = pipeline.session_stream(stream, "at", "u", slack="1 hour").writeStream.outputMode("append").format("memory").queryName("sess").option("checkpointLocation", str(tmp_path / "c")).start()
    try:
        q.processAllAvailable()
        for n in (1, 2):
            send(("b", t + timedelta(days=n)))
            q.processAllAvailable()
        assert sorted(r.events for r in spark.sql("select * from sess where u = 'a'").collect()) == [1, 2]
    finally:
        q.stop()
