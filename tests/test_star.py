"""Reference operators: unit cases, registry against DuckDB, rerun idempotency."""

from __future__ import annotations

import decimal
import os
from datetime import date, datetime, timedelta, UTC

import duckdb
import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.functions.ids import norm_id
from tidewell.operators import audits, marts, versions
from tidewell.operators.calendar import calendar
from tidewell.operators.publish import VersionedTable, overwrite_range
from tidewell.operators.quality import Rule, align, quarantine, require, split_valid
from tidewell.plans import registry
from tidewell.sources import adapters, bronze

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for f in os.listdir(FOLDER):
        c.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{FOLDER}/{f}'")
    return c


def _plain(v):
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, datetime):
        return v.replace(tzinfo=None)
    return round(v, 6) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(registry.oracles()))
def test_query_equals_its_oracle(spark, duck, name):
    df = registry.queries()[name](spark, FOLDER)
    r = duck.execute(registry.oracles()[name])
    cols = [x[0] for x in r.description]
    assert sorted(cols) == sorted(df.columns)
    key = lambda t: tuple((v is None, str(v)) for v in t)
    want = sorted((tuple(_plain(t[cols.index(c)]) for c in sorted(cols)) for t in r.fetchall()), key=key)
    assert sorted((tuple(_plain(t[c]) for c in sorted(cols)) for t in df.collect()), key=key) == want


def test_every_query_without_oracle_runs(spark):
    for name in sorted(set(registry.queries()) - set(registry.oracles())):
        registry.queries()[name](spark, FOLDER).write.format("noop").mode("overwrite").save()


def test_entry_has_rows(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0


def test_latest_keeps_rows_without_key(spark):
    df = spark.createDataFrame([("a", 1, None), ("A ", 2, 5), (None, 3, 1), (" ", 4, 1), ("b", 5, None)], "k string, n int, t int")
    out = versions.latest_by(df, norm_id("k"), versions.newest_first("t"))
    assert sorted(r.n for r in out.collect()) == [2, 3, 4, 5]
    assert sorted(r.n for r in versions.latest_by(df, norm_id("k"), versions.newest_first("t"), False).collect()) == [2, 5]


def test_reasons_are_joined_in_order_and_rows_conserved(spark):
    df = spark.createDataFrame([(1, None), (-1, None), (1, "x")], "a int, b string")
    good, bad = split_valid(df, [Rule("negative", F.col("a") < 0), Rule("missing", F.col("b").isNull())])
    assert good.count() + bad.count() == 3
    assert sorted(r._dq_error_reason for r in bad.collect()) == ["missing", "negative; missing"]


def test_quarantine_ids(spark):
    df = spark.createDataFrame([(0, 1, "x"), (0, 1, "y"), (0, 2, "x"), (None, None, "x")], "kafka_partition int, kafka_offset bigint, _dq_error_reason string")
    q = quarantine(df, "user", "t", F.current_timestamp()).collect()
    assert len(q) == 3 and all(len(r._dq_quarantine_id) == 64 for r in q)
    assert {r._dq_error_reason for r in q if r.kafka_offset == 1} == {"y"}
    assert align(df, T.StructType([T.StructField("kafka_offset", T.StringType()), T.StructField("z", T.IntegerType())])).columns == ["kafka_offset", "z"]
    with pytest.raises(ValueError, match="zz"):
        require(df, ["zz"])


def test_upserts_are_idempotent_and_respect_policies(spark):
    t = spark.createDataFrame([(1, "a", 5), (2, "b", None)], "k int, v string, source_kafka_timestamp int")
    s = spark.createDataFrame([(1, "x", 5), (2, "y", 9), (3, "z", 1)], "k int, v string, source_kafka_timestamp int")
    newer = versions.upsert(t, s, "k", versions.NEWER)
    assert rows(newer, "k", "v") == [(1, "a"), (2, "b"), (3, "z")]
    assert rows(versions.upsert(newer, s, "k", versions.NEWER)) == rows(newer) or rows(newer.na.fill(0)) == rows(versions.upsert(newer, s, "k", versions.NEWER).na.fill(0))
    assert rows(versions.upsert(t, s, "k", "true"), "k", "v") == [(1, "x"), (2, "y"), (3, "z")]
    assert rows(versions.upsert(t, s, "k"), "k", "v") == [(1, "a"), (2, "b"), (3, "z")]


def test_tombstones_and_cascade(spark):
    df = spark.createDataFrame([("a", "o", "u"), ("b ", None, None), (None, None, None), (" ", None, None)], "kafka_key string, order_id string, user_id string")
    keep, gone = versions.split_tombstones(df, "kafka_key", ["order_id", "user_id"])
    assert keep.count() == 2 and rows(gone) == [("b",)]
    facts = spark.createDataFrame([("b", 7), ("c", 8)], "kafka_key string, user_sk int")
    assert rows(versions.reset_reference(facts, gone, "kafka_key", {"user_sk": F.lit(-1)})) == [("b", -1), ("c", 8)]


def test_interval_join_is_half_open(spark):
    d = lambda n: datetime(2025, 1, n)
    v = spark.createDataFrame([("p", d(2), d(4), 1), ("p", d(4), None, 2)], "k string, a timestamp, b timestamp, n int")
    f = spark.createDataFrame([("p", d(1)), ("p", d(2)), ("p", d(3)), ("p", d(4)), ("q", d(4))], "k string, at timestamp")
    assert [r.n for r in versions.interval_join(f, v, "k", "at", "a", "b", ["n"]).orderBy("k", "at").collect()] == [None, 1, 1, 2, None]


def test_calendar_and_once_measure(spark):
    c = calendar(spark, date(2024, 1, 5), date(2024, 1, 7))
    assert [r.is_weekend for r in c.orderBy("full_date").collect()] == [False, True, True]
    with pytest.raises(ValueError):
        calendar(spark, date(2024, 1, 7), date(2024, 1, 5))
    t = spark.createDataFrame([(1, 1, 10), (1, 2, 10), (2, 3, 7)], "o int, i int, total int")
    assert marts.once_per_parent(t, "o", "i", "total").agg(F.sum("total_once")).first()[0] == 17


def test_checks_raise_with_names(spark):
    r = audits.checks(spark.range(1).select(F.lit(1).alias("n")), {"one": F.col("n") == 1, "two": F.col("n") == 2, "unknown": F.lit(None).cast("boolean")})
    with pytest.raises(AssertionError, match="two, unknown"):
        audits.raise_on_failure(r)


def test_publish_swaps_and_rolls_back(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"))
    with pytest.raises(FileNotFoundError):
        t.read()
    t.publish(spark.range(3))

    def refuse(_):
        raise AssertionError("no")

    with pytest.raises(AssertionError):
        t.publish(spark.range(5), refuse)
    assert t.read().count() == 3
    t.publish(spark.range(7))
    assert t.read().count() == 7
    t.rollback(1)
    assert t.read().count() == 3 and t.current() == 1
    t.publish(spark.range(1))
    assert t.clean(1) == [1, 2] and t.versions() == [3] and t.read().count() == 1


def test_range_overwrite_is_idempotent(spark, tmp_path):
    at = str(tmp_path / "r")
    overwrite_range(spark.createDataFrame([(1, "a"), (2, "b")], "n int, day string"), at, ["day"])
    for _ in range(2):
        overwrite_range(spark.createDataFrame([(9, "b")], "n int, day string"), at, ["day"])
    assert sorted(r.n for r in spark.read.parquet(at).collect()) == [1, 9]


def test_topic_paths_and_modes(spark, tmp_path):
    assert bronze.topic_path("/b/", "a.c", day="2025-01-02") == "/b/a/c/new_data/2025/01/02"
    with pytest.raises(ValueError):
        bronze.topic_path("/b", "a.c", day="2025-1-2")
    days = bronze.day_paths("/b", "t", datetime(2025, 1, 1, 5, tzinfo=UTC), datetime(2025, 1, 3, tzinfo=UTC))
    assert [p[-10:] for p in days] == ["2025/01/01", "2025/01/02"]
    base = str(tmp_path)
    spark.createDataFrame([(1,)], "a int").write.parquet(bronze.topic_path(base, "x.y", "historical_v1"))
    spark.createDataFrame([(2, 3)], "a int, b int").write.parquet(bronze.topic_path(base, "x.y", day="2025-01-02"))
    assert rows(bronze.read_topic(spark, base, "x.y", "all").fillna(0)) == [(1, 0), (2, 3)]
    assert bronze.read_topic(spark, base, "x.y", "daily", "2025-01-02").count() == 1
    assert bronze.read_topic(spark, base, "x.y", "historical").count() == 1
    with pytest.raises(ValueError):
        bronze.read_topic(spark, base, "x.y", "other")
    g = bronze.read_generation(spark, bronze.topic_path(base, "x.y", day="2025-01-02"), "recovery", 2)
    assert g.select(bronze.folder_date().alias("d")).first().d == date(2025, 1, 2)


def test_adapters_check_their_options(spark):
    o = adapters.kafka_options("h:1", "t")
    assert o["startingOffsets"] == "earliest" and o["maxOffsetsPerTrigger"] == "10000" and o["failOnDataLoss"] == "false"
    assert "maxOffsetsPerTrigger" not in adapters.kafka_options("h:1", "t", ending="latest")
    with pytest.raises(ValueError):
        adapters.kafka_options("", "t")
    with pytest.raises(ValueError, match="S3_SECRET_KEY"):
        adapters.object_store_conf({"S3_ENDPOINT": "http://x", "S3_ACCESS_KEY": "a"})
    df = spark.createDataFrame([(1, bytearray(b"\x00\x00\x00\x00\x01abc"))], "n int, raw_value binary")
    assert adapters.decode_confluent(df, "t", lambda _: None) is None
    out = adapters.decode_confluent(df, "t", lambda _: "s", from_avro=lambda c, s: F.struct(c.cast("string").alias("v")))
    assert rows(out) == [(1, "abc")]
