"""Pieces of the behavioral marts; the whole marts are held against SQL that reads
the same notations (``test_star``)."""

from __future__ import annotations

import random
from datetime import UTC, datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidewell.operators import marts
from tidewell.plans import behavior
from tidewell.sources import bronze

EVENT = "date_sk int, at_us bigint, event_key string, user_id string, session_id string, event_type string, device string, success boolean, order_id string, duration_sec int"


@pytest.mark.parametrize("chunk", [7, 100, 10**9])
def test_gap_sessions_do_not_depend_on_chunks(spark, chunk):
    rnd = random.Random(chunk)
    events = [(rnd.choice(["hot", "hot", "b"]), rnd.randrange(400), i) for i in range(120)] + [(None, 5, 500), ("b", None, 501)]
    want = set()
    for u in ("hot", "b"):
        n, last, start, k = 0, None, None, 0
        for t in [*sorted(t for x, t, _ in events if x == u and t is not None), None]:
            if t is None or last is None or t - last > 10:
                if k:
                    want.add((u, n, k, start, last))
                n, start, k = n + 1, t, 0
            last, k = t, k + 1
    df = spark.createDataFrame(events, "u string, t bigint, k int")
    assert {tuple(r) for r in marts.gap_sessions(df, "u", "t", "k", 10, chunk).collect()} == want
    assert marts.gap_sessions(df.limit(0), "u", "t", "k", 10).count() == 0


def test_payments_come_as_events_or_as_attempts(spark):
    df = spark.createDataFrame([("payment_attempt", True), ("Payment_Attempt ", False), ("payment_attempt", None), ("successful_payment", None), ("failed_payment", None), (None, True)], "event_type string, success boolean")
    s = marts.step_flags()
    assert rows(df.select(s["successful_payment"].cast("int").alias("a"), s["failed_payment"].cast("int").alias("b")).fillna(0)) == sorted([(1, 0), (0, 1), (0, 0), (1, 0), (0, 1), (0, 0)])


def test_user_days_count_orders_once_and_know_the_days_since(spark):
    data = [
        (20260101, 1, "a", "U", "s", "order_complete", "m", None, "O1", 5), (20260101, 2, "b", "U", "s", "order_complete", "m", None, "O1", None),
        (20260103, 3, "c", "U", None, "order_complete", "d", None, "O1", 1), (20260105, 4, "d", "U", "t", "page_view", "m", None, None, 1), (20260105, 5, "e", None, "t", "page_view", "m", None, None, 1),
    ]
    got = rows(marts.user_daily(spark.createDataFrame(data, EVENT)), "date_sk", "sessions", "daily_orders", "lifetime_orders", "days_since_last_order", "is_new", "primary_device")
    assert got == [(20260101, 1, 1, 1, 0, True, "m"), (20260103, 0, 1, 1, 0, False, "m"), (20260105, 1, 0, 1, 2, False, "m")]
    assert marts.user_daily(spark.createDataFrame([], EVENT)).count() == 0


def test_branches_are_aligned_with_zeros(spark):
    a, b = spark.createDataFrame([("x", 1)], "entity string, views int"), spark.createDataFrame([("y", 2)], "entity string, searches int")
    assert rows(marts.aligned_union({"p": a, "s": b}), "entity_type", "entity", "views", "searches") == [("p", "x", 1, 0), ("s", "y", 0, 2)]


def test_every_class_of_partition_time(spark):
    t = lambda *a: datetime(*a, tzinfo=UTC)
    df = spark.createDataFrame([("n", None, None), ("u", "?", None), ("e", "x", t(1970, 1, 1)), ("o", "x", t(2001, 1, 1)), ("f", "x", t(2031, 1, 1)), ("v", "x", t(2026, 1, 1))], "k string, raw string, at timestamp")
    got = dict(rows(df.select("k", behavior.partition_quality(F.col("at"), F.col("raw"), "2025-01-01", "2027-01-01").alias("q"))))
    assert got == {"n": "null", "u": "unparseable", "e": "epoch_1970", "o": "too_old", "f": "future", "v": "valid"}
    assert behavior.partition_quality(F.col("at"), None, "2025-01-01", "2027-01-01") is not None
    at, source = bronze.first_valid_time({"a": F.col("at"), "b": F.lit("2026-05-05").cast("timestamp")}, "2025-01-01", "2027-01-01")
    assert dict(rows(df.select("k", source.alias("s"))))["v"] == "a" and dict(rows(df.select("k", source.alias("s"))))["f"] == "b"


def test_event_range_is_half_open(spark):
    df = spark.createDataFrame([(1,), (5,), (9,), (None,)], "at_us bigint")
    assert rows(behavior.events_between(df, 1, 9)) == [(1,), (5,)]
    with pytest.raises(ValueError, match="after start"):
        behavior.events_between(df, 9, 9)
