"""Registry, catalog, quarantine, periods and reports."""

from __future__ import annotations

import http.server
import json
import random
import threading
import urllib.error
from datetime import date

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidewell.operators import audits, publish, quality, versions
from tidewell.plans import models
from tidewell.sources import adapters, bronze, catalog


def test_registry_lookup_is_cached_and_404_is_none():
    asked = []

    class Registry(http.server.BaseHTTPRequestHandler):
        def do_GET(self):  # noqa: N802
            asked.append(self.path)
            code = 200 if "good" in self.path else 404 if "none" in self.path else 500
            self.send_response(code)
            self.end_headers()
            self.wfile.write(json.dumps({"schema": "S"}).encode())

        def log_message(self, *_):
            pass

    server = http.server.HTTPServer(("127.0.0.1", 0), Registry)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        of = adapters.schema_registry(f"http://127.0.0.1:{server.server_port}/")
        assert of("good") == of("good") == "S" and of("none") is None
        assert asked.count("/subjects/good-value/versions/latest") == 1
        with pytest.raises(urllib.error.HTTPError):
            of("broken")
    finally:
        server.shutdown()


def test_admin_sql_shows_the_servers_error():
    class Database(http.server.BaseHTTPRequestHandler):
        def do_POST(self):  # noqa: N802
            sql = self.rfile.read(int(self.headers["Content-Length"])).decode()
            self.send_response(200 if sql == "SELECT 1" else 400)
            self.end_headers()
            self.wfile.write((self.headers.get("Authorization", "-") if sql == "SELECT 1" else "bad " + sql).encode())

        def log_message(self, *_):
            pass

    server = http.server.HTTPServer(("127.0.0.1", 0), Database)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        url = f"http://127.0.0.1:{server.server_port}/"
        assert adapters.admin_sql(url, "SELECT 1", "u", "p") == "Basic dTpw"
        with pytest.raises(RuntimeError, match="bad nonsense"):
            adapters.admin_sql(url, "nonsense")
    finally:
        server.shutdown()


@pytest.mark.parametrize("together", ["true", "false"])
def test_versions_that_hold_are_counted_without_pairs(spark, together):
    rnd = random.Random(3)
    v = [(rnd.choice("ab"), rnd.randrange(30), rnd.choice([None, rnd.randrange(40)])) for _ in range(40)] + [(None, 1, 2), ("a", None, 3)]
    f = [(i, rnd.choice(["a", "b", "c", None]), rnd.choice([None, *range(40)])) for i in range(120)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", together)
    got = versions.matches_at(spark.createDataFrame(f, "i int, k string, t int"), spark.createDataFrame(v, "k string, a int, z int"), "k", "t", "a", "z")
    want = [(i, sum(k is not None and t is not None and x == k and a is not None and a <= t and (z is None or t < z) for x, a, z in v)) for i, k, t in f]
    assert rows(got, "i", "matches") == want
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_classified_once_for_two_branches(spark):
    df = spark.createDataFrame([(1,), (None,)], "k int")
    with quality.classified(df, [quality.Rule("missing_k", F.col("k").isNull())]) as (good, bad):
        assert (good.count(), bad.count()) == (1, 1) and bad.first()[quality.REASON] == "missing_k"


def test_days_are_ranges():
    with pytest.raises(ValueError, match="before"):
        quality.inclusive_days("t", date(2026, 1, 2), date(2026, 1, 1))


def test_log_of_publications(spark, tmp_path):
    t = publish.VersionedTable(spark, str(tmp_path / "t"))
    assert t.log().count() == 0
    for _ in range(2):
        t.publish(spark.range(1))
    t.rollback(1)
    assert rows(t.log()) == [(1, 1, False), (2, 2, False), (3, 1, True)]


def test_comparison_with_the_brokers_log_and_report(spark):
    a = spark.createDataFrame([(0, 1), (0, 2), (0, 2)], "p int, o int")
    b = spark.createDataFrame([(0, 2), (0, 3)], "p int, o int")
    assert rows(audits.compare_with_log(a, b, ["p", "o"])) == [(0, 1, "stored_only"), (0, 3, "missing")]
    assert json.loads(audits.json_report({"x": a})) == {"x": [{"o": 1, "p": 0}, {"o": 2, "p": 0}, {"o": 2, "p": 0}]}


def test_catalog_tables(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    catalog.drop(spark, "t_parts")
    for _ in range(2):
        catalog.ensure_table(spark, "t_parts", df, ["v"])
    catalog.insert(df.select("v", "k"), "t_parts")
    assert rows(catalog.scan(spark, "t_parts").na.fill("-"), "k", "v") == [(1, "a"), (2, "-")]
    with pytest.raises(ValueError, match="no columns x"):
        catalog.insert(df.withColumnRenamed("v", "x"), "t_parts")
    with pytest.raises(ValueError, match="table name"):
        catalog.drop(spark, "a; drop b")
    catalog.drop(spark, "t_parts")


def test_quarantine_keeps_its_first_schema(spark):
    old = spark.createDataFrame([("1", "a"), ("2", "b")], "_dq_quarantine_id string, category string")
    new = spark.createDataFrame([("2", "x", 5), ("3", "c", 6)], "_dq_quarantine_id string, category string, more int")
    assert rows(quality.merge_quarantine(old, new)) == [("1", "a"), ("2", "x"), ("3", "c")]
    assert quality.merge_quarantine(None, new) is new
    again = quality.merge_quarantine(quality.merge_quarantine(old, new), new)
    assert rows(again) == [("1", "a"), ("2", "x"), ("3", "c")]


def test_open_periods_end_where_new_versions_begin(spark):
    t = spark.createDataFrame([("a", 1, 5, False), ("a", 5, None, True), ("b", 3, None, True), ("c", 9, None, True)], "k string, effective_from int, effective_to int, is_current boolean")
    s = spark.createDataFrame([("a", 8), ("a", 7), ("c", 9)], "k string, effective_from int")
    got = rows(versions.close_current(t, s, "k").na.fill(-1))
    assert got == [("a", 1, 5, False), ("a", 5, 7, False), ("b", 3, -1, True), ("c", 9, -1, True)]


def test_report_on_a_written_dataset(spark):
    a = spark.createDataFrame([(1, "x", "d"), (2, "y", "d")], "k int, v string, day string")
    ok = lambda b: {r.check_name: r.passed for r in audits.write_report(a, b, ["k"], ["v"], "day").collect()}
    assert all(ok(a).values())
    assert ok(a.limit(1)) == {"same_rows": False, "no_identity_twice": True, "same_payloads": False, "no_null_day": True}
    twice = spark.createDataFrame([(1, "x", "d"), (1, "x", None)], "k int, v string, day string")
    assert ok(twice) == {"same_rows": True, "no_identity_twice": False, "same_payloads": False, "no_null_day": False}


OBSERVED = "product_id string, product_name string, price decimal(10,2), effective_from timestamp, source_kafka_timestamp timestamp, is_snapshot boolean"


def test_product_versions_from_snapshots_and_history(spark):
    from datetime import UTC, datetime
    from decimal import Decimal as D

    t = lambda d: datetime(2026, 1, d, tzinfo=UTC)
    data = [
        ("a", None, D(800), t(1), t(1), False), ("a", "Pen", D(1000), None, t(5), True),  # two intervals
        ("b", None, D(5), t(1), t(1), False), ("b", "Cup", D(5), None, t(4), True),  # an equal snapshot opens none
        ("c", None, D(5), t(2), t(2), False), ("c", "Jar", D(6), None, t(2), True),  # at one instant the snapshot wins
        ("d", "New", D(9), None, t(3), True), ("d", "Newer", D(9), None, t(6), True),  # no history; the latest name
    ]
    v = models.build_product_versions(spark.createDataFrame(data, OBSERVED))
    day = lambda us: None if us is None else (us - 1_767_225_600_000_000) // 86_400_000_000 + 1
    got = sorted((r.product_id, int(r.price), day(r.start), day(r.stop) or 0, r.product_name) for r in v.collect())
    assert got == [("a", 800, 1, 5, "Pen"), ("a", 1000, 5, 0, "Pen"), ("b", 5, 1, 0, "Cup"), ("c", 6, 2, 0, "Jar"), ("d", 9, 3, 0, "Newer")]
    assert models.build_product_versions(spark.createDataFrame([], OBSERVED)).count() == 0


def test_facts_of_unknown_keys_keep_their_rows(spark):
    f = spark.createDataFrame([(1, 10), (2, None), (3, 99)], "i int, user_sk bigint")
    u = spark.createDataFrame([(10, "x"), (-1, "unknown")], "user_sk bigint, name string")
    assert rows(models.with_member(f, u, "user_sk", -1).na.fill("-"), "i", "user_sk", "name") == [(1, 10, "x"), (2, -1, "-"), (3, -1, "-")]


def test_days_without_a_folder_are_skipped_and_told(spark, tmp_path):
    from datetime import datetime

    base, said = str(tmp_path), []
    spark.range(3).write.parquet(bronze.topic_path(base, "a.b", day="2026-01-02"))
    span = (datetime(2026, 1, 1), datetime(2026, 1, 3))
    assert bronze.read_days(spark, base, "a.b", *span, log=said.append).count() == 3 and len(said) == 1
    assert bronze.read_days(spark, base, "none", *span) is None
