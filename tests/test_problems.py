"""The core's data problems against brute force, and their edge cases."""

from __future__ import annotations

import json
import random
from datetime import UTC, datetime, timedelta

import brute
import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidewell.functions.instants import with_parsed, with_utc
from tidewell.operators import asof, changefeed, exactly_once, history, late_events, orphans, slices, timestamps

SMALL = "/root/testdata/sf0.001"
EVENT = "event_key string, event_timestamp string, ingested_at string, kafka_timestamp timestamp, origin_zone string"

@pytest.fixture
def many_slices(spark):
    """As on large data: small partitions aren't put together again."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


TEXTS = [
    "2025-10-01T10:46:44.072Z", "2025-10-01T15:27:11", "2025-10-01T17:08:06.813+02:00", "1759339067739", "1759331351.349", "1759419624779441",
    "2025-10-02 13:36:56 +0100", "02/10/2025 04:22:02", "22/10/2025 04:22:02", "10/22/2025 04:22:02", "05/05/2025 01:02:03", "31/31/2025 01:02:03", "03.10.2025 14:41",
    "Thu, 02 Oct 2025 02:56:21 +0530", "2025-10-02T11:52:00+00", "20251001T111751Z", "Oct 10, 2025 4:01:48 PM", "Oct 1, 2025 12:01:48 AM", "Oct 1, 2025 13:01:48 AM",
    "2025-10-01t17:32:14,176z", "2025-10-01 18:02:53 UTC", " 2025-10-01 21:35:50 GMT", "2025-10-03 16:39:12 Asia/Tehran", "2025-10-02T02:49:21+03:30[Asia/Tehran]",
    "2025-10-04T12:55:00+00:00[UTC]", "2026-13-05 10:00:00", "2025-11-31 07:15:00", "2026-02-29T10:00:00Z", "T12:30:00Z", "null", "25:61", "", "-", "2026-04-1x 09:00:00",
    "0000-00-00T00:00:00", None, "2025-10-01", "2025-10-01 10:00:00 Foo/Bar", "2025-10-01T24:00:00Z", "2025-10-26T02:30:00 Europe/Berlin", "2026-03-29T02:30:00 Europe/Berlin",
    "2025-10-26T01:30:00", "2026-03-29T01:30:00", "2026-04-05T01:45:00", "2025-10-05T02:15:00", "x" * 20_000,
]


@pytest.mark.parametrize("zone", ["UTC", "Europe/London", "Australia/Lord_Howe", "Asia/Tehran"])
def test_instants_of_all_notations(spark, zone):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "i int, v string")
    got = dict(rows(with_utc(with_parsed(df, {"p": "v"}), {"us": ("p", F.lit(zone))}), "i", "us"))
    assert got == {i: brute.instant(t, zone) for i, t in enumerate(TEXTS)}


def _events(spark):
    cols = ["event_key", "event_timestamp", "ingested_at", "kafka_timestamp", "origin_zone"]
    df = spark.read.parquet(f"{SMALL}/fact_behavioral_event.parquet").select(*cols)
    us = df.select(*cols[:3], F.unix_micros("kafka_timestamp").alias("kafka_timestamp"), "origin_zone").collect()
    back = lambda x: None if x is None else brute.EPOCH + timedelta(microseconds=x)
    return df, [r.asDict() | {"kafka_timestamp": back(r.kafka_timestamp)} for r in us]


def test_p4_and_p1_match_brute_force(spark):
    from tidewell.plans import problems

    _, events = _events(spark)
    assert {tuple(r) for r in problems.p4_found(spark, SMALL).collect()} == brute.p4(events)
    assert {tuple(r) for r in problems.p1_found(spark, SMALL).collect()} == brute.p1(events)


def test_instants_keep_rows_and_foreign_columns(spark):
    data = [("a", "2025-10-01T10:00:00", None, None, None, 1), ("a", "2025-10-01T10:00:00", None, None, None, 1), (None, None, None, None, "Nowhere/Town", 2)]
    df = spark.createDataFrame(data, EVENT + ", __zone int")
    out = timestamps.with_instants(df.withColumnRenamed("__zone", "zone"))
    assert out.count() == 3 and "zone" in out.columns
    assert timestamps.with_instants(spark.createDataFrame([], EVENT)).count() == 0


@pytest.mark.parametrize("n", [15, 300])
def test_offset_history_is_estimated_for_writers_without_zone(spark, n):
    """The same for few values and many; a declared zone stays and is reported next
    to its estimate."""
    base = datetime(2025, 11, 3, 12, tzinfo=UTC)
    data = []
    for i in range(n):
        at = base + timedelta(hours=i)
        local = (at + timedelta(hours=3, minutes=30)).strftime("%Y-%m-%dT%H:%M:%S")
        data += [("a", local, z, at + timedelta(seconds=5)) for z in (None, "Europe/Berlin", "Asia/Tehran")]
    df = spark.createDataFrame(data, "k string, v string, z string, a timestamp")
    votes = timestamps.zone_votes(with_parsed(df, {"p": "v"}), "p", "z", F.col("a"))
    got = {r.writer: (r.declared, r.estimated, r.zone) for r in timestamps.offset_histories(votes, timestamps.candidate_zones(df, "z")).collect()}
    assert got == {
        "Europe/Berlin": ("Europe/Berlin", "Asia/Tehran", "Europe/Berlin"), "Asia/Tehran": ("Asia/Tehran",) * 3, timestamps.UNDECLARED: (None, "Asia/Tehran", "Asia/Tehran"),
    }
    out = timestamps.with_instants(df.select(F.lit("e").alias("event_key"), F.col("v").alias("event_timestamp"), F.lit(None).cast("string").alias("ingested_at"), F.col("z").alias("origin_zone"), F.col("a").alias("kafka_timestamp")))
    late = F.unix_micros("kafka_timestamp") - F.col("event_timestamp_us")
    assert out.filter("origin_zone is null or origin_zone = 'Asia/Tehran'").filter(late != 5_000_000).count() == 0


def test_few_values_do_not_move_a_writer_without_zone(spark):
    at = datetime(2025, 11, 3, 12, tzinfo=UTC)
    df = spark.createDataFrame([("2025-11-03T15:29:55", None, at), ("2025-11-03T11:59:58", "Asia/Tehran", at)], "v string, z string, a timestamp")
    votes = timestamps.zone_votes(with_parsed(df, {"p": "v"}), "p", "z", F.col("a"))
    assert {r.writer: r.zone for r in timestamps.offset_histories(votes, timestamps.candidate_zones(df, "z")).collect()}[timestamps.UNDECLARED] == "UTC"


@pytest.mark.usefixtures("many_slices")
def test_k_slack_states_and_values(spark):
    h = 3_600_000_000
    data = [("a", 10 * h, 11 * h), ("b", 20 * h, 25 * h), ("b", 20 * h, 60 * h), ("c", 23 * h, 95 * h), ("d", 23 * h, 95 * h + 1), ("e", 30 * h, 10 * h), ("f", None, 5), ("g", 15 * h, 15 * h)]
    df = spark.createDataFrame(data, "k string, e bigint, a bigint")
    b = late_events.buffer_events(df, F.col("e"), F.col("a"))
    assert dict(rows(b.filter("k not in ('b')"), "k", "state")) == {"a": "in_period", "c": "correction", "d": "rejected", "e": "in_period", "f": "untimed", "g": "in_period"}
    assert rows(late_events.corrections(b, "k")) == [("b", 19700101), ("c", 19700101)]
    days = rows(late_events.provisional(b, "k").filter("period = 0"), "epoch", "events", "total")
    # "b" came again on the day after its first copy: the same total is published again.
    assert days == [(0, 2, 2), (24 * h, 1, 3), (48 * h, 0, 3), (72 * h, 1, 4)]
    assert rows(late_events.rejected(b, "k")) == [("d", 19700101, 72)]
    assert late_events.corrections(b.limit(0), "k").count() == late_events.release(b.limit(0), "k").count() == 0
    final = {r.date_sk: r for r in late_events.release(b, "k").collect()}
    assert (final[19700101].n_events, final[19700101].first_key, final[19700101].last_key, final[19700101].longest_pause_us) == (4, "a", "c", 5 * h)


def _runs(points):
    out = []
    for k in sorted({k for k, _, _ in points}):
        seq = sorted((t, v) for kk, t, v in points if kk == k)
        starts = [(t, v) for i, (t, v) in enumerate(seq) if i == 0 or seq[i - 1][1] != v]
        out += [(k, v, t, starts[i + 1][0] if i + 1 < len(starts) else None) for i, (t, v) in enumerate(starts)]
    return out


@pytest.mark.usefixtures("many_slices")
@pytest.mark.parametrize("leaf", [5, 16, 40])
def test_tree_reduction_equals_a_scan(spark, leaf):
    rnd = random.Random(leaf)
    points = [(k, t, rnd.choice([1, 1, 2, None])) for k in ("hot", "b", "c") for t in rnd.sample(range(500), 200 if k == "hot" else 7)]
    df = spark.createDataFrame(points, "k string, t bigint, v int")
    key = lambda x: tuple((a is None, a or 0) if i else a for i, a in enumerate(x))
    got = sorted((tuple(r) for r in history.coalesce_runs(df, "k", "t", "v", leaf).select("k", "v", "start", "stop").collect()), key=key)
    assert got == sorted(_runs(points), key=key)


def test_an_outlier_in_time_adds_no_rounds(spark):
    day = 86_400_000_000
    points = [("a", i * day, i // 3) for i in range(40)] + [("a", -719_162 * day, 7), ("b", 2_932_896 * day, 1)]
    df = spark.createDataFrame(points, "k string, t bigint, v int")
    out = history.coalesce_runs(df, "k", "t", "v")
    assert {tuple(r) for r in out.select("k", "v", "start", "stop").collect()} == set(_runs(points))
    assert out._jdf.queryExecution().executedPlan().toString().count("Exchange") <= 24


def test_history_of_nothing(spark):
    df = spark.createDataFrame([], "k string, t bigint, v int")
    assert history.coalesce_runs(df, "k", "t", "v").count() == 0
    df = spark.createDataFrame([(None, 1, 1), ("a", None, 1)], "k string, t bigint, v int")
    assert history.coalesce_runs(df, "k", "t", "v").count() == 0


def test_exactly_once_keeps_one_copy_and_all_rows_without_id(spark, tmp_path):
    t = lambda h: datetime(2025, 10, 1, h, tzinfo=UTC)
    data = [("o1", t(1), 1), (" O1\t", t(3), 2), ("O1", None, 3), ("o2", None, 4), ("o2", None, 5), (None, t(1), 6), (" ", t(1), 7), ("o3", t(2), 8)]
    path = str(tmp_path / "t")
    spark.createDataFrame(data, "id string, at timestamp, n int").repartition(3).write.parquet(path)
    for limit in (exactly_once.BROADCAST_BYTES, 4096):
        got = exactly_once.exactly_once(spark, path, "id", "at", broadcast_bytes=limit)
        n = sorted(r.n for r in got.collect())
        assert [x for x in n if x not in (4, 5)] == [2, 6, 7, 8] and len(n) == 5
    slim = exactly_once.positions(spark.read.parquet(path), "id", "at")
    assert rows(exactly_once.repeated(slim)) == [("O1",), ("O2",)]
    empty = str(tmp_path / "e")
    spark.createDataFrame([], "id string, at timestamp, n int").write.parquet(empty)
    assert exactly_once.exactly_once(spark, empty, "id", "at").count() == 0


def test_losers_are_the_rows_that_exactly_once_drops(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(rnd if rnd % 4 else None, rnd % 9, i) for i, rnd in enumerate(range(60))], "k int, at int, n int")
    df = df.select(F.concat(F.lit("o"), (F.col("k") % 11).cast("string")).alias("id"), F.col("at"), F.col("n"))
    df.repartition(3).write.parquet(path)
    for limit in (exactly_once.BROADCAST_BYTES, 4096):
        kept, lost = ([r.n for r in exactly_once.exactly_once(spark, path, "id", "at", broadcast_bytes=limit, losers=x).collect()] for x in (False, True))
        assert sorted(kept + lost) == list(range(60)) and len(lost) == 45 - 11
    once = str(tmp_path / "o")
    spark.createDataFrame([("a", 1)], "id string, at int").write.parquet(once)
    assert exactly_once.exactly_once(spark, once, "id", "at", losers=True).count() == 0


def test_p3_uses_the_vectors_and_returns_whole_rows(spark, monkeypatch):
    from tidewell.plans import problems

    built, real = [], exactly_once.deletion_vectors
    monkeypatch.setattr(exactly_once, "deletion_vectors", lambda slim: built.append(1) or real(slim))
    assert problems.p3_found(spark, SMALL).count() > 0 and len(built) == 2
    whole, slim = problems.p3_exactly_once_rows(spark, SMALL), problems.p3_exactly_once(spark, SMALL)
    for name, key in problems._P3:
        assert set(spark.read.parquet(f"{SMALL}/{name}.parquet").columns) <= set(whole.columns)
        same = whole.filter(F.col("table_name") == name).select(exactly_once.norm_id(key), F.unix_micros("source_kafka_timestamp"))
        old = slim.filter(F.col("table_name") == name).select("message_id", "delivered_us")
        assert same.exceptAll(old).count() == old.exceptAll(same).count() == 0


@pytest.mark.usefixtures("many_slices")
def test_orphans_by_runs_equal_brute_force(spark):
    rnd = random.Random(2)
    t = lambda h: datetime(2025, 10, 1, tzinfo=UTC) + timedelta(hours=h)
    some = lambda: rnd.choice([None, *(t(i) for i in range(5))])
    parents = [(k, some()) for k in [*range(10, 40), *range(12, 20), 2**62, -(2**62), None]]
    refs = [(rnd.choice(["a ", "A", "b", None, "", "c", "d"]), rnd.choice([*range(5, 45), 2**62, 2**61, -(2**63), 2**63 - 1, None]), some()) for _ in range(400)]
    stones = {k: t(rnd.randrange(6)) for k in (11, 13, 7, 2**61, 30)}
    r = spark.createDataFrame(refs, "id string, ref bigint, at timestamp").withColumn("key", exactly_once.norm_id("id"))
    p = spark.createDataFrame(parents, "k bigint, at timestamp")
    g = spark.createDataFrame(list(stones.items()), "key bigint, gone_at timestamp")
    for hot_rows in (1, 3, 10**6):
        got = orphans.find_orphans(r, "ref", "key", "at", p, "k", "at", g, hot_rows=hot_rows)
        assert {tuple(x) for x in got.collect()} == brute.p5(refs, parents, stones)
    none = spark.createDataFrame([], "k bigint, at timestamp")
    assert {x.orphan_kind for x in orphans.find_orphans(r, "ref", "key", "at", none, "k", "at", g).collect()} == {"missing", "deleted"}


@pytest.mark.usefixtures("many_slices")
def test_no_cut_parts_a_reference_from_its_parent(spark):
    """Many slices over keys that all have both."""
    k = spark.range(4_000).select((F.col("id") * 3).alias("key"))
    at = F.lit(None).cast("timestamp")
    met = orphans.match_runs(k.select("key", at.alias("first"), at.alias("last")), k.select("key", at.alias("least")))
    assert met.filter("not has_parent").count() == 0 and met.count() == 4_000


def test_key_runs_compress_neighbours(spark):
    p = spark.createDataFrame([(k, None) for k in [1, 2, 3, 3, 7, 8, None]], "k bigint, t timestamp")
    runs = orphans.key_runs(orphans.parent_ages(p, "k", "t").coalesce(1))
    assert sum(r.n_keys for r in runs.collect()) == 5
    assert all(r.stop - r.start + 1 == r.n_keys for r in runs.collect())


@pytest.mark.usefixtures("many_slices")
def test_a_sentinel_key_does_not_gather_the_others(spark):
    p = spark.range(100_000).select(F.col("id").alias("key"), F.lit(None).cast("timestamp").alias("first"), F.lit(None).cast("timestamp").alias("last"))
    p = p.unionByName(p.limit(1).withColumn("key", F.lit(2**62)))
    sizes = [r["count"] for r in slices.ordered_slices(p, ["key"]).groupBy("slice").count().collect()]
    assert len(sizes) > 1 and max(sizes) < 60_000


@pytest.mark.parametrize("hot_rows", [2, 1000])
def test_hot_keys_join_the_same_in_several_tasks(spark, hot_rows):
    left = spark.createDataFrame([("hot", i) for i in range(50)] + [("b", 1), ("c", 2), (None, 3)], "k string, x int")
    right = spark.createDataFrame([("hot", "H"), ("b", "B")], "k string, y string")
    counts = left.groupBy("k").agg(F.count("*").alias("n"))
    for how in ("inner", "left"):
        want = left.join(right, "k", how)
        got = slices.join_hot(left, right, "k", counts, how, hot_rows)
        assert want.count() == got.count() and want.exceptAll(got.select(want.columns)).count() == 0


def _apply(base, changes):
    state = {k: None for k in base}
    for k, lsn, op in sorted(set(changes), key=lambda c: c[1]):
        if op == "i":
            state[k] = lsn
        elif k in state:
            if op == "u":
                state[k] = lsn
            else:
                del state[k]
    return state


@pytest.mark.parametrize("block", [1, 3, 1 << 16])
def test_signed_multiset_equals_replay(spark, block):
    rnd = random.Random(block)
    base = ["A", "B", "HOT", "UNTOUCHED"]
    changes = [(rnd.choice(["A", "B", "C", "HOT", "HOT"]), lsn, rnd.choice("iuud")) for lsn in range(-3, 120)]
    sent = changes + rnd.sample(changes, 40)
    rnd.shuffle(sent)
    ops = {"i": [" Insert", "c"], "u": ["UPDATE ", "u"], "d": ["D", None]}
    raw = [("t", rnd.choice([k, f" {k.lower()}\n"]), lsn, ops[op][(lsn + i) % 2], None if op == "d" else "{}") for i, (k, lsn, op) in enumerate(sent)]
    raw += [("t", " ", 500, "i", "{}"), ("t", "A", None, "i", "{}"), ("t", "A", 501, "truncate", "{}")]
    c = changefeed.distinct_changes(spark.createDataFrame(raw, "table_name string, record_key string, commit_lsn bigint, op string, payload_json string"))
    b = spark.createDataFrame([("t", k) for k in base], "table_name string, record_key string")
    got = {r.record_key: r.commit_lsn for r in changefeed.current_images(c, b, block).collect()}
    assert got == _apply(base, changes)
    assert all(r.n in (0, 1) for r in changefeed.signed_images(c, b, block).groupBy("record_key", "version").agg(F.sum("n").alias("n")).collect())


def test_fields_follow_the_last_incarnation(spark):
    raw = [
        ("t", "A", 1, "u", '{"f":"x"}'), ("t", "A", 2, "u", '{"g":"y"}'), ("t", "B", 3, "d", None), ("t", "B", 4, "i", '{"f":"n"}'), ("t", "B", 5, "u", '{"f":"m"}'),
    ]
    c = changefeed.distinct_changes(spark.createDataFrame(raw, "table_name string, record_key string, commit_lsn bigint, op string, payload_json string"))
    b = spark.createDataFrame([("t", "A", "f0", "g0"), ("t", "B", "f0", "g0"), ("t", "C", "f0", "g0")], "table_name string, record_key string, f string, g string")
    live = changefeed.current_images(c, b.select("table_name", "record_key"))
    assert sorted(tuple(r) for r in changefeed.current_fields(c, b, live, ["f", "g"]).fillna("-", ["f", "g"]).collect()) == [
        ("t", "A", 2, "x", "y"), ("t", "B", 5, "m", "-"), ("t", "C", None, "f0", "g0"),
    ]


def test_a_null_in_the_payload_is_a_value(spark):
    raw = [
        ("t", "A", 1, "u", '{"f":null}'), ("t", "B", 2, "u", '{"f":"x"}'), ("t", "B", 3, "u", '{"f":null,"g":"y"}'), ("t", "C", 4, "u", '{"f":null}'), ("t", "C", 5, "u", '{"f":"z"}'),
    ]
    c = changefeed.distinct_changes(spark.createDataFrame(raw, "table_name string, record_key string, commit_lsn bigint, op string, payload_json string"))
    b = spark.createDataFrame([("t", k, "f0", "g0") for k in "ABCD"], "table_name string, record_key string, f string, g string")
    live = changefeed.current_images(c, b.select("table_name", "record_key"))
    assert sorted(tuple(r) for r in changefeed.current_fields(c, b, live, ["f", "g"]).fillna("-", ["f", "g"]).collect()) == [
        ("t", "A", 1, "-", "g0"), ("t", "B", 3, "-", "y"), ("t", "C", 5, "z", "g0"), ("t", "D", None, "f0", "g0"),
    ]


def _replay(spark, folder):
    """Current rows of problem 6: every change applied to a dict, one after another."""
    tables = {
        "dim_user": ("user_id", ["username", "device", "loyalty_tier", "location"]),
        "fact_order": ("order_id", ["order_total", "status", "payment_method"]),
        "fact_return_refund": ("return_refund_id", ["refund_amount", "return_reason"]),
    }
    state, latest = {}, {}
    for name, (key, fields) in tables.items():
        df = spark.read.parquet(f"{folder}/{name}.parquet")
        for r in df.select(key, F.unix_micros("source_kafka_timestamp").alias("at"), *[F.col(f).cast("string") for f in fields]).collect():
            k, row = (name, brute.norm(r[key])), {f: r[f] for f in fields}
            rank = [(x is not None, x or 0) for x in [r["at"]]] + [(x is not None, x or "") for x in row.values()]
            if k[1] is not None and (k not in latest or rank > latest[k]):
                latest[k], state[k] = rank, (None, row)
    ops = {"i": "i", "insert": "i", "c": "i", "create": "i", "u": "u", "update": "u", "d": "d", "delete": "d"}
    sent = spark.read.parquet(f"{folder}/raw_change.parquet").select("table_name", "record_key", "commit_lsn", "op", "payload_json").collect()
    for r in sorted((r for r in sent if r.commit_lsn is not None), key=lambda r: r.commit_lsn):
        op, payload = (r.op or "").strip().lower(), (r.payload_json or "").strip()
        what = "d" if not op and not payload else ops.get(op)
        k = (r.table_name, brute.norm(r.record_key))
        if k[1] is None or what is None:
            continue
        new = {f: v for f, v in json.loads(payload or "{}").items() if f in tables[r.table_name][1]}
        if what == "i":
            state[k] = (r.commit_lsn, dict.fromkeys(tables[r.table_name][1]) | new)
        elif what == "d":
            state.pop(k, None)
        elif k in state:
            state[k] = (r.commit_lsn, state[k][1] | new)
    return state


def test_current_state_equals_a_replay_of_all_fields(spark):
    from tidewell.plans import problems

    want = _replay(spark, SMALL)
    names = sorted({f for _, row in want.values() for f in row})
    got = {(r.table_name, r.record_key): r for r in problems.p6_current_state(spark, SMALL).collect()}
    assert {k: (r.commit_lsn, *(r[f] for f in names)) for k, r in got.items()} == {k: (lsn, *(row.get(f) for f in names)) for k, (lsn, row) in want.items()}


@pytest.mark.parametrize("hot_rows", [5, 40, 200_000])
def test_asof_equals_brute_force(spark, hot_rows):
    rnd = random.Random(hot_rows)
    versions = [(rnd.choice(["hot", "hot", "b", None]), rnd.randrange(60), rnd.choice([None, rnd.randrange(80)]), i, rnd.choice([True, False])) for i in range(60)]
    events = [(rnd.choice(["hot", "hot", "b", "none", None]), rnd.choice([None, *range(-5, 70)]), i) for i in range(150)]
    v = spark.createDataFrame(versions, "entity string, start_us bigint, stop_us bigint, version_id bigint, snap boolean")
    e = spark.createDataFrame(events, "entity string, at_us bigint, i int")
    want = set()
    for k, t, i in events:
        fit = [x for x in versions if k is not None and t is not None and x[0] == k and x[1] <= t]
        best = max(fit, key=lambda x: (x[1], x[4], 1 << 62 if x[2] is None else x[2], x[3]), default=None)
        want.add((i, best and best[3]))
    got = asof.asof_versions(e, v, [F.col("snap")], buckets=3, hot_rows=hot_rows)
    assert sorted((r.i, r.version_id) for r in got.collect()) == sorted(want)
    assert asof.asof_versions(e.limit(0), v, [F.col("snap")], buckets=3).count() == 0
    assert asof.asof_versions(e, v.limit(0), [F.col("snap")], buckets=3).filter("version_id is null").count() == 150


@pytest.mark.parametrize("hot_rows", [5, 200_000])
def test_asof_uses_no_version_before_it_was_known(spark, hot_rows):
    rnd = random.Random(hot_rows)
    versions = [("a", rnd.randrange(40), rnd.choice([None, rnd.randrange(80)]), i, rnd.choice([True, False]), rnd.choice([None, rnd.randrange(60)])) for i in range(50)]
    events = [("a", rnd.randrange(70), i) for i in range(80)] + [("a", 30, 100 + i) for i in range(40)]
    v = spark.createDataFrame(versions, "entity string, start_us bigint, stop_us bigint, version_id bigint, snap boolean, known_us bigint")
    e = spark.createDataFrame(events, "entity string, at_us bigint, i int")
    want = set()
    for _, t, i in events:
        fit = [x for x in versions if max(x[1], x[1] if x[5] is None else x[5]) <= t]
        best = max(fit, key=lambda x: (x[1], x[4], 1 << 62 if x[2] is None else x[2], x[3]), default=None)
        want.add((i, best and best[3]))
    got = asof.asof_versions(e, v, [F.col("snap")], buckets=3, hot_rows=hot_rows)
    assert sorted((r.i, r.version_id) for r in got.collect()) == sorted(want)
