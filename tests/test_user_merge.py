"""The merges of the feed into dim_user, against brute force over all users and attributes."""

from __future__ import annotations

import json

import brute
import pytest
from pyspark.sql import functions as F

from tidewell.plans import star

SMALL = "/root/testdata/sf0.001"
TRACKED = ["username", "device", "loyalty_tier", "location"]
OPS = {"i": "i", "insert": "i", "c": "i", "create": "i", "u": "u", "update": "u"}


def merge_sides(spark, folder):
    """({user: row} of dim_user, {user: row} of the feed)"""
    target, rank = {}, {}
    for r in spark.read.parquet(f"{folder}/dim_user.parquet").select("user_id", *TRACKED, F.unix_micros("source_kafka_timestamp").alias("at")).collect():
        k, row = brute.norm(r.user_id), tuple(r[c] for c in TRACKED)
        at = [(x is not None, x if x is not None else 0 if i == 0 else "") for i, x in enumerate((r["at"], *row))]
        if k is not None and (k not in rank or at > rank[k]):
            rank[k], target[k] = at, row
    source = {}
    changes = spark.read.parquet(f"{folder}/raw_change.parquet").filter("table_name = 'dim_user' and commit_lsn is not null").collect()
    for r in sorted(changes, key=lambda r: r.commit_lsn):
        k, op = brute.norm(r.record_key), OPS.get((r.op or "").strip().lower())
        if k is None or op is None:
            continue
        sent = json.loads(r.payload_json or "{}")
        old = (None,) * 4 if op == "i" else source.get(k, target.get(k, (None,) * 4))
        source[k] = tuple(sent.get(c, o) for c, o in zip(TRACKED, old, strict=True))
    return target, source


@pytest.fixture(scope="module")
def sides(spark):
    return merge_sides(spark, SMALL)


def _rows(spark, name, *more):
    out = star.QUERIES[name](spark, SMALL).select("user_id", *TRACKED, *more).collect()
    assert len({r.user_id for r in out}) == len(out)
    return {r.user_id: tuple(r)[1:] for r in out}


def test_changes_of_every_attribute(spark, sides):
    target, source = sides
    want = {k: (*row, "update" if k in target else "insert") for k, row in source.items() if target.get(k) != row}
    assert _rows(spark, "scd1_user_changes", "change_type") == want


def test_every_user_stays_in_the_target(spark, sides):
    target, source = sides
    assert any(row[2] is None for row in target.values())
    assert _rows(spark, "upsert_insert_missing") == source | target
    assert _rows(spark, "upsert_update_always") == target | source
