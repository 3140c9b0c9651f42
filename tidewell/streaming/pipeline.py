"""Structured Streaming ingest: source, decode, day columns, idempotent sink."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidewell.operators.quality import require


def normalize_name(name: str) -> str:
    """Lower case, with _ for everything but letters, digits and hyphens."""
    out = re.sub(r"[^a-z0-9\-]+", "_", (name or "").strip().lower()).strip("_")
    if not out:
        raise ValueError("name must not be empty")
    return out


def checkpoint_path(base: str, topic: str, query: str, version: str = "v1") -> str:
    """``<base>/<query>/<topic>/<version>``."""
    if not (base or "").strip():
        raise ValueError("base must not be empty")
    return "/".join([base.strip().rstrip("/"), *(normalize_name(p) for p in (query, topic, version))])


def with_day(df: DataFrame, field: str, fallback: str = "ingested_at", out: str = "ingest_date") -> DataFrame:
    """Adds the UTC day of ``field``, read by its type: timestamps and dates as
    they are, integers as epoch seconds or, from 1e11 on, milliseconds, strings
    by the timestamp reader (text without zone is UTC); where that gives nothing,
    the day of ``fallback``."""
    from tidewell.functions.instants import with_parsed, with_utc

    require(df, [field, fallback])
    kind = df.schema[field].dataType
    names = df.columns
    c = F.col(field)
    if isinstance(kind, T.StringType):
        d = with_utc(with_parsed(df, {"__p": field}), {"__us": ("__p", F.lit("UTC"))})
        at = F.timestamp_micros("__us")
    elif isinstance(kind, T.IntegralType):
        d, at = df, F.when(F.abs(c) >= 100_000_000_000, F.timestamp_millis(c)).otherwise(F.timestamp_seconds(c))
    else:
        d, at = df, c.cast("timestamp")
    return d.select(*names, F.to_date(F.coalesce(at, F.col(fallback).cast("timestamp"))).alias(out))


def pack_event_data(df: DataFrame, common: list[str], optional: list[str], envelope: list[str], out: str = "event_data") -> DataFrame:
    """Envelope and common fields first, all present optional fields in a struct."""
    require(df, [*envelope, *common])
    there = [c for c in optional if c in df.columns]
    return df.select(*envelope, *common, (F.struct(*there) if there else F.lit(None)).alias(out))


def unpack_event_data(df: DataFrame, data: str = "event_data", rename: dict[str, str] | None = None) -> DataFrame:
    """The struct's fields as columns after the others, renamed where asked (such as
    query to search_query). A field that is already a column gives way to it."""
    rename = rename or {}
    kind = require(df, [data]).schema[data].dataType
    names = [] if not isinstance(kind, T.StructType) else kind.names
    own = [c for c in df.columns if c != data]
    return df.select(*own, *[F.col(data)[n].alias(rename.get(n, n)) for n in names if rename.get(n, n) not in own])


def idempotent_writer(path: str, partition_by: str = "ingest_date", batch_column: str = "batch_id") -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that writes each micro-batch to its own folder by
    overwriting it whole: a batch that is replayed after a failure replaces what it
    wrote before, also where it now has other days, and rows are evaluated once.
    Null days raise. Readers see the folder's name as ``batch_column``."""

    def write(df: DataFrame, batch_id: int) -> None:
        marked = df.withColumn(partition_by, F.coalesce(F.col(partition_by), F.raise_error(F.lit(f"null {partition_by}")).cast("date")))
        marked.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(partition_by).parquet(f"{path}/{batch_column}={batch_id}")

    return write


def start_topic(stream: DataFrame, path: str, checkpoint: str, name: str, available_now: bool = False) -> StreamingQuery:
    """Starts the append of a stream that has an ``ingest_date``."""
    require(stream, ["ingest_date"])
    w = stream.writeStream.queryName(name).outputMode("append").option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    return w.foreachBatch(idempotent_writer(path)).start()


def build_stream(
    topic: str,
    source: Callable[[str], DataFrame],
    decode: Callable[[DataFrame, str], DataFrame | None],
    path: str,
    checkpoints: str,
    day_field: str = "ingested_at",
    group: Callable[[DataFrame], DataFrame] | None = None,
    available_now: bool = False,
) -> StreamingQuery | None:
    """One topic from source to sink: read, decode, group (such as packing event
    data), day column, idempotent append. None where the topic has no schema; an
    empty topic or path raises before anything is read."""
    for name, value in (("topic", topic), ("path", path), ("checkpoints", checkpoints)):
        if not (value or "").strip():
            raise ValueError(f"{name} must not be empty")
    decoded = decode(source(topic), topic)
    if decoded is None:
        return None
    shaped = group(decoded) if group else decoded
    return start_topic(with_day(shaped, day_field), path, checkpoint_path(checkpoints, topic, "ingest"), f"ingest_{normalize_name(topic)}", available_now)


def supervise(
    spark: SparkSession | None, topics: list[str], build: Callable[[str], StreamingQuery | None], log: Callable[[str], None] = print, await_any: bool = False
) -> list[StreamingQuery]:
    """Starts a query for each topic. A topic that has no schema (None) or fails
    is logged and the others run; an error is raised only if none could start.
    ``await_any`` blocks until the first of them ends."""
    running: list[StreamingQuery] = []
    for t in topics:
        try:
            q = build(t)
        except Exception as e:  # noqa: BLE001
            log(f"{t}: {e}")
            continue
        if q is None:
            log(f"{t}: no schema, skipped")
        else:
            running.append(q)
    if not running:
        raise RuntimeError("no topic could be started")
    if await_any:
        spark.streams.awaitAnyTermination()
    return running


def k_slack_stream(events: DataFrame, event_time: str, key: str, slack: str = "72 hours", final: bool = True, arrival: str | None = None) -> DataFrame:
    """(day, events, first, last) by UTC day. The watermark is the slack and its
    state the buffer; records that come later are dropped by it.

    An event can't have happened after it arrived: times beyond ``arrival`` (the
    clock of processing, where no column is named) count as of their arrival, so
    one clock in the future doesn't end the buffer of all others.

    final  for append mode: distinct events, once the slack of the day has passed
    not    for update mode: the provisional value each time records change it;
           redelivered rows count again, as update mode allows no second state"""
    e = events.withColumn(event_time, F.least(F.col(event_time), F.col(arrival) if arrival else F.current_timestamp()))
    e = e.withWatermark(event_time, slack)
    if final:
        e = e.dropDuplicatesWithinWatermark([key])
    by_day = e.groupBy(F.window(event_time, "1 day")).agg(F.count(F.lit(1)).alias("events"), F.min(event_time).alias("first"), F.max(event_time).alias("last"))
    return by_day.select(F.col("window.start").alias("day"), "events", "first", "last")


def session_stream(events: DataFrame, event_time: str, user: str, gap: str = "30 minutes", slack: str = "72 hours") -> DataFrame:
    """(user, started, ended, events) of sessions that a pause ends, for append mode."""
    w = events.withWatermark(event_time, slack).groupBy(F.session_window(event_time, gap), F.col(user)).agg(F.count(F.lit(1)).alias("events"))
    return w.select(user, F.col("session_window.start").alias("started"), F.col("session_window.end").alias("ended"), "events")
