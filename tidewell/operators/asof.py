"""Attributes as known at event time: embedded DuckDB ASOF joins per bucket.

Entities are hash-partitioned into buckets; in each bucket one DuckDB turns the
versions, ordered by when they became available, into current states (of what is
available, the version that starts last) and runs an ASOF LEFT JOIN of the events
against them. Before that, ties (several rows of one entity with one start) are
resolved.

An entity with very many rows is cut into time slices at quantiles of its own
times. Versions go to the slice they became available in, and each slice also gets
the state at its beginning, from one summary row a slice. Where a slice still has
too many events, as they share one instant, they are spread over salts and the
slice's versions go to each. So no hot entity's rows meet in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: An entity with more rows than this is cut into slices, a slice into salts.
HOT_ROWS = 200_000
#: Slices of a hot entity, and the bytes of events that one bucket is to hold.
SLICES, BUCKET_BYTES = 256, 64 << 20

_JOIN = """
    WITH states AS (
        SELECT entity, __slice, available_us,
            max({'start_us': start_us, 'prio': prio, 'stop_us': coalesce(stop_us, 9223372036854775807), 'version_id': version_id})
                OVER (PARTITION BY entity, __slice ORDER BY available_us RANGE UNBOUNDED PRECEDING) AS v
        FROM versions
    )
    SELECT e.* EXCLUDE (entity, __slice), s.v.version_id AS version_id, s.v.start_us AS start_us, nullif(s.v.stop_us, 9223372036854775807) AS stop_us
    FROM events e ASOF LEFT JOIN states s
      ON e.entity = s.entity AND e.__slice = s.__slice AND e.at_us >= s.available_us
"""


def resolve_ties(versions: DataFrame, rank: list[Column]) -> DataFrame:
    """(entity, start_us, available_us, stop_us, version_id, prio): one row for each
    entity, start and time of availability, that of the highest ``rank``; equal
    ranks go to the later stop (open is the latest) and then the higher id. Of
    several times of availability for one start, ``prio`` says whose row counts
    once both are available."""
    order = F.struct(
        *[r.alias(f"r{i}") for i, r in enumerate(rank)],
        F.coalesce("stop_us", F.lit((1 << 63) - 1)).alias("s"),
        F.col("version_id"),
        F.col("stop_us"),
    )
    known = F.col("known_us") if "known_us" in versions.columns else F.lit(None).cast("bigint")
    one = (
        versions.filter("entity is not null and start_us is not null")
        .groupBy("entity", "start_us", F.greatest("start_us", known).alias("available_us"))
        .agg(F.max(order).alias("best"))
    )
    if "known_us" in versions.columns:
        prio = F.row_number().over(W.partitionBy("entity", "start_us").orderBy("best"))
    else:
        prio = F.lit(1)
    return one.select("entity", "start_us", "available_us", "best.stop_us", "best.version_id", prio.alias("prio"))


def _hot(events: DataFrame, versions: DataFrame, hot_rows: int) -> DataFrame:
    """(hot, cuts): entities above ``hot_rows`` with the times that cut them into
    slices; at most rows / hot_rows of them, small next to any bucket. Quantiles are
    taken of those entities only."""
    t = events.select("entity", F.col("at_us").alias("t")).unionByName(versions.select("entity", F.col("available_us").alias("t")))
    many = t.groupBy("entity").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > hot_rows).select(F.col("entity").alias("hot"))
    cuts = F.percentile_approx("t", [i / SLICES for i in range(1, SLICES)], 4 * SLICES)
    return t.join(F.broadcast(many), F.col("entity") == F.col("hot")).groupBy("hot").agg(cuts.alias("cuts"))


def _join_bucket(left, right, schema):  # noqa: ANN001, ANN202
    import duckdb

    # A bucket fits in memory; nothing is ever written to the worker's own disk.
    con = duckdb.connect(config={"threads": 1, "temp_directory": "", "memory_limit": "600MB"})
    try:
        con.execute("SET preserve_insertion_order=false")
        con.register("events", left)
        con.register("versions", right)
        return con.sql(_JOIN).to_arrow_table().select(schema.names).cast(schema)
    finally:
        con.close()


def _bytes(df: DataFrame) -> int:
    """The optimizer's estimate of a frame's size; no job."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def asof_versions(events: DataFrame, versions: DataFrame, rank: list[Column], buckets: int | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Every event (entity, at_us, <other columns>) with version_id, start_us and
    stop_us of the version that started last of those that started and were known
    at or before ``at_us``; nulls where there is none, the entity is null or the
    event has no time. No event is lost or doubled. Whether the version had ended
    by then is for the caller to say.

    events      columns of the three result names are replaced
    versions    (entity, start_us, stop_us, version_id, <columns of rank>) and
                optionally known_us, when the version became known; without it,
                or where it is null, a version counts from its start
    buckets     None: by the events' size, 64 MB each, at least the session's
                shuffle partitions"""
    from pyspark.sql.pandas.types import to_arrow_schema

    from tidewell.session import parallelism

    events = events.drop("version_id", "start_us", "stop_us")
    if buckets is None:
        buckets = max(parallelism(events.sparkSession), min(100_000, _bytes(events) // BUCKET_BYTES))
    tied = resolve_ties(versions, rank)
    null = F.lit(None).cast("bigint")
    out_schema = events.select(*[c for c in events.columns if c != "entity"], null.alias("version_id"), null.alias("start_us"), null.alias("stop_us")).schema
    arrow = to_arrow_schema(out_schema)
    timed = events.select("entity", "at_us").filter("entity is not null and at_us is not null")
    hot = F.broadcast(_hot(timed, tied, hot_rows))

    def sliced(df: DataFrame, t: str, how: str = "left") -> DataFrame:
        at = F.coalesce(F.size(F.filter("cuts", lambda c: c <= F.col(t))), F.lit(0))
        return df.join(hot, F.col("entity") == F.col("hot"), how).withColumn("__slice", F.when(F.col("cuts").isNull() | F.col(t).isNull(), 0).otherwise(at).cast("int"))

    # Slices that a burst of events at one instant leaves too large.
    bursts = sliced(timed, "at_us", "inner").groupBy("entity", "__slice").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > hot_rows)
    bursts = F.broadcast(bursts.select("entity", "__slice", F.ceil(F.col("n") / hot_rows).cast("int").alias("__salts")))
    spread = F.xxhash64(*[F.col(c) for c in events.columns])
    e = sliced(events, "at_us").drop("hot", "cuts").join(bursts, ["entity", "__slice"], "left")
    e = e.withColumn("__salt", F.coalesce(F.pmod(spread, F.col("__salts")).cast("int"), F.lit(0))).drop("__salts")

    columns = ["entity", "__slice", "available_us", "start_us", "stop_us", "version_id", "prio"]
    v = sliced(tied, "available_us")
    state = F.struct("start_us", "prio", "stop_us", "version_id")
    last = v.filter("hot is not null").groupBy("entity", "__slice").agg(F.max(state).alias("best"))
    grid = hot.select(F.col("hot").alias("entity"), F.explode(F.sequence(F.lit(0), F.lit(SLICES))).alias("__slice"))
    w = W.partitionBy("entity").orderBy("__slice").rowsBetween(W.unboundedPreceding, -1)
    carried = grid.join(last, ["entity", "__slice"], "left").withColumn("best", F.max("best").over(w)).filter("best is not null")
    carried = carried.select("entity", "__slice", F.lit(-(1 << 63)).alias("available_us"), "best.start_us", "best.stop_us", "best.version_id", "best.prio")
    v = v.select(*columns).unionByName(carried.select(*columns)).join(bursts, ["entity", "__slice"], "left")
    v = v.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.coalesce("__salts", F.lit(1)) - 1))).drop("__salts")
    # Events without entity or time match nothing; they are spread by their other columns.
    home = F.xxhash64("entity", "__slice", "__salt")
    e = e.withColumn("__bucket", F.pmod(F.when(F.col("entity").isNull(), spread).otherwise(home), F.lit(buckets))).drop("__salt")
    v = v.withColumn("__bucket", F.pmod(home, F.lit(buckets))).drop("__salt")

    def run(left, right):  # noqa: ANN001, ANN202
        return _join_bucket(left.drop_columns(["__bucket"]), right, arrow)

    return e.groupBy("__bucket").cogroup(v.groupBy("__bucket")).applyInArrow(run, out_schema)
