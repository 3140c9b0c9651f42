"""Late and out-of-order events: K-slack reordering with provisional values.

Every event waits in a buffer until the lateness bound of its own event time has
passed (``event time + slack``); then it is released, in event-time order, to the
final aggregation (``release``). Until then its period is published from the
buffer: first when the period closes, then again after each day of arrival that
brings it a record (``provisional``). ``corrections`` are the records that such a
later publication took in; ``rejected`` lists those that came after their release.

Nothing here gathers a period in one task: counts are combined before the shuffle,
and the order-sensitive part runs in slices of about equally many events, whose
borders are then joined from one row a slice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewell.functions.ids import date_sk
from tidewell.functions.instants import DAY, HOUR
from tidewell.operators.slices import ordered_slices

#: Lateness bound: 72 hours.
SLACK_US = 72 * HOUR


def buffer_events(df: DataFrame, event_us: Column, arrival_us: Column, slack_us: int = SLACK_US) -> DataFrame:
    """Adds what the buffer knows of each event.

    period     first microsecond of the UTC day of event time
    epoch      first microsecond of the UTC day after which the event is published
               first: its day of arrival, or its period where it came early
    release_us when the event leaves the buffer
    state      'in_period' (came before its period closed), 'correction' (came
               after, within the slack), 'rejected' (came after its release), or
               'untimed' (no event time or no arrival; in no period)
    """
    late = F.col("arrival_us") - F.col("event_us")
    return (
        df.withColumns({"event_us": event_us, "arrival_us": arrival_us})
        .withColumns(
            {
                "period": F.floor(F.col("event_us") / DAY) * DAY,
                "epoch": F.greatest(F.floor(F.col("arrival_us") / DAY) * DAY, F.floor(F.col("event_us") / DAY) * DAY),
                "release_us": F.col("event_us") + slack_us,
            }
        )
        .withColumn(
            "state",
            F.when(late.isNull(), "untimed")
            .when(F.col("arrival_us") > F.col("release_us"), "rejected")
            .when(F.col("epoch") > F.col("period"), "correction")
            .otherwise("in_period"),
        )
    )


def held(buffered: DataFrame, key: str) -> DataFrame:
    """(period, key, epochs, event_us): the buffer's content, one row an event. An
    event that came several times is held once; ``epochs`` are the days after
    which its copies are published, few because they lie within the slack."""
    kept = buffered.filter(F.col("state").isin("in_period", "correction"))
    return kept.groupBy("period", key).agg(F.array_sort(F.collect_set("epoch")).alias("epochs"), F.min("event_us").alias("event_us"))


def _series(buffer: DataFrame) -> DataFrame:
    """(period, epoch, records, events, n_corrections, total) of the publications."""
    each = buffer.select("period", F.explode("epochs").alias("epoch"), F.col("epochs")[0].alias("first"))
    step = each.groupBy("period", "epoch").agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if(F.col("epoch") == F.col("first")).alias("events"),
    )
    total = F.sum("events").over(W.partitionBy("period").orderBy("epoch"))
    return step.withColumns({"n_corrections": F.when(F.col("epoch") > F.col("period"), F.col("events")).otherwise(0), "total": total})


def provisional(buffered: DataFrame, key: str) -> DataFrame:
    """(period, epoch, events, n_corrections, total): the value of each period as
    published from the buffer at its close and at the end of each later day that
    brought it a record; ``total`` runs up to the final value. One row for each
    period and day within the slack, so the running sum is over a few rows. An
    event counts with its first copy; a day that brought only further copies
    publishes the same total again."""
    return _series(held(buffered, key)).drop("records")


def corrections(buffered: DataFrame, key: str) -> DataFrame:
    """Distinct (key, date_sk) of the events in the buffer that a publication after
    the first of their period took in, i.e. that came when a value of their period
    was out. Only events held at a later epoch meet the series, which has a few
    rows a period; both come from the same shuffle of the buffer."""
    buffer = held(buffered, key)
    again = _series(buffer).filter(F.col("records") > 0).filter("epoch > period").select("period", "epoch")
    late = buffer.select("period", key, F.explode("epochs").alias("epoch")).filter("epoch > period")
    return late.join(again, ["period", "epoch"], "left_semi").select(key, day_of("period").alias("date_sk")).distinct()


def rejected(buffered: DataFrame, key: str) -> DataFrame:
    """Distinct (key, date_sk, hours_late) of the events that came after their
    release and are in no final value."""
    hours = F.floor((F.col("arrival_us") - F.col("event_us")) / HOUR)
    return buffered.filter("state = 'rejected'").select(key, day_of("period").alias("date_sk"), hours.alias("hours_late")).distinct()


def release(buffered: DataFrame, key: str) -> DataFrame:
    """Final value of each period from the events in event-time order: number of
    distinct events, first and last event, and the longest pause between
    neighbours (what needs the order). Ties in time are ordered by key.

    Released events are cut into slices of about equal size along their order;
    a slice is the largest group that is sorted. The slices of a period are then
    put together from their borders, one row a slice."""
    one = ordered_slices(held(buffered, key).select("period", key, "event_us"), ["event_us", key])
    w = W.partitionBy("slice", "period").orderBy("event_us", key)
    pause = F.col("event_us") - F.lag("event_us").over(w)
    slices = (
        one.withColumn("pause", pause)
        .groupBy("slice", "period")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min(F.struct("event_us", key)).alias("first"),
            F.max(F.struct("event_us", key)).alias("last"),
            F.max("pause").alias("pause"),
        )
    )
    across = F.col("first.event_us") - F.lag("last.event_us").over(W.partitionBy("period").orderBy("slice"))
    return (
        slices.withColumn("across", across)
        .groupBy("period")
        .agg(
            F.sum("n").alias("n_events"),
            F.min("first")[key].alias("first_key"),
            F.max("last")[key].alias("last_key"),
            F.max(F.greatest("pause", "across")).alias("longest_pause_us"),
        )
        .select(day_of("period").alias("date_sk"), "n_events", "first_key", "last_key", "longest_pause_us")
    )


def day_of(us: str) -> Column:
    """yyyymmdd of microseconds since 1970 UTC."""
    return date_sk(F.date_from_unix_date(F.floor(F.col(us) / DAY).cast("int")))
