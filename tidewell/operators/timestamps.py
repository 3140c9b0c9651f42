"""Mixed timestamp notations and zones to one UTC instant.

Values that carry an offset or a zone are final after reading. Local values are
converted by the offset history of the *writer* (the front end or table that
wrote them). A writer that declares a zone has that zone's history. For those that
declare none it is estimated: every candidate history (the zones that writers in
the data declare, and the default) is scored by its violations, the local values
that, converted by it, do not fall just before their arrival, and the history with
the fewest wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions.ids import strip
from tidewell.functions.instants import CANONICAL, DAY, known_zones, with_parsed, with_utc, zone_offset_us

QUARTER = 900_000_000
#: Offsets lie between -12 and +14 hours; other differences are late or early clocks.
LEAST, MOST = -48, 56
#: Writers without a declared zone; the zone they have unless the data say otherwise.
UNDECLARED, DEFAULT_ZONE = "(none)", "UTC"
#: Evidence for the prior (the default, the declared zone): another history must
#: have more than this many fewer violations. The same for any number of rows.
PRIOR = 10


def declared_zone(declared: Column | str) -> Column:
    """The zone a writer declares; null where it declares none or no known one."""
    z = strip(declared)
    return F.when(z.isin(known_zones()), z)


def zone_votes(df: DataFrame, parsed: str, declared: str, arrival: Column) -> DataFrame:
    """Counts of local values by writer, day and quarter-hour difference to
    arrival: at most zones x days x 106 rows, however many values there are."""
    us = F.col(f"{parsed}_local")
    local = F.col(f"{parsed}_offset").isNull() & F.col(f"{parsed}_zone").isNull() & us.isNotNull() & arrival.isNotNull()
    ahead = F.round((us - F.unix_micros(arrival)) / QUARTER).cast("int")
    return (
        df.filter(local)
        .groupBy(
            F.coalesce(declared_zone(declared), F.lit(UNDECLARED)).alias("writer"),
            F.floor(us / DAY).cast("int").alias("day"),
            F.when(ahead.between(LEAST, MOST), ahead).otherwise(F.lit(None)).alias("ahead"),
        )
        .agg(F.count(F.lit(1)).alias("n"))
    )


def candidate_zones(df: DataFrame, declared: str, default: str = DEFAULT_ZONE) -> Column:
    """The zones that writers in the data declare, about 600 at most, and the
    default, as a scalar subquery over that one column."""
    return df.agg(F.array_sort(F.array_union(F.collect_set(declared_zone(declared)), F.array(F.lit(default)))).alias("z")).scalar()


def offset_histories(votes: DataFrame, candidates: Column, default: str = DEFAULT_ZONE, prior: int = PRIOR) -> DataFrame:
    """(writer, declared, estimated, zone, violations, rows), at most one row for
    each zone of the time zone database, about 600, and one of the undeclared.

    estimated  the history that minimises violations, with ``prior`` more counted
               for any but the declared zone (the default where none is declared)
    zone       what values are converted by: the declared zone, else the estimate
    violations of ``zone``

    Days on which all candidates have the same offsets are alike, and votes are
    summed over them before they meet the candidates."""
    noon = (F.col("day").cast("bigint") * DAY + DAY // 2).cast("bigint")
    offsets = F.transform("zones", lambda z: F.struct(z.alias("zone"), (zone_offset_us(noon, z) / QUARTER).alias("offset")))
    days = votes.select("day").distinct().withColumn("zones", candidates).select("day", offsets.alias("offsets"))
    alike = votes.join(days, "day").groupBy("writer", "offsets", "ahead").agg(F.sum("n").alias("n"))
    kept = F.col("ahead").between(F.col("c.offset") - 1, F.col("c.offset"))
    scored = (
        alike.withColumn("c", F.explode("offsets"))
        .groupBy("writer", F.col("c.zone").alias("zone"))
        .agg(
            F.sum(F.when(kept, 0).otherwise(F.col("n"))).alias("violations"),
            F.sum("n").alias("rows"),
        )
    )
    undeclared = F.col("writer") == UNDECLARED
    expected = F.when(undeclared, F.lit(default)).otherwise(F.col("writer"))
    own = F.col("zone") == expected
    one = scored.groupBy("writer").agg(
        F.min(F.struct((F.col("violations") + F.when(own, 0).otherwise(prior)).alias("score"), (~own).alias("other"), "zone", "violations")).alias("best"),
        F.max(F.when(own, F.col("violations"))).alias("of_own"),
        F.max("rows").alias("rows"),
    )
    return one.select(
        "writer",
        F.when(~undeclared, F.col("writer")).alias("declared"),
        F.col("best.zone").alias("estimated"),
        F.when(undeclared, F.col("best.zone")).otherwise(F.col("writer")).alias("zone"),
        F.when(undeclared, F.col("best.violations")).otherwise(F.col("of_own")).alias("violations"),
        "rows",
    )


def with_instants(
    df: DataFrame,
    event: str = "event_timestamp",
    ingest: str = "ingested_at",
    declared: str = "origin_zone",
    arrival: str = "kafka_timestamp",
) -> DataFrame:
    """Adds ``<event>_us`` and ``<ingest>_us``, microseconds since 1970 UTC, null
    where the text fixes no single instant. All other columns and rows stay.
    ``ingest`` without zone is UTC; ``event`` without zone follows the history of
    its writer: the declared zone, or the estimate for those that declare none
    (the default where no value of theirs can be aligned with an arrival).

    Only values without zone are read twice, once to estimate theirs. The estimate
    is a scalar subquery of one zone name."""
    unknown = df.filter(declared_zone(declared).isNull()).select(event, declared, arrival)
    votes = zone_votes(with_parsed(unknown, {"__p": event}), "__p", declared, F.col(arrival))
    estimate = offset_histories(votes, candidate_zones(df.select(declared), declared)).agg(F.max("zone").alias("zone")).scalar()
    out = with_parsed(df, {"__event": event, "__ingest": ingest}).withColumn("__own", F.coalesce(declared_zone(declared), estimate, F.lit(DEFAULT_ZONE)))
    out = with_utc(out, {f"{event}_us": ("__event", F.col("__own")), f"{ingest}_us": ("__ingest", F.lit("UTC"))})
    return out.select(*df.columns, f"{event}_us", f"{ingest}_us")


def not_canonical(c: Column | str) -> Column:
    """The text isn't written yyyy-MM-ddTHH:mm:ss.SSSZ."""
    c = F.col(c) if isinstance(c, str) else c
    return ~c.rlike(CANONICAL)


def renormalised(df: DataFrame, key: str = "event_key", fields: tuple[str, ...] = ("event_timestamp", "ingested_at")) -> DataFrame:
    """Distinct (key, field_name, epoch_us) of the values that fix an instant but
    are not written in the canonical notation."""
    d = with_instants(df.select(key, *fields, "origin_zone", "kafka_timestamp"), *fields)
    each = F.explode(
        F.array(
            *(
                F.struct(F.lit(f).alias("field_name"), F.when(not_canonical(f), F.col(f"{f}_us")).alias("epoch_us"))
                for f in fields
            )
        )
    )
    return d.select(key, each.alias("v")).select(key, "v.field_name", "v.epoch_us").filter("epoch_us is not null").distinct()
