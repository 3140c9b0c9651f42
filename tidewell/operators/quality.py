"""Declarative validation with reasons, and quarantine."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

REASON = "_dq_error_reason"


@dataclass(frozen=True)
class Rule:
    """A row violates the rule where ``broken`` is true; null counts as kept."""

    reason: str
    broken: Column


def with_reasons(df: DataFrame, rules: list[Rule], column: str = REASON) -> DataFrame:
    """Adds the reasons of all broken rules in declared order joined by "; ", the
    empty text where none is."""
    return df.withColumn(column, F.concat_ws("; ", *(F.when(r.broken, F.lit(r.reason)) for r in rules)))


def split_valid(df: DataFrame, rules: list[Rule]) -> tuple[DataFrame, DataFrame]:
    """(valid rows without the reason column, invalid rows with it)."""
    marked = with_reasons(df, rules)
    return marked.filter(F.col(REASON) == "").drop(REASON), marked.filter(F.col(REASON) != "")


@contextmanager
def classified(df: DataFrame, rules: list[Rule]) -> Iterator[tuple[DataFrame, DataFrame]]:
    """(valid, invalid) for several actions: classified once, kept in memory or on
    disk while the block runs, and released at its end whatever happens."""
    marked = with_reasons(df, rules).persist()
    try:
        yield marked.filter(F.col(REASON) == "").drop(REASON), marked.filter(F.col(REASON) != "")
    finally:
        marked.unpersist()


def inclusive_days(column: str, first: date, last: date) -> Column:
    """The timestamp lies on a day from ``first`` to ``last``, as a range that
    reaches the scan."""
    if last < first:
        raise ValueError(f"{last} is before {first}")
    return (F.col(column) >= F.lit(first).cast("timestamp")) & (F.col(column) < F.lit(last + timedelta(days=1)).cast("timestamp"))


def whole_day(column: str, day: date) -> Column:
    return inclusive_days(column, day, day)


def quarantine(invalid: DataFrame, entity: str, topic: str, as_of: Column, key: str | None = None) -> DataFrame:
    """Adds _dq_quarantine_id (SHA-256 of the Kafka coordinates), _dq_entity,
    _dq_source_topic, _dq_business_key, _dq_status and _dq_quarantined_at, one row
    for each id: the one whose reason is last in text order. Where a frame has no
    coordinates, or null ones, placeholders stand for them. Columns of these names
    that the frame already has win over the arguments."""
    has = set(invalid.columns)

    def part(name: str) -> Column:
        missing = F.lit(f"unknown_{name}")
        return F.coalesce(F.col(f"kafka_{name}").cast("string"), missing) if f"kafka_{name}" in has else missing

    row_topic = F.coalesce(F.col("kafka_topic"), F.lit(topic)) if "kafka_topic" in has else F.lit(topic)
    added = {
        "_dq_entity": F.lit(entity),
        "_dq_source_topic": F.lit(topic),
        "_dq_business_key": F.col(key).cast("string") if key else F.lit(None).cast("string"),
        "_dq_status": F.lit("open"),
        "_dq_quarantined_at": as_of,
    }
    out = invalid.withColumns({k: v for k, v in added.items() if k not in has})
    out = out.withColumn("_dq_quarantine_id", F.sha2(F.concat_ws("|", row_topic, part("partition"), part("offset")), 256))
    every = F.struct(*([F.col(REASON)] if REASON in has else []), *[F.col(c) for c in out.columns if c != REASON and not isinstance(out.schema[c].dataType, T.MapType)])
    return out.groupBy("_dq_quarantine_id").agg(F.max(every).alias("r")).select("r.*")


def align(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns of ``schema``: cast, filled with null, others dropped."""
    have = set(df.columns)
    return df.select(*[(F.col(f.name).try_cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields])


def require(df: DataFrame, columns: list[str]) -> DataFrame:
    """The frame itself, or an error that names the columns it lacks."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def merge_quarantine(target: DataFrame | None, new: DataFrame) -> DataFrame:
    """The quarantine after a load: its schema is that of the first write, later
    rows are aligned to it, and a row that comes again replaces its former self."""
    from tidewell.operators.versions import upsert

    return new if target is None else upsert(target, align(new, target.schema), "_dq_quarantine_id", "true")
