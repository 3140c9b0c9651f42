"""Single-pass profiles and reconciliation checks. Each returns a small frame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def null_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, n_rows, n_null, n_blank), all columns in one pass."""
    stats = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(F.col(c).isNull()).alias(f"n_{c}") for c in columns],
        *[F.count_if(F.trim(F.col(c).cast("string")) == "").alias(f"b_{c}") for c in columns],
    )
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col("n").alias("n_rows"), F.col(f"n_{c}").alias("n_null"), F.col(f"b_{c}").alias("n_blank")) for c in columns]))
    return stats.select(each.alias("p")).select("p.*")


def frequencies(df: DataFrame, value: Column, name: str) -> DataFrame:
    return df.groupBy(value.alias(name)).agg(F.count(F.lit(1)).alias("n_rows"))


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys on more than one row."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def missing_both_ways(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, side): distinct keys of one frame that the other lacks. One shuffle
    of distinct keys instead of two anti joins."""
    tag = lambda df, x: df.select(*keys, F.lit(x).alias("in_a")).distinct()
    both = tag(a, True).unionByName(tag(b, False)).groupBy(*keys).agg(F.bool_or("in_a").alias("a"), F.bool_and("in_a").alias("only_a"))
    return both.filter("only_a or not a").select(*keys, F.when(F.col("only_a"), "missing_in_b").otherwise("missing_in_a").alias("side"))


def payload_conflicts(df: DataFrame, identity: list[str], payload: list[str]) -> DataFrame:
    """Identities that occur with different payloads, and with how many."""
    h = F.sha2(F.to_json(F.struct(*sorted(payload)), {"ignoreNullFields": "false"}), 256)
    return df.select(*identity, h.alias("h")).distinct().groupBy(*identity).agg(F.count(F.lit(1)).alias("n_payloads")).filter("n_payloads > 1")


def offset_summary(df: DataFrame, topic: str = "kafka_topic", partition: str = "kafka_partition", offset: str = "kafka_offset") -> DataFrame:
    """First and last offset, rows and distinct offsets of each partition. Distinct
    offsets are reduced first, so no row is expanded for the distinct count."""
    one = df.groupBy(topic, partition, offset).agg(F.count(F.lit(1)).alias("n"))
    return one.groupBy(topic, partition).agg(
        F.min(offset).alias("min_offset"),
        F.max(offset).alias("max_offset"),
        F.sum("n").alias("n_rows"),
        F.count(offset).alias("n_offsets"),
    )


def checks(metrics: DataFrame, expected: dict[str, Column]) -> DataFrame:
    """(check, passed) of conditions over a one-row frame of metrics."""
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("check_name"), F.coalesce(c, F.lit(False)).alias("passed")) for k, c in expected.items()]))
    return metrics.select(each.alias("c")).select("c.*")


def raise_on_failure(result: DataFrame) -> None:
    """Raises with the names of the failed checks (one row a check)."""
    failed = [r.check_name for r in result.filter("not passed").collect()]
    if failed:
        raise AssertionError(f"failed checks: {', '.join(sorted(failed))}")


def write_report(source: DataFrame, written: DataFrame, identity: list[str], payload: list[str], day: str) -> DataFrame:
    """(check_name, passed) of a written dataset against its source: as many rows,
    no identity twice, the same (identity, payload) pairs in both, no null day. One
    shuffle by identity."""
    h = F.sha2(F.to_json(F.struct(*sorted(payload)), {"ignoreNullFields": "false"}), 256)
    one = lambda df, side, d: df.select(*identity, h.alias("h"), F.lit(side).alias("side"), d.alias("no_day"))
    both = one(source, 0, F.lit(False)).unionByName(one(written, 1, F.col(day).isNull()))
    count = lambda side: F.count_if(F.col("side") == side)
    pairs = both.groupBy(*identity, "h").agg(count(0).alias("a"), count(1).alias("b"), F.count_if("no_day").alias("no_day"))
    keys = pairs.groupBy(*identity).agg(F.sum("a").alias("a"), F.sum("b").alias("b"), F.sum(F.when((F.col("a") > 0) != (F.col("b") > 0), 1).otherwise(0)).alias("differ"), F.sum("no_day").alias("no_day"))
    zero = lambda c: F.coalesce(F.sum(c), F.lit(0))
    m = keys.agg(zero("a").alias("a"), zero("b").alias("b"), zero(F.when(F.col("b") > 1, 1).otherwise(0)).alias("twice"), zero("differ").alias("differ"), zero("no_day").alias("no_day"))
    return checks(m, {"same_rows": F.col("a") == F.col("b"), "no_identity_twice": F.col("twice") == 0, "same_payloads": F.col("differ") == 0, "no_null_day": F.col("no_day") == 0})


def numeric_range(df: DataFrame, column: str) -> DataFrame:
    """(column_name, least, greatest, mean, n_values) of a numeric column."""
    by_value = df.groupBy(F.col(column).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    n = F.when(F.col("v").isNotNull(), F.col("n"))
    total = F.sum(F.col("v").cast("decimal(28,6)") * n)
    return by_value.agg(
        F.min("v").cast("double").alias("least"), F.max("v").cast("double").alias("greatest"), F.round(total.cast("double") / F.sum(n), 6).alias("mean"), F.count("v").alias("n_values")
    ).select(F.lit(column).alias("column_name"), "least", "greatest", "mean", "n_values")


def compare_with_log(stored: DataFrame, log: DataFrame, identity: list[str]) -> DataFrame:
    """(identity, finding): what the broker's log has and the dataset lacks
    ('missing', a failure) and what only the dataset has ('stored_only', a warning,
    as the log forgets)."""
    both = missing_both_ways(stored, log, identity)
    return both.select(*identity, F.when(F.col("side") == "missing_in_a", "missing").otherwise("stored_only").alias("finding"))


def source_report(df: DataFrame, group: list[str], identity: list[str], payload: list[str], times: list[str]) -> DataFrame:
    """By group: rows, identities, identities with several payloads, rows without
    any of ``times``, and a verdict: PASS, or REVIEW_REQUIRED where something is
    repeated with another payload or has no time."""
    h = F.sha2(F.to_json(F.struct(*sorted(payload)), {"ignoreNullFields": "false"}), 256)
    untimed = F.coalesce(*[F.col(t) for t in times]).isNull()
    pairs = df.select(*group, *identity, h.alias("h"), untimed.alias("u")).groupBy(*group, *identity, "h").agg(F.count(F.lit(1)).alias("n"), F.count_if("u").alias("u"))
    keys = pairs.groupBy(*group, *identity).agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("n"), F.sum("u").alias("u"))
    out = keys.groupBy(*group).agg(F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_identities"), F.count_if(F.col("k") > 1).alias("n_conflicts"), F.sum("u").alias("n_untimed"))
    return out.withColumn("verdict", F.when((F.col("n_conflicts") > 0) | (F.col("n_untimed") > 0), "REVIEW_REQUIRED").otherwise("PASS"))


def json_report(frames: dict[str, DataFrame]) -> str:
    """Small audit frames as one JSON text, rows in a fixed order."""
    import json

    rows = {name: sorted((r.asDict(recursive=True) for r in df.collect()), key=str) for name, df in frames.items()}
    return json.dumps(rows, indent=1, default=str, sort_keys=True)
