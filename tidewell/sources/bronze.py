"""Raw topic datasets: paths, read modes and batch sources."""

from __future__ import annotations

import re
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MODES = ("daily", "historical", "all")


def topic_path(base: str, topic: str, branch: str = "new_data", day: str | None = None) -> str:
    """``<base>/<topic with / for .>/<branch>[/YYYY/MM/DD]``; ``day`` is
    YYYY-MM-DD, anything else raises."""
    if not base or not topic:
        raise ValueError("base and topic must not be empty")
    out = f"{base.rstrip('/')}/{topic.replace('.', '/')}/{branch}"
    if day is None:
        return out
    if not re.fullmatch(r"\d{4}-\d\d-\d\d", day):
        raise ValueError(f"not a YYYY-MM-DD date: {day!r}")
    d = date.fromisoformat(day)
    return f"{out}/{d:%Y/%m/%d}"


def day_paths(base: str, topic: str, start: datetime, end: datetime, branch: str = "new_data") -> list[str]:
    """Day folders that [start, end) touches; an end at midnight excludes its day."""
    if end <= start:
        raise ValueError("end must be after start")
    last = (end - timedelta(microseconds=1)).date()
    days = (last - start.date()).days + 1
    return [topic_path(base, topic, branch, (start.date() + timedelta(days=i)).isoformat()) for i in range(days)]


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def existing(spark: SparkSession, paths: list[str], log=None) -> list[str]:  # noqa: ANN001
    """The paths that are there; the others are told to ``log``, as a day without
    data has no folder."""
    there = []
    for p in paths:
        if exists(spark, p):
            there.append(p)
        elif log:
            log(f"no folder {p}")
    return there


def read_days(spark: SparkSession, base: str, topic: str, start: datetime, end: datetime, branch: str = "new_data", log=None) -> DataFrame | None:  # noqa: ANN001
    """The day folders that [start, end) touches and that are there; None if none is."""
    paths = existing(spark, day_paths(base, topic, start, end, branch), log)
    return read_files(spark, *paths) if paths else None


def read_files(spark: SparkSession, *paths: str, merge_schema: bool = False) -> DataFrame:
    """Parquet files below the paths; folder names are no partitions here."""
    return spark.read.option("recursiveFileLookup", "true").option("mergeSchema", str(merge_schema).lower()).parquet(*paths)


def read_topic(spark: SparkSession, base: str, topic: str, mode: str, day: str | None = None) -> DataFrame:
    """``historical``: that branch only; ``daily``: one day's folder; ``all``:
    both branches, columns that only one has filled with null."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    if mode == "daily":
        if not day:
            raise ValueError("daily mode needs a day")
        return read_files(spark, topic_path(base, topic, day=day))
    history = read_files(spark, topic_path(base, topic, "historical_v1"))
    if mode == "historical":
        return history
    return history.unionByName(read_files(spark, topic_path(base, topic)), allowMissingColumns=True)


def read_generation(spark: SparkSession, path: str, generation: str, priority: int) -> DataFrame:
    """Files of one generation with their path, generation and priority."""
    df = read_files(spark, path, merge_schema=True)
    return df.select("*", F.col("_metadata.file_path").alias("source_path"), F.lit(generation).alias("generation"), F.lit(priority).alias("priority"))


def folder_date(path: str = "source_path"):  # noqa: ANN201
    """Date of the YYYY/MM/DD folder in a path, null where there is none."""
    at = F.regexp_extract(F.col(path), r"/(\d{4})/(\d\d)/(\d\d)/", 0)
    return F.replace(F.btrim(at, F.lit("/")), F.lit("/"), F.lit("-")).try_cast("date")


def write_days(df: DataFrame, path: str, by: str = "ingest_date", append: bool = False) -> None:
    """One write of all days as partitions. A null day raises; an existing target
    raises unless ``append``."""
    checked = df.withColumn(by, F.coalesce(F.col(by), F.raise_error(F.lit(f"null {by}")).cast("date")))
    checked.write.mode("append" if append else "errorifexists").partitionBy(by).parquet(path)


def write_history(df: DataFrame, path: str, files: int, execute: bool = False, order: tuple[str, ...] = ("kafka_partition", "kafka_offset")) -> bool:
    """A repaired dataset in ``files`` files, each sorted by Kafka position. Never
    overwrites; without ``execute`` nothing is written."""
    if exists(df.sparkSession, path):
        raise FileExistsError(path)
    if execute:
        df.repartition(files, *order[:1], F.col(order[-1])).sortWithinPartitions(*order).write.mode("errorifexists").parquet(path)
    return execute


def first_valid_time(times: dict, earliest: str, latest: str):  # noqa: ANN201
    """(time, source) of the first of ``times`` (name to timestamp column, in order)
    that lies in [earliest, latest) and isn't of 1970; null and 'unresolved' where
    none does."""
    at, source = F.lit(None).cast("timestamp"), F.lit("unresolved")
    for name, c in reversed(times.items()):
        good = F.coalesce((F.year(c) != 1970) & (c >= F.lit(earliest).cast("timestamp")) & (c < F.lit(latest).cast("timestamp")), F.lit(False))
        at, source = F.when(good, c).otherwise(at), F.when(good, F.lit(name)).otherwise(source)
    return at, source


def safe_partition_time(field: str, kafka: str = "kafka_timestamp", ingested: str = "ingested_at", earliest: str = "2000-01-01", latest: str = "2100-01-01"):  # noqa: ANN201
    """(time, source) of the first valid timestamp of field, Kafka and ingestion; a
    row without any raises."""
    at, source = first_valid_time({"field": F.col(field), "kafka": F.col(kafka), "ingested": F.col(ingested)}, earliest, latest)
    return F.coalesce(at, F.raise_error(F.lit("no partition time")).cast("timestamp")), source
