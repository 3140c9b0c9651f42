"""Calendar dimension."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions.ids import date_sk


def calendar(spark: SparkSession, start: date, end: date) -> DataFrame:
    """One row a day from ``start`` to ``end``, both included; a start after the
    end raises. Weeks are ISO weeks, day_of_week is 1 for Sunday."""
    if start > end:
        raise ValueError(f"start {start} is after end {end}")
    d = F.col("full_date")
    days = spark.range((end - start).days + 1).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("full_date"))
    return days.select(
        date_sk(d).alias("date_sk"),
        "full_date",
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.weekofyear(d).alias("week_of_year"),
        F.dayofmonth(d).alias("day"),
        F.dayofweek(d).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.dayofweek(d).isin(1, 7).alias("is_weekend"),
    )
