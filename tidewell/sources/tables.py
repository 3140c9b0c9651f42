"""Reading the Parquet tables of one data folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table(spark: SparkSession, folder: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """The table, or only the named columns of it, so that the scan reads no others."""
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    return df.select(*columns) if columns else df


def instant_columns(df: DataFrame) -> DataFrame:
    """Every timestamp without zone read as an instant in UTC."""
    naive = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampNTZType)]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in naive}) if naive else df
