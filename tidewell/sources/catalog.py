"""Tables of the session's catalog: creation, insertion, reading and removal."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession


def _name(table: str) -> str:
    if not re.fullmatch(r"[A-Za-z_]\w*(\.[A-Za-z_]\w*){0,2}", table):
        raise ValueError(f"not a table name: {table!r}")
    return table


def ensure_namespace(spark: SparkSession, namespace: str) -> None:
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {_name(namespace)}")


def ensure_table(spark: SparkSession, table: str, like: DataFrame, partition_by: list[str] | None = None, using: str = "parquet") -> None:
    """Creates an empty table with the columns of ``like`` unless it is there.
    ``partition_by`` names columns, a day column derived beforehand for instance."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in like.schema.fields)
    parts = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_name(table)} ({columns}) USING {using}{parts}")


def insert(df: DataFrame, table: str) -> None:
    """Appends by column name; columns that the table lacks raise."""
    target = df.sparkSession.table(_name(table))
    extra = [c for c in df.columns if c not in target.columns]
    if extra:
        raise ValueError(f"{table} has no columns {', '.join(extra)}")
    df.select(*target.columns).write.insertInto(table)


def scan(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(_name(table))


def drop(spark: SparkSession, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {_name(table)}")
