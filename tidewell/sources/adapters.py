"""Connectors whose jars may be absent: options are built here and checked, the
format is Spark's own."""

from __future__ import annotations

import base64
import json
import os
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ENVELOPE = ["kafka_key", "kafka_topic", "kafka_partition", "kafka_offset", "kafka_timestamp", "ingested_at"]


def kafka_options(servers: str, topic: str, starting: str = "earliest", per_trigger: int | None = 10_000, ending: str | None = None) -> dict[str, str]:
    """Options of a stream, or of a bounded batch where ``ending`` is given."""
    if not servers or not topic:
        raise ValueError("servers and topic must not be empty")
    out = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting, "failOnDataLoss": "false"}
    if ending:
        out["endingOffsets"] = ending
    elif per_trigger:
        out["maxOffsetsPerTrigger"] = str(per_trigger)
    return out


def with_envelope(records: DataFrame) -> DataFrame:
    """Kafka's own columns to the record envelope and ``raw_value``."""
    return records.select(
        F.col("key").cast("string").alias("kafka_key"),
        F.col("topic").alias("kafka_topic"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        F.col("timestamp").alias("kafka_timestamp"),
        F.current_timestamp().alias("ingested_at"),
        F.col("value").alias("raw_value"),
    )


def kafka_stream(spark: SparkSession, servers: str, topic: str, **options: object) -> DataFrame:
    return with_envelope(spark.readStream.format("kafka").options(**kafka_options(servers, topic, **options)).load())


def kafka_batch(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    return with_envelope(spark.read.format("kafka").options(**kafka_options(servers, topic, ending="latest")).load())


def schema_registry(url: str, timeout: float = 10.0) -> Callable[[str], str | None]:
    """Lookup of the latest value schema of a topic, each asked for once. None where
    the registry has none (404); any other failure raises."""
    base = url.rstrip("/")

    @lru_cache(maxsize=32)
    def schema_of(topic: str) -> str | None:
        try:
            with urllib.request.urlopen(f"{base}/subjects/{urllib.parse.quote(topic)}-value/versions/latest", timeout=timeout) as r:
                return json.load(r)["schema"]
        except urllib.error.HTTPError as e:
            if e.code == 404:
                return None
            raise

    return schema_of


def decode_confluent(df: DataFrame, topic: str, schema_of: Callable[[str], str | None], payload: str = "raw_value", from_avro: Callable[[Column, str], Column] | None = None) -> DataFrame | None:
    """Payload behind the 5-byte header decoded and flattened after the other
    columns; None where the registry has no schema for the topic. ``schema_of``
    is the registry lookup; ``from_avro`` can be replaced where the jar is absent."""
    if payload not in df.columns:
        raise ValueError(f"no column {payload!r}")
    schema = schema_of(topic)
    if schema is None:
        return None
    if from_avro is None:
        from pyspark.sql.avro.functions import from_avro as spark_avro

        from_avro = lambda c, s: spark_avro(c, s, {"mode": "PERMISSIVE"})
    body = F.expr(f"substring({payload}, 6, length({payload}) - 5)")
    decoded = df.withColumn("__d", from_avro(body, schema))
    return decoded.select(*[c for c in df.columns if c != payload], "__d.*")


def decode_json(df: DataFrame, schema: str, payload: str = "raw_value") -> DataFrame:
    """The same for JSON payloads."""
    d = df.withColumn("__d", F.from_json(F.col(payload).cast("string"), schema))
    return d.select(*[c for c in df.columns if c != payload], "__d.*")


def object_store_conf(env: dict[str, str] | None = None) -> dict[str, str]:
    """S3A settings from S3_ENDPOINT, S3_ACCESS_KEY and S3_SECRET_KEY; an error
    names all that are missing. TLS follows the endpoint's scheme."""
    env = dict(os.environ if env is None else env)
    need = ["S3_ENDPOINT", "S3_ACCESS_KEY", "S3_SECRET_KEY"]
    missing = [n for n in need if not env.get(n)]
    if missing:
        raise ValueError(f"missing environment variables: {', '.join(missing)}")
    p = "spark.hadoop.fs.s3a."
    return {
        p + "endpoint": env["S3_ENDPOINT"],
        p + "access.key": env["S3_ACCESS_KEY"],
        p + "secret.key": env["S3_SECRET_KEY"],
        p + "path.style.access": "true",
        p + "connection.ssl.enabled": str(env["S3_ENDPOINT"].startswith("https://")).lower(),
    }


def jdbc_options(url: str, table: str, batch: int = 100_000, partitions: int = 8, **extra: str) -> dict[str, str]:
    if not url or not table:
        raise ValueError("url and table must not be empty")
    return {"url": url, "dbtable": table, "batchsize": str(batch), "numPartitions": str(partitions)} | extra


def read_jdbc(spark: SparkSession, url: str, table: str, **extra: str) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **extra)).load()


def append_jdbc(df: DataFrame, url: str, table: str, **extra: str) -> None:
    df.write.format("jdbc").options(**jdbc_options(url, table, **extra)).mode("append").save()


def admin_sql(url: str, sql: str, user: str = "", password: str = "", timeout: float = 120.0) -> str:
    """Sends a statement to a database's HTTP interface and gives back its answer;
    a failure raises with the body of the server's reply."""
    request = urllib.request.Request(url, data=sql.encode(), method="POST")
    if user:
        request.add_header("Authorization", "Basic " + base64.b64encode(f"{user}:{password}".encode()).decode())
    try:
        with urllib.request.urlopen(request, timeout=timeout) as r:
            return r.read().decode()
    except urllib.error.HTTPError as e:
        raise RuntimeError(f"HTTP {e.code}: {e.read().decode(errors='replace')}") from e
