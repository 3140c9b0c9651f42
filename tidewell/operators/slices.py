"""Even work for ordered operators and for hot keys.

``ordered_slices`` cuts rows into stretches of one total order that hold about the
same number of rows each, whatever the values are; ``join_hot`` splits the keys
that hold very many rows over several tasks of a join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key on more rows than this is hot: there are at most rows / HOT_ROWS of them.
HOT_ROWS = 500_000


def ordered_slices(df: DataFrame, order: list[str], name: str = "slice") -> DataFrame:
    """Adds the number of the stretch of the total order ``order`` that a row lies
    in. Stretches are cut from a sample of the values themselves, so an outlier
    or a dense spot makes no large one; equal rows stay together."""
    return df.repartitionByRange(*order).withColumn(name, F.spark_partition_id())


def join_hot(left: DataFrame, right: DataFrame, key: str, counts: DataFrame, how: str = "inner", hot_rows: int = HOT_ROWS) -> DataFrame:
    """``left`` joined with ``right`` (distinct keys) on ``key``.

    counts  (key, n): rows of ``left`` by key
    The rows of a hot key are spread over n / hot_rows tasks and its row of
    ``right`` goes to each of them. What is broadcast is one short row a hot key,
    at most rows / hot_rows. ``how`` is inner or left."""
    hot = F.broadcast(counts.filter(F.col("n") > hot_rows).select(F.col(key).alias("__hot"), F.ceil(F.col("n") / hot_rows).cast("int").alias("__salts")))
    spread = F.xxhash64(*[F.col(c) for c in left.columns if c != key] or [F.col(key)])
    salt = F.when(F.col("__salts").isNull(), 0).otherwise(F.pmod(spread, F.col("__salts")).cast("int"))
    a = left.join(hot, F.col(key) == F.col("__hot"), "left").withColumn("__salt", salt).drop("__hot", "__salts")
    copies = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("__salts"), F.lit(1)) - 1))
    b = right.join(hot, F.col(key) == F.col("__hot"), "left").withColumn("__salt", copies).drop("__hot", "__salts")
    return a.join(b, [key, "__salt"], how).drop("__salt")
