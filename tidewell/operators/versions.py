"""Latest version per key, slowly changing dimensions and upserts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.functions.ids import all_null, strip


def latest_by(df: DataFrame, key: Column, order: list[Column], keep_unidentified: bool = True) -> DataFrame:
    """One row per key, the first in ``order``; rows whose key is null all stay
    (they are for validation to reject), or none does. A row number is limited to
    the first row before the shuffle, so a hot key sends one row a task."""
    spread = F.coalesce(key, F.concat(F.lit("\x00"), F.monotonically_increasing_id().cast("string")))
    d = df if keep_unidentified else df.filter(key.isNotNull())
    w = W.partitionBy("__key").orderBy(*order)
    return d.withColumn("__key", spread).withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__key", "__rn")


def newest_first(*columns: str) -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in columns]


def split_tombstones(df: DataFrame, key: str, payload: list[str]) -> tuple[DataFrame, DataFrame]:
    """(records, distinct deleted keys). A row with a key and an all-null payload
    deletes; keys that are blank delete nothing and are no records either."""
    dead = F.col(key).isNotNull() & all_null(payload)
    text = isinstance(df.schema[key].dataType, T.StringType)
    keys = df.filter(dead).select((strip(key) if text else F.col(key)).alias(key)).distinct()
    return df.filter(~dead), keys.filter(F.col(key) != "") if text else keys


def delete_keys(target: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return target.join(keys.select(key).distinct(), key, "left_anti")


def cascade_delete(parents: DataFrame, children: DataFrame, keys: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Both tables without the rows of the deleted keys."""
    return delete_keys(parents, keys, key), delete_keys(children, keys, key)


def reset_reference(facts: DataFrame, gone: DataFrame, key: str, values: dict[str, Column]) -> DataFrame:
    """Facts whose ``key`` is gone get ``values``, e.g. the unknown member."""
    hit = facts.join(gone.select(key).distinct().withColumn("__gone", F.lit(True)), key, "left")
    return hit.withColumns({c: F.when(F.col("__gone"), v).otherwise(F.col(c)) for c, v in values.items()}).drop("__gone").select(*facts.columns)


def upsert(target: DataFrame, source: DataFrame, key: str, update: str | None = None) -> DataFrame:
    """Target after a merge by ``key``. ``update`` is the SQL condition, over t
    and s, under which a matched row is replaced: None never (insert what is
    missing), "true" always. Null conditions don't update. Columns that only one
    side has are null in the other's rows. ``source`` has distinct keys; a null
    key matches nothing and is inserted."""
    here, there = set(target.columns), set(source.columns)
    if update is None:
        # The target isn't touched: it is unioned with what it lacks.
        return target.unionByName(source.join(target.select(key), key, "left_anti"), allowMissingColumns=True)
    condition = F.coalesce(F.expr(update), F.lit(False))
    names = target.columns + [c for c in source.columns if c not in here]
    in_t, in_s = F.col("t.__t").isNotNull(), F.col("s.__s").isNotNull()
    both = target.withColumn("__t", F.lit(1)).alias("t").join(
        source.withColumn("__s", F.lit(1)).alias("s"), F.col(f"t.{key}") == F.col(f"s.{key}"), "full_outer"
    )
    take = ~in_t | (in_t & in_s & condition)
    null = F.lit(None)
    return both.select(
        *[F.when(take, F.col(f"s.{c}") if c in there else null).otherwise(F.col(f"t.{c}") if c in here else null).alias(c) for c in names]
    )


NEWER = "s.source_kafka_timestamp > t.source_kafka_timestamp"


def record_hash(columns: list[str]) -> Column:
    """SHA-256 over the tracked attributes; nulls keep their place."""
    return F.sha2(F.concat_ws("||", *(F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in columns)), 256)


def scd1_changes(current: DataFrame, incoming: DataFrame, key: str, tracked: list[str]) -> DataFrame:
    """Incoming rows that are new or differ, with change_type insert or update."""
    mine = incoming.withColumn("record_hash", record_hash(tracked))
    known = current.select(F.col(key), record_hash(tracked).alias("__hash"))
    return (
        mine.join(known, key, "left")
        .withColumn("change_type", F.when(F.col("__hash").isNull(), "insert").when(F.col("__hash") != F.col("record_hash"), "update"))
        .filter("change_type is not null")
        .drop("__hash")
    )


def interval_join(facts: DataFrame, versions: DataFrame, key: str, at: str, start: str, stop: str, columns: list[str]) -> DataFrame:
    """Left join to the version whose half-open [start, stop) holds ``at``. For
    versions that don't overlap; see ``asof`` for those that may."""
    v = versions.select(F.col(key).alias("__k"), F.col(start).alias("__a"), F.col(stop).alias("__b"), *columns)
    on = (F.col(key) == F.col("__k")) & (F.col(at) >= F.col("__a")) & (F.col("__b").isNull() | (F.col(at) < F.col("__b")))
    return facts.join(v, on, "left").drop("__k", "__a", "__b")


def close_current(target: DataFrame, staged: DataFrame, key: str, start: str = "effective_from", stop: str = "effective_to", current: str = "is_current") -> DataFrame:
    """Open periods of the keys that ``staged`` has new versions of end where the
    first of these begins, if that is later than their own start."""
    first = staged.groupBy(F.col(key).alias("__k")).agg(F.min(start).alias("__from"))
    hit = target.join(first, F.col(key) == F.col("__k"), "left")
    ends = F.coalesce(F.col(current) & (F.col("__from") > F.col(start)), F.lit(False))
    return hit.withColumns({stop: F.when(ends, F.col("__from")).otherwise(F.col(stop)), current: F.col(current) & ~ends}).select(*target.columns)


def matches_at(facts: DataFrame, versions: DataFrame, key: str, at: str, start: str, stop: str) -> DataFrame:
    """The facts with how many versions [start, stop) of their key hold at their
    time, from running sums instead of pairs: a version counts one from its start
    and minus one from its stop (an empty one counts nothing). A key's rows are
    summed in slices of the order (key, time), then over the slices."""
    from tidewell.operators.slices import ordered_slices

    null = F.lit(None)
    names = [c for c in facts.columns if c not in (key, at)]
    v = versions.filter(F.col(key).isNotNull() & F.col(start).isNotNull() & (F.col(stop).isNull() | (F.col(stop) > F.col(start)))).select(
        F.col(key).alias("__k"), F.explode(F.array(F.struct(F.col(start).alias("t"), F.lit(1).alias("d")), F.struct(F.col(stop).alias("t"), F.lit(-1).alias("d")))).alias("e")
    )
    steps = v.filter("e.t is not null").groupBy("__k", F.col("e.t").alias("__t")).agg(F.sum("e.d").cast("bigint").alias("__d"))
    timed = facts.filter(F.col(key).isNotNull() & F.col(at).isNotNull())
    rest = facts.filter(F.col(key).isNull() | F.col(at).isNull()).withColumn("matches", F.lit(0).cast("bigint"))
    payload = F.struct(*names) if names else F.struct(F.lit(1).alias("one"))
    a = timed.select(F.col(key).alias("__k"), F.col(at).alias("__t"), F.lit(0).cast("bigint").alias("__d"), payload.alias("__f"))
    b = steps.select("__k", "__t", "__d", null.cast(a.schema["__f"].dataType).alias("__f"))
    both = ordered_slices(a.unionByName(b), ["__k", "__t"], "__slice")
    inside = F.sum("__d").over(W.partitionBy("__slice", "__k").orderBy("__t").rangeBetween(W.unboundedPreceding, 0))
    sums = both.groupBy("__slice", "__k").agg(F.sum("__d").alias("s"))
    before = sums.withColumn("__before", F.coalesce(F.sum("s").over(W.partitionBy("__k").orderBy("__slice").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).drop("s")
    out = both.withColumn("__in", inside).filter("__f is not null").join(before, ["__slice", "__k"])
    out = out.select(F.col("__k").alias(key), F.col("__t").alias(at), *[F.col(f"__f.{c}").alias(c) for c in names], (F.col("__in") + F.col("__before")).alias("matches"))
    return out.unionByName(rest)


def overlaps(versions: DataFrame, key: str, start: str, stop: str) -> DataFrame:
    """Versions that last beyond the start of the next one of their key."""
    w = W.partitionBy(key).orderBy(start, F.col(stop).asc_nulls_last())
    later = F.lead(start).over(w)
    return versions.withColumn("next_start", later).filter(F.col("next_start").isNotNull() & (F.col(stop).isNull() | (F.col(stop) > F.col("next_start"))))


def with_unknown(df: DataFrame, values: dict) -> DataFrame:
    """The dimension with its unknown member, once."""
    row = df.sparkSession.range(1).select(*[F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in df.schema.fields])
    key = next(iter(values))
    return df.filter(~F.col(key).eqNullSafe(F.lit(values[key]))).unionByName(row)


def canonical_generations(generations: list[DataFrame], identity: list[str], order: list[str]) -> DataFrame:
    """One row per identity over several generations of a dataset; later ones in
    the list take precedence, then ``order`` descending."""
    tagged = [g.withColumn("generation_priority", F.lit(i + 1)) for i, g in enumerate(generations)]
    union = tagged[0]
    for g in tagged[1:]:
        union = union.unionByName(g, allowMissingColumns=True)
    w = W.partitionBy(*identity).orderBy(F.col("generation_priority").desc(), *newest_first(*order))
    return union.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")
