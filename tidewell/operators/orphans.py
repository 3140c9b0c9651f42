"""References to records that do not exist, by runs of parent keys.

The sorted distinct integer keys of the parents are compressed to contiguous runs.
A run knows its first and last key and the bounds of its parents' times. A
reference is matched as-of to the run that starts last before it: it is an orphan
if it lies beyond that run's end, and where the run's bounds already say that no
parent in it came too late, it is done with. Only keys that the bounds leave open
are looked up one by one, which single-key runs never need.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewell.operators.slices import HOT_ROWS, join_hot, ordered_slices


def parent_ages(parents: DataFrame, key: str, time: str) -> DataFrame:
    """(key, first, last): the distinct keys with their earliest and latest time.
    Repeated keys collapse before the shuffle."""
    p = parents.select(F.col(key).alias("key"), F.col(time).alias("t")).filter("key is not null")
    return p.groupBy("key").agg(F.min("t").alias("first"), F.max("t").alias("last"))


def match_runs(ages: DataFrame, referenced: DataFrame) -> DataFrame:
    """(key, <columns of referenced>, has_parent, n_keys, first_lo, first_hi,
    last_lo, last_hi) of the distinct referenced keys: whether a run holds the key,
    and the bounds of the times of that run's parents (null without one).

    Keys of both sides are cut together into stretches of about equally many, so
    neither clustered keys nor an outlier make a large one. A run never crosses a
    cut. A parent sorts before the reference that equals it."""
    extra = [c for c in referenced.columns if c != "key"]
    null = lambda df, c: F.lit(None).cast(df.schema[c].dataType).alias(c)
    a = ages.select("key", F.lit(True).alias("is_parent"), "first", "last", *[null(referenced, c) for c in extra])
    b = referenced.select("key", F.lit(False).alias("is_parent"), null(ages, "first"), null(ages, "last"), *extra)
    # Cut by key alone: a key's parent and reference must not be parted.
    both = ordered_slices(a.unionByName(b), ["key"])
    w = W.partitionBy("slice").orderBy("key", F.col("is_parent").desc()).rowsBetween(W.unboundedPreceding, 0)
    nth = F.sum(F.col("is_parent").cast("int")).over(w)
    # Neighbouring parents whose keys follow each other have the same difference.
    both = both.withColumn("island", F.when(F.col("is_parent"), F.col("key").cast("decimal(38,0)") - nth))
    both = both.withColumn("island", F.last("island", ignorenulls=True).over(w))
    run = W.partitionBy("slice", "island")
    of = lambda f, c: f(F.when(F.col("is_parent"), F.col(c))).over(run)
    both = both.withColumns(
        {
            "stop": of(F.max, "key"),
            "n_keys": F.sum(F.col("is_parent").cast("int")).over(run),
            "first_lo": of(F.min, "first"),
            "first_hi": of(F.max, "first"),
            "last_lo": of(F.min, "last"),
            "last_hi": of(F.max, "last"),
        }
    ).filter(~F.col("is_parent"))
    held = F.col("island").isNotNull() & F.coalesce(F.col("key") <= F.col("stop"), F.lit(False))
    return both.select("key", *extra, held.alias("has_parent"), *[F.when(held, F.col(c)).alias(c) for c in ("n_keys", "first_lo", "first_hi", "last_lo", "last_hi")])


def key_runs(ages: DataFrame) -> DataFrame:
    """(start, stop, n_keys) of the contiguous runs themselves, for inspection."""
    d = ordered_slices(ages.select("key"), ["key"])
    island = F.col("key").cast("decimal(38,0)") - F.row_number().over(W.partitionBy("slice").orderBy("key"))
    return d.withColumn("island", island).groupBy("slice", "island").agg(F.min("key").alias("start"), F.max("key").alias("stop"), F.count(F.lit(1)).alias("n_keys")).drop("island")


def find_orphans(
    references: DataFrame,
    ref: str,
    row_key: str,
    row_time: str,
    parents: DataFrame,
    parent_key: str,
    parent_time: str,
    gone: DataFrame,
    period: Column | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """(record_key, orphan_kind[, period]) of the references that lead nowhere.

    references  rows; those with a null ``ref`` refer to nothing and are left out,
                as are those with a null ``row_key``
    gone        (key, gone_at): keys of deleted parents, the latest deletion each
    deleted     gone later than every parent row, or gone and there is no parent row
    missing     no parent row
    late        the earliest parent row came after the referring row
    Times that are null are unknown and prove nothing."""
    refs = references.select(
        F.col(row_key).alias("record_key"),
        F.col(ref).alias("key"),
        F.col(row_time).alias("came"),
        *([period.alias("period")] if period is not None else []),
    ).filter("record_key is not null and key is not null")
    # A key that a third of the rows refer to is one row here.
    referenced = refs.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("came").alias("least"))
    ages = parent_ages(parents, parent_key, parent_time)
    met = match_runs(ages, referenced.drop("n")).join(gone, "key", "left")
    # What the run's bounds leave open: some parent of the run, or a deletion, may be later than something.
    open_late = F.coalesce(F.col("first_hi") > F.col("least"), F.lit(False))
    open_gone = F.coalesce(F.col("gone_at") > F.col("last_lo"), F.lit(False))
    met = met.filter(~F.col("has_parent") | open_late | open_gone)
    sure = met.filter("not has_parent or n_keys = 1").select("key", "has_parent", "gone_at", F.col("first_lo").alias("first"), F.col("last_lo").alias("last"))
    looked_up = met.filter("has_parent and n_keys > 1").select("key", "has_parent", "gone_at").join(ages, "key")
    facts = sure.unionByName(looked_up)
    deleted = F.col("gone_at").isNotNull() & (~F.col("has_parent") | F.coalesce(F.col("gone_at") > F.col("last"), F.lit(False)))
    suspect = facts.select(
        "key",
        F.when(deleted, "deleted").when(~F.col("has_parent"), "missing").alias("kind"),
        F.when(F.col("has_parent"), F.col("first")).alias("first"),
    )
    return (
        join_hot(refs, suspect, "key", referenced.select("key", "n"), hot_rows=hot_rows)
        .withColumn("orphan_kind", F.coalesce("kind", F.when(F.col("first") > F.col("came"), "late")))
        .filter("orphan_kind is not null")
        .select("record_key", "orphan_kind", *(["period"] if period is not None else []))
    )
