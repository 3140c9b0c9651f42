"""History of changing attributes by tree-reduction coalescing.

Each observation is a unit interval. Neighbouring runs of equal payload of one
entity are merged pairwise, pair with pair, over a logarithmic number of rounds.

Observations are numbered along the order (entity, time), so the tree's height
follows the number of rows, never the span of time. Rounds run in levels of 16: a
level gathers up to 65,536 neighbours of one entity and merges them pairwise in 16
rounds without a shuffle. Of a level's result only the two border runs go on to
the next level; what lies between them is complete and leaves the tree. So no task
holds more than 65,536 runs of an entity, even where one entity has a third of all.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rounds of one level.
LEVEL_BITS = 16


def one_per_instant(df: DataFrame, key: str, at: str, value: str, rank: list[Column]) -> DataFrame:
    """(key, at, value): of several observations at one instant the one of the
    highest ``rank``; equal ranks go to the higher value. Combined before the
    shuffle, so repeated rows of a hot entity collapse where they are read."""
    order = F.struct(*[r.alias(f"r{i}") for i, r in enumerate(rank)], F.col(value).alias("v"))
    return df.groupBy(key, at).agg(F.max(order)["v"].alias(value))


def _merge(a: Column, b: Column) -> Column:
    """Two neighbouring lists of runs as one: the last run of ``a``, which is open,
    is joined with the first of ``b`` where the payloads are equal, else it ends
    where that begins."""
    left, right = F.element_at(a, -1), F.element_at(b, 1)
    same = left["v"].eqNullSafe(right["v"])
    run = lambda stop: F.struct(left["v"].alias("v"), left["start"].alias("start"), stop.alias("stop"))
    seam = F.when(same, F.array(run(right["stop"]))).otherwise(F.array(run(right["start"]), right))
    return F.concat(F.slice(a, F.lit(1), F.size(a) - 1), seam, F.slice(b, F.lit(2), F.size(b)))


def _round(nodes: Column) -> Column:
    """Each node with its right neighbour; an odd last one stays as it is."""
    pair = lambda i: F.when(2 * i + 1 < F.size(nodes), _merge(F.get(nodes, 2 * i), F.get(nodes, 2 * i + 1))).otherwise(F.get(nodes, 2 * i))
    return F.transform(F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / 2).cast("int")), pair)


def _reduce(nodes: str, bits: int) -> Column:
    """All nodes of a group merged into one list of runs over log2 rounds."""
    done = F.aggregate(F.sequence(F.lit(1), F.lit(bits)), F.col(nodes), lambda acc, _: F.when(F.size(acc) > 1, _round(acc)).otherwise(acc))
    return F.get(done, F.lit(0))


def coalesce_runs(df: DataFrame, key: str, at: str, value: str, level_bits: int = LEVEL_BITS) -> DataFrame:
    """(key, value, start, stop) of the runs of equal value of each key, from
    distinct (key, at) rows with ``at`` a bigint; stop is the start of the next
    run, null for the last. Null values are a payload like any other. Rows with
    a null key or ``at`` are in no history. An empty input has none.

    The first level's result is written to the shared checkpoint folder: it is
    small, and what follows reads it twice a level."""
    from tidewell.session import shared_dir

    shared_dir(df.sparkSession)
    d = df.filter(F.col(key).isNotNull() & F.col(at).isNotNull()).select(F.col(key).alias("k"), F.col(at).alias("t"), F.col(value).alias("v"))
    # Numbers rise along (entity, time): rows of a range come before those of the next one.
    d = d.repartitionByRange("k", "t").sortWithinPartitions("k", "t").withColumn("node", F.monotonically_increasing_id())
    unit = F.array(F.struct("v", F.col("t").alias("start"), F.lit(None).cast("bigint").alias("stop")))
    nodes = d.select("k", "node", unit.alias("runs"))
    done: list[DataFrame] = []
    bits = 0
    while True:
        bits = min(64, bits + level_bits)
        parent = F.shiftright("node", level_bits) if bits < 64 else F.lit(0).cast("bigint")
        group = nodes.groupBy("k", parent.alias("node")).agg(F.array_sort(F.collect_list(F.struct(F.col("node").alias("n"), "runs"))).alias("g"))
        merged = group.select("k", "node", F.col("g")["runs"].alias("nodes")).select("k", "node", _reduce("nodes", level_bits).alias("runs"))
        if bits == 64:
            done.append(merged.select("k", F.explode("runs").alias("e")))
            break
        if not done:
            merged = merged.checkpoint()
        n = F.size("runs")
        done.append(merged.filter(n > 2).select("k", F.explode(F.slice("runs", F.lit(2), n - 2)).alias("e")))
        borders = F.when(n > 1, F.array(F.get("runs", F.lit(0)), F.element_at("runs", -1))).otherwise(F.col("runs"))
        nodes = merged.select("k", "node", borders.alias("runs"))
    out = reduce(DataFrame.unionByName, done)
    return out.select(F.col("k").alias(key), F.col("e.v").alias(value), "e.start", "e.stop")
