"""Applying a stream of inserts, updates and deletes as a signed multiset.

A deduplicated change that takes effect contributes minus one of its before-image
and plus one of its after-image. Images are (record, version); a null version is
the row of the base table, any other the number of the change that made it. Summed
with the base, what has a positive multiplicity is the current state.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewell.functions.ids import blank, norm_id, strip

#: A record's changes are sorted in blocks of this many change numbers. Numbers
#: are unique, so no task sorts more changes of a record than this.
BLOCK = 1 << 16

_OPS = {"i": "i", "insert": "i", "c": "i", "create": "i", "u": "u", "update": "u", "d": "d", "delete": "d"}


def op_of(op: Column, payload: Column) -> Column:
    """i, u or d of the spellings of an operation; a change with neither
    operation nor payload is a delete; null where none of these."""
    o = F.lower(strip(op))
    known = F.create_map(*(F.lit(x) for kv in _OPS.items() for x in kv))
    return F.when(blank(op) & blank(payload), "d").otherwise(F.try_element_at(known, o))


def distinct_changes(changes: DataFrame) -> DataFrame:
    """(table_name, record_key, commit_lsn, op, payload_json): each change once.
    Copies agree; where they don't, the lowest operation and payload count. Rows
    without key, number or known operation change nothing."""
    return (
        changes.select(
            "table_name",
            norm_id("record_key").alias("record_key"),
            "commit_lsn",
            op_of(F.col("op"), F.col("payload_json")).alias("op"),
            "payload_json",
        )
        .filter("record_key is not null and commit_lsn is not null and op is not null")
        .groupBy("table_name", "record_key", "commit_lsn")
        .agg(F.min(F.struct("op", "payload_json")).alias("c"))
        .select("table_name", "record_key", "commit_lsn", "c.op", "c.payload_json")
    )


def _with_before(changes: DataFrame, base: DataFrame, block: int) -> DataFrame:
    """Adds ``alive`` (the record exists just before the change) and ``version``
    (the image it then has). Blocks of a record are scanned on their own and
    linked by one summary row a block."""
    keys = ["table_name", "record_key"]
    c = changes.withColumn("block", F.floor(F.col("commit_lsn") / block))
    w = W.partitionBy(*keys, "block").orderBy("commit_lsn")
    past = w.rowsBetween(W.unboundedPreceding, -1)
    life = F.when(F.col("op") != "u", F.struct("op", "commit_lsn"))
    c = c.withColumns({"life": F.last(life, ignorenulls=True).over(past), "prev": F.last("commit_lsn").over(past)})
    blocks = c.groupBy(*keys, "block").agg(
        F.max(F.when(F.col("op") != "u", F.struct("commit_lsn", "op"))).alias("end_life"), F.max("commit_lsn").alias("end_lsn")
    )
    b = W.partitionBy(*keys).orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    blocks = blocks.withColumns(
        {"from_life": F.last("end_life.op", ignorenulls=True).over(b), "from_lsn": F.last("end_lsn").over(b)}
    )
    blocks = blocks.join(base.withColumn("in_base", F.lit(True)), keys, "left")
    linked = c.join(blocks.select(*keys, "block", "from_life", "from_lsn", "in_base"), [*keys, "block"])
    last_life = F.coalesce("life.op", "from_life")
    prev = F.coalesce("prev", "from_lsn")
    return linked.withColumn("alive", F.when(last_life.isNotNull(), last_life == "i").otherwise(F.coalesce("in_base", F.lit(False)))).withColumn(
        # An alive record's image is that of the change before, for every change of a record that exists takes effect.
        "version", F.when(F.col("alive"), prev)
    )


def signed_images(changes: DataFrame, base: DataFrame, block: int = BLOCK) -> DataFrame:
    """(table_name, record_key, version, n): the base's and the changes'
    contributions. ``base`` has distinct (table_name, record_key)."""
    c = _with_before(changes, base, block)
    effective = c.filter((F.col("op") == "i") | F.col("alive"))
    images = effective.select(
        "table_name",
        "record_key",
        F.explode(
            F.array_compact(
                F.array(
                    F.when(F.col("alive"), F.struct(F.col("version").alias("version"), F.lit(-1).alias("n"))),
                    F.when(F.col("op") != "d", F.struct(F.col("commit_lsn").alias("version"), F.lit(1).alias("n"))),
                )
            )
        ).alias("image"),
    ).select("table_name", "record_key", "image.version", "image.n")
    return base.select("table_name", "record_key", F.lit(None).cast("bigint").alias("version"), F.lit(1).alias("n")).unionByName(images)


def current_images(changes: DataFrame, base: DataFrame, block: int = BLOCK) -> DataFrame:
    """(table_name, record_key, commit_lsn) of the records that exist in the end;
    commit_lsn is the last change that took effect, whatever its number, and null
    for an untouched base row."""
    summed = signed_images(changes, base, block).groupBy("table_name", "record_key", "version").agg(F.sum("n").alias("n"))
    return summed.filter("n > 0").select("table_name", "record_key", F.col("version").alias("commit_lsn"))


def current_fields(changes: DataFrame, base_rows: DataFrame, live: DataFrame, fields: list[str]) -> DataFrame:
    """The current value of each field of the live records.

    base_rows   (table_name, record_key, <fields as strings>), one row a record
    live        the result of ``current_images``
    A field has the value of the last change that carries it since the record was
    last inserted, else of that insert's record (null where it lacks the field),
    else of the base. A payload that says null carries the field; one without the
    key doesn't. Aggregated with partial combination, so a hot record is no
    hot task."""
    keys = ["table_name", "record_key"]
    bounds = changes.groupBy(*keys).agg(F.max(F.when(F.col("op") == "i", F.col("commit_lsn"))).alias("born"))
    since = changes.filter("op <> 'd'").join(bounds, keys).filter("born is null or commit_lsn >= born")
    since = since.withColumn("sent", F.from_json("payload_json", "map<string,string>"))
    carried = lambda f: F.map_contains_key("sent", F.lit(f))
    newest = since.groupBy(*keys, "born").agg(
        *(F.max(F.when(carried(f), F.struct("commit_lsn", F.try_element_at("sent", F.lit(f)).alias("v")))).alias(f"new_{f}") for f in fields)
    )
    joined = live.join(newest, keys, "left").join(base_rows, keys, "left")
    return joined.select(
        *keys,
        "commit_lsn",
        *(F.when(F.col(f"new_{f}").isNotNull(), F.col(f"new_{f}.v")).when(F.col("born").isNull(), F.col(f)).alias(f) for f in fields),
    )
