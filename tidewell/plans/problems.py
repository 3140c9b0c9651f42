"""Queries of the core's data problems p1 to p7 over the project's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions.ids import date_sk, norm_id, strip
from tidewell.operators import asof, changefeed, exactly_once, history, late_events, orphans, timestamps
from tidewell.plans.hash_sql import xxhash64
from tidewell.plans.instant_sql import INSTANTS
from tidewell.sources.tables import table

# ------------------------------------------------------------------ p1


def _buffered(spark: SparkSession, d: str) -> DataFrame:
    cols = ["event_key", "event_timestamp", "ingested_at", "kafka_timestamp", "origin_zone"]
    e = timestamps.with_instants(table(spark, d, "fact_behavioral_event", cols))
    kafka = F.unix_micros("kafka_timestamp")
    return late_events.buffer_events(
        e.select("event_key", "event_timestamp_us", "ingested_at_us", "kafka_timestamp"),
        F.coalesce("event_timestamp_us", kafka),
        F.coalesce(kafka, "ingested_at_us"),
    )


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """The events that corrected a published day."""
    return late_events.corrections(_buffered(spark, d), "event_key")


def p1_provisional_days(spark: SparkSession, d: str) -> DataFrame:
    """Value of each day after each day of arrival, up to the cut-off."""
    p = late_events.provisional(_buffered(spark, d), "event_key")
    return p.select(
        late_events.day_of("period").alias("date_sk"),
        late_events.day_of("epoch").alias("as_of_date_sk"),
        "events",
        "n_corrections",
        "total",
    )


def p1_final_days(spark: SparkSession, d: str) -> DataFrame:
    """Final value of each day, released in event-time order."""
    return late_events.release(_buffered(spark, d), "event_key")


def p1_rejected_events(spark: SparkSession, d: str) -> DataFrame:
    """Events that came after the cut-off of their day's value, with their delay."""
    return late_events.rejected(_buffered(spark, d), "event_key")


# ------------------------------------------------------------------ p2


def _price_runs(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "dim_product", ["product_id", "price", "effective_from", "source_kind", "source_kafka_timestamp"])
    seen = p.filter("effective_from is not null and price > 0").select(
        norm_id("product_id").alias("product_id"),
        F.unix_micros("effective_from").alias("at"),
        "price",
        (F.lower(strip("source_kind")) == "snapshot").alias("is_snapshot"),
        "source_kafka_timestamp",
    )
    rank = [F.coalesce("is_snapshot", F.lit(False)), F.col("source_kafka_timestamp")]
    one = history.one_per_instant(seen.filter("product_id is not null"), "product_id", "at", "price", rank)
    return history.coalesce_runs(one, "product_id", "at", "price")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return _price_runs(spark, d).select("product_id", F.col("start").alias("effective_from_us"))


def p2_price_history(spark: SparkSession, d: str) -> DataFrame:
    """Every price version with the time it began and the time it ended."""
    return _price_runs(spark, d).select(
        "product_id", "price", F.col("start").alias("effective_from_us"), F.col("stop").alias("effective_to_us")
    )


_P2 = """
WITH seen AS (
  SELECT upper(trim(product_id, E' \\t\\n\\r')) AS product_id, price, effective_from, epoch_us(effective_from) AS at_us,
         row_number() OVER (PARTITION BY upper(trim(product_id, E' \\t\\n\\r')), effective_from
           ORDER BY (source_kind = 'snapshot') DESC, source_kafka_timestamp DESC NULLS LAST, price DESC) AS rn
  FROM dim_product
  WHERE effective_from IS NOT NULL AND price > 0 AND upper(trim(product_id, E' \\t\\n\\r')) <> ''
), changed AS (
  SELECT product_id, price, at_us, lag(price) OVER (PARTITION BY product_id ORDER BY at_us) AS before_price
  FROM seen WHERE rn = 1
), runs AS (
  SELECT product_id, price, at_us FROM changed WHERE before_price IS NULL OR before_price <> price
)
"""

# ------------------------------------------------------------------ p3

_P3 = (("fact_order", "order_id"), ("fact_order_item", "order_item_id"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Identifiers of the positions that the deletion vectors mark."""
    parts = []
    for name, key in _P3:
        lost = exactly_once.exactly_once(spark, f"{d}/{name}.parquet", key, "source_kafka_timestamp", [key], losers=True)
        parts.append(lost.select(F.lit(name).alias("table_name"), norm_id(key).alias("message_id")).distinct())
    return parts[0].unionByName(parts[1])


def p3_exactly_once(spark: SparkSession, d: str) -> DataFrame:
    """Both tables with one row for each id and all rows without one. Which of
    equal latest deliveries stays is a matter of position, so the row's other
    columns are left out here."""
    parts = []
    for name, key in _P3:
        rows = exactly_once.exactly_once(spark, f"{d}/{name}.parquet", key, "source_kafka_timestamp")
        parts.append(
            rows.select(F.lit(name).alias("table_name"), norm_id(key).alias("message_id"), F.unix_micros("source_kafka_timestamp").alias("delivered_us"))
        )
    return parts[0].unionByName(parts[1])


def p3_exactly_once_rows(spark: SparkSession, d: str) -> DataFrame:
    """As ``p3_exactly_once`` with all columns of both tables; those that only one
    has are null in the other's rows."""
    parts = [exactly_once.exactly_once(spark, f"{d}/{n}.parquet", k, "source_kafka_timestamp").withColumn("table_name", F.lit(n)) for n, k in _P3]
    return parts[0].unionByName(parts[1], allowMissingColumns=True)


def _p3_sql(name: str, key: str) -> str:
    idq = f"nullif(upper(trim({key}, E' \\t\\n\\r')), '')"
    return f"""
  SELECT '{name}' AS table_name, {idq} AS message_id, epoch_us(source_kafka_timestamp) AS delivered_us
  FROM {name}
  QUALIFY {idq} IS NULL OR row_number() OVER (PARTITION BY {idq} ORDER BY source_kafka_timestamp DESC NULLS LAST) = 1"""


# ------------------------------------------------------------------ p4


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    cols = ["event_key", "event_timestamp", "ingested_at", "kafka_timestamp", "origin_zone"]
    return timestamps.renormalised(table(spark, d, "fact_behavioral_event", cols))


def p4_writer_zones(spark: SparkSession, d: str) -> DataFrame:
    """The history declared by and estimated for each writer, those without a zone
    among them, the one that converts, and the values that contradict it."""
    e = table(spark, d, "fact_behavioral_event", ["event_timestamp", "origin_zone", "kafka_timestamp"])
    from tidewell.functions.instants import with_parsed

    votes = timestamps.zone_votes(with_parsed(e, {"p": "event_timestamp"}), "p", "origin_zone", F.col("kafka_timestamp"))
    return timestamps.offset_histories(votes, timestamps.candidate_zones(e.select("origin_zone"), "origin_zone"))


# ------------------------------------------------------------------ p5


def _tombstones(spark: SparkSession, d: str, topic: str) -> DataFrame:
    t = table(spark, d, "raw_tombstone", ["kafka_key", "kafka_topic", "kafka_timestamp", "order_id", "user_id"])
    t = t.filter((F.col("kafka_topic") == topic) & F.col("order_id").isNull() & F.col("user_id").isNull())
    return (
        t.select(norm_id("kafka_key").alias("id"), "kafka_timestamp")
        .filter("id is not null")
        .groupBy(F.xxhash64("id").alias("key"))
        .agg(F.max("kafka_timestamp").alias("gone_at"))
        # A tombstone without time still says that the parent is gone where there is none.
        .select("key", F.coalesce("gone_at", F.lit("0001-01-01").cast("timestamp")).alias("gone_at"))
    )


#: table, its id, its reference, its month, the parent, the parent's key, the topic of the parent's tombstones
_P5 = (
    ("fact_order", "order_id", "user_sk", "order_timestamp", "dim_user", "user_sk", "transactional.users"),
    ("fact_order_item", "order_item_id", "order_sk", "order_timestamp", "fact_order", "order_sk", "transactional.orders"),
    ("fact_return_refund", "return_refund_id", "order_item_sk", "return_timestamp", "fact_order_item", "order_item_sk", "transactional.order_items"),
)


def _orphans(spark: SparkSession, d: str) -> DataFrame:
    out = None
    for name, key, ref, at, parent, parent_key, topic in _P5:
        rows = table(spark, d, name, [key, ref, at, "source_kafka_timestamp"]).withColumn("id", norm_id(key))
        found = orphans.find_orphans(
            rows,
            ref,
            "id",
            "source_kafka_timestamp",
            table(spark, d, parent, [parent_key, "source_kafka_timestamp"]),
            parent_key,
            "source_kafka_timestamp",
            _tombstones(spark, d, topic),
            period=(date_sk(F.coalesce(at, "source_kafka_timestamp")) / 100).cast("int"),
        ).withColumn("table_name", F.lit(name))
        out = found if out is None else out.unionByName(found)
    return out


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return _orphans(spark, d).select("table_name", "record_key", "orphan_kind").distinct()


def p5_report(spark: SparkSession, d: str) -> DataFrame:
    """Orphan references by table, month (of the row, of its arrival where it has
    no time; null where it has neither) and kind."""
    return (
        _orphans(spark, d)
        .groupBy("table_name", F.col("period").alias("month_sk"), "orphan_kind")
        .agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("record_key").alias("n_records"))
    )


# ------------------------------------------------------------------ p6

_P6 = (("dim_user", "user_id"), ("fact_order", "order_id"), ("fact_return_refund", "return_refund_id"))


def _base_keys(spark: SparkSession, d: str) -> DataFrame:
    out = None
    for name, key in _P6:
        k = table(spark, d, name, [key]).select(F.lit(name).alias("table_name"), norm_id(key).alias("record_key")).filter("record_key is not null").distinct()
        out = k if out is None else out.unionByName(k)
    return out


def _changes(spark: SparkSession, d: str) -> DataFrame:
    cols = ["table_name", "record_key", "op", "commit_lsn", "payload_json"]
    return changefeed.distinct_changes(table(spark, d, "raw_change", cols))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return changefeed.current_images(_changes(spark, d), _base_keys(spark, d)).filter("commit_lsn is not null")


#: The fields that the feed's payloads carry besides the identifier.
_P6_FIELDS = {
    "dim_user": ["username", "device", "loyalty_tier", "location"],
    "fact_order": ["order_total", "status", "payment_method"],
    "fact_return_refund": ["refund_amount", "return_reason"],
}


def p6_current_state(spark: SparkSession, d: str) -> DataFrame:
    """Current value of every field of the feed for every live record of the three
    tables; fields of other tables are null."""
    fields = [f for fs in _P6_FIELDS.values() for f in fs]
    changes, base = _changes(spark, d), None
    for name, key in _P6:
        own = _P6_FIELDS[name]
        rows = (
            table(spark, d, name, [key, *own, "source_kafka_timestamp"])
            .select(norm_id(key).alias("record_key"), *[F.col(f).cast("string").alias(f) for f in own], "source_kafka_timestamp")
            .filter("record_key is not null")
            .groupBy("record_key")
            .agg(F.max(F.struct("source_kafka_timestamp", *own)).alias("v"))
            .select(F.lit(name).alias("table_name"), "record_key", *[(F.col(f"v.{f}") if f in own else F.lit(None).cast("string")).alias(f) for f in fields])
        )
        base = rows if base is None else base.unionByName(rows)
    live = changefeed.current_images(changes, base.select("table_name", "record_key"))
    return changefeed.current_fields(changes, base, live, fields)


_P6_SQL = """
WITH ids AS (
  SELECT DISTINCT * FROM (
    SELECT 'dim_user' AS table_name, nullif(upper(trim(user_id, E' \\t\\n\\r')), '') AS record_key FROM dim_user
    UNION ALL SELECT 'fact_order', nullif(upper(trim(order_id, E' \\t\\n\\r')), '') FROM fact_order
    UNION ALL SELECT 'fact_return_refund', nullif(upper(trim(return_refund_id, E' \\t\\n\\r')), '') FROM fact_return_refund)
  WHERE record_key IS NOT NULL
), c AS (
  SELECT DISTINCT table_name, nullif(upper(trim(record_key, E' \\t\\n\\r')), '') AS record_key, commit_lsn,
    CASE WHEN coalesce(trim(op, E' \\t\\n\\r'), '') = '' AND coalesce(trim(payload_json, E' \\t\\n\\r'), '') = '' THEN 'd'
         WHEN lower(trim(op, E' \\t\\n\\r')) IN ('i', 'insert', 'c', 'create') THEN 'i'
         WHEN lower(trim(op, E' \\t\\n\\r')) IN ('u', 'update') THEN 'u'
         WHEN lower(trim(op, E' \\t\\n\\r')) IN ('d', 'delete') THEN 'd' END AS op
  FROM raw_change WHERE commit_lsn IS NOT NULL
), k AS (
  SELECT table_name, record_key, max(commit_lsn) AS last_lsn,
    max_by(op, commit_lsn) FILTER (WHERE op <> 'u') AS last_life
  FROM c WHERE record_key IS NOT NULL AND op IS NOT NULL GROUP BY ALL
)
SELECT k.table_name, k.record_key, k.last_lsn AS commit_lsn
FROM k LEFT JOIN ids USING (table_name, record_key)
WHERE k.last_life = 'i' OR (k.last_life IS NULL AND ids.record_key IS NOT NULL)
"""

# ------------------------------------------------------------------ p7


def _items_with_versions(spark: SparkSession, d: str, as_known: bool = False) -> DataFrame:
    items = table(spark, d, "fact_order_item", ["order_item_id", "product_id", "product_sk", "order_timestamp"]).select(
        norm_id("product_id").alias("entity"),
        F.unix_micros("order_timestamp").alias("at_us"),
        norm_id("order_item_id").alias("order_item_id"),
        F.col("product_sk").alias("stored_sk"),
    )
    cols = ["product_id", "product_sk", "effective_from", "effective_to", "source_kind", "source_kafka_timestamp"]
    versions = table(spark, d, "dim_product", cols).select(
        norm_id("product_id").alias("entity"),
        F.unix_micros("effective_from").alias("start_us"),
        F.unix_micros("effective_to").alias("stop_us"),
        F.col("product_sk").alias("version_id"),
        F.coalesce(F.lower(strip("source_kind")) == "snapshot", F.lit(False)).alias("is_snapshot"),
        F.col("source_kafka_timestamp").alias("source_at"),
        *([F.unix_micros("source_kafka_timestamp").alias("known_us")] if as_known else []),
    )
    joined = asof.asof_versions(items, versions, [F.col("is_snapshot"), F.col("source_at")])
    in_force = F.col("version_id").isNotNull() & (F.col("stop_us").isNull() | (F.col("stop_us") > F.col("at_us")))
    return joined.withColumn("product_sk", F.when(in_force, F.col("version_id")).otherwise(F.lit(0).cast("bigint")))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    """By start alone, as the problem's statement has it."""
    j = _items_with_versions(spark, d).filter("order_item_id is not null and at_us is not null")
    return j.filter(~F.col("stored_sk").eqNullSafe(F.col("product_sk"))).select("order_item_id", "product_sk").distinct()


def p7_items(spark: SparkSession, d: str) -> DataFrame:
    """Every item row with the version in force at its time, 0 where none is
    known (also for items without time or product)."""
    return _items_with_versions(spark, d).select("order_item_id", "at_us", "stored_sk", "product_sk")


def p7_items_as_known(spark: SparkSession, d: str) -> DataFrame:
    """The same with the versions that had reached the source by the item's time:
    a backdated version that came later is not used."""
    return _items_with_versions(spark, d, as_known=True).select("order_item_id", "at_us", "product_sk")


_P7 = """
WITH v AS (
  SELECT upper(trim(product_id, E' \\t\\n\\r')) AS product_id, effective_from, effective_to, product_sk,
    row_number() OVER (PARTITION BY upper(trim(product_id, E' \\t\\n\\r')), effective_from
      ORDER BY (source_kind = 'snapshot') DESC, source_kafka_timestamp DESC NULLS LAST, effective_to DESC NULLS FIRST, product_sk DESC) AS rn
  FROM dim_product WHERE effective_from IS NOT NULL
), i AS (
  SELECT nullif(upper(trim(order_item_id, E' \\t\\n\\r')), '') AS order_item_id, upper(trim(product_id, E' \\t\\n\\r')) AS product_id,
    order_timestamp, product_sk AS stored_sk
  FROM fact_order_item
), j AS (
  SELECT i.order_item_id, i.order_timestamp, i.stored_sk,
    CASE WHEN v.product_sk IS NOT NULL AND (v.effective_to IS NULL OR v.effective_to > i.order_timestamp) THEN v.product_sk ELSE 0 END AS product_sk
  FROM i ASOF LEFT JOIN (SELECT * FROM v WHERE rn = 1) v
    ON i.product_id = v.product_id AND i.order_timestamp >= v.effective_from
)
"""

_P7_KNOWN = """
WITH v AS (
  SELECT upper(trim(product_id, E' \\t\\n\\r')) AS product_id, effective_from, effective_to, product_sk, greatest(effective_from, source_kafka_timestamp) AS available,
    (coalesce(source_kind, '') = 'snapshot', coalesce(epoch_us(source_kafka_timestamp), -9000000000000000000), coalesce(epoch_us(effective_to), 9000000000000000000), product_sk) AS prio
  FROM dim_product WHERE effective_from IS NOT NULL
), i AS (
  SELECT row_number() OVER () AS n, nullif(upper(trim(order_item_id, E' \\t\\n\\r')), '') AS order_item_id, upper(trim(product_id, E' \\t\\n\\r')) AS product_id, order_timestamp
  FROM fact_order_item
), b AS (
  SELECT i.n, arg_max(v.product_sk, (v.effective_from, v.prio)) AS product_sk, arg_max(coalesce(epoch_us(v.effective_to), 9000000000000000000), (v.effective_from, v.prio)) AS stop_us
  FROM i JOIN v ON i.product_id = v.product_id AND v.available <= i.order_timestamp GROUP BY 1
)
SELECT i.order_item_id, epoch_us(i.order_timestamp) AS at_us, CASE WHEN b.stop_us > epoch_us(i.order_timestamp) THEN b.product_sk ELSE 0 END AS product_sk
FROM i LEFT JOIN b USING (n)
"""

_CANON = "\\d{4}-\\d\\d-\\d\\dT\\d\\d:\\d\\d:\\d\\d\\.\\d{3}Z"
_P4 = (
    "WITH " + INSTANTS
    + f"""SELECT DISTINCT event_key, field_name, epoch_us FROM (
  SELECT event_key, 'event_timestamp' AS field_name, event_timestamp_us AS epoch_us, event_timestamp AS s FROM timed
  UNION ALL SELECT event_key, 'ingested_at', ingested_at_us, ingested_at FROM timed)
WHERE epoch_us IS NOT NULL AND NOT regexp_full_match(s, '{_CANON}')"""
)
_DAY_US = 86_400_000_000
_P1 = (
    "WITH " + INSTANTS
    + f""", b AS (
  SELECT event_key, coalesce(event_timestamp_us, epoch_us(kafka_timestamp)) AS e, coalesce(epoch_us(kafka_timestamp), ingested_at_us) AS a FROM timed
), k AS (
  SELECT *, e - e % {_DAY_US} AS period, greatest(a - a % {_DAY_US}, e - e % {_DAY_US}) AS epoch, strftime(make_timestamp(e), '%Y%m%d')::INT AS date_sk FROM b WHERE e IS NOT NULL AND a IS NOT NULL
), held AS (
  SELECT period, date_sk, event_key, min(e) AS e FROM k WHERE a - e <= {72 * 3_600_000_000} GROUP BY ALL
)
"""
)
_SK = "strftime(make_timestamp({}), '%Y%m%d')::INT"

_GONE = f"""gone AS (SELECT kafka_topic, {xxhash64("id")} AS ref, gone_at FROM (SELECT kafka_topic, id, coalesce(max(kafka_timestamp), TIMESTAMPTZ '0001-01-01 00:00:00+00') AS gone_at
  FROM (SELECT kafka_topic, kafka_timestamp, nullif(upper(trim(kafka_key, E' \\t\\n\\r')), '') AS id FROM raw_tombstone WHERE order_id IS NULL AND user_id IS NULL) WHERE id IS NOT NULL GROUP BY 1, 2))"""
_P5_SQL = (
    f"WITH {_GONE}, o AS ("
    + " UNION ALL ".join(
        f"""SELECT '{name}' AS table_name, r.record_key, r.month_sk, CASE WHEN g.ref IS NOT NULL AND (p.ref IS NULL OR g.gone_at > p.last_at) THEN 'deleted' WHEN p.ref IS NULL THEN 'missing' WHEN p.first_at > r.came THEN 'late' END AS orphan_kind
  FROM (SELECT nullif(upper(trim({key}, E' \\t\\n\\r')), '') AS record_key, {ref} AS ref, source_kafka_timestamp AS came, strftime(coalesce({at}, source_kafka_timestamp) AT TIME ZONE 'UTC', '%Y%m')::INT AS month_sk FROM {name}) r
  LEFT JOIN (SELECT {pk} AS ref, min(source_kafka_timestamp) AS first_at, max(source_kafka_timestamp) AS last_at FROM {parent} WHERE {pk} IS NOT NULL GROUP BY 1) p ON p.ref = r.ref
  LEFT JOIN gone g ON g.ref = r.ref AND g.kafka_topic = '{topic}' WHERE r.record_key IS NOT NULL AND r.ref IS NOT NULL"""
        for name, key, ref, at, parent, pk, topic in _P5
    )
    + ") "
)

#: Current state of the three tables: each field's value in the last change that
#: carries it since the last insert, else the base's where nothing was inserted.
_STATE_FIELDS = [f for fs in _P6_FIELDS.values() for f in fs]
_P6_STATE = (
    _P6_SQL[: _P6_SQL.index("), k AS (")].replace("SELECT DISTINCT table_name, nullif(upper(trim(record_key", "SELECT DISTINCT payload_json, table_name, nullif(upper(trim(record_key")
    + """), live AS (SELECT k.table_name, k.record_key, k.last_lsn AS commit_lsn FROM (
    SELECT table_name, record_key, max(commit_lsn) AS last_lsn, max_by(op, commit_lsn) FILTER (WHERE op <> 'u') AS last_life
    FROM c WHERE record_key IS NOT NULL AND op IS NOT NULL GROUP BY ALL) k LEFT JOIN ids USING (table_name, record_key)
  WHERE k.last_life = 'i' OR (k.last_life IS NULL AND ids.record_key IS NOT NULL)
), untouched AS (SELECT ids.*, NULL::BIGINT AS commit_lsn FROM ids ANTI JOIN (SELECT * FROM c WHERE op IS NOT NULL) USING (table_name, record_key)
), born AS (SELECT table_name, record_key, max(commit_lsn) FILTER (WHERE op = 'i') AS born FROM c WHERE op IS NOT NULL GROUP BY ALL
), since AS (SELECT c.*, b.born FROM c JOIN born b USING (table_name, record_key) WHERE c.op IN ('i', 'u') AND (b.born IS NULL OR c.commit_lsn >= b.born)
), news AS (SELECT table_name, record_key, any_value(born) AS born, """
    + ", ".join(
        f"bool_or(coalesce(json_exists(payload_json, '$.{f}'), false)) AS has_{f}, arg_max_null(json_extract_string(payload_json, '$.{f}'), commit_lsn) FILTER (WHERE json_exists(payload_json, '$.{f}')) AS new_{f}"
        for f in _STATE_FIELDS
    )
    + " FROM since GROUP BY 1, 2), base AS ("
    + " UNION ALL BY NAME ".join(
        f"SELECT '{name}' AS table_name, nullif(upper(trim({key}, E' \\t\\n\\r')), '') AS record_key, {', '.join(f'{f}::VARCHAR AS {f}' for f in _P6_FIELDS[name])} FROM {name} WHERE trim({key}, E' \\t\\n\\r') <> '' "
        f"QUALIFY row_number() OVER (PARTITION BY record_key ORDER BY source_kafka_timestamp DESC NULLS LAST, {', '.join(f'{name}.{f} DESC NULLS LAST' for f in _P6_FIELDS[name])}) = 1"
        for name, key in _P6
    )
    + ") SELECT a.table_name, a.record_key, a.commit_lsn, "
    + ", ".join(f"CASE WHEN n.has_{f} THEN n.new_{f} WHEN n.born IS NULL THEN b.{f} END AS {f}" for f in _STATE_FIELDS)
    + " FROM (SELECT * FROM live UNION ALL BY NAME SELECT * FROM untouched) a LEFT JOIN news n USING (table_name, record_key) LEFT JOIN base b USING (table_name, record_key)"
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p1_found": p1_found,
    "p1_provisional_days": p1_provisional_days,
    "p1_final_days": p1_final_days,
    "p1_rejected_events": p1_rejected_events,
    "p2_found": p2_found,
    "p2_price_history": p2_price_history,
    "p3_found": p3_found,
    "p3_exactly_once": p3_exactly_once,
    "p3_exactly_once_rows": p3_exactly_once_rows,
    "p4_found": p4_found,
    "p4_writer_zones": p4_writer_zones,
    "p5_found": p5_found,
    "p5_report": p5_report,
    "p6_found": p6_found,
    "p6_current_state": p6_current_state,
    "p7_found": p7_found,
    "p7_items": p7_items,
    "p7_items_as_known": p7_items_as_known,
}

ORACLES: dict[str, str] = {
    "p1_found": _P1 + "SELECT DISTINCT event_key, date_sk FROM k WHERE epoch > period AND a - e <= 259200000000",
    "p1_provisional_days": _P1
    + f""", firsts AS (SELECT period, event_key, min(epoch) AS first FROM k WHERE a - e <= 259200000000 GROUP BY ALL),
each AS (SELECT DISTINCT period, event_key, epoch FROM k WHERE a - e <= 259200000000),
steps AS (SELECT period, epoch, count(*) FILTER (WHERE epoch = first) AS events FROM each JOIN firsts USING (period, event_key) GROUP BY ALL)
SELECT {_SK.format("period")} AS date_sk, {_SK.format("epoch")} AS as_of_date_sk, events, CASE WHEN epoch > period THEN events ELSE 0 END AS n_corrections,
  (sum(events) OVER (PARTITION BY period ORDER BY epoch))::BIGINT AS total FROM steps""",
    "p1_final_days": _P1
    + """, g AS (SELECT *, e - lag(e) OVER (PARTITION BY period ORDER BY e, event_key) AS pause FROM held)
SELECT date_sk, count(*) AS n_events, arg_min(event_key, (e, event_key)) AS first_key, arg_max(event_key, (e, event_key)) AS last_key, max(pause) AS longest_pause_us FROM g GROUP BY period, date_sk""",
    "p1_rejected_events": _P1 + "SELECT DISTINCT event_key, date_sk, (a - e) // 3600000000 AS hours_late FROM k WHERE a - e > 259200000000",
    "p4_found": _P4,
    "p5_found": _P5_SQL + "SELECT DISTINCT table_name, record_key, orphan_kind FROM o WHERE orphan_kind IS NOT NULL",
    "p5_report": _P5_SQL + "SELECT table_name, month_sk, orphan_kind, count(*) AS n_rows, count(DISTINCT record_key) AS n_records FROM o WHERE orphan_kind IS NOT NULL GROUP BY 1, 2, 3",
    "p6_current_state": _P6_STATE,
    "p2_found": _P2 + "SELECT product_id, at_us AS effective_from_us FROM runs",
    "p2_price_history": _P2
    + "SELECT product_id, price, at_us AS effective_from_us, lead(at_us) OVER (PARTITION BY product_id ORDER BY at_us) AS effective_to_us FROM runs",
    "p3_found": " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, upper(trim({k}, E' \\t\\n\\r')) AS message_id FROM {n} "
        f"WHERE upper(trim({k}, E' \\t\\n\\r')) <> '' GROUP BY 2 HAVING count(*) > 1"
        for n, k in _P3
    ),
    "p3_exactly_once": " UNION ALL ".join(f"SELECT * FROM ({_p3_sql(n, k)})" for n, k in _P3),
    "p6_found": _P6_SQL,
    "p7_found": _P7
    + "SELECT DISTINCT order_item_id, product_sk FROM j WHERE order_item_id IS NOT NULL AND order_timestamp IS NOT NULL AND stored_sk IS DISTINCT FROM product_sk",
    "p7_items_as_known": _P7_KNOWN,
    "p7_items": _P7 + "SELECT order_item_id, epoch_us(order_timestamp) AS at_us, stored_sk, product_sk FROM j",
}
