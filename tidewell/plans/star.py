"""Queries of the star schema: cleaning, validation, dimensions, facts, joins,
upserts, denormalized tables and audits."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions.ids import blank, date_sk, norm_id, strip
from tidewell.operators import asof, audits, changefeed, versions
from tidewell.operators.calendar import calendar
from tidewell.operators.quality import Rule, inclusive_days, quarantine, split_valid, whole_day, with_reasons
from tidewell.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: Valid loyalty tiers, the e-mail form, and the tolerance of item totals (fixed values).
TIERS = ["Bronze", "Silver", "Gold", "Platinum"]
EMAIL = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"
TOLERANCE = "0.01"
#: The day that times of the data are judged by; a parameter of the rules.
AS_OF = "2026-04-15"

_WS = "E' \\t\\n\\r'"


def _id(c: str) -> str:
    return f"nullif(upper(trim({c}, {_WS})), '')"


def query(sql: str | None = None) -> Callable:
    """Registers a query under its function's name."""

    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


# ------------------------------------------------------------ dimensions


@query(
    """SELECT (year(d) * 10000 + month(d) * 100 + day(d))::INT AS date_sk, d::DATE AS full_date, year(d)::INT AS year, quarter(d)::INT AS quarter,
  month(d)::INT AS month, monthname(d) AS month_name, weekofyear(d)::INT AS week_of_year, day(d)::INT AS day,
  (dayofweek(d) + 1)::INT AS day_of_week, dayname(d) AS day_name, dayofweek(d) IN (0, 6) AS is_weekend
FROM range(DATE '2024-01-01', DATE '2031-01-01', INTERVAL 1 DAY) t(d)"""
)
def dim_date_calendar(spark: SparkSession, d: str) -> DataFrame:
    return calendar(spark, date(2024, 1, 1), date(2030, 12, 31))


@query(
    """WITH b AS (SELECT min((order_timestamp AT TIME ZONE 'UTC')::DATE) AS a, greatest(max((order_timestamp AT TIME ZONE 'UTC')::DATE), DATE '2030-12-31') AS z FROM fact_order)
SELECT (year(d) * 10000 + month(d) * 100 + day(d))::INT AS date_sk, d::DATE AS full_date, dayofweek(d) IN (0, 6) AS is_weekend FROM (SELECT unnest(generate_series(a, z, INTERVAL 1 DAY)) AS d FROM b)"""
)
def dim_date_of_orders(spark: SparkSession, d: str) -> DataFrame:
    """The calendar from the first order's day to the last's, at least to the end of
    2030; one row of bounds comes to the driver."""
    a, z = table(spark, d, "fact_order", ["order_timestamp"]).agg(F.min(F.to_date("order_timestamp")), F.max(F.to_date("order_timestamp"))).first()
    far = date(2030, 12, 31)
    days = calendar(spark, a or far, max(z or far, far))
    return (days if a else days.limit(0)).select("date_sk", "full_date", "is_weekend")


def _latest_users(spark: SparkSession, d: str) -> DataFrame:
    cols = ["user_id", "username", "email", "signup_date", "device", "loyalty_tier", "location", "source_kafka_timestamp"]
    u = table(spark, d, "dim_user", cols).filter(~F.coalesce(strip("user_id"), F.lit("")).eqNullSafe("UNKNOWN"))
    u = u.select(
        norm_id("user_id").alias("user_id"),
        strip("username").alias("username"),
        F.lower(strip("email")).alias("email"),
        "signup_date",
        F.when(blank("device"), "Unknown").otherwise(strip("device")).alias("device"),
        F.initcap(F.lower(strip("loyalty_tier"))).alias("loyalty_tier"),
        strip("location").alias("location"),
        "source_kafka_timestamp",
    )
    content = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("username", "email", "signup_date", "device", "loyalty_tier", "location")])
    return versions.latest_by(u, F.col("user_id"), [F.col("source_kafka_timestamp").desc_nulls_last(), content.asc()])


def _user_rules(as_of: str = AS_OF) -> list[Rule]:
    return [
        Rule("missing_user_id", blank("user_id")),
        Rule("missing_username", blank("username")),
        Rule("missing_email", blank("email")),
        Rule("invalid_email", ~blank("email") & ~F.col("email").rlike(EMAIL)),
        Rule("missing_signup_date", F.col("signup_date").isNull()),
        Rule("future_signup_date", F.col("signup_date") > F.lit(as_of).cast("date")),
        Rule("invalid_loyalty_tier", ~F.coalesce(F.col("loyalty_tier").isin(TIERS), F.lit(True))),
        Rule("missing_location", blank("location")),
        Rule("missing_kafka_timestamp", F.col("source_kafka_timestamp").isNull()),
    ]


_USERS = f"""
WITH u AS (
  SELECT {_id("user_id")} AS user_id, trim(username, {_WS}) AS username, lower(trim(email, {_WS})) AS email, signup_date,
    CASE WHEN coalesce(trim(device, {_WS}), '') = '' THEN 'Unknown' ELSE trim(device, {_WS}) END AS device,
    upper(left(trim(loyalty_tier, {_WS}), 1)) || lower(substr(trim(loyalty_tier, {_WS}), 2)) AS loyalty_tier,
    trim(location, {_WS}) AS location, source_kafka_timestamp
  FROM dim_user WHERE coalesce(trim(user_id, {_WS}), '') <> 'UNKNOWN'
), l AS (
  SELECT * FROM u QUALIFY user_id IS NULL OR row_number() OVER (PARTITION BY user_id ORDER BY source_kafka_timestamp DESC NULLS LAST,
    coalesce(username, '') || '|' || coalesce(email, '') || '|' || coalesce(signup_date::VARCHAR, '') || '|' || coalesce(device, '') || '|' || coalesce(loyalty_tier, '') || '|' || coalesce(location, '')) = 1
), r AS (
  SELECT *, concat_ws('; ', CASE WHEN user_id IS NULL THEN 'missing_user_id' END,
    CASE WHEN coalesce(username, '') = '' THEN 'missing_username' END,
    CASE WHEN coalesce(email, '') = '' THEN 'missing_email' END,
    CASE WHEN coalesce(email, '') <> '' AND NOT regexp_matches(email, '{EMAIL}') THEN 'invalid_email' END,
    CASE WHEN signup_date IS NULL THEN 'missing_signup_date' END,
    CASE WHEN signup_date > DATE '{AS_OF}' THEN 'future_signup_date' END,
    CASE WHEN loyalty_tier IS NOT NULL AND loyalty_tier NOT IN ('Bronze', 'Silver', 'Gold', 'Platinum') THEN 'invalid_loyalty_tier' END,
    CASE WHEN coalesce(location, '') = '' THEN 'missing_location' END,
    CASE WHEN source_kafka_timestamp IS NULL THEN 'missing_kafka_timestamp' END) AS reason
  FROM l
)
"""


_USER_COLUMNS = ["username", "email", "signup_date", "device", "loyalty_tier", "location"]


@query(
    _USERS
    + f"SELECT user_id, {', '.join(_USER_COLUMNS)}, sha256(concat_ws('||', {', '.join(f'coalesce({c}::VARCHAR, chr(0))' for c in _USER_COLUMNS)})) AS record_hash, epoch_us(source_kafka_timestamp) AS source_us FROM r WHERE reason = ''"
)
def dim_user_clean(spark: SparkSession, d: str) -> DataFrame:
    """The valid users with the hash of their tracked attributes."""
    valid, _ = split_valid(_latest_users(spark, d), _user_rules())
    return valid.select("user_id", *_USER_COLUMNS, versions.record_hash(_USER_COLUMNS).alias("record_hash"), F.unix_micros("source_kafka_timestamp").alias("source_us"))


@query(_USERS + "SELECT user_id, reason FROM r WHERE reason <> ''")
def users_rejected(spark: SparkSession, d: str) -> DataFrame:
    _, bad = split_valid(_latest_users(spark, d), _user_rules())
    return bad.select("user_id", F.col("_dq_error_reason").alias("reason"))


@query(
    """SELECT sha256(kafka_topic || '|' || kafka_partition || '|' || kafka_offset) AS quarantine_id, table_name AS entity, 'open' AS status
FROM raw_change WHERE commit_timestamp IS NULL OR payload_json IS NULL"""
)
def change_quarantine(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "raw_change", ["table_name", "commit_timestamp", "payload_json", "kafka_topic", "kafka_partition", "kafka_offset"])
    rules = [Rule("missing_commit_time", F.col("commit_timestamp").isNull()), Rule("missing_payload", F.col("payload_json").isNull())]
    _, bad = split_valid(c, rules)
    q = quarantine(bad.withColumn("_dq_entity", F.col("table_name")), "change", "unknown", F.lit("2026-06-01").cast("timestamp"))
    return q.select(F.col("_dq_quarantine_id").alias("quarantine_id"), F.col("_dq_entity").alias("entity"), F.col("_dq_status").alias("status"))


@query(
    f"""SELECT DISTINCT kafka_topic, {_id("kafka_key")} AS deleted_key FROM raw_tombstone
WHERE order_id IS NULL AND user_id IS NULL AND {_id("kafka_key")} IS NOT NULL"""
)
def tombstone_split(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "raw_tombstone", ["kafka_key", "kafka_topic", "order_id", "user_id"])
    t = t.withColumn("key", F.when(~blank("kafka_key"), F.struct("kafka_topic", norm_id("kafka_key").alias("deleted_key"))))
    return versions.split_tombstones(t, "key", ["order_id", "user_id"])[1].select("key.*")


def _prices(spark: SparkSession, d: str) -> DataFrame:
    from tidewell.plans.problems import _price_runs

    return _price_runs(spark, d)


def _versions(spark: SparkSession, d: str) -> DataFrame:
    return _prices(spark, d).select(
        "product_id", "price", F.timestamp_micros("start").alias("effective_from"), F.timestamp_micros("stop").alias("effective_to"), F.col("stop").isNull().alias("is_current")
    )


def _p2() -> str:
    from tidewell.plans.problems import _P2

    return _P2


@query(
    _p2()
    + """, v AS (SELECT product_id, price, at_us, lead(at_us) OVER (PARTITION BY product_id ORDER BY at_us) AS to_us FROM runs)
SELECT product_id, price::DOUBLE AS price, at_us AS effective_from_us, to_us AS effective_to_us, to_us IS NULL AS is_current FROM v
UNION ALL SELECT 'UNKNOWN', 0.0, 0, NULL, true"""
)
def dim_product_scd2(spark: SparkSession, d: str) -> DataFrame:
    v = versions.with_unknown(
        _versions(spark, d), {"product_id": "UNKNOWN", "price": 0, "effective_from": date(1970, 1, 1), "is_current": True}
    )
    return v.select("product_id", F.col("price").cast("double").alias("price"), F.unix_micros("effective_from").alias("effective_from_us"), F.unix_micros("effective_to").alias("effective_to_us"), "is_current")


@query(
    """WITH v AS (SELECT product_id, effective_from, effective_to, source_kafka_timestamp,
  lead(effective_from) OVER (PARTITION BY product_id ORDER BY effective_from, effective_to NULLS LAST) AS nxt FROM dim_product WHERE effective_from IS NOT NULL)
SELECT product_id, count(*) AS n_overlaps FROM v WHERE nxt IS NOT NULL AND (effective_to IS NULL OR effective_to > nxt) GROUP BY 1"""
)
def scd2_overlap_audit(spark: SparkSession, d: str) -> DataFrame:
    v = table(spark, d, "dim_product", ["product_id", "effective_from", "effective_to"]).filter("effective_from is not null")
    return versions.overlaps(v, "product_id", "effective_from", "effective_to").groupBy("product_id").agg(F.count(F.lit(1)).alias("n_overlaps"))


# ------------------------------------------------------------ facts


#: What the feed's dim_user payloads carry, the tracked attributes of the dimension.
_TRACKED = ["username", "device", "loyalty_tier", "location"]


def _user_merge(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """(target, source) of a merge of the feed into dim_user, without any filter
    but for rows without id. The target has every user id; a user's row is the
    latest, rows without time last. The source has the last state that the feed
    gives each user, what a change doesn't carry staying as it was, and the latest
    time at which the feed brought one of the user's changes."""
    u = table(spark, d, "dim_user", ["user_id", *_TRACKED, "source_kafka_timestamp"])
    latest = F.max(F.struct("source_kafka_timestamp", *_TRACKED))
    target = u.groupBy(norm_id("user_id").alias("user_id")).agg(latest.alias("v")).filter("user_id is not null").select("user_id", "v.*")
    raw = table(spark, d, "raw_change", ["table_name", "record_key", "op", "commit_lsn", "payload_json", "kafka_timestamp"]).filter("table_name = 'dim_user'")
    c = changefeed.distinct_changes(raw.drop("kafka_timestamp"))
    sent = c.filter("op <> 'd'").select(F.lit("dim_user").alias("table_name"), "record_key").distinct().withColumn("commit_lsn", F.lit(None).cast("bigint"))
    known = target.select(F.lit("dim_user").alias("table_name"), F.col("user_id").alias("record_key"), *_TRACKED)
    state = changefeed.current_fields(c, known, sent, _TRACKED).select(F.col("record_key").alias("user_id"), *_TRACKED)
    came = raw.groupBy(norm_id("record_key").alias("user_id")).agg(F.max("kafka_timestamp").alias("source_kafka_timestamp"))
    return target, state.join(came, "user_id", "left")


def _user_merge_sql() -> str:
    """CTEs cur (the target) and inc (the source)."""
    from tidewell.plans.problems import _P6_STATE

    head = _P6_STATE[: _P6_STATE.index(") SELECT a.table_name")]
    fields = ", ".join(f"CASE WHEN n.has_{f} THEN n.new_{f} WHEN n.born IS NULL THEN b.{f} END AS {f}" for f in _TRACKED)
    return (
        head
        + f"""), cur AS (SELECT * FROM (SELECT {_id("user_id")} AS user_id, {", ".join(_TRACKED)}, source_kafka_timestamp FROM dim_user) WHERE user_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY source_kafka_timestamp DESC NULLS LAST, {", ".join(f"{f} DESC NULLS LAST" for f in _TRACKED)}) = 1),
came AS (SELECT {_id("record_key")} AS user_id, max(kafka_timestamp) AS source_kafka_timestamp FROM raw_change WHERE table_name = 'dim_user' GROUP BY 1),
inc AS (SELECT n.record_key AS user_id, {fields}, came.source_kafka_timestamp FROM (SELECT * FROM news WHERE table_name = 'dim_user') n LEFT JOIN (SELECT * FROM base WHERE table_name = 'dim_user') b USING (record_key) LEFT JOIN came ON came.user_id = n.record_key)
"""
    )


def _merged_sql(take: str) -> str:
    columns = ", ".join(f"CASE WHEN {take} THEN inc.{c} ELSE cur.{c} END AS {c}" for c in ["user_id", *_TRACKED])
    at = f"epoch_us(CASE WHEN {take} THEN inc.source_kafka_timestamp ELSE cur.source_kafka_timestamp END) AS source_us"
    return _user_merge_sql() + f"SELECT {columns}, {at} FROM cur FULL JOIN inc ON cur.user_id = inc.user_id"


def _merged(df: DataFrame) -> DataFrame:
    return df.select("user_id", *_TRACKED, F.unix_micros("source_kafka_timestamp").alias("source_us"))


_DIFFERS = " OR ".join(f"inc.{f} IS DISTINCT FROM cur.{f}" for f in _TRACKED)


@query(
    _user_merge_sql()
    + f"SELECT inc.user_id, {', '.join('inc.' + f for f in _TRACKED)}, CASE WHEN cur.user_id IS NULL THEN 'insert' ELSE 'update' END AS change_type FROM inc LEFT JOIN cur ON cur.user_id = inc.user_id WHERE cur.user_id IS NULL OR {_DIFFERS}"
)
def scd1_user_changes(spark: SparkSession, d: str) -> DataFrame:
    """Users that the feed adds or changes in any tracked attribute."""
    target, source = _user_merge(spark, d)
    return versions.scd1_changes(target, source, "user_id", _TRACKED).select("user_id", *_TRACKED, "change_type")


@query(_merged_sql("cur.user_id IS NULL"))
def upsert_insert_missing(spark: SparkSession, d: str) -> DataFrame:
    return _merged(versions.upsert(*_user_merge(spark, d), "user_id"))


@query(_merged_sql("(cur.user_id IS NULL OR coalesce(inc.source_kafka_timestamp > cur.source_kafka_timestamp, false))"))
def upsert_update_if(spark: SparkSession, d: str) -> DataFrame:
    """Replaced where the source is newer; an equal or unknown time changes nothing."""
    return _merged(versions.upsert(*_user_merge(spark, d), "user_id", versions.NEWER))


@query(_merged_sql("inc.user_id IS NOT NULL"))
def upsert_update_always(spark: SparkSession, d: str) -> DataFrame:
    return _merged(versions.upsert(*_user_merge(spark, d), "user_id", "true"))


_ORDERS = f"""
WITH o AS (
  SELECT {_id("order_id")} AS order_id, user_sk, order_timestamp, order_total, lower(trim(status, {_WS})) AS status, lower(trim(payment_method, {_WS})) AS payment_method, source_kafka_timestamp
  FROM fact_order
  QUALIFY {_id("order_id")} IS NULL OR row_number() OVER (PARTITION BY {_id("order_id")} ORDER BY source_kafka_timestamp DESC NULLS LAST, order_total DESC NULLS LAST,
    order_timestamp DESC NULLS LAST, user_sk DESC NULLS LAST, lower(trim(status, {_WS})) DESC NULLS LAST, lower(trim(payment_method, {_WS})) DESC NULLS LAST) = 1
)
"""


def _orders(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "fact_order", ["order_id", "user_sk", "order_timestamp", "order_total", "status", "payment_method", "source_kafka_timestamp"]).select(
        norm_id("order_id").alias("order_id"), "user_sk", "order_timestamp", "order_total", F.lower(strip("status")).alias("status"), F.lower(strip("payment_method")).alias("payment_method"),
        "source_kafka_timestamp",
    )
    return versions.latest_by(o, F.col("order_id"), versions.newest_first("source_kafka_timestamp", "order_total", "order_timestamp", "user_sk", "status", "payment_method"))


@query(
    _ORDERS
    + f"""SELECT order_id, concat_ws('; ', CASE WHEN order_id IS NULL THEN 'missing_order_id' END, CASE WHEN user_sk IS NULL THEN 'missing_user_id' END,
  CASE WHEN order_timestamp IS NULL THEN 'missing_order_timestamp' END, CASE WHEN order_timestamp > TIMESTAMPTZ '{AS_OF} 00:00:00+00' THEN 'future_order_timestamp' END, CASE WHEN order_total IS NULL THEN 'missing_order_total' END,
  CASE WHEN order_total < 0 THEN 'negative_order_total' END, CASE WHEN coalesce(status, '') = '' THEN 'missing_order_status' END,
  CASE WHEN coalesce(payment_method, '') = '' THEN 'missing_payment_method' END,
  CASE WHEN source_kafka_timestamp IS NULL THEN 'missing_kafka_timestamp' END) AS reason FROM o"""
)
def order_validation(spark: SparkSession, d: str) -> DataFrame:
    return with_reasons(_orders(spark, d), _order_rules(), "reason").select("order_id", "reason")


def _order_rules() -> list[Rule]:
    return [
        Rule("missing_order_id", F.col("order_id").isNull()),
        Rule("missing_user_id", F.col("user_sk").isNull()),
        Rule("missing_order_timestamp", F.col("order_timestamp").isNull()),
        Rule("future_order_timestamp", F.col("order_timestamp") > F.lit(AS_OF).cast("timestamp")),
        Rule("missing_order_total", F.col("order_total").isNull()),
        Rule("negative_order_total", F.col("order_total") < 0),
        Rule("missing_order_status", blank("status")),
        Rule("missing_payment_method", blank("payment_method")),
        Rule("missing_kafka_timestamp", F.col("source_kafka_timestamp").isNull()),
    ]


@query(
    _ORDERS
    + """SELECT o.order_id, coalesce(u.user_sk, -1) AS user_sk, (year(order_timestamp AT TIME ZONE 'UTC') * 10000 + month(order_timestamp AT TIME ZONE 'UTC') * 100 + day(order_timestamp AT TIME ZONE 'UTC'))::INT AS order_date_sk
FROM o LEFT JOIN (SELECT DISTINCT user_sk FROM dim_user) u ON o.user_sk = u.user_sk"""
)
def fact_order_unknown_user(spark: SparkSession, d: str) -> DataFrame:
    users = table(spark, d, "dim_user", ["user_sk"]).distinct().withColumn("known", F.col("user_sk"))
    o = _orders(spark, d).join(users, "user_sk", "left")
    return o.select("order_id", F.coalesce("known", F.lit(-1).cast("bigint")).alias("user_sk"), date_sk(F.col("order_timestamp")).alias("order_date_sk"))


_ITEMS = f"""
i AS (
  SELECT {_id("order_item_id")} AS order_item_id, {_id("order_id")} AS order_id, {_id("product_id")} AS product_id, quantity, unit_price, item_total_amount, order_timestamp, source_kafka_timestamp
  FROM fact_order_item
  QUALIFY {_id("order_item_id")} IS NULL OR row_number() OVER (PARTITION BY {_id("order_item_id")} ORDER BY source_kafka_timestamp DESC NULLS LAST, item_total_amount DESC NULLS LAST,
    quantity DESC NULLS LAST, unit_price DESC NULLS LAST, order_timestamp DESC NULLS LAST, {_id("order_id")} DESC NULLS LAST, {_id("product_id")} DESC NULLS LAST) = 1
)
"""


def _items(spark: SparkSession, d: str) -> DataFrame:
    i = table(spark, d, "fact_order_item", ["order_item_id", "order_id", "product_id", "quantity", "unit_price", "item_total_amount", "order_timestamp", "source_kafka_timestamp"]).select(
        norm_id("order_item_id").alias("order_item_id"), norm_id("order_id").alias("order_id"), norm_id("product_id").alias("product_id"),
        "quantity", "unit_price", "item_total_amount", "order_timestamp", "source_kafka_timestamp",
    )
    order = versions.newest_first("source_kafka_timestamp", "item_total_amount", "quantity", "unit_price", "order_timestamp", "order_id", "product_id")
    return versions.latest_by(i, F.col("order_item_id"), order)


@query("WITH " + _ITEMS + "SELECT order_item_id, order_id, quantity, epoch_us(source_kafka_timestamp) AS delivered_us FROM i")
def latest_item_version(spark: SparkSession, d: str) -> DataFrame:
    return _items(spark, d).select("order_item_id", "order_id", "quantity", F.unix_micros("source_kafka_timestamp").alias("delivered_us"))


@query(
    _ORDERS.rstrip() + ", " + _ITEMS
    + f"""SELECT order_item_id, concat_ws('; ', CASE WHEN i.order_item_id IS NULL THEN 'missing_order_item_id' END, CASE WHEN i.order_id IS NULL THEN 'missing_order_id' END,
  CASE WHEN product_id IS NULL THEN 'missing_product_id' END, CASE WHEN quantity IS NULL THEN 'missing_quantity' END, CASE WHEN quantity <= 0 THEN 'non_positive_quantity' END,
  CASE WHEN unit_price IS NULL THEN 'missing_unit_price' END, CASE WHEN unit_price < 0 THEN 'negative_unit_price' END,
  CASE WHEN item_total_amount IS NULL THEN 'missing_item_total_amount' END, CASE WHEN item_total_amount < 0 THEN 'negative_item_total_amount' END,
  CASE WHEN item_total_amount > quantity * unit_price + {TOLERANCE} THEN 'item_total_exceeds_gross' END,
  CASE WHEN i.source_kafka_timestamp IS NULL THEN 'missing_kafka_timestamp' END,
  CASE WHEN o.order_id IS NULL THEN 'missing_parent_order' END) AS reason
FROM i LEFT JOIN (SELECT DISTINCT order_id FROM o WHERE order_id IS NOT NULL) o ON i.order_id = o.order_id"""
)
def item_rules_and_parent(spark: SparkSession, d: str) -> DataFrame:
    return _judged_items(spark, d).select("order_item_id", "reason")


def _judged_items(spark: SparkSession, d: str) -> DataFrame:
    """Latest items with the reasons against them."""
    parents = _orders(spark, d).select(F.col("order_id").alias("parent")).filter("parent is not null").distinct()
    j = _items(spark, d).join(parents, F.col("order_id") == F.col("parent"), "left")
    rules = [
        Rule("missing_order_item_id", F.col("order_item_id").isNull()),
        Rule("missing_order_id", F.col("order_id").isNull()),
        Rule("missing_product_id", F.col("product_id").isNull()),
        Rule("missing_quantity", F.col("quantity").isNull()),
        Rule("non_positive_quantity", F.col("quantity") <= 0),
        Rule("missing_unit_price", F.col("unit_price").isNull()),
        Rule("negative_unit_price", F.col("unit_price") < 0),
        Rule("missing_item_total_amount", F.col("item_total_amount").isNull()),
        Rule("negative_item_total_amount", F.col("item_total_amount") < 0),
        Rule("item_total_exceeds_gross", F.col("item_total_amount") > F.col("quantity") * F.col("unit_price") + F.lit(TOLERANCE).cast("decimal(10,2)")),
        Rule("missing_kafka_timestamp", F.col("source_kafka_timestamp").isNull()),
        Rule("missing_parent_order", F.col("parent").isNull()),
    ]
    return with_reasons(j, rules, "reason")


@query(
    "WITH " + _ITEMS + ", " + _p2().strip().removeprefix("WITH ")
    + """, v AS (SELECT product_id, price, at_us, lead(at_us) OVER (PARTITION BY product_id ORDER BY at_us) AS to_us FROM runs)
SELECT order_item_id, v.price::DOUBLE AS price_in_force, CASE WHEN v.price IS NULL THEN 'unknown_product' ELSE 'temporal' END AS product_resolution
FROM i LEFT JOIN v ON i.product_id = v.product_id AND epoch_us(i.order_timestamp) >= v.at_us AND (v.to_us IS NULL OR epoch_us(i.order_timestamp) < v.to_us)"""
)
def fact_item_temporal_price(spark: SparkSession, d: str) -> DataFrame:
    # The price in cents is the version's identity here: runs of one product never start with an equal price.
    v = _prices(spark, d).select(F.col("product_id").alias("entity"), F.col("start").alias("start_us"), F.col("stop").alias("stop_us"), (F.col("price") * 100).cast("bigint").alias("version_id"))
    i = _items(spark, d).select("order_item_id", F.col("product_id").alias("entity"), F.unix_micros("order_timestamp").alias("at_us"))
    j = asof.asof_versions(i, v, [])
    return j.select(
        "order_item_id",
        (F.col("version_id") / 100).alias("price_in_force"),
        F.when(F.col("version_id").isNull(), "unknown_product").otherwise("temporal").alias("product_resolution"),
    )


_RETURNS = f"""
r AS (
  SELECT {_id("return_refund_id")} AS return_refund_id, {_id("order_id")} AS order_id, {_id("order_item_id")} AS order_item_id, return_timestamp, refund_amount, lower(trim(return_reason, {_WS})) AS return_reason, source_kafka_timestamp
  FROM fact_return_refund
  QUALIFY {_id("return_refund_id")} IS NULL OR row_number() OVER (PARTITION BY {_id("return_refund_id")} ORDER BY source_kafka_timestamp DESC NULLS LAST, refund_amount DESC NULLS LAST,
    return_timestamp DESC NULLS LAST, {_id("order_item_id")} DESC NULLS LAST, {_id("order_id")} DESC NULLS LAST, lower(trim(return_reason, {_WS})) DESC NULLS LAST) = 1
)
"""


def _returns(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "fact_return_refund", ["return_refund_id", "order_id", "order_item_id", "return_timestamp", "refund_amount", "return_reason", "source_kafka_timestamp"]).select(
        norm_id("return_refund_id").alias("return_refund_id"), norm_id("order_id").alias("order_id"), norm_id("order_item_id").alias("order_item_id"),
        "return_timestamp", "refund_amount", F.lower(strip("return_reason")).alias("return_reason"), "source_kafka_timestamp",
    )
    return versions.latest_by(r, F.col("return_refund_id"), versions.newest_first("source_kafka_timestamp", "refund_amount", "return_timestamp", "order_item_id", "order_id", "return_reason"))


@query(
    "WITH " + _ITEMS + ", " + _RETURNS
    + """SELECT r.return_refund_id, concat_ws('; ', CASE WHEN r.return_refund_id IS NULL THEN 'missing_return_refund_id' END, CASE WHEN r.order_id IS NULL THEN 'missing_order_id' END,
  CASE WHEN r.order_item_id IS NULL THEN 'missing_order_item_id' END, CASE WHEN r.return_timestamp IS NULL THEN 'missing_return_timestamp' END, CASE WHEN r.refund_amount IS NULL THEN 'missing_refund_amount' END,
  CASE WHEN r.refund_amount < 0 THEN 'negative_refund_amount' END, CASE WHEN coalesce(r.return_reason, '') = '' THEN 'missing_return_reason' END, CASE WHEN r.source_kafka_timestamp IS NULL THEN 'missing_kafka_timestamp' END,
  CASE WHEN i.order_item_id IS NULL THEN 'missing_parent_order_item' END,
  CASE WHEN i.order_item_id IS NOT NULL AND i.order_id <> r.order_id THEN 'order_item_order_mismatch' END,
  CASE WHEN r.return_timestamp < i.order_timestamp THEN 'return_before_order' END) AS reason
FROM r LEFT JOIN (SELECT * FROM i WHERE order_item_id IS NOT NULL) i ON r.order_item_id = i.order_item_id"""
)
def return_relationships(spark: SparkSession, d: str) -> DataFrame:
    return _judged_returns(spark, d).select("return_refund_id", "reason")


def _judged_returns(spark: SparkSession, d: str) -> DataFrame:
    """Latest returns with the reasons against them."""
    i = _items(spark, d).filter("order_item_id is not null").select(F.col("order_item_id").alias("item"), F.col("order_id").alias("item_order"), F.col("order_timestamp").alias("ordered"))
    j = _returns(spark, d).join(i, F.col("order_item_id") == F.col("item"), "left")
    rules = [
        Rule("missing_return_refund_id", F.col("return_refund_id").isNull()),
        Rule("missing_order_id", F.col("order_id").isNull()),
        Rule("missing_order_item_id", F.col("order_item_id").isNull()),
        Rule("missing_return_timestamp", F.col("return_timestamp").isNull()),
        Rule("missing_refund_amount", F.col("refund_amount").isNull()),
        Rule("negative_refund_amount", F.col("refund_amount") < 0),
        Rule("missing_return_reason", blank("return_reason")),
        Rule("missing_kafka_timestamp", F.col("source_kafka_timestamp").isNull()),
        Rule("missing_parent_order_item", F.col("item").isNull()),
        Rule("order_item_order_mismatch", F.col("item").isNotNull() & (F.col("item_order") != F.col("order_id"))),
        Rule("return_before_order", F.col("return_timestamp") < F.col("ordered")),
    ]
    return with_reasons(j, rules, "reason")


# ------------------------------------------------------------ denormalized


_OBT = (
    _ORDERS.rstrip() + ", " + _ITEMS
    + """, t AS (SELECT i.order_item_id, o.order_id, o.order_total, o.status, i.quantity,
  row_number() OVER (PARTITION BY o.order_id ORDER BY i.order_item_id) AS rn, count(*) OVER (PARTITION BY o.order_id) AS parent_rows
  FROM i JOIN o ON i.order_id = o.order_id WHERE i.order_item_id IS NOT NULL)
"""
)


# ------------------------------------------------------------ audits


@query(
    _OBT
    + """, m AS (SELECT count(*) AS n, count(DISTINCT order_item_id) AS items, count(DISTINCT order_id) AS orders, sum((rn = 1)::INT) AS firsts, sum(CASE WHEN rn = 1 THEN order_total END) AS once FROM t),
s AS (SELECT count(*) AS represented, sum(order_total) AS total, (SELECT count(*) FROM i JOIN o USING (order_id) WHERE i.order_item_id IS NOT NULL) AS source_items FROM o WHERE order_id IN (SELECT order_id FROM t))
SELECT unnest(['rows_are_items', 'items_unique', 'no_duplicates', 'orders_are_represented', 'one_flag_an_order', 'totals_reconcile']) AS check_name,
  unnest([n = source_items, items = source_items, n - items = 0, orders = represented, firsts = represented, once IS NOT DISTINCT FROM total]) AS passed FROM m, s"""
)
def order_total_reconciliation(spark: SparkSession, d: str) -> DataFrame:
    """The six reconciliations of the denormalized table with its sources."""
    from tidewell.plans import models

    t = models.transactional_obt(spark, d)
    by_item = t.groupBy("order_id", "order_item_id").agg(F.count(F.lit(1)).alias("n"), F.sum("order_count_flag").alias("flags"), F.sum(F.round(F.col("order_total_once") * 100).cast("bigint")).alias("cents"))
    by_order = by_item.groupBy("order_id").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("items"), F.sum("flags").alias("flags"), F.sum("cents").alias("cents"))
    items = _items(spark, d).filter("order_item_id is not null").groupBy("order_id").agg(F.count(F.lit(1)).alias("source_items"))
    source = _orders(spark, d).filter("order_id is not null").select("order_id", (F.col("order_total") * 100).cast("bigint").alias("source_cents")).join(items, "order_id")
    m = source.join(by_order, "order_id", "full_outer").agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n", "items", "flags", "cents", "source_items", "source_cents")], F.count("n").alias("orders"), F.count("source_items").alias("represented")
    )
    c = F.col
    return audits.checks(
        m,
        {
            "rows_are_items": c("n") == c("source_items"), "items_unique": c("items") == c("source_items"), "no_duplicates": c("n") == c("items"), "orders_are_represented": c("orders") == c("represented"),
            "one_flag_an_order": c("flags") == c("represented"), "totals_reconcile": c("cents") == c("source_cents"),
        },
    )


@query("SELECT o_orderkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)")
def represented_orders_semi(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem", ["l_orderkey"])
    o = table(spark, d, "orders", ["o_orderkey"])
    return o.join(lines, o.o_orderkey == lines.l_orderkey, "left_semi")


@query(
    """SELECT coalesce(a.k, b.k) AS order_key, CASE WHEN b.k IS NULL THEN 'missing_in_b' ELSE 'missing_in_a' END AS side
FROM (SELECT DISTINCT o_orderkey AS k FROM orders) a FULL JOIN (SELECT DISTINCT l_orderkey AS k FROM lineitem) b ON a.k = b.k WHERE a.k IS NULL OR b.k IS NULL"""
)
def bidirectional_missing(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "orders", ["o_orderkey"]).select(F.col("o_orderkey").alias("order_key"))
    b = table(spark, d, "lineitem", ["l_orderkey"]).select(F.col("l_orderkey").alias("order_key"))
    return audits.missing_both_ways(a, b, ["order_key"])


@query(f"SELECT DISTINCT {_id('order_id')} AS order_id FROM fact_order_item i WHERE {_id('order_id')} IS NOT NULL AND {_id('order_id')} NOT IN (SELECT {_id('order_id')} FROM fact_order WHERE {_id('order_id')} IS NOT NULL)")
def fk_orphans(spark: SparkSession, d: str) -> DataFrame:
    i = table(spark, d, "fact_order_item", ["order_id"]).select(norm_id("order_id").alias("order_id")).filter("order_id is not null").distinct()
    o = table(spark, d, "fact_order", ["order_id"]).select(norm_id("order_id").alias("order_id"))
    return i.join(o, "order_id", "left_anti")


_LINE = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


@query(
    f"SELECT l_orderkey, l_linenumber, count(DISTINCT ({', '.join(_LINE)})) AS n_payloads FROM lineitem GROUP BY 1, 2 HAVING count(DISTINCT ({', '.join(_LINE)})) > 1"
)
def payload_conflicts(spark: SparkSession, d: str) -> DataFrame:
    return audits.payload_conflicts(table(spark, d, "lineitem", ["l_orderkey", "l_linenumber", *_LINE]), ["l_orderkey", "l_linenumber"], _LINE)


@query("SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1 ORDER BY n_rows DESC, l_orderkey, l_linenumber LIMIT 20")
def top_repeated_keys(spark: SparkSession, d: str) -> DataFrame:
    k = audits.repeated_keys(table(spark, d, "lineitem", ["l_orderkey", "l_linenumber"]), ["l_orderkey", "l_linenumber"])
    return k.orderBy(F.col("n_rows").desc(), "l_orderkey", "l_linenumber").limit(20)


_PROFILED = ["order_sk", "order_id", "user_sk", "order_date_sk", "order_timestamp", "order_total", "status", "payment_method", "source_kafka_timestamp", "silver_created_at", "silver_updated_at"]


@query(
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) FILTER (WHERE {c} IS NULL) AS n_null, count(*) FILTER (WHERE trim({c}::VARCHAR) = '') AS n_blank FROM fact_order" for c in _PROFILED
    )
)
def null_profile(spark: SparkSession, d: str) -> DataFrame:
    return audits.null_profile(table(spark, d, "fact_order", _PROFILED), _PROFILED)


@query(f"SELECT lower(trim(status, {_WS})) AS status, count(*) AS n_rows FROM fact_order GROUP BY 1")
def value_frequencies(spark: SparkSession, d: str) -> DataFrame:
    return audits.frequencies(table(spark, d, "fact_order", ["status"]), F.lower(strip("status")), "status")


@query(
    "SELECT kafka_topic, kafka_partition, min(kafka_offset) AS min_offset, max(kafka_offset) AS max_offset, count(*) AS n_rows, count(DISTINCT kafka_offset) AS n_offsets FROM fact_behavioral_event GROUP BY 1, 2"
)
def offset_summary(spark: SparkSession, d: str) -> DataFrame:
    return audits.offset_summary(table(spark, d, "fact_behavioral_event", ["kafka_topic", "kafka_partition", "kafka_offset"]))


@query(
    """SELECT l_orderkey, l_linenumber, max(gen) AS generation_priority FROM (SELECT o_orderkey AS l_orderkey, 1 AS l_linenumber, 1 AS gen FROM orders UNION ALL SELECT l_orderkey, l_linenumber, 2 FROM lineitem) GROUP BY 1, 2"""
)
def canonical_generation_merge(spark: SparkSession, d: str) -> DataFrame:
    """One row an identity over two datasets of their own, the later one first."""
    first = table(spark, d, "orders", ["o_orderkey"]).select(F.col("o_orderkey").alias("l_orderkey"), F.lit(1).alias("l_linenumber"))
    second = table(spark, d, "lineitem", ["l_orderkey", "l_linenumber", "l_shipdate", "l_quantity"])
    merged = versions.canonical_generations([first, second], ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_quantity"])
    return merged.select("l_orderkey", "l_linenumber", "generation_priority")


@query(
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, min({c})::DOUBLE AS least, max({c})::DOUBLE AS greatest, round(avg({c}), 6)::DOUBLE AS mean, count(DISTINCT {c}) AS n_values FROM {t}"
        for t, c in (("fact_order", "order_total"), ("fact_order_item", "quantity"), ("fact_order_item", "unit_price"), ("fact_return_refund", "refund_amount"), ("dim_product", "price"))
    )
)
def numeric_profile(spark: SparkSession, d: str) -> DataFrame:
    """Range, mean and distinct values of the numeric columns, from their counts by
    value, so that no row is expanded for the distinct count."""
    out = None
    for t, c in (("fact_order", "order_total"), ("fact_order_item", "quantity"), ("fact_order_item", "unit_price"), ("fact_return_refund", "refund_amount"), ("dim_product", "price")):
        part = audits.numeric_range(table(spark, d, t, [c]), c)
        out = part if out is None else out.unionByName(part)
    return out


@query(f"SELECT order_id, order_total::DOUBLE AS order_total FROM ({_ORDERS} SELECT * FROM o) WHERE order_timestamp >= TIMESTAMPTZ '2026-01-10 00:00:00+00' AND order_timestamp < TIMESTAMPTZ '2026-01-21 00:00:00+00'")
def orders_of_days(spark: SparkSession, d: str) -> DataFrame:
    """Orders from the 10th to the 20th of January 2026, both days included."""
    o = _orders(spark, d).filter(inclusive_days("order_timestamp", date(2026, 1, 10), date(2026, 1, 20)))
    return o.select("order_id", F.col("order_total").cast("double").alias("order_total"))


@query(f"SELECT order_id, order_total::DOUBLE AS order_total FROM ({_ORDERS} SELECT * FROM o) WHERE (order_timestamp AT TIME ZONE 'UTC')::DATE = DATE '2026-01-15'")
def orders_on_day(spark: SparkSession, d: str) -> DataFrame:
    o = _orders(spark, d).filter(whole_day("order_timestamp", date(2026, 1, 15)))
    return o.select("order_id", F.col("order_total").cast("double").alias("order_total"))


_GONE_ORDERS = f"SELECT DISTINCT {_id('kafka_key')} AS order_id FROM raw_tombstone WHERE kafka_topic = 'transactional.orders' AND order_id IS NULL AND user_id IS NULL AND {_id('kafka_key')} IS NOT NULL"


@query(_ORDERS.rstrip() + ", " + _ITEMS + f", g AS ({_GONE_ORDERS})" + "SELECT 'order' AS entity, order_id AS record_id FROM o WHERE order_id IS NOT NULL AND order_id NOT IN (SELECT order_id FROM g) UNION ALL SELECT 'item', order_item_id FROM i WHERE order_id IS NOT NULL AND order_id NOT IN (SELECT order_id FROM g)")
def delete_cascade(spark: SparkSession, d: str) -> DataFrame:
    gone = tombstone_split(spark, d).filter("kafka_topic = 'transactional.orders'").select(F.col("deleted_key").alias("order_id"))
    orders, items = versions.cascade_delete(_orders(spark, d).filter("order_id is not null"), _items(spark, d).filter("order_id is not null"), gone, "order_id")
    return orders.select(F.lit("order").alias("entity"), F.col("order_id").alias("record_id")).unionByName(items.select(F.lit("item").alias("entity"), F.col("order_item_id").alias("record_id")))
