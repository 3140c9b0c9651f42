"""Queries of the behavioral fact, the marts on it, and raw event repair.

Event time is the payload's in every readable notation, else Kafka's; the oracles
read the same notations in SQL (``instant_sql``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions.ids import date_sk, norm_id, strip
from tidewell.operators import marts, timestamps
from tidewell.plans.instant_sql import INSTANTS
from tidewell.plans.star import _id
from tidewell.session import shared_dir
from tidewell.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


_TIMES = ["event_timestamp", "ingested_at", "kafka_timestamp", "origin_zone"]
#: The fact's payload columns as they are delivered.
_PAYLOAD = [
    "product_id", "quantity", "cart_total_items", "cart_items_json", "cart_value", "shipping_method", "order_id", "fulfillment_speed", "url_path", "duration_sec", "http_status",
    "payment_type", "success", "error_code", "search_query", "results_count", "clicked_position", "rating", "text_length", "wishlist_name", "event_data_json",
    "kafka_topic", "kafka_partition", "kafka_offset",
]
_MART = ["product_id", "quantity", "order_id", "url_path", "duration_sec", "http_status", "success", "search_query", "results_count", "clicked_position", "rating"]


def _timed(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    """The columns and ``event_timestamp_us``, the payload's time read from every
    notation, null where it fixes no instant."""
    c = dict.fromkeys([*columns, *_TIMES])
    return timestamps.with_instants(table(spark, d, "fact_behavioral_event", list(c)))


def _events_once(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    """As ``_events``, for marts that read the events several times: written once to
    the shared checkpoint folder, so times are read once and a lost executor
    doesn't read them again."""
    shared_dir(spark)
    return _events(spark, d, *columns).checkpoint()


def _events(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    """One row an event with its time and ``columns``. Of redelivered rows one
    stays whole: the least of (time, ..., columns), so no row comes out that was
    never sent. Combined before the shuffle."""
    own = ["user_id", "session_id", "event_type", "device"]
    c = list(dict.fromkeys(columns))
    e = _timed(spark, d, "event_key", *own, *c).filter("event_key is not null")
    at = F.coalesce("event_timestamp_us", F.unix_micros("kafka_timestamp"))
    names = [F.coalesce(at, F.lit((1 << 63) - 1)).alias("sort_us"), norm_id("user_id").alias("user_id"), norm_id("session_id").alias("session_id"), "event_type", "device", *c]
    from_payload = F.col("event_timestamp_us").isNotNull().alias("from_payload")
    one = e.groupBy("event_key").agg(F.min(F.struct(*names, from_payload, F.unix_micros("kafka_timestamp").alias("kafka_us"))).alias("r")).select("event_key", "r.*")
    one = one.withColumn("at_us", F.nullif("sort_us", F.lit((1 << 63) - 1))).drop("sort_us")
    return one.withColumn("date_sk", date_sk(F.date_from_unix_date(F.floor(F.col("at_us") / 86_400_000_000).cast("int"))))


_WS = "E' \\t\\n\\r'"
_MAX = (1 << 63) - 1


def _e(*columns: str) -> str:
    """CTEs that end in ``ev``: one row an event, as ``_events``."""
    c = list(dict.fromkeys(columns))
    order = ", ".join(f"{x} NULLS FIRST" for x in (f"coalesce(at_us, {_MAX})", "user_id", "session_id", "event_type", "device", *c, "from_payload", "kafka_us"))
    return f"""WITH {INSTANTS}, e AS (
  SELECT event_key, coalesce(event_timestamp_us, epoch_us(kafka_timestamp)) AS at_us, {_id("user_id")} AS user_id, {_id("session_id")} AS session_id, event_type, device,
    {"".join(x + ", " for x in c)}event_timestamp_us IS NOT NULL AS from_payload, epoch_us(kafka_timestamp) AS kafka_us
  FROM timed WHERE event_key IS NOT NULL
), one AS (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY event_key ORDER BY {order}) = 1
), ev AS (
  SELECT *, strftime(make_timestamp(at_us), '%Y%m%d')::INT AS date_sk, lower(trim(event_type, {_WS})) AS t, coalesce(nullif(lower(trim(device, {_WS})), ''), 'unknown') AS dev FROM one
)
"""


_STEP = {k: "t IN (" + ", ".join(f"'{x}'" for x in v) + ")" for k, v in marts.VOCABULARY.items()}
_PAY = "t = 'payment_attempt'"
_STEP |= {
    "successful_payment": f"coalesce(t = 'successful_payment' OR ({_PAY} AND coalesce(success, false)), false)",
    "failed_payment": f"coalesce(t = 'failed_payment' OR ({_PAY} AND NOT coalesce(success, true)), false)",
}


# ------------------------------------------------------------ the fact


@query(
    _e(*_PAYLOAD)
    + f"""SELECT event_key, user_id, session_id, t AS event_type, nullif(lower(trim(device, {_WS})), '') AS device, at_us, date_sk, CASE WHEN from_payload THEN 'payload' ELSE 'kafka' END AS time_source,
  {", ".join(c for c in _PAYLOAD if c != "cart_value")}, round(cart_value, 6) AS cart_value FROM ev WHERE at_us IS NOT NULL AND kafka_topic IS NOT NULL AND kafka_partition IS NOT NULL AND kafka_offset IS NOT NULL"""
)
def fact_behavioral_event(spark: SparkSession, d: str) -> DataFrame:
    """The fact itself: one row an event that has a time and a Kafka identity, with
    the label of where its time comes from."""
    e = _events(spark, d, *_PAYLOAD).filter("at_us is not null and kafka_topic is not null and kafka_partition is not null and kafka_offset is not null")
    return e.select(
        "event_key", "user_id", "session_id", F.lower(strip("event_type")).alias("event_type"), F.nullif(F.lower(strip("device")), F.lit("")).alias("device"), "at_us", "date_sk",
        F.when(F.col("from_payload"), "payload").otherwise("kafka").alias("time_source"), *[c for c in _PAYLOAD if c != "cart_value"], F.round("cart_value", 6).alias("cart_value"),
    )


def events_between(events: DataFrame, start_us: int, end_us: int) -> DataFrame:
    """Events of [start, end) by event time."""
    if end_us <= start_us:
        raise ValueError("end must be after start")
    return events.filter((F.col("at_us") >= start_us) & (F.col("at_us") < end_us))


_MARCH = (1_772_323_200_000_000, 1_775_001_600_000_000)


@query(_e("order_id") + f"SELECT t AS event_type, count(*) AS n_events, count(order_id) AS with_order FROM ev WHERE at_us >= {_MARCH[0]} AND at_us < {_MARCH[1]} GROUP BY 1")
def events_of_march(spark: SparkSession, d: str) -> DataFrame:
    """The half-open range of event time that a load names."""
    e = events_between(_events(spark, d, "order_id"), *_MARCH)
    return e.groupBy(F.lower(strip("event_type")).alias("event_type")).agg(F.count(F.lit(1)).alias("n_events"), F.count("order_id").alias("with_order"))


# ------------------------------------------------------------ the marts

_COMMERCE_SQL = f"""co AS (
  SELECT strftime(order_timestamp AT TIME ZONE 'UTC', '%Y%m%d')::INT AS date_sk, order_id, user_sk, order_total FROM (SELECT {_id("order_id")} AS order_id, user_sk, order_timestamp, order_total, source_kafka_timestamp, status FROM fact_order)
  WHERE order_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY source_kafka_timestamp DESC NULLS LAST, order_total DESC NULLS LAST, order_timestamp DESC NULLS LAST, user_sk DESC NULLS LAST) = 1
), ci AS (
  SELECT order_id, sum(quantity)::BIGINT AS units FROM (SELECT * FROM (SELECT {_id("order_item_id")} AS item_id, {_id("order_id")} AS order_id, quantity, source_kafka_timestamp FROM fact_order_item)
  WHERE item_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY source_kafka_timestamp DESC NULLS LAST, quantity DESC NULLS LAST, order_id DESC NULLS LAST) = 1) GROUP BY 1
)"""


def _orders_with_units(spark: SparkSession, d: str) -> DataFrame:
    """(order_id, user_sk, order_timestamp, order_total, units), latest rows."""
    best = lambda *c: F.max(F.struct(*c))
    o = table(spark, d, "fact_order", ["order_id", "user_sk", "order_timestamp", "order_total", "source_kafka_timestamp"]).withColumn("order_id", norm_id("order_id"))
    o = o.filter("order_id is not null").groupBy("order_id").agg(best("source_kafka_timestamp", "order_total", "order_timestamp", "user_sk").alias("r")).select("order_id", "r.*")
    i = table(spark, d, "fact_order_item", ["order_item_id", "order_id", "quantity", "source_kafka_timestamp"]).withColumns({"item": norm_id("order_item_id"), "order_id": norm_id("order_id")})
    i = i.filter("item is not null").groupBy("item").agg(best("source_kafka_timestamp", "quantity", "order_id").alias("r")).select("r.order_id", "r.quantity")
    units = i.filter("order_id is not null").groupBy("order_id").agg(F.sum("quantity").alias("units"))
    return o.join(units, "order_id", "left").drop("source_kafka_timestamp")


_BOUNCED = "whole AS (SELECT session_id, count(*) = 1 AS bounced FROM ev WHERE session_id IS NOT NULL GROUP BY 1)"
_FIRST = "firsts AS (SELECT user_id, min(date_sk) AS first_day FROM ev WHERE user_id IS NOT NULL AND date_sk IS NOT NULL GROUP BY 1)"


@query(
    _e("success", "results_count", "clicked_position", "http_status", "duration_sec").rstrip()
    + f", {_BOUNCED}, {_FIRST}, {_COMMERCE_SQL}, cd AS (SELECT date_sk, count(DISTINCT order_id) AS orders, count(DISTINCT user_sk) AS customers, coalesce(sum(units), 0)::BIGINT AS units, sum(order_total) AS gross FROM co LEFT JOIN ci USING (order_id) WHERE date_sk IS NOT NULL GROUP BY 1)"
    + ", b AS (SELECT ev.*, unnest([dev, 'all']) AS device_all FROM ev WHERE date_sk IS NOT NULL)"
    + ", m AS (SELECT b.date_sk, device_all AS device, count(*) AS total_events, count(DISTINCT b.user_id) AS unique_users, count(DISTINCT b.session_id) AS sessions, count(DISTINCT b.session_id) FILTER (WHERE bounced) AS bounced_sessions, "
    + ", ".join(f"count(*) FILTER (WHERE {s}) AS {k}_events" for k, s in _STEP.items())
    + ", "
    + ", ".join(f"count(DISTINCT b.user_id) FILTER (WHERE {_STEP[k]}) AS {k}_users, count(DISTINCT b.session_id) FILTER (WHERE {_STEP[k]}) AS {k}_sessions" for k in marts.FUNNEL)
    + f", count(*) FILTER (WHERE {_STEP['search']} AND coalesce(results_count, 0) = 0) AS zero_result_searches, count(*) FILTER (WHERE {_STEP['search']} AND clicked_position IS NOT NULL) AS clicked_searches"
    + ", count(*) FILTER (WHERE http_status BETWEEN 400 AND 499) AS http_4xx_events, count(*) FILTER (WHERE http_status BETWEEN 500 AND 599) AS http_5xx_events, coalesce(sum(coalesce(duration_sec, 0)::BIGINT), 0)::BIGINT AS total_session_duration_sec"
    + ", count(DISTINCT b.user_id) FILTER (WHERE b.date_sk = first_day) AS new_users FROM b LEFT JOIN whole ON b.session_id = whole.session_id LEFT JOIN firsts ON b.user_id = firsts.user_id GROUP BY 1, 2)"
    + " SELECT m.*, greatest(unique_users - new_users, 0) AS returning_users, coalesce(orders, 0) AS orders, coalesce(customers, 0) AS customers, coalesce(units, 0) AS units, coalesce(gross, 0)::DOUBLE AS gross_revenue, coalesce(gross, 0)::DOUBLE AS net_revenue, 0.0::DOUBLE AS discounts, 0.0::DOUBLE AS refunds"
    + " FROM m LEFT JOIN cd ON m.date_sk = cd.date_sk AND m.device = 'all'"
)
def behavioral_daily(spark: SparkSession, d: str) -> DataFrame:
    """All daily measures, the commercial ones on the row of all devices."""
    o = _orders_with_units(spark, d).withColumn("date_sk", date_sk(F.col("order_timestamp"))).filter("date_sk is not null")
    by_customer = o.groupBy("date_sk", "user_sk").agg(F.count(F.lit(1)).alias("orders"), F.sum("units").alias("units"), F.sum("order_total").alias("gross"))
    commerce = by_customer.groupBy("date_sk").agg(F.sum("orders").alias("orders"), F.count("user_sk").alias("customers"), F.sum("units").alias("units"), F.sum("gross").alias("gross"))
    out = marts.daily(_events_once(spark, d, "success", "results_count", "clicked_position", "http_status", "duration_sec"), commerce)
    return out.withColumns({c: F.col(c).cast("double") for c in ("gross_revenue", "net_revenue", "discounts", "refunds")})


@query(
    _e()
    + """, s AS (SELECT DISTINCT date_sk, user_id FROM ev WHERE user_id IS NOT NULL AND date_sk IS NOT NULL), f AS (SELECT user_id, min(date_sk) AS first_day FROM s GROUP BY 1)
SELECT date_sk AS day, count(*) FILTER (WHERE date_sk = first_day) AS new_users, count(*) FILTER (WHERE date_sk > first_day) AS returning_users FROM s JOIN f USING (user_id) GROUP BY 1"""
)
def new_returning_users(spark: SparkSession, d: str) -> DataFrame:
    return marts.new_and_returning(_events(spark, d), "date_sk", "user_id")


@query(
    _e("success", "order_id", "duration_sec").rstrip()
    + f", u AS (SELECT * FROM ev WHERE user_id IS NOT NULL AND date_sk IS NOT NULL), {_FIRST}"
    + ", g AS (SELECT user_id, date_sk, count(DISTINCT session_id) AS sessions, count(*) AS events, sum(coalesce(duration_sec, 0)::BIGINT)::BIGINT AS duration_sec, "
    + ", ".join(f"count(*) FILTER (WHERE {s}) AS {k}_events" for k, s in _STEP.items())
    + f", count(DISTINCT order_id) FILTER (WHERE {_STEP['order_complete']}) AS daily_orders FROM u GROUP BY 1, 2)"
    + f", od AS (SELECT user_id, order_id, min(date_sk) AS date_sk FROM u WHERE {_STEP['order_complete']} AND order_id IS NOT NULL GROUP BY 1, 2), oc AS (SELECT user_id, date_sk, count(*) AS first_done FROM od GROUP BY 1, 2)"
    + ", dc AS (SELECT user_id, dev, count(*) AS n FROM u GROUP BY 1, 2), pd AS (SELECT user_id, dev AS primary_device FROM dc QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY n DESC, dev) = 1)"
    + """, w AS (SELECT g.*, first_day, primary_device, sum(coalesce(first_done, 0)) OVER so_far AS lifetime_orders, max(CASE WHEN daily_orders > 0 THEN g.date_sk END) OVER so_far AS last_order_day
  FROM g LEFT JOIN oc USING (user_id, date_sk) JOIN firsts USING (user_id) LEFT JOIN pd USING (user_id) WINDOW so_far AS (PARTITION BY g.user_id ORDER BY g.date_sk ROWS UNBOUNDED PRECEDING)),
x AS (SELECT *, strptime(date_sk::VARCHAR, '%Y%m%d')::DATE AS d0, strptime(first_day::VARCHAR, '%Y%m%d')::DATE AS d1, strptime(last_order_day::VARCHAR, '%Y%m%d')::DATE AS d2 FROM w)
SELECT user_id, date_sk, sessions, events, duration_sec, """
    + ", ".join(f"{k}_events" for k in _STEP)
    + """, daily_orders, first_day AS first_seen_day, date_trunc('week', d1)::DATE AS cohort_week, date_trunc('month', d1)::DATE AS cohort_month, (d0 - d1)::INT AS days_since_first_seen,
  date_sk = first_day AS is_new, date_sk > first_day AS is_returning, lifetime_orders::BIGINT AS lifetime_orders, last_order_day, (d0 - d2)::INT AS days_since_last_order, primary_device,
  search_events > 0 AS was_searcher, add_to_cart_events > 0 AS was_cart_user, checkout_start_events > 0 AS was_checkout_user, order_complete_events > 0 AS was_buyer, review_events > 0 AS was_reviewer FROM x"""
)
def user_daily_activity(spark: SparkSession, d: str) -> DataFrame:
    return marts.user_daily(_events_once(spark, d, "success", "order_id", "duration_sec"))


@query(
    _e()
    + f", c AS (SELECT user_id, lower(trim(device, {_WS})) AS device, count(*) AS n FROM ev WHERE user_id IS NOT NULL AND coalesce(trim(device, {_WS}), '') <> '' GROUP BY 1, 2) SELECT user_id, device FROM c QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY n DESC, device) = 1"
)
def modal_device(spark: SparkSession, d: str) -> DataFrame:
    e = _events(spark, d).withColumn("device", F.nullif(F.lower(strip("device")), F.lit("")))
    return marts.modal(e, "user_id", "device")


_SESSION_TIMED = ["page_view", "search", "add_to_cart", "checkout_start", "successful_payment"]


@query(
    _e("success", "url_path", "product_id", "order_id").rstrip()
    + f", {_COMMERCE_SQL}"
    + ", s0 AS (SELECT *, (at_us, event_key, coalesce(url_path, '-'), t, dev) AS p FROM ev WHERE session_id IS NOT NULL AND at_us IS NOT NULL)"
    + ", s AS (SELECT session_id, min(user_id) AS user_id, min(at_us) AS started_us, max(at_us) AS ended_us, count(*) AS events, arg_min(coalesce(url_path, '-'), (at_us, event_key)) AS landing_page, arg_max(coalesce(url_path, '-'), (at_us, event_key)) AS exit_page"
    + ", arg_min_null(t, (at_us, event_key)) AS first_event_type, arg_max_null(t, (at_us, event_key)) AS last_event_type, arg_min(dev, (at_us, event_key)) AS device, "
    + ", ".join(f"min(at_us) FILTER (WHERE {_STEP[k]}) AS first_{k}_us" for k in _SESSION_TIMED)
    + ", "
    + ", ".join(f"count(*) FILTER (WHERE {v}) AS {k}_count" for k, v in _STEP.items())
    + f", count(DISTINCT product_id) FILTER (WHERE {_STEP['page_view']}) AS products_viewed, count(DISTINCT product_id) FILTER (WHERE {_STEP['add_to_cart']}) AS products_added, count(order_id) > 0 AS had_behavioral_order FROM s0 GROUP BY 1)"
    + f", nm AS (SELECT DISTINCT session_id, {_id('order_id')} AS order_id FROM s0), mt AS (SELECT session_id, count(*) AS matched_orders, sum(order_total) AS matched_total, sum(units)::BIGINT AS matched_units FROM nm JOIN co USING (order_id) LEFT JOIN ci USING (order_id) GROUP BY 1)"
    + f", us AS (SELECT * FROM (SELECT {_id('user_id')} AS user_id, location, loyalty_tier, source_kafka_timestamp FROM dim_user) WHERE user_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY source_kafka_timestamp DESC NULLS LAST, location DESC NULLS LAST, loyalty_tier DESC NULLS LAST) = 1)"
    + """ SELECT s.* EXCLUDE (user_id), s.user_id, (ended_us - started_us) // 1000000 AS duration_sec, make_timestamp(started_us)::DATE AS session_date, coalesce(matched_orders, 0) AS matched_orders, coalesce(matched_total, 0)::DOUBLE AS matched_total, coalesce(matched_units, 0) AS matched_units,
  CASE WHEN had_behavioral_order AND matched_orders > 0 THEN 'matched' WHEN had_behavioral_order OR order_complete_count > 0 THEN 'behavioral_only' WHEN matched_orders > 0 THEN 'transactional_only' ELSE 'none' END AS order_match_status,
  events = 1 AS is_bounce, successful_payment_count > 0 AS is_converted, add_to_cart_count > 0 AND successful_payment_count = 0 AS cart_abandoned, checkout_start_count > 0 AND successful_payment_count = 0 AS checkout_abandoned, """
    + f"coalesce(trim(location, {_WS}), '') AS country, coalesce(trim(loyalty_tier, {_WS}), '') AS segment FROM s LEFT JOIN mt USING (session_id) LEFT JOIN us ON s.user_id = us.user_id"
)
def session_summary(spark: SparkSession, d: str) -> DataFrame:
    e = _events_once(spark, d, "success", "url_path", "product_id", "order_id").withColumn("order_id", norm_id("order_id"))
    u = table(spark, d, "dim_user", ["user_id", "location", "loyalty_tier", "source_kafka_timestamp"]).withColumn("user_id", norm_id("user_id")).filter("user_id is not null")
    u = u.groupBy("user_id").agg(F.max(F.struct("source_kafka_timestamp", "location", "loyalty_tier")).alias("r")).select("user_id", "r.location", "r.loyalty_tier")
    out = marts.sessions(e, _orders_with_units(spark, d).select("order_id", "order_total", "units"), u)
    return out.withColumn("matched_total", F.col("matched_total").cast("double"))


# Measures of the three kinds of entities, in SQL and as columns.
_VIEW, _CART = "t = 'page_view'", "t = 'add_to_cart'"
_PRODUCT_SQL = {
    "views": f"count(*) FILTER (WHERE {_VIEW})",
    "cart_adds": f"count(*) FILTER (WHERE {_CART})",
    "wishlist_adds": f"count(*) FILTER (WHERE {_STEP['wishlist_add']})",
    "purchases": f"count(*) FILTER (WHERE {_STEP['order_complete']})",
    "units_sold": f"coalesce(sum(quantity) FILTER (WHERE {_CART}), 0)::BIGINT",
    "reviews": f"count(*) FILTER (WHERE {_STEP['review']})",
    "rating_sum": f"coalesce(sum(rating) FILTER (WHERE {_STEP['review']}), 0)::BIGINT",
    "cart_users": f"count(DISTINCT ev.user_id) FILTER (WHERE {_CART})",
}
_SEARCH_SQL = {
    "searches": "count(*)",
    "zero_result_searches": "count(*) FILTER (WHERE coalesce(results_count, 0) = 0)",
    "clicked_searches": "count(*) FILTER (WHERE clicked_position IS NOT NULL)",
    "results_sum": "coalesce(sum(results_count), 0)::BIGINT",
    "clicked_position_sum": "coalesce(sum(clicked_position), 0)::BIGINT",
    "to_cart_sessions": "count(DISTINCT ev.session_id) FILTER (WHERE did.carted)",
    "to_order_sessions": "count(DISTINCT ev.session_id) FILTER (WHERE did.ordered)",
}
_PAGE_SQL = {
    "page_views": "count(*)",
    "duration_sum": "coalesce(sum(coalesce(duration_sec, 0)::BIGINT), 0)::BIGINT",
    "http_4xx": "count(*) FILTER (WHERE http_status BETWEEN 400 AND 499)",
    "http_5xx": "count(*) FILTER (WHERE http_status BETWEEN 500 AND 599)",
    "entrances": "count(DISTINCT ev.session_id) FILTER (WHERE ev.event_key = did.first_key)",
    "exits": "count(DISTINCT ev.session_id) FILTER (WHERE ev.event_key = did.last_key)",
    "bounces": "count(DISTINCT ev.session_id) FILTER (WHERE did.n = 1)",
}


def _entity_sql(entity: str, kept: str, measures: dict[str, str], columns: tuple[str, ...]) -> str:
    return (
        _e(*columns).rstrip()
        + f""", did AS (SELECT date_sk, session_id, count(*) AS n, arg_min(event_key, (at_us, event_key)) AS first_key, arg_max(event_key, (at_us, event_key)) AS last_key,
  coalesce(bool_or({_STEP["order_complete"]}), false) AS ordered, coalesce(bool_or({_STEP["add_to_cart"]}), false) AS carted FROM ev WHERE session_id IS NOT NULL AND date_sk IS NOT NULL GROUP BY 1, 2)
SELECT ev.date_sk, {entity} AS entity, dev AS device, count(*) AS event_count, count(DISTINCT ev.user_id) AS unique_users, count(DISTINCT ev.session_id) AS unique_sessions,
  count(DISTINCT ev.user_id) FILTER (WHERE did.ordered) AS converting_users, count(DISTINCT ev.session_id) FILTER (WHERE did.ordered) AS converting_sessions, """
        + ", ".join(f"{v} AS {k}" for k, v in measures.items())
        + f" FROM ev LEFT JOIN did ON ev.session_id = did.session_id AND ev.date_sk = did.date_sk WHERE {entity} IS NOT NULL AND {kept} AND ev.date_sk IS NOT NULL GROUP BY 1, 2, 3"
    )


_ENTITY = {
    "product": ("product_id", "true", _PRODUCT_SQL, ("product_id", "quantity", "rating", "success")),
    "search_query": (f"nullif(lower(trim(search_query, {_WS})), '')", _STEP["search"], _SEARCH_SQL, ("search_query", "results_count", "clicked_position", "success")),
    "page": ("url_path", _VIEW, _PAGE_SQL, ("url_path", "duration_sec", "http_status", "success")),
}


def _if(condition: Column, value: Column | str | None = None) -> Column:
    v = F.lit(1) if value is None else F.col(value) if isinstance(value, str) else value
    return F.when(condition, v.cast("bigint")).otherwise(F.lit(0).cast("bigint"))


@query(_entity_sql(*_ENTITY["product"]))
def entity_product_daily(spark: SparkSession, d: str) -> DataFrame:
    s = marts.step_flags()
    measures = {
        "views": _if(s["page_view"]), "cart_adds": _if(s["add_to_cart"]), "wishlist_adds": _if(s["wishlist_add"]), "purchases": _if(s["order_complete"]),
        "units_sold": _if(s["add_to_cart"], "quantity"), "reviews": _if(s["review"]), "rating_sum": _if(s["review"], "rating"),
    }
    return marts.entity_daily(_events_once(spark, d, *_ENTITY["product"][3]), F.col("product_id"), F.lit(True), measures, {"cart_users": s["add_to_cart"]})


@query(_entity_sql(*_ENTITY["search_query"]))
def entity_search_daily(spark: SparkSession, d: str) -> DataFrame:
    s = marts.step_flags()
    measures = {
        "searches": _if(F.lit(True)), "zero_result_searches": _if(F.coalesce("results_count", F.lit(0)) == 0), "clicked_searches": _if(F.col("clicked_position").isNotNull()),
        "results_sum": _if(F.lit(True), "results_count"), "clicked_position_sum": _if(F.lit(True), "clicked_position"),
    }
    sessions = {"to_cart_sessions": s["add_to_cart"], "to_order_sessions": s["order_complete"]}
    key = F.nullif(F.lower(strip("search_query")), F.lit(""))
    return marts.entity_daily(_events_once(spark, d, *_ENTITY["search_query"][3]), key, s["search"], measures, sessions=sessions)


@query(_entity_sql(*_ENTITY["page"]))
def entity_page_daily(spark: SparkSession, d: str) -> DataFrame:
    """Entrances and exits are sessions whose first or last event of the day is a
    view of the page."""
    e = _events_once(spark, d, *_ENTITY["page"][3])
    key = F.struct("at_us", "event_key")
    # One event at most of a session's day is its first, so no distinct count is needed.
    day = {"first_key": F.min(key)["event_key"], "last_key": F.max(key)["event_key"], "n": F.count(F.lit(1))}
    s = marts.step_flags()
    measures = {
        "page_views": _if(F.lit(True)), "duration_sum": _if(F.lit(True), F.coalesce("duration_sec", F.lit(0))), "http_4xx": _if(F.col("http_status").between(400, 499)),
        "http_5xx": _if(F.col("http_status").between(500, 599)), "entrances": _if(F.col("event_key") == F.col("first_key")), "exits": _if(F.col("event_key") == F.col("last_key")), "bounces": _if(F.col("n") == 1),
    }
    return marts.entity_daily(e, F.col("url_path"), s["page_view"], measures, of_session=day)


def entity_daily(spark: SparkSession, d: str) -> DataFrame:
    """The three kinds in one table; measures that a kind lacks are 0."""
    return marts.aligned_union({"product": entity_product_daily(spark, d), "search_query": entity_search_daily(spark, d), "page": entity_page_daily(spark, d)})


_ALL_MEASURES = dict.fromkeys(m for *_, ms, _c in _ENTITY.values() for m in ms)
query(
    "SELECT * REPLACE ("
    + ", ".join(f"coalesce({m}, 0) AS {m}" for m in _ALL_MEASURES)
    + ") FROM ("
    + " UNION ALL BY NAME ".join(f"SELECT '{k}' AS entity_type, * FROM ({_entity_sql(*a)})" for k, a in _ENTITY.items())
    + ")"
)(entity_daily)


@query(
    _e()
    + ", u AS (SELECT date_sk, "
    + ", ".join(f"count(DISTINCT user_id) FILTER (WHERE {_STEP[k]}) AS {k}" for k in ("page_view", "add_to_cart", "checkout_start", "order_complete"))
    + " FROM ev WHERE date_sk IS NOT NULL GROUP BY 1) SELECT date_sk AS day, CASE WHEN page_view > 0 THEN add_to_cart::DOUBLE / page_view END AS view_to_cart, CASE WHEN add_to_cart > 0 THEN checkout_start::DOUBLE / add_to_cart END AS cart_to_checkout, CASE WHEN checkout_start > 0 THEN order_complete::DOUBLE / checkout_start END AS checkout_to_order FROM u"
)
def funnel_rates(spark: SparkSession, d: str) -> DataFrame:
    return marts.funnel_rates(behavioral_daily(spark, d).filter("device = 'all'"))


@query("SELECT epoch_us(time_bucket(INTERVAL 10 MINUTE, ts)) AS bucket_us, count(*) AS n_events FROM events GROUP BY 1")
def ten_minute_buckets(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events", ["ts"]).select(F.col("ts").cast("timestamp").alias("ts"))
    return e.groupBy(F.window("ts", "10 minutes")).agg(F.count(F.lit(1)).alias("n_events")).select(F.unix_micros("window.start").alias("bucket_us"), "n_events")


@query(
    """WITH g AS (SELECT *, epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pause FROM events),
n AS (SELECT *, sum(CASE WHEN pause IS NULL OR pause > 1800000000 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session_no FROM g)
SELECT user_id, session_no::BIGINT AS session_no, count(*) AS n_events, min(epoch_us(ts)) AS started_us FROM n GROUP BY 1, 2"""
)
def gap_sessions(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events", ["event_id", "ts", "user_id"]).withColumn("at_us", F.unix_micros(F.col("ts").cast("timestamp")))
    s = marts.gap_sessions(e, "user_id", "at_us", "event_id", 1_800_000_000)
    return s.select(F.col("user").alias("user_id"), "session_no", F.col("events").alias("n_events"), F.col("started").alias("started_us"))


# ------------------------------------------------------------ event sources


@query(
    f"""WITH {INSTANTS} SELECT CASE WHEN event_timestamp_us IS NOT NULL THEN 'payload' WHEN kafka_timestamp IS NOT NULL THEN 'kafka' ELSE 'none' END AS time_source, count(*) AS n_rows,
  min(coalesce(event_timestamp_us, epoch_us(kafka_timestamp))) AS min_us, max(coalesce(event_timestamp_us, epoch_us(kafka_timestamp))) AS max_us FROM timed GROUP BY 1"""
)
def event_time_provenance(spark: SparkSession, d: str) -> DataFrame:
    e, payload = _timed(spark, d), F.col("event_timestamp_us")
    source = F.when(payload.isNotNull(), "payload").when(F.col("kafka_timestamp").isNotNull(), "kafka").otherwise("none")
    at = F.coalesce(payload, F.unix_micros("kafka_timestamp"))
    return e.select(source.alias("time_source"), at.alias("at")).groupBy("time_source").agg(F.count(F.lit(1)).alias("n_rows"), F.min("at").alias("min_us"), F.max("at").alias("max_us"))


def partition_quality(at: Column, raw: Column | None, earliest: str, latest: str) -> Column:
    """Class of a partition timestamp: field_missing (the dataset has no such
    column: ``raw`` is None), null, unparseable, epoch_1970, too_old, future or valid."""
    if raw is None:
        return F.lit("field_missing")
    return (
        F.when(raw.isNull(), "null")
        .when(at.isNull(), "unparseable")
        .when(F.year(at) == 1970, "epoch_1970")
        .when(at < F.lit(earliest).cast("timestamp"), "too_old")
        .when(at >= F.lit(latest).cast("timestamp"), "future")
        .otherwise("valid")
    )


_EARLIEST, _LATEST = "2025-11-01", "2026-04-01"


def _quality_sql(raw: str, at: str) -> str:
    return (
        f"CASE WHEN {raw} IS NULL THEN 'null' WHEN {at} IS NULL THEN 'unparseable' WHEN year({at}) = 1970 THEN 'epoch_1970' WHEN {at} < TIMESTAMP '{_EARLIEST}' THEN 'too_old' "
        f"WHEN {at} >= TIMESTAMP '{_LATEST}' THEN 'future' ELSE 'valid' END"
    )


@query(f"WITH {INSTANTS} SELECT {_quality_sql('event_timestamp', 'make_timestamp(event_timestamp_us)')} AS quality, count(*) AS n_rows FROM timed GROUP BY 1")
def safe_partition_quality(spark: SparkSession, d: str) -> DataFrame:
    q = partition_quality(F.timestamp_micros("event_timestamp_us"), F.col("event_timestamp"), _EARLIEST, _LATEST)
    return _timed(spark, d).groupBy(q.alias("quality")).agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    f"""WITH {INSTANTS}, c AS (SELECT {_quality_sql('event_timestamp', 'make_timestamp(event_timestamp_us)')} AS q1, {_quality_sql('kafka_timestamp', "(kafka_timestamp AT TIME ZONE 'UTC')")} AS q2,
  {_quality_sql('ingested_at', 'make_timestamp(ingested_at_us)')} AS q3, * FROM timed)
SELECT CASE WHEN q1 = 'valid' THEN 'field' WHEN q2 = 'valid' THEN 'kafka' WHEN q3 = 'valid' THEN 'ingested' ELSE 'unresolved' END AS time_source,
  CASE WHEN q1 = 'valid' THEN make_timestamp(event_timestamp_us)::DATE WHEN q2 = 'valid' THEN (kafka_timestamp AT TIME ZONE 'UTC')::DATE WHEN q3 = 'valid' THEN make_timestamp(ingested_at_us)::DATE END AS partition_date, count(*) AS n_rows
FROM c GROUP BY 1, 2"""
)
def safe_partition_dates(spark: SparkSession, d: str) -> DataFrame:
    """Day partition of each raw event: the first of payload, Kafka and ingest time
    that lies within the bounds; rows for which none does are listed as unresolved."""
    from tidewell.sources.bronze import first_valid_time

    e = _timed(spark, d)
    at, source = first_valid_time(
        {"field": F.timestamp_micros("event_timestamp_us"), "kafka": F.col("kafka_timestamp"), "ingested": F.timestamp_micros("ingested_at_us")}, _EARLIEST, _LATEST
    )
    return e.groupBy(source.alias("time_source"), F.to_date(at).alias("partition_date")).agg(F.count(F.lit(1)).alias("n_rows"))
