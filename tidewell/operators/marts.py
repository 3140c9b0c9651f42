"""Denormalized tables and behavioral marts.

Distinct users and sessions are counted in two levels: one row for each (group,
user) and (group, session) with flags first, then sums of the flags. So no row is
expanded once for every distinct count, and a hot day's users are combined before
the shuffle. What needs an order is the least or greatest of a struct, so no
session and no user is sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewell.functions.ids import strip

#: The steps and the event types that count for them (fixed values); every mart
#: takes the same map.
VOCABULARY = {
    "page_view": ["page_view"],
    "search": ["search", "product_search"],
    "add_to_cart": ["add_to_cart"],
    "checkout_start": ["checkout_start", "checkout"],
    "payment_attempt": ["payment_attempt"],
    "order_complete": ["order_complete"],
    "wishlist_add": ["wishlist_add"],
    "review": ["review", "review_submit"],
}
#: Payments come as events of their own or as attempts with an outcome.
PAID, UNPAID = ["successful_payment"], ["failed_payment"]
FUNNEL = ["page_view", "search", "add_to_cart", "checkout_start", "payment_attempt", "successful_payment", "order_complete"]


def once_per_parent(df: DataFrame, parent: str, order: str, measure: str) -> DataFrame:
    """Fan-out-safe measure: ``<measure>_once`` is the parent's value on its first
    row (by ``order``) and 0 on the others; ``is_first_row`` and ``parent_rows``
    come with it."""
    w = W.partitionBy(parent)
    first = F.when(F.row_number().over(w.orderBy(F.col(order).asc_nulls_last())) == 1, 1).otherwise(0)
    return df.withColumns({"is_first_row": first, "parent_rows": F.count(F.lit(1)).over(w)}).withColumn(
        f"{measure}_once", F.when(F.col("is_first_row") == 1, F.col(measure)).otherwise(F.lit(0).cast(df.schema[measure].dataType))
    )


def step_flags(event_type: str = "event_type", success: str = "success", vocabulary: dict[str, list[str]] = VOCABULARY) -> dict[str, Column]:
    """Conditions by step, with the two outcomes of a payment."""
    t = F.lower(strip(event_type))
    steps = {k: t.isin(v) for k, v in vocabulary.items()}
    tried = t.isin(vocabulary["payment_attempt"])
    return steps | {
        "successful_payment": t.isin(PAID) | (tried & F.coalesce(F.col(success), F.lit(False))),
        "failed_payment": t.isin(UNPAID) | (tried & ~F.coalesce(F.col(success), F.lit(True))),
    }


def device_name(device: str) -> Column:
    """A blank device is ``unknown``."""
    return F.coalesce(F.nullif(F.lower(strip(device)), F.lit("")), F.lit("unknown"))


def daily(events: DataFrame, commerce: DataFrame | None = None, all_label: str = "all") -> DataFrame:
    """By day and device, and over all devices: the daily measures.

    events    (date_sk, user_id, session_id, event_type, device, success,
              results_count, clicked_position, http_status, duration_sec)
    commerce  (date_sk, orders, customers, units, gross): put on the row of all
              devices, zeros elsewhere
    Null users and sessions count as events only. A bounced session has one event
    in all the events given. New users are first seen, by all the events given,
    on that day; the others of that day are returning."""
    steps = step_flags()
    click = steps["search"] & F.col("clicked_position").isNotNull()
    e = events.filter("date_sk is not null").select(
        "date_sk",
        "user_id",
        "session_id",
        device_name("device").alias("device"),
        *[c.alias(k) for k, c in steps.items()],
        (steps["search"] & (F.coalesce("results_count", F.lit(0)) == 0)).alias("zero_result_search"),
        click.alias("clicked_search"),
        F.col("http_status").between(400, 499).alias("http_4xx"),
        F.col("http_status").between(500, 599).alias("http_5xx"),
        F.coalesce(F.col("duration_sec"), F.lit(0)).cast("bigint").alias("duration"),
    )
    counted = [*steps, "zero_result_search", "clicked_search", "http_4xx", "http_5xx"]
    pairs = e.groupBy("date_sk", "device", "user_id", "session_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("duration").alias("duration"), *[F.count_if(k).alias(k) for k in counted]
    )
    pairs = pairs.withColumn("device", F.explode(F.array("device", F.lit(all_label))))
    sums = [F.sum(k).alias(k) for k in ("n", "duration", *counted)]
    by_user = pairs.groupBy("date_sk", "device", "user_id").agg(*sums)
    seen = events.filter("user_id is not null and date_sk is not null").groupBy("user_id").agg(F.min("date_sk").alias("first_day"))
    by_user = by_user.join(seen, "user_id", "left")
    users = by_user.groupBy("date_sk", "device").agg(
        F.sum("n").alias("total_events"),
        F.count("user_id").alias("unique_users"),
        *[F.sum(k).alias(f"{k}_events") for k in steps],
        *[F.count_if(F.col("user_id").isNotNull() & (F.col(k) > 0)).alias(f"{k}_users") for k in FUNNEL],
        F.sum("zero_result_search").alias("zero_result_searches"),
        F.sum("clicked_search").alias("clicked_searches"),
        F.sum("http_4xx").alias("http_4xx_events"),
        F.sum("http_5xx").alias("http_5xx_events"),
        F.sum("duration").alias("total_session_duration_sec"),
        F.count_if(F.col("user_id").isNotNull() & (F.col("date_sk") == F.col("first_day"))).alias("new_users"),
    )
    whole = events.filter("session_id is not null").groupBy("session_id").agg((F.count(F.lit(1)) == 1).alias("bounced"))
    by_session = pairs.filter("session_id is not null").groupBy("date_sk", "device", "session_id").agg(*[F.sum(k).alias(k) for k in FUNNEL]).join(whole, "session_id")
    sessions = by_session.groupBy("date_sk", "device").agg(
        F.count(F.lit(1)).alias("sessions"), F.count_if("bounced").alias("bounced_sessions"), *[F.count_if(F.col(k) > 0).alias(f"{k}_sessions") for k in FUNNEL]
    )
    filled = ["sessions", "bounced_sessions", *[f"{k}_sessions" for k in FUNNEL]]
    out = users.join(sessions, ["date_sk", "device"], "left").fillna(0, filled)
    out = out.withColumn("returning_users", F.greatest(F.col("unique_users") - F.col("new_users"), F.lit(0)))
    if commerce is None:
        return out
    held = commerce.select("date_sk", F.lit(all_label).alias("device"), "orders", "customers", "units", "gross")
    out = out.join(held, ["date_sk", "device"], "left").fillna(0, ["orders", "customers", "units"])
    money = F.coalesce("gross", F.lit(0)).cast("decimal(18,4)")
    zero = F.lit(0).cast("decimal(18,4)")
    return out.withColumns({"gross_revenue": money, "net_revenue": money, "discounts": zero, "refunds": zero}).drop("gross")


def new_and_returning(events: DataFrame, day: str, user: str, start: Column | None = None) -> DataFrame:
    """By day, users seen for the first time and others. ``start`` limits the days
    that come out, not the history that first sight is judged by."""
    seen = events.filter(F.col(user).isNotNull() & F.col(day).isNotNull()).select(F.col(day).alias("day"), F.col(user).alias("user")).distinct()
    first = seen.groupBy("user").agg(F.min("day").alias("first_day"))
    out = seen.join(first, "user").groupBy("day").agg(
        F.count_if(F.col("day") == F.col("first_day")).alias("new_users"),
        F.count_if(F.col("day") > F.col("first_day")).alias("returning_users"),
    )
    return out.filter(F.col("day") >= start) if start is not None else out


def modal(df: DataFrame, key: str, value: str) -> DataFrame:
    """Most frequent value of each key; of equals the least in text order."""
    n = df.filter(F.col(key).isNotNull() & F.col(value).isNotNull()).groupBy(key, value).agg(F.count(F.lit(1)).alias("n"))
    return n.groupBy(key).agg(F.min(F.struct((-F.col("n")).alias("n"), F.col(value).alias("v")))["v"].alias(value))


def _date(sk: str) -> Column:
    return F.to_date(F.col(sk).cast("string"), "yyyyMMdd")


def user_daily(events: DataFrame) -> DataFrame:
    """By user and day: sessions, events, duration, steps, orders, cohorts by first
    sight over all the events given, orders so far and the days since, the user's
    most frequent device, and what they did. A user's orders so far are summed over
    their days with an order, one row a day.

    events    (date_sk, user_id, session_id, event_type, device, success, order_id,
              duration_sec)"""
    steps = step_flags()
    e = events.filter("user_id is not null and date_sk is not null")
    done = F.when(steps["order_complete"], F.col("order_id"))
    pairs = e.groupBy("user_id", "date_sk", "session_id", done.alias("order_id")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.coalesce("duration_sec", F.lit(0)).cast("bigint")).alias("duration"), *[F.count_if(c).alias(k) for k, c in steps.items()]
    )
    sums = [F.sum(k).alias(k) for k in ("n", "duration", *steps)]
    by_session = pairs.groupBy("user_id", "date_sk", "session_id").agg(*sums)
    by_day = by_session.groupBy("user_id", "date_sk").agg(F.count("session_id").alias("sessions"), *sums)
    orders = pairs.filter("order_id is not null").select("user_id", "date_sk", "order_id").distinct()
    per_day = orders.groupBy("user_id", "date_sk").agg(F.count(F.lit(1)).alias("daily_orders"))
    # An order counts once for the lifetime, on the first day it was completed.
    first_done = orders.groupBy("user_id", "order_id").agg(F.min("date_sk").alias("date_sk")).groupBy("user_id", "date_sk").agg(F.count(F.lit(1)).alias("first_done"))
    first = by_day.groupBy("user_id").agg(F.min("date_sk").alias("first_day"))
    out = by_day.join(per_day, ["user_id", "date_sk"], "left").join(first_done, ["user_id", "date_sk"], "left").fillna(0, ["daily_orders", "first_done"])
    so_far = W.partitionBy("user_id").orderBy("date_sk").rowsBetween(W.unboundedPreceding, 0)
    out = out.withColumns(
        {
            "lifetime_orders": F.sum("first_done").over(so_far),
            "last_order_day": F.max(F.when(F.col("daily_orders") > 0, F.col("date_sk"))).over(so_far),
        }
    )
    device = modal(e.withColumn("device", device_name("device")), "user_id", "device").withColumnRenamed("device", "primary_device")
    out = out.join(first, "user_id").join(device, "user_id", "left")
    had = lambda k: F.col(k) > 0
    return out.select(
        "user_id",
        "date_sk",
        "sessions",
        F.col("n").alias("events"),
        F.col("duration").alias("duration_sec"),
        *[F.col(k).alias(f"{k}_events") for k in steps],
        "daily_orders",
        F.col("first_day").alias("first_seen_day"),
        F.trunc(_date("first_day"), "week").alias("cohort_week"),
        F.trunc(_date("first_day"), "month").alias("cohort_month"),
        F.datediff(_date("date_sk"), _date("first_day")).alias("days_since_first_seen"),
        (F.col("date_sk") == F.col("first_day")).alias("is_new"),
        (F.col("date_sk") > F.col("first_day")).alias("is_returning"),
        "lifetime_orders",
        "last_order_day",
        F.datediff(_date("date_sk"), _date("last_order_day")).alias("days_since_last_order"),
        "primary_device",
        had("search").alias("was_searcher"),
        had("add_to_cart").alias("was_cart_user"),
        had("checkout_start").alias("was_checkout_user"),
        had("order_complete").alias("was_buyer"),
        had("review").alias("was_reviewer"),
    )


def sessions(events: DataFrame, orders: DataFrame, users: DataFrame) -> DataFrame:
    """By session: span, first and last event's page, type and device, time of each
    step and their counts, distinct products viewed and added, the orders its
    events name against those that exist, what became of it, and the user's
    attributes.

    events    (at_us, event_key, session_id, user_id, event_type, device, url_path,
              product_id, order_id, success); ties in time are ordered by event_key
    orders    (order_id, order_total, units), distinct order_id
    users     (user_id, location, loyalty_tier), distinct user_id
    All of it is aggregation with partial combination; the distinct products and
    the orders are reduced to one row a (session, product) or (session, order)."""
    steps = step_flags()
    e = events.filter("session_id is not null and at_us is not null").withColumns({"url_path": F.coalesce("url_path", F.lit("-")), "device": device_name("device")})
    point = F.struct("at_us", "event_key", "url_path", F.lower(strip("event_type")).alias("event_type"), "device")
    timed = ["page_view", "search", "add_to_cart", "checkout_start", "successful_payment"]
    s = e.groupBy("session_id").agg(
        F.min(point).alias("a"),
        F.max(point).alias("z"),
        F.count(F.lit(1)).alias("events"),
        F.min("user_id").alias("user_id"),
        *[F.min(F.when(steps[k], F.col("at_us"))).alias(f"first_{k}_us") for k in timed],
        *[F.count_if(c).alias(f"{k}_count") for k, c in steps.items()],
        F.bool_or(F.col("order_id").isNotNull()).alias("had_behavioral_order"),
    )
    item = e.filter("product_id is not null").groupBy("session_id", "product_id").agg(F.bool_or(steps["page_view"]).alias("v"), F.bool_or(steps["add_to_cart"]).alias("c"))
    items = item.groupBy("session_id").agg(F.count_if("v").alias("products_viewed"), F.count_if("c").alias("products_added"))
    named = e.filter("order_id is not null").select("session_id", "order_id").distinct()
    matched = named.join(orders, "order_id").groupBy("session_id").agg(F.count(F.lit(1)).alias("matched_orders"), F.sum("order_total").alias("matched_total"), F.sum("units").alias("matched_units"))
    out = s.join(items, "session_id", "left").join(matched, "session_id", "left").join(users, "user_id", "left")
    had = lambda k: F.col(f"{k}_count") > 0
    behavioral, transactional = F.col("had_behavioral_order"), F.coalesce(F.col("matched_orders") > 0, F.lit(False))
    completed = had("order_complete")
    return out.select(
        "session_id",
        "user_id",
        F.col("a.at_us").alias("started_us"),
        F.col("z.at_us").alias("ended_us"),
        F.floor((F.col("z.at_us") - F.col("a.at_us")) / 1_000_000).alias("duration_sec"),
        F.to_date(F.timestamp_micros("a.at_us")).alias("session_date"),
        "events",
        F.col("a.url_path").alias("landing_page"),
        F.col("z.url_path").alias("exit_page"),
        F.col("a.event_type").alias("first_event_type"),
        F.col("z.event_type").alias("last_event_type"),
        F.col("a.device").alias("device"),
        *[f"first_{k}_us" for k in timed],
        *[f"{k}_count" for k in steps],
        F.coalesce("products_viewed", F.lit(0)).alias("products_viewed"),
        F.coalesce("products_added", F.lit(0)).alias("products_added"),
        "had_behavioral_order",
        F.coalesce("matched_orders", F.lit(0)).alias("matched_orders"),
        F.coalesce("matched_total", F.lit(0)).cast("decimal(18,4)").alias("matched_total"),
        F.coalesce("matched_units", F.lit(0)).alias("matched_units"),
        F.when(behavioral & transactional, "matched")
        .when(behavioral | completed, "behavioral_only")
        .when(transactional, "transactional_only")
        .otherwise("none")
        .alias("order_match_status"),
        (F.col("events") == 1).alias("is_bounce"),
        had("successful_payment").alias("is_converted"),
        (had("add_to_cart") & ~had("successful_payment")).alias("cart_abandoned"),
        (had("checkout_start") & ~had("successful_payment")).alias("checkout_abandoned"),
        F.coalesce(F.nullif(strip("location"), F.lit("")), F.lit("")).alias("country"),
        F.coalesce(F.nullif(strip("loyalty_tier"), F.lit("")), F.lit("")).alias("segment"),
    )


def gap_sessions(events: DataFrame, user: str, at_us: str, key: str, gap_us: int, chunk_us: int = 86_400_000_000) -> DataFrame:
    """(user, session_no, events, started, ended): sessions of sources without
    session ids, a new one after a pause longer than ``gap_us``.

    Sessions are cut inside chunks of time first and then joined over the chunks'
    borders from their few cut sessions, so a user with very many events is no
    single task; ``chunk_us`` bounds what is sorted together."""
    e = events.filter(F.col(user).isNotNull() & F.col(at_us).isNotNull()).select(F.col(user).alias("user"), F.col(at_us).alias("at"), F.col(key).alias("key"))
    e = e.withColumn("chunk", F.floor(F.col("at") / chunk_us))
    w = W.partitionBy("user", "chunk").orderBy("at", "key")
    start = F.coalesce((F.col("at") - F.lag("at").over(w) > gap_us).cast("int"), F.lit(1))
    parts = e.withColumn("s", start).withColumn("part", F.sum("s").over(w)).groupBy("user", "chunk", "part").agg(
        F.count(F.lit(1)).alias("n"), F.min("at").alias("a"), F.max("at").alias("z")
    )
    u = W.partitionBy("user").orderBy("chunk", "part")
    fresh = F.coalesce((F.col("a") - F.lag("z").over(u) > gap_us).cast("int"), F.lit(1))
    numbered = parts.withColumn("s", fresh).withColumn("session_no", F.sum("s").over(u))
    return numbered.groupBy("user", "session_no").agg(F.sum("n").alias("events"), F.min("a").alias("started"), F.max("z").alias("ended"))


def entity_daily(
    events: DataFrame,
    entity: Column,
    kept: Column,
    measures: dict[str, Column],
    users: dict[str, Column] | None = None,
    sessions: dict[str, Column] | None = None,
    of_session: dict[str, Column] | None = None,
) -> DataFrame:
    """By entity, device and day: events, distinct users and sessions, those of
    sessions that completed an order that day, ``measures`` (sums of columns of the
    events), ``users`` (distinct users of events for which a condition holds) and
    ``sessions`` (distinct sessions with the entity that had a step that day).
    ``of_session`` are aggregates of a session's day that measures may name.

    What a session did that day is one aggregation and is joined as one row a (day,
    session), nothing is collected: to the events' sums by user and session, or to
    the kept events themselves where measures need it. Rows without a session don't
    meet that join."""
    steps = step_flags()
    users, sessions, of_session = users or {}, sessions or {}, of_session or {}
    did = events.filter("session_id is not null and date_sk is not null").groupBy("date_sk", "session_id").agg(
        F.bool_or(steps["order_complete"]).alias("__ordered"), *[F.bool_or(c).alias(f"__s_{k}") for k, c in sessions.items()], *[c.alias(k) for k, c in of_session.items()]
    )
    keys = ["date_sk", "entity", "device"]
    flags = ["__ordered", *[f"__s_{k}" for k in sessions]]

    def joined(df: DataFrame) -> DataFrame:
        with_session = df.filter("session_id is not null").join(did, ["date_sk", "session_id"])
        return with_session.unionByName(df.filter("session_id is null"), allowMissingColumns=True)

    rows = events.filter(kept & entity.isNotNull() & F.col("date_sk").isNotNull()).withColumns({"entity": entity, "device": device_name("device")})
    rows = joined(rows) if of_session else rows
    e = rows.groupBy(*keys, "user_id", "session_id").agg(
        F.count(F.lit(1)).alias("__n"),
        *[F.sum(c).alias(k) for k, c in measures.items()],
        *[F.count_if(c).alias(f"__u_{k}") for k, c in users.items()],
        *([F.bool_or(f).alias(f) for f in flags] if of_session else []),
    )
    e = e if of_session else joined(e)
    e = e.withColumns({f: F.coalesce(F.col(f), F.lit(False)) for f in flags})
    by_user = e.groupBy(*keys, "user_id").agg(
        F.sum("__n").alias("__n"), F.bool_or("__ordered").alias("__ordered"), *[F.sum(k).alias(k) for k in measures], *[F.sum(f"__u_{k}").alias(f"__u_{k}") for k in users]
    )
    known = F.col("user_id").isNotNull()
    a = by_user.groupBy(*keys).agg(
        F.sum("__n").alias("event_count"),
        F.count("user_id").alias("unique_users"),
        F.count_if(known & F.col("__ordered")).alias("converting_users"),
        *[F.coalesce(F.sum(k), F.lit(0)).alias(k) for k in measures],
        *[F.count_if(known & (F.col(f"__u_{k}") > 0)).alias(k) for k in users],
    )
    b = (
        e.groupBy(*keys, "session_id")
        .agg(*[F.bool_or(f).alias(f) for f in flags])
        .groupBy(*keys)
        .agg(
            F.count("session_id").alias("unique_sessions"),
            F.count_if(F.col("session_id").isNotNull() & F.col("__ordered")).alias("converting_sessions"),
            *[F.count_if(F.col("session_id").isNotNull() & F.col(f"__s_{k}")).alias(k) for k in sessions],
        )
    )
    return a.join(b, keys)


def aligned_union(branches: dict[str, DataFrame], kind: str = "entity_type") -> DataFrame:
    """All branches by name, with the branch's name; numbers that a branch lacks
    are 0."""
    out = None
    for name, df in branches.items():
        df = df.withColumn(kind, F.lit(name))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out.fillna(0)


def funnel_rates(daily_all: DataFrame) -> DataFrame:
    """Rates between neighbouring steps, in users; null where the first is 0."""
    rate = lambda a, b: F.when(F.col(f"{a}_users") > 0, F.col(f"{b}_users").cast("double") / F.col(f"{a}_users"))
    return daily_all.select(
        F.col("date_sk").alias("day"),
        rate("page_view", "add_to_cart").alias("view_to_cart"),
        rate("add_to_cart", "checkout_start").alias("cart_to_checkout"),
        rate("checkout_start", "order_complete").alias("checkout_to_order"),
    )
