"""The denormalized tables in full, the product dimension from snapshots and
history, and the quarantine and deletes that go with the facts."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions.ids import date_sk, norm_id, strip
from tidewell.operators import asof, audits, history, marts, quality, versions
from tidewell.operators.calendar import calendar
from tidewell.plans import star
from tidewell.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
_WS = star._WS


def query(sql: str | None = None) -> Callable:
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


#: Columns that are identifiers and columns that are compared without case.
_IDS = {"order_id", "order_item_id", "return_refund_id", "product_id", "user_id"}
_LOWER = {"status", "payment_method", "return_reason"}
#: name: (table, key, the columns that decide between rows of one time, in order)
_TABLES = {
    "o": ("fact_order", "order_id", ["order_total", "order_timestamp", "user_sk", "status", "payment_method", "order_sk"]),
    "i": ("fact_order_item", "order_item_id", ["item_total_amount", "quantity", "unit_price", "order_timestamp", "order_id", "product_id", "product_sk", "product_resolution", "order_item_sk"]),
    "r": ("fact_return_refund", "return_refund_id", ["refund_amount", "return_timestamp", "order_item_id", "order_id", "return_reason", "return_refund_sk"]),
    "u": ("dim_user", "user_sk", ["user_id", "username", "email", "signup_date", "device", "loyalty_tier", "location"]),
    "p": ("dim_product", "product_sk", ["product_id", "product_name", "price"]),
}


def _read(c: str) -> Column:
    return norm_id(c) if c in _IDS else F.lower(strip(c)) if c in _LOWER else F.col(c)


def latest(spark: SparkSession, d: str, name: str) -> DataFrame:
    """One row for each key: the latest by source time, ties by the columns. One
    aggregation that combines before the shuffle; rows without key are left out."""
    source, key, columns = _TABLES[name]
    t = table(spark, d, source, [key, *columns, "source_kafka_timestamp"])
    t = t.select(_read(key).alias(key), "source_kafka_timestamp", *[_read(c).alias(c) for c in columns]).filter(F.col(key).isNotNull())
    return t.groupBy(key).agg(F.max(F.struct("source_kafka_timestamp", *columns)).alias("r")).select(key, "r.*")


def _sql(name: str) -> str:
    source, key, columns = _TABLES[name]
    read = lambda c: f"{star._id(c)} AS {c}" if c in _IDS else f"lower(trim({c}, {_WS})) AS {c}" if c in _LOWER else c
    order = ", ".join(f"{c} DESC NULLS LAST" for c in ["source_kafka_timestamp", *columns])
    return f"{name} AS (SELECT * FROM (SELECT {', '.join(read(c) for c in [key, *columns])}, source_kafka_timestamp FROM {source}) WHERE {key} IS NOT NULL QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY {order}) = 1)"


_CALENDAR_SQL = """dd AS (SELECT (year(x) * 10000 + month(x) * 100 + day(x))::INT AS date_sk, x::DATE AS full_date, year(x)::INT AS year, quarter(x)::INT AS quarter, month(x)::INT AS month,
  monthname(x) AS month_name, weekofyear(x)::INT AS week_of_year, day(x)::INT AS day, (dayofweek(x) + 1)::INT AS day_of_week, dayname(x) AS day_name, (dayofweek(x) IN (0, 6))::INT AS is_weekend
  FROM range(DATE '2024-01-01', DATE '2031-01-01', INTERVAL 1 DAY) t(x))"""
_DATE_COLUMNS = ["full_date", "year", "quarter", "month", "month_name", "week_of_year", "day", "day_of_week", "day_name", "is_weekend"]


def _dates(spark: SparkSession, d: str) -> DataFrame:
    return calendar(spark, date(2024, 1, 1), date(2030, 12, 31)).withColumn("is_weekend", F.col("is_weekend").cast("int"))


def with_member(facts: DataFrame, dimension: DataFrame, key: str, unknown: int) -> DataFrame:
    """Star join: facts whose key is null or not in the dimension get its unknown
    member, so no fact is lost. A key that very many facts share is one row of the
    dimension, and adaptive execution broadcasts or splits it."""
    hit = facts.join(dimension.select(F.col(key).alias("__k"), *[F.col(c).alias(f"__{c}") for c in dimension.columns if c != key]), F.col(key) == F.col("__k"), "left")
    member = {c: F.col(f"__{c}") for c in dimension.columns if c != key}
    return hit.select(*[c for c in facts.columns if c != key], F.coalesce("__k", F.lit(unknown).cast("bigint")).alias(key), *[v.alias(c) for c, v in member.items()])


_USER = ["user_id", "username", "email", "signup_date", "device", "loyalty_tier", "location"]
_MONEY = {"order_total", "unit_price", "item_total_amount", "product_price", "refund_amount", "order_total_once"}


def _out(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*[F.col(c).cast("double").alias(c) if c in _MONEY else F.col(c) for c in columns])


_OBT_COLUMNS = [
    "order_item_sk", "order_item_id", "order_sk", "order_id", "order_timestamp_us", "order_date_sk", *_DATE_COLUMNS, "order_count_flag", "item_count_in_order", "order_total", "order_total_once",
    "status", "payment_method", "user_sk", *_USER, "product_sk", "product_id", "product_name", "product_price", "quantity", "unit_price", "item_total_amount", "product_resolution",
]
_BASE_SQL = f"WITH {_sql('o')}, {_sql('i')}, {_sql('u')}, {_sql('p')}, {_CALENDAR_SQL}"
_UNKNOWNS = "coalesce(u.user_sk, -1) AS user_sk, " + ", ".join(f"u.{c}" for c in _USER) + ", coalesce(p.product_sk, 0) AS product_sk, p.product_id, p.product_name, p.price AS product_price"


@query(
    _BASE_SQL
    + f""", t AS (SELECT i.order_item_sk, i.order_item_id, o.order_sk, o.order_id, epoch_us(o.order_timestamp) AS order_timestamp_us, dd.date_sk AS order_date_sk, {", ".join("dd." + c for c in _DATE_COLUMNS)},
  row_number() OVER w = 1 AS is_first, count(*) OVER (PARTITION BY o.order_id) AS item_count_in_order, o.order_total, o.status, o.payment_method, {_UNKNOWNS}, i.quantity, i.unit_price, i.item_total_amount, i.product_resolution
  FROM i JOIN o ON i.order_id = o.order_id LEFT JOIN u ON o.user_sk = u.user_sk LEFT JOIN p ON i.product_sk = p.product_sk LEFT JOIN dd ON dd.date_sk = strftime(o.order_timestamp AT TIME ZONE 'UTC', '%Y%m%d')::INT
  WINDOW w AS (PARTITION BY o.order_id ORDER BY i.order_item_id))
SELECT * EXCLUDE (is_first), is_first::INT AS order_count_flag, CASE WHEN is_first THEN order_total ELSE 0 END AS order_total_once FROM t"""
)
def transactional_obt(spark: SparkSession, d: str) -> DataFrame:
    """One row an item over item, order, user, product and date; users and products
    that are not there are the unknown members, an order without time has no date.
    The load time is the caller's to add."""
    o = latest(spark, d, "o").drop("source_kafka_timestamp")
    i = latest(spark, d, "i").drop("source_kafka_timestamp", "order_timestamp", "product_id")
    base = i.join(o, "order_id").withColumns({"order_date_sk": date_sk(F.col("order_timestamp")), "order_timestamp_us": F.unix_micros("order_timestamp")})
    base = marts.once_per_parent(base, "order_id", "order_item_id", "order_total")
    base = base.withColumnsRenamed({"is_first_row": "order_count_flag", "parent_rows": "item_count_in_order"})
    base = with_member(base, latest(spark, d, "u").drop("source_kafka_timestamp"), "user_sk", -1)
    base = with_member(base, latest(spark, d, "p").drop("source_kafka_timestamp").withColumnRenamed("price", "product_price"), "product_sk", 0)
    return _out(base.join(_dates(spark, d).withColumnRenamed("date_sk", "order_date_sk"), "order_date_sk", "left"), _OBT_COLUMNS)


_RETURN_COLUMNS = [
    "return_refund_sk", "return_refund_id", "return_timestamp_us", "return_date_sk", *[f"return_{c.removeprefix('full_')}" for c in _DATE_COLUMNS], "refund_amount", "return_reason",
    "order_sk", "order_id", "order_timestamp_us", "order_total", "order_status", "payment_method", "order_item_sk", "order_item_id", "quantity", "unit_price", "item_total_amount",
    "user_sk", *_USER, "product_sk", "product_id", "product_name", "product_price",
]


@query(
    _BASE_SQL.replace("WITH ", f"WITH {_sql('r')}, ")
    + f""" SELECT r.return_refund_sk, r.return_refund_id, epoch_us(r.return_timestamp) AS return_timestamp_us, dd.date_sk AS return_date_sk, {", ".join(f"dd.{c} AS return_{c.removeprefix('full_')}" for c in _DATE_COLUMNS)},
  r.refund_amount, r.return_reason, o.order_sk, o.order_id, epoch_us(o.order_timestamp) AS order_timestamp_us, o.order_total, o.status AS order_status, o.payment_method, i.order_item_sk, i.order_item_id, i.quantity, i.unit_price,
  i.item_total_amount, {_UNKNOWNS} FROM r JOIN i ON r.order_item_id = i.order_item_id JOIN o ON i.order_id = o.order_id LEFT JOIN u ON o.user_sk = u.user_sk LEFT JOIN p ON i.product_sk = p.product_sk
  LEFT JOIN dd ON dd.date_sk = strftime(r.return_timestamp AT TIME ZONE 'UTC', '%Y%m%d')::INT"""
)
def return_refund_obt(spark: SparkSession, d: str) -> DataFrame:
    """One row a return over return, item, order, user, product and return date."""
    o = latest(spark, d, "o").drop("source_kafka_timestamp").withColumnRenamed("status", "order_status")
    i = latest(spark, d, "i").drop("source_kafka_timestamp", "order_timestamp", "product_id")
    r = latest(spark, d, "r").drop("source_kafka_timestamp", "order_id")
    base = r.join(i, "order_item_id").join(o, "order_id").withColumns(
        {"return_date_sk": date_sk(F.col("return_timestamp")), "return_timestamp_us": F.unix_micros("return_timestamp"), "order_timestamp_us": F.unix_micros("order_timestamp")}
    )
    base = with_member(base, latest(spark, d, "u").drop("source_kafka_timestamp"), "user_sk", -1)
    base = with_member(base, latest(spark, d, "p").drop("source_kafka_timestamp").withColumnRenamed("price", "product_price"), "product_sk", 0)
    days = _dates(spark, d).select(F.col("date_sk").alias("return_date_sk"), *[F.col(c).alias(f"return_{c.removeprefix('full_')}") for c in _DATE_COLUMNS])
    return _out(base.join(days, "return_date_sk", "left"), _RETURN_COLUMNS)


@query(
    f"WITH {_sql('o')}, {_sql('i')}, {_sql('r')}, t AS (SELECT r.* FROM r JOIN i ON r.order_item_id = i.order_item_id JOIN o ON i.order_id = o.order_id)"
    + """ SELECT unnest(['ids_unique', 'rows_are_represented_returns', 'refunds_reconcile']) AS check_name, unnest([(SELECT count(*) = count(DISTINCT return_refund_id) FROM t),
  (SELECT count(*) FROM t) = (SELECT count(*) FROM r WHERE order_item_id IN (SELECT order_item_id FROM i WHERE order_id IN (SELECT order_id FROM o))),
  (SELECT sum(refund_amount) FROM t) IS NOT DISTINCT FROM (SELECT sum(refund_amount) FROM r WHERE order_item_id IN (SELECT order_item_id FROM i WHERE order_id IN (SELECT order_id FROM o)))]) AS passed"""
)
def return_obt_audit(spark: SparkSession, d: str) -> DataFrame:
    """Rows, distinct ids and the exact sum of refunds of the table against its
    source, each side in one pass."""
    obt = return_refund_obt(spark, d)
    by_id = obt.groupBy("return_refund_id").agg(F.count(F.lit(1)).alias("n"), F.sum(F.round(F.col("refund_amount") * 100).cast("bigint")).alias("cents"))
    a = by_id.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("ids"), F.sum("cents").alias("cents"))
    items = latest(spark, d, "i").select("order_item_id", "order_id").join(latest(spark, d, "o").select("order_id"), "order_id", "left_semi")
    source = latest(spark, d, "r").join(items.select("order_item_id"), "order_item_id", "left_semi")
    b = source.agg(F.count(F.lit(1)).alias("m"), F.sum((F.col("refund_amount") * 100).cast("bigint")).alias("source_cents"))
    m = a.withColumn("j", F.lit(1)).join(b.withColumn("j", F.lit(1)), "j")
    return audits.checks(m, {"ids_unique": F.col("n") == F.col("ids"), "rows_are_represented_returns": F.col("n") == F.col("m"), "refunds_reconcile": F.col("cents").eqNullSafe(F.col("source_cents"))})


# ------------------------------------------------------------ dim_product


def _product_rules() -> list[quality.Rule]:
    """Snapshots and history events have their own reasons."""
    snap = F.col("is_snapshot")
    rule = lambda name, on, broken: quality.Rule(name, on & broken)
    return [
        quality.Rule("missing_product_id", F.col("product_id").isNull()),
        rule("missing_product_name", snap, F.coalesce(F.length("product_name") == 0, F.lit(True))),
        rule("missing_product_price", snap, F.col("price").isNull()),
        rule("negative_product_price", snap, F.col("price") < 0),
        rule("missing_product_timestamp", snap, F.col("source_kafka_timestamp").isNull()),
        rule("missing_price", ~snap, F.col("price").isNull()),
        rule("negative_price", ~snap, F.col("price") < 0),
        rule("missing_valid_from", ~snap, F.col("effective_from").isNull()),
        rule("missing_kafka_timestamp", ~snap, F.col("source_kafka_timestamp").isNull()),
    ]


def _observations(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "dim_product", ["product_id", "product_name", "price", "effective_from", "source_kind", "source_kafka_timestamp"])
    p = p.filter(~F.coalesce(F.lower(strip("source_kind")), F.lit("")).isin("system") & ~norm_id("product_id").eqNullSafe(F.lit("UNKNOWN")))
    return p.select(
        norm_id("product_id").alias("product_id"), strip("product_name").alias("product_name"), "price", "effective_from", "source_kafka_timestamp",
        F.coalesce(F.lower(strip("source_kind")) == "snapshot", F.lit(False)).alias("is_snapshot"),
    )


_OBSERVED = f"""ob AS (SELECT {star._id("product_id")} AS product_id, trim(product_name, {_WS}) AS product_name, price, effective_from, source_kafka_timestamp, coalesce(lower(trim(source_kind, {_WS})) = 'snapshot', false) AS is_snapshot
  FROM dim_product WHERE coalesce(lower(trim(source_kind, {_WS})), '') <> 'system' AND {star._id("product_id")} IS DISTINCT FROM 'UNKNOWN')
, vr AS (SELECT *, concat_ws('; ', CASE WHEN product_id IS NULL THEN 'missing_product_id' END, CASE WHEN is_snapshot AND coalesce(product_name, '') = '' THEN 'missing_product_name' END,
  CASE WHEN is_snapshot AND price IS NULL THEN 'missing_product_price' END, CASE WHEN is_snapshot AND price < 0 THEN 'negative_product_price' END, CASE WHEN is_snapshot AND source_kafka_timestamp IS NULL THEN 'missing_product_timestamp' END,
  CASE WHEN NOT is_snapshot AND price IS NULL THEN 'missing_price' END, CASE WHEN NOT is_snapshot AND price < 0 THEN 'negative_price' END, CASE WHEN NOT is_snapshot AND effective_from IS NULL THEN 'missing_valid_from' END,
  CASE WHEN NOT is_snapshot AND source_kafka_timestamp IS NULL THEN 'missing_kafka_timestamp' END) AS reason FROM ob)"""


@query(f"WITH {_OBSERVED} SELECT product_id, is_snapshot, reason, count(*) AS n_rows FROM vr GROUP BY ALL")
def product_validation(spark: SparkSession, d: str) -> DataFrame:
    marked = quality.with_reasons(_observations(spark, d), _product_rules(), "reason")
    return marked.groupBy("product_id", "is_snapshot", "reason").agg(F.count(F.lit(1)).alias("n_rows"))


def build_product_versions(observations: DataFrame) -> DataFrame:
    """(product_id, price, start, stop, is_snapshot, product_name) from valid
    observations. A history event counts from its own time. A snapshot counts from
    its source time, and only where the product has no history or a price other
    than the latest of it. At one instant snapshots win, then the later source time,
    then the higher price. The name is that of the latest snapshot.

    Everything by product is an aggregation with partial combination, and versions
    are coalesced by the tree, so a product with very many observations is no single
    task."""
    h = observations.filter("not is_snapshot")
    s = observations.filter("is_snapshot")
    last = h.groupBy("product_id").agg(F.max(F.struct("effective_from", "source_kafka_timestamp", "price"))["price"].alias("last_price"))
    news = s.join(last, "product_id", "left").filter(F.col("last_price").isNull() | (F.col("last_price") != F.col("price"))).drop("last_price")
    seen = h.withColumn("at", F.unix_micros("effective_from")).unionByName(news.withColumn("at", F.unix_micros("source_kafka_timestamp")))
    one = seen.groupBy("product_id", "at").agg(F.max(F.struct("is_snapshot", "source_kafka_timestamp", "price")).alias("r")).select("product_id", "at", "r.is_snapshot", "r.price")
    runs = history.coalesce_runs(one, "product_id", "at", "price")
    kinds = one.select("product_id", F.col("at").alias("start"), "is_snapshot")
    names = s.groupBy("product_id").agg(F.max(F.struct("source_kafka_timestamp", "product_name"))["product_name"].alias("product_name"))
    return runs.join(kinds, ["product_id", "start"]).join(names, "product_id", "left")


_BUILT = f"""WITH {_OBSERVED}, ok AS (SELECT * FROM vr WHERE reason = ''), lh AS (SELECT product_id, arg_max(price, (effective_from, source_kafka_timestamp, price)) AS last_price FROM ok WHERE NOT is_snapshot GROUP BY 1),
seen AS (SELECT product_id, price, is_snapshot, source_kafka_timestamp, epoch_us(effective_from) AS at_us FROM ok WHERE NOT is_snapshot
  UNION ALL SELECT ok.product_id, price, is_snapshot, source_kafka_timestamp, epoch_us(source_kafka_timestamp) FROM ok LEFT JOIN lh USING (product_id) WHERE is_snapshot AND (last_price IS NULL OR last_price <> price)),
one AS (SELECT * FROM seen QUALIFY row_number() OVER (PARTITION BY product_id, at_us ORDER BY is_snapshot DESC, source_kafka_timestamp DESC, price DESC) = 1),
ch AS (SELECT *, lag(price) OVER (PARTITION BY product_id ORDER BY at_us) AS was FROM one),
nm AS (SELECT product_id, arg_max(product_name, (source_kafka_timestamp, product_name)) AS product_name FROM ok WHERE is_snapshot GROUP BY 1),
v AS (SELECT product_id, product_name, price, at_us AS effective_from_us, lead(at_us) OVER (PARTITION BY product_id ORDER BY at_us) AS effective_to_us, is_snapshot FROM ch LEFT JOIN nm USING (product_id) WHERE was IS NULL OR was <> price)
"""


@query(
    _BUILT
    + """SELECT product_id, product_name, price::DOUBLE AS price, effective_from_us, effective_to_us, effective_to_us IS NULL AS is_current, CASE WHEN is_snapshot THEN 'product_snapshot' ELSE 'price_history' END AS source_kind,
  sha256(product_id || '||' || coalesce(product_name, chr(0)) || '||' || price) AS record_hash FROM v UNION ALL SELECT 'UNKNOWN', 'Unknown', 0.0, 0, NULL, true, 'system', sha256('UNKNOWN||Unknown||0.00')"""
)
def dim_product_built(spark: SparkSession, d: str) -> DataFrame:
    """The dimension from valid snapshots and history, with its unknown member."""
    valid, _ = quality.split_valid(_observations(spark, d), _product_rules())
    v = build_product_versions(valid).select(
        "product_id", "product_name", "price", F.col("start").alias("effective_from_us"), F.col("stop").alias("effective_to_us"), F.col("stop").isNull().alias("is_current"),
        F.when(F.col("is_snapshot"), "product_snapshot").otherwise("price_history").alias("source_kind"),
    )
    v = versions.with_unknown(v, {"product_id": "UNKNOWN", "product_name": "Unknown", "price": 0, "effective_from_us": 0, "is_current": True, "source_kind": "system"})
    return v.withColumns({"record_hash": versions.record_hash(["product_id", "product_name", "price"]), "price": F.col("price").cast("double")})


@query(
    _BUILT
    + """SELECT coalesce(a.product_id, b.product_id) AS product_id, CASE WHEN b.product_id IS NULL THEN 'missing_history' WHEN a.product_id IS NULL THEN 'missing_snapshot' ELSE 'price_mismatch' END AS finding
FROM (SELECT product_id, arg_max(price, (source_kafka_timestamp, price)) AS price FROM ok WHERE is_snapshot GROUP BY 1) a
FULL JOIN (SELECT product_id, last_price AS price FROM lh) b ON a.product_id = b.product_id WHERE a.product_id IS NULL OR b.product_id IS NULL OR a.price <> b.price"""
)
def product_history_consistency(spark: SparkSession, d: str) -> DataFrame:
    """Products whose latest snapshot and latest history don't go together."""
    valid, _ = quality.split_valid(_observations(spark, d), _product_rules())
    at = F.when(F.col("is_snapshot"), F.col("source_kafka_timestamp")).otherwise(F.col("effective_from"))
    latest_of = lambda on: F.max(F.when(on, F.struct(at.alias("at"), F.col("source_kafka_timestamp").alias("src"), F.col("price").alias("price"))))["price"]
    both = valid.groupBy("product_id").agg(latest_of(F.col("is_snapshot")).alias("snapshot"), latest_of(~F.col("is_snapshot")).alias("history"))
    finding = F.when(F.col("history").isNull(), "missing_history").when(F.col("snapshot").isNull(), "missing_snapshot").when(F.col("snapshot") != F.col("history"), "price_mismatch")
    return both.select("product_id", finding.alias("finding")).filter("finding is not null")


# ------------------------------------------------------------ deletes and resets

_STONES = f"SELECT DISTINCT {star._id('kafka_key')} AS id, kafka_topic FROM raw_tombstone WHERE order_id IS NULL AND user_id IS NULL AND {star._id('kafka_key')} IS NOT NULL"


@query(
    f"WITH {_sql('o')}, {_sql('i')}, {_sql('r')}, g AS ({_STONES}), go AS (SELECT id FROM g WHERE kafka_topic = 'transactional.orders'), gi AS (SELECT id FROM g WHERE kafka_topic = 'transactional.order_items')"
    + """ SELECT 'order' AS entity, order_id AS record_id FROM o WHERE order_id NOT IN (SELECT id FROM go)
UNION ALL SELECT 'item', order_item_id FROM i WHERE coalesce(order_id, '') NOT IN (SELECT id FROM go) AND order_item_id NOT IN (SELECT id FROM gi)
UNION ALL SELECT 'return', return_refund_id FROM r WHERE coalesce(order_id, '') NOT IN (SELECT id FROM go) AND coalesce(order_item_id, '') NOT IN (SELECT id FROM gi)
  AND coalesce(order_item_id, '') NOT IN (SELECT order_item_id FROM i WHERE order_id IN (SELECT id FROM go))"""
)
def delete_cascade_three_levels(spark: SparkSession, d: str) -> DataFrame:
    """What stays after the tombstones: a deleted order takes its items and returns
    along, a deleted item its returns."""
    stones = star.tombstone_split(spark, d)
    gone = lambda topic, name: stones.filter(F.col("kafka_topic") == topic).select(F.col("deleted_key").alias(name))
    o, i, r = (latest(spark, d, n) for n in "oir")
    gone_orders = gone("transactional.orders", "order_id")
    gone_items = gone("transactional.order_items", "order_item_id").unionByName(i.join(gone_orders, "order_id", "left_semi").select("order_item_id")).distinct()
    kept = [
        ("order", versions.delete_keys(o, gone_orders, "order_id"), "order_id"),
        ("item", versions.delete_keys(i, gone_items, "order_item_id"), "order_item_id"),
        ("return", versions.delete_keys(versions.delete_keys(r, gone_items, "order_item_id"), gone_orders, "order_id"), "return_refund_id"),
    ]
    out = None
    for name, df, key in kept:
        part = df.select(F.lit(name).alias("entity"), F.col(key).alias("record_id"))
        out = part if out is None else out.unionByName(part)
    return out


@query(
    f"WITH {_sql('o')}, {_sql('u')}, g AS ({_STONES}), gu AS (SELECT DISTINCT user_sk FROM u WHERE user_id IN (SELECT id FROM g WHERE kafka_topic = 'transactional.users'))"
    + " SELECT order_id, CASE WHEN user_sk IN (SELECT user_sk FROM gu) THEN -1 ELSE user_sk END AS user_sk FROM o"
)
def orders_of_deleted_users(spark: SparkSession, d: str) -> DataFrame:
    """Orders of deleted users refer to the unknown user."""
    stones = star.tombstone_split(spark, d).filter("kafka_topic = 'transactional.users'").select(F.col("deleted_key").alias("user_id"))
    gone = latest(spark, d, "u").join(stones, "user_id", "left_semi").select("user_sk")
    o = latest(spark, d, "o").select("order_id", "user_sk")
    return versions.reset_reference(o, gone, "user_sk", {"user_sk": F.lit(-1).cast("bigint")})


# ------------------------------------------------------------ audits

_FOREIGN = (
    ("fact_order", "user_sk", "dim_user", "user_sk"), ("fact_order_item", "order_sk", "fact_order", "order_sk"), ("fact_order_item", "product_sk", "dim_product", "product_sk"),
    ("fact_return_refund", "order_sk", "fact_order", "order_sk"), ("fact_return_refund", "order_item_sk", "fact_order_item", "order_item_sk"),
)
_KEYS = (("dim_user", "user_sk"), ("dim_product", "product_sk"), ("fact_order", "order_sk"), ("fact_order_item", "order_item_sk"), ("fact_return_refund", "return_refund_sk"), ("fact_behavioral_event", "event_key"))


@query(
    " UNION ALL ".join(
        f"SELECT '{c}.{ck}' AS reference, count(*) AS n_orphan_keys, coalesce(sum(n), 0)::BIGINT AS n_orphan_rows FROM (SELECT {ck} AS k, count(*) AS n FROM {c} WHERE {ck} IS NOT NULL GROUP BY 1) WHERE k NOT IN (SELECT {pk} FROM {p} WHERE {pk} IS NOT NULL)"
        for c, ck, p, pk in _FOREIGN
    )
)
def foreign_key_audit(spark: SparkSession, d: str) -> DataFrame:
    """Distinct keys and rows of each reference that lead nowhere."""
    out = None
    for c, ck, p, pk in _FOREIGN:
        refs = table(spark, d, c, [ck]).filter(F.col(ck).isNotNull()).groupBy(F.col(ck).alias("k")).agg(F.count(F.lit(1)).alias("n"))
        lost = refs.join(table(spark, d, p, [pk]).select(F.col(pk).alias("k")).distinct(), "k", "left_anti")
        part = lost.agg(F.count(F.lit(1)).alias("n_orphan_keys"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_orphan_rows")).select(F.lit(f"{c}.{ck}").alias("reference"), "n_orphan_keys", "n_orphan_rows")
        out = part if out is None else out.unionByName(part)
    return out


@query(
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS n_rows, count({k}) AS n_with_key, count(DISTINCT {k}) AS n_keys, count(*) - count({k}) AS n_null_keys FROM {t}" for t, k in _KEYS
    )
)
def key_audit(spark: SparkSession, d: str) -> DataFrame:
    """Rows, keys and null keys of each table; equal rows and keys mean unique."""
    out = None
    for t, k in _KEYS:
        one = table(spark, d, t, [k]).groupBy(F.col(k).alias("k")).agg(F.count(F.lit(1)).alias("n"))
        held = F.when(F.col("k").isNotNull(), F.col("n")).otherwise(0)
        part = one.agg(F.sum("n").alias("n_rows"), F.sum(held).alias("n_with_key"), F.count("k").alias("n_keys")).select(
            F.lit(t).alias("table_name"), F.coalesce("n_rows", F.lit(0)).alias("n_rows"), F.coalesce("n_with_key", F.lit(0)).alias("n_with_key"), "n_keys",
            (F.coalesce("n_rows", F.lit(0)) - F.coalesce("n_with_key", F.lit(0))).alias("n_null_keys"),
        )
        out = part if out is None else out.unionByName(part)
    return out


@query(
    """WITH p AS (SELECT product_id, effective_from, effective_to, is_current, lead(effective_from) OVER (PARTITION BY product_id ORDER BY effective_from, effective_to NULLS LAST, is_current) AS nxt FROM dim_product WHERE product_id IS NOT NULL AND effective_from IS NOT NULL),
g AS (SELECT product_id, count(*) FILTER (WHERE is_current) AS cur, count(*) FILTER (WHERE is_current AND effective_to IS NOT NULL) AS cur_ended, count(*) FILTER (WHERE NOT is_current AND effective_to IS NULL) AS old_open, count(*) FILTER (WHERE nxt IS NOT NULL AND (effective_to IS NULL OR effective_to > nxt)) AS overlap FROM p GROUP BY 1)
SELECT unnest(['not_one_current', 'current_with_end', 'history_without_end', 'overlapping']) AS finding, unnest([count(*) FILTER (WHERE cur <> 1), count(*) FILTER (WHERE cur_ended > 0), count(*) FILTER (WHERE old_open > 0), count(*) FILTER (WHERE overlap > 0)]) AS n_products FROM g"""
)
def product_period_audit(spark: SparkSession, d: str) -> DataFrame:
    """Products whose periods, as delivered, break the rules of a history."""
    p = table(spark, d, "dim_product", ["product_id", "effective_from", "effective_to", "is_current"]).filter("product_id is not null and effective_from is not null")
    counted = p.groupBy("product_id").agg(
        F.count_if("is_current").alias("cur"), F.count_if(F.col("is_current") & F.col("effective_to").isNotNull()).alias("cur_ended"), F.count_if(~F.col("is_current") & F.col("effective_to").isNull()).alias("old_open")
    )
    over = versions.overlaps(p, "product_id", "effective_from", "effective_to").select("product_id").distinct().withColumn("overlap", F.lit(True))
    g = counted.join(over, "product_id", "left")
    found = {"not_one_current": F.col("cur") != 1, "current_with_end": F.col("cur_ended") > 0, "history_without_end": F.col("old_open") > 0, "overlapping": F.coalesce("overlap", F.lit(False))}
    m = g.agg(*[F.count_if(c).alias(k) for k, c in found.items()])
    return m.select(F.explode(F.array(*[F.struct(F.lit(k).alias("finding"), F.col(k).alias("n_products")) for k in found])).alias("f")).select("f.*")


@query(
    """WITH b AS (SELECT kafka_topic, kafka_partition, kafka_offset FROM fact_behavioral_event WHERE event_key IS NOT NULL), s AS (SELECT kafka_topic, kafka_partition, min(kafka_offset) AS a, max(kafka_offset) AS z, count(*) AS n, count(DISTINCT kafka_offset) AS u FROM b GROUP BY 1, 2)
SELECT kafka_topic, kafka_partition, n - u AS n_repeated, z - a + 1 - u AS n_missing, CASE WHEN z - a + 1 - u > 0 THEN 'FAIL' WHEN n > u THEN 'WARN' ELSE 'PASS' END AS verdict FROM s"""
)
def offset_completeness(spark: SparkSession, d: str) -> DataFrame:
    """Each partition's stored offsets against the range that the broker numbered:
    missing offsets fail, repeated ones warn."""
    s = audits.offset_summary(table(spark, d, "fact_behavioral_event", ["event_key", "kafka_topic", "kafka_partition", "kafka_offset"]).filter("event_key is not null"))
    missing, repeated = F.col("max_offset") - F.col("min_offset") + 1 - F.col("n_offsets"), F.col("n_rows") - F.col("n_offsets")
    verdict = F.when(missing > 0, "FAIL").when(repeated > 0, "WARN").otherwise("PASS")
    return s.select("kafka_topic", "kafka_partition", repeated.alias("n_repeated"), missing.alias("n_missing"), verdict.alias("verdict"))


_CHANGE_PAYLOAD = ["table_name", "record_key", "op", "commit_lsn", "payload_json"]


@query(
    f"""WITH k AS (SELECT kafka_topic, kafka_partition, kafka_offset, count(*) AS n, count(DISTINCT ({", ".join(_CHANGE_PAYLOAD)})) AS p, count(*) FILTER (WHERE coalesce(commit_timestamp, kafka_timestamp, ingested_at) IS NULL) AS u FROM raw_change GROUP BY 1, 2, 3)
SELECT kafka_topic, sum(n)::BIGINT AS n_rows, count(*) AS n_identities, count(*) FILTER (WHERE p > 1) AS n_conflicts, sum(u)::BIGINT AS n_untimed,
  CASE WHEN count(*) FILTER (WHERE p > 1) > 0 OR sum(u) > 0 THEN 'REVIEW_REQUIRED' ELSE 'PASS' END AS verdict FROM k GROUP BY 1"""
)
def change_source_report(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "raw_change", [*_CHANGE_PAYLOAD, "kafka_topic", "kafka_partition", "kafka_offset", "commit_timestamp", "kafka_timestamp", "ingested_at"])
    return audits.source_report(c, ["kafka_topic"], ["kafka_partition", "kafka_offset"], _CHANGE_PAYLOAD, ["commit_timestamp", "kafka_timestamp", "ingested_at"])


@query(
    f"""WITH {_sql('o')}, {_sql('i')}, {_sql('r')}, {_sql('u')}, sums AS (SELECT order_id, sum(item_total_amount) AS total FROM i GROUP BY 1),
vs AS (SELECT {star._id("product_id")} AS product_id, effective_from, effective_to FROM dim_product WHERE effective_from IS NOT NULL),
mt AS (SELECT i.order_item_id, count(vs.product_id) AS m FROM i LEFT JOIN (SELECT product_id, effective_from, max(effective_to) FILTER (WHERE effective_to IS NOT NULL) AS a, bool_or(effective_to IS NULL) AS open FROM vs GROUP BY 1, 2) vs
  ON i.product_id = vs.product_id AND i.order_timestamp >= vs.effective_from AND (vs.open OR i.order_timestamp < vs.a) GROUP BY 1),
x AS (SELECT
  (SELECT count(*) FROM o WHERE order_id NOT IN (SELECT order_id FROM i WHERE order_id IS NOT NULL)) AS orders_without_items,
  (SELECT count(*) FROM i WHERE order_id IS NULL OR order_id NOT IN (SELECT order_id FROM o)) AS items_without_order,
  (SELECT count(*) FROM r WHERE order_item_id IS NULL OR order_item_id NOT IN (SELECT order_item_id FROM i)) AS returns_without_item,
  (SELECT count(*) FROM o WHERE user_sk IS NULL OR user_sk NOT IN (SELECT user_sk FROM u)) AS orders_without_user,
  (SELECT count(*) FROM o JOIN sums USING (order_id) WHERE abs(order_total - total) > 0.01) AS totals_that_differ,
  (SELECT count(*) FROM r JOIN i USING (order_item_id) WHERE r.order_id <> i.order_id) AS returns_of_another_order,
  (SELECT count(*) FROM r JOIN i USING (order_item_id) WHERE r.return_timestamp < i.order_timestamp) AS returns_before_order,
  (SELECT count(*) FROM mt WHERE m = 0) AS items_without_version, (SELECT count(*) FROM mt WHERE m > 1) AS items_with_several_versions,
  (SELECT count(*) FROM i JOIN o USING (order_id) WHERE i.order_timestamp IS DISTINCT FROM o.order_timestamp) AS item_times_that_differ)
UNPIVOT x ON COLUMNS(*) INTO NAME finding VALUE n_rows""".replace("UNPIVOT x", "SELECT * FROM (UNPIVOT x").rstrip() + ")"
)
def order_relationship_audit(spark: SparkSession, d: str) -> DataFrame:
    """Ten checks between orders, items, returns, users and product versions."""
    o, i, r, u = (latest(spark, d, n) for n in "oiru")
    by_order = i.groupBy("order_id").agg(F.count(F.lit(1)).alias("n"), F.sum("item_total_amount").alias("total"))
    known = u.select(F.col("user_sk").alias("known"))
    oo = o.join(by_order, "order_id", "left").join(known, F.col("user_sk") == F.col("known"), "left")
    a = oo.agg(
        F.count_if(F.col("n").isNull()).alias("orders_without_items"), F.count_if(F.col("known").isNull()).alias("orders_without_user"),
        F.count_if(F.abs(F.col("order_total") - F.col("total")) > F.lit("0.01").cast("decimal(10,2)")).alias("totals_that_differ"),
    )
    parents = o.select(F.col("order_id").alias("parent"), F.col("order_timestamp").alias("ordered"))
    b = i.join(parents, F.col("order_id") == F.col("parent"), "left").agg(
        F.count_if(F.col("parent").isNull()).alias("items_without_order"), F.count_if(F.col("parent").isNotNull() & ~F.col("ordered").eqNullSafe(F.col("order_timestamp"))).alias("item_times_that_differ")
    )
    items = i.select(F.col("order_item_id").alias("item"), F.col("order_id").alias("item_order"), F.col("order_timestamp").alias("ordered"))
    c = r.join(items, F.col("order_item_id") == F.col("item"), "left").agg(
        F.count_if(F.col("item").isNull()).alias("returns_without_item"), F.count_if(F.col("order_id") != F.col("item_order")).alias("returns_of_another_order"),
        F.count_if(F.col("return_timestamp") < F.col("ordered")).alias("returns_before_order"),
    )
    v = table(spark, d, "dim_product", ["product_id", "effective_from", "effective_to"]).filter("effective_from is not null").groupBy(norm_id("product_id").alias("product_id"), "effective_from")
    v = v.agg(F.max("effective_to").alias("stop"), F.bool_or(F.col("effective_to").isNull()).alias("open")).withColumn("stop", F.when(~F.col("open"), F.col("stop"))).drop("open")
    matches = versions.matches_at(i.select("order_item_id", "product_id", "order_timestamp"), v, "product_id", "order_timestamp", "effective_from", "stop")
    e = matches.agg(F.count_if(F.col("matches") == 0).alias("items_without_version"), F.count_if(F.col("matches") > 1).alias("items_with_several_versions"))
    out = None
    for m in (a, b, c, e):
        part = m.select(F.explode(F.array(*[F.struct(F.lit(k).alias("finding"), F.col(k).alias("n_rows")) for k in m.columns])).alias("f")).select("f.*")
        out = part if out is None else out.unionByName(part)
    return out


# ------------------------------------------------------------ facts as loaded


def _reasons_sql(name: str) -> str:
    """The registered validation's SQL, as a subquery by key."""
    return star.ORACLES[name]


@query(
    f"WITH {_sql('o')}, ok AS (SELECT order_id FROM ({_reasons_sql('order_validation')}) WHERE reason = ''), us AS (SELECT DISTINCT user_sk FROM dim_user WHERE user_sk IS NOT NULL)"
    + """ SELECT o.order_id, coalesce(us.user_sk, -1) AS user_sk, strftime(order_timestamp AT TIME ZONE 'UTC', '%Y%m%d')::INT AS order_date_sk, epoch_us(order_timestamp) AS order_us, order_total::DOUBLE AS order_total, status, payment_method,
  epoch_us(source_kafka_timestamp) AS source_us FROM o JOIN ok USING (order_id) LEFT JOIN us ON o.user_sk = us.user_sk"""
)
def fact_order(spark: SparkSession, d: str) -> DataFrame:
    """Valid orders with their user, the unknown one where it isn't there."""
    valid, _ = quality.split_valid(star._orders(spark, d), star._order_rules())
    users = table(spark, d, "dim_user", ["user_sk"]).filter("user_sk is not null").distinct()
    return with_member(valid, users, "user_sk", -1).select(
        "order_id", "user_sk", date_sk(F.col("order_timestamp")).alias("order_date_sk"), F.unix_micros("order_timestamp").alias("order_us"), F.col("order_total").cast("double").alias("order_total"),
        "status", "payment_method", F.unix_micros("source_kafka_timestamp").alias("source_us"),
    )


_ITEM_FACT = """, ok AS (SELECT order_item_id FROM ({reasons}) WHERE reason = ''),
vv AS (SELECT {pid} AS product_id, effective_from, effective_to, product_sk FROM dim_product WHERE effective_from IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY {pid}, effective_from ORDER BY effective_to DESC NULLS FIRST, product_sk DESC) = 1),
jj AS (SELECT i.*, CASE WHEN vv.product_sk IS NOT NULL AND (vv.effective_to IS NULL OR vv.effective_to > i.order_timestamp) THEN vv.product_sk END AS sk FROM i ASOF LEFT JOIN vv ON i.product_id = vv.product_id AND i.order_timestamp >= vv.effective_from)
SELECT jj.order_item_id, jj.order_id, jj.product_id, coalesce(sk, 0) AS product_sk, CASE WHEN sk IS NULL THEN 'unknown_product' ELSE 'temporal' END AS product_resolution, quantity, unit_price::DOUBLE AS unit_price,
  item_total_amount::DOUBLE AS item_total_amount, epoch_us(order_timestamp) AS order_us FROM jj JOIN ok USING (order_item_id)""".format(reasons=_reasons_sql("item_rules_and_parent"), pid=star._id("product_id"))


@query("WITH " + star._ITEMS + _ITEM_FACT)
def fact_order_item(spark: SparkSession, d: str) -> DataFrame:
    """Valid items with the product version in force at their time and how it was
    resolved; the unknown product where none was."""
    i = star._judged_items(spark, d).filter("reason = ''").select(
        "order_item_id", "order_id", "product_id", "quantity", F.col("unit_price").cast("double").alias("unit_price"), F.col("item_total_amount").cast("double").alias("item_total_amount"),
        F.unix_micros("order_timestamp").alias("at_us"), F.col("product_id").alias("entity"),
    )
    v = table(spark, d, "dim_product", ["product_id", "product_sk", "effective_from", "effective_to"]).select(
        norm_id("product_id").alias("entity"), F.unix_micros("effective_from").alias("start_us"), F.unix_micros("effective_to").alias("stop_us"), F.col("product_sk").alias("version_id")
    )
    j = asof.asof_versions(i, v, [])
    held = F.col("version_id").isNotNull() & (F.col("stop_us").isNull() | (F.col("stop_us") > F.col("at_us")))
    return j.select(
        "order_item_id", "order_id", "product_id", F.when(held, F.col("version_id")).otherwise(F.lit(0).cast("bigint")).alias("product_sk"), F.when(held, "temporal").otherwise("unknown_product").alias("product_resolution"),
        "quantity", "unit_price", "item_total_amount", F.col("at_us").alias("order_us"),
    )


@query(
    "WITH " + star._RETURNS + f", ok AS (SELECT return_refund_id FROM ({_reasons_sql('return_relationships')}) WHERE reason = '')"
    + """ SELECT return_refund_id, order_id, order_item_id, strftime(return_timestamp AT TIME ZONE 'UTC', '%Y%m%d')::INT AS return_date_sk, epoch_us(return_timestamp) AS return_us, refund_amount::DOUBLE AS refund_amount, return_reason
FROM r JOIN ok USING (return_refund_id)"""
)
def fact_return_refund(spark: SparkSession, d: str) -> DataFrame:
    """Valid returns of items that are there, of the same order and not before it."""
    r = star._judged_returns(spark, d).filter("reason = ''")
    return r.select(
        "return_refund_id", "order_id", "order_item_id", date_sk(F.col("return_timestamp")).alias("return_date_sk"), F.unix_micros("return_timestamp").alias("return_us"),
        F.col("refund_amount").cast("double").alias("refund_amount"), "return_reason",
    )


_LEDGER = (("fact_order", "order_validation"), ("fact_order_item", "item_rules_and_parent"), ("fact_return_refund", "return_relationships"), ("dim_user", "users_rejected"))


@query(
    "SELECT table_name, reason, count(*) AS n_rows FROM ("
    + " UNION ALL ".join(f"SELECT '{t}' AS table_name, unnest(string_split(reason, '; ')) AS reason FROM ({_reasons_sql(q)}) WHERE reason <> ''" for t, q in _LEDGER)
    + ") GROUP BY 1, 2"
)
def rejection_reasons(spark: SparkSession, d: str) -> DataFrame:
    """How often each reason was given, by table; a row with several counts for each."""
    out = None
    for t, q in _LEDGER:
        bad = star.QUERIES[q](spark, d).filter("reason <> ''")
        part = bad.select(F.explode(F.split("reason", "; ")).alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(t).alias("table_name"), "reason", "n_rows")
        out = part if out is None else out.unionByName(part)
    return out
