"""Retail jobs: cleaned tables, customer segments and the analytic tables on them."""

from __future__ import annotations

import datetime as dt
import decimal
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import ladders as L
from ..functions.scalar import (
    cast_columns,
    default_if_blank,
    is_night,
    is_weekday_evening,
    is_weekend,
    rate,
)
from ..operators.filters import flag
from ..operators.joins import enrich
from ..operators.skew import skew_safe_join
from ..operators.windows import dedup_latest, first_event_flag, first_last_growth
from ..operators.aggregates import index_to_mean

# fixed values: columns of the cleaned tables, and the types that are not text
USER_COLS = (
    "user_id", "name", "gender", "birth_date", "pref", "phone_number", "email",
    "email_permission_flg", "registration_date", "status", "last_login_at",
)
USER_TYPES = {
    "birth_date": "date", "registration_date": "date", "email_permission_flg": "boolean",
    "last_login_at": "timestamp",
}
ITEM_COLS = (
    "item_id", "category_id", "item_name", "category_name", "price", "expiration_date", "arrival_date",
    "is_organic", "is_discount_target", "is_ready_to_eat", "is_premium",
)
ITEM_TYPES = {
    "item_id": "bigint", "category_id": "bigint", "price": "bigint", "expiration_date": "date",
    "arrival_date": "date", "is_organic": "boolean", "is_discount_target": "boolean",
    "is_ready_to_eat": "boolean", "is_premium": "boolean",
}
STORE_COLS = (
    "store_id", "store_name", "store_area", "address", "postal_code", "prefecture", "city", "phone_number",
    "email", "business_hours", "closed_days", "manager_id", "opening_date", "status",
)
STORE_TYPES = {"store_id": "bigint", "manager_id": "bigint", "opening_date": "date"}
ORDER_TYPES = {
    "order_id": "bigint", "store_id": "bigint", "total_amount": "bigint", "total_quantity": "int",
    "order_datetime": "timestamp",
}
LINE_TYPES = {
    "order_item_id": "bigint", "order_id": "bigint", "store_id": "bigint", "item_id": "bigint",
    "category_id": "bigint", "quantity": "int", "unit_price": "bigint", "subtotal": "bigint",
    "cancel_flg": "boolean", "order_datetime": "timestamp",
}
UNKNOWN_PREF = "不明"
#: alcohol, sweets and confectionery
FAVOURITE_CATEGORIES = (1100, 600, 1200)

ITEM_REF = ("item_name", "category_name", "is_organic", "is_discount_target", "is_ready_to_eat", "is_premium")
STORE_REF = ("store_name", "store_area")


# --- cleaned tables ---------------------------------------------------------------

def silver_users(raw: DataFrame, types: Mapping[str, str] = USER_TYPES) -> DataFrame:
    typed = cast_columns(raw, types)
    return typed.withColumn("pref", default_if_blank("pref", UNKNOWN_PREF)).select(*USER_COLS)


def silver_items(raw: DataFrame, types: Mapping[str, str] = ITEM_TYPES) -> DataFrame:
    return cast_columns(raw, types).select(*ITEM_COLS)


def silver_stores(raw: DataFrame, types: Mapping[str, str] = STORE_TYPES) -> DataFrame:
    return cast_columns(raw, types).select(*STORE_COLS)


def silver_orders(raw: DataFrame, stores: DataFrame, types: Mapping[str, str] = ORDER_TYPES) -> DataFrame:
    """Typed orders with the name and area of their store."""
    return enrich(cast_columns(raw, types), stores, "store_id", STORE_REF).select(
        "order_id", "user_id", "store_id", *STORE_REF, "order_datetime", "total_amount", "total_quantity",
        "order_status",
    )


def silver_order_items(
    raw: DataFrame,
    items: DataFrame,
    stores: DataFrame,
    latest: Sequence[str] = ("_ingested_at",),
    types: Mapping[str, str] = LINE_TYPES,
) -> DataFrame:
    """Typed order lines, one per id (the latest), with item and store attributes.

    Lines are cast first and ranked in one window, so they are computed and shuffled once
    for it, as typed rows instead of text.
    """
    once = dedup_latest(cast_columns(raw, types), ["order_item_id"], latest)
    wide = enrich(enrich(once, items, "item_id", ITEM_REF), stores, "store_id", STORE_REF)
    return wide.select(
        "order_item_id", "user_id", "order_id", "store_id", *STORE_REF, "item_id", "category_id", *ITEM_REF,
        "quantity", "unit_price", "subtotal", "cancel_flg", "order_datetime",
    )


# --- segments ------------------------------------------------------------------------

def rfm_measures(as_of: dt.date, unique: bool = False) -> dict[str, Column]:
    """``unique``: an order id stands in one row, so rows are counted."""
    last = F.max(F.to_date("order_datetime"))
    return {
        "last_purchase_date": last,
        "frequency": F.count("order_id") if unique else F.count_distinct("order_id"),
        "monetary": F.sum("total_amount"),
        "recency": F.datediff(F.lit(as_of), last),
    }


def rfm_base(orders: DataFrame, as_of: dt.date) -> DataFrame:
    """Last purchase, distinct orders, amount and days since, per user."""
    return orders.groupBy("user_id").agg(*[c.alias(n) for n, c in rfm_measures(as_of).items()])


def with_scores(rfm: DataFrame, limits: L.RfmLimits = L.RfmLimits()) -> DataFrame:
    return (
        rfm.withColumns(L.rfm_score_columns(limits))
        .withColumn("rfm_segment", L.rfm_segment())
        .withColumn("customer_type", L.customer_type())
    )


def rfm(orders: DataFrame, as_of: dt.date, limits: L.RfmLimits = L.RfmLimits()) -> DataFrame:
    return with_scores(rfm_base(orders, as_of), limits)


def order_flags() -> dict[str, Column]:
    return {
        "weekend": is_weekend("order_datetime"),
        "weekday_evening": is_weekday_evening("order_datetime"),
        "night": is_night("order_datetime"),
    }


def order_measures() -> list[Column]:
    return [
        F.count("*").alias("total_orders"),
        *[F.sum(flag(p)).alias(f"{n}_orders") for n, p in order_flags().items()],
        F.sum("total_quantity").alias("total_items"),
    ]


def with_order_rates(counted: DataFrame) -> DataFrame:
    rates = {f"{n}_rate": rate(f"{n}_orders", "total_orders") for n in order_flags()}
    return counted.withColumns({**rates, "avg_basket_size": rate("total_items", "total_orders")})


def order_stats(orders: DataFrame) -> DataFrame:
    """When a user buys: counts and shares of weekend, evening and night orders, and
    the quantity per order."""
    return with_order_rates(orders.groupBy("user_id").agg(*order_measures()))


def item_stats(lines: DataFrame, favourites: Sequence = FAVOURITE_CATEGORIES) -> DataFrame:
    """What a user buys: shares of lines by item property."""
    flags = {
        "favourite": F.col("category_id").isin(list(favourites)),
        "organic_premium": F.col("is_organic") | F.col("is_premium"),
        "discount": F.col("is_discount_target"),
        "ready_to_eat": F.col("is_ready_to_eat"),
    }
    counted = lines.groupBy("user_id").agg(
        F.count("*").alias("total_items_purchased"), *[F.sum(flag(p)).alias(f"{n}_items") for n, p in flags.items()]
    )
    return counted.withColumns({f"{n}_rate": rate(f"{n}_items", "total_items_purchased") for n in flags})


def user_clusters(orders: DataFrame, lines: DataFrame, favourites: Sequence = FAVOURITE_CATEGORIES,
                  limits: L.ClusterLimits = L.ClusterLimits()) -> DataFrame:
    """Behaviour cluster of every user with orders."""
    joined = order_stats(orders).join(item_stats(lines, favourites), "user_id", "left")
    return joined.select("user_id", L.behavior_cluster(limits).alias("behavior_cluster"))


def first_order_flags(orders: DataFrame, users: DataFrame, days: int = 30) -> DataFrame:
    """(order_id, is_first_order) for every order."""
    return first_event_flag(orders, users, "user_id", "order_id", "order_datetime", "registration_date", days)


def user_segments(
    orders: DataFrame,
    lines: DataFrame,
    as_of: dt.date,
    favourites: Sequence = FAVOURITE_CATEGORIES,
    rfm_limits: L.RfmLimits = L.RfmLimits(),
    cluster_limits: L.ClusterLimits = L.ClusterLimits(),
) -> DataFrame:
    """One row per user with orders: scores, segment, cluster and first order.

    ``orders`` has one row per order id (a whole number from zero up); see
    :func:`check_orders`.  All measures are one hash aggregation over one scan: the first
    order is the minimum of one number made of its time and id.  Order lines are reduced
    to one row per user too.
    """
    per_user = orders.groupBy("user_id").agg(
        *[c.alias(n) for n, c in rfm_measures(as_of, unique=True).items()], *order_measures(),
        F.min(F.unix_micros(F.col("order_datetime").cast("timestamp")) * F.lit(ID_SPAN) + F.col("order_id")).alias("__first"),
    )
    joined = with_order_rates(with_scores(per_user, rfm_limits)).join(item_stats(lines, favourites), "user_id", "left")
    first_id = F.pmod("__first", F.lit(ID_SPAN))
    first_time = F.timestamp_micros(((F.col("__first") - first_id) / F.lit(ID_SPAN)).cast("long"))
    code = L.behavior_cluster(cluster_limits)
    return joined.select(
        "user_id",
        "last_purchase_date", "recency", "frequency", "monetary", "r_score", "f_score", "m_score",
        "rfm_segment", "customer_type",
        code.alias("behavior_cluster"),
        L.cluster_name(code).alias("behavior_cluster_name"),
        first_id.cast("long").alias("first_order_id"),
        F.to_date(first_time).alias("first_order_date"),
    )


#: one more than the largest order id, as a decimal that leaves room for a time beside it
ID_SPAN = decimal.Decimal(10) ** 19


def check_orders(orders: DataFrame) -> None:
    """Raise unless every order id is present once, as the segments assume."""
    bad = orders.groupBy("order_id").agg(F.count("*").alias("n")).filter("n > 1 OR order_id IS NULL OR order_id < 0")
    if not bad.isEmpty():
        raise ValueError("order ids are missing, negative or repeated")


# --- analytic tables ---------------------------------------------------------------------

def order_calendar() -> dict[str, Column]:
    ts = F.col("order_datetime")
    return {
        "order_date": F.to_date(ts),
        "order_hour": F.hour(ts),
        "order_dayofweek": F.dayofweek(ts),
        "is_weekend": is_weekend(ts),
    }


SCORE_COLS = ("r_score", "f_score", "m_score", "rfm_segment")
CLUSTER_COLS = ("behavior_cluster", "behavior_cluster_name")


def gold_users(users: DataFrame, segments: DataFrame) -> DataFrame:
    """Every user with cluster, scores and segment; those without orders have none."""
    kept = segments.drop("first_order_id", "first_order_date", "behavior_cluster_name")
    return users.join(kept, "user_id", "left").select(
        *[c for c in USER_COLS if c in users.columns],
        "behavior_cluster",
        L.cluster_name().alias("behavior_cluster_name"),
        "last_purchase_date", "recency", "frequency", "monetary", *SCORE_COLS, "customer_type",
    )


def gold_orders(orders: DataFrame, users: DataFrame, segments: DataFrame, days: int = 30) -> DataFrame:
    """Every order with calendar columns, the segments of its user and whether it is
    the first order of a newly registered user.

    The first order travels with the user's segment row, so this takes one join per
    order row.
    """
    new_user = F.datediff("first_order_date", "registration_date") <= days
    profile = segments.join(users.select("user_id", "registration_date"), "user_id", "left").select(
        "user_id", "behavior_cluster", *SCORE_COLS, F.when(new_user, F.col("first_order_id")).alias("__first")
    )
    first = F.when(
        F.col("order_id").isNotNull(), F.coalesce(F.col("order_id") == F.col("__first"), F.lit(False))
    )
    return (
        skew_safe_join(orders, profile, ["user_id"], "left")
        .withColumns(order_calendar())
        .withColumn("is_first_order", first)
        .select(
            "order_id", "user_id", "store_id", *STORE_REF, "order_datetime", *order_calendar(),
            "total_amount", "total_quantity", "order_status", "behavior_cluster",
            L.cluster_name().alias("behavior_cluster_name"), *SCORE_COLS, "is_first_order",
            L.order_customer_type().alias("customer_type"),
        )
    )


def gold_order_items(
    lines: DataFrame,
    orders: DataFrame,
    users: DataFrame,
    segments: DataFrame,
    days: int = 30,
    dims: Sequence[tuple[DataFrame, str, Sequence[str]]] = (),
    derived: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Every order line with calendar columns, its user's segments and the flag of its
    order; a line without an order has no flag.

    Orders, few beside their lines, get the segments of their user and say whether they are
    first, so a line needs one join for both.  Only lines whose user is not that of their
    order are joined to the segments themselves.  ``dims`` are tables of attributes that
    lines do not hold yet (table, key, columns) and ``derived`` columns computed from
    theirs; they come last, so that narrow rows are moved.
    """
    new_user = F.datediff("first_order_date", "registration_date") <= days
    firsts = segments.join(users.select("user_id", "registration_date"), "user_id").filter(new_user)
    firsts = firsts.select(F.col("first_order_id").alias("order_id"), F.lit(True).alias("__first"))
    profile = segments.select("user_id", "behavior_cluster", *SCORE_COLS)
    heads = skew_safe_join(orders.select("order_id", "user_id"), profile, ["user_id"], "left")
    heads = heads.withColumnRenamed("user_id", "__user").join(firsts, "order_id", "left")
    heads = heads.withColumn("is_first_order", F.coalesce("__first", F.lit(False))).drop("__first")
    found = lines.join(heads, "order_id", "left")
    own = F.col("user_id").eqNullSafe(F.col("__user"))
    others = found.filter(~own).drop("behavior_cluster", *SCORE_COLS)
    joined = found.filter(own).unionByName(skew_safe_join(others, profile, ["user_id"], "left"))
    for table, key, cols in dims:
        joined = enrich(joined, table, key, cols)
    return (
        joined.withColumns({**(derived or {}), **order_calendar()})
        .select(
            "order_item_id", "order_id", "user_id", "store_id", *STORE_REF, "item_id", "item_name",
            "category_id", "category_name", "is_organic", "is_discount_target", "is_ready_to_eat",
            "is_premium", "quantity", "unit_price", "subtotal", "cancel_flg", "order_datetime",
            *order_calendar(), "behavior_cluster", L.cluster_name().alias("behavior_cluster_name"),
            *SCORE_COLS, "is_first_order", L.order_customer_type().alias("customer_type"),
        )
    )


def write_gold(
    spark: SparkSession, users: DataFrame, orders: DataFrame, lines: DataFrame, out: str, as_of: dt.date,
    favourites: Sequence = FAVOURITE_CATEGORIES,
) -> None:
    """Write the three analytic tables.

    The segments are written once and read back by all three, so a lost executor does
    not cost their recomputation.
    """
    check_orders(orders)
    user_segments(orders, lines, as_of, favourites).write.mode("overwrite").parquet(f"{out}/user_segments")
    segments = spark.read.parquet(f"{out}/user_segments")
    gold_users(users, segments).write.mode("overwrite").parquet(f"{out}/gd_users")
    gold_orders(orders, users, segments).write.mode("overwrite").parquet(f"{out}/gd_orders")
    gold_order_items(lines, orders, users, segments).write.mode("overwrite").parquet(f"{out}/gd_order_items")


# --- trends --------------------------------------------------------------------------------

def sales_by_period(orders: DataFrame, period: Column, name: str) -> DataFrame:
    """Sales, orders and distinct customers per period."""
    return orders.groupBy(period.alias(name)).agg(
        F.sum("total_amount").cast("double").alias("total_sales"),
        F.count("order_id").alias("order_count"),
        F.count_distinct("user_id").alias("unique_customers"),
    )


def sales_growth(yearly: DataFrame, period: str = "order_year") -> DataFrame:
    """First and last year and the multiple between them."""
    return first_last_growth(yearly, period, "total_sales")


def new_customer_share(orders: DataFrame, users: DataFrame, period: Column, name: str, days: int = 30) -> DataFrame:
    """Share of orders that are the first of a newly registered user, per period.

    Only one order per user can count, so the flagged orders are aggregated on their
    own and joined per period; the orders themselves are never joined.
    """
    first = orders.groupBy("user_id").agg(F.min(F.struct("order_datetime", "order_id")).alias("f"))
    new = (
        first.join(users.select("user_id", "registration_date"), "user_id")
        .select(F.col("f.order_datetime").alias("order_datetime"), "registration_date")
        .filter(F.datediff(F.to_date("order_datetime"), "registration_date") <= days)
        .groupBy(period.alias(name))
        .agg(F.count("*").alias("new_orders"))
    )
    total = orders.groupBy(period.alias(name)).agg(F.count("order_id").alias("total_orders"))
    joined = total.join(new, name, "left")
    count = F.coalesce("new_orders", F.lit(0))
    return joined.select(
        name, "total_orders", count.alias("new_orders"), (rate(count, "total_orders") * 100.0).alias("new_ratio_pct")
    )


def seasonality(orders: DataFrame) -> DataFrame:
    """Sales per calendar month over all years, relative to the mean month."""
    monthly = orders.groupBy(F.month("order_datetime").alias("order_month")).agg(
        F.sum("total_amount").alias("total_sales")
    )
    return index_to_mean(monthly, "total_sales", "ratio").withColumn("total_sales", F.col("total_sales").cast("double"))


def churn_report(orders: DataFrame, clusters: DataFrame, as_of: dt.date) -> DataFrame:
    """Users per cluster and recency band, with the mean days since the last order."""
    last = orders.groupBy("user_id").agg(F.datediff(F.lit(as_of), F.to_date(F.max("order_datetime"))).alias("days"))
    return (
        last.join(clusters, "user_id", "left")
        .groupBy("behavior_cluster", L.churn_band("days", "behavior_cluster").alias("band"))
        .agg(F.count("*").alias("users"), F.avg("days").alias("mean_days"))
    )
