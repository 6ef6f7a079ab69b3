"""Campaign and call-centre jobs: the order fact with its customer's channel and call,
the customer journey, channel performance and the reports on them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ladders import age_group5, ladder, resolution_group
from ..functions.scalar import month_start, rate, to_date_safe, to_timestamp_safe, week_start
from ..operators.aggregates import ever, flag_rate, mean, with_share
from ..operators.filters import apply_filters, flag
from ..operators.skew import skew_safe_join
from ..operators.text import TRANSCRIPT_RULES, COMPETITOR_PATTERN, FieldRules, extract_fields, summarize
from ..operators.topk import top_k
from ..operators.windows import first_row, mode_by, modes

# fixed values: labels the reports look for
DIRECT = "直接"
NO_CHANNEL = "なし"
DISCOUNT_TROUBLE = "割引条件"
RETURN_DISCOUNT, RETURN_SIZE, RETURN_IMAGE = "割引条件違い", "サイズ不一致", "イメージ違い"
URGENT = "高"
URGENCY_ORDER = ("高", "中")
RESOLVED = "解決"

CALL_FIELDS = (
    "purpose", "urgency_level", "trouble_type", "competitor_mention", "next_intent", "resolution_status", "operator_action",
)


# --- calls ---------------------------------------------------------------------------

def bronze_calls(raw: DataFrame) -> DataFrame:
    """Call log with the time stamp split into date and time of day."""
    ts = to_timestamp_safe("call_datetime")
    renamed = raw.withColumnsRenamed(
        {"customer_age": "age", "customer_gender": "gender", "customer_prefecture": "prefecture"}
    )
    rest = [c for c in renamed.columns if c not in ("call_id", "call_datetime")]
    return renamed.select(
        "call_id", to_date_safe("call_datetime").alias("call_date"),
        F.date_format(ts, "HH:mm:ss").alias("call_time"), *rest,
    )


def call_analysis(
    calls: DataFrame,
    rules: FieldRules = TRANSCRIPT_RULES,
    competitor: str = COMPETITOR_PATTERN,
    keep: Sequence[str] = ("call_id", "customer_id", "call_date", "call_duration_sec", "transcript"),
    summary: Column | None = None,
) -> DataFrame:
    """Calls with the fields extracted from their transcript and a short summary."""
    fields = extract_fields(calls, "transcript", rules, competitor)
    names = [*rules, "competitor_mention", "operator_action"]
    return fields.select(
        *keep,
        *[F.col(f"extracted.{n}").alias(n) for n in names],
        (summarize("transcript") if summary is None else summary).alias("transcript_summary"),
    )


def call_overview(calls: DataFrame, duration: str = "call_duration_sec", text: str = "transcript") -> DataFrame:
    return calls.agg(
        F.count("*").alias("total_calls"),
        F.min("call_date").alias("earliest_call"),
        F.max("call_date").alias("latest_call"),
        F.round(mean(duration), 0).alias("avg_duration_sec"),
        F.count_distinct("customer_id").alias("unique_customers"),
        F.round(F.avg(F.length(text)), 0).alias("avg_transcript_length"),
    )


def call_list(analysis: DataFrame, filters: Mapping[str, Sequence[Any] | None] | None = None) -> DataFrame:
    """Calls, newest first, under up to four multi-select filters."""
    return (
        apply_filters(analysis, one_of=filters)
        .select("call_date", "call_id", "purpose", "trouble_type", "urgency_level", "resolution_status", "transcript_summary")
        .orderBy(F.col("call_date").desc(), "call_id")
    )


# --- the order fact -------------------------------------------------------------------

def primary_channel(exposures: DataFrame) -> DataFrame:
    """Most frequent campaign channel per customer."""
    return mode_by(exposures, ["customer_id"], "channel", "primary_channel")


def customer_profile(customers: DataFrame, exposures: DataFrame, calls: DataFrame, geo: DataFrame, place: str) -> DataFrame:
    """One row per customer: place, main channel and first call."""
    first_call = first_row(calls, ["customer_id"], [F.col("call_id").asc()]).select(
        "customer_id", "call_id", *[F.col(c).alias("call_purpose" if c == "purpose" else c) for c in CALL_FIELDS]
    )
    return (
        customers.join(geo, place, "left")
        .join(primary_channel(exposures), "customer_id", "left")
        .join(first_call, "customer_id", "left")
    )


def dashboard_fact(
    orders: DataFrame, customers: DataFrame, exposures: DataFrame, calls: DataFrame, geo: DataFrame,
    place: str = "prefecture",
) -> DataFrame:
    """Every order with its customer, the customer's place, main channel and first call.

    All customer attributes are joined per customer first, so an order row takes part
    in a single join.
    """
    profile = customer_profile(customers, exposures, calls, geo, place)
    c = F.col
    return skew_safe_join(orders, profile, ["customer_id"], "inner").select(
        "order_id", "order_date",
        month_start("order_date").alias("order_month"),
        week_start("order_date").alias("order_week"),
        F.dayofweek("order_date").alias("order_dow"),
        "product_category", "product_name", "size", "unit_price", "order_channel", "quantity", "discount_applied", "total_amount", "returned",
        "return_reason", "customer_id", "customer_name", "age", age_group5("age").alias("age_group"), "gender",
        place, "customer_segment", "preferred_channel", "latitude", "longitude",
        F.coalesce("primary_channel", F.lit(DIRECT)).alias("campaign_channel"),
        "call_id", "call_purpose", "urgency_level", "trouble_type", "competitor_mention", "next_intent",
        "resolution_status", "operator_action",
        flag(c("trouble_type") == DISCOUNT_TROUBLE).alias("has_discount_trouble"),
        flag(c("competitor_mention")).alias("has_competitor_mention"),
    )


# --- customer journey -------------------------------------------------------------------

def order_summary_by_customer(orders: DataFrame) -> DataFrame:
    """Sums, the first return reason and the most frequent category; one row per order id."""
    sums = orders.groupBy("customer_id").agg(
        F.count("order_id").alias("order_count"),
        F.sum("total_amount").cast("double").alias("total_spend"),
        mean("total_amount").alias("avg_order_amount"),
        mean("discount_applied").alias("avg_discount"),
        F.sum(flag(F.col("returned"))).alias("return_count"),
        flag_rate(F.col("returned")).alias("return_rate"),
    )
    reasons = first_row(
        orders.filter("return_reason IS NOT NULL"), ["customer_id"], [F.col("order_date").asc_nulls_first(), F.col("order_id").asc_nulls_first()]
    ).select("customer_id", F.col("return_reason").alias("primary_return_reason"))
    return sums.join(reasons, "customer_id", "left").join(
        modes(orders, "customer_id", {"product_category": "top_category"}), "customer_id", "left"
    )


def exposure_summary_by_customer(exposures: DataFrame) -> DataFrame:
    """Sums and the most frequent channel; one row per exposure id."""
    sums = exposures.groupBy("customer_id").agg(
        F.count("exposure_id").alias("exposure_count"),
        F.sum(flag(F.col("clicked"))).alias("click_count"),
        F.sum(flag(F.col("converted"))).alias("conversion_count"),
        flag_rate(F.col("clicked")).alias("click_rate"),
    )
    return sums.join(modes(exposures, "customer_id", {"channel": "primary_exposure_channel"}), "customer_id", "left")


def call_summary_by_customer(calls: DataFrame) -> DataFrame:
    """Sums, the most frequent labels and the latest intent; one row per call id."""
    c = F.col
    sums = calls.groupBy("customer_id").agg(
        F.count("call_id").alias("call_count"),
        mean("call_duration_sec").alias("avg_call_duration"),
        ever(c("competitor_mention")).alias("had_competitor_mention"),
        ever(c("trouble_type") == DISCOUNT_TROUBLE).alias("had_discount_trouble"),
        ever(c("urgency_level") == URGENT).alias("had_urgency_call"),
        flag_rate(c("resolution_status") == RESOLVED).alias("resolution_rate"),
    )
    labels = {"purpose": "primary_call_purpose", "trouble_type": "primary_trouble_type", "urgency_level": "primary_urgency_level"}
    latest = first_row(calls, ["customer_id"], [c("call_date").desc_nulls_last(), c("call_id").desc_nulls_last()])
    latest = latest.select("customer_id", c("next_intent").alias("latest_intent"))
    return sums.join(modes(calls, "customer_id", labels), "customer_id", "left").join(latest, "customer_id", "left")


ZERO_WHEN_ABSENT = (
    "order_count", "return_count", "exposure_count", "click_count", "conversion_count", "call_count",
    "had_competitor_mention", "had_discount_trouble", "had_urgency_call",
)
ZERO_DOUBLE_WHEN_ABSENT = ("total_spend", "return_rate", "click_rate")


def customer_journey(customers: DataFrame, orders: DataFrame, exposures: DataFrame, calls: DataFrame) -> DataFrame:
    """Every customer with the summary of their orders, exposures and calls.

    Each side is reduced to one row per customer before the joins.  "primary" and
    "top" values are the most frequent ones, "latest" and "first" go by date.
    """
    joined = (
        customers.join(order_summary_by_customer(orders), "customer_id", "left")
        .join(exposure_summary_by_customer(exposures), "customer_id", "left")
        .join(call_summary_by_customer(calls), "customer_id", "left")
    )
    zeros = {n: F.coalesce(n, F.lit(0)) for n in ZERO_WHEN_ABSENT}
    return joined.withColumns({**zeros, **{n: F.coalesce(n, F.lit(0.0)) for n in ZERO_DOUBLE_WHEN_ABSENT}})


# --- channel performance ------------------------------------------------------------------

def channel_performance(orders: DataFrame, exposures: DataFrame, calls: DataFrame) -> DataFrame:
    """Orders, returns and calls per main channel and product category.

    Orders shrink to one row per customer and category and calls to one per customer
    before the channel is joined, so neither multiplies the other and no customer's
    rows travel as a whole.
    """
    c = F.col
    per_customer = orders.groupBy("customer_id", "product_category").agg(
        F.count_distinct("order_id").alias("orders"),
        F.count("*").alias("rows"),
        F.sum("total_amount").alias("amount"),
        F.count("total_amount").alias("amounts"),
        F.sum("discount_applied").alias("discount"),
        F.count("discount_applied").alias("discounts"),
        F.sum(flag(c("returned"))).alias("returns"),
        F.sum(flag(c("return_reason") == RETURN_DISCOUNT)).alias("r_discount"),
        F.sum(flag(c("return_reason") == RETURN_SIZE)).alias("r_size"),
        F.sum(flag(c("return_reason") == RETURN_IMAGE)).alias("r_image"),
    )
    call_per_customer = calls.groupBy("customer_id").agg(
        F.count_distinct("call_id").alias("calls"),
        F.sum(flag(c("trouble_type") == DISCOUNT_TROUBLE)).alias("trouble"),
        F.sum(flag(c("competitor_mention"))).alias("mention"),
    )
    channels = primary_channel(exposures)
    channel = F.coalesce("primary_channel", F.lit(DIRECT)).alias("channel")
    by_channel = (
        per_customer.join(channels, "customer_id", "left")
        .groupBy(channel, "product_category")
        .agg(
            F.sum("orders").alias("order_count"),
            F.count("customer_id").alias("customer_count"),
            F.sum("amount").cast("double").alias("total_revenue"),
            F.round(rate(F.sum("amount"), F.sum("amounts")), 0).alias("avg_order_amount"),
            F.round(rate(F.sum("discount"), F.sum("discounts")), 4).alias("avg_discount"),
            F.sum("returns").alias("return_count"),
            F.round(rate(F.sum("returns"), F.sum("rows")), 4).alias("return_rate"),
            F.sum("r_discount").alias("discount_trouble_returns"),
            F.sum("r_size").alias("size_mismatch_returns"),
            F.sum("r_image").alias("image_diff_returns"),
        )
    )
    call_side = (
        call_per_customer.join(channels, "customer_id", "left")
        .groupBy(channel)
        .agg(
            F.sum("calls").alias("call_count"),
            F.sum("trouble").alias("discount_trouble_calls"),
            F.sum("mention").alias("competitor_mention_calls"),
        )
    )
    zero = ("call_count", "discount_trouble_calls", "competitor_mention_calls")
    return by_channel.join(call_side, "channel", "left").withColumns({n: F.coalesce(n, F.lit(0)) for n in zero})


# --- reports on the fact and the journey --------------------------------------------------

def channel_summary(fact: DataFrame) -> DataFrame:
    return fact.groupBy("campaign_channel").agg(
        F.count("*").alias("total_orders"),
        F.sum("total_amount").cast("double").alias("total_revenue"),
        F.round(F.avg(flag(F.col("returned")).cast("double")) * 100.0, 2).alias("return_rate_pct"),
        F.sum(flag(F.col("return_reason") == RETURN_DISCOUNT)).alias("discount_trouble_returns"),
        F.sum("has_discount_trouble").alias("discount_trouble_calls"),
    ).orderBy(F.desc("return_rate_pct"), "campaign_channel")


def regional_revenue(fact: DataFrame, place: str = "prefecture", k: int | None = 15) -> DataFrame:
    """Orders and revenue per place with coordinates; the ``k`` largest, or all."""
    out = fact.groupBy(place, "latitude", "longitude").agg(
        F.count("*").alias("order_count"), F.sum("total_amount").cast("double").alias("total_revenue")
    )
    return out if k is None else top_k(out, [F.desc("total_revenue"), F.col(place)], k)


def resolution_vs_repeat(journey: DataFrame, split_zero: bool = True) -> DataFrame:
    """Orders and spend of callers by how often their calls were resolved."""
    callers = journey.filter(F.col("call_count") > 0)
    group = resolution_group("resolution_rate", "call_count" if split_zero else None)
    return callers.groupBy(group.alias("resolution_group")).agg(
        F.count("*").alias("customer_count"),
        F.round(F.avg("order_count"), 2).alias("avg_order_count"),
        F.round(mean("total_spend"), 0).alias("avg_total_spend"),
        F.round(F.avg("return_rate"), 4).alias("avg_return_rate"),
    ).orderBy("resolution_group")


def urgency_vs_spend(calls: DataFrame, journey: DataFrame) -> DataFrame:
    """Spend by urgency of the call.  A customer weighs once per call."""
    per_call = calls.groupBy("urgency_level", "customer_id").agg(F.count("*").alias("n"))
    joined = per_call.join(journey.select("customer_id", "avg_order_amount", "total_spend", "return_rate"), "customer_id")

    def weighted(col: str) -> Column:
        present = F.when(F.col(col).isNotNull(), F.col("n"))
        return rate(F.sum(F.col(col) * F.col("n")), F.sum(present))

    rank = ladder([(F.col("urgency_level") == u, i + 1) for i, u in enumerate(URGENCY_ORDER)], len(URGENCY_ORDER) + 1)
    return (
        joined.groupBy("urgency_level")
        .agg(
            F.count("customer_id").alias("customer_count"),
            F.round(weighted("avg_order_amount"), 0).alias("avg_order_amount"),
            F.round(weighted("total_spend"), 0).alias("avg_total_spend"),
            F.round(weighted("return_rate"), 4).alias("avg_return_rate"),
        )
        .orderBy(rank, "urgency_level")
    )


def kpi_cards(fact: DataFrame) -> DataFrame:
    return fact.agg(
        F.count("order_id").alias("order_count"),
        F.sum("total_amount").cast("double").alias("total_revenue"),
        rate(F.sum(flag(F.col("returned"))), F.count("*")).alias("return_rate"),
        F.count_distinct("customer_id").alias("unique_customers"),
    )


def return_reasons(fact: DataFrame) -> DataFrame:
    return (
        fact.filter(F.col("returned"))
        .groupBy("campaign_channel", "return_reason")
        .agg(F.count("*").alias("cnt"))
        .orderBy("campaign_channel", F.desc("cnt"), "return_reason")
    )


def monthly_revenue(fact: DataFrame) -> DataFrame:
    return (
        fact.groupBy("order_month", "campaign_channel")
        .agg(F.sum("total_amount").cast("double").alias("monthly_revenue"))
        .orderBy("order_month", "campaign_channel")
    )


def category_returns(fact: DataFrame) -> DataFrame:
    return fact.groupBy("product_category").agg(
        F.sum("total_amount").cast("double").alias("total_revenue"),
        rate(F.sum(flag(F.col("returned"))), F.count("*")).alias("return_rate"),
    )


def trouble_vs_returns(journey: DataFrame) -> DataFrame:
    """Return rate of customers with and without a discount trouble call."""
    return journey.filter(F.col("order_count") > 0).groupBy("had_discount_trouble").agg(
        F.count("*").alias("customer_count"),
        F.sum("order_count").alias("order_count"),
        F.sum("return_count").alias("return_count"),
        F.round(rate(F.sum("return_count"), F.sum("order_count")), 4).alias("return_rate"),
    )


def return_what_if(fact: DataFrame) -> DataFrame:
    """Revenue in returns per channel, and what the other channels' rate would recover."""
    lost = F.when(F.col("returned"), F.col("total_amount"))
    per = fact.groupBy("campaign_channel").agg(
        F.count("*").alias("orders"),
        F.sum(flag(F.col("returned"))).alias("returns"),
        F.coalesce(F.sum(lost), F.lit(0)).cast("double").alias("lost_revenue"),
    )
    all_orders = per.agg(F.sum("orders")).scalar()
    all_returns = per.agg(F.sum("returns")).scalar()
    own = rate("returns", "orders")
    others = rate(all_returns - F.col("returns"), all_orders - F.col("orders"))
    gain = F.when(own > others, F.col("lost_revenue") * (F.lit(1.0) - others / own)).otherwise(F.lit(0.0))
    return per.select(
        "campaign_channel", "orders", "returns", "lost_revenue",
        F.round(own, 4).alias("return_rate"), F.round(others, 4).alias("peer_return_rate"),
        F.round(gain, 0).alias("recoverable_revenue"),
    )


# --- customer sets and relations ---------------------------------------------------------

def customer_sets(customers: DataFrame, orders: DataFrame, exposures: DataFrame, channel: str,
                  high_spend: float = 30000, repeat: int = 3, low: int = 1) -> DataFrame:
    """Membership flags per customer; a customer without orders has zero of them."""
    stats = orders.groupBy("customer_id").agg(
        F.count("order_id").alias("orders"), mean("total_amount").alias("avg_amount"),
        F.sum(flag(F.col("returned"))).alias("returns"),
    )
    joined = customers.select("customer_id").join(stats, "customer_id", "left").join(
        primary_channel(exposures), "customer_id", "left"
    )
    n, on_channel = F.coalesce("orders", F.lit(0)), F.coalesce(F.col("primary_channel") == channel, F.lit(False))
    return joined.select(
        "customer_id",
        F.coalesce("primary_channel", F.lit(NO_CHANNEL)).alias("primary_channel"),
        on_channel.alias("on_channel"),
        (on_channel & (F.coalesce("returns", F.lit(0)) > 0)).alias("on_channel_with_return"),
        (F.coalesce("avg_amount", F.lit(0.0)) > high_spend).alias("high_spend"),
        (n >= repeat).alias("repeat_buyer"),
        (n <= low).alias("low_order"),
    )


def topic_by_channel(calls: DataFrame, exposures: DataFrame, topic: Column) -> DataFrame:
    """Calls about a topic by main channel of the caller, with their share."""
    per_customer = calls.filter(topic).groupBy("customer_id").agg(F.count("*").alias("n"))
    joined = per_customer.join(primary_channel(exposures), "customer_id", "left")
    out = joined.groupBy(F.coalesce("primary_channel", F.lit(NO_CHANNEL)).alias("channel")).agg(F.sum("n").alias("cnt"))
    return out.withColumn("pct", F.round(F.col("cnt") * F.lit(100.0) / out.agg(F.sum("cnt")).scalar(), 1))


def orders_by_resolution(calls: DataFrame, orders: DataFrame, resolved: Column) -> DataFrame:
    """Mean number of orders of callers whose call was resolved or not, per call."""
    per = calls.groupBy("customer_id", F.coalesce(resolved, F.lit(False)).alias("resolved")).agg(F.count("*").alias("n"))
    count = orders.groupBy("customer_id").agg(F.count("order_id").alias("orders"))
    joined = per.join(count, "customer_id", "left").withColumn("orders", F.coalesce("orders", F.lit(0)))
    return joined.groupBy("resolved").agg(
        F.sum("n").alias("calls"), rate(F.sum(F.col("orders") * F.col("n")), F.sum("n")).alias("mean_orders")
    )


def type_distribution(calls: DataFrame, col: str) -> DataFrame:
    return with_share(calls, [col]).orderBy(F.desc("cnt"), col)
