"""End-to-end jobs on the given tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans import campaign, retail, shop, store
from ..session import scratch_path, shuffles_freed
from ..sinks import tables as K
from . import grouping  # noqa: F401  (defines relations used below)
from .registry import define, query
from .tables import AS_OF, LIMITS, YEAR, Data

c = F.col


def as_double(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({n: c(n).cast("double") for n in cols})


def rounded(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({n: F.round(n, 2) for n in cols})


def plain(types: dict[str, str]) -> dict[str, str]:
    """Zone-less timestamps, as in the given tables."""
    return {k: "timestamp_ntz" if v == "timestamp" else v for k, v in types.items()}


# --- cleaned tables ---------------------------------------------------------------------


@query(
    "b01_silver_users",
    """SELECT 'U' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS user_id, c_name AS name, CASE WHEN c_custkey % 3 = 0 THEN 'M' ELSE 'F' END AS gender,
    CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE CAST(DATE '1950-01-01' + CAST(c_custkey % 18000 AS INT) AS DATE) END AS birth_date,
    CASE WHEN c_mktsegment IN ('HOUSEHOLD', 'MACHINERY') THEN '不明' ELSE c_mktsegment END AS pref,
    '090-' || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') || '-0000' AS phone_number, c_name || '@example.com' AS email,
    c_custkey % 4 = 0 AS email_permission_flg, CAST(DATE '1995-01-01' + CAST(c_custkey % 700 AS INT) AS DATE) AS registration_date,
    CASE WHEN c_acctbal < 1000 THEN 'inactive' ELSE 'active' END AS status,
    CASE WHEN c_acctbal < 0 THEN NULL ELSE make_timestamp(2001, 7, c_custkey % 28 + 1, 10, 30, 0) END AS last_login_at FROM customer""",
)
def _(d: Data) -> DataFrame:
    return retail.silver_users(d.bz_users, plain(retail.USER_TYPES))


@query(
    "b01_silver_items",
    """SELECT p_partkey AS item_id, CAST(p_size * 100 AS BIGINT) AS category_id, p_name AS item_name, p_type AS category_name, CAST(floor(p_retailprice) AS BIGINT) AS price,
    CASE WHEN p_size > 45 THEN NULL ELSE DATE '2001-12-31' END AS expiration_date, DATE '2001-01-15' AS arrival_date, p_size % 3 = 0 AS is_organic,
    p_size <= 25 AS is_discount_target, p_size > 30 AS is_ready_to_eat, p_retailprice >= 950 AS is_premium FROM part""",
)
def _(d: Data) -> DataFrame:
    return retail.silver_items(d.bz_items)


@query(
    "b01_silver_stores",
    """SELECT s_suppkey AS store_id, s_name AS store_name, n_name AS store_area, 'street ' || s_suppkey AS address, lpad(CAST(s_suppkey AS VARCHAR), 7, '0') AS postal_code,
    n_name AS prefecture, 'city ' || s_nationkey AS city, '03-0000-0000' AS phone_number, s_name || '@example.com' AS email, '9:00-21:00' AS business_hours,
    CAST(NULL AS VARCHAR) AS closed_days, CASE WHEN s_acctbal < 0 THEN NULL ELSE s_suppkey * 10 END AS manager_id,
    CAST(DATE '1990-01-01' + CAST(s_suppkey % 3000 AS INT) AS DATE) AS opening_date, CASE WHEN s_acctbal < 0 THEN 'INACTIVE' ELSE 'ACTIVE' END AS status
    FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
)
def _(d: Data) -> DataFrame:
    return retail.silver_stores(d.bz_stores)


@query(
    "b02_silver_orders",
    """SELECT order_id, CAST(user_id AS VARCHAR) AS user_id, store_id, store_name, store_area, order_datetime, total_amount, total_quantity, order_status FROM r_orders""",
)
def _(d: Data) -> DataFrame:
    return retail.silver_orders(d.bz_orders, retail.silver_stores(d.bz_stores), plain(retail.ORDER_TYPES))


@query(
    "b02_silver_order_items",
    """SELECT CAST(order_item_id AS BIGINT) AS order_item_id, user_id, CAST(order_id AS BIGINT) AS order_id, CAST(b.store_id AS BIGINT) AS store_id, s.store_name, s.store_area,
    CAST(b.item_id AS BIGINT) AS item_id, CAST(b.category_id AS BIGINT) AS category_id, p_name AS item_name, p_type AS category_name, p_size % 3 = 0 AS is_organic,
    p_size <= 25 AS is_discount_target, p_size > 30 AS is_ready_to_eat, p_retailprice >= 950 AS is_premium, CAST(quantity AS INT) AS quantity,
    CAST(unit_price AS BIGINT) AS unit_price, CAST(subtotal AS BIGINT) AS subtotal, cancel_flg = 'True' AS cancel_flg, CAST(b.order_datetime AS TIMESTAMP) AS order_datetime
    FROM (SELECT *, row_number() OVER (PARTITION BY order_item_id ORDER BY _ingested_at DESC, user_id, CAST(order_id AS BIGINT), CAST(store_id AS BIGINT), CAST(item_id AS BIGINT), CAST(category_id AS BIGINT),
      CAST(quantity AS INT), CAST(unit_price AS BIGINT), CAST(subtotal AS BIGINT), cancel_flg, order_datetime) AS rn FROM (
      SELECT CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) AS order_item_id, CAST(user_id AS VARCHAR) AS user_id, CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_suppkey AS VARCHAR) AS store_id,
        CAST(l_partkey AS VARCHAR) AS item_id, CAST(p_size * 100 AS VARCHAR) AS category_id, CAST(CAST(l_quantity AS INT) AS VARCHAR) AS quantity,
        CAST(CAST(floor(l_extendedprice / l_quantity) AS BIGINT) AS VARCHAR) AS unit_price, CAST(CAST(floor(l_extendedprice) AS BIGINT) AS VARCHAR) AS subtotal,
        CASE WHEN l_returnflag = 'R' THEN 'True' ELSE 'False' END AS cancel_flg, CAST(h.order_datetime AS VARCHAR) AS order_datetime, l_shipdate AS _ingested_at
      FROM lineitem JOIN r_heads h ON l_orderkey = h.order_id JOIN part ON l_partkey = p_partkey)) b
    LEFT JOIN part ON CAST(b.item_id AS BIGINT) = p_partkey LEFT JOIN r_stores s ON CAST(b.store_id AS BIGINT) = s.store_id WHERE rn = 1""",
)
def _(d: Data) -> DataFrame:
    items, stores = retail.silver_items(d.bz_items), retail.silver_stores(d.bz_stores)
    return retail.silver_order_items(d.bz_order_items, items, stores, types=plain(retail.LINE_TYPES))


# --- retail analytic tables -----------------------------------------------------------------


def segments(d: Data) -> DataFrame:
    return retail.user_segments(d.order_times, d.r_lines, AS_OF, rfm_limits=LIMITS)


@query(
    "b03_gold_users",
    """SELECT u.user_id, u.name, u.gender, u.status, u.registration_date, k.behavior_cluster, coalesce(n.label, 'ランダム') AS behavior_cluster_name, s.last_purchase_date, s.recency,
    s.frequency, s.monetary, s.r_score, s.f_score, s.m_score, s.rfm_segment, s.customer_type FROM r_users u LEFT JOIN r_clusters k ON u.user_id = k.user_id
    LEFT JOIN r_segmented s ON u.user_id = s.user_id LEFT JOIN r_cluster_names n ON k.behavior_cluster = n.code""",
)
def _(d: Data) -> DataFrame:
    return as_double(retail.gold_users(d.r_users, segments(d)), "monetary")


define(
    r_calendar="""
SELECT order_id AS cal_order_id, CAST(order_datetime AS DATE) AS order_date, CAST(hour(order_datetime) AS INT) AS order_hour, CAST(dayofweek(order_datetime) + 1 AS INT) AS order_dayofweek,
  dayofweek(order_datetime) IN (0, 6) AS is_weekend FROM r_heads"""
)


@query(
    "b04_gold_orders",
    """SELECT o.order_id, o.user_id, o.store_id, o.store_name, o.store_area, o.order_datetime, t.order_date, t.order_hour, t.order_dayofweek, t.is_weekend, o.total_amount::DOUBLE AS total_amount,
    o.total_quantity, o.order_status, k.behavior_cluster, coalesce(n.label, 'ランダム') AS behavior_cluster_name, s.r_score, s.f_score, s.m_score, s.rfm_segment, f.is_first_order,
    CASE WHEN f.is_first_order THEN '新規' ELSE '既存' END AS customer_type FROM r_orders o JOIN r_calendar t ON o.order_id = t.cal_order_id LEFT JOIN r_clusters k ON o.user_id = k.user_id
    LEFT JOIN r_segmented s ON o.user_id = s.user_id LEFT JOIN r_cluster_names n ON k.behavior_cluster = n.code LEFT JOIN r_first f ON o.order_id = f.order_id""",
)
def _(d: Data) -> DataFrame:
    return as_double(retail.gold_orders(d.r_orders, d.r_users, segments(d)), "total_amount")


@query(
    "b05_gold_order_items",
    """SELECT l.order_item_id, l.order_id, l.user_id, l.store_id, l.store_name, l.store_area, l.item_id, l.item_name, l.category_id, l.category_name, l.is_organic, l.is_discount_target, l.is_ready_to_eat,
    l.is_premium, l.quantity, l.subtotal::DOUBLE / l.quantity AS unit_price, l.subtotal::DOUBLE AS subtotal, l.cancel_flg, l.order_datetime, t.order_date, t.order_hour, t.order_dayofweek, t.is_weekend,
    k.behavior_cluster, coalesce(n.label, 'ランダム') AS behavior_cluster_name, s.r_score, s.f_score, s.m_score, s.rfm_segment, f.is_first_order,
    CASE WHEN f.is_first_order THEN '新規' ELSE '既存' END AS customer_type FROM r_lines l JOIN r_calendar t ON l.order_id = t.cal_order_id LEFT JOIN r_clusters k ON l.user_id = k.user_id
    LEFT JOIN r_segmented s ON l.user_id = s.user_id LEFT JOIN r_cluster_names n ON k.behavior_cluster = n.code LEFT JOIN r_first f ON l.order_id = f.order_id""",
)
def _(d: Data) -> DataFrame:
    """The segments are stored, as orders and their flags both ask for them."""
    path = scratch_path(d.spark, "b05")
    with shuffles_freed(d.spark):
        K.overwrite(segments(d), path)
    lines = d.r_bare_lines.join(d.order_times.select("order_id", "user_id", "order_datetime"), "order_id")
    dims = (
        (d.r_store_names, "store_id", ("store_name", "nation_id")), (d.r_store_areas, "nation_id", ("store_area",)),
        (d.r_items, "item_id", ("category_id", *retail.ITEM_REF)),
    )
    derived = {"order_item_id": c("order_id") * 10 + c("line_number"), "unit_price": c("subtotal").cast("double") / c("quantity")}
    gold = retail.gold_order_items(lines, d.order_times, d.r_users, d.spark.read.parquet(path), dims=dims, derived=derived)
    return as_double(gold, "subtotal")


# --- shop -----------------------------------------------------------------------------------


def kept(d: Data) -> DataFrame:
    return shop.enrich_transactions(d.t_transactions, d.t_users, d.t_products)


@query(
    "b06_enriched_transactions",
    """SELECT order_id, product_id, user_id, quantity, amount, transaction_date, user_name, age, gender, email, region, category, subcategory, price, strftime(transaction_date, '%Y-%m-%d') AS transaction_yyyymmdd,
    strftime(transaction_date, '%Y-%m') AS transaction_yyyymm, strftime(transaction_date, '%Y') AS transaction_yyyy FROM t_kept""",
)
def _(d: Data) -> DataFrame:
    return kept(d)


@query(
    "b07_revenue_by_subcategory",
    "SELECT category, subcategory, round(sum(amount), 2) AS sum_revenue, sum(quantity)::BIGINT AS sum_quantity, count(order_id) AS order_count FROM t_kept GROUP BY 1, 2",
)
def _(d: Data) -> DataFrame:
    return rounded(shop.revenue_by_subcategory(kept(d)), "sum_revenue")


AGE3_SQL = "CASE WHEN age < 35 THEN '若年層' WHEN age < 55 THEN '中年層' ELSE 'シニア層' END"


@query(
    "b08_revenue_by_user_segment",
    f"SELECT {AGE3_SQL} AS age_group, gender, region, round(sum(amount), 2) AS sum_revenue, count(order_id) AS order_count FROM t_kept GROUP BY 1, 2, 3",
)
def _(d: Data) -> DataFrame:
    return rounded(shop.revenue_by_user_segment(kept(d)), "sum_revenue")


PIVOT_SQL = """sum(CASE WHEN subcategory = 'PC本体' THEN quantity ELSE 0 END)::BIGINT AS pc_quantity, sum(CASE WHEN subcategory = '周辺機器' THEN quantity ELSE 0 END)::BIGINT AS peripheral_quantity,
    sum(CASE WHEN subcategory NOT IN ('PC本体', '周辺機器') THEN quantity ELSE 0 END)::BIGINT AS other_quantity"""


@query("b09_user_categories", f"SELECT user_id, age, {PIVOT_SQL}, {AGE3_SQL} AS age_group FROM t_kept GROUP BY user_id, age")
def _(d: Data) -> DataFrame:
    return shop.user_categories(kept(d))


@query(
    "b10_revenue_report",
    f"""SELECT user_id, user_name, gender, age, round(sum(amount), 2) AS total_sales, count(order_id) AS total_orders, max(transaction_date) AS last_purchase_timestamp, {PIVOT_SQL}, {AGE3_SQL} AS age_group,
    strftime(max(transaction_date), '%Y-%m-%d') AS last_purchase_date, strftime(max(transaction_date), '%Y-%m') AS last_purchase_month, strftime(max(transaction_date), '%Y') AS last_purchase_year
    FROM t_enriched GROUP BY user_id, user_name, gender, age""",
)
def _(d: Data) -> DataFrame:
    everything = shop.enrich_transactions(d.t_transactions, d.t_users, d.t_products, master_rules=None)
    return rounded(shop.revenue_report(everything), "total_sales").orderBy(F.desc("total_sales"), "user_id")


# --- campaign and calls ---------------------------------------------------------------------


def fact(d: Data) -> DataFrame:
    return campaign.dashboard_fact(d.c_orders, d.c_customers, d.c_exposures, d.c_calls, d.c_geo)


def journey(d: Data) -> DataFrame:
    return campaign.customer_journey(d.c_customers, d.c_orders, d.c_exposures, d.c_calls)


@query("b11_dashboard_fact", "SELECT * REPLACE (total_amount::DOUBLE AS total_amount) FROM c_fact")
def _(d: Data) -> DataFrame:
    return as_double(fact(d), "total_amount", "discount_applied")


@query("b12_customer_journey", "SELECT * FROM c_journey")
def _(d: Data) -> DataFrame:
    return journey(d)


@query(
    "b13_channel_performance",
    """SELECT o.*, coalesce(k.call_count, 0) AS call_count, coalesce(k.discount_trouble_calls, 0) AS discount_trouble_calls, coalesce(k.competitor_mention_calls, 0) AS competitor_mention_calls FROM (
    SELECT coalesce(ch.primary_channel, '直接') AS channel, product_category, count(DISTINCT order_id) AS order_count, count(DISTINCT o.customer_id) AS customer_count, sum(total_amount)::DOUBLE AS total_revenue,
      round(sum(total_amount)::DOUBLE / count(total_amount), 0) AS avg_order_amount, round(sum(discount_applied)::DOUBLE / count(*), 4) AS avg_discount, sum(CASE WHEN returned THEN 1 ELSE 0 END)::BIGINT AS return_count,
      round(avg(CASE WHEN returned THEN 1.0::DOUBLE ELSE 0 END), 4) AS return_rate, sum(CASE WHEN return_reason = '割引条件違い' THEN 1 ELSE 0 END)::BIGINT AS discount_trouble_returns,
      sum(CASE WHEN return_reason = 'サイズ不一致' THEN 1 ELSE 0 END)::BIGINT AS size_mismatch_returns, sum(CASE WHEN return_reason = 'イメージ違い' THEN 1 ELSE 0 END)::BIGINT AS image_diff_returns
    FROM c_orders o LEFT JOIN c_channel ch ON o.customer_id = ch.customer_id GROUP BY 1, 2) o LEFT JOIN (
    SELECT coalesce(ch.primary_channel, '直接') AS channel, count(DISTINCT call_id) AS call_count, sum(CASE WHEN trouble_type = '割引条件' THEN 1 ELSE 0 END)::BIGINT AS discount_trouble_calls,
      sum(CASE WHEN competitor_mention THEN 1 ELSE 0 END)::BIGINT AS competitor_mention_calls FROM c_calls k LEFT JOIN c_channel ch ON k.customer_id = ch.customer_id GROUP BY 1) k ON o.channel = k.channel""",
)
def _(d: Data) -> DataFrame:
    return campaign.channel_performance(d.c_orders, d.c_exposures, d.c_calls)


@query(
    "b14_channel_summary",
    """SELECT campaign_channel, count(*) AS total_orders, sum(total_amount)::DOUBLE AS total_revenue, round(avg(CASE WHEN returned THEN 1.0::DOUBLE ELSE 0 END) * 100, 2) AS return_rate_pct,
    sum(CASE WHEN return_reason = '割引条件違い' THEN 1 ELSE 0 END)::BIGINT AS discount_trouble_returns, sum(has_discount_trouble)::BIGINT AS discount_trouble_calls FROM c_fact GROUP BY 1""",
)
def _(d: Data) -> DataFrame:
    return campaign.channel_summary(fact(d))


REGION_SQL = "SELECT prefecture, latitude, longitude, count(*) AS order_count, sum(total_amount)::DOUBLE AS total_revenue FROM c_fact GROUP BY 1, 2, 3"


@query("b15_regional_revenue", REGION_SQL)
def _(d: Data) -> DataFrame:
    return campaign.regional_revenue(fact(d), k=None)


@query("b15_regional_revenue_top", REGION_SQL + " ORDER BY total_revenue DESC, prefecture LIMIT 15")
def _(d: Data) -> DataFrame:
    return campaign.regional_revenue(fact(d))


@query(
    "b16_resolution_vs_repeat",
    """SELECT CASE WHEN resolution_rate >= 0.8 THEN '解決率80%以上' WHEN resolution_rate >= 0.5 THEN '解決率50-79%' WHEN resolution_rate > 0 THEN '解決率50%未満' ELSE '解決率0%' END AS resolution_group,
    count(*) AS customer_count, round(avg(order_count), 2) AS avg_order_count, round(avg(total_spend), 0) AS avg_total_spend, round(avg(return_rate), 4) AS avg_return_rate FROM c_journey WHERE call_count > 0 GROUP BY 1""",
)
def _(d: Data) -> DataFrame:
    return campaign.resolution_vs_repeat(journey(d))


@query(
    "b17_urgency_vs_spend",
    """SELECT s.urgency_level, count(DISTINCT s.customer_id) AS customer_count, round(avg(j.avg_order_amount), 0) AS avg_order_amount, round(avg(j.total_spend), 0) AS avg_total_spend,
    round(avg(j.return_rate), 4) AS avg_return_rate FROM c_calls s JOIN c_journey j ON s.customer_id = j.customer_id GROUP BY 1""",
)
def _(d: Data) -> DataFrame:
    return campaign.urgency_vs_spend(d.c_calls, journey(d))


@query(
    "b18_kpi_cards",
    """SELECT count(order_id) AS order_count, sum(total_amount)::DOUBLE AS total_revenue, sum(CASE WHEN returned THEN 1 ELSE 0 END)::DOUBLE / count(*) AS return_rate, count(DISTINCT customer_id) AS unique_customers FROM c_fact""",
)
def _(d: Data) -> DataFrame:
    return campaign.kpi_cards(fact(d))


@query("b19_return_reasons", "SELECT campaign_channel, return_reason, count(*) AS cnt FROM c_fact WHERE returned GROUP BY 1, 2")
def _(d: Data) -> DataFrame:
    return campaign.return_reasons(fact(d))


@query("b20_monthly_revenue", "SELECT order_month, campaign_channel, sum(total_amount)::DOUBLE AS monthly_revenue FROM c_fact GROUP BY 1, 2")
def _(d: Data) -> DataFrame:
    return campaign.monthly_revenue(fact(d))


@query(
    "b21_category_returns",
    "SELECT product_category, sum(total_amount)::DOUBLE AS total_revenue, sum(CASE WHEN returned THEN 1 ELSE 0 END)::DOUBLE / count(*) AS return_rate FROM c_fact GROUP BY 1",
)
def _(d: Data) -> DataFrame:
    return campaign.category_returns(fact(d))


@query(
    "b22_call_list",
    """SELECT call_date, call_id, purpose, trouble_type, urgency_level, resolution_status, left(string_split(transcript, chr(10))[1], 50) AS transcript_summary FROM c_calls
    WHERE urgency_level IN ('高', '中') AND trouble_type IN ('割引条件', 'サイズ') AND resolution_status IN ('未解決')""",
)
def _(d: Data) -> DataFrame:
    from .tables import CALL_COMPETITOR, CALL_RULES

    analysis = campaign.call_analysis(d.c_raw_calls, CALL_RULES, CALL_COMPETITOR)
    filters = {"urgency_level": ["高", "中"], "trouble_type": ["割引条件", "サイズ"], "resolution_status": ["未解決"], "purpose": None}
    return campaign.call_list(analysis, filters)


@query(
    "b23_trouble_vs_returns",
    """SELECT had_discount_trouble, count(*) AS customer_count, sum(order_count)::BIGINT AS order_count, sum(return_count)::BIGINT AS return_count, round(sum(return_count)::DOUBLE / sum(order_count), 4) AS return_rate
    FROM c_journey WHERE order_count > 0 GROUP BY 1""",
)
def _(d: Data) -> DataFrame:
    return campaign.trouble_vs_returns(journey(d))


@query(
    "b23_return_what_if",
    """SELECT campaign_channel, orders, returns, lost_revenue, round(own, 4) AS return_rate, round(others, 4) AS peer_return_rate,
    round(CASE WHEN own > others THEN lost_revenue * (1.0::DOUBLE - others / own) ELSE 0 END, 0) AS recoverable_revenue FROM (
    SELECT campaign_channel, orders, returns, lost_revenue, returns::DOUBLE / orders AS own, (sum(returns) OVER () - returns)::DOUBLE / (sum(orders) OVER () - orders)::DOUBLE AS others FROM (
    SELECT campaign_channel, count(*) AS orders, sum(CASE WHEN returned THEN 1 ELSE 0 END)::BIGINT AS returns, coalesce(sum(CASE WHEN returned THEN total_amount END), 0)::DOUBLE AS lost_revenue FROM c_fact GROUP BY 1))""",
)
def _(d: Data) -> DataFrame:
    return campaign.return_what_if(fact(d))


# --- stores ---------------------------------------------------------------------------------


@query(
    "b24_store_kpis",
    """SELECT s.store_id, s.store_name, s.prefecture, s.city, s.size_sqm, s.store_type, s.parking_capacity, y.yoy_pct2 AS avg_yoy_pct, round(y.sales / 10000, 0) AS annual_sales_man, round(y.customers, 0) AS avg_monthly_customers, round(y.basket, 0) AS avg_basket
    FROM s_stores s JOIN s_yearly y ON s.store_id = y.store_id""",
)
def _(d: Data) -> DataFrame:
    return store.store_kpis(d.s_stores, d.s_monthly, YEAR, [*store.STORE_COLS, "size_sqm", "store_type", "parking_capacity"])


@query(
    "b24_store_list",
    """SELECT s.store_id, s.store_name, s.prefecture, s.city, y.yoy3 AS yoy_change, round(y.sales / 10000, 0) AS sales_amount,
    CASE WHEN coalesce(y.yoy3, 0) >= 0 THEN 'good' WHEN y.yoy3 > -0.10::DOUBLE THEN 'normal' WHEN y.yoy3 > -0.15::DOUBLE THEN 'warning' ELSE 'critical' END AS alert_level
    FROM s_stores s JOIN s_yearly y ON s.store_id = y.store_id""",
)
def _(d: Data) -> DataFrame:
    return store.store_list(d.s_stores, d.s_monthly, YEAR)


@query(
    "b25_store_monthly_trend",
    "SELECT store_id, month, sales_amount::DOUBLE AS sales_amount, yoy_change::DOUBLE AS yoy_change, customer_count, avg_basket FROM s_monthly",
)
def _(d: Data) -> DataFrame:
    return as_double(store.monthly_trend(d.s_monthly), "sales_amount", "yoy_change")


TREND_SQL = """SELECT month, round(sum(sales_amount)::DOUBLE / 100000000, 2) AS total_sales_oku, round(sum(yoy_change)::DOUBLE / count(yoy_change) * 100, 1) AS avg_yoy_pct, sum(customer_count)::BIGINT AS total_customers
    FROM s_monthly WHERE year(month) = 2000 {} GROUP BY month"""


@query("b25_chain_trend", TREND_SQL.format(""))
def _(d: Data) -> DataFrame:
    return store.chain_trend(d.s_monthly, d.s_stores, YEAR)


@query(
    "b25_chain_trend_filtered",
    TREND_SQL.format(
        "AND store_id IN (SELECT store_id FROM s_stores WHERE prefecture = 'NATION_3') AND store_id IN (SELECT store_id FROM s_yearly WHERE yoy >= 0)"
    ),
)
def _(d: Data) -> DataFrame:
    return store.chain_trend(d.s_monthly, d.s_stores, YEAR, health="healthy", prefecture="NATION_3", store_id=None)


@query(
    "b26_chain_average",
    """SELECT round(sum(yoy_change)::DOUBLE / count(yoy_change) * 100, 2) AS avg_yoy_pct, round(sum(sales_amount)::DOUBLE / count(*) / 10000.0::DOUBLE * 12.0::DOUBLE, 0) AS avg_annual_sales_man,
    count(*)::DOUBLE / (count(DISTINCT store_id) * 12) AS month_coverage FROM s_monthly WHERE year(month) = 2000""",
)
def _(d: Data) -> DataFrame:
    return store.chain_average(d.s_monthly, YEAR)


@query(
    "b27_demographics",
    """SELECT c_custkey AS store_id, CAST(50000 + c_custkey % 1000 * 100 AS BIGINT) AS population_5km, CAST(20000 + c_custkey % 700 * 30 AS BIGINT) AS households, c_acctbal AS avg_income,
    (c_custkey % 40) / 100.0::DOUBLE AS elderly_rate, (c_custkey % 30) / 100.0::DOUBLE AS young_adult_rate,
    (c_custkey % 80) / 100.0::DOUBLE AS detached_house_rate, (c_custkey % 150) / 100.0::DOUBLE AS day_night_ratio, c_custkey % 5000 AS num_businesses FROM customer""",
)
def _(d: Data) -> DataFrame:
    return store.demographics_of(d.s_trade_area)


define(
    s_spending="SELECT c_custkey AS store_id, "
    + ", ".join(f"CAST(floor(abs(c_acctbal)) AS BIGINT) * 1000 // {k} AS {name}" for k, name in enumerate(store.SPENDING, 1))
    + " FROM customer",
    s_spending_groups="""
SELECT *, expenditure_total // 10000 AS total_man, (garden_plants + garden_supplies) // 10000 AS garden_man, (pet_food + pet_supplies) // 10000 AS pet_man,
  housing_repair_total // 10000 AS repair_man, construction_services // 10000 AS construction_man FROM s_spending""",
)


@query("b27_expenditure", "SELECT * FROM s_spending_groups")
def _(d: Data) -> DataFrame:
    return store.spending_of(d.s_spending)


@query("b27_competitors", "SELECT store_id, competitor_name, distance_km, size_sqm, open_year, is_new_entry FROM s_competitors")
def _(d: Data) -> DataFrame:
    return store.competitors_of(d.s_competitors)


FACILITY_SQL = "CASE facility_type WHEN '駅' THEN 'station' WHEN '学校' THEN 'school' WHEN '公園' THEN 'park' WHEN 'コンビニ' THEN 'convenience' ELSE 'other' END"


@query("b27_facilities", f"SELECT store_id, {FACILITY_SQL} AS facility_type, facility_type AS type_label, facility_name, distance_km, traffic_impact, opening_hours FROM s_facilities")
def _(d: Data) -> DataFrame:
    return store.facilities_of(d.s_facilities)


@query(
    "b27_nearest_facilities",
    f"""SELECT store_id, {FACILITY_SQL} AS facility_type, facility_type AS type_label, facility_name, distance_km, traffic_impact, opening_hours, CAST(rn AS INT) AS rank FROM (
    SELECT *, row_number() OVER (PARTITION BY store_id ORDER BY distance_km, facility_name) AS rn FROM s_facilities) WHERE rn <= 10""",
)
def _(d: Data) -> DataFrame:
    return store.facilities_of(d.s_facilities, 10)


@query(
    "b27_measures",
    "SELECT store_id, measure_id, measure_type, status, start_date, coalesce(replace(related_categories, ',', '|'), '') AS related_categories, description, expected_effect, actual_effect, end_date, investment_amount FROM s_measures",
)
def _(d: Data) -> DataFrame:
    return store.measures_of(d.s_measures).withColumn("related_categories", F.array_join("related_categories", "|"))


def yearly_categories(d: Data) -> DataFrame:
    return store.category_sales(d.s_by_category, d.s_categories, YEAR)


@query("b28_category_gaps", "SELECT * FROM s_gaps")
def _(d: Data) -> DataFrame:
    return store.category_gaps(yearly_categories(d))


@query(
    "b29_huff_share",
    """SELECT store_id, type, name, size_sqm, round(attr / sum(attr) OVER (PARTITION BY store_id) * 100, 1) AS share FROM (
    SELECT *, CASE WHEN distance_km = 0 THEN size_sqm::DOUBLE ELSE size_sqm::DOUBLE / power(distance_km, 2) END AS attr FROM (
    SELECT store_id, 'self' AS type, store_name AS name, size_sqm, 0.0::DOUBLE AS distance_km FROM s_stores UNION ALL SELECT store_id, 'competitor', competitor_name, size_sqm, distance_km FROM s_competitors))""",
)
def _(d: Data) -> DataFrame:
    return store.huff_share(d.s_stores, d.s_competitors)


def peers(d: Data) -> DataFrame:
    return store.similar_kpis(d.s_similar, d.s_stores, d.s_monthly, YEAR)


@query("b30_similar_stores", "SELECT * FROM s_peers")
def _(d: Data) -> DataFrame:
    return peers(d)


@query("b30_benchmark_gaps", "SELECT * FROM s_benchmark")
def _(d: Data) -> DataFrame:
    return store.benchmark_gaps(yearly_categories(d), peers(d))


@query(
    "b31_business_kpis",
    """SELECT count(DISTINCT store_id) AS store_count, round(sum(sales_amount)::DOUBLE / 100000000, 2) AS total_sales_oku, round(sum(yoy_change)::DOUBLE / count(yoy_change) * 100, 1) AS avg_yoy_pct,
    round(sum(customer_count)::DOUBLE / count(*), 0) AS avg_customers, round(sum(avg_basket)::DOUBLE / count(avg_basket), 0) AS avg_basket FROM s_monthly WHERE year(month) = 2000""",
)
def _(d: Data) -> DataFrame:
    return store.business_kpis(d.s_monthly, YEAR)


@query(
    "b31_health_distribution",
    "SELECT CASE WHEN yoy >= 0 THEN 'healthy' WHEN yoy >= -0.10 THEN 'caution' ELSE 'critical' END AS health, count(*) AS stores FROM s_yearly GROUP BY 1",
)
def _(d: Data) -> DataFrame:
    return store.health_distribution(d.s_monthly, YEAR)


@query("b31_all_stores", "SELECT s.store_id, s.store_name, s.prefecture, s.city, y.yoy_pct1 AS yoy_pct, round(y.sales / 10000, 0) AS sales_man, s.latitude, s.longitude FROM s_stores s JOIN s_yearly y ON s.store_id = y.store_id")
def _(d: Data) -> DataFrame:
    return store.all_stores(d.s_stores, d.s_monthly, YEAR)


@query("b31_store_ranking", "SELECT * FROM s_ranking")
def _(d: Data) -> DataFrame:
    return store.store_ranking(d.s_stores, d.s_monthly, YEAR)


@query(
    "b31_regional_breakdown",
    """SELECT s.prefecture, count(DISTINCT s.store_id) AS store_count, round(sum(m.sales_amount)::DOUBLE / 100000000, 2) AS sales_oku, round(sum(m.yoy_change)::DOUBLE / count(m.yoy_change) * 100, 1) AS avg_yoy_pct
    FROM s_stores s JOIN s_monthly m ON s.store_id = m.store_id WHERE year(m.month) = 2000 GROUP BY 1""",
)
def _(d: Data) -> DataFrame:
    return store.regional_breakdown(d.s_stores, d.s_monthly, YEAR)


@query(
    "b32_top_categories",
    """SELECT store_id, CAST(rn AS INT) AS rank, category_name, round(sales::DOUBLE / 10000, 0) AS sales_man FROM (
    SELECT *, row_number() OVER (PARTITION BY store_id ORDER BY sales DESC, category_name) AS rn FROM s_category_sales) WHERE rn <= 5""",
)
def _(d: Data) -> DataFrame:
    return store.top_categories(yearly_categories(d))


define(
    s_sheet_gaps="""
SELECT store_id,
  string_agg(CASE WHEN gap < 0 AND w <= 3 THEN category_name END, '|' ORDER BY w) AS worst,
  string_agg(CASE WHEN gap > 0 AND b <= 3 THEN category_name END, '|' ORDER BY b) AS best
FROM (SELECT *, row_number() OVER (PARTITION BY store_id ORDER BY gap, category_name) AS w,
    row_number() OVER (PARTITION BY store_id ORDER BY gap DESC, category_name DESC) AS b FROM s_gaps) GROUP BY store_id""",
    s_sheet_near="""
SELECT store_id, string_agg(CASE WHEN rn <= 5 THEN competitor_name END, '|' ORDER BY rn) AS near, count(*) AS competitors, count(*) FILTER (WHERE is_new_entry) AS new_competitors
FROM (SELECT *, row_number() OVER (PARTITION BY store_id ORDER BY distance_km, competitor_name) AS rn FROM s_competitors) GROUP BY store_id""",
    s_sheet_peers="""
SELECT store_id, string_agg(CAST(similar_store_id AS VARCHAR), '|' ORDER BY rn) AS growing
FROM (SELECT *, row_number() OVER (PARTITION BY store_id ORDER BY similarity_rank, similar_store_id) AS rn FROM s_peers WHERE yoy_pct > 0) WHERE rn <= 2 GROUP BY store_id""",
    s_sheet_bench="""
SELECT store_id, string_agg(category_name, '|' ORDER BY rn) AS bench
FROM (SELECT *, row_number() OVER (PARTITION BY store_id ORDER BY gap DESC, category_name) AS rn FROM s_benchmark) WHERE rn <= 5 GROUP BY store_id""",
    s_sheet_share="""
SELECT store_id, round(own / total * 100, 1) AS own_share FROM (
  SELECT store_id, sum(attr) AS total, sum(attr) FILTER (WHERE own) AS own FROM (
    SELECT store_id, true AS own, size_sqm::DOUBLE AS attr FROM s_stores UNION ALL
    SELECT store_id, false, CASE WHEN distance_km = 0 THEN size_sqm::DOUBLE ELSE size_sqm::DOUBLE / power(distance_km, 2) END FROM s_competitors) GROUP BY store_id)""",
    s_sheet_facilities="""
SELECT store_id, string_agg(facility_name, '|' ORDER BY rn) AS facilities
FROM (SELECT *, row_number() OVER (PARTITION BY store_id ORDER BY traffic_impact DESC NULLS LAST, facility_name) AS rn FROM s_facilities) WHERE rn <= 5 GROUP BY store_id""",
    s_sheet_measures="""
SELECT store_id, string_agg(description, '|' ORDER BY rn) AS measures, count(actual_effect) AS measured
FROM (SELECT *, row_number() OVER (PARTITION BY store_id ORDER BY start_date DESC NULLS LAST, measure_type, description) AS rn FROM s_measures) WHERE rn <= 5 GROUP BY store_id""",
)


@query(
    "b33_fact_sheet",
    """SELECT s.store_id, y.yoy_pct2 AS avg_yoy_pct, h.garden_man, h.construction_man, w.own_share, coalesce(f.facilities, '') AS facilities, coalesce(t.measures, '') AS measures, coalesce(t.measured, 0) AS measured, coalesce(g.worst, '') AS worst, coalesce(g.best, '') AS best, coalesce(n.near, '') AS near, coalesce(n.competitors, 0) AS competitors,
    coalesce(n.new_competitors, 0) AS new_competitors, coalesce(p.growing, '') AS growing, coalesce(b.bench, '') AS bench FROM s_stores s JOIN s_yearly y ON s.store_id = y.store_id
    LEFT JOIN s_sheet_gaps g ON s.store_id = g.store_id LEFT JOIN s_sheet_near n ON s.store_id = n.store_id LEFT JOIN s_sheet_peers p ON s.store_id = p.store_id LEFT JOIN s_sheet_bench b ON s.store_id = b.store_id
    LEFT JOIN s_spending_groups h ON s.store_id = h.store_id LEFT JOIN s_sheet_share w ON s.store_id = w.store_id LEFT JOIN s_sheet_facilities f ON s.store_id = f.store_id LEFT JOIN s_sheet_measures t ON s.store_id = t.store_id""",
)
def _(d: Data) -> DataFrame:
    per_store, near = yearly_categories(d), peers(d)
    kpis = store.store_kpis(d.s_stores, d.s_monthly, YEAR).select("store_id", "avg_yoy_pct")
    sheet = store.fact_sheet(
        kpis, store.category_gaps(per_store), d.s_competitors, near, store.benchmark_gaps(per_store, near),
        store.spending_of(d.s_spending), store.huff_share(d.s_stores, d.s_competitors), store.facilities_of(d.s_facilities), store.measures_of(d.s_measures),
    )

    def names(col: str, field: str):
        return F.coalesce(F.array_join(c(f"{col}.{field}").cast("array<string>"), "|"), F.lit(""))

    return sheet.select(
        "store_id", "avg_yoy_pct", names("worst_categories", "category_name").alias("worst"), names("best_categories", "category_name").alias("best"),
        names("near_competitors", "competitor_name").alias("near"), "competitors", "new_competitors",
        names("growing_peers", "similar_store_id").alias("growing"), names("benchmark_gaps", "category_name").alias("bench"),
        "household_spending.garden_man", "household_spending.construction_man", "own_share", names("facilities", "facility_name").alias("facilities"),
        names("measures", "description").alias("measures"),
        F.coalesce(F.size(F.filter("measures.actual_effect", lambda x: x.isNotNull())), F.lit(0)).cast("bigint").alias("measured"),
    )


# --- trends, sets and relations ---------------------------------------------------------------


@query("b34_yearly_sales", "SELECT * FROM r_yearly")
def _(d: Data) -> DataFrame:
    return retail.sales_by_period(d.order_times, F.year("order_datetime"), "order_year")


@query(
    "b34_monthly_sales",
    "SELECT strftime(order_datetime, '%Y-%m') AS order_month, sum(total_amount)::DOUBLE AS total_sales, count(order_id) AS order_count, count(DISTINCT user_id) AS unique_customers FROM r_heads GROUP BY 1",
)
def _(d: Data) -> DataFrame:
    return retail.sales_by_period(d.order_times, F.date_format("order_datetime", "yyyy-MM"), "order_month").orderBy("order_month")


def new_share_sql(period: str, name: str) -> str:
    return f"""SELECT {period} AS {name}, count(*) AS total_orders, sum(CASE WHEN is_first_order THEN 1 ELSE 0 END)::BIGINT AS new_orders,
    sum(CASE WHEN is_first_order THEN 1 ELSE 0 END)::DOUBLE / count(*) * 100 AS new_ratio_pct FROM r_heads h JOIN r_first f ON h.order_id = f.order_id GROUP BY 1"""


@query("b35_new_customer_share_by_year", new_share_sql("CAST(year(order_datetime) AS INT)", "order_year"))
def _(d: Data) -> DataFrame:
    return retail.new_customer_share(d.order_times, d.r_users, F.year("order_datetime"), "order_year")


@query("b35_new_customer_share_by_month", new_share_sql("strftime(order_datetime, '%Y-%m')", "order_month"))
def _(d: Data) -> DataFrame:
    return retail.new_customer_share(d.order_times, d.r_users, F.date_format("order_datetime", "yyyy-MM"), "order_month")


@query(
    "b36_seasonality",
    """SELECT order_month, total_sales::DOUBLE AS total_sales, total_sales::DOUBLE / (sum(total_sales) OVER ()::DOUBLE / count(*) OVER ()) AS ratio FROM (
    SELECT CAST(month(order_datetime) AS INT) AS order_month, sum(total_amount) AS total_sales FROM r_heads GROUP BY 1)""",
)
def _(d: Data) -> DataFrame:
    return retail.seasonality(d.order_times)


@query(
    "b37_customer_sets",
    """SELECT c.customer_id, coalesce(ch.primary_channel, 'なし') AS primary_channel, coalesce(ch.primary_channel = 'LINE', false) AS on_channel,
    coalesce(ch.primary_channel = 'LINE', false) AND coalesce(o.returns, 0) > 0 AS on_channel_with_return, coalesce(o.avg_amount, 0) > 250000 AS high_spend, coalesce(o.orders, 0) >= 12 AS repeat_buyer,
    coalesce(o.orders, 0) <= 6 AS low_order FROM c_customers c LEFT JOIN (SELECT customer_id, count(*) AS orders, sum(total_amount)::DOUBLE / count(*) AS avg_amount, sum(CASE WHEN returned THEN 1 ELSE 0 END) AS returns
    FROM c_orders GROUP BY 1) o ON c.customer_id = o.customer_id LEFT JOIN c_channel ch ON c.customer_id = ch.customer_id""",
)
def _(d: Data) -> DataFrame:
    return campaign.customer_sets(d.c_customers, d.c_orders, d.c_exposures, "LINE", high_spend=250_000, repeat=12, low=6)


@query(
    "b38_topic_by_channel",
    """SELECT coalesce(ch.primary_channel, 'なし') AS channel, count(*)::BIGINT AS cnt, round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM c_calls WHERE purpose = '割引クレーム'), 1) AS pct
    FROM c_calls k LEFT JOIN c_channel ch ON k.customer_id = ch.customer_id WHERE purpose = '割引クレーム' GROUP BY 1""",
)
def _(d: Data) -> DataFrame:
    return campaign.topic_by_channel(d.c_calls, d.c_exposures, c("purpose") == "割引クレーム")


@query(
    "b38_orders_by_resolution",
    """SELECT resolution_status = '解決' AS resolved, count(*)::BIGINT AS calls, sum(coalesce(o.n, 0))::DOUBLE / count(*) AS mean_orders FROM c_calls k LEFT JOIN (SELECT customer_id, count(*) AS n FROM c_orders GROUP BY 1) o
    ON k.customer_id = o.customer_id GROUP BY 1""",
)
def _(d: Data) -> DataFrame:
    return campaign.orders_by_resolution(d.c_calls, d.c_orders, c("resolution_status") == "解決")


@query(
    "b39_call_overview",
    """SELECT count(*) AS total_calls, min(call_date) AS earliest_call, max(call_date) AS latest_call, round(sum(call_duration_sec)::DOUBLE / count(*), 0) AS avg_duration_sec,
    count(DISTINCT customer_id) AS unique_customers, round(avg(length(transcript)), 0) AS avg_transcript_length FROM c_calls""",
)
def _(d: Data) -> DataFrame:
    return campaign.call_overview(d.c_raw_calls)


@query("b39_type_distribution", "SELECT inquiry_type, count(*) AS cnt, round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM documents), 1) AS pct FROM c_calls GROUP BY 1")
def _(d: Data) -> DataFrame:
    return campaign.type_distribution(d.c_raw_calls, "inquiry_type")


@query("b40_category_ranking", "SELECT category_id, sum(subtotal)::DOUBLE AS total_sales, sum(quantity)::BIGINT AS total_qty FROM r_lines GROUP BY 1")
def _(d: Data) -> DataFrame:
    lines = d.lineitem.selectExpr("l_partkey AS item_id", "CAST(l_quantity AS INT) AS quantity", "floor(l_extendedprice) AS subtotal")
    joined = lines.join(d.r_items.select("item_id", "category_id"), "item_id")
    out = joined.groupBy("category_id").agg(F.sum("subtotal").cast("double").alias("total_sales"), F.sum("quantity").alias("total_qty"))
    return out.orderBy(F.desc("total_sales"), "category_id")
