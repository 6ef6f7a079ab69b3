"""The same roles as :mod:`tillwise.workload.tables`, stated in SQL for the checks."""

from __future__ import annotations

from .registry import define
from .tables import CALL_COMPETITOR, CALL_RULES, GEO


def case_regex(text: str, steps: list[tuple[str, str]], default: str) -> str:
    whens = " ".join(f"WHEN regexp_matches({text}, '{p}') THEN '{label}'" for p, label in steps)
    return f"CASE {whens} ELSE '{default}' END"


CALL_CASES = ",\n".join(f"{case_regex('text', *rule)} AS {name}" for name, rule in CALL_RULES.items())
GEO_VALUES = ", ".join(f"('{n}', {lat}::DOUBLE, {lon}::DOUBLE)" for n, lat, lon in GEO)

define(
    r_users="""
SELECT c_custkey AS user_id, c_name AS name, CASE WHEN c_custkey % 3 = 0 THEN 'M' ELSE 'F' END AS gender,
  c_mktsegment AS status, c_nationkey AS nation_id,
  CAST(DATE '1995-01-01' + CAST(c_custkey % 700 AS INT) AS DATE) AS registration_date
FROM customer""",
    r_items="""
SELECT p_partkey AS item_id,
  CAST(CASE p_type WHEN 'SMALL' THEN 600 WHEN 'PROMO' THEN 1100 WHEN 'ECONOMY' THEN 1200
    WHEN 'LARGE' THEN 100 WHEN 'MEDIUM' THEN 200 ELSE 300 END AS BIGINT) AS category_id,
  p_name AS item_name, p_type AS category_name, p_size % 3 = 0 AS is_organic, p_size <= 25 AS is_discount_target,
  p_type IN ('SMALL','MEDIUM','PROMO','LARGE') AS is_ready_to_eat, p_retailprice >= 950 AS is_premium
FROM part""",
    r_stores="""
SELECT s_suppkey AS store_id, s_name AS store_name, n_name AS store_area
FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    r_heads="""
SELECT o_orderkey AS order_id, o_custkey AS user_id, o_orderkey % 120 AS store_id,
  o_orderdate + to_hours(CAST(CASE o_custkey % 4 WHEN 0 THEN 16 + o_orderkey % 3 WHEN 1 THEN 19 + o_orderkey % 5
    ELSE 9 + o_orderkey % 12 END AS INT)) AS order_datetime,
  CAST(floor(o_totalprice) AS BIGINT) AS total_amount, CAST(o_orderkey % 15 + 1 AS INT) AS total_quantity,
  o_orderstatus AS order_status
FROM orders""",
    r_orders="SELECT h.*, s.store_name, s.store_area FROM r_heads h LEFT JOIN r_stores s ON h.store_id = s.store_id",
    r_lines="""
SELECT l_orderkey * 10 + l_linenumber AS order_item_id, l_orderkey AS order_id, l_suppkey AS store_id,
  l_partkey AS item_id, CAST(l_quantity AS INT) AS quantity, CAST(floor(l_extendedprice) AS BIGINT) AS subtotal,
  l_returnflag = 'R' AS cancel_flg, h.user_id, h.order_datetime, i.category_id, i.item_name, i.category_name,
  i.is_organic, i.is_discount_target, i.is_ready_to_eat, i.is_premium, s.store_name, s.store_area
FROM lineitem JOIN r_heads h ON l_orderkey = h.order_id LEFT JOIN r_items i ON l_partkey = i.item_id
  LEFT JOIN r_stores s ON l_suppkey = s.store_id""",
    r_rfm="""
SELECT user_id, max(CAST(order_datetime AS DATE)) AS last_purchase_date, count(DISTINCT order_id) AS frequency,
  CAST(sum(total_amount) AS DOUBLE) AS monetary,
  CAST(date_diff('day', max(CAST(order_datetime AS DATE)), DATE '2001-08-02') AS INT) AS recency
FROM r_heads GROUP BY user_id""",
    r_scored="""
SELECT *,
  CAST(CASE WHEN recency <= 100 THEN 5 WHEN recency <= 200 THEN 4 WHEN recency <= 400 THEN 3 WHEN recency <= 800 THEN 2 ELSE 1 END AS INT) AS r_score,
  CAST(CASE WHEN frequency >= 10 THEN 5 WHEN frequency >= 5 THEN 4 WHEN frequency >= 3 THEN 3 WHEN frequency >= 2 THEN 2 ELSE 1 END AS INT) AS f_score,
  CAST(CASE WHEN monetary >= 3000000 THEN 5 WHEN monetary >= 2000000 THEN 4 WHEN monetary >= 1000000 THEN 3 WHEN monetary >= 500000 THEN 2 ELSE 1 END AS INT) AS m_score
FROM r_rfm""",
    r_segmented="""
SELECT *,
  CASE WHEN r_score >= 4 AND f_score >= 4 AND m_score >= 4 THEN 'ロイヤル顧客'
    WHEN r_score >= 4 AND f_score >= 3 THEN '常連顧客' WHEN r_score >= 4 AND f_score <= 2 THEN '新規顧客'
    WHEN r_score <= 2 AND f_score >= 3 THEN '離脱リスク' WHEN r_score <= 2 AND f_score <= 2 THEN '休眠顧客'
    ELSE '一般顧客' END AS rfm_segment,
  CASE WHEN frequency = 1 THEN '新規' ELSE '既存' END AS customer_type
FROM r_scored""",
    r_order_stats="""
SELECT user_id, count(*) AS total_orders,
  CAST(sum(CASE WHEN dayofweek(order_datetime) IN (0, 6) THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS weekend_rate,
  CAST(sum(CASE WHEN dayofweek(order_datetime) NOT IN (0, 6) AND hour(order_datetime) BETWEEN 16 AND 18 THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS weekday_evening_rate,
  CAST(sum(CASE WHEN hour(order_datetime) >= 19 THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS night_rate,
  CAST(sum(total_quantity) AS DOUBLE) / count(*) AS avg_basket_size
FROM r_heads GROUP BY user_id""",
    r_item_stats="""
SELECT user_id, count(*) AS total_items_purchased,
  CAST(sum(CASE WHEN category_id IN (1100, 600, 1200) THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS favourite_rate,
  CAST(sum(CASE WHEN is_organic OR is_premium THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS organic_premium_rate,
  CAST(sum(CASE WHEN is_discount_target THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS discount_rate,
  CAST(sum(CASE WHEN is_ready_to_eat THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS ready_to_eat_rate
FROM r_lines GROUP BY user_id""",
    r_clusters="""
SELECT o.user_id,
  CASE WHEN weekday_evening_rate >= 0.7 AND ready_to_eat_rate >= 0.6 THEN '5'
    WHEN weekend_rate >= 0.8 AND avg_basket_size >= 10 THEN '1'
    WHEN night_rate >= 0.7 AND discount_rate >= 0.5 THEN '2'
    WHEN organic_premium_rate >= 0.6 THEN '3' WHEN favourite_rate >= 0.7 THEN '4' END AS behavior_cluster
FROM r_order_stats o LEFT JOIN r_item_stats i ON o.user_id = i.user_id""",
    r_cluster_names="""
SELECT * FROM (VALUES ('1','週末まとめ買い族'),('2','夜型値引きハンター'),('3','健康・こだわり層'),('4','カテゴリジャンキー'),('5','平日夕方の時短族')) t(code, label)""",
    r_first="""
SELECT h.order_id, row_number() OVER (PARTITION BY h.user_id ORDER BY h.order_datetime, h.order_id) = 1
  AND coalesce(date_diff('day', u.registration_date, CAST(h.order_datetime AS DATE)) <= 30, false) AS is_first_order
FROM r_heads h LEFT JOIN r_users u ON h.user_id = u.user_id""",
    t_transactions="""
SELECT l_orderkey * 10 + l_linenumber AS order_id, l_partkey AS product_id, CAST(l_quantity - 1 AS INT) AS quantity,
  CASE WHEN l_discount = 0 THEN 0 ELSE l_extendedprice END AS amount, o_custkey AS user_id, o_orderdate AS transaction_date
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    t_users="""
SELECT c_custkey AS user_id, c_name AS name, CAST(CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE 20 + c_custkey % 60 END AS INT) AS age,
  CASE WHEN c_custkey % 3 = 0 THEN 'M' ELSE 'F' END AS gender,
  c_name || CASE WHEN c_acctbal < 0 THEN '.' ELSE '@' END || 'example.com' AS email, r_name AS region
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
WHERE c_mktsegment <> 'HOUSEHOLD'""",
    t_products="""
SELECT p_partkey AS product_id, p_type AS category,
  CASE WHEN p_size <= 15 THEN 'PC本体' WHEN p_size <= 35 THEN '周辺機器' WHEN p_size <= 45 THEN 'その他' END AS subcategory,
  p_retailprice AS price
FROM part WHERE p_type <> 'PROMO'""",
    t_enriched="""
SELECT t.*, u.name AS user_name, u.age, u.gender, u.email, u.region, p.category, p.subcategory, p.price,
  u.user_id IS NOT NULL AS has_user, p.product_id IS NOT NULL AS has_product
FROM t_transactions t LEFT JOIN t_users u ON t.user_id = u.user_id LEFT JOIN t_products p ON t.product_id = p.product_id""",
    t_kept="SELECT * FROM t_enriched WHERE has_user AND has_product",
    c_customers="""
SELECT c_custkey AS customer_id, c_name AS customer_name, CAST(20 + c_custkey % 50 AS INT) AS age,
  CASE WHEN c_custkey % 3 = 0 THEN 'M' ELSE 'F' END AS gender, n_name AS prefecture, c_mktsegment AS customer_segment,
  CASE WHEN c_custkey % 4 = 0 THEN '店舗' ELSE 'LINE' END AS preferred_channel
FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    c_exposures="""
SELECT event_id AS exposure_id, user_id AS customer_id, CAST(ts AS DATE) AS exposure_date,
  CASE event_type WHEN 'view' THEN 'LINE' WHEN 'click' THEN 'DM' WHEN 'purchase' THEN 'アプリ' WHEN 'signup' THEN 'Web広告' ELSE '店舗チラシ' END AS channel,
  value > 50 AS clicked, value > 150 AS converted
FROM events""",
    c_orders="""
SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS order_date,
  o_orderpriority AS product_category, CAST(o_orderkey % 5 + 1 AS INT) AS quantity,
  'product ' || o_orderkey % 100 AS product_name, CASE WHEN o_orderkey % 2 = 0 THEN 'M' ELSE 'L' END AS size,
  CAST(floor(o_totalprice) AS BIGINT) // (o_orderkey % 5 + 1) AS unit_price,
  CAST((o_orderkey % 4) * 0.05 AS DECIMAL(8,2)) AS discount_applied, CAST(floor(o_totalprice) AS BIGINT) AS total_amount,
  CASE WHEN o_orderkey % 3 = 0 THEN 'EC' ELSE '店舗' END AS order_channel, o_orderstatus = 'F' AS returned,
  CASE WHEN o_orderstatus <> 'F' THEN NULL WHEN o_orderkey % 4 = 0 THEN '割引条件違い'
    WHEN o_orderkey % 4 = 1 THEN 'サイズ不一致' WHEN o_orderkey % 4 = 2 THEN 'イメージ違い' END AS return_reason
FROM orders""",
    c_calls=f"""
SELECT doc_id AS call_id, doc_id // 2 AS customer_id, CAST(DATE '2001-01-01' + CAST(doc_id % 365 AS INT) AS DATE) AS call_date,
  CAST(n_chars % 600 + 60 AS INT) AS call_duration_sec, lang AS inquiry_type, text AS transcript,
  {CALL_CASES},
  regexp_matches(text, '{CALL_COMPETITOR}') AS competitor_mention, left(string_split(text, chr(10))[1], 20) AS operator_action
FROM documents""",
    c_geo=f"SELECT * FROM (VALUES {GEO_VALUES}) t(prefecture, latitude, longitude)",
    c_channel="""
SELECT customer_id, channel AS primary_channel FROM (
  SELECT customer_id, channel, row_number() OVER (PARTITION BY customer_id ORDER BY count(*) DESC, channel) AS rn
  FROM c_exposures GROUP BY customer_id, channel) WHERE rn = 1""",
    c_fact="""
SELECT o.order_id, o.order_date, CAST(date_trunc('month', o.order_date) AS DATE) AS order_month,
  CAST(date_trunc('week', o.order_date) AS DATE) AS order_week, CAST(dayofweek(o.order_date) + 1 AS INT) AS order_dow,
  o.product_category, o.product_name, o.size, o.unit_price, c.preferred_channel, k.operator_action, o.order_channel, o.quantity, CAST(o.discount_applied AS DOUBLE) AS discount_applied, o.total_amount, o.returned,
  o.return_reason, c.customer_id, c.customer_name, c.age,
  CASE WHEN c.age < 25 THEN '20-24歳' WHEN c.age < 30 THEN '25-29歳' WHEN c.age < 35 THEN '30-34歳' WHEN c.age < 40 THEN '35-39歳'
    WHEN c.age < 45 THEN '40-44歳' WHEN c.age < 50 THEN '45-49歳' WHEN c.age < 55 THEN '50-54歳' WHEN c.age < 60 THEN '55-59歳'
    ELSE '60歳以上' END AS age_group,
  c.gender, c.prefecture, c.customer_segment, g.latitude, g.longitude, coalesce(ch.primary_channel, '直接') AS campaign_channel,
  k.call_id, k.purpose AS call_purpose, k.urgency_level, k.trouble_type, k.competitor_mention, k.next_intent, k.resolution_status,
  CAST(CASE WHEN k.trouble_type = '割引条件' THEN 1 ELSE 0 END AS INT) AS has_discount_trouble,
  CAST(CASE WHEN k.competitor_mention THEN 1 ELSE 0 END AS INT) AS has_competitor_mention
FROM c_orders o JOIN c_customers c ON o.customer_id = c.customer_id
  LEFT JOIN c_geo g ON c.prefecture = g.prefecture
  LEFT JOIN c_channel ch ON o.customer_id = ch.customer_id
  LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY call_id) AS rn FROM c_calls) k
    ON o.customer_id = k.customer_id AND k.rn = 1""",
    c_journey="""
SELECT c.customer_id, c.customer_name, c.age, c.gender, c.prefecture, c.customer_segment, c.preferred_channel,
  coalesce(o.order_count, 0) AS order_count, coalesce(o.total_spend, 0) AS total_spend, o.avg_order_amount, o.avg_discount,
  coalesce(o.return_count, 0) AS return_count, coalesce(o.return_rate, 0) AS return_rate, o.primary_return_reason, o.top_category,
  coalesce(e.exposure_count, 0) AS exposure_count, coalesce(e.click_count, 0) AS click_count,
  coalesce(e.conversion_count, 0) AS conversion_count, coalesce(e.click_rate, 0) AS click_rate, e.primary_exposure_channel,
  coalesce(k.call_count, 0) AS call_count, k.avg_call_duration, k.primary_call_purpose, k.primary_trouble_type,
  coalesce(k.had_competitor_mention, 0) AS had_competitor_mention, coalesce(k.had_discount_trouble, 0) AS had_discount_trouble,
  coalesce(k.had_urgency_call, 0) AS had_urgency_call, k.primary_urgency_level, k.latest_intent, k.resolution_rate
FROM c_customers c
LEFT JOIN (
  SELECT a.*, t.top_category, r.primary_return_reason FROM (
    SELECT customer_id, count(DISTINCT order_id) AS order_count, CAST(sum(total_amount) AS DOUBLE) AS total_spend,
      CAST(sum(total_amount) AS DOUBLE) / count(total_amount) AS avg_order_amount,
      CAST(sum(discount_applied) AS DOUBLE) / count(discount_applied) AS avg_discount,
      CAST(sum(CASE WHEN returned THEN 1 ELSE 0 END) AS BIGINT) AS return_count,
      round(avg(CASE WHEN returned THEN 1.0::DOUBLE ELSE 0 END), 4) AS return_rate
    FROM c_orders GROUP BY customer_id) a
  LEFT JOIN (SELECT customer_id, product_category AS top_category, row_number() OVER (PARTITION BY customer_id ORDER BY count(*) DESC, product_category) AS rn
    FROM c_orders GROUP BY customer_id, product_category) t ON a.customer_id = t.customer_id AND t.rn = 1
  LEFT JOIN (SELECT customer_id, return_reason AS primary_return_reason, row_number() OVER (PARTITION BY customer_id ORDER BY order_date, order_id) AS rn
    FROM c_orders WHERE return_reason IS NOT NULL) r ON a.customer_id = r.customer_id AND r.rn = 1
) o ON c.customer_id = o.customer_id
LEFT JOIN (
  SELECT x.*, ch.primary_channel AS primary_exposure_channel FROM (
    SELECT customer_id, count(DISTINCT exposure_id) AS exposure_count, CAST(sum(CASE WHEN clicked THEN 1 ELSE 0 END) AS BIGINT) AS click_count,
      CAST(sum(CASE WHEN converted THEN 1 ELSE 0 END) AS BIGINT) AS conversion_count, round(avg(CASE WHEN clicked THEN 1.0::DOUBLE ELSE 0 END), 4) AS click_rate
    FROM c_exposures GROUP BY customer_id) x JOIN c_channel ch ON x.customer_id = ch.customer_id
) e ON c.customer_id = e.customer_id
LEFT JOIN (
  SELECT y.*, p.v AS primary_call_purpose, q.v AS primary_trouble_type, u.v AS primary_urgency_level, l.v AS latest_intent FROM (
    SELECT customer_id, count(DISTINCT call_id) AS call_count, CAST(sum(call_duration_sec) AS DOUBLE) / count(*) AS avg_call_duration,
      CAST(max(CASE WHEN competitor_mention THEN 1 ELSE 0 END) AS INT) AS had_competitor_mention,
      CAST(max(CASE WHEN trouble_type = '割引条件' THEN 1 ELSE 0 END) AS INT) AS had_discount_trouble,
      CAST(max(CASE WHEN urgency_level = '高' THEN 1 ELSE 0 END) AS INT) AS had_urgency_call,
      round(avg(CASE WHEN resolution_status = '解決' THEN 1.0::DOUBLE ELSE 0 END), 4) AS resolution_rate
    FROM c_calls GROUP BY customer_id) y
  JOIN (SELECT customer_id, purpose AS v, row_number() OVER (PARTITION BY customer_id ORDER BY count(*) DESC, purpose) AS rn FROM c_calls GROUP BY customer_id, purpose) p ON y.customer_id = p.customer_id AND p.rn = 1
  JOIN (SELECT customer_id, trouble_type AS v, row_number() OVER (PARTITION BY customer_id ORDER BY count(*) DESC, trouble_type) AS rn FROM c_calls GROUP BY customer_id, trouble_type) q ON y.customer_id = q.customer_id AND q.rn = 1
  JOIN (SELECT customer_id, urgency_level AS v, row_number() OVER (PARTITION BY customer_id ORDER BY count(*) DESC, urgency_level) AS rn FROM c_calls GROUP BY customer_id, urgency_level) u ON y.customer_id = u.customer_id AND u.rn = 1
  JOIN (SELECT customer_id, next_intent AS v, row_number() OVER (PARTITION BY customer_id ORDER BY call_date DESC, call_id DESC) AS rn FROM c_calls) l ON y.customer_id = l.customer_id AND l.rn = 1
) k ON c.customer_id = k.customer_id""",
    s_stores="""
SELECT s_suppkey AS store_id, s_name AS store_name, n_name AS prefecture, n_name || '-' || (s_suppkey % 12) AS city, CAST(500 + (s_suppkey % 40) * 50 AS INT) AS size_sqm,
  CASE WHEN s_suppkey % 3 = 0 THEN 'large' ELSE 'standard' END AS store_type, CAST(s_suppkey % 90 * 10 AS INT) AS parking_capacity,
  24 + s_suppkey % 2000 / 100.0::DOUBLE AS latitude, 123 + s_suppkey % 2200 / 100.0::DOUBLE AS longitude
FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    s_monthly="""
SELECT store_id, month, sales_amount, customer_count,
  CAST(round((sales_amount::DOUBLE - before::DOUBLE) / before::DOUBLE, 4) AS DECIMAL(12,4)) AS yoy_change,
  CAST(floor(sales_amount::DOUBLE / customer_count) AS BIGINT) AS avg_basket
FROM (
  SELECT *, first(sales_amount) OVER (PARTITION BY store_id ORDER BY mi RANGE BETWEEN 12 PRECEDING AND 12 PRECEDING) AS before
  FROM (SELECT l_suppkey AS store_id, CAST(date_trunc('month', l_shipdate) AS DATE) AS month,
      sum(CAST(floor(l_extendedprice) AS BIGINT)) AS sales_amount, count(DISTINCT l_orderkey) AS customer_count,
      CAST(year(date_trunc('month', l_shipdate)) * 12 + month(date_trunc('month', l_shipdate)) AS INT) AS mi
    FROM lineitem GROUP BY ALL))""",
    s_yearly="""
SELECT *, sign(s) * ((2 * abs(s) + n) // (2 * n)) / 100.0::DOUBLE AS yoy_pct2, sign(s) * ((2 * abs(s) + 10 * n) // (20 * n)) / 10.0::DOUBLE AS yoy_pct1,
  sign(s) * ((2 * abs(s) + 10 * n) // (20 * n)) / 1000.0::DOUBLE AS yoy3 FROM (
SELECT store_id, CAST(sum(yoy_change) AS DOUBLE) / count(yoy_change) AS yoy, CAST(sum(sales_amount) AS DOUBLE) AS sales,
  CAST(sum(customer_count) AS DOUBLE) / count(*) AS customers, CAST(sum(avg_basket) AS DOUBLE) / count(avg_basket) AS basket, count(*) AS months,
  sum(CAST(yoy_change * 10000 AS BIGINT)) AS s, nullif(count(yoy_change), 0) AS n
FROM s_monthly WHERE year(month) = 2000 GROUP BY store_id)""",
    s_category_sales="""
SELECT l_suppkey AS store_id, p_type AS category_id, lower(p_type) AS category_name, 'spend_' || (length(p_type) % 4) AS expenditure_mapping, sum(CAST(floor(l_extendedprice) AS BIGINT)) AS sales
FROM lineitem JOIN part ON l_partkey = p_partkey WHERE year(l_shipdate) = 2000 GROUP BY ALL""",
    s_gaps="""
SELECT a.store_id, a.category_name, a.expenditure_mapping, round(a.sales::DOUBLE / 10000, 0) AS store_sales, round(b.avg_sales / 10000, 0) AS avg_sales_man,
  round((a.sales::DOUBLE - b.avg_sales) / 10000, 0) AS gap, round((a.sales::DOUBLE - b.avg_sales) / b.avg_sales * 100, 1) AS gap_pct
FROM s_category_sales a JOIN (SELECT category_id, sum(sales)::DOUBLE / count(DISTINCT store_id) AS avg_sales FROM s_category_sales GROUP BY category_id) b
  ON a.category_id = b.category_id""",
    s_competitors="""
SELECT DISTINCT l_suppkey AS store_id, p_name || '#' || p_partkey AS competitor_name, (p_size - 1) / 10.0::DOUBLE AS distance_km,
  CAST(floor(p_retailprice) AS INT) AS size_sqm, CAST(1990 + p_partkey % 36 AS INT) AS open_year, p_partkey % 36 >= 34 AS is_new_entry
FROM lineitem JOIN part ON l_partkey = p_partkey""",
    s_similar="""
SELECT s_suppkey AS store_id, CAST(r AS INT) AS similarity_rank, s_suppkey + r AS similar_store_id, (10 - r) / 10.0::DOUBLE AS similarity_score
FROM supplier, range(1, 6) t(r)""",
    s_peers="""
SELECT m.store_id, m.similar_store_id, s.store_name, s.prefecture, s.city, m.similarity_rank, m.similarity_score,
  y.yoy_pct1 AS yoy_pct, round(y.sales / 10000, 0) AS sales_man
FROM s_similar m JOIN s_stores s ON m.similar_store_id = s.store_id JOIN s_yearly y ON m.similar_store_id = y.store_id""",
    s_best_peer="""
SELECT store_id, similar_store_id FROM (SELECT *, row_number() OVER (PARTITION BY store_id ORDER BY similarity_rank, similar_store_id) AS rn
  FROM s_peers WHERE yoy_pct > 0) WHERE rn = 1""",
    s_benchmark="""
SELECT a.store_id, p.similar_store_id, a.category_name, round(a.sales::DOUBLE / 10000, 0) AS target, round(b.sales::DOUBLE / 10000, 0) AS benchmark,
  round((b.sales::DOUBLE - a.sales::DOUBLE) / 10000, 0) AS gap
FROM s_category_sales a JOIN s_best_peer p ON a.store_id = p.store_id
  JOIN s_category_sales b ON b.store_id = p.similar_store_id AND a.category_name = b.category_name""",
    s_facilities="""
SELECT user_id AS store_id, CASE event_type WHEN 'view' THEN '駅' WHEN 'click' THEN '学校' WHEN 'purchase' THEN '公園' WHEN 'signup' THEN 'コンビニ' ELSE '倉庫' END AS facility_type,
  'F' || event_id AS facility_name, value AS distance_km, value * 2 AS traffic_impact,
  (event_id % 6 + 6) || '-' || (event_id % 6 + 18) AS opening_hours
FROM events""",
    s_measures="""
SELECT o_custkey AS store_id, o_orderkey AS measure_id, o_orderpriority AS measure_type, o_orderstatus AS status, CAST(o_orderdate AS DATE) AS start_date,
  CASE WHEN o_orderstatus = 'P' THEN NULL ELSE replace(o_orderpriority, '-', ',') END AS related_categories,
  'measure ' || o_orderkey AS description, o_orderkey % 30 / 100.0::DOUBLE AS expected_effect, CASE WHEN o_orderstatus = 'F' THEN o_orderkey % 25 / 100.0::DOUBLE END AS actual_effect,
  CAST(o_orderdate AS DATE) + 30 AS end_date, CAST(floor(o_totalprice) AS BIGINT) AS investment_amount
FROM orders""",
)
