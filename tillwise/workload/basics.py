"""Scans, projections, ladders and scalar functions on the given tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import ladders as L
from ..functions import scalar as S
from ..operators import aggregates as A
from ..operators import filters as P
from ..plans import retail
from . import relations  # noqa: F401  (defines the SQL relations)
from .registry import query
from .tables import AS_OF, LIMITS, Data

# --- scans and constants ------------------------------------------------------------


@query("s11_scan_products", "SELECT p_partkey AS product_id, p_name AS name, p_type AS category, p_retailprice AS price FROM part")
def _(d: Data) -> DataFrame:
    return d.part.selectExpr("p_partkey AS product_id", "p_name AS name", "p_type AS category", "p_retailprice AS price")


@query("s15_geo_dim", "SELECT n_nationkey, n_name AS prefecture, latitude, longitude FROM nation LEFT JOIN c_geo ON n_name = prefecture")
def _(d: Data) -> DataFrame:
    places = d.nation.selectExpr("n_nationkey", "n_name AS prefecture")
    return places.join(d.c_geo, "prefecture", "left")


@query(
    "k09_table_counts",
    """SELECT 'customer' AS table_name, count(*) AS row_count FROM customer UNION ALL SELECT 'orders', count(*) FROM orders
    UNION ALL SELECT 'lineitem', count(*) FROM lineitem UNION ALL SELECT 'events', count(*) FROM events
    UNION ALL SELECT 'documents', count(*) FROM documents""",
)
def _(d: Data) -> DataFrame:
    return A.counts({n: d.table(n) for n in ("customer", "orders", "lineitem", "events", "documents")})


# --- projections, casts, filters ---------------------------------------------------------


@query("p01_select_columns", "SELECT o_orderdate, o_orderkey, o_custkey FROM orders")
def _(d: Data) -> DataFrame:
    return d.orders.select("o_orderdate", "o_orderkey", "o_custkey")


@query("p02_rename", "SELECT c_custkey AS user_id, c_name AS user_name, c_mktsegment AS segment FROM customer")
def _(d: Data) -> DataFrame:
    renamed = d.customer.withColumnsRenamed({"c_custkey": "user_id", "c_name": "user_name"})
    return renamed.select("user_id", "user_name", F.col("c_mktsegment").alias("segment"))


@query("p03_drop_columns", "SELECT l_orderkey, l_linenumber, l_quantity, l_shipdate FROM lineitem")
def _(d: Data) -> DataFrame:
    return d.lineitem.drop(
        "l_partkey", "l_suppkey", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"
    )


@query(
    "p04_cast_columns",
    """SELECT o_orderkey AS order_id, TRY_CAST(split_part(o_orderpriority, '-', 1) AS INT) AS priority_no,
    TRY_CAST(o_orderpriority AS INT) AS priority_bad, CAST(o_totalprice AS BIGINT) AS amount, CAST(o_orderdate AS DATE) AS order_date
    FROM (SELECT * REPLACE (floor(o_totalprice) AS o_totalprice) FROM orders)""",
)
def _(d: Data) -> DataFrame:
    text = d.orders.selectExpr(
        "o_orderkey AS order_id", "split_part(o_orderpriority, '-', 1) AS priority_no", "o_orderpriority AS priority_bad",
        "CAST(floor(o_totalprice) AS STRING) AS amount", "CAST(CAST(o_orderdate AS DATE) AS STRING) AS order_date",
    )
    return S.cast_columns(text, {"priority_no": "int", "priority_bad": "int", "amount": "bigint", "order_date": "date"})


@query(
    "p05_default_if_blank",
    """SELECT c_custkey, CASE WHEN pref IS NULL OR pref = '' THEN '不明' ELSE pref END AS pref
    FROM (SELECT c_custkey, CASE c_mktsegment WHEN 'HOUSEHOLD' THEN '' WHEN 'MACHINERY' THEN NULL ELSE c_mktsegment END AS pref FROM customer)""",
)
def _(d: Data) -> DataFrame:
    raw = d.customer.selectExpr(
        "c_custkey", "CASE c_mktsegment WHEN 'HOUSEHOLD' THEN '' WHEN 'MACHINERY' THEN NULL ELSE c_mktsegment END AS pref"
    )
    return raw.select("c_custkey", S.default_if_blank("pref", "不明").alias("pref"))


BOOL_TEXT = "CASE o_orderstatus WHEN 'F' THEN 'TRUE' WHEN 'O' THEN 'False' ELSE 'maybe' END"


@query(
    "p06_parse_bool",
    f"SELECT o_orderkey, CASE lower({BOOL_TEXT}) WHEN 'true' THEN true WHEN 'false' THEN false ELSE NULL END AS flag FROM orders",
)
def _(d: Data) -> DataFrame:
    return d.orders.select("o_orderkey", S.parse_bool(F.expr(BOOL_TEXT)).alias("flag"))


@query("p07_try_cast", "SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INT) AS k, TRY_CAST(event_type AS INT) AS none FROM events")
def _(d: Data) -> DataFrame:
    return d.events.select(
        "event_id", F.get_json_object("props", "$.k").try_cast("int").alias("k"), F.col("event_type").try_cast("int").alias("none")
    )


@query(
    "p08_filters",
    """SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus IN ('O', 'P') AND o_totalprice BETWEEN 50000 AND 200000
    AND o_orderpriority NOT IN ('5-LOW') AND o_orderpriority LIKE '%-%' AND o_orderdate >= TIMESTAMP '1997-01-01'""",
)
def _(d: Data) -> DataFrame:
    c = F.col
    return d.orders.filter(
        c("o_orderstatus").isin("O", "P") & c("o_totalprice").between(50000, 200000) & ~c("o_orderpriority").isin("5-LOW")
        & c("o_orderpriority").like("%-%") & (c("o_orderdate") >= F.lit(dt.date(1997, 1, 1)))
    ).select("o_orderkey", "o_totalprice")


@query(
    "p09_optional_filters",
    """SELECT order_id, customer_id, product_category FROM c_orders WHERE product_category IN ('1-URGENT', '2-HIGH')
    AND order_date BETWEEN DATE '1999-01-01' AND DATE '1999-12-31' AND order_channel = 'EC'""",
)
def _(d: Data) -> DataFrame:
    return P.apply_filters(
        d.c_orders,
        one_of={"product_category": ["1-URGENT", "2-HIGH"], "return_reason": None},
        between={"order_date": (dt.date(1999, 1, 1), dt.date(1999, 12, 31)), "total_amount": (None, None)},
        equals={"order_channel": "EC", "customer_id": None},
    ).select("order_id", "customer_id", "product_category")


@query(
    "p10_filter_by_aggregate",
    """SELECT store_id, month, CAST(sales_amount AS DOUBLE) AS sales_amount FROM s_monthly WHERE year(month) = 1997 AND store_id IN (
    SELECT store_id FROM s_monthly WHERE year(month) = 1997 GROUP BY 1 HAVING sum(yoy_change)::DOUBLE / count(yoy_change) >= -0.10 AND sum(yoy_change)::DOUBLE / count(yoy_change) < 0)""",
)
def _(d: Data) -> DataFrame:
    sales = d.s_monthly.filter(S.in_year("month", 1997))
    chosen = P.having_entity(sales, "store_id", L.health_class("yoy") == "caution", {"yoy": A.mean("yoy_change")})
    return chosen.select("store_id", "month", F.col("sales_amount").cast("double").alias("sales_amount"))


@query(
    "p11_flags",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS INT) AS is_returned,
    l_discount >= 0.05 AS is_discounted FROM lineitem""",
)
def _(d: Data) -> DataFrame:
    return d.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", P.flag(F.col("l_returnflag") == "R").alias("is_returned"),
        (F.col("l_discount") >= 0.05).alias("is_discounted"),
    )


@query("p12_preview", "SELECT doc_id, left(text, 200) AS preview FROM documents")
def _(d: Data) -> DataFrame:
    return d.documents.select("doc_id", S.preview("text", 200).alias("preview"))


# --- ladders ---------------------------------------------------------------------------------


@query("g01_rfm_scores", "SELECT user_id, recency, frequency, monetary, r_score, f_score, m_score FROM r_scored")
def _(d: Data) -> DataFrame:
    out = retail.rfm(d.order_times, AS_OF, LIMITS)
    return out.select("user_id", "recency", "frequency", F.col("monetary").cast("double").alias("monetary"), "r_score", "f_score", "m_score")


@query("g02_rfm_segment", "SELECT user_id, rfm_segment FROM r_segmented")
def _(d: Data) -> DataFrame:
    return retail.rfm(d.order_times, AS_OF, LIMITS).select("user_id", "rfm_segment")


@query(
    "g03_customer_type",
    """SELECT user_id, CASE WHEN count(DISTINCT order_id) <= 5 THEN '新規' ELSE '既存' END AS customer_type
    FROM r_heads GROUP BY user_id""",
)
def _(d: Data) -> DataFrame:
    counted = d.order_times.groupBy("user_id").agg(F.count_distinct("order_id").alias("frequency"))
    return counted.select("user_id", L.customer_type(new_upto=5).alias("customer_type"))


@query("g04_behavior_cluster", "SELECT user_id, behavior_cluster FROM r_clusters")
def _(d: Data) -> DataFrame:
    return retail.user_clusters(d.order_times, d.r_lines)


@query(
    "g05_cluster_name",
    "SELECT user_id, coalesce(label, 'ランダム') AS behavior_cluster_name FROM r_clusters LEFT JOIN r_cluster_names ON behavior_cluster = code",
)
def _(d: Data) -> DataFrame:
    return retail.user_clusters(d.order_times, d.r_lines).select("user_id", L.cluster_name().alias("behavior_cluster_name"))


@query("g06_order_customer_type", "SELECT order_id, CASE WHEN is_first_order THEN '新規' ELSE '既存' END AS customer_type FROM r_first")
def _(d: Data) -> DataFrame:
    return retail.first_order_flags(d.order_times, d.r_users).select("order_id", L.order_customer_type().alias("customer_type"))


@query(
    "g07_age_group3",
    """SELECT user_id, age, CASE WHEN age < 35 THEN '若年層' WHEN age < 55 THEN '中年層' ELSE 'シニア層' END AS age_group,
    CASE WHEN age IS NULL THEN '不明' WHEN age < 35 THEN '若年層' WHEN age < 55 THEN '中年層' ELSE 'シニア層' END AS age_group_known FROM t_users""",
)
def _(d: Data) -> DataFrame:
    return d.t_users.select("user_id", "age", L.age_group3("age").alias("age_group"), L.age_group3("age", "不明").alias("age_group_known"))


@query(
    "g08_age_group5",
    """SELECT customer_id, CASE WHEN age >= 60 THEN '60歳以上' ELSE CAST(age // 5 * 5 AS VARCHAR) || '-' || CAST(age // 5 * 5 + 4 AS VARCHAR) || '歳' END AS age_group
    FROM c_customers""",
)
def _(d: Data) -> DataFrame:
    return d.c_customers.select("customer_id", L.age_group5("age").alias("age_group"))


@query(
    "g09_alert_level",
    """SELECT store_id, month, CASE WHEN coalesce(yoy_change, 0) >= 0 THEN 'good' WHEN yoy_change > -0.10 THEN 'normal'
    WHEN yoy_change > -0.15 THEN 'warning' ELSE 'critical' END AS alert_level FROM s_monthly""",
)
def _(d: Data) -> DataFrame:
    return d.s_monthly.select("store_id", "month", L.alert_level("yoy_change").alias("alert_level"))


@query(
    "g10_health_class",
    "SELECT store_id, CASE WHEN yoy >= 0 THEN 'healthy' WHEN yoy >= -0.10 THEN 'caution' ELSE 'critical' END AS health FROM s_yearly",
)
def _(d: Data) -> DataFrame:
    from ..plans.store import yearly_sales

    return yearly_sales(d.s_monthly, 2000).select("store_id", L.health_class("yoy").alias("health"))


@query(
    "g11_resolution_group",
    """SELECT customer_id, CASE WHEN r >= 0.8 THEN '解決率80%以上' WHEN r >= 0.5 THEN '解決率50-79%' WHEN r > 0 THEN '解決率50%未満' ELSE '解決率0%' END AS grp,
    CASE WHEN r >= 0.8 THEN '解決率80%以上' WHEN r >= 0.5 THEN '解決率50-79%' WHEN r > 0 THEN '解決率50%未満' ELSE '通話なし' END AS grp_merged
    FROM (SELECT customer_id, avg(CASE WHEN resolution_status = '解決' THEN 1 ELSE 0 END) AS r FROM c_calls GROUP BY customer_id)""",
)
def _(d: Data) -> DataFrame:
    per = d.c_calls.groupBy("customer_id").agg(
        A.flag_rate(F.col("resolution_status") == "解決").alias("r"), F.count("*").alias("calls")
    )
    return per.select("customer_id", L.resolution_group("r", "calls").alias("grp"), L.resolution_group("r").alias("grp_merged"))


@query(
    "g12_recency_bands",
    """SELECT user_id, behavior_cluster, days,
    CASE WHEN days <= 7 THEN '0-7' WHEN days <= 14 THEN '8-14' WHEN days <= 30 THEN '15-30' WHEN days <= 60 THEN '31-60' ELSE '61+' END AS fixed_band,
    CASE WHEN days <= a THEN 'active' WHEN days <= i THEN 'intervention' WHEN days <= c THEN 'critical' ELSE 'churned' END AS cluster_band
    FROM (SELECT r.user_id, k.behavior_cluster, r.recency AS days FROM r_rfm r JOIN r_clusters k ON r.user_id = k.user_id)
    JOIN (VALUES ('1',7,14,21),('2',5,10,14),('3',10,14,21),('4',7,10,14),('5',3,7,10),('',14,21,30)) t(code,a,i,c) ON coalesce(behavior_cluster,'') = code""",
)
def _(d: Data) -> DataFrame:
    seg = retail.user_segments(d.order_times, d.r_lines, AS_OF, rfm_limits=LIMITS)
    return seg.select(
        "user_id", "behavior_cluster", F.col("recency").alias("days"), L.recency_band("recency").alias("fixed_band"),
        L.churn_band("recency", "behavior_cluster").alias("cluster_band"),
    )


@query(
    "g12_churn_report",
    """SELECT behavior_cluster, CASE WHEN days <= a THEN 'active' WHEN days <= i THEN 'intervention' WHEN days <= c THEN 'critical' ELSE 'churned' END AS band,
    count(*) AS users, sum(days)::DOUBLE / count(*) AS mean_days
    FROM (SELECT r.user_id, k.behavior_cluster, r.recency AS days FROM r_rfm r JOIN r_clusters k ON r.user_id = k.user_id)
    JOIN (VALUES ('1',7,14,21),('2',5,10,14),('3',10,14,21),('4',7,10,14),('5',3,7,10),('',14,21,30)) t(code,a,i,c) ON coalesce(behavior_cluster,'') = code GROUP BY 1, 2""",
)
def _(d: Data) -> DataFrame:
    return retail.churn_report(d.order_times, retail.user_clusters(d.order_times, d.r_lines), AS_OF)


@query(
    "g13_label_mapping",
    """SELECT facility_name, CASE facility_type WHEN '駅' THEN 'station' WHEN '学校' THEN 'school' WHEN '公園' THEN 'park' WHEN 'コンビニ' THEN 'convenience' ELSE 'other' END AS label
    FROM s_facilities""",
)
def _(d: Data) -> DataFrame:
    return d.s_facilities.select("facility_name", L.facility_label("facility_type").alias("label"))


# --- scalar functions ----------------------------------------------------------------------------


@query("d01_to_date", "SELECT event_id, CAST(ts AS DATE) AS d, TRY_CAST(event_type AS DATE) AS bad FROM events")
def _(d: Data) -> DataFrame:
    text = F.date_format("ts", "yyyy-MM-dd")
    return d.events.select("event_id", S.to_date_safe(text).alias("d"), S.to_date_safe("event_type").alias("bad"))


@query("d02_to_timestamp", "SELECT event_id, date_trunc('second', ts) AS t, event_type = '' AS bad FROM events")
def _(d: Data) -> DataFrame:
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    return d.events.select(
        "event_id", S.to_timestamp_safe(text).cast("timestamp_ntz").alias("t"), S.to_timestamp_safe("event_type").isNotNull().alias("bad")
    )


@query(
    "d03_format_date",
    """SELECT event_id, strftime(ts, '%Y-%m-%d') AS ymd, strftime(ts, '%Y-%m') AS ym, strftime(ts, '%Y') AS y, strftime(ts, '%H:%M:%S') AS hms FROM events""",
)
def _(d: Data) -> DataFrame:
    f = F.date_format
    return d.events.select(
        "event_id", f("ts", "yyyy-MM-dd").alias("ymd"), f("ts", "yyyy-MM").alias("ym"), f("ts", "yyyy").alias("y"), f("ts", "HH:mm:ss").alias("hms")
    )


@query("d04_hour", "SELECT CAST(hour(ts) AS INT) AS h, count(*) AS n FROM events GROUP BY 1")
def _(d: Data) -> DataFrame:
    return d.events.groupBy(F.hour("ts").alias("h")).agg(F.count("*").alias("n"))


@query("d05_day_of_week", "SELECT CAST(dayofweek(ts) + 1 AS INT) AS dow, count(*) AS n FROM events GROUP BY 1")
def _(d: Data) -> DataFrame:
    return d.events.groupBy(F.dayofweek("ts").alias("dow")).agg(F.count("*").alias("n"))


@query(
    "d06_buying_times",
    """SELECT event_id, dayofweek(ts) IN (0, 6) AS weekend, dayofweek(ts) NOT IN (0, 6) AND hour(ts) BETWEEN 16 AND 18 AS evening, hour(ts) >= 19 AS night FROM events""",
)
def _(d: Data) -> DataFrame:
    return d.events.select(
        "event_id", S.is_weekend("ts").alias("weekend"), S.is_weekday_evening("ts").alias("evening"), S.is_night("ts").alias("night")
    )


@query("d07_date_difference", "SELECT o_orderkey, CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-08-02') AS INT) AS days FROM orders")
def _(d: Data) -> DataFrame:
    return d.orders.select("o_orderkey", F.datediff(F.lit(AS_OF), F.to_date("o_orderdate")).alias("days"))


@query("d08_as_of_date", "SELECT c_custkey, DATE '2001-08-02' AS as_of FROM customer")
def _(d: Data) -> DataFrame:
    return d.customer.select("c_custkey", F.lit(AS_OF).alias("as_of"))


@query(
    "d09_truncate_date",
    "SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS m, CAST(date_trunc('week', o_orderdate) AS DATE) AS w FROM orders",
)
def _(d: Data) -> DataFrame:
    return d.orders.select("o_orderkey", S.month_start("o_orderdate").alias("m"), S.week_start("o_orderdate").alias("w"))


@query(
    "d10_year_filter",
    "SELECT CAST(month(o_orderdate) AS INT) AS m, count(*) AS n FROM orders WHERE year(o_orderdate) = 2000 GROUP BY 1",
)
def _(d: Data) -> DataFrame:
    return d.orders.filter(S.in_year("o_orderdate", 2000)).groupBy(F.month("o_orderdate").alias("m")).agg(F.count("*").alias("n"))


@query(
    "d11_split_time_stamp",
    "SELECT event_id, CAST(ts AS DATE) AS call_date, strftime(ts, '%H:%M:%S') AS call_time FROM events",
)
def _(d: Data) -> DataFrame:
    from ..plans.campaign import bronze_calls

    raw = d.events.select(F.col("event_id").alias("call_id"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("call_datetime"))
    return bronze_calls(raw).withColumnRenamed("call_id", "event_id")


@query(
    "d12_fiscal_year",
    """SELECT o_orderkey, CAST(fy AS INT) AS fy, make_date(fy, 3, 1) AS fy_start, CAST(make_date(fy + 1, 3, 1) - INTERVAL 1 DAY AS DATE) AS fy_end
    FROM (SELECT o_orderkey, CASE WHEN month(o_orderdate) >= 3 THEN year(o_orderdate) ELSE year(o_orderdate) - 1 END AS fy FROM orders)""",
)
def _(d: Data) -> DataFrame:
    start, end = S.fiscal_year_bounds("o_orderdate")
    return d.orders.select("o_orderkey", S.fiscal_year("o_orderdate").alias("fy"), start.alias("fy_start"), end.alias("fy_end"))


@query("m01_round", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(CAST(l_extendedprice AS DECIMAL(18,2)), 1)::DOUBLE AS r1, round(CAST(l_extendedprice AS DECIMAL(18,2)), 0)::DOUBLE AS r0 FROM lineitem")
def _(d: Data) -> DataFrame:
    x = S.money("l_extendedprice")
    return d.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.round(x, 1).cast("double").alias("r1"), F.round(x, 0).cast("double").alias("r0")
    )


@query(
    "m02_safe_rate",
    """SELECT l_suppkey, CASE WHEN n0 = 0 THEN NULL ELSE CAST(n1 AS DOUBLE) / n0 END AS r FROM (
    SELECT l_suppkey, sum(CASE WHEN l_discount = 0 AND l_returnflag = 'R' THEN 1 ELSE 0 END) AS n1,
    sum(CASE WHEN l_discount = 0 AND l_tax = 0.08 AND l_quantity > 45 THEN 1 ELSE 0 END) AS n0 FROM lineitem GROUP BY 1)""",
)
def _(d: Data) -> DataFrame:
    c = F.col
    per = d.lineitem.groupBy("l_suppkey").agg(
        F.sum(P.flag((c("l_discount") == 0) & (c("l_returnflag") == "R"))).alias("n1"),
        F.sum(P.flag((c("l_discount") == 0) & (c("l_tax") == 0.08) & (c("l_quantity") > 45))).alias("n0"),
    )
    return per.select("l_suppkey", S.rate("n1", "n0").alias("r"))


@query("m03_distance_decay", "SELECT p_partkey, p_retailprice / power(p_size, 2) AS pull FROM part")
def _(d: Data) -> DataFrame:
    return d.part.select("p_partkey", (F.col("p_retailprice") / F.power("p_size", F.lit(2))).alias("pull"))


@query("m04_unit_scaling", "SELECT o_orderkey, round(o_totalprice / 10000, 0) AS man, round(o_totalprice / 100000000, 4) AS oku, round(o_totalprice * 100.0, 2) AS pct FROM orders")
def _(d: Data) -> DataFrame:
    return d.orders.select(
        "o_orderkey", S.scaled("o_totalprice", 10_000).alias("man"), S.scaled("o_totalprice", 100_000_000, 4).alias("oku"),
        S.percent("o_totalprice", 2).alias("pct"),
    )


@query("m05_null_to_zero", "SELECT user_id, coalesce(age, 0) AS age FROM t_users")
def _(d: Data) -> DataFrame:
    return d.t_users.select("user_id", S.null_to_zero("age").alias("age"))


@query(
    "x01_text_basics",
    "SELECT doc_id, lower(text) AS low, length(text) AS n, left(text, 50) AS head, substring(text, 11, 20) AS mid FROM documents",
)
def _(d: Data) -> DataFrame:
    return d.documents.select(
        "doc_id", F.lower("text").alias("low"), F.length("text").cast("bigint").alias("n"), F.left("text", F.lit(50)).alias("head"),
        F.substring("text", 11, 20).alias("mid"),
    )


@query("x02_concat", "SELECT doc_id, '要約: ' || text AS prompt, lang || ' ' || source AS place FROM documents")
def _(d: Data) -> DataFrame:
    return d.documents.select("doc_id", F.concat(F.lit("要約: "), "text").alias("prompt"), F.concat_ws(" ", "lang", "source").alias("place"))


@query("x03_like", "SELECT user_id, email LIKE '%@%' AS ok FROM t_users")
def _(d: Data) -> DataFrame:
    return d.t_users.select("user_id", F.col("email").like("%@%").alias("ok"))


@query(
    "x04_split_list",
    """SELECT measure_id, CASE WHEN related_categories IS NULL THEN 0 ELSE CAST(len(string_split(related_categories, ',')) AS INT) END AS n,
    string_split(related_categories, ',')[1] AS first_part FROM s_measures""",
)
def _(d: Data) -> DataFrame:
    parts = S.split_list("related_categories")
    return d.s_measures.select("measure_id", F.size(parts).alias("n"), F.get(parts, F.lit(0)).alias("first_part"))


@query(
    "x05_mask_phone",
    r"SELECT doc_id, regexp_replace(text, '(\d{2,4})[- ](\d{3,4})-(\d{4})', '\1-XXXX-\3', 'g') AS masked FROM documents",
)
def _(d: Data) -> DataFrame:
    return d.documents.select("doc_id", S.mask_phone("text").alias("masked"))


@query("x06_struct_fields", "SELECT call_id, 'purpose' AS first_field, 2 AS n_fields, purpose, urgency_level FROM c_calls")
def _(d: Data) -> DataFrame:
    names = F.array(F.lit("purpose"), F.lit("urgency_level"))
    nested = d.c_calls.select("call_id", names.alias("names"), F.struct("purpose", "urgency_level").alias("extracted"))
    return nested.select("call_id", F.get("names", F.lit(0)).alias("first_field"), F.size("names").alias("n_fields"), "extracted.purpose", "extracted.urgency_level")


@query(
    "x07_parse_json",
    "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, json_extract_string(props, '$.k') AS k_text FROM events",
)
def _(d: Data) -> DataFrame:
    return d.events.select("event_id", F.from_json("props", "k bigint")["k"].alias("k"), F.get_json_object("props", "$.k").alias("k_text"))
