"""Joins, aggregations, windows, rankings and set operations on the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalar as S
from ..functions.ladders import ladder
from ..operators import aggregates as A
from ..operators import joins as J
from ..operators import sets as U
from ..operators import topk as T
from ..operators import windows as W
from ..plans import campaign, retail, shop, store
from ..session import scratch_path
from .registry import define, query
from .tables import AS_OF, YEAR, Data

c = F.col


def dbl(name: str):
    return c(name).cast("double").alias(name)


# --- joins ------------------------------------------------------------------------


@query("j01_left_join", "SELECT t.order_id, t.product_id, p.category FROM t_transactions t LEFT JOIN t_products p ON t.product_id = p.product_id")
def _(d: Data) -> DataFrame:
    return d.t_transactions.select("order_id", "product_id").join(d.t_products.select("product_id", "category"), "product_id", "left")


@query(
    "j02_enrich_order",
    """SELECT o_orderkey, o_custkey, c_name AS cust_name, c_mktsegment AS cust_segment, n_name AS nation
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey""",
)
def _(d: Data) -> DataFrame:
    people = J.enrich(d.customer, d.nation, {"c_nationkey": "n_nationkey"}, ["n_name"]).selectExpr(
        "c_custkey", "c_name AS name", "c_mktsegment AS segment", "n_name AS nation"
    )
    out = J.enrich(d.orders, people, {"o_custkey": "c_custkey"}, ["name", "segment", "nation"], prefix="cust_")
    return out.select("o_orderkey", "o_custkey", "cust_name", "cust_segment", c("cust_nation").alias("nation"))


@query(
    "j03_join_on_cast_key",
    """SELECT o_orderkey, code, c_name FROM (SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'x' || o_custkey ELSE CAST(o_custkey AS VARCHAR) END AS code FROM orders)
    LEFT JOIN customer ON TRY_CAST(code AS BIGINT) = c_custkey""",
)
def _(d: Data) -> DataFrame:
    coded = d.orders.selectExpr("o_orderkey", "IF(o_orderstatus = 'F', concat('x', o_custkey), CAST(o_custkey AS STRING)) AS code")
    return J.enrich(coded, d.customer, {"code": "c_custkey"}, ["c_name"], key_type="bigint")


@query("j04_inner_join", "SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment = 'BUILDING'")
def _(d: Data) -> DataFrame:
    chosen = d.customer.filter("c_mktsegment = 'BUILDING'").select(c("c_custkey").alias("o_custkey"), "c_name")
    return d.orders.select("o_orderkey", "o_custkey").join(chosen, "o_custkey").drop("o_custkey")


@query("j05_star_join", "SELECT order_id, customer_id, prefecture, latitude, campaign_channel, call_id, age_group FROM c_fact")
def _(d: Data) -> DataFrame:
    fact = campaign.dashboard_fact(d.c_orders, d.c_customers, d.c_exposures, d.c_calls, d.c_geo)
    return fact.select("order_id", "customer_id", "prefecture", "latitude", "campaign_channel", "call_id", "age_group")


@query(
    "j06_join_first",
    """SELECT c_custkey, o_orderkey, o_orderdate FROM customer LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn
    FROM orders) ON c_custkey = o_custkey AND rn = 1""",
)
def _(d: Data) -> DataFrame:
    right = d.orders.withColumnRenamed("o_custkey", "c_custkey")
    return J.join_first(d.customer.select("c_custkey"), right, "c_custkey", [c("o_orderdate").asc(), c("o_orderkey").asc()], ["o_orderkey", "o_orderdate"])


@query("j08_orphans", "SELECT order_id, user_id FROM t_transactions WHERE user_id NOT IN (SELECT user_id FROM t_users)")
def _(d: Data) -> DataFrame:
    return J.orphans(d.t_transactions, d.t_users, "user_id", "user_id").select("order_id", "user_id")


@query("j09_matched_marker", "SELECT order_id, product_id, user_id, has_user, has_product FROM t_enriched")
def _(d: Data) -> DataFrame:
    out = J.enrich(d.t_transactions, d.t_users, "user_id", [], matched="has_user")
    out = J.enrich(out, d.t_products, "product_id", [], matched="has_product")
    return out.select("order_id", "product_id", "user_id", "has_user", "has_product")


@query(
    "j10_preaggregated_join",
    """SELECT o.prefecture, o.orders, coalesce(k.calls, 0) AS calls FROM
    (SELECT prefecture, count(*) AS orders FROM c_orders JOIN c_customers USING (customer_id) GROUP BY 1) o LEFT JOIN
    (SELECT prefecture, count(*) AS calls FROM c_calls JOIN c_customers USING (customer_id) GROUP BY 1) k ON o.prefecture = k.prefecture""",
)
def _(d: Data) -> DataFrame:
    where = d.c_customers.select("customer_id", "prefecture")

    def by_place(df: DataFrame, name: str) -> DataFrame:
        per = df.groupBy("customer_id").agg(F.count("*").alias("n"))
        return per.join(where, "customer_id").groupBy("prefecture").agg(F.sum("n").alias(name))

    calls = by_place(d.c_raw_calls.select("customer_id"), "calls")
    return by_place(d.c_orders, "orders").join(calls, "prefecture", "left").withColumn("calls", S.null_to_zero("calls"))


@query(
    "j11_entity_vs_average",
    """SELECT s.l_suppkey, s.p_type, s.sales::DOUBLE AS sales, a.mean_sales, s.sales::DOUBLE - a.mean_sales AS gap,
    (s.sales::DOUBLE - a.mean_sales) / a.mean_sales AS gap_ratio FROM
    (SELECT l_suppkey, p_type, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS sales FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL) s JOIN
    (SELECT p_type, sum(CAST(l_extendedprice AS DECIMAL(18,2)))::DOUBLE / count(DISTINCT l_suppkey) AS mean_sales FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1) a USING (p_type)""",
)
def _(d: Data) -> DataFrame:
    kinds = d.part.select(c("p_partkey").alias("l_partkey"), "p_type")
    per_part = d.lineitem.groupBy("l_suppkey", "l_partkey").agg(F.sum(S.money("l_extendedprice")).alias("x"))
    per = per_part.join(kinds, "l_partkey").groupBy("l_suppkey", "p_type").agg(F.sum("x").alias("exact"))
    mean = per.groupBy("p_type").agg((F.sum("exact").cast("double") / F.count("*")).alias("mean_sales"))
    return J.vs_group(per.select("l_suppkey", "p_type", c("exact").cast("double").alias("sales")), ["p_type"], "sales", mean, "mean_sales")


@query("j12_similar_entities", "SELECT store_id, similar_store_id, store_name, prefecture, city, similarity_rank, similarity_score, yoy_pct, sales_man FROM s_peers")
def _(d: Data) -> DataFrame:
    return store.similar_kpis(d.s_similar, d.s_stores, d.s_monthly, YEAR)


# --- aggregations -------------------------------------------------------------------


@query(
    "a01_grouped_measures",
    """SELECT l_returnflag, l_linestatus, count(*) AS n, sum(CAST(l_quantity AS BIGINT))::BIGINT AS qty, sum(CAST(l_extendedprice AS DECIMAL(18,2)))::DOUBLE AS amount,
    sum(CAST(l_extendedprice AS DECIMAL(18,2)))::DOUBLE / count(l_extendedprice) AS mean_amount, min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship FROM lineitem GROUP BY 1, 2""",
)
def _(d: Data) -> DataFrame:
    priced = d.lineitem.withColumn("x", S.money("l_extendedprice"))
    return priced.groupBy("l_returnflag", "l_linestatus").agg(
        F.count("*").alias("n"), F.sum(c("l_quantity").cast("bigint")).alias("qty"), F.sum("x").cast("double").alias("amount"),
        A.mean("x").alias("mean_amount"), F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship"),
    )


@query("a02_count_distinct", "SELECT l_suppkey, count(DISTINCT l_orderkey) AS orders, count(DISTINCT l_partkey) AS parts FROM lineitem GROUP BY 1")
def _(d: Data) -> DataFrame:
    return d.lineitem.groupBy("l_suppkey").agg(F.count_distinct("l_orderkey").alias("orders"), F.count_distinct("l_partkey").alias("parts"))


@query(
    "a02_distinct_sketches",
    """SELECT 'quarter' AS grain, date_trunc('quarter', o_orderdate)::DATE AS start, count(DISTINCT o_custkey) AS customers, true AS estimate_within_5_percent FROM orders GROUP BY 2
    UNION ALL SELECT 'year', date_trunc('year', o_orderdate)::DATE, count(DISTINCT o_custkey), true FROM orders GROUP BY 2""",
)
def _(d: Data) -> DataFrame:
    """Three standard errors are 4.9 %; the estimates come from the stored sketches of months."""
    path = scratch_path(d.spark, "a02")
    orders = d.orders.select("o_custkey", F.to_date("o_orderdate").alias("day"))
    A.distinct_sketches(orders, [F.trunc("day", "month").alias("month")], "o_custkey").write.parquet(path)
    months = d.spark.read.parquet(path)
    out = None
    for grain in ("quarter", "year"):
        exact = orders.groupBy(F.trunc("day", grain).alias("start")).agg(F.count_distinct("o_custkey").alias("customers"))
        near = A.unite_sketches(months, [F.trunc("month", grain).alias("start")], "estimate")
        close = F.abs(c("estimate") - c("customers")) <= 0.05 * c("customers")
        part = exact.join(near, "start").select(F.lit(grain).alias("grain"), "start", "customers", close.alias("estimate_within_5_percent"))
        out = part if out is None else out.unionByName(part)
    return out


@query("a03_rfm_base", "SELECT user_id, last_purchase_date, frequency, monetary, recency FROM r_rfm")
def _(d: Data) -> DataFrame:
    return retail.rfm_base(d.order_times, AS_OF).withColumn("monetary", c("monetary").cast("double"))


@query(
    "a04_conditional_sums",
    """SELECT user_id, sum(CASE WHEN subcategory = 'PC本体' THEN quantity ELSE 0 END)::BIGINT AS pc_quantity,
    sum(CASE WHEN subcategory = '周辺機器' THEN quantity ELSE 0 END)::BIGINT AS peripheral_quantity,
    sum(CASE WHEN subcategory NOT IN ('PC本体', '周辺機器') THEN quantity ELSE 0 END)::BIGINT AS other_quantity FROM t_enriched GROUP BY user_id""",
)
def _(d: Data) -> DataFrame:
    tx = d.t_transactions.select("user_id", "product_id", "quantity").join(d.t_products.select("product_id", "subcategory"), "product_id", "left")
    return tx.groupBy("user_id").agg(*A.pivot_sums("quantity", "subcategory", shop.SUBCATEGORIES, shop.OTHER_QUANTITY))


@query("a05_order_rates", "SELECT user_id, total_orders, weekend_rate, weekday_evening_rate, night_rate FROM r_order_stats")
def _(d: Data) -> DataFrame:
    flags = {f"{n}_rate": p for n, p in retail.order_flags().items()}
    return A.rates(d.order_times, ["user_id"], flags, total="total_orders")


@query(
    "a05_item_rates",
    "SELECT user_id, total_items_purchased, favourite_rate, organic_premium_rate, discount_rate, ready_to_eat_rate FROM r_item_stats",
)
def _(d: Data) -> DataFrame:
    out = retail.item_stats(d.r_lines)
    return out.select("user_id", "total_items_purchased", "favourite_rate", "organic_premium_rate", "discount_rate", "ready_to_eat_rate")


@query("a06_flag_rate", "SELECT customer_id, round(avg(CASE WHEN returned THEN 1.0::DOUBLE ELSE 0 END), 4) AS return_rate FROM c_orders GROUP BY 1")
def _(d: Data) -> DataFrame:
    return d.c_orders.groupBy("customer_id").agg(A.flag_rate(c("returned")).alias("return_rate"))


@query("a07_ever_flag", "SELECT customer_id, CAST(max(CASE WHEN trouble_type = '割引条件' THEN 1 ELSE 0 END) AS INT) AS had_trouble FROM c_calls GROUP BY 1")
def _(d: Data) -> DataFrame:
    return d.c_calls.groupBy("customer_id").agg(A.ever(c("trouble_type") == "割引条件").alias("had_trouble"))


@query(
    "a08_first_value",
    """SELECT customer_id, arg_min_null(return_reason, k) AS first_reason, arg_min(return_reason, k) AS first_known_reason FROM
    (SELECT *, CAST(order_date - DATE '1990-01-01' AS BIGINT) * 100000000 + order_id AS k FROM c_orders) GROUP BY 1""",
)
def _(d: Data) -> DataFrame:
    at = ["order_date", "order_id"]
    first = A.first_by(d.c_orders, ["customer_id"], at, {"return_reason": "first_reason"})
    known = A.first_by(d.c_orders, ["customer_id"], at, {"return_reason": "first_known_reason"}, ignore_nulls=True)
    return first.join(known, "customer_id")


@query(
    "a09_global_kpis",
    """SELECT count(*) AS n, sum(total_amount)::DOUBLE AS revenue, sum(total_amount)::DOUBLE / count(total_amount) AS mean_amount, count(DISTINCT customer_id) AS customers FROM c_orders""",
)
def _(d: Data) -> DataFrame:
    return d.c_orders.agg(
        F.count("*").alias("n"), F.sum("total_amount").cast("double").alias("revenue"), A.mean("total_amount").alias("mean_amount"),
        F.count_distinct("customer_id").alias("customers"),
    )


@query("a10_share_of_total", "SELECT event_type, count(*) AS cnt, round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM events), 1) AS pct FROM events GROUP BY 1")
def _(d: Data) -> DataFrame:
    return A.with_share(d.events, ["event_type"])


@query("a11_mean_per_entity", "SELECT category_id, sum(sales)::DOUBLE / count(DISTINCT store_id) AS avg_sales FROM s_category_sales GROUP BY 1")
def _(d: Data) -> DataFrame:
    per = store.category_sales(d.s_by_category, d.s_categories, YEAR)
    return per.groupBy("category_id").agg((F.sum("sales").cast("double") / F.count_distinct("store_id")).alias("avg_sales"))


@query(
    "a12_aggregate_of_aggregate",
    "SELECT CASE WHEN yoy >= 0 THEN 'healthy' WHEN yoy >= -0.10 THEN 'caution' ELSE 'critical' END AS health, count(*) AS stores FROM s_yearly GROUP BY 1",
)
def _(d: Data) -> DataFrame:
    return store.health_distribution(d.s_monthly, YEAR)


@query("a13_group_by_expression", "SELECT coalesce(primary_channel, '直接') AS channel, count(*) AS n FROM c_customers LEFT JOIN c_channel USING (customer_id) GROUP BY 1")
def _(d: Data) -> DataFrame:
    joined = d.c_customers.join(campaign.primary_channel(d.c_exposures), "customer_id", "left")
    return joined.groupBy(F.coalesce("primary_channel", F.lit("直接")).alias("channel")).agg(F.count("*").alias("n"))


@query("a14_having", "SELECT store_id, sum(yoy_change)::DOUBLE / count(yoy_change) AS yoy FROM s_monthly WHERE year(month) = 1997 GROUP BY 1 HAVING yoy < -0.02")
def _(d: Data) -> DataFrame:
    sales = d.s_monthly.filter(S.in_year("month", 1997))
    return sales.groupBy("store_id").agg(A.mean("yoy_change").alias("yoy")).filter(c("yoy") < -0.02)


@query(
    "a15_derived_after_aggregation",
    """SELECT user_id, strftime(max(order_datetime), '%Y-%m-%d') AS last_date, strftime(max(order_datetime), '%Y-%m') AS last_month, strftime(max(order_datetime), '%Y') AS last_year,
    CASE WHEN count(*) >= 10 THEN 'many' ELSE 'few' END AS volume FROM r_heads GROUP BY 1""",
)
def _(d: Data) -> DataFrame:
    per = d.order_times.groupBy("user_id").agg(F.max("order_datetime").alias("last"), F.count("*").alias("n"))
    f = F.date_format
    return per.select(
        "user_id", f("last", "yyyy-MM-dd").alias("last_date"), f("last", "yyyy-MM").alias("last_month"), f("last", "yyyy").alias("last_year"),
        ladder([(c("n") >= 10, "many")], "few").alias("volume"),
    )


@query("a16_dict_aggregation", "SELECT category_id, sum(subtotal)::DOUBLE AS total_sales, sum(quantity)::BIGINT AS total_qty FROM r_lines GROUP BY 1")
def _(d: Data) -> DataFrame:
    lines = d.lineitem.selectExpr("l_partkey AS item_id", "CAST(l_quantity AS INT) AS quantity", "floor(l_extendedprice) AS subtotal")
    kinds = d.r_items.select("item_id", "category_id")
    out = A.dict_agg(lines.join(kinds, "item_id"), ["category_id"], {"subtotal": "sum", "quantity": "sum"}, {"subtotal": "total_sales", "quantity": "total_qty"})
    return out.withColumn("total_sales", c("total_sales").cast("double"))


# --- windows --------------------------------------------------------------------------


@query(
    "w01_dedup_latest",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_shipdate FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate DESC, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) AS rn FROM lineitem) WHERE rn = 1""",
)
def _(d: Data) -> DataFrame:
    out = W.dedup_latest(d.lineitem, ["l_orderkey", "l_linenumber"], ["l_shipdate"])
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate")


@query(
    "w01_dedup_report",
    """SELECT count(*) AS rows_before, count(DISTINCT (l_orderkey, l_linenumber)) AS rows_after, count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS rows_removed FROM lineitem""",
)
def _(d: Data) -> DataFrame:
    return W.dedup_report(d.lineitem, ["l_orderkey", "l_linenumber"])


@query("w02_event_sequence", "SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS seq FROM events")
def _(d: Data) -> DataFrame:
    events = d.events.select("event_id", "user_id", "ts")
    return W.event_sequence(events, "user_id", "ts", ["event_id"], bucket=F.to_date("ts")).drop("ts")


@query("w02_crowded_minutes", "SELECT o_orderkey, o_orderstatus, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderdate, o_orderkey) AS seq FROM orders")
def _(d: Data) -> DataFrame:
    """Orders of one status and day share a time; buckets of over 20 rows are cut into parts."""
    orders = d.orders.select("o_orderkey", "o_orderstatus", "o_orderdate")
    return W.event_sequence(orders, "o_orderstatus", "o_orderdate", ["o_orderkey"], bucket_rows=20).drop("o_orderdate")


@query("w03_first_order_flag", "SELECT order_id, is_first_order FROM r_first")
def _(d: Data) -> DataFrame:
    return retail.first_order_flags(d.order_times, d.r_users)


@query("w04_modal_value", "SELECT customer_id, primary_channel FROM c_channel")
def _(d: Data) -> DataFrame:
    return campaign.primary_channel(d.c_exposures)


@query(
    "w05_first_related",
    "SELECT customer_id, call_id, call_date FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY call_id) AS rn FROM c_calls) WHERE rn = 1",
)
def _(d: Data) -> DataFrame:
    return W.first_row(d.c_raw_calls.select("customer_id", "call_id", "call_date"), ["customer_id"], [c("call_id").asc()])


@query(
    "w06_market_share",
    """SELECT l_suppkey, p_type, sales::DOUBLE / sum(sales::DOUBLE) OVER (PARTITION BY p_type) * 100 > 1 AS above_one_pct, round(sales::DOUBLE / sum(sales) OVER (PARTITION BY p_type)::DOUBLE * 100, 1) AS share FROM
    (SELECT l_suppkey, p_type, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS sales FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL)""",
)
def _(d: Data) -> DataFrame:
    kinds = d.part.select(c("p_partkey").alias("l_partkey"), "p_type")
    lines = d.lineitem.select("l_suppkey", "l_partkey", S.money("l_extendedprice").alias("x")).join(kinds, "l_partkey")
    per = lines.groupBy("l_suppkey", "p_type").agg(F.sum("x").alias("sales"))
    shared = W.share_within(per, ["p_type"], "sales", "part")
    return shared.select("l_suppkey", "p_type", (c("part") * 100 > 1).alias("above_one_pct"), F.round(c("part") * 100.0, 1).alias("share"))


@query("w07_share_over_groups", "SELECT inquiry_type, count(*) AS cnt, round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (), 1) AS pct FROM c_calls GROUP BY 1")
def _(d: Data) -> DataFrame:
    return A.with_share(d.c_raw_calls, ["inquiry_type"])


define(
    r_yearly="""
SELECT CAST(year(order_datetime) AS INT) AS order_year, sum(total_amount)::DOUBLE AS total_sales, count(order_id) AS order_count, count(DISTINCT user_id) AS unique_customers
FROM r_heads GROUP BY 1"""
)


@query(
    "w08_growth",
    """SELECT a.order_year AS first_period, b.order_year AS last_period, a.total_sales AS first_value, b.total_sales AS last_value, b.total_sales / a.total_sales AS growth
    FROM r_yearly a, r_yearly b WHERE a.order_year = (SELECT min(order_year) FROM r_yearly) AND b.order_year = (SELECT max(order_year) FROM r_yearly)""",
)
def _(d: Data) -> DataFrame:
    yearly = retail.sales_by_period(d.order_times, F.year("order_datetime"), "order_year")
    return W.first_last_growth(yearly, "order_year", "total_sales")


@query(
    "w09_index_to_mean",
    """SELECT m, n, n / (SELECT avg(n) FROM (SELECT count(*) AS n FROM events GROUP BY hour(ts))) AS index FROM (SELECT CAST(hour(ts) AS INT) AS m, count(*) AS n FROM events GROUP BY 1)""",
)
def _(d: Data) -> DataFrame:
    hourly = d.events.groupBy(F.hour("ts").alias("m")).agg(F.count("*").alias("n"))
    return A.index_to_mean(hourly, "n")


# --- sort, limit, top-k -------------------------------------------------------------------


@query("t01_total_order", "SELECT p_partkey, p_retailprice, p_size FROM part ORDER BY p_retailprice DESC, p_size, p_partkey")
def _(d: Data) -> DataFrame:
    return d.part.select("p_partkey", "p_retailprice", "p_size").orderBy(c("p_retailprice").desc(), "p_size", "p_partkey")


@query(
    "t02_order_by_rank",
    "SELECT urgency_level, count(*) AS n FROM c_calls GROUP BY 1 ORDER BY CASE urgency_level WHEN '高' THEN 1 WHEN '中' THEN 2 ELSE 3 END",
)
def _(d: Data) -> DataFrame:
    level = c("urgency_level")
    return d.c_calls.groupBy("urgency_level").agg(F.count("*").alias("n")).orderBy(ladder([(level == "高", 1), (level == "中", 2)], 3))


@query("t03_order_by_position", "SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1 ORDER BY 2")
def _(d: Data) -> DataFrame:
    out = d.customer.groupBy("c_mktsegment").agg(F.count("*").alias("n"))
    return out.orderBy(out.columns[1])


@query("t04_limit", "SELECT doc_id, lang FROM documents ORDER BY doc_id LIMIT 10")
def _(d: Data) -> DataFrame:
    return d.documents.select("doc_id", "lang").orderBy("doc_id").limit(10)


@query("t05_top_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 15")
def _(d: Data) -> DataFrame:
    return T.top_k(d.orders.select("o_orderkey", "o_totalprice"), [c("o_totalprice").desc(), c("o_orderkey").asc()], 15)


define(
    s_ranked="""
SELECT s.store_id, s.store_name, s.prefecture, s.city, y.yoy_pct1 AS yoy_pct, round(y.sales / 10000, 0) AS sales_man, s.latitude, s.longitude
FROM s_stores s JOIN s_yearly y ON s.store_id = y.store_id""",
    s_ranking="""
SELECT * FROM (
  SELECT *, 'top' AS ranking, CAST(row_number() OVER (ORDER BY yoy_pct DESC NULLS LAST, store_id) AS INT) AS position FROM s_ranked
  UNION ALL SELECT *, 'bottom', CAST(row_number() OVER (ORDER BY yoy_pct NULLS FIRST, store_id DESC) AS INT) FROM s_ranked)
WHERE position <= 10""",
)


@query("t06_top_and_bottom", "SELECT * FROM s_ranking")
def _(d: Data) -> DataFrame:
    return store.store_ranking(d.s_stores, d.s_monthly, YEAR)


@query(
    "t07_top_k_per_group",
    """SELECT store_id, competitor_name, distance_km, CAST(rn AS INT) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY store_id ORDER BY distance_km, competitor_name) AS rn FROM s_competitors) WHERE rn <= 8""",
)
def _(d: Data) -> DataFrame:
    return store.competitors_of(d.s_competitors, 8).select("store_id", "competitor_name", "distance_km", "rank")


@query("t08_first_match", "SELECT store_id, similar_store_id FROM s_best_peer")
def _(d: Data) -> DataFrame:
    peers = store.similar_kpis(d.s_similar, d.s_stores, d.s_monthly, YEAR)
    return store.best_growing_peer(peers).select("store_id", "similar_store_id")


# --- set operations and sampling -------------------------------------------------------------


@query(
    "u01_tagged_union",
    "SELECT 'self' AS type, store_id, size_sqm, 0.0::DOUBLE AS distance_km FROM s_stores UNION ALL SELECT 'competitor', store_id, size_sqm, distance_km FROM s_competitors",
)
def _(d: Data) -> DataFrame:
    return U.union_tagged(
        {
            "self": d.s_stores.select("store_id", "size_sqm", F.lit(0.0).alias("distance_km")),
            "competitor": d.s_competitors.select("store_id", "size_sqm", "distance_km"),
        }
    )


EAST = "o_custkey % 2 = 0"


@query("u02_union", "SELECT o_orderkey, o_custkey FROM orders UNION ALL SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'F'")
def _(d: Data) -> DataFrame:
    return d.orders.select("o_orderkey", "o_custkey").union(d.orders.filter("o_orderstatus = 'F'").select("o_orderkey", "o_custkey"))


@query(
    "k04_two_flows_one_target",
    f"SELECT o_orderkey, o_custkey, CASE WHEN {EAST} THEN NULL ELSE o_orderpriority END AS o_orderpriority FROM orders",
)
def _(d: Data) -> DataFrame:
    east = d.orders.filter(EAST).select("o_orderkey", "o_custkey")
    west = d.orders.filter(f"NOT ({EAST})").select("o_orderkey", "o_custkey", "o_orderpriority")
    return U.union_flows([east, west])


@query("u03_distinct", "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem")
def _(d: Data) -> DataFrame:
    return d.lineitem.select("l_partkey", "l_suppkey").distinct()


@query("u04_key_difference", "SELECT DISTINCT user_id FROM t_transactions WHERE user_id NOT IN (SELECT user_id FROM t_users)")
def _(d: Data) -> DataFrame:
    return U.key_difference(d.t_transactions, d.t_users, "user_id", "user_id")


@query(
    "u05_exact_sample",
    "SELECT * FROM orders QUALIFY row_number() OVER (ORDER BY md5('7:' || o_orderkey), o_orderkey) <= (SELECT count(*) // 20 FROM orders)",
)
def _(d: Data) -> DataFrame:
    """Five percent of the orders, to the row."""
    return U.sample_exact(d.orders, d.orders.count() // 20, ["o_orderkey"], seed=7)


@query("u05_sample_size", "SELECT count(*) // 20 AS n, count(*) // 20 AS known_orders FROM orders")
def _(d: Data) -> DataFrame:
    picked = U.sample_exact(d.orders, d.orders.count() // 20, ["o_orderkey"], seed=7)
    known = picked.join(d.orders.select("o_orderkey"), "o_orderkey", "left_semi")
    return known.agg(F.count("*").alias("n"), F.count_distinct("o_orderkey").alias("known_orders"))
