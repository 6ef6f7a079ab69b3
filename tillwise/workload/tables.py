"""The given tables in the roles the jobs expect."""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ladders import RfmLimits
from ..functions.scalar import month_start
from ..operators.windows import same_period_last_year
from ..plans.store import SPENDING
from ..sources.constants import geo_dim

#: "today" of every recency measure: the day after the last order
AS_OF = dt.date(2001, 8, 2)
YEAR = 2000
#: score limits that suit the value ranges of the given orders
LIMITS = RfmLimits(recency=(100, 200, 400, 800), monetary=(3_000_000, 2_000_000, 1_000_000, 500_000))

#: coordinates for the first twenty nations; the others have none
GEO = [(f"NATION_{i}", 30.0 + i * 0.5, 130.0 + i * 0.25) for i in range(20)]

#: words that decide the extracted fields of a text
CALL_RULES = {
    "purpose": (
        [("token|password", "請求支払い"), ("nicht|auch", "返品交換"), ("avec|pour", "配送納期"), ("which|from", "割引クレーム"), ("para|los", "在庫確認")],
        "その他",
    ),
    "urgency_level": ([("that|dans", "高"), ("with|und", "中")], "低"),
    "trouble_type": ([("which|sur", "割引条件"), ("licen[cs]e|copyright", "品質"), ("have|aus", "サイズ")], "なし"),
    "next_intent": ([("are|est", "購入予定"), ("but|mit", "返品依頼")], "検討中"),
    "resolution_status": ([("@|token", "エスカレーション"), ("not|pas", "未解決")], "解決"),
}
CALL_COMPETITOR = "by the|de la"


class Data:
    """Lazily read tables of one directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        if name in (
            "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
            "embeddings", "pages", "benchmark", "labels", "conversations",
        ):
            return self.table(name)
        raise AttributeError(name)

    # --- retail ------------------------------------------------------------------

    @cached_property
    def r_users(self) -> DataFrame:
        return self.customer.selectExpr(
            "c_custkey AS user_id", "c_name AS name", "IF(c_custkey % 3 = 0, 'M', 'F') AS gender",
            "c_mktsegment AS status", "c_nationkey AS nation_id",
            "date_add(DATE'1995-01-01', CAST(c_custkey % 700 AS INT)) AS registration_date",
        )

    @cached_property
    def r_items(self) -> DataFrame:
        return self.part.selectExpr(
            "p_partkey AS item_id",
            "CASE p_type WHEN 'SMALL' THEN 600L WHEN 'PROMO' THEN 1100L WHEN 'ECONOMY' THEN 1200L "
            "WHEN 'LARGE' THEN 100L WHEN 'MEDIUM' THEN 200L ELSE 300L END AS category_id",
            "p_name AS item_name", "p_type AS category_name",
            "p_size % 3 = 0 AS is_organic", "p_size <= 25 AS is_discount_target",
            "p_type IN ('SMALL', 'MEDIUM', 'PROMO', 'LARGE') AS is_ready_to_eat", "p_retailprice >= 950 AS is_premium",
        )

    @cached_property
    def r_stores(self) -> DataFrame:
        return (
            self.supplier.join(self.nation, F.col("s_nationkey") == F.col("n_nationkey"))
            .selectExpr("s_suppkey AS store_id", "s_name AS store_name", "n_name AS store_area")
        )

    @cached_property
    def r_store_names(self) -> DataFrame:
        """The stores of a known area; a semi join keeps Spark's estimate of their size, which a join multiplies."""
        areas = self.nation.selectExpr("n_nationkey AS nation_id")
        return self.supplier.selectExpr("s_suppkey AS store_id", "s_name AS store_name", "s_nationkey AS nation_id").join(areas, "nation_id", "left_semi")

    @cached_property
    def r_store_areas(self) -> DataFrame:
        return self.nation.selectExpr("n_nationkey AS nation_id", "n_name AS store_area")

    @cached_property
    def order_times(self) -> DataFrame:
        """Orders with a time of day that follows the customer."""
        return self.orders.selectExpr(
            "o_orderkey AS order_id", "o_custkey AS user_id", "o_orderkey % 120 AS store_id",
            "o_orderdate + make_dt_interval(0, CAST(CASE o_custkey % 4 WHEN 0 THEN 16 + o_orderkey % 3 "
            "WHEN 1 THEN 19 + o_orderkey % 5 ELSE 9 + o_orderkey % 12 END AS INT), 0, 0) AS order_datetime",
            "floor(o_totalprice) AS total_amount",
            "CAST(o_orderkey % 15 + 1 AS INT) AS total_quantity", "o_orderstatus AS order_status",
        )

    @cached_property
    def r_orders(self) -> DataFrame:
        return self.order_times.join(self.r_stores, "store_id", "left")

    @cached_property
    def r_bare_lines(self) -> DataFrame:
        """Order lines as they are; the id of one is ten times the order's and its number."""
        return self.lineitem.selectExpr(
            "l_linenumber AS line_number", "l_orderkey AS order_id", "l_suppkey AS store_id", "l_partkey AS item_id",
            "CAST(l_quantity AS INT) AS quantity", "floor(l_extendedprice) AS subtotal", "l_returnflag = 'R' AS cancel_flg",
        )

    @cached_property
    def r_lines(self) -> DataFrame:
        """Order lines with user, item and store attributes.

        Orders come last, so that the rows lie by order for what joins them by order next.
        """
        lines = self.r_bare_lines.withColumn("order_item_id", F.expr("order_id * 10 + line_number")).drop("line_number")
        heads = self.order_times.select("order_id", "user_id", "order_datetime")
        named = lines.join(self.r_store_names, "store_id", "left").join(self.r_store_areas, "nation_id", "left")
        named = named.join(self.r_items, "item_id", "left")
        cols = dict.fromkeys(["store_id", "item_id", "order_id", *lines.columns, *heads.columns, *self.r_items.columns, *self.r_stores.columns])
        return named.join(heads, "order_id").select(*cols)

    # --- raw landing tables: all text, as delivered --------------------------------

    @cached_property
    def bz_users(self) -> DataFrame:
        return self.customer.selectExpr(
            "concat('U', lpad(CAST(c_custkey AS STRING), 8, '0')) AS user_id", "c_name AS name",
            "IF(c_custkey % 3 = 0, 'M', 'F') AS gender",
            "IF(c_mktsegment = 'BUILDING', 'n/a', CAST(date_add(DATE'1950-01-01', CAST(c_custkey % 18000 AS INT)) AS STRING)) AS birth_date",
            "CASE c_mktsegment WHEN 'HOUSEHOLD' THEN '' WHEN 'MACHINERY' THEN NULL ELSE c_mktsegment END AS pref",
            "concat('090-', lpad(CAST(c_custkey % 10000 AS STRING), 4, '0'), '-0000') AS phone_number",
            "concat(c_name, '@example.com') AS email", "IF(c_custkey % 4 = 0, 'True', 'False') AS email_permission_flg",
            "CAST(date_add(DATE'1995-01-01', CAST(c_custkey % 700 AS INT)) AS STRING) AS registration_date",
            "IF(c_acctbal < 1000, 'inactive', 'active') AS status",
            "IF(c_acctbal < 0, NULL, concat('2001-07-', lpad(CAST(c_custkey % 28 + 1 AS STRING), 2, '0'), ' 10:30:00')) AS last_login_at",
        )

    @cached_property
    def bz_items(self) -> DataFrame:
        flag = "IF({}, 'True', 'False')"
        return self.part.selectExpr(
            "CAST(p_partkey AS STRING) AS item_id", "CAST(p_size * 100 AS STRING) AS category_id", "p_name AS item_name",
            "p_type AS category_name", "CAST(CAST(floor(p_retailprice) AS BIGINT) AS STRING) AS price",
            "IF(p_size > 45, '', '2001-12-31') AS expiration_date", "'2001-01-15' AS arrival_date",
            f"{flag.format('p_size % 3 = 0')} AS is_organic", f"{flag.format('p_size <= 25')} AS is_discount_target",
            f"{flag.format('p_size > 30')} AS is_ready_to_eat", f"{flag.format('p_retailprice >= 950')} AS is_premium",
        )

    @cached_property
    def bz_stores(self) -> DataFrame:
        return self.supplier.join(self.nation, F.col("s_nationkey") == F.col("n_nationkey")).selectExpr(
            "CAST(s_suppkey AS STRING) AS store_id", "s_name AS store_name", "n_name AS store_area",
            "concat('street ', s_suppkey) AS address", "lpad(CAST(s_suppkey AS STRING), 7, '0') AS postal_code",
            "n_name AS prefecture", "concat('city ', s_nationkey) AS city", "'03-0000-0000' AS phone_number",
            "concat(s_name, '@example.com') AS email", "'9:00-21:00' AS business_hours", "CAST(NULL AS STRING) AS closed_days",
            "IF(s_acctbal < 0, 'none', CAST(s_suppkey * 10 AS STRING)) AS manager_id",
            "CAST(date_add(DATE'1990-01-01', CAST(s_suppkey % 3000 AS INT)) AS STRING) AS opening_date",
            "IF(s_acctbal < 0, 'INACTIVE', 'ACTIVE') AS status",
        )

    @cached_property
    def bz_orders(self) -> DataFrame:
        return self.order_times.selectExpr(
            "CAST(order_id AS STRING) AS order_id", "CAST(user_id AS STRING) AS user_id", "CAST(store_id AS STRING) AS store_id",
            "CAST(order_datetime AS STRING) AS order_datetime", "CAST(total_amount AS STRING) AS total_amount",
            "CAST(total_quantity AS STRING) AS total_quantity", "order_status",
        )

    @cached_property
    def bz_order_items(self) -> DataFrame:
        heads = self.order_times.select(F.col("order_id").alias("l_orderkey"), "user_id", "order_datetime")
        kinds = self.part.selectExpr("p_partkey AS l_partkey", "p_size * 100 AS category_id")
        return self.lineitem.join(heads, "l_orderkey").join(kinds, "l_partkey").selectExpr(
            "CAST(l_orderkey * 10 + l_linenumber AS STRING) AS order_item_id", "CAST(user_id AS STRING) AS user_id",
            "CAST(l_orderkey AS STRING) AS order_id", "CAST(l_suppkey AS STRING) AS store_id", "CAST(l_partkey AS STRING) AS item_id",
            "CAST(category_id AS STRING) AS category_id", "CAST(CAST(l_quantity AS INT) AS STRING) AS quantity",
            "CAST(CAST(floor(l_extendedprice / l_quantity) AS BIGINT) AS STRING) AS unit_price",
            "CAST(CAST(floor(l_extendedprice) AS BIGINT) AS STRING) AS subtotal", "IF(l_returnflag = 'R', 'True', 'False') AS cancel_flg",
            "CAST(order_datetime AS STRING) AS order_datetime", "l_shipdate AS _ingested_at",
        )

    # --- shop ----------------------------------------------------------------------

    @cached_property
    def t_transactions(self) -> DataFrame:
        lines = self.lineitem.selectExpr(
            "l_orderkey", "l_orderkey * 10 + l_linenumber AS order_id", "l_partkey AS product_id",
            "CAST(l_quantity - 1 AS INT) AS quantity", "IF(l_discount = 0, 0D, l_extendedprice) AS amount",
        )
        heads = self.orders.selectExpr("o_orderkey AS l_orderkey", "o_custkey AS user_id", "o_orderdate AS transaction_date")
        return lines.join(heads, "l_orderkey").drop("l_orderkey")

    @cached_property
    def t_users(self) -> DataFrame:
        """Customers known to the shop: one market segment is missing."""
        places = self.nation.join(self.region, F.col("n_regionkey") == F.col("r_regionkey")).selectExpr(
            "n_nationkey", "r_name AS region"
        )
        return (
            self.customer.filter("c_mktsegment <> 'HOUSEHOLD'")
            .join(places, F.col("c_nationkey") == F.col("n_nationkey"))
            .selectExpr(
                "c_custkey AS user_id", "c_name AS name",
                "CAST(IF(c_custkey % 11 = 0, NULL, 20 + c_custkey % 60) AS INT) AS age",
                "IF(c_custkey % 3 = 0, 'M', 'F') AS gender",
                "concat(c_name, IF(c_acctbal < 0, '.', '@'), 'example.com') AS email", "region",
            )
        )

    @cached_property
    def t_products(self) -> DataFrame:
        """Products on sale: one type is missing."""
        return self.part.filter("p_type <> 'PROMO'").selectExpr(
            "p_partkey AS product_id", "p_type AS category",
            "CASE WHEN p_size <= 15 THEN 'PC本体' WHEN p_size <= 35 THEN '周辺機器' WHEN p_size <= 45 THEN 'その他' END AS subcategory",
            "p_retailprice AS price",
        )

    # --- campaign and calls -------------------------------------------------------------

    @cached_property
    def c_customers(self) -> DataFrame:
        return self.customer.join(self.nation, F.col("c_nationkey") == F.col("n_nationkey")).selectExpr(
            "c_custkey AS customer_id", "c_name AS customer_name", "CAST(20 + c_custkey % 50 AS INT) AS age",
            "IF(c_custkey % 3 = 0, 'M', 'F') AS gender", "n_name AS prefecture", "c_mktsegment AS customer_segment",
            "IF(c_custkey % 4 = 0, '店舗', 'LINE') AS preferred_channel",
        )

    @cached_property
    def c_exposures(self) -> DataFrame:
        return self.events.selectExpr(
            "event_id AS exposure_id", "user_id AS customer_id", "CAST(ts AS DATE) AS exposure_date",
            "CASE event_type WHEN 'view' THEN 'LINE' WHEN 'click' THEN 'DM' WHEN 'purchase' THEN 'アプリ' "
            "WHEN 'signup' THEN 'Web広告' ELSE '店舗チラシ' END AS channel",
            "value > 50 AS clicked", "value > 150 AS converted",
        )

    @cached_property
    def c_orders(self) -> DataFrame:
        return self.orders.selectExpr(
            "o_orderkey AS order_id", "o_custkey AS customer_id", "CAST(o_orderdate AS DATE) AS order_date",
            "o_orderpriority AS product_category", "CAST(o_orderkey % 5 + 1 AS INT) AS quantity",
            "concat('product ', o_orderkey % 100) AS product_name", "IF(o_orderkey % 2 = 0, 'M', 'L') AS size",
            "floor(o_totalprice) div (o_orderkey % 5 + 1) AS unit_price",
            "CAST((o_orderkey % 4) * 0.05BD AS DECIMAL(8,2)) AS discount_applied",
            "floor(o_totalprice) AS total_amount", "IF(o_orderkey % 3 = 0, 'EC', '店舗') AS order_channel",
            "o_orderstatus = 'F' AS returned",
            "CASE WHEN o_orderstatus <> 'F' THEN NULL WHEN o_orderkey % 4 = 0 THEN '割引条件違い' "
            "WHEN o_orderkey % 4 = 1 THEN 'サイズ不一致' WHEN o_orderkey % 4 = 2 THEN 'イメージ違い' END AS return_reason",
        )

    @cached_property
    def c_raw_calls(self) -> DataFrame:
        return self.documents.selectExpr(
            "doc_id AS call_id", "doc_id div 2 AS customer_id",
            "date_add(DATE'2001-01-01', CAST(doc_id % 365 AS INT)) AS call_date",
            "CAST(n_chars % 600 + 60 AS INT) AS call_duration_sec", "lang AS inquiry_type", "text AS transcript",
        )

    @cached_property
    def c_calls(self) -> DataFrame:
        from ..operators.text import extract_fields

        fields = extract_fields(self.c_raw_calls, "transcript", CALL_RULES, CALL_COMPETITOR)
        return fields.select(
            "call_id", "customer_id", "call_date", "call_duration_sec", "inquiry_type", "extracted.*"
        )

    @cached_property
    def c_geo(self) -> DataFrame:
        return geo_dim(self.spark, GEO)

    # --- stores ----------------------------------------------------------------------------

    @cached_property
    def s_stores(self) -> DataFrame:
        return self.supplier.join(self.nation, F.col("s_nationkey") == F.col("n_nationkey")).selectExpr(
            "s_suppkey AS store_id", "s_name AS store_name", "n_name AS prefecture",
            "concat(n_name, '-', s_suppkey % 12) AS city", "CAST(500 + (s_suppkey % 40) * 50 AS INT) AS size_sqm",
            "IF(s_suppkey % 3 = 0, 'large', 'standard') AS store_type", "CAST(s_suppkey % 90 * 10 AS INT) AS parking_capacity",
            "24 + s_suppkey % 2000 / 100D AS latitude", "123 + s_suppkey % 2200 / 100D AS longitude",
        )

    @cached_property
    def s_monthly(self) -> DataFrame:
        """Sales per store and month, with the change against the same month a year ago."""
        month = month_start("l_shipdate")
        per = self.lineitem.groupBy(F.col("l_suppkey").alias("store_id"), month.alias("month")).agg(
            F.sum(F.floor("l_extendedprice")).alias("sales_amount"),
            F.count_distinct("l_orderkey").alias("customer_count"),
        )
        # a store has one row per calendar month, so its window stays small
        number = per.withColumn("mi", F.year("month") * 12 + F.month("month"))
        before = same_period_last_year("mi", "sales_amount", ["store_id"]).cast("double")
        now = F.col("sales_amount").cast("double")
        return number.select(
            "store_id", "month", "sales_amount", "customer_count",
            F.round((now - before) / before, 4).cast("decimal(12,4)").alias("yoy_change"),
            F.floor(now / F.col("customer_count")).alias("avg_basket"),
        )

    @cached_property
    def s_by_category(self) -> DataFrame:
        kinds = self.part.selectExpr("p_partkey AS l_partkey", "p_type AS category_id")
        return (
            self.lineitem.select("l_suppkey", "l_partkey", month_start("l_shipdate").alias("month"), F.floor("l_extendedprice").alias("x"))
            .join(kinds, "l_partkey")
            .groupBy(F.col("l_suppkey").alias("store_id"), "category_id", "month")
            .agg(F.sum("x").alias("sales_amount"))
        )

    @cached_property
    def s_categories(self) -> DataFrame:
        return self.part.selectExpr(
            "p_type AS category_id", "lower(p_type) AS category_name", "concat('spend_', length(p_type) % 4) AS expenditure_mapping"
        ).distinct()

    @cached_property
    def s_competitors(self) -> DataFrame:
        """One row per store and part it sells, the part in the role of a rival shop."""
        rival = self.part.selectExpr(
            "p_partkey", "concat(p_name, '#', p_partkey) AS competitor_name", "(p_size - 1) / 10D AS distance_km",
            "CAST(floor(p_retailprice) AS INT) AS size_sqm", "CAST(1990 + p_partkey % 36 AS INT) AS open_year",
            "p_partkey % 36 >= 34 AS is_new_entry",
        )
        pairs = self.lineitem.selectExpr("l_suppkey AS store_id", "l_partkey AS p_partkey").distinct()
        return pairs.join(rival, "p_partkey").drop("p_partkey")

    @cached_property
    def s_similar(self) -> DataFrame:
        return self.supplier.selectExpr("s_suppkey AS store_id", "explode(sequence(1, 5)) AS similarity_rank").selectExpr(
            "store_id", "store_id + similarity_rank AS similar_store_id", "similarity_rank",
            "(10 - similarity_rank) / 10D AS similarity_score",
        )

    @cached_property
    def s_facilities(self) -> DataFrame:
        return self.events.selectExpr(
            "user_id AS store_id",
            "CASE event_type WHEN 'view' THEN '駅' WHEN 'click' THEN '学校' WHEN 'purchase' THEN '公園' "
            "WHEN 'signup' THEN 'コンビニ' ELSE '倉庫' END AS facility_type",
            "concat('F', event_id) AS facility_name", "value AS distance_km", "value * 2 AS traffic_impact",
            "concat(event_id % 6 + 6, '-', event_id % 6 + 18) AS opening_hours",
        )

    @cached_property
    def s_measures(self) -> DataFrame:
        return self.orders.selectExpr(
            "o_custkey AS store_id", "o_orderkey AS measure_id", "o_orderpriority AS measure_type",
            "o_orderstatus AS status", "CAST(o_orderdate AS DATE) AS start_date",
            "IF(o_orderstatus = 'P', NULL, replace(o_orderpriority, '-', ',')) AS related_categories",
            "concat('measure ', o_orderkey) AS description", "o_orderkey % 30 / 100D AS expected_effect",
            "IF(o_orderstatus = 'F', o_orderkey % 25 / 100D, NULL) AS actual_effect",
            "date_add(CAST(o_orderdate AS DATE), 30) AS end_date", "CAST(floor(o_totalprice) AS BIGINT) AS investment_amount",
        )

    @cached_property
    def s_trade_area(self) -> DataFrame:
        return self.customer.selectExpr(
            "c_custkey AS store_id", "CAST(50000 + c_custkey % 1000 * 100 AS BIGINT) AS population_5km",
            "CAST(20000 + c_custkey % 700 * 30 AS BIGINT) AS households", "c_acctbal AS avg_income",
            "c_custkey % 40 / 100D AS elderly_rate", "c_custkey % 30 / 100D AS young_adult_rate",
            "c_custkey % 80 / 100D AS detached_house_rate", "c_custkey % 150 / 100D AS day_night_ratio", "c_custkey % 5000 AS num_businesses",
        )

    @cached_property
    def s_spending(self) -> DataFrame:
        """Spending of the households around a store, from its customers' stand-in."""
        base = "CAST(floor(abs(c_acctbal)) AS BIGINT) * 1000"
        kinds = [f"{base} DIV {k} AS {name}" for k, name in enumerate(SPENDING, 1)]
        return self.customer.selectExpr("c_custkey AS store_id", *kinds)
