"""Plans and results under a hot key that holds most rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tillwise.functions.scalar import in_year
from tillwise.operators import skew as J
from tillwise.operators import topk as T
from tillwise.operators import windows as W


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def skewed(spark):
    """20,000 rows, half of them of key 0."""
    return spark.range(20_000).select(
        F.col("id"), F.when(F.col("id") % 2 == 0, F.lit(0)).otherwise(F.col("id") % 997).alias("k"),
        (F.timestamp_seconds(F.lit(1_700_000_000) + F.hash("id") % 5_000_000)).cast("timestamp_ntz").alias("ts"),
    )


def test_first_rows_limit_before_the_shuffle(skewed):
    text = plan(W.first_row(skewed, ["k"], [F.col("ts").asc(), F.col("id").asc()]))
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")
    assert "WindowGroupLimit" in plan(T.topk_per_group(skewed, ["k"], [F.col("ts").asc()], 5))


def test_sequence_of_a_hot_entity(spark, skewed):
    got = W.event_sequence(skewed, "k", "ts", ["id"], bucket=F.to_date("ts"))
    assert got.count() == 20_000
    from pyspark.sql import Window

    plain = skewed.withColumn("want", F.row_number().over(Window.partitionBy("k").orderBy("ts", "id")))
    assert got.join(plain, "id").filter("seq <> want").count() == 0


def test_sequence_narrows_its_buckets(spark, skewed):
    assert [W._bucket_unit(skewed, "k", "ts", n) for n in (20_000, 1000, 20, 1)] == ["month", "day", "hour", "minute"]


def test_sequence_keeps_rows_without_entity(spark):
    df = spark.createDataFrame([(1, None, dt.datetime(2024, 1, 1)), (2, None, dt.datetime(2024, 2, 1)), (3, 5, None)], "id int, k int, ts timestamp_ntz")
    assert rows(W.event_sequence(df, "k", "ts", ["id"]).select("id", "seq")) == [(1, 1), (2, 2), (3, 1)]


def test_salted_join_equals_join(spark, skewed):
    dim = spark.range(0, 600).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    salted = J.salted_join(skewed, dim, "k", ["id"], salts=8, share=100)
    assert rows(salted.select("id", "v").filter("id < 50")) == rows(skewed.join(dim, "k", "left").select("id", "v").filter("id < 50"))
    assert salted.count() == 20_000
    assert rows(J.hot_keys(skewed, "k", 100)) == [(0,)]


def test_year_filter_reaches_the_scan(spark, tmp_path):
    spark.createDataFrame([(dt.datetime(2000, 5, 1), 1)], "ts timestamp_ntz, x int").write.parquet(str(tmp_path / "t"))
    text = plan(spark.read.parquet(str(tmp_path / "t")).filter(in_year("ts", 2000)))
    assert "GreaterThanOrEqual(ts" in text and "LessThan(ts" in text


def test_share_has_no_window(spark, skewed):
    assert "Window" not in plan(W.share_within(skewed, ["k"], "id", "s"))


def test_top_k_needs_no_sort(skewed):
    assert "TakeOrderedAndProject" in plan(T.top_k(skewed, [F.col("id").desc()], 5))


@pytest.mark.parametrize("n", [0, 1, 777, 19_999, 20_000, 30_000])
def test_exact_sample(skewed, n):
    from tillwise.operators.sets import sample_exact

    ids = sorted(r["id"] for r in sample_exact(skewed, n, ["id"], seed=3).collect())
    assert len(ids) == len(set(ids)) == min(n, 20_000)
    assert ids == sorted(r["id"] for r in sample_exact(skewed.repartition(7), n, ["id"], seed=3).collect())
    if 0 < n < 20_000:
        by_hash = skewed.orderBy(F.md5(F.concat(F.lit("3:"), F.col("id").cast("string"))), "id").limit(n)
        assert ids == sorted(r["id"] for r in by_hash.collect())


@pytest.fixture
def tiny_skew_limits(spark):
    """Limits that make a small table count as skewed, and no broadcast joins."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_user_is_split_in_the_order_join(spark, tiny_skew_limits, tmp_path):
    """A third of the orders belong to one user; the join of orders and segments splits them."""
    from tillwise.plans import retail

    raw = spark.range(0, 60_000, 1, 6).selectExpr(
        "id AS order_id", "CASE WHEN id % 3 = 0 THEN 1 ELSE id % 5000 END AS user_id", "id % 7 AS store_id", "CAST(NULL AS STRING) AS store_name",
        "CAST(NULL AS STRING) AS store_area", "TIMESTAMP_NTZ'2024-01-01 10:00:00' + make_dt_interval(CAST(id % 300 AS INT)) AS order_datetime",
        "id % 1000 AS total_amount", "1 AS total_quantity", "CAST(xxhash64(id) AS STRING) AS order_status",
    )
    raw.write.parquet(str(tmp_path / "orders"))
    orders = spark.read.parquet(str(tmp_path / "orders"))
    users = spark.range(5000).selectExpr("id AS user_id", "DATE'2024-01-01' AS registration_date")
    lines = orders.selectExpr("user_id", "store_id * 100 AS category_id", "true AS is_organic", "false AS is_premium", "false AS is_discount_target", "true AS is_ready_to_eat")
    out = retail.gold_orders(orders, users, retail.user_segments(orders, lines, dt.date(2025, 1, 1)))
    assert len(out.collect()) == 60_000
    assert "skew=true" in plan(out)


def hot_joins(spark, fact):
    """Every operator that joins rows to something grouped by a possibly hot key."""
    from tillwise.operators import filters, joins
    from tillwise.operators.cdc import apply_changes
    from tillwise.plans import store

    log = spark.range(5000).selectExpr("id AS k", "id AS seq", "concat('name', id) AS name")
    dim = apply_changes(log, ["k"], ["seq"])
    return {
        "enrich": joins.enrich(fact, dim, "k", ["name"], matched="found"),
        "join_first": joins.join_first(fact, log, "k", [F.col("seq").asc()], ["name"]),
        "share": W.share_within(fact, ["k"], "x", "part"),
        "having": filters.having_entity(fact, "k", F.col("n") > 0, {"n": F.count("*")}),
        "vs_group": joins.vs_group(fact, ["k"], "x", fact.groupBy("k").agg(F.avg("x").alias("mean")), "mean"),
        "category_gaps": store.category_gaps(
            fact.selectExpr("x AS store_id", "k AS category_id", "pad AS category_name", "x AS sales")
        ),
        "similar_kpis": store.similar_kpis(
            fact.selectExpr("x AS store_id", "k AS similar_store_id", "1 AS similarity_rank", "pad AS similarity_score"),
            spark.range(5000).selectExpr("id AS store_id", "'s' AS store_name", "'p' AS prefecture", "'c' AS city"),
            spark.range(5000).selectExpr("id AS store_id", "DATE'2024-01-01' AS month", "1.0D AS sales_amount", "0.1D AS yoy_change", "1 AS customer_count", "1.0D AS avg_basket"),
            2024,
        ),
        "benchmark_gaps": store.benchmark_gaps(
            fact.selectExpr("x AS store_id", "concat('c', pad = '') AS category_name", "x AS sales"),
            fact.selectExpr("x AS store_id", "k AS similar_store_id", "1 AS similarity_rank", "1.0D AS yoy_pct"),
        ),
    }


@pytest.mark.parametrize("name", ["enrich", "join_first", "share", "having", "vs_group", "category_gaps", "similar_kpis", "benchmark_gaps"])
def test_hot_key_is_split(spark, tiny_skew_limits, tmp_path, name):
    spark.range(0, 60_000, 1, 6).selectExpr(
        "IF(id % 3 = 0, 1, id % 5000) AS k", "id AS x", "CAST(xxhash64(id) AS STRING) AS pad"
    ).write.parquet(str(tmp_path / "fact"))
    out = hot_joins(spark, spark.read.parquet(str(tmp_path / "fact")))[name]
    assert len(out.collect()) == 60_000
    assert "skew=true" in plan(out)


def test_share_keeps_rows_without_group(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 2.0)], "g string, x double")
    assert rows(W.share_within(df, ["g"], "x", "s")) == [("a", 2.0, 1.0), (None, 1.0, 0.25), (None, 3.0, 0.75)]


def test_cleaned_lines_are_computed_once(spark):
    from tillwise.plans import retail

    texts = [c for c in retail.LINE_TYPES if c != "order_datetime"]
    raw = spark.range(40).select(*[F.lit("1").alias(c) for c in texts if c != "order_item_id"], (F.col("id") % 30).cast("string").alias("order_item_id"),
        F.lit("u").alias("user_id"), F.lit("2024-01-01 00:00:00").alias("order_datetime"), F.col("id").alias("_ingested_at"))
    items = spark.createDataFrame([(1, "a", "b", True, True, True, True)], "item_id long, " + ", ".join(
        f"{c} {'string' if c.endswith('name') else 'boolean'}" for c in retail.ITEM_REF))
    stores = spark.createDataFrame([(1, "s", "t")], "store_id long, store_name string, store_area string")
    out = retail.silver_order_items(raw, items, stores)
    assert out.count() == 30 and plan(out).count("Range") == 1


def test_order_lines_are_joined_to_orders_last(spark):
    from tillwise.workload.tables import Data

    lines = Data(spark, "/root/testdata/sf0.001").r_lines
    last = next(n for n in lines._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join" in n)
    assert "l_orderkey" in last or "order_id" in last


def test_order_lines_are_not_moved_for_their_users(spark):
    """Their orders bring the segments."""
    from tillwise.workload import all_queries

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = all_queries()["b05_gold_order_items"](spark, "/root/testdata/sf0.001")
        above, moved = [], []
        for line in plan(out).splitlines():
            depth = len(line) - len(line.lstrip(" :+-"))
            above = [(at, name) for at, name in above if at < depth] + [(depth, line.lstrip(" :+-"))]
            if "l_linenumber" in line and "FileScan" in line:
                moved.append([name for _, name in above if name.startswith("Exchange hashpartitioning")])
        assert any(not any("user_id" in name for name in path) for path in moved)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_lines_of_another_user_or_no_order_have_their_users_segments(spark):
    """As joined line by line: by user for the segments and by order for the flag, with repeated and NULL keys."""
    from tillwise.plans import retail

    lines = spark.createDataFrame(
        [(1, 10, "a"), (2, 10, "b"), (3, 10, None), (4, 99, "a"), (5, None, "b"), (6, 11, "b"), (7, 12, "c"), (8, 12, "d")],
        "order_item_id long, order_id long, user_id string",
    ).withColumns({c: F.lit(1).cast("long") for c in ("store_id", "item_id", "category_id", "quantity", "subtotal", "unit_price")})
    lines = lines.withColumns({c: F.lit(None).cast("string") for c in (*retail.STORE_REF, *retail.ITEM_REF, "cancel_flg")})
    lines = lines.withColumn("order_datetime", F.lit(dt.datetime(2024, 1, 2, 3)))
    orders = spark.createDataFrame([(10, "a"), (11, "b"), (11, "b"), (12, "c"), (12, "d"), (13, None)], "order_id long, user_id string")
    users = spark.createDataFrame([("a", dt.date(2024, 1, 1)), ("b", dt.date(2020, 1, 1)), ("c", dt.date(2024, 1, 1))], "user_id string, registration_date date")
    seg = spark.createDataFrame(
        [("a", "1", 5, 5, 5, "x", 10, dt.date(2024, 1, 2)), ("b", "2", 4, 4, 4, "y", 11, dt.date(2024, 1, 2)), ("c", "3", 3, 3, 3, "z", 12, dt.date(2024, 1, 2))],
        "user_id string, behavior_cluster string, r_score int, f_score int, m_score int, rfm_segment string, first_order_id long, first_order_date date",
    )
    out = retail.gold_order_items(lines, orders, users, seg).select("order_item_id", "user_id", "r_score", "is_first_order")
    assert rows(out) == sorted(
        [(1, "a", 5, True), (2, "b", 4, True), (3, None, None, True), (4, "a", 5, None), (5, "b", 4, None)] + [(6, "b", 4, False)] * 2
        + [(7, "c", 3, True)] * 2 + [(8, "d", None, True)] * 2,
        key=lambda r: tuple((x is None, str(x)) for x in r),
    )
