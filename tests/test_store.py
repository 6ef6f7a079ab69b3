import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tillwise.plans import store as P


@pytest.fixture(scope="module")
def stores(spark):
    return spark.createDataFrame(
        [("S1", "one", "東京都", "港区", 1000, 35.6, 139.7), ("S2", "two", "東京都", None, 500, None, None), ("S3", "three", "大阪府", "堺市", 800, 34.5, 135.5)],
        "store_id string, store_name string, prefecture string, city string, size_sqm int, latitude double, longitude double",
    )


@pytest.fixture(scope="module")
def sales(spark):
    data = [
        ("S1", dt.date(2024, 1, 1), 1_000_000.0, 0.10, 100, 10.0), ("S1", dt.date(2024, 2, 1), 2_000_000.0, -0.10, 200, 20.0),
        ("S2", dt.date(2024, 1, 1), 500_000.0, -0.10, 50, 5.0),  # one month missing
        ("S3", dt.date(2024, 1, 1), 900_000.0, -0.15, 90, 9.0), ("S3", dt.date(2023, 1, 1), 9e9, 5.0, 1, 1.0),
    ]
    return spark.createDataFrame(data, "store_id string, month date, sales_amount double, yoy_change double, customer_count int, avg_basket double")


def test_profile_and_alert(spark, stores, sales):
    assert rows(P.store_kpis(stores, sales, 2024)) == [
        ("S1", "one", "東京都", "港区", 0.0, 300.0, 150.0, 15.0), ("S2", "two", "東京都", None, -10.0, 50.0, 50.0, 5.0), ("S3", "three", "大阪府", "堺市", -15.0, 90.0, 90.0, 9.0),
    ]
    alerts = dict(rows(P.store_list(stores, sales, 2024).select("store_id", "alert_level")))
    assert alerts == {"S1": "good", "S2": "warning", "S3": "critical"}
    assert rows(P.health_distribution(sales, 2024)) == [("caution", 1), ("critical", 1), ("healthy", 1)]


def test_decimal_changes_round_exactly(spark, stores):
    data = [("S1", dt.date(2024, 1, 1), 1.0, "0.3399"), ("S1", dt.date(2024, 2, 1), 1.0, "0.3400"), ("S2", dt.date(2024, 1, 1), 1.0, "-0.00005"), ("S3", dt.date(2024, 1, 1), 1.0, None)]
    df = spark.createDataFrame(data, "store_id string, month date, sales_amount double, c string")
    df = df.select("store_id", "month", "sales_amount", F.col("c").cast("decimal(12,5)").alias("yoy_change"), F.lit(1).alias("customer_count"), F.lit(1.0).alias("avg_basket"))
    got = dict(rows(P.store_kpis(stores, df, 2024).select("store_id", "avg_yoy_pct")))
    assert got == {"S1": 34.0, "S2": -0.01, "S3": None}  # 33.995 % and -0.005 %


def test_fact_sheet_parts(spark, stores, sales):
    text = lambda data, ddl: spark.createDataFrame(data, ddl)
    kpis = P.store_kpis(stores, sales, 2024).select("store_id", "avg_yoy_pct")
    gaps = text([("S1", f"c{i}", float(i - 3), 1.0) for i in range(8)], "store_id string, category_name string, gap double, gap_pct double")
    rivals = text([("S1", f"r{i}", 100, float(i + 1), i == 0) for i in range(7)], "store_id string, competitor_name string, size_sqm int, distance_km double, is_new_entry boolean")
    peers = text([("S1", "S2", 1, 2.0), ("S1", "S3", 2, -1.0)], "store_id string, similar_store_id string, similarity_rank int, yoy_pct double")
    bench = text([("S1", "c1", 5.0)], "store_id string, category_name string, gap double")
    spent = text([("S1", 1_234_567, 15_000, 9_999, None, *range(6))], "store_id string, " + ", ".join(f"{c} long" for c in P.SPENDING))
    near = text([("S1", f"f{i}", "駅", 1.0, float(i % 6)) for i in range(8)], "store_id string, facility_name string, facility_type string, distance_km double, traffic_impact double")
    past = text([("S1", "sale", f"m{i}", "done", dt.date(2024, 1, 1 + i), 0.1, None, "a,b") for i in range(7)], "store_id string, measure_type string, description string, status string, start_date date, expected_effect double, actual_effect double, related_categories string")
    args = (kpis, gaps, rivals, peers, bench, P.spending_of(spent), P.huff_share(stores, rivals), P.facilities_of(near), P.measures_of(past))
    sheet = {r["store_id"]: r for r in P.fact_sheet(*args).collect()}
    one, two = sheet["S1"], sheet["S2"]
    assert one["household_spending"]["total_man"] == 123 and one["household_spending"]["garden_man"] == 2
    assert one["household_spending"]["pet_man"] == 0
    assert [m["description"] for m in one["measures"]] == ["m6", "m5", "m4", "m3", "m2"]
    assert [f["facility_name"] for f in one["facilities"]] == ["f5", "f4", "f3", "f2", "f1"]
    assert 0 < one["own_share"] < 100 and two["own_share"] == 100.0
    assert two["measures"] is None and two["household_spending"] is None and two["competitors"] == 0
    short = P.fact_sheet(*args, sizes=P.SheetSizes(1, 2, 1, 1, 1, 1)).filter("store_id = 'S1'").first()
    assert [len(short[c]) for c in ("worst_categories", "near_competitors", "growing_peers", "facilities", "measures")] == [1, 2, 1, 1, 1]


def test_chain(spark, stores, sales):
    one = P.chain_average(sales, 2024).first()
    assert one["avg_annual_sales_man"] == 1320.0 and one["month_coverage"] == pytest.approx(4 / 36)
    trend = P.chain_trend(sales, stores, 2024, prefecture="東京都").collect()
    assert [(r["month"], r["total_customers"]) for r in trend] == [(dt.date(2024, 1, 1), 150), (dt.date(2024, 2, 1), 200)]
    assert [r["total_customers"] for r in P.chain_trend(sales, stores, 2024, health="critical").collect()] == [90]


def test_share_sums_to_one_hundred(spark, stores):
    rivals = spark.createDataFrame(
        [("S1", "a", 2000, 2.0), ("S1", "b", 500, 0.0), ("S2", "c", 900, 3.0)], "store_id string, competitor_name string, size_sqm int, distance_km double"
    )
    out = P.huff_share(stores, rivals)
    got = {(r["store_id"], r["name"]): r["share"] for r in out.collect()}
    assert got["S1", "one"] == 50.0 and got["S1", "a"] == 25.0 and got["S1", "b"] == 25.0
    assert got["S3", "three"] == 100.0
    for r in out.groupBy("store_id").agg(F.sum("share").alias("s")).collect():
        assert r["s"] == pytest.approx(100, abs=0.2)


def test_peers_and_gaps(spark, stores, sales):
    similar = spark.createDataFrame([("S1", "S2", 1, 0.9), ("S1", "S3", 2, 0.8), ("S2", "S3", 1, 0.7), ("S2", "S1", 2, 0.6)], "store_id string, similar_store_id string, similarity_rank int, similarity_score double")
    growing = sales.withColumn("yoy_change", F.when(F.col("store_id") == "S1", 0.2).otherwise(F.col("yoy_change")))
    peers = P.similar_kpis(similar, stores, growing, 2024)
    best = rows(P.best_growing_peer(peers).select("store_id", "similar_store_id"))
    assert best == [("S2", "S1")]  # every peer of S1 shrinks
    by_cat = spark.createDataFrame(
        [("S1", "C1", dt.date(2024, 1, 1), 30_000.0), ("S2", "C1", dt.date(2024, 1, 1), 10_000.0), ("S1", "C2", dt.date(2024, 1, 1), 0.0)],
        "store_id string, category_id string, month date, sales_amount double",
    )
    cats = spark.createDataFrame([("C1", "garden"), ("C2", "pets")], "category_id string, category_name string")
    per = P.category_sales(by_cat, cats, 2024)
    assert rows(P.benchmark_gaps(per, peers)) == [("S2", "S1", "garden", 1.0, 3.0, 2.0)]
    assert rows(P.category_gaps(per)) == [
        ("S1", "garden", 3.0, 2.0, 1.0, 50.0), ("S1", "pets", 0.0, 0.0, 0.0, None), ("S2", "garden", 1.0, 2.0, -1.0, -50.0),
    ]


def test_short_ranking_overlaps(spark, stores, sales):
    out = P.store_ranking(stores, sales, 2024, k=2)
    assert rows(out.select("ranking", "position", "store_id")) == [("bottom", 1, "S3"), ("bottom", 2, "S2"), ("top", 1, "S1"), ("top", 2, "S2")]
