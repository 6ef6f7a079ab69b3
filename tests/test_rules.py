"""Ladders, quality rules, text fields and small helpers on hand-written rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import rows
from tillwise.functions import ladders as L
from tillwise.functions import scalar as S
from tillwise.operators import aggregates as A
from tillwise.operators import quality as Q
from tillwise.operators import text as X
from tillwise.plans import campaign, retail


def values(spark, col, vals, ddl="double"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], f"i int, x {ddl}")
    return [r[0] for r in df.orderBy("i").select(col).collect()]


def test_score_limits(spark):
    df = spark.createDataFrame(
        [(7, 10, 50000), (8, 9, 49999), (14, 5, 20000), (30, 3, 10000), (60, 2, 5000), (61, 1, 4999)],
        "recency int, frequency int, monetary int",
    )
    got = [tuple(r) for r in df.select(*[c.alias(n) for n, c in L.rfm_score_columns().items()]).collect()]
    assert got == [(5, 5, 5), (4, 4, 4), (4, 4, 4), (3, 3, 3), (2, 2, 2), (1, 1, 1)]


def test_segments_cover_every_score(spark):
    import itertools

    df = spark.createDataFrame(list(itertools.product(range(1, 6), repeat=3)), "r_score int, f_score int, m_score int")
    got = {tuple(r)[:3]: r["s"] for r in df.withColumn("s", L.rfm_segment()).collect()}
    assert got[5, 5, 5] == L.LOYAL and got[5, 5, 3] == L.REGULAR and got[4, 3, 5] == L.REGULAR
    assert got[5, 2, 5] == L.NEW and got[2, 3, 1] == L.AT_RISK and got[1, 1, 1] == L.DORMANT
    assert {got[3, f, m] for f in range(1, 6) for m in range(1, 6)} == {L.GENERAL}
    assert None not in got.values()


@pytest.mark.parametrize(
    "rates,code",
    [
        ((0.70, 0.60, 0.9, 20, 0.9, 0.9, 0.9, 0.9), "5"),
        ((0.69, 0.60, 0.80, 10, 0.9, 0.9, 0.9, 0.9), "1"),
        ((0.70, None, 0.80, 9.9, 0.70, 0.50, 0.9, 0.9), "2"),
        ((0.0, 0.0, 0.0, 1, 0.70, 0.49, 0.60, 0.9), "3"),
        ((0.0, 0.0, 0.0, 1, 0.0, 0.0, 0.59, 0.70), "4"),
        ((0.0, None, 0.0, 1, 0.9, None, None, None), None),
    ],
)
def test_cluster_priority(spark, rates, code):
    names = (
        "weekday_evening_rate, ready_to_eat_rate, weekend_rate, avg_basket_size, night_rate, discount_rate, "
        "organic_premium_rate, favourite_rate"
    )
    ddl = ", ".join(f"{n} double" for n in names.split(", "))
    row = spark.createDataFrame([tuple(None if x is None else float(x) for x in rates)], ddl)
    out = row.select(L.behavior_cluster().alias("c")).select("c", L.cluster_name("c")).first()
    assert tuple(out) == (code, L.CLUSTER_NAMES.get(code, L.CLUSTER_DEFAULT))


def test_bands(spark):
    assert values(spark, L.age_group3("x"), [34.0, 35.0, 54.0, 55.0, None]) == ["若年層", "中年層", "中年層", "シニア層", "シニア層"]
    assert values(spark, L.age_group5("x"), [24, 25, 59, 60, None], "int") == ["20-24歳", "25-29歳", "55-59歳", "60歳以上", "60歳以上"]
    assert values(spark, L.alert_level("x"), [0.0, -0.05, -0.10, -0.12, -0.15, None]) == ["good", "normal", "warning", "warning", "critical", "good"]
    assert values(spark, L.health_class("x"), [0.0, -0.10, -0.11]) == ["healthy", "caution", "critical"]
    assert values(spark, L.resolution_group("x"), [0.8, 0.5, 0.1, 0.0, None]) == [
        L.RESOLVED_HIGH, L.RESOLVED_MID, L.RESOLVED_LOW, L.NO_CALLS, L.NO_CALLS,
    ]
    assert values(spark, L.resolution_group("x", F.lit(2)), [0.0]) == [L.RESOLVED_ZERO]
    assert values(spark, L.recency_band("x"), [7, 8, 30, 60, 61], "int") == ["0-7", "8-14", "15-30", "31-60", "61+"]
    assert values(spark, L.churn_band(F.lit(8), "x"), ["1", "2", "5", None], "string") == ["intervention", "intervention", "critical", "active"]
    assert values(spark, L.facility_label("x"), ["駅", "公園・レジャー", "倉庫", None], "string") == ["station", "park", "other", "other"]


def test_scalars(spark):
    assert values(spark, S.default_if_blank("x", "不明"), ["a", "", None], "string") == ["a", "不明", "不明"]
    assert values(spark, S.parse_bool("x"), ["TRUE", "False", "t", "maybe", None], "string") == [True, False, True, None, None]
    assert values(spark, S.mask_phone("x"), ["090-1234-5678", "03-123-4567 x", "none"], "string") == ["090-XXXX-5678", "03-XXXX-4567 x", "none"]
    assert values(spark, S.split_list("x"), ["a,b", "", None], "string") == [["a", "b"], [], []]
    assert values(spark, S.rate("x", F.lit(0)), [1.0]) == [None]
    start, end = S.fiscal_year_bounds("x")
    days = [dt.date(2024, 2, 29), dt.date(2024, 3, 1), dt.date(2023, 12, 31)]
    assert values(spark, S.fiscal_year("x"), days, "date") == [2023, 2024, 2023]
    assert values(spark, start, days, "date") == [dt.date(2023, 3, 1), dt.date(2024, 3, 1), dt.date(2023, 3, 1)]
    assert values(spark, end, days, "date") == [dt.date(2024, 2, 29), dt.date(2025, 2, 28), dt.date(2024, 2, 29)]


def test_buying_times(spark):
    at = [dt.datetime(2024, 1, 5, 16), dt.datetime(2024, 1, 5, 18, 59), dt.datetime(2024, 1, 5, 19), dt.datetime(2024, 1, 6, 17), dt.datetime(2024, 1, 7, 9)]
    assert values(spark, S.is_weekend("x"), at, "timestamp_ntz") == [False, False, False, True, True]
    assert values(spark, S.is_weekday_evening("x"), at, "timestamp_ntz") == [True, True, False, False, False]
    assert values(spark, S.is_night("x"), at, "timestamp_ntz") == [False, False, True, False, False]


def test_call_time_stamp(spark):
    df = spark.createDataFrame([("C1", "2024-03-05T09:07:00", 31), ("C2", "bad", 20)], "call_id string, call_datetime string, customer_age int")
    assert rows(campaign.bronze_calls(df)) == [("C1", dt.date(2024, 3, 5), "09:07:00", 31), ("C2", None, None, 20)]


# --- quality -----------------------------------------------------------------------------

DATA = [(1, 5, 10.0), (2, 0, 10.0), (3, None, 10.0), (4, 2, 0.0)]


def test_rules(spark):
    df = spark.createDataFrame(DATA, "id int, quantity int, amount double")
    kept, seen = Q.expect_all_or_drop(df, Q.AMOUNT_RULES)
    assert rows(kept.select("id")) == [(1,)]
    assert seen.get == {"rows": 4, "quantity_is_more_than_1": 2, "amount_is_more_than_1": 1}
    warned, seen = Q.expect(df, "some", "quantity >= 1")
    assert warned.count() == 4 and seen.get["some"] == 2
    good, bad = Q.split_valid(df, Q.AMOUNT_RULES)
    assert rows(good.union(bad)) == rows(df) and good.count() == 1
    assert [r["valid"] for r in Q.with_validity(df, Q.AMOUNT_RULES).orderBy("id").collect()] == [True, False, False, False]


def test_key_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (None, "c")], "k int, v string")
    one = Q.check_key(df, ["k"]).first()
    assert (one["total_rows"], one["null_keys"], one["duplicate_keys"], one["surplus_rows"], one["passed"]) == (4, 1, 1, 2, False)
    assert Q.check_key(df.dropna().distinct(), ["k", "v"]).first()["passed"]
    fk = Q.check_fk(df, spark.range(1, 2).toDF("id"), "k", "id").first()
    assert (fk["orphan_keys"], fk["orphan_rows"], fk["passed"]) == (1, 1, False)


def test_suite_and_totals(spark):
    heads = spark.createDataFrame([(3,), (4,)], "t int")
    lines = spark.createDataFrame([(5,), (2,)], "s int")
    ok = Q.check_totals(heads, "t", lines, "s", "a")
    bad = Q.check_totals(heads, "t", lines.filter("s > 2"), "s", "b")
    assert rows(Q.run_checks([ok, bad])) == [("ALL", False), ("a", True), ("b", False)]
    assert Q.check_totals(heads, "t", lines.filter("s > 9"), "s").first()["passed"] is False


def test_match_rate_null_equals_null(spark):
    df = spark.createDataFrame([("1", "1"), (None, None), ("2", None)], "a string, b string")
    assert tuple(Q.match_rate(df, "a", "b").first()) == (3, 2, pytest.approx(2 / 3))


def test_first_value_keeps_or_skips_nulls(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, "x"), ("b", 1, None)], "k string, t int, v string")
    assert rows(A.first_by(df, ["k"], ["t"], {"v": "f"})) == [("a", None), ("b", None)]
    assert rows(A.first_by(df, ["k"], ["t"], {"v": "f"}, ignore_nulls=True)) == [("a", "x"), ("b", None)]


# --- calls ----------------------------------------------------------------------------------

CALLS = [
    ("C1", "オペレーター（山田）：お電話ありがとうございます。\nお客様：LINEのクーポンの割引が適用されません。明日までに必要です。他社ではすぐ使えました。\nオペレーター（山田）：確認します。"),
    ("C2", "オペレーター（山田）：はい。\nお客様：サイズがきついので交換をお願いします。\nオペレーター（山田）：承知しました。"),
    ("C3", "オペレーター（佐藤）：はい。\nお客様：請求が二重です。責任者を出してください。"),
    ("C4", "聞き取れません"),
]


def test_transcript_fields(spark):
    df = spark.createDataFrame(CALLS, "call_id string, transcript string")
    got = {r["call_id"]: r["extracted"].asDict() for r in X.extract_fields(df, "transcript").collect()}
    assert got["C1"] == {
        "purpose": "割引クレーム", "urgency_level": "高", "trouble_type": "割引条件", "next_intent": "検討中", "resolution_status": "解決", "competitor_mention": True,
        "operator_action": "確認します。",
    }
    assert (got["C2"]["purpose"], got["C2"]["trouble_type"], got["C2"]["next_intent"]) == ("返品交換", "サイズ", "交換依頼")
    assert (got["C3"]["purpose"], got["C3"]["resolution_status"]) == ("請求支払い", "エスカレーション")
    assert got["C2"]["operator_action"] == "承知しました。" and got["C4"]["operator_action"] == "聞き取れません"
    assert (got["C4"]["purpose"], got["C4"]["trouble_type"], got["C4"]["urgency_level"]) == ("その他", "なし", "低")
    for vocabulary, field in ((X.PURPOSES, "purpose"), (X.URGENCIES, "urgency_level"), (X.TROUBLES, "trouble_type"), (X.INTENTS, "next_intent"), (X.RESOLUTIONS, "resolution_status")):
        steps, default = X.TRANSCRIPT_RULES[field]
        assert {label for _, label in steps} | {default} <= set(vocabulary)


def test_turns_and_summary(spark):
    df = spark.createDataFrame(CALLS, "call_id string, transcript string")
    turns = [tuple(r) for r in X.explode_turns(df, ["call_id"], "transcript").filter("call_id IN ('C3', 'C4')").orderBy("call_id", "turn").collect()]
    assert turns == [
        ("C3", 0, "オペレーター（佐藤）", "はい。"), ("C3", 1, "お客様", "請求が二重です。責任者を出してください。"), ("C4", 0, None, "聞き取れません"),
    ]
    assert [r[0] for r in df.orderBy("call_id").select(X.summarize("transcript", n=10)).collect()] == [
        "LINEのクーポンの", "サイズがきついので交", "請求が二重です。責任", "聞き取れません",
    ]


# --- first orders -----------------------------------------------------------------------------


def test_first_order_within_thirty_days(spark):
    users = spark.createDataFrame([("A", dt.date(2024, 1, 1)), ("B", dt.date(2024, 1, 1)), ("C", dt.date(2024, 6, 1)), ("D", None)], "user_id string, registration_date date")
    at = lambda *x: dt.datetime(2024, *x)
    orders = spark.createDataFrame(
        [
            (1, "A", at(1, 31, 23), 1), (2, "A", at(2, 1), 1),  # day 30
            (3, "B", at(2, 1), 1),  # day 31
            (5, "C", at(5, 1, 9), 1), (4, "C", at(5, 1, 9), 1),  # before registration, two at one time
            (6, "D", at(5, 1), 1), (7, None, at(5, 1), 1), (8, "X", at(5, 1), 1),
        ],
        "order_id int, user_id string, order_datetime timestamp_ntz, n int",
    )
    got = dict(rows(retail.first_order_flags(orders, users)))
    assert [k for k, v in got.items() if v] == [1, 4] and len(got) == 8


def test_gold_tables_on_edges(spark):
    users = spark.createDataFrame([("A", dt.date(2024, 1, 1)), ("Z", dt.date(2024, 1, 1))], "user_id string, registration_date date")
    orders = spark.createDataFrame(
        [(1, "A", dt.datetime(2024, 1, 6, 12), 100, 12, 9, None, None, "COMPLETED"), (2, "Q", dt.datetime(2024, 1, 8, 12), 50, 1, 9, None, None, "COMPLETED")],
        "order_id long, user_id string, order_datetime timestamp_ntz, total_amount long, total_quantity int, store_id long, store_name string, store_area string, order_status string",
    )
    lines = spark.createDataFrame(
        [(10, 1, "A", 100, True, False, False, False), (11, 99, "A", 1100, False, False, True, True)],
        "order_item_id long, order_id long, user_id string, category_id long, is_organic boolean, is_premium boolean, is_discount_target boolean, is_ready_to_eat boolean",
    ).withColumns({n: F.lit(None).cast(t) for n, t in {
        "store_id": "long", "store_name": "string", "store_area": "string", "item_id": "long", "item_name": "string", "category_name": "string",
        "quantity": "int", "unit_price": "long", "subtotal": "long", "cancel_flg": "boolean", "order_datetime": "timestamp_ntz"}.items()})
    seg = retail.user_segments(orders, lines, dt.date(2024, 1, 13))
    gold = {r["user_id"]: r for r in retail.gold_users(users, seg).collect()}
    assert (gold["A"]["behavior_cluster"], gold["A"]["r_score"], gold["A"]["customer_type"]) == ("1", 5, "新規")
    assert (gold["Z"]["behavior_cluster_name"], gold["Z"]["rfm_segment"], gold["Z"]["customer_type"]) == ("ランダム", None, None)
    out = {r["order_id"]: r for r in retail.gold_orders(orders, users, seg).collect()}
    assert out[1]["is_first_order"] and out[1]["customer_type"] == "新規" and out[1]["is_weekend"]
    assert out[2]["is_first_order"] is False and out[2]["customer_type"] == "既存"
    items = {r["order_item_id"]: r for r in retail.gold_order_items(lines, orders, users, seg).collect()}
    assert items[10]["is_first_order"] is True
    assert items[11]["is_first_order"] is None and items[11]["customer_type"] == "既存"


def test_gold_is_written_and_read_back(spark, tmp_path):
    from tillwise.workload.tables import AS_OF, Data

    d = Data(spark, "/root/testdata/sf0.001")
    lines = d.r_lines.withColumn("unit_price", F.col("subtotal"))
    retail.write_gold(spark, d.r_users, d.r_orders, lines, str(tmp_path / "g"), AS_OF)
    read = lambda n: spark.read.parquet(str(tmp_path / "g" / n))
    assert read("gd_users").count() == d.customer.count()
    assert read("gd_orders").count() == d.orders.count()
    assert read("gd_order_items").count() == d.lineitem.count()
