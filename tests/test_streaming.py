import datetime as dt
import random

import pytest

from tests.conftest import rows
from tillwise.plans import shop
from tillwise.streaming import dedup as R
from tillwise.streaming import ingest as I
from tillwise.streaming import sift as Z


def feed(spark, path, events):
    data = [(i, dt.datetime.fromisoformat(t)) for i, t in events]
    spark.createDataFrame(data, "order_id int, ts timestamp_ntz").coalesce(1).write.mode("append").parquet(path)


@pytest.mark.parametrize("mode", ["bounded", "forever"])
def test_watermark_and_late_rows(spark, tmp_path, mode):
    src, out, cp = (str(tmp_path / n) for n in ("in", "out", "cp"))

    def run():
        stream = I.stream_table(spark, src)
        return I.append_flow(R.dedup_stream(stream, ["order_id"], "ts", "10 minutes", mode), out, cp)

    feed(spark, src, [(1, "2024-01-02 10:00:00"), (1, "2024-01-02 10:00:00"), (2, "2024-01-02 10:05:00")])
    run()
    # 9:57 is later than the watermark 9:55, the day before is not
    feed(spark, src, [(204, "2024-01-02 09:57:00"), (202, "2024-01-01 10:00:00"), (2, "2024-01-02 10:05:00")])
    q = run()
    assert R.late_rows(q) == 1
    assert sum(m["input_rows"] for m in R.progress_metrics(q)) == 3
    ids = sorted(r["order_id"] for r in spark.read.parquet(out).collect())
    assert ids == [1, 2, 204]


def test_bounded_state_is_released(spark, tmp_path):
    for mode, expected in (("bounded", 2), ("forever", 1)):
        src, out, cp = (str(tmp_path / mode / n) for n in ("in", "out", "cp"))
        for when in ("2024-01-01 10:00:00", "2024-02-01 10:00:00", "2024-03-01 10:00:00"):
            feed(spark, src, [(int(when[6]) * 100, when)])
            I.append_flow(R.dedup_stream(I.stream_table(spark, src), ["order_id"], "ts", mode=mode), out, cp)
        feed(spark, src, [(100, "2024-04-01 10:00:00")])  # an id used again months later
        I.append_flow(R.dedup_stream(I.stream_table(spark, src), ["order_id"], "ts", mode=mode), out, cp)
        assert spark.read.parquet(out).filter("order_id = 100").count() == expected


def test_late_rows_of_many_batches(spark, tmp_path):
    """More batches than Spark remembers the progress of."""
    src, out, cp = (str(tmp_path / n) for n in ("in", "out", "cp"))
    feed(spark, src, [(0, "2024-02-01 10:00:00")])
    I.append_flow(R.dedup_stream(I.stream_table(spark, src), ["order_id"], "ts"), out, cp)
    for i in range(8):
        feed(spark, src, [(i, "2024-01-01 10:00:00"), (100 + i, "2024-01-02 10:00:00")])
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "3")
    try:
        q = I.append_flow(R.dedup_stream(I.stream_table(spark, src, max_files=1), ["order_id"], "ts"), out, cp)
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert len(q.recentProgress) < 8 and R.late_rows(q) == 16


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        R.dedup_stream(spark.range(1), ["id"], "id", mode="x")


# --- the shop from landing files to revenue tables ------------------------------------------


USERS = "user_id,name,age,gender,email,region,registration_date,email_opt_in,last_updated,operation"
TX = "order_id,user_id,product_id,transaction_date,quantity,amount"


@pytest.fixture
def products(spark):
    return spark.createDataFrame(
        [("P1", "PC", "PC本体", 1000.0), ("P2", "PC", "周辺機器", 50.0), ("P3", "book", "その他", 10.0)],
        "product_id string, category string, subcategory string, price double",
    )


def test_shop_story(spark, landing, tmp_path, products):
    base, land = str(tmp_path / "base"), f"{landing.base}/land"

    def run(**more):
        return shop.refresh_shop(spark, land, base, products, **more)

    def table(name):
        return spark.read.parquet(f"{base}/{name}")

    landing("land/users/1.csv", USERS,
            "U1,Tanaka,30,M,t@x,east,2020-01-01,TRUE,2024-01-01 00:00:00,INSERT",
            "U2,Sato,60,F,bad-mail,west,2020-01-01,false,2024-01-01 00:00:00,INSERT")
    landing("land/transactions_east/1.csv", TX, "101,U1,P1,2024-01-02 10:00:00,1,1000", "102,U2,P2,2024-01-02 10:05:00,2,100", "102,U2,P2,2024-01-02 10:05:00,2,100")
    landing("land/transactions_west/1.csv", TX, "103,,P1,2024-01-02 10:04:00,1,5", "104,U1,P9,2024-01-02 10:04:00,0,5")
    stats = run()
    assert stats["transactions_east"] == 3 and stats["transactions_west"] == 2
    assert stats["dropped_user_id_is_not_null"] == 1 and stats["dropped_product_id_is_not_null"] == 0
    assert stats["warned_valid_email_format"] == 1 and stats["warned_valid_date"] == 0 and stats["users_unordered"] == 0
    assert stats["warned_quantity_is_more_than_1"] == 1 and stats["warned_amount_is_more_than_1"] == 0
    assert rows(table("sl_transactions").select("order_id", "valid")) == [(101, True), (102, True), (104, False)]
    assert rows(table("gd_user").select("user_id", "age_group", "pc_quantity", "peripheral_quantity", "other_quantity")) == [
        ("U1", "若年層", 1, 0, 0), ("U2", "シニア層", 0, 2, 0),
    ]

    # a change of region, a new column, a late and a too late order, an unknown user
    landing("land/users/2.csv", "operation," + USERS.removesuffix(",operation"),
            "UPDATE,U1,Tanaka,30,M,t@x,west,2020-01-01,False,2024-01-03 00:00:00",
            "UPDATE,U2,Sato,60,F,x@x,west,2020-01-01,False,")
    landing("land/transactions_west/2.csv", "discount," + TX, "0.1,203,U4,P2,2024-01-02 10:06:00,1,45")
    landing("land/transactions_east/2.csv", TX, "204,U1,P2,2024-01-02 09:57:00,1,50", "202,U1,P2,2023-12-01 10:00:00,1,50")
    stats = run()
    assert stats["late_rows"] == 1 and stats["without_user"] == 1 and stats["users_unordered"] == 1
    assert rows(spark.read.parquet(f"{base}/bz_users/unordered").select("user_id", "email")) == [("U2", "x@x")]
    wide = table("sl_transactions_enriched")
    assert sorted(r["order_id"] for r in wide.collect()) == [101, 102, 104, 203, 204]
    assert rows(wide.filter("order_id IN (101, 203)").select("order_id", "user_name", "region", "discount")) == [
        (101, "Tanaka", "west", None), (203, None, None, 0.1),
    ]

    # the missing user arrives in a feed of its own that also deletes one
    landing("land/users_backfill/1.csv", USERS,
            "U4,Ito,40,F,i@x,east,2020-01-01,True,2024-01-01 00:00:00,INSERT",
            "U2,Sato,60,F,bad-mail,west,2020-01-01,false,2024-01-05 00:00:00,DELETE")
    stats = run(user_feeds={"users": None, "users_backfill": "operation = 'DELETE'"})
    assert stats["transactions_east"] == 0 and stats["without_user"] == 1
    names = dict(rows(table("sl_transactions_enriched").select("order_id", "user_name")))
    assert names[203] == "Ito" and names[102] is None
    report = {r["user_id"]: r for r in table("gd_revenue_report").collect()}
    assert report["U1"]["total_orders"] == 3 and report["U1"]["last_purchase_date"] == "2024-01-02"
    assert report["U4"]["total_sales"] == 45.0 and report["U4"]["age_group"] == "中年層"
    assert run(user_feeds={"users": None, "users_backfill": "operation = 'DELETE'"})["enriched"] == 5


def sift(spark, base, delay=dt.timedelta(minutes=10), max_files=None):
    src, out, cp = (f"{base}/{n}" for n in ("in", "out", "cp"))
    return Z.sift_stream(I.stream_table(spark, src, max_files=max_files), out, ["order_id"], "ts", cp, delay)


def fates(spark, base):
    return rows(Z.read_sifted(spark, f"{base}/out").selectExpr("order_id", "date_format(ts, 'dd HH:mm') AS at", "fate"))


def test_sifted_rows_are_all_kept_somewhere(spark, tmp_path):
    base = str(tmp_path)
    feed(spark, f"{base}/in", [(1, "2024-01-02 10:00:00"), (1, "2024-01-02 10:02:00"), (2, "2024-01-02 10:05:00"), (None, "2024-01-02 10:05:00")])
    q = sift(spark, base)
    assert q.counts == {"kept": 3, "duplicate": 1, "late": 0, "undated": 0}
    # the watermark is 9:55: one row before it, one at it, one after it, repeats, and a row without a time
    feed(spark, f"{base}/in", [(7, "2024-01-01 10:00:00"), (8, "2024-01-02 09:55:00"), (9, "2024-01-02 09:57:00"), (2, "2024-01-02 10:06:00"), (None, "2024-01-02 10:07:00")])
    spark.sql("SELECT 10 AS order_id, CAST(NULL AS timestamp_ntz) AS ts").write.mode("append").parquet(f"{base}/in")
    q = sift(spark, base)
    assert q.counts == {"kept": 4, "duplicate": 3, "late": 2, "undated": 1}
    assert fates(spark, base) == rows(spark.createDataFrame([
        (1, "02 10:00", "kept"), (1, "02 10:02", "duplicate"), (2, "02 10:05", "kept"), (None, "02 10:05", "kept"),
        (7, "01 10:00", "late"), (8, "02 09:55", "late"), (9, "02 09:57", "kept"), (2, "02 10:06", "duplicate"),
        (None, "02 10:07", "duplicate"), (10, None, "undated"),
    ], "a int, b string, c string"))
    assert sift(spark, base).counts == dict.fromkeys(Z.FATES, 0)  # nothing new


def test_sift_forgets_and_repeats(spark, tmp_path):
    base = str(tmp_path)
    for when in ("2024-01-01 10:00:00", "2024-01-01 10:09:00", "2024-01-01 10:30:00", "2024-01-01 10:30:00", "2024-01-01 10:31:00"):
        feed(spark, f"{base}/in", [(1, when)])
        sift(spark, base)
    # 10:30 came when the watermark was 9:59, so the key was still known; 10:30 again and 10:31 came at 10:20
    assert [f for _, _, f in fates(spark, base)] == ["kept", "duplicate", "duplicate", "kept", "duplicate"]
    before = fates(spark, base)
    # a batch that is done again after a failure replaces its own rows
    again = spark.read.parquet(f"{base}/out/rows/batch=4").drop("fate", Z.AT)
    Z._sift(again, 4, f"{base}/out", ["order_id"], "ts", 600_000_000)
    assert fates(spark, base) == before


def test_sift_against_brute_force(spark, tmp_path):
    """Random batches against a plain loop over their rows."""
    rng = random.Random(5)
    start = dt.datetime(2024, 1, 1)
    latest, known, expected = None, {}, []
    delay = dt.timedelta(minutes=10)
    for b in range(6):
        batch = [(rng.randrange(8), start + dt.timedelta(minutes=12 * b + rng.randrange(-25, 12))) for _ in range(20)]
        mark = None if latest is None else latest - delay
        seen = {k: t for k, t in known.items() if mark is None or t > mark - delay}
        for key, t in sorted(batch, key=lambda r: r[1]):
            if mark is not None and t <= mark:
                expected.append((key, t, "late"))
            elif key in seen:
                expected.append((key, t, "duplicate"))
            else:
                seen[key] = t
                expected.append((key, t, "kept"))
        known = seen
        latest = max([t for _, t in batch] + ([latest] if latest else []))
        feed(spark, str(tmp_path / "in"), [(k, t.isoformat()) for k, t in batch])
        q = sift(spark, str(tmp_path))
    assert sum(q.counts.values()) == 120 and min(q.counts[f] for f in ("kept", "duplicate", "late")) > 10
    got = Z.read_sifted(spark, str(tmp_path / "out"))
    assert rows(got.select("order_id", "ts", "fate")) == sorted(expected, key=lambda r: tuple((x is None, str(x)) for x in r))


def test_every_batch_is_reported(spark, tmp_path):
    """Quick batches, far more than Spark remembers."""
    src = str(tmp_path / "in")
    spark.range(500).repartition(500, "id").write.option("maxRecordsPerFile", 1).parquet(src)
    n = len(list((tmp_path / "in").glob("*.parquet")))
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        q = I.run_batches(I.stream_table(spark, src, max_files=1), str(tmp_path / "cp"), lambda df, b: None)
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert n >= 500 and len({p["batchId"] for p in q.progress}) == n
