"""Shop tables kept up to date: what is rewritten, and that any order of batches gives the full result."""

import dataclasses
import datetime as dt
import glob
import random

import pytest

from tests.conftest import rows
from tillwise.plans import shop, shop_views
from tillwise.streaming import changes as C
from tillwise.streaming import ingest as I

TX = "order_id long, user_id string, product_id string, transaction_date timestamp, quantity int, amount double"
USER = "user_id string, name string, age int, gender string, email string, region string, version int"


@pytest.fixture
def products(spark):
    return spark.createDataFrame(
        [("P1", "PC", "PC本体", 1000.0), ("P2", "PC", "周辺機器", 50.0)], "product_id string, category string, subcategory string, price double"
    )


class Shop:
    def __init__(self, spark, base, products):
        self.spark, self.base, self.products = spark, str(base), products
        table = C.KeyedTable(f"{base}/bz_users", ["user_id"], ["version"], except_cols=["version"])
        self.views = shop_views.ShopViews(self.base, table, buckets=8)

    def add(self, orders=(), users=()):
        if orders:
            self.spark.createDataFrame(orders, TX).coalesce(1).write.mode("append").parquet(f"{self.base}/sl_transactions")
        if users:
            self.spark.createDataFrame(users, USER).coalesce(1).write.mode("append").parquet(f"{self.base}/feed")
        if users:
            C.stream_apply_changes(I.stream_table(self.spark, f"{self.base}/feed"), self.views.users, f"{self.base}/cp", delete_when="name = 'gone'")

    def run(self):
        return shop_views.refresh_views(self.spark, self.views, self.products)

    def files(self, name="*"):
        return {f[len(self.base) :] for f in glob.glob(f"{self.base}/{name}/**/part-*.parquet", recursive=True) if "/_" not in f[len(self.base) :]}

    def table(self, name):
        return self.spark.read.option("mergeSchema", True).parquet(f"{self.base}/{name}").drop("user_bucket", "batch")

    def check(self):
        """All tables against a recomputation from the whole inputs."""
        tx = self.spark.read.option("mergeSchema", True).parquet(f"{self.base}/sl_transactions")
        users = C.read_keyed(self.spark, self.views.users)
        wide = shop.enrich_transactions(tx, users, self.products, master_rules=None)
        exact = shop.enrich_transactions(tx, users, self.products, master_rules=None, amount_type=shop_views.AMOUNT)
        for name, want in (
            ("sl_transactions_enriched", wide), ("gd_user", shop.user_categories(wide)), ("gd_revenue_report", shop.revenue_report(exact)),
            ("gd_revenue_by_subcategory", shop.revenue_by_subcategory(exact)), ("gd_revenue_by_user_segment", shop.revenue_by_user_segment(exact)),
        ):
            sums = {c: want[c].cast("double") for c in ("total_sales", "sum_revenue") if c in want.columns}
            want = want.withColumns(sums)
            assert rows(self.table(name).select(*want.columns)) == rows(want), name


def order(i, user, product="P1", amount=1.25):
    return (i, user, product, dt.datetime(2024, 1, 1 + i % 28, i % 24), i % 3, amount)


def user(name, version=1, age=30, region="east", label=None):
    return (name, label or name.lower(), age, "F", "a@b", region, version)


def test_late_user_rewrites_only_its_partitions(spark, tmp_path, products):
    s = Shop(spark, tmp_path, products)
    s.add([order(i, f"U{i % 12}") for i in range(48)], [user(f"U{i}") for i in range(11)])
    assert s.run()["user_name_is_not_null"] == 4
    s.add([order(100 + i, f"U{i % 4}") for i in range(8)], [user("U50")])
    s.run()
    s.check()
    before = s.files()
    s.add(users=[user("U11")])
    assert s.run()["user_name_is_not_null"] == 0
    s.check()
    mine = {f"user_bucket={r.b}" for r in spark.sql("SELECT 'U11' AS user_id").select(s.views.bucket().alias("b")).collect()}
    same = lambda f: "=" in f and "/feed" not in f and "bz_users" not in f
    gone = {f for f in before - s.files() if same(f)}
    assert gone and all(f.split("/")[2] in mine for f in gone)
    # its rows came in the first batch only
    assert {f.split("/")[3] for f in gone if "enriched" in f} == {"batch=0"}


def test_run_without_news_writes_nothing(spark, tmp_path, products):
    s = Shop(spark, tmp_path, products)
    assert s.run()["rows"] == 0
    s.add([order(i, f"U{i % 5}") for i in range(20)], [user("U1"), user("U2")])
    first = s.run()
    before = s.files()
    assert s.run() == first and s.files() == before
    s.add(users=[user("U99")])  # a user without orders
    assert s.run() == first and {f for f in s.files() if "bz_users" not in f and "feed" not in f} == {
        f for f in before if "bz_users" not in f and "feed" not in f
    }


@pytest.mark.parametrize("seed", [1, 2])
def test_any_order_of_batches(spark, tmp_path, products, seed):
    rng = random.Random(seed)
    s = Shop(spark, tmp_path, products)
    orders = [order(i, f"U{rng.randrange(9)}", rng.choice(["P1", "P2", "P9"]), rng.choice([0.1, 0.25, 1e6, 3.0])) for i in range(60)]
    users = [user(f"U{i}", v, 20 + 15 * v, f"r{v}", "gone" if (i, v) == (3, 2) else None) for i in range(8) for v in (1, 2)]
    rng.shuffle(orders)
    rng.shuffle(users)
    steps = [("orders", orders[:20]), ("orders", orders[20:40]), ("orders", orders[40:]), ("users", users[:5]), ("users", users[5:10]), ("users", users[10:])]
    rng.shuffle(steps)
    s.add(users=[user("U0", 0)])
    for kind, part in steps:
        s.add(**{kind: part})
        s.run()
    # products change too: one is new, one has another name, one is gone
    s.products = spark.createDataFrame(
        [("P2", "PC", "その他", 60.0), ("P9", "book", "PC本体", 1.0)], "product_id string, category string, subcategory string, price double"
    )
    s.run()
    s.check()


def test_failed_run_is_repeated(spark, tmp_path, products, monkeypatch):
    s = Shop(spark, tmp_path, products)
    s.add([order(i, f"U{i % 5}") for i in range(20)], [user("U1")])
    s.run()
    s.add([order(50 + i, f"U{i % 5}") for i in range(10)], [user("U2")])
    save = shop_views.save_text

    def fails_once(spark, line, path):
        monkeypatch.setattr(shop_views, "save_text", save)
        raise OSError("lost")

    monkeypatch.setattr(shop_views, "save_text", fails_once)
    with pytest.raises(Exception, match="lost"):
        s.run()
    assert s.run()["rows"] == 30
    s.check()


def test_old_facts_are_not_read_for_revenue(spark, tmp_path, products, monkeypatch):
    s = Shop(spark, tmp_path, products)
    s.add([order(i, f"U{i % 5}") for i in range(20)], [user("U1")])
    s.run()
    monkeypatch.setattr(shop_views, "_merged", lambda *a: pytest.fail("facts are read"))
    s.add([order(50, "U3")])
    assert s.run()["rows"] == 21


def test_first_run_rewrites_no_facts_and_joins_once(spark, tmp_path, products, monkeypatch):
    s = Shop(spark, tmp_path, products)
    s.add([order(i, f"U{i % 12}") for i in range(48)], [user(f"U{i}") for i in range(11)])
    replaced, joined = [], []
    replace, enrich = shop_views._replace, shop_views.enrich
    monkeypatch.setattr(shop_views, "_replace", lambda df, path, by: (replaced.append(path.split("/")[-1]), replace(df, path, by)))
    monkeypatch.setattr(shop_views, "enrich", lambda *a, **k: (joined.append(a[2]), enrich(*a, **k))[1])
    s.run()
    # the batch was joined to the present users, so nothing is healed
    assert replaced == ["ag_sales"] and joined == ["product_id", "user_id"]
    s.check()
    s.add(users=[user("U11"), user("U1", 2, label="new")])
    s.run()
    assert replaced == ["ag_sales", "sl_transactions_enriched"]
    s.check()


def test_heal_leaves_the_number_of_rows(spark, tmp_path, products):
    s = Shop(spark, tmp_path, products.unionAll(products))
    s.add([order(i, f"U{i % 4}") for i in range(12)], [user("U0")])
    s.run()
    s.add(users=[user("U1"), user("U0", 2)])
    s.run()
    s.check()


def test_buckets_are_done_in_passes(spark, tmp_path, products, monkeypatch):
    """A pass stages the rows of a few buckets only; together they give all rows."""
    s = Shop(spark, tmp_path, products)
    s.views = dataclasses.replace(s.views, pass_rows=40)
    staged = []
    replace = shop_views._replace
    monkeypatch.setattr(shop_views, "_replace", lambda df, path, by: (staged.append((path.split("/")[-1], df.count())), replace(df, path, by)))
    s.add([order(i, f"U{i % 12}") for i in range(60)], [user(f"U{i}") for i in range(9)])
    s.run()
    s.add(users=[user(f"U{i}", 2, label="new") for i in range(12)])
    s.run()
    s.check()
    largest = max(r["count"] for r in spark.read.parquet(s.views.facts).groupBy("user_bucket").count().collect())
    facts = [n for name, n in staged if name == "sl_transactions_enriched"]
    assert len(facts) > 1 and max(facts) <= max(40, largest)
    changed = spark.read.parquet(s.views.facts).filter("user_name = 'new'").select("user_bucket", "batch").distinct()
    assert sum(facts) == spark.read.parquet(s.views.facts).join(changed, ["user_bucket", "batch"], "left_semi").count()


def test_refresh_leaves_no_shuffle_files(spark, tmp_path, products):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    kept = lambda: {f for f in disk.getAllFiles().mkString("|").split("|") if "/shuffle_" in f}
    s = Shop(spark, tmp_path, products)
    s.add([order(i, f"U{i % 5}") for i in range(20)], [user("U1")])
    before = kept()
    s.run()
    assert not kept() - before
