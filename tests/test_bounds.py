"""Exact files, descent into differing totals, sketches, and crowded time buckets."""

import datetime as dt
import json
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tests.conftest import rows
from tillwise.operators import aggregates as A
from tillwise.operators import quality as Q
from tillwise.operators import windows as W
from tillwise.sinks import tables as K


@pytest.mark.parametrize("parts, n, per_file, tasks", [(1, 95, 10, 100), (7, 95, 10, 100), (13, 100, 10, 3), (40, 23, 5, 1), (3, 4, 10, 100)])
def test_exact_files(spark, tmp_path, parts, n, per_file, tasks):
    df = spark.range(n).select("id", F.concat(F.lit("name "), "id").alias("name")).repartition(parts)
    for fmt in ("csv", "json"):
        out = tmp_path / fmt
        assert K.export_exact(df, str(out), fmt, per_file, tasks) == -(-n // per_file)
        texts = [p.read_text().splitlines()[1 if fmt == "csv" else 0 :] for p in out.glob(f"part-*.{fmt}")]
        sizes = sorted(len(t) for t in texts if t)
        assert sizes == sorted([per_file] * (n // per_file) + ([n % per_file] if n % per_file else []))
        ids = [int(line.split(",")[0]) if fmt == "csv" else json.loads(line)["id"] for t in texts for line in t]
        assert sorted(ids) == list(range(n))


def test_exact_files_of_nothing(spark, tmp_path):
    assert K.export_exact(spark.range(0), str(tmp_path / "none"), "json", 10) == 0
    assert [p for p in (tmp_path / "none").glob("part-*") if p.read_text()] == []


MONEY = "k string, x decimal(18,2)"


def test_differing_totals_against_brute_force(spark):
    rng = random.Random(3)
    heads, lines = {}, []
    for i in range(300):
        amounts = [Decimal(rng.randrange(-500, 500)) / 100 for _ in range(rng.randrange(4))]
        lines += [(f"k{i}", a) for a in amounts]
        heads[f"k{i}"] = sum(amounts, Decimal(0))
    heads["k1"] += Decimal("0.01")
    heads["k2"] -= Decimal("0.01")  # all differences together are zero
    heads["k299"] += Decimal(5)
    lines.append((None, Decimal(-5)))  # a NULL key, missing on the left
    lines.append(("k5", None))  # a NULL amount counts as zero
    left, right = spark.createDataFrame(list(heads.items()), MONEY), spark.createDataFrame(lines, MONEY)
    want = [("k1", Decimal("0.01")), ("k2", Decimal("-0.01")), ("k299", Decimal(5)), (None, Decimal(5))]
    for buckets in (1, 8, 4096):  # one bucket: the plain sums are equal there
        got = Q.differing_totals(left, "x", right, "x", "k", buckets).select("k", "difference")
        assert rows(got) == sorted(want, key=lambda r: tuple((v is None, str(v)) for v in r))


def test_equal_tables_move_bucket_sums_only(spark):
    df = spark.range(5000).select("id", (F.col("id") % 97).cast("decimal(18,2)").alias("x"))
    out = Q.differing_totals(df, "x", df.repartition(5), "x", "id")
    assert out.count() == 0
    assert Q.differing_totals(df.limit(0), "x", df.limit(0), "x", "id").count() == 0


def test_sketches_unite_in_any_order(spark):
    df = spark.range(60_000).select((F.col("id") % 20_000).alias("who"), (F.col("id") % 12).cast("int").alias("month"))
    df = df.unionByName(spark.sql("SELECT CAST(NULL AS BIGINT) AS who, 3 AS month"))
    sketches = A.distinct_sketches(df, ["month"], "who")
    whole = A.unite_sketches(sketches, [F.lit(1).alias("g")]).first()["distinct"]
    assert abs(whole - 20_000) <= 0.049 * 20_000
    halves = sketches.groupBy((F.col("month") % 2).alias("h")).agg(F.hll_union_agg("sketch").alias("sketch"))
    assert A.unite_sketches(halves, [F.lit(1).alias("g")]).first()["distinct"] == whole
    few = A.unite_sketches(A.distinct_sketches(df.filter("who < 50"), ["month"], "who"), []).first()["distinct"]
    assert few == 50


def crowd(spark, n=3000):
    """One entity with most rows in one second, one with a few rows, one without a time."""
    at = dt.datetime(2024, 1, 1, 10, 0, 0)
    data = [("hot", at if i % 10 else at + dt.timedelta(minutes=i % 7), i * 7919 % n) for i in range(n)]
    data += [("cold", at + dt.timedelta(days=i), i) for i in range(9)] + [("none", None, i) for i in range(300)]
    return spark.createDataFrame(data, "e string, ts timestamp, id int")


def test_crowded_second_is_numbered(spark):
    df = crowd(spark)
    plain = df.withColumn("seq", F.row_number().over(Window.partitionBy("e").orderBy("ts", "id")))
    assert rows(W.event_sequence(df, "e", "ts", ["id"], bucket_rows=100)) == rows(plain)
    assert rows(W.event_sequence(df, "e", "ts", ["id"])) == rows(plain)


def test_crowded_second_is_cut(spark):
    parts = W.split_crowded(crowd(spark).withColumn("b", F.date_trunc("minute", "ts")), "e", "b", ["ts", "id"], 100, "s")
    sizes = parts.groupBy("e", "b", "s").count().agg(F.max("count"), F.count("*")).first()
    assert sizes[0] < 250 and sizes[1] > 40
    assert parts.filter("e = 'cold' AND s <> 0").count() == 0 and parts.count() == 3309


def test_unit_is_found_in_one_pass(spark):
    df = crowd(spark)
    assert [W._bucket_unit(df, "e", "ts", most) for most in (10_000, 100, 1)] == ["month", "minute", "minute"]
    days = spark.range(100).select(F.lit("a").alias("e"), F.expr("timestamp'2024-01-01' + make_interval(0,0,0,0,cast(id as int))").alias("ts"))
    assert [W._bucket_unit(days, "e", "ts", most) for most in (100, 50, 10, 1)] == ["month", "day", "hour", "hour"]
