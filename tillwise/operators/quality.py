"""Named data-quality rules and table checks.

A rule is ``name -> SQL predicate``.  A row for which the predicate is false or NULL
violates it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.scalar import conjunction, rate

Rules = Mapping[str, str]

# fixed rule sets of the shop jobs
AMOUNT_RULES: Rules = {
    "quantity_is_more_than_1": "quantity >= 1",
    "amount_is_more_than_1": "amount >= 1",
}
#: the master row was found (checks the dimension side)
MASTER_RULES: Rules = {
    "product_id_is_not_null": "_matched_products",
    "user_id_is_not_null": "_matched_users",
}
#: the fact carries a key (checks the fact side)
KEY_RULES: Rules = {
    "product_id_is_not_null": "product_id IS NOT NULL",
    "user_id_is_not_null": "user_id IS NOT NULL",
}


def holds(predicate: str | Column) -> Column:
    p = F.expr(predicate) if isinstance(predicate, str) else predicate
    return F.coalesce(p, F.lit(False))


def valid(rules: Rules) -> Column:
    return conjunction([holds(p) for p in rules.values()])


# --- rules on rows ---------------------------------------------------------------

def expect_all(df: DataFrame, rules: Rules, name: str = "expectations") -> tuple[DataFrame, Observation]:
    """Keep every row; count violations per rule while the rows pass by."""
    obs = Observation(name)
    metrics = [F.count_if(~holds(p)).alias(n) for n, p in rules.items()]
    return df.observe(obs, F.count("*").alias("rows"), *metrics), obs


def expect(df: DataFrame, name: str, predicate: str) -> tuple[DataFrame, Observation]:
    return expect_all(df, {name: predicate}, name)


def expect_all_or_drop(df: DataFrame, rules: Rules, name: str = "dropped") -> tuple[DataFrame, Observation]:
    """Drop rows that violate any rule, counting violations before the drop."""
    observed, obs = expect_all(df, rules, name)
    return observed.filter(valid(rules)), obs


def expect_or_drop(df: DataFrame, name: str, predicate: str) -> tuple[DataFrame, Observation]:
    return expect_all_or_drop(df, {name: predicate}, name)


def keep_valid(df: DataFrame, rules: Rules) -> DataFrame:
    return df.filter(valid(rules))


def with_validity(df: DataFrame, rules: Rules, out: str = "valid") -> DataFrame:
    return df.withColumn(out, valid(rules))


def split_valid(df: DataFrame, rules: Rules) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rows for quarantine); together they are the input."""
    ok = valid(rules)
    return df.filter(ok), df.filter(~ok)


def rule_report(df: DataFrame, rules: Rules) -> DataFrame:
    """One row per rule: total, passed and violating rows.  A single pass."""
    one = df.agg(
        F.count("*").alias("total_rows"), *[F.count_if(~holds(p)).alias(n) for n, p in rules.items()]
    )
    entries = F.array(*[F.struct(F.lit(n).alias("rule"), F.col(n).alias("violations")) for n in rules])
    return one.select("total_rows", F.explode(entries).alias("e")).select(
        "e.rule", "total_rows", (F.col("total_rows") - F.col("e.violations")).alias("passed"), "e.violations"
    )


# --- checks on tables ---------------------------------------------------------------

def check_key(df: DataFrame, cols: Sequence[str], name: str | None = None) -> DataFrame:
    """One row: NULL keys, duplicated keys, surplus rows, verdict."""
    any_null = conjunction([F.col(c).isNotNull() for c in cols])
    per_key = df.groupBy(*cols).agg(F.count("*").alias("n"))
    out = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum(F.when(~any_null, F.col("n"))), F.lit(0)).alias("null_keys"),
        F.count_if(any_null & (F.col("n") > 1)).alias("duplicate_keys"),
        F.coalesce(F.sum(F.when(any_null, F.col("n") - 1)), F.lit(0)).alias("surplus_rows"),
    )
    verdict = (F.col("null_keys") == 0) & (F.col("duplicate_keys") == 0)
    return out.select(F.lit(name or ",".join(cols)).alias("check_name"), "*", verdict.alias("passed"))


def duplicate_keys(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The duplicated keys themselves, with their number of rows."""
    return df.groupBy(*cols).agg(F.count("*").alias("n")).filter(F.col("n") > 1)


def check_fk(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str, name: str | None = None) -> DataFrame:
    """One row: child keys without a parent, distinct and by row.

    The child is reduced to one row per key before the join.
    """
    keys = child.groupBy(F.col(child_key).alias("__k")).agg(F.count("*").alias("n"))
    known = parent.select(F.col(parent_key).alias("__p")).distinct()
    joined = keys.join(known, F.col("__k") == F.col("__p"), "left")
    lost = F.col("__p").isNull()
    out = joined.agg(
        F.count("*").alias("child_keys"),
        F.count_if(lost).alias("orphan_keys"),
        F.coalesce(F.sum(F.when(lost, F.col("n"))), F.lit(0)).alias("orphan_rows"),
    )
    label = name or f"{child_key}->{parent_key}"
    return out.select(F.lit(label).alias("check_name"), "*", (F.col("orphan_keys") == 0).alias("passed"))


def check_totals(header: DataFrame, header_col: str, lines: DataFrame, line_col: str, name: str = "totals") -> DataFrame:
    """One row: the two exact totals, their difference and verdict."""
    total = lines.agg(F.sum(line_col)).scalar()
    out = header.agg(F.sum(header_col).alias("header_total")).withColumn("line_total", total)
    diff = F.col("header_total") - F.col("line_total")
    return out.select(
        F.lit(name).alias("check_name"),
        F.col("header_total").cast("double").alias("header_total"),
        F.col("line_total").cast("double").alias("line_total"),
        diff.cast("double").alias("difference"),
        F.coalesce(diff == 0, F.lit(False)).alias("passed"),
    )


def differing_totals(
    left: DataFrame, left_col: str, right: DataFrame, right_col: str, key: str, buckets: int = 4096
) -> DataFrame:
    """Keys whose exact totals differ: key, left_total, right_total, difference.

    Both sides are first summed by hash bucket of the key, the amounts as they are and
    with two weights drawn from the key, so that differences of several keys do not
    cancel out but by a chance of about 2^-60.  Sums are linear, hence a side may have
    any number of rows per key.  Only rows of buckets whose sums differ are shuffled by
    key; equal tables move their bucket sums alone.  NULL is a key like any other; a
    missing key and a NULL amount count as zero.  Amounts are taken as DECIMAL(18,2).
    """

    def parted(df: DataFrame, col: str) -> DataFrame:
        amount = F.coalesce(F.col(col).cast("decimal(18,2)"), F.lit(0).cast("decimal(18,2)"))
        bucket = F.pmod(F.xxhash64(F.col(key)), F.lit(buckets))
        return df.select(F.col(key), amount.alias("__x"), bucket.alias("__bucket"))

    def sums(df: DataFrame, sign: int) -> DataFrame:
        weights = [F.pmod(F.xxhash64(F.lit(salt), F.col(key)), F.lit(1 << 30)).cast("decimal(10,0)") for salt in (1, 2)]
        terms = [F.col("__x"), *[F.col("__x") * w for w in weights]]
        return df.groupBy("__bucket").agg(*[(F.sum(t).cast("decimal(38,2)") * sign).cast("decimal(38,2)").alias(f"s{i}") for i, t in enumerate(terms)])

    a, b = parted(left, left_col), parted(right, right_col)
    both = sums(a, 1).unionByName(sums(b, -1)).groupBy("__bucket").agg(*[F.sum(f"s{i}").alias(f"s{i}") for i in range(3)])
    odd = F.broadcast(both.filter("s0 <> 0 OR s1 <> 0 OR s2 <> 0").select("__bucket"))  # at most ``buckets`` rows

    def totals(df: DataFrame, is_left: bool) -> DataFrame:
        rows = df.join(odd, "__bucket", "left_semi").groupBy(key).agg(F.sum("__x").alias("__x"))
        zero = F.lit(0).cast("decimal(28,2)")
        pair = (F.col("__x"), zero) if is_left else (zero, F.col("__x"))
        return rows.select(key, *[c.alias(n) for c, n in zip(pair, ("left_total", "right_total"))])

    found = totals(a, True).unionByName(totals(b, False)).groupBy(key)
    found = found.agg(F.sum("left_total").alias("left_total"), F.sum("right_total").alias("right_total"))
    return found.withColumn("difference", F.col("left_total") - F.col("right_total")).filter("difference <> 0")


def run_checks(checks: Sequence[DataFrame]) -> DataFrame:
    """(check_name, passed) of every check and a last row with the overall verdict."""
    rows = [c.select("check_name", "passed") for c in checks]
    every = rows[0]
    for r in rows[1:]:
        every = every.unionByName(r)
    verdict = every.agg(F.bool_and("passed").alias("passed")).select(F.lit("ALL").alias("check_name"), "passed")
    return every.unionByName(verdict)


def check_distribution(df: DataFrame, col: str, expected: Mapping[str | None, float], tol: float) -> DataFrame:
    """Actual against expected percentage per value.

    Values outside ``expected`` are expected to be absent; an expected value that does
    not occur has share zero.  ``None`` stands for NULL.
    """
    spark = df.sparkSession
    want = spark.createDataFrame(
        [(k, float(v)) for k, v in expected.items()], f"__value string, expected_pct double"
    )
    have = df.groupBy(F.col(col).cast("string").alias("value")).agg(F.count("*").alias("cnt"))
    total = have.agg(F.sum("cnt")).scalar()
    both = have.join(want, F.col("value").eqNullSafe(F.col("__value")), "full").select(
        F.coalesce("value", "__value").alias("value"),
        F.coalesce("cnt", F.lit(0)).alias("cnt"),
        F.coalesce("expected_pct", F.lit(0.0)).alias("expected_pct"),
    )
    pct = F.col("cnt") * F.lit(100.0) / total
    return both.withColumn("actual_pct", pct).withColumn(
        "within", F.abs(F.col("actual_pct") - F.col("expected_pct")) <= F.lit(float(tol))
    )


def null_profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """NULL count and rate per column, in one pass."""
    one = df.agg(F.count("*").alias("n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    entries = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("nulls")) for c in cols])
    return one.select("n", F.explode(entries).alias("e")).select(
        "e.column_name", "e.nulls", rate("e.nulls", "n").alias("null_rate")
    )


def duplicate_profile(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows, distinct keys and the share of rows a dedup would remove."""
    per_key = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return per_key.agg(F.sum("n").alias("total_rows"), F.count("*").alias("distinct_keys")).withColumn(
        "duplicate_rate", F.lit(1.0) - rate("distinct_keys", "total_rows")
    )


def segment_ranges(df: DataFrame, segment: str, value: str, shares: Mapping[str, Column]) -> DataFrame:
    """Per segment: smallest, largest and mean value, and named row shares, in one pass."""
    picks = [
        (F.count_if(F.coalesce(p, F.lit(False))).cast("double") / F.count("*")).alias(n) for n, p in shares.items()
    ]
    return df.groupBy(segment).agg(
        F.count("*").alias("n"),
        F.min(value).alias("min_value"),
        F.max(value).alias("max_value"),
        (F.sum(value).cast("double") / F.count(value)).alias("mean_value"),
        *picks,
    )


def match_rate(df: DataFrame, predicted: str, labelled: str) -> DataFrame:
    """How often two classes agree; NULL agrees with NULL."""
    same = F.col(predicted).eqNullSafe(F.col(labelled))
    return df.agg(F.count("*").alias("total"), F.count_if(same).alias("matches")).withColumn(
        "match_rate", rate("matches", "total")
    )
