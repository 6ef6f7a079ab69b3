"""Shop jobs: two transaction feeds and a customer change feed to revenue tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.ladders import age_group3
from ..operators.aggregates import pivot_sums
from ..operators.joins import enrich
from ..operators.quality import AMOUNT_RULES, KEY_RULES, MASTER_RULES, Rules, keep_valid, with_validity
from ..streaming.changes import KeyedTable, stream_apply_changes
from ..streaming.dedup import dedup_stream, late_rows, observed
from ..streaming.ingest import append_flow, ingest_files, stream_csv_named, stream_table
from ..functions.scalar import parse_bool, to_date_safe

# fixed values: subcategories with a column of their own
SUBCATEGORIES: Mapping[str, Sequence[str]] = {"pc_quantity": ["PC本体"], "peripheral_quantity": ["周辺機器"]}
OTHER_QUANTITY = "other_quantity"
# fixed values: rules that only warn
WARN_RULES: Rules = {
    "valid_email_format": "email LIKE '%@%'",
    "valid_date": "transaction_date >= '2020-01-01'",
}

USER_RENAMES = {
    "name": "user_name", "registration_date": "user_registration_date", "last_updated": "user_last_updated",
}


def master_columns(master: DataFrame, key: str) -> list[str]:
    """Columns that transactions take from a master table."""
    return [c for c in master.columns if c != key and not c.startswith("_")]


def enrich_transactions(
    transactions: DataFrame,
    users: DataFrame,
    products: DataFrame,
    master_rules: Rules | None = MASTER_RULES,
    amount_type: str = "double",
) -> DataFrame:
    """Transactions with their user and product and calendar text columns.

    Works on a batch or a stream of transactions, and on sums of them.  Rows without a
    master row are dropped under ``master_rules`` and kept with NULL attributes when it is
    ``None``.
    """
    user_cols = master_columns(users, "user_id")
    product_cols = master_columns(products, "product_id")
    # the wider user columns come last, so fewer bytes are moved and rows lie by user
    joined = enrich(transactions, products, "product_id", product_cols, matched="_matched_products")
    joined = enrich(joined, users, "user_id", user_cols, matched="_matched_users")
    joined = joined.select(*transactions.columns, *user_cols, "_matched_users", *product_cols, "_matched_products")
    if master_rules:
        joined = keep_valid(joined, master_rules)
    when = F.col("transaction_date")
    return (
        joined.withColumnsRenamed({k: v for k, v in USER_RENAMES.items() if k in user_cols})
        .withColumns(
            {
                "transaction_yyyymmdd": F.date_format(when, "yyyy-MM-dd"),
                "transaction_yyyymm": F.date_format(when, "yyyy-MM"),
                "transaction_yyyy": F.date_format(when, "yyyy"),
                "amount": F.col("amount").cast(amount_type),
                "price": F.col("price").cast("double"),
            }
        )
        .drop("_matched_users", "_matched_products", "_rescued_data_users", "_rescued_data_transactions")
    )


def revenue_by_subcategory(tx: DataFrame, by: Sequence[str] = (), orders: Column | None = None) -> DataFrame:
    """Per subcategory; ``tx`` may be sums of transactions, with the number of ``orders`` stated.

    ``by`` adds grouping columns, here and below.
    """
    return tx.groupBy(*by, "category", "subcategory").agg(
        F.sum("amount").alias("sum_revenue"), F.sum("quantity").alias("sum_quantity"),
        (F.count("order_id") if orders is None else orders).alias("order_count"),
    )


def revenue_by_user_segment(tx: DataFrame, by: Sequence[str] = (), orders: Column | None = None) -> DataFrame:
    return tx.groupBy(*by, age_group3("age").alias("age_group"), "gender", "region").agg(
        F.sum("amount").alias("sum_revenue"), (F.count("order_id") if orders is None else orders).alias("order_count")
    )


def user_categories(
    tx: DataFrame, wanted: Mapping[str, Sequence[str]] = SUBCATEGORIES, other: str = OTHER_QUANTITY, by: Sequence[str] = ()
) -> DataFrame:
    """Quantity per user and subcategory, with the age band."""
    return (
        tx.groupBy(*by, "user_id", "age")
        .agg(*pivot_sums("quantity", "subcategory", wanted, other))
        .withColumn("age_group", age_group3("age"))
    )


def revenue_report(
    tx: DataFrame,
    wanted: Mapping[str, Sequence[str]] = SUBCATEGORIES,
    other: str = OTHER_QUANTITY,
    by: Sequence[str] = (),
    orders: Column | None = None,
) -> DataFrame:
    """Sales, orders, last purchase and quantities per user."""
    last = F.col("last_purchase_timestamp")
    return (
        tx.groupBy(*by, "user_id", "user_name", "gender", "age")
        .agg(
            F.sum("amount").alias("total_sales"),
            (F.count("order_id") if orders is None else orders).alias("total_orders"),
            F.max("transaction_date").alias("last_purchase_timestamp"),
            *pivot_sums("quantity", "subcategory", wanted, other),
        )
        .withColumns(
            {
                "age_group": age_group3("age"),
                "last_purchase_date": F.date_format(last, "yyyy-MM-dd"),
                "last_purchase_month": F.date_format(last, "yyyy-MM"),
                "last_purchase_year": F.date_format(last, "yyyy"),
            }
        )
    )


# --- incremental run over a landing folder --------------------------------------------------

#: fixed layout of the customer change feed
USER_CHANGE_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("age", T.IntegerType()),
        T.StructField("gender", T.StringType()),
        T.StructField("email", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("registration_date", T.StringType()),
        T.StructField("email_opt_in", T.StringType()),
        T.StructField("last_updated", T.TimestampType()),
        T.StructField("operation", T.StringType()),
    ]
)


def user_changes(raw: DataFrame) -> DataFrame:
    """Typed customer changes."""
    return raw.withColumns(
        {"registration_date": to_date_safe("registration_date"), "email_opt_in": parse_bool("email_opt_in")}
    )


def users_table(base: str) -> KeyedTable:
    return KeyedTable(f"{base}/bz_users", ["user_id"], ["last_updated"], ["operation"])


def refresh_shop(
    spark: SparkSession,
    landing: str,
    base: str,
    products: DataFrame,
    feeds: Sequence[str] = ("transactions_east", "transactions_west"),
    user_feeds: Mapping[str, str | None] = {"users": None},
    dedup_mode: str = "bounded",
    delay: str = "10 minutes",
) -> dict[str, int]:
    """Take everything new below ``landing`` through to the revenue tables and stop.

    ``user_feeds`` maps a folder with customer changes to the predicate that marks a
    deletion (``None``: deletions are ignored).  Returns counts of the run.
    """
    stats: dict[str, int] = {}
    cp, bronze = f"{base}/_checkpoints", f"{base}/bz_transactions"
    for feed in feeds:
        stats[feed] = ingest_files(
            spark, f"{landing}/{feed}", bronze, f"{cp}/{feed}", flow=feed,
            rescued_col="_rescued_data_transactions",
        )
    for feed, delete_when in user_feeds.items():
        raw = stream_csv_named(
            spark, f"{landing}/{feed}", USER_CHANGE_SCHEMA, f"{base}/bz_user_changes", f"{cp}/{feed}/files", feed,
            "_rescued_data_users",
        )
        query = stream_apply_changes(user_changes(raw), users_table(base), f"{cp}/{feed}", feed, delete_when)
        stats[f"{feed}_unordered"] = query.unordered

    rows = stream_table(spark, bronze).drop("flow", "batch").observe(
        "drop_rules", *(F.count_if(~F.coalesce(F.expr(rule), F.lit(False))).alias(name) for name, rule in KEY_RULES.items())
    )
    rows = with_validity(keep_valid(rows, KEY_RULES), AMOUNT_RULES)
    query = append_flow(
        dedup_stream(rows, ["order_id"], "transaction_date", delay, dedup_mode).withColumn(
            "amount", F.col("amount").cast("double")
        ),
        f"{base}/sl_transactions",
        f"{cp}/sl_transactions",
    )
    stats.update({f"dropped_{name}": observed(query, "drop_rules").get(name, 0) for name in KEY_RULES})
    stats["late_rows"] = late_rows(query)
    stats.update(refresh_views(spark, base, products))
    return stats


def refresh_views(spark: SparkSession, base: str, products: DataFrame) -> dict[str, int]:
    """Bring the enriched table and the revenue tables up to date (:mod:`.shop_views`).

    Attributes that arrived late fill the gaps of earlier rows; the counts are over all rows.
    """
    from . import shop_views

    seen = shop_views.refresh_views(spark, shop_views.ShopViews(base, users_table(base)), products)
    warned = {f"warned_{name}": seen[name] for name in (*WARN_RULES, *AMOUNT_RULES)}
    return {"enriched": seen["rows"], "without_user": seen["user_name_is_not_null"], **warned}
