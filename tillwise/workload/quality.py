"""Change logs, data-quality checks and text extraction on the given tables."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalar as S
from ..operators import cdc as C
from ..operators import quality as Q
from ..operators import text as X
from ..operators import text_model
from ..operators.skew import skew_safe_join
from ..plans import retail, shop
from .registry import define, query
from .tables import CALL_COMPETITOR, CALL_RULES, Data

c = F.col

# --- change logs: orders as changes of their customer ---------------------------------

LOG = ["o_custkey"], ["o_orderdate", "o_orderkey"]

define(
    k_latest="""
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1"""
)


@query("c01_apply_changes", "SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM k_latest")
def _(d: Data) -> DataFrame:
    return C.apply_changes(d.orders, *LOG)


@query(
    "c02_apply_deletes",
    "SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM k_latest WHERE o_orderstatus <> 'F'",
)
def _(d: Data) -> DataFrame:
    return C.apply_changes(d.orders, *LOG, delete_when="o_orderstatus = 'F'")


@query("c03_exclude_columns", "SELECT o_custkey, o_orderkey, o_totalprice, o_orderdate FROM k_latest")
def _(d: Data) -> DataFrame:
    return C.apply_changes(d.orders, *LOG, except_cols=["o_orderstatus", "o_orderpriority"])


@query(
    "c04_two_feeds_one_table",
    "SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM k_latest WHERE o_orderstatus <> 'F'",
)
def _(d: Data) -> DataFrame:
    live, late = d.orders.filter("o_orderpriority < '3'"), d.orders.filter("o_orderpriority >= '3'")
    return C.apply_changes(C.merge_logs(late, live), *LOG, delete_when="o_orderstatus = 'F'")


@query("c07_fill_late_attributes", "SELECT o_orderkey, o_custkey, c_name, c_mktsegment FROM orders LEFT JOIN customer ON o_custkey = c_custkey")
def _(d: Data) -> DataFrame:
    people = d.customer.select(c("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment")
    facts = d.orders.select("o_orderkey", "o_custkey")
    early = facts.join(people.filter("c_mktsegment <> 'HOUSEHOLD'"), "o_custkey", "left")
    return C.refresh_enriched(early, people, "o_custkey", ["c_name", "c_mktsegment"], ["o_orderkey", "o_custkey"])


# --- rules on rows -------------------------------------------------------------------------

EMAIL = {"valid_email_format": "email LIKE '%@%'"}


def rule_sql(relation: str, rules: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{n}' AS rule, count(*) AS total_rows, count(*) FILTER (WHERE coalesce({p}, false)) AS passed, "
        f"count(*) FILTER (WHERE NOT coalesce({p}, false)) AS violations FROM {relation}"
        for n, p in rules.items()
    )


@query("q01_warn_rule", rule_sql("t_users", EMAIL))
def _(d: Data) -> DataFrame:
    return Q.rule_report(d.t_users, EMAIL)


@query("q02_drop_rule", "SELECT order_id, product_id, quantity FROM t_transactions WHERE quantity >= 1")
def _(d: Data) -> DataFrame:
    kept, _ = Q.expect_or_drop(d.t_transactions, "quantity_is_more_than_1", "quantity >= 1")
    return kept.select("order_id", "product_id", "quantity")


@query("q03_warn_rules", rule_sql("t_transactions", dict(Q.AMOUNT_RULES)))
def _(d: Data) -> DataFrame:
    return Q.rule_report(d.t_transactions, Q.AMOUNT_RULES)


@query("q04_drop_rules", "SELECT order_id, product_id, user_id, quantity, amount FROM t_transactions WHERE quantity >= 1 AND amount >= 1")
def _(d: Data) -> DataFrame:
    kept, _ = Q.expect_all_or_drop(d.t_transactions, Q.AMOUNT_RULES)
    return kept.select("order_id", "product_id", "user_id", "quantity", "amount")


@query(
    "q05_rule_library",
    rule_sql("t_enriched", {**Q.AMOUNT_RULES, "product_id_is_not_null": "has_product", "user_id_is_not_null": "has_user"}),
)
def _(d: Data) -> DataFrame:
    from ..operators.joins import enrich

    wide = enrich(d.t_transactions, d.t_users, "user_id", [], matched="_matched_users")
    wide = enrich(wide, d.t_products, "product_id", [], matched="_matched_products")
    return Q.rule_report(wide, {**Q.AMOUNT_RULES, **Q.MASTER_RULES})


@query(
    "q06_route_invalid",
    "SELECT order_id, product_id, user_id, CASE WHEN quantity >= 1 AND amount >= 1 THEN 'valid' ELSE 'quarantine' END AS route FROM t_transactions",
)
def _(d: Data) -> DataFrame:
    good, bad = Q.split_valid(d.t_transactions, Q.AMOUNT_RULES)
    tagged = good.withColumn("route", F.lit("valid")).unionByName(bad.withColumn("route", F.lit("quarantine")))
    return tagged.select("order_id", "product_id", "user_id", "route")


# --- checks on tables ---------------------------------------------------------------------------


def key_sql(relation: str, cols: str, name: str) -> str:
    nulls = " OR ".join(f"{x} IS NULL" for x in cols.split(", "))
    return f"""SELECT '{name}' AS check_name, sum(n)::BIGINT AS total_rows, coalesce(sum(n) FILTER (WHERE {nulls}), 0)::BIGINT AS null_keys,
    count(*) FILTER (WHERE NOT ({nulls}) AND n > 1) AS duplicate_keys, coalesce(sum(n - 1) FILTER (WHERE NOT ({nulls})), 0)::BIGINT AS surplus_rows,
    coalesce(sum(n) FILTER (WHERE {nulls}), 0) = 0 AND count(*) FILTER (WHERE NOT ({nulls}) AND n > 1) = 0 AS passed
    FROM (SELECT {cols}, count(*) AS n FROM {relation} GROUP BY ALL)"""


@query("q07_primary_key", key_sql("orders", "o_orderkey", "orders"))
def _(d: Data) -> DataFrame:
    return Q.check_key(d.orders, ["o_orderkey"], "orders")


@query("q07_composite_key", key_sql("lineitem", "l_orderkey, l_linenumber", "lineitem"))
def _(d: Data) -> DataFrame:
    return Q.check_key(d.lineitem, ["l_orderkey", "l_linenumber"], "lineitem")


@query("q07_duplicate_keys", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def _(d: Data) -> DataFrame:
    return Q.duplicate_keys(d.lineitem, ["l_orderkey", "l_linenumber"])


def fk_sql(child: str, key: str, parent: str, parent_key: str, name: str) -> str:
    return f"""SELECT '{name}' AS check_name, count(*) AS child_keys, count(*) FILTER (WHERE lost) AS orphan_keys,
    coalesce(sum(n) FILTER (WHERE lost), 0)::BIGINT AS orphan_rows, count(*) FILTER (WHERE lost) = 0 AS passed
    FROM (SELECT {key}, count(*) AS n, {key} NOT IN (SELECT {parent_key} FROM {parent}) AS lost FROM {child} GROUP BY ALL)"""


@query("q08_foreign_key", fk_sql("t_transactions", "user_id", "t_users", "user_id", "transactions->users"))
def _(d: Data) -> DataFrame:
    return Q.check_fk(d.t_transactions, d.t_users, "user_id", "user_id", "transactions->users")


@query(
    "q09_total_reconciliation",
    """SELECT 'orders=lines' AS check_name, a::DOUBLE AS header_total, b::DOUBLE AS line_total, (a - b)::DOUBLE AS difference, a = b AS passed FROM
    (SELECT sum(CAST(o_totalprice AS DECIMAL(18,2))) AS a FROM orders), (SELECT sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS b FROM lineitem)""",
)
def _(d: Data) -> DataFrame:
    heads = d.orders.select(S.money("o_totalprice").alias("x"))
    return Q.check_totals(heads, "x", d.lineitem.select(S.money("l_extendedprice").alias("y")), "y", "orders=lines")


@query(
    "q09_where_totals_differ",
    """SELECT l_orderkey, (t + d)::DOUBLE AS left_total, t::DOUBLE AS right_total, d::DOUBLE AS difference FROM (
    SELECT l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS t, CASE l_orderkey % 50 WHEN 7 THEN 1.00 WHEN 8 THEN -1.00 ELSE 0.00 END AS d FROM lineitem GROUP BY 1) WHERE d <> 0""",
)
def _(d: Data) -> DataFrame:
    """Order totals, two in fifty of them off by 1.00 up or down, against the lines."""
    lines = d.lineitem.select("l_orderkey", S.money("l_extendedprice").alias("y"))
    off = F.expr("CASE l_orderkey % 50 WHEN 7 THEN 1.00BD WHEN 8 THEN -1.00BD ELSE 0.00BD END")
    heads = lines.groupBy("l_orderkey").agg((F.sum("y") + F.first(off)).alias("x"))
    found = Q.differing_totals(heads, "x", lines, "y", "l_orderkey")
    return found.select("l_orderkey", *[F.col(n).cast("double").alias(n) for n in ("left_total", "right_total", "difference")])


define(
    q_suite=f"""
SELECT check_name, passed FROM ({key_sql("orders", "o_orderkey", "orders")})
UNION ALL SELECT check_name, passed FROM ({key_sql("lineitem", "l_orderkey, l_linenumber", "lineitem")})
UNION ALL SELECT check_name, passed FROM ({fk_sql("lineitem", "l_orderkey", "orders", "o_orderkey", "lines->orders")})
UNION ALL SELECT check_name, passed FROM ({fk_sql("lineitem", "l_partkey", "part", "p_partkey", "lines->parts")})"""
)


@query("q10_check_suite", "SELECT * FROM q_suite UNION ALL SELECT 'ALL', bool_and(passed) FROM q_suite")
def _(d: Data) -> DataFrame:
    return Q.run_checks(
        [
            Q.check_key(d.orders, ["o_orderkey"], "orders"),
            Q.check_key(d.lineitem, ["l_orderkey", "l_linenumber"], "lineitem"),
            Q.check_fk(d.lineitem, d.orders, "l_orderkey", "o_orderkey", "lines->orders"),
            Q.check_fk(d.lineitem, d.part, "l_partkey", "p_partkey", "lines->parts"),
        ]
    )


STATUS_SHARES = {"O": 35.0, "F": 30.0, "X": 5.0, None: 0.0}


@query(
    "q11_distribution",
    """SELECT coalesce(h.value, w.v) AS value, coalesce(cnt, 0) AS cnt, coalesce(e, 0.0::DOUBLE) AS expected_pct,
    coalesce(cnt, 0) * 100.0::DOUBLE / (SELECT count(*) FROM orders) AS actual_pct,
    abs(coalesce(cnt, 0) * 100.0::DOUBLE / (SELECT count(*) FROM orders) - coalesce(e, 0)) <= 3 AS within
    FROM (SELECT o_orderstatus AS value, count(*) AS cnt FROM orders GROUP BY 1) h FULL JOIN
    (VALUES ('O', 35.0::DOUBLE), ('F', 30.0), ('X', 5.0), (NULL, 0.0)) w(v, e) ON h.value IS NOT DISTINCT FROM w.v""",
)
def _(d: Data) -> DataFrame:
    return Q.check_distribution(d.orders, "o_orderstatus", STATUS_SHARES, 3)


@query(
    "q12_null_profile",
    " UNION ALL ".join(
        f"SELECT '{n}' AS column_name, count(*) FILTER (WHERE {n} IS NULL) AS nulls, count(*) FILTER (WHERE {n} IS NULL)::DOUBLE / count(*) AS null_rate FROM t_enriched"
        for n in ("user_name", "age", "category", "subcategory", "amount")
    ),
)
def _(d: Data) -> DataFrame:
    wide = shop.enrich_transactions(d.t_transactions, d.t_users, d.t_products, master_rules=None)
    return Q.null_profile(wide, ["user_name", "age", "category", "subcategory", "amount"])


@query(
    "q12_duplicate_profile",
    """SELECT count(*) AS total_rows, count(DISTINCT (l_orderkey, l_linenumber)) AS distinct_keys,
    1.0::DOUBLE - count(DISTINCT (l_orderkey, l_linenumber))::DOUBLE / count(*) AS duplicate_rate FROM lineitem""",
)
def _(d: Data) -> DataFrame:
    return Q.duplicate_profile(d.lineitem, ["l_orderkey", "l_linenumber"])


@query(
    "q13_segment_ranges",
    """SELECT behavior_cluster, count(*) AS n, CAST(min(hour(order_datetime)) AS INT) AS min_value, CAST(max(hour(order_datetime)) AS INT) AS max_value,
    sum(hour(order_datetime))::DOUBLE / count(*) AS mean_value, count(*) FILTER (WHERE dayofweek(order_datetime) IN (0, 6))::DOUBLE / count(*) AS weekend_share,
    count(*) FILTER (WHERE total_quantity >= 10)::DOUBLE / count(*) AS big_basket_share FROM r_heads h JOIN r_clusters k ON h.user_id = k.user_id GROUP BY 1""",
)
def _(d: Data) -> DataFrame:
    clusters = retail.user_clusters(d.order_times, d.r_lines)
    joined = skew_safe_join(d.order_times, clusters, ["user_id"], "inner").withColumn("h", F.hour("order_datetime"))
    shares = {"weekend_share": S.is_weekend("order_datetime"), "big_basket_share": c("total_quantity") >= 10}
    return Q.segment_ranges(joined, "behavior_cluster", "h", shares)


define(
    q_labelled="""
SELECT k.user_id, k.behavior_cluster, CASE WHEN k.user_id % 4 = 0 THEN '5' WHEN k.user_id % 4 = 1 THEN '2' END AS label FROM r_clusters k"""
)


@query(
    "q14_predicted_vs_label",
    """SELECT count(*) AS total, count(*) FILTER (WHERE behavior_cluster IS NOT DISTINCT FROM label) AS matches,
    count(*) FILTER (WHERE behavior_cluster IS NOT DISTINCT FROM label)::DOUBLE / count(*) AS match_rate FROM q_labelled""",
)
def _(d: Data) -> DataFrame:
    labels = d.r_users.selectExpr("user_id", "CASE user_id % 4 WHEN 0 THEN '5' WHEN 1 THEN '2' END AS label")
    return Q.match_rate(retail.user_clusters(d.order_times, d.r_lines).join(labels, "user_id"), "behavior_cluster", "label")


@query(
    "q14_class_distribution",
    """SELECT coalesce(behavior_cluster, 'none') AS value, count(*) AS cnt, round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM r_clusters), 1) AS pct FROM r_clusters GROUP BY 1""",
)
def _(d: Data) -> DataFrame:
    from ..operators.aggregates import with_share

    classes = retail.user_clusters(d.order_times, d.r_lines).select(F.coalesce("behavior_cluster", F.lit("none")).alias("value"))
    return with_share(classes, ["value"])


# --- text to fields ----------------------------------------------------------------------------------


@query(
    "e01_extract_fields",
    "SELECT call_id, purpose, urgency_level, trouble_type, next_intent, resolution_status, competitor_mention, operator_action FROM c_calls",
)
def _(d: Data) -> DataFrame:
    fields = X.extract_fields(d.c_raw_calls, "transcript", CALL_RULES, CALL_COMPETITOR)
    return fields.select("call_id", "extracted.*")


@query("e02_mention_flag", f"SELECT doc_id, regexp_matches(text, '{CALL_COMPETITOR}') AS competitor_mention FROM documents")
def _(d: Data) -> DataFrame:
    return d.documents.select("doc_id", X.mentions("text", CALL_COMPETITOR).alias("competitor_mention"))


@query(
    "e03_summary",
    """SELECT conv_id, turn, left(string_split(text, chr(10))[1], 50) AS summary FROM conversations""",
)
def _(d: Data) -> DataFrame:
    spoken = F.concat(F.col("role"), F.lit("："), F.col("text"))
    return d.conversations.select("conv_id", "turn", X.summarize(spoken, speaker="user").alias("summary"))


@query(
    "e04_explode_turns",
    """SELECT conv_id, no, CAST(i - 1 AS INT) AS turn, CASE WHEN regexp_matches(line, '^[^：]*：') THEN regexp_extract(line, '^([^：]*)：', 1) END AS speaker,
    regexp_replace(line, '^[^：]*：', '') AS words FROM (SELECT conv_id, turn AS no, unnest(string_split(role || '：' || text, chr(10))) AS line,
    generate_subscripts(string_split(role || '：' || text, chr(10)), 1) AS i FROM conversations)""",
)
def _(d: Data) -> DataFrame:
    spoken = d.conversations.select("conv_id", c("turn").alias("no"), F.concat(c("role"), F.lit("："), c("text")).alias("transcript"))
    return X.explode_turns(spoken, ["conv_id", "no"], "transcript")


@query("e05_model_hook", "SELECT doc_id, length(text) AS n_chars, length(text) > 2000 AS is_long FROM documents")
def _(d: Data) -> DataFrame:
    def toy(batch: pd.DataFrame) -> pd.DataFrame:
        n = batch["text"].str.len()
        return pd.DataFrame({"doc_id": batch["doc_id"], "n_chars": n, "is_long": n > 2000})

    return X.infer_batches(d.documents, toy, "doc_id bigint, n_chars bigint, is_long boolean", ["doc_id", "text"])


@query("e05_text_model")
def _(d: Data) -> DataFrame:
    """Every document's quality by a model of all labels; hashed n-grams have no SQL, tests hold labels out."""
    labelled = d.documents.join(d.labels, "doc_id")
    model = text_model.train(labelled, "text", "quality", n=2, buckets=1 << 18)
    return text_model.classify(d.documents, ["doc_id"], "text", model, "int", "quality")


@query(
    "e06_side_by_side",
    "SELECT call_id, inquiry_type, purpose, trouble_type, urgency_level, left(transcript, 150) AS transcript_preview FROM c_calls",
)
def _(d: Data) -> DataFrame:
    return X.side_by_side(
        d.c_raw_calls, d.c_calls, "call_id", ["inquiry_type"], ["purpose", "trouble_type", "urgency_level"], "transcript"
    )
