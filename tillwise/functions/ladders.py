"""First-match-wins rule ladders and the scores and segments built on them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalar import Col, _c, map_labels


def ladder(rules: Sequence[tuple[Column, Any]], default: Any = None) -> Column:
    """Value of the first rule that holds.  A NULL condition does not hold."""
    expr = F
    for pred, value in rules:
        expr = expr.when(pred, value if isinstance(value, Column) else F.lit(value))
    return expr.otherwise(default if isinstance(default, Column) else F.lit(default))


def at_most(col: Col, steps: Sequence[tuple[float, Any]], default: Any) -> Column:
    return ladder([(_c(col) <= limit, v) for limit, v in steps], default)


def at_least(col: Col, steps: Sequence[tuple[float, Any]], default: Any) -> Column:
    return ladder([(_c(col) >= limit, v) for limit, v in steps], default)


def below(col: Col, steps: Sequence[tuple[float, Any]], default: Any) -> Column:
    return ladder([(_c(col) < limit, v) for limit, v in steps], default)


# --- recency, frequency, monetary ---------------------------------------------

# fixed values: score limits, best score first
RECENCY_DAYS = (7, 14, 30, 60)
FREQUENCY_ORDERS = (10, 5, 3, 2)
MONETARY_AMOUNT = (50000, 20000, 10000, 5000)

# fixed values: segment and customer type labels
LOYAL, REGULAR, NEW, AT_RISK, DORMANT, GENERAL = (
    "ロイヤル顧客", "常連顧客", "新規顧客", "離脱リスク", "休眠顧客", "一般顧客",
)
TYPE_NEW, TYPE_EXISTING = "新規", "既存"


@dataclass(frozen=True)
class RfmLimits:
    """Limits of scores 5, 4, 3, 2 for each dimension; anything else scores 1."""

    recency: Sequence[float] = RECENCY_DAYS
    frequency: Sequence[float] = FREQUENCY_ORDERS
    monetary: Sequence[float] = MONETARY_AMOUNT


def rfm_score_columns(limits: RfmLimits = RfmLimits()) -> dict[str, Column]:
    def scored(xs: Sequence[float]) -> list[tuple[float, int]]:
        return list(zip(xs, (5, 4, 3, 2)))

    return {
        "r_score": at_most("recency", scored(limits.recency), 1),
        "f_score": at_least("frequency", scored(limits.frequency), 1),
        "m_score": at_least("monetary", scored(limits.monetary), 1),
    }


def rfm_segment(r: Col = "r_score", f: Col = "f_score", m: Col = "m_score") -> Column:
    """Segment from the three scores; a middle recency stays in the general group."""
    r, f, m = _c(r), _c(f), _c(m)
    recent, lapsed, often = r >= 4, r <= 2, f >= 3
    return ladder(
        [
            (recent & (f >= 4) & (m >= 4), LOYAL),
            (recent & often, REGULAR),
            (recent & (f <= 2), NEW),
            (lapsed & often, AT_RISK),
            (lapsed & (f <= 2), DORMANT),
        ],
        GENERAL,
    )


def customer_type(frequency: Col = "frequency", new_upto: int = 1) -> Column:
    """New with one to ``new_upto`` orders (exactly one by default), existing otherwise."""
    return ladder([(_c(frequency).between(1, new_upto), TYPE_NEW)], TYPE_EXISTING)


def order_customer_type(is_first_order: Col = "is_first_order") -> Column:
    """New only on a flagged first order; an unknown flag counts as existing."""
    return ladder([(_c(is_first_order), TYPE_NEW)], TYPE_EXISTING)


# --- behaviour clusters ---------------------------------------------------------

# fixed values: cluster code -> label
CLUSTER_NAMES = {
    "1": "週末まとめ買い族",
    "2": "夜型値引きハンター",
    "3": "健康・こだわり層",
    "4": "カテゴリジャンキー",
    "5": "平日夕方の時短族",
}
CLUSTER_DEFAULT = "ランダム"


@dataclass(frozen=True)
class ClusterLimits:
    # fixed values: minimum rates and basket size per cluster
    evening: float = 0.70
    ready_to_eat: float = 0.60
    weekend: float = 0.80
    basket: float = 10
    night: float = 0.70
    discount: float = 0.50
    organic_premium: float = 0.60
    favourite: float = 0.70


def behavior_cluster(limits: ClusterLimits = ClusterLimits()) -> Column:
    """Cluster code in priority order 5, 1, 2, 3, 4; NULL when none applies."""
    c = F.col
    return ladder(
        [
            ((c("weekday_evening_rate") >= limits.evening) & (c("ready_to_eat_rate") >= limits.ready_to_eat), "5"),
            ((c("weekend_rate") >= limits.weekend) & (c("avg_basket_size") >= limits.basket), "1"),
            ((c("night_rate") >= limits.night) & (c("discount_rate") >= limits.discount), "2"),
            (c("organic_premium_rate") >= limits.organic_premium, "3"),
            (c("favourite_rate") >= limits.favourite, "4"),
        ],
        F.lit(None).cast("string"),
    )


def cluster_name(code: Col = "behavior_cluster") -> Column:
    return map_labels(code, CLUSTER_NAMES, CLUSTER_DEFAULT)


# fixed values: days up to which a customer is active / due for contact / about to leave
CHURN_LIMITS = {
    "1": (7, 14, 21),
    "2": (5, 10, 14),
    "3": (10, 14, 21),
    "4": (7, 10, 14),
    "5": (3, 7, 10),
    None: (14, 21, 30),
}
CHURN_BANDS = ("active", "intervention", "critical", "churned")
RECENCY_BANDS = (("0-7", 7), ("8-14", 14), ("15-30", 30), ("31-60", 60))
RECENCY_LAST = "61+"


def churn_band(days: Col, cluster: Col, limits: Mapping[str | None, Sequence[int]] = CHURN_LIMITS) -> Column:
    """Recency band with cut-offs that depend on the cluster."""
    code = F.coalesce(_c(cluster), F.lit(""))
    default = limits[None]
    known = {k: v for k, v in limits.items() if k is not None}
    cut = [
        ladder([(code == k, v[i]) for k, v in known.items()], default[i]) for i in range(3)
    ]
    return ladder([(_c(days) <= cut[i], CHURN_BANDS[i]) for i in range(3)], CHURN_BANDS[3])


def recency_band(days: Col) -> Column:
    return at_most(days, [(limit, name) for name, limit in RECENCY_BANDS], RECENCY_LAST)


# --- age bands -------------------------------------------------------------------

# fixed values: three life-stage bands, and five-year bands
AGE3 = ((35, "若年層"), (55, "中年層"))
AGE3_LAST = "シニア層"
AGE5_FROM, AGE5_TO, AGE5_STEP = 20, 60, 5


def age_group3(age: Col, unknown: str | None = None) -> Column:
    """Three bands.  A NULL age falls into the last one unless ``unknown`` is given."""
    band = below(age, AGE3, AGE3_LAST)
    return band if unknown is None else F.when(_c(age).isNull(), F.lit(unknown)).otherwise(band)


def age_group5(age: Col) -> Column:
    steps = [
        (lo + AGE5_STEP, f"{lo}-{lo + AGE5_STEP - 1}歳") for lo in range(AGE5_FROM, AGE5_TO, AGE5_STEP)
    ]
    return below(age, steps, f"{AGE5_TO}歳以上")


# --- stores ------------------------------------------------------------------------

# fixed values: limits of the change against the year before
CAUTION_FROM = -0.10
WARNING_FROM = -0.15


def alert_level(change: Col) -> Column:
    """Alert level; a store without a comparison counts as unchanged."""
    c = F.coalesce(_c(change), F.lit(0.0))
    return ladder(
        [(c >= 0, "good"), (c > CAUTION_FROM, "normal"), (c > WARNING_FROM, "warning")], "critical"
    )


def health_class(mean_change: Col) -> Column:
    c = _c(mean_change)
    return ladder([(c >= 0, "healthy"), (c >= CAUTION_FROM, "caution")], "critical")


# fixed values: resolution-rate buckets
RESOLVED_HIGH, RESOLVED_MID, RESOLVED_LOW, RESOLVED_ZERO, NO_CALLS = (
    "解決率80%以上", "解決率50-79%", "解決率50%未満", "解決率0%", "通話なし",
)


def resolution_group(resolution_rate: Col, calls: Col | None = None) -> Column:
    """Bucket of a resolution rate.

    Without ``calls`` a rate of zero shares the no-call label; with the number of
    calls the two are told apart.
    """
    r = _c(resolution_rate)
    rules = [(r >= 0.8, RESOLVED_HIGH), (r >= 0.5, RESOLVED_MID), (r > 0, RESOLVED_LOW)]
    if calls is not None:
        rules.append((_c(calls) > 0, RESOLVED_ZERO))
    return ladder(rules, NO_CALLS)


# fixed values: facility type -> short label
FACILITY_TYPES = {
    "駅": "station",
    "学校": "school",
    "病院": "hospital",
    "役所・公共施設": "government",
    "公園": "park",
    "公園・レジャー": "park",
    "商業施設": "commercial",
    "スーパー": "supermarket",
    "コンビニ": "convenience",
    "銀行": "bank",
    "郵便局": "post",
    "ドラッグストア": "commercial",
    "家電量販店": "commercial",
    "ガソリンスタンド": "commercial",
}
FACILITY_DEFAULT = "other"


def facility_label(col: Col, mapping: Mapping[str, str] = FACILITY_TYPES) -> Column:
    return map_labels(col, mapping, FACILITY_DEFAULT)
