"""Store analytics for all stores at once; one store is a filter on the result."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ladders import FACILITY_TYPES, alert_level, facility_label, health_class
from ..functions.scalar import in_year, percent, percent_exact, rate, scaled, split_list
from ..operators.aggregates import mean
from ..operators.filters import apply_filters
from ..operators.sets import union_tagged
from ..operators.skew import skew_safe_join
from ..operators.topk import first_match, top_bottom, topk_per_group
from ..operators.windows import share_within

# fixed values: units of the reports
MAN, OKU = 10_000, 100_000_000
STORE_COLS = ("store_id", "store_name", "prefecture", "city")
DEMOGRAPHICS = (
    "population_5km", "households", "avg_income", "elderly_rate", "young_adult_rate", "detached_house_rate",
    "day_night_ratio", "num_businesses",
)
#: fixed values: household spending by kind, and the kinds that the fact sheet adds up
SPENDING = (
    "expenditure_total", "garden_plants", "garden_supplies", "pet_food", "pet_supplies", "housing_repair_total",
    "furniture_household_total", "household_durables", "household_miscellaneous", "construction_services",
)
SPENDING_GROUPS = {
    "total_man": ("expenditure_total",),
    "garden_man": ("garden_plants", "garden_supplies"),
    "pet_man": ("pet_food", "pet_supplies"),
    "repair_man": ("housing_repair_total",),
    "construction_man": ("construction_services",),
}


def _year(sales: DataFrame, year: int) -> DataFrame:
    return sales.filter(in_year("month", year))


# --- profiles and trends ------------------------------------------------------------------

def yearly_sales(sales: DataFrame, year: int) -> DataFrame:
    """Sales, mean change, customers and basket per store; monthly rows reduce to one row
    per store before any join.  The mean of changes kept as decimals is a decimal, so that
    rounding it later is exact."""
    return _year(sales, year).groupBy("store_id").agg(
        F.try_divide(F.sum("yoy_change"), F.count("yoy_change")).alias("yoy"),
        F.sum("sales_amount").alias("sales"),
        mean("customer_count").alias("customers"),
        mean("avg_basket").alias("basket"),
        F.count("*").alias("months"),
    )


def store_kpis(stores: DataFrame, sales: DataFrame, year: int, cols: Sequence[str] = STORE_COLS) -> DataFrame:
    return stores.join(yearly_sales(sales, year), "store_id").select(
        *cols,
        percent_exact("yoy", 2).alias("avg_yoy_pct"),
        scaled("sales", MAN).alias("annual_sales_man"),
        F.round("customers", 0).alias("avg_monthly_customers"),
        F.round("basket", 0).alias("avg_basket"),
    )


def store_list(stores: DataFrame, sales: DataFrame, year: int, cols: Sequence[str] = STORE_COLS) -> DataFrame:
    """Stores with their change and alert level."""
    joined = stores.join(yearly_sales(sales, year), "store_id")
    change = F.round("yoy", 3).cast("double")
    return joined.select(
        *cols, change.alias("yoy_change"), scaled("sales", MAN).alias("sales_amount"),
        alert_level(change).alias("alert_level"),
    )


def monthly_trend(sales: DataFrame) -> DataFrame:
    return sales.select("store_id", "month", "sales_amount", "yoy_change", "customer_count", "avg_basket").sortWithinPartitions(
        "store_id", "month"
    )


def stores_in_health(sales: DataFrame, year: int, health: str) -> DataFrame:
    """Ids of the stores whose mean change puts them into a health class."""
    return yearly_sales(sales, year).filter(health_class("yoy") == health).select("store_id")


def chain_trend(
    sales: DataFrame, stores: DataFrame, year: int, health: str | None = None, **equals: str | None
) -> DataFrame:
    """Monthly totals of the chain under optional filters on store attributes and health."""
    chosen = _year(sales, year)
    if any(v is not None for v in equals.values()):
        chosen = chosen.join(apply_filters(stores, equals=equals).select("store_id"), "store_id", "left_semi")
    if health:
        chosen = chosen.join(stores_in_health(sales, year, health), "store_id", "left_semi")
    return (
        chosen.groupBy("month")
        .agg(
            scaled(F.sum("sales_amount"), OKU, 2).alias("total_sales_oku"),
            percent(mean("yoy_change"), 1).alias("avg_yoy_pct"),
            F.sum("customer_count").alias("total_customers"),
        )
        .orderBy("month")
    )


def chain_average(sales: DataFrame, year: int) -> DataFrame:
    """Mean change, and mean month times twelve.  ``month_coverage`` tells how complete
    the stores' months are: below 1 the annualised mean overstates."""
    per_store = yearly_sales(sales, year)
    months = per_store.agg(rate(F.sum("months"), F.count("*") * 12)).scalar()
    return _year(sales, year).agg(
        percent(mean("yoy_change"), 2).alias("avg_yoy_pct"),
        F.round(mean("sales_amount") / F.lit(float(MAN)) * F.lit(12.0), 0).alias("avg_annual_sales_man"),
    ).withColumn("month_coverage", months)


# --- look-ups --------------------------------------------------------------------------------

def demographics_of(trade_area: DataFrame) -> DataFrame:
    return trade_area.select("store_id", *DEMOGRAPHICS)


def spending_of(spending: DataFrame, groups: Mapping[str, Sequence[str]] = SPENDING_GROUPS) -> DataFrame:
    """Yearly spending of the households around each store, by kind and, in whole units of
    ten thousand, by group.  A kind that is NULL adds nothing to its group."""
    whole = {
        name: F.floor(reduce(add, [F.coalesce(F.col(c), F.lit(0)) for c in kinds]) / F.lit(float(MAN)))
        for name, kinds in groups.items()
    }
    return spending.select("store_id", *SPENDING).withColumns(whole)


def nearest(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    return topk_per_group(df, ["store_id"], order, k)


def competitors_of(competitors: DataFrame, k: int | None = None) -> DataFrame:
    order = [F.col("distance_km").asc_nulls_last(), F.col("competitor_name").asc()]
    if k is None:
        return competitors.sortWithinPartitions("store_id", *order)
    return nearest(competitors, order, k)


def facilities_of(facilities: DataFrame, k: int | None = None, mapping: Mapping[str, str] = FACILITY_TYPES) -> DataFrame:
    labelled = facilities.withColumn("type_label", F.col("facility_type")).withColumn(
        "facility_type", facility_label("facility_type", mapping)
    )
    if k is None:
        return labelled.sortWithinPartitions("store_id", F.desc_nulls_last("traffic_impact"), "facility_name")
    return nearest(labelled, [F.col("distance_km").asc_nulls_last(), F.col("facility_name").asc()], k)


def measures_of(measures: DataFrame) -> DataFrame:
    return measures.withColumn("related_categories", split_list("related_categories")).sortWithinPartitions(
        "store_id", F.desc_nulls_last("start_date"), "measure_type"
    )


# --- categories ---------------------------------------------------------------------------------

def category_sales(by_category: DataFrame, categories: DataFrame, year: int) -> DataFrame:
    """Yearly sales per store and category, with the category's name."""
    # further columns of the categories, such as the spending they map to, stay
    sums = _year(by_category, year).groupBy("store_id", "category_id").agg(F.sum("sales_amount").alias("sales"))
    return sums.join(categories, "category_id")


def category_gaps(per_store: DataFrame) -> DataFrame:
    """Every store's category against the chain mean per store selling it."""
    chain = per_store.groupBy("category_id").agg(
        (F.sum("sales").cast("double") / F.count_distinct("store_id")).alias("avg_sales")
    )
    sales = F.col("sales").cast("double")
    gap = sales - F.col("avg_sales")
    return skew_safe_join(per_store, chain, ["category_id"], "inner").select(
        "store_id", "category_name", *[c for c in ("expenditure_mapping",) if c in per_store.columns],
        scaled(sales, MAN).alias("store_sales"), scaled("avg_sales", MAN).alias("avg_sales_man"),
        scaled(gap, MAN).alias("gap"),
        F.round(F.try_divide(gap, F.col("avg_sales")) * 100.0, 1).alias("gap_pct"),
    )


def top_categories(per_store: DataFrame, k: int = 5) -> DataFrame:
    order = [F.col("sales").desc(), F.col("category_name").asc()]
    return topk_per_group(per_store, ["store_id"], order, k).select(
        "store_id", "rank", "category_name", scaled("sales", MAN).alias("sales_man")
    )


# --- market share ---------------------------------------------------------------------------------

def huff_share(stores: DataFrame, competitors: DataFrame, decay: float = 2) -> DataFrame:
    """Share of each store and of each of its competitors: size over distance to the
    power of ``decay``; at distance zero the size itself."""
    everyone = union_tagged(
        {
            "self": stores.select("store_id", "size_sqm", F.lit(0.0).alias("distance_km"), F.col("store_name").alias("name")),
            "competitor": competitors.select("store_id", "size_sqm", "distance_km", F.col("competitor_name").alias("name")),
        }
    )
    size = F.col("size_sqm").cast("double")
    pull = F.when(F.col("distance_km") == 0, size).otherwise(size / F.power("distance_km", F.lit(decay)))
    shared = share_within(everyone, ["store_id"], pull, "part")
    return shared.select("store_id", "type", "name", "size_sqm", F.round(F.col("part") * 100.0, 1).alias("share"))


# --- peers ------------------------------------------------------------------------------------------

def similar_kpis(similar: DataFrame, stores: DataFrame, sales: DataFrame, year: int) -> DataFrame:
    """Each store's peers with their change and sales."""
    peer = stores.join(yearly_sales(sales, year), "store_id").select(
        F.col("store_id").alias("similar_store_id"), "store_name", "prefecture", "city",
        percent_exact("yoy", 1).alias("yoy_pct"), scaled("sales", MAN).alias("sales_man"),
    )
    return skew_safe_join(similar, peer, ["similar_store_id"], "inner").select(
        "store_id", "similar_store_id", "store_name", "prefecture", "city", "similarity_rank", "similarity_score",
        "yoy_pct", "sales_man",
    )


def best_growing_peer(peers: DataFrame) -> DataFrame:
    return first_match(peers, ["store_id"], F.col("yoy_pct") > 0, [F.col("similarity_rank").asc(), F.col("similar_store_id").asc()])


def benchmark_gaps(per_store: DataFrame, peers: DataFrame) -> DataFrame:
    """Category sales of every store next to those of its first growing peer."""
    pair = best_growing_peer(peers).select("store_id", "similar_store_id")
    named = per_store.groupBy("store_id", "category_name").agg(F.sum("sales").cast("double").alias("sales"))
    theirs = named.select(
        F.col("store_id").alias("similar_store_id"), "category_name", F.col("sales").alias("peer_sales")
    )
    # many stores may share one peer
    both = skew_safe_join(named.join(pair, "store_id"), theirs, ["similar_store_id", "category_name"], "inner")
    return both.select(
        "store_id", "similar_store_id", "category_name",
        scaled("sales", MAN).alias("target"), scaled("peer_sales", MAN).alias("benchmark"),
        scaled(F.col("peer_sales") - F.col("sales"), MAN).alias("gap"),
    )


# --- overview -----------------------------------------------------------------------------------------

def business_kpis(sales: DataFrame, year: int) -> DataFrame:
    return _year(sales, year).agg(
        F.count_distinct("store_id").alias("store_count"),
        scaled(F.sum("sales_amount"), OKU, 2).alias("total_sales_oku"),
        percent(mean("yoy_change"), 1).alias("avg_yoy_pct"),
        F.round(mean("customer_count"), 0).alias("avg_customers"),
        F.round(mean("avg_basket"), 0).alias("avg_basket"),
    )


def health_distribution(sales: DataFrame, year: int) -> DataFrame:
    """Number of stores per health class."""
    return yearly_sales(sales, year).groupBy(health_class("yoy").alias("health")).agg(F.count("*").alias("stores"))


def all_stores(stores: DataFrame, sales: DataFrame, year: int) -> DataFrame:
    """Every store with its place on the map, change and sales; the table behind map and ranking."""
    return stores.join(yearly_sales(sales, year), "store_id").select(
        *STORE_COLS, percent_exact("yoy", 1).alias("yoy_pct"), scaled("sales", MAN).alias("sales_man"), "latitude", "longitude"
    )


def store_ranking(stores: DataFrame, sales: DataFrame, year: int, k: int = 10) -> DataFrame:
    return top_bottom(all_stores(stores, sales, year), "yoy_pct", "store_id", k)


def regional_breakdown(stores: DataFrame, sales: DataFrame, year: int) -> DataFrame:
    joined = _year(sales, year).groupBy("store_id").agg(
        F.sum("sales_amount").alias("sales"), F.sum("yoy_change").alias("yoy"), F.count("yoy_change").alias("n")
    ).join(stores, "store_id")
    return joined.groupBy("prefecture").agg(
        F.count("*").alias("store_count"),
        scaled(F.sum("sales"), OKU, 2).alias("sales_oku"),
        percent(rate(F.sum("yoy"), F.sum("n")), 1).alias("avg_yoy_pct"),
    ).orderBy(F.desc("sales_oku"), "prefecture")


# --- fact sheet -----------------------------------------------------------------------------------------

def _listed(df: DataFrame, order: Sequence[Column], k: int, cols: Sequence[str], out: str) -> DataFrame:
    """The first k rows per store as one array, in order."""
    top = topk_per_group(df, ["store_id"], order, k)
    return top.groupBy("store_id").agg(F.sort_array(F.collect_list(F.struct("rank", *cols))).alias(out))


@dataclass(frozen=True)
class SheetSizes:
    """Lengths of the lists of a fact sheet."""

    categories: int = 3
    competitors: int = 5
    peers: int = 2
    gaps: int = 5
    facilities: int = 5
    measures: int = 5


def fact_sheet(
    kpis: DataFrame, gaps: DataFrame, competitors: DataFrame, peers: DataFrame, benchmark: DataFrame,
    spending: DataFrame, shares: DataFrame, facilities: DataFrame, measures: DataFrame, sizes: SheetSizes = SheetSizes(),
) -> DataFrame:
    """One row per store with everything a diagnosis starts from.

    ``spending`` comes from :func:`spending_of`, ``shares`` from :func:`huff_share`,
    ``facilities`` from :func:`facilities_of` and ``measures`` from :func:`measures_of`.
    Facilities are those with the most traffic, measures the latest.  Every list is a
    top-k, so its length does not grow with the data.
    """
    c = F.col
    gap_cols = ["category_name", "gap", "gap_pct"]
    worst = _listed(gaps.filter(c("gap") < 0), [c("gap").asc(), c("category_name").asc()], sizes.categories, gap_cols, "worst_categories")
    best = _listed(gaps.filter(c("gap") > 0), [c("gap").desc(), c("category_name").desc()], sizes.categories, gap_cols, "best_categories")
    near = _listed(competitors, [c("distance_km").asc(), c("competitor_name").asc()], sizes.competitors, ["competitor_name", "distance_km", "is_new_entry"], "near_competitors")
    new = competitors.groupBy("store_id").agg(
        F.count("*").alias("competitors"), F.count_if("is_new_entry").alias("new_competitors")
    )
    growing = _listed(peers.filter(c("yoy_pct") > 0), [c("similarity_rank").asc(), c("similar_store_id").asc()], sizes.peers, ["similar_store_id", "yoy_pct"], "growing_peers")
    top_gaps = _listed(benchmark, [c("gap").desc(), c("category_name").asc()], sizes.gaps, ["category_name", "gap"], "benchmark_gaps")
    spent = spending.select("store_id", F.struct(*SPENDING_GROUPS).alias("household_spending"))
    own = shares.filter(c("type") == "self").select("store_id", c("share").alias("own_share"))
    visited = _listed(
        facilities, [c("traffic_impact").desc_nulls_last(), c("facility_name").asc()], sizes.facilities,
        ["facility_name", "type_label", "distance_km", "traffic_impact"], "facilities",
    )
    past = _listed(
        measures, [c("start_date").desc_nulls_last(), c("measure_type").asc(), c("description").asc()], sizes.measures,
        ["status", "measure_type", "description", "expected_effect", "actual_effect"], "measures",
    )
    out = kpis
    for part in (worst, best, near, new, growing, top_gaps, spent, own, visited, past):
        out = out.join(part, "store_id", "left")
    return out.withColumns({n: F.coalesce(n, F.lit(0)) for n in ("competitors", "new_competitors")})
