"""Dashboard aggregation layer: KPI block, revenue series and the nested JSON payload.

pandas semantics are kept where they differ from SQL: ``groupby`` drops null
keys, and ``round(x, 2)`` of a ratio is applied numpy-style.  Money sums are
exact decimals, so rounding them is a no-op.

The payload is built from ONE pass over the fact: a grouping-sets aggregate
produces every revenue series at once (month; region x category; category x
sku; channel; region; weekday), and each series is then folded into an array
(one small row per series).  The KPI block is a second, global aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.formatting import money_label, thousands
from ..functions.money import MONEY, money_sum, rint_round
from ..plans.physical import one_row
from ..schema import (DEFAULT_TIME_CUT_PCT, DEFAULT_TOP_OVERALL, KPI_BOARD_LABELS, PAYLOAD_SCHEMA,
                      WEEKDAYS)


def _rev(col: str = "net_revenue") -> Column:
    return money_sum(col).cast("double").alias("revenue")


# ------------------------------------------------------------------ flat parts
def kpi_summary(fact: DataFrame) -> DataFrame:
    """total_revenue, total_orders, total_records_analyzed, avg_order_value, return_rate_pct, unique_customers."""
    k = fact.agg(
        money_sum("net_revenue").alias("_rev"),
        F.countDistinct("order_id").alias("total_orders"),
        F.count(F.lit(1)).alias("total_records_analyzed"),
        F.avg("is_returned").alias("_ret"),
        F.countDistinct("customer_id").alias("unique_customers"),
    )
    rev = F.col("_rev").cast("double")
    return k.select(
        rev.alias("total_revenue"),
        "total_orders", "total_records_analyzed",
        rint_round(F.try_divide(rev, F.col("total_orders").cast("double")), 2).alias("avg_order_value"),
        rint_round(F.lit(100.0) * F.col("_ret"), 2).alias("return_rate_pct"),
        "unique_customers",
    )


def monthly_trend(fact: DataFrame) -> DataFrame:
    return (fact.where(F.col("order_month").isNotNull())
                .groupBy(F.col("order_month").alias("month")).agg(_rev())
                .orderBy("month"))


def region_category_revenue(fact: DataFrame) -> DataFrame:
    return (fact.where(F.col("region").isNotNull() & F.col("category").isNotNull())
                .groupBy("region", "category").agg(_rev()))


def region_list(fact: DataFrame) -> DataFrame:
    """Sorted distinct regions; the first one is the drill-through default."""
    regions = fact.where(F.col("region").isNotNull()).select("region").distinct()
    return (regions.withColumn("is_default", F.col("region") == F.min("region").over(Window.partitionBy()))
                   .orderBy("region"))


def region_drill_one(fact: DataFrame, region: str | None = None) -> DataFrame:
    """Category revenue of one region, revenue descending; default = first region by name.

    The default is resolved inside the plan (a one-row aggregate joined back),
    not by collecting to the driver.
    """
    rc = region_category_revenue(fact)
    if region is None:
        chosen = rc.agg(F.min("region").alias("region"))
    else:
        chosen = rc.select("region").where(F.col("region") == F.lit(region)).distinct()
    return (rc.join(F.broadcast(chosen), "region").select("region", "category", "revenue")
              .orderBy(F.col("revenue").desc(), "category"))


def top_skus_overall(fact: DataFrame, n: int = DEFAULT_TOP_OVERALL) -> DataFrame:
    """Top ``n`` (category, sku) by revenue with a zero-padded position label.

    ``orderBy().limit()`` plans as ``TakeOrderedAndProject`` (per-task top-n,
    then a merge of n rows per task); the position is numbered on those n rows.
    """
    top = (fact.where(F.col("category").isNotNull() & F.col("sku").isNotNull())
               .groupBy("category", "sku").agg(_rev())
               .orderBy(F.col("revenue").desc(), "category", "sku").limit(n))
    w = Window.orderBy(F.col("revenue").desc(), "category", "sku")
    return top.select(F.lpad(F.row_number().over(w).cast("string"), 2, "0").alias("rank"),
                      "sku", "category", "revenue")


def channel_mix(fact: DataFrame) -> DataFrame:
    return fact.where(F.col("channel").isNotNull()).groupBy("channel").agg(_rev()).orderBy("channel")


def region_totals(fact: DataFrame) -> DataFrame:
    return (fact.where(F.col("region").isNotNull()).groupBy("region").agg(_rev())
                .orderBy(F.col("revenue").desc(), "region"))


def weekday_dimension(spark) -> DataFrame:
    """The fixed weekday list with positions from 1."""
    return spark.createDataFrame([(d, i + 1) for i, d in enumerate(WEEKDAYS)], "day string, day_index long")


def day_of_week_revenue(fact: DataFrame) -> DataFrame:
    """Always seven rows, Monday first; a day without sales has revenue 0."""
    by_day = (fact.where(F.col("day_of_week").isNotNull())
                  .groupBy(F.col("day_of_week").alias("day")).agg(_rev()))
    dim = weekday_dimension(fact.sparkSession)
    return (dim.join(by_day, "day", "left")
               .select("day", "day_index", F.coalesce(F.col("revenue"), F.lit(0.0)).alias("revenue"))
               .orderBy("day_index"))


# ------------------------------------------------------------------ nested payload
_SETS = {
    "month": ["order_month"],
    "drill": ["region", "category"],
    "channel": ["channel"],
    "region": ["region"],
    "day": ["day_of_week"],
}
_KEYS = ["order_month", "region", "category", "channel", "day_of_week"]


def _gid(cols: list[str]) -> int:
    """grouping_id() of a set: bit i is 1 when key i is NOT grouped."""
    return sum(1 << (len(_KEYS) - 1 - i) for i, k in enumerate(_KEYS) if k not in cols)


def _sorted_values(cond: Column, sort_key: list[Column], value: Column) -> Column:
    """Aggregate: array of ``value`` for rows matching ``cond``, ordered by ``sort_key``.

    ``collect_list`` skips nulls, so non-matching rows contribute nothing.
    """
    keyed = F.struct(*[k.alias(f"_k{i}") for i, k in enumerate(sort_key)], value.alias("v"))
    return F.transform(F.sort_array(F.collect_list(F.when(cond, keyed))), lambda x: x["v"])


def payload_struct(fact: DataFrame, time_cut_pct: int = DEFAULT_TIME_CUT_PCT,
                   top_n: int = DEFAULT_TOP_OVERALL) -> DataFrame:
    """The payload as one row of nested columns.

    Three passes over the (column-pruned) fact, whatever its size:
    1. GROUPING SETS (month; region x category; channel; region; weekday),
       folded into ordered arrays by ONE aggregate over the small result --
       no per-series filter, so Catalyst cannot split it into one scan per
       series;
    2. the KPI block (exact distinct counts);
    3. the ten best (category, sku) by revenue via ``TakeOrderedAndProject``
       (SKUs are never collected as a whole).
    """
    spark = fact.sparkSession
    g = (fact.groupingSets([[F.col(c) for c in cols] for cols in _SETS.values()], *_KEYS)
             .agg(money_sum("net_revenue").cast(MONEY).alias("revenue"),
                  F.grouping_id().alias("_gid")))

    def in_set(name):
        cond = F.col("_gid") == F.lit(_gid(_SETS[name]))
        for k in _SETS[name]:
            cond = cond & F.col(k).isNotNull()   # pandas groupby drops null keys
        return cond

    rev = F.col("revenue")
    drill_entries = _sorted_values(in_set("drill"), [F.col("region"), -rev, F.col("category")],
                                   F.struct("region", "category", "revenue"))
    folded = g.agg(
        _sorted_values(in_set("month"), [F.col("order_month")],
                       F.struct(F.col("order_month").alias("month"), rev.alias("revenue")))
        .alias("monthly_trend"),
        drill_entries.alias("_drill"),
        _sorted_values(in_set("channel"), [F.col("channel")], F.struct("channel", "revenue"))
        .alias("channel_mix"),
        _sorted_values(in_set("region"), [-rev, F.col("region")], F.struct("region", "revenue"))
        .alias("region_totals"),
        F.map_from_entries(F.collect_list(F.when(in_set("day"), F.struct("day_of_week", "revenue"))))
        .alias("_days"),
    )
    # region -> its categories (already ordered by revenue desc, then name); keys sorted
    regions = F.array_distinct(F.transform("_drill", lambda e: e["region"]))
    region_drill = F.map_from_arrays(
        regions,
        F.transform(regions, lambda r: F.transform(F.filter("_drill", lambda e: e["region"] == r),
                                                   lambda e: F.struct(e["category"], e["revenue"]))))
    # Monday..Sunday, 0 for a day without sales
    days = F.transform(
        F.array(*[F.lit(d) for d in WEEKDAYS]),
        lambda d: F.struct(d.alias("day"),
                           F.coalesce(F.element_at(F.col("_days"), d), F.lit(0).cast(MONEY)).alias("revenue")))
    series = folded.select("monthly_trend", region_drill.alias("region_drill"), "channel_mix",
                           "region_totals", days.alias("day_of_week"))

    k = kpi_summary(fact)
    kpi = k.select(F.struct(
        F.col("total_revenue").cast(MONEY).alias("total_revenue"),
        "total_orders", "total_records_analyzed",
        F.col("avg_order_value").cast(MONEY).alias("avg_order_value"),
        "return_rate_pct", "unique_customers").alias("kpi"))

    top = (fact.where(F.col("category").isNotNull() & F.col("sku").isNotNull())
               .groupBy("category", "sku").agg(money_sum("net_revenue").cast(MONEY).alias("revenue"))
               .orderBy(F.col("revenue").desc(), "category", "sku").limit(top_n))
    top_arr = top.agg(_sorted_values(F.lit(True), [-F.col("revenue"), F.col("category"), F.col("sku")],
                                     F.struct("sku", "category", "revenue")).alias("top_skus"))

    row = one_row({
        "kpi": kpi,
        "series": series.select(F.struct("*")),
        "top_skus": top_arr,
    })
    return row.select(
        "kpi",
        F.col("series.monthly_trend").alias("monthly_trend"),
        F.col("series.region_drill").alias("region_drill"),
        "top_skus",
        F.col("series.channel_mix").alias("channel_mix"),
        F.col("series.region_totals").alias("region_totals"),
        F.col("series.day_of_week").alias("day_of_week"),
        F.lit(int(time_cut_pct)).alias("manual_reporting_time_reduction_pct"),
    )


def dashboard_payload(fact: DataFrame, **kw) -> DataFrame:
    """One row, one column ``payload``: the JSON text the dashboard page embeds."""
    p = payload_struct(fact, **kw)
    return p.select(F.to_json(F.struct(*[F.col(f.name) for f in PAYLOAD_SCHEMA.fields]))
                    .alias("payload"))


def payload_series(payload: DataFrame) -> DataFrame:
    """Re-read the JSON and flatten every series: (series, pos, label, sub_label, value).

    ``pos`` is the 0-based position inside its array, so ordering is checked
    too; in the region drill it is the region's, and ``sub_pos`` the category's
    inside it (null in the other series).  All
    series are built as one array in a single projection and exploded once.
    """
    p = payload.select(F.from_json("payload", PAYLOAD_SCHEMA).alias("p")).select("p.*")

    def entry(series, pos, label, sub, value, sub_pos=None):
        sub_pos = F.lit(None) if sub_pos is None else sub_pos
        return F.struct(F.lit(series).alias("series"), pos.cast("bigint").alias("pos"),
                        sub_pos.cast("bigint").alias("sub_pos"),
                        label.cast("string").alias("label"), sub.cast("string").alias("sub_label"),
                        value.cast("double").alias("value"))

    none = F.lit(None).cast("string")

    def arr(name, label, sub=None):
        return F.transform(name, lambda e, i: entry(name, i, e[label], e[sub] if sub else none,
                                                    e["revenue"]))

    kpi_fields = ["total_revenue", "total_orders", "total_records_analyzed", "avg_order_value",
                  "return_rate_pct", "unique_customers"]
    kpi = F.array(*[entry("kpi", F.lit(i), F.lit(f), none, F.col(f"kpi.{f}"))
                    for i, f in enumerate(kpi_fields)])
    drill = F.flatten(F.transform(
        F.map_entries("region_drill"),
        lambda r, ri: F.transform(r["value"], lambda e, ci: entry(
            "region_drill", ri, r["key"], e["category"], e["revenue"], ci))))
    cut = F.array(entry("manual_reporting_time_reduction_pct", F.lit(0), none, none,
                        F.col("manual_reporting_time_reduction_pct")))
    everything = F.concat(kpi, arr("monthly_trend", "month"), drill,
                          arr("top_skus", "sku", "category"), arr("channel_mix", "channel"),
                          arr("region_totals", "region"), arr("day_of_week", "day"), cut)
    return p.select(F.inline(everything))


def payload_region_drill(payload: DataFrame, region: str | None = None) -> DataFrame:
    """Drill-through as the page does it: look one region up in the payload's map.

    The default region is the first map key (keys are sorted), as the page
    preselects the first pill.  Returns (region, position, category, revenue).
    """
    p = payload.select(F.from_json("payload", PAYLOAD_SCHEMA).alias("p"))
    key = F.lit(region) if region is not None else F.array_min(F.map_keys("p.region_drill"))
    picked = p.select(key.alias("region"), F.element_at("p.region_drill", key).alias("cats"))
    return picked.select("region", F.posexplode("cats").alias("position", "c")).select(
        "region", F.col("position").cast("bigint").alias("position"),
        F.col("c.category").alias("category"), F.col("c.revenue").cast("double").alias("revenue"))


# ------------------------------------------------------------------ page formatting
def kpi_board(fact: DataFrame, time_cut_pct: int = DEFAULT_TIME_CUT_PCT) -> DataFrame:
    """The five KPI tiles of the page as (position, label, value) text."""
    k = kpi_summary(fact)
    def tile(pos, label, value):
        return F.struct(F.lit(pos).alias("position"), F.lit(label).alias("label"),
                        value.alias("value"))

    revenue, records, aov, customers, time_cut = KPI_BOARD_LABELS
    tiles = F.array(
        tile(1, revenue, money_label(F.col("total_revenue"))),
        tile(2, records, F.concat(thousands(F.col("total_records_analyzed")), F.lit("+"))),
        tile(3, aov, F.format_string("$%.2f", F.col("avg_order_value"))),
        tile(4, customers, thousands(F.col("unique_customers"))),
        tile(5, time_cut, F.lit(f"{int(time_cut_pct)}%")),
    )
    return (k.select(F.inline(tiles))
             .select(F.col("position").cast("bigint").alias("position"), "label", "value"))


def money_labels(fact: DataFrame) -> DataFrame:
    """``$1.23M`` / ``$4.5K`` / ``$67`` labels for every (category, sku) revenue."""
    return (fact.where(F.col("category").isNotNull() & F.col("sku").isNotNull())
                .groupBy("category", "sku").agg(_rev())
                .select("category", "sku", F.col("revenue").alias("amount"),
                        money_label(F.col("revenue")).alias("label")))


