"""Cleaning steps of the daily ETL: raw export -> ``fact_transactions``.

Each step is ``f(df) -> df`` so the pipeline reads as a ``transform`` chain.
Rules kept from the reference: invalid values are repaired, never dropped;
supplied revenue figures are always recomputed; missing regions are labelled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..functions.dates import add_time_dimensions
from ..functions.money import rint_round
from ..plans.physical import one_row
from ..plans.quantiles import cumulative_counts, value_histogram
from ..schema import ALL_INGEST_ORDER, FACT_COLUMNS, LINE_KEY, REVENUE_COLUMNS, UNKNOWN_REGION


# ------------------------------------------------------------------ predicates
def invalid_price(col: str = "unit_price") -> Column:
    """price <= 0; a missing price is *not* invalid (comparison with null is false)."""
    return F.coalesce(F.col(col) <= 0, F.lit(False))


def invalid_quantity(col: str = "quantity") -> Column:
    return F.coalesce(F.col(col) <= 0, F.lit(False))


# ------------------------------------------------------------------ B1 dedup
def dedup_lines(df: DataFrame, key: list[str] | None = None,
                order: list[str] | None = None) -> DataFrame:
    """Keep the first line (in ingest order) of each (order, customer, date, sku).

    ``row_number() == 1`` lets Catalyst insert a partial ``WindowGroupLimit``
    before the shuffle, so a hot key is cut to one row per map task before it
    is moved: a key holding a third of the rows costs no more shuffle than any
    other.  The ingest-order columns make the choice deterministic.

    The window is partitioned by a 64-bit hash of the key followed by the key
    columns: the hash gives the sort a cheap binary prefix, the columns keep
    the grouping exact.  With ``spark.sql.requireAllClusterKeysForDistribution``
    (set by ``session.configure``) an input already hash-partitioned on one
    key column (``customer_id`` after a join) does not satisfy the window, so
    the exchange on the full key -- with the partial limit before it -- is
    always planned, and AQE stays free to split a skewed upstream join.
    """
    key = key or LINE_KEY
    order = order or [c for c in ALL_INGEST_ORDER if c in df.columns]
    if not order:
        raise ValueError("dedup needs ingest-order columns to keep the first line")
    ties = [c for c in df.columns if c not in order and c not in key]
    w = Window.partitionBy(*key).orderBy(*[F.col(c).asc() for c in [*order, *ties]])
    out = (df.withColumn("_rn", F.row_number().over(w))
             .where(F.col("_rn") == 1)
             .drop("_rn"))
    return out.drop(*[c for c in ALL_INGEST_ORDER if c in out.columns])


# ------------------------------------------------------------------ B3 impute
def category_median_price(df: DataFrame, group: str = "category",
                          value: str = "unit_price") -> DataFrame:
    """Exact median of valid prices per group (pandas ``groupby().median()``).

    Distributed and skew-safe: rows are reduced to a (group, value) -> count
    histogram (partial aggregation before the shuffle) and the middle
    positions are found from distributed cumulative counts, so no task ever
    holds a whole group.  Even counts average the two middle values (a + b) / 2.
    NaN counts as a missing price.
    """
    return median_of_histogram(price_histogram(df, group, value), group, value)


def price_histogram(df: DataFrame, group: str = "category", value: str = "unit_price") -> DataFrame:
    """(group, value) -> ``_cnt`` of the valid prices.  Histograms of parts add up to that of the whole."""
    valid = df.where(F.col(group).isNotNull() & F.col(value).isNotNull() & ~invalid_price(value))
    return value_histogram(valid, value, [group])


def median_of_histogram(hist: DataFrame, group: str = "category", value: str = "unit_price") -> DataFrame:
    """(group, median_price) from a (group, value) -> ``_cnt`` histogram."""
    pos = cumulative_counts(hist, value, [group])
    lo = F.floor((F.col("_n") - 1) / 2)
    hi = F.floor(F.col("_n") / 2)

    def covers(p):
        return (F.col("_start") <= p) & (p < F.col("_end"))

    return (pos.groupBy(group)
               .agg(F.max(F.when(covers(lo), F.col(value))).alias("_lo"),
                    F.max(F.when(covers(hi), F.col(value))).alias("_hi"))
               .select(group, ((F.col("_lo") + F.col("_hi")) / 2).alias("median_price")))


def impute_price_median(df: DataFrame, medians: DataFrame | None = None) -> DataFrame:
    """Invalid prices take their category's median of valid prices.

    The median table has one row per category and is broadcast: the lines of
    a few large categories are not moved to meet it.  A category with no
    valid price, or a null category, yields a null price.

    Nothing is cached: the pass for the medians shares the exchange of
    ``dedup_lines`` with the lines.  ``medians`` (category, median_price)
    replaces that pass where they are known already.
    """
    medians = category_median_price(df) if medians is None else medians
    joined = df.join(F.broadcast(medians), on="category", how="left")
    return (joined.withColumn("unit_price",
                              F.when(invalid_price(), F.col("median_price"))
                               .otherwise(F.col("unit_price")))
                  .drop("median_price")
                  .select(*df.columns))


# ------------------------------------------------------------------ B4..B7
def fix_quantity(df: DataFrame, default: int = 1) -> DataFrame:
    return df.withColumn("quantity",
                         F.when(invalid_quantity(), F.lit(default)).otherwise(F.col("quantity")))


def recompute_revenue(df: DataFrame) -> DataFrame:
    """gross = round(price*qty, 2); discount = round(gross*pct/100, 2); net = round(gross-discount, 2).

    Rounding is numpy's (half-even on the scaled double); net uses the rounded
    parts, exactly as the reference does.
    """
    gross = rint_round(F.col("unit_price") * F.col("quantity"), 2)
    return (df.withColumn("gross_revenue", gross)
              .withColumn("discount_amount",
                          rint_round(F.col("gross_revenue") * F.col("discount_pct") / F.lit(100), 2))
              .withColumn("net_revenue",
                          rint_round(F.col("gross_revenue") - F.col("discount_amount"), 2)))


def backfill_region(df: DataFrame, label: str = UNKNOWN_REGION) -> DataFrame:
    return df.withColumn("region", F.coalesce(F.col("region"), F.lit(label)))


def enforce_types(df: DataFrame) -> DataFrame:
    """Types of the warehouse table.  With ANSI mode a bad cast raises, like ``astype(int)``."""
    return (df.withColumn("order_date", F.col("order_date").cast("date"))
              .withColumn("is_returned", F.col("is_returned").cast("int"))
              .withColumn("quantity", F.col("quantity").cast("int")))


def time_dimensions(df: DataFrame) -> DataFrame:
    return add_time_dimensions(df, "order_date")


# ------------------------------------------------------------------ B9 metrics
def quality_metrics(raw: DataFrame, deduped: DataFrame) -> DataFrame:
    """One row of data-quality counts; invalid counts are taken after dedup."""
    r = raw.agg(F.count(F.lit(1)).alias("raw_rows"))
    d = deduped.agg(*_dedup_metric_exprs())
    both = one_row({"r": r.select(F.struct("*")), "d": d.select(F.struct("*"))}).select("r.*", "d.*")
    return (both
             .withColumn("duplicates_removed", F.col("raw_rows") - F.col("clean_rows"))
             .select("raw_rows", "duplicates_removed", "invalid_price_rows",
                     "invalid_quantity_rows", "missing_region_rows", "clean_rows",
                     "null_quantity_rows", "null_is_returned_rows"))


def _dedup_metric_exprs() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("clean_rows"),
        F.count_if(invalid_price()).alias("invalid_price_rows"),
        F.count_if(invalid_quantity()).alias("invalid_quantity_rows"),
        F.count_if(F.col("region").isNull()).alias("missing_region_rows"),
        F.count_if(F.col("quantity").isNull()).alias("null_quantity_rows"),
        F.count_if(F.col("is_returned").isNull()).alias("null_is_returned_rows"),
    ]


def clean_fact_observed(raw: DataFrame) -> tuple[DataFrame, dict[str, Observation]]:
    """``clean_fact`` with the data-quality counts collected as side metrics.

    ``df.observe`` computes the counts inside the job that materialises the
    data (e.g. the warehouse write) -- no extra pass over the input.  Read
    them with ``observed_metrics`` after the first action.
    """
    obs = {"raw": Observation("etl_raw"), "dedup": Observation("etl_dedup")}
    unparsed = F.col("unparsed_fields") if "unparsed_fields" in raw.columns else F.lit(0)
    raw = raw.observe(obs["raw"], F.count(F.lit(1)).alias("raw_rows"),
                      F.coalesce(F.sum(unparsed), F.lit(0)).alias("unparsed_fields"))
    d = dedup_lines(raw.drop(*REVENUE_COLUMNS)).observe(obs["dedup"], *_dedup_metric_exprs())
    return repaired_fact(impute_price_median(d)), obs


def observed_metrics(obs: dict[str, Observation]) -> dict[str, int]:
    """The same figures as ``quality_metrics``, from the observations of a finished run."""
    m = {**obs["raw"].get, **obs["dedup"].get}
    m["duplicates_removed"] = m["raw_rows"] - m["clean_rows"]
    return m


class DataQualityError(ValueError):
    pass


def check_strict(metrics: DataFrame) -> None:
    """Strict mode: null quantity / return flag cannot be cast to int (pandas raises)."""
    row = metrics.select("null_quantity_rows", "null_is_returned_rows").first()
    if row and (row[0] or row[1]):
        raise DataQualityError(
            f"null quantity in {row[0]} rows, null is_returned in {row[1]} rows")


# ------------------------------------------------------------------ B10 transform
def clean_fact(raw: DataFrame, strict: bool = False) -> DataFrame:
    """dedup -> impute price -> fix quantity -> recompute -> backfill -> types -> time dims.

    ``strict=True`` first counts null quantities / return flags (one extra
    aggregate job) and raises ``DataQualityError`` when there are any, as the
    reference's integer casts do.
    """
    if strict:
        check_strict(quality_metrics(raw, dedup_lines(raw)))
    return repaired_fact(imputed_lines(raw))


def unique_lines(raw: DataFrame) -> DataFrame:
    """The deduplicated lines.  The supplied revenue figures are left behind."""
    return dedup_lines(raw.drop(*REVENUE_COLUMNS))


def imputed_lines(raw: DataFrame, medians: DataFrame | None = None) -> DataFrame:
    """The steps that need other lines: dedup -> impute price (by ``medians`` where they are known already)."""
    return impute_price_median(unique_lines(raw), medians)


def repaired_fact(lines: DataFrame) -> DataFrame:
    """The steps that need one line only: fix quantity -> recompute -> backfill -> types -> time dims."""
    out = (lines.transform(fix_quantity)
            .transform(recompute_revenue)
            .transform(backfill_region)
            .transform(enforce_types)
            .transform(time_dimensions))
    return out.select(*FACT_COLUMNS)
