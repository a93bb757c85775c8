"""Schemas and fixed reference values.

Fixed values below must equal the reference's for identical results; they are
stated in natural order and not derived.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------- raw export
RAW_COLUMNS = [
    "order_id", "customer_id", "order_date", "region", "category", "sku",
    "channel", "payment_method", "quantity", "unit_price", "discount_pct",
    "gross_revenue", "discount_amount", "net_revenue", "is_returned",
]

RAW_SCHEMA = T.StructType([
    T.StructField("order_id", T.LongType(), False),
    T.StructField("customer_id", T.LongType(), False),
    T.StructField("order_date", T.DateType(), True),
    T.StructField("region", T.StringType(), True),
    T.StructField("category", T.StringType(), True),
    T.StructField("sku", T.StringType(), True),
    T.StructField("channel", T.StringType(), True),
    T.StructField("payment_method", T.StringType(), True),
    T.StructField("quantity", T.IntegerType(), True),
    T.StructField("unit_price", T.DoubleType(), True),
    T.StructField("discount_pct", T.IntegerType(), True),
    T.StructField("gross_revenue", T.DoubleType(), True),
    T.StructField("discount_amount", T.DoubleType(), True),
    T.StructField("net_revenue", T.DoubleType(), True),
    T.StructField("is_returned", T.IntegerType(), True),
])

# Columns that fix "file order" of the export; dedup keeps the first line by them.
INGEST_ORDER = ["ingest_line", "ingest_part", "ingest_supp", "ingest_price", "ingest_copy"]
# File order of a CSV export read back: path, split start, position in the split.
CSV_INGEST_ORDER = ["ingest_file", "ingest_block", "ingest_row"]
ALL_INGEST_ORDER = CSV_INGEST_ORDER + INGEST_ORDER

# Line key: one product line of one order (dedup key, draw key).
LINE_KEY = ["order_id", "customer_id", "order_date", "sku"]

# Figures of the export that the cleaning recomputes whatever they say.
REVENUE_COLUMNS = ["gross_revenue", "discount_amount", "net_revenue"]

TIME_COLUMNS = ["order_year", "order_month", "order_quarter", "day_of_week"]
FACT_COLUMNS = RAW_COLUMNS + TIME_COLUMNS

FACT_SCHEMA = T.StructType(list(RAW_SCHEMA.fields) + [
    T.StructField("order_year", T.IntegerType(), True),
    T.StructField("order_month", T.StringType(), True),
    T.StructField("order_quarter", T.StringType(), True),
    T.StructField("day_of_week", T.StringType(), True),
])

# ---------------------------------------------------------------- fixed values
# Tokens the CSV reader treats as missing text (pandas read_csv defaults that
# can occur in a text column of the export).
NA_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
             "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
             "n/a", "nan", "null"]

# Weekday order used by the day-of-week payload series.
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]

# Defect / adjustment reasons and their draw weights, in order.
DEFECT_REASONS = [
    ("Quality Defect - Item Damaged", 0.27),
    ("Wrong Item Shipped", 0.18),
    ("Size / Fit Issue", 0.16),
    ("Damaged in Transit", 0.14),
    ("Late Delivery - Order Cancelled", 0.10),
    ("Packaging Failure", 0.08),
    ("Customer Changed Mind", 0.07),
]

# Columns of the adjustment log, in sheet order.
ADJUSTMENT_LOG_COLUMNS = ["order_id", "order_date", "region", "category", "sku",
                          "defect_reason", "severity", "adjustment_qty", "adjustment_value"]

# Severity by reason; any other reason is "Low".
HIGH_SEVERITY = ["Quality Defect - Item Damaged", "Damaged in Transit"]
MEDIUM_SEVERITY = ["Wrong Item Shipped", "Packaging Failure"]

# Label of a missing region.
UNKNOWN_REGION = "Unknown"

# Severity names, most severe first.
SEVERITY_HIGH, SEVERITY_MEDIUM, SEVERITY_LOW = "High", "Medium", "Low"

# KPI tiles of the dashboard page, in page order.
KPI_BOARD_LABELS = ["Total Net Revenue", "Transactions Analyzed", "Avg Order Value",
                    "Unique Customers", "Manual Reporting Time Cut"]

# Headline rows of the quality report summary, in sheet order.
REPORT_SUMMARY_LABELS = ["Total Orders", "Total Returns / Adjustments", "Overall Return Rate",
                         "Total Adjustment Value ($)", "#1 Root Cause", "#1 Root Cause Share of Returns"]

# Compact money label formats (millions, thousands, units) and their thresholds.
MONEY_LABEL_FORMATS = [(1e6, "$%.2fM", 2), (1e3, "$%.1fK", 1), (0.0, "$%.0f", 0)]

# Seasonal multiplier rule on day of year.
SEASON_PEAK_FROM_DOY = 320
SEASON_PEAK_TO_DOY = 5
SEASON_PEAK_MULT = 1.55
SEASON_MID_FROM_DOY = 150
SEASON_MID_TO_DOY = 175
SEASON_MID_MULT = 1.25

# Reference defaults.
DEFAULT_DRAW_SEED = 7
DEFAULT_TIME_CUT_PCT = 60
DEFAULT_LOG_ROWS = 500
DEFAULT_TOP_PER_CATEGORY = 3
DEFAULT_TOP_OVERALL = 10
DEFAULT_TILES = 4
DEFAULT_LOESS_SPAN = 0.15
DEFAULT_LOESS_POINTS = 80
DEFAULT_SAMPLE_ROWS = 300

# ---------------------------------------------------------------- payload
_REV = T.DecimalType(18, 2)

PAYLOAD_SCHEMA = T.StructType([
    T.StructField("kpi", T.StructType([
        T.StructField("total_revenue", _REV),
        T.StructField("total_orders", T.LongType()),
        T.StructField("total_records_analyzed", T.LongType()),
        T.StructField("avg_order_value", _REV),
        T.StructField("return_rate_pct", T.DoubleType()),
        T.StructField("unique_customers", T.LongType()),
    ])),
    T.StructField("monthly_trend", T.ArrayType(T.StructType([
        T.StructField("month", T.StringType()), T.StructField("revenue", _REV)]))),
    T.StructField("region_drill", T.MapType(T.StringType(), T.ArrayType(T.StructType([
        T.StructField("category", T.StringType()), T.StructField("revenue", _REV)])))),
    T.StructField("top_skus", T.ArrayType(T.StructType([
        T.StructField("sku", T.StringType()), T.StructField("category", T.StringType()),
        T.StructField("revenue", _REV)]))),
    T.StructField("channel_mix", T.ArrayType(T.StructType([
        T.StructField("channel", T.StringType()), T.StructField("revenue", _REV)]))),
    T.StructField("region_totals", T.ArrayType(T.StructType([
        T.StructField("region", T.StringType()), T.StructField("revenue", _REV)]))),
    T.StructField("day_of_week", T.ArrayType(T.StructType([
        T.StructField("day", T.StringType()), T.StructField("revenue", _REV)]))),
    T.StructField("manual_reporting_time_reduction_pct", T.IntegerType()),
])
