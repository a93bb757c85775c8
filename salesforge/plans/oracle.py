"""Independent SQL (DuckDB dialect) for every registered query.

The CTE chain rebuilds the order-line export from the star tables, cleans it
and exposes ``fact``; each report is a SELECT over it.  Arithmetic is written
in the same operation order as the Spark code so doubles agree bit for bit:
row rounding ``round_even(x*100, 0)/100`` (= Spark ``rint``), SQL rounding
``round(x*100, 0)/100`` (half away, = Spark ``round(x, 0)`` on the scaled value),
money sums over ``DECIMAL(18,2)``.
"""

from __future__ import annotations

STAR = """
star AS (
  SELECT l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_linenumber, l.l_quantity,
         l.l_extendedprice, l.l_discount, l.l_returnflag,
         o.o_custkey, o.o_orderdate, o.o_orderpriority, c.c_mktsegment, r.r_name,
         p.p_type, p.p_brand, p.p_name,
         (l.l_orderkey * 31 + l.l_linenumber * 17 + l.l_partkey * 7 + l.l_suppkey) % 200 AS h
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  JOIN part p ON l.l_partkey = p.p_partkey
)"""

RAW_SELECT = """
  SELECT CAST(l_orderkey AS BIGINT) AS order_id,
         CAST(o_custkey AS BIGINT) AS customer_id,
         CAST(o_orderdate AS DATE) AS order_date,
         CASE WHEN h = 3 THEN NULL ELSE r_name END AS region,
         p_type AS category,
         p_brand || '/' || p_name AS sku,
         c_mktsegment AS channel,
         o_orderpriority AS payment_method,
         CASE WHEN h = 2 THEN 0 ELSE CAST(trunc(l_quantity) AS INTEGER) END AS quantity,
         CASE WHEN h = 1 THEN CAST(-1.0 AS DOUBLE)
              ELSE round_even(l_extendedprice / l_quantity * 100, 0) / 100 END AS unit_price,
         CAST(round(l_discount * 100) AS INTEGER) AS discount_pct,
         l_extendedprice AS gross_revenue,
         CAST(0.0 AS DOUBLE) AS discount_amount,
         l_extendedprice AS net_revenue,
         CAST(l_returnflag = 'R' AS INTEGER) AS is_returned,
         l_linenumber AS ingest_line, l_partkey AS ingest_part, l_suppkey AS ingest_supp,
         l_extendedprice AS ingest_price"""

RAW = f"""
raw AS (
  {RAW_SELECT}, 0 AS ingest_copy FROM star
  UNION ALL
  {RAW_SELECT}, 1 AS ingest_copy FROM star WHERE h IN (1, 4)
)"""

RAW_COLS = """order_id, customer_id, order_date, region, category, sku, channel, payment_method,
  quantity, unit_price, discount_pct, gross_revenue, discount_amount, net_revenue, is_returned"""

FACT_COLS = RAW_COLS + ", order_year, order_month, order_quarter, day_of_week"

DEDUP = f"""
dedup AS (
  SELECT {RAW_COLS} FROM (
    SELECT *, row_number() OVER (PARTITION BY order_id, customer_id, order_date, sku
                                 ORDER BY ingest_line, ingest_part, ingest_supp, ingest_price,
                                          ingest_copy) AS rn
    FROM raw) t
  WHERE rn = 1
)"""

MEDIAN = """
vp AS (
  SELECT category, unit_price,
         row_number() OVER (PARTITION BY category ORDER BY unit_price) - 1 AS pos,
         count(*) OVER (PARTITION BY category) AS n
  FROM dedup
  WHERE category IS NOT NULL AND unit_price IS NOT NULL AND unit_price > 0
),
med AS (
  SELECT category,
         (max(CASE WHEN pos = (n - 1) // 2 THEN unit_price END)
          + max(CASE WHEN pos = n // 2 THEN unit_price END)) / 2 AS median_price
  FROM vp GROUP BY category
)"""

IMPUTED = """
imputed AS (
  SELECT d.* REPLACE (CASE WHEN coalesce(d.unit_price <= 0, false) THEN m.median_price
                           ELSE d.unit_price END AS unit_price)
  FROM dedup d LEFT JOIN med m ON d.category = m.category
)"""

FIXQ = """
fixq AS (
  SELECT * REPLACE (CASE WHEN coalesce(quantity <= 0, false) THEN 1 ELSE quantity END AS quantity)
  FROM imputed
)"""

REVENUE = """
rev1 AS (
  SELECT * REPLACE (round_even(unit_price * quantity * 100, 0) / 100 AS gross_revenue) FROM fixq
),
rev2 AS (
  SELECT * REPLACE (round_even(gross_revenue * discount_pct / 100 * 100, 0) / 100 AS discount_amount)
  FROM rev1
),
recomputed AS (
  SELECT * REPLACE (round_even((gross_revenue - discount_amount) * 100, 0) / 100 AS net_revenue)
  FROM rev2
)"""

BACKFILL = """
backfilled AS (
  SELECT * REPLACE (coalesce(region, 'Unknown') AS region) FROM recomputed
)"""

FACT = f"""
fact AS (
  SELECT *,
         CAST(year(order_date) AS INTEGER) AS order_year,
         strftime(order_date, '%Y-%m') AS order_month,
         CAST(year(order_date) AS VARCHAR) || 'Q' || CAST(quarter(order_date) AS VARCHAR) AS order_quarter,
         dayname(order_date) AS day_of_week
  FROM backfilled
)"""

STAGES = ["star", "raw", "dedup", "imputed", "fixq", "recomputed", "backfilled", "fact"]
_STAGE_SQL = {
    "star": STAR, "raw": RAW, "dedup": DEDUP, "imputed": MEDIAN + "," + IMPUTED,
    "fixq": FIXQ, "recomputed": REVENUE, "backfilled": BACKFILL, "fact": FACT,
}


def with_stage(stage: str, select: str, extra_ctes: str = "") -> str:
    """``WITH <chain up to stage>[, extra] <select>``."""
    upto = STAGES[: STAGES.index(stage) + 1]
    ctes = ",".join(_STAGE_SQL[s] for s in upto)
    if extra_ctes:
        ctes += "," + extra_ctes
    return f"WITH {ctes}\n{select}"


def on_fact(select: str, extra_ctes: str = "") -> str:
    return with_stage("fact", select, extra_ctes)


def money_sum(col: str) -> str:
    return f"sum(CAST({col} AS DECIMAL(18,2)))"


def half_away(expr: str, digits: int = 2) -> str:
    s = 10 ** digits
    return f"(round(CAST({expr} AS DOUBLE) * {s}, 0) / {s})"
