"""Report sinks: the JSON payload file and the multi-table quality report."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_payload_json(payload: DataFrame, path: str) -> str:
    """The one-row ``payload`` column as a single JSON text file."""
    payload.select("payload").coalesce(1).write.mode("overwrite").text(path)
    return path


def write_report(tables: dict[str, DataFrame], base: str, fmt: str = "parquet") -> dict[str, str]:
    """Write each report table to ``base/<name>`` (overwrite); returns the paths.

    The report tables are sorted aggregates or top-n lists, so each is written as a
    single file in its order; formats: parquet, csv (with header) or json.
    """
    paths = {}
    for name, df in tables.items():
        out = os.path.join(base, name)
        w = df.coalesce(1).write.mode("overwrite")
        if fmt == "csv":
            w.option("header", True).csv(out)
        elif fmt == "json":
            w.json(out)
        else:
            w.parquet(out)
        paths[name] = out
    return paths


# How the columns of each report table appear in ``read_report_rows``.
_REPORT_ROWS = {
    "summary": ("label", "value", None, None, None, None),
    "root_cause_pareto": ("defect_reason", None, "orders", None, "adjustment_value", "cumulative_pct"),
    "by_category": ("category", "top_defect_reason", "orders", "returns", "defect_rate_pct", "rate_scale"),
    "by_region": ("region", "top_defect_reason", "orders", "returns", "defect_rate_pct", "rate_scale"),
    "adjustment_log": ("sku", ("order_date", "region", "category", "defect_reason", "severity"), "order_id",
                       "adjustment_qty", "adjustment_value", None),
}


def read_report_rows(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Every row of the written report tables (Parquet), read back in file order.

    Columns: table, row_number (place in the file, from 1), key, text, n1, n2, v1, v2.
    """
    frames = []
    for name, path in paths.items():
        key, text, n1, n2, v1, v2 = _REPORT_ROWS[name]

        def column(c, kind, alias):
            value = F.lit(None) if c is None else F.concat_ws("|", *c) if isinstance(c, tuple) else F.col(c)
            return value.cast(kind).alias(alias)

        # one file of a few hundred rows at most: row numbers are those of its single task
        frames.append(spark.read.parquet(path).coalesce(1).select(
            F.lit(name).alias("table"), (F.monotonically_increasing_id() + 1).alias("row_number"),
            column(key, "string", "key"), column(text, "string", "text"), column(n1, "bigint", "n1"),
            column(n2, "bigint", "n2"), column(v1, "double", "v1"), column(v2, "double", "v2")))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
