"""Cleaning rules on hand-made frames and properties on the fixture tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from salesforge.operators import etl
from salesforge.schema import RAW_SCHEMA
from salesforge.sources.tables import raw_lines
from tests.conftest import SMALL

D = dt.date(2023, 1, 1)


def _raw(spark, rows):
    """rows: (order_id, sku, category, region, qty, price, pct, ingest_line)"""
    full = [(o, 1, D, reg, cat, sku, "Web", "Card", q, p, pct, 9.9, 9.9, 9.9, 0, line, 0, 0, 0.0, 0)
            for (o, sku, cat, reg, q, p, pct, line) in rows]
    schema = RAW_SCHEMA.simpleString()[7:-1] + \
        ",ingest_line int,ingest_part bigint,ingest_supp bigint,ingest_price double,ingest_copy int"
    return spark.createDataFrame(full, schema)


def test_dedup_keeps_first_in_ingest_order(spark):
    df = _raw(spark, [(1, "a", "X", "N", 1, 10.0, 0, 2), (1, "a", "X", "N", 5, 99.0, 0, 1),
                      (2, "a", "X", "N", 1, 10.0, 0, 1)])
    out = {(r.order_id, r.quantity) for r in etl.dedup_lines(df).collect()}
    assert out == {(1, 5), (2, 1)}


def test_median_impute_null_price_not_invalid_and_all_invalid_category(spark):
    df = _raw(spark, [
        (1, "a", "X", "N", 1, 10.0, 0, 1), (2, "b", "X", "N", 1, 20.0, 0, 1),
        (3, "c", "X", "N", 1, 40.0, 0, 1), (4, "d", "X", "N", 1, 50.0, 0, 1),
        (5, "e", "X", "N", 1, -1.0, 0, 1), (6, "f", "X", "N", 1, None, 0, 1),
        (7, "g", "Y", "N", 1, 0.0, 0, 1), (8, "h", None, "N", 1, -1.0, 0, 1)])
    out = {r.order_id: r.unit_price for r in etl.impute_price_median(etl.dedup_lines(df)).collect()}
    assert out[5] == 30.0          # (20 + 40) / 2
    assert out[6] is None          # missing price is neither invalid nor imputed
    assert out[7] is None          # category with only invalid prices
    assert out[8] is None          # null category


def test_fix_quantity_and_recompute(spark):
    df = _raw(spark, [(1, "a", "X", "N", 0, 19.99, 15, 1), (2, "b", "X", "N", 3, 0.285, 0, 1)])
    out = {r.order_id: r for r in etl.recompute_revenue(etl.fix_quantity(etl.dedup_lines(df))).collect()}
    r1 = out[1]
    assert r1.quantity == 1 and r1.gross_revenue == 19.99
    assert r1.discount_amount == 3.0 and r1.net_revenue == 16.99
    assert out[2].gross_revenue == 0.86  # 0.855*100 is exactly 85.5: half-even gives 86


def test_backfill_region(spark):
    df = _raw(spark, [(1, "a", "X", None, 1, 1.0, 0, 1)])
    assert etl.backfill_region(df).first().region == "Unknown"


def test_strict_mode_raises_on_null_quantity(spark):
    df = _raw(spark, [(1, "a", "X", "N", None, 1.0, 0, 1)])
    m = etl.quality_metrics(df, etl.dedup_lines(df))
    with pytest.raises(etl.DataQualityError):
        etl.check_strict(m)


@pytest.fixture(scope="module")
def fact_small(spark):
    return etl.clean_fact(raw_lines(spark, SMALL)).cache()


def test_fixture_counts_match_published_figures(spark, fact_small):
    raw = raw_lines(spark, SMALL)
    assert raw.count() == 6063
    assert fact_small.count() == 5937
    s = fact_small.agg(F.sum(F.col("net_revenue").cast("decimal(18,2)")),
                       F.sum(F.col("discount_amount").cast("decimal(18,2)"))).first()
    assert str(s[0]) == "296908570.24" and str(s[1]) == "15874965.28"
    m = etl.quality_metrics(raw, etl.dedup_lines(raw)).first()
    assert (m.invalid_price_rows, m.invalid_quantity_rows, m.missing_region_rows) == (29, 33, 40)


def test_clean_fact_properties(fact_small):
    f = fact_small
    assert f.where((F.col("unit_price") <= 0) | (F.col("quantity") <= 0)).count() == 0
    assert f.where(F.col("region").isNull()).count() == 0
    assert f.select("order_id", "customer_id", "order_date", "sku").distinct().count() == f.count()
    bad = f.where(F.col("net_revenue") != F.rint((F.col("gross_revenue") - F.col("discount_amount")) * 100) / 100)
    assert bad.count() == 0


def test_same_result_under_different_partitioning(spark):
    from salesforge.operators import sales
    res = []
    for n in ("1", "8", "200"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        f = etl.clean_fact(raw_lines(spark, SMALL))
        res.append(sorted(sales.monthly_revenue_mom(f).collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert res[0] == res[1] == res[2]


def test_strict_clean_fact_raises_and_default_repairs(spark):
    df = _raw(spark, [(1, "a", "X", "N", None, 1.0, 0, 1)])
    with pytest.raises(etl.DataQualityError):
        etl.clean_fact(df, strict=True)
    assert etl.clean_fact(df).count() == 1


def test_csv_na_tokens_become_null(spark, tmp_path):
    from salesforge.sources.csv_export import read_csv_export
    header = ("order_id,customer_id,order_date,region,category,sku,channel,payment_method,quantity,"
              "unit_price,discount_pct,gross_revenue,discount_amount,net_revenue,is_returned")
    lines = [header] + [f"{i},7,2023-01-0{i},{tok},Cat,sku{i},Web,Card,1,9.5,0,9.5,0,9.5,0"
                        for i, tok in enumerate(["", "NA", "N/A", "null", "None", "North"], start=1)]
    path = tmp_path / "export.csv"
    path.write_text("\n".join(lines) + "\n")
    rows = read_csv_export(spark, str(path), with_file_order=True).orderBy("order_id").collect()
    assert [r.region for r in rows] == [None, None, None, None, None, "North"]
    assert rows[0].order_date == D.replace(day=1) and rows[0].unit_price == 9.5
    assert [r.ingest_row for r in rows] == sorted(r.ingest_row for r in rows)
    # dedup of a file keeps the first line in file order
    dup = read_csv_export(spark, str(path), with_file_order=True)
    assert etl.dedup_lines(dup.unionByName(dup)).count() == 6


def test_csv_export_to_fact_equals_table_path(spark, tmp_path):
    """Export in ingest order -> CSV file -> read with file order -> clean: same fact as the table path."""
    from salesforge.schema import FACT_COLUMNS, INGEST_ORDER, RAW_COLUMNS
    from salesforge.sources.csv_export import read_csv_export, write_csv
    raw = raw_lines(spark, SMALL)
    ordered = raw.orderBy("ingest_copy", "order_id", *INGEST_ORDER[:-1]).select(*RAW_COLUMNS)
    path = str(tmp_path / "export")
    write_csv(ordered.coalesce(1), path)
    from_csv = etl.clean_fact(read_csv_export(spark, path, with_file_order=True))
    from_tables = etl.clean_fact(raw)
    a = from_csv.select(*FACT_COLUMNS)
    b = from_tables.select(*FACT_COLUMNS)
    assert a.count() == b.count() == 5937
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_observed_metrics_equal_quality_table(spark, tmp_path):
    from salesforge.sources.warehouse import write_fact
    raw = raw_lines(spark, SMALL)
    fact, obs = etl.clean_fact_observed(raw)
    write_fact(fact, str(tmp_path / "wh"))
    got = etl.observed_metrics(obs)
    want = etl.quality_metrics(raw, etl.dedup_lines(raw)).first().asDict()
    assert {k: got[k] for k in want} == want
    assert want["raw_rows"] == 6063 and want["clean_rows"] == 5937
