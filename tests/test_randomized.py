"""Randomised cross-checks against pandas / numpy semantics (hypothesis drives the shapes)."""

import datetime as dt

import numpy as np
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from salesforge.functions.money import rint_round
from salesforge.operators import etl
from salesforge.plans.ranking import distributed_ntile
from salesforge.schema import RAW_SCHEMA

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


def test_rint_round_equals_numpy_round_on_random_doubles(spark):
    rng = np.random.default_rng(11)
    vals = np.concatenate([rng.uniform(-1e4, 1e4, 10000),
                           np.round(rng.uniform(0, 1000, 10000), 3)])  # many exact half-cent ties
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    got = np.array([r[0] for r in df.select(rint_round("x", 2)).collect()])
    assert np.array_equal(got, np.round(vals, 2))


def _raw_frame(spark, rows):
    schema = RAW_SCHEMA.simpleString()[7:-1] + \
        ",ingest_line int,ingest_part bigint,ingest_supp bigint,ingest_price double,ingest_copy int"
    full = [(o, c, dt.date(2023, 1, 1 + d), "N", cat, f"s{s}", "Web", "Card", q, p, 0, 0.0, 0.0, 0.0, 0,
             i, 0, 0, 0.0, 0)
            for i, (o, c, d, s, cat, q, p) in enumerate(rows)]
    return spark.createDataFrame(full, schema)


row_st = st.tuples(st.integers(1, 6), st.integers(1, 3), st.integers(0, 2), st.integers(0, 3),
                   st.sampled_from(["A", "B", None]), st.integers(-1, 3),
                   st.one_of(st.none(), st.sampled_from([-1.0, 0.0, 1.5, 2.25, 9.99, 10.0, 3.5])))


@SETTINGS
@given(rows=st.lists(row_st, min_size=1, max_size=40))
def test_dedup_equals_pandas_keep_first(spark, rows):
    df = _raw_frame(spark, rows)
    got = sorted((r.order_id, r.customer_id, r.order_date, r.sku, r.quantity, r.unit_price)
                 for r in etl.dedup_lines(df.repartition(3)).collect())
    pdf = pd.DataFrame([(o, c, dt.date(2023, 1, 1 + d), f"s{s}", q, p) for (o, c, d, s, _, q, p) in rows],
                       columns=["order_id", "customer_id", "order_date", "sku", "quantity", "unit_price"])
    want = pdf.drop_duplicates(subset=["order_id", "customer_id", "order_date", "sku"], keep="first")
    want_rows = sorted((a, b, c, d, int(e), None if pd.isna(f) else float(f))
                       for a, b, c, d, e, f in want.itertuples(index=False))
    assert got == want_rows


@SETTINGS
@given(rows=st.lists(row_st, min_size=1, max_size=40))
def test_category_median_equals_pandas(spark, rows):
    df = etl.dedup_lines(_raw_frame(spark, rows))
    got = {r.category: r.median_price for r in etl.category_median_price(df).collect()}
    pdf = df.select("category", "unit_price").toPandas()
    valid = pdf[~(pdf["unit_price"] <= 0)]
    want = valid.groupby("category")["unit_price"].median().dropna().to_dict()
    assert set(got) == set(want)
    assert all(abs(got[k] - want[k]) < 1e-12 for k in want)


@SETTINGS
@given(n=st.integers(1, 150), k=st.integers(1, 9), mod=st.integers(1, 40))
def test_distributed_ntile_equals_sql_ntile(spark, n, k, mod):
    df = spark.range(n).select("id", (F.col("id") * 37 % mod).cast("double").alias("v"))
    mine = distributed_ntile(df, [F.col("v").desc(), F.col("id")], k, name="t").select("id", "t")
    ref = df.selectExpr("id", f"ntile({k}) OVER (ORDER BY v DESC, id) AS t")
    assert sorted(mine.collect()) == sorted(ref.collect())
