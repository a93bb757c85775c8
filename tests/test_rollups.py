"""Mergeable summaries: bitmaps, sketches, price histograms; and the streams that keep them."""

import datetime as dt
import random

from pyspark.sql import functions as F

from salesforge.operators import etl
from salesforge.plans import rollups
from salesforge.session import compiled_methods
from salesforge.schema import RAW_COLUMNS
from salesforge.sources.tables import raw_lines
from salesforge.streaming import daily_ingest, weekly_stream
from tests.conftest import SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bitmaps_of_loads_add_up(spark):
    rng = random.Random(4)
    rows = [(rng.choice(["2023-01", "2023-02", "2023-04", None]), rng.choice([None, rng.randint(-5, 90_000)]),
             rng.randint(0, 40)) for _ in range(3000)] + [("2023-07", None, None)]
    df = spark.createDataFrame(rows, "order_month string, order_id long, customer_id long")
    loads = rollups.distinct_bitmaps(df.where("customer_id < 20")).union(
        rollups.distinct_bitmaps(df.where("customer_id >= 20 or customer_id is null")))
    got = {(r["grain"], r["period"]): (r["orders"], r["customers"]) for r in rollups.distinct_rollup(loads).collect()}
    quarter = lambda m: m and f"{m[:4]}Q{(int(m[5:]) + 2) // 3}"
    want = {}
    for m, o, c in rows:
        for key in (("month", m), ("quarter", quarter(m)), ("all", "all")):
            orders, customers = want.setdefault(key, (set(), set()))
            orders |= {o} - {None}
            customers |= {c} - {None}
    assert got == {k: (len(o), len(c)) for k, (o, c) in want.items()}
    assert "Expand" not in _plan(rollups.distinct_rollup(loads))


def test_merged_sketches_keep_their_rank_error(spark):
    rng = random.Random(5)
    rows = [(rng.choice("abc"), f"2023-{rng.randint(1, 12):02d}", rng.choice([rng.lognormvariate(3, 2), 1.0, None,
             float("nan")])) for _ in range(30_000)]
    df = spark.createDataFrame(rows, "category string, order_month string, net_revenue double").repartition(7)
    sketches = rollups.month_sketches(df)
    errors = rollups.measured_rank_errors(df, rollups.sketch_quantiles(sketches)).collect()
    assert len(errors) == 3 and all(0 <= r[f"err_{n}"] <= rollups.SKETCH_RANK_ERROR for r in errors for n in rollups.SKETCH_PROBS)
    assert all(r["within_bound"] for r in rollups.sketched_and_exact(df, sketches).collect())
    far = rollups.sketch_quantiles(sketches).withColumn("p50", F.lit(1e9))
    assert all(r["err_p50"] > 0.4 for r in rollups.measured_rank_errors(df, far).collect())  # the measure tells


def test_medians_come_from_the_histograms_alone(spark, tmp_path):
    raw = raw_lines(spark, SMALL)
    lines = f"{tmp_path}/lines"
    early = F.col("order_date") < F.lit("1997-01-01").cast("date")
    for k, part in enumerate((raw.where(early), raw.where(~early), raw.where(early))):
        daily_ingest.store_batch(part, lines, f"q-{k}")
    daily_ingest.store_batch(raw.where(~early), lines, "q-1")  # a replay replaces its histogram
    medians = etl.median_of_histogram(daily_ingest.read_price_histogram(spark, lines))
    assert all(f"{lines}-prices/" in f for f in medians.inputFiles())
    want = etl.category_median_price(etl.dedup_lines(raw))
    assert sorted(map(tuple, medians.collect())) == sorted(map(tuple, want.collect()))
    fact = daily_ingest.fact_from_lines(spark, lines)
    # the lines are read once: for the rows, not for the medians
    assert _plan(fact).count("ReadSchema: struct<order_id") == 1
    assert sorted(map(tuple, fact.collect())) == sorted(map(tuple, etl.clean_fact(raw).collect()))


def _raw(spark, rows):
    """(order, day, price, copy) as raw lines of two categories."""
    return spark.createDataFrame(
        [(o, 1, d, "ASIA", f"c{o % 2}", "s", "web", "card", 2, p, 10, 0.0, 0.0, 0.0, 0, 1, 1, 1, 1.0, c)
         for o, d, p, c in rows],
        "order_id long, customer_id long, order_date date, region string, category string, sku string, channel string, "
        "payment_method string, quantity int, unit_price double, discount_pct int, gross_revenue double, "
        "discount_amount double, net_revenue double, is_returned int, ingest_line int, ingest_part long, "
        "ingest_supp long, ingest_price double, ingest_copy int")


def test_new_lines_meet_the_stored_keys_in_one_exchange(spark, tmp_path):
    lines, day = f"{tmp_path}/lines", dt.date(2023, 1, 5)
    daily_ingest.store_batch(_raw(spark, [(1, day, 5.0, 0), (2, None, 5.0, 0)]), lines, "q-0")
    batch = _raw(spark, [(1, day, 4.0, 0), (2, None, 5.0, 0), (3, day, 7.0, 1), (3, day, 6.0, 0), (4, None, 1.0, 0)])
    new = daily_ingest._new_lines(spark, batch, lines, "q-1")
    plan = _plan(new)
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
    assert sorted((r.order_id, r.unit_price) for r in new.collect()) == [(3, 6.0), (4, 1.0)]
    assert new.columns == [*RAW_COLUMNS, "order_month"]


def test_streams_run_in_methods_that_are_compiled(spark, tmp_path, monkeypatch):
    name, seen = "spark.sql.codegen.hugeMethodLimit", []
    before = spark.conf.get(name)
    monkeypatch.setattr(daily_ingest, "store_batch", lambda batch, *_: seen.append(batch.sparkSession.conf.get(name)))
    landing = daily_ingest.drop_exports(_raw(spark, [(1, dt.date(2023, 1, 5), 5.0, 0)]), f"{tmp_path}/landing")
    daily_ingest.run_daily_ingest(spark, landing, f"{tmp_path}/lines", f"{tmp_path}/ck")
    assert seen == ["8000"] and spark.conf.get(name) == before
    try:
        with compiled_methods(spark):
            raise KeyError
    except KeyError:
        assert spark.conf.get(name) == before


def test_a_drop_makes_its_rows_once(spark, tmp_path):
    made = spark.sparkContext.accumulator(0)

    def counted(frames):
        for pdf in frames:
            made.add(len(pdf))
            yield pdf

    raw = _raw(spark, [(k, dt.date(2023, 1, 5), 5.0, 0) for k in range(50)])
    path = weekly_stream.write_drop(raw.mapInPandas(counted, raw.schema), f"{tmp_path}/drop")
    assert made.value == 50 == spark.read.option("header", True).csv(path).count()


def test_weekly_stream_drops_what_is_later_than_the_watermark(spark, tmp_path):
    day = lambda n: dt.date(2023, 1, 1) + dt.timedelta(days=n)
    landing, base = f"{tmp_path}/landing", f"{tmp_path}/stream"
    first = [(k, day(k), 10.0 + k, 0) for k in range(40)] + [(50, day(39), -1.0, 0)]
    weekly_stream.write_drop(_raw(spark, first), f"{landing}/1")
    weekly_stream.run_weekly_stream(spark, landing, base, "10 days")
    late = [(60, day(35), 99.0, 0), (61, day(33), 0.0, 0)]
    second = [*late, (39, day(39), 49.0, 1), (38, day(38), 48.0, 1), (70, day(60), 5.0, 0), (71, None, 5.0, 0)]
    weekly_stream.write_drop(_raw(spark, [*second, (80, day(3), 7.0, 0)]), f"{landing}/2")  # day 3 is too late
    weekly_stream.run_weekly_stream(spark, landing, base, "10 days")
    kept = _raw(spark, [*first, *late, (70, day(60), 5.0, 0)])
    fact = etl.clean_fact(kept)
    want = (fact.groupBy(F.date_sub("order_date", F.dayofweek("order_date") - 1).alias("week"))
            .agg(F.sum(F.col("net_revenue").cast("decimal(18,2)")).cast("double").alias("revenue")))
    got = weekly_stream.weekly_revenue_of(spark, base)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
