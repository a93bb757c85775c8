"""Restart / replay safety of the streaming ingest and correctness under hot keys."""

import datetime as dt
import os
import shutil

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from salesforge import session

from salesforge.operators import etl
from salesforge.plans.quantiles import exact_quantiles
from salesforge.schema import RAW_SCHEMA
from salesforge.sources import warehouse
from salesforge.sources.tables import raw_lines
from salesforge.streaming import daily_ingest as S
from tests.conftest import SMALL


def test_stream_restart_loads_nothing_twice(spark, tmp_path):
    base = str(tmp_path)
    landing, lines, ck = (os.path.join(base, x) for x in ("landing", "lines", "ck"))
    S.drop_exports(raw_lines(spark, SMALL), landing)
    S.run_daily_ingest(spark, landing, lines, ck, max_files_per_trigger=30)
    first = S.read_lines(spark, lines).count()
    S.run_daily_ingest(spark, landing, lines, ck, max_files_per_trigger=30)  # restart: nothing new
    assert S.read_lines(spark, lines).count() == first == 5937
    fact = S.fact_from_lines(spark, lines)
    batch = etl.clean_fact(raw_lines(spark, SMALL))
    assert fact.exceptAll(batch).count() == 0 and batch.exceptAll(fact).count() == 0


def _landed(spark, rows):
    """Rows (order_id, date or None, sku or None, price) as landed lines."""
    full = [(i, 1, d, "N", "C", sku, "Web", "Card", 1, p, 0, 0.0, 0.0, 0.0, 0, 1, 0, 0, 0.0, 0, "m") for i, d, sku, p in rows]
    return spark.createDataFrame(full, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in
                                                 S.LANDING_SCHEMA.fields) + ", drop_month string")


D1, D2 = dt.date(2023, 1, 5), dt.date(2023, 2, 5)


def _ids(spark, lines):
    return sorted(r.order_id for r in S.read_lines(spark, lines).collect())


def test_replay_after_a_half_written_batch(spark, tmp_path):
    lines = f"{tmp_path}/lines"
    land = [(i, D1 if i < 3 else D2, "s", 1.0) for i in range(1, 5)]
    S.store_batch(_landed(spark, land[:1]), lines, "q1-0")  # what a failed attempt left
    S.store_batch(_landed(spark, land), lines, "q1-0")      # the batch again, whole
    S.store_batch(_landed(spark, land), lines, "q1-0")      # and again
    S.store_batch(_landed(spark, land), lines, "q1-1")      # the same lines in a later batch
    assert _ids(spark, lines) == [1, 2, 3, 4]


def test_a_second_checkpoint_over_the_same_table_adds_its_lines(spark, tmp_path):
    lines = f"{tmp_path}/lines"
    for name, ids in (("a", (1, 2)), ("b", (2, 3, 4))):
        df = _landed(spark, [(i, D1, "s", 1.0) for i in ids])
        df.write.option("header", True).partitionBy("drop_month").csv(f"{tmp_path}/{name}")
        S.run_daily_ingest(spark, f"{tmp_path}/{name}", lines, f"{tmp_path}/ck-{name}")
    assert _ids(spark, lines) == [1, 2, 3, 4]


def test_redelivered_lines_with_null_key_parts_are_stored_once(spark, tmp_path):
    lines = f"{tmp_path}/lines"
    land = _landed(spark, [(1, None, "s", 1.0), (2, D1, None, 1.0), (3, D1, "s", 1.0)])
    S.store_batch(land, lines, "q-0")
    S.store_batch(land, lines, "q-1")
    assert _ids(spark, lines) == [1, 2, 3] == sorted(r.order_id for r in etl.dedup_lines(land).collect())


def test_reload_without_a_month_drops_that_month(spark, tmp_path):
    path = f"{tmp_path}/fact"
    fact = etl.clean_fact(_landed(spark, [(1, D1, "s", 1.0), (2, D2, "s", 1.0)]).drop("drop_month"))
    warehouse.write_fact(fact, path)
    january = fact.where("order_month = '2023-01'")
    warehouse.write_fact(january, path)
    assert [r.order_id for r in warehouse.read_fact(spark, path).collect()] == [1]
    warehouse.write_fact(fact.where("order_month = '2023-02'"), path, replace="dynamic")
    assert sorted(r.order_id for r in warehouse.read_fact(spark, path).collect()) == [1, 2]


def test_changed_tables_give_changed_results(spark, tmp_path):
    for t in warehouse.STAR_TABLES:
        shutil.copyfile(f"{SMALL}/{t}.parquet", tmp_path / f"{t}.parquet")  # without the read-only mode
    count = lambda: E.queries()["kpi_summary"](spark, str(tmp_path)).first().total_records_analyzed
    before = count()
    assert count() == before
    half = spark.read.parquet(f"{SMALL}/lineitem.parquet").where("l_orderkey % 2 = 0")
    pq.write_table(half.toArrow(), tmp_path / "lineitem.parquet")
    want = etl.clean_fact(raw_lines(spark, str(tmp_path))).count()
    assert count() == want < before


def test_shared_storage_must_be_named_off_local_masters(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return self

        def get(self, key, default):
            return default

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())


def test_configure_keeps_what_the_caller_set(spark):
    key = "spark.sql.requireAllClusterKeysForDistribution"
    other = spark.newSession()
    other.conf.set(key, "false")
    assert session.configure(other).conf.get(key) == "false"


def _hot_frame(spark, n=3000):
    """A third of all rows are copies of one line; another third share one category."""
    rows = []
    for i in range(n):
        if i % 3 == 0:   # hot duplicate key
            rows.append((1, 1, dt.date(2023, 1, 1), "N", "Hot", "hot-sku", "Web", "Card", 1,
                         5.0 + (i % 7), 0, 0.0, 0.0, 0.0, 0, i, 0, 0, 0.0, 0))
        else:
            cat = "Hot" if i % 3 == 1 else f"C{i % 11}"
            rows.append((i, i % 97, dt.date(2023, 1, 1 + i % 28), "N", cat, f"s{i}", "Web", "Card", 1,
                         float(1 + i % 53), 0, 0.0, 0.0, 0.0, 0, 1, 0, 0, 0.0, 0))
    schema = RAW_SCHEMA.simpleString()[7:-1] + \
        ",ingest_line int,ingest_part bigint,ingest_supp bigint,ingest_price double,ingest_copy int"
    return spark.createDataFrame(rows, schema).repartition(8)


def test_dedup_with_a_hot_duplicate_key(spark):
    df = _hot_frame(spark)
    out = etl.dedup_lines(df)
    hot = out.where(F.col("sku") == "hot-sku").collect()
    assert len(hot) == 1 and hot[0].unit_price == 5.0   # first in ingest order (i = 0)
    assert out.count() == 1 + 2000
    plan = out._jdf.queryExecution().executedPlan().toString()
    below_shuffle = plan[plan.index("Exchange hashpartitioning"):]
    assert "WindowGroupLimit" in below_shuffle      # the partial limit runs before the shuffle


def test_exact_median_with_a_hot_category(spark):
    import numpy as np
    df = _hot_frame(spark)
    q = {r.category: r.med for r in exact_quantiles(df, "unit_price", {"med": 0.5}, ["category"]).collect()}
    pdf = df.select("category", "unit_price").toPandas()
    for cat, vals in pdf.groupby("category")["unit_price"]:
        assert abs(q[cat] - float(np.quantile(vals.to_numpy(), 0.5))) < 1e-12


def test_quantiles_of_odd_values(spark):
    import numpy as np
    values = [0.0, -0.0, -1.5, -1e-300, 1e-300, 3.0, 3.0, 2.9999999999999996, 4.0, 1e300, -1e300, 7.25, 1023.0, 1024.0]
    df = spark.createDataFrame([(g, float(v)) for g in ("a", None) for v in values]
                               + [("a", None), ("a", float("nan"))], "g string, v double")
    rows = exact_quantiles(df, "v", {"q1": 0.25, "med": 0.5, "p9": 0.9}, ["g"]).collect()
    assert {r.g for r in rows} == {"a", None}
    for r in rows:
        want = np.quantile(values, [0.25, 0.5, 0.9])
        assert r.n == len(values) and np.allclose([r.q1, r.med, r.p9], want)


def test_value_buckets_never_decrease(spark):
    from salesforge.plans.quantiles import value_bucket
    import random
    rng = random.Random(1)
    values = sorted([rng.choice([-1, 1]) * 2 ** rng.uniform(-60, 60) for _ in range(5000)]
                    + [s * 2.0 ** k * f for k in range(-40, 40) for f in (1, 1 - 2 ** -53, 1 + 2 ** -52) for s in (-1, 1)])
    got = spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "i long, v double").select(
        "i", value_bucket(F.col("v")).alias("b")).orderBy("i").collect()
    assert all(a.b <= b.b for a, b in zip(got, got[1:], strict=False))
