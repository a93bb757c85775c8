"""Loads in slices: the same rows, and no shuffle files of finished jobs beside those of the next."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from salesforge.operators import etl
from salesforge.plans import slices
from salesforge.session import delete_path
from salesforge.sources import warehouse
from salesforge.streaming import daily_ingest, weekly_stream
from tests.test_rollups import _raw

COPY = ["order_id", "sku", "unit_price", "net_revenue", "order_month"]


def _lines(n=60):
    """Lines of ``n`` orders over three months with copies, and prices to repair."""
    day = lambda k: dt.date(2023, 1 + k % 3, 1 + k % 20)
    rows = [(k, day(k), -1.0 if k % 7 == 0 else 10.0 + k % 5, 0) for k in range(n)]
    return rows + [(k, day(k), 999.0, 1) for k in range(0, n, 4)]


def _stored(spark, path, rows):
    _raw(spark, rows).coalesce(1).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def _shuffle_files(spark):
    dirs = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirsString()
    return {f for d in dirs for _, _, files in os.walk(d) for f in files if f.startswith("shuffle_")}


@pytest.fixture
def four_slices(monkeypatch):
    sizes = []
    known = slices.input_bytes

    def size(df):
        sizes.append(known(df))
        monkeypatch.setattr(slices, "SLICE_BYTES", max(1, -(-sizes[-1] // 4)))
        return sizes[-1]

    monkeypatch.setattr(slices, "input_bytes", size)
    return sizes


def test_slices_hold_each_row_once_and_keys_together(spark, tmp_path, four_slices):
    raw = _stored(spark, f"{tmp_path}/raw", _lines())
    parts = slices.sliced(raw, "order_id")
    assert len(parts) == 4 and four_slices[0] > 0
    orders = [{r[0] for r in p.select("order_id").collect()} for p in parts]
    assert sum(map(len, orders)) == len(set().union(*orders)) == 60
    assert sum(p.count() for p in parts) == raw.count()


def test_small_or_unknown_inputs_stay_whole(spark):
    raw = _raw(spark, _lines())
    assert slices.input_bytes(raw) < slices.SLICE_BYTES and slices.sliced(raw, "order_id") == [raw]


def test_load_in_slices_equals_the_whole(spark, tmp_path, four_slices):
    raw = _stored(spark, f"{tmp_path}/raw", _lines())
    whole = sorted(map(tuple, etl.clean_fact(raw).select(*COPY).collect()))
    before = _shuffle_files(spark)
    path = warehouse.load_fact(raw, f"{tmp_path}/fact")
    assert not _shuffle_files(spark) - before  # of a job that has ended
    assert len(four_slices) == 1
    assert sorted(map(tuple, warehouse.read_fact(spark, path).select(*COPY).collect())) == whole
    assert sorted(os.listdir(tmp_path)) == ["fact", "raw"]  # nothing is left beside them


def test_a_load_gives_its_shuffle_files_back(spark, tmp_path):
    raw = _stored(spark, f"{tmp_path}/raw", _lines())
    before = _shuffle_files(spark)
    warehouse.load_fact(raw, f"{tmp_path}/fact")
    assert not _shuffle_files(spark) - before


def test_daily_ingest_of_a_sliced_drop(spark, tmp_path, four_slices, monkeypatch):
    raw = _stored(spark, f"{tmp_path}/raw", _lines())
    before = _shuffle_files(spark)
    landing = daily_ingest.drop_exports(raw, f"{tmp_path}/landing")
    assert len(four_slices) == 1
    files = [f for _, _, names in os.walk(landing) for f in names if f.startswith("part-")]
    assert files and all(f.endswith(f".csv.{daily_ingest.DROP_CODEC}") for f in files)
    monkeypatch.setattr(daily_ingest, "SLICE_BYTES", 1)  # a batch takes one file at least
    for name in ("ck", "ck-2"):
        daily_ingest.run_daily_ingest(spark, landing, f"{tmp_path}/lines", f"{tmp_path}/{name}")
        assert len([f for f in os.listdir(f"{tmp_path}/{name}/commits") if f.isdigit()]) == len(files)
    assert not _shuffle_files(spark) - before
    got = daily_ingest.fact_from_lines(spark, f"{tmp_path}/lines").select(*COPY)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, etl.clean_fact(raw).select(*COPY).collect()))


def test_weekly_stream_of_a_sliced_drop(spark, tmp_path, four_slices):
    raw = _stored(spark, f"{tmp_path}/raw", _lines())
    before = _shuffle_files(spark)
    path = weekly_stream.write_drop(raw, f"{tmp_path}/landing/1")
    assert len(four_slices) == 1 and all(f.endswith(f".csv.{daily_ingest.DROP_CODEC}")
                                         for f in os.listdir(path) if f.startswith("part-"))
    weekly_stream.run_weekly_stream(spark, f"{tmp_path}/landing", f"{tmp_path}/stream")
    assert not _shuffle_files(spark) - before
    week = F.date_sub("order_date", F.dayofweek("order_date") - 1).alias("week")
    want = etl.clean_fact(raw).groupBy(week).agg(F.sum(F.col("net_revenue").cast("decimal(18,2)")).cast("double"))
    got = weekly_stream.weekly_revenue_of(spark, f"{tmp_path}/stream")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_a_failed_slice_leaves_the_old_table(spark, tmp_path, four_slices, monkeypatch):
    raw = _stored(spark, f"{tmp_path}/raw", _lines())
    path = warehouse.load_fact(raw, f"{tmp_path}/fact")
    old = warehouse.read_fact(spark, path).count()
    derive = warehouse.repaired_fact
    monkeypatch.setattr(warehouse, "repaired_fact", lambda rows: derive(rows).withColumn("sku", F.when(
        F.col("order_id") == 17, F.raise_error(F.lit("no"))).otherwise(F.col("sku"))))
    with pytest.raises(Exception, match="no"):
        warehouse.load_fact(raw, path)
    assert warehouse.read_fact(spark, path).count() == old and sorted(os.listdir(tmp_path)) == ["fact", "raw"]
    delete_path(spark, path)
