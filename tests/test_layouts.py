"""Layouts, bucketed tables, run-time pruning: same rows, and less work for them."""

import datetime as dt
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from salesforge.operators import segments
from salesforge.schema import FACT_COLUMNS
from salesforge.sources import bucketed, spatial, warehouse
from salesforge.sources.tables import read_table
from tests.conftest import MEDIUM

BOXES = [{"region": "ASIA", "category": "PROMO", "first_day": "1996-06-02", "last_day": "1996-06-08"},
         {"region": "EUROPE", "category": "LARGE"}, {"category": "SMALL", "first_day": "1997-01-01", "last_day": "1997-12-31"},
         {"region": "AFRICA", "first_day": "1998-03-01", "last_day": "1999-03-01"}, {"category": "STANDARD"}]


@pytest.fixture(scope="module")
def fact(spark):
    return warehouse.fact_table(spark, MEDIUM)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _groups_read(files, box):
    """Row groups whose statistics cannot rule the box out."""
    read = 0
    for f in files:
        meta = pq.ParquetFile(f).metadata
        for g in range(meta.num_row_groups):
            stats = {meta.row_group(g).column(c).path_in_schema: meta.row_group(g).column(c).statistics
                     for c in range(meta.num_columns)}
            ranges = {"region": (box.get("region"),) * 2, "category": (box.get("category"),) * 2,
                      "order_date": tuple(box.get(k) and dt.date.fromisoformat(box[k]) for k in ("first_day", "last_day"))}
            read += all(low is None or (stats[c].min <= high and low <= stats[c].max) for c, (low, high) in ranges.items())
    return read


def test_morton_key_interleaves_the_bits(spark):
    rng = random.Random(1)
    rows = [tuple(rng.randrange(1 << 12) for _ in range(3)) for _ in range(200)]
    got = spark.createDataFrame(rows, "a int, b int, c int").select(
        "a", "b", "c", spatial.interleaved([F.col(x) for x in "abc"]).alias("k")).collect()
    for a, b, c, k in got:
        assert k == sum(((x >> i) & 1) << (3 * i + d) for i in range(12) for d, x in enumerate((a, b, c)))


def test_curve_reads_fewer_row_groups_than_months(spark, fact, tmp_path):
    curve, months = f"{tmp_path}/curve", f"{tmp_path}/months"
    spatial.write_spatial(fact, curve, files=8, rows_per_group=200)
    (fact.repartitionByRange("order_month", "region", "category", "order_id")
        .sortWithinPartitions("order_month", "region", "category").write.option("parquet.block.row.count.limit", "200")
        .partitionBy("order_month").parquet(months))
    files = {p: [f for f in (tmp_path / p).rglob("*.parquet")] for p in ("curve", "months")}
    counted = {p: [_groups_read(f, b) for b in BOXES] for p, f in files.items()}
    # the month layout also prunes folders, as its statistics on the date do
    assert sum(counted["curve"]) < sum(counted["months"]) / 2, counted
    for box in BOXES:
        got = spatial.in_box(spatial.read_spatial(spark, curve), **box)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, spatial.in_box(fact, **box).collect()))
        for c in ("region", "category"):
            assert c not in box or f"EqualTo({c},{box[c]})" in _scan(got)


def _scan(df):
    import contextlib
    import io
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_ids_have_bloom_filters(spark, fact, tmp_path):
    spatial.write_spatial(fact.limit(1000), f"{tmp_path}/t", files=1)
    jvm = spark._jvm
    (file,) = (tmp_path / "t").glob("*.parquet")
    reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(
        jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(
            jvm.org.apache.hadoop.fs.Path(str(file)), spark._jsc.hadoopConfiguration()))
    offsets = {c.getPath().toDotString(): c.getBloomFilterOffset() for c in reader.getFooter().getBlocks()[0].getColumns()}
    reader.close()
    assert [n for n, at in offsets.items() if at >= 0] == ["order_id", "customer_id"]


def test_curve_takes_missing_values(spark, fact, tmp_path):
    some = fact.limit(50).withColumn("region", F.when(F.col("order_id") % 2 == 0, F.col("region"))).withColumn(
        "order_date", F.when(F.col("order_id") % 3 == 0, F.col("order_date"))).select(*FACT_COLUMNS)
    spatial.write_spatial(some, f"{tmp_path}/t")
    assert spatial.read_spatial(spark, f"{tmp_path}/t").exceptAll(some).count() == 0
    spatial.write_spatial(some.where("false"), f"{tmp_path}/e")
    assert spatial.read_spatial(spark, f"{tmp_path}/e").count() == 0


def test_bucketed_aggregates_have_no_exchange(spark, fact):
    for name, key, report in (("t_order", "order_id", bucketed.order_totals),
                              ("t_customer", "customer_id", bucketed.customer_totals)):
        bucketed.replace_table(fact, name, key, buckets=4)
        df = report(spark.table(name))
        assert "Exchange" not in _plan(df) and "Exchange" in _plan(report(fact))
        assert sorted(map(tuple, df.collect())) == sorted(map(tuple, report(fact).collect()))
    joined = spark.table("t_order").join(bucketed.order_totals(spark.table("t_order")).hint("merge"), "order_id")
    assert "Exchange" not in _plan(joined)


def test_a_failing_replacement_leaves_the_old_rows(spark, fact, tmp_path):
    bucketed.replace_table(fact.limit(10), "t_safe", "order_id", buckets=2)
    before = spark.table("t_safe").count()
    failing = fact.withColumn("sku", F.when(F.col("order_id") >= 0, F.raise_error(F.lit("no"))).otherwise(F.col("sku")))
    with pytest.raises(Exception, match="no"):
        bucketed.replace_table(failing, "t_safe", "order_id", buckets=2)
    assert spark.table("t_safe").count() == before == 10
    reader = spark.table("t_safe")
    for n in (20, 30):
        bucketed.replace_table(fact.limit(n), "t_safe", "order_id", buckets=2)
        assert spark.table("t_safe").count() == n
        if n == 20:
            assert reader.count() == 10  # planned on the version before
    assert len(bucketed._versions(spark, "t_safe")) == 2

    path = f"{tmp_path}/fact"
    warehouse.write_fact(fact.limit(10), path)
    with pytest.raises(Exception, match="no"):
        warehouse.write_fact(failing, path)
    assert warehouse.read_fact(spark, path).count() == 10
    assert [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["fact"]


def _executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_calendar_filter_prunes_months_at_run_time(spark, fact, tmp_path):
    segments.write_calendar(read_table(spark, MEDIUM, "orders"), f"{tmp_path}/cal", "o_orderdate")
    calendar = segments.read_calendar(spark, f"{tmp_path}/cal")
    df = segments.quarter_by_segment(fact, calendar, F.col("cal_quarter") == "1996Q2")
    plan = _executed(df)
    assert "dynamicpruning" in plan.lower()
    found, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:  # the scans of the executed plan, through the adaptive stages
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
            continue
        if name.endswith("QueryStageExec"):
            todo.append(node.plan())
            continue
        if name == "FileSourceScanExec" and "order_month" in node.toString():
            found.append(node.metrics().apply("numPartitions").value())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    assert found and max(found) == 3, found


def test_large_facts_get_a_run_time_filter_of_order_keys(spark, fact, tmp_path):
    segments.write_calendar(read_table(spark, MEDIUM, "orders"), f"{tmp_path}/cal", "o_orderdate")
    calendar = segments.read_calendar(spark, f"{tmp_path}/cal")
    orders = read_table(spark, MEDIUM, "orders").where("o_orderpriority = '1-URGENT'")
    settings = {"spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
                "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in settings}
    plain = sorted(map(tuple, segments.quarter_by_segment(fact, calendar, F.col("cal_year") == 1996, orders).collect()))
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        df = segments.quarter_by_segment(fact, calendar, F.col("cal_year") == 1996, orders)
        assert "might_contain" in _plan(df) and sorted(map(tuple, df.collect())) == plain
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
