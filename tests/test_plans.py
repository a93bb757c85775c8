"""Physical-plan checks: partial window limits, top-k fusion, pushdown, pruning, no Python UDFs."""

import pytest

import __spark_entry__ as E
from salesforge.operators import etl, payload, quality
from salesforge.plans import catalog
from salesforge.sources.tables import raw_lines
from tests.conftest import SMALL


def _plan(df):
    df.write.format("noop").mode("overwrite").save()  # final adaptive plan
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_uses_partial_window_group_limit(spark):
    spark.catalog.clearCache()
    plan = etl.dedup_lines(raw_lines(spark, SMALL))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_top_k_is_take_ordered(spark):
    plan = _plan(E.queries()["top_skus_overall"](spark, SMALL))
    assert "TakeOrderedAndProject" in plan


def test_rank_filter_becomes_window_group_limit(spark):
    plan = _plan(E.queries()["top_skus_per_category"](spark, SMALL))
    assert "WindowGroupLimit" in plan


def test_returned_filter_is_pushed_into_scan(spark):
    df = E.queries()["returned_lines"](spark, SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(is_returned), EqualTo(is_returned,1)]" in plan


def test_report_scan_reads_only_needed_columns(spark):
    df = E.queries()["channel_mix"](spark, SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    schema = plan.split("ReadSchema: ")[1].split("\\n")[0]
    assert "channel" in schema and "net_revenue" in schema and "sku" not in schema


NO_PYTHON = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas", "MapInPandas")


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_no_python_udf_in_any_plan(spark, name):
    plan = E.queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not [node for node in NO_PYTHON if node in plan]


def test_no_python_udf_in_what_the_writing_queries_write(spark):
    """Their results are read back from files, so the plans that were written are checked here."""
    raw = raw_lines(spark, SMALL)
    fact = etl.clean_fact(raw)
    written = [raw, fact, payload.dashboard_payload(fact), *quality.quality_report(fact).values()]
    for df in written:
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not [node for node in NO_PYTHON if node in plan]


def test_queries_leave_no_cached_frame_and_start_no_job_for_the_medians(spark):
    spark.catalog.clearCache()
    for name in ("etl_clean_fact", "boxplot_by_category", "boxplot_outliers", "report_tables", "warehouse_load"):
        E.queries()[name](spark, SMALL).count()
        assert spark.sparkContext._jsc.sc().getPersistentRDDs().size() == 0, name
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plan-only", "")
    etl.clean_fact(raw_lines(spark, SMALL))
    assert list(tracker.getJobIdsForGroup("plan-only")) == []
    spark.sparkContext.setJobGroup("", "")
