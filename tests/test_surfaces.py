"""CSV quarantine, VARIANT payload, SQL table functions."""

import contextlib
import io
import json

import pytest

from salesforge.operators import payload, payload_variant, sales, sql_functions
from salesforge.schema import RAW_COLUMNS
from salesforge.sources import csv_export
from salesforge.sources.warehouse import fact_table
from tests.conftest import SMALL

GOOD = "1,2,2023-01-05,ASIA,c,s,web,card,2,10.0,5,20.0,1.0,19.0,0"


def _export(tmp_path, lines, name="a.csv"):
    folder = tmp_path / "export"
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join([",".join(RAW_COLUMNS), *lines]) + "\n")
    return str(folder)


def test_lines_of_wrong_length_are_counted_quarantined_or_refused(spark, tmp_path):
    short, long, opened = "3,2,2023-01-05,ASIA,c,s", GOOD + ",x,y", '"4,2,2023-01-05' + GOOD[14:]
    path = _export(tmp_path, [GOOD, short, GOOD.replace("1,2", "9,2", 1), long, opened, GOOD.replace(",2,10.0", ",two,10.0")])
    _export(tmp_path, [GOOD, short], "b.csv")
    counted = csv_export.read_csv_export(spark, path, count_unparsed=True)
    assert counted.count() == 8 and sum(r["unparsed_fields"] > 0 for r in counted.collect()) == 5
    for f in (lambda: csv_export.read_csv_export(spark, path, strict=True).collect(),
              lambda: csv_export.read_csv_export(spark, path, strict=True).count()):
        with pytest.raises(Exception, match="wrong length|no value of their type"):
            f()
    good, bad = csv_export.read_with_quarantine(spark, path)
    assert good.count() == 4 and bad.count() == 4
    rows = {(r["file"].rsplit("/", 1)[1], r["row"]): r["line"] for r in bad.collect()}
    assert rows == {("a.csv", 1): short, ("a.csv", 3): long, ("a.csv", 4): opened, ("b.csv", 1): short}
    good, clean, quarantined = csv_export.ingest_export(spark, path, f"{tmp_path}/q")
    (row,) = csv_export.intake_balance(spark, path, good, clean, quarantined).collect()
    # three of the good lines have one key
    assert row.asDict() == {"lines_read": 8, "quarantined": 4, "duplicates": 2, "clean": 2, "balanced": True}


def test_sound_export_is_read_strictly(spark, tmp_path):
    path = _export(tmp_path, [GOOD])
    assert csv_export.read_csv_export(spark, path, strict=True).count() == 1


@pytest.fixture(scope="module")
def fact(spark):
    return fact_table(spark, SMALL)


def test_variant_series_take_unknown_keys(spark, fact):
    doc = payload.dashboard_payload(fact)
    known = payload.payload_series(doc)
    rows = lambda df: sorted(repr(tuple(r)) for r in df.select(*known.columns).collect())
    assert rows(payload_variant.payload_series_variant(doc)) == rows(known)
    changed = json.loads(doc.first()["payload"])
    changed["kpi"]["zz_margin"] = 1.5
    changed["store_mix"] = [{"channel": "kiosk", "revenue": 3.0, "extra": {"a": 1}}]
    changed["note"] = "text"
    for e in changed["monthly_trend"]:
        e["forecast"] = 1
    more = spark.createDataFrame([(json.dumps(changed),)], "payload string")
    got = payload_variant.payload_series_variant(more)
    extra = got.where("series = 'store_mix' or label = 'zz_margin'").collect()
    assert {(r["series"], r["label"], r["value"]) for r in extra} == {("store_mix", "kiosk", 3.0), ("kpi", "zz_margin", 1.5)}
    assert rows(got.where("series <> 'store_mix' and not coalesce(label = 'zz_margin', false)")) == rows(known)
    bad = spark.createDataFrame([("no json",), (None,), ("{}",)], "payload string")
    assert payload_variant.payload_series_variant(bad).count() == 0


def _explain(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_sql_functions_equal_the_data_frame_reports(spark, fact):
    sql_functions.register_sql(spark, fact)
    asia = fact.where("region = 'ASIA'")
    calls = [("monthly_revenue_mom", "", sales.monthly_revenue_mom(fact)),
             ("monthly_revenue_mom", "'ASIA'", sales.monthly_revenue_mom(asia)),
             ("top_skus_per_category", "top_n => 5", sales.top_skus_per_category(fact, 5)),
             ("top_skus_per_category", "2, 'PROMO'", sales.top_skus_per_category(fact, 2).where("category = 'PROMO'")),
             ("regional_cumulative", "'ASIA'", sales.regional_cumulative(fact).where("region = 'ASIA'")),
             ("customer_value_quartiles", "", sales.customer_value_quartiles(fact)),
             ("customer_value_quartiles", "tiles => 7, region_name => 'ASIA'", sales.customer_value_quartiles(asia, 7)),
             ("customer_value_quartiles", "1000", sales.customer_value_quartiles(fact, 1000)),
             ("return_rate_vs_avg", "'ASIA'", sales.return_rate_vs_avg(asia)),
             ("channel_payment_mix", "'ASIA', DATE'1996-01-01', DATE'1997-06-30'",
              sales.channel_payment_mix(asia.where("order_date between '1996-01-01' and '1997-06-30'")))]
    for name, arguments, want in calls:
        got = sql_functions.call(spark, name, arguments)
        assert got.dtypes == want.dtypes
        assert sorted(repr(tuple(r)) for r in got.collect()) == sorted(repr(tuple(r)) for r in want.collect()), (name, arguments)
    plan = _explain(sql_functions.call(spark, "channel_payment_mix", "'ASIA', DATE'1996-01-01'"))
    assert "EqualTo(region,ASIA)" in plan and "GreaterThanOrEqual(order_date,1996-01-01)" in plan
    assert "sku" not in plan.split("ReadSchema: ")[1].split("\n")[0]
    with pytest.raises(ValueError, match="no such report"):
        sql_functions.call(spark, "nothing")
