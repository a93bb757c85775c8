"""The three command-line runs, end to end on the fixture tables."""

import json
import os

from salesforge import cli
from salesforge.schema import INGEST_ORDER, RAW_COLUMNS
from salesforge.sources.csv_export import write_csv
from salesforge.sources.tables import raw_lines
from tests.conftest import SMALL


def test_cli_etl_payload_report(spark, tmp_path):
    exports = str(tmp_path / "exports")
    raw = raw_lines(spark, SMALL)
    write_csv(raw.orderBy("ingest_copy", "order_id", *INGEST_ORDER[:-1]).select(*RAW_COLUMNS)
                 .coalesce(1), exports)
    wh = str(tmp_path / "wh")
    m = cli.main(["--master", "local[4]", "etl", "--input", exports, "--warehouse", wh])
    assert m["raw_rows"] == 6063 and m["clean_rows"] == 5937 and m["invalid_price_rows"] == 29
    out = cli.main(["payload", "--warehouse", wh, "--out", str(tmp_path / "payload")])
    text = spark.read.text(out["payload"]).first()[0]
    assert json.loads(text)["kpi"]["total_records_analyzed"] == 5937
    paths = cli.main(["report", "--warehouse", wh, "--out", str(tmp_path / "report"), "--format", "csv"])
    assert set(paths) == {"summary", "root_cause_pareto", "by_category", "by_region", "adjustment_log"}
    assert all(os.path.isdir(p) for p in paths.values())
