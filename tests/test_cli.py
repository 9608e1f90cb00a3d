import json

from tillstar.__main__ import main
from tillstar.queries import QUERIES
from tillstar.sources.testdata import write_source_files

from conftest import SF_SMALL


def _rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)


def test_cli_all(spark, scratch, capsys):
    specs = write_source_files(spark, SF_SMALL, scratch + "/src")
    cfg = scratch.replace("file:", "") + "/sources.json"
    with open(cfg, "w") as f:
        json.dump([{"name": s.name, "format": s.format, "paths": list(s.paths)} for s in specs], f)
    main(["all", "--sources", cfg, "--raw-db", "cli_raw"])
    assert "presentation.daily_order_revenue:" in capsys.readouterr().out
    got = spark.table("presentation.daily_order_revenue").drop("year", "month")
    assert _rows(got) == _rows(QUERIES["daily_revenue"](spark, SF_SMALL))
