"""End-to-end batch job on the driver's tables: write, read back, publish."""

import csv
import glob
import os
import tempfile

import pytest

from given import SF001
from pressio.plans import catalog as C
from pressio.plans import run
from pressio.plans.run import current_run, run_all
from pressio.sources import adapters as A
from pressio.sources import publish_frame


def test_run_all_publishes_every_product(spark):
    out = tempfile.mkdtemp(prefix="pressio-run-")
    paths = run_all(spark, A.incidence_raw(spark, SF001), A.vaccination_raw(spark, SF001),
                    A.dimension_raw(spark, SF001), out, C.CFG,
                    population=A.population_raw(spark, SF001))
    assert set(paths) >= {"result", "snapshot", "map", "scatter", "arrow", "weekly", "daily",
                          "population"}
    res = spark.read.parquet(paths["result"])
    assert res.count() == C.full_result(spark, SF001).count()
    assert current_run(spark, out) == os.path.dirname(paths["result"])
    queries = {"snapshot": C.snapshot_labelled, "map": C.snapshot_map, "scatter": C.snapshot_scatter,
               "arrow": C.arrow, "weekly": C.weekly_wide, "daily": C.daily_wide}
    for name, query in queries.items():
        want = publish_frame(query(spark, SF001))
        head, rows = _published(paths[name])
        assert head == want.columns
        assert sorted(rows) == sorted(["NA" if v is None else v for v in r] for r in want.collect()), name
    head, rows = _published(paths["population"])
    want = C.weighted_count_q(spark, SF001).orderBy("rank").collect()
    assert rows == [[r[0], str(r[1])] for r in want] and rows[-1][0] == "TOTAL"


def _published(path):
    head, rows = None, []
    for f in sorted(glob.glob(os.path.join(path, "part-*.csv"))):
        with open(f, encoding="utf-8") as fh:
            head, *more = list(csv.reader(fh))
        rows += more
    return head, rows


def test_failed_run_leaves_the_published_set(spark, monkeypatch):
    out = tempfile.mkdtemp(prefix="pressio-run-")
    feeds = (A.incidence_raw(spark, SF001), A.vaccination_raw(spark, SF001), A.dimension_raw(spark, SF001))
    assert current_run(spark, out) is None
    first = run_all(spark, *feeds, out, C.CFG)

    def broken(result, cfg):
        raise RuntimeError("fourth product")
    monkeypatch.setitem(run.PRODUCTS, "arrow", broken)
    with pytest.raises(RuntimeError, match="fourth"):
        run_all(spark, *feeds, out, C.CFG)
    now = current_run(spark, out)
    assert now == os.path.dirname(first["result"])
    assert sorted(os.listdir(os.path.join(now, "products"))) == sorted(
        ["snapshot", "map", "scatter", "arrow", "weekly", "daily"])


def test_cli_from_csv_feeds(spark):
    from pressio.plans.run import main
    feeds = tempfile.mkdtemp(prefix="pressio-feeds-")
    for name, df in [("inc", A.incidence_raw(spark, SF001)), ("vax", A.vaccination_raw(spark, SF001)),
                     ("dim", A.dimension_raw(spark, SF001))]:
        df.coalesce(1).write.option("header", True).csv(os.path.join(feeds, name))
    out = os.path.join(feeds, "out")
    main(["--incidence", os.path.join(feeds, "inc"), "--vaccination", os.path.join(feeds, "vax"),
          "--dimension", os.path.join(feeds, "dim"), "--out", out, "--as-of", "1998-06-03",
          "--weekly-start", "1997-07-05", "--total-label", "TOTAL",
          "--single-dose-supplier", "R"])
    now = current_run(spark, out)
    res = spark.read.parquet(os.path.join(now, "result"))
    assert res.count() == C.full_result(spark, SF001).count()
    snap = glob.glob(os.path.join(now, "products", "snapshot", "part-*.csv"))
    with open(snap[0], encoding="utf-8") as fh:
        rows = list(csv.reader(fh))
    assert len(rows[0]) == 31 and rows[-1][1] == "TOTAL"
