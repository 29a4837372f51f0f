"""The batch job: feeds -> full result (written once) -> published files.

Mirrors the published pipeline's run (every few hours, full recompute,
overwrite), re-expressed for Spark: the full result is written once as
Parquet partitioned by month (S5) into a new run folder; every product is
read back from the months it needs (partition pruning) and written as CSV
(S6, S7). A marker written last publishes the run as a whole: readers take
the latest marked run, so a failure half way shows nothing of itself.

    python -m pressio.plans.run --incidence PATH --vaccination PATH \\
        --dimension PATH --out DIR --as-of 2022-05-19 [--population PATH]
"""

from __future__ import annotations

import argparse
import datetime as dt
import os
import sys
import uuid

from pyspark.sql import SparkSession

from ..config import REFERENCE, PipelineConfig
from ..sources import (observe_rejects, publish_csv, read_result, read_table, read_with_rejects,
                       schemas, write_result)
from ..sources.io import months
from . import result as P
from . import products as R

PRODUCTS = {
    "snapshot": R.snapshot_labelled,
    "map": R.snapshot_map,
    "scatter": R.snapshot_scatter,
    "arrow": R.arrow,
    "weekly": R.weekly_wide,
    "daily": R.daily_wide,
}


def product_months(cfg: PipelineConfig) -> dict:
    """The result months each product reads (partition pruning)."""
    snap = months(cfg.day(cfg.snapshot_lag), cfg.day(cfg.snapshot_lag))
    return {
        "snapshot": snap, "map": snap, "scatter": snap,
        "arrow": months(cfg.day(cfg.previous_lag), cfg.day(cfg.snapshot_lag)),
        "weekly": months(cfg.weekly_start, cfg.as_of),
        "daily": months(cfg.day(cfg.last_days), cfg.day(cfg.snapshot_lag)),
    }


def run_all(spark: SparkSession, incidence, vaccination, dimension, out_dir: str,
            cfg: PipelineConfig = REFERENCE, population=None, observed=None) -> dict:
    """Compute, write and publish into a fresh run folder, then make it the
    current one; returns the written paths. A run that fails leaves the
    published set as it was: see :func:`current_run`. ``observed`` holds, by
    feed, the counts of unreadable cells that the write of the result gathers
    (:func:`~pressio.sources.observe_rejects`); they are written as ``rejects``."""
    run = f"run-{dt.datetime.now(dt.timezone.utc):%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"
    run_dir = os.path.join(out_dir, "runs", run)
    result_path = os.path.join(run_dir, "result")
    write_result(P.full_result(incidence, vaccination, dimension, cfg), result_path, cfg.date)
    written = {"result": result_path}
    if observed:
        counts = [(feed, column, n) for feed, seen in observed.items() for column, n in seen.get.items()]
        written["rejects"] = os.path.join(run_dir, "rejects")
        publish_csv(spark.createDataFrame(counts, "feed string, column string, n_rejected long"),
                    written["rejects"], order_by=["feed", "column"])
        for feed, column, n in counts:
            if n:
                print(f"{feed}: {n} unreadable in {column}", file=sys.stderr)
    labels = dict((c, lab) for lab, c in cfg.table_labels)
    order = {
        "snapshot": R.snapshot_order(cfg, labels.get(cfg.entity, cfg.entity)),
        "map": R.snapshot_order(cfg),
        "scatter": R.snapshot_order(cfg),
        "arrow": R.arrow_order(cfg),
        "weekly": R.weekly_order(),
        "daily": [cfg.date],
    }
    needed = product_months(cfg)
    for name, product in PRODUCTS.items():
        path = os.path.join(run_dir, "products", name)
        result = read_result(spark, result_path, needed[name])
        publish_csv(product(result, cfg), path, order_by=order[name])
        written[name] = path
    if population is not None:
        path = os.path.join(run_dir, "population")
        publish_csv(R.population_by_entity(population, cfg), path,
                    order_by=R.population_order(cfg))
        written["population"] = path
    _make_current(spark, out_dir, run)
    return written


def _store(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _make_current(spark: SparkSession, out_dir: str, run: str) -> None:
    """An empty marker, named so that the latest sorts last, appears in one
    step after everything else is written."""
    p, fs = _store(spark, os.path.join(out_dir, "published", run))
    fs.mkdirs(p.getParent())
    fs.create(p, False).close()


def current_run(spark: SparkSession, out_dir: str) -> str | None:
    """The folder of the latest run that was published whole."""
    p, fs = _store(spark, os.path.join(out_dir, "published"))
    if not fs.exists(p):
        return None
    names = sorted(s.getPath().getName() for s in fs.listStatus(p))
    return os.path.join(out_dir, "runs", names[-1]) if names else None


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.split("\n")[0])
    ap.add_argument("--incidence", required=True)
    ap.add_argument("--vaccination", required=True)
    ap.add_argument("--dimension", required=True)
    ap.add_argument("--population")
    ap.add_argument("--out", required=True)
    ap.add_argument("--as-of", required=True, type=dt.date.fromisoformat)
    ap.add_argument("--weekly-start", type=dt.date.fromisoformat,
                    default=REFERENCE.weekly_start)
    ap.add_argument("--total-label", default=REFERENCE.total_label)
    ap.add_argument("--single-dose-supplier", default=REFERENCE.single_dose_supplier)
    ap.add_argument("--format", default="csv", choices=["csv", "parquet"],
                    help="format of the landed feeds (default csv)")
    ap.add_argument("--master", help="only for local runs, e.g. local[8]")
    args = ap.parse_args(argv)
    from ..session import build_session
    spark = build_session(args.master)
    cfg = REFERENCE.with_(as_of=args.as_of, weekly_start=args.weekly_start,
                          total_label=args.total_label,
                          single_dose_supplier=args.single_dose_supplier)
    fmt = args.format
    observed = {}

    def feed(name: str, path: str, day: str):
        schema = schemas.BY_NAME[name]
        df, observed[name] = observe_rejects(read_with_rejects(spark, path, schema, [day], fmt), schema.names)
        return df

    inc = feed("incidence", args.incidence, "data")
    vax = feed("vaccination", args.vaccination, "data_somministrazione")
    dim = read_table(spark, args.dimension, schemas.DIMENSION, fmt)
    pop = (read_table(spark, args.population, schemas.POPULATION, fmt)
           if args.population else None)
    for k, v in run_all(spark, inc, vax, dim, args.out, cfg, pop, observed).items():
        print(k, v)


if __name__ == "__main__":
    main()
