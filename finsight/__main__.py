"""Command line: the daily flow as three steps.

  python -m finsight export-fixture --sf-dir /root/testdata/sf0.01 --out /data/landing
  python -m finsight load --csv-dir /data/landing --root /data/warehouse [--keep-time]
  python -m finsight run --root /data/warehouse [--as-of 2024-02-15] [--select TAG ...]
                         [--layers staging intermediate marts] [--materialize-all] [--quarantine] [--no-tests]
                         [--z-threshold 3] [--freq-threshold 5] [--fix-night] [--audit-columns]
  python -m finsight check --root /data/warehouse [--as-of 2024-02-15]

``load`` reads ``<csv-dir>/<table>.csv`` (file or folder) for the five raw tables into
``<root>/raw``; ``run`` reads ``<root>/raw`` and writes the layers under ``<root>``; ``check`` prints
row counts (and fails on an empty table), anomaly volume, churn distribution and freshness.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import os
import sys

from finsight import schemas
from finsight.params import Params


def _session(args):
    from finsight.session import build_session
    return build_session(args.master, args.shuffle_partitions)


def _params(args) -> Params:
    kw = {}
    if getattr(args, "as_of", None):
        kw["as_of"] = dt.date.fromisoformat(args.as_of)
    for name in ("z_threshold", "freq_threshold"):
        if getattr(args, name, None) is not None:
            kw[name] = getattr(args, name)
    if getattr(args, "fix_night", False):
        kw["fix_night"] = True
    if getattr(args, "audit_columns", False):
        kw["audit_columns"] = True
    return Params(**kw)


def cmd_export_fixture(args) -> int:
    from finsight.sources import csv_ingest, fixtures
    spark = _session(args)
    raw = fixtures.raw_tables(spark, args.sf_dir, _params(args))
    for t in schemas.LOAD_ORDER:
        csv_ingest.write_csv(raw[t], os.path.join(args.out, f"{t}.csv"))
        print(f"exported {t}")
    return 0


def cmd_load(args) -> int:
    from finsight.sources import loader
    spark = _session(args)
    paths = {t: os.path.join(args.csv_dir, f"{t}.csv") for t in schemas.LOAD_ORDER}
    paths = {t: path for t, path in paths.items() if _readable(lambda: spark.read.text(path))}
    res = loader.load_raw(spark, paths, os.path.join(args.root, "raw"), truncate_dates=not args.keep_time)
    for r in res:
        print(json.dumps(r.__dict__))
    if not loader.all_loaded(res) or len(res) < len(schemas.LOAD_ORDER):
        return 1
    # statistics only after a complete load (one-row aggregates)
    from finsight.operators import monitoring
    raw = _raw(spark, args.root)
    stats = {
        "avg_trans_per_client": monitoring.avg_transactions_per_client(raw["transactions"]).first().avg_trans,
        "avg_amount": str(monitoring.avg_amount(raw["transactions"]).first().avg_montant),
        "active_contracts": monitoring.active_contracts(raw["contrats"]).first().contrats_actifs,
        "claim_rate_pct": str(monitoring.claim_rate(raw["contrats"], raw["sinistres"]).first().ratio),
    }
    print(json.dumps({"load_statistics": stats}))
    return 0


def _readable(read) -> bool:
    """Whether Spark finds the files (whatever store the path names)."""
    from pyspark.errors import AnalysisException
    try:
        read()
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def _raw(spark, root):
    from finsight.sources import loader
    return {t: loader.read_table(spark, os.path.join(root, "raw"), t) for t in schemas.LOAD_ORDER}


def cmd_run(args) -> int:
    from finsight.plans import pipeline
    from finsight.sources import loader
    spark = _session(args)
    rel, log = pipeline.run_pipeline(spark, _raw(spark, args.root), _params(args), args.root,
                                     layers=args.layers, tags=set(args.select) if args.select else None,
                                     run_tests=not args.no_tests, materialize_all=args.materialize_all,
                                     raw_id=loader.snapshot_id(spark, os.path.join(args.root, "raw")),
                                     quarantine=args.quarantine)
    for step in log:
        print(json.dumps(step.__dict__))
    if args.catalog is not None:
        from finsight.plans import catalog
        for layer, name, kind in catalog.register(spark, args.root, os.path.join(args.root, "raw"), args.catalog):
            print(json.dumps({"registered": f"{args.catalog}{layer}.{name}", "kind": kind}))
    return 1 if log and log[-1].step == "stop" else 0


def cmd_check(args) -> int:
    from finsight.operators import monitoring, staging
    from finsight.plans import pipeline
    spark = _session(args)
    p = _params(args)
    raw = _raw(spark, args.root)
    tables = {f"raw.{t}": raw[t] for t in ("clients", "transactions")}
    for t in ("clients", "transactions"):  # staging relations are views unless a run stored them
        tables[f"staging.stg_{t}"] = staging.STAGING[t](raw[t], p)
    for name in ("fct_anomalies_transactions", "fct_churn_predictions"):
        if not _readable(lambda name=name: pipeline.read_model(spark, args.root, name)):
            print(f"ERROR table marts.{name} is missing")
            return 1
        tables[f"marts.{name}"] = pipeline.read_model(spark, args.root, name)
    try:
        counts = monitoring.require_non_empty(monitoring.row_counts(tables))
    except monitoring.EmptyTableError as e:
        print(f"ERROR {e}")
        return 1
    print(json.dumps({"row_counts": dict(counts)}))
    r = monitoring.anomaly_counts(tables["marts.fct_anomalies_transactions"]).first()
    print(json.dumps({"anomalies": r.total, "critical": r.critiques}))
    if r.total == 0:
        print("WARN no anomaly detected")
    dist = monitoring.churn_distribution(tables["marts.fct_churn_predictions"]).collect()  # <= 4 rows
    print(json.dumps({"churn_distribution": {x.segment_risque: x.nb_clients for x in dist}}))
    f = monitoring.freshness(raw["transactions"], p.as_of).first()
    print(json.dumps({"last_loaded_at": str(f.last_loaded_at), "age_hours": f.age_hours,
                      "status": f.freshness_status, "alert_48h": f.alert_48h}))
    return 0


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="finsight")
    ap.add_argument("--master", default=None)
    ap.add_argument("--shuffle-partitions", type=int, default=None)
    sub = ap.add_subparsers(dest="cmd", required=True)
    e = sub.add_parser("export-fixture")
    e.add_argument("--sf-dir", required=True)
    e.add_argument("--out", required=True)
    e.add_argument("--as-of")
    ld = sub.add_parser("load")
    ld.add_argument("--csv-dir", required=True)
    ld.add_argument("--root", required=True)
    ld.add_argument("--keep-time", action="store_true", help="keep the time of day in date columns")
    r = sub.add_parser("run")
    r.add_argument("--root", required=True, help="warehouse root: reads <root>/raw, writes the layers under it")
    r.add_argument("--as-of", help="as-of date YYYY-MM-DD (default 2024-02-15)")
    r.add_argument("--layers", nargs="*", help="subset of: staging intermediate marts")
    r.add_argument("--select", nargs="*", help="tags a model must carry")
    r.add_argument("--materialize-all", action="store_true", help="write staging and intermediate too")
    r.add_argument("--quarantine", action="store_true",
                   help="set raw rows that break a declared rule aside and go on with the others")
    r.add_argument("--catalog", nargs="?", const="", metavar="PREFIX",
                   help="register the stored relations, one database a layer (names begin with PREFIX)")
    r.add_argument("--no-tests", action="store_true", help="skip the declared checks (no gate)")
    r.add_argument("--z-threshold", type=float, help="amount anomaly when |z| is above (default 3)")
    r.add_argument("--freq-threshold", type=int, help="frequency anomaly above this many per day (default 5)")
    r.add_argument("--fix-night", action="store_true", help="night = hour >= 22 or <= 6 (default: literal rule)")
    r.add_argument("--audit-columns", action="store_true", help="add wall-clock audit columns")
    c = sub.add_parser("check")
    c.add_argument("--root", required=True)
    c.add_argument("--as-of")
    args = ap.parse_args(argv)
    return {"export-fixture": cmd_export_fixture, "load": cmd_load, "run": cmd_run, "check": cmd_check}[args.cmd](args)


if __name__ == "__main__":
    sys.exit(main())
