"""Job entry points (``python -m dockwatch.jobs.cli <command> ...`` or via
spark-submit). Each command is a thin wrapper over the library functions."""

from __future__ import annotations

import argparse
import json
import sys
from datetime import datetime

from pyspark.sql import SparkSession

from dockwatch.ml.model import DEFAULT_MAX_ITER
from dockwatch.settings import DEFAULT_TOP_N, SENSITIVITY_THRESHOLDS, Settings


def _spark(args) -> SparkSession:
    if args.local:
        from dockwatch.session import local_session
        return local_session(args.local)
    spark = SparkSession.builder.appName(f"dockwatch-{args.cmd}").getOrCreate()
    from dockwatch.session import REQUIRED_CONF, ensure_checkpoint_dir
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    ensure_checkpoint_dir(spark)
    return spark


def _readings(spark, args):
    from dockwatch.sources.readings import load_readings, readings_for
    if args.events_dir:
        return readings_for(spark, args.events_dir)
    return load_readings(spark, args.readings)


def _settings(args) -> Settings:
    s = Settings.from_env()
    for name in ("min_forward_rows", "min_capacity", "empty_threshold", "sample_interval_min"):
        v = getattr(args, name, None)
        if v is not None:
            s = s.with_(**{name: v})
    return s


def _newest(spark, args) -> dict:
    from dockwatch.sources.runs import newest_run
    return newest_run(spark, args.runs) if args.runs else {}


def _scorer(spark, args, rule):
    """The model that is named, that of the newest run, or the rule."""
    from dockwatch.ml.model import load_model
    from dockwatch.ml.scorers import ModelScorer
    path = args.model or _newest(spark, args).get("model")
    return ModelScorer(load_model(path)) if path else rule()


def _show(df):
    """Every row as a JSON line, fetched one partition at a time."""
    for row in df.toLocalIterator():
        print(json.dumps(row.asDict(recursive=True), default=str))


def main(argv=None) -> int:
    p = argparse.ArgumentParser(prog="dockwatch")
    p.add_argument("--local", help="run on local[N] (tests, laptops)")
    p.add_argument("--readings", help="readings table (parquet)")
    p.add_argument("--events-dir", help="derive readings from <dir>/events.parquet")
    p.add_argument("--min-forward-rows", dest="min_forward_rows", type=int)
    p.add_argument("--min-capacity", dest="min_capacity", type=float)
    p.add_argument("--empty-threshold", dest="empty_threshold", type=float)
    p.add_argument("--sample-interval", dest="sample_interval_min", type=int)
    sub = p.add_subparsers(dest="cmd", required=True)
    b = sub.add_parser("build")
    b.add_argument("--out", required=True)
    b.add_argument("--dry-run", action="store_true")
    v = sub.add_parser("validate")
    v.add_argument("--dataset", required=True)
    sub.add_parser("attrition")
    se = sub.add_parser("sensitivity")
    se.add_argument("--thresholds", default=",".join(map(str, SENSITIVITY_THRESHOLDS)))
    ins = sub.add_parser("inspect")
    ins.add_argument("--station", required=True)
    ins.add_argument("--start", required=True)
    ins.add_argument("--end", required=True)
    ins.add_argument("--dataset", help="a written dataset, read by day instead of built")
    tr = sub.add_parser("train")
    tr.add_argument("--dataset", required=True)
    tr.add_argument("--out", required=True)
    tr.add_argument("--max-iter", type=int, default=DEFAULT_MAX_ITER)
    ev = sub.add_parser("evaluate")
    ev.add_argument("--dataset")
    ev.add_argument("--model")
    ev.add_argument("--metrics")
    ev.add_argument("--runs", help="folder of the run table: its newest run stands for paths not given")
    tg = sub.add_parser("triage")
    tg.add_argument("--model")
    tg.add_argument("--at", required=True)
    tg.add_argument("--top-n", type=int, default=DEFAULT_TOP_N)
    tg.add_argument("--debug", action="store_true")
    tg.add_argument("--index", help="look-back index table (see the index command)")
    tg.add_argument("--runs")
    ix = sub.add_parser("index", help="write the station look-back index")
    ix.add_argument("--out", required=True)
    sc = sub.add_parser("score", help="score a table of requests (station_id, obs_ts)")
    sc.add_argument("--requests", required=True)
    sc.add_argument("--out", required=True)
    sc.add_argument("--model")
    sc.add_argument("--index")
    sc.add_argument("--runs")
    sc.add_argument("--debug", action="store_true")
    lv = sub.add_parser("score-live", help="score requests against readings, both arriving as Parquet files")
    for name in ("--requests", "--out", "--checkpoint"):
        lv.add_argument(name, required=True)
    lv.add_argument("--model")
    lv.add_argument("--runs")
    lv.add_argument("--max-bikes", type=float, default=0.0, help="of the rule, without a model")
    lv.add_argument("--delay", default="1 hour")
    lv.add_argument("--late-hours", type=int, default=24)
    lv.add_argument("--once", action="store_true", help="stop when all files are read")
    ch = sub.add_parser("chain", help="build, validate, train; publish the run if all went well")
    ch.add_argument("--out", required=True)
    ch.add_argument("--max-iter", type=int, default=DEFAULT_MAX_ITER)
    args = p.parse_args(argv)

    spark = _spark(args)
    s = _settings(args)
    if args.cmd == "build":
        from dockwatch.plans.dataset import build_dataset
        from dockwatch.sources.artifacts import write_dataset
        ds = build_dataset(_readings(spark, args), s)
        if args.dry_run:
            ds.explain("formatted")
            print(f"dry run: {ds.count():,} rows")
            return 0
        path = write_dataset(ds, args.out, spark, upstream=args.readings or args.events_dir or "")
        print(path or "WARNING: dataset is empty, nothing written")
        return 0
    if args.cmd == "validate":
        from dockwatch.reports.validation import validate_dataset
        from dockwatch.sources.artifacts import load_dataset
        ok, rep = validate_dataset(load_dataset(spark, args.dataset))
        print(json.dumps(rep, default=str, indent=2))
        print("PASS" if ok else "FAIL")
        return 0 if ok else 1
    if args.cmd == "attrition":
        from dockwatch.reports import diagnose as G
        r = _readings(spark, args)
        for df in (G.station_attrition(r, s), G.obs_attrition(r, s), G.forward_count_dist(r, s)):
            _show(df)
        return 0
    if args.cmd == "sensitivity":
        from dockwatch.reports.diagnose import forward_sensitivity
        th = [int(x) for x in args.thresholds.split(",") if x]
        _show(forward_sensitivity(spark, _readings(spark, args), s, th).orderBy("threshold"))
        return 0
    if args.cmd == "inspect":
        from dockwatch.plans.dataset import build_dataset
        from dockwatch.reports import diagnose as G
        from dockwatch.sources.artifacts import load_dataset
        r = _readings(spark, args)
        if G.station_reading_count(r, args.station) == 0:
            print(f"Station '{args.station}' not found.")
            return 0
        start, end = datetime.fromisoformat(args.start), datetime.fromisoformat(args.end)
        ds = load_dataset(spark, args.dataset, start, end) if args.dataset else build_dataset(r, s)
        rows = G.inspect_dataset(ds, args.station, start, end).cache()
        if rows.count() == 0:
            from pyspark.sql import functions as F
            _show(G.station_capacity(r.filter(F.col("station_id") == args.station)))
            return 0
        _show(rows.orderBy("obs_ts"))
        _show(G.inspect_raw_around(r, rows).orderBy("obs_ts", "window_start"))
        fwd = G.inspect_forward_rows(r, rows, s)
        _show(G.label_justification(fwd, s).orderBy("obs_ts"))
        _show(G.inspect_forward_trim(fwd).orderBy("obs_ts", "window_start"))
        return 0
    if args.cmd == "train":
        from dockwatch.ml.training import train_run
        from dockwatch.sources.artifacts import load_dataset
        rec = train_run(spark, load_dataset(spark, args.dataset), args.out, args.max_iter,
                        input_path=args.dataset)
        print(json.dumps({k: v for k, v in rec.items() if not k.startswith("_")}, default=str,
                         indent=2))
        return 0
    if args.cmd == "evaluate":
        from dockwatch.ml.training import evaluate_saved
        from dockwatch.sources.artifacts import load_dataset
        run = _newest(spark, args)
        paths = [getattr(args, n) or run.get(n) for n in ("dataset", "model", "metrics")]
        if not all(paths[:2]):
            p.error("evaluate needs --dataset and --model, or --runs")
        _show(evaluate_saved(spark, load_dataset(spark, paths[0]), *paths[1:]))
        return 0
    if args.cmd == "index":
        from dockwatch.plans.lookback import station_days
        station_days(_readings(spark, args)).write.mode("overwrite").parquet(args.out)
        return 0
    if args.cmd == "score":
        from dockwatch.ml.scorers import RuleScorer
        from dockwatch.plans.scoring import score_requests
        r = _readings(spark, args)
        score_requests(r, spark.read.parquet(args.requests), _scorer(spark, args, lambda: RuleScorer.fitted(r)), s, args.debug,
                       spark.read.parquet(args.index) if args.index else None).write.mode("overwrite").parquet(args.out)
        return 0
    if args.cmd == "score-live":
        from dockwatch.ml.scorers import RuleScorer
        from dockwatch.streaming.live_score import score_live
        if not args.readings:
            p.error("score-live needs --readings")
        score_live(spark, args.readings, args.requests, args.out, args.checkpoint,
                   _scorer(spark, args, lambda: RuleScorer(max_bikes=args.max_bikes)), s, args.delay, args.late_hours,
                   available_now=args.once).awaitTermination()
        return 0
    if args.cmd == "chain":
        from dockwatch.jobs.chain import run_chain
        out = run_chain(spark, _readings(spark, args), args.out, s, args.max_iter, upstream=args.readings or args.events_dir or "")
        print(json.dumps(out, default=str, indent=2))
        return 0 if out["published"] else 1
    if args.cmd == "triage":
        from dockwatch.ml.scorers import RuleScorer
        from dockwatch.plans.triage import TriageError, triage_result
        scorer = _scorer(spark, args, RuleScorer)
        try:
            res = triage_result(_readings(spark, args), datetime.fromisoformat(args.at), scorer, s,
                                args.top_n, args.debug, spark.read.parquet(args.index) if args.index else None)
        except TriageError as e:
            print(json.dumps({"error": e.code, "detail": e.detail, "status": e.status}))
            return 1
        res.pop("skipped_stations")
        print(json.dumps(res, default=str, indent=2))
        return 0
    return 2


if __name__ == "__main__":
    sys.exit(main())
