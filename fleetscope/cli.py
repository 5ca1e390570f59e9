"""Command-line entry points with the platform's defaults.

    python -m fleetscope.cli stream    (--source DIR | --servers HOSTS --topic T | --log DIR --topic T)
                                       --store DIR --checkpoint DIR [--once] [--history]
    python -m fleetscope.cli replay    (--servers HOSTS | --log DIR) --topic T  (raw-stream summary, V9 V10)
    python -m fleetscope.cli ingest    --store DIR [--topic T]    (counts and lag of past batches, V11 H3)
    python -m fleetscope.cli aggregate --store DIR [--append]
    python -m fleetscope.cli quality   --store DIR            (exit code 0 pass / 1 fail)
    python -m fleetscope.cli gate      --store DIR            (quality, then aggregate or alert)
    python -m fleetscope.cli train     --store DIR --experiments DIR [--epochs 50 --lr 0.001
                                       --patience 5 --batch-size 32 --snapshot-id N]
    python -m fleetscope.cli evaluate  --store DIR --experiments DIR [--experiment ID]
    python -m fleetscope.cli catalog   --store DIR [--table T [--snapshots | --sample [--snapshot-id N] [--limit 10]]]
    python -m fleetscope.cli health    --store DIR [--as-of ISO] [--max-age 30]
    python -m fleetscope.cli experiments --experiments DIR [--experiment ID [--loss] | --latest]
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import functions as F

from fleetscope.operators import catalog as C
from fleetscope.schema import STALE_AFTER_MINUTES, STATUS_HEALTHY
from fleetscope.sources.fixtures import TOPIC


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="fleetscope")
    sub = ap.add_subparsers(dest="cmd", required=True)
    s = sub.add_parser("stream")
    src = s.add_mutually_exclusive_group(required=True)
    src.add_argument("--source", help="folder of JSON-lines message files")
    src.add_argument("--servers", help="Kafka bootstrap servers (needs the connector)")
    src.add_argument("--log", help="folder of a partitioned message log")
    s.add_argument("--topic", default=TOPIC)
    s.add_argument("--history", action="store_true", help="keep counts and lag of every batch in the store")
    s.add_argument("--store", required=True)
    s.add_argument("--checkpoint", required=True)
    s.add_argument("--once", action="store_true", help="drain what is available, then stop")
    for name in ("aggregate", "quality", "gate"):
        p = sub.add_parser(name)
        p.add_argument("--store", required=True)
        p.add_argument("--append", action="store_true")
    t = sub.add_parser("train")
    t.add_argument("--store", required=True)
    t.add_argument("--experiments", required=True)
    t.add_argument("--epochs", type=int, default=50)
    t.add_argument("--lr", type=float, default=1e-3)
    t.add_argument("--patience", type=int, default=5)
    t.add_argument("--batch-size", type=int, default=32)
    t.add_argument("--snapshot-id", type=int, default=None)
    e = sub.add_parser("evaluate")
    e.add_argument("--store", required=True)
    e.add_argument("--experiments", required=True)
    e.add_argument("--experiment", default=None)
    r = sub.add_parser("replay")
    where = r.add_mutually_exclusive_group(required=True)
    where.add_argument("--servers")
    where.add_argument("--log")
    r.add_argument("--topic", default=TOPIC)
    g = sub.add_parser("ingest")
    g.add_argument("--store", required=True)
    g.add_argument("--topic", default=TOPIC)
    c = sub.add_parser("catalog")
    c.add_argument("--store", required=True)
    c.add_argument("--table", default=None)
    c.add_argument("--snapshots", action="store_true")
    c.add_argument("--sample", action="store_true")
    c.add_argument("--snapshot-id", type=int, default=None)
    c.add_argument("--limit", type=int, default=10)
    h = sub.add_parser("health")
    h.add_argument("--store", required=True)
    h.add_argument("--as-of", default=None, help="ISO time; default: now")
    h.add_argument("--max-age", type=int, default=STALE_AFTER_MINUTES)
    x = sub.add_parser("experiments")
    x.add_argument("--experiments", required=True)
    x.add_argument("--experiment", default=None)
    x.add_argument("--latest", action="store_true")
    x.add_argument("--loss", action="store_true")
    args = ap.parse_args(argv)

    from fleetscope.session import build_session
    spark = build_session(app=f"fleetscope-{args.cmd}")
    if args.cmd == "stream":
        from fleetscope.sources import messagelog, messages
        from fleetscope.streaming.processor import TelemetryProcessor
        if args.source:
            source = messages.text_stream_source(spark, args.source)
        elif args.log:
            source = messagelog.log_stream(spark, args.log, args.topic)
        else:
            source = messages.stream_source(spark, args.servers, args.topic)
        q = TelemetryProcessor(args.store).start(source, args.checkpoint, available_now=args.once, history=args.history)
        try:
            q.awaitTermination()
        except KeyboardInterrupt:
            q.stop()
        return 0
    if args.cmd == "aggregate":
        from fleetscope.plans.gate import run_aggregation
        print(run_aggregation(spark, args.store, mode="append" if args.append else "overwrite"))
        return 0
    if args.cmd in ("quality", "gate"):
        from fleetscope.operators import quality as Q
        from fleetscope.plans.gate import run_quality_gate
        from fleetscope.sources import store
        if args.cmd == "quality":
            rows = Q.quality_report(store.read_snapshots(spark, args.store, "clean_events")) \
                .orderBy("check_order").collect()
            for r in rows:
                print(f"  [{'+' if r['passed'] else 'X'}] {r['check']:20s} "
                      f"{'PASS' if r['passed'] else 'FAIL'} - {r['detail']}")
            return 0 if all(r["passed"] for r in rows) else 1
        out = run_quality_gate(spark, args.store, mode="append" if args.append else "overwrite")
        print(json.dumps({"action": out.action, "checks": out.checks, "rows_written": out.rows_written}))
        return out.exit_code
    if args.cmd == "train":
        from fleetscope.plans.experiment import run_training
        print(run_training(spark, args.store, args.experiments, args.epochs, args.lr,
                           args.patience, args.batch_size, args.snapshot_id))
        return 0
    if args.cmd == "evaluate":
        from fleetscope.plans.experiment import run_evaluation
        r = run_evaluation(spark, args.store, args.experiments, args.experiment).first()
        print(json.dumps(r.asDict(recursive=True), default=str))
        return 0
    if args.cmd == "replay":
        from fleetscope.operators import validate as V
        from fleetscope.sources import messagelog, messages
        sent = (messagelog.log_replay(spark, args.log, args.topic) if args.log
                else messages.replay_source(spark, args.servers, args.topic))
        _show(V.raw_anomaly_summary(V.raw_anomaly_flags(sent)))
        return 0
    from fleetscope.plans import serving
    if args.cmd == "ingest":
        _show(serving.ingest_totals(spark, args.store).orderBy("stream"))
        _show(serving.past_ingest_health(spark, args.store, args.topic))
        return 0
    try:
        if args.cmd == "catalog":
            if args.table is None:
                _show(serving.tables(spark, args.store).orderBy("table_name"))
            elif args.snapshots:
                _show(serving.snapshots(spark, args.store, args.table).orderBy(F.col("snapshot_id").cast("long")))
            elif args.sample:
                _show(serving.sample(spark, args.store, args.table, args.snapshot_id, args.limit))
            else:
                _show(serving.table_detail(spark, args.store, args.table).orderBy("position"))
        elif args.cmd == "health":
            now = F.lit(args.as_of).cast("timestamp") if args.as_of else F.current_timestamp()
            fresh = serving.freshness(spark, args.store, now, args.max_age).persist()
            _show(fresh.orderBy("table_name"))
            status = C.storage_status(fresh)
            _show(status)
            return 0 if status.first()["status"] == STATUS_HEALTHY else 1
        elif args.latest:
            _show(serving.latest_model(spark, args.experiments))
        elif args.experiment and args.loss:
            _show(serving.loss_curve(spark, args.experiments, args.experiment))
        elif args.experiment:
            _show(serving.experiment(spark, args.experiments, args.experiment))
        else:
            _show(serving.experiments(spark, args.experiments))
    except KeyError as e:
        print(e.args[0], file=sys.stderr)
        return 1
    return 0


def _show(df) -> None:
    """Rows as JSON lines. The commands end in a few rows by their nature: tables,
    commits, columns, runs, or a limit."""
    for row in df.toJSON().toLocalIterator():
        print(row)


if __name__ == "__main__":
    sys.exit(main())
