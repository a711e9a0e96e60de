"""Command line: ``python -m wardlog monitor|train ...``."""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from wardlog.plans import pipeline
from wardlog.session import build_session
from wardlog.sources.readers import SOURCE_DATASETS


def parse(argv: list[str]) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="wardlog")
    commands = parser.add_subparsers(dest="command", required=True)
    watch = commands.add_parser("monitor", help="score logs and write alerts")
    watch.add_argument("--model", action="append", required=True, help="saved model; repeat in order of preference")
    watch.add_argument("--logs", help="log table written by the routed sink")
    watch.add_argument("--datasets", default=",".join(SOURCE_DATASETS))
    watch.add_argument("--hours", type=int, default=8760)
    watch.add_argument("--log-type", choices=("ssh", "web", "all"), default="ssh")
    watch.add_argument("--max-docs", type=int, default=0)
    watch.add_argument("--text", help="text log read when the table has nothing")
    watch.add_argument("--base-year", type=int, default=dt.date.today().year)
    watch.add_argument("--model-name", default="unified")
    watch.add_argument("--run-id", default="")
    watch.add_argument("--window-minutes", type=int, default=5)
    watch.add_argument("--out", required=True)
    learn = commands.add_parser("train", help="merge event tables and train a model")
    learn.add_argument("--source", action="append", required=True, metavar="NAME=CSV")
    learn.add_argument("--model", required=True)
    learn.add_argument("--metrics")
    learn.add_argument("--balance-mode", choices=("off", "moderate"), default="moderate")
    learn.add_argument("--target-attack-ratio", type=float, default=0.6)
    learn.add_argument("--no-handle-imbalance", action="store_true")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> int:
    args = parse(sys.argv[1:] if argv is None else argv)
    spark = build_session()
    if args.command == "train":
        pairs = (item.split("=", 1) for item in args.source)
        sources = {name: pipeline.ft.preprocess(pipeline.load_dataset(spark, path), "ssh") for name, path in pairs}
        result = pipeline.train_unified(
            spark, sources, args.model, args.metrics, args.balance_mode == "moderate", args.target_attack_ratio,
            not args.no_handle_imbalance)
        result.report.show()
        return 0
    now = dt.datetime.now(dt.timezone.utc)
    stored = {"table": args.logs, "requested": args.datasets, "hours": args.hours, "now": now,
              "mode": args.log_type, "max_docs": args.max_docs} if args.logs else None
    events = pipeline.collect(spark, stored, args.text, args.base_year)
    stamp = now.strftime("%Y%m%d_%H%M%S")
    result = pipeline.monitor(spark, events, pipeline.choose_model(spark, args.model), args.out, args.model_name,
                              args.run_id or stamp, stamp, args.window_minutes)
    result.summary.show()
    return 0


if __name__ == "__main__":
    sys.exit(main())
