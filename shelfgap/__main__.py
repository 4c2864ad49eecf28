"""``python -m shelfgap --config job.yml``, also through spark-submit."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from shelfgap.plans.config import RESULT_SECTION, load_config
from shelfgap.plans.jobs import ingest, run_all, run_recommendation
from shelfgap.plans.session import get_session
from shelfgap.specs import DATASETS


def main(argv: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="shelfgap")
    parser.add_argument("--config", required=True, help="path of the job file")
    parser.add_argument("--job", default="all", choices=["all", *DATASETS, "recommendation"])
    parser.add_argument("--preview", action="store_true", help="print some rows of each step")
    args = parser.parse_args(argv)
    config = load_config(args.config)
    spark = get_session(f"shelfgap-{args.job}")
    if args.job == "all":
        reports = run_all(spark, config, args.preview)
    elif args.job == RESULT_SECTION:
        if config.result is None:
            parser.error(f"the job file has no section {RESULT_SECTION!r}")
        report = run_recommendation(spark, config.result, config.options, args.preview)
        reports = {args.job: report}
    else:
        if args.job not in config.datasets:
            parser.error(f"the job file has no section {args.job!r}")
        paths = config.datasets[args.job]
        report = ingest(spark, DATASETS[args.job], paths, config.options, args.preview)
        reports = {args.job: report}
    for name, report in reports.items():
        print(f"{name}: {report}")


if __name__ == "__main__":
    main()
