"""Command line: load every table from exported sheets and publish the summaries."""

from __future__ import annotations

import argparse

from peerline.plans.job import run_all
from peerline.session import build_session
from peerline.specs import SPECS


def main() -> None:
    parser = argparse.ArgumentParser(prog="peerline", description=__doc__)
    parser.add_argument("--source", required=True, help="folder with one subfolder of exported sheets per table")
    parser.add_argument("--target", required=True, help="folder for the CSV exports")
    parser.add_argument("--model-file", help="file that must exist in every sheet folder")
    parser.add_argument("--tables", nargs="*", choices=sorted(SPECS), help="only these tables")
    parser.add_argument("--replace", action="store_true", help="replace whole quarters instead of appending")
    args = parser.parse_args()

    specs = [SPECS[t] for t in args.tables] if args.tables else None
    spark = build_session()
    for report in run_all(spark, args.source, args.target, specs, model_file=args.model_file, replace=args.replace):
        print(f"{report.table}: {report.cleaned} cleaned, {report.fresh} fresh, {report.redundant} redundant")


if __name__ == "__main__":
    main()
