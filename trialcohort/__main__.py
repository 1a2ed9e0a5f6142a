"""The jobs from the command line: extract, requests, run."""

from __future__ import annotations

import argparse
import os

from trialcohort.plans import pipeline
from trialcohort.session import session
from trialcohort.sources.writers import write_csv


def main() -> None:
    parser = argparse.ArgumentParser(prog="trialcohort")
    jobs = parser.add_subparsers(dest="job", required=True)

    extract = jobs.add_parser("extract", help="copy the registry tables from its database to parquet")
    extract.add_argument("url", help="JDBC address; user and password come from REGISTRY_USER and REGISTRY_PASSWORD")
    extract.add_argument("out")
    extract.add_argument("--bounds", nargs="*", default=[], help="trial ids at which to cut the reading into tasks")
    extract.add_argument("--tasks", type=int, default=32, help="without bounds, ranges that the database is asked for")
    extract.add_argument("--driver", default="org.postgresql.Driver")

    for name, text in (("requests", "write label requests"), ("run", "build the table of trials")):
        job = jobs.add_parser(name, help=text)
        job.add_argument("inputs")
        job.add_argument("out")
        job.add_argument("--format", choices=["parquet", "csv"], default="parquet")
        if name == "requests":
            job.add_argument("--chunks", type=int, default=pipeline.REQUEST_CHUNKS)
            job.add_argument("--label-missing", action="store_true", help="ask for missing expressions as well")
        else:
            job.add_argument("--responses", help="folder of response lines, in place of the labels table")
            job.add_argument("--sample", type=int, help="flag a sample of this many trials only")
            job.add_argument("--seed", type=int, default=0)
            job.add_argument("--all-labels", action="store_true", help="fail if a label has no column")

    args = parser.parse_args()
    spark = session()
    if args.job == "extract":
        access = {
            "user": os.environ["REGISTRY_USER"],
            "password": os.environ["REGISTRY_PASSWORD"],
            "driver": args.driver,
        }
        pipeline.extract(spark, args.url, args.bounds, access, args.out, args.tasks)
    elif args.job == "requests":
        inputs = pipeline.read_inputs(spark, args.inputs, args.format)
        pipeline.write_label_requests(inputs, args.out, args.chunks, args.label_missing)
    else:
        inputs = pipeline.read_inputs(spark, args.inputs, args.format, args.responses)
        write_csv(pipeline.input_report(spark, args.inputs, args.format), f"{args.out}/bad_values")
        pipeline.run(inputs, args.out, args.sample, args.seed, args.all_labels)


if __name__ == "__main__":
    main()
