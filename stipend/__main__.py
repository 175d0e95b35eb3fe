"""Run a job: spark-submit --py-files … stipend/__main__.py <job> …, or python -m stipend <job> …

    publish    --profile fijo --records <table folder> --out <folder>
    payout     --inputs <folder> --out <folder> [--as-of 2024-04-15] [--stage-out <folder>]
               [--infinite-growth]
    recode     --file <csv> [--out <folder>] [--null-text nan] [--multiline]
    snapshots  --folder <folder> --out <folder>
"""

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from stipend.plans import incentive, publish, recoding, snapshots
from stipend.sources.tables import replica


def _publish(spark, args):
    records = replica(spark, args.records, args.format)
    publish.publish_latest_batch(
        spark, records, publish.PROFILES[args.profile], args.out
    ).orderBy("batch_no").show(truncate=False)


def _payout(spark, args):
    as_of = F.lit(args.as_of).cast("date") if args.as_of else None
    incentive.run_payout(
        spark, args.inputs, args.out, as_of, args.stage_out, not args.infinite_growth)


def _recode(spark, args):
    print(recoding.recode_file(
        spark, args.file, args.out, null_text=args.null_text, multiline=args.multiline))


def _snapshots(spark, args):
    for family, path in snapshots.publish_newest(spark, args.folder, args.out).items():
        print(family, path)


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="stipend")
    jobs = parser.add_subparsers(required=True)

    job = jobs.add_parser("publish")
    job.set_defaults(run=_publish)
    job.add_argument("--profile", choices=publish.PROFILES, required=True)
    job.add_argument("--records", required=True)
    job.add_argument("--format", default="parquet")
    job.add_argument("--out", required=True)

    job = jobs.add_parser("payout")
    job.set_defaults(run=_payout)
    job.add_argument("--inputs", required=True)
    job.add_argument("--out", required=True)
    job.add_argument("--as-of")
    job.add_argument("--stage-out")
    job.add_argument("--infinite-growth", action="store_true", help="over prior sales of zero")

    job = jobs.add_parser("recode")
    job.add_argument("--multiline", action="store_true")
    job.set_defaults(run=_recode)
    job.add_argument("--file", required=True)
    job.add_argument("--out")
    job.add_argument("--null-text")

    job = jobs.add_parser("snapshots")
    job.set_defaults(run=_snapshots)
    job.add_argument("--folder", required=True)
    job.add_argument("--out", required=True)
    return parser


def main(arguments: list[str] | None = None) -> None:
    args = _parser().parse_args(arguments)
    args.run(SparkSession.builder.appName("stipend").getOrCreate(), args)


if __name__ == "__main__":
    main()
