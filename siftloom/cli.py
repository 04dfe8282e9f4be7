"""Commands over stored tables: ``python -m siftloom.cli COMMAND ...``.

Tables are Parquet folders. Exit codes: 0 all is well, 1 there are findings, 2 a
command that can't be understood, 3 a refusal.
"""

from __future__ import annotations

import argparse
import json
import sys
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import compare, fetch, links, migrate, schedule, shards, validate
from .runtime import prepare
from .sinks.publish import PublishError, Store, narrowed, serialized

#: Rows of a report that are shown; all of them are counted, and written with --out.
SHOWN = 50


def _shown(report: DataFrame, args: argparse.Namespace, sort: Sequence[str]) -> int:
    if args.out:
        report.write.mode("errorifexists").parquet(args.out)
        report = report.sparkSession.read.parquet(args.out)
    n = report.count()
    for r in report.orderBy(*sort).limit(SHOWN).collect():
        print(json.dumps(r.asDict(recursive=True), default=str, ensure_ascii=False, sort_keys=True))
    print(f"{n} rows", file=sys.stderr)
    return n


def preflight(spark: SparkSession, args: argparse.Namespace) -> int:
    """Result rows of the configured sources from stored probes."""
    rows = fetch.preflight_rows(spark.read.parquet(args.catalog), spark.read.parquet(args.probes), args.sources.split(",") if args.sources else None)
    _shown(rows, args, ["source_id"])
    return int(not rows.where("result <> 'ok'").isEmpty())


def validate_documents(spark: SparkSession, args: argparse.Namespace) -> int:
    """JSON documents against a schema."""
    with open(args.schema, encoding="utf-8") as f:
        schema = json.load(f)
    docs = spark.read.text(args.documents, wholetext=True, recursiveFileLookup=True).select(F.col("_metadata.file_name").alias("file"), "value")
    return int(_shown(validate.against_schema(docs, F.col("file"), F.col("value"), schema), args, ["subject", "path"]) > 0)


def compare_runs(spark: SparkSession, args: argparse.Namespace) -> int:
    """Whole documents (name, document) of two runs; exit 1 for violations only."""
    d = compare.document_differences(spark.read.parquet(args.left), spark.read.parquet(args.right), "name", "document", args.permitted, args.content)
    _shown(d, args, ["verdict", "name", "path"])
    return int(not d.where("verdict = 'violation'").isEmpty())


def diff(spark: SparkSession, args: argparse.Namespace) -> int:
    """States of published documents (name, sha256) of two places."""
    d = compare.publication_state(spark.read.parquet(args.left), spark.read.parquet(args.right), "name", "sha256")
    _shown(d, args, ["name"])
    return int(not d.where("state <> 'identical'").isEmpty())


def linkcheck(spark: SparkSession, args: argparse.Namespace) -> int:
    """Records with the stored checks of a sample of their links appended, as a new table."""
    records = spark.read.parquet(args.records)
    sample = schedule.link_sample(records, int(narrowed(25, args.sample, "a sample")))
    after = links.check_run(records, sample, spark.read.parquet(args.fetches), args.at)
    Store(spark, args.root).write_table(args.run, after)
    return 0


def migrate_cases(spark: SparkSession, args: argparse.Namespace) -> int:
    """A legacy registry into records and rejections; without --apply only the report."""
    cases = spark.read.parquet(args.registry)
    migrate.check_count(cases, args.expect_count)
    reviews = spark.read.parquet(args.reviews) if args.reviews else migrate.empty_reviews(spark)
    problems = validate.united(migrate.registry_problems(cases), migrate.review_problems(reviews, cases))
    if _shown(problems, args, ["subject", "path"]):
        return 3
    counts = migrate.summary(cases, reviews).first().asDict()
    print(serialized(counts).decode(), end="")
    if counts["unresolved_rejection_count"] and not args.allow_unmappable:
        return 1
    if args.apply:
        records, rejected = migrate.migrate(cases, reviews, spark.read.parquet(args.legacy_map), spark.read.parquet(args.support), args.topic, args.category)
        store = Store(spark, args.root)
        store.write_table(f"{args.run}/records", records, migrate.identity_problems(records))
        store.write_table(f"{args.run}/rejections", rejected)
        store.write_document(f"{args.run}/manifest.json", migrate.manifest(counts, f"{args.topic}__{args.category}", args.run, args.at))
    return 0


def assess(spark: SparkSession, args: argparse.Namespace) -> int:
    """Counts by value of a registry's columns, and identifiers that stand twice."""
    rows = spark.read.parquet(args.registry)
    for c in args.by.split(","):
        _shown(validate.counted(rows, c).withColumn("dimension", F.lit(c)), argparse.Namespace(out=None), ["value"])
    return int(_shown(shards.duplicate_groups(rows, args.key), args, ["place"]) > 0)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="siftloom", description=__doc__)
    sub = p.add_subparsers(dest="command", required=True)

    def command(name: str, f, *needed: str, **optional):
        c = sub.add_parser(name, help=f.__doc__.splitlines()[0])
        for n in needed:
            c.add_argument(f"--{n}", required=True)
        for n, default in {"out": None, **optional}.items():
            kind = {"action": "store_true"} if default is False else {"default": default, "type": type(default) if default is not None else str}
            c.add_argument(f"--{n.replace('_', '-')}", **kind)
        c.set_defaults(run_command=f)

    command("preflight-sources", preflight, "catalog", "probes", sources=None)
    command("validate", validate_documents, "documents", "schema")
    command("compare-runs", compare_runs, "left", "right", permitted=r"\.(generated_at|harvest_run_id|.*_at)$", content=r"\.(title|summary|.*_score)$")
    command("diff", diff, "left", "right")
    command("linkcheck", linkcheck, "records", "fetches", "root", "run", "at", sample=20)
    command("migrate-cases", migrate_cases, "registry", "root", "run", "at", expect_count=0, reviews=None, legacy_map=None, support=None, topic="cases", category="domain-applications", allow_unmappable=False, apply=False)
    command("assess", assess, "registry", "by", "key")
    return p


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> int:
    try:
        args = parser().parse_args(argv)
    except SystemExit as e:
        return int(e.code or 0)
    try:
        return args.run_command(prepare(spark or SparkSession.builder.getOrCreate()), args)
    except (PublishError, ValueError) as e:
        print(f"refused: {e}", file=sys.stderr)
        return 3


if __name__ == "__main__":
    sys.exit(main())
