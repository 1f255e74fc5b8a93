"""Command line: doctor, inspect-runtime, list-domains, validate-batch, profile-batch, run-pipeline, db-upgrade, db-current, export-reviews, import-decisions."""

from __future__ import annotations

import argparse
import importlib.util
import json
import sys
from pathlib import Path


def session(name: str = "convolens"):
    from pyspark.sql import SparkSession

    return SparkSession.builder.appName(name).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true").getOrCreate()


def doctor() -> dict:
    """Which libraries are there."""
    return {name: importlib.util.find_spec(name) is not None for name in ("pyspark", "pyarrow", "pandas", "numpy", "yaml")} | {"python": sys.version.split()[0]}


def inspect_runtime(spark) -> dict:
    """What a session runs on and with."""
    from . import providers
    from .tables import shared_dir

    context = spark.sparkContext
    keys = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled", "spark.sql.session.timeZone", "spark.sql.files.maxPartitionBytes", "spark.sql.autoBroadcastJoinThreshold")
    return {
        "spark": spark.version, "master": context.master, "parallelism": context.defaultParallelism, "shared_dir": shared_dir(spark), "conf": {k: spark.conf.get(k, None) for k in keys},
        "providers": {k: providers.names(k) for k in providers.KINDS}, **doctor(),
    }


def list_domains(folder: str) -> list[dict]:
    from .operators import ontology

    found = []
    for path in sorted(Path(folder).rglob("*.yaml")):
        o = ontology.load(str(path))
        found.append({"domain_id": o.get("domain_id"), "path": str(path), "entities": len(o["entities"]), "topics": len(o["topics"]), "errors": ontology.integrity_errors(o)})
    return found


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="convolens")
    sub = parser.add_subparsers(dest="command", required=True)
    sub.add_parser("doctor")
    sub.add_parser("inspect-runtime")
    for name in ("db-upgrade", "db-current"):
        sub.add_parser(name).add_argument("folder")
    for name in ("export-reviews", "import-decisions"):
        moved = sub.add_parser(name)
        moved.add_argument("folder")
        moved.add_argument("path")
    sub.add_parser("list-domains").add_argument("folder")
    for name in ("validate-batch", "profile-batch"):
        sub.add_parser(name).add_argument("input")
    run = sub.add_parser("run-pipeline")
    run.add_argument("input")
    run.add_argument("--ontology", required=True)
    run.add_argument("--overlay", action="append", default=[])
    run.add_argument("--out", required=True)
    run.add_argument("--weighting", choices=("raw", "dedup", "quality"))
    run.add_argument("--previous-topics")
    args = parser.parse_args(argv)
    if args.command == "doctor":
        print(json.dumps(doctor(), indent=2))
        return 0
    if args.command == "list-domains":
        print(json.dumps(list_domains(args.folder), indent=2))
        return 0
    from .operators import policy, validation
    from .plans import pipeline
    from .sources import records

    spark = session()
    if args.command == "inspect-runtime":
        print(json.dumps(inspect_runtime(spark), indent=2))
    elif args.command == "db-upgrade":
        print(json.dumps({"applied": policy.migrate(spark, args.folder), "version": policy.schema_version(spark, args.folder)}))
    elif args.command == "db-current":
        print(json.dumps({"version": policy.schema_version(spark, args.folder), "ready": policy.ready(spark, args.folder)}))
    elif args.command == "export-reviews":
        for name in ("items", "groups", "decisions"):
            if (table := policy.ReviewSession(spark, args.folder).table(name)) is not None:
                policy.export_reviews(table, f"{args.path.rstrip('/')}/{name}")
    elif args.command == "import-decisions":
        with policy.ReviewSession(spark, args.folder) as stored:
            known = stored.table("decisions")
            known = spark.createDataFrame([], policy.DECISIONS) if known is None else known
            stored.put("decisions", policy.import_decisions(spark, args.path, known))
    elif args.command == "validate-batch":
        rows = validation.validated(records.read_records(spark, args.input))
        print(json.dumps(validation.report(rows).first().asDict() | {"records_by_type": {r["value"]: r["count"] for r in validation.counts(rows, "uap_type", valid_only=True).collect()}}))
    elif args.command == "profile-batch":
        validation.field_profile(records.read_records(spark, args.input)).orderBy("field").show(200, truncate=60)
    else:
        settings = pipeline.Settings.from_environment()
        settings.weighting = args.weighting or settings.weighting
        print(json.dumps(pipeline.run(spark, args.input, args.ontology, args.out, settings, tuple(args.overlay), args.previous_topics), indent=2))
    return 0


if __name__ == "__main__":
    sys.exit(main())
