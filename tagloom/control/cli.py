"""``python -m tagloom.control.cli build --root DIR --out DIR``: the build as a command.

Reads the site databases under ROOT, on top of an earlier build if given, and
writes tables, the view, and reports under OUT, and the finished SQLite file if
one is named. Exit code 1 if no source loaded and there is no earlier build.
``health``, ``inversions`` and ``unicode`` write reports on the tables of a
build; ``migrate`` adds the columns of newer tables to those of an older one.
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tagloom.control.filters import load_alias_overrides, parse_filter
from tagloom.plans.pipeline import BASE, REPORTS, build
from tagloom.functions.text import unicode_escape
from tagloom.plans.views import alias_view, bad_unicode, format_statistics, health, health_details, prefix_inversions, status_conflict_details, status_conflicts
from tagloom.sources.master import formats, type_names
from tagloom.sources.files import read_translations
from tagloom.sources.sinks import write_database, write_metadata, write_report, write_tables, write_view
from tagloom.sources.sqlite import migrate_status, read_legacy, unify


def arguments() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tagloom")
    commands = p.add_subparsers(dest="command", required=True)
    b = commands.add_parser("build", help="merge site databases into tag tables")
    b.add_argument("--root", required=True, help="folder with one folder a site")
    b.add_argument("--out", required=True)
    b.add_argument("--base", help="folder of an earlier build to add to")
    b.add_argument("--include", help="file with names and patterns of sources to take")
    b.add_argument("--exclude", help="file with names and patterns of sources to leave out")
    b.add_argument("--alias-overrides", help="YAML file: domain, alias, canonical")
    b.add_argument("--translations", action="append", default=[], help="Parquet folder of a translation data set; may be repeated")
    b.add_argument("--sqlite", help="the finished database as one file")
    b.add_argument("--version", default="0", help="version that the finished database carries")
    for name, text in (("health", "totals, findings and their rows"), ("inversions", "aliases whose target carries a prefix they lack"), ("unicode", "tags with replacement characters")):
        r = commands.add_parser(name, help=text)
        r.add_argument("--tables", required=True, help="folder of a build's tables")
        r.add_argument("--out", required=True)
    m = commands.add_parser("migrate", help="the tables of an older SQLite database as tables of a build")
    m.add_argument("--database", required=True)
    m.add_argument("--out", required=True)
    return p


def run_build(spark: SparkSession, a: argparse.Namespace) -> int:
    rules = lambda path: parse_filter(open(path, encoding="utf-8").read()) if path else None
    overrides = None
    if a.alias_overrides:
        overrides = spark.createDataFrame(load_alias_overrides(a.alias_overrides), "domain string, alias string, canonical string")
    base = {n: spark.read.parquet(os.path.join(a.base, f"{n}.parquet")) for n in BASE} if a.base else None
    told = {f"hf://datasets/{p}": (lambda p=p: read_translations(spark, p)) for p in a.translations}
    tables = build(spark, a.root, base, rules(a.include), rules(a.exclude), overrides, told)
    write_report(tables.pop("skipped_sources"), os.path.join(a.out, "skipped_sources"), order=["source"])
    write_report(tables.pop("source_effects"), os.path.join(a.out, "source_effects"), order=["source", "action", "note"])
    if "tag_status" not in tables:
        return 1
    write_report(tables.pop("alias_conflicts"), os.path.join(a.out, "alias_conflicts"), order=["site", "alias", "rejected"])
    for name in REPORTS:
        report = tables.pop(name)
        write_report(report, os.path.join(a.out, name), order=report.columns)
    master = {"tag_formats": formats(spark), "tag_type_name": type_names(spark)}
    write_tables(tables | master, a.out)
    back = {n: spark.read.parquet(os.path.join(a.out, f"{n}.parquet")) for n in [*tables, *master]}
    status = back["tag_status"]
    view = alias_view(back["tags"], status, back["tag_usage_counts"], back["tag_translations"], back["tag_formats"], back["tag_type_format_mapping"])
    write_view(view, os.path.join(a.out, "view.parquet"))
    checks = health(back["tags"], status, back["tag_usage_counts"], back["tag_translations"], back["tag_type_format_mapping"], back["tag_formats"])
    statistics = format_statistics(status, back["tag_formats"])
    write_report(statistics, os.path.join(a.out, "format_statistics"), order=["format_id"])
    conflicts = status_conflict_details(status, back["tags"], back["tag_formats"])
    write_report(conflicts, os.path.join(a.out, "tag_status_conflicts"), order=["format_id", "tag_key", "tag_id"])
    write_report(status_conflicts(status, back["tags"]), os.path.join(a.out, "tag_status_conflicts_summary"), order=["format_id", "tag_key"])
    if a.sqlite:
        write_database({n.upper(): df for n, df in back.items()}, a.sqlite, a.version)
    write_metadata(checks, os.path.join(a.out, "health.json"), back, statistics, a.sqlite or a.out)
    return 0


def run_report(spark: SparkSession, a: argparse.Namespace) -> int:
    names = ("tags", "tag_status", "tag_usage_counts", "tag_translations", "tag_type_format_mapping", "tag_formats")
    t = {n: spark.read.parquet(os.path.join(a.tables, f"{n}.parquet")) for n in names}
    main_four = [t[n] for n in names[:4]]
    if a.command == "health":
        write_report(health(*main_four, t["tag_type_format_mapping"], t["tag_formats"]), os.path.join(a.out, "health_summary"), order=["metric"])
        write_report(health_details(*main_four, t["tag_type_format_mapping"]), os.path.join(a.out, "health_details"), order=["check", "tag_id", "format_id", "item"])
    elif a.command == "inversions":
        write_report(prefix_inversions(t["tag_status"], t["tags"]), os.path.join(a.out, "prefix_inversions"), order=["preferred_tag", "tag", "format_id"])
    else:
        found = bad_unicode(t["tags"], t["tag_status"], t["tag_usage_counts"]).withColumn("tag_escaped", unicode_escape(F.col("tag")))
        write_report(found, os.path.join(a.out, "bad_unicode"), order=[F.desc_nulls_last("count"), "tag_id", "format_id"])
    return 0


def run_migrate(spark: SparkSession, a: argparse.Namespace) -> int:
    tables = unify(read_legacy(spark, a.database))
    tables["tag_status"] = migrate_status(tables["tag_status"])
    write_tables(tables, a.out)
    return 0


def main(argv: list[str] | None = None) -> int:
    a = arguments().parse_args(argv)
    run = {"build": run_build, "migrate": run_migrate}.get(a.command, run_report)
    return run(SparkSession.builder.appName("tagloom").getOrCreate(), a)


if __name__ == "__main__":
    raise SystemExit(main())
