"""Which sources there are, what they did to a build, and where files are: plain Python over small files."""

from __future__ import annotations

import csv
import glob
import json
import os
import re
from typing import Protocol

from pyspark.sql import DataFrame

from tagloom.control.filters import parse_filter


class Source(Protocol):
    """What a source of tag rows can do: read its frame, tell whether it can be used, and mend known faults."""

    def read(self) -> DataFrame: ...

    def validate(self, df: DataFrame) -> bool: ...

    def repair(self, df: DataFrame) -> DataFrame: ...


class FileSource:
    """A CSV, JSON or Parquet file as a source; the ending decides. ``repair`` names a fault of ``files.REPAIRS``."""

    def __init__(self, spark, path: str, fault: str | None = None, overrides=None, report_folder: str | None = None):
        self.spark, self.path, self.fault, self.overrides, self.report_folder = spark, path, fault, overrides, report_folder

    def read(self) -> DataFrame:
        """The frame with a canonical ``source_tag``. A column whose kind cannot be told is reported and the source is skipped by an error."""
        from tagloom.plans.views import classify_column
        from tagloom.sources import files, sinks

        kind = os.path.splitext(self.path)[1].lower()
        reader = {".csv": files.read_csv, ".json": files.read_json, ".parquet": files.read_parquet}.get(kind)
        if reader is None:
            raise ValueError(f"no reader for {self.path}")
        df = reader(self.spark, self.path)
        try:
            return files.source_column(df, self.path, self.overrides, self.fault)
        except files.NormalizedSourceSkipError as e:
            if self.report_folder and e.decision == "unknown":
                sinks.write_unknown_column(classify_column(df, "tag").first().asDict(), self.path, "tag", self.report_folder, str(e))
            raise

    def validate(self, df: DataFrame) -> bool:
        from tagloom.sources.files import validate

        return validate(df)

    def repair(self, df: DataFrame) -> DataFrame:
        from tagloom.sources.files import REPAIRS

        return REPAIRS[self.fault](df) if self.fault else df


def load_sources(path: str) -> list[dict]:
    """The enabled entries of a YAML file with a list ``sources``; an entry is enabled unless it says otherwise."""
    import yaml

    with open(path, encoding="utf-8") as f:
        listed = (yaml.safe_load(f) or {}).get("sources") or []
    return [s for s in listed if s.get("enabled", True)]


def for_target(sources: list[dict], target: str) -> list[dict]:
    """The enabled sources that apply to a target."""
    return [s for s in sources if s.get("enabled", True) and target in (s.get("applies_to") or [])]


def matching_source(name: str, sources: list[dict]) -> dict | None:
    """The entry behind the name of a source in a report: by the folder below ``external_sources``, or by the id of its data set."""
    head, _, rest = name.partition("/")
    if head == "external_sources":
        return next((s for s in sources if s.get("id") == rest.partition("/")[0]), None)
    if name.startswith("hf://datasets/"):
        return next((s for s in sources if s.get("repo_id") == name[len("hf://datasets/") :]), None)
    return None


EFFECTS = ("source", "action", "rows_read", "db_changes", "note")


def read_effects(path: str) -> list[dict]:
    """Rows of a report of effects, with or without a header; short rows are passed over, a missing file has none."""
    if not os.path.exists(path):
        return []
    with open(path, encoding="utf-8", newline="") as f:
        rows = list(csv.reader(f, delimiter="\t"))
    names = list(EFFECTS)
    if rows and "source" in rows[0]:
        names, rows = rows[0], rows[1:]
    return [dict(zip(names, r)) for r in rows if len(r) >= len(EFFECTS)]


def whole(text: str | None) -> int | None:
    try:
        return int(text)
    except (TypeError, ValueError):
        return None


def effective(rows: list[dict], sources: list[dict]) -> list[tuple[dict, dict | None]]:
    """The sources that changed something, each with its entry."""
    return [(r, matching_source(r.get("source", ""), sources)) for r in rows if (whole(r.get("db_changes")) or 0) > 0]


def read_summary(path: str) -> dict[str, str]:
    """``metric`` and ``value`` of a health report; rows of another width are passed over, a missing file has none."""
    if not os.path.exists(path):
        return {}
    with open(path, encoding="utf-8", newline="") as f:
        rows = list(csv.reader(f, delimiter="\t"))
    return {r[0]: r[1] for r in rows[1:] if len(r) == 2}


def is_snapshot(path: str) -> bool:
    """Whether a file holds the whole counts of its format, to replace the ones before: ``danbooru_`` and six to eight digits."""
    return re.fullmatch(r"danbooru_\d{6,8}\.csv", os.path.basename(path).lower()) is not None


def latest(folder: str, pattern: str) -> str | None:
    """The file changed last among those of a pattern, at any depth."""
    return max(glob.glob(os.path.join(folder, "**", pattern), recursive=True), key=lambda p: (os.path.getmtime(p), p), default=None)


def join_filters(texts: list[str]) -> list[str]:
    """The entries of several include lists, each once, in the order they come."""
    return list(dict.fromkeys(line for text in texts for raw in text.splitlines() if (line := raw.split("#", 1)[0].strip()) and parse_filter(line) != (set(), [])))


def create_manifest(version: str, target: str, sources: list[dict], built_at: str, builder_version: str = "unknown", override_hash: str = "absent", **more) -> dict:
    """A build's manifest; ``base_db``, ``statistics`` and ``health_checks`` are taken in where they are given."""
    out = {"build_info": {"version": version, "target": target, "built_at": built_at, "builder_version": builder_version, "override_hash": override_hash}, "sources": sources}
    if more.get("base_db"):
        out["build_info"]["base_db"] = more["base_db"]
    return out | {k: more[k] for k in ("statistics", "health_checks") if more.get(k)}


def load_manifest(path: str) -> dict | None:
    if not os.path.exists(path):
        return None
    with open(path, encoding="utf-8") as f:
        return json.load(f)
