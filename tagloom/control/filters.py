"""Which sources a build takes: include and exclude lists, overrides, manifests."""

from __future__ import annotations

import fnmatch
import hashlib
import json
import os


def parse_filter(text: str) -> tuple[set[str], list[str]]:
    """Exact names and patterns of a list; ``#`` starts a comment."""
    names, patterns = set(), []
    for line in text.splitlines():
        entry = line.split("#", 1)[0].strip()
        if entry:
            (patterns.append if any(c in entry for c in "*?[") else names.add)(entry)
    return names, patterns


def matches(source: str, rules: tuple[set[str], list[str]]) -> bool:
    names, patterns = rules
    return source in names or any(fnmatch.fnmatchcase(source, p) for p in patterns)


def included(source: str, include: tuple[set[str], list[str]] | None, exclude: tuple[set[str], list[str]] | None) -> bool:
    """Exclusion wins; an empty include list takes everything."""
    if exclude and matches(source, exclude):
        return False
    return not include or not (include[0] or include[1]) or matches(source, include)


def discover_sites(root: str) -> list[str]:
    """Site databases in the order that defines their rank."""
    return sorted(os.path.join(root, d, "tags.sqlite") for d in os.listdir(root) if os.path.exists(os.path.join(root, d, "tags.sqlite")))


def load_alias_overrides(path: str) -> list[tuple[str, str, str]]:
    """``(domain, alias, canonical)`` of a YAML file; entries that are no text or blank are skipped."""
    import yaml

    data = yaml.safe_load(open(path, encoding="utf-8")) or {}
    if not isinstance(data, dict):
        raise ValueError("overrides must be a mapping")
    out = []
    for domain, entries in (data.get("alias_resolution") or {}).items():
        if isinstance(entries, dict):
            out += [(str(domain), str(a), c.strip()) for a, c in entries.items() if isinstance(c, str) and c.strip()]
    return out


def file_hash(path: str | None) -> str:
    if not path or not os.path.exists(path):
        return "absent"
    return "sha256:" + hashlib.sha256(open(path, "rb").read()).hexdigest()


def write_manifest(path: str, sources: list[dict], build: dict) -> None:
    with open(path, "w", encoding="utf-8") as f:
        json.dump({"sources": sources, "build_info": build}, f, indent=2, sort_keys=True)


def compare_manifests(old: dict | None, new: dict) -> dict[str, list[str]]:
    """Source ids that were added, changed or removed."""
    was = {s["id"]: s.get("revision") for s in (old or {}).get("sources", [])}
    now = {s["id"]: s.get("revision") for s in new.get("sources", [])}
    return {"added": sorted(now.keys() - was.keys()), "changed": sorted(k for k in now.keys() & was.keys() if now[k] != was[k]), "removed": sorted(was.keys() - now.keys())}


def needs_rebuild(old: dict | None, new: dict, force: bool = False) -> bool:
    """Added or changed sources, another builder, base or override file; removed sources alone do not count."""
    if force or old is None:
        return True
    diff = compare_manifests(old, new)
    a, b = old.get("build_info", {}), new.get("build_info", {})
    return bool(diff["added"] or diff["changed"]) or any(a.get(k) != b.get(k) for k in ("builder_version", "base_revision", "override_hash"))
