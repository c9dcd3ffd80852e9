"""Writers: tables, sharded views, reports, and SQLite for the finished database with its keys, indexes and version."""

from __future__ import annotations

import csv
import datetime as dt
import json
import os
import sqlite3

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_tables(frames: dict[str, DataFrame], folder: str) -> None:
    """One Parquet folder a table."""
    for name, df in frames.items():
        df.write.mode("overwrite").option("compression", "zstd").parquet(f"{folder}/{name}.parquet")


def write_view(view: DataFrame, path: str, key: str = "tag_id", rows_per_file: int = 50_000) -> None:
    """A view in files of bounded size, ranged and sorted by its key, so that readers can skip by the key's bounds."""
    view.repartitionByRange(key).sortWithinPartitions(key).write.mode("overwrite").option("compression", "zstd").option("maxRecordsPerFile", rows_per_file).parquet(path)


def write_view_shards(view: DataFrame, path: str, key: str = "tag_id", ids_per_shard: int = 50_000) -> None:
    """A view in one folder ``shard=n`` for each range of so many ids, sorted by its key within."""
    shard = F.floor(F.col(key) / ids_per_shard).cast("long")
    view.withColumn("shard", shard).repartition("shard").sortWithinPartitions("shard", key).write.mode("overwrite").option("compression", "zstd").partitionBy("shard").parquet(path)


def read_view_range(spark: SparkSession, path: str, low: int, high: int, key: str = "tag_id", ids_per_shard: int = 50_000) -> DataFrame:
    """The rows of a sharded view with keys from ``low`` to ``high``; other shards are not read."""
    return spark.read.parquet(path).where(F.col("shard").between(low // ids_per_shard, high // ids_per_shard) & F.col(key).between(low, high)).drop("shard")


def write_report(df: DataFrame, path: str, separator: str = "\t", order: list | None = None) -> None:
    """A report in parts, written by the executors; in order of the columns given, part after part."""
    df = df.orderBy(*order) if order else df
    df.write.mode("overwrite").option("sep", separator).option("header", True).csv(path)


def write_small_report(df: DataFrame, path: str, max_rows: int = 100_000, separator: str = "\t") -> str | None:
    """A report as one file; None without rows, an error past ``max_rows``: write such a report in parts."""
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"more than {max_rows} rows")
    if not rows:
        return None
    with open(path, "w", encoding="utf-8", newline="") as f:
        out = csv.writer(f, delimiter=separator)
        out.writerow(df.columns)
        for r in rows:
            out.writerow(["" if v is None else str(v).replace("\t", " ").replace("\r", " ").replace("\n", " ") for v in r])
    return path


def export_conflicts(conflicts: DataFrame, folder: str, max_rows: int = 100_000) -> dict[str, str | None]:
    """The rows of ``detect_conflicts`` as two CSV files, ``type_id_conflicts`` and ``alias_changes``; None for a kind without rows."""
    os.makedirs(folder, exist_ok=True)
    out: dict[str, str | None] = {}
    for kind, name in (("type_id", "type_id_conflicts"), ("alias", "alias_changes")):
        rows = conflicts.where(F.col("kind") == kind).drop("kind").orderBy("tag", "format_id", "old_value", "new_value")
        out[name] = write_small_report(rows, os.path.join(folder, f"{name}.csv"), max_rows, ",")
    return out


#: Columns of the report on a column whose kind cannot be told.
UNKNOWN_COLUMN = ("source_file", "column_name", "decision", "confidence", "underscore_ratio", "escaped_paren_ratio", "normalize_change_ratio", "notes")


def write_unknown_column(signals: dict, source: str, column: str, folder: str, notes: str = "") -> str:
    """One row of signals of ``classify_column`` for a person to decide by; tabs and line breaks become blanks."""
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, f"{os.path.splitext(os.path.basename(source))[0]}__unknown_{column}.tsv")
    row = [source, column, *(signals.get(k, "") for k in ("decision", "confidence", "underscore", "escaped_paren", "normalize_change")), notes]
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.writelines("\t".join(" ".join(("" if v is None else str(v)).replace("\t", " ").splitlines()) for v in line) + "\n" for line in (UNKNOWN_COLUMN, row))
    return path


# Tables of the finished database with their columns and keys, and its indexes.
_STAMPS = "created_at DATETIME DEFAULT CURRENT_TIMESTAMP, updated_at DATETIME DEFAULT CURRENT_TIMESTAMP"
SQLITE_TABLES = {
    "TAG_FORMATS": "format_id INTEGER NOT NULL PRIMARY KEY, format_name TEXT NOT NULL UNIQUE, description TEXT",
    "TAG_TYPE_NAME": "type_name_id INTEGER NOT NULL PRIMARY KEY, type_name TEXT NOT NULL UNIQUE, description TEXT",
    "TAG_TYPE_FORMAT_MAPPING": "format_id INTEGER NOT NULL REFERENCES TAG_FORMATS, type_id INTEGER NOT NULL, type_name_id INTEGER NOT NULL REFERENCES TAG_TYPE_NAME, description TEXT, PRIMARY KEY (format_id, type_id)",
    "TAGS": f"tag_id INTEGER NOT NULL PRIMARY KEY, source_tag TEXT NOT NULL, tag TEXT NOT NULL UNIQUE, {_STAMPS}",
    "TAG_STATUS": "tag_id INTEGER NOT NULL REFERENCES TAGS, format_id INTEGER NOT NULL REFERENCES TAG_FORMATS, type_id INTEGER NOT NULL, alias BOOLEAN NOT NULL, preferred_tag_id INTEGER NOT NULL REFERENCES TAGS (tag_id),"
    f" deprecated BOOLEAN NOT NULL DEFAULT 0, deprecated_at DATETIME, source_created_at DATETIME, {_STAMPS}, PRIMARY KEY (tag_id, format_id),"
    " FOREIGN KEY (format_id, type_id) REFERENCES TAG_TYPE_FORMAT_MAPPING, CHECK (alias = (preferred_tag_id <> tag_id))",
    "TAG_TRANSLATIONS": f"translation_id INTEGER NOT NULL PRIMARY KEY, tag_id INTEGER NOT NULL REFERENCES TAGS, language TEXT, translation TEXT, {_STAMPS}, UNIQUE (tag_id, language, translation)",
    "TAG_USAGE_COUNTS": f"tag_id INTEGER NOT NULL REFERENCES TAGS, format_id INTEGER NOT NULL REFERENCES TAG_FORMATS, count INTEGER NOT NULL, {_STAMPS}, PRIMARY KEY (tag_id, format_id)",
    "DATABASE_METADATA": "key TEXT NOT NULL PRIMARY KEY, value TEXT NOT NULL",
}
SQLITE_INDEXES = {
    "idx_tags_tag": "TAGS (tag)", "idx_tags_source_tag": "TAGS (source_tag)", "idx_tag_status_format": "TAG_STATUS (format_id)", "idx_tag_status_type": "TAG_STATUS (type_id)",
    "idx_tag_status_preferred": "TAG_STATUS (preferred_tag_id)", "idx_translations_tag_lang": "TAG_TRANSLATIONS (tag_id, language)", "idx_translations_text": "TAG_TRANSLATIONS (translation)", "idx_usage_counts_count": "TAG_USAGE_COUNTS (count DESC)",
}
#: Settings of a connection, by what it is for.
PROFILES = {
    "build": {"journal_mode": "OFF", "synchronous": "OFF", "cache_size": -128_000, "temp_store": "MEMORY"},
    "distribution": {"journal_mode": "WAL", "synchronous": "NORMAL", "cache_size": -64_000, "mmap_size": 256 << 20, "temp_store": "MEMORY"},
}


def apply_profile(con: sqlite3.Connection, profile: str) -> None:
    if profile not in PROFILES:
        raise ValueError(f"unknown profile: {profile}")
    for name, value in PROFILES[profile].items():
        con.execute(f"PRAGMA {name} = {value}").fetchall()


def create_database(path: str) -> bool:
    """An empty database with all tables; one that exists stays as it is, and False comes back."""
    if os.path.exists(path):
        return False
    os.makedirs(os.path.dirname(os.path.abspath(path)), exist_ok=True)
    con = sqlite3.connect(path)
    try:
        con.execute("PRAGMA page_size = 4096")
        con.execute("PRAGMA auto_vacuum = INCREMENTAL")
        for name, columns in SQLITE_TABLES.items():
            con.execute(f"CREATE TABLE {name} ({columns})")
        con.commit()
    finally:
        con.close()
    return True


def set_version(path: str, version: str) -> None:
    """The version of the database, in place of the one before."""
    con = sqlite3.connect(path)
    try:
        con.execute("INSERT OR REPLACE INTO DATABASE_METADATA VALUES ('version', ?)", (version,))
        con.commit()
    finally:
        con.close()


def finish_database(path: str) -> None:
    """Indexes, compaction and statistics of a database that is loaded, and the settings it is given away with."""
    con = sqlite3.connect(path)
    try:
        there = {r[0] for r in con.execute("SELECT name FROM sqlite_master WHERE type = 'table'")}
        for name, on in SQLITE_INDEXES.items():
            if on.partition(" ")[0] in there:
                con.execute(f"CREATE INDEX IF NOT EXISTS {name} ON {on}")
        con.commit()
        con.execute("VACUUM")
        con.execute("ANALYZE")
        apply_profile(con, "distribution")
    finally:
        con.close()


def write_database(frames: dict[str, DataFrame], path: str, version: str) -> None:
    """The finished database: tables with keys, rows (``frames`` by table name), indexes and version. Columns that a table lacks are left out."""
    create_database(path)
    known = {n: [part.split()[0] for part in _parts(c)] for n, c in SQLITE_TABLES.items()}
    write_sqlite({n: frames[n].select(*(c for c in frames[n].columns if c in known[n])) for n in SQLITE_TABLES if n in frames}, path)
    set_version(path, version)
    finish_database(path)


def _parts(columns: str) -> list[str]:
    """A table's columns and constraints, cut at the commas outside brackets."""
    out, depth = [""], 0
    for c in columns:
        depth += (c == "(") - (c == ")")
        out = [*out, ""] if c == "," and not depth else [*out[:-1], out[-1] + c]
    return out


def write_sqlite(frames: dict[str, DataFrame], path: str, batch: int = 10_000) -> None:
    """Tables as one SQLite file, streamed partition by partition through the driver; tables that exist are added to."""
    con = sqlite3.connect(path)
    try:
        for name, df in frames.items():
            con.execute(f'CREATE TABLE IF NOT EXISTS "{name}" ({", ".join(f"{chr(34)}{c}{chr(34)}" for c in df.columns)})')
            put, held = f'INSERT INTO "{name}" ({", ".join(f"{chr(34)}{c}{chr(34)}" for c in df.columns)}) VALUES ({", ".join("?" * len(df.columns))})', []
            for r in df.select(*(F.col(c).cast("string") if t in ("timestamp", "timestamp_ntz") else F.col(c) for c, t in df.dtypes)).toLocalIterator():
                held.append(tuple(r))
                if len(held) == batch:
                    con.executemany(put, held)
                    held = []
            con.executemany(put, held)
        con.commit()
        con.execute("ANALYZE")
    finally:
        con.close()


def megabytes(size: int) -> float:
    return round(size / (1 << 20), 2)


def utc_now() -> str:
    return dt.datetime.now(dt.timezone.utc).isoformat()


def folder_size(path: str) -> int:
    """Bytes of a file or of all files in a folder of the local file system."""
    return os.path.getsize(path) if os.path.isfile(path) else sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(path) for f in files)


def write_metadata(totals: DataFrame, path: str, tables: dict[str, DataFrame] | None = None, statistics: DataFrame | None = None, artefact: str | None = None) -> dict:
    """``metric, value`` rows as a JSON object, with the schema of tables, distinct tags of each format and the size of an artefact if given."""
    out = {r["metric"]: r["value"] for r in totals.collect()}  # one row a metric
    out["generated_at"] = utc_now()
    if tables:
        out["schema"] = {n: [{"name": c, "type": t} for c, t in df.dtypes] for n, df in tables.items()}
    if statistics is not None:
        out["tags_of_format"] = {r["format_name"]: r["n_tags"] for r in statistics.collect()}  # one row a format
    if artefact and os.path.exists(artefact):
        out["size_mb"] = megabytes(folder_size(artefact))
    os.makedirs(os.path.dirname(os.path.abspath(path)), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        json.dump(out, f, indent=2, sort_keys=True)
    return out
