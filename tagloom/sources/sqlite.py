"""Site databases in SQLite as a Spark data source.

A table is read in row-id ranges, one task each, and only the columns asked for
leave the file. The row id comes along as ``row_id``, for the order of rows
decides between rival aliases. Files must be readable by every executor.
"""

from __future__ import annotations

import sqlite3
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tagloom.functions.text import blank_to_null, canonicalize_source_tag, clean_count, to_long
from tagloom.operators.register import SINKS
from tagloom.operators.repair import apply_remap, deduplicate_tags, remap_duplicates

ROWS_PER_TASK = 500_000


def quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def table_columns(path: str, table: str) -> dict[str, str]:
    """Column names and declared types; empty if there is no such table."""
    with sqlite3.connect(f"file:{path}?mode=ro", uri=True) as con:
        return {r[1]: (r[2] or "").upper() for r in con.execute(f"PRAGMA table_info({quoted(table)})")}


@dataclass
class RowRange(InputPartition):
    low: int
    high: int


class SqliteReader(DataSourceReader):
    def __init__(self, path: str, table: str, columns: list[str], rows: int):
        self.path, self.table, self.columns, self.rows = path, table, columns, rows

    def partitions(self) -> list[RowRange]:
        with sqlite3.connect(f"file:{self.path}?mode=ro", uri=True) as con:
            low, high = con.execute(f"SELECT min(rowid), max(rowid) FROM {quoted(self.table)}").fetchone()
        return [] if low is None else [RowRange(i, min(high, i + self.rows - 1)) for i in range(low, high + 1, self.rows)]

    def read(self, partition: RowRange) -> Iterator[tuple]:
        # whole numbers that are stored as floating ones keep their integer form
        whole = "CASE WHEN typeof({0}) = 'real' AND {0} = CAST({0} AS INTEGER) THEN CAST(CAST({0} AS INTEGER) AS TEXT) ELSE CAST({0} AS TEXT) END"
        names = ", ".join(whole.format(quoted(c)) for c in self.columns)
        con = sqlite3.connect(f"file:{self.path}?mode=ro", uri=True)
        try:
            yield from con.execute(f"SELECT rowid, {names} FROM {quoted(self.table)} WHERE rowid BETWEEN ? AND ? ORDER BY rowid", (partition.low, partition.high))
        finally:
            con.close()


class SqliteSource(DataSource):
    """Options: path, table, columns (comma-joined; all by default), rowsPerTask. All columns but row_id are text."""

    @classmethod
    def name(cls) -> str:
        return "tagloom_sqlite"

    def _columns(self) -> list[str]:
        named = self.options.get("columns")
        return named.split(",") if named else list(table_columns(self.options["path"], self.options["table"]))

    def schema(self) -> str:
        return ", ".join(["row_id long", *(f"`{c}` string" for c in self._columns())])

    def reader(self, schema) -> SqliteReader:
        return SqliteReader(self.options["path"], self.options["table"], self._columns(), int(self.options.get("rowsPerTask", ROWS_PER_TASK)))


def read_table(spark: SparkSession, path: str, table: str, columns: list[str] | None = None) -> DataFrame:
    spark.dataSource.register(SqliteSource)
    reader = spark.read.format("tagloom_sqlite").option("path", path).option("table", table)
    return (reader.option("columns", ",".join(columns)) if columns else reader).load()


@dataclass(frozen=True)
class Shape:
    """Which columns of a site's table hold what; None where it has none."""

    kind: str
    tag: str
    count: str | None = None
    type: str | None = None
    deprecated: str | None = None
    created: str | None = None
    updated: str | None = None
    translations: tuple[tuple[str, str], ...] = ()


# Type names of one site as its type ids.
NAMED_TYPES = {"general": 0, "artist": 1, "copyright": 3, "character": 4, "metadata": 5, "deprecated": 6}


def detect_shape(columns: dict[str, str]) -> Shape:
    """The first of the known shapes whose columns are all there."""
    has = lambda *names: set(names) <= set(columns)
    some = lambda name: name if name in columns else None
    if has("name", "post_count", "pool_count", "series_count", "type") and (trans := [c for c in columns if c.startswith("trans_")]):
        return Shape("pools", "name", "post_count", "type", translations=tuple((c, c[6:].strip()) for c in trans))
    if has("name", "post_count", "category"):
        stamps = {"created": some("created_at"), "updated": some("updated_at")}
        return Shape("categories_deprecated", "name", "post_count", "category", "is_deprecated", **stamps) if has("is_deprecated") else Shape("categories", "name", "post_count", "category", **stamps)
    if has("tag", "num", "type", "alias"):
        return Shape("pointers", "tag", "num", "type", translations=tuple((c, lang) for c, lang in (("tag_jp", "ja"), ("tag_ru", "ru")) if c in columns))
    if has("name", "posts", "updated_at", "wiki_url"):
        return Shape("posts", "name", "posts", updated="updated_at", translations=(("trans_ja", "ja"),) if "trans_ja" in columns else ())
    if has("name", "posts", "category_id", "category_name"):
        return Shape("walls", "name", "posts")
    if has("tag", "type", "total"):
        return Shape("totals", "tag", "total")
    if has("name", "count", "type"):
        kind = columns["type"]
        return Shape("named_types" if kind == "TEXT" else "integer_types" if kind.startswith("INT") else "other_types", "name", "count", "type")
    if has("name", "post_count", "tag_type"):
        return Shape("tag_types", "name", "post_count", "tag_type")
    raise ValueError(f"unknown table shape: {sorted(columns)}")


def alias_pairs(spark: SparkSession, path: str, shape: Shape) -> DataFrame:
    """``alias, tag, ord`` of a site, from its alias table or from the pointers in its tags; may be empty."""
    if {"alias", "tag"} <= set(table_columns(path, "tag_aliases")):
        return read_table(spark, path, "tag_aliases", ["alias", "tag"]).where("alias is not null and tag is not null").select("alias", "tag", F.col("row_id").alias("ord"))
    if shape.kind == "pointers" and "id" in table_columns(path, "tags"):
        rows = read_table(spark, path, "tags", ["id", "tag", "alias"])
        return rows.where("alias is not null").alias("a").join(rows.alias("t"), F.col("a.alias") == F.col("t.id")).select(F.col("a.tag").alias("alias"), F.col("t.tag").alias("tag"), F.col("a.row_id").alias("ord"))
    return spark.createDataFrame([], "alias string, tag string, ord long")


def _type_id(shape: Shape) -> Column:
    if shape.type is None:
        return F.lit(-1).cast("long")
    if shape.kind == "named_types":
        table = F.create_map(*(x for k, v in NAMED_TYPES.items() for x in (F.lit(k), F.lit(v))))
        return F.coalesce(F.try_element_at(table, F.col(shape.type)), F.lit(-1)).cast("long")
    return F.coalesce(to_long(F.col(shape.type)), F.lit(-1))


def read_site(spark: SparkSession, path: str, format_id: int, overrides: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """A site's rows and its alias conflicts.

    Rows: ``ord, source_tag, format_id, type_id, count, aliases (array),
    deprecated, source_created_at, source_updated_at`` and one column a
    language. A tag that is another's alias has no row of its own unless its
    target is a sink; aliases of sinks come last as deprecated rows. Of several
    targets the first seen wins, or the one an override (``alias, canonical``)
    names. Aliases are not followed further.
    """
    columns = table_columns(path, "tags")
    shape = detect_shape(columns)
    wanted = [c for c in (shape.tag, shape.count, shape.type, shape.deprecated, shape.created, shape.updated, *(c for c, _ in shape.translations)) if c]
    rows = read_table(spark, path, "tags", list(dict.fromkeys(wanted))).where(F.col(shape.tag).isNotNull())
    pairs = alias_pairs(spark, path, shape).groupBy("alias", "tag").agg(F.min("ord").alias("first"))
    chosen = pairs.groupBy("alias").agg(F.min_by("tag", F.struct("first", "tag")).alias("tag"), F.count("*").alias("n"))
    if overrides is not None:
        chosen = chosen.join(overrides.select("alias", "canonical"), "alias", "left").withColumn("reason", F.when(F.col("canonical").isNotNull(), "override").otherwise("first-win")).withColumn("tag", F.coalesce("canonical", "tag")).drop("canonical")
    else:
        chosen = chosen.withColumn("reason", F.lit("first-win"))
    conflicts = pairs.join(chosen.where("n > 1 or reason = 'override'").select("alias", F.col("tag").alias("selected"), "reason"), "alias").where("tag <> selected").select("alias", "selected", F.col("tag").alias("rejected"), "reason")
    sink = F.col("tag").isin(*SINKS)
    named = shape.kind == "named_types"
    flag = F.lit(False) if not shape.deprecated else F.coalesce(to_long(F.col(shape.deprecated)) != 0, F.lower(F.col(shape.deprecated)).isin("true", "t", "yes"), F.lit(False))
    if named:
        flag = flag | F.coalesce(F.lower(F.col(shape.type)) == "deprecated", F.lit(False))
    base = rows.select(
        F.col("row_id").alias("ord"),
        F.col(shape.tag).alias("source_tag"),
        F.lit(format_id).cast("long").alias("format_id"),
        _type_id(shape).alias("type_id"),
        (clean_count(F.col(shape.count)) if shape.count else F.lit(None).cast("long")).alias("count"),
        flag.cast("int").alias("deprecated"),
        (blank_to_null(F.col(shape.created)) if shape.created else F.lit(None).cast("string")).alias("source_created_at"),
        (blank_to_null(F.col(shape.updated)) if shape.updated else F.lit(None).cast("string")).alias("source_updated_at"),
        *(F.col(f"`{c}`").alias(lang) for c, lang in shape.translations),
    )
    base = base.join(chosen.where(~sink).select(F.col("alias").alias("source_tag")), "source_tag", "left_anti")
    lists = chosen.where(~sink & (F.col("alias") != F.col("tag"))).groupBy(F.col("tag").alias("source_tag")).agg(F.array_sort(F.collect_set("alias")).alias("aliases"))
    full = base.join(lists, "source_tag", "left").withColumn("aliases", F.coalesce("aliases", F.array().cast("array<string>")))
    lost = chosen.where(sink).select(
        F.lit(1 << 62).alias("ord"), F.col("alias").alias("source_tag"), F.lit(format_id).cast("long").alias("format_id"), F.lit(6 if format_id == 2 else -1).cast("long").alias("type_id"),
        F.lit(None).cast("long").alias("count"), F.lit(1).alias("deprecated"), F.array().cast("array<string>").alias("aliases"),
    )
    return full.unionByName(lost, allowMissingColumns=True), conflicts


#: Columns of the tables of an older database, beside their keys and dates. Dates stay text.
LEGACY = {
    "tags": ("TAGS", "tag_id long, tag string, source_tag string, created_at string, updated_at string"),
    "tag_status": ("TAG_STATUS", "tag_id long, format_id long, type_id long, alias int, preferred_tag_id long, created_at string, updated_at string"),
    "tag_translations": ("TAG_TRANSLATIONS", "translation_id long, tag_id long, language string, translation string, created_at string, updated_at string"),
    "tag_usage_counts": ("TAG_USAGE_COUNTS", "tag_id long, format_id long, count long, created_at string, updated_at string"),
}
#: Columns that newer status tables have, with what older rows get.
ADDED_STATUS = {"deprecated": ("int", 0), "deprecated_at": ("string", None), "source_created_at": ("string", None)}


def read_legacy(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The four tables of an older database, typed, source forms canonical. A missing table is an error."""
    out = {}
    for name, (table, schema) in LEGACY.items():
        fields = [f.split() for f in schema.split(", ")]
        if not set(n for n, _ in fields) <= set(table_columns(path, table)):
            raise ValueError(f"{path}: {table} lacks columns of {schema}")
        rows = read_table(spark, path, table, [n for n, _ in fields])
        out[name] = rows.select(*(F.col(n).try_cast(kind).alias(n) for n, kind in fields))
    out["tags"] = out["tags"].withColumn("source_tag", canonicalize_source_tag(F.col("source_tag")))
    return out


def unify(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Tables of which each tag has one id, the smallest: references follow, and the other tags rows go."""
    remap = remap_duplicates(tables["tags"])
    refers = {"tag_status": ["tag_id", "preferred_tag_id"], "tag_translations": ["tag_id"], "tag_usage_counts": ["tag_id"]}
    return {"tags": deduplicate_tags(tables["tags"])} | {n: apply_remap(tables[n], remap, columns) for n, columns in refers.items()}


def migrate_status(status: DataFrame) -> DataFrame:
    """A status table with the columns of newer ones; columns that are there stay as they are."""
    return status.select("*", *(F.lit(value).cast(kind).alias(c) for c, (kind, value) in ADDED_STATUS.items() if c not in status.columns))


def probe_site(path: str) -> dict[str, str | bool | None]:
    """What a site's database holds: the column of names (``name`` or ``tag``), and whether there is an alias table."""
    columns = table_columns(path, "tags")
    return {"name_column": next((c for c in ("name", "tag") if c in columns), None), "has_aliases": {"alias", "tag"} <= set(table_columns(path, "tag_aliases"))}


# Site folders and their formats.
SITE_FORMATS = {
    "anime-pictures.net": 14, "booru.allthefallen.moe": 5, "chan.sankakucomplex.com": 6, "danbooru.donmai.us": 1, "e621.net": 2, "en.pixiv.net": 18, "gelbooru.com": 7, "hypnohub.net": 10, "konachan.com": 11, "konachan.net": 12,
    "lolibooru.moe": 13, "pixiv.net": 18, "rule34.xxx": 8, "safebooru.donmai.us": 4, "wallhaven.cc": 15, "xbooru.com": 9, "yande.re": 16, "zerochan.net": 17,
}


def site_format(folder: str) -> int:
    """The format of a site's folder, 0 where it is unknown."""
    return SITE_FORMATS.get(folder, 0)


def format_site(format_id: int) -> str | None:
    """The first site folder of a format, None where it has none."""
    return next((site for site, f in SITE_FORMATS.items() if f == format_id), None)
