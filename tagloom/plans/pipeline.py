"""The whole build: site databases in, tag tables out."""

from __future__ import annotations

import os
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tagloom.control.filters import discover_sites, included
from tagloom.functions.text import canonicalize_source_tag, has_name, normalize_tag
from tagloom.operators.clean import SCRIPTS, script_filter, split_values, wrong_script
from tagloom.operators.ids import dense_ids, next_id
from tagloom.operators.merge import greatest_wins, insert_or_ignore, last_wins
from tagloom.operators.register import tag_index
from tagloom.operators.repair import map_missing, rename_to_base, replace_placeholders, turn_to_base
from tagloom.sources.files import translation_pairs, unpivot_translations
from tagloom.sources.master import mappings, seed
from tagloom.sources.sqlite import read_site, site_format
from tagloom.tables import Scratch

FIXED = ("ord", "source_tag", "format_id", "type_id", "count", "aliases", "deprecated", "source_created_at", "source_updated_at")
TAGS = "tag_id long, source_tag string, tag string"
STATUS = "tag_id long, format_id long, type_id long, alias int, preferred_tag_id long, deprecated int, source_created_at string"
STAMPED_STATUS = f"{STATUS}, deprecated_at string, created_at timestamp, updated_at timestamp"
ATTRIBUTES = ["type_id", "alias", "preferred_tag_id", "deprecated", "deprecated_at", "source_created_at"]
USAGE = "tag_id long, format_id long, count long, source_created_at string, source_updated_at string"
TRANSLATIONS = "translation_id long, tag_id long, language string, translation string, created_at timestamp, updated_at timestamp"
NO_ROWS = "src int, ord long, source_tag string, format_id long, type_id long, count long, aliases array<string>, deprecated int, source_created_at string, source_updated_at string"
NO_CONFLICTS = "alias string, selected string, rejected string, reason string, site string"
MAPPING = "format_id long, type_id long, type_name_id long, description string"
#: What the four repairs did, in their order.
REPORTS = ("missing_type_format_mapping_repairs", "non_e621_prefix_repairs", "prefix_tag_renames", "placeholder_repairs")
#: The tables that a build adds to.
BASE = {"tags": TAGS, "tag_status": STAMPED_STATUS, "tag_usage_counts": USAGE, "tag_translations": TRANSLATIONS, "tag_type_format_mapping": MAPPING}


def in_schema(spark: SparkSession, df: DataFrame | None, schema: str) -> DataFrame:
    """The columns of ``schema``, null where the table lacks one; an empty table for none."""
    empty = spark.createDataFrame([], schema)
    if df is None:
        return empty
    return df.select(*((F.col(c) if c in df.columns else F.lit(None)).cast(kind).alias(c) for c, kind in empty.dtypes))


EFFECTS = "source string, action string, rows_read long, db_changes long, note string"


def changes_by_source(status: DataFrame, usage: DataFrame, order: list[str]) -> DataFrame:
    """``src, changes``: how many rows of each source changed what the rows before them had left, first rows included.

    ``status`` and ``usage`` hold all rows with their ``src`` and order. A key is
    a (tag, format), which few sources show and each few times.
    """
    attributes = F.struct(*ATTRIBUTES)
    before = Window.partitionBy("tag_id", "format_id").orderBy(*order)
    changed = status.withColumn("_a", attributes).withColumn("_was", F.lag("_a").over(before)).where(F.col("_was").isNull() | ~F.col("_a").eqNullSafe(F.col("_was")))
    earlier = Window.partitionBy("tag_id", "format_id").orderBy("src", "ord").rowsBetween(Window.unboundedPreceding, -1)
    raised = usage.where("count is not null").withColumn("_top", F.max("count").over(earlier)).where("_top is null or count > _top")
    return changed.select("src").unionByName(raised.select("src")).groupBy("src").agg(F.count("*").alias("changes"))


def with_stamps(status: DataFrame, before: DataFrame) -> DataFrame:
    """Rows that were there keep ``created_at``, and ``updated_at`` unless an attribute changed; the others are of now."""
    key, now = ["tag_id", "format_id"], F.current_timestamp()
    old = before.groupBy(*key).agg(F.max(F.struct("updated_at", "created_at", *ATTRIBUTES)).alias("_was"))
    same = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"_was.{c}")) for c in ATTRIBUTES))
    there = F.col("_was").isNotNull()
    created, updated = F.when(there, F.col("_was.created_at")).otherwise(now), F.when(there & same, F.col("_was.updated_at")).otherwise(now)
    return status.join(old, key, "left").select(*status.columns, created.alias("created_at"), updated.alias("updated_at"))


def build(
    spark: SparkSession, root: str, base: dict[str, DataFrame] | None = None, include=None, exclude=None, overrides: DataFrame | None = None, translations_of: dict[str, Callable[[], DataFrame]] | None = None
) -> dict[str, DataFrame]:
    """Tag tables of all site databases under a folder, on top of ``base`` tables if given.

    ``base`` holds the tables of an earlier build; its status, counts and
    translations are the first source, and its ids stay. Without any site the
    result is the base, cleaned. ``translations_of`` maps the names of translation
    data sets to their readers; they come before the sites and tell of tags that
    the base has. One that cannot be read is skipped and reported.

    Pass one registers every name of every site, pass two composes status,
    counts and translations against the full index. The order of sites, rows
    and aliases is an explicit column, and each table is one aggregation.
    Returns tags, tag_status, tag_usage_counts, tag_translations,
    tag_type_format_mapping, alias_conflicts, skipped_sources, source_effects
    (what each source and step read and changed) and the ``REPORTS`` of the
    repairs that end the build.
    """
    scratch = Scratch(spark)
    rows, told, conflicts, skipped, names_of, effects = [], [], [], [], {}, []
    for rank, path in enumerate(discover_sites(root)):
        site = os.path.basename(os.path.dirname(path))
        format_id = site_format(site)
        reason = "filtered" if not included(f"{site}/tags.sqlite", include, exclude) else "unknown_site_format" if not format_id else None
        if reason is None:
            try:
                own = overrides.where(F.col("domain") == site) if overrides is not None else None
                frame, rivals = read_site(spark, path, format_id, own)
            except ValueError as e:
                reason = f"read_failed: {e}"
        if reason:
            skipped.append((site, reason))
            continue
        languages = [c for c in frame.columns if c not in FIXED]
        names_of[rank] = f"external_sources/site_tags/{site}/tags.sqlite"
        rows.append(frame.select(F.lit(rank).alias("src"), *FIXED))
        if languages:
            told.append(unpivot_translations(frame, languages).withColumn("src", F.lit(rank)))
        conflicts.append(rivals.withColumn("site", F.lit(site)))
    skipped_frame = spark.createDataFrame(skipped, "source string, reason string")
    held = {name: scratch.put(in_schema(spark, (base or {}).get(name), schema)) for name, schema in BASE.items()}
    tags = held["tags"]
    if not rows and base is None:
        return {"tags": tags, "skipped_sources": skipped_frame, "source_effects": spark.createDataFrame([], EFFECTS)}
    if base is not None:
        effects.append(("base", "loaded", tags.count(), 0, "loaded from the base tables"))
    if not rows:
        rows.append(spark.createDataFrame([], NO_ROWS))
        conflicts.append(spark.createDataFrame([], NO_CONFLICTS))
    every = scratch.put(reduce(DataFrame.unionByName, rows))
    # translation data sets: tags of the base only, before any site
    known_before = scratch.put(tag_index(tags))
    for k, (name, read) in enumerate((translations_of or {}).items()):
        try:
            pairs = scratch.put(translation_pairs(read()))
        except Exception as e:  # a source that fails is reported and the build goes on
            effects.append((name, "read_failed", 0, 0, str(e).splitlines()[0] if str(e) else type(e).__name__))
            continue
        rank = k - len(translations_of) - 1  # below the sites
        names_of[rank] = name
        told.append(pairs.join(known_before, normalize_tag(F.col("source_tag")) == F.col("tag"), "left_semi").withColumn("src", F.lit(rank)))
    # pass one: all names, numbered by the site that showed them first, then by name
    own = every.select("src", F.col("source_tag").alias("name"))
    alias = every.select("src", F.explode("aliases").alias("name"))
    names = own.unionByName(alias).where(has_name(F.col("name"))).select("src", canonicalize_source_tag(F.col("name")).alias("source_tag")).withColumn("tag", normalize_tag(F.col("source_tag")))
    new = names.groupBy("tag").agg(F.min(F.struct("src", "source_tag")).alias("f")).join(tags.select("tag"), "tag", "left_anti").select("tag", "f.src", "f.source_tag")
    numbered = dense_ids(new, [F.col("src"), F.col("tag")], "tag_id", next_id(tags, "tag_id")).select("tag_id", "source_tag", "tag")
    tags = scratch.put(tags.unionByName(numbered))
    index = tag_index(tags)
    # pass two
    known = every.withColumn("tag", normalize_tag(F.col("source_tag"))).join(index, "tag").withColumnRenamed("tag_id", "canonical")
    canon = known.select("src", "ord", F.lit(0).alias("pos"), "format_id", F.col("canonical").alias("tag_id"), F.col("canonical").alias("preferred_tag_id"), F.lit(0).alias("alias"), "type_id", "deprecated", F.lit(None).cast("string").alias("deprecated_at"), "source_created_at")
    spread = known.select("src", "ord", "format_id", "canonical", "type_id", F.posexplode("aliases").alias("pos", "name")).withColumn("tag", normalize_tag(F.col("name"))).join(index, "tag").where("tag_id <> canonical")
    aliased = spread.select("src", "ord", (F.col("pos") + 1).alias("pos"), "format_id", "tag_id", F.col("canonical").alias("preferred_tag_id"), F.lit(1).alias("alias"), "type_id", F.lit(1).alias("deprecated"), F.lit(None).cast("string").alias("deprecated_at"), F.lit(None).cast("string").alias("source_created_at"))
    first = [F.lit(-1).alias("src"), F.lit(-1).cast("long").alias("ord")]
    was = held["tag_status"].select(*first, F.lit(0).alias("pos"), *[c for c in canon.columns if c not in ("src", "ord", "pos")])
    every_status = scratch.put(was.unionByName(canon).unionByName(aliased))
    status = last_wins(every_status, ["tag_id", "format_id"], ["src", "ord", "pos"], ATTRIBUTES)
    status = with_stamps(status, held["tag_status"])
    counted = known.select("src", "ord", F.col("canonical").alias("tag_id"), "format_id", "count", "source_created_at", "source_updated_at")
    every_usage = scratch.put(held["tag_usage_counts"].select(*first, "*").unionByName(counted))
    usage = greatest_wins(every_usage, ["tag_id", "format_id"], "count", ["src", "ord"], ["source_created_at", "source_updated_at"])
    out = {"tags": tags, "tag_status": status, "tag_usage_counts": usage, "skipped_sources": skipped_frame, "alias_conflicts": reduce(DataFrame.unionByName, conflicts)}
    translations = held["tag_translations"]
    changes = changes_by_source(every_status, every_usage, ["src", "ord", "pos"]).unionByName(new.groupBy("src").agg(F.count("*").alias("changes")))
    if told:
        long = reduce(DataFrame.unionByName, told).withColumn("tag", normalize_tag(F.col("source_tag"))).join(index, "tag").select("tag_id", "language", "translation", "src")
        fresh = scratch.put(insert_or_ignore(translations, long, ["tag_id", "language", "translation"], ["src"]))
        changes = changes.unionByName(fresh.groupBy("src").agg(F.count("*").alias("changes")))
        ids = dense_ids(fresh, [F.col("src"), F.col("tag_id"), F.col("language"), F.col("translation")], "translation_id", next_id(translations, "translation_id"))
        none = F.lit(None).cast("timestamp")
        translations = translations.unionByName(ids.select("translation_id", "tag_id", "language", "translation", none.alias("created_at"), none.alias("updated_at")))
    read = every.groupBy("src").agg(F.count("*").alias("n"))
    for t in told:
        read = read.unionByName(t.groupBy("src").agg(F.count("*").alias("n")).where("src < 0"))
    read = read.groupBy("src").agg(F.sum("n").alias("n"))
    done = {r["src"]: (r["n"], r["c"]) for r in read.join(changes.groupBy("src").agg(F.sum("changes").alias("c")), "src", "left").collect()}  # one row a source
    for rank, name in sorted(names_of.items()):
        n, c = done.get(rank, (0, 0))
        effects.append((name, "imported", n, c or 0, "translations" if rank < 0 else "site_tags"))
    wrong = {r["language"]: r["n"] for r in translations.where(wrong_script()).groupBy("language").agg(F.count("*").alias("n")).collect()}  # one row a language tested
    effects += [("TAG_TRANSLATIONS", "cleanup_deleted", 0, wrong[code], f"cleanup_missing_required_script:{code}") for code in SCRIPTS if wrong.get(code)]
    before_split = script_filter(translations.where("translation is not null")).count()
    # rows of the base without a text are no matter of the cleanup and stay
    translations = out["tag_translations"] = scratch.put(split_values(script_filter(translations)).unionByName(translations.where("translation is null")))
    split = translations.where("translation is not null").count() - before_split
    if split:
        effects.append(("TAG_TRANSLATIONS", "cleanup_split", 0, abs(split), "split_comma_delimited_translations"))
    # repairs, each on what the one before it left
    status, usage = scratch.put(status), scratch.put(usage)
    known_types = scratch.put(seed(held["tag_type_format_mapping"], mappings(spark), ["format_id", "type_id"]))
    out["tag_type_format_mapping"], unmapped = map(scratch.put, map_missing(status, known_types))
    status, turned = map(scratch.put, turn_to_base(status, tags, index))
    tags, renamed = map(scratch.put, rename_to_base(tags))
    tags, status, usage, replaced = map(scratch.put, replace_placeholders(tags, status, usage, translations))
    out |= {"tags": tags, "tag_status": status, "tag_usage_counts": usage}
    out["source_effects"] = spark.createDataFrame(effects, EFFECTS)
    return out | dict(zip(REPORTS, (unmapped, turned, renamed, replaced)))
