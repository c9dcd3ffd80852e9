"""Denormalised views and reports over the tag tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.functions.lang import infer_language
from tagloom.functions.text import fffd_candidates
from tagloom.tables import broadcast_if_small

#: Ids a page of list items spans: no list of the view is longer, whatever a tag's number of aliases.
PAGE_IDS = 1_000_000

# Fixed values.
TYPE_NAMES = (
    "unknown general artist copyright character species invalid meta lore oc rating body-type origin error spoiler "
    "content-official content-fanmade contributor organization deprecated"
).split()


def type_names(spark) -> DataFrame:
    return spark.createDataFrame(list(enumerate(TYPE_NAMES)), "type_name_id long, type_name string")


def current_status(status: DataFrame) -> DataFrame:
    """One row a (tag_id, format_id), exact repeats removed."""
    return status.groupBy("tag_id", "format_id").agg(F.max(F.struct("updated_at", "created_at", "type_id", "alias", "preferred_tag_id", "deprecated")).alias("s")).select("tag_id", "format_id", "s.type_id", "s.alias", "s.preferred_tag_id", "s.deprecated")


def alias_view(tags: DataFrame, status: DataFrame, usage: DataFrame, translations: DataFrame, formats: DataFrame, mapping: DataFrame) -> DataFrame:
    """Canonical tags of every format with name, type, count, aliases and translations.

    ``format_id, tag_id, page, tag, format_name, type_name, count, aliases,
    lang_ja, lang_zh``. Lists are ordered by the id of their items and cut into
    pages of ``PAGE_IDS`` ids, so that a tag with a third of all aliases makes
    many rows and no long one; a tag without items has page 0. Tags that are
    missing give no row; unknown types are named ``unknown``; empty lists are
    empty, never null.
    """
    now = current_status(status)
    names = tags.where("tag is not null").select("tag_id", "tag")
    canon = now.select("format_id", F.col("preferred_tag_id").alias("tag_id")).distinct().join(names, "tag_id").join(broadcast_if_small(formats.select("format_id", "format_name")), "format_id")
    alias = now.where("alias = 1").join(names, "tag_id").select("format_id", F.col("preferred_tag_id").alias("tag_id"), F.lit("alias").alias("kind"), F.col("tag_id").alias("ord"), F.col("tag").alias("text"))
    told = translations.where("translation is not null").select("tag_id", infer_language(F.col("language")).alias("kind"), F.col("translation_id").alias("ord"), F.col("translation").alias("text")).where("kind in ('ja', 'zh')")
    told = told.join(canon.select("tag_id", "format_id"), "tag_id").select("format_id", "tag_id", "kind", "ord", "text")
    items = alias.unionByName(told).withColumn("page", F.floor(F.col("ord") / PAGE_IDS).cast("long"))

    def listed(kind: str) -> Column:
        found = F.collect_list(F.when(F.col("kind") == kind, F.struct("ord", "text")))
        return F.transform(F.array_sort(found), lambda x: x["text"])

    lists = items.groupBy("format_id", "tag_id", "page").agg(listed("alias").alias("aliases"), listed("ja").alias("lang_ja"), listed("zh").alias("lang_zh"))
    # joined types: the canonical tag's own status row, its format's type mapping, the type's name
    own = now.select("tag_id", "format_id", "type_id")
    pairs = mapping.groupBy("format_id", "type_id").agg(F.min("type_name_id").alias("type_name_id"))
    kinds = pairs.join(F.broadcast(type_names(tags.sparkSession)), "type_name_id").select("format_id", "type_id", "type_name")
    counts = usage.where("count >= 0").groupBy("tag_id", "format_id").agg(F.max("count").alias("count"))
    out = canon.join(own, ["tag_id", "format_id"], "left").join(broadcast_if_small(kinds), ["format_id", "type_id"], "left").join(counts, ["tag_id", "format_id"], "left").join(lists, ["format_id", "tag_id"], "left")
    empty = F.array().cast("array<string>")
    return out.select(
        "format_id", "tag_id", F.coalesce("page", F.lit(0)).cast("long").alias("page"), "tag", "format_name", F.coalesce("type_name", F.lit("unknown")).alias("type_name"), "count",
        *(F.coalesce(c, empty).alias(c) for c in ("aliases", "lang_ja", "lang_zh")),
    )


def _referred(status: DataFrame, usage: DataFrame, translations: DataFrame) -> DataFrame:
    """How often each tag id is referred to, by field: ``tag_id, tag_status, preferred_tag_id, tag_usage_counts, tag_translations``."""
    kinds = ("tag_status", "preferred_tag_id", "tag_usage_counts", "tag_translations")
    keys = (status.select("tag_id"), status.select("preferred_tag_id"), usage.select("tag_id"), translations.select("tag_id"))
    rows = reduce(DataFrame.unionByName, (df.toDF("tag_id").select("tag_id", F.lit(k).alias("kind")) for k, df in zip(kinds, keys)))
    return rows.where("tag_id is not null").groupBy("tag_id").agg(*(F.count_if(F.col("kind") == k).alias(k) for k in kinds))


def health(tags: DataFrame, status: DataFrame, usage: DataFrame, translations: DataFrame, mapping: DataFrame, formats: DataFrame) -> DataFrame:
    """``metric, value``: totals and the number of findings of each check.

    References are counted per id before they meet the tags, once for all
    checks; the other checks are one aggregation a table.
    """
    n = F.count("*").alias("n")
    some = lambda c: F.coalesce(F.sum(c), F.lit(0))
    known = formats.select("format_id").distinct().withColumn("known", F.lit(True))
    lost = _referred(status, usage, translations).join(tags.select("tag_id"), "tag_id", "left_anti")
    lost = lost.agg(*(some(c).alias(c) for c in ("tag_status", "preferred_tag_id", "tag_usage_counts", "tag_translations")))
    kinds = status.groupBy("format_id", "type_id").agg(n, F.count_if(F.expr("alias = 0 and preferred_tag_id <> tag_id")).alias("inconsistent"))
    paired = mapping.select("format_id", "type_id").distinct().withColumn("mapped", F.lit(True))
    kinds = kinds.join(paired, ["format_id", "type_id"], "left").join(known, "format_id", "left").agg(
        some(F.when(F.col("mapped").isNull(), F.col("n"))).alias("unmapped"), F.count_if(F.col("mapped").isNull()).alias("unmapped_pairs"), some("inconsistent").alias("inconsistent"),
        some(F.when(F.col("known").isNull(), F.col("n"))).alias("status_formats"),
    )
    counts = usage.groupBy("format_id").agg(n, F.count_if(F.expr("count is null or count < 0")).alias("bad")).join(known, "format_id", "left")
    counts = counts.agg(some("n").alias("usage"), some("bad").alias("bad"), some(F.when(F.col("known").isNull(), F.col("n"))).alias("usage_formats"))
    rows = status.groupBy("tag_id", "format_id").agg(n).agg(some("n").alias("status"), F.count_if(F.col("n") > 1).alias("same_status"))
    names = tags.groupBy("tag").agg(n).agg(some("n").alias("tags"), F.count_if(F.expr("n > 1 and tag is not null")).alias("same_tags"))
    one = reduce(DataFrame.crossJoin, (lost, kinds, counts, rows, names, translations.agg(F.count("*").alias("translations"))))  # one row each
    metrics = {
        "total_tags": "tags", "total_tag_status": "status", "total_translations": "translations", "total_usage_counts": "usage",
        "foreign_key_violations": "tag_status + preferred_tag_id + tag_usage_counts + tag_translations + status_formats + usage_formats + unmapped",
        "missing_type_format_mapping_pairs": "unmapped_pairs", "orphan_tag_status": "tag_status", "orphan_usage_counts": "tag_usage_counts", "orphan_translations": "tag_translations",
        "duplicate_tags": "same_tags", "duplicate_tag_status": "same_status", "alias_inconsistencies": "inconsistent", "bad_usage_counts": "bad",
    }
    return one.select(F.inline(F.array(*(F.struct(F.lit(m).alias("metric"), F.expr(e).cast("long").alias("value")) for m, e in metrics.items()))))


def health_details(tags: DataFrame, status: DataFrame, usage: DataFrame, translations: DataFrame, mapping: DataFrame) -> DataFrame:
    """``check, tag_id, format_id, item``: the rows that each check of ``health`` finds, one a key.

    ``item`` is the type, the tag, the count, the target or the number of rows
    that is at fault, as text. Reports are written sorted by all columns.
    """
    none = F.lit(None).cast("long")
    ids = tags.select("tag_id")
    found = lambda df, check, tag, form, item: df.select(F.lit(check).alias("check"), tag.alias("tag_id"), form.alias("format_id"), item.cast("string").alias("item"))
    lost = _referred(status, usage, translations).join(ids, "tag_id", "left_anti")
    each = F.inline(F.array(*(F.struct(F.lit(f"orphan_{c}").alias("check"), F.col(c).alias("n")) for c in ("tag_status", "preferred_tag_id", "tag_usage_counts", "tag_translations"))))
    orphans = lost.select("tag_id", each).where("n > 0").select("check", "tag_id", none.alias("format_id"), F.col("n").cast("string").alias("item"))
    pairs = status.groupBy("format_id", "type_id").agg(F.count("*").alias("n")).join(mapping, ["format_id", "type_id"], "left_anti")
    twice = status.groupBy("tag_id", "format_id").agg(F.count("*").alias("n")).where("n > 1")
    same = tags.where("tag is not null").groupBy("tag").agg(F.min("tag_id").alias("tag_id"), F.count("*").alias("n")).where("n > 1")
    wrong = status.where("alias = 0 and preferred_tag_id <> tag_id").select("tag_id", "format_id", "preferred_tag_id").distinct()
    bad = usage.where("count is null or count < 0").select("tag_id", "format_id", "count").distinct()
    c = F.col
    return reduce(
        DataFrame.unionByName,
        (
            orphans,
            found(pairs, "missing_type_format_mapping", none, c("format_id"), c("type_id")),
            found(twice, "duplicate_tag_status", c("tag_id"), c("format_id"), c("n")),
            found(same, "duplicate_tags", c("tag_id"), none, c("tag")),
            found(wrong, "alias_inconsistencies", c("tag_id"), c("format_id"), c("preferred_tag_id")),
            found(bad, "bad_usage_counts", c("tag_id"), c("format_id"), c("count")),
        ),
    )


def format_statistics(status: DataFrame, formats: DataFrame) -> DataFrame:
    """``format_id, format_name, n_tags``: distinct tags of every format, zero where it has none."""
    counts = status.select("format_id", "tag_id").distinct().groupBy("format_id").agg(F.count("*").alias("n_tags"))
    return formats.join(counts, "format_id", "left").select("format_id", "format_name", F.coalesce("n_tags", F.lit(0)).alias("n_tags"))


def detect_conflicts(old: DataFrame, new: DataFrame) -> DataFrame:
    """``tag, format_id, kind, old_value, new_value``: types that differ, and canonical tags that became aliases."""
    both = old.join(new.select("tag", "format_id", F.col("type_id").alias("type_id_new"), F.col("alias").alias("alias_new")), ["tag", "format_id"])
    pair = lambda kind, a, b: both.select("tag", "format_id", F.lit(kind).alias("kind"), F.col(a).cast("long").alias("old_value"), F.col(b).cast("long").alias("new_value"))
    types = pair("type_id", "type_id", "type_id_new").where("old_value <> new_value")
    return types.unionByName(pair("alias", "alias", "alias_new").where("old_value = 0 and new_value = 1")).distinct()


def status_conflicts(status: DataFrame, tags: DataFrame) -> DataFrame:
    """``tag_key, format_id, n_rows, n_types, n_aliases, n_preferred``: tags whose status rows of a format disagree.

    Rows of different ids with one tag come together; a missing tag gets a key from its id. Nulls count as a value.
    """
    key = F.when(F.col("tag").isNull() | (F.col("tag") == ""), F.format_string("__missing_tag_id_%d__", "tag_id")).otherwise(F.col("tag"))
    rows = status.join(tags.select("tag_id", "tag"), "tag_id", "left").withColumn("tag_key", key)
    kinds = lambda c: F.countDistinct(c) + F.max(F.col(c).isNull().cast("int"))
    agg = rows.groupBy("tag_key", "format_id").agg(F.count("*").alias("n_rows"), kinds("type_id").alias("n_types"), kinds("alias").alias("n_aliases"), kinds("preferred_tag_id").alias("n_preferred"))
    return agg.where("n_types > 1 or n_aliases > 1 or n_preferred > 1")


def status_conflict_details(status: DataFrame, tags: DataFrame, formats: DataFrame) -> DataFrame:
    """``format_id, format_name, tag_key, tag_missing, tag_id, alias, type_id, preferred_tag_id, preferred_tag``: the rows behind ``status_conflicts``."""
    missing = F.col("tag").isNull() | (F.col("tag") == "")
    key = F.when(missing, F.format_string("__missing_tag_id_%d__", "tag_id")).otherwise(F.col("tag"))
    name = tags.select("tag_id", "tag")
    rows = status.join(name, "tag_id", "left").withColumns({"tag_key": key, "tag_missing": missing})
    hit = rows.join(status_conflicts(status, tags).select("tag_key", "format_id"), ["tag_key", "format_id"], "left_semi")
    out = hit.join(name.toDF("preferred_tag_id", "preferred_tag"), "preferred_tag_id", "left").join(formats.select("format_id", "format_name"), "format_id", "left")
    return out.select("format_id", F.coalesce("format_name", F.lit("unknown")).alias("format_name"), "tag_key", "tag_missing", "tag_id", "alias", "type_id", "preferred_tag_id", "preferred_tag")


def prefix_inversions(status: DataFrame, tags: DataFrame, prefixes: tuple[str, ...] = ("meta:", "artist:")) -> DataFrame:
    """``tag_id, format_id, tag, preferred_tag``: aliases whose target carries a prefix that they lack."""
    any_of = lambda c: reduce(lambda a, b: a | b, (c.ilike(f"{p}%") for p in prefixes))
    name = tags.select("tag_id", "tag")
    rows = status.where("alias = 1").select("tag_id", "format_id", "preferred_tag_id").distinct()
    targets = name.where(any_of(F.col("tag"))).select(F.col("tag_id").alias("preferred_tag_id"), F.col("tag").alias("preferred_tag"))
    return rows.join(targets, "preferred_tag_id").join(name.where(~any_of(F.col("tag"))), "tag_id").select("tag_id", "format_id", "tag", "preferred_tag")


def bad_unicode(tags: DataFrame, status: DataFrame, usage: DataFrame) -> DataFrame:
    """``tag_id, format_id, tag, count, tag_hex, suggestion_id, suggestion``: tags with replacement characters.

    The suggestion is an existing tag that a rewrite of the character gives:
    one with a status in the same format first, then in the order of the rewrites.
    """
    bad = tags.where(F.col("tag").contains(chr(0xFFFD))).select("tag_id", "tag")
    rows = bad.join(status.select("tag_id", "format_id").distinct(), "tag_id")
    counts = usage.groupBy("tag_id", "format_id").agg(F.max("count").alias("count"))
    rewrites = bad.select("tag_id", F.posexplode(fffd_candidates(F.col("tag"))).alias("rule", "candidate"))
    found = rewrites.join(tags.select(F.col("tag_id").alias("suggestion_id"), F.col("tag").alias("candidate")), "candidate")
    there = status.select(F.col("tag_id").alias("suggestion_id"), "format_id", F.lit(0).alias("absent")).distinct()
    ranked = rows.select("tag_id", "format_id").join(found, "tag_id").join(there, ["suggestion_id", "format_id"], "left")
    best = ranked.groupBy("tag_id", "format_id").agg(F.min(F.struct(F.coalesce("absent", F.lit(1)).alias("absent"), "rule", "suggestion_id", "candidate")).alias("b"))
    out = rows.join(counts, ["tag_id", "format_id"], "left").join(best, ["tag_id", "format_id"], "left")
    return out.select("tag_id", "format_id", "tag", "count", F.hex(F.encode("tag", "UTF-8")).alias("tag_hex"), F.col("b.suggestion_id").alias("suggestion_id"), F.col("b.candidate").alias("suggestion"))


def classify_column(df: DataFrame, column: str, underscore: float = 0.7, paren: float = 0.3, change: float = 0.5, margin: float = 0.1) -> DataFrame:
    """One row: the shares of a column's signals, and whether it holds source forms or normalised ones.

    Null and blank values do not count; a column without any others gives decision ``empty``.
    """
    from tagloom.functions.text import normalize_tag, strip

    v = strip(F.col(column).cast("string"))
    values = df.select(v.alias("v")).where("v <> ''")
    share = lambda c: F.avg(c.cast("int"))
    one = values.agg(
        F.count("*").alias("n_values"),
        share(F.col("v").contains("_")).alias("underscore"),
        share(F.col("v").rlike(r"\\[()]")).alias("escaped_paren"),
        share(normalize_tag(F.col("v")) != F.col("v")).alias("normalize_change"),
    )
    yes = lambda c: c.cast("int")
    source = yes(F.col("underscore") >= underscore) + yes(F.col("normalize_change") >= change)
    normal = yes(F.col("underscore") <= margin) + yes(F.col("escaped_paren") >= paren) + yes(F.col("normalize_change") <= margin)
    decision = F.when(F.col("n_values") == 0, "empty").when(source >= 2, "source").when(normal >= 2, "normalized").otherwise("unknown")
    level = F.when(F.col("n_values") == 0, "none").when(source >= 2, "medium").when(normal >= 3, "high").when(normal >= 2, "medium").otherwise("low")
    return one.select("*", decision.alias("decision"), level.alias("confidence"))


def null_ratios(df: DataFrame) -> DataFrame:
    """``column_name, null_ratio`` of every column, in one pass; an empty frame has ratio 0."""
    shares = df.agg(*(F.coalesce(F.avg(F.col(f"`{c}`").isNull().cast("int")), F.lit(0.0)).alias(c) for c in df.columns))
    return shares.unpivot([], list(shares.columns), "column_name", "null_ratio")


def prune_null_columns(df: DataFrame, limit: float = 0.9) -> DataFrame:
    """Without the columns of which at least ``limit`` is null."""
    keep = [r["column_name"] for r in null_ratios(df).where(F.col("null_ratio") < limit).collect()]  # one row a column
    return df.select(*(f"`{c}`" for c in df.columns if c in keep))


def bad_unicode_origins(tags: DataFrame, site_tags: DataFrame, aliases: DataFrame) -> DataFrame:
    """``tag_id, origin, origin_id``: where a tag with replacement characters came from.

    The first that holds: a site row with its source form, an alias with its
    source form, a site row with its tag, an alias whose target in lower case is
    its tag; else ``unknown``. Of several rows the smallest id counts.
    """
    bad = tags.where(F.col("tag").contains(chr(0xFFFD)) | F.col("source_tag").contains(chr(0xFFFD))).select("tag_id", "source_tag", "tag")

    def first(df: DataFrame, name, row_id: str, on: str, origin: str) -> DataFrame:
        return df.select(name.alias(on), F.col(row_id).alias("_id")).where(F.col(on).isNotNull()).groupBy(on).agg(F.min("_id").alias(origin))

    out = bad
    for df, name, row_id, on, origin in (
        (site_tags, F.col("source_tag"), "site_row_id", "source_tag", "site_source"),
        (aliases, F.col("alias"), "alias_index", "source_tag", "alias_source"),
        (site_tags, F.col("source_tag"), "site_row_id", "tag", "site_tag"),
        (aliases, F.lower(F.col("tag")), "alias_index", "tag", "alias_target"),
    ):
        found = first(df, name, row_id, on, origin)
        out = out.join(found.where(F.col(on).contains(chr(0xFFFD)) if origin == "alias_target" else F.lit(True)), on, "left")
    names = ("site_source", "alias_source", "site_tag", "alias_target")
    chosen = F.coalesce(*(F.when(F.col(n).isNotNull(), F.lit(n)) for n in names), F.lit("unknown"))
    return out.select("tag_id", chosen.alias("origin"), F.coalesce(*names).alias("origin_id"))
