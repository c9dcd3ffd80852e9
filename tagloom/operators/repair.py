"""Repairs of the tag database, each a set of frames: what to change, and the report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.functions.text import CATEGORY_PREFIXES, strip_category_prefix


def missing_mappings(status: DataFrame, mapping: DataFrame) -> DataFrame:
    """``format_id, type_id, type_name_id, n_rows, reason``: (format, type) pairs in use that the mapping lacks.

    A type id that is a known type name stands for itself, others for 0.
    """
    top = mapping.agg(F.max("type_name_id")).first()[0]
    top = -1 if top is None else top
    used = status.groupBy("format_id", "type_id").agg(F.count("*").alias("n_rows"))
    missing = used.join(mapping.select("format_id", "type_id"), ["format_id", "type_id"], "left_anti")
    known = F.col("type_id").between(0, top)
    return missing.select(
        "format_id",
        "type_id",
        F.when(known, F.col("type_id")).otherwise(F.lit(0)).alias("type_name_id"),
        "n_rows",
        F.when(known, "type_id_as_type_name_id").otherwise("fallback_unknown").alias("reason"),
    )


def has_prefix(c):
    out = F.lit(False)
    for p in CATEGORY_PREFIXES:
        out = out | c.startswith(p)
    return F.coalesce(out, F.lit(False))


def prefix_to_base(status: DataFrame, tags: DataFrame, index: DataFrame, spared_format: int = 2) -> DataFrame:
    """``tag_id, format_id, alias, preferred_tag_id, reason``: status rows whose own or preferred tag carries a category prefix.

    They are turned to the tag without prefix: (0, self) if that is the row's
    own tag, else (1, base); ``base_tag_not_found`` where it does not exist.
    Rows that already say so are left out. ``index`` is ``tag, tag_id``.
    """
    name = tags.select("tag_id", "tag")
    rows = status.where(F.col("format_id") != spared_format).select("tag_id", "format_id", "alias", "preferred_tag_id").distinct()
    prefixed = name.where(has_prefix(F.col("tag")))
    own = rows.join(prefixed.select("tag_id", F.col("tag").alias("own")), "tag_id", "left")
    both = own.join(prefixed.select(F.col("tag_id").alias("preferred_tag_id"), F.col("tag").alias("target")), "preferred_tag_id", "left").where("own is not null or target is not null")
    wanted = both.withColumn("base", F.coalesce(strip_category_prefix(F.col("target")), strip_category_prefix(F.col("own"))))
    found = wanted.join(index.select(F.col("tag").alias("base"), F.col("tag_id").alias("base_id")), "base", "left")
    alias = F.when(F.col("base_id") == F.col("tag_id"), 0).otherwise(1)
    out = found.select(
        "tag_id",
        "format_id",
        F.when(F.col("base_id").isNull(), F.col("alias")).otherwise(alias).alias("new_alias"),
        F.coalesce("base_id", "preferred_tag_id").alias("new_preferred"),
        F.when(F.col("base_id").isNull(), "base_tag_not_found").otherwise("prefix_to_base").alias("reason"),
        "alias",
        "preferred_tag_id",
    )
    changed = (F.col("reason") == "base_tag_not_found") | (F.col("new_alias") != F.col("alias")) | (F.col("new_preferred") != F.col("preferred_tag_id"))
    return out.where(changed).select("tag_id", "format_id", F.col("new_alias").alias("alias"), F.col("new_preferred").alias("preferred_tag_id"), "reason")


def rename_orphans(tags: DataFrame) -> DataFrame:
    """``tag_id, tag, new_tag``: prefixed tags whose clean name nobody has; the smallest id claims it."""
    claims = tags.where(has_prefix(F.col("tag"))).select("tag_id", "tag", strip_category_prefix(F.col("tag")).alias("new_tag")).where("new_tag is not null")
    first = claims.groupBy("new_tag").agg(F.min(F.struct("tag_id", "tag")).alias("r")).select("r.tag_id", "r.tag", "new_tag")
    return first.join(tags.select(F.col("tag").alias("new_tag")), "new_tag", "left_anti").select("tag_id", "tag", "new_tag")


def remap_duplicates(tags: DataFrame) -> DataFrame:
    """``tag_id, canonical_id``: ids whose tag another, smaller id has too."""
    first = tags.where("tag is not null").groupBy("tag").agg(F.min("tag_id").alias("canonical_id"))
    return tags.join(first, "tag").where("tag_id <> canonical_id").select("tag_id", "canonical_id")


def deduplicate_tags(tags: DataFrame) -> DataFrame:
    """One row a tag, that of the smallest id; tags without a name are one tag."""
    rest = [c for c in tags.columns if c not in ("tag", "tag_id")]
    first = tags.groupBy("tag").agg(F.min(F.struct("tag_id", *rest)).alias("r"))
    return first.select(*(F.col("tag") if c == "tag" else F.col(f"r.{c}").alias(c) for c in tags.columns))


def apply_remap(rows: DataFrame, remap: DataFrame, columns: list[str]) -> DataFrame:
    """``rows`` with the ids in ``columns`` replaced; ids that are not remapped stay."""
    out = rows
    for c in columns:
        to = remap.select(F.col("tag_id").alias(c), F.col("canonical_id").alias("_to"))
        out = out.join(to, c, "left").withColumn(c, F.coalesce("_to", c)).drop("_to")
    return out.select(*rows.columns)


def placeholder_repair(tags: DataFrame, status: DataFrame, usage: DataFrame, translations: DataFrame, pattern: str = "\\_\\_missing\\_tag\\_id\\_%\\_\\_") -> DataFrame:
    """``tag_id, format_id, preferred_tag_id, action``: what becomes of placeholder tags and their rows.

    Without status: deleted. A status that prefers itself: deleted. If the
    preferred tag already has a status in the format, the placeholder's is
    redundant; else the first placeholder, by id, hands its status over. Counts
    move to the preferred tag; translations need a person; a placeholder that
    nothing refers to any more is deleted.
    """
    marks = tags.where(F.col("tag").like(pattern)).select("tag_id")
    own = status.join(F.broadcast(marks) if marks.limit(10001).count() <= 10000 else marks, "tag_id").select("tag_id", "format_id", "preferred_tag_id").distinct()
    bare = marks.join(status.select("tag_id"), "tag_id", "left_anti").select("tag_id", F.lit(None).cast("long").alias("format_id"), F.lit(None).cast("long").alias("preferred_tag_id"), F.lit("delete_placeholder_only").alias("action"))
    taken = status.select(F.col("tag_id").alias("preferred_tag_id"), "format_id", F.lit(1).alias("taken")).distinct()
    # the first claimant is a minimum, so a tag that most placeholders prefer is no hot window
    first = own.groupBy("preferred_tag_id", "format_id").agg(F.min("tag_id").alias("first"))
    judged = own.join(taken, ["preferred_tag_id", "format_id"], "left").join(first, ["preferred_tag_id", "format_id"])
    action = F.when(F.col("tag_id") == F.col("preferred_tag_id"), "delete_invalid_self_preferred").when(F.col("taken").isNotNull() | (F.col("tag_id") > F.col("first")), "delete_redundant_status").otherwise("reassign_status_to_preferred")
    first = judged.select("tag_id", "format_id", "preferred_tag_id", action.alias("action"))
    counts = usage.select("tag_id", "format_id").distinct().join(marks, "tag_id").join(own, ["tag_id", "format_id"], "left")
    moved = counts.select(
        "tag_id", "format_id", "preferred_tag_id",
        F.when(F.col("preferred_tag_id").isNull() | (F.col("preferred_tag_id") == F.col("tag_id")), "delete_usage_count_unmappable").otherwise("move_usage_count_to_preferred").alias("action"),
    )
    held = marks.join(translations.select("tag_id"), "tag_id", "left_semi")
    no_format = [F.lit(None).cast("long").alias(c) for c in ("format_id", "preferred_tag_id")]
    manual = held.select("tag_id", *no_format, F.lit("has_extra_rows_needs_manual").alias("action"))
    done = marks.join(status.select("tag_id"), "tag_id", "left_semi").join(held, "tag_id", "left_anti").select("tag_id", *no_format, F.lit("delete_placeholder_after_repair").alias("action"))
    return bare.unionByName(first).unionByName(moved).unionByName(manual).unionByName(done)


def map_missing(status: DataFrame, mapping: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The mapping with a row for every (format, type) pair in use, and the report of ``missing_mappings``."""
    report = missing_mappings(status, mapping)
    added = report.select("format_id", "type_id", "type_name_id", F.concat(F.lit("auto-added ("), "reason", F.lit(")")).alias("description"))
    return mapping.select("format_id", "type_id", "type_name_id", "description").unionByName(added), report


def turn_to_base(status: DataFrame, tags: DataFrame, index: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The status with the rows of ``prefix_to_base`` turned, and a report with the names and targets before and after.

    ``status`` holds one row a (tag, format). Prefixes without a name behind them are no case.
    """
    name = tags.select("tag_id", "tag")
    target = lambda c: name.select(F.col("tag_id").alias(f"{c}_tag_id"), F.col("tag").alias(f"{c}_tag"))
    change = prefix_to_base(status, tags, index).select("tag_id", "format_id", F.col("alias").alias("new_alias"), F.col("preferred_tag_id").alias("new_preferred_tag_id"), "reason")
    before = status.select("tag_id", "format_id", F.col("preferred_tag_id").alias("old_preferred_tag_id"))
    full = change.join(before, ["tag_id", "format_id"]).join(name, "tag_id").join(target("old_preferred"), "old_preferred_tag_id").join(target("new_preferred"), "new_preferred_tag_id")
    turned = F.col("reason") == "prefix_to_base"
    only = lambda c: F.when(turned, F.col(c)).alias(c)
    report = full.where(F.coalesce(strip_category_prefix(F.col("old_preferred_tag")), strip_category_prefix(F.col("tag"))).isNotNull()).select(
        "format_id", "tag_id", "tag", "old_preferred_tag_id", "old_preferred_tag", only("new_preferred_tag_id"), only("new_preferred_tag"), only("new_alias"), "reason"
    )
    to = change.where(turned).select("tag_id", "format_id", "new_alias", "new_preferred_tag_id")
    out = status.join(to, ["tag_id", "format_id"], "left").withColumn("alias", F.coalesce("new_alias", "alias")).withColumn("preferred_tag_id", F.coalesce("new_preferred_tag_id", "preferred_tag_id"))
    return out.select(*status.columns), report


def rename_to_base(tags: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The tags with the names of ``rename_orphans``, and its report."""
    report = rename_orphans(tags).select("tag_id", F.col("tag").alias("old_tag"), "new_tag", F.lit("rename_prefix_to_base").alias("reason"))
    out = tags.join(report.select("tag_id", "new_tag"), "tag_id", "left").withColumn("tag", F.coalesce("new_tag", "tag"))
    return out.select(*tags.columns), report


def replace_placeholders(tags: DataFrame, status: DataFrame, usage: DataFrame, translations: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Tags, status and counts with the actions of ``placeholder_repair`` done, and their report.

    A placeholder with status goes only when nothing refers to it any more,
    other tags' preference included; counts of one without status are left as
    they are. A count that moves raises that of the preferred tag or becomes it.
    """
    listed = status.select("tag_id").distinct()
    actions = placeholder_repair(tags, status, usage, translations).where("action <> 'delete_placeholder_after_repair'")
    about = F.col("action").isin("delete_usage_count_unmappable", "move_usage_count_to_preferred", "has_extra_rows_needs_manual")
    actions = actions.where(~about).unionByName(actions.where(about).join(listed, "tag_id", "left_semi").select(*actions.columns))
    of = lambda *names: actions.where(F.col("action").isin(*names))
    # status
    done = of("delete_invalid_self_preferred", "delete_redundant_status", "reassign_status_to_preferred").select("tag_id", "format_id", "action")
    kept = status.join(done.select("tag_id", "format_id"), ["tag_id", "format_id"], "left_anti").select(*status.columns)
    handed = status.join(done.where("action = 'reassign_status_to_preferred'"), ["tag_id", "format_id"]).withColumn("tag_id", F.col("preferred_tag_id")).withColumn("alias", F.lit(0).cast(dict(status.dtypes)["alias"]))
    new_status = kept.unionByName(handed.select(*status.columns))
    # counts
    counted = of("delete_usage_count_unmappable", "move_usage_count_to_preferred").select("tag_id", "format_id", F.col("preferred_tag_id").alias("to"), "action")
    still = usage.join(counted.select("tag_id", "format_id"), ["tag_id", "format_id"], "left_anti").select(*usage.columns)
    moved = usage.join(counted.where("action = 'move_usage_count_to_preferred'"), ["tag_id", "format_id"]).groupBy(F.col("to").alias("tag_id"), "format_id").agg(F.max("count").alias("moved"))
    new_usage = still.join(moved, ["tag_id", "format_id"], "full").withColumn("count", F.greatest("count", "moved")).select(*usage.columns)
    # tags
    repaired = done.select("tag_id").distinct()
    used = new_status.select("tag_id").unionByName(new_status.select(F.col("preferred_tag_id").alias("tag_id"))).unionByName(translations.select("tag_id")).unionByName(new_usage.select("tag_id"))
    free = repaired.join(used, "tag_id", "left_anti")
    none = F.lit(None).cast("long")
    gone = of("delete_placeholder_only").unionByName(free.select("tag_id", none.alias("format_id"), none.alias("preferred_tag_id"), F.lit("delete_placeholder_after_repair").alias("action")))
    report = actions.where("action <> 'delete_placeholder_only'").unionByName(gone).join(tags.select("tag_id", F.col("tag").alias("placeholder_tag")), "tag_id")
    return tags.join(gone.select("tag_id"), "tag_id", "left_anti").select(*tags.columns), new_status, new_usage, report
