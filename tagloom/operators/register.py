"""Registration of tags in two passes, alias expansion, and alias resolution."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.functions.text import canonicalize_source_tag, has_name, normalize_tag, split_list
from tagloom.operators.ids import dense_ids, next_id
from tagloom.tables import broadcast_if_small

SINKS = ("invalid_tag", "bad_tag")


def source_names(rows: DataFrame, source: str = "source_tag", packed: str = "deprecated_tags") -> DataFrame:
    """Every canonical and alias name of the rows, distinct, in stored form. Blank names are left out."""
    own = rows.select(F.col(source).alias("name"))
    alias = rows.select(F.explode(split_list(F.col(packed))).alias("name"))
    return own.unionByName(alias).where(has_name(F.col("name"))).select(canonicalize_source_tag(F.col("name")).alias("source_tag")).distinct()


def register(tags: DataFrame, rows: DataFrame) -> DataFrame:
    """``tag_id, source_tag, tag`` of the names that ``tags`` lacks, numbered on from its greatest id in the order of tag.

    Of several source forms of one tag the smallest is kept. Null and blank
    names give nothing; an empty ``tags`` starts at 1.
    """
    new = source_names(rows).withColumn("tag", normalize_tag(F.col("source_tag"))).groupBy("tag").agg(F.min("source_tag").alias("source_tag"))
    new = new.join(tags.select("tag").where("tag is not null"), "tag", "left_anti")
    return dense_ids(new, [F.col("tag")], "tag_id", next_id(tags, "tag_id")).select("tag_id", "source_tag", "tag")


def tag_index(tags: DataFrame) -> DataFrame:
    """``tag, tag_id``: the smallest id of each tag."""
    return tags.where("tag is not null").groupBy("tag").agg(F.min("tag_id").alias("tag_id"))


def expand_aliases(rows: DataFrame, index: DataFrame) -> DataFrame:
    """Status rows of site rows: the canonical one, and one alias row for each name in the packed list.

    ``format_id, tag_id, preferred_tag_id, alias, type_id, deprecated``,
    distinct. Names that the index lacks and aliases of themselves are skipped.
    Alias rows take the canonical row's type and are deprecated.
    """
    base = rows.select("format_id", F.coalesce("type_id", F.lit(-1)).alias("type_id"), "deprecated", "deprecated_tags", normalize_tag(F.col("source_tag")).alias("tag"))
    known = base.join(index, "tag").withColumnRenamed("tag_id", "preferred_tag_id")
    own = known.select("format_id", F.col("preferred_tag_id").alias("tag_id"), "preferred_tag_id", F.lit(0).alias("alias"), "type_id", F.coalesce("deprecated", F.lit(0)).cast("int").alias("deprecated"))
    names = known.select("format_id", "preferred_tag_id", "type_id", F.explode(split_list(F.col("deprecated_tags"))).alias("name")).withColumn("tag", normalize_tag(F.col("name")))
    alias = names.join(index, "tag").where("tag_id <> preferred_tag_id").select("format_id", "tag_id", "preferred_tag_id", F.lit(1).alias("alias"), "type_id", F.lit(1).alias("deprecated"))
    return own.unionByName(alias).distinct()


def unknown_aliases(rows: DataFrame, index: DataFrame) -> DataFrame:
    """Names in packed lists that the index lacks, with the number of rows that hold them."""
    names = rows.select(F.explode(split_list(F.col("deprecated_tags"))).alias("alias")).withColumn("tag", normalize_tag(F.col("alias")))
    return names.join(index, "tag", "left_anti").groupBy("alias").agg(F.count("*").alias("n_rows"))


def candidates(aliases: DataFrame, domain: str = "format_id", order: str = "alias_index") -> DataFrame:
    """``domain, alias, tag, first``: each alias's targets with where they were first seen. Nulls are no names."""
    return aliases.where("alias is not null and tag is not null").groupBy(domain, "alias", "tag").agg(F.min(order).alias("first"))


def resolve_aliases(aliases: DataFrame, overrides: DataFrame | None = None, domain: str = "format_id") -> DataFrame:
    """``domain, alias, tag, reason, n_candidates``: the target of each alias.

    The first seen wins unless an override (``domain, alias, canonical``) names another.
    """
    cands = candidates(aliases, domain)
    chosen = cands.groupBy(domain, "alias").agg(F.min_by("tag", F.struct("first", "tag")).alias("tag"), F.count("*").alias("n_candidates"))
    if overrides is None:
        return chosen.select(domain, "alias", "tag", F.lit("first-win").alias("reason"), "n_candidates")
    joined = chosen.join(broadcast_if_small(overrides), [domain, "alias"], "left")
    return joined.select(domain, "alias", F.coalesce("canonical", "tag").alias("tag"), F.when(F.col("canonical").isNotNull(), "override").otherwise("first-win").alias("reason"), "n_candidates")


def alias_conflicts(aliases: DataFrame, overrides: DataFrame | None = None, domain: str = "format_id") -> DataFrame:
    """``domain, alias, selected, rejected, reason``: one row for each target that was not selected."""
    chosen = resolve_aliases(aliases, overrides, domain).where("n_candidates > 1 or reason = 'override'").select(domain, "alias", F.col("tag").alias("selected"), "reason")
    return candidates(aliases, domain).join(chosen, [domain, "alias"]).where("tag <> selected").select(domain, "alias", "selected", F.col("tag").alias("rejected"), "reason")


def aliases_of(aliases: DataFrame, domain: str = "format_id") -> DataFrame:
    """``domain, tag, alias``: distinct aliases of each canonical name, sinks left out; self-links are no aliases.

    Long form: a canonical name with a third of all aliases stays spread.
    """
    return resolve_aliases(aliases, None, domain).where(~F.col("tag").isin(*SINKS) & (F.col("alias") != F.col("tag"))).select(domain, "tag", "alias").distinct()
