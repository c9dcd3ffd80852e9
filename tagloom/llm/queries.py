"""Queries of the problems tagged llm, each over its whole tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.llm.bpe import token_ids
from tagloom.llm.copies import copies, copy_groups
from tagloom.llm.groups import tag_groups
from tagloom.llm.leakage import clean, leaked, matches
from tagloom.llm.mojibake import garbled_fields
from tagloom.llm.residue import residue_pages
from tagloom.llm.survivor import claims, fuse, survivors
from tagloom.tables import load


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Copies among the tags records and the first record of each one's group."""
    return copies(load(spark, d, "tags"))


def p2_groups(spark: SparkSession, d: str) -> DataFrame:
    """One record a group with the number of its copies, groups of one included."""
    return copy_groups(load(spark, d, "tags")).select("first_id", "copies")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Which member each field of a group's surviving record comes from."""
    return survivors(load(spark, d, "tags"))


def p3_fused(spark: SparkSession, d: str) -> DataFrame:
    """The source_tag and tag of greatest posterior for each group, by fusion over the formats that list it."""
    fields = ("source_tag", "tag")
    out = fuse(claims(load(spark, d, "tags"), load(spark, d, "tag_status"), *fields))
    which = F.left("canon", F.lit(1)).cast("int")
    return out.select(F.element_at(F.array(*map(F.lit, fields)), which + 1).alias("field_name"), F.substring("canon", 3, 1 << 30).alias("canon"), "value", "probability")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """Fields whose text was decoded wrongly."""
    return garbled_fields(load(spark, d, "tags"), load(spark, d, "tag_aliases")).select("table_name", "field_name", "row_id")


def p6_restored(spark: SparkSession, d: str) -> DataFrame:
    """The original text of garbled fields, where one can be had, and the swap that explains it."""
    return garbled_fields(load(spark, d, "tags"), load(spark, d, "tag_aliases")).where("restored is not null").select("table_name", "field_name", "row_id", "swap", "restored")


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    """The group of every linked tag."""
    return tag_groups(load(spark, d, "tags"), load(spark, d, "tag_status"), load(spark, d, "tag_aliases"))


def p7_sizes(spark: SparkSession, d: str) -> DataFrame:
    """Groups with the number of their tags."""
    return p7_found(spark, d).groupBy("group_id").agg(F.count("*").alias("n_tags"))


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    """Token ids of every document by byte_bpe_50k."""
    return token_ids(load(spark, d, "documents"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    """Documents that hold a passage of a test item, and the item."""
    return leaked(load(spark, d, "documents"), load(spark, d, "eval_items"))


def p9_matches(spark: SparkSession, d: str) -> DataFrame:
    """The longest verbatim match of each item in each document, and where it starts."""
    return matches(load(spark, d, "documents"), load(spark, d, "eval_items"))


def p9_clean(spark: SparkSession, d: str) -> DataFrame:
    """The documents that hold no passage of a test item."""
    return clean(load(spark, d, "documents"), load(spark, d, "eval_items")).select("doc_id")


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    """Documents with residue in place of content."""
    return residue_pages(load(spark, d, "documents")).select("doc_id")


QUERIES = {
    "p2_found": p2_found,
    "p2_groups": p2_groups,
    "p3_found": p3_found,
    "p3_fused": p3_fused,
    "p6_found": p6_found,
    "p6_restored": p6_restored,
    "p7_found": p7_found,
    "p7_sizes": p7_sizes,
    "p8_ids": p8_ids,
    "p9_found": p9_found,
    "p9_matches": p9_matches,
    "p9_clean": p9_clean,
    "p10_found": p10_found,
}

_CANON = r"""
WITH canon AS (SELECT *, list_sort(regexp_extract_all(lower(CASE WHEN coalesce(regexp_full_match(tag, '[\s\pZ\x0b\x1c-\x1f\x{85}]*'), true) THEN source_tag ELSE tag END), '[\pL\pN]+')) AS words FROM tags),
named AS (SELECT *, array_to_string(words, ' ') AS c, coalesce(regexp_full_match(tag, '[\s\pZ\x0b\x1c-\x1f\x{85}]*'), true) AS no_tag,
  coalesce(regexp_full_match(source_tag, '[\s\pZ\x0b\x1c-\x1f\x{85}]*'), true) AS no_source FROM canon WHERE len(words) > 0)
"""

_GROUPS = """
WITH RECURSIVE link AS (
  SELECT 't' || s.tag_id AS a, 't' || s.preferred_tag_id AS b FROM tag_status s
    WHERE alias = 1 AND tag_id IN (SELECT tag_id FROM tags) AND preferred_tag_id IN (SELECT tag_id FROM tags)
  UNION SELECT 'n' || alias, 'n' || tag FROM tag_aliases
  UNION SELECT 't' || tag_id, 'n' || source_tag FROM tags WHERE source_tag IN (SELECT alias FROM tag_aliases UNION SELECT tag FROM tag_aliases)),
both_ways AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
start AS (SELECT DISTINCT a AS node FROM both_ways),
reach(node, root) USING KEY (node) AS (
  SELECT node, node FROM start
  UNION SELECT e.b, min(r.root) FROM reach r JOIN both_ways e ON e.a = r.node JOIN recurring.reach cur ON cur.node = e.b WHERE r.root < cur.root GROUP BY e.b),
labelled AS (SELECT CAST(substr(node, 2) AS BIGINT) AS tag_id, root FROM reach WHERE node[1] = 't'),
groups AS (SELECT root, min(tag_id) AS group_id FROM labelled GROUP BY root HAVING count(*) > 1)
"""

SQL = {
    "p2_found": _CANON + "SELECT f.first_tag_id, n.tag_id AS copy_tag_id FROM named n JOIN (SELECT c, min(tag_id) AS first_tag_id FROM named GROUP BY c) f USING (c) WHERE n.tag_id <> f.first_tag_id",
    "p2_groups": _CANON + "SELECT min(tag_id) AS first_id, count(*) AS copies FROM named GROUP BY c",
    "p3_found": _CANON
    + """SELECT min(tag_id) AS tag_id,
  first(tag_id ORDER BY updated_at DESC NULLS LAST, tag_id) FILTER (NOT no_source) AS source_tag_from,
  first(tag_id ORDER BY created_at ASC NULLS LAST, tag_id) FILTER (NOT no_tag) AS tag_from
FROM named GROUP BY c HAVING count(*) > 1""",
    "p7_found": _GROUPS + "SELECT tag_id, group_id FROM labelled JOIN groups USING (root)",
    "p7_sizes": _GROUPS + "SELECT group_id, count(*) AS n_tags FROM labelled JOIN groups USING (root) GROUP BY group_id",
}
