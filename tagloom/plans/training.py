"""Queries of the general training-data problems (1, 4, 5), each over its whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.operators.orphans import tag_orphans
from tagloom.operators.packed import explode_packed, split_packed
from tagloom.sources.csvlines import failed_lines, line_edits, loaded_lines
from tagloom.tables import load


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Values of every field of site_tags and tag_translations that holds two or more."""
    sites = explode_packed(load(spark, d, "site_tags"), "site_row_id", "deprecated_tags", 2)
    translations = explode_packed(load(spark, d, "tag_translations"), "translation_id", "translation", 2)
    name = lambda df, t: df.select(F.lit(t).alias("table_name"), "row_id", "pos", "item_value")
    return name(sites, "site_tags").unionByName(name(translations, "tag_translations"))


def p1_value_counts(spark: SparkSession, d: str) -> DataFrame:
    """How many values the fields of each table hold: ``table_name, n_values, n_fields``."""
    out = None
    for table, field in (("site_tags", "deprecated_tags"), ("tag_translations", "translation")):
        per = load(spark, d, table).select(F.size(split_packed(F.col(field))).cast("long").alias("n_values")).where("n_values > 0").groupBy("n_values").agg(F.count("*").alias("n_fields"))
        per = per.select(F.lit(table).alias("table_name"), "n_values", "n_fields")
        out = per if out is None else out.unionByName(per)
    return out


def _orphans(spark: SparkSession, d: str) -> DataFrame:
    names = ("tag_status", "tag_usage_counts", "tag_translations", "tags", "tag_type_format_mapping")
    return tag_orphans(*(load(spark, d, n) for n in names))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """Referring rows whose target does not exist, or not yet, by table, field and month."""
    return _orphans(spark, d)


def p4_report(spark: SparkSession, d: str) -> DataFrame:
    """Orphans counted per table, field and period."""
    return _orphans(spark, d).groupBy("ref_table", "ref_field", "period").agg(F.count("*").alias("n_rows"), F.countDistinct("missing_key").alias("n_keys"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """CSV records that fail, with the first reason that holds."""
    return failed_lines(load(spark, d, "csv_lines"))


def p5_loaded(spark: SparkSession, d: str) -> DataFrame:
    """CSV records that load, typed."""
    return loaded_lines(load(spark, d, "csv_lines")).select("line_id", "source_tag", "type_id", "count", "format_id")


def p5_edits(spark: SparkSession, d: str) -> DataFrame:
    """The edits of the cheapest parse of CSV records that need some."""
    return line_edits(load(spark, d, "csv_lines"))


QUERIES = {"p1_found": p1_found, "p1_value_counts": p1_value_counts, "p4_found": p4_found, "p4_report": p4_report, "p5_found": p5_found, "p5_loaded": p5_loaded, "p5_edits": p5_edits}

_TAG_REFERENCE = """
SELECT '{table}' AS ref_table, '{field}' AS ref_field, coalesce(strftime(r.created_at, '%Y-%m'), 'unknown') AS period, r.tag_id, CAST(r.{field} AS VARCHAR) AS missing_key
FROM {table} r LEFT JOIN have h ON h.tag_id = r.{field}
WHERE r.{field} IS NOT NULL AND (h.tag_id IS NULL OR (r.created_at IS NOT NULL AND h.since > strftime(r.created_at, '%Y-%m')))"""

_ORPHANS = (
    "WITH have AS (SELECT tag_id, min(coalesce(strftime(created_at, '%Y-%m'), '0000-00')) AS since FROM tags GROUP BY tag_id), found AS ("
    + " UNION ".join(_TAG_REFERENCE.format(table=t, field=f) for t, f in (("tag_status", "preferred_tag_id"), ("tag_usage_counts", "tag_id"), ("tag_translations", "tag_id")))
    + """ UNION
SELECT 'tag_status', 'type_id', coalesce(strftime(created_at, '%Y-%m'), 'unknown'), tag_id, format_id || ':' || type_id
FROM tag_status s WHERE type_id <> -1 AND NOT EXISTS (SELECT 1 FROM tag_type_format_mapping m WHERE m.format_id = s.format_id AND m.type_id = s.type_id))
"""
)

_LINES = r"""
WITH head AS (SELECT file_name, string_split(raw_line, ',') AS header FROM csv_lines WHERE line_no = 1),
body AS (SELECT l.line_id, coalesce(l.raw_line, '') AS raw, h.header FROM csv_lines l LEFT JOIN head h USING (file_name) WHERE l.line_no <> 1),
cut AS (SELECT *, regexp_full_match(raw, '(?s)(?:"(?:[^"]|"")*"|[^",]*)(?:,(?:"(?:[^"]|"")*"|[^",]*))*') AS quoted_well,
  list_transform(regexp_extract_all(',' || raw, '(?s),("(?:[^"]|"")*"|[^",]*)', 1),
    lambda x: CASE WHEN x LIKE '"%' THEN replace(substr(x, 2, length(x) - 2), '""', '"') ELSE x END) AS fields FROM body),
named AS (SELECT *, fields[nullif(list_position(header, 'source_tag'), 0)] AS source_tag, fields[nullif(list_position(header, 'type_id'), 0)] AS type_id,
  fields[nullif(list_position(header, 'count'), 0)] AS n, fields[nullif(list_position(header, 'format_id'), 0)] AS format_id FROM cut),
judged AS (SELECT *, CASE WHEN NOT quoted_well THEN 'quoting' WHEN len(fields) <> len(header) THEN 'column_count'
  WHEN regexp_full_match(source_tag, '(?s)[\s\pZ\x0b\x1c-\x1f\x{85}]*') OR regexp_matches(source_tag, '[\x00-\x1f\x7f\x{FFFD}]')
    OR NOT regexp_full_match(coalesce(type_id, ''), '[0-9]*') OR NOT regexp_full_match(coalesce(n, ''), '[0-9]*') OR NOT regexp_full_match(coalesce(format_id, ''), '[0-9]*')
  THEN 'invalid_value' END AS reason FROM named)
"""

SQL = {
    "p4_found": _ORPHANS + "SELECT * FROM found",
    "p4_report": _ORPHANS + "SELECT ref_table, ref_field, period, count(*) AS n_rows, count(DISTINCT missing_key) AS n_keys FROM found GROUP BY ALL",
    "p5_found": _LINES + "SELECT line_id, reason FROM judged WHERE reason IS NOT NULL",
    "p5_loaded": _LINES
    + "SELECT line_id, source_tag, TRY_CAST(type_id AS BIGINT) AS type_id, TRY_CAST(n AS BIGINT) AS count, TRY_CAST(format_id AS BIGINT) AS format_id FROM judged WHERE reason IS NULL",
}
