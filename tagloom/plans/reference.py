"""Registered queries of the tag database's own operators, each over its whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.functions import lang, text
from tagloom.operators import clean, merge, register, repair
from tagloom.plans import views
from tagloom.tables import load

QUERIES = {}
SQL = {}
#: SQL macros written out: outer white space, and the blank test.
_WS = r"[\s\x0b\x1c-\x1f\x{85}\pZ]"


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^{_WS}+|{_WS}+$', '', 'g')"


_FACE = r"[0-9oOxXtTuUvV.\-+;:^<>=_]"
_WORD = r"[a-z0-9][a-z0-9_./:\-]*"


def _kaomoji(s: str) -> str:
    m = lambda p: f"regexp_matches({s}, '{p}')"
    return f"""CASE WHEN {s} = '' OR length({s}) > 24 THEN false WHEN {m(rf'(?i)^{_WORD}_\({_WORD}\)$')} THEN false WHEN {m(rf'(?i)^/{_WORD}/$')} THEN false
 WHEN {m(r'(?i)^[:;=8xX]-?[)D(P/\\|]$')} THEN true WHEN {m(r'^[:;][<>]=?$')} THEN true WHEN {m(rf'^\({_FACE}{{1,5}}(?:_{_FACE}{{1,5}})*\)$')} THEN true
 WHEN {m(r'(?i)^\([a-z0-9_]{2,}\)$')} THEN false WHEN {m(rf'^{_FACE}{{1,3}}(?:_{_FACE}{{1,3}})+$')} AND {m(r'[\^;:<>=oOxX0-9]')} THEN true
 ELSE {m(r'[\^;:<>=]')} AND length(regexp_replace({s}, '[\\pL\\pN]|{_WS}', '', 'g')) >= 2 AND length(regexp_replace({s}, '[^\\pL\\pN]', '', 'g')) <= 3 AND NOT {m(_WS)} END"""


def _escape(x: str) -> str:
    return f"replace(replace(replace(replace({x}, '\\(', '('), '\\)', ')'), '(', '\\('), ')', '\\)')"


def _normalize(x: str) -> str:
    """SQL of the normalised form; x is a column of stripped text."""
    folded = f"replace(translate({x}, '：，．；！？（）［］｛｝／＋＝－＊＆％＃＠＾～｜＜＞　', ':,.;!?()[]{{}}/+=-*&%#@^~|<> '), chr(65340), '\\\\')"
    return _escape(f"CASE WHEN {_kaomoji(x)} THEN {x} ELSE {_strip(f'''replace(lower({folded}), '_', ' ')''')} END")


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _t(spark, d, *names):
    return [load(spark, d, n) for n in names]


# --- scalar functions -------------------------------------------------------


@query(f"WITH s AS (SELECT tag_id, {_strip('source_tag')} AS s FROM tags) SELECT tag_id, {_normalize('s')} AS normalized FROM s")
def normalize_tag(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "tags").select("tag_id", text.normalize_tag(F.col("source_tag")).alias("normalized"))


@query(f"WITH s AS (SELECT tag_id, {_strip('source_tag')} AS s FROM tags) SELECT tag_id, CASE WHEN {_kaomoji('s')} THEN s ELSE lower(s) END AS canonical FROM s")
def canonicalize_tag(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "tags").select("tag_id", text.canonicalize_source_tag(F.col("source_tag")).alias("canonical"))


@query(f"WITH s AS (SELECT tag_id, {_strip('source_tag')} AS s FROM tags) SELECT tag_id, coalesce({_kaomoji('s')}, false) AS kaomoji FROM s")
def is_kaomoji(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "tags").select("tag_id", text.is_kaomoji(F.col("source_tag")).alias("kaomoji"))


@query(f"SELECT alias_index, {_escape('alias')} AS escaped FROM tag_aliases")
def escape_parens(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "tag_aliases").select("alias_index", text.escape_parens(F.col("alias")).alias("escaped"))


_TRIM = r"[ \"''“”‘’「」]"
_SPLIT = f"list_filter(list_transform(regexp_split_to_array(translation, '[,，、､﹐]'), lambda x: regexp_replace({_strip('x')}, '^{_TRIM}+|{_TRIM}+$', '', 'g')), lambda x: x <> '')"


@query(f"SELECT translation_id, array_to_string({_SPLIT}, chr(31)) AS names FROM tag_translations WHERE translation IS NOT NULL")
def split_translations(spark: SparkSession, d: str) -> DataFrame:
    names = F.array_join(text.split_translations(F.col("translation")), "\x1f")
    return load(spark, d, "tag_translations").where("translation is not null").select("translation_id", names.alias("names"))


def _language(c: str) -> str:
    low = f"lower({_strip(c)})"
    whens = "".join(f" WHEN {low} LIKE '%\\{s}' ESCAPE '\\' THEN '{code}'" for s, code in (("_jp", "ja"), ("_ja", "ja"), ("_ru", "ru"), ("_ko", "ko"), ("_zh", "zh")))
    whens += f" WHEN {low} IN ('ja', 'en', 'zh', 'ko', 'fr', 'de', 'es', 'ru', 'pt', 'it', 'vi', 'th', 'zh-cn', 'zh-hk') THEN {low}"
    whens += f" WHEN {low} = 'japanese' THEN 'ja' WHEN {low} = 'english' THEN 'en' WHEN {low} = 'chinese' THEN 'zh' WHEN {low} = 'korean' THEN 'ko' WHEN {low} = 'french' THEN 'fr' WHEN {low} = 'german' THEN 'de' WHEN {low} = 'spanish' THEN 'es' WHEN {low} = 'russian' THEN 'ru'"
    return f"CASE WHEN {_strip(c)} = '' THEN '' WHEN {low} LIKE 'trans\\_%' ESCAPE '\\' THEN substr({_strip(c)}, 7) {whens} ELSE substr({low}, 1, 2) END"


@query(f"SELECT {_language('language')} AS code, count(*) AS n_rows FROM tag_translations WHERE language IS NOT NULL GROUP BY 1")
def infer_language(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "tag_translations").where("language is not null").groupBy(lang.infer_language(F.col("language")).alias("code")).agg(F.count("*").alias("n_rows"))


_PREFIX = "(?:general|artist|copyright|character|species|invalid|meta|lore):"


@query(f"SELECT tag_id, nullif({_strip(f'''regexp_extract(tag, '(?s)^{_PREFIX}(.*)$', 1)''')}, '') AS base FROM (SELECT tag_id, 'artist:' || tag AS tag FROM tags UNION ALL SELECT tag_id, tag FROM tags)")
def strip_prefix(spark: SparkSession, d: str) -> DataFrame:
    tags = load(spark, d, "tags").select("tag_id", "tag")
    both = tags.select("tag_id", F.concat(F.lit("artist:"), "tag").alias("tag")).unionByName(tags)
    return both.select("tag_id", text.strip_category_prefix(F.col("tag")).alias("base"))


@query(r"SELECT line_id, regexp_replace(regexp_extract(file_name, '_(\d{8})', 1), '(\d{4})(\d{2})(\d{2})', '\1-\2-\3 00:00:00+00:00') AS stamp FROM csv_lines")
def date_from_file_name(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "csv_lines").select("line_id", text.date_from_file_name(F.col("file_name")).alias("stamp"))


@query("SELECT site_row_id, CASE WHEN count >= 0 THEN count END AS n, coalesce(type_id, -1) AS type_id, CASE WHEN trim(source_updated_at) <> '' THEN source_updated_at END AS updated FROM site_tags")
def clean_site_rows(spark: SparkSession, d: str) -> DataFrame:
    rows = load(spark, d, "site_tags")
    return rows.select("site_row_id", text.clean_count(F.col("count")).alias("n"), F.coalesce("type_id", F.lit(-1)).alias("type_id"), text.blank_to_null(F.col("source_updated_at")).alias("updated"))


def _signals(table: str, column: str) -> str:
    v = _strip(column)
    return f"""WITH s AS (SELECT {v} AS s FROM {table} WHERE {v} <> ''), a AS (SELECT count(*) AS n_values, avg(CAST(contains(s, '_') AS INT)) AS underscore,
 avg(CAST(regexp_matches(s, '\\\\[()]') AS INT)) AS escaped_paren, avg(CAST({_normalize('s')} <> s AS INT)) AS normalize_change FROM s),
 b AS (SELECT *, CAST(underscore >= 0.7 AS INT) + CAST(normalize_change >= 0.5 AS INT) AS src, CAST(underscore <= 0.1 AS INT) + CAST(escaped_paren >= 0.3 AS INT) + CAST(normalize_change <= 0.1 AS INT) AS nrm FROM a)
 SELECT '{table}' AS table_name, n_values, underscore, escaped_paren, normalize_change, CASE WHEN src >= 2 THEN 'source' WHEN nrm >= 2 THEN 'normalized' ELSE 'unknown' END AS decision,
 CASE WHEN src >= 2 THEN 'medium' WHEN nrm >= 3 THEN 'high' WHEN nrm >= 2 THEN 'medium' ELSE 'low' END AS confidence FROM b"""


@query(f"SELECT * FROM ({_signals('site_tags', 'source_tag')}) UNION ALL SELECT * FROM ({_signals('tags', 'tag')})")
def classify_column(spark: SparkSession, d: str) -> DataFrame:
    parts = [views.classify_column(load(spark, d, t), c).select(F.lit(t).alias("table_name"), "*") for t, c in (("site_tags", "source_tag"), ("tags", "tag"))]
    return parts[0].unionByName(parts[1])


_SITE = ("site_row_id", "source_tag", "format_id", "type_id", "count", "deprecated_tags", "deprecated", "deprecated_at", "source_created_at", "source_updated_at")


@query(" UNION ALL ".join(f"SELECT '{c}' AS column_name, avg(CAST({c} IS NULL AS INT)) AS null_ratio FROM site_tags" for c in _SITE))
def null_ratios(spark: SparkSession, d: str) -> DataFrame:
    return views.null_ratios(load(spark, d, "site_tags"))


# --- translations -----------------------------------------------------------

_HAN = r"\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{F900}-\x{FAFF}"
_RANGES = {"ja": rf"[\x{{3040}}-\x{{30FF}}{_HAN}]", "zh": f"[{_HAN}]", "ko": r"[\x{AC00}-\x{D7A3}]"}


@query(
    "SELECT translation_id, language, translation FROM tag_translations WHERE NOT coalesce("
    + " OR ".join(f"(language = '{k}' AND translation <> '' AND NOT regexp_matches(translation, '{v}'))" for k, v in _RANGES.items())
    + ", false)"
)
def script_filter(spark: SparkSession, d: str) -> DataFrame:
    return clean.script_filter(load(spark, d, "tag_translations")).select("translation_id", "language", "translation")


@query(r"SELECT translation_id, language FROM tag_translations WHERE NOT coalesce(language IN ('ja', 'ko', 'zh') AND regexp_matches(translation, '^[\x00-\x7F]+$'), false)")
def ascii_filter(spark: SparkSession, d: str) -> DataFrame:
    return clean.ascii_filter(load(spark, d, "tag_translations"), ("ja", "ko", "zh")).select("translation_id", "language")


@query(
    """SELECT translation_id FROM tag_translations t WHERE NOT EXISTS (SELECT 1 FROM tags g WHERE t.language = 'ja' AND g.tag = t.translation)"""
)
def delete_values(spark: SparkSession, d: str) -> DataFrame:
    values = load(spark, d, "tags").where("tag is not null").select(F.col("tag").alias("translation"))
    return clean.delete_values(load(spark, d, "tag_translations"), values).select("translation_id")


@query(
    f"""WITH long AS (SELECT translation_id, tag_id, language, unnest(CASE WHEN regexp_matches(translation, '[,，、､﹐]') THEN {_SPLIT} ELSE [translation] END) AS name,
 generate_subscripts(CASE WHEN regexp_matches(translation, '[,，、､﹐]') THEN {_SPLIT} ELSE [translation] END, 1) AS pos FROM tag_translations WHERE translation IS NOT NULL)
 SELECT tag_id, language, name AS translation, min(translation_id) AS translation_id FROM long GROUP BY tag_id, language, name"""
)
def split_translation_rows(spark: SparkSession, d: str) -> DataFrame:
    return clean.split_values(load(spark, d, "tag_translations")).select("tag_id", "language", "translation", "translation_id")


# --- registration and aliases ----------------------------------------------


def _stored(x: str) -> str:
    return f"CASE WHEN {_kaomoji(x)} THEN {x} ELSE lower({x}) END"


_LIST = f"list_filter(list_transform(string_split(coalesce(deprecated_tags, ''), ','), lambda x: {_strip('x')}), lambda x: x <> '')"
_NEW = f"""WITH raw AS (SELECT {_strip('source_tag')} AS s FROM site_tags UNION SELECT unnest({_LIST}) FROM site_tags),
stored AS (SELECT DISTINCT {_stored('s')} AS source_tag FROM raw WHERE s <> ''), named AS (SELECT source_tag, {_normalize('source_tag')} AS tag FROM stored),
fresh AS (SELECT tag, min(source_tag) AS source_tag FROM named n WHERE tag <> '' AND NOT EXISTS (SELECT 1 FROM tags t WHERE t.tag = n.tag) GROUP BY tag),
registered AS (SELECT (SELECT max(tag_id) FROM tags) + row_number() OVER (ORDER BY tag) AS tag_id, source_tag, tag FROM fresh)
"""


@query(_NEW + "SELECT * FROM registered")
def register_tags(spark: SparkSession, d: str) -> DataFrame:
    return register.register(*_t(spark, d, "tags", "site_tags"))


_EXPAND = f"""WITH idx AS (SELECT tag, min(tag_id) AS tag_id FROM tags WHERE tag IS NOT NULL GROUP BY tag),
base AS (SELECT format_id, coalesce(type_id, -1) AS type_id, deprecated, {_LIST} AS names, {_normalize('s')} AS tag FROM (SELECT *, {_strip('source_tag')} AS s FROM site_tags)),
known AS (SELECT b.*, i.tag_id AS preferred_tag_id FROM base b JOIN idx i USING (tag)),
names AS (SELECT format_id, preferred_tag_id, type_id, unnest(names) AS name FROM known)
"""


@query(
    _EXPAND
    + f"""SELECT DISTINCT format_id, preferred_tag_id AS tag_id, preferred_tag_id, 0 AS alias, type_id, CAST(coalesce(deprecated, 0) AS INT) AS deprecated FROM known
UNION SELECT n.format_id, i.tag_id, n.preferred_tag_id, 1, n.type_id, 1 FROM (SELECT *, {_normalize('name')} AS tag FROM names) n JOIN idx i USING (tag) WHERE i.tag_id <> n.preferred_tag_id"""
)
def expand_aliases(spark: SparkSession, d: str) -> DataFrame:
    tags, rows = _t(spark, d, "tags", "site_tags")
    return register.expand_aliases(rows, register.tag_index(tags))


@query(
    f"""WITH names AS (SELECT unnest({_LIST}) AS alias FROM site_tags) SELECT alias, count(*) AS n_rows FROM (SELECT alias, {_normalize('alias')} AS tag FROM names) n
 WHERE NOT EXISTS (SELECT 1 FROM tags t WHERE t.tag = n.tag) GROUP BY alias"""
)
def unknown_aliases(spark: SparkSession, d: str) -> DataFrame:
    tags, rows = _t(spark, d, "tags", "site_tags")
    return register.unknown_aliases(rows, register.tag_index(tags))


_CANDS = "WITH cands AS (SELECT format_id, alias, tag, min(alias_index) AS first FROM tag_aliases GROUP BY ALL), chosen AS (SELECT format_id, alias, arg_min(tag, first) AS tag, count(*) AS n_candidates FROM cands GROUP BY ALL)"


@query(_CANDS + " SELECT format_id, alias, tag, 'first-win' AS reason, n_candidates FROM chosen")
def resolve_aliases(spark: SparkSession, d: str) -> DataFrame:
    return register.resolve_aliases(load(spark, d, "tag_aliases"))


@query(_CANDS + " SELECT c.format_id, c.alias, h.tag AS selected, c.tag AS rejected, 'first-win' AS reason FROM cands c JOIN chosen h USING (format_id, alias) WHERE c.tag <> h.tag")
def alias_conflicts(spark: SparkSession, d: str) -> DataFrame:
    return register.alias_conflicts(load(spark, d, "tag_aliases"))


_OVER = ", over AS (SELECT format_id, alias, max(tag) AS canonical FROM tag_aliases GROUP BY ALL HAVING count(DISTINCT tag) > 1)"


def _overrides(aliases: DataFrame) -> DataFrame:
    """A stand-in for a file of human decisions: the greatest target of each contested alias."""
    return aliases.groupBy("format_id", "alias").agg(F.max("tag").alias("canonical"), F.countDistinct("tag").alias("n")).where("n > 1").drop("n")


@query(
    _CANDS + _OVER + " SELECT c.format_id, c.alias, coalesce(o.canonical, c.tag) AS tag, CASE WHEN o.canonical IS NULL THEN 'first-win' ELSE 'override' END AS reason, c.n_candidates FROM chosen c LEFT JOIN over o USING (format_id, alias)"
)
def override_aliases(spark: SparkSession, d: str) -> DataFrame:
    aliases = load(spark, d, "tag_aliases")
    return register.resolve_aliases(aliases, _overrides(aliases))


@query(_CANDS + " SELECT DISTINCT format_id, tag, alias FROM chosen WHERE tag NOT IN ('invalid_tag', 'bad_tag') AND alias <> tag")
def aliases_of(spark: SparkSession, d: str) -> DataFrame:
    return register.aliases_of(load(spark, d, "tag_aliases"))


# --- merges -------------------------------------------------------------------

_ATTRS = ["type_id", "alias", "preferred_tag_id", "deprecated"]


@query(
    """SELECT tag_id, format_id, type_id, alias, preferred_tag_id, deprecated FROM tag_status QUALIFY row_number() OVER (PARTITION BY tag_id, format_id
 ORDER BY updated_at DESC NULLS LAST, created_at DESC NULLS LAST, type_id DESC, alias DESC, preferred_tag_id DESC, deprecated DESC) = 1"""
)
def upsert_status(spark: SparkSession, d: str) -> DataFrame:
    return merge.last_wins(load(spark, d, "tag_status"), ["tag_id", "format_id"], ["updated_at", "created_at"], _ATTRS)


@query(
    """WITH w AS (SELECT *, lag(ROW(type_id, alias, preferred_tag_id, deprecated)) OVER k AS prev, row_number() OVER k AS rn FROM
 (SELECT * FROM tag_status UNION ALL SELECT * REPLACE (type_id + 1 AS type_id, updated_at + INTERVAL 1 DAY AS updated_at) FROM tag_status WHERE deprecated = 1)
 WINDOW k AS (PARTITION BY tag_id, format_id ORDER BY created_at NULLS FIRST, updated_at NULLS FIRST, type_id, alias, preferred_tag_id, deprecated))
 SELECT count(*) AS changes FROM w WHERE rn = 1 OR prev IS DISTINCT FROM ROW(type_id, alias, preferred_tag_id, deprecated)"""
)
def status_changes(spark: SparkSession, d: str) -> DataFrame:
    rows = load(spark, d, "tag_status")
    later = rows.where("deprecated = 1").withColumns({"type_id": F.col("type_id") + 1, "updated_at": F.col("updated_at") + F.expr("INTERVAL 1 DAY")})
    return merge.effective_updates(rows.unionByName(later), ["tag_id", "format_id"], _ATTRS, "created_at", ["updated_at", *_ATTRS])


@query(
    """SELECT tag_id, format_id, count, created_at, updated_at FROM tag_usage_counts WHERE count IS NOT NULL QUALIFY row_number() OVER (PARTITION BY tag_id, format_id
 ORDER BY count DESC, created_at NULLS FIRST, updated_at NULLS FIRST) = 1"""
)
def upsert_usage(spark: SparkSession, d: str) -> DataFrame:
    return merge.greatest_wins(load(spark, d, "tag_usage_counts"), ["tag_id", "format_id"], "count", ["created_at", "updated_at"], ["created_at", "updated_at"])


@query(
    """WITH w AS (SELECT count, max(count) OVER (PARTITION BY tag_id, format_id ORDER BY created_at NULLS FIRST, updated_at NULLS FIRST, count ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top
 FROM tag_usage_counts WHERE count IS NOT NULL) SELECT count(*) AS changes FROM w WHERE top IS NULL OR count > top"""
)
def usage_changes(spark: SparkSession, d: str) -> DataFrame:
    return merge.effective_raises(load(spark, d, "tag_usage_counts"), ["tag_id", "format_id"], "count", "created_at", ["updated_at", "count"])


@query(
    """WITH k AS (SELECT tag_id, language, translation, min(translation_id) AS translation_id FROM tag_translations WHERE created_at IS NULL OR created_at >= TIMESTAMP '2022-01-01' GROUP BY ALL)
 SELECT * FROM k WHERE NOT EXISTS (SELECT 1 FROM tag_translations o WHERE o.created_at < TIMESTAMP '2022-01-01' AND o.tag_id = k.tag_id AND o.language IS NOT DISTINCT FROM k.language AND o.translation IS NOT DISTINCT FROM k.translation)"""
)
def insert_translations(spark: SparkSession, d: str) -> DataFrame:
    rows = load(spark, d, "tag_translations").select("tag_id", "language", "translation", "translation_id", "created_at")
    old, new = rows.where("created_at < timestamp '2022-01-01'"), rows.where("created_at is null or created_at >= timestamp '2022-01-01'")
    return merge.insert_or_ignore(old.drop("created_at"), new.drop("created_at"), ["tag_id", "language", "translation"], ["translation_id"])


_MAXED = "SELECT tag_id, format_id, max(count) AS count FROM tag_usage_counts GROUP BY ALL"


@query(f"WITH m AS ({_MAXED}) SELECT * FROM m WHERE format_id <> 1 UNION ALL SELECT tag_id, 1, 7 FROM tags")
def replace_snapshot(spark: SparkSession, d: str) -> DataFrame:
    usage, tags = _t(spark, d, "tag_usage_counts", "tags")
    state = usage.groupBy("tag_id", "format_id").agg(F.max("count").alias("count"))
    snapshot = tags.select("tag_id", F.lit(1).cast("long").alias("format_id"), F.lit(7).cast("long").alias("count"))
    return merge.replace_snapshot(state, snapshot, F.col("format_id") == 1)


@query("SELECT tag_id, format_id, max(count) AS count FROM (SELECT tag_id, format_id, count FROM tag_usage_counts UNION ALL SELECT t.tag_id, s.format_id, s.count FROM site_tags s JOIN (SELECT tag, min(tag_id) AS tag_id FROM tags GROUP BY tag) t ON t.tag = s.source_tag) GROUP BY ALL")
def max_merge(spark: SparkSession, d: str) -> DataFrame:
    usage, site, tags = _t(spark, d, "tag_usage_counts", "site_tags", "tags")
    site = site.join(register.tag_index(tags).withColumnRenamed("tag", "source_tag"), "source_tag")
    return merge.max_merge(usage, site, ["tag_id", "format_id"], "count")


@query(
    """SELECT tag_id, alias, preferred_tag_id, format_id FROM tag_status QUALIFY row_number() OVER (PARTITION BY tag_id
 ORDER BY alias, CASE WHEN alias = 1 THEN preferred_tag_id ELSE 0 END, created_at NULLS FIRST, format_id, preferred_tag_id) = 1"""
)
def fold_duplicates(spark: SparkSession, d: str) -> DataFrame:
    return merge.fold_duplicates(load(spark, d, "tag_status"), ["tag_id"], ["created_at", "format_id"], ["alias", "preferred_tag_id", "format_id"]).select("tag_id", "alias", "preferred_tag_id", "format_id")


# --- repairs -------------------------------------------------------------------


@query(
    """WITH u AS (SELECT format_id, type_id, count(*) AS n_rows FROM tag_status GROUP BY ALL), top AS (SELECT max(type_name_id) AS t FROM tag_type_format_mapping)
 SELECT format_id, type_id, CASE WHEN type_id BETWEEN 0 AND t THEN type_id ELSE 0 END AS type_name_id, n_rows, CASE WHEN type_id BETWEEN 0 AND t THEN 'type_id_as_type_name_id' ELSE 'fallback_unknown' END AS reason
 FROM u, top WHERE NOT EXISTS (SELECT 1 FROM tag_type_format_mapping m WHERE m.format_id = u.format_id AND m.type_id = u.type_id)"""
)
def missing_mappings(spark: SparkSession, d: str) -> DataFrame:
    return repair.missing_mappings(*_t(spark, d, "tag_status", "tag_type_format_mapping"))


def _prefixed(tags: DataFrame) -> DataFrame:
    """Tags of which every one with a bracket carries a category prefix, which its length chooses: the tables hold none of their own."""
    prefix = F.element_at(F.array(*(F.lit(f"{p}:") for p in ("general", "artist", "copyright", "character", "species", "invalid", "meta", "lore"))), (F.length("tag") % 8 + 1).cast("int"))
    return tags.select("tag_id", F.when(F.col("tag").contains("("), F.concat(prefix, F.regexp_extract("tag", r"^([^ ]*)", 1))).otherwise(F.col("tag")).alias("tag"))


def _base(c: str) -> str:
    return f"regexp_extract({c}, '(?s)^{_PREFIX}(.*)$', 1)"


_PTAGS = "WITH p AS (SELECT tag_id, CASE WHEN contains(tag, '(') THEN ['general:', 'artist:', 'copyright:', 'character:', 'species:', 'invalid:', 'meta:', 'lore:'][length(tag) % 8 + 1] || regexp_extract(tag, '^([^ ]*)', 1) ELSE tag END AS tag FROM tags), idx AS (SELECT tag, min(tag_id) AS tag_id FROM p WHERE tag IS NOT NULL GROUP BY tag)"


@query(
    _PTAGS
    + f""", r AS (SELECT DISTINCT s.tag_id, s.format_id, s.alias, s.preferred_tag_id, o.tag AS own, t.tag AS target FROM tag_status s
 LEFT JOIN p o ON o.tag_id = s.tag_id AND regexp_matches(o.tag, '^{_PREFIX}') LEFT JOIN p t ON t.tag_id = s.preferred_tag_id AND regexp_matches(t.tag, '^{_PREFIX}') WHERE s.format_id <> 2 AND (o.tag IS NOT NULL OR t.tag IS NOT NULL)),
 f AS (SELECT r.*, i.tag_id AS base_id FROM (SELECT *, coalesce(nullif({_strip(_base('target'))}, ''), nullif({_strip(_base('own'))}, '')) AS base FROM r) r LEFT JOIN idx i ON i.tag = r.base)
 SELECT tag_id, format_id, CAST(CASE WHEN base_id IS NULL THEN alias WHEN base_id = tag_id THEN 0 ELSE 1 END AS INT) AS alias, coalesce(base_id, preferred_tag_id) AS preferred_tag_id,
 CASE WHEN base_id IS NULL THEN 'base_tag_not_found' ELSE 'prefix_to_base' END AS reason FROM f
 WHERE base_id IS NULL OR (CASE WHEN base_id = tag_id THEN 0 ELSE 1 END) <> alias OR base_id <> preferred_tag_id"""
)
def prefix_to_base(spark: SparkSession, d: str) -> DataFrame:
    tags, status = _t(spark, d, "tags", "tag_status")
    tags = _prefixed(tags)
    return repair.prefix_to_base(status, tags, register.tag_index(tags)).withColumn("alias", F.col("alias").cast("int"))


@query(
    _PTAGS
    + f""", c AS (SELECT tag_id, tag, nullif({_strip(_base('tag'))}, '') AS new_tag FROM p WHERE regexp_matches(tag, '^{_PREFIX}'))
 SELECT min(tag_id) AS tag_id, arg_min(tag, tag_id) AS tag, new_tag FROM c WHERE new_tag IS NOT NULL AND new_tag NOT IN (SELECT tag FROM p WHERE tag IS NOT NULL) GROUP BY new_tag"""
)
def rename_orphans(spark: SparkSession, d: str) -> DataFrame:
    return repair.rename_orphans(_prefixed(load(spark, d, "tags")))


@query(
    _PTAGS
    + f""", c AS (SELECT tag_id, nullif({_strip(_base('tag'))}, '') AS new_tag FROM p WHERE regexp_matches(tag, '^{_PREFIX}')),
 w AS (SELECT min(tag_id) AS tag_id, new_tag FROM c WHERE new_tag IS NOT NULL AND new_tag NOT IN (SELECT tag FROM p WHERE tag IS NOT NULL) GROUP BY new_tag)
 SELECT p.tag_id, coalesce(w.new_tag, p.tag) AS tag FROM p LEFT JOIN w USING (tag_id)"""
)
def renamed_tags(spark: SparkSession, d: str) -> DataFrame:
    """The tags after the renaming of orphan prefixed ones."""
    return repair.rename_to_base(_prefixed(load(spark, d, "tags")))[0]


_REMAP = "WITH f AS (SELECT tag, min(tag_id) AS canonical_id FROM tags WHERE tag IS NOT NULL GROUP BY tag), m AS (SELECT t.tag_id, f.canonical_id FROM tags t JOIN f USING (tag) WHERE t.tag_id <> f.canonical_id)"


@query(_REMAP + " SELECT * FROM m")
def remap_duplicates(spark: SparkSession, d: str) -> DataFrame:
    return repair.remap_duplicates(load(spark, d, "tags"))


@query(_REMAP + " SELECT coalesce(a.canonical_id, s.tag_id) AS tag_id, s.format_id, coalesce(b.canonical_id, s.preferred_tag_id) AS preferred_tag_id, count(*) AS n_rows FROM tag_status s LEFT JOIN m a ON a.tag_id = s.tag_id LEFT JOIN m b ON b.tag_id = s.preferred_tag_id GROUP BY 1, 2, 3")
def apply_remap(spark: SparkSession, d: str) -> DataFrame:
    tags, status = _t(spark, d, "tags", "tag_status")
    out = repair.apply_remap(status.select("tag_id", "format_id", "preferred_tag_id"), repair.remap_duplicates(tags), ["tag_id", "preferred_tag_id"])
    return out.groupBy("tag_id", "format_id", "preferred_tag_id").agg(F.count("*").alias("n_rows"))


_MARKED_STATUS = "CASE WHEN t.tag IS NULL OR t.tag = '' THEN '__missing_tag_id_' || s.tag_id || '__' ELSE t.tag END"
_MARKED = "CASE WHEN tag IS NULL OR tag = '' THEN '__missing_tag_id_' || tag_id || '__' ELSE tag END"


@query(
    f"""WITH marks AS (SELECT tag_id FROM tags WHERE tag IS NULL OR tag = ''), own AS (SELECT DISTINCT tag_id, format_id, preferred_tag_id FROM tag_status WHERE tag_id IN (FROM marks)),
 taken AS (SELECT DISTINCT tag_id, format_id FROM tag_status),
 judged AS (SELECT o.*, t.tag_id AS taken, row_number() OVER (PARTITION BY o.preferred_tag_id, o.format_id ORDER BY o.tag_id) AS rn FROM own o LEFT JOIN taken t ON t.tag_id = o.preferred_tag_id AND t.format_id = o.format_id),
 counts AS (SELECT u.tag_id, u.format_id, o.preferred_tag_id FROM (SELECT DISTINCT tag_id, format_id FROM tag_usage_counts WHERE tag_id IN (FROM marks)) u LEFT JOIN own o ON o.tag_id = u.tag_id AND o.format_id = u.format_id)
 SELECT tag_id, NULL::BIGINT AS format_id, NULL::BIGINT AS preferred_tag_id, 'delete_placeholder_only' AS action FROM marks WHERE tag_id NOT IN (SELECT tag_id FROM tag_status)
 UNION ALL SELECT tag_id, format_id, preferred_tag_id, CASE WHEN tag_id = preferred_tag_id THEN 'delete_invalid_self_preferred' WHEN taken IS NOT NULL OR rn > 1 THEN 'delete_redundant_status' ELSE 'reassign_status_to_preferred' END FROM judged
 UNION ALL SELECT tag_id, format_id, preferred_tag_id, CASE WHEN preferred_tag_id IS NULL OR preferred_tag_id = tag_id THEN 'delete_usage_count_unmappable' ELSE 'move_usage_count_to_preferred' END FROM counts
 UNION ALL SELECT tag_id, NULL, NULL, 'has_extra_rows_needs_manual' FROM marks WHERE tag_id IN (SELECT tag_id FROM tag_translations)
 UNION ALL SELECT tag_id, NULL, NULL, 'delete_placeholder_after_repair' FROM marks WHERE tag_id IN (SELECT tag_id FROM tag_status) AND tag_id NOT IN (SELECT tag_id FROM tag_translations)"""
)
def placeholder_repair(spark: SparkSession, d: str) -> DataFrame:
    tags, status, usage, told = _t(spark, d, "tags", "tag_status", "tag_usage_counts", "tag_translations")
    blank = F.col("tag").isNull() | (F.col("tag") == "")
    tags = tags.select("tag_id", F.when(blank, F.format_string("__missing_tag_id_%d__", "tag_id")).otherwise(F.col("tag")).alias("tag"))
    return repair.placeholder_repair(tags, status, usage, told)


# --- views and reports -----------------------------------------------------------

_NOW = "now AS (SELECT * FROM tag_status QUALIFY row_number() OVER (PARTITION BY tag_id, format_id ORDER BY updated_at DESC NULLS LAST, created_at DESC NULLS LAST, type_id DESC, alias DESC, preferred_tag_id DESC, deprecated DESC) = 1)"
_KINDS = "kinds(type_name_id, type_name) AS (VALUES " + """(0, 'unknown'), (1, 'general'), (2, 'artist'), (3, 'copyright'), (4, 'character'), (5, 'species'), (6, 'invalid'), (7, 'meta'), (8, 'lore'), (9, 'oc'),
 (10, 'rating'), (11, 'body-type'), (12, 'origin'), (13, 'error'), (14, 'spoiler'), (15, 'content-official'), (16, 'content-fanmade'), (17, 'contributor'), (18, 'organization'), (19, 'deprecated'))"""


@query(
    f"""WITH {_NOW}, {_KINDS}, names AS (SELECT tag_id, tag FROM tags WHERE tag IS NOT NULL),
 canon AS (SELECT DISTINCT n.format_id, n.preferred_tag_id AS tag_id, t.tag, f.format_name FROM now n JOIN names t ON t.tag_id = n.preferred_tag_id JOIN tag_formats f ON f.format_id = n.format_id),
 told AS (SELECT tag_id, {_language('language')} AS kind, translation_id AS ord, translation AS txt FROM tag_translations WHERE translation IS NOT NULL),
 items AS (SELECT n.format_id, n.preferred_tag_id AS tag_id, 'alias' AS kind, n.tag_id AS ord, t.tag AS txt FROM now n JOIN names t ON t.tag_id = n.tag_id WHERE n.alias = 1
   UNION ALL SELECT c.format_id, c.tag_id, o.kind, o.ord, o.txt FROM told o JOIN canon c USING (tag_id) WHERE o.kind IN ('ja', 'zh')),
 lists AS (SELECT format_id, tag_id, ord // 1000000 AS page, string_agg(txt, chr(31) ORDER BY ord, txt) FILTER (kind = 'alias') AS aliases,
   string_agg(txt, chr(31) ORDER BY ord, txt) FILTER (kind = 'ja') AS lang_ja, string_agg(txt, chr(31) ORDER BY ord, txt) FILTER (kind = 'zh') AS lang_zh FROM items GROUP BY 1, 2, 3),
 pairs AS (SELECT format_id, type_id, min(type_name_id) AS type_name_id FROM tag_type_format_mapping GROUP BY 1, 2),
 counts AS (SELECT tag_id, format_id, max(count) AS count FROM tag_usage_counts WHERE count >= 0 GROUP BY 1, 2)
 SELECT c.format_id, c.tag_id, coalesce(l.page, 0) AS page, c.tag, c.format_name, coalesce(k.type_name, 'unknown') AS type_name, u.count,
  coalesce(l.aliases, '') AS aliases, coalesce(l.lang_ja, '') AS lang_ja, coalesce(l.lang_zh, '') AS lang_zh
 FROM canon c LEFT JOIN now o ON o.tag_id = c.tag_id AND o.format_id = c.format_id LEFT JOIN pairs p ON p.format_id = c.format_id AND p.type_id = o.type_id LEFT JOIN kinds k ON k.type_name_id = p.type_name_id
 LEFT JOIN counts u ON u.tag_id = c.tag_id AND u.format_id = c.format_id LEFT JOIN lists l ON l.format_id = c.format_id AND l.tag_id = c.tag_id"""
)
def alias_view(spark: SparkSession, d: str) -> DataFrame:
    names = ("tags", "tag_status", "tag_usage_counts", "tag_translations", "tag_formats", "tag_type_format_mapping")
    out = views.alias_view(*_t(spark, d, *names))
    return out.withColumns({c: F.array_join(c, "\x1f") for c in ("aliases", "lang_ja", "lang_zh")})


@query(
    _PTAGS.replace("WITH p", f"WITH {_NOW}, p", 1)
    + f""", f AS (SELECT n.tag_id, n.format_id, n.type_id, n.alias, n.preferred_tag_id, CASE WHEN n.format_id <> 2 THEN coalesce(nullif({_strip(_base('t.tag'))}, ''), nullif({_strip(_base('o.tag'))}, '')) END AS base
 FROM now n LEFT JOIN p o ON o.tag_id = n.tag_id LEFT JOIN p t ON t.tag_id = n.preferred_tag_id)
 SELECT f.tag_id, f.format_id, f.type_id, CAST(CASE WHEN i.tag_id IS NULL THEN f.alias WHEN i.tag_id = f.tag_id THEN 0 ELSE 1 END AS INT) AS alias, coalesce(i.tag_id, f.preferred_tag_id) AS preferred_tag_id
 FROM f LEFT JOIN idx i ON i.tag = f.base"""
)
def turned_status(spark: SparkSession, d: str) -> DataFrame:
    """The status rows after those of prefixed tags were turned to the tags without prefix."""
    tags, status = _t(spark, d, "tags", "tag_status")
    tags = _prefixed(tags)
    now = views.current_status(status).select("tag_id", "format_id", "type_id", "alias", "preferred_tag_id")
    return repair.turn_to_base(now, tags, register.tag_index(tags))[0].withColumn("alias", F.col("alias").cast("int"))


def _total(name: str, rest: str) -> str:
    return f"SELECT '{name}' AS metric, count(*) AS value FROM {rest}"


_NO_TAG = "{t} x WHERE x.{c} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM tags t WHERE t.tag_id = x.{c})"
_NO_PAIR = "NOT EXISTS (SELECT 1 FROM tag_type_format_mapping m WHERE m.format_id = s.format_id AND m.type_id = s.type_id)"


@query(
    " UNION ALL ".join(
        [
            _total("total_tags", "tags"),
            _total("total_tag_status", "tag_status"),
            _total("total_translations", "tag_translations"),
            _total("total_usage_counts", "tag_usage_counts"),
            "SELECT 'foreign_key_violations', CAST(sum(n) AS BIGINT) FROM ("
            + " UNION ALL ".join(
                [f"SELECT count(*) AS n FROM {_NO_TAG.format(t=t, c=c)}" for t, c in (("tag_status", "tag_id"), ("tag_status", "preferred_tag_id"), ("tag_usage_counts", "tag_id"), ("tag_translations", "tag_id"))]
                + [f"SELECT count(*) FROM {t} WHERE format_id NOT IN (SELECT format_id FROM tag_formats)" for t in ("tag_status", "tag_usage_counts")]
                + [f"SELECT count(*) FROM tag_status s WHERE {_NO_PAIR}"]
            )
            + ")",
            _total("missing_type_format_mapping_pairs", f"(SELECT DISTINCT format_id, type_id FROM tag_status s WHERE {_NO_PAIR})"),
            _total("orphan_tag_status", _NO_TAG.format(t="tag_status", c="tag_id")),
            _total("orphan_usage_counts", _NO_TAG.format(t="tag_usage_counts", c="tag_id")),
            _total("orphan_translations", _NO_TAG.format(t="tag_translations", c="tag_id")),
            _total("duplicate_tags", "(SELECT tag FROM tags WHERE tag IS NOT NULL GROUP BY tag HAVING count(*) > 1)"),
            _total("duplicate_tag_status", "(SELECT tag_id FROM tag_status GROUP BY tag_id, format_id HAVING count(*) > 1)"),
            _total("alias_inconsistencies", "tag_status WHERE alias = 0 AND preferred_tag_id <> tag_id"),
            _total("bad_usage_counts", "tag_usage_counts WHERE count IS NULL OR count < 0"),
        ]
    )
)
def health_summary(spark: SparkSession, d: str) -> DataFrame:
    return views.health(*_t(spark, d, "tags", "tag_status", "tag_usage_counts", "tag_translations", "tag_type_format_mapping", "tag_formats"))


@query("SELECT f.format_id, f.format_name, count(DISTINCT s.tag_id) AS n_tags FROM tag_formats f LEFT JOIN tag_status s USING (format_id) GROUP BY ALL")
def format_statistics(spark: SparkSession, d: str) -> DataFrame:
    return views.format_statistics(*_t(spark, d, "tag_status", "tag_formats"))


_OLD_NEW = """WITH o AS (SELECT t.tag, s.format_id, s.type_id, s.alias FROM tag_status s JOIN tags t USING (tag_id) WHERE s.created_at < TIMESTAMP '2022-01-01' OR s.created_at IS NULL),
 n AS (SELECT t.tag, s.format_id, s.type_id, s.alias FROM tag_status s JOIN tags t USING (tag_id) WHERE s.created_at >= TIMESTAMP '2022-01-01')"""


@query(
    _OLD_NEW
    + """ SELECT DISTINCT o.tag, o.format_id, 'type_id' AS kind, o.type_id AS old_value, n.type_id AS new_value FROM o JOIN n USING (tag, format_id) WHERE o.type_id <> n.type_id
 UNION ALL SELECT DISTINCT o.tag, o.format_id, 'alias', CAST(o.alias AS BIGINT), CAST(n.alias AS BIGINT) FROM o JOIN n USING (tag, format_id) WHERE o.alias = 0 AND n.alias = 1"""
)
def detect_conflicts(spark: SparkSession, d: str) -> DataFrame:
    tags, status = _t(spark, d, "tags", "tag_status")
    rows = status.join(tags.select("tag_id", "tag"), "tag_id").select("tag", "format_id", "type_id", "alias", "created_at")
    return views.detect_conflicts(rows.where("created_at < timestamp '2022-01-01' or created_at is null"), rows.where("created_at >= timestamp '2022-01-01'"))


@query(
    f"""WITH r AS (SELECT s.*, {_MARKED_STATUS} AS tag_key FROM tag_status s LEFT JOIN tags t ON t.tag_id = s.tag_id)
 SELECT tag_key, format_id, count(*) AS n_rows, count(DISTINCT type_id) AS n_types, count(DISTINCT alias) AS n_aliases, count(DISTINCT preferred_tag_id) AS n_preferred FROM r GROUP BY ALL
 HAVING count(DISTINCT type_id) > 1 OR count(DISTINCT alias) > 1 OR count(DISTINCT preferred_tag_id) > 1"""
)
def status_conflicts(spark: SparkSession, d: str) -> DataFrame:
    return views.status_conflicts(*_t(spark, d, "tag_status", "tags"))


@query(
    f"""WITH r AS (SELECT s.*, {_MARKED_STATUS} AS tag_key, t.tag IS NULL OR t.tag = '' AS tag_missing FROM tag_status s LEFT JOIN tags t ON t.tag_id = s.tag_id),
 k AS (SELECT tag_key, format_id FROM r GROUP BY ALL HAVING count(DISTINCT type_id) > 1 OR count(DISTINCT alias) > 1 OR count(DISTINCT preferred_tag_id) > 1)
 SELECT r.format_id, coalesce(f.format_name, 'unknown') AS format_name, r.tag_key, r.tag_missing, r.tag_id, r.alias, r.type_id, r.preferred_tag_id, p.tag AS preferred_tag
 FROM r JOIN k USING (tag_key, format_id) LEFT JOIN tags p ON p.tag_id = r.preferred_tag_id LEFT JOIN tag_formats f ON f.format_id = r.format_id"""
)
def status_conflict_details(spark: SparkSession, d: str) -> DataFrame:
    return views.status_conflict_details(*_t(spark, d, "tag_status", "tags", "tag_formats"))


@query(
    "".join(
        f"SELECT 'orphan_{t if c == 'tag_id' else c}' AS check, x.{c} AS tag_id, NULL::BIGINT AS format_id, CAST(count(*) AS VARCHAR) AS item FROM {_NO_TAG.format(t=t, c=c)} GROUP BY x.{c} UNION ALL "
        for t, c in (("tag_status", "tag_id"), ("tag_status", "preferred_tag_id"), ("tag_usage_counts", "tag_id"), ("tag_translations", "tag_id"))
    )
    + f"""SELECT DISTINCT 'missing_type_format_mapping', NULL::BIGINT, format_id, CAST(type_id AS VARCHAR) FROM tag_status s WHERE {_NO_PAIR}
 UNION ALL SELECT 'duplicate_tag_status', tag_id, format_id, CAST(count(*) AS VARCHAR) FROM tag_status GROUP BY tag_id, format_id HAVING count(*) > 1
 UNION ALL SELECT 'duplicate_tags', min(tag_id), NULL, tag FROM tags WHERE tag IS NOT NULL GROUP BY tag HAVING count(*) > 1
 UNION ALL SELECT DISTINCT 'alias_inconsistencies', tag_id, format_id, CAST(preferred_tag_id AS VARCHAR) FROM tag_status WHERE alias = 0 AND preferred_tag_id <> tag_id
 UNION ALL SELECT DISTINCT 'bad_usage_counts', tag_id, format_id, CAST(count AS VARCHAR) FROM tag_usage_counts WHERE count IS NULL OR count < 0"""
)
def health_details(spark: SparkSession, d: str) -> DataFrame:
    return views.health_details(*_t(spark, d, "tags", "tag_status", "tag_usage_counts", "tag_translations", "tag_type_format_mapping"))


@query("SELECT tag, min(tag_id) AS tag_id, arg_min(source_tag, tag_id) FILTER (WHERE true) AS source_tag FROM (SELECT tag, tag_id, coalesce(source_tag, chr(0)) AS source_tag FROM tags) GROUP BY tag")
def deduplicated_tags(spark: SparkSession, d: str) -> DataFrame:
    return repair.deduplicate_tags(load(spark, d, "tags").select("tag_id", F.coalesce("source_tag", F.lit("\x00")).alias("source_tag"), "tag"))


@query(
    """WITH u AS (SELECT DISTINCT format_id, type_id FROM tag_status), m AS (SELECT max(type_name_id) AS top FROM tag_type_format_mapping)
 SELECT format_id, type_id, type_name_id FROM tag_type_format_mapping UNION ALL
 SELECT format_id, type_id, CASE WHEN type_id BETWEEN 0 AND top THEN type_id ELSE 0 END FROM u, m WHERE NOT EXISTS (SELECT 1 FROM tag_type_format_mapping x WHERE x.format_id = u.format_id AND x.type_id = u.type_id)"""
)
def repaired_mapping(spark: SparkSession, d: str) -> DataFrame:
    """The mapping after the repair of missing pairs."""
    return repair.map_missing(*_t(spark, d, "tag_status", "tag_type_format_mapping"))[0].select("format_id", "type_id", "type_name_id")


_STORED = "WITH o AS (SELECT tag_id, format_id, max(ROW(type_id, alias, preferred_tag_id)) AS s FROM tag_status WHERE created_at < TIMESTAMP '2022-01-01' OR created_at IS NULL GROUP BY ALL),"


@query(
    _STORED
    + """ n AS (SELECT DISTINCT tag_id, format_id, type_id, alias, preferred_tag_id FROM tag_status WHERE created_at >= TIMESTAMP '2022-01-01')
 SELECT n.*, o.s[1] AS stored_type_id, o.s[2] AS stored_alias, o.s[3] AS stored_preferred_tag_id FROM n JOIN o USING (tag_id, format_id)
 WHERE n.type_id IS DISTINCT FROM o.s[1] OR n.alias IS DISTINCT FROM o.s[2] OR n.preferred_tag_id IS DISTINCT FROM o.s[3]"""
)
def stored_conflicts(spark: SparkSession, d: str) -> DataFrame:
    """Later status rows that differ from the stored row of their key."""
    status, attributes = load(spark, d, "tag_status"), ["type_id", "alias", "preferred_tag_id"]
    later = F.coalesce(F.col("created_at") >= F.lit("2022-01-01").cast("timestamp"), F.lit(False))
    state = merge.last_wins(status.where(~later), ["tag_id", "format_id"], attributes, attributes)
    return merge.state_conflicts(state, status.where(later).select("tag_id", "format_id", *attributes).distinct(), ["tag_id", "format_id"], attributes)


@query(
    _PTAGS
    + """ SELECT DISTINCT s.tag_id, s.format_id, a.tag, b.tag AS preferred_tag FROM tag_status s JOIN p a ON a.tag_id = s.tag_id JOIN p b ON b.tag_id = s.preferred_tag_id
 WHERE s.alias = 1 AND regexp_matches(b.tag, '(?i)^(artist|meta):') AND NOT regexp_matches(a.tag, '(?i)^(artist|meta):')"""
)
def prefix_inversions(spark: SparkSession, d: str) -> DataFrame:
    tags, status = _t(spark, d, "tags", "tag_status")
    return views.prefix_inversions(status, _prefixed(tags))


@query(
    """WITH bad AS (SELECT tag_id, tag FROM tags WHERE contains(tag, chr(65533))), r AS (SELECT DISTINCT b.tag_id, s.format_id, b.tag FROM bad b JOIN tag_status s USING (tag_id)),
 c AS (SELECT tag_id, 0 AS rule, replace(tag, chr(65533), '*') AS cand FROM bad UNION ALL SELECT tag_id, 1, replace(tag, chr(65533), 'e') FROM bad UNION ALL SELECT tag_id, 2, replace(tag, chr(65533), '') FROM bad),
 f AS (SELECT r.tag_id, r.format_id, c.rule, t.tag_id AS suggestion_id, t.tag AS suggestion, NOT EXISTS (SELECT 1 FROM tag_status s WHERE s.tag_id = t.tag_id AND s.format_id = r.format_id) AS absent FROM r JOIN c USING (tag_id) JOIN tags t ON t.tag = c.cand),
 best AS (SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY tag_id, format_id ORDER BY absent, rule, suggestion_id) = 1)
 SELECT r.tag_id, r.format_id, r.tag, u.count, hex(encode(r.tag)) AS tag_hex, b.suggestion_id, b.suggestion FROM r LEFT JOIN (SELECT tag_id, format_id, max(count) AS count FROM tag_usage_counts GROUP BY ALL) u USING (tag_id, format_id) LEFT JOIN best b USING (tag_id, format_id)"""
)
def bad_unicode(spark: SparkSession, d: str) -> DataFrame:
    return views.bad_unicode(*_t(spark, d, "tags", "tag_status", "tag_usage_counts"))


@query(
    """WITH s AS (SELECT source_tag, min(site_row_id) AS id FROM site_tags GROUP BY 1), a AS (SELECT alias, min(alias_index) AS id FROM tag_aliases GROUP BY 1),
 l AS (SELECT lower(tag) AS tag, min(alias_index) AS id FROM tag_aliases WHERE contains(tag, chr(65533)) GROUP BY 1)
 SELECT t.tag_id, CASE WHEN s.id IS NOT NULL THEN 'site_source' WHEN a.id IS NOT NULL THEN 'alias_source' WHEN s2.id IS NOT NULL THEN 'site_tag' WHEN l.id IS NOT NULL THEN 'alias_target' ELSE 'unknown' END AS origin,
  coalesce(s.id, a.id, s2.id, l.id) AS origin_id
 FROM tags t LEFT JOIN s ON s.source_tag = t.source_tag LEFT JOIN a ON a.alias = t.source_tag LEFT JOIN s s2 ON s2.source_tag = t.tag LEFT JOIN l ON l.tag = t.tag
 WHERE contains(coalesce(t.tag, ''), chr(65533)) OR contains(coalesce(t.source_tag, ''), chr(65533))"""
)
def bad_unicode_origins(spark: SparkSession, d: str) -> DataFrame:
    return views.bad_unicode_origins(*_t(spark, d, "tags", "site_tags", "tag_aliases"))


@query(
    """WITH r AS (SELECT *, first_value(ROW(type_id, alias, preferred_tag_id)) OVER () AS x, ROW(alias, CASE WHEN alias = 1 THEN preferred_tag_id ELSE 0 END, format_id, type_id, alias, preferred_tag_id) AS rank FROM tag_status),
 w AS (SELECT *, min(rank) OVER (PARTITION BY tag_id ORDER BY format_id, type_id, alias, preferred_tag_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS kept FROM r)
 SELECT tag_id, format_id, type_id, alias, preferred_tag_id, kept[4] AS kept_type_id, kept[5] AS kept_alias, kept[6] AS kept_preferred_tag_id FROM w
 WHERE kept IS NOT NULL AND (type_id IS DISTINCT FROM kept[4] OR alias IS DISTINCT FROM kept[5] OR preferred_tag_id IS DISTINCT FROM kept[6])"""
)
def fold_conflicts(spark: SparkSession, d: str) -> DataFrame:
    return merge.fold_conflicts(load(spark, d, "tag_status"), ["tag_id"], ["format_id"], ["type_id", "alias", "preferred_tag_id"])


@query(
    f"""WITH long AS (SELECT 'site' AS language, source_tag, unnest({_SPLIT.replace('translation', 'deprecated_tags')}) AS translation FROM site_tags WHERE deprecated_tags IS NOT NULL
 UNION ALL SELECT 'created', source_tag, unnest({_SPLIT.replace('translation', 'source_created_at')}) FROM site_tags WHERE source_created_at IS NOT NULL)
 SELECT source_tag, language, translation, count(*) AS n_rows FROM long GROUP BY ALL"""
)
def unpivot_columns(spark: SparkSession, d: str) -> DataFrame:
    from tagloom.sources.files import unpivot_translations

    rows = load(spark, d, "site_tags").select("source_tag", F.col("deprecated_tags").alias("site"), F.col("source_created_at").alias("created"))
    return unpivot_translations(rows, ["site", "created"]).groupBy("source_tag", "language", "translation").agg(F.count("*").alias("n_rows"))
