"""Cleanup of translations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.functions.lang import infer_language
from tagloom.functions.text import split_translations

# The scripts a language's text must show. A language that is not listed is not tested.
_HAN = r"㐀-䶿一-鿿豈-﫿"
SCRIPTS = {"ja": rf"[぀-ヿ{_HAN}]", "zh": f"[{_HAN}]", "ko": "[가-힣]"}


def wrong_script(language: str = "language", text: str = "translation"):
    """True where a text lacks every script of its language. Null and empty texts and other languages: false."""
    out = F.lit(False)
    for code, script in SCRIPTS.items():
        out = out | ((F.col(language) == code) & (F.col(text) != "") & ~F.col(text).rlike(script))
    return F.coalesce(out, F.lit(False))


def script_filter(translations: DataFrame) -> DataFrame:
    """Translations that show a script of their language."""
    return translations.where(~wrong_script())


def ascii_filter(translations: DataFrame, languages: tuple[str, ...]) -> DataFrame:
    """Without ASCII-only texts of the given languages."""
    return translations.where(~F.coalesce(F.col("language").isin(*languages) & F.col("translation").rlike(r"^[\x00-\x7F]+$"), F.lit(False)))


def delete_values(translations: DataFrame, values: DataFrame, language: str = "ja") -> DataFrame:
    """Without the translations of a language that a value list (``translation``) names."""
    return translations.join(values.select("translation", F.lit(language).alias("language")).distinct(), ["language", "translation"], "left_anti")


def normalize_languages(translations: DataFrame) -> DataFrame:
    """Language values as codes."""
    return translations.withColumn("language", infer_language(F.col("language")))


def split_values(translations: DataFrame) -> DataFrame:
    """``tag_id, language, translation, pos, created_at, updated_at``: one row a name of fields that hold comma-like marks.

    A single unchanged name stays as it is; a field without any name is gone;
    equal (tag_id, language, translation) keep the one of the earliest
    translation_id and position.
    """
    names = F.when(F.col("translation").rlike("[,，、､﹐]"), split_translations(F.col("translation"))).otherwise(F.array("translation"))
    long = translations.where("translation is not null").select("translation_id", "tag_id", "language", "created_at", "updated_at", F.posexplode(names).alias("pos", "name"))
    first = long.groupBy("tag_id", "language", "name").agg(F.min(F.struct("translation_id", "pos", "created_at", "updated_at")).alias("r"))
    return first.select("tag_id", "language", F.col("name").alias("translation"), "r.translation_id", "r.created_at", "r.updated_at")
