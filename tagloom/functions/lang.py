"""Language codes of column names and language values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tagloom.functions.text import strip

# Fixed values.
KNOWN_CODES = ("ja", "en", "zh", "ko", "fr", "de", "es", "ru", "pt", "it", "vi", "th", "zh-cn", "zh-hk")
NAMES = {"japanese": "ja", "english": "en", "chinese": "zh", "korean": "ko", "french": "fr", "german": "de", "spanish": "es", "russian": "ru"}
SUFFIXES = {"_jp": "ja", "_ja": "ja", "_ru": "ru", "_ko": "ko", "_zh": "zh"}


def infer_language(c: Column) -> Column:
    """Language code of a column name or a language value.

    ``trans_x`` gives x as written; then the suffixes, the known codes, the
    names, and last the first two letters. Blank gives an empty text.
    """
    s = strip(c)
    low = F.lower(s)
    out = F.when(low.startswith("trans_"), F.substr(s, F.lit(7)))
    for suffix, code in SUFFIXES.items():
        out = out.when(low.endswith(suffix), F.lit(code))
    out = out.when(low.isin(*KNOWN_CODES), low)
    for name, code in NAMES.items():
        out = out.when(low == name, F.lit(code))
    return F.when(s == "", s).otherwise(out.otherwise(F.substring(low, 1, 2)))
