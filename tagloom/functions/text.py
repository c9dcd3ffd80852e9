"""Tag text: normalisation, emoticon protection, splitting, prefixes, dates in file names.

All functions take and return Columns and stay inside whole-stage code
generation. A null input gives null unless stated otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
WHITE = r"[\s\x1c-\x1f\x85\p{Z}]"
FULL_WIDTH = "：，．；！？（）［］｛｝／＋＝－＊＆％＃＠＾～｜＜＞　"
HALF_WIDTH = ":,.;!?()[]{}/+=-*&%#@^~|<> "
TRANSLATION_SEPARATORS = "[,，、､﹐]"
TRANSLATION_TRIM = r"[ \"'“”‘’「」]"
CATEGORY_PREFIXES = ("general:", "artist:", "copyright:", "character:", "species:", "invalid:", "meta:", "lore:")
FACE = r"[0-9oOxXtTuUvV.\-+;:^<>=_]"
WORD = r"[a-z0-9][a-z0-9_./:\-]*"


def strip(c: Column) -> Column:
    """Without outer white space, in the Unicode sense."""
    return F.regexp_replace(c, f"^{WHITE}+|{WHITE}+$", "")


def blank_to_null(c: Column) -> Column:
    """Null where only white space is left; other values keep their outer white space."""
    return F.when(strip(c) != "", c)


def is_kaomoji(c: Column) -> Column:
    """True for short emoticon-like strings; false for null.

    The order of the rules decides: exclusions for ``word_(word)`` and
    ``/path/``, then the face shapes, then a count of marks against letters.
    """
    s = strip(c)
    any_mark = s.rlike("[\\^;:<>=]")
    marks = F.length(F.regexp_replace(s, rf"[\p{{L}}\p{{N}}]|{WHITE}", ""))
    alnum = F.length(F.regexp_replace(s, r"[^\p{L}\p{N}]", ""))
    result = (
        F.when((s == "") | (F.length(s) > 24), False)
        .when(s.rlike(rf"(?iu)^{WORD}_\({WORD}\)$"), False)
        .when(s.rlike(rf"(?iu)^/{WORD}/$"), False)
        .when(s.rlike(r"(?i)^[:;=8xX]-?[)D(P/\\|]$"), True)
        .when(s.rlike(r"^[:;][<>]=?$"), True)
        .when(s.rlike(rf"^\({FACE}{{1,5}}(?:_{FACE}{{1,5}})*\)$"), True)
        .when(s.rlike(r"(?iu)^\([a-z0-9_]{2,}\)$"), False)
        .when(s.rlike(rf"^{FACE}{{1,3}}(?:_{FACE}{{1,3}})+$") & s.rlike(r"[\^;:<>=oOxX0-9]"), True)
        .otherwise(any_mark & (marks >= 2) & (alnum <= 3) & ~s.rlike(WHITE))
    )
    return F.coalesce(result, F.lit(False))


def escape_parens(c: Column) -> Column:
    """A backslash before each round bracket that has none."""
    return F.regexp_replace(c, r"(?<!\\)([()])", r"\\$1")


def fold_full_width(c: Column) -> Column:
    """Full-width marks as ASCII; the full-width backslash becomes two. Letters and digits stay."""
    return F.replace(F.translate(c, FULL_WIDTH, HALF_WIDTH), F.lit("＼"), F.lit("\\\\"))


def canonicalize_source_tag(c: Column) -> Column:
    """The stored source form: stripped and lower-cased, emoticons only stripped."""
    s = strip(c)
    return F.when(is_kaomoji(c), s).otherwise(F.lower(s))


def normalize_tag(c: Column) -> Column:
    """The tag form: folded, lower-cased, blanks for underscores, brackets escaped; emoticons only escaped."""
    s = strip(c)
    plain = strip(F.replace(F.lower(fold_full_width(s)), F.lit("_"), F.lit(" ")))
    return escape_parens(F.when(is_kaomoji(c), s).otherwise(plain))


def has_name(c: Column) -> Column:
    """Whether normalisation leaves anything: a filter on this says the same as one on the normalised text, for less."""
    return F.coalesce(c.rlike(f"[^_{WHITE[1:-1]}]"), F.lit(False))


def split_translations(c: Column) -> Column:
    """Names of a translation field: split at comma-like marks, quotes and brackets trimmed, empties dropped."""
    parts = F.split(c, TRANSLATION_SEPARATORS)
    trimmed = F.transform(parts, lambda x: F.regexp_replace(strip(x), f"^{TRANSLATION_TRIM}+|{TRANSLATION_TRIM}+$", ""))
    return F.filter(trimmed, lambda x: x != "")


def split_list(c: Column, separator: str = ",") -> Column:
    """Stripped, non-empty elements of a joined list; null counts as an empty list."""
    parts = F.split(F.coalesce(c, F.lit("")), separator)
    return F.filter(F.transform(parts, strip), lambda x: x != "")


def strip_category_prefix(c: Column) -> Column:
    """What follows the first category prefix, stripped; null without a prefix or without a rest."""
    rest = F.regexp_extract(c, "^(?:" + "|".join(CATEGORY_PREFIXES) + r")([\s\S]*)$", 1)
    return F.nullif(strip(rest), F.lit(""))


def date_from_file_name(c: Column) -> Column:
    """Midnight UTC of the ``_yyyymmdd`` or ``_yymmdd`` in a file name, as text; null without one."""
    long, short = F.regexp_extract(c, r"_(\d{8})", 1), F.regexp_extract(c, r"_(\d{6})", 1)
    digits = F.when(long != "", long).when(short != "", F.concat(F.lit("20"), short))
    return F.when(
        F.try_to_timestamp(digits, F.lit("yyyyMMdd")).isNotNull(),
        F.regexp_replace(digits, r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3 00:00:00+00:00"),
    )


def to_long(c: Column) -> Column:
    """Lenient integer cast: null where the text is no integer."""
    return c.try_cast("bigint")


def clean_count(c: Column) -> Column:
    """A count: lenient cast, negative values become null."""
    n = to_long(c)
    return F.when(n >= 0, n)


def unicode_escape(c: Column) -> Column:
    """A text in ASCII, other characters and the backslash escaped as Python writes them."""
    units = F.regexp_extract_all(c, F.lit("(?s)."), 0)
    plain = {"\\": "\\\\", "\n": "\\n", "\r": "\\r", "\t": "\\t"}

    def one(ch: Column) -> Column:
        utf32 = F.lower(F.hex(F.encode(ch, "UTF-32")))
        code = F.conv(utf32, 16, 10).cast("long")
        out = F.when(code.between(32, 126) & (ch != "\\"), ch)
        for k, v in plain.items():
            out = out.when(ch == k, F.lit(v))
        return out.when(code < 256, F.concat(F.lit("\\x"), F.substring(utf32, 7, 2))).when(code < 65536, F.concat(F.lit("\\u"), F.substring(utf32, 5, 4))).otherwise(F.concat(F.lit("\\U"), utf32))

    return F.array_join(F.transform(units, one), "")


def fffd_candidates(c: Column) -> Column:
    """Rewrites of a text with replacement characters: ``*``, ``e`` and nothing, in this order."""
    bad = F.lit("�")
    return F.array(F.replace(c, bad, F.lit("*")), F.replace(c, bad, F.lit("e")), F.replace(c, bad, F.lit("")))


def let(value: Column, f) -> Column:
    """``f(value)`` with ``value`` computed once, also where ``f`` uses it within another lambda."""
    return F.transform(F.array(value), f)[0]
