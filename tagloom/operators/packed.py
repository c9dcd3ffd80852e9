"""Several values packed in one field: one row per value with its position."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.functions.text import WHITE, let, strip

# Comma-like, semicolon-like, bar-like marks, and the pairs of quotation marks and corner brackets.
COMMAS = r",，、､﹐﹑،"
SEMICOLONS = r";；﹔؛"
BARS = r"|｜¦￨"
CONTROLS = r"\x00-\x1f\x7f-\x9f\p{Zl}\p{Zp}"
PAIRS = (("“", "”"), ("‘", "’"), ("「", "」"), ("『", "』"), ("„", "“"), ("«", "»"), ("｢", "｣"), ("〝", "〟"))

DELIMITER = f"(?:[{COMMAS}{SEMICOLONS}{BARS}{CONTROLS}]|(?<={WHITE})/(?={WHITE}))"
_SPANS = [f'{q}[^{q}]*+(?:{q}{q}[^{q}]*+)*+{q}' for q in ('"', "'")] + [f"{a}[^{b}]*+{b}" for a, b in PAIRS]
#: A quoted span that opens where a value starts and closes where it ends.
QUOTED = f"(^|{DELIMITER}){WHITE}*({'|'.join(_SPANS)})(?={WHITE}*(?:{DELIMITER}|$))"
#: Stands for itself when followed by ``x``, for span n when followed by n and ``q``.
MARK = chr(0xF8FF)


def split_packed(c: Column) -> Column:
    """All values of a field in their order, as an array; null and blank fields give an empty one.

    Quoted spans are swapped for indexed placeholders that no text can hold (the
    placeholder's mark is escaped where it stands in the text), the rest is cut
    at the delimiters, and the spans come back by index. A quote that does not
    open at the start of a value, or is not closed at the end of one, is an
    ordinary character. Empty values are dropped and take no position.
    """
    text = F.replace(F.coalesce(c, F.lit("")), F.lit(MARK), F.lit(MARK + "x"))
    held = F.array_join(
        F.transform(F.split(text, QUOTED), lambda x, i: F.when(i == 0, x).otherwise(F.concat(F.lit(f";{MARK}"), (i - 1).cast("string"), F.lit("q"), x))),
        "",
    )
    parts = F.struct(F.regexp_extract_all(text, F.lit(QUOTED), 2).alias("spans"), F.transform(F.split(held, DELIMITER), strip).alias("pieces"))

    def restore(piece: Column, spans: Column) -> Column:
        n = F.regexp_extract(piece, f"^{MARK}([0-9]+)q$", 1)
        span = F.try_element_at(spans, F.when(n != "", n.cast("int") + 1))
        mark = F.left(span, F.lit(1))
        inner = F.substr(span, F.lit(2), F.length(span) - 2)
        plain = F.when(mark.isin('"', "'"), F.replace(inner, F.concat(mark, mark), mark)).otherwise(inner)
        return F.when(n == "", F.replace(piece, F.lit(MARK + "x"), F.lit(MARK))).otherwise(strip(F.replace(plain, F.lit(MARK + "x"), F.lit(MARK))))

    return F.filter(let(parts, lambda p: F.transform(p["pieces"], lambda x: restore(x, p["spans"]))), lambda x: x != "")


def explode_packed(df: DataFrame, key: str, field: str, min_values: int = 1) -> DataFrame:
    """``row_id, pos, item_value``: one row for each value of ``field``, counted from 1.

    Fields with fewer than ``min_values`` values give no row. Null, empty and
    blank fields have none; equal values of one field stay apart, and so do
    repeated rows. Other columns of ``df`` are not read, whatever their names.
    No shuffle: the cost is one scan.
    """
    values = df.select(F.col(key).alias("row_id"), split_packed(F.col(field)).alias("_values"))
    kept = values.where(F.size("_values") >= min_values)
    return kept.select("row_id", F.posexplode("_values").alias("_pos", "item_value")).select("row_id", (F.col("_pos") + 1).cast("long").alias("pos"), "item_value")
