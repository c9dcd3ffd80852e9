"""Raw CSV records: valid ones load, the others come out with the reason for failure.

A record that is not plainly clean goes through a minimum-cost parse: a dynamic
program over the places in a field (start, plain, quoted, closed) that may
insert or delete quotes and delimiters. The steps are min-plus matrices, one a
character, and their product is formed pairwise for a batch of records at once;
going down the products again gives the states of the cheapest parse and with
them its edits. To these come the delimiters to be deleted or inserted at the
end for the parse to reach the header's width. A record without edits whose
values fit their types loads; the first edits state the reason of another.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.functions.text import WHITE
from tagloom.tables import broadcast_if_small

NUMBERS = ("type_id", "count", "format_id")
START, PLAIN, QUOTED, CLOSED = range(4)
OTHER, COMMA, QUOTE, END = range(4)
FAR = np.int32(1 << 28)
#: Characters of a batch whose matrices are held at once, which bounds a worker's memory.
CELLS = 400_000

#: Steps without an edit, and those that cost one or two: (kind of character, from, to, edits).
STEPS = (
    *((COMMA, s, START, 0) for s in (START, PLAIN, CLOSED)),
    (COMMA, QUOTED, QUOTED, 0),
    (OTHER, START, PLAIN, 0),
    (OTHER, PLAIN, PLAIN, 0),
    (OTHER, QUOTED, QUOTED, 0),
    (QUOTE, START, QUOTED, 0),
    (QUOTE, QUOTED, CLOSED, 0),
    (QUOTE, CLOSED, QUOTED, 0),  # a doubled quote
    *((QUOTE, s, s, 1) for s in range(4)),  # the quote is deleted
    (QUOTE, PLAIN, QUOTED, 1),  # a delimiter set before it
    (OTHER, CLOSED, PLAIN, 1),  # a delimiter set after the closing quote
    *((k, CLOSED, QUOTED, 2) for k in (OTHER, COMMA)),  # the closing quote deleted, or doubled
    (COMMA, QUOTED, START, 1),  # a closing quote set
    *((k, START, QUOTED, 1) for k in (OTHER, COMMA)),  # an opening quote set
    *((END, s, s, 0) for s in range(4)),
)
MATRICES = np.full((4, 4, 4), FAR, np.int32)
for _kind, _from, _to, _edits in STEPS:
    MATRICES[_kind, _from, _to] = min(MATRICES[_kind, _from, _to], _edits)


#: What a step with edits does: (kind of character, from, to) to operation. The place is that of the character.
OPERATIONS = {
    **{(QUOTE, s, s): "delete_quote" for s in range(4)},
    (QUOTE, PLAIN, QUOTED): "insert_delimiter",
    (OTHER, CLOSED, PLAIN): "insert_delimiter",
    **{(k, CLOSED, QUOTED): "double_quote" for k in (OTHER, COMMA)},
    (COMMA, QUOTED, START): "insert_quote",
    **{(k, START, QUOTED): "insert_quote" for k in (OTHER, COMMA)},
}
COSTS = {(k, a, b): e for k, a, b, e in STEPS if e}


def _kinds(records: list[str]) -> tuple[np.ndarray, list[np.ndarray]]:
    """The kind of each character that may move a state, padded to a power of two, and the characters' places."""
    rows, places = [], []
    for r in records:
        codes = np.frombuffer(r.encode("utf-32-le", "surrogatepass"), "<u4")
        kind = (codes == 44) * COMMA + (codes == 34) * QUOTE
        at = np.flatnonzero((kind != OTHER) | (np.roll(kind, 1) != OTHER) | (np.arange(len(kind)) == 0))  # further others move no state
        rows.append(kind[at])
        places.append(at)
    longest = max(1, *map(len, rows))
    kinds = np.full((len(rows), 1 << (longest - 1).bit_length()), END, np.int8)
    for i, kind in enumerate(rows):
        kinds[i, : len(kind)] = kind
    return kinds, places


def _products(kinds: np.ndarray, keep: bool = True) -> list[np.ndarray]:
    """The steps' matrices, those of pairs of steps, of fours, and so on; only the last without ``keep``."""
    levels = [MATRICES[kinds]]
    while levels[-1].shape[1] > 1:
        a, b = levels[-1][:, 0::2], levels[-1][:, 1::2]
        out = a[..., :, 0, None] + b[..., 0, None, :]
        for k in range(1, 4):
            np.minimum(out, a[..., :, k, None] + b[..., k, None, :], out=out)
        levels = [*(levels if keep else ()), np.minimum(out, FAR)]
    return levels


def _ends(top: np.ndarray) -> np.ndarray:
    ends = top[:, 0, START].astype(np.int64)
    ends[:, QUOTED] += 1  # closed at the end
    return ends


def quote_edits(records: list[str]) -> np.ndarray:
    """Edits of the cheapest parse of each record, 0 where it is well formed."""
    return _ends(_products(_kinds(records)[0], keep=False)[-1]).min(axis=1) if records else np.zeros(0, np.int64)


def edit_operations(records: list[str]) -> list[tuple[list[tuple[str, int]], list[int]]]:
    """For each record the edits of its cheapest parse, as operation and place, and the places of its delimiters under it.

    Places count characters from 0; an insertion stands before its place. Of
    equally cheap parses the one with the earlier states counts.
    """
    if not records:
        return []
    kinds, places = _kinds(records)
    levels = _products(kinds)
    states = np.stack([np.zeros(len(records), np.int64), _ends(levels[-1]).argmin(axis=1)], axis=1)
    row = np.arange(len(records))[:, None]
    for m in reversed(levels[:-1]):  # from the whole down to single steps: the state between two halves
        half = np.arange(m.shape[1] // 2)[None, :]
        cost = m[row, 2 * half, states[:, :-1]] + m[row, 2 * half + 1, :, states[:, 1:]]
        between = cost.argmin(axis=2)
        states = np.insert(states, np.arange(1, states.shape[1]), between, axis=1)
    out = []
    for i, at in enumerate(places):
        edits, delimiters = [], []
        for k, place in enumerate(at.tolist()):
            kind, was, now = int(kinds[i, k]), int(states[i, k]), int(states[i, k + 1])
            if (kind, was, now) in COSTS:
                edits.append((OPERATIONS[kind, was, now], place))
            if kind == COMMA and now == START:
                delimiters.append(place)
            elif (kind, was, now) in ((QUOTE, PLAIN, QUOTED), (OTHER, CLOSED, PLAIN)):
                delimiters.append(place)
        if states[i, -1] == QUOTED:
            edits.append(("insert_quote", len(records[i])))
        out.append((edits, delimiters))
    return out


def width_operations(fields: int, width: int, delimiters: list[int], end: int) -> list[tuple[str, int]]:
    """The delimiters to be deleted or inserted for ``fields`` to become ``width``, the last ones."""
    if not width or fields == width:
        return []
    return [("delete_delimiter", p) for p in delimiters[width - fields :]] if fields > width else [("insert_delimiter", end)] * (width - fields)


def split_record(record: str) -> list[str]:
    """Fields of a record that needs no quote edit."""
    out, i, n = [], 0, len(record)
    while True:
        if i < n and record[i] == '"':
            j, parts = i + 1, []
            while True:
                k = record.index('"', j)
                parts.append(record[j:k])
                if k + 1 < n and record[k + 1] == '"':
                    parts.append('"')
                    j = k + 2
                    continue
                i = k + 1
                break
            out.append("".join(parts))
        else:
            k = record.find(",", i)
            k = n if k < 0 else k
            out.append(record[i:k])
            i = k
        if i >= n:
            return out
        i += 1


_EDIT = T.StructType([T.StructField("operation", T.StringType()), T.StructField("place", T.IntegerType())])
_RESULT = T.StructType([T.StructField("quoting", T.BooleanType()), T.StructField("edits", T.ArrayType(_EDIT)), T.StructField("fields", T.ArrayType(T.StringType()))])


@F.pandas_udf(_RESULT)
def minimum_cost_parse(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    """Whether quoting needs edits, all edits, and the fields where it needs none. Arguments: record, width (0: unknown)."""
    for records, widths in batches:
        texts, width = records.fillna("").tolist(), widths.fillna(0).to_numpy(np.int64)
        cost = np.zeros(len(texts), np.int64)
        lengths = np.array([len(t) for t in texts])
        left = np.argsort(lengths, kind="stable")
        left = left[lengths[left] > 0]
        while len(left):  # the longest first, as many together as the bound on the matrices allows
            chunk = left[-max(1, CELLS // int(lengths[left[-1]])) :]
            cost[chunk] = quote_edits([texts[i] for i in chunk])
            left = left[: -len(chunk)]
        out = []
        for i, (t, c) in enumerate(zip(texts, cost)):
            if c:
                edits, delimiters = edit_operations([t])[0]
                edits += width_operations(len(delimiters) + 1, int(width[i]), delimiters, len(t))
                out.append((True, edits, None))
            else:
                fields = split_record(t)
                edits = [] if len(fields) == width[i] else width_operations(len(fields), int(width[i]), edit_operations([t])[0][1], len(t))
                out.append((False, edits, fields))
        yield pd.DataFrame({"quoting": [q for q, _, _ in out], "edits": [[{"operation": o, "place": p} for o, p in e] for _, e, _ in out], "fields": [f for _, _, f in out]})


def parse_lines(lines: DataFrame, max_files: int = 100_000) -> DataFrame:
    """``line_id, file_name, line_no, header, fields, reason, edits`` of every record but the headers.

    ``reason`` is null for records that load. The first that holds counts:
    ``quoting``, ``column_count``, ``invalid_value``. A null record counts as an
    empty one, which has one empty field. A file without a header row has no
    known width: only its quoting is checked. Of several header rows of a file
    the one with the smallest line_id counts, and all are left out. ``edits``
    are the operations of the cheapest parse with their places: any on quotes is
    a failure of quoting, delimiters alone one of the column count. Records
    without a quote and with the right number of commas have none and skip the
    dynamic program. Extra columns of ``lines`` are not read.
    """
    rows = lines.select("line_id", "file_name", "line_no", F.coalesce("raw_line", F.lit("")).alias("raw"))
    heads = rows.where("line_no = 1").groupBy("file_name").agg(F.min_by("raw", "line_id").alias("raw"))
    clean_head = ~F.col("raw").contains('"')
    heads = heads.select("file_name", F.when(clean_head, F.split("raw", ",")).otherwise(minimum_cost_parse("raw", F.lit(0))["fields"]).alias("header"))
    body = rows.where("line_no <> 1 or line_no is null").join(broadcast_if_small(heads, max_files), "file_name", "left")
    width = F.coalesce(F.size("header"), F.lit(0))
    width = F.when(F.col("header").isNull(), 0).otherwise(width)
    plain = ~F.col("raw").contains('"')
    commas = F.length("raw") - F.length(F.replace("raw", F.lit(","), F.lit("")))
    clean = plain & ((width == 0) | (commas + 1 == width))
    body = body.withColumns({"width": width, "clean": F.coalesce(clean, F.lit(False))})
    no_edits = F.array().cast("array<struct<operation:string,place:int>>")
    direct = body.where("clean").select("*", F.lit(False).alias("quoting"), no_edits.alias("edits"), F.split("raw", ",").alias("fields"))
    parsed = body.where("not clean").select("*", minimum_cost_parse("raw", "width").alias("p")).select(*body.columns, "p.quoting", "p.edits", "p.fields")
    both = direct.unionByName(parsed)

    def value(name: str) -> Column:
        at = F.array_position("header", name)
        return F.try_element_at("fields", F.when(at > 0, at.cast("int")))

    tag = value("source_tag")
    bad = F.coalesce(tag.rlike(rf"^{WHITE}*$") | tag.rlike("[\\x00-\\x1f\\x7f" + chr(0xFFFD) + "]"), F.lit(False))
    for name in NUMBERS:
        bad = bad | F.coalesce((value(name) != "") & ~value(name).rlike(r"^[0-9]+\z"), F.lit(False))
    reason = F.when(F.col("quoting"), "quoting").when(F.size("edits") > 0, "column_count").when(bad, "invalid_value")
    return both.select("line_id", "file_name", "line_no", "header", "fields", reason.alias("reason"), "edits")


def failed_lines(lines: DataFrame) -> DataFrame:
    """``line_id, reason`` of the records that fail."""
    return parse_lines(lines).where("reason is not null").select("line_id", "reason")


def line_edits(lines: DataFrame) -> DataFrame:
    """``line_id, step, operation, place``: the edits of the cheapest parse of every record that needs some."""
    return parse_lines(lines).select("line_id", F.posexplode("edits").alias("step", "e")).select("line_id", "step", "e.operation", "e.place")


def loaded_lines(lines: DataFrame) -> DataFrame:
    """The valid records as typed columns: ``line_id, file_name, source_tag, type_id, count, format_id, deprecated_tags, note``."""
    ok = parse_lines(lines).where("reason is null")
    value = lambda name: F.try_element_at("fields", F.nullif(F.array_position("header", name), F.lit(0)).cast("int"))
    return ok.select(
        "line_id",
        "file_name",
        value("source_tag").alias("source_tag"),
        *(value(n).try_cast("bigint").alias(n) for n in NUMBERS),
        value("deprecated_tags").alias("deprecated_tags"),
        value("note").alias("note"),
    )
