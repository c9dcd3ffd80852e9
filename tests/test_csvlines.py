import random
import re

from tagloom.sources.csvlines import edit_operations, failed_lines, line_edits, loaded_lines, parse_lines, quote_edits, split_record, width_operations

_FIELD = r'(?:"[^"]*(?:""[^"]*)*"|[^",]*)'
STRICT = re.compile(f"{_FIELD}(?:,{_FIELD})*")

SCHEMA = "line_id long, file_name string, line_no long, raw_line string"


def strict(record):
    """Fields of a record by the plain rules, or None."""
    out, i, n = [], 0, len(record)
    while True:
        field = ""
        if i < n and record[i] == '"':
            i += 1
            while True:
                if i >= n:
                    return None
                if record[i] == '"':
                    if i + 1 < n and record[i + 1] == '"':
                        field += '"'
                        i += 2
                        continue
                    i += 1
                    break
                field += record[i]
                i += 1
            if i < n and record[i] != ",":
                return None
        else:
            while i < n and record[i] != ",":
                if record[i] == '"':
                    return None
                field += record[i]
                i += 1
        out.append(field)
        if i >= n:
            return out
        i += 1


def test_edits_against_the_plain_rules():
    random.seed(1)
    records = ["".join(random.choice(['"', ",", "a", "bc", '""', "\n"]) for _ in range(random.randint(0, 9))) for _ in range(5000)]
    for r, e in zip(records, quote_edits(records)):
        fields = strict(r)
        assert (e > 0) == (fields is None), r
        assert (STRICT.fullmatch(r) is not None) == (fields is not None), r
        if fields is not None:
            assert split_record(r) == fields, r


def test_least_edits():
    for record, edits in (('"pena"trelo",0,1', 1), ('a,"0', 1), ('a"b,c', 1), ("a,b,c", 0), ('a"b"c', 2), ('"', 1), ("", 0), ('"a"b"', 1)):
        assert quote_edits([record])[0] == edits, record


def apply(record, edits):
    for operation, place in sorted(edits, key=lambda e: -e[1]):
        if operation.startswith("delete"):
            record = record[:place] + record[place + 1 :]
        else:
            record = record[:place] + ("," if operation == "insert_delimiter" else '"') + record[place:]
    return record


def test_edit_operations_mend_the_record():
    random.seed(2)
    records = ["".join(random.choice(['"', ",", "a", "bc", '""', "\n"]) for _ in range(random.randint(0, 12))) for _ in range(3000)]
    for r, cost, (edits, delimiters) in zip(records, quote_edits(records), edit_operations(records)):
        mended = apply(r, edits)
        assert len(edits) == cost or any(o == "double_quote" for o, _ in edits), r
        assert STRICT.fullmatch(mended), (r, edits, mended)
        assert len(strict(mended)) == len(delimiters) + 1, (r, edits, mended)
    assert edit_operations(['"pena"trelo,0,1'])[0] == ([("insert_delimiter", 6)], [6, 11, 13])
    assert edit_operations(['a,"0'])[0][0] == [("delete_quote", 2)]  # as cheap as to close it at the end
    assert apply("a,b,c", width_operations(3, 2, [1, 3], 5)) == "a,bc" and apply("a", width_operations(1, 3, [], 1)) == "a,,"
    assert width_operations(4, 0, [1], 2) == [] == width_operations(2, 2, [1], 3)


def test_line_edits(spark):
    rows = [(1, "f", 1, "source_tag,count"), (2, "f", 2, "a,1"), (3, "f", 3, "a"), (4, "f", 4, 'a"b,1'), (5, "f", 5, "a,1,2"), (6, "f", 6, None)]
    out = sorted(tuple(r) for r in line_edits(lines(spark, rows)).collect())
    assert out == [(3, 0, "insert_delimiter", 1), (4, 0, "delete_quote", 1), (5, 0, "delete_delimiter", 3), (6, 0, "insert_delimiter", 0)]
    assert line_edits(lines(spark, rows).limit(0)).count() == 0


def lines(spark, rows):
    return spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA + ", reason string")


def test_reasons(spark):
    head = "source_tag,type_id,count"
    raw = ["ok,1,2", '"a ""b"" c",,', " ,1,2", ",1,2", "a,1", "a,1,2,3", 'a"b,1', '"a,1,2', "a,-1,2", "a,1, 2", "a,１,2", "x\x7f,1,1", "x" + chr(0xFFFD) + ",1,1", '"two\nlines",1,1', None, "", '"a",1,"2"']
    rows = [(0, "f", 1, head)] + [(i + 1, "f", i + 2, r) for i, r in enumerate(raw)]
    got = dict(map(tuple, failed_lines(lines(spark, rows)).collect()))
    names = {3: "invalid_value", 4: "invalid_value", 5: "column_count", 6: "column_count", 7: "quoting", 8: "quoting", 9: "invalid_value", 10: "invalid_value", 11: "invalid_value", 12: "invalid_value", 13: "invalid_value", 14: "invalid_value", 15: "column_count", 16: "column_count"}
    assert got == names
    loaded = {r["line_id"]: (r["source_tag"], r["type_id"], r["count"]) for r in loaded_lines(lines(spark, rows)).collect()}
    assert loaded == {1: ("ok", 1, 2), 2: ('a "b" c', None, None), 17: ("a", 1, 2)}


def test_files_without_and_with_odd_headers(spark):
    rows = [(1, "none", 2, "a,b"), (2, "none", 3, 'a"'), (3, "q", 1, '"type_id","source_tag"'), (4, "q", 2, "x,a"), (5, "q", 3, "1,a"), (6, "twice", 1, "source_tag"), (7, "twice", 1, "a,b"), (8, "twice", 2, "v")]
    got = dict(map(tuple, failed_lines(lines(spark, rows)).collect()))
    assert got == {2: "quoting", 4: "invalid_value"}


def test_empty_and_very_long(spark):
    assert parse_lines(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(1, "f", 1, "source_tag,note"), (2, "f", 2, '"' + "a,b" * 400_000 + '",x'), (3, "f", 3, '"' + "z," * 500_000)]
    assert [tuple(r) for r in failed_lines(lines(spark, rows)).collect()] == [(3, "quoting")]
