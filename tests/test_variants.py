"""Payloads whose fields change, read from files and from texts."""

import json

from echotide.sources import files, variants

SCHEMA = "id STRING, n INT, `im:x` STRUCT<label: STRING>, list ARRAY<STRUCT<k: INT>>, at TIMESTAMP"
LINES = [
    '{"id": 1, "n": "7", "im:x": {"label": "q"}, "list": [{"k": 1}, {"k": "2"}, 5], "extra": [1]}',
    '{"id": {"a": 1}, "n": {"a": 1}, "im:x": 3, "list": 4, "at": "2026-01-02 03:04:05"}',
    '{"id": null, "at": "soon"}',
    "{}",
    "[1]",
    '{"id": 1',
    '{"id": 1, "id": 2}',
    "  ",
]


def test_fields_that_change_leave_their_neighbours(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text("\n".join(LINES))
    read = variants.read_open_payloads(spark, str(tmp_path / "in"), SCHEMA)
    rows = {r[files.CORRUPT] or i: r for i, r in enumerate(read.collect())}
    assert set(rows) == {0, 1, 2, 3, "[1]", '{"id": 1', '{"id": 1, "id": 2}'}
    first = rows[0]
    assert (first["id"], first["n"], first["im:x"]["label"]) == ("1", 7, "q")
    assert [x and x["k"] for x in first["list"]] == [1, 2, None]
    assert json.loads(rows[1]["id"]) == {"a": 1}
    assert rows[1]["n"] is rows[1]["im:x"] is rows[1]["list"] is None
    assert str(rows[1]["at"]) == "2026-01-02 03:04:05"
    assert rows[2]["id"] is rows[2]["at"] is None
    keys = read.select(variants.undeclared(read[variants.PAYLOAD], SCHEMA, spark)).collect()
    assert keys[0][0] == ["extra"] and keys[4][0] is None


def test_a_declared_reading_loses_what_an_open_one_keeps(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text(LINES[1])
    closed = files.read_payloads(spark, str(tmp_path / "in"), "n INT").first()
    assert closed["n"] is None and closed[files.CORRUPT]
    opened = variants.read_open_payloads(spark, str(tmp_path / "in"), "n INT").first()
    assert opened["n"] is None and opened[files.CORRUPT] is None


def test_other_columns_and_no_rows(spark):
    lines = spark.createDataFrame(
        [('{"ID": "x", "id": "y"}', 5, "old"), (None, 6, "old")], "line string, seq int, n string"
    )
    row = variants.open_payloads(lines, "line", "id STRING, n INT").collect()
    assert [(r["seq"], r["id"], r["n"]) for r in row] == [(5, "y", None)]
    assert variants.open_payloads(lines.limit(0), "line", SCHEMA).collect() == []
