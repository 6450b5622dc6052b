"""The sheet source: header by place, cell types, chosen names, files that can't be read."""

import json

from newsweft.sources import sheets


def test_rows_of_a_range():
    text = json.dumps({"range": "prod!A:AF", "values": [["day", "n", "n"], ["a", 1, 2.5, True, None, "é"], [], ["x" * 5]]})
    got = list(sheets.rows_of(text, 7))
    assert [r[0] for r in got] == [2, 3, 4]
    assert got[0][1] == ["day", "n", "n", "", "", "", ""]
    assert got[0][2] == ["a", "1", "2.5", "TRUE", None, "é", None]
    assert got[0][3] == ["text", "number", "number", "flag", "blank", "text", "blank"]
    assert got[1][2] == [None] * 7
    assert list(sheets.rows_of('{"values": []}', 3)) == list(sheets.rows_of("{}", 3)) == list(sheets.rows_of('{"values": [["h"]]}', 3)) == []


def test_read_sheets(spark, tmp_path):
    for name, text in {"prod_1": '{"values": [["a"], ["x"], ["y", 2]]}', "prod_2": '{"values": [["a"], [false]]}', "prod_3": "{broken", "prod_4": '{"values": [1]}', "dev_1": '{"values": [["a"], ["no"]]}', "_hidden": "x"}.items():
        (tmp_path / f"{name}.json").write_text(text)
    df = sheets.read_sheets(spark, str(tmp_path), 2)
    assert df.count() == 6 and df.filter("error IS NOT NULL").count() == 2
    own = sheets.read_sheets(spark, str(tmp_path), 2, "prod_").filter("row_index > 1")
    assert sorted((r.file, r.row_index, *r.cells) for r in own.collect()) == [("prod_1", 2, "x", None), ("prod_1", 3, "y", "2"), ("prod_2", 2, "FALSE", None)]
    # Names that are not wanted are no partitions; a filter takes nothing from the frame it is put on.
    assert df.rdd.getNumPartitions() == 5
    assert sheets.read_sheets(spark, str(tmp_path), 2, names=["prod_1", "dev_1"]).rdd.getNumPartitions() == 2
    assert df.filter("file = 'prod_1'").count() == 2 and df.unionByName(df.filter("file = 'prod_1'")).count() == 8


def test_round_trip(spark, tmp_path):
    rows = [("s1", i, f'q"{i},\\', i / 4, None if i % 2 else True) for i in range(5)] + [("s2", 1, ',"c1":{', -1.0, False)]
    df = spark.createDataFrame(rows, "sheet string, nth int, text string, value double, flag boolean")
    folder = str(tmp_path / "out")
    sheets.write_sheets(df, "sheet", "nth", ["text", "value", "flag"], folder)
    got = sheets.read_sheets(spark, folder, 3).filter("error IS NULL")
    want = [(s, n + 1 if s == "s2" else n + 2, [t, json.dumps(v), None if f is None else str(f).upper()]) for s, n, t, v, f in rows]
    assert sorted((r.file, r.row_index, r.cells) for r in got.collect()) == sorted(want)
    assert {tuple(r.header) for r in got.collect()} == {("text", "value", "flag")}
