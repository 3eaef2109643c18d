"""CSV and JSON files of many splits against the readers that take a whole file."""

from __future__ import annotations

import csv
import json
import random

import pytest

from uttermill import schema as S
from uttermill.sources import readers, splitscan


@pytest.fixture
def tiny_splits(spark):
    """Sets the split size; restores the settings afterwards."""
    names = {"spark.sql.files.maxPartitionBytes": None, "spark.sql.files.openCostInBytes": None}
    for n in names:
        names[n] = spark.conf.get(n)

    def use(size: int) -> None:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")

    yield use
    for n, v in names.items():
        spark.conf.set(n, v)


def write_csv(path, rows, header=True):
    with open(path, "w", newline="", encoding="utf-8") as f:
        writer = csv.writer(f, lineterminator="\n")
        if header:
            writer.writerow(["file_id", "transcript"])
        writer.writerows(rows)


def pairs(df):
    return sorted((r[0], r[1] or "") for r in df.collect())


def some_rows(seed, n, first=0):
    rnd = random.Random(seed)
    parts = ["a", '"', "\n", ",", "é", " ", 'x"y', "\n\n", '""', '"\n"']
    return [(f"id{i}", "".join(rnd.choices(parts, k=rnd.randint(0, 9)))) for i in range(first, first + n)]


@pytest.mark.parametrize("size", [29, 10_000])
def test_csv_equals_the_whole_file_reader(spark, tmp_path, tiny_splits, size):
    one, two = some_rows(1, 40), some_rows(2, 20, 1000)
    write_csv(tmp_path / "a.csv", one)
    write_csv(tmp_path / "b.csv", two)
    want = pairs(readers.scan_predictions(spark, str(tmp_path)))
    assert want == sorted(one + two)
    tiny_splits(size)
    df = splitscan.read_csv(spark, str(tmp_path), S.PREDICTION)
    assert pairs(df) == want
    skipped = splitscan.read_csv(spark, str(tmp_path), S.PREDICTION, skip_first=True)
    assert pairs(skipped) == sorted(one[1:] + two[1:])


def test_csv_bounds_on_every_byte(spark, tmp_path, tiny_splits):
    """One field with line feeds and doubled marks, cut at each of its bytes."""
    rows = [("a", 'x\n""\n"y"\n'), ("b", "plain"), ("c", '\n"')]
    write_csv(tmp_path / "a.csv", rows)
    length = (tmp_path / "a.csv").stat().st_size
    for size in range(3, length + 1, 9):
        tiny_splits(size)
        assert pairs(splitscan.read_csv(spark, str(tmp_path / "a.csv"), S.PREDICTION)) == sorted(rows), size


def test_csv_odd_files(spark, tmp_path, tiny_splits):
    (tmp_path / "blank.csv").write_text('\n\n\nfile_id,transcript\r\n\r\n"a","x\r\ny"\r\n\n\n"b",\r\n')
    (tmp_path / "head.csv").write_text("file_id,transcript\n")
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "open.csv").write_text('"file\n_id",transcript\n"c","no line feed at the end"')
    for size in (3, 1000):
        tiny_splits(size)
        got = {r[0]: r[1] for r in splitscan.read_csv(spark, str(tmp_path), S.PREDICTION).collect()}
        assert got == {"a": "x\r\ny", "b": None, "c": "no line feed at the end"}
    assert splitscan.read_csv(spark, str(tmp_path / "empty.csv"), S.PREDICTION).count() == 0
    assert splitscan.read_csv(spark, str(tmp_path / "head.csv"), S.PREDICTION).count() == 0
    headless = splitscan.read_csv(spark, str(tmp_path / "head.csv"), S.PREDICTION, header=False).collect()
    assert [tuple(r) for r in headless] == [("file_id", "transcript")]


@pytest.mark.parametrize("size", [23, 10_000])
@pytest.mark.parametrize("indent", [None, 2])
def test_json_equals_the_whole_file_reader(spark, tmp_path, tiny_splits, size, indent):
    rnd = random.Random(size)
    parts = ["a", '"', "\\", "\n", ",", "é", "{", "}", "[", ":", '\\"', "\U0001f600"]
    obj = {f'k"{i},\\': "".join(rnd.choices(parts, k=rnd.randint(0, 9))) for i in range(30)}
    (tmp_path / "a.json").write_text(json.dumps(obj, indent=indent, ensure_ascii=bool(indent)), encoding="utf-8")
    (tmp_path / "b.json").write_text(json.dumps({"other": "x", "more": ""}))
    want = pairs(readers.scan_json_map(spark, str(tmp_path)))
    assert dict(want) == {**obj, "other": "x", "more": ""}
    tiny_splits(size)
    assert pairs(splitscan.read_json_map(spark, str(tmp_path))) == want


def test_json_values_of_other_types_and_repeats(spark, tmp_path, tiny_splits):
    text = ' \n{"a" : 1,"b":{"c":[1,{"d":"},{"}],"e":","}, "n":null,"a":"later", "x":[ ],\n"t":true , "a" : -2.5e3 }\n '
    (tmp_path / "a.json").write_text(text)
    (tmp_path / "none.json").write_text(" { } ")
    for size in (4, 1000):
        tiny_splits(size)
        got = {r[0]: r[1] for r in splitscan.read_json_map(spark, str(tmp_path)).collect()}
        assert got == {"a": "-2.5e3" if got["a"] == "-2.5e3" else "-2500.0", "b": '{"c":[1,{"d":"},{"}],"e":","}', "n": None, "x": "[]", "t": "true"}, size
    (tmp_path / "a.json").write_text('{"p": 1, "q": 2, "p": 3}')
    assert {(r[0], r[1]) for r in splitscan.read_json_map(spark, str(tmp_path / "a.json"), "int").collect()} == {("p", 3), ("q", 2)}


def test_json_that_is_none_fails(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"a": "b", oops, "c": "d"}')
    with pytest.raises(Exception, match="no JSON entry"):
        splitscan.read_json_map(spark, str(tmp_path / "a.json")).collect()


def test_many_splits_without_a_broadcast(spark, tmp_path, tiny_splits, monkeypatch):
    rows = some_rows(5, 30)
    write_csv(tmp_path / "a.csv", rows)
    tiny_splits(50)
    monkeypatch.setattr(splitscan, "SPLITS", 3)
    assert pairs(splitscan.read_csv(spark, str(tmp_path / "a.csv"), S.PREDICTION)) == sorted(rows)
