"""Sheets: columns by header, line breaks in cells, malformed rows set aside."""

import os

import pytest

from courtline.sources import raw


def sheet(folder, text, name="sheet.csv"):
    path = os.path.join(folder, name)
    with open(path, "w") as f:
        f.write(text)
    return path


def test_columns_are_found_by_their_header(spark, tmp_dir):
    path = sheet(tmp_dir, "name,value,id\nitem,7,1\n")
    rows = raw.read_sheet(spark, path, "default")
    assert rows.columns == ["id", "name", "value"] and rows.collect() == [(1, "item", 7)]
    assert raw.read_sheet(spark, path, "id int, name string, value int").collect() == [(1, "item", 7)]


@pytest.mark.parametrize("header", ["id,name,value,price", "id,name", "id,name,worth", "id,name,value,value"])
def test_other_headers_raise(spark, tmp_dir, header):
    with pytest.raises(raw.SheetHeaderError):
        raw.read_sheet(spark, sheet(tmp_dir, f"{header}\n1,a,2,3\n"), "default")


def test_files_of_one_drop_must_agree(spark, tmp_dir):
    sheet(tmp_dir, "id,name,value\n1,a,2\n", "a.csv")
    sheet(tmp_dir, "id,value,name\n1,2,b\n", "b.csv")
    with pytest.raises(Exception, match="(?i)header"):
        raw.read_sheet(spark, tmp_dir, "default").collect()


def test_line_breaks_and_quotes_in_cells(spark, tmp_dir):
    told = 'first line\nsecond, "quoted" line'
    path = os.path.join(tmp_dir, "drop")
    raw.write_sheet(spark.createDataFrame([(1, told, 2), (2, "plain", None)], "id int, name string, value int"), path)
    assert sorted(raw.read_sheet(spark, path, "default").collect()) == [(1, told, 2), (2, "plain", None)]


def test_bad_rows_are_set_aside(spark, tmp_dir):
    path = sheet(tmp_dir, "value,id,name\n1,10,good\nx,11,bad value\n2,12,good\n3,thirteen,bad id\n,14,null value\n")
    with pytest.raises(Exception):
        raw.read_sheet(spark, path, "default").collect()
    table = os.path.join(tmp_dir, "table")
    raw.land_sheet(spark, path, "default", table)
    assert sorted(spark.read.parquet(table).collect(), key=str) == [(10, "good", 1), (12, "good", 2), (14, "null value", None)]
    bad = spark.read.parquet(f"{table}_bad").collect()
    assert sorted(r.record for r in bad) == ["3,thirteen,bad id", "x,11,bad value"]
    assert {os.path.basename(r.file) for r in bad} == {"sheet.csv"}
