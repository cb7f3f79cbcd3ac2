"""The splittable reader against Spark's own reader of whole files."""

import csv
import random

import pytest

from termtide.schemas import ENTITIES
from termtide.sources import quoted_csv, tables

NAMES = ENTITIES.fieldNames()
VALUES = ["", "plain", "two\nlines", '"', 'say ""hi""\n\n', "a,b", '\n"\n', "x\r\ny", " padded ", "é\n漢字", "#no comment", "\\", '\\"', ","]


def key(rows):
    return sorted(rows, key=str)


def write(path, rows, end="\n"):
    with open(path, "w", newline="", encoding="utf-8") as f:
        out = csv.writer(f, lineterminator=end)
        out.writerow(NAMES)
        out.writerows(rows)


@pytest.fixture
def small_splits(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}
    spark.conf.set(names[0], "200")
    spark.conf.set(names[1], "0")
    yield
    for n, value in before.items():
        spark.conf.set(n, value)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_equal_to_the_reader_of_whole_files(spark, tmp_path, small_splits, end):
    rng = random.Random(3)
    for name in "ab":
        write(tmp_path / f"{name}.csv", [[str(i), *(rng.choice(VALUES) for _ in NAMES[1:])] for i in range(200)], end)
    # one field over many splits, beginnings of splits inside it
    write(tmp_path / "c.csv", [["long", "line, \"and\"\n" * 300, *[""] * 8], ["after", *["x"] * 9]], end)
    lines = quoted_csv._lines(spark, str(tmp_path))
    assert lines.select("_file", "_begin").distinct().count() > 100
    got, whole = (tables.read_entities(spark, str(tmp_path), lone_quotes=lone) for lone in (False, True))
    assert got.schema == whole.schema and got.count() == 402
    assert key(map(tuple, got.collect())) == key(map(tuple, whole.collect()))


def test_odd_files(spark, tmp_path, small_splits):
    head = ",".join(NAMES)
    texts = {
        "empty": "", "header": head, "header_line": head + "\n", "no_end": f'{head}\na,"b\nc"', "blank": f"{head}\n\n\na\n\n",
        "short_and_long": f"{head}\na,b\n{','.join('abcdefghijklm')}\n", "empty_quoted": f'{head}\n"",""\n', "bom": f"﻿{head}\na,b\n",
        "header_quoted": '"' + head.replace(",", '","').replace("title", "ti\ntle") + f'"\n{"x" * 500}\n', "equal": f"{head}\na,b\na,b\n",
    }
    for name, text in texts.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / "f.csv").write_text(text, encoding="utf-8", newline="")
        got, whole = (tables.read_entities(spark, str(tmp_path / name), lone_quotes=lone).collect() for lone in (False, True))
        assert key(map(tuple, got)) == key(map(tuple, whole)), name


def test_open_quote(spark, tmp_path, small_splits):
    (tmp_path / "f.csv").write_text(f'{",".join(NAMES)}\na,"b\n{"c" * 300}\nd,e\n', newline="")
    (row,) = tables.read_entities(spark, str(tmp_path)).collect()
    assert tuple(row) == ("a", f"b\n{'c' * 300}\nd,e", *[None] * 8)


def test_quotes_in_unquoted_fields(spark, tmp_path):
    (tmp_path / "f.csv").write_text(",".join(NAMES) + '\na,5" disk\nb,x\n')
    assert [r.entity_id for r in tables.read_entities(spark, str(tmp_path), lone_quotes=True).collect()] == ['5" disk', "x"]
