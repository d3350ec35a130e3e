"""One CSV file read by many tasks equals the reader that gives a file to one task."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attrition.sources import csv_ranges, files

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("note, quoted", T.StringType()),
                       T.StructField("amount", T.DecimalType(12, 2)), T.StructField("day", T.DateType())])


def _write(path, rows, end="\n", bom=True, header=None):
    out = io.StringIO()
    writer = csv.writer(out, lineterminator=end)
    writer.writerow(header or SCHEMA.names)
    for r in rows:
        writer.writerow(r)
    path.write_bytes(("﻿" if bom else "").encode() + out.getvalue().encode())


def _rows(n, seed, newline="\n", long_at=()):
    rng = random.Random(seed)
    parts = ["a", "é", ",", '"', '""', newline, " ", "漢", "x,y", f"{newline}{newline}", "'", " tail "]
    rows = []
    for k in range(n):
        note = "".join(rng.choices(parts, k=rng.randint(0, 30)))
        if k in long_at:
            note = ("line" + newline + '"quoted, ' + newline) * 6000     # a field over several ranges
        rows.append((k, note, f"{rng.randint(-999, 999)}.{rng.randint(10, 99)}" if k % 7 else "", "2024-02-29" if k % 5 else ""))
    return rows


@pytest.fixture
def small_ranges(spark):
    kept = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    for k in kept:
        spark.conf.set(k, "16384")
    yield spark
    for k, v in kept.items():
        spark.conf.set(k, v)


def _sorted(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_one_file_in_many_ranges(small_ranges, tmp_path, end):
    spark = small_ranges
    path = tmp_path / "big.csv"
    _write(path, _rows(4000, 1, long_at=(17, 1800, 1801)), end)
    got = files.read_csv(spark, str(path), SCHEMA)
    want = files.read_csv_by_file(spark, str(path), SCHEMA)
    assert want.rdd.getNumPartitions() == 1
    assert spark.read.text(str(path)).rdd.getNumPartitions() > 10
    assert got.rdd.getNumPartitions() > 10
    assert got.schema == want.schema
    assert _sorted(got) == _sorted(want) and got.count() == 4000
    counts = csv_ranges.range_counts(csv_ranges._lines(spark, str(path))).collect()
    entry = csv_ranges.inside_quotes([(r["file"], r["start"], r["quotes"]) for r in counts])
    assert 5 < sum(entry.values()) < len(entry)      # ranges that begin inside quotes are there


def test_several_files_and_carriage_returns_inside_fields(small_ranges, tmp_path):
    spark = small_ranges
    for k in range(3):
        _write(tmp_path / f"part-{k}.csv", _rows(900, 10 + k, newline="\r\n" if k == 1 else "\n"), bom=k == 0)
    _write(tmp_path / "part-none.csv", [])
    got, want = files.read_csv(spark, str(tmp_path), SCHEMA), files.read_csv_by_file(spark, str(tmp_path), SCHEMA)
    assert got.count() == 2700
    assert _sorted(got) == _sorted(want)


def test_plain_file_stays_on_the_native_reader(small_ranges, tmp_path):
    spark = small_ranges
    rows = [(k, f'say "{k}", twice', "1.50", "2024-01-31") for k in range(3000)]
    _write(tmp_path / "plain.csv", rows)
    got = files.read_csv(spark, str(tmp_path / "plain.csv"), SCHEMA)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan and "FileScan csv" in plan
    assert got.rdd.getNumPartitions() > 3
    assert _sorted(got) == _sorted(files.read_csv_by_file(spark, str(tmp_path / "plain.csv"), SCHEMA))


def test_plan_has_no_shuffle_of_whole_records(small_ranges, tmp_path):
    """Only the parts of records that cross a range are exchanged."""
    path = tmp_path / "big.csv"
    _write(path, _rows(2000, 3, long_at=(9,)))
    found = csv_ranges.records(small_ranges, str(path))
    text = found._jdf.queryExecution().optimizedPlan().toString()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Union" in text
    branches = plan.split("MapInArrow")
    assert len(branches) == 3 and plan.count("Exchange hashpartitioning") <= 2


@pytest.mark.parametrize("bad", [["id", "other", "amount", "day"], ["id", "note, quoted", "amount"]])
def test_wrong_header_and_malformed_rows_fail(small_ranges, tmp_path, bad):
    spark = small_ranges
    _write(tmp_path / "a.csv", _rows(50, 4), header=bad)
    with pytest.raises(Exception):
        files.read_csv(spark, str(tmp_path / "a.csv"), SCHEMA).collect()
    _write(tmp_path / "b.csv", [*_rows(50, 5), ("not a number", "x\ny", "1.00", "2024-01-01")])
    with pytest.raises(Exception):
        files.read_csv(spark, str(tmp_path / "b.csv"), SCHEMA).collect()


def test_written_text_comes_back(small_ranges, tmp_path):
    spark = small_ranges
    schema = "id bigint, t string"
    rows = [(1, None), (2, ""), (3, 'a\n"b"\r\nc'), (4, " x "), (5, "\n"), (6, '"'), (None, ",")]
    df = spark.createDataFrame(rows, schema).repartition(3)
    files.write_csv(df, str(tmp_path / "out"))
    got = files.read_csv(spark, str(tmp_path / "out"), df.schema)
    assert _sorted(got) == sorted(rows, key=repr)
    assert got.filter(F.col("t").isNull()).count() == 1
