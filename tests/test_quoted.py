"""Quoted line breaks in files that are read in byte ranges."""

import random

import pytest
from pyspark.sql import functions as F

from innlake.sources import landing as lf, quoted
from innlake.sources.schemas import RAW_COLUMNS

COLUMNS = RAW_COLUMNS["rooms"]


def read(spark, folder, size):
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        lines = quoted.lines_of(spark.read.option("lineSep", "\n").text(folder))
        ranges = lines.select("_file", "_range").distinct().count()
        rows = quoted.parsed(quoted.records(lines), lf.csv_schema("rooms"), lf.csv_options(True))
        return ranges, sorted(map(repr, rows.select(*COLUMNS, lf.CORRUPT, "_file").collect()))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("seed", [1, 2])
def test_rows_equal_whole_file_reading(spark, tmp_path, seed):
    chance = random.Random(seed)
    folder = tmp_path / lf.folder("", "rooms").strip("/")
    folder.mkdir()
    cell = lambda: chance.choice(["a", "", '"two\nlines"', '"say ""hi""\n\nthere"', "plain", '"x,y"', '" keep "', "é", '"' + "\n" * 30 + '"', '""'])
    for n in range(3):
        lines = [",".join(COLUMNS)] + [",".join([f"r{n}{k}", *(cell() for _ in COLUMNS[1:])]) for k in range(60)]
        lines += ["short,row"] if n == 1 else ["", "   "] if n == 2 else []
        (folder / f"{n}.csv").write_bytes((("\n" if n else "\r\n").join(lines) + ("\n" if n < 2 else "")).encode())
    want = lf.with_file(spark.read.schema(lf.csv_schema("rooms")).options(**lf.csv_options(True)).csv(str(folder)))
    want = sorted(map(repr, want.select(*COLUMNS, lf.CORRUPT, "_file").collect()))
    for size in (200, 3000, 1 << 20):
        ranges, got = read(spark, str(folder), size)
        assert got == want
        assert ranges > 20 if size == 200 else ranges >= 3
