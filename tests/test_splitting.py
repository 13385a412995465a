"""Quoted CSV by byte ranges against the csv module."""
import csv
import random

import pytest

from aspectra.sources import readers as RD
from aspectra.sources import splitting as SP


def _write(path, rows, newline="\n"):
    with open(path, "w", newline="") as f:
        w = csv.writer(f, lineterminator=newline, quoting=csv.QUOTE_MINIMAL)
        w.writerow(["id", "text", "n"])
        w.writerows(rows)


def _rows(n, seed):
    r = random.Random(seed)
    word = lambda: r.choice(["good", 'so "so"', "a,b", "line\nbreak", "tab\t", "é", "\n\n", '""', "plain"])
    rows = [(i, " ".join(word() for _ in range(r.randrange(1, 12))).strip(" "), i % 7) for i in range(n)]
    rows[n // 2] = (n // 2, "x" + "\nmany lines in one record" * 9_000, 1)      # spans several ranges
    return rows


@pytest.mark.parametrize("size", ["7k", "64k", "16m"])
def test_equal_to_the_csv_module_at_any_range_size(spark, tmp_path, size):
    for k in range(2):
        _write(f"{tmp_path}/{k}.csv", _rows(1500, k))
    old = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        df = SP.read_quoted_csv(spark, str(tmp_path), "id int, text string, n int")
        assert SP.quoted_records(spark, str(tmp_path)).filter("first").count() == 2
        if size == "7k":
            assert spark.read.option("lineSep", "\n").text(str(tmp_path)).rdd.getNumPartitions() > 50
        got = sorted((r.id, r.text, r.n) for r in df.collect())
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)
    assert got == sorted(_rows(1500, 0) + _rows(1500, 1))


def test_carriage_returns_blank_lines_and_no_header(spark, tmp_path):
    with open(f"{tmp_path}/a.csv", "w", newline="") as f:
        f.write('1,"x\r\ny",2\r\n\r\n2,,3\r\n3,"",4')
    got = SP.read_quoted_csv(spark, f"{tmp_path}/a.csv", "id int, text string, n int", header=False).collect()
    assert sorted((r.id, r.n) for r in got) == [(1, 2), (2, 3), (3, 4)]
    assert next(r.text for r in got if r.id == 1) == "x\r\ny"
    open(f"{tmp_path}/empty.csv", "w").close()
    assert SP.quoted_records(spark, f"{tmp_path}/empty.csv").count() == 0


def test_app_reviews_by_ranges_equal_whole_files(spark):
    from aspectra.sources import derived as DV
    apps, revs = DV.write_app_csvs(spark, "/root/testdata/sf0.001")
    a, b = RD.read_app_reviews(spark, apps, revs, by_ranges=True), RD.read_app_reviews(spark, apps, revs)
    assert a.dtypes == b.dtypes and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
