"""A quoted file read in one split and in many."""
import csv
import random

import pytest

from cairn.sources import readers


@pytest.fixture
def scrape(tmp_path):
    r = random.Random(5)
    cells = ["plain", 'say "hi"', "two\nlines", "a,b", "", "\n\nstarts and ends\n", 'quote " and\nnewline', "é ñ", '""', "x" * 300]
    rows = [[str(i), *(r.choice(cells) for _ in range(3))] for i in range(3000)]
    path = tmp_path / "scrape.csv"
    with path.open("w", newline="", encoding="utf-8-sig") as f:
        w = csv.writer(f, lineterminator="\n")
        w.writerow(["id", "First name", " b ", "c"])
        w.writerows(rows)
    return str(path), rows


@pytest.mark.parametrize("bytes_", ["64m", "10k", "2k"])
def test_equal_rows_and_ordinals_at_any_number_of_splits(spark, scrape, bytes_):
    path, rows = scrape
    spark.conf.set("spark.sql.files.maxPartitionBytes", bytes_)
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        df = readers.read_scrape_split(spark, path)
        assert spark.read.text(path).rdd.getNumPartitions() >= {"64m": 1, "10k": 30, "2k": 100}[bytes_]
        got = sorted(((r["_ordinal"], [r["id"], r["First name"], r["b"], r["c"]]) for r in df.collect()), key=lambda x: x[0])
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert [o for o, _ in got] == list(range(len(rows)))
    assert [[x or "" for x in v] for _, v in got] == rows


def test_both_readers_agree(spark, scrape):
    path, _ = scrape
    plain = lambda df: sorted((r["id"], r["First name"] or "", r["b"] or "", r["c"] or "") for r in df.collect())
    assert plain(readers.read_scrape_split(spark, path)) == plain(readers.read_scrape(spark, path))
