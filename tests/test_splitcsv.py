"""Files read in byte ranges give what the whole-file reader gives, from many tasks."""

import csv as pycsv
import os
import random

import pytest

from staylens.sources import csv, splitcsv


@pytest.fixture()
def small_ranges(spark):
    """Ranges of a few hundred bytes, so that a small file has many and records cross several borders."""
    keys = {"spark.sql.files.maxPartitionBytes": "256", "spark.sql.files.openCostInBytes": "64"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v)


def rows_of(seed, n):
    r = random.Random(seed)
    words = ["plain", "with, comma", 'quote " inside', "two\nlines", "three\n\nlines\n", '"all quoted"', "é漢字", "", "nan", "x" * 700, "many\n" * 200, "a,b\n\"c\"\n"]
    return [(str(i), r.choice(words), r.choice(words), str(r.random())) for i in range(n)]


def write(path, rows, end="\n"):
    with open(path, "w", newline="", encoding="utf-8") as f:
        w = pycsv.writer(f, lineterminator=end)
        w.writerow(["id", "text", "more text", "value"])
        w.writerows(rows)


def both(spark, path):
    whole = csv.read_landed_csv(spark, path).collect()
    split = csv.read_landed_csv(spark, path, split=True)
    assert split.columns == csv.read_landed_csv(spark, path).columns
    key = lambda r: tuple("" if x is None else x for x in r)
    assert sorted(map(tuple, split.collect()), key=key) == sorted(map(tuple, whole), key=key)
    return whole


def test_split_equals_whole(small_ranges, tmp_dir):
    for seed in range(3):
        rows = rows_of(seed, 120)
        write(f"{tmp_dir}/f{seed}.csv", rows)
        got = both(small_ranges, f"{tmp_dir}/f{seed}.csv")
        assert sorted(r[0] for r in got) == sorted(r[0] for r in rows)
    both(small_ranges, tmp_dir)  # several files in one read
    lines = splitcsv._lines(small_ranges, [f"{tmp_dir}/f0.csv"])
    assert lines.rdd.getNumPartitions() > 20
    opens = splitcsv.open_ranges(lines).collect()
    assert len(opens) > 20 and {r["opens"] for r in opens} == {True, False}


def test_line_ends_and_short_files(small_ranges, tmp_dir):
    write(f"{tmp_dir}/crlf.csv", [(str(i), "a b", "line\r\nend", "1") for i in range(60)], "\r\n")
    got = csv.read_landed_csv(small_ranges, f"{tmp_dir}/crlf.csv", split=True).collect()
    assert len(got) == 60 and {r["more text"] for r in got} == {"line\r\nend"} and {r["value"] for r in got} == {"1"}
    write(f"{tmp_dir}/header.csv", [])
    assert csv.read_landed_csv(small_ranges, f"{tmp_dir}/header.csv", split=True).count() == 0
    with open(f"{tmp_dir}/noend.csv", "w") as f:
        f.write('a,b\n1,"x\ny"\n\n2,z')
    assert sorted(map(tuple, csv.read_landed_csv(small_ranges, f"{tmp_dir}/noend.csv", split=True).collect())) == [("1", "x\ny"), ("2", "z")]


def test_one_record_over_many_ranges(small_ranges, tmp_dir):
    write(f"{tmp_dir}/one.csv", [("1", "line of text\n" * 300, "x", "y"), ("2", "b", "c", "d")])
    both(small_ranges, f"{tmp_dir}/one.csv")


def test_groups_bound_the_ranges():
    files = [(f"f{i}", 1000) for i in range(10)]
    assert splitcsv.groups(files, 100, 25) == [["f0", "f1"], ["f2", "f3"], ["f4", "f5"], ["f6", "f7"], ["f8", "f9"]]
    assert splitcsv.groups([("big", 10_000), ("small", 1)], 100, 25) == [["big"], ["small"]]


def test_headers_are_one_line_a_file(spark, tmp_dir):
    import gzip

    write(f"{tmp_dir}/a.csv", [("1", "x", "y", "z")])
    with gzip.open(f"{tmp_dir}/b.csv.gz", "wt") as f:
        f.write("value,id,text,more text\nz,2,x,y\n")
    open(f"{tmp_dir}/empty.csv", "w").close()
    found = csv.header_groups(spark, tmp_dir)
    assert sorted((k, [os.path.basename(f) for f, _ in v]) for k, v in found.items()) == [("id,text,more text,value", ["a.csv"]), ("value,id,text,more text", ["b.csv.gz"])]
    for split in (False, True):
        out = csv.read_landed_csv(spark, tmp_dir, split=split).select("id", "text", "more text", "value")
        assert sorted(map(tuple, out.collect())) == [("1", "x", "y", "z"), ("2", "x", "y", "z")]
    assert csv.header_schema(spark, "", line='a,"b ""c""",,a').names == ["a0", 'b "c"', "_c2", "a3"]
