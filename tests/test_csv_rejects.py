"""CSV records: every one is a row or a reject with file and reason."""

from __future__ import annotations

import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chainfold.session import scratch_dir
from chainfold.sources.csv_records import OtherHeader, scan_csv
from chainfold.sources.files import read_csv_inferred, read_csv_schema, read_csv_strings, read_or_fallback
from tests.conftest import rows

SCHEMA = T.StructType([T.StructField("h", T.StringType()), T.StructField("n", T.IntegerType()), T.StructField("v", T.StringType())])


def files(tmp_path, **texts):
    for name, text in texts.items():
        (tmp_path / f"{name}.csv").write_text(text, newline="")
    return f"file://{tmp_path}"


def rejects(scan):
    return sorted((r["file"].rsplit("/", 1)[1], r["reason"], r["record"]) for r in scan.rejects.collect())


def test_each_kind_of_reject(spark, tmp_path):
    path = files(
        tmp_path,
        a='h,n,v\nh1,1,x\nh2,a,b,9\nh3\nh4,12x,y\n\nh5,5,"q,"\nh6,6,"open\nh7,7,z\nh8,8,"a"b\n',
        b='h,n,v\r\nk1,1,"two\r\nlines"\r\nk2,2,"three\n\nmore, ""lines"""\nk3,,\nk4,4,5" pipe\n',
        c="h,n,v\n",
    )
    scan = scan_csv(spark, path, SCHEMA)
    assert rows(scan.rows) == sorted(
        [("h1", 1, "x"), ("h5", 5, "q,"), ("h7", 7, "z"), ("k1", 1, "two\nlines"), ("k2", 2, 'three\n\nmore, "lines"'), ("k3", None, None), ("k4", 4, '5" pipe')],
        key=repr,
    )
    assert rejects(scan) == [
        ("a.csv", "bad value in n", "h4,12x,y"),
        ("a.csv", "broken quotes", 'h6,6,"open'),
        ("a.csv", "broken quotes", 'h8,8,"a"b'),
        ("a.csv", "wrong column count", "h2,a,b,9"),
        ("a.csv", "wrong column count", "h3"),
    ]
    for read in (lambda: read_csv_strings(spark, path), lambda: read_csv_inferred(spark, path), lambda: read_csv_schema(spark, path, SCHEMA)):
        with pytest.raises(PySparkException, match="malformed CSV record"):
            read().collect()
    kept = scratch_dir(spark, "t-rejects")
    assert read_csv_schema(spark, path, SCHEMA, rejects_to=kept).count() == 7
    assert spark.read.parquet(kept).count() == 5


def test_a_broken_quote_takes_no_other_record(spark, tmp_path):
    """The quote opened in one record is closed by the quoted value of a later one."""
    path = files(tmp_path, a='h,n,v\nh1,1,"open\nh2,2,x\nh3,3,"fine\nlast"\nh4,4,y\nh5,5,"never\n')
    scan = scan_csv(spark, path, SCHEMA)
    assert rows(scan.rows) == [("h2", 2, "x"), ("h3", 3, "fine\nlast"), ("h4", 4, "y")]
    assert [r[2] for r in rejects(scan)] == ['h1,1,"open', 'h5,5,"never']


def test_rows_and_rejects_make_the_records(spark, tmp_path):
    rnd = random.Random(2)
    pieces = ["a,1,b", 'a,2,"x,y"', 'a,3,"l\nm"', "a,4", "a,5,b,c", "a,6x,b", 'a,7,"b"c']
    chosen = [[rnd.choice(pieces) for _ in range(400)] for _ in range(3)]
    path = files(tmp_path, **{f"f{i}": "\n".join(["h,n,v", *c]) + "\n" for i, c in enumerate(chosen)})
    scan = scan_csv(spark, path, SCHEMA)
    assert scan.rows.count() == sum(pieces.index(x) < 3 for c in chosen for x in c)
    assert scan.rows.count() + scan.rejects.count() == sum(map(len, chosen))
    # columns of the result can be pruned without losing the check
    with pytest.raises(PySparkException, match="malformed CSV record"):
        scan.checked.select("h").collect()


def test_split_files_and_stitched_order(spark, tmp_path):
    """Quoted values with line breaks in a file of many splits."""
    lines = [f'r{i},{i},"line {i}\nsecond {i}"' if i % 3 == 0 else f"r{i},{i},plain {i}" for i in range(3000)]
    path = files(tmp_path, big="h,n,v\n" + "\n".join(lines) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        got = scan_csv(spark, path, SCHEMA).checked
        assert got.count() == 3000
        assert got.where(F.col("v") == F.concat(F.lit("line "), "n", F.lit("\nsecond "), "n")).count() == 1000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_long_values_and_escapes(spark, tmp_path):
    long = "x" * 200_000 + '""' * 5000
    path = files(tmp_path, a=f'h,n,v\nh1,1,"{long}"\nh2,2,"a\\"b"\n')
    got = {r["h"]: r["v"] for r in scan_csv(spark, path, SCHEMA, options={"escape": '"'}).rows.collect()}
    assert got == {"h1": "x" * 200_000 + '"' * 5000}
    assert scan_csv(spark, path, SCHEMA).rows.where("h = 'h2'").first()["v"] == 'a"b'


def test_headers_types_and_empty_folders(spark, tmp_path):
    (tmp_path / "x").mkdir()
    path = files(tmp_path / "x", a="i,l,f,d,b,s,e\n1,5000000000,1.5,2024-01-02,true,x,\n2,1,2,2024-01-03,False,1x,\n")
    kinds = dict(read_csv_inferred(spark, path).dtypes)
    assert kinds == {"i": "int", "l": "bigint", "f": "double", "d": "date", "b": "boolean", "s": "string", "e": "string"}
    files(tmp_path / "x", b="l,i,f,d,b,s,e\n")
    with pytest.raises(OtherHeader):
        scan_csv(spark, path)
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "a.csv").write_text("")
    assert scan_csv(spark, f"file://{tmp_path}/none").rows.collect() == []


def test_the_fallback_is_for_missing_and_malformed_sources_only(spark, tmp_path):
    path = files(tmp_path, a="h,n,v\nh1,1\n")
    other = lambda: spark.range(2)
    assert read_or_fallback(lambda: read_csv_strings(spark, path), other).count() == 2
    assert read_or_fallback(lambda: spark.read.parquet(f"{path}/none"), other).count() == 2
    with pytest.raises(PySparkException, match="(?i)UNRESOLVED_COLUMN"):
        read_or_fallback(lambda: spark.range(1).select("nothing"), other)
    with pytest.raises(Exception, match="disk full"):
        read_or_fallback(lambda: spark.range(1).select(F.raise_error(F.lit("disk full")).alias("x")), other)
