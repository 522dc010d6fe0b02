"""File scans: pair lines, flat lines, text documents."""

import os
import tempfile

import pytest

from tallyspark.sources import files as FS


def write_lines(lines):
    d = tempfile.mkdtemp(prefix="lines-")
    with open(os.path.join(d, "part-0.txt"), "w") as f:
        f.write("\n".join(lines) + "\n")
    return d


def pairs(df):
    return sorted(map(tuple, df.collect()))


def test_pair_lines(spark):
    d = write_lines(["1,2", "-3,4", " 5 , 6", "9000000000,1"])
    assert pairs(FS.read_pair_lines(spark, d)) == [(-3, 4), (1, 2), (5, 6), (9000000000, 1)]


def test_pair_lines_bad_id_fails(spark):
    d = write_lines(["1,2", "x,4"])
    with pytest.raises(Exception):
        FS.read_pair_lines(spark, d).collect()


def test_flat_lines(spark):
    d = write_lines(["1,2,3,4", "5,6", "7,8,"])
    assert pairs(FS.read_flat_lines(spark, d)) == [(1, 2), (3, 4), (5, 6), (7, 8)]


@pytest.mark.parametrize("bad", ["1,2,3", "", "1,x"])
def test_flat_lines_bad_line_fails(spark, bad):
    d = write_lines(["1,2", bad])
    with pytest.raises(Exception):
        FS.read_flat_lines(spark, d).collect()


def test_text_documents(spark):
    d = write_lines(["a b", "", "c  d "])
    got = sorted(r.text for r in FS.read_text_documents(spark, d).collect())
    assert got == ["", "a b", "c  d "]
    assert FS.read_text_documents(spark, d).select("doc_id").distinct().count() == 3


def test_round_trips(spark):
    e = spark.createDataFrame([(1, 2), (-3, 4)], "u bigint, v bigint")
    d = tempfile.mkdtemp(prefix="pairs-") + "/out"
    FS.write_pair_lines(e, d)
    assert pairs(FS.read_pair_lines(spark, d)) == [(-3, 4), (1, 2)]
    arr = spark.sql("SELECT array(named_struct('u', 1L, 'v', 2L), "
                    "named_struct('u', 3L, 'v', -4L)) AS edges")
    d2 = tempfile.mkdtemp(prefix="flat-") + "/out"
    FS.write_flat_lines(arr, d2)
    assert pairs(FS.read_flat_lines(spark, d2)) == [(1, 2), (3, -4)]


def test_flat_lines_bad_id_fails_without_ansi(spark):
    d = write_lines(["1,2", "3,x"])
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(Exception):
            FS.read_flat_lines(spark, d).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_flat_line_with_many_pairs_is_linear(spark):
    # 50 000 pairs on one line: each id is read once (a per-element re-split
    # of the line would take minutes here)
    import time
    n = 50_000
    d = write_lines([",".join(f"{i},{i + 1}" for i in range(n))])
    t0 = time.perf_counter()
    got = FS.read_flat_lines(spark, d).selectExpr("count(*)", "sum(u)", "sum(v)").collect()[0]
    assert tuple(got) == (n, n * (n - 1) // 2, n * (n + 1) // 2)
    assert time.perf_counter() - t0 < 60


@pytest.mark.parametrize("bad", ["3,4,5", "6"])
def test_pair_lines_wrong_field_count_fails(spark, bad):
    d = write_lines(["1,2", bad])
    with pytest.raises(Exception):
        FS.read_pair_lines(spark, d).collect()


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("bad", ["1,", ",5", "", "1", "1,2,3", "a,2"])
def test_pair_lines_raise_whatever_the_ansi_mode(spark, tmp_path, bad, ansi):
    path = tmp_path / "pairs.txt"
    path.write_text(f"1,2\n{bad}\n3, 4\n")
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match="malformed"):
            FS.read_pair_lines(spark, str(path)).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)
