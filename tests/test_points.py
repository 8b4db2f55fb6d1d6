import pytest

from canopy.sources.points import assemble, label_at, parse_points


def lines(spark, rows):
    return spark.createDataFrame([(r,) for r in rows], "value string")


NAMES = ["a", "b", "y"]


def test_parse_label_last(spark):
    df = parse_points(lines(spark, ["1,2,3", " 4 , 5.5 ,NaN"]), NAMES)
    rows = df.collect()
    assert df.columns == ["label", "a", "b"]
    assert rows[0] == (3.0, 1.0, 2.0)
    assert rows[1]["a"] == 4.0 and rows[1]["b"] == 5.5 and rows[1]["label"] != rows[1]["label"]  # NaN


def test_failfast_raises_on_trailing_comma(spark):
    df = parse_points(lines(spark, ["1,2,3,"]), NAMES, mode="FAILFAST")
    with pytest.raises(Exception):
        df.collect()


def test_permissive_and_drop(spark):
    src = lines(spark, ["1,2,3", "1,2,3,", "x,2,3", "", "7,8,9"])
    perm = parse_points(src, NAMES, mode="PERMISSIVE").collect()
    bad = [r["_corrupt_record"] for r in perm if r["_corrupt_record"] is not None]
    assert sorted(bad) == ["", "1,2,3,", "x,2,3"]
    assert all(r["label"] is None for r in perm if r["_corrupt_record"] is not None)
    dropped = parse_points(src, NAMES, mode="DROPMALFORMED").collect()
    assert [tuple(r) for r in dropped] == [(3.0, 1.0, 2.0), (9.0, 7.0, 8.0)]


def test_label_at_index_and_leak(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0, 4.0)], "f0 double, f1 double, f2 double, f3 double")
    ok = label_at(df, df.columns, 1)
    assert ok.columns == ["label", "f0", "f2", "f3"] and tuple(ok.first()) == (2.0, 1.0, 3.0, 4.0)
    leak = label_at(df, df.columns, 1, leak_label=True)
    assert leak.columns == ["label", "f0", "f1", "f2"]
    last = label_at(df, df.columns)
    assert tuple(last.first()) == (4.0, 1.0, 2.0, 3.0)


def test_assemble_keeps_nan(spark):
    df = spark.createDataFrame([(1.0, float("nan"))], "a double, b double")
    v = assemble(df, ["a", "b"]).first()["features"]
    assert v[0] == 1.0 and v[1] != v[1]
