import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from peerline.operators import rows as R
from peerline.operators.profile import filled_cells, fingerprint_counts, rows_per_quarter


def test_rename_passes_over_absent_names_and_projection_does_not(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert R.rename_columns(df, {"a": "x", "zz": "y"}).columns == ["x", "b"]
    assert R.keep_columns(df, ["b", "a"]).columns == ["b", "a"]
    with pytest.raises(Exception, match="zz"):
        R.keep_columns(df, ["zz"]).collect()


def test_constant_and_flag(spark):
    df = spark.createDataFrame([("Camden",), ("camden",), (None,)], "la string")
    got = R.add_constant(df.withColumn("flag", R.peer_flag(F.col("la"), ["Camden"])))
    assert [tuple(r) for r in got.collect()] == [("Camden", 1, 1), ("camden", 0, 1), (None, 0, 1)]


def test_map_values(spark):
    df = spark.createDataFrame([("a",), ("b",)], "k string")
    assert [r[0] for r in df.select(R.map_values(F.col("k"), {"a": 1, "b": 2})).collect()] == [1, 2]
    with pytest.raises(Exception, match="no mapping for b"):
        df.select(R.map_values(F.col("k"), {"a": 1})).collect()


def test_sparse_rows_and_missing_ids(spark):
    df = spark.createDataFrame([("a", 1, 2), ("b", None, None), (None, 3, 4), (None, None, None)], "id string, x int, y int")
    assert len(rows(R.drop_sparse_rows(df, 1))) == 3
    assert rows(R.drop_sparse_rows(df, 3)) == [("a", 1, 2)]
    assert {r[0] for r in rows(R.not_null(df, "id"))} == {"a", "b"}


def test_sparse_columns(spark):
    data = [(i, 1 if i < 19 else None, 1 if i < 20 else None) for i in range(25)]
    df = spark.createDataFrame(data, "a int, b int, c int")
    assert R.drop_sparse_columns(df, 20).columns == ["a", "c"]
    with pytest.raises(ValueError, match="b"):
        R.drop_sparse_columns(df, 20, ["b"])


def test_dedup_keeps_the_first_and_treats_missing_as_equal(spark):
    df = spark.createDataFrame([("f", 3, None), ("f", 1, None), ("f", 2, "x"), ("g", 4, None)], "file string, row_no int, c string")
    got = rows(R.dedup_rows(df, ["file", "c"], "row_no"))
    assert got == sorted([("f", None, 1), ("f", "x", 2), ("g", None, 4)], key=repr)


def test_anchor(spark):
    data = [("f", 0, "head"), ("f", 1, "ENGLAND"), ("f", 2, "a"), ("f", 3, "ENGLAND"), ("g", 0, "a"), ("g", 5, "b")]
    df = spark.createDataFrame(data, "file string, row_no int, la string")
    got = R.start_at_anchor(df, ["file"], "row_no", F.col("la") == "ENGLAND")
    assert rows(got) == [("f", 1, "ENGLAND"), ("f", 2, "a"), ("f", 3, "ENGLAND")]


def test_append_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "a int, b string")
    b = spark.createDataFrame([("y", 2.5)], "b string, c double")
    got = R.append_by_name([a, b])
    assert got.columns == ["a", "b", "c"]
    assert rows(got) == sorted([(1, "x", None), (None, "y", 2.5)], key=repr)


def test_profiles(spark):
    df = spark.createDataFrame([(202403, "a"), (202403, "a"), (202406, None)], "quarter_ending int, delta_id string")
    assert rows(rows_per_quarter(df)) == [(202403, 2), (202406, 1)]
    assert rows(filled_cells(df)) == [("delta_id", 2), ("quarter_ending", 3)]
    assert rows(fingerprint_counts(df.na.drop())) == [(2, 1)]


def test_recast(spark):
    df = spark.createDataFrame([("2024-03-31", "1.5", "7", 3), (None, "x", "..", None)], "d string, f string, n string, t int")
    got = R.recast_columns(df, ["d"], ["f"], ["n"], ["t"])
    assert [t for _, t in got.dtypes] == ["timestamp_ntz", "double", "bigint", "string"]
    assert [tuple(r)[1:] for r in got.collect()] == [(1.5, 7, "3"), (None, None, None)]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        R.recast_columns(spark.createDataFrame([("no date",)], "d string"), dates=["d"]).collect()


def test_wide_rows_are_compared_by_hash_first(spark, monkeypatch):
    """Same rows as the plain operator; rows that share a hash only are told apart; rows that occur once are not shuffled."""
    some = random.Random(11)
    data = [(i, f"f{i % 3}", [some.choice("ab"), some.choice(["c", None]), str(i // 40)]) for i in range(400)]
    df = spark.createDataFrame(data, "row_no int, file string, cells array<string>")
    want = rows(R.dedup_rows(df, ["file", "cells"], "row_no").select("file", "cells", "row_no"))
    assert rows(R.dedup_wide_rows(df, ["file", "cells"], "row_no")) == want and len(want) < 400

    single = R.dedup_wide_rows(df.filter("row_no < 3"), ["row_no", "cells"], "row_no")
    assert "Exchange" not in single._jdf.queryExecution().executedPlan().toString() and single.count() == 3
    named = df.withColumnRenamed("file", "row_hash")  # clashes with the hash's own name
    assert len(rows(R.dedup_wide_rows(named, ["row_hash", "cells"], "row_no"))) == len(want)

    monkeypatch.setattr(R.F, "xxhash64", lambda *columns: F.lit(1))
    assert rows(R.dedup_wide_rows(df, ["file", "cells"], "row_no")) == want
