import datetime as dt

import pytest
from pyspark.sql import functions as F

from peerline.functions.periods import (
    quarter_from_name,
    quarter_label,
    quarter_month,
    quarter_of_date,
    quarter_year,
)
from peerline.functions.text import add_fingerprint, clean_label, text_array
from peerline.specs import SPECS


@pytest.mark.parametrize(
    "name,want",
    [
        ("A_202406_revised.xlsx", 202406), ("A_202503.ods", 202503), ("A_1999.csv", None), ("plain.csv", None),
        ("A_202406_202409.csv", 202409), ("Detailed_LA_202406_v2.csv", 202406), ("x202406y12.csv", 202406),
    ],
)
def test_quarter_from_name(spark, name, want):
    df = spark.createDataFrame([(name,)], "n string")
    assert df.select(quarter_from_name(F.col("n"))).first()[0] == want


def test_quarter_parts_and_label(spark):
    df = spark.createDataFrame([(q,) for q in (202403, 202406, 202409, 202412, 202407, None)], "q int")
    month = quarter_month(F.col("q"))
    got = [tuple(r) for r in df.select(quarter_year(F.col("q")), month, quarter_label(month)).collect()]
    assert got == [
        (2024, 3, "q1"), (2024, 6, "q2"), (2024, 9, "q3"), (2024, 12, "q4"), (2024, 7, "q0"), (None, None, "q0"),
    ]


def test_quarter_of_date(spark):
    df = spark.createDataFrame([(dt.date(2024, 4, 1),), (dt.date(2024, 12, 31),)], "d date")
    assert [r[0] for r in df.select(quarter_of_date(F.col("d"))).collect()] == [202406, 202412]


def test_fingerprint_keeps_the_place_of_missing_values(spark):
    df = spark.createDataFrame([("a", None, 1, None), ("a", 1, None, 1.5)], "s string, x bigint, y bigint, z double")
    got = [r.delta_id for r in add_fingerprint(df).collect()]
    assert got == ["a-;-<NA>-;-1-;-nan", "a-;-1-;-<NA>-;-1.5"]
    assert [r.delta_id for r in add_fingerprint(df, ["x", "s"]).collect()] == ["<NA>-;-a", "1-;-a"]


def test_clean_label_on_every_prefixed_metric(spark):
    names = [n for s in SPECS.values() for n in s.metric_names]
    df = spark.createDataFrame([(n,) for n in names], "m string")
    got = {r[0]: r[1] for r in df.select("m", clean_label(F.col("m"))).collect()}
    assert got["perc_pdo_from_family_friend_terminations"] == "family_friend_terminations"
    assert got["rde_by_not_known"] == "not_known"
    assert got["perc_initial_assessments"] == "perc_initial_assessments"


def test_text_array_escapes(spark):
    got = spark.range(1).select(text_array(["it's", None, "back\\slash", 'q"'])).first()[0]
    assert got == ["it's", None, "back\\slash", 'q"']
