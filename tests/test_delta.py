import random
from collections import Counter

import pytest
from conftest import rows
from pyspark.sql import functions as F

from peerline.functions.text import add_fingerprint
from peerline.operators.delta import compare_rows, fresh_rows, redundant_rows, unmatched_keys
from peerline.plans.job import append_fresh
from peerline.plans.publish import append_rows
from peerline.sources.tables import bucket_count, create_keyed_table, held_keys, with_row_key

SCHEMA = "la string, n bigint, quarter_ending int"


def made(spark, data):
    return add_fingerprint(spark.createDataFrame(data, SCHEMA))


def test_same_data_loads_nothing(spark):
    df = made(spark, [("a", 1, 202403), ("b", None, 202403)])
    assert fresh_rows(df, df).count() == 0


def test_copies_within_new_are_kept(spark):
    new = made(spark, [("a", 1, 202403)] * 2 + [("b", 1, 202403)])
    old = made(spark, [("b", 1, 202403)] * 3)
    assert rows(fresh_rows(new, old).drop("delta_id")) == [("a", 1, 202403)] * 2


def test_revised_value_is_one_fresh_and_one_redundant(spark):
    old = made(spark, [("a", 1, 202403), ("b", 2, 202403)])
    new = made(spark, [("a", 9, 202403), ("b", 2, 202403)])
    assert rows(fresh_rows(new, old).drop("delta_id")) == [("a", 9, 202403)]
    assert rows(redundant_rows(new, old).drop("delta_id")) == [("a", 1, 202403)]


def test_missing_values_in_other_places_differ(spark):
    schema = "x bigint, y bigint"
    new = add_fingerprint(spark.createDataFrame([(1, None)], schema))
    old = add_fingerprint(spark.createDataFrame([(None, 1)], schema))
    assert fresh_rows(new, old).count() == 1


def test_against_brute_force(spark):
    rnd = random.Random(7)
    draw = lambda n: [(rnd.choice("abc"), rnd.choice([None, 1, 2, 3]), rnd.choice([202403, 202406])) for _ in range(n)]
    new, old = draw(200), draw(12)
    want = Counter(r for r in new if r not in set(old))
    got = Counter(tuple(r) for r in fresh_rows(made(spark, new), made(spark, old)).drop("delta_id").collect())
    assert got == want


def test_a_row_repeated_very_often_is_split_over_tasks(spark):
    """A third of the rows are one row; without a broadcast its partition is cut up."""
    settings = {
        "spark.sql.shuffle.partitions": "64",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16KB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        n = 300_000
        key = F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id"))
        new = add_fingerprint(spark.range(0, n, 1, 16).select(key.alias("k"), F.rand(3).alias("unused")), ["k"])
        old = add_fingerprint(spark.range(0, n, 2, 16).select(F.col("id").alias("k")))
        fresh = fresh_rows(new, old)
        total = fresh.count()
        assert total == n // 3 + sum(1 for i in range(n) if i % 3 and i % 2)
        fresh.collect()
        plan = fresh._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan, plan
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_both_sides_of_one_comparison(spark):
    rnd = random.Random(9)
    draw = lambda n: [(rnd.choice("abc"), rnd.choice([None, 1, 2, 3]), rnd.choice([202403, 202406])) for _ in range(n)]
    new, old = draw(60), draw(12) + [("z", None, None)] * 5
    fresh, redundant = compare_rows(made(spark, new), made(spark, old))
    assert Counter(tuple(r)[:3] for r in fresh.collect()) == Counter(r for r in new if r not in set(old))
    assert Counter(tuple(r)[:3] for r in redundant.collect()) == Counter(r for r in old if r not in set(new))
    clash = made(spark, new).withColumnRenamed("n", "row_key")
    assert compare_rows(clash, clash)[0].count() == 0 and fresh_rows(clash, clash.limit(0)).count() == 60


def test_only_digests_are_shuffled_of_the_held_rows(spark):
    wide = spark.range(1000).select(F.col("id"), *(F.lit(f"long text {i}").alias(f"c{i}") for i in range(8)))
    df = add_fingerprint(wide)
    plan = fresh_rows(df.drop("delta_id", "c1").withColumn("delta_id", F.lit("x")), df)._jdf.queryExecution().executedPlan().toString()
    right = plan[plan.index("BuildRight") if "BuildRight" in plan else 0 :]
    assert "LeftAnti" in plan and "delta_id" not in right.split("Exchange")[-1].split("\n")[0]


@pytest.fixture
def keyed_table(spark):
    schema = spark.createDataFrame([], SCHEMA).schema
    spark.sql("DROP DATABASE IF EXISTS kept CASCADE")
    yield create_keyed_table(spark, "kept.rows", schema, buckets=4)
    spark.sql("DROP DATABASE kept CASCADE")


def test_a_held_table_is_compared_without_a_shuffle_of_it(spark, keyed_table):
    old = [("a", 1, 202403), ("a", 1, 202403), ("b", None, 202406), ("c", 3, None)]
    append_rows(spark.createDataFrame(old, SCHEMA), keyed_table)
    table = spark.table(keyed_table)
    assert table.count() == 4 and bucket_count(spark, keyed_table) == 4
    new = spark.createDataFrame([("a", 1, 202403), ("d", 4, 202403), ("d", 4, 202403), ("c", 3, None)], SCHEMA)
    keyed = with_row_key(new, keyed_table)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = unmatched_keys(keyed, held_keys(spark, keyed_table), "row_key", 4)
        plan = found._jdf.queryExecution().executedPlan().toString()
        rows_found = found.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sorted(r["in_new"] for r in rows_found) == [False, True]
    held_side = plan[plan.rindex("FileScan") - 600 : plan.rindex("FileScan")]
    assert "Bucketed: true" in plan and "Exchange" not in held_side.split("SortMergeJoin")[-1].split("in_old")[-1], plan
    fresh, lone = append_fresh(new, keyed_table)
    assert [tuple(r)[:2] for r in fresh.select("la", "n").collect()] == [("d", 4)] * 2 and lone.count() == 1
    assert append_fresh(new, keyed_table)[0].count() == 0 and spark.table(keyed_table).count() == 6
    # One quarter is compared with its own partition only.
    assert append_fresh(new.filter("quarter_ending = 202403"), keyed_table, [202403])[0].count() == 0
