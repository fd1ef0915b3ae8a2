"""The join of the facts: which side is built, and what reaches the scans."""

import re

import pytest
from compare import difference
from pyspark.sql import functions as F

from peerline.plans import facts as X
from peerline.registry.oracle import ORACLE
from peerline.registry.queries import FACTS, QUERIES

FOLDER = "/root/testdata/sf0.01"


def executed(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(FACTS))
def test_facts_are_streamed(spark, name):
    joins = [line for line in executed(QUERIES[name](spark, FOLDER)).splitlines() if re.search(r"Join \[(l_suppkey|o_custkey)", line)]
    assert joins and all("BroadcastHashJoin" in j and "BuildRight" in j for j in joins), joins


def test_facts_are_sorted_not_sent_when_the_keys_are_large(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = executed(QUERIES["peer_benchmark_prevention"](spark, FOLDER))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin [l_suppkey" in plan and "Broadcast" not in plan, plan


def test_keys_hold_the_compared_nations_only(spark):
    keys = lambda only: X.keys_with_nation(spark, FOLDER, "customer", "c_custkey", "c_nationkey", only)
    every, some = keys(None), keys(X.COMPARED)
    wanted = {int(n.removeprefix("NATION_")) for n in X.COMPARED}
    assert {r.n_nationkey for r in some.select("n_nationkey").distinct().collect()} == wanted
    assert some.count() == every.filter(F.col("n_nationkey").isin(*wanted)).count() < every.count()


def test_values_beyond_the_last_step_stay_in_the_last_part(spark, tmp_path):
    for table in ("nation", "supplier"):
        spark.read.parquet(f"{FOLDER}/{table}.parquet").write.parquet(f"{tmp_path}/{table}.parquet")
    lines = spark.read.parquet(f"{FOLDER}/lineitem.parquet")
    high = lines.withColumns({"l_quantity": F.col("l_quantity") + 40, "l_tax": F.col("l_tax") + 0.06})
    high.coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    for facts, table in ((X.accommodation_facts, "tab_ta1"), (X.ended_prevention_facts, "tab_p1"), (X.prevention_facts, "tab_a2p")):
        total, *parts = X.nation_spec(table).measure_columns
        if table == "tab_ta1":
            sums = facts(spark, str(tmp_path)).select(*(F.sum(c).alias(c) for c in (total, *parts))).first()
            assert sums[0] == sum(v or 0 for v in sums[1:])
        else:
            row = facts(spark, str(tmp_path)).select(F.sum(parts[-1])).first()
            assert row[0] > 0


def test_a_query_agrees_with_sql_when_nations_repeat_no_key(spark):
    assert difference(QUERIES["peer_benchmark_composition"](spark, FOLDER), ORACLE["peer_benchmark_composition"], FOLDER) is None
