"""One key holds a third of all rows: the plans must spread it, and lose nothing."""

from collections import Counter
from contextlib import contextmanager

import duckdb
import pytest
from compare import difference
from pyspark.sql import functions as F

from peerline.operators import rows as R
from peerline.plans import facts as X
from peerline.registry.oracle import ORACLE
from peerline.registry.queries import QUERIES
from peerline.specs import QUARTER

SMALL_LIMITS = {
    "spark.sql.shuffle.partitions": "64",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16KB",
}


@contextmanager
def settings(spark, values):
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture(scope="module")
def skewed_tables(tmp_path_factory):
    """The sf0.01 tables, where a third of all lines has one supplier and a third of all orders one customer."""
    folder = tmp_path_factory.mktemp("skewed")
    con = duckdb.connect()
    source = "/root/testdata/sf0.01"
    for name in ("nation", "supplier", "customer"):
        con.execute(f"COPY (FROM '{source}/{name}.parquet') TO '{folder}/{name}.parquet' (FORMAT parquet)")
    con.execute(f"""COPY (SELECT * REPLACE (CASE WHEN (l_orderkey + l_partkey) % 3 = 0 THEN 7 ELSE l_suppkey END AS l_suppkey)
        FROM '{source}/lineitem.parquet' CROSS JOIN range(10)) TO '{folder}/lineitem.parquet' (FORMAT parquet)""")
    con.execute(f"""COPY (SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 11 ELSE o_custkey END AS o_custkey)
        FROM '{source}/orders.parquet') TO '{folder}/orders.parquet' (FORMAT parquet)""")
    return str(folder)


@pytest.mark.parametrize("name", ["peer_benchmark_assessment", "peer_benchmark_accommodation"])
def test_results_hold(spark, skewed_tables, name):
    assert difference(QUERIES[name](spark, skewed_tables), ORACLE[name], skewed_tables) is None


def test_hot_supplier_is_split_when_nothing_fits_a_broadcast(spark, skewed_tables):
    with settings(spark, {**SMALL_LIMITS, "spark.sql.files.maxPartitionBytes": "1MB", "spark.sql.files.openCostInBytes": "65536"}):
        lines = X.lines_by_nation(spark, skewed_tables, F.col("l_extendedprice"))
        got = lines.groupBy("n_nationkey", QUARTER).count()
        rows = got.collect()
        plan = got._jdf.queryExecution().executedPlan().toString()
    assert sum(r["count"] for r in rows) == 600_000
    assert "SortMergeJoin(skew=true)" in plan, plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_no_shuffle_of_the_rows_behind_an_anchor(spark, skewed_tables):
    orders = X.read_table(spark, skewed_tables, "orders").select("o_custkey", "o_orderkey", "o_orderpriority")
    kept = R.start_at_anchor(orders, ["o_custkey"], "o_orderkey", F.col("o_orderpriority") == "1-URGENT")
    kept.collect()
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "hashpartitioning" not in plan, plan


def test_copies_collapse_before_the_shuffle(spark):
    n = 90_000
    cells = F.when(F.col("id") % 3 == 0, F.lit("same")).otherwise(F.col("id").cast("string"))
    df = spark.range(0, n, 1, 8).select(F.lit("f").alias("file"), F.col("id").alias("row_no"), cells.alias("c"))
    got = R.dedup_rows(df, ["file", "c"], "row_no")
    found = Counter({r["c"]: r["row_no"] for r in got.collect()})
    assert len(found) == n - n // 3 + 1 and found["same"] == 0
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "SortAggregate" not in plan
