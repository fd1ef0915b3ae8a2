"""Stored summaries, public views and CSV exports."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peerline.operators.rows import fresh_name
from peerline.plans.summary import measure_states, merged_states, summary_of
from peerline.session import materialise
from peerline.sources.tables import (
    CORE,
    PUBLIC,
    ROW_KEY,
    bucket_count,
    in_quarters,
    read_staging,
    require_quarter_overwrite,
    with_row_key,
)
from peerline.specs import QUARTER, TableSpec

ROWS_BEHIND = -1  # in place of a measure: how many staging rows a quarter's states count


def public_columns(spec: TableSpec) -> list[str]:
    """Column order of the public view, which differs from the stored summary's."""
    return [
        QUARTER, "qtr_year", "qtr_month", "year_qtr",
        spec.focal_column, spec.peer_column, "metrics", "difference",
    ]


def append_rows(rows: DataFrame, table: str, quarter: str = QUARTER, replace: bool = False) -> None:
    """Add rows to a table partitioned by quarter, with the digest of each where the table holds it.

    The rebalance hint lets adaptive execution cut a large quarter over several
    writers and join small ones, a bucket at a time where the table has buckets. `replace` swaps the quarters present in
    `rows` and needs a table whose options keep it from touching others.
    """
    spark = rows.sparkSession
    if replace:
        require_quarter_overwrite(spark, table)
    columns = spark.table(table).columns
    if ROW_KEY in columns and ROW_KEY not in rows.columns:
        rows = with_row_key(rows, table)
    rows, buckets = rows.select(*columns), bucket_count(spark, table)
    if buckets:
        bucket = fresh_name("bucket", rows)
        dealt = rows.withColumn(bucket, F.pmod(F.hash(ROW_KEY), F.lit(buckets))).hint("rebalance", quarter, bucket)
    else:
        dealt = rows.hint("rebalance", quarter)
    dealt.select(*columns).write.insertInto(table, overwrite=replace)


def state_table(spec: TableSpec) -> str:
    return f"{CORE}.{spec.summary}_state"


def _with_row_counts(states: DataFrame, rows: DataFrame) -> DataFrame:
    """States, and for each quarter the number of staging rows behind them as measure -1."""
    counts = rows.groupBy(QUARTER).agg(F.count(F.lit(1)).alias("n")).withColumn("measure", F.lit(ROWS_BEHIND))
    return states.unionByName(counts, allowMissingColumns=True)


def _store(rows: DataFrame, name: str) -> None:
    """Swap the quarters of `rows` in a table that has them as partitions, or create it."""
    spark = rows.sparkSession
    each = rows.repartition(QUARTER)  # a quarter has one row a metric: one file
    if spark.catalog.tableExists(name):
        each.select(*spark.table(name).columns).write.insertInto(name, overwrite=True)
    else:
        each.write.format("parquet").option("partitionOverwriteMode", "dynamic").partitionBy(QUARTER).saveAsTable(name)


def refresh_summary(spark: SparkSession, spec: TableSpec, strict: bool = False) -> str:
    """Recompute the stored summary from all of staging; returns its table name."""
    name = f"{CORE}.{spec.summary}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {CORE}")
    staging = read_staging(spark, spec)
    states = materialise(_with_row_counts(measure_states(staging, spec, strict), staging), f"{spec.name}-states")
    summary = summary_of(states.filter(F.col("measure") != ROWS_BEHIND), spec, strict)
    for rows, table in ((states, state_table(spec)), (summary, name)):
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        _store(rows, table)
    return name


def refresh_quarters(
    spark: SparkSession, spec: TableSpec, fresh: DataFrame | None, quarters: Sequence[int | None], strict: bool = False
) -> str:
    """Bring the stored summary up to date after a load of some quarters; returns its table name.

    The states of the `fresh` rows are merged into the stored ones of those quarters, and only these partitions are
    swapped. Without `fresh`, and for a quarter whose stored states do not count as many rows as staging holds (a load cut off
    half-way), the states come from staging's rows of that quarter. Other quarters are not read.
    """
    name = f"{CORE}.{spec.summary}"
    if not (spark.catalog.tableExists(name) and spark.catalog.tableExists(state_table(spec))):
        return refresh_summary(spark, spec, strict)
    if not quarters:
        return name
    held = read_staging(spark, spec, quarters)
    off = list(quarters)
    merged = None
    if fresh is not None:
        stored = spark.table(state_table(spec)).filter(in_quarters(quarters))
        gained = _with_row_counts(measure_states(fresh, spec, strict), fresh)
        merged = materialise(merged_states(stored.unionByName(gained)), f"{spec.name}-merged")
        counted = merged.filter(F.col("measure") == ROWS_BEHIND).select(F.col(QUARTER).alias("its_quarter"), "n")
        rows = held.groupBy(QUARTER).agg(F.count(F.lit(1)).alias("rows"))
        both = rows.join(counted, F.col(QUARTER).eqNullSafe(F.col("its_quarter")), "left")
        wrong = both.filter(~F.col("n").eqNullSafe(F.col("rows"))).select(QUARTER)
        off = [r[0] for r in wrong.collect()]  # at most the quarters at hand
    if off:
        again = read_staging(spark, spec, off)
        rebuilt = _with_row_counts(measure_states(again, spec, strict), again)
        right = [] if merged is None else [merged.filter(~F.coalesce(in_quarters(off), F.lit(False)))]
        merged = materialise(functools.reduce(DataFrame.unionByName, [rebuilt, *right]), f"{spec.name}-rebuilt")
    _store(merged, state_table(spec))
    _store(summary_of(merged.filter(F.col("measure") != ROWS_BEHIND), spec, strict), name)
    return name


def create_public_view(spark: SparkSession, spec: TableSpec) -> str:
    name = f"{PUBLIC}.{spec.summary}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {PUBLIC}")
    columns = ", ".join(public_columns(spec))
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {columns} FROM {CORE}.{spec.summary}")
    return name


def public_view(summary: DataFrame, spec: TableSpec, name: str) -> DataFrame:
    """A session view over any summary, in the public column order."""
    summary.select(*public_columns(spec)).createOrReplaceTempView(name)
    return summary.sparkSession.table(name)


def export_csv(df: DataFrame, path: str) -> str:
    """UTF-8 CSV with a header in a folder, one part per task, in place of an earlier export."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    return path


def export_summary_csv(summary: DataFrame, path: str) -> str:
    """A summary as a single ordered CSV part in place of an earlier one; it has quarters times metrics rows.

    The one task only sorts and writes: the aggregate before it stays parallel.
    """
    single = summary.repartition(1).sortWithinPartitions(QUARTER, "metrics")
    single.write.mode("overwrite").option("header", True).csv(path)
    return path
