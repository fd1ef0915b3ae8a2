"""Staging-shaped relations built from the star-schema tables.

Entity = nation, quarter = quarter end of the order or ship date. Every measure
is a count of rows; a count of zero is missing, as in the published sheets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from peerline.functions.periods import quarter_of_date
from peerline.operators.rows import peer_flag
from peerline.specs import PEER_FLAG, QUARTER, SPECS, TableSpec

FOCAL_NATION = "NATION_0"
PEER_NATIONS = [f"NATION_{i}" for i in range(1, 10)]
ORDER_VALUE_STEP = 62_500.0
COMPARED = (FOCAL_NATION, *PEER_NATIONS)


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def nation_spec(name: str) -> TableSpec:
    """One of the table specs, compared over nations."""
    return SPECS[name].for_entities(
        FOCAL_NATION, PEER_NATIONS, focal_column="focal", peer_column="peer_group"
    )


def keys_with_nation(
    spark: SparkSession, folder: str, table: str, key: str, nation: str, only: Sequence[str] | None = None
) -> DataFrame:
    """(key, n_nationkey) of a table of customers or suppliers, of `only` the named nations if given.

    The nations are asked by a semi-join: its estimate is that of the stored table, where the product of a plain join would make
    Catalyst take the far larger facts for the smaller side and build a table of them. So what is built next to the facts is the keys'
    side if that is small; beyond the threshold both sides are sorted and a hot key is split.
    """
    keys = read_table(spark, folder, table).select(key, F.col(nation).alias("n_nationkey"))
    if only is None:
        return keys
    nations = read_table(spark, folder, "nation").filter(F.col("n_name").isin(*only)).select("n_nationkey")
    return keys.join(nations, "n_nationkey", "left_semi")


def orders_by_nation(spark: SparkSession, folder: str, part: Column, only: Sequence[str] | None = None) -> DataFrame:
    """(nation, quarter_ending, part) of every order, or of those of some nations."""
    orders = read_table(spark, folder, "orders").select(
        "o_custkey", quarter_of_date(F.col("o_orderdate")).alias(QUARTER), part.alias("part")
    )
    customers = keys_with_nation(spark, folder, "customer", "c_custkey", "c_nationkey", only)
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select("n_nationkey", QUARTER, "part")


def lines_by_nation(
    spark: SparkSession, folder: str, part: Column, status: str | None = None, only: Sequence[str] | None = None
) -> DataFrame:
    """(nation, quarter_ending, part) of every order line, or of those of some nations; with a status, lines of another one have no part."""
    lines = read_table(spark, folder, "lineitem")
    if status:
        part = F.when(F.col("l_linestatus") == status, part)
    lines = lines.select("l_suppkey", quarter_of_date(F.col("l_shipdate")).alias(QUARTER), part.alias("part"))
    suppliers = keys_with_nation(spark, folder, "supplier", "s_suppkey", "s_nationkey", only)
    return lines.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey")).select("n_nationkey", QUARTER, "part")


def count_parts(rows: DataFrame) -> DataFrame:
    """Rows per nation, quarter and part.

    The only step that sees every row: one join to a stored table whose size
    Catalyst knows, one lookup by three small values. A hot nation or quarter
    collapses in each task. What follows works on nations x quarters x parts.
    """
    return rows.groupBy("n_nationkey", QUARTER, "part").agg(F.count(F.lit(1)).alias("n"))


def counted(spark: SparkSession, folder: str, rows: DataFrame, spec: TableSpec) -> DataFrame:
    """Wide counts: the first measure counts all rows, the others one part each."""
    total, *parts = spec.measure_columns
    wide = count_parts(rows).groupBy("n_nationkey", QUARTER).agg(
        F.sum("n").alias(total),
        *(F.expr(f"sum(n) filter (where part = {k}) as {c}") for k, c in enumerate(parts)),
    )
    return _as_staging(spark, folder, wide, spec)


def _as_staging(spark: SparkSession, folder: str, wide: DataFrame, spec: TableSpec) -> DataFrame:
    nations = read_table(spark, folder, "nation").select("n_nationkey", "n_name")
    named = wide.join(nations, "n_nationkey").selectExpr(
        f"cast(n_nationkey as string) as {spec.id_column}",
        f"n_name as {spec.entity_column}",
        *(f"cast({m.column} as {m.data_type.simpleString()}) as {m.column}" for m in spec.measures),
        QUARTER,
    )
    return named.withColumn(PEER_FLAG, peer_flag(F.col(spec.entity_column), spec.peers))


def quantity_band(parts: int) -> Column:
    """Quantities from 1 cut into bands 0 .. parts - 1, equal up to 50; the last is open-ended."""
    return F.least(F.floor((F.col("l_quantity") - 1) * parts / 50), F.lit(parts - 1)).cast("int")


def assessment_facts(spark: SparkSession, folder: str, only: Sequence[str] | None = None) -> DataFrame:
    """tab_a1: orders by status over the nation's customers, in thousands."""
    spec = nation_spec("tab_a1")
    by_status = count_parts(orders_by_nation(spark, folder, F.col("o_orderstatus"), only))

    def of(*statuses: str) -> Column:
        return F.sum(F.when(F.col("part").isin(*statuses), F.col("n")))

    wide = by_status.groupBy("n_nationkey", QUARTER).agg(
        F.sum("n").alias("initial_assessments"),
        of("F", "O").alias("owed_prevention_or_relief_duty"),
        of("F").alias("prevention_duty_owed"),
        of("O").alias("relief_duty_owed"),
    )
    customers = read_table(spark, folder, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey"))
    residents = customers.agg((F.count(F.lit(1)) * F.lit("0.001").cast("decimal(4,3)")).alias("households_in_area_000s"))
    return _as_staging(spark, folder, wide.join(residents, "n_nationkey"), spec)


def prevention_facts(spark: SparkSession, folder: str, only: Sequence[str] | None = None) -> DataFrame:
    spec = nation_spec("tab_a2p")
    return counted(spark, folder, lines_by_nation(spark, folder, quantity_band(13), "F", only), spec)


def relief_facts(spark: SparkSession, folder: str, only: Sequence[str] | None = None) -> DataFrame:
    spec = nation_spec("tab_a2r")
    return counted(spark, folder, lines_by_nation(spark, folder, quantity_band(13), "O", only), spec)


def ended_prevention_facts(spark: SparkSession, folder: str, only: Sequence[str] | None = None) -> DataFrame:
    spec = nation_spec("tab_p1")
    # The last part is open-ended: a tax of eight hundredths or more.
    tax_step = F.least(F.round(F.col("l_tax") * 100), F.lit(8.0)).cast("int")
    return counted(spark, folder, lines_by_nation(spark, folder, tax_step, "F", only), spec)


def ended_relief_facts(spark: SparkSession, folder: str, only: Sequence[str] | None = None) -> DataFrame:
    spec = nation_spec("tab_r1")
    # The last part is open-ended: a discount of nine hundredths or more.
    discount_step = F.least(F.round(F.col("l_discount") * 100), F.lit(9.0)).cast("int")
    return counted(spark, folder, lines_by_nation(spark, folder, discount_step, "O", only), spec)


def accommodation_facts(spark: SparkSession, folder: str, only: Sequence[str] | None = None) -> DataFrame:
    spec = nation_spec("tab_ta1")
    return counted(spark, folder, lines_by_nation(spark, folder, quantity_band(20), only=only), spec)


def composition_facts(spark: SparkSession, folder: str, only: Sequence[str] | None = None) -> DataFrame:
    spec = nation_spec("tab_ta2")
    # The last part is open-ended: seven steps or more.
    step = F.least(F.floor(F.col("o_totalprice") / ORDER_VALUE_STEP), F.lit(7)).cast("int")
    return counted(spark, folder, orders_by_nation(spark, folder, step, only), spec)
