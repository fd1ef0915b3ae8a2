"""The steps of the peer comparison, each usable on its own.

Values travel as whole numbers of units (BIGINT): a count is itself, a measure
in thousands is multiplied by 1000. A ratio is a whole number of hundredths.
Every rounding is exact integer arithmetic; decimals appear once rows are few.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peerline.functions.numbers import round_divide
from peerline.functions.periods import quarter_label, quarter_month, quarter_year
from peerline.specs import PEER_FLAG, QUARTER, Measure, TableSpec

METRIC = "metrics"
VALUE = "households"
PERIOD_COLUMNS = [QUARTER, "qtr_year", "year_qtr", "qtr_month", METRIC]


def in_units(measure: Measure) -> str:
    """The measure as a whole number of units, as an SQL expression."""
    factor = " * 1000" if measure.in_thousands else ""
    return f"cast({measure.column}{factor} as bigint)"


def hundredths(value: str, base: str, strict: bool = False) -> Column:
    """value / base rounded to two decimals, as a whole number of hundredths."""
    return round_divide(value, base, 2, strict)


def from_hundredths(column: Column) -> Column:
    return (column.cast("decimal(20,0)") * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(18,2)")


def from_units(column: Column) -> Column:
    return column.cast("decimal(18,2)")


def to_units(wide: DataFrame, spec: TableSpec) -> DataFrame:
    """Wide staging rows with all measures as whole units."""
    extra = [PEER_FLAG] if PEER_FLAG in wide.columns else []
    return wide.select(*spec.key_columns, *(F.expr(in_units(m)).alias(m.column) for m in spec.measures), QUARTER, *extra)


def peer_rows(wide: DataFrame) -> DataFrame:
    return wide.filter(F.col(PEER_FLAG) == 1)


def focal_rows(wide: DataFrame, spec: TableSpec) -> DataFrame:
    return wide.filter(F.col(spec.entity_column) == spec.focal)


def rounded_mean(total: str, count: str) -> Column:
    """Mean rounded to a whole unit; NULL without any value."""
    return round_divide(total, count)


def peer_means(units: DataFrame, spec: TableSpec) -> DataFrame:
    """One row per quarter: the rounded mean of every measure over the peers."""
    means = [rounded_mean(f"sum({c})", f"count({c})").alias(c) for c in spec.measure_columns]
    return peer_rows(units).groupBy(QUARTER).agg(*means)


def label_group(means: DataFrame, spec: TableSpec) -> DataFrame:
    """Give the peer means the id and name of the peer group."""
    return means.select(
        F.lit(spec.group_id).alias(spec.id_column),
        F.lit(spec.group_name).alias(spec.entity_column),
        *spec.measure_columns,
        QUARTER,
    )


def focal_with_peers(units: DataFrame, spec: TableSpec) -> DataFrame:
    """Peer-group rows and focal rows together, without duplicates."""
    columns = [*spec.key_columns, *spec.measure_columns, QUARTER]
    group = label_group(peer_means(units, spec), spec).select(*columns)
    return group.union(focal_rows(units, spec).select(*columns)).distinct()


def add_ratios(rows: DataFrame, spec: TableSpec, strict: bool = False) -> DataFrame:
    """Every metric of the summary with two decimals: values under their label, ratios beside them."""
    metrics = []
    for m in spec.measures:
        metrics.append(from_units(F.col(m.column)).alias(m.label))
        if m.base:
            share = hundredths(m.column, m.base, strict)
            metrics.append(from_hundredths(share).alias(m.ratio_label))
    return rows.select(*spec.key_columns, QUARTER, *metrics)


def add_period(rows: DataFrame) -> DataFrame:
    """Year, month and label of the quarter."""
    month = quarter_month(F.col(QUARTER))
    return rows.withColumns(
        {"qtr_year": quarter_year(F.col(QUARTER)), "qtr_month": month, "year_qtr": quarter_label(month)}
    )


def unpivot_metrics(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """One row per entity, quarter and metric; a missing value keeps its row."""
    ids = [c for c in rows.columns if c not in set(spec.metric_names) and c != spec.id_column]
    return rows.unpivot(ids, spec.metric_names, METRIC, VALUE)


def pivot_entities(long: DataFrame, spec: TableSpec) -> DataFrame:
    """Focal and peer group side by side, the larger value where there are several."""
    keys = [c for c in PERIOD_COLUMNS if c in long.columns]
    wide = long.groupBy(*keys).pivot(spec.entity_column, [spec.focal, spec.group_name]).agg(F.max(VALUE))
    return wide.withColumnsRenamed({spec.focal: spec.focal_column, spec.group_name: spec.peer_column})


def add_difference(pivoted: DataFrame, spec: TableSpec) -> DataFrame:
    """Focal minus peer group; NULL if either is missing."""
    gap = F.col(spec.focal_column) - F.col(spec.peer_column)
    return pivoted.withColumn("difference", gap.cast("decimal(18,2)"))
