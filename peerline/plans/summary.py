"""The peer comparison as one aggregate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peerline.operators.benchmark import (
    METRIC,
    add_difference,
    add_period,
    add_ratios,
    focal_with_peers,
    from_hundredths,
    from_units,
    hundredths,
    in_units,
    pivot_entities,
    rounded_mean,
    to_units,
    unpivot_metrics,
)
from peerline.operators.rows import fresh_name
from peerline.specs import PEER_FLAG, QUARTER, TableSpec


def summary_columns(spec: TableSpec) -> list[str]:
    return [
        QUARTER, "qtr_year", "year_qtr", "qtr_month", METRIC,
        spec.focal_column, spec.peer_column, "difference",
    ]


def peer_summary(wide: DataFrame, spec: TableSpec, strict: bool = False) -> DataFrame:
    """Focal value, peer-group value and difference per quarter and metric.

    The focal row and the peer mean need neither a second scan nor a union nor
    a pivot: both sides are conditional aggregates of one pass. The scan keeps
    focal and peer rows only, measures are unpivoted inside the same stage, and
    every task sends on at most one row per quarter and measure.
    """
    return summary_of(measure_states(wide, spec, strict), spec, strict)


STATE = ("total", "n", "base_total", "base_n", "focal", "focal_ratio")


def measure_states(wide: DataFrame, spec: TableSpec, strict: bool = False) -> DataFrame:
    """Per quarter and measure what its summary rows need: sums and counts of the peers, largest focal value and ratio.

    Measures go by their place in the spec. States of parts of the rows add up to the state of all, see `merged_states`.
    """
    is_focal = F.col(spec.entity_column) == spec.focal
    is_peer = F.col(PEER_FLAG) == 1
    focal, peer = fresh_name("focal", wide), fresh_name("peer", wide)
    per_row = wide.filter(is_focal | is_peer).select(
        QUARTER, is_focal.alias(focal), is_peer.alias(peer), _unpivoted_measures(spec)
    )
    value, base = F.col("value"), F.col("base")
    peer_value, peer_base = F.when(F.col(peer), value), F.when(F.col(peer), base)
    return per_row.groupBy(QUARTER, "measure").agg(
        F.sum(peer_value).alias("total"),
        F.count(peer_value).alias("n"),
        F.sum(peer_base).alias("base_total"),
        F.count(peer_base).alias("base_n"),
        F.max(F.when(F.col(focal), value)).alias("focal"),
        # Taken row by row: with several focal rows the largest ratio need not
        # belong to the largest value.
        F.max(F.when(F.col(focal), hundredths("value", "base", strict))).alias("focal_ratio"),
    )


def merged_states(states: DataFrame) -> DataFrame:
    """One state per quarter and measure from any number of them."""
    schema = states.schema
    merge = {c: F.max if c.startswith("focal") else F.sum for c in STATE}
    merged = states.groupBy(QUARTER, "measure").agg(*(merge[c](c).alias(c) for c in STATE))
    return merged.select(QUARTER, "measure", *(F.col(c).cast(schema[c].dataType).alias(c) for c in STATE))


def summary_of(states: DataFrame, spec: TableSpec, strict: bool = False) -> DataFrame:
    """Summary rows from the states: quarters times measures from here on. Ratios of the group use the means already rounded."""
    means = states.select(
        QUARTER,
        _name_of([m.label for m in spec.measures]).alias("label"),
        _name_of([m.ratio_label for m in spec.measures]).alias("ratio_label"),
        "focal",
        "focal_ratio",
        rounded_mean("total", "n").alias("mean"),
        rounded_mean("base_total", "base_n").alias("base_mean"),
    )
    names = (METRIC, spec.focal_column, spec.peer_column)
    group_ratio = hundredths("mean", "base_mean", strict)
    own = (F.col("label"), from_units(F.col("focal")), from_units(F.col("mean")))
    share = (F.col("ratio_label"), from_hundredths(F.col("focal_ratio")), from_hundredths(group_ratio))
    both = F.array(*(F.struct(*(c.alias(n) for c, n in zip(entry, names))) for entry in (own, share)))
    long = means.select(QUARTER, F.inline(both)).filter(F.col(METRIC).isNotNull())
    return add_difference(add_period(long), spec).select(*summary_columns(spec))


def _unpivoted_measures(spec: TableSpec) -> Column:
    """(measure, value, base): the measure's place in the spec, its units and those of its base.

    Written as one SQL expression: the specs hold up to 21 measures.
    """
    units = {m.column: in_units(m) for m in spec.measures}
    missing = "cast(null as bigint)"
    entries = [f"{k}, {units[m.column]}, {units.get(m.base, missing)}" for k, m in enumerate(spec.measures)]
    return F.expr(f"stack({len(entries)}, {', '.join(entries)}) as (measure, value, base)")


def _name_of(names: list[str | None]) -> Column:
    """Name of the measure by its place in the spec."""
    listed = ", ".join("cast(null as string)" if n is None else f"'{n}'" for n in names)
    return F.expr(f"get(array({listed}), measure)")


def peer_summary_stepwise(wide: DataFrame, spec: TableSpec, strict: bool = False) -> DataFrame:
    """The same result composed from the single operators.

    Kept for reading, testing and partial reuse; `peer_summary` is the one to run.
    """
    rows = add_period(add_ratios(focal_with_peers(to_units(wide, spec), spec), spec, strict))
    pivoted = pivot_entities(unpivot_metrics(rows, spec), spec)
    return add_difference(pivoted, spec).select(*summary_columns(spec))
