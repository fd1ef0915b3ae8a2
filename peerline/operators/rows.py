"""Row and column operators used by the cleaner and open to any DataFrame."""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peerline.functions.numbers import to_double, to_whole
from peerline.session import materialise


def fresh_name(name: str, df: DataFrame) -> str:
    """A column name that `df` does not have, whatever the case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename by {old: new}; names that are absent are passed over."""
    return df.withColumnsRenamed(dict(names))


def keep_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exactly these columns in this order; an absent one is an error."""
    return df.select(*columns)


def add_constant(df: DataFrame, name: str = "row_count", value: object = 1) -> DataFrame:
    return df.withColumn(name, F.lit(value))


def peer_flag(entity: Column, peers: Sequence[str]) -> Column:
    """1 for a named peer (exact, case-sensitive), 0 for all others and for NULL."""
    return F.coalesce(entity.isin(*peers).cast("int"), F.lit(0))


def map_values(column: Column, mapping: Mapping[object, object]) -> Column:
    """Replace each value through a dictionary; a value it lacks is an error."""
    if not mapping:
        raise ValueError("map_values needs at least one entry")
    pairs = F.create_map(*(F.lit(v) for v in chain.from_iterable(mapping.items())))
    found = F.map_contains_key(pairs, column)
    missing = F.raise_error(F.concat(F.lit("no mapping for "), F.coalesce(column.cast("string"), F.lit("NULL"))))
    return F.when(column.isNotNull() & found, F.try_element_at(pairs, column)).otherwise(missing)


def drop_sparse_rows(df: DataFrame, least: int = 1, columns: Sequence[str] | None = None) -> DataFrame:
    """Keep rows with at least `least` non-null cells."""
    return df.na.drop(thresh=least, subset=list(columns) if columns else None)


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNotNull())


def count_cells(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: non-null count of every column, under the column's own name."""
    return df.agg(*(F.count(c).alias(c) for c in (columns or df.columns)))


def drop_sparse_columns(df: DataFrame, least: int = 20, required: Sequence[str] = ()) -> DataFrame:
    """Keep columns with at least `least` non-null cells.

    The result's schema depends on the data, so one aggregate of one row is run
    here. Losing a `required` column is an error.
    """
    counts = count_cells(df).first().asDict()
    lost = [c for c in required if counts[c] < least]
    if lost:
        raise ValueError(f"columns with fewer than {least} cells: {', '.join(lost)}")
    return df.select(*(c for c in df.columns if counts[c] >= least))


def dedup_rows(df: DataFrame, columns: Sequence[str], order: str) -> DataFrame:
    """One row per distinct `columns`, at the lowest `order` (the first occurrence).

    A plain aggregate: copies collapse before the shuffle, however many there are.
    """
    return df.groupBy(*columns).agg(F.min(order).alias(order))


def dedup_wide_rows(df: DataFrame, columns: Sequence[str], order: str) -> DataFrame:
    """The same for wide rows that seldom repeat, of `columns` and `order` alone: rows that occur once are never moved.

    Rows are counted by a 64-bit hash, all that is shuffled of most of them. Those whose hash occurs again are then
    compared cell by cell, so two rows that merely share a hash both stay. Runs one action, and reads `df` again
    for the result: it should be stored, or cheap to read.
    """
    columns = list(columns)
    key = fresh_name("row_hash", df)
    hashed = df.select(*columns, order, F.xxhash64(*columns).alias(key))
    repeated = hashed.groupBy(key).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1").select(key)
    repeated = materialise(repeated, "repeated")
    if repeated.isEmpty():
        return df.select(*columns, order)
    once = hashed.join(repeated, key, "left_anti").select(*columns, order)
    again = hashed.join(repeated, key, "left_semi")
    return once.unionByName(dedup_rows(again, columns, order).select(*columns, order))


def start_at_anchor(df: DataFrame, group: Sequence[str], order: str, is_anchor: Column) -> DataFrame:
    """Rows of each group from its first anchor row onward; groups without one vanish.

    A window over the group would sort a whole group in one task. Instead the
    anchors are aggregated and stored first, so that the join knows their true
    size: few groups are sent to the tasks and `df` is not moved at all.
    """
    group, anchor = list(group), fresh_name("anchor", df)
    found = df.filter(is_anchor).groupBy(*group).agg(F.min(order).alias(anchor))
    anchors = materialise(found, "anchors")
    kept = df.join(anchors, group, "inner").filter(F.col(order) >= F.col(anchor))
    return kept.select(*df.columns)


def recast_columns(
    df: DataFrame,
    dates: Sequence[str] = (),
    floats: Sequence[str] = (),
    whole: Sequence[str] = (),
    texts: Sequence[str] = (),
) -> DataFrame:
    """Cast columns by list; text that is no number becomes NULL, a date that is none is an error."""
    casts = {c: F.col(c).cast("timestamp_ntz") for c in dates}
    casts |= {c: to_double(F.col(c).cast("string")) for c in floats}
    casts |= {c: to_whole(F.col(c).cast("string"), c) for c in whole}
    casts |= {c: F.col(c).cast("string") for c in texts}
    return df.withColumns(casts)


def append_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Rows of all frames, columns matched by name; a column some lack is NULL there."""
    return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
