"""Small reports on a table: fingerprints, rows per quarter, filled cells."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerline.functions.text import FINGERPRINT
from peerline.operators.rows import count_cells
from peerline.specs import QUARTER


def fingerprint_counts(df: DataFrame, key: str = FINGERPRINT) -> DataFrame:
    """One row: rows, and distinct fingerprints among them.

    Grouping by the fingerprint first collapses copies map-side; the second
    step only adds up one count per group.
    """
    copies = df.groupBy(key).agg(F.count(F.lit(1)).alias("copies"))
    return copies.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).cast("bigint").alias("row_count"),
        F.count(key).alias("fingerprint_count"),
    )


def rows_per_quarter(df: DataFrame, quarter: str = QUARTER) -> DataFrame:
    return df.groupBy(quarter).agg(F.count(F.lit(1)).alias("row_count"))


def filled_cells(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per column: its name and the number of non-null cells."""
    columns = list(columns or df.columns)
    return count_cells(df, columns).unpivot([], columns, "column_name", "non_null")
