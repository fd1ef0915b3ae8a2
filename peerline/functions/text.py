"""Row fingerprints, metric labels and text literals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fingerprint separator, how a missing value reads in it, and the
# prefixes a dashboard label drops.
SEPARATOR = "-;-"
MISSING_WHOLE = "<NA>"
MISSING_OTHER = "nan"
FINGERPRINT = "delta_id"
LABEL_PREFIX = r"^(perc_)?(pdo_from|rdo_from|pde_by|rde_by)_"


def text_array(values: Sequence[str | None]) -> Column:
    """Array literal of texts, as one expression however long the list."""
    listed = ", ".join("null" if v is None else "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" for v in values)
    return F.expr(f"cast(array({listed}) as array<string>)")


def _as_text(column: str, data_type: T.DataType) -> Column:
    missing = MISSING_WHOLE if isinstance(data_type, T.IntegralType) else MISSING_OTHER
    return F.coalesce(F.col(column).cast("string"), F.lit(missing))


def fingerprint(df: DataFrame, columns: Sequence[str] | None = None, separator: str = SEPARATOR) -> Column:
    """Text of all `columns` (default: every column), joined in order.

    A missing value keeps its place through its own token: `concat_ws` alone
    would skip it and let shifted rows look equal.
    """
    columns = list(columns or df.columns)
    return F.concat_ws(separator, *(_as_text(c, df.schema[c].dataType) for c in columns))


def add_fingerprint(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    separator: str = SEPARATOR,
    name: str = FINGERPRINT,
) -> DataFrame:
    """Add the fingerprint as a column."""
    return df.withColumn(name, fingerprint(df, columns, separator))


def row_key(text: Column) -> Column:
    """The SHA-256 of a fingerprint, 32 bytes that stand for the whole row wherever rows are compared."""
    return F.unhex(F.sha2(text, 256))


def clean_label(metric: Column) -> Column:
    """Metric name without the group prefix the dashboard page already states."""
    return F.regexp_replace(metric, LABEL_PREFIX, "")
