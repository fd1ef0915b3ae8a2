"""The quarter as YYYYMM: from a file name, split into parts, labelled."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Month of the quarter's end and its label.
QUARTER_LABELS = {3: "q1", 6: "q2", 9: "q3", 12: "q4"}
OTHER_LABEL = "q0"
# Fixed value: a name part holding this is taken to hold the quarter.
DECADE_MARK = "202"


def quarter_from_name(name: Column, delimiter: str = "_") -> Column:
    """First digit run of the last name part that mentions the 2020s; NULL without one."""
    parts = F.filter(F.split(name, f"\\Q{delimiter}\\E"), lambda part: F.contains(part, F.lit(DECADE_MARK)))
    digits = F.regexp_extract(F.try_element_at(parts, F.lit(-1)), r"(\d+)", 1)
    return digits.try_cast("int")


def quarter_year(quarter: Column) -> Column:
    return F.left(quarter.cast("string"), F.lit(4)).cast("int")


def quarter_month(quarter: Column) -> Column:
    return F.right(quarter.cast("string"), F.lit(2)).cast("int")


def quarter_label(month: Column) -> Column:
    """q1 to q4 for a month that ends a quarter, q0 for any other."""
    labels = [F.when(month == end, text) for end, text in QUARTER_LABELS.items()]
    return F.coalesce(*labels, F.lit(OTHER_LABEL))


def quarter_of_date(date: Column) -> Column:
    """Quarter end of a date or timestamp as YYYYMM."""
    return (F.year(date) * 100 + F.quarter(date) * 3).cast("int")
