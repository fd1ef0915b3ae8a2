"""Text to numbers, and rounding that is exact."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The marker for a missing cell, and what counts as a number in text.
PLACEHOLDER = ".."
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
SURROUNDING_SPACE = " \t\r\n"


def scrub_placeholder(text: Column, marker: str = PLACEHOLDER) -> Column:
    """Remove the literal marker wherever it occurs in the text."""
    return F.replace(text, F.lit(marker), F.lit(""))


def _trimmed(text: Column) -> Column:
    return F.btrim(text, F.lit(SURROUNDING_SPACE))


def to_double(text: Column) -> Column:
    """Number in the text as DOUBLE; NULL where the text is no number."""
    return F.when(text.rlike(NUMBER), _trimmed(text).try_cast("double"))


def to_decimal(text: Column, precision: int = 18, scale: int = 3) -> Column:
    """Number in the text as DECIMAL, without passing through binary floats."""
    return F.when(text.rlike(NUMBER), _trimmed(text).try_cast(f"decimal({precision},{scale})"))


def to_whole(text: Column, column_name: str) -> Column:
    """Number in the text as BIGINT; NULL where it is no number, an error where it is not whole.

    The match comes first: a cast that fails costs far more than one that is not tried.
    """
    number = _trimmed(text).try_cast("double")
    whole = F.when(number == F.floor(number), number.try_cast("bigint"))
    refusal = F.raise_error(F.concat(F.lit(f"{column_name}: not a whole number: "), text)).cast("bigint")
    return F.when(text.rlike(NUMBER), F.coalesce(text.try_cast("bigint"), whole, refusal))


def round_divide(numerator: str, denominator: str, digits: int = 0, strict: bool = False) -> Column:
    """numerator / denominator of two BIGINT expressions, rounded with halves away from zero.

    The result is a BIGINT in units of 10^-digits, so 57 / 200 to two digits is
    29. Whole-number arithmetic keeps it exact and cheap. Where that would
    overflow, a decimal quotient of 19 places takes over: with a denominator
    below 10^16 it tells any quotient from a tie, for up to two digits. A zero
    denominator gives NULL, or an error when `strict`.
    """
    n, d, scale = f"({numerator})", f"({denominator})", 10**digits
    doubled = f"try_add(try_multiply({n}, {2 * scale}L), if(({n} < 0) = ({d} < 0), {d}, -{d}))"
    exact = f"{doubled} div nullif(try_multiply({d}, 2L), 0L)"
    quotient = f"try_divide(cast({n} as decimal(19, 0)), cast({d} as decimal(18, 0)))"
    large = f"cast(round({quotient}, {digits}) * {scale} as bigint)"
    result = f"coalesce({exact}, {large})"
    if strict:
        result = f"if({d} = 0, cast(raise_error('division by zero') as bigint), {result})"
    return F.expr(result)
