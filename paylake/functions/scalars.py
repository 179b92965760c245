"""Column helpers shared by the layers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Money is summed as decimal, so a sum does not depend on the order rows arrive in. Ten decimals keep small
# amounts; eighteen digits before them leave room for any amount that is a real amount, and a larger one counts as null.
MONEY = "decimal(28,10)"
MONEY_LIMIT = 1e18
RATE = "decimal(18,4)"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def event_key(c: str | Column = "event_id") -> Column:
    """Trimmed text form of an event id; blank counts as missing."""
    return F.nullif(F.trim(col(c).cast("string")), F.lit(""))


def half_up(c: str | Column, digits: int) -> Column:
    """Round half away from zero. Spare digits first, so that float noise cannot turn a tie."""
    return F.round(col(c).try_cast(f"decimal(38,{digits + 5})"), digits).cast("double")


def exact_sum(c: str | Column, unit: str = MONEY) -> Column:
    """Order-free sum, returned as double."""
    return F.sum(col(c).try_cast(unit)).cast("double")


def exact_avg(c: str | Column, unit: str = MONEY) -> Column:
    """Mean over non-null values from an order-free sum; null when there are none."""
    return F.try_divide(exact_sum(c, unit), F.count(col(c)))


def rows() -> Column:
    return F.count(F.lit(1))


def pct(part: Column, whole: Column, digits: int) -> Column:
    """part as a percentage of whole, null when whole is 0."""
    return half_up(F.try_divide(part * F.lit(100.0), whole), digits)


def when_any(text: Column, fragments) -> Column:
    """True when any of the fragments occurs in the text."""
    found = F.lit(False)
    for fragment in fragments:
        found = found | text.contains(fragment)
    return found


def total_of(counted: DataFrame, column: str) -> Column:
    """The sum of a column as a scalar: each task adds up its rows, and one row of sums meets in one place."""
    return counted.agg(F.sum(column).alias("total")).scalar()
