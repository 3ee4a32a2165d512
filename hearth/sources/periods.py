"""Date partitions of the receipt tables.

Receipts, lines and payments are stored by the receipt's business date: in the
column ``business_date`` and, as the partition column ``business_period``, in the
finest of day, month and year whose partitions are not tiny. A period is a prefix
of the ISO date (``2001-07-05``, ``2001-07`` or ``2001``), so a reader prunes
partitions without knowing the grain.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PERIOD = "business_period"
DATE = "business_date"
#: Partition of rows without a date.
UNDATED = "undated"
#: Prefix length of each grain, and the days of its periods.
GRAINS = {"day": (10, 1), "month": (7, 30), "year": (4, 365)}
#: Bytes that a partition should hold at least; below, the next coarser grain is taken.
PARTITION_BYTES = 64 * 1024 * 1024


def choose_grain(total_bytes: int, days: int) -> str:
    """The finest grain whose partitions hold ``PARTITION_BYTES`` on average."""
    for grain, (_, length) in GRAINS.items():
        if total_bytes * length >= PARTITION_BYTES * max(days, 1):
            return grain
    return "year"


def period_of(date: Column, grain: str) -> Column:
    """Partition value of a business date (null: ``UNDATED``)."""
    return F.coalesce(F.substring(date.cast("date").cast("string"), 1, GRAINS[grain][0]), F.lit(UNDATED))


def with_period(df: DataFrame, grain: str, date: str = DATE) -> DataFrame:
    return df.withColumn(PERIOD, period_of(F.col(date), grain))


def within(df: DataFrame, first, last=None) -> DataFrame:
    """Rows of business dates ``first`` to ``last`` (open if None). On stored tables the
    condition on ``PERIOD`` prunes partitions and that on ``DATE`` row groups; a table
    without the columns is returned as it is (its reader filters anyway)."""
    if PERIOD not in df.columns or DATE not in df.columns:
        return df
    def day(x):
        return (x if isinstance(x, Column) else F.lit(x)).cast("date")
    low = day(first)
    df = df.filter((F.col(PERIOD) >= F.substring(low.cast("string"), F.lit(1), F.length(PERIOD))) & (F.col(DATE) >= low))
    if last is None:
        return df.filter(F.col(PERIOD) != UNDATED)
    return df.filter((F.col(PERIOD) <= day(last).cast("string")) & (F.col(DATE) <= day(last)))
