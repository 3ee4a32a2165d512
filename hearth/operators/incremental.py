"""Incremental loading.

Late and corrected data are healed by re-pulling an overlapping window and
merging it idempotently (K01); the window arithmetic here is per site and
runs as DataFrame expressions over the watermark table.
"""

from __future__ import annotations

import traceback
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

OVERLAP_HOURS = 48
BACKFILL_DAYS = 365
CAP_DAYS = 364


def incremental_window(state: DataFrame, sites: DataFrame, now, overlap_hours: int = OVERLAP_HOURS,
                       backfill_days: int = BACKFILL_DAYS, cap_days: int = CAP_DAYS,
                       first_seen: DataFrame | None = None) -> DataFrame:
    """I01 (+I04): per site, pull from ``watermark - overlap`` (or ``now -
    backfill`` without a watermark) to ``now``, never further back than
    ``cap_days``; when ``first_seen`` (site, first time) is given the start is
    clamped to the site's earliest data."""
    now_ts = F.lit(now).cast("timestamp")
    wm = state.select("business_location_id", "last_watermark")
    j = sites.select("business_location_id").join(wm, "business_location_id", "left")
    start = F.coalesce(F.col("last_watermark") - F.make_dt_interval(F.lit(0), F.lit(overlap_hours)),
                       now_ts - F.make_dt_interval(F.lit(backfill_days)))
    start = F.greatest(start, now_ts - F.make_dt_interval(F.lit(cap_days)))
    if first_seen is not None:
        j = j.join(first_seen.select("business_location_id", "first_time"), "business_location_id", "left")
        start = F.greatest(start, F.col("first_time"))
    return j.select("business_location_id", start.alias("window_from"), now_ts.alias("window_to"))


def in_window(df: DataFrame, windows: DataFrame, ts_col: str = "time_closed") -> DataFrame:
    """Rows of ``df`` inside their site's window (equi join on the site, then a
    range filter; the window table has one row per site)."""
    from hearth.plans.joins import broadcast_if_small
    w = broadcast_if_small(windows)
    return (df.join(w, "business_location_id")
              .filter((F.col(ts_col) >= F.col("window_from")) & (F.col(ts_col) <= F.col("window_to")))
              .drop("window_from", "window_to"))


def rolling_window(as_of, days: int):
    """(from, to) of a re-pull that always re-reads the last ``days`` days."""
    to = F.lit(as_of).cast("date")
    return F.date_sub(to, days), to


def date_grid(ranges: DataFrame, from_col: str = "date_from", to_col: str = "date_to") -> DataFrame:
    """One row per (site, day) between each site's bounds (each site row
    expands its own range -- no cross join)."""
    return ranges.select("business_location_id",
                         F.explode(F.sequence(F.col(from_col), F.col(to_col))).alias("day"))


def clamp_from(window_from, first_time):
    """A window never starts before the site's first data."""
    return F.greatest(window_from, first_time)


def run_steps(steps: list[tuple[str, Callable[[], object]]], spark: SparkSession | None = None):
    """Run every step even if some fail; return a status DataFrame (or
    list when no session) and whether everything succeeded."""
    rows = []
    for name, fn in steps:
        try:
            fn()
            rows.append((name, "ok", None))
        except Exception as exc:  # noqa: BLE001 - isolation is the point
            rows.append((name, "failed", f"{type(exc).__name__}: {exc}"))
            traceback.print_exc()
    ok = all(r[1] == "ok" for r in rows)
    if spark is None:
        return rows, ok
    return spark.createDataFrame(rows, "step string, status string, error string"), ok


def register_views(spark: SparkSession, views: list[tuple[str, Callable[[], DataFrame]]]) -> list[str]:
    """Create temp views in the given (dependency) order so later views
    can be written as SQL over earlier ones."""
    done = []
    for name, build in views:
        build().createOrReplaceTempView(name)
        done.append(name)
    return done
