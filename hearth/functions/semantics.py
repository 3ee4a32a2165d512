"""Cross-cutting business semantics as Column expressions.

Every function returns a Column built from Spark built-ins, so it stays inside
whole-stage codegen and can be used in any select/filter/groupBy.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LONDON = "Europe/London"

# Trading-shift labels and their London-hour bands.
SHIFT_LUNCH = "Lunch (12-5)"
SHIFT_DINNER = "Dinner (5-10)"
SHIFT_OTHER = "Other"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def local_time(ts, zone: str = LONDON) -> Column:
    """Wall-clock time in ``zone`` (TIMESTAMP_NTZ) of an instant.

    Works for TIMESTAMP (instant) input under any session time zone: the cast
    to NTZ renders in the session zone, which ``convert_timezone`` then moves
    to ``zone``.
    """
    return F.convert_timezone(F.current_timezone(), F.lit(zone), _c(ts).cast("timestamp_ntz"))


def utc_wallclock_to_instant(ts_ntz) -> Column:
    """Interpret a TIMESTAMP_NTZ as a UTC reading and return the instant."""
    return F.convert_timezone(F.lit("UTC"), F.current_timezone(), _c(ts_ntz)).cast("timestamp")


def business_date(ts) -> Column:
    """Trading date = London calendar date of the instant."""
    return F.to_date(local_time(ts))


def shift_of(ts, fallback=None) -> Column:
    """Trading shift from the London hour of ``coalesce(ts, fallback)``.

    12-16 lunch, 17-21 dinner, anything else (including NULL) 'Other'.
    """
    t = _c(ts) if fallback is None else F.coalesce(_c(ts), _c(fallback))
    h = F.hour(local_time(t))
    return (F.when(h.between(12, 16), F.lit(SHIFT_LUNCH))
             .when(h.between(17, 21), F.lit(SHIFT_DINNER))
             .otherwise(F.lit(SHIFT_OTHER)))


def not_cancelled(cancelled="cancelled") -> Column:
    """NULL cancelled counts as not cancelled."""
    return ~F.coalesce(_c(cancelled), F.lit(False))


def clean_site_label(x) -> Column:
    """'Tap Harbour.' -> 'Harbour': strip trailing dots, then a leading 'Tap '."""
    return F.regexp_replace(F.regexp_replace(_c(x), r"\.+$", ""), r"^Tap ", "")


def site_key(x) -> Column:
    """Normalised site key: lower case, letters only, 'tap' removed."""
    return F.replace(F.regexp_replace(F.lower(_c(x)), "[^a-z]", ""), F.lit("tap"), F.lit(""))


def week_start(d) -> Column:
    """Monday of the ISO week."""
    return F.to_date(F.date_trunc("week", _c(d)))


def iso_dow(d) -> Column:
    """ISO weekday, 1 = Monday .. 7 = Sunday."""
    return F.weekday(_c(d)) + 1


def safe_div(num, den) -> Column:
    """num / den as double, NULL when den is 0 or NULL (never raises)."""
    d = _c(den).cast("double")
    return F.when(d != 0, _c(num).cast("double") / d)


def pct(num, den, digits: int) -> Column:
    """round(100 * num / den, digits) with a zero/NULL guard."""
    return F.round(safe_div(_c(num) * 100.0, den), digits)


def round_div(num, den, digits: int, scale: int = 4) -> Column:
    """round(num / den, digits) computed in decimals, half away from zero, NULL
    when den is 0 or NULL -- the exact numeric division of the source SQL rather
    than a double division (which flips x.xx5 ties). ``num`` has at most
    ``scale`` decimals, ``den`` is whole."""
    n = _c(num).cast(f"decimal({20 + scale},{scale})")
    d = _c(den).cast("decimal(10,0)")
    return F.round(F.when(d != 0, n / d), digits).cast("double")


def money(x, scale: int = 4) -> Column:
    """Cast to the warehouse money type (NUMERIC(14,scale)); bad input -> NULL."""
    return F.expr(f"try_cast({x} as decimal(14,{scale}))") if isinstance(x, str) else \
        _c(x).try_cast(f"decimal(14,{scale})")


def clean_num(x) -> Column:
    """Messy numeric text -> double: drop currency, thousands commas and %,
    take the first signed decimal number, else NULL."""
    s = F.regexp_replace(_c(x).cast("string"), "[£,%]", "")
    m = F.regexp_extract(s, r"-?\d+(\.\d+)?", 0)
    return F.when(m != "", m.try_cast("double"))


def clean_int(x) -> Column:
    """clean_num rounded half-to-even (the loaders' Python round)."""
    return F.bround(clean_num(x), 0).cast("long")


def clean_num_na(x) -> Column:
    """Review-feed flavour: '-', 'N/A' and blanks are NULL before cleaning."""
    t = F.trim(_c(x).cast("string"))
    return F.when(~F.upper(t).isin("", "-", "N/A", "NA"), clean_num(t))


DATE_FORMATS_FORMS = ["M/d/yyyy", "d/M/yyyy", "yyyy-MM-dd", "M/d/yy", "d/M/yy"]
DATE_FORMATS_REVIEWS = ["yyyy-MM-dd", "d/M/yyyy", "M/d/yyyy", "d/M/yy", "M/d/yy"]


def parse_date(x, formats=DATE_FORMATS_FORMS, cut_t: bool = False) -> Column:
    """First format that parses wins; only the text before the first space
    (and before 'T' when ``cut_t``) is looked at."""
    s = F.split(F.trim(_c(x).cast("string")), " ").getItem(0)
    if cut_t:
        s = F.split(s, "T").getItem(0)
    # two-digit-year patterns must not swallow four-digit years
    outs = []
    for fmt in formats:
        cand = F.try_to_timestamp(s, F.lit(fmt))
        if fmt.endswith("yy") and not fmt.endswith("yyyy"):
            cand = F.when(s.rlike(r"^\d{1,2}/\d{1,2}/\d{2}$"), cand)
        elif fmt.endswith("yyyy"):
            cand = F.when(s.rlike(r"^\d{1,2}/\d{1,2}/\d{4}$|^\d{4}-\d{1,2}-\d{1,2}$"), cand)
        outs.append(F.to_date(cand))
    return F.coalesce(*outs)


def nonempty(x) -> Column:
    """'' -> NULL (NULLIF(x, ''))."""
    return F.nullif(_c(x), F.lit(""))


def first_nonempty(*cols) -> Column:
    """First argument that is neither NULL nor empty text."""
    return F.coalesce(*[nonempty(_c(c).cast("string")) for c in cols])
