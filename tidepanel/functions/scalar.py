"""Scalar column functions (all JVM-side built-ins, no Python per row)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._col import as_col

# Fixed values that must equal the reference's for equal results.
EARTH_RADIUS_NM = 3440.065
EVENT_NAME_PREFIXES = ("Hurricane ", "Tropical Storm ", "Tropical Cyclone ")
SENTINELS = ("", "-999", "-99")
STAR_LEVELS = ((0.01, "***"), (0.05, "**"), (0.10, "*"))


def haversine_nm(lat1, lon1, lat2, lon2) -> Column:
    """great-circle distance in nautical miles."""
    la1, lo1, la2, lo2 = (F.radians(as_col(c)) for c in (lat1, lon1, lat2, lon2))
    a = (F.pow(F.sin((la2 - la1) / 2), 2)
         + F.cos(la1) * F.cos(la2) * F.pow(F.sin((lo2 - lo1) / 2), 2))
    return F.lit(2 * EARTH_RADIUS_NM) * F.asin(F.sqrt(a))


def normalize_event_name(c) -> Column:
    """drop the first matching prefix, cut at '(', trim, upper-case."""
    pattern = "^(" + "|".join(EVENT_NAME_PREFIXES) + ")"
    stripped = F.regexp_replace(as_col(c), pattern, "")
    return F.upper(F.trim(F.split_part(stripped, F.lit("("), F.lit(1))))


def upper_trim(c) -> Column:
    """join-key normalisation."""
    return F.upper(F.trim(as_col(c)))


def short_name(c) -> Column:
    """text before the first ',' then before the first '-', trimmed."""
    first = F.split_part(as_col(c), F.lit(","), F.lit(1))
    return F.trim(F.split_part(first, F.lit("-"), F.lit(1)))


def slug(c) -> Column:
    """lower case, spaces to '_', dots removed."""
    return F.replace(F.replace(F.lower(as_col(c)), F.lit(" "), F.lit("_")),
                     F.lit("."), F.lit(""))


def month_start(c) -> Column:
    return F.trunc(F.to_date(as_col(c)), "month")


def month_end(c) -> Column:
    return F.last_day(F.to_date(as_col(c)))


def date_parts(c) -> dict[str, Column]:
    """year, month, year-month and ISO text of a date column."""
    d = F.to_date(as_col(c))
    return {
        "year": F.year(d),
        "month": F.month(d),
        "year_month": F.date_format(d, "yyyy-MM"),
        "iso_date": F.date_format(d, "yyyy-MM-dd"),
    }


def round_half_even(c, scale: int = 0) -> Column:
    """half-even rounding (numpy/pandas style)."""
    return F.bround(as_col(c), scale)


def millions_to_billions(c) -> Column:
    return F.bround(as_col(c) / F.lit(1000.0), 2)


def safe_ln(c) -> Column:
    """F8: natural log, NULL for x <= 0 (pandas gives -inf/NaN)."""
    x = as_col(c)
    return F.when(x > 0, F.ln(x))


def sig_stars(p) -> Column:
    """significance stars from a p-value."""
    p = as_col(p)
    out = F.when(p.isNull(), F.lit(""))
    for level, stars in STAR_LEVELS:
        out = out.when(p < level, F.lit(stars))
    return out.otherwise(F.lit(""))


def sentinel_int(c) -> Column:
    """P4: '', -999, -99 and non-integers become NULL."""
    s = F.trim(as_col(c).cast("string"))
    return F.when(s.isin(*SENTINELS) | s.isNull(), F.lit(None).cast("int")) \
        .otherwise(s.try_cast("int"))


def signed_lat(c) -> Column:
    """P5: '28.0N' -> 28.0; anything but N is south (negative)."""
    s = F.trim(as_col(c))
    num = F.substring(s, 1, F.length(s) - 1).try_cast("double")
    return F.when(F.upper(F.substring(s, -1, 1)) == "N", num).otherwise(-num)


def signed_lon(c) -> Column:
    """P5: '80.1W' -> -80.1; anything but W is east (positive)."""
    s = F.trim(as_col(c))
    num = F.substring(s, 1, F.length(s) - 1).try_cast("double")
    return F.when(F.upper(F.substring(s, -1, 1)) == "W", -num).otherwise(num)


def tolerant_double(c) -> Column:
    """Empty or non-numeric text becomes NULL instead of an error."""
    return F.trim(as_col(c).cast("string")).try_cast("double")


def nan_to_null(c) -> Column:
    x = as_col(c)
    return F.when(~F.isnan(x), x)


def safe_div(a, b) -> Column:
    return F.try_divide(as_col(a), as_col(b))


def safe_corr(a, b) -> Column:
    """Pearson r over pairwise-complete rows; NULL for n<2 or zero variance.

    The built-in ``corr`` raises under ANSI mode when a variance is zero.
    """
    a, b = as_col(a), as_col(b)
    both = a.isNotNull() & b.isNotNull()
    aa = F.when(both, a)
    bb = F.when(both, b)
    den = F.sqrt(F.var_pop(aa) * F.var_pop(bb))
    return F.when(F.count(aa) >= 2,
                  F.try_divide(F.covar_pop(aa, bb), F.when(den > 0, den)))


def safe_slope(y, x) -> Column:
    """Least-squares slope; NULL when x has no variance."""
    y, x = as_col(y), as_col(x)
    both = y.isNotNull() & x.isNotNull()
    xx, yy = F.when(both, x), F.when(both, y)
    return F.try_divide(F.covar_pop(xx, yy), F.when(F.var_pop(xx) > 0, F.var_pop(xx)))


def safe_intercept(y, x) -> Column:
    y, x = as_col(y), as_col(x)
    both = y.isNotNull() & x.isNotNull()
    xx, yy = F.when(both, x), F.when(both, y)
    return F.avg(yy) - safe_slope(yy, xx) * F.avg(xx)
