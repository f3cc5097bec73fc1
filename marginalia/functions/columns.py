"""Column helpers shared by every operator.

All helpers return ``Column`` expressions built from Spark built-ins, so they
stay inside whole-stage codegen.  Each one fixes one semantic difference
between the SQL dialect the reference targets and Spark (see the notes).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

def c(x) -> Column:
    """Accept a column name or a Column."""
    return F.col(x) if isinstance(x, str) else x


def lit_or_col(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


# --- periods ----------------------------------------------------------------

def in_months(col, start: str, end: str) -> Column:
    """Whether a date or timestamp lies in the calendar months that ``start`` to ``end`` touch.

    A range over the column as it is, so it reaches the scan; filter a feed
    by it before a month roll-up, and no month of the range loses a row.
    """
    first = F.trunc(F.lit(start).cast("date"), "MM")
    after = F.add_months(F.trunc(F.lit(end).cast("date"), "MM"), 1)
    return (c(col) >= first) & (c(col) < after)


# --- ratios -----------------------------------------------------------------

def safe_div(num, den) -> Column:
    """NULL when the denominator is 0 or NULL (never raises under ANSI mode)."""
    num = F.col(num) if isinstance(num, str) else lit_or_col(num)
    den = F.col(den) if isinstance(den, str) else lit_or_col(den)
    return F.try_divide(num, den)


def zero_as_null(x) -> Column:
    """I-24: sentinel 0 -> NULL (quality score 0, impression share 0, ...)."""
    x = c(x)
    return F.when(x != 0, x)


def blank_as_null(x) -> Column:
    """'' -> NULL: reproduces Python truthiness of text fields."""
    x = c(x)
    return F.when(x != "", x)


def nz(x, default=0) -> Column:
    return F.coalesce(c(x), F.lit(default))


# --- rounding and casts ------------------------------------------------------

def round_to_long(x) -> Column:
    """float -> integer rounding half away from zero (a plain cast truncates)."""
    return F.round(c(x)).cast("bigint")


def money(x, scale: int = 2) -> Column:
    return F.round(c(x).cast("double"), scale)


def try_double(x) -> Column:
    """Text -> double; bad text -> NULL; NULL passes."""
    return c(x).try_cast("double")


def try_long(x) -> Column:
    """Text -> bigint through double, so '3.0' -> 3 (a direct try_cast gives NULL)."""
    return c(x).try_cast("double").try_cast("bigint")


# --- dates -------------------------------------------------------------------

def month_start(d) -> Column:
    """First day of the month, as a DATE (``date_trunc`` would give a TIMESTAMP)."""
    return F.trunc(c(d), "MM")


def monday_week(d) -> Column:
    """Monday-based week start as a DATE."""
    return F.trunc(c(d), "WEEK")


def sunday_week(d) -> Column:
    """Sunday-based week start as a DATE (the default ``week`` of the source dialect)."""
    d = c(d)
    return F.date_sub(d, F.dayofweek(d) - 1)


def month_diff(later, earlier) -> Column:
    """Number of calendar-month boundaries between two dates (Jan 31 -> Mar 1 = 2)."""
    a, b = c(later), c(earlier)
    return (F.year(a) - F.year(b)) * 12 + (F.month(a) - F.month(b))


def day_diff(later, earlier) -> Column:
    return F.datediff(c(later), c(earlier))


def as_date(x) -> Column:
    return c(x).cast("date")


# --- text ----------------------------------------------------------------------

def norm_key(x) -> Column:
    """Normalised lookup key: lower(trim(x))."""
    return F.lower(F.trim(c(x)))


def regex_group_or_null(x, pattern: str, idx: int = 1) -> Column:
    """``regexp_extract`` returns '' on no match; the source dialect returns NULL."""
    return blank_as_null(F.regexp_extract(c(x), pattern, idx))


def gid_to_long(x) -> Column:
    """'gid://shop/Order/123' -> 123 (last path segment)."""
    return F.element_at(F.split(c(x), "/"), -1).try_cast("bigint")


def micros(x, zero_null: bool = False) -> Column:
    """I-23: money micros -> units; optionally 0 -> NULL first."""
    x = c(x)
    if zero_null:
        x = zero_as_null(x)
    return x / F.lit(1_000_000.0)


def utm_param(url, name: str) -> Column:
    """First non-blank value of ``utm_<name>`` in the query of a landing URL, plus- and percent-decoded.

    Blank values count as absent; an undecodable value keeps its raw text.
    """
    query = F.regexp_replace(c(url), "#.*$", "")
    raw = blank_as_null(F.regexp_extract(query, rf"[?&]utm_{name}=([^&]+)", 1))
    plus = F.regexp_replace(raw, r"\+", " ")
    return F.coalesce(F.try_url_decode(plus), plus)


def domain_label(prop) -> Column:
    """'sc-domain:example.com' -> example.com; a URL property -> its host."""
    p = c(prop)
    return F.when(p.startswith("sc-domain:"), F.substr(p, F.lit(11))) \
        .otherwise(F.coalesce(F.try_parse_url(p, F.lit("HOST")), p))


def round_half_away(x, scale: int = 2) -> Column:
    """Decimal rounding, half away from zero, of a double that carries float noise.

    The value is first snapped to 1e-6 (removing summation-order noise), then
    rounded at ``scale``; both steps use floor on |x|, so an amount such as
    2.675 stored as 2.67499999... still rounds to 2.68, as decimal ROUND does.
    """
    x = c(x)
    k = float(10 ** scale)
    mag = F.floor(F.abs(x) * 1000000.0 + 0.5) / 1000000.0
    return F.signum(x) * (F.floor(mag * k + 0.5) / k)


def sql_round_half_away(expr: str, scale: int = 2) -> str:
    """The same rounding as ``round_half_away`` written for a SQL engine (used by the oracles)."""
    k = f"{float(10 ** scale)}"
    mag = f"(floor(abs({expr}) * 1000000.0 + 0.5) / 1000000.0)"
    return f"(sign({expr}) * (floor({mag} * {k} + 0.5) / {k}))"
