"""Scalar expressions, all on the JVM side."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- text -------------------------------------------------------------------

_CASE = {"upper": F.upper, "lower": F.lower, None: lambda c: c}


def _column(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def clean(col: Column | str, case: str | None = None) -> Column:
    """Trim and bring to upper or lower case."""
    return F.trim(_CASE[case](_column(col)))


def normalize_url(col: Column | str) -> Column:
    """Lower case, no scheme, no trailing slashes."""
    bare = F.lower(F.trim(_column(col)))
    for scheme in ("https://", "http://"):
        bare = F.replace(bare, F.lit(scheme), F.lit(""))
    return F.regexp_replace(bare, "/+$", "")


def url_parts(col: Column | str) -> tuple[Column, Column]:
    """``(site name, top-level domain)``: first and last label of a normalised URL's host."""
    host = F.try_parse_url(F.concat(F.lit("https://"), _column(col)), F.lit("HOST"))
    labels = F.split(host, r"\.")
    known = host.isNotNull() & (host != "")
    name = F.when(known, F.element_at(labels, 1)).otherwise("unknown")
    domain = F.when(known, F.element_at(labels, -1)).otherwise("unknown")
    return name, domain


def join_text(sep: str, *cols: Column | str) -> Column:
    """Concatenate with a separator, values cast to text, NULLs skipped."""
    return F.concat_ws(sep, *[_column(c).cast("string") for c in cols])


def max_length(col: Column | str, n: int) -> Column:
    return F.length(_column(col)) <= n


def like(col: Column | str, pattern: str) -> Column:
    return _column(col).like(pattern)


# --- casts and time ---------------------------------------------------------


def try_cast(col: Column | str, to: str) -> Column:
    """NULL where the value does not fit the type."""
    return _column(col).try_cast(to)


def parse_ts(col: Column | str, fmt: str, lenient: bool = True) -> Column:
    """Parse text as a zone-less timestamp; lenient gives NULL for bad text, strict raises."""
    parsed = F.try_to_timestamp(_column(col), F.lit(fmt)) if lenient else F.to_timestamp(_column(col), fmt)
    return parsed.cast("timestamp_ntz")


def date_of(col: Column | str) -> Column:
    return F.to_date(_column(col))


def time_of(col: Column | str) -> Column:
    """Time of day as ``HH:mm:ss`` text."""
    return F.date_format(_column(col), "HH:mm:ss")


def date_parts(col: Column | str) -> dict[str, Column]:
    c = _column(col)
    return {"year": F.year(c), "month": F.month(c), "hour": F.hour(c)}


def iso_week(col: Column | str) -> Column:
    return F.weekofyear(_column(col))


def iso_weekday(col: Column | str) -> Column:
    """Monday 1 to Sunday 7."""
    return F.weekday(_column(col)) + 1


def weekday_name(col: Column | str) -> Column:
    return F.date_format(_column(col), "EEEE")


def day_period(col: Column | str) -> Column:
    """5-11 MORNING, 12-16 AFTERNOON, 17-20 EVENING, else NIGHT."""
    hour = F.hour(_column(col))
    return (
        F.when(hour.between(5, 11), "MORNING")
        .when(hour.between(12, 16), "AFTERNOON")
        .when(hour.between(17, 20), "EVENING")
        .otherwise("NIGHT")
    )


def days_since(col: Column | str, as_of: date) -> Column:
    return F.datediff(F.lit(as_of), _column(col))


def add_days(col: Column | str, days: int | Column) -> Column:
    return F.date_add(_column(col), days)


def shift(col: Column | str, **interval: int) -> Column:
    """Add an interval given as ``hours=5`` or ``days=-30``."""
    return _column(col) + F.make_dt_interval(
        *[F.lit(interval.get(unit, 0)) for unit in ("days", "hours", "mins", "secs")]
    )


def minutes_between(start: Column | str, end: Column | str, digits: int = 2) -> Column:
    """Duration in minutes; zone-less and zoned timestamps alike."""
    span = _column(end) - _column(start)
    seconds = span.cast("interval day to second").cast("decimal(38,6)")
    return F.round(seconds / 60, digits).cast("double")


# --- numbers ----------------------------------------------------------------


def stable_round(col: Column | str, digits: int) -> Column:
    """Round half up, once, on the shortest decimal that stands for the double."""
    return F.round(_column(col), digits)


#: Units that a double is cut into: multiples of 2 ** 20, then of 2 ** -32, then of 2 ** -84.
_UNITS = (2.0**20, 2.0**-32, 2.0**-84)


def exact_sum(col: Column | str) -> Column:
    """The sum of doubles, whatever the order of the rows: equal rows give equal bits.

    Each value is cut without loss into whole multiples of three units; the multiples are added
    as whole numbers and the three sums put together at the end. What is below 2 ** -85 of a
    value is left out, as is what is below 2 ** -52 of the sum. Infinities, NaN and values of 2 ** 63 or more are added as in ``sum``.
    """
    value = _column(col).cast("double")
    finite = F.when(F.abs(value) < F.lit(2.0**63), value)
    rest, sums = finite, []
    for unit in _UNITS:
        whole = F.rint(rest / unit)
        sums.append(F.sum(whole.cast("decimal(28,0)")))
        rest = rest - whole * unit

    def power(k: int) -> Column:
        return F.lit(2**k).cast("decimal(20,0)")

    # in units of 2 ** -32; where there is room for them, with twenty bits more
    coarse = sums[0] * power(52) + sums[1]
    fine = coarse * power(20) + F.rint(sums[2].cast("double") / 2.0**32).cast("decimal(20,0)")
    total = F.when(F.abs(coarse.cast("double")) < 1e30, fine.cast("double") * 2.0**-52).otherwise(coarse.cast("double") * 2.0**-32)
    others = F.sum(F.when(value.isNotNull() & finite.isNull(), value))
    return F.coalesce(others + total, others, total)


def exact_mean(col: Column | str) -> Column:
    """The mean that follows from :func:`exact_sum`."""
    return F.try_divide(exact_sum(col), F.count(_column(col)))


def scaled(col: Column | str, factor: float, digits: int | None = None) -> Column:
    """Unit conversion, e.g. milliseconds to seconds."""
    value = _column(col) * F.lit(factor)
    return value if digits is None else stable_round(value, digits)


def ratio(num: Column, den: Column) -> Column:
    """NULL on a zero or missing denominator."""
    return F.try_divide(num, den)


def margin(revenue: Column | str, cost: Column | str) -> Column:
    return F.try_divide(_column(revenue) - _column(cost), _column(revenue))


def with_tax(amount: Column | str, rate: Column | str) -> Column:
    return _column(amount) * (1 + _column(rate))


def remainder(col: Column | str, n: int) -> Column:
    return _column(col) % n


# --- json, keys, lineage ----------------------------------------------------


def pack_json(*cols: str) -> Column:
    return F.to_json(F.struct(*cols))


def unpack_json(col: Column | str, schema: str | T.StructType) -> Column:
    return F.from_json(_column(col), schema)


# Fixed value: stands for NULL inside a surrogate key, so keys agree with those made elsewhere.
NULL_KEY_PART = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*cols: str, null: str = NULL_KEY_PART) -> Column:
    """md5 of the ``-``-joined values with a placeholder for NULL."""
    return F.md5(F.concat_ws("-", *[F.coalesce(F.col(c).cast("string"), F.lit(null)) for c in cols]))


def lineage(df: DataFrame, as_of: datetime | None = None, files: bool = False) -> DataFrame:
    """Add ``_ingested_at`` and, for file scans, ``_source_file``."""
    when = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp_ntz")
    df = df.withColumn("_ingested_at", when)
    return df.withColumn("_source_file", F.col("_metadata.file_path")) if files else df


def salt(n: int, *cols: str) -> Column:
    """Repeatable salt 0..n-1 from the row's own values."""
    return F.pmod(F.xxhash64(*cols), F.lit(n)).cast("int")
