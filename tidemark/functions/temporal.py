"""Dates, times and intervals as text; index values in the form the state log keeps."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: stands in for dates that are present but not valid.
ZERO_DATE = date(1, 1, 1)
ZERO_TIMESTAMP = datetime(1, 1, 1)

MICROS_PER_DAY = 86_400_000_000

INTEGER_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
TIMESTAMP_TYPES = (T.TimestampType, T.TimestampNTZType)


# Lengths of ``yyyy-MM-dd HH:mm:ss.ffffff`` and ``HH:mm:ss.ffffff``.
_STAMP = 26
_TIME = 15


def _with_six_digits(plain: Column, size: int) -> Column:
    """Spark trims trailing zeros of a fraction; a fraction here has none or six digits."""
    return F.when(F.contains(plain, F.lit(".")), F.rpad(plain, size, "0")).otherwise(plain)


def iso_timestamp(c: Column, zoned: bool = False) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` with six digits of fraction when there is one, and the offset when zoned."""
    text = _with_six_digits(c.cast("string"), _STAMP)
    return F.concat(text, F.date_format(c, "xxx")) if zoned else text


def iso_date(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def iso_time(c: Column) -> Column:
    """A TIME value as ``HH:mm:ss``, with six digits of fraction when there is one."""
    return _with_six_digits(c.cast("string"), _TIME)


def micros_time_of_day(micros: Column) -> Column:
    """A length of time as a time of day: whole days are dropped, a negative length is NULL."""
    rest = F.pmod(micros.cast("long"), F.lit(MICROS_PER_DAY))

    def field(unit: int, modulus: int, digits: int) -> Column:
        return F.lpad(F.floor(rest / F.lit(unit)).cast("long") % F.lit(modulus), digits, "0")

    clock = F.concat_ws(
        ":",
        field(3_600_000_000, 24, 2),
        field(60_000_000, 60, 2),
        field(1_000_000, 60, 2),
    )
    fraction = field(1, 1_000_000, 6)
    text = F.when(rest % F.lit(1_000_000) == 0, clock).otherwise(F.concat(clock, F.lit("."), fraction))
    return F.when(micros >= 0, text)


def interval_micros(c: Column) -> Column:
    """The length of a day-time interval in microseconds, whatever fields its type has."""
    c = c.cast("interval day to second")
    whole = (
        F.extract(F.lit("DAY"), c).cast("long") * 86_400
        + F.extract(F.lit("HOUR"), c).cast("long") * 3_600
        + F.extract(F.lit("MINUTE"), c).cast("long") * 60
    )
    return whole * 1_000_000 + (F.extract(F.lit("SECOND"), c) * 1_000_000).cast("long")


def interval_time_of_day(c: Column) -> Column:
    return micros_time_of_day(interval_micros(c))


def zero_date_default(c: Column, kind: str = "timestamp_ntz") -> Column:
    """Text dates: what cannot be read becomes the zero date, NULL stays NULL.

    ``kind`` is ``date`` or a timestamp type.
    """
    default = F.lit("0001-01-01").cast(kind)
    return F.when(c.isNotNull(), F.coalesce(c.try_cast(kind), default))


def replace_zero_dates(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Apply :func:`zero_date_default` to ``{column: kind}``."""
    return df.withColumns({name: zero_date_default(F.col(name), kind) for name, kind in columns.items()})


def _utc(c: Column) -> Column:
    """An instant as the clock shows it in UTC, without a zone."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(c), F.lit("1970-01-01").cast("timestamp_ntz"))


def index_value(text: Column, data_type: T.DataType) -> Column:
    """A text of :func:`index_text` as a value of the index column's own type."""
    if isinstance(data_type, T.TimestampType):
        text = F.concat(text, F.when(text.rlike(r"[0-9]$"), F.lit("Z")).otherwise(F.lit("")))
    return text.cast(data_type)


def index_text(c: Column, data_type: T.DataType) -> Column:
    """An index value as the state log keeps it: plain digits, or a timestamp with six digits of fraction.

    Other types cannot be kept, which is known from the schema before any row is read.
    """
    if isinstance(data_type, INTEGER_TYPES):
        return c.cast("string")
    if isinstance(data_type, TIMESTAMP_TYPES):
        # An instant is written, and read back, in UTC: a session's own zone has hours that occur twice.
        plain = c.cast("string") if isinstance(data_type, T.TimestampNTZType) else _utc(c).cast("string")
        whole = F.when(F.contains(plain, F.lit(".")), plain).otherwise(F.concat(plain, F.lit(".")))
        return F.rpad(whole, _STAMP, "0")
    raise TypeError(f"an index column must be an integer or a timestamp, not {data_type.simpleString()}")
