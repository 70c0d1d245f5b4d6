"""Time conversions written so that they do not depend on the session time
zone: naive timestamps (TIMESTAMP_NTZ) are treated as UTC wall clock, and
every step is epoch arithmetic on built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

def epoch_ntz() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def epoch_micros(c: Column | str, naive: bool = True) -> Column:
    """Microseconds since 1970-01-01 of a TIMESTAMP_NTZ (``naive``) or a
    TIMESTAMP column.  For NTZ the difference of two NTZ values is a
    day-time interval whose fields are summed: no time zone is involved, so
    wall-clock times inside a DST gap of the session zone stay exact."""
    c = F.col(c) if isinstance(c, str) else c
    if not naive:
        return F.unix_micros(c)
    iv = c - epoch_ntz()
    return (F.extract(F.lit("DAY"), iv).cast("long") * 86_400_000_000
            + F.extract(F.lit("HOUR"), iv).cast("long") * 3_600_000_000
            + F.extract(F.lit("MINUTE"), iv).cast("long") * 60_000_000
            + (F.extract(F.lit("SECOND"), iv) * 1_000_000).cast("long"))


def epoch_seconds(c: Column | str, naive: bool = True) -> Column:
    """Whole seconds since 1970-01-01 (floor)."""
    c = F.col(c) if isinstance(c, str) else c
    if not naive:
        return F.unix_seconds(c)
    m = epoch_micros(c, naive=True)
    return ((m - F.pmod(m, F.lit(1_000_000))) / 1_000_000).cast("long")


def as_instant(c: Column | str) -> Column:
    """TIMESTAMP_NTZ → TIMESTAMP at the same UTC wall clock (what a
    watermark needs), independent of ``spark.sql.session.timeZone``."""
    return F.timestamp_micros(epoch_micros(c, naive=True))


def as_naive(c: Column | str) -> Column:
    """TIMESTAMP → TIMESTAMP_NTZ in UTC wall clock."""
    return F.timestamp_add("MICROSECOND", epoch_micros(c, naive=False), epoch_ntz())


def naive_from_seconds(c: Column | str, zone: str = "UTC") -> Column:
    """Epoch seconds → TIMESTAMP_NTZ, the wall clock of ``zone``; the
    ``TO_TIMESTAMP(FROM_UNIXTIME(ts))`` computed column of a session in that
    zone."""
    c = F.col(c) if isinstance(c, str) else c
    ntz = F.timestamp_add("SECOND", c, epoch_ntz())
    return ntz if zone == "UTC" else F.convert_timezone(F.lit("UTC"), F.lit(zone), ntz)


def format_epoch_seconds(c: Column | str, tz: str = "UTC",
                         fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Epoch seconds → text in time zone ``tz`` (the reading-to-record map
    that formats ``timestamp * 1000`` with a date pattern)."""
    return F.date_format(naive_from_seconds(c, tz), fmt)
