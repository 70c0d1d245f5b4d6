"""Text splitting with the JVM's ``String.split(regex)`` result shape."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def java_split(c: Column | str, pattern: str, drop_trailing_empty: bool = True) -> Column:
    """Split by a regular expression.  Spark keeps trailing empty parts; the
    JVM's one-argument split drops them unless nothing matched at all (then
    the input itself is the single part, even when it is empty)."""
    s = F.col(c) if isinstance(c, str) else c
    parts = F.split(s, pattern, -1)
    if not drop_trailing_empty:
        return parts
    p = F.array_position(F.transform(F.reverse(parts), lambda x: x != F.lit("")), True)
    keep = F.when(p == 0, F.lit(0)).otherwise(F.size(parts) - p + 1).cast("int")
    return F.when(F.size(parts) <= 1, parts).otherwise(F.slice(parts, 1, keep))


def utf16_length(c: Column | str) -> Column:
    """The JVM's ``String.length``: UTF-16 units, two for an astral character."""
    c = F.col(c) if isinstance(c, str) else c
    return (F.octet_length(F.encode(c, "UTF-16LE")) / 2).cast("int")
