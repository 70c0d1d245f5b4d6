"""Lateral (table-function) joins: each row expands into 0..n rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import java_split, utf16_length


def split_words(df: DataFrame, col: str, sep: str, keep: list[str],
                outer: bool = False, word: str = "word", length: str = "length") -> DataFrame:
    """``joinLateral(split(col) as (word, length))``: one row per part of the
    JVM-style split; an input with no part vanishes (inner) or keeps NULLs
    (``outer``, the left outer lateral join)."""
    gen = F.explode_outer if outer else F.explode
    parts = df.select(*keep, gen(java_split(col, sep)).alias(word))
    return parts.withColumn(length, utf16_length(word))
