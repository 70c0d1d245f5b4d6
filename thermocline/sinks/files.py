"""Append-mode CSV file sink with a custom delimiter."""

from __future__ import annotations

from pyspark.sql import DataFrame


#: A field is written as it is: blanks stay, a quote inside a quoted field is
#: doubled, NULL is an empty field and an empty text a quoted one.
WRITE_OPTIONS = {"header": "false", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
                 "escape": '"', "nullValue": "", "emptyValue": '""'}
#: The reader's side of that (also for ``from_csv``).
READ_OPTIONS = {"header": "false", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
                "escape": '"', "nullValue": "\0", "emptyValue": ""}


def write_csv(df: DataFrame, path: str, sep: str = ",", mode: str = "append") -> None:
    df.write.mode(mode).options(**WRITE_OPTIONS).option("sep", sep).csv(path)


def csv_stream(df: DataFrame, path: str, checkpoint: str, sep: str = ",", trigger: dict | None = None):
    """``inAppendMode().withFormat(Csv().fieldDelimiter(sep))`` on a stream."""
    w = (df.writeStream.format("csv").options(**WRITE_OPTIONS).option("sep", sep)
         .option("path", path).option("checkpointLocation", checkpoint).outputMode("append"))
    if trigger:
        w = w.trigger(**trigger)
    return w.start()
