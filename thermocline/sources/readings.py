"""Readings ``(id, timestamp, temperature)``: declared schema, parsing of
delimited text lines, CSV tables, and the DDL-declared table with a computed
event-time column.  Nothing is inferred from data; malformed input fails
the job (ANSI casts raise, CSV reads use FAILFAST)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.time import as_instant, naive_from_seconds

READING_SCHEMA = T.StructType([
    T.StructField("id", T.StringType(), False),
    T.StructField("timestamp", T.LongType(), True),
    T.StructField("temperature", T.DoubleType(), True),
])
READING_DDL = "id STRING, timestamp BIGINT, temperature DOUBLE"


def parse_lines(lines: DataFrame, sep: str = " ", trim: bool = True,
                value_col: str = "value", names: tuple[str, str, str] = ("id", "timestamp", "temperature"),
                ts_scale: int = 1) -> DataFrame:
    """Text lines ``id<sep>timestamp<sep>temperature`` → typed readings.

    ``sep`` is a regular expression (``" "``, ``","``, ``"-"``); ``trim``
    trims every field; ``ts_scale`` multiplies the timestamp (1000 turns
    epoch seconds into milliseconds).  Works on any DataFrame with a text
    ``value`` column — a file, socket or Kafka stream alike."""
    parts = F.split(F.col(value_col), sep, -1)
    f = [parts.getItem(i) for i in range(3)]
    if trim:
        f = [F.trim(x) for x in f]
    ts = f[1].cast("bigint")
    if ts_scale != 1:
        ts = ts * F.lit(ts_scale)
    return lines.select(f[0].alias(names[0]), ts.alias(names[1]),
                        f[2].cast("double").alias(names[2]))


def read_text(spark: SparkSession, path: str, stream: bool = False, **opts) -> DataFrame:
    reader = spark.readStream if stream else spark.read
    for k, v in opts.items():
        reader = reader.option(k, v)
    return reader.text(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str = READING_SCHEMA,
             sep: str = ",", stream: bool = False, **opts) -> DataFrame:
    """``connect(FileSystem(path)).withFormat(Csv().fieldDelimiter(sep))
    .withSchema(schema)`` as a batch or streaming DataFrame."""
    reader = spark.readStream if stream else spark.read
    reader = (reader.schema(schema).option("sep", sep).option("header", "false")
              .option("mode", "FAILFAST"))
    for k, v in opts.items():
        reader = reader.option(k, v)
    return reader.csv(path)


def register_csv_table(spark: SparkSession, name: str, path: str,
                       schema: T.StructType | str = READING_SCHEMA, sep: str = ",") -> DataFrame:
    """Register a CSV file as a temporary view (the catalog table)."""
    df = read_csv(spark, path, schema, sep)
    df.createOrReplaceTempView(name)
    return df


def ddl_table(spark: SparkSession, name: str, path: str, sep: str = ",",
              stream: bool = False, watermark: str = "1 second", zone: str | None = None) -> DataFrame:
    """``CREATE TABLE name (id VARCHAR(20) NOT NULL, ts BIGINT, temperature
    DOUBLE, rt AS TO_TIMESTAMP(FROM_UNIXTIME(ts)), WATERMARK FOR rt AS rt -
    INTERVAL '1' SECOND) WITH (filesystem, csv)``.

    Spark DDL has no computed columns or WATERMARK clause, so the view is a
    CSV source plus ``rt`` and, when streaming, ``withWatermark``.  ``rt`` is
    the wall clock of ``zone``, the session's time zone unless given."""
    schema = "id STRING, ts BIGINT, temperature DOUBLE"
    df = read_csv(spark, path, schema, sep, stream)
    df = with_computed_rowtime(df, "ts", "rt", zone=zone or spark.conf.get("spark.sql.session.timeZone"))
    if stream:
        df = (df.withColumn("rt", as_instant("rt"))  # watermark needs TIMESTAMP
              .withWatermark("rt", watermark))
    df.createOrReplaceTempView(name)
    return df


def with_computed_rowtime(df: DataFrame, seconds_col: str, out: str = "rt",
                          delay_seconds: int = 1, zone: str = "UTC") -> DataFrame:
    """Computed columns of the DDL table: ``rt`` = epoch seconds as a
    timestamp, and ``rt_wm`` = ``rt - INTERVAL delay`` (the watermark
    expression, exposed as a column for batch use); the wall clock of
    ``zone``."""
    rt = naive_from_seconds(F.col(seconds_col), zone)
    return (df.withColumn(out, rt)
            .withColumn(f"{out}_wm", rt - F.expr(f"INTERVAL {int(delay_seconds)} SECONDS")))


def ddl_table_sql(spark: SparkSession, name: str, path: str, sep: str = ",", zone: str | None = None) -> DataFrame:
    """The DDL-declared table in SQL only: a CSV view with the declared
    columns, and a view over it that adds the computed rowtime columns
    (Spark DDL has no computed columns, so the second view carries them)."""
    raw = f"{name}_raw"
    zone = zone or spark.conf.get("spark.sql.session.timeZone")
    rt = f"convert_timezone('UTC', '{zone}', timestampadd(SECOND, ts, TIMESTAMP_NTZ'1970-01-01 00:00:00'))"
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {raw} (id STRING, ts BIGINT, temperature DOUBLE) "
              f"USING csv OPTIONS (path '{path}', sep '{sep}', header 'false', mode 'FAILFAST')")
    spark.sql(f"""CREATE OR REPLACE TEMPORARY VIEW {name} AS
        SELECT *, {rt} AS rt, {rt} - INTERVAL 1 SECOND AS rt_wm
        FROM {raw}""")
    return spark.table(name)
