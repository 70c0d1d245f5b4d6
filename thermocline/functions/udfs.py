"""User-defined function surface.

* Scalar functions for SQL (``hash_code(s, factor)``, the three ``hash_*``
  overloads, ``java_split``) are registered as SQL functions whose bodies
  are built-in expressions: callable by name from SQL, evaluated in the JVM.
* A table function for ``LATERAL`` use in SQL (:func:`register_split_udtf`)
  is a SQL function too.  The aggregate function accumulates in Arrow batches
  on the map side (:func:`partial_averages`), merges by built-in sums and has
  its value step registered for SQL (:func:`register_avg_udaf`).
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_WRAP = "CAST(pmod(({x}) + 2147483648, 4294967296) - 2147483648 AS INT)"

# code points of the string; an astral one stands for its two UTF-16 units
_STRING_HASH_U = ("CASE WHEN length({s}) = 0 THEN 0L ELSE aggregate("
                  "transform(split({s}, ''), ch -> CAST(ascii(ch) AS BIGINT)), 0L, (a, cp) -> "
                  "CASE WHEN cp < 65536 THEN pmod(a * 31 + cp, 4294967296L) "
                  "ELSE pmod(a * 961 + (55296 + shiftright(cp - 65536, 10)) * 31 "
                  "+ 56320 + pmod(cp - 65536, 1024), 4294967296L) END) END")


def string_hash_sql(s: str) -> str:
    """SQL text of the JVM ``String.hashCode`` of expression ``s``."""
    return f"CASE WHEN {s} IS NULL THEN NULL ELSE " + _WRAP.format(
        x=_STRING_HASH_U.format(s=s)) + " END"


def double_hash_sql(x: str) -> str:
    """SQL text of the JVM ``Double.hashCode`` of expression ``x``."""
    a = f"abs({x})"
    e0 = f"floor(log2({a}))"
    m0 = f"({a} / pow(2D, {e0}))"
    e = f"({e0} + CASE WHEN {m0} >= 2 THEN 1 WHEN {m0} < 1 THEN -1 ELSE 0 END)"
    sub = f"({a} < 2.2250738585072014E-308D)"
    frac = (f"CAST(CASE WHEN {sub} THEN {a} * pow(2D, 1022) * pow(2D, 52) "
            f"ELSE ({a} / pow(2D, {e}) - 1D) * pow(2D, 52) END AS BIGINT)")
    biased = f"CAST(CASE WHEN {sub} THEN 0 ELSE {e} + 1023 END AS BIGINT)"
    sign = f"CASE WHEN {x} < 0 THEN 2147483648L ELSE 0L END"
    hi = f"({sign} + {biased} * 1048576L + CAST(floor({frac} / 4294967296D) AS BIGINT))"
    lo = f"pmod({frac}, 4294967296L)"
    return (f"CASE WHEN {x} IS NULL THEN NULL WHEN isnan({x}) THEN 2146959360 "
            f"WHEN {x} = double('infinity') THEN 2146435072 "
            f"WHEN {x} = double('-infinity') THEN -1048576 "
            f"WHEN {x} = 0 AND CAST({x} AS STRING) = '-0.0' THEN -2147483648 "
            f"WHEN {x} = 0 THEN 0 ELSE {_WRAP.format(x=f'{hi} ^ {lo}')} END")


def java_split_sql(s: str, sep: str) -> str:
    """SQL text of the JVM one-argument ``split``: trailing empty parts
    dropped unless nothing matched."""
    parts = f"split({s}, {sep}, -1)"
    p = f"array_position(transform(reverse({parts}), x -> x != ''), true)"
    keep = f"CAST(CASE WHEN {p} = 0 THEN 0 ELSE size({parts}) - {p} + 1 END AS INT)"
    return f"CASE WHEN size({parts}) <= 1 THEN {parts} ELSE slice({parts}, 1, {keep}) END"


def register_sql_functions(spark: SparkSession, python_workers: bool = True) -> None:
    """Register the scalar functions by name (temporary, session scope).

    ``hash_double`` and ``java_split`` are SQL functions over built-in
    expressions.  The string-hash overloads are vectorised Arrow UDFs
    (``python_workers``) or, when Python workers are unwanted, SQL functions
    over the interpreted built-in form."""
    defs = {
        "java_split(s STRING, sep STRING) RETURNS ARRAY<STRING>": java_split_sql("s", "sep"),
    }
    if not python_workers:
        defs.update({
            "hash_double(x DOUBLE) RETURNS INT": double_hash_sql("x"),
            "hash_string(s STRING) RETURNS INT": string_hash_sql("s"),
            "hash_code(s STRING, factor INT) RETURNS INT":
                _WRAP.format(x=f"CAST({string_hash_sql('s')} AS BIGINT) * factor"),
            "hash_pair(s STRING, x DOUBLE) RETURNS INT":
                _WRAP.format(x=f"CAST({string_hash_sql('s')} AS BIGINT) + "
                               f"CAST({double_hash_sql('x')} AS BIGINT)"),
        })
    for name in ("hash_string", "hash_code", "hash_pair", "hash_double", "java_split",
                 "hash_double_bits"):
        spark.sql(f"DROP TEMPORARY FUNCTION IF EXISTS {name}")
    for sig, body in defs.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {sig} RETURN {body}")
    if python_workers:
        _register_hash_udfs(spark)


def _register_hash_udfs(spark: SparkSession) -> None:
    """``hash_string`` and the double's bit hash as vectorised Arrow UDFs;
    ``hash_double``, ``hash_code`` and ``hash_pair`` as SQL functions over
    them (the factor product and the INT wrap stay JVM expressions, and the
    NULL flag keeps NULL apart from NaN, which pandas cannot tell apart)."""
    import pandas as pd

    from pyspark.sql.functions import pandas_udf

    from .scalar import double_hash_values, string_hash_values

    @pandas_udf("int")
    def hash_string(s: pd.Series) -> pd.Series:
        return string_hash_values(s)

    @pandas_udf("int")
    def hash_double_bits(x: pd.Series, is_null: pd.Series) -> pd.Series:
        return double_hash_values(x, is_null)

    spark.udf.register("hash_string", hash_string)
    spark.udf.register("hash_double_bits", hash_double_bits)
    defs = {
        "hash_double(x DOUBLE) RETURNS INT": "hash_double_bits(x, x IS NULL)",
        "hash_code(s STRING, factor INT) RETURNS INT":
            _WRAP.format(x="CAST(hash_string(s) AS BIGINT) * factor"),
        "hash_pair(s STRING, x DOUBLE) RETURNS INT":
            _WRAP.format(x="CAST(hash_string(s) AS BIGINT) + CAST(hash_double_bits(x, x IS NULL) AS BIGINT)"),
    }
    for sig, body in defs.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {sig} RETURN {body}")


def register_split_udtf(spark: SparkSession, name: str = "split_words") -> None:
    """``LATERAL split_words(text, sep)`` → rows ``(word, length)``: a SQL
    table function over built-in expressions, evaluated in the JVM with its
    regular expressions and string lengths."""
    spark.sql(f"DROP TEMPORARY FUNCTION IF EXISTS {name}")
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}(text STRING, sep STRING)
        RETURNS TABLE (word STRING, length INT)
        RETURN SELECT p.word, CAST(octet_length(encode(p.word, 'UTF-16LE')) / 2 AS INT)
               FROM explode({java_split_sql("text", "sep")}) AS p(word)""")


def partial_averages(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """The accumulate step of the average aggregate function, run where the
    rows are: per Arrow batch one accumulator ``(total, n)`` for each key in
    it, so a hot key leaves a map task as a few rows.  Accumulators merge by
    ``sum``; :func:`register_avg_udaf` gives the value of the merged one."""
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            got = pa.table(batch).group_by(keys).aggregate([(value, "sum"), (value, "count")])
            got = got.select([*keys, f"{value}_sum", f"{value}_count"]).rename_columns([*keys, "total", "n"])
            yield from got.to_batches()

    types = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)
    return (df.select(*keys, F.col(value).cast("double").alias(value))
            .mapInArrow(run, f"{types}, total double, n long"))


def register_avg_udaf(spark: SparkSession, name: str = "avg_temp") -> None:
    """Register the value step for SQL: ``avg_temp(sum(total), sum(n))``,
    NULL without a value."""
    spark.sql(f"DROP TEMPORARY FUNCTION IF EXISTS {name}")
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(total DOUBLE, n BIGINT) RETURNS DOUBLE "
              "RETURN CASE WHEN n > 0 THEN total / n END")
