"""Column functions (scalar).

The two hash functions reproduce the JVM's ``String.hashCode`` and
``Double.hashCode`` bit for bit, because user functions of the reference
return exactly those 32-bit values.  The double hash and all formatting are
built-in expressions (whole-stage codegen).  The string hash is a polynomial
over UTF-16 units; as built-in higher-order lambdas it runs interpreted
(about 13 us per row), so the default is a vectorised Arrow UDF that hashes a
whole batch with numpy (about 10x faster); :func:`java_string_hash_expr`
is the all-JVM form for SQL function bodies.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

_2_32 = 4294967296
_2_31 = 2147483648


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_col(c: Column | str) -> Column:
    return F.trim(_c(c))


def wrap_int32(c: Column) -> Column:
    """Two's-complement wrap of a BIGINT to INT (what JVM int arithmetic
    does silently; Spark's ANSI mode would raise instead)."""
    u = F.pmod(c, F.lit(_2_32))
    return F.when(u >= _2_31, u - _2_32).otherwise(u).cast("int")


def string_hash_values(values: pd.Series, most_chars: int = 1 << 20) -> pd.Series:
    """JVM ``String.hashCode`` of every string of a pandas batch, in slices of
    about ``most_chars`` characters so that work space stays bounded."""
    chars = values.str.len().fillna(0).to_numpy().cumsum()
    parts, lo = [], 0
    while lo < len(values):
        hi = max(lo + 1, int(np.searchsorted(chars, (chars[lo - 1] if lo else 0) + most_chars, side="right")))
        parts.append(_string_hashes(values.iloc[lo:hi]))
        lo = hi
    return pd.concat(parts, ignore_index=True) if parts else pd.Series([], dtype="Int32")


def _string_hashes(values: pd.Series) -> pd.Series:
    """The units of all strings in one uint32 array, each multiplied by
    31^(distance to its string's end) (uint32 arithmetic wraps mod 2^32),
    summed per string."""
    mask = values.isna().to_numpy()
    enc = [b"" if m else v.encode("utf-16-le") for v, m in zip(values.tolist(), mask)]
    lens = np.fromiter((len(b) // 2 for b in enc), dtype=np.int64, count=len(enc))
    out = np.zeros(len(enc), dtype=np.uint32)
    if lens.sum():
        units = np.frombuffer(b"".join(enc), dtype="<u2").astype(np.uint32)
        ends = np.cumsum(lens)
        seg = np.repeat(np.arange(len(enc)), lens)
        expo = ends[seg] - 1 - np.arange(len(units))
        powers = np.cumprod(np.concatenate([[1], np.full(int(lens.max()) - 1, 31)]).astype(np.uint32),
                            dtype=np.uint32)
        nz = lens > 0
        out[nz] = np.add.reduceat(units * powers[expo], (ends - lens)[nz], dtype=np.uint32)
    res = pd.Series(out.view(np.int32), dtype="Int32")
    res[mask] = pd.NA
    return res


_UDF: dict = {}


def _string_hash_udf():
    if "h" not in _UDF:
        def string_hash(s: pd.Series) -> pd.Series:
            return string_hash_values(s)
        _UDF["h"] = F.pandas_udf(string_hash, "int")
    return _UDF["h"]


def java_string_hash(c: Column | str) -> Column:
    """``s.hashCode`` of the JVM: sum of s[i]·31^(n-1-i) over UTF-16 units,
    modulo 2^32, as a signed INT.  NULL stays NULL."""
    return _string_hash_udf()(_c(c))


def java_string_hash_expr(c: Column | str) -> Column:
    """The same hash as built-in expressions only (no Python worker):
    code points from ``split(s, '')``, astral ones as two surrogate units."""
    s = _c(c)
    cps = F.transform(F.split(s, ""), lambda ch: F.ascii(ch).cast("bigint"))

    def step(a, cp):
        v = cp - 65536
        hi = F.lit(0xD800) + F.shiftright(v, 10)
        lo = F.lit(0xDC00) + F.pmod(v, F.lit(1024))
        return (F.when(cp < 65536, F.pmod(a * 31 + cp, F.lit(_2_32)))
                .otherwise(F.pmod(a * 961 + hi * 31 + lo, F.lit(_2_32))))

    acc = F.when(F.length(s) == 0, F.lit(0).cast("bigint")).otherwise(
        F.aggregate(cps, F.lit(0).cast("bigint"), step))
    return F.when(s.isNull(), F.lit(None).cast("int")).otherwise(wrap_int32(acc))


def scaled_hash(c: Column | str, factor: int) -> Column:
    """String hash times a constructor factor, with INT wrap-around
    (the parameterised scalar function)."""
    return wrap_int32(java_string_hash(c).cast("bigint") * F.lit(int(factor)))


def _double_hash_unsigned_parts(x: Column) -> tuple[Column, Column]:
    """High and low 32-bit words of the IEEE-754 bits of a finite non-zero
    double, each as a non-negative BIGINT, by exact power-of-two scaling."""
    a = F.abs(x)
    e0 = F.floor(F.log2(a)).cast("int")
    m0 = a / F.pow(F.lit(2.0), e0)
    e = (F.when(m0 >= 2.0, e0 + 1).when(m0 < 1.0, e0 - 1).otherwise(e0))
    subnormal = a < F.lit(2.2250738585072014e-308)
    frac_normal = (a / F.pow(F.lit(2.0), e) - 1.0) * F.pow(F.lit(2.0), F.lit(52))
    frac_sub = (a * F.pow(F.lit(2.0), F.lit(1022))) * F.pow(F.lit(2.0), F.lit(52))
    frac = F.when(subnormal, frac_sub).otherwise(frac_normal).cast("bigint")
    biased = F.when(subnormal, F.lit(0)).otherwise(e + 1023).cast("bigint")
    sign = F.when(x < 0, F.lit(_2_31)).otherwise(F.lit(0)).cast("bigint")
    hi = sign + biased * 1048576 + F.floor(frac / F.lit(_2_32)).cast("bigint")
    lo = F.pmod(frac, F.lit(_2_32))
    return hi, lo


def double_hash_values(x: pd.Series, is_null: pd.Series) -> pd.Series:
    """JVM ``Double.hashCode`` of a pandas batch from the IEEE bits (NaN in
    its canonical form).  Arrow turns NULL doubles into NaN, so NULL comes
    as a separate flag."""
    arr = x.to_numpy(dtype=np.float64, na_value=np.nan)
    bits = arr.view(np.uint64).copy()
    bits[np.isnan(arr)] = np.uint64(0x7FF8000000000000)
    h = ((bits ^ (bits >> np.uint64(32))) & np.uint64(0xFFFFFFFF)).astype(np.uint32).view(np.int32)
    res = pd.Series(h, dtype="Int32")
    res[is_null.to_numpy(dtype=bool)] = pd.NA
    return res


def _double_hash_udf():
    if "d" not in _UDF:
        def double_hash(x: pd.Series, is_null: pd.Series) -> pd.Series:
            return double_hash_values(x, is_null)
        _UDF["d"] = F.pandas_udf(double_hash, "int")
    return _UDF["d"]


def java_double_hash(c: Column | str) -> Column:
    """``Double.hashCode`` of the JVM: (int)(bits ^ (bits >>> 32)) with the
    canonical NaN, read from the bits of each value in an Arrow batch."""
    x = _c(c)
    return _double_hash_udf()(x, x.isNull())


def java_double_hash_expr(c: Column | str) -> Column:
    """The same hash from exact power-of-two arithmetic, built-in only."""
    x = _c(c)
    hi, lo = _double_hash_unsigned_parts(x)
    finite = wrap_int32(hi.bitwiseXOR(lo))
    return (F.when(x.isNull(), F.lit(None).cast("int"))
            .when(F.isnan(x), F.lit(0x7FF80000))
            .when(x == float("inf"), F.lit(0x7FF00000))
            .when(x == float("-inf"), F.lit(-1048576))
            .when((x == 0) & (x.cast("string") == "-0.0"), F.lit(-_2_31))
            .when(x == 0, F.lit(0))
            .otherwise(finite).cast("int"))


def java_hash_pair(s: Column | str, x: Column | str) -> Column:
    """The (string, double) overload: sum of the two hashes, INT wrap."""
    return wrap_int32(java_string_hash(s).cast("bigint") + java_double_hash(x).cast("bigint"))


def format_number(c: Column | str, pattern: str = "%06.3f") -> Column:
    """printf-style formatting of a number (``%06.3f``, ``%.2f``)."""
    return F.format_string(pattern, _c(c))


def to_csv_value(*cols: Column | str, sep: str = ",") -> Column:
    """A record as one delimited text value (the record's text form and the
    Kafka/CSV value).  NULL fields become empty fields, positions kept."""
    parts = [F.coalesce(_c(c).cast("string"), F.lit("")) for c in cols]
    return F.concat_ws(sep, *parts)


def java_hash(df, *cols: str) -> Column:
    """The overloaded hash function, dispatched on the argument types of
    ``df``: one string → string hash, one double → double hash, (string,
    double) → their wrapped sum."""
    types = [dict(df.dtypes)[c] for c in cols]
    if types == ["string"]:
        return java_string_hash(cols[0])
    if types == ["double"]:
        return java_double_hash(cols[0])
    if types == ["string", "double"]:
        return java_hash_pair(cols[0], cols[1])
    raise TypeError(f"no hash overload for {types}")
