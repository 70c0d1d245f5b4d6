"""User-defined aggregate and table-aggregate functions.

A :class:`UserAggregate` has four steps: ``create`` an accumulator,
``accumulate`` values into one, ``merge`` two, and give the ``value`` (or, for
a table aggregate, ``emit`` rows).  Accumulators are opaque Python objects.

They are filled where the rows are: each map task keeps one accumulator a key
and sends those, never rows, so a hot key leaves a task as one small row.
What the tasks send is merged in a tree, ``FAN`` tasks at a time, along
sorted partitions: no group is ever gathered, whatever its size.

:func:`register_aggregate` makes an aggregate callable by name in SQL::

    register_aggregate(spark, AvgTemp())
    spark.sql("SELECT id, AvgTemp(temperature) FROM {t} GROUP BY id",
              t=accumulated(readings, ["id"], AvgTemp(), "temperature"))

:func:`accumulated` keeps the column's name, so the statement is the one that
would be written over the readings themselves, which works too (there Spark
gathers each group, so keep that for groups known to be small).

NULL values are not accumulated; a NULL key is a key; a key whose values are
all NULL keeps the created accumulator."""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Partial accumulators of one key that meet in one step of the tree.
FAN = 64
#: Keys a map task holds before it sends what it has.
HELD_KEYS = 100_000


class UserAggregate:
    """Subclass and give the steps; ``name`` is that in SQL, ``returns`` the
    DDL type of ``value``, ``emits`` the DDL columns of ``emit``."""

    name = "user_aggregate"
    returns = "double"
    emits = "value double"

    def create(self):
        raise NotImplementedError

    def accumulate(self, acc, values: np.ndarray):
        """The accumulator after ``values`` (none NULL, at least one)."""
        raise NotImplementedError

    def merge(self, a, b):
        raise NotImplementedError

    def value(self, acc):
        raise NotImplementedError

    def emit(self, acc) -> Iterable[tuple]:
        """The rows of a table aggregate."""
        return [(self.value(acc),)]


class AvgTemp(UserAggregate):
    """Sum over count; NULL without a value.  The sum is kept as two doubles,
    so the order in which accumulators meet does not show."""

    name = "AvgTemp"

    def create(self):
        return 0.0, 0.0, 0

    def accumulate(self, acc, values):
        return self._sum([*acc[:2], *values.tolist()], acc[2] + len(values))

    def merge(self, a, b):
        return self._sum([*a[:2], *b[:2]], a[2] + b[2])

    def _sum(self, parts, n):
        if not all(map(math.isfinite, parts)):
            return sum(parts), 0.0, n
        total = math.fsum(parts)
        return total, math.fsum([*parts, -total]), n

    def value(self, acc):
        return (acc[0] + acc[1]) / acc[2] if acc[2] else None


class MaxTemp(UserAggregate):
    """The largest value, at least the one it starts from."""

    name = "MaxTemp"

    def __init__(self, floor: float = 0.0) -> None:
        self.floor = floor

    def create(self):
        return self.floor

    def accumulate(self, acc, values):
        return max(acc, float(values.max()))

    def merge(self, a, b):
        return max(a, b)

    def value(self, acc):
        return acc


class TopN(UserAggregate):
    """Table aggregate: the ``n`` largest values with their ranks, ``pad`` in
    ranks that no value fills.  Only values above the pad enter."""

    name = "TopN"
    emits = "temp double, rank int"

    def __init__(self, n: int = 2, pad: float = -2147483648.0) -> None:
        self.n, self.pad = n, pad

    def create(self):
        return ()

    def accumulate(self, acc, values):
        return self._top(np.r_[np.array(acc, np.float64), values])

    def merge(self, a, b):
        return self._top(np.array([*a, *b], np.float64))

    def _top(self, values: np.ndarray) -> tuple[float, ...]:
        return tuple(np.sort(values[values > self.pad])[::-1][:self.n].tolist())

    def emit(self, acc):
        return [(x, i + 1) for i, x in enumerate([*acc, *[self.pad] * (self.n - len(acc))])]


class Extremes(UserAggregate):
    """Table aggregate: one row for the lowest and one for the highest value,
    each with how often it occurs; none without a value."""

    name = "Extremes"
    emits = "side string, value double, times long"

    def create(self):
        return None

    def accumulate(self, acc, values):
        lo, hi = float(values.min()), float(values.max())
        found = lo, int((values == lo).sum()), hi, int((values == hi).sum())
        return found if acc is None else self.merge(acc, found)

    def merge(self, a, b):
        if a is None or b is None:
            return a or b
        lo, hi = min(a[0], b[0]), max(a[2], b[2])
        return (lo, sum(x[1] for x in (a, b) if x[0] == lo), hi, sum(x[3] for x in (a, b) if x[2] == hi))

    def emit(self, acc):
        return [] if acc is None else [("lowest", acc[0], acc[1]), ("highest", acc[2], acc[3])]


def _ddl(df: DataFrame, cols: list[str]) -> str:
    return ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in cols)


def _partial(df: DataFrame, keys: list[str], agg: UserAggregate, column: str, fan: int) -> DataFrame:
    """(keys, _task, acc): at most ``fan`` accumulators for each key (times
    those of a task that holds too many keys)."""
    rows = df.select(*keys, F.col(column).alias("_value"))
    sent = rows.mapInArrow(_partials(keys, agg), f"{_ddl(df, keys)}, _task long, acc binary")
    tasks = df.rdd.getNumPartitions()
    while tasks > fan:
        tasks = -(-tasks // fan)
        # what is merged goes on under the number of its group of tasks
        sent = _step(sent.withColumn("_task", F.expr(f"_task div {fan}L")), keys, [*keys, "_task"], agg)
    return sent


def _step(sent: DataFrame, keys: list[str], by: list[str], agg: UserAggregate) -> DataFrame:
    return sent.repartition(*by).sortWithinPartitions(*by).mapInArrow(
        _merge_sorted(keys, agg), f"{_ddl(sent, keys)}, _task long, acc binary")


def merged(df: DataFrame, keys: list[str], agg: UserAggregate, column: str, fan: int = FAN) -> DataFrame:
    """(keys, acc): one pickled accumulator for each key."""
    sent = _partial(df, keys, agg, column, fan).withColumn("_task", F.lit(0).cast("long"))
    return _step(sent, keys, keys, agg).drop("_task")


def accumulated(df: DataFrame, keys: list[str], agg: UserAggregate, column: str, fan: int = FAN) -> DataFrame:
    """``df`` reduced to the keys and ``column``, which holds accumulators: a
    few rows a key, whatever it held."""
    return _partial(df, keys, agg, column, fan).select(*keys, F.col("acc").alias(column))


def aggregate(df: DataFrame, keys: list[str], agg: UserAggregate, column: str, out: str, fan: int = FAN) -> DataFrame:
    """One row a key with the aggregate's value in ``out``."""
    kind = T._parse_datatype_string(agg.returns) if isinstance(agg.returns, str) else agg.returns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type
        for b in batches:
            got = pa.array([agg.value(pickle.loads(x)) for x in b.column("acc").to_pylist()], to_arrow_type(kind))
            yield pa.RecordBatch.from_arrays([*[b.column(k) for k in keys], got], names=[*keys, out])

    return merged(df, keys, agg, column, fan).mapInArrow(run, f"{_ddl(df, keys)}, `{out}` {kind.simpleString()}")


def table_aggregate(df: DataFrame, keys: list[str], agg: UserAggregate, column: str, fan: int = FAN) -> DataFrame:
    """``flatAggregate``: the rows that ``emit`` gives for each key."""
    emits = T.StructType.fromDDL(agg.emits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type
        for b in batches:
            rows = [list(agg.emit(pickle.loads(x))) for x in b.column("acc").to_pylist()]
            at = pa.array(np.repeat(np.arange(len(rows)), [len(r) for r in rows]))
            flat = [r for many in rows for r in many]
            cols = [pa.array([r[i] for r in flat], to_arrow_type(f.dataType)) for i, f in enumerate(emits)]
            yield pa.RecordBatch.from_arrays([*[b.column(k).take(at) for k in keys], *cols],
                                             names=[*keys, *emits.fieldNames()])

    return merged(df, keys, agg, column, fan).mapInArrow(run, f"{_ddl(df, keys)}, {agg.emits}")


def register_aggregate(spark: SparkSession, agg: UserAggregate) -> None:
    """``agg.name(column)`` in SQL, over accumulators (:func:`accumulated`) or
    over plain values."""
    @F.pandas_udf(agg.returns)
    def call(x: pd.Series) -> float:
        known = x.dropna()
        if len(known) and isinstance(known.iloc[0], (bytes, bytearray)):
            acc = None
            for one in map(pickle.loads, known):
                acc = one if acc is None else agg.merge(acc, one)
            return agg.value(agg.create() if acc is None else acc)
        acc = agg.create()
        return agg.value(agg.accumulate(acc, known.to_numpy()) if len(known) else acc)

    spark.udf.register(agg.name, call)


def _batch_of(keys: list[str], types: list[pa.DataType], rows: list[tuple], task: int) -> pa.RecordBatch:
    cols = [pa.array([r[0][i] for r in rows], t) for i, t in enumerate(types)]
    return pa.RecordBatch.from_arrays(
        [*cols, pa.array([task] * len(rows) if isinstance(task, int) else task, pa.int64()),
         pa.array([pickle.dumps(r[1]) for r in rows], pa.binary())], names=[*keys, "_task", "acc"])


def _partials(keys: list[str], agg: UserAggregate):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        task, held, types = TaskContext.get().partitionId(), {}, []
        for batch in batches:
            types = [batch.schema.field(k).type for k in keys]
            table = pa.table(batch).group_by(keys).aggregate([("_value", "list")]).combine_chunks()
            lists = table["_value_list"].chunk(0) if table["_value_list"].num_chunks else pa.array([], pa.list_(pa.null()))
            for key, values in zip(zip(*[table[k].to_pylist() for k in keys]), lists):
                known = values.values.drop_null()
                acc = held[key] if key in held else agg.create()
                held[key] = agg.accumulate(acc, known.to_numpy(zero_copy_only=False)) if len(known) else acc
            if len(held) > HELD_KEYS:
                yield _batch_of(keys, types, list(held.items()), task)
                held = {}
        if held:
            yield _batch_of(keys, types, list(held.items()), task)
    return run


def _merge_sorted(keys: list[str], agg: UserAggregate):
    """Rows of one key and task number follow each other."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, acc, done, types = None, None, [], []
        for batch in batches:
            types = [batch.schema.field(k).type for k in keys]
            cols = [batch.column(i).to_pylist() for i in range(len(keys) + 2)]
            for *key, task, raw in zip(*cols):
                one, at = pickle.loads(raw), (tuple(key), task)
                if current is not None and repr(at[0]) == repr(current[0]) and task == current[1]:
                    acc = agg.merge(acc, one)
                    continue
                if current is not None:
                    done.append((current, acc))
                current, acc = at, one
            if len(done) > 10_000:
                yield _batch_of(keys, types, [(k, a) for (k, _), a in done], [t for (_, t), _ in done])
                done = []
        if current is not None:
            done.append((current, acc))
            yield _batch_of(keys, types, [(k, a) for (k, _), a in done], [t for (_, t), _ in done])
    return run
