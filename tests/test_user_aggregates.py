"""The contract of user-defined aggregates and table aggregates."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from thermocline.functions.aggregate import (AvgTemp, Extremes, MaxTemp, TopN, UserAggregate, accumulated, aggregate, merged,
                                             register_aggregate, table_aggregate)
from thermocline.operators.aggregates import top2_padded


def median():
    """Made here, so it travels to the workers by value."""
    class Median(UserAggregate):
        """An accumulator no built-in has: a sorted list."""

        name, returns = "Median", "double"

        def create(self):
            return []

        def accumulate(self, acc, values):
            return sorted([*acc, *values.tolist()])

        def merge(self, a, b):
            return sorted([*a, *b])

        def value(self, acc):
            return acc[len(acc) // 2] if acc else None
    return Median()


@pytest.fixture(scope="module")
def hot(spark):
    """A third of the events on one key, NULL keys and NULL values, in more
    tasks than meet in one step of the tree."""
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    key = F.when(F.col("event_id") % 3 == 0, F.lit(0).cast("long")).when(F.col("event_id") % 10 != 1, F.col("user_id"))
    return ev.select("event_id", key.alias("user_id"), F.when(F.col("event_id") % 13 != 0, F.col("value")).alias("value")).repartition(9)


def test_average_by_name_on_a_column(spark, readings, hot):
    register_aggregate(spark, AvgTemp())
    sql = "SELECT id, AvgTemp(temperature) AS a FROM {t} GROUP BY id"
    want = {"sensor_1": 36.15, "sensor_6": 15.4, "sensor_7": 6.7, "sensor_10": 38.1}
    # over accumulators, and the same statement over the readings
    for t in (accumulated(readings, ["id"], AvgTemp(), "temperature"), readings.select("id", "temperature")):
        assert {r.id: round(r.a, 6) for r in spark.sql(sql, t=t).collect()} == want
    got = spark.sql("SELECT user_id, AvgTemp(value) AS a FROM {t} GROUP BY user_id", t=accumulated(hot, ["user_id"], AvgTemp(), "value", fan=2))
    want = {r.user_id: r.a for r in hot.groupBy("user_id").agg(F.avg("value").alias("a")).collect()}
    assert {r.user_id: None if r.a is None else round(r.a, 9) for r in got.collect()} == {
        k: None if v is None else round(v, 9) for k, v in want.items()}


@pytest.mark.parametrize("fan", [2, 3, 64])
def test_hot_key_through_the_tree(spark, hot, fan):
    want = {r.user_id: r.m for r in hot.groupBy("user_id").agg(F.greatest(F.lit(0.0), F.max("value")).alias("m")).collect()}
    got = aggregate(hot, ["user_id"], MaxTemp(), "value", "m", fan)
    assert {r.user_id: r.m for r in got.collect()} == want
    assert merged(hot, ["user_id"], MaxTemp(), "value", fan).count() == len(want)
    values: dict = {}
    for r in hot.collect():
        values.setdefault(r.user_id, []).extend([] if r.value is None else [r.value])
    got = aggregate(hot, ["user_id"], median(), "value", "m", fan)
    assert {r.user_id: r.m for r in got.collect()} == {k: sorted(v)[len(v) // 2] if v else None for k, v in values.items()}


def test_no_task_gets_the_rows_of_a_hot_key(spark, hot):
    one = hot.withColumn("user_id", F.lit(1))
    sent = accumulated(one, ["user_id"], AvgTemp(), "value", fan=4)
    assert sent.count() <= 4 and one.count() > 300


def test_table_aggregates(spark, hot):
    flat = lambda df: sorted(map(tuple, df.collect()), key=str)
    assert flat(table_aggregate(hot, ["user_id"], TopN(2), "value", fan=2)) == flat(top2_padded(hot, "user_id", "value"))
    ties = spark.createDataFrame([("a", x) for x in (5.0, 5.0, 1.0)] + [("b", -5.0), ("c", None), (None, 2.0)], "id string, v double")
    assert flat(table_aggregate(ties, ["id"], TopN(2), "v")) == flat(top2_padded(ties, "id", "v"))
    assert flat(table_aggregate(ties.repartition(5), ["id"], Extremes(), "v", fan=2)) == sorted([
        ("a", "lowest", 1.0, 1), ("a", "highest", 5.0, 2), ("b", "lowest", -5.0, 1), ("b", "highest", -5.0, 1),
        (None, "lowest", 2.0, 1), (None, "highest", 2.0, 1)], key=str)
    assert table_aggregate(ties.limit(0), ["id"], TopN(2), "v").collect() == []


def test_two_key_columns_and_an_expression_of_types(spark):
    rows = [(i % 3, str(i % 2), float(i)) for i in range(60)]
    df = spark.createDataFrame(rows, "a int, b string, v double").repartition(4)
    got = {(r.a, r.b): r.m for r in aggregate(df, ["a", "b"], AvgTemp(), "v", "m", 2).collect()}
    assert got == {(a, b): np.mean([v for x, y, v in rows if (x, y) == (a, b)]) for a in range(3) for b in "01"}
