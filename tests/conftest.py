import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from thermocline.session import build_session  # noqa: E402

# The seven sensor readings of the reference's demo input (FIXTURES.md §2).
READINGS = [
    ("sensor_1", 1547718199, 35.8),
    ("sensor_6", 1547718201, 15.4),
    ("sensor_7", 1547718202, 6.7),
    ("sensor_10", 1547718205, 38.1),
    ("sensor_1", 1547718207, 37.2),
    ("sensor_1", 1547718212, 33.5),
    ("sensor_1", 1547718215, 38.1),
]
BASE = 1547718000


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", shuffle_partitions=4)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def readings(spark):
    """Readings with an arrival id, a naive event time and epoch micros."""
    from thermocline.functions.time import epoch_micros, naive_from_seconds
    rows = [(i, *r) for i, r in enumerate(READINGS)]
    df = spark.createDataFrame(rows, "rid long, id string, timestamp long, temperature double")
    return (df.withColumn("ts", naive_from_seconds("timestamp"))
            .withColumn("_t", epoch_micros("ts")))
