"""Exact top-k against brute force."""

import math
import random

import pytest

from thermocline.llm import topk


def brute(rows, k):
    ok = []
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        ok.append((i, [math.floor(64 * x) for x in v]))
    out = []
    for n, (q, a) in enumerate(ok):
        if q % 20:
            continue
        best = sorted((-sum(x * y for x, y in zip(a, b)), i)
                       for m, (i, b) in enumerate(ok) if m != n)[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return sorted(out)


def run(spark, rows, k, **blocks):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows],
                               "vec_id long, embedding array<float>, score int, rank string")
    v = topk.integer_vectors(df)
    got = topk.top_k(v, v.filter("vec_id % 20 = 0"), k, **blocks)
    assert got.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "bigint")]
    return sorted(map(tuple, got.collect()))


def test_against_brute_force(spark):
    r = random.Random(3)
    rows = [(i, [r.gauss(0, .3) for _ in range(8)]) for i in range(130)]
    rows += [(i, rows[40][1]) for i in range(130, 190)]  # a third of the rows tie
    rows += [(200, None), (None, rows[0][1]), (220, [1.0, None]), (240, [float("nan")] * 8), (260, [float("inf")] * 8),
             (280, []), (20, rows[20][1]), (20, [2.0] * 8), (41, rows[41][1]), (300, [9000.0] * 8), (301, [-9000.0, 3.0])]
    rows = [(i, None if v is None else [x if x is None else float(__import__("numpy").float32(x)) for x in v])
            for i, v in rows]
    assert run(spark, rows, 20, query_block=4, row_block=50) == brute(rows, 20)


@pytest.mark.parametrize("rows", [[], [(0, [1.0])], [(0, [1.0, 2.0]), (1, [0.0, 0.0]), (20, [-1.0, .5])]])
def test_fewer_rows_than_k(spark, rows):
    assert run(spark, rows, 20) == brute(rows, 20)


def test_kth_score_in_the_short_last_part_of_a_range(spark):
    # bound 409602: parts of 3201 and then 13 values, of which the last holds 3
    rows = [(0, [1 / 64]), (1, [233802 / 64]), (2, [233798 / 64]), (3, [230603 / 64]), (4, [-6400.0])]
    assert [r[2:] for r in run(spark, rows, 2)] == [(1, 233802), (2, 233798)]


def test_wide_ranges_against_brute_force(spark):
    r = random.Random(9)
    scores = {x * 3201 + d - 409602 for x in range(256) for d in r.sample([0, 1, 3, 3186, 3187, 3198, 3199, 3200], 4)}
    rows = [(i, [x / 64]) for i, x in enumerate(sorted(scores), 1) if i % 20 and abs(x) < 409600]
    rows += [(0, [1 / 64]), (20, [-1 / 64]), (2001, [-6400.0])]
    for k in (1, 2, 7, 50):
        assert run(spark, rows, k) == brute(rows, k)
