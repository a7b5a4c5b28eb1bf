import math
import random

import pytest

from tabloom.llm.kd_search import top_inner_products


def brute(rows, every, top):
    whole = [
        (i, [math.floor(256 * x) for x in v]) for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for at, (q, a) in enumerate(whole):
        if q % every == 0:
            scores = sorted(
                (-max(-(2**63 - 1), min(2**63 - 1, sum(x * y for x, y in zip(a, b)))), i)
                for other, (i, b) in enumerate(whole) if other != at and len(a) == len(b)
            )
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:top])]
    return sorted(out)


@pytest.mark.parametrize("shard_rows", [7, 40, 8192])
def test_equals_brute_force(spark, shard_rows):
    rng = random.Random(5)
    rows = [(i, [rng.gauss(0, 1) for _ in range(6)]) for i in range(150)]
    rows += [(i, [0.5] * 6) for i in range(150, 400)]  # one very common vector
    rows += [(400, None), (401, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (402, [float("nan")] * 6), (None, [1.0] * 6),
             (403, [float("inf")] * 6), (410, [1.0, 2.0]), (411, [2.0, 2.0]), (0, rows[0][1]), (10, [9.0] * 6),
             (420, []), (421, [])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(tuple(r) for r in top_inner_products(spark, frame, every=10, shard_rows=shard_rows).collect())
    assert got == brute(rows, 10, 5)


def test_rows_with_one_id_are_rows_of_their_own(spark):
    rows = [(0, [1.0]), (50, [2.0]), (50, [3.0]), (7, [2.5]), (7, [2.5])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(tuple(r) for r in top_inner_products(spark, frame).collect())
    assert got == brute(rows, 50, 5)
    assert (0, 1, 50, 196608) in got and [r for r in got if r[0] == 0][1:3] == [(0, 2, 7, 163840), (0, 3, 7, 163840)]


def test_large_components_are_exact(spark):
    rows = [(i, [float(2**20 + i), float(-(2**19) - 3 * i), 0.25]) for i in range(30)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(tuple(r) for r in top_inner_products(spark, frame, every=10).collect())
    assert got == brute(rows, 10, 5)


def test_empty_table_and_clashing_columns(spark):
    frame = spark.createDataFrame([(0, [1.0], 1, 2), (50, [2.0], 1, 2)], "vec_id long, embedding array<float>, shard int, block int")
    assert sorted(tuple(r) for r in top_inner_products(spark, frame).collect()) == [(0, 1, 50, 131072), (50, 1, 0, 131072)]
    assert top_inner_products(spark, frame.where("false")).count() == 0
