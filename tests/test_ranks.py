import math
import random

import pytest

from tabloom.operators import ranks, stats


def expected(values):
    seen = sorted(v for v in values if v is not None)
    out = []
    for share in (0.25, 0.5, 0.75):
        place = share * (len(seen) - 1)
        low, high = seen[math.floor(place)], seen[math.ceil(place)]
        out.append(low + (high - low) * (place - math.floor(place)))
    return out


def columns(n=700):
    rng = random.Random(8)
    return {
        "even": [rng.random() for _ in range(n)],
        "ties": [float(rng.choice([1, 1, 1, 1, 2, 7])) for _ in range(n)],
        "gaps": [rng.choice([None, rng.gauss(0, 1), 10 ** rng.uniform(-300, 300)]) for _ in range(n)],
        "one": [5.0] * n,
        "few": [rng.choice([None] * 400 + [1.0, 2.0]) for _ in range(n)],
        "none": [None] * n,
    }


@pytest.mark.parametrize("most,accuracy", [(1_000_000, 1000), (20, 20)])
def test_quartiles_are_exact(spark, monkeypatch, most, accuracy):
    monkeypatch.setattr(ranks, "MOST_INSIDE", most)
    monkeypatch.setattr(ranks, "ACCURACY", accuracy)
    monkeypatch.setattr(ranks, "NARROWINGS", 2)
    data = columns()
    frame = spark.createDataFrame(list(zip(*data.values())), ", ".join(f"{c} double" for c in data)).repartition(6)
    rows = {r["column"]: r for r in stats.describe(frame, list(data)).collect()}
    for name, values in data.items():
        row = rows[name]
        if name == "none":
            assert row["count"] == 0 and row["q50"] is None
        else:
            assert [row["q25"], row["q50"], row["q75"]] == expected(values)
            assert row["count"] == sum(v is not None for v in values)


def test_a_bracket_that_misses_its_rank_is_moved(spark):
    frame = spark.range(1000).selectExpr("CAST(id AS double) v")
    wrong = {(0, 10): (500.0, 510.0), (0, 900): (3.0, 4.0), (0, 505): (500.0, 510.0)}
    found = ranks.values_at(frame, ["v"], {0: [10, 505, 900]}, wrong, {0: (0.0, 999.0)})
    assert found == {(0, 10): 10.0, (0, 505): 505.0, (0, 900): 900.0}


def test_nan_is_larger_than_any_number(spark):
    frame = spark.createDataFrame([(float(i),) for i in range(5)] + [(float("nan"),)] * 4, "v double")
    row = stats.describe(frame, ["v"]).first()
    assert row["q25"] == 2.0 and row["q50"] == 4.0 and math.isnan(row["q75"])


def test_merged_brackets():
    nan = float("nan")
    assert ranks.merged([(3, 4), (1, 2), (2, 2.5)]) == [(1, 2.5), (3, 4)]
    assert ranks.merged([(1.0, 5.0), (2.0, 3.0)]) == [(1.0, 5.0)]
    (whole,) = ranks.merged([(1.0, nan), (2.0, 3.0)])
    assert whole[0] == 1.0 and math.isnan(whole[1])
