"""Order statistics and quantiles on columns with hot values, with bounds small enough for the bracketed path."""

import random

import numpy as np
import pytest

from tabmine.functions import quantiles as Q


def columns():
    rng = random.Random(2)
    return {
        "hot_zero": [0.0] * 3000 + [rng.uniform(1, 5000) for _ in range(2000)],
        "two_values": [1.0] * 2500 + [2.0] * 2500,
        "one_value": [7.0] * 5000,
        "hot_middle": [rng.gauss(0, 1) for _ in range(2500)] + [0.25] * 2500,
        "spread": [rng.uniform(0, 1) for _ in range(5000)],
        "nulls": [None] * 2000 + [float(rng.randint(0, 3)) for _ in range(3000)],
    }


@pytest.mark.parametrize("name", sorted(columns()))
def test_quantiles_with_hot_values(spark, name):
    values = columns()[name]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    known = np.sort([v for v in values if v is not None])
    probs = [0.0, 0.25, 0.4999, 0.5, 0.6, 0.75, 1.0]
    got = Q.column_quantiles(df, ["x"], probs, distinct_bound=0, bracket_bound=50)["x"]
    assert np.allclose(got, np.quantile(known, probs))
    ranks = [0, 100, len(known) // 2, len(known) - 1, len(known)]
    assert Q.order_statistics(df, "x", ranks, bracket_bound=50) == [*known[ranks[:-1]].tolist(), None]
