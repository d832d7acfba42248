import random

import numpy as np
import pytest

from tablewright.functions.quantiles import quantile_frame, quantile_values

PROBS = [0.0, 0.25, 0.5, 0.75, 1.0]


def _close(got, want):
    assert got == pytest.approx(want, rel=1e-12, abs=1e-12)


def test_small_group_matches_numpy(spark):
    values = [3.0, 1.0, None, 4.0, 1.5, float("nan")]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    _close(quantile_values(df, ["x"], PROBS)["x"], np.quantile([3.0, 1.0, 4.0, 1.5], PROBS))


@pytest.mark.parametrize("shape", ["distinct", "hot", "heavy_tail"])
def test_narrowing_is_exact(spark, shape):
    rng = random.Random(5)
    make = {
        "distinct": lambda: rng.gauss(0, 1),
        "hot": lambda: 7.0 if rng.random() < 0.4 else float(rng.randint(1, 12)),
        "heavy_tail": lambda: 10 ** rng.uniform(-5, 9),
    }[shape]
    values = [make() for _ in range(5000)]
    df = spark.createDataFrame([(v, -v) for v in values], "x double, y double").repartition(5)
    got = quantile_values(df, ["x", "y"], PROBS, row_limit=100, list_limit=20)
    _close(got["x"], np.quantile(values, PROBS))
    _close(got["y"], np.quantile([-v for v in values], PROBS))


def test_hot_and_cold_groups(spark):
    rng = random.Random(9)
    rows = [(rng.choice(["hot", "hot", "hot", "a", None]), rng.random() if rng.random() > 0.05 else None) for _ in range(3000)]
    rows += [("single", 2.5), ("empty", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r["k"]: r["_q0"] for r in quantile_frame(df, ["v"], [0.25, 0.5], "k", row_limit=700, list_limit=15).collect()}
    for key in {k for k, _ in rows}:
        group = [v for k, v in rows if k == key and v is not None]
        if group:
            _close(got[key], np.quantile(group, [0.25, 0.5]))
        else:
            assert got[key] is None
    assert len(got) == 5


def test_empty_table(spark):
    df = spark.createDataFrame([], "x double")
    assert quantile_values(df, ["x"], [0.5]) == {"x": [None]}
