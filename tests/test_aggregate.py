import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tablewright.functions.aggregates import NAMES
from tablewright.operators import joins, windows
from tablewright.operators.aggregate import aggregate, distinct_values, summarize
from tablewright.operators.joins import spread_join
from tablewright.operators.windows import average_rank, cumulative_sum, group_head, row_index, shift


def rows(df):
    return [tuple(r) for r in df.collect()]


@pytest.fixture(scope="module")
def pairs(spark):
    return spark.createDataFrame([("wood", 3, 2), ("iron", 25, 1), ("wood", 8, 4), ("iron", 14, 1), ("wood", 1, 1)], "category string, value long, count long")


def test_basic(pairs):
    got = aggregate(pairs, "category", {"value": ["sum", "mean"], "count": "sum"})
    assert got.columns == ["category", "value_sum", "value_mean", "count_sum"]
    assert sorted(rows(got)) == [("iron", 39, 19.5, 2), ("wood", 12, 4.0, 7)]


def test_sort(pairs):
    got = rows(aggregate(pairs, ["category"], {"value": "sum"}, sort_by=["value_sum"], sort_ascending=False))
    assert [r[0] for r in got] == ["iron", "wood"]


def test_naming(pairs):
    assert aggregate(pairs, "category", {"value": "sum"}, naming="legacy").columns == ["category", "value"]
    got = aggregate(pairs, "category", {"value": ["sum"], "count": "max"}, naming="legacy")
    assert got.columns == ["category", "value_sum", "count_max"]


def test_validation(pairs):
    with pytest.raises(ValueError, match="'group_by'"):
        aggregate(pairs, [], {"value": "sum"})
    with pytest.raises(ValueError, match="'aggregations'"):
        aggregate(pairs, "category", {})
    with pytest.raises(ValueError, match="not found"):
        aggregate(pairs, "nothing", {"value": "sum"})
    with pytest.raises(ValueError, match="Available"):
        aggregate(pairs, "category", {"value": "kurt"})
    with pytest.raises(ValueError, match="order_by"):
        aggregate(pairs, "category", {"value": "first"})
    with pytest.raises(ValueError, match="requires a Spark DataFrame"):
        aggregate([1, 2], "category", {"value": "sum"})


def test_null_rules(spark):
    df = spark.createDataFrame([("a", 1.0), (None, 2.0), ("a", None), ("b", None)], "k string, v double")
    got = rows(aggregate(df, "k", {"v": ["sum", "prod", "std", "count", "size", "any", "all", "median"]}, sorted_groups=True))
    assert got == [("a", 1.0, 1.0, None, 1, 2, True, True, 1.0), ("b", 0.0, 1.0, None, 0, 1, False, True, None)]
    kept = rows(aggregate(df, "k", {"v": ["sum", "median"]}, dropna=False, sorted_groups=True))
    assert kept[-1] == (None, 2.0, 2.0)


def test_nulls_sort_last(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", None), ("c", 3.0)], "k string, v double")
    for up, order in ((True, "acb"), (False, "cab")):
        got = rows(aggregate(df, "k", {"v": "max"}, sort_by="v_max", sort_ascending=up))
        assert "".join(r[0] for r in got) == order


def test_post_filter_and_limit(pairs):
    got = rows(aggregate(pairs, "category", {"value": "sum"}, post_filter="value_sum > 12", limit=1))
    assert got == [("iron", 39)]
    assert len(rows(aggregate(pairs, "category", {"value": "sum"}, limit=0))) == 2


def test_numeric_functions_match_pandas(spark):
    rng = random.Random(3)
    data = [(rng.choice("abc"), rng.choice([None, rng.gauss(5, 2)]), i) for i in range(200)]
    data += [("two", 1.0, 900), ("two", 2.0, 901), ("flat", 3.0, 902), ("flat", 3.0, 903), ("flat", 3.0, 904)]
    frame = pd.DataFrame(data, columns=["k", "v", "i"])
    df = spark.createDataFrame(data, "k string, v double, i long").repartition(5)
    names = ["sum", "mean", "count", "nunique", "min", "max", "std", "var", "sem", "median", "quantile", "prod", "size", "skew", "first", "last"]
    got = aggregate(df, "k", {"v": names}, order_by="i").toPandas().set_index("k").sort_index()
    want = frame.groupby("k")["v"].agg(names)
    for name in names:
        np.testing.assert_allclose(
            got[f"v_{name}"].astype(float), want[name].astype(float), rtol=1e-9, atol=1e-12, err_msg=name
        )


def test_labels_and_ohlc(spark):
    df = spark.createDataFrame([("a", 2.0, 1), ("a", 5.0, 2), ("a", 5.0, 3), ("a", 1.0, 4), ("b", None, 5)], "k string, v double, i long")
    got = rows(aggregate(df, "k", {"v": ["idxmin", "idxmax", "ohlc"]}, label="i", order_by="i", sorted_groups=True))
    assert got == [("a", 4, 2, 2.0, 5.0, 1.0, 1.0), ("b", None, None, None, None, None, None)]


def test_extreme_integers(spark):
    df = spark.createDataFrame([("a", -(2**63), 1), ("a", 2**63 - 1, 2), ("a", 0, 3)], "k string, v long, i long")
    assert rows(aggregate(df, "k", {"v": ["idxmin", "idxmax"]}, label="i")) == [("a", 1, 2)]


def test_unique_is_guarded(spark):
    df = spark.createDataFrame([("a", i) for i in range(10)], "k string, v long")
    assert rows(aggregate(df, "k", {"v": "unique"})) == [("a", list(range(10)))]
    with pytest.raises(ValueError, match="distinct_values"):
        aggregate(df, "k", {"v": "unique"}, array_limit=5)
    assert distinct_values(df, "k", "v").count() == 10


def test_every_name_runs(pairs):
    got = aggregate(pairs, "category", {"value": NAMES}, order_by="value", label="count")
    assert got.count() == 2


def test_approximate_median(pairs):
    got = rows(aggregate(pairs, "category", {"value": ["median", "describe"]}, method="approx", sorted_groups=True))
    assert got[0][:2] == ("iron", 14.0)


def test_summary_matches_pandas(spark):
    frame = pd.DataFrame({"k": list("aabbb"), "x": [1.0, 2.0, 3.0, None, 7.0], "y": [5, 4, 3, 2, 1]})
    df = spark.createDataFrame([("a", 1.0, 5), ("a", 2.0, 4), ("b", 3.0, 3), ("b", None, 2), ("b", 7.0, 1)], "k string, x double, y long")
    got = {r[0]: r[1:] for r in rows(summarize(df))}
    for c in ("x", "y"):
        np.testing.assert_allclose(np.array(got[c], float), frame[c].describe().to_numpy(), rtol=1e-12)
    grouped = {(r[0], r[1]): r[2:] for r in rows(summarize(df, ["x"], "k"))}
    np.testing.assert_allclose(np.array(grouped["b", "x"], float), frame[frame.k == "b"].x.describe().to_numpy())


def _random(spark, n=600, seed=4):
    rng = random.Random(seed)
    data = [
        (rng.choice(["hot", "hot", "hot", "cold", None]), rng.randint(0, 40), rng.choice([None, rng.randint(0, 9)]), i)
        for i in range(n)
    ]
    frame = pd.DataFrame(data, columns=["k", "o", "v", "i"]).sort_values(["o", "i"])
    return frame, spark.createDataFrame(data, "k string, o long, v long, i long").repartition(6)


@pytest.mark.parametrize("limit", [10_000, 50])
def test_windows_match_pandas(spark, limit):
    frame, df = _random(spark)
    groups = frame.groupby("k", dropna=False)

    def by_row(result, out):
        return {r["i"]: r[out] for r in result.collect()}

    def check(got, want):
        want = dict(zip(frame.i, want))
        assert len(got) == len(frame)
        for i, value in got.items():
            assert (value is None and pd.isna(want[i])) or value == want[i], (i, value, want[i])

    check(by_row(cumulative_sum(df, "k", ["o", "i"], "v", row_limit=limit), "v_cumsum"), groups.v.cumsum())
    check(by_row(row_index(df, "k", ["o", "i"], row_limit=limit), "row_index"), groups.cumcount() + 1)
    check(by_row(shift(df, "k", ["o", "i"], "v", 2, row_limit=limit), "v_shift"), groups.v.shift(2))
    check(by_row(shift(df, "k", ["o", "i"], "v", -1, row_limit=limit), "v_shift"), groups.v.shift(-1))
    check(by_row(average_rank(df, "k", "v", row_limit=limit), "v_rank"), groups.v.rank())


def test_windows_of_a_task_are_bounded(spark):
    """A group of three million rows is cut into slices unless a limit is given."""
    df = spark.range(3_000_000).withColumn("k", F.lit(1))
    assert not windows._fits(df, ["k"], windows.ROW_LIMIT) and windows._fits(df, ["k"], 10_000_000)


def test_copies_of_one_row_are_all_counted(spark):
    df = spark.createDataFrame([("a", 1)] * 300, "k string, v long").repartition(7)
    got = sorted(r[0] for r in cumulative_sum(df, "k", "v", "v", row_limit=40).select("v_cumsum").collect())
    assert got == list(range(1, 301))
    assert sorted(r[0] for r in row_index(df, "k", "v", row_limit=40).select("row_index").collect()) == list(range(1, 301))


def test_group_head(spark):
    frame, df = _random(spark)
    want = frame.groupby("k", dropna=False).head(3).i
    assert sorted(r["i"] for r in group_head(df, "k", ["o", "i"], 3).collect()) == sorted(want)
    many = spark.range(0, 3000, numPartitions=4).selectExpr("id % 2 AS k", "id AS v")
    assert group_head(many, "k", "v", 1200, row_limit=100).count() == 2400


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_spread_join_equals_join(spark, how):
    data = [(1, i) for i in range(200)] + [(2, i) for i in range(5)] + [(None, i) for i in range(90)] + [(9, 0)] * 60
    left = spark.createDataFrame(data, "k long, v long").repartition(5)
    right = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "k long, name string")
    want = sorted(rows(left.join(right, "k", how)), key=str)
    assert sorted(rows(spread_join(left, right, "k", how, hot_rows=30)), key=str) == want


def test_large_keys_show_in_the_sample(spark, monkeypatch):
    from tablewright.operators import joins

    monkeypatch.setattr(joins, "SAMPLED_ROWS", 100)
    df = spark.range(0, 40_000, numPartitions=4).select(F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id")).alias("k"))
    counts, n = joins.key_counts(df, ["k"], 5000)
    hot = counts.filter(F.col(n) > 5000).collect()
    assert [r["k"] for r in hot] == [1] and 15_000 < hot[0][n] < 25_000
    assert joins.key_counts(df.withColumnRenamed("k", "_rows"), ["_rows"], 5000)[1] != "_rows"
    right = spark.range(50).select(F.col("id").alias("k"), F.lit("x").alias("x"))
    want = df.join(right, "k").count()
    assert spread_join(df, right, "k", hot_rows=5000).count() == want


def test_spread_join_bounds_the_bytes_of_hot_keys(spark, monkeypatch):
    """Hot keys beyond the bytes join as usual, with the same result."""
    left = spark.range(300).select(F.concat(F.repeat(F.lit("long key "), 20), (F.col("id") % 3).cast("string")).alias("_slot"), F.col("id").alias("_seed"))
    right = left.select("_slot").distinct().withColumn("_slices", F.lit("x"))
    want = sorted(rows(left.join(right, "_slot")), key=str)
    for most in (0, 250, 10_000):
        monkeypatch.setattr(joins, "BROADCAST_BYTES", most)
        assert sorted(rows(spread_join(left, right, "_slot", hot_rows=20)), key=str) == want


@pytest.mark.parametrize("how", ["inner", "left"])
def test_spread_join_sends_the_largest_keys_only(spark, how, monkeypatch):
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 1)
    left = spark.range(400).select(F.when(F.col("id") < 250, 1).when(F.col("id") < 350, 2).otherwise(F.col("id")).alias("k"), "id")
    right = spark.createDataFrame([(1, "a"), (2, "b"), (360, "c")], "k long, v string")
    want = sorted(rows(left.join(right, "k", how)), key=str)
    assert sorted(rows(spread_join(left, right, "k", how, hot_rows=30)), key=str) == want
