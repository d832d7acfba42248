import collections
import datetime
import decimal
import math
import random

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tablewright.operators import clean as clean_module
from tablewright.operators.clean import (
    clean,
    convert_types,
    dedup,
    dedup_and_filter,
    fill_mean,
    fill_missing,
    fill_mode,
    filter_rows,
    remove_outliers,
    standardize_columns,
)


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_dedup_then_drop_nulls(spark):
    data = [(90, "rye", 4), (91, "oat", 6), (90, "rye", 4), (92, None, 1), (90, "rye", 4)]
    df = spark.createDataFrame(data, "id long, name string, value long")
    got = rows(clean(df, {"remove_duplicates": True, "missing_strategy": "drop"}))
    assert sorted(got) == [(90, "rye", 4), (91, "oat", 6)]


def test_fill_from_map(spark):
    data = [(5, None, "wet"), (6, "peat", None), (7, None, None)]
    df = spark.createDataFrame(data, "id long, soil string, state string")
    config = {"missing_strategy": "fill", "fill_values": {"soil": "clay", "state": "dry", "none": 1}}
    assert sorted(rows(clean(df, config))) == [(5, "clay", "wet"), (6, "peat", "dry"), (7, "clay", "dry")]


def test_filter(spark):
    df = spark.range(10).select("id", (F.col("id") * F.col("id")).alias("square"))
    assert sorted(r[0] for r in rows(clean(df, {"filter_expr": "square > 36 and id <> 8"}))) == [7, 9]


def test_bad_filter_is_skipped_by_clean_and_raised_alone(spark):
    df = spark.createDataFrame([(1, 10)], "id long, value long")
    assert clean(df, {"filter_expr": "nothing > 1"}).count() == 1
    assert clean(df, {"filter_expr": "value >"}).count() == 1
    with pytest.raises(AnalysisException):
        dedup_and_filter(df, {"filter_expr": "nothing > 1"})
    with pytest.raises(AnalysisException):
        filter_rows(df, "value >")


def test_refuses_other_inputs():
    for bad in ([1, 2, 3], None, {"a": 1}):
        with pytest.raises(ValueError, match="requires a Spark DataFrame"):
            clean(bad, {})


def test_keep_first_is_deterministic_and_treats_nulls_alike(spark):
    data = [(None, 3, "c"), (None, 1, "z"), (None, 1, "a"), ("k", None, "b"), ("k", 2, "d")]
    df = spark.createDataFrame(data, "k string, o int, v string").repartition(4)
    assert sorted(rows(dedup(df, "k", "o")), key=str) == [("k", 2, "d"), (None, 1, "a")]


def test_keep_first_drops_rows_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    plan = dedup(df, "k")._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_mean_and_mode(spark):
    df = spark.createDataFrame([(1.0, "b"), (None, "a"), (3.0, None), (float("nan"), "b"), (2.0, "a")], "x double, s string")
    assert [r[0] for r in rows(fill_mean(df, ["x"]))] == [1.0, 2.0, 3.0, 2.0, 2.0]
    assert [r[1] for r in rows(fill_mode(df, ["s"]))] == ["b", "a", "a", "b", "a"]
    empty = spark.createDataFrame([(None,), (None,)], "s string")
    assert rows(fill_mode(empty)) == [("Unknown",), ("Unknown",)]


def test_auto_fill(spark):
    df = spark.createDataFrame([(1, None), (None, "a"), (3, "a")], "x long, s string")
    got = clean(df, {"remove_duplicates": False, "missing_strategy": "fill"})
    assert sorted(rows(got)) == [(1.0, "a"), (2.0, "a"), (3.0, "a")]


def test_fill_value_of_wrong_type(spark):
    df = spark.createDataFrame([(1.0,)], "x double")
    with pytest.raises(ValueError, match="does not fit"):
        fill_missing(df, {"x": "text"})


def test_names(spark):
    df = spark.createDataFrame([(1, 2)], ["Order ID", "Price ($)"])
    assert standardize_columns(df).columns == ["order_id", "price_"]
    with pytest.raises(ValueError, match="collide"):
        standardize_columns(spark.createDataFrame([(1, 2)], ["A B", "a_b"]))


def test_conversion_is_all_or_nothing(spark):
    df = spark.createDataFrame([("1", "1.5", "2020-01-02"), ("x", None, "2020-01-03")], "a string, b string, d string")
    got = convert_types(df, {"a": "int64", "b": "float64", "d": "datetime64[ns]", "none": "int64", "b2": "?"})
    assert dict(got.dtypes) == {"a": "string", "b": "double", "d": "timestamp"}
    assert dict(convert_types(df, {"a": "no_such_type"}).dtypes)["a"] == "string"


def test_outliers_in_sequence(spark):
    data = [(float(v), float(v)) for v in range(1, 20)] + [(1000.0, 5.0), (5.0, 1000.0), (None, 5.0)]
    df = spark.createDataFrame(data, "a double, b double")
    got = rows(remove_outliers(df))
    assert len(got) == 19 and max(r[0] for r in got) < 100 and max(r[1] for r in got) < 100
    assert remove_outliers(df.withColumn("c", F.lit(None).cast("double")), ["c"]).count() == 0
    with pytest.raises(ValueError, match="not numeric"):
        remove_outliers(df.withColumn("s", F.lit("x")), ["s"])


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "x double")
    assert rows(clean(df)) == [(1.0,)]


def test_order_of_steps(spark):
    """Filter uses raw names, conversions and outliers the standardised ones."""
    df = spark.createDataFrame([(1, "5"), (1, "6"), (2, "700"), (3, "7"), (4, "8"), (5, "6")], "`Order Id` long, `Amount` string")
    metrics = {}
    got = clean(
        df,
        {
            "dedup_cols": ["Order Id"],
            "filter_expr": "`Order Id` < 9",
            "dtype_conversions": {"amount": "float64"},
            "remove_outliers": True,
            "outlier_cols": ["amount"],
        },
        metrics,
    )
    assert sorted(rows(got)) == [(1, 5.0), (3, 7.0), (4, 8.0), (5, 6.0)]
    assert metrics["rows_out"].get["rows"] == 4


def test_other_strategy_keeps_nulls(spark):
    df = spark.createDataFrame([(None,), (1,)], "x int")
    assert clean(df, {"missing_strategy": "keep"}).count() == 2


def test_filter_reaches_the_scan(spark, sf):
    df = spark.read.parquet(f"{sf}/orders.parquet")
    plan = filter_rows(df, "o_totalprice > 100000").select("o_orderkey")._jdf.queryExecution().toString()
    assert "GreaterThan(o_totalprice,100000.0)" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in plan
    fenced = remove_outliers(df, ["o_totalprice"]).select("o_orderkey")._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(o_totalprice), GreaterThanOrEqual" in fenced
    assert not math.isnan(1.0)


def test_modes_of_many_columns_in_one_scan(spark, monkeypatch):
    """Five gappy columns of different types, ties included; their values are counted together."""
    rng = random.Random(6)
    day = lambda n: datetime.date(2024, 1, 1) + datetime.timedelta(days=n)
    makers = [lambda n: f"t{n}", day, lambda n: n % 2 == 0, lambda n: decimal.Decimal(n), lambda n: [n, n], lambda n: float(n)]
    data = [tuple(None if rng.random() < 0.2 else make(rng.randrange(4)) for make in makers) for _ in range(200)]
    data += [(None,) * 6]
    frame = spark.createDataFrame(data, "a string, b date, c boolean, d decimal(9,2), e array<int>, f float")
    calls = []
    real = clean_module.value_counts
    monkeypatch.setattr(clean_module, "value_counts", lambda df, cols: calls.append(cols) or real(df, cols))
    filled = fill_mode(frame)
    assert calls == [["a", "b", "c", "d", "e", "f"]]
    counts = [collections.Counter(tuple(r[i]) if isinstance(r[i], list) else r[i] for r in data if r[i] is not None) for i in range(6)]
    modes = [min(c, key=lambda v: (-c[v], v)) for c in counts]
    last = filled.collect()[-1]
    assert [tuple(v) if isinstance(v, list) else v for v in last] == modes
    wide = spark.range(3).select(*[F.when(F.col("id") > i % 2, "x").alias(f"c{i}") for i in range(70)])
    assert fill_mode(wide).filter("c0 = 'x' AND c69 = 'x'").count() == 3
    empty = frame.limit(0).unionByName(frame.limit(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in frame.schema.fields]))
    assert fill_mode(empty, ["a", "b"]).first()[:2] == ("Unknown", None)
