"""Joins by time against all pairs."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

import catalog
import catalog.sql
from tablewright.operators.timejoins import asof_join, interval_join

NOT_A_PAIRWISE_JOIN = ("BroadcastNestedLoopJoin", "CartesianProduct")


def _day(n):
    return None if n is None else datetime.datetime(2024, 1, 1) + datetime.timedelta(hours=n)


@pytest.fixture(scope="module")
def ticks():
    """A key with a third of the rows, ties, missing times and keys."""
    rng = random.Random(8)
    key = lambda: rng.choice(["hot", "hot", "a", "b", "c", None])
    left = [(i, key(), rng.choice([None, *range(60)])) for i in range(150)]
    right = [(key(), rng.choice([None, *range(60)]), rng.choice([None, *range(5)])) for _ in range(150)]
    return left, right


def _last_by_hand(left, right, exact, reach):
    out = []
    for i, k, t in left:
        best = None
        for k2, t2, v in right:
            if k is not None and k2 == k and None not in (t, t2) and (t2 < t or exact and t2 == t) and (reach is None or t - t2 <= reach):
                best = max(best or (t2, v is not None, v), (t2, v is not None, v), key=lambda x: (x[0], x[1], x[2] or 0))
        out.append((i, k, _day(t), _day(best[0]) if best else None, best[2] if best else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("exact, reach, row_limit", [(True, None, 10**6), (True, None, 9), (False, 5, 9), (False, None, 10**6)])
def test_asof(spark, ticks, exact, reach, row_limit):
    left, right = ticks
    a = spark.createDataFrame([(i, k, _day(t)) for i, k, t in left], "i int, _found string, at timestamp")
    b = spark.createDataFrame([(k, _day(t), v) for k, t, v in right], "_found string, at timestamp, v int")
    found = asof_join(a, b, "at", "_found", tolerance=None if reach is None else F.make_dt_interval(hours=F.lit(reach)), exact=exact, row_limit=row_limit)
    assert found.columns == ["i", "_found", "at", "at_right", "v"]
    assert sorted((tuple(r) for r in found.collect()), key=str) == _last_by_hand(left, right, exact, reach)


def test_asof_without_key(spark):
    a = spark.createDataFrame([(1, 5.0), (2, float("nan")), (3, 0.5)], "i int, x double")
    b = spark.createDataFrame([(1.0, "m"), (4.0, None), (5.5, "n")], "y double, v string")
    found = asof_join(a, b, "x", right_time="y", tolerance=F.lit(2.0))
    assert sorted((tuple(r) for r in found.collect()), key=str) == [(1, 5.0, 4.0, None), (2, None, None, None), (3, 0.5, None, None)]
    assert asof_join(a.limit(0), b, "x", right_time="y").count() == 0
    assert asof_join(a, b.limit(0), "x", right_time="y").filter("y IS NULL").count() == 3
    with pytest.raises(ValueError, match="same name"):
        asof_join(a.withColumn("x_right", F.lit(1)), b.withColumnRenamed("y", "x"), "x")


SPANS = {"long bigint": lambda n: n, "double": float, "date": lambda n: datetime.date(2024, 1, 1) + datetime.timedelta(days=n), "timestamp": _day, "timestamp_ntz": _day}


@pytest.mark.parametrize("kind", SPANS)
def test_intervals(spark, kind):
    rng = random.Random(kind)
    make, kind = SPANS[kind], kind.split()[-1]

    def spans(n):
        rows = []
        for i in range(n):
            start = rng.randrange(900)
            length = rng.choice([0, 0, 1, 3, 20, 250, 900, -2])
            rows.append((i, rng.choice(["x", "x", "y", None]), start if rng.random() > 0.05 else None, start + length))
        return rows

    left, right = spans(120), spans(90)
    frames = [spark.createDataFrame([(i, k, None if a is None else make(a), make(b)) for i, k, a, b in rows], f"id int, _at string, s {kind}, e {kind}") for rows in (left, right)]
    for by in (None, "_at"):
        found = interval_join(frames[0], frames[1], ("s", "e"), ("s", "e"), by)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert not any(name in plan for name in NOT_A_PAIRWISE_JOIN)
        wanted = [
            (a[0], b[0]) for a in left for b in right
            if None not in (a[2], b[2]) and a[2] <= a[3] and b[2] <= b[3] and a[2] <= b[3] and b[2] <= a[3] and (by is None or a[1] is not None and a[1] == b[1])
        ]
        assert sorted((r["id"], r["id_right"]) for r in found.collect()) == sorted(wanted)
    points = interval_join(frames[0].select("id", "e"), frames[1].select("id", "e"), "e", "e")
    assert sorted((r["id"], r["id_right"]) for r in points.collect()) == sorted((a[0], b[0]) for a in left for b in right if a[3] == b[3])


def test_intervals_of_large_numbers_and_none(spark):
    big = 2**62
    a = spark.createDataFrame([(1, big, big + 1), (2, big + 2, big + 2)], "i int, s bigint, e bigint")
    b = spark.createDataFrame([(big + 2,)], "p bigint")
    assert [r["i"] for r in interval_join(a, b, ("s", "e"), "p").collect()] == [2]
    assert interval_join(a.limit(0), b, ("s", "e"), "p").count() == 0
    with pytest.raises(ValueError, match="span needs"):
        interval_join(a.withColumn("t", F.lit("x")), b, "t", "p")


def test_shipments_join_alike_rows_once(spark, tmp_path, monkeypatch):
    """Rows alike in times and groups are joined once with their numbers; missing and infinite quantities count as before."""
    nan, inf = float("nan"), float("inf")
    day = lambda d: None if d is None else datetime.datetime(2024, 1, 1) + datetime.timedelta(days=d)
    lines = [(1, "A", 2.25), (1, "A", 2.25), (1, "A", None), (1, "A", nan), (2, None, 1.5), (None, "A", 9.0), (3, "R", inf), (3, "R", -inf), (3, "N", None), (300, "B", 1.0)]
    orders = [(500, 0, "x"), (500, 0, "x"), (1, 1, "x"), (4, 1, None), (2, 1, "y"), (None, 1, "x"), (2, None, "x"), (3, 3, "x"), (1000, -400, "z")]
    spark.createDataFrame([(day(d), f, q) for d, f, q in lines], "l_shipdate timestamp_ntz, l_returnflag string, l_quantity double").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(k, day(d), p) for k, d, p in orders], "o_orderkey long, o_orderdate timestamp_ntz, o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    wanted = {}
    for d, flag, quantity in lines:
        for key, start, priority in orders:
            if None not in (d, key, start) and start <= d <= start + (400 if key % 500 == 0 else key % 3):
                wanted.setdefault((priority, flag), []).append(quantity)
    joined = []
    monkeypatch.setattr(catalog.sql, "interval_join", lambda a, b, *spans: joined.append((a.count(), b.count())) or interval_join(a, b, *spans))
    found = {(r[0], r[1]): (r["n"], str(r["units"])) for r in catalog.QUERIES["interval_join_shipments"](spark, str(tmp_path)).collect()}
    total = lambda qs: sum(known) if (known := [q for q in qs if q is not None and q == q]) else None
    assert found == {k: (len(qs), str(total(qs))) for k, qs in wanted.items()} and found["x", "R"][1] == "nan"
    assert joined == [(6, 8)]
