"""Tables in buckets: what an upsert reads and writes."""

import pytest
from pyspark.sql import functions as F

from tablewright.operators.buckets import create_buckets, latest, read_buckets, upsert_buckets
from tablewright.operators.graph import upsert_nodes
from tablewright.plans.pipeline import extract, load


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture
def table(spark, tmp_path):
    uri = str(tmp_path / "table")
    create_buckets(spark.range(300).selectExpr("id", "id * 2 AS v"), uri, "id", 32)
    return uri


def _merge(old, new):
    return upsert_nodes(old, new, "id")


def test_only_touched_buckets_are_read_and_written(spark, table):
    before = latest(spark, table)
    seen = []

    def merge(old, new):
        seen.append(old.inputFiles())
        return _merge(old, new)

    new = spark.createDataFrame([(5, -1, "x"), (1000, -2, None), (5, -1, "x")], "id int, v bigint, note string")
    touched = upsert_buckets(spark, table, new, merge)
    after = latest(spark, table)
    assert 1 <= len(touched) <= 2 and after.number == 1
    assert all(any(f"/{before.folders[b]}/" in f for b in touched) for f in seen[0])
    assert {b for b in range(32) if before.folders.get(b) != after.folders.get(b)} == set(touched)
    wanted = {i: (i, i * 2, None) for i in range(300)} | {5: (5, -1, "x"), 1000: (1000, -2, None)}
    assert _rows(read_buckets(spark, table)) == sorted(wanted.values(), key=str)
    assert _rows(read_buckets(spark, table, version=0)) == _rows(spark.range(300).selectExpr("id", "id * 2 AS v"))
    assert upsert_buckets(spark, table, new.limit(0), _merge) == [] and latest(spark, table).number == 1


def test_refusals(spark, table, tmp_path):
    new = spark.createDataFrame([(5, 1)], "id bigint, v bigint")
    with pytest.raises(ValueError, match="missing or of another type"):
        upsert_buckets(spark, table, new, lambda old, new: new.select("id"))
    with pytest.raises(ValueError, match="no incoming key"):
        upsert_buckets(spark, table, new, lambda old, new: new.unionByName(spark.range(50).selectExpr("id", "id AS v")))
    with pytest.raises(FileNotFoundError):
        read_buckets(spark, str(tmp_path / "nothing"))
    with pytest.raises(ValueError, match="key"):
        create_buckets(new, str(tmp_path / "other"), "absent")
    with pytest.raises(FileExistsError):
        create_buckets(new, table, "id")
    assert latest(spark, table).number == 0 and read_buckets(spark, table).count() == 300


def test_lost_run_leaves_the_table_as_it_was(spark, table):
    def lost(old, new):
        return _merge(old, new).withColumn("v", F.raise_error(F.lit("lost")).cast("bigint"))

    new = spark.createDataFrame([(5, 1)], "id bigint, v bigint")
    with pytest.raises(Exception, match="lost"):
        upsert_buckets(spark, table, new, lost)
    assert read_buckets(spark, table).filter("id = 5").first()["v"] == 10
    upsert_buckets(spark, table, new, _merge)
    assert read_buckets(spark, table).filter("id = 5").first()["v"] == 1


def test_taken_name_and_null_keys(spark, tmp_path):
    uri = str(tmp_path / "t")
    create_buckets(spark.createDataFrame([(None, 1.5), ("a", float("nan"))], "k string, bucket double"), uri, "k", 4)
    assert _rows(read_buckets(spark, uri)) == [("a", None), (None, 1.5)]


def test_configured_sink_and_source(spark, tmp_path):
    nodes, edges = str(tmp_path / "nodes"), str(tmp_path / "edges")
    people = spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, name string")
    for frame in (people, people.limit(1).withColumn("name", F.lit("c"))):
        load(frame, {"type": "graph", "load_type": "nodes", "node_label": "P", "target": nodes, "bucketed": True, "buckets": 8})
    assert {r["name"] for r in read_buckets(spark, nodes).collect()} in ({"b", "c"}, {"a", "c"})
    links = spark.createDataFrame([(1, 2), (1, 9)], "from_id bigint, to_id bigint")
    load(links, {"type": "graph", "load_type": "relationships", "nodes": nodes, "target": edges, "relationship_type": "KNOWS", "bucketed": True})
    found = extract(spark, {"type": "graph", "nodes": nodes, "edges": edges, "relationship_type": "KNOWS", "bucketed": True})
    assert [(r["from_id"], r["to_id"]) for r in found.collect()] == [(1, 2)]
