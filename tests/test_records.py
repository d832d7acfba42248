"""CSV records with line breaks across the borders of splits."""

import csv
import random

import pytest

from tablewright.plans.pipeline import run_pipeline
from tablewright.sources import records
from tablewright.sources.files import read_csv
from tablewright.sources.records import ends_inside, records_of

SPLITS = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")


@pytest.fixture
def split_into(spark):
    before = {k: spark.conf.get(k) for k in SPLITS}

    def cut(size):
        spark.conf.set(SPLITS[0], size)
        spark.conf.set(SPLITS[1], 1)

    yield cut
    for k, v in before.items():
        spark.conf.set(k, v)


def _cells(rng):
    kind = rng.random()
    if kind < 0.3:
        return "".join(rng.choice('ab,"\n\r x') for _ in range(rng.randrange(60)))
    return "\n" * rng.randrange(30) if kind < 0.4 else rng.choice(["x", 'a 5" pipe', "é", '"', ' "q"', "long " * 50])


def _write(path, rows, end="\n"):
    with open(path, "w", newline="") as file:
        writer = csv.writer(file, lineterminator=end)
        writer.writerows(rows)


@pytest.mark.parametrize("size, end, piece", [(150, "\n", 1 << 16), (150, "\r\n", 10), (1000, "\r\n", 1 << 16)])
def test_any_split(spark, tmp_path, split_into, size, end, piece):
    rng = random.Random(size)
    files = {}
    for name in ("a", "b"):
        rows = [[f"{name}{i}", _cells(rng), _cells(rng)] for i in range(25)]
        _write(tmp_path / f"{name}.csv", [["id", 'first\n"line"' * 20, "last"], *rows], end)
        files[name] = rows
    split_into(size)
    found = records_of(spark, str(tmp_path), ",", True, {}, piece)
    found = [next(csv.reader([r["record"]] if "\n" not in r["record"] else r["record"].splitlines(keepends=True))) for r in found.collect()]
    assert len(found) == 50
    table = read_csv(spark, str(tmp_path), infer=False, multi_line=True)
    assert table.columns == ["id", 'first\n"line"' * 20, "last"]
    wanted = sorted([*r[:1], *(c or None for c in r[1:])] for f in files.values() for r in f)
    assert sorted((list(r) for r in table.collect()), key=lambda r: r[0]) == sorted(wanted, key=lambda r: r[0])


def test_partitions_are_those_of_the_plain_read(spark, tmp_path, split_into):
    _write(tmp_path / "plain.csv", [["a", "b"], *([i, "x" * 50] for i in range(500))])
    _write(tmp_path / "broken.csv", [["a", "b"], *([i, "x\n" * 25] for i in range(500))])
    split_into(1800)
    for name, more in (("plain", 0), ("broken", 1)):
        path = str(tmp_path / f"{name}.csv")
        plain = spark.read.csv(path).rdd.getNumPartitions()
        schema = "a bigint, b string"
        ran = run_pipeline(spark, {"source": {"type": "csv", "path": path, "schema": schema}})
        assert ran.data.rdd.getNumPartitions() == plain + more > 8
        assert ran.data.count() == 500 == ran.data.filter("length(b) = 50").count()


def test_last_cell_left_open(spark, tmp_path, split_into):
    (tmp_path / "open.csv").write_text('a,b\n1,x\n2,"never closed\n' + "line\n" * 30)
    split_into(40)
    rows = read_csv(spark, str(tmp_path / "open.csv"), infer=False, multi_line=True).collect()
    assert sorted(r["a"] for r in rows) == ["1", "2"]
    assert next(r["b"] for r in rows if r["a"] == "2").count("line") == 30


def test_other_separator_and_bad_rows(spark, tmp_path, split_into):
    (tmp_path / "t.csv").write_text('a;b\n1;"x;\ny"\n2;u;v\n3\n')
    split_into(8)
    path = str(tmp_path / "t.csv")
    kept = read_csv(spark, path, sep=";", infer=False, multi_line=True, bad_rows="keep").collect()
    assert sorted(map(tuple, kept)) == [("1", "x;\ny"), ("2", "u"), ("3", None)]
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        read_csv(spark, path, sep=";", infer=False, multi_line=True).collect()


def test_changed_splits_end_the_job(spark, tmp_path, split_into):
    _write(tmp_path / "t.csv", [["a"], *([f"x\n{i}"] for i in range(60))])
    split_into(20)
    table = read_csv(spark, str(tmp_path / "t.csv"), infer=False, multi_line=True)
    split_into(41)
    with pytest.raises(Exception, match="open them again"):
        table.withColumnRenamed("a", "b").collect()


def test_ends_inside():
    cases = {'a,b': False, 'a,"b': True, '"a""b",c': False, '"a""': True, 'a 5" b': False, '"a"x,"': True, ' "a': False, 'a,"b",': False, "": False}
    for line, wanted in cases.items():
        assert ends_inside(line, False, ",") == wanted, line
    cases = {"a": True, 'a"': False, 'a",b': False, 'a","b': True, 'a""': True, '"': False, '","': True, '"x,y': False, 'x"y"z,"': True}
    for line, wanted in cases.items():
        assert ends_inside(line, True, ",") == wanted, line


def test_states_of_splits(monkeypatch):
    rng = random.Random(1)
    ends = [-(2**63), 2**63 - 1, 0, 5]
    inside = {(rng.choice(ends), start): rng.random() < 0.5 for start in range(0, 9000, 7)}
    states = records._States(inside)
    assert all(states.find(k) == v for k, v in inside.items())
    assert states.find((5, 1)) is None and states.find((6, 0)) is None and records._States({}).find((1, 1)) is None
    monkeypatch.setattr(records, "STATE_BYTES", 1000)
    with pytest.raises(ValueError, match="too many"):
        records._States(inside)
