import datetime
import json
import os

import pytest
from pyspark.sql import functions as F

import catalog
import catalog.files
import catalog.whole
from tablewright.operators.graph import match_edges, match_nodes, upsert_edges, upsert_nodes
from tablewright.operators.sqlops import apply_sql_transform, sql_transform
from tablewright import session
from tablewright.plans import ledger, pipeline
from tablewright.plans.ledger import content_of, content_of_files
from tablewright.plans.pipeline import SINKS, SOURCES, TRANSFORMS, extract, load, pick, run_pipeline, transform
from tablewright.session import freeze, shared_dir, stage_count
from tablewright.sources.files import from_rows, load_intermediate, object_settings, object_uri, read_csv, read_object
from tablewright.sources.sinks import materialize, write_batches, write_csv, write_object
from tablewright.streaming.commits import commits, read_sink, write_batch
from tablewright.streaming.files import clean_stream, read_stream, write_append, write_batchwise, write_quarantine


def rows(df):
    return [tuple(r) for r in df.collect()]


# --- files ---------------------------------------------------------------------------------


def test_csv_scan(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("col1,col2\n1,a\n2,b\n3,c\n")
    got = read_csv(spark, str(path))
    assert got.count() == 3 and dict(got.dtypes) == {"col1": "bigint", "col2": "string"}


def test_csv_types_and_missing_words(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text(
        "i,f,b,d,s,e,big,code\n1,1.5,True,2020-01-02,x,NA,99999999999999999999,1d\nNA,,false,2021-02-03,None,,1,2\n-3,1e3,TRUE,N/A,null,nan,2,3\n"
    )
    got = read_csv(spark, str(path))
    assert dict(got.dtypes) == {
        "i": "bigint", "f": "double", "b": "boolean", "d": "string", "s": "string", "e": "double", "big": "double", "code": "string",
    }
    assert [r[:6] for r in rows(got)] == [
        (1, 1.5, True, "2020-01-02", "x", None),
        (None, None, False, "2021-02-03", None, None),
        (-3, 1000.0, True, None, None, None),
    ]
    dated = read_csv(spark, str(path), parse_dates=["d"], dtype={"i": "float64", "code": "str"})
    assert dict(dated.dtypes)["d"] == "timestamp_ntz" and dict(dated.dtypes)["i"] == "double"
    assert rows(dated)[0][3] == datetime.datetime(2020, 1, 2)


def test_csv_options(spark, tmp_path):
    path = tmp_path / "a.txt"
    path.write_bytes("1;é\n2;b\n".encode("latin-1"))
    got = read_csv(spark, str(path), sep=";", encoding="ISO-8859-1", header=None)
    assert got.columns == ["0", "1"] and rows(got) == [(1, "é"), (2, "b")]
    typed = read_csv(spark, str(path), sep=";", header=False, schema="a int, b string")
    assert dict(typed.dtypes)["a"] == "int"


def test_csv_errors(spark, tmp_path):
    with pytest.raises(ValueError, match="'path'"):
        read_csv(spark, "")
    with pytest.raises(FileNotFoundError):
        read_csv(spark, str(tmp_path / "none.csv"))
    for line in (1, 3):
        with pytest.raises(ValueError, match="first line"):
            read_csv(spark, "x", header=line)


@pytest.mark.parametrize("suffix", ["csv", "parquet", "json", "data"])
def test_object_round_trip(spark, tmp_path, suffix):
    df = spark.createDataFrame([(1, "a\"b,c"), (2, None)], "x long, s string")
    uri = str(tmp_path / f"t.{suffix}")
    write_object(df, uri)
    options = {}
    assert sorted(rows(read_object(spark, uri, **options).select("x", "s")), key=str) == sorted(rows(df), key=str)
    with pytest.raises(FileExistsError):
        write_object(df, uri)
    write_object(df.limit(1), uri, overwrite=True)
    assert read_object(spark, uri, **options).count() == 1


def test_json_array(spark, tmp_path):
    path = tmp_path / "a.json"
    path.write_text(json.dumps([{"x": 1}, {"x": 2}], indent=1))
    with pytest.raises(RuntimeError, match="json_lines=False"):
        read_object(spark, str(path))
    assert sorted(rows(read_object(spark, str(path), json_lines=False))) == [(1,), (2,)]
    path.write_text(json.dumps([{"x": 1}, {"x": 2}]))  # on one line
    assert sorted(rows(read_object(spark, str(path)))) == [(1,), (2,)]


def test_csv_sink_modes(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "x long, s string")
    uri = str(tmp_path / "out")
    write_csv(df, uri, sep=";", single_file=True)
    with pytest.raises(FileExistsError):
        write_csv(df, uri)
    write_csv(df, uri, "append", sep=";")
    assert rows(read_csv(spark, uri, sep=";")) == [(1, "a"), (1, "a")]
    write_csv(df, uri, "overwrite", header=False)
    assert rows(read_csv(spark, uri, header=None)) == [(1, "a")]
    with pytest.raises(ValueError):
        write_csv(df, uri, "sometimes")


def test_object_addresses():
    config = {"bucket": "b", "key": "k.csv", "access_key": "a", "secret_key": "s", "region": "r", "server_side_encryption": "AES256"}
    assert object_uri(config) == "s3a://b/k.csv"
    assert object_settings(config) == {
        "fs.s3a.bucket.b.access.key": "a",
        "fs.s3a.bucket.b.secret.key": "s",
        "fs.s3a.bucket.b.endpoint.region": "r",
        "fs.s3a.bucket.b.encryption.algorithm": "AES256",
    }
    for missing in ("bucket", "key"):
        with pytest.raises(ValueError, match=missing):
            object_uri({k: v for k, v in config.items() if k != missing})


def test_rows_and_batches(spark, tmp_path):
    assert rows(from_rows(spark, {"a": 1})) == [(1,)]
    assert rows(from_rows(spark, [{"a": 1}, {"a": 2, "b": "x"}])) == [(1, None), (2, "x")]
    with pytest.raises(ValueError):
        from_rows(spark, "text")
    folder = str(tmp_path)

    def send(batch):
        import os
        import uuid

        with open(os.path.join(folder, uuid.uuid4().hex), "w") as f:
            f.write(f"{len(batch)} {sum(r['id'] for r in batch)}")

    write_batches(spark.range(0, 25, numPartitions=2), send, 10)
    parts = [tuple(map(int, p.read_text().split())) for p in tmp_path.iterdir()]
    assert sum(n for n, _ in parts) == 25 and max(n for n, _ in parts) <= 10 and sum(s for _, s in parts) == 300


def test_intermediates(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "x long, s string")
    for fmt in ("parquet", "csv", "json"):
        uri = str(tmp_path / fmt)
        got = materialize(df, uri, fmt)
        assert sorted(rows(got.select("x", "s"))) == [(1, "a")]
        assert load_intermediate(spark, uri, fmt).count() == 1
    assert rows(freeze(df)) == [(1, "a")] and shared_dir(spark)
    with pytest.raises(FileNotFoundError):
        load_intermediate(spark, str(tmp_path / "none"))


# --- graph ---------------------------------------------------------------------------------


def test_node_upserts(spark):
    old = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "id long, name string, extra string")
    new = spark.createDataFrame([(2, "old", 1), (2, None, 2), (3, "c", 1)], "id long, name string, seq long")
    merged = sorted(rows(upsert_nodes(old, new, order_by="seq")))
    assert merged == [(1, "a", "x", None), (2, None, "y", 2), (3, "c", None, 1)]
    replaced = sorted(rows(upsert_nodes(old, new, mode="replace", order_by="seq")))
    assert replaced == [(1, "a", "x", None), (2, None, None, 2), (3, "c", None, 1)]
    with pytest.raises(ValueError, match="null"):
        upsert_nodes(old, spark.createDataFrame([(None, "a")], "id long, name string"))
    with pytest.raises(ValueError, match="mode"):
        upsert_nodes(old, new, mode="other")


def test_labels_keep_ids_apart(spark):
    old = spark.createDataFrame([("A", 1, "a")], "label string, id long, name string")
    new = spark.createDataFrame([(1, "b")], "id long, name string")
    assert sorted(rows(upsert_nodes(old, new, label="B"))) == [("A", 1, "a"), ("B", 1, "b")]
    assert rows(upsert_nodes(old, new, label="A")) == [("A", 1, "b")]


def test_edges(spark):
    nodes = spark.createDataFrame([("P", 1, "ann"), ("P", 2, "bob"), ("C", 9, "acme")], "label string, id long, name string")
    edges = spark.createDataFrame([(1, 9, "WORKS", 5)], "from_id long, to_id long, type string, years long")
    new = spark.createDataFrame([(1, 9, 6, 1), (1, 9, 7, 2), (2, 9, 1, 1), (2, 77, 1, 1), (9, 9, 1, 1), (None, 9, 1, 1)], "from_id long, to_id long, years long, seq long")
    got = upsert_edges(nodes, edges, new, rel_type="WORKS", from_label="P", to_label="C", order_by="seq")
    assert sorted(rows(got)) == [(1, 9, "WORKS", 7, 2), (2, 9, "WORKS", 1, 1)]
    matched = match_edges(nodes, got, "WORKS", "P", "C")
    assert {(r["from_name"], r["to_name"], r["years"]) for r in matched.collect()} == {("ann", "acme", 7), ("bob", "acme", 1)}
    assert match_edges(nodes, got, "OTHER").count() == 0
    assert match_nodes(nodes, "P", "name = 'ann'").count() == 1


# --- SQL -----------------------------------------------------------------------------------


def test_sql(spark, tmp_path):
    df = spark.createDataFrame([(8, 5, "north"), (9, 2, "south"), (8, 6, "north")], "id long, value long, category string")
    query = "SELECT category, SUM(value) AS total_value FROM source_data GROUP BY category"
    assert sorted(rows(sql_transform(df, query))) == [("north", 11), ("south", 2)]
    path = tmp_path / "q.sql"
    path.write_text("SELECT max(value) AS m\nFROM source_data")
    assert rows(sql_transform(df, query, sql_file=str(path))) == [(6,)]
    assert rows(apply_sql_transform(df, "SELECT count(*) FROM data")) == [(3,)]
    with pytest.raises(ValueError, match="either"):
        sql_transform(df)
    with pytest.raises(ValueError, match="requires a Spark DataFrame"):
        sql_transform([1], query)


def test_sql_leaves_other_views_alone(spark):
    spark.range(3).createOrReplaceTempView("kept")
    assert rows(sql_transform(spark.range(7), "SELECT count(*) FROM kept", "kept")) == [(7,)]
    assert spark.table("kept").count() == 3
    spark.catalog.dropTempView("kept")
    assert not {t.name for t in spark.catalog.listTables()} & {"source_data", "data"}


# --- plans ---------------------------------------------------------------------------------


def test_registries():
    for registry in (SOURCES, TRANSFORMS, SINKS):
        with pytest.raises(ValueError, match="Available"):
            pick(registry, {"type": "other"}, "step")
        with pytest.raises(ValueError, match="must include 'type'"):
            pick(registry, {}, "step")


def test_required_keys(spark):
    df = spark.range(1)
    for call in (
        lambda: extract(spark, {"type": "csv"}),
        lambda: extract(spark, {"type": "s3", "bucket": "b"}),
        lambda: extract(spark, {"type": "graph"}),
        lambda: transform(df, {"type": "aggregator", "group_by": "id"}),
        lambda: transform(df, {"type": "aggregator", "aggregations": {"id": "sum"}}),
        lambda: transform(df, {"type": "sql"}),
        lambda: load(df, {"type": "csv"}),
        lambda: load(df, {"type": "s3", "key": "k"}),
        lambda: load(df, {"type": "graph"}),
        lambda: load(df, {"type": "graph", "load_type": "custom"}),
        lambda: load(df, {"type": "graph", "load_type": "other"}),
        lambda: run_pipeline(spark, {}),
    ):
        with pytest.raises(ValueError):
            call()


def _sales(tmp_path):
    lines = ["order_id,customer_name,product_category,order_amount,order_date,quantity,unit_price"]
    for i in range(1, 41):
        name = "" if i % 9 == 0 else f"c{i % 5}"
        lines.append(f"{i},{name},Books,{i * 2.5},2021-01-{i % 28 + 1:02d},{i},2.5")
    lines += ["1,dup,Books,2.5,2021-01-02,1,2.5", "99,big,Home,90000,2021-01-01,36000,2.5", "98,neg,Home,-5,2021-01-01,-2,2.5"]
    path = tmp_path / "sales.csv"
    path.write_text("\n".join(lines))
    return str(path)


def test_whole_run(spark, tmp_path):
    out = str(tmp_path / "out")
    config = {
        "source": {"type": "csv", "path": _sales(tmp_path), "separator": ",", "header": 0},
        "transform": {
            "type": "cleaner",
            "dedup_cols": ["order_id"],
            "missing_strategy": "fill",
            "fill_values": {"customer_name": "Unknown Customer", "product_category": "Uncategorized"},
            "filter_expr": "order_amount > 0",
            "dtype_conversions": {"order_amount": "float64", "order_date": "datetime64[ns]"},
            "remove_outliers": True,
            "outlier_cols": ["order_amount"],
        },
        "analytics": {
            "inspection": {"sample_size": 10, "include_correlations": True, "include_outliers": True},
            "quality": {
                "quality_rules": {
                    "completeness": {"required_columns": ["order_id", "customer_name", "order_amount"]},
                    "uniqueness": {"unique_columns": ["order_id"]},
                    "validity": {
                        "column_rules": {
                            "order_amount": {"type": "float", "min_value": 0, "max_value": 100000},
                            "order_date": {"type": "datetime"},
                            "product_category": {"allowed_values": ["Books", "Home", "Uncategorized"]},
                        }
                    },
                    "consistency": {
                        "cross_column_rules": [
                            {
                                "name": "amount",
                                "columns": ["order_amount", "quantity", "unit_price"],
                                "condition": "order_amount == quantity * unit_price",
                            }
                        ]
                    },
                    "accuracy": {
                        "business_rules": [
                            {"name": "dates", "condition": "order_date >= '2020-01-01' and order_date <= '2024-12-31'"},
                            {"name": "quantities", "condition": "quantity >= 1 and quantity <= 1000"},
                        ]
                    },
                }
            },
            "reporting": {"dataset_name": "Sales", "output_path": str(tmp_path / "report")},
        },
        "load": {"type": "csv", "path": out, "overwrite": True},
    }
    runs = str(tmp_path / "ledger")
    run = run_pipeline(spark, config, ledger=runs, name="sales", metrics=True)
    assert run.status == "completed"
    assert run.metrics["extract"] == {"rows": 43, "columns": 7} and run.metrics["transform"]["rows"] == 40
    assert run.analysis["quality"]["overall_score"] == 100.0
    assert read_csv(spark, out).count() == 40
    assert json.loads(spark.read.text(str(tmp_path / "report")).first()[0])["metadata"]["dataset_name"] == "Sales"
    assert run_pipeline(spark, config, ledger=runs, name="sales").status == "skipped"
    assert run_pipeline(spark, config | {"analytics": None}, ledger=runs, name="sales").status == "completed"
    ledger.reset(spark, runs, "sales")
    assert run_pipeline(spark, config | {"analytics": None}, ledger=runs, name="sales").status == "completed"


def test_failed_run_is_not_recorded(spark, tmp_path):
    config = {
        "source": {"type": "csv", "path": _sales(tmp_path)},
        "transform": {"type": "sql", "sql_query": "SELECT * FROM source_data"},
        "load": {"type": "csv", "path": str(tmp_path / "out")},
    }
    runs = str(tmp_path / "ledger")
    (tmp_path / "out").mkdir()
    with pytest.raises(FileExistsError):
        run_pipeline(spark, config, ledger=runs)
    content = ledger.content_of(read_csv(spark, config["source"]["path"]))
    assert not ledger.unchanged(spark, runs, "default", config, content)


def test_fingerprint_follows_content(spark):
    df = spark.range(100)
    assert ledger.content_of(df) == ledger.content_of(df.repartition(7))
    assert ledger.content_of(df) != ledger.content_of(df.withColumn("id", F.col("id") + (F.col("id") == 5).cast("int")))
    assert ledger.config_hash({"a": 1, "b": 2}) == ledger.config_hash({"b": 2, "a": 1})
    assert len(ledger.config_hash({})) == 16


def test_graph_run(spark, tmp_path):
    nodes, edges = str(tmp_path / "nodes.parquet"), str(tmp_path / "edges.parquet")
    load(spark.createDataFrame([(1, "a"), (2, "b")], "id long, name string"), {"type": "graph", "target": nodes, "node_label": "N"})
    load(
        spark.createDataFrame([(1, 2, 0.5), (1, 3, 0.5)], "from_id long, to_id long, w double"),
        {"type": "graph", "load_type": "relationships", "nodes": nodes, "target": edges, "relationship_type": "KNOWS"},
    )
    got = extract(spark, {"type": "graph", "nodes": nodes, "edges": edges, "relationship_type": "KNOWS", "from_label": "N"})
    assert [(r["from_name"], r["to_name"]) for r in got.collect()] == [("a", "b")]
    assert extract(spark, {"type": "graph", "nodes": nodes, "where": "id = 2"}).count() == 1


# --- streams -------------------------------------------------------------------------------


@pytest.fixture()
def stream_folder(spark, tmp_path):
    folder = str(tmp_path / "in")
    for part in range(3):
        data = [(i, datetime.datetime(2024, 1, 1, i % 24), f"k{i % 4}", None if i % 5 == 0 else float(i)) for i in range(part * 10, part * 10 + 10)]
        spark.createDataFrame(data, "id long, ts timestamp, k string, v double").coalesce(1).write.mode("append").parquet(folder)
    return folder


SCHEMA = "id long, ts timestamp, k string, v double"


def test_stream_cleaning(spark, stream_folder, tmp_path):
    stream = read_stream(spark, stream_folder, SCHEMA, max_files=1)
    out = str(tmp_path / "out")
    cleaned = clean_stream(stream, {"dedup_cols": ["k"], "missing_strategy": "keep"}, event_time="ts", delay="10 days")
    write_append(cleaned, out).awaitTermination()
    assert spark.read.parquet(out).count() == 4
    with pytest.raises(ValueError, match="event_time"):
        clean_stream(stream, {})
    with pytest.raises(ValueError, match="whole table"):
        clean_stream(stream, {"remove_outliers": True})


def test_stream_batches_and_quarantine(spark, stream_folder, tmp_path):
    stream = read_stream(spark, stream_folder, SCHEMA, max_files=1)
    out, good, bad = (str(tmp_path / n) for n in ("out", "good", "bad"))
    write_batchwise(stream, lambda b: b.groupBy("k").count(), out).awaitTermination()
    assert spark.read.parquet(out).agg(F.sum("count")).first()[0] == 30
    assert spark.read.parquet(out).select("batch").distinct().count() == 3
    rules = {"completeness": {"required_columns": ["v"]}}
    write_quarantine(stream, rules, good, bad).awaitTermination()
    assert spark.read.parquet(good).count() == 24
    assert {tuple(r["violated_rules"]) for r in spark.read.parquet(bad).collect()} == {("v:required",)}


def test_own_progress_folders_share_a_sink(spark, stream_folder, tmp_path):
    """Ten rows and then three, each stream with a batch number zero."""
    more = str(tmp_path / "more")
    spark.read.parquet(stream_folder).limit(3).coalesce(1).write.parquet(more)
    out = str(tmp_path / "out")
    for i, folder in enumerate((stream_folder, more)):
        stream = read_stream(spark, folder, SCHEMA)
        write_append(stream, out, checkpoint=str(tmp_path / f"progress{i}")).awaitTermination()
    assert read_sink(spark, out).count() == 33
    assert commits(spark, out).select("stream").distinct().count() == 2


def test_batch_that_breaks_off_is_not_read_and_runs_again(spark, stream_folder, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    stream = read_stream(spark, stream_folder, SCHEMA, max_files=1)
    calls = []

    def step(batch):
        calls.append(1)
        if len(calls) == 2:
            batch.limit(1).write.parquet(f"{out}/batch=left-over")  # as if the files were there and the commit was not
            raise RuntimeError("lost")
        return batch

    with pytest.raises(Exception, match="lost"):
        write_batchwise(stream, step, out).awaitTermination()
    assert read_sink(spark, out).count() == 10
    write_batchwise(stream, step, out).awaitTermination()
    assert read_sink(spark, out).count() == 30 and len(calls) == 4
    identity = commits(spark, out).first()["stream"]
    batch = spark.read.parquet(stream_folder)
    write_batch(batch, out, identity, 0)  # a batch that has a commit is not written twice
    assert read_sink(spark, out).count() == 30
    with pytest.raises(FileNotFoundError):
        read_sink(spark, str(tmp_path / "nothing"))
    with pytest.raises(ValueError, match="batch"):
        write_batch(batch.withColumn("batch", F.lit(1)), out, identity, 9)


# --- what is known of files ----------------------------------------------------------------


def test_known_files_are_not_opened(spark, tmp_path):
    ledger, folder = str(tmp_path / "ledger"), str(tmp_path / "in")
    rows = spark.range(40).selectExpr("id", "map('b', id, 'a', 1L) AS m", "array(map(1, id)) AS deep", "named_struct('m', map('x', id)) AS s")
    rows.repartition(4).write.parquet(folder)
    first = content_of_files(spark, ledger, folder, "parquet")
    assert first == content_of(rows) == content_of(rows.selectExpr("id", "map('a', 1L, 'b', id) AS m", "deep", "s").repartition(3))
    assert first != content_of(rows.selectExpr("id", "map('b', id, 'a', 2L) AS m", "deep", "s"))
    stored = spark.read.parquet(f"{ledger}/_files").count()
    assert content_of_files(spark, ledger, folder, "parquet") == first
    assert spark.read.parquet(f"{ledger}/_files").count() == stored == 4
    for file in (tmp_path / "in").glob("part-*.parquet"):  # the same size and time, and nothing that could be read
        changed = file.stat().st_mtime_ns
        file.write_bytes(b"x" * file.stat().st_size)
        os.utime(file, ns=(changed, changed))
    assert content_of_files(spark, ledger, folder, "parquet") == first


def test_only_new_files_are_read(spark, tmp_path):
    ledger, folder = str(tmp_path / "ledger"), tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text("id,v\n1,x\n")
    (folder / "empty.csv").write_text("")
    config = {"source": {"type": "csv", "path": str(folder)}, "load": {"type": "csv", "path": str(tmp_path / "out"), "overwrite": True}}
    assert [run_pipeline(spark, config, ledger).status for _ in range(2)] == ["completed", "skipped"]
    (folder / "b.csv").write_text("id,v\n2,y\n")
    assert [run_pipeline(spark, config, ledger).status for _ in range(2)] == ["completed", "skipped"]
    assert spark.read.parquet(f"{ledger}/_files").count() == 2  # an empty file has nothing to be known
    (folder / "b.csv").write_text("id,v\n2,zz\n")
    assert run_pipeline(spark, config, ledger).status == "completed"
    assert spark.read.parquet(f"{ledger}/_files").count() == 3


# --- addresses, settings and what a run leaves behind ---------------------------------------


def test_addresses_and_settings():
    keys = {"access_key": "a", "secret_key": "b", "region": "r"}
    assert object_uri({"uri": "s3://sales/raw/x.csv"}) == "s3a://sales/raw/x.csv" == object_uri({"bucket": "sales", "key": "raw/x.csv"})
    named = object_settings({"bucket": "sales"} | keys)
    assert named == object_settings({"uri": "s3://sales/raw/x.csv"} | keys) == object_settings({"uri": "s3a://sales/x"} | keys)
    assert named["fs.s3a.bucket.sales.endpoint.region"] == "r" and len(named) == 3
    assert object_settings({"uri": "/local/x", "storage": {"k": "v"}} | keys) == {"k": "v"}


def test_records_go_straight_to_a_sink(spark, tmp_path):
    load([{"a": 1, "b": "x"}, {"a": 2}], {"type": "s3", "uri": str(tmp_path / "t.parquet")})
    assert rows(spark.read.parquet(str(tmp_path / "t.parquet")).orderBy("a")) == [(1, "x"), (2, None)]
    load({"a": 3}, {"type": "csv", "path": str(tmp_path / "t.csv")})
    assert rows(read_csv(spark, str(tmp_path / "t.csv"))) == [(3,)]


def test_stages_go_after_a_run(spark, tmp_path, monkeypatch):
    data = spark.createDataFrame([(1, "x"), (1, "x"), (2, None)], "a bigint, b string")
    data.write.parquet(str(tmp_path / "in.parquet"))
    config = {
        "source": {"type": "s3", "uri": str(tmp_path / "in.parquet")},
        "transform": {"type": "cleaner", "missing_strategy": "fill", "remove_outliers": True, "outlier_cols": ["a"]},
        "analytics": {"save_report": False},
        "load": {"type": "s3", "uri": str(tmp_path / "out.parquet")},
    }
    own = freeze(data, "own")
    before = stage_count(spark)
    made = []
    monkeypatch.setattr(pipeline, "drop_stages", lambda s, since: made.extend(session._stages(s)[since:]) or session.drop_stages(s, since))
    run = run_pipeline(spark, config, clean_up=True)
    assert run.status == "completed" and run.data is None and run.analysis["report"]
    assert len(made) > 1 and not any(os.path.exists(uri.removeprefix("file://")) for uri in made)
    assert stage_count(spark) == before and own.count() == 3
    assert spark.read.parquet(str(tmp_path / "out.parquet")).count() == 2
    with pytest.raises(FileExistsError):
        run_pipeline(spark, config, clean_up=True)
    assert stage_count(spark) == before and not any(os.path.exists(uri.removeprefix("file://")) for uri in made)


def test_small_splits_of_a_csv_file_share_tasks(spark, tmp_path, monkeypatch):
    """A file has many splits of a few lines, but a task reads many of them; the texts come back whole."""
    rows = [(i, i % 7, "user", f'{i} "a",\n' + "line\n" * (i % 300) + "end") for i in range(6000)]
    spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    tasks = []
    monkeypatch.setattr(catalog.files, "freeze", lambda df: tasks.append(df.rdd.getNumPartitions()) or freeze(df))
    settings = {k: spark.conf.get(f"spark.sql.files.{k}", None) for k in ("maxPartitionBytes", "openCostInBytes", "maxPartitionNum")}
    found = catalog.QUERIES["roundtrip_csv_split"](spark, str(tmp_path))
    assert sorted(tuple(r) for r in found.collect()) == rows
    splits = sum(len(r[3]) for r in rows) // 4096
    assert splits > 1000 and tasks[0] < splits // 4
    assert settings == {k: spark.conf.get(f"spark.sql.files.{k}", None) for k in settings}


def test_content_fingerprint_in_more_tasks(spark, sf, monkeypatch):
    """The files grow in number with the rows, and say the same."""
    files = []
    monkeypatch.setattr(catalog.files, "TASK_ROWS", 1000)
    monkeypatch.setattr(catalog.files, "content_of_files", lambda s, ledger, folder, fmt: files.append(len(s.read.parquet(folder).inputFiles())) or content_of_files(s, ledger, folder, fmt))
    row = catalog.QUERIES["content_fingerprint"](spark, sf).first()
    assert tuple(row)[1:] == (True, True, False, True)
    assert files == [5 + row["rows"] // 1000] * 2


def test_stream_of_orders_in_more_files(spark, sf, monkeypatch):
    """Three batches of any size come in files of a bounded one."""
    read = []
    monkeypatch.setattr(catalog.whole, "FILE_ROWS", 100)
    monkeypatch.setattr(catalog.whole, "read_stream", lambda s, folder, schema, max_files: read.append((len(s.read.parquet(folder).inputFiles()), max_files)) or read_stream(s, folder, schema, max_files))
    found = catalog.QUERIES["stream_quality_scores"](spark, sf).collect()
    assert sorted(map(str, found)) == sorted(map(str, catalog.QUERIES["quality_whole"](spark, sf).collect()))
    assert read[0][1] > 1 and read[0][0] == 3 * read[0][1]
