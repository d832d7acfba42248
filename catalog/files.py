from pyspark.sql import functions as F

from tablewright.plans.ledger import content_of, content_of_files, fingerprint
from tablewright.plans.pipeline import run_pipeline
from tablewright.session import freeze, scratch_uri
from tablewright.sources.files import read_csv, read_object
from tablewright.sources.sinks import materialize, write_csv, write_object
from tablewright.streaming.commits import read_sink
from tablewright.streaming.files import (
    clean_stream,
    read_stream,
    write_append,
    write_cleaned,
    write_quarantine,
)

from .registry import query

TASK_ROWS = 2_000_000  # rows for which a shuffle that is part of a query gets one more task


@query("SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment FROM customer")
def roundtrip_csv(t):
    uri = scratch_uri(t.spark, "customer") + ".csv"
    write_csv(t.customer, uri)
    return read_csv(t.spark, uri)


@query("SELECT conv_id, turn, role, text FROM conversations")
def roundtrip_csv_text(t):
    """Texts with line breaks, quotes and separators."""
    uri = scratch_uri(t.spark, "conversations") + ".csv"
    write_csv(t.conversations, uri)
    return read_csv(t.spark, uri, schema="conv_id bigint, turn bigint, role string, text string", multi_line=True)


@query("SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') AS ts, user_id, event_type, value, props FROM events")
def roundtrip_json(t):
    uri = scratch_uri(t.spark, "events") + ".json"
    write_object(t.events.withColumn("ts", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS")), uri)
    return read_object(t.spark, uri).select("event_id", "ts", "user_id", "event_type", "value", "props")


MICROS = "SELECT event_id, ts + to_microseconds((event_id * 7919) % 1000000) AS ts FROM events"


def _micros(t):
    return t.events.select("event_id", (F.col("ts") + F.expr("make_dt_interval(0, 0, 0, ((event_id * 7919) % 1000000) / 1000000.0)")).alias("ts"))


@query(MICROS)
def roundtrip_csv_micros(t):
    uri = scratch_uri(t.spark, "events") + ".csv"
    write_csv(_micros(t), uri)
    return read_csv(t.spark, uri, parse_dates=["ts"])


@query(MICROS)
def roundtrip_json_micros(t):
    uri = scratch_uri(t.spark, "events") + ".json"
    write_object(_micros(t), uri)
    return read_object(t.spark, uri).select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"))


@query("SELECT conv_id, turn, role, text FROM conversations")
def roundtrip_csv_pipeline(t):
    """Quoted line breaks through a configured run."""
    first, second = (scratch_uri(t.spark, "conversations") + ".csv" for _ in range(2))
    write_csv(t.conversations, first)
    schema = "conv_id bigint, turn bigint, role string, text string"
    run_pipeline(t.spark, {"source": {"type": "csv", "path": first, "schema": schema}, "load": {"type": "csv", "path": second}})
    return read_csv(t.spark, second, schema=schema, multi_line=True)


@query("SELECT conv_id, turn, role, text FROM conversations")
def roundtrip_csv_split(t):
    """One file read in splits of a few lines, so that many texts with line breaks cross their borders."""
    uri = scratch_uri(t.spark, "conversations") + ".csv"
    write_csv(t.conversations, uri, single_file=True)
    # The splits stay small, but a task reads many of them.
    small = {"maxPartitionBytes": "4k", "openCostInBytes": "2k", "maxPartitionNum": 8 * t.spark.sparkContext.defaultParallelism}
    small = {f"spark.sql.files.{k}": v for k, v in small.items()}
    before = {k: t.spark.conf.get(k, None) for k in small}
    for k, v in small.items():
        t.spark.conf.set(k, v)
    try:
        return freeze(read_csv(t.spark, uri, schema="conv_id bigint, turn bigint, role string, text string", multi_line=True))
    finally:
        for k, v in before.items():
            t.spark.conf.unset(k) if v is None else t.spark.conf.set(k, v)


@query("SELECT * FROM orders")
def roundtrip_parquet(t):
    return materialize(t.orders)


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0 THEN o_custkey END AS custkey, nullif(o_orderstatus, 'P') AS status,
    o_totalprice > 100000 AS dear, CAST(strftime(o_orderdate, '%Y-%m-%d') AS TIMESTAMP) AS day FROM orders""")
def csv_types_inferred(t):
    rows = t.orders.select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 5 != 0, F.col("o_custkey").cast("string")).otherwise("NA").alias("custkey"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).otherwise("None").alias("status"),
        F.when(F.col("o_totalprice") > 100000, "True").otherwise("False").alias("dear"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"),
    )
    uri = scratch_uri(t.spark, "orders") + ".csv"
    write_csv(rows, uri)
    return read_csv(t.spark, uri, parse_dates=["day"])


STREAM_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def _event_stream(t):
    return read_stream(t.spark, t.folder, STREAM_SCHEMA, name_filter="events.parquet").withColumn(
        "ts", F.col("ts").cast("timestamp")
    )


def _event_batches(t, files=3):
    """The events in several files, each a batch of its own, so that state is carried from batch to batch."""
    folder = scratch_uri(t.spark, "incoming")
    t.events.repartition(files, "event_id").write.parquet(folder)
    return read_stream(t.spark, folder, STREAM_SCHEMA, max_files=1).withColumn("ts", F.col("ts").cast("timestamp"))


@query("""SELECT event_id, user_id, event_type AS kind, value FROM events WHERE value > 10 AND event_type <> 'error'""")
def stream_cleaned_rows(t):
    stream = _event_batches(t).select("event_id", "user_id", F.nullif("event_type", F.lit("error")).alias("Kind"), "value")
    cleaned = clean_stream(stream, {"remove_duplicates": False, "filter_expr": "value > 10"})
    uri = scratch_uri(t.spark, "stream")
    write_append(cleaned, uri).awaitTermination()
    return read_sink(t.spark, uri).drop("batch")


@query("SELECT DISTINCT user_id, event_type FROM events")
def stream_distinct(t):
    stream = _event_batches(t).select("ts", "user_id", "event_type")
    unique = clean_stream(stream, {"dedup_cols": ["user_id", "event_type"]}, event_time="ts", delay="3650 days")
    uri = scratch_uri(t.spark, "stream")
    stores = t.spark.sparkContext.defaultParallelism
    write_append(unique.select("user_id", "event_type"), uri, state_partitions=stores).awaitTermination()
    return read_sink(t.spark, uri).drop("batch")


@query("SELECT event_id, value FROM events UNION ALL SELECT o_orderkey, o_totalprice FROM orders")
def stream_two_runs(t):
    """Two starts from two folders into one sink: the second goes on after the first."""
    uri = scratch_uri(t.spark, "stream")
    rows = [t.events.select("event_id", "value"), t.orders.select(F.col("o_orderkey").alias("event_id"), F.col("o_totalprice").alias("value"))]
    for frame in rows:
        folder = scratch_uri(t.spark, "incoming")
        frame.repartition(3).write.parquet(folder)
        stream = read_stream(t.spark, folder, "event_id bigint, value double", max_files=1)
        write_append(stream, uri, name=folder.rsplit("-", 1)[-1]).awaitTermination()
    return read_sink(t.spark, uri).drop("batch")


@query("SELECT event_id, value FROM events UNION ALL SELECT o_orderkey, o_totalprice FROM orders")
def stream_own_checkpoints(t):
    """Two streams with progress folders of their own, both counting their batches from zero, into one sink."""
    uri = scratch_uri(t.spark, "stream")
    rows = [t.events.select("event_id", "value"), t.orders.select(F.col("o_orderkey").alias("event_id"), F.col("o_totalprice").alias("value"))]
    for frame in rows:
        folder = scratch_uri(t.spark, "incoming")
        frame.repartition(2).write.parquet(folder)
        stream = read_stream(t.spark, folder, "event_id bigint, value double", max_files=1)
        write_append(stream, uri, checkpoint=scratch_uri(t.spark, "progress")).awaitTermination()
    return read_sink(t.spark, uri).drop("batch")


@query("""WITH q AS (SELECT quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.75) AS b FROM events)
    SELECT event_id, value FROM events, q WHERE value BETWEEN a - 1.5 * (b - a) AND b + 1.5 * (b - a)""")
def stream_cleaned_batches(t):
    uri = scratch_uri(t.spark, "stream")
    stream = _event_stream(t).select("event_id", "value")
    config = {"dedup_cols": ["event_id"], "remove_outliers": True, "outlier_cols": ["value"]}
    write_cleaned(stream, config, uri).awaitTermination()
    return read_sink(t.spark, uri).select("event_id", "value")


@query("""SELECT event_id, CASE WHEN value > 100 THEN 'value:max_value' ELSE '' END AS rules FROM events""")
def stream_quarantine(t):
    rules = {"validity": {"column_rules": {"value": {"max_value": 100}}}}
    good, bad = scratch_uri(t.spark, "good"), scratch_uri(t.spark, "bad")
    write_quarantine(_event_batches(t).select("event_id", "value"), rules, good, bad).awaitTermination()
    kept = read_sink(t.spark, good).select("event_id", F.lit("").alias("rules"))
    return kept.unionByName(
        read_sink(t.spark, bad).select("event_id", F.array_join("violated_rules", "|").alias("rules"))
    )


@query("""SELECT o_orderpriority, o_orderstatus, round(sum(o_totalprice), 2) AS o_totalprice_sum,
    round(avg(o_totalprice), 4) AS o_totalprice_mean, count(o_totalprice) AS o_totalprice_count,
    count(DISTINCT o_custkey) AS o_custkey_nunique FROM orders GROUP BY 1, 2""")
def aggregate_from_config(t):
    uri = scratch_uri(t.spark, "report") + ".parquet"
    run_pipeline(
        t.spark,
        {
            "source": {"type": "s3", "uri": f"{t.folder}/orders.parquet"},
            "transform": {
                "type": "aggregator",
                "group_by": ["o_orderpriority", "o_orderstatus"],
                "aggregations": {"o_totalprice": ["sum", "mean", "count"], "o_custkey": "nunique"},
                "sort_by": ["o_totalprice_sum"],
                "sort_ascending": False,
                "limit": 1000,
                "post_filter": "o_totalprice_sum > 1000",
            },
            "load": {"type": "s3", "uri": uri, "overwrite": True},
        },
    )
    result = t.spark.read.parquet(uri)
    return result.withColumns(
        {"o_totalprice_sum": F.round("o_totalprice_sum", 2), "o_totalprice_mean": F.round("o_totalprice_mean", 4)}
    )


@query("""SELECT c_mktsegment, round(sum(c_acctbal), 2) AS total FROM customer GROUP BY 1""")
def sql_from_config(t):
    run = run_pipeline(
        t.spark,
        {
            "source": {"type": "s3", "uri": f"{t.folder}/customer.parquet"},
            "transform": {
                "type": "sql",
                "sql_query": "SELECT c_mktsegment, round(sum(c_acctbal), 2) AS total FROM source_data GROUP BY 1",
            },
        },
    )
    return run.data


@query("""SELECT count(*) AS rows, true AS same_in_any_order, true AS same_in_files, false AS same_after_a_change,
    true AS same_without_reading FROM lineitem""")
def content_fingerprint(t):
    """Hash sums that do not depend on the order or the files, differ after one change, and are read off the ledger later."""
    rows, ledger, folder = t.lineitem, scratch_uri(t.spark, "ledger"), scratch_uri(t.spark, "lineitem")
    more = rows.count() // TASK_ROWS
    rows.repartition(5 + more).write.parquet(folder)
    first = content_of(rows)
    least = rows.agg(F.min("l_extendedprice")).first()[0]
    changed = rows.withColumn("l_tax", F.when(F.col("l_extendedprice") == least, -1.0).otherwise(F.col("l_tax")))
    files = content_of_files(t.spark, ledger, folder, "parquet")
    again = content_of_files(t.spark, ledger, folder, "parquet")
    facts = [content_of(rows.repartition(7 + more, "l_suppkey", "l_orderkey")) == first, files == first, content_of(changed) == first, again == files]
    names = ["same_in_any_order", "same_in_files", "same_after_a_change", "same_without_reading"]
    return fingerprint(rows).select("rows", *[F.lit(f).alias(n) for f, n in zip(facts, names)])
