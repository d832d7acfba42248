"""Whole outputs as tidy rows: ``key`` (the path to a value), ``number`` and ``text``."""

import json
from dataclasses import replace

from pyspark.sql import functions as F

from tablewright.functions.nulls import numeric_columns
from tablewright.operators.profile import gather, inspect
from tablewright.operators.quality import check_quality
from tablewright.operators.report import analyze, build_report, recommendations, save_report
from tablewright.operators.sqlops import sql_transform
from tablewright.plans import ledger
from tablewright.plans.pipeline import SINKS, SOURCES, TRANSFORMS, run_pipeline
from tablewright.session import scratch_uri
from tablewright.sources.files import from_rows, object_settings, object_uri, read_object
from tablewright.sources.sinks import write_batches, write_csv, write_object
from tablewright.streaming.files import read_stream
from tablewright.streaming.scores import running_quality, write_quality

from .quality import ORDERS, RULES, _orders
from .registry import query

SCHEMA = "key string, number double, text string"
FILE_ROWS = 500_000  # rows of a file of a stream, about; a task reads files whole


def tidy(value, key: str = "") -> list[tuple]:
    """Every number and text of nested dictionaries and lists, numbers to six digits."""
    if isinstance(value, dict):
        return [row for k, v in value.items() for row in tidy(v, f"{key}/{k}" if key else str(k))]
    if isinstance(value, (list, tuple)):
        return [row for i, v in enumerate(value) for row in tidy(v, f"{key}/{i}")]
    if isinstance(value, (bool, int, float)):
        return [(key, round(float(value), 6), None)]
    return [(key, None, None if value is None else str(value))]


def _frame(t, value):
    return t.spark.createDataFrame(tidy(value), SCHEMA)


def _sql(rows: dict[str, str], source: str) -> str:
    """One row for each key; an expression that begins with a quote or TEXT is a text."""
    parts = []
    for key, e in rows.items():
        text = e.startswith(("'", "TEXT "))
        e = e.removeprefix("TEXT ")
        parts.append(f"(SELECT '{key}' AS key, " + (f"NULL::DOUBLE AS number, CAST({e} AS VARCHAR) AS text" if text else f"round(CAST({e} AS DOUBLE), 6) AS number, NULL AS text") + f" FROM {source} LIMIT 1)")
    return " UNION ALL ".join(parts)


CUSTOMER = {"c_custkey": "int64", "c_name": "object", "c_nationkey": "int32", "c_acctbal": "float64", "c_mktsegment": "object"}
NUMBERS = ("c_custkey", "c_acctbal")
STATS = {"count": "count({c})", "mean": "avg({c})", "std": "stddev_samp({c})", "min": "min({c})", "25%": "quantile_cont({c}, 0.25)", "50%": "quantile_cont({c}, 0.5)", "75%": "quantile_cont({c}, 0.75)", "max": "max({c})"}
BYTES = "sum(8 + strlen(c_name) + 4 + 8 + strlen(c_mktsegment))"
COPIES = "(count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM customer)))"
FENCE = "(SELECT quantile_cont({c}, {p}) {s} 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) FROM customer)"


def _inspected() -> str:
    rows = {"basic_info/rows": "count(*)", "basic_info/columns": "5", "basic_info/memory_usage_mb": f"{BYTES} / 1048576.0"}
    rows |= {f"basic_info/column_names/{i}": f"'{c}'" for i, c in enumerate(CUSTOMER)}
    rows |= {f"summary_stats/{c}/{s}": e.format(c=c) for c in NUMBERS for s, e in STATS.items()}
    rows |= {f"null_analysis/null_counts/{c}": f"count(*) - count({c})" for c in CUSTOMER}
    rows |= {f"null_analysis/null_percentages/{c}": f"round_even((count(*) - count({c})) * 100.0 / count(*), 2)" for c in CUSTOMER}
    rows |= {"null_analysis/total_null_values": " + ".join(f"count(*) - count({c})" for c in CUSTOMER)}
    rows |= {f"data_types/{c}": f"'{kind}'" for c, kind in CUSTOMER.items()}
    rows |= {f"correlations/{a}/{b}": f"corr({a}, {b})" for a in NUMBERS for b in NUMBERS}
    rows |= {"duplicates/duplicate_rows": COPIES, "duplicates/duplicate_percentage": f"round_even({COPIES} * 100.0 / count(*), 2)", "duplicates/unique_rows": f"count(*) - {COPIES}"}
    for c in NUMBERS:
        low, high = FENCE.format(c=c, p=0.25, s="-"), FENCE.format(c=c, p=0.75, s="+")
        out = f"count(*) FILTER (WHERE {c} < {low} OR {c} > {high})"
        rows |= {f"outliers/{c}/outlier_count": out, f"outliers/{c}/outlier_percentage": f"round_even({out} * 100.0 / count(*), 2)", f"outliers/{c}/lower_bound": f"any_value({low})", f"outliers/{c}/upper_bound": f"any_value({high})"}
    sql = _sql(rows, "customer")
    for part, order in (("head", "c_custkey"), ("tail", "c_custkey DESC")):
        place = "row_number() OVER (ORDER BY c_custkey) - 1"
        for c, kind in CUSTOMER.items():
            cell = f"NULL::DOUBLE, {c}" if kind == "object" else f"round({c}::DOUBLE, 6), NULL"
            sql += f" UNION ALL SELECT 'sample_data/{part}/' || ({place}) || '/{c}', {cell} FROM (SELECT * FROM customer ORDER BY {order} LIMIT 4)"
    return sql


@query(_inspected())
def inspection_whole(t):
    """Every section of a profile, samples and types included."""
    config = {"include_correlations": True, "include_outliers": True, "order_by": "c_custkey", "sample_size": 4}
    return _frame(t, inspect(t.customer, config))


SCORES = """s AS (SELECT 100 - nulls * 100.0 / (n * 5) AS completeness, 100 - (n - uniq) * 100.0 / n AS uniqueness,
    100 - (low + high + bad) * 100.0 / (n * 5) AS validity, nulls = 0 AS complete, cons = 0 AS consistent, * FROM n)"""
QUALITY = {
    "overall_score": "round_even(complete::INT * 20.0 + consistent::INT * 20.0, 2)",
    "checks_passed": "complete::INT + consistent::INT",
    "checks_failed": "5 - complete::INT - consistent::INT",
    "completeness/score": "completeness",
    "uniqueness/score": "uniqueness",
    "uniqueness/duplicate_count": "n - uniq",
    "uniqueness/duplicate_percentage": "round_even((n - uniq) * 100.0 / n, 2)",
    "validity/score": "validity",
    "validity/invalid_count": "low + high + bad",
    "validity/invalid_percentage": "round_even((low + high + bad) * 100.0 / (n * 5), 2)",
    "consistency/score": "CASE WHEN consistent THEN 100 ELSE 50 END",
    "accuracy/score": "50",
    "completeness/null_percentages/status": "round_even(nulls * 100.0 / n, 2)",
    **{f"completeness/null_percentages/{c}": "0" for c in ("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")},
}
ISSUES = [
    ("nulls * 100.0 / (n * 5) > 5", "'Table holds ' || nulls || ' null cells, above 5.0% of all cells'"),
    ("nulls > 0", "'Required column ''status'' is null in ' || nulls || ' rows (' || {nulls} || '%)'"),
    ("round_even(nulls * 100.0 / n, 2) > 5", "'Column ''status'' is null in ' || {nulls} || '% of rows, above 5.0%'"),
    ("custs < n", "'Column ''o_custkey'' must be unique but holds ' || (n - custs) || ' duplicate values (' || {custs} || '%)'"),
    ("low > 0", "'Column ''o_totalprice'' is below 1000 in ' || low || ' rows'"),
    ("high > 0", "'Column ''o_totalprice'' is above 450000 in ' || high || ' rows'"),
    ("bad > 0", "'Column ''status'' holds ' || bad || ' values that are not allowed'"),
    ("true", "'Column ''o_custkey'' is not of type float'"),
    ("cons > 0", "'Consistency rule ''price by status'' fails in ' || cons || ' rows'"),
    ("dates > 0", "'Accuracy rule ''order dates'' fails in ' || dates || ' rows'"),
]
_SHARES = {"nulls": "round_even(nulls * 100.0 / n, 2)::DOUBLE", "custs": "round_even((n - custs) * 100.0 / n, 2)::DOUBLE"}


QUALITY_SQL = (
    f"WITH {ORDERS}, {SCORES} "
    + _sql(QUALITY, "s")
    + " UNION ALL "
    + " UNION ALL ".join(f"SELECT 'issue', NULL, {text.format(**_SHARES)} FROM s WHERE {cond}" for cond, text in ISSUES)
    + " UNION ALL SELECT 'passed/' || unnest(['completeness', 'uniqueness', 'validity', 'consistency', 'accuracy']), unnest([complete::INT, 0, 0, consistent::INT, 0]), NULL FROM s"
)


@query(QUALITY_SQL)
def quality_whole(t):
    """Scores, counts and issues of every family; the wording of the rule that cannot be evaluated is Spark's."""
    return _judged(t, check_quality(_orders(t), RULES))


def _judged(t, found):
    families = found.pop("detailed_results")
    issues, rows = found.pop("issues"), {k: found[k] for k in ("overall_score", "checks_passed", "checks_failed")}
    rows |= {f"{f}/{k}": v for f, d in families.items() for k, v in d.items() if k not in ("passed", "issues")}
    rows |= {f"passed/{f}": d["passed"] for f, d in families.items()}
    return t.spark.createDataFrame(tidy(rows) + [("issue", None, i) for i in issues if "'broken'" not in i], SCHEMA)


@query(QUALITY_SQL)
def stream_quality_scores(t):
    """The same from the counts of three batches of a stream."""
    folder, uri = scratch_uri(t.spark, "incoming"), scratch_uri(t.spark, "counts")
    orders = _orders(t)
    files = 1 + orders.count() // (3 * FILE_ROWS)  # of a batch
    orders.repartition(3 * files, "o_orderkey").write.parquet(folder)
    stream = read_stream(t.spark, folder, orders.schema, max_files=files)
    write_quality(stream, RULES, uri).awaitTermination()
    return _judged(t, running_quality(t.spark, uri, orders.schema, RULES))


ORDER_BYTES = "round((SELECT sum(8 + 8 + coalesce(strlen(status), 0) + 8 + 8) FROM o) / 1048576.0, 2)"


@query(
    f"WITH {ORDERS}, {SCORES} "
    + _sql(
        {
            "metadata/dataset_name": "'orders'",
            "metadata/report_version": "'1.0'",
            "dataset_overview/total_rows": "n",
            "dataset_overview/total_columns": "5",
            "dataset_overview/memory_usage_mb": ORDER_BYTES,
            "dataset_overview/column_types/int64": "2",
            "dataset_overview/column_types/object": "1",
            "dataset_overview/column_types/float64": "1",
            "dataset_overview/column_types/datetime64[ns]": "1",
            "dataset_overview/numeric_columns/0": "'o_orderkey'",
            "dataset_overview/numeric_columns/1": "'o_custkey'",
            "dataset_overview/numeric_columns/2": "'o_totalprice'",
            "dataset_overview/categorical_columns/0": "'status'",
            "dataset_overview/datetime_columns/0": "'o_orderdate'",
            "executive_summary/dataset_size": "TEXT format('{:,}', n) || ' rows × 5 columns'",
            "executive_summary/memory_footprint": f"TEXT printf('%.1f MB', {ORDER_BYTES})",
            "executive_summary/quality_score": "TEXT printf('%.1f%%', round(complete::INT * 50.0, 2))",
            "executive_summary/quality_status": "'Critical'",
            "executive_summary/critical_issues": "(nulls > 0)::INT",
            "executive_summary/high_priority_recommendations": "1",
        },
        "s",
    )
    + """ UNION ALL SELECT unnest(['Optimization/Low', 'Quality/High', 'Completeness/Medium', 'Completeness/Medium', 'Uniqueness/Medium', 'Completeness/Medium']), NULL,
        unnest(['Column ''status'' has few distinct values (' || printf('%.2f%%', (SELECT count(DISTINCT status) FROM o) * 100.0 / n) || '); a lookup code would be smaller.',
        'The quality score is low (0.0%); settle the issues before using the data.',
        'Fill or remove missing values: Required column ''status'' is null in ' || nulls || ' rows (' || round_even(nulls * 100.0 / n, 2)::DOUBLE || '%)',
        'Fill or remove missing values: Column ''status'' is null in ' || round_even(nulls * 100.0 / n, 2)::DOUBLE || '% of rows, above 1.0%',
        'Look into the duplicates: Column ''o_custkey'' must be unique but holds ' || (n - custs) || ' duplicate values (' || round_even((n - custs) * 100.0 / n, 2)::DOUBLE || '%)',
        'Columns with null values: status.']) FROM s"""
)
def report_whole(t):
    """Overview, advice of every kind that the table gives rise to, and the summary, after a trip through a stored report."""
    rules = {f: {"enabled": False} for f in ("validity", "consistency", "accuracy")}
    rules |= {"completeness": {"max_null_percentage": 1.0, "required_columns": ["status"]}, "uniqueness": {"unique_columns": ["o_custkey"]}}
    uri = scratch_uri(t.spark, "report")
    quality = check_quality(_orders(t), rules)
    quality["issues"] = [i for i in quality["issues"] if "null cells" not in i]
    quality["failed_rules"] = [r for r in quality["failed_rules"] if r["rule"] != "overall_nulls"]
    save_report(t.spark, build_report(_orders(t), quality=quality, config={"dataset_name": "orders"}), uri)
    report = json.loads(t.spark.read.text(uri, wholetext=True).first()[0])
    report["metadata"].pop("report_timestamp")
    rows = tidy({k: report[k] for k in ("metadata", "dataset_overview", "executive_summary")})
    return t.spark.createDataFrame(rows + [(f"{r['category']}/{r['priority']}", None, r["recommendation"]) for r in report["recommendations"]], SCHEMA)


@query("""SELECT 'The table holds ' || printf('%.1f', count(*) * 1000 / 1.0 * (8 + 8 + 4 + 8) / 1048576) || ' MB; partition it by a column that queries filter on.' AS text
    FROM lineitem""")
def size_advice(t):
    """The advice for large tables: the facts of one a thousand times as long."""
    df = t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
    facts = gather(df, [])
    found = recommendations(df, replace(facts, bytes=facts.bytes * 1000))
    return t.spark.createDataFrame([(r["recommendation"],) for r in found if r["category"] == "Performance"], "text string")


@query("""SELECT 'inspection' AS key, count(*)::DOUBLE AS number FROM customer
    UNION ALL SELECT 'quality', 5 - 2.0 * (count(*) > (SELECT count(*) FROM (SELECT DISTINCT * FROM customer)))::INT FROM customer
    UNION ALL SELECT 'report', count(*) FROM customer UNION ALL SELECT 'stored', count(*) FROM customer
    UNION ALL SELECT 'columns with statistics', 2 UNION ALL SELECT 'disabled', 1""")
def analysis_whole(t):
    """Profile, rules and report in one step, the report stored and read back."""
    uri = scratch_uri(t.spark, "report")
    found = analyze(t.customer, {"reporting": {"output_path": uri}})
    stored = json.loads(t.spark.read.text(uri, wholetext=True).first()[0])
    rows = {
        "inspection": found["inspection"]["basic_info"]["rows"],
        "quality": found["quality"]["checks_passed"],
        "report": found["report"]["dataset_overview"]["total_rows"],
        "stored": stored["dataset_overview"]["total_rows"],
        "columns with statistics": len(found["inspection"]["summary_stats"]) * (list(found["inspection"]["summary_stats"]) == numeric_columns(t.customer)),
        "disabled": analyze(t.customer, {"enabled": False}) is None,
    }
    return _frame(t, rows).select("key", "number")


_PARTS = """SELECT '{where}' AS place, c_custkey, c_name, c_nationkey::BIGINT AS c_nationkey, c_acctbal, c_mktsegment FROM customer"""


@query(" UNION ALL ".join(_PARTS.format(where=w) for w in ("csv", "other suffix", "json", "parquet")))
def objects_by_suffix(t):
    """One table through every format that a suffix stands for."""
    found = None
    for suffix, place in ((".csv", "csv"), (".dat", "other suffix"), (".json", "json"), (".parquet", "parquet")):
        uri = scratch_uri(t.spark, "customer") + suffix
        write_object(t.customer, uri)
        rows = read_object(t.spark, uri).select(F.lit(place).alias("place"), *[F.col(c) for c in t.customer.columns])
        rows = rows.withColumn("c_nationkey", F.col("c_nationkey").cast("bigint"))
        found = rows if found is None else found.unionByName(rows)
    return found


@query("""SELECT r_regionkey::BIGINT AS r_regionkey, r_name, CASE WHEN r_regionkey % 2 = 0 THEN 'even' END AS note FROM region
    UNION ALL SELECT n_nationkey::BIGINT, n_name, 'one record' FROM nation WHERE n_nationkey = 7""")
def rows_to_table(t):
    """Records with absent fields, and a single record, through a sink and back."""
    records = [{"r_regionkey": r["r_regionkey"], "r_name": r["r_name"]} | ({"note": "even"} if r["r_regionkey"] % 2 == 0 else {}) for r in t.region.collect()]
    one = t.nation.filter("n_nationkey = 7").first()
    table = from_rows(t.spark, records).unionByName(from_rows(t.spark, {"r_regionkey": one["n_nationkey"], "r_name": one["n_name"], "note": "one record"}))
    uri = scratch_uri(t.spark, "rows") + ".parquet"
    write_object(table, uri)
    return read_object(t.spark, uri).withColumn("r_regionkey", F.col("r_regionkey").cast("bigint"))


@query("""SELECT count(*)::BIGINT AS rows, sum(s_suppkey)::BIGINT AS keys, 0::BIGINT AS too_large, true AS custom_too FROM supplier""")
def record_batches(t):
    """Lists of records of at most seven, handed to a function on the executors, alone and as a configured sink."""
    spark = t.spark
    totals = [spark.sparkContext.accumulator(0) for _ in range(4)]

    def take(batch):
        totals[0].add(len(batch))
        totals[1].add(sum(r["s_suppkey"] for r in batch))
        totals[2].add(len(batch) > 7)

    write_batches(t.supplier, take, 7)
    config = {"type": "graph", "load_type": "custom", "batch_size": 3, "batch_function": lambda batch: totals[3].add(len(batch))}
    run_pipeline(spark, {"source": {"type": "s3", "uri": f"{t.folder}/supplier.parquet"}, "load": config})
    row = (totals[0].value, totals[1].value, totals[2].value, totals[3].value == totals[0].value)
    return spark.createDataFrame([row], "rows bigint, keys bigint, too_large bigint, custom_too boolean")


@query("SELECT p_brand, count(*) AS n, round(avg(p_retailprice), 4) AS price FROM part GROUP BY 1")
def sql_from_file(t):
    uri = scratch_uri(t.spark, "query") + ".sql"
    text = "SELECT p_brand, count(*) AS n,\n  round(avg(p_retailprice), 4) AS price\nFROM parts GROUP BY p_brand\n"
    t.spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(uri)
    return sql_transform(t.part, sql_file=uri, table_name="parts")


@query("""WITH s AS (SELECT count(*) AS n, count(*) FILTER (o_totalprice > 100000) AS k FROM orders) SELECT * FROM (
    SELECT unnest(['first run', 'same again', 'other configuration', 'after a reset', 'one more row', 'broken source']) AS step,
    unnest(['completed', 'skipped', 'completed', 'completed', 'completed', 'FileNotFoundError']) AS status,
    unnest([n, NULL, n, n, n + 1, NULL]) AS extracted, unnest([k, NULL, 0, k, k + 1, NULL]) AS transformed, unnest([k, NULL, 0, k, k + 1, NULL]) AS kept FROM s)""")
def pipeline_runs(t):
    """A configured run with intermediates and counts: skipped where nothing changed, made again after changes and resets."""
    spark, place = t.spark, scratch_uri(t.spark, "runs")
    folder, runs = f"{place}/in.parquet", f"{place}/ledger"
    t.orders.write.parquet(folder)
    found = []

    def run(step, least, **source):
        kept = f"{place}/kept-{len(found)}"
        config = {
            "source": {"type": "s3", "uri": folder} | source,
            "transform": {"type": "sql", "sql_query": f"SELECT * FROM source_data WHERE o_totalprice > {least}"},
            "load": {"type": "s3", "uri": f"{place}/out.parquet", "overwrite": True},
        }
        try:
            done = run_pipeline(spark, config | {"intermediates": {"transform": kept} if not found or step != "same again" else {"transform": f"{place}/kept-0"}}, runs, "orders", metrics=True)
        except FileNotFoundError as error:
            found.append((step, type(error).__name__, None, None, None))
            return
        rows = spark.read.parquet(kept).count() if done.status == "completed" else None
        found.append((step, done.status, *(done.metrics.get(s, {}).get("rows") for s in ("extract", "transform")), rows))

    run("first run", 100000)
    run("same again", 100000)
    run("other configuration", 1e12)
    ledger.reset(spark, runs, "orders")
    run("after a reset", 100000)
    t.orders.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(1).write.mode("append").parquet(folder)
    run("one more row", 100000)
    run("broken source", 100000, uri=f"{place}/nothing.parquet")
    return spark.createDataFrame(found, "step string, status string, extracted bigint, transformed bigint, kept bigint")


@query("""SELECT unnest(['sources', 'transforms', 'sinks']) AS what, unnest(['csv, graph, s3', 'aggregator, cleaner, sql', 'csv, graph, s3']) AS found, NULL::BIGINT AS rows
    UNION ALL SELECT unnest(['source', 'transform', 'load', 'no source', 'no type', 'no path', 'no group']), 'refused', count(*) FROM nation
    UNION ALL SELECT unnest(['csv', 's3', 'graph']), 'read', count(*) FROM nation
    UNION ALL SELECT 'address', 's3a://sales/raw/n.parquet', NULL UNION ALL SELECT 'settings', 'access.key endpoint.region secret.key', NULL""")
def dispatch_and_validation(t):
    """What is registered, what a configuration has to have, and each source type over the same rows."""
    spark, n = t.spark, t.nation.count()
    rows = [(what, ", ".join(sorted(r)), None) for what, r in (("sources", SOURCES), ("transforms", TRANSFORMS), ("sinks", SINKS))]
    table = {"type": "s3", "uri": f"{t.folder}/nation.parquet"}
    wrong = {
        "source": {"source": {"type": "ftp"}},
        "transform": {"source": table, "transform": {"type": "spin"}},
        "load": {"source": table, "load": {"type": "tape"}},
        "no source": {"transform": {"type": "sql"}},
        "no type": {"source": {"path": "x"}},
        "no path": {"source": {"type": "csv"}},
        "no group": {"source": table, "transform": {"type": "aggregator", "aggregations": {"n_name": "count"}}},
    }
    for what, config in wrong.items():
        try:
            run_pipeline(spark, config)
            rows.append((what, "accepted", n))
        except ValueError:
            rows.append((what, "refused", n))
    csv = scratch_uri(spark, "nation") + ".csv"
    write_csv(t.nation, csv)
    for config in ({"type": "csv", "path": csv}, table, {"type": "graph", "nodes": f"{t.folder}/nation.parquet"}):
        rows.append((config["type"], "read", run_pipeline(spark, {"source": config}).data.count()))
    store = {"bucket": "sales", "key": "raw/n.parquet", "access_key": "a", "secret_key": "b", "region": "r"}
    rows.append(("address", object_uri(store), None))
    rows.append(("settings", " ".join(sorted(k.removeprefix("fs.s3a.bucket.sales.") for k in object_settings(store))), None))
    return spark.createDataFrame(rows, "what string, found string, rows bigint")
