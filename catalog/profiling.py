from pyspark.sql import functions as F

from tablewright.operators.profile import (
    correlations,
    duplicates,
    inspect,
    null_analysis,
    outlier_counts,
    profile_table,
    sample,
)
from tablewright.operators.report import build_report, low_cardinality, quality_status

from .registry import query


@query("""WITH g AS (SELECT event_id, nullif(event_type, 'view') AS event_type, CASE WHEN value > 1 THEN value END AS value
        FROM events),
    n AS (SELECT count(*) AS n, count(event_type) AS a, count(value) AS b FROM g)
    SELECT 'event_id' AS "column", 0 AS null_count, 0.0 AS null_percentage FROM n
    UNION ALL SELECT 'event_type', n - a, round_even((n - a) * 100.0 / n, 2) FROM n
    UNION ALL SELECT 'value', n - b, round_even((n - b) * 100.0 / n, 2) FROM n""")
def nulls_by_column(t):
    gappy = t.events.select(
        "event_id",
        F.nullif("event_type", F.lit("view")).alias("event_type"),
        F.when(F.col("value") > 1, F.col("value")).alias("value"),
    )
    return null_analysis(gappy)


DUPLICATES_SQL = """SELECT count(*) AS rows, count(*) - (SELECT count(*) FROM (SELECT DISTINCT {cols} FROM {table})) AS duplicate_rows,
    round_even((count(*) - (SELECT count(*) FROM (SELECT DISTINCT {cols} FROM {table}))) * 100.0 / count(*), 2) AS duplicate_percentage,
    (SELECT count(*) FROM (SELECT DISTINCT {cols} FROM {table})) AS unique_rows FROM {table}"""


@query(DUPLICATES_SQL.format(cols="text, lang, source, n_chars", table="documents"))
def duplicate_documents(t):
    return duplicates(t.documents.select("text", "lang", "source", "n_chars"))


@query(DUPLICATES_SQL.format(cols="l_orderkey, l_linenumber", table="lineitem"))
def duplicate_keys(t):
    return duplicates(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(DUPLICATES_SQL.format(cols="text, lang", table="documents"))
def duplicate_documents_by_fingerprint(t):
    return duplicates(t.documents, ["text", "lang"], method="fingerprint")


CORRELATED = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query(
    " UNION ALL ".join(
        f"SELECT '{a}' AS column_a, '{b}' AS column_b, round(corr({a}, {b}), 8) AS correlation FROM lineitem"
        for a in CORRELATED
        for b in CORRELATED
    )
)
def correlation_matrix(t):
    return correlations(t.lineitem, list(CORRELATED)).withColumn("correlation", F.round("correlation", 8))


OUTLIER_SQL = """SELECT '{c}' AS "column", count(*) FILTER (WHERE {c} < a - 1.5 * (b - a) OR {c} > b + 1.5 * (b - a)) AS outlier_count,
    round_even(count(*) FILTER (WHERE {c} < a - 1.5 * (b - a) OR {c} > b + 1.5 * (b - a)) * 100.0 / count(*), 2) AS outlier_percentage,
    round(min(a - 1.5 * (b - a)), 4) AS lower_bound, round(min(b + 1.5 * (b - a)), 4) AS upper_bound
    FROM events, (SELECT quantile_cont({c}, 0.25) AS a, quantile_cont({c}, 0.75) AS b FROM events)"""


@query(" UNION ALL ".join(OUTLIER_SQL.format(c=c) for c in ("event_id", "user_id", "value")))
def outliers_by_column(t):
    result = outlier_counts(t.events)
    return result.withColumns({c: F.round(c, 4) for c in ("lower_bound", "upper_bound")})


@query("""SELECT 'head' AS part, * FROM (SELECT * FROM orders ORDER BY o_orderkey LIMIT 5)
    UNION ALL SELECT 'tail', * FROM (SELECT * FROM orders ORDER BY o_orderkey DESC LIMIT 5)""")
def sample_rows(t):
    head, tail = sample(t.orders, 5, "o_orderkey")
    part = F.lit
    return head.select(part("head").alias("part"), "*").unionByName(tail.select(part("tail").alias("part"), "*"))


_PROFILE = {
    "null_count": "count(*) - count({c})",
    "count": "count({c})",
    "mean": "avg({c})",
    "std": "stddev_samp({c})",
    "min": "min({c})",
    "p25": "quantile_cont({c}, 0.25)",
    "p50": "quantile_cont({c}, 0.5)",
    "p75": "quantile_cont({c}, 0.75)",
    "max": "max({c})",
}


@query(
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", '{m}' AS metric, round(CAST({e.format(c=c)} AS DOUBLE), 3) AS value FROM orders"
        for c in ("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus", "o_orderdate", "o_orderpriority")
        for m, e in _PROFILE.items()
        if m == "null_count" or c in ("o_orderkey", "o_custkey", "o_totalprice")
    )
)
def profile_as_rows(t):
    return profile_table(t.orders).withColumn("value", F.round("value", 3))


@query("""SELECT count(*) AS rows, 5 AS columns,
    count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM customer)) AS duplicate_rows,
    CAST(sum(8 + strlen(c_name) + 4 + 8 + strlen(c_mktsegment)) AS BIGINT) AS bytes FROM customer""")
def inspection(t):
    found = inspect(t.customer, {"include_correlations": True, "include_outliers": True, "order_by": "c_custkey"})
    info = found["basic_info"]
    return t.spark.createDataFrame(
        [
            (
                info["rows"],
                info["columns"],
                found["duplicates"]["duplicate_rows"],
                round(info["memory_usage_mb"] * 1024 * 1024),
            )
        ],
        "rows bigint, columns int, duplicate_rows bigint, bytes bigint",
    )


@query("""SELECT * FROM (
    SELECT 'o_orderstatus' AS "column", count(DISTINCT o_orderstatus) AS distinct_values,
        count(DISTINCT o_orderstatus) * 1.0 / count(*) AS ratio FROM orders
    UNION ALL SELECT 'o_orderpriority', count(DISTINCT o_orderpriority), count(DISTINCT o_orderpriority) * 1.0 / count(*) FROM orders)
    WHERE ratio < 0.5""")
def low_cardinality_columns(t):
    return low_cardinality(t.orders)


@query("""SELECT c_nationkey, round(100.0 * count(*) FILTER (WHERE c_acctbal > 0) / count(*), 6) AS score,
    CASE WHEN 100.0 * count(*) FILTER (WHERE c_acctbal > 0) / count(*) >= 90 THEN 'Excellent'
         WHEN 100.0 * count(*) FILTER (WHERE c_acctbal > 0) / count(*) >= 80 THEN 'Good'
         WHEN 100.0 * count(*) FILTER (WHERE c_acctbal > 0) / count(*) >= 70 THEN 'Fair'
         WHEN 100.0 * count(*) FILTER (WHERE c_acctbal > 0) / count(*) >= 60 THEN 'Poor' ELSE 'Critical' END AS status
    FROM customer GROUP BY 1""")
def status_bands(t):
    scores = t.customer.groupBy("c_nationkey").agg(
        (F.count_if(F.col("c_acctbal") > 0) * 100.0 / F.count(F.lit(1))).alias("score")
    )
    return scores.select("c_nationkey", F.round("score", 6).alias("score"), quality_status(F.col("score")).alias("status"))


@query("""SELECT count(*) AS total_rows, 6 AS total_columns, 2 AS low_cardinality_advice FROM orders""")
def report_of_orders(t):
    report = build_report(t.orders)
    size = report["dataset_overview"]
    advice = sum(r["category"] == "Optimization" for r in report["recommendations"])
    return t.spark.createDataFrame(
        [(size["total_rows"], size["total_columns"], advice)],
        "total_rows bigint, total_columns int, low_cardinality_advice int",
    )
