from pyspark.sql import functions as F

from tablewright.operators.quality import check_quality, quality_table, split_violations, tag_violations

from .registry import query

RULES = {
    "completeness": {"max_null_percentage": 5.0, "required_columns": ["status", "o_custkey"]},
    "uniqueness": {"max_duplicate_percentage": 1.0, "unique_columns": ["o_orderkey", "o_custkey"]},
    "validity": {
        "column_rules": {
            "o_totalprice": {"type": "float", "min_value": 1000, "max_value": 450000},
            "o_orderdate": {"type": "datetime"},
            "status": {"allowed_values": ["O", "F"]},
            "o_custkey": {"type": "float"},
        }
    },
    "consistency": {
        "cross_column_rules": [
            {
                "name": "price by status",
                "columns": ["status", "o_totalprice"],
                "condition": "status == 'O' or o_totalprice < 200000",
            }
        ]
    },
    "accuracy": {
        "business_rules": [
            {"name": "order dates", "condition": "o_orderdate >= '1995-01-01' and o_orderdate <= '2000-12-31'"},
            {"name": "broken", "condition": "no_such_column > 1"},
        ]
    },
}


def _orders(t):
    return t.orders.select(
        "o_orderkey",
        "o_custkey",
        F.nullif("o_orderstatus", F.lit("P")).alias("status"),
        "o_totalprice",
        "o_orderdate",
    )


ORDERS = """o AS (SELECT o_orderkey, o_custkey, nullif(o_orderstatus, 'P') AS status, o_totalprice, o_orderdate FROM orders),
    n AS (SELECT count(*) AS n, count(*) - count(status) AS nulls, count(DISTINCT o_custkey) AS custs,
        count(DISTINCT o_orderkey) AS keys,
        (SELECT count(*) FROM (SELECT DISTINCT * FROM o)) AS uniq,
        count(*) FILTER (WHERE o_totalprice < 1000) AS low, count(*) FILTER (WHERE o_totalprice > 450000) AS high,
        count(*) FILTER (WHERE status IS NULL OR status NOT IN ('O', 'F')) AS bad,
        count(*) FILTER (WHERE NOT coalesce(status = 'O' OR o_totalprice < 200000, false)) AS cons,
        count(*) FILTER (WHERE NOT coalesce(o_orderdate >= '1995-01-01' AND o_orderdate <= '2000-12-31', false)) AS dates
        FROM o)"""


@query(f"""WITH {ORDERS} SELECT * FROM (
    SELECT 'completeness' AS family, 'overall_nulls' AS rule, '*' AS target, nulls AS violations, nulls * 100.0 / (n * 5) <= 5 AS passed FROM n
    UNION ALL SELECT 'completeness', 'required', 'status', nulls, nulls = 0 FROM n
    UNION ALL SELECT 'completeness', 'required', 'o_custkey', 0, true FROM n
    UNION ALL SELECT 'completeness', 'column_nulls', unnest(['o_orderkey', 'o_custkey', 'o_totalprice', 'o_orderdate']), 0, true FROM n
    UNION ALL SELECT 'completeness', 'column_nulls', 'status', nulls, round_even(nulls * 100.0 / n, 2) <= 5 FROM n
    UNION ALL SELECT 'uniqueness', 'duplicate_rows', '*', n - uniq, (n - uniq) * 100.0 / n <= 1 FROM n
    UNION ALL SELECT 'uniqueness', 'unique_column', 'o_orderkey', n - keys, n = keys FROM n
    UNION ALL SELECT 'uniqueness', 'unique_column', 'o_custkey', n - custs, n = custs FROM n
    UNION ALL SELECT 'validity', 'type', unnest(['o_totalprice', 'o_orderdate']), 0, true FROM n
    UNION ALL SELECT 'validity', 'type', 'o_custkey', 0, false FROM n
    UNION ALL SELECT 'validity', 'min_value', 'o_totalprice', low, low = 0 FROM n
    UNION ALL SELECT 'validity', 'max_value', 'o_totalprice', high, high = 0 FROM n
    UNION ALL SELECT 'validity', 'allowed_values', 'status', bad, bad = 0 FROM n
    UNION ALL SELECT 'consistency', 'condition', 'price by status', cons, cons = 0 FROM n
    UNION ALL SELECT 'accuracy', 'condition', 'order dates', dates, dates = 0 FROM n
    UNION ALL SELECT 'accuracy', 'condition', 'broken', NULL, false FROM n)""")
def quality_rules(t):
    table = quality_table(_orders(t), RULES)
    return table.select("family", "rule", "target", "violations", "passed")


@query(f"""WITH {ORDERS} SELECT 'completeness' AS family, round(100 - nulls * 100.0 / (n * 5), 6) AS score, nulls = 0 AS passed FROM n
    UNION ALL SELECT 'uniqueness', round(100 - (n - uniq) * 100.0 / n, 6), (n - uniq) * 100.0 / n <= 1 AND n = keys AND n = custs FROM n
    UNION ALL SELECT 'validity', round(100 - (low + high + bad) * 100.0 / (n * 5), 6), false FROM n
    UNION ALL SELECT 'consistency', CASE WHEN cons = 0 THEN 100.0 ELSE 50.0 END, cons = 0 FROM n
    UNION ALL SELECT 'accuracy', 50.0, false FROM n""")
def quality_scores(t):
    found = check_quality(_orders(t), RULES)
    rows = [(f, round(float(d["score"]), 6), d["passed"]) for f, d in found["detailed_results"].items()]
    return t.spark.createDataFrame(rows, "family string, score double, passed boolean")


@query(f"""WITH {ORDERS} SELECT o_orderkey, concat_ws('|',
        CASE WHEN status IS NULL THEN 'status:required' END,
        CASE WHEN o_totalprice < 1000 THEN 'o_totalprice:min_value' END,
        CASE WHEN o_totalprice > 450000 THEN 'o_totalprice:max_value' END,
        CASE WHEN status IS NULL OR status NOT IN ('O', 'F') THEN 'status:allowed_values' END,
        CASE WHEN NOT coalesce(status = 'O' OR o_totalprice < 200000, false) THEN 'price by status' END,
        CASE WHEN NOT (o_orderdate >= '1995-01-01' AND o_orderdate <= '2000-12-31') THEN 'order dates' END) AS rules FROM o""")
def violations_by_row(t):
    tagged = tag_violations(_orders(t), RULES)
    return tagged.select("o_orderkey", F.array_join("violated_rules", "|").alias("rules"))


@query(f"""WITH {ORDERS} SELECT * FROM o WHERE status IN ('O', 'F') AND o_totalprice >= 1000 AND o_totalprice <= 450000
    AND (status = 'O' OR o_totalprice < 200000) AND o_orderdate >= '1995-01-01' AND o_orderdate <= '2000-12-31'""")
def rows_without_violations(t):
    return split_violations(_orders(t), RULES)[0]


@query("""WITH e AS (SELECT event_id % 4 AS d, value, event_type FROM events)
    SELECT 'condition' AS rule, 'ratio' AS target, count(*) FILTER (WHERE d = 0 OR NOT coalesce(value / d > 1, false)) AS violations FROM e
    UNION ALL SELECT 'allowed_values', 'd', count(*) FILTER (WHERE d NOT IN (1, 2)) FROM e
    UNION ALL SELECT 'allowed_values', 'event_type', count(*) FILTER (WHERE event_type IS DISTINCT FROM 'click') FROM e""")
def quality_rules_zero_divisor(t):
    """A division by zero violates its row only; allowed values of another type match nothing."""
    rules = {
        "completeness": {"enabled": False},
        "uniqueness": {"enabled": False},
        "validity": {"column_rules": {"d": {"allowed_values": [1, 2, "many"]}, "event_type": {"allowed_values": ["click", 3]}}},
        "consistency": {"cross_column_rules": [{"name": "ratio", "columns": ["value", "d"], "condition": "value / d > 1"}]},
    }
    events = t.events.select((F.col("event_id") % 4).alias("d"), "value", "event_type")
    return quality_table(events, rules).select("rule", "target", "violations")


@query("""SELECT event_id, CASE WHEN event_id % 4 = 0 OR NOT coalesce(value / (event_id % 4) > 1, false) THEN 'ratio' ELSE '' END AS rules
    FROM events""")
def quarantine_zero_divisor(t):
    rules = {"accuracy": {"business_rules": [{"name": "ratio", "condition": "value / (event_id % 4) > 1"}]}}
    good, bad = split_violations(t.events.select("event_id", "value"), rules)
    marked = bad.select("event_id", F.array_join("violated_rules", "|").alias("rules"))
    return good.select("event_id", F.lit("").alias("rules")).unionByName(marked)
