from pyspark.sql import functions as F

from tablewright.operators.sqlops import sql_transform
from tablewright.operators.windows import group_head
from tablewright.operators.clean import (
    clean,
    convert_types,
    dedup,
    dedup_and_filter,
    drop_missing,
    fill_mean,
    fill_missing,
    fill_mode,
    filter_rows,
    remove_outliers,
    standardize_columns,
)

from .registry import query


def _gappy(t):
    """orders with missing values in a text and a number column."""
    return t.orders.select(
        "o_orderkey",
        F.nullif("o_orderstatus", F.lit("P")).alias("status"),
        F.when(F.col("o_orderkey") % 7 != 0, F.col("o_totalprice")).alias("price"),
    )


GAPPY = """(SELECT o_orderkey, nullif(o_orderstatus, 'P') AS status,
    CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice END AS price FROM orders)"""


@query("SELECT * FROM documents")
def dedup_full(t):
    """Every row twice, all columns."""
    return dedup(t.documents.unionByName(t.documents))


# NaN stands for missing: planted in every seventh row.
NAN_EVENTS = "(SELECT event_id, user_id, CASE WHEN event_id % 7 <> 0 THEN value END AS value FROM events)"


def _nan_events(t):
    planted = F.when(F.col("event_id") % 7 != 0, F.col("value")).otherwise(F.when(F.col("event_id") % 2 == 0, float("nan")))
    return t.events.select("event_id", "user_id", planted.alias("value"))


@query(f"SELECT DISTINCT user_id, value FROM {NAN_EVENTS} WHERE value > 20")
def dedup_filter_nan(t):
    return dedup_and_filter(_nan_events(t).select("user_id", "value"), {"filter_expr": "value > 20"})


@query(f"SELECT DISTINCT user_id, value FROM {NAN_EVENTS}")
def dedup_nan(t):
    return dedup(_nan_events(t).select("user_id", "value"))


@query(f"SELECT user_id, count(value) AS n, round(sum(value), 4) AS total FROM {NAN_EVENTS} GROUP BY user_id")
def sql_nan_is_null(t):
    return sql_transform(_nan_events(t), "SELECT user_id, count(value) AS n, round(sum(value), 4) AS total FROM source_data GROUP BY user_id")


@query(f"""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY user_id
    ORDER BY value DESC NULLS LAST, event_id) AS rn FROM {NAN_EVENTS}) WHERE rn <= 2""")
def group_head_nan(t):
    return group_head(_nan_events(t), "user_id", "value", 2, ascending=False)


@query("SELECT event_id, value FROM events WHERE CASE WHEN event_id % 5 <> 0 THEN value / (event_id % 5) > 3 ELSE false END")
def filter_zero_divisor(t):
    return filter_rows(t.events.select("event_id", "value"), "value / (event_id % 5) > 3")


@query("SELECT event_id, event_type FROM events")
def clean_skips_unlike_filter(t):
    """A text column taken for a number: the filter is left out and reported."""
    skipped: list[str] = []
    rows = clean(t.events.select("event_id", "event_type"), {"filter_expr": "event_type > 5"}, skipped=skipped)
    return rows.filter(F.lit(len(skipped) == 1))


@query("SELECT DISTINCT text, lang FROM documents")
def dedup_whole_text(t):
    return dedup(t.documents.select("text", "lang"))


@query("""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY
    l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag,
    l_linestatus, l_shipdate) AS rn FROM lineitem) WHERE rn = 1""")
def dedup_keep_first(t):
    return dedup(t.lineitem, "l_orderkey")


@query("""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type
    ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1""")
def dedup_first_in_time(t):
    return dedup(t.events, ["user_id", "event_type"], order_by=["ts", "event_id"])


@query(f"SELECT * FROM {GAPPY} WHERE status IS NOT NULL AND price IS NOT NULL")
def drop_missing_rows(t):
    return drop_missing(_gappy(t))


@query(f"SELECT o_orderkey, coalesce(status, 'Unknown') AS status, coalesce(price, 0.5) AS price FROM {GAPPY}")
def fill_map(t):
    return fill_missing(_gappy(t), {"status": "Unknown", "price": 0.5, "absent": 1})


@query(f"""SELECT o_orderkey, status,
    round(coalesce(price, (SELECT avg(price) FROM {GAPPY})), 4) AS price FROM {GAPPY}""")
def fill_with_mean(t):
    return fill_mean(_gappy(t), ["price"]).withColumn("price", F.round("price", 4))


@query(f"""SELECT o_orderkey, coalesce(status, (SELECT status FROM {GAPPY} WHERE status IS NOT NULL
    GROUP BY status ORDER BY count(*) DESC, status LIMIT 1)) AS status, price FROM {GAPPY}""")
def fill_with_mode(t):
    return fill_mode(_gappy(t), ["status"])


@query("""SELECT o_orderkey, o_totalprice, o_orderdate FROM orders
    WHERE o_totalprice > 100000 AND o_orderdate >= '1997-01-01' AND o_orderstatus IN ('O', 'F')""")
def filter_by_condition(t):
    cond = "o_totalprice > 100000 and o_orderdate >= '1997-01-01' and o_orderstatus in ('O', 'F')"
    return filter_rows(t.orders, cond).select("o_orderkey", "o_totalprice", "o_orderdate")


@query("SELECT count(*) AS n FROM orders")
def filter_skipped_when_invalid(t):
    kept = filter_rows(t.orders, "no_such_column > 1", on_error="skip")
    return kept.agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT p_partkey, CAST(p_size AS DOUBLE) AS p_size, CAST(p_retailprice * 0 + p_size AS BIGINT) AS whole,
    CAST(replace(p_brand, 'Brand#', '') AS BIGINT) AS brand_no, p_name FROM part""")
def convert_column_types(t):
    parts = t.part.select(
        "p_partkey",
        "p_size",
        (F.col("p_retailprice") * 0 + F.col("p_size")).alias("whole"),
        F.replace("p_brand", F.lit("Brand#"), F.lit("")).alias("brand_no"),
        "p_name",
    )
    # p_name holds words: its cast fails and the column stays as it is.
    return convert_types(
        parts, {"p_size": "float64", "whole": "int64", "brand_no": "int64", "p_name": "float64", "absent": "int64"}
    )


@query("SELECT c_custkey AS customer_key, c_name AS name, c_acctbal AS acctbal_usd FROM customer")
def standardize_names(t):
    raw = t.customer.select("c_custkey", "c_name", "c_acctbal").toDF("Customer Key", "NAME!", "Acct-Bal (USD)")
    return standardize_columns(raw.withColumnRenamed("Acct-Bal (USD)", "Acctbal (USD)"))


@query("""WITH q AS (SELECT quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.75) AS b FROM events)
    SELECT event_id, value FROM events, q WHERE value BETWEEN a - 1.5 * (b - a) AND b + 1.5 * (b - a)""")
def remove_value_outliers(t):
    return remove_outliers(t.events.select("event_id", "value"), ["value"])


@query("""WITH q AS (SELECT quantile_cont(l_extendedprice, 0.25) AS a, quantile_cont(l_extendedprice, 0.75) AS b
        FROM lineitem),
    s AS (SELECT l_orderkey, l_extendedprice, l_quantity FROM lineitem, q
        WHERE l_extendedprice BETWEEN a - 0.2 * (b - a) AND b + 0.2 * (b - a)),
    q2 AS (SELECT quantile_cont(l_quantity, 0.25) AS a, quantile_cont(l_quantity, 0.75) AS b FROM s)
    SELECT s.* FROM s, q2 WHERE l_quantity BETWEEN a - 0.2 * (b - a) AND b + 0.2 * (b - a)""")
def remove_outliers_in_sequence(t):
    rows = t.lineitem.select("l_orderkey", "l_extendedprice", "l_quantity")
    return remove_outliers(rows, ["l_extendedprice", "l_quantity"], k=0.2)


@query("""WITH d AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type
        ORDER BY event_id, ts, value, props) AS rn FROM events) WHERE rn = 1),
    f AS (SELECT event_id, ts, user_id, event_type AS kind, value, props FROM d WHERE value > 0.5),
    q AS (SELECT quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.75) AS b FROM f)
    SELECT event_id, ts, CAST(user_id AS DOUBLE) AS user_id, kind, value, props
    FROM f, q WHERE value BETWEEN a - 1.5 * (b - a) AND b + 1.5 * (b - a)""")
def clean_events(t):
    raw = t.events.withColumnRenamed("event_type", "Kind")
    return clean(
        raw,
        {
            "dedup_cols": ["user_id", "Kind"],
            "filter_expr": "value > 0.5",
            "dtype_conversions": {"user_id": "float64"},
            "remove_outliers": True,
            "outlier_cols": ["value"],
        },
    )


@query("""SELECT lang, source, n_chars FROM documents WHERE n_chars > 500 GROUP BY ALL""")
def dedup_then_filter(t):
    return dedup_and_filter(t.documents.select("lang", "source", "n_chars"), {"filter_expr": "n_chars > 500"})


# One condition per form a filter can take, all on one table.
FORMS = {
    "equal": "o_orderstatus == 'F'",
    "different": "NOT (o_orderstatus <=> 'F')",
    "both": "o_totalprice > 50000 and `o_orderstatus` = 'O' or not o_custkey >= 10",
    "arithmetic": "power(o_custkey, 2) % 7 = 1 and floor(o_totalprice / 1000) > 100 and abs(o_custkey - 20) < 15",
    "listed": "o_orderstatus in ('O', 'F') and o_orderpriority not in ('1-URGENT', '5-LOW')",
    "chained": "o_totalprice > 1000 and o_totalprice < 90000",
    "negated": "not (o_totalprice > 1000 and o_totalprice < 90000)",
    "dated": "o_orderdate >= '1996-01-01' and o_orderdate <= '1998-12-31'",
    "methods": "o_orderstatus is not null and o_totalprice between 2000 and 60000 and o_orderpriority like '%-H%'",
}
FORMS_SQL = {
    **FORMS,
    "different": "o_orderstatus IS DISTINCT FROM 'F'",
    "both": "o_totalprice > 50000 and o_orderstatus = 'O' or not o_custkey >= 10",
    "arithmetic": "power(o_custkey, 2) % 7 = 1 and floor(o_totalprice / 1000) > 100 and abs(o_custkey - 20) < 15",
}


@query(" UNION ALL ".join(f"SELECT '{n}' AS form, o_orderkey FROM orders WHERE {c}" for n, c in FORMS_SQL.items()))
def filter_forms(t):
    kept = [filter_rows(t.orders, c).select(F.lit(n).alias("form"), "o_orderkey") for n, c in FORMS.items()]
    result = kept[0]
    for more in kept[1:]:
        result = result.unionByName(more)
    return result


HELPERS = ("_place", "_rn", "_at", "_slice", "_slot", "_rows")


@query("""SELECT o_orderkey, o_custkey, o_totalprice, 1 AS _place, 2 AS _rn, 3 AS _at, 4 AS _slice, 5 AS _slot, 6 AS _rows FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) <= 1""")
def dedup_taken_names(t):
    """Columns named like the helpers of the operators stay as they are."""
    named = t.orders.select("o_orderkey", "o_custkey", "o_totalprice", *[F.lit(i).alias(n) for i, n in enumerate(HELPERS, 1)])
    first = dedup(named, ["o_custkey"], ["o_orderkey"])
    return group_head(first, ["o_custkey"], ["o_orderkey"], 1)


@query("""SELECT count(*) AS rows, true AS refused, count(*) FILTER (c_mktsegment = 'BUILDING') AS building FROM customer""")
def dedup_filter_unlike(t):
    """A filter that takes text for numbers is refused; one over text is not."""
    try:
        dedup_and_filter(t.customer, {"filter_expr": "c_name > 5"})
        refused = False
    except ValueError:
        refused = True
    kept = dedup_and_filter(t.customer, {"filter_expr": "c_mktsegment = 'BUILDING'"}).agg(F.count(F.lit(1)).alias("building"))
    return t.customer.agg(F.count(F.lit(1)).alias("rows"), F.lit(refused).alias("refused")).crossJoin(kept)


@query("SELECT o_orderkey, o_totalprice / nullif(o_custkey % 3, 0) AS share FROM orders")
def sql_zero_divisor(t):
    return sql_transform(t.orders, "SELECT o_orderkey, o_totalprice / (o_custkey % 3) AS share FROM source_data")
