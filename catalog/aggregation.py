from pyspark.sql import functions as F

from tablewright.operators.aggregate import aggregate, distinct_values, summarize
from tablewright.operators.windows import average_rank, cumulative_sum, group_head, row_index, shift

from .registry import query


def _rounded(df, digits, *names):
    return df.withColumns({n: F.round(n, digits) for n in names})


@query("""SELECT l_returnflag, l_linestatus, round(sum(l_extendedprice), 2) AS l_extendedprice_sum,
    round(avg(l_extendedprice), 4) AS l_extendedprice_mean, count(l_extendedprice) AS l_extendedprice_count,
    sum(l_quantity) AS l_quantity_sum FROM lineitem WHERE l_quantity > 0 GROUP BY 1, 2""")
def agg_basic(t):
    result = aggregate(
        t.lineitem.filter("l_quantity > 0"),
        ["l_returnflag", "l_linestatus"],
        {"l_extendedprice": ["sum", "mean", "count"], "l_quantity": "sum"},
        sort_by="l_extendedprice_sum",
        sort_ascending=False,
    )
    return _rounded(_rounded(result, 2, "l_extendedprice_sum"), 4, "l_extendedprice_mean")


@query("""SELECT l_returnflag, min(l_tax) AS l_tax_min, max(l_tax) AS l_tax_max,
    round(stddev_samp(l_extendedprice), 3) AS l_extendedprice_std,
    round(var_samp(l_quantity), 6) AS l_quantity_var,
    round(stddev_samp(l_quantity) / sqrt(count(l_quantity)), 8) AS l_quantity_sem,
    round(skewness(l_extendedprice), 6) AS l_extendedprice_skew, round(median(l_extendedprice), 3) AS l_extendedprice_median,
    quantile_cont(l_quantity, 0.5) AS l_quantity_quantile FROM lineitem GROUP BY 1""")
def agg_stats(t):
    result = aggregate(
        t.lineitem,
        "l_returnflag",
        {
            "l_tax": ["min", "max"],
            "l_extendedprice": ["std", "skew", "median"],
            "l_quantity": ["var", "sem", "quantile"],
        },
    )
    result = _rounded(result, 3, "l_extendedprice_std", "l_extendedprice_median")
    return _rounded(_rounded(result, 6, "l_quantity_var", "l_extendedprice_skew"), 8, "l_quantity_sem")


@query("""SELECT o_orderpriority, count(DISTINCT o_custkey) AS o_custkey_nunique,
    count(DISTINCT nullif(o_orderstatus, 'P')) AS status_nunique, count(*) AS status_size FROM orders GROUP BY 1""")
def agg_nunique(t):
    orders = t.orders.withColumn("status", F.nullif("o_orderstatus", F.lit("P")))
    return aggregate(orders, "o_orderpriority", {"o_custkey": "nunique", "status": ["nunique", "size"]})


@query("""SELECT o_custkey, round(sum(o_totalprice), 2) AS o_totalprice_sum, count(o_orderkey) AS o_orderkey_count
    FROM orders GROUP BY 1 HAVING sum(o_totalprice) > 1000 ORDER BY sum(o_totalprice) DESC, o_custkey LIMIT 100""")
def agg_topk(t):
    result = aggregate(
        t.orders,
        "o_custkey",
        {"o_totalprice": "sum", "o_orderkey": "count"},
        sort_by=["o_totalprice_sum"],
        sort_ascending=False,
        post_filter="o_totalprice_sum > 1000",
        limit=100,
    )
    return _rounded(result, 2, "o_totalprice_sum")


@query("""SELECT nullif(o_orderstatus, 'P') AS status, round(sum(o_totalprice), 2) AS o_totalprice_sum
    FROM orders WHERE nullif(o_orderstatus, 'P') IS NOT NULL GROUP BY 1""")
def agg_null_keys_dropped(t):
    orders = t.orders.withColumn("status", F.nullif("o_orderstatus", F.lit("P")))
    return _rounded(aggregate(orders, ["status"], {"o_totalprice": "sum"}), 2, "o_totalprice_sum")


@query("""SELECT o_orderstatus, round(coalesce(sum(CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END), 0), 2) AS price_sum,
    count(CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END) AS price_count FROM orders GROUP BY 1""")
def agg_sum_of_nothing(t):
    orders = t.orders.withColumn("price", F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")))
    return _rounded(aggregate(orders, "o_orderstatus", {"price": ["sum", "count"]}), 2, "price_sum")


@query("""SELECT o_custkey, first(o_totalprice ORDER BY o_orderdate, o_orderkey, o_totalprice) AS o_totalprice_first,
    last(o_totalprice ORDER BY o_orderdate, o_orderkey, o_totalprice) AS o_totalprice_last FROM orders GROUP BY 1""")
def agg_first_last(t):
    return aggregate(
        t.orders, "o_custkey", {"o_totalprice": ["first", "last"]}, order_by=["o_orderdate", "o_orderkey"]
    )


@query("""SELECT event_type, first(value ORDER BY ts, event_id) AS value_ohlc_open, max(value) AS value_ohlc_high,
    min(value) AS value_ohlc_low, last(value ORDER BY ts, event_id) AS value_ohlc_close FROM events GROUP BY 1""")
def agg_ohlc(t):
    return aggregate(t.events, "event_type", {"value": "ohlc"}, order_by=["ts", "event_id"])


@query("""SELECT o_custkey, product(1 + o_orderkey % 2) AS factor_prod, bool_or(o_orderkey % 3 <> 0) AS rest_any,
    bool_and(o_orderkey % 3 <> 0) AS rest_all FROM orders GROUP BY 1""")
def agg_prod_any_all(t):
    orders = t.orders.withColumns({"factor": 1 + F.col("o_orderkey") % 2, "rest": F.col("o_orderkey") % 3})
    return aggregate(orders, "o_custkey", {"factor": "prod", "rest": ["any", "all"]})


@query("""SELECT c_nationkey, string_agg(DISTINCT c_mktsegment, '|' ORDER BY c_mktsegment) AS segments
    FROM customer GROUP BY 1""")
def agg_unique(t):
    result = aggregate(t.customer, "c_nationkey", {"c_mktsegment": "unique"})
    return result.select("c_nationkey", F.array_join("c_mktsegment_unique", "|").alias("segments"))


@query("SELECT DISTINCT l_returnflag, l_partkey FROM lineitem")
def agg_unique_as_rows(t):
    return distinct_values(t.lineitem, "l_returnflag", "l_partkey")


@query("""SELECT o_custkey, first(o_orderkey ORDER BY o_totalprice, o_orderkey) AS o_totalprice_idxmin,
    first(o_orderkey ORDER BY o_totalprice DESC, o_orderkey) AS o_totalprice_idxmax FROM orders GROUP BY 1""")
def agg_row_of_extreme(t):
    return aggregate(t.orders, "o_custkey", {"o_totalprice": ["idxmin", "idxmax"]}, label="o_orderkey")


@query("""SELECT event_type, count(value) AS value_describe_count, round(avg(value), 6) AS value_describe_mean,
    round(stddev_samp(value), 6) AS value_describe_std, min(value) AS value_describe_min,
    round(quantile_cont(value, 0.25), 4) AS value_describe_p25, round(quantile_cont(value, 0.5), 4) AS value_describe_p50,
    round(quantile_cont(value, 0.75), 4) AS value_describe_p75, max(value) AS value_describe_max FROM events GROUP BY 1""")
def agg_describe(t):
    result = aggregate(t.events, "event_type", {"value": "describe"})
    result = _rounded(result, 6, "value_describe_mean", "value_describe_std")
    return _rounded(result, 4, "value_describe_p25", "value_describe_p50", "value_describe_p75")


SUMMARY_SQL = """SELECT {keys} '{c}' AS "column", count({c}) AS count, round(avg({c}), 3) AS mean,
    round(stddev_samp({c}), 3) AS std, CAST(min({c}) AS DOUBLE) AS min,
    round(quantile_cont({c}, 0.25), 3) AS p25, round(quantile_cont({c}, 0.5), 3) AS p50,
    round(quantile_cont({c}, 0.75), 3) AS p75, CAST(max({c}) AS DOUBLE) AS max FROM lineitem {group}"""
SUMMARY_COLUMNS = ("l_quantity", "l_extendedprice", "l_discount")


@query(" UNION ALL ".join(SUMMARY_SQL.format(keys="", group="", c=c) for c in SUMMARY_COLUMNS))
def summary(t):
    return _rounded(summarize(t.lineitem, list(SUMMARY_COLUMNS)), 3, "mean", "std", "p25", "p50", "p75")


@query(
    " UNION ALL ".join(
        SUMMARY_SQL.format(keys="l_returnflag, l_linestatus,", group="GROUP BY 1, 2", c=c) for c in SUMMARY_COLUMNS
    )
)
def summary_grouped(t):
    result = summarize(t.lineitem, list(SUMMARY_COLUMNS), ["l_returnflag", "l_linestatus"])
    return _rounded(result, 3, "mean", "std", "p25", "p50", "p75")


@query("""SELECT o_orderkey, o_custkey, round(sum(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
    ROWS UNBOUNDED PRECEDING), 2) AS o_totalprice_cumsum FROM orders""")
def cumulative(t):
    result = cumulative_sum(t.orders, "o_custkey", ["o_orderdate", "o_orderkey"], "o_totalprice")
    return _rounded(result.select("o_orderkey", "o_custkey", "o_totalprice_cumsum"), 2, "o_totalprice_cumsum")


@query("""SELECT event_id, rank() OVER (PARTITION BY event_type ORDER BY value)
    + (count(*) OVER (PARTITION BY event_type, value) - 1) / 2.0 AS value_rank FROM events""")
def group_rank(t):
    return average_rank(t.events.select("event_id", "event_type", "value"), "event_type", "value").select(
        "event_id", "value_rank"
    )


@query("""SELECT event_id, lag(value, 2) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS value_shift FROM events""")
def group_shift(t):
    events = t.events.select("event_id", "user_id", "ts", "value")
    return shift(events, "user_id", ["ts", "event_id"], "value", 2).select("event_id", "value_shift")


@query("""SELECT o_orderkey, o_custkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
    ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders) WHERE rn <= 3""")
def group_first_rows(t):
    orders = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    return group_head(orders, "o_custkey", ["o_totalprice", "o_orderkey"], 3, ascending=[False, True])


@query("""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_orderkey, l_partkey,
    l_suppkey, l_linenumber) AS row_index FROM lineitem""")
def group_row_index(t):
    rows = t.lineitem.select("l_returnflag", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    return row_index(rows, "l_returnflag", ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]).drop(
        "l_returnflag"
    )


@query("""SELECT o_orderstatus, count(*) FILTER (WHERE o_totalprice > 100000) AS dear_sum,
    round(avg((o_totalprice > 100000)::INT), 6) AS dear_mean FROM orders GROUP BY 1""")
def agg_boolean(t):
    rows = t.orders.select("o_orderstatus", (F.col("o_totalprice") > 100000).alias("dear"))
    return aggregate(rows, "o_orderstatus", {"dear": ["sum", "mean"]}).withColumn("dear_mean", F.round("dear_mean", 6))


@query("""SELECT o_custkey, round(sum(o_totalprice), 2) AS o_totalprice_sum, count(o_orderkey) AS o_orderkey_count FROM orders GROUP BY 1
    HAVING sum(o_totalprice) / nullif(count(o_orderkey) - 5, 0) > 100000""")
def post_filter_zero_divisor(t):
    """A group whose condition has no result is left out and ends no job."""
    config = {"o_totalprice": ["sum"], "o_orderkey": ["count"]}
    return _rounded(aggregate(t.orders, "o_custkey", config, post_filter="o_totalprice_sum / (o_orderkey_count - 5) > 100000"), 2, "o_totalprice_sum")
