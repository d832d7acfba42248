"""Spark SQL over registered tables; the oracle is the same question in the other dialect."""

from pyspark.sql import functions as F

from tablewright.functions.nulls import nan_to_null
from tablewright.operators.sqlops import apply_sql_transform, sql_transform
from tablewright.operators.timejoins import asof_join, interval_join
from tablewright.session import freeze

from .registry import query


@query("SELECT o_orderstatus, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1")
def sql_group(t):
    return sql_transform(
        t.orders, "SELECT o_orderstatus, round(sum(o_totalprice), 2) AS total FROM source_data GROUP BY o_orderstatus"
    )


@query("SELECT count(*) AS n, min(p_retailprice) AS least FROM part WHERE p_size > 10")
def sql_apply(t):
    return apply_sql_transform(t.part, "SELECT count(*) AS n, min(p_retailprice) AS least FROM data WHERE p_size > 10")


CASE_SQL = """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
    CASE WHEN l_quantity >= 40 THEN 'large' WHEN l_quantity >= 10 THEN 'medium' ELSE 'small' END AS size_class,
    CAST(l_quantity AS INT) AS units, round(l_extendedprice * (1 - l_discount), 4) AS net
    FROM {t} WHERE l_shipdate >= TIMESTAMP '1998-01-01' AND l_returnflag <> 'R'"""


@query(CASE_SQL.format(t="lineitem"))
def sql_project_filter_case(t):
    return sql_transform(t.lineitem, CASE_SQL.format(t="source_data"))


JOIN_SQL = """SELECT n_name, count(*) AS items, count(DISTINCT o_orderkey) AS orders,
    round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue
    FROM {lineitem} JOIN {orders} ON o_orderkey = l_orderkey
    JOIN {customer} ON c_custkey = o_custkey
    JOIN {nation} ON n_nationkey = c_nationkey
    GROUP BY n_name"""
NAMES = {n: n for n in ("lineitem", "orders", "customer", "nation", "part", "supplier", "events", "region")}


@query(JOIN_SQL.format(**NAMES))
def sql_join_inner(t):
    return t.spark.sql(JOIN_SQL, lineitem=t.lineitem, orders=t.orders, customer=t.customer, nation=t.nation)


OUTER_SQL = """SELECT coalesce(c_custkey, o_custkey) AS k, c_name, o_orderkey, o_totalprice
    FROM (SELECT c_custkey, c_name FROM {customer} WHERE c_acctbal > 0) c
    {kind} JOIN {orders} ON c_custkey = o_custkey"""


def _outer(kind):
    return OUTER_SQL.replace("{kind}", kind)


@query(_outer("LEFT").format(**NAMES))
def sql_join_left(t):
    return t.spark.sql(_outer("LEFT"), customer=t.customer, orders=t.orders)


@query(_outer("RIGHT").format(**NAMES))
def sql_join_right(t):
    return t.spark.sql(_outer("RIGHT"), customer=t.customer, orders=t.orders)


@query(_outer("FULL").format(**NAMES))
def sql_join_full(t):
    return t.spark.sql(_outer("FULL"), customer=t.customer, orders=t.orders)


# Pairs of items of one order, which has few, shipped in another order than listed.
SELF_SQL = """SELECT a.l_orderkey, a.l_linenumber AS listed_first, b.l_linenumber AS shipped_first
    FROM {lineitem} a JOIN {lineitem} b
    ON a.l_orderkey = b.l_orderkey AND a.l_linenumber < b.l_linenumber AND a.l_shipdate > b.l_shipdate"""


@query(SELF_SQL.format(**NAMES))
def sql_self_join(t):
    return t.spark.sql(SELF_SQL, lineitem=t.lineitem)


USING_SQL = """WITH a AS (SELECT o_custkey AS custkey, o_orderkey, o_totalprice FROM {orders}),
    b AS (SELECT c_custkey AS custkey, c_mktsegment FROM {customer})
    SELECT custkey, o_orderkey, o_totalprice, c_mktsegment FROM a {how}"""


def _using(how):
    return USING_SQL.replace("{how}", how)


@query(_using("JOIN b USING (custkey)").format(**NAMES))
def sql_join_using(t):
    return t.spark.sql(_using("JOIN b USING (custkey)"), orders=t.orders, customer=t.customer)


@query(_using("NATURAL LEFT JOIN b").format(**NAMES))
def sql_join_natural(t):
    return t.spark.sql(_using("NATURAL LEFT JOIN b"), orders=t.orders, customer=t.customer)


SEMI_SQL = """SELECT c_custkey, c_name FROM {customer} WHERE c_custkey {word} (
    SELECT o_custkey FROM {orders} WHERE o_totalprice > 400000 GROUP BY o_custkey)"""
EXISTS_SQL = """SELECT s_suppkey FROM {supplier} WHERE {word} EXISTS (
    SELECT 1 FROM (SELECT l_suppkey, max(l_quantity) AS most FROM {lineitem} WHERE l_tax = 0.08 AND l_discount = 0.1
        GROUP BY l_suppkey) x WHERE l_suppkey = s_suppkey AND most >= 49)"""


@query(SEMI_SQL.format(word="IN", **NAMES))
def sql_semi_join(t):
    return t.spark.sql(SEMI_SQL.replace("{word}", "IN"), customer=t.customer, orders=t.orders)


@query(EXISTS_SQL.format(word="", **NAMES))
def sql_exists(t):
    return t.spark.sql(EXISTS_SQL.replace("{word}", ""), supplier=t.supplier, lineitem=t.lineitem)


@query(EXISTS_SQL.format(word="NOT", **NAMES))
def sql_anti_join(t):
    return t.spark.sql(EXISTS_SQL.replace("{word}", "NOT"), supplier=t.supplier, lineitem=t.lineitem)


@query("""WITH shipped AS (SELECT o_custkey AS k, l_shipdate AS last_shipment FROM lineitem JOIN orders ON o_orderkey = l_orderkey)
    SELECT o_orderkey, last_shipment FROM orders ASOF LEFT JOIN shipped ON k = o_custkey AND o_orderdate >= last_shipment""")
def sql_asof_join(t):
    """The last shipment that each order's customer got up to the day of the order."""
    shipped = t.lineitem.join(t.orders, F.col("o_orderkey") == F.col("l_orderkey")).select("o_custkey", F.col("l_shipdate").alias("last_shipment"))
    found = asof_join(t.orders, shipped, "o_orderdate", "o_custkey", "last_shipment")
    return found.select("o_orderkey", "last_shipment")


@query("""SELECT event_id, o_orderkey FROM events ASOF LEFT JOIN
    (SELECT o_orderdate AS placed, max(o_orderkey) AS o_orderkey FROM orders GROUP BY o_orderdate) ON ts > placed""")
def asof_join_sliced(t):
    """The last order before each event, all under one key, which is above the limit: last rows are carried over slices."""
    placed = t.orders.select(F.col("o_orderdate").cast("timestamp").alias("at"), "o_orderkey")
    events = t.events.select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    found = asof_join(events, placed, "ts", right_time="at", exact=False, row_limit=events.count() // 4)
    return found.select("event_id", "o_orderkey")


@query("""WITH o AS (SELECT *, o_orderdate + to_days((CASE WHEN o_orderkey % 500 = 0 THEN 400 ELSE o_orderkey % 3 END)::INT) AS upto FROM orders)
    SELECT o_orderpriority, l_returnflag, count(*) AS n, round(sum(l_quantity), 2) AS units FROM lineitem
    JOIN o ON l_shipdate BETWEEN o_orderdate AND upto GROUP BY ALL""")
def interval_join_shipments(t):
    """Shipments while an order is open; a few orders stay open for more than a year.

    Rows that are alike in what the join and the groups look at are joined once, with their numbers: the pairs grow with
    the different times, not with the square of the rows.
    """
    days = F.when(F.col("o_orderkey") % 500 == 0, 400).otherwise(F.col("o_orderkey") % 3)
    spans = t.orders.withColumn("upto", F.col("o_orderdate") + F.make_dt_interval(days))
    spans = spans.groupBy("o_orderpriority", "o_orderdate", "upto").agg(F.count(F.lit(1)).alias("orders"))
    shipped = nan_to_null(t.lineitem.select("l_shipdate", "l_returnflag", "l_quantity")).groupBy("l_shipdate", "l_returnflag")
    # In a struct, because the join takes a NaN column for missing values, which a sum of infinities is not.
    shipped = shipped.agg(F.count(F.lit(1)).alias("lines"), F.struct(F.sum("l_quantity").alias("units")).alias("sums"))
    pairs = interval_join(freeze(shipped, "shipped"), freeze(spans, "spans"), "l_shipdate", ("o_orderdate", "upto"))
    units = F.round(F.sum(F.col("sums.units") * F.col("orders")), 2)
    return pairs.groupBy("o_orderpriority", "l_returnflag").agg(F.sum(F.col("lines") * F.col("orders")).alias("n"), units.alias("units"))


HAVING_SQL = """SELECT l_suppkey, count(DISTINCT l_partkey) AS parts,
    count(*) FILTER (WHERE l_returnflag = 'R') AS returned, sum(l_quantity) AS units
    FROM {t} GROUP BY l_suppkey HAVING count(*) > 20"""


@query(HAVING_SQL.format(t="lineitem"))
def sql_having_distinct_filter(t):
    return sql_transform(t.lineitem, HAVING_SQL.format(t="source_data"))


SETS_SQL = """SELECT l_returnflag, l_linestatus, count(*) AS n, sum(l_quantity) AS units, grouping(l_returnflag) AS g
    FROM {t} GROUP BY {how}"""


def _sets(how):
    return SETS_SQL.replace("{how}", how)


@query(_sets("GROUPING SETS ((l_returnflag, l_linestatus), (l_linestatus), ())").format(t="lineitem"))
def sql_grouping_sets(t):
    sets = "GROUPING SETS ((l_returnflag, l_linestatus), (l_linestatus), ())"
    return sql_transform(t.lineitem, _sets(sets).format(t="source_data"))


@query(_sets("CUBE (l_returnflag, l_linestatus)").format(t="lineitem"))
def sql_cube(t):
    return sql_transform(t.lineitem, _sets("CUBE (l_returnflag, l_linestatus)").format(t="source_data"))


@query(_sets("ROLLUP (l_returnflag, l_linestatus)").format(t="lineitem"))
def sql_rollup(t):
    return sql_transform(t.lineitem, _sets("ROLLUP (l_returnflag, l_linestatus)").format(t="source_data"))


WINDOW_SQL = """WITH m AS (SELECT *, floor(o_totalprice / 50000) AS band FROM {t})
    SELECT o_orderkey, row_number() OVER w AS rn, rank() OVER b AS rnk, dense_rank() OVER b AS drnk,
    round(percent_rank() OVER b, 8) AS prnk, round(cume_dist() OVER b, 8) AS cume, ntile(4) OVER w AS quarter,
    lag(o_totalprice) OVER w AS before, lead(o_totalprice, 2) OVER w AS after, first_value(o_totalprice) OVER w AS opening,
    last_value(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
        ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS closing,
    nth_value(o_totalprice, 3) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
        ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS third,
    round(sum(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
        ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 2) AS moving,
    count(*) OVER (PARTITION BY o_custkey ORDER BY band RANGE BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS near
    FROM m WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey), b AS (PARTITION BY o_custkey ORDER BY band)"""


@query(WINDOW_SQL.format(t="orders"))
def sql_window(t):
    return sql_transform(t.orders, WINDOW_SQL.format(t="source_data"))


TOPN_SQL = """SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT o_custkey, o_orderkey, o_totalprice,
    row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM {t}) WHERE rn <= 2"""


@query(TOPN_SQL.format(t="orders"))
def sql_window_topn(t):
    return sql_transform(t.orders, TOPN_SQL.format(t="source_data"))


INTERSECT_SQL = """SELECT o_custkey AS k FROM {orders} WHERE o_orderstatus = 'O' INTERSECT
    SELECT o_custkey FROM {orders} WHERE o_orderstatus = 'F'"""
EXCEPT_SQL = """SELECT c_custkey AS k FROM {customer} EXCEPT SELECT o_custkey FROM {orders} WHERE o_totalprice > 400000"""
UNION_SQL = """SELECT s_nationkey AS k, 's' AS kind FROM {supplier} UNION SELECT c_nationkey, 'c' FROM {customer}"""
UNION_ALL_SQL = """SELECT s_nationkey AS k FROM {supplier} UNION ALL SELECT c_nationkey FROM {customer}"""


@query(INTERSECT_SQL.format(**NAMES))
def sql_intersect(t):
    return t.spark.sql(INTERSECT_SQL, orders=t.orders)


@query(EXCEPT_SQL.format(**NAMES))
def sql_except(t):
    return t.spark.sql(EXCEPT_SQL, customer=t.customer, orders=t.orders)


@query(UNION_SQL.format(**NAMES))
def sql_union(t):
    return t.spark.sql(UNION_SQL, supplier=t.supplier, customer=t.customer)


@query(UNION_ALL_SQL.format(**NAMES))
def sql_union_all(t):
    return t.spark.sql(UNION_ALL_SQL, supplier=t.supplier, customer=t.customer)


CTE_SQL = """WITH per AS (SELECT o_custkey, sum(o_totalprice) AS total, count(*) AS n FROM {orders} GROUP BY o_custkey),
    mean AS (SELECT avg(total) AS m FROM per)
    SELECT o_custkey, round(total, 2) AS total, n FROM per WHERE total > (SELECT m FROM mean)"""


@query(CTE_SQL.format(**NAMES))
def sql_cte_scalar_subquery(t):
    return t.spark.sql(CTE_SQL, orders=t.orders)


CORRELATED_SQL = """SELECT c_custkey, (SELECT round(max(o_totalprice), 2) FROM {orders} WHERE o_custkey = c_custkey) AS largest
    FROM {customer}"""


@query(CORRELATED_SQL.format(**NAMES))
def sql_correlated_subquery(t):
    return t.spark.sql(CORRELATED_SQL, customer=t.customer, orders=t.orders)


RECURSIVE_SQL = """WITH RECURSIVE span(y, last) AS (
        SELECT CAST(min(year(o_orderdate)) AS INT), CAST(max(year(o_orderdate)) AS INT) FROM {orders}
        UNION ALL SELECT y + 1, last FROM span WHERE y < last)
    SELECT y, coalesce(n, 0) AS n FROM span LEFT JOIN
        (SELECT CAST(year(o_orderdate) AS INT) AS oy, count(*) AS n FROM {orders} GROUP BY 1) o ON y = oy"""


@query(RECURSIVE_SQL.format(**NAMES))
def sql_recursive_cte(t):
    return t.spark.sql(RECURSIVE_SQL, orders=t.orders)


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50 OFFSET 10")
def sql_order_limit_offset(t):
    return sql_transform(
        t.orders,
        "SELECT o_orderkey, o_totalprice FROM source_data ORDER BY o_totalprice DESC, o_orderkey LIMIT 50 OFFSET 10",
    )


@query("""SELECT p_partkey, substr(p_name, 1, 4) AS head, strpos(p_name, ' ') AS space, replace(p_brand, '#', '-') AS brand,
    trim('  ' || p_type || ' ') AS trimmed, ltrim('  ' || p_type) AS l, rtrim(p_type || '  ') AS r, upper(p_name) AS up,
    lower(p_type) AS low, length(p_name) AS len, hex(encode(p_type)) AS hexed, printf('%05d:%s', p_size, p_brand) AS shown,
    chr(CAST(65 + p_size % 26 AS INT)) AS letter, ascii(p_type) AS code, p_name LIKE '%ring%' AS is_like,
    p_name GLOB '*widget' AS is_glob FROM part""")
def sql_string_functions(t):
    return sql_transform(
        t.part,
        r"""SELECT p_partkey, substr(p_name, 1, 4) AS head, instr(p_name, ' ') AS space, replace(p_brand, '#', '-') AS brand,
        trim('  ' || p_type || ' ') AS trimmed, ltrim('  ' || p_type) AS l, rtrim(p_type || '  ') AS r, upper(p_name) AS up,
        lower(p_type) AS low, length(p_name) AS len, hex(p_type) AS hexed, format_string('%05d:%s', p_size, p_brand) AS shown,
        char(65 + p_size % 26) AS letter, ascii(p_type) AS code, p_name LIKE '%ring%' AS is_like,
        p_name RLIKE '^.*widget$' AS is_glob FROM source_data""",
    )


@query("""SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day, strftime(o_orderdate, '%H:%M:%S') AS clock,
    strftime(o_orderdate, '%Y/%j') AS year_day, strftime(o_orderdate + INTERVAL 7 DAY, '%Y-%m-%d') AS week_later,
    strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS month_start,
    date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS days, CAST(epoch(o_orderdate) AS BIGINT) AS seconds,
    CAST(julian(CAST(o_orderdate AS DATE)) AS BIGINT) AS julian_day, year(o_orderdate) AS y FROM orders""")
def sql_date_functions(t):
    return sql_transform(
        t.orders,
        """SELECT o_orderkey, date_format(o_orderdate, 'yyyy-MM-dd') AS day, date_format(o_orderdate, 'HH:mm:ss') AS clock,
        date_format(o_orderdate, 'yyyy/DDD') AS year_day, date_format(o_orderdate + INTERVAL 7 DAY, 'yyyy-MM-dd') AS week_later,
        date_format(date_trunc('MONTH', o_orderdate), 'yyyy-MM-dd') AS month_start,
        datediff(o_orderdate, DATE '1970-01-01') AS days, unix_seconds(CAST(o_orderdate AS TIMESTAMP)) AS seconds,
        CAST(datediff(o_orderdate, DATE '1970-01-01') + 2440588 AS BIGINT) AS julian_day, year(o_orderdate) AS y FROM source_data""",
    )


@query("""SELECT event_id, abs(value - 50) AS away, round(value, 1) AS rounded, greatest(value, 20.0) AS hi, least(value, 20.0) AS lo,
    CAST(sign(value - 50) AS DOUBLE) AS side, floor(value) AS fl, ceil(value) AS ce, round(sqrt(value), 8) AS root,
    round(ln(value), 8) AS logged, round(power(value, 2), 6) AS squared, user_id % 7 AS rest, user_id // 7 AS whole FROM events""")
def sql_math_functions(t):
    return sql_transform(
        t.events,
        """SELECT event_id, abs(value - 50) AS away, round(value, 1) AS rounded, greatest(value, 20.0D) AS hi,
        least(value, 20.0D) AS lo, sign(value - 50) AS side, CAST(floor(value) AS DOUBLE) AS fl, CAST(ceil(value) AS DOUBLE) AS ce,
        round(sqrt(value), 8) AS root, round(ln(value), 8) AS logged, round(power(value, 2), 6) AS squared,
        user_id % 7 AS rest, user_id DIV 7 AS whole FROM source_data""",
    )


@query("""SELECT o_orderkey, coalesce(nullif(o_orderstatus, 'P'), 'none') AS a, ifnull(nullif(o_orderstatus, 'O'), '-') AS b,
    if(o_totalprice > 100000, 'dear', 'cheap') AS c FROM orders""")
def sql_conditional_functions(t):
    return sql_transform(
        t.orders,
        """SELECT o_orderkey, coalesce(nullif(o_orderstatus, 'P'), 'none') AS a, ifnull(nullif(o_orderstatus, 'O'), '-') AS b,
        if(o_totalprice > 100000, 'dear', 'cheap') AS c FROM source_data""",
    )


@query("""SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, json_extract_string(props, '$.none') AS nothing,
    'k=' || json_extract_string(props, '$.k') AS shown, CAST(json_extract_string(props, '$.k') AS BIGINT) + 1 AS first_item FROM events""")
def sql_json_functions(t):
    return sql_transform(
        t.events,
        """SELECT event_id, CAST(get_json_object(props, '$.k') AS BIGINT) AS k, get_json_object(props, '$.none') AS nothing,
        'k=' || from_json(props, 'k BIGINT').k AS shown,
        get(from_json('[' || (from_json(props, 'k BIGINT').k + 1) || ',0]', 'array<bigint>'), 0) AS first_item
        FROM source_data""",
    )


@query("""SELECT event_id, json_object('id', event_id, 'kind', event_type) AS made, unnest(CAST(json_array(user_id, user_id + 1) AS BIGINT[])) AS item
    FROM events""")
def sql_json_build_explode(t):
    return sql_transform(
        t.events,
        """SELECT event_id, to_json(named_struct('id', event_id, 'kind', event_type)) AS made,
        explode(from_json(to_json(array(user_id, user_id + 1)), 'array<bigint>')) AS item FROM source_data""",
    )


# An order has few items, so each list is short.
@query("""SELECT l_orderkey, string_agg(l_returnflag, ',' ORDER BY l_returnflag) AS flags, sum(l_quantity) AS total,
    round(avg(l_quantity), 8) AS mean, count(*) AS n, min(l_linestatus) AS lo, max(l_linestatus) AS hi FROM lineitem GROUP BY 1""")
def sql_aggregates(t):
    return sql_transform(
        t.lineitem,
        """SELECT l_orderkey, listagg(l_returnflag, ',') WITHIN GROUP (ORDER BY l_returnflag) AS flags, sum(l_quantity) AS total,
        round(avg(l_quantity), 8) AS mean, count(*) AS n, min(l_linestatus) AS lo, max(l_linestatus) AS hi
        FROM source_data GROUP BY l_orderkey""",
    )


@query("""SELECT vec_id, len(embedding) AS n, round(CAST(embedding[1] AS DOUBLE), 5) AS first_item,
    len(list_filter(embedding, lambda x: x > 0)) AS positive FROM embeddings""")
def sql_array_functions(t):
    return sql_transform(
        t.embeddings,
        """SELECT vec_id, size(embedding) AS n, round(CAST(element_at(embedding, 1) AS DOUBLE), 5) AS first_item,
        size(filter(embedding, x -> x > 0)) AS positive FROM source_data""",
    )
