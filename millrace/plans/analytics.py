"""The analytic queries on the generated test tables.

Each ``q_*`` takes ``(spark, sf_dir)`` and returns a DataFrame; ``SQL`` holds
the same question as plain SQL (run by DuckDB as the oracle, and readable as a
specification). Money is summed as ``decimal(18,2)`` (all amounts have two
decimals) and converted to double at the end, so totals do not depend on
addition order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.casts import parse_date
from ..functions.values import swap_values
from ..operators.islands import islands, runs
from ..operators.positions import global_lag, global_row_number
from ..operators.joins import equi_join, join_cardinality
from ..operators.ranking import top_n_per_group, top_n_sum
from ..operators.ratios import ratio_to_max
from ..operators.series import declines
from ..sources.tables import test_table

MONEY = "decimal(18,2)"
ACTIVITY_EPOCH = "2024-01-01"   # day 0 of the activity sequence
HIGH_VALUE = 150000             # order value threshold for the streak query


def _money_sum(c: str):
    return F.sum(F.col(c).cast(MONEY))


# --- Q-2: top 3 customers by revenue per region ------------------------------

def top_customers_per_region(orders: DataFrame, customer: DataFrame, nation: DataFrame,
                             region: DataFrame, n: int = 3) -> DataFrame:
    """``region, customer_name, total_revenue, rn``.

    Orders are reduced to one row per customer before any join (partial
    aggregation map-side), and the dimensions are joined among themselves
    first (nation-region, then customer), so the per-customer table passes
    through a single join. Spark broadcasts each side when measured small.
    The ranking's partial window limit runs before its shuffle.
    """
    per_customer = orders.groupBy("o_custkey").agg(_money_sum("o_totalprice").alias("rev"))
    geo = (nation.select("n_nationkey", "n_regionkey")
           .join(region.select("r_regionkey", "r_name"), F.col("n_regionkey") == F.col("r_regionkey")))
    customer_region = (customer.select("c_custkey", "c_name", "c_nationkey")
                       .join(geo, F.col("c_nationkey") == F.col("n_nationkey"))
                       .select("c_custkey", "c_name", "r_name"))
    joined = per_customer.join(customer_region, F.col("o_custkey") == F.col("c_custkey"))
    totals = (joined.groupBy(F.col("r_name").alias("region"), F.col("c_name").alias("customer_name"))
                    .agg(F.sum("rev").cast("double").alias("total_revenue")))
    return top_n_per_group(totals, "region", [F.desc("total_revenue"), F.asc("customer_name")], n)


def q_top3_customers_per_region(spark: SparkSession, sf: str) -> DataFrame:
    t = lambda name: test_table(spark, sf, name)
    return top_customers_per_region(t("orders"), t("customer"), t("nation"), t("region"), 3)


TOP3_SQL_TEXT = """
SELECT area AS region, buyer AS customer_name, spent AS total_revenue, CAST(place AS BIGINT) AS rn
FROM (
    SELECT area, buyer, spent, ROW_NUMBER() OVER by_area AS place
    FROM (
        SELECT r.r_name AS area, c.c_name AS buyer, CAST(SUM(o.paid) AS DOUBLE) AS spent
        FROM (SELECT o_custkey, SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS paid
              FROM {orders} GROUP BY o_custkey) o
        JOIN {customer} c ON c.c_custkey = o.o_custkey
        JOIN {nation} n ON n.n_nationkey = c.c_nationkey
        JOIN {region} r ON r.r_regionkey = n.n_regionkey
        GROUP BY r.r_name, c.c_name
    )
    WINDOW by_area AS (PARTITION BY area ORDER BY spent DESC, buyer)
)
WHERE place <= 3
"""


def q_top3_customers_per_region_sql(spark: SparkSession, sf: str) -> DataFrame:
    """The same question through ``spark.sql`` over temp views (same plan shape:
    orders pre-aggregated per customer, partial window limit before the shuffle)."""
    names = {}
    for t in ("orders", "customer", "nation", "region"):
        names[t] = f"millrace_{t}"
        test_table(spark, sf, t).createOrReplaceTempView(names[t])
    return spark.sql(TOP3_SQL_TEXT.format(**names))


# --- Q-9: sum of each customer's top-2 orders -------------------------------

def q_top2_orders_sum_per_customer(spark: SparkSession, sf: str) -> DataFrame:
    o = test_table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    out = top_n_sum(o.withColumn("amt", F.col("o_totalprice").cast(MONEY)), "o_custkey", "amt",
                    [F.desc("o_totalprice"), F.asc("o_orderkey")], 2, alias="top2_total")
    return out.withColumn("top2_total", F.col("top2_total").cast("double"))


# --- Q-1: days whose revenue is below the previous day's ---------------------

def _daily_revenue(spark: SparkSession, sf: str) -> DataFrame:
    """One row per order day (partial aggregation: #days rows leave each task)."""
    return (test_table(spark, sf, "orders")
            .groupBy(F.to_date("o_orderdate").alias("order_day"))
            .agg(_money_sum("o_totalprice").cast("double").alias("revenue")))


def q_declining_revenue_days(spark: SparkSession, sf: str) -> DataFrame:
    # Buckets by month: the stitching window sees one row per month.
    return declines(_daily_revenue(spark, sf), "order_day", "revenue",
                    F.trunc("order_day", "month"), prev="prev_revenue")


def q_declining_revenue_adjacent_days(spark: SparkSession, sf: str) -> DataFrame:
    """Variant: only compare with the previous *calendar* day (a gap breaks it)."""
    return declines(_daily_revenue(spark, sf), "order_day", "revenue",
                    F.trunc("order_day", "month"), prev="prev_revenue", adjacent_only=True)


# --- Q-3: orders in runs of >= 3 consecutive keys with value >= threshold -----

def q_consecutive_high_value_orders(spark: SparkSession, sf: str) -> DataFrame:
    o = (test_table(spark, sf, "orders")
         .select("o_orderkey", "o_totalprice")
         .where(F.col("o_totalprice") >= HIGH_VALUE))
    return runs(o, "o_orderkey", min_length=3)


# --- one global order over every line item --------------------------------------

_LINE_ORDER = ["l_shipdate", "l_orderkey", "l_linenumber"]


def q_global_row_number(spark: SparkSession, sf: str) -> DataFrame:
    """Each line item's place in the order of shipping (one order over the whole table)."""
    items = test_table(spark, sf, "lineitem").select(*_LINE_ORDER)
    return global_row_number(items, _LINE_ORDER, "place").drop("l_shipdate")


def q_global_lag(spark: SparkSession, sf: str) -> DataFrame:
    """Each line item's price, and that of the item shipped just before it."""
    items = test_table(spark, sf, "lineitem").select(*_LINE_ORDER, "l_extendedprice")
    return global_lag(items, [*_LINE_ORDER, "l_extendedprice"], {"prev_price": "l_extendedprice"}).drop("l_shipdate")


# --- Q-6 / Q-7: islands of consecutive activity days per user ----------------

def _activity_days(spark: SparkSession, sf: str) -> DataFrame:
    e = test_table(spark, sf, "events").select("user_id", "ts")
    day = F.datediff(F.to_date("ts"), parse_date(F.lit(ACTIVITY_EPOCH))).cast("bigint")
    # distinct (user, day): partial aggregation dedups map-side; a user then
    # holds at most one row per calendar day, whatever its event volume.
    return e.select("user_id", day.alias("day_no")).distinct()


ISLANDS_SQL_TEXT = """
WITH starts AS (
    -- `user` is a reserved word and so is written with back quotes.
    SELECT user_id AS `user`, day_no,
           IF(day_no - LAG(day_no) OVER (PARTITION BY user_id ORDER BY day_no) = 1, 0, 1) AS begins
    FROM {view}
),
counted AS (
    SELECT `user`, day_no,
           SUM(begins) OVER (PARTITION BY `user` ORDER BY day_no
                             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS nth
    FROM starts
)
SELECT `user` AS user_id, MIN(day_no) AS min_sequence, MAX(day_no) AS max_sequence
FROM counted
GROUP BY `user`, nth
ORDER BY `user`, min_sequence
"""


def q_user_activity_islands_sql(spark: SparkSession, sf: str) -> DataFrame:
    """The SQL form: a temp view and one statement; start flags, then their running count."""
    view = "millrace_activity_days"
    _activity_days(spark, sf).createOrReplaceTempView(view)
    return spark.sql(ISLANDS_SQL_TEXT.format(view=view))


DAY_BUCKET = 1024   # days per bucket; day numbers live in a calendar-sized domain


def q_user_activity_islands_df(spark: SparkSession, sf: str) -> DataFrame:
    """The DataFrame form, bucketed (no whole-group window), globally sorted
    like the SQL form (a range-partitioned sort, not one task)."""
    out = islands(_activity_days(spark, sf), "day_no", by="user_id", width=DAY_BUCKET)
    return out.orderBy("user_id", "min_sequence")


# --- Q-4: swap two status values in one pass ---------------------------------

def q_swap_order_status(spark: SparkSession, sf: str) -> DataFrame:
    o = test_table(spark, sf, "orders")
    return o.select("o_orderkey", "o_orderstatus",
                    swap_values("o_orderstatus", "O", "F").alias("swapped_status"))


# --- Q-5: each order with its customer's maximum and the ratio ----------------

def q_order_ratio_to_customer_max(spark: SparkSession, sf: str) -> DataFrame:
    o = test_table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    return ratio_to_max(o, "o_custkey", "o_totalprice", max_col="max_totalprice", ratio_col="ratio")


# --- Hot keys: the same operators where one group holds a third of the rows ----
# lineitem's l_returnflag has three values with a third of the rows each.

def _line_order():
    return [F.desc("l_extendedprice"), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def q_top5_lineitems_per_returnflag(spark: SparkSession, sf: str) -> DataFrame:
    """Top-N with three groups of a third of the table each: the partial
    window limit keeps 5 rows per group per map task before the shuffle."""
    li = test_table(spark, sf, "lineitem").select(
        "l_returnflag", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    return top_n_per_group(li, "l_returnflag", _line_order(), 5)


def q_lineitem_ratio_to_flag_max(spark: SparkSession, sf: str) -> DataFrame:
    """Ratio to group max with six groups of a sixth of the table each:
    partial maxima per task, then a join back (no whole-group window)."""
    li = test_table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_extendedprice")
    return ratio_to_max(li, ["l_returnflag", "l_linestatus"], "l_extendedprice",
                        max_col="max_price", ratio_col="ratio")


# --- Q-8 / JOIN-1..6: join kinds with duplicate and NULL keys ----------------
# Left: orders keyed by nullif(o_custkey % 7, 0) -> keys 1..6 and NULL.
# Right: nation keyed by nullif(n_nationkey % 5, 0) -> keys 1..4 (five rows
# each) and NULL. Every order takes part; the right side's multiplicity is
# bounded by the 25-row nation table, so the joins grow linearly with orders.

def _join_sides(spark: SparkSession, sf: str):
    left = test_table(spark, sf, "orders").select(
        "o_orderkey", F.expr("nullif(o_custkey % 7, 0)").cast("bigint").alias("lkey"))
    right = test_table(spark, sf, "nation").select(
        "n_nationkey", F.expr("nullif(n_nationkey % 5, 0)").cast("bigint").alias("rkey"))
    return left, right


def _join_query(how: str):
    def q(spark: SparkSession, sf: str) -> DataFrame:
        left, right = _join_sides(spark, sf)
        return equi_join(left, right, "lkey", "rkey", how)
    q.__name__ = f"q_join_{how}"
    return q


def q_join_cardinality(spark: SparkSession, sf: str) -> DataFrame:
    left, right = _join_sides(spark, sf)
    return join_cardinality(left, right, "lkey", "rkey")


QUERIES = {
    "top3_customers_per_region": q_top3_customers_per_region,
    "top3_customers_per_region_sql": q_top3_customers_per_region_sql,
    "top2_orders_sum_per_customer": q_top2_orders_sum_per_customer,
    "declining_revenue_days": q_declining_revenue_days,
    "declining_revenue_adjacent_days": q_declining_revenue_adjacent_days,
    "consecutive_high_value_orders": q_consecutive_high_value_orders,
    "global_row_number": q_global_row_number,
    "global_lag": q_global_lag,
    "user_activity_islands_sql": q_user_activity_islands_sql,
    "user_activity_islands_df": q_user_activity_islands_df,
    "swap_order_status": q_swap_order_status,
    "top5_lineitems_per_returnflag": q_top5_lineitems_per_returnflag,
    "lineitem_ratio_to_flag_max": q_lineitem_ratio_to_flag_max,
    "order_ratio_to_customer_max": q_order_ratio_to_customer_max,
    "join_inner": _join_query("inner"),
    "join_left": _join_query("left"),
    "join_right": _join_query("right"),
    "join_full": _join_query("full"),
    "join_cardinality": q_join_cardinality,
}

_ACTIVITY_DAYS_SQL = f"""
    SELECT DISTINCT user_id,
           CAST(date_diff('day', DATE '{ACTIVITY_EPOCH}', CAST(ts AS DATE)) AS BIGINT) AS day_no
    FROM events
"""

_JOIN_SIDES_SQL = """
    l AS (SELECT o_orderkey, CAST(NULLIF(o_custkey % 7, 0) AS BIGINT) AS lkey FROM orders),
    r AS (SELECT n_nationkey, CAST(NULLIF(n_nationkey % 5, 0) AS BIGINT) AS rkey FROM nation)
"""


def _join_sql(kind: str) -> str:
    return f"WITH {_JOIN_SIDES_SQL} SELECT l.o_orderkey, l.lkey, r.n_nationkey, r.rkey " \
           f"FROM l {kind} JOIN r ON l.lkey = r.rkey"


SQL = {
    "global_row_number": """
        SELECT l_orderkey, l_linenumber,
               row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber) AS place
        FROM lineitem""",
    "global_lag": """
        SELECT l_orderkey, l_linenumber, l_extendedprice,
               lag(l_extendedprice) OVER (
                   ORDER BY l_shipdate, l_orderkey, l_linenumber, l_extendedprice) AS prev_price
        FROM lineitem""",
    "top3_customers_per_region": """
        SELECT r.r_name AS region, c.c_name AS customer_name,
               CAST(SUM(CAST(o.o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue,
               ROW_NUMBER() OVER (PARTITION BY r.r_name
                                  ORDER BY SUM(CAST(o.o_totalprice AS DECIMAL(18,2))) DESC, c.c_name) AS rn
        FROM orders o
        JOIN customer c ON c.c_custkey = o.o_custkey
        JOIN nation n ON n.n_nationkey = c.c_nationkey
        JOIN region r ON r.r_regionkey = n.n_regionkey
        GROUP BY r.r_name, c.c_name
        QUALIFY rn <= 3
    """,
    "top2_orders_sum_per_customer": """
        WITH ranked AS (
            SELECT o_custkey, o_totalprice,
                   ROW_NUMBER() OVER (PARTITION BY o_custkey
                                      ORDER BY o_totalprice DESC, o_orderkey) AS rn
            FROM orders
        )
        SELECT o_custkey,
               CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS top2_total
        FROM ranked WHERE rn <= 2 GROUP BY o_custkey
    """,
    "declining_revenue_days": """
        WITH daily AS (
            SELECT CAST(o_orderdate AS DATE) AS order_day,
                   CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue
            FROM orders GROUP BY 1
        ),
        prev AS (
            SELECT order_day, revenue,
                   LAG(revenue) OVER (ORDER BY order_day) AS prev_revenue
            FROM daily
        )
        SELECT order_day, revenue, prev_revenue FROM prev WHERE revenue < prev_revenue
    """,
    "declining_revenue_adjacent_days": """
        WITH daily AS (
            SELECT CAST(o_orderdate AS DATE) AS order_day,
                   CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue
            FROM orders GROUP BY 1
        ),
        prev AS (
            SELECT order_day, revenue,
                   LAG(revenue) OVER (ORDER BY order_day) AS prev_revenue,
                   LAG(order_day) OVER (ORDER BY order_day) AS prev_day
            FROM daily
        )
        SELECT order_day, revenue, prev_revenue FROM prev
        WHERE revenue < prev_revenue AND date_diff('day', prev_day, order_day) = 1
    """,
    "consecutive_high_value_orders": f"""
        WITH f AS (
            SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice >= {HIGH_VALUE}
        ),
        g AS (
            SELECT *, o_orderkey - DENSE_RANK() OVER (ORDER BY o_orderkey) AS grp FROM f
        ),
        r AS (
            SELECT o_orderkey, o_totalprice,
                   MIN(o_orderkey) OVER (PARTITION BY grp) AS run_start,
                   MAX(o_orderkey) OVER (PARTITION BY grp)
                     - MIN(o_orderkey) OVER (PARTITION BY grp) + 1 AS run_length
            FROM g
        )
        SELECT o_orderkey, o_totalprice, CAST(run_start AS BIGINT) AS run_start,
               CAST(run_length AS BIGINT) AS run_length
        FROM r WHERE run_length >= 3
    """,
    "user_activity_islands_sql": f"""
        WITH days AS ({_ACTIVITY_DAYS_SQL}),
        ranked AS (
            SELECT user_id, day_no,
                   DENSE_RANK() OVER (PARTITION BY user_id ORDER BY day_no) AS rn
            FROM days
        )
        SELECT user_id, MIN(day_no) AS min_sequence, MAX(day_no) AS max_sequence
        FROM ranked GROUP BY user_id, day_no - rn
    """,
    "swap_order_status": """
        SELECT o_orderkey, o_orderstatus,
               CASE WHEN o_orderstatus = 'O' THEN 'F'
                    WHEN o_orderstatus = 'F' THEN 'O'
                    ELSE o_orderstatus END AS swapped_status
        FROM orders
    """,
    "order_ratio_to_customer_max": """
        SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate,
               MAX(o_totalprice) OVER (PARTITION BY o_custkey) AS max_totalprice,
               o_totalprice / NULLIF(MAX(o_totalprice) OVER (PARTITION BY o_custkey), 0) AS ratio
        FROM orders
    """,
    "top5_lineitems_per_returnflag": """
        WITH ranked AS (
            SELECT l_returnflag, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
                   ROW_NUMBER() OVER (PARTITION BY l_returnflag
                                      ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber,
                                               l_partkey, l_suppkey) AS rn
            FROM lineitem
        )
        SELECT l_returnflag, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
               CAST(rn AS BIGINT) AS rn
        FROM ranked WHERE rn <= 5
    """,
    "lineitem_ratio_to_flag_max": """
        SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus, l_extendedprice,
               MAX(l_extendedprice) OVER (PARTITION BY l_returnflag, l_linestatus) AS max_price,
               l_extendedprice / NULLIF(MAX(l_extendedprice)
                   OVER (PARTITION BY l_returnflag, l_linestatus), 0) AS ratio
        FROM lineitem
    """,
    "join_inner": _join_sql("INNER"),
    "join_left": _join_sql("LEFT"),
    "join_right": _join_sql("RIGHT"),
    "join_full": _join_sql("FULL OUTER"),
    "join_cardinality": f"""
        WITH {_JOIN_SIDES_SQL}
        SELECT 'inner' AS join_kind, CAST(COUNT(*) AS DECIMAL(38,0)) AS row_count
        FROM l JOIN r ON l.lkey = r.rkey
        UNION ALL SELECT 'left', CAST(COUNT(*) AS DECIMAL(38,0)) FROM l LEFT JOIN r ON l.lkey = r.rkey
        UNION ALL SELECT 'right', CAST(COUNT(*) AS DECIMAL(38,0)) FROM l RIGHT JOIN r ON l.lkey = r.rkey
        UNION ALL SELECT 'full', CAST(COUNT(*) AS DECIMAL(38,0))
        FROM l FULL OUTER JOIN r ON l.lkey = r.rkey
        UNION ALL SELECT 'cross', CAST(COUNT(*) AS DECIMAL(38,0)) FROM l CROSS JOIN r
    """,
}
SQL["user_activity_islands_df"] = SQL["user_activity_islands_sql"]
SQL["top3_customers_per_region_sql"] = SQL["top3_customers_per_region"]
