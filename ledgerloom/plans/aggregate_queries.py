"""Aggregations, sorts, limits and set operations over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.functions import amount_sum, cents
from ledgerloom.operators import aggregates as A
from ledgerloom.plans.registry import Tables, query

@query(
    "agg_group_sum_count",
    """
    SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS sum_qty,
           min(l_extendedprice) AS min_price, max(l_extendedprice) AS max_price,
           round(CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / count(*), 4) AS avg_price,
           CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))) AS DOUBLE) AS revenue
    FROM lineitem WHERE l_shipdate <= TIMESTAMP '2001-09-02' GROUP BY 1, 2""",
)
def _(t: Tables):
    net = cents("l_extendedprice") * (100 - cents("l_discount"))
    return (
        t.lineitem.filter(F.col("l_shipdate") <= F.lit("2001-09-02").cast("timestamp_ntz"))
        .groupBy("l_returnflag", "l_linestatus")
        .agg(
            F.count(F.lit(1)).alias("n"),
            amount_sum("l_quantity").alias("sum_qty"),
            F.min("l_extendedprice").alias("min_price"),
            F.max("l_extendedprice").alias("max_price"),
            F.round(amount_sum("l_extendedprice") / F.count(F.lit(1)), 4).alias("avg_price"),
            (F.sum(net.cast("decimal(18,0)")).cast("double") / 10000).alias("revenue"),
        )
    )


@query(
    "agg_count_distinct",
    """
    SELECT l_suppkey, count(DISTINCT l_orderkey) AS n_orders, count(DISTINCT l_partkey) AS n_parts FROM lineitem GROUP BY l_suppkey""",
)
def _(t: Tables):
    return t.lineitem.groupBy("l_suppkey").agg(
        F.count_distinct("l_orderkey").alias("n_orders"), F.count_distinct("l_partkey").alias("n_parts")
    )


@query(
    "agg_conditional",
    """
    SELECT user_id, count(*) FILTER (event_type = 'error') AS n_errors,
           CAST(coalesce(sum(CASE WHEN event_type = 'purchase' THEN CAST(value AS DECIMAL(18,2)) END), 0) AS DOUBLE) AS spent
    FROM events GROUP BY user_id""",
)
def _(t: Tables):
    spent = amount_sum(F.when(F.col("event_type") == "purchase", F.col("value")))
    return t.events.groupBy("user_id").agg(
        F.count_if(F.col("event_type") == "error").alias("n_errors"),
        F.coalesce(spent, F.lit(0.0)).alias("spent"),
    )


@query(
    "agg_having",
    """
    SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM orders GROUP BY 1
    HAVING sum(CAST(o_totalprice AS DECIMAL(18,2))) > 3000000""",
)
def _(t: Tables):
    return (
        t.orders.groupBy("o_custkey").agg(amount_sum("o_totalprice").alias("total")).filter("total > 3000000")
    )


@query(
    "agg_having_duplicates",
    "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)
def _(t: Tables):
    return A.duplicates(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(
    "agg_global",
    """
    SELECT count(*) AS n_records, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total,
           min(l_shipdate) AS first_day, max(l_shipdate) AS last_day FROM lineitem""",
)
def _(t: Tables):
    return t.lineitem.agg(
        F.count(F.lit(1)).alias("n_records"),
        amount_sum("l_extendedprice").alias("total"),
        F.min("l_shipdate").alias("first_day"),
        F.max("l_shipdate").alias("last_day"),
    )


@query(
    "agg_array_ordered",
    """
    SELECT user_id, arg_max(event_type, (ts, event_id)) AS last_type,
           arg_max(value, (ts, event_id)) FILTER (event_type = 'purchase') AS last_purchase FROM events GROUP BY user_id""",
)
def _(t: Tables):
    purchase = F.when(F.col("event_type") == "purchase", F.col("value"))
    return t.events.groupBy("user_id").agg(
        A.latest_non_null(F.col("event_type"), "ts", "event_id").alias("last_type"),
        A.latest_non_null(purchase, "ts", "event_id").alias("last_purchase"),
    )


@query(
    "agg_array_struct",
    """
    WITH f AS (SELECT l_orderkey, l_returnflag AS flag, count(*) AS n FROM lineitem GROUP BY 1, 2)
    SELECT l_orderkey, '[' || string_agg('{"flag":"' || flag || '","n":' || CAST(n AS VARCHAR) || '}', ',' ORDER BY flag) || ']' AS flags
    FROM f GROUP BY l_orderkey""",
)
def _(t: Tables):
    # counted per (order, flag) first: a collected array has one element per flag, however hot the order
    per_flag = t.lineitem.groupBy("l_orderkey", F.col("l_returnflag").alias("flag")).agg(F.count(F.lit(1)).alias("n"))
    return per_flag.groupBy("l_orderkey").agg(
        F.to_json(F.array_sort(F.collect_list(F.struct("flag", "n")))).alias("flags")
    )


@query(
    "agg_max_by",
    """
    SELECT o_custkey, arg_max(o_orderpriority, (o_totalprice, o_orderkey)) AS priority_of_largest,
           arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS first_order FROM orders GROUP BY o_custkey""",
)
def _(t: Tables):
    return t.orders.groupBy("o_custkey").agg(
        F.max_by("o_orderpriority", F.struct("o_totalprice", "o_orderkey")).alias("priority_of_largest"),
        F.min_by("o_orderkey", F.struct("o_orderdate", "o_orderkey")).alias("first_order"),
    )


@query(
    "agg_any_value",
    "SELECT c_nationkey, max(n_name) AS nation, count(*) AS n FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY 1",
)
def _(t: Tables):
    # customers are counted per nation before the join
    counted = t.customer.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"))
    return (
        counted.join(t.nation, F.col("n_nationkey") == F.col("c_nationkey"))
        .groupBy("c_nationkey")
        .agg(F.any_value("n_name").alias("nation"), F.sum("n").alias("n"))
    )


@query(
    "agg_string",
    """
    SELECT user_id, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS types FROM events GROUP BY user_id""",
)
def _(t: Tables):
    return A.joined_distinct(t.events, ["user_id"], "event_type", "types")


@query(
    "agg_variance",
    """
    SELECT l_suppkey, round(var_samp(l_quantity), 6) AS var_qty, round(var_samp(l_discount), 8) AS var_discount
    FROM lineitem GROUP BY l_suppkey""",
)
def _(t: Tables):
    return t.lineitem.groupBy("l_suppkey").agg(
        F.round(F.var_samp("l_quantity"), 6).alias("var_qty"), F.round(F.var_samp("l_discount"), 8).alias("var_discount")
    )


@query(
    "agg_ratio_safe",
    """
    SELECT c_nationkey, n, bad, CASE WHEN n = 0 THEN NULL ELSE round(bad / n, 6) END AS rate,
           CAST(CASE WHEN bad / n > 0.10 THEN 99 WHEN bad <= 0 THEN 1 ELSE ceil(bad / n / 0.0075) END AS BIGINT) AS grade
    FROM (SELECT c_nationkey, count(*) AS n, count(*) FILTER (c_acctbal < 0) AS bad FROM customer GROUP BY 1)""",
)
def _(t: Tables):
    counted = t.customer.groupBy("c_nationkey").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("c_acctbal") < 0).alias("bad")
    )
    rate = F.try_divide(F.col("bad").cast("double"), F.col("n").cast("double"))
    return counted.select(
        "c_nationkey", "n", "bad", F.round(rate, 6).alias("rate"), A.capped_grade(rate, 0.10, 0.0075).alias("grade")
    )


@query("agg_distinct_rows", "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem")
def _(t: Tables):
    return t.lineitem.select("l_returnflag", "l_linestatus", "l_linenumber").distinct()


@query(
    "agg_multi_level",
    """
    WITH o AS (SELECT l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS v FROM lineitem GROUP BY 1),
         c AS (SELECT o_custkey, date_trunc('month', o_orderdate) AS mth, sum(v) AS v, count(*) AS n FROM o JOIN orders ON o_orderkey = l_orderkey GROUP BY 1, 2)
    SELECT CAST(mth AS DATE) AS month, count(*) AS n_customers, CAST(sum(n) AS BIGINT) AS n_orders, CAST(max(v) AS DOUBLE) AS best_customer,
           CAST(sum(v) AS DOUBLE) AS total FROM c GROUP BY 1""",
)
def _(t: Tables):
    per_order = t.lineitem.groupBy("l_orderkey").agg(F.sum(cents("l_extendedprice")).alias("v"))
    per_customer = (
        per_order.join(t.orders, F.col("o_orderkey") == F.col("l_orderkey"))
        .groupBy("o_custkey", F.trunc("o_orderdate", "MM").alias("month"))
        .agg(F.sum("v").alias("v"), F.count(F.lit(1)).alias("n"))
    )
    return per_customer.groupBy("month").agg(
        F.count(F.lit(1)).alias("n_customers"),
        F.sum("n").alias("n_orders"),
        (F.max("v") / 100).alias("best_customer"),
        (F.sum("v") / 100).alias("total"),
    )


@query(
    "agg_rollup_parent",
    """
    SELECT r_regionkey, r_name, coalesce(CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE), 0) AS balance, count(c_custkey) AS n
    FROM region LEFT JOIN nation ON n_regionkey = r_regionkey LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY 1, 2""",
)
def _(t: Tables):
    per_nation = t.customer.groupBy("c_nationkey").agg(F.sum(cents("c_acctbal")).alias("b"), F.count(F.lit(1)).alias("k"))
    return (
        t.region.join(t.nation, F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .join(per_nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .groupBy("r_regionkey", "r_name")
        .agg(
            F.coalesce(F.sum("b") / 100, F.lit(0.0)).alias("balance"),
            F.coalesce(F.sum("k"), F.lit(0)).alias("n"),
        )
    )


@query("sort_order_by", "SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders ORDER BY o_orderpriority, o_totalprice DESC, o_orderkey")
def _(t: Tables):
    return t.orders.select("o_orderkey", "o_orderpriority", "o_totalprice").orderBy(
        "o_orderpriority", F.desc("o_totalprice"), "o_orderkey"
    )


@query("limit_n", "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal < 0 ORDER BY c_acctbal, c_custkey LIMIT 10")
def _(t: Tables):
    return t.customer.filter("c_acctbal < 0").select("c_custkey", "c_acctbal").orderBy("c_acctbal", "c_custkey").limit(10)


@query(
    "topk_per_order",
    """
    SELECT string_agg(m, ',' ORDER BY m DESC) AS month_list FROM (
      SELECT DISTINCT strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS m FROM orders ORDER BY m DESC LIMIT 13)""",
)
def _(t: Tables):
    return A.latest_months(t.orders, "o_orderdate", 13).select(F.array_join("month_list", ",").alias("month_list"))


@query(
    "set_union_all",
    "SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance FROM customer UNION ALL SELECT s_suppkey, s_name, s_acctbal FROM supplier",
)
def _(t: Tables):
    a = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))
    b = t.supplier.select(F.col("s_acctbal").alias("balance"), F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    return a.unionByName(b)


@query("set_union_distinct", "SELECT c_nationkey AS nation FROM customer UNION SELECT s_nationkey FROM supplier")
def _(t: Tables):
    a = t.customer.select(F.col("c_nationkey").alias("nation")).distinct()
    return a.union(t.supplier.select("s_nationkey")).distinct()


@query(
    "sample_table",
    "SELECT event_id, user_id, event_type FROM events ORDER BY event_id LIMIT 100",
)
def _(t: Tables):
    return A.sample_rows(t.events, ["event_id"], 100, "sample").select("event_id", "user_id", "event_type")
