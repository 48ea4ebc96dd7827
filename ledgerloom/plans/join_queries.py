"""Joins over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.functions import amount_sum
from ledgerloom.operators import joins as J
from ledgerloom.plans.registry import Tables, query
from ledgerloom.session import settled


@query(
    "join_inner",
    """
    SELECT o_orderkey, o_custkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice
    FROM orders JOIN lineitem ON l_orderkey = o_orderkey""",
)
def _(t: Tables):
    return t.orders.join(t.lineitem, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "o_orderkey", "o_custkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"
    )


@query(
    "join_left",
    """
    SELECT c_custkey, n_name, r_name, o_orderkey, o_totalprice FROM customer
    LEFT JOIN nation ON n_nationkey = c_nationkey AND n_nationkey < 20
    LEFT JOIN region ON r_regionkey = n_regionkey
    LEFT JOIN orders ON o_custkey = c_custkey""",
)
def _(t: Tables):
    return (
        t.customer.join(t.nation.filter("n_nationkey < 20"), F.col("n_nationkey") == F.col("c_nationkey"), "left")
        .join(t.region, F.col("r_regionkey") == F.col("n_regionkey"), "left")
        .join(t.orders, F.col("o_custkey") == F.col("c_custkey"), "left")
        .select("c_custkey", "n_name", "r_name", "o_orderkey", "o_totalprice")
    )


@query(
    "join_right",
    """
    SELECT o_orderkey, o_custkey, l_linenumber, l_shipdate FROM lineitem
    RIGHT JOIN orders ON l_orderkey = o_orderkey AND l_shipdate > o_orderdate + INTERVAL 60 DAY""",
)
def _(t: Tables):
    """All orders, with their lines that were shipped late."""
    late = F.col("l_shipdate") > F.col("o_orderdate") + F.expr("INTERVAL 60 DAY")
    return t.lineitem.join(t.orders, (F.col("l_orderkey") == F.col("o_orderkey")) & late, "right").select(
        "o_orderkey", "o_custkey", "l_linenumber", "l_shipdate"
    )


@query(
    "join_full_outer",
    """
    WITH a AS (SELECT o_custkey AS k, count(*) AS n FROM orders GROUP BY 1),
         b AS (SELECT user_id AS k, count(*) AS n FROM events GROUP BY 1)
    SELECT coalesce(a.k, b.k) AS party, coalesce(a.n, 0) + coalesce(b.n, 0) AS n FROM a FULL JOIN b ON a.k = b.k""",
)
def _(t: Tables):
    counted = lambda df, k: df.groupBy(F.col(k).alias("party")).agg(F.count(F.lit(1)).alias("n"))
    return J.full_add(counted(t.orders, "o_custkey"), counted(t.events, "user_id"), ["party"], ["n"])


@query(
    "join_cross",
    """
    WITH p AS (SELECT max(o_orderdate) AS run_date, count(*) AS n_all FROM orders)
    SELECT c_custkey, run_date, n_all FROM customer CROSS JOIN p""",
)
def _(t: Tables):
    parameters = t.orders.agg(F.max("o_orderdate").alias("run_date"), F.count(F.lit(1)).alias("n_all"))
    return t.customer.select("c_custkey").crossJoin(F.broadcast(parameters))


# balance bands: lower bound, upper bound, label (fixed values of the example)
BALANCE_BANDS = [
    (-1000.0, -0.01, "negative"),
    (0.0, 999.99, "low"),
    (1000.0, 4999.99, "middle"),
    (5000.0, 7999.99, "high"),
]


@query(
    "join_range_bucket",
    """
    SELECT c_custkey, c_acctbal, band FROM customer LEFT JOIN (VALUES (-1000.0, -0.01, 'negative'), (0.0, 999.99, 'low'),
      (1000.0, 4999.99, 'middle'), (5000.0, 7999.99, 'high')) AS b(lo, hi, band)
    ON c_acctbal BETWEEN CAST(lo AS DOUBLE) AND CAST(hi AS DOUBLE)""",
)
def _(t: Tables):
    bands = t.spark.createDataFrame(BALANCE_BANDS, "lo double, hi double, band string")
    return J.band_join(t.customer.select("c_custkey", "c_acctbal"), bands, "c_acctbal", "lo", "hi", ["band"])


@query(
    "join_time_proximity",
    """
    SELECT a.event_id AS purchase_id, b.event_id AS click_id, a.user_id AS user_id,
           CAST(abs(date_diff('second', date_trunc('second', a.ts), date_trunc('second', b.ts))) AS BIGINT) AS seconds_apart
    FROM events a JOIN events b ON a.user_id = b.user_id
     AND abs(date_diff('second', date_trunc('second', a.ts), date_trunc('second', b.ts))) <= 900
    WHERE a.event_type = 'purchase' AND b.event_type = 'click'""",
)
def _(t: Tables):
    pick = lambda kind, p: t.events.filter(F.col("event_type") == kind).select(
        F.col("event_id").alias(f"{p}_id"), F.col("user_id").alias(f"{p}_user"), F.col("ts").alias(f"{p}_ts")
    )
    joined = J.proximity_join(
        pick("purchase", "purchase"), pick("click", "click"), [("purchase_user", "click_user")], "purchase_ts", "click_ts", 900
    )
    second = lambda c: F.unix_timestamp(F.col(c).cast("timestamp"))
    return joined.select(
        "purchase_id",
        "click_id",
        F.col("purchase_user").alias("user_id"),
        F.abs(second("purchase_ts") - second("click_ts")).alias("seconds_apart"),
    )


@query(
    "join_asof_last",
    """
    WITH w AS (SELECT CAST(unnest(generate_series(TIMESTAMP '2024-01-08', TIMESTAMP '2024-01-29', INTERVAL 7 DAY)) AS TIMESTAMP) AS week_start),
         u AS (SELECT DISTINCT user_id FROM events)
    SELECT u.user_id, w.week_start, arg_max(event_type, (e.ts, e.event_id)) AS status, max(e.ts) AS since
    FROM u CROSS JOIN w JOIN events e ON e.user_id = u.user_id AND e.ts <= w.week_start GROUP BY 1, 2""",
)
def _(t: Tables):
    weeks = F.sequence(
        F.lit("2024-01-08").cast("timestamp_ntz"), F.lit("2024-01-29").cast("timestamp_ntz"), F.expr("interval 7 day")
    )
    points = t.events.select("user_id").distinct().withColumn("week_start", F.explode(weeks))
    events = t.events.select("user_id", "ts", "event_id", F.col("event_type").alias("status"), F.col("ts").alias("since"))
    return J.asof_join(points, events, ["user_id"], "week_start", "ts", ["status", "since"], tie=["event_id"])


@query(
    "join_temporal_validity",
    """
    WITH v AS (SELECT event_id AS version_id, user_id, ts AS valid_from, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS valid_to
               FROM events WHERE event_type = 'signup')
    SELECT p.event_id, v.version_id, v.valid_from, v.valid_to
    FROM events p JOIN v ON p.user_id = v.user_id AND p.ts >= v.valid_from AND (v.valid_to IS NULL OR p.ts < v.valid_to)
    WHERE p.event_type = 'purchase'""",
)
def _(t: Tables):
    versions = J.validity_intervals(
        t.events.filter("event_type = 'signup'").select(
            "user_id", F.col("event_id").alias("version_id"), F.col("ts").alias("valid_from")
        ),
        ["user_id"], "valid_from", [F.col("valid_from"), F.col("version_id")], "valid_to",
    )
    purchases = t.events.filter("event_type = 'purchase'").select("event_id", "user_id", "ts")
    # the intervals of a key do not overlap, so the valid one is the last that began
    found = J.asof_join(
        purchases, versions, ["user_id"], "ts", "valid_from", ["version_id", "valid_from", "valid_to"], tie=["version_id"]
    )
    return found.select("event_id", "version_id", "valid_from", "valid_to")


@query(
    "join_null_safe",
    """
    WITH s AS (SELECT s_suppkey, nullif(s_nationkey, 3) AS k FROM supplier), n AS (SELECT n_name, nullif(n_nationkey, 3) AS k FROM nation)
    SELECT s_suppkey, n_name FROM s JOIN n ON s.k IS NOT DISTINCT FROM n.k""",
)
def _(t: Tables):
    s = t.supplier.select("s_suppkey", F.nullif("s_nationkey", F.lit(3)).alias("sk"))
    n = t.nation.select("n_name", F.nullif("n_nationkey", F.lit(3)).alias("nk"))
    return s.join(n, F.col("sk").eqNullSafe(F.col("nk"))).select("s_suppkey", "n_name")


@query(
    "join_semi_exists",
    "SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 480000)",
)
def _(t: Tables):
    big = t.orders.filter("o_totalprice > 480000")
    return t.customer.join(big, F.col("o_custkey") == F.col("c_custkey"), "left_semi").select("c_custkey", "c_name")


@query(
    "join_anti_not_exists",
    "SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')",
)
def _(t: Tables):
    returned = t.lineitem.filter("l_returnflag = 'R'")
    return t.orders.join(returned, F.col("l_orderkey") == F.col("o_orderkey"), "left_anti").select("o_orderkey")


@query(
    "join_anti_left_null",
    "SELECT p_partkey, p_name FROM part LEFT JOIN lineitem ON l_partkey = p_partkey AND l_quantity > 49 WHERE l_partkey IS NULL",
)
def _(t: Tables):
    return t.part.join(
        t.lineitem.filter("l_quantity > 49"), F.col("l_partkey") == F.col("p_partkey"), "left_anti"
    ).select("p_partkey", "p_name")


@query(
    "join_not_in",
    """
    SELECT c_custkey, nation FROM (SELECT c_custkey, nullif(c_nationkey, 3) AS nation FROM customer)
    WHERE nation NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1)""",
)
def _(t: Tables):
    left = t.customer.select("c_custkey", F.nullif("c_nationkey", F.lit(3)).alias("nation"))
    return J.not_in(left, t.nation.filter("n_regionkey = 1"), "nation", "n_nationkey")


@query(
    "join_config_lookup",
    """
    SELECT n_name, n_regionkey, s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier
    LEFT JOIN nation ON s_nationkey = n_nationkey AND n_regionkey <> 2""",
)
def _(t: Tables):
    spec = {
        "columns": ["n_name", "n_regionkey"],
        "on": [("s_nationkey", "n_nationkey")],
        "how": "left",
        "filters": ["n_regionkey <> 2"],
    }
    return J.lookup_join(t.supplier, t.nation, spec)


@query(
    "join_scalar_subquery",
    """
    SELECT c_custkey, (SELECT max(o_orderdate) FROM orders) AS last_day,
           (SELECT r_name FROM region WHERE r_regionkey = (SELECT min(r_regionkey) FROM region)) AS home_region FROM customer""",
)
def _(t: Tables):
    last_day = F.broadcast(t.orders.agg(F.max("o_orderdate").alias("last_day")))
    home = F.broadcast(t.region.agg(F.min_by("r_name", "r_regionkey").alias("home_region")))
    return t.customer.select("c_custkey").crossJoin(last_day).crossJoin(home)


@query(
    "join_correlated_unnest",
    """
    SELECT o_orderkey, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) FILTER (l_returnflag = 'R') AS DOUBLE) AS returned_quantity
    FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey""",
)
def _(t: Tables):
    # one struct per (order, flag): the flag domain bounds the array
    per_flag = t.lineitem.groupBy("l_orderkey", "l_returnflag").agg(
        amount_sum("l_quantity").alias("quantity")
    )
    nested = per_flag.groupBy("l_orderkey").agg(
        F.collect_list(F.struct(F.col("l_returnflag").alias("code"), "quantity")).alias("parties")
    )
    first = F.get(F.filter("parties", lambda x: x["code"] == "R"), F.lit(0))["quantity"]
    return t.orders.join(nested, F.col("l_orderkey") == F.col("o_orderkey"), "left").select(
        "o_orderkey", first.alias("returned_quantity")
    )


@query(
    "join_unique_key_only",
    """
    WITH u AS (SELECT p_brand, p_type, p_size, p_name, max(p_partkey) AS part_id FROM part GROUP BY 1, 2, 3, 4 HAVING count(*) = 1)
    SELECT p.p_partkey, u.part_id FROM part p LEFT JOIN u USING (p_brand, p_type, p_size, p_name)""",
)
def _(t: Tables):
    keys = ["p_brand", "p_type", "p_size", "p_name"]
    unique = J.unique_keys_only(t.part.withColumn("part_id", F.col("p_partkey")), keys, ["part_id"])
    return t.part.join(unique, keys, "left").select("p_partkey", "part_id")


@query(
    "join_fallback_cascade",
    """
    WITH s AS (SELECT c_mktsegment, c_nationkey, max(c_acctbal) AS v FROM customer WHERE c_nationkey < 12 GROUP BY 1, 2),
         g AS (SELECT c_mktsegment, max(c_acctbal) AS v FROM customer GROUP BY 1)
    SELECT c_custkey, coalesce(s.v, g.v) AS ceiling FROM customer c LEFT JOIN s USING (c_mktsegment, c_nationkey) LEFT JOIN g USING (c_mktsegment)""",
)
def _(t: Tables):
    ceiling = F.max("c_acctbal").alias("ceiling")
    specific = t.customer.filter("c_nationkey < 12").groupBy("c_mktsegment", "c_nationkey").agg(ceiling)
    general = t.customer.groupBy("c_mktsegment").agg(ceiling)
    found = J.fallback_lookup(
        t.customer, specific, general, ["c_mktsegment", "c_nationkey"], ["c_mktsegment"], "ceiling"
    )
    return found.select("c_custkey", "ceiling")


@query(
    "join_multi_strategy_link",
    """
    WITH c1 AS (SELECT s_suppkey, c_custkey AS a FROM supplier JOIN customer ON c_custkey = s_suppkey AND c_mktsegment = 'BUILDING'),
         c2 AS (SELECT s_suppkey, c_custkey AS a FROM supplier JOIN customer ON c_custkey = s_suppkey + 1 AND c_mktsegment = 'MACHINERY'),
         c3 AS (SELECT s_suppkey, min(c_custkey) AS a FROM supplier JOIN customer ON c_nationkey = s_nationkey
                AND floor(c_acctbal / 100) = floor(s_acctbal / 100) GROUP BY 1)
    SELECT s.s_suppkey, coalesce(c1.a, c2.a, c3.a) AS account,
           CASE WHEN c1.a IS NOT NULL THEN 'CURRENT' WHEN c2.a IS NOT NULL THEN 'PREVIOUS' WHEN c3.a IS NOT NULL THEN 'ATTRIBUTES' ELSE 'NOT FOUND' END AS rule
    FROM supplier s LEFT JOIN c1 USING (s_suppkey) LEFT JOIN c2 USING (s_suppkey) LEFT JOIN c3 USING (s_suppkey)""",
)
def _(t: Tables):
    current = t.customer.filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("k1"), F.col("c_custkey").alias("a1"))
    previous = t.customer.filter("c_mktsegment = 'MACHINERY'").select((F.col("c_custkey") - 1).alias("k2"), F.col("c_custkey").alias("a2"))
    # the attribute key is reduced to one account before the join, so it adds no rows
    attributes = settled(
        t.customer.groupBy(F.col("c_nationkey").alias("n3"), F.floor(F.col("c_acctbal") / 100).alias("b3"))
        .agg(F.min("c_custkey").alias("a3"))
    )
    linked = (
        t.supplier.join(current, F.col("s_suppkey") == F.col("k1"), "left")
        .join(previous, F.col("s_suppkey") == F.col("k2"), "left")
        .join(
            attributes,
            (F.col("s_nationkey") == F.col("n3")) & (F.floor(F.col("s_acctbal") / 100) == F.col("b3")),
            "left",
        )
    )
    rule = (
        F.when(F.col("a1").isNotNull(), "CURRENT")
        .when(F.col("a2").isNotNull(), "PREVIOUS")
        .when(F.col("a3").isNotNull(), "ATTRIBUTES")
        .otherwise("NOT FOUND")
    )
    return linked.select("s_suppkey", F.coalesce("a1", "a2", "a3").alias("account"), rule.alias("rule"))


@query(
    "join_self_parent",
    """
    SELECT p.c_custkey, p.c_name, count(*) AS n_children, CAST(sum(CAST(c.c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS child_balance
    FROM customer p JOIN customer c ON c.c_custkey // 10 = p.c_custkey GROUP BY 1, 2""",
)
def _(t: Tables):
    children = (
        t.customer.groupBy(F.expr("c_custkey div 10").alias("parent"))
        .agg(
            F.count(F.lit(1)).alias("n_children"),
            amount_sum("c_acctbal").alias("child_balance"),
        )
    )
    return t.customer.join(children, F.col("c_custkey") == F.col("parent")).select(
        "c_custkey", "c_name", "n_children", "child_balance"
    )


@query(
    "join_recursive_chain",
    """
    WITH RECURSIVE e AS (SELECT c_custkey // 2 AS survivor, c_custkey AS victim, c_nationkey AS merge_no FROM customer WHERE c_custkey > 0),
    chain AS (SELECT survivor, victim, merge_no, 1 AS depth FROM e
      UNION ALL SELECT e.survivor, c.victim, c.merge_no, c.depth + 1 FROM chain c JOIN e ON c.survivor = e.victim WHERE c.depth < 10)
    SELECT survivor, victim, merge_no, CAST(depth AS BIGINT) AS depth FROM chain""",
)
def _(t: Tables):
    edges = t.customer.filter("c_custkey > 0").select(
        F.expr("c_custkey div 2").alias("survivor"), F.col("c_custkey").alias("victim"), F.col("c_nationkey").alias("merge_no")
    )
    return J.merge_chain(edges, "survivor", "victim", 10, ["merge_no"]).withColumn("depth", F.col("depth").cast("long"))


@query(
    "join_header_detail_segments",
    """
    SELECT o_orderkey // 100 AS account, o_orderkey % 100 AS suffix, o_orderstatus, l_linenumber, l_partkey, l_suppkey, l_extendedprice
    FROM orders JOIN lineitem ON l_orderkey = o_orderkey""",
)
def _(t: Tables):
    header = t.orders.select(
        F.expr("o_orderkey div 100").alias("account"), F.expr("o_orderkey % 100").alias("suffix"), "o_orderstatus"
    )
    body = t.lineitem.select(
        F.expr("l_orderkey div 100").alias("account"), F.expr("l_orderkey % 100").alias("suffix"),
        "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
    )
    return header.join(body, ["account", "suffix"])
