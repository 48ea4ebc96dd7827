"""Ordered and grouped window computations over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.functions import cents
from ledgerloom.operators import ordered as O
from ledgerloom.plans.registry import Tables, query

_MONTHLY_SQL = """
    WITH m AS (SELECT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS mth, count(*) AS n,
                      sum(CAST(o_totalprice AS DECIMAL(18,2))) AS spend FROM orders GROUP BY 1, 2)"""


def monthly(t: Tables):
    """One row per customer and month (spend in cents): the series that the windows run on."""
    return t.orders.groupBy("o_custkey", F.trunc("o_orderdate", "MM").alias("mth")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(cents("o_totalprice")).alias("spend")
    )


@query(
    "win_row_number_latest",
    """
    SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
)
def _(t: Tables):
    newest = O.latest_per_key(t.orders, ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")])
    return newest.select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")


@query(
    "win_qualify",
    """
    SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem WHERE l_returnflag = 'R'
    QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey) <= 3""",
)
def _(t: Tables):
    order = [F.desc("l_extendedprice"), F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey")]
    return O.latest_per_key(t.lineitem.filter("l_returnflag = 'R'"), ["l_suppkey"], order, n=3).select(
        "l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"
    )


@query(
    "win_dedup_keys",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate FROM lineitem QUALIFY row_number() OVER
    (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_shipdate, l_extendedprice) = 1""",
)
def _(t: Tables):
    order = [F.col(c) for c in ("l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice")]
    return O.latest_per_key(t.lineitem, ["l_orderkey", "l_linenumber"], order).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"
    )


@query(
    "win_rank",
    "SELECT o_orderkey, o_orderdate, rank() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate DESC) AS load_rank FROM orders",
)
def _(t: Tables):
    ranked = O.attach_ranks(t.orders, ["o_orderpriority"], ["o_orderdate"], descending=True)
    return ranked.select("o_orderkey", "o_orderdate", F.col("rank").alias("load_rank"))


@query(
    "win_dense_rank",
    """
    SELECT o_orderkey, dense_rank() OVER (ORDER BY date_trunc('month', o_orderdate) DESC) AS date_rank FROM orders""",
)
def _(t: Tables):
    dated = t.orders.select("o_orderkey", F.trunc("o_orderdate", "MM").alias("mth"))
    ranked = O.attach_ranks(dated, [], ["mth"], descending=True, bounded=True)
    return ranked.select("o_orderkey", F.col("dense_rank").alias("date_rank"))


@query(
    "win_lag_delta",
    _MONTHLY_SQL + """
    SELECT o_custkey, mth, CAST(n - lag(n, 1, 0) OVER w AS BIGINT) AS n_delta, CAST(spend - lag(spend, 1, 0) OVER w AS DOUBLE) AS spend_delta
    FROM m WINDOW w AS (PARTITION BY o_custkey ORDER BY mth)""",
)
def _(t: Tables):
    out = O.over_neighbours(
        monthly(t), ["o_custkey"], [F.col("mth")],
        lambda w: {
            "n_delta": F.col("n") - F.lag("n", 1, 0).over(w),
            "spend_delta": (F.col("spend") - F.lag("spend", 1, 0).over(w)) / 100,
        },
        before=1, bounded=True,
    )
    return out.select("o_custkey", "mth", "n_delta", "spend_delta")


@query(
    "win_lag_change_rate",
    _MONTHLY_SQL + """
    SELECT o_custkey, mth, round((CAST(spend AS DOUBLE) - lag(CAST(spend AS DOUBLE), 5) OVER w) / nullif(lag(CAST(spend AS DOUBLE), 5) OVER w, 0), 6) AS change_6m
    FROM m WINDOW w AS (PARTITION BY o_custkey ORDER BY mth)""",
)
def _(t: Tables):
    def rate(w):
        spend = F.col("spend") / 100
        old = F.lag(spend, 5).over(w)
        return {"change_6m": F.round(F.try_divide(spend - old, old), 6)}

    return O.over_neighbours(monthly(t), ["o_custkey"], [F.col("mth")], rate, before=5, bounded=True).select(
        "o_custkey", "mth", "change_6m"
    )


@query(
    "win_lead_interval",
    """
    SELECT event_id, user_id, ts AS valid_from, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS valid_to FROM events""",
)
def _(t: Tables):
    events = t.events.select("event_id", "user_id", F.col("ts").alias("valid_from"))
    return O.over_neighbours(
        events, ["user_id"], [F.col("valid_from"), F.col("event_id")], lambda w: {"valid_to": F.lead("valid_from").over(w)}, after=1
    )


@query(
    "win_last_value_ffill",
    """
    SELECT event_id, user_id, last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS) OVER w AS last_purchase,
           last_value(CASE WHEN event_type = 'signup' THEN props END IGNORE NULLS) OVER w AS last_signup
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
)
def _(t: Tables):
    sparse = t.events.select(
        "event_id", "user_id", "ts",
        F.when(F.col("event_type") == "purchase", F.col("value")).alias("p"),
        F.when(F.col("event_type") == "signup", F.col("props")).alias("s"),
    )
    filled = O.fill_forward(
        sparse, ["user_id"], [F.col("ts"), F.col("event_id")], {"p": "last_purchase", "s": "last_signup"}
    )
    return filled.select("event_id", "user_id", "last_purchase", "last_signup")


@query(
    "win_rolling_rows",
    _MONTHLY_SQL + """
    SELECT o_custkey, mth, CAST(sum(n) OVER y AS BIGINT) AS n_12, CAST(max(spend) OVER y AS DOUBLE) AS max_12,
           round(CAST(sum(spend) OVER h AS DOUBLE) / count(*) OVER h, 4) AS avg_6, round(var_samp(CAST(n AS DOUBLE)) OVER h, 6) AS var_6
    FROM m WINDOW y AS (PARTITION BY o_custkey ORDER BY mth ROWS BETWEEN 11 PRECEDING AND CURRENT ROW),
                  h AS (PARTITION BY o_custkey ORDER BY mth ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)""",
)
def _(t: Tables):
    def rolling(w):
        year, half = w.rowsBetween(-11, 0), w.rowsBetween(-5, 0)
        return {
            "n_12": F.sum("n").over(year),
            "max_12": F.max("spend").over(year) / 100,
            "avg_6": F.round(F.sum("spend").over(half) / 100 / F.count(F.lit(1)).over(half), 4),
            "var_6": F.round(F.var_samp("n").over(half), 6),
        }

    return O.over_neighbours(monthly(t), ["o_custkey"], [F.col("mth")], rolling, before=11, bounded=True).drop("n", "spend")


@query(
    "win_running_sum",
    """
    SELECT DISTINCT o_orderpriority, o_orderdate, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) OVER
      (PARTITION BY o_orderpriority ORDER BY o_orderdate) AS DOUBLE) AS running FROM orders""",
)
def _(t: Tables):
    priced = t.orders.select("o_orderpriority", "o_orderdate", cents("o_totalprice").alias("v"))
    total = O.running_total(priced, ["o_orderpriority"], ["o_orderdate"], "v", "running")
    return total.withColumn("running", F.col("running") / 100)


@query(
    "win_partition_total",
    """
    SELECT event_id, user_id, min(ts) OVER (PARTITION BY user_id) AS first_seen, max(ts) OVER (PARTITION BY user_id) AS last_seen FROM events""",
)
def _(t: Tables):
    return O.attach_group(
        t.events.select("event_id", "user_id", "ts"), ["user_id"], {"first_seen": F.min("ts"), "last_seen": F.max("ts")}
    ).drop("ts")


@query(
    "win_count_over",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, n FROM (
      SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n FROM lineitem) WHERE n > 1""",
)
def _(t: Tables):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    return O.attach_group(lines, ["l_orderkey", "l_linenumber"], {"n": F.count(F.lit(1))}).filter("n > 1")


@query(
    "win_sequence_offset",
    "SELECT o_orderkey, 1000 + row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS seq FROM orders",
)
def _(t: Tables):
    numbered = O.positions(t.orders.select("o_orderkey", "o_orderdate"), [], [F.col("o_orderdate"), F.col("o_orderkey")])
    return numbered.select("o_orderkey", (F.col("pos") + 1000).alias("seq"))


@query(
    "win_priority_pick",
    """
    SELECT o_custkey, o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus IN ('P', 'O') QUALIFY row_number() OVER
    (PARTITION BY o_custkey ORDER BY CASE o_orderstatus WHEN 'P' THEN 1 WHEN 'O' THEN 2 END, o_orderkey) = 1""",
)
def _(t: Tables):
    priority = F.when(F.col("o_orderstatus") == "P", 1).when(F.col("o_orderstatus") == "O", 2)
    chosen = t.orders.filter(F.col("o_orderstatus").isin("P", "O")).select("o_custkey", "o_orderkey", "o_orderstatus")
    return O.latest_per_key(chosen, ["o_custkey"], [priority, F.col("o_orderkey")])
