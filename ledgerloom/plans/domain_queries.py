"""End-to-end jobs restated on the given tables."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from ledgerloom.functions import amount_sum, business_day, cents, mask_alnum, sha256_hex, stable_bucket
from ledgerloom.operators.aggregates import capped_grade
from ledgerloom.operators.changes import merge
from ledgerloom.operators.shaping import case_map, latest_load, latest_to_wide
from ledgerloom.plans import domain as D
from ledgerloom.plans.load import FILE_LOAD, TABLE_LOAD, Segment, load_segment_file, run_chain
from ledgerloom.plans.registry import AS_OF, Tables, query
from ledgerloom.session import scratch_path, settled
from ledgerloom.sources.fixed_width import parse_layout
from ledgerloom.sources.tables import read_table, swap_in

at = lambda d: F.lit(d).cast("timestamp_ntz")


@query(
    "app_points_by_period",
    """
    WITH id AS (SELECT o_custkey, arg_max(o_orderpriority, (o_orderdate, o_orderkey)) AS tier FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1),
    p AS (SELECT o_custkey AS wallet_id, CAST(date_trunc('month', l_shipdate) AS DATE) AS month,
        CAST(sum(CASE WHEN l_returnflag = 'R' THEN -(floor(l_extendedprice) - floor(l_extendedprice * l_discount))
                      WHEN l_returnflag = 'N' THEN floor(l_extendedprice) ELSE floor(l_extendedprice) + floor(l_extendedprice * l_discount) END) AS BIGINT) AS points
      FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE abs(date_diff('day', o_orderdate, l_shipdate)) <= 60 GROUP BY 1, 2)
    SELECT wallet_id, tier, month, CASE WHEN month < DATE '1998-01-01' AND tier <> '1-URGENT' THEN points + 500 ELSE points END AS points
    FROM p JOIN id ON o_custkey = wallet_id WHERE points <> 0""",
)
def _(t: Tables):
    """Newest identity, payments near their movement, refunds, then a conditional merge into a ledger."""
    bonus = F.when(F.col("l_returnflag") != "N", F.floor(F.col("l_extendedprice") * F.col("l_discount"))).otherwise(0)
    movements = t.lineitem.select(
        F.col("l_orderkey").alias("payment_id"), F.col("l_shipdate").alias("moved_at"),
        F.floor("l_extendedprice").alias("base"), bonus.alias("bonus"), (F.col("l_returnflag") == "R").alias("is_refund"),
    )
    payments = t.orders.select(F.col("o_orderkey").alias("payment_id"), F.col("o_custkey").alias("wallet_id"), F.col("o_orderdate").alias("paid_at"))
    identities = t.orders.filter("o_orderstatus <> 'P'").select(
        F.col("o_custkey").alias("wallet_id"), F.col("o_orderpriority").alias("tier"),
        F.col("o_orderdate").alias("effective_at"), F.col("o_orderkey").alias("identity_no"),
    )
    ledger = scratch_path(t.spark, "points-ledger")
    staged = scratch_path(t.spark, "points-staged")
    D.points_by_period(movements, payments, identities, days=60).write.parquet(staged)
    source = t.spark.read.parquet(staged)
    # the ledger already has the months before 1998, too low for one tier and too high for the others
    known = F.when(F.col("tier") == "1-URGENT", F.col("points") - 500).otherwise(F.col("points") + 500)
    swap_in(source.filter("month < date'1998-01-01'").withColumn("points", known), ledger)
    merged = merge(
        read_table(t.spark, ledger), source, ["wallet_id", "month"],
        update={"points": lambda t, s: s("points"), "tier": lambda t, s: s("tier")},
        when=lambda t, s: s("points") > t("points"), insert=True,
    )
    swap_in(merged, ledger)
    return read_table(t.spark, ledger)


@query(
    "app_lifetime_rollforward",
    """
    WITH o AS (SELECT o_custkey, CASE o_orderpriority WHEN '4-NOT SPECIFIED' THEN '5-LOW' ELSE o_orderpriority END AS partner, CAST(floor(o_totalprice) AS BIGINT) AS points FROM orders)
    SELECT o_custkey, partner, CAST(sum(points) AS BIGINT) AS points FROM o GROUP BY 1, 2""",
)
def _(t: Tables):
    rows = t.orders.select("o_custkey", F.col("o_orderpriority").alias("partner"), F.floor("o_totalprice").alias("points"), "o_orderdate")
    split = F.col("o_orderdate") < at("2001-01-01")
    return D.lifetime_rollforward(
        rows.filter(split), rows.filter(~split), ["o_custkey", "partner"], "partner", {"4-NOT SPECIFIED": "5-LOW"}, "points"
    )


@query(
    "app_feature_timeseries",
    """
    WITH m AS (SELECT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS mth, count(*) AS n, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS spend FROM orders GROUP BY 1, 2),
    s AS (SELECT o_custkey, mth, n, spend, CAST(spend AS DOUBLE) AS sd, CASE WHEN c_acctbal = 0 THEN NULL ELSE CAST(spend AS DOUBLE) / (abs(c_acctbal) * 50) END AS util
          FROM m JOIN customer ON c_custkey = o_custkey)
    SELECT o_custkey, mth, round(util, 6) AS utilisation, round(sd - coalesce(lag(sd) OVER w, 0), 2) AS spend_delta, CAST(sum(n) OVER y AS BIGINT) AS n_12m,
      round(CAST(sum(spend) OVER h AS DOUBLE), 2) AS spend_6m, max(sd) OVER y AS max_spend_12m,
      round(CAST(sum(spend) OVER h AS DOUBLE) / nullif(CAST(sum(spend) OVER y AS DOUBLE), 0), 6) AS ratio_6m_12m,
      round((util - lag(util, 5) OVER w) / nullif(lag(util, 5) OVER w, 0), 6) AS util_change_6m, count(*) OVER y AS months_seen
    FROM s WINDOW w AS (PARTITION BY o_custkey ORDER BY mth), y AS (PARTITION BY o_custkey ORDER BY mth ROWS BETWEEN 11 PRECEDING AND CURRENT ROW),
      h AS (PARTITION BY o_custkey ORDER BY mth ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)""",
)
def _(t: Tables):
    monthly = t.orders.groupBy("o_custkey", F.trunc("o_orderdate", "MM").alias("mth")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(cents("o_totalprice")).alias("spend")
    )
    limit = (F.abs("c_acctbal") * 50).alias("limit")
    series = monthly.join(t.customer.select("c_custkey", limit), F.col("c_custkey") == F.col("o_custkey")).drop("c_custkey")
    return D.series_features(series, "o_custkey", "mth", "spend", "limit", "n").drop("n", "spend", "limit")


_MATRIX = ", ".join(f"max(CASE WHEN r = {i} THEN {v} END) AS {v}_t{i}" for v in ("n", "spent", "top") for i in range(5))


@query(
    "app_feature_matrix",
    f"""
    WITH g AS (SELECT user_id, date_trunc('week', ts) AS wk, count(*) AS n,
      CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS spent, max(value) AS top FROM events GROUP BY 1, 2),
    w AS (SELECT *, dense_rank() OVER (PARTITION BY user_id ORDER BY wk DESC) - 1 AS r FROM g)
    SELECT user_id, {_MATRIX} FROM w GROUP BY user_id""",
)
def _(t: Tables):
    week = F.trunc("ts", "week")
    weekly = t.events.groupBy("user_id", week.alias("wk")).agg(
        F.count(F.lit(1)).alias("n"), amount_sum("value").alias("spent"), F.max("value").alias("top")
    )
    return latest_to_wide(weekly, ["user_id"], "wk", ["n", "spent", "top"], 5)


# attribute -> ascending (upper bound, points); invented for the example
_BINS = {
    "mean_order": [(210000.0, 12), (270000.0, 25), (None, 40)],
    "n_orders": [(7.0, 33), (13.0, 21), (None, 9)],
    "urgent_share": [(0.2, 50), (None, 15)],
}


@query(
    "app_scorecard_points",
    """
    WITH f AS (SELECT o_custkey, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total, count(*) FILTER (o_orderpriority = '1-URGENT') AS u FROM orders GROUP BY 1)
    SELECT o_custkey, CAST(CASE WHEN total < 500000 OR total > 5000000 THEN 1 ELSE
      (CASE WHEN total / n <= 210000 THEN 12 WHEN total / n <= 270000 THEN 25 ELSE 40 END) + (CASE WHEN n <= 7 THEN 33 WHEN n <= 13 THEN 21 ELSE 9 END)
      + (CASE WHEN u / n <= 0.2 THEN 50 ELSE 15 END) END AS BIGINT) AS score FROM f""",
)
def _(t: Tables):
    features = t.orders.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n_orders"), amount_sum("o_totalprice").alias("total"),
        F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("urgent"),
    ).withColumns({"mean_order": F.col("total") / F.col("n_orders"), "urgent_share": F.col("urgent") / F.col("n_orders")})
    outlier = (F.col("total") < 500000) | (F.col("total") > 5000000)
    return D.scorecard(features, _BINS, outlier).select("o_custkey", "score")


@query(
    "app_area_risk_rank",
    """
    WITH f AS (SELECT c_nationkey, c_mktsegment, c_custkey, CASE WHEN c_acctbal > 9500 THEN 2 WHEN c_acctbal < 0 THEN 1 ELSE 0 END AS flag FROM customer),
    a AS (SELECT c_nationkey, c_mktsegment, count(DISTINCT c_custkey) AS total_accounts, CAST(sum(flag) AS BIGINT) AS total_bad FROM f WHERE flag <> 2 GROUP BY 1, 2)
    SELECT c_nationkey, c_mktsegment, total_accounts, total_bad, round(total_bad / total_accounts, 6) AS bad_rate,
      CAST(CASE WHEN total_bad / total_accounts > 0.125 THEN 99 WHEN total_bad <= 0 THEN 1 ELSE ceil(total_bad / total_accounts / 0.0075) END AS BIGINT) AS area_rank FROM a""",
)
def _(t: Tables):
    flag = F.when(F.col("c_acctbal") > 9500, 2).when(F.col("c_acctbal") < 0, 1).otherwise(0)
    areas = (
        t.customer.withColumn("flag", flag).filter("flag <> 2").groupBy("c_nationkey", "c_mktsegment")
        .agg(F.count_distinct("c_custkey").alias("total_accounts"), F.sum("flag").alias("total_bad"))
    )
    rate = F.try_divide(F.col("total_bad").cast("double"), F.col("total_accounts").cast("double"))
    return areas.withColumns({"bad_rate": F.round(rate, 6), "area_rank": capped_grade(rate, 0.125, 0.0075)})


@query(
    "app_hash_bucket",
    "SELECT c_custkey, CAST(('0x' || substr(md5(CAST(c_custkey AS VARCHAR)), 1, 15)) AS BIGINT) % 10000 AS bucket FROM customer",
)
def _(t: Tables):
    return t.customer.select("c_custkey", stable_bucket("c_custkey", 10000).alias("bucket"))


@query(
    "app_merge_survivor_history",
    """
    WITH RECURSIVE e AS (SELECT c_custkey // 2 AS survivor, c_custkey AS victim, CAST(TIMESTAMP '2000-01-01' + INTERVAL (c_nationkey) DAY AS TIMESTAMP) AS merged_at FROM customer WHERE c_custkey > 0),
    chain AS (SELECT survivor, victim, merged_at, 1 AS depth FROM e UNION ALL
      SELECT e.survivor, c.victim, c.merged_at, c.depth + 1 FROM chain c JOIN e ON c.survivor = e.victim WHERE c.depth < 10),
    v AS (SELECT o_custkey, o_orderpriority, o_orderdate AS f, lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderpriority) AS u
      FROM (SELECT DISTINCT o_custkey, o_orderpriority, o_orderdate FROM orders)),
    h AS (SELECT * FROM v UNION SELECT survivor, o_orderpriority, f, coalesce(u, merged_at) FROM chain JOIN v ON victim = o_custkey)
    SELECT o_custkey, count(*) AS n_intervals, min(f) AS first_from FROM h WHERE o_orderpriority = '1-URGENT' AND year(f) <= 1998 AND (u IS NULL OR year(u) >= 1998) GROUP BY 1""",
)
def _(t: Tables):
    edges = t.customer.filter("c_custkey > 0").select(
        F.expr("c_custkey div 2").alias("survivor"), F.col("c_custkey").alias("victim"),
        (at("2000-01-01") + F.make_dt_interval(days=F.col("c_nationkey"))).alias("merged_at"),
    )
    history = D.survivor_history(t.orders, edges, "o_custkey", "o_orderpriority", "o_orderdate")
    open_in = (F.year("effective_from") <= 1998) & (F.col("effective_to").isNull() | (F.year("effective_to") >= 1998))
    return history.filter((F.col("o_orderpriority") == "1-URGENT") & open_in).groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n_intervals"), F.min("effective_from").alias("first_from")
    )


_FREQUENCIES = {"AUTOMOBILE": "once", "BUILDING": "weekly", "FURNITURE": "bi-weekly", "HOUSEHOLD": "monthly"}


@query(
    "app_next_occurrence",
    f"""
    WITH f AS (SELECT c_custkey, c_mktsegment, CAST(max(o_orderdate) AS DATE) AS d FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY 1, 2)
    SELECT c_custkey, d AS first_on, CASE c_mktsegment WHEN 'AUTOMOBILE' THEN CASE WHEN d >= DATE '{AS_OF}' THEN d END
      WHEN 'BUILDING' THEN CASE WHEN d >= DATE '{AS_OF}' THEN d ELSE d + CAST(ceil((DATE '{AS_OF}' - d) / 7.0) * 7 AS INT) END
      WHEN 'FURNITURE' THEN CASE WHEN d >= DATE '{AS_OF}' THEN d ELSE d + CAST(ceil((DATE '{AS_OF}' - d) / 14.0) * 14 AS INT) END
      WHEN 'HOUSEHOLD' THEN CASE WHEN d >= DATE '{AS_OF}' THEN d WHEN day(d) >= 15 THEN DATE '1998-06-15' + CAST(day(d) - 15 AS INT)
        ELSE DATE '1998-07-15' + CAST(day(d) - 15 AS INT) END END AS next_date FROM f""",
)
def _(t: Tables):
    first = t.orders.groupBy("o_custkey").agg(F.to_date(F.max("o_orderdate")).alias("first_on"))
    plans = t.customer.join(first, F.col("o_custkey") == F.col("c_custkey")).select(
        "c_custkey", "first_on", case_map("c_mktsegment", _FREQUENCIES).alias("frequency")
    )
    return D.next_transfer(plans, "first_on", "frequency", AS_OF).drop("frequency")


@query(
    "app_burndown_forecast",
    f"""
    WITH g AS (SELECT c_nationkey, CAST(sum(CASE WHEN o_orderstatus = 'P' THEN CAST(o_totalprice AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) / 1000000 AS remaining,
      CAST(sum(CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) / 100000 / date_diff('day', min(o_orderdate), max(o_orderdate)) AS per_day
      FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1),
    r AS (SELECT *, DATE '{AS_OF}' + CAST(ceil(remaining / per_day) AS INT) AS completed_on FROM g),
    d AS (SELECT c_nationkey, remaining, per_day, completed_on, unnest(range(0, least(completed_on - DATE '{AS_OF}', 365) + 1)) AS i FROM r)
    SELECT c_nationkey, completed_on, DATE '{AS_OF}' + CAST(i AS INT) AS event_day, round(greatest(remaining - per_day * i, 0), 4) AS "left" FROM d
    WHERE i % 7 = 0 OR DATE '{AS_OF}' + CAST(i AS INT) = completed_on""",
)
def _(t: Tables):
    amount = lambda s: amount_sum(F.when(F.col("o_orderstatus") == s, F.col("o_totalprice")).otherwise(0.0))
    span = F.datediff(F.max("o_orderdate"), F.min("o_orderdate"))
    rates = (
        t.orders.join(t.customer, F.col("c_custkey") == F.col("o_custkey")).groupBy("c_nationkey")
        .agg((amount("P") / 1000000).alias("remaining"), (amount("F") / 100000 / span).alias("per_day"))
    )
    done = F.date_add(F.lit(AS_OF), F.ceil(F.col("remaining") / F.col("per_day")).cast("int"))
    return D.burndown_forecast(rates.withColumn("completed_on", done), AS_OF)


@query(
    "app_cumulative_flow",
    """
    WITH w AS (SELECT CAST(unnest(generate_series(TIMESTAMP '2024-01-08', TIMESTAMP '2024-01-29', INTERVAL 7 DAY)) AS TIMESTAMP) AS point),
    u AS (SELECT DISTINCT user_id FROM events),
    s AS (SELECT u.user_id // 10 AS team, u.user_id, w.point, arg_max(event_type, (e.ts, e.event_id)) AS event_type FROM u CROSS JOIN w JOIN events e ON e.user_id = u.user_id AND e.ts <= w.point GROUP BY 1, 2, 3),
    f AS (SELECT DISTINCT team, event_type FROM s)
    SELECT f.team, w.point, f.event_type, count(s.user_id) AS n FROM f CROSS JOIN w LEFT JOIN s ON s.team = f.team AND s.point = w.point AND s.event_type = f.event_type GROUP BY 1, 2, 3""",
)
def _(t: Tables):
    changes = t.events.withColumn("team", F.expr("user_id div 10"))
    return D.cumulative_flow(changes, "team", "user_id", "ts", "event_type", ["event_id"], "2024-01-08", "2024-01-29", "7 day")


@query(
    "app_changelog_initial",
    """
    WITH c AS (SELECT user_id AS issue_key, ts, event_id, props, event_type FROM events WHERE user_id IN (SELECT c_custkey FROM customer))
    SELECT issue_key, ts AS event_time, props AS from_value, event_type AS to_value FROM c
    UNION ALL SELECT issue_key, TIMESTAMP '1990-01-01', NULL, arg_min(props, (ts, event_id)) FROM c GROUP BY issue_key
    UNION ALL SELECT c_custkey, TIMESTAMP '1990-01-01', NULL, c_mktsegment FROM customer WHERE c_custkey NOT IN (SELECT issue_key FROM c)""",
)
def _(t: Tables):
    issues = t.customer.select(F.col("c_custkey").alias("issue_key"), at("1990-01-01").alias("created"), F.col("c_mktsegment").alias("value"))
    changes = t.events.select(
        F.col("user_id").alias("issue_key"), F.col("ts").alias("event_time"), "event_id", F.col("props").alias("from_value"), F.col("event_type").alias("to_value")
    )
    return D.with_creation_events(issues, changes, "event_id")


@query(
    "app_limits_unpivot",
    """
    WITH m AS (SELECT o_custkey, max(o_totalprice) AS daily, max(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END) AS weekly, max(CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice END) AS monthly
      FROM orders GROUP BY 1)
    SELECT o_custkey, period, amount FROM m UNPIVOT (amount FOR period IN (daily AS 'DAILY', weekly AS 'WEEKLY', monthly AS 'MONTHLY'))""",
)
def _(t: Tables):
    price = F.col("o_totalprice")
    limits = t.orders.select(
        "o_custkey", price.alias("daily"), F.when(F.col("o_orderstatus") == "F", price).alias("weekly"),
        F.when(F.col("o_orderpriority") == "1-URGENT", price).alias("monthly"),
    )
    return D.period_limits(limits, "o_custkey", {"daily": "DAILY", "weekly": "WEEKLY", "monthly": "MONTHLY"})


@query(
    "app_eligibility_purge_list",
    f"""
    WITH j AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'F' AND o_orderdate < CAST(DATE '{AS_OF}' - INTERVAL 24 MONTH AS TIMESTAMP) THEN 'CLOSED AND OLD' WHEN o_orderstatus = 'P' THEN 'DECLINED' ELSE 'NOT FOUND' END AS reason,
      CASE WHEN o_orderstatus = 'O' AND o_orderdate >= TIMESTAMP '2001-01-01' THEN 1 ELSE 0 END AS purge_ind FROM orders)
    SELECT o_orderkey, o_custkey, reason FROM j WHERE o_custkey NOT IN (SELECT o_custkey FROM j WHERE purge_ind = 1)
      AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 9000)""",
)
def _(t: Tables):
    old = F.col("o_orderdate") < F.add_months(F.lit(AS_OF), -24).cast("timestamp_ntz")
    reasons = [((F.col("o_orderstatus") == "F") & old, "CLOSED AND OLD"), (F.col("o_orderstatus") == "P", "DECLINED")]
    active = (F.col("o_orderstatus") == "O") & (F.col("o_orderdate") >= at("2001-01-01"))
    listed = t.customer.filter("c_acctbal > 9000").select("c_custkey")
    return D.purge_list(t.orders, listed, "o_custkey", reasons, "NOT FOUND", active).select("o_orderkey", "o_custkey", "reason")


@query(
    "app_cri_evaluation",
    f"""
    WITH a AS (SELECT c_custkey, CAST(min(o_orderdate) AS DATE) AS opened, CASE WHEN c_acctbal < 0 THEN DATE '{AS_OF}' END AS closed, c_acctbal < -100 AS zero_balance
      FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey, c_acctbal),
    e AS (SELECT c_custkey, opened, CASE WHEN coalesce(closed = DATE '{AS_OF}' AND zero_balance, false) THEN 'closure' ELSE 'anniversary' END AS event,
      CASE WHEN opened >= DATE '1996-01-01' THEN '0.40' ELSE '0.60' END AS threshold FROM a
      WHERE coalesce(closed = DATE '{AS_OF}' AND zero_balance, false) OR (closed IS NULL AND month(opened) = 6 AND day(opened) = 15)),
    x AS (SELECT o_custkey, sum(CASE WHEN l_returnflag = 'A' THEN CAST(l_extendedprice AS DECIMAL(18,2)) ELSE 0 END) AS fees,
      sum(CASE WHEN l_returnflag = 'N' THEN CAST(l_extendedprice AS DECIMAL(18,2)) ELSE 0 END) AS purchases FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1)
    SELECT c_custkey, opened, event, threshold, CAST(fees AS DOUBLE) AS fees, CAST(purchases AS DOUBLE) AS purchases,
      coalesce(CAST(fees AS DOUBLE) / nullif(CAST(purchases AS DOUBLE), 0) > CAST(threshold AS DOUBLE), false) AS breach FROM e LEFT JOIN x ON o_custkey = c_custkey""",
)
def _(t: Tables):
    opened = t.orders.groupBy("o_custkey").agg(F.to_date(F.min("o_orderdate")).alias("opened"))
    accounts = t.customer.join(opened, F.col("o_custkey") == F.col("c_custkey")).select(
        "c_custkey", "opened", F.when(F.col("c_acctbal") < 0, F.lit(AS_OF)).alias("closed"), (F.col("c_acctbal") < -100).alias("zero_balance")
    )
    due = settled(D.evaluation_events(accounts, AS_OF, date(1996, 1, 1), "0.60", "0.40"), "due")
    # only the orders of due accounts meet their lines; amounts are summed per order before that
    classes = case_map("l_returnflag", {"A": "fee", "N": "purchase"})
    amount = lambda k: F.sum(F.when(F.col("class") == k, cents("l_extendedprice")).otherwise(0))
    per_order = t.lineitem.withColumn("class", classes).groupBy("l_orderkey").agg(amount("fee").alias("f"), amount("purchase").alias("p"))
    charges = (
        t.orders.join(due, F.col("o_custkey") == F.col("c_custkey"), "left_semi")
        .join(per_order, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("o_custkey")
        .agg((F.sum("f") / 100).alias("fees"), (F.sum("p") / 100).alias("purchases"))
    )
    breach = F.coalesce(F.try_divide("fees", "purchases") > F.col("threshold").cast("double"), F.lit(False))
    return due.join(charges, F.col("o_custkey") == F.col("c_custkey"), "left").select(
        "c_custkey", "opened", "event", "threshold", "fees", "purchases", breach.alias("breach")
    )


@query(
    "app_aml_transaction_feed",
    """
    WITH f AS (SELECT 'order' AS rail, 'O' || CAST(o_orderkey AS VARCHAR) AS txn_id, o_custkey AS party_id, o_totalprice AS amount, CAST(o_orderdate AS DATE) AS txn_day, o_orderstatus AS status FROM orders
      UNION ALL SELECT 'card', 'L' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-' || CAST(l_partkey AS VARCHAR), o_custkey, l_extendedprice, CAST(l_shipdate AS DATE), NULL
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_returnflag <> 'R'
      UNION ALL SELECT 'event', 'E' || CAST(event_id AS VARCHAR), user_id, value, CAST(ts AS DATE), NULL FROM events WHERE event_type = 'purchase')
    SELECT rail, txn_id, party_id, amount, txn_day, status, n_name AS country FROM f LEFT JOIN customer ON c_custkey = party_id LEFT JOIN nation ON n_nationkey = c_nationkey""",
)
def _(t: Tables):
    layout = ["txn_id", "party_id", "amount", "txn_day", "status"]
    cards = t.lineitem.filter("l_returnflag <> 'R'").join(t.orders.select("o_orderkey", "o_custkey"), F.col("o_orderkey") == F.col("l_orderkey"))
    rails = {
        "order": (t.orders, {"txn_id": "concat('O', o_orderkey)", "party_id": "o_custkey", "amount": "o_totalprice", "txn_day": "date(o_orderdate)", "status": "o_orderstatus"}),
        "card": (cards, {"txn_id": "concat('L', l_orderkey, '-', l_linenumber, '-', l_partkey)", "party_id": "o_custkey", "amount": "l_extendedprice", "txn_day": "date(l_shipdate)"}),
        "event": (t.events.filter("event_type = 'purchase'"), {"txn_id": "concat('E', event_id)", "party_id": "user_id", "amount": "value", "txn_day": "date(ts)"}),
    }
    feed = D.unified_feed(rails, layout)
    parties = t.customer.join(t.nation, F.col("n_nationkey") == F.col("c_nationkey"), "left").select(
        F.col("c_custkey").alias("party_id"), F.col("n_name").alias("country")
    )
    return feed.join(parties, "party_id", "left").select("rail", *layout, "country")


@query(
    "app_statement_sequence",
    """
    WITH c AS (SELECT l_orderkey AS k, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS record_seq,
        'D' || CAST(l_linenumber AS VARCHAR) || '/' || CAST(l_partkey AS VARCHAR) AS text FROM lineitem),
    l AS (SELECT o_orderkey AS k, strftime(o_orderdate, '%Y%m') AS cycle, 0 AS record_seq, 'P' || CAST(o_custkey AS VARCHAR) AS text FROM orders
      UNION ALL SELECT c.k, strftime(o_orderdate, '%Y%m'), c.record_seq, c.text FROM c JOIN orders ON o_orderkey = c.k)
    SELECT k, cycle, CAST(record_seq AS BIGINT) AS record_seq, text FROM l UNION ALL
    SELECT NULL, cycle, 0, 'T' || lpad(CAST(count(*) AS VARCHAR), 11, '0') || lpad(CAST(count(*) FILTER (record_seq = 0) AS VARCHAR), 11, '0') FROM l GROUP BY cycle""",
)
def _(t: Tables):
    parents = t.orders.select(
        F.col("o_orderkey").alias("k"), F.date_format("o_orderdate", "yyyyMM").alias("cycle"), F.concat(F.lit("P"), F.col("o_custkey").cast("string")).alias("text")
    )
    children = t.lineitem.select(
        F.col("l_orderkey").alias("k"), "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
        F.concat(F.lit("D"), F.col("l_linenumber").cast("string"), F.lit("/"), F.col("l_partkey").cast("string")).alias("text"),
    )
    order = [F.col(c) for c in ("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")]
    return D.statement_lines(parents, children, "k", "cycle", order)


@query(
    "app_regulatory_extract",
    """
    SELECT sha256(CAST(user_id AS VARCHAR)) AS depositor_hash, regexp_replace(event_type || ' 12', '[a-zA-Z0-9]', 'X', 'g') AS masked_name, DATE '1900-01-01' AS birth_date,
      CAST(event_id AS VARCHAR) AS reference FROM events WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)""",
)
def _(t: Tables):
    loads = latest_load(t.events.withColumn("load_date", F.to_date("ts")), "load_date")
    return loads.select(
        sha256_hex("user_id").alias("depositor_hash"), mask_alnum(F.concat("event_type", F.lit(" 12"))).alias("masked_name"),
        F.lit("1900-01-01").cast("date").alias("birth_date"), F.col("event_id").cast("string").alias("reference"),
    )


@query(
    "app_eod_balance_snapshot",
    f"""
    WITH s AS (SELECT o_custkey, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS status FROM orders WHERE CAST(o_orderdate AS DATE) <= DATE '{AS_OF}' GROUP BY 1),
    b AS (SELECT o_custkey, o_orderdate, o_orderkey, o_totalprice FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')),
    c AS (SELECT o_custkey, arg_max(o_totalprice, (o_orderdate, o_orderkey)) AS closing FROM b WHERE CAST(o_orderdate AS DATE) <= DATE '{AS_OF}' GROUP BY 1),
    p AS (SELECT o_custkey, arg_max(o_totalprice, (o_orderdate, o_orderkey)) AS opening FROM b WHERE CAST(o_orderdate AS DATE) <= DATE '{AS_OF}' - 1 GROUP BY 1)
    SELECT s.o_custkey AS account_id, status, c_name AS holder, closing, opening FROM s JOIN customer ON c_custkey = s.o_custkey
    LEFT JOIN c ON c.o_custkey = s.o_custkey LEFT JOIN p ON p.o_custkey = s.o_custkey""",
)
def _(t: Tables):
    rows = t.orders.select(
        F.col("o_custkey").alias("account_id"), F.col("o_orderdate").alias("at"), F.col("o_orderkey").alias("no"),
        F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("balance"), "o_orderpriority",
    )
    accounts = t.customer.select(F.col("c_custkey").alias("account_id"), F.col("c_name").alias("holder"))
    return D.end_of_day(accounts, rows, rows.filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")), "account_id", AS_OF)


_STATES = {"signup": "new", "view": "pending", "click": "Pending", "purchase": "DONE", "error": "FAILED"}


@query(
    "app_reminder_eligibility",
    """
    SELECT user_id, status, reminders FROM (
      SELECT user_id, ts, CASE event_type WHEN 'signup' THEN 'new' WHEN 'view' THEN 'pending' WHEN 'click' THEN 'Pending' WHEN 'purchase' THEN 'DONE' ELSE 'FAILED' END AS status,
        CAST(json_extract_string(props, '$.k') AS BIGINT) AS reminders FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)
    WHERE status = 'new' OR (upper(status) = 'PENDING' AND reminders < 50 AND ts <= TIMESTAMP '2024-01-30 06:00:00')""",
)
def _(t: Tables):
    states = t.events.select(
        "user_id", case_map("event_type", _STATES).alias("status"), F.col("ts").alias("changed_at"), F.col("event_id").alias("state_no"),
        F.get_json_object("props", "$.k").cast("long").alias("reminders"),
    )
    return D.reminder_list(states, "user_id", "2024-01-30 12:00:00", 50, 6).select("user_id", "status", "reminders")


@query(
    "app_identity_verification",
    """
    WITH f AS (SELECT l_orderkey, max(CASE WHEN a = 'AF' THEN 1 ELSE 0 END) AS af, max(CASE WHEN a = 'AO' THEN 1 ELSE 0 END) AS ao, max(CASE WHEN a = 'NF' THEN 1 ELSE 0 END) AS nf,
      max(CASE WHEN a = 'NO' THEN 1 ELSE 0 END) AS no, max(CASE WHEN a = 'RF' THEN 1 ELSE 0 END) AS rf, max(CASE WHEN a = 'RO' THEN 1 ELSE 0 END) AS ro
      FROM (SELECT l_orderkey, l_returnflag || l_linestatus AS a FROM lineitem) GROUP BY 1)
    SELECT l_orderkey, CASE WHEN ro = 1 THEN 'single' WHEN (af = 1 AND no = 1) OR (ao = 1 AND nf = 1) OR (rf = 1 AND nf = 1) OR (af = 1 AND rf = 1) THEN 'dual' ELSE 'none' END AS source,
      CASE WHEN ro = 1 THEN 'credit file' WHEN (af = 1 AND no = 1) OR (ao = 1 AND nf = 1) THEN 'two trades' WHEN (rf = 1 AND nf = 1) OR (af = 1 AND rf = 1) THEN 'trade and statement' ELSE 'exception' END AS method FROM f""",
)
def _(t: Tables):
    attributes = t.lineitem.select("l_orderkey", F.concat("l_returnflag", "l_linestatus").alias("name"))
    dual = [("two trades", [("AF", "NO"), ("AO", "NF")]), ("trade and statement", [("RF", "NF"), ("AF", "RF")])]
    return D.verification_decisions(attributes, "l_orderkey", "name", {"credit file": ["RO"]}, dual)


@query(
    "app_case_linking",
    """
    SELECT 'note' AS kind, user_id AS customer_id FROM events WHERE event_type = 'error' AND value > 60
    UNION SELECT 'note', o_custkey FROM events JOIN orders ON o_orderkey = event_id WHERE event_type = 'error' AND value < 5
    UNION SELECT 'alert', o_custkey FROM orders WHERE o_orderstatus = 'P' AND o_totalprice > 450000
    UNION SELECT 'attachment', o_custkey FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_returnflag = 'R' AND l_quantity > 49""",
)
def _(t: Tables):
    none = F.lit(None).cast("long")
    item = lambda df, no, customer, account: df.select(no.alias("item_id"), customer.alias("customer_id"), account.alias("account_id"))
    errors = t.events.filter("event_type = 'error' and (value > 60 or value < 5)")
    items = {
        "note": item(errors, F.col("event_id"), F.when(F.col("value") > 60, F.col("user_id")), F.when(F.col("value") < 5, F.col("event_id"))),
        "alert": item(t.orders.filter("o_orderstatus = 'P' and o_totalprice > 450000"), F.col("o_orderkey"), none, F.col("o_orderkey")),
        "attachment": item(t.lineitem.filter("l_returnflag = 'R' and l_quantity > 49"), F.col("l_linenumber").cast("long"), none, F.col("l_orderkey")),
    }
    accounts = t.orders.select(F.col("o_orderkey").alias("account_id"), F.col("o_custkey").alias("customer_id"))
    return D.derived_cases(items, accounts)


@query(
    "app_missing_reward_transactions",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey AS merchant_id, l_shipdate, l_extendedprice FROM lineitem
    WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_nationkey < 8) AND l_discount < 0.03""",
)
def _(t: Tables):
    columns = ["l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "l_extendedprice"]
    transactions = t.lineitem.select(*columns, F.col("l_suppkey").alias("merchant_id"))
    merchants = t.supplier.filter("s_nationkey < 8").select(F.col("s_suppkey").alias("merchant_id"))
    rewards = t.lineitem.filter("l_discount >= 0.03").select(*[F.col(c).alias(f"r_{c}") for c in columns])
    return D.missing_rewards(transactions, merchants, rewards, [(c, f"r_{c}") for c in columns])


@query(
    "app_business_day_shift",
    """
    SELECT o_orderkey, CAST(o_orderdate AS DATE) + CASE dayofweek(o_orderdate) WHEN 0 THEN 1 WHEN 6 THEN 2 ELSE 0 END AS settlement_day FROM orders""",
)
def _(t: Tables):
    return t.orders.select("o_orderkey", business_day("o_orderdate").alias("settlement_day"))


@query(
    "app_event_latest_failure",
    """
    WITH e AS (SELECT CAST(user_id AS VARCHAR) || '-' || json_extract_string(props, '$.k') AS request, event_id, ts, event_type FROM events)
    SELECT request, event_id, event_type AS name FROM e WHERE request NOT IN (SELECT request FROM e WHERE event_type = 'purchase')
    QUALIFY row_number() OVER (PARTITION BY request ORDER BY ts DESC, event_id DESC) = 1""",
)
def _(t: Tables):
    events = t.events.select(
        F.concat_ws("-", F.col("user_id").cast("string"), F.get_json_object("props", "$.k")).alias("request"), "event_id", "ts",
        F.when(F.col("event_type") == "purchase", "SUCCESSFUL").otherwise("FAILED").alias("status"),
        F.concat(F.lit("com.example."), "event_type").alias("name"),
    )
    return D.open_failures(events, "request", "SUCCESSFUL", [F.desc("ts"), F.desc("event_id")], "name").select("request", "event_id", "name")


_CHAIN = {
    "join": [{"table": "customer", "columns": ["c_mktsegment"], "on": [("o_custkey", "c_custkey")], "how": "left"}],
    "add": ["cast(round(o_totalprice * 100) as bigint) as cents"],
    "drop": ["o_totalprice"],
    "time_columns": ["o_orderdate"],
}


@query(
    "load_table_chain",
    """
    SELECT c_mktsegment, o_orderkey, o_custkey, o_orderstatus, (o_orderdate AT TIME ZONE 'UTC') AT TIME ZONE 'America/Toronto' AS o_orderdate, o_orderpriority,
      CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders LEFT JOIN customer ON c_custkey = o_custkey WHERE c_mktsegment = 'BUILDING' AND o_orderstatus <> 'P'""",
)
def _(t: Tables):
    config = {**_CHAIN, "filters": ["c_mktsegment = 'BUILDING'", "o_orderstatus <> 'P'"]}
    return run_chain(t.orders, config, {"customer": t.customer}, TABLE_LOAD)


@query(
    "load_file_chain",
    """
    SELECT o_custkey, c_mktsegment, (o_orderdate AT TIME ZONE 'UTC') AT TIME ZONE 'America/Toronto' AS o_orderdate, CAST(round(o_totalprice * 100) AS BIGINT) AS cents
    FROM orders LEFT JOIN customer ON c_custkey = o_custkey QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
)
def _(t: Tables):
    config = {
        **_CHAIN,
        "dedup": ["o_custkey"],
        "dedup_order": ["o_orderdate desc", "o_orderkey desc"],
        "target": ["o_custkey", "c_mktsegment", "o_orderdate", "cents"],
    }
    return run_chain(t.orders, config, {"customer": t.customer}, FILE_LOAD)


@query(
    "load_segment_job",
    """
    SELECT 'O' AS segment, o_orderkey AS k, CAST(round(o_totalprice * 100) AS BIGINT) * 2 AS doubled, c_mktsegment AS owner, (SELECT count(*) FROM orders) AS n_rows
    FROM orders LEFT JOIN customer ON c_custkey = o_orderkey
    UNION ALL SELECT 'S', s_suppkey, CAST(round(s_acctbal * 100) AS BIGINT) * 2, NULL, (SELECT count(*) FROM supplier) FROM supplier""",
)
def _(t: Tables):
    """An inbound file with two segments and a trailer is checked, transformed, written and recorded."""
    inbox, targets = scratch_path(t.spark, "inbound"), scratch_path(t.spark, "loaded")
    line = lambda df, seg, key, amount: df.select(F.format_string("%s%012d%015d", F.lit(seg), key, cents(amount)).alias("line"))
    orders, suppliers = t.orders.agg(F.count(F.lit(1)).alias("a")), t.supplier.agg(F.count(F.lit(1)).alias("b"))
    trailer = orders.crossJoin(F.broadcast(suppliers)).select(F.format_string("T20240101%012d%012d", "a", "b").alias("line"))
    whole = line(t.orders, "O", "o_orderkey", "o_totalprice").unionByName(line(t.supplier, "S", "s_suppkey", "s_acctbal"))
    whole.unionByName(trailer).write.text(inbox)
    body = parse_layout(["k:2:12:0:L:long", "cents:14:15:0:L:long"])
    steps = {"add": ["cents * 2 as doubled"], "drop": ["cents"], "time_columns": [], "dedup": ["k"], "dedup_order": ["doubled"]}
    owner = [{"table": "customer", "columns": ["c_mktsegment"], "on": [("k", "c_custkey")], "how": "left"}]
    segments = {
        "O": Segment(body, f"{targets}/orders", {**steps, "join": owner}, "n_orders"),
        "S": Segment(body, f"{targets}/suppliers", steps, "n_suppliers", mode="refresh"),
    }
    layout = parse_layout(["file_day:2:8: :R:string", "n_orders:10:12:0:L:long", "n_suppliers:22:12:0:L:long"])
    control = load_segment_file(
        t.spark, inbox, segments, "T", Segment(layout, f"{targets}/trailers"), ["file_day"], f"{targets}/control",
        "run-1", datetime(2024, 1, 1, 6), {"customer": t.customer},
    )
    a = t.spark.read.parquet(f"{targets}/orders").select(F.lit("O").alias("segment"), "k", "doubled", F.col("c_mktsegment").alias("owner"))
    b = t.spark.read.parquet(f"{targets}/suppliers").select(F.lit("S").alias("segment"), "k", "doubled", F.lit(None).cast("string").alias("owner"))
    return a.unionByName(b).join(control.select("segment", "n_rows"), "segment")
