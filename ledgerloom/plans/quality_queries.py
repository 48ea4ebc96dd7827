"""Data quality, comparison, reconciliation and load control over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.functions import cents
from ledgerloom.operators import changes as C
from ledgerloom.operators import compare as X
from ledgerloom.operators import operations as P
from ledgerloom.operators import quality as Q
from ledgerloom.operators.aggregates import duplicates
from ledgerloom.operators.shaping import case_map
from ledgerloom.plans.registry import Tables, query

money = lambda c: F.col(c).cast("decimal(18,2)")


@query(
    "dq_required_columns",
    """
    SELECT * FROM (VALUES ('C_CUSTKEY', true), ('c_mktsegment', true), ('c_phone', false)) v(column_name, present)
    JOIN (SELECT count(c_custkey) AS a, count(c_mktsegment) AS b FROM customer) ON true
    """.replace("SELECT * FROM", "SELECT column_name, present, CASE column_name WHEN 'C_CUSTKEY' THEN a WHEN 'c_mktsegment' THEN b ELSE 0 END AS n_values FROM"),
)
def _(t: Tables):
    return Q.required_columns(t.customer, ["C_CUSTKEY", "c_mktsegment", "c_phone"])


_APPLICATIONS_SQL = """
    WITH a AS (SELECT o_orderkey AS application_id, CASE WHEN o_orderstatus = 'P' THEN NULL WHEN o_orderpriority = '5-LOW' THEN '  ' ELSE o_orderpriority END AS channel,
      CASE WHEN o_totalprice < 20000 THEN NULL ELSE o_custkey END AS customer_id, strftime(o_orderdate, '%Y%m%d') AS day_txt,
      o_totalprice AS amount, o_orderdate FROM orders)"""


def applications(t: Tables):
    """Order rows with NULL and blank fields, as an inbound file would have them."""
    channel = F.when(F.col("o_orderstatus") != "P", F.when(F.col("o_orderpriority") == "5-LOW", "  ").otherwise(F.col("o_orderpriority")))
    return t.orders.select(
        F.col("o_orderkey").alias("application_id"), channel.alias("channel"),
        F.when(F.col("o_totalprice") >= 20000, F.col("o_custkey")).alias("customer_id"),
        F.date_format("o_orderdate", "yyyyMMdd").alias("day_txt"), F.col("o_totalprice").alias("amount"), "o_orderdate",
    )


@query(
    "dq_mandatory_counts",
    _APPLICATIONS_SQL + """
    SELECT count(*) AS total_rows, count(*) FILTER (channel IS NULL OR customer_id IS NULL) AS null_violations, count(*) FILTER (trim(channel) = '') AS empty_violations,
           count(*) FILTER (channel IS NULL OR trim(channel) = '' OR customer_id IS NULL) AS total_violations,
           count(*) FILTER (channel IS NULL OR trim(channel) = '' OR customer_id IS NULL) = 0 AS is_valid FROM a""",
)
def _(t: Tables):
    return Q.mandatory_counts(applications(t), ["CHANNEL", "customer_id"])


@query(
    "dq_violation_rows",
    _APPLICATIONS_SQL + """
    SELECT application_id, CASE WHEN channel IS NULL OR customer_id IS NULL THEN 'NULL_VIOLATION' ELSE 'EMPTY_VIOLATION' END AS violation_type
    FROM a WHERE channel IS NULL OR customer_id IS NULL OR trim(channel) = '' ORDER BY application_id LIMIT 100""",
)
def _(t: Tables):
    found = Q.violations(applications(t), ["channel", "customer_id"]).select("application_id", "violation_type")
    return found.orderBy("application_id").limit(100)


@query(
    "dq_date_int_format",
    """
    WITH a AS (SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN strftime(o_orderdate, '%Y') || '1332' WHEN '2-HIGH' THEN 'n/a'
      WHEN '3-MEDIUM' THEN '09' || strftime(o_orderdate, '%y%m%d') WHEN '5-LOW' THEN NULL ELSE strftime(o_orderdate, '%Y%m%d') END AS d FROM orders)
    SELECT o_orderkey, CASE WHEN d IS NULL THEN NULL WHEN TRY_CAST(d AS BIGINT) IS NULL THEN 'not a number'
      WHEN CAST(d AS BIGINT) NOT BETWEEN 10000101 AND 99991231 THEN 'out of range' WHEN try_strptime(d, '%Y%m%d') IS NULL THEN 'not a date' END AS problem FROM a""",
)
def _(t: Tables):
    day = F.date_format("o_orderdate", "yyyyMMdd")
    raw = (
        F.when(F.col("o_orderpriority") == "1-URGENT", F.concat(F.date_format("o_orderdate", "yyyy"), F.lit("1332")))
        .when(F.col("o_orderpriority") == "2-HIGH", "n/a")
        .when(F.col("o_orderpriority") == "3-MEDIUM", F.concat(F.lit("09"), F.date_format("o_orderdate", "yyMMdd")))
        .when(F.col("o_orderpriority") != "5-LOW", day)
    )
    return t.orders.select("o_orderkey", raw.alias("d")).select("o_orderkey", Q.date_int_problem("d").alias("problem"))


@query(
    "dq_rule_set_first_error",
    _APPLICATIONS_SQL + """
    SELECT application_id, CASE WHEN NOT coalesce(trim(channel) <> '', false) THEN 'channel is required' WHEN customer_id IS NULL THEN 'customer is required'
      WHEN NOT amount <= 400000 THEN 'amount is too large' END AS error FROM a""",
)
def _(t: Tables):
    rules = [
        (F.trim("channel") != "", "channel is required"),
        (F.col("customer_id").isNotNull(), "customer is required"),
        (F.col("amount") <= 400000, "amount is too large"),
    ]
    valid, invalid = Q.split_valid(applications(t).select("application_id", "channel", "customer_id", "amount"), rules)
    return invalid.select("application_id", "error").unionByName(
        valid.select("application_id", F.lit(None).cast("string").alias("error"))
    )


@query(
    "dq_trailer_count",
    """
    SELECT l_returnflag AS segment, CAST(count(*) + CASE l_returnflag WHEN 'R' THEN 1 ELSE 0 END AS BIGINT) AS n_expected, count(*) AS n_rows,
           CASE l_returnflag WHEN 'R' THEN 'Mismatch' ELSE 'Match' END AS status FROM lineitem GROUP BY 1""",
)
def _(t: Tables):
    body = t.lineitem.select(F.col("l_returnflag").alias("segment"))
    one_off = F.when(F.col("segment") == "R", 1).otherwise(0)
    trailer = body.groupBy("segment").agg(F.count(F.lit(1)).alias("n")).select("segment", (F.col("n") + one_off).alias("n"))
    return Q.trailer_counts(body, trailer, "segment", "n")


@query(
    "dq_trailer_duplicate",
    """
    WITH trailers AS (SELECT CAST(ts AS DATE) AS file_day, count(*) AS n FROM events GROUP BY 1)
    SELECT file_day, n, file_day < DATE '2024-01-20' AS already_loaded FROM trailers""",
)
def _(t: Tables):
    trailers = t.events.groupBy(F.to_date("ts").alias("file_day")).agg(F.count(F.lit(1)).alias("n"))
    loaded = t.events.select(F.to_date("ts").alias("file_day")).filter("file_day < date'2024-01-20'")
    seen = trailers.join(loaded, "file_day", "left_semi").withColumn("already_loaded", F.lit(True))
    return seen.unionByName(trailers.join(loaded, "file_day", "left_anti").withColumn("already_loaded", F.lit(False)))


@query(
    "dq_totals_match",
    """
    SELECT count(*) AS n_rows, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total, 'Match' AS count_status, 'Mismatch' AS total_status, 'Mismatch' AS validation_status FROM orders""",
)
def _(t: Tables):
    summary = t.orders.agg(F.count(F.lit(1)).alias("slips"), (F.sum(cents("o_totalprice")) / 100 + 1).alias("amount"))
    return Q.totals_match(t.orders, summary, "o_totalprice", "slips", "amount")


@query("dq_duplicate_key", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def _(t: Tables):
    return duplicates(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(
    "dq_luhn_check",
    """
    WITH d AS (SELECT o_orderkey, CAST(o_orderkey * 7919 + o_custkey AS VARCHAR) AS sin FROM orders),
    s AS (SELECT o_orderkey, sin, list_sum(list_transform(range(1, length(sin) + 1), lambda i: CASE WHEN (length(sin) - i) % 2 = 0 THEN CAST(sin[i:i] AS INT)
      ELSE (CAST(sin[i:i] AS INT) * 2) // 10 + (CAST(sin[i:i] AS INT) * 2) % 10 END)) AS total FROM d)
    SELECT o_orderkey, sin, CASE WHEN total % 10 = 0 THEN 'Valid' ELSE 'Invalid' END AS mod10_status FROM s""",
)
def _(t: Tables):
    sin = (F.col("o_orderkey") * 7919 + F.col("o_custkey")).cast("string")
    return t.orders.select("o_orderkey", sin.alias("sin")).withColumn("mod10_status", Q.mod10("sin"))


@query(
    "dq_threshold_gate",
    """
    SELECT count(*) AS n_exceptions, CASE WHEN count(*) = 0 THEN 'skip' WHEN count(*) > 100 THEN 'fail' ELSE 'continue' END AS decision
    FROM customer WHERE c_acctbal < -900""",
)
def _(t: Tables):
    return Q.gate(t.customer.filter("c_acctbal < -900"), 100)


@query(
    "dq_file_date_order",
    """
    SELECT (SELECT max(CAST(ts AS DATE)) FROM events WHERE event_type = 'error') AS incoming_date,
           (SELECT max(CAST(ts AS DATE)) FROM events WHERE event_type <> 'error') AS loaded_date,
           (SELECT max(CAST(ts AS DATE)) FROM events WHERE event_type = 'error') >= (SELECT max(CAST(ts AS DATE)) FROM events WHERE event_type <> 'error') AS accepted""",
)
def _(t: Tables):
    days = t.events.select("event_type", F.to_date("ts").alias("d"))
    return Q.not_older_than_loaded(days.filter("event_type = 'error'"), days.filter("event_type <> 'error'"), "d")


# Second side of the comparisons: pending orders have not arrived, urgent ones differ by 1.
_SIDES_SQL = """
    WITH s AS (SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders WHERE o_orderdate >= TIMESTAMP '1995-06-01'),
         t AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
                      '  ' || lower(o_orderpriority) || ' ' AS o_orderpriority FROM orders WHERE o_orderstatus <> 'P'),
         j AS (SELECT coalesce(s.o_orderkey, t.o_orderkey) AS o_orderkey, CASE WHEN s.o_orderkey IS NULL THEN 'MISSING_IN_SOURCE'
                 WHEN t.o_orderkey IS NULL THEN 'MISSING_IN_TARGET' WHEN s.o_totalprice <> t.o_totalprice THEN 'MISMATCH' END AS status,
                 s.o_totalprice AS a, t.o_totalprice AS b FROM s FULL JOIN t ON s.o_orderkey = t.o_orderkey)"""


def sides(t: Tables):
    source = t.orders.filter(F.col("o_orderdate") >= F.lit("1995-06-01").cast("timestamp_ntz"))
    price = F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    target = t.orders.filter("o_orderstatus <> 'P'").select(
        "o_orderkey", "o_custkey", price.alias("o_totalprice"),
        F.concat(F.lit("  "), F.lower("o_orderpriority"), F.lit(" ")).alias("o_orderpriority"),
    )
    return source.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority"), target


_BY_TYPE = {"string": ["TRIM(column)", "UPPER(column)"]}


@query(
    "cmp_schema_diff",
    """
    SELECT * FROM (VALUES ('o_custkey', 'bigint', 'int', 'DATA_TYPE_MISMATCH'), ('o_orderdate', 'timestamp_ntz', NULL, 'COLUMN_MISSING_IN_TARGET'),
      ('o_total', NULL, 'double', 'COLUMN_MISSING_IN_SOURCE'), ('o_totalprice', 'double', NULL, 'COLUMN_MISSING_IN_TARGET'))
      AS v(column_name, source_type, target_type, discrepancy)
    CROSS JOIN (SELECT count(*) AS n_rows FROM orders)""",
)
def _(t: Tables):
    target = t.orders.select(
        "o_orderkey", F.col("o_custkey").cast("int").alias("o_custkey"), "o_orderstatus", F.col("o_totalprice").alias("o_total"), "o_orderpriority"
    )
    rows = X.schema_diff(t.orders, target)
    found = t.spark.createDataFrame(rows, "column_name string, source_type string, target_type string, discrepancy string")
    return found.crossJoin(F.broadcast(t.orders.agg(F.count(F.lit(1)).alias("n_rows"))))


@query(
    "cmp_row_diff",
    _SIDES_SQL + """
    SELECT o_orderkey, status AS record_comparison_status, CASE status WHEN 'MISSING_IN_SOURCE' THEN 'record_status:MISSING_IN_SOURCE'
      WHEN 'MISSING_IN_TARGET' THEN 'record_status:MISSING_IN_TARGET' ELSE 'o_totalprice' END AS details,
      CASE WHEN status = 'MISMATCH' THEN a END AS source_price, CASE WHEN status = 'MISMATCH' THEN b END AS target_price FROM j WHERE status IS NOT NULL""",
)
def _(t: Tables):
    source, target = sides(t)
    report, _ = X.compare(source, target, ["o_orderkey"], by_type=_BY_TYPE)
    d = F.col("differing_column_details")
    text = F.array_join(
        F.transform(d, lambda x: F.when(x["column_name"] == "record_status",
            F.concat(x["column_name"], F.lit(":"), F.coalesce(x["source_original_value"], x["target_original_value"]))).otherwise(x["column_name"])), ","
    )
    price = lambda side: F.get(F.filter(d, lambda x: x["column_name"] == "o_totalprice"), F.lit(0))[side].cast("double")
    return report.select(
        "o_orderkey", "record_comparison_status", text.alias("details"),
        price("source_transformed_value").alias("source_price"), price("target_original_value").alias("target_price"),
    )


@query(
    "cmp_counts",
    _SIDES_SQL + """
    SELECT count(*) FILTER (status = 'MISMATCH') AS n_mismatch, count(*) FILTER (status = 'MISSING_IN_SOURCE') AS n_missing_in_source,
           count(*) FILTER (status = 'MISSING_IN_TARGET') AS n_missing_in_target FROM j""",
)
def _(t: Tables):
    source, target = sides(t)
    return X.compare(source, target, ["o_orderkey"], by_type=_BY_TYPE)[1]


@query(
    "cmp_column_expressions",
    """
    SELECT c_custkey, 'MISMATCH' AS record_comparison_status FROM customer WHERE round(c_acctbal, 0) <> round(c_acctbal + 0.4, 0)""",
)
def _(t: Tables):
    source = t.customer.select("c_custkey", "c_name", "c_acctbal")
    target = t.customer.select("c_custkey", F.upper(F.concat("c_name", F.lit(" "))).alias("c_name"), (F.col("c_acctbal") + 0.4).alias("c_acctbal"))
    report = X.row_diff(
        source, target, ["c_custkey"], by_column={"c_acctbal": ["ROUND(column, 0)"]},
        by_type={"string": ["COALESCE(column, '')", "UPPER(TRIM(column))"], "numeric": ["column * 0"]},
    )
    return report.select("c_custkey", "record_comparison_status")


@query(
    "cmp_compare_columns",
    """
    SELECT 'c_custkey' AS keys, 'c_name,c_mktsegment' AS compared, count(*) FILTER (c_nationkey < 3) AS n_mismatch FROM customer""",
)
def _(t: Tables):
    segment = F.when(F.col("c_nationkey") < 3, "CHANGED").otherwise(F.col("c_mktsegment"))
    target = t.customer.select("c_custkey", "c_name", segment.alias("c_mktsegment"), (F.col("c_acctbal") + 1).alias("c_acctbal"))
    chosen = X.compared_columns(t.customer, target, ["c_custkey"], exclude=["c_acctbal"])
    report = X.row_diff(t.customer, target, ["c_custkey"], exclude=["c_acctbal"])
    return X.diff_counts(report).select(
        F.lit("c_custkey").alias("keys"), F.lit(",".join(chosen)).alias("compared"), "n_mismatch"
    )


@query(
    "cmp_snapshot_delta",
    """
    WITH p AS (SELECT s_suppkey, s_name, s_acctbal FROM supplier WHERE s_nationkey <> 4),
         c AS (SELECT s_suppkey, s_name, CASE WHEN s_acctbal < 0 THEN 0 ELSE s_acctbal END AS s_acctbal FROM supplier WHERE s_nationkey <> 9)
    SELECT coalesce(c.s_suppkey, p.s_suppkey) AS s_suppkey, CASE WHEN p.s_suppkey IS NULL THEN 'insert' WHEN c.s_suppkey IS NULL THEN 'delete' ELSE 'update' END AS change,
           coalesce(c.s_name, p.s_name) AS s_name, coalesce(c.s_acctbal, p.s_acctbal) AS s_acctbal
    FROM p FULL JOIN c ON p.s_suppkey = c.s_suppkey WHERE p.s_suppkey IS NULL OR c.s_suppkey IS NULL OR p.s_acctbal <> c.s_acctbal""",
)
def _(t: Tables):
    rows = lambda balance, nation: t.supplier.filter(F.col("s_nationkey") != nation).select("s_suppkey", "s_name", balance.alias("s_acctbal"))
    b = F.col("s_acctbal")
    return X.snapshot_delta(rows(b, 4), rows(F.when(b < 0, 0.0).otherwise(b), 9), ["s_suppkey"])


@query(
    "cmp_anti_writeback",
    """
    SELECT c_custkey, c_name, 'NEW' AS status, 'compare_job' AS created_by FROM customer
    WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 420000)""",
)
def _(t: Tables):
    big = t.orders.filter("o_totalprice > 420000")
    return X.only_in(t.customer.select("c_custkey", "c_name"), big, [("c_custkey", "o_custkey")], status="NEW", created_by="compare_job")


@query(
    "recon_two_sided",
    """
    WITH a AS (SELECT o_orderkey AS reference, CAST(o_totalprice AS DECIMAL(18,2)) AS amount, o_custkey AS request FROM orders WHERE o_orderstatus <> 'P'),
         b AS (SELECT o_orderkey AS reference, CAST(CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice + 5 ELSE o_totalprice END AS DECIMAL(18,2)) AS amount,
                      CASE WHEN o_orderpriority = '2-HIGH' THEN o_custkey + 1 ELSE o_custkey END AS request FROM orders WHERE o_orderdate >= TIMESTAMP '1995-09-01')
    SELECT coalesce(a.reference, b.reference) AS reference, CAST(a.amount AS DOUBLE) AS our_amount, CAST(b.amount AS DOUBLE) AS their_amount,
      CASE WHEN b.reference IS NULL THEN 'MISSING_AT_NETWORK' WHEN a.reference IS NULL THEN 'MISSING_AT_LEDGER' WHEN a.amount <> b.amount THEN 'AMOUNT_MISMATCH'
           WHEN a.request <> b.request THEN 'REQUEST_MISMATCH' ELSE 'N/A' END AS exception_type FROM a FULL JOIN b ON a.reference = b.reference""",
)
def _(t: Tables):
    key = F.col("o_orderkey").alias("reference")
    ours = t.orders.filter("o_orderstatus <> 'P'").select(key, money("o_totalprice").alias("amount"), F.col("o_custkey").alias("request"))
    urgent, high = F.col("o_orderpriority") == "1-URGENT", F.col("o_orderpriority") == "2-HIGH"
    theirs = t.orders.filter(F.col("o_orderdate") >= F.lit("1995-09-01").cast("timestamp_ntz")).select(
        key,
        F.when(urgent, F.col("o_totalprice") + 5).otherwise(F.col("o_totalprice")).cast("decimal(18,2)").alias("amount"),
        F.when(high, F.col("o_custkey") + 1).otherwise(F.col("o_custkey")).alias("request"),
    )
    out = X.reconcile(ours, theirs, "reference", "amount", "request", "LEDGER", "NETWORK")
    return out.withColumns({c: F.col(c).cast("double") for c in ("our_amount", "their_amount")})


@query(
    "recon_missing_events",
    """
    SELECT DISTINCT user_id FROM events s WHERE event_type = 'signup' AND ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-25'
      AND NOT EXISTS (SELECT 1 FROM events e WHERE e.user_id = s.user_id AND e.event_type = 'purchase' AND e.value > 60)
      AND NOT EXISTS (SELECT 1 FROM events e WHERE e.user_id = s.user_id AND e.event_type = 'error' AND e.value > 120)""",
)
def _(t: Tables):
    day = lambda d: F.lit(d).cast("timestamp_ntz")
    issued = t.events.filter((F.col("event_type") == "signup") & F.col("ts").between(day("2024-01-05"), day("2024-01-25")))
    return X.missing_events(
        issued, t.events.filter("event_type = 'purchase' and value > 60"), t.events.filter("event_type = 'error' and value > 120"),
        "user_id", "user_id", "user_id",
    )


@query(
    "recon_copy_counts",
    """
    WITH a AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS chunk, count(*) AS n FROM orders GROUP BY 1),
         b AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS chunk, count(*) AS n FROM orders WHERE o_orderdate < TIMESTAMP '2001-03-10' GROUP BY 1)
    SELECT chunk, a.n AS n_source, coalesce(b.n, 0) AS n_copy, CASE WHEN b.n IS NULL THEN 'ERROR' WHEN a.n = b.n THEN 'SUCCESS' ELSE 'FAILED' END AS status
    FROM a LEFT JOIN b USING (chunk)""",
)
def _(t: Tables):
    copy = t.orders.filter(F.col("o_orderdate") < F.lit("2001-03-10").cast("timestamp_ntz"))
    return X.copy_counts(t.orders, copy, "o_orderdate", F.trunc("o_orderdate", "MM"))


# feed -> schedule, planned time and buffer in minutes (fixed values of the examples)
FREQUENCY = {"click": "daily", "view": "1-5", "signup": "mondays", "purchase": "monthly"}
PLANNED = {"click": "06:30", "view": "09:00", "signup": "12:00", "purchase": "21:00"}

_SCHEDULE_SQL = """
    WITH feeds AS (SELECT event_type AS table_name, max(ts) AS last_loaded_time, count(*) AS n FROM events GROUP BY 1),
    sch AS (SELECT table_name, CASE table_name WHEN 'click' THEN 'daily' WHEN 'view' THEN '1-5' WHEN 'signup' THEN 'mondays' WHEN 'purchase' THEN 'monthly' END AS frequency,
      CASE table_name WHEN 'click' THEN '06:30' WHEN 'view' THEN '09:00' WHEN 'signup' THEN '12:00' WHEN 'purchase' THEN '21:00' END AS planned FROM feeds),
    cal AS (SELECT CAST(unnest(generate_series((SELECT min(ts)::DATE FROM events), (SELECT max(ts)::DATE FROM events), INTERVAL 1 DAY)) AS DATE) AS calendar_date),
    agenda AS (SELECT table_name, calendar_date, frequency, strptime(strftime(calendar_date, '%Y-%m-%d') || ' ' || planned, '%Y-%m-%d %H:%M') AS planned_load_time,
      CASE frequency WHEN 'daily' THEN 'Y' WHEN '1-5' THEN CASE WHEN dayofweek(calendar_date) BETWEEN 1 AND 5 THEN 'Y' ELSE 'N' END
        WHEN 'mondays' THEN CASE WHEN dayofweek(calendar_date) = 1 THEN 'Y' ELSE 'N' END
        WHEN 'monthly' THEN CASE WHEN calendar_date = last_day(calendar_date) THEN 'Y' ELSE 'N' END END AS is_run_expected FROM sch CROSS JOIN cal WHERE frequency IS NOT NULL)"""


def feeds(t: Tables):
    """One row per event type with its newest time: the load log of a set of feeds."""
    return t.events.groupBy(F.col("event_type").alias("table_name")).agg(F.max("ts").alias("last_loaded_time"))


def agenda(t: Tables):
    schedules = feeds(t).select("table_name", case_map("table_name", FREQUENCY).alias("frequency"), case_map("table_name", PLANNED).alias("planned"))
    days = t.events.agg(F.to_date(F.min("ts")).alias("a"), F.to_date(F.max("ts")).alias("b")).select(
        F.explode(F.sequence("a", "b", F.expr("interval 1 day"))).alias("calendar_date")
    )
    return P.loading_agenda(schedules.filter("frequency is not null"), days, "planned")


@query("ops_loading_agenda", _SCHEDULE_SQL + " SELECT table_name, calendar_date, frequency, planned_load_time, is_run_expected FROM agenda")
def _(t: Tables):
    return agenda(t).select("table_name", "calendar_date", "frequency", "planned_load_time", "is_run_expected")


@query(
    "ops_freshness_upsert",
    """
    SELECT event_type AS table_name, max(ts) AS last_loaded_time FROM events WHERE event_type <> 'view' OR ts < TIMESTAMP '2024-01-15' GROUP BY 1""",
)
def _(t: Tables):
    loads = lambda df: df.groupBy(F.col("event_type").alias("table_name")).agg(F.max("ts").alias("last_loaded_time"))
    before = F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz")
    stored = loads(t.events.filter(before & (F.col("event_type") != "click")))
    arrived = loads(t.events.filter(~before & (F.col("event_type") != "view")))
    return C.merge(stored, arrived, ["table_name"], update={"last_loaded_time": lambda t, s: s("last_loaded_time")}, insert=True)


@query(
    "ops_freshness_status",
    _SCHEDULE_SQL + """
    , d AS (SELECT f.table_name, f.last_loaded_time, a.planned_load_time,
        abs(date_diff('minute', f.last_loaded_time, coalesce(a.planned_load_time, TIMESTAMP '2024-02-01 00:00:00'))) AS minutes_off
      FROM feeds f LEFT JOIN agenda a ON a.table_name = f.table_name AND a.is_run_expected = 'Y'
      QUALIFY row_number() OVER (PARTITION BY f.table_name ORDER BY minutes_off, a.planned_load_time) = 1)
    SELECT table_name, last_loaded_time, planned_load_time, minutes_off, CASE WHEN planned_load_time IS NOT NULL AND minutes_off <= 600 THEN 'On-Time' ELSE 'Delayed' END AS status FROM d""",
)
def _(t: Tables):
    due = agenda(t).filter("is_run_expected = 'Y'").select("table_name", "planned_load_time", F.lit(600).alias("buffer_in_minutes"))
    now = F.lit("2024-02-01").cast("timestamp_ntz")
    return P.freshness_status(feeds(t), due, ["table_name"], now).select(
        "table_name", "last_loaded_time", "planned_load_time", "minutes_off", "status"
    )


@query(
    "ops_missing_periods",
    """
    WITH cal AS (SELECT CAST(unnest(generate_series((SELECT min(o_orderdate) FROM orders), (SELECT max(o_orderdate) FROM orders), INTERVAL 1 DAY)) AS DATE) AS d),
    p AS (SELECT DISTINCT o_orderpriority FROM orders)
    SELECT o_orderpriority, d FROM p CROSS JOIN cal WHERE (month(d), day(d)) NOT IN ((12, 25), (1, 1))
      AND NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderpriority = p.o_orderpriority AND o_totalprice > 450000 AND CAST(o_orderdate AS DATE) = d)""",
)
def _(t: Tables):
    days = t.orders.agg(F.to_date(F.min("o_orderdate")).alias("a"), F.to_date(F.max("o_orderdate")).alias("b")).select(
        F.explode(F.sequence("a", "b", F.expr("interval 1 day"))).alias("d")
    )
    arrivals = t.orders.filter("o_totalprice > 450000").select("o_orderpriority", F.to_date("o_orderdate").alias("d"))
    expected = t.orders.select("o_orderpriority").distinct().crossJoin(F.broadcast(days))
    holidays = days.filter(((F.month("d") == 12) & (F.dayofmonth("d") == 25)) | ((F.month("d") == 1) & (F.dayofmonth("d") == 1)))
    return P.missing_periods(expected, arrivals, ["o_orderpriority"], holidays, "d")


@query(
    "ops_unprocessed_batches",
    """
    SELECT DISTINCT user_id, CAST(ts AS DATE) AS file_day FROM events e WHERE NOT EXISTS (
      SELECT 1 FROM events c WHERE c.user_id = e.user_id AND CAST(c.ts AS DATE) = CAST(e.ts AS DATE) AND c.event_type = 'purchase' AND c.value > 20)""",
)
def _(t: Tables):
    batches = t.events.select("user_id", F.to_date("ts").alias("file_day"), "event_type", "value")
    # a user's day counts as completed when it holds a larger purchase, as started otherwise
    done = (F.col("event_type") == "purchase") & (F.col("value") > 20)
    control = batches.select("user_id", "file_day", F.when(done, "C").otherwise("S").alias("status"))
    return P.unprocessed(batches, control, ["user_id", "file_day"])
