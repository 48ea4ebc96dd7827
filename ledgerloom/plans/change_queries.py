"""Table changes over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.functions import key_hash
from ledgerloom.operators import changes as C
from ledgerloom.plans.registry import Tables, query
from ledgerloom.session import scratch_path
from ledgerloom.sources import tables as W

_LEDGER_SQL = """
    WITH t AS (SELECT o_custkey AS customer_id, CAST(sum(CAST(floor(o_totalprice) AS BIGINT)) AS BIGINT) AS points, CAST(max(o_orderdate) AS DATE) AS update_dt
               FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01' GROUP BY 1),
         s AS (SELECT o_custkey AS customer_id, CAST(sum(CAST(floor(o_totalprice) AS BIGINT)) AS BIGINT) AS points, CAST(max(o_orderdate) AS DATE) AS update_dt
               FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01' GROUP BY 1)"""


def ledgers(t: Tables):
    """Stored points per customer, and newly computed ones."""
    split = F.lit("1998-01-01").cast("timestamp_ntz")

    def points(df):
        return df.groupBy(F.col("o_custkey").alias("customer_id")).agg(
            F.sum(F.floor("o_totalprice")).alias("points"), F.to_date(F.max("o_orderdate")).alias("update_dt")
        )

    return points(t.orders.filter(F.col("o_orderdate") < split)), points(t.orders.filter(F.col("o_orderdate") >= split))


@query(
    "dml_merge_upsert",
    _LEDGER_SQL + """
    SELECT coalesce(t.customer_id, s.customer_id) AS customer_id, coalesce(s.points, t.points) AS points, coalesce(s.update_dt, t.update_dt) AS update_dt
    FROM t FULL JOIN s ON t.customer_id = s.customer_id""",
)
def _(t: Tables):
    """Into a stored table in fifty partitions, of which only those that the source touches are written."""
    part = (F.col("customer_id") % 50).cast("int").alias("part")
    target, source = (df.select("*", part) for df in ledgers(t))
    path = scratch_path(t.spark, "ledger")
    W.full_refresh(target, path, ["part"])
    rules = {"points": lambda t, s: s("points"), "update_dt": lambda t, s: s("update_dt")}
    W.merge_into(t.spark, path, source, ["customer_id"], ["part"], update=rules, insert=True)
    return W.read_table(t.spark, path).drop("part")


@query(
    "dml_merge_conditional",
    _LEDGER_SQL + """
    SELECT coalesce(t.customer_id, s.customer_id) AS customer_id,
           CASE WHEN t.customer_id IS NULL OR s.points > t.points THEN s.points ELSE t.points END AS points,
           CASE WHEN t.customer_id IS NULL OR s.points > t.points THEN s.update_dt ELSE t.update_dt END AS update_dt
    FROM t FULL JOIN s ON t.customer_id = s.customer_id""",
)
def _(t: Tables):
    target, source = ledgers(t)
    return C.merge(
        target, source, ["customer_id"],
        update={"points": lambda t, s: s("points"), "update_dt": lambda t, s: s("update_dt")},
        when=lambda t, s: s("points") > t("points"), insert=True,
    )


@query(
    "dml_merge_additive",
    _LEDGER_SQL + """
    SELECT coalesce(t.customer_id, s.customer_id) AS customer_id, coalesce(t.points, 0) + coalesce(s.points, 0) AS points,
           coalesce(s.update_dt, t.update_dt) AS update_dt FROM t FULL JOIN s ON t.customer_id = s.customer_id""",
)
def _(t: Tables):
    target, source = ledgers(t)
    return C.merge(
        target, source, ["customer_id"],
        update={"points": lambda t, s: s("points") + t("points"), "update_dt": lambda t, s: s("update_dt")}, insert=True,
    )


@query(
    "dml_merge_insert_only",
    """
    WITH t AS (SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'),
         s AS (SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderdate >= TIMESTAMP '1997-06-01')
    SELECT * FROM t UNION ALL SELECT * FROM s WHERE o_orderkey NOT IN (SELECT o_orderkey FROM t)""",
)
def _(t: Tables):
    kept = t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    day = lambda d: F.lit(d).cast("timestamp_ntz")
    target = kept.filter(F.col("o_orderdate") < day("1998-01-01")).drop("o_orderdate")
    source = kept.filter(F.col("o_orderdate") >= day("1997-06-01")).drop("o_orderdate")
    return C.insert_absent(target, source, lambda df: key_hash(["o_orderkey", "o_custkey"], "|"))


@query(
    "dml_merge_update_only",
    """
    SELECT c_custkey, c_name, CAST(coalesce(last_day, c_since) AS DATE) AS c_since
    FROM (SELECT c_custkey, c_name, DATE '1990-01-01' AS c_since FROM customer)
    LEFT JOIN (SELECT o_custkey, CAST(max(o_orderdate) AS DATE) AS last_day FROM orders GROUP BY 1) ON o_custkey = c_custkey""",
)
def _(t: Tables):
    target = t.customer.select("c_custkey", "c_name", F.lit("1990-01-01").cast("date").alias("c_since"))
    source = (
        t.orders.groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.to_date(F.max("o_orderdate")).alias("last_day"))
    )
    return C.merge(target, source, ["c_custkey"], update={"c_since": lambda t, s: s("last_day")})


@query(
    "dml_cdc_hash_replace",
    """
    WITH h AS (SELECT *, base64(from_hex(md5(CAST(o_custkey AS VARCHAR) || o_orderstatus))) AS cdc_hash FROM orders),
         t AS (SELECT o_orderkey, o_custkey, o_orderstatus, cdc_hash FROM h WHERE o_orderdate < TIMESTAMP '1998-01-01'),
         s AS (SELECT o_orderkey, o_custkey, o_orderstatus, cdc_hash FROM h WHERE o_orderdate >= TIMESTAMP '1998-01-01')
    SELECT * FROM t WHERE cdc_hash NOT IN (SELECT cdc_hash FROM s) UNION ALL SELECT * FROM s""",
)
def _(t: Tables):
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    day = lambda d: F.lit(d).cast("timestamp_ntz")
    keys = ["o_custkey", "o_orderstatus"]
    stored = rows.filter(F.col("o_orderdate") < day("1998-01-01")).drop("o_orderdate")
    incoming = rows.filter(F.col("o_orderdate") >= day("1998-01-01")).drop("o_orderdate")
    return C.cdc_hash_replace(stored.withColumn("cdc_hash", key_hash(keys)), incoming, keys)


@query(
    "dml_update_where",
    """
    SELECT o_orderkey, CASE WHEN o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0) AND o_orderstatus = 'P'
           THEN 'H' ELSE o_orderstatus END AS o_orderstatus FROM orders""",
)
def _(t: Tables):
    held = t.customer.filter("c_acctbal < 0")
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus")
    return C.update_where_in(
        rows, held, "o_custkey", "c_custkey", {"o_orderstatus": F.lit("H")}, also=F.col("o_orderstatus") == "P"
    ).drop("o_custkey")


@query(
    "dml_update_not_in",
    """
    SELECT c_custkey, CASE WHEN c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 450000) THEN 'SMALL' ELSE c_mktsegment END AS c_mktsegment
    FROM customer""",
)
def _(t: Tables):
    big = t.orders.filter("o_totalprice > 450000")
    rows = t.customer.select("c_custkey", "c_mktsegment")
    return C.update_where_not_in(rows, big, "c_custkey", "o_custkey", {"c_mktsegment": F.lit("SMALL")})


@query(
    "dml_delete_filter",
    """
    SELECT event_id, user_id, k FROM (SELECT event_id, user_id, CASE WHEN event_type = 'error' THEN NULL ELSE value END AS k FROM events)
    WHERE NOT coalesce(k > 20, false)""",
)
def _(t: Tables):
    """From a stored table by day; days without such rows keep their files."""
    amount = F.when(F.col("event_type") != "error", F.col("value")).alias("k")
    path = scratch_path(t.spark, "events")
    W.full_refresh(t.events.select("event_id", "user_id", amount, F.to_date("ts").alias("day")), path, ["day"])
    W.delete_rows(t.spark, path, ["day"], F.col("k") > 20)
    return W.read_table(t.spark, path).drop("day")


@query(
    "dml_delete_in_chain",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem WHERE l_orderkey NOT IN (
      SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0))""",
)
def _(t: Tables):
    purge = t.customer.filter("c_acctbal < 0")
    kept = C.delete_in_chain(
        t.lineitem, [(t.orders, "o_orderkey", "o_custkey"), (None, "l_orderkey", None)], purge, "c_custkey"
    )
    return kept.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query(
    "dml_current_history_roll",
    """
    SELECT o_custkey, o_orderdate, o_orderkey, CASE WHEN row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
           THEN 'current' ELSE 'history' END AS kind FROM orders""",
)
def _(t: Tables):
    rows = t.orders.select("o_custkey", "o_orderdate", "o_orderkey")
    split = F.lit("1999-01-01").cast("timestamp_ntz")
    current, history = C.roll_current(
        rows.filter(F.col("o_orderdate") < split), rows.filter(F.col("o_orderdate") >= split),
        ["o_custkey"], ["o_orderdate", "o_orderkey"],
    )
    return current.withColumn("kind", F.lit("current")).unionByName(history.withColumn("kind", F.lit("history")))


@query(
    "dml_one_current_per_key",
    """
    SELECT o_custkey, 'current' AS kind, max(o_orderkey) AS detail FROM orders GROUP BY 1
    UNION ALL SELECT o_custkey, 'several', count(*) FROM orders GROUP BY 1 HAVING count(*) > 1""",
)
def _(t: Tables):
    current, several = C.one_current(t.orders, ["o_custkey"], [F.desc("o_orderkey")])
    return current.select("o_custkey", F.lit("current").alias("kind"), F.col("o_orderkey").alias("detail")).unionByName(
        several.select("o_custkey", F.lit("several").alias("kind"), F.col("n_rows").alias("detail"))
    )


#: event type -> change type; a type that is not listed has none (fixed values of the example)
CHANGE_TYPES = {"signup": "I", "click": "U", "purchase": "U", "error": "D"}


def change_rows(t: Tables):
    from ledgerloom.operators.shaping import case_map

    return t.events.select(
        "user_id", "event_id", "ts", "value", case_map("event_type", CHANGE_TYPES).alias("optype")
    )


LATEST_STATE_SQL = """
    SELECT user_id, event_id, value, optype FROM (
      SELECT *, CASE event_type WHEN 'signup' THEN 'I' WHEN 'click' THEN 'U' WHEN 'purchase' THEN 'U' WHEN 'error' THEN 'D' END AS optype
      FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1) WHERE optype <> 'D'"""


@query("dml_cdc_latest_state", LATEST_STATE_SQL)
def _(t: Tables):
    latest = C.cdc_latest_state(change_rows(t), ["user_id"], [F.desc("ts"), F.desc("event_id")])
    return latest.select("user_id", "event_id", "value", "optype")


@query(
    "dml_flag_missing_from_snapshot",
    """
    SELECT s_suppkey, CASE WHEN s_acctbal < 1000 AND status <> 'CLOSED' THEN 'DEACTIVATED' WHEN s_acctbal >= 1000 AND status = 'CLOSED' THEN 'REOPENED' ELSE status END AS status
    FROM (SELECT s_suppkey, s_acctbal, CASE WHEN s_nationkey < 12 THEN 'ACTIVE' ELSE 'CLOSED' END AS status FROM supplier)""",
)
def _(t: Tables):
    stored = t.supplier.select("s_suppkey", F.when(F.col("s_nationkey") < 12, "ACTIVE").otherwise("CLOSED").alias("status"))
    snapshot = t.supplier.filter("s_acctbal >= 1000").select(F.col("s_suppkey").alias("k"))
    return C.flag_missing(stored, snapshot, "s_suppkey", "k", "status", "DEACTIVATED", "REOPENED", ["CLOSED"])


@query(
    "dml_fill_null_from_column",
    "SELECT event_id, coalesce(CASE WHEN event_type = 'view' THEN NULL ELSE value END, CAST(user_id AS DOUBLE)) AS amount FROM events",
)
def _(t: Tables):
    amount = F.when(F.col("event_type") != "view", F.col("value"))
    return t.events.select("event_id", F.coalesce(amount, F.col("user_id").cast("double")).alias("amount"))


@query(
    "dml_partition_int_range",
    "SELECT CAST(p_size // 10 * 10 AS BIGINT) AS bucket, count(*) AS n, max(p_size) AS largest FROM part WHERE p_size >= 0 AND p_size < 100 GROUP BY 1",
)
def _(t: Tables):
    path = scratch_path(t.spark, "int-range")
    W.full_refresh(W.int_range_bucket(t.part, "p_size", 0, 100, 10), path, partition_by=["bucket"])
    back = W.read_table(t.spark, path)
    return back.groupBy(F.col("bucket").cast("long").alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"), F.max("p_size").alias("largest")
    )


@query("dml_backup_copy", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def _(t: Tables):
    table, backup = scratch_path(t.spark, "supplier"), scratch_path(t.spark, "backup")
    W.full_refresh(t.supplier, table)
    W.copy_table(t.spark, table, backup)
    W.swap_in(C.delete_where(W.read_table(t.spark, table), F.col("s_acctbal") < 0), table)
    W.copy_table(t.spark, backup, table)
    return W.read_table(t.spark, table)


@query(
    "dml_schema_evolve",
    """
    SELECT CAST(c_custkey AS VARCHAR) AS account_id, c_name AS name, CAST(c_acctbal AS DECIMAL(12,2))::DOUBLE AS balance, CAST(NULL AS VARCHAR) AS segment
    FROM customer WHERE c_nationkey < 10
    UNION ALL SELECT CAST(c_custkey AS VARCHAR), c_name, CAST(c_acctbal AS DECIMAL(12,2))::DOUBLE, c_mktsegment FROM customer WHERE c_nationkey >= 10""",
)
def _(t: Tables):
    old = t.customer.filter("c_nationkey < 10").select("c_custkey", "c_name", "c_acctbal")
    new = t.customer.filter("c_nationkey >= 10").select(
        F.col("c_custkey").alias("account_id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment")
    )
    evolved = C.evolve(
        old, new, {"account_id": "string", "balance": "decimal(12,2)"},
        {"c_custkey": "account_id", "c_name": "name", "c_acctbal": "balance"},
    )
    return evolved.withColumn("balance", F.col("balance").cast("double"))


@query(
    "dml_rebuild_partitioned",
    "SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS ship_month, count(*) AS n, max(l_shipdate) AS last_day FROM lineitem GROUP BY 1",
)
def _(t: Tables):
    path = scratch_path(t.spark, "by-month")
    W.full_refresh(t.lineitem.withColumn("ship_month", F.trunc("l_shipdate", "MM")), path, partition_by=["ship_month"])
    return W.read_table(t.spark, path).groupBy("ship_month").agg(
        F.count(F.lit(1)).alias("n"), F.max("l_shipdate").alias("last_day")
    )


@query(
    "dml_recluster",
    """
    SELECT o_orderkey, o_custkey, o_orderdate, 0 AS overlapping_files, true AS rewritten, false AS rewritten_again FROM orders""",
)
def _(t: Tables):
    """The rows with what the files themselves say of their layout, and whether there was anything to do."""
    path = scratch_path(t.spark, "clustered")
    W.full_refresh(t.orders, path)
    rewritten, again = (W.recluster(t.spark, path, ["o_custkey", "o_orderdate"]) for _ in range(2))
    rows = W.read_table(t.spark, path)
    overlaps = W.overlapping_files(rows, "o_custkey").agg(F.count(F.lit(1)).cast("int").alias("overlapping_files"))
    return rows.select("o_orderkey", "o_custkey", "o_orderdate").crossJoin(F.broadcast(overlaps)).withColumns(
        {"rewritten": F.lit(rewritten), "rewritten_again": F.lit(again)}
    )
