"""Projections, filters and reshaping over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.functions import (
    amount_sum,
    format_time,
    from_julian,
    hex_to_base64,
    hhmmss,
    mask_alnum,
    null_if_empty,
    null_if_sentinel,
    sha256_hex,
    split_at,
    to_julian,
)
from ledgerloom.operators import shaping as S
from ledgerloom.plans.registry import AS_OF, Tables, query

# segment name -> short code (fixed values of the examples)
SEGMENT_CODES = {"AUTOMOBILE": "AU", "BUILDING": "BU", "FURNITURE": "FU", "HOUSEHOLD": "HH"}


@query(
    "proj_add_drop_columns",
    """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate, o_orderpriority,
           CAST(round(o_totalprice * 100) AS BIGINT) AS total_cents, upper(o_orderstatus) || '-' || left(o_orderpriority, 1) AS tag
    FROM orders""",
)
def _(t: Tables):
    return S.add_drop_columns(
        t.orders,
        add=[
            "cast(round(o_totalprice * 100) as bigint) as total_cents",
            "concat(upper(o_orderstatus), '-', left(o_orderpriority, 1)) as tag",
        ],
        drop=["o_totalprice"],
    )


@query(
    "proj_rename_mapping",
    "SELECT c_custkey AS customer_id, c_name AS customer_name, c_nationkey, c_acctbal AS balance, c_mktsegment FROM customer",
)
def _(t: Tables):
    return S.rename_columns(
        t.customer,
        {"c_custkey": "customer_id", "c_name": "customer_name", "c_acctbal": "balance", "not_there": "x"},
    )


@query("proj_schema_sync", "SELECT p_brand, p_partkey, p_size FROM part")
def _(t: Tables):
    return S.sync_schema(t.part, ["p_brand", "p_partkey", "p_size"])


@query("proj_star_except", "SELECT * EXCLUDE (s_acctbal) FROM supplier")
def _(t: Tables):
    return t.supplier.drop("s_acctbal")


@query(
    "proj_local_time",
    """
    SELECT event_id, (ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/Toronto' AS ts,
           strftime((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/Toronto', '%Y-%m-%d') AS local_day
    FROM events""",
)
def _(t: Tables):
    return S.local_times(t.events.select("event_id", "ts"), columns=["ts"]).withColumn(
        "local_day", format_time("ts", "%Y-%m-%d")
    )


@query(
    "proj_constant_lineage",
    """
    SELECT s_suppkey, s_name, 'file-0001' AS file_uuid, CAST(42 AS BIGINT) AS execution_id, 'supplier_load' AS job_id,
           TIMESTAMP '1998-06-15 04:05:06' AS rec_load_timestamp FROM supplier""",
)
def _(t: Tables):
    return S.add_lineage(
        t.supplier.select("s_suppkey", "s_name"), file_uuid="file-0001", job_id="supplier_load"
    ).withColumns(
        {
            "execution_id": F.lit(42).cast("long"),
            "rec_load_timestamp": F.lit("1998-06-15 04:05:06").cast("timestamp_ntz"),
        }
    )


@query(
    "proj_nested_rename",
    """
    SELECT o_orderkey,
           '[{"plan":"' || o_orderpriority || '","terms":[{"state":"' || o_orderstatus ||
           '","dates":[{"on":"' || strftime(o_orderdate, '%Y-%m-%d') || '","customer":' || CAST(o_custkey AS VARCHAR) || '}]}]}]' AS rates
    FROM orders""",
)
def _(t: Tables):
    day = F.struct(F.date_format("o_orderdate", "yyyy-MM-dd").alias("date_txt"), F.col("o_custkey").alias("cust"))
    tier = F.struct(F.col("o_orderstatus").alias("status_cd"), F.array(day).alias("date_list"))
    source = t.orders.select(
        "o_orderkey",
        F.array(F.struct(F.col("o_orderpriority").alias("rate_cd"), F.array(tier).alias("tier_list"))).alias("raw"),
    )
    renamed = S.rename_nested(
        source,
        {
            "raw": "rates", "raw.rate_cd": "plan", "raw.tier_list": "terms", "raw.tier_list.status_cd": "state",
            "raw.tier_list.date_list": "dates", "raw.tier_list.date_list.date_txt": "on", "raw.tier_list.date_list.cust": "customer",
        },
    )
    return renamed.select("o_orderkey", F.to_json("rates").alias("rates"))


@query(
    "proj_case_map",
    """
    SELECT c_custkey, CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'AU' WHEN 'BUILDING' THEN 'BU' WHEN 'FURNITURE' THEN 'FU'
           WHEN 'HOUSEHOLD' THEN 'HH' ELSE 'ZZ' END AS segment_code FROM customer""",
)
def _(t: Tables):
    return t.customer.select(
        "c_custkey", S.case_map("c_mktsegment", SEGMENT_CODES, F.lit("ZZ")).alias("segment_code")
    )


@query(
    "proj_priority_case",
    """
    SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'NEGATIVE_BALANCE' WHEN c_mktsegment = 'MACHINERY' THEN 'EXCLUDED_SEGMENT'
           WHEN c_nationkey < 5 THEN 'EXCLUDED_NATION' ELSE 'ELIGIBLE' END AS reason FROM customer""",
)
def _(t: Tables):
    rules = [
        (F.col("c_acctbal") < 0, "NEGATIVE_BALANCE"),
        (F.col("c_mktsegment") == "MACHINERY", "EXCLUDED_SEGMENT"),
        (F.col("c_nationkey") < 5, "EXCLUDED_NATION"),
    ]
    return t.customer.select("c_custkey", S.priority_case(rules, "ELIGIBLE").alias("reason"))


@query(
    "proj_mask_pii",
    """
    SELECT doc_id, regexp_replace(text, '[a-zA-Z0-9]', 'X', 'g') AS masked, sha256(CAST(doc_id AS VARCHAR)) AS id_hash,
           DATE '1900-01-01' AS birth_date FROM documents""",
)
def _(t: Tables):
    return t.documents.select(
        "doc_id",
        mask_alnum("text").alias("masked"),
        sha256_hex("doc_id").alias("id_hash"),
        F.lit("1900-01-01").cast("date").alias("birth_date"),
    )


@query(
    "proj_empty_to_null",
    "SELECT page_id, nullif(regexp_extract(url, '[?](.*)$', 1), '') AS query_text FROM pages",
)
def _(t: Tables):
    raw = F.regexp_extract("url", "[?](.*)$", 1)
    return t.pages.select("page_id", raw.alias("query_text")).withColumn("query_text", null_if_empty("query_text"))


@query(
    "proj_sentinel_null",
    """
    SELECT c_custkey, CAST(nullif(TRY_CAST(CASE WHEN c_acctbal < 0 THEN '-999' WHEN c_mktsegment = 'BUILDING' THEN 'n/a'
           ELSE CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) END AS DECIMAL(18,2)), -999) * 2 AS DOUBLE) AS doubled
    FROM customer""",
)
def _(t: Tables):
    stored = (
        F.when(F.col("c_acctbal") < 0, "-999")
        .when(F.col("c_mktsegment") == "BUILDING", "n/a")
        .otherwise(F.col("c_acctbal").cast("decimal(18,2)").cast("string"))
    )
    return t.customer.select("c_custkey", stored.alias("stored")).select(
        "c_custkey", (null_if_sentinel("stored", -999, "decimal(18,2)") * 2).cast("double").alias("doubled")
    )


@query(
    "proj_regex_rewrite",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice,
           regexp_replace(lpad(CAST(l_orderkey AS VARCHAR), 11, '0') || strftime(l_shipdate, '%Y'), '^(.{11})19', '\\114') AS reference
    FROM lineitem""".replace("\\\\", "\\"),
)
def _(t: Tables):
    raw = F.concat(F.lpad(F.col("l_orderkey").cast("string"), 11, "0"), F.date_format("l_shipdate", "yyyy"))
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice",
        F.regexp_replace(raw, "^(.{11})19", "$114").alias("reference"),
    )


@query(
    "proj_julian_dates",
    """
    SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%j') AS BIGINT) AS julian, CAST(o_orderdate AS DATE) AS back,
           CAST(CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderdate END AS DATE) AS closed_on FROM orders""",
)
def _(t: Tables):
    stored = F.when(F.col("o_orderstatus") == "P", F.lit(0)).otherwise(F.col("julian"))
    return t.orders.select("o_orderkey", "o_orderstatus", to_julian("o_orderdate").alias("julian")).select(
        "o_orderkey", "julian", from_julian("julian").alias("back"), from_julian(stored).alias("closed_on")
    )


@query(
    "proj_hhmmss_int",
    """
    SELECT event_id, CASE WHEN strftime(ts, '%H%M%S') = '000000' THEN NULL ELSE strftime(ts, '%H:%M:%S') END AS posted_at
    FROM events""",
)
def _(t: Tables):
    return t.events.select("event_id", F.date_format("ts", "HHmmss").cast("long").alias("n")).select(
        "event_id", hhmmss("n").alias("posted_at")
    )


@query(
    "proj_split_positions",
    """
    SELECT p_partkey, nullif(split_part(raw, ',', 1), '') AS name, nullif(split_part(raw, ',', 2), '') AS brand,
           nullif(split_part(raw, ',', 4), '') AS size_txt, nullif(split_part(raw, ',', 9), '') AS absent
    FROM (SELECT p_partkey, p_name || ',' || CASE WHEN p_type = 'ECONOMY' THEN '' ELSE p_brand END || ',' || p_type || ',' ||
                 CAST(p_size AS VARCHAR) AS raw FROM part)""",
)
def _(t: Tables):
    brand = F.when(F.col("p_type") == "ECONOMY", "").otherwise(F.col("p_brand"))
    raw = t.part.select("p_partkey", F.concat_ws(",", "p_name", brand, "p_type", F.col("p_size").cast("string")).alias("raw"))
    return raw.select(
        "p_partkey",
        split_at("raw", ",", 0).alias("name"),
        split_at("raw", ",", 1).alias("brand"),
        split_at("raw", ",", 3).alias("size_txt"),
        split_at("raw", ",", 8).alias("absent"),
    )


@query("proj_hex_base64", "SELECT c_custkey, base64(from_hex(hex(c_name))) AS encoded FROM customer")
def _(t: Tables):
    return t.customer.select("c_custkey", F.hex(F.encode("c_name", "UTF-8")).alias("h")).select(
        "c_custkey", hex_to_base64("h").alias("encoded")
    )


@query(
    "filter_conjunction",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem WHERE l_quantity > 45 AND l_discount < 0.03 AND l_returnflag = 'R'",
)
def _(t: Tables):
    return S.filter_all(t.lineitem, ["l_quantity > 45", "l_discount < 0.03", "l_returnflag = 'R'"]).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity"
    )


@query(
    "filter_date_window",
    f"""
    SELECT o_orderkey, o_orderdate FROM orders
    WHERE o_orderdate BETWEEN CAST(DATE '{AS_OF}' - INTERVAL 1 MONTH AS TIMESTAMP) AND CAST(DATE '{AS_OF}' AS TIMESTAMP)""",
)
def _(t: Tables):
    as_of = F.lit(AS_OF)
    low, high = F.add_months(as_of, -1).cast("timestamp_ntz"), as_of.cast("timestamp_ntz")
    return t.orders.filter(F.col("o_orderdate").between(low, high)).select("o_orderkey", "o_orderdate")


@query(
    "filter_length_guard",
    """
    SELECT p_partkey, p_name, p_brand, CASE WHEN length(p_name) <= 11 AND length(p_brand) <= 7 THEN 'accepted' ELSE 'rejected' END AS verdict
    FROM part""",
)
def _(t: Tables):
    accepted, rejected = S.split_by(
        t.part.select("p_partkey", "p_name", "p_brand"), S.within_lengths({"p_name": 11, "p_brand": 7})
    )
    return accepted.withColumn("verdict", F.lit("accepted")).unionByName(
        rejected.withColumn("verdict", F.lit("rejected"))
    )


@query(
    "filter_code_list",
    """
    SELECT c_custkey, c_mktsegment FROM customer
    WHERE lower(c_mktsegment) IN ('building', 'machinery') AND c_nationkey NOT IN (3, 7, 11)""",
)
def _(t: Tables):
    return t.customer.filter(
        F.lower("c_mktsegment").isin("building", "machinery") & ~F.col("c_nationkey").isin(3, 7, 11)
    ).select("c_custkey", "c_mktsegment")


@query(
    "filter_latest_load",
    """
    SELECT event_id, user_id, CAST(ts AS DATE) AS load_date FROM events
    WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)""",
)
def _(t: Tables):
    loads = t.events.select("event_id", "user_id", F.to_date("ts").alias("load_date"))
    return S.latest_load(loads, "load_date")


@query(
    "reshape_unpivot",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate, name, value FROM (
      SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate, nullif(l_discount, 0) AS discount_rate, nullif(l_tax, 0) AS tax_rate FROM lineitem)
    UNPIVOT (value FOR name IN (discount_rate, tax_rate))""",
)
def _(t: Tables):
    source = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_shipdate",
        F.nullif("l_discount", F.lit(0.0)).alias("d"), F.nullif("l_tax", F.lit(0.0)).alias("x"),
    )
    return S.unpivot(
        source, ["l_orderkey", "l_linenumber", "l_partkey", "l_shipdate"], {"d": "discount_rate", "x": "tax_rate"}
    )


@query(
    "reshape_pivot_max",
    """
    SELECT user_id,
           max(value) FILTER (event_type = 'click') AS click_value, max(props) FILTER (event_type = 'click') AS click_props,
           max(value) FILTER (event_type = 'purchase') AS purchase_value, max(props) FILTER (event_type = 'purchase') AS purchase_props
    FROM events GROUP BY user_id""",
)
def _(t: Tables):
    return S.pivot_max(t.events, ["user_id"], "event_type", ["click", "purchase"], {"value": "value", "props": "props"})


@query(
    "reshape_pivot_any",
    """
    SELECT o_custkey, max(o_orderpriority) FILTER (o_orderstatus = 'F') AS f, max(o_orderpriority) FILTER (o_orderstatus = 'O') AS o,
           max(o_orderpriority) FILTER (o_orderstatus = 'P') AS p
    FROM orders GROUP BY o_custkey""",
)
def _(t: Tables):
    # max stands for ANY_VALUE: any value is right, this one is repeatable
    wide = t.orders.groupBy("o_custkey").pivot("o_orderstatus", ["F", "O", "P"]).agg(F.max("o_orderpriority"))
    return wide.select("o_custkey", F.col("F").alias("f"), F.col("O").alias("o"), F.col("P").alias("p"))


_WIDE = ", ".join(
    f"max(CASE WHEN r = {i + 1} THEN {v} END) AS {v}_t{i}" for v in ("n_orders", "spend") for i in range(13)
)


@query(
    "reshape_rank_to_wide",
    f"""
    WITH m AS (SELECT o_custkey, date_trunc('month', o_orderdate) AS mth, count(*) AS n_orders,
                      CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS spend FROM orders GROUP BY 1, 2),
         k AS (SELECT *, dense_rank() OVER (PARTITION BY o_custkey ORDER BY mth DESC) AS r FROM m)
    SELECT o_custkey, {_WIDE} FROM k GROUP BY o_custkey""",
)
def _(t: Tables):
    monthly = (
        t.orders.groupBy("o_custkey", F.trunc("o_orderdate", "MM").alias("mth"))
        .agg(
            F.count(F.lit(1)).alias("n_orders"),
            amount_sum("o_totalprice").alias("spend"),
        )
    )
    return S.latest_to_wide(monthly, ["o_custkey"], "mth", ["n_orders", "spend"], 13)


@query(
    "reshape_name_value_wide",
    """
    SELECT c_custkey, c_name AS name, c_mktsegment AS segment, CAST(c_nationkey AS VARCHAR) AS nation, CAST(NULL AS VARCHAR) AS unknown
    FROM customer""",
)
def _(t: Tables):
    vector = t.customer.select(
        "c_custkey",
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_nationkey").alias("nation"),
    ).select("c_custkey", S.wide_to_name_value(["name", "segment", "nation"]).alias("features"))
    return S.name_value_to_wide(vector, "features", ["name", "segment", "nation", "unknown"])


@query(
    "reshape_wide_to_name_value",
    """
    SELECT p_partkey, 'p_brand=' || p_brand || ';p_size=' || CAST(p_size AS VARCHAR) || ';p_type=' || p_type AS features,
           CAST(3 AS BIGINT) AS n FROM part""",
)
def _(t: Tables):
    vector = t.part.select("p_partkey", S.wide_to_name_value(["p_brand", "p_size", "p_type"]).alias("v"))
    text = F.array_join(F.transform("v", lambda x: F.concat(x["name"], F.lit("="), x["value"])), ";")
    return vector.select("p_partkey", text.alias("features"), F.size("v").cast("long").alias("n"))


@query(
    "explode_array",
    """
    SELECT vec_id, CAST(pos AS BIGINT) AS pos, CAST(embedding[pos] AS DOUBLE) AS x
    FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS pos FROM embeddings)""",
)
def _(t: Tables):
    return t.embeddings.select("vec_id", F.posexplode("embedding").alias("p", "e")).select(
        "vec_id", (F.col("p") + 1).cast("long").alias("pos"), F.col("e").cast("double").alias("x")
    )


@query(
    "generate_series",
    """
    WITH b AS (SELECT CAST(min(o_orderdate) AS DATE) AS lo, CAST(max(o_orderdate) AS DATE) AS hi FROM orders),
         d AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d FROM b)
    SELECT d, count(o_orderkey) AS n_orders FROM d LEFT JOIN orders ON CAST(o_orderdate AS DATE) = d GROUP BY d""",
)
def _(t: Tables):
    bounds = t.orders.agg(F.to_date(F.min("o_orderdate")).alias("lo"), F.to_date(F.max("o_orderdate")).alias("hi"))
    days = bounds.select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("d"))
    daily = t.orders.groupBy(F.to_date("o_orderdate").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    return days.join(daily, "d", "left").select("d", F.coalesce("n", F.lit(0)).alias("n_orders"))
