"""Writers and write modes: each query writes from the given tables and reads the result back."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import functions as F

from ledgerloom.functions import cents
from ledgerloom.operators.changes import delete_where
from ledgerloom.plans.registry import Tables, query
from ledgerloom.session import scratch_path
from ledgerloom.sources import fixed_width, records, sinks, xml
from ledgerloom.sources import tables as W


@query("sink_parquet", "SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders")
def _(t: Tables):
    path = scratch_path(t.spark, "parquet")
    t.orders.write.mode("overwrite").parquet(path)
    return t.spark.read.parquet(path).select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")


@query("sink_csv_pipe", "SELECT page_id, replace(url, '|', '') AS url, replace(substr(url, 1, 4) || '|x', '|', '') AS tag FROM pages")
def _(t: Tables):
    path = scratch_path(t.spark, "pipe")
    sinks.write_delimited(t.pages.select("page_id", "url", F.concat(F.substring("url", 1, 4), F.lit("|x")).alias("tag")), path)
    return t.spark.read.option("header", True).option("sep", "|").schema("page_id long, url string, tag string").csv(path)


@query("sink_json", "SELECT p_partkey, p_name, p_brand, p_size, p_retailprice FROM part")
def _(t: Tables):
    path = scratch_path(t.spark, "json-out")
    rows = t.part.select("p_partkey", "p_name", "p_brand", "p_size", "p_retailprice")
    rows.write.json(path)
    return t.spark.read.schema(rows.schema).json(path)


@query(
    "sink_single_file",
    """
    SELECT 'customer_id,name' AS value UNION ALL SELECT CAST(c_custkey AS VARCHAR) || ',' || c_name FROM customer""",
)
def _(t: Tables):
    shards, target = scratch_path(t.spark, "single"), scratch_path(t.spark, "deliverable") + ".csv"
    body = t.customer.select("c_custkey", F.concat_ws(",", F.col("c_custkey").cast("string"), "c_name").alias("text"))
    lines = sinks.with_header_trailer(body, "text", ["c_custkey"], F.lit("customer_id,name"), F.lit(None).cast("string"), {})
    sinks.write_ordered_lines(lines.filter("line is not null"), shards, ["part", "c_custkey"], windows=True)
    sinks.compose(t.spark, shards, target)
    return t.spark.read.option("lineSep", "\r\n").text(target)


@query(
    "sink_fixed_width",
    """
    WITH r AS (SELECT row_number() OVER (ORDER BY c_custkey) AS n, lpad(CAST(c_custkey AS VARCHAR), 10, '0') || rpad(left(c_name, 14), 14, ' ') ||
           CASE WHEN c_acctbal < 0 THEN '-' || lpad(CAST(CAST(abs(c_acctbal) AS DECIMAL(18,2)) AS VARCHAR), 11, '0')
                ELSE lpad(CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR), 12, '0') END || rpad(c_mktsegment, 12, '.') AS value FROM customer)
    SELECT 1 AS line_no, rpad('OPEN', 8, ' ') AS value UNION ALL SELECT n + 1, value FROM r
    UNION ALL SELECT (SELECT count(*) FROM r) + 2, 'CLOSE' || lpad(CAST(count(*) AS VARCHAR), 9, '0') FROM r""",
)
def _(t: Tables):
    """A delimited file becomes a fixed-width one with header and footer, in the order of its lines."""
    source, target = scratch_path(t.spark, "delimited"), scratch_path(t.spark, "fixed-width")
    layout = fixed_width.parse_layout(
        ["c_custkey:1:10:0:L:string", "c_name:11:14: :R:string", "balance:25:12:0:L:decimal", "c_mktsegment:37:12:.:R:string"]
    )
    rows = t.customer.select("c_custkey", "c_name", F.col("c_acctbal").cast("decimal(18,2)").alias("balance"), "c_mktsegment")
    rows.orderBy("c_custkey").write.csv(source)
    footer = ["CLOSE", {"value": "{record_count}", "length": 9, "pad_value": "0", "pad_type": "left"}]
    fixed_width.convert_delimited(t.spark, source, layout, target, has_header=False, header={"value": "OPEN", "length": 8}, footer=footer)
    return sinks.read_ordered_lines(t.spark, target)


@query(
    "sink_header_trailer",
    """
    SELECT 1 AS line_no, 'HDR19980615' AS value
    UNION ALL SELECT 1 + row_number() OVER (ORDER BY o_orderdate, o_orderkey), 'D' || lpad(CAST(o_orderkey AS VARCHAR), 9, '0') || lpad(CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS VARCHAR), 12, '0') FROM orders
    UNION ALL SELECT count(*) + 2, 'TRL' || lpad(CAST(count(*) AS VARCHAR), 9, '0') || lpad(CAST(CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) * 100 AS BIGINT) AS VARCHAR), 15, '0') FROM orders""",
)
def _(t: Tables):
    path = scratch_path(t.spark, "header-trailer")
    price = cents("o_totalprice")
    body = t.orders.select("o_orderdate", "o_orderkey", "o_totalprice", F.format_string("D%09d%012d", "o_orderkey", price).alias("text"))
    totals = {"cents": F.sum(price)}
    trailer = F.format_string("TRL%09d%015d", "record_count", "cents")
    order = ["o_orderdate", "o_orderkey"]
    lines = sinks.with_header_trailer(body, "text", order, F.lit("HDR19980615"), trailer, totals)
    sinks.write_ordered_lines(lines, path, ["part", *order])
    return sinks.read_ordered_lines(t.spark, path)


@query(
    "sink_batch_control_file",
    """
    WITH r AS (SELECT *, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders),
    b AS (SELECT o_orderpriority AS p, count(*) AS n, CAST(sum(cents) AS BIGINT) AS c FROM r GROUP BY 1)
    , x AS (SELECT 0 AS s, NULL AS p, 0 AS q, NULL AS k, 'TH0001' AS value UNION ALL SELECT 1, p, 0, NULL, 'BH' || p FROM b
    UNION ALL SELECT 1, o_orderpriority, 1, o_orderkey, 'R' || lpad(CAST(o_orderkey AS VARCHAR), 9, '0') || lpad(CAST(cents AS VARCHAR), 12, '0') FROM r
    UNION ALL SELECT 1, p, 2, NULL, 'BT' || p || lpad(CAST(n AS VARCHAR), 9, '0') || lpad(CAST(c AS VARCHAR), 15, '0') FROM b
    UNION ALL SELECT 2, NULL, 0, NULL, 'FT' || lpad(CAST(count(*) AS VARCHAR), 5, '0') || lpad(CAST(CAST(sum(n) AS BIGINT) AS VARCHAR), 9, '0') || lpad(CAST(CAST(sum(c) AS BIGINT) AS VARCHAR), 15, '0') FROM b)
    SELECT row_number() OVER (ORDER BY s, p, q, k) AS line_no, value FROM x""",
)
def _(t: Tables):
    path = scratch_path(t.spark, "control-file")
    records = t.orders.withColumn("text", F.format_string("R%09d%012d", "o_orderkey", cents("o_totalprice")))
    lines = sinks.control_file(
        records, "o_orderpriority", ["o_orderkey"], "text", "o_totalprice",
        file_header="TH0001", file_trailer="FT%05d%09d%015d", batch_header="BH%s", batch_trailer="BT%s%09d%015d",
    )
    sinks.write_ordered_lines(lines, path, ["section", "batch", "part", "o_orderkey"])
    return sinks.read_ordered_lines(t.spark, path)


@query(
    "sink_ebcdic",
    """
    SELECT form, o_orderkey, regexp_replace(lpad(CAST(o_orderkey AS VARCHAR), 9, '0'), '(.)', 'F\\1', 'g') || repeat('40', 7) AS encoded_hex,
           rpad(lpad(CAST(o_orderkey AS VARCHAR), 9, '0'), 16, ' ') AS decoded FROM orders, (VALUES ('lines'), ('records')) f(form)""",
)
def _(t: Tables):
    """Both forms of file, read back: records that end with the code page's line feed, and records with nothing between."""
    lines, whole = scratch_path(t.spark, "ebcdic-lines"), scratch_path(t.spark, "ebcdic-records")
    rows = t.orders.select("o_orderkey", F.lpad(F.col("o_orderkey").cast("string"), 9, "0").alias("line"))
    fixed_width.write_ebcdic(rows, lines, ["o_orderkey"], "line", 16)
    records.write_ebcdic_records(rows, whole, ["o_orderkey"], "line", 16)
    # with its line feed, a record has 17 bytes
    with_feed = records.read_records(t.spark, lines, 17).select(F.lit("lines").alias("form"), F.substring("record", 1, 16).alias("raw"))
    plain = records.read_records(t.spark, whole, 16).select(F.lit("records").alias("form"), F.col("record").alias("raw"))
    text = fixed_width.from_ebcdic("raw")
    return with_feed.unionByName(plain).select(
        "form", F.trim(text).cast("long").alias("o_orderkey"), F.hex("raw").alias("encoded_hex"), text.alias("decoded")
    )


@query(
    "sink_xml",
    "SELECT p_partkey, p_name, nullif(p_brand, 'Brand#7') AS p_brand, p_size FROM part",
)
def _(t: Tables):
    path = scratch_path(t.spark, "xml-out")
    brand = F.when(F.col("p_brand") != "Brand#7", F.col("p_brand")).otherwise("")
    rows = t.part.select("p_partkey", "p_name", brand.alias("p_brand"), "p_size")
    xml.write_rows(rows, path, "Parts", "Part")
    return t.spark.read.format("xml").option("rowTag", "Part").schema(rows.schema).load(path)


@query(
    "sink_kafka_events",
    """
    SELECT CAST(c_custkey AS VARCHAR) AS key, '{"customerId":' || CAST(c_custkey AS VARCHAR) || ',"name":"' || c_name || '","nation":' || CAST(c_nationkey AS VARCHAR) || '}' AS value
    FROM customer""",
)
def _(t: Tables):
    path = scratch_path(t.spark, "events")
    chosen = t.customer.select("c_custkey", "c_name", "c_nationkey")
    messages = sinks.events(chosen, "c_custkey", {"c_custkey": "customerId", "c_name": "name", "c_nationkey": "nation"})
    sinks.publish(messages, path)
    return t.spark.read.schema("key string, value string").json(path)


@query(
    "sink_jdbc_upsert",
    """
    WITH s AS (SELECT o_custkey AS k, count(*) AS points, max(o_orderdate) AS seen FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01' GROUP BY 1),
         n AS (SELECT o_custkey AS k, count(*) AS points, max(o_orderdate) AS seen FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01' GROUP BY 1)
    SELECT coalesce(s.k, n.k) AS customer_id, coalesce(s.points, 0) + coalesce(n.points, 0) AS points, coalesce(n.seen, s.seen) AS seen FROM s FULL JOIN n ON s.k = n.k""",
)
def _(t: Tables):
    split = F.lit("1998-01-01").cast("timestamp_ntz")
    rows = lambda part: t.orders.filter(part).groupBy(
        F.col("o_custkey").alias("customer_id")
    ).agg(F.count(F.lit(1)).alias("points"), F.max("o_orderdate").alias("seen"))
    return sinks.upsert(rows(F.col("o_orderdate") < split), rows(F.col("o_orderdate") >= split), ["customer_id"], update=["points", "seen"], append=["points"])


@query(
    "sink_typed_extract",
    """
    SELECT CAST(c_custkey AS DECIMAL(12,0))::BIGINT AS c_custkey, left(c_name, 12) AS c_name, round(c_acctbal, 1) AS c_acctbal, '19980615 00:00' AS loaded FROM customer""",
)
def _(t: Tables):
    rows = t.customer.withColumn("loaded", F.lit("1998-06-15").cast("timestamp_ntz"))
    fitted = sinks.typed_extract(
        rows, {"c_custkey": "number(12,0)", "c_name": "varchar(12)", "c_acctbal": "number(12,1)", "loaded": "timestamp(yyyyMMdd HH:mm)"}
    )
    return fitted.withColumns({"c_custkey": F.col("c_custkey").cast("long"), "c_acctbal": F.col("c_acctbal").cast("double")})


@query("write_append_only", "SELECT o_orderkey, o_orderstatus FROM orders")
def _(t: Tables):
    """One run per status; the second one is repeated, as after a failure, and adds nothing."""
    path = scratch_path(t.spark, "append")
    for run, status in enumerate(("F", "O", "O", "P")):
        rows = t.orders.filter(F.col("o_orderstatus") == status).select("o_orderkey", "o_orderstatus")
        W.append_run(rows, path, f"2024-01-{min(run, 1) + (run == 3) + 1:02d}")
    return W.read_table(t.spark, path).drop(W.RUN)


@query(
    "write_full_refresh",
    """
    SELECT o_orderkey, o_custkey, year(o_orderdate) AS order_year, 0 AS overlapping_files FROM orders WHERE o_totalprice > 100000""",
)
def _(t: Tables):
    path = scratch_path(t.spark, "refresh")
    rows = t.orders.select("o_orderkey", "o_custkey", "o_totalprice", F.year("o_orderdate").cast("long").alias("order_year"))
    W.full_refresh(rows.filter("o_totalprice <= 100000"), path, ["order_year"])
    W.full_refresh(rows.filter("o_totalprice > 100000").drop("o_totalprice"), path, ["order_year"], cluster_by=["o_custkey"])
    back = W.read_table(t.spark, path)
    # counted from the files: whether customers are laid out in order within a year
    overlaps = W.overlapping_files(back, "o_custkey", ["order_year"]).agg(F.count(F.lit(1)).cast("int").alias("overlapping_files"))
    return back.withColumn("order_year", F.col("order_year").cast("long")).crossJoin(F.broadcast(overlaps))


@query(
    "write_bucketed",
    """
    SELECT o_custkey, count(*) AS n_lines, CAST(sum(CAST(round(l_quantity) AS BIGINT)) AS BIGINT) AS quantity
    FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1""",
)
def _(t: Tables):
    """Two catalog tables bucketed on the order number, joined without a shuffle."""
    orders, lines = (f"bucketed_{uuid.uuid4().hex}" for _ in range(2))
    W.write_bucketed(t.orders.select("o_orderkey", "o_custkey"), orders, 16, ["o_orderkey"], scratch_path(t.spark, "orders"))
    W.write_bucketed(t.lineitem.select("l_orderkey", "l_quantity"), lines, 16, ["l_orderkey"], scratch_path(t.spark, "lines"))
    joined = t.spark.table(orders).join(t.spark.table(lines), F.col("o_orderkey") == F.col("l_orderkey"))
    return joined.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum(F.round("l_quantity").cast("long")).alias("quantity")
    )


@query("write_schema_preserving", "SELECT s_suppkey, s_name, CAST(s_nationkey AS BIGINT) AS s_nationkey FROM supplier WHERE s_acctbal >= 0")
def _(t: Tables):
    path = scratch_path(t.spark, "schema-kept")
    W.schema_preserving(t.supplier.select("s_suppkey", "s_name", F.col("s_nationkey").cast("long").alias("s_nationkey")), path)
    shuffled = delete_where(t.supplier, F.col("s_acctbal") < 0).select("s_nationkey", "s_name", "s_suppkey")
    W.schema_preserving(shuffled, path)
    return W.read_table(t.spark, path)


@query(
    "write_partition_replace",
    """
    SELECT event_id, CASE WHEN CAST(ts AS DATE) >= DATE '2024-01-15' THEN value * 2 ELSE value END AS value, CAST(ts AS DATE) AS business_date FROM events""",
)
def _(t: Tables):
    path = scratch_path(t.spark, "partitions")
    rows = t.events.select("event_id", "value", F.to_date("ts").alias("business_date"))
    W.replace_partitions(rows, path, ["business_date"])
    later = rows.filter("business_date >= date'2024-01-15'").withColumn("value", F.col("value") * 2)
    W.replace_partitions(later, path, ["business_date"])
    return t.spark.read.parquet(path)


@query(
    "write_run_date_idempotent",
    """
    SELECT c_custkey, DATE '2024-01-01' AS run_date FROM customer WHERE c_acctbal < 0
    UNION ALL SELECT c_custkey, DATE '2024-01-02' FROM customer WHERE c_acctbal > 9000""",
)
def _(t: Tables):
    path = scratch_path(t.spark, "run-date")
    run = lambda cond, day: W.replace_run_date(t.customer.filter(cond).select("c_custkey"), path, day)
    run("c_acctbal < 0", date(2024, 1, 1))
    run("c_acctbal > 5000", date(2024, 1, 2))
    run("c_acctbal > 9000", date(2024, 1, 2))
    return t.spark.read.parquet(path)
