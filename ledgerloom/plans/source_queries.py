"""Readers over files that are written from the given tables first."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from ledgerloom.plans.registry import Tables, query
from ledgerloom.session import scratch_path
from ledgerloom.sources import files, fixed_width, pulls, records, sinks, xml


@query("src_parquet_glob", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def _(t: Tables):
    files.parquet_glob(t.spark, f"{t.folder}/nation*.parquet", "glob_nation")
    return t.spark.sql("SELECT n_nationkey, n_name, n_regionkey FROM glob_nation")


@query("src_csv_external", "SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer")
def _(t: Tables):
    """Deliveries that begin with a title, a note and the names of the columns."""
    path = scratch_path(t.spark, "csv")
    rows = t.customer.select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    record = F.to_csv(F.struct(*rows.columns), {"sep": ";"})
    # a file holds a thousand customers
    files_ = rows.groupBy(F.floor(F.col("c_custkey") / 1000).alias("delivery")).agg(F.array_join(F.collect_list(record), "\n").alias("body"))
    lines = F.concat_ws("\n", F.lit("Customers"), F.lit("balances; in dollars"), F.lit(";".join(rows.columns)), "body")
    files_.select("delivery", lines.alias("value")).write.partitionBy("delivery").text(path)
    return files.read_csv(t.spark, path, rows.schema, sep=";", skip_leading_rows=3)


@query("src_csv_latest_by_pattern", "SELECT s_suppkey, s_name, 'second' AS load FROM supplier")
def _(t: Tables):
    folder = scratch_path(t.spark, "drops")
    rows = t.supplier.select("s_suppkey", "s_name")
    for load in ("first", "second"):
        rows.withColumn("load", F.lit(load)).write.option("header", True).csv(f"{folder}/{load}")
    # a delivery is a folder of shards: the newest file names it
    delivery = files.newest_file(t.spark, folder, r"part-.*\.csv").rsplit("/", 1)[0]
    return files.read_csv(t.spark, delivery, "s_suppkey long, s_name string, load string")


@query("src_json_external", "SELECT event_id, user_id, event_type, value, props FROM events")
def _(t: Tables):
    path = scratch_path(t.spark, "json")
    rows = t.events.select("event_id", "user_id", "event_type", "value", "props")
    rows.write.json(path)
    return files.read_json(t.spark, path, rows.schema)


_LINE = fixed_width.parse_layout(
    ["id:1:1: :R:string", "o_orderkey:2:12:0:L:long", "o_orderstatus:14:3: :R:string", "o_totalprice:17:14:0:L:decimal"]
)


@query(
    "src_fixed_width_copybook",
    """
    SELECT form, o_orderkey, o_orderstatus, o_totalprice FROM orders, (VALUES ('lines'), ('records')) f(form)""",
)
def _(t: Tables):
    """Text lines, and EBCDIC records of the same layout with nothing between them."""
    path, raw = scratch_path(t.spark, "fixed"), scratch_path(t.spark, "fixed-records")
    rows = t.orders.select(
        F.lit("O").alias("id"), "o_orderkey", "o_orderstatus", F.col("o_totalprice").cast("decimal(18,2)").alias("o_totalprice")
    )
    lines = fixed_width.format_records(rows, _LINE).select("line")
    lines.write.text(path)
    length = _LINE[-1].start + _LINE[-1].length - 1
    records.write_ebcdic_records(lines, raw, [], "line", length)
    back = fixed_width.read_fixed_width(t.spark, path, _LINE).withColumn("form", F.lit("lines")).unionByName(
        records.read_ebcdic_records(t.spark, raw, length, _LINE).withColumn("form", F.lit("records"))
    )
    return back.select("form", "o_orderkey", "o_orderstatus", F.col("o_totalprice").cast("double").alias("o_totalprice"))


@query(
    "src_multi_segment_file",
    """
    SELECT 'O' AS segment, o_orderkey AS k, o_totalprice AS amount, (SELECT count(*) FROM orders) AS trailer_count FROM orders
    UNION ALL SELECT 'L', l_orderkey, l_extendedprice, (SELECT count(*) FROM lineitem) FROM lineitem""",
)
def _(t: Tables):
    path = scratch_path(t.spark, "segments-in")
    line = lambda seg, key, amount: F.format_string("%s%012d%014.2f", F.lit(seg), F.col(key), F.col(amount)).alias("line")
    trailer = lambda df, seg: df.agg(F.format_string("T%s%012d", F.lit(seg), F.count(F.lit(1))).alias("line"))
    parts = [
        t.spark.range(1).select(F.lit("H20240101").alias("line")),
        t.orders.select(line("O", "o_orderkey", "o_totalprice")),
        t.lineitem.select(line("L", "l_orderkey", "l_extendedprice")),
        trailer(t.orders, "O"),
        trailer(t.lineitem, "L"),
    ]
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p)
    whole.write.text(path)
    body = fixed_width.parse_layout(["k:2:12:0:L:long", "amount:14:14:0:L:decimal"])
    layouts = {"O": body, "L": body, "T": fixed_width.parse_layout(["segment:2:1: :R:string", "n:3:12:0:L:long"])}
    seg = fixed_width.read_segments(t.spark, path, layouts, ignore=["H"])
    rows = seg["O"].withColumn("segment", F.lit("O")).unionByName(seg["L"].withColumn("segment", F.lit("L")))
    return rows.join(seg["T"], "segment").select(
        "segment", "k", F.col("amount").cast("double").alias("amount"), F.col("n").alias("trailer_count")
    )


@query(
    "src_xml_rows",
    """
    SELECT 'Slip' AS tag, c_custkey AS id, c_name AS name, c_mktsegment AS segment FROM customer
    UNION ALL SELECT 'Summary', s_suppkey, s_name, CAST(s_nationkey AS VARCHAR) FROM supplier""",
)
def _(t: Tables):
    folder = scratch_path(t.spark, "xml")
    slips = t.customer.select("c_custkey", F.struct(F.struct(F.col("c_name").alias("full")).alias("name"), F.col("c_mktsegment").alias("segment")).alias("holder"))
    xml.write_rows(slips, f"{folder}/slips", "Root", "Slip")
    xml.write_rows(t.supplier.select("s_suppkey", "s_name", "s_nationkey"), f"{folder}/summary", "Root", "Summary")
    slip = xml.read_rows(t.spark, f"{folder}/slips", "Slip", slips.schema)
    summary = xml.read_rows(t.spark, f"{folder}/summary", "Summary", "s_suppkey long, s_name string, s_nationkey string")
    a = slip.select(F.lit("Slip").alias("tag"), F.col("c_custkey").alias("id"), F.col("full").alias("name"), "segment")
    b = summary.select(F.lit("Summary").alias("tag"), F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("segment"))
    return a.unionByName(b)


_XSD = """<?xml version="1.0" encoding="UTF-8"?>
<xs:schema xmlns:xs="http://www.w3.org/2001/XMLSchema">
  <xs:element name="Account"><xs:complexType><xs:sequence>
    <xs:element name="id" type="xs:long"/>
    <xs:element name="balance"><xs:simpleType><xs:restriction base="xs:decimal"><xs:minInclusive value="0"/></xs:restriction></xs:simpleType></xs:element>
  </xs:sequence></xs:complexType></xs:element>
</xs:schema>"""


@query(
    "src_xml_validated",
    """
    SELECT 'valid' AS kind, count(*) AS n, CAST(sum(c_custkey) AS BIGINT) AS id_sum FROM customer WHERE c_acctbal >= 0
    UNION ALL SELECT 'quarantined', count(*), NULL FROM customer WHERE c_acctbal < 0""",
)
def _(t: Tables):
    folder = scratch_path(t.spark, "xml-valid")
    t.spark.range(1).select(F.lit(_XSD).alias("value")).coalesce(1).write.text(f"{folder}/xsd")
    xsd = files.newest_file(t.spark, f"{folder}/xsd", r"part-.*\.txt")
    rows = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_acctbal").cast("decimal(18,2)").alias("balance"))
    xml.write_rows(rows, f"{folder}/rows", "Accounts", "Account")
    valid, bad = xml.read_validated(t.spark, f"{folder}/rows", "Account", xsd, rows.schema)
    a = valid.agg(F.lit("valid").alias("kind"), F.count(F.lit(1)).alias("n"), F.sum("id").alias("id_sum"))
    b = bad.agg(F.lit("quarantined").alias("kind"), F.count("_corrupt_record").alias("n"), F.lit(None).cast("long").alias("id_sum"))
    return a.unionByName(b)


@query(
    "src_jdbc_partitioned",
    """
    WITH b AS (SELECT min(o_orderkey) AS lo, max(o_orderkey) AS hi FROM orders),
    c AS (SELECT i AS chunk, CASE WHEN i > 0 THEN lo + (hi - lo) * i // 8 END AS a, CASE WHEN i < 7 THEN lo + (hi - lo) * (i + 1) // 8 END AS z
          FROM b, range(0, 8) t(i))
    SELECT chunk, CASE WHEN a IS NULL THEN 'o_orderkey < ' || z || ' OR o_orderkey IS NULL'
        WHEN z IS NULL THEN 'o_orderkey >= ' || a ELSE 'o_orderkey >= ' || a || ' AND o_orderkey < ' || z END AS predicate,
      count(*) FILTER (CASE WHEN a IS NULL THEN o_orderkey IS NULL OR o_orderkey < z ELSE o_orderkey >= a AND (z IS NULL OR o_orderkey < z) END) AS n_rows
    FROM c CROSS JOIN orders GROUP BY 1, a, z""",
)
def _(t: Tables):
    # what each connection of the pull would fetch; together the predicates cover every row once
    low, high = t.orders.agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    return pulls.count_by_predicate(t.orders, pulls.stride_predicates("o_orderkey", low, high, 8))


@query(
    "src_jdbc_custom_query",
    """
    SELECT o_custkey, count(*) AS n, max(o_orderdate) AS last_day FROM orders
    WHERE o_orderdate >= '1996-02-01' AND o_orderdate < '1997-02-01' GROUP BY o_custkey""",
)
def _(t: Tables):
    text = (
        "SELECT o_custkey, count(*) AS n, max(o_orderdate) AS last_day FROM {{orders}} "
        "WHERE o_orderdate >= {start} AND o_orderdate < {end} GROUP BY o_custkey"
    )
    return t.spark.sql(pulls.bound_query(text, {"start": "1996-02-01", "end": "1997-02-01"}), orders=t.orders)


@query(
    "src_chunk_by_months",
    """
    WITH b AS (SELECT CAST(min(o_orderdate) AS DATE) + 16 AS s, CAST(max(o_orderdate) AS DATE) + 9 AS e FROM orders),
    c AS (SELECT CAST(unnest(generate_series(CAST(date_trunc('month', s) + INTERVAL 1 MONTH AS DATE), e, INTERVAL 3 MONTH)) AS DATE) AS d FROM b
          UNION SELECT s FROM b UNION SELECT e FROM b),
    p AS (SELECT d AS chunk_start, lead(d) OVER (ORDER BY d) AS chunk_end FROM c)
    SELECT chunk_start, chunk_end, (SELECT count(*) FROM orders WHERE o_orderdate >= chunk_start AND o_orderdate < chunk_end) AS n_rows FROM p WHERE chunk_end IS NOT NULL""",
)
def _(t: Tables):
    bounds = t.orders.agg(F.date_add(F.to_date(F.min("o_orderdate")), 16).alias("s"), F.date_add(F.to_date(F.max("o_orderdate")), 9).alias("e"))
    chunks = pulls.month_chunks(bounds, "s", "e", 3)
    daily = t.orders.groupBy(F.to_date("o_orderdate").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    return (
        chunks.join(daily, (F.col("d") >= F.col("chunk_start")) & (F.col("d") < F.col("chunk_end")), "left")
        .groupBy("chunk_start", "chunk_end").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"))
    )


@query(
    "src_chunk_by_range",
    """
    WITH b AS (SELECT min(o_orderkey) AS lo, max(o_orderkey) + 1 AS hi FROM orders), g AS (SELECT lo, hi, greatest((hi - lo - 1) // 4000, 1) AS n FROM b),
    c AS (SELECT unnest(range(0, CAST(n AS BIGINT))) AS i, lo, hi, n FROM g)
    SELECT lo + i * 4000 AS chunk_start, CASE WHEN i = n - 1 THEN hi ELSE lo + (i + 1) * 4000 END AS chunk_end FROM c""",
)
def _(t: Tables):
    bounds = t.orders.agg(F.min("o_orderkey").alias("lo"), (F.max("o_orderkey") + 1).alias("hi"))
    return pulls.range_chunks(bounds, "lo", "hi", 4000)


@query(
    "src_incremental_window",
    """
    SELECT event_id, user_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-09 18:00:00' AND ts < TIMESTAMP '2024-01-10 18:00:00'""",
)
def _(t: Tables):
    # control rows: one finished run per earlier day of the table
    day = F.to_date("ts").cast("timestamp_ntz")
    control = t.events.filter(F.col("ts") < F.lit("2024-01-09").cast("timestamp_ntz")).select(
        day.alias("load_from"), (day + F.expr("interval 1 day")).alias("load_to"), day.alias("run_at")
    ).distinct()
    window = pulls.run_window(datetime(2024, 1, 10, 20, 0), "18:00:00", "18:00:00")
    return pulls.incremental(t.events, "ts", window, control).select("event_id", "user_id", "ts")


@query("src_multi_file_headers", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, nullif(l_returnflag, 'N') AS l_returnflag FROM lineitem")
def _(t: Tables):
    """Many delivered files become one deliverable with one header and CRLF, which is read again."""
    folder, whole = scratch_path(t.spark, "shards"), scratch_path(t.spark, "composed")
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.nullif("l_returnflag", F.lit("N")).alias("l_returnflag"))
    rows.repartition(5).write.option("header", True).option("nullValue", '""').option("quote", "").csv(folder)
    sinks.compose_files(t.spark, f"{folder}/part-*", f"{whole}/shards", windows=True, empty_to_blank=True)
    sinks.compose(t.spark, f"{whole}/shards", f"{whole}/lines.csv")
    return files.read_csv(
        t.spark, f"{whole}/lines.csv", "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_returnflag string", null_value=""
    )


@query(
    "src_positional_record_type",
    "SELECT c_custkey AS customer_id, nullif(c_mktsegment, 'BUILDING') AS segment, c_acctbal AS balance, true AS from_file FROM customer",
)
def _(t: Tables):
    path = scratch_path(t.spark, "positional")
    segment = F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).otherwise("")
    detail = t.customer.select(F.concat_ws(",", F.lit("D"), "c_custkey", F.lit("x"), segment, F.col("c_acctbal").cast("decimal(18,2)")).alias("line"))
    edge = t.customer.agg(F.count(F.lit(1)).alias("n"))
    lines = edge.select(F.lit("H,20240101").alias("line")).unionByName(detail).unionByName(edge.select(F.concat(F.lit("T,"), "n").alias("line")))
    lines.write.text(path)
    back = files.read_positional(t.spark, path, [(1, "customer_id", "long"), (3, "segment", "string"), (4, "balance", "double")])
    return back.select("customer_id", "segment", "balance", F.col("file_name").startswith("part-").alias("from_file"))
