"""The function catalogue and the user-defined functions over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom import functions as fn
from ledgerloom.operators.aggregates import latest_months
from ledgerloom.operators.shaping import decode_by_table
from ledgerloom.plans.registry import AS_OF, Tables, query


@query(
    "fn_string",
    r"""
    SELECT page_id, substr(url, 8, 10) AS f_substr, lpad(CAST(page_id AS VARCHAR), 3, '0') AS f_lpad, rpad(CAST(page_id AS VARCHAR), 6, '*') AS f_rpad,
      lower(url) AS f_lower, upper(url) AS f_upper, replace(url, '.example.', '.test.') AS f_replace, url || '#' || CAST(page_id AS VARCHAR) AS f_concat,
      'p' || CAST(page_id AS VARCHAR) AS f_trim, CAST(length(html) AS BIGINT) AS f_length, split_part(url, '/', 3) AS f_split, left(url, 5) AS f_left, right(url, 4) AS f_right,
      regexp_replace(url, '[0-9]+', 'N', 'g') AS f_regexp_replace, nullif(regexp_extract(url, '/([a-z]{2})/', 1), '') AS f_regexp_extract,
      regexp_matches(url, 'page=[0-9]') AS f_regexp_contains, CAST(instr(url, 'example') AS BIGINT) AS f_instr, starts_with(url, 'https') AS f_starts_with,
      ends_with(url, 'top') AS f_ends_with, repeat('ab', CAST(page_id % 3 AS INT)) AS f_repeat, printf('%.2f', page_id / 7.0) AS f_format,
      html AS f_valid_text, CAST(36 AS BIGINT) AS uuid_length FROM pages""",
)
def _(t: Tables):
    u, key = F.col("url"), F.col("page_id").cast("string")
    return t.pages.select(
        "page_id",
        F.substring(u, 8, 10).alias("f_substr"),
        F.lpad(key, F.lit(3), F.lit("0")).alias("f_lpad"),
        F.rpad(key, F.lit(6), F.lit("*")).alias("f_rpad"),
        F.lower(u).alias("f_lower"),
        F.upper(u).alias("f_upper"),
        F.replace(u, F.lit(".example."), F.lit(".test.")).alias("f_replace"),
        F.concat(u, F.lit("#"), key).alias("f_concat"),
        fn.strip(F.concat(F.lit(" \t p"), key, F.lit("\n"))).alias("f_trim"),
        F.length("html").cast("long").alias("f_length"),
        F.get(fn.split_text(u, "/"), F.lit(2)).alias("f_split"),
        F.left(u, F.lit(5)).alias("f_left"),
        F.right(u, F.lit(4)).alias("f_right"),
        F.regexp_replace(u, "[0-9]+", "N").alias("f_regexp_replace"),
        fn.regexp_first(u, "/([a-z]{2})/").alias("f_regexp_extract"),
        u.rlike("page=[0-9]").alias("f_regexp_contains"),
        F.instr(u, "example").cast("long").alias("f_instr"),
        u.startswith("https").alias("f_starts_with"),
        u.endswith("top").alias("f_ends_with"),
        F.repeat(F.lit("ab"), (F.col("page_id") % 3).cast("int")).alias("f_repeat"),
        fn.text_number(F.col("page_id") / 7.0).alias("f_format"),
        F.try_validate_utf8("html").alias("f_valid_text"),
        F.length(F.uuid()).cast("long").alias("uuid_length"),
    )


@query(
    "fn_conditional",
    """
    SELECT c_custkey, if(c_acctbal < 0, 'neg', 'pos') AS f_if, coalesce(nullif(c_nationkey, 5), -1) AS f_ifnull, coalesce(nullif(c_nationkey, 5), nullif(c_nationkey, 6), 0) AS f_coalesce,
      nullif(c_mktsegment, 'BUILDING') AS f_nullif, CAST(round(c_acctbal) AS BIGINT) AS f_cast_int, TRY_CAST(c_name AS BIGINT) AS f_safe_cast,
      CAST(TRY_CAST(' ' || CAST(c_acctbal AS VARCHAR) || ' ' AS DECIMAL(18,4)) AS DOUBLE) AS f_parse_numeric,
      CASE WHEN nullif(c_nationkey, 5) IS NOT NULL THEN greatest(nullif(c_nationkey, 5), 12) END AS f_greatest,
      CASE WHEN nullif(c_nationkey, 5) IS NOT NULL THEN least(nullif(c_nationkey, 5), 12) END AS f_least, CAST(c_custkey AS VARCHAR) AS f_string FROM customer""",
)
def _(t: Tables):
    n5, n6 = F.nullif("c_nationkey", F.lit(5)), F.nullif("c_nationkey", F.lit(6))
    return t.customer.select(
        "c_custkey",
        F.expr("if(c_acctbal < 0, 'neg', 'pos')").alias("f_if"),
        F.ifnull(n5, F.lit(-1)).alias("f_ifnull"),
        F.coalesce(n5, n6, F.lit(0)).alias("f_coalesce"),
        F.nullif("c_mktsegment", F.lit("BUILDING")).alias("f_nullif"),
        fn.round_to_long("c_acctbal").alias("f_cast_int"),
        F.col("c_name").try_cast("long").alias("f_safe_cast"),
        fn.parse_numeric(F.concat(F.lit(" "), F.col("c_acctbal").cast("string"), F.lit(" "))).cast("double").alias("f_parse_numeric"),
        fn.strict_greatest(n5, F.lit(12)).alias("f_greatest"),
        fn.strict_least(n5, F.lit(12)).alias("f_least"),
        F.col("c_custkey").cast("string").alias("f_string"),
    )


@query(
    "fn_datetime",
    f"""
    WITH o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, o_orderdate + INTERVAL (o_orderkey % 86400) SECOND AS ts FROM orders)
    SELECT o_orderkey, year(d) * 10000 + month(d) * 100 + day(d) AS f_extract, dayofweek(d) + 1 AS f_dayofweek, make_date(year(d), month(d), 1) AS f_date,
      CAST(strftime(d, '%Y%m%d') AS VARCHAR) AS f_format_date, strftime(ts, '%Y-%m-%d %H:%M:%S') AS f_format_datetime, strftime(d, '%b %d') AS f_format_month,
      CAST(ts + INTERVAL 36 HOUR AS TIMESTAMP) AS f_timestamp_add, CAST(ts - INTERVAL 15 MINUTE AS TIMESTAMP) AS f_datetime_sub, CAST(d + INTERVAL 2 MONTH AS DATE) AS f_date_add, d - 10 AS f_date_sub,
      date_diff('day', d, DATE '{AS_OF}') AS f_days, date_diff('month', d, DATE '{AS_OF}') AS f_months, date_diff('quarter', d, DATE '{AS_OF}') AS f_quarters, date_diff('year', d, DATE '{AS_OF}') AS f_years,
      date_diff('day', date_trunc('week', d + 1), date_trunc('week', DATE '{AS_OF}' + 1)) // 7 AS f_weeks, date_diff('day', date_trunc('week', d), date_trunc('week', DATE '{AS_OF}')) // 7 AS f_isoweeks,
      date_diff('hour', ts, TIMESTAMP '{AS_OF} 12:30:00') AS f_datetime_diff, date_sub('hour', ts, TIMESTAMP '{AS_OF} 12:30:00') AS f_timestamp_diff,
      CAST(date_trunc('month', d) AS DATE) AS f_date_trunc, date_trunc('hour', ts) AS f_datetime_trunc, CAST(date_trunc('week', d) AS DATE) AS f_week_trunc,
      d AS f_parse_date, CASE WHEN month(d) = 2 THEN NULL ELSE d END AS f_safe_parse_date, date_trunc('second', ts) AS f_parse_datetime, last_day(d) AS f_last_day,
      epoch_us(ts) AS f_unix_micros, len(generate_series(d, d + 21, INTERVAL 7 DAY)) AS f_date_array, strftime(ts, '%H:%M') AS f_time FROM o""",
)
def _(t: Tables):
    shift = F.make_interval(secs=(F.col("o_orderkey") % 86400).cast("decimal(18,6)"))
    o = t.orders.select("o_orderkey", F.to_date("o_orderdate").alias("d"), (F.col("o_orderdate") + shift).alias("ts"))
    as_of, noon = F.lit(AS_OF), F.lit(f"{AS_OF} 12:30:00").cast("timestamp_ntz")
    text = F.date_format("d", "yyyyMMdd")
    # February dates become an impossible month 13
    broken = F.when(F.month("d") == 2, F.concat(F.substring(text, 1, 4), F.lit("1301"))).otherwise(text)
    return o.select(
        "o_orderkey",
        (F.year("d") * 10000 + F.month("d") * 100 + F.dayofmonth("d")).cast("long").alias("f_extract"),
        F.dayofweek("d").cast("long").alias("f_dayofweek"),
        F.make_date(F.year("d"), F.month("d"), F.lit(1)).alias("f_date"),
        fn.format_time("d", "%Y%m%d").alias("f_format_date"),
        fn.format_time("ts", "%Y-%m-%d %H:%M:%S").alias("f_format_datetime"),
        fn.format_time("d", "%b %d").alias("f_format_month"),
        (F.col("ts") + F.expr("interval 36 hour")).alias("f_timestamp_add"),
        (F.col("ts") - F.expr("interval 15 minute")).alias("f_datetime_sub"),
        F.add_months("d", 2).alias("f_date_add"),
        F.date_sub("d", 10).alias("f_date_sub"),
        fn.date_diff(as_of, "d", "DAY").alias("f_days"),
        fn.date_diff(as_of, "d", "MONTH").alias("f_months"),
        fn.date_diff(as_of, "d", "QUARTER").alias("f_quarters"),
        fn.date_diff(as_of, "d", "YEAR").alias("f_years"),
        fn.date_diff(as_of, "d", "WEEK").alias("f_weeks"),
        fn.date_diff(as_of, "d", "ISOWEEK").alias("f_isoweeks"),
        fn.datetime_diff(noon, "ts", "HOUR").alias("f_datetime_diff"),
        fn.timestamp_diff(noon, "ts", "HOUR").alias("f_timestamp_diff"),
        F.trunc("d", "MM").alias("f_date_trunc"),
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("f_datetime_trunc"),
        F.trunc("d", "week").alias("f_week_trunc"),
        fn.parse_date(text, "%Y%m%d").alias("f_parse_date"),
        fn.try_parse_date(broken, "%Y%m%d").alias("f_safe_parse_date"),
        fn.parse_datetime(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), "%Y-%m-%dT%H:%M:%S").alias("f_parse_datetime"),
        F.last_day("d").alias("f_last_day"),
        F.unix_micros(F.col("ts").cast("timestamp")).alias("f_unix_micros"),
        F.size(F.sequence("d", F.date_add("d", 21), F.expr("interval 7 day"))).cast("long").alias("f_date_array"),
        fn.format_time("ts", "%H:%M").alias("f_time"),
    )


@query(
    "fn_math",
    """
    SELECT c_custkey, round(c_acctbal, 1) AS f_round, abs(c_acctbal) AS f_abs, c_custkey % 7 AS f_mod, c_custkey // 7 AS f_div, CAST(floor(c_acctbal) AS BIGINT) AS f_floor,
      CAST(ceil(c_acctbal) AS BIGINT) AS f_ceil, CAST(trunc(c_acctbal) AS DOUBLE) + 0.0 AS f_trunc, CASE WHEN c_nationkey = 0 THEN NULL ELSE round(c_acctbal / c_nationkey, 6) END AS f_safe_divide,
      CAST(len(range(0, c_nationkey + 1, 5)) AS BIGINT) AS f_generate_array,
      CAST(CASE WHEN c_acctbal < 0 THEN 0 WHEN c_acctbal < 1000 THEN 1 WHEN c_acctbal < 5000 THEN 2 ELSE 3 END AS BIGINT) AS f_range_bucket FROM customer""",
)
def _(t: Tables):
    b = F.col("c_acctbal")
    return t.customer.select(
        "c_custkey",
        F.round(b, 1).alias("f_round"),
        F.abs(b).alias("f_abs"),
        (F.col("c_custkey") % 7).alias("f_mod"),
        F.expr("c_custkey div 7").alias("f_div"),
        F.floor(b).alias("f_floor"),
        F.ceil(b).alias("f_ceil"),
        fn.truncate_to(b).alias("f_trunc"),
        F.round(F.try_divide(b, F.col("c_nationkey").cast("double")), 6).alias("f_safe_divide"),
        F.size(F.sequence(F.lit(0), F.col("c_nationkey"), F.lit(5))).cast("long").alias("f_generate_array"),
        fn.range_bucket(b, [0, 1000, 5000]).cast("long").alias("f_range_bucket"),
    )


@query(
    "fn_aggregate",
    """
    SELECT event_type, max(value) AS f_max, min(value) AS f_min, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS f_sum, count(*) AS f_count,
      round(CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(*), 6) AS f_avg, count(*) FILTER (value > 50) AS f_countif, max(event_type) AS f_any_value,
      arg_max(event_id, (value, event_id)) AS f_max_by, arg_min(event_id, (value, event_id)) AS f_min_by, round(var_samp(value), 4) AS f_var_samp,
      count(DISTINCT user_id) AS f_count_distinct, string_agg(DISTINCT CAST(user_id // 100 AS VARCHAR), '|' ORDER BY CAST(user_id // 100 AS VARCHAR)) AS f_string_agg
    FROM events GROUP BY event_type""",
)
def _(t: Tables):
    total = fn.amount_sum("value")
    order = F.struct("value", "event_id")
    plain = t.events.groupBy("event_type").agg(
        F.max("value").alias("f_max"), F.min("value").alias("f_min"), total.alias("f_sum"), F.count(F.lit(1)).alias("f_count"),
        F.round(total / F.count(F.lit(1)), 6).alias("f_avg"), F.count_if(F.col("value") > 50).alias("f_countif"),
        F.any_value("event_type").alias("f_any_value"), F.max_by("event_id", order).alias("f_max_by"),
        F.min_by("event_id", order).alias("f_min_by"), F.round(F.var_samp("value"), 4).alias("f_var_samp"),
        F.count_distinct("user_id").alias("f_count_distinct"),
    )
    # a text list is built from distinct values, never from the raw group
    blocks = t.events.select("event_type", F.expr("user_id div 100").cast("string").alias("b")).distinct()
    listed = blocks.groupBy("event_type").agg(F.array_join(F.sort_array(F.collect_list("b")), "|").alias("f_string_agg"))
    return plain.join(listed, "event_type")


@query(
    "fn_array",
    """
    SELECT page_id, split_part(url, '/', 1) AS f_offset, nullif(split_part(url, '/', 12), '') AS f_safe_offset, len(string_split(url, '/')) AS f_array_length,
      list_extract(list_reverse(string_split(split_part(url, '/', 3), '.')), 1) AS f_array_reverse, replace(url, '/', '-') AS f_array_to_string,
      len(string_split(url, '/')) + 2 AS f_array_concat, url || '|' || CAST(page_id AS VARCHAR) AS f_struct FROM pages""",
)
def _(t: Tables):
    parts = fn.split_text("url", "/")
    host = F.get(parts, F.lit(2))
    s = F.struct(F.col("url").alias("a"), F.col("page_id").alias("b"))
    return t.pages.select(
        "page_id",
        parts[0].alias("f_offset"),
        fn.array_at(parts, 11).alias("f_safe_offset"),
        F.size(parts).cast("long").alias("f_array_length"),
        F.reverse(fn.split_text(host, "."))[0].alias("f_array_reverse"),
        F.array_join(parts, "-").alias("f_array_to_string"),
        F.size(F.concat(parts, F.array(F.lit("x"), F.lit("y")))).cast("long").alias("f_array_concat"),
        F.concat_ws("|", s["a"], s["b"].cast("string")).alias("f_struct"),
    )


@query(
    "fn_json",
    """
    SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS f_json_value, CAST(NULL AS VARCHAR) AS f_scalar_of_object,
      CAST(2 AS BIGINT) AS f_array_size, event_type AS f_array_second, '{"id":' || CAST(event_id AS VARCHAR) || ',"kind":"' || event_type || '","none":null}' AS f_to_json,
      CAST(json_extract_string(props, '$.k') AS BIGINT) + 1 AS f_parse_json FROM events""",
)
def _(t: Tables):
    doc = F.concat(F.lit('{"o":{"a":1},"l":["x","'), "event_type", F.lit('"]}'))
    items = fn.json_array(doc, "$.l")
    none = F.lit(None).cast("string")
    return t.events.select(
        "event_id",
        fn.json_scalar("props", "$.k").cast("long").alias("f_json_value"),
        fn.json_scalar(doc, "$.o").alias("f_scalar_of_object"),
        F.size(items).cast("long").alias("f_array_size"),
        items[1].alias("f_array_second"),
        F.to_json(F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("kind"), none.alias("none")), {"ignoreNullFields": "false"}).alias("f_to_json"),
        (F.try_variant_get(F.try_parse_json("props"), "$.k", "long") + 1).alias("f_parse_json"),
    )


@query(
    "fn_hash",
    """
    SELECT doc_id, sha256(text) AS f_sha256_hex, lower(hex(CAST(CAST(doc_id AS VARCHAR) AS BLOB))) AS f_to_hex, CAST(doc_id AS VARCHAR) AS f_from_hex,
      base64(CAST(CAST(doc_id AS VARCHAR) AS BLOB)) AS f_to_base64, base64(from_hex(md5(lang || source))) AS f_md5,
      CAST(('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 15)) AS BIGINT) % 10000 AS f_bucket FROM documents""",
)
def _(t: Tables):
    raw = F.encode(F.col("doc_id").cast("string"), "UTF-8")
    return t.documents.select(
        "doc_id",
        F.sha2("text", 256).alias("f_sha256_hex"),
        F.lower(F.hex(raw)).alias("f_to_hex"),
        F.decode(F.unhex(F.hex(raw)), "UTF-8").alias("f_from_hex"),
        F.base64(raw).alias("f_to_base64"),
        fn.key_hash(["lang", "source"]).alias("f_md5"),
        fn.stable_bucket("doc_id").alias("f_bucket"),
    )


@query("udf_sql_scalar", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(CASE WHEN l_partkey * 2 > 9 THEN l_partkey * 2 // 10 + l_partkey * 2 % 10 ELSE l_partkey * 2 END AS BIGINT) AS folded FROM lineitem")
def _(t: Tables):
    t.spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION fold_digits(n BIGINT) RETURNS BIGINT "
        "RETURN CASE WHEN n > 9 THEN n div 10 + n % 10 ELSE n END"
    )
    return t.spark.sql(
        "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, fold_digits(l_partkey * 2) AS folded FROM {lines}", lines=t.lineitem
    )


@query(
    "udf_sql_nested",
    """
    WITH b AS (SELECT c_custkey, '400000' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS body FROM customer),
    s AS (SELECT c_custkey, body, list_sum(list_transform(range(1, 16), lambda i: CASE WHEN i % 2 = 0 THEN CAST(body[i:i] AS INT)
      ELSE (CAST(body[i:i] AS INT) * 2) // 10 + (CAST(body[i:i] AS INT) * 2) % 10 END)) AS total FROM b)
    SELECT c_custkey, body || CAST((10 - total % 10) % 10 AS VARCHAR) AS account_number, true AS valid FROM s""",
)
def _(t: Tables):
    body = F.concat(F.lit("400000"), F.lpad(F.col("c_custkey").cast("string"), 9, "0"))
    accounts = t.customer.select("c_custkey", fn.with_check_digit(body).alias("account_number"))
    return accounts.withColumn("valid", fn.luhn_valid("account_number"))


@query(
    "udf_lookup",
    "SELECT c_custkey, coalesce(n_name, 'UNKNOWN') AS country FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey AND n_nationkey < 20",
)
def _(t: Tables):
    codes = t.nation.filter("n_nationkey < 20")
    return decode_by_table(
        t.customer.select("c_custkey", "c_nationkey"), codes, "c_nationkey", "n_nationkey", "n_name", "country", F.lit("UNKNOWN")
    ).drop("c_nationkey")


@query(
    "udf_struct_return",
    """
    WITH m AS (SELECT DISTINCT CAST(date_trunc('month', l_shipdate) AS DATE) AS m FROM lineitem ORDER BY m DESC LIMIT 13)
    SELECT max(m) AS report_month, string_agg(strftime(m, '%Y-%m-%d'), ',' ORDER BY m DESC) AS month_list, count(*) AS n FROM m""",
)
def _(t: Tables):
    report = latest_months(t.lineitem, "l_shipdate", 13).select(F.struct("report_month", "month_list").alias("r"))
    return report.select(
        "r.report_month", F.array_join("r.month_list", ",").alias("month_list"), F.size("r.month_list").cast("long").alias("n")
    )


@query(
    "udf_dynamic_union",
    """
    SELECT 'customer' AS source, c_custkey AS id, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment, NULL::VARCHAR AS brand FROM customer
    UNION ALL SELECT 'supplier', s_suppkey, s_name, s_acctbal, NULL, NULL FROM supplier
    UNION ALL SELECT 'part', p_partkey, p_name, NULL, NULL, p_brand FROM part""",
)
def _(t: Tables):
    # table -> (column, common name); columns that a table lacks become NULL
    tables = {
        "customer": {"c_custkey": "id", "c_name": "name", "c_acctbal": "balance", "c_mktsegment": "segment"},
        "supplier": {"s_suppkey": "id", "s_name": "name", "s_acctbal": "balance"},
        "part": {"p_partkey": "id", "p_name": "name", "p_brand": "brand"},
    }
    parts = [
        getattr(t, name).select(F.lit(name).alias("source"), *[F.col(c).alias(a) for c, a in columns.items()])
        for name, columns in tables.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out
