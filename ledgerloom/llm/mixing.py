"""Mixing sources to target weights by a time-varying curriculum.

Each source has a schedule: its weight at training times from 0 to 1, linear between knots. The
integral of a schedule is the source's share; shares turn into word targets, capped at ``cap`` times
the source's own words, the excess going to the other sources by weight. A source meets its demand by
passing over its documents in a fixed hashed order, again and again until the target is reached;
inverting the cumulated demand at a copy's first word gives the training time of the copy. Documents
are range-sorted by that time.

Nulls: a null source is a source of its own and comes last; a null text has 0 words; a null doc_id
is hashed as an empty text. Empty texts take no words. Repeated rows are mixed row by row. The hashed order is by doc_id and text;
ties are broken by doc_id and size, so they can fall only between equal rows. An empty table gives
an empty result. Columns of the input named like a result are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import query, table, word_count

Schedule = Sequence[tuple[float, float]]

#: Weight over training time with integrals 1, 2 and 3: fading out, steady, and fading in.
SCHEDULES: tuple[Schedule, ...] = (
    ((0.0, 1.5), (1.0, 0.5)),
    ((0.0, 2.0), (1.0, 2.0)),
    ((0.0, 2.0), (0.5, 3.0), (1.0, 4.0)),
)
#: A source's target, and a document's taken words, stop at this many times its size.
CAP = 3


def integral(schedule: Schedule) -> float:
    return sum((t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(schedule, schedule[1:], strict=False))


def time_of(demand: Column, schedule: Schedule) -> Column:
    """The training time at which the share ``demand`` (0 to 1) of a source's words is used up."""
    area = demand * integral(schedule)
    pieces, below = [], 0.0
    for (t0, w0), (t1, w1) in zip(schedule, schedule[1:], strict=False):
        if (whole := (t1 - t0) * (w0 + w1) / 2) <= 0:
            continue
        left, slope = area - F.lit(below), (w1 - w0) / (t1 - t0)
        root = F.sqrt(F.greatest(F.lit(w0 * w0) + 2 * slope * left, F.lit(0.0)))
        # the stable root of w0 x + slope x^2 / 2 = left
        step = F.when(left <= 0, F.lit(0.0)).otherwise(2 * left / (F.lit(w0) + root))
        pieces.append((below + whole, F.lit(t0) + step))
        below += whole
    out = pieces[-1][1]
    for end, piece in reversed(pieces[:-1]):
        out = F.when(area < end, piece).otherwise(out)
    return F.least(out, F.lit(1.0))


def source_targets(sizes: DataFrame, schedules: Sequence[Schedule] = SCHEDULES, cap: int = CAP) -> DataFrame:
    """One row per source of (source, size): source_size, target, schedule number.

    The list of sources is part of a mix's configuration; the windows below run over one row per source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    shares = F.array(*[F.lit(float(integral(s))) for s in schedules])
    per = per.withColumn("schedule", ((place - 1) % len(schedules)).cast("int")).withColumn(
        "weight", F.element_at(shares, F.col("schedule") + 1)
    )
    everything = Window.partitionBy(F.lit(1))
    by_ratio = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    limit = F.col("source_size") * cap
    per = per.withColumns(
        {
            "total": F.sum("source_size").over(everything),
            "used": F.coalesce(F.sum(limit).over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
            "open": F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing)),
        }
    )
    # in order of cap over weight, the sources that reach their cap come first
    full = limit < (F.col("total") - F.col("used")) * F.col("weight") / F.col("open")
    per = per.withColumn("full", full)
    used = F.coalesce(F.sum(F.when(F.col("full"), limit)).over(everything), F.lit(0))
    open_ = F.sum(F.when(~F.col("full"), F.col("weight"))).over(everything)
    per = per.withColumns({"used": used, "open": open_})
    target = F.when(F.col("full"), limit.cast("double")).otherwise(
        (F.col("total") - F.col("used")) * F.col("weight") / F.col("open")
    )
    return per.select("source", "source_size", "n_docs", "schedule", target.alias("target"))


def plan_mix(
    docs: DataFrame,
    schedules: Sequence[Schedule] = SCHEDULES,
    cap: int = CAP,
    carry: Sequence[str] | None = None,
) -> DataFrame:
    """Each input row as struct ``doc`` (of the columns ``carry``, by default all), with size, source_size, target, taken and ``positions``.

    ``positions`` holds the training times of the row's copies, none if the mix leaves it out. The
    words before a row are its bucket's words before it, plus those of earlier buckets: a source is cut by hash into
    as many buckets as the square root of its rows, so no task holds a whole source.
    """
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in (docs.columns if carry is None else carry)]).alias("doc"),
        F.col("doc_id").alias("_id"),
        F.col("source"),
        word_count(F.col("text")).alias("size"),
        # the text is part of it: rows without a doc_id, or with the same one, are spread like others
        F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5(F.coalesce("text", F.lit(""))))).alias("_hash"),
    )
    per = source_targets(rows.select("source", "size"), schedules, cap).withColumnRenamed("source", "_source")
    share = F.conv(F.substring("_hash", 1, 8), 16, 10).cast("double") / float(1 << 32)
    rows = rows.join(per, rows["source"].eqNullSafe(per["_source"])).withColumn(
        "_bucket", F.floor(share * F.ceil(F.sqrt("n_docs"))).cast("long")
    )
    lot = ["_source", "_bucket"]
    earlier = Window.partitionBy("_source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy(*lot)
        .agg(F.sum("size").alias("_words"))
        .select(
            F.col("_source").alias("_o_source"),
            F.col("_bucket").alias("_o_bucket"),
            F.coalesce(F.sum("_words").over(earlier), F.lit(0)).alias("_offset"),
        )
    )
    inside = Window.partitionBy(*lot).orderBy("_hash", "_id", "size")
    rows = rows.withColumn("_upto", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    rows = rows.join(
        offsets, rows["_source"].eqNullSafe(offsets["_o_source"]) & (rows["_bucket"] == offsets["_o_bucket"])
    ).withColumn("_before", F.col("_offset") + F.col("_upto") - F.col("size"))
    # a copy belongs to the mix if its middle word lies below the target
    passes = F.floor((F.col("target") - F.col("_before") - F.col("size") / 2) / F.col("source_size")) + 1
    copies = F.when(F.col("source_size") > 0, F.greatest(F.lit(0), F.least(passes, F.lit(cap)))).otherwise(F.lit(0))
    rows = rows.withColumn("_copies", copies.cast("int"))

    def at(turn: Column) -> Column:
        demand = (turn * F.col("source_size") + F.col("_before")) / F.col("target")
        out = time_of(demand, schedules[-1])
        for number, schedule in enumerate(schedules[:-1]):
            out = F.when(F.col("schedule") == number, time_of(demand, schedule)).otherwise(out)
        return out

    turns = F.when(F.col("_copies") > 0, F.sequence(F.lit(0), F.col("_copies") - 1)).otherwise(
        F.array().cast("array<int>")
    )
    return rows.select(
        "doc",
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("_copies")).cast("long").alias("taken"),
        F.transform(turns, at).alias("positions"),
    )


def training_order(docs: DataFrame, schedules: Sequence[Schedule] = SCHEDULES, cap: int = CAP) -> DataFrame:
    """One row per copy that the mix takes, with its training ``position``, range-sorted by it."""
    plan = plan_mix(docs, schedules, cap).select("doc", F.explode("positions").alias("_position"))
    kept = [F.col(f"doc.`{c}`").alias(c) for c in docs.columns if c != "position"]
    return plan.select(*kept, F.col("_position").alias("position")).orderBy("position", "doc_id")


@query(
    "op1_mixing",
    """
    WITH d AS (
      SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))) AS h,
        CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size
      FROM documents),
    s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
    w AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1.0 AS weight FROM s),
    r AS (SELECT *, CAST(sum(source_size) OVER () AS BIGINT) AS total,
        CAST(coalesce(sum(3 * source_size) OVER o1, 0) AS BIGINT) AS used,
        sum(CAST(weight AS DOUBLE)) OVER o2 AS open
      FROM w WINDOW
        o1 AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
        o2 AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
    f AS (SELECT *, 3 * source_size < CAST(total - used AS DOUBLE) * weight / open AS isfull FROM r),
    t AS (SELECT source, source_size, CASE WHEN isfull THEN CAST(3 * source_size AS DOUBLE)
        ELSE CAST(total - coalesce(sum(CASE WHEN isfull THEN 3 * source_size END) OVER (), 0) AS DOUBLE) * weight
          / sum(CASE WHEN NOT isfull THEN CAST(weight AS DOUBLE) END) OVER () END AS target
      FROM f),
    c AS (SELECT d.doc_id, d.size, t.source_size, t.target,
        sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h, d.doc_id, d.size
          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - d.size AS before
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
    SELECT doc_id, size, source_size, target, CAST(CASE WHEN source_size = 0 THEN 0 ELSE
      size * greatest(0, least(3, floor((target - before - size / 2) / source_size) + 1)) END AS BIGINT) AS taken
    FROM c
    """,
)
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    plan = plan_mix(docs, carry=["doc_id"])
    first = F.try_element_at("positions", F.lit(1)).alias("position")
    rows = plan.select(F.col("doc.doc_id").alias("doc_id"), "size", "source_size", "target", "taken", first)
    return rows.orderBy(F.col("position").asc_nulls_last(), "doc_id").drop("position")
