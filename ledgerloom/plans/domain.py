"""End-to-end table jobs, composed from the operators; dates and code lists are parameters."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions import next_monthly, next_occurrence
from ledgerloom.operators.joins import asof_join, cell_of, full_add, merge_chain, not_in
from ledgerloom.operators.ordered import latest_per_key, over_neighbours, positions
from ledgerloom.operators.shaping import priority_case, unpivot
from ledgerloom.session import materialize, settled


def points_by_period(
    movements: DataFrame, payments: DataFrame, identities: DataFrame, days: int
) -> DataFrame:
    """Points per customer, tier and month; refunds count as minus (base minus bonus).

    ``movements``: payment_id, moved_at, base, bonus, is_refund. ``payments``: payment_id, wallet_id,
    paid_at. ``identities``: wallet_id, tier, effective_at, identity_no (only the newest per wallet
    counts). A movement belongs to its payment when both lie within ``days`` of each other.
    """
    newest = latest_per_key(identities, ["wallet_id"], [F.desc("effective_at"), F.desc("identity_no")])
    newest = settled(newest.select(F.col("wallet_id").alias("_wallet"), "tier"), "identity")
    near = F.abs(F.datediff("moved_at", "paid_at")) <= days
    matched = movements.join(payments, "payment_id").filter(near)
    points = F.when(F.col("is_refund"), -(F.col("base") - F.col("bonus"))).otherwise(F.col("base") + F.col("bonus"))
    # summed per wallet and month before the identity is looked up
    summed = matched.groupBy("wallet_id", F.trunc("moved_at", "MM").alias("month")).agg(F.sum(points).alias("points"))
    return (
        summed.join(newest, F.col("wallet_id") == F.col("_wallet"))
        .filter("points <> 0")
        .select("wallet_id", "tier", "month", "points")
    )


def lifetime_rollforward(
    lifetime: DataFrame, month: DataFrame, keys: Sequence[str], partner: str, partner_groups: Mapping[str, str], value: str
) -> DataFrame:
    """Lifetime balance plus the last month, partners folded into groups first."""
    def fold(df: DataFrame) -> DataFrame:
        c = F.col(partner)
        mapped = c
        for code, group in partner_groups.items():
            mapped = F.when(c == code, group).otherwise(mapped)
        return df.withColumn(partner, mapped).groupBy(*keys).agg(F.sum(value).alias(value))

    return full_add(fold(lifetime), fold(month), keys, [value])


def series_features(series: DataFrame, key: str, at: str, spend: str, limit: str, count: str) -> DataFrame:
    """Deltas, utilisation, rolling and change features of a series with one row per key and month.

    ``spend`` is in cents.
    """
    s = F.col(spend) / 100
    util = F.try_divide(s, F.col(limit).cast("double"))

    def columns(w):
        year, half = w.rowsBetween(-11, 0), w.rowsBetween(-5, 0)
        old = F.lag(util, 5).over(w)
        return {
            "utilisation": F.round(util, 6),
            "spend_delta": F.round(s - F.coalesce(F.lag(s, 1).over(w), F.lit(0.0)), 2),
            "n_12m": F.sum(count).over(year),
            "spend_6m": F.round(F.sum(spend).over(half) / 100, 2),
            "max_spend_12m": F.max(s).over(year),
            "ratio_6m_12m": F.round(F.try_divide(F.sum(spend).over(half) / 100, F.sum(spend).over(year) / 100), 6),
            "util_change_6m": F.round(F.try_divide(util - old, old), 6),
            "months_seen": F.count(F.lit(1)).over(year),
        }

    return over_neighbours(series, [key], [F.col(at)], columns, before=11, bounded=True)


def scorecard(df: DataFrame, bins: Mapping[str, Sequence[tuple[float | None, int]]], outlier: Column, name: str = "score") -> DataFrame:
    """Points per attribute by bin, summed; outliers get the reject score 1.

    ``bins``: per attribute, (upper bound, points) in ascending order, the last bound None.
    """
    points = []
    for attribute, steps in bins.items():
        c = F.when(F.lit(False), F.lit(0))
        for upper, value in steps:
            c = c.otherwise(value) if upper is None else c.when(F.col(attribute) <= upper, value)
        points.append(c)
    total = points[0]
    for p in points[1:]:
        total = total + p
    return df.withColumn(name, F.when(outlier, F.lit(1)).otherwise(total).cast("long"))


def survivor_history(
    versions: DataFrame, edges: DataFrame, customer: str, attribute: str, start: str, depth: int = 10
) -> DataFrame:
    """Validity intervals of a customer's attribute, with those inherited from merged customers.

    ``edges``: survivor, victim, merged_at. An open interval of a victim ends when it was merged.
    """
    own = over_neighbours(
        versions.select(customer, attribute, start).distinct(), [customer], [F.col(start), F.col(attribute)],
        lambda w: {"effective_to": F.lead(start).over(w)}, after=1,
    ).withColumnRenamed(start, "effective_from")
    chain = merge_chain(edges, "survivor", "victim", depth, ["merged_at"])
    inherited = chain.join(own, F.col("victim") == F.col(customer)).select(
        F.col("survivor").alias(customer), attribute, "effective_from",
        F.coalesce("effective_to", "merged_at").alias("effective_to"),
    )
    return own.select(*inherited.columns).unionByName(inherited).distinct()


def next_transfer(df: DataFrame, first: str, frequency: str, as_of: date) -> DataFrame:
    """Next date of a once, weekly, bi-weekly or monthly instruction on or after ``as_of``."""
    day = F.lit(as_of)
    f = F.col(first)
    nxt = (
        F.when(F.col(frequency) == "once", F.when(f >= day, f))
        .when(F.col(frequency) == "weekly", next_occurrence(first, day, 7))
        .when(F.col(frequency) == "bi-weekly", next_occurrence(first, day, 14))
        .when(F.col(frequency) == "monthly", next_monthly(first, day, F.dayofmonth(first)))
    )
    return df.withColumn("next_date", nxt)


def burndown_forecast(rates: DataFrame, as_of: date, horizon: int = 365) -> DataFrame:
    """Remaining work per day from ``as_of`` on, kept weekly and on the last day, never below zero.

    ``rates``: key, remaining, per_day, completed_on.
    """
    start = F.lit(as_of)
    last = F.least("completed_on", F.date_add(start, horizon))
    days = rates.filter(F.col("completed_on") >= start).withColumn("event_day", F.explode(F.sequence(start, last)))
    index = F.datediff("event_day", start)
    left = F.greatest(F.col("remaining") - F.col("per_day") * index, F.lit(0.0))
    kept = (F.pmod(index, F.lit(7)) == 0) | (F.col("event_day") == F.col("completed_on"))
    return days.filter(kept).withColumn("left", F.round(left, 4)).drop("remaining", "per_day")


def cumulative_flow(
    changes: DataFrame,
    group: str,
    entity: str,
    at: str,
    status: str,
    tie: Sequence[str],
    start: str,
    end: str,
    every: str,
    by_day: bool = False,
    calendars: DataFrame | None = None,
) -> DataFrame:
    """Entities per group and status at each point of a calendar, by the last status at or before it.

    Every status that a group shows at a point has a row at every point, with zero where no entity has it. ``by_day``
    compares days in place of instants. ``calendars`` (group, points: sorted array) replaces the common calendar. Work
    follows the changes: an entity's last change before each point adds one to its status and takes one from the former.
    A change's place in the common calendar is found block by block among its points, which are part of the expression; in a calendar of its
    group by an as-of join. No row carries a calendar. Changes without group, entity or time are left out.
    """
    spark = changes.sparkSession
    known = F.col(group).isNotNull() & F.col(entity).isNotNull() & F.col(at).isNotNull()
    rows = changes.filter(known)
    # whole numbers that order instants, or days
    number = (
        (lambda c: F.datediff(F.to_date(c), F.lit("1970-01-01").cast("date")).cast("long"))
        if by_day
        else (lambda c: F.unix_micros(F.col(c).cast("timestamp")))
    )
    if calendars is None:
        series = F.sequence(F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz"), F.expr(f"interval {every}"))
        calendar = spark.range(1).select(F.posexplode(series).alias("_slot", "point"))
        # a calendar is a list of report dates: it is part of the request
        edges = [r.n for r in calendar.orderBy("_slot").select(number("point").alias("n")).collect()]
        before = cell_of(number(at) - 1, edges, max(32, math.isqrt(len(edges))))
        rows = rows.withColumn("_slot", before).filter(F.col("_slot") < len(edges))
    else:
        calendar = calendars.select(group, F.posexplode("points").alias("_slot", "point"))
        points = calendar.select(group, (number("point") + 1).alias("_n"), (F.col("_slot") + 1).cast("long").alias("_after"))
        rows = rows.withColumn("_at", number(at)).join(calendars.select(F.col(group).alias("_c")), F.col(group) == F.col("_c"), "left_semi")
        rows = asof_join(rows, points, [group], "_at", "_n", ["_after"], ["_after"], keep_unmatched=True)
        rows = rows.withColumn("_slot", F.coalesce("_after", F.lit(0).cast("long")))
    last = rows.groupBy(group, entity, "_slot").agg(F.max_by(status, F.struct(at, *tie)).alias("_new"))
    # one row per entity and slot: bounded by the calendar
    former = F.lag("_new").over(Window.partitionBy(group, entity).orderBy("_slot"))
    had = F.lag(F.lit(True)).over(Window.partitionBy(group, entity).orderBy("_slot"))
    last = last.withColumns({"_old": former, "_had": had})
    plus = F.struct(F.col("_new").alias("s"), F.lit(1).alias("d"))
    minus = F.when(F.col("_had"), F.struct(F.col("_old").alias("s"), F.lit(-1).alias("d")))
    moves = last.select(group, "_slot", F.explode(F.array_compact(F.array(plus, minus))).alias("m"))
    steps = moves.groupBy(group, F.col("m.s").alias(status), "_slot").agg(F.sum("m.d").alias("_d"))
    steps = materialize(steps, "flow-steps")
    # the calendar meets the data here, once per group and status
    if calendars is None:
        shown = steps.select(group, status).distinct().crossJoin(F.broadcast(calendar))
    else:
        here = calendar.select(F.col(group).alias("_c"), F.col("_slot").alias("_p"))
        inside = steps.join(here, (F.col(group) == F.col("_c")) & (F.col("_slot") == F.col("_p")), "left_semi")
        shown = inside.select(group, status).distinct().join(calendar, group)
    steps = steps.select(
        F.col(group).alias("_g"), F.col(status).alias("_s"), F.col("_slot").alias("_k"), "_d"
    )
    on = (F.col(group) == F.col("_g")) & F.col(status).eqNullSafe(F.col("_s")) & (F.col("_slot") == F.col("_k"))
    upto = Window.partitionBy(group, status).orderBy("_slot").rowsBetween(Window.unboundedPreceding, 0)
    flow = shown.join(steps, on, "left").withColumn("n", F.sum(F.coalesce("_d", F.lit(0))).over(upto))
    return flow.select(group, "point", status, "n")


def with_creation_events(issues: DataFrame, changes: DataFrame, tie: str) -> DataFrame:
    """Change log with one creation event per issue: from its first change, else from its value.

    ``issues``: issue_key, created, value. ``changes``: issue_key, event_time, from_value, to_value.
    """
    known = changes.join(issues, "issue_key", "left_semi")
    first = known.groupBy("issue_key").agg(F.min_by("from_value", F.struct("event_time", tie)).alias("to_value"))
    changed = settled(first).join(issues.drop("value"), "issue_key")
    unchanged = issues.join(known.select("issue_key"), "issue_key", "left_anti").withColumnRenamed("value", "to_value")
    creation = changed.select("issue_key", "created", "to_value").unionByName(
        unchanged.select("issue_key", "created", "to_value")
    )
    return creation.select(
        "issue_key", F.col("created").alias("event_time"), F.lit(None).cast("string").alias("from_value"), "to_value"
    ).unionByName(known.select("issue_key", "event_time", "from_value", "to_value"))


def period_limits(limits: DataFrame, key: str, periods: Mapping[str, str]) -> DataFrame:
    """Maximum limit per customer and period type as one row each."""
    widest = limits.groupBy(key).agg(*[F.max(c).alias(c) for c in periods])
    return unpivot(widest, [key], periods, "period", "amount")


def purge_list(
    candidates: DataFrame, already_listed: DataFrame, key: str, reasons: Sequence[tuple[Column, str]], default: str, active: Column
) -> DataFrame:
    """Retention list: reason per candidate; active ones and those already listed are left out."""
    judged = candidates.withColumns(
        {"reason": priority_case(reasons, default), "purge_ind": F.when(active, 1).otherwise(0)}
    )
    blocked = judged.filter("purge_ind = 1").select(F.col(key).alias("_blocked"))
    return not_in(not_in(judged, blocked, key, "_blocked"), already_listed, key, already_listed.columns[0])


def anniversary(opened: Column, year: int) -> Column:
    """Anniversary in ``year``; 29 February becomes 1 March outside leap years."""
    leap = (year % 4 == 0 and year % 100 != 0) or year % 400 == 0
    on = F.make_date(F.lit(year), F.month(opened), F.dayofmonth(opened))
    if leap:
        return on
    is_leap_day = (F.month(opened) == 2) & (F.dayofmonth(opened) == 29)
    return F.when(is_leap_day, F.lit(date(year, 3, 1))).otherwise(
        F.make_date(F.lit(year), F.month(opened), F.when(is_leap_day, 1).otherwise(F.dayofmonth(opened)))
    )


def evaluation_events(accounts: DataFrame, as_of: date, changeover: date, before: str, after: str) -> DataFrame:
    """Accounts due on ``as_of``: closed that day with no balance, or open on their anniversary.

    ``accounts``: account_id, opened, closed, zero_balance. The threshold depends on the opening date.
    """
    day = F.lit(as_of)
    closure = F.coalesce((F.col("closed") == day) & F.col("zero_balance"), F.lit(False))
    due = F.col("closed").isNull() & (anniversary(F.col("opened"), as_of.year) == day)
    return (
        accounts.filter(closure | due)
        .withColumn("event", F.when(closure, "closure").otherwise("anniversary"))
        .withColumn("threshold", F.when(F.col("opened") >= F.lit(changeover), after).otherwise(before))
    )


def unified_feed(rails: Mapping[str, tuple[DataFrame, Mapping[str, str]]], layout: Sequence[str]) -> DataFrame:
    """Payment rails in one transaction layout; each rail maps its columns (SQL expressions) to it."""
    out = None
    for rail, (df, mapping) in rails.items():
        part = df.select(
            F.lit(rail).alias("rail"), *[F.expr(mapping[c]).alias(c) if c in mapping else F.lit(None).alias(c) for c in layout]
        )
        out = part if out is None else out.unionByName(part)
    return out


def statement_lines(parents: DataFrame, children: DataFrame, key: str, cycle: str, order: Sequence[Column]) -> DataFrame:
    """Parent line (sequence 0), numbered child lines, and a trailer per cycle with its counts.

    ``parents``: key, cycle, text. ``children``: key, text and the order columns.
    """
    numbered = positions(children, [key], order, "record_seq")
    lines = parents.select(key, cycle, F.lit(0).cast("long").alias("record_seq"), "text").unionByName(
        numbered.join(parents.select(key, cycle), key).select(key, cycle, "record_seq", "text")
    )
    # the trailer needs counts only, so the numbering runs once
    n_children = settled(children.groupBy(F.col(key).alias("_k")).agg(F.count(F.lit(1)).alias("_n")), "children")
    trailer = parents.join(n_children, F.col(key) == F.col("_k"), "left").groupBy(cycle).agg(
        (F.count(F.lit(1)) + F.coalesce(F.sum("_n"), F.lit(0))).alias("_all"), F.count(F.lit(1)).alias("_parents")
    )
    text = F.format_string("T%011d%011d", "_all", "_parents")
    return lines.unionByName(
        trailer.select(F.lit(None).cast(lines.schema[key].dataType).alias(key), cycle, F.lit(0).cast("long").alias("record_seq"), text.alias("text"))
    )


def end_of_day(
    accounts: DataFrame, status: DataFrame, balances: DataFrame, key: str, as_of: date
) -> DataFrame:
    """State per account at the end of ``as_of``: latest status, closing and opening balance.

    ``status``: key, at, no, status. ``balances``: key, at, no, balance.
    """
    def newest(df: DataFrame, values: dict[str, tuple[str, Column]]) -> DataFrame:
        order = F.struct("at", "no")
        seen = df.filter(F.to_date("at") <= F.lit(as_of))
        last = [
            F.max_by(value, F.when(F.to_date("at") <= until, order)).alias(name) for name, (value, until) in values.items()
        ]
        return settled(seen.groupBy(key).agg(*last), "end-of-day")

    day = F.lit(as_of)
    ends = {"closing": ("balance", day), "opening": ("balance", F.date_sub(day, 1))}
    return (
        newest(status, {"status": ("status", day)}).join(accounts, key).join(newest(balances, ends), key, "left")
    )


def reminder_list(states: DataFrame, key: str, now: str, max_reminders: int, min_hours: int) -> DataFrame:
    """Customers to remind: newest state NEW, or PENDING with few reminders and long enough ago.

    ``states``: key, status, changed_at, state_no, reminders.
    """
    newest = latest_per_key(states, [key], [F.desc("changed_at"), F.desc("state_no")])
    old = F.col("changed_at").isNull() | (
        F.col("changed_at") <= F.lit(now).cast("timestamp_ntz") - F.expr(f"interval {int(min_hours)} hour")
    )
    pending = (F.upper("status") == "PENDING") & (F.coalesce("reminders", F.lit(0)) < max_reminders) & old
    return newest.filter((F.upper("status") == "NEW") | pending)


def verification_decisions(
    attributes: DataFrame, key: str, name: str, single: Mapping[str, Sequence[str]], dual: Sequence[tuple[str, Sequence[tuple[str, str]]]]
) -> DataFrame:
    """One record per application and method from its attribute rows.

    ``single``: method -> attributes of which one is enough. ``dual``: (method, attribute pairs of
    which both must be present), in order of preference; used only without a single-source decision.
    """
    wanted = sorted({a for v in single.values() for a in v} | {a for _, ps in dual for p in ps for a in p})
    flags = attributes.groupBy(key).agg(*[F.max(F.when(F.col(name) == a, 1).otherwise(0)).alias(f"f_{a}") for a in wanted])
    has = lambda a: F.col(f"f_{a}") == 1
    any_of = lambda conditions: F.greatest(*[c.cast("int") for c in conditions], F.lit(0)) == 1
    one = priority_case([(any_of([has(a) for a in v]), m) for m, v in single.items()])
    two = priority_case([(any_of([has(a) & has(b) for a, b in ps]), m) for m, ps in dual])
    decided = flags.select(key, one.alias("_one"), two.alias("_two"))
    rows = F.array(
        F.when(F.col("_one").isNotNull(), F.struct(F.lit("single").alias("source"), F.col("_one").alias("method"))),
        F.when(F.col("_one").isNull() & F.col("_two").isNotNull(), F.struct(F.lit("dual").alias("source"), F.col("_two").alias("method"))),
        F.when(F.col("_one").isNull() & F.col("_two").isNull(), F.struct(F.lit("none").alias("source"), F.lit("exception").alias("method"))),
    )
    return decided.select(key, F.explode(F.filter(rows, lambda x: x.isNotNull())).alias("d")).select(key, "d.source", "d.method")


def derived_cases(items: Mapping[str, DataFrame], accounts: DataFrame) -> DataFrame:
    """Cases from notes, alerts and attachments: an item names a customer, or an account of one.

    Each item relation has item_id, customer_id and account_id (either may be NULL); ``accounts`` has
    account_id and customer_id. Both paths are taken and equal cases are merged.
    """
    out = None
    for kind, df in items.items():
        direct = df.filter("customer_id is not null").select("customer_id")
        through = df.filter("account_id is not null").select("account_id").distinct().join(accounts, "account_id").select("customer_id")
        part = direct.unionByName(through).select(F.lit(kind).alias("kind"), "customer_id").distinct()
        out = part if out is None else out.unionByName(part)
    return out.distinct()


def missing_rewards(transactions: DataFrame, merchants: DataFrame, rewards: DataFrame, keys: Sequence[tuple[str, str]]) -> DataFrame:
    """Transactions at campaign merchants without a reward row on the whole key."""
    at_campaign = transactions.join(merchants, "merchant_id", "left_semi")
    on = [transactions[a] == rewards[b] for a, b in keys]
    return at_campaign.join(rewards, on, "left_anti")


def open_failures(events: DataFrame, key: str, recovered: str, order: Sequence[Column], path: str) -> DataFrame:
    """Newest row of every event that was never recovered, with the last part of its dotted name."""
    done = events.filter(F.col("status") == recovered).select(F.col(key).alias("_done"))
    failed = events.join(done, F.col(key) == F.col("_done"), "left_anti")
    newest = latest_per_key(failed, [key], order)
    return newest.withColumn(path, F.element_at(F.split(path, r"\."), -1))


