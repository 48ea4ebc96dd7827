"""Chat formatting in windows of a token budget.

The turns of a conversation get prefix sums of their tokens; a window's targets are the turns that start inside one span
of equal length, so windows are aligned to turns and no window depends on how an earlier one was filled. A span is half of what the budget leaves after the
system turn and the history; a window so passes ``BUDGET`` only if it has a single turn longer than a span, and says so
in ``over_budget``. Every window but the first repeats the system turn, cut to ``SYSTEM_SHARE`` of the budget (a repeat is dropped when windows are read back, so
nothing is lost), and the turns that began in the last ``HISTORY`` tokens before it, if each is not longer than that. The loss mask covers assistant texts that are targets, never repeats: each assistant text once.

A turn is written ``<|turn|>role<|text|>text<|end|>`` and a newline. Inside roles and texts a backslash becomes two, ``<``
becomes ``\\l`` and ``[`` becomes ``\\b``; so no control string (of this template, ``</s>``, ``[INST]``, ...) can stand there, and all is reversible.

Order: by turn, nulls last; ties by role and text. A null role or text is empty; a null conv_id is a conversation of its own.
Equal rows are turns of their own. An empty table gives an empty result. Other columns are not read. Prefix sums are
taken over runs of turn numbers, so that no task needs a whole conversation.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import arrow_sized, query, table

BUDGET, HISTORY = 1024, 128
#: Share of the budget that a repeated system turn takes at most.
SYSTEM_SHARE = 0.25
#: Turn numbers that one run holds.
RUN = 4096
#: Tokens of a turn besides its text and role.
FRAME = 4
SYSTEM, ASSISTANT = "system", "assistant"
# fixed values: the template
TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>\n"
_CODES = {"\\\\": "\\", "\\l": "<", "\\b": "["}


def escaped(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(out, F.lit("<"), F.lit("\\l")), F.lit("["), F.lit("\\b"))


def unescaped(text: str) -> str:
    return re.sub(r"\\[\\lb]", lambda m: _CODES[m[0]], text)


def tokens(text: Column) -> Column:
    """About the number of a subword tokenizer's tokens: a quarter of the bytes, rounded up."""
    return F.ceil(F.octet_length(text) / 4).cast("long")


def turn_windows(turns: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """One row per window: conv_id, window, text, n_turns, n_repeated (its first turns), spans, n_tokens, over_budget.

    ``spans`` lists (start, length) of the loss mask in ``text``, in characters.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = turns.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"))
    head = F.concat(F.lit(TURN), escaped(F.col("role")), F.lit(TEXT))
    body = escaped(F.col("text"))
    rows = rows.select(
        "conv_id",
        F.floor(F.col("turn") / RUN).alias("run"),
        F.struct(F.col("turn").isNull().alias("none"), "turn", "role", "text").alias("order"),
        F.col("role"),
        F.concat(head, body, F.lit(END)).alias("piece"),
        F.length(head).alias("head"),
        F.length(body).alias("body"),
        (tokens(F.col("text")) + tokens(F.col("role")) + FRAME).alias("n"),
    )
    # prefix sums: inside runs of turn numbers, then over a conversation's runs
    runs = rows.groupBy("conv_id", "run").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("turns"))
    earlier = Window.partitionBy("conv_id").orderBy(F.col("run").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        F.col("conv_id").alias("r_id"),
        F.col("run").alias("r_run"),
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("r_tokens"),
        F.coalesce(F.sum("turns").over(earlier), F.lit(0)).alias("r_turns"),
    )
    inside = Window.partitionBy("conv_id", "run").orderBy("order")
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({"tokens": F.sum("n").over(upto), "place": F.row_number().over(inside)})
    rows = rows.join(runs, rows["conv_id"].eqNullSafe(runs["r_id"]) & rows["run"].eqNullSafe(runs["r_run"]))
    rows = rows.withColumns(
        {"start": F.col("r_tokens") + F.col("tokens") - F.col("n"), "place": F.col("r_turns") + F.col("place")}
    )
    first = rows.filter(F.col("role") == SYSTEM)
    # as many characters as tokens are allowed, so that they are enough in any script; an escape is not cut through
    most = int(budget * SYSTEM_SHARE)
    shown = F.regexp_replace(F.substring("piece", F.col("head") + 1, F.least(F.col("body"), F.lit(most))), r"(?<!\\)((?:\\\\)*)\\$", "$1")
    again = F.concat(F.substring("piece", F.lit(1), F.col("head")), shown, F.lit(END))
    long = F.col("n") > most
    first = first.withColumns(
        {"piece": F.when(long, again).otherwise(F.col("piece")), "n": F.when(long, F.lit(most + 2 * FRAME).cast("long")).otherwise(F.col("n"))}
    )
    system = first.groupBy(F.col("conv_id").alias("s_id")).agg(F.min(F.struct("place", "piece", "n")).alias("system"))
    rows = rows.join(system, rows["conv_id"].eqNullSafe(system["s_id"]), "left")
    room = F.lit(budget) - F.coalesce(F.col("system.n"), F.lit(0)) - 2 * history
    rows = rows.withColumn("span", F.greatest(F.floor(room / 2), F.lit(FRAME)).cast("long"))
    own = F.floor(F.col("start") / F.col("span")).cast("long")
    near = (own + 1) * F.col("span") - F.col("start") <= history
    is_system = F.coalesce(F.col("place") == F.col("system.place"), F.lit(False))
    again = F.when(near & (F.col("n") <= history) & ~is_system, F.struct((own + 1).alias("window"), F.lit(1).alias("kind")))
    copies = F.array_compact(F.array(F.struct(own.alias("window"), F.lit(2).alias("kind")), again))
    rows = rows.withColumn("copy", F.explode(copies))
    rows = rows.select("conv_id", "copy.window", "copy.kind", "place", "piece", "head", "body", "n", "role", "system")
    targets = rows.filter("kind = 2").groupBy("conv_id", "window").agg(
        F.first("system").alias("system"), F.min("place").alias("first")
    )
    repeats = targets.filter(F.col("system").isNotNull() & (F.col("system.place") < F.col("first"))).select(
        "conv_id",
        "window",
        F.lit(0).alias("kind"),
        "system.place",
        "system.piece",
        F.lit(0).alias("head"),
        F.lit(0).alias("body"),
        "system.n",
        F.lit(SYSTEM).alias("role"),
    )
    rows = rows.drop("system").unionByName(repeats)
    # a window has few turns: each takes FRAME tokens of the span or of the history
    before = Window.partitionBy("conv_id", "window").orderBy("kind", "place").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("at", F.coalesce(F.sum(F.length("piece")).over(before), F.lit(0)) + F.col("head"))
    span = F.when(
        (F.col("kind") == 2) & (F.col("role") == ASSISTANT),
        F.struct(F.col("at").alias("start"), F.col("body").cast("long").alias("length")),
    )
    parts = F.struct("kind", "place", "piece", span.alias("span"))
    done = rows.groupBy("conv_id", "window").agg(
        F.array_sort(F.collect_list(parts)).alias("parts"),
        F.count_if(F.col("kind") < 2).cast("int").alias("n_repeated"),
        F.count(F.lit(1)).cast("int").alias("n_turns"),
        F.sum("n").alias("n_tokens"),
    )
    spans = F.filter(F.transform("parts", lambda p: p["span"]), lambda x: x.isNotNull())
    return done.filter(F.col("n_repeated") < F.col("n_turns")).select(
        "conv_id",
        "window",
        F.array_join(F.transform("parts", lambda p: p["piece"]), "").alias("text"),
        "n_turns",
        "n_repeated",
        spans.alias("spans"),
        "n_tokens",
        (F.col("n_tokens") > budget).alias("over_budget"),
    )


def read_turns(text: str) -> list[tuple[str, str]]:
    """(role, text) of the turns of a formatted window."""
    turns = text.split(TURN)[1:]
    pairs = (t.removesuffix(END).split(TEXT, 1) for t in turns)
    return [(unescaped(role), unescaped(said)) for role, said in pairs]


class _Digest:
    """Running digests of one conversation; constant size, whatever its length."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.turns, self.loss, self.chars = conv_id, 0, 0, 0
        self.turns_hash, self.loss_hash = hashlib.sha256(), hashlib.sha256()

    def add(self, text: str, repeated: int, spans: list[dict]) -> None:
        self.chars += len(text)
        for role, said in read_turns(text)[repeated:]:
            self.turns += 1
            self.turns_hash.update(f"{role}\n{said}\n".encode())
        for span in spans:
            said = unescaped(text[span["start"] : span["start"] + span["length"]])
            self.loss += len(said)
            self.loss_hash.update(said.encode())

    def row(self) -> dict:
        return {
            "conv_id": self.conv_id,
            "n_turns": self.turns,
            "turns_sha256": self.turns_hash.hexdigest(),
            "loss_chars": self.loss,
            "loss_sha256": self.loss_hash.hexdigest(),
            "formatted_chars": self.chars,
        }


_READ = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
_READ_ARROW = pa.schema(
    [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string())]
    + [("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]
)


def _read_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now = None
    for batch in batches:
        out = []
        columns = (batch.column(c).to_pylist() for c in ("conv_id", "text", "n_repeated", "spans"))
        for conv_id, text, repeated, spans in zip(*columns, strict=True):
            if now is None or now.conv_id != conv_id:
                if now is not None:
                    out.append(now.row())
                now = _Digest(conv_id)
            now.add(text, repeated, spans)
        if out:
            yield pa.RecordBatch.from_pylist(out, _READ_ARROW)
    if now is not None:
        yield pa.RecordBatch.from_pylist([now.row()], _READ_ARROW)


def read_back(windows: DataFrame) -> DataFrame:
    """Digests of each conversation, read from its windows in order."""
    arrow_sized(windows.sparkSession)
    rows = windows.select(F.col("conv_id").cast("long").alias("conv_id"), "window", "text", "n_repeated", "spans")
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "window").mapInArrow(_read_rows, _READ)


@query("op4_chat_format")
def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, ASSISTANT, said)], turns.schema)
    return read_back(turn_windows(turns.unionByName(probe)))
