"""The operators for training text against SQL, brute force, round trips and held-out accuracy."""

from __future__ import annotations

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from conftest import SMALL, spark_table, table_of
from pyspark.sql import functions as F

from ledgerloom.llm import bytesops as B
from ledgerloom.llm import (
    chat,
    convnet,
    decontamination,
    langid,
    lm,
    mixing,
    neardup,
    quality,
    rules,
    suffixes,
    toxicity,
)
from ledgerloom.llm.common import table
from ledgerloom.llm.queries import QUERIES, SQL

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size long, score string, spans string, target int"
#: Nulls everywhere, empty and long texts, repeated rows, equal ids.
ODD = [
    (1, "alpha beta gamma delta epsilon zeta eta", "en", "a", 5, 1, "x", "y", 1),
    (1, "alpha beta gamma delta epsilon zeta eta", "en", "a", 5, 1, "x", "y", 1),
    (2, None, None, None, None, None, None, None, None),
    (3, "", "en", "b", 0, 0, "", "", 0),
    (None, "alpha beta gamma delta epsilon zeta eta", None, "b", 1, 1, "z", "z", 3),
    (4, " \n\t ", "de", None, 4, 4, "q", "q", 4),
    (5, "ßé 漢字 " * 3000, "de", "a", 9, 9, "r", "r", 5),
    (6, "one", "fr", "b", 3, 3, "s", "s", 6),
    (7, "12345 !!! ###", "fr", "b", 3, 3, "s", "s", 6),
]
MEDIUM = SMALL.replace("sf0.001", "sf0.01")
SPLIT = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return SPLIT.findall(text or "")


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, SMALL, "documents")


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text for r in docs.collect()}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, duck, name):
    cursor = duck.execute(SQL[name])
    want = table_of([c[0] for c in cursor.description], cursor.fetchall())
    assert spark_table(QUERIES[name](spark, SMALL)) == want


def test_all_and_the_pipeline_are_registered():
    import __spark_entry__ as entry_point

    names = entry_point.queries()
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(names)


# --- words and hashes


def test_words_of_a_batch():
    given = ["a bb  ccc", None, "", " x", "é ", "y", "\x1fz\x0bq"]
    buf, offsets = B.packed(pa.array(given))
    starts, ends, first = B.word_spans(buf, offsets)
    got = [[buf[a:b].tobytes().decode() for a, b in zip(starts[i:j], ends[i:j])] for i, j in zip(first, first[1:])]
    assert got == [words(t) for t in given]


def test_short_words_hash_alike_in_any_company():
    alone, among = (B.word_hashes(*(x := np.frombuffer(t, np.uint8), *B.word_spans(x, np.array([0, len(x)]))[:2])) for t in (b"a b", b"a longer b"))
    assert alone.tolist() == [among[0], among[2]]


def test_equal_words_have_equal_hashes(monkeypatch):
    monkeypatch.setattr(B, "SLICE", 7)
    rng = random.Random(1)
    given = ["".join(rng.choice("abC") for _ in range(rng.randrange(1, 9))) for _ in range(400)]
    buf, offsets = B.packed(pa.array([" ".join(given)]))
    starts, ends, _ = B.word_spans(buf, offsets)
    for lower in (False, True):
        hashes = B.word_hashes(buf, starts, ends, lower)
        named = {}
        for w, h in zip(given, hashes.tolist()):
            assert named.setdefault(w.lower() if lower else w, h) == h
        assert len(set(named.values())) == len(named)


# --- 1 mixing


def test_targets_are_shared_out_under_the_cap(spark):
    sizes = [("a", 100), ("b", 10), ("c", 10), (None, 5), ("d", 0)]
    got = {r.source: r.target for r in mixing.source_targets(spark.createDataFrame(sizes, "source string, size long")).collect()}
    weight = {"a": 1, "b": 2, "c": 3, "d": 1, None: 2}
    size, total = dict(sizes), 125
    want, open_, rest = {}, set(size), total
    while True:
        share = {s: rest * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > 3 * size[s]}
        if not over:
            want |= share
            break
        for s in over:
            want[s] = 3 * size[s]
            rest -= want[s]
        open_ -= over
    assert got == pytest.approx(want)


def test_mix_meets_its_targets_and_reruns_agree(docs):
    rows = mixing.plan_mix(docs, carry=["doc_id", "source"]).collect()
    taken, target, longest = collections.Counter(), {}, collections.Counter()
    for r in rows:
        taken[r.doc.source] += r.taken
        target[r.doc.source] = r.target
        longest[r.doc.source] = max(longest[r.doc.source], r.size)
        assert r.taken == r.size * len(r.positions) <= 3 * r.size
    assert all(abs(taken[s] - target[s]) <= longest[s] / 2 + 1 for s in target)
    again = mixing.plan_mix(docs.repartition(7), carry=["doc_id", "source"]).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))


def test_training_times_follow_the_schedules(spark, docs):
    many = spark.range(900).select(
        F.col("id").alias("doc_id"), F.lit("a b c").alias("text"), F.concat(F.lit("s"), F.col("id") % 3).alias("source")
    )
    rows = mixing.plan_mix(many).select("doc.source", F.explode("positions").alias("t")).collect()
    for place, schedule in enumerate(mixing.SCHEDULES):
        own = [r.t for r in rows if r.source == f"s{place}"]
        for t in (0.25, 0.5, 0.75):
            wanted, at = 0.0, np.linspace(0, t, 2001)
            weights = np.interp(at, *zip(*schedule))
            wanted = float(((weights[1:] + weights[:-1]) / 2 * np.diff(at)).sum()) / mixing.integral(schedule)
            assert sum(x < t for x in own) / len(own) == pytest.approx(wanted, abs=0.01)
    out = mixing.training_order(docs).select("position").collect()
    assert [r.position for r in out] == sorted(r.position for r in out)


def test_rows_without_ids_are_spread(spark):
    rows = spark.range(4000).select(F.lit(None).cast("long").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"), F.lit("a").alias("source"))
    plan = mixing.plan_mix(rows)
    assert plan.agg(F.sum("taken")).first()[0] == 8000
    hashed = plan._jdf.queryExecution().optimizedPlan().toString()
    assert hashed.count("md5") > 1
    times = [r.positions[0] for r in plan.select("positions").collect()]
    assert len(set(times)) == 4000


def test_mixing_odd_rows(odd, nothing):
    rows = mixing.plan_mix(odd).collect()
    assert sorted(r.size for r in rows) == sorted(len(words(r[1])) for r in ODD)
    assert "position" in mixing.training_order(odd).columns
    assert mixing.training_order(nothing).isEmpty() and mixing.plan_mix(nothing).isEmpty()


# --- 2 and 3 the byte networks


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(3)
    x = rng.integers(0, 256, (5, 20)).astype(np.uint8)
    y = np.eye(3, dtype=np.float32)[rng.integers(0, 3, 5)]
    net = convnet.fresh(3, (2, 3), 4, 3, 1)
    _, slopes = convnet.gradients(net, x, y)
    for p, g in zip(net.parameters(), slopes, strict=True):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        old, step = p[at].copy(), 1e-2
        p[at] = old + step
        up = convnet.gradients(net, x, y)[0]
        p[at] = old - step
        down = convnet.gradients(net, x, y)[0]
        p[at] = old
        assert (up - down) / (2 * step) == pytest.approx(g[at], rel=0.1, abs=1e-3)


def test_scoring_tables_give_the_same_shares():
    rng = np.random.default_rng(4)
    x = rng.integers(0, 256, (70, 32)).astype(np.uint8)
    net = convnet.fresh(2, (2, 3, 5), 6, 4, 2)
    seen, parts = net.embed[x], []
    for f, b in zip(net.filters, net.biases, strict=True):
        views = np.lib.stride_tricks.sliding_window_view(seen, len(f), axis=1).transpose(0, 1, 3, 2)
        parts.append(np.maximum(np.einsum("nlwe,wek->nlk", views, f).max(axis=1) + b, 0))
    want = convnet.softmax(np.concatenate(parts, axis=1) @ net.dense + net.bias)
    assert np.allclose(convnet.Scorer(net).shares(x), want, atol=1e-4)


def test_windows_cover_whole_texts():
    buf, offsets = B.packed(pa.array(["x" * 1000, "", "yy", "z" * 256]))
    text, start, used = convnet.cut(buf, offsets, 256, 224)
    for i, (a, b) in enumerate(zip(offsets, offsets[1:])):
        covered = set()
        for s, n in zip(start[text == i], used[text == i]):
            covered |= set(range(s, s + n))
        assert covered == set(range(a, b))


def test_languages_are_told_apart(docs):
    rows = langid.identify(docs.select("doc_id", "text"), docs).collect()
    truth = {r.doc_id: r.lang for r in docs.collect()}
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) > 0.9
    assert all(0 <= r.score <= 1 for r in rows)


def test_windows_are_drawn_over_whole_texts(spark):
    # what tells the languages apart stands behind the first 5000 bytes
    rows = [(i, "x" * 5000 + (" eins zwei drei" if i % 2 else " uno dos tres") * 300, "de" if i % 2 else "es") for i in range(300)]
    few = langid.sampled(spark.createDataFrame(rows, "doc_id long, text string, lang string"), "lang", 100, 256, 4)
    pieces = [(r.label, bytes(r.piece).decode()) for r in few.collect()]
    assert len(pieces) == 800 and {len(p) for _, p in pieces} == {256}
    for label, word in (("de", "zwei"), ("es", "dos")):
        assert 0.3 < sum(word in p for x, p in pieces if x == label) / 400 < 0.7
    assert all(("dos" in p) <= (x == "es") for x, p in pieces)
    short = spark.createDataFrame([(1, "short", "de"), (2, "", "de"), (3, "m" * 600, "de")], "doc_id long, text string, lang string")
    assert sorted(len(r.piece) for r in langid.sampled(short, "lang", 100, 256, 4).collect()) == [0, 5, 256, 256]


def test_a_column_of_very_many_languages_is_refused(spark, monkeypatch):
    monkeypatch.setattr(langid, "MOST_LANGS", 3)
    rows = spark.createDataFrame([(i, "text", f"l{i}") for i in range(9)], "doc_id long, text string, lang string")
    with pytest.raises(ValueError, match="more than 3"):
        langid.learn(rows)


def test_language_of_odd_rows(odd, nothing):
    got = collections.defaultdict(set)
    for r in langid.identify(odd).collect():
        got[r.doc_id].add(r.lang_pred)
    assert got[2] == got[3] == got[4] == got[7] == {"und"}
    assert got[1] <= {"en", "de", "fr"} and "und" not in got[None]
    assert langid.identify(nothing).isEmpty()
    unlabelled = odd.withColumn("lang", F.lit(None).cast("string"))
    assert {(r.lang_pred, r.score) for r in langid.identify(unlabelled).collect()} == {("und", 0.0)}


def labelled(rows, labels, column, folds, held_out):
    truth = {r.doc_id: r[column] for r in labels.collect()}
    return [(r.score, truth[r.doc_id]) for r in rows if r.doc_id in truth and zlib.crc32(str(r.doc_id).encode()) % folds == held_out]


def area(pairs):
    """Share of pairs of a 1 and a 0 that the score orders rightly."""
    ones, zeros = ([s for s, y in pairs if y == k] for k in (1, 0))
    return sum((a > b) + 0.5 * (a == b) for a in ones for b in zeros) / (len(ones) * len(zeros))




def plain_shares(net, raw, length):
    """Class shares of one window, byte by byte."""
    x = raw[:length] + bytes(max(0, length - len(raw)))
    seen, features = [net.embed[b] for b in x], []
    for f, bias in zip(net.filters, net.biases, strict=True):
        w = f.shape[0]
        active = [sum(seen[i + k] @ f[k] for k in range(w)) for i in range(length - w + 1)]
        features += np.maximum(np.max(active, axis=0) + bias, 0).tolist()
    z = np.array(features) @ net.dense + net.bias
    return np.exp(z - z.max()) / np.exp(z - z.max()).sum()


def plain_windows(raw, length, step):
    starts = [0] if raw else []
    while starts and starts[-1] + length < len(raw):
        starts.append(starts[-1] + step)
    return [raw[a : a + length] for a in starts]


SAMPLES = ["Das ist ein kurzer Text.", "é", "one two three " * 40, "x" * 256, "y" * 257, "ab " * 180, "Ende, fin, end! " * 45]


def test_languages_against_a_plain_computation(spark):
    net = convnet.fresh(3, (2, 4, 6), 5, 8, 7)
    docs = spark.createDataFrame(list(enumerate(SAMPLES)), "doc_id long, text string")
    for r in langid.with_language(docs, net, ["a", "b", "c"]).collect():
        parts = plain_windows(r.text.encode(), langid.LENGTH, langid.LENGTH)
        shares = sum(len(w) * plain_shares(net, w, langid.LENGTH) for w in parts) / sum(map(len, parts))
        assert r.lang_pred == "abc"[int(shares.argmax())] and r.score == pytest.approx(shares.max(), abs=1e-4)


def test_quality_against_a_plain_computation(spark):
    net = convnet.fresh(2, (2, 4, 6), 5, 8, 9)
    docs = spark.createDataFrame(list(enumerate(SAMPLES)), "doc_id long, text string")
    for r in quality.with_score(docs, net).collect():
        parts = plain_windows(SAMPLES[r.doc_id].encode(), quality.LENGTH, quality.STEP)
        good = [min(max(plain_shares(net, w, quality.LENGTH)[1], 1e-4), 1 - 1e-4) for w in parts]
        odds = sum(len(w) * math.log(g / (1 - g)) for w, g in zip(parts, good, strict=True)) / sum(map(len, parts))
        assert r.score == pytest.approx(1 / (1 + math.exp(-odds)), abs=1e-4)


def test_quality_on_held_out_rows(spark):
    docs, labels = table(spark, MEDIUM, "documents"), table(spark, MEDIUM, "labels")
    rows = quality.score_quality(docs, labels).collect()
    assert area(labelled(rows, labels, "quality", 3, 1)) > 0.9


@pytest.mark.parametrize("score", [quality.score_quality, toxicity.score_toxicity])
def test_scores_of_odd_rows(spark, odd, nothing, score):
    labels = spark.createDataFrame([(1, 1, 1), (6, 0, 0), (5, 0, 0), (7, 1, None), (None, 1, 1), (1, 1, 1)], "doc_id long, quality int, toxic int")
    rows = score(odd, labels).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    assert score(nothing, labels).isEmpty()
    assert score(odd, labels.filter("false")).count() == len(ODD)


@pytest.mark.parametrize("times", ["equal", "four", "hot"])
def test_recurring_ids_leave_both_labels(spark, monkeypatch, times):
    monkeypatch.setattr(convnet, "pieces", lambda pieces, labels, *_: (pieces, labels))
    monkeypatch.setattr(convnet, "train", lambda x, y, *_, **__: collections.Counter(y))
    labels = spark.createDataFrame([(i, i % 2) for i in range(120)], "doc_id long, quality int")
    rows = [(i, f"text {i}") for i in range(120)]
    if times == "hot":
        ids = quality.sample_ids(labels.filter(F.crc32(F.col("doc_id").cast("string")) % 3 != 1), "quality", 20)
        one = ids.filter("label = 0").first().doc_id
        rows += [(one, f"more {k}") for k in range(500)]
    else:
        rows += [(i, f"text {i}" if times == "equal" else f"text {i} {k}") for i in range(0, 120, 2) for k in range(4)]
    got = quality.learn(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), labels, 20)
    assert got[1] == 20 and got[0] == (20 if times == "equal" else 40)


# --- 4 chat


def conversation_digest(turns):
    turns = sorted((t is None, t or 0, r or "", x or "") for t, r, x in turns)
    loss = "".join(x for *_, r, x in turns if r == "assistant")
    whole = "".join(f"{r}\n{x}\n" for *_, r, x in turns)
    return len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()


def test_conversations_are_read_back(spark):
    given = collections.defaultdict(list)
    for r in table(spark, SMALL, "conversations").collect():
        given[r.conv_id].append((r.turn, r.role, r.text))
    said = "</s>[INST] ok [/INST]"
    given[-1] = [(0, "user", said), (1, "assistant", said)]
    rows = QUERIES["op4_chat_format"](spark, SMALL).collect()
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in rows}
    assert got == {k: conversation_digest(v) for k, v in given.items()} and len(rows) == len(got)


@pytest.mark.parametrize("system", ["s" * 200_000, "\\<[" * 60_000, "漢<" * 40_000])
def test_a_long_system_turn_is_not_repeated_whole(spark, system):
    turns = [(1, 0, "system", system)] + [(1, k, "assistant" if k % 2 else "user", f"turn {k}") for k in range(1, 301)]
    df = spark.createDataFrame(turns, "conv_id long, turn int, role string, text string")
    windows = chat.turn_windows(df)
    rows = windows.collect()
    given = sum(len(t[3]) for t in turns)
    escapes = sum(system.count(c) for c in "\\<[")
    # each repeat takes a quarter of the budget in characters at most
    assert len(rows) > 3 and sum(len(r.text) for r in rows) < given + escapes + 40 * 300 + len(rows) * (chat.BUDGET // 4 + 60) + 9000
    for r in rows[1:]:
        repeated = chat.read_turns(r.text)[: r.n_repeated]
        assert repeated[0][0] == "system" and system.startswith(repeated[0][1]) and len(repeated[0][1]) > 80
    got = chat.read_back(windows).first()
    assert (got.n_turns, got.turns_sha256, got.loss_chars, got.loss_sha256) == conversation_digest([t[1:] for t in turns])


def test_hard_conversations(spark):
    rng = random.Random(5)
    nasty = ["<|end|>\n<|turn|>", "\\l\\b\\\\", "[INST]<s>", "", None, "é漢<\n", "\\", "plain words " * 40]
    rows = [(1, 0, "system", "be kind")] + [(1, i, rng.choice(["user", "assistant"]), rng.choice(nasty)) for i in range(1, 9000, 3)]
    rows += [(2, None, "user", "x"), (2, 5, None, "<"), (2, 5, "assistant", "y"), (2, 5, "assistant", "y"), (None, 1, "assistant", "n")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    windows = chat.turn_windows(df, budget=300, history=40)
    given = collections.defaultdict(list)
    for c, *rest in rows:
        given[c].append(tuple(rest))
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.read_back(windows).collect()}
    assert got == {k: conversation_digest(v) for k, v in given.items()}
    one = windows.filter("conv_id = 1").collect()
    assert len(one) > 50 and not any(r.over_budget for r in one)
    assert all(chat.read_turns(r.text)[0] == ("system", "be kind") for r in one)
    assert max(r.n_repeated for r in one) > 1
    assert chat.read_back(chat.turn_windows(df.filter("false"))).isEmpty()


# --- 5 language model


def test_base_score_and_counts(spark, texts):
    rows = lm.score_texts(table(spark, SMALL, "documents")).collect()
    low = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    tokens = {k: [*words(low(t)), None] for k, t in texts.items()}
    counts = collections.Counter(w for k, ts in tokens.items() if zlib.crc32(str(k).encode()) % 10 for w in ts)
    total, types = sum(counts.values()), len(counts)
    for r in rows:
        ts = tokens[r.doc_id]
        base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (types + 1))) for w in ts)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(ts), sum(counts[w] > 0 for w in ts), total)
        assert r.base_score == pytest.approx(base, rel=1e-9)
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 10 == 0]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_the_model_is_a_distribution():
    Row = collections.namedtuple("Row", "kind n types once twice")
    found = [Row(lm.RARE, 4, 4, 4, 0), Row(lm.END_CLASS, 7, 1, 0, 0), Row(lm.LOOSE, 6, 3, 0, 3), Row(3, 17, 2, 0, 0), Row(5, 33, 1, 0, 0)]
    classes = lm.class_table(found, np.eye(lm.DIMS, dtype=np.float32)[:3])
    assert (classes.total, classes.types, classes.once, classes.count) == (67, 11, 4, 6)
    counts = {lm.LOOSE: [2, 2, 2], 3: [9, 8], 5: [33]}
    inside = {lm.RARE: classes.unseen + 4 * (1 - classes.unseen) / classes.once, lm.END_CLASS: 1.0}
    inside |= {kind: sum(c / classes.tokens[kind] for c in cs) for kind, cs in counts.items()}
    assert all(v == pytest.approx(1) for v in inside.values())
    assert {k for k, n in enumerate(classes.tokens) if n} <= set(inside)
    rng = np.random.default_rng(1)
    p = lm._scores(rng.normal(size=(lm.FEATURES, classes.count)).astype(np.float32), np.zeros(classes.count, np.float32), rng.integers(0, lm.FEATURES, (9, 4)).astype(np.uint16))
    assert np.allclose(p.sum(axis=1), 1, atol=1e-5)


def python_score(tokens, known, classes, weights, bias):
    """log10 probability of one text, step by step; tokens are hashes, ``known`` gives count and direction."""
    kinds, inside = [], 0.0
    for t in tokens:
        n, signs = known[t]
        if t == int(lm._END):
            kind, share = lm.END_CLASS, 1.0
        elif n < 2:
            kind = lm.RARE
            share = (1 - classes.unseen) / classes.once if n else classes.unseen
        else:
            kind = lm.LOOSE
            if signs is not None:
                x = np.frombuffer((signs % (1 << 64)).to_bytes(8, "little"), np.int8).astype(float)
                kind = lm.FIRST_CLUSTER + int(np.argmax([np.dot(c, x) for c in classes.centroids]))
            share = n / classes.tokens[kind]
        kinds.append(kind)
        inside += math.log10(share)
    marks = [int(B.mix(np.array([t], np.uint64))[0]) & 0xFFFF for t in tokens]
    total = inside
    for i, kind in enumerate(kinds):
        word = lambda k: marks[i - k] + 1 if i >= k else 0  # noqa: B023, E731
        of = lambda k: kinds[i - k] + 1 if i >= k else 0  # noqa: B023, E731
        features = (word(1), word(2), of(1) * 256 + of(2), (of(1) * 256 + of(2)) * 256 + of(3))
        z = bias.astype(float).copy()
        for j, x in enumerate(features):
            x = (x + j + 1) * int(lm._SEEDS[j]) % 2**32
            x = (x ^ (x >> 15)) * 0x2C1B3C6D % 2**32
            z += weights[(x ^ (x >> 13)) % lm.ROWS + (lm.ROWS if j > 1 else 0)]
        total += (z[kind] - z.max() - math.log(np.exp(z - z.max()).sum())) / math.log(10)
    return total


def test_scores_against_a_plain_computation(spark, monkeypatch):
    docs = table(spark, SMALL, "documents").select("doc_id", "text")
    encoded, looked, classes = lm.prepared(docs)
    weights, bias = lm.fit(encoded, classes)
    assert np.abs(weights).max() > 0.1 and classes.count > lm.FIRST_CLUSTER + 10
    # the query's own run, from the same weights
    monkeypatch.setattr(lm, "prepared", lambda _: (encoded, looked, classes))
    monkeypatch.setattr(lm, "fit", lambda *_: (weights, bias))
    got = {r.doc_id: r.score for r in lm.score_texts(docs).collect()}
    known = {r.token % 2**64: (r.n, r.signs) for r in looked.collect()}
    for doc_id, text in [*((r.doc_id, r.text) for r in docs.limit(25).collect())]:
        raw = (text or "").encode()
        tokens, _ = lm._tokens(pa.RecordBatch.from_pydict({"text": pa.array([text], pa.string())}))
        assert len(tokens) == len(SPLIT.findall(raw.decode())) + 1
        want = python_score([int(t) for t in tokens], known, classes, weights, bias)
        assert got[doc_id] == pytest.approx(want, rel=1e-4)


def test_directions_are_those_of_the_neighbours(spark):
    rows = [(i, t) for i, t in enumerate(["a b a b", "b a", "c", None, "a a b"]) if i is not None]
    docs = spark.createDataFrame([*rows, (None, "a b b")], "doc_id long, text string").withColumn("train", F.col("doc_id").isNotNull())
    blocked = docs.select("doc_id", "train", F.lit(0).alias("part"), "text", F.lit(0).cast("long").alias("block")).coalesce(1)
    schema = "block long, token long, n long, " + ", ".join(f"{c} long" for c in lm._SIGNS)
    got = {r.token % 2**64: r for r in blocked.select("block", "train", "text").mapInArrow(lm._token_rows, schema).collect()}
    code = {w: int(lm._tokens(pa.RecordBatch.from_pydict({"text": pa.array([w])}))[0][0]) for w in "abc"}
    sign = lambda w, d: 1 if int(B.mix(np.array([code[w]], np.uint64))[0]) >> (40 + d) & 1 else -1
    # neighbours of a in texts that are learned from: b b b b | b | a, a b
    for d in range(lm.DIMS):
        assert got[code["a"]][lm._SIGNS[d]] == 4 * sign("b", d) - sign("b", d) + sign("b", d) + 2 * sign("a", d) + sign("b", d)
    assert got[code["a"]].n == 5 and got[code["b"]].n == 4 and got[code["c"]].n == 1 and got[code["c"]].s0 is None


def test_centroids_part_two_languages():
    rng = np.random.default_rng(5)
    truth = rng.random(600) < 0.5
    x = np.clip(np.where(truth[:, None], 60, -60) * np.array([1, 1, 1, 1, -1, -1, -1, 1]) + rng.normal(0, 25, (600, 8)), -127, 127).astype(np.int8)
    centroids = lm.fit_centroids(x.view("<i8").ravel(), rng.integers(2, 999, 600), 2)
    nearest = (lm.directions(x.view("<i8").ravel()) @ centroids.T).argmax(axis=1)
    assert max((nearest == truth).mean(), (nearest != truth).mean()) > 0.99
    assert len(lm.fit_centroids(x[:3].view("<i8").ravel(), np.ones(3), 40)) == 3


def test_all_types_fit_the_centroids(spark, monkeypatch):
    """However many types there are, each has its part in the cells of directions, by its weight."""
    seen, fit = [], lm.fit_centroids_of_cells
    monkeypatch.setattr(lm, "fit_centroids_of_cells", lambda sums, weight: seen.append((sums, weight)) or fit(sums, weight))
    text = lambda r: " ".join(f"w{i} w{i}" for i in range(r * 400, r * 400 + 400))
    docs = spark.createDataFrame([(r, text(r)) for r in range(80)], "doc_id long, text string")
    _, looked, classes = lm.prepared(docs)
    types = looked.filter("is_first and n > 1 and signs is not null").select("n", "signs").toPandas()
    (sums, weight), = seen
    assert len(types) > 20_000 and len(weight) <= lm.LEVELS**lm.DIMS
    assert weight.sum() == pytest.approx(np.sqrt(types.n).sum(), rel=1e-4)
    x = lm.directions(types.signs.to_numpy(np.int64))
    assert sums.sum(axis=0) == pytest.approx((np.sqrt(types.n.to_numpy())[:, None] * x).sum(axis=0), abs=1)
    assert len(classes.centroids) == lm.CLUSTERS


def per_token(rows):
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 10 == 0]
    train = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 10]
    mean = lambda part, c: sum(r[c] for r in part) / sum(r.n_tokens for r in part)
    return mean(held, "base_score"), mean(held, "score"), mean(train, "base_score"), mean(train, "score")


def test_contexts_are_learned(spark):
    docs = table(spark, MEDIUM, "documents").select("doc_id", "text").repartition(2, "doc_id")
    base, untrained, *_ = per_token(lm.score_texts(docs, 0).collect())
    _, trained, seen_base, seen = per_token(lm.score_texts(docs).collect())
    assert untrained > base + 0.3 and trained > untrained + 0.08
    assert seen > seen_base + 0.05


def test_segment_sums():
    rng = np.random.default_rng(2)
    ids = np.sort(np.minimum(rng.zipf(1.3, 3000), 200))
    x, start = rng.normal(size=(3000, 4)), np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
    order, sums = lm._segment_sums(x, start)
    assert np.allclose(np.add.reduceat(x, start)[order], sums)


def test_segment_sums_of_chosen_rows():
    rng = np.random.default_rng(3)
    x, at, start = rng.normal(size=(50, 4)), rng.integers(0, 50, 400), np.array([0, 1, 2, 7, 120, 399])
    order, sums = lm._segment_sums(x, start, at=at)
    assert np.allclose(np.add.reduceat(x[at], start)[order], sums)


@pytest.mark.parametrize("low", [0, 60])
def test_tokens_are_found_by_their_first_bits(low):
    """Also where hashes have their first bits in common, or come twice."""
    rng = np.random.default_rng(4)
    known = np.sort(rng.integers(0, 1 << 63, 3000, np.uint64) >> np.uint64(low // 2))
    known = np.sort(np.concatenate([known, known[:10], known[-10:], [np.uint64(0), np.uint64(2**64 - 1)]]))
    tokens = rng.choice(known, 20_000)
    assert (lm._finder(known)(tokens) == np.searchsorted(known, tokens)).all()
    assert (lm._finder(known[:1])(known[:1]) == [0]).all() and not len(lm._finder(known[:0])(known[:0]))


def test_lm_odd_rows(odd, nothing):
    rows = lm.score_texts(odd).collect()
    assert sorted(r.n_tokens for r in rows) == sorted(len(words(r[1])) + 1 for r in ODD)
    assert all(math.isfinite(r.score) and r.score <= 0 for r in rows)
    assert lm.score_texts(nothing).isEmpty()


# --- 6 rules


def test_rules_of_odd_rows(odd, nothing):
    rows = rules.with_rules(odd).collect()
    assert len(rows) == len(ODD)
    assert all(r.base_failed and not r.kept for r in rows if r.n_words < 50)
    long = next(r for r in rows if r.doc_id == 5)
    assert (long.n_words, long.n_repeat_words) == (6000, 6000)
    assert rules.with_rules(nothing).isEmpty()


def test_common_lines_are_removed(spark):
    common = "Read our terms of use before you go on."
    name = lambda i, k: f"{chr(97 + i)}{chr(97 + k % 26)}{chr(97 + k // 26)}"
    prose = lambda i: " ".join(name(i, k) for k in range(60))
    rows = [(i, f"{prose(i)}\n {common.upper()} \nend {name(i, 1)}", "h") for i in range(12)] + [(99, f"{common}\n" * 9 + "word " * 9, "h")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = rules.with_rules(df, max_docs=5).withColumn("left", rules.without_lines(F.col("text"), F.col("bad_lines")))
    got = {r.doc_id: r for r in out.collect()}
    assert all(got[i].kept and got[i].left == f"{prose(i)}\nend {name(i, 1)}" for i in range(12))
    assert not got[99].kept and got[99].left == "word " * 9
    assert all(r.bad_lines is None for r in rules.with_rules(df, max_docs=50).collect())
    # 13 documents: a line of all of them passes a share of 0.9, but not one of 1
    assert sum(r.bad_lines is not None for r in rules.with_rules(df, max_docs=5, max_share=0.9).collect()) == 13
    assert all(r.bad_lines is None for r in rules.with_rules(df, max_docs=5, max_share=1.0).collect())


def test_lines_are_removed_from_the_given_documents(spark):
    rows = rules.with_rules(table(spark, MEDIUM, "documents")).filter("bad_lines IS NOT NULL")
    assert rows.count() > 10


# --- 7 near-duplicates


def bag(text):
    w = words(text)
    return collections.Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else collections.Counter()


def brute_classes(rows):
    bags, up = [bag(t) for _, t in rows], list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, j in itertools.combinations(range(len(rows)), 2):
        both = sum((bags[i] & bags[j]).values())
        if both and both >= 0.8 * (sum(bags[i].values()) + sum(bags[j].values()) - both):
            up[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            least[find(i)] = min(least.get(find(i), k), k)
    return sorted(((k, least.get(find(i), k)) for i, (k, _) in enumerate(rows)), key=str)


def varied(n=160):
    """A family of copies with more and more edits, copies of a repetitive text, and unrelated texts."""
    rng = random.Random(11)
    base = [f"b{rng.randrange(400)}" for _ in range(120)]
    out = []
    for i in range(n):
        w = list(base)
        for _ in range(rng.randrange(14)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
        out.append((i, " ".join(w)))
    out += [(1000 + i, "again and again and again " * (30 + i // 8)) for i in range(24)]
    out += [(2000 + i, " ".join(f"u{rng.randrange(10**6)}" for _ in range(rng.randrange(1, 40)))) for i in range(60)]
    return out


@pytest.mark.parametrize("elements", [neardup.ELEMENTS, 900])
def test_classes_are_those_of_all_pairs(spark, monkeypatch, elements):
    monkeypatch.setattr(neardup._family_links, "__defaults__", (elements,))
    rows = varied() + [(3, varied()[3][1]), (None, varied()[0][1]), (None, None), (5000, ""), (5001, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted(((r.doc_id, r.class_id) for r in neardup.classes(df).collect()), key=str)
    assert got == brute_classes(rows)


def test_only_probes_go_to_every_block(spark):
    key = "struct<k1:bigint,k2:bigint>"
    family = (0, 0)
    rows = [(family, (i, i), family, 300, False) for i in range(2000)] + [(family, (9999 + i, 0), (9999 + i, 0), 300, True) for i in range(3)]
    df = spark.createDataFrame(rows, f"family {key}, node {key}, root {key}, total long, probe boolean").repartition(3)
    parts = neardup._copies(df, 10_000).select("node", "part.*").collect()
    # 2003 nodes of 300 shingles make 61 blocks: each is met once, and three probes go to all of them
    assert sum(p.target for p in parts) == 2003 and sum(p.probe for p in parts) == 3 * 61
    assert len(parts) == 2003 + 3 * 60
    # with small blocks of probes each probe still meets each node once
    parts = neardup._copies(df, 300).select("node", "part.*").collect()
    probes, targets = collections.defaultdict(list), collections.defaultdict(list)
    for p in parts:
        if p.probe:
            probes[p.i, p.j].append(p.node)
        if p.target:
            targets[p.i, p.j].append(p.node)
    meetings = collections.Counter((a, b) for k in probes for a in probes[k] for b in targets[k])
    assert len(meetings) == 3 * 2003 and set(meetings.values()) == {1}


def family_table(n, links, probe):
    """One family of which two nodes share an element if they are linked."""
    bags = [[k for k, link in enumerate(links) if u in link] + [10**6 + u] for u in range(n)]
    same = np.zeros(n, np.int64)
    return pa.table(
        {
            **{c: same for c in ("f1", "f2", "i", "j", "n2", "r2")},
            "n1": np.arange(n),
            "r1": np.arange(n),
            "probe": probe,
            "target": [True] * n,
            "bag": pa.array(bags, pa.list_(pa.int64())),
        }
    )


def joined(n, links):
    up = list(range(n))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        up[max(find(a), find(b))] = min(find(a), find(b))
    return [find(x) for x in range(n)]


@pytest.mark.parametrize("at_once", [neardup._AT_ONCE, 25, 12, 1])
def test_families_of_many_chunks_keep_all_links(monkeypatch, at_once):
    monkeypatch.setattr(neardup, "_AT_ONCE", at_once)
    rng = random.Random(12)
    graphs = [(7, [(0, 4), (1, 3), (2, 5), (2, 6), (3, 5), (4, 6)], [True] * 5 + [False, True])]
    for _ in range(200):
        n = rng.randrange(6, 30)
        graphs.append((n, [tuple(rng.sample(range(n), 2)) for _ in range(n)], [rng.random() < 0.6 for _ in range(n)]))
    for n, links, probe in graphs:
        out = neardup._compared(family_table(n, links, probe), 0.01)
        got = joined(n, zip(out.column("a1").to_pylist(), out.column("b1").to_pylist(), strict=True))
        assert got == joined(n, [(a, b) for a, b in links if probe[a] or probe[b]])


def test_signatures_estimate_weighted_similarity():
    a = {k: 1 + k % 5 for k in range(40)}
    b = {k: 1 + (k * 3) % 7 for k in range(12, 52)}
    text = np.repeat([0, 1], 40)
    grams = B.mix(np.array([*a, *b], np.uint64))
    signed = neardup.signatures(text, grams, np.array([*a.values(), *b.values()]), 2, 8192)
    keys = set(a) | set(b)
    want = sum(min(a.get(k, 0), b.get(k, 0)) for k in keys) / sum(max(a.get(k, 0), b.get(k, 0)) for k in keys)
    assert (signed[0] == signed[1]).mean() == pytest.approx(want, abs=0.025)


def test_one_of_each_class_stays(spark, odd, nothing):
    rows = varied(40)
    df = spark.createDataFrame([(k, t, "en", "s", 1) for k, t in rows + rows[:3]], "doc_id long, text string, lang string, source string, n_chars long")
    kept = sorted(r.doc_id for r in neardup.keep_one(df).collect())
    assert kept == sorted({c for _, c in brute_classes(rows)})
    left = neardup.keep_one(odd)
    assert left.columns == odd.columns
    assert sorted(str(r.doc_id) for r in left.collect()) == sorted(["1", "2", "3", "4", "5", "6", "7"])
    assert neardup.keep_one(nothing).isEmpty()


def test_components(spark):
    rng = random.Random(2)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(1000, 1064)]
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in links:
        up[max(find(a), find(b))] = min(find(a), find(b))
    got = {r.node: r.root for r in neardup.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: find(x) for x in up if find(x) != x}


# --- 8 repeated strings


def brute_cuts(texts):
    raw = [(t or "").encode() for t in texts]
    seen = collections.Counter(b[i : i + 200] for b in raw for i in range(len(b) - 199))
    for b in raw:
        gone = bytearray(len(b))
        for i in range(len(b) - 199):
            if seen[b[i : i + 200]] > 1:
                gone[i : i + 200] = b"\1" * 200
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        yield len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()


@pytest.mark.parametrize("hot", [suffixes.HOT, 3])
def test_repeated_strings_against_brute_force(spark, monkeypatch, hot):
    rng = random.Random(8)
    a = "".join(rng.choice("abcd é") for _ in range(700))
    rows = [a, a[90:420] + "xyz" * 20 + a[380:640], "q" * 900, "ab" * 300, a[:150], a[150:349], None, "", a[230:500] + "Z" + a[501:]]
    rows += ["".join(rng.choice("uvw") for _ in range(250)) + a[50:280] + str(i) for i in range(9)] + [a]
    df = spark.createDataFrame([(i if i != 3 else None, t) for i, t in enumerate(rows)] + [(0, a)], "doc_id long, text string")
    monkeypatch.setattr(suffixes.repeated_spans, "__defaults__", (hot,))
    out = suffixes.with_spans(df.repartition(4)).mapInArrow(
        suffixes._digest_rows, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    )
    got = sorted((tuple(r) for r in out.collect()), key=str)
    ids = [i if i != 3 else None for i in range(len(rows))] + [0]
    assert got == sorted(((k, *cut) for k, cut in zip(ids, brute_cuts([*rows, a]))), key=str)


def test_repeats_of_the_documents(spark, texts):
    rows = QUERIES["op8_suffix_dedup"](spark, SMALL).collect()
    want = dict(zip(texts, brute_cuts(texts.values())))
    assert {r.doc_id: tuple(r)[1:] for r in rows} == want


def test_slices_do_not_change_the_anchors(monkeypatch):
    rng = np.random.default_rng(9)
    buf = rng.integers(97, 100, 6000).astype(np.uint8)
    offsets = np.array([0, 50, 2600, 2600, 6000])
    whole = set(suffixes.anchors(buf, offsets)[1].tolist())
    monkeypatch.setattr(suffixes, "SLICE", 777)
    assert set(suffixes.anchors(buf, offsets)[1].tolist()) == whole


def test_removal_of_odd_rows(odd, nothing):
    out = suffixes.remove_repeats(odd)
    assert out.columns == [c for c in odd.columns if c != "spans"]
    got = {r.doc_id: r.text for r in out.collect()}
    assert got[2] is None and got[3] == "" and got[6] == "one" and len(got[5]) < 400
    assert suffixes.remove_repeats(nothing).isEmpty()


# --- 9 toxicity


def brute_patterns(text):
    raw = (text or "").encode()
    letters = [chr(b) for b in raw if chr(b).isalpha() and b < 128]
    shouts = len(letters) > 20 and 2 * sum(c.isupper() for c in letters) > len(letters)
    return [shouts, b"!!!" in raw, bool(re.search(rb"(?<=[A-Za-z])[*@$](?=[A-Za-z])", raw))]


def test_pattern_votes_stay_within_texts(texts):
    odd_ones = ["wow!!", "!ok", "*def", "abc*", "def", "a*b", "", None, "!", "!!!", "!!", "!a!!", "x$", "$", "y", "f**k", "ÄB*é", "S*T", "SHOUTING IS NOT ALLOWED HERE"]
    rng = random.Random(2)
    given = odd_ones + [*texts.values()][:80] + ["".join(rng.choice("aB!*@$ é") for _ in range(rng.randrange(6))) for _ in range(400)]
    for size in (1, 7, len(given)):
        got = [v for k in range(0, len(given), size) for v in toxicity._patterns(*B.packed(pa.array(given[k : k + size], pa.string()))).tolist()]
        assert got == [brute_patterns(t) for t in given]


def plain_features(text):
    """Feature hashes of a text: its words and their beginnings."""
    low = re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode())
    one = lambda raw: int(B.word_hashes(np.frombuffer(raw, np.uint8), np.zeros(1, np.int64), np.array([len(raw)]))[0])
    out = set()
    for w in re.findall(rb"[0-9a-z\x80-\xff]+", low):
        out.add(one(w))
        for n in toxicity.STEMS:
            if len(w) > n:
                out.add(int(B.mix(np.array([(one(w[:n]) + n) % 2**64], np.uint64))[0]))
    return out


def test_toxicity_against_a_plain_computation(spark, texts, monkeypatch):
    seen = {}
    for name in ("_mask_rows", "_score_rows", "fit_label_model"):
        make = getattr(toxicity, name)

        def kept(*args, make=make, name=name):
            seen[name] = (args, make(*args))
            return seen[name][1]

        monkeypatch.setattr(toxicity, name, kept)
    docs, labels = table(spark, SMALL, "documents").select("doc_id", "text"), table(spark, SMALL, "labels")
    scores = {r.doc_id: r.score for r in toxicity.score_toxicity(docs, labels).collect()}
    votes = {r.doc_id: r.votes for r in docs.mapInArrow(seen["_mask_rows"][1], "doc_id long, votes long").collect()}
    mined = [int(h) for h in seen["_mask_rows"][0][0]]
    lexicon = {int(h) for h in toxicity._hash_of(toxicity.LEXICON)}
    wanted, weights, bias = seen["_score_rows"][0]
    weight = dict(zip((int(h) for h in wanted), weights.tolist(), strict=True))
    model, voters = seen["fit_label_model"][1], 4 + len(mined)
    assert len(weight) > 3
    for doc_id, text in texts.items():
        features = plain_features(text)
        fired = [bool(features & lexicon), *brute_patterns(text), *(h in features for h in mined)]
        assert votes[doc_id] == sum(1 << k for k, x in enumerate(fired) if x)
        odds = bias + sum(weight.get(h, 0.0) for h in features)
        assert scores[doc_id] == pytest.approx(1 / (1 + math.exp(-odds)), rel=1e-6)
        joint = {}
        for y, prior in ((1, model.prior), (0, 1 - model.prior)):
            joint[y] = math.log(prior)
            for j in range(voters):
                up = fired[model.parent[j]] if model.parent[j] >= 0 else False
                p = model.rate[y, int(up), j]
                joint[y] += math.log(p if fired[j] else 1 - p)
        got = model.posterior(toxicity._bits(np.array([votes[doc_id]]), voters))[0]
        assert got == pytest.approx(1 / (1 + math.exp(joint[0] - joint[1])), rel=1e-6)


def test_toxicity_on_held_out_rows(spark):
    docs, labels = table(spark, MEDIUM, "documents"), table(spark, MEDIUM, "labels")
    rows = toxicity.score_toxicity(docs, labels).collect()
    assert area(labelled(rows, labels, "toxic", 5, 0)) > 0.85


def test_label_model_recovers_accuracies(spark):
    rng = np.random.default_rng(6)
    n = 20000
    truth = rng.random(n) < 0.2
    fire = [(0.8, 0.02), (0.6, 0.05), (0.5, 0.01)]
    votes = [np.where(truth, rng.random(n) < a, rng.random(n) < b) for a, b in fire]
    votes.append(votes[0] ^ (rng.random(n) < 0.02))  # nearly a copy of the first voter
    masks = sum(v.astype(np.int64) << k for k, v in enumerate(votes))
    known = np.where(rng.random(n) < 0.05, truth, -1)
    rows = collections.Counter(zip(masks.tolist(), known.astype(int).tolist()))
    df = spark.createDataFrame([(v, y, c) for (v, y), c in rows.items()], "votes long, label int, n long")
    model = toxicity.fit_label_model(df, 4)
    assert model.prior == pytest.approx(0.2, abs=0.04)
    assert {(0, 3), (3, 0)} & {(j, int(model.parent[j])) for j in range(4)}
    q = model.posterior(toxicity._bits(masks, 4))
    assert ((q > 0.5) == truth).mean() > 0.93


# --- 10 decontamination


def brute_tiles(item, doc, seed):
    used_i, used_d, total = [False] * len(item), [False] * len(doc), 0
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for j in range(len(doc)):
                n = 0
                while i + n < len(item) and j + n < len(doc) and item[i + n] == doc[j + n] and not used_i[i + n] and not used_d[j + n]:
                    n += 1
                best = max(best, (n, -i, -j))
        n, i, j = best[0], -best[1], -best[2]
        if n < seed:
            return total
        total += n
        for k in range(n):
            used_i[i + k] = used_d[j + k] = True


def test_tiles_are_greedy():
    rng = random.Random(4)
    for _ in range(30):
        item = [rng.choice("abcd") for _ in range(30)]
        doc = [rng.choice("abcd") for _ in range(40)] + item[12:25] + item[:9]
        pairs = [(i, j) for i in range(len(item) - 2) for j in range(len(doc) - 2) if item[i : i + 3] == doc[j : j + 3]]
        code = lambda x, k: hash(tuple(x[k : k + 3]))
        sides = [(np.arange(len(x) - 2), np.array([code(x, k) for k in range(len(x) - 2)])) for x in (item, doc)]
        for at_once in (1, 7, 1 << 20):
            i, j, n = decontamination.diagonal_runs(*sides[0], *sides[1], 3, at_once)
            assert sum(n) - 2 * len(n) == len(pairs)
            assert sum(x for *_, x in decontamination.tiles(i, j, n, 3, len(item))) == brute_tiles(item, doc, 3)


def test_a_repetitive_text_against_a_repetitive_item(spark):
    # 200 by 400,000 equal words: 80 million equal places
    docs = spark.createDataFrame([(1, "again " * 400_000), (2, "now and then " * 200_000), (3, "other words")], "doc_id long, text string")
    items = spark.createDataFrame([(7, "again " * 200), (8, "now and then " * 60)], "item_id long, text string")
    got = {r.doc_id: (r.item_id, r.coverage, r.n_items) for r in decontamination.with_matches(docs, items).collect()}
    assert got == {1: (7, 1.0, 1), 2: (8, 1.0, 1), 3: (None, 0.0, 0)}


def test_short_items_match_as_a_whole(spark):
    items = spark.createDataFrame([(1, "Name four seas!"), (2, "why"), (3, "..."), (4, "one two three four five")], "item_id long, text string")
    rows = [(1, "please name four seas now"), (2, "name four lakes"), (3, "But WHY not"), (4, "whyever"), (5, "one two three four"), (6, "one two three four five")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.item_id for r in decontamination.with_matches(docs, items).collect() if r.contaminated}
    assert got == {1: 1, 3: 2, 6: 4}


def test_columns_named_like_the_keys_are_kept(spark):
    rows = [(1, "one two three four five six", "mine", 5), (2, "clean", "yours", 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _key string, key int")
    items = spark.createDataFrame([(1, "one two three four five six")], "item_id long, text string")
    assert [tuple(r) for r in decontamination.without_tests(docs, items).collect()] == [rows[1]]
    got = {r.doc_id: (r._key, r.key, r.contaminated) for r in decontamination.with_matches(docs, items).collect()}
    assert got == {1: ("mine", 5, True), 2: ("yours", 6, False)}
    for out in (suffixes.with_spans(docs), suffixes.remove_repeats(docs)):
        assert sorted(r._key for r in out.collect()) == ["mine", "yours"]


def test_leaks_are_found_in_any_order(spark):
    rng = random.Random(3)
    word = lambda: f"w{rng.randrange(10**6)}"
    items = [(k, " ".join(word() for _ in range(30))) for k in range(5)] + [(8, None), (9, "too short")]
    filler = lambda n: " ".join(word() for _ in range(n))
    w = items[1][1].split()
    turned = " ".join([*w[20:], "cut", *w[10:20], "cut", *w[:10]])
    rows = [(1, filler(50) + " " + items[0][1].upper() + "! " + filler(9)), (2, filler(5) + " " + turned), (3, filler(80))]
    rows += [(4, " ".join(items[2][1].split()[:12])), (5, None), (6, ""), (None, items[3][1]), (1, filler(4))]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("coverage", F.lit("x")).withColumn("item_id", F.lit(1))
    tests = spark.createDataFrame(items, "item_id long, text string").repartition(3)
    got = [(r.doc_id, r.item_id, r.n_items, r.contaminated) for r in decontamination.with_matches(df, tests).collect()]
    assert sorted(x for x in got if x[3] and x[0]) == [(1, 0, 1, True), (2, 1, 1, True)]
    assert (None, 3, 1, True) in got and len(got) == len(rows) and sum(x[3] for x in got) == 3
    left = decontamination.without_tests(df, tests)
    assert left.columns == df.columns and left.count() == len(rows) - 3
    assert decontamination.without_tests(df, tests.filter("false")).count() == len(rows)
    assert decontamination.with_matches(df.filter("false"), tests).isEmpty()


def test_documents_against_brute_force(spark, texts):
    token = re.compile(r"[0-9a-z\x80-\U0010ffff]+")
    split = lambda t: token.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    items = {r.item_id: split(r.text) for r in table(spark, SMALL, "benchmark").collect()}
    rows = QUERIES["op10_decontamination"](spark, SMALL).collect()
    for r in rows:
        doc = split(texts[r.doc_id])
        grams = {tuple(doc[k : k + 5]) for k in range(len(doc) - 4)}
        best = 0.0
        for item in items.values():
            if 5 * sum(tuple(item[k : k + 5]) in grams for k in range(len(item) - 4)) >= 0.5 * len(item):
                best = max(best, brute_tiles(item, doc, 5) / len(item))
        assert r.coverage == pytest.approx(best) and r.contaminated == (best >= 0.5)


# --- pipeline


def test_pipeline_stages(spark):
    import corpus_pipeline as P

    docs = table(spark, SMALL, "documents")
    assert [name for name, _ in P.STAGES] == ["language_id", "minhash_neardup", "suffix_dedup", "decontamination", "mixing"]
    given = {r.doc_id: r.text for r in docs.collect()}
    first = P.known_language(spark, docs, SMALL)
    assert first.columns == docs.columns and len({r.doc_id for r in first.collect()} & set(given)) > 0.97 * len(given)
    rows = sorted(given.items())
    kept = {r.doc_id for r in P.one_of_each(spark, docs, SMALL).collect()}
    assert kept == {c for _, c in brute_classes(rows)}
    cleaned = P.without_repeats(spark, docs, SMALL).collect()
    assert all(r.n_chars == len(r.text) for r in cleaned)
    out = P.run(spark, SMALL)
    got = out.collect()
    assert out.columns == [*docs.columns, "position"]
    assert {r.doc_id for r in got} <= kept
    assert [r.position for r in got] == sorted(r.position for r in got)


def planted():
    """Documents with copies, near copies, long repeats, benchmark items, and rows without a language."""
    rng = random.Random(21)
    word = lambda lang: lang + "".join(rng.choice("aeiou" if i % 2 else "bdklmnrst") for i in range(6))
    prose = lambda lang, n: " ".join(word(lang) for _ in range(n))
    rows, passage = [], {x: prose(x, 40) for x in "xy"}
    for i in range(120):
        lang = "xy"[i % 2]
        text = prose(lang, 60)
        if i % 10 == 3:
            text += " " + passage[lang] + " " + prose(lang, 15)
        rows.append([i, text, lang, f"s{i % 3}", 0])
    for i in range(12):
        rows.append([200 + i, rows[i * 5][1], rows[i * 5][2], "s1", 0])  # exact copies
        w = rows[i * 7][1].split()
        w[17] = "edited"
        rows.append([300 + i, " ".join(w), rows[i * 7][2], "s2", 0])  # near copies
    items = [(k, prose("xy"[k % 2], 24)) for k in range(6)]
    for i, (_, text) in enumerate(items):
        lang = "xy"[i % 2]
        rows.append([400 + i, f"{prose(lang, 30)} {text} {prose(lang, 30)}", lang, "s0", 0])
    rows += [[500, None, "x", "s0", 0], [501, "12 34 !!", "x", "s0", 0], [502, "", None, None, 0]]
    return [(a, b, c, d, len(b or "")) for a, b, c, d, _ in rows], items


def test_the_language_stage_keeps_prose_and_rejects_junk(spark):
    import corpus_pipeline as P

    docs = table(spark, MEDIUM, "documents")
    rng = random.Random(3)
    pick = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    junk = [(10**6 + i, pick("0123456789abcdef", 900)) for i in range(150)]
    junk += [(2 * 10**6 + i, " ".join(pick("бвгдежзиклмнопрст", 6) for _ in range(120))) for i in range(150)]
    more = spark.createDataFrame([(i, t, None, "junk", len(t)) for i, t in junk], docs.schema)
    both = docs.unionByName(more)
    kept = {r.doc_id for r in P.known_language(spark, both, MEDIUM).select("doc_id").collect()}
    given = {r.doc_id for r in docs.select("doc_id").collect()}
    assert len(kept & given) > 0.99 * len(given)
    # some junk goes; the network is sure of most of it
    assert len(kept - given) < 0.97 * len(junk)


def test_run_against_brute_force(spark, duck, tmp_path):
    import corpus_pipeline as P

    rows, items = planted()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    # languages: all texts with a letter are recognised here
    left = [r for r in rows if r[1] and re.search("[a-z]", r[1])]
    assert len(left) == len(rows) - 3
    ones = {k for k, c in brute_classes([(r[0], r[1]) for r in left]) if k == c}
    left = [r for r in left if r[0] in ones]
    assert not ones & set(range(200, 400))
    cleaned, raw = [], [r[1].encode() for r in left]
    seen = collections.Counter(b[i : i + 200] for b in raw for i in range(len(b) - 199))
    for r, b in zip(left, raw, strict=True):
        gone = {i + k for i in range(len(b) - 199) if seen[b[i : i + 200]] > 1 for k in range(200)}
        cleaned.append((r[0], bytes(x for i, x in enumerate(b) if i not in gone).decode(), *r[2:4]))
    assert sum(a[1] != b[1] for a, b in zip(left, cleaned, strict=True)) > 8
    split = lambda t: re.findall("[0-9a-z]+", t)
    leaks = {r[0] for r in cleaned if any(2 * brute_tiles(split(t), split(r[1]), 5) >= len(split(t)) for _, t in items)}
    assert leaks == set(range(400, 406))
    final = [(*r, len(r[1])) for r in cleaned if r[0] not in leaks]
    # the mix by the SQL of its own query
    con = duck.cursor()
    con.execute("CREATE TEMP TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", final)
    names = [c[0] for c in con.execute(SQL["op1_mixing"]).description]
    taken = {x["doc_id"]: x["taken"] // x["size"] for x in (dict(zip(names, r, strict=True)) for r in con.fetchall())}
    want = sorted(r for r in final for _ in range(taken[r[0]]))
    got = [tuple(r) for r in P.run(spark, str(tmp_path)).collect()]
    assert sorted(r[:-1] for r in got) == want and len(want) > 100
    assert [r[-1] for r in got] == sorted(r[-1] for r in got)


def test_pipeline_of_odd_rows(spark, odd, nothing):
    import corpus_pipeline as P

    for given in (odd.select("doc_id", "text", "lang", "source", "n_chars"), nothing.select("doc_id", "text", "lang", "source", "n_chars")):
        docs = given
        for _, stage in P.STAGES[:-1]:
            docs = stage(spark, docs, SMALL)
            assert docs.columns == given.columns
        P.STAGES[-1][1](spark, docs, SMALL).count()
