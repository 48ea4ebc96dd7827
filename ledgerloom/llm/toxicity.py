"""Toxicity by weak supervision: many voters, a generative label model, a linear classifier on its posterior labels.

Voters fire on a text or not: a fixed lexicon, patterns (shouting, rows of exclamation marks, words masked by symbols), and words or
word beginnings mined from a bounded sample of labelled documents, chosen greedily for the toxic texts that no earlier voter
covers. The label model gives each voter its accuracy, its rate in toxic and in other texts, and each dependent pair its
correlation: a tree of the voter pairs of largest conditional mutual information (Chow-Liu), so that two voters for one thing do not
count twice. It is fitted by expectation maximisation over all documents, by sums over distinct vote patterns; labels of
rows that are not held out stay fixed. Texts drawn by posterior label, or by their own if given (a bounded sample), then train a sparse logistic
regression on hashed words and word beginnings, which scores every whole text.

Nulls: a null text is an empty one and gets the score of a text without features; null labels are ignored; rows with a
null doc_id are scored and not learned from. Without toxic and other labels all scores are 0. Equal texts get equal scores. Tied
features go by hash. Empty tables give empty results. Of the documents only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.bytesops import PUNCTUATION, mix, packed, word_hashes, word_spans
from ledgerloom.llm.common import arrow_sized, crc_mod, drawn, query, table
from ledgerloom.session import materialize

FOLDS, HELD_OUT = 5, 0
#: Labelled documents per label, and documents per posterior label, that training reads at most.
PER_LABEL, PER_POSTERIOR = 1500, 2000
#: Mined candidates and voters, and features of the classifier, at most.
CANDIDATES, VOTERS, FEATURES = 400, 40, 2048
ROUNDS = 6
#: Lengths of word beginnings in bytes.
STEMS = (4, 5, 6, 7)

# fixed values: general insults of English
LEXICON = (
    "idiot idiots moron morons stupid dumb loser losers scum trash garbage pathetic worthless disgusting clown imbecile "
    "coward cretin filth freak jerk liar pig rat shut sucker ugly vermin wretch"
).split()


def _word_features(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(feature hash, text index) of all words, A-Z folded, and of their beginnings."""
    starts, ends, first = word_spans(buf, offsets, PUNCTUATION)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    found, owner = [word_hashes(buf, starts, ends, lower=True)], [text]
    for n in STEMS:
        long = ends - starts > n
        found.append(mix(word_hashes(buf, starts[long], starts[long] + n, lower=True) + np.uint64(n)))
        owner.append(text[long])
    return np.concatenate(found), np.concatenate(owner)


def _hash_of(words: list[str]) -> np.ndarray:
    buf, offsets = packed(pa.array(words))
    return word_hashes(buf, offsets[:-1], offsets[1:], lower=True)


class _Finder:
    """Places of wanted hashes: a bit table drops most others before the exact search."""

    def __init__(self, wanted: np.ndarray):
        self.order = np.argsort(wanted)
        self.sorted = wanted[self.order]
        self.table = np.zeros(1 << 16, bool)
        self.table[(wanted & np.uint64(0xFFFF)).astype(np.int64)] = True

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index into hashes, index of the wanted hash) of all hits."""
        at = np.flatnonzero(self.table[(hashes & np.uint64(0xFFFF)).astype(np.int64)])
        place = np.minimum(np.searchsorted(self.sorted, hashes[at]), len(self.sorted) - 1)
        same = self.sorted[place] == hashes[at]
        return at[same], self.order[place[same]]


def _patterns(buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Three pattern votes per text: shouting, rows of exclamation marks, letters masked by symbols."""
    n = len(offsets) - 1
    out = np.zeros((n, 3), bool)
    if not len(buf):
        return out
    text = np.repeat(np.arange(n), np.diff(offsets))
    count = lambda flags: np.bincount(text[flags], minlength=n)
    upper, lower = (buf >= 65) & (buf <= 90), (buf >= 97) & (buf <= 122)
    letters = count(upper | lower)
    out[:, 0] = (letters > 20) & (count(upper) * 2 > letters)
    # three bytes in a row, all of one text
    one = text[2:] == text[:-2]
    marks, symbol, letter = buf == 33, (buf == 42) | (buf == 64) | (buf == 36), upper | lower
    out[text[2:][one & marks[2:] & marks[1:-1] & marks[:-2]], 1] = True
    out[text[2:][one & letter[2:] & symbol[1:-1] & letter[:-2]], 2] = True
    return out


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(feature, texts of label 1, texts of label 0) of a batch, each feature once per text."""
    for batch in batches:
        buf, offsets = packed(batch.column("text"))
        label = batch.column("label").to_numpy()
        hashes, text = _word_features(buf, offsets)
        order = np.lexsort((text, hashes))
        hashes, text = hashes[order], text[order]
        new = np.ones(len(hashes), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
        hashes, text = hashes[new], text[new]
        found, at = np.unique(hashes, return_inverse=True)
        one = np.bincount(at, label[text], len(found)).astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(found.view(np.int64)), pa.array(one), pa.array(np.bincount(at, minlength=len(found)) - one)],
            names=["feature", "n1", "n0"],
        )


def _present_rows(wanted: np.ndarray):
    """(label, indexes of the wanted features that a text has)"""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = _Finder(wanted)
        for batch in batches:
            hashes, text = _word_features(*packed(batch.column("text")))
            at, which = finder.find(hashes)
            pairs = np.unique(text[at] * np.int64(len(wanted)) + which)
            ends = np.searchsorted(pairs, np.arange(len(batch) + 1) * len(wanted)).astype(np.int32)
            present = pa.ListArray.from_arrays(pa.array(ends), pa.array((pairs % len(wanted)).astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column("label"), present], names=["label", "present"])

    return run


def _mask_rows(mined: np.ndarray):
    """(doc_id, votes): bit 0 the lexicon, bits 1 to 3 the patterns, the others mined voters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = _Finder(np.concatenate([_hash_of(LEXICON), mined]))
        for batch in batches:
            buf, offsets = packed(batch.column("text"))
            hashes, text = _word_features(buf, offsets)
            at, which = finder.find(hashes)
            bit = np.maximum(which - len(LEXICON) + 4, 0)
            bit[which < len(LEXICON)] = 0
            votes = np.zeros(len(batch), np.int64)
            np.bitwise_or.at(votes, text[at], np.int64(1) << bit)
            votes |= _patterns(buf, offsets) @ np.array([2, 4, 8])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(votes)], names=["doc_id", "votes"])

    return run


def top_features(sample: DataFrame, n1: int, n0: int, limit: int, toxic_only: bool) -> np.ndarray:
    """The hashes of the features whose rates in the two kinds of texts differ most."""
    counts = sample.mapInArrow(_feature_rows, "feature long, n1 long, n0 long").groupBy("feature")
    counts = counts.agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0")).filter(F.col("n1") + F.col("n0") >= 3)
    toxic, other = F.col("n1") / max(n1, 1), F.col("n0") / max(n0, 1)
    # a voter's word is at least ten times as frequent in toxic texts
    order = F.when(toxic >= 10 * other, toxic) if toxic_only else F.abs(toxic - other)
    rows = counts.select("feature", order.alias("gain")).filter("gain > 0").orderBy(F.desc("gain"), "feature").limit(limit)
    return np.array([r.feature for r in rows.collect()], np.int64).view(np.uint64)


def matrix(sample: DataFrame, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which wanted features each text of a bounded sample has (texts, features), and the labels."""
    found = sample.mapInArrow(_present_rows(wanted), "label int, present array<int>").toArrow()
    present = found.column("present").combine_chunks()
    if isinstance(present, pa.ChunkedArray):
        present = present.chunk(0)
    x = np.zeros((len(present), len(wanted)), np.float32)
    rows = np.repeat(np.arange(len(present)), np.diff(present.offsets.to_numpy()))
    x[rows, present.flatten().to_numpy()] = 1
    return x, found.column("label").to_numpy()


def mined_voters(x: np.ndarray, label: np.ndarray, limit: int) -> list[int]:
    """Columns that, one after the other, fire on most toxic texts not covered twice, and hardly on others."""
    toxic = x[label == 1] > 0
    noise = x[label == 0].mean(axis=0) if (label == 0).any() else np.zeros(x.shape[1])
    need = np.full(len(toxic), 2.0)
    chosen: list[int] = []
    for _ in range(min(limit, x.shape[1])):
        gain = need @ toxic / max(len(toxic), 1) - 4 * noise
        gain[chosen] = -1
        best = int(gain.argmax())
        if gain[best] <= 0.002:
            break
        chosen.append(best)
        need = np.maximum(need - toxic[:, best], 0)
    return chosen


class LabelModel:
    """P(votes | label) as a tree over the voters, with the label's prior."""

    def __init__(self, voters: int):
        self.voters = voters
        self.parent = np.full(voters, -1)
        self.prior = 0.1
        #: P(vote j | parent's vote, label) as (label, parent's vote, j)
        self.rate = np.full((2, 2, voters), 0.5)

    def fit(self, sums: np.ndarray) -> None:
        """Maximisation from sums (label, voters + 1, voters + 1) of co-firing weights; the last row counts all."""
        v = self.voters
        n = sums[:, v, v]
        self.prior = float(np.clip((n[1] + 1) / (n.sum() + 2), 1e-4, 0.9999))
        gain = np.zeros((v, v))
        both = sums[:, :v, :v] + 0.25
        single = np.einsum("yjj->yj", sums[:, :v, :v])
        for y in (0, 1):
            size, p = n[y] + 1, (single[y] + 0.5) / (n[y] + 1)
            for a in (0, 1):
                for b in (0, 1):
                    cell = both[y] if a and b else None
                    if a and not b:
                        cell = single[y][:, None] - sums[y, :v, :v] + 0.25
                    elif b and not a:
                        cell = single[y][None, :] - sums[y, :v, :v] + 0.25
                    elif not a:
                        cell = n[y] - single[y][:, None] - single[y][None, :] + sums[y, :v, :v] + 0.25
                    q = cell / size
                    pa_, pb = (p if a else 1 - p)[:, None], (p if b else 1 - p)[None, :]
                    gain += size / n.sum() * q * np.log(np.maximum(q, 1e-12) / (pa_ * pb))
        self._tree(gain)
        for y in (0, 1):
            alone = (single[y] + 0.5) / (n[y] + 1)
            for j, up in enumerate(self.parent):
                if up < 0:
                    self.rate[y, :, j] = alone[j]
                    continue
                # shrink towards the voter's own rate where the pair is rare
                for a in (0, 1):
                    fire = sums[y, up, j] if a else single[y, j] - sums[y, up, j]
                    times = single[y, up] if a else n[y] - single[y, up]
                    self.rate[y, a, j] = (fire + 5 * alone[j]) / (times + 5)
        self.rate = np.clip(self.rate, 1e-6, 1 - 1e-6)

    def _tree(self, gain: np.ndarray) -> None:
        """Maximum spanning tree by Prim; only clear dependencies become edges."""
        gain = gain - np.diag(np.diag(gain))
        self.parent[:] = -1
        best, link = gain[0].copy(), np.zeros(self.voters, int)
        inside = np.zeros(self.voters, bool)
        inside[0] = True
        for _ in range(self.voters - 1):
            j = int(np.where(inside, -np.inf, best).argmax())
            inside[j] = True
            self.parent[j] = link[j] if best[j] > 1e-3 else -1
            closer = (gain[j] > best) & ~inside
            best[closer], link[closer] = gain[j][closer], j

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """P(label 1) of vote patterns (n, voters)."""
        up = np.where(self.parent >= 0, votes[:, np.maximum(self.parent, 0)], 0)
        odds = np.full(len(votes), np.log(self.prior / (1 - self.prior)))
        every = np.arange(self.voters)
        for y, sign in ((1, 1), (0, -1)):
            p = self.rate[y][up, every]
            odds += sign * np.log(np.where(votes > 0, p, 1 - p)).sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(odds, -50, 50)))


def _bits(votes: np.ndarray, voters: int) -> np.ndarray:
    return (votes[:, None] >> np.arange(voters)) & 1


def _expected_rows(model: LabelModel | None, voters: int):
    """Expectation: one row of sums (label, voters + 1, voters + 1) per task; without a model labelled rows only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, voters + 1, voters + 1))
        for batch in batches:
            votes, n = batch.column("votes").to_numpy(), batch.column("n").to_numpy().astype(float)
            label = batch.column("label").to_numpy(zero_copy_only=False)
            x = np.concatenate([_bits(votes, voters), np.ones((len(votes), 1), np.int64)], axis=1).astype(float)
            known = label >= 0
            q = np.where(known, label, model.posterior(x[:, :-1].astype(np.int64)) if model is not None else 0.0)
            weight = n if model is not None else n * known
            for y, share in ((1, q), (0, 1 - q)):
                sums[y] += x.T @ (x * (weight * share)[:, None])
        yield pa.RecordBatch.from_arrays([pa.array([0]), pa.array([sums.tobytes()])], names=["one", "sums"])

    return run


def _total_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = 0.0
    for batch in batches:
        for sums in batch.column("sums").to_pylist():
            total = total + np.frombuffer(sums, np.float64)
    if isinstance(total, np.ndarray):
        yield pa.RecordBatch.from_arrays([pa.array([0]), pa.array([total.tobytes()])], names=["one", "sums"])


def fit_label_model(patterns: DataFrame, voters: int, rounds: int = ROUNDS) -> LabelModel:
    """Expectation maximisation over (votes, label or -1, n)."""
    kind = "one long, sums binary"

    def sums(model: LabelModel | None) -> np.ndarray:
        per_task = patterns.mapInArrow(_expected_rows(model, voters), kind)
        # a small number of rows: one matrix of fixed size per task, summed in two steps
        rows = per_task.repartition(8).mapInArrow(_total_rows, kind).collect()
        return np.sum([np.frombuffer(r.sums, np.float64) for r in rows], axis=0).reshape(2, voters + 1, voters + 1)

    model = LabelModel(voters)
    model.fit(sums(None))
    for _ in range(rounds):
        model.fit(sums(model))
    return model


def sparse_logistic(x: np.ndarray, y: np.ndarray, l1: float = 3e-4, steps: int = 400) -> tuple[np.ndarray, float]:
    """Logistic regression with an L1 penalty, by accelerated proximal gradient steps."""
    n = len(y)
    step = 4.0 / (np.square(x).sum(axis=1).max() + 1)
    step = max(step, 0.05)
    w, b = np.zeros(x.shape[1], np.float32), 0.0
    old_w, old_b = w, b
    for k in range(steps):
        push = k / (k + 3)
        v, c = w + push * (w - old_w), b + push * (b - old_b)
        p = 1 / (1 + np.exp(-np.clip(x @ v + c, -30, 30)))
        g = ((p - y) / n).astype(np.float32)
        old_w, old_b = w, b
        w = v - step * (x.T @ g)
        w = np.sign(w) * np.maximum(np.abs(w) - step * l1, 0)
        b = c - step * float(g.sum())
    return w.astype(np.float64), float(b)


def _score_rows(wanted: np.ndarray, weights: np.ndarray, bias: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = _Finder(wanted) if len(wanted) else None
        for batch in batches:
            n = len(batch)
            odds = np.full(n, bias)
            if finder is not None:
                hashes, text = _word_features(*packed(batch.column("text")))
                at, which = finder.find(hashes)
                pairs = np.unique(text[at] * np.int64(len(wanted)) + which)
                odds += np.bincount(pairs // len(wanted), weights[pairs % len(wanted)], n)
            score = 1 / (1 + np.exp(-np.clip(odds, -50, 50)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score)], names=["doc_id", "score"])

    return run


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, score) of every row of ``docs``."""
    arrow_sized(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    scored = "doc_id long, score double"
    open_ = F.coalesce(crc_mod("doc_id", FOLDS) != HELD_OUT, F.lit(False))
    marked = labels.filter(F.col("toxic").isin(0, 1) & open_)
    marked = marked.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("label"))

    def sampled(rows: DataFrame, limit: int, label: str) -> tuple[DataFrame, dict[int, int]]:
        # at most 2 * limit rows: safe to broadcast
        ids = F.broadcast(drawn(rows.select("doc_id", "label"), "label", limit))
        found = materialize(texts.join(ids, "doc_id").dropDuplicates(["doc_id", "label", "text"]), label)
        return found, {r.label: r["count"] for r in found.groupBy("label").count().collect()}

    none = texts.select("doc_id", F.lit(0.0).alias("score"))
    sample, n = sampled(marked, PER_LABEL, "labelled")
    if len(n) < 2:
        return none
    candidates = top_features(sample, n[1], n[0], CANDIDATES, True)
    # words of the lexicon have their voter
    candidates = candidates[~np.isin(candidates, _hash_of(LEXICON))]
    mined = np.empty(0, np.uint64)
    if len(candidates):
        x, y = matrix(sample, candidates)
        mined = candidates[mined_voters(x, y, VOTERS)]
    voters = 4 + len(mined)
    votes = materialize(texts.mapInArrow(_mask_rows(mined), "doc_id long, votes long"), "votes")
    known = marked.withColumnRenamed("doc_id", "_id")
    known = votes.join(known, votes["doc_id"] == known["_id"], "left").withColumn("label", F.coalesce("label", F.lit(-1)))
    patterns = materialize(known.groupBy("votes", "label").agg(F.count(F.lit(1)).alias("n")), "patterns")
    model = fit_label_model(patterns, voters)

    def posterior(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q = model.posterior(_bits(batch.column("votes").to_numpy(), voters))
            given = batch.column("label").to_numpy()
            label = np.where(given >= 0, given, q >= 0.5).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(label)], names=["doc_id", "label"])

    judged = known.select("doc_id", "votes", "label").filter(F.col("doc_id").isNotNull() & open_)
    judged = judged.mapInArrow(posterior, "doc_id long, label int").distinct()
    sample, n = sampled(judged, PER_POSTERIOR, "judged")
    if len(n) < 2:
        return none
    wanted = top_features(sample, n[1], n[0], FEATURES, False)
    x, y = matrix(sample, wanted)
    weights, bias = sparse_logistic(x, y)
    use = weights != 0
    return texts.mapInArrow(_score_rows(wanted[use], weights[use], bias), scored)


@query("op9_toxicity")
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = score_toxicity(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    held = F.coalesce(crc_mod("doc_id", FOLDS) == HELD_OUT, F.lit(False))
    return rows.select("doc_id", held.alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
