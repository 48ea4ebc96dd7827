"""Packing, prefix tries and collocations against brute force."""

from __future__ import annotations

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from ledgerloom.llm import collocations, packing, tries
from ledgerloom.llm.common import table

# ---- packing


@pytest.fixture(scope="module")
def model():
    return packing.tokenizer_file()


@pytest.fixture(scope="module")
def whole_text(model):
    from tokenizers import Tokenizer

    known = Tokenizer.from_str(model.decode())
    return lambda text: [*known.encode(text or "", add_special_tokens=False).ids, packing.CLOSE]


HARD = [
    "",
    None,
    " \n\t ",
    "a<|endoftext|>b  <|startoftext|> c",
    "word, word.word;WORD 's it's don't 'can",
    "é ́x ͅ Σας ΌΣΟΣ 漢字 a≠b a̸.b",
    "a\x1cb\x85c　d\xa0e",
    "x" * 5000 + "," + "y" * 3000,
    "1,234.5:6;7!?8 <|endoftext| >",
    "a''s *'s '*s 's't a'b'c ''''ll 'LL I'VE",
    "<|ENDOFTEXT|> <|endoftext|>Abc<|startoftext|>9<|endoftext|> |a|b| x|Y <|end oftext|>",
    "839756d1d951***abc%%%def&&&é***é12é  ½²a１２",
    "=\u0338a\u0301 <\u0338>\u0338b 3\u0301 *\u0301x 'é é's",
]


def test_parts_give_the_ids_of_whole_texts(model, whole_text, spark):
    texts = HARD + [r[0] for r in table(spark, SMALL, "documents").select("text").limit(60).collect()]
    ids, first = packing._Encoder(model)(pa.array(texts, pa.string()))
    for text, a, b in zip(texts, first[:-1], first[1:], strict=True):
        assert ids[a:b].tolist() == whole_text(text)


def test_remembered_parts_are_forgotten(model, whole_text, monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 3)
    encode = packing._Encoder(model)
    for text in ("one two three", "four five one two", "one two three", "", "|a| <|endoftext|> four"):
        assert encode(pa.array([text]))[0].tolist() == whole_text(text)


def test_a_tokenizer_with_other_words(model):
    import public_tokenizers
    from tokenizers import Tokenizer

    encode = packing._Encoder(packing.tokenizer_file("byte_bpe_50k.json"))
    known = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert not encode.by_parts and packing._Encoder(model).by_parts
    ids, first = encode(pa.array(["two  words", None, "one"]))
    whole = [[*known.encode(t, add_special_tokens=False).ids, packing.CLOSE] for t in ("two  words", "", "one")]
    assert [ids[a:b].tolist() for a, b in zip(first[:-1], first[1:], strict=True)] == whole


def test_documents_are_packed_whole(spark, whole_text):
    docs = table(spark, SMALL, "documents").select("doc_id", "text")
    rows = packing.op11_packing(spark, SMALL).collect()
    texts = {r.doc_id: whole_text(r.text) for r in docs.collect()}
    by_doc = collections.defaultdict(list)
    by_sequence = collections.defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    assert by_doc.keys() == texts.keys()
    for doc, pieces in by_doc.items():
        pieces.sort(key=lambda r: r.piece)
        at = 0
        for i, r in enumerate(pieces):
            part = np.array(texts[doc][at : at + packing.SEQUENCE], "<u4")
            assert (r.piece, r.start, r.length, r.ids_crc32) == (i, at, len(part), zlib.crc32(part.tobytes()))
            at += len(part)
        assert at == len(texts[doc])
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= packing.SEQUENCE
    # with many short documents the least possible number is reached
    assert len(by_sequence) == -(-sum(map(len, texts.values())) // packing.SEQUENCE)


def test_sequences_hold_their_documents(spark, model, whole_text):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(HARD)], "doc_id long, text string")
    rows = packing.sequences(docs, model, 64).collect()
    found = collections.defaultdict(dict)
    for r in rows:
        assert len(r.ids) <= 64
        for p in r.pieces:
            found[p.doc_id][p.piece] = r.ids[p.offset : p.offset + p.length]
    for i, text in enumerate(HARD):
        assert [x for _, part in sorted(found[i].items()) for x in part] == whole_text(text)


def _triples(n, seed=0):
    """Pieces of which three fill a bin exactly."""
    rng, out = np.random.default_rng(seed), []
    for _ in range(n):
        a, b = (int(x) for x in rng.integers(800, 1800, 2))
        out += [a, b, packing.SEQUENCE - a - b]
    return out


def test_evolution_beats_best_fit():
    lengths = np.array(sorted(_triples(100), reverse=True))
    rng = np.random.default_rng(1)
    first = packing.seeded(lengths, packing.SEQUENCE, rng, 0.0)
    people = [first] + [packing.seeded(lengths, packing.SEQUENCE, rng, 0.1 * i) for i in range(1, 4)]
    best = packing.evolve(lengths, people, packing.SEQUENCE, rng, 100, 300)[0]
    assert np.bincount(best, lengths).max() <= packing.SEQUENCE
    assert 100 <= best.max() + 1 < first.max() + 1


def test_a_child_holds_every_piece_once():
    rng = np.random.default_rng(2)
    lengths = np.sort(rng.integers(1, 900, 400))[::-1].copy()
    a, b = (packing.seeded(lengths, 1000, rng, noise) for noise in (0.0, 0.5))
    for _ in range(20):
        child = packing.cross(lengths, a, b, 1000, rng)
        assert len(child) == 400 and child.min() == 0 and len(np.unique(child)) == child.max() + 1
        assert np.bincount(child, lengths).max() <= 1000
        a, b = b, child


def test_groups_merge_their_loose_bins(spark):
    lengths = np.random.default_rng(3).integers(1, 60, 3000).tolist() + [64] * 5
    rows = spark.createDataFrame(list(enumerate(lengths)), "id long, length long").repartition(4)
    bins = packing.packed_bins(rows, 64, group=200, fan=4).collect()
    assert sorted(r.id for r in bins) == list(range(len(lengths)))
    fill = collections.Counter()
    for r in bins:
        fill[r.sequence_id] += r.length
    least = -(-sum(lengths) // 64)
    assert max(fill.values()) <= 64 and least <= len(fill) <= least * 1.02


def test_packing_of_odd_rows(spark, model):
    empty = spark.createDataFrame([], "doc_id long, text string, offset int, piece string, _id int")
    assert packing.placed(packing.tokenised(empty, model)).collect() == []
    rows = [(None, None, 1, "x", 1), (None, None, 1, "x", 1), (1, "", 2, "y", 2), (1, "a b " * 30000, 3, "z", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, offset int, piece string, _id int")
    found = packing.placed(packing.tokenised(docs, model, keep_ids=False)).collect()
    assert sum(r.length for r in found if r.doc_id == 1) == 60002
    assert [r.length for r in found if r.doc_id is None] == [1, 1]


def test_a_text_beyond_one_batch(spark, model):
    docs = spark.createDataFrame([(7, "alpha beta. " * 250_000)], "doc_id long, text string")
    found = packing.placed(packing.tokenised(docs, model, keep_ids=False)).agg(F.sum("length"), F.count("piece")).first()
    assert tuple(found) == (750_001, -(-750_001 // packing.SEQUENCE))


# ---- prefix tries


def trie(rows):
    """Nodes by brute force."""
    own = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [(role, text) for _, role, text in sorted(v)] for c, v in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        built[c] = own.get(base, [])[:h] + turns[h:]
    members = collections.defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = collections.defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    leaves, saved, out = {}, {}, []
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in children[p]) if children[p] else 1
        saved[p] = sum(saved[k] for k in children[p])
        saved[p] += (len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0
        ends = ",".join(str(c) for c in sorted(members[p]) if len(built[c]) == len(p))
        parent = min(members[p[:-1]]) if p else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(members[p]), len(p), parent, len(members[p]), len(children[p]), leaves[p], saved[p], digest))
    return sorted(out, key=lambda r: r[:2])


def nodes_of(frame):
    return sorted((tuple(r) for r in frame.collect()), key=lambda r: r[:2])


TURNS = "conv_id long, turn int, role string, text string"


@pytest.fixture(scope="module")
def talks():
    rng, rows = random.Random(1), []
    for c in range(-7, 60):
        for t in range(rng.choice([1, 2, 5, 9, 12])):
            turn = t if rng.random() < 0.9 else None
            rows.append((c, turn, rng.choice(["user", "assistant", None]), rng.choice(["a", "bé", "", None, "x y"])))
    # conversations that end where a stretch ends, beside longer ones; repeated rows; no conv_id
    for c, n in ((100, 4), (105, 9), (111, 9), (103, 8), (121, 8), (112, 4), (122, 4)):
        rows += [(c, t, "user", "x") for t in range(n)]
    return [*rows, rows[0], (None, 1, "user", "lost")]


@pytest.mark.parametrize("block", [64, 4, 1])
@pytest.mark.parametrize("held", [2000, 3])
def test_nodes_against_brute_force(spark, monkeypatch, talks, block, held):
    monkeypatch.setattr(tries, "BLOCK", block)
    frame = spark.createDataFrame(talks, TURNS).repartition(5)
    assert nodes_of(tries.prefix_trie(frame, held)) == trie(talks)


def test_trie_as_if_the_input_were_large(spark, large, talks):
    frame = spark.createDataFrame(talks, TURNS).repartition(5)
    assert nodes_of(tries.prefix_trie(frame, 10)) == trie(talks)


def test_trie_of_the_conversations(spark):
    rows = [tuple(r) for r in table(spark, SMALL, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert nodes_of(tries.op12_prefix_trie(spark, SMALL)) == trie(rows)


def test_many_copies_and_one_long_conversation(spark, monkeypatch):
    monkeypatch.setattr(tries, "ENDS", 7)
    rows = [(c, t, "user", f"turn {t}") for c in range(0, 300, 5) for t in range(3)]
    rows += [(1001, t, "user", "m" * (t % 5)) for t in range(700)]
    rows += [(2001, 0, "user", "long " * 500_000)]
    frame = spark.createDataFrame(rows, TURNS).repartition(3)
    assert nodes_of(tries.prefix_trie(frame)) == trie(rows)


def test_trie_of_no_rows(spark):
    frame = spark.createDataFrame([], TURNS + ", depth int, key string")
    assert tries.prefix_trie(frame).collect() == []


# ---- collocations


def phrases(rows, least, top):
    """Collocations by brute force."""
    low = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
    counts, sizes = collections.defaultdict(collections.Counter), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(low)):
            words = re.findall(r"[^\x20\x09]+", piece)
            sizes[lang] += len(words)
            for m in range(1, 6):
                for i in range(len(words) - m + 1):
                    counts[lang][tuple(words[i : i + m])] += 1
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        hidden = set()
        for longer, b in candidates.items():
            for m in range(2, len(longer)):
                for i in range(len(longer) - m + 1):
                    part = longer[i : i + m]
                    if 100 * b >= 100 * f[part]:
                        hidden.add(part)
        scored = []
        for p, a in candidates.items():
            if p in hidden:
                continue
            score, k = min((1000 * a * sizes[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, text, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, text.decode(), -a, left, right, sizes[lang], -score))
    return sorted(out)


def found_of(frame):
    return sorted(tuple(r) for r in frame.collect())


PAIRS = "lang string, text string"


@pytest.fixture(scope="module")
def said():
    rng, rows = random.Random(5), []
    words = ["Alpha", "beta", "gamma", "délta", "of", "the", "x"]
    for _ in range(700):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t", ". ", ",", "\n"]) for _ in range(rng.randint(0, 30)))
        if rng.random() < 0.4:
            text += " New York City Hall of Fame again"
        rows.append((rng.choice(["en", "en", "fr", None, "und"]), text))
    return [*rows, ("en", None), ("de", ""), ("xx", "...")]


@pytest.mark.parametrize(("least", "top", "first", "bits"), [(3, 30, 2, 1 << 25), (3, 5, 1, 1 << 15), (2, 2000, 50, 1 << 15)])
def test_phrases_against_brute_force(spark, said, least, top, first, bits):
    frame = spark.createDataFrame(said, PAIRS).repartition(4)
    found = collocations.mine(frame, top=top, least=least, first=first, bits=bits)
    assert found_of(found) == phrases(said, least, top)


def test_phrases_with_full_bitmaps(spark, said, monkeypatch):
    # every word and phrase seems frequent and in the frontier: exact counts alone decide
    monkeypatch.setattr(collocations, "_has", lambda bitmap, hashes: np.ones(len(hashes), bool))
    found = collocations.mine(spark.createDataFrame(said, PAIRS).repartition(2), top=20, least=3, first=2)
    assert found_of(found) == phrases(said, 3, 20)


def test_phrases_of_the_documents(spark):
    docs = table(spark, SMALL, "documents")
    rows = [tuple(r) for r in docs.select("lang", "text").collect()]
    assert found_of(collocations.mine(docs, top=40, least=4, first=2)) == phrases(rows, 4, 40)


def test_phrases_at_production_parameters(spark):
    docs = table(spark, SMALL, "documents")
    rows = [tuple(r) for r in docs.select("lang", "text").collect()]
    assert found_of(collocations.op13_collocations(spark, SMALL)) == phrases(rows, 100, 2000)


def test_ties_at_the_last_rank(spark):
    # ten phrases of equal score and frequency for five ranks
    rows = [("en", f"a{i} b{i}. filler") for i in range(10) for _ in range(4)]
    found = collocations.mine(spark.createDataFrame(rows, PAIRS).repartition(3), top=5, least=4, first=1)
    assert found_of(found) == phrases(rows, 4, 5)


def test_scores_are_exact_beyond_64_bits(spark):
    big = 3_000_000_007
    counts = spark.createDataFrame([(1, big), (2, big + 2)], "h long, f long")
    words = spark.createDataFrame([(1, "en", big, "a"), (2, "en", big + 2, "b")], "h long, lang string, f long, word string")
    both = collocations._joined(np.array([1], np.uint64), np.array([2], np.uint64)).view(np.int64)[0]
    scored = spark.createDataFrame([(int(both), big, [1, 2])], "h long, f long, words array<long>")
    n = 9_999_999_999_999
    totals = spark.createDataFrame([("en", n)], "lang string, n long")
    row = collocations._scores(counts, scored, words, totals, 1000).first()
    assert row.score == 1000 * big * n // (big * (big + 2))


def test_phrases_of_odd_rows(spark):
    assert collocations.mine(spark.createDataFrame([], PAIRS + ", h long, rank int")).collect() == []
    rows = [(None, "one two. " * 200_000, 1, 1), ("en", None, 2, 2)]
    frame = spark.createDataFrame(rows, PAIRS + ", h long, rank int")
    found = collocations.mine(frame, least=100).collect()
    assert [tuple(r) for r in found] == [("und", 1, "one two", 200_000, 200_000, 200_000, 400_000, 2000)]
