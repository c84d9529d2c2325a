"""Language-model scores: the base against a plain count, the mixing against one bit at a time, held-out texts, odd rows."""

import math
import random
import re
import zlib
from collections import Counter
from itertools import product

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from feedloom.llm import scoring

SCHEMA = "doc_id long, text string, score string, _row string, _id int"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    parts = ["an", "ti", "on", "er", "é", "日", "xo"]
    vocabulary = ["".join(rng.choices(parts, k=rng.randint(1, 5))) for _ in range(300)]
    weights = [1 / (i + 1) for i in range(300)]
    out = []
    for i in range(140):
        words = rng.choices(vocabulary, weights, k=rng.randint(0, 60))
        out.append((i, rng.choice([" ", "\n", " \t "]).join(words).title(), "s", "r", 1))
    out += [(200, None, None, None, None), (201, "", "", "", 0), (202, " \x0b\r ", "", "", 0), (None, "Anti on", "", "", 0)]
    out += [(203, "hot " * 5000, "", "", 0), (204, "y" * 30_000, "", "", 0), (205, "\x1c\x85 Q", "", "", 0)]
    return out + out[:4]


@pytest.fixture(scope="module")
def scored(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return scoring.score(docs.withColumn("held_out", scoring.is_held_out())).collect()


def tokens(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lowered), "\n"]


def held(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 == 2


def test_base_score_by_plain_counts(rows, scored):
    counts = Counter(t for i, text, *_ in rows if not held(i) for t in tokens(text))
    n, v = sum(counts.values()), len(counts)
    want = []
    for i, text, *_ in rows:
        found = tokens(text)
        base = sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in found)
        want.append((str(i), held(i), len(found), sum(counts[t] > 0 for t in found), n, round(base, 6)))
    got = [
        (str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6))
        for r in scored
    ]
    assert sorted(got) == sorted(want)


def test_scores_are_log_probabilities(rows, scored):
    assert len(scored) == len(rows)
    assert all(r["score"] < 0 and math.isfinite(r["score"]) and r["bits_per_byte"] > 0 for r in scored)
    assert {r["_row"] for r in scored} == {"s", "r", "", None} - {"s"} and {r["_id"] for r in scored} == {0, 1, None}
    by = {}
    for r in scored:
        by.setdefault(r["doc_id"], set()).add(r["score"])
    assert all(len(s) == 1 for s in by.values())  # repeated rows
    repeated = next(r for r in scored if r["doc_id"] == 203)
    assert repeated["bits_per_byte"] < 0.2


def test_held_out_texts_next_to_the_base(spark, sf_dir):
    """The base gives all unknown words one place, the model spells them (a sixth of these few documents' words)"""
    docs = spark.read.parquet(f"{sf_dir.replace('sf0.001', 'sf0.01')}/documents.parquet").select("doc_id", "text")
    out = scoring.score(docs.withColumn("held_out", scoring.is_held_out())).filter("held_out")
    model, base, n = out.agg(F.sum("score"), F.sum("base_score"), F.count("*")).first()
    assert n > 100 and model > 1.03 * base


def test_reruns_agree(spark, rows, scored):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(7).withColumn("held_out", scoring.is_held_out())
    again = {str(r["doc_id"]): r["score"] for r in scoring.score(docs).collect()}
    assert all(again[str(r["doc_id"])] == pytest.approx(r["score"], rel=1e-6) for r in scored)


def test_no_rows_and_no_training_rows(spark):
    none = spark.createDataFrame([], SCHEMA).withColumn("held_out", scoring.is_held_out())
    assert scoring.score(none).count() == 0
    only = spark.createDataFrame([(1, "a b a")], "doc_id long, text string").withColumn("held_out", F.lit(True))
    row = scoring.score(only).first()
    assert (row["n_tokens"], row["n_known"], row["train_tokens"], row["base_score"]) == (4, 0, 0, 0.0)
    assert -40 < row["score"] < 0


def small_model(words, counts, bits=12):
    codes, lengths = scoring.spell(words)
    code = scoring.ByteCode((1 + np.bincount(codes, np.repeat(counts, lengths), 256).astype(int)).tolist())
    held = scoring.Bits(words, code)
    both = np.zeros((1 << bits, 2), np.int64)
    for slots in held.slots(bits):
        np.add.at(both, (slots, held.bit), np.repeat(counts, held.count))
    odds = np.clip(np.rint(8 * np.log((both[:, 1] + scoring.PRIOR) / (both[:, 0] + scoring.PRIOR))), -127, 127)
    table = scoring.small(both.sum(1)).astype(np.uint16) << np.uint16(8) | odds.astype(np.int8).view(np.uint8)
    rng = np.random.default_rng(1)
    weights = rng.uniform(0.1, 0.5, (scoring.GATES, len(scoring.CONTEXTS))).astype(np.float32)
    return scoring.Model(code, table, weights)


def one_by_one(model, words):
    """The same mixing with one bit at a time and dictionaries"""
    word, pair, total = {}, {}, 0.0
    weights = {g: list(map(float, scoring.START[g])) for g in range(4)}
    before = np.uint32(0)
    shift = 32 - scoring.LOCAL_BITS
    mixed = lambda h: ((int(h) * int(scoring.MIX32)) & 0xFFFFFFFF) >> shift
    for w in words:
        bits = scoring.Bits([w], model.code)
        inputs, gates = model.inputs(bits)
        paths, moves, marks = bits.paths(), [], []
        for i, y in enumerate(bits.bit.tolist()):
            x0 = sum(float(model.weights[gates[i], k]) * float(x[i]) for k, x in enumerate(inputs))
            if i and abs(x0) >= scoring.CERTAIN:
                total += -math.log1p(math.exp(-max(-15, min(15, x0 if y else -x0))))
                continue
            path = int(paths[i]) & 0xFFFFFFFE
            s, t = mixed(path), mixed(path ^ int(before))
            z, o = word.get(s, (0, 0))
            z2, o2 = pair.get(t, (0, 0))
            gate = 3 if z2 + o2 else min(z + o, 2)
            x = [x0, math.log((o + 0.4) / (z + 0.4)), math.log((o2 + 0.4) / (z2 + 0.4))]
            odds = max(-15, min(15, sum(a * b for a, b in zip(weights[gate], x))))
            p = 1 / (1 + math.exp(-odds))
            total += math.log(p if y else 1 - p)
            moves += [(gate, k, (y - p) * float(scoring.RATE) * x[k]) for k in (1, 2)]
            marks += [(word, s, y, (z, o)), (pair, t, y, (z2, o2))]
        for gate, k, change in moves:
            weights[gate][k] += change
        for table, slot, y, (z, o) in marks:
            z, o = z + (1 - y), o + y
            table[slot] = (z // 2, o // 2) if max(z, o) > 15 else (z, o)
        last = (int(paths[-1]) & 0xFFFFFFFE) | int(bits.bit[-1])
        before = np.uint32((last * int(scoring.STEP32)) & 0xFFFFFFFF)
    return total / math.log(10)


def probabilities(model, texts):
    lexicon = scoring.Lexicon(model)
    number = {}
    ids = np.array([number.setdefault(w, len(number)) for words in texts for w in words], np.int64)
    ids = lexicon.numbers(list(number))[ids]
    sizes = np.array([len(words) for words in texts], np.int64)
    return scoring.log_probabilities(lexicon, ids, np.cumsum(sizes) - sizes, sizes)


def test_words_met_before_keep_their_bits(monkeypatch):
    words = [b"a", b"b", b"ab", scoring.END]
    model = small_model(words, np.array([5, 3, 2, 4]))
    texts = [[b"a", b"x", scoring.END], [b"y", b"a", b"ab", scoring.END], [b"x", b"y", b"z", scoring.END]]
    want = probabilities(model, texts)
    for held in (scoring.HELD, 10):
        monkeypatch.setattr(scoring, "HELD", held)
        lexicon = scoring.Lexicon(model)
        for text, score in zip(texts, want):
            got = scoring.of_run(lexicon, {b"a": 5}, [text])
            assert got[2].to_pylist() == pytest.approx([score], rel=1e-6)
        assert len(lexicon.packed) < 200


def test_mixing_equals_one_bit_at_a_time():
    rng = random.Random(3)
    words = [b"the", b"then", b"thing", b"a", "é".encode(), scoring.END, b"on"]
    model = small_model(words, np.array([50, 20, 7, 30, 2, 9, 400]))
    texts = [[*rng.choices([*words[:5], b"new", b"thong"], k=rng.randint(0, 120)), scoring.END] for _ in range(12)]
    for text, got in zip(texts, probabilities(model, texts)):
        assert got == pytest.approx(one_by_one(model, text), rel=1e-4)


def test_probabilities_of_all_short_texts_stay_below_one():
    words = [b"a", b"b", b"ab", scoring.END]
    model = small_model(words, np.array([5, 3, 2, 4]))
    letters = [bytes([c]) for c in range(256) if c not in b" \t\n\x0b\x0c\r"]
    texts = [[scoring.END], *[[x, scoring.END] for x in letters], *[[x, y, scoring.END] for x, y in product(letters[:120], repeat=2)]]
    total = (10 ** probabilities(model, texts)).sum()
    assert 0.05 < total < 1


def test_long_texts_are_read_in_windows():
    words = [b"a", b"b", scoring.END]
    model = small_model(words, np.array([5, 3, 4]))
    text = [b"a", b"b", b"c"] * scoring.WINDOW + [scoring.END]
    parts = [text[i : i + scoring.WINDOW] for i in range(0, len(text), scoring.WINDOW)]
    assert probabilities(model, [text])[0] == pytest.approx(sum(one_by_one(model, p) for p in parts), rel=1e-4)


def test_a_text_teaches_to_its_end(monkeypatch):
    """Texts of over WINDOW words and short ones in turns through two lanes, each as if read alone and whole"""
    words = [b"a", b"b", scoring.END]
    model = small_model(words, np.array([5, 3, 4]))
    texts = [[b"c", b"a"] * 20 + [scoring.END], [b"a", b"b", b"c"] * 500 + [scoring.END], [scoring.END]]
    texts += [[b"b", b"d"] * 700 + [scoring.END], [b"a"] * 7 + [scoring.END], texts[0]]
    monkeypatch.setattr(scoring, "LANES", 2)
    got = scoring.of_run(scoring.Lexicon(model), {}, texts)[2].to_pylist()
    assert got == pytest.approx([one_by_one(model, t) for t in texts], rel=1e-4)


def test_sums_of_short_and_long_runs_agree(monkeypatch):
    """Bits are added up many words at a time: one word, some words or all at once give the same sums"""
    words = [b"a", b"b", scoring.END]
    model = small_model(words, np.array([5, 3, 4]))
    texts = [[*[b"a", b"c", b"ab"] * n, scoring.END] for n in (0, 3, 40, 1, 90)]
    want = [one_by_one(model, t) for t in texts]
    for many in (0, 500, 1 << 19):
        monkeypatch.setattr(scoring, "TOTALLED", many)
        assert probabilities(model, texts) == pytest.approx(want, rel=1e-4)


def test_packed_odds_are_of_the_bit_that_came():
    words = [b"a", b"the", "é".encode(), scoring.END]
    model = small_model(words, np.array([5, 3, 2, 4]))
    lexicon = scoring.Lexicon(model)
    lexicon.numbers(words)
    bits = scoring.Bits(words, model.code)
    odds = model.corpus_odds(bits)
    open_ = np.abs(odds) < scoring.CERTAIN
    open_[bits.first] = True
    held = (lexicon.packed >> np.uint64(32)).astype(np.uint32).view(np.float32)
    assert held.tolist() == np.where(bits.bit, odds, -odds)[open_].tolist()


def test_own_counts_are_taken_out():
    size, ones = 9, 4
    entry = (size << 8) | int(np.array(round(8 * math.log((ones + 0.1) / (size - ones + 0.1)))).astype(np.int8).view(np.uint8))
    assert scoring.WITHOUT[entry + (1 << 16)] == pytest.approx(math.log(3.1 / 5.1), rel=1e-5)
    assert scoring.WITHOUT[entry] == pytest.approx(math.log(4.1 / 4.1), abs=1e-6)


def test_tokens_by_arrow_are_the_words_and_the_end():
    texts = ["A b  a\n", None, "", " \x0b\r ", "\x1c\x85 Q \u00a0x\u2003y İK É", "\tzz\x0czz ZZ", "日 Ab"]
    for some in (pa.array(texts), pa.array(["cut", *texts, "off"]).slice(1, len(texts)), pa.array([None], pa.string())):
        ids, names, sizes = scoring.tokens_of(some)
        parts = np.split(np.array(names, object)[ids], np.cumsum(sizes)[:-1])
        assert [p.tolist() for p in parts] == [[*scoring.words_of(t), scoring.END] for t in some.to_pylist()]


def spelled_bits(shared, per_bit):
    """Per word what a shared byte's bits have, put back in the words' order"""
    parts = [per_bit[shared.first[i] : shared.first[i] + shared.count[i]] for i in shared.of]
    return np.concatenate(parts)


def test_common_beginnings_are_worked_out_once():
    words = [b"thing", b"the", b"then", scoring.END, "é".encode(), b"t", b"the" * 4, b"xthe", b"thin"]
    model = small_model(words, np.array([5, 3, 2, 4, 1, 9, 1, 2, 2]))
    plain, shared = scoring.Bits(words, model.code), scoring.SharedBits(words, model.code)
    assert len(shared.bit) < 0.9 * len(plain.bit)
    for a, b in [(plain.bit, shared.bit), (plain.paths(), shared.paths()), *zip(plain.slots(12), shared.slots(12))]:
        assert a.tolist() == spelled_bits(shared, b).tolist()
    assert model.corpus_odds(plain).tolist() == spelled_bits(shared, model.corpus_odds(shared)).tolist()
    c = np.arange(1, len(words) + 1)
    assert shared.weights(c).dot(shared.bit) == np.repeat(c, plain.count).dot(plain.bit)


def test_words_asked_for_again_are_not_worked_out_again(monkeypatch):
    words = [b"a", b"b", b"ab", scoring.END]
    model = small_model(words, np.array([5, 3, 2, 4]))
    whole, lexicon, added = scoring.Lexicon(model), scoring.Lexicon(model), []
    whole.numbers([*words, b"x", b"new"])
    monkeypatch.setattr(scoring, "HELD", 10)
    add = scoring.Lexicon.add
    monkeypatch.setattr(scoring.Lexicon, "add", lambda self, some: (added.extend(some), add(self, some)))
    for some in (words, [b"x", b"ab", b"a"], [b"ab", b"new", b"x"]):
        for w, i in zip(some, lexicon.numbers(some).tolist()):
            j = whole.number[w]
            got, want = (x.packed[x.first[k] : x.first[k] + x.count[k]] for x, k in ((lexicon, i), (whole, j)))
            assert got.tolist() == want.tolist()
            assert (lexicon.name[i], lexicon.fixed[i]) == (whole.name[j], pytest.approx(whole.fixed[j]))
    assert added == [*words, b"x", b"new"] and len(lexicon.number) == 3


@pytest.mark.parametrize("rows_held", [1, 1 << 17])
def test_table_counts_every_bit(spark, monkeypatch, rows_held):
    words, c = ["the", "then", "a", "é", "thing", "\n"], [5, 1 << 40, 3, 2, 7, 4]
    monkeypatch.setattr(scoring, "SORTED", rows_held)
    counted = spark.createDataFrame([*zip(words, c)], "word string, c long").repartition(3)
    code = scoring.ByteCode(scoring.byte_counts(counted))
    got = scoring.predictor_table(counted, code, 12)
    held, both = scoring.Bits([w.encode() for w in words], code), np.zeros((1 << 12, 2), np.int64)
    for slots in held.slots(12):
        np.add.at(both, (slots, held.bit), np.repeat(c, held.count))
    odds = np.clip(np.rint(8 * np.log((both[:, 1] + scoring.PRIOR) / (both[:, 0] + scoring.PRIOR))), -127, 127)
    want = scoring.small(both.sum(1)).astype(np.uint16) << np.uint16(8) | odds.astype(np.int8).view(np.uint8)
    assert got.tolist() == want.tolist()
