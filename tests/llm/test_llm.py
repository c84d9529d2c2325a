"""The operators on small tables: brute force, nulls, empty and long texts, repeated rows, extra columns, empty tables."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from feedloom.llm import (
    bpe,
    components,
    fingerprints,
    licenses,
    line_dedup,
    mixing,
    neighbors,
    secrets,
    simhash,
    suffixes,
    toxicity,
)

LINE = "this line is long enough to count as a repeated one, ok"
ROWS = [
    (1, f"{LINE}\nown words here", "a", "n"),
    (2, f"  {LINE.upper()}\t\nother words", "a", "n"),
    (3, LINE, None, None),
    (4, f"{LINE}\n{LINE}", "b", "n"),
    (5, f"x\n{LINE}\ny", "b", "n"),
    (6, f"{LINE}\nlast one", "c", "n"),
    (7, None, "c", "n"),
    (8, "", "a", "n"),
    (9, "é ü 　 日本 🙂", "a", "n"),
    (9, "é ü 　 日本 🙂", "a", "n"),
    (None, f"no id\n{LINE}", "a", "n"),
    (10, "Released under the MIT License.\n" + " ".join(f"word{i}" for i in range(3000)), "d", "n"),
    (11, 'password = "x9Kq7Zpw2LmN"\npwd: s0mE&th1ng!Odd', "d", "n"),
]
SCHEMA = "doc_id long, text string, source string, _row string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_mixing(docs, none):
    rows = mixing.copies(docs).collect()
    assert len(rows) == len(ROWS) and {r["_row"] for r in rows} == {"n", None}
    by = {r["source"]: (r["source_size"], r["target"]) for r in rows}
    sizes = {}
    for _, text, source, _ in ROWS:
        sizes[source] = sizes.get(source, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    assert {k: v[0] for k, v in by.items()} == sizes
    assert sum(v[1] for v in by.values()) == pytest.approx(sum(sizes.values()))
    assert all(t <= 3 * s for s, t in by.values())
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(r["n_copies"] for r in rows)
    assert mixing.mix(none).count() == 0


def test_mixing_by_salted_join(docs, monkeypatch):
    want = sorted(str(r) for r in mixing.copies(docs).collect())
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)
    assert sorted(str(r) for r in mixing.copies(docs).collect()) == want


def test_line_dedup(docs, none):
    got = line_dedup.drop_repeated_lines(docs).collect()
    texts = {(r["doc_id"], r["n_lines"], r["n_dropped"]): r["text"] for r in got}
    assert texts[1, 2, 1] == "own words here"
    assert texts[3, 1, 1] == "" and texts[4, 2, 2] == "" and texts[5, 3, 1] == "x\ny"
    assert texts[6, 2, 0] == f"{LINE}\nlast one"  # the largest id keeps the line
    assert texts[None, 2, 1] == "no id"
    assert texts[7, 1, 0] == "" and len(got) == len(ROWS)
    assert line_dedup.drop_repeated_lines(none).count() == 0


@pytest.mark.parametrize("batches", [1, 3])
def test_line_runs_do_not_depend_on_batches(docs, batches):
    found = line_dedup.repeated_lines(docs.select("doc_id", "text"), min_docs=2, batches=batches).collect()
    # a settled key is not counted on, so the number of documents is a lower bound
    assert [(r["_docs"] >= 2, r["_last"]) for r in found] == [(True, 6)]


def test_secrets(docs, none):
    rows = {r["doc_id"]: r["spans"] for r in secrets.scan(docs, words=["something"]).collect()}
    text = ROWS[-1][1]
    found = [(s["kind"], text[s["start"] : s["end"]]) for s in rows[11]]
    assert found == [("assign", 'password = "x9Kq7Zpw2LmN'), ("guess", "s0mE&th1ng!Odd")]
    assert rows[7] == rows[8] == []
    assert secrets.scan(none, words=[]).count() == 0 and secrets.common_words(none) == []


def test_credential_words_before_each_other():
    ranks = {w: i + 1 for i, w in enumerate(secrets.COMMON)}
    for text, values in (
        ("Auth token: $x9!Kq7#Zpw2&LmN", ["$x9!Kq7#Zpw2&LmN"]),
        ("secret password: $x9!Kq7#Zpw2&LmN", ["$x9!Kq7#Zpw2&LmN"]),
        ("DB_PASSWORD=p@9!Kq7#Zpw2&LmN", ["p@9!Kq7#Zpw2&LmN"]),
        ("user_pwd = p@9!Kq7#Zpw2&LmN", ["p@9!Kq7#Zpw2&LmN"]),
        ("secret token=$x9!Kq7#Zpw2&LmN", ["token=$x9!Kq7#Zpw2&LmN"]),
        ("compass: $x9!Kq7#Zpw2&LmN", []),
    ):
        found = secrets.guess_spans(text, ranks, 9.0, secrets.base_spans(text))
        assert [text[a:b] for a, _, b in found] == values


def test_guess_costs():
    ranks = {"password": 1, "horse": 50}
    cost = lambda s: secrets.guess_cost(s, ranks)
    assert cost("password") < cost("Password") < cost("P@ssword") < cost("pxsswqrd")
    assert cost("a" * 1000) < 6 and cost("qwertyuiop") < cost("qptwuyrieo")
    assert cost("2019-04-12") < cost("8371-95-77") and cost("horsehorse") < 2 * cost("horse") + 2
    assert cost("") == 0


def test_fingerprints(spark, docs, none):
    rows = fingerprints.compare_with_edits(docs).collect()
    own = {(r["doc_id"], r["n_chars"]): r for r in rows}
    assert len(rows) == len(ROWS)
    assert own[7, 0]["fingerprint"] == own[8, 0]["fingerprint"]
    first = next(r for r in rows if r["doc_id"] is None)
    after = f"no id\n{LINE}"
    edited = after[: len(after) - len(after) // 2] + ROWS[0][1][: len(after) // 2]
    assert first["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
    last = own[11, len(ROWS[-1][1])]  # the first document, the one without id, follows
    assert 0 <= last["near_next"] <= 1
    assert all(r["near_next"] == 1 for r in rows if r["doc_id"] == 7)
    one = spark.createDataFrame([(1, "some words")], "doc_id long, text string")
    assert fingerprints.compare_with_edits(one).first()["near_next"] == 1
    assert fingerprints.compare_with_edits(none).count() == 0


def test_fingerprints_add_up(spark):
    df = spark.createDataFrame([("a b c d\ne f", "g h", "g h\na b c d\ne f")], "x string, y string, z string")
    for c in "xyz":
        df = fingerprints.fingerprint_of(df, c, f"f{c}")
    r = df.select(
        "fz",
        fingerprints.add(F.col("fx"), F.col("fy")).alias("sum"),
        "fx",
        fingerprints.subtract(F.col("fz"), F.col("fy")).alias("rest"),
    ).first()
    assert r["sum"] == r["fz"] and r["rest"] == r["fx"]


def test_next_document_over_many_blocks(spark):
    rows = [(i * 7 % 101, f"t{i * 7 % 101}") for i in range(101)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for blocks in (1, 4, 40):
        got = {r["doc_id"]: r["_next"]["text"] for r in fingerprints.with_next(df, ["text"], blocks).collect()}
        assert got == {i: f"t{(i + 1) % 101}" for i in range(101)}


@pytest.fixture(scope="module")
def vocabulary():
    tokenizers = pytest.importorskip("public_tokenizers")
    return tokenizers.path("byte_bpe_50k.json")


def test_bpe_equals_library(vocabulary):
    from tokenizers import Tokenizer

    rng = random.Random(1)
    texts = ["", "  a  b\n\n c", "it's we'll", "<|endoftext|>x<|endoftext|>", "x" * 3000, "ab" * 500 + "!?" * 40]
    texts += ["".join(rng.choice("ab c'sd\n\t .,!?1é日🙂 \x1c\x85<|") for _ in range(rng.randint(0, 60))) for _ in range(300)]
    got = [np.frombuffer(b, np.int32).tolist() for b in bpe.Encoder(bpe.Vocabulary(vocabulary)).encode(texts)]
    want = Tokenizer.from_file(vocabulary).encode_batch(texts, add_special_tokens=False)
    assert got == [w.ids for w in want]


def test_bpe_round_trip(docs, none, vocabulary):
    rows = bpe.decode(bpe.encode(docs, vocabulary), vocabulary).collect()
    assert all(r["decoded"] == (r["text"] or "") for r in rows) and len(rows) == len(ROWS)
    assert bpe.decode(bpe.encode(none, vocabulary), vocabulary).count() == 0


def test_bpe_in_one_worker(spark, docs, vocabulary):
    clashing = docs.withColumn("ids", F.lit("x")).withColumn("decoded", F.lit(1))
    rows = bpe.code(clashing, vocabulary).collect()
    two = bpe.decode(bpe.encode(docs, vocabulary), vocabulary).collect()
    assert sorted((str(r["doc_id"]), r["ids"], r["decoded"]) for r in rows) == sorted(
        (str(r["doc_id"]), r["ids"], r["decoded"]) for r in two
    )
    assert set(rows[0].asDict()) == {"doc_id", "source", "_row", "ids", "decoded"}
    same = bpe.code(docs, vocabulary, compare="same").collect()
    assert all(r["same"] for r in same) and "decoded" not in same[0]
    with pytest.raises(Exception, match="does not have"):
        bpe.decode(spark.createDataFrame([([-1],)], "ids array<int>"), vocabulary).collect()


def test_bpe_table_is_bounded(vocabulary, monkeypatch):
    shared = bpe.Vocabulary(vocabulary)
    texts = [" ".join(f"w{i}q{j % 7}" for j in range(i, i + 200)) * 2 for i in range(0, 4000, 100)]
    want = [bpe.Encoder(shared).encode([t])[0] for t in texts]
    monkeypatch.setattr(bpe, "REMEMBERED", 20_000)
    encoder, most = bpe.Encoder(shared), 0
    for text, ids in zip(texts, want):
        assert encoder.encode([text]) == [ids]
        most = max(most, len(encoder.known))
        assert encoder.held <= bpe.REMEMBERED
    assert 0 < most <= bpe.REMEMBERED // bpe.ENTRY


def test_licenses(docs, none):
    found = {r["doc_id"]: r for r in licenses.by_document(licenses.scan(docs)).collect()}
    assert (found[10]["n_matches"], found[10]["licenses"], found[10]["best_dice"]) == (1, "mit-short", 1.0)
    assert found[7]["n_matches"] == 0 and found[9]["best_dice"] == 0.0
    assert licenses.size_bounds(10, 0.8) == (7, 15)
    assert licenses.by_document(licenses.scan(none)).count() == 0


def test_licenses_against_brute_force(spark):
    """Notices with words left out, other case and marks, and broken over lines; K is no ASCII letter"""
    texts = []
    for _, notice in licenses.NOTICES:
        words = notice.split()
        for k in (2, 3, 5, 9):
            left = [w for n, w in enumerate(words) if n % (k + 4) != k]
            texts += [" ".join(left).upper(), "** " + ", ".join(left) + " **", " ".join(words[:-k] or words)]
        half = len(words) // 2
        texts.append(" ".join(words[:half]) + "\n" + " ".join(words[half:]))
        texts.append("other words before\n" + notice + "\n\n" + notice.replace("k", "\u212a") + "\n")
    expected = set()
    for n, text in enumerate(texts):
        lines = text.split("\n")
        for number, unit in [*enumerate(lines, 1), *([(0, text)] if len(lines) > 1 else [])]:
            own = set(licenses._pairs(unit))
            for name, notice in licenses.NOTICES:
                pairs = set(licenses._pairs(notice))
                dice = 2 * len(own & pairs) / (len(own) + len(pairs))
                if dice >= licenses.THRESHOLD:
                    expected.add((n, number, name, round(dice, 9)))
    found = licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()
    got = {(r["doc_id"], r["unit"], r["license"], round(r["dice"], 9)) for r in found if r["license"]}
    assert got == expected
    assert len(expected) > 2 * len(licenses.NOTICES)
    assert any(unit == 0 for _, unit, _, _ in expected)


@pytest.mark.parametrize("scaled", [False, True])
def test_neighbors(spark, scaled):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((400, 16)) + 2 * rng.standard_normal((5, 16))[rng.integers(0, 5, 400)]
    x[50:90] = x[50]  # copies
    if not scaled:
        x /= np.linalg.norm(x, axis=1, keepdims=True)
    odd = [(1000, None), (1001, []), (1002, [0.0] * 16), (1003, [float("nan")] * 16), (1004, [1.0] * 8), (None, [1.0] * 16)]
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)] + odd + [(7, [float(v) for v in x[7]])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = neighbors.search(df, F.col("vec_id") % 20 == 0, k=10, block_rows=16).toPandas()
    hits = 0
    for q in range(0, 400, 20):
        scores = [float(np.cumsum(x[q] * v)[-1]) for v in x]
        best = sorted((i for i in range(400) if i != q), key=lambda i: (-scores[i], i))[:10]
        mine = got[got["query_id"] == q].sort_values("rank")
        assert list(mine["rank"]) == list(range(1, 11))
        assert [scores[i] for i in mine["vec_id"]] == list(mine["score"])
        hits += len(set(best) & set(mine["vec_id"]))
    assert hits / 200 >= 0.9
    empty = spark.createDataFrame([], "vec_id long, embedding array<double>")
    assert neighbors.search(empty, F.col("vec_id") % 20 == 0).count() == 0


@pytest.mark.parametrize("n, spread, long", [(1200, 0.5, 1), (1200, 0.0, 20), (30, 0.0, 1)])
def test_neighbors_of_unequal_lengths(spark, n, spread, long):
    """64 dimensions with the registered tables and probes; every query gets its k rows"""
    rng = np.random.default_rng(4)
    x = rng.standard_normal((n, 64))
    x *= np.exp(spread * rng.standard_normal(n))[:, None] / np.linalg.norm(x, axis=1, keepdims=True)
    x[5] *= long
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "vec_id long, embedding array<double>")
    got = neighbors.search(df, F.col("vec_id") % 20 == 0).toPandas()
    hits = 0
    for q in range(0, n, 20):
        scores = x @ x[q]
        scores[q] = -np.inf
        mine = got[got["query_id"] == q]
        assert sorted(mine["rank"]) == list(range(1, 21))
        hits += len(set(np.argsort(-scores)[:20]) & set(mine["vec_id"]))
    assert hits / (20 * len(range(0, n, 20))) >= 0.9


def plain_simhash(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) > 3 else [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_groups(spark, docs, none):
    got = simhash.groups(docs).collect()
    for r in got:
        texts = [t for i, t, *_ in ROWS if i == r["doc_id"]]
        assert r["fingerprint"] == f"{plain_simhash(texts[0]):016x}"
    by = {r["doc_id"]: r["component_id"] for r in got}
    assert by[8] == by[7] == 7 and by[9] == 9
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns and len(kept.filter("doc_id = 9").collect()) == 1
    assert kept.filter("doc_id = 8").isEmpty() and simhash.keep_first(none).count() == 0


@pytest.mark.parametrize("group_rows", [4, 1024])
def test_simhash_links(spark, group_rows):
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(40)]
    values = set(base)
    for b in base[:10]:
        for _ in range(30):
            b ^= 1 << rng.randrange(64) | 1 << rng.randrange(64)
            values.add(b)
    values = sorted(v - (1 << 64) if v >> 63 else v for v in values)
    df = spark.createDataFrame([(v,) for v in values], "fp long")
    found = components.components(simhash.links(df, 2, group_rows)).collect()
    label = {v: v for v in values} | {r["node"]: r["component"] for r in found}
    bits = np.array(values, np.int64)
    parent = {v: v for v in values}

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for i, v in enumerate(values):
        for j in np.flatnonzero(np.bitwise_count((bits ^ bits[i]).view(np.uint64)) <= 2):
            a, b = sorted((root(v), root(values[j])))
            parent[b] = a
    assert label == {v: root(v) for v in values}


def test_thresholds_are_complete():
    share = np.full(64, 0.5)
    for m in range(1, 5):
        parts = simhash.correlated_parts(100, np.full((64, 64), 25.0), m)
        assert sorted(b for p in parts for b in p) == list(range(64))
        _, thresholds = simhash.allocate(10**6, share, parts, 2)
        assert sum(thresholds) == 2 - m + 1


def plain_repeats(rows, length=50):
    least = {}
    for k, t in rows:
        b = (t or "").encode()
        for i in range(len(b) - length + 1) if k is not None else ():
            s = b[i : i + length]
            least[s] = min(k, least.get(s, k))
    out = []
    for k, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1) if k is not None else ():
            if least[b[i : i + length]] < k:
                gone[i : i + length] = True
        spans = int((np.diff(np.append(False, gone).astype(int)) == 1).sum())
        out.append((k, len(b), int(gone.sum()), spans, bytes(np.frombuffer(b, np.uint8)[~gone])))
    return sorted(out, key=str)


@pytest.mark.parametrize("hot_pieces", [3, 10**6])
def test_suffix_dedup(spark, hot_pieces):
    rng = random.Random(1)
    base = ["".join(rng.choice("ab") for _ in range(rng.randint(0, 200))) for _ in range(20)]
    rows = [(i, rng.choice(base) + rng.choice(["", "é", "x" * 120]) + rng.choice(base)) for i in range(60)]
    rows += [(500, "a" * 400), (501, "a" * 90), (502, "a" * 50), (503, "a" * 49), (504, ""), (505, None), (None, "a" * 90)]
    rows += [(500, "a" * 400)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("kept", F.lit(1))
    got = suffixes.remove_repeats(df, hot_pieces=hot_pieces).collect()
    mine = [(r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in got]
    assert sorted(mine, key=str) == plain_repeats(rows)


def test_suffix_pieces_are_runs_of_strings_with_one_anchor():
    rng = random.Random(5)
    texts = ["".join(rng.choice("abc") for _ in range(n)).encode() for n in (0, 49, 130, 0, 50, 400, 3, 0)] + [b"a" * 200]
    lengths = np.array([len(t) for t in texts])
    starts = np.cumsum(lengths) - lengths
    codes = np.frombuffer(b"".join(texts), np.uint8)
    values = suffixes.mixed(suffixes.eights(codes), np.uint64(1))
    least = suffixes.least_places(values, 43)
    upper = (values >> np.uint64(32)).tolist()
    assert least.tolist() == [min(range(i, i + 43), key=upper.__getitem__) for i in range(len(codes) - 42)]
    text, begin, anchor, count, _ = suffixes.pieces(codes, starts, lengths, 50)
    found = [(t, p - starts[t], a) for t, b, c, a in zip(text, begin, count, anchor) for p in range(b, b + c)]
    want = [(t, i, least[starts[t] + i]) for t, n in enumerate(lengths) for i in range(n - 49)]
    assert found == want


def test_suffix_cut_without_texts(spark):
    rows = [(1, "x" * 60), (2, "é" + "x" * 70 + "y"), (3, None), (4, ""), (5, "x" * 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    lean, full = (suffixes.remove_repeats(docs, keep_text=k) for k in (False, True))
    assert "text" not in lean.columns and "text" in full.columns
    got = [(r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in lean.collect()]
    assert sorted(got, key=str) == plain_repeats(rows)
    spans = [[{"low": 2, "high": 4}, {"low": 3, "high": 6}], None, [{"low": 0, "high": 2}, {"low": 2, "high": 3}], [], []]
    kind = pa.list_(pa.struct([("low", pa.int64()), ("high", pa.int64())]))
    batch = pa.RecordBatch.from_arrays([pa.array([b"abcdef", b"", b"ghi", b"jk", b""]), pa.array(spans, kind)], ["text", "_spans"])
    kept = [[b"ab", b"", b"", b"jk", b""], [6, 0, 3, 2, 0], [4, 0, 3, 0, 0], [1, 0, 1, 0, 0]]
    assert [x.to_pylist() for x in suffixes.cut_spans(batch)] == kept
    assert [x.to_pylist() for x in suffixes.cut_spans(batch.slice(1, 2))] == [x[1:3] for x in kept]


def test_suffix_dedup_of_nothing(none):
    assert suffixes.remove_repeats(none).count() == 0


def toxic_docs(spark):
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(200)]
    rows, marks = [], []
    for i in range(600):
        text = [rng.choice(words) for _ in range(rng.randint(5, 120))]
        toxic = i % 3 == 0
        if toxic:
            text[rng.randrange(len(text))] = rng.choice(["idiot", "moron"])
        rows.append((i, " ".join(text), "s", "l"))
        marks.append((i, int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string, source string, lang string"), spark.createDataFrame(
        marks, "doc_id long, toxic int"
    )


def test_toxicity_on_held_out_rows(spark, docs, none):
    texts, labels = toxic_docs(spark)
    rows = toxicity.score(texts, labels).withColumn("held", toxicity.held_out("doc_id")).collect()
    held = [r for r in rows if r["held"]]
    right = sum((r["score"] >= 0.7) == (r["doc_id"] % 3 == 0) for r in held)
    assert right / len(held) >= 0.95 and len(rows) == 600
    odd = toxicity.score(docs, labels.limit(0)).collect()
    assert {r["score"] for r in odd} == {0.0} and len(odd) == len(ROWS)
    scored = toxicity.score(docs.unionByName(texts, allowMissingColumns=True).drop("lang"), labels).filter("source <> 's'")
    assert all(0 <= r["score"] <= 1 for r in scored.collect())
    assert toxicity.score(none, labels).count() == 0


def test_gradients():
    network = toxicity.Network({"aa": 1, "bb": 2}, dim=2, hidden=3)
    network.start(1)
    network.weights = {k: v.astype(np.float64) for k, v in network.weights.items()}
    index = np.zeros((3, toxicity.WINDOW), np.int32)
    index[0, :5], index[1, :2], index[2, :7] = [1, 2, 3, 1, 2], [3, 3], [2, 2, 1, 1, 3, 1, 2]
    labels = np.array([1.0, 0.0, 1.0])

    def loss():
        inputs = network.inputs(["", "aa", "bb", "cc"])
        inputs[3][0] = 0
        score = network.forward(inputs[3] @ network.weights["wx"] + network.weights["b"], index)
        return np.mean(np.log1p(np.exp(score)) - labels * score), inputs

    grads = network.gradients(index, loss()[1], labels)
    for name, place in (("wh", (0, 1, 2)), ("wx", (1, 2, 4)), ("att", (1,)), ("out", (2,)), ("b", (0, 0, 1)), ("word", (1, 1))):
        kept = network.weights[name][place]
        sides = []
        for step in (1e-2, -1e-2):
            network.weights[name][place] = kept + step
            sides.append(loss()[0])
        network.weights[name][place] = kept
        assert grads[name][place] == pytest.approx((sides[0] - sides[1]) / 2e-2, abs=2e-4)


def test_pipeline_stages(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    clean = corpus_pipeline.toxicity_stage(spark, docs, sf_dir).cache()
    toxic = spark.read.parquet(f"{sf_dir}/labels.parquet").filter("toxic = 1")
    assert clean.columns == list(corpus_pipeline.COLUMNS)
    assert clean.join(toxic, "doc_id").count() <= toxic.count() // 2
    assert clean.count() >= 0.8 * docs.count()
    lines = corpus_pipeline.line_stage(spark, clean, sf_dir)
    assert lines.count() == clean.count() and lines.filter("n_chars <> char_length(text)").isEmpty()
    one = corpus_pipeline.near_stage(spark, clean, sf_dir)
    assert one.count() == simhash.groups(clean).select("component_id").distinct().count()
    mixed = corpus_pipeline.mixing_stage(spark, one, sf_dir)
    assert mixed.columns == list(corpus_pipeline.COLUMNS)
    coded = corpus_pipeline.encoding_stage(spark, mixed, sf_dir)
    assert coded.filter("not round_trip").isEmpty() and coded.count() == mixed.count()
