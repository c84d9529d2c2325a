"""Document fingerprints: a homomorphic multiset hash over paragraphs.

Every paragraph (line) is hashed to a wide vector and a document's fingerprint is the sum of its paragraphs' vectors,
lane by lane, modulo powers of two. Sums do not depend on order, and a paragraph is inserted or deleted by adding or
subtracting its vector (``add``, ``subtract``). The vector has two parts:

* 16 lanes modulo 2^32 of hashes of the paragraph. They tell equality: equal multisets of paragraphs give equal lanes,
  different ones give different lanes but for a chance of about 2^-512.
* the number of the paragraph's phrases (eight words each, counted from its start) modulo 2^40, and 21 words of 62 bits
  that hold 63 lanes modulo 2^20: lane j counts the phrases whose hash has bit j set. They tell likeness: 2 * count -
  phrases is a random projection of the phrase counts, so the cosine of two such vectors estimates that of the counts.

Cases: null text counts as empty, one empty paragraph without phrases; likeness is 1 for equal fingerprints, and 0 when
either has no phrases or the estimate is below 0; documents with the same id are ordered by text, null first; the next
document of a single one is itself; an empty table gives no rows; other columns are not returned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DIGEST_LANES = 16
DIGEST_MASK = (1 << 32) - 1
COUNT_MASK = (1 << 40) - 1
LANE_BITS = 21
PACK_MASK = (1 << 62) - 1
ONES = 1 | 1 << LANE_BITS | 1 << 2 * LANE_BITS
LANE_MASK = (1 << 20) - 1
PHRASE_WORDS = 8
MASKS = [DIGEST_MASK] * DIGEST_LANES + [COUNT_MASK] + [PACK_MASK] * LANE_BITS


def _long(n: int) -> Column:
    return F.lit(n).cast("bigint")


def fingerprint(paragraphs: Column, phrases: Column) -> Column:
    """Array of words from the two hashes of every paragraph and the hash of every phrase"""

    def digest(j: int) -> Column:
        lane = lambda a, p: (a + F.xxhash64(F.lit(j), p["a"], p["b"]).bitwiseAND(_long(DIGEST_MASK))).bitwiseAND(
            _long(DIGEST_MASK)
        )
        return F.aggregate(paragraphs, _long(0), lane)

    def counts(g: int) -> Column:
        bits = lambda a, h: a.bitwiseAND(_long(PACK_MASK)) + F.shiftrightunsigned(h, g).bitwiseAND(_long(ONES))
        return F.aggregate(phrases, _long(0), bits).bitwiseAND(_long(PACK_MASK))

    return F.array(
        *[digest(j) for j in range(DIGEST_LANES)],
        F.size(phrases).cast("bigint").bitwiseAND(_long(COUNT_MASK)),
        *[counts(g) for g in range(LANE_BITS)],
    )


def paragraph_hashes(text: Column) -> Column:
    """Two hashes with different seeds for every line of the text"""
    return F.transform(
        F.split(text, "\n", -1), lambda p: F.struct(F.xxhash64(p).alias("a"), F.xxhash64(F.lit(1), p).alias("b"))
    )


def phrase_hashes(text: Column) -> Column:
    """A hash for every run of up to PHRASE_WORDS words within a line"""
    word, gap = r"[^\x20\x09-\x0D]++", r"[\x20\x09\x0B-\x0D]*+"
    phrases = F.regexp_extract_all(text, F.lit(f"(?:{word}{gap}){{1,{PHRASE_WORDS}}}+"), F.lit(0))
    return F.transform(phrases, lambda p: F.xxhash64(p))


def fingerprint_of(df: DataFrame, text: str, name: str) -> DataFrame:
    """Add the fingerprint of a text column. The hashes are columns of their own, so lanes don't compute them again."""
    own = F.coalesce(F.col(text), F.lit(""))
    hashed = df.withColumns({"_paragraphs": paragraph_hashes(own), "_phrases": phrase_hashes(own)})
    return hashed.withColumn(name, fingerprint(F.col("_paragraphs"), F.col("_phrases"))).drop("_paragraphs", "_phrases")


def _combined(one: Column, two: Column, sign: int) -> Column:
    masks = F.array(*[_long(m) for m in MASKS])
    other = two if sign > 0 else F.zip_with(two, masks, lambda y, m: (m - y).bitwiseAND(m) + _long(1))
    joined = F.arrays_zip(one.alias("x"), other.alias("y"), masks.alias("m"))
    # both terms are below 2^62 + 1, so the sum fits
    return F.transform(joined, lambda t: (t["x"] + t["y"]).bitwiseAND(t["m"]))


def add(one: Column, two: Column) -> Column:
    """Fingerprint of two documents put together"""
    return _combined(one, two, 1)


def subtract(one: Column, two: Column) -> Column:
    """Fingerprint without the paragraphs of ``two``"""
    return _combined(one, two, -1)


def lanes(words: Column) -> Column:
    """63 projections: 2 * count - phrases"""
    n = F.element_at(words, DIGEST_LANES + 1)
    packed = F.slice(words, DIGEST_LANES + 2, LANE_BITS)
    return F.flatten(
        F.transform(
            packed,
            lambda w: F.array(
                *[
                    F.shiftrightunsigned(w, k * LANE_BITS).bitwiseAND(_long(LANE_MASK)) * 2 - n
                    for k in range(3)
                ]
            ),
        )
    )


def likeness(one: str, two: str, one_lanes: str, two_lanes: str) -> Column:
    """1 for equal fingerprints, else the cosine of the projections, at least 0"""

    def dot(a: str, b: str) -> Column:
        total = lambda s, x: s + x
        product = lambda x, y: x.cast("double") * y
        return F.aggregate(F.zip_with(a, b, product), F.lit(0.0), total)

    size = F.sqrt(dot(one_lanes, one_lanes)) * F.sqrt(dot(two_lanes, two_lanes))
    cosine = F.when(size > 0, dot(one_lanes, two_lanes) / size).otherwise(F.lit(0.0))
    # a rounded cosine of two different vectors may not pass for equality
    return F.when(F.col(one) == F.col(two), F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(0.999999), cosine)))


def as_text(words: str) -> Column:
    """Lowercase hex, 8 digits for digest lanes, 16 for the others"""
    first = F.transform(F.slice(words, 1, DIGEST_LANES), lambda x: F.lpad(F.lower(F.hex(x)), 8, "0"))
    rest = F.transform(F.slice(words, DIGEST_LANES + 1, LANE_BITS + 1), lambda x: F.lpad(F.lower(F.hex(x)), 16, "0"))
    return F.concat(F.array_join(first, ""), F.array_join(rest, ""))


def _block_number(doc_id: Column, edges: list[int]) -> Column:
    """How many of the sorted edges are at most the id, searched in two steps"""
    if not edges:
        return F.lit(0)
    step = max(1, int(len(edges) ** 0.5))
    groups = [edges[i : i + step] for i in range(0, len(edges), step)]
    below = lambda e: e <= doc_id
    coarse = F.size(F.filter(F.array(*[_long(g[0]) for g in groups]), below))
    fine = F.array(*[F.array(*[_long(e) for e in g]) for g in groups])
    inside = F.size(F.filter(F.get(fine, coarse - 1), below))
    return F.when(coarse == 0, 0).otherwise((coarse - 1) * step + inside)


def with_next(docs: DataFrame, columns: list[str], blocks: int | None = None) -> DataFrame:
    """Add the struct ``_next``: ``columns`` of the next document by (doc_id, text), of the first after the last.

    Ids are cut at approximate quantiles into ``blocks`` (four per shuffle partition unless given, 4096 at most), and
    a block is one window. The first document of a block also goes to the block before it (the very first to the last
    block, where it ends the circle), so one pass over the texts is enough and no task sees more than a block. The
    driver gets one number per block.
    """
    spark = docs.sparkSession
    count = blocks or min(4096, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    shares = F.array(*[F.lit(i / count) for i in range(1, count)])
    found = docs.agg(F.percentile_approx("doc_id", shares, F.lit(10 * count)).alias("e")).first()["e"] if count > 1 else []
    edges = sorted({int(e) for e in found or []})
    block = F.when(F.col("doc_id").isNull(), -1).otherwise(_block_number(F.col("doc_id"), edges))
    starts = docs.select("doc_id", block.alias("_own")).groupBy("_own").agg(F.min("doc_id").alias("_start")).collect()
    order = sorted((r["_own"], r["_start"]) for r in starts)
    heads = spark.createDataFrame(
        [(b, start, order[i - 1][0], i == 0) for i, (b, start) in enumerate(order)],
        "_own int, _start bigint, _to int, _wraps boolean",
    )
    placed = docs.withColumn("_own", block).join(F.broadcast(heads), "_own")
    stay = F.struct(F.col("_own").alias("block"), F.lit(False).alias("copy"), F.lit(False).alias("wraps"))
    visit = F.struct(F.col("_to").alias("block"), F.lit(True).alias("copy"), F.col("_wraps").alias("wraps"))
    places = F.when(F.col("doc_id").eqNullSafe(F.col("_start")), F.array(stay, visit)).otherwise(F.array(stay))
    at = placed.withColumn("_at", F.explode(places)).withColumn("_block", F.col("_at.block"))
    circle = Window.partitionBy("_block").orderBy("_at.wraps", "doc_id", "text")
    led = at.withColumn("_next", F.lead(F.struct(*columns)).over(circle)).filter(~F.col("_at.copy"))
    return led.drop("_own", "_start", "_to", "_wraps", "_at", "_block")


def compare_with_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of all texts and of their edited texts, and how alike they are.

    The edited text has its last floor(n_chars / 2) characters replaced by as many of the next document's first ones.
    """
    own = fingerprint_of(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), "text", "_words")
    led = with_next(own, ["text", "_words"])
    n = F.char_length("text")
    cut = (n / 2).cast("int")
    head = F.substring(F.col("text"), F.lit(1), n - cut)
    tail = F.substring(F.col("_next.text"), F.lit(1), cut)
    edited = led.select(
        "doc_id",
        n.cast("bigint").alias("n_chars"),
        "_words",
        F.col("_next._words").alias("_next_words"),
        F.concat(head, tail).alias("_edited"),
    )
    both = fingerprint_of(edited, "_edited", "_edited_words").withColumns(
        {
            "_lanes": lanes(F.col("_words")),
            "_edited_lanes": lanes(F.col("_edited_words")),
            "_next_lanes": lanes(F.col("_next_words")),
        }
    )
    return both.select(
        "doc_id",
        "n_chars",
        F.sha2("_edited", 256).alias("edited_sha256"),
        as_text("_words").alias("fingerprint"),
        as_text("_edited_words").alias("edited_fingerprint"),
        likeness("_words", "_edited_words", "_lanes", "_edited_lanes").alias("near_edited"),
        likeness("_words", "_next_words", "_lanes", "_next_lanes").alias("near_next"),
    )
