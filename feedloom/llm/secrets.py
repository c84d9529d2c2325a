"""Secret scans: fixed patterns, and guess costs of values that stand where a credential is named.

Values after words such as ``pwd``, ``bearer`` or ``passphrase`` are weighed by the guesses an attacker needs: the
cheapest segmentation into words, dates, repeats, keyboard walks and single characters, found by dynamic programming in
time linear in the value (segments other than repeats and walks have bounded length; those two are taken as long as they
run). A value of at least ``least_cost`` (log10 of guesses) is reported as kind ``guess``.

Words are ranked by how often they occur in all documents; the list is cut at its length parameter.

Cases: null text counts as empty; matches of one kind do not overlap, those of different kinds may; a value inside a
reported base span is not reported again; an empty table gives no rows; a column ``spans`` is replaced, others are kept.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, with_column

# fixed values: kinds in their order, and the contract's patterns
KINDS = ("assign", "access", "hex", "guess")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # the same spans as runs of any length of which 32 characters are asked

# fixed values: words that name a credential, common passwords, keyboard rows, look-alike characters
# a word's separator and value are looked ahead at, so that a value may itself be the word before the real one
CONTEXT = re.compile(
    r"""(?<![A-Za-z0-9])(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|api[_-]?key|credentials?|auth|bearer|access[_-]?key|private[_-]?key)(?![A-Za-z0-9_])"""
    r"""(?=["']?(?:[\x20\t]*[:=][\x20\t]*|\x20+is\x20+|\x20+)["']?([^\s"'<>]{6,}))""",
    re.I | re.A,
)
HINTS = ("pass", "pwd", "secret", "token", "apikey", "api_key", "api-key", "credential", "auth", "bearer", "access", "private")
COMMON = (
    "password passw0rd letmein welcome qwerty monkey dragon master login admin root user test guest changeme secret "
    "default iloveyou sunshine princess football baseball shadow superman batman trustno1 hello freedom whatever"
).split()
ROWS = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./")
LOOKALIKE = str.maketrans("@431!05$7", "aaeiiosst")
DATE = re.compile(r"(?:19|20)\d\d([-/.]?)\d{1,2}\1\d{1,2}|\d{1,2}([-/.]?)\d{1,2}\2(?:19|20)\d\d|(?:19|20)\d\d")

LONGEST_WORD = 20
LONGEST_UNIT = 8
SPLIT_COST = math.log10(2)


def next_keys() -> dict[str, str]:
    """For every key the keys beside it, in its row and the rows next to it"""
    near: dict[str, set[str]] = {}
    for y, row in enumerate(ROWS):
        for x, key in enumerate(row):
            for other, shift in ((y, -1), (y, 1), (y - 1, 0), (y - 1, 1), (y + 1, 0), (y + 1, -1)):
                if 0 <= other < len(ROWS) and 0 <= x + shift < len(ROWS[other]):
                    near.setdefault(key, set()).add(ROWS[other][x + shift])
    return {k: "".join(sorted(v)) for k, v in near.items()}


NEAR = next_keys()


def char_cost(c: str) -> float:
    """log10 of the size of the character's class"""
    if c.isdigit():
        return 1.0
    return math.log10(26) if c.isascii() and c.isalpha() else math.log10(33) if c.isascii() else 3.0


def guess_cost(value: str, ranks: dict[str, int]) -> float:
    """log10 of the guesses for the cheapest segmentation"""
    n, low = len(value), value.lower()
    if len(low) != n:  # a few letters change their number when lower-cased
        low = value
    plain = low.translate(LOOKALIKE)
    best = [0.0] + [math.inf] * n
    # per unit length, how many characters from here on equal the one that many places further
    runs = [0] * (LONGEST_UNIT + 1)
    same = [[0] * (n + 1) for _ in range(LONGEST_UNIT + 1)]
    for i in range(n - 1, -1, -1):
        for u in range(1, LONGEST_UNIT + 1):
            runs[u] = runs[u] + 1 if i + u < n and value[i] == value[i + u] else 0
            same[u][i] = runs[u]
    walk_end, turns = n, 0
    walks = [(0, 0)] * n  # where the walk that starts here ends, and its changes of direction
    for i in range(n - 2, -1, -1):
        if low[i + 1] in NEAR.get(low[i], ""):
            end, turns = walks[i + 1] if walks[i + 1][0] else (i + 2, 0)
            turned = i + 2 < end and ord(low[i + 1]) - ord(low[i]) != ord(low[i + 2]) - ord(low[i + 1])
            walks[i] = (end, turns + turned)
    for i in range(n):
        here = best[i] + SPLIT_COST

        def offer(j: int, cost: float) -> None:
            if cost < best[j]:
                best[j] = cost

        offer(i + 1, best[i] + char_cost(value[i]))
        for length in range(3, min(LONGEST_WORD, n - i) + 1):
            j = i + length
            rank = ranks.get(low[i:j])
            if rank is not None:
                cased = value[i:j]
                extra = 0.0 if cased.islower() else math.log10(2) if cased.istitle() or cased.isupper() else math.log10(2) * length
                offer(j, here + math.log10(rank) + extra)
            elif (rank := ranks.get(plain[i:j])) is not None:
                offer(j, here + math.log10(rank) + 2 * math.log10(2))
        for u in range(1, LONGEST_UNIT + 1):
            if (times := same[u][i] // u + 1) >= (3 if u == 1 else 2):
                unit = sum(map(char_cost, value[i : i + u]))
                offer(i + u * times, here + unit + math.log10(times))
        end, turns = walks[i]
        if end - i >= 4:
            offer(end, here + math.log10(47 * (end - i)) + (turns + 1) * math.log10(4.6))
        if value[i].isdigit() and (m := DATE.match(value, i)):
            offer(m.end(), here + (math.log10(130) if m.end() - i == 4 else math.log10(365 * 130)))
    return best[n]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the three fixed kinds"""
    found = []
    low = text.lower()
    if any(h in low for h in ("passw", "secret", "token", "apikey", "api_key")):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    return found + [(m.start(), 2, m.end()) for m in HEX.finditer(text)]


def guess_spans(text: str, ranks: dict[str, int], least_cost: float, base: list[tuple[int, int, int]]) -> list:
    """Values in a credential's place that cost enough and lie in no base span"""
    low = text.lower()
    if not any(h in low for h in HINTS):
        return []
    found, reached = [], 0
    for m in CONTEXT.finditer(text):
        value = m.group(1).rstrip(".,;:!?)")
        start, end = m.start(1), m.start(1) + len(value)
        # of values that overlap the first that costs enough is kept
        if start >= reached and len(value) >= 6 and not any(a <= start and end <= b for a, _, b in base):
            if guess_cost(value, ranks) >= least_cost:
                found.append((start, 3, end))
                reached = end
    return found


def common_words(docs: DataFrame, size: int = 20_000, least: int = 5) -> list[str]:
    """The ``size`` most frequent words of all documents, ties by the word"""
    words = F.explode(F.split(F.lower("text"), "[^a-z]+")).alias("word")
    counted = docs.select(words).filter(F.length("word").between(3, LONGEST_WORD)).groupBy("word").count()
    top = counted.filter(F.col("count") >= least).orderBy(F.desc("count"), "word").limit(size)
    return [r["word"] for r in top.collect()]


def scan(docs: DataFrame, words: list[str] | None = None, least_cost: float = 9.0) -> DataFrame:
    """Add ``spans``: array of (kind, start, end) in code points, end exclusive, by start, then kind.

    ``words`` ranks the dictionary of the guess costs; by default it is counted from the documents.
    """
    listed = common_words(docs) if words is None else words
    ranks = {w: i + 1 for i, w in enumerate(dict.fromkeys([*COMMON, *listed]))}
    shared = docs.sparkSession.sparkContext.broadcast(ranks)  # as long as the list
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def spans_of(text: str) -> list[dict]:
        base = base_spans(text)
        found = sorted(base + guess_spans(text, shared.value, least_cost, base))
        return [{"kind": KINDS[k], "start": a, "end": b} for a, k, b in found]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = [spans_of(t) if t else [] for t in batch.column("text").to_pylist()]
            yield with_column(batch, "spans", pa.array(found, kind))

    rest = [f"`{c}` {t}" for c, t in docs.dtypes if c != "spans"]
    return docs.mapInArrow(run, ", ".join([*rest, "spans array<struct<kind:string,start:bigint,end:bigint>>"]))


def spans_text(spans, kinds: tuple[str, ...] = KINDS):
    """kind:start:end of the spans of these kinds, comma-joined"""
    chosen = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
