"""Secrets in texts: fixed patterns, and credential values that are costly to guess.

The cost of a value is that of its cheapest segmentation into known words,
dates, repeats, keyboard walks and brute-force spans, found by dynamic
programming over its characters. Costs are decimal logarithms of guesses.
"""

from __future__ import annotations

import hashlib
import math
import re
from array import array
from bisect import bisect_left
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from ledgerline.llm.common import discard, ship, stored, whole_text

#: Guesses (log10) from which a credential value counts as a secret.
MIN_GUESSES = 8.0
#: log10 of the choice where the next segment begins and of which kind it is.
SEGMENT = math.log10(20)

# The base patterns and their least lengths.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ASSIGN_KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN_LENGTH = 12
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
KINDS = ("assign", "access", "hex", "guess")

#: Where credential values stand: a keyword, a sign or a verb, and the value.
CONTEXT = re.compile(
    r"""(?:password|passwd|passphrase|pwd|secret|token|api_?key|credential|access_?key)["']?"""
    r"""(?:\x20*[:=]\x20*|\x20+is:?\x20+)["']?([^\s"'<>,;]+)""",
    re.IGNORECASE | re.ASCII,
)
CONTEXT_KEYWORDS = (
    "password", "passwd", "passphrase", "pwd", "secret", "token", "apikey", "api_key",
    "credential", "accesskey", "access_key",
)

#: The same as Spark reads it, with what comes before the value as a group.
_CONTEXT_JAVA = "(?i)({}){}".format(*CONTEXT.pattern[:-1].rsplit("(", 1))

#: Words that a guesser tries first; those of the documents come by their count.
COMMON_WORDS = (
    "password", "admin", "letmein", "welcome", "login", "user", "root", "test", "guest", "secret",
    "master", "dragon", "monkey", "sunshine", "princess", "football", "shadow", "hello", "love",
    "hunter", "summer", "winter", "spring", "autumn", "change", "changeme", "default", "example",
    "token", "key", "pass", "word", "name", "server", "system", "data", "base", "house", "blue",
    "green", "black", "white", "orange", "tiger", "silver", "golden", "super", "magic", "happy",
    "the", "and", "for", "you", "are", "not", "this", "that", "with", "your", "from", "have",
    "placeholder", "insert", "here", "replace", "value", "string", "none", "null", "true", "false",
    "correct", "horse", "battery", "staple", "computer", "internet", "service", "private", "public",
)
KEYBOARD = ("qwertyuiop", "asdfghjkl", "zxcvbnm", "1234567890", "abcdefghijklmnopqrstuvwxyz")
NEIGHBOURS = {pair for row in KEYBOARD for a, b in zip(row, row[1:]) for pair in (a + b, b + a)}
LOOKALIKES = str.maketrans("4@301!57$", "aaeoiists")


class Segment(NamedTuple):
    start: int
    end: int
    kind: str
    cost: float


class WordRanks:
    """Ranks of words by 64-bit hash in sorted arrays, 12 bytes a word, and of a few words by name."""

    def __init__(self, first: dict[str, int], hashes: np.ndarray, ranks: np.ndarray, lengths: Sequence[int]):
        self.first = first
        order = np.argsort(hashes)
        self.hashes = array("q", hashes[order].astype(np.int64).tobytes())
        self.ranks = array("I", ranks[order].astype(np.uint32).tobytes())
        self.lengths = sorted({len(w) for w in first}.union(lengths))

    def get(self, word: str) -> int | None:
        rank, key = self.first.get(word), _hash(word)
        at = bisect_left(self.hashes, key)
        if at < len(self.hashes) and self.hashes[at] == key:
            return self.ranks[at] if rank is None else min(rank, self.ranks[at])
        return rank


def _hash(word: str) -> int:
    """As Spark's ``xxhash64`` has it."""
    value = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"), seed=42)
    return value - (1 << 64) if value >> 63 else value


def _walk_ends(text: str) -> list[int]:
    """For each position, where the keyboard walk or sequence beginning there ends."""
    ends = list(range(1, len(text) + 1))
    for i in range(len(text) - 2, -1, -1):
        if text[i : i + 2] in NEIGHBOURS:
            ends[i] = ends[i + 1]
    return ends


_MONTH, _DAY = "(?:0[1-9]|1[0-2])", r"(?:0[1-9]|[12]\d|3[01])"
_DATES = [re.compile(form) for form in (
    rf"(?:19|20)\d\d[-/._]?{_MONTH}[-/._]?{_DAY}", rf"{_DAY}[-/._]?{_MONTH}[-/._]?(?:19|20)\d\d", r"(?:19|20)\d\d",
)]


def _alphabet(text: str) -> float:
    """log10 of the number of characters a brute-force guesser tries."""
    size = 26 * bool(re.search("[a-z]", text)) + 26 * bool(re.search("[A-Z]", text))
    size += 10 * bool(re.search("[0-9]", text)) + 33 * bool(re.search("[^a-zA-Z0-9]", text))
    return math.log10(max(size, 2))


def cheapest_segments(
    value: str, words: dict[str, int] | WordRanks, least: float = math.inf
) -> tuple[float, list[Segment]]:
    """The least log10 of guesses for a value, and the segments that give it.

    Every brute-force character costs the same, so a brute-force span is grown
    character by character; every other segment, and a brute-force span after
    one, also pays ``SEGMENT``. All words, dates, repeats and walks at each
    place are offered, but for those that a longer or simpler one undercuts. Prefixes that
    cost ``least`` go no further; where all do, the answer is (inf, []).
    """
    n = len(value)
    lower = value.lower()
    lower = lower if len(lower) == n else value
    plain = lower.translate(LOOKALIKES)
    per_character = _alphabet(value)
    walks = _walk_ends(lower)
    lengths = words.lengths if isinstance(words, WordRanks) else sorted({len(w) for w in words})
    runs: dict[int, tuple[int, int]] = {}  # unit -> the last run of that period
    # A prefix ends in a brute-force span or in another segment; its next brute-force character costs accordingly.
    brute, other = [math.inf] * (n + 1), [math.inf] * (n + 1)
    via: list[Segment | None] = [None] * (n + 1)  # what gave other
    run_of: list[tuple | None] = [None] * (n + 1)  # the run that a repeat or walk in via lies in
    other[0] = 0.0

    def offer(start, end, kind, cost, run=None):
        total = best + cost
        if total < other[end] and total < least:
            other[end], via[end], run_of[end] = total, Segment(start, end, kind, cost), run

    def run_end(i, unit):
        start, end = runs.get(unit, (0, 0))
        if not start <= i <= end - 2 * unit:
            at = i
            while at + unit < n and value[at] == value[at + unit]:
                at += 1
            end = at + unit
            runs[unit] = (i, end)
        return end

    for i in range(n):
        best = min(brute[i], other[i])
        if best >= least:
            continue
        one = per_character + min(brute[i], other[i] + (SEGMENT if i else 0.0))
        if one < least:
            brute[i + 1] = one
        # Going on with a run costs less than beginning it anew.
        within = run_of[i] if other[i] <= brute[i] else None
        for size in lengths:
            j = i + size
            if j > n:
                break
            rank = words.get(lower[i:j])
            cost = math.inf if rank is None else math.log10(rank + 1)
            if plain[i:j] != lower[i:j] and (swapped := words.get(plain[i:j])) is not None:
                cost = min(cost, math.log10(swapped + 1) + math.log10(4))
            if cost < math.inf:
                offer(i, j, "word", cost + math.log10(2) * (value[i:j] != lower[i:j]) + SEGMENT)
        if value[i] in "0123":
            for match in filter(None, (form.match(value, i) for form in _DATES)):
                guesses = 365 * 120 * 4 if match.end() - i > 4 else 120
                offer(i, match.end(), "date", math.log10(guesses) + SEGMENT)
        for unit in range(1, (n - i) // 2 + 1):
            fixed = unit * per_character + SEGMENT
            if best + fixed >= least:
                break
            part = value[i : i + unit]
            if value[i + unit : i + 2 * unit] != part or part in (part + part)[1:-1]:
                continue  # no repeat, or one of a shorter unit
            end = run_end(i, unit)
            if within != (unit, end):
                for copies in range(2, (end - i) // unit + 1):
                    offer(i, i + copies * unit, "repeat", fixed + math.log10(copies), (unit, end))
        if within != ("walk", walks[i]):
            for j in range(i + 3, walks[i] + 1):
                offer(i, j, "walk", math.log10(100 * (j - i)) + SEGMENT, ("walk", walks[i]))
    total = min(brute[n], other[n])
    if total == math.inf:
        return total, []
    segments: list[Segment] = []
    at, grown = n, brute[n] < other[n]
    while at:
        if not grown:
            segments.append(via[at])
            at = via[at].start
            grown = brute[at] < other[at]
            continue
        end, cost = at, 0.0
        while grown:
            at -= 1
            opens = SEGMENT if at else 0.0
            grown = brute[at] < other[at] + opens
            cost += per_character + (0.0 if grown else opens)
        segments.append(Segment(at, end, "brute", cost))
    return total, segments[::-1]


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the fixed patterns, by start, then kind as listed."""
    found = []
    lower = text.lower()
    if any(word in lower for word in ASSIGN_KEYWORDS):
        found += [
            ("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LENGTH
        ]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text)]
    found += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0])))


def guess_spans(text: str, words: dict[str, int], least: float = MIN_GUESSES) -> list[tuple[str, int, int]]:
    """Values in a credential context that cost at least ``least`` to guess."""
    lower = text.lower()
    if not any(word in lower for word in CONTEXT_KEYWORDS):
        return []
    found = []
    for match in CONTEXT.finditer(text):
        value = match[1].rstrip(".!?:)")
        if cheapest_segments(value, words, least)[0] >= least:
            found.append(("guess", match.start(1), match.start(1) + len(value)))
    return found


def find_spans(text: str, words: dict[str, int], least: float = MIN_GUESSES) -> list[tuple[str, int, int]]:
    spans = base_spans(text) + guess_spans(text, words, least)
    return sorted(spans, key=lambda x: (x[1], KINDS.index(x[0])))


def word_ranks(words: Sequence[str] = COMMON_WORDS) -> dict[str, int]:
    return {word: rank for rank, word in reversed(list(enumerate(words, 1)))}


def corpus_ranks(
    docs: DataFrame, text_col: str = "text", words: Sequence[str] = COMMON_WORDS, least: float = MIN_GUESSES,
) -> WordRanks:
    """Ranks of all words of the documents by count, and of ``words`` by order; the lower one counts.

    A word is a run of letters, in lower case. Those in credential values are
    not counted, or each secret would be a known word. A word's rank is the
    number of words that come as often or oftener. A word whose own cost
    reaches ``least`` cannot bring a value below it, so only ranks under
    10^(least - SEGMENT) are kept: 5 million by default, 60 MB at most. Words
    are hashed on the executors; hashes, counts and the lengths in use come here, no words.
    """
    prose = F.regexp_replace(whole_text(text_col), _CONTEXT_JAVA, "$1 ")
    parts = docs.select(F.explode(F.split(F.lower(prose), r"[^\p{L}]+")).alias("word"))
    counts = stored(parts.where("word <> ''").groupBy("word").count(), "words")
    totals = sorted((tuple(r) for r in counts.groupBy("count").agg(F.count("*")).collect()), reverse=True)
    of_count, rank = {}, 0
    for times, size in totals:
        rank += size
        if math.log10(rank + 1) + SEGMENT >= least:
            break
        of_count[times] = rank
    known = counts.where(F.col("count") >= F.lit(min(of_count, default=(1 << 63) - 1)))
    lengths = [r[0] for r in known.select(F.length("word")).distinct().collect()]
    kept = known.select(F.xxhash64("word").alias("hash"), "count").toArrow()
    discard(counts)
    times = np.array(sorted(of_count), np.int64)
    ranks = np.array([of_count[t] for t in times.tolist()], np.int64)
    place = np.searchsorted(times, kept["count"].to_numpy())
    return WordRanks(word_ranks(words), kept["hash"].to_numpy(), ranks[place] if len(ranks) else place, lengths)


def scan_secrets(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    words: Sequence[str] = COMMON_WORDS, least: float = MIN_GUESSES,
) -> DataFrame:
    """One row per input row: id and ``secrets``, an array of (kind, start, end).

    Offsets are in code points, the end exclusive; spans go by start, then
    kind. NULL text is empty and has none. Repeated rows repeat; no rows in, no
    rows out. The words of all documents are counted first (``corpus_ranks``,
    ``words`` are those guessed first), then one narrow pass scans the texts.
    """
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(corpus_ranks(docs, text_col, words, least))  # at most 60 MB by default
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = shared.value
        for batch in batches:
            found = [
                [dict(zip(("kind", "start", "end"), s)) for s in find_spans(text.as_py(), ranks, least)]
                for text in batch.column(1)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.list_(span))], [id_col, "secrets"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, whole_text(text_col)).mapInArrow(
        run, f"`{id_col}` {kind}, secrets array<struct<kind:string,start:bigint,end:bigint>>")


def redact(text: str, spans: Sequence[tuple[str, int, int]], mark: str = "<secret>") -> str:
    """The text with each maximal covered run replaced by ``mark``."""
    runs: list[list[int]] = []
    for _, start, end in sorted(spans, key=lambda s: s[1]):
        if runs and start <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], end)
        else:
            runs.append([start, end])
    for start, end in reversed(runs):
        text = text[:start] + mark + text[end:]
    return text


def redact_secrets(
    docs: DataFrame, text_col: str = "text", words: Sequence[str] = COMMON_WORDS,
    least: float = MIN_GUESSES, mark: str = "<secret>",
) -> DataFrame:
    """The same rows and columns with the secrets in the text replaced; NULL stays NULL."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(corpus_ranks(docs, text_col, words, least))  # at most 60 MB by default
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = shared.value
        for batch in batches:
            texts = [
                None if (text := value.as_py()) is None else redact(text, find_spans(text, ranks, least), mark)
                for value in batch.column(place)
            ]
            columns = list(batch.columns)
            columns[place] = pa.array(texts, batch.column(place).type)
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return docs.mapInArrow(run, docs.schema)


def span_columns(secrets: str = "secrets") -> dict:
    """Counts, digest and text forms of the spans of ``scan_secrets``."""
    spans = F.col(secrets)
    base = F.filter(spans, lambda s: s["kind"] != "guess")

    def joined(part):
        return F.array_join(F.transform(part, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind):
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")

    return {**{f"n_{kind}": count(kind) for kind in KINDS}, "base_sha256": F.sha2(joined(base), 256), "spans": joined(spans)}
