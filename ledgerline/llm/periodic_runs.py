"""Periodic runs of words: Lyndon lengths by grouping, Lyndon roots extended into runs.

Baier's first phase sorts suffixes into groups by their longest Lyndon prefix.
At any time the text is tiled by the prefixes that no neighbour has taken in
yet. The tiles of the greatest group are final; each stretch of them joins the
tile before it, which moves up to a new group just above its own. So every
position learns where its longest Lyndon word ends. Under an order of the
words and under its opposite, each run has a root among these Lyndon words
(Bannai et al.), so extending them by common extensions finds all runs. One
narrow pass; a document takes time and memory after its number of words.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from itertools import groupby
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerline.llm.common import ship, whole_text

#: A run has at least so many words, and at least so many times its period.
LEAST_WORDS = 6
LEAST_POWER = 4


class Run(NamedTuple):
    start: int
    length: int
    period: int


def lyndon_ends(ranks: Sequence[int]) -> list[int]:
    """Where the longest Lyndon word that starts at each position ends (exclusive).

    ``ranks`` are the numbers 0 to k-1, each used; their order is the alphabet's.
    """
    n = len(ranks)
    count = max(ranks, default=-1) + 1
    members: list[list[int]] = [[] for _ in range(count)]
    for i, rank in enumerate(ranks):
        members[rank].append(i)
    below, above = list(range(-1, count - 1)), list(range(1, count + 1))
    group = [*ranks, -1]  # the last entry also serves as the place before the text
    left, right = list(range(-1, n)), list(range(1, n + 1))
    top = count - 1
    while top >= 0:
        moved: dict[tuple[int, int], list[int]] = {}
        for head in members[top]:
            before = left[head]
            if group[head] != top or group[before] == top:
                continue  # moved up since, or taken in with the head of its stretch
            end, copies = right[head], 1
            while group[end] == top:
                end = right[end]
                copies += 1
            left[end] = before
            if before >= 0:
                right[before] = end
                old = group[before]
                if len(members[old]) > 1:
                    moved.setdefault((old, copies), []).append(before)
        # More copies of the greatest word make the greater tile; all lie above the group they leave.
        highest: dict[int, int] = {}
        for old, copies in sorted(moved):
            tiles = moved[old, copies]
            new, under = len(members), highest.get(old, old)
            over = above[under]
            members.append(tiles)
            below.append(under)
            above.append(over)
            above[under] = below[over] = new
            highest[old] = new
            for i in tiles:
                group[i] = new
        top = below[top]
    return right


def _agreement(words: Sequence[int], a: int, b: int) -> int:
    """How many words from ``a`` and from ``b`` (later) on agree: slices that double, then halve."""
    step, found, room = 1, 0, len(words) - b
    while step:
        if found + step <= room and words[a + found : a + found + step] == words[b + found : b + found + step]:
            found += step
            step *= 2
        else:
            step //= 2
            while step and found + step > room:
                step //= 2
    return found


def _agreement_before(words: Sequence[int], a: int, b: int) -> int:
    """How many words before ``a`` and before ``b`` (later) agree."""
    step, found = 1, 0
    while step:
        if found + step <= a and words[a - found - step : a - found] == words[b - found - step : b - found]:
            found += step
            step *= 2
        else:
            step //= 2
            while step and found + step > a:
                step //= 2
    return found


def _stretches(words: Sequence, least_words: int, least_power: int) -> Iterator[tuple[int, list[int]]]:
    """Starts of the stretches that may hold runs, and their words numbered from 0.

    A run holds each of its words at least ``least_power`` times, so rarer words end a stretch.
    """
    often = {w for w, n in Counter(words).items() if n >= least_power}
    at = 0
    for usual, part in groupby(words, often.__contains__):
        part = list(part)
        if usual and len(part) >= least_words:
            number: dict = {}
            yield at, [number.setdefault(w, len(number)) for w in part]
        at += len(part)


def _runs_of_stretch(words: list[int], least_words: int, least_power: int) -> set[Run]:
    last = max(words)
    ends_with = [*words, -1]
    found = set()
    for ranks in (words, [last - w for w in words]):
        reached: dict[int, int] = {}
        for start, end in enumerate(lyndon_ends(ranks)):
            # A run of two or more periods goes on after its first root.
            if ends_with[end] == ends_with[start] and reached.get(end - start, 0) <= end:
                period = end - start
                stop = end + _agreement(words, start, end)
                reached[period] = stop
                first = start - _agreement_before(words, start, end)
                if stop - first >= max(least_words, least_power * period):
                    found.add(Run(first, stop - first, period))
    return found


def find_runs(words: Sequence, least_words: int = LEAST_WORDS, least_power: int = LEAST_POWER) -> list[Run]:
    """Maximal stretches with smallest period p, at least ``least_words`` and ``least_power * p`` long.

    ``least_power`` is 2 or more. Sorted by start, then period.
    """
    found = [
        run._replace(start=at + run.start)
        for at, part in _stretches(words, least_words, least_power)
        for run in _runs_of_stretch(part, least_words, least_power)
    ]
    return sorted(found, key=lambda run: (run.start, run.period))


def kept_words(count: int, runs: Sequence[Run]) -> list[tuple[int, int]]:
    """Spans of word numbers that stay when each run is cut to its first period."""
    spans, at = [], 0
    for start, stop in sorted((r.start + r.period, r.start + r.length) for r in runs):
        if start > at:
            spans.append((at, start))
        at = max(at, stop)
    if at < count:
        spans.append((at, count))
    return spans


def repeat_tail(words: list[bytes], key: int) -> list[bytes]:
    """The words with a periodic tail in one of ten documents, chosen by the check sum of the key.

    The tail's start and period follow from the same check sum.
    """
    h = zlib.crc32(str(key).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    start = g % n
    period = 1 + (n - start) // (3 + g % 8)
    unit = words[start : start + period]
    return words[:start] + (unit * ((n - start) // period + 1))[: n - start]


def run_digests(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_words: int = LEAST_WORDS,
    least_power: int = LEAST_POWER, prepare: Callable[[list[bytes], object], list[bytes]] | None = None,
) -> DataFrame:
    """Runs of every whole text and the text with each run cut to its first period.

    One row per input row: id, ``n_runs``, ``runs`` (all, by start, then period),
    ``collapsed`` (kept words joined by one space), and of the longest run (ties:
    smallest start, then period) ``start``, ``length``, ``period`` and
    ``exponent_milli``, NULL without a run; ``runs_sha256`` (of the lines
    ``start,length,period``) and ``collapsed_sha256``. Words are split at ASCII
    white space. ``prepare(words, id)`` may change the words first; it is not
    asked for rows with a NULL id. NULL text is empty; an empty text has no run and digests of
    nothing; repeated rows repeat; no rows in, no rows out; columns beyond id
    and text are not read, so their names cannot clash.
    """
    ship(docs.sparkSession)

    def judged(key, text: bytes) -> tuple:
        words = text.split()
        if prepare is not None and key is not None:
            words = prepare(words, key)
        runs = find_runs(words, least_words, least_power)
        kept = b" ".join([w for a, b in kept_words(len(words), runs) for w in words[a:b]] if runs else words)
        lines = "".join(f"{r.start},{r.length},{r.period}\n" for r in runs)
        best = max(runs, key=lambda r: (r.length, -r.start, -r.period), default=None)
        top = (*best, 1000 * best.length // best.period) if best else (None,) * 4
        return (
            len(runs), *top, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest(),
            [r._asdict() for r in runs], kept,
        )

    kind = docs.schema[id_col].dataType.simpleString()
    names = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256", "runs", "collapsed"]
    triple = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    types = [*[pa.int64()] * 5, *[pa.string()] * 2, pa.list_(triple), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            rows = [judged(k.as_py(), t.as_py()) for k, t in zip(batch.column(0), texts)]
            columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate(types[:-1])]
            columns.append(pa.array([r[-1] for r in rows], pa.binary()).cast(pa.string()))
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], [id_col, *names])

    return docs.select(id_col, whole_text(text_col)).mapInArrow(
        run,
        f"`{id_col}` {kind}, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint,"
        " runs_sha256 string, collapsed_sha256 string,"
        " runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string")
