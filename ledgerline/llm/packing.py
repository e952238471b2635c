"""Hierarchical packing of documents into training windows of several lengths."""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F, types as T
from tokenizers import Tokenizer

from ledgerline.llm.common import ship, stored, whole_text
from ledgerline.llm.letters import FIRST_UNASSIGNED, WHITE_SPACE

WINDOW = 4096
#: Context sizes, longest first; each halves the one before.
TIERS = (4096, 2048, 1024, 512)
END_ID = 2
#: Parts that a cut should not fall below, in ids.
SHORT_PART = 64
#: Windows packed by one task call.
GROUP_WINDOWS = 256
#: Sequences of one training step.
STEP_SEQUENCES = 64
#: Entries a worker remembers before it sets them aside; bounds its memory.
REMEMBERED = 200_000
#: The splitting pattern of the word-end vocabulary on lower-cased text: in ASCII, and before any unassigned code point.
_QUOTED = "'s|'t|'re|'ve|'m|'ll|'d|"
ASCII_WORDS = re.compile(_QUOTED + "[a-z]+|[0-9]|[^a-z0-9]+")
EARLY_WORDS = regex.compile(_QUOTED + r"[\p{L}]+|[\p{N}]|[^\p{L}\p{N}]+")
_SPACE = re.compile(f"[{WHITE_SPACE}]+")
_SEPARATORS = re.compile("[\x1c-\x1f]")


def _byte_letters() -> dict[int, str]:
    """Byte-level vocabularies write a byte that is not printable as a letter above 255."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordIds:
    """Ids of texts as little-endian 32-bit bytes, with a bounded memory.

    White space only separates, so each stretch between white space is encoded
    once, and each distinct word in it once, by the tokenizer's own model.
    Stretches that go beyond ``FIRST_UNASSIGNED`` are lower-cased and split by the tokenizer's own
    normalizer and splitter, whose Unicode tables may differ from Python's.
    ``encode`` takes plain text, ``encode_raw`` also finds the added tokens.
    """

    def __init__(self, definition: bytes):
        self.added: dict[str, bytes] = {}
        for token in json.loads(definition).get("added_tokens", ()):
            if any(token[flag] for flag in ("single_word", "lstrip", "rstrip", "normalized")):
                raise ValueError(f"added token {token['content']!r} is not matched literally")
            self.added[token["content"]] = token["id"].to_bytes(4, "little")
        literals = sorted(self.added, key=len, reverse=True)  # at one place the longest counts
        self.cut = re.compile("(" + "|".join(map(re.escape, literals)) + ")") if literals else None
        self.tokenizer = Tokenizer.from_buffer(definition)
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.of_word: dict[str, bytes] = {}
        self.of_stretch: dict[str, bytes] = {}
        # Entries set aside come back when used again; the others go next time.
        self.older_words: dict[str, bytes] = {}
        self.older_stretches: dict[str, bytes] = {}

    def _word(self, word: str) -> bytes:
        ids = self.of_word.get(word)
        if ids is None and (ids := self.older_words.get(word)) is not None:
            self.of_word[word] = ids
        if ids is None:
            mapped = word.translate(self.letters) if word.isascii() else word.encode().decode("latin-1").translate(self.letters)
            ids = b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(mapped)])
            if len(self.of_word) >= REMEMBERED:
                self.older_words, self.of_word = self.of_word, {}
            if len(word) <= 64:
                self.of_word[word] = ids
        return ids

    def _stretch(self, stretch: str) -> bytes:
        if (ids := self.older_stretches.get(stretch)) is not None:
            self.of_stretch[stretch] = ids
            return ids
        if stretch.isascii():
            ids = b"".join([self._word(word) for word in ASCII_WORDS.findall(stretch.lower())])
        elif max(stretch) < FIRST_UNASSIGNED:
            lower = unicodedata.normalize("NFC", stretch).lower()
            ids = b"".join([self._word(word) for word in EARLY_WORDS.findall(lower)])
        else:
            lower = self.tokenizer.normalizer.normalize_str(stretch)
            words = self.tokenizer.pre_tokenizer.pre_tokenize_str(lower)
            ids = b"".join([t.id.to_bytes(4, "little") for word, _ in words for t in self.model.tokenize(word)])
        if len(self.of_stretch) >= REMEMBERED:
            self.older_stretches, self.of_stretch = self.of_stretch, {}
        if len(stretch) <= 64:
            self.of_stretch[stretch] = ids
        return ids

    def encode(self, text: str) -> bytes:
        parts = text.split() if not _SEPARATORS.search(text) else _SPACE.split(text)
        return b"".join([x if (x := self.of_stretch.get(p)) is not None else self._stretch(p) for p in parts])

    def encode_raw(self, text: str) -> bytes:
        """As the tokenizer does by default: added tokens written out in the raw text are their own ids."""
        if self.cut is None or not any(literal in text for literal in self.added):
            return self.encode(text)
        parts = self.cut.split(text)
        return b"".join([self.added[p] if k % 2 else self.encode(p) for k, p in enumerate(parts)])


_encoders: dict[str, WordIds] = {}


def encoder_of(definition: bytes) -> WordIds:
    """The worker's encoder; later tasks use what it remembers."""
    key = hashlib.sha256(definition).hexdigest()
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = WordIds(definition)
    return _encoders[key]


def cut_lengths(total: int, window: int = WINDOW, tiers=TIERS) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces.

    A document that fits the window is one piece. A longer one fills windows,
    and its rest is cut into the context sizes that it holds, longest first, so
    that the parts fill windows of the shorter tiers exactly.
    """
    if total <= window:
        return [(0, total)]
    pieces = [(start, window) for start in range(0, total - window + 1, window)]
    at = window * len(pieces)
    for size in sorted((t for t in tiers if t < window), reverse=True):
        if total - at >= size:
            pieces.append((at, size))
            at += size
    return pieces + [(at, total - at)] * (at < total)


def to_planes(ids: bytes) -> bytes:
    """First bytes of all ids, then second ones and so on; the upper ones compress to nothing."""
    return ids[0::4] + ids[1::4] + ids[2::4] + ids[3::4]


def from_planes(planes: bytes, start: int, length: int) -> bytes:
    """Ids from ``start`` on."""
    count, ids = len(planes) // 4, bytearray(4 * length)
    for k in range(4):
        ids[k::4] = planes[k * count + start : k * count + start + length]
    return bytes(ids)


def tokenize_pieces(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
    window: int = WINDOW, end_id: int = END_ID, with_ids: bool = False, tiers=TIERS, with_planes: bool = False,
) -> DataFrame:
    """Ids of every whole text plus ``end_id``, cut into pieces.

    Columns: id, ``start``, ``length``,
    ``ids_crc32``, ``doc_tokens`` and, on request, ``ids`` and ``_planes``, the
    ids as ``to_planes`` writes them. Documents that fit a
    window stay whole; the others are cut by ``cut_lengths``.
    """
    spark = docs.sparkSession
    ship(spark)
    with open(tokenizer_path, "rb") as file:
        shared = spark.sparkContext.broadcast(file.read())  # as large as the vocabulary
    end = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(shared.value)
        for batch in batches:
            rows, starts, lengths, sums, totals, pieces, planes = [], [], [], [], [], [], []
            for row, text in enumerate(batch.column(1)):
                ids = encoder.encode_raw(text.as_py()) + end
                total = len(ids) // 4
                for start, length in cut_lengths(total, window, tiers):
                    piece = ids[4 * start : 4 * (start + length)]
                    rows.append(row)
                    starts.append(start)
                    lengths.append(len(piece) // 4)
                    sums.append(zlib.crc32(piece))
                    totals.append(total)
                    if with_ids:
                        pieces.append(pa.array(memoryview(piece).cast("I").tolist(), pa.int32()))
                    if with_planes:
                        planes.append(to_planes(piece))
            taken = batch.column(0).take(pa.array(rows, pa.int64()))
            columns = [taken, *[pa.array(x, pa.int64()) for x in (starts, lengths, sums, totals)]]
            if with_ids:
                columns.append(pa.array([p.to_pylist() for p in pieces], pa.list_(pa.int32())))
            if with_planes:
                columns.append(pa.array(planes, pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names)

    names = [id_col, "start", "length", "ids_crc32", "doc_tokens", *["ids"] * with_ids, *["_planes"] * with_planes]
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
    schema += ", ids array<int>" * with_ids + ", _planes binary" * with_planes
    return docs.select(id_col, whole_text(text_col)).mapInArrow(run, schema)


def tier_of(length: int, tiers=TIERS) -> int:
    """The shortest context size that holds the piece."""
    return min((t for t in tiers if t >= length), default=tiers[0])


class Part(NamedTuple):
    """``length`` ids of a piece from ``start`` on, in a window of ``tier`` ids of a sequence."""

    piece: int
    start: int
    length: int
    sequence: int
    offset: int
    tier: int


def pack_group(lengths: list[int], window: int = WINDOW, tiers=TIERS) -> list[Part]:
    """Where the pieces of one group go; only the last sequence is partly empty.

    Tiers are packed longest first, each into windows of its own size: the
    longest piece left opens a window of its tier, and pieces of the shorter
    tiers fill the gap, longest first. Where the gap would be padded or left
    all but full, a piece longer than it is cut: the shortest that leaves
    ``SHORT_PART`` ids, so that long ones stay whole, or else the longest. The
    rest joins the tier of its own length. Sizes of windows halve and never
    grow, so they tile the sequences.
    """
    tiers = (window, *[t for t in sorted(tiers, reverse=True) if t < window and window % t == 0])
    waiting: dict[int, list[tuple[int, int]]] = {}  # length -> (piece, start)
    for i in reversed(range(len(lengths))):
        waiting.setdefault(lengths[i], []).append((i, 0))
    sizes = sorted(waiting)
    parts: list[Part] = []
    at = room = tier = 0
    while sizes:
        if not room:
            room = tier = tier_of(sizes[-1], tiers)
        fit = bisect_right(sizes, room) - 1
        left = room - sizes[fit] if fit >= 0 else room
        whole = fit == len(sizes) - 1 or fit >= 0 and (
            left == 0 or left >= SHORT_PART or len(waiting.get(left, ())) > (left == sizes[fit]))
        chosen = fit if whole else min(bisect_left(sizes, room + SHORT_PART), len(sizes) - 1)
        size = sizes[chosen]
        piece, start = waiting[size].pop()
        if not waiting[size]:
            del waiting[size], sizes[chosen]
        length = min(size, room)
        parts.append(Part(piece, start, length, at // window, at % window, tier))
        if size > length:
            if size - length not in waiting:
                waiting[size - length] = []
                insort(sizes, size - length)
            waiting[size - length].append((piece, start + length))
        at += length
        room -= length
    return parts


def balanced_steps(tokens: list[int], per_step: int = STEP_SEQUENCES) -> list[int]:
    """Step of each sequence: steps get equally many sequences (one less for some) and even token sums."""
    steps = -(-len(tokens) // per_step)
    room = [per_step] * steps
    queue = [(0, s) for s in range(steps)]
    step_of = [0] * len(tokens)
    for i in sorted(range(len(tokens)), key=lambda i: (-tokens[i], i)):
        load, s = heapq.heappop(queue)
        step_of[i] = s
        room[s] -= 1
        if room[s]:
            heapq.heappush(queue, (load + tokens[i], s))
    return step_of


def pack_pieces(
    pieces: DataFrame, window: int = WINDOW, group_windows: int = GROUP_WINDOWS, id_col: str = "doc_id"
) -> DataFrame:
    """Cut and place pieces that come with ``_planes``; ``sequence_id``, ``offset``, ``tier`` and ``step_group`` take its place.

    Pieces, which should be a stored table, are dealt into groups of about
    ``group_windows`` windows by a hash of their place in it, whatever document
    or source they come from and however often a row is repeated.
    Full windows are dealt likewise. A group leaves at most one sequence
    partly empty. Ids move with the pieces, as the parts of a cut piece need
    check sums of their own.
    """
    total = pieces.agg(F.sum("length").alias("n")).first()["n"] or 0
    groups = max(1, round(total / (window * group_windows)))
    dealt = pieces.withColumn("_group", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))
    schema = T.StructType([
        *[f for f in dealt.schema.fields if f.name != "_planes"], T.StructField("sequence_id", T.LongType()),
        T.StructField("offset", T.LongType()), T.StructField("tier", T.IntegerType()),
        T.StructField("step_group", T.LongType()),
    ])

    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values([id_col, "start", "ids_crc32", "doc_tokens"], kind="stable")
        lengths, sums, planes = frame["length"].tolist(), frame["ids_crc32"].tolist(), frame["_planes"].tolist()
        parts = pack_group(lengths, window)
        filled = [0] * (parts[-1].sequence + 1)
        for part in parts:
            filled[part.sequence] += part.length
        steps = balanced_steps(filled)
        first = int(frame["_group"].iloc[0]) << 32
        placed = frame.drop(columns="_planes").iloc[[p.piece for p in parts]]
        return placed.assign(
            start=[s + p.start for s, p in zip(placed["start"].tolist(), parts)], length=[p.length for p in parts],
            ids_crc32=[
                sums[p.piece] if p.length == lengths[p.piece]
                else zlib.crc32(from_planes(planes[p.piece], p.start, p.length)) for p in parts],
            sequence_id=[first + p.sequence for p in parts], offset=[p.offset for p in parts],
            tier=[p.tier for p in parts], step_group=[first + steps[p.sequence] for p in parts],
        )

    return dealt.groupBy("_group").applyInPandas(pack, schema).drop("_group")


def pack_documents(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Pack all documents into sequences of at most 4096 ids.

    One row per piece: id, ``start``, ``length``, ``ids_crc32``,
    ``doc_tokens``, ``sequence_id``, ``offset``, ``tier`` (context size of the
    window it lies in) and ``step_group``. NULL and empty texts are one piece
    holding the end id. Repeated rows are packed as often as they come. No
    rows, no pieces. Texts are tokenized once; the ids move with their pieces.
    """
    pieces = stored(tokenize_pieces(docs, tokenizer_path, id_col, text_col, with_planes=True), "pieces")
    return pack_pieces(pieces, id_col=id_col)
