"""Byte-level BPE on one worker: ranked merges over the bytes of distinct words, and the way back.

``bpe_fold`` has the same results with the merges as a fold in Spark.

A text is cut at spaces that follow a non-space. No match of the splitting
pattern crosses such a place, so each cut-out stretch is encoded once per
worker, and each distinct word in it once. The cuts of a text with other runs
of white space are made by the pattern itself.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerline.llm.common import ship, whole_text
from ledgerline.llm.letters import Splitter, spelled

#: Words of more bytes are merged through a heap.
LONG_WORD = 64
#: Entries a worker remembers before it sets them aside; bounds its memory.
REMEMBERED = 100_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks from lines of base64 token and number."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merge_word(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one word: fold the lowest-ranked neighbouring pair, leftmost first, till none is left."""
    whole = ranks.get(word)
    if whole is not None:
        return [whole]
    if len(word) > LONG_WORD:
        return _merge_long(word, ranks)
    pieces = [word[i : i + 1] for i in range(len(word))]
    none = len(ranks) + 1
    pairs = [ranks.get(word[i : i + 2], none) for i in range(len(word) - 1)]
    while pairs:
        lowest = min(pairs)
        if lowest == none:
            break
        i = pairs.index(lowest)
        pieces[i : i + 2] = [pieces[i] + pieces[i + 1]]
        del pairs[i]
        if i < len(pairs):
            pairs[i] = ranks.get(pieces[i] + pieces[i + 1], none)
        if i:
            pairs[i - 1] = ranks.get(pieces[i - 1] + pieces[i], none)
    return [ranks[piece] for piece in pieces]


def _merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges with the pairs in a heap: n log n for a word of n bytes.

    A piece is known by its first byte. A pair of the heap holds while its
    first piece is there and the two still end where they did.
    """
    size = len(word)
    end, before, there = list(range(1, size + 1)), list(range(-1, size)), [True] * size
    pairs = [(rank, i, i + 2) for i in range(size - 1) if (rank := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(pairs)
    while pairs:
        _, i, stop = heapq.heappop(pairs)
        follower = end[i]
        if not there[i] or follower >= stop or end[follower] != stop:
            continue
        there[follower], end[i] = False, stop
        before[stop] = i
        for first in (before[i], i):
            if first >= 0 and end[first] < size:
                last = end[end[first]]
                if (rank := ranks.get(word[first:last])) is not None:
                    heapq.heappush(pairs, (rank, first, last))
    return [ranks[word[i : end[i]]] for i in range(size) if there[i]]


def cut(text: str) -> list[str]:
    """The stretches of a text that are split on their own."""
    if not text:
        return []
    parts = text.split(" ")
    if any(not part or part.isspace() for part in parts):
        return [text]
    return [parts[0], *[" " + part for part in parts[1:]]]


class ByteBpe:
    """Encoder and decoder with a bounded memory of stretches and words.

    ``every`` is the pattern ``spelled``, given where that is known already.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str, every: str | None = None):
        self.ranks = ranks
        self.pieces = {rank: piece for piece, rank in ranks.items()}
        self.split = Splitter(pattern, every or spelled(pattern))
        self.words: dict[str, tuple[int, ...]] = {}
        # Words set aside come back when used again; the others go next time.
        self.older_words: dict[str, tuple[int, ...]] = {}
        self.stretches: dict[str, tuple[bytes, int, bytes]] = {}
        self.older_stretches: dict[str, tuple[bytes, int, bytes]] = {}

    def word(self, word: str) -> tuple[int, ...]:
        ids = self.words.get(word)
        if ids is None:
            ids = self.older_words.get(word) or tuple(merge_word(word.encode(), self.ranks))
            if len(self.words) >= REMEMBERED:
                self.older_words, self.words = self.words, {}
            if len(word) <= LONG_WORD:
                self.words[word] = ids
        return ids

    def decode(self, ids) -> bytes:
        return b"".join([self.pieces[i] for i in ids])

    def stretch(self, text: str) -> tuple[bytes, int, bytes]:
        """Decimal ids joined by commas, their number, and their bytes decoded."""
        known = self.stretches.get(text)
        if known is None and (known := self.older_stretches.get(text)) is not None:
            self.stretches[text] = known
        if known is None:
            if len(self.stretches) >= REMEMBERED:
                self.older_stretches, self.stretches = self.stretches, {}
            ids = [i for word in self.split(text) for i in self.word(word)]
            known = (b"%b," % ",".join(map(str, ids)).encode(), len(ids), self.decode(ids))
            if len(text) <= LONG_WORD:
                self.stretches[text] = known
        return known

    def encode(self, text: str) -> tuple[bytes, int, bytes]:
        found = [self.stretch(part) for part in cut(text)]
        return (
            b"".join([x[0] for x in found])[:-1], sum([x[1] for x in found]), b"".join([x[2] for x in found])
        )

    def ids(self, text: str) -> list[int]:
        joined = self.encode(text)[0]
        return [int(i) for i in joined.split(b",")] if joined else []


_coders: dict[str, ByteBpe] = {}


def coder_of(key: str, ranks: dict[bytes, int], pattern: str, every: str) -> ByteBpe:
    """The worker's coder for these ranks; later tasks use what it remembers."""
    if key not in _coders:
        _coders.clear()
        _coders[key] = ByteBpe(ranks, pattern, every)
    return _coders[key]


def _coding(docs: DataFrame, ranks_path: str, pattern: str):
    ship(docs.sparkSession)
    ranks, every = read_ranks(ranks_path), spelled(pattern)
    key = hashlib.sha256(repr((sorted(ranks.items()), pattern)).encode()).hexdigest()
    shared = docs.sparkSession.sparkContext.broadcast(ranks)  # as large as the vocabulary
    return lambda: coder_of(key, shared.value, pattern, every)


def encode_texts(
    docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: id and ``token_ids``. NULL text is empty and has no ids."""
    coder = _coding(docs, ranks_path, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder()
        for batch in batches:
            ids = [own.ids(text) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ids, pa.list_(pa.int32()))], [id_col, "token_ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, whole_text(text_col)).mapInArrow(run, f"`{id_col}` {kind}, token_ids array<int>")


def decode_ids(encoded: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id") -> DataFrame:
    """One row per input row: id and ``content``, the pieces of ``token_ids`` put together."""
    coder = _coding(encoded, ranks_path, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder()
        for batch in batches:
            content = [own.decode(ids or ()) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(content, pa.binary())], [id_col, "content"])

    kind = encoded.schema[id_col].dataType.simpleString()
    return encoded.select(id_col, "token_ids").mapInArrow(run, f"`{id_col}` {kind}, content binary")


def coding_digests(
    docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Encode and decode every whole text and return digests instead of the ids.

    One row per input row: id, ``n_tokens``, ``ids_sha256`` (of the decimal ids
    joined by commas) and ``decoded_sha256`` (of the decoded bytes). NULL text
    is empty; repeated rows repeat; no rows in, no rows out. One narrow pass.
    """
    coder = _coding(docs, ranks_path, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder()
        for batch in batches:
            counts, ids, decoded = [], [], []
            for text in batch.column(1):
                joined, count, content = own.encode(text.as_py())
                counts.append(count)
                ids.append(hashlib.sha256(joined).hexdigest())
                decoded.append(hashlib.sha256(content).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids, pa.string()),
                 pa.array(decoded, pa.string())],
                [id_col, "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, whole_text(text_col)).mapInArrow(
        run, f"`{id_col}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
