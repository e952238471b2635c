"""Ranked merges as a fold of Spark's higher-order functions over the bytes of a word.

The ranks of pairs are literal arrays in the plan, in which the pairs of all
pieces interlock, so that a look-up reads two numbers. Pieces are their ranks
while they are merged. The lowest pair and its place are one minimum, as
``array_position`` leaves its loop by an exception for each merge.

One narrow job does it all: tasks split their texts and number distinct words,
Spark folds the merges of each word new to its task, and the same tasks put
ids and pieces together by number. Nothing is shuffled or stored, so a lost
task is only run again.
"""

from __future__ import annotations

import hashlib
import json
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import from_arrow_type

from ledgerline.llm.byte_bpe import LONG_WORD, cut, merge_word, read_ranks
from ledgerline.llm.common import ship, whole_text
from ledgerline.llm.letters import Splitter, spelled

#: Maps of a literal that holds whole words.
MAPS = 1 << 14
#: Bits of a rank and of a place in a word; an item of the fold takes three times as many.
BITS = 20
#: The character that follows those of all bytes.
EDGE = "\u0100"
#: Words and bytes of words a task numbers before it begins a new dictionary; bounds its memory.
DICTIONARY_WORDS, DICTIONARY_BYTES = 1_000_000, 64 << 20
#: Stretches whose word numbers a task remembers, of texts that are slow to split.
STRETCHES = 200_000
#: Code points of text for which new words are gathered into one row.
GATHERED = 4 << 20


def rank_maps(ranks: dict[bytes, int], maps: int = MAPS) -> Column:
    """The ranks as a literal array of maps; as large as the vocabulary."""
    parts: list[dict[str, int]] = [{} for _ in range(maps)]
    for piece, rank in ranks.items():
        name = piece.hex().upper()
        parts[zlib.crc32(name.encode()) % maps][name] = rank
    return F.from_json(F.lit(json.dumps(parts)), "array<map<string,int>>")


def _with(value: Column, body) -> Column:
    """``body`` of the value, which is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _rank(maps: Column, size: int, piece: Column) -> Column:
    return F.try_element_at(F.get(maps, F.pmod(F.crc32(piece), F.lit(size)).cast("int")), piece)


def pair_cells(ranks: dict[bytes, int]) -> tuple[list[int], list[int]]:
    """Where the pairs of a piece begin, by its rank, and one list of cells that the pairs of all pieces share.

    The pair of pieces l and r that merge to m has ``l << BITS | m`` in cell ``begin[l] + r``. Where l and r do
    not merge, that cell holds a pair of another piece or none; it is never outside the list.
    """
    top = max(ranks.values()) + 2
    if top >= 1 << BITS:
        raise ValueError(f"ranks reach {top - 2}, the fold takes less than {(1 << BITS) - 2}")
    pairs: dict[int, dict[int, int]] = {}
    for piece, rank in ranks.items():
        for i in range(1, len(piece)):
            if piece[:i] in ranks and piece[i:] in ranks:
                pairs.setdefault(ranks[piece[:i]], {})[ranks[piece[i:]]] = rank
    begin, cells = [0] * top, np.full(4 * top, -1)
    least = 0  # where the search for room begins
    for left, row in sorted(pairs.items(), key=lambda pair: -len(pair[1])):
        first, *others = row
        at, step = max(least, first), 256
        while True:
            if len(cells) < at + step + top:
                cells = np.append(cells, np.full(len(cells), -1))
            room = at + np.flatnonzero(cells[at : at + step] < 0) - first
            for right in others:
                room = room[cells[room + right] < 0]
            if len(room):
                break
            at, step = at + step, min(2 * step, 1 << 15)
        if len(row) < 16:
            least = max(least, at - first)
        begin[left] = int(room[0])
        for right, rank in row.items():
            cells[begin[left] + right] = left << BITS | rank
    cells[cells < 0] = (1 << 2 * BITS) - 1
    return begin, cells[: max(begin) + top].tolist()


def unreached(ranks: dict[bytes, int]) -> dict[bytes, int]:
    """Pieces that are one id as a word though no merges of their bytes lead to them."""
    found = {}
    for piece, rank in list(ranks.items()):
        if len(piece) > 1:
            del ranks[piece]
            if len(merge_word(piece, ranks)) != 2:
                found[piece] = rank
            ranks[piece] = rank
    return found


def _fold_word(word: Column, letters: Column, begin: Column, cells: Column) -> Column:
    """Ids of a word: merge the lowest-ranked neighbouring pair, leftmost first, till none is left.

    An item is a piece and, above its ``BITS``, the rank of its pair with the next piece; ``1 << BITS`` or more
    says that they do not merge. An edge, with which nothing merges, stands before the word, two behind it.
    """
    mask = (1 << BITS) - 1

    def item(left: Column, right: Column) -> Column:
        rank = F.get(cells, F.get(begin, left) + right).bitwiseXOR(F.shiftleft(left, BITS))
        return F.shiftleft(rank, BITS).bitwiseOR(left)

    def merged(items: Column, lowest: Column) -> Column:
        place, joined = lowest.bitwiseAND(F.lit(mask)).cast("int"), F.shiftright(lowest, BITS)
        before, after = F.get(items, place - 1).bitwiseAND(F.lit(mask)), F.get(items, place + 2).bitwiseAND(F.lit(mask))
        return F.flatten(F.array(
            F.slice(items, 1, place - 1),
            F.zip_with(F.array(before, joined), F.array(joined, after), item),
            F.slice(items, place + 3, F.size(items)),
        ))

    def step(items: Column, _) -> Column:
        placed = F.transform(items, lambda x, place: x.bitwiseAND(F.lit(~mask)).bitwiseOR(place.cast("long")))
        return F.when(
            F.array_min(items) < 1 << 2 * BITS, F.aggregate(F.array(F.array_min(placed)), items, merged)).otherwise(items)

    text = F.concat(F.lit(EDGE), F.decode(word, "ISO-8859-1"), F.lit(2 * EDGE))
    pieces = F.transform(F.split(text, ""), lambda letter: F.get(letters, F.ascii(letter)))
    return _with(pieces, lambda pieces: F.aggregate(
        F.sequence(F.lit(5), F.size(pieces)),
        F.zip_with(F.slice(pieces, 1, F.size(pieces) - 1), F.slice(pieces, 2, F.size(pieces)), item),
        step,
        lambda items: F.transform(
            F.slice(items, 2, F.size(items) - 2), lambda x: x.bitwiseAND(F.lit(mask)).cast("int")),
    ))


def fold_words(words: Column, ranks: dict[bytes, int], maps: int = MAPS) -> Column:
    """An array of ids for each binary word of an array; an empty word has none.

    Each merge of a word scans the word, so callers keep very long words away.
    """
    def literal(values: list[int]) -> Column:
        return F.from_json(F.lit(json.dumps(values)), "array<bigint>")

    begin, cells = pair_cells(ranks)
    letters = [ranks[bytes([b])] for b in range(256)] + [max(ranks.values()) + 1]
    folded = _with(literal(letters), lambda letters: _with(literal(begin), lambda begin: _with(
        literal(cells), lambda cells: F.transform(words, lambda word: _fold_word(word, letters, begin, cells)))))
    whole = unreached(ranks)
    if not whole:
        return folded
    return _with(rank_maps(whole, maps), lambda table: F.zip_with(words, folded, lambda word, ids: _with(
        _rank(table, maps, F.hex(word)), lambda rank: F.when(rank.isNull(), ids).otherwise(F.array(rank)))))


class WordNumbers:
    """Numbers of the distinct words of a task's texts, and the words not sent on yet.

    Words of more than ``LONG_WORD`` bytes get a new number each time.
    """

    def __init__(self, split: Splitter):
        self.split = split
        self.begin()

    def begin(self) -> None:
        self.numbers: dict[str, int] = {}
        self.stretches: dict[str, bytes] = {}
        self.count = self.weight = 0
        self.first = True
        self.fresh: list[bytes] = []
        self.long: list[bytes] = []

    def number(self, word: str) -> int:
        known = self.numbers.get(word)
        if known is not None:
            return known
        content = word.encode()
        if len(content) > LONG_WORD:
            self.fresh.append(b"")
            self.long.append(content)
        else:
            self.fresh.append(content)
            self.numbers[word] = self.count
        self.count += 1
        self.weight += len(content)
        return self.count - 1

    def stretch(self, part: str) -> bytes:
        found = array("I", map(self.number, self.split(part))).tobytes()
        if len(part) <= LONG_WORD:
            if len(self.stretches) >= STRETCHES:
                self.stretches.clear()
            self.stretches[part] = found
        return found

    def text(self, text: str) -> bytes:
        if self.split.quick(text):
            known = self.numbers.get
            words = self.split(text)
            found = list(map(known, words))
            if None in found:
                found = [self.number(word) if n is None else n for word, n in zip(words, found)]
            return array("I", found).tobytes()
        known = self.stretches.get
        return b"".join([known(part) or self.stretch(part) for part in cut(text)])

    def words(self) -> tuple[bool, list[bytes], list[bytes]]:
        """Whether a dictionary begins, its next words, and the long ones among them (empty there)."""
        sent = self.first, self.fresh, self.long
        self.first, self.fresh, self.long = False, [], []
        return sent

    def full(self) -> bool:
        return self.count >= DICTIONARY_WORDS or self.weight >= DICTIONARY_BYTES


class WordIds:
    """What the numbers of a task stand for: ids, or only decimal ids and their bytes."""

    def __init__(self, ranks: dict[bytes, int], lists: bool = True):
        self.ranks = ranks
        self.lists = lists
        self.pieces = {rank: piece for piece, rank in ranks.items()}
        self.decimals = {rank: b"%d," % rank for rank in self.pieces}
        self.begin()

    def begin(self) -> None:
        self.ids: list[list[int]] = []
        self.joined: list[bytes] = []
        self.content: list[bytes] = []

    def add(self, folded: list[list[int]], long: list[bytes]) -> None:
        rest = iter(long)
        decimal, piece = self.decimals.__getitem__, self.pieces.__getitem__
        for ids in folded:
            ids = ids or merge_word(next(rest), self.ranks)
            if self.lists:
                self.ids.append(ids)
            self.joined.append(b"".join(map(decimal, ids)))
            self.content.append(b"".join(map(piece, ids)))


def _lists(folded: pa.ListScalar) -> list[list[int]]:
    """The ids of each word; NULL has none. Much faster than ``as_py``."""
    if not folded.is_valid:
        return []
    words = folded.values
    ends = words.offsets.to_pylist()
    ids = words.values.slice(ends[0], ends[-1] - ends[0]).to_numpy().tolist()
    return [ids[a - ends[0] : b - ends[0]] for a, b in zip(ends, ends[1:])]


def _numbered(docs: DataFrame, pattern: str, id_col: str, text_col: str) -> DataFrame:
    """Rows of word numbers, each after rows with the words that are new; those have no ``numbers``."""
    every = spelled(pattern)
    kind = docs.schema[id_col].dataType
    names = ["id", "first", "fresh", "long", "numbers"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordNumbers(Splitter(pattern, every))

        def gathered(ids: list, numbers: list[bytes], of: pa.DataType) -> pa.RecordBatch:
            first, fresh, long = known.words()
            none = [None] * len(ids)
            columns = [
                pa.array([None, *ids], of), pa.array([first, *none], pa.bool_()),
                pa.array([fresh, *none], pa.list_(pa.binary())), pa.array([long, *none], pa.list_(pa.binary())),
                pa.array([None, *numbers], pa.binary()),
            ]
            if known.full():
                known.begin()
            return pa.RecordBatch.from_arrays(columns, names)

        for batch in batches:
            of, ids, numbers, size = batch.column(0).type, [], [], 0
            for key, text in zip(batch.column(0), batch.column(1)):
                text = text.as_py()
                ids.append(key.as_py())
                numbers.append(known.text(text))
                size += len(text)
                if size >= GATHERED or known.full():
                    yield gathered(ids, numbers, of)
                    ids, numbers, size = [], [], 0
            if ids:
                yield gathered(ids, numbers, of)

    return docs.select(F.col(id_col).alias("id"), whole_text(text_col)).mapInArrow(
        run, f"id {kind.simpleString()}, first boolean, fresh array<binary>, long array<binary>, numbers binary")


def fewer_tasks(docs: DataFrame) -> DataFrame:
    """The rows in a quarter of the partitions, but at least two a core: a task folds each of its words once.

    For tables as read; what comes from a shuffle would be shuffled for the count.
    """
    tasks = 2 * docs.sparkSession.sparkContext.defaultParallelism
    return docs.coalesce(max(tasks, docs.rdd.getNumPartitions() // 4))


def _coded(docs: DataFrame, ranks_path: str, pattern: str, id_col: str, text_col: str, kinds: dict, put) -> DataFrame:
    """``put`` of the words and the numbers of each text, as the columns ``kinds`` after the id."""
    spark = docs.sparkSession
    ship(spark)
    ranks = read_ranks(ranks_path)
    shared = spark.sparkContext.broadcast(ranks)  # as large as the vocabulary
    numbered = _numbered(docs, pattern, id_col, text_col)
    folded = numbered.select(
        "id", "first", F.when(F.size("fresh") > 0, fold_words(F.col("fresh"), ranks)).alias("folded"), "long", "numbers")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordIds(shared.value, lists="token_ids" in kinds)
        for batch in batches:
            keys, rows = [], []
            for key, first, ids, long, numbers in zip(*batch.columns):
                if numbers.is_valid:
                    keys.append(key.as_py())
                    rows.append(put(words, array("I", numbers.as_py())))
                    continue
                if first.as_py():
                    words.begin()
                words.add(_lists(ids), long.as_py())
            if rows:
                columns = [pa.array(values, of) for values, of in zip(zip(*rows), kinds.values())]
                yield pa.RecordBatch.from_arrays([pa.array(keys, batch.column(0).type), *columns], [id_col, *kinds])

    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType)])
    for name, of in kinds.items():
        schema.add(name, from_arrow_type(of))
    return folded.mapInArrow(run, schema)


def folded_digests(
    docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Encode and decode every whole text and return digests instead of the ids.

    One row per input row: id, ``n_tokens``, ``ids_sha256`` (of the decimal ids
    joined by commas) and ``decoded_sha256`` (of the decoded bytes). NULL text
    is empty; repeated rows repeat; no rows in, no rows out.
    """
    def put(words: WordIds, numbers: array) -> tuple[int, str, str]:
        joined = b"".join(map(words.joined.__getitem__, numbers))[:-1]
        content = b"".join(map(words.content.__getitem__, numbers))
        count = joined.count(b",") + 1 if joined else 0
        return count, hashlib.sha256(joined).hexdigest(), hashlib.sha256(content).hexdigest()

    return _coded(docs, ranks_path, pattern, id_col, text_col,
                  {"n_tokens": pa.int64(), "ids_sha256": pa.string(), "decoded_sha256": pa.string()}, put)


def encode_folded(
    docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: id and ``token_ids``. NULL text is empty and has no ids."""
    def put(words: WordIds, numbers: array) -> tuple[list[int]]:
        return ([i for n in numbers for i in words.ids[n]],)

    return _coded(docs, ranks_path, pattern, id_col, text_col, {"token_ids": pa.list_(pa.int32())}, put)
