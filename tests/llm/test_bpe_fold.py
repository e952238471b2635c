"""Merges folded by Spark, against the library and against merges on one worker."""

import hashlib
import random
from array import array

import public_tokenizers
import tiktoken
from pyspark.sql import functions as F, types as T

from ledgerline.llm import bpe_fold, byte_bpe
from ledgerline.llm.letters import Splitter, spelled

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


def library(ranks):
    return tiktoken.Encoding("t", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def table(spark, texts):
    schema = T.StructType([
        T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
        T.StructField("fresh", T.StringType()), T.StructField("numbers", T.LongType())])
    rows = [(i, t, "x", 1) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows + [(None, "hello again", "x", 1)] + rows[-2:], schema).repartition(3)


def odd_texts():
    rng = random.Random(11)
    words = ["".join(rng.choice("etaoinshrdluxq019_'é中") for _ in range(rng.randint(1, 14))) for _ in range(400)]
    return [
        "", None, " ", "\n\n \t", "a", "aaaaaaa " * 50, "don't DON'T", "é naïve 日本語 \U0001f600 ՘",
        "x" * 5_000 + " " + "kqz" * 700, "the cat " * 40_000, " ".join(words), "  ".join(words), "\n".join(words),
    ]


def test_folded_words_are_merged_as_on_one_worker(spark):
    ranks = byte_bpe.read_ranks(RANKS)
    rng = random.Random(7)
    words = [bytes(rng.choice(b"abenrst ") for _ in range(rng.randint(1, 30))) for _ in range(400)]
    words += [bytes([b]) for b in range(256)] + [b"a" * 64, "漢字かな".encode(), bytes(range(200, 232))]
    one = spark.createDataFrame([([b"", *words],)], "words array<binary>")
    got = one.select(bpe_fold.fold_words(F.col("words"), ranks)).first()[0]
    assert got == [[], *(byte_bpe.merge_word(w, ranks) for w in words)]


def test_digests_ids_and_round_trip(spark):
    texts = odd_texts()
    want = library(byte_bpe.read_ranks(RANKS))
    ids = {i: want.encode_ordinary(t or "") for i, t in enumerate(texts)} | {None: want.encode_ordinary("hello again")}
    docs = table(spark, texts)
    rows = bpe_fold.folded_digests(docs, RANKS, PATTERN).collect()
    assert len(rows) == len(texts) + 3
    plain = {i: t or "" for i, t in enumerate(texts)} | {None: "hello again"}
    for r in rows:
        assert r["n_tokens"] == len(ids[r["doc_id"]])
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids[r["doc_id"]])).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(plain[r["doc_id"]].encode()).hexdigest()
    encoded = bpe_fold.encode_folded(docs, RANKS, PATTERN)
    assert all(r["token_ids"] == ids[r["doc_id"]] for r in encoded.collect())
    decoded = byte_bpe.decode_ids(encoded, RANKS, PATTERN).collect()
    assert all(bytes(r["content"]).decode() == plain[r["doc_id"]] for r in decoded)


def test_merges_are_spark_functions_and_nothing_is_shuffled(spark):
    plan = bpe_fold.folded_digests(table(spark, ["a b"]).coalesce(1), RANKS, PATTERN)
    text = plan._jdf.queryExecution().analyzed().toString()
    assert "aggregate(sequence(" in text and text.count("MapInArrow") == 2
    narrow = bpe_fold.folded_digests(spark.range(3).selectExpr("id doc_id", "'a b' text"), RANKS, PATTERN)
    assert "Exchange" not in narrow._jdf.queryExecution().executedPlan().toString()


def test_empty_table_and_text_ids(spark):
    empty = bpe_fold.folded_digests(table(spark, ["a"]).limit(0), RANKS, PATTERN)
    assert empty.count() == 0 and empty.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    named = spark.createDataFrame([("k1", "hello"), ("k1", "hello")], "`the key` string, text string")
    got = bpe_fold.encode_folded(named, RANKS, PATTERN, "the key").collect()
    assert [r["the key"] for r in got] == ["k1", "k1"] and got[0]["token_ids"] == got[1]["token_ids"]


def test_a_new_dictionary_begins_when_one_is_full(monkeypatch):
    monkeypatch.setattr(bpe_fold, "DICTIONARY_WORDS", 40)
    monkeypatch.setattr(bpe_fold, "STRETCHES", 10)
    ranks = byte_bpe.read_ranks(RANKS)
    want, numbers, ids = library(ranks), bpe_fold.WordNumbers(Splitter(PATTERN, spelled(PATTERN))), bpe_fold.WordIds(ranks)
    begun = 0
    for text in [t for t in odd_texts() if t] * 2:
        found = numbers.text(text)
        first, fresh, long = numbers.words()
        if first:
            begun += 1
            ids.begin()
        if numbers.full():
            numbers.begin()
        ids.add([byte_bpe.merge_word(w, ranks) if w else [] for w in fresh], long)
        assert [i for n in array("I", found) for i in ids.ids[n]] == want.encode_ordinary(text)
    assert begun > 3


def test_all_pairs_of_the_vocabulary_are_found_and_no_others():
    ranks = byte_bpe.read_ranks(RANKS)
    begin, cells = bpe_fold.pair_cells(ranks)
    pieces = {rank: piece for piece, rank in ranks.items()}
    rng = random.Random(5)
    some = [(rng.randrange(len(ranks)), rng.randrange(len(ranks) + 1)) for _ in range(50_000)]
    some += [(ranks[p[:i]], ranks[p[i:]]) for p in ranks for i in range(1, len(p)) if p[:i] in ranks and p[i:] in ranks]
    for left, right in some + [(len(ranks), 3), (len(ranks), len(ranks))]:
        found = cells[begin[left] + right] ^ left << bpe_fold.BITS
        want = ranks.get(pieces.get(left, b"\0" * 99) + pieces.get(right, b"\0" * 99))
        assert found == want if want is not None else found >> bpe_fold.BITS


def test_words_that_no_merges_lead_to_are_one_id(spark):
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 256, b"abc": 257, b"xyz": 300}
    words = [b"xyz", b"xyzxyz", b"abc", b"zabcab", b"a", b"", b"\xff\x00"]
    assert bpe_fold.unreached(ranks) == {b"xyz": 300}
    one = spark.createDataFrame([(words,)], "words array<binary>")
    got = one.select(bpe_fold.fold_words(F.col("words"), ranks)).first()[0]
    assert got == [byte_bpe.merge_word(w, ranks) if w else [] for w in words]


def test_the_fold_leaves_no_loop_by_an_exception(spark):
    plan = bpe_fold.folded_digests(table(spark, ["a b"]), RANKS, PATTERN)
    assert "array_position" not in plan._jdf.queryExecution().analyzed().toString()


def test_partitions_as_read_share_tasks(spark):
    least = 2 * spark.sparkContext.defaultParallelism
    assert bpe_fold.fewer_tasks(spark.range(0, 100, 1, 8 * least)).rdd.getNumPartitions() == 2 * least
    assert bpe_fold.fewer_tasks(spark.range(0, 100, 1, 3)).rdd.getNumPartitions() == 3


def test_early_letters_are_split_as_by_every_class():
    split = Splitter(PATTERN, spelled(PATTERN))
    rng = random.Random(3)
    early = "".join(map(chr, range(0x378)))
    for _ in range(3_000):
        text = "".join(rng.choice(early) for _ in range(30))
        assert split.quick(text) and split(text) == split.every.findall(text)
    assert not split.quick("a͸") and not split.quick("\U0001f600")
