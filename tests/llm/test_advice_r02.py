"""What the second review found: each test failed before its finding was settled."""

import math
import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from ledgerline.llm import packing, secret_scan

WORD = public_tokenizers.path("word_bpe_49k.json")


def test_packing_emits_added_tokens(spark):
    tokenizer = Tokenizer.from_file(WORD)
    texts = [
        "end <|endoftext|> x", "a<|endoftext|>b", "x<|ENDOFTEXT|>", "don<|endoftext|>'t <|startoftext|", "<|endoftext|><|endoftext|>",
        "é<|startoftext|>ΟΔΟΣ<|endoftext|>", "e<|endoftext|>́ z", " <|endoftext|>\x1c", "plain", "", "<|start<|endoftext|>oftext|>",
    ]
    want = {i: tokenizer.encode(t, add_special_tokens=False).ids + [packing.END_ID] for i, t in enumerate(texts)}
    rows = packing.pack_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), WORD).collect()
    got = {r["doc_id"]: (r["length"], r["doc_tokens"], r["ids_crc32"]) for r in rows if r["start"] == 0}
    assert got == {i: (len(w), len(w), zlib.crc32(np.array(w, "<u4").tobytes())) for i, w in want.items()}


def test_prose_words_are_no_secrets(spark):
    texts = [
        "password: required", "token: optional", "the secret is important", "Password is Mandatory.",
        "a required field, an optional one and an important, mandatory one",
        "password: kqzvxwjbtr", "password: kqzvxwjbtr", "token=x9$Kq2!vTz",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r["doc_id"]: [tuple(s) for s in r["secrets"]] for r in secret_scan.scan_secrets(docs).collect()}
    assert not any(got[i] for i in range(5))
    assert got[5] == got[6] == [("guess", 10, 20)] and got[7] == [("guess", 6, 16)]
    kept = {r["doc_id"]: r["text"] for r in secret_scan.redact_secrets(docs).collect()}
    assert [kept[i] for i in range(5)] == texts[:5] and kept[5] == "password: <secret>"


def naive_cost(value, words):
    """Cheapest segmentation by trying every one."""
    lower, per = value.lower(), secret_scan._alphabet(value)
    plain, known = lower.translate(secret_scan.LOOKALIKES), {}

    def costs(i, j):
        part, size = value[i:j], j - i
        yield size * per, "brute"
        for text, extra in ((lower, 0), (plain, math.log10(4))):
            if text[i:j] in words and (extra == 0 or plain[i:j] != lower[i:j]):
                yield math.log10(words[text[i:j]] + 1) + extra + math.log10(2) * (part != lower[i:j]), "word"
        if any(form.fullmatch(part) for form in secret_scan._DATES):
            yield math.log10(365 * 120 * 4 if size > 4 else 120), "date"
        for unit in range(1, size // 2 + 1):
            if size % unit == 0 and part == part[:unit] * (size // unit):
                yield unit * per + math.log10(size // unit), "repeat"
        if size >= 3 and all(lower[k : k + 2] in secret_scan.NEIGHBOURS for k in range(i, j - 1)):
            yield math.log10(100 * size), "walk"

    def rest(i, before):
        if i == len(value):
            return 0.0
        if (i, before) not in known:
            known[i, before] = min(
                cost + (0.0 if kind == "brute" and before in ("", "brute") else secret_scan.SEGMENT) + rest(j, kind)
                for j in range(i + 1, len(value) + 1) for cost, kind in costs(i, j))
        return known[i, before]

    return rest(0, "")


def test_guess_cost_is_the_minimum():
    words = secret_scan.word_ranks() | {"ab": 3, "x": 9000, "extraordinarilylong": 70}
    values = ["aabaabaabaab", "xaabaabaab", "20240131", "31012024", "qwertyu", "extraordinarilylong1", "passwordpasswordd"]
    rng = random.Random(4)
    values += ["".join(rng.choice(["a", "b", "ab", "aab", "pass", "word", "p@ss", "Key", "qwe", "123", "2024", "!", "01"])
                       for _ in range(rng.randint(1, 6))) for _ in range(400)]
    for value in values:
        total, segments = secret_scan.cheapest_segments(value, words)
        assert abs(total - naive_cost(value, words)) < 1e-9, value
        assert "".join(value[s.start:s.end] for s in segments) == value
        assert abs(total - sum(s.cost for s in segments)) < 1e-9, value
        bounded = secret_scan.cheapest_segments(value, words, 8.0)[0]
        assert (bounded < 8.0) == (total < 8.0), value


def check_tiers(parts, lengths):
    """Parts cover the pieces once, follow each other, stay in their windows and leave only the last one open."""
    at = 0
    for p in parts:
        assert p.sequence * 4096 + p.offset == at and p.offset // p.tier == (p.offset + p.length - 1) // p.tier
        at += p.length
    for i, length in enumerate(lengths):
        own = sorted((p.start, p.length) for p in parts if p.piece == i)
        assert [s for s, _ in own] == [sum(n for _, n in own[:k]) for k in range(len(own))]
        assert sum(n for _, n in own) == length
    tiers = [p.tier for p in parts]
    assert tiers == sorted(tiers, reverse=True)
    return tiers


def test_tiers_have_windows_of_their_own():
    rng = random.Random(6)
    for top in (300, 900, 2000, 4096):
        lengths = [rng.randint(1, top) for _ in range(800)]
        parts = packing.pack_group(lengths)
        tiers = check_tiers(parts, lengths)
        assert max(tiers) == packing.tier_of(max(lengths))
    assert len(set(tiers)) > 1
    for n in (2100, 2900, 4000):
        assert set(check_tiers(packing.pack_group([n] * 300), [n] * 300)) >= {4096}


def test_equal_lengths_above_half_a_window_are_not_padded(spark):
    tokenizer = Tokenizer.from_file(WORD)
    rows = [(i, " ".join(["the", str(i % 10)] * 1050)) for i in range(200)]
    got = packing.pack_documents(spark.createDataFrame(rows, "doc_id bigint, text string"), WORD).collect()
    total = sum(r["length"] for r in got)
    assert total == 200 * 2101
    assert len({r["sequence_id"] for r in got}) == -(-total // 4096)
    for r in got:
        ids = tokenizer.encode(rows[r["doc_id"]][1], add_special_tokens=False).ids + [packing.END_ID]
        part = ids[r["start"] : r["start"] + r["length"]]
        assert r["doc_tokens"] == 2101 and r["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
