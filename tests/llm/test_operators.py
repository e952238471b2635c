"""Dealt operators against brute force, and on odd rows."""

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from ledgerline.llm import (
    byte_bpe, embedding_dedup, exact_dedup, packing, secret_scan, sharding, shingle_join, suffix_dedup,
    toxicity, url_filter,
)

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORD = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "", None, " ", "  two  spaces \n\n and\tmore ", "a" * 5000, "naïve Σίσυφος ΟΔΟΣ don't 12 ½ 　x y", "\x1c a\x1fb",
    "İstanbul é <|endoftext|> \U0001F600!!", "x\x85y\xa0z", "end\n", "password=hunter2Zq9!",
]


def odd_docs(spark):
    """Odd texts twice, a NULL id, a repeated id, and columns with names the operators use."""
    rows = [(i, text, i, "x") for i, text in enumerate(ODD + ODD)] + [(None, "one row without id", 1, None), (3, "again", 1, None)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, kept bigint, _id string")


def components(count, links):
    parent = list(range(count))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((top(a), top(b)))
        parent[b] = a
    return [top(i) for i in range(count)]


def written(rng, words):
    return " ".join(rng.choice(VOCABULARY) for _ in range(words))


VOCABULARY = [a + b for a in "bcdfgh" for b in ("a", "en", "ios", "ur")]


def test_shards_are_even_and_gapless(spark):
    rng = random.Random(1)
    rows = [(i, "hot text " * 40 if i % 3 == 0 else written(rng, rng.randint(1, 60))) for i in range(3000)]
    got = sharding.shard_documents(spark.createDataFrame(rows, "doc_id bigint, text string"), 4).collect()
    assert len(got) == 3000 and {r["doc_id"] for r in got} == set(range(3000))
    texts = dict(rows)
    loads = [0] * 4
    for shard in range(4):
        own = [r for r in got if r["shard"] == shard]
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
        loads[shard] = sum(r["size"] for r in own)
    assert max(loads) < 1.05 * min(loads)
    assert all(r["size"] == len(texts[r["doc_id"]].encode()) + 1 for r in got)
    assert all(r["text_crc32"] == zlib.crc32(texts[r["doc_id"]].encode()) for r in got)


def test_url_rules(spark):
    rules = [url_filter.Rule("allow", "org", "/"), url_filter.Rule("block", "example.org", "/en/1"),
             url_filter.Rule("block", "", "/ads/*.js")]
    urls = ["http://a.Example.ORG/en/12", "http://example.org/en/2", "https://xexample.org/en/1", "http://b.net/ads/q/z.js?x",
            "http://org", None, "no scheme", "http://org#/en/1", "http://b.net/ADS/z.js"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    got = {r["page_id"]: r for r in url_filter.judge_urls(df, rules).collect()}
    assert [got[i]["rule"] for i in range(9)] == [
        "example.org/en/1", "org/", "org/", "/ads/*.js", None, None, None, None, None]
    assert [got[i]["verdict"] for i in (0, 1, 3, 4)] == ["block", "allow", "block", "allow"]
    assert (got[0]["host"], got[0]["path"], got[6]["host"]) == ("a.example.org", "/en/12", "")
    assert url_filter.judge_urls(df.limit(0), rules).count() == 0


def test_guess_costs():
    words = secret_scan.word_ranks()
    cost = {v: secret_scan.cheapest_segments(v, words)[0] for v in ("password", "qwertyuiop", "aaaaaaaaaa", "2024-01-31", "x9$Kq2!vTz")}
    assert max(cost["password"], cost["qwertyuiop"], cost["aaaaaaaaaa"], cost["2024-01-31"]) < secret_scan.MIN_GUESSES < cost["x9$Kq2!vTz"]
    for value in ("password2024!", "aaaabbbbqwerty", "zz", "hunter2Zq9!"):
        total, segments = secret_scan.cheapest_segments(value, words)
        assert "".join(value[s.start:s.end] for s in segments) == value
        assert abs(total - sum(s.cost for s in segments)) < 1e-9


def test_base_spans_match_the_plain_patterns(spark):
    texts = ['api_key = "abcDEF123456789"', "token:short", "AKIA" + "A" * 20 + " AKIA123", "é" + "0f" * 10 + "G", "Secret=aaaaaaaaaaaa", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for row in secret_scan.scan_secrets(df).collect():
        text = texts[row["doc_id"]] or ""
        want = [("assign", m.start(), m.end()) for m in re.finditer(
            r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A) if len(m[2]) >= 12]
        want += [("access", m.start(), m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
        want += [("hex", m.start(), m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 16]
        assert sorted(tuple(s) for s in row["secrets"] if s["kind"] != "guess") == sorted(want)
    assert secret_scan.redact("a password=b c", [("assign", 2, 12), ("guess", 11, 12)], "#") == "a # c"


def test_vectors_against_all_pairs(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(60, 24))
    x = np.concatenate([base, base[:30] + 0.05 * rng.normal(size=(30, 24)), base[:10]])
    near = base[40:55] / np.linalg.norm(base[40:55], axis=1, keepdims=True)
    side = rng.normal(size=near.shape)
    side -= (side * near).sum(1, keepdims=True) * near
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    x = np.concatenate([x, 0.905 * near + np.sqrt(1 - 0.905**2) * side])
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    odd = [(900, None), (901, [0.0] * 24), (902, [float("nan")] + [1.0] * 23), (903, [None] + [1.0] * 23), (904, [])]
    got = {r["vec_id"]: r for r in embedding_dedup.near_duplicate_vectors(
        spark.createDataFrame(rows + odd, "vec_id bigint, embedding array<double>")).collect()}
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    links = unit @ unit.T >= 0.9
    np.fill_diagonal(links, False)
    found = sum(got[i]["n_links"] for i in range(len(x)))
    assert 0.9 * links.sum() <= found <= links.sum()
    clear = np.flatnonzero(links.sum(1) == (unit @ unit.T >= 0.97).sum(1) - 1)
    assert all(got[i]["n_links"] == links[i].sum() for i in clear)
    assert all(got[i]["n_links"] == 0 and got[i]["kept"] for i, _ in odd)


def test_exact_dedup(spark):
    df = odd_docs(spark)
    got = exact_dedup.exact_dedup(df).collect()
    groups = {}
    for r in df.collect():
        groups.setdefault(r["text"] or "", []).append(r["doc_id"])
    assert len(got) == df.count()
    keep = {i: max(x for x in ids if x is not None) for ids in groups.values() for i in ids if any(x is not None for x in ids)}
    for r in got:
        if r["doc_id"] not in (None, 3):
            assert r["keep_id"] == keep[r["doc_id"]] and r["kept"] == (r["doc_id"] == r["keep_id"])
    assert exact_dedup.exact_dedup(df.limit(0)).count() == 0


def test_byte_bpe_round_trip(spark):
    ranks = byte_bpe.read_ranks(RANKS)
    want = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    coder = byte_bpe.ByteBpe(ranks, public_tokenizers.PATTERN)
    rng = random.Random(5)
    texts = [t for t in ODD if t] + ["".join(rng.choice("ab \n\t é中.1'") for _ in range(30)) for _ in range(500)]
    for text in texts:
        assert coder.ids(text) == want.encode_ordinary(text)
        assert coder.encode(text)[2].decode() == text
    rows = byte_bpe.coding_digests(odd_docs(spark), RANKS, public_tokenizers.PATTERN).collect()
    texts = {i: t or "" for i, t in enumerate(ODD + ODD)}
    for r in rows:
        if r["doc_id"] not in (None, 3):
            ids = want.encode_ordinary(texts[r["doc_id"]])
            assert r["n_tokens"] == len(ids)
            assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    encoded = byte_bpe.encode_texts(odd_docs(spark), RANKS, public_tokenizers.PATTERN)
    decoded = byte_bpe.decode_ids(encoded.where("doc_id = 5"), RANKS, public_tokenizers.PATTERN).first()
    assert bytes(decoded["content"]).decode() == ODD[5]


def test_toxicity_on_held_out_documents(spark):
    rng = random.Random(7)
    rows, labels = [], []
    for i in range(900):
        toxic = i % 6 == 0
        bad = " ".join(rng.choice(["zork", "quux", "blarg"]) for _ in range(3)) if toxic else ""
        rows.append((i, f"{written(rng, 40)} {bad} {written(rng, 5)}"))
        labels.append((i, rng.randint(0, 1), int(toxic)))
    rows += [(5000, None), (5001, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    known = spark.createDataFrame(labels[:600] + [(None, 1, 1), (7, None, None)], "doc_id bigint, quality int, toxic int")
    got = {r["doc_id"]: r["rejected"] for r in toxicity.score_toxicity(docs, known).collect()}
    assert sum(got[i] == (i % 6 == 0) for i in range(600, 900)) >= 294
    assert not got[5000] and not got[5001]
    assert not any(r["rejected"] for r in toxicity.score_toxicity(docs, known.limit(0)).collect())


def test_repeated_passages_against_all_windows(spark):
    rng = random.Random(9)
    passage = written(rng, 40)
    texts = [written(rng, rng.randint(0, 60)) for _ in range(60)]
    texts += [texts[3], texts[4][:150] + "é" + texts[4][150:], passage + texts[5], texts[6] + passage + texts[7] + passage]
    texts += ["a" * 700, "ab" * 200, "a" * 99, "a" * 100, None, ""]
    got = {r["doc_id"]: r for r in suffix_dedup.remove_repeats(
        spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()}
    seen = set()
    for i, text in enumerate(texts):
        data = (text or "").encode()
        mask = [False] * len(data)
        for p in range(len(data) - 99):
            if data[p : p + 100] in seen:
                mask[p : p + 100] = [True] * 100
            seen.add(data[p : p + 100])
        assert got[i]["n_removed"] == sum(mask), i
        assert bytes(got[i]["kept"]) == bytes(b for b, m in zip(data, mask) if not m)
    assert suffix_dedup.remove_repeats(odd_docs(spark)).count() == odd_docs(spark).count()


def test_packing(spark):
    tokenizer = Tokenizer.from_file(WORD)
    tokenizer.encode_special_tokens = True
    words = packing.WordIds(open(WORD, "rb").read())
    for text in (t for t in ODD if t):
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        assert words.encode(text) == np.array(ids, dtype="<u4").tobytes(), text
    rng = random.Random(2)
    rows = [(i, written(rng, rng.choice([0, rng.randint(1, 200), rng.randint(1, 900), 6000]))) for i in range(300)] + [(900, None), (None, "x")]
    got = packing.pack_documents(spark.createDataFrame(rows, "doc_id bigint, text string"), WORD).collect()
    assert sum(r["length"] for r in got) == sum(len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in rows)
    sequences = {}
    for r in got:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 4096
    assert sum(r["length"] for r in got) > 0.97 * 4096 * (len(sequences) - 1)
    steps = packing.balanced_steps([4096] * 100 + [10] * 28, 64)
    assert sorted(steps.count(s) for s in set(steps)) == [64, 64]


@pytest.mark.parametrize("hot", [0, 40])
def test_shingle_join_against_all_pairs(spark, hot):
    rng = random.Random(hot)
    texts = [written(rng, rng.randint(1, 60)) for _ in range(80)]
    for text in texts[:40]:
        words = text.split()
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(len(words))] = "edited"
        texts.append(" ".join(words).upper())
    base = written(rng, 120).split()
    for i in range(hot):
        copy = list(base)
        for _ in range(rng.randint(1, 5)):
            copy[rng.randrange(120)] = f"edit{i}"
        texts.append(" \x0b".join(copy))
    texts += ["", None, " \n", "one", "ONE", "a b c", "a  b\tc"]
    sets = []
    for text in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append({tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set())
    links = [(i, j) for i in range(len(sets)) for j in range(i)
             if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    got = {r["doc_id"]: r for r in shingle_join.jaccard_components(
        spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()}
    assert [got[i]["n_shingles"] for i in range(len(texts))] == [len(s) for s in sets]
    assert [got[i]["component_id"] for i in range(len(texts))] == components(len(texts), links)


def test_odd_rows_do_not_crash(spark):
    for df in (odd_docs(spark), odd_docs(spark).limit(0)):
        count = df.count()
        assert shingle_join.jaccard_components(df).count() == count
        assert sharding.shard_documents(df).count() == count
        assert secret_scan.scan_secrets(df).count() == count
        assert packing.pack_documents(df, WORD).select("doc_id").distinct().count() == df.select("doc_id").distinct().count()


def test_groups_of_one_leader_keep_every_pair(spark):
    """A passage of eight shingles whose groups differ by a set, and a leader of two groups far apart."""
    groups = {h: [s for s in range(10) if s != h] for h in range(8)} | {20: [30, 31, 32], 21: [30, 41, 42]}
    lead = {h: 9 if h < 10 else 30 for h in groups}
    rows = [(h, lead[h], s, s) for h, sets in groups.items() for s in sets]
    merged = shingle_join._merged(spark.createDataFrame(rows, "h long, lead long, s long, c long")).collect()
    found = {}
    for r in merged:
        found.setdefault((r.h, r.joined), []).append(r.s)
    assert sorted(found) == [(9, True), (20, False), (21, False)]
    assert sorted(found[9, True]) == list(range(10))
    assert sorted(found[20, False]) == [30, 31, 32] and sorted(found[21, False]) == [30, 41, 42]
