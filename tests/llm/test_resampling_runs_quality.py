"""Quality trees, target resampling and periodic runs against brute force, and on odd rows."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from ledgerline.llm import periodic_runs, quality_trees, target_resampling
from tests.llm.test_operators import ODD, odd_docs, written

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
FEATURE_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
NAMES = [name for name, _ in quality_trees.FEATURES]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- Periodic runs -----------------------------------------------------------

def plain_runs(words, least, power):
    found = {}
    for p in range(1, len(words) // power + 1):
        i = 0
        while i + p < len(words):
            start = i
            while i + p < len(words) and words[i] == words[i + p]:
                i += 1
            length = i + p - start
            if length >= max(least, power * p) and (start, length) not in found:
                found[start, length] = p
            i += 1
    return sorted((start, length, p) for (start, length), p in found.items())


def numbers(rng):
    n, kinds = rng.randint(0, 40), rng.randint(1, 4)
    words = [rng.randrange(kinds) for _ in range(n)]
    if n and rng.random() < 0.6:
        a = rng.randrange(n)
        p = 1 + (n - a) // rng.randint(2, 9)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def test_runs_equal_brute_force():
    rng = random.Random(5)
    for _ in range(1500):
        words = numbers(rng)
        for least, power in ((2, 2), (6, 4), (3, 3)):
            assert sorted(map(tuple, periodic_runs.find_runs(words, least, power))) == plain_runs(words, least, power)


def test_lyndon_ends_equal_brute_force():
    rng = random.Random(6)

    def is_lyndon(word):
        return all(word < word[i:] for i in range(1, len(word)))

    for _ in range(300):
        number = {}
        words = [number.setdefault(w, len(number)) for w in numbers(rng)]
        want = [max(e for e in range(i + 1, len(words) + 1) if is_lyndon(words[i:e])) for i in range(len(words))]
        assert periodic_runs.lyndon_ends(words) == want


def test_long_periodic_texts_are_quick():
    a, b = [0], [0, 1]
    while len(b) < 60_000:
        a, b = b, b + a
    assert periodic_runs.find_runs(b) == []  # a Fibonacci word has no fourth power
    assert periodic_runs.find_runs([7] * 60_000) == [(0, 60_000, 1)]
    unit = list(range(20_000))
    assert periodic_runs.find_runs(unit * 4 + unit[:5]) == [(0, 80_005, 20_000)]


def plain_digests(key, text):
    words = WORDS.findall(text or "")
    n = len(words)
    if key is not None:
        h = zlib.crc32(str(key).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words, 6, 4)
    runs.sort(key=lambda r: (r[0], r[2]))
    dropped = {i for s, length, p in runs for i in range(s + p, s + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (key, len(runs), *top, sha("".join("%d,%d,%d\n" % r for r in runs)),
            sha(" ".join(w for i, w in enumerate(words) if i not in dropped)))


def test_run_digests_equal_brute_force(spark):
    rng = random.Random(7)
    texts = [written(rng, rng.randint(0, 120)) for _ in range(200)]
    texts += ["a b " * 9 + "c", "x " * 5, "x " * 6, "e\x1cf g\x0b" * 6, "é\xa0ü " * 8, "p q r\n" * 7 + "p q z " * 7]
    rows = [*enumerate(texts), *[(i + 900, t) for i, t in enumerate(ODD)], (3, texts[3]), (None, "u v " * 30)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = periodic_runs.run_digests(docs, prepare=periodic_runs.repeat_tail).drop("runs", "collapsed")
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted((plain_digests(*r) for r in rows), key=repr)
    assert sum(plain_digests(*r)[1] > 0 for r in rows) > 10


def test_run_outputs_and_odd_tables(spark):
    docs = spark.createDataFrame([(1, "b a b a b a b a c", 9)], "doc_id bigint, text string, n_runs int")
    row = periodic_runs.run_digests(docs).first()
    assert [tuple(r) for r in row["runs"]] == [(0, 8, 2)] and row["collapsed"] == "b a c" and row["n_runs"] == 1
    assert periodic_runs.run_digests(docs.limit(0)).count() == 0
    odd = odd_docs(spark)
    assert periodic_runs.run_digests(odd).count() == odd.count()
    named = docs.selectExpr("'k' as key", "text as body")
    assert periodic_runs.run_digests(named, "key", "body").first()["key"] == "k"


# --- Target resampling -------------------------------------------------------

def plain_resample(rows, target, longest=1, buckets=10_000, percent=10, least=20, seed=2024):
    def words(text):
        return FEATURE_WORDS.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))

    def features(text):
        w = words(text)
        grams = [" ".join(w[i : i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1)]
        return [zlib.crc32(g.encode()) % buckets for g in grams]

    own = [(key, len(words(text)), features(text)) for key, text in rows]
    s = collections.Counter(b for _, _, f in own for b in f)
    t = collections.Counter(b for text in target for b in features(text))
    total_s, total_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (total_s + buckets) / ((s[b] + 1) * (total_t + buckets)))) for b in range(buckets)]
    result = []
    for key, n_words, f in own:
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(sha(f"{seed}:{'' if key is None else key}")[:8], 16)
        result.append([key, n_words, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    able = sorted((r for r in result if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    ranks = {id(r): i for i, r in enumerate(able[: percent * len(able) // 100], 1)}
    return sorted(((r[0], *r[2:], ranks.get(id(r))) for r in result), key=repr)


@pytest.mark.parametrize("longest", [1, 3])
def test_resampling_equals_brute_force(spark, longest):
    rng = random.Random(8)
    rows = [(i, written(rng, rng.randint(0, 90))) for i in range(300)]
    rows += [(400 + i, t) for i, t in enumerate(ODD)] + [(500, "Ünïcode straße ÀB " * 9), (501, "a1-b2_c3\x7f" * 10), (501, "z " * 30)]
    target = [written(rng, 40), "Ba ben bios bur", "", None]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id bigint, text string, rank int")
    bench = spark.createDataFrame(list(enumerate(target)), "item_id bigint, text string")
    got = target_resampling.resample(docs, bench, longest=longest, percent=30)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, got.collect()), key=repr) == plain_resample(rows, target, longest, percent=30)


def test_spans_overlap():
    patterns = target_resampling.ngram_patterns(3)
    line = target_resampling.collapsed(b"--The quick,  brown\tFOX!")
    found = [m.group() for m in patterns[1].finditer(line, overlapped=True)]
    assert line == b"the quick brown fox" and found == [b"the quick", b"quick brown", b"brown fox"]
    assert [m.group() for m in patterns[2].finditer(line, overlapped=True)] == [b"the quick brown", b"quick brown fox"]


def test_resampling_on_odd_tables(spark):
    bench = spark.createDataFrame([(1, "good words")], "item_id bigint, text string")
    docs = spark.createDataFrame([(1, "one " * 30)] * 500 + [(None, "two " * 30)] * 500, "doc_id bigint, text string")
    assert target_resampling.resample(docs.limit(0), bench).count() == 0
    got = target_resampling.resample(docs, bench.limit(0)).collect()
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, 101)) and len(got) == 1000


# --- Quality trees -----------------------------------------------------------

def plain_counts(text):
    words = WORDS.findall(text or "")
    windows = collections.defaultdict(list)
    for i in range(len(words) - 4):
        windows[tuple(words[i : i + 5])].append(i)
    covered = {j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 5)}
    lines = [line for line in (text or "").split("\n") if WORDS.search(line)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered))


def quality_docs(rng, count):
    rows, labels = [], []
    for i in range(count):
        text = written(rng, rng.randint(20, 150)).capitalize()
        poor = i % 5 == 0
        if poor:
            text = " ".join(w + rng.choice(["###", "$$$", "", "&&"]) for w in text.split())
        rows.append((i, text))
        labels.append((i, int(not poor), 0))
    return rows, labels


def test_quality_counts_and_base_rule(spark):
    rng = random.Random(9)
    rows, labels = quality_docs(rng, 200)
    rows += [(900 + i, t) for i, t in enumerate(ODD)]
    rows += [(950, "a b c d e " * 12), (951, "one\ntwo\n one\none\n\n\n" * 3), (952, "q " * 9), (953, "q w e r t " + written(rng, 60) + " q w e r t"),
             (954, "a a a a a a a b c d e f"), (None, "x\x1cy \x0b z"), (3, rows[3][1])]
    docs = spark.createDataFrame([(*r, 5) for r in rows], "doc_id bigint, text string, n_words int")
    known = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    got = quality_trees.judge_quality(docs, known)
    assert got.columns == ["doc_id", *quality_trees.COUNTS, "base_failed", "p_good", "kept"]
    found = [(r[0], *r[1:6], r["base_failed"]) for r in got.collect()]
    want = [(key, *c, c[0] < 10 or 100 * c[4] > 20 * c[0]) for key, text in rows for c in [plain_counts(text)]]
    assert sorted(found, key=repr) == sorted(want, key=repr)
    assert not any(r["kept"] and r["base_failed"] for r in got.collect())


def test_quality_verdicts_on_held_out_rows(spark):
    rows, labels = quality_docs(random.Random(10), 600)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    known = spark.createDataFrame(labels[:400], "doc_id bigint, quality int, toxic int")
    got = {r["doc_id"]: r for r in quality_trees.judge_quality(docs, known).collect()}
    judged = [(got[i]["kept"], bool(q)) for i, q, _ in labels[400:] if not got[i]["base_failed"]]
    assert sum(a == b for a, b in judged) > 0.97 * len(judged) and len(judged) > 150


def test_trees_are_monotonic_and_scored_alike():
    rng = np.random.default_rng(1)
    x = rng.random((800, len(NAMES)))
    noise = rng.random(800)
    good = ((x[:, 2] < 0.6) & (x[:, 0] + 0.4 * noise > 0.3) | (x[:, 3] * noise > 0.5)).astype(float)
    forest = quality_trees.fit_forest(x, good, np.ones(800))
    for at, direction in enumerate(d for _, d in quality_trees.FEATURES):
        for row in x[:60] if direction else ():
            line = np.tile(row, (50, 1))
            line[:, at] = np.linspace(-0.1, 1.1, 50)
            assert (np.diff(quality_trees.predict(forest, line)) * direction >= -1e-12).all()

    def walk(node, row):
        while forest.left[node] != node:
            node = forest.left[node] if row[forest.feature[node]] <= forest.threshold[node] else forest.right[node]
        return forest.value[node]

    margins = [forest.bias + sum(walk(r, row) for r in forest.roots) for row in x[:100]]
    assert np.allclose(quality_trees.predict(forest, x[:100]), 1 / (1 + np.exp(-np.array(margins))))
    assert ((quality_trees.predict(forest, x) > 0.5) == good).mean() > 0.85


def test_quality_without_usable_labels(spark):
    rows, labels = quality_docs(random.Random(11), 60)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    known = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    got = quality_trees.judge_quality(docs, known.limit(0)).collect()
    assert all(r["p_good"] is None and r["kept"] == (not r["base_failed"]) for r in got) and len(got) == 60
    got = quality_trees.judge_quality(docs, known.where("quality = 1")).collect()
    assert all(r["p_good"] > 0.9 and r["kept"] == (not r["base_failed"]) for r in got)
    assert quality_trees.judge_quality(docs.limit(0), known).count() == 0
    twice = known.unionByName(known).unionByName(known.selectExpr("doc_id", "cast(null as int) quality", "toxic"))
    again = quality_trees.judge_quality(docs.unionByName(docs), twice)
    assert again.count() == 120 and again.distinct().count() == 60
    odd = odd_docs(spark)
    assert quality_trees.judge_quality(odd, known).count() == odd.count()


def test_labelled_draw_is_bounded_per_class(spark):
    stats = spark.range(4000).selectExpr("id as _id", "array(cast(id as double)) as _x")
    labels = spark.range(4000).selectExpr("id as doc_id", "cast(id % 100 > 0 as int) as quality")
    drawn = quality_trees.labelled_sample(stats, labels, max_per_class=500).collect()
    of = collections.Counter(r["good"] for r in drawn)
    assert of[0] == 40 and 400 < of[1] < 600
    assert abs(sum(r["weight"] for r in drawn if r["good"] == 1) - 3960) < 500
