"""The near-copy stage against a plain search over all pairs, with repeated and missing ids."""

import random

import corpus_pipeline
from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("text_hash", T.StringType()), T.StructField("doc_id", T.LongType()),
    T.StructField("text", T.StringType()), T.StructField("component_id", T.LongType()),
    T.StructField("row", T.StringType()), T.StructField("_id", T.StringType()),
])


def shingles(text):
    words = (text or "").lower().split()
    if not words:
        return set()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def plain_rows(rows):
    """Rows that stay: the smallest (id, text) of each linked group, found through all pairs."""
    known = [r for r in rows if r[0] is not None and shingles(r[1])]
    group = list(range(len(known)))

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, (_, a) in enumerate(known):
        for j in range(i):
            one, other = shingles(a), shingles(known[j][1])
            if 100 * len(one & other) >= 75 * len(one | other):
                group[top(i)] = top(j)
    groups = {}
    for i, r in enumerate(known):
        groups.setdefault(top(i), []).append(r)
    return groups.values(), [r for r in rows if r not in known]


def test_near_copies_go_by_row_and_not_by_id(spark):
    rng = random.Random(4)

    def text(n):
        return " ".join(rng.choice("abcdefghijklmnopqrstuvwxyz") + str(rng.randint(0, 400)) for _ in range(n))

    first, second, third = text(60), text(60), text(60)
    rows = [
        (1, first), (2, first + " end"), (2, second), (3, second + " more words"), (3, third), (4, "end " + first),
        (5, text(3)), (5, text(70)), (6, None), (6, ""), (7, " \n"), (None, first + " end"), (None, text(30)), (8, "one two"),
    ]
    rows += [(100 + i, text(40)) for i in range(30)] + [(9, third + " tail"), (9, "tail " + third)]
    docs = spark.createDataFrame([(f"h{i}", d, t, 7, "r", "i") for i, (d, t) in enumerate(rows)], SCHEMA)
    out = corpus_pipeline.without_near_copies(spark, docs, "")
    assert out.columns == docs.columns
    kept = [(r["doc_id"], r["text"]) for r in out.collect()]
    groups, untouched = plain_rows(rows)
    for group in groups:
        stays = [r for r in group if r in kept]
        assert len(stays) == 1 and stays[0][0] == min(r[0] for r in group)
    assert all(r in kept for r in untouched)
    assert len(kept) == len(groups) + len(untouched)
    assert (2, second) in kept and (3, third) in kept and (2, first + " end") not in kept
    assert corpus_pipeline.without_near_copies(spark, docs.limit(0), "").count() == 0
