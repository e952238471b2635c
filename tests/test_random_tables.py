"""Operators against brute force on generated tables with hot values."""

import itertools

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from ledgerline.operators import evaluation as E, joins as J, ordered as O, profiling as P, sampling
from ledgerline.sources.files import literal_table

quick = settings(
    max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
# A third or more of the rows share one value.
hot_score = st.one_of(st.just(0.5), st.floats(0, 1, allow_nan=False).map(lambda v: round(v, 2)))


@quick
@given(rows=st.lists(st.tuples(hot_score, st.integers(0, 1)), min_size=2, max_size=60))
def test_auc_by_pairs(spark, rows):
    positives = [s for s, y in rows if y]
    negatives = [s for s, y in rows if not y]
    got = E.auc(spark.createDataFrame(rows, "score double, y int")).first()[0]
    if not positives or not negatives:
        assert got is None
        return
    wins = sum((p > n) + 0.5 * (p == n) for p, n in itertools.product(positives, negatives))
    assert got == pytest.approx(wins / (len(positives) * len(negatives)))


@quick
@given(
    values=st.lists(st.one_of(st.just(7), st.integers(-50, 50)), min_size=1, max_size=80),
    share=st.sampled_from([0.01, 0.25, 0.5, 0.75, 0.99]), rows=st.sampled_from([1, 5, 1000]),
)
def test_order_statistics(spark, values, share, rows):
    df = spark.createDataFrame([(v,) for v in values], "x int")
    running = O.running_counts(O.value_counts(df, "x"), "x", rows_per_cell=rows).collect()
    assert {r["x"]: r["n_through"] for r in running} == {
        v: sum(w <= v for w in values) for v in values}
    place = share * (len(values) - 1)
    low, ordered = int(place), sorted(values)
    want = ordered[low] + (place - low) * (ordered[min(low + 1, len(values) - 1)] - ordered[low])
    assert O.quantiles(df, "x", {"q": share}, interpolate=True).first()[0] == pytest.approx(want)


@quick
@given(
    labels=st.lists(st.one_of(st.just(0), st.integers(0, 2)), min_size=1, max_size=90),
    fraction=st.sampled_from([0.2, 0.5, 0.8]),
)
def test_stratified_split(spark, labels, fraction):
    df = spark.createDataFrame(list(enumerate(labels)), "id int, y int")
    train, test = sampling.stratified_split(df, fraction, "id", "y", (0, 1, 2))
    kept, rest = train.collect(), test.collect()
    assert sorted(r["id"] for r in kept + rest) == list(range(len(labels)))
    for level in set(labels):
        assert sum(r["y"] == level for r in kept) == int(fraction * labels.count(level) + 0.5)


@quick
@given(
    keys=st.lists(st.sampled_from(["a", "a", "a", "b", "c", None]), min_size=1, max_size=80),
    salts=st.sampled_from([1, 3, 16]),
)
def test_salted_join(spark, keys, salts):
    lookup = [("a", 1), ("b", 2), ("b", 3), ("z", 4)]
    fact = spark.createDataFrame(list(enumerate(keys)), "id int, k string")
    joined = J.shuffle_join(fact, literal_table(spark, lookup, ["k", "v"]), "k", ["id"], salts)
    got = sorted((r["id"], r["k"], r["v"]) for r in joined.collect())
    assert got == sorted((i, k, v) for i, k in enumerate(keys) for m, v in lookup if m == k)


@quick
@given(rows=st.lists(st.tuples(st.sampled_from(["x", "x", "y", None]), st.integers(0, 2)), max_size=60))
def test_duplicates(spark, rows):
    got = P.duplicates(spark.createDataFrame(rows, "a string, b int")).first()
    assert tuple(got) == (len(rows), len(set(rows)), len(rows) - len(set(rows)))
