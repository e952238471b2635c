import math

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import ChiSquareTest
from pyspark.sql import functions as F

from ledgerline.functions import tails
from ledgerline.operators import distributions as D, hypothesis as H, ordered as O, profiling as P

TWO_BY_TWO = [(0, 0, 10), (0, 1, 20), (1, 0, 30), (1, 1, 15)]


@pytest.fixture(scope="module")
def table(spark):
    rows = [(a, b) for a, b, n in TWO_BY_TWO for _ in range(n)]
    return spark.createDataFrame(rows, "a int, b int")


@pytest.fixture(scope="module")
def numbers(spark):
    """Values with many copies of one of them, and NULLs."""
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.lognormal(3, 1, 500).round(2), np.full(300, 7.5)])
    frame = pd.DataFrame({"g": rng.integers(0, 2, 800), "x": x})
    rows = [(int(g), float(v)) for g, v in frame.itertuples(index=False)] + [(0, None), (1, None)]
    return frame, spark.createDataFrame(rows, "g int, x double")


def _tail(spark, function, statistic, dof):
    return spark.range(1).select(function(F.lit(statistic), F.lit(dof)).alias("p")).first()["p"]


def test_chi_squared_tail_values(spark):
    # Published critical values at 5 %.
    for dof, critical in [(1, 3.841459), (2, 5.991465), (3, 7.814728), (10, 18.307038)]:
        assert _tail(spark, tails.chi_squared_tail, critical, dof) == pytest.approx(0.05, abs=1e-7)
    assert _tail(spark, tails.chi_squared_tail, 0, 1) == 1.0
    assert _tail(spark, tails.chi_squared_tail, 5.0, 0) == 1.0
    assert _tail(spark, tails.chi_squared_tail, None, 2) is None
    for x in (1e-9, 0.3, 4.0, 90.0, 600.0):
        assert _tail(spark, tails.chi_squared_tail, x, 1) == pytest.approx(math.erfc(math.sqrt(x / 2)), rel=1e-11)
    # Even degrees of freedom are a Poisson sum.
    poisson = sum(math.exp(k * math.log(1000) - 1000 - math.lgamma(k + 1)) for k in range(1000))
    assert _tail(spark, tails.chi_squared_tail, 2000.0, 2000) == pytest.approx(poisson, rel=1e-9)


def test_student_tail_values(spark):
    for dof, critical in [(1, 12.706205), (5, 2.570582), (30, 2.042272), (1000, 1.962339)]:
        assert _tail(spark, tails.student_t_two_sided, critical, dof) == pytest.approx(0.05, abs=1e-7)
        assert _tail(spark, tails.student_t_two_sided, -critical, dof) == pytest.approx(0.05, abs=1e-7)
    assert _tail(spark, tails.student_t_two_sided, 0, 7) == pytest.approx(1.0)
    assert 0 < _tail(spark, tails.student_t_two_sided, 35.1, 2535.8) < 1e-200
    assert _tail(spark, tails.student_t_two_sided, None, 7) is None
    for t in (0.01, 1.0, 40.0):  # closed forms for one and two degrees of freedom
        assert _tail(spark, tails.student_t_two_sided, t, 1) == pytest.approx(
            2 * math.atan2(1, t) / math.pi, rel=1e-11)
        root = math.sqrt(2 + t * t)
        assert _tail(spark, tails.student_t_two_sided, t, 2) == pytest.approx(2 / (root * (root + t)), rel=1e-11)


def test_student_tail_of_large_samples(spark):
    # To first order in 1/dof the tail differs from the normal one by a known term.
    for dof in (1e8, 1e10, 1e12):
        for t in (0.5, 1.96, 6.0):
            normal = math.erfc(t / math.sqrt(2))
            density = math.exp(-t * t / 2) / math.sqrt(2 * math.pi)
            expected = normal + density * t * (t * t + 1) / (2 * dof)
            assert _tail(spark, tails.student_t_two_sided, t, dof) == pytest.approx(expected, rel=1e-10)


def test_chi_squared_two_by_two(table):
    plain = H.chi_squared(table, "a", "b", (0, 1), correction=False).first()
    yates = H.chi_squared(table, "a", "b", (0, 1)).first()
    assert plain["chi2"] == pytest.approx(8.035714, abs=1e-6)
    assert yates["chi2"] == pytest.approx(6.752232, abs=1e-6)
    assert plain["dof"] == yates["dof"] == 1 and yates["reject"]


def test_chi_squared_agrees_with_ml(table):
    vectors = VectorAssembler(inputCols=["a"], outputCol="v").transform(table)
    reference = ChiSquareTest.test(vectors, "v", "b", flatten=True).first()
    plain = H.chi_squared(table, "a", "b", (0, 1), correction=False).first()
    assert plain["chi2"] == pytest.approx(reference["statistic"])
    assert plain["p_value"] == pytest.approx(reference["pValue"])


def test_expected_keeps_empty_cells(spark):
    df = spark.createDataFrame([("p", 0), ("p", 0), ("q", 1), (None, 1)], "r string, y int")
    cells = H.expected_counts(df, "r", "y", (0, 1))
    assert cells.count() == 4
    labelled = H.expected_counts(df, "r", "y", (0, 1), "unknown")
    assert labelled.agg(F.sum("observed")).first()[0] == 4


def test_welch_closed_form(numbers):
    frame, df = numbers
    a, b = (frame.x[frame.g == g] for g in (1, 0))
    va, vb = a.var() / len(a), b.var() / len(b)
    row = H.welch(df, "x", "g").first()
    assert row["t"] == pytest.approx((a.mean() - b.mean()) / math.sqrt(va + vb))
    assert row["dof"] == pytest.approx((va + vb) ** 2 / (va**2 / (len(a) - 1) + vb**2 / (len(b) - 1)))
    assert 0 <= row["p_value"] <= 1


@pytest.mark.parametrize("rows_per_cell", [1, 7, 40, 100_000])
def test_running_counts_match_a_plain_cumulative_sum(numbers, rows_per_cell):
    frame, df = numbers
    counts = O.value_counts(df, "x", ["g"])
    got = O.running_counts(counts, "x", by=["g"], rows_per_cell=rows_per_cell).toPandas()
    want = frame.groupby(["g", "x"]).size().rename("n").reset_index().sort_values(["g", "x"])
    want["n_through"] = want.groupby("g").n.cumsum()
    want["n_total"] = want.groupby("g").n.transform("sum")
    got = got.sort_values(["g", "x"]).reset_index(drop=True)[list(want.columns)]
    pd.testing.assert_frame_equal(got, want.reset_index(drop=True), check_dtype=False)


def test_quantiles(numbers):
    frame, df = numbers
    shares = {"a": 0.01, "b": 0.5, "c": 0.9, "d": 1.0, "e": 0.0}
    linear = O.quantiles(df, "x", shares, interpolate=True).first()
    discrete = O.quantiles(df, "x", shares).first()
    for name, share in shares.items():
        assert linear[name] == pytest.approx(np.quantile(frame.x, share))
        assert discrete[name] == np.quantile(frame.x, share, method="inverted_cdf")
    assert df.approxQuantile("x", [0.5], 0.0) == [discrete["b"]]


def test_quantiles_of_few_values(spark):
    one = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    assert tuple(O.quantiles(one, "x", {"q": 0.25, "m": 0.5}, interpolate=True).first()) == (3.0, 3.0)
    none = spark.createDataFrame([(None,)], "x double")
    assert D.median(none, "x").first()[0] is None


def test_histogram_matches_numpy(numbers):
    frame, df = numbers
    rows = D.histogram(df, "x", 30).orderBy("bin").collect()
    counts, edges = np.histogram(frame.x, 30)
    assert [r["count"] for r in rows] == counts.tolist()
    assert [r["left_edge"] for r in rows] == pytest.approx(edges[:-1].tolist())
    clipped = D.histogram(df, "x", 10, 5, 20).orderBy("bin").collect()
    assert [r["count"] for r in clipped] == np.histogram(frame.x.clip(5, 20), 10)[0].tolist()


def test_histogram_of_one_value(spark):
    df = spark.createDataFrame([(4.0,), (4.0,)], "x double")
    rows = D.histogram(df, "x", 4).orderBy("bin").collect()
    counts, edges = np.histogram([4.0, 4.0], 4)
    assert [r["count"] for r in rows] == counts.tolist()
    assert rows[0]["left_edge"] == edges[0]


def test_density(numbers):
    frame, df = numbers
    x = frame.x.to_numpy()
    h = x.std(ddof=1) * len(x) ** -0.2
    grid = np.linspace(x.min(), x.max(), 40)
    want = np.exp(-0.5 * ((grid[:, None] - x) / h) ** 2).sum(1) / (len(x) * h * math.sqrt(2 * math.pi))
    got = D.density(df, "x", 40).orderBy("point").collect()
    assert [r["x"] for r in got] == pytest.approx(grid.tolist())
    assert [r["density"] for r in got] == pytest.approx(want.tolist())
    assert D.density(df, "x", 40, "g", (0, 1)).count() == 80


def test_box_stats(numbers):
    frame, df = numbers
    for row in D.box_stats(df, "x", "g", (0, 1)).collect():
        x = frame.x[frame.g == row["g"]]
        q1, q3 = x.quantile(0.25), x.quantile(0.75)
        inside = x[(x >= q1 - 1.5 * (q3 - q1)) & (x <= q3 + 1.5 * (q3 - q1))]
        assert (row["q1"], row["q3"]) == pytest.approx((q1, q3))
        assert (row["whisker_low"], row["whisker_high"]) == (inside.min(), inside.max())
        assert row["n_outliers"] == len(x) - len(inside)


def test_correlation_with_missing_and_constant_columns(spark):
    rng = np.random.default_rng(1)
    frame = pd.DataFrame({"a": rng.normal(1e6, 3, 200), "c": 1.0})
    frame["b"] = frame.a * 2 + rng.normal(0, 4, 200)
    frame.loc[::7, "a"] = None
    frame.loc[::5, "b"] = None
    rows = [tuple(None if pd.isna(v) else float(v) for v in r) for r in frame.itertuples(index=False)]
    got = {(r["a"], r["b"]): r["r"] for r in
           D.correlation(spark.createDataFrame(rows, "a double, c double, b double"), ["a", "b", "c"]).collect()}
    want = frame.corr()
    assert got["a", "b"] == got["b", "a"] == pytest.approx(want.loc["a", "b"], abs=1e-6)
    assert got["a", "a"] == 1.0
    assert got["a", "c"] is None and got["c", "c"] is None


def test_profile_of_nulls_and_copies(spark):
    df = spark.createDataFrame(
        [("unknown", 1), ("unknown", 1), (None, None), (None, None), ("a", 2)], "job string, n int")
    assert tuple(P.duplicates(df).first()) == (5, 3, 2)
    assert {r["column"]: r["n_null"] for r in P.null_summary(df).collect()} == {"job": 2, "n": 2}
    assert {r["column"]: r["n_distinct"] for r in P.cardinality(df).collect()} == {"job": 3, "n": 3}
    approx = {r["column"]: r["n_distinct"] for r in P.cardinality_approx(df).collect()}
    assert approx == {"job": 3, "n": 3}
    rate = P.sentinel_rates(df, {"job": "unknown"}).first()
    assert (rate["n_sentinel"], rate["pct"]) == (2, 40.0)


def test_profiles_of_no_rows(spark):
    df = spark.createDataFrame([], "job string, n int")
    assert tuple(P.duplicates(df).first()) == (0, 0, 0)
    assert tuple(P.sentinel_rates(df, {"job": "unknown"}).first()) == ("job", 0, None)
    assert P.positive_rate(df, "n").first()[0] is None
    assert P.shape(df).first()["n_rows"] == 0


def test_value_samples(clients):
    samples = P.value_samples(clients.drop("row_id"))
    assert samples.groupBy("column").count().agg(F.max("count")).first()[0] == 6


def test_quantiles_approx_is_close(clients):
    shares = {"p50": 0.5, "p99": 0.99}
    exact = {r["column"]: r for r in P.quantiles(clients, ["balance"], shares).collect()}["balance"]
    rough = P.quantiles_approx(clients, ["balance"], shares).first()
    n = clients.count()
    for name, share in shares.items():
        rank = clients.where(F.col("balance") <= rough[name]).count() / n
        assert rank == pytest.approx(share, abs=0.001)
        assert abs(exact[name] - rough[name]) <= abs(exact[name]) * 0.05


def test_running_counts_read_the_table_once(spark, numbers):
    """The counts are stored: nothing behind them is in the plan of the result."""
    from ledgerline.operators import layout as L
    _, df = numbers
    plan = L.plan_text(O.running_counts(O.value_counts(df, "x", ["g"]), "x", by=["g"]))
    assert "value-counts-" in plan and "RDD" not in plan and "LocalTableScan" not in plan


def test_density_meets_only_near_points(numbers):
    from ledgerline.operators import layout as L
    frame, df = numbers
    wide = df.select("x").unionByName(df.select((F.col("x") + 10_000).alias("x")))
    got = D.density(wide, "x", 64).orderBy("point").collect()
    values_ = [*frame.x.dropna(), *(frame.x.dropna() + 10_000)]
    n = len(values_)
    h = pd.Series(values_).std() * n**-0.2
    for r in got:
        want = sum(math.exp(-0.5 * ((r["x"] - v) / h) ** 2) for v in values_) / (n * h * math.sqrt(2 * math.pi))
        assert r["density"] == pytest.approx(want, abs=1e-15)
    assert [r["point"] for r in got] == list(range(64))


def test_density_of_nothing_and_of_one_value(spark):
    df = spark.createDataFrame([(3.0,)] * 4, "x double")
    assert D.density(df.limit(0), "x", 5).count() == 0
    assert [(r["x"], r["density"]) for r in D.density(df, "x", 3).collect()] == [(3.0, None)] * 3


def test_value_samples_order_numbers_as_numbers(spark):
    df = spark.createDataFrame([(n, str(n), n / 2) for n in (100, 9, 20, -3, 9)], "n int, t string, d double")
    got = {(r["column"], r["position"]): r["value"] for r in P.value_samples(df, per_column=3).collect()}
    assert [got["n", i] for i in (1, 2, 3)] == ["-3", "9", "20"]
    assert [got["t", i] for i in (1, 2, 3)] == ["-3", "100", "20"]
    assert [got["d", i] for i in (1, 2, 3)] == ["-1.5", "4.5", "10.0"]
