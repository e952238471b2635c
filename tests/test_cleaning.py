from pyspark.sql import functions as F

from ledgerline import schemas
from ledgerline.functions import columns as C
from ledgerline.operators import cleaning, segments as S
from ledgerline.plans import reports


def raw_rows(spark, **columns):
    """Raw campaign rows with the given columns and NULL elsewhere."""
    n = len(next(iter(columns.values())))
    rows = [
        tuple(columns[f.name][i] if f.name in columns else None for f in schemas.RAW_CAMPAIGN)
        for i in range(n)
    ]
    return spark.createDataFrame(rows, schemas.RAW_CAMPAIGN)


def column(df, name):
    return [r[0] for r in df.select(name).collect()]


def test_sentinels(spark):
    out = cleaning.clean(raw_rows(spark, job=["x", "unknown", None, "y"], pdays=[-1, 0, 5, None]))
    assert column(out, "job") == ["x", None, None, "y"]
    assert column(out, "pdays") == [0, 0, 5, None]
    assert column(out, "never_contacted_before") == [1, 0, 0, None]


def test_flags(spark):
    out = cleaning.clean(raw_rows(spark, y=["yes", "no", "YES", "", None]))
    assert column(out, "y") == [1, 0, 0, 0, None]


def test_bucket_edges(spark):
    ages = [29, 30, 44, 45, 59, 60, None]
    out = cleaning.clean(raw_rows(spark, age=ages))
    assert column(out, "age_bucket") == ["young", "mid", "mid", "senior", "senior", "retired", "retired"]
    balances = [-1, 0, 499, 500, 1999, 2000, 9999, 10000, None]
    out = cleaning.clean(raw_rows(spark, balance=balances))
    assert column(out, "balance_bucket") == [
        "negative", "low", "low", "mid", "mid", "high", "high", "vip", "vip"]


def test_clean_schema(spark):
    out = cleaning.clean(raw_rows(spark, age=[30]))
    kinds = {f.name: f.dataType for f in out.schema}
    assert kinds == {f.name: f.dataType for f in schemas.CLEAN_CAMPAIGN}


def test_clean_is_one_projection(spark):
    plan = cleaning.clean(raw_rows(spark, age=[30]))._jdf.queryExecution().analyzed().toString()
    assert plan.count("Project") == 1


def test_rounding_and_clip(spark):
    df = spark.createDataFrame([(17,), (None,), (100,)], "duration int")
    out = df.select(F.round(F.col("duration") / 60, 2), C.clip("duration", 20, 50))
    assert [tuple(r) for r in out.collect()] == [(0.28, 20), (None, None), (1.67, 50)]


def test_above_is_strict(spark):
    df = spark.createDataFrame([(5.0,), (5.1,), (None,)], "amount double")
    assert column(df.select(C.above("amount", 5.0).alias("s")), "s") == [0, 1, None]


def test_fill_missing(spark):
    out = cleaning.fill_missing(cleaning.clean(raw_rows(spark, job=["unknown", "a"], marital=[None, "b"])))
    assert column(out, "job") == ["missing", "a"]
    assert column(out, "marital") == ["missing", "b"]
    assert column(out, "y") == [None, None]


def test_unknown_label_does_not_merge_groups(spark):
    df = spark.createDataFrame([("unknown", 1), (None, 0), (None, 1)], "education string, y int")
    out = S.segment(df, ["education"], [S.measure_count("n")], unknown="unknown")
    assert sorted(tuple(r) for r in out.collect()) == [("unknown", 1), ("unknown", 2)]
    merged = S.rate_by(df, "education", "y", "unknown")
    assert merged.count() == 1


def test_rank_ties(spark):
    df = spark.createDataFrame([("a", 1), ("b", 1), ("c", 0)], "poutcome string, y int")
    out = S.ranked(df, "poutcome", "y", "unknown", [S.measure_count("n")])
    assert {r["poutcome"]: r["rate_rank"] for r in out.collect()} == {"a": 1, "b": 1, "c": 3}


def test_calendar_keeps_absent_months(spark):
    df = spark.createDataFrame([("mar", 1), ("jan", 0), ("dec", 1)], "month string, y int")
    rows = reports.month_calendar(df).collect()
    assert [r["month"] for r in rows] == list(schemas.MONTHS)
    assert [r["rate_pct"] for r in rows].count(None) == 9


def test_reports_are_sorted(clients):
    for name, report in reports.REPORTS.items():
        rates = [r[reports.RATE] for r in report.run(clients).collect()]
        assert rates == sorted(rates, reverse=True), name
    assert [r["age_bucket"] for r in reports.age_bucket_rates(clients).collect()] == list(schemas.AGE_LABELS)


def test_reports_on_no_rows(spark, clients):
    none = clients.limit(0)
    assert reports.REPORTS["job"].run(none).count() == 0
    assert reports.duration_cohort(none).count() == 0
