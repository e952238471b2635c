"""Places in a total order without a global sort."""

import random

from pyspark.sql import functions as F

from ledgerline.operators import ordered
from ledgerline.session import fresh_dir
from ledgerline.sources.files import store


def test_row_numbers_are_gapless_and_in_order(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice([None, 1.5, 2.5, *map(float, range(40))])) for i in range(4000)]
    df = store(spark.createDataFrame(rows, "k int, v double").repartition(7), fresh_dir(spark, "order"))
    got = ordered.row_numbers(df, [F.desc_nulls_last("v"), F.asc("k")]).collect()
    want = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))
    assert [(r["k"], r["v"]) for r in sorted(got, key=lambda r: r["place"])] == want
    assert sorted(r["place"] for r in got) == list(range(1, 4001))


def test_equal_rows_are_spread(spark):
    """One value in every row still gives every row a place, over several partitions."""
    df = store(spark.range(20_000).select(F.lit(1).alias("v")), fresh_dir(spark, "equal"))
    placed = ordered.row_numbers(df, [F.asc("v")])
    assert sorted(r["place"] for r in placed.collect()) == list(range(1, 20_001))
    parts = placed.inputFiles()
    assert len(parts) >= 4 and max(spark.read.parquet(p).count() for p in parts) < 10_000
    assert ordered.row_numbers(df.limit(0), [F.asc("v")]).count() == 0
