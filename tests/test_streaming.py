import os

import pytest
from tests.helpers import values
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from ledgerline import schemas, session
from ledgerline.plans import transaction_job
from ledgerline.sources import files
from ledgerline.streaming import runner, windows as T

DAY = "2026-01-01T"
# One file per micro-batch: (time, amount). The fourth is ten minutes late.
SCRIPT = [
    [("00:00:10", 1.0), ("00:00:59", 2.0)],
    [("00:10:00", 5.0)],
    [("00:10:05", 7.0)],
    [("00:00:20", 100.0)],
    [("00:20:00", 1.0)],
]
COLUMNS = ("minute", "n_txn", "total_amount")


def line(number, time, amount, job="a"):
    stamp = f'"{DAY}{time}.000000"' if time else "null"
    return (f'{{"txn_id":"{number}","account_id":"A","job":"{job}","amount":{amount},'
            f'"currency":"EUR","txn_time":{stamp}}}')


@pytest.fixture()
def late_folder(tmp_path):
    """The scripted files, with rising modification times."""
    for i, rows in enumerate(SCRIPT):
        path = tmp_path / f"b{i}.json"
        path.write_text("\n".join(line(f"{i}-{k}", *row) for k, row in enumerate(rows)))
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))
    return str(tmp_path)


@pytest.fixture(scope="module")
def streams(spark):
    return session.stream_session(spark)


def minutes(df):
    return df.withColumn("minute", F.minute("window_start"))


def run_mode(streams, folder, mode):
    result = T.flatten(transaction_job.window_stream(streams, folder))
    base = session.fresh_dir(streams, mode)
    query = runner.run_available(runner.to_versions(result, f"{base}/out", f"{base}/state", mode))
    return minutes(runner.read_versions(streams, f"{base}/out", result.schema)), query


def test_complete_accepts_late_rows(streams, late_folder):
    versions, _ = run_mode(streams, late_folder, "complete")
    assert values(runner.last_version(versions), *COLUMNS) == [(0, 3, 103.0), (10, 2, 12.0), (20, 1, 1.0)]


def test_update_drops_late_rows(streams, late_folder):
    versions, _ = run_mode(streams, late_folder, "update")
    assert values(versions, *COLUMNS) == [
        (0, 2, 3.0), (10, 1, 5.0), (10, 2, 12.0), (20, 1, 1.0)]
    newest = runner.newest_per_key(versions, ["minute", "job"])
    assert values(newest, *COLUMNS) == [(0, 2, 3.0), (10, 2, 12.0), (20, 1, 1.0)]


def test_append_emits_closed_windows_once(streams, late_folder):
    base = session.fresh_dir(streams, "archive")
    query = transaction_job.archive(
        streams, late_folder, f"{base}/out", f"{base}/state", files_per_trigger=1)
    out = minutes(streams.read.parquet(f"{base}/out"))
    assert values(out, *COLUMNS) == [(0, 2, 3.0), (10, 2, 12.0)]
    progress = [p for p in query.recentProgress if p["numInputRows"]]
    assert [p["numInputRows"] for p in progress] == [2, 1, 1, 1, 1]
    assert sum(p["stateOperators"][0]["numRowsDroppedByWatermark"] for p in query.recentProgress) == 1


def test_batch_and_stream_share_the_transformation(streams, late_folder):
    batch = T.windowed(T.tag(files.read_transactions(streams, late_folder)))
    versions, _ = run_mode(streams, late_folder, "complete")
    columns = ("window_start", "window_end", "job", "n_txn", "total_amount", "n_suspicious")
    assert values(T.flatten(batch), *columns) == values(runner.last_version(versions), *columns)


def test_memory_table_by_name(streams, late_folder):
    stream = transaction_job.window_stream(streams, late_folder, seconds=3600, threshold=50.0)
    assert stream.isStreaming
    query = runner.run_available(runner.to_memory(stream, "txn_windows"))
    assert not query.isActive
    rows = streams.sql("SELECT * FROM txn_windows ORDER BY window, job").collect()
    assert [(r["n_txn"], r["total_amount"], r["n_suspicious"]) for r in rows] == [(6, 116.0, 1)]
    rolled = T.rollup(streams.table("txn_windows")).first()
    assert (rolled["job"], rolled["n_txn"], rolled["n_suspicious"]) == ("a", 6, 1)


def test_console_run_stops_in_time(streams, late_folder, capfd):
    base = session.fresh_dir(streams, "console")
    query = transaction_job.watch(streams, late_folder, base, run_seconds=8)
    assert not query.isActive and query.exception() is None


def test_order_newest_window_first(streams, late_folder):
    batch = T.windowed(T.tag(files.read_transactions(streams, late_folder)))
    starts = [r["window"]["start"] for r in T.latest_first(batch).collect()]
    assert starts == sorted(starts, reverse=True)


def test_sort_needs_complete_mode(streams, late_folder):
    result = T.latest_first(transaction_job.window_stream(streams, late_folder))
    base = session.fresh_dir(streams, "refused")
    with pytest.raises(AnalysisException) as refused:
        runner.to_versions(result, f"{base}/out", f"{base}/state", "append").start()
    assert "STREAMING" in refused.value.getCondition() or "sort" in str(refused.value).lower()


def test_rows_without_time_or_job(streams, tmp_path):
    (tmp_path / "x.json").write_text("\n".join([
        line(1, None, 3.0), line(2, "00:00:01", 4.0).replace('"a"', "null"), line(3, "00:00:02", "null")]))
    rows = T.windowed(T.tag(files.read_transactions(streams, str(tmp_path)))).orderBy("job").collect()
    assert [(r["job"], r["n_txn"], r["total_amount"], r["n_suspicious"]) for r in rows] == [
        (None, 1, 4.0, 0), ("a", 1, None, None)]


def test_restart_resumes_from_the_checkpoint(streams, spark):
    base = session.fresh_dir(streams, "resume")
    schema = schemas.TRANSACTION
    stamp = F.col("txn_time").cast("timestamp")

    def arrival(*rows):
        texts = [(str(i), "A", "a", amount, "EUR", f"2026-01-01 {time}") for i, (time, amount) in enumerate(rows)]
        return spark.createDataFrame(
            texts, "txn_id string, account_id string, job string, amount double, currency string, txn_time string"
        ).withColumn("txn_time", stamp).select(*schema.names)

    def attach(stream):
        return runner.to_files(T.flatten(T.windowed(T.tag(stream))), f"{base}/out", f"{base}/state")

    parts = [arrival(("00:00:10", 1.0)), arrival(("00:00:30", 2.0)), arrival(("00:09:00", 3.0))]
    runner.run_arrivals(streams, parts, f"{base}/in", attach)
    out = minutes(spark.read.parquet(f"{base}/out"))
    assert values(out, *COLUMNS) == [(0, 2, 3.0)]


def test_repeated_micro_batch_leaves_no_doubles(streams, spark):
    path = session.fresh_dir(spark, "retry")
    batch = spark.range(3)
    for _ in range(2):
        batch.write.mode("overwrite").parquet(f"{path}/batch_id=0")
    assert runner.read_versions(spark, path, batch.schema).count() == 3


# --- Sliding windows, several sinks, scores inside a stream --------------------

SLID = ("window_start", "window_end", "job", "n_txn", "total_amount", "n_suspicious")


def test_sliding_windows_by_hand(streams, tmp_path):
    (tmp_path / "x.json").write_text("\n".join([
        line(1, "00:01:00", 4.0), line(2, "00:01:09", 6000.0), line(3, "00:01:55", 1.0), line(4, None, 9.0)]))
    txns = files.read_transactions(streams, str(tmp_path))
    rows = T.flatten(T.sliding(T.tag(txns))).withColumn("at", F.date_format("window_start", "mm:ss")).collect()
    assert {r["at"]: (r["n_txn"], r["total_amount"], r["n_suspicious"]) for r in rows} == {
        **{at: (2, 6004.0, 1) for at in ("00:10", "00:20", "00:30", "00:40", "00:50")},
        "01:00": (3, 6005.0, 1), **{at: (1, 1.0, 0) for at in ("01:10", "01:20", "01:30", "01:40", "01:50")}}
    with pytest.raises(ValueError, match="multiple"):
        T.sliding(T.tag(txns), 60, 25)
    assert T.sliding(T.tag(txns.limit(0))).count() == 0


def test_sliding_equals_spark_windows_and_repeats_panes_only(streams, spark, small):
    from ledgerline.operators import layout as L
    from ledgerline.sources import standin

    txns = T.tag(standin.transactions(spark, small), 100.0)
    want = txns.groupBy(F.window("txn_time", "30 minutes", "10 minutes"), "job").agg(
        F.count(F.lit(1)).alias("n_txn"), F.round(F.sum("amount"), 2).alias("total_amount"), F.sum("suspicious").alias("n_suspicious"))
    slid = T.sliding(txns, 1800, 600)
    assert values(T.flatten(slid), *SLID) == values(T.flatten(want), *SLID)
    plan = L.plan_text(slid, "simple")
    assert plan.index("Expand") < plan.rindex("partial_count")  # printed from the top: panes are summed below


def test_sliding_stream_equals_closed_batch_windows(streams, late_folder):
    """One file per micro-batch, one late row: what was closed before it came stays as it was."""
    stream = files.stream_transactions(streams, late_folder)
    result = T.flatten(T.sliding(T.tag(stream)))
    base = session.fresh_dir(streams, "slide")
    runner.run_available(runner.to_files(result, f"{base}/out", f"{base}/state"))
    on_time = files.read_transactions(streams, late_folder).where("amount <> 100")
    closed = T.flatten(T.sliding(T.tag(on_time))).where(f"window_end <= timestamp '{DAY[:-1]} 00:18:00'")
    got = values(streams.read.parquet(f"{base}/out"), *SLID)
    assert got == values(closed, *SLID) and len(got) > 10


def test_two_sinks_stay_equal_after_a_failure_between_them(streams, late_folder):
    base = session.fresh_dir(streams, "two")
    stream = T.tag(files.stream_transactions(streams, late_folder))
    fails = {"left": 1}
    archive, downstream = runner.parquet_sink(f"{base}/archive"), runner.json_sink(f"{base}/downstream")

    def fragile(batch, batch_id):
        if batch_id == 2 and fails["left"]:
            fails["left"] -= 1
            raise RuntimeError("downstream is away")
        downstream(batch, batch_id)

    def attach():
        return runner.to_sinks(stream, {"archive": archive, "downstream": fragile}, f"{base}/committed", f"{base}/state")

    def read(sink, kind):
        return values(runner.read_committed(streams, f"{base}/{sink}", f"{base}/committed", stream.schema, kind))

    with pytest.raises(Exception, match="downstream is away"):
        runner.run_available(attach())
    # The archive has batch 2, but readers see only what reached both.
    raw = streams.read.parquet(f"{base}/archive").select("batch_id").distinct().count()
    assert raw == 3
    assert {r[0] for r in read("archive", "parquet")} == {r[0] for r in read("downstream", "json")}
    assert len(read("archive", "parquet")) == 3
    runner.run_available(attach())
    both = read("archive", "parquet"), read("downstream", "json")
    assert both[0] == both[1] and len(both[0]) == 6
    assert streams.read.parquet(f"{base}/committed").select("batch_id").distinct().count() == 5


def test_each_batch_is_computed_once_for_all_sinks(streams, late_folder):
    base = session.fresh_dir(streams, "once")
    seen = streams.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    stream = files.stream_transactions(streams, late_folder).mapInArrow(count, schemas.TRANSACTION)
    sinks = {k: runner.parquet_sink(f"{base}/{k}") for k in ("a", "b", "c")}
    runner.run_available(runner.to_sinks(stream, sinks, f"{base}/committed", f"{base}/state"))
    assert seen.value == 6


def test_scores_inside_a_stream_keep_unseen_categories(streams, spark, tmp_path):
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from ledgerline.operators import features as X, models as M

    train = spark.createDataFrame(
        [(j, float(i), int(i % 3 == 0)) for i, j in enumerate("aabbabab" * 5)], "job string, age double, y int")
    stages = [*X.preparation(["job"], ["age"]), LogisticRegression(labelCol="y", featuresCol=X.FEATURES)]
    path = f"{tmp_path}/model"
    M.save(Pipeline(stages=stages).fit(train), path)
    clients = spark.createDataFrame([(1, "a"), (2, "never seen"), (3, "b")], "client_id int, job string")
    folder = f"{tmp_path}/calls"
    spark.createDataFrame([(1, 3.0), (2, 4.0), (3, 5.0), (9, 6.0)], "client_id int, age double").write.json(folder)
    calls = streams.readStream.schema("client_id int, age double").json(folder)
    joined = calls.join(clients, "client_id")
    result = M.predict(M.load(path), joined).select("client_id", "score")
    base = session.fresh_dir(streams, "score")
    runner.run_available(runner.to_files(result, f"{base}/out", f"{base}/state"))
    got = values(spark.read.parquet(f"{base}/out"), "client_id", "score")
    batch = spark.read.schema("client_id int, age double").json(folder).join(clients, "client_id")
    assert got == values(M.predict(M.load(path), batch), "client_id", "score") and [r[0] for r in got] == [1, 2, 3]
