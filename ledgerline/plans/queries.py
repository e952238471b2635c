"""Every operator as a query over the given tables: name -> (spark, folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Pipeline
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerline import schemas
from ledgerline.functions import columns as C
from ledgerline.operators import (
    cleaning, contacts as K, distributions as D, evaluation as E, features as X, hypothesis as H,
    joins as J, layout as L, models as M, profiling as P, rolling, sampling, segments as S,
)
from ledgerline.plans import reports as R
from ledgerline.plans.training import model_table, stored_split
from ledgerline.session import ensure_checkpoint_dir, fresh_dir, stream_session
from ledgerline.sources import files, standin, warehouse as W
from ledgerline.streaming import runner, windows as T

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

KEY = "row_id"
CLASSES = (0, 1)
THRESHOLD = 100.0  # the event values stay below 500
SHARES = {"p01": 0.01, "p50": 0.5, "p99": 0.99}
OUTLIER_COLUMNS = ("balance", "campaign", "previous", "pdays")


def query(name: str):
    def register(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return register


def raw(spark: SparkSession, folder: str) -> DataFrame:
    return standin.campaign(spark, folder)


def raw_only(spark: SparkSession, folder: str) -> DataFrame:
    """The 17 campaign columns without the added key."""
    return raw(spark, folder).drop(KEY)


def clients(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.clean(raw(spark, folder))


def on_clients(name: str, fn: Callable[[DataFrame], DataFrame]) -> None:
    REGISTRY[name] = lambda spark, folder: fn(clients(spark, folder))


def on_raw(name: str, fn: Callable[[DataFrame], DataFrame]) -> None:
    REGISTRY[name] = lambda spark, folder: fn(raw(spark, folder))


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), digits) for c in columns})


# --- Sources and warehouse ---------------------------------------------------

@query("src_csv_roundtrip")
def src_csv(spark, folder):
    path = fresh_dir(spark, "campaign-csv")
    files.write_csv(raw_only(spark, folder), path)
    return files.read_campaign_csv(spark, path)


@query("src_json_roundtrip")
def src_json(spark, folder):
    path = fresh_dir(spark, "txn-json")
    files.write_transactions(standin.transactions(spark, folder), path)
    return files.read_transactions(spark, path)


_made: dict[tuple, object] = {}


def once(spark: SparkSession, purpose: str, of: str, make: Callable):
    """What ``make`` returns, made once per application and input for all queries that need it."""
    key = (spark.sparkContext.applicationId, purpose, of)
    if key not in _made:
        _made[key] = make()
    return _made[key]


def stored(spark: SparkSession, folder: str) -> str:
    """Clean table written as a month-partitioned warehouse."""
    def make():
        path = fresh_dir(spark, "warehouse")
        W.write_warehouse(clients(spark, folder).drop(KEY), path)
        return path

    return once(spark, "warehouse", folder, make)


def registered(spark: SparkSession, folder: str) -> str:
    """Name of an external table over the warehouse folder."""
    path = stored(spark, folder)
    table = "bank_clients_" + path.rsplit("-", 1)[1]
    if not spark.catalog.tableExists(table):
        W.register_table(spark, table, path)
    return table


@query("wh_partition_scan")
def wh_partition_scan(spark, folder):
    return spark.read.parquet(stored(spark, folder))


@query("wh_partition_prune")
def wh_partition_prune(spark, folder):
    """Only the folders of two months are read."""
    table = spark.read.parquet(stored(spark, folder))
    return table.where(F.col("month").isin("mar", "sep")).groupBy("month").agg(
        F.count(F.lit(1)).alias("n_calls"), F.sum("duration").alias("total_duration")
    )


@query("wh_table_scan")
def wh_table_scan(spark, folder):
    return spark.table(registered(spark, folder))


@query("wh_show_partitions")
def wh_show_partitions(spark, folder):
    return W.list_partitions(spark, registered(spark, folder))


@query("wh_report_job")
def wh_report_job(spark, folder):
    """The flagship report over the registered table, as SQL users run it."""
    return R.REPORTS["job"].run(spark.table(registered(spark, folder)))


@query("wh_sql_report")
def wh_sql_report(spark, folder):
    """A report as plain SQL text over the registered table."""
    return spark.sql(f"""
        SELECT `default`, age_bucket, count(*) AS n_clients,
               round(100.0 * avg(y), 2) AS subscription_rate_pct
        FROM {registered(spark, folder)}
        WHERE month IN ('may', 'jun', 'jul') AND job IS NOT NULL
        GROUP BY `default`, age_bucket
        ORDER BY subscription_rate_pct DESC
    """)


BUCKETS = 4  # files per month folder, and tasks of a join of small tables


def bucketed(spark: SparkSession, folder: str, buckets: int = BUCKETS) -> tuple[str, str]:
    """Contacts by year and month in buckets by client, and the client table in the same buckets."""
    def make():
        root = fresh_dir(spark, "bucketed")
        names = tuple(f"{t}_{root.rsplit('-', 1)[1]}" for t in ("contacts", "profiles"))
        W.write_bucketed(standin.contacts(spark, folder), names[0], f"{root}/contacts", buckets, "client_id")
        W.write_bucketed(standin.profiles(spark, folder), names[1], f"{root}/profiles", buckets, "client_id", ())
        return names

    return once(spark, f"bucketed-{buckets}", folder, make)


@query("wh_bucketed_join")
def wh_bucketed_join(spark, folder):
    """Contacts with their clients, bucket by bucket, without a shuffle below the join."""
    contacts, profiles = bucketed(spark, folder)
    joined = spark.table(contacts).join(spark.table(profiles).hint("merge"), "client_id")
    return joined.groupBy("year", "job").agg(
        F.count(F.lit(1)).alias("n_contacts"), F.round(F.sum("amount"), 2).alias("total_amount"),
        F.round(F.avg("balance"), 4).alias("avg_balance"))


@query("wh_bucketed_client")
def wh_bucketed_client(spark, folder):
    """One client's contacts of three years: one bucket of the folders of these years is read."""
    contacts, _ = bucketed(spark, folder)
    return spark.table(contacts).where("client_id = 7 and year in (1996, 1997, 1998)").select(
        "row_id", "contact_date", "year", "month")


@query("contact_rate_limit")
def contact_rate_limit(spark, folder):
    """Which contacts take place when a client is contacted once in 90 days."""
    return K.rate_limit(standin.contacts(spark, folder), "client_id", "contact_date", "row_id").select(
        "row_id", "client_id", "contact_date", "allowed")


# --- Cleaning ----------------------------------------------------------------

on_clients("clean_sentinel_null", lambda df: df.select(KEY, *schemas.NULLABLE_CATEGORIES))
on_clients("clean_pdays", lambda df: df.select(KEY, "pdays", "never_contacted_before"))
on_clients("clean_flags", lambda df: df.select(KEY, *schemas.YES_NO))
on_clients("clean_age_bucket", lambda df: df.select(KEY, "age", "age_bucket"))
on_clients("clean_balance_bucket", lambda df: df.select(KEY, "balance", "balance_bucket"))
on_clients("clean_duration_min", lambda df: df.select(KEY, "duration", "duration_min"))
on_clients("clean_full", lambda df: df)
on_clients(
    "clean_fill_missing",
    lambda df: cleaning.fill_missing(df).select(KEY, *schemas.CATEGORICAL_FEATURES),
)
on_clients(
    "prj_clip",
    lambda df: df.select(KEY, C.clip("balance", -2000, 20000).alias("balance_clipped"),
                         C.clip("duration", 0, 1500).alias("duration_clipped")),
)
on_clients(
    "feat_class_weight",
    lambda df: rounded(X.with_class_weight(df.select(KEY, "y")), 8, "weight"),
)


# --- Reports -----------------------------------------------------------------

on_clients("seg_job", R.REPORTS["job"].run)
on_clients("seg_month", R.REPORTS["month"].run)
on_clients("seg_balance_bucket", R.REPORTS["balance_bucket"].run)
on_clients("seg_education", R.REPORTS["education"].run)
on_clients("seg_contact", R.REPORTS["contact"].run)
on_clients("seg_housing_loan", R.REPORTS["housing_loan"].run)
on_clients("seg_poutcome", R.REPORTS["poutcome"].run)
on_clients("seg_duration_cohort", R.duration_cohort)
on_clients("seg_poutcome_rank", R.poutcome_rank)
on_clients("seg_month_calendar", lambda df: rounded(R.month_calendar(df), 6, "rate_pct"))
on_clients("seg_age_bucket", lambda df: rounded(R.age_bucket_rates(df), 6, "rate"))
on_clients("seg_job_rate_count", lambda df: rounded(R.job_rate_and_count(df), 6, "mean"))
on_clients(
    "seg_contact_rate",
    lambda df: rounded(S.rate_by(df, "contact", "y", schemas.UNKNOWN), 6, "rate_pct"),
)
on_clients(
    "seg_poutcome_rate",
    lambda df: rounded(S.rate_by(df, "poutcome", "y", schemas.UNKNOWN), 6, "rate_pct"),
)


# --- Profiles ----------------------------------------------------------------

REGISTRY["prof_shape"] = lambda spark, folder: P.shape(raw_only(spark, folder))
REGISTRY["prof_duplicates"] = lambda spark, folder: P.duplicates(raw_only(spark, folder))
REGISTRY["prof_duplicates_union"] = lambda spark, folder: P.duplicates(
    L.times(raw_only(spark, folder), 3)
)
REGISTRY["prof_null_summary"] = lambda spark, folder: P.null_summary(clients(spark, folder))
on_raw("prof_sentinel_rate", lambda df: P.sentinel_rates(
    df, {**dict.fromkeys(schemas.NULLABLE_CATEGORIES, schemas.UNKNOWN),
         "pdays": schemas.NEVER_CONTACTED}))
REGISTRY["prof_cardinality"] = lambda spark, folder: P.cardinality(
    clients(spark, folder).drop(KEY)
)
REGISTRY["prof_cardinality_approx"] = lambda spark, folder: P.cardinality_approx(
    clients(spark, folder).drop(KEY)
)
REGISTRY["prof_value_samples"] = lambda spark, folder: P.value_samples(raw_only(spark, folder))
REGISTRY["prof_describe"] = lambda spark, folder: P.describe(
    raw_only(spark, folder),
    [f.name for f in schemas.RAW_CAMPAIGN if f.dataType.simpleString() == "int"],
)
on_clients("prof_quantiles", lambda df: P.quantiles(df, OUTLIER_COLUMNS, SHARES))
on_clients("prof_quantiles_approx", lambda df: P.quantiles_approx(df, OUTLIER_COLUMNS, SHARES))
def _approx_bounds(df: DataFrame) -> DataFrame:
    """Exact distinct counts, and whether the sketch is within three of its standard errors (5 %)."""
    table = df.drop(KEY)
    exact, near = P.cardinality(table), P.cardinality_approx(table).withColumnRenamed("n_distinct", "sketched")
    within = F.abs(F.col("sketched") - F.col("n_distinct")) <= F.greatest(F.lit(1.0), 0.15 * F.col("n_distinct"))
    return exact.join(near, "column", "full").select("column", "n_distinct", F.coalesce(within, F.lit(False)).alias("within"))


def _approx_quantile_bounds(df: DataFrame) -> DataFrame:
    """Whether each sketched quantile is a value whose rank is off by no more than the sketch's promise."""
    near = P.quantiles_approx(df, OUTLIER_COLUMNS, SHARES, 1000)
    numbers = df.select(*[F.col(c).cast("double").alias(c) for c in OUTLIER_COLUMNS]).unpivot(
        [], list(OUTLIER_COLUMNS), "column", "value").where("value is not null")
    ranked = numbers.join(F.broadcast(near), "column").groupBy("column")

    def off(name):  # the rank interval of a value must come within a thousandth of the wanted rank
        below, through = F.avg((F.col("value") < F.col(name)).cast("int")), F.avg((F.col("value") <= F.col(name)).cast("int"))
        share = F.lit(SHARES[name])
        return ((below - 0.001 <= share) & (share <= through + 0.001)).alias(name)

    return ranked.agg(F.count(F.lit(1)).alias("n"), *[off(name) for name in SHARES])


on_clients("prof_cardinality_bounds", _approx_bounds)
on_clients("prof_quantile_bounds", _approx_quantile_bounds)
on_clients("prof_positive_rate", lambda df: rounded(P.positive_rate(df, "y"), 8, "positive_rate"))


# --- Distributions and tests -------------------------------------------------

on_clients("dist_value_counts", lambda df: D.value_counts(df, "job"))
on_clients("dist_value_counts_marital", lambda df: D.value_counts(df, "marital"))
on_clients("dist_value_counts_y", lambda df: D.value_counts(df, "y"))
on_clients("dist_share_marital", lambda df: D.shares(df, "marital"))


def _histogram(column, bins, low=None, high=None):
    return lambda df: rounded(
        D.histogram(df, column, bins, low, high), 6, "left_edge", "right_edge"
    )


on_clients("dist_hist_age", _histogram("age", 30))
on_clients("dist_hist_balance", _histogram("balance", 60, -2000, 20000))
on_clients("dist_hist_duration", _histogram("duration", 60, 0, 1500))
on_clients("dist_median_duration", lambda df: D.median(df, "duration"))
on_clients("dist_kde_age", lambda df: rounded(D.density(df, "age", 200), 8, "x", "density"))
on_clients(
    "dist_density_duration_by_y",
    lambda df: rounded(
        D.density(df.where(F.col("duration") < 1500), "duration", 100, "y", CLASSES),
        8, "x", "density",
    ),
)
on_clients("dist_box_age_by_y", lambda df: D.box_stats(df, "age", "y", CLASSES))
on_clients(
    "dist_box_balance_by_y",
    lambda df: D.box_stats(df.where(F.col("balance").between(-2000, 10000)), "balance", "y", CLASSES),
)
on_clients("stat_correlation", lambda df: D.correlation(df, schemas.CORRELATED))
on_clients("stat_crosstab_housing", lambda df: D.crosstab(df, "housing", "y", CLASSES))
on_clients(
    "stat_crosstab_education",
    lambda df: D.crosstab(df, "education", "y", CLASSES, schemas.UNKNOWN),
)
on_clients(
    "hyp_welch_duration",
    lambda df: rounded(rounded(H.welch(df, "duration", "y"), 6, "t", "dof"), 9, "p_value"),
)
on_clients(
    "hyp_expected_education",
    lambda df: rounded(
        H.expected_counts(df, "education", "y", CLASSES, schemas.UNKNOWN), 6, "expected"
    ),
)


def _chi2(column, **options):
    return lambda df: rounded(
        rounded(H.chi_squared(df, column, "y", CLASSES, **options), 6, "chi2"), 9, "p_value"
    )


on_clients("hyp_chi2_housing", _chi2("housing"))
on_clients("hyp_chi2_housing_uncorrected", _chi2("housing", correction=False))
on_clients("hyp_chi2_education", _chi2("education", unknown=schemas.UNKNOWN))


# --- Joins, set operations and layout ----------------------------------------

JOINED = (KEY, "job", "balance", "y", "sector")


def sectors(spark):
    return files.literal_table(spark, standin.STANDIN_SECTORS, ["job", "sector"])


on_clients(
    "join_sector_default",
    lambda df: J.lookup_join(df, sectors(df.sparkSession), "job").select(*JOINED),
)
on_clients(
    "join_sector_broadcast",
    lambda df: J.broadcast_join(df, sectors(df.sparkSession), "job").select(*JOINED),
)
on_clients(
    "join_sector_sortmerge",
    lambda df: J.shuffle_join(df, sectors(df.sparkSession), "job", [KEY]).select(*JOINED),
)
on_clients("set_union_all", lambda df: L.times(df.select(KEY, "job", "balance"), 3))
on_clients(
    "set_distinct",
    lambda df: df.select("job", "marital", "education", "age_bucket", "balance_bucket").distinct(),
)


def tripled(df: DataFrame) -> DataFrame:
    """Three copies of the columns the layout scenarios need."""
    return L.times(df.select(KEY, "job", "balance"), 3)


def average_balance(df: DataFrame) -> DataFrame:
    return rounded(S.mean_by(df, "job", "balance"), 6, "avg_balance")


on_clients("phys_groupby_default", lambda df: average_balance(tripled(df)))
on_clients(
    "phys_groupby_repartition",
    lambda df: average_balance(L.repartition_by(
        tripled(df), 2 * df.sparkSession.sparkContext.defaultParallelism, "job", [KEY])),
)


def _coalesced(df: DataFrame) -> DataFrame:
    """The columns are stored first: ``coalesce`` also narrows what runs before it, here the join of three copies."""
    spark = df.sparkSession
    held = files.store(df.select(KEY, "job", "balance"), fresh_dir(spark, "coalesced"))
    return average_balance(tripled(held).coalesce(max(2, spark.sparkContext.defaultParallelism // 4)))


on_clients("phys_groupby_coalesce", _coalesced)


@query("phys_groupby_cached")
def phys_groupby_cached(spark, folder):
    """Three aggregations over one cached table; the last result outlives the cache."""
    ensure_checkpoint_dir(spark)
    with L.cached(tripled(clients(spark, folder))) as held:
        for _ in range(2):
            L.run_only(average_balance(held))
        return average_balance(held).checkpoint()


# --- Samples and splits ------------------------------------------------------

on_clients("sample_exact", lambda df: sampling.exact_sample(df.select(KEY, "age", "job", "y"), 800, KEY))
on_clients(
    "sample_pairplot",
    lambda df: sampling.exact_sample(
        df.select(KEY, "age", "balance", "duration", "campaign", "y"), 800, KEY),
)
PAIRED = ("age", "balance", "duration", "campaign")


def _pair_densities(df: DataFrame) -> DataFrame:
    """What a pair plot shows on its diagonal: the density of each column per class in the drawn rows."""
    drawn = sampling.exact_sample(df.select(KEY, *PAIRED, "y"), 800, KEY)
    drawn = files.store(drawn, fresh_dir(df.sparkSession, "pairplot"))
    parts = [
        rounded(D.density(drawn, c, 50, "y", CLASSES), 8, "x", "density").withColumn("column", F.lit(c)) for c in PAIRED]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


on_clients("sample_pairplot_density", _pair_densities)
on_clients(
    "sample_scatter",
    lambda df: sampling.exact_sample(
        df.select(KEY, "campaign", "duration", "y"), 1500, KEY).where(F.col("duration") < 1500),
)
on_clients(
    "sample_fraction", lambda df: sampling.fraction_sample(df.select(KEY, "age", "y"), 0.1, KEY)
)


def _parts(split: tuple[DataFrame, DataFrame]) -> DataFrame:
    train, test = split
    return train.withColumn("part", F.lit("train")).unionByName(
        test.withColumn("part", F.lit("test"))
    )


on_clients(
    "split_random", lambda df: _parts(sampling.random_split(df.select(KEY, "y"), 0.8, KEY))
)
on_clients(
    "split_stratified",
    lambda df: _parts(sampling.stratified_split(df.select(KEY, "y"), 0.8, KEY, "y", CLASSES)),
)


# --- Transactions, batch and stream ------------------------------------------

WINDOWS = ("window_start", "window_end", "job", "n_txn", "total_amount", "n_suspicious")


def windows_of(txns: DataFrame, seconds: int = schemas.WINDOW_SECONDS) -> DataFrame:
    return T.windowed(T.tag(txns, THRESHOLD), seconds)


@query("txn_tag_suspicious")
def txn_tag_suspicious(spark, folder):
    return T.tag(standin.transactions(spark, folder), THRESHOLD).select(
        "txn_id", "amount", "suspicious"
    )


@query("txn_window_batch")
def txn_window_batch(spark, folder):
    return T.flatten(windows_of(standin.transactions(spark, folder))).orderBy("window_start", "job")


@query("txn_window_hourly")
def txn_window_hourly(spark, folder):
    return T.flatten(windows_of(standin.transactions(spark, folder), 3600))


@query("txn_job_rollup")
def txn_job_rollup(spark, folder):
    return T.rollup(windows_of(standin.transactions(spark, folder)))


@query("txn_window_sliding")
def txn_window_sliding(spark, folder):
    """Sixty seconds of transactions, every ten seconds."""
    return T.flatten(T.sliding(T.tag(standin.transactions(spark, folder), THRESHOLD)))


def _zscores(days: int) -> Query:
    def run(spark, folder):
        scored = rolling.rolling_zscore(
            standin.transactions(spark, folder), "amount", "txn_time", ["account_id"], days)
        return rounded(rolling.tag_unusual(scored), 6, "mean_before", "zscore").select(
            "txn_id", "account_id", "n_before", "mean_before", "zscore", "unusual")
    return run


REGISTRY["txn_zscore_30d"] = _zscores(30)
REGISTRY["txn_zscore_7d"] = _zscores(7)


def event_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The event table read as a stream of files.

    The braces make the path a glob, which may name one file or a folder of files.
    """
    schema = spark.read.parquet(f"{folder}/events.parquet").schema
    stream = spark.readStream.schema(schema).parquet(f"{folder}/{{events}}.parquet")
    return standin.as_transactions(stream)


def stream_paths(spark: SparkSession, name: str) -> tuple[str, str, str]:
    root = fresh_dir(spark, name)
    return f"{root}/incoming", f"{root}/out", f"{root}/checkpoint"


@query("stream_append")
def stream_append(spark, folder):
    """Closed windows only; the newest ones wait for the watermark."""
    _, out, state = stream_paths(spark, "append")
    result = T.flatten(windows_of(event_stream(stream_session(spark), folder)))
    runner.run_available(runner.to_files(result, out, state))
    return spark.read.schema(result.schema).parquet(out)


@query("stream_sliding")
def stream_sliding(spark, folder):
    """Closed sliding windows: panes keep state, then windows over panes."""
    _, out, state = stream_paths(spark, "sliding")
    result = T.flatten(T.sliding(T.tag(event_stream(stream_session(spark), folder), THRESHOLD)))
    runner.run_available(runner.to_files(result, out, state))
    return spark.read.schema(result.schema).parquet(out)


@query("stream_two_sinks")
def stream_two_sinks(spark, folder):
    """Tagged transactions in a Parquet archive and as JSON lines for other systems, from one stream."""
    root = fresh_dir(spark, "sinks")
    tagged = T.tag(event_stream(stream_session(spark), folder), THRESHOLD)
    sinks = {"archive": runner.parquet_sink(f"{root}/archive"), "downstream": runner.json_sink(f"{root}/downstream")}
    runner.run_available(runner.to_sinks(tagged, sinks, f"{root}/committed", f"{root}/checkpoint"))
    kinds = {"archive": "parquet", "downstream": "json"}
    parts = [
        runner.read_committed(spark, f"{root}/{sink}", f"{root}/committed", tagged.schema, kind).groupBy("job").agg(
            F.lit(sink).alias("sink"), F.count(F.lit(1)).alias("n_txn"), F.round(F.sum("amount"), 2).alias("total_amount"),
            F.sum("suspicious").alias("n_suspicious"), F.max("txn_time").alias("newest"))
        for sink, kind in kinds.items()
    ]
    return parts[0].unionByName(parts[1])


@query("stream_complete")
def stream_complete(spark, folder):
    """All windows, newest first, rewritten by every micro-batch."""
    _, out, state = stream_paths(spark, "complete")
    result = T.latest_first(windows_of(event_stream(stream_session(spark), folder)))
    runner.run_available(runner.to_versions(result, out, state, "complete"))
    versions = runner.read_versions(spark, out, result.schema)
    return T.flatten(runner.last_version(versions))


@query("stream_update")
def stream_update(spark, folder):
    """Changed windows per micro-batch, reduced to the last state of each."""
    _, out, state = stream_paths(spark, "update")
    result = T.flatten(windows_of(event_stream(stream_session(spark), folder)))
    runner.run_available(runner.to_versions(result, out, state, "update"))
    versions = runner.read_versions(spark, out, result.schema)
    return runner.newest_per_key(versions, WINDOWS[:3]).select(*WINDOWS)


def arrivals(spark: SparkSession, folder: str, late: bool) -> list[DataFrame]:
    """The event table in order of arrival: equal thirds of its time range.

    With ``late`` every twentieth event arrives two deliveries after its time.
    """
    txns = standin.transactions(spark, folder)
    at = F.unix_micros("txn_time")
    span = txns.agg(F.struct(F.min(at).alias("lo"), F.max(at).alias("hi"))).scalar()
    timed = txns.withColumn("_span", span).withColumn(
        "_turn", F.expr("(unix_micros(txn_time) - _span.lo) * 3 div (_span.hi - _span.lo + 1)")
    )
    if late:
        delay = F.when(F.col("txn_id").cast("bigint") % 20 == 0, 2).otherwise(0)
        timed = timed.withColumn("_turn", F.col("_turn") + delay)
    turns = range(5 if late else 3)
    return [timed.where(F.col("_turn") == t).select(*txns.columns) for t in turns]


def _arriving(spark, folder, name, late, mode):
    incoming, out, state = stream_paths(spark, name)
    result_schema = None

    def attach(stream):
        nonlocal result_schema
        result = T.flatten(windows_of(stream, 3600))
        result_schema = result.schema
        if mode == "append":
            return runner.to_files(result, out, state)
        return runner.to_versions(result, out, state, mode)

    runner.run_arrivals(stream_session(spark), arrivals(spark, folder, late), incoming, attach)
    if mode == "append":
        return spark.read.schema(result_schema).parquet(out)
    versions = runner.read_versions(spark, out, result_schema)
    return runner.last_version(versions)


REGISTRY["stream_restart"] = lambda spark, folder: _arriving(spark, folder, "restart", False, "append")
REGISTRY["stream_append_late"] = lambda spark, folder: _arriving(spark, folder, "late", True, "append")
REGISTRY["stream_complete_late"] = lambda spark, folder: _arriving(
    spark, folder, "late-complete", True, "complete"
)


# --- Features and evaluation -------------------------------------------------

def prepared(df: DataFrame) -> DataFrame:
    """All rows with index, one-hot, raw and scaled feature columns."""
    table = model_table(df, KEY)
    return Pipeline(stages=X.preparation()).fit(table).transform(table)


on_clients(
    "feat_string_index",
    lambda df: prepared(df).select(
        KEY, *[F.col(X.index_column(c)).cast("int").alias(c) for c in schemas.CATEGORICAL_FEATURES]),
)


def _one_hot(df: DataFrame) -> DataFrame:
    return X.nonzero_slots(
        prepared(df), {c: X.hot_column(c) for c in schemas.CATEGORICAL_FEATURES}, KEY)


on_clients("feat_one_hot", _one_hot)
on_clients(
    "feat_vector_size",
    lambda df: prepared(df).select(F.size(X.vector_to_array(F.col(X.FEATURES))).alias("size"))
    .groupBy("size").agg(F.count(F.lit(1)).alias("n_rows")),
)
on_clients("feat_slot_names", lambda df: X.slots_table(prepared(df)))


def _scaled(df: DataFrame) -> DataFrame:
    table = prepared(df).withColumn("_v", X.vector_to_array(F.col(X.FEATURES)))
    return table.select(
        KEY, *[F.round(F.col("_v")[i], 6).alias(c) for i, c in enumerate(schemas.NUMERIC_FEATURES)]
    )


on_clients("feat_scaled_numeric", _scaled)


def rule_scores(df: DataFrame) -> DataFrame:
    """A score both engines compute alike, to check metrics without a model."""
    score = (
        F.col("duration") % 1000 + F.when(F.col("poutcome") == "success", 700).otherwise(0)
    ) / 2000
    return df.select(KEY, "y", score.alias("score")).withColumn(
        "prediction", F.when(F.col("score") > 0.5, 1.0).otherwise(0.0)
    )


on_clients("eval_auc", lambda df: rounded(E.auc(rule_scores(df)), 8, "roc_auc"))
on_clients("eval_confusion", lambda df: E.confusion(rule_scores(df)))
on_clients(
    "eval_weighted",
    lambda df: rounded(
        E.weighted_metrics(rule_scores(df)), 8, "f1", "weighted_precision", "weighted_recall"),
)
on_clients(
    "eval_positive_class",
    lambda df: rounded(E.class_metrics(rule_scores(df)), 8, "precision", "recall"),
)
on_clients(
    "eval_bundle",
    lambda df: rounded(
        E.metrics(rule_scores(df)), 8, "roc_auc", "f1", "weighted_precision", "weighted_recall",
        "positive_precision", "positive_recall"),
)


def pr_curve(df: DataFrame) -> DataFrame:
    return E.precision_recall(rule_scores(df))


CURVE = ("threshold", "precision", "recall")
on_clients("eval_pr_curve", lambda df: rounded(pr_curve(df).drop("step"), 8, *CURVE))
on_clients(
    "eval_average_precision",
    lambda df: rounded(E.average_precision(pr_curve(df)), 8, "average_precision"),
)
on_clients("eval_best_threshold", lambda df: rounded(E.best_threshold(pr_curve(df), 1, 8), 8, *CURVE))
on_clients("eval_threshold_capacity", lambda df: rounded(E.threshold_at_capacity(pr_curve(df), 1000), 8, *CURVE))
on_clients(
    "eval_lift_deciles",
    lambda df: rounded(E.lift_by_share(rule_scores(df), KEY), 8, "rate", "lift", "captured", "highest", "lowest"),
)


# --- Models ------------------------------------------------------------------
# Full parameters. Searching the grids of all three candidates is the training
# job's work; here the grid of the logistic regression is searched.

def _source(df: DataFrame) -> str:
    return f"{sorted(df.inputFiles())} {df.semanticHash()}"


def split_model_table(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return once(df.sparkSession, "split", _source(df), lambda: stored_split(df, KEY))


def fitted(name: str, train: DataFrame):
    """The candidate fitted on the stored training part, once for all queries that use it."""
    def make():
        candidate = M.CANDIDATES[name]
        with L.cached(L.spread(train, candidate.rows_per_task)) as held:
            return M.fit(candidate, held)

    return once(train.sparkSession, f"model-{name}", _source(train), make)


def shown(scored: DataFrame) -> DataFrame:
    """Key, label, prediction, probability of the positive class and score."""
    probability = X.vector_to_array(F.col("probability"))[1].alias("probability")
    return rounded(scored.select(KEY, "y", "prediction", probability, "score"), 6, "probability", "score")


def _predictions(name: str):
    def run(df):
        train, test = split_model_table(df)
        return shown(M.predict(fitted(name, train), test))
    return run


on_clients("ml_lr_predictions", _predictions("LogReg"))
on_clients("ml_rf_predictions", _predictions("RandomForest"))
on_clients("ml_gbt_predictions", _predictions("GBT"))


def _cv_grid(df: DataFrame) -> DataFrame:
    train, _ = split_model_table(df)
    tuned = M.tune(M.CANDIDATES["LogReg"], train)
    return rounded(M.grid_table(tuned, df), 6, "roc_auc")


on_clients("ml_cv_grid", _cv_grid)


def _comparison(df: DataFrame) -> DataFrame:
    train, test = split_model_table(df)
    folder = fresh_dir(df.sparkSession, "scores")
    scored = {
        name: M.stored_scores(fitted(name, train), test, f"{folder}/{name}")
        for name in M.CANDIDATES
    }
    table = M.comparison(scored)
    return rounded(table, 6, *[c for c in table.columns if c != "model"])


on_clients("ml_comparison", _comparison)


def _heldout_facts(df: DataFrame) -> DataFrame:
    """Per model what holds whatever its coefficients: rows and labels scored, sound probabilities, metrics that agree.

    ``auc_agrees`` says that the exact metric is what Spark's evaluator finds on the
    stored scores, ``recount_agrees`` that the weighted recall is the share of right rows.
    """
    train, test = split_model_table(df)
    spark, folder = df.sparkSession, fresh_dir(df.sparkSession, "scores")
    parts = []
    for name in M.CANDIDATES:
        scored = M.predict(fitted(name, train), test)
        probability = X.vector_to_array(F.col("probability"))[1].alias("probability")
        scored = files.store(scored.select(KEY, "y", "prediction", "score", probability), f"{folder}/{name}")
        sound = F.col("probability").between(0, 1) & ((F.col("probability") > 0.5) == (F.col("prediction") == 1.0))
        metrics = E.metrics(scored).select(F.struct("*")).scalar()
        area = BinaryClassificationEvaluator(labelCol="y", rawPredictionCol="score", numBins=0).evaluate(scored)
        parts.append(scored.withColumn("m", metrics).agg(
            F.lit(name).alias("model"), F.count(F.lit(1)).alias("n_test"), F.sum("y").alias("n_positive"),
            F.bool_and(sound).alias("sound"), (F.max(F.col("m.roc_auc")) > 0.5).alias("beats_chance"),
            (F.abs(F.max("m.roc_auc") - area) < 1e-9).alias("auc_agrees"),
            (F.abs(F.max("m.weighted_recall") - F.avg((F.col("y") == F.col("prediction")).cast("int"))) < 1e-9).alias("recount_agrees")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


on_clients("ml_heldout_facts", _heldout_facts)


def _reload_facts(df: DataFrame) -> DataFrame:
    """Held-out rows with whether the saved and reloaded pipeline scores them as the fitted one does."""
    train, test = split_model_table(df)
    path, model = fresh_dir(df.sparkSession, "model"), fitted("LogReg", train)
    M.save(model, path)
    own = M.predict(model, test).select(KEY, "y", F.col("score").alias("own"))
    again = M.predict(M.load(path), test).select(KEY, "score")
    return own.join(again, KEY, "full").select(KEY, "y", F.coalesce(F.col("own") == F.col("score"), F.lit(False)).alias("same_score"))


on_clients("ml_reload_facts", _reload_facts)


def _importance(df: DataFrame) -> DataFrame:
    train, _ = split_model_table(df)
    model = fitted("GBT", train)
    return rounded(M.feature_importance(model, model.transform(train)), 6, "importance")


on_clients("ml_feature_importance", _importance)


@query("ml_reload_predict")
def ml_reload_predict(spark, folder):
    train, test = split_model_table(clients(spark, folder))
    path = fresh_dir(spark, "model")
    M.save(fitted("LogReg", train), path)
    return shown(M.predict(M.load(path), test))


@query("stream_scored")
def stream_scored(spark, folder):
    """A saved pipeline inside a stream of contacts joined to the client table, against batch scores of the same rows.

    ``same_score`` says that stream and batch agree on a row.
    """
    table = clients(spark, folder)
    train, _ = split_model_table(table)
    path, (_, out, state) = fresh_dir(spark, "model"), stream_paths(spark, "scored")
    M.save(fitted("LogReg", train), path)
    model = M.load(path)
    sibling = stream_session(spark)
    arriving = cleaning.clean(standin.campaign_from(
        sibling, standin.order_stream(sibling, folder), sibling.read.parquet(f"{folder}/customer.parquet")))
    result = M.predict(model, model_table(arriving, KEY)).select(KEY, "y", "score")
    runner.run_available(runner.to_files(result, out, state))
    streamed = spark.read.schema(result.schema).parquet(out)
    batch = M.predict(model, model_table(table, KEY)).select(KEY, F.col("score").alias("batch_score"))
    same = F.coalesce(F.abs(F.col("score") - F.col("batch_score")) < 1e-9, F.lit(False))
    return streamed.join(batch, KEY, "full").select(KEY, "y", same.alias("same_score"))
