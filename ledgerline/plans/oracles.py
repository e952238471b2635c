"""The same results as plain SQL for DuckDB, to check every query against."""

from __future__ import annotations

from ledgerline import schemas
from ledgerline.sources.standin import CAMPAIGN_COLUMNS_SQL, STANDIN_SECTORS

_CAMPAIGN = CAMPAIGN_COLUMNS_SQL.format(orders="orders", customer="customer")

_BASE = f"""
WITH RECURSIVE campaign AS (SELECT * RENAME (in_default AS "default") FROM ({_CAMPAIGN})),
bank AS (
  SELECT row_id, age, nullif(job, 'unknown') AS job, marital,
    nullif(education, 'unknown') AS education,
    CAST("default" = 'yes' AS INT) AS "default", balance,
    CAST(housing = 'yes' AS INT) AS housing, CAST(loan = 'yes' AS INT) AS loan,
    nullif(contact, 'unknown') AS contact, day, month, duration, campaign,
    CASE WHEN pdays = -1 THEN 0 ELSE pdays END AS pdays, previous,
    nullif(poutcome, 'unknown') AS poutcome, CAST(y = 'yes' AS INT) AS y,
    CAST(pdays = -1 AS INT) AS never_contacted_before,
    CASE WHEN age < 30 THEN 'young' WHEN age < 45 THEN 'mid'
         WHEN age < 60 THEN 'senior' ELSE 'retired' END AS age_bucket,
    CASE WHEN balance < 0 THEN 'negative' WHEN balance < 500 THEN 'low'
         WHEN balance < 2000 THEN 'mid' WHEN balance < 10000 THEN 'high'
         ELSE 'vip' END AS balance_bucket,
    round(duration / 60, 2) AS duration_min
  FROM campaign),
txn AS (
  SELECT CAST(event_id AS VARCHAR) AS txn_id, CAST(user_id AS VARCHAR) AS account_id,
    event_type AS job, value AS amount, 'EUR' AS currency, CAST(ts AS TIMESTAMP) AS txn_time
  FROM events)
"""

_RATE = "round(100.0 * avg(y), 2) AS subscription_rate_pct"
_N = "count(*) AS n_clients"
_CALLS = f"count(*) AS n_calls, round(avg(duration), 1) AS avg_duration_sec, {_RATE}"
_RAW_COLUMNS = [f.name for f in schemas.RAW_CAMPAIGN]
_CLEAN_COLUMNS = [f.name for f in schemas.CLEAN_CAMPAIGN]


def _q(name: str) -> str:
    return f'"{name}"'


def _list(names) -> str:
    return ", ".join(_q(n) for n in names)


def _per_column(columns, make) -> str:
    return " UNION ALL ".join(make(c) for c in columns)


# --- building blocks ---------------------------------------------------------

def _hash(seed: int = schemas.SEED, key: str = "row_id") -> str:
    return f"md5('{seed}:' || {key})"


def _histogram(column: str, bins: int, low=None, high=None) -> str:
    x = column if low is None else f"greatest(least({column}, {high}), {low})"
    return f"""
, p AS (SELECT CAST({x} AS DOUBLE) AS x FROM bank WHERE {column} IS NOT NULL),
s AS (SELECT min(x) AS lo, (max(x) - min(x)) / {bins} AS w FROM p),
c AS (SELECT least(CAST(floor((x - lo) / w) AS BIGINT), {bins - 1}) AS bin, count(*) AS n
      FROM p, s GROUP BY 1)
SELECT CAST(r.bin AS INT) AS bin, round(lo + r.bin * w, 6) AS left_edge,
  round(lo + (r.bin + 1) * w, 6) AS right_edge, coalesce(n, 0) AS count
FROM range({bins}) AS r(bin) CROSS JOIN s LEFT JOIN c ON c.bin = r.bin"""


def _density(column: str, points: int, where: str, by: str | None, source: str = "bank") -> str:
    group = f"{by}, " if by else ""
    match = f"USING ({by})" if by else "ON true"
    return f"""
, d AS (SELECT {group}CAST({column} AS DOUBLE) AS v FROM {source} WHERE {where}),
s AS (SELECT {group}count(*) AS n, min(v) AS lo, max(v) AS hi,
        stddev_samp(v) * pow(count(*), -0.2) AS h FROM d {'GROUP BY ' + by if by else ''}),
c AS (SELECT {group}v, count(*) AS k FROM d GROUP BY ALL),
g AS (SELECT {group}n, h, i AS point, lo + i * (hi - lo) / {points - 1} AS x
      FROM s, range({points}) AS r(i))
SELECT {group}CAST(point AS INT) AS point, round(max(x), 8) AS x,
  round(sum(k * exp(-0.5 * pow((x - v) / h, 2))) / (max(n) * max(h) * sqrt(2 * pi())), 8) AS density
FROM g JOIN c {match} GROUP BY {group}point"""


def _box(column: str, where: str = "true") -> str:
    return f"""
, q AS (SELECT y, quantile_cont({column}, 0.25) AS q1, quantile_cont({column}, 0.5) AS median,
          quantile_cont({column}, 0.75) AS q3 FROM bank WHERE {where} GROUP BY y),
m AS (SELECT b.y, q1, median, q3, {column} AS v,
        {column} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside
      FROM bank b JOIN q ON b.y = q.y WHERE {where})
SELECT y, q1, median, q3, CAST(min(v) FILTER (inside) AS DOUBLE) AS whisker_low,
  CAST(max(v) FILTER (inside) AS DOUBLE) AS whisker_high,
  count(*) FILTER (NOT inside) AS n_outliers
FROM m GROUP BY y, q1, median, q3"""


def _simpson(density: str, upper: str, steps: int = 20000) -> str:
    """Integral of a density (in x) from 0 to ``upper`` by Simpson's rule."""
    return f"""(SELECT sum(weight * ({density})) * w / 3 FROM (
      SELECT i * {upper} / {steps} AS x, {upper} / {steps} AS w,
        CASE WHEN i = 0 OR i = {steps} THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END AS weight
      FROM range({steps + 1}) AS r(i)) GROUP BY w)"""


def _welch() -> str:
    pdf = ("exp(lgamma((dof + 1) / 2) - lgamma(dof / 2)) / sqrt(dof * pi())"
           " * pow(1 + x * x / dof, -(dof + 1) / 2)")
    return f"""
, g AS (SELECT y, count(duration) AS n, avg(duration) AS m, var_samp(duration) / count(duration) AS e
        FROM bank GROUP BY y),
r AS (SELECT a.n AS n_a, b.n AS n_b, (a.m - b.m) / sqrt(a.e + b.e) AS t,
        pow(a.e + b.e, 2) / (pow(a.e, 2) / (a.n - 1) + pow(b.e, 2) / (b.n - 1)) AS dof
      FROM g a, g b WHERE a.y = 1 AND b.y = 0),
p AS (SELECT *, greatest(1 - 2 * {_simpson(pdf, 'abs(t)')}, 0) AS p FROM r)
SELECT n_a, n_b, round(t, 6) AS t, round(dof, 6) AS dof, abs(round(p, 9)) AS p_value,
  p < 0.05 AS reject FROM p"""


def _expected(row: str) -> str:
    return f"""
, l AS (SELECT {row} AS label, y FROM bank WHERE {row} IS NOT NULL),
e AS (SELECT r.label, c.y, count(l.y) AS observed,
        max(r.n) * max(c.n) / CAST((SELECT count(*) FROM l) AS DOUBLE) AS expected
      FROM (SELECT label, count(*) AS n FROM l GROUP BY 1) r
      CROSS JOIN (SELECT y, count(*) AS n FROM l GROUP BY 1) c
      LEFT JOIN l ON l.label = r.label AND l.y = c.y GROUP BY r.label, c.y)"""


def _chi2(row: str, yates: bool) -> str:
    gap = "abs(observed - expected)"
    if yates:
        gap = f"({gap} - least({gap}, 0.5))"
    # Tail for dof 1 and 3 by integrating the chi density (x is a square root).
    pdf = ("2 * pow(x, dof - 1) * exp(-x * x / 2) / (pow(2, dof / 2.0) * gamma(dof / 2.0))")
    return f"""{_expected(row)},
r AS (SELECT sum(pow({gap}, 2) / expected) AS chi2,
        CAST(count(DISTINCT label) - 1 AS INT) AS dof FROM e),
p AS (SELECT *, greatest(1 - {_simpson(pdf, 'sqrt(chi2)')}, 0) AS p FROM r)
SELECT round(chi2, 6) AS chi2, dof, abs(round(p, 9)) AS p_value, p < 0.05 AS reject FROM p"""


def _windows(seconds: int, source: str = "txn") -> str:
    return f"""
SELECT window_start, window_start + INTERVAL '{seconds} seconds' AS window_end, job,
  count(*) AS n_txn, round(sum(amount), 2) AS total_amount,
  CAST(sum(CAST(amount > 100 AS INT)) AS BIGINT) AS n_suspicious
FROM (SELECT *, time_bucket(INTERVAL '{seconds} seconds', txn_time) AS window_start FROM {source})
GROUP BY window_start, job"""


_HELD_OUT = "SELECT row_id, y FROM bank WHERE {hash} >= '{at}'"

_SLIDING = """
SELECT window_start, window_start + INTERVAL '60 seconds' AS window_end, job, count(*) AS n_txn,
  round(sum(amount), 2) AS total_amount, count(*) FILTER (amount > 100) AS n_suspicious
FROM (SELECT job, amount, time_bucket(INTERVAL '10 seconds', txn_time) - i * INTERVAL '10 seconds' AS window_start
      FROM txn, range(6) AS r(i))
GROUP BY window_start, job"""


def _zscore(days: int) -> str:
    return f"""
, cents AS (SELECT *, CAST(round(amount * 100) AS HUGEINT) AS v FROM txn),
hist AS (SELECT txn_id, account_id, v, count(v) OVER w AS n_before, sum(v) OVER w AS s, sum(v * v) OVER w AS q FROM cents
  WINDOW w AS (PARTITION BY account_id ORDER BY txn_time
    RANGE BETWEEN INTERVAL '{days} days' PRECEDING AND INTERVAL '1 microsecond' PRECEDING)),
scored AS (SELECT *, s / n_before AS m, n_before * q - s * s AS spread FROM hist)
SELECT txn_id, account_id, n_before, round(m / 100, 6) AS mean_before,
  CASE WHEN spread > 0 THEN round((v - m) / sqrt(spread / (n_before * (n_before - 1))), 6) END AS zscore,
  CAST(coalesce(abs((v - m) / sqrt(nullif(greatest(spread, 0), 0) / (n_before * (n_before - 1)))) > 3, false) AS INT)
    AS unusual
FROM scored"""


_CONTACTS = """
, contact AS (SELECT o_orderkey AS row_id, o_custkey AS client_id, CAST(o_orderdate AS DATE) AS contact_date,
    o_totalprice AS amount, CAST(year(o_orderdate) AS INT) AS year, CAST(month(o_orderdate) AS INT) AS month FROM orders)
"""
_RATE_LIMIT = _CONTACTS + """
, chain AS (
  SELECT client_id, min(contact_date) AS d FROM contact GROUP BY client_id
  UNION ALL
  SELECT chain.client_id, min(contact_date) FROM chain JOIN contact ON contact.client_id = chain.client_id
    AND contact_date >= d + INTERVAL '90 days' GROUP BY chain.client_id),
first AS (SELECT client_id, contact_date, min(row_id) AS row_id FROM contact JOIN chain USING (client_id)
  WHERE contact_date = d GROUP BY client_id, contact_date)
SELECT row_id, client_id, contact_date, row_id IN (SELECT row_id FROM first) AS allowed FROM contact
"""

_CURVE = """
, step AS (SELECT score, count(*) FILTER (y = 1) AS pos, count(*) FILTER (y = 0) AS neg FROM scored GROUP BY score),
curve AS (SELECT score AS threshold, pos, CAST(sum(pos) OVER above AS BIGINT) AS tp, CAST(sum(neg) OVER above AS BIGINT) AS fp,
    CAST(sum(pos) OVER () - tp AS BIGINT) AS fn, tp / (tp + fp) AS precision, tp / (tp + fn) AS recall
  FROM step WINDOW above AS (ORDER BY score DESC))
"""
_ROUNDED_CURVE = "round(threshold, 8) AS threshold, round(precision, 8) AS precision, round(recall, 8) AS recall"
_LIFT = """
, part AS (SELECT *, CAST(ntile(10) OVER (ORDER BY score DESC, row_id) AS INT) AS part FROM scored),
per AS (SELECT part, count(*) AS n, count(*) FILTER (y = 1) AS n_positive, max(score) AS highest, min(score) AS lowest
  FROM part GROUP BY part)
SELECT part, n, n_positive, round(n_positive / n, 8) AS rate,
  round(n_positive / n * sum(n) OVER () / sum(n_positive) OVER (), 8) AS lift,
  round(sum(n_positive) OVER (ORDER BY part) / sum(n_positive) OVER (), 8) AS captured,
  round(highest, 8) AS highest, round(lowest, 8) AS lowest FROM per
"""


def _closed(windows: str) -> str:
    return (f"SELECT * FROM ({windows}) WHERE window_end <= "
            "(SELECT max(txn_time) FROM txn) - INTERVAL '2 minutes'")


# Arrival order: thirds of the time range, every twentieth event two turns late.
_ARRIVAL = """
, span AS (SELECT min(epoch_us(txn_time)) AS lo, max(epoch_us(txn_time)) AS hi FROM txn),
arr AS (SELECT txn.*, (epoch_us(txn_time) - lo) * 3 // (hi - lo + 1)
          + CASE WHEN CAST(txn_id AS BIGINT) % 20 = 0 THEN 2 ELSE 0 END AS turn FROM txn, span),
turns AS (SELECT turn, max(txn_time) AS newest FROM arr GROUP BY turn),
marks AS (SELECT turn, max(newest) OVER (ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
            - INTERVAL '2 minutes' AS watermark FROM turns),
kept AS (SELECT arr.* FROM arr JOIN marks USING (turn)
         WHERE watermark IS NULL
           OR time_bucket(INTERVAL '3600 seconds', txn_time) + INTERVAL '3600 seconds' > watermark)
"""

_SCORED = """
, scored AS (SELECT row_id, y,
    (duration % 1000 + CASE WHEN poutcome = 'success' THEN 700 ELSE 0 END) / 2000 AS score FROM bank),
judged AS (SELECT *, CASE WHEN score > 0.5 THEN 1 ELSE 0 END AS p FROM scored),
cls AS (SELECT c, count(*) FILTER (y = c AND p = c) AS hit, count(*) FILTER (p = c) AS pred,
          count(*) FILTER (y = c) AS act, count(*) AS n
        FROM judged, (VALUES (0), (1)) AS v(c) GROUP BY c),
pr AS (SELECT *, CASE WHEN pred = 0 THEN 0 ELSE hit / pred END AS prec,
         CASE WHEN act = 0 THEN 0 ELSE hit / act END AS rec FROM cls),
auc AS (SELECT (sum(rk) FILTER (y = 1) - count(*) FILTER (y = 1) * (count(*) FILTER (y = 1) + 1) / 2)
          / (count(*) FILTER (y = 1) * count(*) FILTER (y = 0)) AS roc_auc
        FROM (SELECT y, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2 AS rk
              FROM scored))
"""
_F1 = "CASE WHEN prec + rec = 0 THEN 0 ELSE 2 * prec * rec / (prec + rec) END"
_WEIGHTED = f"""sum(act / n * {_F1}) AS f1, sum(act / n * prec) AS weighted_precision,
  sum(act / n * rec) AS weighted_recall"""


def _levels() -> str:
    """Frequency rank of every level of every categorical feature, from 0."""
    one = ("SELECT '{c}' AS feature, level, row_number() OVER (ORDER BY count(*) DESC, level) - 1 AS slot"
           " FROM (SELECT coalesce({c}, 'missing') AS level FROM bank) GROUP BY level")
    return ", lv AS (" + _per_column(
        schemas.CATEGORICAL_FEATURES, lambda c: one.format(c=c)
    ) + ")"


def _features() -> dict[str, str]:
    cats, nums = schemas.CATEGORICAL_FEATURES, schemas.NUMERIC_FEATURES
    joins = " ".join(
        f"JOIN lv AS l{i} ON l{i}.feature = '{c}' AND l{i}.level = coalesce(bank.{c}, 'missing')"
        for i, c in enumerate(cats)
    )
    order = " ".join(f"WHEN '{c}' THEN {i}" for i, c in enumerate(cats))
    numeric = " UNION ALL ".join(
        f"SELECT {i} AS slot, '{c}' AS feature" for i, c in enumerate(nums)
    )
    return {
        "feat_string_index": f"{_levels()} SELECT row_id, " + ", ".join(
            f"CAST(l{i}.slot AS INT) AS {c}" for i, c in enumerate(cats)
        ) + f" FROM bank {joins}",
        "feat_one_hot": _levels() + _per_column(cats, lambda c: (
            f" SELECT row_id, '{c}' AS feature, CAST(slot AS INT) AS slot, 1.0::DOUBLE AS value"
            f" FROM bank JOIN lv ON feature = '{c}' AND level = coalesce({c}, 'missing')")),
        "feat_vector_size": f"{_levels()} SELECT CAST((SELECT count(*) FROM lv) + {len(nums)} AS INT)"
                            " AS size, count(*) AS n_rows FROM bank",
        "feat_slot_names": f"""{_levels()}
SELECT CAST(slot AS INT) AS slot, feature FROM (
  {numeric} UNION ALL
  SELECT {len(nums)} - 1 + row_number() OVER (ORDER BY CASE feature {order} END, slot),
    feature || '=' || level FROM lv)""",
        "feat_scaled_numeric": "SELECT row_id, " + ", ".join(
            f"round({_q(c)} / (SELECT stddev_samp({_q(c)}) FROM bank), 6) AS {_q(c)}" for c in nums
        ) + " FROM bank",
    }


def _describe() -> str:
    numeric = {f.name for f in schemas.RAW_CAMPAIGN if f.dataType.simpleString() == "int"}

    def one(c):
        stats = (f"round(avg({_q(c)}), 6), round(stddev_samp({_q(c)}), 6)"
                 if c in numeric else "NULL::DOUBLE, NULL::DOUBLE")
        return (f"SELECT '{c}', count({_q(c)}), {stats}, min({_q(c)})::VARCHAR, max({_q(c)})::VARCHAR"
                " FROM campaign")

    return ('SELECT * FROM (' + _per_column(_RAW_COLUMNS, one)
            + ') AS t("column", "count", mean, stddev, min, max)')


def _duplicates(copies: int) -> str:
    return f"""
, d AS (SELECT DISTINCT {_list(_RAW_COLUMNS)} FROM campaign),
t AS (SELECT {copies} * count(*) AS total_rows FROM campaign),
u AS (SELECT count(*) AS distinct_rows FROM d)
SELECT total_rows, distinct_rows, total_rows - distinct_rows AS duplicates FROM t, u"""


def _exact_sample(n: int, columns: str, where: str = "true") -> str:
    return (f"SELECT * EXCLUDE (h) FROM (SELECT {columns}, {_hash()} AS h FROM bank"
            f" ORDER BY h, row_id LIMIT {n}) WHERE {where}")


def build() -> dict[str, str]:
    clean_with_key = ["row_id", *_CLEAN_COLUMNS]
    sectors = ", ".join(f"('{job}', '{sector}')" for job, sector in STANDIN_SECTORS)
    joined = (f"SELECT row_id, bank.job, balance, y, sector FROM bank"
              f" JOIN (VALUES {sectors}) AS s(job, sector) ON bank.job = s.job")
    averages = "SELECT job, round(avg(balance), 6) AS avg_balance FROM bank GROUP BY job"
    calendar = ", ".join(f"({i}, '{m}')" for i, m in enumerate(schemas.MONTHS, 1))
    ages = ", ".join(f"({i}, '{a}')" for i, a in enumerate(schemas.AGE_LABELS, 1))
    by_job = (f"SELECT job, {_N}, CAST(sum(y) AS BIGINT) AS n_subscribed, {_RATE}"
              " FROM bank WHERE job IS NOT NULL GROUP BY job")
    by_poutcome = f"SELECT coalesce(poutcome, 'unknown') AS poutcome, {_N}, {_RATE}"
    warehouse = f"SELECT {_list(_CLEAN_COLUMNS)} FROM bank"
    split = "SELECT row_id, y, CASE WHEN {} THEN 'train' ELSE 'test' END AS part FROM {}"

    queries = {
        # sources and warehouse
        "src_csv_roundtrip": f"SELECT {_list(_RAW_COLUMNS)} FROM campaign",
        "src_json_roundtrip": "SELECT * FROM txn",
        "wh_partition_scan": warehouse,
        "wh_table_scan": warehouse,
        "wh_partition_prune": "SELECT month, count(*) AS n_calls, CAST(sum(duration) AS BIGINT)"
                              " AS total_duration FROM bank WHERE month IN ('mar', 'sep') GROUP BY month",
        "wh_show_partitions": "SELECT DISTINCT month FROM bank",
        "wh_report_job": by_job,
        "wh_sql_report": f"SELECT \"default\", age_bucket, {_N}, {_RATE} FROM bank WHERE month IN"
                         " ('may', 'jun', 'jul') AND job IS NOT NULL GROUP BY \"default\", age_bucket",
        "wh_bucketed_join": _CONTACTS + """
SELECT year, lower(c_mktsegment) AS job, count(*) AS n_contacts, round(sum(amount), 2) AS total_amount,
  round(avg(c_acctbal), 4) AS avg_balance FROM contact JOIN customer ON client_id = c_custkey GROUP BY 1, 2""",
        "wh_bucketed_client": _CONTACTS + "SELECT row_id, contact_date, year, month FROM contact"
                                          " WHERE client_id = 7 AND year IN (1996, 1997, 1998)",
        "contact_rate_limit": _RATE_LIMIT,
        # cleaning
        "clean_sentinel_null": "SELECT row_id, job, education, contact, poutcome FROM bank",
        "clean_pdays": "SELECT row_id, pdays, never_contacted_before FROM bank",
        "clean_flags": 'SELECT row_id, "default", housing, loan, y FROM bank',
        "clean_age_bucket": "SELECT row_id, age, age_bucket FROM bank",
        "clean_balance_bucket": "SELECT row_id, balance, balance_bucket FROM bank",
        "clean_duration_min": "SELECT row_id, duration, duration_min FROM bank",
        "clean_full": f"SELECT {_list(clean_with_key)} FROM bank",
        "clean_fill_missing": "SELECT row_id, " + ", ".join(
            f"coalesce({c}, 'missing') AS {c}" for c in schemas.CATEGORICAL_FEATURES) + " FROM bank",
        "prj_clip": "SELECT row_id, greatest(least(balance, 20000), -2000) AS balance_clipped,"
                    " greatest(least(duration, 1500), 0) AS duration_clipped FROM bank",
        "feat_class_weight": "SELECT row_id, y, round(CASE WHEN y = 1 THEN"
                             " (SELECT (1 - avg(y)) / avg(y) FROM bank) ELSE 1 END, 8) AS weight FROM bank",
        # reports
        "seg_job": by_job,
        "seg_month": f"SELECT month, {_CALLS} FROM bank GROUP BY month",
        "seg_balance_bucket": f"SELECT balance_bucket, {_N}, round(avg(balance), 0) AS avg_balance,"
                              f" {_RATE} FROM bank GROUP BY balance_bucket",
        "seg_education": f"SELECT coalesce(education, 'unknown') AS education, {_N}, {_RATE}"
                         " FROM bank GROUP BY bank.education",
        "seg_contact": f"SELECT coalesce(contact, 'unknown') AS contact_type, {_CALLS}"
                       " FROM bank GROUP BY contact",
        "seg_housing_loan": f"SELECT housing, loan, {_N}, {_RATE} FROM bank GROUP BY housing, loan",
        "seg_poutcome": f"{by_poutcome} FROM bank GROUP BY bank.poutcome",
        "seg_duration_cohort": "SELECT CASE WHEN y = 1 THEN 'subscribed' ELSE 'not_subscribed' END AS"
                               " cohort, count(*) AS n_calls, round(avg(duration), 1) AS avg_duration_sec,"
                               " min(duration) AS min_duration_sec, max(duration) AS max_duration_sec"
                               " FROM bank GROUP BY y",
        "seg_poutcome_rank": f"{by_poutcome}, CAST(rank() OVER (ORDER BY avg(y) DESC) AS INT) AS"
                             " rate_rank FROM bank GROUP BY bank.poutcome",
        "seg_month_calendar": f"SELECT month_no, c.month, round(100 * avg(y), 6) AS rate_pct FROM"
                              f" (VALUES {calendar}) AS c(month_no, month) LEFT JOIN bank"
                              " ON bank.month = c.month GROUP BY month_no, c.month",
        "seg_age_bucket": f"SELECT position, a.age_bucket, round(avg(y), 6) AS rate FROM (VALUES {ages})"
                          " AS a(position, age_bucket) LEFT JOIN bank ON bank.age_bucket = a.age_bucket"
                          " GROUP BY position, a.age_bucket",
        "seg_job_rate_count": "SELECT job, round(avg(y), 6) AS mean, count(y) AS count FROM bank"
                              " WHERE job IS NOT NULL GROUP BY job",
        "seg_contact_rate": "SELECT coalesce(contact, 'unknown') AS contact, round(100 * avg(y), 6) AS"
                            " rate_pct FROM bank GROUP BY 1",
        "seg_poutcome_rate": "SELECT coalesce(poutcome, 'unknown') AS poutcome, round(100 * avg(y), 6)"
                             " AS rate_pct FROM bank GROUP BY 1",
        # profiles
        "prof_shape": f"SELECT count(*) AS n_rows, {len(_RAW_COLUMNS)} AS n_columns FROM campaign",
        "prof_duplicates": _duplicates(1),
        "prof_duplicates_union": _duplicates(3),
        "prof_null_summary": _per_column(clean_with_key, lambda c: (
            f"SELECT '{c}' AS \"column\", count(*) - count({_q(c)}) AS n_null FROM bank")),
        "prof_sentinel_rate": _per_column([*schemas.NULLABLE_CATEGORIES, "pdays"], lambda c: (
            f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} = {'-1' if c == 'pdays' else repr('unknown')})"
            " AS n_sentinel, round(100 * n_sentinel / count(*), 2) AS pct FROM campaign")),
        "prof_cardinality": _per_column(_CLEAN_COLUMNS, lambda c: (
            f"SELECT '{c}' AS \"column\", count(*) AS n_distinct FROM (SELECT DISTINCT {_q(c)} FROM bank)")),
        "prof_value_samples": "SELECT * FROM (" + _per_column(_RAW_COLUMNS, lambda c: (
            f"SELECT '{c}' AS \"column\", value, CAST(row_number() OVER (ORDER BY typed) AS INT) AS position"
            f" FROM (SELECT DISTINCT {_q(c)} AS typed, {_q(c)}::VARCHAR AS value FROM campaign)")) + ") WHERE position <= 6",
        "prof_describe": _describe(),
        "prof_quantiles": _per_column(("balance", "campaign", "previous", "pdays"), lambda c: (
            f"SELECT '{c}' AS \"column\", quantile_disc({c}, 0.01)::DOUBLE AS p01,"
            f" quantile_disc({c}, 0.5)::DOUBLE AS p50, quantile_disc({c}, 0.99)::DOUBLE AS p99 FROM bank")),
        "prof_cardinality_bounds": _per_column(_CLEAN_COLUMNS, lambda c: (
            f"SELECT '{c}' AS \"column\", count(*) AS n_distinct, true AS within"
            f" FROM (SELECT DISTINCT {_q(c)} FROM bank)")),
        "prof_quantile_bounds": _per_column(("balance", "campaign", "previous", "pdays"), lambda c: (
            f"SELECT '{c}' AS \"column\", count({c}) AS n, true AS p01, true AS p50, true AS p99 FROM bank")),
        "prof_positive_rate": "SELECT round(avg(y), 8) AS positive_rate FROM bank",
        # distributions and tests
        "dist_value_counts": "SELECT job, count(*) AS count FROM bank WHERE job IS NOT NULL GROUP BY job",
        "dist_value_counts_marital": "SELECT marital, count(*) AS count FROM bank GROUP BY marital",
        "dist_value_counts_y": "SELECT y, count(*) AS count FROM bank GROUP BY y",
        "dist_share_marital": "SELECT marital, count(*) AS count,"
                              " round(100.0 * count(*) / sum(count(*)) OVER (), 1) AS share_pct"
                              " FROM bank WHERE marital IS NOT NULL GROUP BY marital",
        "dist_hist_age": _histogram("age", 30),
        "dist_hist_balance": _histogram("balance", 60, -2000, 20000),
        "dist_hist_duration": _histogram("duration", 60, 0, 1500),
        "dist_median_duration": "SELECT median(duration) AS median FROM bank",
        "dist_kde_age": _density("age", 200, "age IS NOT NULL", None),
        "dist_density_duration_by_y": _density("duration", 100, "duration < 1500", "y"),
        "dist_box_age_by_y": _box("age"),
        "dist_box_balance_by_y": _box("balance", "balance BETWEEN -2000 AND 10000"),
        "stat_correlation": " UNION ALL ".join(
            f"SELECT '{a}' AS a, '{b}' AS b, round(corr({_q(a)}, {_q(b)}), 6) AS r FROM bank"
            for a in schemas.CORRELATED for b in schemas.CORRELATED),
        "stat_crosstab_housing": "SELECT housing, count(*) FILTER (y = 0) AS y_0,"
                                 " count(*) FILTER (y = 1) AS y_1 FROM bank GROUP BY housing",
        "stat_crosstab_education": "SELECT coalesce(education, 'unknown') AS education,"
                                   " count(*) FILTER (y = 0) AS y_0, count(*) FILTER (y = 1) AS y_1"
                                   " FROM bank GROUP BY 1",
        "hyp_welch_duration": _welch(),
        "hyp_expected_education": _expected("coalesce(education, 'unknown')")
        + " SELECT label AS education, y, observed, round(expected, 6) AS expected FROM e",
        "hyp_chi2_housing": _chi2("housing", True),
        "hyp_chi2_housing_uncorrected": _chi2("housing", False),
        "hyp_chi2_education": _chi2("coalesce(education, 'unknown')", False),
        # joins, sets, layout
        "join_sector_default": joined,
        "join_sector_broadcast": joined,
        "join_sector_sortmerge": joined,
        "set_union_all": "SELECT row_id, job, balance FROM bank, range(3)",
        "set_distinct": "SELECT DISTINCT job, marital, education, age_bucket, balance_bucket FROM bank",
        "phys_groupby_default": averages,
        "phys_groupby_repartition": averages,
        "phys_groupby_coalesce": averages,
        "phys_groupby_cached": averages,
        # samples and splits
        "sample_exact": _exact_sample(800, "row_id, age, job, y"),
        "sample_pairplot": _exact_sample(800, "row_id, age, balance, duration, campaign, y"),
        "sample_pairplot_density": ", drawn AS (" + _exact_sample(
            800, "row_id, age, balance, duration, campaign, y") + ")" + " UNION ALL ".join(
                f"SELECT *, '{c}' AS \"column\" FROM (" + _density(
                    c, 50, "true", "y", "drawn").replace("\n, d AS", "WITH d AS", 1) + ")"
                for c in ("age", "balance", "duration", "campaign")),
        "sample_scatter": _exact_sample(1500, "row_id, campaign, duration, y", "duration < 1500"),
        "sample_fraction": f"SELECT row_id, age, y FROM bank WHERE {_hash()} < '{int(0.1 * 2**60):015x}'",
        "split_random": split.format(f"{_hash()} < '{int(0.8 * 2**60):015x}'", "bank"),
        "split_stratified": split.format(
            "place <= floor(0.8 * n + 0.5)",
            f"(SELECT row_id, y, row_number() OVER (PARTITION BY y ORDER BY {_hash()}, row_id) AS place,"
            " count(*) OVER (PARTITION BY y) AS n FROM bank)"),
        # transactions
        "txn_tag_suspicious": "SELECT txn_id, amount, CAST(amount > 100 AS INT) AS suspicious FROM txn",
        "txn_window_batch": _windows(60),
        "txn_window_hourly": _windows(3600),
        "txn_job_rollup": "SELECT job, round(sum(amount), 2) AS total_amount, count(*) AS n_txn,"
                          " count(*) FILTER (amount > 100) AS n_suspicious FROM txn GROUP BY job",
        "txn_window_sliding": _SLIDING,
        "txn_zscore_30d": _zscore(30),
        "txn_zscore_7d": _zscore(7),
        "stream_sliding": _closed(_SLIDING),
        "stream_two_sinks": "SELECT sink, job, count(*) AS n_txn, round(sum(amount), 2) AS total_amount,"
                            " count(*) FILTER (amount > 100) AS n_suspicious, max(txn_time) AS newest"
                            " FROM txn, (VALUES ('archive'), ('downstream')) AS s(sink) GROUP BY sink, job",
        "stream_scored": "SELECT row_id, y, true AS same_score FROM bank",
        "stream_append": _closed(_windows(60)),
        "stream_complete": _windows(60),
        "stream_update": _windows(60),
        "stream_restart": _closed(_windows(3600)),
        "stream_append_late": _ARRIVAL + _closed(_windows(3600, "kept")),
        "stream_complete_late": _windows(3600),
        # models
        "ml_heldout_facts": ", test AS (" + _HELD_OUT.format(hash=_hash(), at=f"{int(0.8 * 2**60):015x}") + """)
SELECT model, count(*) AS n_test, CAST(sum(y) AS BIGINT) AS n_positive, true AS sound, true AS beats_chance,
  true AS auc_agrees, true AS recount_agrees
FROM test, (VALUES ('LogReg'), ('RandomForest'), ('GBT')) AS m(model) GROUP BY model""",
        "ml_reload_facts": ", test AS (" + _HELD_OUT.format(hash=_hash(), at=f"{int(0.8 * 2**60):015x}")
                           + ") SELECT row_id, y, true AS same_score FROM test",
        # evaluation
        "eval_auc": _SCORED + "SELECT round(roc_auc, 8) AS roc_auc FROM auc",
        "eval_confusion": _SCORED + "SELECT y, CAST(p AS DOUBLE) AS prediction, count(*) AS n FROM judged"
                                    " GROUP BY y, p",
        "eval_weighted": _SCORED + f"SELECT round(f1, 8) AS f1, round(weighted_precision, 8) AS"
                                   f" weighted_precision, round(weighted_recall, 8) AS weighted_recall"
                                   f" FROM (SELECT {_WEIGHTED} FROM pr)",
        "eval_positive_class": _SCORED + "SELECT round(prec, 8) AS precision, round(rec, 8) AS recall"
                                         " FROM pr WHERE c = 1",
        "eval_bundle": _SCORED + f"""SELECT round(roc_auc, 8) AS roc_auc, round(f1, 8) AS f1,
  round(weighted_precision, 8) AS weighted_precision, round(weighted_recall, 8) AS weighted_recall,
  round(prec, 8) AS positive_precision, round(rec, 8) AS positive_recall
FROM auc, (SELECT {_WEIGHTED} FROM pr), (SELECT prec, rec FROM pr WHERE c = 1)""",
        "eval_pr_curve": _SCORED + _CURVE + f"SELECT {_ROUNDED_CURVE}, tp, fp, fn FROM curve",
        "eval_average_precision": _SCORED + _CURVE + "SELECT round(sum(pos * precision) / sum(pos), 8)"
                                                     " AS average_precision FROM curve",
        "eval_best_threshold": _SCORED + _CURVE + f"SELECT 1.0::DOUBLE * fp + 8 * fn AS cost, {_ROUNDED_CURVE},"
                               " tp, fp, fn FROM curve ORDER BY fp + 8 * fn, curve.threshold DESC LIMIT 1",
        "eval_threshold_capacity": _SCORED + _CURVE + f"SELECT {_ROUNDED_CURVE}, tp + fp AS n_calls FROM curve"
                                   " WHERE tp + fp <= 1000 ORDER BY curve.threshold LIMIT 1",
        "eval_lift_deciles": _SCORED + _LIFT,
        **_features(),
    }
    return {name: _BASE + sql for name, sql in queries.items()}
