"""Table schemas, column groups and the fixed values of the campaign domain."""

from __future__ import annotations

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _struct(**columns) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns.items()])


_INT, _STR, _DBL = IntegerType(), StringType(), DoubleType()

RAW_CAMPAIGN = _struct(
    age=_INT, job=_STR, marital=_STR, education=_STR, default=_STR, balance=_INT,
    housing=_STR, loan=_STR, contact=_STR, day=_INT, month=_STR, duration=_INT,
    campaign=_INT, pdays=_INT, previous=_INT, poutcome=_STR, y=_STR,
)

CLEAN_CAMPAIGN = _struct(
    age=_INT, job=_STR, marital=_STR, education=_STR, default=_INT, balance=_INT,
    housing=_INT, loan=_INT, contact=_STR, day=_INT, duration=_INT, campaign=_INT,
    pdays=_INT, previous=_INT, poutcome=_STR, y=_INT, never_contacted_before=_INT,
    age_bucket=_STR, balance_bucket=_STR, duration_min=_DBL, month=_STR,
)

TRANSACTION = _struct(
    txn_id=_STR, account_id=_STR, job=_STR, amount=_DBL, currency=_STR,
    txn_time=TimestampType(),
)

# --- Fixed values: column groups, tokens, band edges and labels -------------
UNKNOWN = "unknown"
MISSING = "missing"
NULLABLE_CATEGORIES = ("job", "education", "contact", "poutcome")
YES_NO = ("default", "housing", "loan", "y")
NEVER_CONTACTED = -1
AGE_EDGES, AGE_LABELS = (30, 45, 60), ("young", "mid", "senior", "retired")
BALANCE_EDGES = (0, 500, 2000, 10000)
BALANCE_LABELS = ("negative", "low", "mid", "high", "vip")
CATEGORICAL_FEATURES = (
    "job", "marital", "education", "contact", "poutcome", "age_bucket", "balance_bucket",
)
# Call length is known only after the call, so it is not a feature.
NUMERIC_FEATURES = (
    "age", "balance", "day", "campaign", "pdays", "previous",
    "default", "housing", "loan", "never_contacted_before",
)
CORRELATED = (
    "age", "balance", "day", "duration", "campaign", "pdays", "previous",
    "default", "housing", "loan", "y", "never_contacted_before",
)
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
SUSPICIOUS_ABOVE = 5000.0
WINDOW_SECONDS = 60
LATENESS = "2 minutes"
SEED = 42
