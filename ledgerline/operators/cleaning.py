"""Cleaning of sentinel-coded tables, driven by declared rules."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from ledgerline import schemas
from ledgerline.functions import columns as C


@dataclass(frozen=True)
class Band:
    """A labelled bucket column over a numeric column."""

    source: str
    target: str
    edges: tuple[float, ...]
    labels: tuple[str, ...]


@dataclass(frozen=True)
class Sentinel:
    """An integer code that means 'no value', recorded in a flag column."""

    column: str
    code: int
    replacement: int
    flag: str


@dataclass(frozen=True)
class CleaningRules:
    null_tokens: dict[str, str]
    yes_no: tuple[str, ...] = ()
    sentinels: tuple[Sentinel, ...] = ()
    bands: tuple[Band, ...] = ()
    # target -> (source, divisor, digits)
    ratios: dict[str, tuple[str, float, int]] | None = None


CAMPAIGN_RULES = CleaningRules(
    null_tokens={c: schemas.UNKNOWN for c in schemas.NULLABLE_CATEGORIES},
    yes_no=schemas.YES_NO,
    sentinels=(Sentinel("pdays", schemas.NEVER_CONTACTED, 0, "never_contacted_before"),),
    bands=(
        Band("age", "age_bucket", schemas.AGE_EDGES, schemas.AGE_LABELS),
        Band("balance", "balance_bucket", schemas.BALANCE_EDGES, schemas.BALANCE_LABELS),
    ),
    ratios={"duration_min": ("duration", 60, 2)},
)


def clean(df: DataFrame, rules: CleaningRules = CAMPAIGN_RULES) -> DataFrame:
    """Apply all rules in a single projection.

    Every expression reads the input row, so a flag sees the code that its
    column's replacement removes. Other columns pass through.
    """
    derived = {c: C.null_token(c, token) for c, token in rules.null_tokens.items()}
    derived |= {c: C.flag(F.col(c) == "yes") for c in rules.yes_no}
    for s in rules.sentinels:
        derived[s.column] = C.replace_code(s.column, s.code, s.replacement)
        derived[s.flag] = C.flag(F.col(s.column) == s.code)
    derived |= {b.target: C.band(b.source, b.edges, b.labels) for b in rules.bands}
    derived |= {
        target: F.round(F.col(source) / divisor, digits)
        for target, (source, divisor, digits) in (rules.ratios or {}).items()
    }
    return df.withColumns(derived)


def fill_missing(
    df: DataFrame, columns: Iterable[str] = schemas.CATEGORICAL_FEATURES,
    token: str = schemas.MISSING,
) -> DataFrame:
    """Give NULL categories a level of their own."""
    return df.fillna(token, subset=list(columns))
