"""Column expressions shared by batch and streaming operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def quoted(name: str) -> str:
    """Column name as SQL text."""
    return "`" + name.replace("`", "``") + "`"


def literal(value) -> str:
    """Number, text or NULL as SQL text."""
    if value is None:
        return "NULL"
    if isinstance(value, str):
        escaped = value.replace("\\", "\\\\").replace("'", "\\'")
        return f"'{escaped}'"
    return repr(value)


def null_token(column: str, token: str) -> Column:
    """NULL where the column holds the token that stands for 'missing'."""
    return F.nullif(F.col(column), F.lit(token))


def flag(condition: Column) -> Column:
    """1/0 for a predicate; NULL stays NULL."""
    return condition.cast("int")


def replace_code(column: str, code: int, value: int) -> Column:
    """Swap one sentinel code for a value; NULL stays NULL."""
    return F.when(F.col(column) == code, value).otherwise(F.col(column))


def band(column: str, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label half-open ranges split at ``edges``; NULL falls in the last label."""
    if len(labels) != len(edges) + 1:
        raise ValueError("need one label more than edges")
    labelled = F.lit(labels[-1])
    for edge, label in zip(reversed(edges), reversed(labels[:-1])):
        labelled = F.when(F.col(column) < edge, label).otherwise(labelled)
    return labelled


def clip(column: str | Column, low: float, high: float) -> Column:
    """Limit a value to [low, high].

    ``greatest``/``least`` skip NULL arguments, so NULL is guarded.
    """
    value = F.col(column) if isinstance(column, str) else column
    return F.when(value.isNotNull(), F.greatest(F.least(value, F.lit(high)), F.lit(low)))


def above(column: str, threshold: float) -> Column:
    """1 where the value is strictly above the threshold; NULL stays NULL."""
    return flag(F.col(column) > F.lit(threshold))


def percent(column: str, digits: int = 2) -> Column:
    """Mean of a 0/1 column as a rounded percentage."""
    return F.round(100.0 * F.avg(column), digits)


def key_hash(key: str | Column, seed: int) -> Column:
    """Seeded uniform 32-digit hex text that depends on the key alone.

    A row keeps its value when a lost task is computed again and under any
    file layout, which ``rand(seed)`` does not offer. Texts of equal length
    compare like the numbers they stand for.
    """
    key = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat_ws(":", F.lit(str(seed)), key.cast("string")))


def hash_point(share: float) -> str:
    """The hash text below which a ``share`` of all rows lies; a share of 1 is above every hash."""
    if not 0 <= share <= 1:
        raise ValueError(f"share must be from 0 to 1, not {share}")
    if share == 1:
        return "g"
    return f"{int(share * 2**60):015x}"
