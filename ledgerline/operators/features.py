"""Feature preparation for classifiers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Transformer, Estimator
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from ledgerline import schemas
from ledgerline.sources.files import literal_table

RAW_FEATURES, FEATURES = "features_raw", "features"


def index_column(name: str) -> str:
    return f"{name}_index"


def hot_column(name: str) -> str:
    return f"{name}_hot"


def preparation(
    categorical: Sequence[str] = schemas.CATEGORICAL_FEATURES,
    numeric: Sequence[str] = schemas.NUMERIC_FEATURES,
) -> list[Transformer | Estimator]:
    """Index, one-hot, assemble (numeric first) and scale to unit deviation.

    One multi-column indexer counts the labels of all columns in one pass.
    Scaling does not centre, so vectors stay sparse.
    """
    indexed = [index_column(c) for c in categorical]
    hot = [hot_column(c) for c in categorical]
    return [
        StringIndexer(inputCols=list(categorical), outputCols=indexed, handleInvalid="keep"),
        OneHotEncoder(inputCols=indexed, outputCols=hot),
        VectorAssembler(inputCols=[*numeric, *hot], outputCol=RAW_FEATURES),
        StandardScaler(inputCol=RAW_FEATURES, outputCol=FEATURES, withMean=False, withStd=True),
    ]


def feature_names(prepared: DataFrame, column: str = RAW_FEATURES) -> list[str]:
    """Name of every vector slot, from the attributes the assembler recorded."""
    groups = prepared.schema[column].metadata["ml_attr"]["attrs"]
    slots = sorted((a["idx"], a["name"]) for attrs in groups.values() for a in attrs)
    return [name.replace("_hot_", "=", 1) for _, name in slots]


def slots_table(prepared: DataFrame, column: str = RAW_FEATURES) -> DataFrame:
    table = literal_table(
        prepared.sparkSession, enumerate(feature_names(prepared, column)), ["slot", "feature"]
    )
    return table.withColumn("slot", F.col("slot").cast("int"))


def nonzero_slots(prepared: DataFrame, vectors: Mapping[str, str], *keep: str) -> DataFrame:
    """Vectors in sparse long form: ``feature``, ``slot`` and ``value`` of each non-zero slot.

    ``vectors`` maps feature names to vector columns. One pass serves them all,
    and zeros go before rows are made of the slots.
    """
    def slots(feature: str, column: str) -> Column:
        named = F.transform(vector_to_array(F.col(column)), lambda value, slot: F.struct(
            F.lit(feature).alias("feature"), slot.alias("slot"), value.alias("value")))
        return F.filter(named, lambda s: s["value"] != 0)

    every = F.flatten(F.array(*[slots(f, c) for f, c in vectors.items()]))
    return prepared.select(*keep, F.explode(every).alias("_slot")).select(*keep, "_slot.*")


def with_class_weight(df: DataFrame, label: str = "y", weight: str = "weight") -> DataFrame:
    """Weight positives by the odds of the negative class, so both classes count alike.

    The positive rate stays in the plan as a scalar subquery.
    """
    rate = df.agg(F.avg(label).alias("p"))
    odds = rate.select(((1 - F.col("p")) / F.nullif(F.col("p"), F.lit(0.0))).alias("odds")).scalar()
    return df.withColumn(weight, F.when(F.col(label) == 1, odds).otherwise(F.lit(1.0)))


def with_unit_weight(df: DataFrame, weight: str = "weight") -> DataFrame:
    return df.withColumn(weight, F.lit(1.0))
