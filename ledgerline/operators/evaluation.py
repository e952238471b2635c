"""Classifier metrics as exact aggregates over (score, prediction, label)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerline.operators import ordered
from ledgerline.session import fresh_dir
from ledgerline.sources.files import store


def with_score(predictions: DataFrame, raw: str = "rawPrediction", score: str = "score") -> DataFrame:
    """Score of the positive class as a plain number."""
    return predictions.withColumn(score, vector_to_array(F.col(raw))[1])


def _known(score: str, label: str) -> Column:
    return F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double")) & F.col(label).isNotNull()


def _per_score(scored: DataFrame, score: str, label: str) -> DataFrame:
    """Positives and negatives of each distinct score, with running counts from the lowest."""
    per_score = scored.where(_known(score, label)).groupBy(score).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )
    return ordered.running_counts(per_score, score, ("pos", "neg"))


def auc(scored: DataFrame, score: str = "score", label: str = "y") -> DataFrame:
    """Area under the ROC curve, exact, ties counted half.

    Each positive beats the negatives that score lower. Rows combine per
    distinct score first, then negatives are counted cumulatively. Rows whose
    score is NULL or NaN, or whose label is NULL, are left out.
    """
    running = _per_score(scored, score, label)
    beaten = F.col("neg_through") - F.col("neg") / 2
    pairs = F.max("pos_total").cast("double") * F.max("neg_total")
    wins = F.sum(F.col("pos").cast("double") * beaten)
    return running.agg((wins / F.nullif(pairs, F.lit(0.0))).alias("roc_auc"))


def _share(part: Column, whole: Column) -> Column:
    """Ratio that is 0 where there is nothing to divide by."""
    return F.when(whole == 0, 0.0).otherwise(part / whole)


def confusion(scored: DataFrame, label: str = "y", prediction: str = "prediction") -> DataFrame:
    return scored.groupBy(label, prediction).agg(F.count(F.lit(1)).alias("n"))


def _class_counts(scored: DataFrame, levels: Sequence, label: str, prediction: str) -> DataFrame:
    actual, predicted = F.col(label), F.col(prediction)
    return scored.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if((actual == c) & (predicted == c)).alias(f"hit_{c}") for c in levels],
        *[F.count_if(predicted == c).alias(f"predicted_{c}") for c in levels],
        *[F.count_if(actual == c).alias(f"actual_{c}") for c in levels],
    )


def _precision(c) -> Column:
    return _share(F.col(f"hit_{c}"), F.col(f"predicted_{c}"))


def _recall(c) -> Column:
    return _share(F.col(f"hit_{c}"), F.col(f"actual_{c}"))


def _weighted(levels: Sequence) -> list[Column]:
    def average(metric):
        return sum(F.col(f"actual_{c}") / F.nullif(F.col("n"), F.lit(0)) * metric(c) for c in levels)

    def f1(c):
        return _share(2 * _precision(c) * _recall(c), _precision(c) + _recall(c))

    return [
        average(f1).alias("f1"), average(_precision).alias("weighted_precision"), average(_recall).alias("weighted_recall")]


def weighted_metrics(
    scored: DataFrame, levels: Sequence = (0, 1), label: str = "y", prediction: str = "prediction"
) -> DataFrame:
    """F1, precision and recall averaged over classes by their share of rows."""
    return _class_counts(scored, levels, label, prediction).select(*_weighted(levels))


def class_metrics(
    scored: DataFrame, level=1, label: str = "y", prediction: str = "prediction"
) -> DataFrame:
    """Precision and recall of one class, the positive one by default.

    The weighted recall above equals accuracy; this is the share of true
    subscribers found.
    """
    return _class_counts(scored, [level], label, prediction).select(
        _precision(level).alias("precision"), _recall(level).alias("recall")
    )


def metrics(scored: DataFrame, score: str = "score", label: str = "y", prediction: str = "prediction") -> DataFrame:
    """All metrics of one model as one row: one pass for the score, one for the classes."""
    return _class_counts(scored, (0, 1), label, prediction).select(
        auc(scored, score, label).scalar().alias("roc_auc"), *_weighted((0, 1)),
        _precision(1).alias("positive_precision"), _recall(1).alias("positive_recall"),
    )


def precision_recall(scored: DataFrame, score: str = "score", label: str = "y") -> DataFrame:
    """One row per distinct score: what calling everyone with at least that score would bring.

    ``threshold``, ``tp``, ``fp``, ``fn``, ``precision``, ``recall`` and ``step``, the recall
    gained over the next higher threshold. Rows of one score are called together or not at all. Without
    positives recall and step are NULL. Left out as in ``auc``.
    """
    running = _per_score(scored, score, label)
    tp = F.col("pos_total") - F.col("pos_through") + F.col("pos")
    fp = F.col("neg_total") - F.col("neg_through") + F.col("neg")
    positives = F.nullif(F.col("pos_total"), F.lit(0))
    return running.select(
        F.col(score).alias("threshold"), tp.alias("tp"), fp.alias("fp"), (F.col("pos_total") - tp).alias("fn"),
        (tp / (tp + fp)).alias("precision"), (tp / positives).alias("recall"), (F.col("pos") / positives).alias("step"))


def average_precision(curve: DataFrame) -> DataFrame:
    """Area under the precision/recall curve in steps, as one row."""
    return curve.agg(F.sum(F.col("step") * F.col("precision")).alias("average_precision"))


def best_threshold(curve: DataFrame, call_cost: float, missed_value: float) -> DataFrame:
    """The threshold with the lowest cost, as one row.

    A call to someone who declines costs ``call_cost``, a subscriber not called
    costs ``missed_value``. Of equal costs the highest threshold wins. Calling nobody is no
    threshold of the curve; an empty curve gives one row of NULL.
    """
    cost = F.lit(float(call_cost)) * F.col("fp") + F.lit(float(missed_value)) * F.col("fn")
    row = F.struct(cost.alias("cost"), *["threshold", "tp", "fp", "fn", "precision", "recall"])
    return curve.agg(F.min_by(row, F.struct(cost, -F.col("threshold"))).alias("best")).select("best.*")


def threshold_at_capacity(curve: DataFrame, calls: int) -> DataFrame:
    """The lowest threshold that asks for no more than ``calls`` calls; one row of NULL if the top score alone has more."""
    fits = F.col("tp") + F.col("fp") <= calls
    row = F.struct("threshold", (F.col("tp") + F.col("fp")).alias("n_calls"), "precision", "recall")
    return curve.where(fits).agg(F.min_by(row, "threshold").alias("best")).select("best.*")


def lift_by_share(
    scored: DataFrame, key: str, parts: int = 10, score: str = "score", label: str = "y"
) -> DataFrame:
    """Rows in ``parts`` groups of falling score, sizes at most one apart, and what each brings.

    ``part`` 1 has the highest scores; the first parts take the odd rows, ties
    in score go by ``key``. Per part: ``n``, ``n_positive``, ``rate``, ``lift`` (its rate
    over that of all rows), ``captured`` (share of all positives up to and
    including the part) and the score range. Places come from row numbers over
    ranges of scores, so no task sorts the table. Left out as in ``auc``; with
    fewer rows than parts the later parts are missing.
    """
    rows = scored.where(_known(score, label)).select(
        F.col(key).alias("_key"), F.col(score).alias("_score"), F.col(label).alias("_label"))
    rows = store(rows, fresh_dir(scored.sparkSession, "lift"))
    placed = ordered.row_numbers(rows, [F.desc("_score"), F.asc("_key")], "_place").withColumn(
        "_n", rows.agg(F.count(F.lit(1))).scalar())
    small = F.floor(F.col("_n") / parts)
    odd = F.col("_n") % parts
    edge = odd * (small + 1)
    part = F.when(F.col("_place") <= edge, F.floor((F.col("_place") - 1) / (small + 1))).otherwise(
        odd + F.floor((F.col("_place") - 1 - edge) / small)) + 1
    per_part = placed.groupBy(part.cast("int").alias("part")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("_label") == 1).alias("n_positive"),
        F.max("_score").alias("highest"), F.min("_score").alias("lowest"))
    # One row per part from here on.
    through = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy()
    positives = F.nullif(F.sum("n_positive").over(whole), F.lit(0))
    rate = F.col("n_positive") / F.col("n")
    return per_part.select(
        "part", "n", "n_positive", rate.alias("rate"),
        (rate * F.sum("n").over(whole) / positives).alias("lift"),
        (F.sum("n_positive").over(through) / positives).alias("captured"), "highest", "lowest")
