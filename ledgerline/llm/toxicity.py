"""Toxicity by classifier chain: each category's linear model sees the probabilities of those before.

Earlier probabilities in the training rows are out of fold: a row's comes from
a model that was fitted without the row, as it will be for unseen rows. The
models are fitted on a bounded sample of labelled rows and travel with the
tasks as word weights; every document is scored whole.
"""

from __future__ import annotations

import math
import re
import warnings
from collections import Counter
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ledgerline.llm.common import ship, whole_text

#: Labelled rows used to fit, at most (in expectation) beside those of MIN_PER_CLASS; drawn by a hash of the id.
MAX_LABELLED = 5_000
#: Rows of each class of the last category that are drawn (in expectation) where there are as many.
MIN_PER_CLASS = 500
#: Words a model may weigh: those in most sampled rows, in at least MIN_ROWS.
MAX_WORDS = 50_000
MIN_ROWS = 5
FOLDS = 3
ROUNDS = 100
RIDGE = 1e-4
_WORD = re.compile(r"[^\W\d_]+")


class Category(NamedTuple):
    """A link of the chain: its name and its 0/1 label as an expression over the labels."""

    name: str
    label: str


#: Poor writing first, as it may tell on toxicity; the last category decides.
CHAIN = (Category("low_quality", "1 - quality"), Category("toxic", "toxic"))


class Rows(NamedTuple):
    """Distinct word numbers of each row, row by row, and what each row stands for."""

    words: np.ndarray
    row: np.ndarray
    weight: np.ndarray

    @property
    def count(self) -> int:
        return len(self.weight)

    def only(self, keep: np.ndarray) -> "Rows":
        place = np.cumsum(keep) - 1
        taken = keep[self.row]
        return Rows(self.words[taken], place[self.row[taken]], self.weight[keep])


class Linear(NamedTuple):
    """Log-odds = bias + earlier . p + (sum of weights over words) / (norm of ratios over words)."""

    weights: np.ndarray
    ratios: np.ndarray
    earlier: np.ndarray
    bias: float


class Chain(NamedTuple):
    categories: tuple[str, ...]
    vocabulary: dict[str, int]
    models: tuple[Linear, ...]
    threshold: float


def words_of(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit_linear(rows: Rows, labels: np.ndarray, earlier: np.ndarray, size: int) -> Linear:
    """Logistic regression on words scaled by their class log-ratio, rows of unit length."""
    weight, total = rows.weight, max(rows.weight.sum(), 1)
    hits = np.bincount(rows.words, weights=(weight * labels)[rows.row], minlength=size)
    seen = np.bincount(rows.words, weights=weight[rows.row], minlength=size)
    positives = (weight * labels).sum()
    ratios = np.log((hits + 1) / (positives + 2)) - np.log((seen - hits + 1) / (total - positives + 2))
    values = ratios[rows.words]
    norms = np.sqrt(np.bincount(rows.row, weights=values**2, minlength=rows.count) + 1)
    values = values / norms[rows.row]
    w, e, b = np.zeros(size), np.zeros(earlier.shape[1]), 0.0
    w_at, e_at, b_at, before = w, e, b, 1.0
    step = 4.0 / (2 + earlier.shape[1])
    for _ in range(ROUNDS):
        z = np.bincount(rows.row, weights=w_at[rows.words] * values, minlength=rows.count)
        gap = (_sigmoid(z + earlier @ e_at + b_at) - labels) * weight / total
        slope = np.bincount(rows.words, weights=gap[rows.row] * values, minlength=size)
        w_new = w_at - step * (slope + RIDGE * w_at)
        e_new = e_at - step * (earlier.T @ gap + RIDGE * e_at)
        b_new = b_at - step * gap.sum()
        after = (1 + math.sqrt(1 + 4 * before**2)) / 2
        push = (before - 1) / after
        w_at, e_at, b_at = w_new + push * (w_new - w), e_new + push * (e_new - e), b_new + push * (b_new - b)
        w, e, b, before = w_new, e_new, b_new, after
    return Linear(w * ratios, ratios**2, e, float(b))


def predict_rows(model: Linear, rows: Rows, earlier: np.ndarray) -> np.ndarray:
    total = np.bincount(rows.row, weights=model.weights[rows.words], minlength=rows.count)
    norms = np.sqrt(np.bincount(rows.row, weights=model.ratios[rows.words], minlength=rows.count) + 1)
    return _sigmoid(total / norms + earlier @ model.earlier + model.bias)


def best_threshold(scores: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> float:
    """The cut with the best F1 on out-of-fold probabilities, half way to the next lower one."""
    order = np.argsort(-scores, kind="stable")
    hits = np.cumsum((weight * labels)[order])
    f1 = 2 * hits / (np.cumsum(weight[order]) + (weight * labels).sum())
    at = int(np.argmax(f1))
    below = scores[order[at + 1]] if at + 1 < len(order) else 0.0
    return float((scores[order[at]] + below) / 2)


def labelled_rows(
    docs: DataFrame, labels: DataFrame, chain: Sequence[Category] = CHAIN, id_col: str = "doc_id",
    text_col: str = "text", max_labelled: int = MAX_LABELLED, min_per_class: int = MIN_PER_CLASS,
) -> DataFrame:
    """A bounded draw of labelled documents: ``words``, one 0/1 column per category, ``weight`` and ``_draw``.

    Rows without an id or with a NULL in any label are left out; of several labels or documents
    of an id the least counts. All rows are drawn with one chance, but a rare
    class of the last category with a higher one, so that it is not
    missed; ``weight`` makes up for that. The drawn labels are few, so they
    travel to the documents and not the other way.
    """
    ship(docs.sparkSession)
    last = f"_y{len(chain) - 1}"
    values = [F.expr(c.label).cast("int").alias(f"_y{i}") for i, c in enumerate(chain)]
    known = labels.select(F.col(id_col).alias("_id"), *values).dropna().groupBy("_id").agg(
        F.min(F.struct(*[f"_y{i}" for i in range(len(chain))])).alias("_y")).select("_id", "_y.*")
    known = known.where(F.col(last).isin(0, 1))
    sizes = {r[0]: r[1] for r in known.groupBy(last).agg(F.count(F.lit(1))).collect()}  # two classes
    even = min(1.0, max_labelled / max(sum(sizes.values()), 1))
    chance = {c: min(1.0, max(even, min_per_class / n)) for c, n in sizes.items()}
    share = F.when(F.col(last) == 1, F.lit(chance.get(1, 1.0))).otherwise(F.lit(chance.get(0, 1.0)))
    draw = F.pmod(F.xxhash64("_id", F.lit("labelled")), F.lit(1 << 30))
    drawn = known.withColumns({"_draw": draw, "weight": F.lit(even) / share}).where(F.col("_draw") < share * (1 << 30))
    rows = docs.select(F.col(id_col).alias("_id"), whole_text(text_col).alias("_text"))
    found = rows.join(F.broadcast(drawn), "_id")

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [sorted(words_of(text.as_py())) for text in batch.column(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(words, pa.list_(pa.string()))], [*batch.schema.names[:-1], "words"])

    keys = ["_id", "_draw", "weight", *[f"_y{i}" for i in range(len(chain))]]
    texts = found.select(*keys, "_text")
    schema = T.StructType([*texts.schema.fields[:-1], T.StructField("words", T.ArrayType(T.StringType()))])
    return texts.mapInArrow(split, schema).groupBy(*keys).agg(F.min("words").alias("words"))


def fit_chain(training: DataFrame, chain: Sequence[Category] = CHAIN) -> Chain | None:
    """Fit the categories in order; None where the last one has no row of one of its classes.

    Rows are dealt to folds within each class, so every fold has its share of
    a rare one. An earlier category that is constant says nothing and harms nothing.
    """
    last = f"_y{len(chain) - 1}"
    table = training.orderBy(last, "_draw", "words").drop("_id").toArrow()
    lists = table["words"].combine_chunks() if table.num_rows else []
    counts: Counter = Counter()
    for words in lists:
        counts.update(words.as_py())
    kept = sorted((w for w, n in counts.items() if n >= MIN_ROWS), key=lambda w: (-counts[w], w))[:MAX_WORDS]
    vocabulary = {word: i for i, word in enumerate(kept)}
    numbers, at = [], []
    for i, words in enumerate(lists):
        own = [vocabulary[w] for w in words.as_py() if w in vocabulary]
        numbers += own
        at += [i] * len(own)
    rows = Rows(np.array(numbers, dtype=np.int64), np.array(at, dtype=np.int64), table["weight"].to_numpy())
    decisive = table[last].to_numpy()
    if len(set(decisive)) < 2:
        warnings.warn(f"no labelled row of one class of {chain[-1].name!r}: nothing can be told apart", stacklevel=2)
        return None
    fold = np.arange(rows.count) % FOLDS  # rows are sorted by class
    earlier = np.zeros((rows.count, 0))
    models = []
    for i in range(len(chain)):
        y = table[f"_y{i}"].to_numpy().astype(float)
        models.append(fit_linear(rows, y, earlier, len(kept)))
        unseen = np.zeros(rows.count)
        for k in range(FOLDS):
            inside = fold != k
            part = fit_linear(rows.only(inside), y[inside], earlier[inside], len(kept))
            unseen[~inside] = predict_rows(part, rows.only(~inside), earlier[~inside])
        earlier = np.column_stack([earlier, unseen])
    threshold = best_threshold(earlier[:, -1], y, rows.weight)
    return Chain(tuple(c.name for c in chain), vocabulary, tuple(models), threshold)


def predict_text(chain: Chain, text: str) -> list[float]:
    """Probabilities of the categories in order."""
    numbers = [i for w in words_of(text) if (i := chain.vocabulary.get(w)) is not None]
    found: list[float] = []
    for model in chain.models:
        total = model.weights[numbers].sum() / math.sqrt(model.ratios[numbers].sum() + 1)
        z = total + sum(p * c for p, c in zip(found, model.earlier)) + model.bias
        found.append(float(_sigmoid(z)))
    return found


def score_toxicity(
    docs: DataFrame, labels: DataFrame, chain: Sequence[Category] = CHAIN, id_col: str = "doc_id",
    text_col: str = "text", threshold: float | None = None,
) -> DataFrame:
    """All columns of the documents plus ``p_<category>`` in chain order and ``rejected``.

    ``rejected`` says that the last category reaches ``threshold``, by default
    the one that does best on out-of-fold probabilities. NULL and
    empty texts have no words and get the base rate. Without any label of one class of the last
    category there is nothing to learn: a warning is given, probabilities are NULL and nothing is rejected.
    Repeated rows repeat; no rows in, no rows out; a column of the documents
    with the name of a result column is replaced. Scoring is one narrow pass.
    """
    spark = docs.sparkSession
    ship(spark)
    names = [f"p_{c.name}" for c in chain]
    rows = docs.drop(*names, "rejected")
    fitted = fit_chain(labelled_rows(docs, labels, chain, id_col, text_col), chain)
    if fitted is None:
        return rows.withColumns({n: F.lit(None).cast("double") for n in names}).withColumn(
            "rejected", F.lit(False))
    shared = spark.sparkContext.broadcast(fitted)  # at most MAX_WORDS words
    place = rows.columns.index(text_col)
    outputs = [*rows.columns, *names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            scores = [predict_text(model, text.as_py() or "") for text in batch.column(place)]
            columns = [pa.array([s[i] for s in scores], pa.float64()) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], outputs)

    fields = [*rows.schema.fields, *[T.StructField(n, T.DoubleType()) for n in names]]
    scored = rows.mapInArrow(run, T.StructType(fields))
    return scored.withColumn("rejected", F.col(names[-1]) >= F.lit(fitted.threshold if threshold is None else threshold))
