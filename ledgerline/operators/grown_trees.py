"""Boosted trees and forests grown level by level from histograms of binned rows.

The rules are those of Spark ML: thresholds, gains, stopping and pruning, on
every row in every pass. What differs is the form of the rows. A row is a
handful of bytes, each the bins of several features, and a pass counts bytes in
place of features; the histogram of a feature is a sum over the bytes that hold
its bin. Rows stay in blocks of numpy arrays that Spark keeps, passes over and
repeats; only histograms and splits leave them. The result is Spark's own model.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier, GBTClassificationModel, GBTClassifier, RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerline.session import fresh_dir, ship

CODES = 256  # what a byte tells apart
CHUNK = 32_768  # rows at a time: their arrays stay in a core's cache
BLOCK = 500_000  # rows that travel together
TASK = 4_000_000  # rows of a task at most; up to there one task a core, as starting a task costs more than its rows
ANCHOR = 20  # rounds after which margins start from the binned rows again, which bounds the lineage
EPSILON = 2.0 ** -52
SETTINGS = {"maxIter", "numTrees", "maxDepth", "stepSize", "minInstancesPerNode", "minInfoGain", "seed"}
DEEPEST = 10
TIE = 1e-10  # gains this close, as a share of the node's impurity, are one gain


def can_grow(classifier, overrides: Iterable[str]) -> bool:
    """Whether only settings read here differ from Spark's defaults."""
    return set(overrides) <= SETTINGS and 1 <= classifier.getMaxDepth() <= DEEPEST


class Bins:
    """Thresholds of every feature and the byte and digit that hold its bin."""

    def __init__(self, thresholds: Sequence[np.ndarray]):
        self.thresholds = list(thresholds)
        self.sizes = [len(t) + 1 for t in thresholds]
        self.column, self.stride, self.widths = [0] * len(self.sizes), [1] * len(self.sizes), []
        for slot in sorted(range(len(self.sizes)), key=lambda s: -self.sizes[s]):
            size = self.sizes[slot]
            fitting = [c for c, width in enumerate(self.widths) if width * size <= CODES]
            if not fitting:
                self.widths.append(1)
            column = fitting[0] if fitting else len(self.widths) - 1
            self.column[slot], self.stride[slot] = column, self.widths[column]
            self.widths[column] *= size
        starts = np.cumsum([0, *self.sizes])
        self.total = int(starts[-1])
        # Place of every feature's bins in a histogram; bins a feature lacks read the empty place at the end.
        bins = np.arange(max(self.sizes))
        self.places = np.where(bins < np.array(self.sizes)[:, None], starts[:-1, None] + bins, self.total)

    def encode(self, values: np.ndarray) -> np.ndarray:
        codes = np.zeros((len(values), len(self.widths)), np.uint8)
        for slot, thresholds in enumerate(self.thresholds):
            at = np.searchsorted(thresholds, values[:, slot]).astype(np.uint8)
            codes[:, self.column[slot]] += at * np.uint8(self.stride[slot])
        return codes

    def digit(self, slot: int) -> np.ndarray:
        """The feature's bin in each value of its byte."""
        return np.arange(CODES) // self.stride[slot] % self.sizes[slot]

    def per_feature(self, counted: np.ndarray) -> np.ndarray:
        """Sums per byte (bytes x nodes x codes) to sums per feature and bin (nodes x bins)."""
        parts = []
        for slot, size in enumerate(self.sizes):
            column, stride = self.column[slot], self.stride[slot]
            width = self.widths[column]
            digits = counted[column][:, :width].reshape(-1, width // (stride * size), size, stride)
            parts.append(digits.sum((1, 3)))
        return np.concatenate(parts, 1)


def thresholds_of(values: np.ndarray, max_bins: int) -> np.ndarray:
    """Candidate thresholds of a feature, by Spark's rule: between all values, or at strides of equal counts."""
    distinct, counts = np.unique(values, return_counts=True)
    middles = (distinct[:-1] + distinct[1:]) / 2
    if len(middles) < max_bins:
        return middles
    stride, through, chosen = len(values) / max_bins, np.cumsum(counts), []
    target = stride
    for i in range(len(middles)):
        if abs(through[i] - target) < abs(through[i + 1] - target):
            chosen.append(i)
            target += stride
    return middles[chosen]


def variance(stats: np.ndarray) -> np.ndarray:
    """Impurity of (count, sum, sum of squares)."""
    count = np.maximum(stats[..., 0], 1)
    return (stats[..., 2] - stats[..., 1] ** 2 / count) / count


def gini(stats: np.ndarray) -> np.ndarray:
    """Impurity of rows per class."""
    return 1 - ((stats / np.maximum(stats.sum(-1), 1)[..., None]) ** 2).sum(-1)


@dataclass
class Kind:
    """What a tree's statistics mean."""

    impurity: object
    count: object
    predict: object


VARIANCE = Kind(variance, lambda s: s[..., 0], lambda s: float(s[1] / s[0]) if s[0] else 0.0)
GINI = Kind(gini, lambda s: s.sum(-1), lambda s: float(np.argmax(s)))


def best_splits(
    sums: np.ndarray, bins: Bins, kind: Kind, least_rows: int, least_gain: float, allowed: np.ndarray | None = None
) -> list[tuple | None]:
    """Per node the split of highest gain as (feature, bin, gain, left, right statistics), if one gains.

    Of equal gains the first feature and bin wins.
    """
    sums = np.concatenate([sums, np.zeros_like(sums[:, :1])], 1)
    left = np.cumsum(sums[:, bins.places], 2)
    whole = left[:, :1, -1:]
    right = whole - left
    rows, left_rows, right_rows = kind.count(whole), kind.count(left), kind.count(right)
    impurity = kind.impurity(whole)
    shares = np.maximum(rows, 1)
    gain = impurity - left_rows / shares * kind.impurity(left) - right_rows / shares * kind.impurity(right)
    valid = (left_rows >= least_rows) & (right_rows >= least_rows) & (gain >= least_gain)
    valid &= np.arange(bins.places.shape[1]) < np.array(bins.sizes)[:, None] - 1
    if allowed is not None:
        valid &= allowed[:, :, None]
    gain = np.where(valid, gain, -np.inf).reshape(len(sums), -1)
    best = gain.max(1)
    at = np.argmax(gain >= (best - TIE * impurity[:, 0, 0])[:, None], 1)
    found = []
    for node, (place, most) in enumerate(zip(at, best)):
        slot, cut = divmod(int(place), bins.places.shape[1])
        own = float(gain[node, place])
        found.append((slot, cut, own, left[node, slot, cut], right[node, slot, cut]) if most > 0 and own > 0 else None)
    return found


@dataclass
class Tree:
    """A tree under growth. Nodes are (level, place in the level); children of place p are 2p and 2p + 1."""

    kind: Kind
    bins: Bins
    max_depth: int
    splits: dict = field(default_factory=dict)
    stats: dict = field(default_factory=dict)
    open: list = field(default_factory=lambda: [0])
    levels: list = field(default_factory=list)

    def take(self, found: Sequence[tuple | None]) -> None:
        """Splits found for the open nodes make the next level."""
        level, following = len(self.levels), []
        column = np.zeros(1 << level, np.int64)
        child = np.repeat(np.arange(1 << level, dtype=np.int64) * 2, CODES).reshape(-1, CODES)
        for place, split in zip(self.open, found):
            if split is None:
                continue
            slot, cut, _, left, right = split
            self.splits[level, place] = split
            column[place] = self.bins.column[slot]
            child[place] += self.bins.digit(slot) > cut
            for at, stats in ((2 * place, left), (2 * place + 1, right)):
                self.stats[level + 1, at] = stats
                if level + 1 < self.max_depth and abs(self.kind.impurity(stats)) >= EPSILON:
                    following.append(at)
        self.levels.append((column, child.astype(np.int16)))
        self.open = following

    def values(self) -> np.ndarray:
        """Prediction at every place below the last level."""
        depth = len(self.levels)
        values = np.zeros(1 << depth)
        for (level, place), stats in self.stats.items():
            if (level, place) not in self.splits:
                values[place << (depth - level)] = self.kind.predict(stats)
        return values

    def nodes(self) -> list[dict]:
        """Nodes as Spark's model files hold them, children after parents; leaves that predict alike are one."""
        def build(level, place):
            stats, split = self.stats[level, place], self.splits.get((level, place))
            own = {"prediction": self.kind.predict(stats), "impurity": float(self.kind.impurity(stats)),
                   "impurityStats": [float(v) for v in stats], "rawCount": int(self.kind.count(stats)), "gain": -1.0}
            if split is None:
                return own, None, None
            left, right = build(level + 1, 2 * place), build(level + 1, 2 * place + 1)
            if left[1] is None and right[1] is None and left[0]["prediction"] == right[0]["prediction"]:
                return own, None, None
            slot, cut, gain, *_ = split
            own |= {"gain": gain, "split": (slot, [float(self.bins.thresholds[slot][cut])], -1)}
            return own, left, right

        rows = []

        def number(node):
            own, left, right = node
            row = {"id": len(rows), "leftChild": -1, "rightChild": -1, "split": (-1, [], -1)} | own
            rows.append(row)
            if left is not None:
                row["leftChild"], row["rightChild"] = number(left), number(right)
            return row["id"]

        number(build(0, 0))
        keys = ("featureIndex", "leftCategoriesOrThreshold", "numCategories")
        return [row | {"split": dict(zip(keys, row["split"]))} for row in rows]


def route(levels: Sequence[tuple], codes: np.ndarray) -> np.ndarray:
    """Place of each row in the level below the given ones."""
    node = np.zeros(len(codes), np.int64)
    flat, first = codes.ravel(), np.arange(0, codes.size, codes.shape[1])
    for column, child in levels:
        node = child[node * CODES + flat[first + column[node]]]
    return node


def wide(levels: Sequence[tuple]) -> list[tuple]:
    """Routing tables in the type numpy indexes by; they travel in a smaller one."""
    return [(column, child.ravel().astype(np.int64)) for column, child in levels]


def counted(nodes: np.ndarray, size: int, codes: np.ndarray, weights: Sequence, into: np.ndarray) -> None:
    """Add weights (None: rows) per byte, node and code to ``into`` (weights x bytes x nodes * codes)."""
    base = nodes * CODES
    for column in range(codes.shape[1]):
        key = base + codes[:, column]
        for i, weight in enumerate(weights):
            into[i, column] += np.bincount(key, weight, size * CODES)


def chunks(rows: int, keys: int = 0) -> Iterator[slice]:
    """Rows in parts, no smaller than the histogram they are counted in."""
    size = max(CHUNK, keys)
    return (slice(at, at + size) for at in range(0, rows, size))


def binned(classifier, preparation: PipelineModel, train: DataFrame) -> tuple[RDD, Bins]:
    """Rows as blocks of (codes, labels), kept until released.

    Thresholds come from max(10,000, bins squared) rows, as Spark's own do.
    """
    ship(train.sparkSession)
    label, max_bins = classifier.getLabelCol(), classifier.getMaxBins()
    vector = vector_to_array(F.col(classifier.getFeaturesCol())).alias("v")
    rows, wanted = train.count(), max(max_bins ** 2, 10_000)
    drawn = train if rows <= wanted else train.sample(False, wanted / rows, classifier.getSeed())
    drawn = matrix(preparation.transform(drawn).select(vector).toArrow()["v"].combine_chunks())
    bins = Bins([thresholds_of(values, min(max_bins, rows)) for values in drawn.T])
    width = len(bins.widths)

    def block(codes, labels):
        arrays = [pa.array([np.concatenate(part).tobytes()], pa.binary()) for part in (codes, labels)]
        return pa.RecordBatch.from_arrays(arrays, ["codes", "y"])

    def encode(batches):
        codes, labels, held = [], [], 0
        for batch in batches:
            y = batch.column("y").to_numpy(zero_copy_only=False)
            if not np.isin(y, (0.0, 1.0)).all():
                raise ValueError(f"labels other than 0 and 1 in {label}")
            codes.append(bins.encode(matrix(batch.column("v"))))
            labels.append(y.astype(np.int8))
            held += len(y)
            if held >= BLOCK:
                yield block(codes, labels)
                codes, labels, held = [], [], 0
        if held:
            yield block(codes, labels)

    tasks = max(train.sparkSession.sparkContext.defaultParallelism, -(-rows // TASK))
    blocks = preparation.transform(train.coalesce(tasks)).select(vector, F.col(label).cast("double").alias("y")).mapInArrow(
        encode, "codes binary, y binary").rdd.map(lambda row: (
            np.frombuffer(row["codes"], np.uint8).reshape(-1, width), np.frombuffer(row["y"], np.int8)))
    return blocks.persist(StorageLevel.MEMORY_AND_DISK), bins


def matrix(vectors: pa.ListArray) -> np.ndarray:
    return vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), -1)


def residual_sums(state, levels: list, bins: Bins) -> Iterator[np.ndarray]:
    """Count, sum and sum of squares of the residuals per node, feature and bin."""
    size, levels = 1 << len(levels), wide(levels)
    into = None
    for codes, labels, margin in state:
        into = np.zeros((3, codes.shape[1], size * CODES)) if into is None else into
        for part in chunks(len(codes)):
            r = residuals(labels[part], margin[part])
            counted(route(levels, codes[part]), size, codes[part], (None, r, r * r), into)
    if into is not None:
        yield np.stack([bins.per_feature(sums.reshape(-1, size, CODES)) for sums in into], -1)


def residuals(labels: np.ndarray, margin: np.ndarray) -> np.ndarray:
    """What the next tree is fitted to: the labels, then the negative gradient of the logistic loss.

    Margins are NaN until there is a tree.
    """
    sign = 2.0 * labels - 1
    return np.where(np.isnan(margin), sign, 4 * sign / (1 + np.exp(2 * sign * margin)))


def boosted(codes, labels, margin, trees: Sequence[tuple]) -> tuple:
    """Rows with their margins after more trees (levels, values, weight)."""
    margin = np.where(np.isnan(margin), 0.0, margin)
    for levels, values, weight in trees:
        levels = wide(levels)
        for part in chunks(len(codes)):
            margin[part] += weight * values[route(levels, codes[part])]
    return codes, labels, margin


def boost(classifier: GBTClassifier, preparation: PipelineModel, train: DataFrame) -> GBTClassificationModel:
    """``GBTClassifier`` on many rows."""
    blocks, bins = binned(classifier, preparation, train)
    limits = classifier.getMinInstancesPerNode(), classifier.getMinInfoGain()
    start = blocks.map(lambda block: (*block, np.full(len(block[1]), np.nan)))
    state = start.map(tuple).persist(StorageLevel.MEMORY_AND_DISK)
    trees, grown, former = [], [], None
    for rounds in range(1, classifier.getMaxIter() + 1):
        tree = Tree(VARIANCE, bins, classifier.getMaxDepth())
        while tree.open:
            levels = tree.levels
            sums = sum(state.mapPartitions(lambda part: residual_sums(part, levels, bins)).collect())
            if former is not None:
                former, _ = None, former.unpersist()
            if not levels:
                tree.stats[0, 0] = sums[0, :bins.sizes[0]].sum(0)
            tree.take(best_splits(sums[tree.open], bins, VARIANCE, *limits))
        trees.append(tree)
        grown.append((tree.levels, tree.values(), classifier.getStepSize() if rounds > 1 else 1.0))
        if rounds < classifier.getMaxIter():
            origin, more = (start, list(grown)) if rounds % ANCHOR == 0 else (state, grown[-1:])
            former, state = state, origin.map(lambda s: boosted(*s, more)).persist(StorageLevel.MEMORY_AND_DISK)
    state.unpersist()
    blocks.unpersist()
    return as_model(train.sparkSession, classifier, DecisionTreeRegressor, GBTClassificationModel, trees,
                    [weight for *_, weight in grown])


def times_drawn(seed: Sequence[int], rows: int, rate: float) -> np.ndarray:
    """How often each row is in a bootstrap sample: Poisson numbers by inversion of 32 random bits."""
    at, left, bounds = 0, np.exp(-rate), []
    through = left
    while through < 1 - 2.0 ** -32:
        bounds.append(int(through * 2 ** 32))
        at += 1
        left *= rate / at
        through += left
    bits = np.random.default_rng(seed).integers(0, 2 ** 32, rows, np.uint32)
    drawn = np.zeros(rows, np.uint8)
    for bound in bounds:
        drawn += bits >= np.uint32(bound)
    return drawn


def class_sums(
    place: int, blocks: Iterator[tuple], trees: Sequence[tuple], bins: Bins, seed: int, rate: float | None
) -> Iterator[tuple[int, np.ndarray]]:
    """Per tree the rows drawn for it by open node, feature, bin and class."""
    blocks = list(blocks)  # bytes of at most TASK rows
    for number, levels, open_ in trees if blocks else ():
        levels, size = wide(levels), 2 << len(levels)
        into = np.zeros((1, len(bins.widths), size * CODES))
        for at, (codes, labels) in enumerate(blocks):
            drawn = None if rate is None else times_drawn([seed, number, place, at], len(codes), rate)
            for part in chunks(len(codes), size * CODES):
                nodes = route(levels, codes[part]) * 2 + labels[part]
                counted(nodes, size, codes[part], (None if drawn is None else drawn[part],), into)
        per_node = bins.per_feature(into[0].reshape(-1, size, CODES)).reshape(size // 2, 2, -1)
        yield number, per_node[open_].swapaxes(1, 2).astype(np.int64)


def grow_forest(
    classifier: RandomForestClassifier, preparation: PipelineModel, train: DataFrame
) -> RandomForestClassificationModel:
    """``RandomForestClassifier`` on many rows: all trees grow a level in one pass.

    Samples follow the seed, the tree and the block, features the seed, the tree and the node.
    """
    blocks, bins = binned(classifier, preparation, train)
    limits = classifier.getMinInstancesPerNode(), classifier.getMinInfoGain()
    seed, count = classifier.getSeed(), classifier.getNumTrees()
    rate = classifier.getSubsamplingRate() if classifier.getBootstrap() else None
    features = len(bins.sizes)
    every = classifier.getFeatureSubsetStrategy() == "all" or count == 1
    wanted = features if every else int(np.ceil(np.sqrt(features)))
    trees = [Tree(GINI, bins, classifier.getMaxDepth()) for _ in range(count)]

    def judged(item):
        number, sums = item
        allowed = np.zeros(sums.shape[:1] + (features,), bool)
        for row, at in enumerate(opened[number]):
            allowed[row, np.random.default_rng([seed, number, depth, at]).permutation(features)[:wanted]] = True
        found = best_splits(sums.astype(float), bins, GINI, *limits, allowed)
        return number, (found, sums[0, :bins.sizes[0]].sum(0).astype(float))

    for depth in range(classifier.getMaxDepth()):
        growing = [(number, tree.levels, tree.open) for number, tree in enumerate(trees) if tree.open]
        if not growing:
            break
        opened = {number: open_ for number, _, open_ in growing}
        sums = blocks.mapPartitionsWithIndex(lambda place, part: class_sums(place, part, growing, bins, seed, rate))
        splits = sums.reduceByKey(np.add, train.sparkSession.sparkContext.defaultParallelism).map(judged).collect()
        for number, (found, first) in splits:
            if depth == 0:
                trees[number].stats[0, 0] = first
            trees[number].take(found)
    blocks.unpersist()
    return as_model(train.sparkSession, classifier, DecisionTreeClassifier, RandomForestClassificationModel, trees,
                    [1.0] * count, numClasses=2)


def as_model(spark: SparkSession, classifier, member, kind, trees: Sequence[Tree], weights: Sequence[float], **more):
    """Trees as a fitted model of Spark ML, read from files of its own format."""
    path = fresh_dir(spark, "grown-trees")
    lone = member(**{p: classifier.getOrDefault(p) for p in ("labelCol", "featuresCol", "maxDepth", "seed")})

    def described(estimator, model_class: str, **extra) -> str:
        at = fresh_dir(spark, "estimator")
        estimator.save(at)
        return json.dumps(json.loads(spark.read.text(f"{at}/metadata").first()[0]) | {"class": model_class} | extra)

    one = json.loads(described(lone, lone_class(member)))
    one = [json.dumps(one | {"uid": f"{one['uid']}_{i}"}) for i in range(len(trees))]
    owner = f"org.apache.spark.ml.classification.{kind.__name__}"
    features = len(trees[0].bins.sizes)
    own = described(classifier, owner, numFeatures=features, numTrees=len(trees), **more)
    spark.createDataFrame([(own,)], "value string").coalesce(1).write.text(f"{path}/metadata")
    spark.createDataFrame(pa.table({
        "_1": pa.array(range(len(trees)), pa.int32()), "_2": pa.array(one), "_3": pa.array(list(weights), pa.float64()),
    })).coalesce(1).write.parquet(f"{path}/treesMetadata")
    rows = [{"treeID": i, "nodeData": node} for i, tree in enumerate(trees) for node in tree.nodes()]
    spark.createDataFrame(pa.Table.from_pylist(rows, NODES)).coalesce(1).write.parquet(f"{path}/data")
    return kind.load(path)


def lone_class(member) -> str:
    package = "regression" if member is DecisionTreeRegressor else "classification"
    name = member.__name__.replace("Classifier", "Classification").replace("Regressor", "Regression")
    return f"org.apache.spark.ml.{package}.{name}Model"


NODES = pa.schema([("treeID", pa.int32()), ("nodeData", pa.struct([
    ("id", pa.int32()), ("prediction", pa.float64()), ("impurity", pa.float64()),
    ("impurityStats", pa.list_(pa.float64())), ("rawCount", pa.int64()), ("gain", pa.float64()),
    ("leftChild", pa.int32()), ("rightChild", pa.int32()),
    ("split", pa.struct([("featureIndex", pa.int32()), ("leftCategoriesOrThreshold", pa.list_(pa.float64())),
                         ("numCategories", pa.int32())]))]))])
