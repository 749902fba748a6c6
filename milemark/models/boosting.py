"""Gradient-boosted trees over histograms, fitted in few passes and returned as MLlib models.

The method is that of MLlib's ``GBTClassifier`` and ``GBTRegressor``: trees of least squares on gradients, features cut
into ``maxBins``, a new sample of rows for each round, a new draw of features for each node. MLlib keeps every row as
objects, samples and caches them again in each round, and runs several jobs for it. Here rows are binned once and kept as
blocks of arrays; a level of a tree is one pass that adds up histograms. A tree sees a row by its bins only, so rows of a
block that agree in bins, label and weight have the same margin in all rounds and are kept once, with their number; how
many of them a round samples is binomial, as if each was drawn.
"""

from __future__ import annotations

import math
import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

#: Rows of a block: what a task holds at a time.
BLOCK_ROWS = 1 << 17
#: Points of a feature's weighted quantiles that a task reports where it has more values than bins.
QUANTILES = 512
#: Margins are brought up to date after so many rounds; until then a pass applies the trees since.
REFRESH_ROUNDS = 10

_STATS = 4  # rows, weight, weighted sum, weighted sum of squares


# --- bins ---


def _merged(values: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in order, with their total weights."""
    distinct, place = np.unique(values, return_inverse=True)
    return distinct, np.bincount(place, weights=weights, minlength=len(distinct))


def _thinned(values: np.ndarray, weights: np.ndarray, points: int) -> tuple[np.ndarray, np.ndarray]:
    """At most ``points`` values that split the weight evenly, each with the weight since the one before."""
    if len(values) <= points:
        return values, weights
    upto = np.cumsum(weights)
    at = np.unique(np.searchsorted(upto, upto[-1] * np.arange(1, points + 1) / points).clip(max=len(values) - 1))
    return values[at], np.diff(upto[at], prepend=0.0)


def _summaries(features: int, weighted: bool, bins: int):
    """One row per task: rows, rows that cannot be used, and per feature values with weights."""

    def run(batches):
        rows = bad = 0
        held = [(np.empty(0), np.empty(0))] * features
        for batch in batches:
            columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(batch.num_columns)]
            weight = columns[1] if weighted else np.ones(batch.num_rows)
            rows += batch.num_rows
            usable = np.isfinite(columns[0]) & np.isfinite(weight) & (weight >= 0)
            for x in columns[2:]:
                usable &= ~np.isnan(x)
            bad += int((~usable).sum())
            if bad:
                continue
            for f, x in enumerate(columns[2:]):
                v, w = held[f]
                v, w = _merged(np.concatenate([v, x]), np.concatenate([w, weight]))
                held[f] = _thinned(v, w, max(16 * QUANTILES, bins + 1))
        final = [_thinned(v, w, max(QUANTILES, bins + 1)) for v, w in held]
        yield pa.RecordBatch.from_arrays(
            [pa.array([rows]), pa.array([bad]), pa.array([pickle.dumps(final)], pa.binary())], ["rows", "bad", "held"]
        )

    return run


def _thresholds(values: np.ndarray, weights: np.ndarray, bins: int) -> np.ndarray:
    """Borders of the bins, as MLlib sets them: between all values if these are few, else by equal weights."""
    middles = (values[:-1] + values[1:]) / 2
    if len(values) <= bins:
        return middles
    stride = weights.sum() / bins
    found, before, target = [], weights[0], stride
    for middle, weight in zip(middles, weights[1:], strict=True):
        if abs(before - target) < abs(before + weight - target):
            found.append(middle)
            target += stride
        before += weight
    return np.array(found[: bins - 1])


# --- blocks ---


@dataclass
class _Block:
    number: tuple[int, int]
    bins: np.ndarray  # (features, rows), uint8
    y: np.ndarray
    weight: np.ndarray
    n: np.ndarray
    margin: np.ndarray


def _blocks(cuts: list[np.ndarray], weighted: bool):
    """Rows as pickled blocks; equal ones are counted. A block takes in rows until so many distinct ones are in it."""
    names = [f"b{i}" for i in range(len(cuts))] + ["y", "weight"]

    def counted(tables):
        table = pa.concat_tables(tables)
        grouped = table.group_by(names, use_threads=False).aggregate([("n", "sum")])
        return grouped.rename_columns([*(c.removesuffix("_sum") for c in grouped.column_names)]).select([*names, "n"])

    def run(batches):
        from pyspark import TaskContext

        part, number = TaskContext.get().partitionId(), 0

        def emit(table):
            columns = [table.column(c).combine_chunks().to_numpy(zero_copy_only=False) for c in names]
            n = table.column("n").to_numpy()
            block = _Block((part, number), np.array(columns[:-2], np.uint8).reshape(len(cuts), len(n)), columns[-2].copy(), columns[-1].copy(), n.copy(), np.zeros(len(n)))
            return pa.RecordBatch.from_arrays([pa.array([pickle.dumps(block, 5)], pa.binary()), pa.array([len(n)])], ["block", "rows"])

        held, rows = [], 0
        for batch in batches:
            label = batch.column(0)
            weight = batch.column(1) if weighted else pa.array(np.ones(batch.num_rows))
            binned = [pa.array(np.searchsorted(cut, batch.column(2 + i).to_numpy(zero_copy_only=False)).astype(np.uint8)) for i, cut in enumerate(cuts)]
            held.append(pa.table([*binned, label, weight, pa.array(np.ones(batch.num_rows, np.int64))], names=[*names, "n"]))
            rows += batch.num_rows
            if rows >= BLOCK_ROWS:
                held = [counted(held)]
                rows = held[0].num_rows
                if rows > BLOCK_ROWS // 2:
                    yield emit(held[0])
                    held, rows, number = [], 0, number + 1
        if rows:
            yield emit(counted(held))

    return run


# --- trees as arrays: children of node i are 2i and 2i + 1, the root is 1 ---


@dataclass
class _Tree:
    feature: np.ndarray
    border: np.ndarray  # a row whose bin is above goes right; 255 for leaves, which hand their value to the left
    value: np.ndarray
    gain: np.ndarray
    stats: np.ndarray
    split: np.ndarray

    @staticmethod
    def empty(depth: int) -> _Tree:
        size = 2 << depth
        return _Tree(
            np.zeros(size, np.intp), np.full(size, 255, np.uint8), np.zeros(size), np.zeros(size), np.zeros((size, _STATS)), np.zeros(size, bool)
        )


def _places(tree: _Tree, bins: np.ndarray, levels: int) -> np.ndarray:
    """The node of each row after so many levels."""
    node = np.ones(bins.shape[1], np.intp)
    every = np.arange(bins.shape[1])
    for _ in range(levels):
        here = bins[tree.feature[node], every] if len(bins) else np.zeros(len(node), np.uint8)
        node = 2 * node + (here > tree.border[node])
    return node


def _with_trees(block: _Block, trees: list[tuple[float, _Tree]], depth: int) -> np.ndarray:
    margin = block.margin
    for factor, tree in trees:
        margin = margin + factor * tree.value[_places(tree, block.bins, depth)]
    return margin


def _target(y: np.ndarray, margin: np.ndarray, started: bool, classify: bool) -> np.ndarray:
    """What the next tree fits: the label, later the negative gradient of the loss (log loss on -1 and 1, or squares)."""
    if not started:
        return y
    if classify:
        with np.errstate(over="ignore"):
            return 4.0 * y / (1.0 + np.exp(2.0 * y * margin))
    return 2.0 * (y - margin)


def _sampled(n: np.ndarray, rate: float, key: list[int]) -> np.ndarray:
    """How many of ``n`` equal rows take part in a round: each does by a draw of its own."""
    if rate >= 1:
        return n
    rng = np.random.Generator(np.random.Philox(np.random.SeedSequence(key)))
    taken = (rng.random(len(n)) < rate).astype(np.int64)
    several = n > 1
    if several.any():
        taken[several] = rng.binomial(n[several], rate)
    return taken


def _histograms(trees, tree, level, depth, rate, key, started, classify, width):
    """Per node of the level, feature and bin: rows, weight, sum and sum of squares of the target; one array per task."""

    def run(blocks):
        total = None
        for block in blocks:
            taken = _sampled(block.n, rate, [*key, *block.number])
            target = _target(block.y, _with_trees(block, trees, depth), started, classify)
            weight = taken * block.weight
            parts = [taken, taken if (block.weight == 1).all() else weight, weight * target, weight * target * target]
            node = _places(tree, block.bins, level) - (1 << level)
            nodes = 1 << level
            # without a feature the one column holds the totals
            found = np.empty((nodes, max(len(block.bins), 1), width, _STATS))
            for f in range(found.shape[1]):
                place = node * width + (block.bins[f] if len(block.bins) else 0)
                for s, part in enumerate(parts):
                    if s == 1 and parts[1] is parts[0]:
                        found[:, f, :, 1] = found[:, f, :, 0]
                    else:
                        found[:, f, :, s] = np.bincount(place, weights=part, minlength=nodes * width).reshape(nodes, width)
            total = found if total is None else total + found
        if total is not None:
            yield total

    return run


def _impurity(stats: np.ndarray) -> float:
    _, weight, total, squares = stats
    return (squares - total * total / weight) / weight if weight > 0 else 0.0


def _grow(tree: _Tree, level: int, found: np.ndarray, cuts: list[np.ndarray], subset: int, rng: np.random.Generator) -> bool:
    """Split the nodes of a level where that gains something; tells whether any was."""
    any_split = False
    for k in range(1 << level):
        i = (1 << level) + k
        if level and not tree.split[i >> 1]:
            continue
        whole = found[k, 0].sum(axis=0)
        if level == 0:
            tree.stats[i], tree.value[i] = whole, whole[2] / whole[1] if whole[1] > 0 else 0.0
        impurity, best = _impurity(tree.stats[i]), (0.0, 0, 0, None, None)
        chosen = np.sort(rng.choice(len(cuts), subset, replace=False)) if cuts else []
        for f in chosen:
            left = np.cumsum(found[k, f], axis=0)[: len(cuts[f])]
            for b, low in enumerate(left):
                high = whole - low
                if low[0] < 1 or high[0] < 1 or low[1] <= 0 or high[1] <= 0:
                    continue
                gain = impurity - (low[1] * _impurity(low) + high[1] * _impurity(high)) / whole[1]
                if gain > best[0]:
                    best = (gain, int(f), b, low, high)
        gain, f, b, low, high = best
        if gain > 0:
            tree.feature[i], tree.border[i], tree.gain[i], tree.split[i] = f, b, gain, True
            for child, part in ((2 * i, low), (2 * i + 1, high)):
                tree.stats[child], tree.value[child] = part, part[2] / part[1]
            any_split = True
    return any_split


def _closed(tree: _Tree) -> None:
    """Leaves hand their value down to the left, where their rows arrive; equal leaves become one."""
    for i in range(len(tree.split) // 2 - 1, 0, -1):
        left, right = 2 * i, 2 * i + 1
        if tree.split[i] and not (tree.split[left] or tree.split[right]) and tree.value[left] == tree.value[right]:
            tree.split[i], tree.border[i], tree.value[i] = False, 255, tree.value[left]
    for i in range(1, len(tree.split) // 2):
        if not tree.split[i]:
            tree.value[2 * i] = tree.value[i]


def _fit(train: DataFrame, features: list[str], estimator, classify: bool) -> tuple[list[_Tree], list[np.ndarray]]:
    get = lambda name: estimator.getOrDefault(name)
    rounds, depth, rate, seed, bins = get("maxIter"), get("maxDepth"), get("subsamplingRate"), get("seed") % (1 << 63), get("maxBins")
    weighted = estimator.isDefined("weightCol")
    weight = F.col(get("weightCol")) if weighted else F.lit(1.0)
    rows = train.select(F.col(get("labelCol")).cast("double").alias("y"), weight.cast("double").alias("weight"), *[F.col(f).cast("double").alias(f) for f in features])
    parts = rows.mapInArrow(_summaries(len(features), weighted, bins), "rows long, bad long, held binary").collect()
    total = sum(p["rows"] for p in parts)
    if total == 0:
        raise ValueError("boosted trees need at least one row")
    if any(p["bad"] for p in parts):
        raise ValueError("boosted trees need labels, features and weights that are neither null nor NaN, and weights of 0 at least")
    bins = min(bins, max(total, 2))
    held = [pickle.loads(p["held"]) for p in parts if p["rows"]]
    cuts = [
        _thresholds(*_merged(np.concatenate([h[f][0] for h in held]), np.concatenate([h[f][1] for h in held])), bins)
        for f in range(len(features))
    ]
    width = max([len(cut) + 1 for cut in cuts], default=1)
    strategy = get("featureSubsetStrategy")
    subset = len(features) if strategy == "all" else math.ceil(float(strategy) * len(features))

    if classify:
        if rows.filter(~F.col("y").isin(0.0, 1.0)).take(1):
            raise ValueError("labels of the boosted classifier must be 0 or 1")
        rows = rows.withColumn("y", 2 * F.col("y") - 1)
    trees: list[_Tree] = []
    recent: list[tuple[float, _Tree]] = []
    rng = np.random.default_rng([seed, 1])
    with _Blocks(rows.mapInArrow(_blocks(cuts, weighted), "block binary, rows long")) as blocks:
        for m in range(rounds):
            if len(recent) == REFRESH_ROUNDS:
                blocks.refresh(recent, depth)
                recent = []
            tree = _Tree.empty(depth)
            for level in range(depth):
                run = _histograms(recent, tree, level, depth, rate, [seed, m], m > 0, classify, width)
                if not _grow(tree, level, sum(blocks.over(run)), cuts, subset, rng):
                    break
            _closed(tree)
            trees.append(tree)
            recent.append((1.0 if m == 0 else get("stepSize"), tree))
    return trees, cuts


def _joined(blocks: list[_Block]) -> _Block:
    each = {c: [getattr(b, c) for b in blocks] for c in ("bins", "y", "weight", "n", "margin")}
    return _Block(blocks[0].number, **{c: np.concatenate(parts, axis=-1) for c, parts in each.items()})


class _Blocks:
    """The blocks for the time of the fit. Where all of them hold no more than one may, a job for each level would take
    longer than the pass itself: they are kept here. Others stay in the tasks' memory, or on their disks."""

    def __init__(self, packed: DataFrame):
        rows = packed.rdd.persist(StorageLevel.MEMORY_AND_DISK)
        self.rdd = self.local = None
        if rows.map(lambda row: row[1]).sum() <= BLOCK_ROWS:
            self.local = [_joined([pickle.loads(row[0]) for row in rows.collect()])]
            rows.unpersist()
            return
        tasks = 2 * rows.context.defaultParallelism
        few = rows.coalesce(tasks) if rows.getNumPartitions() > tasks else rows
        self.rdd = few.map(lambda row: pickle.loads(row[0])).persist(StorageLevel.MEMORY_AND_DISK)
        self.rdd.foreachPartition(lambda blocks: None)
        rows.unpersist()

    def over(self, run) -> list[np.ndarray]:
        return list(run(self.local)) if self.rdd is None else self.rdd.mapPartitions(run).collect()

    def refresh(self, recent: list[tuple[float, _Tree]], depth: int) -> None:
        def run(block):
            block.margin = _with_trees(block, recent, depth)
            return block

        if self.rdd is None:
            self.local = [run(block) for block in self.local]
            return
        old, self.rdd = self.rdd, self.rdd.map(run).persist(StorageLevel.MEMORY_AND_DISK)
        self.rdd.foreachPartition(lambda blocks: None)
        old.unpersist()

    def __enter__(self) -> _Blocks:
        return self

    def __exit__(self, *problem) -> None:
        if self.rdd is not None:
            self.rdd.unpersist()


# --- as models of MLlib ---


def _java_node(jvm, gateway, tree: _Tree, cuts: list[np.ndarray], i: int = 1):
    stats = gateway.new_array(jvm.double, 3)
    for k in range(3):
        stats[k] = float(tree.stats[i][k + 1])
    calculator = jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator(stats, int(tree.stats[i][0]))
    value, impurity = float(tree.value[i]), _impurity(tree.stats[i])
    if not tree.split[i]:
        return jvm.org.apache.spark.ml.tree.LeafNode(value, impurity, calculator)
    f = int(tree.feature[i])
    split = jvm.org.apache.spark.ml.tree.ContinuousSplit(f, float(cuts[f][tree.border[i]]))
    left, right = (_java_node(jvm, gateway, tree, cuts, 2 * i + side) for side in (0, 1))
    return jvm.org.apache.spark.ml.tree.InternalNode(value, impurity, float(tree.gain[i]), left, right, split, calculator)


def _model(spark, estimator, trees: list[_Tree], cuts: list[np.ndarray], features: int, classify: bool):
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    ml = jvm.org.apache.spark.ml
    regressors = gateway.new_array(ml.regression.DecisionTreeRegressionModel, len(trees))
    factors = gateway.new_array(jvm.double, len(trees))
    for m, tree in enumerate(trees):
        regressors[m] = ml.regression.DecisionTreeRegressionModel(f"dtr_{estimator.uid}_{m}", _java_node(jvm, gateway, tree, cuts), features)
        factors[m] = 1.0 if m == 0 else float(estimator.getOrDefault("stepSize"))
    if classify:
        model = GBTClassificationModel(ml.classification.GBTClassificationModel(estimator.uid, regressors, factors, features, 2))
    else:
        model = GBTRegressionModel(ml.regression.GBTRegressionModel(estimator.uid, regressors, factors, features))
    model._resetUid(estimator.uid)
    return estimator._copyValues(model)


def fit_boosted(train: DataFrame, features: list[str], estimator: GBTClassifier | GBTRegressor):
    """The model that ``estimator`` describes, fitted on ``train``, whose ``features`` are columns of numbers."""
    classify = isinstance(estimator, GBTClassifier)
    trees, cuts = _fit(train, features, estimator, classify)
    return _model(train.sparkSession, estimator, trees, cuts, len(features), classify)
