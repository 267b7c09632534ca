"""Regularised second-order boosting of trees, grown level by level from histograms.

A tree is fitted to the gradients and curvatures of the logistic loss. Features are cut into at most ``BINS``
bins once, and rows are packed into blocks that hold them by column. For a level of a tree, every task adds up
gradient and curvature by (node, feature, bin) over its rows, in one pass; these sums are as large as the
tree's level, not as the data, and the driver takes the best split of each node from their total. Of two
children only the one with fewer rows, as a thin sample has it, is added up; the other's sums are its parent's less
those, exactly. The gain of a split is G_l^2 / (H_l + l2) + G_r^2 / (H_r + l2) - G^2 / (H + l2), a leaf's value is
-G / (H + l2), times the step size. Rows are drawn for each tree by a hash of the row, features by a seeded
draw for each tree.

Sums are taken of whole numbers, gradients times a power of two that leaves no room for overflow, nor for
rounding in a block, so a model depends neither on partitions nor on the order of rows. The first pass of a round
moves the margins by the tree of the round before and keeps the blocks, in memory or on local disk; every
``PENDING`` rounds they are checkpointed, and older checkpoints deleted.

Every pass moves all blocks to the tasks, so they are narrow: features of two bins share a byte, whose values are
counted like bins and added up by bit, and a weight that follows from the label is two numbers a block.
"""

import json
import pickle
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel, cloudpickle
from pyspark.ml import Transformer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.session import ensure_checkpoint_dir

# Functions of this module travel to the tasks by value, so executors need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BINS = 64
PENDING = 16
#: Histograms that the driver adds up itself; of more, tasks add up some first.
TO_DRIVER = 64
#: Rows of a block, at most.
BLOCK = 1 << 15
#: Rows of a task, at most; the tasks of a pass are a multiple of the cores, so none of these waits for a last few.
TASK_ROWS = 1 << 22
#: One row in so many is counted to find the smaller child.
THIN = 8
#: Columns of a feature vector that training holds as bins, one byte each.
MOST_FEATURES = 4096


@dataclass
class Tree:
    """Nodes as in a heap: the children of node i are 2i + 1 and 2i + 2. A leaf has feature -1."""

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray

    @staticmethod
    def empty(depth: int) -> "Tree":
        n = 2 ** (depth + 1) - 1
        return Tree(np.full(n, -1), np.zeros(n, np.int64), np.zeros(n))

    def margins(self, columns: np.ndarray, places: "Places | None" = None) -> np.ndarray:
        """The value of the leaf that each row is in, of bins by column."""
        found = np.zeros(columns.shape[1])
        leaves = set(np.flatnonzero(self.feature < 0).tolist())
        for node, rows in self.rows(columns, np.arange(len(found)), leaves, places).items():
            found[rows] = self.value[node]
        return found

    def rows(self, columns: np.ndarray, rows: np.ndarray, wanted: set[int], places: "Places | None" = None) -> dict[int, np.ndarray]:
        """Which of the rows each wanted node holds; without ``places`` every feature has its own column."""
        passed, found, left = set(), {}, [(0, rows)]
        for node in wanted:
            while node not in passed:
                passed.add(node)
                node = (node - 1) // 2 if node else 0
        while left:
            node, own = left.pop()
            if node in wanted:
                found[node] = own
            feature = self.feature[node]
            if feature >= 0 and (2 * node + 1 in passed or 2 * node + 2 in passed):
                column, bit = places[feature] if places else (feature, None)
                bins = columns[column].take(own)
                right = bins > self.cut[node] if bit is None else bins & (1 << bit) != 0
                # Taking by number is several times faster than by a mask.
                left += [(k, own.take(np.flatnonzero(side))) for k, side in ((2 * node + 1, ~right), (2 * node + 2, right)) if k in passed]
        return found


def binned(x: np.ndarray, cuts: list[list[float]]) -> np.ndarray:
    """The bin of every value: the number of cuts below it."""
    return np.stack([np.searchsorted(c, x[:, k], "left") for k, c in enumerate(cuts)], 1).astype(np.uint8)


def find_cuts(matrix: DataFrame, numeric: int, width: int, bins: int = BINS) -> list[list[float]]:
    """Cuts of the first ``numeric`` slots of ``features`` by approximate quantiles; the other slots hold 0 or 1."""
    slots = matrix.select(vector_to_array("features").alias("x")).select(*[F.col("x")[k].alias(f"x{k}") for k in range(numeric)])
    shares = [i / bins for i in range(1, bins)]
    found = slots.approxQuantile(slots.columns, shares, 1 / (4 * bins)) if numeric else []
    return [sorted(set(c)) for c in found] + [[0.5]] * (width - numeric)


#: The stored column of each feature, and its bit in it if it shares the column.
Places = list[tuple[int, int | None]]


def places_of(cuts: list[list[float]]) -> Places:
    """Features of two bins share columns, so many that a column's values are no more than the bins."""
    bits, own, shared, places = (max(map(len, cuts)) + 1).bit_length() - 1, 0, 0, []
    alone = sum(len(c) != 1 for c in cuts)
    for c in cuts:
        if len(c) == 1:
            places.append((alone + shared // bits, shared % bits))
            shared += 1
        else:
            places.append((own, None))
            own += 1
    return places


#: Bins by stored column, label, weight (or that of either label), hash and margin of some rows.
Block = tuple[np.ndarray, np.ndarray, np.ndarray | tuple[float, float], np.ndarray, np.ndarray]


def _blocks(matrix: DataFrame, cuts: list[list[float]]) -> RDD:
    places = places_of(cuts)

    def block(kept: list) -> pa.RecordBatch:
        bins, y, w, u = (np.concatenate(part) for part in zip(*kept))
        columns = np.zeros((1 + max(c for c, _ in places), len(bins)), np.uint8)
        for f, (column, bit) in enumerate(places):
            columns[column] |= bins[:, f] << (bit or 0)
        positive = y > 0
        by_label = tuple(float(w[positive == side].max(initial=0.0)) for side in (False, True))
        weights = by_label if np.array_equal(np.where(positive, by_label[1], by_label[0]), w) else w
        labels = positive if np.array_equal(positive, y) else y
        rows = (columns, labels, weights, u, np.zeros(len(bins)))
        return pa.RecordBatch.from_arrays([pa.array([pickle.dumps(rows, pickle.HIGHEST_PROTOCOL)], pa.binary())], ["block"])

    def packed(batches):
        kept, size = [], 0
        for batch in batches:
            for cut in range(0, batch.num_rows, BLOCK):
                part = batch.slice(cut, BLOCK)
                if size + part.num_rows > BLOCK:
                    yield block(kept)
                    kept, size = [], 0
                x = part.column("x").flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)
                kept.append((binned(x, cuts), *(part.column(c).to_numpy(zero_copy_only=False) for c in ("y", "w", "u"))))
                size += part.num_rows
        if kept:
            yield block(kept)

    weight = F.col("weight") if "weight" in matrix.columns else F.lit(1.0)
    x = vector_to_array("features")
    rows = matrix.select(x.alias("x"), F.col("label").cast("double").alias("y"), weight.cast("double").alias("w"), F.xxhash64(x, "label").alias("u"))
    return rows.mapInArrow(packed, "block binary").rdd.map(lambda r: pickle.loads(r.block))


def _moved(blocks: RDD, tree: Tree, places: Places) -> RDD:
    """The blocks with their margins moved by a tree, kept for several passes."""

    def move(block: Block) -> Block:
        return *block[:4], block[4] + tree.margins(block[0], places)

    return blocks.map(move).persist(StorageLevel.MEMORY_AND_DISK)


def _drop_checkpoint(blocks: RDD) -> None:
    path = blocks.getCheckpointFile()
    if path:
        target = blocks.context._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(blocks.context._jsc.hadoopConfiguration()).delete(target, True)


def _drawn_rows(u: np.ndarray, seed: int, share: float) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = u.view(np.uint64) ^ np.uint64(seed * 0x9E3779B97F4A7C15 % 2**64)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
    h >>= np.uint64(11)
    return h < np.uint64(np.ceil(share * 2**53))


def _histograms(blocks: RDD, tree: Tree, wanted: list[int], drawn: list[int], places: Places, bins: int, scale: float, seed: int, share: float) -> np.ndarray:
    """Scaled gradients and curvatures by wanted node, drawn feature and bin, and thin counts of rows."""
    nodes = len(wanted)
    shape = (3, nodes, len(drawn), bins)
    alone = [(places[f][0], j) for j, f in enumerate(drawn) if places[f][1] is None]
    # The drawn features of each shared column, and which of its values have their bits.
    shared = {}
    for j, f in enumerate(drawn):
        if places[f][1] is not None:
            own, has = shared.setdefault(places[f][0], ([], []))
            own.append(j)
            has.append(np.arange(bins) >> places[f][1] & 1)
    shared = [(at, own, np.array(has, float).T) for at, (own, has) in shared.items()]

    def add(found: np.ndarray, block: Block) -> None:
        columns, y, w, u, m = block
        held = tree.rows(columns, np.flatnonzero(_drawn_rows(u, seed, share)), set(wanted), places)
        rows = np.concatenate([held[n] for n in wanted])
        slot = np.repeat(np.arange(nodes) * bins, [len(held[n]) for n in wanted])
        y, m = y.take(rows), m.take(rows)
        w = np.where(y > 0, w[1], w[0]) if isinstance(w, tuple) else w.take(rows)
        p = 1 / (1 + np.exp(-m))
        # Whole numbers; their sums over a block are exact in doubles too.
        sums = [np.rint(w * (p - y) * scale), np.rint(w * p * (1 - p) * scale)]

        def counts(column: np.ndarray) -> list[np.ndarray]:
            code = slot + column.take(rows)
            each = [*(np.bincount(code, v, nodes * bins) for v in sums), np.bincount(code[::THIN], None, nodes * bins)]
            return [h.reshape(nodes, bins) for h in each]

        for at, j in alone:
            for k, h in enumerate(counts(columns[at])):
                found[k, :, j] += h.astype(np.int64)
        for at, own, has in shared:
            for k, h in enumerate(counts(columns[at])):
                ones = h @ has
                found[k][:, own, 1] += ones.astype(np.int64)
                found[k][:, own, 0] += (h.sum(1, keepdims=True) - ones).astype(np.int64)

    def counted(own: Iterator[Block]) -> Iterator[bytes]:
        found = np.zeros(shape, np.int64)
        for block in own:
            add(found, block)
        yield found.tobytes()

    def added(parts: Iterator[bytes]) -> Iterator[bytes]:
        found = np.zeros(shape, np.int64)
        for h in parts:
            found += np.frombuffer(h, np.int64).reshape(shape)
        yield found.tobytes()

    each = blocks.mapPartitions(counted)
    parts = blocks.getNumPartitions()
    if parts > TO_DRIVER:
        each = each.repartition(int(parts**0.5)).mapPartitions(added)
    return np.frombuffer(next(added(iter(each.collect()))), np.int64).reshape(shape)


def _grow(tree: Tree, level: int, histograms: dict[int, np.ndarray], scale: float, drawn: list[int], l2: float, step: float, least: float) -> dict[int, bool]:
    """Splits the nodes of a level where that gains; children start as leaves. The nodes that were split, each
    with whether its left child has fewer rows."""
    split = {}
    for at, found in sorted(histograms.items()):
        g, h = found[:2] / scale
        total_g, total_h = g[0].sum(), h[0].sum()
        left_g, left_h = np.cumsum(g, 1)[:, :-1], np.cumsum(h, 1)[:, :-1]
        right_g, right_h = total_g - left_g, total_h - left_h
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = left_g**2 / (left_h + l2) + right_g**2 / (right_h + l2) - total_g**2 / (total_h + l2)
        gain = np.where((left_h >= least) & (right_h >= least), gain, -np.inf)
        if level == 0:
            tree.value[0] = -step * total_g / (total_h + l2)
        if not gain.size or not gain.max() > 1e-9:
            continue
        # Ties go to the first feature and then to the lowest cut.
        j, cut = divmod(int(np.argmax(gain)), gain.shape[1])
        tree.feature[at], tree.cut[at] = drawn[j], cut
        tree.value[2 * at + 1] = -step * left_g[j, cut] / (left_h[j, cut] + l2)
        tree.value[2 * at + 2] = -step * right_g[j, cut] / (right_h[j, cut] + l2)
        split[at] = bool(2 * found[2, j, : cut + 1].sum() <= found[2, j].sum())
    return split


def fit_trees(
    matrix: DataFrame,
    cuts: list[list[float]],
    rounds: int,
    depth: int,
    step: float,
    l2: float = 1.0,
    rows_share: float = 1.0,
    features_share: float = 1.0,
    least: float = 1.0,
    seed: int = 42,
) -> list[Tree]:
    """Trees for ``features``, ``label`` (0 or 1) and, if present, ``weight``; ``least`` is the least curvature
    of a child."""
    width = len(cuts)
    if width > MOST_FEATURES:
        raise ValueError(f"{width} features; more than {MOST_FEATURES} need max_categories")
    spark, bins = matrix.sparkSession, max(map(len, cuts)) + 1
    weight = F.max(F.col("weight").cast("double")) if "weight" in matrix.columns else F.lit(1.0)
    seen = matrix.agg(F.count(F.lit(1)).alias("n"), weight.alias("w")).head()
    if not seen.n:
        return []
    heaviest = max(seen.w, 1.0)
    scale = min(2 ** (61 - int(np.ceil(np.log2(seen.n * heaviest + 1)))), 2.0 ** (52 - int(np.ceil(np.log2(BLOCK * heaviest)))))
    places, cores = places_of(cuts), spark.sparkContext.defaultParallelism
    ensure_checkpoint_dir(spark)
    blocks = _blocks(matrix.coalesce(cores * -(-seen.n // (cores * TASK_ROWS))), cuts).persist(StorageLevel.MEMORY_AND_DISK)
    blocks.checkpoint()
    settled = blocks
    rng, trees = np.random.default_rng(seed), []
    for t in range(rounds):
        older, outdated = None, None
        if trees:
            older, blocks = blocks, _moved(blocks, trees[-1], places)
            if t % PENDING == 0:
                blocks.checkpoint()
                outdated, settled = settled, blocks
        drawn = sorted(rng.choice(width, max(1, int(features_share * width)), replace=False).tolist())
        tree, wanted, known = Tree.empty(depth), [0], {}
        for level in range(depth):
            found = _histograms(blocks, tree, wanted, drawn, places, bins, scale, seed + t, rows_share)
            if older is not None:
                older.unpersist()
                older = None
            parents, known = known, {n: found[:, k] for k, n in enumerate(wanted)}
            for n in wanted if level else ():
                # The sibling: odd nodes are left children.
                known[n + 1 if n % 2 else n - 1] = parents[(n - 1) // 2] - known[n]
            split = _grow(tree, level, known, scale, drawn, l2, step, least)
            wanted = [2 * n + 1 if left else 2 * n + 2 for n, left in split.items()]
            if not wanted:
                break
        trees.append(tree)
        if outdated is not None:
            _drop_checkpoint(outdated)
    blocks.unpersist()
    _drop_checkpoint(settled)
    return trees


class BoostedTrees(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Scores ``features`` by trees: ``rawPrediction``, ``probability`` and ``prediction``, as MLlib's models."""

    model = Param(Params._dummy(), "model", "cuts and trees as JSON", TypeConverters.toString)

    @staticmethod
    def of(cuts: list[list[float]], trees: list[Tree]) -> "BoostedTrees":
        nodes = [[t.feature.tolist(), t.cut.tolist(), t.value.tolist()] for t in trees]
        return BoostedTrees()._set(model=json.dumps({"cuts": cuts, "trees": nodes}))

    def parts(self) -> tuple[list[list[float]], list[Tree]]:
        found = json.loads(self.getOrDefault(self.model))
        return found["cuts"], [Tree(np.array(f), np.array(c), np.array(v)) for f, c, v in found["trees"]]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        cuts, trees = self.parts()

        @F.pandas_udf("double")
        def margin(x: pd.Series) -> pd.Series:
            if not len(x):
                return pd.Series([], dtype=float)
            columns = np.ascontiguousarray(binned(np.stack(x.to_numpy()), cuts).T)
            return pd.Series(sum((t.margins(columns) for t in trees), np.zeros(len(x))))

        scored = dataset.withColumn("_margin", margin(vector_to_array("features")))
        m, p = F.col("_margin"), 1 / (1 + F.exp(-F.col("_margin")))
        return scored.withColumns(
            {
                "rawPrediction": array_to_vector(F.array(-m, m)),
                "probability": array_to_vector(F.array(1 - p, p)),
                "prediction": (m > 0).cast("double"),
            }
        ).drop("_margin")
