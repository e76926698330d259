"""Exact contributions of features to a tree model's score (E1 for trees).

The score of a record when only the features of a set S are known is the mean over the training rows that each
tree sends down all branches of the unknown features (path-dependent expectation).  The Shapley values of that game are
exact here: a leaf adds its value times a product over the features on its path, of 1 or 0 for a known feature
(the record passes all its splits or not) and of the share of training rows that pass for an unknown one.  The weighted
sum over all sets of such a product is a polynomial in the number of known features, so no set is listed.

A model is a bounded set of leaves; records are scored in Arrow batches, many at a time per leaf.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskwise.session import ship


@dataclass
class Leaf:
    """A leaf's value, and for every feature on its path the interval that passes and the share of rows that do."""

    value: float
    features: list[int]
    above: list[float]      # the value must be greater
    upto: list[float]       # and not greater than this
    share: list[float]


def _leaves(node, value, path: dict, out: list[Leaf], scale: float) -> None:
    """All leaves below ``node``; ``path`` maps a feature to (above, upto, share)."""
    if node.getClass().getSimpleName() == "LeafNode":
        f = sorted(path)
        out.append(Leaf(scale * value(node), f, *([path[i][k] for i in f] for k in range(3))))
        return
    split, total = node.split(), float(node.impurityStats().count())
    if split.getClass().getSimpleName() != "ContinuousSplit":
        raise ValueError("only splits of continuous features can be explained")
    f, cut = split.featureIndex(), float(split.threshold())
    above, upto, share = path.get(f, (-math.inf, math.inf, 1.0))
    for child, bounds in ((node.leftChild(), (above, min(upto, cut))), (node.rightChild(), (max(above, cut), upto))):
        part = float(child.impurityStats().count()) / total
        _leaves(child, value, path | {f: (*bounds, share * part)}, out, scale)


def tree_leaves(model) -> list[Leaf]:
    """Leaves of a fitted tree, forest or boosted-tree classifier, with values that add up to its score.

    The score is the probability of class 1 for a tree or forest and the margin (half the log-odds) for boosted trees.
    """
    def share_of_one(node) -> float:
        stats = list(node.impurityStats().stats())
        return stats[1] / sum(stats)

    if hasattr(model, "treeWeights") and type(model).__name__ == "GBTClassificationModel":
        trees = [(t, w, lambda n: n.prediction()) for t, w in zip(model.trees, model.treeWeights)]
    elif type(model).__name__ == "RandomForestClassificationModel":
        trees = [(t, 1.0 / len(model.trees), share_of_one) for t in model.trees]
    elif type(model).__name__ == "DecisionTreeClassificationModel":
        trees = [(model, 1.0, share_of_one)]
    else:
        raise ValueError(f"{type(model).__name__} is not a tree classifier")
    out: list[Leaf] = []
    for tree, weight, value in trees:
        _leaves(tree._call_java("rootNode"), value, {}, out, float(weight))
    return out


def shapley(leaves: list[Leaf], x: np.ndarray) -> tuple[float, np.ndarray]:
    """(expected score, contributions per row and feature of ``x``)."""
    base, out = 0.0, np.zeros(x.shape)
    for leaf in leaves:
        k = len(leaf.features)
        base += leaf.value * float(np.prod(leaf.share))
        if not k:
            continue
        cols = x[:, leaf.features]
        passes = ((cols > np.array(leaf.above)) & (cols <= np.array(leaf.upto))).astype(np.float64)
        weight = [math.factorial(s) * math.factorial(k - s - 1) / math.factorial(k) for s in range(k)]
        for i, f in enumerate(leaf.features):
            known = [np.ones(len(x))]                      # coefficient s: sets of s known features among the others
            for j in range(k):
                if j != i:
                    grown = [c * leaf.share[j] for c in known] + [np.zeros(len(x))]
                    for s, c in enumerate(known):
                        grown[s + 1] = grown[s + 1] + c * passes[:, j]
                    known = grown
            out[:, f] += leaf.value * (passes[:, i] - leaf.share[i]) * sum(w * c for w, c in zip(weight, known))
    return base, out


def tree_contributions(model: PipelineModel, records: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """(kept columns, feature, contribution, expected): what every feature adds to a record's score.

    ``records`` are as the pipeline takes them; its last stage is a tree, forest or boosted-tree classifier over ``features``
    in that order.  The contributions of a record add up to its score less ``expected``.
    """
    ship(records.sparkSession)
    leaves, names = tree_leaves(model.stages[-1]), list(features)
    rows = model.transform(records).select(*keep, vector_to_array(F.col(model.stages[-1].getFeaturesCol())).alias("__x"))
    expected, _ = shapley(leaves, np.zeros((1, len(names))))

    def run(batches):
        for batch in batches:
            n = batch.num_rows
            column = batch.column(batch.num_columns - 1)
            x = column.flatten().to_numpy(zero_copy_only=False).reshape(n, len(names))
            _, found = shapley(leaves, x)
            again = pa.array(np.repeat(np.arange(n), len(names)))
            yield pa.RecordBatch.from_arrays(
                [*[c.take(again) for c in batch.columns[:-1]], pa.array(names * n, pa.string()), pa.array(found.ravel()),
                 pa.array(np.full(n * len(names), expected))],
                names=[*batch.schema.names[:-1], "feature", "contribution", "expected"])

    added = [T.StructField("feature", T.StringType()), T.StructField("contribution", T.DoubleType()),
             T.StructField("expected", T.DoubleType())]
    return rows.mapInArrow(run, T.StructType([*rows.schema.fields[:-1], *added]))
