"""Boosted trees as column expressions: trained with Spark ML on a bounded set
of labelled rows, then compiled to nested CASE expressions, so scoring is plain
generated code wherever an expression can go (also inside array functions)."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_IF = re.compile(r"^(\s*)If \(feature (\d+) <= ([-0-9.Ee]+)\)")
_LEAF = re.compile(r"^\s*Predict: ([-0-9.Ee]+)")


def train(rows: DataFrame, features: list[str], label: str, trees: int = 16, depth: int = 3,
          seed: int = 7) -> list[tuple[float, list]]:
    """[(weight, tree)]; a tree is a number or [feature, threshold, low, high]."""
    data = VectorAssembler(inputCols=features, outputCol="vector").transform(rows)
    model = GBTClassifier(featuresCol="vector", labelCol=label, maxIter=trees, maxDepth=depth,
                          stepSize=0.3, seed=seed).fit(data)
    return [(w, _parse(t.toDebugString)) for w, t in zip(model.treeWeights, model.trees)]


def _parse(text: str):
    lines = [x for x in text.splitlines()[1:] if x.strip()]

    def node(i: int):
        if m := _LEAF.match(lines[i]):
            return float(m[1]), i + 1
        m = _IF.match(lines[i])
        low, i = node(i + 1)
        high, i = node(i + 1)  # past the line that says Else
        return [int(m[2]), float(m[3]), low, high], i

    return node(0)[0]


def score(model: list[tuple[float, list]], features: list[Column]) -> Column:
    """The model's probability of label 1 for these feature columns."""

    def value(t) -> Column:
        if not isinstance(t, list):
            return F.lit(t)
        return F.when(features[t[0]] <= t[1], value(t[2])).otherwise(value(t[3]))

    margin = reduce(lambda a, b: a + b, [F.lit(w) * value(t) for w, t in model])
    return F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-2.0) * margin))
