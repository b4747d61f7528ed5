"""Fitted tree ensembles as SQL expressions, so that scoring stays within column expressions
and reaches into arrays of candidates without exploding them."""

from __future__ import annotations

from pyspark.ml.classification import GBTClassificationModel, RandomForestClassificationModel


def _tree(node, names: list[str], leaf) -> str:
    if node.numDescendants() == 0:
        return f"{float(leaf(node))!r}D"
    split = node.split()
    return (f"CASE WHEN {names[split.featureIndex()]} <= {float(split.threshold())!r}D "
            f"THEN {_tree(node.leftChild(), names, leaf)} ELSE {_tree(node.rightChild(), names, leaf)} END")


def _share(node) -> float:
    stats = list(node.impurityStats().stats())
    return stats[1] / sum(stats)


def forest_sql(model: RandomForestClassificationModel, names: list[str]) -> str:
    """Probability of label 1: the mean of the leaves' shares."""
    trees = [_tree(t._call_java("rootNode"), names, _share) for t in model.trees]
    return "(" + " + ".join(trees) + f") / {len(trees)}D"


def boosted_sql(model: GBTClassificationModel, names: list[str]) -> str:
    """Probability of label 1: the logistic function of twice the margin."""
    parts = [f"{float(w)!r}D * ({_tree(t._call_java('rootNode'), names, lambda n: n.prediction())})"
             for t, w in zip(model.trees, model.treeWeights)]
    return "1D / (1D + exp(-2D * (" + " + ".join(parts) + ")))"
