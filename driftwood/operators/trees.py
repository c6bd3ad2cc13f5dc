"""Exact Shapley values of tree models, from their node tables.

A tree is a table of nodes (tree, node, feature, threshold, left, right, value, cover): rows with feature <= threshold go
left, others (NaN too) right; ``cover`` is the training weight of a node. The value of a set of known features is the tree's
expectation when unknown features follow the covers. A leaf's share of it is a product over the distinct features
of its path - 1 or 0 for a known feature inside or outside the leaf's interval, the ratio of covers for an unknown one - so its
Shapley values need only the subsets of those features: they are enumerated, at most ``MOST_FEATURES`` features a path.

The model is small by nature (its nodes are counted before they are collected) and goes to the tasks; rows are scored where they
are, in Arrow batches, without a shuffle. Base plus contributions equals the model's prediction.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations
from math import factorial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package

MOST_FEATURES, MOST_NODES = 10, 1_000_000
NODE_COLUMNS = ["tree", "node", "feature", "threshold", "left", "right", "value", "cover"]


def forest_nodes(model) -> DataFrame:
    """Node table of a fitted MLlib tree ensemble for regression, values weighted so that the trees add up to the prediction."""
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    weights = list(model.treeWeights)
    total = 1.0 if type(model).__name__.startswith("GBT") else float(sum(weights))
    rows = []
    for t, (tree, w) in enumerate(zip(model.trees, weights)):
        stack, n = [(tree._call_java("rootNode"), 0)], 1
        while stack:
            node, at = stack.pop()
            inner = node.getClass().getSimpleName() == "InternalNode"
            cover = float(node.impurityStats().count())
            if inner:
                split = node.split()
                rows.append((t, at, int(split.featureIndex()), float(split.threshold()), n, n + 1, None, cover))
                stack += [(node.leftChild(), n), (node.rightChild(), n + 1)]
                n += 2
            else:
                rows.append((t, at, None, None, None, None, float(node.prediction()) * w / total, cover))
    return spark.createDataFrame(rows, "tree int, node int, feature int, threshold double, left int, right int, value double, cover double")


def fit_fixed_tree(df: DataFrame, splits: Sequence[tuple[str, float]], features: Sequence[str], target: str, tree: int = 0) -> DataFrame:
    """Node table of a complete tree that asks one (feature, threshold) a level; its leaves hold the target's mean, their covers
    the row counts. One aggregation over the rows, all levels from it; empty leaves have the value 0 and no cover."""
    depth = len(splits)
    leaf = F.lit(0)
    for f, t in splits:
        leaf = leaf * 2 + (F.col(f).cast("double") > F.lit(float(t))).cast("int")
    cells = df.where(F.col(target).isNotNull()).groupBy(leaf.alias("leaf")).agg(F.avg(target).alias("value"), F.count(F.lit(1)).alias("n"))
    held = {r["leaf"]: r for r in cells.where(F.col("leaf").isNotNull()).collect()}  # 2 ** depth rows at most
    cover = {(depth, k): float(held[k]["n"]) if k in held else 0.0 for k in range(1 << depth)}
    for d in range(depth - 1, -1, -1):
        for k in range(1 << d):
            cover[d, k] = cover[d + 1, 2 * k] + cover[d + 1, 2 * k + 1]
    number = lambda d, k: (1 << d) - 1 + k
    rows = [(tree, number(d, k), list(features).index(splits[d][0]), float(splits[d][1]), number(d + 1, 2 * k), number(d + 1, 2 * k + 1), None,
             cover[d, k]) for d in range(depth) for k in range(1 << d)]
    rows += [(tree, number(depth, k), None, None, None, None, float(held[k]["value"]) if k in held else 0.0, cover[depth, k]) for k in range(1 << depth)]
    return df.sparkSession.createDataFrame(rows, "tree int, node int, feature int, threshold double, left int, right int, value double, cover double")


def _leaves(nodes: pd.DataFrame) -> list[tuple[float, list[tuple[int, float, float, float]]]]:
    """(value, [(feature, above, up to, ratio of covers)]) of every leaf of the forest."""
    out = []
    for _, tree in nodes.groupby("tree"):
        held = {int(r.node): r for r in tree.itertuples()}
        stack = [(0, {})]
        while stack:
            at, path = stack.pop()
            r = held[at]
            if pd.isna(r.feature):
                if len(path) > MOST_FEATURES:
                    raise ValueError(f"a path asks {len(path)} features, {MOST_FEATURES} at most are enumerated")
                out.append((float(r.value), [(f, lo, hi, p) for f, (lo, hi, p) in path.items()]))
                continue
            f, t = int(r.feature), float(r.threshold)
            lo, hi, p = path.get(f, (-np.inf, np.inf, 1.0))
            for child, new in ((int(r.left), (lo, min(hi, t))), (int(r.right), (max(lo, t), hi))):
                share = held[child].cover / r.cover if r.cover else 0.0
                stack.append((child, {**path, f: (*new, p * share)}))
    return out


def contributions(x: np.ndarray, leaves) -> tuple[float, np.ndarray]:
    """Base value and one Shapley value a row and feature."""
    base, phi = 0.0, np.zeros(x.shape)
    for value, path in leaves:
        base += value * float(np.prod([p for *_, p in path]))
        m = len(path)
        # NaN lies above every threshold: it is inside a leaf's interval when that has no upper end
        inside = [np.where(np.isnan(x[:, f]), hi == np.inf, (x[:, f] > lo) & (x[:, f] <= hi)).astype(float) for f, lo, hi, _ in path]
        for j, (f, _, _, p) in enumerate(path):
            others = [k for k in range(m) if k != j]
            for size in range(m):
                weight = factorial(size) * factorial(m - size - 1) / factorial(m) * value
                for known in combinations(others, size):
                    term = np.full(len(x), weight * float(np.prod([path[k][3] for k in others if k not in known])))
                    for k in known:
                        term *= inside[k]
                    phi[:, f] += term * (inside[j] - p)
    return base, phi


def tree_attribution(df: DataFrame, nodes: DataFrame, features: Sequence[str], prefix: str = "attr_", base: str = "attr_base") -> DataFrame:
    """``df`` with the forest's base value and a contribution column a feature (of ``features``, in the order of the model's indices).
    A row that lacks a feature (NULL) is treated as NaN."""
    spark, features = df.sparkSession, list(features)
    if nodes.limit(MOST_NODES + 1).count() > MOST_NODES:
        raise ValueError(f"more than {MOST_NODES} nodes")
    ship_package(spark)
    held = spark.sparkContext.broadcast(_leaves(nodes.select(*NODE_COLUMNS).toPandas()))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            x = np.column_stack([pd.to_numeric(pdf[f]).to_numpy(float, na_value=np.nan) for f in features])
            b, phi = contributions(x, held.value)
            yield pdf.assign(**{base: b, **{f"{prefix}{f}": phi[:, i] for i, f in enumerate(features)}})

    new = [(base, "double"), *[(f"{prefix}{f}", "double") for f in features]]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema] + [f"`{n}` {t}" for n, t in new])
    return df.mapInPandas(run, schema)
