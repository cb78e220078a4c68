"""Per-row contributions of the features to a score, and what is reported from them.

A contribution list is an ``array<double>`` column aligned with the feature names, so
reasons and importances are per-row array expressions and one partial aggregate; rows
are never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, functions as F

from riskloom.functions import sqltext
from riskloom.session import scratch_path, stored

REASON_TYPE = "array<struct<feature:string,impact:double,direction:string>>"


def feature_means(df: DataFrame, vector: str = "features") -> list[float]:
    """Background of a linear explanation: the mean of every vector slot."""
    return [float(v) for v in df.select(Summarizer.mean(F.col(vector)).alias("m")).first()["m"]]


def linear_contributions(
    df: DataFrame,
    values: Column,
    coefficients: Sequence[float],
    background: Sequence[float],
    out: str = "contributions",
) -> DataFrame:
    """``coefficient * (value - background mean)`` per feature, in log-odds.

    ``values`` is the array of feature values.
    """
    weights = F.expr(f"array({sqltext.values(float(c) for c in coefficients)})")
    centre = F.expr(f"array({sqltext.values(float(b) for b in background)})")
    centred = F.zip_with(values, centre, lambda x, m: x - m)
    return df.withColumn(out, F.zip_with(centred, weights, lambda d, w: d * w))


def long_contributions(
    df: DataFrame, names: Sequence[str], key: str, contributions: str = "contributions"
) -> DataFrame:
    """``(key, idx, feature, contribution)``."""
    labels = F.expr(f"array({sqltext.values(names)})")
    return df.select(key, F.posexplode(contributions).alias("idx", "contribution")).select(
        key, "idx", F.get(labels, F.col("idx")).alias("feature"), "contribution"
    )


def top_reasons(
    names: Sequence[str], contributions: str = "contributions", top_n: int = 3
) -> Column:
    """The ``top_n`` largest contributions by size as an array of reasons.

    Ties go to the earlier feature. A contribution above 0 increased the risk.
    """
    labels = sqltext.values(names)
    ranked = (
        f"slice(array_sort(transform({contributions}, (v, i) -> "
        f"named_struct('rank', -abs(v), 'idx', i, 'v', v))), 1, {int(top_n)})"
    )
    return F.expr(
        f"transform({ranked}, r -> named_struct('feature', get(array({labels}), r.idx), "
        "'impact', abs(r.v), 'direction', IF(r.v > 0, 'increased risk', 'decreased risk')))"
    )


def explain_row(
    explained: DataFrame, key: str, value: object, names: Sequence[str], top_n: int = 3
) -> DataFrame:
    """Contributions and reasons of one row, through the same plan as a table."""
    return explained.filter(F.col(key) == value).withColumn("top_reasons", top_reasons(names, top_n=top_n))


def global_importance(
    explained: DataFrame, names: Sequence[str], contributions: str = "contributions"
) -> DataFrame:
    """Mean absolute contribution of every feature."""
    labels = F.expr(f"array({sqltext.values(names)})")
    return (
        explained.select(F.posexplode(contributions).alias("idx", "v"))
        .groupBy("idx")
        .agg(F.avg(F.abs("v")).alias("importance"))
        .select(F.get(labels, F.col("idx")).alias("feature"), "importance")
    )


# ---- trees ------------------------------------------------------------------
#
# A fitted tree model is saved, and its node table is turned on the executors into two tables:
# one row per tree with its nodes as arrays, for exact contributions, and one row per leaf and
# feature with the change of the expected score along the leaf's path, for the relational form.

TREE_TYPE = (
    "tree int, feature array<int>, threshold array<double>, categories array<array<double>>, "
    "left array<int>, right array<int>, share array<double>, value array<double>"
)
STEP_TYPE = "tree int, leaf int, feature int, contribution double"
LONGEST_TABLE_BITS = 12


@dataclass(frozen=True)
class Tree:
    """Nodes of one tree as arrays; number 0 is the root, a leaf has no left child (-1).

    A node's test sends a row left when its feature is at most ``threshold``, or among
    ``categories`` where there are some. ``share`` is its part of the cover of its parent, and
    ``value`` what a row that ends there adds to the score.
    """

    feature: np.ndarray
    threshold: np.ndarray
    categories: tuple[np.ndarray | None, ...]
    left: np.ndarray
    right: np.ndarray
    share: np.ndarray
    value: np.ndarray

    def expected(self) -> np.ndarray:
        """Expected value at every node: its leaves' values by cover."""
        out = self.value.copy()
        for k in range(len(out) - 1, -1, -1):  # children come after their parent
            if self.left[k] >= 0:
                out[k] = sum(self.share[c] * out[c] for c in (self.left[k], self.right[k]))
        return out


@dataclass(frozen=True)
class Forest:
    """Trees whose leaf values add up to the score; ``base`` is the expected score."""

    trees: tuple[Tree, ...]
    base: float


def saved_nodes(df: DataFrame, model) -> DataFrame:
    """Node table of a fitted tree model, read from its saved form: a row per node."""
    path = scratch_path(df.sparkSession, "forest")
    model.write().overwrite().save(path)
    return df.sparkSession.read.parquet(f"{path}/data").select("treeID", "nodeData.*")


def _packing(model) -> tuple[bool, list[float]]:
    """Whether leaf values are predictions, and the factor of every tree's values.

    Contributions of a forest add up to its probability, those of a boosted model to its
    log-odds (twice MLlib's margin).
    """
    boosted = "GBT" in type(model).__name__
    weights = [float(w) for w in model.treeWeights]
    scale = 2.0 if boosted else 1.0 / sum(weights)
    return boosted, [w * scale for w in weights]


def _packed(nodes: pd.DataFrame, boosted: bool, weight: float) -> Tree:
    """Arrays of one tree; nodes are numbered in the order of their saved ids, root first."""
    nodes = nodes.sort_values("id")
    number = {int(i): k for k, i in enumerate(nodes["id"])}
    stats = nodes["impurityStats"].tolist()
    cover = [float(s[0]) if boosted else float(sum(s)) for s in stats]
    answer = nodes["prediction"] if boosted else [s[1] / max(sum(s), 1e-300) for s in stats]
    left = np.array([number[c] if c >= 0 else -1 for c in nodes["leftChild"]])
    right = np.array([number[c] if c >= 0 else -1 for c in nodes["rightChild"]])
    share = np.ones(len(nodes))
    for k in np.flatnonzero(left >= 0):
        for child in (left[k], right[k]):
            share[child] = cover[child] / cover[k]
    splits = nodes["split"].tolist()
    cuts = [np.array(s["leftCategoriesOrThreshold"], float) for s in splits]
    numeric = [s["numCategories"] < 0 for s in splits]
    return Tree(
        np.array([s["featureIndex"] for s in splits]),
        np.array([c[0] if n and len(c) else np.nan for c, n in zip(cuts, numeric)]),
        tuple(None if n else c for c, n in zip(cuts, numeric)),
        left, right, share, np.array(answer, float) * weight,
    )


def forest_table(df: DataFrame, model) -> DataFrame:
    """One row per tree with its nodes as arrays, packed on the executors."""
    boosted, weights = _packing(model)

    def pack(nodes: pd.DataFrame) -> pd.DataFrame:
        number = int(nodes["treeID"].iloc[0])
        t = _packed(nodes, boosted, weights[number])
        categories = [[] if c is None else c.tolist() for c in t.categories]
        return pd.DataFrame(
            {
                "tree": [number], "feature": [t.feature], "threshold": [t.threshold], "categories": [categories],
                "left": [t.left], "right": [t.right], "share": [t.share], "value": [t.value],
            }
        )

    # A group is one tree, whose size its depth bounds.
    return saved_nodes(df, model).groupBy("treeID").applyInPandas(pack, TREE_TYPE)


def read_forest(df: DataFrame, model) -> Forest:
    """The packed trees, as numbers in arrays; their size is the model's, whatever the data."""
    rows = sorted(forest_table(df, model).collect(), key=lambda r: r["tree"])
    trees = tuple(
        Tree(
            np.array(r["feature"]), np.array(r["threshold"], float),
            tuple(np.array(c, float) if c else None for c in r["categories"]),
            np.array(r["left"]), np.array(r["right"]), np.array(r["share"]), np.array(r["value"]),
        )
        for r in rows
    )
    return Forest(trees, sum(float(t.expected()[0]) for t in trees))


def path_weights(shares: np.ndarray, taken: np.ndarray) -> np.ndarray:
    """Shapley weight of every feature of a path, for patterns ``taken`` of shape ``(d, p)``.

    The leaf's game pays, over the path's features, 1 or 0 for a known one (its tests hold or
    not) and its cover share for an unknown one. Weighted by set sizes, the sum over the sets
    of the other features is the integral over t in (0, 1) of the product of their
    ``share * (1 - t) + taken * t``: a polynomial, which Gauss points integrate exactly. The
    product of all is extended once and unwound for each feature, so a path costs its length
    squared and no set is enumerated.
    """
    d = len(shares)
    points, weights = np.polynomial.legendre.leggauss((d + 1) // 2)
    t, weights = (points + 1) / 2, weights / 2
    factors = shares[:, None, None] * (1 - t)[:, None] + taken[:, None, :] * t[:, None]
    others = np.ones_like(factors)
    for k in range(1, d):  # products of the factors ahead, then of those behind
        others[k] = others[k - 1] * factors[k - 1]
    behind = np.ones_like(factors[0])
    for k in range(d - 1, -1, -1):
        others[k] *= behind
        behind = behind * factors[k]
    return (taken - shares[:, None]) * np.einsum("k,dkp->dp", weights, others)


def _explain_tree(x: np.ndarray, tree: Tree, phi: np.ndarray) -> None:
    """Add a tree's contributions to ``phi`` ``(features, rows)``.

    A walk carries, per row, one bit for each feature on the path: whether all its tests hold.
    Rows with the same bits at a leaf share its values.
    """
    rows = np.arange(len(x))
    stack = [(0, (), (), np.zeros(len(x), np.int64))]
    while stack:
        node, features, shares, bits = stack.pop()
        if tree.left[node] < 0:
            if features:
                _add_leaf(tree.value[node], features, np.array(shares), bits, phi)
            continue
        feature, categories = int(tree.feature[node]), tree.categories[node]
        column = x[rows, feature]
        goes_left = column <= tree.threshold[node] if categories is None else np.isin(column, categories)
        for child, holds in ((tree.left[node], goes_left), (tree.right[node], ~goes_left)):
            share = float(tree.share[child])
            if feature in features:
                at = features.index(feature)
                own = bits & ~(np.where(holds, 0, 1 << at))
                stack.append((child, features, (*shares[:at], shares[at] * share, *shares[at + 1 :]), own))
            else:
                own = bits | (holds.astype(np.int64) << len(features))
                stack.append((child, (*features, feature), (*shares, share), own))


def _add_leaf(value: float, features: tuple[int, ...], shares: np.ndarray, bits: np.ndarray, phi: np.ndarray) -> None:
    if len(features) <= LONGEST_TABLE_BITS:
        seen = np.flatnonzero(np.bincount(bits, minlength=1 << len(features)))
        place = np.zeros(1 << len(features), np.int64)
        place[seen] = np.arange(len(seen))
        at = place[bits]
    else:
        seen, at = np.unique(bits, return_inverse=True)
    taken = (seen[None, :] >> np.arange(len(features))[:, None] & 1).astype(float)
    weights = value * path_weights(shares, taken)
    for feature, own in zip(features, weights):
        phi[feature] += own[at]


def tree_contributions(
    df: DataFrame, forest: Forest, vector: str = "features", out: str = "contributions", rows: int = 4096
) -> DataFrame:
    """Exact path-dependent Shapley values, computed ``rows`` at a time inside the tasks.

    Memory is bounded by the rows times the depth and number of features.
    """
    shared = df.sparkSession.sparkContext.broadcast(forest)

    @F.pandas_udf("array<double>")
    def explain(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        trees = shared.value.trees
        for batch in batches:
            found = []
            for at in range(0, len(batch), rows):
                x = np.stack(batch.iloc[at : at + rows].to_numpy()).astype(float)
                phi = np.zeros((x.shape[1], len(x)))
                for tree in trees:
                    _explain_tree(x, tree, phi)
                found += list(phi.T)
            yield pd.Series(found, dtype=object)

    return df.withColumn(out, explain(vector_to_array(vector)))


def path_table(df: DataFrame, model) -> DataFrame:
    """``(tree, leaf, feature, contribution)``: what a leaf's path adds for every feature on it.

    Each step from a node to its child changes the expected score, and that change belongs to
    the feature tested at the node. Leaves are numbered as MLlib numbers them, in the order of
    their ids. The table is made on the executors, tree by tree, and never leaves them.
    """
    boosted, weights = _packing(model)

    def walk(nodes: pd.DataFrame) -> pd.DataFrame:
        number = int(nodes["treeID"].iloc[0])
        t = _packed(nodes, boosted, weights[number])
        expected, leaves = t.expected(), np.cumsum(t.left < 0) - 1
        out, stack = [], [(0, {})]
        while stack:
            node, changes = stack.pop()
            if t.left[node] < 0:
                out += [(number, int(leaves[node]), f, c) for f, c in changes.items()]
                continue
            feature = int(t.feature[node])
            for child in (t.left[node], t.right[node]):
                change = changes.get(feature, 0.0) + expected[child] - expected[node]
                stack.append((child, {**changes, feature: change}))
        return pd.DataFrame(out, columns=["tree", "leaf", "feature", "contribution"])

    return stored(saved_nodes(df, model).groupBy("treeID").applyInPandas(walk, STEP_TYPE), "paths")


def path_contributions(scored: DataFrame, paths: DataFrame, key: str, leaves: str = "leaves") -> DataFrame:
    """``(key, feature, contribution)`` by joining every row's leaves with their paths.

    ``leaves`` is the vector of leaf numbers that a model with ``leafCol`` adds. A row's
    contributions and the expected score add up to its score. They equal the exact ones where a
    tree tests one feature per path; elsewhere a path credits an interaction to the later tests.
    Rows are reduced to distinct leaf vectors first, so rows that fall into the same leaves, of
    which there may be many, are joined once.
    """
    held = scored.select(F.col(key).alias("_key"), vector_to_array(leaves).alias("_leaves"))
    kinds = held.groupBy("_leaves").agg(F.count(F.lit(1)).alias("_n")).select(
        "_leaves", F.posexplode("_leaves").alias("tree", "leaf")
    )
    sums = (
        kinds.withColumn("leaf", F.col("leaf").cast("int"))
        .join(paths, ["tree", "leaf"])
        .groupBy("_leaves", "feature")
        .agg(F.sum("contribution").alias("contribution"))
        .groupBy("_leaves")
        .agg(F.collect_list(F.struct("feature", "contribution")).alias("_parts"))  # one per feature at most
    )
    return held.join(sums, "_leaves", "left").select(F.col("_key").alias(key), F.inline_outer("_parts"))


def importance_table(model, names: Iterable[str], df: DataFrame) -> DataFrame:
    """Impurity importances of a fitted tree model by feature name."""
    values = model.featureImportances.toArray().tolist()
    return df.sparkSession.createDataFrame(
        list(zip(names, values)), "feature string, importance double"
    )
