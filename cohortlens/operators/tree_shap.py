"""Path-dependent Shapley values of tree ensembles.

For one leaf with value v, let o_j be 1 if the row meets all of feature j's conditions on the path
and z_j the share of training weight that does. Features outside a coalition follow the training
shares, so the leaf contributes to feature j

    v * (o_j - z_j) * integral over t in [0, 1] of prod_{i != j} (t * o_i + (1 - t) * z_i)

because the Shapley weight of a coalition of size s among m features is the integral of
t^s * (1 - t)^(m - 1 - s). The integrand is a polynomial of degree m - 1, so Gauss-Legendre
quadrature with ceil(m / 2) nodes gives it without error.

A tree is walked once for a batch of rows (``tree_values``): going down, the products at the quadrature
nodes are extended by one factor per edge; coming up, the leaves' products are summed, and each edge adds to
its feature what all leaves below it contribute. A row matters only through the sides it took on the path,
so products are kept per combination of sides, and rows look them up, while there are fewer of these than
rows; below that they are kept per row. ``contributions`` is the formula itself, leaf by leaf.
"""

from __future__ import annotations

import pickle
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.ml import Model
from pyspark.ml.classification import DecisionTreeClassificationModel, GBTClassificationModel, RandomForestClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import materialize, shared_dir
from .meeting import meet

TREE_MODELS = (GBTClassificationModel, RandomForestClassificationModel, DecisionTreeClassificationModel)

# Rows times leaves handled in one numpy step; keeps a step's arrays within a few tens of MB.
CELLS = 200_000
# Rows that go down a tree together: enough to share products, few enough for a step's arrays to stay in a core's cache.
TREE_ROWS = 16384


# Leaves whose paths test the same number m of distinct features: values (leaves,), then features,
# low, high and share (leaves, m). A condition is low < x <= high. Plain arrays, so that executors
# need nothing but numpy to read them.
LeafGroup = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]

# Left and right child (-1 at a leaf), feature, threshold and value of each node; the root comes first.
Walkable = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]

# The same, and the share of its parent's cover that each node has.
SharedTree = tuple[Walkable, np.ndarray]

# The functions below travel to executors by value; the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def node_table(spark: SparkSession, model: Model) -> DataFrame:
    """The ensemble's nodes (tree, id, left, right, feature, threshold, cover, value).

    Read from the saved form of the model. Cover is the weighted number of training rows. A forest's
    leaf value is its positive class share over the number of trees, a boosted tree's its prediction
    times the tree's weight, doubled because Spark's margin is half the log-odds.
    """
    path = shared_dir(spark)
    model.write().overwrite().save(path)
    stored = spark.read.parquet(f"{path}/data")
    if isinstance(model, DecisionTreeClassificationModel):
        nodes = stored.select(F.lit(0).alias("tree"), "*")
    else:
        nodes = stored.select(F.col("treeID").alias("tree"), "nodeData.*")
    stats = F.col("impurityStats")
    if isinstance(model, GBTClassificationModel):
        weights = F.array(*[F.lit(float(w)) for w in model.treeWeights])
        cover, value = stats[0], F.lit(2.0) * F.col("prediction") * weights[F.col("tree")]
    else:
        trees = 1 if isinstance(model, DecisionTreeClassificationModel) else model.getNumTrees
        cover = stats[0] + stats[1]
        value = stats[1] / cover / F.lit(float(trees))
    return nodes.select(
        "tree",
        "id",
        F.col("leftChild").alias("left"),
        F.col("rightChild").alias("right"),
        F.col("split.featureIndex").alias("feature"),
        F.get("split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold"),
        cover.alias("cover"),
        value.alias("value"),
    )


def packed_trees(nodes: DataFrame) -> DataFrame:
    """(part, packed, base) for each tree: its nodes as arrays, and its expected output. Each task packs single trees."""

    def pack(nodes: pd.DataFrame) -> pd.DataFrame:
        tree = shared_tree(nodes)
        return pd.DataFrame([{"part": nodes["tree"].iloc[0], "packed": pickle.dumps(tree), "base": base_value(tree)}])

    return nodes.groupBy("tree").applyInPandas(pack, "part long, packed binary, base double")


def shared_tree(nodes: pd.DataFrame) -> SharedTree:
    """A tree's nodes by position, and the share of its parent's cover that each has."""
    nodes = nodes.sort_values("id")
    tree = walkable(nodes)
    cover, share = nodes["cover"].to_numpy(float), np.ones(len(nodes))
    for child in tree[:2]:
        inner = np.flatnonzero(child >= 0)
        share[child[inner]] = cover[child[inner]] / cover[inner]
    return tree, share


def base_value(packed: SharedTree) -> float:
    """The tree's expected output: leaf values weighted by the training share reaching them."""
    (left, right, _, _, value), share = packed
    total, going = 0.0, [(0, 1.0)]
    while going:
        node, reaching = going.pop()
        if left[node] < 0:
            total += reaching * value[node]
        else:
            going += [(child, reaching * share[child]) for child in (left[node], right[node])]
    return float(total)


def ensemble_values(trees: list[SharedTree], x: np.ndarray) -> np.ndarray:
    """Shapley values (rows, features) of the rows ``x``, those of all trees added up."""
    phi = np.zeros(x.shape[::-1])
    for at in range(0, len(x), TREE_ROWS):
        columns = np.ascontiguousarray(x[at : at + TREE_ROWS].T)
        for tree in trees:
            tree_values(tree, columns, phi[:, at : at + TREE_ROWS])
    return phi.T


def tree_values(packed: SharedTree, columns: np.ndarray, phi: np.ndarray) -> None:
    """Adds one tree's Shapley values of the rows in ``columns`` (features, rows) to ``phi`` (features, rows).

    ``products`` has a line for each state, and ``at`` the state of each row; without ``at`` every row is a
    state. ``path`` has for each feature tested above: whether rows meet its conditions, its share, the weights of
    the products in its contribution if they are met, and the levels and sides of its tests.
    """
    (left, right, feature, threshold, value), share = packed
    if left[0] < 0 or not columns.size:
        return
    rows = columns.shape[1]
    points, weights = np.polynomial.legendre.leggauss((_most_features(left, right, feature) + 1) // 2)
    t, weights = (points + 1) / 2, weights / 2
    rest = 1 - t
    unmet = -weights / rest  # (0 - z) / ((1 - t) * z), whatever z is

    def visit(node, products, at, path, depth):
        j = feature[node]
        low = columns[j] <= threshold[node]
        states, before = len(products), path.get(j)
        by_state = at is not None and 2 * states <= rows
        if at is not None and not by_state:  # from here on every row is a state
            products, at = products[at], None
        below, was_met = None, None
        if by_state:
            below = at * 2
            below += low
        if before:
            met_rows, z_before, gain_before, turns = before
            was_met = _met_states(turns, depth) if by_state else met_rows
        summed, table, added = None, None, None
        for child, side in ((left[node], 1), (right[node], 0)):
            taken = low if side else ~low
            z = share[child] * (z_before if before else 1.0)
            met, not_met = t + rest * z, rest * z
            gain = weights * (1 - z) / met
            factors = np.array([not_met, met])
            if before:  # the factor of the edge above is replaced
                factors = np.array([np.full_like(factors, share[child]), factors / (t + rest * z_before)])
            if by_state:  # state 2 * s + 1 is that of rows of state s that go left
                factors = factors if side else factors[..., ::-1, :]
                next_products = (products[:, None, :] * (factors[was_met.view(np.int8)] if before else factors)).reshape(2 * states, -1)
            else:
                chosen = factors[was_met.view(np.int8), taken.view(np.int8)] if before else factors.take(taken.view(np.int8), 0)
                next_products = products * chosen
            if left[child] < 0:
                next_products *= value[child]
                on = np.tile([not side, bool(side)], states) if by_state else taken
                above = before and (was_met.repeat(2) if by_state else was_met, gain_before)
                here = _edge(next_products, on, gain, unmet, above)
                table = next_products if table is None else table + next_products
                added = here if added is None else added + here
                continue
            on_rows = taken & met_rows if before else taken
            turned = (*(turns if before else ()), (depth, side))
            found = visit(child, next_products, below, path | {j: (on_rows, z, gain, turned)}, depth + 1)
            phi[j] += _edge(found, on_rows, gain, unmet, before and (met_rows, gain_before))
            summed = found if summed is None else summed.__iadd__(found)
        if table is not None:
            phi[j] += added.take(below) if by_state else added
            table = table.take(below, 0) if by_state else table
            summed = table if summed is None else summed.__iadd__(table)
        return summed

    visit(0, np.ones((1, len(t))), np.zeros(rows, np.intp), {}, 0)


def _met_states(turns, depth: int) -> np.ndarray:
    """Which states of ``depth`` sides, the first one being the highest bit, took all of ``turns`` (level, side)."""
    state = np.arange(1 << depth)
    return np.logical_and.reduce([state >> (depth - 1 - level) & 1 == side for level, side in turns])


def _edge(sums, on, gain, unmet, before):
    """What the leaves below an edge, whose products are ``sums``, contribute to its feature, by state or by row. An
    edge above that tests the same feature (``before``: met, weights) counts them too, which is taken back."""
    if not before:
        return _mixed(sums, on, gain, unmet)
    was_on, was_gain = before
    return (_mixed(sums, on, gain, unmet) - sums @ was_gain) * was_on


def _mixed(sums, on, gain, unmet):
    met, not_met = np.array([gain - unmet, unmet]) @ sums.T
    met *= on
    met += not_met
    return met


def _most_features(left, right, feature) -> int:
    """The most distinct features that a path tests."""
    most, going = 0, [(0, frozenset())]
    while going:
        node, seen = going.pop()
        if left[node] < 0:
            most = max(most, len(seen))
        else:
            seen = seen | {feature[node]}
            going += [(left[node], seen), (right[node], seen)]
    return most


def contributions(groups: list[LeafGroup], x: np.ndarray) -> np.ndarray:
    """Shapley values (rows, features) of the rows ``x``.

    A leaf's contributions depend on a row only through which of its m features meet their
    conditions. Where there are more rows than the 2^m patterns, they are computed per pattern and
    looked up per row, else per row.
    """
    rows, width = x.shape
    columns = np.ascontiguousarray(x.T)
    phi = np.zeros((width, rows))
    for group in groups:
        m = group[1].shape[1]
        by_pattern = m < 31 and 1 << m < rows
        step = max(1, CELLS // max(1, rows))
        for at in range(0, len(group[0]) if m else 0, step):
            value, features, low, high, share = (a[at : at + step] for a in group)
            met = [
                (columns[features[:, j]] > low[:, j, None]) & (columns[features[:, j]] <= high[:, j, None])
                for j in range(m)
            ]
            if by_pattern:
                patterns = np.arange(1 << m)
                terms = _terms([((patterns >> j) & 1)[None, :] for j in range(m)], value, share)
                seen = sum(met[j].astype(np.int64) << j for j in range(m))
                for leaf in range(len(value)):
                    for j in range(m):
                        phi[features[leaf, j]] += terms[j][leaf].take(seen[leaf])
            else:
                terms = _terms(met, value, share)
                for j in range(m):
                    one_hot = np.zeros((width, len(value)))
                    one_hot[features[:, j], np.arange(len(value))] = 1.0
                    phi += one_hot @ terms[j]
    return phi.T


def _terms(met: list[np.ndarray], value: np.ndarray, share: np.ndarray) -> list[np.ndarray]:
    """Contribution of each leaf (axis 0) to its j-th feature, for the states along axis 1.

    The product over the other features is the whole product over j's own factor, which is
    t + (1 - t) * z for a met condition and (1 - t) * z for an unmet one; in the second case the
    quotient (0 - z) / ((1 - t) * z) is -1 / (1 - t) for every feature.
    """
    m = share.shape[1]
    nodes, weights = np.polynomial.legendre.leggauss((m + 1) // 2)
    unmet, gained = 0.0, [0.0] * m
    for t, w in zip((nodes + 1) / 2, weights / 2):
        product = (w * value)[:, None]
        for j in range(m):
            product = product * ((1 - t) * share[:, j, None] + t * met[j])
        unmet = unmet - product / (1 - t)
        for j in range(m):
            slope = (1 - share[:, j]) / (t + (1 - t) * share[:, j]) + 1 / (1 - t)
            gained[j] = gained[j] + product * slope[:, None]
    return [unmet + met[j] * gained[j] for j in range(m)]


def tree_contributions(
    df: DataFrame, model: Model | DataFrame, keep: list[str], features: str = "features"
) -> tuple[DataFrame, float]:
    """(``keep`` columns, x, phi) per row, and the base value.

    Values explain the positive class: log-odds for boosting, probability for a forest. Instead of a
    model its ``node_table`` may be given, or one of the same columns. Trees are packed where their nodes
    are, and rows meet them by key (``meeting.meet``): no tree passes through the driver.
    """
    packed = materialize(packed_trees(_nodes(df, model)))
    base = packed.agg(F.coalesce(F.sum("base"), F.lit(0.0))).first()[0]
    rows = df.select(*keep, vector_to_array(features).alias("x"))
    values = lambda trees, x, _: ensemble_values(trees, x)
    return meet(rows, packed, lambda trees: [pickle.loads(t) for t in trees], values, "phi", lines=TREE_ROWS), base


def tree_scores(df: DataFrame, model: Model | DataFrame, keep: list[str], features: str = "features") -> DataFrame:
    """(``keep`` columns, total): the sum of the values of the leaves that a row reaches, one in each tree.

    For a forest that is the positive class' probability, for boosting its log-odds.
    """

    def pack(tree: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([{"part": tree["tree"].iloc[0], "packed": pickle.dumps(walkable(tree))}])

    def total(trees: list[Walkable], x: np.ndarray, _) -> np.ndarray:
        return sum((reached(tree, x) for tree in trees), np.zeros(len(x)))[:, None]

    packed = _nodes(df, model).groupBy("tree").applyInPandas(pack, "part long, packed binary")
    rows = df.select(*keep, vector_to_array(features).alias("x"))
    met = meet(rows, packed, lambda trees: [pickle.loads(t) for t in trees], total, "totals")
    return met.select(*keep, F.col("totals")[0].alias("total"))


def _nodes(df: DataFrame, model: Model | DataFrame) -> DataFrame:
    return model if isinstance(model, DataFrame) else node_table(df.sparkSession, model)


def walkable(tree: pd.DataFrame) -> Walkable:
    """A tree's nodes by position instead of by name."""
    tree = tree.sort_values("id")
    place = {i: k for k, i in enumerate(tree["id"])} | {-1: -1}
    left, right = (tree[c].map(place).to_numpy(int) for c in ("left", "right"))
    return left, right, tree["feature"].to_numpy(int), tree["threshold"].fillna(0.0).to_numpy(float), tree["value"].to_numpy(float)


def reached(tree: Walkable, x: np.ndarray) -> np.ndarray:
    """The value of the leaf that each row reaches; all rows go down one level at a time."""
    left, right, feature, threshold, value = tree
    node, going = np.zeros(len(x), int), np.arange(len(x))
    while len(going := going[left[node[going]] >= 0]):
        at = node[going]
        node[going] = np.where(x[going, feature[at]] <= threshold[at], left[at], right[at])
    return value[node]
