from itertools import combinations
from math import factorial

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from cohortlens.operators import models
from cohortlens.operators.attribution import (
    attribution_long, beeswarm, explain, importance, linear_contributions, sampled_contributions,
)
from cohortlens.operators import meeting
from cohortlens.operators.stats import class_weights, with_weights
from cohortlens.operators.tree_shap import contributions, ensemble_values, node_table, shared_tree, tree_contributions, tree_scores
from cohortlens.operators.walks import array_scorer

WIDTH = 5


@pytest.fixture(scope="module")
def rows(spark):
    """300 rows with five features, labels unbalanced and dependent on interactions."""
    u = [F.pmod(F.xxhash64("id", F.lit(j)), F.lit(1000)) / 1000.0 for j in range(WIDTH + 1)]
    label = ((u[0] > 0.5) & (u[1] > 0.3) | (u[2] * u[3] > 0.7) | (u[5] < 0.05)).cast("int")
    df = spark.range(300).select("id", array_to_vector(F.array(*u[:WIDTH])).alias("features"), label.alias("label"))
    return with_weights(df, "label", class_weights(df, "label"), models.WEIGHT).cache()


def brute_force(nodes, x):
    """Shapley values over all coalitions, unknown features following the training shares."""
    trees = {}
    for n in nodes:
        trees.setdefault(n["tree"], {})[n["id"]] = n

    def expected(tree, n, known):
        if n["left"] < 0:
            return n["value"]
        left, right = tree[n["left"]], tree[n["right"]]
        if n["feature"] in known:
            return expected(tree, left if x[n["feature"]] <= n["threshold"] else right, known)
        return (left["cover"] * expected(tree, left, known) + right["cover"] * expected(tree, right, known)) / n["cover"]

    def value(known):
        return sum(expected(t, t[0], known) for t in trees.values())

    phi = []
    for j in range(len(x)):
        others = [i for i in range(len(x)) if i != j]
        phi.append(sum(
            factorial(s) * factorial(len(x) - s - 1) / factorial(len(x)) * (value({*c, j}) - value(set(c)))
            for s in range(len(x)) for c in combinations(others, s)
        ))
    return value(set()), phi


@pytest.fixture(scope="module")
def tree_models(rows):
    return {
        "forest": models.random_forest(4, 5).fit(rows),
        "boosting": models.gradient_boosting(4).fit(rows),
        "tree": DecisionTreeClassifier(maxDepth=4, weightCol=models.WEIGHT, seed=1).fit(rows),
    }


@pytest.mark.parametrize("kind", ["forest", "boosting", "tree"])
def test_tree_values_equal_brute_force_and_add_up(spark, rows, tree_models, kind):
    model = tree_models[kind]
    explained, base = tree_contributions(models.score(model, rows), model, ["id", "score"])
    nodes = node_table(spark, model).collect()
    got = explained.collect()
    assert len(got) == rows.count()
    for r in got[:12]:
        expected_base, phi = brute_force(nodes, r["x"])
        assert base == pytest.approx(expected_base, abs=1e-12)
        assert r["phi"] == pytest.approx(phi, abs=1e-12)
    p = np.array([r["score"] for r in got])
    target = np.log(p / (1 - p)) if kind == "boosting" else p
    assert [base + sum(r["phi"]) for r in got] == pytest.approx(target, abs=1e-9)


def test_deep_trees_add_up(spark, rows):
    """Paths with all features and many repeated tests per feature."""
    model = models.random_forest(5, 12).setMinInstancesPerNode(1).fit(rows)
    explained, base = tree_contributions(models.score(model, rows), model, ["score"])
    assert all(abs(base + sum(r["phi"]) - r["score"]) < 1e-9 for r in explained.collect())


def test_single_leaf_has_no_attributions(spark, rows):
    model = DecisionTreeClassifier(maxDepth=0).fit(rows)
    explained, base = tree_contributions(rows, model, ["id"])
    assert set(explained.first()["phi"]) == {0.0}
    assert base == pytest.approx(rows.agg(F.avg("label")).first()[0])


def test_linear_values_add_up(spark, rows):
    model = models.logistic_regression(300.0).fit(rows)
    explained, base = linear_contributions(models.score(model, rows), model, ["id", "score"], rows.limit(50))
    for r in explained.collect():
        assert base + sum(r["phi"]) == pytest.approx(np.log(r["score"] / (1 - r["score"])), abs=1e-9)


def test_sampled_values_add_up_and_agree_in_sign_with_linear(spark, rows):
    model = models.logistic_regression(300.0).fit(rows)
    one = rows.orderBy("id").limit(1)
    explained, base = sampled_contributions(models.score(model, rows).drop("prediction", "probability", "rawPrediction", "score"),
                                            model, "id", one, permutations=3)
    explained = explained.collect()
    scores = {r["id"]: r["score"] for r in models.score(model, rows).collect()}
    assert base == pytest.approx(scores[one.first()["id"]], abs=1e-12)
    assert len(explained) == 300
    for r in explained:
        assert sum(r["phi"]) == pytest.approx(scores[r["id"]] - base, abs=1e-9)
    slopes, at = model.coefficients.toArray(), one.first()["features"].toArray()
    for r in explained[:50]:
        assert all(p * s * (x - a) >= -1e-12 for p, s, x, a in zip(r["phi"], slopes, r["x"], at))


def test_copies_and_null_ids_keep_their_own_values(spark, rows):
    model = models.logistic_regression(300.0).fit(rows)
    some = rows.orderBy("id").limit(8)
    twice = some.union(some).union(some.limit(2).withColumn("id", F.lit(None).cast("int")))
    single, base = sampled_contributions(some, model, "id", some)
    double, again = sampled_contributions(twice, model, "id", some)
    phi = {r["id"]: r["phi"] for r in single.collect()}
    got = double.collect()
    assert base == pytest.approx(again) and len(got) == 18
    assert sum(r["id"] is None for r in got) == 2
    assert all(r["phi"] == pytest.approx(phi[r["id"]], abs=1e-12) for r in got if r["id"] is not None)


def test_the_whole_background_is_met(spark):
    from pyspark.ml.linalg import Vectors

    background = spark.createDataFrame([(k, Vectors.dense(float(k), 0.0)) for k in range(600)], ["id", "features"])
    plain = lambda df: df.withColumn("score", vector_to_array("features")[0])
    one = spark.createDataFrame([(1, Vectors.dense(1000.0, 5.0))], ["id", "features"])
    explained, base = sampled_contributions(one, None, "id", background, scorer=plain)
    assert base == pytest.approx(299.5)
    assert explained.first()["phi"] == pytest.approx([700.5, 0.0])


def test_explain_picks_the_method(spark, rows, tree_models):
    lr = models.logistic_regression(300.0).fit(rows)
    for model in (*tree_models.values(), lr):
        explained, base = explain(rows, model, "id")
        assert isinstance(base, float)
        assert explained.columns == ["id", "x", "phi"] and len(explained.first()["phi"]) == WIDTH


def test_explain_compares_with_the_rows_given(spark, rows):
    lr = models.logistic_regression(300.0).fit(rows)
    one = rows.orderBy("id").limit(1)
    margin = models.score(lr, one).first()["rawPrediction"][1]
    explained, base = explain(rows, lr, "id", background=one)
    assert base == pytest.approx(margin)
    assert np.allclose(explained.where(F.col("id") == one.first()["id"]).first()["phi"], 0.0)


def test_summaries(spark):
    df = spark.createDataFrame(
        [(1, [1.0, 2.0, 3.0], [0.5, -4.0, 0.0]), (2, [4.0, 5.0, 6.0], [-1.5, 2.0, 0.0])],
        "id int, x array<double>, phi array<double>",
    )
    ranked = [tuple(r) for r in importance(df, ["a", "b", "c"]).collect()]
    assert ranked == [("b", 3.0), ("a", 1.0), ("c", 0.0)]
    long = {(r["id"], r["feature"]): (r["phi"], r["value"]) for r in attribution_long(df, ["a", "b", "c"], ["id"]).collect()}
    assert len(long) == 6 and long[(1, "b")] == (-4.0, 2.0)
    assert {r["feature"] for r in beeswarm(df, ["a", "b", "c"], "id", 2).collect()} == {"a", "b"}


def test_large_batches_give_the_same_values_as_small_ones():
    """Looking contributions up by pattern equals computing them per row."""
    rng = np.random.default_rng(3)
    groups = []
    for m in (1, 4, 7):
        features = np.stack([rng.permutation(9)[:m] for _ in range(30)])
        low = np.where(rng.random((30, m)) < 0.5, -np.inf, rng.normal(size=(30, m)) - 1)
        high = np.where(rng.random((30, m)) < 0.5, np.inf, low + 2)
        groups.append((rng.normal(size=30), features, low, high, rng.random((30, m))))
    x = rng.normal(size=(1500, 9))
    small = np.vstack([contributions(groups, x[i : i + 100]) for i in range(0, 1500, 100)])
    assert contributions(groups, x) == pytest.approx(small, abs=1e-12)


@pytest.mark.parametrize("count", [1, 40, 300, 20_000])
def test_a_walk_gives_what_the_formula_gives_leaf_by_leaf(count):
    """Over two features, so paths test them again and again; for few and many rows, and in any number of batches."""
    rng = np.random.default_rng(8)
    nodes, leaves, open_nodes = [], [], [(0, 0, 4096.0, {})]
    while open_nodes:
        node, depth, cover, path = open_nodes.pop()
        if depth == 7 or depth > 2 and rng.random() < 0.2:
            nodes.append((0, node, -1, -1, -1, None, cover, value := rng.normal()))
            leaves.append((value, path))
            continue
        j, threshold, part = int(rng.integers(2)), rng.normal(), rng.uniform(0.1, 0.9)
        nodes.append((0, node, 2 * node + 1, 2 * node + 2, j, threshold, cover, 0.0))
        low, high, share = path.get(j, (-np.inf, np.inf, 1.0))
        open_nodes.append((2 * node + 1, depth + 1, cover * part, path | {j: (low, min(high, threshold), share * part)}))
        open_nodes.append((2 * node + 2, depth + 1, cover * (1 - part), path | {j: (max(low, threshold), high, share * (1 - part))}))
    frame = pd.DataFrame(nodes, columns=["tree", "id", "left", "right", "feature", "threshold", "cover", "value"])
    groups = []
    for m in (1, 2):
        some = [(v, p) for v, p in leaves if len(p) == m]
        arrays = [np.array([[p[j][k] for j in sorted(p)] for _, p in some]).reshape(-1, m) for k in range(3)]
        groups.append((np.array([v for v, _ in some]), np.array([sorted(p) for _, p in some], int).reshape(-1, m), *arrays))
    x = rng.normal(size=(count, 3))
    tree = shared_tree(frame)
    assert ensemble_values([tree, tree], x) == pytest.approx(2 * contributions(groups, x), abs=1e-12)


def test_trees_meet_many_rows_at_once_whatever_the_batches(spark, rows, conf):
    """A batch of the session may be small; each call pays for the trees' nodes again."""
    conf(spark__sql__execution__arrow__maxRecordsPerBatch="7")
    parts = spark.createDataFrame([(0, bytearray(b"x"))], "part long, packed binary")
    same = rows.select("id", F.lit(0).alias("n"), vector_to_array("features").alias("x"))
    found = meeting.meet(same, parts, len, lambda n, x, _: np.full((len(x), 1), float(len(x))), "n_at_once", lines=10_000)
    sizes = [r["n_at_once"][0] for r in found.collect()]
    assert len(sizes) == 300 and min(sizes) > 7  # some 37 rows in each of 8 shards


@pytest.mark.parametrize("kind", ["forest", "boosting", "tree"])
def test_walks_down_the_trees_give_the_models_scores(rows, tree_models, kind):
    model = tree_models[kind]
    got = tree_scores(models.score(model, rows), model, ["id", "score"]).collect()
    assert len(got) == 300
    for r in got:
        assert (1 / (1 + np.exp(-r["total"])) if kind == "boosting" else r["total"]) == pytest.approx(r["score"], abs=1e-12)


def test_many_groups_of_parts_and_shards_of_rows_add_up(spark, rows, tree_models, monkeypatch):
    """Every row meets every tree once, also if each is a group of its own, and no part passes the driver."""
    model = tree_models["forest"]
    wanted = {r["id"]: r["phi"] for r in tree_contributions(rows, model, ["id"])[0].collect()}
    nodes = node_table(spark, model)
    monkeypatch.setattr(meeting.meet, "__defaults__", (1, 7))
    monkeypatch.setattr(type(rows), "toPandas", None)
    explained, _ = tree_contributions(rows.withColumn("group", F.lit(None).cast("string")), nodes, ["id", "group"])
    got = {r["id"]: r["phi"] for r in explained.collect()}
    assert got.keys() == wanted.keys()
    assert all(got[i] == pytest.approx(wanted[i], abs=1e-12) for i in wanted)


def test_no_rows_and_no_parts(spark, rows, tree_models):
    assert tree_contributions(rows.limit(0), tree_models["tree"], ["id"])[0].count() == 0
    nothing = spark.createDataFrame([], "part long, packed binary")
    found = meeting.meet(rows.selectExpr("id", "array(1D, 2D) AS x"), nothing, len, lambda n, x, _: np.full((len(x), 1), float(n)), "n")
    assert {r["n"][0] for r in found.collect()} == {0.0}


def test_perceptrons_are_scored_from_arrays(spark, rows):
    from pyspark.ml.classification import MultilayerPerceptronClassifier

    model = MultilayerPerceptronClassifier(layers=[WIDTH, 4, 3, 2], maxIter=20, seed=1).fit(rows)
    scored = models.score(model, rows).collect()
    x = np.array([r["features"].toArray() for r in scored])
    assert array_scorer(model)(x) == pytest.approx([r["score"] for r in scored], abs=1e-12)
    explained, base = explain(rows, model, "id", background_rows=20)
    scores = {r["id"]: r["score"] for r in scored}
    for r in explained.collect():
        assert base + sum(r["phi"]) == pytest.approx(scores[r["id"]], abs=1e-9)


def test_walks_in_tasks_agree_with_walks_scored_by_spark(spark, rows):
    """For a linear score the order of the features does not matter, so both ways give the same values."""
    plain = lambda df: df.withColumn("score", F.aggregate(
        F.transform(vector_to_array("features"), lambda v, j: v * (j - 2.0)), F.lit(0.0), lambda a, v: a + v))
    slopes = np.arange(WIDTH) - 2.0
    some = rows.where("id < 40")
    one, base = sampled_contributions(some, None, "id", rows.where("id >= 270"), scorer=plain)
    other, again = sampled_contributions(some, None, "id", rows.where("id >= 270"), arrays=lambda x: x @ slopes)
    assert base == pytest.approx(again)
    phi = {r["id"]: r["phi"] for r in one.collect()}
    got = other.collect()
    assert len(got) == 40 and all(r["phi"] == pytest.approx(phi[r["id"]], abs=1e-12) for r in got)
