import math
import shutil
import statistics

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from cohortlens.functions import slug
from cohortlens.operators import ranking
from cohortlens.operators.encode import DictionaryEncoder, feature_names, fit_features, label_encode, ordinal_encode, split_by_type
from cohortlens.operators.ranking import sorted_codes
from cohortlens.operators.sampling import class_counts, fixed_sample, split_sizes, stratified_split
from cohortlens.operators.stats import class_weights, distributed_medians, medians, modes, moments, with_weights


def test_gender_codes(spark):
    df = spark.createDataFrame([(1, None), (2, "F"), (3, "M")], "id int, gender string")
    assert {r["id"]: r["gender"] for r in label_encode(df, "gender").collect()} == {1: 2, 2: 0, 3: 1}


@pytest.mark.parametrize("inline", [0, 1000])
def test_unknown_category(spark, inline):
    train = spark.createDataFrame([("b",), ("a",), ("a",), (None,)], "c string")
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, "zz"), (4, None)], "id int, c string")
    coded = ordinal_encode(rows, sorted_codes(train, "c"), "c", "code", inline_values=inline)
    assert {r["id"]: r["code"] for r in coded.collect()} == {1: 0, 2: 1, 3: -1, 4: -1}


def test_empty_dictionary_knows_nothing(spark):
    train = spark.createDataFrame([(None,)], "c string")
    rows = spark.createDataFrame([("a",)], "c string")
    assert ordinal_encode(rows, sorted_codes(train, "c"), "c", "code").first()["code"] == -1


def test_numbering_by_range_equals_numbering_in_one_task(spark):
    values = spark.range(5000).select(F.concat(F.lit("v"), F.xxhash64("id").cast("string")).alias("value"))
    expected = {v: i for i, v in enumerate(sorted(r[0] for r in values.collect()))}
    assert {r["value"]: r["code"] for r in ranking.number_sorted(values.repartition(7)).collect()} == expected


def test_median_fill_then_scale(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (None,)], "x double")
    centre = medians(df, ["x"])
    assert centre == {"x": 1.5}
    mean, deviation = moments(df, centre)["x"]
    assert mean == 1.5 and abs(deviation - 0.408248) < 1e-6


def test_constant_column_is_divided_by_one(spark):
    df = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    assert moments(df, {"x": 3.0}) == {"x": (3.0, 1.0)}


@pytest.mark.parametrize("slice_rows", [3, 1_000_000])
def test_distributed_median(spark, slice_rows):
    data = [(float(i * 37 % 101), float(i % 2) if i % 3 else None, float(i) if i < 5 else None) for i in range(200)]
    df = spark.createDataFrame(data, "a double, b double, c double").withColumn("d", F.lit(None).cast("double"))
    found = {r["column"]: r["median"] for r in distributed_medians(df, ["a", "b", "c", "d"], slice_rows).collect()}
    columns = zip("abc", zip(*data))
    assert found == {n: statistics.median(v for v in col if v is not None) for n, col in columns}


def test_mode_takes_the_smallest_of_equals(spark):
    df = spark.createDataFrame([("b", None), ("a", None), ("b", None), ("a", None), ("c", None)], "x string, y string")
    assert modes(df, ["x", "y"]) == {"x": "a", "y": None}


def test_numeric_and_categorical_columns(spark):
    df = spark.createDataFrame([], "id long, s string, d decimal(5,1), i short, b boolean, y int")
    assert split_by_type(df, exclude=["id", "y"]) == (["d", "i"], ["s", "b"])


ROWS = [(1, 10.0, None, "x'y", "p"), (2, None, None, "a\\b", None), (3, 30.0, None, "x'y", "q"), (4, 5.0, None, None, "q")]
SCHEMA = "id int, n double, empty double, s string, t string"


@pytest.mark.parametrize("inline", [0, 1000])
def test_fitted_features(spark, tmp_path, inline):
    """Numeric block first; a column without values is dropped; saving and loading changes nothing."""
    train = spark.createDataFrame(ROWS, SCHEMA)
    fitted = fit_features(train, ["n", "empty"], ["s", "t"], inline_values=inline)
    assert fitted.names == ["n", "s", "t"]
    PipelineModel(stages=fitted.stages).write().overwrite().save(str(tmp_path / "m"))
    loaded = PipelineModel.load(str(tmp_path / "m"))
    assert feature_names(loaded.stages) == ["n", "s", "t"]
    rows = spark.createDataFrame([*ROWS, (5, 0.0, 1.0, "new", "p")], SCHEMA)
    got = {r["id"]: list(r["features"].toArray()) for r in loaded.transform(rows).collect()}
    filled = [10.0, 10.0, 30.0, 5.0]
    mean, deviation = statistics.fmean(filled), statistics.pstdev(filled)
    expected = {
        1: [(10 - mean) / deviation, 1, 0], 2: [(10 - mean) / deviation, 0, 1], 3: [(30 - mean) / deviation, 1, 1],
        4: [(5 - mean) / deviation, 1, 1], 5: [(0 - mean) / deviation, -1, 0],
    }
    for i, v in expected.items():
        assert got[i] == pytest.approx(v, abs=1e-12)


def test_saved_dictionary_lies_in_the_model(spark, tmp_path):
    """150 categories: the saved model is copied elsewhere and needs nothing but its own folder."""
    train = spark.createDataFrame([(k, float(k), None, f"c{k % 150:03d}", "p") for k in range(450)], SCHEMA)
    fitted = fit_features(train, ["n"], ["s"])
    PipelineModel(stages=fitted.stages).write().overwrite().save(str(tmp_path / "m"))
    shutil.copytree(tmp_path / "m", tmp_path / "copy")
    loaded = PipelineModel.load(str(tmp_path / "copy"))
    encoder = next(s for s in loaded.stages if isinstance(s, DictionaryEncoder))
    assert str(tmp_path / "copy") in encoder.getOrDefault(encoder.path)
    codes = {r["s"]: r["features"][1] for r in loaded.transform(train).select("s", "features").collect()}
    assert codes == {f"c{k:03d}": float(k) for k in range(150)}


def test_balanced_weights(spark):
    df = spark.createDataFrame([(0,)] * 30 + [(1,)] * 10, "y int")
    assert {r["class"]: r["weight"] for r in class_weights(df, "y").collect()} == {0: 40 / 60, 1: 40 / 20}
    assert with_weights(df.limit(0), "y", class_weights(df.limit(0), "y")).collect() == []


def plain_sizes(counts, fraction):
    """Largest remainder, given to training rows."""
    n = sum(counts.values())
    n_train = n - math.ceil(round(fraction * n, 9))
    train = {c: n_train * k // n for c, k in counts.items()}
    for c in sorted(counts, key=lambda c: (-(n_train * counts[c] % n), str(c)))[: n_train - sum(train.values())]:
        train[c] += 1
    return {c: k - train[c] for c, k in counts.items()}


@pytest.mark.parametrize("counts", [{0: 348, 1: 51}, {0: 1, 1: 1}, {0: 7, 1: 3, 2: 5}, {None: 4, 1: 11}])
def test_split_sizes_add_up(spark, counts):
    sizes = split_sizes(spark.createDataFrame(list(counts.items()), "class int, n long"), 0.2)
    sizes = {r["class"]: r["n_test"] for r in sizes.collect()}
    n = sum(counts.values())
    assert sizes == plain_sizes(counts, 0.2)
    assert sum(sizes.values()) == math.ceil(n / 5)
    assert all(abs(sizes[c] - k * (1 - (n - math.ceil(n / 5)) / n)) < 1 for c, k in counts.items())


def test_split_is_exact_and_independent_of_partitioning(spark):
    df = spark.range(3000).select("id", F.when(F.col("id") % 10 == 0, 1).when(F.col("id") % 7 != 0, 0).alias("y"))
    one = stratified_split(df.repartition(1), "y", "id")
    many = stratified_split(df.repartition(23), "y", "id")
    assert sorted(map(tuple, one.collect()), key=str) == sorted(map(tuple, many.collect()), key=str)
    got = {(r["y"], r["split"]): r["count"] for r in one.groupBy("y", "split").count().collect()}
    for y, k in plain_sizes({r["class"]: r["n"] for r in class_counts(df, "y").collect()}, 0.2).items():
        assert got[(y, "test")] == k
    other = stratified_split(df, "y", "id", seed=7)
    assert other.exceptAll(many).count() > 0


def test_split_is_exact_on_repeated_and_missing_ids(spark):
    rows = spark.createDataFrame([(None if k % 5 == 0 else k // 4, k % 2) for k in range(400)], "id int, y int")
    got = {(r["y"], r["split"]): r["count"] for r in stratified_split(rows, "y", "id").groupBy("y", "split").count().collect()}
    assert got == {(0, "test"): 40, (0, "train"): 160, (1, "test"): 40, (1, "train"): 160}
    same = stratified_split(rows.withColumn("id", F.lit(1)), "y", "id").groupBy("split").count().collect()
    assert {r["split"]: r["count"] for r in same} == {"test": 80, "train": 320}


def test_fixed_sample_is_exact_and_reproducible(spark):
    df = spark.range(1000)
    a, b = fixed_sample(df.repartition(3), 100, "id"), fixed_sample(df.repartition(11), 100, "id")
    assert sorted(r[0] for r in a.collect()) == sorted(r[0] for r in b.collect())
    assert a.count() == 100 and fixed_sample(df, 5000, "id").count() == 1000


def test_slug():
    assert slug("Gradient Boosting") == "gradient_boosting"
    assert slug("  A--b  (c) ") == "a_b_c" and slug("Éa_1") == "éa_1" and slug("...") == ""


def test_samples_of_any_size_hold_the_smallest_numbers(spark):
    """Also where identifiers repeat, are missing or all the same, and where numbers collide."""
    ids = [None if k % 9 == 0 else k // 3 for k in range(600)]
    df = spark.createDataFrame([(i, k) for k, i in enumerate(ids)], "id int, k int").repartition(4)
    for n in (0, 1, 299, 300, 301, 599, 600, 601):
        got = fixed_sample(df, n, "id", order=F.coalesce(F.col("id"), F.lit(0)) % 7)
        wanted = sorted(((i or 0) % 7, i is not None, i or 0) for i in ids)[:n]
        assert sorted(((r["id"] or 0) % 7, r["id"] is not None, r["id"] or 0) for r in got.collect()) == wanted
        assert got.distinct().count() == min(n, 600)
    assert fixed_sample(df.withColumn("id", F.lit(1)), 77, "id").distinct().count() == 77


def test_a_label_of_thousands_of_values_splits_exactly(spark):
    df = spark.range(12_000).select("id", (F.col("id") % 5000).alias("y"))
    got = stratified_split(df, "y", "id").groupBy("y").agg(F.sum((F.col("split") == "test").cast("int")).alias("n"))
    sizes = {r["y"]: r["n"] for r in got.collect()}
    assert sizes == plain_sizes({y: 3 if y < 2000 else 2 for y in range(5000)}, 0.2)
    weights = class_weights(df, "y")
    assert weights.count() == 5000
    assert with_weights(df, "y", weights).agg(F.round(F.sum("weight"), 6)).first()[0] == 12_000


def test_label_codes_are_part_of_the_saved_model(spark, tmp_path):
    """Fitted on one class, the saved model alone scores another; a missing value is a class of its own."""
    train = spark.createDataFrame([("F", 1.0), ("F", 3.0)], "gender string, age double")
    stages = fit_features(train, ["gender", "age"], []).stages
    assert feature_names(stages) == ["gender", "age"]
    PipelineModel(stages=stages).write().overwrite().save(str(tmp_path / "m"))
    rows = spark.createDataFrame([("F", 2.0), ("M", 2.0), (None, 2.0)], "gender string, age double")
    got = {r["gender"]: r["features"][0] for r in PipelineModel.load(str(tmp_path / "m")).transform(rows).collect()}
    assert got == {"F": 0.0, "M": -1.0, None: -1.0}
    train = spark.createDataFrame([("M", 1.0), ("F", 1.0), (None, 1.0), ("F", 1.0)], "gender string, age double")
    coded = PipelineModel(stages=fit_features(train, ["gender"], []).stages[:1]).transform(train)
    assert {r["gender"]: r["code_gender"] for r in coded.collect()} == {"F": 0, "M": 1, None: 2}


def test_fills_and_scales_take_two_passes(spark):
    from cohortlens.operators.stats import fills_and_scales

    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    plain = spark.range(500).select(F.when(F.col("id") % 3 != 0, F.sqrt("id")).alias("a"), (F.col("id") % 2).alias("b"), F.lit(None).cast("int").alias("c"))
    got = fills_and_scales(plain.mapInArrow(counted, plain.schema), ["a", "b", "c"])
    assert seen.value <= 3 * 500  # brackets and moments, then counts, whose range bounds Spark may sample once
    centres = {c: m for c, m in medians(plain, ["a", "b", "c"]).items() if m is not None}
    scales = moments(plain, centres)
    assert got.keys() == {"a", "b"}
    assert all(got[c] == pytest.approx((centres[c], *scales[c])) for c in got)
