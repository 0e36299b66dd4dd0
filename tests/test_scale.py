"""Plans and behaviour that must hold when tables are large or one key dominates."""

import re
from datetime import datetime as dt

import pytest
from pyspark.sql import functions as F

from cohortlens import session
from cohortlens.operators.cohort import first_per_group
from cohortlens.operators.keyed import with_known_keys
from cohortlens.operators.metrics import roc_auc, roc_curve
from cohortlens.operators.quality import class_distribution, value_shares
from cohortlens.operators.sampling import grouped_split
from cohortlens.operators.windowed import windowed_averages
from cohortlens.plans.dataset import vitals_first_day
from cohortlens.queries import QUERIES
from cohortlens.specs import Measure

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().toString()


def final_plan(df):
    """The plan after adaptive execution of this very DataFrame."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def shuffled(conf):
    """No broadcast joins, and partitions count as skewed from a few KB on."""
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20000",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="10000",
        spark__sql__adaptive__coalescePartitions__enabled="false",
    )


def hot_events(spark):
    """30,000 readings of which one key holds a third, all in one time slot."""
    key = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 2000 + 10)
    return spark.range(0, 30_000, 1, 16).select(
        key.alias("k"), F.lit("p").alias("c"),
        (F.lit(dt(2020, 1, 1)).cast("timestamp_ntz") + F.expr("INTERVAL '1' SECOND") * (F.col("id") % 3600)).alias("t"),
        (F.col("id") % 100 + 1).cast("double").alias("v"),
    )


def test_hot_key_is_split_in_the_window_join(spark, shuffled):
    events = hot_events(spark)
    windows = events.groupBy("k").agg(F.lit(dt(2020, 1, 1)).cast("timestamp_ntz").alias("s"))
    out = windowed_averages(events, windows, "k", "c", "t", "v", "s", [Measure("p", ("p",), 0, 1000)])
    assert "SortMergeJoin(skew=true)" in final_plan(out)
    expected = {r["k"]: round(r["m"], 2) for r in events.groupBy("k").agg(F.avg("v").alias("m")).collect()}
    got = {r["k"]: r["p"] for r in out.collect()}
    assert got.keys() == expected.keys()
    assert all(abs(got[k] - v) < 0.0101 for k, v in expected.items())


def test_hot_group_of_copies_is_split_when_choosing_first_rows(spark, shuffled):
    """A third of all rows are copies of one group's first row."""
    df = spark.range(0, 30_000, 1, 16).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 2000 + 10).alias("g"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("o"), F.col("id").alias("payload"),
    )
    out = first_per_group(df, "g", "o")
    assert "SortMergeJoin(skew=true)" in final_plan(out)
    assert out.where("g = 7").count() == 10_000
    assert out.count() == 10_000 + df.where("g <> 7").select("g").distinct().count()


def test_first_row_choice_uses_no_window(spark):
    assert "Window" not in plan(QUERIES["q02b_first_with_ties"](spark, SF))


def test_filters_and_columns_reach_the_scan(spark, conf):
    conf(spark__sql__maxMetadataStringLength="1000")
    text = plan(QUERIES["q04_window_pivot"](spark, SF))
    assert re.search(r"PushedFilters: \[.*In\(event_type, .*GreaterThan\(value,0\.0\)", text)
    assert "props" not in text.split("== Physical Plan ==")[1]


def test_window_averages_are_combined_before_the_shuffle(spark):
    physical = plan(QUERIES["q05_window_pivot_lines"](spark, SF)).split("== Physical Plan ==")[1]
    assert physical.count("partial_sum") > 0
    assert "CartesianProduct" not in physical and "BroadcastNestedLoopJoin" not in physical


@pytest.mark.parametrize("name", ["q06_assemble", "q40_clinical_dataset", "q41_icu_cohort", "q11_los"])
def test_no_pairing_without_keys(spark, name):
    physical = plan(QUERIES[name](spark, SF)).split("== Physical Plan ==")[1]
    assert "CartesianProduct" not in physical and "BroadcastNestedLoopJoin" not in physical


def test_reports_need_no_window(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("c"))
    assert "Window" not in plan(class_distribution(df, "c")) + plan(value_shares(df, "c"))


def test_one_score_for_a_third_of_the_rows(spark):
    df = spark.range(9000).select(
        (F.col("id") % 2).cast("int").alias("label"),
        F.when(F.col("id") % 3 == 0, 0.5).otherwise(F.pmod(F.xxhash64("id"), F.lit(10_000)) / 10_000.0).alias("score"),
    )
    rows = df.toPandas()
    ranks = rows["score"].rank()
    p = (rows["label"] == 1).sum()
    n = len(rows) - p
    expected = (ranks[rows["label"] == 1].sum() - p * (p + 1) / 2) / (p * n)
    assert roc_auc(df).first()["roc_auc"] == pytest.approx(expected, abs=1e-12)
    assert roc_curve(df).count() == rows["score"].nunique() + 1


def test_lineage_is_cut_in_the_shared_folder(spark):
    stored = session.materialize(spark.range(10).withColumn("x", F.col("id") * 2))
    assert sorted(map(tuple, stored.collect())) == [(i, 2 * i) for i in range(10)]
    assert spark.conf.get("spark.checkpoint.dir") in stored.inputFiles()[0]


def test_vitals_join_broadcasts_only_by_size(spark, conf):
    base = spark.range(1000).select(
        F.col("id").alias("icustay_id"), F.lit(dt(2020, 1, 1)).cast("timestamp_ntz").alias("icu_intime")
    )
    events = spark.createDataFrame([], "icustay_id long, itemid int, charttime timestamp_ntz, valuenum double, error int")
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    physical = plan(vitals_first_day(events, base)).split("== Physical Plan ==")[1]
    assert "Broadcast" not in physical


def test_spreading_rows_starts_no_job(spark):
    from cohortlens.session import spread

    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("spread", "spread")
    spread(spark.range(100).groupBy((F.col("id") % 7).alias("k")).count())
    assert not tracker.getJobIdsForGroup("spread")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_first_rows_read_their_input_twice(spark):
    df = spark.read.parquet(f"{SF}/orders.parquet")
    plan = first_per_group(df, "o_custkey", "o_orderkey")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 2


def shuffled_bytes(spark, df):
    """What the stages of one run write for shuffles."""
    store = spark.sparkContext._jsc.sc().statusStore()
    before = {(s.stageId(), s.attemptId()) for s in _stages(store)}
    df.write.format("noop").mode("overwrite").save()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    return sum(s.shuffleWriteBytes() for s in _stages(store) if (s.stageId(), s.attemptId()) not in before)


def _stages(store):
    listed = store.stageList(None, False, False, spark_doubles(), None)
    return [listed.apply(k) for k in range(listed.size())]


def spark_doubles():
    from pyspark import SparkContext

    context = SparkContext._active_spark_context
    return context._gateway.new_array(context._jvm.double, 0)


def test_events_of_other_keys_stay_out_of_the_shuffle(spark, shuffled):
    events = hot_events(spark)
    windows = session.materialize(spark.createDataFrame([(k, dt(2020, 1, 1)) for k in (11, 12, 999_999, None)], "k long, s timestamp_ntz"))
    average = [Measure("p", ("p",), 0, 1000)]
    plain = windowed_averages(events, windows, "k", "c", "t", "v", "s", average)
    kept = windowed_averages(events, windows, "k", "c", "t", "v", "s", average, stored_windows=True)
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, plain.collect()))
    assert with_known_keys(events, windows, "k").count() < 100 < events.count()
    few = with_known_keys(events, windows, "k", bits=1).count()  # useless, not wrong
    assert few == events.count()
    assert shuffled_bytes(spark, kept) < shuffled_bytes(spark, plain) / 5


def test_the_explained_study_meets_no_rows_again(spark):
    """Score and attributions of a stay come from one pass: neither the stays nor their vectors are shuffled to meet."""
    assert "hashpartitioning" not in plan(QUERIES["q52_clinical_explained"](spark, SF))


def test_rows_stay_where_they_are_for_a_small_test_side(spark):
    """Rows of a missing group, or of a group that occurs twice, keep their number."""
    rows = spark.range(400).select(F.col("id"), F.when(F.col("id") % 9 > 0, F.col("id") % 50).alias("g"), (F.col("id") % 2).alias("y"))
    split = grouped_split(session.materialize(rows), "y", "g")
    assert "hashpartitioning" not in plan(split)
    assert split.count() == 400 and split.where("g IS NULL AND split = 'test'").isEmpty()
    assert split.groupBy("g").agg(F.countDistinct("split").alias("n")).where("n > 1").isEmpty()
    assert split.where("split = 'test'").select("g").distinct().count() == 10


def test_every_known_key_is_kept_and_few_others(spark):
    keyed = session.materialize(spark.range(0, 400_000, 13).select(F.col("id").alias("k")))
    rows = spark.range(400_000).select(F.col("id").alias("k"))
    kept = with_known_keys(rows, keyed, "k")
    assert keyed.exceptAll(kept).isEmpty()
    assert kept.count() < 1.01 * keyed.count()


def test_settings_of_a_block_end_with_it(spark, conf):
    conf(spark__sql__files__minPartitionNum="5")
    names = ["spark.sql.files.minPartitionNum", "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"]
    before = [spark.conf.get(n) for n in names]
    with pytest.raises(ZeroDivisionError), session.evenly(spark):
        assert spark.conf.get(names[0]) == str(3 * spark.sparkContext.defaultParallelism)
        1 / 0
    assert [spark.conf.get(n) for n in names] == before
