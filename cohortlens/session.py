"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# AQE measures every shuffle, so it alone decides broadcast joins, partition counts and the
# splitting of skewed partitions; no operator in this package forces a broadcast of data whose
# size it has not bounded.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A split hot key may need one more exchange behind the join; that is cheaper than one hot task.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Python workers get batches of bounded size, whatever a row holds.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 << 20),
}


# On a cluster shuffles start with this many partitions per core, and AQE merges the small ones.
# Nothing here knows the input's size: a job that shuffles more than some hundred MB a partition sets
# the option itself.
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
WAVES = 4


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators rely on (timestamps without zone read as UTC)."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    sc = spark.sparkContext
    if not sc.master.startswith("local") and spark.conf.get(INITIAL_PARTITIONS, None) is None:
        spark.conf.set(INITIAL_PARTITIONS, str(WAVES * sc.defaultParallelism))
    return spark


def local_session(
    app: str, cores: str = "*", partitions: int = 8, memory: str = "8g", checkpoint_dir: str | None = None
) -> SparkSession:
    """A single-machine session for tests and the benchmark; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if checkpoint_dir is not None:
        builder = builder.config("spark.checkpoint.dir", checkpoint_dir)
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """A fresh sub-folder of the checkpoint folder every executor can reach.

    The folder comes from ``spark.checkpoint.dir``. Only a local session may do without that
    setting; it then gets a temporary folder of its own.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="cohortlens-")
        sc.setCheckpointDir(root)
    path = os.path.join(root, f"cohortlens-{uuid.uuid4().hex}")
    _made.append(path)
    return path


_made: list[str] = []  # folders handed out by shared_dir


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Deletes, at the end of the block, the folders that ``shared_dir`` has given out inside it.

    For whole runs whose results are written elsewhere: tables that were only handed on, such as those of
    ``materialize``, cannot be read any more afterwards.
    """
    first = len(_made)
    try:
        yield
    finally:
        while len(_made) > first:
            discard(spark, _made.pop())


def discard(spark: SparkSession, path: str) -> None:
    """Deletes a folder whose rows have been handed on and are not read any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


# For stages that last: several tasks a core, so that no core waits for one late task, and hash joins, which sort
# nothing, where AQE has measured that each partition of a side is small enough to be held.
TASKS_PER_CORE = 3
HASHED_PARTITION = 64 << 20


@contextmanager
def evenly(spark: SparkSession) -> Iterator[None]:
    """Runs the jobs of the block with smaller tasks, and joins with small partitions without sorting them.

    Choices of execution alone: rows are the same. What is only planned inside, and runs later, is not affected.
    """
    tasks = str(TASKS_PER_CORE * spark.sparkContext.defaultParallelism)
    settings = {
        "spark.sql.adaptive.coalescePartitions.minPartitionNum": tasks,
        "spark.sql.files.minPartitionNum": tasks,
        "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": str(HASHED_PARTITION),
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """What the tables written inside the block have shuffled is deleted as soon as each is written.

    What is only planned inside, and runs later, is not affected.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def materialize(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder once and read it back.

    Cuts lineage durably (a lost executor re-reads files instead of recomputing), and gives
    Catalyst the real file size, which is what decides between broadcast and shuffle joins.
    Whoever names the ``path`` can ``discard`` it.
    """
    spark = df.sparkSession
    path = path or shared_dir(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Redistribute rows over the cores before heavy work on them, without running anything yet."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)
