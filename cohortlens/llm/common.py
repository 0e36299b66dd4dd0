"""Helpers shared by the corpus operators: input columns, folding, worker caches, running totals."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from ..queries.tables import table
from ..session import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BATCH_ROWS, BATCH_BYTES = 2000, 16 << 20


def prepare(spark: SparkSession, rows: int = BATCH_ROWS, size: int = BATCH_BYTES) -> SparkSession:
    """Bounds the Arrow batches by rows and bytes, so that very long texts do not add up in a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))
    return spark


def documents(spark: SparkSession, d: str) -> DataFrame:
    return table(prepare(spark), d, "documents")


def labels(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "labels")


def texts(docs: DataFrame) -> DataFrame:
    """Only the identifier and the whole text (null: empty), whatever else the input carries."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))


def fold(text: Column) -> Column:
    """Lower-cases A-Z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the identifier as text (null: the empty text), modulo ``divisor``."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(divisor))


def row_key(doc_id: Column, text: Column) -> list[Column]:
    """Tells rows apart that share an identifier; rows equal in both are one and the same to every operator."""
    return [F.coalesce(doc_id, F.lit(-1 << 63)).alias("key_id"), F.xxhash64(text).alias("key_text")]


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores before it as make it differ from every column of ``df``."""
    taken, found = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        found.append(name)
    return found


def per_worker(name: str, make: Callable):
    """``make()`` once in each Python worker process, which runs many tasks."""
    held = sys.modules.setdefault("_cohortlens_worker", types.ModuleType("_cohortlens_worker"))
    if not hasattr(held, name):
        setattr(held, name, make())
    return getattr(held, name)


def remembered(make: Callable, *key, size: int = 1 << 16):
    """``make(*key)``, remembered in the worker; all is forgotten when there are ``size`` results. Unlike a cache
    around the function this travels by value."""
    held = per_worker(f"remembered {make.__module__}.{make.__name__}", dict)
    if key not in held:
        if len(held) >= size:
            held.clear()
        held[key] = make(*key)
    return held[key]


def task_id() -> int:
    from pyspark import TaskContext

    context = TaskContext.get()
    return context.partitionId() if context else 0


def running_start(df: DataFrame, value: str, start: str) -> DataFrame:
    """Adds ``start``: the sum of ``value`` over all rows before this one, in an order that is fixed once written.

    Every task adds up its own rows; only one total a task is added up across tasks, so no task and
    no window sees more rows than there are partitions.
    """
    import pyarrow as pa

    at = df.columns.index(value)
    schema = T.StructType(list(df.schema)).add("part", "long").add("local_start", "long")

    def local(batches):
        import numpy as np

        part, total = task_id(), 0
        for batch in batches:
            v = batch.column(at).to_numpy(zero_copy_only=False)
            before = total + np.cumsum(v) - v
            total += int(v.sum())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(len(v), part, np.int64)), pa.array(before.astype(np.int64))],
                names=[*batch.schema.names, "part", "local_start"],
            )

    placed = materialize(df.mapInArrow(local, schema))
    totals = placed.groupBy("part").agg(F.sum(value).alias("part_total"))
    order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("part_total").over(order), F.lit(0)).alias("part_start"))
    return placed.join(offsets, "part").withColumn(start, F.col("part_start") + F.col("local_start")).drop(
        "part", "part_start", "local_start"
    )
