"""Rows meet packed parts of a model, or of a background, by key: neither passes through the driver.

Parts are put into groups of a bounded size and copied to shards of rows. A task reads the parts of a
group first, keeps them while the rows of the shard stream through, and lets go of them at the next
key. What several groups give for one row is added up.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F, types as T

from ..session import materialize

GROUP_BYTES = 64 << 20  # packed bytes of a group, which is what a task holds
SHARD_ROWS = 1 << 16  # rows that share one copy of the parts

# What runs in tasks travels by value; the package need not be installed on executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def meet(
    rows: DataFrame,
    parts: DataFrame,
    load: Callable[[list[bytes]], object],
    work: Callable[[object, np.ndarray, np.ndarray], np.ndarray],
    found: str,
    group_bytes: int = GROUP_BYTES,
    shard_rows: int = SHARD_ROWS,
    *,
    lines: int = 1,
) -> DataFrame:
    """``rows`` with the array ``found``: the sum over groups of ``work(load(parts), x, seeds)`` for the row.

    ``rows`` has a column ``x`` (array of doubles, of one length) and may have ``_seed`` (a long), which
    is left out of the result; ``parts`` has ``part`` (a long) and ``packed`` (binary). ``work`` returns
    one line for each row, and gets at least ``lines`` rows at once, unless the shard has fewer left, whatever the
    size of the session's batches. Rows and parts are stored first. The shuffle carries the rows, once for each
    group, and the parts, once for each shard.
    """
    if "_seed" not in rows.columns:
        rows = rows.withColumn("_seed", F.lit(0).cast("long"))
    rows = materialize(rows.withColumn("_row", F.monotonically_increasing_id()))
    parts = materialize(parts.select(F.col("part").cast("long").alias("part"), "packed"))
    size = parts.agg(F.coalesce(F.sum(F.length("packed")), F.lit(0))).first()[0]
    groups = max(1, math.ceil(size / group_bytes))
    shards = max(rows.sparkSession.sparkContext.defaultParallelism, math.ceil(rows.count() / shard_rows))
    row = F.struct(*rows.columns).alias("row")
    left = rows.select(
        F.pmod(F.xxhash64("_row"), F.lit(shards)).alias("shard"), _numbers(groups, "group"), F.lit(1).alias("kind"),
        F.lit(-1).cast("long").alias("part"), F.lit(None).cast("binary").alias("packed"), row,
    )
    right = parts.select(
        _numbers(shards, "shard"), F.pmod("part", F.lit(groups)).alias("group"), F.lit(0).alias("kind"), "part", "packed",
        F.lit(None).cast(T.StructType(rows.schema.fields)).alias("row"),
    )
    key = ["shard", "group"]
    dealt = left.unionByName(right).repartition(*key).sortWithinPartitions(*key, "kind", "part")
    names = rows.columns
    schema = T.StructType([*rows.schema.fields, T.StructField(found, T.ArrayType(T.DoubleType()))])

    def stream(batches):
        import pyarrow as pa

        held, loaded, here, waiting = [], None, None, []

        def worked():
            columns = pa.concat_arrays(waiting).flatten() if len(waiting) > 1 else waiting[0].flatten()
            waiting.clear()
            x = columns[names.index("x")].flatten().to_numpy(zero_copy_only=False).reshape(len(columns[0]), -1)
            values = work(loaded[0], x, columns[names.index("_seed")].to_numpy())
            offsets = pa.array(np.arange(len(x) + 1, dtype=np.int32) * values.shape[1])
            listed = pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(values).reshape(-1)))
            return pa.RecordBatch.from_arrays([*columns, listed], names=[*names, found])

        for batch in batches:
            shard, group, kind = (batch.column(k).to_numpy() for k in range(3))
            packed, rows_here = batch.column(4), batch.column(5)
            turns = np.flatnonzero((np.diff(shard) != 0) | (np.diff(group) != 0) | (np.diff(kind) != 0)) + 1
            for a, b in zip([0, *turns], [*turns, len(kind)]):
                if a == b:
                    continue
                if (now := (shard[a], group[a])) != here:
                    if waiting:
                        yield worked()
                    held, loaded, here = [], None, now
                if not kind[a]:
                    held += packed.slice(a, b - a).to_pylist()
                    continue
                if loaded is None:
                    loaded, held = (load(held),), []
                waiting.append(rows_here.slice(a, b - a))
                if sum(map(len, waiting)) >= lines:
                    yield worked()
        if waiting:
            yield worked()

    met = dealt.select("shard", "group", "kind", "part", "packed", "row").mapInArrow(stream, schema)
    if groups > 1:
        # One array from each group, of which there are as many as the parts' size has it.
        kept = [F.first(c).alias(c) for c in names if c != "_row"]
        arrays = F.collect_list(found)
        total = F.aggregate(F.slice(arrays, 2, groups), arrays[0], lambda a, v: F.zip_with(a, v, lambda p, q: p + q))
        met = met.groupBy("_row").agg(*kept, total.alias(found))
    return met.drop("_row", "_seed")


def _numbers(n: int, name: str):
    """The numbers 0 to n - 1, one to a row."""
    return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))).alias(name)
