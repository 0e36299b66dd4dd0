"""Exact deduplication by content sort.

Normalised bytes are dealt to range partitions by splitters that Spark samples, the external sort
places equal texts next to each other, and every text is compared in full with its neighbour. The
ranges are cut on (first bytes, content hash, doc_id): a text with any number of copies is spread
over as many partitions as its rows need, and the parts of such a run are joined afterwards from
one summary row for each part.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import materialize
from .common import documents, fold, free_names, task_id, texts

HEAD_BYTES = 24
RUNS = (
    "doc_id long, text_sha256 string, keep_id long, group_size long, leads boolean, edge boolean, part long"
)
OUT_ROWS = 8192


def content_sort(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; a null text is empty and equal to other
    empty ones. The row with the largest doc_id of a group stays; a null doc_id is smaller than any
    other, and of rows that repeat the largest doc_id exactly one stays. An empty table gives an
    empty result; other columns are ignored.
    """
    body = texts(docs).select("doc_id", fold(F.col("text")).cast("binary").alias("body"))
    keyed = body.select("doc_id", "body", F.substring("body", 1, HEAD_BYTES).alias("head"), F.xxhash64("body").alias("tie"))
    ranged = keyed.repartitionByRange("head", "tie", "doc_id").sortWithinPartitions(
        "head", "tie", "body", F.col("doc_id").desc_nulls_last()
    )
    runs = materialize(ranged.select("doc_id", "body").mapInArrow(_neighbours, RUNS))
    inner = runs.where(~F.col("edge")).withColumn("last_id", F.col("keep_id"))
    # A run can go on in other partitions only if it is the first or the last of its own.
    edge = runs.where("edge")
    seams = edge.groupBy("text_sha256").agg(F.max("keep_id").alias("last_id"), F.count("*").alias("whole_size"))
    # Two rows a partition at most, so the rows of a long run stay where they are.
    outer = edge.join(F.broadcast(seams), "text_sha256").withColumn("group_size", F.col("whole_size")).drop("whole_size")
    return inner.unionByName(outer).select(
        "doc_id",
        F.col("last_id").alias("keep_id"),
        "group_size",
        (F.col("leads") & F.col("doc_id").eqNullSafe(F.col("last_id"))).alias("kept"),
        "text_sha256",
    )


def keep_last(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all their columns, but one only of each group of equal texts: the one with
    the largest doc_id; of rows that repeat both text and doc_id any one stays. Null texts are empty, a null
    doc_id is the smallest, columns of any other name come back untouched, an empty table gives none."""
    least, names = F.lit(-1 << 63), free_names(docs, "id", "sha")
    found = content_sort(docs).where("kept").select(F.coalesce("doc_id", least).alias(names[0]), F.col("text_sha256").alias(names[1]))
    body = F.sha2(fold(F.coalesce("text", F.lit(""))).cast("binary"), 256)
    marked = docs.withColumns({names[0]: F.coalesce(F.col("doc_id").cast("long"), least), names[1]: body})
    # The join has dealt the rows by these columns already.
    return marked.join(found, names, "left_semi").dropDuplicates(names).drop(*names)


def _neighbours(batches):
    """Compares each text with the one before it; the rows of a run leave together once it has ended."""
    import pyarrow as pa

    part, body, ids, first = task_id(), None, [], True
    out: list[list] = [[] for _ in range(6)]

    def close(edge):
        sha = hashlib.sha256(body).hexdigest()
        for column, values in zip(out, (ids, [sha] * len(ids), [ids[0]] * len(ids), [len(ids)] * len(ids), [True] + [False] * (len(ids) - 1), [edge] * len(ids))):
            column.extend(values)

    def emit():
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_())
        columns = [pa.array(c, k) for c, k in zip(out, kinds)] + [pa.array([part] * len(out[0]), pa.int64())]
        for column in out:
            column.clear()
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "text_sha256", "keep_id", "group_size", "leads", "edge", "part"])

    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if text != body:
                if ids:
                    close(first)
                    first = False
                body, ids = text, []
            ids.append(doc_id)
        if len(out[0]) >= OUT_ROWS:
            yield emit()
    if ids:
        close(True)
    yield emit()


def query(spark: SparkSession, d: str) -> DataFrame:
    return content_sort(documents(spark, d))


QUERIES = {"op6_content_sort": query}
ORACLES = {
    "op6_content_sort": """
WITH t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body
           FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY body) AS keep_id, count(*) OVER (PARTITION BY body) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY body) AS kept, sha256(body) AS text_sha256
FROM t"""
}
