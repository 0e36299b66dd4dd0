"""Hard negatives by threshold joins with norm-bounded inverted indexes.

Rows are packed into blocks of a bounded size, anchors into blocks of their own, and every block of
anchors meets every block of rows. Inside such a pair the dimensions are ordered by weight and indexed
only where they have to be: as long as the norm of a row's first dimensions times the largest norm of
the anchors' stays below every threshold, these dimensions are left out, for a row that agrees there
alone cannot reach one; rows covered to the end are not looked at. Scores are accumulated over the
indexed dimensions, and after each step pairs are dropped whose remaining norms cannot make up for
what is missing. The left-out dimensions are added for the pairs that remain.

An anchor has windows (lowest and highest score, number of rows wanted). Thresholds are found from a
first round over a sixty-fourth of the blocks: a window that it fills needs nothing below its last row;
for one that is not full the threshold goes down to the window's lowest score. The second round reads
all other blocks with these thresholds, so windows hold the same rows as without any.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..queries.tables import table
from ..session import materialize
from .common import prepare

EVERY, POSITIVES, NEGATIVES = 100, 5, 10
LOW, HIGH = 30, 90  # hundredths of the positive score between which a negative lies
SCALE = 256
BLOCK_VALUES, BLOCK_ROWS = 1 << 18, 4096  # components and rows in a block, about
FIRST_ROUND = 64  # the first round reads one block of so many
STEP = 16  # dimensions accumulated between two prunings
LEAST = -(1 << 62)
EXACT = 1 << 53  # products up to which sums of doubles are exact


def mine_negatives(embeddings: DataFrame, relabelled: bool = False) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are rows whose vec_id is divisible by EVERY; their positives the best rows of the same label with
    another vec_id; the negatives of a positive the best rows of other labels whose score lies between LOW and
    HIGH hundredths of its own. Scores are integer inner products of floor(SCALE * x), ties go to the smaller
    vec_id. Rows with a null vec_id, label, vector or component, or a component that is not finite, take no
    part. Where vectors differ in length, missing components are 0. Rows that are repeated are rows like any
    other: each takes a place in the lists, and a repeated anchor has its lists as often. Scores have to fit in
    a long. Other columns are ignored; an empty table, or an anchor without positives, gives nothing.
    """
    rows = _valid(embeddings, relabelled)
    count, most = embeddings.agg(F.count("*"), F.max(F.size("embedding"))).first()
    per_block = max(64, min(BLOCK_ROWS, BLOCK_VALUES // max(1, most or 1)))
    n_blocks = max(1, -(-count // per_block))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(n_blocks)))
    blocks = materialize(dealt.groupBy("block").applyInPandas(_pack, "block long, ids binary, labels binary, dims int, kind string, vectors binary"))
    own = rows.where(F.col("vec_id") % EVERY == 0).withColumn("anchor", F.monotonically_increasing_id())
    anchors = materialize(own)
    n_anchors = anchors.count()
    anchors = anchors.withColumn("share", F.pmod(F.xxhash64("anchor"), F.lit(max(1, -(-n_anchors // per_block)))))
    every = anchors.select("anchor", F.lit(0).alias("w"), F.lit(LEAST).alias("low"), F.lit(-LEAST).alias("high"))
    near = materialize(_fill(anchors, every, blocks, n_blocks, POSITIVES, True))
    score = F.col("score")
    windows = near.select(
        "anchor", (F.col("rank") - 1).alias("w"), F.expr(f"({LOW} * score + 99) div 100").alias("low"),
        F.expr(f"({HIGH} * score) div 100").alias("high"), F.col("vec_id").alias("positive_id"), score.alias("positive_score"),
    ).where("positive_score >= 0 AND low <= high")
    windows = materialize(windows)
    found = _fill(anchors, windows.select("anchor", "w", "low", "high"), blocks, n_blocks, NEGATIVES, False)
    named = windows.join(anchors.select("anchor", F.col("vec_id").alias("anchor_id")), "anchor")
    return named.join(found, ["anchor", "w"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


def _valid(embeddings: DataFrame, relabelled: bool) -> DataFrame:
    id_, label = F.col("vec_id").cast("long"), F.col("label").cast("long")
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = embeddings.where(id_.isNotNull() & label.isNotNull() & F.col("embedding").isNotNull()).where(~bad)
    label = F.when(id_ % 7 == 0, F.pmod(label + 1, F.lit(10))).otherwise(label) if relabelled else label
    return rows.select(id_.alias("vec_id"), label.alias("label"), F.col("embedding").cast("array<double>").alias("embedding"))


def _fill(anchors: DataFrame, windows: DataFrame, blocks: DataFrame, n_blocks: int, wanted: int, same: bool) -> DataFrame:
    """anchor, w, rank, vec_id, score: the best rows inside each window."""
    early = max(1, n_blocks // FIRST_ROUND)
    windows = windows.withColumn("least", F.col("low"))
    first = materialize(_best(_meet(anchors, windows, blocks.where(F.col("block") < early), range(early), wanted, same), wanted))
    full = first.where(F.col("rank") == wanted).select("anchor", "w", F.col("score").alias("reached"))
    windows = windows.join(full, ["anchor", "w"], "left").withColumn("least", F.coalesce("reached", "low")).drop("reached")
    rest = _meet(anchors, windows, blocks.where(F.col("block") >= early), range(early, n_blocks), wanted, same)
    return _best(rest.unionByName(first.drop("rank")), wanted)


def _best(found: DataFrame, wanted: int) -> DataFrame:
    # Spark limits such ranks within every task before it shuffles.
    order = Window.partitionBy("anchor", "w").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= wanted)


def _meet(anchors: DataFrame, windows: DataFrame, blocks: DataFrame, numbers: range, wanted: int, same: bool) -> DataFrame:
    """anchor, w, vec_id, score: the best of each block for each window, none below its threshold."""
    listed = windows.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("w", "low", "high", "least"))).alias("windows"))
    packed = anchors.join(listed, "anchor").groupBy("share").applyInPandas(
        _pack_anchors, "ids binary, labels binary, dims int, kind string, vectors binary, anchors binary, windows binary, most int"
    )
    copies = packed.select(*[F.col(c).alias(f"a_{c}") for c in packed.columns])
    first, last = (F.lit(k).cast("long") for k in (numbers.start, numbers.stop - 1))
    copies = copies.withColumn("block", F.explode(F.sequence(first, last) if len(numbers) else F.array().cast("array<long>")))
    # Never a broadcast: the copies are as many as the blocks.
    pairs = blocks.join(copies.hint("merge"), "block")

    def scan(batches):
        import pyarrow as pa

        for batch in batches:
            columns = {name: batch.column(k) for k, name in enumerate(batch.schema.names)}
            for k in range(batch.num_rows):
                found = _scan({name: c[k].as_py() for name, c in columns.items()}, wanted, same)
                yield pa.RecordBatch.from_arrays([pa.array(v) for v in found], names=["anchor", "w", "vec_id", "score"])

    return pairs.mapInArrow(scan, "anchor long, w int, vec_id long, score long")


def _pack(frame: pd.DataFrame) -> pd.DataFrame:
    import numpy as np

    vectors = frame["embedding"].to_numpy()
    dims = max((len(v) for v in vectors), default=0)
    whole = np.zeros((len(vectors), dims))
    for row, v in zip(whole, vectors):
        row[: len(v)] = v
    whole = np.floor(whole * SCALE)
    most = np.abs(whole).max(initial=0)
    kind = "<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<i8"
    return pd.DataFrame([{
        "block": frame["block"].iloc[0] if "block" in frame else 0, "ids": frame["vec_id"].to_numpy(np.int64).tobytes(),
        "labels": frame["label"].to_numpy(np.int64).tobytes(), "dims": dims, "kind": kind, "vectors": whole.astype(kind).tobytes(),
    }])


def _pack_anchors(frame: pd.DataFrame) -> pd.DataFrame:
    import numpy as np

    packed = _pack(frame).drop(columns="block")
    most = max(len(w) for w in frame["windows"])
    windows = np.zeros((len(frame), most, 4), np.int64)
    windows[:, :, 0] = -1
    for own, some in zip(windows, frame["windows"]):
        for line, one in zip(own, some):
            line[:] = one["w"], one["low"], one["high"], one["least"]
    return packed.assign(anchors=frame["anchor"].to_numpy(np.int64).tobytes(), windows=windows.tobytes(), most=most)


def _unpacked(row: dict, prefix: str = ""):
    import numpy as np

    ids, labels = (np.frombuffer(row[prefix + c], np.int64) for c in ("ids", "labels"))
    vectors = np.frombuffer(row[prefix + "vectors"], row[prefix + "kind"]).reshape(len(ids), row[prefix + "dims"])
    return ids, labels, vectors


def _scan(row: dict, wanted: int, same: bool):
    import numpy as np

    ids, labels, x = _unpacked(row)
    own_ids, own_labels, q = _unpacked(row, "a_")
    windows = np.frombuffer(row["a_windows"], np.int64).reshape(len(own_ids), row["a_most"], 4)
    anchors = np.frombuffer(row["a_anchors"], np.int64)
    x, q = _wide(x, q)
    open_ = windows[:, :, 0] >= 0
    least = np.where(open_, windows[:, :, 3], -LEAST).min(axis=1)
    found = []
    if same:
        for label in np.unique(own_labels):
            here, there = np.flatnonzero(own_labels == label), np.flatnonzero(labels == label)
            a, b, s = threshold_join(q[here], x[there], least[here])
            a, b = here[a], there[b]
            other = own_ids[a] != ids[b]
            found.append((a[other], b[other], s[other]))
    else:
        a, b, s = threshold_join(q, x, least)
        other = own_labels[a] != labels[b]
        found.append((a[other], b[other], s[other]))
    a, b, s = (np.concatenate(c) for c in zip(*found))
    out = []
    for w in range(windows.shape[1]):
        line = windows[a, w]
        inside = np.flatnonzero((line[:, 0] >= 0) & (s >= line[:, 3]) & (s <= line[:, 2]))
        inside = inside[np.lexsort((ids[b[inside]], -s[inside], a[inside]))]
        first = np.r_[True, a[inside][1:] != a[inside][:-1]][: len(inside)]
        place = np.arange(len(inside)) - np.maximum.accumulate(np.where(first, np.arange(len(inside)), 0))
        inside = inside[place < wanted]
        out.append((anchors[a[inside]], windows[a[inside], w, 0].astype(np.int32), ids[b[inside]], s[inside]))
    return [np.concatenate(c) for c in zip(*out)]


def _wide(x, q):
    """Both as matrices of the same number of dimensions, of doubles if these keep all sums exact."""
    import numpy as np

    dims = max(x.shape[1], q.shape[1], 1)
    x, q = (np.pad(v.astype(np.float64), ((0, 0), (0, dims - v.shape[1]))) for v in (x, q))
    most = np.sqrt((x * x).sum(1).max(initial=0)) * np.sqrt((q * q).sum(1).max(initial=0))
    return (x, q) if most < EXACT else (x.astype(np.int64), q.astype(np.int64))


def threshold_join(q, x, least):
    """Positions in ``q`` and ``x`` and the inner products of all pairs that reach the threshold of their q."""
    import numpy as np

    def norms(v):
        sums = np.cumsum(np.square(v, dtype=np.float64), axis=1)
        return np.sqrt(np.column_stack([np.zeros(len(v)), sums[:, [c - 1 for c in cuts[1:]]]])) * (1 + 1e-9)

    empty = np.zeros(0, np.int64)
    if not len(q) or not len(x):
        return empty, empty, empty
    weight = np.argsort(-np.square(x, dtype=np.float64).sum(axis=0), kind="stable")
    x, q = x[:, weight], q[:, weight]
    cuts = [*range(0, x.shape[1], STEP), x.shape[1]]
    x_norm, q_norm, bar = norms(x), norms(q), least - 1.0
    # The index: dimensions before cuts[left_out] are covered by the norm bound and stay out of it.
    covered = x_norm * q_norm.max(axis=0) < bar.min()
    left_out = np.maximum(covered.sum(axis=1) - 1, 0)
    found = []
    for k in np.unique(left_out[left_out < len(cuts) - 1]):
        rows = np.flatnonzero(left_out == k)
        partial = np.zeros((len(rows), len(q)), x.dtype)
        for at in range(len(cuts) - 2, k - 1, -1):
            partial += x[rows, cuts[at] : cuts[at + 1]] @ q[:, cuts[at] : cuts[at + 1]].T
            alive = partial + x_norm[rows, at, None] * q_norm[:, at] >= bar
            some = alive.any(axis=1)
            if 2 * some.sum() < len(rows) or at == k:
                rows, partial, alive = rows[some], partial[some], alive[some]
        b, a = np.nonzero(alive)
        score = partial[b, a]
        if cuts[k]:
            for start in range(0, len(b), 1 << 16):
                part = slice(start, start + (1 << 16))
                score[part] += np.einsum("ij,ij->i", x[rows[b[part]], : cuts[k]], q[a[part], : cuts[k]])
        reached = score >= least[a]
        found.append((a[reached], rows[b[reached]], score[reached].astype(np.int64)))
    return tuple(np.concatenate(c) for c in zip(*found)) if found else (empty, empty, empty)


def query(spark: SparkSession, d: str) -> DataFrame:
    return mine_negatives(table(prepare(spark), d, "embeddings"), relabelled=True)


QUERIES = {"op12_negative_mining": query}
ORACLES = {
    "op12_negative_mining": """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e
           FROM embeddings
           WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id, CAST(list_dot_product(a.e, b.e) AS BIGINT) AS score
      FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same
  AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) <= 10"""
}
