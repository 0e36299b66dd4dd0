"""SimHash near-duplicates with vantage-point trees.

Every text gets a 64-bit fingerprint of its word shingles. Distinct fingerprints are dealt to shards
by the upper levels of a vantage-point tree grown from a bounded sample. A node with vantage point v
and radius m sends fingerprints with d(v, x) <= m + 2 to the inside and those with d(v, x) > m to the
outside: by the triangle inequality two fingerprints within distance 2 meet on at least one side, so
the shards overlap at the boundaries and no pair is lost. Each shard goes on the same way down to
small leaves that are compared directly, and gives back one link for each fingerprint it has joined
to another. Links of all shards are merged by alternating star contraction.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..session import materialize
from .common import documents, free_names, row_key, texts

SHINGLE, SEED, RADIUS = 3, 42, 2
SAMPLE = 500_000  # fingerprints at most, about, from which the upper tree is grown
SHARD = 4_096  # fingerprints wanted in a shard
SHARD_SAMPLE = 32  # sampled fingerprints that a shard needs at least
LEAF = 384


def fingerprint(text: Column, shingle: int = SHINGLE) -> Column:
    """The SimHash of a text as a signed 64-bit number; a null text has no words and gives 0."""

    @F.pandas_udf(T.LongType())
    def simhash(values: pd.Series) -> pd.Series:
        import numpy as np

        return pd.Series(np.array([_simhash(v, shingle) for v in values], np.uint64).view(np.int64))

    return simhash(F.coalesce(text, F.lit("")))


def _simhash(text: str, shingle: int) -> int:
    import numpy as np
    from xxhash import xxh64_intdigest

    # bytes.lower and bytes.split know ASCII only: A-Z, and space with 0x09-0x0D.
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxh64_intdigest(joined, SEED)]
    else:
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths + 1) - 1
        starts = (ends - lengths)[: len(words) - shingle + 1].tolist()
        hashes = [xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, ends[shingle - 1 :].tolist())]
    bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return int(np.packbits(bits.sum(axis=0, dtype=np.int64) * 2 > len(hashes), bitorder="little").view("<u8")[0])


def near_duplicates(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hexadecimal digits) and component_id.

    Two documents are linked when their fingerprints differ in ``radius`` bits or fewer;
    component_id is the smallest doc_id that can be reached. A null or wordless text has fingerprint 0
    and is linked like any other. Null doc_ids never name a component (a component of nothing else has
    a null id). Repeated rows come back as often as they went in; an empty table gives an empty result.
    """
    marked = materialize(texts(docs).select("doc_id", fingerprint(F.col("text")).alias("fp")))
    named = components(marked, radius)
    return marked.join(named, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs``, with all their columns, but one only of each group of near duplicates.

    The row with the smallest (doc_id, hash of the text) stays; rows equal in both stay together, so
    exact copies of a row should have been removed before. A null doc_id counts as the smallest, a null
    or wordless text has fingerprint 0, and columns of any other name come back untouched. An empty
    table gives an empty result.
    """
    key = row_key(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")))
    marked = materialize(docs.select(*key, F.col("doc_id").cast("long").alias("doc_id"), fingerprint(F.col("text")).alias("fp")))
    named = links(marked.select("fp"), radius)
    grouped = marked.join(named, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    stay = grouped.groupBy("root").agg(F.min(F.struct("key_id", "key_text")).alias("stays")).select("stays.*")
    names = free_names(docs, "key_id", "key_text")
    return docs.withColumns(dict(zip(names, key))).join(stay.toDF(*names), names, "left_semi").drop(*names)


def components(marked: DataFrame, radius: int = RADIUS) -> DataFrame:
    """fp, component_id for each distinct fingerprint of ``marked`` (doc_id, fp)."""
    first = marked.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    rooted = materialize(
        first.join(links(marked.select("fp"), radius), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    )
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return rooted.join(smallest, "root").select("fp", "component_id")


def links(fingerprints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """fp, root for the fingerprints that have another one within ``radius``, themselves not their root."""
    distinct = materialize(fingerprints.distinct())
    tree, count = _upper_tree(distinct, radius)

    def route(frames):
        import numpy as np

        for frame in frames:
            x = frame["fp"].to_numpy().view(np.uint64)
            shards = list(_descend(tree, x))
            yield pd.DataFrame({"shard": np.concatenate([np.full(len(v), k, np.int32) for k, v in shards]) if shards else np.zeros(0, np.int32), "fp": np.concatenate([v for _, v in shards]).view(np.int64) if shards else np.zeros(0, np.int64)})

    def join(frame):
        import numpy as np

        x = np.unique(frame["fp"].to_numpy().view(np.uint64))
        roots = _joined(x, radius)
        moved = np.flatnonzero(roots != np.arange(len(x)))
        return pd.DataFrame({"a": x[moved].view(np.int64), "b": x[roots[moved]].view(np.int64)})

    dealt = distinct.mapInPandas(route, "shard int, fp long")
    found = dealt.groupBy("shard").applyInPandas(join, "a long, b long")
    return contract(found).select(F.col("a").alias("fp"), F.col("b").alias("root"))


def contract(edges: DataFrame) -> DataFrame:
    """Connected components by alternating large-star and small-star steps: a, b with b the smallest of
    a's component, for every a that is not itself the smallest. Each step is stored in the shared folder."""

    def oriented(df):
        return df.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()

    edges, before = materialize(oriented(edges)), None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = oriented(large)
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        edges = materialize(oriented(small))
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return edges
        before = now


def _upper_tree(distinct: DataFrame, radius: int) -> tuple[list, int]:
    """Nodes (vantage, radius, inside, outside) as nested tuples; a leaf is its shard number."""
    import numpy as np

    count = distinct.count()
    share = min(1.0, SAMPLE / max(1, count))
    near = distinct.where(F.pmod(F.xxhash64("fp"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
    sample = near.toPandas()["fp"].to_numpy().view(np.uint64) if count > SHARD else np.zeros(0, np.uint64)
    rng, shards = np.random.default_rng(SEED), [0]
    scale = count / max(1, len(sample))

    def grow(x):
        cut = _cut(x, radius, rng) if len(x) * scale > SHARD and len(x) >= 2 * SHARD_SAMPLE else None
        if cut is None:
            shards[0] += 1
            return shards[0] - 1
        v, m, d = cut
        return (int(v), int(m), grow(x[d <= m + radius]), grow(x[d > m]))

    return [grow(sample), radius], shards[0]


def _cut(x, radius, rng):
    """The vantage point and radius, of a few tried, that leave the fewest fingerprints in the larger side."""
    import numpy as np

    best = None
    for v in x[rng.integers(0, len(x), 8)]:
        d = np.bitwise_count(x ^ v)
        for m in {max(0, int(np.median(d)) - 1), int(np.median(d)), max(0, int(np.median(d)) - 2)}:
            inside, outside = int((d <= m + radius).sum()), int((d > m).sum())
            if max(inside, outside) <= 0.9 * len(x) and (best is None or inside + outside + abs(inside - outside) / 4 < best[0]):
                best = (inside + outside + abs(inside - outside) / 4, v, m, d)
    return best and best[1:]


def _descend(tree, x):
    """The fingerprints that each shard gets."""
    import numpy as np

    top, radius = tree
    todo = [(top, x)]
    while todo:
        node, some = todo.pop()
        if not len(some):
            continue
        if isinstance(node, int):
            yield node, some
            continue
        v, m, inside, outside = node
        d = np.bitwise_count(some ^ np.uint64(v))
        todo += [(inside, some[d <= m + radius]), (outside, some[d > m])]


def _joined(x, radius):
    """For each of the distinct fingerprints ``x`` the position of the first one it is connected with."""
    import numpy as np

    rng, label, todo = np.random.default_rng(SEED), np.arange(len(x)), [np.arange(len(x))]

    def merge(i, j):
        while True:
            a, b = label[i], label[j]
            open_ = a != b
            if not open_.any():
                return
            i, j, a, b = i[open_], j[open_], a[open_], b[open_]
            np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
            while True:
                up = label[label]
                if (up == label).all():
                    break
                label[:] = up

    held: list = []

    def settle():
        if held:
            i, j = (np.concatenate(k) for k in zip(*held))
            held.clear()
            merge(i, j)

    waiting = 0
    while todo:
        at = todo.pop()
        cut = _cut(x[at], radius, rng) if len(at) > LEAF else None
        if cut is not None:
            _, m, d = cut
            todo += [at[d <= m + radius], at[d > m]]
            continue
        for k in range(0, len(at), LEAF):  # a leaf, or points that no vantage point tells apart
            rows = at[k : k + LEAF]
            i, j = np.nonzero(np.bitwise_count(x[rows][:, None] ^ x[at[k:]][None, :]) <= radius)
            i, j = rows[i], at[k:][j]
            off = i < j
            if off.any():
                held.append((i[off], j[off]))
                waiting += int(off.sum())
            if waiting > 2_000_000:
                settle()
                waiting = 0
    settle()
    return label


def query(spark: SparkSession, d: str) -> DataFrame:
    return near_duplicates(documents(spark, d))


QUERIES = {"op9_simhash_vp": query}
ORACLES: dict[str, str] = {}
