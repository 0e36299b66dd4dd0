"""Removal of long repeated byte strings by bucket-pointer refinement.

A suffix matters here only by its first LENGTH bytes, and only suffixes near an anchor are looked at: an
anchor is a position whose GRAM-byte string has the smallest hash of some window of LENGTH bytes, so
equal windows have an anchor at the same place inside, wherever they stand. Initial buckets hold the
anchors with the same GRAM bytes; a bucket of one is dropped at once, which leaves little of a corpus.
Anchors whose whole surroundings are equal settle each other. For the others the windows around the
anchor are refined: those that begin within 17 bytes of one another hold the same core of 384 bytes.
A bucket of cores that agree in their first k bytes is sorted on the bucket identifiers at later offsets
(128 bytes on), each level reusing the identifiers of the one before, and a bucket of windows of one core
on those at their two ends, until 400 bytes are told apart; what is left alone in a bucket drops out at
every level.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import materialize
from .common import documents, row_key, texts

LENGTH, GRAM = 400, 64
REACH = LENGTH - GRAM  # bytes on either side of an anchor's gram that a window around it can hold
WINDOWS = REACH + 1
CORE = 6 * GRAM
BAND = LENGTH - CORE + 1  # windows in a row that all hold the same CORE bytes
CHUNK_BYTES = 1 << 19
TASK_CONTEXTS, TASK_WINDOWS = 1500, 300_000  # surroundings, and windows in them, that are refined in one go
BUCKET_CONTEXTS = 30_000  # a larger bucket is refined by Spark, window by window
FACTOR = 0x9E3779B97F4A7C15  # odd, so it can be divided by modulo 2**64
INVERSE = pow(FACTOR, -1, 1 << 64)
CODES = np.random.default_rng(GRAM).integers(1, 1 << 63, 256, np.int64).astype(np.uint64)
MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def remove_repeats(docs: DataFrame, bucket_contexts: int = BUCKET_CONTEXTS) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for each document.

    Every byte covered by a LENGTH-byte string that also starts anywhere else, in the same or another
    document, is removed; strings are judged on the input. Null and short texts lose nothing unless
    they are long enough to repeat; rows given twice repeat each other and lose all of LENGTH bytes or
    more. Other columns are ignored; an empty table gives an empty result.
    """
    packed = texts(docs).select("doc_id", *row_key(F.col("doc_id"), F.col("text")), "text")
    anchors = materialize(packed.select("key_id", "key_text", "text").mapInArrow(_anchors, ANCHORS))
    buckets = anchors.groupBy("gram").agg(F.count("*").alias("n"), F.min("around").alias("a"), F.max("around").alias("b"))
    buckets = buckets.where("n > 1").select("gram", (F.col("a") != F.col("b")).alias("mixed"))
    shared = materialize(anchors.join(buckets, "gram"))
    classes = shared.where("mixed").groupBy("gram", "around").agg(
        (F.count("*") > 1).alias("settled"), F.min(F.struct("key_id", "key_text", "at", "size")).alias("one")
    )
    sizes = classes.groupBy("gram").agg((F.count("*") > bucket_contexts).alias("large"))
    classes = materialize(classes.join(sizes, "gram").select("gram", "around", "settled", "large", "one.*"))
    alike = shared.where("not mixed").drop("mixed").unionByName(
        shared.where("mixed").drop("mixed").join(classes.where("settled").select("gram", "around"), ["gram", "around"])
    )
    whole = alike.select(
        "key_id", "key_text", F.greatest(F.lit(0), F.col("at") - REACH).alias("start"),
        F.least("size", F.col("at") + LENGTH).alias("end"),
    )
    spans = whole.unionByName(_refined(packed, classes))
    per_text = spans.groupBy("key_id", "key_text").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    cut = _zipped(packed).join(materialize(per_text), ["key_id", "key_text"], "left")
    return cut.select("doc_id", "zipped", "spans").mapInArrow(_cut, CUT)


# ------------------------------------------------------------------ hashes of substrings


class Hashes:
    """Polynomial hashes modulo 2**64 of any substring of ``data``; equal bytes, equal hash, wherever they stand."""

    def __init__(self, data):
        powers = np.full(len(data) + 1, FACTOR, np.uint64)
        powers[0] = 1
        np.cumprod(powers, out=powers)
        self.inverse = np.full(len(data) + 1, INVERSE, np.uint64)
        self.inverse[0] = 1
        np.cumprod(self.inverse, out=self.inverse)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(CODES[data] * powers[:-1], out=self.sums[1:])

    def of(self, start, end):
        return _mixed((self.sums[end] - self.sums[start]) * self.inverse[start])

    def grams(self):
        return _mixed((self.sums[GRAM:] - self.sums[:-GRAM]) * self.inverse[:-GRAM])


def _mixed(h):
    h = (h ^ (h >> np.uint64(30))) * MIX[0]
    h = (h ^ (h >> np.uint64(27))) * MIX[1]
    return h ^ (h >> np.uint64(31))


def _named(left, right):
    """The identifier of a bucket told by those of its two parts."""
    return _mixed(left * MIX[0] + _mixed(right + MIX[1]))


def _sliding(values, width, pick, fill):
    """``pick`` over every ``width`` values in a row, by running values from both ends of blocks."""
    n = len(values)
    padded = np.full(-(-n // width) * width, fill, values.dtype)
    padded[:n] = values
    rows = padded.reshape(-1, width)
    ahead = pick.accumulate(rows, axis=1).reshape(-1)
    back = pick.accumulate(rows[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return pick(back[: n - width + 1], ahead[width - 1 : n])


# ------------------------------------------------------------------ anchors

ANCHORS = "gram long, around long, key_id long, key_text long, at int, size int"


def _anchors(batches):
    """The anchors of each text, with hashes of their gram and of all that windows around them can hold."""
    import pyarrow as pa

    for batch in batches:
        keys = [batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1)]
        bodies = [t.encode("utf-8", "surrogatepass") for t in batch.column(2).to_pylist()]
        rows = [k for k, b in enumerate(bodies) if len(b) >= LENGTH]
        while rows:
            some, size = [], 0
            while rows and (not some or size + len(bodies[rows[0]]) <= CHUNK_BYTES):
                some.append(rows.pop(0))
                size += len(bodies[some[-1]])
            sizes = np.array([len(bodies[k]) for k in some])
            ends = np.cumsum(sizes)
            data = np.frombuffer(b"".join(bodies[k] for k in some), np.uint8)
            hashes = Hashes(data)
            grams = np.minimum(hashes.grams(), np.uint64(2**64 - 2))
            inside = np.ones(len(data), bool)
            for back in (GRAM, LENGTH):
                inside[:] = True
                inside[(ends[:-1, None] - np.arange(1, back)).reshape(-1)] = False
                if back == GRAM:
                    grams[~inside[: len(grams)]] = 2**64 - 1
            least = _sliding(grams, WINDOWS, np.minimum, np.uint64(2**64 - 1))
            least[~inside[: len(least)]] = 0  # windows that would reach into the next text
            spread = np.concatenate([np.zeros(REACH, np.uint64), least, np.zeros(REACH, np.uint64)])
            at = np.flatnonzero(_sliding(spread, WINDOWS, np.maximum, np.uint64(0)) == grams)
            owner = np.searchsorted(ends, at, "right")
            first, last = (ends - sizes)[owner], ends[owner]
            low, high = np.maximum(first, at - REACH), np.minimum(last, at + LENGTH)
            around = _named(hashes.of(low, high), ((at - low) << 16 | (high - at)).astype(np.uint64))
            doc = np.array(some)[owner]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(grams[at].view(np.int64)), pa.array(around.view(np.int64)), pa.array(keys[0][doc]),
                    pa.array(keys[1][doc]), pa.array((at - first).astype(np.int32)), pa.array(sizes[owner].astype(np.int32)),
                ],
                names=["gram", "around", "key_id", "key_text", "at", "size"],
            )


# ------------------------------------------------------------------ refinement

CONTEXTS = "gram long, settled boolean, large boolean, key_id long, key_text long, at int, left int, body binary"


def _refined(packed: DataFrame, classes: DataFrame) -> DataFrame:
    """key_id, key_text, start, end of the repeated windows around anchors that are one of a kind."""
    wanted = classes.groupBy("key_id", "key_text").agg(F.collect_list(F.struct("gram", "settled", "large", "at")).alias("wanted"))
    # Rows equal in key are equal in all; one of them stands for all here.
    texts_of = _zipped(packed).join(wanted, ["key_id", "key_text"])
    contexts = texts_of.select("key_id", "key_text", "zipped", "wanted").mapInArrow(_surroundings, CONTEXTS)
    small = classes.where("not large").limit(1).count()
    large = classes.where("large").limit(1).count()
    parts = []
    if large:
        contexts = materialize(contexts)
        parts.append(_windows_counted(contexts.where("large")))
    if small or not large:
        dealt = contexts.where("not large").repartition("gram").sortWithinPartitions("gram")
        parts.append(dealt.mapInArrow(_refine_buckets, "key_id long, key_text long, start int, end int"))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _surroundings(batches):
    import pyarrow as pa
    import zstandard

    for batch in batches:
        rows: list = []
        for key_id, key_text, zipped, wanted in zip(*(c.to_pylist() for c in batch.columns)):
            body = zstandard.decompress(zipped)
            for w in wanted:
                low = max(0, w["at"] - REACH)
                rows.append((w["gram"], w["settled"], w["large"], key_id, key_text, w["at"], w["at"] - low, body[low : w["at"] + LENGTH]))
        columns = list(zip(*rows)) if rows else [[]] * 8
        kinds = (pa.int64(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=[x.split()[0] for x in CONTEXTS.split(", ")])


def _refine_buckets(batches):
    """Buckets one after the other, some at a time; a bucket is never split."""
    import pyarrow as pa

    def out(rows):
        gram, settled, _, key_id, key_text, at, left, body = zip(*rows)
        spans = refine(np.unique(gram, return_inverse=True)[1], np.array(settled), np.array(at), np.array(left), body)
        rows.clear()
        row, start, end = spans
        return pa.RecordBatch.from_arrays(
            [pa.array(np.array(key_id, np.int64)[row]), pa.array(np.array(key_text, np.int64)[row]), pa.array(start.astype(np.int32)), pa.array(end.astype(np.int32))],
            names=["key_id", "key_text", "start", "end"],
        )

    held: list = []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if len(held) >= TASK_CONTEXTS and row[0] != held[-1][0]:
                yield out(held)
            held.append(row)
    if held:
        yield out(held)


def refine(bucket, settled, at, left, bodies):
    """(row, start, end) of the maximal runs of repeated windows in rows that are not settled."""
    sizes = np.array([len(b) for b in bodies])
    begin = np.cumsum(sizes) - sizes
    sums, inverse = _sums_from(bodies, sizes, int(sizes.max()))

    def gram(row, step):
        here = begin[row] + step
        return _mixed((sums[here + GRAM] - sums[here]) * inverse[step])

    def two(row, step):
        return _named(gram(row, step), gram(row, step + GRAM))

    # Windows are compared only with those that lie alike around the same gram. Those at distances of one band from
    # it all hold the band's core, so cores are refined first, some bands at a time, and windows only where a core
    # is not alone.
    found = []
    nearest, farthest = np.maximum(0, left + LENGTH - sizes), np.minimum(left, REACH)
    wide = max(1, TASK_WINDOWS // (BAND * len(sizes)))
    for low in range(0, -(-WINDOWS // BAND), wide):
        first = np.maximum(low, nearest // BAND)
        count = np.where(nearest <= farthest, np.maximum(0, np.minimum(low + wide - 1, farthest // BAND) - first + 1), 0)
        row = np.repeat(np.arange(len(sizes)), count)
        band = np.arange(len(row)) - np.repeat(np.cumsum(count) - count - first, count)
        name = bucket[row].astype(np.uint64) << np.uint64(16) | band.astype(np.uint64)
        for later in range(0, CORE, 2 * GRAM):  # each level from the buckets before it and those so much later
            name = _named(name, two(row, left[row] - BAND * band + later))
            order, same = _alone(name)
            order = order[same]
            row, band, name = row[order], band[order], name[order]
        # A window is the core and its own two ends.
        lower, upper = np.maximum(nearest[row], BAND * band), np.minimum(farthest[row], BAND * band + BAND - 1)
        count = upper - lower + 1
        pick = np.repeat(np.arange(len(row)), count)
        distance = np.arange(len(pick)) - np.repeat(np.cumsum(count) - count - lower, count)
        row, name = row[pick], name[pick]
        step = left[row] - distance
        ends = _named(gram(row, step), gram(row, step + REACH))
        order, same = _alone(_named(_named(name, ends), distance.astype(np.uint64)))
        order = order[same]
        row, step = row[order], step[order]
        open_ = ~settled[row]
        found.append((row[open_], step[open_]))
    row, step = (np.concatenate([f[k] for f in found]) for k in (0, 1))
    order = np.lexsort((step, row))
    row, step = row[order], step[order]
    if not len(row):
        return row, step, step
    new = np.r_[True, (row[1:] != row[:-1]) | (step[1:] != step[:-1] + 1)]
    final = np.r_[new[1:], True]
    start = (at - left)[row]
    return row[new], (start + step)[new], (start + step)[final] + LENGTH


def _sums_from(bodies, sizes, longest):
    """Running sums over all bodies, each with powers that begin anew, and the inverse powers."""
    powers, inverse = (np.cumprod(np.r_[np.uint64(1), np.full(longest, x, np.uint64)]) for x in (np.uint64(FACTOR), np.uint64(INVERSE)))
    sums = np.zeros(int(sizes.sum()) + 1, np.uint64)
    at = 0
    for k in range(0, len(bodies), 512):
        data = np.frombuffer(b"".join(bodies[k : k + 512]), np.uint8)
        inside = np.arange(len(data)) - np.repeat(np.cumsum(sizes[k : k + 512]) - sizes[k : k + 512], sizes[k : k + 512])
        np.cumsum(CODES[data] * powers[inside], out=sums[at + 1 : at + 1 + len(data)])
        sums[at + 1 : at + 1 + len(data)] += sums[at]
        at += len(data)
    return sums, inverse


def _alone(names):
    """A sorted order of ``names`` and which of them, in that order, have an equal one."""
    order = np.argsort(names)
    equal = names[order][1:] == names[order][:-1]
    same = np.zeros(len(names), bool)
    same[1:] |= equal
    same[:-1] |= equal
    return order, same


def _windows_counted(contexts: DataFrame) -> DataFrame:
    """The same for buckets too large for a task: one row for each window, counted by Spark."""

    def windows(batches):
        import pyarrow as pa

        names = ["name", "place", "settled", "key_id", "key_text", "start"]
        for batch in batches:
            for gram, settled, _, key_id, key_text, at, left, body in zip(*(c.to_pylist() for c in batch.columns)):
                hashes = Hashes(np.frombuffer(body, np.uint8))
                step = np.arange(len(body) - LENGTH + 1)
                name = _named(hashes.of(step, step + LENGTH), np.uint64(gram % (1 << 64)) + (left - step).astype(np.uint64))
                n = len(step)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(name.view(np.int64)), pa.array((left - step).astype(np.int32)), pa.array(np.full(n, settled)), pa.array(np.full(n, key_id, np.int64)), pa.array(np.full(n, key_text, np.int64)), pa.array((at - left + step).astype(np.int32))],
                    names=names,
                )

    rows = contexts.mapInArrow(windows, "name long, place int, settled boolean, key_id long, key_text long, start int")
    twice = rows.groupBy("name", "place").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    found = rows.where("not settled").join(twice, ["name", "place"])
    return found.select("key_id", "key_text", "start", (F.col("start") + LENGTH).alias("end"))


# ------------------------------------------------------------------ texts

CUT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _zipped(packed: DataFrame) -> DataFrame:
    """Texts are shuffled compressed."""

    def zipped(batches):
        import pyarrow as pa
        import zstandard

        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            bodies = [press.compress(t.encode("utf-8", "surrogatepass")) for t in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(bodies, pa.binary())], names=["doc_id", "key_id", "key_text", "zipped"])

    return packed.mapInArrow(zipped, "doc_id long, key_id long, key_text long, zipped binary")


def _cut(batches):
    import pyarrow as pa
    import zstandard

    for batch in batches:
        rows: list = []
        for zipped, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            body = zstandard.decompress(zipped)
            merged: list = []
            for start, end in sorted((s["start"], s["end"]) for s in spans or ()):
                if merged and start <= merged[-1][1]:
                    merged[-1][1] = max(end, merged[-1][1])
                else:
                    merged.append([start, end])
            edges = [0, *(x for span in merged for x in span), len(body)]
            kept = b"".join(body[a:b] for a, b in zip(edges[::2], edges[1::2]))
            rows.append((len(body), len(body) - len(kept), len(merged), hashlib.sha256(kept).hexdigest()))
        columns = list(zip(*rows)) if rows else [[]] * 4
        kinds = [pa.int64()] * 3 + [pa.string()]
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))], names=[x.split()[0] for x in CUT.split(", ")])


def query(spark: SparkSession, d: str) -> DataFrame:
    return remove_repeats(documents(spark, d))


QUERIES = {"op10_bucket_refinement": query}
ORACLES: dict[str, str] = {}
