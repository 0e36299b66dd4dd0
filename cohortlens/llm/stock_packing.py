"""Packing of documents into training sequences as a cutting-stock problem.

The part of a document beyond its full sequences is an order for that many tokens. Orders fall into
classes of UNIT tokens; the histogram of the classes, which is all the driver sees, goes into a linear
program over patterns (how many orders of each class share a sequence). Columns are priced by a
knapsack dynamic program over the dual values until none improves; patterns are rounded down and what
is left over gets patterns of its own. Documents are ranked within their class, and rank alone says
which instance of which pattern a document belongs to. A fixed share of the documents, chosen by hash,
is not ordered whole but cut up to fill what the patterns leave free; the rest of them fills sequences
of its own, the last of which is cut into powers of two.
"""

from __future__ import annotations

import os
import zlib
from array import array
from unicodedata import is_normalized

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..session import materialize
from .common import documents, per_worker, row_key, running_start, task_id, texts
from .piece_merge import chunks, ragged

LENGTH = 4096
UNIT = 32  # tokens in a class of orders
SHARES = 64  # parts by hash, the first of which serve as filling
END_ID = 2
SPACED = np.arange(256, dtype=np.uint8)
SPACED[[9, 10, 13]] = 0x20
STOPS, LETTERS = (np.isin(np.arange(256), list(some)) for some in (b".,", b"abcdefghijklmnopqrstuvwxyz"))
HELD_WORDS = 100_000  # encoded words that a worker keeps besides those of the last chunk


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Words:
    """Token ids of texts, found once for each distinct run between ASCII spaces: the tokenizer drops
    white space and merges nothing across it, nor between a letter and a stop. A-Z are folded before, as
    it would do itself, unless the text might spell a special token."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # The tokenizer's byte alphabet: printable bytes stand for themselves, the others for 256 and on.
        shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
        hidden = iter(range(256, 512))
        self.alphabet = {b: b if b in shown else next(hidden) for b in range(256)}
        self.often, self.last = {}, {}  # what two chunks in a row had, and what the last one had

    def spelled(self, distinct: list[str]) -> list[bytes]:
        often, last, here = self.often, self.last, {}
        new, merge = [], self.tokenizer.model.tokenize
        for w in distinct:
            known = often.get(w)
            if known is None:
                known = last.get(w)
                if known is not None and len(often) < HELD_WORDS:
                    often[w] = known
            if known is None:
                plain = w.lstrip(" ")
                if plain.isalpha() and plain.lower() == plain and is_normalized("NFC", plain):
                    # A word of letters is cut no further: only its merges are left to do.
                    known = array("I", [t.id for t in merge(plain.encode().decode("latin-1").translate(self.alphabet))]).tobytes()
                else:
                    new.append(w)
            here[w] = known
        for k in range(0, len(new), 10_000):
            found = self.tokenizer.encode_batch_fast(new[k : k + 10_000], add_special_tokens=False)
            here.update((w, array("I", e.ids).tobytes()) for w, e in zip(new[k : k + 10_000], found))
        self.last = here
        return list(here.values())

    def ids(self, some: list[str]):
        """Flat ids of all texts, each followed by the end id, and the number of ids of each text."""
        import pyarrow as pa

        bodies = [t.encode("utf-8", "replace") for t in some]
        bodies = [b" " + (b if b"<|" in b else b.lower()) for b in bodies]
        ends = np.cumsum([len(b) for b in bodies])
        data = np.frombuffer(b"".join(bodies), np.uint8)
        data = SPACED[data]
        starts = np.zeros(len(data) + 1, bool)
        starts[1:-1] = (data[1:] == 0x20) & (data[:-1] != 0x20) | STOPS[data[1:]] & LETTERS[data[:-1]]
        starts[0] = starts[-1] = True
        starts[ends] = True
        offset = np.flatnonzero(starts)
        words = pa.StringArray.from_buffers(len(offset) - 1, pa.py_buffer(offset.astype(np.int32)), pa.py_buffer(data)).dictionary_encode()
        spelled = self.spelled(words.dictionary.to_pylist())
        flat = np.frombuffer(b"".join(spelled), np.uint32)
        count = np.fromiter(map(len, spelled), np.int64, len(spelled)) // 4
        index = words.indices.to_numpy(zero_copy_only=False)
        own = ragged(flat, (np.cumsum(count) - count)[index], count[index])
        reached = np.r_[0, np.cumsum(count[index])][np.searchsorted(offset, ends)]
        return np.insert(own, reached, END_ID), np.diff(np.r_[0, reached]) + 1


def pack(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset for each piece of a document.

    A document is its token ids and the end id; a null or empty text is the end id alone. Every id lies
    in one piece, every sequence is filled from 0 without gaps; all but the ones cut to a power of two
    hold LENGTH ids, unless the filling does not suffice. Repeated rows are packed as often as they
    come, a null doc_id is carried along, an empty table gives no pieces, other columns are ignored.
    """
    path = path or default_tokenizer()
    key = row_key(F.col("doc_id"), F.col("text"))
    shared = texts(docs).withColumn("share", F.pmod(F.xxhash64(*key), F.lit(SHARES)).cast("int"))
    lengths = materialize(shared.select("doc_id", "share", "text").mapInArrow(_lengths(path), LENGTHS))
    filling, patterns = _plan(lengths)
    placed, sequences = _assign(lengths.where(F.col("share") >= filling), patterns)
    window = Window.partitionBy("sequence_id").orderBy(F.col("class").desc(), "slot")
    before = F.sum("rest").over(window.rowsBetween(Window.unboundedPreceding, -1))
    placed = materialize(placed.withColumn("offset", F.coalesce(before, F.lit(0))))
    ordered = placed.select(
        "doc_id", (F.col("n") - F.col("rest")).alias("start"), F.col("rest").alias("length"),
        F.col("rest_crc").alias("ids_crc32"), F.col("n").alias("doc_tokens"), "sequence_id", "offset",
    )
    full = lengths.where((F.col("share") >= filling) & (F.size("crcs") > 0))
    full = running_start(full.select("doc_id", "n", "crcs", F.size("crcs").cast("long").alias("fulls")), "fulls", "number")
    fulls = full.select("doc_id", "n", "number", F.posexplode("crcs").alias("pos", "crc")).select(
        "doc_id", (F.col("pos") * F.lit(LENGTH)).cast("long").alias("start"), F.lit(LENGTH).cast("long").alias("length"),
        F.col("crc").alias("ids_crc32"), F.col("n").alias("doc_tokens"),
        (F.col("number") + F.col("pos") + F.lit(sequences)).alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
    )
    sequences += full.agg(F.coalesce(F.sum("fulls"), F.lit(0))).first()[0]
    used = placed.groupBy("sequence_id").agg(F.sum("rest").alias("used")).where(F.col("used") < LENGTH)
    gaps = running_start(used.withColumn("gap", F.lit(LENGTH) - F.col("used")), "gap", "gap_start")
    filled = _fill(shared.where(F.col("share") < filling).select("doc_id", "text"), gaps, path, sequences)
    return ordered.unionByName(fulls).unionByName(filled)


LENGTHS = "doc_id long, share int, n long, crcs array<long>, rest long, rest_crc long, class int"


def _lengths(path):
    def tokenize(batches):
        import pyarrow as pa

        words = per_worker(f"words:{path}", lambda: Words(path))
        for batch in batches:
            rows: list = []
            for chunk in chunks(batch.column(2).to_pylist()):
                flat, counts = words.ids(chunk)
                at = 0
                for n in counts.tolist():
                    rest = n % LENGTH
                    crcs = [zlib.crc32(flat[k : k + LENGTH].tobytes()) for k in range(at, at + n - rest, LENGTH)]
                    rows.append((n, crcs, rest, zlib.crc32(flat[at + n - rest : at + n].tobytes()), -(-rest // UNIT)))
                    at += n
            columns = list(zip(*rows)) if rows else [[]] * 5
            kinds = (pa.int64(), pa.list_(pa.int64()), pa.int64(), pa.int64(), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                names=["doc_id", "share", "n", "crcs", "rest", "rest_crc", "class"],
            )

    return tokenize


def _plan(lengths: DataFrame) -> tuple[int, list]:
    """How many shares are filling, and the patterns for the orders of the others. The histogram has at
    most SHARES x (LENGTH / UNIT) rows, however large the corpus."""
    rows = lengths.groupBy("share", "class").agg(F.count("*"), F.sum("rest"), F.sum("n")).collect()
    units = LENGTH // UNIT
    count, rest, whole = np.zeros((SHARES, units + 1), np.int64), np.zeros(SHARES, np.int64), np.zeros(SHARES, np.int64)
    for share, kind, number, tokens, all_tokens in rows:
        count[share, kind] += number
        rest[share] += tokens
        whole[share] += all_tokens
    filling = 1
    while filling < SHARES:
        patterns = cutting_stock(count[filling:].sum(axis=0), units)
        free = sum(number for number, _ in patterns) * LENGTH - int(rest[filling:].sum())
        if whole[:filling].sum() >= free:
            return filling, patterns
        filling = min(SHARES, max(filling + 1, int(SHARES * free / max(1, whole.sum()))))
    return SHARES, []


def cutting_stock(demand, units: int) -> list[tuple[int, dict[int, int]]]:
    """(instances, {class: orders}) of patterns that cover ``demand[class]``, a class taking as many units.

    The linear program's patterns are rounded down; the orders left over, at most one pattern's worth for
    each class, are placed largest first into sequences of their own.
    """
    kinds = [k for k in range(1, len(demand)) if demand[k]]
    if not kinds:
        return []
    size, want = np.array(kinds), np.array([demand[k] for k in kinds], float)
    basis = np.diag(units // size).astype(float)
    for _ in range(40 * len(kinds)):
        price = np.linalg.solve(basis.T, np.ones(len(kinds)))
        column, value = _knapsack(price, size, units)
        if value <= 1 + 1e-6:
            break
        amount, change = np.linalg.solve(basis, want), np.linalg.solve(basis, column)
        ratio = np.where(change > 1e-9, np.maximum(amount, 0) / np.where(change > 1e-9, change, 1), np.inf)
        basis[:, int(np.argmin(ratio))] = column
    amount = np.floor(np.maximum(np.linalg.solve(basis, want), 0) + 1e-9).astype(np.int64)
    left = {k: int(demand[k]) for k in kinds}
    patterns = []
    for j, number in enumerate(amount):
        orders = {k: int(a) for k, a in zip(kinds, basis[:, j]) if a > 0}
        number = min([int(number), *(left[k] // a for k, a in orders.items())])
        if number > 0:
            patterns.append((number, orders))
            for k, a in orders.items():
                left[k] -= number * a
    while any(left.values()):
        room, orders = units, {}
        for k in sorted(left, reverse=True):
            a = min(left[k], room // k)
            if a:
                orders[k] = a
                room -= a * k
        number = min(left[k] // a for k, a in orders.items())
        patterns.append((number, orders))
        for k, a in orders.items():
            left[k] -= number * a
    return patterns


def _knapsack(price, size, units):
    """The pattern of the greatest value at these prices, by dynamic programming over the units used."""
    best, taken = np.zeros(units + 1), np.full(units + 1, -1)
    for room in range(1, units + 1):
        fits = np.searchsorted(size, room, "right")
        best[room], taken[room] = best[room - 1], -1
        if fits:
            values = best[room - size[:fits]] + price[:fits]
            k = int(np.argmax(values))
            if values[k] > best[room] + 1e-12:
                best[room], taken[room] = values[k], k
    column, room = np.zeros(len(size)), units
    while room > 0:
        if taken[room] < 0:
            room -= 1
        else:
            column[taken[room]] += 1
            room -= int(size[taken[room]])
    return column, best[units]


def _assign(lengths: DataFrame, patterns: list) -> tuple[DataFrame, int]:
    """Adds sequence_id and slot by the document's rank within its class; the number of sequences."""
    units = LENGTH // UNIT
    runs: dict = {k: [] for k in range(units + 1)}  # per class: first rank, orders in an instance, first sequence
    next_rank, sequences = [0] * (units + 1), 0
    for number, orders in patterns:
        for k, a in orders.items():
            runs[k].append((next_rank[k], a, sequences))
            next_rank[k] += number * a
        sequences += number
    table = {k: np.array(v, np.int64).reshape(-1, 3) for k, v in runs.items()}
    columns = ("doc_id", "n", "rest", "rest_crc", "class")

    def rank(batches):
        import pyarrow as pa

        part, seen = task_id(), np.zeros(units + 1, np.int64)
        for batch in batches:
            kind = batch.column(4).to_numpy(zero_copy_only=False)
            order = np.argsort(kind, kind="stable")
            number = np.bincount(kind, minlength=units + 1)
            local = np.empty(len(kind), np.int64)
            local[order] = np.arange(len(kind)) - np.repeat(np.cumsum(number) - number, number) + np.repeat(seen, number)
            seen += number
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(len(kind), part, np.int64)), pa.array(local)], names=[*columns, "part", "local_rank"]
            )

    def place(batches):
        import pyarrow as pa

        for batch in batches:
            kind = batch.column(4).to_numpy(zero_copy_only=False)
            ranks = batch.column(5).to_numpy(zero_copy_only=False)
            sequence, slot = np.zeros(len(kind), np.int64), np.zeros(len(kind), np.int64)
            for k in np.unique(kind):
                at = kind == k
                first, a, base = table[int(k)][np.searchsorted(table[int(k)][:, 0], ranks[at], "right") - 1].T
                sequence[at] = base + (ranks[at] - first) // a
                slot[at] = (ranks[at] - first) % a
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence), pa.array(slot)], names=[*columns, "sequence_id", "slot"])

    schema = "doc_id long, n long, rest long, rest_crc long, class int"
    ranked = materialize(
        lengths.where("rest > 0").select(*columns).mapInArrow(rank, schema + ", part long, local_rank long")
    )
    order = Window.partitionBy("class").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = ranked.groupBy("class", "part").agg(F.count("*").alias("number"))
    counts = counts.select("class", "part", F.coalesce(F.sum("number").over(order), F.lit(0)).alias("first"))
    ranks = ranked.join(counts, ["class", "part"]).select(*columns, (F.col("first") + F.col("local_rank")).alias("rank"))
    return ranks.mapInArrow(place, schema + ", sequence_id long, slot long"), sequences


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def _fill(docs: DataFrame, gaps: DataFrame, path: str, sequences: int) -> DataFrame:
    """Cuts documents, one after the other, to the gaps, one after the other, and to new sequences."""

    def tokenize(batches):
        import pyarrow as pa

        words = per_worker(f"words:{path}", lambda: Words(path))
        for batch in batches:
            ids: list = []
            for chunk in chunks(batch.column(1).to_pylist()):
                flat, counts = words.ids(chunk)
                ids += [part.tobytes() for part in np.split(flat, np.cumsum(counts)[:-1])]
            lengths = [len(x) // 4 for x in ids]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary()), pa.array(lengths, pa.int64())], names=["doc_id", "ids", "n"])

    filling = running_start(docs.mapInArrow(tokenize, "doc_id long, ids binary, n long"), "n", "at")
    free = gaps.agg(F.coalesce(F.sum("gap"), F.lit(0))).first()[0]
    total = filling.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]

    def blocks(first, length):
        return F.explode(F.sequence(F.expr(f"{first} div {LENGTH}"), F.expr(f"({first} + {length} - 1) div {LENGTH}"))).alias("block")

    left = filling.where(F.col("at") < free).select("at", "n", blocks("at", "n"))
    right = gaps.select("sequence_id", "used", "gap", "gap_start", blocks("gap_start", "gap"))
    low, high = F.greatest("at", "gap_start"), F.least(F.col("at") + F.col("n"), F.col("gap_start") + F.col("gap"))
    met = left.join(right, "block").where((low < high) & (F.col("block") == F.expr(f"greatest(at, gap_start) div {LENGTH}")))
    cuts = met.groupBy("at").agg(
        F.collect_list(F.struct((low - F.col("at")).alias("start"), (high - low).alias("length"), "sequence_id", (F.col("used") + low - F.col("gap_start")).alias("offset"))).alias("cuts")
    )

    def pieces(batches):
        import pyarrow as pa

        for batch in batches:
            rows: list = []
            for doc_id, ids, n, at, cuts in zip(*(c.to_pylist() for c in batch.columns)):
                found = [(c["start"], c["length"], c["sequence_id"], c["offset"]) for c in cuts or ()]
                found += _beyond(at, n, free, total, sequences)
                rows += [(doc_id, s, k, zlib.crc32(ids[4 * s : 4 * (s + k)]), n, q, o) for s, k, q, o in found]
            columns = list(zip(*rows)) if rows else [[]] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=[x.split()[0] for x in PIECES.split(", ")])

    return filling.join(cuts, "at", "left").select("doc_id", "ids", "n", "at", "cuts").mapInArrow(pieces, PIECES)


def _beyond(at: int, n: int, free: int, total: int, sequences: int) -> list[tuple]:
    """start, length, sequence and offset of what lies behind the gaps: sequences of LENGTH ids, and for
    the last ids of all one sequence for each binary digit of their number."""
    found, low = [], max(at, free)
    fulls = (total - free) // LENGTH if total > free else 0
    while low < min(at + n, free + fulls * LENGTH):
        number, offset = divmod(low - free, LENGTH)
        length = min(at + n - low, LENGTH - offset)
        found.append((low - at, length, sequences + number, offset))
        low += length
    edge, number = free + fulls * LENGTH, sequences + fulls
    for bit in reversed(range(LENGTH.bit_length())):
        if total > edge and (total - edge) & (1 << bit):
            high = edge + (1 << bit)
            a, b = max(low, edge), min(at + n, high)
            if a < b:
                found.append((a - at, b - a, number, a - edge))
            edge, number = high, number + 1
    return found


def query(spark: SparkSession, d: str) -> DataFrame:
    return pack(documents(spark, d))


QUERIES = {"op7_stock_packing": query}
ORACLES: dict[str, str] = {}
