"""Repair of conversations as shortest paths, found by auction.

The rows of a conversation and the four things the role grammar can have seen last (nothing, a system
row, a user row, an assistant row) span a lattice; keeping, changing, deleting and inserting rows are
its arcs, with whole-number costs. The auction algorithm finds shortest paths: a path grows from its
origin, its last node's price is raised to the best offer of an arc out of it, and the path is drawn
back when the price went up or extended when it did not. Prices never exceed distances to the goal, so
where they meet at the origin every arc of every shortest path is tight, and following tight arcs by
the least letter gives the least of the cheapest audits.

Long conversations are cut into blocks of a few rows. A block is a 4 x 4 matrix of costs between the
states at its two ends, and blocks of blocks again, each found by auction on a small lattice; prices at
the borders are then handed down the same tree, and the blocks traced one after the other.

Rows are range-partitioned by conversation and turn, so a conversation of any length spreads over the
partitions its rows need. Inside a partition a conversation is repaired whole. The first and the last one
of a partition may go on elsewhere: their parts give matrices, one row for each part, and prices and
traces are made from these. Only the hash of a repaired text has to read its parts in order; it streams.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import materialize
from ..sources import read_table
from .common import prepare, remembered, task_id

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
WHITE = " \t\n\x0b\x0c\r"
HEAD = 64  # characters of a text by which rows of one turn and role are ordered before the hash decides
NO_WAY = 1 << 60
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
NEXT = (USER, USER, ASSISTANT, USER)  # what has to follow a state, but for a system row at the start
TAIL = (0, 2 * INSERT, INSERT, 0)  # cost of the rows to insert at the end
BLOCK = 8  # rows in a block, and blocks in a block of the next level
FRAGMENT = 1 << 20  # characters of repaired text in a row of the stream that is hashed
SCHEMA = "conv_id long, turn long, role string, text string"
OUT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
PART_ROWS = "conv_id long, part long, at long, turn long, role string, text string, code string, key binary"


def _moves(code: str, state: int):
    """letter, cost and next state of what can be done with a row. The code is the role's initial, in
    capitals for a truncated row, ``x`` for one that has to go."""
    yield "D", DELETE, state
    if code == "x":
        return
    extra, role = (TRUNCATED if code.isupper() else 0), {"s": SYSTEM, "u": USER, "a": ASSISTANT}.get(code.lower())
    if role == NEXT[state] or (role == SYSTEM and state == NOTHING):
        yield "K", KEEP + extra, role
    yield "R", REROLE + extra, NEXT[state]


def _lattice(block) -> list:
    """Arcs (cost, to, letter) out of each node 4 * step + state. A block is a string of codes or a tuple of matrices."""
    arcs: list = [[] for _ in range(4 * len(block) + 4)]
    for k, step in enumerate(block):
        for state in range(4):
            node = arcs[4 * k + state]
            if isinstance(step, str):
                node += [(cost, 4 * k + 4 + to, letter) for letter, cost, to in _moves(step, state)]
                node.append((INSERT, 4 * k + NEXT[state], "I"))
            else:
                node += [(step[4 * state + to], 4 * k + 4 + to, "") for to in range(4) if step[4 * state + to] < NO_WAY]
    return arcs


class Auction:
    """Prices of a block's nodes: how far each origin is from the cheapest way out."""

    def __init__(self, block, origins, exits):
        # States from which no way out can be reached are left out, or prices there would rise for ever.
        most = max((s for s in range(4) if exits[s] < NO_WAY), default=-1)
        usable = {-1: (), NOTHING: (NOTHING,), SYSTEM: (NOTHING, SYSTEM)}.get(most, range(4))
        self.end, self.goal = 4 * len(block), 4 * len(block) + 4
        self.arcs = [[a for a in node if a[1] % 4 in usable] for node in _lattice(block)] + [[]]
        for state in usable:
            self.arcs[self.end + state] = [(exits[state], self.goal, "")] if exits[state] < NO_WAY else []
        self.price = [0] * (self.goal + 1)
        for origin in origins:
            if origin in usable:
                self._bid(origin)
            else:
                self.price[origin] = NO_WAY

    def _bid(self, origin):
        price, arcs, path = self.price, self.arcs, [origin]
        while path[-1] != self.goal:
            node = path[-1]
            best, to = min(((cost + price[to], to) for cost, to, _ in arcs[node]), default=(NO_WAY, -1))
            best = min(best, NO_WAY)
            if price[node] < best:
                price[node] = best
                if len(path) > 1:
                    path.pop()
            elif best == NO_WAY:
                if len(path) == 1:
                    return
                path.pop()
            else:
                path.append(to)

    def open(self, origins) -> set:
        """The nodes on tight ways from the origins to the goal."""
        seen, todo, back = set(), [o for o in origins if self.price[o] < NO_WAY], {}
        while todo:
            node = todo.pop()
            if node in seen:
                continue
            seen.add(node)
            for cost, to, _ in self.arcs[node]:
                if self.price[node] == cost + self.price[to]:
                    back.setdefault(to, []).append(node)
                    todo.append(to)
        found, todo = set(), [self.goal] if self.goal in seen else []
        while todo:
            node = todo.pop()
            if node not in found:
                found.add(node)
                todo += back.get(node, [])
        return found

    def trace(self, origin) -> tuple[str, int]:
        """The least audit among the cheapest ways from an origin, and the state in which it leaves the block."""
        open_, node, audit = self.open([origin]), origin, []
        while node < self.end:
            letter, node = min((letter, to) for cost, to, letter in self.arcs[node] if to in open_ and self.price[node] == cost + self.price[to])
            audit.append(letter)
        return "".join(audit), node - self.end


def matrix(block) -> tuple:
    """The cost from each state before a block to each state behind it, 16 numbers."""
    return remembered(_matrix, block)


def _matrix(block) -> tuple:
    if not block:
        return tuple(0 if k % 5 == 0 else NO_WAY for k in range(16))
    ways = [Auction(block, range(4), [0 if s == end else NO_WAY for s in range(4)]).price[:4] for end in range(4)]
    return tuple(ways[end][start] for start in range(4) for end in range(4))


def _borders(block: tuple, origins: tuple, exits: tuple) -> list:
    """Prices of the states behind each step of a block, NO_WAY where no cheapest way passes."""
    auction = Auction(block, origins, exits)
    open_ = auction.open(origins)
    return [tuple(auction.price[4 * k + s] if 4 * k + s in open_ else NO_WAY for s in range(4)) for k in range(1, len(block) + 1)]


def _traced(block: str, origin: int, exits: tuple) -> tuple[str, int]:
    return Auction(block, [origin], exits).trace(origin)


def level_up(steps: list) -> list:
    return [tuple(steps[k : k + BLOCK]) for k in range(0, len(steps), BLOCK)]


def whole(matrices: list) -> tuple:
    """The matrix of a sequence of matrices."""
    while len(matrices) > 1:
        matrices = [matrix(block) for block in level_up(matrices)]
    return matrices[0] if matrices else matrix(())


def exits_of(matrices: list, origins: tuple, exits: tuple) -> list:
    """For each of a sequence of matrices the prices behind it, on cheapest ways from the origins to the exits."""
    if not matrices:
        return []
    if len(matrices) <= BLOCK:
        low = min(exits)
        found = remembered(_borders, tuple(matrices), origins, tuple(e - low if e < NO_WAY else e for e in exits))
        return [tuple(p + low if p < NO_WAY else p for p in prices) for prices in found]
    blocks = level_up(matrices)
    found, before = [], None
    for block, behind in zip(blocks, exits_of([matrix(b) for b in blocks], origins, exits)):
        here = origins if before is None else tuple(s for s in range(4) if before[s] < NO_WAY)
        found += exits_of(list(block), here, behind)
        before = behind
    return found


class Codes:
    """The rows of a conversation, or of a part of one, as blocks of codes."""

    def __init__(self, codes: str):
        self.blocks = [codes[k : k + BLOCK] for k in range(0, len(codes), BLOCK)]
        self.matrices = [matrix(b) for b in self.blocks]

    def matrix(self) -> tuple:
        return whole(self.matrices)

    def traces(self, origins: tuple, exits: tuple) -> dict:
        """For each origin the state in which its least cheapest audit ends, and that audit."""
        behind, found = exits_of(self.matrices, origins, exits), {}
        for origin in origins:
            state, audit = origin, []
            for block, prices in zip(self.blocks, behind):
                low = min(prices)
                letters, state = remembered(_traced, block, state, tuple(p - low if p < NO_WAY else p for p in prices))
                audit.append(letters)
            found[origin] = state, "".join(audit)
        return found


def _repair_any(codes: str) -> tuple[int, str]:
    rows = Codes(codes)
    cost = min(c + t for c, t in zip(rows.matrix(), TAIL))
    state, audit = rows.traces((NOTHING,), TAIL)[NOTHING]
    return cost, audit + "I" * (TAIL[state] // INSERT)


def repair(codes: str) -> tuple[int, str]:
    """The least cost for rows of these codes, and the least audit of that cost."""
    return remembered(_repair_any, codes) if len(codes) <= 8 * BLOCK else _repair_any(codes)


def lines(audit: str, rows, state: int = NOTHING):
    """The repaired rows as ``role:text``, and the state after them; ``rows`` gives (role, text) one by one."""
    rows, names = iter(rows), {USER: "user", ASSISTANT: "assistant"}
    for letter in audit:
        role, text = next(rows) if letter != "I" else (None, "")
        if letter == "D":
            continue
        state = SYSTEM if letter == "K" and role[0] == "s" else NEXT[state]
        yield f"{role if letter == 'K' else names[state]}:{text}"


def _damaged(conversations: DataFrame) -> DataFrame:
    """The rows after damage, and one row without code for each that was dropped, so that no conversation is lost."""
    blank = F.lit(" ")
    turn = F.col("turn").cast("long")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(turn.cast("string"), blank))
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), turn.alias("turn"), F.coalesce("role", blank).alias("role"),
        F.coalesce("text", blank).alias("text"), F.pmod(F.crc32(key.cast("binary")), F.lit(20)).alias("kind"),
    )
    kind = F.col("kind")
    text = F.when(kind.isin(0, 1), F.lit("")).when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(kind == 0, F.lit("")).when(kind == 4, F.lit("user")).otherwise(F.col("role"))
    copies = F.explode(F.array_repeat(F.lit(0), F.when(kind == 3, 2).otherwise(1)))
    rows = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), kind, copies.alias("copy"))
    return rows.select("conv_id", "turn", "role", "text", _code(kind).alias("code"))


def _code(kind: Column) -> Column:
    """Null for a dropped row, ``x`` for a blank one, else the role's initial (``o`` for any other than s, u, a),
    as a capital where the text is truncated."""
    body = F.rtrim(F.col("text"), F.lit(WHITE))
    initial = F.substring("role", 1, 1)
    initial = F.when(initial.isin("s", "u", "a"), initial).otherwise(F.lit("o"))
    whole_text = F.substring(body, -1, 1).isin(".", "!", "?")
    return F.when(kind == 0, F.lit(None)).when(body == "", F.lit("x")).when(whole_text, initial).otherwise(F.upper(initial))


class Faults:
    """What is counted over the rows of a conversation, or of a part of one, in order."""

    def __init__(self):
        self.count, self.distinct = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}, 0
        self.first = self.last = self.low = self.high = None

    def add(self, turn, role, code, again):
        self.count["duplicate"] += again
        self.count["blank"] += code == "x" and not again
        self.count["truncated"] += code.isupper()
        initial = role[:1]
        if self.last is not None:
            self.count["illegal"] += self.last + initial not in ("su", "ua", "au")
        else:
            self.first = initial
        self.last = initial
        if turn is not None:
            self.distinct += turn != self.high
            self.low, self.high = turn if self.low is None else self.low, turn

    def gaps(self) -> int:
        return 0 if self.low is None else self.high - self.low + 1 - self.distinct


def _conversations(batches):
    """Repairs the conversations that begin and end inside a partition; hands on the rows of the first and the last."""
    import pyarrow as pa

    part, first = task_id(), True
    results: list = [[] for _ in range(9)]
    rows: list = [[] for _ in range(8)]
    names = [f.split()[0] for f in OUT.split(", ")], [f.split()[0] for f in PART_ROWS.split(", ")]
    kinds = (
        [pa.int64()] * 7 + [pa.string()] * 2,
        [pa.int64()] * 4 + [pa.string()] * 3 + [pa.binary()],
    )
    held, conv, key, seen = [], None, None, set()

    def emit():
        both = []
        for columns, types, fields in zip((results, rows), kinds, names):
            struct = pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=fields)
            both.append(pa.ListArray.from_arrays(pa.array([0, len(struct)], pa.int32()), struct))
            for column in columns:
                column.clear()
        return pa.RecordBatch.from_arrays(both, names=["results", "rows"])

    def close(edge):
        if edge:
            for at, (turn, role, text, code, digest) in enumerate(held):
                for column, value in zip(rows, (conv, part, at, turn, role, text, code, digest)):
                    column.append(value)
            return
        faults, codes, kept = Faults(), [], []
        for turn, role, text, code, digest in held:
            if code is not None:
                faults.add(turn, role, code, digest is None and code == "x")
                codes.append(code)
                kept.append((role, text))
        cost, audit = repair("".join(codes))
        sha = hashlib.sha256("\n".join(lines(audit, kept)).encode()).hexdigest()
        for column, value in zip(results, (conv, faults.gaps(), *faults.count.values(), cost, audit, sha)):
            column.append(value)

    for batch in batches:
        for conv_id, turn, role, text, code in zip(*(c.to_pylist() for c in batch.columns)):
            if (now := (conv_id,)) != key:
                if key is not None:
                    close(first)
                    first = False
                held, conv, key, seen = [], conv_id, now, set()
            digest = b""
            if code is not None and code != "x":
                digest = hashlib.blake2b(f"{len(role)} {role}{text}".encode(), digest_size=16).digest()
                if digest in seen:
                    code, digest = "x", None  # a copy of an earlier row
                else:
                    seen.add(digest)
            held.append((turn, role, text, code, digest))
        yield emit()
    if key is not None:
        close(True)
    yield emit()


def repair_conversations(conversations: DataFrame) -> DataFrame:
    """One row per conv_id: gaps, blank, duplicate, truncated, illegal, cost, audit and repaired_sha256.

    Rows are damaged by a hash of conv_id and turn, taken by turn (nulls first; rows of one turn by role,
    the text's first characters and its hash), and repaired at the least cost. A null conv_id is a
    conversation of its own, null roles and texts are one space, a null turn has no part in the gaps. A
    role that begins with none of s, u, a (an empty one too) cannot be kept. A conversation without rows
    after damage has zeros, an empty audit and the hash of nothing. Rows that are repeated are rows like
    any other; an empty table gives none; other columns are ignored. Rows are told equal by 128-bit hashes.
    """
    rows = _damaged(conversations).withColumns({
        "head": F.substring("text", 1, HEAD), "tie": F.xxhash64("text"), "salt": F.monotonically_increasing_id(),
    })
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "head", "tie", "salt"]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    taken = ranged.select("conv_id", "turn", "role", "text", "code")
    found = materialize(taken.mapInArrow(_conversations, f"results array<struct<{_typed(OUT)}>>, rows array<struct<{_typed(PART_ROWS)}>>"))
    inner = found.select(F.explode("results").alias("r")).select("r.*")
    return inner.unionByName(_over_parts(found.select(F.explode("rows").alias("r")).select("r.*")))


def _typed(schema: str) -> str:
    return schema.replace(" ", ": ").replace(",: ", ", ")


def _over_parts(rows: DataFrame) -> DataFrame:
    """The conversations that may lie in several partitions, from their parts."""
    rows = rows.withColumn("conv", F.coalesce(F.col("conv_id").cast("string"), F.lit("")))
    # A row is a copy if an earlier part has it; within a part copies are known already.
    new = rows.where("code IS NOT NULL AND length(key) = 16")
    firsts = new.groupBy("conv", "key").agg(F.min("part").alias("first_part"), F.count("*").alias("n")).where("n > 1").drop("n")
    again = F.col("part") > F.col("first_part")
    marked = rows.join(firsts, ["conv", "key"], "left").withColumns({
        "copy": F.coalesce(again, F.col("key").isNull() & F.col("code").isNotNull()),
        "code": F.when(again, F.lit("x")).otherwise(F.col("code")),
    })
    # Numbers that may be null travel as text, for pandas would make them inexact.
    marked = materialize(marked.select("conv", "part", "at", F.col("turn").cast("string"), "role", "text", "code", "copy"))
    pieces = marked.groupBy("conv", "part").applyInPandas(
        _piece, "conv string, part long, costs array<long>, counts array<long>, distinct long, low string, high string, first string, last string"
    )
    pieces = materialize(pieces)
    # At most two pieces a partition, so what is done for all pieces of a conversation is small.
    chained = materialize(pieces.groupBy("conv").applyInPandas(
        _chain, "conv string, part long, origins array<long>, exits array<long>, cost long, gaps long, counts array<long>"
    ))
    traced = materialize(marked.groupBy("conv", "part").cogroup(chained.groupBy("conv", "part")).applyInPandas(
        _trace, "conv string, part long, origin long, state long, audit string"
    ))
    walked = traced.select("conv", "part", "origin", "state").groupBy("conv").applyInPandas(_walk, "conv string, part long, origin long, tail long")
    chosen = traced.join(walked, ["conv", "part", "origin"]).select("conv", "part", "origin", "audit", "tail")
    fragments = marked.groupBy("conv", "part").cogroup(chosen.groupBy("conv", "part")).applyInPandas(
        _fragments, "conv string, part long, at long, body string, audit string"
    )
    ordered = fragments.repartition("conv").sortWithinPartitions("conv", "part", "at")
    hashed = ordered.mapInArrow(_hash, "conv string, audit string, repaired_sha256 string")
    totals = chained.where("cost IS NOT NULL")
    counts = [F.col("counts")[k].alias(name) for k, name in enumerate(("blank", "duplicate", "truncated", "illegal"))]
    conv_id = F.when(F.col("conv") != "", F.col("conv").cast("long")).alias("conv_id")
    return totals.select("conv", conv_id, "gaps", *counts, "cost").join(hashed, "conv").drop("conv")


def _rows(frame: pd.DataFrame):
    for turn, role, text, code, copy in frame.sort_values("at")[["turn", "role", "text", "code", "copy"]].itertuples(index=False):
        if code is not None and code == code:
            yield (None if turn is None or turn != turn else int(turn)), role, text, code, bool(copy)


def _piece(frame: pd.DataFrame) -> pd.DataFrame:
    faults, codes = Faults(), []
    for turn, role, _, code, copy in _rows(frame):
        faults.add(turn, role, code, copy)
        codes.append(code)
    return pd.DataFrame([{
        "conv": frame["conv"].iloc[0], "part": frame["part"].iloc[0],
        "costs": list(Codes("".join(codes)).matrix()), "counts": list(faults.count.values()), "distinct": faults.distinct,
        "low": _text(faults.low), "high": _text(faults.high), "first": faults.first, "last": faults.last,
    }])


def _text(number) -> str | None:
    return None if number is None else str(number)


def _chain(frame: pd.DataFrame) -> pd.DataFrame:
    """Prices behind each part, and what the whole conversation adds up to, with its first part."""
    frame = frame.sort_values("part")
    matrices = [tuple(int(c) for c in costs) for costs in frame["costs"]]
    exits = exits_of(matrices, (NOTHING,), TAIL)
    origins = [(NOTHING,)] + [tuple(s for s in range(4) if e[s] < NO_WAY) for e in exits[:-1]]
    counts, distinct, low, high, last = [0, 0, 0, 0], 0, None, None, None
    for some, n, a, b, first, end in frame[["counts", "distinct", "low", "high", "first", "last"]].itertuples(index=False):
        counts = [x + int(y) for x, y in zip(counts, some)]
        if first is not None and first == first:
            counts[3] += last is not None and last + first not in ("su", "ua", "au")
            last = end
        if pd.notna(a):
            distinct += int(n) - (high == int(a))
            low, high = int(a) if low is None else low, int(b)
    out = pd.DataFrame({"conv": frame["conv"].tolist(), "part": frame["part"].tolist(), "origins": [list(o) for o in origins], "exits": [list(e) for e in exits]})
    at_first = lambda value: [value] + [None] * (len(out) - 1)
    out["cost"] = pd.array(at_first(min(c + t for c, t in zip(whole(matrices), TAIL))), "Int64")
    out["gaps"] = pd.array(at_first(0 if low is None else high - low + 1 - distinct), "Int64")
    out["counts"] = at_first(counts)
    return out


def _trace(rows: pd.DataFrame, chained: pd.DataFrame) -> pd.DataFrame:
    part = chained.iloc[0]
    codes = Codes("".join(code for _, _, _, code, _ in _rows(rows)))
    found = codes.traces(tuple(int(o) for o in part["origins"]), tuple(int(e) for e in part["exits"]))
    return pd.DataFrame([(part["conv"], part["part"], origin, state, audit) for origin, (state, audit) in found.items()], columns=["conv", "part", "origin", "state", "audit"])


def _walk(frame: pd.DataFrame) -> pd.DataFrame:
    """The state in which each part begins, and the rows inserted behind it: none but behind the last part."""
    to, origin, out = {}, NOTHING, []
    for part, start, end in frame[["part", "origin", "state"]].itertuples(index=False):
        to.setdefault(part, {})[start] = end
    for part in sorted(to):
        out.append([part, origin, 0])
        origin = to[part][origin]
    out[-1][2] = TAIL[origin] // INSERT
    return pd.DataFrame([(frame["conv"].iloc[0], *row) for row in out], columns=["conv", "part", "origin", "tail"])


def _fragments(rows: pd.DataFrame, chosen: pd.DataFrame) -> pd.DataFrame:
    _, part, origin, audit, tail = chosen[["conv", "part", "origin", "audit", "tail"]].iloc[0]
    audit += "I" * int(tail)
    out, body, size = [], [], 0
    for line in lines(audit, ((role, text) for _, role, text, _, _ in _rows(rows)), int(origin)):
        body.append(line + "\n")
        size += len(line)
        if size >= FRAGMENT:
            out.append("".join(body))
            body, size = [], 0
    out.append("".join(body))
    conv = chosen["conv"].iloc[0]
    return pd.DataFrame([(conv, part, k, text, audit if k == 0 else "") for k, text in enumerate(out)], columns=["conv", "part", "at", "body", "audit"])


def _hash(batches):
    """Audit and hash of each conversation, whose fragments come in order; every line ends in a newline but the last."""
    import pyarrow as pa

    conv, sha, waiting, audit = None, None, "", []

    def closed():
        sha.update(waiting[:-1].encode())
        return pa.RecordBatch.from_pydict({"conv": [conv], "audit": ["".join(audit)], "repaired_sha256": [sha.hexdigest()]})

    for batch in batches:
        columns = batch.to_pydict()
        for name, body, letters in zip(columns["conv"], columns["body"], columns["audit"]):
            if name != conv:
                if sha is not None:
                    yield closed()
                conv, sha, waiting, audit = name, hashlib.sha256(), "", []
            audit.append(letters)
            if body:
                sha.update(waiting.encode())
                waiting = body
    if sha is not None:
        yield closed()


def query(spark: SparkSession, d: str) -> DataFrame:
    return repair_conversations(read_table(prepare(spark), d, "conversations", SCHEMA))


QUERIES = {"op11_conversation_repair": query}
ORACLES: dict[str, str] = {}
