"""Repaired conversations against a plain search over all edits."""

import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest

from cohortlens.llm import conversation_repair
from cohortlens.llm.conversation_repair import OUT, SCHEMA, repair, repair_conversations

SF = "/root/testdata/sf0.01"
NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}


def search(codes):
    """Cost, audit and repaired roles; a code is (initial, must go, truncated)."""

    @lru_cache(None)
    def best(i, state, inserted):
        ways = []
        if i == len(codes) and state in ("", "a"):
            ways.append((0, ""))
        if inserted < 3:
            cost, audit = best(i, NEXT[state], inserted + 1)
            ways.append((cost + 5, "I" + audit))
        if i < len(codes):
            initial, gone, truncated = codes[i]
            cost, audit = best(i + 1, state, 0)
            ways.append((cost + 2, "D" + audit))
            if not gone:
                if initial == NEXT[state] or (initial == "s" and state == ""):
                    cost, audit = best(i + 1, initial, 0)
                    ways.append((cost + 5 * truncated, "K" + audit))
                cost, audit = best(i + 1, NEXT[state], 0)
                ways.append((cost + 5 * truncated + 1, "R" + audit))
        return min(ways, default=(10**9, ""))

    for i in range(len(codes), 0, -20):  # so that no search goes deep
        for state in NEXT:
            best(i, state, 0)
    return best(0, "", 0)


def expected(rows):
    """rows: (conv_id, turn, role, text) in any order."""
    convs = {}
    for conv, turn, role, text in rows:
        found = convs.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        found += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    for conv, found in convs.items():
        found.sort(key=lambda r: (r[0] is not None, r[0], r[1], r[2]))
        seen, codes, counts = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, role, text in found:
            body = text.strip(" \t\n\x0b\x0c\r")
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            codes.append((role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(found, found[1:]))
        cost, audit = search(tuple(codes))
        out, rows_left, state = [], iter(found), ""
        for letter in audit:
            _, role, text = next(rows_left) if letter != "I" else (None, None, "")
            if letter == "D":
                continue
            if letter != "K":
                role = {"u": "user", "a": "assistant"}[NEXT[state]]
            state = role[0]
            out.append(f"{role}:{text}")
        assert re.fullmatch("(s?(ua)+)?", "".join(line[0] for line in out))
        turns = [t for t, _, _ in found if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        yield (conv, gaps, *counts.values(), illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())


def check(spark, rows, parts=4):
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    got = repair_conversations(df.selectExpr("*", "1 AS part", "'x' AS code", "2 AS kind", "3 AS key", "4 AS conv"))
    assert got.columns == [f.split()[0] for f in OUT.split(", ")]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(expected(rows), key=str)


def coded(codes):
    return "".join("x" if gone else (i if i in ("s", "u", "a") else "o").upper() if cut else (i if i in ("s", "u", "a") else "o") for i, gone, cut in codes)


@pytest.mark.parametrize("block", [2, 3, 8])
def test_repairs_are_cheapest_and_least(monkeypatch, block):
    monkeypatch.setattr(conversation_repair, "BLOCK", block)
    monkeypatch.setattr(conversation_repair, "remembered", lambda make, *key: make(*key))
    rng = random.Random(block)
    for n in [0, 1, 1, 1, 2, 2, 3, 3, 4, 5] * 12 + [rng.randrange(6, 60) for _ in range(150)]:
        codes = tuple((rng.choice("ssuuuuuaaaaa t"), rng.random() < 0.1, rng.random() < 0.15) for _ in range(n))
        assert repair(coded(codes)) == search(codes), coded(codes)


def test_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    check(spark, rows)


ODD = [
    (None, 1, "user", "Hi."), (None, None, "assistant", "Yes."), (None, None, None, None), (1, None, None, None), (2, 0, "", ""),
    (3, 5, "user", "a" * 200_000 + "."), (3, 6, "assistant", "b. \t\n"), (4, -3, "system", "Be."), (4, 9, "tool", "x!"), (4, 9, "tool", "x!"),
    (5, 1, "user", "Tie."), (5, 1, "assistant", "Tie."), (5, 1, "system", "Tie."), (6, 1 << 60, "user", "far."), (6, -1, "assistant", "日本。"),
    (7, 2, "User", "Capital."), (7, 3, "ü", "é?"), (8, 0, "system", "alone."), (9, 0, "assistant", "a\x0b."), (9, 1, "assistant", "a\x0b."),
]


def test_odd_rows(spark, conf):
    check(spark, ODD + [(100 + k, 0, "user", "gone or not.") for k in range(60)])
    assert repair_conversations(spark.createDataFrame([], SCHEMA)).count() == 0


def test_conversation_over_many_partitions(spark, conf):
    conf(spark__sql__shuffle__partitions="13", spark__sql__adaptive__coalescePartitions__enabled="false")
    rng = random.Random(3)
    hot = [
        (7, rng.randrange(1500) if rng.random() < 0.98 else None, rng.choice(["user", "assistant", "assistant", "user", "system", "tool"]), rng.choice(["Same.", "", "cut", f"Own {k}.", f"Own {k}!\n"]))
        for k in range(900)
    ]
    check(spark, hot + ODD + [(50, k, ("user", "assistant")[k % 2], f"Fine {k}.") for k in range(300)], parts=9)
