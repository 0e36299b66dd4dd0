"""Hard negatives against a plain reading of their definition, and against SQL."""

import math
import random

import numpy as np
import pytest

import __spark_entry__ as entry
from cohortlens.llm import negative_mining
from cohortlens.llm.negative_mining import mine_negatives, threshold_join
from oracle import connect, difference

SCHEMA = "vec_id long, embedding array<float>, label int"


def expected(rows):
    valid = []
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        label = (label + 1) % 10 if i % 7 == 0 else label
        valid.append((i, [math.floor(256 * float(np.float32(x))) for x in v], label))
    out = []
    for i, v, label in valid:
        if i % 100:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, other) for j, w, other in valid)
        near = [(j, -s) for s, j, other in scored if other == label and j != i][:5]
        for positive, p in near:
            inside = [(j, -s) for s, j, other in scored if other != label and 30 * p <= -100 * s <= 90 * p]
            out += [(i, positive, k, j, p, s) for k, (j, s) in enumerate(inside[:10], 1)]
    return sorted(out)


def some(n, labels, seed, dims=20):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(labels)]
    for i in range(n):
        label = rng.randrange(labels)
        yield i, [c + rng.gauss(0, 0.8) for c in centres[rng.randrange(labels)]], label


@pytest.mark.parametrize("rows_in_block,step,first", [(4096, 16, 64), (64, 3, 4)])
def test_lists_are_whole(spark, monkeypatch, rows_in_block, step, first):
    for name, value in {"BLOCK_ROWS": rows_in_block, "STEP": step, "FIRST_ROUND": first}.items():
        monkeypatch.setattr(negative_mining, name, value)
    rows = list(some(900, 4, rows_in_block))
    rows += [(2000 + k, rows[5][1], k % 3) for k in range(150)]  # one vector many times: ties
    got = mine_negatives(spark.createDataFrame(rows, SCHEMA).repartition(5), relabelled=True)
    assert sorted(map(tuple, got.collect())) == expected(rows)


def test_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [
        (0, [1.0, 2.0], 1), (100, [], 1), (200, [1.0], 1), (300, [-1.0, 0.5, 3.0], 2), (None, [1.0], 1), (400, None, 1), (500, [1.0, None], 1),
        (600, [inf, 1.0], 2), (700, [nan], 2), (800, [0.0, 0.0], 2), (900, [9e3, 9e3], 3), (1, [1.0, 1.9], 1), (2, [0.6, 1.1], 2), (3, [0.5, 1.0], None),
        (4, [0.7, 1.0], 2), (5, [0.7, 1.0], 2), (7, [1.0, 1.0], 9), (1000, [5.0], 77), (-100, [1.0, 1.0], -3),
    ] + [(20 + k, [0.1 * k, 1.0], k % 4) for k in range(40)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS block", "2 AS anchor", "3 AS w", "4 AS score", "5 AS rank", "6 AS share")
    got = mine_negatives(df, relabelled=True)
    assert sorted(map(tuple, got.collect())) == expected(rows)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert mine_negatives(spark.createDataFrame([], SCHEMA)).count() == 0


def test_repeated_rows_take_places(spark):
    rows = [(0, [1.0], 1), (1, [1.0], 1)] + [(2, [0.5], 2)] * 12
    got = sorted(map(tuple, mine_negatives(spark.createDataFrame(rows + rows[:1], SCHEMA)).collect()))
    assert got == sorted([(0, 1, k, 2, 65536, 32768) for k in range(1, 11)] * 2)


@pytest.mark.parametrize("scale", [100, 10**7])
def test_threshold_join(scale):
    rng = np.random.default_rng(1)
    q, x = (rng.integers(-scale, scale, (n, 40)) * (0.97 ** np.arange(40) > 0.5) for n in (30, 400))
    x, q = negative_mining._wide(x, q)
    exact = q.astype(object) @ x.astype(object).T
    least = np.array(sorted(exact.max(axis=1) // 2), np.int64)
    a, b, s = threshold_join(q, x, least)
    assert {(i, j): v for i, j, v in zip(a.tolist(), b.tolist(), s.tolist())} == {
        (i, j): exact[i, j] for i in range(30) for j in range(400) if exact[i, j] >= least[i]
    }


def test_against_sql(spark):
    d, name = "/root/testdata/sf0.01", "op12_negative_mining"
    assert difference(entry.queries()[name](spark, d), connect(d), entry.oracle_sql()[name]) is None
