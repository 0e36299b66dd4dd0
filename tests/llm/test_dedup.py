"""Exact copies, near copies and repeated passages against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import xxhash

from cohortlens.llm import bucket_refinement, content_sort as content_sort_module, simhash_vp
from cohortlens.llm.bucket_refinement import LENGTH, remove_repeats
from cohortlens.llm.content_sort import content_sort, keep_last
from cohortlens.llm.simhash_vp import keep_one, near_duplicates


def folded(text):
    return (text or "").encode().lower()  # bytes: A-Z only


def test_content_sort(make, odd):
    rows = odd + [(k, "hot text") for k in range(100, 400)]
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(folded(text), []).append(-1 if doc_id is None else doc_id)
    got = content_sort(make(rows, clash=True, parts=5)).collect()
    assert len(got) == len(rows)
    kept = Counter()
    for r in got:
        members = groups[next(g for g in groups if hashlib.sha256(g).hexdigest() == r["text_sha256"])]
        assert r["group_size"] == len(members)
        assert (-1 if r["keep_id"] is None else r["keep_id"]) == max(members)
        kept[r["text_sha256"]] += r["kept"]
        assert not r["kept"] or r["doc_id"] == r["keep_id"]
    assert set(kept.values()) == {1} and len(kept) == len(groups)
    assert content_sort(make([])).count() == 0


def test_runs_over_several_partitions(make, conf):
    conf(spark__sql__shuffle__partitions="7", spark__sql__adaptive__coalescePartitions__enabled="false")
    got = content_sort(make([(k, "A" if k % 2 else "a") for k in range(500)] + [(1000, "b")])).collect()
    assert {(r["keep_id"], r["group_size"]) for r in got} == {(499, 500), (1000, 1)}
    assert sum(r["kept"] for r in got) == 2


def test_runs_are_the_only_table_that_is_stored(make, monkeypatch):
    """Each file of a table costs its executor some processes, and the few rows that join runs were a table too."""
    stored, original = [], content_sort_module.materialize
    monkeypatch.setattr(content_sort_module, "materialize", lambda df: stored.append(df.columns) or original(df))
    assert content_sort(make([(k, "A" if k % 2 else "a") for k in range(500)])).where("kept").count() == 1
    assert len(stored) == 1


def test_keep_last(make, odd):
    left = keep_last(make(odd, clash=True))
    assert left.columns == make(odd, clash=True).columns
    texts = [folded(r["text"]) for r in left.collect()]
    assert sorted(texts) == sorted({folded(t) for _, t in odd})


def brute_fingerprint(text):
    words = folded(text).split()
    if not words:
        return 0
    hashes = [xxhash.xxh64(b" ".join(words[k : k + 3]), 42).intdigest() for k in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(pairs, fingerprints):
    parent = list(range(len(pairs)))

    def top(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for i, a in enumerate(fingerprints):
        for j in range(i):
            if (a ^ fingerprints[j]).bit_count() <= 2:
                parent[top(i)] = top(j)
    names = {}
    for k, (doc_id, _) in enumerate(pairs):
        names.setdefault(top(k), []).append(doc_id)
    return [min((x for x in names[top(k)] if x is not None), default=None) for k in range(len(pairs))]


@pytest.fixture
def near():
    rng = random.Random(1)
    base = [" ".join(f"w{rng.randint(0, 4000)}" for _ in range(300)) for _ in range(30)]
    rows = [(1000 + k, t) for k, t in enumerate(base)]
    for k in range(200):
        words = rng.choice(base).split()
        words[rng.randrange(300)] = "changed"
        rows.append((k, " ".join(words)))
    return rows


def test_near_duplicates(make, odd, near, monkeypatch):
    monkeypatch.setattr(simhash_vp, "SHARD", 60)
    monkeypatch.setattr(simhash_vp, "SHARD_SAMPLE", 4)
    monkeypatch.setattr(simhash_vp, "LEAF", 16)
    rows = odd + near
    prints = [brute_fingerprint(t) for _, t in rows]
    wanted = Counter((i, f"{f:016x}", c) for (i, _), f, c in zip(rows, prints, brute_components(rows, prints)))
    got = Counter(tuple(r) for r in near_duplicates(make(rows, clash=True)).collect())
    assert got == wanted
    assert near_duplicates(make([])).count() == 0


def test_points_that_lie_close_together():
    rng = np.random.default_rng(0)
    centre = rng.integers(0, 1 << 63, 1, np.int64).astype(np.uint64)[0]
    x = [centre] + [centre ^ np.uint64(1 << a) for a in range(64)] + [centre ^ np.uint64(1 << a | 1 << b) for a in range(64) for b in range(a)]
    x = np.unique(np.array(x, np.uint64))
    assert (simhash_vp._joined(x, 2) == 0).all()


def test_chain_of_links(spark):
    chain = [(k, k + 1) for k in range(60)] + [(200, 150), (150, 180)]
    got = {r["a"]: r["b"] for r in simhash_vp.contract(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(1, 61)} | {200: 150, 180: 150}


def test_keep_one(make, near):
    left = {r["doc_id"] for r in keep_one(make(near)).collect()}
    prints = [brute_fingerprint(t) for _, t in near]
    assert left == set(brute_components(near, prints))


def brute_repeats(rows):
    count = Counter()
    for _, text in rows:
        b = (text or "").encode()
        count.update(b[p : p + LENGTH] for p in range(len(b) - LENGTH + 1))
    out = Counter()
    for doc_id, text in rows:
        b = (text or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - LENGTH + 1):
            if count[b[p : p + LENGTH]] > 1:
                gone[p : p + LENGTH] = b"\1" * LENGTH
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(gone[k] and (k == 0 or not gone[k - 1]) for k in range(len(b)))
        out[(doc_id, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())] += 1
    return out


@pytest.mark.parametrize("limit", [bucket_refinement.BUCKET_CONTEXTS, 5])
def test_repeats(make, limit):
    rng = random.Random(5)
    text = lambda n: "".join(rng.choice("abcdefgh é\n") for _ in range(n))
    passages = [text(n) for n in (380, 400, 401, 450, 700, 1500)]
    rows = [(k, text(rng.randint(0, 300)) + rng.choice(passages) + text(rng.randint(0, 500)) + rng.choice(passages)) for k in range(60)]
    rows += [(100, "a" * 500), (101, "ab" * 600), (102, "x" * 400), (103, None), (104, ""), (105, passages[5]), (106, passages[5])]
    rows += [(106, passages[5]), (None, passages[4] + "q"), (107, "x" * 399), (108, "z" * 400 + "z"), (109, "é" * 200), (110, "é" * 201)]
    got = Counter(tuple(r) for r in remove_repeats(make(rows, clash=True), bucket_contexts=limit).collect())
    assert got == brute_repeats(rows)


def test_repeats_of_nothing(make):
    assert remove_repeats(make([])).count() == 0


@pytest.mark.parametrize("pairs, shared, alone", [(10, 200, 700), (1, 200, 700), (800, 120, 330)])
def test_anchors_that_share_less_than_a_window(make, pairs, shared, alone):
    rng = random.Random(8)
    text = lambda n: "".join(rng.choice("abcdefgh é\n") for _ in range(n))
    heads = [text(shared)] * pairs if shared == 120 else [text(shared) for _ in range(pairs)]
    rows = [(2 * k + j, (text(alone) if shared == 200 else "") + head + text(alone)) for k, head in enumerate(heads) for j in (0, 1)]
    got = Counter(tuple(r) for r in remove_repeats(make(rows)).collect())
    assert got == brute_repeats(rows)


def test_refinement_that_no_window_survives():
    rng = random.Random(9)
    text = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n)).encode()
    for shared in (64, 127, 130, 200, 300, 399):
        middle = text(shared)
        bodies = [text(336) + middle + text(336) for _ in range(2)]
        row, start, end = bucket_refinement.refine(np.zeros(2, int), np.zeros(2, bool), np.full(2, 336), np.full(2, 336), bodies)
        assert len(row) == len(start) == len(end) == 0
    assert len(bucket_refinement._alone(np.zeros(0, np.uint64))[0]) == 0


def test_windows_are_refined_only_around_shared_cores(monkeypatch):
    rng = random.Random(10)
    text = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n)).encode()
    compared = []
    original = bucket_refinement._alone
    monkeypatch.setattr(bucket_refinement, "_alone", lambda names: compared.append(len(names)) or original(names))
    middle = text(120)
    bodies = [text(336) + middle + text(280) for _ in range(50)]
    row, _, _ = bucket_refinement.refine(np.zeros(50, int), np.zeros(50, bool), np.full(50, 336), np.full(50, 336), bodies)
    assert len(row) == 0 and sum(compared) <= 50 * 30  # one identifier for each of 337 windows before


def test_refinement_at_the_edges_of_bands():
    """Pairs that share some bytes before the gram and after it, cut short or not, against plain comparison."""
    rng = random.Random(11)
    text = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n)).encode()
    bucket, settled, left, bodies = [], [], [], []
    for k in range(400):
        before, after = rng.randint(0, 336), rng.randint(64, 400)
        shared = text(before), text(after)
        for _ in range(rng.choice((2, 3))):
            ahead, behind = before + rng.choice((0, rng.randint(0, 336))), after + rng.choice((0, rng.randint(0, 336)))
            body = (text(336) + shared[0])[-min(336, ahead):] if ahead else b""
            bodies.append(body + (shared[1] + text(336))[: min(400, behind)])
            bucket.append(k), left.append(len(body)), settled.append(rng.random() < 0.2)
    at = [n + 7 for n in left]
    row, start, end = bucket_refinement.refine(*map(np.array, (bucket, settled, at, left)), bodies)
    got = Counter((r, s) for r, first, last in zip(row.tolist(), start.tolist(), end.tolist()) for s in range(first, last - LENGTH + 1))
    seen = Counter()
    windows = [(r, s, (bucket[r], left[r] - s, b[s : s + LENGTH])) for r, b in enumerate(bodies) for s in range(max(0, len(b) - LENGTH + 1)) if s <= left[r] <= s + 336]
    for _, _, window in windows:
        seen[window] += 1
    assert got == Counter((r, s + 7) for r, s, window in windows if seen[window] > 1 and not settled[r]) and got
