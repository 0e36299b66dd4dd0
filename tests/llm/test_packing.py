"""Every id in one piece, sequences without gaps, next to no padding."""

import zlib
from collections import defaultdict

import numpy as np
from tokenizers import Tokenizer

from cohortlens.llm.stock_packing import LENGTH, Words, cutting_stock, default_tokenizer, pack


def check(rows, wanted):
    covered, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        assert r["length"] > 0
        covered[r["doc_id"]].append((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(covered) == set(wanted)
    for doc_id, pieces in covered.items():
        at = 0
        for start, length, crc, n in sorted(pieces):
            assert (start, n) == (at, len(wanted[doc_id]))
            assert crc == zlib.crc32(wanted[doc_id][start : start + length].tobytes())
            at += length
        assert at == len(wanted[doc_id])
    padding = 0
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= LENGTH
        padding += LENGTH - at if at & (at - 1) else 0
    return padding


def ids_of(pairs):
    library = Tokenizer.from_file(default_tokenizer())
    return {i: np.array([*library.encode(t or "", add_special_tokens=False).ids, 2], np.uint32) for i, t in pairs}


def test_words_are_encoded_as_whole_texts():
    some = ["", "A b.", "a,b", "É,", "İ.", "x..", "Don't I'M straße ŉ ǰx ﬃ éa éa Éa ÿ ñandú ªº ʰa ⅷ", "<|endoftext|> <|EndOfText|>.", "ﬁ Å\x85c", "Σας ΣΑΣ", "é ́a", "a\x1cb", "日本 😀 12.5,"]
    flat, counts = Words(default_tokenizer()).ids(some)
    for text, own in zip(some, np.split(flat, np.cumsum(counts)[:-1])):
        assert own.tolist() == ids_of([(0, text)])[0].tolist(), text


def test_pieces(make, odd):
    pairs = [(i, t) for i, t in odd if i is not None and i != 6] + [(100 + k, "some words of text " * (k % 40)) for k in range(300)]
    assert check(pack(make(pairs, clash=True)).collect(), ids_of(pairs)) == 0


def test_repeated_rows_and_null_ids(make):
    rows = pack(make([(1, "twice"), (1, "twice"), (None, "none"), (None, None)])).collect()
    wanted = ids_of([(1, "twice"), (2, "none")])
    assert sum(r["length"] for r in rows) == 2 * len(wanted[1]) + len(wanted[2]) + 1
    spots = [(r["sequence_id"], r["offset"] + k) for r in rows for k in range(r["length"])]
    assert len(spots) == len(set(spots))
    assert pack(make([])).count() == 0


def test_patterns_cover_the_orders():
    rng = np.random.default_rng(4)
    demand = np.r_[0, rng.integers(0, 5000, 128)]
    patterns = cutting_stock(demand, 128)
    made = np.zeros(129, np.int64)
    for number, orders in patterns:
        assert number > 0 and sum(k * a for k, a in orders.items()) <= 128
        for k, a in orders.items():
            made[k] += number * a
    assert (made == demand).all()
    assert sum(n for n, _ in patterns) <= 1.06 * np.arange(129) @ demand / 128
    assert cutting_stock(np.zeros(129, int), 128) == []
    small = cutting_stock(np.array([0, 0, 0, 4, 0, 2]), 8)  # 3 + 5, twice, and 3 + 3
    assert sum(n for n, _ in small) == 3
