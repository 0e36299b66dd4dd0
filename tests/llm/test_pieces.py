"""Encoding and decoding against the library, text by text."""

import hashlib
import random

import numpy as np
import pytest
import sentencepiece

from cohortlens.llm.piece_merge import Pieces, chunks, decode, default_model, encode, piece_ids


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=default_model())


@pytest.fixture(scope="module")
def pieces():
    return Pieces(default_model())


def test_same_ids_and_text_as_the_library(library, pieces, odd):
    rng = random.Random(3)
    some = [t or "" for _, t in odd] + ["a" * 4000, "ab" * 2000, "aaab" * 500, "1234567 12,3.4", "\r\n", "ÀÉ ß"]
    for letters in ("aeiou thens\n▁  é日😀1<>", "thesanoi", "ab "):
        some += ["".join(rng.choice(letters) for _ in range(rng.randint(0, 80))) for _ in range(700)]
    at = 0
    for chunk in chunks(some):
        ids, counts = encode(pieces, chunk)
        back = decode(pieces, ids, counts)
        for text, own, found in zip(chunk, np.split(ids, np.cumsum(counts)[:-1]), back):
            wanted = library.encode(text)
            assert own.tolist() == wanted, text[:80]
            assert found == library.decode(wanted)
            at += 1
    assert at == len(some)


def test_rows(make, library, odd):
    got = sorted((r["doc_id"] or 0, r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in piece_ids(make(odd, clash=True)).collect())
    wanted = []
    for doc_id, text in odd:
        ids = [library.bos_id(), *library.encode(text or ""), library.eos_id()]
        raw = np.array(ids, "<u4").tobytes()
        wanted.append((doc_id or 0, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    assert got == sorted(wanted)
    assert piece_ids(make([])).count() == 0
