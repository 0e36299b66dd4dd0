"""Token counts of the transducers against the tokenizers library."""

import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from cohortlens.llm import common, token_transducer
from cohortlens.llm.token_transducer import Counter, default_tokenizer, token_counts

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(default_tokenizer())
    return lambda texts: [len(e.ids) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


@pytest.fixture(scope="module")
def counter():
    return Counter(default_tokenizer())


def strings():
    rng = random.Random(1)
    letters = "abcdefghijklmnopqrstuvwxyz"
    yield from ("".join(rng.choice(letters) for _ in range(rng.randrange(1, 200))) for _ in range(200))
    yield from ("".join(rng.choice("aeint's rev lld'l'r1é!😀日\n<|") for _ in range(rng.randrange(80))) for _ in range(1500))
    yield from ("".join(rng.choice("ab") for _ in range(rng.randrange(1, 300))) for _ in range(200))
    yield from (c * k for c in ("a", "!", "日本", "'r", "'l", "1", "'") for k in range(80))
    yield from ("a<|endoftext|>b", "<|startoftext|><|endoftext|>", "<|END|>", "ΑΣ ΟΔΟΣ Σ", "İ", "é e ́", "x\x1cy\x85z　", "it'sabc 'rx 'lly 'v", "Ɤ")


def test_counts_are_the_librarys(counter, library):
    some = list(strings())
    assert counter.counts(some).tolist() == library(some)


def test_small_slabs_pieces_and_tables(counter, library, monkeypatch):
    for name, value in {"SLAB": 50, "PIECE": 3, "WARM": 2, "CHUNK": 4, "HELD_STATES": 100}.items():
        monkeypatch.setattr(token_transducer, name, value)
    some = list(strings())[::7]
    assert counter.counts(some).tolist() == library(some)


def test_every_character(counter, library):
    some = [f"a{chr(c)}b" for c in range(0x110000) if not 0xD800 <= c < 0xE000][::13]
    assert counter.counts(some).tolist() == library(some)


def test_chunk_maps_compose_to_one_pass(counter):
    rng = np.random.default_rng(0)
    codes = np.array([ord(c) for c in "".join(rng.choice(list("ab'srvle1! \n"), 5000)) + " "])
    state, wanted = 0, np.zeros(len(codes), bool)
    words = counter.words
    for k, c in enumerate(codes):
        at = words.classes[c] * 8 + state
        wanted[k] |= bool(words.here[at])
        if words.before[at]:
            wanted[k - 1] = True
        state = words.following[at]
    assert (words.starts(codes)[0] == wanted).all()


def test_documents(spark, library):
    docs = common.documents(spark, SF)
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    wanted = dict(zip(texts, library(list(texts.values()))))
    got = token_counts(docs).collect()
    assert {r["doc_id"]: (r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in got} == {
        i: (len(t.encode()), wanted[i], wanted[i] > 2048) for i, t in texts.items()
    }


def test_odd_rows(make, odd, library):
    got = token_counts(make(odd, clash=True), limit=3).collect()
    texts = [t or "" for _, t in odd]
    wanted = [(i, len(t.encode()), n, n > 3) for (i, _), t, n in zip(odd, texts, library(texts))]
    assert sorted(map(tuple, got), key=str) == sorted(wanted, key=str)
    assert token_counts(make([])).count() == 0


def test_other_tokenizers_are_refused():
    import public_tokenizers

    with pytest.raises(ValueError, match="not a lower-casing"):
        Counter(public_tokenizers.path("byte_bpe_50k.json"))
