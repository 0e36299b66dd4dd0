"""Pseudonyms against their own rules: valid, one to one, linked, and never the value itself where values are few."""

import random
import string
from datetime import date, timedelta
from itertools import product

import pytest

from cohortlens.llm import feistel_pii
from cohortlens.llm.feistel_pii import Permutation, iban_rest, luhn, luhn_digit, pseudonymise

KEY = b"a key of the tests"


@pytest.fixture(scope="module")
def p():
    return Permutation(KEY)


@pytest.mark.parametrize("size", [2, 3, 10, 26, 100, 676, 4096])
def test_small_domains_are_permuted_without_fixed_points(size):
    for tweak in (b"a", b"b", b"c", b"d"):
        p = Permutation(KEY + tweak)
        found = [p.moved(v, size, tweak) for v in range(size)]
        assert sorted(found) == list(range(size))
        assert all(v != w for v, w in enumerate(found))


def test_walks_are_permutations_of_the_valid(p):
    even = lambda v: v % 2 == 0
    assert sorted(p.walk(v, 1000, b"x", even) for v in range(0, 1000, 2)) == list(range(0, 1000, 2))


def test_local_parts_of_one_and_two_characters(p):
    for alphabet, n in ((string.digits, 1), (string.digits, 2), (string.ascii_lowercase, 1), (string.ascii_lowercase, 2)):
        some = ["".join(x) for x in product(alphabet, repeat=n)]
        got = [pseudonymise(f"write to {s}@example.org now", p) for s in some]
        assert all(k == 1 for _, k in got)
        locals_ = [t[len("write to ") : t.index("@")] for t, _ in got]
        assert sorted(locals_) == sorted(some) and all(a != b for a, b in zip(locals_, some))


def test_letters_beyond_ascii_do_not_stay(p):
    for name in ("jos\u00e9.n\u00fa\u00f1ez", "\u0438\u0432\u0430\u043d", "\u5c71\u7530"):
        got, n = pseudonymise(f"{name}@example.org", p)
        local = got.split("@")[0]
        assert n == 1 and local != name and len(local) == len(name)
        assert all(a.isalpha() == b.isalpha() and a.islower() == b.islower() for a, b in zip(local, name))
        assert sum(a == b for a, b in zip(local, name) if a.isalpha()) <= 2


def test_numbers_stay_valid_and_distinct(p):
    rng, cards, ibans = random.Random(1), set(), set()
    for _ in range(300):
        body = "4" + "".join(rng.choice(string.digits) for _ in range(14))
        got, n = pseudonymise("card " + body + luhn_digit(body), p)
        assert n == 1 and luhn(got[5:]) and got[5] == "4" and len(got) == 21
        cards.add((body, got))
        plain = "DE00" + "".join(rng.choice(string.digits) for _ in range(18))
        plain = plain[:2] + f"{98 - iban_rest(plain):02d}" + plain[4:]
        got, n = pseudonymise(plain, p)
        assert n == 1 and iban_rest(got) == 1 and got[:2] == "DE"
        ibans.add((plain, got))
    for some in (cards, ibans):
        assert len({a for a, _ in some}) == len({b for _, b in some}) and all(a != b for a, b in some)


def test_one_day_in_two_layouts_is_linked(p):
    for k in range(200):
        day = date(1950, 1, 1) + timedelta(97 * k)
        a, b, c = (pseudonymise(day.strftime(f), p)[0] for f in ("%Y-%m-%d", "%d.%m.%Y", "%Y/%m/%d"))
        assert date.fromisoformat(a) == date(*map(int, reversed(b.split(".")))) == date(*map(int, c.split("/"))) != day


def test_equal_values_are_linked_across_texts(p):
    one = pseudonymise("mail ann.lee@example.org, again ann.lee@example.org", p)[0]
    other = pseudonymise("ann.lee@example.org", p)[0]
    assert one.count(other) == 2
    assert pseudonymise("ann.lee@example.org", Permutation(b"another key"))[0] != other


def test_a_clash_with_the_count_is_an_error(make):
    docs = make([(1, "a@b.org")]).selectExpr("*", "5 AS n_items")
    with pytest.raises(ValueError, match="n_items"):
        feistel_pii.replace_personal_data(docs)
    kept = feistel_pii.replace_personal_data(docs, counted="replaced").first()
    assert kept["n_items"] == 5 and kept["replaced"] == 1
