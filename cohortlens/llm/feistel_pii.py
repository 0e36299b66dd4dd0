"""Pseudonyms for personal data that keep its format, by keyed Feistel permutations.

Each kind of identifier is found by its pattern and has to pass its own test (check digits, ranges, a real
calendar day). Its digits and letters are a number below the count of all such identifiers; a Feistel
network over the key permutes these numbers, and is applied again while the result fails the test or
leaves the range (cycle walking), so that valid identifiers are permuted among themselves. Equal values
get equal pseudonyms in every document, different values different ones, without any table: the operator
is a map over texts.
"""

from __future__ import annotations

import hashlib
import re
import string
from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, timedelta

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import documents, free_names, texts

KEY = b"change this key: whoever has it can undo the pseudonyms"
ROUNDS = 8
LISTED = 4096  # sizes up to which fixed points are looked for; above, a value stays with a chance of 1 in so many
FIRST_DAY, DAYS = date(1900, 1, 1), 73_049  # to 2099-12-31


class Permutation:
    """Keyed permutation of the numbers below any size."""

    def __init__(self, key: bytes):
        self.key = hashlib.blake2b(key, digest_size=32).digest()
        self.tables: dict[tuple[int, bytes], list[int]] = {}

    def _once(self, value: int, half: int, tweak: bytes) -> int:
        mask, width = (1 << half) - 1, (half + 7) // 8
        left, right = value >> half, value & mask
        for turn in range(ROUNDS):
            mixed = hashlib.blake2b(right.to_bytes(width, "big") + bytes([turn]) + tweak, key=self.key, digest_size=min(64, width + 4))
            left, right = right, left ^ (int.from_bytes(mixed.digest(), "big") & mask)
        return left << half | right

    def walk(self, value: int, size: int, tweak: bytes, valid: Callable[[int], bool] = lambda v: True) -> int:
        """The next value below ``size`` that is valid. ``value`` has to be so itself, which ends the walk."""
        half = max(1, ((size - 1).bit_length() + 1) // 2)
        while True:
            value = self._once(value, half, tweak)
            if value < size and valid(value):
                return value

    def moved(self, value: int, size: int, tweak: bytes) -> int:
        """``walk`` without fixed points where the size is small: there these are listed and rotated among
        themselves, and a lone one changes places with the next value, so that all stays a permutation."""
        if size > LISTED or size < 2:
            return self.walk(value, size, tweak)
        if (size, tweak) not in self.tables:
            table = [self.walk(v, size, tweak) for v in range(size)]
            fixed = [v for v in range(size) if table[v] == v]
            if len(fixed) == 1:
                other = (fixed[0] + 1) % size
                table[fixed[0]], table[other] = table[other], fixed[0]
            for v, w in zip(fixed, fixed[1:] + fixed[:1]) if len(fixed) > 1 else ():
                table[v] = w
            self.tables[size, tweak] = table
        return self.tables[size, tweak][value]


def luhn(digits: str) -> bool:
    doubled = (int(c) * (1 + k % 2) for k, c in enumerate(reversed(digits)))
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def luhn_digit(body: str) -> str:
    return next(c for c in string.digits if luhn(body + c))


def iban_rest(iban: str) -> int:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def _digits(found: str) -> str:
    return "".join(c for c in found if c.isdigit())


def _laid_out(layout: str, digits: str) -> str:
    """``layout`` with its digits replaced, separators as they were."""
    rest = iter(digits)
    return "".join(next(rest) if c.isdigit() else c for c in layout)


def _alike(c: str) -> str | None:
    """The characters that may stand for a letter or digit beyond ASCII: those of its kind and case within 64 code points."""
    if c.isascii() or not c.isalnum():
        return None
    first = ord(c) & ~63
    return "".join(x for x in map(chr, range(first, first + 64)) if (x.isalpha(), x.isdecimal(), x.islower(), x.isupper()) == (c.isalpha(), c.isdecimal(), c.islower(), c.isupper()))


def characters(p: Permutation, found: str, tweak: bytes, hexadecimal: bool = False) -> str:
    """Letters become letters of the same case and script, digits digits (or hexadecimal digits such), others stay."""
    alphabets = [string.digits + "abcdef", string.digits + "ABCDEF"] if hexadecimal else [string.digits, string.ascii_lowercase, string.ascii_uppercase]
    if hexadecimal and found.upper() == found:
        alphabets.reverse()
    of = [next((a for a in alphabets if c in a), None) or _alike(c) for c in found]
    value, size = 0, 1
    for c, a in zip(found, of):
        if a:
            value, size = value * len(a) + a.index(c), size * len(a)
    if size == 1:
        return found
    value = p.moved(value, size, tweak + bytes([len(found) % 256]))
    out = []
    for c, a in zip(reversed(found), reversed(of)):
        if a:
            value, k = divmod(value, len(a))
            c = a[k]
        out.append(c)
    return "".join(reversed(out))


def card(p, found):
    digits = _digits(found)
    if not (13 <= len(digits) <= 19 and luhn(digits)) or len(set(digits)) == 1:
        return None
    # The first digit tells the scheme and stays; the last is the check digit.
    size = 10 ** (len(digits) - 2)
    body = digits[0] + str(p.walk(int(digits[1:-1]), size, b"card" + digits[:1].encode() + bytes([len(digits)]))).zfill(len(digits) - 2)
    return _laid_out(found, body + luhn_digit(body))


def social(p, found):
    def valid(v):
        d = str(v).zfill(9)
        return d[:3] not in ("000", "666") and d[0] != "9" and d[3:5] != "00" and d[5:] != "0000"

    value = int(_digits(found))
    return _laid_out(found, str(p.walk(value, 10**9, b"social", valid)).zfill(9)) if valid(value) else None


def phone(p, found):
    digits = _digits(found)
    if not 9 <= len(digits) <= 15:
        return None
    plus = found.lstrip("(").startswith("+")
    own = 10 if plus and digits[0] == "1" and len(digits) == 11 or not plus and len(digits) == 10 else None
    if own:  # North American plan: area and exchange do not begin with 0 or 1

        def valid(v):
            d = str(v).zfill(10)
            return d[0] not in "01" and d[3] not in "01"

        if valid(int(digits[-10:])):
            return _laid_out(found, digits[:-10] + str(p.walk(int(digits[-10:]), 10**10, b"phone", valid)).zfill(10))
    if not plus and not own:
        return None
    stay = 2 if plus else 0  # the country
    return _laid_out(found, digits[:stay] + str(p.walk(int(digits[stay:]), 10 ** (len(digits) - stay), b"phone" + digits[:stay].encode())).zfill(len(digits) - stay))


def address(p, found):
    octets = [int(x) for x in found.split(".")]
    if any(x > 255 for x in octets) or any(x != str(int(x)) for x in found.split(".")):
        return None
    value = int.from_bytes(bytes(octets), "big")
    return ".".join(map(str, p.walk(value, 1 << 32, b"address").to_bytes(4, "big")))


def iban(p, found):
    plain = found.replace(" ", "")
    if not 15 <= len(plain) <= 34 or iban_rest(plain) != 1:
        return None
    body = characters(p, plain[4:], b"iban" + plain[:2].encode())
    whole = plain[:2] + f"{98 - iban_rest(plain[:2] + '00' + body):02d}" + body
    rest = iter(whole)
    return "".join(c if c == " " else next(rest) for c in found)


def day(p, found):
    sep = next(c for c in found if not c.isdigit())
    parts = found.split(sep)
    # Each layout is permuted within itself: month first only where it cannot be day first.
    layouts = {"ymd": (0, 1, 2)} if len(parts[0]) == 4 else {"dmy": (2, 1, 0), "mdy": (2, 0, 1)}

    def read(texts_, order):
        try:
            return date(*(int(texts_[k]) for k in order))
        except ValueError:
            return None

    for name, order in layouts.items():
        when = read(parts, order)
        if when is None or not 0 <= (when - FIRST_DAY).days < DAYS:
            continue
        padded = all(len(x) >= 2 for x in parts)

        def valid(v, name=name):
            d = FIRST_DAY + timedelta(v)
            return (name != "mdy" or d.day > 12) and (padded or d.day > 9 or d.month > 9 or len(found) < 10)

        value = (when - FIRST_DAY).days
        if not valid(value):
            continue
        # One day in several layouts stays one day, as far as each layout can show every day.
        new = FIRST_DAY + timedelta(p.walk(value, DAYS, b"day", valid))
        numbers = {order[0]: f"{new.year:04d}", order[1]: f"{new.month:02d}" if padded else str(new.month), order[2]: f"{new.day:02d}" if padded else str(new.day)}
        return sep.join(numbers[k] for k in range(3))
    return None


def email(p, found):
    local, _, domain = found.rpartition("@")
    return characters(p, local, b"email") + "@" + domain


def key_id(p, found):
    return found[:4] + characters(p, found[4:], b"key")


def secret(p, found):
    return characters(p, found, b"secret", hexadecimal=bool(re.fullmatch(r"(?:[0-9a-f]+|[0-9A-F]+)", found)))


@dataclass(frozen=True)
class Kind:
    """The first group, if there is one, is what is replaced; ``replace`` gives None for what is not valid."""

    name: str
    pattern: str
    replace: Callable


# In this order; what one kind has replaced no later kind looks at. Formats are fixed values.
KINDS = (
    Kind("email", r"(?<![\w.+-])[\w.+-]+@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}", email),
    Kind("key_id", r"(?<![A-Za-z0-9])A(?:KIA|SIA)[A-Z0-9]{16}(?![A-Za-z0-9])", key_id),
    Kind("secret", r"(?i:\b(?:password|passwd|pwd|secret|token|api_?key)\b)\s{0,3}[=:]\s{0,3}[\"']?(?P<secret>[A-Za-z0-9+/_\-]{6,})", secret),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", iban),
    Kind("address", r"(?<![\w.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![\w]|\.[0-9])", address),
    Kind("day", r"(?<![\w./-])(?:[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}|[0-9]{4}/[0-9]{1,2}/[0-9]{1,2}|[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}|[0-9]{1,2}-[0-9]{1,2}-[0-9]{4}|[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4})(?![\w/-])", day),
    Kind("social", r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])", social),
    Kind("card", r"(?<![\w-])[0-9](?:[ -]?[0-9]){12,18}(?![\w-])", card),
    Kind("phone", r"(?<![\w-])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)[ .-]?|[0-9]{2,4}[ .-])[0-9]{3,4}[ .-]?[0-9]{3,4}(?![\w-])|(?<![\w])\+[0-9](?:[ .-]?[0-9]){8,13}(?![\w-])", phone),
)
FOUND = re.compile("|".join(f"(?P<k{n}>{kind.pattern})" for n, kind in enumerate(KINDS)))
SINGLE = [re.compile(kind.pattern) for kind in KINDS]
HINT = re.compile(r"[\d@]|(?i:pass|pwd|secret|token|key)")


def pseudonymise(text: str, p: Permutation) -> tuple[str, int]:
    """The text with its identifiers replaced, and how many there were."""
    if not HINT.search(text):
        return text, 0
    out, at, count = [], 0, 0
    where = FOUND.search(text)
    while where:
        first = int(where.lastgroup[1:]) if where.lastgroup != "secret" else 2
        replaced = None
        for n in range(first, len(KINDS)):  # a later kind may accept what an earlier one has found
            own = where if n == first else SINGLE[n].match(text, where.start())
            if own and (replaced := KINDS[n].replace(p, own["secret"] if n == 2 else own[0])) is not None:
                start, end = own.span("secret") if n == 2 else own.span()
                break
        if replaced is None:
            where = FOUND.search(text, where.start() + 1)
            continue
        out += [text[at:start], replaced]
        at, count = end, count + 1
        where = FOUND.search(text, end)
    return "".join([*out, text[at:]]), count


def replacer(key: bytes = KEY):
    """A column function: struct(text, n_items) of a text; a null text stays null."""
    @F.pandas_udf("text string, n_items long")
    def replaced(values: pd.Series) -> pd.DataFrame:
        p = Permutation(key)
        pairs = [(None, 0) if v is None else pseudonymise(v, p) for v in values]
        return pd.DataFrame(pairs, columns=["text", "n_items"])

    return replaced


def replace_personal_data(docs: DataFrame, key: bytes = KEY, counted: str | None = "n_items") -> DataFrame:
    """The rows of ``docs``, all columns kept, with identifiers in ``text`` replaced and their number as ``counted``.

    Null and empty texts stay as they are; rows come back as they went in, equal ones equal; an empty
    table gives none. ``n_chars``, where there is one, follows the new text. A column that has the name
    ``counted`` already is an error; None adds no column.
    """
    if counted in docs.columns:
        raise ValueError(f"the input has a column {counted}: name another for the count")
    [name] = free_names(docs, "found")
    found = docs.withColumn(name, replacer(key)(F.col("text")))
    n_items = F.coalesce(F.col(f"{name}.n_items"), F.lit(0).cast("long"))
    new = {"text": F.col(f"{name}.text")} | ({counted: n_items} if counted else {})
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(n_items > 0, F.length(f"{name}.text").cast("long")).otherwise(F.col("n_chars"))
    return found.withColumns(new).drop(name)


def query(spark: SparkSession, d: str) -> DataFrame:
    return replace_personal_data(texts(documents(spark, d)))


QUERIES = {"op2_feistel_pii": query}
ORACLES: dict[str, str] = {}
