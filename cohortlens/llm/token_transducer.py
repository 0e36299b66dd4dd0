"""Token counts by a tokenizer compiled into two deterministic transducers.

The first transducer reads characters and marks where words begin: letters run together, numbers
stand alone, and an apostrophe may take one or two letters after it. It has seven states, so a chunk
of text is a map from seven states to seven; the maps of all chunks are tabulated side by side and
composed by a parallel prefix scan, which gives every chunk its state to start from.

The second one reads the bytes of a word, the last byte marked as such, and adds tokens to a count on
every transition. A sequence of tokens is what the merges make of a word exactly if they make any two
neighbours of just these two. So a prefix has one last token that goes with the last token before it,
and a state only has to hold the open paths of the vocabulary's trie, each with the token before it
and the number of tokens by then, relative to the whole prefix. States are found when they are first
met and kept in a table that is emptied when it holds too many. Words longer than a piece are read in
pieces side by side, each from the state that the bytes right before it lead to; a piece whose guess
was not what its predecessor ended in is read again, until all agree.
"""

from __future__ import annotations

import json
import re

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from .common import documents, per_worker, texts

LIMIT = 2048  # tokens above which a document is over the limit
SLAB = 1 << 18  # characters read at once; more only if no white space comes before
CHUNK = 64  # characters of which one chunk map is made
PIECE, WARM = 32, 12  # bytes in a piece of a word, and bytes before it that give its first guess
HELD_STATES = 150_000  # states above which the table is emptied before the next slab
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
SPACES = "\t\n\x0b\x0c\r \x85\xa0                　"
OUT = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"

# Classes of characters and states of the first transducer.
SPACE, LETTER, NUMBER, OTHER, QUOTE, ENDS, R, V, L, E = range(10)
FRESH, IN_LETTERS, IN_OTHERS, QUOTED, QUOTED_R, QUOTED_V, QUOTED_L = range(7)
STATES = 7
NEVER = (1 << 40, 0)  # rank and result of a pair that is not merged
FULL = {QUOTED_R: E, QUOTED_V: E, QUOTED_L: L}


def _word_table():
    """next state, whether a word begins here, whether one began with the character before; by class * 8 + state."""
    following, here, before = (np.zeros(10 * 8, np.uint8) for _ in range(3))
    letters = (LETTER, ENDS, R, V, L, E)
    for c in range(10):
        for s in range(STATES):
            at = c * 8 + s
            if s in FULL and FULL[s] == c:
                continue  # the apostrophe has taken both letters: nothing begins, any word may follow
            if s in FULL:
                before[at], s = 1, IN_LETTERS
            if c == SPACE:
                continue
            if s == QUOTED and c in (ENDS, R, V, L):
                following[at] = {ENDS: FRESH, R: QUOTED_R, V: QUOTED_V, L: QUOTED_L}[c]
            elif c in letters:
                following[at], here[at] = IN_LETTERS, s != IN_LETTERS
            elif c == NUMBER:
                here[at] = 1
            elif s in (IN_OTHERS, QUOTED):
                following[at] = IN_OTHERS
            else:
                following[at], here[at] = (QUOTED if c == QUOTE else IN_OTHERS), 1
    return following, here, before


def _classes():
    from tokenizers import Regex, pre_tokenizers

    # The library's own idea of letters and numbers, which depends on its version of Unicode.
    points = [*range(0xD800), *range(0xE000, 0x110000)]
    table, every = np.full(0x110000, OTHER, np.uint8), "".join(map(chr, points))
    points = np.array(points)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+")):
        for _, (a, b) in pre_tokenizers.Split(Regex(pattern), "removed", invert=True).pre_tokenize_str(every):
            table[points[a:b]] = kind
    table[[ord(c) for c in SPACES]] = SPACE
    table[[ord(c) for c in "stmd"]] = ENDS
    table[[ord(c) for c in "'rvle"]] = QUOTE, R, V, L, E
    return table


def _newer(classes):
    """Lower case of the letters that the tokenizer's Unicode knows and Python's does not."""
    import unicodedata
    from tokenizers import normalizers

    new = [chr(c) for c in np.flatnonzero(classes == LETTER).tolist() if unicodedata.category(chr(c)) == "Cn"]
    lower = normalizers.Lowercase()
    return {ord(c): low for c in new if (low := lower.normalize_str(c)) != c}


class Words:
    """The first transducer."""

    def __init__(self):
        self.classes, (self.following, self.here, self.before) = _classes(), _word_table()

    def starts(self, codes):
        """For each character, whether a word begins with it, and whether it is white space. The last one must be."""
        kinds = self.classes[codes]
        n = -(-len(kinds) // CHUNK)
        rows = np.zeros(n * CHUNK, np.uint8)
        rows[: len(kinds)] = kinds
        rows = np.ascontiguousarray(rows.reshape(n, CHUNK).T) << 3
        maps = np.broadcast_to(np.arange(STATES, dtype=np.uint8), (n, STATES))
        for row in rows:
            maps = self.following[row[:, None] | maps]
        state = self._scan(maps)
        begins, began = np.empty_like(rows), np.empty_like(rows)
        for k, row in enumerate(rows):
            at = row | state
            begins[k], began[k], state = self.here[at], self.before[at], self.following[at]
        found, late = (x.T.reshape(-1)[: len(kinds)] for x in (begins, began))
        found[:-1] |= late[1:]
        return found.astype(bool), kinds == SPACE

    @staticmethod
    def _scan(maps):
        """The state in which each chunk begins: maps composed over spans of 1, 2, 4, ... chunks."""
        total, span = maps.copy(), 1
        while span < len(total):
            total[span:] = np.take_along_axis(total[span:], total[:-span], axis=1)
            span *= 2
        return np.concatenate([np.zeros(1, np.uint8), total[:-1, FRESH]])


class Merges:
    """The second transducer, compiled state by state."""

    def __init__(self, path: str):
        model = _checked(json.load(open(path, encoding="utf-8")), path)
        shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
        hidden = iter(range(256, 512))
        alphabet = {chr(b) if b in shown else chr(next(hidden)): b for b in range(256)}
        end = model["end_of_word_suffix"]
        ids = {text: k for k, text in enumerate(model["vocab"])}
        self.symbols = [self._spelled(text, alphabet, end) for text in ids]
        self.base = np.full(512, -1, np.int64)
        self.child, self.token, open_nodes = {}, [-1], {0}
        for k, symbols in enumerate(self.symbols):
            if len(symbols) == 1:
                self.base[symbols[0]] = k
            node = 0
            for c in symbols:
                open_nodes.add(node)
                node = self.child.setdefault(node << 9 | c, len(self.token))
                if node == len(self.token):
                    self.token.append(-1)
            self.token[node] = k
        self.open = bytearray(len(self.token))
        for node in open_nodes:
            self.open[node] = 1
        self.merged = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.merged.setdefault(ids[a] << 32 | ids[b], (rank, ids[a + b]))
        self.tree: dict = {}
        self.clear()

    @staticmethod
    def _spelled(text, alphabet, end):
        last = text.endswith(end) and len(text) > len(end)
        symbols = [alphabet[c] for c in (text[: -len(end)] if last else text)]
        return (*symbols[:-1], symbols[-1] | last << 8)

    def clear(self):
        """Forgets all states but the first, in which a word begins."""
        first = ((0, -1, 0),)
        self.states, self.number, self.pairs = [first], {first: 0}, {}
        self._room(1 << 16)

    def _room(self, size):
        self.size, self.used = size, 0
        self.keys, self.to, self.added = np.full(size, -1, np.int64), np.zeros(size, np.int32), np.zeros(size, np.int32)

    def last_merge(self, token: int):
        """The two parts that become this token last and the rank at which they do; None if the merges,
        always the first of the pairs of least rank, do not make the token of its own symbols."""
        if token not in self.tree:
            word, last = [int(self.base[c]) for c in self.symbols[token]], (-1, -1, -1)
            while len(word) > 1:
                found = [self.merged.get(a << 32 | b, NEVER) for a, b in zip(word, word[1:])]
                rank, new = min(found)
                if rank == NEVER[0]:
                    break
                at = found.index((rank, new))
                last = (word[at], word[at + 1], rank)
                word[at : at + 2] = [new]
            self.tree[token] = last if len(word) == 1 else None
        return self.tree[token]

    def edge(self, token: int, side: int) -> list:
        """What stands at the right (1) or left (0) end of a token while it grows, and the rank that ends it."""
        found, until = [], NEVER[0]
        while token >= 0:
            found.append((token, until))
            *parts, until = self.last_merge(token)
            token = parts[side]
        return found[::-1]

    def together(self, before: int, token: int) -> bool:
        """Whether the merges leave these two tokens, or the one alone, as they are.

        Merges go by rank, and a pair never ranks before the merges that made its parts. So the two grow as
        they would alone, until a pair across their border ranks before the next growth of either.
        """
        key = before << 32 | token
        known = self.pairs.get(key)
        if known is None:
            known = self.last_merge(token) is not None
            if known and before >= 0:
                left, right, i, j = self.edge(before, 1), self.edge(token, 0), 0, 0
                while i < len(left) and j < len(right):
                    (a, a_ends), (b, b_ends) = left[i], right[j]
                    rank = self.merged.get(a << 32 | b, NEVER)[0]
                    if rank < a_ends and rank <= b_ends and rank < NEVER[0]:
                        known = False
                        break
                    if a_ends == b_ends == NEVER[0]:
                        break
                    i, j = (i + 1, j) if a_ends <= b_ends else (i, j + 1)
            self.pairs[key] = known
        return known

    def step(self, state: int, symbol: int) -> tuple[int, int]:
        """The next state and the tokens added by one symbol; after the last byte of a word, the first state."""
        paths, last, count = [], -1, 0
        for node, before, tokens in self.states[state]:
            node = self.child.get(node << 9 | symbol)
            if node is None:
                continue
            token = self.token[node]
            if token >= 0 and self.together(before, token):
                last, count = token, tokens + 1
            if self.open[node]:
                paths.append((node, before, tokens))
        if symbol >> 8:
            return 0, count
        found = (*((node, before, tokens - count) for node, before, tokens in paths), (0, last, 0))
        number = self.number.setdefault(found, len(self.states))
        if number == len(self.states):
            self.states.append(found)
        return number, count

    def steps(self, state, symbol):
        """``step`` for arrays, by the table; what it lacks is found and entered."""
        key = state.astype(np.int64) << 9 | symbol
        at = self._places(key)
        new = np.flatnonzero(self.keys[at] < 0)
        if len(new):
            self._enter(np.unique(key[new]))
            at = self._places(key)
        return self.to[at], self.added[at]

    def _hash(self, key):
        return (key * np.int64(0x9E3779B97F4A7C1) >> np.int64(20)) & np.int64(self.size - 1)

    def _places(self, key):
        """Where each key is in the table, or the free place where it would be."""
        at = self._hash(key)
        todo = np.flatnonzero((self.keys[at] != key) & (self.keys[at] >= 0))
        while len(todo):
            at[todo] = (at[todo] + 1) & (self.size - 1)
            held = self.keys[at[todo]]
            todo = todo[(held != key[todo]) & (held >= 0)]
        return at

    def _enter(self, key):
        """Finds the steps for distinct new keys and puts them into the table, which grows when half full."""
        found = np.array([self.step(k >> 9, k & 511) for k in key.tolist()], np.int32).reshape(-1, 2)
        if 2 * (self.used + len(key)) > self.size:
            held = np.flatnonzero(self.keys >= 0)
            old = self.keys[held], np.stack([self.to[held], self.added[held]], 1)
            self._room(1 << int(4 * (self.used + len(key))).bit_length())
            self._put(*old)
        self._put(key, found)

    def _put(self, key, found):
        self.used += len(key)
        while len(key):
            at = self._places(key)
            self.keys[at] = key  # of several at one free place one stays, the others try again
            won = self.keys[at] == key
            self.to[at[won]], self.added[at[won]] = found[won].T
            key, found = key[~won], found[~won]

    def run(self, data, start, length, state, last):
        """End state and tokens of pieces of ``data``, each read from its state; ``last``: its end is a word's end."""
        order = np.argsort(-length, kind="stable")
        start, length, last = start[order], length[order], last[order]
        state, count = state[order].astype(np.int64), np.zeros(len(order), np.int64)
        for k in range(int(length[0]) if len(length) else 0):
            n = int(np.searchsorted(-length, -k))
            symbol = data[start[:n] + k].astype(np.int64) | ((length[:n] == k + 1) & last[:n]).astype(np.int64) << 8
            state[:n], added = self.steps(state[:n], symbol)
            count[:n] += added
        back = np.empty_like(order)
        back[order] = np.arange(len(order))
        return state[back], count[back]

    def counts(self, data, offset):
        """The number of tokens of each word data[offset[k]:offset[k + 1]]."""
        length = np.diff(offset)
        parts = -(-length // PIECE)
        word = np.repeat(np.arange(len(length)), parts)
        part = np.arange(len(word)) - np.repeat(np.cumsum(parts) - parts, parts)
        start = offset[:-1][word] + part * PIECE
        size = np.minimum(length[word] - part * PIECE, PIECE)
        last, later = part == parts[word] - 1, np.flatnonzero(part)
        state = np.zeros(len(word), np.int64)
        warm = np.full(len(later), WARM)
        state[later], _ = self.run(data, start[later] - WARM, warm, state[later], warm < 0)
        end, count = self.run(data, start, size, state, last)
        while len(wrong := later[state[later] != end[later - 1]]):
            state[wrong] = end[wrong - 1]
            end[wrong], count[wrong] = self.run(data, start[wrong], size[wrong], state[wrong], last[wrong])
        return np.bincount(word, count, len(length)).astype(np.int64)


def _checked(spec: dict, path: str) -> dict:
    """The model part of a tokenizer file, if it is of the one kind that the transducers stand for."""
    model = spec["model"]
    splits = [p.get("pattern") for p in (spec["pre_tokenizer"] or {}).get("pretokenizers", [])]
    kinds = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
    plain = not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "byte_fallback", "ignore_merges"))
    if kinds != ["NFC", "Replace", "Lowercase"] or splits[:1] != [{"Regex": WORDS}] or not model.get("end_of_word_suffix") or not plain:
        raise ValueError(f"{path} is not a lower-casing byte-pair tokenizer with word ends")
    return model


class Counter:
    """Token counts of texts: both transducers, special strings and normal forms."""

    def __init__(self, path: str):
        special = [t["content"] for t in json.load(open(path, encoding="utf-8"))["added_tokens"]]
        self.special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True))) or r"(?!)")
        self.words, self.merges = Words(), Merges(path)
        self.newer = _newer(self.words.classes)
        self.unlike = re.compile("[" + "".join(map(chr, self.newer)) + "]") if self.newer else re.compile(r"(?!)")

    def counts(self, some: list[str]):
        total, slab, owner, room = np.zeros(len(some), np.int64), [], [], 0
        for k, text in enumerate(some):
            if "<" in text:
                text, total[k] = self.special.subn(" ", text)
            for part in _parts(text):
                slab.append(part.replace("\n", " "))
                owner.append(k)
                room += len(part)
                if room >= SLAB:
                    np.add.at(total, owner, self._slab(slab))
                    slab, owner, room = [], [], 0
        if slab:
            np.add.at(total, owner, self._slab(slab))
        return total

    def _slab(self, parts: list[str]):
        import pyarrow as pa
        from unicodedata import is_normalized, normalize

        if len(self.merges.states) > HELD_STATES:
            self.merges.clear()
        body = "\n".join(parts) + "\n"
        if not is_normalized("NFC", body):
            body = normalize("NFC", body)
        body = body.replace("Σ", "σ").lower()  # letter by letter: a last sigma is not told apart
        if self.unlike.search(body):
            body = body.translate(self.newer)
        codes = np.frombuffer(body.encode("utf-32-le"), np.uint32)
        begins, space = self.words.starts(codes)
        data = np.frombuffer(body.encode(), np.uint8)
        width = 1 + (codes >= 0x80) + (codes >= 0x800) + (codes >= 0x10000)
        data = data[np.repeat(~space, width)]
        width[space] = 0
        first = np.flatnonzero(begins)
        reached = np.cumsum(width) - width
        offset = np.append(reached[first], len(data)).astype(np.int32)
        found = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(offset), pa.py_buffer(np.ascontiguousarray(data))]).dictionary_encode()
        distinct = found.dictionary
        spans = np.frombuffer(distinct.buffers()[1], np.int32, len(distinct) + 1).astype(np.int64) if len(distinct) else np.zeros(1, np.int64)
        bodies = np.frombuffer(distinct.buffers()[2], np.uint8) if len(distinct) else np.zeros(0, np.uint8)
        counts = self.merges.counts(bodies, spans)
        of = np.searchsorted(np.flatnonzero(codes == 10), first)
        return np.bincount(of, counts[found.indices.to_numpy(zero_copy_only=False)], len(parts)).astype(np.int64)


def _parts(text: str):
    """A text in parts of about SLAB characters, cut before white space: neither words nor normal forms reach across."""
    start = 0
    while len(text) - start > SLAB:
        cut = re.compile(r"\s").search(text, start + SLAB)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def token_counts(docs: DataFrame, path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """One row per document: doc_id, n_bytes (UTF-8), n_tokens and over_limit (n_tokens > limit).

    The count is that of the tokenizers library without added special tokens; special strings inside a
    text count one each. A null or empty text has no bytes and no tokens; repeated rows come back as often
    as they went in, null doc_ids are carried along, other columns are ignored, an empty table gives none.
    """
    path = path or default_tokenizer()

    def count(batches):
        import pyarrow as pa

        counter = per_worker(f"counter {path}", lambda: Counter(path))
        for batch in batches:
            some = batch.column(1).to_pylist()
            n = counter.counts(some)
            sizes = pa.array([len(t.encode()) for t in some], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), sizes, pa.array(n), pa.array(n > limit)], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return texts(docs).mapInArrow(count, OUT)


def query(spark: SparkSession, d: str) -> DataFrame:
    return token_counts(documents(spark, d))


QUERIES = {"op13_token_transducer": query}
ORACLES: dict[str, str] = {}
