"""SentencePiece encoding and decoding by vectorised merge rounds.

Texts are cut where no piece of the vocabulary can reach across (before a run of spaces, around
characters that no longer piece holds). The distinct words of a batch lie in one flat symbol array;
each round looks up the best pair of every word at once (a segmented minimum), merges it and closes
the gaps, until no word has a pair left. Nothing depends on a word's position, so tasks need neither
a shuffle nor each other.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from .common import documents, per_worker, texts

SPACE = "▁"
NONE = np.int32(2**31 - 1)
CHUNK_BYTES = 4 << 20
CODE_POINTS = 0x110000


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Pieces:
    """The vocabulary of a SentencePiece BPE model with byte fallback, as flat arrays."""

    def __init__(self, model: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        size = sp.get_piece_size()
        names = [sp.id_to_piece(i) for i in range(size)]
        self.begin, self.end = sp.bos_id(), sp.eos_id()
        normal = [i for i in range(size) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))]
        self.byte_id = np.array([sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32)
        symbol = {names[i]: i for i in normal}
        reach = {c for i in normal if len(names[i]) > 1 for c in names[i]}
        for c in sorted(reach - symbol.keys()):  # characters that occur inside pieces only
            symbol[c] = size + len(symbol)
        if any(SPACE in names[i].lstrip(SPACE) for i in normal):
            raise ValueError("a piece reaches across a space; texts cannot be cut into words")
        self.of_char = np.full(CODE_POINTS, -1, np.int32)
        for s, i in symbol.items():
            if len(s) == 1:
                self.of_char[ord(s)] = i
        self.of_char[0x20] = self.of_char[ord(SPACE)]
        self.alone = np.zeros(256, bool)  # ASCII characters that never merge
        self.alone[:128] = [chr(b) not in reach and b != 0x20 for b in range(128)]
        order = sorted((i for i in normal if len(names[i]) > 1), key=lambda i: (-sp.get_score(i), i))
        rank = {i: r for r, i in enumerate(order)}
        pairs = [
            (symbol[a] << 32 | symbol[b], rank[i], i, symbol[a], symbol[b])
            for i in order
            for k in range(1, len(names[i]))
            if (a := names[i][:k]) in symbol and (b := names[i][k:]) in symbol
        ]
        pairs.sort()
        self.key = np.array([p[0] for p in pairs] or [0], np.int64)
        self.rank = np.array([p[1] for p in pairs] or [NONE], np.int32)
        self.merged = np.array([p[2] for p in pairs] or [0], np.int32)
        # If a longer piece that starts or ends with this one comes before it in rank, its occurrences
        # in a word must be merged one after the other.
        one_by_one = {s for _, r, _, a, b in pairs for s in (a, b) if rank.get(s, -1) > r}
        self.single = np.isin(self.merged, list(one_by_one))
        known = set(normal)
        spelled = [
            bytes([int(names[i][3:5], 16)]) if sp.is_byte(i)
            else names[i].replace(SPACE, " ").encode() if i in known
            else b" \xe2\x81\x87 " if sp.is_unknown(i) else b""
            for i in range(size)
        ]
        self.spelled = np.frombuffer(b"".join(spelled), np.uint8)
        self.spelled_length = np.array([len(x) for x in spelled], np.int64)
        self.spelled_start = np.cumsum(self.spelled_length) - self.spelled_length

    def look_up(self, a, b):
        """Rank, merged piece and one-by-one flag of each pair of symbols (rank NONE: not a piece)."""
        wanted = a.astype(np.int64) << 32 | b
        at = np.minimum(np.searchsorted(self.key, wanted), len(self.key) - 1)
        return np.where((self.key[at] == wanted) & (a >= 0) & (b >= 0), self.rank[at], NONE), at


def ragged(flat, start, length):
    """The slices ``flat[start : start + length]`` one after the other."""
    out = np.cumsum(length)
    total = int(out[-1]) if len(out) else 0
    return flat[np.repeat(start - (out - length), length) + np.arange(total)]


def merge_rounds(pieces: Pieces, code_points, lengths):
    """Piece ids of all words and the number of ids of each. ``lengths``: code points of each word, 1 or more."""
    symbol, word = pieces.of_char[code_points], np.repeat(np.arange(len(lengths)), lengths)
    # What is not in the vocabulary keeps its code point as a negative number.
    symbol = np.where(symbol < 0, -1 - code_points.astype(np.int32), symbol)
    done: list = []
    rank, at = np.full(len(symbol), NONE), np.zeros(len(symbol), np.int64)
    rank[:-1], at[:-1] = pieces.look_up(symbol[:-1], symbol[1:])
    rank[:-1][word[:-1] != word[1:]] = NONE
    while len(symbol):
        first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        count = np.diff(np.r_[first, len(word)])
        best = np.minimum.reduceat(rank, first)
        over = best == NONE
        if over.any():
            gone = np.repeat(over, count)
            done.append((word[gone], symbol[gone]))
            stay = ~gone
            symbol, word, rank, at = symbol[stay], word[stay], rank[stay], at[stay]
            best, count = best[~over], count[~over]
            if not len(symbol):
                break
        hit = np.flatnonzero(rank == np.repeat(best, count))
        # Of overlapping occurrences (aaa) the leftmost comes first, then every other one.
        run = np.r_[True, (hit[1:] != hit[:-1] + 1) | (word[hit[1:]] != word[hit[:-1]])]
        since = np.arange(len(hit)) - np.maximum.accumulate(np.where(run, np.arange(len(hit)), 0))
        leftmost = np.r_[True, word[hit[1:]] != word[hit[:-1]]]
        hit = hit[np.where(pieces.single[at[hit]], leftmost, since % 2 == 0)]
        symbol[hit] = pieces.merged[at[hit]]
        stay = np.ones(len(symbol), bool)
        stay[hit + 1] = False
        new = hit - np.arange(len(hit))  # where the merged symbols lie once the gaps are closed
        symbol, word, rank, at = symbol[stay], word[stay], rank[stay], at[stay]
        again = np.union1d(new, new[new > 0] - 1)
        rank[again] = NONE
        again = again[again + 1 < len(symbol)]
        again = again[word[again] == word[again + 1]]
        rank[again], at[again] = pieces.look_up(symbol[again], symbol[again + 1])
    word, symbol = (np.concatenate([d[k] for d in done]) if done else np.zeros(0, np.int64) for k in (0, 1))
    order = np.argsort(word, kind="stable")
    word, symbol = word[order], symbol[order]
    size = len(pieces.spelled_length)
    loose = (symbol < 0) | (symbol >= size)
    if loose.any():  # byte fallback
        back = np.zeros(int(max(symbol.max() + 1, 1)), np.int64)
        inside = np.flatnonzero(pieces.of_char >= size)
        back[pieces.of_char[inside][pieces.of_char[inside] < len(back)]] = inside[pieces.of_char[inside] < len(back)]
        chars = np.where(symbol[loose] < 0, -1 - symbol[loose], back[np.maximum(symbol[loose], 0)])
        width = np.ones(len(symbol), np.int64)
        width[loose] = 1 + (chars >= 0x80) + (chars >= 0x800) + (chars >= 0x10000)
        ids = np.repeat(symbol, width)
        ids[np.repeat(loose, width)] = pieces.byte_id[np.frombuffer("".join(map(chr, chars)).encode("utf-8", "surrogatepass"), np.uint8)]
        word, symbol = np.repeat(word, width), ids
    return symbol.astype(np.int32), np.bincount(word, minlength=len(lengths))


def encode(pieces: Pieces, some: list[str]):
    """Flat ids of all texts, without begin and end, and the number of ids of each text."""
    import pyarrow as pa

    bodies = [b" " + t.replace(SPACE, " ").encode("utf-8", "surrogatepass") if t else b"" for t in some]
    data = np.frombuffer(b"".join(bodies), np.uint8)
    if not len(data):
        return np.zeros(0, np.int32), np.zeros(len(some), np.int64)
    text_end = np.cumsum([len(b) for b in bodies])
    starts = np.zeros(len(data) + 1, bool)
    starts[1:-1] = (data[1:] == 0x20) & (data[:-1] != 0x20)
    alone = pieces.alone[data]
    starts[:-1] |= alone
    starts[1:] |= alone
    starts[0] = True
    starts[text_end] = True
    offset = np.flatnonzero(starts)
    words = pa.StringArray.from_buffers(len(offset) - 1, pa.py_buffer(offset.astype(np.int32)), pa.py_buffer(data)).dictionary_encode()
    index, distinct = words.indices.to_numpy(zero_copy_only=False), words.dictionary.to_pylist()
    lengths = np.fromiter(map(len, distinct), np.int64, len(distinct))
    points = np.frombuffer("".join(distinct).encode("utf-32-le", "surrogatepass"), np.uint32)
    ids, count = merge_rounds(pieces, points, lengths)
    start = np.cumsum(count) - count
    per_word = np.r_[0, np.cumsum(count[index])]
    reached = per_word[np.searchsorted(offset, text_end)]
    return ragged(ids, start[index], count[index]), np.diff(np.r_[0, reached])


def decode(pieces: Pieces, ids, counts) -> list[str]:
    """The text of each run of ids; begin and end add nothing, the space put before a text goes."""
    length = pieces.spelled_length[ids]
    data = ragged(pieces.spelled, pieces.spelled_start[ids], length).tobytes()
    ends = np.r_[0, np.cumsum(length)][np.r_[0, np.cumsum(counts)]].tolist()
    whole = (data[a:b] for a, b in zip(ends, ends[1:]))
    return [(x[1:] if x[:1] == b" " else x).decode("utf-8", "replace") for x in whole]


def piece_ids(docs: DataFrame, model: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 for each document, ids with begin and end.

    A null or empty text has only those two ids and decodes to the empty text. Rows come back as they
    went in, repeated or not; other columns are ignored.
    """
    path = model or default_model()

    def digests(batches):
        import pyarrow as pa

        pieces = per_worker(f"pieces:{path}", lambda: Pieces(path))
        for batch in batches:
            doc_ids, some = batch.column(0), batch.column(1).to_pylist()
            n, ids_sha, text_sha = [], [], []
            for chunk in chunks(some):
                ids, counts = encode(pieces, chunk)
                n += (counts + 2).tolist()
                at = 0
                edge = [np.array([x], "<u4").tobytes() for x in (pieces.begin, pieces.end)]
                raw = ids.astype("<u4")
                for count in counts.tolist():
                    ids_sha.append(hashlib.sha256(edge[0] + raw[at : at + count].tobytes() + edge[1]).hexdigest())
                    at += count
                text_sha += [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in decode(pieces, ids, counts)]
            yield pa.RecordBatch.from_arrays(
                [doc_ids, pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return texts(docs).mapInArrow(digests, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def chunks(some: list[str]):
    """Runs of texts of some megabytes; a longer text is a run of its own."""
    held, size = [], 0
    for t in some:
        if held and size + len(t) > CHUNK_BYTES:
            yield held
            held, size = [], 0
        held.append(t)
        size += len(t)
    if held:
        yield held


def query(spark: SparkSession, d: str) -> DataFrame:
    return piece_ids(documents(spark, d))


QUERIES = {"op1_piece_merge": query}
ORACLES: dict[str, str] = {}
