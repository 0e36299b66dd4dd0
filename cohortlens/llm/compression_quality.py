"""Quality scores from compression.

Two zstandard dictionaries are filled with labelled good and bad text. A text is compressed piece by
piece with either; the difference of the sizes, divided by their sum, says which of the two it is more
like. The same is done with the text's outline, in which every word is one letter, so that layout counts
and not only vocabulary. A logistic curve over these differences and the plain ratios turns them into a
calibrated score.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import materialize
from .common import documents, labels, remainder, texts
from .learning import THRESHOLD, Logistic, labelled_sample

FOLDS, HELD_OUT = 4, 2
TRAIN_ROWS = 8000  # labelled texts, about: one half fills the dictionaries, the other calibrates
PIECE = 2048  # bytes compressed at a time, so that a dictionary counts in long texts too
DICTIONARY = 112_640
LEVEL = 3
LETTERS, DIGITS = re.compile(r"[^\W\d_]+"), re.compile(r"\d+")


def outline(text: str) -> str:
    return DIGITS.sub("0", LETTERS.sub(lambda m: "A" if m[0][0].isupper() else "a", text))


class Sizes:
    """Compressed sizes of a text and its outline under both dictionaries and none."""

    def __init__(self, good: list[bytes], bad: list[bytes]):
        import zstandard

        def press(data):
            kind = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            kind.precompute_compress(level=LEVEL)
            return zstandard.ZstdCompressor(dict_data=kind, write_content_size=False)

        self.pairs = [(press(g), press(b)) for g, b in zip(good, bad)]
        self.plain = zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)

    def features(self, text: str) -> list[float]:
        found = []
        for (good, bad), view in zip(self.pairs, (text, outline(text))):
            data = view.encode("utf-8", "surrogatepass")
            pieces = [data[k : k + PIECE] for k in range(0, max(1, len(data)), PIECE)]
            g, b, p = (sum(len(c.compress(x)) for x in pieces) for c in (good, bad, self.plain))
            found += [(g - b) / (g + b), p / (len(data) + 20)]
        return [*found, float(np.log(len(text) + 1))]


def fit(docs: DataFrame, known: DataFrame, rows: int = TRAIN_ROWS) -> tuple[list[bytes], list[bytes], Logistic]:
    """Dictionaries (of the text and of the outline) of good and of bad texts, and the calibration."""
    sample = materialize(labelled_sample(texts(docs), known, "quality", FOLDS, HELD_OUT, rows))
    half = F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2))
    filled = []
    for label in (1, 0):
        # One piece from a place that the hash picks in each text; as many texts as fill a dictionary.
        place = F.pmod(F.xxhash64("doc_id"), F.greatest(F.length("text") - PIECE, F.lit(1))).cast("int") + 1
        some = sample.where((half == 0) & (F.col("label") == label) & (F.col("text") != "")).orderBy(F.xxhash64("doc_id"))
        some = some.select(F.substring("text", place, F.lit(PIECE)).alias("piece")).limit(DICTIONARY * 8 // PIECE)
        pieces = [r["piece"] for r in some.collect()] or [" " * 64]
        for view in (lambda t: t, outline):
            data = b"\n".join(view(t).encode("utf-8", "surrogatepass") for t in pieces)
            filled.append((data * (1 + 64 // len(data)))[:DICTIONARY])
    good, bad = filled[:2], filled[2:]
    rows_of = sample.where(half == 1).select("doc_id", "text", "label").mapInArrow(_measured(good, bad), "label int, features array<double>")
    measured = rows_of.collect()
    return good, bad, Logistic([r["features"] for r in measured], [r["label"] for r in measured])


def _measured(good, bad):
    def measure(batches):
        import pyarrow as pa

        sizes = Sizes(good, bad)
        for batch in batches:
            found = [sizes.features(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(2), pa.array(found, pa.list_(pa.float64()))], names=["label", "features"])

    return measure


def quality(docs: DataFrame, known: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted for each document: how likely its quality label is 1.

    Only labels of documents whose crc32(doc_id) mod 4 is not 2 are learned. A null text is empty and
    scored as such; without labels of both kinds the share of ones is everyone's score. Rows come back as
    they went in; an empty table gives none; other columns are ignored.
    """
    good, bad, curve = fit(docs, known, rows)

    def scored(batches):
        import pyarrow as pa

        sizes = Sizes(good, bad)
        for batch in batches:
            found = [sizes.features(t) for t in batch.column(2).to_pylist()]
            p = curve.score(found) if found else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(p, pa.float64()), pa.array((p >= THRESHOLD).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    marked = texts(docs).select("doc_id", (remainder(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "text")
    return marked.mapInArrow(scored, "doc_id long, held_out boolean, score double, predicted int")


def query(spark: SparkSession, d: str) -> DataFrame:
    return quality(documents(spark, d), labels(spark, d))


QUERIES = {"op5_compression_quality": query}
ORACLES: dict[str, str] = {}
