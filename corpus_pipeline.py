"""A training-data pipeline over the corpus operators: filter, deduplicate, pseudonymise, pack."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cohortlens.llm.common import documents, labels, prepare
from cohortlens.llm.content_sort import keep_last
from cohortlens.llm.feistel_pii import replace_personal_data
from cohortlens.llm.simhash_vp import keep_one
from cohortlens.llm.stock_packing import pack
from cohortlens.llm.toxic_grammar import reject_toxic
from cohortlens.session import configure, materialize

# Workers serve all stages and keep what each has made them grow to, so batches are smaller than for one operator.
BATCH_ROWS, BATCH_BYTES = 700, 6 << 20


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity grammar does not reject; it learns from the labels of this very input.

    All columns of ``docs`` come back; a null text is judged as an empty one; an empty table stays empty."""
    prepare(spark, BATCH_ROWS, BATCH_BYTES)
    return reject_toxic(docs, labels(spark, sf_dir))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the largest doc_id, of those whose texts are equal but for the case of A-Z.

    A null text equals an empty one, a null doc_id is the smallest; of rows that repeat doc_id and text one stays."""
    prepare(spark, BATCH_ROWS, BATCH_BYTES)
    return keep_last(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest doc_id, of each group of texts whose fingerprints of three-word
    shingles are linked by steps of at most two bits.

    A null or wordless text has fingerprint 0 and is linked like any other; a null doc_id is the smallest."""
    prepare(spark, BATCH_ROWS, BATCH_BYTES)
    return keep_one(docs)


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in their texts replaced by pseudonyms of the same format.

    Null and empty texts stay as they are; n_chars follows the new text."""
    prepare(spark, BATCH_ROWS, BATCH_BYTES)
    return replace_personal_data(docs, counted=None)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in training sequences; a null text is empty and packed as its end id."""
    prepare(spark, BATCH_ROWS, BATCH_BYTES)
    return pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("near dedup", drop_near_copies),
    ("personal data", hide_personal_data),
    ("packing", pack_sequences),
]

# The stages learn, link fingerprints and tokenize, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other; what each leaves is stored as Parquet in the shared folder."""
    configure(spark)
    docs = documents(spark, sf_dir)
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = materialize(docs)
    return docs
