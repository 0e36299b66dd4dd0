import pytest

from cohortlens.llm.common import prepare

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def make(spark):
    """A documents table from (doc_id, text) pairs; with ``clash`` it has columns of names used inside too."""
    prepare(spark)

    def build(pairs, clash=False, parts=3):
        rows = [(i, t, None, "s", len(t) if t is not None else None) for i, t in pairs]
        df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
        if clash:
            df = df.selectExpr("*", "1 AS part", "'x' AS body", "2 AS fp", "3 AS n", "'y' AS key_id", "4 AS score", "5 AS keep_id", "6 AS at", "7 AS word", "8 AS label", "9 AS found", "10 AS _found", "11 AS id", "12 AS _id", "13 AS sha", "14 AS _sha", "15 AS key_text", "16 AS _key_id", "17 AS toxic_score", "18 AS _toxic_score")
        return df

    return build


# Nulls, empty and wordless texts, ties, repeated rows, a very long text, white space and other scripts.
@pytest.fixture
def odd():
    return [
        (1, None), (2, ""), (3, " \t\n"), (None, "a lone row"), (None, None), (4, "Same words here"), (5, "same WORDS here"),
        (6, "same words here"), (6, "same words here"), (7, "word " * 30_000), (8, "x" * 50_000), (9, "日本語 テキスト 😀\n▁ ﬁ"),
        (10, "one"), (11, "one two"), (12, "a\x0bb\x0cc d e"), (13, "#" * 100 + "\n" + "#" * 100),
    ]


@pytest.fixture
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")
