"""Toxicity scores from a weighted finite-state grammar.

Words become symbols: insult, threat, target, negation, reporting verb, boundary, other. Small
weighted transducers, for negation, for reported speech and for weighing what matches, are composed
into one machine, which reads a text clause by clause; what counts is a matched clause, say an insult with
a target that is neither denied nor quoted, not the word alone. Insults are learned: word stems whose
texts are labelled toxic far more often than others. The other word lists are fixed. A logistic curve
turns the clause weights of a text into a score.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import materialize
from .common import documents, free_names, labels, remainder, texts
from .learning import THRESHOLD, Logistic, labelled_sample

FOLDS, HELD_OUT = 3, 1
TRAIN_ROWS = 8000  # labelled texts, about, from which insults and the curve are learned
STEM_LENGTHS = (3, 8)  # characters of the word beginnings that are tried besides whole words
MAX_STEMS = 5000
LEAST_EVIDENCE, LEAST_SHARE, LEAST_TEXTS, LEAST_WORDS = 12.0, 0.7, 4, 3
HELD_WORDS = 200_000
INSULT, THREAT, TARGET, NEGATION, REPORT, OTHER, BOUNDARY = "insult", "threat", "target", "negation", "report", "other", "boundary"
DENIED, QUOTED = "denied", "quoted"
TOKEN = re.compile(r"\w+|[.!?;\n]")

# Closed word classes of the grammar in English, German, French and Spanish.
WORDS = {
    TARGET: "you your yours yourself u ur du dich dir dein deine euch tu te toi ton ta vous votre vos tú ti usted ustedes vosotros",
    NEGATION: "not no never isn aren wasn nobody without nicht kein keine nie niemals ne pas jamais sans nunca jamás tampoco sin",
    REPORT: "said says say told called calls wrote writes quoted reported claimed sagte sagt schrieb nannte dit disait écrit appelé dijo dice escribió llamó",
    THREAT: "kill hurt destroy stab shoot beat töten umbringen schlagen tuer frapper détruire matar golpear destruir",
}


@dataclass
class Transducer:
    """Arcs (state, symbol) -> (state, symbol written, weight); a symbol without an arc is passed on."""

    arcs: dict
    start: int = 0
    resting: dict = field(default_factory=dict)

    def step(self, state, symbol):
        return self.arcs.get((state, symbol)) or (self.resting.get(state, state), symbol, 0.0)


def compose(first: Transducer, second: Transducer, symbols) -> Transducer:
    """The machine that feeds what the first one writes to the second one."""
    number, arcs, todo = {(first.start, second.start): 0}, {}, [(first.start, second.start)]
    while todo:
        pair = todo.pop()
        for symbol in symbols:
            a, middle, w = first.step(pair[0], symbol)
            b, out, v = second.step(pair[1], middle)
            if (a, b) not in number:
                number[(a, b)] = len(number)
                todo.append((a, b))
            arcs[(number[pair], symbol)] = (number[(a, b)], out, w + v)
    return Transducer(arcs)


def grammar() -> Transducer:
    """Negation, reported speech, targets and weights in one machine. A clause ends at a boundary."""
    symbols = (INSULT, THREAT, TARGET, NEGATION, REPORT, OTHER, BOUNDARY)
    # A negation reaches three words far: states count down.
    negation = Transducer(
        {(s, NEGATION): (3, NEGATION, 0.0) for s in range(4)}
        | {(s, x): (s - 1, DENIED, 0.0) for s in (1, 2, 3) for x in (INSULT, THREAT)}
        | {(s, BOUNDARY): (0, BOUNDARY, 0.0) for s in range(4)},
        resting={1: 0, 2: 1, 3: 2},
    )
    # What follows a reporting verb in its clause is somebody else's.
    reported = Transducer(
        {(s, REPORT): (1, REPORT, 0.0) for s in (0, 1)}
        | {(1, x): (1, QUOTED, 0.0) for x in (INSULT, THREAT)}
        | {(s, BOUNDARY): (0, BOUNDARY, 0.0) for s in (0, 1)}
    )
    # States of the weighing: 0 plain, 1 target seen, 2 matched, 3 matched with target, 4 a threat so far at nobody.
    weighing = Transducer(
        {(0, TARGET): (1, TARGET, 0.0), (2, TARGET): (3, TARGET, 0.5), (4, TARGET): (3, TARGET, 1.0)}
        | {(s, INSULT): (t, INSULT, w) for s, t, w in ((0, 2, 1.0), (1, 3, 1.5), (2, 2, 1.0), (3, 3, 1.0), (4, 2, 1.0))}
        | {(s, THREAT): (t, THREAT, w) for s, t, w in ((0, 4, 0.0), (1, 3, 1.0), (2, 2, 0.5), (3, 3, 1.0))}
        | {(s, x): (s, x, 0.2) for s in range(5) for x in (DENIED, QUOTED)}
        | {(s, BOUNDARY): (0, BOUNDARY, 0.0) for s in range(5)}
    )
    return compose(compose(negation, reported, symbols), weighing, symbols)


class Reader:
    """Clause weights of texts under the grammar and a lexicon {stem: weight} (``$`` ends a whole word)."""

    def __init__(self, lexicon: dict[str, float]):
        self.lexicon, self.machine, self.held = lexicon, grammar(), {}
        self.fixed = {w: (kind, 1.0) for kind, words in WORDS.items() for w in words.split()}

    def symbol(self, word: str):
        found = self.held.get(word)
        if found is None:
            if len(self.held) >= HELD_WORDS:
                self.held.clear()
            weight = max((self.lexicon.get(x, 0.0) for x in stems(word)), default=0.0)
            found = (INSULT, weight) if weight else self.fixed.get(word, (OTHER, 0.0))
            self.held[word] = found
        return found

    def clauses(self, text: str) -> list[float]:
        """The weight of each clause that has a match."""
        low = text.lower()
        if not any(self.symbol(w)[0] in (INSULT, THREAT) for w in set(TOKEN.findall(low))):
            return []
        found, state, weight = [], self.machine.start, 0.0
        for token in TOKEN.findall(low) + ["."]:
            kind, strength = (BOUNDARY, 0.0) if token in ".!?;\n" else self.symbol(token)
            state, _, arc = self.machine.step(state, kind)
            weight += arc * (strength if kind == INSULT else 1.0)
            if kind == BOUNDARY:
                if weight:
                    found.append(weight)
                weight = 0.0
        return found

    def features(self, text: str) -> list[float]:
        weights = self.clauses(text)
        return [float(np.log1p(sum(weights))), max(weights, default=0.0)]


def stems(word: str) -> list[str]:
    return [word[:k] for k in range(STEM_LENGTHS[0], min(STEM_LENGTHS[1], len(word)) + 1)] + [word + "$"]


def learn_lexicon(sample: DataFrame) -> dict[str, float]:
    """Stems that tell toxic texts: {stem: weight}, at most MAX_STEMS. ``sample``: text, label."""
    share = sample.agg(F.avg("label")).first()[0]
    if not share or share >= 1:
        return {}
    words = sample.select("label", F.explode(F.array_distinct(F.expr(r"regexp_extract_all(lower(text), '(?U)\\w+', 0)"))).alias("word"))
    words = words.groupBy("word").agg(F.sum("label").alias("toxic"), F.count("*").alias("n"))
    low, high = STEM_LENGTHS
    beginnings = F.expr(f"transform(sequence({low}, greatest({low}, least({high}, length(word)))), k -> substring(word, 1, k))")
    whole = F.array(F.concat("word", F.lit("$")))
    stemmed = words.select("toxic", "n", F.explode(F.when(F.length("word") >= low, F.concat(beginnings, whole)).otherwise(whole)).alias("stem"))
    # The beginning of one word only is not a stem: it would stand for words that nobody has seen.
    shared = F.col("stem").endswith("$") | ((F.count_if(F.col("toxic") > 0) >= LEAST_WORDS) & (F.max("toxic") <= 0.7 * F.sum("toxic")))
    counts = stemmed.groupBy("stem").agg(F.sum("toxic").alias("toxic"), F.sum("n").alias("n"), shared.alias("shared"))
    counts = counts.where(F.col("shared") & (F.col("toxic") >= LEAST_TEXTS))
    p = (F.col("toxic") + 0.5) / (F.col("n") + 1)
    evidence = F.col("toxic") * F.log(p / share) + (F.col("n") - F.col("toxic")) * F.log((1 - p) / (1 - share))
    best = counts.withColumns({"p": p, "evidence": evidence}).where((F.col("p") >= LEAST_SHARE) & (F.col("evidence") >= LEAST_EVIDENCE))
    lexicon: dict[str, float] = {}
    shares: dict[str, float] = {}
    for row in sorted(best.orderBy(F.desc("evidence"), "stem").limit(MAX_STEMS).collect(), key=lambda r: len(r["stem"])):
        shorter = [shares[x] for x in stems(row["stem"].rstrip("$")) if x in shares and x != row["stem"]]
        if not shorter or row["p"] > max(shorter) + 0.02:  # else a shorter stem says as much
            shares[row["stem"]] = row["p"]
            lexicon[row["stem"]] = float(min(2.0, max(0.2, np.log(row["p"] / (1 - row["p"])) / 3)))
    return lexicon


def fit(docs: DataFrame, known: DataFrame, rows: int = TRAIN_ROWS) -> tuple[dict[str, float], Logistic]:
    sample = materialize(labelled_sample(texts(docs), known, "toxic", FOLDS, HELD_OUT, rows))
    lexicon = learn_lexicon(sample)

    def measure(batches):
        import pyarrow as pa

        reader = Reader(lexicon)
        for batch in batches:
            found = [reader.features(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(2), pa.array(found, pa.list_(pa.float64()))], names=["label", "features"])

    measured = sample.mapInArrow(measure, "label int, features array<double>").collect()
    return lexicon, Logistic([r["features"] for r in measured], [r["label"] for r in measured])


def scorer(lexicon: dict[str, float], curve: Logistic):
    """A column function that scores texts; a null text counts as empty."""

    @F.pandas_udf("double")
    def scored(values: Iterator[pd.Series]) -> Iterator[pd.Series]:
        reader = Reader(lexicon)
        for some in values:
            found = [reader.features(t) for t in some]
            yield pd.Series(curve.score(found) if found else np.zeros(0))

    def score(text: Column) -> Column:
        return scored(F.coalesce(text, F.lit("")))

    return score


def toxicity(docs: DataFrame, known: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted for each document: how likely its toxic label is 1.

    Only labels of documents whose crc32(doc_id) mod 3 is not 1 are learned. A null or empty text has no
    clause and gets the score of such texts; without labels of both kinds the share of ones is everyone's
    score. Rows come back as they went in; an empty table gives none; other columns are ignored.
    """
    score = scorer(*fit(docs, known, rows))
    marked = texts(docs).select("doc_id", (remainder(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), score(F.col("text")).alias("score"))
    return marked.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def reject_toxic(docs: DataFrame, known: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """The rows of ``docs``, with all their columns of whatever name, that are not predicted toxic.

    A null text is scored as an empty one; repeated rows stay or go together; without labels or on an
    empty table the curve is the one that ``fit`` gives for no rows.
    """
    score, [name] = scorer(*fit(docs, known, rows)), free_names(docs, "toxic_score")
    return docs.withColumn(name, score(F.col("text"))).where(F.col(name) < THRESHOLD).drop(name)


def query(spark: SparkSession, d: str) -> DataFrame:
    return toxicity(documents(spark, d), labels(spark, d))


QUERIES = {"op4_toxic_grammar": query}
ORACLES: dict[str, str] = {}
