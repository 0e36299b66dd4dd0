"""Quality rules as a short-circuit cascade.

The base measures are needed of every text. The other rules are tried one after the other until one
rejects; a bounded sample tells what each costs and how many texts it rejects, and rules go by
rejection per cost. The order saves work and never changes a verdict.
"""

from __future__ import annotations

import re
import time
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import documents, texts

SPACES = " \t\n\x0b\f\r"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOLS = "#*$%&|<>"
WINDOW, MIN_WORDS, MAX_REPEAT_PERCENT = 5, 10, 20
SAMPLE_ROWS = 1000  # texts, about, from which cost and selectivity are estimated
SAMPLE_CHARS = 20_000  # a longer text is not sampled
DROP_SYMBOLS = str.maketrans("", "", SYMBOLS)


@dataclass(frozen=True)
class Rule:
    """Rejects a text by its measures, its words or itself."""

    name: str
    rejects: Callable[[dict, list, str], bool]


# Limits after published web-text filters, set so that only clear junk is beyond them.
RULES = (
    Rule("symbols_for_words", lambda m, words, text: 10 * m["n_symbols"] > 3 * m["n_words"]),
    Rule("word_length", lambda m, words, text: not 2 * m["n_words"] <= m["word_chars"] <= 25 * m["n_words"]),
    Rule("duplicate_lines", lambda m, words, text: 2 * m["n_dup_lines"] > sum(1 for x in text.split("\n") if x.strip(SPACES))),
    Rule("one_word", lambda m, words, text: 100 * Counter(words).most_common(1)[0][1] > 30 * len(words)),
    Rule("same_word_again", lambda m, words, text: 100 * sum(map(str.__eq__, words, words[1:])) > 20 * len(words)),
    Rule("no_letters", lambda m, words, text: 10 * sum(map(_has_letter, words)) < 6 * len(words)),
    Rule("ellipsis_lines", lambda m, words, text: 10 * sum(x.rstrip(SPACES).endswith(("...", "…")) for x in text.split("\n")) > 3 * (text.count("\n") + 1)),
)


def _has_letter(word: str) -> bool:
    return any(c.isalpha() for c in word)


def measures(text: str) -> tuple[dict, list[str]]:
    """The base measures of a text, and its words."""
    words = WORD.findall(text)
    seen, dup = set(), 0
    lines = text.split("\n")
    if len(lines) > 1:
        for line in lines:
            if line in seen:
                dup += 1
            elif line.strip(SPACES):
                seen.add(line)
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": len(text) - len(text.translate(DROP_SYMBOLS)),
        "n_dup_lines": dup,
        "n_repeat_words": repeated_words(words),
    }, words


def repeated_words(words: list[str], window: int = WINDOW) -> int:
    """Words that lie in some window of words found twice or more in the text."""
    import numpy as np

    n = len(words) - window + 1
    if n < 2:
        return 0
    number: dict = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    if len(number) == len(words):
        return 0
    # Windows are numbered two words at a time, so numbers stay below the count of words, exactly.
    name, width = ids, 1
    while width < window:
        step = min(width, window - width)
        pair = name[: len(words) - width - step + 1] * np.int64(len(words) + 1) + name[step : step + len(words) - width - step + 1]
        name = np.unique(pair, return_inverse=True)[1].astype(np.int64)
        width += step
    twice = np.bincount(name)[name] > 1
    if not twice.any():
        return 0
    covered = np.zeros(len(words) + 1, np.int64)
    covered[:n] += twice
    covered[window:] -= twice
    return int((np.cumsum(covered)[:-1] > 0).sum())


def base_failed(m: dict) -> bool:
    return m["n_words"] < MIN_WORDS or 100 * m["n_repeat_words"] > MAX_REPEAT_PERCENT * m["n_words"]


def cascade_order(sample: list[str], rules: tuple[Rule, ...] = RULES) -> list[int]:
    """The rules by rejections per second on the sample, best first."""
    cost, rejected, tried = [0.0] * len(rules), [0] * len(rules), 0
    for text in sample:
        m, words = measures(text)
        if base_failed(m):
            continue
        tried += 1
        for k, rule in enumerate(rules):
            began = time.thread_time()
            rejected[k] += rule.rejects(m, words, text)
            cost[k] += time.thread_time() - began
    # One rejection more than seen, out of one text more: a rule that rejected nothing goes by its cost.
    return sorted(range(len(rules)), key=lambda k: -((rejected[k] + 1) / (tried + 1)) / (cost[k] + 1e-9))


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept for each document.

    Words are runs without ASCII white space. A null or empty text has no words, fails the base and is
    not kept. Rows come back as they went in; other columns are ignored; an empty table gives none.
    """
    some = texts(docs)
    rows = some.count()
    share = min(1.0, SAMPLE_ROWS / max(1, rows))
    limit = int(share * (1 << 20)) + 1
    # Verdicts do not depend on the order, so the driver's sample may leave long texts out.
    near = some.where((F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < limit) & (F.length("text") <= SAMPLE_CHARS)).limit(2 * SAMPLE_ROWS)
    order = [rules[k] for k in cascade_order([r.text for r in near.select("text").toLocalIterator()], rules)]
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

    def verdicts(batches):
        import pyarrow as pa

        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                m, words = measures(text)
                failed = base_failed(m)
                kept = not failed and not any(rule.rejects(m, words, text) for rule in order)
                rows.append((*m.values(), failed, kept))
            columns = list(zip(*rows)) if rows else [[]] * 7
            kinds = [pa.int64()] * 5 + [pa.bool_()] * 2
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                names=["doc_id", *names, "base_failed", "kept"],
            )

    schema = "doc_id long, " + ", ".join(f"{n} long" for n in names) + ", base_failed boolean, kept boolean"
    return some.mapInArrow(verdicts, schema)


def query(spark: SparkSession, d: str) -> DataFrame:
    return judge(documents(spark, d))


QUERIES = {"op3_rule_cascade": query}
ORACLES: dict[str, str] = {}
