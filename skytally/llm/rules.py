"""Quality rules as a short-circuit cascade.

Each rule says of one text whether it is rejected.  On a sample, every rule is run alone and timed;
the rules are then ordered by rejected texts per second, so that cheap rules that reject much come
first and the costly ones only see what is left.  The verdict is the same in any order: a text is
kept if no rule rejects it.

Null and empty texts have no words.  Rows are judged one by one, so repeated rows, null ids and
further columns of any name pass through unchanged; an empty table gives an empty result.
"""

from __future__ import annotations

import time
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from functools import cached_property
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytally.llm.common import begin, fresh

WINDOW = 5
_SPACES = " \t\n\v\f\r"
_SYMBOLS = "#*$%&|<>"


class Text:
    """Measures of one text, each worked out when first asked for."""

    def __init__(self, text: str | None):
        self.text = text or ""

    @cached_property
    def words(self) -> list[bytes]:
        # On bytes, split() takes exactly the six ASCII white space characters.
        return self.text.encode("utf-8", "surrogatepass").split()

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len(self.text) - sum(map(self.text.count, _SPACES))

    @cached_property
    def n_symbols(self) -> int:
        return sum(map(self.text.count, _SYMBOLS))

    @cached_property
    def lines(self) -> list[str]:
        """Lines with a word."""
        return [line for line in self.text.split("\n") if line.strip(_SPACES)]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        """Words inside any 5-word window that the text holds twice or more."""
        words = self.words
        windows = list(zip(*(words[i:] for i in range(WINDOW))))
        if len(set(windows)) == len(windows):
            return 0
        counts = Counter(windows)
        covered, end = 0, 0
        for start, window in enumerate(windows):
            if counts[window] > 1:
                covered += start + WINDOW - max(start, end)
                end = start + WINDOW
        return covered


class Rule(NamedTuple):
    name: str
    rejects: Callable[[Text], bool]


def base_failed(t: Text) -> bool:
    return t.n_words < 10 or 100 * t.n_repeat_words > 20 * t.n_words


RULES = (
    Rule("few_words", lambda t: t.n_words < 10),
    Rule("repeated_windows", lambda t: 100 * t.n_repeat_words > 20 * t.n_words),
    Rule("symbols", lambda t: 100 * t.n_symbols > 25 * t.n_words),
    Rule("duplicate_lines", lambda t: 100 * t.n_dup_lines > 50 * len(t.lines)),
    Rule("word_length", lambda t: not 2 * t.n_words <= t.word_chars <= 15 * t.n_words),
)


def order_rules(
    docs: DataFrame, rules: Sequence[Rule] = RULES, sample_rows: int = 2000, seed: int = 7, text: str = "text"
) -> list[Rule]:
    """The rules by rejections per second on about ``sample_rows`` random rows; best first.

    Only the order depends on the sample, never a verdict.
    """
    total = docs.count()
    if not total:
        return list(rules)

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        begin("rules")
        for batch in batches:
            for k, rule in enumerate(rules):
                start = time.perf_counter()
                rejected = sum(rule.rejects(Text(t)) for t in batch["t"])
                yield pd.DataFrame({"rule": [k], "rejected": [rejected], "seconds": [time.perf_counter() - start]})

    sample = docs.select(F.col(text).alias("t")).sample(min(1.0, sample_rows / total), seed)
    found = {
        r["rule"]: r["rejected"] / max(r["seconds"], 1e-9)
        for r in sample.mapInPandas(measure, "rule int, rejected long, seconds double")
        .groupBy("rule")
        .agg(F.sum("rejected").alias("rejected"), F.sum("seconds").alias("seconds"))
        .collect()
    }
    return [rules[k] for k in sorted(range(len(rules)), key=lambda k: -found.get(k, 0.0))]


def cascade(docs: DataFrame, rules: Sequence[Rule], text: str = "text", kept: str = "kept") -> DataFrame:
    """Add the boolean column ``kept``: false from the first rule that rejects the text.

    A column of that name is replaced.
    """

    @F.pandas_udf("boolean")
    def verdict(texts: pd.Series) -> pd.Series:
        begin("rules")
        return pd.Series([not any(rule.rejects(t) for rule in rules) for t in map(Text, texts)], dtype=bool)

    return docs.withColumn(kept, verdict(F.col(text)))


def keep_good(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text") -> DataFrame:
    """Rows that no rule rejects, with the columns of ``docs``."""
    [kept] = fresh(docs, "kept")
    return cascade(docs, order_rules(docs, rules, text=text), text, kept).filter(F.col(kept)).drop(kept)


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def measured(docs: DataFrame, rules: Sequence[Rule], text: str = "text") -> DataFrame:
    """All measures, ``base_failed`` and ``kept`` of each row, beside the other columns of ``docs``.

    Columns of these names are replaced.
    """
    kind = ", ".join(f"{m} long" for m in MEASURES) + ", base_failed boolean, kept boolean"

    @F.pandas_udf(kind)
    def measure(texts: pd.Series) -> pd.DataFrame:
        begin("rules")
        rows = []
        for t in map(Text, texts):
            kept = not any(rule.rejects(t) for rule in rules)
            failed = base_failed(t)
            rows.append((*(getattr(t, m) for m in MEASURES), failed, kept and not failed))
        return pd.DataFrame(rows, columns=[*MEASURES, "base_failed", "kept"])

    [m] = fresh(docs, "measures")
    rest = [c for c in docs.columns if c not in {*MEASURES, "base_failed", "kept"}]
    return docs.withColumn(m, measure(F.col(text))).select(*rest, f"{m}.*")
