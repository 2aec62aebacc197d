"""Quality rules: a decision list learned from labelled text statistics.

Sequential covering in the manner of RIPPER: a rule for bad documents is grown, one threshold
at a time, on one part of the labelled rows, cut back on the rest, and kept if it is precise
there; the rows it covers leave, and the next rule is grown. The list is emitted as one
ordered ``CASE WHEN`` of Spark columns. The first rule that holds decides; if none does, the
document is kept.

Defined cases: a null or blank text has no words and fails the base rule; null labels, or
labels without a document, are not used; without usable labels the list is empty, so only
the base rule decides; repeated rows each get their own verdict; an empty table gives no rows; a text
of any length is assessed whole, by itself; input columns named like the new ones are replaced, and
others may have any name.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.llm.common import BLANKS, fresh, modest_batches

SYMBOLS = "#*$%&|<>"
STAT_TYPE = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "n_lines long, n_distinct_words long, n_upper_words long, n_exclamations long"
)
STATS = tuple(field.split()[0] for field in STAT_TYPE.split(", "))
WINDOW = 5
SAMPLE_ROWS = 20_000


def _repeated_words(words: list[bytes]) -> int:
    """Words inside some window of five words that the text has twice or more."""
    n = len(words)
    if n <= WINDOW:
        return 0
    number = {word: i for i, word in enumerate(dict.fromkeys(words))}
    one = np.fromiter(map(number.__getitem__, words), np.int64, n)
    if len(number) == n:
        return 0

    def pair(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ids of pairs: equal just when both parts are. Ids stay below n."""
        size = min(len(left), len(right))
        return np.unique(left[:size] * n + right[:size], return_inverse=True)[1]

    two = pair(one, one[1:])
    four = pair(two, two[2:])
    five = pair(four, one[4:])
    repeated = np.flatnonzero(np.bincount(five)[five] > 1)
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, repeated, 1)
    np.add.at(edges, repeated + WINDOW, -1)
    return int(np.count_nonzero(np.cumsum(edges)[:n]))


def statistics(text: str | None) -> tuple[int, ...]:
    """The values of ``STATS`` for one whole text."""
    if not text:
        return (0,) * len(STATS)
    words = text.encode().split()
    lines = [line for line in text.split("\n") if line.strip(BLANKS)]
    return (
        len(words),
        len(text) - sum(map(text.count, BLANKS)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        _repeated_words(words),
        len(lines),
        len(set(words)),
        sum(map(bytes.isupper, words)),
        text.count("!"),
    )


def _statistics_of(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame(list(map(statistics, texts)), columns=list(STATS), dtype="int64")


def text_statistics(spark: SparkSession, text: str) -> Column:
    modest_batches(spark)
    return F.pandas_udf(_statistics_of, STAT_TYPE)(F.col(text))


def features(stats: Column) -> dict[str, Column]:
    """What the thresholds are on: rates, as they mean the same for any length."""
    words = F.greatest(stats["n_words"], F.lit(1))
    return {
        "chars_per_word": stats["word_chars"] / words,
        "symbols_per_word": stats["n_symbols"] / words,
        "repeated_share": stats["n_repeat_words"] / words,
        "duplicate_lines_share": stats["n_dup_lines"] / F.greatest(stats["n_lines"], F.lit(1)),
        "upper_share": stats["n_upper_words"] / words,
        "exclamations_per_word": stats["n_exclamations"] / words,
        "words_per_line": stats["n_words"] / F.greatest(stats["n_lines"], F.lit(1)),
    }


def base_failed(stats: Column) -> Column:
    """Under 10 words, or over a fifth of the words in repeated windows."""
    return (stats["n_words"] < 10) | (100 * stats["n_repeat_words"] > 20 * stats["n_words"])


@dataclass(frozen=True)
class Threshold:
    feature: str
    at_least: bool
    value: float

    def mask(self, table: dict[str, np.ndarray]) -> np.ndarray:
        x = table[self.feature]
        return x >= self.value if self.at_least else x <= self.value

    def column(self, columns: dict[str, Column]) -> Column:
        x = columns[self.feature]
        return x >= self.value if self.at_least else x <= self.value


Rule = tuple[Threshold, ...]


def _covers(rule: Rule, table: dict[str, np.ndarray], size: int) -> np.ndarray:
    return reduce(np.logical_and, (t.mask(table) for t in rule), np.ones(size, bool))


def _best_threshold(table, bad, inside) -> tuple[float, Threshold | None]:
    """The threshold of largest FOIL gain among the rows that the rule still covers."""
    p0, n0 = np.count_nonzero(bad & inside), np.count_nonzero(~bad & inside)
    before = np.log2(p0 / (p0 + n0))
    best: tuple[float, Threshold | None] = (0.0, None)
    for feature, column in table.items():
        x, y = column[inside], bad[inside]
        order = np.argsort(x, kind="stable")
        x, y = x[order], y[order]
        cuts = np.flatnonzero(x[1:] > x[:-1])  # between this value and the next
        if not len(cuts):
            continue
        low_p = np.cumsum(y)[cuts]
        low_n = cuts + 1 - low_p
        middle = (x[cuts] + x[cuts + 1]) / 2
        for at_least, p, n in ((False, low_p, low_n), (True, p0 - low_p, n0 - low_n)):
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(p > 0, p * (np.log2(p / (p + n)) - before), 0.0)
            at = int(np.argmax(gain))
            if gain[at] > best[0] + 1e-9:
                best = float(gain[at]), Threshold(feature, at_least, float(middle[at]))
    return best


def _grow(table, bad, max_thresholds: int) -> Rule:
    rule: Rule = ()
    inside = np.ones(len(bad), bool)
    while len(rule) < max_thresholds and (~bad & inside).any():
        _, threshold = _best_threshold(table, bad, inside)
        if threshold is None:
            break
        rule += (threshold,)
        inside &= threshold.mask(table)
    return rule


def _prune(rule: Rule, table, bad) -> tuple[Rule, float]:
    """The shortest beginning of the rule that is worth most on rows it was not grown on."""
    best, worth, precision = rule, -2.0, 0.0
    for length in range(1, len(rule) + 1):
        covered = _covers(rule[:length], table, len(bad))
        p, n = np.count_nonzero(covered & bad), np.count_nonzero(covered & ~bad)
        if p + n and (p - n) / (p + n) > worth + 1e-9:
            best, worth, precision = rule[:length], (p - n) / (p + n), p / (p + n)
    return best, precision


def learn(
    table: dict[str, np.ndarray],
    bad: np.ndarray,
    min_precision: float = 0.95,
    min_covered: int = 3,
    max_rules: int = 16,
    max_thresholds: int = 4,
) -> list[Rule]:
    """Rules for bad rows, in order; rows are split by position into growing and pruning."""
    rules: list[Rule] = []
    pruning = np.arange(len(bad)) % 3 == 2
    left = np.ones(len(bad), bool)
    while len(rules) < max_rules:
        grow, prune = left & ~pruning, left & pruning
        if not bad[grow].any() or bad[grow].all():
            break
        rule = _grow({k: v[grow] for k, v in table.items()}, bad[grow], max_thresholds)
        if not rule:
            break
        rule, precision = _prune(rule, {k: v[prune] for k, v in table.items()}, bad[prune])
        covered = _covers(rule, table, len(bad)) & left
        if precision < min_precision or np.count_nonzero(covered & bad) < min_covered:
            break
        rules.append(rule)
        left &= ~covered
    return rules


def fit(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text",
    label: str = "quality", sample_rows: int = SAMPLE_ROWS,
) -> list[Rule]:
    """A decision list from the labelled documents that pass the base rule.

    ``labels`` has 0 for bad and 1 for good. The classifier sees the ``sample_rows`` labelled
    rows of smallest hash, whatever the input's size; that many rows of statistics reach the
    driver, and the labels are broadcast under the same bound.
    """
    key = F.xxhash64(F.col(id_column).cast("string"))
    chosen = (
        labels.filter(F.col(label).isin(0, 1) & F.col(id_column).isNotNull())
        .select(F.col(id_column).alias("_id"), (F.col(label) == 0).alias("_bad"), key.alias("_key"))
        .orderBy("_key", "_id", "_bad")
        .limit(sample_rows)
    )
    found = docs.select(F.col(id_column).alias("_id"), F.col(text).alias("_text")).join(
        F.broadcast(chosen), "_id"
    )
    stats = found.select("_id", "_key", "_bad", text_statistics(docs.sparkSession, "_text").alias("_s"))
    columns = features(F.col("_s"))
    # Filtered here: Catalyst would push a filter on the statistics below the join and so
    # take them of every document.
    rows = (
        stats.select(
            "_key", "_id", "_bad", base_failed(F.col("_s")).alias("_failed"),
            *(c.alias(n) for n, c in columns.items()),
        )
        .orderBy("_key", "_id", "_bad", *columns)
        .limit(sample_rows)
        .toPandas()
    )
    rows = rows[~rows["_failed"].astype(bool)]
    return learn({n: rows[n].to_numpy(float) for n in columns}, rows["_bad"].to_numpy(bool))


def verdict(rules: Sequence[Rule], columns: dict[str, Column]) -> Column:
    """The ordered conditional: number of the rule that rejects, null if none does."""
    case = F.lit(None).cast("int")
    for number, rule in reversed(list(enumerate(rules))):
        case = F.when(reduce(Column.__and__, (t.column(columns) for t in rule)), number).otherwise(case)
    return case


def assess(docs: DataFrame, rules: Sequence[Rule], text: str = "text") -> DataFrame:
    """``docs`` with the statistics, base_failed, rule (that rejects, or null) and kept.

    One pass, no shuffle. An input column with such a name is replaced.
    """
    new = (*STATS, "base_failed", "rule", "kept")
    others = [c for c in docs.columns if c.lower() not in new]
    name = fresh(docs.columns, "_stats")
    s = F.col(name)
    failed, by = base_failed(s), verdict(rules, features(s))
    return docs.withColumn(name, text_statistics(docs.sparkSession, text)).select(
        *others,
        *(s[c].alias(c) for c in STATS),
        failed.alias("base_failed"),
        by.alias("rule"),
        (~failed & by.isNull()).alias("kept"),
    )


def keep_good(docs: DataFrame, rules: Sequence[Rule], text: str = "text") -> DataFrame:
    """The rows of ``docs`` that neither the base rule nor the list rejects, unchanged."""
    name = fresh(docs.columns, "_stats")
    s = F.col(name)
    kept = ~base_failed(s) & verdict(rules, features(s)).isNull()
    return docs.withColumn(name, text_statistics(docs.sparkSession, text)).filter(kept).select(*docs.columns)
