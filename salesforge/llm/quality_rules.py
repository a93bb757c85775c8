"""Quality rules: a learned decision list over text statistics.

Statistics of every whole text come from one Arrow UDF.  From labelled texts, sequential covering learns
an ordered list of rules.  A rule is a conjunction of thresholds; it is grown term by term on one part of the
labelled rows (FOIL gain), pruned on the other part, and accepted only if it is precise there.  The list is
emitted as one Spark ``CASE WHEN`` over the statistics: the first rule that fires rejects, else the text is kept.

Defined results
* null text: as the empty text, all statistics 0, ``base_failed`` true (fewer than 50 words).
* repeated rows, repeated or null ids: every row is judged on its own; nothing is joined back by id.
* labels: rows with a null id or a null quality are ignored; an id labelled both 0 and 1 is ignored.
  Without two classes of labels the list is empty and only the base rules reject.
* extra columns, also named like the statistics: kept as they are by ``filter_documents``; ``judge`` returns its own.
* ties: thresholds and features are tried in a fixed order and the first best one is taken.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from .common import scratch_column, text_or_empty

# Fixed values of the base rules.
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = "#*$%&|<>"
WHITE = " \t\n\x0b\x0c\r"

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_digits",
          "n_marks"]
FEATURES = ["n_words", "mean_word_chars", "symbols_per_char", "dup_line_share", "repeat_share", "upper_share",
            "digit_share", "marks_per_word", "words_per_line"]

# Upper bound for the labelled rows that the classifier is fitted on (the driver holds one float matrix of them).
MAX_LABELLED = 20_000
MAX_RULES = 16
MAX_TERMS = 4
MIN_PRECISION = 0.95
CUTS_PER_FEATURE = 64


def repeated_window_words(words: list, size: int = 3) -> int:
    """Words that lie in a window of ``size`` words which occurs twice or more, the first one included."""
    n = len(words)
    if n <= size:
        return 0
    codes: dict = {}
    ids = np.fromiter((codes.setdefault(w, len(codes)) for w in words), np.int64, n)
    key = ids[: n - size + 1]
    for j in range(1, size):  # dense codes of the first j + 1 words: no overflow, no collision
        key = key * len(codes) + ids[j: n - size + 1 + j]
        if j < size - 1 and len(codes) > 2_000_000:
            key = np.unique(key, return_inverse=True)[1].astype(np.int64)
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(key), bool)
    twice[order[1:]] |= same
    twice[order[:-1]] |= same
    covered = np.zeros(n, bool)
    for j in range(size):
        covered[j: n - size + 1 + j] |= twice
    return int(covered.sum())


def text_counts(text: str) -> tuple:
    """The counts of ``COUNTS`` for one text.  Words are runs of anything but ASCII white space."""
    words = text.encode("utf-8", "surrogatepass").split()
    lines = [x for x in text.split("\n") if x.strip(WHITE)]
    return (len(words), len(text) - sum(map(text.count, WHITE)), sum(map(text.count, SYMBOLS)),
            len(lines) - len(set(lines)), repeated_window_words(words), len(lines),
            sum(map(str.isupper, text)) if not text.islower() else 0,
            sum(map(text.count, "0123456789")), sum(map(text.count, "!?")))


@pandas_udf(T.StructType([T.StructField(c, T.LongType()) for c in COUNTS]))
def count_udf(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for part in texts:
        yield pd.DataFrame([text_counts(t) for t in part], columns=COUNTS, dtype="int64")


# else a filter on the counts would be pushed below the projection and the UDF would run twice
count_udf = count_udf.asNondeterministic()


def features(counts: Column) -> dict[str, Column]:
    """Ratios of the counts; a ratio over nothing is 0."""
    def ratio(a: str, b: str) -> Column:
        return F.when(counts[b] > 0, counts[a].cast("double") / counts[b]).otherwise(F.lit(0.0))

    return {
        "n_words": counts["n_words"].cast("double"),
        "mean_word_chars": ratio("word_chars", "n_words"),
        "symbols_per_char": ratio("n_symbols", "word_chars"),
        "dup_line_share": ratio("n_dup_lines", "n_lines"),
        "repeat_share": ratio("n_repeat_words", "n_words"),
        "upper_share": ratio("n_upper", "word_chars"),
        "digit_share": ratio("n_digits", "word_chars"),
        "marks_per_word": ratio("n_marks", "n_words"),
        "words_per_line": ratio("n_words", "n_lines"),
    }


def base_failed(counts: Column) -> Column:
    return ((counts["n_words"] < MIN_WORDS)
            | (100 * counts["n_repeat_words"] > MAX_REPEAT_PERCENT * counts["n_words"]))


@dataclass(frozen=True)
class Term:
    feature: str
    above: bool  # feature > cut, else feature <= cut
    cut: float

    def holds(self, x: np.ndarray) -> np.ndarray:
        column = x[:, FEATURES.index(self.feature)]
        return column > self.cut if self.above else column <= self.cut

    def column(self, of: dict[str, Column]) -> Column:
        return of[self.feature] > F.lit(self.cut) if self.above else of[self.feature] <= F.lit(self.cut)


Rule = tuple[Term, ...]


def _covers(rule: Rule, x: np.ndarray) -> np.ndarray:
    return reduce(np.logical_and, (t.holds(x) for t in rule), np.ones(len(x), bool))


def _grow(x: np.ndarray, bad: np.ndarray) -> Rule:
    rule: list[Term] = []
    inside = np.ones(len(x), bool)
    while len(rule) < MAX_TERMS and (p := int(bad[inside].sum())) and p < inside.sum():
        base, best, gain = np.log2(p / inside.sum()), None, 1e-9
        for j, name in enumerate(FEATURES):
            values = x[inside, j]
            for cut in np.unique(np.quantile(values, np.linspace(0, 1, CUTS_PER_FEATURE + 1), method="lower")):
                for above in (True, False):
                    hit = values > cut if above else values <= cut
                    got = int(bad[inside][hit].sum())
                    if got and hit.sum() < len(values) and (g := got * (np.log2(got / hit.sum()) - base)) > gain:
                        best, gain = Term(name, above, float(cut)), g
        if best is None:
            break
        values = x[inside, FEATURES.index(best.feature)]
        # halfway to the next value that occurs, so that unseen values near the cut fall on the closer side
        best = Term(best.feature, best.above, float((best.cut + values[values > best.cut].min()) / 2))
        rule.append(best)
        inside &= best.holds(x)
    return tuple(rule)


def _prune(rule: Rule, x: np.ndarray, bad: np.ndarray) -> Rule:
    """The shortest prefix of the rule that is worth most on rows it was not grown on."""
    def worth(r: Rule) -> float:
        hit = _covers(r, x)
        return (bad[hit].sum() - (~bad[hit]).sum()) / max(1, hit.sum())

    return max((rule[:k] for k in range(1, len(rule) + 1)), key=lambda r: (worth(r), -len(r)), default=())


def learn(x: np.ndarray, bad: np.ndarray, ids: np.ndarray) -> list[Rule]:
    """Sequential covering: an ordered list of rules for ``bad`` rows of the feature matrix ``x``."""
    grow_on = (ids * 2654435761 % 2**32) % 3 != 0  # a fixed two-thirds split by id
    rules: list[Rule] = []
    while len(rules) < MAX_RULES and bad[grow_on].sum() >= 2 and bad[~grow_on].sum() >= 1:
        rule = _grow(x[grow_on], bad[grow_on])
        rule = _prune(rule, x[~grow_on], bad[~grow_on]) if rule else ()
        hit, held = _covers(rule, x), _covers(rule, x[~grow_on])
        precise = held.sum() and bad[~grow_on][held].mean() >= MIN_PRECISION and bad[hit].mean() >= MIN_PRECISION
        if not rule or not precise or bad[hit].sum() < 2:
            break
        rules.append(rule)
        x, bad, ids, grow_on = x[~hit], bad[~hit], ids[~hit], grow_on[~hit]
    return rules


def labelled_sample(labels: DataFrame, bound: int = MAX_LABELLED) -> DataFrame:
    """(id, bad) of at most ``bound`` consistently labelled ids, picked by the hash of the id."""
    clean = (labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
             .groupBy(F.col("doc_id").alias("label_id"))
             .agg(F.min("quality").alias("low"), F.max("quality").alias("high")).where("low = high"))
    return (clean.orderBy(F.xxhash64("label_id"), "label_id").limit(bound)
            .select("label_id", (F.col("low") == 0).alias("bad")))


def fit(docs: DataFrame, labels: DataFrame, bound: int = MAX_LABELLED) -> list[Rule]:
    """Learn the list from the labelled texts.  The sample has at most ``bound`` ids, so it may be broadcast."""
    sample = labelled_sample(labels, bound)
    rows = (docs.select("doc_id", text_or_empty("text").alias("text"))
            .join(F.broadcast(sample), F.col("doc_id") == F.col("label_id"))
            .select("doc_id", "bad", count_udf("text").alias("c")))
    of = features(F.col("c"))
    # one row an id, so repeated documents do not weigh more; the base rules judge their rows themselves
    table = (rows.where(~base_failed(F.col("c"))).groupBy("doc_id")
             .agg(F.first("bad").alias("bad"), *[F.max(of[f]).alias(f) for f in FEATURES]).toPandas()
             .sort_values("doc_id"))
    if table.empty:
        return []
    return learn(table[FEATURES].to_numpy(float), table["bad"].to_numpy(bool), table["doc_id"].to_numpy("int64"))


def rule_column(rules: list[Rule], counts: Column) -> Column:
    """The ordered conditional expression: number of the first rule that fires (from 1), else null."""
    of, out = features(counts), F.lit(None).cast("int")
    for k in range(len(rules), 0, -1):
        fires = reduce(lambda a, b: a & b, (t.column(of) for t in rules[k - 1]))
        out = F.when(fires, F.lit(k)).otherwise(out)
    return out


def judge(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """One row per document: the counts, ``base_failed``, ``rule`` (the rule that rejects, from 1) and ``kept``."""
    rows = docs.select("doc_id", count_udf(text_or_empty("text")).alias("c"))
    c = F.col("c")
    return rows.select(
        "doc_id", *[c[x].alias(x) for x in COUNTS[:5]], base_failed(c).alias("base_failed"),
        (~base_failed(c) & rule_column(rules, c).isNull()).alias("kept"), rule_column(rules, c).alias("rule"))


def filter_documents(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """The documents that are kept, with all their columns."""
    name = scratch_column(docs, "counts")
    c = F.col(name)
    rows = docs.withColumn(name, count_udf(text_or_empty("text")))
    return rows.where(~base_failed(c) & rule_column(rules, c).isNull()).select(*[F.col(f"`{x}`") for x in docs.columns])
