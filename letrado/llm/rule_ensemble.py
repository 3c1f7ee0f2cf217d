"""Quality classifier as a sparse rule ensemble (operator 3).

Statistics of a text are Spark column expressions.  Small trees grown on a
bounded labelled sample give conjunctive rules (every path from a root to a
node), a lasso logistic regression keeps the few that matter, and the model is
compiled back into one column expression: scoring runs in the JVM in the scan's
own stage, without a shuffle and without Python.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from letrado.llm.common import WORD_GAP, fold_remainder, free_name

STATISTICS = ("n_words", "mean_word", "symbols_per_word", "bars_per_word", "exclaims_per_word", "stops_per_word",
              "commas_per_word", "upper_share", "digit_share", "distinct_share", "repeated_line_share")


def with_statistics(df: DataFrame, text_col: str) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with a column per statistic, and their names; null counts as empty, where all but the
    distinct share (1) are 0.

    Words and lines are cut once, in a projection of their own, and every
    statistic is a column rather than a field: Catalyst inlines the fields of a
    struct into each rule, and would then compute them once per rule.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    words, lines, size = (free_name(df, c) for c in ("text_words", "text_lines", "text_size"))
    names = {s: free_name(df, s) for s in STATISTICS}

    def chars(pattern: str) -> Column:
        return F.regexp_count(text, F.lit(pattern))

    cut = df.select("*", F.array_remove(F.split(text, WORD_GAP), "").alias(words), F.split(text, "\n").alias(lines))
    cut = cut.select("*", F.length(F.array_join(words, "")).alias(size))
    n = F.greatest(F.size(words), F.lit(1)).cast("double")
    some = F.greatest(F.col(size), F.lit(1)).cast("double")
    stats = {
        "n_words": F.size(words), "mean_word": F.col(size) / n,
        "symbols_per_word": chars("[#*$%&|<>]") / n, "bars_per_word": chars("[|]") / n,
        "exclaims_per_word": chars("!") / n, "stops_per_word": chars("[.?]") / n, "commas_per_word": chars("[,;:]") / n,
        "upper_share": chars(r"\p{Lu}") / some, "digit_share": chars("[0-9]") / some,
        "distinct_share": F.when(F.size(words) == 0, 1.0).otherwise(F.size(F.array_distinct(words)) / n),
        "repeated_line_share": (F.size(lines) - F.size(F.array_distinct(lines))) / F.size(lines),
    }
    found = cut.select(*df.columns, *[stats[s].cast("double").alias(names[s]) for s in STATISTICS])
    return found, names


@dataclass(frozen=True)
class Rule:
    """A conjunction of (statistic, '<=' or '>', threshold)."""

    terms: tuple[tuple[str, str, float], ...]

    def column(self, names: dict[str, str]) -> Column:
        stats = {s: F.col(names[s]) for s, _, _ in self.terms}
        return reduce(lambda a, b: a & b, [stats[s] <= t if op == "<=" else stats[s] > t for s, op, t in self.terms])


@dataclass(frozen=True)
class RuleModel:
    """score = logistic(intercept + sum of the weights of the rules that hold)."""

    intercept: float
    rules: tuple[tuple[Rule, float], ...] = ()

    def score(self, names: dict[str, str]) -> Column:
        total = reduce(lambda a, b: a + b, [F.when(r.column(names), w).otherwise(0.0) for r, w in self.rules],
                       F.lit(self.intercept))
        return 1.0 / (1.0 + F.exp(-total))


def tree_rules(debug_string: str, names: tuple[str, ...]) -> set[Rule]:
    """Every path from the root of a printed tree to one of its nodes."""
    rules, path = set(), []
    for line in debug_string.splitlines():
        m = re.match(r"(\s*)(If|Else) \(feature (\d+) (<=|>) ([-+.\deE]+)\)", line)
        if m:
            indent = len(m[1])
            while path and path[-1][0] >= indent:
                path.pop()
            path.append((indent, (names[int(m[3])], m[4], float(m[5]))))
            rules.add(_simplest(tuple(t for _, t in path)))
    return rules


def _simplest(terms: tuple) -> Rule:
    """The rule with one bound per statistic and side."""
    bound: dict = {}
    for s, op, t in terms:
        old = bound.get((s, op))
        bound[s, op] = t if old is None else min(old, t) if op == "<=" else max(old, t)
    return Rule(tuple(sorted((s, op, t) for (s, op), t in bound.items())))


def labelled_sample(docs: DataFrame, labels: DataFrame, max_rows: int, id_col: str = "doc_id",
                    text_col: str = "text", label_col: str = "quality", folds: int = 5) -> DataFrame:
    """(STATISTICS, label) of at most ``max_rows`` labelled documents outside fold 0.

    Null ids and labels other than 0 and 1 are left out.  An id labelled more
    than once counts once, as 1 if any label says so; of repeated documents the
    least statistics count.  The sample is the ids of smallest hash, so it does
    not depend on the order of rows.
    """
    ids = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("double").alias("label"))
           .where(F.col("id").isNotNull() & F.col("label").isin(0.0, 1.0))
           .where(fold_remainder(F.col("id"), folds) != 0)
           .groupBy("id").agg(F.max("label").alias("label"))
           .orderBy(F.xxhash64(F.col("id").cast("string")), "id").limit(max_rows))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    found, names = with_statistics(texts.join(F.broadcast(ids), "id"), "text")     # at most max_rows ids
    least = F.min(F.struct(*[F.col(names[s]).alias(s) for s in STATISTICS])).alias("stats")
    return found.groupBy("id").agg(least, F.max("label").alias("label")).select("stats.*", "label")


def fit_rules(docs: DataFrame, labels: DataFrame, max_rows: int = 20_000, trees: int = 20, depth: int = 3,
              lasso: float = 0.0005, seed: int = 7, **columns) -> RuleModel:
    """Fit the ensemble; ``max_rows`` bounds the labelled sample, ``columns`` go to labelled_sample.

    Without labelled rows the model is the constant 0.5; with one class it is
    the constant share of label 1 in the sample, kept off 0 and 1 by one
    imagined row of either label.
    """
    sample = labelled_sample(docs, labels, max_rows, **columns)
    sample = (sample.withColumn("features", array_to_vector(F.array(*STATISTICS)))
              .repartition(1).sortWithinPartitions(*STATISTICS, "label").persist())      # at most max_rows rows
    names = {s: s for s in STATISTICS}
    try:
        n, ones = sample.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0.0))).first()
        if ones in (0, n):
            return RuleModel(math.log((ones + 1) / (n - ones + 1)))
        forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, minInstancesPerNode=5,
                                        featureSubsetStrategy="0.6", subsamplingRate=0.7).fit(sample)
        # a bound's two sides are each other's complement: one of them is enough
        rules = sorted((r for r in set().union(*(tree_rules(t.toDebugString, STATISTICS) for t in forest.trees))
                        if len(r.terms) > 1 or r.terms[0][1] == "<="), key=lambda r: r.terms)
        if not rules:
            return RuleModel(math.log((ones + 1) / (n - ones + 1)))
        holds = F.array(*[F.when(r.column(names), 1.0).otherwise(0.0) for r in rules])
        held = sample.select("label", array_to_vector(holds).alias("features"))
        linear = LogisticRegression(elasticNetParam=1.0, regParam=lasso, maxIter=40, tol=1e-5).fit(held)
        weights = linear.coefficients.toArray().tolist()
        return RuleModel(linear.intercept, tuple((r, w) for r, w in zip(rules, weights) if w))
    finally:
        sample.unpersist()


def score_quality(df: DataFrame, model: RuleModel, text_col: str = "text", out_col: str = "score") -> DataFrame:
    """``df`` with the model's probability of label 1 in ``out_col`` (an existing one is replaced).

    Null and empty texts are scored by their statistics like any other text.
    The score comes out of a generator of one row: a later filter on it then
    stays above, instead of being pushed below with the whole model in it.
    """
    found, names = with_statistics(df, text_col)
    kept = [c for c in df.columns if c != out_col]
    return found.select(*kept, F.inline(F.array(F.struct(model.score(names).alias(out_col)))))
