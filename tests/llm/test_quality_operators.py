"""Operators 1 and 3."""

import math
import re
import unicodedata
import zlib

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from conftest import SF_SMALL
from letrado.llm import quality_rules, rule_ensemble
from letrado.llm.common import fold_remainder

SENTENCE = "These words make one plain sentence that ends as it should."


def test_base_counts():
    r = quality_rules.judge_text("a b c d e a b c d e\nx #1\nx #1\n \nlast |")
    assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"]) == (16, 21, 3, 1)
    assert r["n_repeat_words"] == 10
    assert quality_rules.repeated_words("a a a a a a".split()) == 6
    assert quality_rules.repeated_words("a b c d".split()) == 0


def test_line_rules():
    def rule(line):
        return quality_rules.judge_line(line.encode(), line.encode().split(), quality_rules.LineRules())
    assert rule(SENTENCE) is None
    assert rule("Home News Contact About us") == "punctuation"
    assert rule("words!! that!! shout.") == "punctuation"
    assert rule("one | two | three.") == "navigation"
    assert rule("All Rights Reserved.") == "boilerplate"
    assert rule("A | in a longer sentence of prose is no reason to remove the whole line.") is None


def test_failing_lines_go_and_lossy_documents_are_rejected():
    some = quality_rules.judge_text("\n".join([SENTENCE, "", "Another line of prose follows it, with other words.", "Home | News | About."]))
    assert some["kept"] and "Home" not in some["clean_text"] and some["n_navigation_lines"] == 1
    much = quality_rules.judge_text("\n".join([SENTENCE] + [f"menu{i} | item{i} | link{i}." for i in range(9)]))
    assert not much["kept"] and not much["base_failed"]


def test_rules_on_messy_rows(clashing, messy_rows, no_rows):
    out = quality_rules.apply_quality_rules(clashing)
    assert sorted(out.columns) == sorted(clashing.columns)
    found = {(r.doc_id, r.text): r.quality_rules for r in out.collect()}
    for i, t, *_ in messy_rows:
        assert found[i, t].asDict() == quality_rules.judge_text(t)
    empty = found[13, None]
    assert empty.n_words == 0 and empty.base_failed and not empty.kept and empty.clean_text == ""
    assert quality_rules.apply_quality_rules(no_rows).count() == 0


def test_tree_paths_become_rules():
    printed = """DecisionTreeClassificationModel: depth=2
  If (feature 0 <= 1.5)
   If (feature 1 <= 2.0)
    Predict: 0.0
   Else (feature 1 > 2.0)
    Predict: 1.0
  Else (feature 0 > 1.5)
   If (feature 0 <= 3.0)
    Predict: 1.0
   Else (feature 0 > 3.0)
    Predict: 0.0
"""
    rules = {r.terms for r in rule_ensemble.tree_rules(printed, ("a", "b"))}
    assert (("a", "<=", 1.5),) in rules and (("a", "<=", 1.5), ("b", ">", 2.0)) in rules
    assert (("a", "<=", 3.0), ("a", ">", 1.5)) in rules and (("a", ">", 3.0),) in rules      # the tighter bound of a side
    assert len(rules) == 6


def test_held_out_accuracy_and_blind_folds(spark):
    docs = spark.read.parquet(f"{SF_SMALL[:-2]}1/documents.parquet")          # sf0.01
    labels = spark.read.parquet(f"{SF_SMALL[:-2]}1/labels.parquet")
    model = rule_ensemble.fit_rules(docs, labels)
    assert 0 < len(model.rules) < 120
    spoiled = labels.withColumn("quality", F.when(fold_remainder(F.col("doc_id"), 5) == 0, 1 - F.col("quality"))
                                .otherwise(F.col("quality")))
    assert rule_ensemble.fit_rules(docs, spoiled) == model                     # held-out labels are never seen
    truth = {r["doc_id"]: r["quality"] for r in pq.read_table(f"{SF_SMALL[:-2]}1/labels.parquet").to_pylist()}
    scored = {r.doc_id: r.score for r in rule_ensemble.score_quality(docs, model).select("doc_id", "score").collect()}
    held = [i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0]
    right = sum((scored[i] >= 0.3) == truth[i] for i in held)
    assert right >= 0.97 * len(held)
    assert all(0 <= s <= 1 for s in scored.values())


def test_classifier_on_messy_rows(spark, messy, clashing, messy_rows, no_rows):
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1), (4, 0), (5, 1), (None, 1), (6, None), (7, 9), (18, 1), (18, 0)],
                                   "doc_id long, quality int")
    model = rule_ensemble.fit_rules(messy, labels)
    out = rule_ensemble.score_quality(clashing, model)
    assert sorted(out.columns) == sorted(clashing.columns) and out.count() == len(messy_rows)
    assert out.where("score is null or score < 0 or score > 1").count() == 0
    none = rule_ensemble.fit_rules(messy, labels.where("quality > 9"))
    assert none == rule_ensemble.RuleModel(0.0)
    assert rule_ensemble.score_quality(no_rows, none).count() == 0
    one = rule_ensemble.fit_rules(messy, labels.where("quality = 1"))
    assert not one.rules and one.intercept > 0
    assert rule_ensemble.fit_rules(no_rows, labels) == rule_ensemble.RuleModel(0.0)


def test_stock_phrases_of_four_languages_are_boilerplate():
    rules = quality_rules.LineRules()
    stock = ["Released under the MIT License.", "Alle Rechte vorbehalten.", "Tous droits réservés.", "Todos los derechos reservados.",
             "Ce texte est publié sous licence libre.", "Lizenziert unter CC BY.", "All rights reserved.", "Bajo licencia MIT."]
    clean = ["The prisoner was released at noon.", "Sie hatte alle ihre Rechte verloren.", "Il a tous les droits.", "Tiene sus derechos."]
    assert [quality_rules.judge_line(x.encode(), x.encode().split(), rules) for x in stock] == ["boilerplate"] * len(stock)
    assert [quality_rules.judge_line(x.encode(), x.encode().split(), rules) for x in clean] == [None] * len(clean)


def test_rules_on_a_very_long_text(spark):
    text = "\n".join(f"Line {i} says that the sea is word{i * 7919 % 10007} wide." for i in range(60_000))
    df = spark.createDataFrame([(1, text + "\nAlle Rechte vorbehalten."), (2, "word " * 300_000)], "doc_id long, text string")
    long, flat = sorted(quality_rules.apply_quality_rules(df, out_col="r").select("doc_id", "r.*").collect(), key=lambda r: r.doc_id)
    assert long.n_lines == 60_001 and long.n_boilerplate_lines == 1 and long.clean_text == text
    assert flat.n_words == flat.n_repeat_words == 300_000 and flat.base_failed and not flat.kept


def plain_statistics(text):
    """The classifier's statistics of one text, computed without Spark."""
    words, lines = re.findall(r"[^\x20\x09-\x0D]+", text), text.split("\n")
    n, some = max(len(words), 1), max(sum(map(len, words)), 1)
    count = lambda chars: sum(c in chars for c in text)
    return {"n_words": len(words), "mean_word": sum(map(len, words)) / n, "symbols_per_word": count("#*$%&|<>") / n,
            "bars_per_word": count("|") / n, "exclaims_per_word": count("!") / n, "stops_per_word": count(".?") / n,
            "commas_per_word": count(",;:") / n, "upper_share": sum(unicodedata.category(c) == "Lu" for c in text) / some,
            "digit_share": count("0123456789") / some, "distinct_share": len(set(words)) / n if words else 1.0,
            "repeated_line_share": (len(lines) - len(set(lines))) / len(lines)}


def test_compiled_rules_equal_a_plain_evaluation(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    model = rule_ensemble.fit_rules(docs, spark.read.parquet(f"{SF_SMALL}/labels.parquet"))
    extra = [(-1, None), (-2, ""), (-3, "ÄÖ | # 12\n\nÄÖ\nÄÖ !,;"), (-4, "x" * 10_000)]
    every = docs.unionByName(spark.createDataFrame(extra, "doc_id long, text string"))
    for each in (model, rule_ensemble.RuleModel(-0.5, tuple((rule_ensemble.Rule(((s, op, 0.2), ("n_words", ">", 3.0))), w)
                                                            for s in rule_ensemble.STATISTICS for op, w in (("<=", 0.7), (">", -1.1))))):
        for r in rule_ensemble.score_quality(every, each).collect():
            stats = plain_statistics(r.text or "")
            total = each.intercept + sum(w for rule, w in each.rules if all(
                stats[s] <= t if op == "<=" else stats[s] > t for s, op, t in rule.terms))
            assert abs(r.score - 1 / (1 + math.exp(-total))) < 1e-12, r.doc_id
