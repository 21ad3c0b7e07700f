"""Quality classifier: a sparse ensemble of rules.

Trees are grown on statistics of the text; every path from a root becomes one rule, a conjunction of
bounds. A lasso logistic fit weighs the rules, and those with a weight are compiled into one column
expression, so scoring runs over whole tables without a join.

Learning sees at most about ``SAMPLE`` labelled documents (chosen by a hash of the id; of rows that share an
id the one with the least counts, of labels the least). Everything else covers all rows, and whole texts of any length. A score
at exactly the threshold is accepted. Null and empty texts have all statistics 0 and get a score as
any other. If no labels, or one class only, are there to learn from, every score is the smoothed
share of label 1. Rows without an id or a label are not learnt from, but scored. Other columns are
carried along, and an empty table gives an empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hardwood.llm.common import prepared, table, unwrapped, wrapped
from hardwood.llm.statistics import counted
from hardwood.session import materialize

SAMPLE = 20_000
TREES, DEPTH, LEAST_ROWS, LASSO = 20, 4, 10, 1e-3
THRESHOLD = 0.7


def features(counts: str) -> dict[str, Column]:
    """Numbers the rules are made of, from a struct of counts."""

    def of(name: str) -> Column:
        return F.col(counts)[name].cast("double")

    def share(a: str, b: str) -> Column:
        return of(a) / F.greatest(of(b), F.lit(1.0))

    letters = of("n_upper") + of("n_lower")
    return {
        "log_words": F.log1p(of("n_words")),
        "word_length": share("word_chars", "n_words"),
        "symbol_runs": share("n_symbol_runs", "n_words"),
        "symbols": share("n_symbols", "word_chars"),
        "upper": of("n_upper") / F.greatest(letters, F.lit(1.0)),
        "digits": share("n_digits", "word_chars"),
        "exclaim": share("n_exclaim", "n_words"),
        "marks": share("n_marks", "n_words"),
        "pipes": share("n_pipes", "n_words"),
        "adjacent": share("n_adjacent", "n_words"),
        "repeated": share("n_repeat_words", "n_words"),
        "distinct": share("n_distinct", "n_words"),
        "dup_lines": share("n_dup_lines", "n_lines"),
        "line_words": share("n_words", "n_lines"),
    }


@dataclass(frozen=True)
class Rule:
    """A conjunction of ``feature <= bound`` and ``feature > bound``, and its weight."""

    at_most: tuple[tuple[str, float], ...]
    above: tuple[tuple[str, float], ...]
    weight: float = 0.0

    def holds(self, of: dict[str, Column]) -> Column:
        parts = [of[n] <= F.lit(b) for n, b in self.at_most] + [of[n] > F.lit(b) for n, b in self.above]
        whole = parts[0]
        for part in parts[1:]:
            whole = whole & part
        return whole


@dataclass(frozen=True)
class RuleEnsemble:
    """``1 / (1 + exp(-(intercept + sum of the weights of the rules that hold)))``."""

    intercept: float
    rules: tuple[Rule, ...]

    def score(self, counts: str) -> Column:
        of = features(counts)
        total = F.lit(self.intercept)
        for rule in self.rules:
            total = total + F.when(rule.holds(of), F.lit(rule.weight)).otherwise(F.lit(0.0))
        return 1.0 / (1.0 + F.exp(-total))


def paths(tree, names: list[str]) -> set[Rule]:
    """All rules of one fitted tree: bounds on the same feature are merged."""
    found: set[Rule] = set()

    def walk(node, low: dict[str, float], high: dict[str, float]) -> None:
        if low or high:
            found.add(Rule(tuple(sorted(high.items())), tuple(sorted(low.items()))))
        if node.subtreeDepth() == 0:
            return
        split = node.split()
        name, bound = names[split.featureIndex()], split.threshold()
        walk(node.leftChild(), low, {**high, name: min(bound, high.get(name, math.inf))})
        walk(node.rightChild(), {**low, name: max(bound, low.get(name, -math.inf))}, high)

    walk(tree._java_obj.rootNode(), {}, {})
    return found


def fitted(examples: DataFrame, counts: str = "counts", label: str = "label") -> RuleEnsemble:
    """The ensemble for examples of ``counts`` and a label of 0 or 1; a bounded table."""
    by_label = {r["y"]: r["n"] for r in examples.groupBy(F.col(label).alias("y")).agg(F.count(F.lit(1)).alias("n")).collect()}
    good, bad = by_label.get(1, 0), by_label.get(0, 0)
    if not good or not bad:
        return RuleEnsemble(math.log((good + 1) / (bad + 1)), ())
    of = features(counts)
    names = list(of)
    rows = examples.select(F.col(label).cast("double").alias("label"), array_to_vector(F.array(*of.values())).alias("features"), counts)
    rows = materialize(rows, "examples")
    forest = RandomForestClassifier(
        numTrees=TREES, maxDepth=DEPTH, minInstancesPerNode=min(LEAST_ROWS, max(1, min(good, bad) // 4)), seed=7
    ).fit(rows)
    rules = sorted(set().union(*(paths(tree, names) for tree in forest.trees)), key=lambda r: (r.at_most, r.above))
    if not rules:
        return RuleEnsemble(math.log((good + 1) / (bad + 1)), ())
    of = features(counts)
    held = F.array(*[F.when(rule.holds(of), F.lit(1.0)).otherwise(F.lit(0.0)) for rule in rules])
    table_of_rules = materialize(rows.select("label", array_to_vector(held).alias("features")), "rules")
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=LASSO, maxIter=100).fit(table_of_rules)
    weighed = (Rule(r.at_most, r.above, float(w)) for r, w in zip(rules, lasso.coefficients.toArray()))
    return RuleEnsemble(float(lasso.intercept), tuple(r for r in weighed if abs(r.weight) > 1e-9))


def held_out(id_col: Column) -> Column:
    """Rows that are never learnt from."""
    return F.coalesce(F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def learnt(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> RuleEnsemble:
    """Learn ``labels.quality`` from at most about ``sample`` documents that are not held out."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").alias("id")).agg(F.min("quality").alias("label"))
    among = known.count()
    part = F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < F.lit(math.ceil(1_000_000 * min(1.0, sample / max(1, among))))
    chosen = materialize(known.where(part), "labels")
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    # About ``sample`` rows of two numbers.
    examples = texts.join(F.broadcast(chosen), "id").select("id", "label", counted(F.col("text")).alias("counts"))
    return fitted(materialize(examples.groupBy("id").agg(F.min("label").alias("label"), F.min("counts").alias("counts")), "counts"))


def scored(docs: DataFrame, ensemble: RuleEnsemble, text_col: str = "text") -> DataFrame:
    """All rows as ``doc`` with ``score``."""
    prepared(docs.sparkSession)
    rows = wrapped(docs).withColumn("counts", counted(F.col(f"doc.`{text_col}`")))
    return rows.select("doc", ensemble.score("counts").alias("score"))


def accepted(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows whose score reaches the threshold, with their columns."""
    prepared(docs.sparkSession)
    found = scored(docs, learnt(docs, labels, id_col, text_col), text_col)
    return unwrapped(found.where(F.col("score") >= threshold))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ensemble = learnt(docs, table(spark, sf_dir, "labels"))
    return scored(docs, ensemble).select(
        "doc.doc_id",
        held_out(F.col("doc.doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


SQL: dict[str, str] = {}
QUERIES = {"op10_quality": op10_quality}
