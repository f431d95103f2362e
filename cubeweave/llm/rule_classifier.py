"""Quality classifier: a sparse ensemble of rules.

Shallow trees over text statistics are grown on the labelled documents. Every
path from a root to a node is a rule, a conjunction of comparisons. A logistic
regression with a lasso penalty weighs the rules and sets most weights to
zero; the rest is compiled into one column expression, so scoring needs no model
at run time and no Python.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cubeweave.llm.tables import save

TREES = 24
DEPTH = 3
BINS = 64
PENALTY = 0.0005
ROUNDS = 40
SEED = 7

Rule = tuple[tuple[str, bool, float], ...]


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, list[str]]:
    """The id column and statistics of each whole text (null: empty), and the statistics' names."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"))
    rows = rows.select("*", F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "").alias("words"), F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"))
    n, lines = F.size("words"), F.size("lines")
    letters = F.length("text") - n + 1

    def share(part: Column, whole: Column) -> Column:
        return F.when(whole > 0, part / whole).otherwise(F.lit(0.0)).cast("double")

    def signs(characters: str) -> Column:
        rest = reduce(lambda t, c: F.replace(t, F.lit(c), F.lit("")), characters, F.col("text"))
        return F.length("text") - F.length(rest)

    values = {
        "words": n.cast("double"),
        "word_length": share(letters, n),
        "different_words": share(F.size(F.array_distinct("words")), n),
        "bars": share(signs("|<>"), n),
        "symbols": share(signs("#*$%&"), n),
        "shouts": share(signs("!"), n),
        "stops": share(signs(".,;:?"), n),
        "digits": share(signs("0123456789"), n),
        "capitals": share(F.regexp_count("text", F.lit(r"\p{Lu}")), letters),
        "line_words": share(n, lines),
        "different_lines": share(F.size(F.array_distinct("lines")), lines),
        "ended_lines": share(F.size(F.filter("lines", lambda x: x.rlike(r"[.!?]['\")\]]*[\x20\x09-\x0D]*$"))), lines),
    }
    return rows.select(F.col("id").alias(id_col), *[v.alias(k) for k, v in values.items()]), list(values)


@dataclass(frozen=True)
class RuleModel:
    """Rules with their weights; no rules: the score is the same for all."""

    rules: tuple[tuple[Rule, float], ...]
    intercept: float

    def score(self) -> Column:
        """The score as a column expression over the statistics."""
        parts = [F.when(condition(rule), F.lit(w)).otherwise(F.lit(0.0)) for rule, w in self.rules]
        total = reduce(lambda a, b: a + b, parts, F.lit(self.intercept))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def condition(rule: Rule) -> Column:
    return reduce(lambda a, b: a & b, [F.col(name) <= at if low else F.col(name) > at for name, low, at in rule])


def paths(forest, names: list[str]) -> list[Rule]:
    """The rules of all trees: for each node but the roots, the comparisons that lead to it, one for each side of a statistic."""
    found: dict[Rule, None] = {}

    def walk(node, rule: dict[tuple[str, bool], float]) -> None:
        if rule:
            found[tuple((name, low, at) for (name, low), at in sorted(rule.items()))] = None
        if node.numDescendants() == 0:
            return
        name, at = names[node.split().featureIndex()], float(node.split().threshold())
        walk(node.leftChild(), rule | {(name, True): min(at, rule.get((name, True), at))})
        walk(node.rightChild(), rule | {(name, False): max(at, rule.get((name, False), at))})

    for tree in forest.trees:
        walk(tree._call_java("rootNode"), {})
    return list(found)


def fit(labelled: DataFrame, names: list[str], label_col: str = "label") -> RuleModel:
    """Learn from all rows of ``labelled``: statistics and a label of 0 or 1.

    Rows with another or no label are not read. Without both labels there is
    nothing to tell apart: the score of all is the smoothed share of label 1.
    """
    rows = labelled.select(*names, F.col(label_col).cast("double").alias("label")).where("label in (0, 1)")
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    if len(counts) < 2:
        ones, total = counts.get(1.0, 0), sum(counts.values())
        return RuleModel((), _logit((ones + 1) / (total + 2)))
    rows = save(VectorAssembler(inputCols=names, outputCol="features").transform(rows).select("label", "features", *names), "labelled")
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, maxBins=BINS, bootstrap=False, featureSubsetStrategy="onethird", minInstancesPerNode=5, seed=SEED).fit(rows)
    rules = paths(forest, names)
    if not rules:
        return RuleModel((), _logit((counts[1.0] + 1) / (counts[0.0] + counts[1.0] + 2)))
    columns = [condition(r).cast("double").alias(f"r{i}") for i, r in enumerate(rules)]
    kept = VectorAssembler(inputCols=[f"r{i}" for i in range(len(rules))], outputCol="held").transform(rows.select("label", *columns)).select("label", "held")
    lasso = LogisticRegression(featuresCol="held", regParam=PENALTY, elasticNetParam=1.0, maxIter=ROUNDS).fit(kept)
    return RuleModel(tuple((r, float(w)) for r, w in zip(rules, lasso.coefficients, strict=True) if w), float(lasso.intercept))


def _logit(p: float) -> float:
    from math import log

    return log(p / (1 - p))


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", folds: int = 3, held_out: int = 1) -> DataFrame:
    """Score of every row of ``docs``, learnt from the labels outside one fold.

    The fold of a row is the CRC-32 of its id, as text, modulo ``folds``; labels
    of fold ``held_out`` are not learnt from. Returns the id column, held_out,
    score (0 to 1, higher: label 1 is likelier) and predicted (1 from 0.5 on).

    Null and empty texts are scored by their statistics, all zero. A null id is
    in no fold and has no label. Repeated rows are scored alike; an id with
    several labels is learnt from with each. Without labels of both kinds all
    scores are equal. An empty table gives no rows. Other columns are not read.
    """
    rows, names = statistics(docs, id_col, text_col)
    rows = save(rows, "statistics")
    out = F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == held_out, F.lit(False))
    known = labels.select(F.col(id_col), F.col(label_col).alias("label"))
    model = fit(rows.where(~out).join(known, id_col), names)
    return rows.select(id_col, out.alias("held_out"), model.score().alias("score")).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
