"""The classifier's statistics, rules and scores by plain means."""

from __future__ import annotations

import math
import random
import re

import pytest
import regex
from edges import frame
from test_exact import documents

from cubeweave.llm import rule_classifier as rc


def plain_statistics(text):
    text = text or ""
    words = [w for w in re.split("[\x20\x09-\x0d]+", text) if w]
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    n, letters = len(words), len(text) - len(words) + 1
    share = lambda a, b: a / b if b > 0 else 0.0
    count = lambda signs: sum(c in signs for c in text)
    ended = sum(bool(re.search("[.!?]['\")\\]]*[\x20\x09-\x0d]*$", x)) for x in lines)
    return {
        "words": float(n), "word_length": share(letters, n), "different_words": share(len(set(words)), n), "bars": share(count("|<>"), n),
        "symbols": share(count("#*$%&"), n), "shouts": share(count("!"), n), "stops": share(count(".,;:?"), n), "digits": share(count("0123456789"), n),
        "capitals": share(len(regex.findall(r"\p{Lu}", text)), letters), "line_words": share(n, len(lines)), "different_lines": share(len(set(lines)), len(lines)),
        "ended_lines": share(ended, len(lines)),
    }


def test_statistics_by_plain_counts(spark, sf_dir):
    for df in (frame(spark), documents(spark, sf_dir)):
        rows, names = rc.statistics(df.select("doc_id", "text"))
        got = sorted(repr([r.doc_id, *[round(r[n], 9) for n in names]]) for r in rows.collect())
        want = sorted(repr([r.doc_id, *[round(plain_statistics(r.text)[n], 9) for n in names]]) for r in df.select("doc_id", "text").collect())
        assert got == want


def holds(rule, row):
    return all(row[name] <= at if low else row[name] > at for name, low, at in rule)


@pytest.fixture(scope="module")
def labelled(spark):
    rnd = random.Random(11)
    rows = []
    for _ in range(600):
        a, b, c = rnd.random(), rnd.random(), float(rnd.randint(0, 3))
        rows.append((a, b, c, int((a > 0.4 and c > 1) or b < 0.2 if rnd.random() < 0.95 else rnd.random() < 0.5)))
    return spark.createDataFrame(rows, "a double, b double, c double, label int"), [dict(zip("abc", r[:3], strict=True)) for r in rows]


def test_rules_are_the_nodes_that_trees_visit(labelled):
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    df, rows = labelled
    names = ["a", "b", "c"]
    vectors = VectorAssembler(inputCols=names, outputCol="features").transform(df)
    forest = RandomForestClassifier(numTrees=5, maxDepth=3, bootstrap=False, seed=3).fit(vectors)
    rules = rc.paths(forest, names)
    assert len(set(rules)) == len(rules) > 10

    def visited(node, row, at):
        """Simplified conditions of the nodes below the root that a row comes through."""
        if at:
            yield tuple((n, low, t) for (n, low), t in sorted(at.items()))
        if node.numDescendants():
            name, t = names[node.split().featureIndex()], float(node.split().threshold())
            left = row[name] <= t
            bound = at.get((name, left), t)
            yield from visited(node.leftChild() if left else node.rightChild(), row, at | {(name, left): min(t, bound) if left else max(t, bound)})

    for row in rows[:150]:
        want = {rule for tree in forest.trees for rule in visited(tree._call_java("rootNode"), row, {})}
        assert {rule for rule in rules if holds(rule, row)} == want


def test_scores_are_the_weighted_rules(labelled):
    df, rows = labelled
    model = rc.fit(df, ["a", "b", "c"])
    assert 0 < len(model.rules) < 300
    got = {(r.a, r.b, r.c): r.score for r in df.select("a", "b", "c", model.score().alias("score")).collect()}
    right = 0
    labels = {(r.a, r.b, r.c): r.label for r in df.collect()}
    for row in rows:
        total = model.intercept + sum(w for rule, w in model.rules if holds(rule, row))
        key = (row["a"], row["b"], row["c"])
        assert abs(got[key] - 1 / (1 + math.exp(-total))) < 1e-12
        right += (got[key] >= 0.5) == labels[key]
    assert right > 0.9 * len(rows)
