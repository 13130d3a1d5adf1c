"""Rule covering, classifier features and gradient steps against plain loops."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedstat.llm import quality_model, quality_rules


def statistics(seed):
    """Rows of features with poor texts in two corners, and a few labels turned round."""
    own = random.Random(seed)
    choices = {"symbols_per_word": [0.0, 0.1, 0.4, 0.8], "mean_word": [3.2, 4.6, 5.2, 7.0], "upper_share": [0.0, 0.04, 0.2]}
    rows = []
    for k in range(900):
        row = {name: own.choice(choices.get(name, [0.0, 0.2, 0.6])) for name in quality_rules.FEATURES}
        poor = row["symbols_per_word"] >= 0.4 and row["mean_word"] >= 5 or row["upper_share"] >= 0.2 and row["mean_word"] < 4
        rows.append({"doc_id": k, "base_failed": False, **row, "quality": int(poor == (own.random() < 0.01))})
    return rows


def holds(row, rule):
    return all((row[name] >= t) if side == ">=" else (row[name] < t) for name, side, t in rule)


def grown(rows):
    rule = []
    while len(rule) < quality_rules.MAX_CONDITIONS:
        poor = sum(r["quality"] == 0 for r in rows)
        if poor in (0, len(rows)):
            break
        now, best = math.log2(poor / len(rows)), (0.0, None)
        for name, thresholds in quality_rules.FEATURES.items():
            for t in thresholds:
                for side in (">=", "<"):
                    covered = [r["quality"] for r in rows if holds(r, [(name, side, t)])]
                    p = covered.count(0)
                    if p >= quality_rules.MIN_COVERED and (gain := p * (math.log2(p / len(covered)) - now)) > best[0] + 1e-9:
                        best = gain, (name, side, float(t))
        if best[1] is None:
            break
        rule.append(best[1])
        rows = [r for r in rows if holds(r, rule)]
    return rule


def covering(rows, pruning):
    """The list of rules, and how many rules were cut back."""
    rules, cut = [], 0
    while len(rules) < quality_rules.MAX_RULES:
        rule = grown([r for r in rows if r["doc_id"] not in pruning])
        if not rule:
            break
        worth = []
        for k in range(1, len(rule) + 1):
            covered = [r["quality"] for r in rows if r["doc_id"] in pruning and holds(r, rule[:k])]
            worth.append(((covered.count(0) - covered.count(1)) / max(1, len(covered)), -k, covered.count(0), len(covered)))
        _, short, poor, size = max(worth)
        cut += -short < len(rule)
        if not size or poor < quality_rules.MIN_PRECISION * size:
            break
        rules.append(rule[:-short])
        rows = [r for r in rows if not holds(r, rules[-1])]
    return rules, cut


@pytest.mark.parametrize("seed", [1, 2])
def test_rules_equal_covering_by_loops(spark, seed):
    rows = statistics(seed)
    names = ["doc_id", "base_failed", *quality_rules.FEATURES, "quality"]
    kinds = ", ".join(f"{n} {'long' if n == 'doc_id' else 'boolean' if n == 'base_failed' else 'int' if n == 'quality' else 'double'}" for n in names)
    frame = spark.createDataFrame([tuple(r[n] for n in names) for r in rows], kinds)
    pruning = {r.doc_id for r in frame.where(F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0).collect()}
    rules, cut = covering(rows, pruning)
    assert quality_rules.learn_rules(frame.drop("quality"), frame.select("doc_id", "quality")) == rules
    assert any(len(rule) >= 2 for rule in rules) and cut
    kept = {r.doc_id for r in frame.where(quality_rules.verdict(rules)).collect()}
    assert kept == {r["doc_id"] for r in rows if not any(holds(r, rule) for rule in rules)}


def test_features_of_a_text_are_those_of_its_words_and_pairs():
    def counted(text):
        features, counts = quality_model.text_features([text])[0]
        return Counter(dict(zip(features.tolist(), counts.tolist())))

    one, other = counted("pear"), counted("élan")
    # a word, the three- and four-letter runs of "<pear>"
    assert sum(one.values()) == 1 + 4 + 3
    pair = counted("pear élan") - one - other
    assert sum(pair.values()) == 1 and next(iter(pair)) >= quality_model.WORDS + quality_model.GRAMS
    twice = counted("pear pear")
    assert twice - one - one == counted("élan élan") - other - other and sum(twice.values()) == 2 * 8 + 1
    assert counted("") == Counter()


def test_scores_are_means_over_features():
    own = np.random.default_rng(3)
    model = quality_model.Model(own.normal(size=quality_model.WORDS + quality_model.GRAMS + quality_model.PAIRS), 0.25)
    texts = ["", "a", "one two one two", "l'été «fini» 😀 x", "w " * 500]
    expected = []
    for features, counts in quality_model.text_features(texts):
        mean = sum(model.values[f] * n for f, n in zip(features, counts)) / max(1, counts.sum())
        expected.append(1 / (1 + math.exp(-mean - model.bias)))
    assert model.scores(texts) == pytest.approx(expected, abs=1e-12)


def test_training_follows_the_gradient():
    rows = [([1, 5], [2, 1], 1), ([5, 9], [1, 3], 0), ([], [], 1)]
    model = quality_model.train([(np.array(f, np.int64), np.array(n, np.int64), y) for f, n, y in rows])
    own = np.random.default_rng(0)
    size = (quality_model.WORDS + quality_model.GRAMS + quality_model.PAIRS, quality_model.DIMENSIONS)
    edge = 1 / quality_model.DIMENSIONS
    table = own.uniform(-edge, edge, size).astype(np.float32).astype(float)
    layer, bias, step = np.zeros((size[1], 2)), np.zeros(2), 0
    for _ in range(quality_model.EPOCHS):
        for k in own.permutation(len(rows)):
            features, counts, label = rows[k]
            rate = quality_model.RATE * (1 - step / (quality_model.EPOCHS * len(rows)))
            step += 1
            hidden = sum((n * table[f] for f, n in zip(features, counts)), np.zeros(size[1])) / max(1, sum(counts))
            chance = np.exp(hidden @ layer + bias) / np.exp(hidden @ layer + bias).sum()
            error = chance - np.eye(2)[label]
            back = layer @ error
            layer = layer - rate * np.outer(hidden, error)
            bias = bias - rate * error
            for f in features:
                table[f] = table[f] - rate * back
    assert model.values[[1, 5, 9]] == pytest.approx(table[[1, 5, 9]] @ (layer[:, 1] - layer[:, 0]), abs=1e-5)
    assert model.bias == pytest.approx(bias[1] - bias[0], abs=1e-5)
