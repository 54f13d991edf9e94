"""Learned swap sets, and the fit against its stated objective over whole counterfactual texts."""

import random

import numpy as np

from voltlake.llm import toxicity

GROUPS = (("farmers", "fishers", "millers"), ("red", "blue"))


def examples(seed=1, n=400):
    chance = random.Random(seed)
    rows = []
    for _ in range(n):
        toxic = chance.random() < 0.4
        group = chance.choice(GROUPS[0][: 1 if toxic else 3])
        colour = chance.choice(GROUPS[1])
        said = chance.choice(("fools", "liars")) if toxic and chance.random() < 0.9 else chance.choice(("tall", "kind"))
        rows.append((f"the {colour} {group} are {said} {chance.choice(('today', 'always', 'fooled'))}", int(toxic)))
    return rows


def objective(rows, groups, features, fairness, l2):
    """The loss of weights, over texts and counterfactual texts written out, and its slope."""
    place = {f: k for k, f in enumerate(features)}

    def seen(words):
        row = np.zeros(len(features))
        row[[place[f] for f in toxicity.all_features(words).tolist() if f in place]] = 1
        return row

    told, changes = [], []
    for text, _ in rows:
        words = toxicity.words_of(text)
        told.append(seen(words))
        for group in groups:
            for term in words & set(group):
                for other in set(group) - words:
                    changes.append(seen(words) - seen(words - {term} | {other}))
    told, changes, labels = np.array(told), np.array(changes), np.array([y for _, y in rows])
    weight = len(labels) / (2 * np.where(labels, labels.sum(), (1 - labels).sum()))

    def slope(w, b):
        error = (1 / (1 + np.exp(-(told @ w + b))) - labels) * weight / len(labels)
        return error @ told + 2 * l2 * w + 2 * fairness * changes.T @ (changes @ w) / len(changes), error.sum()

    return slope, changes


def test_the_fit_is_where_its_objective_is_flat():
    rows = examples()
    for fairness in (0.0, 10.0):
        model = toxicity.fit_rows(rows, GROUPS, fairness=fairness, l2=1e-2, rounds=4000)
        w = np.array(list(model.weights.values()))
        slope, changes = objective(rows, GROUPS, list(model.weights), fairness, 1e-2)
        low, high = -30.0, 30.0  # the bias is moved afterwards to part the classes best
        for _ in range(80):
            mid = (low + high) / 2
            low, high = (low, mid) if slope(w, mid)[1] > 0 else (mid, high)
        assert np.abs(slope(w, low)[0]).max() < 1e-4 < np.abs(slope(w * 0.5, low)[0]).max()
        assert model.swaps == len(changes)
        assert abs(model.swap_change - np.abs(changes @ w).mean()) < 1e-9


def test_penalty_makes_swaps_change_less():
    rows = examples()
    plain, fair = (toxicity.fit_rows(rows, GROUPS, fairness=f) for f in (0.0, 10.0))
    assert plain.swaps == fair.swaps > len(rows)
    assert fair.swap_change < 0.2 * plain.swap_change


def test_learned_groups(spark):
    sample = spark.createDataFrame(examples(n=600), "text string, label int")
    sets = toxicity.learned_groups(sample, at_least=20, alike=0.8)
    held_together = {frozenset(s) for s in sets}
    assert frozenset(("red", "blue")) in held_together or any({"red", "blue"} <= s for s in held_together)
    words = {w for s in sets for w in s}
    assert not words & {"fools", "liars", "tall", "kind", "farmers"}  # labels tell them apart
    assert len(words) == sum(map(len, sets))
    assert not {w for s in toxicity.learned_groups(sample, known=["red"]) for w in s} & {"red"}


def test_nothing_to_learn_swaps_from(spark):
    schema = "text string, label int"
    assert toxicity.learned_groups(spark.createDataFrame([], schema)) == []
    assert toxicity.learned_groups(spark.createDataFrame([("a b", 1)], schema)) == []
    odd = [("", 0), ("", 1), ("x", 0), ("x " * 5000, 1)] * 30
    assert all(len(s) > 1 for s in toxicity.learned_groups(spark.createDataFrame(odd, schema)))
