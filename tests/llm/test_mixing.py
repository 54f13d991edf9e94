"""Mixing against plain versions of its rules."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from voltlake.llm import mixing


def highest_quotients(weights, caps, seats):
    given = [0] * len(weights)
    for _ in range(seats):
        open_ = [i for i in range(len(weights)) if weights[i] > 0 and given[i] < caps[i]]
        if not open_:
            break
        given[max(open_, key=lambda i: (weights[i] / (2 * given[i] + 1), -i))] += 1
    return given


@pytest.mark.parametrize("seed", range(30))
def test_apportion_is_the_highest_quotient_method(seed):
    rng = random.Random(seed)
    n = rng.randint(1, 12)
    weights = [rng.choice([0, 1, 3, 7.5, rng.random() * 100, 1000]) for _ in range(n)]
    caps = [rng.choice([0, 2, 5, 10**6]) for _ in range(n)]
    seats = rng.randint(0, 400)
    assert mixing.apportion(np.array(weights), np.array(caps), seats).tolist() == highest_quotients(weights, caps, seats)


@pytest.mark.parametrize("seed", range(20))
def test_targets(seed):
    rng = random.Random(seed)
    sizes = [rng.choice([0, 5, 100, rng.randint(1, 5000)]) for _ in range(rng.randint(1, 15))]
    weights = [(5, 2, 1)[i % 3] for i in range(len(sizes))]
    found = mixing.targets(sizes, weights)
    assert sum(found) == pytest.approx(1.5 * sum(sizes))
    below = [(t / w) for t, s, w in zip(found, sizes, weights) if t < 2 * s]
    assert all(t <= 2 * s for t, s in zip(found, sizes))
    # Those below their limit all get the same for a unit of weight, and no one at the limit gets more.
    assert not below or max(below) - min(below) < 1e-9 * max(below)
    assert not below or all(t / w <= max(below) * (1 + 1e-9) for t, s, w in zip(found, sizes, weights) if t == 2 * s)


def rows_of(frame):
    return [r.asDict(recursive=True) for r in frame.collect()]


def test_odd_documents(docs, no_docs):
    given = [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]
    rows = rows_of(mixing.mix(docs, (5, 2, 1), block=16, shard_words=500))
    size = {t: len(re.findall(r"[^\x20\x09-\x0D]+", t)) for _, t in given}
    assert Counter((r["doc_id"], r["size"]) for r in rows) == Counter((i, size[t]) for i, t in given)
    assert {r["source_size"] for r in rows} == {sum(size[t] for _, t in given)}
    assert {r["target"] for r in rows} == {1.5 * sum(size[t] for _, t in given)}
    for r in rows:
        assert r["taken"] <= 2 * r["size"]
        assert r["taken"] == sum((s["end"] - s["first"]) * s["times"] for s in r["spans"])
        edges = [0, *(x for s in r["spans"] for x in (s["first"], s["end"])), r["size"]]
        assert edges == sorted(edges) and all(1 <= s["times"] <= 2 for s in r["spans"])
    shards = -(-rows[0]["source_size"] // 500)
    assert abs(sum(r["taken"] for r in rows) - rows[0]["target"]) <= 16 * (shards + 1)
    assert mixing.mix(no_docs, (1,)).collect() == []


def test_sources_copies_and_reruns(spark):
    rng = random.Random(5)
    rows = [(i, " ".join("w" * rng.randint(1, 200)), rng.choice(["a", "é", "z", "", None])) for i in range(600)]
    rows += [(7, "one row many times over", "z")] * 2500 + [(None, None, "b"), (None, "x", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    settings = {"block": 8, "shard_words": 3000, "shard_rows": 400}
    found = rows_of(mixing.mix(docs, {"a": 1, "é": 4, "z": 0.5, None: 2}, **settings))
    again = rows_of(mixing.mix(docs.repartition(13, "text"), {"a": 1, "é": 4, "z": 0.5, None: 2}, **settings))
    assert Counter(map(str, found)) == Counter(map(str, again))
    assert len(found) == len(rows)
    by = defaultdict(list)
    for r in found:
        by[r["source"]].append(r)
    total = sum(r["size"] for r in found)
    names = ["", "a", "b", "z", "é", None]
    assert set(by) == set(names)
    goals = mixing.targets([by[s][0]["source_size"] for s in names], [0, 1, 0, 0.5, 4, 2])
    for name, goal in zip(names, goals):
        size = sum(r["size"] for r in by[name])
        assert {r["source_size"] for r in by[name]} == {size} and {r["target"] for r in by[name]} == {goal}
        shards = max(1, -(-size // 3000), -(-len(by[name]) // 400))
        taken = sum(r["taken"] for r in by[name])
        assert taken == goal if goal in (0, 2 * size) else abs(taken - goal) <= 8 * (shards + 1)
    assert sum(goals) == pytest.approx(1.5 * total)
    with pytest.raises(ValueError, match="sources"):
        mixing.mix(docs, (1,), max_sources=3)


def test_bundles_add_up(spark, monkeypatch):
    monkeypatch.setattr(mixing, "FAN", 4)
    docs = spark.range(400).selectExpr("id AS doc_id", "repeat('w ', 50) AS text", "'s' AS source")
    rows = rows_of(mixing.mix(docs, (1,), share=0.7, block=10, shard_words=500))
    assert sum(r["taken"] for r in rows) == 0.7 * 400 * 50
