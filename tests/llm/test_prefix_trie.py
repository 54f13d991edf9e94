"""The conversation trie against a plain one, and its parts."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from voltlake.llm import prefix_trie
from voltlake.llm.node_table import NodeTable, subtree_sums
from voltlake.llm.running import running

SCHEMA = "conv_id long, turn long, role string, text string, depth string, level int, last string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA)


def turns_of(rows):
    def turn_hash(role, text):
        return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:30]

    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            convs.setdefault(c, []).append(((turn is not None, turn or 0, role, turn_hash(role, text)), (role, text)))
    return {c: [t for _, t in sorted(turns)] for c, turns in convs.items()}


def rebuilt(convs):
    found = {}
    for c, own in convs.items():
        donor, h = c - int(np.fmod(c, 5)), zlib.crc32(str(c).encode()) % 9
        found[c] = convs.get(donor, [])[:h] + own[h:]
    return found


def plain_trie(convs):
    nodes = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    result = []
    for path, who in nodes.items():
        below = [p for p in nodes if p[: len(path)] == path]
        children = [p for p in nodes if len(p) == len(path) + 1 and p[:-1] == path]
        leaves = [p for p in below if not any(len(q) == len(p) + 1 and q[:-1] == p for q in below)]
        saved = sum((len(nodes[p]) - 1) * len(p[-1][1].encode()) for p in below if p)
        ends = ",".join(str(c) for c in sorted(who) if len(convs[c]) == len(path))
        result.append(
            (min(who), len(path), min(nodes[path[:-1]]) if path else None, len(who), len(children), len(leaves),
             saved, hashlib.sha256(ends.encode()).hexdigest())
        )
    return sorted(result, key=str)


def found(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def conversations(seed, n=120):
    rng = random.Random(seed)
    rows = []
    for c in range(-7, n):
        length = rng.choice([1, 1, 2, 3, 5, 9, 12])
        for t in range(length):
            rows.append((c, t, rng.choice(["user", "bot"]), rng.choice(["a", "b", "é" * 3]) if t else "hello"))
    return rows


@pytest.mark.parametrize("fan_bits", [1, 3, 10])
def test_plain_trie(spark, fan_bits):
    rows = conversations(fan_bits)
    ranked = prefix_trie.numbered(frame(spark, rows).repartition(5))
    convs = turns_of(rows)
    given = prefix_trie.trie(*prefix_trie.as_given(ranked), fan_bits=fan_bits, shard_nodes=7)
    assert found(given) == plain_trie(convs)
    grafted = prefix_trie.trie(*prefix_trie.grafted(ranked), fan_bits=fan_bits, shard_nodes=7)
    assert found(grafted) == plain_trie(rebuilt(convs))


def test_odd_rows(spark):
    rows = [
        (1, None, "user", "no number"), (1, 0, None, None), (1, 0, None, None),  # repeated
        (1, 3, "user", "z"), (1, 3, "user", "y"), (1, 3, "bot", "x"),  # ties
        (2, None, "user", "no number"), (2, 0, "", ""), (2, 0, "", None), (2, 7, "u", "long " * 50_000),
        (None, 0, "user", "nobody's"), (10**15, 5, "user", ""), (-3, 1, "ab", "c"), (-4, 1, "a", "bc"),
    ]
    ranked = prefix_trie.numbered(frame(spark, rows))
    assert found(prefix_trie.trie(*prefix_trie.as_given(ranked))) == plain_trie(turns_of(rows))
    assert found(prefix_trie.trie(*prefix_trie.grafted(ranked))) == plain_trie(rebuilt(turns_of(rows)))
    none = prefix_trie.numbered(frame(spark, rows).limit(0))
    assert prefix_trie.trie(*prefix_trie.grafted(none)).collect() == []
    one = prefix_trie.numbered(frame(spark, rows[-1:]))
    assert found(prefix_trie.trie(*prefix_trie.as_given(one))) == plain_trie(turns_of(rows[-1:]))


def test_long_conversations_and_large_groups(spark):
    long = [(c, t, "user", f"t{t % 7}") for c in (1, 2, 3) for t in range(700)]
    copies = [(c, t, "user", f"same {t}") for c in range(10, 2000) for t in range(2)]
    rows = long + [(3, 700, "user", "more")] + copies
    ranked = prefix_trie.numbered(frame(spark, rows).repartition(9))
    result = {(r.depth, r.conv_id): r for r in prefix_trie.trie(*prefix_trie.as_given(ranked)).collect()}
    assert len(result) == 1 + 701 + 2
    root = result[0, 1]
    assert (root.n_convs, root.n_children, root.n_leaves) == (1993, 2, 2)
    # Three members of 700 turns of two bytes; 1990 of two turns of six.
    assert root.saved_tokens == 2 * 700 * 2 + 1989 * 2 * 6
    assert result[700, 1].ends_sha256 == hashlib.sha256(b"1,2").hexdigest()
    ids = ",".join(map(str, range(10, 2000)))
    assert result[2, 10].ends_sha256 == hashlib.sha256(ids.encode()).hexdigest()


def test_equal_digests_are_told_apart(spark, monkeypatch):
    rows = conversations(4, 40)
    seeds = []

    def weak(turns, seed, terms=prefix_trie.with_terms):
        seeds.append(seed)
        made = terms(turns, seed)
        return made if len(seeds) > 1 else made.withColumns({t: made.a * 0 for t in prefix_trie.LANES})

    monkeypatch.setattr(prefix_trie, "with_terms", weak)
    ranked = prefix_trie.numbered(frame(spark, rows))
    assert found(prefix_trie.trie(*prefix_trie.as_given(ranked))) == plain_trie(turns_of(rows))
    assert len(seeds) == 2


def test_running(spark):
    rng = random.Random(2)
    rows = [(k, i, rng.randint(-5, 5)) for k, n in (("a", 3000), ("b", 1), ("c", 40), (None, 30)) for i in range(n)]
    table = spark.createDataFrame(rows, "k string, i int, v long").repartition(6)
    totals = {}
    for k, i, v in rows:
        totals[k, i] = totals.get((k, i - 1), 0) + v
    found = running(table.filter("k IS NOT NULL"), ["k"], ["i"], ["v"], "test").collect()
    assert {(r.k, r.i): r.sum_v for r in found} == {k: v for k, v in totals.items() if k[0] is not None}


def test_node_table():
    rng = np.random.default_rng(0)
    depth, first, second = (rng.integers(0, high, 5000) for high in (6, 1 << 62, 1 << 62))
    table = NodeTable(depth, first, second)
    assert sorted(table.slots) == list(range(5000))
    assert (table.find(depth, first, second) == table.slots).all()
    assert (table.find(depth + 1, first, second) == -1).all()
    assert NodeTable(depth[:0], first[:0], second[:0]).find(depth, first, second).max() == -1
    with pytest.raises(ValueError, match="distinct"):
        NodeTable(*(np.array([1, 1, 2]) for _ in range(3)))


def test_subtree_sums():
    depth = np.array([3, 1, 2, 2, 5])
    own = np.array([31, 11, 21, 22, 51])
    parent = np.array([21, 1, 11, 11, 99])
    (totals,), outside = subtree_sums(depth, (own, own), (parent, parent), [np.array([1, 10, 100, 1000, 7])])
    assert totals.tolist() == [1, 1111, 101, 1000, 7]
    assert outside.tolist() == [False, True, False, False, True]
