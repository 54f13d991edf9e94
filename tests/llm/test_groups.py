"""Exact and near duplicates, connected components, signatures."""

import hashlib
import itertools
import random

import numpy as np
import pytest

from tests_llm_data import TEXTS, prose
from voltlake.llm import near_dedup
from voltlake.llm.components import components
from voltlake.llm.exact_dedup import exact_groups
from voltlake.llm.superminhash import STEP_SHIFT, signatures


def smallest_reachable(nodes, links):
    label = {n: n for n in nodes}
    for _ in nodes:
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    return label


@pytest.mark.parametrize("keep", ["largest", "smallest"])
@pytest.mark.parametrize(("runs", "fan_in"), [(1, 2), (7, 2), (40, 3)])
def test_exact_groups(docs, keep, runs, fan_in):
    groups = {}
    for i, text in TEXTS:
        groups.setdefault(text or "", []).append(i)
    expected = []
    for i, text in TEXTS:
        members = groups[text or ""]
        ids = [m for m in members if m is not None]
        stays = (max if keep == "largest" else min)(ids, default=None)
        sha = hashlib.sha256((text or "").encode()).hexdigest()
        expected.append((str(i), str(stays), len(members), i == stays, sha))
    found = exact_groups(docs, keep=keep, runs=runs, fan_in=fan_in).collect()
    assert sorted((str(r[0]), str(r[1]), *r[2:]) for r in found) == sorted(expected)


def test_exact_groups_of_nothing(no_docs):
    assert exact_groups(no_docs).collect() == []


def test_exact_groups_run_no_python(docs):
    plan = exact_groups(docs)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))


def test_components(spark):
    rng = random.Random(4)
    chain = [(k, k + 1) for k in range(100, 140)]
    star = [(200, k) for k in range(201, 260)]
    loose = [(rng.randrange(60), rng.randrange(60)) for _ in range(40)]
    links = [*chain, *star, *loose, (5, 5)]
    expected = smallest_reachable({n for link in links for n in link}, links)
    found = components(spark.createDataFrame(links, "a long, b long"))
    assert {r.id: r.label for r in found.collect()} == expected


def test_an_element_offers_to_every_slot_once():
    signed = signatures(np.arange(1, 6, dtype=np.uint64), np.arange(5), 5, 64)
    assert (np.sort((signed >> np.uint64(STEP_SHIFT)).astype(int), axis=1) == np.arange(64)).all()


def test_signatures_estimate_similarity_with_less_variance():
    rng, errors = np.random.default_rng(1), []
    for _ in range(60):
        a = rng.integers(1, 2**62, 200).astype(np.uint64)
        b = a.copy()
        b[:20] = rng.integers(1, 2**62, 20)
        signed = signatures(np.concatenate([a, b]), np.repeat([0, 1], 200), 2, 224)
        errors.append((signed[0] == signed[1]).mean() - 180 / 220)
    independent = (180 / 220 * 40 / 220 / 224) ** 0.5
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < independent


def test_an_empty_set_and_the_order_of_elements():
    elements = np.array([3, 1, 2], dtype=np.uint64)
    one = signatures(elements, np.array([1, 1, 1]), 3, 16)
    other = signatures(elements[::-1].copy(), np.array([1, 1, 1]), 3, 16)
    assert (one == other).all()
    assert (one[[0, 2]] == np.iinfo(np.uint64).max).all()


def brute_force(rows):
    sets = {}
    for i, text in rows:
        if i is not None:
            sets.setdefault(i, []).append(near_dedup.shingles_of(text or ""))
    links = [
        (a, b)
        for a, b in itertools.combinations(sets, 2)
        if any(near_dedup.similar(x, y) for x in sets[a] for y in sets[b])
    ]
    return smallest_reachable(set(sets), links)


def test_near_groups_of_odd_rows(docs, no_docs):
    expected = brute_force(TEXTS)
    found = near_dedup.near_groups(docs).collect()
    assert len(found) == len(TEXTS)
    sizes = sorted((str(i), len(near_dedup.shingles_of(t or ""))) for i, t in TEXTS)
    assert sorted((str(r.doc_id), r.n_shingles) for r in found) == sizes
    for row in found:
        assert row.component_id == expected.get(row.doc_id)
        assert row.kept == (row.doc_id == row.component_id)
    assert near_dedup.near_groups(no_docs).collect() == []


def test_near_groups_with_chains_and_shared_passages(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 5)  # several blocks in a bucket
    rng, rows = random.Random(8), []
    for group in range(6):
        words = prose(group, 80).split()
        for _ in range(20):
            rows.append((len(rows), " ".join(words)))
            words[rng.randrange(80)] = f"new{rng.randrange(1000)}"  # each a step further
    shared = prose(99, 60)
    rows += [(1000 + k, f"{shared} {prose(200 + k, 40)}") for k in range(30)]
    rows.append((500, rows[3][1]))
    rows.append((500, rows[70][1]))  # one id with texts of two groups
    expected = brute_force(rows)
    found = near_dedup.near_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.component_id) for r in found} == set(expected.items())


def test_near_groups_whose_members_hardly_link(spark):
    """Copies of one text with two words changed in each: most pairs are just below the threshold."""
    rng, words = random.Random(3), prose(1, 200).split()
    rows = []
    for k in range(250):
        copy = list(words)
        for place in rng.sample(range(200), 2):
            copy[place] = f"new{k}"
        rows.append((k, " ".join(copy)))
    found = near_dedup.near_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.component_id) for r in found} == set(brute_force(rows).items())


def test_a_block_hands_on_fewer_links_than_it_has_members(spark):
    import pyarrow as pa

    texts = [" ".join(f"w{k}" for k in range(60)) + f" end{i % 3}" for i in range(40)]
    table = near_dedup.sketches(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).toArrow()
    sets = {i: sorted(near_dedup.hashed_shingles([t])[0].view(np.int64).tolist(), key=lambda v: v % (1 << 64)) for i, t in enumerate(texts)}
    rows = table.sort_by("doc_id")
    rows = rows.append_column("hashes", pa.array([sets[i] for i in range(40)], pa.list_(pa.int64())))
    rows = rows.append_column("label", rows.column("doc_id")).append_column("part", pa.array([0] * 40, pa.int32()))
    key = [pa.scalar(v) for v in (0, 1, 0, 0)]
    links = near_dedup._joining_links(85)(key, rows).to_pylist()
    assert len(links) == 39
    assert set(smallest_reachable(range(40), [(r["a"], r["b"]) for r in links]).values()) == {0}
