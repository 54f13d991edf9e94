"""Benchmark items that stand in a document with edits, or that are short, numeric or mistyped."""

import random
import time

import numpy as np
import pyarrow as pa

from tests_llm_data import prose
from voltlake.llm import decontamination


def found(spark, docs, items):
    docs = [(k, f"{prose(50 + k, 40)}. {text} . {prose(70 + k, 40)}") for k, text in docs]
    rows = decontamination.contaminated(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string"),
    ).collect()
    return {(r.doc_id, r.item_id): r for r in rows}


def edited(words, *middle, drop=0):
    half = len(words) // 2
    return " ".join([*words[:half], *middle, *words[half + drop :]])


def test_edits_in_the_middle_are_found(spark):
    lengths = (15, 16, 17, 20, 22, 38, 59)
    items = [(n, prose(n, n)) for n in lengths]
    docs = []
    for n, text in items:
        words = text.split()
        docs += [(n, edited(words, "inserted")), (100 + n, edited(words, drop=1)), (200 + n, edited(words, "changed", drop=1))]
    items += [(300, "when the brave Tom went to New York he saw the tall Tom and ate a big red apple")]
    docs += [(300, items[-1][1].replace("Tom", "Mary Ann").replace("New York", "Paris"))]
    docs += [(400, " ".join(items[6][1].split()[20:42]))]  # an excerpt
    expected = {(n + k, n) for n in lengths for k in (0, 100, 200)} | {(300, 300), (400, 59)}
    assert expected <= set(found(spark, docs, items))
    far = [(1, f"{' '.join(items[3][1].split()[:9])} {prose(9, 300)} {' '.join(items[3][1].split()[11:])}")]
    assert found(spark, far, items[3:4]) == {}


def test_items_of_few_tokens_are_found(spark):
    items = [(1, "What is the capital of France?"), (2, "tiny item"), (3, "Never said so")]
    docs = [(1, "What is the capital of France?"), (2, "He asked: What is the capital of France? And"), (3, "a tiny item here")]
    assert set(found(spark, docs, items)) == {(1, 1), (2, 1), (3, 2)}


def test_copies_with_few_literals_are_found(spark):
    items = [
        (1, "Compute 12 34 56 km 78 90 12 and 11 plus 17 times 9 minus 4 5 6 7"),
        (2, "THE QUICK BROWN FOX JUMPS OVER THE LAZY DOG AND RUNS AWAY"),
        (3, "1 2 3 4 5 6 7 8 9 10"),
        (4, "we read that the old table now shows 3 4 5 km 7 km 9 km 12 km 15 km 18 km 21 km 24 km 27 km 30 km 33 km 36 km"),
    ]
    docs = [(k, f"In Table 5 {text} 77 Then") for k, text in items]
    changed = [(5, items[3][1].replace("7", "8").replace("3", "6"))]  # its template
    assert set(found(spark, docs + changed, items)) == {(k, k) for k, _ in items} | {(5, 4)}


def test_a_torn_slot_costs_its_windows_only(spark):
    apples = "the old farmer has 3 apples and 5 pears in his small wooden basket near the door"
    long = f"{prose(1, 20)} the man Tom {prose(2, 20)} the man Tom {prose(3, 20)}"
    docs = [(1, apples.replace("3", "4").replace("5", "4")), (2, long.replace("Tom", "Tim", 1))]
    matches = found(spark, docs, [(1, apples), (2, long)])
    assert set(matches) == {(1, 1), (2, 2)}
    assert matches[2, 2].matched < matches[2, 2].windows


def test_texts_together_have_the_windows_of_each():
    rng, texts = random.Random(6), []
    for k in range(60):
        words = [rng.choice(["km", "Tom", "Ann", "12", "3.5", "sheep", "and", "fence", ".", "buys"]) for _ in range(rng.choice([0, 1, 5, 9, 40]))]
        texts.append(" ".join(words))
    sizes = [(kind, size) for kind in (0, 1) for size in (3, 7, 8)]
    bits = np.packbits(np.ones(1 << decontamination.BITS, dtype=bool), bitorder="little")
    made = decontamination.Canonicaliser()

    def rows(found, row=None):
        return sorted(
            (int(t) if row is None else row, int(w), int(p), int(a), tuple(s.tolist()))
            for text, window, place, at, slots in found
            for t, w, p, a, s in zip(text, window, place, at, slots)
        )

    together = rows(decontamination._document_windows(made.tokens(texts), sizes, bits))
    each = [rows(decontamination._document_windows(made.tokens([t]), sizes, bits), k) for k, t in enumerate(texts)]
    assert together == sorted(x for found in each for x in found) and len(together) > 1000


def hits(item, document):
    """The joined windows of one item in one document, as they are judged."""
    made = decontamination.Canonicaliser()
    hashes, slot, of = made.tokens([item])
    last = len(decontamination._collapsed(hashes, slot, of)[0]) - 1
    found = decontamination._item_windows(hashes, slot)
    templates = sum(len(f[2]) for f in found if f[0] == 0)
    windows = len(set().union(*(f[3].tolist() for f in found)))
    bits = np.packbits(np.ones(1 << decontamination.BITS, dtype=bool), bitorder="little")
    sizes = [(f[0], f[1]) for f in found]
    seen = {}
    for _, window, place, at, slots in decontamination._document_windows(made.tokens([document]), sizes, bits):
        for w, p, a, s in zip(window.tolist(), place, at, slots):
            seen.setdefault(w, []).append((p, a, s))
    rows = [
        (kind, p, a, n, len(hashes), last, templates, windows, dp, da, s, ds)
        for kind, _, rolled, place, at, span, slots in found
        for w, p, a, n, s in zip(rolled.tolist(), place, at, span, slots)
        for dp, da, ds in seen.get(w, ())
    ]
    names = ["kind", "place", "at", "span", "tokens", "last", "templates", "windows", "doc_place", "doc_at", "slots", "doc_slots"]
    columns = [pa.array([int(r[k]) for r in rows]) for k in range(10)]
    columns += [pa.array([r[k].tolist() for r in rows], pa.list_(pa.int64())) for k in (10, 11)]
    return pa.table(columns, names=names)


def test_a_repeated_window_is_judged_at_once():
    item = prose(3, 30)
    few = hits(item, " ".join(item.split()[:8] + ["between", "them"] * 3) * 1000)
    start = time.perf_counter()
    assert decontamination._best(few, 0.5) is None
    assert time.perf_counter() - start < 0.5
    # A whole copy behind very many pieces is found.
    late = hits(item, f"{' '.join(item.split()[:8] + ['x'] * 90) * 300} {item}")
    assert decontamination._best(late, 0.5)[0] > 10


def test_ties(spark):
    passage, other = prose(3, 40), prose(4, 40)
    docs = [(1, f"{passage}\n{prose(9, 50)}\n{passage}", 0, ""), (2, f"{passage} {other}", 0, "")]
    found = decontamination.contaminated(
        spark.createDataFrame(docs, "doc_id long, text string, item_id int, window string"),
        spark.createDataFrame([(1, passage), (2, passage), (3, other)], "item_id long, text string"),
    ).collect()
    assert sorted((r.doc_id, r.item_id) for r in found) == [(1, 1), (1, 2), (2, 1), (2, 2), (2, 3)]
    assert all(r.verbatim for r in found)
