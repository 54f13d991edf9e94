"""Language model, language identification, toxicity."""

import collections
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests_llm_data import TEXTS, prose
from voltlake.llm import interpolated_lm as lm
from voltlake.llm import language_id, toxicity
from voltlake.llm.common import fold, is_fold


def test_folds(docs):
    found = docs.select("doc_id", fold(5).alias("n"), is_fold(5, 1).alias("is")).collect()
    for row in found:
        n = None if row.doc_id is None else zlib.crc32(str(row.doc_id).encode()) % 5
        assert (row.n, row["is"]) == (n, n == 1)


def brute_force_lm(rows, held, deleted, weights):
    tokens = [(t or "").encode().lower().split() + [None] for _, t in rows]
    one, two = collections.Counter(), collections.Counter()
    for own, out in zip(tokens, held):
        if not out:
            one.update(own)
            two.update(zip([None, *own[:-1]], own))
    total, kinds = sum(one.values()), len(one)
    for own in tokens:
        base = sum(math.log10((one[w] + 0.5) / (total + 0.5 * (kinds + 1))) for w in own)
        score = 0.0
        for before, w in zip([None, *own[:-1]], own):
            mix = weights[lm.bucket_of(np.array([one[before]]))[0]]
            score += math.log10(
                mix[2] * two[before, w] / max(one[before], 1) + mix[1] * one[w] / total + mix[0] / (kinds + 1)
            )
        yield len(own), sum(one[w] > 0 for w in own), total, base, score


def test_interpolated_lm(docs, monkeypatch):
    held, deleted = F.col("doc_id").isin(4, 10), F.col("doc_id").isin(2, 11)
    told = []
    learn = lm.learn_weights
    monkeypatch.setattr(lm, "learn_weights", lambda cells: told.append(learn(cells)) or told[-1])
    held_out = F.coalesce(held, F.lit(False))
    found = lm.score_texts(docs, held_out, F.coalesce(deleted, F.lit(False)), shards=5).collect()
    out = [i in (4, 10) for i, _ in TEXTS]
    expected = sorted((str(i), o, *r) for (i, _), o, r in zip(TEXTS, out, brute_force_lm(TEXTS, out, (), told[0])))
    for row, wanted in zip(sorted((str(r[0]), *r[1:]) for r in found), expected, strict=True):
        assert row[:5] == wanted[:5]
        assert row[5:] == pytest.approx(wanted[5:])
    assert np.allclose(told[0].sum(axis=1), 1)


def test_interpolated_lm_of_nothing(no_docs, docs):
    nothing = F.lit(False)
    assert lm.score_texts(no_docs, nothing, nothing).collect() == []
    untaught = lm.score_texts(docs, F.lit(True), nothing).collect()
    assert len(untaught) == len(TEXTS) and all(r.train_tokens == 0 for r in untaught)


def test_weights_follow_the_evidence():
    # Events that only the bigram explains, in bucket 3; only the unigram in bucket 5.
    cells = np.array([[3, 40, -lm.LEAST, 900], [5, -lm.LEAST, 40, 900], [5, -lm.LEAST, -lm.LEAST, 100]])
    weights = lm.learn_weights(cells)
    assert weights[3, 2] > 0.9 and weights[5, 1] > 0.8 and weights[5, 0] > 0.05
    assert weights[0, 2] == 0


SENTENCES = {
    "en": "the quick brown fox jumps over the lazy dog while they were walking through the wood",
    "de": "der schnelle braune fuchs springt über den faulen hund während sie durch den wald gingen",
    "fr": "le renard brun rapide saute par dessus le chien paresseux pendant qu'ils marchaient dans le bois",
    "es": "el rápido zorro marrón salta sobre el perro perezoso mientras ellos caminaban por el bosque",
}


def sentences(spark):
    rows = []
    for lang, text in SENTENCES.items():
        words = text.split()
        for k in range(40):
            rows.append((len(rows), " ".join(words[(k + j * 3) % len(words)] for j in range(9)), lang))
    rows += [(900, None, "en"), (901, "", None), (902, "123 !?", "de"), (903, SENTENCES["fr"], None), (None, SENTENCES["de"], None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string"), rows


def test_language_id(spark, no_docs):
    docs, rows = sentences(spark)
    model = language_id.fit(docs, F.coalesce(F.col("doc_id") % 4 != 2, F.lit(True)))
    assert model.families == ["germanic", "romance"] and len(model.pairs) == 2
    found = {r.doc_id: r for r in language_id.identify(docs, model).collect()}
    assert len(found) == len(rows)
    for i, text, lang in rows:
        row = found[i]
        assert 0 <= row.score <= 1
        if i is not None and i < 900 and i % 4 == 2:
            assert row.lang_pred == lang
    assert [found[i].lang_pred for i in (900, 901, 902, 903, None)] == ["und", "und", "und", "fr", "de"]
    assert language_id.identify(no_docs, model).collect() == []
    nothing = language_id.identify(docs, language_id.fit(docs, F.lit(False)))
    assert {r.lang_pred for r in nothing.collect()} == {"und"}


def test_a_language_without_known_family_is_its_own():
    model = language_id.fit_rows([("aa bb aa bb", "xx"), ("cc dd cc dd", "yy"), ("cc dd dd", "yy")])
    assert model.predict(["bb aa aa", "dd cc cc"])[0] == ["xx", "yy"]


def insults():
    rows = []
    for k in range(300):
        group = ("women", "muslims")[k % 2]
        # Mentions of one group and insults met in the sample.
        rows.append((f"{prose(k, 12)} {group} are idiots {prose(k + 1, 5)}", 1))
        rows.append((f"{prose(k, 12)} people came home {prose(k + 2, 5)}", 0))
        if k % 30 == 0:
            rows.append((f"the {group} came home", 0))
    return rows


def test_swapping_groups_changes_little():
    plain = toxicity.fit_rows(insults(), fairness=0.0)
    fair = toxicity.fit_rows(insults(), fairness=30.0)

    def gap(model):
        odds = [model.log_odds({group, "came", "home"}, model.remembered()) for group in ("women", "men", "girls")]
        return max(odds) - min(odds)

    assert gap(fair) < 0.5 * gap(plain)
    kept = fair.remembered()
    assert fair.log_odds({"men", "came", "home"}, kept) < 0 < fair.log_odds({"men", "are", "idiots"}, kept)


def test_toxicity_of_odd_rows(spark, docs, no_docs):
    rows = insults()
    table = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(rows)], "doc_id long, text string")
    labels = spark.createDataFrame(
        [(k, y) for k, (_, y) in enumerate(rows)] + [(0, 1), (1, None), (None, 1)], "doc_id long, toxic int"
    )
    model = toxicity.fit(table, labels, F.lit(True))
    found = toxicity.score(table, model).collect()
    assert sum(r.predicted == rows[r.doc_id][1] for r in found) > 0.99 * len(rows)
    odd = toxicity.score(docs, model).collect()
    assert len(odd) == len(TEXTS) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in odd)
    assert toxicity.score(no_docs, model).collect() == []
    untaught = toxicity.fit(table, labels, F.lit(False))
    assert {r.predicted for r in toxicity.score(table, untaught).collect()} == {0}
    kept = toxicity.without_toxic(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(r.predicted == 0 for r in odd)
