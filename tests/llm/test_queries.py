"""The registered queries and the pipeline over the given tables, against brute force."""

import zlib

import duckdb
import pytest

pytest.importorskip("public_tokenizers")

import corpus_pipeline  # noqa: E402
from voltlake.llm import near_dedup, queries  # noqa: E402


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@pytest.fixture(scope="module")
def found(spark, sf_dir):
    return {name: query(spark, sf_dir).toPandas() for name, query in queries.queries().items()}


@pytest.mark.parametrize("name", [n for n in queries.queries() if not n.startswith(("op5", "op9", "op11", "op12"))])
def test_one_row_per_document(spark, sf_dir, found, name):
    ids = sorted(r.doc_id for r in table(spark, sf_dir, "documents").select("doc_id").collect())
    assert sorted(found[name].doc_id) == ids


@pytest.mark.parametrize("name", queries.oracle_sql())
def test_sql(sf_dir, found, name):
    with duckdb.connect() as db:
        for name_of_table in ("documents", "conversations"):
            db.sql(f"CREATE VIEW {name_of_table} AS FROM '{sf_dir}/{name_of_table}.parquet'")
        expected = db.sql(queries.oracle_sql()[name]).df()[list(found[name].columns)]
    key = list(found[name].columns)
    ours, theirs = (t.sort_values(key).convert_dtypes().astype(str).to_numpy().tolist() for t in (found[name], expected))
    assert ours == theirs


def test_held_out_quality(spark, sf_dir, found):
    labels = {r.doc_id: r.toxic for r in table(spark, sf_dir, "labels").collect()}
    toxic = found["op3_toxicity"]
    known = toxic[toxic.held_out & toxic.doc_id.isin(labels)]
    assert (known.predicted == known.doc_id.map(labels)).mean() >= 0.85
    langs = {r.doc_id: r.lang for r in table(spark, sf_dir, "documents").select("doc_id", "lang").collect()}
    lang = found["op7_language_id"]
    known = lang[lang.held_out & (lang.lang_pred != "und")]
    assert (known.lang_pred == known.doc_id.map(langs)).mean() >= 0.9
    scores = found["op2_interpolated_lm"]
    assert scores[scores.held_out].score.sum() > scores[scores.held_out].base_score.sum()
    assert all(h == (zlib.crc32(str(i).encode()) % 5 == 1) for i, h in zip(scores.doc_id, scores.held_out))


def test_pipeline(spark, sf_dir):
    docs = queries.ready(spark).read.parquet(f"{sf_dir}/documents.parquet")
    columns, left = docs.columns, [{r.doc_id: r.text or "" for r in docs.collect()}]
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir).cache()
        if name != "encoding":
            assert docs.columns == columns
            left.append({r.doc_id: r.text or "" for r in docs.collect()})
    given, clean, distinct, apart, unleaked = left
    assert set(distinct) == {max(i for i, u in clean.items() if u == t) for t in set(clean.values())}
    sets = {i: near_dedup.shingles_of(t) for i, t in apart.items()}
    assert not any(near_dedup.similar(sets[a], sets[b]) for a in sets for b in sets if a < b)
    passages = [r.text for r in table(spark, sf_dir, "benchmark").collect()]
    assert set(unleaked) == {i for i, t in apart.items() if not any(p in t for p in passages)}
    assert sorted(r.doc_id for r in docs.collect()) == sorted(unleaked)
    assert corpus_pipeline.run(spark, sf_dir).count() == len(unleaked)
