"""Shards of the language model follow from the size of its input."""

from pyspark.sql import functions as F
from tests_llm_data import prose
from voltlake.llm import interpolated_lm as lm


def test_shards_grow_with_the_input(spark, monkeypatch):
    rows = [(k, prose(k, 30)) for k in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    asked, ask = [], lm._ask
    monkeypatch.setattr(lm, "_ask", lambda shards: asked.append(shards) or ask(shards))
    monkeypatch.setattr(lm, "SHARD_BYTES", 100, raising=False)
    held_out, deleted = F.col("doc_id") % 5 == 1, F.col("doc_id") % 5 == 3
    small = sorted(lm.score_texts(docs, held_out, deleted).collect())
    assert asked == [-(-sum(len(t) for _, t in rows) // 100)] and asked[0] > 12
    assert small == sorted(lm.score_texts(docs, held_out, deleted, shards=1).collect())
