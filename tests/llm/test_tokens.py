"""Encoding, token files and prefix counts against the tokenizers library."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tests_llm_data import LONG, TEXTS
from voltlake.llm import prefix_counts, rank_bpe, token_files
from voltlake.llm.chunks import Memo, chunks
from voltlake.llm.vocabulary import load

PIECES = [
    " ", "  ", "\n", "\t", "a", "the", "'s", "'re", "'ll", "é", "ß", "<|endoftext|>", "<|endof", "12",
    "!", "\0", "\r\n", "xyzzy", "日本", "🙂", "\xa0", " '", "'", "ll", "\x1c", "ing",
]


def strange_texts(count, seed=5):
    rng = random.Random(seed)
    return ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 10))) for _ in range(count)]


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_chunks_join_to_the_text():
    for text in [*strange_texts(500), LONG]:
        assert "".join(chunks(text)) == text


def test_memo_forgets_what_the_last_batch_did_not_use():
    memo = Memo(str.upper, 2)
    assert [memo[k] for k in "abc"] == ["A", "B", "C"]
    memo.age("c")
    assert dict(memo) == {"c": "C"}


def test_every_token_is_encoded_as_itself(vocabulary):
    known = load(vocabulary)
    coded = rank_bpe.merge_words(list(known.id_of), known)
    assert all(raw == np.uint32(i).tobytes() for raw, i in zip(coded, known.id_of.values()))


def test_rank_bpe_is_the_library(vocabulary, library):
    coder = rank_bpe.Codec(vocabulary)
    texts = [*strange_texts(2000), "x" * 5000, LONG, ""]
    for text, ids in zip(texts, coder.encode_batch(texts)):
        assert ids.tolist() == ids_of(library, text)
        assert coder.decode(ids.tolist()) == library.decode(ids.tolist(), skip_special_tokens=False)


def test_long_words_merge_alike_in_all_three_ways(vocabulary, monkeypatch):
    known = load(vocabulary)
    rng = random.Random(2)
    for size in (1, 2, 5, 32, 33, 300):
        word = bytes(rng.choice(b"abeiourst") for _ in range(size))
        plain = rank_bpe.merge_word(word, known)
        assert np.frombuffer(rank_bpe.merge_words([word], known)[0], "<u4").tolist() == plain
        monkeypatch.setattr(rank_bpe, "SHORT", 0 if size <= 200 else 10**6)
        assert rank_bpe.merge_word(word, known) == plain
        monkeypatch.undo()


def test_decoding_bytes_that_are_no_text(vocabulary, library):
    ids = [load(vocabulary).byte_ids[b] for b in (0xE6, 0x97, 0x41, 0xFF)]
    assert rank_bpe.Codec(vocabulary).decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_round_trip_of_odd_rows(docs, no_docs, vocabulary, library):
    found = rank_bpe.round_trip(docs, vocabulary).collect()
    assert len(found) == len(TEXTS)
    expected = sorted(
        (str(i), len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
         hashlib.sha256((t or "").encode()).hexdigest(), True)
        for i, t in TEXTS for ids in [ids_of(library, t)]
    )
    assert sorted((str(r[0]), *r[1:]) for r in found) == expected
    assert rank_bpe.round_trip(no_docs, vocabulary).collect() == []
    coded = {r[0]: r[1] for r in rank_bpe.encode(docs, vocabulary).collect()}
    assert coded[10] == ids_of(library, dict(TEXTS)[10]) and coded[5] == []


def test_prefix_tables_are_exact(vocabulary, library):
    counter = prefix_counts.PrefixCounter(vocabulary)
    texts = strange_texts(300, seed=9)
    for text, table in zip(texts, counter.tables(texts)):
        assert table.tolist() == [len(ids_of(library, text[:k])) for k in range(len(text) + 1)]


def test_prefix_counts_of_odd_rows(docs, no_docs, vocabulary, library):
    found = prefix_counts.prefix_counts(docs, vocabulary, budget=3).cache()
    rows = found.collect()
    assert len(rows) == len(TEXTS)
    by_id = {r.doc_id: r for r in rows}
    for i, text in TEXTS:
        if i is None:
            continue
        ids, row = ids_of(library, text), by_id[i]
        assert (row.n_tokens, row.n_bytes) == (len(ids), len((text or "").encode()))
        if len(text or "") < 500:
            fits = [k for k in range(len(text or "") + 1) if len(ids_of(library, (text or "")[:k])) <= 3]
            assert row.fit_chars == fits[-1]
    asked = found.filter("doc_id = 8").select(
        prefix_counts.tokens_in_prefix(F.lit(5)).alias("n"),
        prefix_counts.tokens_in_prefix(F.lit(999)).alias("beyond"),
        prefix_counts.longest_within(F.lit(2)).alias("chars"),
    )
    assert asked.first() == (len(ids_of(library, "Three")), None, len("Three short"))
    assert prefix_counts.prefix_counts(no_docs, vocabulary).collect() == []


@pytest.mark.parametrize("in_chunks", [True, False])
def test_library_encoder_gives_whole_texts(vocabulary, library, in_chunks):
    coder = token_files.LibraryEncoder(vocabulary)
    if not in_chunks:
        coder._line_end = None
    texts = [*strange_texts(800), LONG, "", "a, b. c.,", "\n\n", "x.\n"]
    for text, raw in zip(texts, coder.encode_batch(texts)):
        assert np.frombuffer(raw, "<u4").tolist() == ids_of(library, text)


class Counted:
    """A tokenizer that notes the lines it is given."""

    def __init__(self, tokenizer):
        self.tokenizer, self.lines = tokenizer, []

    def encode(self, text, **more):
        self.lines += text.split("\n")
        return self.tokenizer.encode(text, **more)

    def encode_batch_fast(self, texts, **more):
        self.lines += [line for text in texts for line in text.split("\n")]
        return self.tokenizer.encode_batch_fast(texts, **more)


def test_library_gets_a_word_once_whatever_signs_follow(vocabulary, library):
    coder = token_files.LibraryEncoder(vocabulary)
    coder._tokenizer = counted = Counted(coder._tokenizer)
    texts = [f"tionchoi jadoes{signs} jadoes tionchoi{signs}" for signs in (".", ",", "***", "&&&.", "'", "?!")]
    texts += [f"jadoes{signs}" for signs in ("é.", "\u0301.", "×.", "5.", "'s.", "_'s'")]
    for text, raw in zip(texts, coder.encode_batch(texts)):
        assert np.frombuffer(raw, "<u4").tolist() == ids_of(library, text)
    assert counted.lines.count(" jadoes") == counted.lines.count("tionchoi") == 1


def test_library_encoder_keeps_words_that_are_used_often(vocabulary, library):
    coder = token_files.LibraryEncoder(vocabulary, remembered=8)
    coder._tokenizer = counted = Counted(coder._tokenizer)
    for text in ("often one", "often two", "often three", "four five six seven eight", "nine ten", "often one"):
        assert np.frombuffer(coder.encode_batch([text])[0], "<u4").tolist() == ids_of(library, text)
        assert len(coder._places) <= 8
    assert counted.lines.count("often") == 1


def test_library_encoder_of_odd_columns(vocabulary, library):
    coder = token_files.LibraryEncoder(vocabulary)
    assert coder.encode_batch([]) == []
    texts = ["", "a <|endoftext|> b", "", "x\0y. z", "one  two\n\n", "<|endoftext|>"]
    for column in (pa.array(["cut off", *texts]).slice(1), pa.array(texts, pa.large_string())):
        ids, numbers = coder.encode_column(column)
        expected = [ids_of(library, t) for t in texts]
        assert numbers.tolist() == list(map(len, expected)) and ids.tolist() == sum(expected, [])


def test_token_files(spark, docs, no_docs, vocabulary, library, tmp_path):
    out = str(tmp_path / "tokens")
    token_files.write_tokens(docs, vocabulary, out)
    rows = token_files.with_start(spark, out, token_files.checksums(token_files.read_tokens(spark, out)))
    found = sorted((r.start, str(r.doc_id), r.n_tokens, r.ids_crc32) for r in rows.collect())
    expected, start = [], 0
    for i, text in sorted(TEXTS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = [*ids_of(library, text), 0]
        expected.append((start, str(i), len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert found == expected
    assert token_files.read_tokens(spark, out, [8, 6]).count() == 3
    lengths = token_files.read_metadata(spark, out)
    assert lengths.select("doc_id").count() == len(TEXTS)
    plan = lengths._jdf.queryExecution().executedPlan().toString()
    assert "token_ids" not in plan
    file = next(p for p in sorted((tmp_path / "tokens").glob("*.parquet")) if pq.ParquetFile(p).metadata.num_rows)
    group = pq.ParquetFile(file).metadata.row_group(0)
    columns = {group.column(k).path_in_schema: group.column(k) for k in range(group.num_columns)}
    assert "RLE_DICTIONARY" in columns["token_ids.list.element"].encodings
    assert columns["doc_id"].encodings == ("DELTA_BINARY_PACKED",)
    assert columns["token_ids.list.element"].has_offset_index
    empty = str(tmp_path / "none")
    token_files.write_tokens(no_docs, vocabulary, empty)
    assert token_files.read_metadata(spark, empty).collect() == []
