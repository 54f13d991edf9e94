"""Deleted interpolation: a bigram model mixed by the frequency of the context.

    P(w | v) = m2(b) * c(v w) / c(v)  +  m1(b) * c(w) / N  +  m0(b) / (V + 1)

b is the bucket of the context's count. The mixture weights of each bucket are learned by
expectation-maximisation on counts that were held out: the maximum-likelihood estimates of that
step come from the training texts outside the deleted fold, the events from those inside it. The
counts of the final model are those of all training texts.

A corpus has far too many distinct n-grams to hand every task a table, so texts and counts meet
in between. Texts are worked on in blocks. Each block asks for its distinct words and word pairs
(64-bit hashes, with its own counts), dealt over ``shards`` by value; a shard adds up what all
blocks tell it and answers each block with the totals, in the order of its question. Questions
and answers are packed arrays: one row for each block and shard. A block is a few megabytes, a
shard holds 1 / ``shards`` of all questions, so neither grows if shards grow with the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltlake.llm.common import shuffle_partitions, texts, written
from voltlake.llm.near_dedup import words_of
from voltlake.llm.rank_bpe import in_pieces
from voltlake.llm.superminhash import mix64

BLOCK_BYTES = 12 << 20
SHARD_BYTES = 1 << 25  # of text whose words and pairs one shard counts, so that its group stays small
BUCKETS = 24  # contexts by the binary logarithm of their count
STEPS = 8  # per doubling, in which the evidence for the mixture weights is gathered
LEAST = 2 * BUCKETS * STEPS
LEARNED, DELETED, OTHER = 0, 1, 2  # roles of a text
_U64 = np.uint64
_END = np.array([xxhash.xxh64_intdigest(b"", seed=1)], dtype=np.uint64)


def _tokens(batch: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed tokens of all texts in a row, an end after each, and the tokens of each text."""
    hashed: list[np.ndarray] = []
    for text in batch:
        words = words_of(text)
        hashed += [np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words)), _END]
    sizes = np.fromiter(map(len, hashed[::2]), dtype=np.int64, count=len(batch)) + 1
    return np.concatenate(hashed) if hashed else np.zeros(0, np.uint64), sizes


def _pairs(tokens: np.ndarray) -> np.ndarray:
    """Each token with the one before it. Before the first stands an end, as between texts."""
    before = np.concatenate((_END, tokens[:-1]))
    with np.errstate(over="ignore"):
        return mix64(before * _U64(0x9E3779B97F4A7C15) ^ mix64(tokens))


def _blocks(batches: Iterator[pa.RecordBatch], roles: tuple[int, ...]):
    """(block, role, rows) of the wanted roles. Numbers depend on the partition and its rows only,
    so a block that is made again, for the answers or after a loss, is the same block."""
    part, number = TaskContext.get().partitionId(), 0
    for batch in batches:
        for piece in in_pieces(batch, BLOCK_BYTES):
            told = piece.column("role").to_numpy()
            for role in (LEARNED, DELETED, OTHER):
                if role in roles and (told == role).any():
                    yield (part << 34) | (number << 2) | role, role, piece.take(pa.array(np.flatnonzero(told == role)))
            number += 1


def _pack(values: np.ndarray) -> bytes:
    return pa.compress(values.astype("<u4").tobytes(), codec="zstd", asbytes=True)


def _unpack(raw: bytes, size: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(raw, 4 * size, codec="zstd", asbytes=True), dtype="<u4").astype(np.int64)


def _ask(shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, role, rows in _blocks(batches, (LEARNED, DELETED, OTHER)):
            tokens, _ = _tokens(rows.column("text").to_pylist())
            out = []
            for gram, values in enumerate((tokens, _pairs(tokens)), 1):
                keys, counts = np.unique(values, return_counts=True)
                shard = ((keys >> _U64(32)) * _U64(shards) >> _U64(32)).astype(np.int64)
                cuts = np.searchsorted(shard, np.arange(shards + 1))
                for k in np.flatnonzero(np.diff(cuts)):
                    a, b = cuts[k], cuts[k + 1]
                    told = None if role == OTHER else _pack(counts[a:b])
                    out.append((block, role, gram, int(k), keys[a:b].tobytes(), told))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), _ASKED.types)], schema=_ASKED
            )

    return run


_ASKED = pa.schema(
    [("block", pa.int64()), ("role", pa.int32()), ("gram", pa.int32()), ("shard", pa.int32()),
     ("keys", pa.binary()), ("counts", pa.binary())]
)
_TOLD = pa.schema(
    [("block", pa.int64()), ("gram", pa.int32()), ("shard", pa.int32()), ("size", pa.int64()),
     ("total", pa.binary()), ("learned", pa.binary()),
     ("tokens", pa.int64()), ("kinds", pa.int64()), ("learned_tokens", pa.int64())]
)


def _answer(table):
    """What a shard tells each block that has asked, and in one more row its own sums."""
    blocks, roles, grams, shards = (table.column(c).to_pylist() for c in ("block", "role", "gram", "shard"))
    raw, counts = table.column("keys").to_pylist(), table.column("counts").to_pylist()
    out = []
    for gram in (1, 2):
        rows = [k for k, g in enumerate(grams) if g == gram]
        if not rows:
            continue
        keys = [np.frombuffer(raw[k], dtype=np.uint64) for k in rows]
        known, place = np.unique(np.concatenate(keys), return_inverse=True)
        ends = np.concatenate(([0], np.cumsum([len(x) for x in keys])))
        learned, deleted = np.zeros(len(known), dtype=np.int64), np.zeros(len(known), dtype=np.int64)
        for at, k in enumerate(rows):
            if roles[k] != OTHER:  # keys are distinct within a row
                sums = learned if roles[k] == LEARNED else deleted
                sums[place[ends[at] : ends[at + 1]]] += _unpack(counts[k], len(keys[at]))
        total = learned + deleted
        for at, k in enumerate(rows):
            own = place[ends[at] : ends[at + 1]]
            more = _pack(learned[own]) if roles[k] == DELETED else None
            out.append((blocks[k], gram, shards[k], len(own), _pack(total[own]), more, None, None, None))
        if gram == 1:
            sums = int(total.sum()), int((total > 0).sum()), int(learned.sum())
            out.append((-1, gram, shards[rows[0]], 0, None, None, *sums))
    return pa.table([pa.array(c, t) for c, t in zip(zip(*out), _TOLD.types)], schema=_TOLD)


def _structure(roles: tuple[int, ...]):
    """Blocks as they wait for their answers: ids, sizes, distinct words and their order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, role, rows in _blocks(batches, roles):
            tokens, sizes = _tokens(rows.column("text").to_pylist())
            words, place = np.unique(tokens, return_inverse=True)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([block]),
                    pa.array([[None if v is None else str(v) for v in rows.column("doc_id").to_pylist()]], pa.list_(pa.string())),
                    pa.array([sizes.tolist()], pa.list_(pa.int64())),
                    pa.array([words.tobytes()], pa.binary()),
                    pa.array([_pack(place)], pa.binary()),
                ],
                ["block", "ids", "sizes", "words", "places"],
            )

    return run, "block long, ids array<string>, sizes array<long>, words binary, places binary"


def _counted(block, answers, column: str, n_words: int, n_pairs: int | None = None):
    """The answers of all shards put together again, for words and for pairs."""
    found = {1: {}, 2: {}}
    for gram, shard, size, raw in zip(*(answers.column(c).to_pylist() for c in ("gram", "shard", "size", column))):
        found[gram][shard] = _unpack(raw, size)
    words, pairs = (np.concatenate([v for _, v in sorted(found[g].items())]) for g in (1, 2))
    if len(words) != n_words or (n_pairs is not None and len(pairs) != n_pairs):
        raise RuntimeError("a block was not made the same way again; materialise the input first")
    return words, pairs


def _events(block, answers, column: str):
    """For each token of a block: the counts of its context, of itself and of the two together."""
    sizes = np.array(block.column("sizes")[0].as_py(), dtype=np.int64)
    words = np.frombuffer(block.column("words")[0].as_py(), dtype=np.uint64)
    place = _unpack(block.column("places")[0].as_py(), int(sizes.sum()))
    keys, pair_place = np.unique(_pairs(words[place]), return_inverse=True)
    c_words, c_pairs = _counted(block, answers, column, len(words), len(keys))
    own = c_words[place]
    end = c_words[np.searchsorted(words, _END[0])]
    context = np.concatenate(([end], own[:-1]))
    return sizes, context, own, c_pairs[pair_place]


def bucket_of(context: np.ndarray) -> np.ndarray:
    """0 for a context that was not seen, then one bucket for each doubling of its count."""
    seen = np.log2(np.maximum(context, 1)).astype(np.int64) + 1
    return np.where(context > 0, np.minimum(seen, BUCKETS - 1), 0)


def _evidence(tokens: int, kinds: int):
    """How often each (bucket, bigram estimate, unigram estimate) occurs in a deleted block. The
    estimates are relative to the uniform one, in steps of 1/STEPS of a doubling."""

    def run(key, block, answers):
        if not block.num_rows:
            return _EVIDENCE.empty_table()
        _, context, own, pair = _events(block, answers, "learned")

        def steps(share):
            level = np.round(STEPS * np.log2(np.maximum(share * (kinds + 1), 1e-12)))
            return np.where(share > 0, np.maximum(level, -LEAST + 1), -LEAST).astype(np.int64)

        cells = np.stack(
            (bucket_of(context), steps(pair / np.maximum(context, 1)), steps(own / max(tokens, 1)))
        )
        cells, counts = np.unique(cells, axis=1, return_counts=True)
        return pa.table([*map(pa.array, cells), pa.array(counts)], schema=_EVIDENCE)

    return run


_EVIDENCE = pa.schema([(c, pa.int64()) for c in ("bucket", "bigram", "unigram", "n")])


def learn_weights(cells: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Mixture weights (bucket; uniform, unigram, bigram) by expectation-maximisation.

    ``cells`` has rows (bucket, bigram, unigram, n). A bucket without evidence, and the one of
    unseen contexts, take the weights of all buckets together, without the bigram if there is no
    context.
    """
    shares = np.ones((len(cells), 3))
    for column, source in ((1, cells[:, 2]), (2, cells[:, 1])):
        shares[:, column] = np.where(source > -LEAST, np.exp2(source / STEPS), 0.0)
    bucket, n = cells[:, 0], cells[:, 3].astype(np.float64)
    weights = np.tile(np.array([0.1, 0.45, 0.45]), (BUCKETS, 1))
    weights[0] = (0.2, 0.8, 0.0)
    for _ in range(rounds):
        parts = shares * weights[bucket]
        parts *= (n / parts.sum(axis=1))[:, None]
        gathered = np.zeros((BUCKETS, 3))
        np.add.at(gathered, bucket, parts)
        # One event of each component keeps every weight above zero; none has a bigram unseen.
        gathered += np.where(weights > 0, 1.0, 0.0) * np.array([1.0, 0.5, 0.5])
        weights = gathered / gathered.sum(axis=1, keepdims=True)
    return weights


def _score(tokens: int, kinds: int, weights: np.ndarray):
    def run(key, block, answers):
        if not block.num_rows:
            return _SCORED.empty_table()
        sizes, context, own, pair = _events(block, answers, "total")
        mix = weights[bucket_of(context)]
        chance = mix[:, 2] * pair / np.maximum(context, 1) + mix[:, 1] * own / max(tokens, 1)
        chance += mix[:, 0] / (kinds + 1)
        base = np.log10((own + 0.5) / (tokens + 0.5 * (kinds + 1)))
        starts = np.cumsum(sizes) - sizes
        summed = [np.add.reduceat(x, starts) for x in ((own > 0).astype(np.int64), base, np.log10(chance))]
        ids = block.column("ids")[0].as_py()
        held = [(key[0].as_py() & 3) == OTHER] * len(ids)
        columns = [ids, held, sizes, summed[0], [tokens] * len(ids), summed[1], summed[2]]
        return pa.table([pa.array(c, t) for c, t in zip(columns, _SCORED.types)], schema=_SCORED)

    return run


_SCORED = pa.schema(
    [("id", pa.string()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
     ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())]
)


def _ddl(schema: pa.Schema) -> str:
    kinds = {pa.int64(): "long", pa.int32(): "int", pa.binary(): "binary", pa.string(): "string",
             pa.bool_(): "boolean", pa.float64(): "double"}
    return ", ".join(f"{f.name} {kinds[f.type]}" for f in schema)


def score_texts(
    docs: DataFrame,
    held_out: Column,
    deleted: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    shards: int | None = None,
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row.

    The model learns from the rows where ``held_out`` is false; those of them where ``deleted`` is
    true are the deleted fold, from which the mixture weights are learned. Tokens are words with
    A-Z in lower case, and one end per text, which is also the context of the first word. n_known
    counts tokens seen in training, base_score is the log10 probability under smoothed single
    tokens, score that under the mixture. Null and blank texts are one end. Repeated rows count
    and are scored each time, null ids are carried along, an empty table gives no rows, other
    columns play no part. Without training text every estimate is uniform. Rows must come in the
    same order each time they are read, as those of files do; anything else is noticed and raised.
    Without ``shards`` there is one for each 32 MB of text, and no fewer than shuffle partitions.
    """
    spark = docs.sparkSession
    if not shards:
        size = docs.agg(F.sum(F.octet_length(F.col(text_col)))).first()[0] or 0
        shards = max(12, shuffle_partitions(spark), -(-size // SHARD_BYTES))
    role = F.when(held_out, OTHER).when(deleted, DELETED).otherwise(LEARNED)
    source = texts(docs.withColumn("__role", role), id_col, text_col, "__role").withColumnRenamed("__role", "role")
    kind = source.schema["doc_id"].dataType
    answers = written(
        source.mapInArrow(_ask(shards), _ddl(_ASKED)).groupBy("shard").applyInArrow(_answer, _ddl(_TOLD)),
        "lm-counts",
    )
    sums = answers.agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in ("tokens", "kinds", "learned_tokens"))).first()
    tokens, kinds, learned_tokens = map(int, sums)

    def meet(roles, function, schema):
        run, ddl = _structure(roles)
        blocks = source.mapInArrow(run, ddl).groupBy("block")
        mine = answers.filter(F.col("block") >= 0)
        if roles == (DELETED,):
            mine = mine.filter(F.col("learned").isNotNull())
        return blocks.cogroup(mine.groupBy("block")).applyInArrow(function, schema)

    evidence = meet((DELETED,), _evidence(learned_tokens, kinds), _ddl(_EVIDENCE))
    # At most BUCKETS * (2 * LEAST) ** 2 cells, whatever the corpus; in practice some thousands.
    cells = evidence.groupBy("bucket", "bigram", "unigram").agg(F.sum("n").alias("n")).toPandas()
    weights = learn_weights(cells.to_numpy(dtype=np.int64).reshape(-1, 4))
    scored = meet((LEARNED, DELETED, OTHER), _score(tokens, kinds, weights), _ddl(_SCORED))
    return scored.withColumn("id", F.col("id").cast(kind)).withColumnRenamed("id", "doc_id")
