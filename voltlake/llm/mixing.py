"""Mixing sources to target weights by Sainte-Laguë apportionment of equal-token blocks.

Every source has a target, its weight's share of the mix, at most so many times its own size. The
mix is handed out in blocks of equally many words: the next block goes where target / (2k + 1) is
highest, k being the blocks a source has so far. A source's blocks are handed down to its shards
in the same way, by the words they hold, through bundles of shards, so that no step sees more
than ``FAN`` of them together. A shard puts its documents one after the other, cuts the words
into blocks, takes every block equally often, and those that a seeded hash ranks first once more.

Texts are read once, to be counted. What is shuffled after that is one small row per document.
"""

from __future__ import annotations

import heapq
from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltlake.llm.common import written

WORD = r"[^\x20\x09-\x0D]+"
FAN = 1024  # shards of a bundle
COPIES = 1000  # rows that repeat source, id and size, and stay together


def targets(
    sizes: Sequence[int], weights: Sequence[float], share: float = 1.5, most: float = 2.0
) -> list[float]:
    """``share`` of all sizes dealt by weight; what a source may not take, being above ``most``
    times its size, is dealt anew among the others until none is above. Without weight: 0."""
    result = [0.0] * len(sizes)
    open_, left = [i for i, w in enumerate(weights) if w > 0], share * sum(sizes)
    while open_:
        unit = left / sum(weights[i] for i in open_)
        full = {i for i in open_ if unit * weights[i] > most * sizes[i]}
        for i in full or open_:
            result[i] = float(most * sizes[i] if full else unit * weights[i])
        left -= sum(result[i] for i in full)
        open_ = [i for i in open_ if i not in full] if full else []
    return result


def apportion(weights: np.ndarray, caps: np.ndarray, seats: int) -> np.ndarray:
    """Seats by highest quotients weight / (2k + 1); ties go to the earlier one, none above its
    cap. Fewer seats than ``seats`` are given only if all caps (of those with weight) are met."""
    weights, caps = np.asarray(weights, dtype=np.float64), np.asarray(caps, dtype=np.int64)
    given = np.zeros(len(weights), dtype=np.int64)
    # A divisor that is too large gives everyone at most what is due; it leaves about one seat
    # for each to the heap.
    while True:
        free = (given < caps) & (weights > 0)
        n, left = int(free.sum()), seats - int(given[~free].sum())
        if left <= n or not n:
            break
        divisor = weights[free].sum() / (left - n / 2)
        due = np.minimum(caps[free], np.maximum(given[free], np.floor(weights[free] / divisor + 0.5)))
        if (due == given[free]).all():
            break
        given[free] = due
    left = seats - int(given.sum())
    heap = [(-w / (2 * g + 1), i) for i, (w, g, c) in enumerate(zip(weights, given, caps)) if w > 0 and g < c]
    heapq.heapify(heap)
    while left > 0 and heap:
        _, i = heap[0]
        given[i], left = given[i] + 1, left - 1
        if given[i] < caps[i]:
            heapq.heapreplace(heap, (-weights[i] / (2 * given[i] + 1), i))
        else:
            heapq.heappop(heap)
    return given


def _mixed(values: np.ndarray) -> np.ndarray:
    """64-bit finalizer of SplitMix: spreads every bit of its input."""
    z = values.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def block_times(n_blocks: int, quota: int, seed: int, source_no: int, shard: int) -> np.ndarray:
    """How often each block is taken: all equally often, and the rest by seeded rank."""
    every, extra = divmod(quota, n_blocks)
    times = np.full(n_blocks, every, dtype=np.int64)
    if extra:
        start = _mixed(_mixed(_mixed(np.array([seed])) ^ np.uint64(source_no)) ^ np.uint64(shard))
        rank = np.argsort(_mixed(np.arange(n_blocks, dtype=np.uint64) ^ start), kind="stable")
        times[rank[:extra]] += 1
    return times


def _sizes(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """source, doc_id, size and how many rows have these; copies meet before they are shuffled."""
    return (
        docs.select(
            F.col(source_col).cast("string").alias("source"),
            F.col(id_col).alias("doc_id"),
            F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        )
        .groupBy("source", "doc_id", "size")
        .agg(F.count(F.lit(1)).alias("copies"))
    )


def _plan(
    sizes: DataFrame,
    weights: Sequence[float] | Mapping[str | None, float],
    share: float,
    most: int,
    shard_words: int,
    shard_rows: int,
    max_sources: int,
) -> list[tuple]:
    """Per source, by code point and null last: name, number, shards, size and target."""
    found = (
        sizes.groupBy("source")
        .agg(F.sum(F.col("size") * F.col("copies")).alias("words"), F.sum("copies").alias("rows"))
        .limit(max_sources + 1)
        .collect()
    )
    if len(found) > max_sources:
        raise ValueError(f"more than {max_sources} sources to weigh")
    found.sort(key=lambda r: (r.source is None, r.source or ""))
    if isinstance(weights, Mapping):
        chosen = [float(weights.get(r.source, 0)) for r in found]
    else:
        chosen = [float(weights[i % len(weights)]) for i in range(len(found))]
    goals = targets([r.words for r in found], chosen, share, most)
    shards = [max(1, -(-r.words // shard_words), -(-r.rows // shard_rows)) for r in found]
    return [(r.source, i, n, r.words, goal) for i, (r, n, goal) in enumerate(zip(found, shards, goals))]


def _quotas(plan: list[tuple], caps: Mapping[int, int], most: int, block: int) -> list[tuple[int, int]]:
    """Blocks of each source. Where all of a source is wanted, every block is; the others share
    the rest by highest quotients."""
    whole = {i: caps[i] for _, i, _, size, goal in plan if goal >= most * size}
    goals = np.array([0.0 if i in whole else goal for _, i, _, _, goal in plan])
    seats = apportion(goals, np.array([caps[i] for _, i, *_ in plan]), round(goals.sum() / block))
    return [(i, whole.get(i, int(n))) for (_, i, *_), n in zip(plan, seats)]


def _handed_down(parents: DataFrame, children: DataFrame, parent: list[str], child: str) -> DataFrame:
    """``quota`` of every child: its parent's, apportioned by words."""

    def run(above: pa.Table, below: pa.Table) -> pa.Table:
        below = below.sort_by(child)
        quota = above.column("quota")[0].as_py() if above.num_rows else 0
        words, caps = (below.column(c).to_numpy() for c in ("words", "cap"))
        seats = apportion(words, caps, quota)
        keys = [below.column(c) for c in (*parent, child)]
        return pa.table([*keys, pa.array(seats)], names=[*parent, child, "quota"])

    kinds = dict(children.dtypes)
    schema = ", ".join(f"{c} {kinds[c]}" for c in (*parent, child)) + ", quota long"
    return parents.groupBy(*parent).cogroup(children.groupBy(*parent)).applyInArrow(run, schema)


def mix(
    docs: DataFrame,
    weights: Sequence[float] | Mapping[str | None, float],
    share: float = 1.5,
    most: int = 2,
    block: int = 32,
    seed: int = 13,
    shard_words: int = 1 << 20,
    shard_rows: int = 1 << 13,
    max_sources: int = 100_000,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """source, doc_id, size, source_size, target, taken, spans for every row of ``docs``.

    ``size`` counts the words of the whole text (null or blank: 0), ``taken`` the words of it that
    the mix takes, repeats counted; ``spans`` says which: first word, end and how often, in order
    and without words that are not taken. ``weights`` are by source, others weighing 0, or a list that
    repeats over the sources in the order of code points, null last.

    The words taken of a source differ from its target by a block and, for each of its shards, less than
    one more; a target of ``most`` times its size is every block that often. A document is
    never taken more than ``most`` times. Nothing depends on the layout of the table: the same
    rows give the same mix. Rows that repeat id, source and size are alike to the operator: the
    same set of ``taken`` for them on every run. Null ids and sources are values like others; an
    empty table gives no rows; other columns play no part. The sources come to the driver, a
    row each; more than ``max_sources`` raise a ValueError.
    """
    spark = docs.sparkSession
    sizes = written(_sizes(docs, id_col, text_col, source_col), "mix-sizes")
    plan = _plan(sizes, weights, share, most, shard_words, shard_rows, max_sources)
    # At most ``max_sources`` rows.
    sources = F.broadcast(
        spark.createDataFrame(plan, "source_of string, source_no int, n_shards long, source_size long, target double")
    )
    piece = F.explode(F.sequence(F.lit(0), F.expr(f"(copies - 1) div {COPIES}")))
    rows = (
        sizes.withColumn("piece", piece)
        .withColumn("copies", F.least(F.lit(COPIES), F.col("copies") - F.col("piece") * COPIES))
        .join(sources, F.col("source").eqNullSafe(F.col("source_of")))
        .select(
            "source_no",
            F.pmod(F.xxhash64(F.lit(seed), "doc_id", "size", "piece"), F.col("n_shards")).alias("shard"),
            "doc_id", "size", "piece", "copies",
        )
    )
    shards = (
        rows.groupBy("source_no", "shard")
        .agg(F.sum(F.col("size") * F.col("copies")).alias("words"))
        .withColumns(
            {
                "bundle": F.expr(f"shard div {FAN}"),
                "cap": most * F.ceil(F.col("words") / block).cast("long"),
            }
        )
    )
    shards = written(shards, "mix-shards")
    bundles = shards.groupBy("source_no", "bundle").agg(F.sum("words").alias("words"), F.sum("cap").alias("cap"))
    caps = shards.groupBy("source_no").agg(F.sum("cap").alias("cap")).collect()  # a row each again
    blocks = _quotas(plan, {r.source_no: r.cap for r in caps}, most, block)
    quotas = spark.createDataFrame(blocks, "source_no int, quota long")
    quotas = _handed_down(quotas, bundles, ["source_no"], "bundle")
    quotas = _handed_down(quotas, shards, ["source_no", "bundle"], "shard").select("source_no", "shard", "quota")

    def take(table: pa.Table, quota: pa.Table) -> pa.Table:
        order = [(c, "ascending") for c in ("doc_id", "size", "piece")]
        table = table.take(pc.sort_indices(table, sort_keys=order))
        copies = table.column("copies").to_numpy()
        lengths = np.repeat(table.column("size").to_numpy(), copies)
        ends = np.cumsum(lengths)
        starts, total = ends - lengths, int(ends[-1])
        source_no, shard = (table.column(c)[0].as_py() for c in ("source_no", "shard"))
        n_blocks = -(-total // block)
        seats = quota.column("quota")[0].as_py() if quota.num_rows else 0
        times = block_times(n_blocks, seats, seed, source_no, shard) if n_blocks else np.zeros(0, np.int64)
        # Words taken before each block; a place within a block adds its own share.
        before = np.concatenate(([0], np.cumsum(times * block)))
        times = np.append(times, 0)

        def taken_before(place: np.ndarray) -> np.ndarray:
            at = place // block
            return before[at] + (place - at * block) * times[at]

        repeated = table.take(pa.array(np.repeat(np.arange(len(copies)), copies)))
        return pa.table(
            [
                repeated.column("doc_id"), repeated.column("size"), repeated.column("source_no"),
                pa.array(taken_before(ends) - taken_before(starts)), _spans(starts, ends, times, block),
            ],
            names=names,
        )

    names = ["doc_id", "size", "source_no", "taken", "spans"]
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, size long, source_no int, taken long, spans array<struct<first: long, end: long, times: long>>"
    dealt = rows.groupBy("source_no", "shard").cogroup(quotas.groupBy("source_no", "shard")).applyInArrow(take, schema)
    return dealt.join(sources, "source_no").select(
        F.col("source_of").alias("source"), "doc_id", "size", "source_size", "target", "taken", "spans"
    )


def _spans(starts: np.ndarray, ends: np.ndarray, times: np.ndarray, block: int) -> pa.Array:
    """The stretches of each document that are taken, with neighbours of equal times as one."""
    n_blocks = len(times) - 1
    edges = np.flatnonzero(np.diff(times[:n_blocks])) + 1
    cuts = edges * block  # places where the number of times changes
    after = np.searchsorted(cuts, starts, "right")
    inside = np.where(ends > starts, np.searchsorted(cuts, ends, "left") - after + 1, 0)
    owner = np.repeat(np.arange(len(starts)), inside)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(inside) - inside, inside)
    cuts = np.append(cuts, 0)
    first = np.where(nth == 0, starts[owner], cuts[after[owner] + nth - 1])
    last = nth == inside[owner] - 1
    end = np.where(last, ends[owner], cuts[np.where(last, 0, after[owner] + nth)])
    often = times[first // block]
    some = often > 0
    counts = np.bincount(owner[some], minlength=len(starts))
    offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
    values = pa.StructArray.from_arrays(
        [
            pa.array((first - starts[owner])[some]), pa.array((end - starts[owner])[some]),
            pa.array(often[some]),
        ],
        names=["first", "end", "times"],
    )
    return pa.ListArray.from_arrays(pa.array(offsets), values)
