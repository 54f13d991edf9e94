"""Near-duplicates by SuperMinHash: signatures, bands, links verified on the texts, groups.

1. Each whole text becomes the set of its five-word shingles, its size, a fingerprint of the set,
   and a SuperMinHash signature. Documents of equal sets are one class from here on, represented
   by the smallest id.
2. Signatures are cut into bands; representatives that agree in a band share a bucket. A pair at
   the threshold of 0.85 misses all 32 buckets of 7 values with a chance of 4e-6.
3. In each bucket everybody is compared with the smallest id only, so that a bucket makes as many
   candidates as it has members, not their square. Candidates are verified on the full shingle
   sets of both texts, and the links grouped.
4. What is left are buckets that still hold several groups. Members outside the group of the
   bucket's smallest id are strangers; they meet each other and the group's members in blocks of
   bounded size, which get the members' full sets once, as 64-bit hashes. A block verifies there
   every pair of two groups whose signatures come within six standard deviations of the threshold,
   skips what it has already joined, and hands on the links that joined something: fewer than it has members.
   No bucket is capped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltlake.llm.common import texts, written
from voltlake.llm.components import components
from voltlake.llm.rank_bpe import in_pieces
from voltlake.llm.superminhash import mix64, signatures

WORDS = 5
PERCENT = 85
BANDS, ROWS = 32, 7
SLOTS = BANDS * ROWS
BLOCK = 1000  # members of a block, of one kind
BLOCK_SHINGLES = 4 << 20  # and their shingles
TOGETHER = 64  # sets that are compared with one at a time
_U64 = np.uint64


def words_of(text: str) -> list[bytes]:
    """Words of a text with A-Z in lower case, between blanks (0x20, 0x09 to 0x0D)."""
    return text.encode().lower().split()


def shingles_of(text: str) -> set[bytes]:
    words = words_of(text)
    if len(words) < WORDS:
        return {b" ".join(words)} if words else set()
    return {b" ".join(words[k : k + WORDS]) for k in range(len(words) - WORDS + 1)}


def similar(first: set, second: set, percent: int = PERCENT) -> bool:
    shared = len(first & second)
    return bool(first) and 100 * shared >= percent * (len(first) + len(second) - shared)


def hashed_shingles(batch: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles of each text, sorted within it, and the text of each."""
    words = [words_of(t) for t in batch]
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    flat = [w for ws in words for w in ws]
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, flat), dtype=np.uint64, count=len(flat))
    counts = np.where(sizes >= WORDS, sizes - WORDS + 1, np.minimum(sizes, 1))
    owner = np.repeat(np.arange(len(batch)), counts)
    first = np.concatenate(([0], np.cumsum(sizes)[:-1])) if len(sizes) else sizes
    within = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    start = np.repeat(first, counts) + within
    length = np.repeat(np.minimum(sizes, WORDS), counts)
    total = length.astype(np.uint64)
    padded = np.concatenate((hashes, np.zeros(WORDS, dtype=np.uint64)))
    factor = 0x9E3779B97F4A7C15
    with np.errstate(over="ignore"):
        for k in range(WORDS):
            part = padded[start + k] * _U64(factor)
            total += np.where(k < length, part, _U64(0))
            factor = factor * 0xD1342543DE82EF95 % (1 << 64) | 1
    total = mix64(total)
    ends = np.cumsum(counts)
    for a, b in zip(ends - counts, ends):
        total[a:b].sort()
    fresh = np.ones(len(total), dtype=bool)
    fresh[1:] = (total[1:] != total[:-1]) | (owner[1:] != owner[:-1])
    return total[fresh], owner[fresh]


def _fingerprints(elements: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Two 64-bit sums over each set, whatever the order of its elements."""
    sums = np.zeros((2, n), dtype=np.uint64)
    for k, salt in enumerate((0x1F83D9ABFB41BD6B, 0x5BE0CD19137E2179)):
        np.add.at(sums[k], owner, mix64(elements ^ _U64(salt)))
    return sums


def hashed_sets(source: DataFrame) -> DataFrame:
    """doc_id, the fingerprint (k1, k2) and the sorted 64-bit hashes of each row's set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in in_pieces(batch, 2 << 20):
                elements, owner = hashed_shingles(part.column("text").to_pylist())
                sums = _fingerprints(elements, owner, part.num_rows)
                ends = np.searchsorted(owner, np.arange(part.num_rows + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"), pa.array(sums[0].view(np.int64)), pa.array(sums[1].view(np.int64)),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(elements.view(np.int64))),
                    ],
                    ["doc_id", "k1", "k2", "hashes"],
                )

    kind = source.schema["doc_id"].dataType.simpleString()
    return source.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, k1 long, k2 long, hashes array<long>")


def sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, a fingerprint of the set (k1, k2), band keys, signature marks."""
    source = texts(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in in_pieces(batch, 2 << 20):
                n = part.num_rows
                elements, owner = hashed_shingles(part.column("text").to_pylist())
                signed = signatures(elements, owner, n, SLOTS)
                sums = _fingerprints(elements, owner, n)
                bands = np.zeros((n, BANDS), dtype=np.uint64)
                for row in range(ROWS):
                    bands = mix64(bands ^ signed[:, row::ROWS])
                marks = mix64(signed).astype(np.uint8)
                empty = np.bincount(owner, minlength=n) == 0
                ends = np.arange(0, n * BANDS + 1, BANDS, dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(np.bincount(owner, minlength=n).astype(np.int64)),
                        pa.array(sums[0].view(np.int64)),
                        pa.array(sums[1].view(np.int64)),
                        pa.ListArray.from_arrays(
                            pa.array(ends), pa.array(bands.view(np.int64).ravel())
                        ),
                        pa.array([None if e else m.tobytes() for e, m in zip(empty, marks)], pa.binary()),
                    ],
                    ["doc_id", "n_shingles", "k1", "k2", "bands", "marks"],
                )

    return source.mapInArrow(
        run,
        f"doc_id {source.dtypes[0][1]}, n_shingles long, k1 long, k2 long, bands array<long>,"
        " marks binary",
    )


def _sizes_allow(one: Column, other: Column, percent: int) -> Column:
    return F.lit(100) * F.least(one, other) >= F.lit(percent) * F.greatest(one, other)


def verified(pairs: DataFrame, source: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of ids whose texts are linked, judged on their full sets of shingles."""
    first = source.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    second = source.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    held = pairs.join(first, "b").join(second, "a").select("a", "b", "text_a", "text_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, shingles = None, set()  # rows of one `a` follow each other
        for batch in batches:
            for part in in_pieces(batch):
                keep = []
                a, text_a, text_b = (part.column(c).to_pylist() for c in ("a", "text_a", "text_b"))
                for k, whole in enumerate(text_a):
                    if (a[k], whole) != known:
                        known, shingles = (a[k], whole), shingles_of(whole)
                    if similar(shingles, shingles_of(text_b[k]), percent):
                        keep.append(k)
                yield part.select(["a", "b"]).take(pa.array(keep, pa.int64()))

    kind = source.schema["doc_id"].dataType.simpleString()
    return held.mapInArrow(run, f"a {kind}, b {kind}")


def _joining_links(percent: int):
    """For the members of a block: links that join two of its groups, until no pair is left that would.

    A block holds strangers and members of the bucket's first group ("others"), or strangers of one part
    of the bucket or two. A pair is looked at only in the first band that the two share.
    """
    share = percent / 100
    agree = share - 6 * np.sqrt(share * (1 - share) / SLOTS)

    def run(key, table):
        band, one_part = key[0].as_py(), key[2].as_py() == key[3].as_py()
        side = table.column("part").to_numpy()
        ids = table.column("doc_id").to_pylist()
        _, group = np.unique(table.column("label").to_numpy(zero_copy_only=False), return_inverse=True)
        n = table.column("n_shingles").to_numpy()
        marks = np.frombuffer(b"".join(table.column("marks").to_pylist()), dtype=np.uint8).reshape(len(ids), SLOTS)
        bands = table.column("bands").combine_chunks().flatten().to_numpy().reshape(len(ids), BANDS)
        hashes = table.column("hashes").combine_chunks().flatten().to_numpy().view(np.uint64)
        ends = np.cumsum(n)

        def shared(k: int, others: np.ndarray) -> np.ndarray:
            own = hashes[ends[k] - n[k] : ends[k]]
            theirs = np.concatenate([hashes[ends[x] - n[x] : ends[x]] for x in others])
            at = np.minimum(np.searchsorted(own, theirs), len(own) - 1)
            return np.add.reduceat((own[at] == theirs).astype(np.int64), np.cumsum(n[others]) - n[others])

        links = []
        for k in range(len(ids) - 1):
            left = np.flatnonzero(group[k + 1 :] != group[k]) + k + 1
            if not one_part:
                left = left[side[left] != side[k]]
            small, large = np.minimum(n[left], n[k]), np.maximum(n[left], n[k])
            left = left[100 * small >= percent * large]
            if len(left):
                left = left[(marks[left] == marks[k]).mean(axis=1) >= agree]
            if len(left):
                left = left[(bands[left] == bands[k]).argmax(axis=1) == band]
            while len(left):
                some, left = left[:TOGETHER], left[TOGETHER:]
                both = shared(k, some)
                for x in some[100 * both >= percent * (n[some] + n[k] - both)]:
                    if group[x] != group[k]:
                        links.append(sorted((ids[k], ids[x])))
                        group[group == group[x]] = group[k]
                left = left[group[left] != group[k]]
        kind = table.schema.field("doc_id").type
        return pa.table({"a": pa.array([a for a, _ in links], kind), "b": pa.array([b for _, b in links], kind)})

    return run


def _upto(n: Column) -> Column:
    """0 to n - 1; nothing for 0."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def _blocks(members: DataFrame, buckets: DataFrame) -> DataFrame:
    """Members of mixed buckets, each in all the blocks it is needed in.

    Strangers of a bucket are cut into parts and the members of its first group into others, each by bytes
    and number. A pair of parts is a block, and so is a part with a part of the group: the group's members
    do not meet each other, and few strangers cost few copies however large the group is.
    """
    parts = {
        side: F.ceil(F.greatest(F.col(f"n_{side}") / BLOCK, F.col(f"shingles_{side}") / BLOCK_SHINGLES)).cast("int")
        for side in ("strangers", "group")
    }
    held = members.join(buckets, ["band", "key"]).withColumns(
        {"parts_strangers": parts["strangers"], "parts_group": parts["group"], "stranger": F.col("label") != F.col("first")}
    )
    own = F.when(F.col("stranger"), F.col("parts_strangers")).otherwise(F.col("parts_group"))
    held = held.withColumn("own", F.pmod(F.xxhash64("doc_id"), own).cast("int"))
    other = F.lit(-1) - F.col("own")  # parts of the group have numbers below zero
    among = F.transform(_upto(F.col("parts_strangers")), lambda p: F.struct(
        F.least("own", p).alias("low"), F.greatest("own", p).alias("high")
    ))
    with_group = F.transform(_upto(F.col("parts_group")), lambda p: F.struct((F.lit(-1) - p).alias("low"), F.col("own").alias("high")))
    with_strangers = F.transform(_upto(F.col("parts_strangers")), lambda p: F.struct(other.alias("low"), p.alias("high")))
    places = F.when(F.col("stranger"), F.concat(among, with_group)).otherwise(with_strangers)
    return held.select(
        "band", "key", "doc_id", "label",
        F.when(F.col("stranger"), F.col("own")).otherwise(other).alias("part"), F.explode(places).alias("place"),
    ).select("band", "key", "doc_id", "label", "part", "place.low", "place.high")


def near_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT
) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs``.

    Two documents are linked when 100 * |both| >= ``percent`` * |either| of their sets of distinct
    five-word shingles; a shorter text is one shingle as a whole. A null or blank text has an
    empty set and is linked with nothing. component_id is the smallest doc_id reachable over
    links, kept is whether that is the row's own. Rows that share an id are one document, linked
    to whatever one of them is linked to; a row without id is linked to nothing and kept, with a
    null component. An empty table gives no rows; other columns play no part.
    """
    source = texts(docs, id_col, text_col)
    all_rows = written(sketches(docs, id_col, text_col), "sketches")
    linkable = all_rows.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    members = linkable.select("doc_id", "n_shingles", "k1", "k2")
    classes = written(
        members.groupBy("n_shingles", "k1", "k2").agg(F.min("doc_id").alias("rep")), "classes"
    )
    reps = linkable.join(
        classes.select(F.col("rep").alias("doc_id"), "n_shingles", "k1", "k2"),
        ["doc_id", "n_shingles", "k1", "k2"],
        "left_semi",
    ).dropDuplicates(["doc_id", "n_shingles", "k1", "k2"])
    rows = reps.select("doc_id", "n_shingles", F.posexplode("bands").alias("band", "key"))

    # One comparison for each member of a bucket.
    hubs = (
        rows.groupBy("band", "key")
        .agg(F.min(F.struct("doc_id", "n_shingles")).alias("hub"), F.count(F.lit(1)).alias("size"))
        .filter("size > 1")
    )
    shared = written(
        rows.join(hubs, ["band", "key"]).select("band", "key", "doc_id", "n_shingles", "hub"), "buckets"
    )
    candidates = (
        shared.filter(F.col("hub.doc_id") != F.col("doc_id"))
        .filter(_sizes_allow(F.col("hub.n_shingles"), F.col("n_shingles"), percent))
        .select(F.col("hub.doc_id").alias("a"), F.col("doc_id").alias("b"))
        .distinct()
    )
    # An id with several texts joins the classes of all of them.
    texts_differ = " OR ".join(f"min({c}) != max({c})" for c in ("n_shingles", "k1", "k2"))
    several = members.groupBy("doc_id").agg(F.expr(texts_differ).alias("several")).filter("several")
    ids = (
        members.join(several, "doc_id", "left_semi")
        .join(classes, ["n_shingles", "k1", "k2"])
        .select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))
    )
    links = written(verified(candidates, source, percent).union(ids), "links")
    labels = components(links)

    # Buckets that hold several groups.
    labelled = shared.join(labels.withColumnRenamed("id", "doc_id"), "doc_id", "left").select(
        "band", "key", "doc_id", "n_shingles", F.coalesce("label", "doc_id").alias("label"),
        (F.col("hub.doc_id") == F.col("doc_id")).alias("is_hub"),
    )
    buckets = labelled.groupBy("band", "key").agg(
        F.min("label").alias("lowest"), F.max("label").alias("highest"),
        F.max(F.when(F.col("is_hub"), F.col("label"))).alias("first"),
    ).filter("lowest != highest").select("band", "key", "first")
    undecided = written(
        labelled.join(buckets, ["band", "key"]).filter("NOT is_hub").drop("is_hub"), "undecided"
    )
    if not undecided.isEmpty():
        stranger = F.col("label") != F.col("first")
        counts = undecided.groupBy("band", "key", "first").agg(
            F.count_if(stranger).alias("n_strangers"), F.count_if(~stranger).alias("n_group"),
            F.sum(F.when(stranger, F.col("n_shingles")).otherwise(0)).alias("shingles_strangers"),
            F.sum(F.when(~stranger, F.col("n_shingles")).otherwise(0)).alias("shingles_group"),
        )
        ids_met = written(undecided.select("doc_id").distinct(), "undecided-ids")
        sets = written(hashed_sets(source.join(ids_met, "doc_id", "left_semi")), "undecided-sets")
        known = reps.join(ids_met, "doc_id", "left_semi").join(
            sets.dropDuplicates(["doc_id", "k1", "k2"]), ["doc_id", "k1", "k2"]
        )
        blocks = _blocks(undecided.select("band", "key", "doc_id", "label"), counts).join(
            known.select("doc_id", "n_shingles", "bands", "marks", "hashes"), "doc_id"
        )
        kind = all_rows.schema["doc_id"].dataType.simpleString()
        late = written(
            blocks.groupBy("band", "key", "low", "high").applyInArrow(_joining_links(percent), f"a {kind}, b {kind}"),
            "links",
        )
        if not late.isEmpty():
            labels = components(links.union(late))

    grouped = classes.join(labels.select(F.col("id").alias("rep"), "label"), "rep", "left").select(
        "n_shingles", "k1", "k2", F.coalesce("label", "rep").alias("component_id")
    )
    # A large class meets its one row here; the join splits hot keys at run time.
    linked = members.join(grouped, ["n_shingles", "k1", "k2"]).select(
        "doc_id", "n_shingles", "component_id"
    )
    alone = all_rows.filter("n_shingles = 0 OR doc_id IS NULL").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id")
    )
    return linked.union(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
