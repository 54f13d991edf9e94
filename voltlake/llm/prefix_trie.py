"""The trie of what conversations begin with: how many share each opening, and what sharing saves.

Every prefix of a conversation gets a digest that its turns add up to, so that it can be
computed by running totals, which no conversation is too long for. Equal digests are one node;
that they stand for equal turns is verified for all of them. Nodes with one member need no
further work, as what is below them is one conversation's rest. The others are dealt
into shards by whole subtrees: of nodes with up to 1024 members first, then of those with up to
1024 times as many, and so on, so that a shard has at most about 1024 nodes of each depth from one
subtree. A shard gives its nodes slots by a minimal perfect hash, scatters what is counted into
flat arrays and adds it up along parent slots, deepest first. What its topmost nodes have found goes to
their parents before those are dealt. Texts are read once, to be hashed, and never shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltlake.llm.common import written
from voltlake.llm.node_table import subtree_sums
from voltlake.llm.running import running

PRIME = (1 << 31) - 1
LANES = ("t0", "t1", "t2", "t3")
NODE = ("depth", "d1", "d2")
END_BITS = 9  # ids that are put in order together: ranges of 512
NOTHING = hashlib.sha256(b"").hexdigest()


def numbered(conversations: DataFrame) -> DataFrame:
    """conv_id, rank (from 1), n_bytes of the text and the turn's 120-bit hash (a, b).

    Turns are in the order of ``turn``, null first; equal ones in the order of role, then of their
    hash. A null role or text is empty. Repeated rows are turns that follow each other. Rows without conv_id belong
    to no conversation and are left out.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    sha = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    turns = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        role.alias("role"),
        F.conv(F.substring(sha, 1, 15), 16, 10).cast("long").alias("a"),
        F.conv(F.substring(sha, 16, 15), 16, 10).cast("long").alias("b"),
        F.octet_length(text).cast("long").alias("n_bytes"),
        F.lit(1).cast("long").alias("rank"),
    )
    ranked = running(turns, ["conv_id"], ["turn", "role", "a", "b"], ["rank"], "trie-turns")
    return written(ranked.select("conv_id", F.col("sum_rank").alias("rank"), "n_bytes", "a", "b"), "trie-ranked")


def as_given(ranked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The turns of :func:`numbered` as they are: (conv_id, depth, last, n_bytes, a, b) of every
    turn and (conv_id, total) of every conversation."""
    convs = written(ranked.groupBy("conv_id").agg(F.max("rank").alias("total")), "trie-conversations")
    turns = ranked.join(convs, "conv_id").select(
        "conv_id", F.col("rank").alias("depth"), (F.col("rank") == F.col("total")).alias("last"), "n_bytes", "a", "b"
    )
    return turns, convs


def grafted(ranked: DataFrame, family: int = 5, most: int = 9) -> tuple[DataFrame, DataFrame]:
    """As :func:`as_given`, of conversations whose first turns are another's: conversation c has the
    first h turns of c - c % ``family`` and its own after its first h, h being crc32(c) % ``most``.
    A conversation may be left without any turn."""
    donor = F.col("conv_id") - F.col("conv_id") % family
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    own = ranked.groupBy("conv_id").agg(F.max("rank").alias("length")).withColumns({"donor": donor, "h": h})
    own = written(own, "trie-lengths")
    lent = F.least("h", F.coalesce("donor_length", F.lit(0)))
    kept = F.when(F.col("donor") == F.col("conv_id"), F.lit(0)).otherwise(F.col("h"))
    convs = (
        own.join(own.select(F.col("conv_id").alias("donor"), F.col("length").alias("donor_length")), "donor", "left")
        .withColumns({"skipped": kept, "lent": F.when(F.col("donor") == F.col("conv_id"), F.lit(0)).otherwise(lent)})
        .withColumn("total", F.col("lent") + F.greatest(F.col("length") - F.col("skipped"), F.lit(0)))
        .select("conv_id", "donor", "skipped", "lent", "total")
    )
    convs = written(convs, "trie-conversations")
    rest = (
        ranked.join(convs.select("conv_id", "skipped", "lent", "total"), "conv_id")
        .filter(F.col("rank") > F.col("skipped"))
        .withColumn("depth", F.col("lent") + F.col("rank") - F.col("skipped"))
    )
    # At most ``most`` - 1 turns of each donor.
    openings = ranked.filter((F.col("rank") < most) & (F.col("conv_id") % family == 0)).select(
        F.col("conv_id").alias("donor"), F.col("rank").alias("depth"), "n_bytes", "a", "b"
    )
    borrowed = openings.join(convs.filter("conv_id <> donor"), "donor").filter(F.col("depth") <= F.col("lent"))
    columns = ["conv_id", "depth", (F.col("depth") == F.col("total")).alias("last"), "n_bytes", "a", "b"]
    return rest.select(*columns).union(borrowed.select(*columns)), convs.select("conv_id", "total")


def _powers(base: int, exponents: np.ndarray) -> np.ndarray:
    result, left = np.ones(len(exponents), dtype=np.int64), exponents.copy()
    while left.any():
        result = np.where(left & 1, result * base % PRIME, result)
        base, left = base * base % PRIME, left >> 1
    return result


def with_terms(turns: DataFrame, seed: int) -> DataFrame:
    """Adds what a turn at its depth adds to the digest, in four lanes."""
    rng = np.random.default_rng(seed)
    bases = [int(b) for b in rng.integers(1 << 20, PRIME, len(LANES))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, depth = (batch.column(c).to_numpy() for c in ("a", "b", "depth"))
            parts = (a >> 30, a & ((1 << 30) - 1), b >> 30, b & ((1 << 30) - 1))
            terms = [pa.array((part + 1) * _powers(x, depth) % PRIME) for part, x in zip(parts, bases)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *terms], [*batch.schema.names, *LANES])

    schema = ", ".join(f"{c} {kind}" for c, kind in turns.dtypes) + "".join(f", {lane} long" for lane in LANES)
    return turns.mapInArrow(run, schema)


def members(turns: DataFrame, seed: int) -> DataFrame:
    """A row for each turn: the digest (d1, d2) of all up to it, and (p1, p2) of those before."""
    sums = running(with_terms(turns, seed), ["conv_id"], ["depth"], LANES, "trie-terms")

    def packed(high: Column, low: Column) -> Column:
        return F.shiftleft(F.pmod(high, F.lit(PRIME)), 31).bitwiseOR(F.pmod(low, F.lit(PRIME)))

    upto, before = ([F.col(f"sum_{t}") - (F.col(t) if less else 0) for t in LANES] for less in (False, True))
    return written(
        sums.select(
            "conv_id", "depth", "last", "n_bytes", "a", "b",
            packed(*upto[:2]).alias("d1"), packed(*upto[2:]).alias("d2"),
            packed(*before[:2]).alias("p1"), packed(*before[2:]).alias("p2"),
        ),
        "trie-members",
    )


def _nodes(rows: DataFrame) -> DataFrame:
    """A row for each digest, and whether all its members agree on the last turn and what is before."""
    same = [F.min(c) == F.max(c) for c in ("p1", "p2", "a", "b")]
    agree = same[0] & same[1] & same[2] & same[3]
    return written(
        rows.groupBy(*NODE).agg(
            F.min("p1").alias("p1"), F.min("p2").alias("p2"),
            F.min("conv_id").alias("conv_id"),
            F.count(F.lit(1)).alias("n_convs"),
            F.count_if("last").alias("n_ends"),
            F.max("n_bytes").alias("n_bytes"),
            agree.alias("agree"),
        ),
        "trie-nodes",
    )


def _ends(rows: DataFrame, convs: DataFrame) -> DataFrame:
    """ends_sha256 of the nodes at which conversations end.

    Ids are joined in ranges of 512 before they are shuffled by node; the ranges of a node with
    more than one stream through a task, which holds a few of them at a time.
    """
    root = [F.lit(0).cast("long").alias(c) for c in NODE]
    ending = rows.filter("last").select(*NODE, "conv_id").union(
        convs.filter("total = 0").select(*root, "conv_id")
    )
    ids = F.array_join(F.sort_array(F.collect_list("conv_id")), ",").alias("ids")
    ranges = written(ending.groupBy(*NODE, F.shiftright("conv_id", END_BITS).alias("range")).agg(ids), "trie-ends")
    found = ranges.groupBy(*NODE).agg(F.count(F.lit(1)).alias("n_ranges"), F.min("ids").alias("ids"))
    short = found.filter("n_ranges = 1").select(*NODE, F.sha2(F.col("ids").cast("binary"), 256).alias("ends_sha256"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, hashlib.sha256()
        for batch in batches:
            done = []
            for *key, ids in zip(*(batch.column(c).to_pylist() for c in (*NODE, "ids"))):
                if node is not None and key != node:
                    done.append((*node, digest.hexdigest()))
                    digest = hashlib.sha256()
                elif node is not None:
                    digest.update(b",")
                node = key
                digest.update(ids.encode())
            yield packed(done)
        if node is not None:
            yield packed([(*node, digest.hexdigest())])

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [()] * 4
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [*NODE, "ends_sha256"])

    long = (
        ranges.join(found.filter("n_ranges > 1").select(*NODE), list(NODE), "left_semi")
        .repartition(*NODE)
        .sortWithinPartitions(*NODE, "range")
        .mapInArrow(run, "depth long, d1 long, d2 long, ends_sha256 string")
    )
    return short.union(long)


def _placed(shared: DataFrame, rows: DataFrame, fan_bits: int, shard_nodes: int) -> tuple[DataFrame, int]:
    """Level and shard of nodes with several members, and the highest level.

    The level says how many times ``fan_bits`` bits the number of members has; it never rises
    on the way down. Nodes of one level that hang together go to one shard: the one of their
    topmost node, which lies on the way of any member.
    """
    bits = F.length(F.bin(F.col("n_convs") - 1))
    leveled = written(shared.withColumn("level", F.ceil(bits / fan_bits).cast("int")), "trie-shared")
    counts = {r.level: r["count"] for r in leveled.groupBy("level").count().collect()}
    top = max(counts, default=0)
    # The nodes of the highest level hang together from the root.
    lower = leveled.filter(F.col("level") < top).select(*NODE, "level")
    topmost = (
        rows.select("conv_id", *NODE)
        .join(lower, list(NODE))
        .groupBy("conv_id", "level")
        .agg(F.min(F.struct(*NODE)).alias("topmost"))
    )
    shards = F.lit(1)
    for level, n in counts.items():
        shards = F.when(F.col("level") == level, F.lit(-(-n // shard_nodes))).otherwise(shards)
    placed = leveled.join(topmost, ["conv_id", "level"], "left").withColumn(
        "shard", F.pmod(F.xxhash64("topmost.depth", "topmost.d1", "topmost.d2"), shards).cast("long")
    )
    return written(placed.drop("topmost"), "trie-placed"), top


def _accumulated(placed: DataFrame, top: int) -> DataFrame:
    """n_leaves and saved of all nodes of ``placed``, the lowest level first."""
    kept = ["conv_id", *NODE, "p1", "p2", "n_convs", "n_children"]
    schema = ", ".join(f"{c} long" for c in (*kept, "n_leaves", "saved")) + ", topmost boolean"

    def run(table: pa.Table) -> pa.Table:
        depth, d1, d2, p1, p2, n_leaves, saved = (
            table.column(c).to_numpy() for c in (*NODE, "p1", "p2", "n_leaves", "saved")
        )
        (n_leaves, saved), topmost = subtree_sums(depth, (d1, d2), (p1, p2), [n_leaves, saved])
        return pa.table(
            [*(table.column(c) for c in kept), pa.array(n_leaves), pa.array(saved), pa.array(topmost)],
            names=[*kept, "n_leaves", "saved", "topmost"],
        )

    done = None
    for level in range(1, top + 1):
        rows = placed.filter(F.col("level") == level)
        if done is not None:
            below = (
                done.filter("topmost")
                .groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("d1"), F.col("p2").alias("d2"))
                .agg(F.sum("n_leaves").alias("leaves_below"), F.sum("saved").alias("saved_below"))
            )
            rows = rows.join(below, list(NODE), "left").withColumns(
                {
                    "n_leaves": F.col("n_leaves") + F.coalesce("leaves_below", F.lit(0)),
                    "saved": F.col("saved") + F.coalesce("saved_below", F.lit(0)),
                }
            )
        found = written(rows.groupBy("shard").applyInArrow(run, schema), "trie-level")
        done = found if done is None else done.union(found)
    return done


def trie(turns: DataFrame, convs: DataFrame, fan_bits: int = 10, shard_nodes: int = 1 << 14, seed: int = 11) -> DataFrame:
    """A row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    A node is a distinct sequence of first turns (role and text), from the empty one on; its members
    are the conversations that begin with it, conv_id the smallest of them and parent_conv_id that of its
    parent. n_leaves counts the childless nodes of its subtree, itself included; saved_tokens adds up,
    over its subtree, the members beyond the first times the bytes of the last text; ends_sha256 is of
    the ids of the members that end here, ascending and joined by commas. Takes turns and conversations as
    from :func:`as_given`. Without conversations there is no node.

    A shard grows with the depth of what it holds: a few thousand conversations that share a
    million turns are a million slots of about 100 bytes.
    """
    while True:
        rows = members(turns, seed)
        nodes = _nodes(rows)
        if nodes.filter("NOT agree").isEmpty():
            break
        seed += 1  # two different openings had one digest
    zero = F.lit(0).cast("long")
    root = convs.agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.count_if(F.col("total") == 0).alias("n_ends")
    ).filter("n_convs > 0")
    nodes = nodes.drop("agree").unionByName(
        root.withColumns({c: zero for c in (*NODE, "n_bytes")} | {c: F.lit(None).cast("long") for c in ("p1", "p2")})
    )
    children = (
        nodes.filter("depth > 0")
        .groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("d1"), F.col("p2").alias("d2"))
        .agg(F.count(F.lit(1)).alias("n_children"), F.count_if(F.col("n_convs") == 1).alias("n_single"))
    )
    shared = (
        nodes.filter("n_convs > 1")
        .join(children, list(NODE), "left")
        .fillna(0, ["n_children", "n_single"])
        .withColumns(
            {
                "n_leaves": F.col("n_single") + (F.col("n_children") == 0).cast("long"),
                "saved": (F.col("n_convs") - 1) * F.col("n_bytes"),
            }
        )
        # The root's parent is nobody's digest.
        .fillna(-1, ["p1", "p2"])
    )
    columns = ["conv_id", *NODE, "p1", "p2", "n_convs", "n_children", "n_leaves", "saved"]
    every = nodes.filter("n_convs = 1").withColumns(
        {"n_children": 1 - F.col("n_ends"), "n_leaves": F.lit(1).cast("long"), "saved": zero}
    ).select(*columns)
    placed, top = _placed(shared, rows, fan_bits, shard_nodes)
    if top:
        every = every.union(_accumulated(placed, top).select(*columns))
    parents = nodes.select(
        (F.col("depth") + 1).alias("depth"), F.col("d1").alias("p1"), F.col("d2").alias("p2"),
        F.col("conv_id").alias("parent_conv_id"),
    )
    return (
        every.join(parents, ["depth", "p1", "p2"], "left")
        .join(_ends(rows, convs), list(NODE), "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
            F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(NOTHING)).alias("ends_sha256"),
        )
    )
