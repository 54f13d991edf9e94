"""Groups of equal texts by a tree-merge of sorted digest runs.

Every text is read once, to be replaced by a digest. The digests are dealt into runs by document
id. A run holds each of its digests once, sorted, with the identifier to keep and a count. Runs
then meet in rounds: ``fan_in`` neighbouring runs are merged into one, round after round, until
one run is left, which is itself spread over all partitions by digest. The answer goes back down
the same tree: each run learns the outcome from the run it was merged into.

So no step ever brings the copies of one text together: in the first round a text with a third of
all rows is a few rows of each run, and above that one row per run; a parent hands its answer to
``fan_in`` children at most. Digests, never texts, are shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltlake.llm.common import shuffle_partitions, texts, written

# What makes two texts equal: SHA-256, verified by length and an independent 64-bit hash.
KEY = ("digest", "n_bytes", "check")


def digests(docs: DataFrame, runs: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, the run it is dealt to, and the key of its whole text."""
    text = F.col("text")
    return texts(docs, id_col, text_col).select(
        "doc_id",
        F.pmod(F.xxhash64("doc_id"), F.lit(runs)).cast("int").alias("run"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"),
        F.octet_length(text).cast("long").alias("n_bytes"),
        F.xxhash64(text).alias("check"),
    )


def exact_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "largest",
    fan_in: int = 16,
    runs: int | None = None,
) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row of ``docs``.

    Texts are equal when identical, byte for byte; null counts as empty. ``keep`` says whether the
    "largest" or the "smallest" doc_id of a group stays. Rows that repeat both id and text are all
    returned, all counted in group_size, and alike in ``kept``; a null id never stays unless its
    group has no other. An empty table gives no rows; other columns play no part.
    """
    if keep not in ("largest", "smallest"):
        raise ValueError("keep must be 'largest' or 'smallest'")
    if fan_in < 2:
        raise ValueError("fan_in must be at least 2")
    best = F.max if keep == "largest" else F.min
    runs = runs or shuffle_partitions(docs.sparkSession)
    leaves = written(digests(docs, runs, id_col, text_col), "exact-digests")

    def merged(rows: DataFrame, size) -> DataFrame:
        return (
            rows.groupBy("run", *KEY)
            .agg(best("doc_id").alias("doc_id"), size.alias("size"))
            .sortWithinPartitions("run", "digest")
        )

    # Up: levels[0] are the runs themselves, the last level is one run.
    levels = [written(merged(leaves, F.count(F.lit(1))), "exact-run")]
    left = runs
    while left > 1:
        left = -(-left // fan_in)
        above = levels[-1].withColumn("run", F.floor(F.col("run") / fan_in).cast("int"))
        levels.append(written(merged(above, F.sum("size")), "exact-run"))

    # Down: what the run above has found replaces what a run knew by itself.
    answer = levels[-1].select("run", *KEY, F.col("doc_id").alias("keep_id"), F.col("size").alias("group_size"))
    for level in reversed(levels[:-1]):
        parent = answer.withColumnRenamed("run", "parent")
        answer = (
            level.select("run", F.floor(F.col("run") / fan_in).cast("int").alias("parent"), *KEY)
            .join(parent, ["parent", *KEY])
            .select("run", *KEY, "keep_id", "group_size")
        )
    return leaves.join(answer, ["run", *KEY]).select(
        "doc_id",
        "keep_id",
        F.col("group_size").cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
