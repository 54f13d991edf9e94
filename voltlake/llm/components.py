"""Connected components of a graph given as links, by labels that shrink."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltlake.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """(id, label) of every node of ``links`` (a, b); the label is the smallest id reachable.

    This is union-find in rounds for all nodes at once: a node takes the smallest label among its
    neighbours and itself (union), then the label of its label (find, with the path halved), until
    nothing changes; chains of any length need about the logarithm of it in rounds. A node with
    very many neighbours is pre-aggregated before its rows meet, and the joins leave hot keys to
    be split at run time. Links to itself and repeated links do no harm.
    """
    both = written(
        links.select(F.col("a").alias("id"), F.col("b").alias("other"))
        .union(links.select("b", "a"))
        .distinct(),
        "links",
    )
    labels = written(
        both.groupBy("id").agg(F.least("id", F.min("other")).alias("label")), "labels"
    )
    while True:
        around = (
            both.join(labels.select(F.col("id").alias("other"), "label"), "other")
            .groupBy("id")
            .agg(F.min("label").alias("near"))
        )
        united = labels.join(around, "id").select(
            "id", F.col("label").alias("was"), F.least("label", "near").alias("label")
        )
        above = labels.select(F.col("id").alias("label"), F.col("label").alias("above"))
        found = written(
            united.join(above, "label", "left").select(
                "id", "was", F.least("label", F.coalesce("above", "label")).alias("label")
            ),
            "labels",
        )
        changed = not found.filter(F.col("was") != F.col("label")).isEmpty()
        labels = found.select("id", "label")
        if not changed:
            return labels
