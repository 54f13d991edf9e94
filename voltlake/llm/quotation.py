"""Conversations in reply order, from what messages quote of each other.

Lines that begin with ``>`` are quoted, one level deeper for each. Quoted passages are normalised
and hashed, and joined to the messages of the same conversation that said them first: whole
bodies, paragraphs and lines. What a message quotes at its first level is what it answers.
Only messages with a quote are taken apart; everything is a join, a grouping or a window over the
lines of one message or over a stretch of a conversation's turns, never over a whole conversation.
A message goes by a digest of its four columns, so that no line carries the text it is from.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltlake.llm.common import written

QUOTE = r"^([ \t]*>)+"
HAS_QUOTE = r"(?m)^[ \t]*>"
# The line mail programs put above a quote.
ATTRIBUTION = r"(?i)^[ \t]*(on .{1,200} wrote|am .{1,200} schrieb .{0,100}|le .{1,200} a écrit|el .{1,200} escribió)\s*:[ \t]*$"
STRETCH = 1000  # turns that are put in order together
MESSAGE = ("conv_id", "turn", "message")


def normalised(text: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(text, r"\s+", " ")))


def _hashed(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def _message_id(*columns: str) -> Column:
    """A digest of all columns, with nulls told from texts."""
    return _hashed(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}))


def _units(text: Column) -> Column:
    """A text as a whole, its paragraphs and its lines."""
    return F.array_union(F.array(text), F.array_union(F.split(text, r"\n\s*\n"), F.split(text, "\n")))


def parsed_lines(quoting: DataFrame) -> DataFrame:
    """The lines of messages with quotes: line, level, content (without marks), attribution.

    An attribution stands above a deeper line, or has only blank lines between.
    """
    lines = quoting.select(*MESSAGE, F.posexplode(F.split("said", "\n")).alias("line", "raw"))
    marks = F.regexp_extract("raw", QUOTE, 0)
    # Backwards, as Spark reads a window up to the end anew for every row.
    upwards = Window.partitionBy("message").orderBy(F.desc("line"))
    filled = F.when(normalised(F.col("content")) != "", F.col("level"))
    below = F.last(filled, ignorenulls=True).over(upwards.rowsBetween(Window.unboundedPreceding, -1))
    following = F.greatest(F.lag("level", 1, 0).over(upwards), F.coalesce(below, F.lit(0)))
    return (
        lines.withColumn("level", F.length(F.regexp_replace(marks, "[^>]", "")))
        .withColumn("content", F.trim(F.regexp_replace("raw", QUOTE, "")))
        .withColumn("attribution", (F.col("level") < following) & F.col("content").rlike(ATTRIBUTION))
    )


def passages(lines: DataFrame) -> DataFrame:
    """Quoted passages: lines of one level that follow each other, and the paragraphs and lines of them."""
    order = Window.partitionBy("message").orderBy("line")
    begins = (F.col("level") != F.lag("level", 1, -1).over(order)).cast("int")
    quoted = (
        lines.filter("NOT attribution")
        .withColumn("passage", F.sum(begins).over(order))
        .filter("level > 0")
    )
    whole = (
        quoted.groupBy(*MESSAGE, "passage", "level")
        .agg(F.sort_array(F.collect_list(F.struct("line", "content"))).alias("parts"))
        .select(*MESSAGE, "level", F.array_join(F.col("parts.content"), "\n").alias("content"))
    )
    return (
        whole.select(*MESSAGE, "level", F.explode(_units(F.col("content"))).alias("content"))
        .withColumn("content", normalised(F.col("content")))
        .filter("content != ''")
        .select(*MESSAGE, "level", F.length("content").alias("size"), _hashed(F.col("content")).alias("hash"))
        .distinct()
    )


def originals(bodies: DataFrame) -> DataFrame:
    """What a message itself says: its body, its paragraphs and its lines, hashed."""
    return (
        bodies.select("conv_id", "turn", F.explode(_units(F.col("body"))).alias("content"))
        .withColumn("content", normalised(F.col("content")))
        .filter("content != ''")
        .select("conv_id", "turn", _hashed(F.col("content")).alias("hash"))
        .distinct()
    )


def _previous_turns(turns: DataFrame) -> DataFrame:
    """conv_id, turn, and the turn before it; stretches of a long conversation one by one."""
    turns = turns.withColumn("stretch", F.floor(F.col("turn") / STRETCH))
    within = Window.partitionBy("conv_id", "stretch").orderBy("turn")
    over = Window.partitionBy("conv_id").orderBy("stretch")
    last = (
        turns.groupBy("conv_id", "stretch")
        .agg(F.max("turn").alias("last"))
        .withColumn("before", F.lag("last").over(over))
        .select("conv_id", "stretch", "before")
    )
    return (
        turns.withColumn("near", F.lag("turn").over(within))
        .join(last, ["conv_id", "stretch"])
        .select("conv_id", "turn", F.coalesce("near", "before").alias("previous"))
    )


def latest_before(asked: DataFrame, said: DataFrame) -> DataFrame:
    """conv_id, hash, turn, source: the latest earlier turn that said what a turn asks for.

    Both sides hold distinct conv_id, hash, turn. A passage that a conversation says in all its turns is looked up
    stretch by stretch, with the last turn of earlier stretches handed on.
    """
    # At one turn, who asks comes before who says it, so that nobody quotes the own turn.
    both = (
        asked.withColumn("asking", F.lit(0))
        .unionByName(said.withColumn("asking", F.lit(1)))
        .withColumn("stretch", F.floor(F.col("turn") / STRETCH))
    )
    saying = F.max(F.when(F.col("asking") == 1, F.col("turn")))
    passed = Window.unboundedPreceding, -1
    within = Window.partitionBy("conv_id", "hash", "stretch").orderBy("turn", "asking").rowsBetween(*passed)
    over = Window.partitionBy("conv_id", "hash").orderBy("stretch").rowsBetween(*passed)
    earlier = (
        both.groupBy("conv_id", "hash", "stretch")
        .agg(saying.alias("last"))
        .select("conv_id", "hash", "stretch", F.max("last").over(over).alias("earlier"))
    )
    return (
        both.withColumn("near", saying.over(within))
        .filter("asking = 0")
        .join(earlier, ["conv_id", "hash", "stretch"])
        .select("conv_id", "hash", "turn", F.coalesce("near", "earlier").alias("source"))
        .filter("source IS NOT NULL")
    )


def reply_order(
    conversations: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """conv_id, turn, role, parent_turn, branch, quotes, linked, body, copies of every message.

    ``body`` is the text without quoted lines and the lines that announce them; a text without
    quotes is left as it is, null counts as empty. ``quotes`` counts distinct quoted passages, their
    paragraphs and lines, ``linked`` those found in an earlier message of the conversation. parent_turn is the
    earlier turn that the first quote level matches in most characters (of equal ones the latest),
    else the turn before; null for a first turn. ``branch`` is the turn at which a line of first
    replies begins: ordering a conversation by branch and turn gives every reply after what it
    answers, each line of replies together. Rows equal in all four columns are one message with
    ``copies``; different messages of one turn are answered together. Rows without conversation or
    turn have no parent and a null branch. An empty table gives no rows, other columns play no part.
    """
    messages = written(
        conversations.select(
            F.col(conv_col).alias("conv_id"),
            F.col(turn_col).alias("turn"),
            F.col(role_col).alias("role"),
            F.coalesce(F.col(text_col), F.lit("")).alias("said"),
        )
        .groupBy("conv_id", "turn", "role", "said")
        .agg(F.count(F.lit(1)).alias("copies"))
        .withColumn("quoting", F.col("said").rlike(HAS_QUOTE))
        .withColumn("message", _message_id("conv_id", "turn", "role", "said")),
        "messages",
    )
    lines = written(parsed_lines(messages.filter("quoting")), "quoted-lines")
    own = written(
        lines.filter("level = 0 AND NOT attribution")
        .groupBy("message")
        .agg(F.sort_array(F.collect_list(F.struct("line", "raw"))).alias("parts"))
        .select("message", F.regexp_replace(F.array_join(F.col("parts.raw"), "\n"), r"^\s+|\s+$", "").alias("own")),
        "own-lines",
    )

    # Each quoted passage and the latest message before that said it.
    quoted = written(passages(lines), "passages")
    asked = quoted.filter("conv_id IS NOT NULL AND turn IS NOT NULL")
    talked = asked.select("conv_id").distinct()
    # Only conversations in which something is quoted are looked through.
    answering = messages.join(talked, "conv_id", "left_semi").filter("turn IS NOT NULL")
    bodies = (
        answering.filter("NOT quoting").select("conv_id", "turn", F.col("said").alias("body"))
    ).unionByName(
        answering.filter("quoting").select(*MESSAGE).join(own, "message").select("conv_id", "turn", F.col("own").alias("body"))
    )
    said = originals(bodies).join(asked.select("conv_id", "hash").distinct(), ["conv_id", "hash"], "left_semi")
    found = latest_before(asked.select("conv_id", "hash", "turn").distinct(), said)
    links = written(asked.join(found, ["conv_id", "hash", "turn"]), "quote-links")
    votes = links.filter("level = 1").groupBy("message", "source").agg(F.sum("size").alias("size"))
    chosen = votes.groupBy("message").agg(F.max(F.struct("size", "source")).alias("best"))
    counted = quoted.groupBy("message").agg(F.count(F.lit(1)).alias("quotes"))
    matched = links.groupBy("message").agg(F.count(F.lit(1)).alias("linked"))
    told = counted.join(matched, "message", "left").join(chosen, "message", "left")

    # Who quotes nobody answers the turn before. Texts come to it last.
    ids = messages.select(*MESSAGE)
    turns = ids.filter("conv_id IS NOT NULL AND turn IS NOT NULL").select("conv_id", "turn").distinct()
    answered = written(
        ids.join(told, "message", "left")
        .join(_previous_turns(turns), ["conv_id", "turn"], "left")
        .select(*MESSAGE, "quotes", "linked", F.coalesce("best.source", "previous").alias("parent_turn")),
        "answered",
    )
    branches = _branches(answered, links.select("conv_id").distinct())
    first = ids.groupBy("conv_id").agg(F.min("turn").alias("first"))
    placed = (
        answered.join(first, "conv_id", "left")
        .join(branches, ["conv_id", "turn"], "left")
        .select("message", "parent_turn", "quotes", "linked", F.coalesce("branch", "first").alias("branch"))
    )
    body = F.when(F.col("quoting"), F.coalesce("own", F.lit(""))).otherwise(F.col("said"))
    return (
        messages.join(placed, "message")
        .join(own, "message", "left")
        .select(
            "conv_id",
            "turn",
            "role",
            "parent_turn",
            F.when(F.col("turn").isNotNull(), F.col("branch")).alias("branch"),
            F.coalesce("quotes", F.lit(0)).cast("long").alias("quotes"),
            F.coalesce("linked", F.lit(0)).cast("long").alias("linked"),
            body.alias("body"),
            "copies",
        )
    )


def _branches(answered: DataFrame, linked: DataFrame) -> DataFrame:
    """conv_id, turn, branch for conversations with links; all others are one line of replies.

    A turn goes on with its parent's branch if it is the parent's first reply. Each round doubles
    the way looked up the line, so a line of any length takes its logarithm in rounds.
    """
    turns = (
        answered.filter("turn IS NOT NULL")
        .join(linked, "conv_id", "left_semi")
        .groupBy("conv_id", "turn")
        .agg(F.max("parent_turn").alias("parent"))
    )
    replies = turns.filter("parent IS NOT NULL").groupBy("conv_id", "parent").agg(F.min("turn").alias("reply"))
    step = written(
        turns.join(replies, ["conv_id", "parent"], "left").select(
            "conv_id", "turn", F.when(F.col("turn") == F.col("reply"), F.col("parent")).otherwise(F.col("turn")).alias("up")
        ),
        "branches",
    )
    while True:
        above = step.select("conv_id", F.col("turn").alias("up"), F.col("up").alias("higher"))
        higher = written(step.join(above, ["conv_id", "up"]).select("conv_id", "turn", "up", "higher"), "branches")
        done = higher.filter("up != higher").isEmpty()
        step = higher.select("conv_id", "turn", F.col("higher").alias("up"))
        if done:
            return step.withColumnRenamed("up", "branch")
