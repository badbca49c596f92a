"""Chat formatting by quotation linking.

Messages may quote earlier ones in lines that begin with ``>``, one per level.  Passages are single
lines, paragraphs (lines of one level that follow one another without an empty one between), and
blocks: all that stands at one quote level in a row, and all that a message writes itself.  Lines of
a passage are joined, so it does not matter where they are wrapped.  Every quoted passage is
normalised and hashed, and joined with the message of the same conversation that first wrote that
passage itself.  A line counts as quoted if it, its paragraph or its block is found.  A message
answers the message that its lowest matched level quotes, the one with the most quoted letters if
there are several, the latest of those.  Answers follow their thread: a conversation is ordered by
the first message of each thread, then by turn, and the quoted lines are taken out.

Only one original stands for each passage of a conversation, so one that is repeated or quoted
any number of times gives one link per quoting message.  Threads are found by doubling steps
along the links.  The order comes from Spark's range partitioning, so a conversation that holds a
large share of all rows is spread over many tasks.

Defined results: a NULL text is empty; a line without letters or digits links nothing; a message
that quotes no earlier message starts a thread; a NULL conversation or turn has no links, and
messages of the NULL conversation are ordered like one; repeated rows stand one after the other;
an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.text import ascii_lower, whole
from tidemark.session import materialize

MARKS = r"^(?:[ \t]*>)+"


def quote_level(line: Column) -> Column:
    """Number of ``>`` at the start of a line."""
    return F.length(F.regexp_replace(F.regexp_extract(line, MARKS, 0), r"[^>]", ""))


def passage(line: Column) -> Column:
    """A line without marks, case, punctuation and repeated space."""
    words = F.regexp_replace(F.regexp_replace(line, MARKS, ""), r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", " ")
    return ascii_lower(F.trim(words))


def without_quotes(text: Column) -> Column:
    """The lines of a text that are not quoted."""
    own = F.filter(F.split(text, "\n"), lambda line: ~line.rlike(MARKS))
    return F.trim(F.array_join(own, "\n"))


def escaped(text: Column) -> Column:
    """The text with one more bar in every ``<|``, so that it cannot pass for a role marker."""
    return F.regexp_replace(text, r"<(\|+)", r"<$1|")


_ROW = ["conv", "turn", "row"]


def _lines(messages: DataFrame) -> DataFrame:
    """Every line that is not empty: conv, turn, row (its text), at, level, block, paragraph, passage."""
    split = (
        messages.where("conv IS NOT NULL AND turn IS NOT NULL")
        .select("conv", "turn", "text")
        .distinct()
        .select("conv", "turn", F.md5("text").alias("row"), F.posexplode(F.split("text", "\n")).alias("at", "line"))
        .select(*_ROW, "at", quote_level(F.col("line")).alias("level"), passage(F.col("line")).alias("passage"))
    )
    order = Window.partitionBy(*_ROW).orderBy("at")
    turned = F.coalesce(F.lag("level").over(order) != F.col("level"), F.lit(True))
    rested = F.coalesce(F.lag("passage").over(order) == "", F.lit(True))
    marked = split.select("*", turned.cast("int").alias("turned"), (turned | rested).cast("int").alias("fresh"))
    # What a message writes itself is one block, wherever quotes stand between.
    block = F.when(F.col("level") == 0, 0).otherwise(F.sum("turned").over(order))
    numbered = marked.select(*_ROW, "at", "level", "passage", block.alias("block"), F.sum("fresh").over(order).alias("paragraph"))
    return numbered.where("passage != ''")


def _joined(parts: DataFrame, by: list[str], place: str) -> DataFrame:
    """The passages of each group, in order, as one."""
    listed = F.array_sort(F.collect_list(F.struct(place, "passage")))
    texts = F.array_join(F.transform(listed, lambda p: p["passage"]), " ")
    return parts.groupBy(*by).agg(texts.alias("passage"))


def reply_links(messages: DataFrame) -> DataFrame:
    """The message each message answers, for (conv, turn, text): conv, turn, reply_to, quoted (number of lines)."""
    lines = materialize(_lines(messages))
    paragraphs = _joined(lines, [*_ROW, "level", "block", "paragraph"], "at")
    blocks = _joined(paragraphs, [*_ROW, "level", "block"], "paragraph")
    units = {"at": lines, "paragraph": paragraphs, "block": blocks}
    hashed = {k: u.withColumn("hash", F.md5("passage")) for k, u in units.items()}
    own = [u.where("level = 0").select("conv", "turn", "hash") for u in hashed.values()]
    written = own[0].unionByName(own[1]).unionByName(own[2]).groupBy("conv", "hash").agg(F.min("turn").alias("reply_to"))
    written = materialize(written)
    quoted = lines.where("level > 0")
    found = None
    for place, unit in hashed.items():
        hits = unit.where("level > 0").join(written, ["conv", "hash"]).where("reply_to < turn")
        hits = hits.select(*_ROW, place, "reply_to")
        part = quoted.join(hits, [*_ROW, place]).select(
            "conv", "turn", "at", "level", F.length("passage").alias("n"), F.md5("passage").alias("hash"), "reply_to"
        )
        found = part if found is None else found.unionByName(part)
    votes = (
        found.distinct()
        .groupBy("conv", "turn", "level", "reply_to")
        .agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("quoted"))
    )
    best = F.max(F.struct(-F.col("level"), "n", "reply_to", "quoted")).alias("best")
    return votes.groupBy("conv", "turn").agg(best).select("conv", "turn", "best.reply_to", "best.quoted")


def threads(links: DataFrame) -> DataFrame:
    """First message of the thread of each linked message, and the number of answers down to it."""
    at = materialize(links.select("conv", "turn", F.col("reply_to").alias("root"), F.lit(1).cast("long").alias("depth")))
    while True:
        up = at.select("conv", F.col("turn").alias("root"), F.col("root").alias("above"), F.col("depth").alias("more"))
        # The steps double, so the rounds are the logarithm of the longest chain.
        further = materialize(
            at.join(up, ["conv", "root"], "left").select(
                "conv",
                "turn",
                F.coalesce("above", "root").alias("root"),
                (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
                F.col("above").isNotNull().alias("moved"),
            )
        )
        at = further.drop("moved")
        if further.where("moved").isEmpty():
            return at


def chat_messages(
    messages: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row per message: conv, turn, role, position in its conversation (from 0), reply_to, root
    (turn of its thread's first message), depth, quoted_lines, content without quotes, formatted (role
    marker and content, in which every ``<|`` has one more bar)."""
    rows = messages.select(
        F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.col(role).alias("role"), whole(F.col(text)).alias("text")
    )
    links = materialize(reply_links(rows))
    placed = links.join(threads(links), ["conv", "turn"])
    content = without_quotes(F.col("text"))
    threaded = rows.join(placed, ["conv", "turn"], "left").select(
        "conv",
        "turn",
        "role",
        "reply_to",
        F.coalesce("root", "turn").alias("root"),
        F.coalesce("depth", F.lit(0)).cast("long").alias("depth"),
        F.coalesce("quoted", F.lit(0)).cast("long").alias("quoted_lines"),
        content.alias("content"),
    )
    order = ["root", "turn", "role", "content"]
    lanes = materialize(threaded.repartitionByRange("conv", *order).withColumn("lane", F.spark_partition_id()))
    earlier = Window.partitionBy("conv").orderBy("lane").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        lanes.groupBy("conv", "lane")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("conv").alias("_conv"), F.col("lane").alias("_lane"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    )
    rank = F.row_number().over(Window.partitionBy("lane", "conv").orderBy(*order)) - 1
    same = F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("lane") == F.col("_lane"))
    return (
        lanes.withColumn("rank", rank)
        .join(before, same)
        .select(
            F.col("conv").alias(conv),
            F.col("turn").alias(turn),
            F.col("role").alias(role),
            (F.col("before") + F.col("rank")).cast("long").alias("position"),
            "reply_to",
            "root",
            "depth",
            "quoted_lines",
            "content",
            F.concat(
                F.lit("<|"), escaped(F.coalesce("role", F.lit(""))), F.lit("|>\n"), escaped(F.col("content")), F.lit("\n")
            ).alias("formatted"),
        )
    )
