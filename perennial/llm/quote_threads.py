"""Conversations in reply order, without quotations, DataFrame functions only.

A line that begins with one or more ``>`` is quoted; their number is its level. Lines of one
level in a row are a passage, whatever way they are wrapped. Lines, and the sentences and
runs of five words of passages, are normalised (lower case, single blanks, no marks at either
end), hashed and joined within the conversation to the latest earlier message that says the
same unquoted. A message answers the one that most votes of the lowest matched level are for:
a line has eight, a sentence four, a run of words one, and what several earlier messages say
counts less. A message that quotes nothing known answers the one before it. Messages are ordered depth first: a message, then what follows it in its own
branch, then the answers that branch off, each with all that hangs on it.

The join is a window that carries the latest earlier message along each (conversation, line),
so a line that many messages repeat is not paired with itself. Only messages that branch off
need paths, found by doubling.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from perennial.llm.shared import drop_settled, settle

_MARKS = r"^((?:[ \t]*>)+)[ \t]?"
_QUOTED_LINES = r"(?m)^[ \t]*>[^\n]*(?:\n|\z)"
# Fixed value: an introduction of a quotation that mail programs write.
_SAYS = r"(?m)^[^\n>]{0,200}\b(?:wrote|writes|schrieb|écrit|escribió) ?:[ \t]*\n(?=[ \t]*>)"

# Lines of equal marks in a row; possessive, so that Java's matcher does not recurse.
_PASSAGES = r"(?dm)^(>*+)[^\n]*+(?:\n\1(?!>)[^\n]*+)*+"
_SENTENCE_ENDS = r"(?<=[.!?…])\s+|(?<=[。！？])|\n[ \t]*\n"
_WORD_RUNS = r"(?:^| )(?=(\S++ \S++ \S++ \S++ \S++))"
_VOTES = {"line": 8, "sentence": 4, "run": 1}

TEMPLATE = "<|{role}|>\n{body}\n"


def unquoted(text: Column) -> Column:
    """The text without quoted lines, the lines that introduce them and outer white space."""
    said = F.regexp_replace(F.coalesce(text, F.lit("")), _SAYS, "")
    own = F.regexp_replace(said, _QUOTED_LINES, "")
    return F.regexp_replace(F.regexp_replace(own, r"^\s+|\s+\z", ""), r"\n{3,}", "\n\n")


def normalised(line: Column) -> Column:
    words = F.regexp_replace(F.lower(F.regexp_replace(line, _MARKS, "")), r"[\s\p{P}]+", " ")
    return F.trim(words)


def _quoting(messages: DataFrame) -> DataFrame:
    """The linkable messages of conversations that hold a quoted line."""
    linkable = messages.where("conv_id is not null and turn is not null and text is not null")
    quoting = settle(linkable.where(F.col("text").rlike(r"(?m)^[ \t]*>")).select("conv_id").distinct(), "quoting")
    return linkable.join(quoting, "conv_id", "left_semi")


def _said(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, level, vote, said): different lines, sentences and runs of words."""

    def voted(kind: str, texts: Column) -> Column:
        return F.transform(texts, lambda x: F.struct(F.lit(_VOTES[kind]).alias("vote"), x.alias("said")))

    # Marks without blanks between them.
    compact = F.regexp_replace(F.regexp_replace("text", "\r\n?", "\n"), r"(?dm)(?:^|\G)[ \t]*>", ">")
    passage = F.explode(F.regexp_extract_all(compact, F.lit(_PASSAGES), F.lit(0)))
    passages = messages.select("conv_id", "turn", passage.alias("passage"))
    body = F.regexp_replace("passage", r"(?dm)^>+[ \t]?", "")
    level = F.length(F.regexp_extract("passage", r"^>*", 0))
    items = F.concat(
        voted("line", F.transform(F.split(body, "\n"), normalised)),
        voted("sentence", F.transform(F.split(body, _SENTENCE_ENDS), normalised)),
        voted("run", F.regexp_extract_all(normalised(body), F.lit(_WORD_RUNS), F.lit(1))),
    )
    said = passages.select("conv_id", "turn", level.alias("level"), F.explode(items).alias("item"))
    said = said.where("item.said <> ''").select("conv_id", "turn", "level", "item.*")
    return said.withColumn("said", F.xxhash64("vote", "said")).distinct()


def parents(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, parent_turn, level) of messages whose quotations are known."""
    lines = _said(_quoting(messages))
    quoting = lines.where("level > 0").select("conv_id", "said").distinct()
    # What is said unquoted matters only where some message quotes it.
    told = lines.join(quoting, ["conv_id", "said"], "left_semi")
    # At one turn quotations come first, so a message never answers itself.
    order = W.partitionBy("conv_id", "said").orderBy("turn", F.col("level").desc())
    earlier = order.rowsBetween(W.unboundedPreceding, -1)
    unquoted_at = F.when(F.col("level") == 0, F.col("turn"))
    found = (
        told.withColumn("source", F.last(unquoted_at, ignorenulls=True).over(earlier))
        .withColumn("sources", F.count(unquoted_at).over(earlier))
        .where("level > 0 and source is not null")
    )
    votes = found.groupBy("conv_id", "turn", "level", "source").agg(
        F.sum(F.col("vote") / F.col("sources")).alias("weight")
    )
    best = F.max_by(F.struct("source", "level"), F.struct(-F.col("level"), F.round("weight", 9), F.col("source")))
    return (
        votes.groupBy("conv_id", "turn").agg(best.alias("best"))
        .select("conv_id", "turn", F.col("best.source").alias("parent_turn"), F.col("best.level").alias("level"))
    )


def _paths(branches: DataFrame) -> DataFrame:
    """(conv_id, branch, path) from (conv_id, branch, up, path): the steps from the trunk.

    Every round puts the path of the branch above in front and moves on to the one above
    that, so the distance doubles. The trunk is ``up`` NULL.
    """
    now = settle(branches, "branches")
    while not now.where("up is not null").isEmpty():
        above = now.select(
            F.col("conv_id").alias("c"), F.col("branch").alias("b"), F.col("up").alias("further"), F.col("path").alias("before")
        )
        after = settle(
            now.join(above, (F.col("conv_id") == F.col("c")) & (F.col("up") == F.col("b")), "left").select(
                "conv_id",
                "branch",
                F.col("further").alias("up"),
                F.concat(F.coalesce("before", F.slice("path", 1, 0)), "path").alias("path"),
            ),
            "branches",
        )
        drop_settled(now)
        now = after
    return now.select("conv_id", "branch", "path")


def _step(kind: int, first: Column, second: Column) -> Column:
    return F.struct(
        F.lit(kind).alias("kind"), first.cast("long").alias("first"), second.cast("long").alias("second")
    )


def reply_order(turns: DataFrame, answers: DataFrame) -> DataFrame:
    """(conv_id, turn, parent_turn, reply_order) of the different turns of conversations.

    ``answers`` (conv_id, turn, parent_turn) are the turns that answer an earlier one.
    """
    turns = turns.where("conv_id is not null and turn is not null").select("conv_id", "turn").distinct()
    by_turn = W.partitionBy("conv_id").orderBy("turn")
    linked = turns.join(answers, ["conv_id", "turn"], "left").withColumn("previous", F.lag("turn").over(by_turn))
    # A branch begins where a message answers another one than the message before it.
    begins = F.when(F.col("parent_turn") != F.col("previous"), F.col("turn"))
    linked = settle(
        linked.withColumn("branch", F.last(begins, ignorenulls=True).over(by_turn)).withColumn(
            "parent_turn", F.coalesce("parent_turn", "previous")
        ),
        "turns",
    )
    forks = linked.where("branch = turn").select("conv_id", "branch", "parent_turn")
    home = linked.select(F.col("conv_id").alias("c"), F.col("turn").alias("t"), F.col("branch").alias("up"))
    placed = forks.join(home, (F.col("conv_id") == F.col("c")) & (F.col("parent_turn") == F.col("t"))).select(
        "conv_id", "branch", "up", F.array(_step(1, -F.col("parent_turn"), F.col("branch"))).alias("path")
    )
    paths = _paths(placed)
    own = F.array(_step(0, F.col("turn"), F.lit(0)))
    keyed = linked.join(paths, ["conv_id", "branch"], "left").withColumn(
        "key", F.when(F.col("path").isNull(), own).otherwise(F.concat("path", own))
    )
    in_order = W.partitionBy("conv_id").orderBy("key")
    return keyed.select("conv_id", "turn", "parent_turn", F.row_number().over(in_order).alias("reply_order"))


def chat_messages(conversations: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """(conv_id, turn, role, reply_order, parent_turn, quote_level, body, chat), one row per
    row of ``conversations``: the body without quotations, and the message in the chat
    template. In the order of (conv_id, reply_order) the chats make up the conversations.

    Needs conv_id, turn (long), role and text; further columns are not read. Rows without
    conv_id or turn cannot be placed: they answer nothing and have no order. A NULL text is
    empty, a NULL role is ``unknown``. Rows of one turn share its place and, if they quote,
    its answer. quote_level is the deepest level of quotation in the text, 0 for none. An
    empty table gives an empty table.
    """
    rows = conversations.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("unknown")).alias("role"),
        F.col("text").cast("string").alias("text"),
    )
    answers = settle(parents(rows).select("conv_id", "turn", "parent_turn"), "answers")
    order = reply_order(rows, answers)
    marks = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"(?m)^((?:[ \t]*>)+)"), F.lit(1))
    level = F.coalesce(F.array_max(F.transform(marks, lambda m: F.regexp_count(m, F.lit(">")))), F.lit(0))
    body = unquoted(F.regexp_replace("text", "\r\n?", "\n"))
    before, rest = template.split("{role}")
    middle, after = rest.split("{body}")
    return (
        rows.join(order, ["conv_id", "turn"], "left")
        .withColumn("body", body)
        .select(
            "conv_id", "turn", "role", "reply_order", "parent_turn", level.alias("quote_level"), "body",
            F.concat(F.lit(before), "role", F.lit(middle), "body", F.lit(after)).alias("chat"),
        )
    )
