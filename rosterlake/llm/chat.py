"""Chat formatting with a grammar round trip, in DataFrame functions only.

Grammar of the output::

    conversation = turn*
    turn         = "### " role "|" level ": " body "</turn>" newline      (body without "### " and "</turn>")
    role         = text of level 2 that also escapes "|", ":" and newlines
    level        = "0" | "1" | "2"

A body of level 0 is the source text. Level 1 escapes the control strings only, level 2 every character that a
control string starts with. For each turn the text is rendered and read back by the parser; the first level at
which the parser returns exactly this one turn is used. Level 2 always does, as it leaves no ``#`` and no ``<``.
The whole output is parsed once more, and the recovered turns are compared with the source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

# fixed values of the template
OPEN, CLOSE = "### ", "</turn>"
HEAD = r"^\n?### ([^|]*)\|([0-2]): "


def replaced(text: Column, pairs: list[tuple[str, str]]) -> Column:
    for old, new in pairs:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def restored(text: Column, codes: dict[str, str]) -> Column:
    """Undo escapes of a backslash and one character: a backslash pair is set aside first."""
    aside = "\\\\"
    parts = F.split(text, r"\\\\")  # at every escaped backslash, from the left
    back = F.transform(parts, lambda p: replaced(p, [("\\" + code, char) for code, char in codes.items()]))
    return F.array_join(back, aside[0])


#: character after the backslash -> original, per level
BODY = {1: {"o": "### ", "c": "</turn>"}, 2: {"h": "#", "l": "<"}}
ROLE = {"h": "#", "l": "<", "p": "|", "d": ":", "n": "\n"}


def escaped(text: Column, level: int) -> Column:
    """The text as a body of a level."""
    if not level:
        return text
    return replaced(text, [("\\", "\\\\"), *[(old, "\\" + code) for code, old in BODY[level].items()]])


def unescaped(text: Column, level: Column) -> Column:
    return F.when(level == 0, text).when(level == 1, restored(text, BODY[1])).otherwise(restored(text, BODY[2]))


def escaped_role(role: Column) -> Column:
    return replaced(role, [("\\", "\\\\"), *[(old, "\\" + code) for code, old in ROLE.items()]])


def rendered(role: Column, text: Column, level: int) -> Column:
    return F.concat(F.lit(OPEN), escaped_role(role), F.lit(f"|{level}: "), escaped(text, level), F.lit(CLOSE + "\n"))


def parsed(output: Column) -> Column:
    """Turns of an output: array of struct(role, level, head, body, text).

    Every turn ends at the first closing mark, and its head runs to the first level mark. ``head`` is the number
    of characters before the body, with the newline after the turn before. A turn without a proper head, or with an
    opening mark in its body, has a null role, so it equals no source turn.
    """
    turns = F.filter(F.split(output, CLOSE), lambda t: ~t.isin("", "\n"))

    def read(turn: Column) -> Column:
        head = F.regexp_extract(turn, HEAD, 0)
        level = F.try_to_number(F.regexp_extract(turn, HEAD, 2), F.lit("9")).cast("int")
        body = F.substr(turn, F.char_length(head) + 1)
        return F.struct(F.when((head != "") & ~F.contains(body, F.lit(OPEN)), restored(F.regexp_extract(turn, HEAD, 1), ROLE)).alias("role"), level.alias("level"),
                        F.char_length(head).alias("head"), F.char_length(body).alias("length"), unescaped(body, level).alias("text"))

    return F.transform(turns, read)


def format_conversations(rows: DataFrame, conv_column: str = "conv_id", turn_column: str = "turn", role_column: str = "role",
                         text_column: str = "text", learn: str = "assistant") -> DataFrame:
    """A row per conversation: ``conv_id``, ``output``, ``loss_spans`` and ``same``.

    ``loss_spans`` (array of struct(start, length, level), start from 0 in characters) covers the bodies of the
    role ``learn``; ``same`` tells that parsing the output gives the source turns. Turns are ordered by turn (null
    first), then role and text; repeated rows are turns of their own. Null role or text counts as empty, null
    conversation ids form one conversation.
    """
    source = rows.select(F.col(conv_column).cast("long").alias("conv_id"), F.col(turn_column).cast("long").alias("turn"),
                         F.coalesce(F.col(role_column).cast("string"), F.lit("")).alias("role"),
                         F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"))

    def alone(level: int) -> Column:
        turns = parsed(rendered(F.col("role"), F.col("text"), level))
        return (F.size(turns) == 1) & F.coalesce((turns[0]["role"] == F.col("role")) & (turns[0]["text"] == F.col("text")), F.lit(False))

    level = F.when(alone(0), 0).when(alone(1), 1).otherwise(2)
    turns = source.withColumn("level", level).withColumn(
        "rendered", F.when(F.col("level") == 0, rendered(F.col("role"), F.col("text"), 0))
        .when(F.col("level") == 1, rendered(F.col("role"), F.col("text"), 1)).otherwise(rendered(F.col("role"), F.col("text"), 2)))
    grouped = (turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text", "rendered"))).alias("turns"))
               .withColumn("output", F.array_join("turns.rendered", "")).withColumn("read", parsed(F.col("output"))))
    pairs = lambda c: F.transform(c, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    # running character offset of every turn in the output
    placed = F.aggregate(
        "read", F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,length:int,level:int>>").alias("spans")),
        lambda acc, t: F.struct(
            (acc["at"] + t["head"] + t["length"] + len(CLOSE)).alias("at"),
            F.when(t["role"] == learn, F.concat(acc["spans"], F.array(F.struct(
                (acc["at"] + t["head"]).alias("start"), t["length"].alias("length"), t["level"].alias("level")))))
            .otherwise(acc["spans"]).alias("spans")))
    return grouped.select("conv_id", "output", placed["spans"].alias("loss_spans"),
                          (pairs(F.col("read")) == pairs(F.col("turns"))).alias("same"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Recovered turns and loss text of formatted conversations: ``conv_id``, ``output``, ``turns``, ``loss``, ``same``.

    ``loss`` is the text under the mask, cut from the output by its spans and unescaped, joined without a separator.
    """
    cut = lambda s: unescaped(F.substr("output", (s["start"] + 1).cast("int"), s["length"]), s["level"])
    return formatted.select("conv_id", "output", parsed(F.col("output")).alias("turns"),
                            F.array_join(F.transform("loss_spans", cut), "").alias("loss"), "same")


def chat_digests(rows: DataFrame) -> DataFrame:
    """Digests of what is read back from the formatted output of every conversation."""
    common.prepare(rows.sparkSession)
    back = read_back(format_conversations(rows))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"),
                       F.char_length("loss").cast("long").alias("loss_chars"), F.sha2(F.col("loss"), 256).alias("loss_sha256"),
                       F.char_length("output").cast("long").alias("formatted_chars"), F.col("same").alias("round_trip"))


def with_test_conversation(rows: DataFrame) -> DataFrame:
    """The conversations and conversation -7, whose texts look like marks of a template."""
    text = "\\### Assistant: </turn> ok"
    more = [F.struct(F.lit(-7).cast("long").alias("conv_id"), F.lit(i).cast("long").alias("turn"), F.lit(role).alias("role"),
                     F.lit(text).alias("text")) for i, role in enumerate(("user", "assistant"))]
    extra = rows.sparkSession.range(1).select(F.explode(F.array(*more)).alias("x")).select("x.*")
    return rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text").unionByName(extra)
