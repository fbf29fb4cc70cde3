"""Chat formatting from an event log.

A log has one row per event of a message: ``open`` names its role, ``delta`` appends
streamed text, ``edit`` replaces the text, ``regenerate`` discards it. Events are
folded in order of their sequence numbers into final messages, which are rendered
with turn marks and a loss mask.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import let

#: One turn is BEGIN, role, ROLE_END, text, END. Fixed values of the format.
BEGIN, ROLE_END, END = "[INST]", "[/INST]", "</s>"
CONTROLS = (BEGIN, ROLE_END, END, "<s>")
TRAINED_ROLE = "assistant"
DELTA_CHARS = 48


def escaped(text: Column) -> Column:
    """The text without any control string; ``unescaped`` gives it back.

    A backslash is doubled and put behind the first character of control strings.
    """
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for control in CONTROLS:
        text = F.replace(text, F.lit(control), F.lit(f"{control[0]}\\{control[1:]}"))
    return text


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def fold_messages(events: DataFrame) -> DataFrame:
    """Final messages (conv_id, message, role, text) of a log.

    ``events`` has conv_id, message, seq, kind, role, text. Only one message's events
    meet in a task. An event delivered twice counts once. Among equal sequence
    numbers kinds run in the order open, regenerate, edit, delta, and then by text.
    Null text is empty; the last role named wins, and a message without one has the
    empty role; null conv_id or message are values like any other.
    """
    rank = F.when(F.col("kind") == "open", 0).when(F.col("kind") == "regenerate", 1)
    rank = rank.when(F.col("kind") == "edit", 2).otherwise(3)
    event = F.struct("seq", rank.alias("rank"), "text", "role")

    def final_text(e: Column) -> Column:
        resets = F.filter(e, lambda x: x["rank"].isin(1, 2))
        return let(
            F.element_at(F.concat(F.array(F.lit(None).cast(e_type)), resets), -1),
            lambda last: F.array_join(
                F.transform(
                    F.filter(
                        e,
                        lambda x: x["rank"].isin(2, 3) & F.coalesce(x >= last, F.lit(True)),
                    ),
                    lambda x: x["text"],
                ),
                "",
            ),
        )

    e_type = events.select(event.alias("e")).schema["e"].dataType
    folded = events.groupBy("conv_id", "message").agg(
        F.array_sort(F.collect_set(event)).alias("e")
    )
    named = F.filter("e", lambda x: x["role"].isNotNull())
    role = F.when(F.size(named) > 0, F.element_at(named, -1)["role"]).otherwise(F.lit(""))
    return folded.select(
        "conv_id", "message", role.alias("role"), let(F.col("e"), final_text).alias("text")
    )


def render(messages: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_spans (start and length).

    Spans count code points of ``formatted`` and cover the escaped text of every
    assistant message. A conversation is one output cell, so its messages meet in one
    task; its size is bounded by what a trainer can take as one sample.
    """
    turn = F.struct(
        "message",
        F.concat(F.lit(BEGIN), escaped(F.col("role")), F.lit(ROLE_END)).alias("head"),
        escaped(F.col("text")).alias("body"),
        (F.col("role") == TRAINED_ROLE).alias("loss"),
    )
    turns = messages.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    start = F.struct(
        F.lit(0).cast("long").alias("at"),
        F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans"),
    )

    def step(a: Column, t: Column) -> Column:
        begin = a["at"] + F.length(t["head"])
        size = F.length(t["body"]).cast("long")
        span = F.array(F.struct(begin.alias("start"), size.alias("length")))
        return F.struct(
            (begin + size + len(END)).alias("at"),
            F.when(t["loss"], F.concat(a["spans"], span)).otherwise(a["spans"]).alias("spans"),
        )

    pieces = F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(END)))
    return turns.select(
        "conv_id",
        F.array_join(pieces, "").alias("formatted"),
        F.aggregate("turns", start, step)["spans"].alias("loss_spans"),
    )


def parse(rendered: DataFrame) -> DataFrame:
    """Reads rendered rows back: turns (role, text) and ``loss_texts``, unescaped."""

    def turn(piece: Column) -> Column:
        halves = F.split(piece, r"\[/INST\]", 2)
        role = F.substring(F.get(halves, F.lit(0)), len(BEGIN) + 1, 2**31 - 1)
        return F.struct(
            unescaped(role).alias("role"),
            unescaped(F.get(halves, F.lit(1))).alias("text"),
        )

    pieces = F.split("formatted", END)
    pieces = F.slice(pieces, F.lit(1), F.size(pieces) - 1)
    loss = F.transform(
        "loss_spans",
        lambda s: unescaped(
            F.substring(F.col("formatted"), (s["start"] + 1).cast("int"), s["length"].cast("int"))
        ),
    )
    return rendered.withColumns(
        {"turns": F.transform(pieces, turn), "loss_texts": loss}
    )
