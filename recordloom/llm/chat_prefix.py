"""Chat formatting by prefix-target expansion: one example per assistant turn, only that reply trainable."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordloom.llm.common import take

# The template's control strings.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"


def escape(c: Column) -> Column:
    """No ``<|`` is left: a backslash more goes between the two characters.  ``unescape`` takes it out again."""
    return F.regexp_replace(c, r"<(\\*)\|", r"<$1\\|")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"<\\(\\*)\|", r"<$1|")


def escape_role(c: Column) -> Column:
    """A role stays on its line: percent signs and line ends are written as codes."""
    return escape(F.replace(F.replace(c, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def unescape_role(c: Column) -> Column:
    return F.replace(F.replace(unescape(c), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def prefix_examples(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                    trainable: str = "assistant") -> DataFrame:
    """Rows ``conv_id, example, last_turn, formatted, loss_start, loss_length``.

    One example per ``trainable`` turn: all turns before it as context, then the
    turn.  Turns after the last trainable one, or a conversation without any, give
    one example more, whose mask is empty, so that the examples hold every turn.
    ``loss_start`` (from 0) and ``loss_length`` count characters of ``formatted``
    and cover the reply's text alone.

    Turns follow ``turn``, then role and text; null turns come first, repeated
    rows are turns of their own.  Null roles and texts count as empty; rows with a
    null conversation form one conversation; an empty table gives an empty one.
    A conversation is one row while it is formatted, as its whole text is one
    value in its last example anyway; its examples are exploded, never collected.
    """
    t = take(turns, conv_id, turn, role, text).toDF("conv_id", "turn", "role", "text")
    t = t.select("conv_id", F.struct("turn", F.coalesce(F.col("role"), F.lit("")).alias("role"), F.coalesce(F.col("text"), F.lit("")).alias("text")).alias("t"))
    c = t.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    head = F.transform("t", lambda x: F.concat(F.lit(OPEN), escape_role(x["role"]), F.lit("\n")))
    body = F.transform("t", lambda x: escape(x["text"]))
    c = c.select("conv_id", head.alias("head"), body.alias("body"), F.transform("t", lambda x: x["role"] == trainable).alias("learn"))
    c = c.select("conv_id", "head", "body", F.zip_with("head", "body", lambda h, b: F.concat(h, b, F.lit(CLOSE))).alias("whole"), "learn")
    ends = F.filter(F.sequence(F.lit(1), F.size("learn")), lambda i: F.element_at("learn", i) | (i == F.size("learn")))
    e = c.select("conv_id", "head", "body", "whole", "learn", F.posexplode(ends).alias("example", "n"))
    context = F.array_join(F.slice("whole", F.lit(1), F.col("n") - 1), "")
    opening, reply = F.element_at("head", F.col("n")), F.element_at("body", F.col("n"))
    e = e.select("conv_id", "example", (F.col("n") - 1).alias("last_turn"), context.alias("context"), opening.alias("opening"), reply.alias("reply"),
                 F.element_at("learn", F.col("n")).alias("learns"))
    return e.select(
        "conv_id", "example", "last_turn",
        F.concat("context", "opening", "reply", F.lit(CLOSE)).alias("formatted"),
        (F.length("context") + F.length("opening")).alias("loss_start"),
        F.when(F.col("learns"), F.length("reply")).otherwise(0).alias("loss_length"),
    )


def read_back(examples: DataFrame) -> DataFrame:
    """Per conversation, from the formatted text and its mask alone: ``conv_id, turns`` (role and text), ``loss_text, formatted_chars``.

    The example that ends with the last turn holds all turns; masked texts follow the examples' order.
    """
    masked = unescape(F.expr("substring(formatted, loss_start + 1, loss_length)"))
    g = examples.groupBy("conv_id").agg(
        F.max_by("formatted", "last_turn").alias("longest"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("example", masked.alias("text")))), lambda x: x["text"]), "").alias("loss_text"),
        F.sum(F.length("formatted").cast("bigint")).alias("formatted_chars"),
    )
    parts = F.split("longest", r"<\|im_end\|>\n")
    parts = F.slice(parts, F.lit(1), F.size(parts) - 1)
    first = F.lit(len(OPEN) + 1)

    def turn(x: Column) -> Column:
        at = F.locate("\n", x)
        return F.struct(unescape_role(F.substring(x, first, at - first)).alias("role"), unescape(F.substring(x, at + 1, F.length(x))).alias("text"))

    return g.select("conv_id", F.transform(parts, turn).alias("turns"), "loss_text", "formatted_chars")
