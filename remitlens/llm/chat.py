"""Conversations as training examples, one for each reply.

A conversation with k assistant turns becomes k examples: all turns up to the reply as context, and the reply alone as
target. If turns follow the last reply, one example more without a target holds them, so that nothing is lost.

A turn is written ``<|im_start|>role``, a line break, the text and ``<|im_end|>`` with a line break. Control strings of
common templates inside a role or text lose their first character to a percent code, as do percent signs that would
read as such a code; line breaks in roles too. That can be undone exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>\n"
ASSISTANT = "assistant"

# Control strings of chat templates, by their first character.
_ANGLE = r"<(?=\|im_start\|>|\|im_end\|>|s>|/s>|<SYS>>|</SYS>>)"
_SQUARE = r"\[(?=/?INST\])"


def escaped(text: Column) -> Column:
    text = F.regexp_replace(text, "%(?=25|3C|5B|0A)", "%25")
    return F.regexp_replace(F.regexp_replace(text, _ANGLE, "%3C"), _SQUARE, "%5B")


def unescaped(text: Column) -> Column:
    for code, plain in (("%3C", "<"), ("%5B", "["), ("%0A", "\n"), ("%25", "%")):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def _role(role: Column) -> Column:
    return F.replace(escaped(role), F.lit("\n"), F.lit("%0A"))


def examples(turns: DataFrame) -> DataFrame:
    """Examples of conversations, from rows of ``conv_id``, ``turn``, ``role`` and ``text``.

    Returns ``conv_id``, ``example`` (from 0), ``formatted``, ``loss_start`` and ``loss_length`` (code points of the
    target in ``formatted``; null in the example without a target). A null role or text counts as empty. Turns come in
    the order of ``turn``, nulls first, then of role and text; repeated rows stay. Rows without a conv_id are one
    conversation. A conversation is one row here, as its examples repeat their context.
    """
    empty = lambda c: F.coalesce(F.col(c), F.lit(""))
    row = F.struct("turn", empty("role").alias("role"), empty("text").alias("text"))
    whole = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(row)).alias("turns"))
    written = F.transform(
        "turns",
        lambda t: F.struct(
            (t["role"] == ASSISTANT).alias("reply"),
            F.concat(F.lit(START), _role(t["role"]), F.lit("\n")).alias("head"),
            escaped(t["text"]).alias("body"),
        ),
    )
    whole = whole.select("conv_id", written.alias("turns"))
    last = F.size("turns") - 1
    ends = F.filter(
        F.transform("turns", lambda t, i: F.when(t["reply"] | (i == last), i)), lambda i: i.isNotNull()
    )
    each = whole.select("conv_id", "turns", F.posexplode(ends).alias("example", "at"))
    join = lambda part: F.array_join(F.transform(part, lambda t: F.concat(t["head"], t["body"], F.lit(END))), "")
    each = each.select(
        "conv_id", "example", join(F.slice("turns", 1, F.col("at"))).alias("context"), F.get("turns", F.col("at")).alias("t")
    )
    reply = F.col("t.reply")
    return each.select(
        "conv_id",
        "example",
        F.concat("context", "t.head", "t.body", F.lit(END)).alias("formatted"),
        F.when(reply, F.length("context") + F.length("t.head")).alias("loss_start"),
        F.when(reply, F.length("t.body")).alias("loss_length"),
    )


def target(formatted: Column, start: Column, length: Column) -> Column:
    """The unescaped text under the loss mask; null without a target."""
    return unescaped(F.substring(formatted, start + 1, length))


def read_turns(formatted: Column) -> Column:
    """The turns of an example as an array of ``role`` and ``text``."""
    parts = F.split(formatted, r"<\|im_end\|>\n", -1)
    turns = F.slice(parts, 1, F.size(parts) - 1)

    def read(part: Column) -> Column:
        head = F.substring_index(part, "\n", 1)
        body = F.substring(part, F.length(head) + 2, F.length(part))
        return F.struct(
            unescaped(F.substring(head, len(START) + 1, F.length(head))).alias("role"), unescaped(body).alias("text")
        )

    return F.transform(turns, read)
