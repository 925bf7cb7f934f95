"""Chat formatting with Spark expressions only.

A conversation's turns are collected as structs and sorted; adjacent turns of
one role become one message. The template is

    <|im_start|>ROLE<|im_body|>TEXT<|im_sep|>TEXT...<|im_end|>

with ``<|im_sep|>`` between the texts of turns that were merged. Roles and
texts are escaped: every ``<`` that is followed by underscores (none or more)
and ``|`` gets one more underscore, so no control string stands inside them and
unescaping (one underscore less) restores them exactly.

The loss mask lists the spans (start, length in code points) of the assistant
texts in the formatted string, separators left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, BODY, SEP, END = "<|im_start|>", "<|im_body|>", "<|im_sep|>", "<|im_end|>"
LEARNED = "assistant"


def escaped(c: Column) -> Column:
    return F.regexp_replace(c, r"<(_*)\|", r"<$1_|")


def unescaped(c: Column) -> Column:
    return F.regexp_replace(c, r"<(_*)_\|", r"<$1|")


def _split(c: Column, control: str) -> Column:
    return F.split(c, control.replace("|", r"\|"), -1)


def format_conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss_spans) of rows (conv_id, turn, role, text); others are ignored.

    Turns go by number, null first, then by role and text, so ties and
    repeated rows have one order. Null roles and texts are empty; rows of a
    null conv_id form a conversation. An empty table gives no rows. One
    shuffle; a conversation is one row of the result.
    """
    row = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    convs = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(row)).alias("turns"))
    # where a message starts: the first turn, and each whose role is not the one before
    roles = F.transform("turns", lambda t: t["role"])
    starts = F.filter(F.sequence(F.lit(1), F.size("turns")),
                      lambda i: (i == 1) | (F.get(F.col("roles"), i - 1) != F.get(F.col("roles"), i - 2)))
    convs = convs.withColumn("roles", roles).withColumn("starts", starts)
    ends = F.concat(F.slice("starts", 2, F.size("starts")), F.array(F.size("turns") + 1))
    texts = F.transform("turns", lambda t: escaped(t["text"]))
    convs = convs.withColumn("texts", texts).withColumn("messages", F.zip_with("starts", ends, lambda a, b: F.struct(
        F.get(F.col("roles"), a - 1).alias("role"), F.slice("texts", a, b - a).alias("texts"))))
    text = F.transform("messages", lambda m: F.concat(F.lit(START), escaped(m["role"]), F.lit(BODY), F.array_join(m["texts"], SEP), F.lit(END)))
    # one pass over the messages: the position reached, and the spans so far
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))
    head = lambda m: len(START) + F.length(escaped(m["role"])) + len(BODY)
    inner = lambda at, m: F.aggregate(
        m["texts"], F.struct(at.alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans")),
        lambda acc, t: F.struct((acc["at"] + F.length(t) + len(SEP)).alias("at"),
                                F.concat(acc["spans"], F.array(F.struct(acc["at"].alias("start"), F.length(t).alias("length")))).alias("spans")))
    folded = F.aggregate("messages", zero, lambda acc, m: _then(inner(acc["at"] + head(m), m), acc, m))
    return convs.select("conv_id", F.array_join(text, "").alias("formatted"), folded["spans"].alias("loss_spans"))


def _then(message: Column, acc: Column, m: Column) -> Column:
    spans = F.when(m["role"] == LEARNED, F.concat(acc["spans"], message["spans"])).otherwise(acc["spans"])
    return F.struct((message["at"] - len(SEP) + len(END)).alias("at"), spans.alias("spans"))


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, turns, learned): what the formatted text and the loss mask say.

    turns: array of (role, text) in order; learned: the texts under the mask.
    """
    messages = F.filter(_split(F.col("formatted"), END), lambda m: m != "")
    part = F.transform(messages, lambda m: _split(F.substring(m, len(START) + 1, F.length(m)), BODY))
    turns = F.flatten(F.transform(part, lambda p: F.transform(
        _split(F.get(p, 1), SEP), lambda t: F.struct(unescaped(F.get(p, 0)).alias("role"), unescaped(t).alias("text")))))
    learned = F.transform("loss_spans", lambda s: unescaped(F.substring(F.col("formatted"), s["start"] + 1, s["length"])))
    return formatted.select("conv_id", "formatted", turns.alias("turns"), learned.alias("learned"))
