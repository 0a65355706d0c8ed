"""Chat formatting: every assistant turn becomes an example of its own.

An example holds all turns up to and including one assistant turn; only the text of that turn is
trainable. ``conversation_examples`` builds the rows; only built-in functions are used.

Template, per turn: ``<|start|>role<|sep|>text<|end|>``. Inside roles and texts a backslash follows
every ``<``, every ``[`` and every backslash, so neither the marks of this template nor other
control strings such as ``</s>`` or ``[INST]`` can stand there, and dropping the added backslashes
gives the original back.

Defined results: null texts and roles count as empty; turns sort by number (null first), then role,
then text, so ties and repeated rows keep a fixed order and all of them stay; rows with a null
conversation form one conversation. Turns after the last reply, or of a conversation without one,
stay in a last example without a trainable span (``loss_chars`` 0). An empty table gives no rows;
other columns of the input are ignored.

A conversation is one value by definition of the operator (its last example is its whole text), so
its turns meet in one row; between conversations nothing is gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, SEP, END = "<|start|>", "<|sep|>", "<|end|>"
ASSISTANT = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[\\])", r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[\\])\\", r"$1")


def conversation_examples(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """Columns: conv_id, example, n_examples, text, loss_start (from 0, code points), loss_chars.

    ``text`` is the prefix of the formatted conversation up to the end of the example's last turn.
    """
    plain = F.coalesce(F.col(text).cast("string"), F.lit(""))
    who = F.coalesce(F.col(role).cast("string"), F.lit(""))
    head = F.concat(F.lit(START), escape(who), F.lit(SEP))
    in_order = Window.partitionBy("conv_id").orderBy("turn", "role", "plain").rowsBetween(Window.unboundedPreceding, 0)
    segments = (
        turns.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), who.alias("role"), plain.alias("plain"),
                     F.concat(head, escape(plain), F.lit(END)).alias("segment"), F.char_length(head).alias("head_chars"))
        .withColumn("chars", F.char_length("segment"))
        .withColumn("stop", F.sum("chars").over(in_order).cast("int"))
        .withColumn("total", F.sum("chars").over(Window.partitionBy("conv_id")))
        .withColumn("reply", F.col("role") == ASSISTANT)
        .select("conv_id", F.struct(
            "stop",
            "reply",
            (F.col("stop") - F.col("chars") + F.col("head_chars")).alias("loss_start"),
            # A reply ends an example; so does the last turn, whoever speaks.
            (F.col("reply") | (F.col("stop") == F.col("total"))).alias("ends"),
            "segment",
        ).alias("t"))
    )
    whole = (
        segments.groupBy("conv_id")
        .agg(F.array_sort(F.collect_list("t")).alias("turns"))
        .withColumn("formatted", F.array_join(F.transform("turns", lambda t: t["segment"]), ""))
        .withColumn("spans", F.transform(
            F.filter("turns", lambda t: t["ends"]), lambda t: F.struct(t["reply"], t["stop"], t["loss_start"])))
    )
    examples = (
        whole.select("conv_id", "formatted", F.size("spans").alias("n_examples"), F.posexplode("spans").alias("example", "s"))
        .withColumn("text", F.substring("formatted", 1, F.col("s.stop")))
    )
    loss = F.when(F.col("s.reply"), F.col("s.stop") - F.col("s.loss_start") - len(END)).otherwise(0)
    return examples.select(
        "conv_id", F.col("example").cast("int").alias("example"), "n_examples", "text",
        F.col("s.loss_start").alias("loss_start"), loss.alias("loss_chars"))


def parse_turns(text: Column) -> Column:
    """The turns of a formatted text as an array of (role, text)."""
    segments = F.filter(F.split(text, r"<\|end\|>"), lambda s: s != F.lit(""))
    return F.transform(
        segments,
        lambda s: F.struct(
            unescape(F.substring_index(F.substring(s, len(START) + 1, 2**31 - 1), SEP, 1)).alias("role"),
            unescape(F.substring(
                s, F.char_length(F.substring_index(s, SEP, 1)) + len(SEP) + 1, F.lit(2**31 - 1))).alias("text"),
        ),
    )


def conversation_digest(examples: DataFrame) -> DataFrame:
    """Per conversation, read back from the examples: its turns and all text under the loss mask.

    Only the last example carries its whole text into the exchange; the others carry their reply.
    """
    reply = unescape(F.substring("text", F.col("loss_start") + 1, F.col("loss_chars")))
    last = F.when(F.col("example") == F.col("n_examples") - 1, F.col("text"))
    grouped = (
        examples.select("conv_id", "example", "n_examples", reply.alias("reply"), last.alias("last"))
        .groupBy("conv_id")
        .agg(
            F.array_sort(F.collect_list(F.struct("example", "reply"))).alias("replies"),
            F.max("last").alias("formatted"),
            F.max("n_examples").alias("n_examples"),
        )
        .withColumn("read", parse_turns(F.col("formatted")))
        .withColumn("loss", F.array_join(F.transform("replies", lambda r: r["reply"]), ""))
    )
    lines = F.transform("read", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return grouped.select(
        "conv_id",
        F.size("read").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
        F.col("n_examples").cast("long").alias("n_examples"),
    )
