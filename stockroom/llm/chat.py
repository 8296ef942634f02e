"""Chat formatting: every assistant turn becomes an example of its own.

An example holds the turns before the reply as context and the reply as the only
trainable text. One shuffle gathers a conversation; examples are then streamed out of
its row by a generator, so no group of examples is ever held together. An example is
as long as the conversation up to its reply, so a conversation must fit in a row.

Template: ``<s>role\\ntext\\n</s>`` per turn. The role is URL-encoded. A control string
inside a text (``<s>``, ``</s>``, ``[INST]``, ``[/INST]``, with any backslashes before it)
gets one backslash more, which :func:`unescaped` takes away again; the newline before
``</s>`` keeps a text's last characters from joining with the marker.

Defined results: turns are ordered by turn, then role, then text, NULL first; a NULL
text or role is empty; repeated rows are repeated turns; rows with a NULL ``conv_id``
form one conversation. Turns after the last reply, or a conversation without one, give
a last example with an empty loss span. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CONTROL = r"</?s>|\[/?INST\]"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, rf"(\\*)({CONTROL})", r"\\$1$2")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, rf"\\(\\*(?:{CONTROL}))", "$1")


def examples(conversations: DataFrame, reply: str = "assistant") -> DataFrame:
    """conv_id, target (turn's place from 0), text, loss_start, loss_end (code points), whole.

    ``whole`` marks the one example of a conversation that holds all of its turns.
    """
    turn = F.struct(
        F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    gathered = conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))

    def rendered(t: Column) -> Column:
        return F.struct(
            t["role"].alias("role"),
            F.concat(F.lit("<s>"), F.url_encode(t["role"]), F.lit("\n")).alias("head"),
            escaped(t["text"]).alias("body"),
        )

    places = F.transform(F.col("turns"), lambda t, i: F.when((t["role"] == reply), i))
    gathered = gathered.select(
        "conv_id",
        F.transform("turns", rendered).alias("turns"),
        F.array_distinct(
            F.concat(F.array_compact(places), F.array(F.size("turns") - 1))
        ).alias("targets"),
    )
    one = gathered.select("conv_id", "turns", F.explode("targets").alias("target"))

    def joined(turns: Column) -> Column:
        return F.concat_ws("", F.transform(turns, lambda t: F.concat(t["head"], t["body"], F.lit("\n</s>"))))

    last = F.col("turns")[F.col("target")]
    before = joined(F.slice("turns", F.lit(1), F.col("target")))
    one = one.select(
        "conv_id", "target", before.alias("context"), last.alias("last"),
        (F.col("target") == F.size("turns") - 1).alias("whole"),
    )
    start = F.length("context") + F.length("last.head")
    return one.select(
        "conv_id",
        F.col("target").cast("long").alias("target"),
        F.concat("context", "last.head", "last.body", F.lit("\n</s>")).alias("text"),
        start.cast("long").alias("loss_start"),
        (start + F.when(F.col("last.role") == reply, F.length("last.body")).otherwise(0))
        .cast("long").alias("loss_end"),
        "whole",
    )


def turns_of(text: Column) -> Column:
    """Parse formatted text back into an array of (role, text)."""
    parts = F.split(text, r"(?<!\\)</s>")
    turns = F.filter(parts, lambda p: p != "")

    def parsed(p: Column) -> Column:
        cut = F.instr(p, "\n")
        return F.struct(
            F.url_decode(F.substring(p, F.lit(4), cut - 4)).alias("role"),
            unescaped(F.substring(p, cut + 1, F.length(p) - cut - 1)).alias("text"),
        )

    return F.transform(turns, parsed)


def loss_text(text: Column, start: Column, end: Column) -> Column:
    """The text under the loss mask as it was before escaping."""
    return unescaped(F.substring(text, (start + 1).cast("int"), (end - start).cast("int")))


def digest(written: DataFrame) -> DataFrame:
    """Read examples back into one row per conversation."""
    turns = F.transform(
        turns_of(F.col("text")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    )
    parsed = written.select(
        "conv_id",
        "target",
        F.length("text").cast("long").alias("chars"),
        loss_text(F.col("text"), F.col("loss_start"), F.col("loss_end")).alias("loss"),
        F.when(F.col("whole"), turns).alias("turns"),
    ).select(
        "conv_id", "target", "chars", "loss",
        F.when(F.col("turns").isNotNull(), F.size("turns").cast("long")).alias("n_turns"),
        F.when(F.col("turns").isNotNull(), F.sha2(F.concat_ws("", "turns"), 256)).alias("turns_sha256"),
    )
    loss = F.concat_ws("", F.transform("losses", lambda x: x["loss"]))
    return (
        parsed.groupBy("conv_id")
        .agg(
            F.max("n_turns").alias("n_turns"),
            F.max("turns_sha256").alias("turns_sha256"),
            F.sum("chars").alias("formatted_chars"),
            F.sort_array(F.collect_list(F.struct("target", "loss"))).alias("losses"),
            F.count("*").alias("n_examples"),
        )
        .withColumn("loss", loss)
        .select(
            "conv_id", "n_turns", "turns_sha256",
            F.length("loss").cast("long").alias("loss_chars"),
            F.sha2("loss", 256).alias("loss_sha256"),
            "formatted_chars", "n_examples",
        )
    )
