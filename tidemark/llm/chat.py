"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all preceding turns are its context and its
reply alone is trainable. Turns after the last assistant turn would be in no example, so they end
one more, without a target. A turn is written as

    <|turn|>ROLE<|says|>TEXT<|end|>

and control strings inside roles and texts get a backslash after their first character (one more
if they have some already), which reading takes away again; nothing else changes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import table

TURN, SAYS, END = "<|turn|>", "<|says|>", "<|end|>"
#: Control strings after their first character: this template's and those of common chat formats (fixed values).
CONTROL = r"(/?s>|/?INST\]|</?SYS>>|\|[A-Za-z_]+\|>)"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])(\\*)" + CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])\\(\\*)" + CONTROL, r"$1$2$3")


def turns_of(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation: conv_id and turns array<struct<role, text>> by turn; ties by role, then text."""
    one = F.struct(F.col(turn_col).alias("turn"), F.coalesce(role_col, F.lit("")).alias("role"), F.coalesce(text_col, F.lit("")).alias("text"))
    rows = df.select(F.col(conv_col).alias("conv_id"), one.alias("t"))
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))


def examples(df: DataFrame, **columns: str) -> DataFrame:
    """conv_id, example (from 0), formatted, loss_start (code points before the mask), loss_length.

    Null roles and texts count as empty, a null conv_id is one conversation, null turns come first, repeated
    rows are turns like others, other columns are not carried. loss_length is 0 in an example without target.
    """
    written = F.transform("turns", lambda t: F.concat(F.lit(TURN), escape(t["role"]), F.lit(SAYS), escape(t["text"]), F.lit(END)))
    convs = turns_of(df, **columns).withColumn("written", written)
    ends = F.expr("filter(sequence(1, size(turns)), i -> turns[i - 1].role = 'assistant' OR i = size(turns))")
    rows = convs.select("conv_id", "turns", "written", F.posexplode(ends).alias("example", "upto"))
    last = F.element_at("turns", F.col("upto"))
    rows = rows.select(
        "conv_id",
        "example",
        F.array_join(F.slice("written", 1, F.col("upto")), "").alias("formatted"),
        F.when(last["role"] == "assistant", F.char_length(escape(last["text"]))).otherwise(0).cast("long").alias("loss_length"),
    )
    return rows.select("conv_id", "example", "formatted", (F.char_length("formatted") - len(END) - F.col("loss_length")).cast("long").alias("loss_start"), "loss_length")


def read_turns(formatted: Column) -> Column:
    """array<struct<role, text>> read back from an example."""
    parts = F.filter(F.split(formatted, r"<\|turn\|>"), lambda p, i: i > 0)
    role = lambda p: unescape(F.substring_index(p, SAYS, 1))
    text = lambda p: unescape(F.substring_index(F.substring_index(p, SAYS, -1), END, 1))
    return F.transform(parts, lambda p: F.struct(role(p).alias("role"), text(p).alias("text")))


def digests(made: DataFrame) -> DataFrame:
    """Per conversation, from its examples alone: turns, what the masks cover, and sizes."""
    masked = F.expr("substring(formatted, cast(loss_start AS int) + 1, cast(loss_length AS int))")
    rows = made.select("conv_id", "example", "formatted", unescape(masked).alias("loss"))
    per = rows.groupBy("conv_id").agg(
        F.max_by("formatted", "example").alias("longest"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("example", "loss"))), lambda x: x["loss"]), "").alias("loss"),
        F.sum(F.char_length("formatted")).cast("long").alias("formatted_chars"),
    )
    per = per.withColumn("turns", read_turns(F.col("longest")))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return per.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(lines, 256).alias("turns_sha256"), F.char_length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of all `conversations` and of conversation -1, whose texts hold control strings."""
    text = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", text), (-1, 1, "assistant", text)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return digests(examples(rows.unionByName(extra)))
