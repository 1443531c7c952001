"""Chat formatting with Spark expressions only.

Method: the turns of a conversation are collected as structs and sorted, adjacent turns of one
role are merged with array functions, and everything is concatenated. No Python runs.

Template: every block of turns of one role is ``<s>role[INST]text<sep>text[/INST]</s>``. Control
strings inside roles and texts get a backslash after their first character (one more if
they have some), so reading back is exact: ``<s>`` becomes ``<\\s>``.

The output is one row per conversation by definition, so the largest conversation bounds
the memory of a task; everything within it takes linear time.

Defined results: null texts and roles count as empty; turns of one number are ordered by
role, then text; null turn numbers come first; repeated rows are turns of their own; a null
conversation id is a conversation; an empty table has no conversations; further columns are
not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Control strings of the template.
OPEN, CLOSE, BEGIN, END, NEXT = "<s>", "</s>", "[INST]", "[/INST]", "<sep>"
_CONTROL = r"(s>|/s>|INST\]|/INST\]|sep>)"


def escape(text: Column) -> Column:
    """A text in which no control string is left."""
    return F.regexp_replace(text, r"([<\[])(\\*)" + _CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    """The text that ``escape`` was given."""
    return F.regexp_replace(text, r"([<\[])\\(\\*)" + _CONTROL, r"$1$2$3")


def format_conversations(
    df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """One row per conversation: the id and ``formatted``."""
    turns = df.select(
        F.col(conv_col).alias("_conv"),
        F.struct(
            F.col(turn_col).alias("turn"),
            escape(F.coalesce(F.col(role_col).cast("string"), F.lit(""))).alias("role"),
            escape(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("text"),
        ).alias("_turn"),
    )
    sorted_turns = turns.groupBy("_conv").agg(F.sort_array(F.collect_list("_turn")).alias("turns"))
    # where a block begins: the first turn, and every turn whose role differs from the one before
    roles = F.transform("turns", lambda t: t["role"])
    changes = F.zip_with(
        F.concat(F.array(F.lit(None).cast("string")), F.slice(roles, 1, F.size("turns") - 1)),
        roles,
        lambda before, role: F.coalesce(before != role, F.lit(True)),
    )
    starts = F.filter(F.transform(changes, lambda c, i: F.when(c, i)), lambda i: i.isNotNull())
    begun = sorted_turns.withColumn("starts", starts)
    ends = F.concat(F.slice("starts", 2, F.size("starts")), F.array(F.size("turns")))
    spans = begun.withColumn("spans", F.arrays_zip(F.col("starts").alias("first"), ends.alias("past")))

    def block(span: Column) -> Column:
        merged = F.slice("turns", span["first"] + 1, span["past"] - span["first"])
        texts = F.array_join(F.transform(merged, lambda t: t["text"]), NEXT)
        return F.concat(F.lit(OPEN), merged[0]["role"], F.lit(BEGIN), texts, F.lit(END + CLOSE))

    return spans.select(
        F.col("_conv").alias(conv_col), F.array_join(F.transform("spans", block), "").alias("formatted")
    )


def read_back(formatted: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """One row per conversation: the id, ``formatted``, and the array ``turns`` of its roles and texts."""
    close = F.split("formatted", END.replace("[", r"\[").replace("]", r"\]") + CLOSE, -1)
    blocks = F.slice(close, 1, F.size(close) - 1)

    def turns(block: Column) -> Column:
        head = F.substring_index(block, BEGIN, 1)
        body = F.substr(block, F.length(head) + len(BEGIN) + 1)
        role = unescape(F.substr(head, F.lit(len(OPEN) + 1)))
        return F.transform(
            F.split(body, NEXT, -1), lambda t: F.struct(role.alias("role"), unescape(t).alias("text"))
        )

    return formatted.select(conv_col, "formatted", F.flatten(F.transform(blocks, turns)).alias("turns"))


def digests(read: DataFrame, conv_col: str = "conv_id", trained_role: str = "assistant") -> DataFrame:
    """What was read back: counts and digests of all turns and of the texts under the loss mask."""
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    trained = F.filter("turns", lambda t: t["role"] == trained_role)
    loss = read.withColumn("_loss", F.array_join(F.transform(trained, lambda t: t["text"]), ""))
    return loss.select(
        conv_col,
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.char_length("_loss").cast("long").alias("loss_chars"),
        F.sha2("_loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
