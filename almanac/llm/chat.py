"""Chat formatting with Spark expressions only.

A conversation's turns are collected as structs and sorted; adjacent turns of one role
share one block::

    <|im_start|>role\\ntext<|im_sep|>text<|im_end|>\\n

Inside roles and texts a backslash becomes ``\\s`` and ``<|`` becomes ``<\\b`` (a newline in a
role: ``\\n``), so no control string can occur there and every step can be undone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"


def _swap(text: Column, pairs: list[tuple[str, str]]) -> Column:
    for a, b in pairs:
        text = F.replace(text, F.lit(a), F.lit(b))
    return text


_TEXT = [("\\", "\\s"), ("<|", "<\\b")]
_ROLE = [*_TEXT, ("\n", "\\n")]


def escape(text: Column, role: bool = False) -> Column:
    return _swap(text, _ROLE if role else _TEXT)


def unescape(text: Column, role: bool = False) -> Column:
    return _swap(text, [(b, a) for a, b in reversed(_ROLE if role else _TEXT)])


def format_conversations(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row (conv_id, formatted) per conversation.

    Turns are ordered by turn, then role, then text (repeated rows stay, side by side); a null
    turn comes first. A null role or text is empty. A null conversation id is one conversation.
    An empty table gives no rows. Other columns are dropped.
    """
    one = F.struct(F.col(turn).alias("turn"), F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    turns = rows.select(F.col(conv).alias("conv_id"), one.alias("t")).groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))

    def part(t: Column, i: Column) -> Column:
        same = t["role"] == F.get("turns", i - 1)["role"]
        opened = F.concat(F.lit(START), escape(t["role"], role=True), F.lit("\n"))
        lead = F.when(i == 0, opened).when(same, F.lit(SEP)).otherwise(F.concat(F.lit(END + "\n"), opened))
        return F.concat(lead, escape(t["text"]))

    return turns.select("conv_id", F.concat(F.array_join(F.transform("turns", part), ""), F.lit(END + "\n")).alias("formatted"))


def read_back(formatted: DataFrame) -> DataFrame:
    """The turns of formatted conversations: (conv_id, formatted, turns: array<struct<role, text>>)."""

    def block(b: Column) -> Column:
        body = F.substring_index(b, END, 1)
        head = F.substring_index(body, "\n", 1)
        texts = F.split(F.substr(body, F.length(head) + 2), r"<\|im_sep\|>")
        return F.transform(texts, lambda t: F.struct(unescape(head, role=True).alias("role"), unescape(t).alias("text")))

    blocks = F.split("formatted", r"<\|im_start\|>")
    return formatted.select("conv_id", "formatted", F.flatten(F.transform(F.slice(blocks, F.lit(2), F.size(blocks)), block)).alias("turns"))


def digest(formatted: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """What the formatted text says: turns, the text under the loss mask, and their hashes."""
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform(F.filter("turns", lambda t: t["role"] == loss_role), lambda t: t["text"]), "")
    return read_back(formatted).withColumn("loss", loss).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(lines.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
