"""Chat formatting: an example for each reply, with every earlier turn as context.

A turn is written as ``<turn ROLE>``, a line feed, its text, ``</turn>`` and a line feed. Inside
texts and roles a backslash becomes ``\\b``, and the ``<`` of ``<turn`` and ``</turn`` becomes
``\\l`` (in roles also ``>`` becomes ``\\g`` and a line feed ``\\n``), so a text never holds a mark
and reading back is exact.

Every assistant turn gives an example: all earlier turns and its own opening mark as context, its
text and closing mark as target, the only part to train on. Turns after the last reply (or all turns
where there is none) are the context of a last example with an empty target. An example holds its
conversation up to there in one row, so conversations are taken to fit in a row.

Turns are ordered by turn, then role, then text. A null text, role or turn counts as empty, empty
and lowest; repeated rows are turns of their own; rows without a conv_id are left out. An empty table
gives an empty result. Other columns are not read, whatever their names. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "<turn ", "</turn>\n"
TRAINED_ROLE = "assistant"

TEXT_CODES = [("\\", "\\b"), ("<turn", "\\lturn"), ("</turn", "\\l/turn")]
ROLE_CODES = [*TEXT_CODES, (">", "\\g"), ("\n", "\\n")]


def escape(text: Column, codes: list[tuple[str, str]] = TEXT_CODES) -> Column:
    for plain, code in codes:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    """Every backslash of an escaped text starts a code, so the order of codes does not matter
    until backslashes themselves come back."""
    for code, plain in (("\\n", "\n"), ("\\g", ">"), ("\\l", "<"), ("\\b", "\\")):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def mark(role: Column) -> Column:
    return F.concat(F.lit(OPEN), escape(role, ROLE_CODES), F.lit(">\n"))


def examples(conversations: DataFrame) -> DataFrame:
    """conv_id, target_turn (position from 0; null for turns without a reply), context, target."""
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(
            F.col("turn").cast("long").alias("turn"),
            F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
            F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        ).alias("t"))
    whole = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns")).select(
        "conv_id",
        F.transform("turns", lambda t: F.struct(
            mark(t["role"]).alias("mark"),
            F.concat(escape(t["text"]), F.lit(CLOSE)).alias("body"),
            (t["role"] == TRAINED_ROLE).alias("trained"))).alias("parts"))
    # Positions to write an example for: replies, and the end where the last turn is none.
    at = F.filter(
        F.sequence(F.lit(0), F.size("parts")),
        lambda i: F.when(i < F.size("parts"), F.get(F.col("parts.trained"), i))
        .otherwise(~F.element_at(F.col("parts.trained"), -1)))
    before = F.transform(F.slice("parts", F.lit(1), F.col("at")),
                         lambda p: F.concat(p["mark"], p["body"]))
    this = F.get("parts", F.col("at"))
    return whole.select("conv_id", "parts", F.explode(at).alias("at")).select(
        "conv_id",
        F.when(F.col("at") < F.size("parts"), F.col("at")).alias("target_turn"),
        F.concat(F.array_join(before, ""), F.coalesce(this["mark"], F.lit(""))).alias("context"),
        F.coalesce(this["body"], F.lit("")).alias("target"))


def read_turns(formatted: Column) -> Column:
    """array<struct<role, text>> of a formatted text."""
    parts = F.split(formatted, CLOSE)
    return F.transform(
        F.slice(parts, F.lit(1), F.size(parts) - 1),
        lambda p: F.struct(
            unescape(F.substr(F.substring_index(p, ">\n", 1), F.lit(len(OPEN) + 1))).alias("role"),
            unescape(F.substr(p, F.position(F.lit(">\n"), p) + 2)).alias("text")))


def read_back(made: DataFrame) -> DataFrame:
    """What the examples of each conversation say: all turns, and all text under the loss."""
    order = F.coalesce("target_turn", F.lit(2**31 - 1))
    lost = F.transform(
        F.sort_array(F.collect_list(F.struct(order.alias("at"), "target"))),
        lambda e: unescape(F.replace(e["target"], F.lit(CLOSE), F.lit(""))))
    read = made.groupBy("conv_id").agg(
        F.max(F.struct(order.alias("at"), F.concat("context", "target").alias("text")))["text"]
        .alias("longest"),
        F.array_join(lost, "").alias("loss"),
        F.sum(F.char_length("context") + F.char_length("target")).cast("long")
        .alias("formatted_chars"),
    ).withColumn("turns", read_turns(F.col("longest")))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))

    def sha(text: Column) -> Column:
        return F.sha2(text.cast("binary"), 256)

    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        sha(F.array_join(lines, "")).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        sha(F.col("loss")).alias("loss_sha256"),
        "formatted_chars",
    )
