"""Preparing supervised fine-tuning rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from corpusflow.functions.text import chat_line, chat_text, instruction_text
from corpusflow.operators.ordering import Running, running
from corpusflow.operators.packing import IGNORE
from corpusflow.operators.tokens import PAD_ID, encode, pad


def example_text(df: DataFrame) -> Column:
    """The text of an example, chosen once from the columns of the frame.

    text, else messages (chat template), else instruction and response, else the first column.
    """
    columns = df.columns
    if "text" in columns:
        return F.col("text")
    if "messages" in columns:
        return chat_text(F.col("messages"))
    if "instruction" in columns and "response" in columns:
        return instruction_text(F.col("instruction"), F.col("response"))
    return F.col(columns[0]).cast("string")


def format_examples(df: DataFrame, out: str = "text") -> DataFrame:
    return df.withColumn(out, example_text(df))


def chat_template(turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role",
                  content: str = "text") -> DataFrame:
    """Chat text per conversation from one row per turn.

    A conversation ends up in one value whatever the plan, so it has to fit into a row.
    """
    line = F.struct(F.col(turn).alias("turn"), chat_line(F.col(role), F.col(content)).alias("line"))
    return turns.groupBy(conversation).agg(F.array_sort(F.collect_list(line)).alias("lines")).select(
        conversation, F.array_join(F.transform("lines", lambda l: l["line"]), "").alias("text")
    )


def mask_labels(df: DataFrame) -> DataFrame:
    """Labels: the ids where the attention mask is set, -100 elsewhere.

    The mask decides, not the id, because the pad token may equal the end token.
    """
    pairs = F.arrays_zip("input_ids", "attention_mask")
    return df.withColumn(
        "labels",
        F.transform(pairs, lambda p: F.when(p["attention_mask"] == 0, F.lit(IGNORE)).otherwise(p["input_ids"])),
    )


def prepare(df: DataFrame, vocab: DataFrame, seq_len: int, pad_id: int = PAD_ID) -> DataFrame:
    """Format, encode, cut, pad and label."""
    encoded = encode(format_examples(df), vocab, max_length=seq_len)
    return mask_labels(pad(encoded, seq_len, pad_id))


def prepare_chats(
    turns: DataFrame, vocab: DataFrame, seq_len: int, pad_id: int = PAD_ID, conversation: str = "conv_id",
    turn: str = "turn", role: str = "role", content: str = "text", parts: int | None = None,
) -> DataFrame:
    """``prepare`` for conversations that come as one row per turn.

    Every line ends in white space, so lines can be encoded on their own. A running token count tells
    which turns reach into the first ``seq_len`` tokens; only those are gathered, however long the
    conversation is.
    """
    lines = turns.select(conversation, turn, chat_line(F.col(role), F.col(content)).alias("_line"))
    coded = encode(lines, vocab, max_length=seq_len, text="_line", out="_ids").drop("_line")
    placed = running(
        coded, [conversation], [turn], {"_before": Running("sum", F.size("_ids"), exclusive=True)}, parts=parts
    )
    listed = F.array_sort(F.collect_list(F.struct(F.col(turn).alias("turn"), F.col("_ids").alias("ids"))))
    chats = placed.where(F.col("_before") < seq_len).groupBy(conversation).agg(
        F.slice(F.flatten(F.transform(listed, lambda l: l["ids"])), 1, seq_len).alias("ids")
    )
    return mask_labels(pad(chats, seq_len, pad_id))


def step_budget(df: DataFrame, batch_size: int, epochs: int, accum: int, warmup_ratio: float) -> DataFrame:
    """One row: examples, batches, total optimizer steps and warm-up steps."""
    counted = df.agg(F.count(F.lit(1)).alias("examples"))
    batches = F.ceil(F.col("examples") / batch_size).cast("bigint")
    total = F.floor(batches * epochs / accum).cast("bigint")
    return counted.select(
        "examples", batches.alias("batches"), total.alias("total_steps"),
        F.floor(total * F.lit(warmup_ratio)).cast("bigint").alias("warmup_steps"),
    )
