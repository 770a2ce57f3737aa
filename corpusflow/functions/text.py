"""Text expressions: whitespace tokens and the fixed templates of fine-tuning data."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Spelled out because engines disagree on what \s covers.
SPACES = r"[ \t\n\r\f]+"
WORD = r"[^ \t\n\r\f]+"


def words(text: Column) -> Column:
    """Whitespace-separated tokens as array<string>."""
    return F.filter(F.split(text, SPACES), lambda w: w != "")


def word_count(text: Column) -> Column:
    """Number of whitespace tokens, without building the array."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0))


def non_empty(text: Column) -> Column:
    """True where there is text; null counts as empty."""
    return F.coalesce(text, F.lit("")) != ""


def chat_line(role: Column, content: Column) -> Column:
    """One message of the chat template; the role defaults to user, the content to nothing."""
    return F.concat(
        F.lit("<|"), F.coalesce(role, F.lit("user")), F.lit("|>\n"), F.coalesce(content, F.lit("")), F.lit("\n")
    )


def chat_text(messages: Column) -> Column:
    """Chat template over array<struct<role, content>>."""
    return F.array_join(F.transform(messages, lambda m: chat_line(m["role"], m["content"])), "")


def instruction_text(instruction: Column, response: Column) -> Column:
    return F.concat(F.lit("### Instruction:\n"), instruction, F.lit("\n\n### Response:\n"), response)


def question_prompt(question: Column) -> Column:
    return F.concat(F.lit("Question: "), question, F.lit("\n\nAnswer: Let me solve this step by step.\n"))


def joined_contents(messages: Column) -> Column:
    """Contents of a message list joined by one space."""
    return F.array_join(F.transform(messages, lambda m: F.coalesce(m["content"], F.lit(""))), " ")
