"""Checking numeric answers in generated text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# How numbers and marked answers look.
NUMBER = r"[+-]?\d+(?:,\d{3})*(?:\.\d+)?"
MARKED = r"####\s*(" + NUMBER + ")"
NOT_NUMERIC = r"[^\d.-]"
STRIPPED = " \t\n\r\f\x0b"


def _plain(number: Column) -> Column:
    return F.replace(number, F.lit(","), F.lit(""))


def marked_answer(response: Column) -> Column:
    """The first number after ####, without commas; null where there is none."""
    found = F.regexp_extract(response, MARKED, 1)
    return F.when(found != "", _plain(found))


def last_number(response: Column) -> Column:
    """The last number of the response, without commas; null where there is none."""
    return _plain(F.try_element_at(F.regexp_extract_all(response, F.lit(NUMBER), F.lit(0)), F.lit(-1)))


def prediction(response: Column) -> Column:
    return F.coalesce(marked_answer(response), last_number(response))


def clean_answer(answer: Column, marked_first: bool = False) -> Column:
    """The reference answer reduced to digits, points and minus signs.

    ``marked_first`` looks for #### before, which suits worked answers.
    """
    cleaned = F.regexp_replace(answer, NOT_NUMERIC, "")
    return F.coalesce(marked_answer(answer), cleaned) if marked_first else cleaned


def math_reward(response: Column, answer: Column, marked_first: bool = False) -> Column:
    """1.0 where prediction and answer are equal numbers, else 0.0."""
    equal = prediction(response).try_cast("double") == clean_answer(answer, marked_first).try_cast("double")
    return F.coalesce(equal, F.lit(False)).cast("double")


def strip_prompt(completion: Column, prompt: Column) -> Column:
    """The completion after its prompt, without surrounding white space."""
    return F.trim(F.substr(completion, F.length(prompt) + 1), F.lit(STRIPPED))
