"""Quality rules as weak supervision.

Each rule votes keep (1), reject (-1) or abstains (0). Expectation-maximisation estimates how often
every rule is right on good and on bad texts, without labels: given accuracies, a text's votes give a posterior
probability of being good (rules vote independently given the truth); given posteriors, an accuracy is
the expected share of right votes. The posterior replaces an all-must-pass filter. Texts with the same
votes are alike for this, so the fit works on the counts of vote patterns, three to the number of
rules at most, which Spark counts over all documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from corpusflow.llm.textbytes import mix, raw, shingle_hashes, slices, word_hashes, word_spans
from corpusflow.session import materialise

# The characters that count as symbols.
SYMBOLS = "#*$%&|<>"
#: Frequent words of English, German, French and Spanish.
FUNCTION_WORDS = tuple("the of and to in a is that for with der die und das zu den le la les de et des que el los y un en".split())
WINDOW = 3
FEATURES = "n_words bigint, word_chars bigint, n_symbols bigint, n_repeat_words bigint, n_function_words bigint, n_upper bigint, n_letters bigint, n_closed bigint"


def _table(characters: bytes) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(characters)] = True
    return table


_SYMBOL = _table(SYMBOLS.encode())
_UPPER = _table(bytes(range(0x41, 0x5B)))
_LETTER = _UPPER | _table(bytes(range(0x61, 0x7B)))
_CLOSING = _table(b".!?")


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def _hashed(words: tuple[str, ...]) -> np.ndarray:
    data, offsets = raw(pa.array([" ".join(words)]))
    starts, ends, _ = word_spans(data, offsets)
    return np.sort(word_hashes(data, starts, ends))


def measure(column: pa.Array) -> list[np.ndarray]:
    """The features of each text, in the order of ``FEATURES``."""
    data, offsets = raw(column)
    starts, ends, owner = word_spans(data, offsets)
    n = len(offsets) - 1
    words = word_hashes(data, starts, ends)
    firsts = np.searchsorted(owner, np.arange(n + 1))
    # Windows of three words inside one text; the same words in another text are another window.
    windows = mix(shingle_hashes(words, WINDOW) ^ mix(owner.astype(np.uint64) + np.uint64(1)))
    whole = np.zeros(len(words), dtype=bool)
    if len(words) >= WINDOW:
        whole[: len(words) - WINDOW + 1] = owner[: len(words) - WINDOW + 1] == owner[WINDOW - 1 :]
    places = np.flatnonzero(whole)
    order = places[np.argsort(windows[places], kind="stable")]
    same = windows[order][1:] == windows[order][:-1]
    again = np.zeros(len(order), dtype=bool)
    again[1:] |= same
    again[:-1] |= same
    repeated = np.zeros(len(words) + WINDOW, dtype=bool)
    for k in range(WINDOW):
        repeated[order[again] + k] = True
    chars = (data & 0xC0) != 0x80
    inside = np.concatenate([[0], np.cumsum(chars, dtype=np.int64)])
    word_chars = np.concatenate([[0], np.cumsum(inside[ends] - inside[starts])])
    known = _hashed(FUNCTION_WORDS)
    at = np.minimum(np.searchsorted(known, words), len(known) - 1)
    closed = _CLOSING[data[ends - 1]] if len(ends) else np.zeros(0, bool)
    return [
        np.diff(firsts),
        word_chars[firsts[1:]] - word_chars[firsts[:-1]],
        _per_text(_SYMBOL[data], offsets),
        _per_text(repeated[: len(words)], firsts),
        _per_text(known[at] == words, firsts),
        _per_text(_UPPER[data], offsets),
        _per_text(_LETTER[data], offsets),
        _per_text(closed, firsts),
    ]


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, features) of every row in one pass over the whole texts; null counts as empty."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "n_dup_lines", "n_lines", *[f.split()[0] for f in FEATURES.split(", ")]]
        for batch in batches:
            for part in slices(batch, "text"):
                found = [pa.array(f, pa.int64()) for f in measure(part.column("text"))]
                fixed = [part.column(c) for c in names[:3]]
                yield pa.RecordBatch.from_arrays([*fixed, *found], names)

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    kind = docs.schema[id_col].dataType.simpleString()
    narrow = docs.select(F.col(id_col).alias("id"), text.alias("text"), lines.alias("lines")).select(
        "id", "text", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.size("lines").cast("bigint").alias("n_lines"),
    )
    return narrow.mapInArrow(scan, f"id {kind}, n_dup_lines bigint, n_lines bigint, {FEATURES}")


def _rule(good: Column, bad: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0)


def votes() -> dict[str, Column]:
    """The rules over the features; a text without words is rejected by the rule on length alone."""
    n = F.col("n_words")

    def share(part: str, whole: str = "n_words") -> Column:
        return F.when(F.col(whole) > 0, F.col(part) / F.col(whole))

    length = share("word_chars")
    return {
        "length": _rule(n >= 100, n < 50),
        "word_length": _rule(length.between(3, 9), (length < 2.2) | (length > 12)),
        "symbols": _rule(share("n_symbols") < 0.02, share("n_symbols") > 0.1),
        "lines": _rule((share("n_dup_lines", "n_lines") < 0.05) & (F.col("n_lines") > 1), share("n_dup_lines", "n_lines") > 0.3),
        "repeats": _rule(share("n_repeat_words") < 0.1, share("n_repeat_words") > 0.3),
        "function_words": _rule(share("n_function_words") > 0.08, share("n_function_words") < 0.02),
        "upper": _rule(share("n_upper", "n_letters") < 0.15, share("n_upper", "n_letters") > 0.5),
        "sentences": _rule(share("n_closed").between(0.02, 0.5), share("n_closed") < 0.005),
    }


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = 300) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Posterior of every pattern, each rule's accuracy on good and on bad texts, and the share of good texts.

    A rule is right when it votes keep on a good text or reject on a bad one, and has an accuracy for
    either; abstaining says nothing. The start says that good texts pass nearly every rule and bad texts
    fail about a third, and weighs as twenty and ten votes, so that a rule without votes stays there.
    """
    on_good, on_bad, share = np.full(patterns.shape[1], 0.95), np.full(patterns.shape[1], 0.3), 0.8
    keeps, rejects, weight = (patterns > 0).astype(float), (patterns < 0).astype(float), counts.astype(float)
    posterior = np.full(len(patterns), share)
    for _ in range(rounds):
        log_odds = np.log(share / (1 - share)) + keeps @ np.log(on_good / (1 - on_bad)) + rejects @ np.log((1 - on_good) / on_bad)
        posterior = 1 / (1 + np.exp(-np.clip(log_odds, -60, 60)))
        good, bad = posterior * weight, (1 - posterior) * weight
        on_good = np.clip((good @ keeps + 19) / (good @ (keeps + rejects) + 20), 0.5, 0.999)
        on_bad = np.clip((bad @ rejects + 3) / (bad @ (keeps + rejects) + 10), 0.02, 0.98)
        share = float(np.clip((good.sum() + 1) / (weight.sum() + 2), 0.05, 0.95))
    return posterior, on_good, on_bad, share


def weak_supervision(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = 0.5) -> DataFrame:
    """Counts, votes, ``quality`` (posterior probability of being good) and ``kept`` of every row.

    ``base_failed``: fewer than 50 words, or more than half of the words in repeated windows.
    ``kept`` is false where that holds, else whether ``quality`` is at least ``least``. Null and empty
    texts have no words and fail; repeated rows count each; other columns are not read.
    """
    rules = votes()
    measured = features(docs, id_col, text_col)
    voted = materialise(measured.withColumns({f"vote_{k}": v.cast("int") for k, v in rules.items()}), "votes")
    names = [f"vote_{k}" for k in rules]
    table = voted.groupBy(*names).agg(F.count(F.lit(1)).alias("n")).toPandas()
    posterior, *_ = estimate(table[names].to_numpy(dtype=float).reshape(-1, len(names)), table["n"].to_numpy(dtype=float))
    known = table[names].assign(quality=posterior)
    # Three to the number of rules rows at most.
    scored = voted.join(
        F.broadcast(docs.sparkSession.createDataFrame(known, ", ".join(f"{n} int" for n in names) + ", quality double")), names
    )
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return scored.select(
        F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & (F.col("quality") >= least)).alias("kept"), "quality", *names,
    )
