"""Language identification by a convolutional network over bytes.

A text is cut into windows of a fixed number of bytes, which overlap by one byte less than the widest
filter, so that every run of bytes lies in a window. Bytes are embedded; filters of several widths
slide over a window; each filter keeps its largest value; a softmax layer turns these into a
probability for each language. The text gets the mean over its windows, weighted by their bytes.

The network is trained in numpy on a bounded sample of the labelled texts and is a few kilobytes,
which travel to the tasks. All texts are read whole, in one pass without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from corpusflow.llm.textbytes import raw, slices

#: Bytes of a window, of an embedded byte, and the widths of the filters with their number.
WINDOW, DIMS = 256, 8
FILTERS = ((2, 12), (3, 16), (4, 20))
WIDEST = max(width for width, _ in FILTERS)
STRIDE = WINDOW - WIDEST + 1
#: Windows that go through the network at once: about 25 MB of temporaries.
BATCH = 256
FOLDS, HELD_OUT = 4, 2
UNKNOWN = "und"
MAX_LANGUAGES = 4096
#: Groups of a language's rows from which its sample is drawn.
SALTS = 64


@dataclass
class Network:
    """Parameters; ``filters`` holds all widths as one matrix over WIDEST bytes, zero beyond a filter's width."""

    languages: list[str]
    embedding: np.ndarray
    filters: np.ndarray
    filter_bias: np.ndarray
    weights: np.ndarray
    bias: np.ndarray

    def parameters(self) -> list[np.ndarray]:
        return [self.embedding, self.filters, self.filter_bias, self.weights, self.bias]


def in_width() -> np.ndarray:
    """1 where a filter has a weight, 0 beyond its width."""
    columns = [np.repeat((np.arange(WIDEST) < width)[:, None], DIMS, 1).reshape(-1, 1).repeat(n, 1) for width, n in FILTERS]
    return np.concatenate(columns, axis=1).astype(np.float32)


def fresh(languages: list[str], seed: int) -> Network:
    draw = np.random.default_rng(seed)
    count = sum(n for _, n in FILTERS)
    normal = lambda *shape, scale: (draw.standard_normal(shape) * scale).astype(np.float32)
    mask = in_width()
    return Network(
        languages, normal(256, DIMS, scale=0.5), normal(WIDEST * DIMS, count, scale=1) * mask / np.sqrt(mask.sum(0)),
        np.zeros(count, np.float32), normal(count, len(languages), scale=0.1), np.zeros(len(languages), np.float32),
    )


def pooled(net: Network, windows: np.ndarray, places: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
    """Largest value of every filter in every window, and where it begins if ``places`` are wanted."""
    embedded = net.embedding[windows]
    runs = np.lib.stride_tricks.sliding_window_view(embedded.reshape(len(windows), -1), WIDEST * DIMS, axis=1)[:, ::DIMS]
    values = (runs.reshape(-1, WIDEST * DIMS) @ net.filters).reshape(len(windows), STRIDE, -1)
    if not places:
        return values.max(axis=1), None
    at = values.argmax(axis=1)
    return np.take_along_axis(values, at[:, None], axis=1)[:, 0], at


def softmax(logits: np.ndarray) -> np.ndarray:
    spread = np.exp(logits - logits.max(axis=1, keepdims=True))
    return spread / spread.sum(axis=1, keepdims=True)


def probabilities(net: Network, windows: np.ndarray) -> np.ndarray:
    """Probability of every language for every window."""
    out = np.empty((len(windows), len(net.languages)))
    for k in range(0, len(windows), BATCH):
        top, _ = pooled(net, windows[k : k + BATCH])
        out[k : k + BATCH] = softmax(np.maximum(top + net.filter_bias, 0) @ net.weights + net.bias)
    return out


def gradients(net: Network, windows: np.ndarray, target: np.ndarray) -> list[np.ndarray]:
    """Gradients of the cross-entropy by the parameters. Only the largest value of a filter has one."""
    top, at = pooled(net, windows, places=True)
    hidden = np.maximum(top + net.filter_bias, 0)
    error = softmax(hidden @ net.weights + net.bias)
    error[np.arange(len(target)), target] -= 1
    error /= len(target)
    back = (error @ net.weights.T) * (hidden > 0)
    # Bytes under each filter where it was largest: window x filter x WIDEST.
    under = np.take_along_axis(windows[:, None, :], at[:, :, None] + np.arange(WIDEST), axis=2)
    inputs = net.embedding[under].reshape(*under.shape[:2], -1)
    filters = np.einsum("bf,bfi->if", back, inputs) * in_width()
    through = back[:, :, None] * net.filters.T[None]
    embedding = np.zeros_like(net.embedding)
    np.add.at(embedding, under.reshape(-1), through.reshape(-1, DIMS))
    return [embedding, filters, back.sum(axis=0), hidden.T @ error, error.sum(axis=0)]


def train(windows: np.ndarray, target: np.ndarray, languages: list[str], rounds: int, seed: int = 7, rate: float = 0.01) -> Network:
    """Adam over shuffled batches; the rate falls to a tenth over the rounds. Languages weigh the same by drawing them alike."""
    net = fresh(languages, seed)
    draw = np.random.default_rng(seed)
    members = [np.flatnonzero(target == k) for k in range(len(languages))]
    first = [np.zeros_like(p) for p in net.parameters()]
    second = [np.zeros_like(p) for p in net.parameters()]
    per = max(1, 64 // len(languages))
    steps = rounds * max(1, len(target) // (per * len(languages)))
    for t in range(1, steps + 1):
        chosen = np.concatenate([draw.choice(m, per) for m in members])
        pace = rate * (1 - 0.9 * t / steps)
        for p, g, m, v in zip(net.parameters(), gradients(net, windows[chosen], target[chosen]), first, second):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= (pace * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)).astype(np.float32)
    return net


def cut(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of all texts, the text of each and its number of bytes; a text has one window at least, padded by zeros."""
    sizes = np.diff(offsets)
    counts = np.maximum(1, -(-(sizes - (WIDEST - 1)) // STRIDE))
    owner = np.repeat(np.arange(len(sizes)), counts)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    starts = offsets[:-1][owner] + number * STRIDE
    held = np.minimum(offsets[1:][owner] - starts, WINDOW)
    at = starts[:, None] + np.arange(WINDOW)
    windows = data[np.minimum(at, max(len(data) - 1, 0))] if len(data) else np.zeros(at.shape, np.uint8)
    windows[np.arange(WINDOW) >= held[:, None]] = 0
    return windows, owner, held


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text leaves HELD_OUT modulo FOLDS; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == HELD_OUT, F.lit(False))


def sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str, max_rows: int, max_windows: int) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Windows, language numbers and languages of the training rows.

    At most ``max_rows`` texts of each language, those with the smallest hash of their id, and at most
    ``max_windows`` evenly placed windows of each. Rows with a held-out or null id are left out.
    """
    rows = docs.where(F.col(id_col).isNotNull() & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & ~held_out(F.col(id_col)))
    narrow = rows.select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"))
    languages = narrow.select("lang").distinct().limit(MAX_LANGUAGES + 1).collect()
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    rank = lambda *by: F.row_number().over(Window.partitionBy("lang", *by).orderBy(F.xxhash64("id"), "id"))
    # The rows of a language meet in SALTS groups first, so that few of them meet in one task.
    salted = narrow.withColumn("_salt", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(SALTS)))
    thinned = salted.withColumn("_rank", rank("_salt")).where(F.col("_rank") <= max_rows)
    # max_rows short rows of each of at most MAX_LANGUAGES languages.
    chosen = F.broadcast(thinned.withColumn("_rank", rank()).where(F.col("_rank") <= max_rows).select("id", "lang").distinct())

    def windows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                windows, owner, _ = cut(*raw(part.column("text")))
                number = np.arange(len(owner)) - np.searchsorted(owner, owner)
                total = np.bincount(owner)[owner]
                # The k-th of max_windows lies at k / max_windows of the text.
                kept = np.flatnonzero((number * max_windows // total) != ((number - 1) * max_windows // total))
                rows = part.select(["lang", "place"]).take(pa.array(owner[kept]))
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, pa.array(number[kept]), pa.array([w.tobytes() for w in windows[kept]], pa.binary())],
                    ["lang", "place", "number", "window"],
                )

    texts = rows.select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    got = texts.join(chosen, ["id", "lang"]).select("lang", F.xxhash64("id").alias("place"), "text").mapInArrow(
        windows_of, "lang string, place bigint, number bigint, window binary"
    ).toArrow().sort_by([(c, "ascending") for c in ("lang", "place", "number", "window")])
    langs = got.column("lang").to_pylist()
    known = sorted(set(langs))
    number = {lang: k for k, lang in enumerate(known)}
    windows = np.frombuffer(b"".join(got.column("window").to_pylist()), np.uint8).reshape(-1, WINDOW)
    return windows, np.array([number[x] for x in langs], dtype=np.int64), known


def learn(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", max_rows: int = 400,
    max_windows: int = 4, rounds: int = 4,
) -> Network | None:
    """The network of a bounded sample: ``max_rows`` texts of a language, ``max_windows`` windows of each; None without rows."""
    windows, target, languages = sample(docs, id_col, text_col, lang_col, max_rows, max_windows)
    return train(windows, target, languages, rounds) if languages else None


def identify(
    docs: DataFrame, net: Network | None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, lang_pred, score) of every row; ``und`` with score 0 for texts that are null or have no letter, or without a network."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                windows, owner, held = cut(*raw(part.column("text")))
                share = np.maximum(held, 1)
                sums = np.zeros((part.num_rows, len(net.languages)))
                np.add.at(sums, owner, probabilities(net, windows) * share[:, None])
                sums /= np.bincount(owner, weights=share)[:, None]
                best = sums.argmax(axis=1)
                lettered = part.column("lettered").to_numpy(zero_copy_only=False)
                names = [net.languages[k] if ok else UNKNOWN for k, ok in zip(best.tolist(), lettered.tolist())]
                score = np.where(lettered, np.clip(sums.max(axis=1), 0, 1), 0.0)
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(names, pa.string()), pa.array(score)], ["id", "lang_pred", "score"])

    text = F.col(text_col).cast("string")
    narrow = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.coalesce(text.rlike(r"\p{L}"), F.lit(False)).alias("lettered"))
    if net is None:
        return narrow.select("id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    id_type = narrow.schema["id"].dataType.simpleString()
    return narrow.mapInArrow(scan, f"id {id_type}, lang_pred string, score double")


def language_id(docs: DataFrame, max_rows: int = 400, max_windows: int = 4) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row of (doc_id, text, lang); other columns are not read.

    The network learns from rows with a text, a language and an id whose crc32 as text leaves another
    remainder than HELD_OUT modulo FOLDS. A text with a letter gets one of the learnt languages and the
    mean probability of it over its windows; null texts and texts without a letter get ``und`` and 0, as does
    every text where nothing could be learnt. A null id is not held out and not learnt from.
    Repeated rows are scored as they are. An empty table gives an empty result.
    """
    net = learn(docs, max_rows=max_rows, max_windows=max_windows)
    return identify(docs, net).select(
        F.col("id").alias("doc_id"), held_out(F.col("id")).alias("held_out"), "lang_pred", "score"
    )
