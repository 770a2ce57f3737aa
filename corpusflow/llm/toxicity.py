"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

An n-gram of UTF-8 bytes counts once per text. Its naive Bayes log-count ratio says how much likelier
it is in toxic texts; a logistic regression then learns one weight per n-gram on features that are
scaled by these ratios, so that n-grams which say nothing stay near zero. The n-grams are hashed
into a fixed number of slots, so the model has a fixed size whatever the corpus holds.

The classifier is fitted on a bounded sample of the labelled rows (``max_rows`` of each class, those
with the smallest hash); the model, a few hundred kilobytes, is what travels to the tasks. All
texts are scored whole, in one pass without a shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from corpusflow.llm.textbytes import mix, raw, slices
from corpusflow.session import materialise

#: Lengths of the n-grams in bytes.
ORDERS = (3, 4, 5)
SLOT_BITS = 18
FOLDS = 5


@dataclass(frozen=True)
class Model:
    """Score = sigmoid(bias + sum of the weights of the distinct n-gram slots of a text)."""

    weights: np.ndarray
    bias: float


def grams(data: np.ndarray) -> np.ndarray:
    """Slot of every n-gram of a text given as lower-cased bytes, framed by spaces; with repeats."""
    framed = np.full(len(data) + 2, 0x20, dtype=np.uint64)
    framed[1:-1] = data
    found = []
    for order in ORDERS:
        size = len(framed) - order + 1
        if size <= 0:
            continue
        packed = np.zeros(size, dtype=np.uint64)
        for k in range(order):
            packed = packed << np.uint64(8) | framed[k : k + size]
        found.append((mix(packed + np.uint64(order << 48)) >> np.uint64(64 - SLOT_BITS)).astype(np.int32))
    return np.concatenate(found) if found else np.zeros(0, np.int32)


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_LOWER[[0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = 0x20


def per_text(column: pa.Array) -> Iterator[np.ndarray]:
    """Lower-cased bytes of each text."""
    data, offsets = raw(column)
    data = _LOWER[data]
    for start, end in zip(offsets[:-1], offsets[1:]):
        yield data[start:end]


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            sets = [np.unique(grams(t)) for t in per_text(part.column("text"))]
            digests = pa.array([hashlib.sha256(s.tobytes()).digest() for s in sets], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), part.column("label"), digests, pa.array(sets, pa.list_(pa.int32()))], ["id", "label", "digest", "slots"]
            )


_SETS = "id string, label int, digest binary, slots array<int>"


def _only(wanted: np.ndarray):
    """Rows with those of their slots that are wanted."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slots = batch.column("slots")
            kept = [s[wanted[s]] for s in (x.values.to_numpy() for x in slots)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(kept, pa.list_(pa.int32()))], batch.schema.names)

    return scan


def _order(rows: pa.Table) -> pa.Array:
    """Places of the rows by id, label and the digest of all their slots."""
    return pc.sort_indices(rows.drop_columns(["slots"]), sort_keys=[(c, "ascending") for c in ("id", "label", "digest")])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "label",
        max_rows: int = 2500, least_z: float = 4.0, strength: float = 30.0, rounds: int = 100, prior: float = 0.25) -> Model:
    """Fit on at most ``max_rows`` label rows of each class, those with the smallest hash of their id.

    ``least_z`` is how significant the difference of an n-gram's shares in the two classes must be for
    a weight, ``strength`` the penalty on the squared weights, ``prior`` the share of toxic texts that
    the score assumes. Labels other than 0 and 1 are left out. With one class only every text gets the
    share of toxic labels, and the prior without any label.
    """
    rows = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).where("label in (0, 1)")
    sample = [rows.where(F.col("label") == k).orderBy(F.xxhash64("id"), "id").limit(max_rows) for k in (0, 1)]
    # Two times max_rows rows of two numbers at most.
    chosen = F.broadcast(sample[0].union(sample[1]))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    sets = texts.join(chosen, "id").select(F.col("id").cast("string"), "label", "text").mapInArrow(_features, _SETS)
    sets = materialise(sets, "features")
    by_label = {r.label: r.n for r in sets.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    size = 1 << SLOT_BITS
    toxic, clean = float(by_label.get(1, 0)), float(by_label.get(0, 0))
    if not toxic or not clean:
        n = toxic + clean
        share = toxic / n if n else prior
        return Model(np.zeros(size, np.float32), float(np.log((share + 1e-3) / (1 - share + 1e-3))))
    # The slots are counted by Spark; a row for each slot at most comes here, and then the slots with a ratio alone.
    counted = sets.select("label", F.explode("slots").alias("slot")).groupBy("slot").agg(
        F.sum("label").alias("ones"), F.count(F.lit(1)).alias("all")
    ).toArrow()
    ones, every = np.zeros(size, np.int64), np.zeros(size, np.int64)
    ones[counted.column("slot").to_numpy()] = counted.column("ones").to_numpy()
    every[counted.column("slot").to_numpy()] = counted.column("all").to_numpy()
    zeros = every - ones
    in_toxic, in_clean = (ones + 1) / (toxic + 2), (zeros + 1) / (clean + 2)
    both = (ones + zeros + 2) / (toxic + clean + 4)
    z = (in_toxic - in_clean) / np.sqrt(both * (1 - both) * (1 / toxic + 1 / clean) + 1e-12)
    ratio = np.where((ones + zeros >= 3) & (np.abs(z) > least_z), np.log(in_toxic / in_clean), 0.0)
    got = sets.mapInArrow(_only(ratio != 0.0), _SETS).toArrow()
    # One order, whatever the partitions, so that sums of floats and with them the scores are the same.
    got = got.take(_order(got))
    labels = got.column("label").to_numpy().astype(np.float64)
    slots = got.column("slots").combine_chunks()
    cells, ends = slots.flatten().to_numpy(), slots.offsets.to_numpy()
    owner = np.repeat(np.arange(len(labels), dtype=np.int32), np.diff(ends))
    weights, bias = _logistic(cells, ratio[cells], owner, labels, size, strength, rounds)
    return Model((weights * ratio).astype(np.float32), bias + float(np.log(prior / (1 - prior))))


def _logistic(cells, values, owner, labels, size, strength, rounds) -> tuple[np.ndarray, float]:
    """Penalised logistic regression by gradient steps with per-weight step sizes; classes weigh the same."""
    n = len(labels)
    toxic = labels.sum()
    balance = np.where(labels == 1, 0.5 / toxic, 0.5 / (n - toxic))
    weights, bias = np.zeros(size), 0.0
    first, second = np.zeros(size + 1), np.zeros(size + 1)
    for t in range(1, rounds + 1):
        margin = np.bincount(owner, weights=weights[cells] * values, minlength=n) + bias
        error = (1 / (1 + np.exp(-np.clip(margin, -40, 40))) - labels) * balance
        gradient = np.empty(size + 1)
        gradient[:size] = np.bincount(cells, weights=values * error[owner], minlength=size) + strength * 1e-4 * weights
        gradient[size] = error.sum()
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        step = 0.02 * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.99**t)) + 1e-7)
        weights -= step[:size]
        bias -= step[size]
    return weights, float(bias)


def margins(model: Model, column: pa.Array, scratch: np.ndarray) -> list[float]:
    """bias + weights of the distinct slots, for each text."""
    out = []
    for text in per_text(column):
        slots = grams(text)
        numbers = np.arange(len(slots), dtype=np.int32)
        scratch[slots] = numbers
        once = slots[scratch[slots] == numbers]
        out.append(model.bias + float(model.weights[once].sum(dtype=np.float64)))
    return out


def scored(docs: DataFrame, model: Model, text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the score in the column ``out``; null and empty texts get that of a text without n-grams."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scratch = np.zeros(1 << SLOT_BITS, dtype=np.int32)
        for batch in batches:
            for part in slices(batch, text_col):
                margin = np.clip(margins(model, part.column(text_col), scratch), -40, 40)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(1 / (1 + np.exp(-margin)))], [*part.schema.names, out])

    kept = docs.drop(out)
    return kept.mapInArrow(scan, T.StructType([*kept.schema.fields, T.StructField(out, T.DoubleType())]))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every row."""
    narrow = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("_text"))
    return scored(narrow, model, "_text").select(id_col, "score")


def learn(docs: DataFrame, labels: DataFrame, max_rows: int = 2500) -> Model:
    """The model of the labels whose crc32(doc_id as text) mod 5 is not 0."""
    known = labels.select("doc_id", F.col("toxic").alias("label")).where(~held_out(F.col("doc_id")))
    return fit(docs, known, max_rows=max_rows)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(False))


def toxicity(docs: DataFrame, labels: DataFrame, max_rows: int = 2500) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document.

    Labels are learnt only from documents whose crc32(doc_id as text) mod 5 is not 0; the label rows
    of one document are joined as they are, so a repeated label counts again. ``held_out`` is false for a
    null id.
    """
    return score(docs, learn(docs, labels, max_rows)).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
