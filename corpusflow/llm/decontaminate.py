"""Benchmark decontamination by CGK embeddings.

The CGK random walk reads a word sequence and writes one word per step; whether it moves on to the
next word is a random bit of the step and the word read. Sequences a small edit distance apart give walks
that agree in most steps, so edit distance becomes Hamming distance. Walks start at every word of every text
and of every benchmark item, so that an item has many windows to meet a text in, and are compared through a sample of their
steps: equal words at all steps of the sample make a candidate. Each table has random bits and a sample of its own. How many tables
reach the recall is measured on edited copies of the items before texts are read. A candidate is verified by the
exact word edit distance between the whole item and the words around the place where it has to be.

Items of fewer than ``STEPS`` words are too short to sample. They are cut into one run of words more than they may have edits,
one of which stands unchanged in every text that holds the item.

The benchmark travels to the tasks in blocks of bounded bytes, each a pass over the texts; there is no
shuffle of texts.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from corpusflow.llm.textbytes import mix, raw, shingle_hashes, slices, word_hashes, word_spans

#: Steps of a walk, of which a table samples one of each part.
STEPS, SAMPLE = 12, 4
#: Tables are added until the recall is reached, this many at most.
MOST_TABLES = 48
#: Items whose edited copies are tried, of a block and a range of lengths, and copies of each.
TRIED, COPIES = 500, 4
#: Ranges of lengths that have to reach the recall each, by their least number of words.
LENGTHS = (STEPS, 20, 40, 80)
#: Bits of the lookups of keys.
LOOKUP_BITS = 20
SLICE = 1 << 19
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
# Punctuation of ASCII separates words.
_LOWER[[c for c in range(0x80) if not (chr(c).isalnum())]] = 0x20


def words_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words of all texts, and the number of the text of each."""
    data, offsets = raw(pc.utf8_lower(pc.fill_null(column, "")))
    data = _LOWER[data]
    starts, ends, owner = word_spans(data, offsets)
    return word_hashes(data, starts, ends), owner


def padded(words: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The words with STEPS zeros after every text, and the place of each word."""
    places = np.arange(len(words)) + owner * STEPS
    out = np.zeros(len(words) + n * STEPS, dtype=np.uint64)
    out[places] = words
    return out, places


def sampled(table: int) -> list[int]:
    """The steps that a table looks at: one of each of ``SAMPLE`` equal parts of the walk."""
    part = STEPS // SAMPLE
    draw = random.Random(table)
    return [part * k + draw.randrange(part) for k in range(SAMPLE)]


def walk_keys(padded_words: np.ndarray, places: np.ndarray, table: int) -> tuple[np.ndarray, np.ndarray]:
    """Key of the walk from every place, and whether its last sampled step still read a word."""
    steps = sampled(table)
    bits = mix(padded_words ^ mix(np.array([table + 1], dtype=np.uint64)))
    at = places.astype(np.int64)
    key = np.zeros(len(at), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for step in range(steps[-1] + 1):
            if step in steps:
                key = key * np.uint64(0x9E3779B97F4A7C15) + padded_words[at]
            if step == steps[-1]:
                return mix(key), padded_words[at] != 0
            at += ((bits[at] >> np.uint64(step)) & np.uint64(1)).astype(np.int64)
    raise AssertionError("a table samples a step at least")


def allowed(lengths: np.ndarray, similarity: float) -> np.ndarray:
    """Most edits of items with these numbers of words."""
    return np.minimum(np.floor((1 - similarity) * lengths + 1e-9).astype(np.int64), np.maximum(lengths - 1, 0))


def edited(words: np.ndarray, edits: int, draw: random.Random) -> np.ndarray:
    """The words with so many of them changed, taken out or preceded by another one, at random places."""
    out = words.tolist()
    for _ in range(edits):
        at, kind = draw.randrange(len(out)), draw.randrange(3)
        other = draw.getrandbits(63) | 1
        out[at : at + 1] = [[other], [], [other, out[at]]][kind]
    return np.array(out, dtype=np.uint64)


def tables_needed(texts: list[str], similarity: float, recall: float) -> int:
    """Least number of tables with which this share of edited copies is met, in each range of lengths, with all edits that are allowed."""
    words, owner = words_of(pa.array(texts, pa.string()))
    lengths = np.bincount(owner, minlength=len(texts)) if len(texts) else np.zeros(0, int)
    begins = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    draw, tried, copies, copied = random.Random(11), [], [], []
    for least, below in zip(LENGTHS, (*LENGTHS[1:], np.inf)):
        fitting = np.flatnonzero((lengths >= least) & (lengths < below)).tolist()
        for item in draw.sample(fitting, min(TRIED, len(fitting))):
            edits = int(allowed(lengths[item : item + 1], similarity)[0])
            tried.append(item)
            copies += [edited(words[begins[item] : begins[item + 1]], edits, draw) for _ in range(COPIES)]
            copied += [least] * COPIES
    if not tried:
        return 0
    of = np.repeat(np.arange(len(tried)), COPIES)

    def walks(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        belongs = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        return (*padded(np.concatenate(parts), belongs, len(parts)), belongs)

    known = walks([words[begins[i] : begins[i + 1]] for i in tried])
    new = walks(copies)
    met, ranges = np.zeros(len(copies), dtype=bool), np.array(copied)
    for table in range(MOST_TABLES):
        (key, inside), (other, whole) = walk_keys(*known[:2], table), walk_keys(*new[:2], table)
        # A copy is met if it shares a key with its own item.
        mark = mix(key ^ mix(known[2].astype(np.uint64)))[inside]
        seen = np.isin(mix(other ^ mix(of[new[2]].astype(np.uint64))), mark) & whole
        met[np.unique(new[2][seen])] = True
        if all(met[ranges == r].mean() >= recall for r in set(copied)):
            return table + 1
    return MOST_TABLES


class Block:
    """The walks of some benchmark items, ready for lookup."""

    def __init__(self, ids: list[int], texts: list[str], similarity: float, tables: int):
        words, owner = words_of(pa.array(texts, pa.string()))
        lengths = np.bincount(owner, minlength=len(ids)) if len(ids) else np.zeros(0, int)
        self.ids, self.lengths, self.similarity = np.array(ids, dtype=np.int64), lengths, similarity
        self.begins = np.concatenate([[0], np.cumsum(lengths)])
        self.words = words
        spread, places = padded(words, owner, len(ids))
        within = np.arange(len(words)) - self.begins[owner]
        self.index = []
        for table in range(tables):
            key, inside = walk_keys(spread, places, table)
            which = np.flatnonzero(inside & (lengths[owner] >= STEPS))
            order = which[np.argsort(key[which], kind="stable")]
            lookup = np.zeros(1 << LOOKUP_BITS, dtype=bool)
            lookup[(key[order] >> np.uint64(64 - LOOKUP_BITS)).astype(np.int64)] = True
            self.index.append((lookup, key[order], owner[order], within[order]))
        self.runs = self._runs()

    def _runs(self) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """By number of words: lookup, and sorted hashes, items and places in the item of the runs that short items are cut into."""
        items = np.flatnonzero((self.lengths > 0) & (self.lengths < STEPS))
        parts = allowed(self.lengths[items], self.similarity) + 1
        item = np.repeat(items, parts)
        number = np.arange(len(item)) - np.repeat(np.cumsum(parts) - parts, parts)
        length, of = self.lengths[item], np.repeat(parts, parts)
        begin, end = number * length // of, (number + 1) * length // of
        out = {}
        for width in np.unique(end - begin).tolist():
            which = np.flatnonzero(end - begin == width)
            key = mix(shingle_hashes(self.words, width)[self.begins[item[which]] + begin[which]])
            order = np.argsort(key, kind="stable")
            lookup = np.zeros(1 << LOOKUP_BITS, dtype=bool)
            lookup[(key >> np.uint64(64 - LOOKUP_BITS)).astype(np.int64)] = True
            out[width] = lookup, key[order], item[which][order], begin[which][order]
        return out

    def _met(self, key: np.ndarray, where: np.ndarray, owner: np.ndarray, index: tuple) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, first word that may belong to the item, item) of the places whose key the index holds."""
        lookup, known, items, begins = index
        hit = np.flatnonzero(where & lookup[(key >> np.uint64(64 - LOOKUP_BITS)).astype(np.int64)])
        low, high = np.searchsorted(known, key[hit], "left"), np.searchsorted(known, key[hit], "right")
        times = high - low
        at = np.repeat(low, times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        start, item = np.repeat(hit, times), items[at]
        return owner[start], start - begins[at] - allowed(self.lengths[item], self.similarity), item

    def candidates(self, words: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct (text, first word that may belong to the item, item) of all walks that meet, and of runs of short items."""
        found = []
        spread, places = padded(words, owner, n)
        for table, index in enumerate(self.index):
            if len(index[1]):
                found.append(self._met(*walk_keys(spread, places, table), owner, index))
        for width, index in self.runs.items():
            if len(words) >= width:
                key = mix(shingle_hashes(words, width)[: len(words) - width + 1])
                found.append(self._met(key, owner[: len(key)] == owner[width - 1 :], owner, index))
        if not found:
            return (np.zeros(0, np.int64),) * 3
        text, start, item = (np.concatenate(part) for part in zip(*found))
        order = np.lexsort((item, start, text))
        text, start, item = text[order], start[order], item[order]
        fresh = np.ones(len(text), dtype=bool)
        fresh[1:] = (text[1:] != text[:-1]) | (start[1:] != start[:-1]) | (item[1:] != item[:-1])
        return text[fresh], start[fresh], item[fresh]

    def distances(self, words: np.ndarray, owner: np.ndarray, text: np.ndarray, start: np.ndarray, item: np.ndarray) -> np.ndarray:
        """Least word edit distance between the item and a run of the text's words not before the start."""
        out = np.zeros(len(start), dtype=np.int64)
        first, stop = np.searchsorted(owner, text, side="left"), np.searchsorted(owner, text, side="right")
        for length in np.unique(self.lengths[item]).tolist():
            which = np.flatnonzero(self.lengths[item] == length)
            reach = length + 3 * int(allowed(np.array([length]), self.similarity)[0])
            columns = np.arange(reach + 1)
            most = max(1, (1 << 20) // (reach + 1))
            for k in range(0, len(which), most):
                some = which[k : k + most]
                at = start[some][:, None] + np.arange(reach)
                inside = (at >= first[some][:, None]) & (at < stop[some][:, None])
                window = np.where(inside, words[np.clip(at, 0, len(words) - 1)], np.uint64(0))
                row = np.zeros((len(some), reach + 1), dtype=np.int32)
                for i in range(length):
                    word = self.words[self.begins[item[some]] + i][:, None]
                    new = np.empty_like(row)
                    new[:, 0] = i + 1
                    new[:, 1:] = np.minimum(row[:, 1:] + 1, row[:, :-1] + (window != word))
                    row = np.minimum.accumulate(new - columns, axis=1) + columns
                out[some] = row.min(axis=1)
        return out

    def search(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(number of the text, item id, similarity) of every verified window."""
        words, owner = words_of(column)
        text, start, item = self.candidates(words, owner, len(column))
        apart = self.distances(words, owner, text, start, item)
        near = 1 - apart / np.maximum(self.lengths[item], 1)
        kept = near >= self.similarity - 1e-12
        return text[kept], self.ids[item[kept]], near[kept]


def blocks(benchmark: DataFrame, limit: int) -> Iterator[tuple[list[int], list[str]]]:
    """Items in blocks of about ``limit`` characters; the driver holds one block at a time."""
    ids, texts, size = [], [], 0
    for row in benchmark.where("item_id is not null").select("item_id", F.col("text").cast("string")).toLocalIterator():
        if ids and size + len(row[1] or "") > limit:
            yield ids, texts
            ids, texts, size = [], [], 0
        ids.append(row[0])
        texts.append(row[1] or "")
        size += len(row[1] or "")
    if ids:
        yield ids, texts


def _pass(docs: DataFrame, ids: list[int], texts: list[str], similarity: float, tables: int) -> DataFrame:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = Block(ids, texts, similarity, tables)
        for batch in batches:
            for part in slices(batch, "_text", SLICE):
                items = [dict(zip(i or (), s)) for i, s in zip(part.column("_items").to_pylist(), part.column("_near").to_pylist())]
                for text, item, near in zip(*[a.tolist() for a in block.search(part.column("_text"))]):
                    items[text][item] = max(near, items[text].get(item, 0.0))
                ordered = [sorted(found.items()) for found in items]
                arrays = [pa.array([[i for i, _ in f] for f in ordered], pa.list_(pa.int64())), pa.array([[s for _, s in f] for f in ordered], pa.list_(pa.float64()))]
                kept = [part.column(c) for c in part.schema.names[:-2]]
                yield pa.RecordBatch.from_arrays([*kept, *arrays], part.schema.names)

    return docs.mapInArrow(scan, docs.schema)


def contamination(docs: DataFrame, benchmark: DataFrame, columns: list[str] | None = None, text_col: str = "text",
                  similarity: float = 0.8, recall: float = 0.99, block_chars: int = 8_000_000) -> DataFrame:
    """``columns`` of every row with ``contaminated``, ``item_ids`` and ``similarities``.

    An item is found in a text if the edit distance in words between the item and some run of the text's
    words is at most (1 - similarity) times the item's words. Words are lower-cased; ASCII punctuation
    separates them. Items and texts without words, and null ones, match nothing. A repeated item id
    is reported once, with the best similarity. An item with as many
    edits as the similarity allows is found with a chance of ``recall`` or more, an unchanged one and one of fewer than ``STEPS`` words always. Rows keep their number; an empty benchmark finds nothing.
    """
    columns = ["doc_id"] if columns is None else columns
    found = docs.select(
        *[F.col(c).alias(f"_c{i}") for i, c in enumerate(columns) if c != text_col], F.col(text_col).cast("string").alias("_text"),
        F.array().cast("array<bigint>").alias("_items"), F.array().cast("array<double>").alias("_near"),
    )
    for ids, texts in blocks(benchmark, block_chars):
        found = _pass(found, ids, texts, similarity, tables_needed(texts, similarity, recall))
    return found.select(
        *[F.col("_text" if c == text_col else f"_c{i}").alias(c) for i, c in enumerate(columns)], (F.size("_items") > 0).alias("contaminated"),
        F.col("_items").alias("item_ids"), F.col("_near").alias("similarities"),
    )
