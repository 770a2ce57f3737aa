"""Substring deduplication by paragraphs: MinHash bands, exact Jaccard similarity, components.

A paragraph is a line of the text. Its MinHash signature over five-word shingles is cut into bands;
paragraphs that are equal in one band collide. A set of shingles is also drawn as a bitmap in which every shingle
flips one bit: two bitmaps differ in no more bits than the sets differ in shingles, so that pairs which differ
too much are left out while they are joined, without losing any that reaches the threshold. The others are
verified by the Jaccard similarity of their shingle sets. The number of bands follows from the recall asked for at the threshold. Of each
connected group the first paragraph stays.

Passages inside paragraphs that are otherwise different are found by MinHash as well: a window of as many words as a passage
has at least is a set of shingles, and its minimum under one hash is a sliding minimum over the paragraph. Equal windows have
equal minima, so that only windows of minima that two documents hold are compared, by a hash of all their words.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from corpusflow.llm.linking import linked_classes, shared_members
from corpusflow.llm.lines import _passing, cut_places, document_rows, repeated_places
from corpusflow.llm.suffixes import sliding
from corpusflow.llm.textbytes import mix, prefix_hashes, raw, shingle_hashes, slices, span_hashes, word_hashes, word_spans
from corpusflow.session import materialise

WIDTH = 5
ROWS = 4
#: Longs of a paragraph's bitmap.
BITMAP = 4
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_SPACES = " \t\n\v\f\r"
_WORD = re.compile(f"[^{_SPACES}]+")


def band_count(similarity: float, recall: float, rows: int = ROWS) -> int:
    """Bands of ``rows`` minima each that catch a pair of this similarity with this probability."""
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - min(similarity, 0.999) ** rows)))


def _paragraphs(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For the paragraphs with words: text, line number, and first word; then the words' starts and ends, and the bytes."""
    data, offsets = raw(column)
    data = _LOWER[data]
    starts, ends, owner = word_spans(data, offsets)
    breaks = np.flatnonzero(data == 0x0A)
    line = np.searchsorted(breaks, starts)
    fresh = np.ones(len(starts), dtype=bool)
    fresh[1:] = (line[1:] != line[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(fresh)
    before = np.searchsorted(breaks, offsets[:-1])
    return owner[first], line[first] - before[owner[first]], first, starts, ends, data


def _shingles(words: np.ndarray, first: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of all paragraphs one after the other, and where each begins; a shorter one is one shingle."""
    full = shingle_hashes(words, WIDTH)
    number = np.maximum(counts - WIDTH + 1, 1)
    begin = np.concatenate([[0], np.cumsum(number)])
    at = np.repeat(first - begin[:-1], number) + np.arange(begin[-1])
    out = full[at]
    for k in np.flatnonzero(counts < WIDTH):
        out[begin[k]] = shingle_hashes(words[first[k] : first[k] + counts[k]], int(counts[k]))[0]
    return out, begin


def _node(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> bytes:
    text = b" ".join(data[starts[0] : ends[-1]].tobytes().split())
    return hashlib.blake2b(text, digest_size=16).digest()


def _cut(part: pa.RecordBatch, min_words: int):
    """(text, line, words, node, shingles, begin) of the paragraphs with ``min_words`` words in a slice."""
    text, line, first, starts, ends, data = _paragraphs(part.column("text"))
    counts = np.diff(np.append(first, len(starts)))
    kept = counts >= min_words
    text, line, first, counts = text[kept], line[kept], first[kept], counts[kept]
    shingles, begin = _shingles(word_hashes(data, starts, ends), first, counts)
    nodes = [_node(data, starts[f : f + c], ends[f : f + c]) for f, c in zip(first.tolist(), counts.tolist())]
    return text, line, counts, nodes, shingles, begin


def _bands(shingles: np.ndarray, begin: np.ndarray, bands: int) -> np.ndarray:
    """Band keys, one column per band."""
    out = np.zeros((len(begin) - 1, bands), dtype=np.uint64)
    if not len(out):
        return out
    seeds = mix(np.arange(1, bands * ROWS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    with np.errstate(over="ignore"):
        for b in range(bands):
            for r in range(ROWS):
                least = np.minimum.reduceat(shingles * seeds[b * ROWS + r], begin[:-1])
                out[:, b] = mix(out[:, b] * np.uint64(5) + least)
            out[:, b] += np.uint64(b)
    return out


def _facts(shingles: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Per paragraph the number of different shingles, and the longs of a bitmap in which each of them flips one bit."""
    out = np.zeros((len(begin) - 1, 1 + BITMAP), dtype=np.uint64)
    if not len(out):
        return out
    owner = np.repeat(np.arange(len(out)), np.diff(begin))
    order = np.lexsort((shingles, owner))
    shingles, owner = shingles[order], owner[order]
    fresh = np.ones(len(owner), dtype=bool)
    fresh[1:] = (owner[1:] != owner[:-1]) | (shingles[1:] != shingles[:-1])
    shingles, owner = mix(shingles[fresh]), owner[fresh]
    first = np.searchsorted(owner, np.arange(len(out)))
    out[:, 0] = np.diff(np.append(first, len(owner)))
    place = shingles % np.uint64(64 * BITMAP)
    flip = np.uint64(1) << (place % np.uint64(64))
    for k in range(BITMAP):
        out[:, 1 + k] = np.bitwise_xor.reduceat(np.where(place // np.uint64(64) == k, flip, np.uint64(0)), first)
    return out


def can_reach(similarity: float, a: Column, b: Column) -> Column:
    """Whether two sets of these facts can have this Jaccard similarity: it bounds by how many shingles they differ."""
    differ = F.bit_count(a[1].bitwiseXOR(b[1]))
    for k in range(1, BITMAP):
        differ = differ + F.bit_count(a[1 + k].bitwiseXOR(b[1 + k]))
    apart = F.greatest(differ.cast("bigint"), F.abs(a[0] - b[0]))
    return apart * (1 + similarity) <= (a[0] + b[0]) * (1 - similarity) + 1e-6


def paragraph_groups(rows: DataFrame, similarity: float, recall: float, min_words: int) -> DataFrame:
    """(id, row, pos, words, group) of the paragraphs of ``rows`` (id, row, text)."""
    bands = band_count(similarity, recall)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                text, line, counts, nodes, shingles, begin = _cut(part, min_words)
                keys = _bands(shingles, begin, bands).view(np.int64)
                at = pa.array(text)
                yield pa.RecordBatch.from_arrays([
                    pc.take(part.column("id"), at), pc.take(part.column("row"), at), pa.array(line, pa.int32()), pa.array(counts, pa.int32()),
                    pa.array(nodes, pa.binary()), pa.array(list(keys), pa.list_(pa.int64())),
                    pa.array(list(_facts(shingles, begin).view(np.int64)), pa.list_(pa.int64())),
                ], ["id", "row", "pos", "words", "node", "keys", "fact"])

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                _, _, _, nodes, shingles, begin = _cut(part, min_words)
                found = [np.unique(shingles[s:e].view(np.int64)) for s, e in zip(begin[:-1], begin[1:])]
                yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(found, pa.list_(pa.int64()))], ["node", "shingles"])

    found = materialise(rows.mapInArrow(scan, "id bigint, row bigint, pos int, words int, node binary, keys array<bigint>, fact array<bigint>"), "paragraphs")
    holders = materialise(found.groupBy("node").agg(F.min("id").alias("id")), "nodes")
    # A node's keys follow from its words, so that one row a node is enough; two keys of a node may be equal.
    once = found.select("node", F.array_distinct("keys").alias("keys")).dropDuplicates(["node"])
    members = shared_members(once.select("node", F.explode("keys").alias("bucket")))
    met = members.select("node").distinct()
    facts = materialise(found.select("node", "fact").join(met, "node", "left_semi").dropDuplicates(["node"]), "facts")

    def verify(pairs: DataFrame) -> DataFrame:
        pairs = materialise(pairs, "pairs")
        wanted = materialise(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct(), "wanted")
        held = rows.join(holders.join(wanted, "node", "left_semi").select("id").distinct(), "id", "left_semi")
        texts = held.select("text").mapInArrow(sets, "node binary, shingles array<bigint>")
        texts = materialise(texts.join(wanted, "node", "left_semi").dropDuplicates(["node"]), "shingles")
        both = pairs.join(texts.select(F.col("node").alias("a"), F.col("shingles").alias("sa")), "a").join(
            texts.select(F.col("node").alias("b"), F.col("shingles").alias("sb")), "b"
        )
        # A pair whose sizes differ too much cannot reach the threshold.
        fitting = F.least(F.size("sa"), F.size("sb")) >= similarity * F.greatest(F.size("sa"), F.size("sb")) - 1e-9
        common = F.size(F.array_intersect("sa", "sb"))
        return both.where(fitting).where(common >= similarity * (F.size("sa") + F.size("sb") - common) - 1e-9).select("a", "b")

    classes = linked_classes(members, verify, lambda a, b: can_reach(similarity, a, b), facts)
    return found.join(classes, "node", "left").select("id", "row", "pos", "words", F.coalesce("component", "node").alias("group"))


def _windows(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all windows of ``width`` words that lie inside one paragraph: text, first word in the whole column and in the text,
    and MinHash; then the hashes of all words."""
    owner, _, first, starts, ends, data = _paragraphs(column)
    words, none = word_hashes(data, starts, ends), np.zeros(0, np.int64)
    if len(words) < width:
        return none, none, none, none.astype(np.uint64), words
    least = sliding(shingle_hashes(words, WIDTH)[: len(words) - WIDTH + 1], width - WIDTH + 1, np.minimum)
    counts = np.diff(np.append(first, len(words)))
    left = np.repeat(first + counts, counts) - np.arange(len(words))
    begin = np.flatnonzero(left[: len(least)] >= width)
    of_word = np.repeat(owner, counts)
    text = of_word[begin]
    return text, begin, begin - np.searchsorted(of_word, text), least[begin], words


def _lists(text: np.ndarray, values: np.ndarray, size: int) -> pa.Array:
    """The different values of each text, in order."""
    order = np.lexsort((values, text))
    text, values = text[order], values[order]
    fresh = np.ones(len(text), bool)
    fresh[1:] = (text[1:] != text[:-1]) | (values[1:] != values[:-1])
    text, values = text[fresh], values[fresh]
    ends = np.searchsorted(text, np.arange(size + 1))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int64()))


def _cut_words(text: str, at: list[int], width: int) -> tuple[str, int, int]:
    """The text without the windows of ``width`` words that begin at these words, the number of runs cut and of their words.
    A line that loses all its words goes."""
    gone = {w for a in at for w in range(a, a + width)}
    number, runs, kept = 0, 0, []
    for line in text.split("\n"):
        found = list(_WORD.finditer(line))
        flags = [number + k in gone for k in range(len(found))]
        number += len(found)
        runs += sum(f and not (k and flags[k - 1]) for k, f in enumerate(flags))
        if any(flags) and all(flags):
            continue
        if any(flags):
            # A word goes with the spaces behind it, the last one with those before it.
            ends = [m.start() for m in found[1:]] + [len(line)]
            line = line[: found[0].start()] + "".join(line[m.start() : e] for m, e, f in zip(found, ends, flags) if not f)
            line = line.rstrip(_SPACES) if flags[-1] else line
        kept.append(line)
    return "\n".join(kept), runs, len(gone)


def repeated_passages(rows: DataFrame, removed: DataFrame, width: int) -> DataFrame:
    """(_id, _row, _text, _more, _passed) of the texts of ``rows`` (id, row, text) that hold, in what is left without the lines ``removed``, a window
    of ``width`` words of a paragraph that is left of an earlier text: the text without such windows, the number of runs cut, and of their words."""

    def left(texts: DataFrame) -> DataFrame:
        return cut_places(texts, removed, "id", "text").select("id", "row", "text")

    def met(wanted: DataFrame) -> DataFrame:
        # Few texts pass the filter, and only these are shuffled.
        key = F.xxhash64("id", "row")
        some = _passing(rows, key, wanted, key).where("_maybe").dropDuplicates(["id", "row"])
        return left(some.select("id", "row", "text")).join(wanted, ["id", "row"])

    def minima(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                text, _, _, least, _ = _windows(part.column("text"), width)
                keys = _lists(text, least.view(np.int64), part.num_rows)
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("row"), keys], ["id", "row", "keys"])

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                text, begin, at, least, words = _windows(part.column("text"), width)
                shared = np.isin(least.view(np.int64), pc.list_flatten(part.column("keys")).to_numpy(zero_copy_only=False))
                text, begin, at = text[shared], begin[shared], at[shared]
                window = span_hashes(*prefix_hashes(words), begin, begin + width).view(np.int64)
                of = pa.array(text)
                yield pa.RecordBatch.from_arrays(
                    [pc.take(part.column("id"), of), pc.take(part.column("row"), of), pa.array(window), pa.array(at, pa.int32())], ["id", "row", "window", "at"]
                )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                done = [_cut_words(t, at, width) for t, at in zip(part.column("text").to_pylist(), part.column("at").to_pylist())]
                columns = [pa.array(c, k) for c, k in zip(zip(*done), (pa.string(), pa.int64(), pa.int64()))]
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("row"), *columns], ["_id", "_row", "_text", "_more", "_passed"])

    place = F.struct("id", "row")

    def repeats(members: DataFrame, key: str) -> DataFrame:
        ends = members.groupBy(key).agg(F.min(place).alias("first"), F.max(place).alias("last"))
        return ends.where("first < last").select(key, "first")

    found = materialise(left(rows).mapInArrow(minima, "id bigint, row bigint, keys array<bigint>"), "minima")
    members = found.select("id", "row", F.explode("keys").alias("key"))
    shared = materialise(repeats(members, "key").select("key"), "shared")
    candidates = _passing(members, F.col("key"), shared, F.col("key")).where("_maybe").join(shared, "key", "left_semi")
    candidates = materialise(candidates.groupBy("id", "row").agg(F.collect_set("key").alias("keys")), "candidates")
    windows = materialise(met(candidates).mapInArrow(compared, "id bigint, row bigint, window bigint, at int"), "windows")
    later = windows.join(repeats(windows, "window"), "window").where(place > F.col("first"))
    later = materialise(later.groupBy("id", "row").agg(F.array_sort(F.collect_set("at")).alias("at")), "passages")
    return met(later).mapInArrow(cut, "_id bigint, _row bigint, _text string, _more bigint, _passed bigint")


def dedupe_paragraphs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = 0.8,
                      recall: float = 0.99, min_words: int = 10, passage_words: int | None = None) -> DataFrame:
    """All rows of ``docs`` with repeated paragraphs cut out, and ``n_lines`` and ``n_removed``.

    Of every group of paragraphs with a Jaccard similarity of ``similarity`` or more over five-word shingles,
    directly or over others, the first in (id, text hash, line) order stays. Paragraphs of fewer than ``min_words``
    words stay; shorter than a shingle, the whole paragraph is the shingle. Case is ignored in A-Z. Rows that repeat
    both id and text are one document; null ids come first. A null text stays null, a text that loses all
    paragraphs becomes empty; an empty table stays empty. Other columns are passed on.

    With ``passage_words``, equal runs of that many words and more inside the paragraphs that are left are cut out of all documents
    but the first; ``n_removed`` counts these runs too, and ``n_passage_words`` the words of runs and of
    removed paragraphs of that length that an earlier document holds.
    """
    rows = document_rows(docs, id_col, text_col)
    groups = paragraph_groups(rows, similarity, recall, min_words)
    if passage_words is None:
        return cut_places(docs, repeated_places(groups), id_col, text_col)
    if passage_words < WIDTH:
        raise ValueError(f"passages have {WIDTH} words at least")
    removed = repeated_places(groups, passage_words)
    passages = repeated_passages(rows, removed.select("_id", "_row", "_removed"), passage_words)
    edits = removed.withColumnRenamed("_words", "_long").join(passages, ["_id", "_row"], "full_outer")
    edits = edits.withColumn("_words", F.coalesce("_long", F.lit(0)) + F.coalesce("_passed", F.lit(0))).drop("_long", "_passed")
    return cut_places(docs, materialise(edits, "edits"), id_col, text_col)
