"""Ranked lexical search by branch and bound over trees of documents.

Each document becomes a vector of the terms that the benchmark items use, with their counts. A task puts
its vectors into trees as for frequent patterns: terms in order of falling document frequency, so that
documents with the same common terms share a path. Every branching node knows, for each term below it
or on its path, the largest count, and the smallest length norm of its documents. A score grows with the counts and
falls with the norm, so these bound the scores of all documents below a node. The tree is walked depth
first; a node is entered for the items whose bound reaches their tenth best score so far, and its
documents are scored for these only. Texts are read once, are not shuffled, and what leaves a task are
its best documents of each item.

The benchmark is handled in blocks of bounded size, each of which reads the documents anew.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from corpusflow.llm.textbytes import raw, slices, word_hashes, word_spans
from corpusflow.session import materialise

#: Items of a block and bytes of their texts; an item longer than that is a block of its own.
BLOCK_ITEMS, BLOCK_BYTES = 512, 4 << 20
#: Documents and vector entries of a tree. A tree takes about 100 bytes an entry.
TREE_DOCS, TREE_ENTRIES = 4096, 1 << 20
#: Documents of a leaf: subtrees that are smaller are kept together.
LEAF = 8
#: Groups in which the best of all tasks are thinned out before they meet by item.
SALTS = 64
NO_ID = np.iinfo(np.int64).max

_BETWEEN = np.ones(256, dtype=bool)
_LOWER = np.arange(256, dtype=np.uint8)
for _first, _last in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
    _BETWEEN[_first : _last + 1] = False
_LOWER[0x41:0x5B] += 0x20


def term_spans(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes of all texts, and start, end and text number of every term."""
    data, offsets = raw(column)
    data = _LOWER[data]
    return data, *word_spans(data, offsets, _BETWEEN)


def spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... counts[0] of them, then those of starts[1] and so on."""
    return np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())


@dataclass(frozen=True)
class Items:
    """A block of items: ids, the hashes of their terms in ascending order, and the items of every term."""

    ids: list[int | None]
    hashes: np.ndarray
    first: np.ndarray
    count: np.ndarray
    holders: np.ndarray

    @staticmethod
    def of(ids: list[int | None], texts: list[str | None]) -> Items:
        data, starts, ends, owner = term_spans(pa.array(texts, pa.string()))
        pairs = np.unique(np.stack([word_hashes(data, starts, ends), owner.astype(np.uint64)], axis=1), axis=0)
        hashes, first, count = np.unique(pairs[:, 0], return_index=True, return_counts=True)
        return Items(ids, hashes, first, count, pairs[:, 1].astype(np.int64))


def blocks(items: DataFrame, item_col: str, text_col: str) -> Iterator[Items]:
    """The items in blocks; the driver reads them as a stream."""
    ids, texts, held = [], [], 0
    for row in items.select(F.col(item_col).cast("bigint"), F.col(text_col).cast("string")).toLocalIterator():
        size = len(row[1] or "")
        if ids and (len(ids) == BLOCK_ITEMS or held + size > BLOCK_BYTES):
            yield Items.of(ids, texts)
            ids, texts, held = [], [], 0
        ids.append(row[0])
        texts.append(row[1])
        held += size
    if ids:
        yield Items.of(ids, texts)


def vectors(docs: DataFrame, items: Items, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, n, terms, counts) of the documents with a term: all their terms counted, those of the items listed.

    Terms are told apart by a 64-bit hash of their bytes and are numbered by the order of these.
    """
    hashes = items.hashes

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                data, starts, ends, owner = term_spans(part.column("text"))
                n = np.bincount(owner, minlength=part.num_rows)
                words = word_hashes(data, starts, ends)
                at = np.minimum(np.searchsorted(hashes, words), max(len(hashes) - 1, 0))
                known = hashes[at] == words if len(hashes) else np.zeros(len(words), bool)
                cells, counts = np.unique(owner[known] * np.int64(max(len(hashes), 1)) + at[known], return_counts=True)
                holder, term = np.divmod(cells, max(len(hashes), 1))
                ends = np.concatenate([[0], np.cumsum(np.bincount(holder, minlength=part.num_rows))]).astype(np.int32)
                listed = [pa.ListArray.from_arrays(pa.array(ends), pa.array(v.astype(np.int32))) for v in (term, counts)]
                rows = pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(n, pa.int64()), *listed], ["doc_id", "n", "terms", "counts"]
                )
                yield rows.filter(pa.array(n > 0))

    narrow = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return narrow.mapInArrow(scan, "doc_id bigint, n bigint, terms array<int>, counts array<int>")


def document_counts(vectors: DataFrame, size: int) -> np.ndarray:
    """Number of documents that hold each of the ``size`` terms."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype=np.int64)
        for batch in batches:
            total += np.bincount(batch.column(0).flatten().to_numpy(), minlength=size)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["term", "n"])

    counted = vectors.select("terms").mapInArrow(count, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
    got = counted.toArrow()
    out = np.zeros(size, dtype=np.int64)
    out[got.column("term").to_numpy()] = got.column("n").to_numpy()
    return out


@dataclass(frozen=True)
class Scale:
    """What a score needs of the whole corpus: documents, their terms, and the weight of each term."""

    documents: int
    terms: int
    weights: np.ndarray

    def norms(self, n: np.ndarray) -> np.ndarray:
        return 10 + 90 * n * self.documents // self.terms

    def parts(self, terms: np.ndarray, counts: np.ndarray, norms: np.ndarray) -> np.ndarray:
        """What each term adds to a score."""
        return self.weights[terms] * (10**9 * counts // (1000 * counts + 8 * norms))


@dataclass
class Node:
    """Documents lo to hi of a tree, which share the first ``depth`` terms; without children a leaf."""

    lo: int
    hi: int
    depth: int
    children: list[Node]
    terms: np.ndarray
    most: np.ndarray
    least_norm: int


class Tree:
    """A tree of document vectors; its documents lie in the order of their paths."""

    def __init__(self, ids: np.ndarray, norms: np.ndarray, ends: np.ndarray, terms: np.ndarray, counts: np.ndarray, rank: np.ndarray):
        sizes = np.diff(ends)
        owner = np.repeat(np.arange(len(ids)), sizes)
        order = np.lexsort((rank[terms], owner))
        terms, counts = terms[order], counts[order]
        path = rank[terms].astype(">u4").tobytes()
        keys = [path[4 * s : 4 * e] for s, e in zip(ends[:-1].tolist(), ends[1:].tolist())]
        by_path = np.array(sorted(range(len(keys)), key=keys.__getitem__), dtype=np.int64)
        self.ids, self.norms, self.sizes = ids[by_path], norms[by_path], sizes[by_path]
        moved = spread(ends[:-1][by_path], self.sizes)
        self.terms, self.counts = terms[moved], counts[moved]
        self.ends = np.concatenate([[0], np.cumsum(self.sizes)])
        self.shared = self._shared()
        self.root = self._node(0, len(ids), 0)

    def _shared(self) -> np.ndarray:
        """Terms at the start of each path that the path before it begins with, too."""
        out = np.zeros(len(self.ids), dtype=np.int64)
        for i in range(1, len(self.ids)):
            size = min(self.sizes[i - 1], self.sizes[i])
            before, here = self.ends[i - 1], self.ends[i]
            differ = self.terms[before : before + size] != self.terms[here : here + size]
            at = int(differ.argmax()) if size else 0
            out[i] = at if size and differ[at] else size
        return out

    def _node(self, lo: int, hi: int, above: int) -> Node:
        """The node of documents lo to hi, built from the leaves up without recursion over paths."""
        done: dict[tuple[int, int], Node] = {}
        todo = [(lo, hi, above, None)]
        while todo:
            lo_, hi_, above_, parts = todo.pop()
            if parts is None:
                inner = self.shared[lo_ + 1 : hi_]
                depth = int(inner.min()) if len(inner) else int(self.sizes[lo_])
                parts = [] if hi_ - lo_ <= LEAF else self._split(lo_, hi_, depth)
                if len(parts) < 2:
                    done[lo_, hi_] = self._summed(lo_, hi_, depth, [])
                    continue
                todo.append((lo_, hi_, depth, parts))
                todo.extend((a, b, depth, None) for a, b in parts)
            else:
                done[lo_, hi_] = self._summed(lo_, hi_, above_, [done.pop(p) for p in parts])
        return done[lo, hi]

    def _split(self, lo: int, hi: int, depth: int) -> list[tuple[int, int]]:
        """Child subtrees of the node; small ones next to each other go together into one leaf."""
        cuts = [lo, *(np.flatnonzero(self.shared[lo + 1 : hi] == depth) + lo + 1).tolist(), hi]
        parts: list[tuple[int, int]] = []
        for a, b in zip(cuts[:-1], cuts[1:]):
            if parts and b - parts[-1][0] <= LEAF:
                parts[-1] = (parts[-1][0], b)
            else:
                parts.append((a, b))
        return parts

    def _summed(self, lo: int, hi: int, depth: int, children: list[Node]) -> Node:
        if children:
            terms = np.concatenate([c.terms for c in children])
            counts = np.concatenate([c.most for c in children])
        else:
            terms, counts = self.terms[self.ends[lo] : self.ends[hi]], self.counts[self.ends[lo] : self.ends[hi]]
        order = np.argsort(terms, kind="stable")
        sorted_terms = terms[order]
        first = np.flatnonzero(np.concatenate([[True], sorted_terms[1:] != sorted_terms[:-1]])) if len(terms) else order
        most = np.maximum.reduceat(counts[order], first) if len(terms) else counts
        return Node(lo, hi, depth, children, sorted_terms[first], most, int(self.norms[lo:hi].min()))


class Best:
    """The best documents of every item so far; equal scores by ascending id, null ids last."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.heaps: list[list[tuple[int, int, bool]]] = [[] for _ in range(items)]
        #: Score and id of the last of k; nothing below 1 counts.
        self.score = np.ones(items, dtype=np.int64)
        self.id = np.full(items, NO_ID, dtype=np.int64)

    def offer(self, item: int, score: int, doc: int, null: bool) -> None:
        heap, entry = self.heaps[item], (score, -doc, null)
        if len(heap) < self.k:
            heapq.heappush(heap, entry)
        elif entry > heap[0]:
            heapq.heapreplace(heap, entry)
        if len(heap) == self.k:
            self.score[item], self.id[item] = heap[0][0], -heap[0][1]


def walk(tree: Tree, nulls: np.ndarray, items: Items, scale: Scale, best: Best) -> tuple[int, int]:
    """Depth-first branch and bound for all items of a block; (item, node) pairs bounded and entered."""
    size = len(items.ids)
    bounded = entered = 0
    todo = [(tree.root, np.arange(size))]
    while todo:
        node, active = todo.pop()
        counts = items.count[node.terms]
        holders = items.holders[spread(items.first[node.terms], counts)]
        parts = np.repeat(scale.parts(node.terms, node.most, np.int64(node.least_norm)), counts)
        bound = np.zeros(size, dtype=np.int64)
        np.add.at(bound, holders, parts)
        bounded += len(active)
        # An equal bound may still hold a smaller id.
        active = active[bound[active] >= best.score[active]]
        entered += len(active)
        if not len(active):
            continue
        if node.children:
            todo.extend((child, active) for child in reversed(node.children))
            continue
        wanted = np.zeros(size, dtype=bool)
        wanted[active] = True
        for lo in range(node.lo, node.hi, 256):
            _score(tree, lo, min(lo + 256, node.hi), nulls, items, scale, best, wanted)
    return bounded, entered


def _score(tree, lo, hi, nulls, items, scale, best, wanted) -> None:
    """Score documents lo to hi for the wanted items and keep the best."""
    start, stop = tree.ends[lo], tree.ends[hi]
    terms = tree.terms[start:stop]
    owner = np.repeat(np.arange(hi - lo), tree.sizes[lo:hi])
    parts = scale.parts(terms, tree.counts[start:stop], tree.norms[lo:hi][owner])
    counts = items.count[terms]
    holders = items.holders[spread(items.first[terms], counts)]
    chosen = wanted[holders]
    cells = (np.repeat(owner, counts)[chosen]) * len(items.ids) + holders[chosen]
    scores = np.zeros((hi - lo) * len(items.ids), dtype=np.int64)
    np.add.at(scores, cells, np.repeat(parts, counts)[chosen])
    scores = scores.reshape(hi - lo, len(items.ids))
    ids = tree.ids[lo:hi]
    good = (scores > best.score) | ((scores == best.score) & (ids[:, None] <= best.id))
    for doc, item in zip(*np.nonzero(good)):
        best.offer(int(item), int(scores[doc, item]), int(ids[doc]), bool(nulls[lo + doc]))


def search_block(docs: DataFrame, items: Items, k: int, id_col: str, text_col: str) -> DataFrame:
    """(_item, item_id, doc_id, score): the best ``k`` documents that each task found, and all k best among them."""
    found = materialise(vectors(docs, items, id_col, text_col), "vectors")
    size = len(items.hashes)
    documents, terms = found.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    held = document_counts(found, size)
    weights = np.floor(1000 * np.log((2 * documents + 2) / (2 * held + 1))).astype(np.int64)
    rank = np.empty(size, dtype=np.int64)
    rank[np.argsort(-held, kind="stable")] = np.arange(size)
    scale = Scale(documents, max(terms, 1), weights)

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(len(items.ids), k)
        for rows in gathered(batches):
            ids = rows.column("doc_id")
            lists = rows.column("terms")
            tree = Tree(
                ids.fill_null(NO_ID).to_numpy(zero_copy_only=False), scale.norms(rows.column("n").to_numpy()),
                np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))]),
                lists.flatten().to_numpy().astype(np.int64), rows.column("counts").flatten().to_numpy().astype(np.int64), rank,
            )
            # A null id is told from the largest number by its flag.
            walk(tree, tree.ids == NO_ID if ids.null_count else np.zeros(len(ids), bool), items, scale, best)
        kept = [(i, items.ids[i], None if null else -doc, score) for i, heap in enumerate(best.heaps) for score, doc, null in heap]
        columns = list(zip(*kept)) or [[], [], [], []]
        types = (pa.int32(), pa.int64(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["_item", "item_id", "doc_id", "score"])

    return found.mapInArrow(grow, "_item int, item_id bigint, doc_id bigint, score bigint")


def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of vectors in batches of the size of a tree; documents without a listed term are left out."""
    held: list[pa.RecordBatch] = []
    rows = entries = 0
    for batch in batches:
        batch = batch.filter(pc.greater(pc.list_value_length(batch.column("terms")), 0))
        sizes = np.cumsum(batch.column("terms").value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = sizes[start - 1] if start else 0
            stop = int(np.searchsorted(sizes, before + TREE_ENTRIES - entries, side="right"))
            stop = min(max(stop, start + (not held)), start + TREE_DOCS - rows, batch.num_rows)
            if stop > start:
                held.append(batch.slice(start, stop - start))
                rows, entries = rows + stop - start, entries + int(sizes[stop - 1] - before)
            if stop < batch.num_rows or rows >= TREE_DOCS:
                yield pa.concat_batches(held)
                held, rows, entries = [], 0, 0
            start = stop
    if held:
        yield pa.concat_batches(held)


def search(
    docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` documents with the highest score above 0 for each item.

    Terms are runs of letters and digits of ASCII and of all characters beyond it, A-Z in lower case.
    Null texts have none; documents without a term are not counted and never found, items without one
    find nothing. Equal scores are ranked by ascending id, null ids last. Every row is a document and
    every row of ``items`` an item of its own, repeated ids included. Other columns are not read. Without
    documents or items the result is empty. Each block of items reads the documents once; its result is written down, so
    the driver holds one block at a time.
    """
    spark = docs.sparkSession
    best = None
    number = 0
    for block in blocks(items, item_col, item_text_col):
        found = search_block(docs, block, k, id_col, text_col).withColumn("_item", F.col("_item").cast("bigint") + F.lit(number))
        part = materialise(found, "found")
        best = part if best is None else best.unionByName(part)
        number += len(block.ids)
    if best is None:
        return spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    # One row in SALTS meets the others of its item first, so that no task reads all tasks' rows of an item.
    salted = best.withColumn("_salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
    thinned = salted.withColumn("_rank", F.row_number().over(Window.partitionBy("_item", "_salt").orderBy(*order))).where(F.col("_rank") <= k)
    ranked = thinned.withColumn("rank", F.row_number().over(Window.partitionBy("_item").orderBy(*order))).where(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")


def search_sql(documents: str = "documents", items: str = "benchmark", k: int = 10) -> str:
    """SQL of ``search``."""
    terms = (
        "regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
        r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
    )
    return f"""
WITH words AS (SELECT doc_id, unnest({terms.format('text')}) AS term FROM {documents}),
wanted AS (SELECT DISTINCT item_id, unnest({terms.format('text')}) AS term FROM {items}),
lengths AS (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id),
corpus AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM lengths),
tfs AS (SELECT doc_id, term, count(*) AS tf FROM words WHERE term IN (SELECT term FROM wanted) GROUP BY doc_id, term),
dfs AS (SELECT term, count(*) AS df FROM tfs GROUP BY term),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w FROM dfs, corpus),
scored AS (
    SELECT item_id, t.doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // total)))) AS BIGINT) AS score
    FROM wanted JOIN tfs t USING (term) JOIN weights USING (term) JOIN lengths l ON l.doc_id = t.doc_id, corpus
    GROUP BY item_id, t.doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score FROM ranked WHERE rank <= {k}"""
