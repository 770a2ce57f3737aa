"""Ranked lexical search against plain loops, its bounds, and its edge cases."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from corpusflow.llm import search
from corpusflow.llm.queries import QUERIES
from corpusflow.llm.tables import table

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items, k=10):
    """Scores of all documents for all items, from the rule."""
    bags = [(i, Counter(terms_of(t))) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    total, count = sum(sum(b.values()) for _, b in bags), len(bags)
    held = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        scores = []
        for doc, bag in bags:
            norm = 10 + 90 * sum(bag.values()) * count // total
            score = sum(
                math.floor(1000 * math.log((2 * count + 2) / (2 * held[t] + 1))) * (10**9 * bag[t] // (1000 * bag[t] + 8 * norm))
                for t in set(terms_of(text)) if t in bag
            )
            if score > 0:
                scores.append((-score, doc is None, doc if doc is not None else 0, doc))
        out += [(item, r, doc, -score) for r, (score, _, _, doc) in enumerate(sorted(scores, key=lambda s: s[:3])[:k], 1)]
    return out


def words(draw, n, vocabulary):
    return " ".join(draw.choices(vocabulary, weights=[1 / (r + 1) for r in range(len(vocabulary))], k=n))


def got(frame):
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2] is None, r[2] or 0, r[3])
    return sorted([(r.item_id, r["rank"], r.doc_id, r.score) for r in frame.collect()], key=key), key


def frames(spark, docs, items):
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("tree_docs, leaf", [(4096, 8), (30, 1), (7, 3)])
def test_equal_to_plain_loops(spark, monkeypatch, tree_docs, leaf):
    monkeypatch.setattr(search, "TREE_DOCS", tree_docs)
    monkeypatch.setattr(search, "LEAF", leaf)
    draw = random.Random(tree_docs)
    vocabulary = [f"w{k}" for k in range(80)] + ["Été", "naïve", "日本", "X9"]
    docs = [(i * 3, words(draw, draw.randint(1, 60), vocabulary)) for i in range(150)]
    docs += [(1000 + i, docs[i % 5][1]) for i in range(40)]
    items = [(i, words(draw, draw.randint(1, 25), vocabulary)) for i in range(12)]
    rows, key = got(search.search(*frames(spark, docs, items)))
    assert rows == sorted(plain(docs, items), key=key)
    rows, key = got(search.search(*[f.repartition(5) for f in frames(spark, docs, items)], k=3))
    assert rows == sorted(plain(docs, items, 3), key=key)


def test_blocks_give_the_same_result(spark, monkeypatch):
    monkeypatch.setattr(search, "BLOCK_ITEMS", 2)
    docs = [(i, f"alpha beta{i % 3} gamma{i % 4}") for i in range(20)]
    items = [(i, f"beta{i % 3} gamma{i}") for i in range(5)]
    rows, key = got(search.search(*frames(spark, docs, items)))
    assert rows == sorted(plain(docs, items), key=key)


def test_edges(spark):
    long = "tick " * 60_000 + "tock"
    docs = [(1, None), (2, ""), (3, " .,;\n"), (4, "Tick tock"), (4, "Tick tock"), (None, "tick tock"), (5, long), (-6, "tock"), (7, "a\x00b")]
    items = [(1, "tick"), (1, "TICK"), (None, "tock"), (2, None), (3, ""), (4, "absent"), (5, "b tick tock")]
    rows, key = got(search.search(*frames(spark, docs, items)))
    assert rows == sorted(plain(docs, items), key=key)
    docs_frame, items_frame = frames(spark, docs, items)
    extra = docs_frame.selectExpr("*", "1 as n", "'x' as terms", "2 as counts", "'y' as _item", "3 as score")
    assert got(search.search(extra, items_frame.selectExpr("*", "'z' as doc_id", "0 as rank")))[0] == rows
    assert search.search(docs_frame.limit(0), items_frame).collect() == []
    assert search.search(docs_frame, items_frame.limit(0)).collect() == []
    assert search.search(docs_frame.where("doc_id < 4 and doc_id > 0"), items_frame).collect() == []


def test_ties_go_to_the_smallest_ids(spark):
    docs = [(i, "same words here") for i in range(3000, 0, -1)]
    rows, _ = got(search.search(*frames(spark, docs + [(9000 + k, "other") for k in range(2000)], [(1, "words")])))
    assert [(r[1], r[2]) for r in rows] == [(k, k) for k in range(1, 11)]


def test_bounds_hold_and_leave_work_out():
    draw = random.Random(5)
    vocabulary = [f"w{k}" for k in range(400)]
    texts = [words(draw, draw.randint(5, 80), vocabulary) for _ in range(600)]
    items = search.Items.of(list(range(20)), texts[:20])
    lists = [np.unique(np.searchsorted(items.hashes, [h for h in hashed(t) if h in set(items.hashes.tolist())]), return_counts=True) for t in texts]
    sizes = np.array([len(t) for t, _ in lists])
    terms, counts = (np.concatenate([x[k] for x in lists]).astype(np.int64) for k in (0, 1))
    lengths = np.array([len(t.split()) for t in texts])
    held = np.bincount(terms, minlength=len(items.hashes))
    rank = np.empty(len(held), dtype=np.int64)
    rank[np.argsort(-held, kind="stable")] = np.arange(len(held))
    scale = search.Scale(600, int(lengths.sum()), np.floor(1000 * np.log(1202 / (2 * held + 1))).astype(np.int64))
    tree = search.Tree(np.arange(600), scale.norms(lengths), np.concatenate([[0], np.cumsum(sizes)]), terms, counts, rank)
    todo = [tree.root]
    while todo:
        node = todo.pop()
        held_here = tree.terms[tree.ends[node.lo] : tree.ends[node.hi]]
        assert sorted(set(held_here.tolist())) == node.terms.tolist()
        assert node.least_norm == tree.norms[node.lo : node.hi].min()
        if node.children:
            assert [c.lo for c in node.children] + [node.hi] == [node.lo] + [c.hi for c in node.children]
        paths = {tuple(tree.terms[tree.ends[d] : tree.ends[d] + node.depth].tolist()) for d in range(node.lo, node.hi)}
        assert len(paths) == 1
        todo.extend(node.children)
    best = search.Best(20, 10)
    bounded, entered = search.walk(tree, np.zeros(600, bool), items, scale, best)
    assert 0 < entered < bounded


def hashed(text):
    import pyarrow as pa

    data, starts, ends, _ = search.term_spans(pa.array([text]))
    return search.word_hashes(data, starts, ends).tolist()


def test_query_over_the_table(spark, sf):
    docs = [(r.doc_id, r.text) for r in table(spark, sf, "documents").collect()]
    items = [(r.item_id, r.text) for r in table(spark, sf, "benchmark").collect()]
    rows, key = got(QUERIES["op13_fp_tree_search"](spark, sf))
    assert rows == sorted(plain(docs, items), key=key)
