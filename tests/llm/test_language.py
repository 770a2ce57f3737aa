"""The byte network: gradients, windows, held-out accuracy and edge cases."""

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from corpusflow.llm import language
from corpusflow.llm.queries import QUERIES
from corpusflow.llm.tables import table
from corpusflow.llm.textbytes import raw

SCHEMA = "doc_id long, text string, lang string"


def two_languages(n):
    return [(i, ("abab cdcd " if i % 2 else "xyxy zwzw ") * (1 + i % 40), "one" if i % 2 else "two") for i in range(n)]


def test_windows_hold_every_run_of_bytes():
    texts = [None, "", "a", "b" * 256, "c" * 257, "".join(chr(97 + k % 26) for k in range(2000)), "é" * 300]
    data, offsets = raw(pa.array(texts, pa.string()))
    windows, owner, held = language.cut(data, offsets)
    for k, text in enumerate(texts):
        body = (text or "").encode()
        mine = [w[:h].tobytes() for w, h in zip(windows[owner == k], held[owner == k])]
        assert all(len(w) <= language.WINDOW for w in mine)
        joined = mine[0] + b"".join(w[language.WIDEST - 1 :] for w in mine[1:])
        assert joined == body
        # A run across a border lies whole in one of the two windows.
        assert all(any(body[s : s + language.WIDEST] in w for w in mine) for s in range(len(body) - language.WIDEST + 1))
    assert not windows[np.arange(language.WINDOW) >= held[:, None]].any()


def test_gradients_agree_with_differences():
    draw = np.random.default_rng(3)
    net = language.fresh(["a", "b", "c"], 1)
    for name in ("embedding", "filters", "filter_bias", "weights", "bias"):
        setattr(net, name, getattr(net, name).astype(np.float64))
    windows = draw.integers(0, 256, (4, language.WINDOW)).astype(np.uint8)
    target = np.array([0, 1, 2, 1])

    def loss():
        return -np.log(language.probabilities(net, windows)[np.arange(4), target]).mean()

    for p, g in zip(net.parameters(), language.gradients(net, windows, target)):
        for at in draw.choice(p.size, min(12, p.size), replace=False):
            place = np.unravel_index(at, p.shape)
            if p is net.filters and not language.in_width()[place]:
                assert g[place] == 0
                continue
            old, step = p[place], 1e-6
            p[place] = old + step
            up = loss()
            p[place] = old - step
            down = loss()
            p[place] = old
            assert abs((up - down) / (2 * step) - g[place]) < 1e-5


def test_probabilities_do_not_depend_on_batches(monkeypatch):
    net = language.fresh(["a", "b"], 2)
    windows = np.random.default_rng(1).integers(0, 256, (50, language.WINDOW)).astype(np.uint8)
    whole = language.probabilities(net, windows)
    monkeypatch.setattr(language, "BATCH", 7)
    assert np.allclose(whole, language.probabilities(net, windows), atol=1e-6)
    assert np.allclose(whole.sum(axis=1), 1)


def test_held_out_accuracy(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows = language.language_id(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    unseen = [r for r in rows if r.held_out and r.lang is not None]
    assert len(unseen) > 200
    assert sum(r.lang == r.lang_pred for r in unseen) / len(unseen) >= 0.97
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)


def test_held_out_rows_and_other_columns_say_nothing(spark):
    rows = two_languages(200)
    docs = spark.createDataFrame(rows, SCHEMA)
    # Wrong languages on held-out rows, and another order of rows, change nothing.
    wrong = docs.withColumn("lang", F.when(language.held_out(F.col("doc_id")), F.lit("three")).otherwise(F.col("lang"))).repartition(7)
    a, b = language.learn(docs), language.learn(wrong)
    assert a.languages == b.languages == ["one", "two"]
    assert all(np.array_equal(x, y) for x, y in zip(a.parameters(), b.parameters()))


def test_edges(spark):
    rows = two_languages(120) + [
        (1000, None, "one"), (1001, "", "two"), (1002, "123 !? 456", "one"), (1003, "abab " * 50_000, None), (1004, "é", "one"),
        (None, "abab cdcd abab", "two"), (1003, "abab " * 50_000, None), (1005, "\x00\x01", "one"), (1006, "日本", None),
    ]
    docs = spark.createDataFrame(rows, SCHEMA)
    extra = docs.selectExpr("*", "'x' as id", "1 as lettered", "'q' as lang_pred", "5 as score", "0 as held_out", "'w' as window")
    got = language.language_id(extra).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append((r.lang_pred, r.score, r.held_out))
    assert all(by[k] == [("und", 0.0, by[k][0][2])] for k in (1000, 1001, 1002, 1005))
    assert [x[0] for x in by[1003]] == ["one", "one"] and by[1003][0] == by[1003][1]
    assert by[None][0][0] == "one" and by[None][0][2] is False
    assert by[1004][0][0] in ("one", "two") and by[1006][0][0] in ("one", "two")
    assert language.language_id(docs.limit(0)).collect() == []
    unknown = language.language_id(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r.lang_pred, r.score) for r in unknown} == {("und", 0.0)}


def test_query_returns_every_document(spark, sf):
    assert QUERIES["op12_byte_cnn"](spark, sf).count() == table(spark, sf, "documents").count()
