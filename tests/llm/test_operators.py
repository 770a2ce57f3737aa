"""Training-data operators against plain loops, and their edge cases."""

import hashlib
import itertools
import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from corpusflow.llm import decontaminate, graph, lines, linking, paragraphs, pfair, pii, quality, simhash, suffixes, toxicity, warc
from corpusflow.llm.queries import CHECKS, QUERIES, SHARES
from corpusflow.llm.tables import table

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def docs_of(spark, texts, ids=None):
    rows = [(i if ids is None else ids[i], t, "x") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, kept string")


def some_texts(seed, n=60, words=40):
    draw = random.Random(seed)
    vocabulary = ["".join(draw.choices("abcdefgh", k=draw.randint(2, 9))) for _ in range(300)]
    texts = []
    for _ in range(n):
        if texts and draw.random() < 0.4:
            parts = draw.choice(texts).split(" ")
            for _ in range(draw.randint(0, 3)):
                parts[draw.randrange(len(parts))] = draw.choice(vocabulary)
            texts.append(" ".join(parts))
        else:
            texts.append(" ".join(draw.choices(vocabulary, k=words)))
    return texts


EDGES = [None, "", " \n\t ", "one", "one", "é\n\né", "word " * 30_000, "Same line of five words here\n" * 40]


def classes_of(nodes, linked):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in linked:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 40)] + [(7, 7), (None, 3)]
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{100 + i: 100 for i in range(40)}}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_linking_loses_no_link_in_mixed_buckets(spark):
    draw = random.Random(3)
    nodes = list(range(120))
    members = {(draw.randrange(6), n) for n in nodes} | {(9, n) for n in nodes[:80]}
    pairs = {(a, b) for x, a in members for y, b in members if x == y and a < b}
    linked = {p for p in pairs if (p[1] - p[0]) in (1, 13)}
    got = linking.linked_classes(
        spark.createDataFrame(sorted(members), "bucket long, node long"), lambda p: p.where("b - a in (1, 13)")
    )
    want = classes_of(nodes, linked)
    assert {r.node: r.component for r in got.collect()} == {n: c for n, c in want.items() if any(n in p for p in linked)}


def test_exploded_members_are_not_broadcast(spark, monkeypatch):
    """Members come out of an explode, which Spark sizes like the few rows before it."""
    plans, write = [], linking.materialise
    planned = lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString())
    monkeypatch.setattr(linking, "materialise", lambda df, label: planned(df) or write(df, label))
    got = simhash.near_duplicates(docs_of(spark, some_texts(1, n=40, words=60)))
    planned(got)
    assert got.count() == 40 and len(plans) >= 4 and not any("Broadcast" in plan for plan in plans)


def simhash_by_hand(text, width):
    words = WORD.findall(text)
    words = ["".join(c.lower() if "A" <= c <= "Z" else c for c in w) for w in words]
    shingles = [" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("texts", [some_texts(1, words=150), EDGES, []])
def test_simhash(spark, texts):
    got = {r.doc_id: r for r in simhash.near_duplicates(docs_of(spark, texts)).collect()}
    prints = {i: simhash_by_hand(t or "", 3) for i, t in enumerate(texts)}
    want = classes_of(prints, [(a, b) for a, b in itertools.combinations(prints, 2) if (prints[a] ^ prints[b]).bit_count() <= 3])
    assert {i: (r.fingerprint, r.component_id) for i, r in got.items()} == {i: (f"{p:016x}", want[i]) for i, p in prints.items()}


def test_anchors_cover_every_pair_one_bit_apart(spark):
    draw = random.Random(5)
    values = [(v := draw.getrandbits(31), v ^ (1 << draw.randrange(31))) for _ in range(200)]
    got = spark.createDataFrame(values, "a long, b long").select(simhash.anchors(F.col("a")).alias("a"), simhash.anchors(F.col("b")).alias("b")).collect()
    assert all(set(r.a) & set(r.b) for r in got)
    assert all(len(r.a) in (1, 16) and len(set(r.a)) == len(r.a) for r in got)


def test_null_and_repeated_ids(spark):
    got = simhash.near_duplicates(docs_of(spark, ["a b c d", "a b c d", "x y z w"], [None, 5, None])).collect()
    assert Counter((r.doc_id, r.component_id) for r in got) == Counter([(None, 5), (5, 5), (None, None)])


def edit(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def test_lines_are_cut_once_per_group(spark):
    base = "the quick brownish foxes jumped over several lazily sleeping animals yesterday morning again without stopping"
    texts = [f"{base}\nshort line", f"intro words that are only found here today\n{base.upper()}!", f"{base}\nshort line", None, ""]
    got = {r.doc_id: r for r in lines.dedupe_lines(docs_of(spark, texts)).collect()}
    assert got[0].text == texts[0] and got[0].n_removed == 0
    assert got[1].text == "intro words that are only found here today" and got[1].n_lines == 2
    assert got[2].text == "short line" and got[3].text is None and got[4].text == ""
    assert got[3].n_lines == 0 and got[4].n_lines == 1 and got[0].kept == "x"


def test_lines_with_clashing_columns_and_without_repeats(spark):
    """Columns named like those the operator adds are passed on; documents without a cut stay as they are."""
    line = "a sufficiently repeated sentence containing several remarkably lengthy words everywhere"
    rows = [(1, line, "r1"), (2, f"unique\n{line}", "r2"), (3, "nothing repeated here at all today", "r3"), (None, None, "r4")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, _id string").selectExpr(
        "*", "'d' as _doc", "'x' as _removed", "'y' as _row", "'z' as `a.b`", "5 as n_lines"
    )
    got = {r.doc_id: r for r in lines.dedupe_lines(frame).collect()}
    assert {k: (r.text, r.n_removed) for k, r in got.items()} == {1: (line, 0), 2: ("unique", 1), 3: (rows[2][1], 0), None: (None, 0)}
    assert all((r._doc, r._removed, r._row, r["a.b"]) == ("d", "x", "y", "z") for r in got.values())
    assert got[2]["_id"] == "r2" and got[2].n_lines == 2 and got[None].n_lines == 0


def test_near_lines_are_found_as_often_as_blocks_allow(spark):
    """One word of fifty changed leaves two of five blocks alone in about three of four pairs."""
    draw = random.Random(17)
    vocabulary = ["".join(draw.choices("abcdefghij", k=7)) for _ in range(5000)]
    texts = []
    for _ in range(100):
        words = draw.choices(vocabulary, k=50)
        texts.append(" ".join(words))
        words[draw.randrange(50)] = draw.choice(vocabulary)
        texts.append(" ".join(words))
    got = {r.doc_id: r.n_removed for r in lines.dedupe_lines(docs_of(spark, texts)).collect()}
    assert all(got[i] == 0 for i in range(0, 200, 2)) and sum(got[i] for i in range(1, 200, 2)) >= 60


def edited(draw, vocabulary, words, changed):
    """A line and the same with some words replaced, one dropped where two and more change."""
    line = draw.sample(vocabulary, words)
    other = line[:]
    for at in draw.sample(range(words), changed):
        other[at] = draw.choice(vocabulary)
    return " ".join(line), " ".join(other)


def test_near_lines_are_found_at_the_threshold(spark):
    """Nine in ten of the pairs at a similarity of 0.95, less the spread of 150 pairs; more of the closer ones. None is linked beyond it."""
    draw = random.Random(23)
    vocabulary = ["".join(draw.choices("abcdefghijklmno", k=draw.randint(2, 10))) for _ in range(9000)]
    kinds = [(20, 1), (40, 2), (120, 6), (50, 1), (100, 2), (12, 1), (30, 3)]
    texts = [text for words, changed in kinds * 150 for text in edited(draw, vocabulary, words, changed)]
    got = [r.n_removed for r in lines.dedupe_lines(docs_of(spark, texts)).orderBy("doc_id").collect()]
    assert not any(got[::2])
    found = [sum(got[1::2][k :: len(kinds)]) / 150 for k in range(len(kinds))]
    assert min(found[:3]) >= 0.84 and min(found[3:5]) >= 0.96 and found[5:] == [0, 0], found


@pytest.mark.parametrize("similarity", [0.95, 0.9, 0.8])
def test_no_near_line_is_left_out(spark, similarity):
    """Every pair with as many edits as the similarity allows is found, spread evenly or anywhere, and none with one more."""
    draw = random.Random(31)
    vocabulary = ["".join(draw.choices("abcdefghijklmno", k=draw.randint(2, 10))) for _ in range(9000)]
    texts, near = [], []
    for n in [20, 21, 24, 25, 31, 39, 40, 41, 59, 60, 61, 80, 100, 160, 400] * 8:
        line, k = draw.sample(vocabulary, n), lines.most_edits(similarity, n)
        for edits in (k, k + 1):
            even = len(near) % 4 < 2
            places = [(j + 1) * n // (edits + 1) for j in range(edits)] if even else sorted(draw.sample(range(n), edits))
            other = line[:]
            for at in reversed(places):
                # The longer line has n words: words go or change, none comes.
                other[at : at + 1] = [] if draw.random() < 0.5 else [draw.choice(vocabulary)]
            texts.append("\n".join([" ".join(line), " ".join(other)]))
            near.append(edit(line, other) <= k)
            line = draw.sample(vocabulary, n)
    got = [r.n_removed for r in lines.dedupe_lines(docs_of(spark, texts), similarity=similarity).orderBy("doc_id").collect()]
    assert got == [int(x) for x in near] and sum(near) >= len(near) // 2


def test_line_groups_against_all_pairs(spark):
    """Groups are those of all pairs within the edits; fingerprints of whole lines are those made word by word."""
    draw = random.Random(29)
    vocabulary = ["".join(draw.choices("abcdefgh", k=6)) for _ in range(60)]
    texts = []
    for _ in range(40):
        line = draw.choices(vocabulary, k=draw.choice([5, 24, 40, 300]))
        for _ in range(3):
            other = line[:]
            other[draw.randrange(len(other))] = draw.choice(vocabulary)
            texts += [" ".join(line), " ".join(other)]
    distinct = sorted(set(texts))
    words = sorted({w for t in distinct for w in t.split()})
    frame = spark.createDataFrame([(w,) for w in words], "w string")
    hashes = {r.w: [r.h0, r.h1, r.h2] for r in frame.selectExpr("w", "xxhash64(w, 0) h0", "xxhash64(w, 1) h1", "xxhash64(w, 2) h2").collect()}
    nodes = dict(spark.createDataFrame([(t,) for t in distinct], "t string").selectExpr("t", "xxhash64(t) h").collect())
    prints = {}
    for t in distinct:
        each = [hashes[w] for w in dict.fromkeys(t.split())]
        prints[t] = [sum(1 << b for b in range(64) if 2 * sum(h[k] >> b & 1 for h in each) > len(each)) for k in range(3)]
    made = lines.fingerprints(spark.createDataFrame([(nodes[t], len(t.split()), t) for t in distinct], "node long, n int, line string")).collect()
    back = {nodes[t]: t for t in distinct}
    assert len(made) == len(distinct) and all([r[f"p{k}"] % 2**64 for k in range(3)] == prints[back[r.line_node]] for r in made)
    parent = {t: t for t in distinct}

    def root(t):
        while parent[t] != t:
            t = parent[t]
        return t

    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            n = max(len(a.split()), len(b.split()))
            if root(a) != root(b) and edit(a.split(), b.split()) <= int(n * 0.05 + 1e-9):
                parent[root(a)] = root(b)
    rows = lines.document_rows(docs_of(spark, texts), "doc_id", "text")
    groups = {r.id: r.group for r in lines.line_groups(rows, 0.95, 0.9, 5, 5).collect()}
    by_group, by_root = {}, {}
    for k, t in enumerate(texts):
        by_group.setdefault(groups[k], set()).add(k)
        by_root.setdefault(root(t), set()).add(k)
    assert sorted(map(sorted, by_group.values())) == sorted(map(sorted, by_root.values())) and len(by_root) < len(distinct)


def test_blocks_follow_from_the_recall():
    chosen = lines.blocks(0.95, 0.9)
    assert len(chosen) == 29 and all(len(set(a) & set(b)) < 2 for a in chosen for b in chosen if a != b)
    assert len(lines.blocks(0.8, 0.9)) == 90 and len(lines.blocks(1.0, 0.9)) == 1


def test_repeated_ids_lose_lines_once(spark):
    line = "a line that stands in three rows of which two share id and text"
    got = lines.dedupe_lines(docs_of(spark, [line, line, f"own words\n{line}"], [7, 7, 7])).collect()
    assert sorted((r.text, r.n_removed) for r in got) in ([("", 1), ("", 1), (f"own words\n{line}", 0)], [(line, 0), (line, 0), ("own words", 1)])


@pytest.mark.parametrize("cut", [lines.dedupe_lines, paragraphs.dedupe_paragraphs])
def test_cuts_keep_rows_and_meet_edges(spark, cut):
    texts = EDGES + ["only words of this single line stay as they are in here today"] * 2
    got = {r.doc_id: r for r in cut(docs_of(spark, texts)).collect()}
    assert len(got) == len(texts)
    assert got[0].text is None and got[1].text == "" and got[3].text == "one"
    assert got[8].text == texts[8] and got[9].text == ""
    assert cut(docs_of(spark, [])).count() == 0


def test_removed_lines_are_repeats(spark, sf):
    """No line goes that is not similar to one that stays or goes before it; exact repeats all go."""
    docs = {r.doc_id: r.text for r in table(spark, sf, "documents").collect()}
    got = {r.doc_id: r.text for r in lines.dedupe_lines(table(spark, sf, "documents")).collect()}
    seen, norm = set(), lambda s: " ".join(re.findall(r"[^\W_]+", s.lower()))
    for i in sorted(docs):
        left, fresh = Counter(got[i].split("\n")), Counter()
        for line in docs[i].split("\n"):
            key = norm(line)
            if len(key.split(" ")) < 5:
                assert left[line] > 0
            else:
                fresh[line] += key not in seen
            seen.add(key)
        assert all(left[line] <= n for line, n in fresh.items())


def test_paragraph_pairs_against_all_pairs(spark):
    texts = some_texts(11, n=80, words=60)
    rows = lines.document_rows(docs_of(spark, texts), "doc_id", "text")
    got = {r.id: r.group for r in paragraphs.paragraph_groups(rows, 0.8, 0.999, 10).collect()}
    sets = [{tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)} for t in texts]
    near = [(a, b) for a, b in itertools.combinations(range(80), 2) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    want = classes_of(range(80), near)
    assert {(a, b) for a in got for b in got if got[a] == got[b]} == {(a, b) for a in want for b in want if want[a] == want[b]}


def test_passages_inside_other_paragraphs(spark):
    """A run of over 50 words goes from all texts but the first, whatever stands around it; runs of 50 words stay."""
    draw = random.Random(51)
    word = lambda: "".join(draw.choices("abcdefghijklm", k=7))
    some = lambda n: " ".join(word() for _ in range(n))
    long, short, line = some(51), some(50), some(60)
    texts = [f"{some(40)} {long} {some(9)}\n{short}x {some(30)}", f"{some(70)} {long}", f"{long} {some(30)}\nown", f"{some(20)} {short}  {some(5)}", f"{some(20)} {short} {some(9)}",
             line, f"own\n{line}", "the " * 300, "of the " + "the " * 120, None, f"{some(12)}\n{some(3)} {long.upper()}"]
    got = {r.doc_id: r for r in paragraphs.dedupe_paragraphs(docs_of(spark, texts), passage_words=51).collect()}
    assert {i: (r.n_removed, r.n_passage_words) for i, r in got.items() if r.n_removed} == {1: (1, 51), 2: (1, 51), 6: (1, 60), 8: (1, 121), 10: (1, 51)}
    assert got[1].text == texts[1][: -len(long) - 1] and got[2].text == texts[2][len(long) + 1 :] and got[6].text == "own" and got[8].text == "of"
    assert all(got[i].text == texts[i] and got[i].n_passage_words == 0 for i in (0, 3, 4, 5, 7, 9))
    assert got[10].text == texts[10][: -len(long) - 1]


def test_passages_against_all_windows(spark):
    texts = some_texts(52, n=60, words=90)
    got = {r.doc_id: r.n_passage_words > 0 for r in paragraphs.dedupe_paragraphs(docs_of(spark, texts), similarity=0.999, passage_words=20).collect()}
    seen, want = set(), {}
    for i, t in enumerate(texts):
        own = {tuple(t.split()[k : k + 20]) for k in range(len(t.split()) - 19)}
        want[i] = bool(own & seen)
        seen |= own
    assert got == want and 5 < sum(want.values()) < 55


def test_band_count_reaches_recall():
    for similarity, recall in ((0.8, 0.99), (0.9, 0.95), (0.5, 0.9)):
        n = paragraphs.band_count(similarity, recall)
        assert 1 - (1 - similarity**paragraphs.ROWS) ** n >= recall > 1 - (1 - similarity**paragraphs.ROWS) ** (n - 1)


def repeats_by_hand(texts, length):
    first = {}
    raw = [(t or "").encode() for t in texts]
    for i, t in enumerate(raw):
        for q in range(len(t) - length + 1):
            first.setdefault(t[q : q + length], i)
    for i, t in enumerate(raw):
        gone = bytearray(len(t))
        for q in range(len(t) - length + 1):
            if first[t[q : q + length]] < i:
                gone[q : q + length] = b"\1" * length
        kept = bytes(c for c, g in zip(t, gone) if not g)
        yield i, (len(t), sum(gone), sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone)), hashlib.sha256(kept).hexdigest())


@pytest.mark.parametrize("texts", [
    some_texts(21, n=50, words=30), ["ab" * 400, "ab" * 90 + "c" + "ab" * 200, "x" * 49, "x" * 50, "x" * 51, "é" * 60, "é" * 70, None, ""], EDGES[:6], []])
def test_suffix_repeats(spark, texts):
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixes.remove_repeats(docs_of(spark, texts)).collect()}
    assert got == dict(repeats_by_hand(texts, 50))


def test_anchors_of_a_slice_take_bounded_memory():
    """A slice's anchors are those of each text, and hashing it holds temporaries of a part of the slice only."""
    draw = random.Random(44)
    texts = ["".join(draw.choices("abcdefgh ", k=draw.choice([0, 49, 50, 51, 3000, 9000]))).encode() for _ in range(300)] + ["é\n".encode() * 60_000, None]
    part = pa.RecordBatch.from_arrays([pa.array(range(302), pa.int64()), pa.array([0] * 302, pa.int64()), pa.array(texts, pa.binary())], ["id", "row", "text"])
    tracemalloc.start()
    got = list(suffixes._flag_scan(50, 4)([part]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    size = sum(len(t or b"") for t in texts)
    assert got and peak < 40 * size, peak / size
    found = suffixes._anchors(part, 50)
    whole = suffixes.anchors(*suffixes.raw(part.column("text")), 50)
    assert all((a == b).all() for a, b in zip(found, whole)) and len(found[0]) > 10_000


def test_anchors_are_dealt_evenly():
    """A sliding minimum favours small hashes; the ranges that anchors are sent to must not follow their order. What is sent comes back."""
    draw = random.Random(45)
    texts = ["".join(draw.choices("abcdefgh ", k=9000)).encode() for _ in range(100)]
    part = pa.RecordBatch.from_arrays([pa.array(range(7, 107), pa.int64()), pa.array([0] * 100, pa.int64()), pa.array(texts, pa.binary())], ["id", "row", "text"])
    sent = pa.Table.from_batches(suffixes._flag_scan(50, 16)([part]))
    ids, ranges = [], Counter()
    for at, blob in zip(sent.column("range").to_pylist(), sent.column("ids")):
        some = suffixes._sums(pa.chunked_array([pa.array([blob.as_py()], pa.binary())]))
        ids += some.tolist()
        ranges[at] += len(some)
    assert len(ranges) == 16 and max(ranges.values()) < 1.2 * min(ranges.values())
    text, _, keys, _, _ = suffixes._anchors(part, 50)
    assert Counter(ids) == Counter((text + 7).tolist())
    assert (suffixes._long(suffixes._short(keys).ravel()) == keys >> np.uint64(24)).all()


def test_ranges_send_a_row_for_each_part(spark):
    """What a range finds is a row for each part of the documents, however many of them hold it; the parts give each document its own."""
    n = 5000
    ids, rows, values = np.arange(n) % 900 - 3, np.arange(n) % 2 - (np.arange(n) % 7 << 60), np.arange(2 * n, dtype=np.int32).reshape(-1, 2)
    found = suffixes._by_part(ids, rows, values, 4)
    assert found.num_rows == 4 and suffixes._by_part(ids[:0], rows[:0], values[:0], 4).num_rows == 0
    got = {}
    for k in range(4):
        each = suffixes._gather(2)(found.slice(k, 1))
        got |= {(i, r): np.frombuffer(b, np.int32).reshape(-1, 2).tolist() for i, r, b in zip(*each.to_pydict().values())}
    want = {}
    for i, r, v in zip(ids.tolist(), rows.tolist(), values.tolist()):
        want.setdefault((i, r), []).append(v)
    assert got == want


def test_arrays_are_sent_compressed():
    """Contexts of words that come again take less than half of their bytes, and all arrays come back as they were."""
    draw = random.Random(43)
    vocabulary = ["".join(draw.choices("abcdefgh", k=7)) for _ in range(60)]
    contexts = np.frombuffer("".join(" ".join(draw.choices(vocabulary, k=40))[:84] for _ in range(300)).encode(), np.uint8).reshape(-1, 84)
    numbers = np.arange(-5, 5, dtype=np.int64)
    blobs = suffixes._pack(contexts, numbers, numbers[:0])
    assert len(blobs[0]) < contexts.size / 2
    column = pa.chunked_array([pa.array([blobs[1], blobs[2], None, blobs[1]], pa.binary())])
    assert suffixes._unpack(column, np.int64).tolist() == [*numbers, *numbers]
    assert (suffixes._unpack(pa.chunked_array([pa.array([blobs[0]], pa.binary())]), np.uint8).reshape(-1, 84) == contexts).all()


def test_suffix_sort_is_a_sort():
    draw = np.random.default_rng(2)
    rows = draw.integers(0, 2, (400, 12)).astype(np.uint8)
    group = np.sort(draw.integers(0, 7, 400))
    order = suffixes.Suffixes(rows).sort(np.arange(400), group)
    keyed = [(g, bytes(rows[o])) for g, o in zip(group, order)]
    assert keyed == sorted(keyed) and sorted(order) == list(range(400))


def test_shares_are_met_within_a_block(spark):
    shares = {"a": 5, "b": 3, "c": 1}
    slots = pfair.period({**shares, pfair.POOL: 1})
    for name, share in shares.items():
        taken = 0
        for t, (got, _, _) in enumerate(slots, 1):
            taken += got == name
            assert abs(taken - t * share / 10) < 1
    rows = [(i, "abcd"[i % 4] if i % 9 else None, "t") for i in range(200)]
    got = pfair.mix(spark.createDataFrame(rows, "doc_id long, source string, on_target string"), shares, block_docs=2).collect()
    assert len(got) == 200 and len({r.mix_order for r in got}) == 200
    until = sorted({r.mix_slot for r in got if r.on_target})
    assert until == list(range(len(until)))
    assert pfair.mix(spark.createDataFrame([], "doc_id long, source string"), shares).count() == 0
    with pytest.raises(ValueError):
        pfair.period({"a": 0})


def test_mix_passes_clashing_columns_on(spark):
    rows = [(1, "src1"), (1, "src1"), (None, None), (2, "else")]
    frame = spark.createDataFrame(rows, "doc_id long, source string").selectExpr(
        "*", "7 as _place", "8 as _bits", "9 as _in_period", "10 as _share", "11 as _slot", "12 as _source", "13 as _doc", "14 as _id", "15 as `a.b`"
    )
    got = pfair.mix(frame, SHARES).collect()
    assert sorted((r.doc_id or 0, r.source or "") for r in got) == sorted((i or 0, s or "") for i, s in rows)
    assert all(tuple(r)[2:11] == tuple(range(7, 16)) for r in got) and len({r.mix_order for r in got}) == 4


def test_decontamination_against_all_windows(spark):
    draw = random.Random(4)
    vocabulary = ["".join(draw.choices("abcdefghij", k=5)) for _ in range(400)]
    items = [" ".join(draw.choices(vocabulary, k=n)) for n in (8, 15, 25, 45, 70)]
    texts, want = [], set()
    for i in range(120):
        words = draw.choices(vocabulary, k=80)
        if i % 3:
            k = i % 5
            part = items[k].split()
            for _ in range(0 if i % 3 == 1 else max(1, len(part) // 20)):
                part[draw.randrange(len(part))] = draw.choice(vocabulary)
            at = draw.randrange(60)
            words[at:at] = part
            want.add((i, k))
        texts.append(" ".join(words).title() + "!")
    benchmark = spark.createDataFrame(list(enumerate(items)) + [(9, None), (8, "")], "item_id long, text string")
    got = {(r.doc_id, k) for r in decontaminate.contamination(docs_of(spark, texts), benchmark, block_chars=300).collect() for k in r.item_ids}
    exact = {(i, k) for i, k in want if i % 3 == 1}
    assert exact <= got <= want
    assert len(got) >= 0.9 * len(want)
    assert not any(r.contaminated for r in decontaminate.contamination(docs_of(spark, EDGES), benchmark.limit(0)).collect())


def test_edit_distance_of_candidates():
    draw = random.Random(8)
    words = lambda n: [draw.choice("abcd") for _ in range(n)]
    item, text = words(12), words(40)
    block = decontaminate.Block([1], [" ".join(item)], 0.5, 2)
    hashes, owner = decontaminate.words_of(__import__("pyarrow").array([" ".join(text)]))
    starts = np.arange(len(text))
    got = block.distances(hashes, owner, np.zeros(len(text), int), starts, np.zeros(len(text), int))
    # Six edits are allowed: the run begins up to twelve words on and is up to six longer than the item.
    want = [min(edit(item, text[b:e]) for b in range(s, min(s + 30, len(text)) + 1) for e in range(b, min(s + 30, len(text)) + 1)) for s in starts]
    assert got.tolist() == want


def test_quality_counts_and_edges(spark):
    texts = EDGES + some_texts(31, n=20) + ["A b c A b c d\nA b c\nA b c"]
    got = {r.doc_id: r for r in quality.weak_supervision(docs_of(spark, texts)).collect()}
    for i, t in enumerate(texts):
        words = WORD.findall(t or "")
        windows = Counter(tuple(words[k : k + 3]) for k in range(len(words) - 2))
        again = {k + d for k in range(len(words) - 2) if windows[tuple(words[k : k + 3])] > 1 for d in range(3)}
        with_words = [x for x in (t or "").split("\n") if WORD.search(x)]
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_repeat_words, r.n_dup_lines) == (len(words), sum(map(len, words)), len(again), len(with_words) - len(set(with_words)))
        assert r.base_failed == (len(words) < 50 or 100 * len(again) > 50 * len(words))
        assert not (r.base_failed and r.kept)
    assert quality.weak_supervision(docs_of(spark, [])).count() == 0


def test_quality_follows_labels(spark, sf):
    labels = {r.doc_id: r.quality for r in table(spark, sf, "labels").collect()}
    rows = [r for r in quality.weak_supervision(table(spark, sf, "documents")).collect() if r.doc_id in labels and not r.base_failed]
    assert sum(r.kept == bool(labels[r.doc_id]) for r in rows) >= 0.85 * len(rows)


def test_toxicity_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in toxicity.toxicity(table(spark, sf, "documents"), table(spark, sf, "labels")).collect()}
    labels = {r.doc_id: r.toxic for r in table(spark, sf, "labels").collect()}
    held = [(got[i].score, t) for i, t in labels.items() if got[i].held_out]
    pairs = [(a > b) + 0.5 * (a == b) for a, x in held for b, y in held if x > y]
    assert sum(pairs) / len(pairs) > 0.8
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())


def test_toxicity_edges(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    got = toxicity.toxicity(docs_of(spark, EDGES), none).collect()
    assert len(got) == len(EDGES) and {r.predicted for r in got} == {0}
    one = spark.createDataFrame([(1, 1), (3, 1), (None, 0)], "doc_id long, toxic int")
    assert {r.predicted for r in toxicity.toxicity(docs_of(spark, EDGES), one).collect()} == {1}


def test_surrogates_keep_type_format_and_reference(spark):
    texts = [
        "Mr. John Smith wrote to ann.b@mail.example.com, then Mrs. Smith did.", "MR Mr. SMITH called +1 (482) 555-7163 from 10.20.30.40",
        "card 4111 1111 1111 1111, again 4111 1111 1111 1111; key " + "0aF3" * 10, "Г-жа Анна Иванова", "clean text 12 of no one", *EDGES]
    got = {r.doc_id: r for r in pii.replace_entities(docs_of(spark, texts), "k").collect()}
    assert got[0].kinds == ["given_m", "family", "email", "family"]
    first, second = re.search(r"Mr\. \w+ (\w+) .* Mrs\. (\w+)", got[0].text).groups()
    assert first == second != "Smith" and first.upper() in got[1].text
    cards = re.findall(r"\d{4} \d{4} \d{4} \d{4}", got[2].text)
    digits = [int(c) for c in reversed(cards[0].replace(" ", ""))]
    assert cards[0] == cards[1] and sum(d if k % 2 == 0 else sum(divmod(2 * d, 10)) for k, d in enumerate(digits)) % 10 == 0
    assert re.search(r"\+1 \(\d{3}\) \d{3}-\d{4} from \d\d\.\d\d\.\d\d\.\d\d$", got[1].text)
    assert re.fullmatch(r"Г-жа [А-Я][а-я]+ [А-Я][а-я]+", got[3].text) and "Анна" not in got[3].text
    assert all(got[i].text == t and got[i].n_entities == 0 for i, t in enumerate(texts) if i > 3)


def test_surrogates_are_distinct(spark):
    values = [("ip", f"{a}.{b}.1.1") for a in range(1, 10) for b in range(1, 10)] + [("given_m", f"n{i}") for i in range(300)]
    got = pii.surrogates(spark.createDataFrame(values, "kind string, value string"), "k").collect()
    assert len(got) == len(values) == len({(r.kind, r.surrogate) for r in got}) and all(r.value != r.surrogate for r in got)


def test_archive_round_trip(spark):
    inner = "WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:99>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    long = "päge\r\n" * 40
    rows = [(1, "u", long), (2, "u\nv", long), (3, "u", inner * 3), (4, None, None), (5, "u", "short"), (6, "u", "short"), (None, "u", long), (7, "u", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    got = {r.page_id: r for r in warc.archived(pages).collect()}
    assert set(got) == {1, 2, 3, 4, 5, 6, 7, None}
    for i, _, html in rows:
        body = (html or "").encode()
        assert (got[i].payload_bytes, got[i].payload_digest) == (len(body), hashlib.sha256(body).hexdigest())
        again = i in (2, None)
        assert (got[i].record_type, got[i].refers_to) == (("revisit", 1) if again else ("response", None))


def test_archive_of_long_addresses_and_pages(spark):
    url = "data:," + "x" * 100_000
    rows = [(1, url, "p" * 200), (2, "u", "WARC/1.0\r\n" * 40_000), (3, url, "p" * 200), (4, "u", "q" * 300_000 + "\r\n\r\n" + "WARC/1.0\r\n"), (5, "v", "short")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    got = {r.page_id: r for r in warc.archived(pages).collect()}
    assert {i: (r.payload_bytes, r.record_type, r.refers_to) for i, r in got.items()} == {
        1: (200, "response", None), 2: (400_000, "response", None), 3: (200, "revisit", 1), 4: (300_014, "response", None), 5: (5, "response", None)}
    assert all(got[i].payload_digest == hashlib.sha256(html.encode()).hexdigest() for i, _, html in rows)
    assert warc.archived(pages.limit(0)).count() == 0


def test_broken_chain_is_refused():
    offset, following = np.array([0, 10, 20]), np.array([10, 20, 31])
    with pytest.raises(ValueError):
        warc.reached(offset, following, 30)
    assert warc.reached(np.array([0, 4, 10]), np.array([10, 9, 30]), 30).tolist() == [True, False, True]


def test_every_operator_is_registered():
    assert {n.split("_")[0] for n in QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(CHECKS) <= set(QUERIES) and sum(SHARES.values()) == 50


def test_bitmaps_keep_every_pair_at_the_threshold(spark):
    draw = np.random.default_rng(5)
    base = draw.integers(0, 1 << 63, 400, dtype=np.uint64)
    sets, rows = [], []
    for k in range(60):
        size = int(draw.integers(1, 400))
        shingles = np.concatenate([base[:size], draw.integers(0, 1 << 63, k % 20, dtype=np.uint64), base[: k % 3]])
        sets.append(set(shingles.tolist()))
        fact = paragraphs._facts(shingles, np.array([0, len(shingles)])).view(np.int64)[0]
        assert fact[0] == len(sets[-1])
        rows.append((k, fact.tolist()))
    facts = spark.createDataFrame(rows, "k int, f array<bigint>")
    pairs = facts.selectExpr("k a", "f fa").crossJoin(facts.selectExpr("k b", "f fb"))
    kept = {(r.a, r.b) for r in pairs.where(paragraphs.can_reach(0.8, F.col("fa"), F.col("fb"))).select("a", "b").collect()}
    linked = {(a, b) for a in range(60) for b in range(60) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    assert linked <= kept and len(kept) < 1800


def test_changed_items_are_all_found():
    """Items of every length with as many edits as the similarity allows, in the middle of a text, and none that is further away."""
    draw = random.Random(31)
    vocabulary = ["".join(draw.choices("abcdefghij", k=6)) for _ in range(3000)]
    texts, items, held = [], [], []
    for words in [1, 2, 3, 4, 5, 6, 9, 12, 25, 45, 70] * 20:
        item = draw.sample(vocabulary, words)
        changed, edits = item[:], words // 5
        for at in draw.sample(range(words), edits):
            changed[at] = "x" + changed[at]
        if edits and draw.random() < 0.5:
            gone = changed.index(next(w for w in changed if w[0] == "x"))
            changed = changed[:gone] + changed[gone + 1 :]
        items.append(" ".join(item))
        texts.append(" ".join([f"a{len(texts)}", *changed, "after"]))
        held.append((words, edits))
    block = decontaminate.Block(list(range(len(items))), items, 0.8, 12)
    text, item, near = block.search(decontaminate.pa.array(texts))
    best = {}
    for t, i, s in zip(text.tolist(), item.tolist(), near.tolist()):
        best[t, i] = max(s, best.get((t, i), 0))
    assert all(best.get((k, k), 0) >= 1 - edits / words - 1e-9 for k, (words, edits) in enumerate(held))
    hand = lambda t, i: min(edit(items[i].split(), texts[t].split()[a:b]) for a in range(len(texts[t].split())) for b in range(a, len(texts[t].split()) + 1))
    for (t, i), s in draw.sample(sorted(best.items()), 12):
        if held[i][0] < 13 and held[t][0] < 13:
            assert abs(s - (1 - hand(t, i) / held[i][0])) < 1e-9


def test_lines_alike_in_keys_only_make_no_pairs(spark, monkeypatch):
    """Lines that share their longer words but no short ones meet in all keys; no pair of them is handed to the edit distance."""
    longer = "several remarkably lengthy words everywhere repeated within sentences containing templates forever"
    texts = [f"{longer} " + " ".join(f"{k % 10}{c}{k // 10}" for c in "abcdef") for k in range(60)]
    seen, link = [], lines.linked_classes

    def counting(members, verify, *given):
        def counted(pairs):
            seen.append(pairs.count())
            return verify(pairs)

        return link(members, counted, *given)

    monkeypatch.setattr(lines, "linked_classes", counting)
    got = lines.dedupe_lines(docs_of(spark, texts)).collect()
    assert sum(r.n_removed for r in got) == 0 and seen and sum(seen) <= 6


@pytest.mark.parametrize(("words", "run"), [(100, 8), (30, 12)])
def test_lines_with_common_runs_make_no_pairs(spark, monkeypatch, words, run):
    """Lines that share runs of words and are not near meet in no block: not in short runs of long lines, nor in runs that stand elsewhere."""
    draw = random.Random(47)
    word = lambda: "".join(draw.choices("abcdefghijklm", k=7))
    common = [[word() for _ in range(run)] for _ in range(words // 20)]
    texts = []
    for k in range(40):
        parts = [*[[*c, word()] for c in common], *[[word()] for _ in range(words - (run + 1) * len(common))]]
        if words > 50:
            draw.shuffle(parts)
        else:
            parts = parts[1 : 2 + k % 10] + parts[:1] + parts[2 + k % 10 :]
        texts.append(" ".join(w for part in parts for w in part))
    seen, link = [], lines.linked_classes

    def counting(members, verify, *given):
        seen.append(members.groupBy("bucket").count().where("count > 1").count())
        return link(members, verify, *given)

    monkeypatch.setattr(lines, "linked_classes", counting)
    got = lines.dedupe_lines(docs_of(spark, texts)).collect()
    assert len(got) == 40 and sum(r.n_removed for r in got) == 0 and seen == [0]


@pytest.mark.parametrize("similarity", [0.95, 0.9, 0.8, 0.6])
def test_pieces_meet_within_the_edits(similarity):
    """Of lines within the edits, however these stand, one piece is the same words at places that both look at."""
    draw, met = random.Random(48), 0
    first = lines.first_banded(similarity)
    assert first > lines.least_near(similarity) + 1 and lines.bands(similarity)[0][0] == first
    for _ in range(2000):
        line = [draw.random() for _ in range(draw.randrange(lines.least_near(similarity) + 1, first))]
        other = line[:]
        for _ in range(lines.most_edits(similarity, len(line))):
            at, kind = draw.randrange(len(other)), draw.randrange(3)
            other[at : at + 1] = [[draw.random()], [], [other[at], draw.random()][: 1 + (len(other) < len(line))]][kind]
        one, two = [{(n, i, tuple(x[at : at + size])) for n, i, at, size in lines.pieces(similarity, len(x))} for x in (line, other)]
        assert one & two
        met += len(other) < len(line)
    assert met > 100


def test_equal_short_lines_are_cut_where_asked_for(spark, tmp_path):
    texts = ["Read more.\n----\n\none", "read MORE\n----\n\n这是一个没有空格的重复的句子", "这是一个没有空格的重复的句子。\nread less"]
    docs_of(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.n_removed, r.kept_sha256) for r in QUERIES["op1_line_dedup"](spark, str(tmp_path)).collect()}
    left = [texts[0], "----\n\n这是一个没有空格的重复的句子", "read less"]
    assert got == {i: (min(i, 1), hashlib.sha256(t.encode()).hexdigest()) for i, t in enumerate(left)}


def test_near_texts_against_all_pairs(spark):
    draw = random.Random(5)
    words = ["w%d" % k for k in range(4000)]
    texts, base = [], [[draw.choice(words) for _ in range(n)] for n in (60, 120, 400) for _ in range(60)]
    for text in base:
        texts.append(text)
        for changes in (1, len(text) // 60, len(text) // 20):
            near = list(text)
            for at in draw.sample(range(len(near)), changes):
                near[at] = draw.choice(words)
            texts.append(near)
    docs = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "doc_id bigint, text string")
    group = {r.id: r.group for r in simhash.near_texts(docs).collect()}
    shingles = [{tuple(t[k : k + 5]) for k in range(len(t) - 4)} for t in texts]
    similar = [(a, b, len(shingles[a] & shingles[b]) / len(shingles[a] | shingles[b])) for k in range(0, len(texts), 4) for a in range(k, k + 4) for b in range(a)
               if b >= k]
    found = [group[a] == group[b] for a, b, near in similar if near >= 0.8]
    assert len(found) > 200 and sum(found) >= 0.9 * len(found)
    # Groups are chains of links: each member has a near one in its group, not all are near each other.
    nearest = {}
    for a, b, near in similar:
        if group[a] == group[b]:
            nearest[a], nearest[b] = max(near, nearest.get(a, 0)), max(near, nearest.get(b, 0))
    assert min(nearest.values()) >= 0.55
    # Texts of different origin are never joined.
    assert all(len({k // 4 for k in group if group[k] == g}) == 1 for g in set(group.values()))
    assert simhash.near_texts(docs.limit(0)).count() == 0


def test_texts_two_bits_apart_share_an_anchor(spark):
    draw = random.Random(3)
    values = [draw.getrandbits(31) for _ in range(300)]
    rows = [(k, [v if not way else v ^ 1 << way - 1 ^ (1 << other - 1 if other else 0)]) for k, v in enumerate(values)
            for way, other in ((0, 0), (k % 31 + 1, 0), (k % 31 + 1, (k + 1 + k % 29) % 31 + 1)) if way != other or not way]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(rows))), pa.array([p for _, p in rows], pa.list_(pa.int64()))], ["node", "prints"])
    at = {}
    for out in simhash._covering([batch]):
        for bucket, node in zip(out.column(0).to_pylist(), out.column(1).to_pylist()):
            if bucket < 1 << 31:
                at.setdefault(node, set()).add(bucket)
    for one in range(len(rows)):
        for two in range(one + 1, min(one + 3, len(rows))):
            if rows[one][0] == rows[two][0] and (rows[one][1][0] ^ rows[two][1][0]).bit_count() <= 2:
                assert at[one] & at[two]


def test_toxicity_fit_does_not_depend_on_partitions(spark, sf):
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    one, two = toxicity.learn(docs.repartition(7), labels), toxicity.learn(docs.repartition(2, "text"), labels.repartition(3))
    assert one.bias == two.bias and (one.weights == two.weights).all()


def test_toxicity_fit_sends_only_slots_with_a_weight_to_the_driver(spark, monkeypatch):
    """Of long texts with few telling n-grams the driver gets these n-grams alone."""
    draw, seen, logistic = random.Random(41), [], toxicity._logistic
    monkeypatch.setattr(toxicity, "_order", lambda rows, order=toxicity._order: seen.append(rows.nbytes) or order(rows))
    monkeypatch.setattr(toxicity, "_logistic", lambda cells, *rest: seen.append(len(cells)) or logistic(cells, *rest))
    texts = [" ".join(draw.choices(["".join(draw.choices("abcdefghijklmnop", k=6)) for _ in range(40)], k=150) + ["zzzqq"] * (i % 2)) for i in range(80)]
    docs = docs_of(spark, texts)
    model = toxicity.fit(docs, docs.selectExpr("doc_id", "cast(doc_id % 2 as int) as label"))
    assert np.count_nonzero(model.weights) > 0
    assert seen[0] < 80 * 200 + 4 * seen[1] and seen[1] < 80 * 60


def test_walks_reach_the_recall_by_length_and_edits():
    """Walks alone, items of 12 words and more, against the edit distance of every run of words."""
    draw = random.Random(77)
    vocabulary = ["".join(draw.choices("abcdefghij", k=6)) for _ in range(2000)]
    items = [draw.choices(vocabulary, k=n) for n in (12, 16, 24, 40, 90) for _ in range(40)]
    tables = decontaminate.tables_needed([" ".join(i) for i in items], 0.8, 0.99)
    block = decontaminate.Block(list(range(len(items))), [" ".join(i) for i in items], 0.8, tables)
    assert not block.runs and 0 < tables < 12
    for part in (0.0, 0.1, 0.2, 0.35):
        texts = []
        for item in items:
            changed = decontaminate.edited(np.array(range(1, len(item) + 1), dtype=np.uint64), int(part * len(item)), draw).tolist()
            words = [item[w - 1] if w <= len(item) else f"x{w}" for w in changed]
            texts.append(draw.choices(vocabulary, k=draw.randrange(30)) + words + draw.choices(vocabulary, k=draw.randrange(30)))
        text, item, near = block.search(decontaminate.pa.array([" ".join(t) for t in texts]))
        found = set(zip(text.tolist(), item.tolist()))

        def apart(words, text):
            row = [0] * (len(text) + 1)
            for i, word in enumerate(words):
                new = [i + 1]
                for j, other in enumerate(text):
                    new.append(min(row[j] + (word != other), row[j + 1] + 1, new[j] + 1))
                row = new
            return min(row)

        true = {(k, k) for k, words in enumerate(items) if apart(words, texts[k]) <= 0.2 * len(words) + 1e-9}
        assert found <= true and len(found) >= 0.97 * len(true)
        assert found == true or part


def test_decontamination_edges(spark):
    item = " ".join(f"w{k}" for k in range(30))
    benchmark = spark.createDataFrame([(1, item), (1, item), (2, None), (None, item), (3, "?!")], "item_id long, text string")
    rows = [(1, f"before {item} after", "x"), (1, f"before {item} after", "x"), (None, item.upper(), "y"), (2, None, "z"), (3, "", None), (4, "word " * 20_000, "long")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `_items` string")
    got = decontaminate.contamination(docs, benchmark, columns=docs.columns).collect()
    assert sorted((str(r.doc_id), r["_items"] or "", r.contaminated, tuple(r.item_ids)) for r in got) == sorted(
        (str(i), e or "", bool(t) and "w3" in t.lower(), (1,) if t and "w3" in t.lower() else ()) for i, t, e in rows)
    assert decontaminate.contamination(docs.limit(0), benchmark).count() == 0


def test_lines_too_short_for_an_edit_are_near_none():
    for similarity in (0.5, 0.75, 0.8, 0.9, 0.95, 0.98):
        least = lines.least_near(similarity)
        near = [n for n in range(1, 80) for m in range(n, 160) for most in [int(m * (1 - similarity) + 1e-9)] if most >= max(1, m - n)]
        assert min(near) == least
    assert lines.least_near(1.0) > 1 << 30


def test_surrogates_of_whole_names_and_clashing_columns(spark):
    rows = [(1, "Mr. Jean-Luc Picard met Ms. O'Neil and Mrs. Ann D’Arcy-Smith.", "keep", 7, "p"), (1, "Mr. Jean-Luc Picard met Ms. O'Neil and Mrs. Ann D’Arcy-Smith.", "keep", 7, "p"),
            (None, "Mr. Picard's", "x", 8, "q"), (2, None, None, None, None), (3, "", "y", 9, "r")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, `_id` string, `_row` int, `_pieces` string").withColumn("_changes", F.lit("c"))
    out = pii.replace_entities(docs, "k")
    got = out.collect()
    assert out.columns == [*docs.columns, "n_entities", "kinds"]
    assert sorted(((r.doc_id, r["_id"], r["_row"], r["_pieces"], r["_changes"]) for r in got), key=str) == sorted(((i, a, b, c, "c") for i, _, a, b, c in rows), key=str)
    one, two = [r for r in got if r.doc_id == 1]
    assert one.text == two.text and one.n_entities == 5
    assert not any(part in one.text for part in ("Jean", "Luc", "Picard", "Neil", "D’Arcy", "Smith", "Ann "))
    alone = next(r for r in got if r.doc_id is None)
    assert alone.text.endswith("'s") and alone.text.split()[1][:-2] in one.text and alone.n_entities == 1
    assert pii.replace_entities(docs.limit(0), "k").count() == 0
