"""The prefix trie of conversations against plain loops, its shards, and its edge cases."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from corpusflow.llm import turntrie
from corpusflow.llm.queries import QUERIES
from corpusflow.llm.tables import table

SCHEMA = "conv_id long, turn long, role string, text string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain(rows):
    """Nodes of the trie from the rule; turns of one number by the md5 of their role and text."""
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            mark = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            turns[conv].append(((turn is not None, turn or 0, mark), role, text))
    ordered = {c: [(r, t) for _, r, t in sorted(x)] for c, x in turns.items()}
    made = {}
    for c, own in ordered.items():
        h = zlib.crc32(str(c).encode()) % 4
        made[c] = ordered.get(c - c % 20, [])[:h] + own[h:]
    members = defaultdict(list)
    for c in sorted(made):
        for d in range(len(made[c]) + 1):
            members[tuple(made[c][:d])].append(c)
    out, children = {}, defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    for path in sorted(members, key=len, reverse=True):
        below = children[path]
        words = len(WORD.findall(path[-1][1])) if path else 0
        ends = ",".join(str(c) for c in members[path] if len(made[c]) == len(path))
        out[path] = (
            members[path][0], len(path), members[path[:-1]][0] if path else None, len(members[path]), len(below),
            sum(out[b][5] for b in below) or 1, sum(out[b][6] for b in below) + (len(members[path]) - 1) * words,
            hashlib.sha256(ends.encode()).hexdigest(),
        )
    return sorted(out.values(), key=lambda n: n[:2])


def grown(spark, rows, **options):
    frame = rows if not isinstance(rows, list) else spark.createDataFrame(rows, SCHEMA)
    return sorted((tuple(r[n] for n in NAMES) for r in turntrie.prefix_trie(frame, **options).collect()), key=lambda n: n[:2])


def some_rows(seed, convs=150, texts=4):
    draw = random.Random(seed)
    rows = []
    for c in draw.sample(range(400), convs):
        rows += [(c, k, draw.choice(["user", "assistant"]), " ".join(["w"] * draw.randint(0, texts))) for k in range(draw.randint(1, 6))]
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("shards", [1, 2, 7, 40])
def test_equal_to_plain_loops_for_any_number_of_shards(spark, shards):
    rows = some_rows(shards)
    assert grown(spark, rows, shards=shards) == plain(rows)


def test_a_hot_conversation_is_cut_into_shards(spark, monkeypatch):
    monkeypatch.setattr(turntrie, "ENDS", 3)
    monkeypatch.setattr(turntrie, "ROWS", 5)
    # Multiples of 20 with equal turns: copies of one conversation, whatever their first turns.
    rows = [(c * 20, k, "user", f"turn {k}") for c in range(300) for k in range(3)] + some_rows(3)
    assert grown(spark, rows, shards=9) == plain(rows)
    sequences = turntrie.rebuilt(spark.createDataFrame(rows, SCHEMA))
    skeleton = turntrie.skeleton_of(sequences, 9)
    assert len({path for path, _ in skeleton.splitters}) < len(skeleton.splitters)


def test_a_skeleton_is_bounded(spark, monkeypatch):
    rows = some_rows(11)
    monkeypatch.setattr(turntrie, "MAX_SKELETON", 6)
    sequences = turntrie.rebuilt(spark.createDataFrame(rows, SCHEMA))
    assert len(turntrie.skeleton_of(sequences, 40).parent) <= 6
    assert grown(spark, rows, shards=40) == plain(rows)
    monkeypatch.setattr(turntrie, "MAX_SKELETON", 1)
    assert grown(spark, rows, shards=40) == plain(rows)


def test_edges(spark):
    long = "word " * 50_000
    rows = [
        (None, 1, "user", "lost"), (1, None, "user", "first"), (1, 0, None, None), (1, 0, None, None), (1, 0, "b", "a"), (1, 0, "a", "b"),
        (2, 5, "user", long), (2, 7, "x", ""), (22, 1, "user", "only"), (3, 1, "user", "only"), (3, 2, "", "user"), (40, 1, "u", "é　x\ty"),
        (41, 1, "u", "z"), (42, 1, "u", "z"), (43, 9, "u", "z"),
    ] + [(60, k, "user", str(k)) for k in range(500)] + [(61, k, "user", str(k)) for k in range(400)]
    assert grown(spark, rows) == plain(rows)
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' as path", "1 as words", "2 as family", "3 as mark", "4 as _role", "5 as sid")
    assert grown(spark, frame) == plain(rows)
    assert grown(spark, [r for r in rows if r[0] is None]) == []
    assert turntrie.prefix_trie(spark.createDataFrame([], SCHEMA)).collect() == []


def test_a_turnless_conversation_is_a_member_of_the_root(spark):
    lone = next(c for c in range(21, 400) if c % 20 and zlib.crc32(str(c).encode()) % 4 >= 1)
    rows = [(lone, 0, "user", "gone")]
    assert grown(spark, rows) == plain(rows)
    assert len(plain(rows)) == 1 and plain(rows)[0][3] == 1


def test_query_over_the_table(spark, sf):
    rows = [tuple(r) for r in table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").collect()]
    got = sorted((tuple(r[n] for n in NAMES) for r in QUERIES["op11_turn_trie"](spark, sf).collect()), key=lambda n: n[:2])
    assert got == plain(rows)
