"""Prefix trie of conversations: local shards and a skeleton of splitter paths.

A conversation is its sequence of turns, and each distinct beginning of one is a node of the trie. The
sequences are range-partitioned by splitters, so that a shard holds an interval of their sorted order.
Only nodes on the path of a splitter can have members in more than one shard. The trie of
the splitter paths, the skeleton, travels to the shards: each walks its sorted conversations with one stack,
finishes all nodes outside the skeleton, and sends one partial aggregate for every node of the skeleton that it
meets. Partial aggregates are reduced by node. A conversation that a third of all rows repeat is cut by
its conversation ids, which are part of the splitters.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from corpusflow.session import materialise

#: Conversations whose first turns may be shared: those of one block of ids.
FAMILY = 20
SHARED_TURNS = 4
#: Bytes of a turn's mark in a path.
MARK = 16
#: Turns of a shard, conversations sampled for each splitter, and most nodes of a skeleton.
SHARD_TURNS, SAMPLED, MAX_SKELETON = 100_000, 32, 200_000
#: Ids that a skeleton node's list of endings takes in one row, and finished nodes sent at once.
ENDS, ROWS = 512, 8192
WORD = r"[^\x20\x09-\x0D]+"

NODE, PARTIAL, ENDING = 0, 1, 2
NODE_SCHEMA = (
    "kind int, conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, "
    "saved_tokens bigint, ends_sha256 string, sid bigint, shard bigint, seq bigint, words bigint, ids string"
)
FIELDS = [c.split(" ")[0] for c in NODE_SCHEMA.split(", ")]
TYPES = [{"int": pa.int32(), "bigint": pa.int64(), "string": pa.string()}[c.split(" ")[1]] for c in NODE_SCHEMA.split(", ")]


def rebuilt(convs: DataFrame) -> DataFrame:
    """(conv_id, path, words): the marks of the rebuilt turns one after the other, and their numbers of words."""
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    mark = F.md5(F.concat(F.length("_role").cast("string"), F.lit(":"), "_role", "_text"))
    turns = (
        convs.select(F.col("conv_id").cast("bigint").alias("conv_id"), "turn", empty("role").alias("_role"), empty("text").alias("_text"))
        .where(F.col("conv_id").isNotNull())
        .select(
            (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("family"), "conv_id", F.col("turn").isNotNull().alias("placed"),
            "turn", mark.alias("mark"), F.regexp_count("_text", F.lit(WORD)).cast("bigint").alias("words"),
        )
    )
    # One shuffle by family, which holds 20 conversations at most; what follows keeps its partitions.
    listed = turns.repartition("family").groupBy("family", "conv_id").agg(
        F.sort_array(F.collect_list(F.struct("placed", "turn", "mark", "words"))).alias("turns")
    )
    first = F.max(F.when(F.col("conv_id") == F.col("family"), F.slice("turns", 1, SHARED_TURNS - 1))).over(Window.partitionBy("family"))
    shared = (F.crc32(F.col("conv_id").cast("string")) % SHARED_TURNS).cast("int")
    own = F.slice("turns", shared + 1, F.greatest(F.size("turns") - shared, F.lit(0)))
    # A family without its first conversation shares nothing.
    begun = F.coalesce(F.slice("first", 1, shared), F.slice("turns", 1, 0))
    joined = listed.withColumn("first", first).select("conv_id", F.concat(begun, own).alias("turns"))
    return joined.select(
        "conv_id", F.unhex(F.array_join(F.transform("turns", lambda t: t["mark"]), "")).alias("path"),
        F.transform("turns", lambda t: t["words"]).alias("words"),
    )


@dataclass
class Skeleton:
    """The trie of the splitter paths; node 0 is the root, parents come before their children."""

    splitters: list[tuple[bytes, int]]
    child: dict[tuple[int, bytes], int] = field(default_factory=dict)
    parent: list[int] = field(default_factory=lambda: [-1])
    depth: list[int] = field(default_factory=lambda: [0])

    def __post_init__(self) -> None:
        for path, _ in self.splitters:
            at = 0
            for k in range(0, len(path), MARK):
                below = self.child.get((at, path[k : k + MARK]))
                if below is None:
                    below = self.child[at, path[k : k + MARK]] = len(self.parent)
                    self.parent.append(at)
                    self.depth.append(self.depth[at] + 1)
                at = below


def skeleton_of(sequences: DataFrame, shards: int) -> Skeleton:
    """Splitters that cut the sorted sequences into about ``shards`` parts of like size, and their trie.

    They are chosen from a sample by a hash of the id, which decides on the sizes of the shards only. Every
    second splitter goes until the trie has at most MAX_SKELETON nodes: what travels is bounded whatever
    the conversations hold.
    """
    total = max(sequences.count(), 1)
    share = min(1.0, SAMPLED * shards / total)
    rows = sequences.where(F.pmod(F.xxhash64("conv_id"), F.lit(1 << 30)) < int(share * (1 << 30))).select("path", "conv_id").collect()
    sampled = sorted((bytes(r.path), r.conv_id) for r in rows)
    weights = np.cumsum([len(path) // MARK + 1 for path, _ in sampled])
    wanted = (weights[-1] * np.arange(1, shards) / shards) if len(sampled) else []
    splitters = [sampled[k] for k in sorted({int(np.searchsorted(weights, w)) for w in wanted})]
    while True:
        made = Skeleton(splitters)
        if len(made.parent) <= MAX_SKELETON or not splitters:
            return made
        splitters = splitters[1::2]


class _Node:
    """A node on the walk's stack."""

    __slots__ = ("sid", "words", "conv", "convs", "children", "leaves", "saved", "ends", "hash", "waiting", "seq")

    def __init__(self, sid: int, words: int):
        self.sid, self.words = sid, words
        self.conv = self.hash = None
        self.convs = self.children = self.leaves = self.saved = self.seq = 0
        self.ends: list[int] = []
        self.waiting: list[list] = []


class Walk:
    """One pass over the sorted conversations of a shard; rows are finished as the walk leaves their nodes."""

    def __init__(self, skeleton: Skeleton, shard: int):
        self.skeleton, self.shard = skeleton, shard
        self.out: list[list] = []
        self.path = b""
        self.stack = [_Node(0, 0)]

    def add(self, conv: int, path: bytes, words: list[int]) -> None:
        depth, most = 0, min(len(self.path), len(path)) // MARK
        if path[: most * MARK] == self.path[: most * MARK]:
            depth = most
        else:
            while path[depth * MARK : (depth + 1) * MARK] == self.path[depth * MARK : (depth + 1) * MARK]:
                depth += 1
        while len(self.stack) > depth + 1:
            self.leave()
        for k in range(depth, len(path) // MARK):
            above = self.stack[-1].sid
            sid = self.skeleton.child.get((above, path[k * MARK : (k + 1) * MARK]), -1) if above >= 0 else -1
            self.stack.append(_Node(sid, words[k]))
        self.path = path
        node = self.stack[-1]
        node.convs += 1
        node.conv = conv if node.conv is None else min(node.conv, conv)
        if node.sid >= 0:
            node.ends.append(conv)
            if len(node.ends) == ENDS:
                self.end(node)
        elif node.hash is None:
            node.hash = hashlib.sha256(str(conv).encode())
        else:
            node.hash.update(f",{conv}".encode())

    def end(self, node: _Node) -> None:
        """Send the ids that end in a node of the skeleton so far."""
        row = dict(kind=ENDING, sid=node.sid, shard=self.shard, seq=node.seq, ids=",".join(map(str, node.ends)))
        self.out.append([row.get(c) for c in FIELDS])
        node.ends, node.seq = [], node.seq + 1

    def leave(self) -> None:
        node = self.stack.pop()
        above = self.stack[-1] if self.stack else None
        if node.sid >= 0:
            if node.ends:
                self.end(node)
            row = dict(kind=PARTIAL, conv_id=node.conv, n_convs=node.convs, n_children=node.children, n_leaves=node.leaves,
                       saved_tokens=node.saved, sid=node.sid, words=node.words)
            self.out.append([row.get(c) for c in FIELDS])
        else:
            node.leaves += not node.children
            node.saved += (node.convs - 1) * node.words
            digest = (node.hash or hashlib.sha256()).hexdigest()
            row = [NODE, node.conv, len(self.stack), None, node.convs, node.children, node.leaves, node.saved, digest, None, None, None, None, None]
            self.out.append(row)
            for waiting in node.waiting:
                waiting[3] = node.conv
            above.children += 1
            if above.sid >= 0:
                row[9] = above.sid
            else:
                above.waiting.append(row)
        if above is not None:
            above.convs += node.convs
            above.leaves += node.leaves
            above.saved += node.saved
            above.conv = node.conv if above.conv is None else min(above.conv, node.conv)

    def ready(self) -> list[list]:
        """The rows that wait for nothing, once there are enough and no open node outside the skeleton holds some back."""
        if len(self.out) < ROWS or self.stack[-1].sid < 0:
            return []
        rows, self.out = self.out, []
        return rows

    def close(self) -> list[list]:
        while self.stack:
            self.leave()
        rows, self.out = self.out, []
        return rows


def _batch(rows: list[list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), TYPES)], FIELDS)


def grown(sequences: DataFrame, skeleton: Skeleton) -> DataFrame:
    """Finished nodes, partial aggregates of skeleton nodes, and their lists of endings, told apart by ``kind``."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = zip(batch.column("path").to_pylist(), batch.column("conv_id").to_pylist())
            shard = pa.array([bisect_right(skeleton.splitters, key) for key in keys], pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns, shard], [*batch.schema.names, "shard"])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here = None
        for batch in batches:
            for conv, path, words, shard in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "path", "words", "shard"))):
                if here is None or here.shard != shard:
                    if here is not None:
                        yield _batch(here.close())
                    here = Walk(skeleton, shard)
                here.add(conv, path, words)
                if rows := here.ready():
                    yield _batch(rows)
        if here is not None:
            yield _batch(here.close())

    dealt = sequences.mapInArrow(deal, "conv_id bigint, path binary, words array<bigint>, shard int")
    placed = dealt.repartitionById(len(skeleton.splitters) + 1, F.col("shard")).sortWithinPartitions("shard", "path", "conv_id")
    return placed.mapInArrow(walk, NODE_SCHEMA)


def ends_of(endings: DataFrame) -> DataFrame:
    """(sid, ends_sha256): the digest of the ids that end in each skeleton node, fed in order piece by piece."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple[int, str]] = []
        sid = state = None
        for batch in batches:
            for node, ids in zip(batch.column("sid").to_pylist(), batch.column("ids").to_pylist()):
                if node == sid:
                    state.update(f",{ids}".encode())
                    continue
                if state is not None:
                    done.append((sid, state.hexdigest()))
                sid, state = node, hashlib.sha256(ids.encode())
        if state is not None:
            done.append((sid, state.hexdigest()))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([d[k] for d in done]) for k in (0, 1)], ["sid", "ends_sha256"])

    ordered = endings.select("sid", "shard", "seq", "ids").repartition("sid").sortWithinPartitions("sid", "shard", "seq")
    return ordered.select("sid", "ids").mapInArrow(digest, "sid bigint, ends_sha256 string")


def finished(parts: DataFrame, endings: DataFrame, skeleton: Skeleton) -> DataFrame:
    """The nodes of the skeleton from the reduced partial aggregates; at most MAX_SKELETON rows."""
    nothing = hashlib.sha256().hexdigest()

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = {r["sid"]: r for batch in batches for r in batch.to_pylist()}
        leaves, saved = [0] * len(skeleton.parent), [0] * len(skeleton.parent)
        children = np.bincount(np.array(skeleton.parent[1:], dtype=np.int64), minlength=len(skeleton.parent))
        out = []
        for sid in range(len(skeleton.parent) - 1, -1, -1):
            if sid not in rows:
                continue
            row, above = rows[sid], skeleton.parent[sid]
            row["n_children"] += int(children[sid])
            # What the shards sent holds all nodes below but those of the skeleton, whose own shares are added here.
            leaves[sid] += not row["n_children"]
            saved[sid] += (row["n_convs"] - 1) * row["words"]
            if above >= 0:
                leaves[above] += leaves[sid]
                saved[above] += saved[sid]
            row["n_leaves"] += leaves[sid]
            row["saved_tokens"] += saved[sid]
            row["depth"], row["parent_conv_id"] = skeleton.depth[sid], rows[above]["conv_id"] if above >= 0 else None
            row["ends_sha256"] = row["ends_sha256"] or nothing
            out.append([row[c] for c in FIELDS[1:10]])
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), TYPES[1:10])], FIELDS[1:10])

    reduced = parts.groupBy("sid").agg(
        F.min("conv_id").alias("conv_id"), F.max("words").alias("words"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
    )
    schema = ", ".join(c for c in NODE_SCHEMA.split(", ")[1:10])
    return reduced.join(ends_of(endings), "sid", "left").repartition(1).mapInArrow(finish, schema)


def prefix_trie(convs: DataFrame, shards: int | None = None) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) of every node.

    Conversations are ordered by turn, null first, turns of one number by the md5 of role and text; a null
    role or text counts as empty, repeated rows are turns of their own, rows without a conversation id are
    left out, other columns are not read. The first h turns (h: crc32 of the decimal id modulo 4) come
    from the first conversation of the id's family of 20; turns are told apart by md5. An empty table
    gives no node. A conversation's marks (16 bytes a turn) make one row, its texts do not.

    ``shards`` defaults to the number of shuffle partitions, or as many as keep SHARD_TURNS a shard.
    """
    spark: SparkSession = convs.sparkSession
    sequences = materialise(rebuilt(convs), "sequences")
    if shards is None:
        turns = sequences.agg(F.coalesce(F.sum(F.size("words") + 1), F.lit(0))).first()[0]
        shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), turns // SHARD_TURNS + 1)
    skeleton = skeleton_of(sequences, shards)
    rows = materialise(grown(sequences, skeleton), "nodes")
    names = FIELDS[1:9]
    of = lambda kind: rows.where(F.col("kind") == kind)
    shared = materialise(finished(of(PARTIAL), of(ENDING), skeleton), "skeleton")
    # At most MAX_SKELETON rows of two numbers.
    above = F.broadcast(shared.select(F.col("sid").alias("_sid"), F.col("conv_id").alias("_above")))
    local = of(NODE).join(above, F.col("sid") == F.col("_sid"), "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "_above"))
    return local.select(*names).unionByName(shared.select(*names))


_CRC = (
    "list_reduce(list_transform(string_split(CAST({} AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)), "
    "lambda c, b: xor(c >> 8, list_reduce(range(8), lambda r, k: CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END, "
    "xor(c, b) & 255)), 4294967295)"
)


def trie_sql(table: str = "conversations") -> str:
    """SQL of ``prefix_trie``, with every prefix of every conversation as a row."""
    shared = f"(xor({_CRC.format('c.conv_id')}, 4294967295) % {SHARED_TURNS})"
    return f"""
WITH marked AS (
    SELECT conv_id, turn, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS mark,
        CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS words
    FROM {table} WHERE conv_id IS NOT NULL),
listed AS (SELECT conv_id, list({{'mark': mark, 'words': words}} ORDER BY turn NULLS FIRST, mark) AS turns FROM marked GROUP BY conv_id),
sequences AS (
    SELECT c.conv_id, list_concat(coalesce(f.turns[1:{shared}], []), c.turns[{shared} + 1:]) AS turns
    FROM listed c LEFT JOIN listed f ON f.conv_id = c.conv_id - c.conv_id % {FAMILY}),
prefixes AS (
    SELECT conv_id, d, len(turns) AS size, md5(array_to_string(list_transform(turns[1:d], lambda t: t.mark), ',')) AS node,
        md5(array_to_string(list_transform(turns[1:d - 1], lambda t: t.mark), ',')) AS above,
        CASE WHEN d > 0 THEN turns[d].words ELSE 0 END AS words
    FROM (SELECT *, unnest(range(len(turns) + 1)) AS d FROM sequences)),
nodes AS (
    SELECT node, d, any_value(above) AS above, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
        sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (size = d), '')) AS ends_sha256
    FROM prefixes GROUP BY node, d),
counted AS (
    SELECT n.*, (SELECT count(*) FROM nodes c WHERE c.d = n.d + 1 AND c.above = n.node) AS n_children FROM nodes n),
held AS (
    SELECT p.node, p.d, sum(CASE WHEN c.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((c.n_convs - 1) * c.words) AS saved_tokens
    FROM counted c JOIN prefixes p ON p.conv_id = c.conv_id AND p.d <= c.d GROUP BY p.node, p.d)
SELECT n.conv_id, n.d AS depth, a.conv_id AS parent_conv_id, n.n_convs, n.n_children, CAST(h.n_leaves AS BIGINT) AS n_leaves,
    CAST(h.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM counted n JOIN held h ON h.node = n.node AND h.d = n.d
LEFT JOIN nodes a ON n.d > 0 AND a.d = n.d - 1 AND a.node = n.above"""
