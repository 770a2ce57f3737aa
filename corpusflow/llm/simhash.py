"""SimHash near-duplicates by anchor-point covering.

Two fingerprints that differ in at most three bits differ in at most one bit of one of two 31-bit
blocks. The words of the perfect Hamming code of length 31 are the anchors of a block: every value
lies within one bit of an anchor (covering radius 1), so two values one bit apart share an anchor
within two bits (radius plus threshold) of both. Each distinct fingerprint is replicated to all
anchors within two bits of its blocks, 16 at most in either, and compared inside the anchors.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from corpusflow.llm.linking import linked_classes
from corpusflow.llm.textbytes import mix
from corpusflow.session import materialise

BITS = 64
SEED = 42
#: Length of the Hamming code and its parity bits.
LENGTH, PARITY = 31, 5
#: Bits of the first fingerprint that a node's number in ``near_texts`` carries.
CARRIED = 32
#: Most shingles whose bits are unpacked at once.
BLOCK = 1 << 16


def shingle_digests(text: bytes, width: int) -> np.ndarray:
    """Hashes of the ``width``-word shingles of a text, repeats included; none for a text without words."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    joined = b" ".join(words)
    ends = (np.cumsum([len(w) for w in words]) + np.arange(len(words))).tolist()
    starts = [0, *[e + 1 for e in ends[:-1]]]
    digest = xxhash.xxh64_intdigest
    last = ends[width - 1 :] or ends[-1:]
    return np.array([digest(joined[s:e], SEED) for s, e in zip(starts, last)], dtype=np.uint64)


def majority(hashes: np.ndarray) -> int:
    """The bits set in over half the hashes; 0 for none."""
    rows = hashes.astype(">u8").view(np.uint8).reshape(-1, 8)
    counts = np.zeros(BITS, dtype=np.int64)
    for k in range(0, len(rows), BLOCK):
        counts += np.unpackbits(rows[k : k + BLOCK], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(rows)).tobytes(), "big", signed=True)


def fingerprint(text: bytes, width: int) -> int:
    """SimHash of the ``width``-word shingles of a text; 0 for a text without words."""
    return majority(shingle_digests(text, width))


def fingerprints(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """(id, fp) of every document, fp as a signed long. One pass over the texts, no shuffle."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(t.as_buffer().to_pybytes() if t.is_valid else b"", width) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints, pa.int64())], ["id", "fp"])

    narrow = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    return narrow.mapInArrow(scan, "id bigint, fp bigint")


def anchors(value: Column) -> Column:
    """All words of the Hamming code within two bits of a 31-bit value."""
    syndrome = F.lit(0)
    for k in range(PARITY):
        mask = sum(1 << (p - 1) for p in range(1, LENGTH + 1) if p >> k & 1)
        syndrome = syndrome.bitwiseOR(F.shiftleft(F.bit_count(value.bitwiseAND(F.lit(mask))) % 2, k))

    def flip(position: Column) -> Column:
        return F.when(position == 0, F.lit(0).cast("bigint")).otherwise(
            F.call_function("shiftleft", F.lit(1).cast("bigint"), (position - 1).cast("int"))
        )

    def near(i: Column) -> Column:
        # Position 0 stands for no flip: i = 0 gives the code word one bit away.
        return value.bitwiseXOR(flip(i)).bitwiseXOR(flip(i.bitwiseXOR(syndrome)))

    flips = F.filter(F.sequence(F.lit(0), F.lit(LENGTH)), lambda i: i < i.bitwiseXOR(syndrome))
    return F.when(syndrome == 0, F.array(value)).otherwise(F.transform(flips, near))


def covered(prints: DataFrame) -> DataFrame:
    """(bucket, node): every fingerprint at every anchor near one of its blocks."""

    def buckets_of(block: int) -> Column:
        value = F.shiftrightunsigned("node", block * LENGTH).bitwiseAND(F.lit((1 << LENGTH) - 1))
        return F.transform(anchors(value), lambda anchor: anchor + F.lit(block << LENGTH))

    buckets = [buckets_of(block) for block in range(2)]
    return prints.select(F.explode(F.concat(*buckets)).alias("bucket"), "node")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, distance: int = 3
) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every document.

    ``component_id`` is the smallest id that links reach, where a link is a difference of at most
    ``distance`` (0 to 3) fingerprint bits. Texts are lower-cased in A-Z, null counts as empty; texts
    without words have fingerprint zero and are linked like any other. Rows keep their number; a
    null id gives a row of its own, and a component of null ids alone has a null id. Other columns
    are not read. An empty table gives an empty result.
    """
    if not 0 <= distance <= 3:
        raise ValueError("two blocks cover a distance of three bits at most")
    prints = materialise(fingerprints(docs, id_col, text_col, width), "prints")
    firsts = prints.groupBy(F.col("fp").alias("node")).agg(F.min("id").alias("first"))

    def near(a: Column, b: Column) -> Column:
        return F.bit_count(a.bitwiseXOR(b)) <= distance

    # The condition is exact: pairs that meet it are links.
    classes = linked_classes(covered(firsts), lambda pairs: pairs, near)
    # Copies make files of fingerprints small for their rows, so none of these joins is left to Spark's estimate.
    placed = firsts.join(classes.hint("merge"), "node", "left").select("node", "first", F.coalesce("component", "node").alias("class"))
    smallest = placed.groupBy("class").agg(F.min("first").alias("component_id"))
    by_print = placed.join(smallest.hint("merge"), "class").select(F.col("node").alias("fp"), "component_id")
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return prints.join(by_print.hint("merge"), "fp").select(F.col("id").alias(id_col), hexed.alias("fingerprint"), "component_id")


def differing(similarity: float) -> float:
    """Chance that a bit differs between texts of this Jaccard similarity of shingles: the angle of the sets over pi."""
    return math.acos(min(2 * similarity / (1 + similarity), 1.0)) / math.pi


def share_an_anchor(similarity: float) -> float:
    """Chance that a block of two such texts has a common anchor. Values up to two bits apart always have one, and of
    those three or four bits apart the ones whose syndrome is the sum of one or two of the differing places."""
    p = differing(similarity)
    chance = [math.comb(LENGTH, d) * p**d * (1 - p) ** (LENGTH - d) for d in range(5)]
    return sum(chance[:3]) + 6 / (LENGTH + 1) * sum(chance[3:])


def plan(similarity: float, recall: float) -> tuple[int, int, int]:
    """Number of fingerprints, most differing bits of all of them, and most of the carried half of the first one, for this recall at the similarity."""
    p, part = differing(similarity), math.sqrt(recall)
    number = 1 if p == 0 else max(1, math.ceil(math.log(1 - part) / math.log(1 - share_an_anchor(similarity)) / 2))

    def most(bits: int, deviations: float) -> int:
        return min(bits, math.floor(bits * p + deviations * math.sqrt(bits * p * (1 - p))))

    return number, most(number * BITS, NormalDist().inv_cdf(part)), most(CARRIED, 4)


def _error_masks() -> np.ndarray:
    """By syndrome: the 16 patterns of one or two bits that lead to a code word. Row 0 is not used."""
    flip = np.array([0, *[1 << (i - 1) for i in range(1, LENGTH + 1)]], dtype=np.uint64)
    out = np.zeros((LENGTH + 1, (LENGTH + 1) // 2), dtype=np.uint64)
    for s in range(1, LENGTH + 1):
        out[s] = [flip[i] ^ flip[i ^ s] for i in range(LENGTH + 1) if i < i ^ s]
    return out


def _covering(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(bucket, node) of (node, prints): both blocks of every fingerprint at every anchor near them."""
    errors = _error_masks()
    parity = [np.uint64(sum(1 << (p - 1) for p in range(1, LENGTH + 1) if p >> k & 1)) for k in range(PARITY)]
    for batch in batches:
        for part in (batch.slice(k, 1 << 12) for k in range(0, batch.num_rows, 1 << 12)):
            nodes = part.column(0).to_numpy()
            prints = part.column(1).flatten().to_numpy().view(np.uint64).reshape(len(nodes), -1)
            for number in range(2 * prints.shape[1]):
                value = prints[:, number // 2] >> np.uint64(number % 2 * LENGTH) & np.uint64((1 << LENGTH) - 1)
                syndrome = sum((np.bitwise_count(value & m).astype(np.int64) & 1) << k for k, m in enumerate(parity))
                code = syndrome == 0
                near = np.concatenate([(value[~code, None] ^ errors[syndrome[~code]]).ravel(), value[code]])
                node = np.concatenate([np.repeat(nodes[~code], errors.shape[1]), nodes[code]])
                bucket = (near + np.uint64(number << LENGTH)).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(node)], ["bucket", "node"])


def row_hash(docs: DataFrame) -> Column:
    """Tells apart rows that differ in any column but maps."""
    return F.xxhash64(*[F.col(f"`{f.name}`") for f in docs.schema.fields if not isinstance(f.dataType, T.MapType)])


def near_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, similarity: float = 0.8,
               recall: float = 0.8) -> DataFrame:
    """(id, row, group) of every row of ``docs``; ``row`` is ``row_hash(docs)``, and ``group`` is the same for rows that links join.

    Links are what several fingerprints say of the Jaccard similarity of the ``width``-word shingles (repeats included): pairs at ``similarity``
    are found with a chance of ``recall``, closer ones with a greater, equal ones always. Words and short texts are as in
    ``near_duplicates``; null and empty texts are equal. A null id is passed on. An empty table gives an empty result.
    """
    number, most, most_carried = plan(similarity, recall)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns = [mix(np.array([k], dtype=np.uint64)) for k in range(number)]
        for batch in batches:
            found = []
            for text in batch.column(2):
                digests = shingle_digests(text.as_buffer().to_pybytes() if text.is_valid else b"", width)
                found.append([majority(digests if k == 0 else mix(digests ^ turn)) for k, turn in enumerate(turns)])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.int64()))], ["id", "row", "prints"])

    narrow = docs.select(
        F.col(f"`{id_col}`").cast("bigint").alias("id"), row_hash(docs).alias("row"), F.col(f"`{text_col}`").cast("string").cast("binary").alias("text")
    )
    printed = narrow.mapInArrow(scan, "id bigint, row bigint, prints array<bigint>")
    # Texts of the same fingerprints are one node; its number keeps the first one, so that joins can test the distance of that.
    printed = materialise(printed.withColumn("key", F.xxhash64("prints")), "prints")
    low = F.col("key").bitwiseAND(F.lit((1 << (BITS - CARRIED)) - 1))
    named = printed.withColumn("node", F.shiftleft(F.element_at("prints", 1), BITS - CARRIED).bitwiseOR(low))
    nodes = materialise(named.select("node", "prints").dropDuplicates(["node"]), "nodes")

    def close(a: Column, b: Column) -> Column:
        return F.bit_count(F.shiftrightunsigned(a.bitwiseXOR(b), BITS - CARRIED)) <= most_carried

    def verify(pairs: DataFrame) -> DataFrame:
        one, two = [nodes.select(F.col("node").alias(c), F.col("prints").alias(f"_{c}")) for c in ("a", "b")]
        apart = [F.bit_count(F.get("_a", F.lit(k)).bitwiseXOR(F.get("_b", F.lit(k)))) for k in range(number)]
        return pairs.join(one, "a").join(two, "b").where(sum(apart[1:], apart[0]) <= most).select("a", "b")

    classes = linked_classes(nodes.mapInArrow(_covering, "bucket bigint, node bigint"), verify, close)
    placed = named.select("id", "row", "node").join(classes.hint("merge"), "node", "left")
    return placed.select("id", "row", F.coalesce("component", "node").alias("group"))
