"""Fuzzy line deduplication with DataFrame functions only.

Lines are normalised (lower case, runs of other characters than letters and digits become one space).
Lines that are equal then (by a 64-bit hash) are one node. Blocks of a line have SimHash fingerprints: a bit is 1 if set in the hashes
of over half of five shingles that make up the block. Nodes that agree in a whole fingerprint share a bucket. By the pigeonhole principle
this misses no pair: with at most k edits, one of k + 1 equal pieces of the longer line stands unchanged in the other, at
a place that the edits before and after it allow, so that lines of few edits meet in a block of a known length of line and place (:func:`pieces`). Of
longer lines, n - k words are left in at most k + 1 runs, so that one run has
its share of them, and a sliding minimum of word hashes, no wider than that run, cuts the same block out of it in both lines.
Nodes of a bucket are linked if their edit similarity in words reaches the threshold. Of each connected group the first occurrence stays.

Blocks are cut in the stage that cuts and normalises the lines; no text is shuffled for that. Fingerprints of whole lines
(:func:`fingerprints`) miss pairs by chance and are no longer what lines are joined by.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from corpusflow.llm.linking import linked_classes
from corpusflow.session import materialise

#: Fingerprints of 64 bits a line. Each has nine pieces of seven bits; a block is three pieces.
PRINTS, PIECE, PIECES = 3, 7, 9
#: A wider block has fewer chance meetings and asks for more blocks.
BLOCK_BITS = 3 * PIECE
#: Bits of the first fingerprint that a node's number carries, so that the joins which make pairs can test their distance.
CARRIED = 32
#: Most words of a block that a sliding minimum cuts, and most places that is taken over.
WORDS, SPAN = 9, 16
#: Lines with more edits or words are cut by sliding minima, others into pieces.
PIECE_EDITS, PIECE_WORDS = 3, 120
#: Shingles of a block, an odd number.
SHINGLES = 5
#: Lengths are cut into bands of this ratio, the last one open: lines of different bands share no bucket.
BAND_RATIO, BANDS = 1.25, 12
#: Bits of a node's number with the parities of its words, and with the class of its length.
PARITY, LENGTH = 22, 7
#: Bits of a word's place behind its hash, so that of equal hashes the first is the least.
PLACE = 27
#: Words of a part of a line; no sum of a part passes a lane of 8 bits whose first one stays free.
PART = 127
#: Longs of a line's bitmap of words.
BITMAP = 4
#: Bits of the filter that keeps texts without a candidate or without a cut out of shuffles. Its size is fixed (a
#: row for every 64 bits); with more keys than bits it lets all texts pass, which costs a shuffle and changes no result.
FILTER_BITS = 1 << 22


def differing(similarity: float) -> float:
    """Chance that a bit differs between lines of which this share of the words is the same: the angle of the sets over pi."""
    return math.acos(min(max(similarity, 0.0), 1.0)) / math.pi


def blocks(similarity: float, recall: float) -> list[tuple[int, int, int]]:
    """Pieces, numbered over all fingerprints, of as many blocks as two lines at this similarity need to agree in one with
    this chance. No two blocks have two pieces in common. There are 90 of them; a similarity that needs more gets all."""
    straight = [tuple(PIECES * k + 3 * b + i for i in range(3)) for k in range(PRINTS) for b in range(PIECES // 3)]
    across = [(i, PIECES + (i + s) % PIECES, 2 * PIECES + (i + 2 * s) % PIECES) for s in range(PIECES) for i in range(PIECES)]
    agree = (1 - differing(similarity)) ** BLOCK_BITS
    # Blocks with common pieces fail together more often than independent ones: two fifths more make up for it.
    wanted = 1 if agree == 1 else math.ceil(1.4 * math.log(1 - recall) / math.log(1 - agree))
    return (straight + across)[: max(1, wanted)]


def most_bits(similarity: float) -> int:
    """Carried bits in which lines at this similarity differ at most, but for about one pair in ten thousand."""
    p = differing(similarity)
    return min(CARRIED, math.floor(CARRIED * p + 4 * math.sqrt(CARRIED * p * (1 - p))))


def least_near(similarity: float) -> int:
    """Fewest words of a line that can be near another one: one fewer than the shortest line that may have an edit."""
    spare = 1 - similarity
    return max(1, math.ceil((1 - 1e-9) / spare) - 1) if spare > 0 else (1 << 31) - 1


def most_edits(similarity: float, n: int) -> int:
    """Most edits of two lines at this similarity of which the longer one has ``n`` words."""
    return math.floor(n * (1 - similarity) + 1e-9)


def shared_run(similarity: float, low: int, high: float = math.inf) -> int:
    """Words of a run that two lines at this similarity share at least, if the longer one has ``low`` to ``high`` words."""
    # The run is shortest where a further edit is allowed, and grows from one such length to the next.
    lengths = range(low, int(min(high, low + math.ceil(1 / (1 - similarity)) + 1)) + 1)
    return min(-(-(n - k) // (k + 1)) for n in lengths for k in [most_edits(similarity, n)])


def first_banded(similarity: float) -> int:
    """Least length of a longer line that bands hold."""
    length = least_near(similarity) + 1
    while length <= PIECE_WORDS and most_edits(similarity, length) <= PIECE_EDITS:
        length += 1
    return length


def pieces(similarity: float, n: int) -> list[tuple[int, int, int, int]]:
    """(words of the longer line, number, place, words) of the pieces by which a line of ``n`` words is met by longer ones or is the longer one.

    The longer line has k + 1 pieces for k edits. Let the first so many pieces hold fewer edits than pieces for the first time: the last of
    them, number i from 0, has none, as many as i edits stand before it and k - i behind it. They bound how far the piece has moved.
    """
    found = []
    for longer in range(n, min(first_banded(similarity) - 1, math.floor(n / similarity + 1e-9)) + 1):
        k, shorter = most_edits(similarity, longer), longer - n
        for i in range(k + 1 if 0 < k >= shorter else 0):
            begin, end = i * longer // (k + 1), (i + 1) * longer // (k + 1)
            for moved in range(max(-i, -shorter - (k - i)), min(i, -shorter + (k - i)) + 1):
                if 0 <= begin + moved and end + moved <= n:
                    found.append((longer, i, begin + moved, end - begin))
    return found


def bands(similarity: float) -> list[tuple[int, int, int]]:
    """(least length, words of a block, places of the sliding minimum) of every band of the longer line's length.
    A similarity that asks for nothing in common gets no band."""
    if not 0 < similarity < 1:
        return []
    edges = [first_banded(similarity)]
    while len(edges) < BANDS:
        edges.append(max(edges[-1] + 1, math.ceil(edges[-1] * BAND_RATIO)))
    found = []
    for low, after in zip(edges, [*edges[1:], math.inf]):
        run = max(1, shared_run(similarity, low, after - 1))
        words = min(WORDS, run)
        found.append((low, words, min(SPAN, run - words + 1)))
    return found


def normalised(line: Column) -> Column:
    # A single space stays as it is, which leaves few matches.
    return F.trim(F.regexp_replace(F.lower(line), r" *[^\p{L}\p{N} ][^\p{L}\p{N}]*| {2,}", " "))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def symbols(words: Column) -> Column:
    """The words as a text of one character each, so that edit distances count words. Of the 55 040 characters
    two different words share one about once in as many pairs."""
    code = F.transform(words, lambda word: F.lpad(F.hex(F.lit(0x100) + F.pmod(F.xxhash64(word), F.lit(0xD700))), 4, "0"))
    return F.decode(F.unhex(F.array_join(code, "")), "UTF-16BE")


def document_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, row, text): the id with a null one first of all, and a hash that tells apart texts with the same id."""
    text = F.col(text_col).cast("string")
    return docs.select(F.coalesce(F.col(id_col).cast("bigint"), F.lit(-(1 << 63))).alias("id"), F.xxhash64(text).alias("row"), text.alias("text"))


def _lanes(byte: int) -> Column:
    """A long with this byte in each lane of eight bits."""
    return F.lit(int.from_bytes(bytes([byte]) * 8, "big"))


def fingerprints(texts: DataFrame) -> DataFrame:
    """(line_node, node, fact, p0, p1, ...) of distinct (node, n, line), n the number of words: the facts that ``can_be_near`` reads and the SimHash
    fingerprints. The new node has half of the first fingerprint above half of the line's hash."""
    each = texts.select("node", "n", F.posexplode(F.array_distinct(F.split("line", " "))).alias("at", "word"))
    hashed = each.select("node", "n", F.floor(F.col("at") / PART).alias("part"), *[F.xxhash64("word", F.lit(k)).alias(f"h{k}") for k in range(PRINTS)])
    place = F.pmod(F.xxhash64("h0"), F.lit(64 * BITMAP))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), (place % 64).cast("int"))
    parts = hashed.groupBy("node", "part").agg(
        F.max("n").alias("n"), F.count(F.lit(1)).alias("distinct"),
        *[F.bit_or(F.when(F.shiftright(place, 6) == k, bit).otherwise(F.lit(0))).alias(f"l{k}") for k in range(BITMAP)],
        *[F.sum(F.shiftrightunsigned(f"h{k}", i).bitwiseAND(_lanes(1))).alias(f"c{k}_{i}") for k in range(PRINTS) for i in range(8)],
    )
    wide, top = F.lit(0xFF000000FF), F.lit(0x4000000040000000)
    counts = [(k, i, j) for k in range(PRINTS) for i in range(8) for j in range(4)]
    whole = parts.groupBy("node").agg(
        F.max("n").cast("bigint").alias("n"), F.sum("distinct").alias("distinct"), *[F.bit_or(f"l{k}").alias(f"l{k}") for k in range(BITMAP)],
        *[F.sum(F.shiftrightunsigned(f"c{k}_{i}", 8 * j).bitwiseAND(wide)).alias(f"w{k}_{i}_{j}") for k, i, j in counts],
    )
    # A count above half the words carries into the lane's bit 30.
    lift = (F.lit((1 << 30) - 1) - F.shiftright("distinct", 1)) * F.lit((1 << 32) + 1)
    lifted = whole.withColumn("lift", lift)

    def bits(k: int) -> Column:
        each = [
            F.call_function("shiftleft", F.shiftrightunsigned((F.col(f"w{k}_{i}_{j}") + F.col("lift")).bitwiseAND(top), 30), F.lit(8 * j + i))
            for i in range(8) for j in range(4)
        ]
        # Different bits each, so that any order will do; pairs keep the expression flat.
        while len(each) > 1:
            each = [a.bitwiseOR(b) for a, b in zip(each[::2], each[1::2])]
        return each[0]

    fact = F.array("n", *[f"l{k}" for k in range(BITMAP)]).alias("fact")
    done = lifted.select(F.col("node").alias("line_node"), fact, *[bits(k).alias(f"p{k}") for k in range(PRINTS)])
    low = F.col("line_node").bitwiseAND(F.lit((1 << (64 - CARRIED)) - 1))
    return done.withColumn("node", F.shiftleft("p0", 64 - CARRIED).bitwiseOR(low))


def _keys(chosen: list[tuple[int, int, int]]) -> list[Column]:
    """The value and the number of every block as one long."""

    def piece(number: int, place: int) -> Column:
        at = F.shiftrightunsigned(f"p{number // PIECES}", PIECE * (number % PIECES)).bitwiseAND(F.lit((1 << PIECE) - 1))
        return F.shiftleft(at.cast("bigint"), PIECE * place)

    return [piece(a, 0) + piece(b, 1) + piece(c, 2) + F.lit(k << BLOCK_BITS) for k, (a, b, c) in enumerate(chosen)]


def _passing(rows: DataFrame, key: Column, wanted: DataFrame, wanted_key: Column) -> DataFrame:
    """``rows`` with ``_maybe``: true for all whose key is in ``wanted`` and for few others (a Bloom filter with one hash)."""

    def bit(of: Column) -> Column:
        return F.pmod(F.xxhash64(of, F.lit(1)), F.lit(FILTER_BITS))

    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), (bit(wanted_key) % 64).cast("int"))
    cells = wanted.select(F.shiftright(bit(wanted_key), 6).cast("int").alias("_cell"), one.alias("_bit"))
    # One row per 64 bits at most, whatever the number of keys.
    cells = cells.groupBy("_cell").agg(F.bit_or("_bit").alias("_bits"))
    placed = rows.withColumn("_cell", F.shiftright(bit(key), 6).cast("int")).join(F.broadcast(cells), "_cell", "left")
    held = F.coalesce(F.getbit("_bits", (bit(key) % 64).cast("int")) == 1, F.lit(False))
    return placed.withColumn("_maybe", held).drop("_cell", "_bits")


def can_be_near(similarity: float, a: Column, b: Column) -> Column:
    """Whether two lines of these facts can have this edit similarity. A word, and so a bit of the bitmap, that only one
    of them has costs an edit, and so does every word by which one is longer."""
    most = F.floor(F.greatest(a[0], b[0]) * (1 - similarity) + 1e-9)

    def only(one: Column, other: Column) -> Column:
        lost = [F.bit_count(one[k].bitwiseAND(F.bitwise_not(other[k]))) for k in range(1, 1 + BITMAP)]
        return sum(lost[1:], lost[0])

    return (F.abs(a[0] - b[0]) <= most) & (only(a, b) <= most) & (only(b, a) <= most)


def majority(words: list[Column]) -> Column:
    """SimHash of one, three or five hashes: each bit that is set in over half of them."""

    def carry(a: Column, b: Column, c: Column) -> Column:
        return a.bitwiseAND(b).bitwiseOR(a.bitwiseOR(b).bitwiseAND(c))

    if len(words) == 1:
        return words[0]
    a, b, c, *more = words
    if not more:
        return carry(a, b, c)
    odd, (d, e) = a.bitwiseXOR(b).bitwiseXOR(c), more
    return carry(carry(a, b, c), carry(odd, d, e), odd.bitwiseXOR(d).bitwiseXOR(e))


def _least_of_two(values: Column, apart: Column | int) -> Column:
    """Each value or that so many places behind it, the smaller one."""
    return F.zip_with(values, F.slice(values, F.lit(1) + apart, F.size(values)), lambda a, b: F.least(a, b))


def block_keys(lines: DataFrame, similarity: float, min_words: int) -> DataFrame:
    """``lines`` (n, line, hash and others) with ``node`` and ``keys`` in place of the line, both null for lines that can be near none
    but their equals. A near line's keys hold one of this line's at least. The node has the parities of the numbers of words
    by their hash and the class of the length above the rest of the line's hash."""
    passed = [c for c in lines.columns if c != "line"]
    chosen, least = bands(similarity), max(min_words, least_near(similarity))
    if not chosen:
        return lines.select(*passed, F.lit(None).cast("bigint").alias("node"), F.lit(None).cast("array<bigint>").alias("keys"))
    n, long = F.col("n"), F.col("n") >= least
    banded = long & (F.floor(n / similarity + 1e-9) >= chosen[0][0])
    hashes = F.when(long, F.transform(F.split("line", " "), lambda word: F.xxhash64(word)))
    # Each step reads the one before twice and is therefore a column of its own.
    steps = lines.select(*passed, hashes.alias("_h"))
    places = F.transform("_h", lambda h, i: F.shiftleft(F.shiftrightunsigned(h, PLACE + 1), PLACE).bitwiseOR(i.cast("bigint")))
    steps = steps.withColumn("_m1", F.when(banded, places))
    wide = 1
    while 2 * wide <= max(span for _, _, span in chosen):
        steps = steps.withColumn(f"_m{2 * wide}", _least_of_two(F.col(f"_m{wide}"), wide))
        wide *= 2

    def band_of(length: Column) -> Column:
        return sum([(length >= low).cast("int") for low, _, _ in chosen[1:]], F.lit(0))

    def shingles(place: Column, words: Column) -> Column:
        edges = [F.floor(words * k / SHINGLES).cast("int") for k in range(SHINGLES + 1)]
        return F.array(*[F.xxhash64(F.slice("_h", place + a + 1, b - a)) for a, b in zip(edges, edges[1:])])

    def prints(blocks: Column) -> Column:
        return F.transform(blocks, lambda block: majority([F.get(block, F.lit(k)) for k in range(SHINGLES)]))

    def keys(number: Column) -> Column:
        found = None
        for words, span in sorted({band[1:] for band in chosen}):
            power = 1 << (span.bit_length() - 1)
            values = F.col(f"_m{power}") if power == span else _least_of_two(F.col(f"_m{power}"), span - power)
            # Minima of whole windows only.
            whole = F.slice(values, F.lit(1), F.greatest(n - (words + span - 2), F.lit(0)))
            at = F.array_distinct(F.transform(whole, lambda v: v.bitwiseAND(F.lit((1 << PLACE) - 1)).cast("int")))
            cut = prints(F.transform(at, lambda place: shingles(place, F.lit(words))))
            mine = sum([(number == k).cast("int") for k, band in enumerate(chosen) if band[1:] == (words, span)], F.lit(0)) > 0
            found = F.when(mine, cut) if found is None else found.when(mine, cut)
        return F.transform(found, lambda print_: print_.bitwiseXOR(F.xxhash64(number)))

    # The longer line of a pair may be this one, or longer by as many words as there are edits.
    own, most = band_of(n), band_of(F.floor(n / similarity + 1e-9))
    steps = steps.withColumns({"_own": own, "_most": most})
    numbers = F.sequence("_own", "_most")
    # Pieces of all lengths one after the other, each as one long, and where those of a length begin.
    packed, begins = [], []
    for words in range(least, chosen[0][0]):
        begins.append(len(packed))
        packed += [longer << 40 | i << 32 | at << 16 | size for longer, i, at, size in pieces(similarity, words)]
    begins.append(len(packed))
    if packed:
        low = F.lit((1 << 16) - 1)
        begin = F.get(F.lit(begins), n - least)
        mine = F.slice(F.lit(packed).cast("array<bigint>"), begin + 1, F.get(F.lit(begins), n - least + 1) - begin)
        mine = F.when(long & (n < chosen[0][0]), mine)
        steps = steps.withColumn("_pieces", mine)
        cut = prints(F.transform("_pieces", lambda p: shingles(F.shiftright(p, 16).bitwiseAND(low).cast("int"), p.bitwiseAND(low).cast("int"))))
        pieced = F.zip_with(cut, "_pieces", lambda print_, p: print_.bitwiseXOR(F.xxhash64(F.shiftright(p, 32))))
    else:
        pieced = F.lit(None).cast("array<bigint>")
    parity = F.aggregate("_h", F.lit(0).cast("bigint"), lambda bits, h: bits.bitwiseXOR(F.call_function(
        "shiftleft", F.lit(1).cast("bigint"), F.pmod(h, F.lit(PARITY)).cast("int"))))
    length = F.greatest(F.lit(0), F.least(F.floor(F.log(n / least_near(similarity)) / math.log(_class_ratio(similarity))), F.lit((1 << LENGTH) - 1)))
    rest = 64 - PARITY - LENGTH
    node = F.shiftleft(parity, 64 - PARITY).bitwiseOR(F.shiftleft(length.cast("bigint"), rest)).bitwiseOR(F.col("hash").bitwiseAND(F.lit((1 << rest) - 1)))
    # Most lines have one band; a wider one than two is met by low similarities only.
    one = F.array_distinct(keys(F.col("_own")))
    two = F.when(F.col("_most") == F.col("_own"), F.col("_one")).otherwise(F.array_union("_one", F.flatten(F.transform(F.filter(numbers, lambda k: k > F.col("_own")), keys))))
    done = steps.withColumn("_one", F.when(banded, one)).withColumn("node", F.when(long, node))
    none = F.array().cast("array<bigint>")
    every = F.array_union(F.coalesce(F.when(banded, two), none), F.coalesce(pieced, none))
    return done.select(*passed, "node", F.when(long, every).alias("keys"))


def _class_ratio(similarity: float) -> float:
    """Ratio of the lengths of a class, a little wider than that of near lines."""
    return 1.001 / similarity


def can_be_close(similarity: float, a: Column, b: Column) -> Column:
    """Whether lines with these nodes can be near each other: their lengths are of the same class or of neighbouring ones, and an
    edit changes two parities at most. The last class is open."""
    last, rest, ratio = (1 << LENGTH) - 1, 64 - PARITY - LENGTH, _class_ratio(similarity)
    one, two = [F.shiftrightunsigned(x, rest).bitwiseAND(F.lit(last)) for x in (a, b)]
    longest = F.greatest(one, two)
    edits = F.floor(F.pow(F.lit(ratio), longest + 1) * (least_near(similarity) * (1 - similarity)) + 1e-6)
    apart = F.bit_count(F.shiftrightunsigned(a.bitwiseXOR(b), 64 - PARITY))
    return (F.abs(one - two) <= 1) & ((longest == last) | (apart <= 2 * edits))


def normal_lines(rows: DataFrame) -> DataFrame:
    """(id, row, pos, n, line) of all lines of ``rows`` (id, row, text), normalised, with the number of their words."""
    # An outer explode and no filter on the words: Spark would work them out once more for a filter that it pushes down.
    cut = rows.select("id", "row", F.posexplode_outer(_lines(F.col("text"))).alias("pos", "line"))
    cut = cut.select("id", "row", "pos", normalised(F.col("line")).alias("line"))
    # A line without letters and digits has no word.
    n = F.when(F.col("line") == "", 0).otherwise(F.length("line") - F.length(F.replace("line", F.lit(" "))) + 1)
    return cut.select("id", "row", "pos", n.alias("n"), "line")


def line_groups(rows: DataFrame, similarity: float, recall: float, min_words: int, exact_words: int) -> DataFrame:
    """(id, row, pos, group) of the lines of ``rows`` (id, row, text) that have words, ``min_words`` or ``exact_words`` or more.

    No pair is left out, whatever the ``recall``.
    """
    cut = normal_lines(rows)
    cut = cut.select("id", "row", "pos", "n", F.xxhash64("line").alias("hash"), "line")
    printed = materialise(block_keys(cut, similarity, min_words), "lines")
    # Equal lines are one node already, so that a bucket of one node needs no look.
    members = printed.where("node is not null").select(F.explode("keys").alias("bucket"), "node")
    shared = members.groupBy("bucket").agg(F.min("node").alias("first"), F.max("node").alias("last")).where("first < last")
    shared = materialise(shared.select("bucket"), "shared")
    met = _passing(members, F.col("bucket"), shared, F.col("bucket")).where("_maybe").join(shared, "bucket", "left_semi")

    def verify(pairs: DataFrame) -> DataFrame:
        pairs = materialise(pairs, "pairs")
        wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
        at = F.min(F.struct("id", "row", "pos")).alias("at")
        held = materialise(printed.join(wanted, "node", "left_semi").groupBy("node").agg(at).select("node", "at.*"), "wanted")
        document, place = F.xxhash64("id", "row"), F.xxhash64("id", "row", "pos")
        texts = _passing(rows, document, held, document).where("_maybe").select("id", "row", "text")
        maybe = _passing(normal_lines(texts), place, held, place).where("_maybe").select("id", "row", "pos", "line")
        found = maybe.join(held, ["id", "row", "pos"]).dropDuplicates(["node"])
        found = materialise(found.select("node", symbols(F.split("line", " ")).alias("symbols")), "symbols")
        one = found.select(F.col("node").alias("a"), F.col("symbols").alias("ta"))
        two = found.select(F.col("node").alias("b"), F.col("symbols").alias("tb"))
        both = pairs.join(one, "a").join(two, "b")
        longest, shortest = F.greatest(F.length("ta"), F.length("tb")), F.least(F.length("ta"), F.length("tb"))
        edits = F.floor(longest * (1 - similarity) + 1e-9).cast("int")
        # Lengths differ by no more than the edits; beyond the limit the distance is -1.
        return both.where(longest - shortest <= edits).where(F.call_function("levenshtein", "ta", "tb", edits) >= 0).select("a", "b").distinct()

    classes = linked_classes(met.distinct(), verify, lambda a, b: can_be_close(similarity, a, b))
    # A class has the number of its least line, so that it cannot be taken for that of another line.
    of_node = printed.where("node is not null").select("node", "hash").distinct()
    named = materialise(of_node.join(classes, "node"), "classes")
    least = named.groupBy("component").agg(F.min("hash").alias("group"))
    of_line = named.join(least, "component").select("hash", "group")
    found = printed.where((F.col("n") > 0) & (F.col("n") >= min(min_words, exact_words))).select("id", "row", "pos", "hash")
    return found.join(of_line, "hash", "left").select("id", "row", "pos", F.coalesce("group", "hash").alias("group"))


def repeated_places(groups: DataFrame, long_words: int | None = None) -> DataFrame:
    """(_id, _row, _removed) with the places of ``groups`` (id, row, pos, group) that are not the first of their group. With
    ``long_words`` and the numbers of ``words``, also ``_words``: those of such places with that many, whose first stands in another document."""
    place = F.struct("id", "row", "pos")
    first = groups.groupBy("group").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    later = groups.join(first, "group").where(place != F.col("first"))
    found = {"_removed": F.array_sort(F.collect_set("pos"))}
    if long_words is not None:
        other = (F.col("id") != F.col("first.id")) | (F.col("row") != F.col("first.row"))
        long = F.collect_set(F.when(other & (F.col("words") >= long_words), F.struct("pos", "words")))
        found["_words"] = F.aggregate(long, F.lit(0).cast("bigint"), lambda total, x: total + x["words"])
    removed = later.groupBy("id", "row").agg(*[column.alias(name) for name, column in found.items()])
    return materialise(removed.select(F.col("id").alias("_id"), F.col("row").alias("_row"), *found), "removed")


def cut_places(docs: DataFrame, edits: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``docs`` without the lines at ``_removed`` of ``edits``, which may also have a new ``_text`` that replaces what is left,
    ``_more`` removals to be counted and ``_words``, which are passed on as ``n_passage_words``."""
    # The rows travel as one struct, so that no column of theirs can clash with those used here.
    made = ["n_lines", "n_removed"] + ["n_passage_words"] * ("_words" in edits.columns)
    passed = [c for c in docs.columns if c not in made]
    named = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in passed]).alias("_doc"),
        F.coalesce(F.col(f"`{id_col}`").cast("bigint"), F.lit(-(1 << 63))).alias("_id"),
        F.xxhash64(F.col(f"`{text_col}`").cast("string")).alias("_row"),
    )
    placed = _passing(named, F.col("_id"), edits, F.col("_id"))
    edit = [f for f in edits.schema if f.name not in ("_id", "_row")]
    none = [F.lit(None).cast(f.dataType).alias(f.name) for f in edit]
    met = placed.where("_maybe").join(edits, ["_id", "_row"], "left")
    joined = met.select(*named.columns, *[f.name for f in edit]).union(placed.where(~F.col("_maybe")).select(*named.columns, *none))

    def run(p: Column, i: Column) -> Column:
        before = F.coalesce(F.get("_removed", i - 1), F.lit(-1))
        return F.concat(F.array_repeat(F.lit(False), p - before - 1), F.array(F.lit(True)))

    flags = F.flatten(F.transform("_removed", run))
    doc = F.col("_doc")
    text = doc[text_col].cast("string")
    joined = joined.withColumn("_flags", flags)
    kept = F.array_join(F.filter(_lines(text), lambda line, i: ~F.coalesce(F.get("_flags", i), F.lit(False))), "\n")
    left = F.when(F.col("_flags").isNull(), text).otherwise(kept)
    gone = F.coalesce(F.size("_removed"), F.lit(0)).cast("bigint")
    if "_text" in edits.columns:
        left, gone = F.coalesce("_text", left), gone + F.coalesce("_more", F.lit(0))
    return joined.select(
        *[left.alias(c) if c == text_col else doc[c].alias(c) for c in passed],
        F.when(text.isNull(), 0).otherwise(F.size(_lines(text))).cast("bigint").alias("n_lines"), gone.alias("n_removed"),
        *[F.coalesce("_words", F.lit(0)).cast("bigint").alias(c) for c in made[2:]],
    )


def cut_repeats(docs: DataFrame, groups: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``docs`` without the lines of ``groups`` (id, row, pos, group) that are not the first of their group."""
    return cut_places(docs, repeated_places(groups), id_col, text_col)


def dedupe_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = 0.95, recall: float = 0.9,
                 min_words: int = 5, exact_words: int | None = None) -> DataFrame:
    """All rows of ``docs`` with the repeated lines cut out of the text, and ``n_lines`` and ``n_removed``.

    Of every group of lines with an edit similarity in words of ``similarity`` or more, directly or over others, the
    first in (id, text hash, line) order stays. All pairs at that similarity are found, whatever the ``recall``. Lines of fewer than ``min_words`` words are only
    compared for equality, if they have ``exact_words`` words (``min_words`` if not given), and otherwise stay. Rows that repeat
    both id and text are one document and lose the same lines; null ids come first. A null text stays null, a
    text that loses all lines becomes empty. Other columns are passed on; ``n_lines`` and ``n_removed`` are
    replaced if there. An empty table stays empty.
    """
    exact_words = min_words if exact_words is None else exact_words
    return cut_repeats(docs, line_groups(document_rows(docs, id_col, text_col), similarity, recall, min_words, exact_words), id_col, text_col)
