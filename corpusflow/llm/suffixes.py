"""Removal of byte strings that an earlier document holds, by hash-compared suffix sorting.

Places that a sliding minimum of k-gram hashes selects (anchors) are the same relative to any string of the
asked length wherever it stands, so a string that two documents share has its anchor in both. First the
anchors whose k-gram stands in two documents are found; of these the surroundings are sorted as
suffixes. Two suffixes are compared by binary search for their common extension over prefix polynomial hashes,
in a mergesort of the suffixes with the same first bytes. Neighbours with a long enough common extension, and equal
bytes to the left, hold the same string; the bytes are compared to rule out collisions of hashes.

Tasks exchange packed and compressed arrays by ranges of the k-gram hash, of its low bits, as a sliding minimum favours small high ones. What repeats inside a task's batch is resolved there,
so copies in great number send one entry per batch.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from corpusflow.llm.lines import document_rows
from corpusflow.llm.textbytes import BASE, mix, prefix_hashes, raw, slices, span_hashes

GRAM = 16
#: Bytes of text per range of hashes.
RANGE_BYTES = 16 << 20
#: Bytes of text per part of the documents, to which ranges send what they find.
PART_BYTES = 64 << 20
#: Low bits of a k-gram hash that choose its range, and bytes of the others that are compared to flag it.
DEALT, KEY_BYTES = 24, 5
#: Bytes of text whose anchors are found and grouped in one go.
GROUP_BYTES = 4 << 20
#: Bytes of whole texts whose k-grams are hashed in one go; temporaries take about a hundred times as much.
HASHED_BYTES = 1 << 18
#: Contexts sorted in one go, and the rest of the last key.
SORTED = 1 << 15
_I64 = np.int64


def sliding(values: np.ndarray, width: int, best) -> np.ndarray:
    """``best`` (np.minimum or np.maximum) over every ``width`` consecutive values."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = best(out[: len(out) - step], out[step:])
        have += step
    return out


def anchors(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Anchors of texts that stand one after the other: number of the text, place, k-gram hash, and the least
    and greatest distance to the starts of the anchor's windows.

    A window of ``length`` bytes lies inside one text and belongs to the k-gram in it whose hash has the least upper half, the
    leftmost one of equals.
    """
    none = np.zeros(0, _I64)
    if len(data) < length:
        return none, none, none.astype(np.uint64), none, none
    sums, inverse = prefix_hashes(data)
    begin = np.arange(len(data) - GRAM + 1)
    grams = span_hashes(sums, inverse, begin, begin + GRAM)
    # The place stands below the upper half of the hash, so that one minimum gives both.
    low = np.uint64((1 << 32) - 1)
    least = sliding(grams & ~low | begin.astype(np.uint64), length - GRAM + 1, np.minimum)
    inside = np.zeros(len(least) + 1, np.int32)
    runs = np.flatnonzero(np.diff(offsets) >= length)
    inside[offsets[runs]] += 1
    np.subtract.at(inside, offsets[runs + 1] - length + 1, 1)
    valid = np.cumsum(inside)[:-1] > 0
    window = np.flatnonzero(valid)
    if not len(window):
        return none, none, none.astype(np.uint64), none, none
    # Places do not step back from one window to the next.
    where = (least[window] & low).astype(_I64)
    fresh = np.flatnonzero(np.append(True, where[1:] != where[:-1]))
    place = where[fresh]
    first, last = window[fresh], window[np.append(fresh[1:] - 1, len(window) - 1)]
    text = np.searchsorted(offsets, place, side="right") - 1
    return text, place - offsets[text], grams[place], place - last, place - first


def _anchors(part: pa.RecordBatch, length: int) -> tuple[np.ndarray, ...]:
    """:func:`anchors` of all texts of a slice, some texts after the others."""
    found, before = [], 0
    for some in slices(part, "text", HASHED_BYTES):
        text, *others = anchors(*raw(some.column("text")), length)
        found.append((text + before, *others))
        before += some.num_rows
    return tuple(np.concatenate(x) for x in zip(*found)) if found else anchors(np.zeros(0, np.uint8), np.zeros(1, _I64), length)


def _pack(*arrays: np.ndarray) -> list[bytes]:
    """Each array as its number of bytes and the bytes compressed."""
    blobs = [np.ascontiguousarray(a).tobytes() for a in arrays]
    return [len(b).to_bytes(8, "little") + pa.compress(b, codec="zstd", asbytes=True) if b else b"" for b in blobs]


def _open(blob: pa.Scalar, dtype) -> np.ndarray:
    data = blob.as_buffer()
    if not data.size:
        return np.zeros(0, dtype)
    return np.frombuffer(pa.decompress(data.slice(8), int.from_bytes(data.slice(0, 8).to_pybytes(), "little"), codec="zstd"), dtype)


def _unpack(column: pa.ChunkedArray, dtype) -> np.ndarray:
    parts = [_open(x, dtype) for x in column if x.is_valid]
    return np.concatenate(parts) if parts else np.zeros(0, dtype)


def _ranges_of(keys: np.ndarray, ranges: int) -> np.ndarray:
    return (keys & np.uint64((1 << DEALT) - 1)).astype(_I64) * ranges >> DEALT


def _short(keys: np.ndarray) -> np.ndarray:
    """Bytes of the keys above those that choose the range. Keys that agree in them and are not equal are rare, and flagged in vain."""
    return np.ascontiguousarray((keys >> np.uint64(DEALT)).astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES]


def _long(short: np.ndarray) -> np.ndarray:
    out = np.zeros((len(short) // KEY_BYTES, 8), np.uint8)
    out[:, :KEY_BYTES] = short.reshape(-1, KEY_BYTES)
    return out.view("<u8").ravel()


def _steps(values: np.ndarray) -> np.ndarray:
    """First value and differences, which compress better; they may wrap around."""
    return np.append(values[:1], values[1:] - values[:-1])


def _sums(column: pa.ChunkedArray) -> np.ndarray:
    """What :func:`_steps` were made of."""
    parts = [np.cumsum(_open(x, _I64)) for x in column if x.is_valid]
    return np.concatenate(parts) if parts else np.zeros(0, _I64)


def _texts(part: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray]]:
    data, offsets = raw(part.column("text"))
    ids, rows = part.column("id").to_numpy(), part.column("row").fill_null(0).to_numpy()
    for k in range(part.num_rows):
        yield int(ids[k]), int(rows[k]), data[offsets[k] : offsets[k + 1]]


_SENT = "range bigint, kind int, keys binary, ids binary, rows binary, places binary"
_FOUND = "part bigint, ids binary, rows binary, found binary"
_GATHERED = "id bigint, row bigint, found binary"


def _flag_scan(length: int, ranges: int):
    """Anchors of all texts by range; kind 1 are those known to repeat in this batch, kind 0 the others."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", GROUP_BYTES):
                text, places, keys, _, _ = _anchors(part, length)
                ids, rows = part.column("id").to_numpy()[text], part.column("row").fill_null(0).to_numpy()[text]
                places = places.astype(np.int32)
                yield _by_range(keys, ids, rows, places, *_repeats(keys, ids), ranges)

    return scan


def _repeats(keys: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which entries have a key that two ids hold, and which stand for their key: the first of each key and, of
    a key that one id holds, all."""
    order = np.lexsort((ids, keys))
    k, i = keys[order], ids[order]
    start = np.flatnonzero(np.append(True, k[1:] != k[:-1])) if len(k) else np.zeros(0, _I64)
    size = np.diff(np.append(start, len(k)))
    many = np.repeat(i[np.append(start[1:], len(k)) - 1] != i[start], size) if len(k) else np.zeros(0, bool)
    first = np.zeros(len(k), bool)
    first[start] = True
    repeated, sent = np.zeros(len(k), bool), np.zeros(len(k), bool)
    repeated[order] = many
    sent[order] = first | ~many
    return repeated, sent


def _by_range(keys, ids, rows, places, repeated, sent, ranges) -> pa.RecordBatch:
    out = []
    target = _ranges_of(keys, ranges)
    for kind, mask in ((0, sent), (1, repeated)):
        which = np.flatnonzero(mask)
        which = which[np.argsort(target[which], kind="stable")]
        cuts = np.append(np.flatnonzero(np.append(True, target[which][1:] != target[which][:-1])), len(which)) if len(which) else []
        for a, b in zip(cuts[:-1], cuts[1:]):
            w = which[a:b]
            out.append([int(target[w[0]]), kind, *_pack(_short(keys[w] if not kind else keys[:0]), _steps(ids[w]), rows[w], places[w])])
    columns = list(zip(*out)) if out else [[]] * 6
    kinds = [pa.int64(), pa.int32(), *[pa.binary()] * 4]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [f.split()[0] for f in _SENT.split(", ")])


def _by_part(ids: np.ndarray, rows: np.ndarray, values: np.ndarray, parts: int) -> pa.Table:
    """Packed values by part of the documents: a range makes a row for each part at most, not one for each document."""
    with np.errstate(over="ignore"):
        part = (mix(ids.astype(np.uint64) * np.uint64(3) + rows.astype(np.uint64)) % np.uint64(parts)).astype(_I64)
    order = np.lexsort((rows, ids, part))
    part, ids, rows, values = part[order], ids[order], rows[order], values[order]
    cuts = np.append(np.flatnonzero(np.append(True, part[1:] != part[:-1])), len(part)) if len(part) else []
    out = [[int(part[a]), *_pack(_steps(ids[a:b]), rows[a:b], values[a:b])] for a, b in zip(cuts[:-1], cuts[1:])]
    columns = list(zip(*out)) if out else [[]] * 4
    names = [f.split()[0] for f in _FOUND.split(", ")]
    return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, [pa.int64(), *[pa.binary()] * 3])], names)


def _gather(width: int):
    """Of all ranges' values, ``width`` numbers each, those of each document."""

    def gather(table: pa.Table) -> pa.Table:
        ids, rows = _sums(table.column("ids")), _unpack(table.column("rows"), _I64)
        return _per_document(ids, rows, _unpack(table.column("found"), np.int32).reshape(-1, width), "found")

    return gather


def _gathered(found: DataFrame, width: int, name: str) -> DataFrame:
    return found.groupBy("part").applyInArrow(_gather(width), _GATHERED).withColumnRenamed("found", name)


def _per_document(ids: np.ndarray, rows: np.ndarray, values: np.ndarray, name: str) -> pa.Table:
    """Bytes of the values of each (id, row)."""
    order = np.lexsort((rows, ids))
    i, r, v = ids[order], rows[order], values[order]
    cuts = np.append(np.flatnonzero(np.append(True, (i[1:] != i[:-1]) | (r[1:] != r[:-1]))), len(i)) if len(i) else np.zeros(1, _I64)
    blobs = [np.ascontiguousarray(v[a:b]).tobytes() for a, b in zip(cuts[:-1], cuts[1:])]
    return pa.table({"id": pa.array(i[cuts[:-1]], pa.int64()), "row": pa.array(r[cuts[:-1]], pa.int64()), name: pa.array(blobs, pa.binary())})


def _flag_range(parts: int):
    """Places of the anchors whose key two documents hold."""

    def flag(table: pa.Table) -> pa.Table:
        fresh = table.filter(pc.equal(table.column("kind"), 0))
        known = table.filter(pc.equal(table.column("kind"), 1))
        keys, ids = _long(_unpack(fresh.column("keys"), np.uint8)), _sums(fresh.column("ids"))
        repeated, _ = _repeats(keys, ids)
        rows, places = _unpack(fresh.column("rows"), _I64), _unpack(fresh.column("places"), np.int32)
        return _by_part(
            np.concatenate([ids[repeated], _sums(known.column("ids"))]), np.concatenate([rows[repeated], _unpack(known.column("rows"), _I64)]),
            np.concatenate([places[repeated], _unpack(known.column("places"), np.int32)]), parts,
        )

    return flag


_CONTEXT = "range bigint, kind int, contexts binary, ids binary, rows binary, spans binary"


def _context_scan(length: int, ranges: int):
    """The surroundings of the flagged anchors by range (kind 0), and spans known to repeat in this batch (kind 1)."""
    left, names = length - GRAM, [f.split()[0] for f in _CONTEXT.split(", ")]
    kinds = [pa.int64(), pa.int32(), *[pa.binary()] * 4]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", GROUP_BYTES):
                data, offsets = raw(part.column("text"))
                text, place, key, near, far = _anchors(part, length)
                flags = part.column("flags")
                flagged = [np.frombuffer(b.as_buffer(), np.int32).astype(_I64) + (k << 32) for k, b in enumerate(flags)]
                on = np.isin((text << 32) + place, np.concatenate(flagged)) if flagged else np.zeros(len(text), bool)
                text, place, key, near, far = text[on], place[on], key[on], near[on], far[on]
                framed = np.concatenate([np.zeros(left, np.uint8), data, np.zeros(length, np.uint8)])
                column = np.arange(left + length, dtype=np.int32)
                # Rows of a view, so that no matrix of places, eight times as large, is made.
                context = np.lib.stride_tricks.sliding_window_view(framed, left + length)[offsets[text] + place]
                # What lies outside the anchor's windows is blanked, so that equal windows make equal contexts.
                context[(column < left - far[:, None]) | (column >= left - near[:, None] + length)] = 0
                ids, rows = part.column("id").to_numpy()[text], part.column("row").fill_null(0).to_numpy()[text]
                spans = np.stack([place, near, far], 1).astype(np.int32)
                yield from _send(context, key, ids, rows, spans, length, ranges)

    def _send(context, key, ids, rows, spans, length, ranges) -> Iterator[pa.RecordBatch]:
        same = _row_hashes(context, key) ^ mix(spans[:, 1].astype(np.uint64) * np.uint64(977) + spans[:, 2].astype(np.uint64))
        order = np.lexsort((ids, same))
        start = np.append(True, same[order][1:] != same[order][:-1]) if len(order) else np.zeros(0, bool)
        head = order[np.flatnonzero(start)[np.cumsum(start) - 1]] if len(order) else order
        later = (ids[order] > ids[head]) & (context[order] == context[head]).all(axis=1) & (spans[order, 1:] == spans[head, 1:]).all(axis=1)
        done = np.zeros(len(ids), bool)
        done[order] = later
        target = _ranges_of(key, ranges)
        for kind, mask in ((0, ~done), (1, done)):
            which = np.flatnonzero(mask)
            which = which[np.argsort(target[which], kind="stable")]
            cuts = np.append(np.flatnonzero(np.append(True, target[which][1:] != target[which][:-1])), len(which)) if len(which) else []
            out = []
            for a, b in zip(cuts[:-1], cuts[1:]):
                w = which[a:b]
                out.append([int(target[w[0]]), kind, *_pack(context[w] if not kind else context[:0], _steps(ids[w]), rows[w], spans[w])])
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    return scan


def _row_hashes(matrix: np.ndarray, seed: np.ndarray) -> np.ndarray:
    out = seed.copy()
    with np.errstate(over="ignore"):
        for k in range(0, matrix.shape[1], 4):
            word = np.zeros(len(matrix), np.uint64)
            for c in range(k, min(k + 4, matrix.shape[1])):
                word = word << np.uint64(8) | matrix[:, c]
            out = mix(out * np.uint64(3) + word + np.uint64(k))
    return out


class Suffixes:
    """Suffixes of bounded length, rows of a byte matrix, compared over prefix polynomial hashes."""

    def __init__(self, rows: np.ndarray):
        self.rows, (n, self.width) = rows, rows.shape
        self.hashes = np.zeros((n, self.width + 1), np.uint64)
        with np.errstate(over="ignore"):
            for k in range(self.width):
                self.hashes[:, k + 1] = self.hashes[:, k] * BASE + rows[:, k] + np.uint64(1)

    def extension(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Common extension of the suffixes a and b, by binary search for the longest equal prefix hash."""
        low, high = np.zeros(len(a), _I64), np.full(len(a), self.width, _I64)
        while (low < high).any():
            middle = (low + high + 1) >> 1
            equal = self.hashes[a, middle] == self.hashes[b, middle]
            low, high = np.where(equal, middle, low), np.where(equal, high, middle - 1)
        return low

    def before(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether suffix a sorts strictly before suffix b."""
        common = self.extension(a, b)
        inside = np.minimum(common, self.width - 1)
        return (common < self.width) & (self.rows[a, inside] < self.rows[b, inside])

    def sort(self, order: np.ndarray, group: np.ndarray) -> np.ndarray:
        """Mergesort of ``order`` inside each run of equal ``group``; runs of all groups are merged together."""
        n = len(order)
        start = np.flatnonzero(np.append(True, group[1:] != group[:-1])) if n else np.zeros(0, _I64)
        begin = np.repeat(start, np.diff(np.append(start, n)))
        end = np.repeat(np.append(start[1:], n), np.diff(np.append(start, n))) if n else begin
        within, size = np.arange(n) - begin, 1
        while n and size < (end - begin).max():
            run = within // size
            sibling = begin + (run ^ 1) * size
            live = np.flatnonzero((sibling < end) & (end - begin > size))
            low = np.zeros(len(live), _I64)
            high = np.minimum(sibling[live] + size, end[live]) - sibling[live]
            mine = order[live]
            right = (run[live] & 1).astype(bool)
            while (low < high).any():
                open_ = np.flatnonzero(low < high)
                middle = (low[open_] + high[open_]) >> 1
                other = order[sibling[live[open_]] + middle]
                # Of equal suffixes those of the left run come first.
                up = np.where(right[open_], ~self.before(mine[open_], other), self.before(other, mine[open_]))
                low[open_], high[open_] = np.where(up, middle + 1, low[open_]), np.where(up, high[open_], middle)
            pair = begin[live] + (run[live] // 2) * 2 * size
            new = order.copy()
            new[pair + within[live] % size + low] = mine
            order, size = new, size * 2
        return order


def _cover_range(length: int, parts: int):
    """Spans of the windows that a smaller id holds as well."""
    left = length - GRAM

    def cover(table: pa.Table) -> pa.Table:
        known = table.filter(pc.equal(table.column("kind"), 1))
        fresh = table.filter(pc.equal(table.column("kind"), 0))
        ids, rows = _sums(fresh.column("ids")), _unpack(fresh.column("rows"), _I64)
        key = _grams(fresh.column("contexts"), left + length, left)
        spans = _unpack(fresh.column("spans"), np.int32).reshape(-1, 3)
        # Only keys that are still held twice can repeat.
        order = np.argsort(key, kind="stable")
        twice = np.zeros(len(key), bool)
        equal = key[order][1:] == key[order][:-1]
        twice[order[1:][equal]] = True
        twice[order[:-1][equal]] = True
        context = _wanted_rows(fresh.column("contexts"), left + length, twice)
        key, ids, rows, spans = (x[twice] for x in (key, ids, rows, spans))
        # Bytes of each part become spans before the next part is looked at.
        runs = [_runs(some, covered, spans, length) for some, covered in _in_parts(context, key, ids, spans, length)]
        at, begin, end = (np.concatenate(x) if x else np.zeros(0, _I64) for x in (list(zip(*runs)) or [[]] * 3))
        done = _unpack(known.column("spans"), np.int32).reshape(-1, 3)
        every = np.concatenate([np.stack([begin, end], 1), np.stack([done[:, 0] - done[:, 2], done[:, 0] - done[:, 1] + length], 1)]).astype(np.int32)
        return _by_part(np.concatenate([ids[at], _sums(known.column("ids"))]), np.concatenate([rows[at], _unpack(known.column("rows"), _I64)]), every, parts)

    return cover


def _grams(column: pa.ChunkedArray, width: int, left: int) -> np.ndarray:
    """Hashes of the k-grams, which begin ``left`` bytes into each row; equal for equal ones."""
    out = [np.zeros(0, np.uint64)]
    for blob in column:
        gram = np.ascontiguousarray(_open(blob, np.uint8).reshape(-1, width)[:, left : left + GRAM]).view(np.uint64)
        with np.errstate(over="ignore"):
            out.append(mix(mix(gram[:, 0]) * np.uint64(3) + gram[:, 1]))
    return np.concatenate(out)


def _wanted_rows(column: pa.ChunkedArray, width: int, wanted: np.ndarray) -> np.ndarray:
    """The ``wanted`` ones of the rows of all blobs, of which one is open at a time."""
    out, at, filled = np.empty((int(wanted.sum()), width), np.uint8), 0, 0
    for blob in column:
        rows = _open(blob, np.uint8).reshape(-1, width)
        some = rows[wanted[at : at + len(rows)]]
        out[filled : filled + len(some)] = some
        at, filled = at + len(rows), filled + len(some)
    return out


def _runs(some: np.ndarray, covered: np.ndarray, spans: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entry, first byte and end of every run of covered windows of the entries ``some``."""
    edge = np.zeros((len(covered), 1), bool)
    change = np.diff(np.concatenate([edge, covered, edge], axis=1).astype(np.int8), axis=1)
    at, first = np.nonzero(change == 1)
    _, stop = np.nonzero(change == -1)
    # Column s of ``covered`` is the window that begins s bytes before the anchor.
    place = spans[some[at], 0]
    return some[at], place - (stop - 1), place - first + length


def _in_parts(context: np.ndarray, key: np.ndarray, ids: np.ndarray, spans: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Some entries and their :func:`repeated_windows`, some keys after the others, so that hashes of few contexts are held at a time."""
    order = np.argsort(key, kind="stable")
    starts = np.flatnonzero(np.append(True, key[order][1:] != key[order][:-1])) if len(key) else []
    begin = 0
    while begin < len(key):
        next_key = np.searchsorted(starts, begin + SORTED)
        end = int(starts[next_key]) if next_key < len(starts) else len(key)
        some = order[begin:end]
        yield some, repeated_windows(context[some], key[some], ids[some], spans[some], length)
        begin = end


def _heads(string: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entries sorted by string and id, and for each the first entry of its string."""
    by = np.lexsort((ids, string))
    fresh = np.append(True, string[by][1:] != string[by][:-1])
    return by, by[np.flatnonzero(fresh)[np.cumsum(fresh) - 1]]


def repeated_windows(context: np.ndarray, key: np.ndarray, ids: np.ndarray, spans: np.ndarray, length: int) -> np.ndarray:
    """For each context and distance s: does the window that begins s bytes before the anchor stand at a smaller id?"""
    left, n = length - GRAM, len(key)
    covered = np.zeros((n, left + 1), bool)
    if not n:
        return covered
    suffixes = Suffixes(np.ascontiguousarray(context[:, left:]))
    # Of equal suffixes of a key one is sorted, and the others follow it.
    whole = suffixes.hashes[:, -1]
    order = np.lexsort((whole, key))
    fresh = np.append(True, (key[order][1:] != key[order][:-1]) | (whole[order][1:] != whole[order][:-1]))
    heads = order[fresh]
    rank = np.empty(n, _I64)
    rank[suffixes.sort(heads, key[heads])] = np.arange(len(heads))
    rank[order] = rank[heads][np.cumsum(fresh) - 1]
    order = np.argsort(rank, kind="stable")
    common = np.full(n, suffixes.width, _I64)
    edge = np.flatnonzero(np.append(False, rank[order][1:] != rank[order][:-1]))
    common[edge] = suffixes.extension(order[edge], order[edge - 1])
    common[edge[key[order[edge]] != key[order[edge - 1]]]] = 0
    common[0] = 0
    towards = np.zeros(n, np.uint64)
    for s in range(left + 1):
        if s:
            with np.errstate(over="ignore"):
                towards = mix(towards * np.uint64(3) + context[:, left - s] + np.uint64(1))
        has = (spans[:, 1] <= s) & (s <= spans[:, 2])
        run = np.cumsum(common < length - s)
        some = order[has[order]]
        if len(some) < 2:
            continue
        with np.errstate(over="ignore"):
            string = mix(mix(run[has[order]].astype(np.uint64)) * np.uint64(3) + towards[some])
        columns = slice(left - s, left - s + length)
        windows = context[some, columns]
        by, head = _heads(string, ids[some])
        if not (windows[by] == windows[head]).all():
            # Different strings share a hash: tell them apart by their bytes.
            _, string = np.unique(np.ascontiguousarray(windows).view(f"V{length}").ravel(), return_inverse=True)
            by, head = _heads(string, ids[some])
        mine = some[by[ids[some][by] > ids[some][head]]]
        covered[mine, s] = True
    return covered


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            out = []
            for (_, _, text), blob in zip(_texts(part), part.column("covered")):
                gone = np.zeros(len(text) + 1, np.int64)
                if blob.is_valid:
                    spans = np.frombuffer(blob.as_buffer(), np.int32).reshape(-1, 2)
                    np.add.at(gone, spans[:, 0], 1)
                    np.add.at(gone, spans[:, 1], -1)
                removed = np.cumsum(gone)[:-1] > 0
                begins = removed & ~np.concatenate([[False], removed[:-1]]) if len(text) else removed
                kept = text[~removed].tobytes()
                out.append((len(text), int(removed.sum()), int(begins.sum()), hashlib.sha256(kept).hexdigest(), kept))
            columns = list(zip(*out)) if out else [[]] * 5
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [part.column("given"), *[pa.array(c, k) for c, k in zip(columns, kinds)]], ["given", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
            )


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 50) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256, kept) of every row; ``kept`` are the bytes that stay.

    Removed is each byte covered by a string of ``length`` bytes that also starts in a document with a smaller id,
    judged on the input. Matches lie inside one document. Null texts are empty; a null id is smaller than all
    others; rows with the same id are one document here, so they remove nothing from each other. Rows keep their number.
    """
    if length < GRAM:
        raise ValueError(f"strings have {GRAM} bytes at least")
    spark = docs.sparkSession
    # The ids given may be null; the texts are dealt by (id, row) once, and read again from there.
    texts = document_rows(docs, id_col, text_col).withColumn("text", F.col("text").cast("binary"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges, parts = [max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // each)) for each in (RANGE_BYTES, PART_BYTES)]
    sent = texts.mapInArrow(_flag_scan(length, ranges), _SENT)
    flags = _gathered(sent.groupBy("range").applyInArrow(_flag_range(parts), _FOUND), 1, "flags")
    distinct = texts.withColumn("row", F.coalesce("row", F.lit(0)))
    contexts = distinct.join(flags, ["id", "row"]).select("id", "row", "text", "flags").mapInArrow(_context_scan(length, ranges), _CONTEXT)
    spans = _gathered(contexts.groupBy("range").applyInArrow(_cover_range(length, parts), _FOUND), 2, "covered")
    given = F.when(F.col("id") != -(1 << 63), F.col("id")).alias("given")
    joined = distinct.join(spans, ["id", "row"], "left").select("id", "row", given, "text", "covered")
    done = joined.mapInArrow(_remove, "given bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary")
    return done.withColumnRenamed("given", id_col)
