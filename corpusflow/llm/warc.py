"""WARC archives: writing with revisits, reading by boundary-chain verification.

Writing: of pages with equal payloads of 100 bytes or more the one with the smallest id is a response,
the others revisit it and carry no payload. Records go through the text sink, whose line end is the
last byte of each record, so files are committed as Spark commits them.

Reading: tasks look for the magic of a record anywhere in a file, payloads included, and emit each place with
the place where the next record would begin by its header. Pointer jumping from the start of the file
then retains the places that the chain of records reaches; magic inside payloads is not among them. The
chain has to end at the end of the file, or the archive is refused.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from corpusflow.session import materialise, scratch_path

# Fixed values of the format.
MAGIC = b"WARC/1.0\r\n"
GAP = b"\r\n\r\n"
#: Shortest payload that is worth a revisit.
LEAST_BYTES = 100
#: Records are written by the bytes of address and payload: those of at most so many, so many to a file. With their headers
#: a file has about 64 MB at most, or one record; larger ones, the last of the table, have files of their own.
FILES = ((8 << 10, 8192), (256 << 10, 256), (None, 1))
SCHEMA = (
    "file string, offset bigint, next bigint, size bigint, record_id string, target_uri string, record_type string, "
    "refers_to string, payload_bytes bigint, payload_digest string"
)


def _revisits(pages: DataFrame) -> DataFrame:
    """(page_id, row, first) of the pages that revisit another: narrow, and written down before the join with payloads."""
    narrow = pages.where(F.octet_length("payload") >= LEAST_BYTES).select("page_id", "row", "digest")
    firsts = narrow.groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return materialise(
        narrow.join(firsts, "digest").where("first is not null and not page_id <=> first").select("page_id", "row", "first").distinct(), "revisits"
    )


def _line(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))


def write_archive(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                  date: str = "1970-01-01T00:00:00Z") -> None:
    """Write a record per row of ``pages`` below ``path``.

    A null payload is an empty one. Rows that share id and payload are all responses if the id is the
    smallest; null ids revisit a page that has one. Line ends in addresses become spaces. Addresses and
    payloads may have any length that a value can have.
    """
    keyed = pages.select(
        F.col(id_col).cast("bigint").alias("page_id"), F.coalesce(F.col(url_col).cast("string"), F.lit("")).alias("url"),
        F.coalesce(F.col(payload_col).cast("string"), F.lit("")).alias("payload"),
    ).withColumns({
        "row": F.xxhash64("payload"), "digest": F.sha2("payload", 256), "bytes": F.octet_length("payload").cast("bigint") + F.octet_length("url"),
    })
    revisits = _revisits(keyed).select(F.col("page_id").alias("_id"), F.col("row").alias("_row"), "first")
    least = -1
    for number, (most, records) in enumerate(FILES):
        sized = keyed.where(F.col("bytes") > least) if most is None else keyed.where((F.col("bytes") > least) & (F.col("bytes") <= most))
        _write_records(sized, revisits, f"{path}/{number}", records, date)
        least = most


def _write_records(keyed: DataFrame, revisits: DataFrame, path: str, records: int, date: str) -> None:
    joined = keyed.join(revisits, F.col("page_id").eqNullSafe(F.col("_id")) & (F.col("row") == F.col("_row")), "left")
    again = F.col("first").isNotNull()
    block = F.when(again, "").otherwise(F.col("payload"))
    header = F.concat(
        F.lit(MAGIC.decode()),
        _line("WARC-Type", F.when(again, "revisit").otherwise("response")),
        _line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(">"))),
        _line("WARC-Target-URI", F.regexp_replace("url", "[\r\n]", " ")),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        _line("X-Payload-Length", F.octet_length("payload").cast("string")),
        F.when(again, _line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("first").cast("string"), F.lit(">")))).otherwise(""),
        _line("Content-Type", F.lit("text/html; charset=utf-8")),
        _line("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"),
    )
    record = F.concat(header, block, F.lit("\r\n\r"))
    joined.select(record.alias("value")).write.option("maxRecordsPerFile", records).option("lineSep", "\n").text(path)


def _fields(header: bytes) -> dict[str, str]:
    lines = header.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}


def candidates(name: str, content: bytes, payload: bool) -> Iterator[tuple]:
    """Every place that could begin a record, with its successor; places without a whole record are left out.

    No header holds the magic, so that of two magics before the end of a header the second one counts. That
    keeps the work in proportion to the content, however long headers are.
    """
    view = memoryview(content)
    places = [found.start() for found in re.finditer(re.escape(MAGIC), content)]
    end = content.find(GAP)
    for offset, following in zip(places, [*places[1:], len(content)]):
        if 0 <= end < offset:
            end = content.find(GAP, offset)
        if end < 0 or end > following:
            continue
        fields = _fields(content[offset:end])
        length = fields.get("content-length", "")
        if not re.fullmatch("[0-9]{1,18}", length):
            continue
        begin, stop = end + len(GAP), end + len(GAP) + int(length)
        if content[stop : stop + len(GAP)] != GAP:
            continue
        whole = fields.get("warc-type") != "revisit"
        block = view[begin:stop]
        told = fields.get("x-payload-length", "")
        yield (
            name, offset, stop + len(GAP), len(content), fields.get("warc-record-id"), fields.get("warc-target-uri"), fields.get("warc-type"),
            fields.get("warc-refers-to"), int(length) if whole else int(told) if told.isdigit() else None,
            hashlib.sha256(block).hexdigest() if whole else fields.get("warc-payload-digest", "").partition(":")[2] or None,
            *([bytes(block)] if payload else []),
        )


def reached(offset: np.ndarray, following: np.ndarray, size: int) -> np.ndarray:
    """Which of the sorted places the chain from 0 reaches, by pointer jumping.

    In round k every reached place marks the place 2^k records on, and all pointers double. Raises
    ValueError if the chain does not end at ``size``.
    """
    n = len(offset)
    at = np.searchsorted(offset, following)
    known = (at < n) & (offset[np.minimum(at, n - 1)] == following) if n else np.zeros(0, bool)
    # Place n is the end of the file, place n + 1 nowhere.
    jump = np.append(np.where(known, at, np.where(following == size, n, n + 1)), [n, n + 1]).astype(np.int64)
    marked = np.zeros(n + 2, dtype=bool)
    marked[0 if n and offset[0] == 0 else n if size == 0 else n + 1] = True
    for _ in range(max(n, 1).bit_length() + 1):
        marked[jump[marked]] = True
        jump = jump[jump]
    if marked[n + 1] or not marked[n]:
        raise ValueError("the chain of records breaks off before the end of the file")
    return marked[:n]


def read_archive(spark: SparkSession, path: str, payload: bool = False) -> DataFrame:
    """One row per record of the archives below ``path``: place, header fields, size and digest, and the payload if asked for.

    ``payload_bytes`` and ``payload_digest`` are those of the full payload, computed for responses and
    told by the header for revisits. An empty folder gives no rows.
    """
    schema = SCHEMA + (", payload binary" if payload else "")
    names = [part.split()[0] for part in schema.split(", ")]
    kinds = [pa.string() if part.endswith("string") else pa.binary() if part.endswith("binary") else pa.int64() for part in schema.split(", ")]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0), batch.column(1)):
                rows = list(candidates(name.as_py(), content.as_buffer().to_pybytes(), payload))
                if not rows and len(content.as_buffer()):
                    raise ValueError(f"no record in {name.as_py()}")
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * len(names), kinds)], names)

    def chain(table: pa.Table) -> pa.Table:
        table = table.sort_by("offset")
        keep = reached(table.column("offset").to_numpy(), table.column("next").to_numpy(), table.column("size")[0].as_py())
        return table.filter(pa.array(keep))

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").option("recursiveFileLookup", True).load(path).select("path", "content")
    return files.mapInArrow(scan, schema).groupBy("file").applyInArrow(chain, schema)


def archived(pages: DataFrame) -> DataFrame:
    """Write ``pages`` to a new archive in the shared folder, read it back, and return what it says of each page."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_archive(pages, path)
    page = F.regexp_extract(F.col("record_id"), "^<urn:page:(.*)>$", 1)
    first = F.regexp_extract(F.col("refers_to"), "^<urn:page:(.*)>$", 1)
    return read_archive(spark, path).select(
        F.when(page != "", page).cast("bigint").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.when(first != "", first).cast("bigint").alias("refers_to"),
    )
