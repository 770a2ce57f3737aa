"""Packing documents into fixed-length sequences with boundaries, labels, positions and masks.

Batches are consecutive documents of the mix order, so a batch is bounded by ``batch_size`` documents
of at most ``seq_len`` tokens each (longer ones are cut by the packing rule anyway). One shuffle on the
batch number gathers a batch; the rest are array expressions on the batch row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from corpusflow.functions.hashing import int_div

IGNORE = -100


def assign_batches(df: DataFrame, batch_size: int, pos: str = "mix_pos") -> DataFrame:
    """Consecutive documents into micro-batches; the last one may be partial."""
    return df.withColumns(
        {"batch_id": int_div(F.col(pos) - 1, batch_size), "idx": ((F.col(pos) - 1) % batch_size).cast("int")}
    )


def assign_steps(df: DataFrame, accum: int) -> DataFrame:
    """Micro-batches into optimizer steps; the batches of an incomplete last step are dropped."""
    complete = df.agg(F.max("batch_id") + 1)
    stepped = df.withColumn("step", int_div(F.col("batch_id"), accum))
    return stepped.where((F.col("step") + 1) * accum <= complete.scalar())


def sequence_starts(lengths: Column, seq_len: int, docs_per_sequence: int) -> Column:
    """Next-fit over an ordered array of document lengths: the index of the first document of each sequence.

    One token per document is charged for the end token, whether one is configured or not. The fold
    keeps an entry a sequence, not one a document.
    """
    start = F.struct(
        F.array().cast("array<int>").alias("starts"), F.lit(0).alias("used"), F.lit(0).alias("docs"), F.lit(0).alias("i"),
    )

    def step(state: Column, length: Column) -> Column:
        charged = length + 1
        opens = (state["i"] == 0) | (state["used"] + charged > seq_len) | (state["docs"] >= docs_per_sequence)
        return F.struct(
            F.when(opens, F.concat(state["starts"], F.array(state["i"]))).otherwise(state["starts"]).alias("starts"),
            F.when(opens, charged).otherwise(state["used"] + charged).alias("used"),
            F.when(opens, F.lit(1)).otherwise(state["docs"] + 1).alias("docs"), (state["i"] + 1).alias("i"),
        )

    return F.aggregate(lengths, start, step, lambda s: s["starts"])


def _ranges(docs: Column, starts: Column) -> Column:
    """(seq_idx, docs) of every sequence: the slice of the batch's documents from its start to the next one."""
    return F.transform(
        starts,
        lambda first, s: F.struct(
            s.alias("seq_idx"),
            F.slice(docs, first + 1, F.coalesce(F.get(starts, s + 1), F.size(docs)) - first).alias("docs"),
        ),
    )


def _fitted(df: DataFrame, seq_len: int, docs_per_sequence: int, *fields: Column) -> DataFrame:
    """(batch_id, idx, seq_idx, fields) of every document, next-fit by ``n_tokens``; one shuffle by batch."""
    # Capping a length at seq_len changes nothing: such a document opens and fills a sequence anyway.
    length = F.least(F.col("n_tokens"), F.lit(seq_len)).cast("int")
    batches = df.groupBy("batch_id").agg(
        F.array_sort(F.collect_list(F.struct("idx", length.alias("_length"), *fields))).alias("docs")
    )
    starts = sequence_starts(F.transform("docs", lambda d: d["_length"]), seq_len, docs_per_sequence)
    ranges = batches.withColumn("starts", starts).select("batch_id", F.inline(_ranges(F.col("docs"), F.col("starts"))))
    return ranges.select("batch_id", "seq_idx", F.inline("docs")).drop("_length")


def next_fit(df: DataFrame, seq_len: int, docs_per_sequence: int = 4) -> DataFrame:
    """(batch_id, idx, seq_idx) of every document, from (batch_id, idx, n_tokens)."""
    return _fitted(df, seq_len, docs_per_sequence).select("batch_id", "idx", "seq_idx")


def layout(
    df: DataFrame, seq_len: int, docs_per_sequence: int = 4, with_eos: bool = False, key: str = "doc_id"
) -> DataFrame:
    """Where every document lies: (batch_id, seq_idx, idx, key, start, stop), from (batch_id, idx, key, n_tokens).

    Only lengths are read. A document that would start at or after ``seq_len`` has no place. The places
    are window sums in the partitions of the one shuffle by batch.
    """
    placed = _fitted(
        df, seq_len, docs_per_sequence, F.col(key).alias("_key"),
        F.least(F.col("n_tokens") + int(with_eos), F.lit(seq_len)).cast("int").alias("_held"),
    )
    before = Window.partitionBy("batch_id", "seq_idx").orderBy("idx").rowsBetween(Window.unboundedPreceding, -1)
    # Capped, the sum stays within an int whatever number of documents a sequence takes.
    start = F.least(F.coalesce(F.sum("_held").over(before), F.lit(0)), F.lit(seq_len)).cast("int")
    return placed.withColumn("start", start).where(F.col("start") < seq_len).select(
        "batch_id", "seq_idx", "idx", F.col("_key").alias(key), "start",
        F.least(F.col("start") + F.col("_held"), F.lit(seq_len)).alias("stop"),
    )


def layout_boundaries(places: DataFrame, key: str = "doc_id") -> DataFrame:
    """(batch_id, seq_idx, doc_ids, boundaries) from the places of a layout."""
    rows = places.groupBy("batch_id", "seq_idx").agg(
        F.array_sort(F.collect_list(F.struct("idx", F.col(key).alias("doc"), "stop"))).alias("docs")
    )
    return rows.select(
        "batch_id", "seq_idx", F.transform("docs", lambda d: d["doc"]).alias("doc_ids"),
        F.transform("docs", lambda d: d["stop"]).alias("boundaries"),
    )


def layout_fill(places: DataFrame, seq_len: int, boundary_mask: str = "literal") -> DataFrame:
    """What ``fill_report`` says, from the places of a layout: no token is needed to know which labels count."""
    if boundary_mask not in ("literal", "next_first"):
        raise ValueError(f"unknown boundary mask: {boundary_mask}")
    # The joint of a document that has a token is masked, but for the last (or first) one of a sequence.
    edge = F.max("idx") if boundary_mask == "literal" else F.min("idx")
    whole = F.col("idx") == edge.over(Window.partitionBy("batch_id", "seq_idx"))
    size = F.col("stop") - F.col("start")
    valid = places.select("batch_id", "seq_idx", (size - F.when(whole | (size == 0), F.lit(0)).otherwise(F.lit(1))).alias("valid"))
    sequences = valid.groupBy("batch_id", "seq_idx").agg(F.sum("valid").alias("n_valid"))
    return sequences.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("sequences"), F.sum("n_valid").alias("valid_labels"),
        (F.sum("n_valid") / (F.count(F.lit(1)) * F.lit(seq_len))).alias("fill"),
    )


def layout_offsets(places: DataFrame, seq_len: int | None = None, cu_seqlens: str = "literal") -> DataFrame:
    """What ``batch_offsets`` says, from the places of a layout: (batch_id, cu_seqlens, max_seqlen)."""
    if cu_seqlens not in ("literal", "padded"):
        raise ValueError(f"unknown offsets mode: {cu_seqlens}")
    if cu_seqlens == "padded" and seq_len is None:
        raise ValueError("padded offsets need seq_len")
    size = F.col("stop") - F.col("start")
    if cu_seqlens == "literal":
        along = Window.partitionBy("batch_id").orderBy("seq_idx", "idx").rowsBetween(Window.unboundedPreceding, 0)
        end = F.sum(size).over(along).cast("int")
    else:
        end = F.col("stop") + F.col("seq_idx") * F.lit(seq_len)
    ends = places.select("batch_id", "seq_idx", "idx", end.alias("end"), size.alias("size"))
    listed = F.array_sort(F.collect_list(F.struct("seq_idx", "idx", "end")))
    return ends.groupBy("batch_id").agg(listed.alias("ends"), F.max("size").alias("max_seqlen")).select(
        "batch_id", F.concat(F.array(F.lit(0)), F.transform("ends", lambda e: e["end"])).alias("cu_seqlens"), "max_seqlen",
    )


def _places(packed: DataFrame) -> DataFrame:
    """The places of packed sequences, told by their boundaries; no other array is read."""
    along = Window.partitionBy("batch_id", "seq_idx").orderBy("idx")
    ends = packed.select("batch_id", "seq_idx", F.posexplode("boundaries").alias("idx", "stop"))
    return ends.withColumn("start", F.lag("stop", 1, 0).over(along))


def cut_ends(lengths: Column, seq_len: int) -> Column:
    """Cumulative end offsets of the documents of a sequence, cut at ``seq_len``.

    Documents that would start at or after ``seq_len`` have no end and are left out.
    """
    start = F.struct(F.array().cast("array<int>").alias("ends"), F.lit(0).alias("used"))

    def step(state: Column, length: Column) -> Column:
        end = F.least(state["used"] + length, F.lit(seq_len))
        return F.struct(
            F.when(state["used"] >= seq_len, state["ends"]).otherwise(F.concat(state["ends"], F.array(end))).alias("ends"),
            end.alias("used"),
        )

    return F.aggregate(lengths, start, step, lambda s: s["ends"])


def _starts(ends: Column) -> Column:
    return F.slice(F.concat(F.array(F.lit(0)), ends), 1, F.size(ends))


def _fill(ends: Column, seq_len: int) -> Column:
    return seq_len - F.coalesce(F.array_max(ends), F.lit(0))


def position_ids(ends: Column, seq_len: int) -> Column:
    """Positions that restart in every document; zero in the padding."""
    runs = F.transform(
        F.arrays_zip(_starts(ends).alias("start"), ends.alias("stop")),
        lambda d: F.when(d["stop"] > d["start"], F.sequence(F.lit(0), d["stop"] - d["start"] - 1))
        .otherwise(F.array().cast("array<int>")),
    )
    return F.concat(F.flatten(runs), F.array_repeat(F.lit(0), _fill(ends, seq_len)))


def allowed_start(ends: Column, seq_len: int) -> Column:
    """Compact mask: token i may see tokens allowed_start[i]..i; padding holds -1 and sees nothing."""
    runs = F.transform(
        F.arrays_zip(_starts(ends).alias("start"), ends.alias("stop")),
        lambda d: F.array_repeat(d["start"], d["stop"] - d["start"]),
    )
    return F.concat(F.flatten(runs), F.array_repeat(F.lit(-1), _fill(ends, seq_len)))


def dense_mask(starts: Column) -> Column:
    """The s x s mask from the compact one, True where seeing is not allowed."""
    size = F.size(starts)
    return F.transform(
        starts,
        lambda start, i: F.transform(
            F.sequence(F.lit(0), size - 1), lambda j: ~((start >= 0) & (j >= start) & (j <= i))
        ),
    )


def labels(input_ids: Column, ends: Column, boundary_mask: str = "literal") -> Column:
    """Copy of the ids with -100 on padding and at the joints between documents.

    ``literal`` masks the last token of every document but the last; ``next_first`` masks the first
    token of every document but the first instead, which is the target that crosses documents once
    the loss shifts the labels.
    """
    if boundary_mask not in ("literal", "next_first"):
        raise ValueError(f"unknown boundary mask: {boundary_mask}")
    ignored = F.array(F.lit(IGNORE))
    docs = F.arrays_zip(_starts(ends).alias("start"), ends.alias("stop"))

    def run(doc: Column, i: Column) -> Column:
        first, length = doc["start"] + 1, doc["stop"] - doc["start"]
        if boundary_mask == "literal":
            whole = i == F.size(ends) - 1
            joint = F.concat(F.slice(input_ids, first, length - 1), ignored)
        else:
            whole = i == 0
            joint = F.concat(ignored, F.slice(input_ids, first + 1, length - 1))
        return F.when(whole | (length == 0), F.slice(input_ids, first, length)).otherwise(joint)

    fill = F.size(input_ids) - F.coalesce(F.array_max(ends), F.lit(0))
    return F.concat(F.flatten(F.transform(docs, run)), F.array_repeat(F.lit(IGNORE), fill))


def pack(
    df: DataFrame, seq_len: int, docs_per_sequence: int = 4, eos_id: int | None = None, pad_id: int = 0,
    boundary_mask: str = "literal", include_mask: bool = True, key: str = "doc_id",
    together: str | None = None,
) -> DataFrame:
    """One row per packed sequence from (batch_id, idx, key, ids).

    Columns: batch_id, seq_idx, doc_ids, input_ids, labels, position_ids, boundaries, n_valid and, unless
    switched off, allowed_start. ``together`` names a column that a batch determines, such as its step:
    rows are shuffled by it, so that the batches of one value are packed by one task and can be
    written to few files without another shuffle.
    """
    ending = F.array(F.lit(eos_id)) if eos_id is not None else F.array().cast("array<int>")
    # A document contributes at most seq_len tokens to its sequence, so only those are gathered.
    doc = F.struct(
        "idx", F.col(key).alias("doc"), F.least(F.size("ids"), F.lit(seq_len)).alias("length"),
        F.slice(F.concat("ids", ending), 1, seq_len).alias("ids"),
    )
    by = [together, "batch_id"] if together else ["batch_id"]
    spread = df.repartition(together) if together else df
    batches = spread.groupBy(*by).agg(F.array_sort(F.collect_list(doc)).alias("docs"))
    starts = sequence_starts(F.transform("docs", lambda d: d["length"]), seq_len, docs_per_sequence)
    mine = batches.withColumn("starts", starts).select(*by, F.inline(_ranges(F.col("docs"), F.col("starts"))))
    laid = mine.select(
        *by, "seq_idx", F.transform("docs", lambda d: d["doc"]).alias("doc_ids"),
        cut_ends(F.transform("docs", lambda d: F.size(d["ids"])), seq_len).alias("boundaries"),
        F.slice(F.flatten(F.transform("docs", lambda d: d["ids"])), 1, seq_len).alias("_ids"),
    )
    filled = laid.withColumn(
        "input_ids", F.concat("_ids", F.array_repeat(F.lit(pad_id), seq_len - F.size("_ids")))
    )
    out = filled.select(
        *by, "seq_idx", F.slice("doc_ids", 1, F.size("boundaries")).alias("doc_ids"), "input_ids",
        labels(F.col("input_ids"), F.col("boundaries"), boundary_mask).alias("labels"),
        position_ids(F.col("boundaries"), seq_len).alias("position_ids"), "boundaries",
        *([allowed_start(F.col("boundaries"), seq_len).alias("allowed_start")] if include_mask else []),
    )
    return out.withColumn("n_valid", valid_labels(F.col("boundaries"), boundary_mask))


def valid_labels(ends: Column, boundary_mask: str = "literal") -> Column:
    """Number of labels that are not ignored: all tokens but one of every non-empty document save the last (or first)."""
    sizes = F.zip_with(ends, _starts(ends), lambda stop, start: stop - start)
    inner = F.slice(sizes, 1 if boundary_mask == "literal" else 2, F.greatest(F.size(ends) - 1, F.lit(0)))
    return F.coalesce(F.array_max(ends), F.lit(0)) - F.size(F.filter(inner, lambda n: n > 0))


def batch_offsets(packed: DataFrame, seq_len: int | None = None, cu_seqlens: str = "literal") -> DataFrame:
    """Cumulative document lengths over each batch and its longest document.

    ``literal`` skips the padding between sequences; ``padded`` counts from the real start of every
    sequence, so that the offsets fit the flattened batch (needs ``seq_len``).
    """
    return layout_offsets(_places(packed), seq_len, cu_seqlens)


def flatten_batch(packed: DataFrame) -> DataFrame:
    """Each batch as one token stream with its labels, offsets and longest document."""
    rows = packed.groupBy("batch_id").agg(
        F.array_sort(F.collect_list(F.struct("seq_idx", "input_ids", "labels"))).alias("seqs")
    )
    flat = rows.select(
        "batch_id", F.flatten(F.transform("seqs", lambda s: s["input_ids"])).alias("input_ids"),
        F.flatten(F.transform("seqs", lambda s: s["labels"])).alias("labels"),
    )
    return flat.join(batch_offsets(packed), "batch_id")


def fill_report(packed: DataFrame) -> DataFrame:
    """Sequences, non-ignored labels and the share of label slots they fill, per batch."""
    return packed.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("sequences"), F.sum("n_valid").cast("bigint").alias("valid_labels"),
        (F.sum("n_valid") / F.sum(F.size("labels"))).alias("fill"),
    )
