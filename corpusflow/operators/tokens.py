"""Vocabulary, encoding, padding and decoding.

Looking a token up does not need a join that explodes every text and shuffles every token. The
vocabulary has a fixed size, so it travels as one value: an array of small maps, addressed by a hash of
the token (encode), or an array of tokens addressed by id (decode). Both work inside the scan's stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from corpusflow.functions.text import SPACES, words
from corpusflow.operators.ordering import ordered_position
from corpusflow.session import materialise

# The special tokens and their ids.
UNK, BOS, EOS, PAD = "<unk>", "<s>", "</s>", "<pad>"
UNK_ID, BOS_ID, EOS_ID, PAD_ID = 0, 1, 2, 3
SPECIALS = (UNK, BOS, EOS, PAD)

#: Defaults of the bounds on a vocabulary that travels with the tasks: entries, and bytes of its tokens.
MAX_VOCAB = 1_000_000
MAX_VOCAB_BYTES = 64 << 20


def _frequent(counts: DataFrame, wanted: int) -> DataFrame:
    """The tokens that can be among the ``wanted`` most frequent: those whose count has enough digits.

    The binary lengths of the counts make at most 64 groups. Their sizes tell from which length on there
    are enough tokens, so the long tail is neither sorted nor written.
    """
    length = F.length(F.bin("n"))
    sizes = counts.groupBy(length.alias("length")).agg(F.count(F.lit(1)).alias("tokens"))
    above = F.sum("tokens").over(Window.orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, 0))
    least = sizes.withColumn("above", above).where(F.col("above") >= wanted).agg(F.max("length")).scalar()
    return counts.where(length >= F.coalesce(least, F.lit(0)))


def build_vocab(df: DataFrame, size: int, with_pad: bool = True, text: str = "text") -> DataFrame:
    """The most frequent whitespace tokens as (token, n, id), special tokens first.

    Ids follow (count descending, token). Without a pad token of its own, ``<pad>`` gets the id of
    the end token. A vocabulary may have any size; ``encode`` and ``decode`` bound the one they carry.
    """
    if size <= len(SPECIALS):
        raise ValueError(f"vocabulary size must be more than {len(SPECIALS)}, got {size}")
    spark = df.sparkSession
    first = len(SPECIALS)
    # Dropping empty pieces after the explode keeps the filter in generated code.
    pieces = df.select(F.explode(F.split(F.col(text), SPACES)).alias("token")).where(F.col("token") != "")
    counts = pieces.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    ranked = ordered_position(
        _frequent(counts, size - first).withColumn("_down", -F.col("n")), [], ["_down", "token"], "rank"
    )
    common = ranked.where(F.col("rank") <= size - first).select(
        "token", "n", (F.col("rank") + (first - 1)).cast("int").alias("id")
    )
    pad_id = PAD_ID if with_pad else EOS_ID
    special = spark.createDataFrame(
        [(UNK, 0, UNK_ID), (BOS, 0, BOS_ID), (EOS, 0, EOS_ID), (PAD, 0, pad_id)], "token string, n bigint, id int"
    )
    return materialise(special.unionByName(common), "vocab")


def vocab_size(vocab: DataFrame) -> DataFrame:
    """Size and the ids of the special tokens, as one row."""
    pick = lambda token: F.max(F.when(F.col("token") == token, F.col("id")))
    return vocab.agg(
        F.countDistinct("id").alias("vocab_size"),
        pick(BOS).alias("bos_id"), pick(EOS).alias("eos_id"),
        F.coalesce(pick(PAD), pick(EOS)).alias("pad_id"),
    )


def _slot(token: Column, slots: int) -> Column:
    return F.pmod(F.hash(token), F.lit(slots))


def _token_slots(vocab: DataFrame, slots: int) -> DataFrame:
    """One row: array of ``slots`` maps token -> id. Its size was checked before."""
    filled = vocab.where(F.col("id") >= len(SPECIALS)).groupBy(_slot(F.col("token"), slots).alias("slot")).agg(
        F.map_from_entries(F.collect_list(F.struct("token", "id"))).alias("ids")
    )
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<int>"))
    every = vocab.sparkSession.range(slots).select(F.col("id").cast("int").alias("slot")).join(filled, "slot", "left")
    listed = F.collect_list(F.struct("slot", F.coalesce("ids", empty).alias("ids")))
    return every.agg(
        F.transform(F.array_sort(listed, lambda a, b: a["slot"] - b["slot"]), lambda s: s["ids"]).alias("slots")
    )


def checked_size(vocab: DataFrame, max_entries: int, max_bytes: int) -> int:
    """Entries of a vocabulary that is small enough to travel with the tasks; one that is not raises an error."""
    size, held = vocab.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("token")), F.lit(0))).first()
    if size > max_entries:
        raise ValueError(f"the vocabulary has {size} entries, more than {max_entries}; encode_any and decode_any take any number")
    if held > max_bytes:
        raise ValueError(f"the tokens of the vocabulary take {held} bytes, more than {max_bytes}")
    return size


def encode(
    df: DataFrame, vocab: DataFrame, max_length: int | None = None, add_bos: bool = False, add_eos: bool = False,
    text: str = "text", out: str = "ids", max_entries: int = MAX_VOCAB, max_bytes: int = MAX_VOCAB_BYTES,
) -> DataFrame:
    """Token ids of ``text`` in column ``out``; unknown tokens get id 0.

    Special tokens are added first, then the whole is cut to ``max_length`` (None or 0 keeps all). The
    vocabulary travels as one value; more entries than ``max_entries`` or token bytes than ``max_bytes`` are an error.
    """
    slots = max(1, checked_size(vocab, max_entries, max_bytes) // 4)
    looked_up = df.withColumn("_slots", _token_slots(vocab, slots).scalar())
    find = lambda w: F.coalesce(F.try_element_at(F.col("_slots")[_slot(w, slots)], w), F.lit(UNK_ID))
    found = words(F.coalesce(F.col(text), F.lit("")))
    # Words beyond the cut are not looked up.
    found = F.slice(found, 1, max_length) if max_length else found
    encoded = looked_up.withColumn(out, F.transform(found, find)).drop("_slots")
    if add_bos or add_eos:
        parts = [F.array(F.lit(BOS_ID))] * add_bos + [F.col(out)] + [F.array(F.lit(EOS_ID))] * add_eos
        encoded = encoded.withColumn(out, F.concat(*parts))
    return encoded.withColumn(out, F.slice(out, 1, max_length)) if max_length else encoded


def padded(ids: Column, length: int, pad_id: int = PAD_ID) -> Column:
    """Ids cut or right-padded to ``length``."""
    return F.concat(F.slice(ids, 1, length), F.array_repeat(F.lit(pad_id), length - F.least(F.size(ids), F.lit(length))))


def attention_mask(ids: Column, length: int) -> Column:
    """1 on tokens, 0 on padding."""
    kept = F.least(F.size(ids), F.lit(length))
    return F.concat(F.array_repeat(F.lit(1), kept), F.array_repeat(F.lit(0), length - kept))


def pad(df: DataFrame, length: int, pad_id: int = PAD_ID, ids: str = "ids") -> DataFrame:
    """Adds ``input_ids`` and ``attention_mask``, both of the given length."""
    return df.withColumns(
        {"input_ids": padded(F.col(ids), length, pad_id), "attention_mask": attention_mask(F.col(ids), length)}
    )


def decode(
    df: DataFrame, vocab: DataFrame, skip_special: bool = True, ids: str = "ids", out: str = "text",
    max_entries: int = MAX_VOCAB, max_bytes: int = MAX_VOCAB_BYTES,
) -> DataFrame:
    """Text of the ids, tokens joined by one space; an id that the vocabulary does not have gives ``<unk>``.
    The bounds are those of ``encode``."""
    checked_size(vocab, max_entries, max_bytes)
    last = vocab.agg(F.max("id")).scalar()
    named = vocab.groupBy("id").agg(F.min("token").alias("token"))
    # Ids may have gaps: without a pad token of its own the vocabulary has no id 3.
    every = vocab.sparkSession.range(1).select(F.explode(F.sequence(F.lit(0), last)).alias("id")).join(named, "id", "left")
    listed = F.array_sort(F.collect_list(F.struct("id", F.coalesce("token", F.lit(UNK)).alias("token"))))
    ordered = every.agg(F.transform(listed, lambda e: e["token"]).alias("tokens"))
    kept = F.filter(F.col(ids), lambda i: i >= len(SPECIALS)) if skip_special else F.col(ids)
    looked_up = df.withColumn("_tokens", ordered.scalar())
    find = lambda i: F.coalesce(F.try_element_at(F.col("_tokens"), i + 1), F.lit(UNK))
    return looked_up.withColumn(out, F.array_join(F.transform(kept, find), " ")).drop("_tokens")


def token_totals(df: DataFrame, by: str, ids: str = "ids") -> DataFrame:
    """Documents and tokens per ``by``."""
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("docs"), F.sum(F.size(ids)).alias("tokens"))


# ------------------------------------------------------------------ vocabularies of any size

#: Bytes of text, or four times the ids, of a slice, and the lists among which its dictionary is dealt.
SLICE_BYTES, SLICE_LISTS = 2 << 20, 4096


def _looked_up(
    df: DataFrame, key: str, values: Column, size: Column, entries: DataFrame, entry: str, answer: str, missing: Column, out: str
) -> DataFrame:
    """Adds ``out``: for each of the ``values`` the ``answer`` of its ``entry``, or ``missing``.

    Rows are put together in slices of about SLICE_BYTES. The distinct values of a slice, not the
    values, meet the entries, and come back as the slice's own dictionary: neither a task nor the driver holds
    all entries, and a value that is everywhere is asked for once a slice.
    """
    row = F.struct(*[F.col(c) for c in df.columns])
    total = df.agg(F.coalesce(F.sum(size.cast("bigint")), F.lit(0))).first()[0]
    slices = total // SLICE_BYTES + 1
    sliced = df.select(F.pmod(F.xxhash64(key), F.lit(slices)).alias("_slice"), row.alias("_row"), values.alias("_values"))
    asked = sliced.select("_slice", F.explode("_values").alias(entry)).distinct()
    told = asked.join(entries.select(entry, answer), entry)
    at = F.pmod(F.hash(entry), F.lit(SLICE_LISTS))
    lists = told.groupBy("_slice", at.alias("_list")).agg(F.map_from_entries(F.collect_list(F.struct(entry, answer))).alias("_map"))
    books = lists.groupBy("_slice").agg(F.map_from_entries(F.collect_list(F.struct("_list", "_map"))).alias("_book"))
    whole = F.transform(F.sequence(F.lit(0), F.lit(SLICE_LISTS - 1)), lambda k: F.try_element_at("_book", k))
    gathered = sliced.groupBy("_slice").agg(F.collect_list(F.struct("_row", "_values")).alias("_rows"))
    joined = gathered.join(books.select("_slice", whole.alias("_lists")), "_slice", "left")
    find = lambda v: F.coalesce(F.try_element_at(F.get("_lists", F.pmod(F.hash(v), F.lit(SLICE_LISTS))), v), missing)
    found = F.transform(
        "_rows", lambda r: F.struct(r["_row"].alias("_row"), F.transform(r["_values"], find).alias(out))
    )
    told_rows = joined.select(F.inline(found))
    return told_rows.select(*[F.col("_row")[c].alias(c) for c in df.columns if c != out], out)


def encode_any(
    df: DataFrame, vocab: DataFrame, key: str, max_length: int | None = None, add_bos: bool = False, add_eos: bool = False,
    text: str = "text", out: str = "ids",
) -> DataFrame:
    """What ``encode`` gives, for a vocabulary of any size: it is shuffled by token instead of travelling.

    ``key`` tells rows apart and deals them to slices.
    """
    found = words(F.coalesce(F.col(text), F.lit("")))
    found = F.slice(found, 1, max_length) if max_length else found
    size = F.coalesce(F.octet_length(text), F.lit(0))
    # Special tokens are no words, as in ``encode``.
    ordinary = vocab.where(F.col("id") >= len(SPECIALS))
    coded = _looked_up(df, key, found, size, ordinary, "token", "id", F.lit(UNK_ID), out)
    parts = [F.array(F.lit(BOS_ID))] * add_bos + [F.col(out)] + [F.array(F.lit(EOS_ID))] * add_eos
    coded = coded.withColumn(out, F.concat(*parts)) if len(parts) > 1 else coded
    return coded.withColumn(out, F.slice(out, 1, max_length)) if max_length else coded


def decode_any(df: DataFrame, vocab: DataFrame, key: str, skip_special: bool = True, ids: str = "ids", out: str = "text") -> DataFrame:
    """What ``decode`` gives, for a vocabulary of any size."""
    kept = F.filter(F.col(ids), lambda i: i >= len(SPECIALS)) if skip_special else F.col(ids)
    named = vocab.groupBy("id").agg(F.min("token").alias("token"))
    size = F.coalesce(F.size(ids), F.lit(0)) * 4
    known = df.where(F.col(ids).isNotNull())
    found = _looked_up(known, key, kept, size, named, "id", "token", F.lit(UNK), "_found")
    shown = found.withColumn(out, F.array_join("_found", " ")).drop("_found")
    unknown = df.where(F.col(ids).isNull()).withColumn(out, F.lit(None).cast("string"))
    return shown.unionByName(unknown)
