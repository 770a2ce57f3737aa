"""Running totals, positions and trailing frames over a total order, without one giant task.

A window that is only partitioned by ``run`` or ``domain`` puts the largest group into one task.
Here every group is first cut into chunks that respect the order. Running values are computed inside
the chunks, one total per (group, chunk) is carried over to the later chunks, and the two are
combined. Trailing frames over the last n rows copy the last n rows of each block to the next one.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from corpusflow.functions.hashing import HASH_SPAN, int_div
from corpusflow.session import materialise

CHUNK = "_chunk"
#: Rows in a chunk whose bounds follow from a dense position or an arrival time. A hundred billion rows
#: make about a hundred thousand chunk totals, a few megabytes.
CHUNK_ROWS = 1 << 20
#: Rows of one block in trailing frames.
BLOCK_ROWS = 65_536


@dataclass(frozen=True)
class Running:
    """An aggregate along an order: ``how`` is sum, min or max.

    ``exclusive`` leaves out the current row; ``whole`` covers the whole group instead of its start.
    """

    how: str
    value: Column
    exclusive: bool = False
    whole: bool = False

    def local(self, column: str, inside: WindowSpec) -> Column:
        """The aggregate within the row's own chunk."""
        stop = Window.unboundedFollowing if self.whole else -1 if self.exclusive else Window.currentRow
        return getattr(F, self.how)(column).over(inside.rowsBetween(Window.unboundedPreceding, stop))

    def carry(self, column: str, chunks: WindowSpec) -> Column:
        """The aggregate over the earlier chunks, or over all of them."""
        stop = Window.unboundedFollowing if self.whole else -1
        return getattr(F, self.how)(column).over(chunks.rowsBetween(Window.unboundedPreceding, stop))

    def combine(self, carried: Column, local: Column) -> Column:
        if self.whole:
            return F.coalesce(carried, local)
        if self.how == "sum":
            return F.coalesce(carried, F.lit(0)) + F.coalesce(local, F.lit(0))
        return (F.least if self.how == "min" else F.greatest)(carried, local)


def row_count() -> Running:
    """Running count of rows, that is the 1-based position."""
    return Running("sum", F.lit(1).cast("bigint"))


def chunk_by_hash(df: DataFrame, bits: Column) -> Column:
    """Chunk of a row whose order key is a 48-bit hash: equal slices of the hash range."""
    slices = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return F.floor(bits / F.lit(HASH_SPAN / slices)).cast("bigint")


def present(df: DataFrame, group: Sequence[str]) -> dict[str, Column]:
    """The group columns, with an error where one is null: totals are carried over by plain equality,
    which keeps the rows in the partitions where their windows ran."""
    return {g: F.coalesce(g, F.raise_error(F.lit(f"{g} is null")).cast(df.schema[g].dataType)) for g in group}


def range_chunks(df: DataFrame, keys: Sequence[Column | str], parts: int | None = None) -> DataFrame:
    """Range-partition by the keys and keep the partition number as the chunk, written down.

    The bounds come from a sample, so the numbered rows are materialised: everything later reads
    the same chunks, retries included.
    """
    ranged = df.repartitionByRange(parts, *keys) if parts else df.repartitionByRange(*keys)
    return materialise(ranged.withColumn(CHUNK, F.spark_partition_id().cast("bigint")), "chunks")


def running(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column | str],
    outs: Mapping[str, Running],
    chunk: Column | None = None,
    stage: bool = True,
    parts: int | None = None,
) -> DataFrame:
    """Add running aggregates over ``order`` within ``group``; ``order`` must be a total order.

    Group columns must not be null. ``chunk`` may name a column expression that never decreases along
    the order. Then no range sampling is needed; ``stage=False`` additionally skips writing the rows
    down, which suits inputs that are cheap to compute twice and whose groups were checked before.
    """
    group = list(group)
    order = list(order)
    values = {f"_v_{out}": spec.value for out, spec in outs.items()}
    if chunk is None:
        staged = range_chunks(df.withColumns(values).withColumns(present(df, group)), group + order, parts)
    else:
        # Values first: they may read the columns that the results replace.
        staged = df.withColumns({**values, CHUNK: chunk})
        if stage:
            staged = materialise(staged.withColumns(present(df, group)), "chunks")

    inside = Window.partitionBy(*group, CHUNK).orderBy(*order)
    local = staged.withColumns({f"_l_{out}": s.local(f"_v_{out}", inside) for out, s in outs.items()})

    totals = staged.groupBy(*group, CHUNK).agg(
        *[getattr(F, s.how)(f"_v_{out}").alias(f"_t_{out}") for out, s in outs.items()]
    )
    # One row per (group, chunk); groups that lie in a single chunk have nothing to carry. Range
    # chunks hold at most one group that began earlier, so what is left is small.
    chunks = Window.partitionBy(*group).orderBy(CHUNK)
    keys = [F.col(k).alias(f"_k{i}") for i, k in enumerate([*group, CHUNK])]
    carried = totals.select(
        *keys, F.count(F.lit(1)).over(Window.partitionBy(*group)).alias("_chunks"),
        *[s.carry(f"_t_{out}", chunks).alias(f"_c_{out}") for out, s in outs.items()],
    ).where(F.col("_chunks") > 1)
    match = F.lit(True)
    for i, k in enumerate([*group, CHUNK]):
        match = match & (F.col(f"_k{i}") == F.col(k))
    joined = local.join(carried, match, "left")
    return joined.select(
        *[F.col(c) for c in df.columns if c not in outs],
        *[s.combine(F.col(f"_c_{out}"), F.col(f"_l_{out}")).alias(out) for out, s in outs.items()],
    )


def ordered_position(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column | str],
    out: str = "pos",
    **kwargs,
) -> DataFrame:
    """1-based position of every row within its group."""
    return running(df, group, order, {out: row_count()}, **kwargs)


def trailing(
    df: DataFrame,
    group: Sequence[str],
    pos: str,
    frame: tuple[int, int],
    outs: Mapping[str, Column],
    block_rows: int | None = None,
) -> DataFrame:
    """Aggregates over the rows ``frame`` (for example (-99, 0)) around each row.

    ``pos`` is the dense 1-based position in the group. Groups are cut into blocks of positions; the
    rows at the end of a block that the next block's frames reach are copied there.
    """
    low, high = frame
    if high > 0:
        raise ValueError("only trailing frames are supported")
    reach = -low
    size = max(block_rows or BLOCK_ROWS, reach, 1)
    at = F.col(pos) - 1
    home = int_div(at, size)
    copies = F.when(at % size >= size - reach, F.array(home, home + 1)).otherwise(F.array(home))
    spread = df.withColumns({"_home": home, "_block": F.explode(copies)})
    window = Window.partitionBy(*group, "_block").orderBy(pos).rowsBetween(low, high)
    framed = spread.withColumns({out: agg.over(window) for out, agg in outs.items()})
    return framed.where(F.col("_home") == F.col("_block")).drop("_home", "_block")
