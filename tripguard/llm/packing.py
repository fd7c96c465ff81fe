"""Packing documents into training sequences of several permitted lengths."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripguard.llm.common import table, written

# Pieces packed together on average; more make no fuller bins worth the memory.
GROUP_PIECES = 4096


@dataclass(frozen=True)
class Lengths:
    """Permitted sequence lengths and what a sequence of length n costs.

    The cost is n plus ``quadratic * n * n`` (attention) plus ``fixed``.
    """

    capacities: tuple[int, ...] = (512, 1024, 2048, 4096)
    quadratic: float = 1 / 65536
    fixed: float = 16.0

    def cost(self, capacity: int) -> float:
        return capacity + self.quadratic * capacity * capacity + self.fixed


def best_fit(sizes: np.ndarray, lengths: Lengths) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin, offset and final capacity of each piece; no piece exceeds the largest length.

    Pieces come longest first. A piece goes to the open bin it fits most
    tightly. If it fits none, a bin is opened of the length that costs least
    per token it can come to hold: its own length, or all tokens still to be
    packed if they are fewer. In the end each bin shrinks to the least length
    that holds its contents.
    """
    capacities = sorted(lengths.capacities)
    order = np.lexsort((np.arange(len(sizes)), -sizes))
    room: list[list[int]] = [[] for _ in range(capacities[-1] + 1)]  # open bins by space left
    # Spaces that some bin has: bit s of the number is set if room[s] is not empty.
    have = 0
    bins, offsets = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    used: list[int] = []
    left = int(sizes.sum())
    for i in order.tolist():
        size = int(sizes[i])
        fitting = have >> size
        if fitting:
            space = size + (fitting & -fitting).bit_length() - 1
            at = heapq.heappop(room[space])
            if not room[space]:
                have &= ~(1 << space)
        else:
            held = [c for c in capacities if c >= size]
            space = min(held, key=lambda c: (lengths.cost(c) / max(1, min(c, left)), c))
            at = len(used)
            used.append(0)
        bins[i], offsets[i] = at, used[at]
        used[at] += size
        left -= size
        space -= size
        heapq.heappush(room[space], at)
        have |= 1 << space
    fit = np.searchsorted(capacities, np.array(used, np.int64))
    return bins, offsets, np.array(capacities, np.int64)[fit][bins] if len(used) else bins


def whitespace_tokens(text: Column) -> Column:
    """Words of the text, and one token that ends it."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint") + 1


def pack(
    docs: DataFrame,
    n_tokens: Column,
    id_col: str = "doc_id",
    lengths: Lengths = Lengths(),
    group_pieces: int = GROUP_PIECES,
) -> DataFrame:
    """One row per piece: id, piece, start, n_tokens, group, bin, offset, capacity, used.

    ``n_tokens`` is any expression over ``docs``. A document longer than the
    largest length becomes pieces of that length and a rest; no token is lost.
    Pieces are dealt at random, by a hash of the row's number and the piece, to
    as many groups as keep them at ``group_pieces`` on average, and each group
    is packed in one task from numbers alone: rows of one id spread like any
    others, and bins of a group of thousands are as full as those of one large
    group. Sizes are computed once and written in between with the row's
    number, so that a repeated task deals as the first one did. Which rows share
    a bin depends on how the input lies in its files.

    Null or negative sizes count as zero; a document of zero tokens takes no
    room but has its row. Repeated rows are packed as often as they occur; rows
    with a null id are packed too. Extra columns are ignored.
    """
    top = max(lengths.capacities)
    sized = docs.select(
        F.col(id_col).alias("d"),
        F.greatest(F.coalesce(n_tokens.cast("bigint"), F.lit(0)), F.lit(0)).alias("n"),
        F.monotonically_increasing_id().alias("row"),
    )
    cut = sized.select(
        "d",
        "n",
        "row",
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"greatest(n - 1, 0) div {top}"))).alias("piece"),
    ).select("d", "row", "piece", (F.col("piece") * top).alias("start"), F.least(F.lit(top), F.expr(f"n - piece * {top}")).alias("n_tokens"))
    cut = written(cut, "pieces")
    groups = max(1, -(-cut.count() // group_pieces))
    dealt = cut.withColumn("group", F.pmod(F.xxhash64("row", "piece"), F.lit(groups)))
    names = ["group", "d", "piece", "start", "n_tokens"]

    def pack_group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(batches).combine_chunks()
        rows = rows.sort_by([(c, "ascending") for c in ("d", "piece", "n_tokens")])
        bins, offsets, capacities = best_fit(rows["n_tokens"].to_numpy(), lengths)
        used = np.bincount(bins, weights=rows["n_tokens"].to_numpy()).astype(np.int64)[bins]
        for name, values in (("bin", bins), ("offset", offsets), ("capacity", capacities), ("used", used)):
            rows = rows.append_column(name, pa.array(values, pa.int64()))
        yield from rows.to_batches()

    kind = dealt.schema["d"].dataType.simpleString()
    schema = (
        f"group bigint, d {kind}, piece bigint, start bigint, n_tokens bigint, "
        "bin bigint, offset bigint, capacity bigint, used bigint"
    )
    packed = dealt.select(*names).groupBy("group").applyInArrow(pack_group, schema)
    return packed.select(
        F.col("d").alias(id_col), "piece", "start", "n_tokens", "group", "bin", "offset", "capacity", "used"
    )


def op3_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), whitespace_tokens(F.col("text")))
