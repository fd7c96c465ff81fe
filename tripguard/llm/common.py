"""Helpers the text operators share."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripguard.session import ensure_checkpoint_dir

# Bytes of text handled at once inside a task; one longer text is one slice.
SLICE_BYTES = 4 << 20
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Bits of an array that tells tasks which of any number of keys may be there; a power of two.
KEY_BITS = 1 << 24
# Odd multiplier of the rolling hash, and its inverse modulo 2^64.
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, what: str) -> str:
    """A new path below the checkpoint folder that all executors share."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{what}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a query run inside go when it is done."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def written(df: DataFrame, what: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: lineage is cut there.

    The shuffles behind it are of no more use, so Spark is told to remove their
    files when the write is done: a chain of such tables then needs the disk of
    its largest link, not of their sum.
    """
    spark = df.sparkSession
    path = shared_folder(spark, what)
    with shuffles_removed(spark):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def discard(*frames: DataFrame) -> None:
    """Delete tables of ``written`` that nothing will read again."""
    for df in frames:
        jvm, conf = df.sparkSession.sparkContext._jvm, df.sparkSession.sparkContext._jsc.hadoopConfiguration()
        folder = jvm.org.apache.hadoop.fs.Path(df.scratch_path)
        folder.getFileSystem(conf).delete(folder, True)


def bits_of(df: DataFrame, *columns: str) -> Callable[[], bytes] | None:
    """For tasks: a bit array in which the bits of all keys in ``columns`` are set; None without keys.

    Its size is fixed, ``KEY_BITS``, and so is what reaches the driver and is
    broadcast, whatever the number of keys. The more bits are set, the more
    other keys find theirs set as well.
    """
    at = F.xxhash64(*columns).bitwiseAND(F.lit(KEY_BITS - 1))
    words = df.select(at.alias("at")).selectExpr("at div 64 as w", "shiftleft(1L, cast(at % 64 as int)) as m")
    with shuffles_removed(df.sparkSession):
        found = words.groupBy("w").agg(F.bit_or("m").alias("m")).toArrow()
    if not found.num_rows:
        return None
    array = np.zeros(KEY_BITS // 64, np.uint64)
    array[found.column("w").to_numpy()] = found.column("m").to_numpy().view(np.uint64)
    shared = df.sparkSession.sparkContext.broadcast(array.tobytes())
    return lambda: shared.value


def has_bit(array: bytes, key_hash: int) -> int:
    """Whether the bit of a key with this XXH64 is set."""
    at = key_hash % (8 * len(array))
    return array[at >> 3] >> (at & 7) & 1


def free_name(columns: list[str], base: str) -> str:
    """``base``, with underscores until no column has the name."""
    taken = {c.lower() for c in columns}
    while base.lower() in taken:
        base += "_"
    return base


def slices(batch: pa.RecordBatch, column: int, slice_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``slice_bytes`` of text each, in order."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0)
    part = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64)) // slice_bytes
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for start, end in zip(edges, edges[1:]):
        if end > start:
            yield batch.slice(start, end - start)


def texts_of(batch: pa.RecordBatch, column: int) -> list[bytes]:
    """The texts in UTF-8; null counts as empty."""
    return pc.fill_null(batch.column(column).cast(pa.binary()), b"").to_pylist()


def hash_words(words: list[bytes]) -> np.ndarray:
    """XXH64 of each word; a word that repeats is hashed once."""
    coded = pa.array(words, pa.binary()).dictionary_encode()
    distinct = coded.dictionary.to_pylist()
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, distinct), np.uint64, len(distinct))
    return hashes[coded.indices.to_numpy()] if len(words) else np.zeros(0, np.uint64)


def powers(base: int, n: int) -> np.ndarray:
    """1, base, base^2 ... modulo 2^64, built by doubling."""
    out = np.ones(max(n, 1), np.uint64)
    size, step = 1, base
    while size < n:
        take = min(size, n - size)
        out[size : size + take] = out[:take] * np.uint64(step)
        size, step = size + take, step * step % (1 << 64)
    return out[:n]


class Rolling:
    """Hashes of all runs of ``width`` items; tables grow with the longest text."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(0, np.uint64)

    def runs(self, items: np.ndarray, width: int) -> np.ndarray:
        n = len(items)
        if n < width:
            return np.zeros(0, np.uint64)
        if n > len(self.up):
            self.up, self.down = powers(BASE, 2 * n), powers(BASE_INVERSE, 2 * n)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(items * self.up[:n], out=total[1:])
        return (total[width:] - total[:-width]) * self.down[: n - width + 1]


def mixed(values: np.ndarray, seed: int = 0) -> np.ndarray:
    """A second, unrelated hash of 64-bit hashes."""
    x = values ^ np.uint64(seed * 0xD6E8FEB86659FD93 % (1 << 64))
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))
