"""Near duplicates by SimHash fingerprints and a byte-position index."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripguard.llm.common import free_name, slices, table, texts_of
from tripguard.llm.components import components
from tripguard.session import ensure_checkpoint_dir

SHINGLE = 3
MAX_BITS = 3
# Bytes two fingerprints share by position at the least if MAX_BITS differ.
MIN_SHARED = 8 - MAX_BITS
# The 14 sets of four byte positions whose exclusive or is zero. Any three
# positions lie in exactly one of them (a Steiner system), so fingerprints that
# differ in at most three bytes agree on all four bytes outside some set.
PLANES = [s for s in combinations(range(8), 4) if s[0] ^ s[1] ^ s[2] ^ s[3] == 0]
# Fingerprints of one posting that are compared with each other inside a task.
POSTING_ROWS = 4096


def fingerprint(text: bytes) -> int:
    """Majority bits of the XXH64 values of all word shingles, repeats included."""
    joined = b" ".join(text.lower().split())
    if not joined:
        return 0
    gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    width = min(SHINGLE, len(gaps) + 1)
    starts = np.concatenate(([0], gaps + 1))
    ends = np.concatenate((gaps, [len(joined)]))
    digest = xxhash.xxh64_intdigest
    hashes = np.array(
        [digest(joined[a:b], 42) for a, b in zip(starts.tolist(), ends[width - 1 :].tolist())],
        dtype=">u8",
    )
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 65536):
        part = hashes[i : i + 65536].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(d, f)``: id and fingerprint as a signed long, a row per input row."""
    source = docs.select(F.col(id_col).alias("d"), F.col(text_col).alias("t"))

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                values = [fingerprint(t) for t in texts_of(part, 1)]
                signed = np.array(values, np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(signed)], ["d", "f"])

    kind = source.schema["d"].dataType.simpleString()
    return source.mapInArrow(compute, f"d {kind}, f bigint")


def _bytes_at(positions: tuple[int, ...]):
    """The bytes of ``f`` at these positions (0 is the highest), side by side."""
    out = F.lit(0).cast("bigint")
    for p in positions:
        byte = F.shiftrightunsigned("f", 56 - 8 * p).bitwiseAND(F.lit(255).cast("bigint"))
        out = F.shiftleft(out, 8).bitwiseOR(byte)
    return out


def postings(nodes: DataFrame) -> DataFrame:
    """``(k, f)``: a posting key per plane, from the four bytes outside it."""
    keys = []
    for i, plane in enumerate(PLANES):
        outside = tuple(p for p in range(8) if p not in plane)
        keys.append(_bytes_at(outside).bitwiseOR(F.lit(i << 32).cast("bigint")))
    return nodes.select(F.explode(F.array(*keys)).alias("k"), "f")


def close(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Tally the bytes shared by position; with enough of them, count the bits."""
    differ = a ^ b
    shared = (differ.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)
    out = shared >= MIN_SHARED
    out[out] = np.bitwise_count(differ[out]) <= MAX_BITS
    return out


def _merge(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least label over the links ``a``-``b`` and the labels so far."""
    while True:
        least = np.minimum(labels[a], labels[b])
        if np.array_equal(least, labels[a]) and np.array_equal(least, labels[b]):
            return labels
        after = labels.copy()
        for end in (a, b):
            np.minimum.at(after, labels[end], least)
            np.minimum.at(after, end, least)
        labels = after[after]


def _link_sorted(keys: np.ndarray, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of the rows of each key: every row and the least row it is joined to."""
    labels = np.arange(len(keys))
    left = labels[:-1][keys[:-1] == keys[1:]]
    shift = 1
    while len(left):
        hit = left[close(prints[left], prints[left + shift])]
        if len(hit):
            labels = _merge(labels, hit, hit + shift)
        shift += 1
        left = left[left + shift < len(keys)]
        left = left[keys[left] == keys[left + shift]]
    joined = np.flatnonzero(labels != np.arange(len(keys)))
    return prints[joined], prints[labels[joined]]


def _link_small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by key; the last key of a batch waits for the next one."""
    keys = prints = np.zeros(0, np.int64)

    def links(upto: int) -> pa.RecordBatch:
        u, v = _link_sorted(keys[:upto], prints[:upto].view(np.uint64))
        return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], ["u", "v"])

    for batch in batches:
        keys = np.concatenate((keys, batch.column(0).to_numpy()))
        prints = np.concatenate((prints, batch.column(1).to_numpy()))
        if len(keys):
            cut = int(np.searchsorted(keys, keys[-1]))
            yield links(cut)
            keys, prints = keys[cut:], prints[cut:]
    if len(keys):
        yield links(len(keys))


def _flips(positions: tuple[int, ...], most: int) -> list[int]:
    """Masks of up to ``most`` bits in the bytes at these positions, as signed longs."""
    bits = [1 << (63 - 8 * p - i) for p in positions for i in range(8)]
    masks = [sum(c) for n in range(most + 1) for c in combinations(bits, n)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _link_large(members: DataFrame) -> DataFrame:
    """Links within postings of any size, with work in proportion to their rows.

    Two fingerprints differ in at most three bits just if a value lies within
    one bit of the one and two of the other. Each row names the values within
    two bits inside its plane and is linked to the least row within one bit of
    a value: pre-aggregated minima and a join, never pairs of a posting.
    """
    spark = members.sparkSession
    rows = [
        (i, mask, (mask & (1 << 64) - 1).bit_count() <= 1)
        for i, plane in enumerate(PLANES)
        for mask in _flips(plane, 2)
    ]
    masks = spark.createDataFrame(rows, "i int, mask bigint, near boolean")
    near = (
        members.join(masks.filter("near"), F.shiftright("k", 32) == F.col("i"))
        .groupBy("k", F.col("f").bitwiseXOR(F.col("mask")).alias("x"))
        .agg(F.min("f").alias("v"))
    )
    far = members.join(masks, F.shiftright("k", 32) == F.col("i")).select(
        "k", F.col("f").bitwiseXOR(F.col("mask")).alias("x"), F.col("f").alias("u")
    )
    return far.join(near, ["k", "x"]).filter("u != v").select("u", "v").distinct()


def simhash_links(nodes: DataFrame, posting_rows: int = POSTING_ROWS) -> DataFrame:
    """Links ``(u, v)`` between distinct fingerprints ``f`` that join just what is close.

    Fingerprints with at most three differing bits share at least five bytes by
    position, and so all four bytes of one of 14 posting keys. (Postings of one
    byte each would hold 1/256 of all rows.) Within a posting the shared bytes
    of a pair are tallied, pairs below five are dropped, the rest is verified
    bit by bit, and only links that span each group leave the task. Postings
    too large for that go through ``_link_large``, which is exact as well.
    """
    entries = postings(nodes)
    sizes = entries.groupBy("k").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    sized = entries.join(sizes, "k")
    small = (
        sized.filter(F.col("n") <= posting_rows)
        .select("k", "f")
        .repartition("k")
        .sortWithinPartitions("k")
        .mapInArrow(_link_small, "u bigint, v bigint")
    )
    large = sizes.filter(F.col("n") > posting_rows)
    if large.isEmpty():
        return small.distinct()
    return small.union(_link_large(sized.filter(F.col("n") > posting_rows).select("k", "f"))).distinct()


def simhash_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    posting_rows: int = POSTING_ROWS,
) -> DataFrame:
    """One row per input row: id, fingerprint (16 hex digits), component_id.

    component_id is the least id of all rows reachable over links. Null and
    empty texts have the fingerprint zero and link like any other; repeated
    rows are rows of one component; a null id gets the component of its
    fingerprint and is never its least id. Extra columns are ignored.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    prints = fingerprints(docs, id_col, text_col).checkpoint()
    nodes = prints.groupBy("f").agg(F.min("d").alias("least"))
    roots = components(simhash_links(nodes.select("f"), posting_rows))
    classes = nodes.join(roots, nodes["f"] == roots["id"], "left").select(
        "f", "least", F.coalesce("root", "f").alias("root")
    )
    least = classes.groupBy(F.col("root").alias("r")).agg(F.min("least").alias("component_id"))
    named = classes.join(least, F.col("root") == F.col("r")).select(F.col("f").alias("g"), "component_id")
    return prints.join(named, F.col("f") == F.col("g")).select(
        F.col("d").alias(id_col),
        F.lower(F.lpad(F.hex("f"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each component: the row with the least id.

    Columns stay as they are. Rows that repeat the id that stays are one
    document and stay together; rows without an id stay.
    """
    found = simhash_components(docs, id_col, text_col)
    gone = free_name(docs.columns, "_gone")
    others = (
        found.filter(F.col(id_col) != F.col("component_id")).select(F.col(id_col).alias(gone)).distinct()
    )
    return docs.join(others, docs[id_col] == others[gone], "left_anti")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"))
