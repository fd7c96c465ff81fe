"""Repeated word windows, found by anchors at difference-cover positions."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripguard.llm.common import Rolling, hash_words, mixed, slices, table, texts_of

WIDTH = 35
# Perfect difference sets. Modulo the period, every difference is
# one of two members, so any two positions have a common shift into the set.
COVERS = {1: (0,), 3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16)}


def cover_for(width: int) -> tuple[int, tuple[int, ...], int]:
    """Period, cover and anchor length for windows of ``width`` words."""
    period = max(v for v in COVERS if v == 1 or v <= 0.6 * width)
    return period, COVERS[period], width - period + 1


def _repeats_twice(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First place of each distinct value, and those of values that occur again."""
    _, first, counts = np.unique(values, return_index=True, return_counts=True)
    return first, first[counts > 1]


class Windows:
    """Word windows of single texts."""

    def __init__(self, width: int) -> None:
        self.width = width
        self.period, cover, self.length = cover_for(width)
        self.cover = np.isin(np.arange(self.period), cover)
        self.rolling = Rolling()

    def anchors(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the anchors, and where they start."""
        if len(words) < self.width:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        hashes = self.rolling.runs(words, self.length)
        at = np.flatnonzero(np.resize(self.cover, len(hashes)))
        return hashes[at], at

    def around(self, words: np.ndarray, shared: np.ndarray) -> np.ndarray:
        """Starts of the windows that hold an anchor out of ``shared``."""
        hashes, at = self.anchors(words)
        hit = np.zeros(len(words) - self.length + 2, np.int64)
        hit[at[np.isin(hashes, shared)] + 1] = 1
        total = np.cumsum(hit)
        starts = np.arange(len(words) - self.width + 1)
        return starts[total[starts + self.period] > total[starts]]

    def covered(self, words: np.ndarray, repeated: np.ndarray) -> np.ndarray:
        """Whether a word lies in a window out of ``repeated``."""
        n = len(words)
        edge = np.zeros(n + 1, np.int64)
        at = np.flatnonzero(np.isin(self.rolling.runs(words, self.width), repeated))
        edge[at] += 1
        edge[at + self.width] -= 1
        return np.cumsum(edge[:n]) > 0


def _words(texts: list[bytes]) -> tuple[list[list[bytes]], list[np.ndarray]]:
    """Words of each text and their hashes."""
    split = [t.split() for t in texts]
    flat = hash_words([w for words in split for w in words])
    ends = np.cumsum([len(words) for words in split])
    return split, np.split(flat, ends[:-1]) if split else []


def _emit(columns: list[np.ndarray], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c.view(np.int64)) for c in columns], names)


def _shared_only(keys: int):
    """Keep rows whose first ``keys`` columns equal those of a row beside them.

    Rows come sorted by these columns; a row at a time is carried over, so a
    group may be of any size.
    """

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, last_out = None, False
        names = None
        for batch in batches:
            rows = [c.to_numpy() for c in batch.columns]
            names = batch.schema.names
            if not len(rows[0]):
                continue
            same = np.ones(len(rows[0]) - 1, bool)
            for c in rows[:keys]:
                same &= c[1:] == c[:-1]
            joined = last is not None and all(c[0] == x for c, x in zip(rows[:keys], last))
            hit = np.zeros(len(rows[0]), bool)
            hit[1:] |= same
            hit[:-1] |= same
            hit[0] |= joined
            if joined and not last_out:
                yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in last], names)
            yield pa.RecordBatch.from_arrays([pa.array(c[hit]) for c in rows], names)
            last, last_out = [c[-1] for c in rows], bool(hit[-1])

    return keep


def substring_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH
) -> DataFrame:
    """Per input row: id, n_words, n_removed, kept (its other words, joined by one space).

    A word goes if it lies in a window of ``width`` words whose sequence starts
    at another place too, in any text or in the same one. Windows are judged on
    the input.

    Anchors are shorter windows that start at cover positions modulo a period;
    two equal windows hold an anchor at one shift into both. So anchors that
    occur once rule out all windows around them, and only windows around shared
    anchors are extended to full width and compared, by 128 bits. Both searches
    sort hashes and look at neighbours: a group of any size is read as a stream.
    Texts are shuffled once, by their hash; of rows of one text side by side,
    two speak for all.

    Null and empty texts have no words. Repeated rows are copies, so texts of
    ``width`` words and more lose everything. Extra columns are ignored.
    """
    source = docs.select(
        F.col(id_col).alias("i"), F.coalesce(F.col(text_col), F.lit("")).alias("t")
    ).select("i", "t", F.xxhash64("t").alias("d"))

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = Windows(width)
        for batch in batches:
            for part in slices(batch, 0):
                keys = part.column(1).to_numpy()
                found, owner = [], []
                for words, key in zip(_words(texts_of(part, 0))[1], keys):
                    hashes, _ = windows.anchors(words)
                    first, again = _repeats_twice(hashes)
                    found += [hashes[first], hashes[again]]
                    owner.append(np.full(len(first) + len(again), key))
                yield _emit([np.concatenate(found), np.concatenate(owner)], ["a", "d"])

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = Windows(width)
        before, times = None, 0
        for batch in batches:
            for part in slices(batch, 1):
                texts = texts_of(part, 1)
                shared = part.column(3)
                keys = part.column(2).to_numpy()
                out = [[np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]]
                for row, (text, words) in enumerate(zip(texts, _words(texts)[1])):
                    times = times + 1 if text == before else 1
                    before = text
                    if times > 2:
                        continue
                    starts = windows.around(words, shared[row].values.to_numpy().view(np.uint64))
                    one = windows.rolling.runs(words, width)[starts]
                    two = windows.rolling.runs(mixed(words), width)[starts]
                    first, again = _repeats_twice(one)
                    at = np.concatenate((first, again))
                    out[0].append(one[at])
                    out[1].append(two[at])
                    out[2].append(np.full(len(at), keys[row]))
                yield _emit([np.concatenate(c) for c in out], ["w", "w2", "d"])

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = Windows(width)
        for batch in batches:
            for part in slices(batch, 1):
                split, hashes = _words(texts_of(part, 1))
                repeated, counts, gone, kept = part.column(2), [], [], []
                for row, (words, h) in enumerate(zip(split, hashes)):
                    drop = np.zeros(len(words), bool)
                    if repeated[row].is_valid and len(words) >= width:
                        drop = windows.covered(h, repeated[row].values.to_numpy().view(np.uint64))
                    counts.append(len(words))
                    gone.append(int(drop.sum()))
                    kept.append(b" ".join(w for w, x in zip(words, drop.tolist()) if not x))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(counts, pa.int64()),
                        pa.array(gone, pa.int64()),
                        pa.array(kept, pa.binary()).cast(pa.string()),
                    ],
                    ["i", "n_words", "n_removed", "kept"],
                )

    found = source.select("t", "d").mapInArrow(anchors, "a bigint, d bigint")
    shared = (
        found.repartition("a")
        .sortWithinPartitions("a")
        .mapInArrow(_shared_only(1), "a bigint, d bigint")
        .groupBy("d")
        .agg(F.collect_set("a").alias("anchors"))
    )
    extended = source.join(shared, "d").select("i", "t", "d", "anchors")
    repeated = (
        extended.mapInArrow(extend, "w bigint, w2 bigint, d bigint")
        .repartition("w")
        .sortWithinPartitions("w", "w2")
        .mapInArrow(_shared_only(2), "w bigint, w2 bigint, d bigint")
        .groupBy("d")
        .agg(F.collect_set("w").alias("repeated"))
    )
    kind = source.schema["i"].dataType.simpleString()
    return (
        source.join(repeated, "d", "left")
        .select("i", "t", "repeated")
        .mapInArrow(remove, f"i {kind}, n_words bigint, n_removed bigint, kept string")
        .withColumnRenamed("i", id_col)
    )


def op2_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP2_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT r, i, array_to_string(w[i:i + 34], ' ') AS s
  FROM d, unnest(range(1, len(w) - 33)) AS u(i) WHERE len(w) >= 35),
again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY s) AS n FROM windows) WHERE n > 1),
gone AS (SELECT DISTINCT r, i + k AS p FROM again, unnest(range(35)) AS u(k)),
words AS (SELECT r, w[p] AS word, p FROM d, unnest(range(1, len(w) + 1)) AS u(p)),
kept AS (
  SELECT r, string_agg(word, ' ' ORDER BY p) AS t, count(*) AS n
  FROM words ANTI JOIN gone USING (r, p) GROUP BY r)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""
