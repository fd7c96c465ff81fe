"""Text quality by similarity-weighted votes of labelled neighbours."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripguard.llm.common import free_name, slices, table, texts_of

# Columns of the term matrix: words, shapes of words, and signs of repetition.
WORD_TERMS, SHAPE_TERMS, SIGN_TERMS = 1024, 1008, 16
TERMS = WORD_TERMS + SHAPE_TERMS + SIGN_TERMS
# Rows counted and scored at once, and words whose terms a task remembers. A worker
# keeps the memory of its largest block, and stands beside a full heap.
BLOCK_ROWS = 128
CACHED_WORDS = 1 << 17
# Unit vectors are kept in multiples of this. A product of two such has 40 bits
# behind the point, so sums of products are exact and come out the same in any order.
STEP = 2.0**-20

# What a byte is to a word's shape: a capital, another letter, a digit, or itself.
_CLASSES = bytes(
    65 if 65 <= b <= 90 else 97 if 97 <= b <= 122 or b >= 128 else 48 if 48 <= b <= 57 else b
    for b in range(256)
)
_RUNS = re.compile(rb"(.)\1+", re.DOTALL)


@dataclass(frozen=True)
class Settings:
    """``sample_rows`` bounds the labelled rows that are fitted and broadcast."""

    sample_rows: int = 4096
    dimensions: int = 48
    neighbours: int = 15


def _terms_of_word(word: bytes) -> int:
    """The word's term and its shape's, as one number to base ``TERMS``."""
    shape = _RUNS.sub(rb"\1", word.translate(_CLASSES))
    by_word = xxhash.xxh64_intdigest(word.lower()) % WORD_TERMS
    return by_word * TERMS + WORD_TERMS + xxhash.xxh64_intdigest(shape) % SHAPE_TERMS


class Terms:
    """Counts of hashed terms of texts."""

    def __init__(self) -> None:
        self.known: dict[bytes, int] = {}

    def counts(self, texts: list[bytes]) -> np.ndarray:
        """A row of ``TERMS`` counts per text; whole texts are read."""
        rows = len(texts)
        split = [t.split() for t in texts]
        sizes = np.array([len(s) for s in split], np.int64)
        owner = np.repeat(np.arange(rows), sizes)
        coded = pa.array([w for s in split for w in s], pa.binary()).dictionary_encode()
        if len(self.known) > CACHED_WORDS:
            self.known.clear()
        known, both = self.known, []
        for word in coded.dictionary.to_pylist():
            terms = known.get(word)
            if terms is None:
                terms = known[word] = _terms_of_word(word)
            both.append(terms)
        ids = coded.indices.to_numpy().astype(np.int64)
        out = np.zeros(rows * TERMS, np.float32)
        for terms in np.divmod(np.array(both, np.int64), TERMS):
            out += np.bincount(owner * TERMS + terms[ids], minlength=rows * TERMS)
        out = out.reshape(rows, TERMS)
        self._signs(out, owner, ids, sizes)
        self._lines(out, texts)
        return out

    @staticmethod
    def _signs(out: np.ndarray, owner: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
        """Words that repeat the one before, and words used before in the text."""
        base, rows = WORD_TERMS + SHAPE_TERMS, len(sizes)
        if not len(ids):
            return
        same = (ids[1:] == ids[:-1]) & (owner[1:] == owner[:-1])
        out[:, base] = np.bincount(owner[1:][same], minlength=rows)
        pairs = np.unique(owner * (int(ids.max()) + 1) + ids)
        distinct = np.bincount(pairs // (int(ids.max()) + 1), minlength=rows)
        share = distinct / np.maximum(sizes, 1)
        step = np.minimum((share * 8).astype(int), 7)
        held = sizes > 0
        out[np.flatnonzero(held), base + 2 + step[held]] = sizes[held]

    @staticmethod
    def _lines(out: np.ndarray, texts: list[bytes]) -> None:
        """Words in lines that the text has more than once."""
        base = WORD_TERMS + SHAPE_TERMS + 1
        for row, text in enumerate(texts):
            lines = text.split(b"\n")
            if len(lines) > 1:
                out[row, base] = len(lines) - len(set(lines))


@dataclass
class Model:
    """All that scoring needs: of a size set by ``Settings``, whatever the corpus."""

    weights: np.ndarray  # inverse document frequency by term
    axes: np.ndarray  # terms x dimensions
    vectors: np.ndarray  # labelled rows x dimensions, of length one
    labels: np.ndarray
    neighbours: int

    def latent(self, counts: np.ndarray) -> np.ndarray:
        """Texts as unit vectors on the latent axes; zero for texts without words."""
        return unit_rows(weighted(counts, self.weights) @ in_steps(self.axes))

    @cached_property
    def distinct(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Labelled vectors without repeats; how many rows each stands for, and the sum of their labels."""
        vectors, of = np.unique(self.vectors, axis=0, return_inverse=True)
        return vectors, np.bincount(of.ravel()), np.bincount(of.ravel(), weights=self.labels)

    def score(self, counts: np.ndarray) -> np.ndarray:
        """Mean label of the nearest labelled rows, weighted by cosine.

        They are the ``neighbours`` nearest and all as near as the last of
        them. All sums are exact, so the score of a text depends neither on
        the texts beside it nor on the order of the labelled rows.
        """
        prior = float(self.labels.mean()) if len(self.labels) else 0.5
        if not len(self.labels):
            return np.full(len(counts), prior)
        vectors, rows, positive = self.distinct
        cosines = self.latent(counts) @ vectors.T
        k = min(self.neighbours, len(vectors))
        near = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
        values = np.take_along_axis(cosines, near, axis=1)
        order = np.argsort(-values, axis=1)
        held = np.cumsum(np.take_along_axis(rows[near], order, axis=1), axis=1)
        # Where the rows so far reach the number wanted; the last place if all are fewer.
        last = np.argmax(held >= min(self.neighbours, len(self.labels)), axis=1)
        values = np.take_along_axis(values, order, axis=1)
        least = np.maximum(values[np.arange(len(values)), last], 0)
        weight = np.where(cosines >= least[:, None], cosines, 0)
        total = weight @ rows.astype(np.float64)
        return np.where(total > 0, (weight @ positive) / np.where(total > 0, total, 1), prior)


def in_steps(values: np.ndarray) -> np.ndarray:
    return np.rint(values.astype(np.float64) / STEP) * STEP


def unit_rows(rows: np.ndarray) -> np.ndarray:
    """Rows of length one, in steps; zero rows stay zero."""
    length = np.sqrt((rows * rows).sum(axis=1, keepdims=True))
    return in_steps(rows / np.where(length > 0, length, 1))


def weighted(counts: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Log counts times term weights, as unit rows."""
    return unit_rows(np.log1p(counts.astype(np.float64)) * weights)


def _blocks(batches: Iterator[pa.RecordBatch], column: int):
    for batch in batches:
        for part in slices(batch, column):
            for start in range(0, part.num_rows, BLOCK_ROWS):
                yield part.slice(start, BLOCK_ROWS)


def document_frequencies(docs: DataFrame, text_col: str) -> tuple[np.ndarray, int]:
    """In how many of all documents each term occurs; ``TERMS`` numbers reach the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, found = Terms(), np.zeros(TERMS + 1, np.int64)
        for block in _blocks(batches, 0):
            found[:TERMS] += (terms.counts(texts_of(block, 0)) > 0).sum(axis=0)
            found[TERMS] += block.num_rows
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(TERMS + 1)), pa.array(found)], ["term", "n"]
        )

    rows = (
        docs.select(F.col(text_col).alias("t"))
        .mapInArrow(count, "term bigint, n bigint")
        .groupBy("term")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    out = np.zeros(TERMS + 1, np.int64)
    for row in rows:
        out[row["term"]] = row["n"]
    return out[:TERMS], int(out[TERMS])


def held_out(id_column: Column) -> Column:
    """Whether labels of this id are kept from the fit."""
    return F.crc32(id_column.cast("string")) % 3 == 1


@dataclass
class Labelled:
    """Term counts and labels of the rows that are fitted.

    Few of a text's counts are not zero, and only those are held: the rows are
    spread out a block at a time, so that the driver never holds them all.
    """

    packed: list[tuple[bytes, bytes]]  # the terms of a row, and their counts
    labels: np.ndarray

    def blocks(self) -> Iterator[np.ndarray]:
        """The rows in order, as ``TERMS`` counts each."""
        for start in range(0, len(self.packed), BLOCK_ROWS):
            part = self.packed[start : start + BLOCK_ROWS]
            out = np.zeros((len(part), TERMS), np.float32)
            for row, (at, n) in zip(out, part):
                row[np.frombuffer(at, np.int32)] = np.frombuffer(n, np.float32)
            yield out


def labelled_counts(
    docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, rows: int
) -> Labelled:
    """Term counts and labels of at most ``rows`` labelled rows that are not held out.

    They are those with the least hash of the id, so any order of the input
    gives the same ones; only they are read back as counts.
    """
    usable = labels.select(F.col(id_col).alias("i"), F.col(label_col).cast("int").alias("y"))
    usable = usable.filter("i is not null and y is not null").filter(~held_out(F.col("i")))
    chosen = (
        usable.groupBy("i").agg(F.max("y").alias("y")).orderBy(F.xxhash64("i"), "i").limit(rows)
    )
    texts = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"))
    joined = texts.join(F.broadcast(chosen), "i").select("i", "y", "t")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = Terms()
        for block in _blocks(batches, 2):
            found = terms.counts(texts_of(block, 2))
            packed = [np.flatnonzero(r).astype(np.int32).tobytes() for r in found]
            values = [r[r > 0].astype(np.float32).tobytes() for r in found]
            yield pa.RecordBatch.from_arrays(
                [block.column(0), block.column(1), pa.array(packed), pa.array(values)], ["i", "y", "at", "n"]
            )

    kind = joined.schema["i"].dataType.simpleString()
    found = joined.mapInArrow(count, f"i {kind}, y int, at binary, n binary")
    # A repeated id counts once, and the bound holds for the collected rows too.
    one = found.groupBy("i").agg(F.max(F.struct("y", "at", "n")).alias("r")).orderBy("i").select("r.*").collect()
    return Labelled([(x["at"], x["n"]) for x in one], np.array([x["y"] for x in one], np.float64))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    settings: Settings = Settings(),
) -> Model:
    """Term weights from all documents, axes and vectors from a bounded labelled sample.

    The products of terms are summed by blocks of rows. Sums are exact, so they
    are those of all rows at once.
    """
    seen, n = document_frequencies(docs, text_col)
    weights = np.log((1 + n) / (1 + seen)) + 0.1
    sample = labelled_counts(docs, labels, id_col, text_col, label_col, settings.sample_rows)
    axes = _axes(sample, weights, settings.dimensions)
    none = np.zeros((0, axes.shape[1]))
    model = Model(weights, axes, none, sample.labels, settings.neighbours)
    model.vectors = np.concatenate([none, *map(model.latent, sample.blocks())])
    return model


def _axes(sample: Labelled, weights: np.ndarray, dimensions: int) -> np.ndarray:
    """The directions in which the sample's rows differ most."""
    products = np.zeros((TERMS, TERMS))
    for counts in sample.blocks():
        rows = weighted(counts, weights)
        products += rows.T @ rows
    _, vectors = np.linalg.eigh(products)
    return vectors[:, ::-1][:, :dimensions].astype(np.float32)


def score(docs: DataFrame, model: Model, text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with a double column ``out``; any other columns stay as they are.

    The model is broadcast; products are computed block by block, for every row
    and the whole text. Texts without words, null ones too, get the mean label
    of the sample; without labelled rows every score is a half. Equal texts have
    equal scores, wherever they stand: labelled rows as near as the last of the
    nearest vote too, and equal ones count as often as they occur.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = Terms()
        for block in _blocks(batches, at):
            values = shared.value.score(terms.counts(texts_of(block, at)))
            yield pa.RecordBatch.from_arrays(
                [*block.columns, pa.array(values, pa.float64())], [*block.schema.names, out]
            )

    if out in docs.columns:
        raise ValueError(f"column {out} exists")
    schema = T.StructType([*docs.schema.fields, T.StructField(out, T.DoubleType())])
    return docs.mapInArrow(compute, schema)


def keep_good(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality"
) -> DataFrame:
    """The rows of ``docs`` that score a half or more, with the columns they came with."""
    out = free_name(docs.columns, "_score")
    scored = score(docs, fit(docs, labels, id_col, text_col, label_col), text_col, out)
    return scored.filter(F.col(out) >= 0.5).drop(out)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = score(docs.select("doc_id", "text"), fit(docs, labels))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
