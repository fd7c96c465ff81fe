"""Benchmark items inside documents, by size-partitioned MinHash containment search."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tripguard.llm.common import Rolling, free_name, hash_words, mixed, slices, table, texts_of

SHINGLE = 5
CONTAINMENT = 0.8
HASHES = 64
# Items that one broadcast holds, and their shingles: the bound of its size.
BLOCK_ITEMS = 20_000
BLOCK_SHINGLES = 2_000_000

_WORDS = re.compile(r"\w+")


def normal_words(text: str) -> list[bytes]:
    """Lower-cased runs of letters, digits and underscores."""
    return [w.encode() for w in _WORDS.findall(text.lower())]


def shingles(words: np.ndarray, rolling: Rolling) -> np.ndarray:
    """Hashes of five words each; a shorter text is one shingle, an empty one none."""
    return rolling.runs(words, min(SHINGLE, len(words))) if len(words) else words


@dataclass
class Partition:
    """Items of one size class: between ``least`` and ``2 * least - 1`` distinct shingles."""

    least: int
    minima: list[np.ndarray]  # per hash function: the items' minima, sorted
    owners: list[np.ndarray]  # and which item each is of


@dataclass
class Index:
    ids: list
    sets: list[np.ndarray]
    partitions: list[Partition]
    short: dict[int, list[int]]  # by number of words: items of less than a shingle


def build_index(ids: list, texts: list[str]) -> Index:
    """Distinct shingles of each item and MinHash minima by size class."""
    rolling, kept, sets = Rolling(), [], []
    short: dict[int, list[int]] = {}
    classes: dict[int, list[int]] = {}
    for item, text in zip(ids, texts):
        words = hash_words(normal_words(text))
        if not len(words):
            continue
        i, found = len(sets), np.unique(shingles(words, rolling))
        kept.append(item)
        sets.append(found)
        if len(words) < SHINGLE:
            short.setdefault(len(words), []).append(i)
        else:
            classes.setdefault(1 << (len(found).bit_length() - 1), []).append(i)
    partitions = []
    for least, members in sorted(classes.items()):
        minima, owners = [], []
        for j in range(HASHES):
            low = np.array([mixed(sets[i], j + 1).min() for i in members], np.uint64)
            order = np.argsort(low, kind="stable")
            minima.append(low[order])
            owners.append(np.array(members)[order])
        partitions.append(Partition(least, minima, owners))
    return Index(kept, sets, partitions, short)


def segment_edges(n: int, least: int) -> np.ndarray:
    """Starts of the half segments: a segment is two of them, and they overlap by half.

    A half has as many shingles as the largest item of the class, so an item
    copied into a text lies in one segment, of at most four times its least size.
    """
    return np.arange(0, max(n, 1), 2 * least)


def candidates(index: Index, found: np.ndarray, bounds: np.ndarray) -> set[tuple[int, int]]:
    """Pairs (text, item) with a minimum in common in some segment.

    ``found`` holds the shingles of many texts on end; text i has those from
    ``bounds[i]`` to ``bounds[i + 1]``. A segment shares each of 64 minima with
    an item that is contained to four fifths with a chance of 0.19 or more: one
    pair in a million is lost.
    """
    out: set[tuple[int, int]] = set()
    layouts = []
    for part in index.partitions:
        halves, texts = [], []
        for i in range(len(bounds) - 1):
            n = int(bounds[i + 1] - bounds[i])
            if n:
                edges = segment_edges(n, part.least) + int(bounds[i])
                halves.append(edges)
                texts.append(np.full(len(edges), i))
        if halves:
            layouts.append((part, np.concatenate(halves), np.concatenate(texts)))
    if not layouts:
        return out
    for j in range(HASHES):
        values = mixed(found, j + 1)
        for part, halves, texts in layouts:
            low = np.minimum.reduceat(values, halves)
            same = texts[:-1] == texts[1:]
            low[:-1][same] = np.minimum(low[:-1][same], low[1:][same])
            minima, owners = part.minima[j], part.owners[j]
            first = np.searchsorted(minima, low, "left")
            hit = np.flatnonzero(minima[np.minimum(first, len(minima) - 1)] == low)
            for at in hit.tolist():
                k = int(first[at])
                while k < len(minima) and minima[k] == low[at]:
                    out.add((int(texts[at]), int(owners[k])))
                    k += 1
    return out


def _short_items(index: Index, words: list[np.ndarray], rolling: Rolling) -> set[tuple[int, int]]:
    """Pairs (text, item) of items of under five words that stand in a text as a whole."""
    out = set()
    for width, items in index.short.items():
        wanted = np.concatenate([index.sets[i] for i in items])
        for text, w in enumerate(words):
            held = rolling.runs(w, width)
            out.update((text, items[k]) for k in np.flatnonzero(np.isin(wanted, held)).tolist())
    return out


def _search_block(docs: DataFrame, index: Index, item_field: T.StructField) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(index)
    item_arrow = to_arrow_type(item_field.dataType)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, rolling = shared.value, Rolling()
        brief = {item for items in index.short.values() for item in items}
        for batch in batches:
            for part in slices(batch, 1):
                split = [normal_words(t.decode()) for t in texts_of(part, 1)]
                flat = hash_words([w for words in split for w in words])
                ends = np.cumsum([len(w) for w in split])
                words = np.split(flat, ends[:-1])
                sets = [shingles(w, rolling) for w in words]
                bounds = np.concatenate(([0], np.cumsum([len(s) for s in sets])))
                rows, items, shares = [], [], []
                pairs = candidates(index, np.concatenate(sets), bounds)
                for i, item in sorted(pairs | _short_items(index, words, rolling)):
                    wanted = index.sets[item]
                    share = np.isin(wanted, sets[i]).sum() / len(wanted) if item not in brief else 1.0
                    if share >= CONTAINMENT:
                        rows.append(i)
                        items.append(index.ids[item])
                        shares.append(float(share))
                found = part.column(0).take(pa.array(rows, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [found, pa.array(items, item_arrow), pa.array(shares, pa.float64())],
                    ["d", "item", "containment"],
                )

    fields = [docs.schema["d"], item_field, T.StructField("containment", T.DoubleType())]
    return docs.mapInArrow(search, T.StructType(fields))


def contained_items(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_items: int = BLOCK_ITEMS,
) -> DataFrame:
    """``(id, item, containment)`` where a text holds four fifths of an item's shingles.

    Shingles are five words of letters and digits, lower-cased. Items are put
    into size classes by powers of two. For each class a text is cut into half
    overlapping segments of four times the least size, so that containment in a
    long text becomes a fair similarity with one of its segments; a segment and
    an item that share one of 64 minima are a candidate, and the whole text's
    shingles decide. Nothing is shuffled. Items are broadcast a block at a time,
    of a size bounded by ``block_items`` and ``BLOCK_SHINGLES``; more items are
    more passes over the documents.

    Texts and items without words, null ones too, match nothing. Items of under
    five words match as a whole. Repeated rows give repeated results; an item id
    may stand for several texts. Extra columns are ignored.
    """
    source = docs.select(F.col(id_col).alias("d"), F.col(text_col).alias("t"))
    item_field = T.StructField("item", benchmark.schema[item_col].dataType)
    found = None
    ids, texts, size = [], [], 0
    items = benchmark.select(F.col(item_col).alias("i"), F.col(item_text_col).alias("t")).filter("t is not null")
    for row in items.toLocalIterator():
        ids.append(row["i"])
        texts.append(row["t"])
        size += len(row["t"]) // 2
        if len(ids) >= block_items or size >= BLOCK_SHINGLES:
            part = _search_block(source, build_index(ids, texts), item_field)
            found = part if found is None else found.union(part)
            ids, texts, size = [], [], 0
    if ids or found is None:
        part = _search_block(source, build_index(ids, texts), item_field)
        found = part if found is None else found.union(part)
    return found.toDF(id_col, item_col, "containment")


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` without those that hold an item; columns stay as they are.

    Goes by the id: rows that repeat the id of a document that goes, go too.
    A document without an id stays.
    """
    gone = free_name(docs.columns, "_gone")
    hit = contained_items(docs, benchmark, id_col, text_col)
    hit = hit.select(F.col(id_col).alias(gone)).distinct()
    return docs.join(hit, docs[id_col] == hit[gone], "left_anti")


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
