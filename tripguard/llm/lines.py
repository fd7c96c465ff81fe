"""Near-duplicate lines by MinHash over character shingles.

Signatures and shared shingles are counted with numpy on Arrow batches; all that
brings rows together is joins and aggregates.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripguard.llm.common import BASE, bits_of, discard, free_name, has_bit, mixed, slices, table, written
from tripguard.llm.components import components

# Characters of a shingle; a shorter line is one shingle.
CHARS = 8
# Bands of least hashes for all lines, and for those of large buckets that are not all alike.
BANDS, ROWS = 6, 3
FINE_BANDS, FINE_ROWS = 24, 8
SIMILARITY = 0.8
# Lines of a bucket up to which all its pairs are compared.
PAIRED = 16
# Characters whose shingles are hashed at once; one longer line is hashed whole.
BLOCK_CHARS = 1 << 18
# Bytes of lines whose pairs are verified at once.
PAIR_BYTES = 1 << 18


def turned(n: int) -> list[int]:
    """A shingle's hash is 32 bits; with the bits of one of these turned over, the
    least of a line's hashes is that next to one of as many spread-out places."""
    return [i * 0x9E3779B1 % (1 << 32) for i in range(1, n + 1)]


_SPACES = re.compile(r"[ \t\r\f\x0B]+")


def normal_lines(text: str) -> list[str]:
    """A text's lines lower-cased, with white space at the ends gone and single inside."""
    lower = text.lower()
    if any(x in lower for x in ("  ", "\t", "\r", "\f", "\x0b")):
        return [_SPACES.sub(" ", x).strip(" ") for x in lower.split("\n")]
    return [x.strip(" ") for x in lower.split("\n")]


def line_hashes(lines: list[str]) -> np.ndarray:
    """A row of two 64-bit halves per line."""
    return np.frombuffer(b"".join(xxhash.xxh3_128_digest(x.encode()) for x in lines), np.int64).reshape(-1, 2)


def shingle_hashes(lines: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hashes of the shingles from every character, and where those of each line begin and end.

    Lines have ``CHARS`` characters at least.
    """
    codes = "".join(lines).encode("utf-32-le")
    found, width, base = np.frombuffer(codes, np.uint32).astype(np.uint64), 1, BASE
    while width < CHARS:
        longer = found.copy()
        longer[:-width] += found[width:] * np.uint64(base)
        found, width, base = longer, 2 * width, base * base % (1 << 64)
    ends = np.cumsum(np.fromiter(map(len, lines), np.int64, len(lines)))
    starts = np.concatenate(([0], ends[:-1])).astype(np.int64)
    return mixed(found), starts, ends - CHARS + 1


def _blocks(lines: list[str]) -> Iterator[list[str]]:
    held, size = [], 0
    for line in lines:
        if held and size + len(line) > BLOCK_CHARS:
            yield held
            held, size = [], 0
        held.append(line)
        size += len(line)
    if held:
        yield held


def band_keys(lines: list[str], bands: int, rows: int) -> np.ndarray:
    """A row of keys per line of ``CHARS`` characters at least: a band's key stands for several least hashes."""
    out = [np.zeros((0, bands), np.uint64)]
    for block in _blocks(lines):
        hashes, starts, ends = shingle_hashes(block)
        short = (hashes >> np.uint64(32)).astype(np.uint32)
        # Every other segment is what lies between the shingles of two lines.
        edges = np.stack([starts, ends], axis=1).ravel()
        least = [np.minimum.reduceat(short ^ np.uint32(c), edges)[::2].astype(np.uint64) for c in turned(bands * rows)]
        keys = np.zeros((len(block), bands), np.uint64)
        for band in range(bands):
            key = np.full(len(block), band, np.uint64)
            for found in least[band * rows : (band + 1) * rows]:
                key = mixed(key * np.uint64(BASE) + found, 1)
            keys[:, band] = key
        out.append(keys)
    return np.concatenate(out).view(np.int64)


def _key_columns(bands: int) -> str:
    return ", ".join(f"k{i} bigint" for i in range(bands))


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(d, s, p, a, b, k0...)``: id, hash of the text, place and 128-bit hash of each line that isn't blank.

    The band keys stand where the line is met first in a batch. A line shorter
    than a shingle has none: it is like no other line.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    source = docs.select(F.col(id_col).alias("d"), F.xxhash64(text).alias("s"), text.alias("t"))
    kind = source.schema["d"].dataType.simpleString()

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2):
                owners, places, numbers = [], [], []
                known: dict[str, int] = {}
                for owner, text in enumerate(part.column(2).to_pylist()):
                    for place, line in enumerate(normal_lines(text)):
                        if line:
                            owners.append(owner)
                            places.append(place)
                            numbers.append(known.setdefault(line, len(known)))
                lines = list(known)
                long = np.array([len(x) >= CHARS for x in lines], bool)
                keys = np.zeros((len(lines), BANDS), np.int64)
                keys[long] = band_keys([x for x in lines if len(x) >= CHARS], BANDS, ROWS)
                at = np.array(numbers, np.int64)
                first = np.zeros(len(at), bool)
                first[np.unique(at, return_index=True)[1]] = True
                bare = ~(first & long[at])
                halves, owner = line_hashes(lines)[at], pa.array(owners, pa.int64())
                columns = [
                    part.column(0).take(owner),
                    part.column(1).take(owner),
                    pa.array(places, pa.int32()),
                    pa.array(halves[:, 0]),
                    pa.array(halves[:, 1]),
                    *[pa.array(k, mask=bare) for k in keys[at].T.copy()],
                ]
                yield pa.RecordBatch.from_arrays(columns, ["d", "s", "p", "a", "b", *[f"k{i}" for i in range(BANDS)]])

    return source.mapInArrow(find, f"d {kind}, s bigint, p int, a bigint, b bigint, {_key_columns(BANDS)}")


def _texts(docs: DataFrame, text_col: str, wanted: DataFrame) -> DataFrame:
    """``(a, b, l)``: the normal forms of the lines with the ``a`` of ``wanted``, once each.

    Lines whose bit is not set stay where they are; an exact join takes the rest.
    """
    wanted = wanted.select("a").distinct()
    bits = bits_of(wanted, "a")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        array = bits()
        for batch in batches:
            for part in slices(batch, 0):
                lines = list(dict.fromkeys(x for t in part.column(0).to_pylist() for x in normal_lines(t) if len(x) >= CHARS))
                halves = line_hashes(lines)
                held = [i for i, a in enumerate(halves[:, 0]) if has_bit(array, xxhash.xxh64_intdigest(a.tobytes(), 42))]
                columns = [pa.array(halves[held, 0]), pa.array(halves[held, 1]), pa.array([lines[i] for i in held], pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["a", "b", "l"])

    schema = "a bigint, b bigint, l string"
    if bits is None:
        return docs.sparkSession.createDataFrame([], schema)
    found = docs.select(text_col).filter(F.col(text_col).isNotNull()).mapInArrow(find, schema)
    near = found.join(wanted, "a", "left_semi").groupBy("a").agg(F.min(F.struct("b", "l")).alias("t"))
    return near.select("a", "t.b", "t.l")


def shingle_set(hashes: np.ndarray) -> np.ndarray:
    """Distinct hashes in order."""
    found = np.sort(hashes)
    first = np.ones(len(found), bool)
    np.not_equal(found[1:], found[:-1], out=first[1:])
    return found if first.all() else found[first]


def _shingle_rows(texts: DataFrame) -> DataFrame:
    """``(a, n, g)``: each distinct shingle of a line with their number."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1, PAIR_BYTES):
                names = iter(part.column(0).to_pylist())
                for block in _blocks(part.column(1).to_pylist()):
                    hashes, starts, ends = shingle_hashes(block)
                    sets = [shingle_set(hashes[i:j]) for i, j in zip(starts, ends)]
                    sizes = np.array([len(x) for x in sets], np.int64)
                    owner = np.array([next(names) for _ in block], np.int64)
                    columns = [np.repeat(owner, sizes), np.repeat(sizes, sizes), np.concatenate(sets).view(np.int64)]
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["a", "n", "g"])

    return texts.select("a", "l").mapInArrow(find, "a bigint, n bigint, g bigint")


def _signed(texts: DataFrame, bands: int, rows: int) -> DataFrame:
    """``(a, b, k0...)``: lines with their band keys instead of their text."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2):
                keys = band_keys(part.column(2).to_pylist(), bands, rows)
                names = ["a", "b", *[f"k{i}" for i in range(bands)]]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *map(pa.array, keys.T.copy())], names)

    return texts.select("a", "b", "l").mapInArrow(sign, f"a bigint, b bigint, {_key_columns(bands)}")


def _shared_buckets(signed: DataFrame, bands: int = BANDS) -> DataFrame:
    """``(k, a, lo)``: entries of buckets of several lines, with the least line.

    A line may be signed in several rows. Few lines share a bucket, so repeats
    are taken out of those alone. Most buckets have one line, and are not worth
    counting before entries are dealt; count and join share one shuffle.
    """
    entries = signed.select(F.explode(F.array(*[f"k{i}" for i in range(bands)])).alias("k"), "a").repartition("k")
    ends = entries.groupBy("k").agg(F.min("a").alias("lo"), F.max("a").alias("hi"))
    return entries.join(ends.filter("lo != hi").drop("hi"), "k").distinct()


def _star(buckets: DataFrame) -> DataFrame:
    """``(a, c, u, v)``: each line of a bucket with its least one, so a bucket may be of any size."""
    return buckets.filter("a != lo").selectExpr("lo as a", "a as c").distinct().selectExpr("a", "c", "a as u", "c as v")


def _star_across(mixed: DataFrame) -> DataFrame:
    """``(a, c, u, v)``: each line of a bucket with its least one, if that is of another class."""
    return mixed.filter("r != lo_r").selectExpr("lo as a", "a as c", "lo_r as u", "r as v")


def _mixed(buckets: DataFrame, classes: DataFrame) -> DataFrame:
    """``(k, a, r, lo, lo_r, n)``: entries of buckets whose lines are not all of one class yet.

    With their class and that of the least line, which is a line itself where
    none is known, and the bucket's size.
    """
    known = classes.select(F.col("a").alias("a_"), "root")
    told = buckets.join(known, F.col("a") == F.col("a_"), "left")
    told = told.select("k", "a", F.coalesce("root", "a").alias("r"), "lo")
    least = F.max(F.when(F.col("a") == F.col("lo"), F.col("r"))).alias("lo_r")
    sizes = told.groupBy("k").agg(F.min("r").alias("r1"), F.max("r").alias("r2"), F.count(F.lit(1)).alias("n"), least)
    return told.join(sizes.filter("r1 != r2").select("k", "lo_r", "n"), "k")


def _across(mixed: DataFrame) -> DataFrame:
    """``(a, c, u, v)``: the pairs of different classes in buckets of up to ``PAIRED`` lines."""
    small = mixed.filter((F.col("n") > 2) & (F.col("n") <= PAIRED)).selectExpr("k", "a", "r as u")
    other = small.toDF("k", "c", "v")
    return small.join(other, "k").filter("a < c and u != v").select("a", "c", "u", "v")


def _prefix_pairs(texts: DataFrame, opened: DataFrame, similarity: float) -> DataFrame:
    """``(a, c, u, v)``: all pairs of open lines of different classes that can be similar enough, by prefix filter.

    A line's shingles are put in one order for all lines, the rarest first.
    Sets of sizes n >= m that are similar share one of the first
    n - ceil(s n) + 1 shingles of the larger and of the first
    m - ceil(2 s m / (1 + s)) + 1 of the smaller (Xiao et al., 2008). What
    lines of one template share comes last, so it makes no pairs.
    """
    least = lambda part, n: F.ceil(F.lit(part) * F.col(n) - 1e-9)
    lines = texts.join(opened.select("a").distinct(), "a", "left_semi")
    sets = written(_shingle_rows(lines), "line-shingles")
    # A line's own shingles come first, and link nothing: their number alone is needed.
    often = sets.groupBy("g").agg(F.count(F.lit(1)).alias("f")).filter("f > 1")
    ordered = sets.join(often, "g").groupBy("a", "n").agg(F.sort_array(F.collect_list(F.struct("f", "g"))).alias("o"))
    ordered = ordered.withColumn("own", F.col("n") - F.size("o"))
    taken = F.greatest(F.col("n") - least(similarity, "n") + 1 - F.col("own"), F.lit(0)).cast("int")
    first = ordered.select("a", "n", "own", F.posexplode(F.slice("o", F.lit(1), taken)).alias("i", "o"))
    posted = first.selectExpr("a", "n", "own + i as i", "o.g as g").join(opened, "a")
    # Shingles of one class alone link nothing.
    mixed = posted.groupBy("g").agg(F.min("r").alias("r1"), F.max("r").alias("r2")).filter("r1 != r2").select("g")
    posted = written(posted.join(mixed, "g", "left_semi"), "line-prefixes")
    held = F.col("i") < F.col("n") - least(2 * similarity / (1 + similarity), "n") + 1
    small = posted.filter(held).toDF("g", *[f"{c}2" for c in posted.columns[1:]])
    share = similarity / (1 + similarity) * (F.col("n") + F.col("n2")) - 1e-9
    fits = (
        (F.col("r") != F.col("r2"))
        & (F.struct("n", "a") > F.struct("n2", "a2"))
        & (F.col("n2") >= similarity * F.col("n") - 1e-9)
        & (F.least(F.col("n") - F.col("i"), F.col("n2") - F.col("i2")) >= share)
    )
    pairs = posted.join(small, "g").filter(fits).selectExpr("a", "a2 as c", "r as u", "r2 as v").distinct()
    out = written(pairs, "line-pairs")
    discard(sets, posted)
    return out


def _similar(texts: DataFrame, pairs: DataFrame, similarity: float) -> DataFrame:
    """Links ``(u, v)`` of pairs whose sets of shingles are similar enough.

    A pair meets its first text, and takes that along to the second.
    """
    left = texts.select("a", F.col("l").alias("l1"))
    right = texts.select(F.col("a").alias("c"), F.col("l").alias("l2"))
    both = pairs.join(left, "a").join(right, "c").select("u", "v", "l1", "l2")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2, PAIR_BYTES):
                sides = part.column(2).to_pylist(), part.column(3).to_pylist()
                sets: dict[str, np.ndarray] = {}
                for block in _blocks(list(dict.fromkeys([*sides[0], *sides[1]]))):
                    hashes, starts, ends = shingle_hashes(block)
                    sets.update((x, shingle_set(hashes[i:j])) for x, i, j in zip(block, starts, ends))
                near = [_alike(sets[x], sets[y], similarity) for x, y in zip(*sides)]
                yield part.select(["u", "v"]).filter(pa.array(near, pa.bool_()))

    return both.mapInArrow(verify, "u bigint, v bigint")


def _alike(x: np.ndarray, y: np.ndarray, similarity: float) -> bool:
    """Whether two sets, each sorted, have this Jaccard similarity."""
    if min(len(x), len(y)) < similarity * max(len(x), len(y)):
        return False
    both = np.concatenate((x, y))
    both.sort()
    shared = int(np.count_nonzero(both[1:] == both[:-1]))
    return shared >= similarity * (len(both) - shared)


def _merged(classes: DataFrame, links: DataFrame) -> DataFrame:
    """``(a, root)``: classes, and lines that were none, joined by links of their roots.

    Only the roots go through the union-find, not the links that are joined already.
    """
    found = components(links)
    to = found.toDF("root", "to")
    grown = classes.join(to, "root", "left").select("a", F.coalesce("to", "root").alias("root"))
    lone = found.toDF("a", "root").join(classes.select("a"), "a", "left_anti")
    out = written(grown.union(lone), "line-classes")
    discard(found)
    return out


def line_classes(docs: DataFrame, text_col: str, lines: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``(a, b, root)`` of distinct lines that are near copies of others, by class.

    Each line of a bucket is compared with its least one first. Buckets that
    are still of several classes then compare all pairs across them, up to
    ``PAIRED`` lines; larger ones are split by bands of more least hashes, which
    lines of one template seldom share, and go the same way. What is of several
    classes in a large bucket even then is joined by a prefix filter. Only the
    texts of lines that share a bucket are moved, once.
    """
    buckets = written(_shared_buckets(lines.filter("k0 is not null")), "line-buckets")
    texts = written(_texts(docs, text_col, buckets), "line-texts")
    classes = components(_similar(texts, _star(buckets), similarity)).toDF("a", "root")
    mixed = written(_mixed(buckets, classes), "line-mixed")
    discard(buckets)
    pairs = _across(mixed)
    opened = mixed.filter(F.col("n") > PAIRED)
    fine = None
    if not opened.isEmpty():
        keys = written(_signed(texts.join(opened.select("a").distinct(), "a", "left_semi"), FINE_BANDS, FINE_ROWS), "line-keys")
        fine = written(_shared_buckets(keys, FINE_BANDS), "line-buckets")
        discard(keys)
        finer = written(_mixed(fine, classes), "line-mixed")
        # Buckets of two lines are all star.
        pairs = pairs.union(_across(finer)).union(_star_across(finer.filter((F.col("n") > PAIRED) | (F.col("n") == 2))))
    pairs = written(pairs.distinct(), "line-pairs")
    discard(mixed, *([finer] if fine is not None else []))
    if not pairs.isEmpty():
        classes = _merged(classes, _similar(texts, pairs, similarity))
        if fine is not None:
            left = written(_mixed(fine, classes).filter(F.col("n") > PAIRED).select("a", "r").distinct(), "line-open")
            if not left.isEmpty():
                classes = _merged(classes, _similar(texts, _prefix_pairs(texts, left, similarity), similarity))
            discard(left)
    discard(pairs, *([fine] if fine is not None else []))
    # A text has one hash of 128 bits for the first half that it goes by.
    named = written(classes.join(texts.select("a", "b"), "a").select("a", "b", "root"), "line-classes")
    discard(texts)
    return named


def dropped_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY
) -> DataFrame:
    """``(d, s, gone)``: per id and text hash, the places of lines that a kept line stands for.

    The line of a class that is kept is the one with the least id, and the
    first one there. A class is lines of one normal form, or linked ones.
    """
    lines = written(_lines(docs, id_col, text_col), "lines")
    near = line_classes(docs, text_col, lines, similarity)
    again = (
        lines.groupBy("a", "b")
        .agg(F.count(F.lit(1)).alias("n"))
        .join(near, ["a", "b"], "left")
        .filter("n > 1 or root is not null")
        .select("a", "b", F.coalesce("root", "a").alias("r1"), F.when(F.col("root").isNull(), F.col("b")).otherwise(0).alias("r2"))
    )
    placed = lines.join(again, ["a", "b"]).select("r1", "r2", "d", "s", "p")
    # Pre-aggregated, so a line that every document has is no task's burden.
    first = placed.groupBy("r1", "r2").agg(F.min(F.struct(F.col("d").isNull(), "d", "s", "p")).alias("f"))
    gone = placed.join(first, ["r1", "r2"]).filter(
        ~(F.col("d").eqNullSafe(F.col("f.d")) & (F.col("s") == F.col("f.s")) & (F.col("p") == F.col("f.p")))
    )
    return gone.groupBy("d", "s").agg(F.collect_set("p").alias("gone"))


def dedup_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    similarity: float = SIMILARITY,
    counts: tuple[str, str] | None = None,
) -> DataFrame:
    """``docs`` with one line of each class left, in ``text``; other columns stay as they are.

    Lines are compared in lower case and with single spaces. A line's shingles
    are its runs of ``CHARS`` characters, one from each character. Near copies share
    at least ``similarity`` of their distinct shingles (Jaccard). Six bands of
    three least hashes each find a pair at the threshold with a chance of over
    0.98, a pair at 0.85 with one of over 0.99; ``line_classes`` says which lines
    of a bucket are compared. All links are verified on the sets of shingles
    and joined by a distributed union-find.

    Blank lines always stay; a null text stays null. Rows of one id and one
    text count as one document. ``counts`` names two more columns, for the
    number of lines and of those that went. An empty table gives an empty one.
    """
    names = [free_name(docs.columns, n) for n in ("_id", "_hash", "_gone")]
    gone = dropped_lines(docs, id_col, text_col, similarity).toDF(*names)
    text = F.coalesce(docs[text_col], F.lit(""))
    joined = docs.join(
        gone, docs[id_col].eqNullSafe(gone[names[0]]) & (F.xxhash64(text) == gone[names[1]]), "left"
    )
    split = F.split(text, "\n")
    place = gone[names[2]]
    # A set's difference, since a look at all dropped lines for each line would square a long text.
    left = F.array_except(F.sequence(F.lit(0), F.size(split) - 1), place)
    # The outer lambda holds the split text, which the inner one would split anew for each line.
    held = F.transform(F.array(split), lambda lines: F.transform(left, lambda i: F.get(lines, i)))
    kept = F.array_join(F.get(held, F.lit(0)), "\n")
    columns = [
        F.when(place.isNotNull(), kept).otherwise(docs[text_col]).alias(c) if c == text_col else docs[c]
        for c in docs.columns
    ]
    if counts:
        columns += [
            F.size(split).cast("bigint").alias(counts[0]),
            F.coalesce(F.size(place), F.lit(0)).cast("bigint").alias(counts[1]),
        ]
    return joined.select(*columns)


def op4_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = dedup_lines(docs, counts=("n_lines", "n_removed"))
    return kept.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))
