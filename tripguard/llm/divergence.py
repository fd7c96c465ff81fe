"""How far the sources of a language differ in their terms."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripguard.llm.common import bits_of, has_bit, slices, table, written

# A term is kept in a language if so many of its documents have it.
LEAST_DOCUMENTS = 10
# Bytes of the first prefixes; each level doubles them.
FIRST_LEVEL = 8
# Terms and sources of a block that one task compares at a time.
BLOCK_TERMS, TILE_SOURCES = 4096, 128
TOP_TERMS = 10
SCALE = 1_000_000_000

# Bytes of text that a task takes apart at once; a longer text goes by parts.
PART_BYTES = 16 << 20
# Letters and bytes of characters beyond ASCII make terms, A-Z in lower case.
_PLAIN = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_PLAIN_TABLE = np.frombuffer(_PLAIN, np.uint8)
Batches = Iterator[pa.RecordBatch]


def _pieces(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, some megabytes at a time."""
    plain, start = text.translate(_PLAIN), 0
    while len(plain) - start > PART_BYTES:
        end = plain.rfind(b" ", start, start + PART_BYTES)
        if end < 0:
            end = plain.find(b" ", start)
        if end < 0:
            break
        yield plain[start:end].split()
        start = end + 1
    yield plain[start:].split()


def _split(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The terms of all texts, an empty one among them here and there, and how many are of each text."""
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1]
    held = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data else np.zeros(0, np.uint8)
    plain = pa.StringArray.from_buffers(len(texts), pa.py_buffer((ends - ends[0]).astype(np.int32)), pa.py_buffer(_PLAIN_TABLE[held]))
    words = pc.ascii_split_whitespace(plain)
    return words.flatten(), words.value_lengths().to_numpy()


def _by_language(part: pa.RecordBatch) -> Iterator[tuple[str, list[int], list[int]]]:
    """Languages with their rows, those of very long texts apart."""
    sizes = pc.binary_length(part.column(1)).to_numpy()
    rows = defaultdict(lambda: ([], []))
    for row, lang in enumerate(part.column(0).to_pylist()):
        rows[lang][int(sizes[row] > PART_BYTES)].append(row)
    for lang, (short, long) in rows.items():
        yield lang, short, long


def _coded(terms: pa.Array) -> tuple[list[bytes], np.ndarray]:
    """Distinct terms, and the number of each term among them."""
    coded = terms.dictionary_encode()
    return coded.dictionary.cast(pa.binary()).to_pylist(), coded.indices.to_numpy().astype(np.int64)


def _prefix_counter(length: int, before: int, bits: Callable[[], bytes] | None) -> Callable[[Batches], Batches]:
    """Documents per prefix of ``length`` bytes, of terms whose prefix of ``before`` bytes is alive.

    A term of at most ``length`` bytes counts as a whole, with ``done``. No
    document spans two parts, so counts of parts just add up.
    """

    def candidates(lang: str, terms: list[bytes]) -> tuple[dict, np.ndarray]:
        items: dict[tuple[bytes, bool], int] = {}
        ids = np.full(len(terms), -1, np.int64)
        alive, seed = bits and bits(), xxhash.xxh64_intdigest(lang.encode(), 42)
        for i, term in enumerate(terms):
            if len(term) > before and (alive is None or has_bit(alive, xxhash.xxh64_intdigest(term[:before], seed))):
                ids[i] = items.setdefault((term[:length], len(term) <= length), len(items))
        return items, ids

    def counted(lang: str, terms: pa.Array, sizes: np.ndarray) -> Batches:
        distinct, codes = _coded(terms)
        items, ids = candidates(lang, distinct)
        if items:
            owner, chosen = np.repeat(np.arange(len(sizes)), sizes), ids[codes]
            pairs = owner[chosen >= 0] * len(items) + chosen[chosen >= 0]
            held = pa.array(pairs).unique().to_numpy() % len(items)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(items)),
                    pa.array([p for p, _ in items], pa.binary()),
                    pa.array([d for _, d in items]),
                    pa.array(np.bincount(held, minlength=len(items))),
                ],
                ["lang", "prefix", "done", "docs"],
            )

    def count(batches: Batches) -> Batches:
        for batch in batches:
            for part in slices(batch, 1, PART_BYTES):
                for lang, short, long in _by_language(part):
                    yield from counted(lang, *_split(part.column(1).take(pa.array(short, pa.int64()))))
                    for row in long:
                        terms = list(set().union(*_pieces(part.column(1)[row].as_buffer().to_pybytes())))
                        yield from counted(lang, pa.array(terms, pa.binary()).cast(pa.string()), np.array([len(terms)]))

    return count


def kept_terms(rows: DataFrame, least: int = LEAST_DOCUMENTS, first: int = FIRST_LEVEL) -> DataFrame:
    """``(lang, term, docs)``: the terms that at least ``least`` documents of their language hold.

    ``rows`` has lang and text without nulls; a row is a document. Terms grow
    from byte prefixes: a level counts, for each prefix, the documents with a
    term that begins so, and prefixes under the threshold end there, with all
    terms they begin. Prefixes that are alive reach the next level as a bit
    array of a fixed size, indexed by a hash: a bit set by another prefix lets
    a term through to be counted, none that is alive is ever missed. The last
    level is the one after which no prefix is alive but whole terms.
    """
    kept, before, length, bits = None, 0, first, None
    while True:
        counted = rows.select("lang", "text").mapInArrow(
            _prefix_counter(length, before, bits), "lang string, prefix binary, done boolean, docs bigint"
        )
        summed = counted.groupBy("lang", "prefix", "done").agg(F.sum("docs").alias("docs"))
        alive = written(summed.filter(F.col("docs") >= least), "term-prefixes")
        whole = alive.filter("done").select("lang", F.col("prefix").cast("string").alias("term"), "docs")
        kept = whole if kept is None else kept.union(whole)
        bits = bits_of(alive.filter("not done"), "lang", "prefix")
        if bits is None:
            return kept
        before, length = length, 2 * length


def _occurrences(bits: Callable[[], bytes] | None) -> Callable[[Batches], Batches]:
    """Occurrences by language, source and term, of terms that may be kept."""

    def counted(lang: str, terms: pa.Array, held: np.ndarray, sources: pa.Array) -> pa.RecordBatch:
        alive, seed = bits and bits(), xxhash.xxh64_intdigest(lang.encode(), 42)
        distinct, codes = _coded(terms)
        hit = np.fromiter(
            (alive is not None and t != b"" and has_bit(alive, xxhash.xxh64_intdigest(t, seed)) for t in distinct), bool, len(distinct)
        )
        there = hit[codes]
        found = pa.array(held[there] * max(1, len(distinct)) + codes[there]).value_counts()
        keys = found.field("values").to_numpy()
        return pa.RecordBatch.from_arrays(
            [
                pa.array([lang] * len(keys), pa.string()),
                sources.take(pa.array(keys // max(1, len(distinct)))),
                pa.array(distinct, pa.binary()).cast(pa.string()).take(pa.array(keys % max(1, len(distinct)))),
                found.field("counts"),
            ],
            ["lang", "source", "term", "n"],
        )

    def count(batches: Batches) -> Batches:
        for batch in batches:
            for part in slices(batch, 1, PART_BYTES):
                for lang, short, long in _by_language(part):
                    coded = part.column(2).take(pa.array(short, pa.int64())).dictionary_encode()
                    terms, sizes = _split(part.column(1).take(pa.array(short, pa.int64())))
                    held = np.repeat(coded.indices.to_numpy().astype(np.int64), sizes)
                    yield counted(lang, terms, held, coded.dictionary)
                    for row in long:
                        for piece in _pieces(part.column(1)[row].as_buffer().to_pybytes()):
                            terms = pa.array(piece, pa.binary()).cast(pa.string())
                            yield counted(lang, terms, np.zeros(len(piece), np.int64), part.column(2).slice(row, 1))

    return count


def _share(count: str, total: str, kept: str) -> Column:
    """1 + floor(10^9 (count + 2) / (total + 2 kept)), exact; 1 in a language that keeps no term."""
    exact = f"1 + (cast({SCALE} as decimal(10,0)) * ({count} + 2)) div ({total} + 2 * {kept})"
    return F.expr(f"if({total} + 2 * {kept} = 0, 1L, {exact})")


def _apart(p: str, q: str) -> str:
    return f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})"


def _block_sums(block: pa.Table) -> pa.Table:
    """Sums over one block of terms for each pair of sources of two tiles.

    Rows are the shares of terms that a source has; those without a term tell
    the share of all others. A matrix of the block's terms and sources is all
    that is held.
    """
    lang, i, j, _ = (block.column(c)[0].as_py() for c in ("lang", "i", "j", "block"))
    term, source = block.column("term"), block.column("source").to_pylist()
    tile, p = block.column("tile").to_numpy(), block.column("p").to_numpy()
    marks = term.is_null().to_numpy(zero_copy_only=False)
    names = {source[r]: c for c, r in enumerate(np.flatnonzero(marks).tolist())}
    at = np.fromiter((names[s] for s in source), np.int64, len(source))
    rest, tiles = np.zeros(len(names), np.int64), np.zeros(len(names), np.int64)
    rest[at[marks]], tiles[at[marks]] = p[marks], tile[marks]
    coded = term.combine_chunks().filter(pa.array(~marks)).dictionary_encode()
    shares = np.repeat(rest[None, :], len(coded.dictionary), 0)
    shares[coded.indices.to_numpy(), at[~marks]] = p[~marks]
    known = list(names)
    left, right = np.flatnonzero(tiles == i), np.flatnonzero(tiles == j)
    out: tuple[list, list, list] = ([], [], [])
    for a in left.tolist():
        others = right[right > a] if i == j else right
        if len(others):
            one, two = shares[:, [a]], shares[:, others]
            sums = ((one - two) ** 2 // (one + two)).sum(axis=0)
            out[0].extend([known[a]] * len(others))
            out[1].extend(known[b] for b in others.tolist())
            out[2].extend(sums.tolist())
    n = len(out[0])
    return pa.table(
        {
            "lang": pa.array([lang] * n, pa.string()),
            "a": pa.array(out[0], pa.string()),
            "b": pa.array(out[1], pa.string()),
            "value": pa.array(out[2], pa.int64()),
            "seen": pa.array([len(coded.dictionary)] * n, pa.int64()),
        }
    )


def source_pairs(shares: DataFrame, groups: DataFrame) -> DataFrame:
    """``(lang, source, item, value)``: how far each two sources of a language are apart, both ways.

    ``shares`` has ``(lang, source, term, p)`` of the terms a source has,
    ``groups`` every ``(lang, source, rest, kept)`` with the share of a term it
    lacks and the number of kept terms. Terms are dealt into blocks and sources
    into tiles by their hashes, so a task holds one block of two tiles however
    many rows a source or a term has. Terms that neither tile has in a block
    are all alike and need no row.
    """
    dealt = groups.groupBy("lang").agg(
        F.ceil(F.count(F.lit(1)) / F.lit(TILE_SOURCES)).cast("int").alias("tiles"),
        F.greatest(F.ceil(F.max("kept") / F.lit(BLOCK_TERMS)), F.lit(1)).cast("int").alias("blocks"),
    )
    tile = F.expr("cast(pmod(xxhash64(source), tiles) as int)").alias("tile")
    marks = groups.join(dealt, "lang").select(
        "lang", "source", F.lit(None).cast("string").alias("term"), F.col("rest").alias("p"), tile, "tiles",
        F.explode(F.expr("sequence(0, blocks - 1)")).alias("block"),
    )
    rows = shares.join(dealt, "lang").select(
        "lang", "source", "term", "p", tile, "tiles", F.expr("cast(pmod(xxhash64(term), blocks) as int)").alias("block")
    )
    spread = rows.unionByName(marks).select(
        "*", F.explode(F.expr("sequence(0, tiles - 1)")).alias("other")
    ).select("lang", F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j"), "block", "source", "term", "p", "tile")
    sums = spread.groupBy("lang", "i", "j", "block").applyInArrow(
        _block_sums, "lang string, a string, b string, value bigint, seen bigint"
    )
    pairs = sums.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"), F.sum("seen").alias("seen"))
    one = groups.select("lang", F.col("source").alias("a"), F.col("rest").alias("rest_a"), "kept")
    two = groups.select("lang", F.col("source").alias("b"), F.col("rest").alias("rest_b"))
    whole = pairs.join(one, ["lang", "a"]).join(two, ["lang", "b"])
    value = F.expr(f"value + (kept - seen) * ({_apart('rest_a', 'rest_b')})")
    both = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
    return whole.select("lang", both.alias("e"), value.alias("value")).select("lang", "e.source", "e.item", "value")


def source_divergence(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    least: int = LEAST_DOCUMENTS,
    top: int = TOP_TERMS,
) -> DataFrame:
    """``(lang, source, part, item, value, rank)``: what sets each source of a language apart.

    Terms are runs of letters and of characters beyond ASCII, A-Z in lower
    case. A language keeps the terms that at least ``least`` of its documents
    hold (``kept_terms``). A source's share of a kept term is
    p = 1 + floor(10^9 (count + 2) / (N + 2 V)), over its N occurrences of the
    V kept terms. Two shares are floor((p - q)^2 / (p + q)) apart.

    Part ``pair``: each other source of the language, with that sum over all
    kept terms. Part ``term``: the ``top`` terms whose share is larger than the
    language's, with their distance. Ties go to the lesser item in UTF-8.

    A null text, language or source reads as empty, each row counts as one
    document, repeated rows too, and other columns are ignored. A source
    without terms has pairs; the only source of a language has none. An empty
    table gives an empty one.
    """
    spark = docs.sparkSession
    rows = docs.select(*[
        F.coalesce(docs[c].cast("string"), F.lit("")).alias(n)
        for c, n in ((lang_col, "lang"), (text_col, "text"), (source_col, "source"))
    ])
    kept = kept_terms(rows, least)
    found = rows.mapInArrow(_occurrences(bits_of(kept, "lang", "term")), "lang string, source string, term string, n bigint")
    # Dealt by language and term once, for the sums by source, the join and the
    # sums of the language. The bit array lets a few other terms through; the
    # join takes them out.
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = found.repartition(parts, "lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"))
    counts = dealt.join(kept.select("lang", "term"), ["lang", "term"])
    whole = F.sum("n").over(Window.partitionBy("lang", "term")).alias("whole")
    counts = written(counts.select("lang", "term", "source", "n", whole), "term-counts")
    sizes = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = (
        rows.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("rows"))
        .join(totals, ["lang", "source"], "left")
        .join(sizes, "lang", "left")
        .select("lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("kept", F.lit(0)).alias("kept"))
    )
    groups = written(groups.withColumn("rest", _share("0L", "total", "kept")), "term-groups")
    by_lang = groups.groupBy("lang").agg(F.sum("total").alias("all"))
    shares = counts.join(groups.join(by_lang, "lang"), ["lang", "source"]).select(
        "lang", "source", "term", _share("n", "total", "kept").alias("p"), _share("whole", "all", "kept").alias("q")
    )
    pairs = source_pairs(shares, groups).withColumn("part", F.lit("pair"))
    own = shares.filter("p > q")
    own = own.select("lang", "source", F.col("term").alias("item"), F.expr(_apart("p", "q")).alias("value"), F.lit("term").alias("part"))

    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    ranked = [f.withColumn("rank", F.row_number().over(order)) for f in (pairs, own)]
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return ranked[0].select(*columns).union(ranked[1].filter(F.col("rank") <= top).select(*columns))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(table(spark, sf_dir, "documents"))


OP12_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS t
  FROM documents),
words AS (
  SELECT r, lang, source, translate(unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM d),
kept AS (SELECT lang, term FROM words GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term),
g AS (SELECT DISTINCT lang, source FROM d),
dense AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, v.v
  FROM g JOIN kept k USING (lang) JOIN v USING (lang)
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
p AS (
  SELECT lang, source, term, n,
    CAST(1 + (1000000000::HUGEINT * (n + 2)) // (sum(n) OVER (PARTITION BY lang, source) + 2 * v) AS BIGINT) AS p
  FROM dense),
q AS (
  SELECT lang, term,
    CAST(1 + (1000000000::HUGEINT * (n + 2)) // (sum(n) OVER (PARTITION BY lang) + 2 * v) AS BIGINT) AS q
  FROM (SELECT lang, term, sum(n) AS n, max(v) AS v FROM dense GROUP BY lang, term)),
far AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS f
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(f, 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN far ON far.lang = a.lang AND far.source = a.source AND far.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, CAST(((p - q) * (p - q)) // (p + q) AS BIGINT)
  FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INT) AS rank FROM parts)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 10
"""
