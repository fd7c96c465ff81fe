"""Spelling variants: words one edit apart, found by composing automata."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripguard.llm.common import SLICE_BYTES, table, texts_of, written

LEAST_LENGTH, LEAST_COUNT = 6, 5
# A form occurs so many times as often as the word it stands for.
FACTOR = 5
# One in so many runs of a document loses a character.
SLIP = 199
# Characters that part the vocabulary, from either end. Of two words of
# LEAST_LENGTH that are one edit apart, that many are equal at one end at least.
ENDS = LEAST_LENGTH // 2
# Words of a partition that one task composes.
PART_WORDS = 8192
# Counts a task holds before it sends them on.
HELD_WORDS = 200_000

# In Latin-1, letters are single bytes; what is no letter becomes a space.
_PLAIN = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 192 else 32 for b in range(256))
Batches = Iterator[pa.RecordBatch]


def _runs(text: bytes) -> Counter:
    """Runs of letters in Latin-1 and how often they occur; long texts go by parts."""
    counts: Counter = Counter()
    plain, start = text.decode().encode("latin-1", "replace").translate(_PLAIN), 0
    while start < len(plain):
        end = len(plain)
        if end - start > SLICE_BYTES:
            cut = plain.find(b" ", start + SLICE_BYTES)
            end = cut if cut >= 0 else end
        counts.update(plain[start:end].split())
        start = end
    return counts


def slipped(doc_id: object, run: bytes) -> bytes:
    """``run`` (Latin-1), less one character if the checksum of document and run says so."""
    seed = crc32(b":" if doc_id is None else f"{doc_id}:".encode())
    return _slipped(seed, run)


def _slipped(seed: int, run: bytes) -> bytes:
    h = crc32(run if run.isascii() else run.decode("latin-1").encode(), seed)
    if h % SLIP:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def _count_words(batches: Batches) -> Batches:
    """Words and counts of what a task has read, some hundred thousand words at a time."""

    def told() -> pa.RecordBatch:
        words = pa.array([w.decode("latin-1") for w in held], pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(held.values(), pa.int64())], ["word", "n"])

    held: Counter = Counter()
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), texts_of(batch, 1)):
            seed = crc32(b":" if doc_id is None else f"{doc_id}:".encode())
            for run, n in _runs(text).items():
                if len(run) >= LEAST_LENGTH:
                    word = _slipped(seed, run)
                    if len(word) >= LEAST_LENGTH:
                        held[word] += n
            if len(held) > HELD_WORDS:
                yield told()
                held.clear()
    yield told()


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(word, n)``: words of at least ``LEAST_LENGTH`` characters that occur ``LEAST_COUNT`` times."""
    source = docs.select(docs[id_col].alias("i"), docs[text_col].alias("t"))
    counts = source.mapInArrow(_count_words, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.filter(F.col("n") >= LEAST_COUNT)


class Acceptor:
    """The least automaton that accepts a sorted list of words; state 0 is its initial state.

    Built word by word: the states behind the common prefix with the next word
    are final, and one with equal arcs takes their place if there is one
    (Daciuk et al., 2000).
    """

    def __init__(self, words: list[str]) -> None:
        self.arcs: list[dict[str, int]] = [{}]
        self.final = [False]
        same: dict[tuple, int] = {}
        open_: list[tuple[int, str, int]] = []
        before = ""

        def close(depth: int) -> None:
            while len(open_) > depth:
                state, symbol, child = open_.pop()
                key = (self.final[child], *self.arcs[child].items())
                self.arcs[state][symbol] = same.setdefault(key, child)

        for word in words:
            shared = 0
            while shared < len(before) and shared < len(word) and before[shared] == word[shared]:
                shared += 1
            close(shared)
            state = open_[-1][2] if open_ else 0
            for symbol in word[shared:]:
                self.arcs.append({})
                self.final.append(False)
                open_.append((state, symbol, len(self.arcs) - 1))
                state = len(self.arcs) - 1
            self.final[state] = True
            before = word
        close(0)


class Composition:
    """An acceptor, the transducer of one edit, and the acceptor again, composed.

    A state is two states of the acceptor and whether the edit is done. Before
    it both have read the same, so they are one state; after it both must read
    the same. ``longest`` bounds what may follow the edit.
    """

    def __init__(self, acceptor: Acceptor, longest: int | None = None) -> None:
        self.arcs, self.final, self.longest = acceptor.arcs, acceptor.final, longest
        self.common_of: dict[tuple[int, int, int | None], list[str]] = {}
        self.edits_of: dict[int, list[tuple[str, str]]] = {}

    def common(self, s: int, t: int, longest: int | None) -> list[str]:
        """What both states accept."""
        key = (s, t, longest) if s < t else (t, s, longest)
        found = self.common_of.get(key)
        if found is None:
            found = [""] if self.final[s] and self.final[t] else []
            if longest != 0:
                left, right = self.arcs[s], self.arcs[t]
                if len(left) > len(right):
                    left, right = right, left
                for symbol, state in left.items():
                    if symbol in right:
                        rest = self.common(state, right[symbol], None if longest is None else longest - 1)
                        found += [symbol + z for z in rest]
            self.common_of[key] = found
        return found

    def edits(self, s: int) -> list[tuple[str, str]]:
        """What two words read from a state at which their edit comes; neither reads the same symbol next."""
        found = self.edits_of.get(s)
        if found is None:
            arcs = sorted(self.arcs[s].items())
            found = []
            for n, (a, u) in enumerate(arcs):
                for b, v in arcs[n + 1 :]:
                    found += [(a + z, b + z) for z in self.common(u, v, self.longest)]
                found += [(a + z, z) for z in self.common(u, s, self.longest) if not z.startswith(a)]
            self.edits_of[s] = found
        return found

    def pairs(self) -> Iterator[tuple[str, str]]:
        """Each two accepted words that are one edit apart, once."""
        todo = [(0, "")]
        while todo:
            state, read = todo.pop()
            for x, y in self.edits(state):
                yield read + x, read + y
            todo += [(child, read + symbol) for symbol, child in self.arcs[state].items()]


def _compose(part: pa.Table) -> pa.Table:
    """The near pairs of one partition: words of one beginning, read from its end on.

    Words that are read backward tell only pairs whose beginnings differ; the
    others are found forward.
    """
    backward = part.column("side")[0].as_py() == 1
    start = part.column("part")[0].as_py()
    counts = dict(zip(part.column("v").to_pylist(), part.column("n").to_pylist()))
    acceptor = Acceptor(sorted(v[len(start) :] for v in counts))
    out: tuple[list, list, list, list] = ([], [], [], [])
    for x, y in Composition(acceptor, ENDS - 1 if backward else None).pairs():
        x, y = start + x, start + y
        n, m = counts[x], counts[y]
        if backward:
            x, y = x[::-1], y[::-1]
            if x[:ENDS] == y[:ENDS]:
                continue
        for column, value in zip(out, (x, n, y, m)):
            column.append(value)
    kinds = (pa.string(), pa.int64(), pa.string(), pa.int64())
    return pa.table({c: pa.array(values, kind) for c, values, kind in zip(("x", "n", "y", "m"), out, kinds)})


PAIRS = "x string, n bigint, y string, m bigint"


def _edits_at(opened: DataFrame, depth: int) -> DataFrame:
    """Near pairs of large partitions whose edit comes right behind the beginning of ``depth`` characters.

    What follows the edit is the same in both words. So these transitions of a
    partition's initial state fall apart by it, and of words that share
    beginning and rest there is one for each character, and one without.
    """
    whole = f"named_struct('a', '', 'z', substring(v, {depth + 1}))"
    less = f"named_struct('a', substring(v, {depth + 1}, 1), 'z', substring(v, {depth + 2}))"
    ways = F.expr(f"inline(if(char_length(v) > {depth}, array({whole}, {less}), array({whole})))")
    read = opened.select("side", "part", "v", "n", ways)
    read = read.filter(f"side = 0 or char_length(z) < {ENDS}")
    alike = read.groupBy("side", "part", "z").agg(F.collect_list(F.struct("a", "v", "n")).alias("w")).filter("size(w) > 1")
    one = alike.select("side", "z", "w", F.explode("w").alias("x"))
    both = one.select("side", "z", "x", F.explode("w").alias("y")).filter("x.a > y.a and (y.a != '' or not startswith(z, x.a))")
    forward = lambda c: F.expr(f"if(side = 1, reverse({c}.v), {c}.v)")
    pairs = both.select("side", forward("x").alias("x"), F.col("x.n").alias("n"), forward("y").alias("y"), F.col("y.n").alias("m"))
    return pairs.filter(f"side = 0 or left(x, {ENDS}) != left(y, {ENDS})").drop("side")


def near_pairs(words: DataFrame, part_words: int = PART_WORDS) -> DataFrame:
    """``(x, n, y, m)``: each two words one edit apart, once, with their counts.

    The vocabulary's acceptor, the transducer of one edit and the acceptor
    again are composed partition by partition of their initial state: words
    that begin with the same three characters, and, read backward, words that
    end so. Every pair agrees at one of its ends at least. A partition of more
    than ``part_words`` words is parted once more by the next character; pairs
    whose edit is that character are then found by what follows it.
    """
    view = F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("word").alias("v")), F.struct(F.lit(1).alias("side"), F.reverse("word").alias("v"))))
    opened = words.select(view.alias("e"), "n").select("e.side", "e.v", "n")
    depth, found = ENDS, None
    while True:
        opened = opened.withColumn("part", F.expr(f"left(v, {depth})"))
        sizes = opened.groupBy("side", "part").agg(F.count(F.lit(1)).alias("words"))
        large = written(sizes.filter(F.col("words") > part_words), "word-parts").select("side", "part")
        more = not large.isEmpty()
        small = opened.join(large, ["side", "part"], "left_anti") if more else opened
        pairs = small.groupBy("side", "part").applyInArrow(_compose, PAIRS)
        found = pairs if found is None else found.union(pairs)
        if not more:
            return found
        opened = written(opened.join(large, ["side", "part"], "left_semi").select("side", "part", "v", "n"), "word-parts")
        found = found.union(_edits_at(opened, depth))
        opened = opened.filter(F.char_length("v") > depth).select("side", "v", "n")
        depth += 1


def _roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` from ``(word, form)``: the end of each chain, by doubling its steps.

    Counts grow along a chain, so it has no loop, and its length is at most
    the logarithm of the largest count.
    """
    steps = written(forms.select("word", F.col("form").alias("root")), "word-roots")
    while True:
        ahead = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = steps.join(ahead, "root", "left")
        moved = written(moved.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "word-roots")
        steps = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            return steps


def spelling_variants(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", factor: int = FACTOR, part_words: int = PART_WORDS
) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)``: the words of a corpus and the spelling each stands for.

    Words are runs of A-Z, a-z and U+00C0 to U+00FF with A-Z in lower case; a
    run that the checksum of document and run picks loses one character
    (``slipped``). Words of six characters and five occurrences count. Words
    are near if one inserted, deleted or replaced character makes them equal.
    A word's form is its near word with the largest n, the least in order of
    code points of equal ones, if that is at least ``factor`` times its own;
    ``root`` follows forms to the last.

    A null text has no words, a null id reads as empty, repeated rows count as
    often as they occur, and other columns are ignored. An empty table gives an
    empty one.
    """
    words = written(vocabulary(docs, id_col, text_col), "words")
    pairs = near_pairs(words, part_words)
    ways = F.inline(
        F.array(
            F.struct(F.col("x").alias("word"), "n", F.struct((-F.col("m")).alias("less"), F.col("y").alias("form")).alias("near")),
            F.struct(F.col("y").alias("word"), F.col("m").alias("n"), F.struct((-F.col("n")).alias("less"), F.col("x").alias("form")).alias("near")),
        )
    )
    alone = words.select("word", "n", F.expr("cast(null as struct<less: bigint, form: string>) as near"))
    rows = pairs.select(ways).union(alone).groupBy("word").agg(
        F.max("n").alias("n"), F.count("near").alias("n_near"), F.min("near").alias("near")
    )
    has = -F.col("near.less") >= factor * F.col("n")
    told = written(
        rows.select(
            "word", "n", "n_near", F.when(has, F.col("near.form")).alias("form"), F.when(has, -F.col("near.less")).alias("form_n")
        ),
        "word-forms",
    )
    roots = _roots(told.filter("form is not null"))
    return told.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def op13_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


# A checksum is linear: each byte adds what its table entry becomes by as many
# steps as bytes follow, and the start value what it becomes by all of them.
OP13_SQL = r"""
WITH RECURSIVE
runs AS (
  SELECT d, translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w, count(*) AS n
  FROM (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS d,
          unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{C0}-\x{FF}]+')) AS w FROM documents)
  GROUP BY ALL),
long AS (SELECT row_number() OVER () AS r, d, w, n, hex(encode(d || ':' || w)) AS h FROM runs WHERE length(w) >= 6),
t AS (
  SELECT list(v ORDER BY b) AS t FROM (
    SELECT b, list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0],
      lambda c, k: CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END) AS v
    FROM (SELECT CAST(range AS BIGINT) AS b FROM range(256)))),
steps(d, b, v) AS (
  SELECT 0, b, CASE WHEN b = 256 THEN 4294967295 ELSE t[b + 1] END FROM t, (SELECT range AS b FROM range(257))
  UNION ALL
  SELECT d + 1, b, xor(t[(v % 256) + 1], v // 256) FROM steps, t WHERE d < (SELECT max(length(h)) // 2 FROM long)),
bytes AS (
  SELECT r, length(h) // 2 AS size, unnest(range(1, length(h) // 2 + 1)) AS i, h FROM long),
parts AS (
  SELECT r, size - i AS d, CAST(('0x' || substr(h, 2 * CAST(i AS INT) - 1, 2)) AS BIGINT) AS b FROM bytes
  UNION ALL SELECT r, length(h) // 2, 256 FROM long),
sums AS (SELECT r, xor(bit_xor(v), 4294967295) AS h FROM parts JOIN steps USING (d, b) GROUP BY r),
words AS (
  SELECT CASE WHEN s.h % 199 = 0
      THEN substr(w, 1, CAST(s.h % length(w) AS INT)) || substr(w, CAST(s.h % length(w) AS INT) + 2) ELSE w END AS word,
    n FROM long JOIN sums s USING (r)),
vocab AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM words WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
cuts AS (
  SELECT word, n, CAST(i AS INT) AS i, substr(word, 1, CAST(i AS INT) - 1) || substr(word, CAST(i AS INT) + 1) AS c
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM vocab)),
pairs AS (
  SELECT a.word AS x, b.word AS y, b.n AS m FROM cuts a JOIN cuts b ON a.i = b.i AND a.c = b.c AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cuts a JOIN vocab b ON a.c = b.word
  UNION SELECT b.word, a.word, a.n FROM cuts a JOIN vocab b ON a.c = b.word),
best AS (SELECT x AS word, count(*) AS n_near, max(m) AS m, first(y ORDER BY m DESC, y) AS y FROM pairs GROUP BY x),
told AS (
  SELECT word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 5 * v.n THEN y END AS form,
    CASE WHEN m >= 5 * v.n THEN m END AS form_n FROM vocab v LEFT JOIN best USING (word)),
chain(word, root) AS (
  SELECT word, word FROM told
  UNION ALL SELECT c.word, t.form FROM chain c JOIN told t ON t.word = c.root WHERE t.form IS NOT NULL)
SELECT word, form, c.root, t.n, n_near, form_n
FROM told t JOIN chain c USING (word) ANTI JOIN (SELECT word AS root FROM told WHERE form IS NOT NULL) USING (root)
"""
