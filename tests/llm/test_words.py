"""Source divergence and spelling variants against brute force."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import product

import pyarrow as pa
import pytest
from corpora import CLASHING, documents, empty, odd_rows, values

from tripguard.llm import common, divergence, variants

COLUMNS = ["lang", "source", "part", "item", "value", "rank"]


def plain(word):
    return re.sub("[A-Z]", lambda m: m[0].lower(), word)


def brute_divergence(rows, least=10, top=10):
    """rows: (text, lang, source)."""
    rows = [(t or "", a or "", s or "") for t, a, s in rows]
    term = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    docs, counts, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        words = [plain(w) for w in term.findall(text)]
        docs[lang].update(set(words))
        counts[lang, source].update(words)
        groups[lang].add(source)
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= least]

        def shares(count, kept=kept):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 2) // (total + 2 * len(kept)) for t in kept}

        q = shares(sum((counts[lang, s] for s in sources), Counter()))
        p = {s: shares(counts[lang, s]) for s in sources}
        apart = lambda x, y: (x - y) ** 2 // (x + y)
        for s in sources:
            pairs = [(o, sum(apart(p[s][t], p[o][t]) for t in kept)) for o in sources if o != s]
            terms = [(t, apart(p[s][t], q[t])) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                ranked = sorted(found, key=lambda x: (-x[1], x[0].encode()))[:most]
                out += [(lang, s, part, item, value, r + 1) for r, (item, value) in enumerate(ranked)]
    return sorted(out, key=repr)


def corpus(seed=3, n=260):
    rng = random.Random(seed)
    stems = ["".join(x) for x in product("abct", "aeé", "bdRlß", ["", "n", "ing", "n漢字", "tenlangesWort" * 3])]
    rows = []
    for _ in range(n):
        lang, source = rng.choice(["en", "de", None]), rng.choice(["s1", "s1", "s1", "s2", "s3", None])
        words = [rng.choice(stems) for _ in range(rng.randrange(60))]
        words += [rng.choice(stems) + rng.choice(stems) for _ in range(rng.randrange(5))]
        rows.append((rng.choice([" ", "-", ", "]).join(words), lang, source))
    return rows + [(None, "en", "s9"), ("", "xx", "a"), ("1234", "xx", "b"), ("few words", "yy", "alone")] + rows[:9]


def framed(spark, rows):
    frame = spark.createDataFrame([(t, a, s) for t, a, s in rows], "text string, lang string, source string")
    for name in ("term", "n", "tile", "value", "prefix", "docs"):
        frame = frame.withColumn(name, frame["lang"])
    return frame


@pytest.mark.parametrize(("bits", "block", "tile"), [(1 << 24, 4096, 128), (64, 7, 2)])
def test_divergence_equals_brute_force(spark, monkeypatch, bits, block, tile):
    """Also with a bit array that is full at once, and with many blocks and tiles."""
    monkeypatch.setattr(common, "KEY_BITS", bits)
    monkeypatch.setattr(divergence, "BLOCK_TERMS", block)
    monkeypatch.setattr(divergence, "TILE_SOURCES", tile)
    rows = corpus()
    want = brute_divergence(rows)
    assert len(want) > 60 and any(len(r[3]) > 32 for r in want)
    assert values(divergence.source_divergence(framed(spark, rows)), *COLUMNS) == want


def test_divergence_of_odd_tables(spark):
    docs = documents(spark, clash=True)
    want = brute_divergence([(t, a, s) for _, t, a, s, _ in odd_rows()], least=2)
    assert values(divergence.source_divergence(docs, least=2), *COLUMNS) == want
    assert divergence.source_divergence(empty(spark)).count() == 0


def test_long_texts_are_split_in_parts(monkeypatch):
    monkeypatch.setattr(divergence, "PART_BYTES", 50)
    monkeypatch.setattr(variants, "SLICE_BYTES", 50)
    text = " ".join(f"wordé{'x' * (i % 70)}" for i in range(200)).encode()
    assert [t for piece in divergence._pieces(text) for t in piece] == text.split()
    many = [text.decode(), "", "A-b 1c", *["x" * 60] * 3]
    batch = pa.RecordBatch.from_arrays([pa.array(["en", "de", "en", *["en"] * 3]), pa.array(many), pa.array(["s", "t", "t", "s", "s", "t"])], ["lang", "text", "source"])
    counted, docs = Counter(), Counter()
    full = lambda: b"\xff" * 8
    for out in divergence._occurrences(full)(iter([batch])):
        counted.update({(r["source"], r["term"]): r["n"] for r in out.to_pylist()})
    for out in divergence._prefix_counter(100, 0, None)(iter([batch])):
        docs.update({r["prefix"]: r["docs"] for r in out.to_pylist()})
    words = [t.lower().replace("-", " ").replace("1", "").split() for t in many]
    assert counted == Counter((s, w) for s, found in zip("sttsst", words) for w in found)
    assert docs == Counter(w.encode() for found in words for w in set(found))
    want = Counter(re.findall(r"[A-Za-z\u00C0-\u00FF]+", text.decode()))
    assert {w.decode("latin-1"): n for w, n in variants._runs(text).items()} == want


def test_kept_terms_are_those_of_enough_documents(spark):
    rows = corpus(5)
    frame = framed(spark, rows).selectExpr("coalesce(lang, '') as lang", "coalesce(text, '') as text")
    docs = Counter()
    for text, lang, _ in rows:
        docs.update({(lang or "", plain(w)) for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")})
    for least, first in ((10, 4), (30, 1)):
        want = sorted((k, t, n) for (k, t), n in docs.items() if n >= least)
        assert values(divergence.kept_terms(frame, least, first), "lang", "term", "docs") == sorted(want, key=repr)


def brute_words(rows):
    counts = Counter()
    for i, text in rows:
        for run in re.findall(r"[A-Za-z\u00C0-\u00FF]+", text or ""):
            run = plain(run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def one_edit(x, y):
    if len(x) == len(y):
        return sum(a != b for a, b in zip(x, y)) == 1
    x, y = sorted((x, y), key=len)
    return len(y) == len(x) + 1 and any(y[:i] + y[i + 1 :] == x for i in range(len(y)))


def brute_variants(rows):
    words = brute_words(rows)
    near = {x: [y for y in words if one_edit(x, y)] for x in words}
    form = {}
    for x, found in near.items():
        best = min(found, key=lambda y: (-words[y], y), default=None)
        form[x] = best if best is not None and words[best] >= 5 * words[x] else None
    out = []
    for x in words:
        root = x
        while form[root]:
            root = form[root]
        out.append((x, form[x], root, words[x], len(near[x]), words.get(form[x])))
    return sorted(out, key=repr)


def variant_rows(seed=2):
    """Words that share beginnings, ends and runs of one letter, in a few spellings of very different counts."""
    rng = random.Random(seed)
    stems = ["".join(x) for x in product(["aaa", "aab", "préfix", "zz"], ["o", "oo", "ä", "x÷"], ["ton", "tön", "aaaa", "ation"])]
    rows, words = [], []
    for stem in stems:
        for n in (400, 30, 7, 6):
            w = stem
            for _ in range(rng.randrange(3) if n < 400 else 0):
                at = rng.randrange(len(w))
                w = w[:at] + rng.choice(["", "e", "é", w[at] * 2]) + w[at + rng.randrange(2) :]
            words += [w] * n
    words += ["zettel"] * 400 + ["zetteln"] * 40 + ["zettelns"] * 6
    rng.shuffle(words)
    for i in range(0, len(words), 40):
        rows.append((i, rng.choice([" ", "4", "–", "_"]).join(w.title() if i % 3 else w for w in words[i : i + 40])))
    return rows


@pytest.mark.parametrize("part_words", [8192, 9, 1])
def test_variants_equal_brute_force(spark, part_words):
    """Also where partitions have to be parted again, down to single words."""
    rows = variant_rows()
    want = brute_variants(rows)
    assert len(want) > 100 and sum(r[1] is not None for r in want) > 40 and any(r[1] != r[2] for r in want if r[1])
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    for name in ("word", "n", "side", "part", "v"):
        frame = frame.withColumn(name, frame["text"])
    found = variants.spelling_variants(frame, part_words=part_words)
    assert values(found, "word", "form", "root", "n", "n_near", "form_n") == want


def test_variants_of_odd_tables(spark):
    rows = [(i, t) for i, t, *_ in odd_rows()]
    found = variants.spelling_variants(documents(spark, clash=True))
    assert values(found, "word", "form", "root", "n", "n_near", "form_n") == brute_variants(rows)
    assert CLASHING and variants.spelling_variants(empty(spark)).count() == 0


def test_acceptor_is_minimal_and_exact():
    words = sorted({x for _, t in variant_rows() for x in re.findall(r"[a-z\u00C0-\u00FF]+", t.lower())})
    acceptor = variants.Acceptor(words)

    def language(state):
        out = [""] if acceptor.final[state] else []
        return out + [c + z for c, s in acceptor.arcs[state].items() for z in language(s)]

    assert sorted(language(0)) == words
    reached, todo = set(), [0]
    while todo:
        state = todo.pop()
        if state not in reached:
            reached.add(state)
            todo += acceptor.arcs[state].values()
    rights = [tuple(sorted(language(s))) for s in reached]
    assert len(set(rights)) == len(rights) < sum(map(len, words))


def test_slips_follow_the_checksum():
    hits = [w for w in (f"word{chr(97 + i % 26)}{chr(192 + i // 26)}é" for i in range(600)) if variants.slipped(7, w.encode("latin-1")) != w.encode("latin-1")]
    assert hits
    for w in hits:
        h = zlib.crc32(f"7:{w}".encode())
        assert h % 199 == 0 and variants.slipped(7, w.encode("latin-1")).decode("latin-1") == w[: h % len(w)] + w[h % len(w) + 1 :]
