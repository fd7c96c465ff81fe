"""Exact, near, substring and line duplicates against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from corpora import documents, empty, odd_rows, same_schema, sentence, values

from tripguard.llm import components as cc
from tripguard.llm import exact_dedup, lines, simhash, substring


def union_find(nodes, links):
    parent = {n: n for n in nodes}

    def top(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = sorted((top(a), top(b)))
        parent[b] = a
    return {n: top(n) for n in nodes}


def test_components(spark):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)]
    links += [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(120)] + [(7, 7)]
    found = {r["id"]: r["root"] for r in cc.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    want = union_find({n for e in links for n in e}, links)
    lone = {n for n in want if n not in found}
    assert all(found[n] == want[n] for n in found) and all(want[n] == n for n in lone)
    assert cc.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_components_leave_one_table_and_no_shuffles(spark):
    """Each round's table and shuffles go with the next round, or a chain of rounds fills the disk."""
    from pathlib import Path

    from tripguard.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(spark)
    context = spark.sparkContext
    scratch = Path(context.getCheckpointDir().removeprefix("file:"))
    local = Path(context._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()[0])
    shuffles = lambda: {p.name for p in local.rglob("shuffle_*")}
    links = spark.createDataFrame([(i, i + 1) for i in range(300)], "u bigint, v bigint")
    held, files = set(scratch.iterdir()), shuffles()
    found = cc.components(links)
    left = set(scratch.iterdir()) - held
    assert len(left) == 1 and shuffles() <= files
    assert {r["root"] for r in found.collect()} == {0}
    cc.discard(found)
    assert set(scratch.iterdir()) == held


def brute_print(text):
    words = (text or "").encode().lower().split()
    width = min(3, len(words))
    grams = [b" ".join(words[i : i + width]) for i in range(len(words) - width + 1)] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


@pytest.mark.parametrize("posting_rows", [4096, 3])
def test_simhash_equals_brute_force(spark, posting_rows):
    rng = random.Random(5)
    rows = [(i, t) for i, t, *_ in odd_rows()]
    for i in range(60):
        words = sentence(rng, 120).split()
        for copy in range(4):
            words[rng.randrange(120)] = "w"
            rows.append((100 + 10 * i + copy, " ".join(words)))
    prints = [brute_print(t) for _, t in rows]
    links = [(a, b) for a in range(len(rows)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 3]
    top = union_find(range(len(rows)), links)
    least = defaultdict(lambda: None)
    for n, (i, _) in enumerate(rows):
        if i is not None:
            least[top[n]] = i if least[top[n]] is None else min(i, least[top[n]])
    want = sorted(((i, f"{prints[n]:016x}", least[top[n]]) for n, (i, _) in enumerate(rows)), key=repr)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = simhash.simhash_components(docs, posting_rows=posting_rows)
    assert values(got, "doc_id", "fingerprint", "component_id") == want
    assert sum(1 for i, _, c in want if i != c) > 60


def test_planes_cover_all_triples():
    from itertools import combinations

    assert all(sum(set(t) <= set(p) for p in simhash.PLANES) == 1 for t in combinations(range(8), 3))


def test_large_postings_are_exact(spark):
    rng = np.random.default_rng(2)
    base = rng.integers(0, 1 << 32, 30, dtype=np.uint64)
    flips = [np.uint64(sum(1 << int(b) for b in rng.choice(32, rng.integers(0, 4), replace=False))) for _ in range(300)]
    prints = {int((base[i % 30] ^ f).view(np.int64)) for i, f in enumerate(flips)}
    # Four bits apart, two of them the highest: no link.
    high = int(np.uint64(0xA5A5A5A5_00000001).view(np.int64))
    prints = sorted(prints | {-(1 << 63) | 5, 5, high, high ^ 0b11_0000 ^ -(1 << 63) ^ (1 << 62)})
    nodes = spark.createDataFrame([(p,) for p in prints], "f bigint")
    got = cc.components(simhash.simhash_links(nodes, posting_rows=2)).collect()
    near = lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count() <= 3
    links = [(a, b) for i, a in enumerate(prints) for b in prints[:i] if near(a, b)]
    want = union_find(prints, links)
    assert {r["id"]: r["root"] for r in got} == {n: want[n] for e in links for n in e}


def test_near_copies_go_and_columns_stay(spark):
    docs = documents(spark, clash=True)
    kept = simhash.drop_near_copies(docs)
    assert same_schema(kept, docs)
    ids = sorted((r["doc_id"] for r in kept.select("doc_id").collect()), key=repr)
    assert 6 not in ids and 5 in ids and 15 not in ids and 2 in ids and ids.count(None) == 2
    assert simhash.drop_near_copies(empty(spark)).count() == 0
    assert simhash.simhash_components(empty(spark)).count() == 0


def test_exact_dedup_equals_brute_force(spark):
    rows = odd_rows()
    groups = defaultdict(list)
    for i, t, *_ in rows:
        groups[t or ""].append(i)
    want, seen = [], set()
    for i, t, *_ in rows:
        ids = [x for x in groups[t or ""] if x is not None]
        keep = max(ids) if ids else None
        first = i == keep and (t or "") not in seen
        if first:
            seen.add(t or "")
        want.append((i, keep, len(groups[t or ""]), first, hashlib.sha256((t or "").encode()).hexdigest()))
    for clash in (False, True):
        got = exact_dedup.exact_dedup(documents(spark, clash=clash), min_chars=20, max_chars=60)
        assert values(got, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == sorted(want, key=repr)
    assert exact_dedup.exact_dedup(empty(spark)).count() == 0


def test_chunks_join_to_the_text():
    rng = random.Random(1)
    pattern = exact_dedup.chunk_pattern(20, 60).replace(r"\z", r"\Z")
    for text in (sentence(rng, 500), "a" * 1000, "x. " * 99, "\n" * 77, "ab", ""):
        chunks = [m[0] for m in re.finditer(pattern, text)]
        assert "".join(chunks) == text and all(len(c) <= 62 for c in chunks)


def brute_substring(texts, width):
    words = [(t or "").encode().split() for t in texts]
    windows = Counter(tuple(w[i : i + width]) for w in words for i in range(len(w) - width + 1))
    for w in words:
        gone = set()
        for i in range(len(w) - width + 1):
            if windows[tuple(w[i : i + width])] > 1:
                gone |= set(range(i, i + width))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        yield len(w), len(gone), kept.decode()


@pytest.mark.parametrize("width", [35, 12, 5, 2])
def test_substring_equals_brute_force(spark, width):
    rng = random.Random(width)
    shared = sentence(rng, width + 3)
    rows = [(i, t) for i, t, *_ in odd_rows() if i != 12]
    rows += [(200 + i, f"{sentence(rng, 9)} {shared} {sentence(rng, i)}") for i in range(25)]
    rows += [(300, " ".join(shared.split()[:-4])), (301, " ".join(shared.split()[2:]))]
    rows += [(400 + i, sentence(rng, 50)) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = sorted(((i, *x) for (i, _), x in zip(rows, brute_substring([t for _, t in rows], width))), key=repr)
    assert values(substring.substring_dedup(docs, width=width), "doc_id", "n_words", "n_removed", "kept") == want


def test_covers_have_every_difference():
    for period, cover in substring.COVERS.items():
        assert {(a - b) % period for a in cover for b in cover} == set(range(period))


def test_substring_odd_tables(spark):
    assert substring.substring_dedup(empty(spark)).count() == 0
    assert substring.substring_dedup(documents(spark, clash=True)).count() == len(odd_rows())


def all_shingles(line, chars=8):
    return {line[i : i + chars] for i in range(max(1, len(line) - chars + 1))}


def test_line_classes_find_near_lines(spark):
    rng = random.Random(8)
    rows, want = [], []
    for i in range(80):
        words = sentence(rng, 40).split()
        rows.append((i, " ".join(words)))
        if i % 2:
            words[rng.randrange(40)] = "other"
            rows.append((1000 + i, "  ".join(words).upper()))
            a, b = rows[-2][1], " ".join(words)
            if len(all_shingles(a) & all_shingles(b.lower())) >= 0.8 * len(all_shingles(a) | all_shingles(b.lower())):
                want.append(1000 + i)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = lines.dedup_lines(docs)
    gone = sorted(r["doc_id"] for r in kept.filter("text = ''").collect())
    assert gone == want and len(want) > 30


def test_lines_of_one_template_find_their_mates(spark):
    """Thousands of lines share most shingles; each has one near copy, and is like no other."""
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(7))
    template = [word() for _ in range(20)]
    rows = []
    for i in range(1500):
        own = template + [word() for _ in range(4)]
        rows += [(2 * i, " ".join(own)), (2 * i + 1, " ".join(own) + "s")]
    kept = lines.dedup_lines(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert sorted(r["doc_id"] for r in kept.filter("text != ''").collect()) == list(range(0, 3000, 2))


def test_scripts_without_spaces_are_shingled_by_character(spark):
    text = "".join(chr(0x4E00 + 7 * i) for i in range(120))
    rows = [(1, text), (2, text[:20] + "一" + text[20:]), (3, text[:-1]), (4, text[::-1]), (5, text[:60] + text[::-1])]
    rows += [(6, "https://a.example/" + "x" * 60), (7, "https://a.example/" + "x" * 59 + "y")]
    kept = lines.dedup_lines(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert {r["doc_id"] for r in kept.collect() if r["text"]} == {1, 4, 5, 6}


def test_line_classes_equal_brute_force_over_all_characters(spark):
    """Short lines, lines without spaces, changed digits: shingles start at every character."""
    rng = random.Random(21)
    texts = ["x", "short", "https://b.example/" + "path/" * 9 + "index.html", "https://b.example/" + "path/" * 9 + "index.htm"]
    for i in range(60):
        words = sentence(rng, rng.choice((9, 17, 30))).split()
        texts += [" ".join([*words, "2023"]), " ".join([*words, "2024"])]
        code = "".join(rng.choice("0123456789abcdef/{}") for _ in range(90))
        texts += [code, code[:40] + "#" + code[41:], code[:20] + "#" + code[21:50] + "#" + code[51:]]
    sets = [all_shingles(t) for t in texts]
    near = lambda a, b: len(a & b) >= 0.8 * len(a | b)
    links = [(i, j) for i in range(len(texts)) for j in range(i) if near(sets[i], sets[j])]
    top = union_find(range(len(texts)), links)
    kept = lines.dedup_lines(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"))
    assert sorted(r["doc_id"] for r in kept.filter("text != ''").collect()) == sorted(set(top.values()))
    assert len(links) > 100


def test_line_dedup_odd_tables(spark):
    docs = documents(spark, clash=True)
    kept = lines.dedup_lines(docs)
    assert same_schema(kept, docs)
    texts = defaultdict(list)
    for r in kept.select("doc_id", "text").collect():
        texts[r["doc_id"]].append(r["text"])
    source = {i: t for i, t, *_ in odd_rows()}
    assert texts[2] == [None] and texts[3] == [""] and texts[4] == [" \n\t "]
    assert texts[5] == [source[5]] and texts[6] == ["", ""] and texts[8] == [""] and texts[17] == [""]
    assert texts[7] == [source[7]] and texts[12] == [source[12]] and texts[14] == [source[14]]
    assert sorted(texts[None], key=repr) == ["", None]
    assert lines.dedup_lines(empty(spark)).count() == 0
