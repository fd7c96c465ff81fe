"""Registered queries against SQL, and the pipeline stage by stage against brute force."""

from __future__ import annotations

import re
import sys
from collections import defaultdict
from pathlib import Path

import pytest
from corpora import documents, empty, odd_rows, same_schema
from test_dedup import all_shingles, brute_print, union_find
from test_text import brute_containment

ROOT = Path(__file__).resolve().parents[2]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from compare import difference, duck  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
import corpus_pipeline  # noqa: E402
from tripguard.llm import queries  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    assert difference(queries.QUERIES[name](spark, SF), duck(SF), queries.ORACLES[name]) is None


def test_all_are_registered():
    names = {re.match(r"op\d+_", n)[0] for n in queries.QUERIES}
    assert names == {f"op{i}_" for i in range(1, 14)}
    assert {*queries.QUERIES, "pipeline"} <= set(entry.queries())
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "lines", "near_duplicates", "decontamination", "packing"]


def stages_over(spark, docs, sf_dir=SF):
    """Every stage's result, each over what the one before kept."""
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir).checkpoint()
        out.append(docs)
    return out


@pytest.fixture(scope="module")
def results(spark):
    from tripguard.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(spark)
    return stages_over(spark, spark.read.parquet(f"{SF}/documents.parquet"))


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_columns_stay_until_the_last_stage(results):
    assert all(same_schema(results[0], r) for r in results[1:5])


def test_good_documents_stay(spark, results):
    kept = set(texts(results[1]))
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    good = [i for i, q in labels.items() if q == 1]
    bad = [i for i, q in labels.items() if q == 0]
    assert sum(i in kept for i in good) >= 0.97 * len(good)
    assert sum(i in kept for i in bad) <= 0.2 * len(bad)


def plain_line(line):
    return re.sub(r"\s+", " ", line.lower()).strip()


def test_lines_equal_brute_force(results):
    before, after = texts(results[1]), texts(results[2])
    places = [(i, p, plain_line(x)) for i, t in sorted(before.items()) for p, x in enumerate((t or "").split("\n"))]
    distinct = sorted({x for *_, x in places if x})
    sets = {x: all_shingles(x) for x in distinct}
    links = []
    for n, a in enumerate(distinct):
        for b in distinct[:n]:
            small, large = sorted((len(sets[a]), len(sets[b])))
            if small >= 0.8 * large and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                links.append((a, b))
    top = union_find(distinct, links)
    seen, kept = set(), defaultdict(list)
    for i, _, x in places:
        if not x or top[x] not in seen:
            kept[i].append(True)
            seen.add(top.get(x))
        else:
            kept[i].append(False)
    want = {i: "\n".join(x for x, k in zip((t or "").split("\n"), kept[i]) if k) for i, t in before.items()}
    assert len(links) > 5 and {i: t or "" for i, t in after.items()} == want


def test_near_duplicates_equal_brute_force(results):
    before, after = texts(results[2]), texts(results[3])
    prints = {i: brute_print(t) for i, t in before.items()}
    ids = sorted(before)
    links = [(a, b) for n, a in enumerate(ids) for b in ids[:n] if (prints[a] ^ prints[b]).bit_count() <= 3]
    top = union_find(ids, links)
    assert set(after) == {i for i in ids if top[i] == i}


def test_decontamination_equals_brute_force(spark, results):
    before, after = texts(results[3]), texts(results[4])
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    held = {d for d, _ in brute_containment(before.items(), items)}
    assert held and set(after) == set(before) - held


def test_packing_has_every_token(results):
    before, rows = texts(results[4]), results[5].collect()
    sums = defaultdict(int)
    for r in rows:
        sums[r["doc_id"]] += r["n_tokens"]
        assert r["offset"] + r["n_tokens"] <= r["used"] <= r["capacity"]
    assert sums == {i: len((t or "").split()) + 1 for i, t in before.items()}


def test_odd_documents_pass_all_stages(spark):
    docs = documents(spark, clash=True)
    out = stages_over(spark, docs)
    assert all(same_schema(docs, r) for r in out[1:5])
    assert out[1].count() <= len(odd_rows())
    assert [r.count() for r in stages_over(spark, empty(spark))] == [0] * 6
