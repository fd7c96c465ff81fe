"""Small tables that hold every odd case, and writers of sf folders."""

from __future__ import annotations

import random

from pyspark.sql import types as T

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# Names that the operators use inside, to clash with.
CLASHING = ["d", "t", "s", "f", "kept", "score", "_score", "_gone", "u", "root", "group", "n_tokens", "K", "a b"]


def sentence(rng: random.Random, words: int) -> str:
    vocabulary = "the of and stone river light house under seven walks green paper often quiet market".split()
    return " ".join(rng.choice(vocabulary) + str(rng.randrange(30)) for _ in range(words))


def odd_rows(seed: int = 1) -> list[tuple]:
    """Nulls, empty and blank texts, copies, near copies, ties, repeated rows, a long text."""
    rng = random.Random(seed)
    base = [sentence(rng, n) for n in (3, 40, 60, 60, 90, 200)]
    near = base[4].split()
    near[45] = "CHANGED"
    rows = [
        (1, base[0]), (2, None), (3, ""), (4, " \n\t "), (5, base[1]), (6, base[1]), (6, base[1]),
        (7, base[2] + "\n" + base[3]), (8, base[3] + "\n" + base[2]), (9, base[4]), (10, " ".join(near)),
        (11, base[5] + " " + base[1] + " " + base[5]), (12, sentence(rng, 30_000)), (13, "Ünï cödé – " + base[1].upper()),
        (14, "und " * 500), (15, None), (None, base[1]), (None, None), (16, "x"), (17, "\n".join([base[2]] * 3)),
    ]
    return [(i, t, rng.choice(["en", None]), "src0", None if t is None else len(t)) for i, t in rows]


def documents(spark, rows=None, clash: bool = False):
    frame = spark.createDataFrame(odd_rows() if rows is None else rows, SCHEMA)
    if clash:
        for name in CLASHING:
            frame = frame.withColumn(name, frame["lang"])
    return frame


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def values(frame, *columns):
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=repr)


def same_schema(a, b) -> bool:
    plain = lambda f: [(x.name, x.dataType) for x in f.schema.fields]
    return plain(a) == plain(b)


__all__ = ["CLASHING", "SCHEMA", "T", "documents", "empty", "odd_rows", "same_schema", "sentence", "values"]
