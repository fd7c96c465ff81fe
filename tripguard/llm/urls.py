"""URL verdicts by rules, and by a tree of path templates learned per host."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from math import log, sqrt

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripguard.llm.common import discard, table, written

ALLOW, BLOCK = "allow", "block"
# Verdict and rule, a host with what a path begins with.
RULES = [(BLOCK, "net/"), (ALLOW, "example.net/en/"), (BLOCK, "example.com/de/"), (ALLOW, "org/fr/")]
# Segments of a path that make levels of the tree; the last takes the rest of a longer path.
DEPTH = 8
# A segment stands for itself if it has that many urls and that part of those of its parent.
LEAST_URLS, LEAST_SHARE = 5, 0.02
# Branches differ if this chance of a mistake is small enough for it.
ALPHA = 0.05
# Urls that the corpus' share of bad ones counts for in each template, and the share that rejects it.
PRIOR_URLS, REJECT = 8, 0.5
WILDCARD = "*"
# What may come behind a segment: the profile by which branches are compared.
KINDS = ["end", "slash", "number", "word", "file", "other"]


def host_of(url: Column) -> Column:
    """From behind the first ``://`` to the next ``/``, ``?`` or ``#``, A-Z in lower case; else empty."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """From behind the host to the next ``?`` or ``#``; else empty."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]], verdicts: bool = False) -> Column:
    """The longest rule that fits, or its verdict; null if none does. Rules are a short list."""
    found = F
    for verdict, rule in sorted(rules, key=lambda r: -len(r[1])):
        own, slash, start = rule.partition("/")
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(slash + start)
        found = found.when(fits, F.lit(verdict if verdicts else rule))
    return F.lit(None).cast("string") if found is F else found


def _segments(path: Column, depth: int) -> Column:
    """What lies between the slashes of a path; the last of ``depth`` takes all that follow."""
    behind = F.regexp_replace(path, "^/", "")
    return F.when(path == "", F.array().cast("array<string>")).otherwise(F.split(behind, "/", depth))


def _kind(level: int) -> Column:
    """What comes behind the segment of a level."""
    after = F.get("segments", F.lit(level))
    return (
        F.when(after.isNull(), "end")
        .when(after == "", "slash")
        .when(after.rlike(r"^[0-9]+$"), "number")
        .when(after.rlike(r"^[A-Za-z_-]+$"), "word")
        .when(after.rlike(r"\.[A-Za-z0-9]{1,5}$"), "file")
        .otherwise("other")
    )


def alike(n: int, of_n: list[int], m: int, of_m: list[int], alpha: float = ALPHA) -> bool:
    """Whether counts out of ``n`` and of ``m`` can be of one distribution, by the Hoeffding bound
    that merges states of a learned automaton (Carrasco and Oncina, 1994)."""
    if not n or not m:
        return True
    bound = sqrt(0.5 * log(2 / alpha)) * (1 / sqrt(n) + 1 / sqrt(m))
    return all(abs(a / n - b / m) < bound for a, b in zip(of_n, of_m))


def merged(children: list[dict], alpha: float = ALPHA) -> list[tuple[str, str]]:
    """(segment, name of its branch) of one parent's literal children.

    The largest child that is in no branch yet leads one; smaller ones that are
    alike in what follows them and in their share of bad urls join it.
    """
    branches: list[list[dict]] = []
    for child in sorted(children, key=lambda c: (-c["n"], c["segment"])):
        for branch in branches:
            first = branch[0]
            if alike(first["n"], first["kinds"], child["n"], child["kinds"], alpha) and alike(
                first["labelled"], [first["bad"]], child["labelled"], [child["bad"]], alpha
            ):
                branch.append(child)
                break
        else:
            branches.append([child])
    out = []
    for branch in branches:
        # A literal wildcard, or a bar, is no sign of the template's own.
        plain = sorted(c["segment"].replace("%", "%25").replace("*", "%2A").replace("|", "%7C") for c in branch)
        name = plain[0] if len(plain) == 1 else "{" + "|".join(plain) + "}"
        out += [(c["segment"], name) for c in branch]
    return out


def _merge_children(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [
            (parent["host"], parent["template"], segment, name)
            for parent in batch.to_pylist()
            for segment, name in merged(parent["children"])
        ]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], pa.string()) for i in range(4)], ["host", "template", "segment", "name"]
        )


def _branches(rows: DataFrame, level: int) -> DataFrame:
    """``(host, template, segment, name)``: segments of a level that are no wildcard, by branch.

    A parent has at most 1 / LEAST_SHARE of them, so its children fit in a row.
    """
    here = rows.filter(F.size("segments") >= level)
    parents = here.groupBy("host", "template").agg(F.count(F.lit(1)).alias("of"))
    children = here.withColumns({"segment": F.get("segments", F.lit(level - 1)), "kind": _kind(level)}).groupBy(
        "host", "template", "segment"
    ).agg(
        F.count(F.lit(1)).alias("n"),
        F.count("bad").alias("labelled"),
        F.count_if("bad").alias("bad"),
        F.array(*[F.count_if(F.col("kind") == k) for k in KINDS]).alias("kinds"),
    )
    often = children.filter(F.col("n") >= LEAST_URLS).join(parents, ["host", "template"])
    often = often.filter(F.col("n") >= LEAST_SHARE * F.col("of"))
    child = F.struct("segment", "n", "labelled", "bad", "kinds")
    together = often.groupBy("host", "template").agg(F.collect_list(child).alias("children"))
    return together.mapInArrow(_merge_children, "host string, template string, segment string, name string")


def with_templates(rows: DataFrame, depth: int = DEPTH) -> DataFrame:
    """Add ``template`` to rows with host, path and bad.

    The tree of a host grows from its root, a level of segments at a time. A
    segment that has few of its parent's urls becomes a wildcard, the others
    branch, and branches that are statistically alike are merged before the
    next level is counted. A level is counts by node, so a host of any size is
    spread over its nodes, and one join that deals a hot node out again.
    """
    kept = rows.columns
    rows = written(rows.withColumns({"segments": _segments(F.col("path"), depth), "template": F.lit("")}), "url-level")
    levels = rows.agg(F.max(F.size("segments"))).first()[0] or 0
    for level in range(1, levels + 1):
        names = written(_branches(rows, level), "url-branches")
        here = rows.withColumn("segment", F.get("segments", F.lit(level - 1)))
        joined = here.join(names, ["host", "template", "segment"], "left")
        step = F.concat("template", F.lit("/"), F.coalesce("name", F.lit(WILDCARD)))
        template = F.when(F.size("segments") >= level, step).otherwise(F.col("template"))
        last, rows = rows, written(joined.select(*kept, "segments", template.alias("template")), "url-level")
        discard(last, names)
    return rows.drop("segments")


def rejected_templates(rows: DataFrame, prior_urls: float = PRIOR_URLS, reject: float = REJECT) -> DataFrame:
    """``(host, template)`` whose labelled urls are bad, by their share smoothed with that of the corpus.

    A template without labels has the corpus' share.
    """
    counts = rows.groupBy("host", "template").agg(F.count("bad").alias("labelled"), F.count_if("bad").alias("bad"))
    counts = written(counts, "url-templates")
    bad, labelled = counts.agg(F.sum("bad"), F.sum("labelled")).first()
    prior = bad / labelled if labelled else 0.0
    purity = (F.col("bad") + F.lit(prior_urls * prior)) / (F.col("labelled") + F.lit(prior_urls))
    return counts.filter(purity >= reject).select("host", "template")


def url_verdicts(
    pages: DataFrame,
    rules: Sequence[tuple[str, str]] = RULES,
    id_col: str = "page_id",
    url_col: str = "url",
    bad_col: str | None = None,
    depth: int = DEPTH,
) -> DataFrame:
    """``(id, host, path, rule, verdict, template)`` of every page's url.

    The longest rule whose host is the url's or above it, and whose path the
    url's begins with, gives the verdict. Without one, urls are blocked whose
    template is rejected: ``bad_col`` tells of some pages, by true or false,
    whether they are bad, and templates with too large a share of bad ones go.
    Without labels nothing is rejected.

    A null url, or one without ``://``, has an empty host and an empty path;
    such urls make one template. A null id stays null, repeated rows count as
    often as they occur, and other columns are ignored. An empty table gives
    an empty one.
    """
    bad = F.lit(None).cast("boolean") if bad_col is None else pages[bad_col].cast("boolean")
    parsed = pages.select(
        pages[id_col].alias("id"), host_of(pages[url_col]).alias("host"), path_of(pages[url_col]).alias("path"), bad.alias("bad")
    )
    rows = with_templates(parsed, depth)
    gone = rejected_templates(rows).withColumn("rejected", F.lit(True))
    host, path = F.col("host"), F.col("path")
    told = F.when(F.col("rejected"), BLOCK).otherwise(ALLOW)
    return rows.join(gone, ["host", "template"], "left").select(
        F.col("id").alias(id_col),
        "host",
        "path",
        rule_of(host, path, rules).alias("rule"),
        F.coalesce(rule_of(host, path, rules, verdicts=True), told).alias("verdict"),
        "template",
    )


def with_document_labels(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """``(page_id, url, bad)``: a url whose path ends in a number shows the document of that id,
    and is bad if the document is of bad quality; without a label it is neither."""
    number = F.regexp_extract(path_of(pages["url"]), r"/([0-9]{1,18})(?:\.[a-z]+|/)?$", 1)
    known = labels.groupBy(F.col("doc_id").alias("doc")).agg((F.min("quality") == 0).alias("bad"))
    numbered = pages.select("page_id", "url", F.when(number != "", number).try_cast("bigint").alias("doc"))
    return numbered.join(known, "doc", "left").select("page_id", "url", "bad")


def op11_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = with_document_labels(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))
    return url_verdicts(labelled, bad_col="bad")
