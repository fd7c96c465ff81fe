"""URL verdicts against a brute-force version over dictionaries."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

from corpora import CLASHING, values

from tripguard.llm import urls

SF = "/root/testdata/sf0.01"


def parse(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), path


def fitting(host, path, rules=urls.RULES):
    best = None
    for verdict, rule in rules:
        own, start = rule.split("/", 1)
        if (host == own or host.endswith("." + own)) and path.startswith("/" + start) and (best is None or len(rule) > len(best[1])):
            best = (verdict, rule)
    return best or (None, None)


def kind(segments, level):
    if len(segments) == level:
        return 0
    after = segments[level]
    for i, pattern in enumerate(("", "[0-9]+", "[A-Za-z_-]+", r"(?s).*\.[A-Za-z0-9]{1,5}"), 1):
        if re.fullmatch(pattern, after):
            return i
    return 5


def close(n, counts, m, others):
    bound = math.sqrt(math.log(2 / 0.05) / 2) * (1 / math.sqrt(n) + 1 / math.sqrt(m)) if n and m else 2
    return not n or not m or all(abs(a / n - b / m) < bound for a, b in zip(counts, others))


def brute_templates(rows, depth=8):
    """rows: (host, path, bad) to templates."""
    split = [(p[1:].split("/", depth - 1) if p else []) for _, p, _ in rows]
    templates = [""] * len(rows)
    for level in range(1, max(map(len, split)) + 1):
        nodes = defaultdict(lambda: defaultdict(list))
        for i, (host, _, _) in enumerate(rows):
            if len(split[i]) >= level:
                nodes[host, templates[i]][split[i][level - 1]].append(i)
        for children in nodes.values():
            total = sum(map(len, children.values()))
            leaders = []
            often = [(s, m) for s, m in children.items() if len(m) >= 5 and len(m) >= 0.02 * total]
            for segment, members in sorted(often, key=lambda c: (-len(c[1]), c[0])):
                kinds = Counter(kind(split[i], level) for i in members)
                kinds = [kinds[k] for k in range(6)]
                told = [rows[i][2] for i in members if rows[i][2] is not None]
                for other in leaders:
                    if close(other[1], other[2], len(members), kinds) and close(other[3], [other[4]], len(told), [sum(told)]):
                        other[0].append(segment)
                        break
                else:
                    leaders.append([[segment], len(members), kinds, len(told), sum(told)])
            names = {}
            for segments, *_ in leaders:
                shown = sorted(s.replace("%", "%25").replace("*", "%2A").replace("|", "%7C") for s in segments)
                names |= dict.fromkeys(segments, shown[0] if len(shown) == 1 else "{" + "|".join(shown) + "}")
            for segment, members in children.items():
                for i in members:
                    templates[i] += "/" + names.get(segment, "*")
    return templates


def brute_verdicts(pages):
    """pages: (id, url, bad)."""
    rows = [(*parse(u), b) for _, u, b in pages]
    templates = brute_templates(rows)
    stats = defaultdict(list)
    for (host, _, bad), t in zip(rows, templates):
        stats[host, t].append(bad)
    told = [b for _, _, b in rows if b is not None]
    prior = sum(told) / len(told) if told else 0.0
    out = []
    for (i, _, _), (host, path, _), t in zip(pages, rows, templates):
        known = [b for b in stats[host, t] if b is not None]
        verdict, rule = fitting(host, path)
        own = "block" if (sum(known) + 8 * prior) / (len(known) + 8) >= 0.5 else "allow"
        out.append((i, host, path, rule, verdict or own, t))
    return sorted(out, key=repr)


def site(seed=1):
    """A host with a bad corner, hot hosts, odd urls, and branches that are alike."""
    rng = random.Random(seed)
    rows = []
    for i in range(900):
        part = rng.choice(["news", "blog", "shop", "pills", "tag"])
        tail = {"news": f"{rng.randrange(9999)}.html", "blog": f"{rng.randrange(9999)}.html", "pills": f"{rng.randrange(9999)}/buy",
                "shop": f"item/{rng.randrange(9999)}", "tag": rng.choice(["a*b", "c|d", "e%f", "plain"])}[part]
        bad = rng.random() < (0.9 if part == "pills" else 0.05) if rng.random() < 0.5 else None
        rows.append((i, f"https://{rng.choice(['', 'M.'])}Hot.example.ORG/{part}/{tail}{rng.choice(['', '?q=/x', '#a/b'])}", bad))
    rows += [(1000 + i, f"http://small{i % 7}.example.com/{rng.choice(['de', 'en'])}/{i}", rng.choice([None, True, False])) for i in range(90)]
    deep = "/".join(str(i % 3) for i in range(5000))
    odd = [None, "", "no scheme", "://", "a://b", "http://x.net", "http://x.net/", "HTTP://NET/a", "http://a.net?b/c", "http://ünï.Example.net/en/x",
           "http://example.net/en/", "http://example.net/en", "http://xexample.net/en/1", "http://a.example.com/de/1/2//", "http://u@v.org:80/fr/1",
           "http://w.org/fr/", "http://w.org/fr", "http://w.org/fr?x", "x\ny://Z.org/a\nb/c", f"http://deep.example.org/{deep}", "a://b://c/d", "http://A.ORG/FR/"]
    rows += [(2000 + i, u, None) for i, u in enumerate(odd)]
    return rows + [(None, "http://w.org/fr/", True), (3, rows[3][1], None), (3, rows[3][1], None)]


def framed(spark, rows):
    frame = spark.createDataFrame(rows, "page_id bigint, url string, wrong boolean")
    for name in [*CLASHING, "host", "path", "bad", "template", "segment", "id", "n"]:
        frame = frame.withColumn(name, frame["url"])
    return frame


OUT = ["page_id", "host", "path", "rule", "verdict", "template"]


def test_verdicts_equal_brute_force(spark):
    rows = site()
    want = brute_verdicts(rows)
    assert values(urls.url_verdicts(framed(spark, rows), bad_col="wrong"), *OUT) == want
    blocked = {t for _, host, _, rule, verdict, t in want if rule is None and verdict == "block"}
    assert blocked == {"/pills/*/buy"}
    hot = {t for _, h, _, _, _, t in want if h == "hot.example.org"}
    assert {"/{blog|news}/*", "/shop/item/*"} <= hot and any("%2A" in t and "%7C" in t for t in hot)


def test_verdicts_of_the_pages(spark):
    pages, labels = (spark.read.parquet(f"{SF}/{n}.parquet") for n in ("pages", "labels"))
    quality = {r["doc_id"]: r["quality"] for r in labels.collect()}
    rows = []
    for r in pages.collect():
        number = re.search(r"/([0-9]+)(?:\.[a-z]+|/)?$", parse(r["url"])[1])
        known = quality.get(int(number[1])) if number else None
        rows.append((r["page_id"], r["url"], None if known is None else known == 0))
    assert sum(b is not None for *_, b in rows) > 50
    assert values(urls.op11_urls(spark, SF), *OUT) == brute_verdicts(rows)


def test_without_labels_only_rules_block(spark):
    rows = site()
    found = urls.url_verdicts(framed(spark, rows))
    assert found.filter("verdict = 'block' and rule is null").isEmpty()
    assert found.count() == len(rows)
    assert urls.url_verdicts(framed(spark, rows), rules=[]).filter("rule is not null or verdict = 'block'").isEmpty()


def test_empty_tables(spark):
    assert urls.url_verdicts(framed(spark, []), bad_col="wrong").count() == 0


def test_rules_win_by_length():
    cases = {
        ("net", "/x"): "net/", ("a.net", ""): None, ("b.example.net", "/en/1"): "example.net/en/", ("b.example.net", "/en"): "net/",
        ("xnet", "/"): None, ("example.com", "/de/"): "example.com/de/", ("anexample.com", "/de/"): None, ("org", "/fr/"): "org/fr/",
    }
    assert {k: fitting(*k)[1] for k in cases} == cases
