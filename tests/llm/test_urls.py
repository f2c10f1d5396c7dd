"""URL filter against plain Python: parts, rules, segmentation, model."""

import itertools
import math
import random
import re
from collections import Counter

import pytest

from canvass.llm import queries
from canvass.llm.urls import TAGS, WORD, Rule, judge_urls, segmented, viterbi

SCHEMA = "page_id long, url string, html string, verdict string, host int"


def parts(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def rule_of(host, path, rules):
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.host + r.path), default=None)


def tokens(host, path, cut):
    out = []
    for kind, text in (("h:", host), ("p:", path)):
        for t in re.findall(r"[^\W\d_]+|\d+", text.lower()):
            out += [kind + w for w in ([f"#{len(t)}"] if t[0].isdigit() else cut(t))]
    return out


def plain(rows, rules):
    counts = Counter(w for _, _, html, *_ in rows for w in WORD.findall(TAGS.sub(" ", html or "").lower()))
    total = sum(counts.values())

    lengths = sorted({len(w) for w in counts})

    def cut(name):
        spans = {(i, n): counts[name[i : i + n]] for i in range(len(name)) for n in lengths
                 if i + n <= len(name) and name[i : i + n] in counts}
        return viterbi(name, spans, total)

    seen, classes = {"allow": Counter(), "block": Counter()}, Counter()
    for _, url, *_ in rows:
        rule = rule_of(*parts(url), rules)
        if rule:
            classes[rule.verdict] += 1
            seen[rule.verdict].update(tokens(*parts(url), cut))
    kinds = len(set(seen["allow"]) | set(seen["block"]))
    known = set(seen["allow"]) | set(seen["block"])

    def chance(verdict, t):
        return math.log((seen[verdict][t] + 1) / (sum(seen[verdict].values()) + kinds))

    out = []
    for page_id, url, *_ in rows:
        host, path = parts(url)
        rule = rule_of(host, path, rules)
        score = math.log((classes["allow"] + 1) / (classes["block"] + 1))
        score += sum(chance("allow", t) - chance("block", t) for t in tokens(host, path, cut) if t in known)
        verdict = rule.verdict if rule else "allow" if round(score, 9) >= 0 else "block"
        out.append((page_id, host, path, rule and rule.host + rule.path, verdict, score))
    return out


def same(got, want):
    key = lambda r: tuple((v is None, v) for v in r[:5])
    got = sorted(((r.page_id, r.host, r.path, r.rule, r.verdict, r.score) for r in got), key=key)
    want = sorted(want, key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert all(math.isclose(a[5], b[5], abs_tol=1e-6) for a, b in zip(got, want))


ODD = [
    (1, None, "<p>the cat sat</p>", "x", 1), (2, "", None, None, None), (3, "no scheme/path", "", "x", 1), (4, "http://", "x", "x", 1),
    (5, "http://EXAMPLE.org", "x", "x", 1), (6, "http://example.org/es/x?u=http://a.com/de/", "x", "x", 1),
    (7, "http://notexample.org/es/", "the cat", "x", 1), (8, "http://a.example.org/en/19#f", "x", "x", 1), (None, "ftp://a.com/de/?x", "x", "x", 1),
    (9, "http://a.com/de", "x", "x", 1), (9, "http://a.com/de", "x", "x", 1), (10, "http://É.net:80?q=/", "x", "x", 1),
    (11, "http://" + "thecat" * 3000 + ".net/" + "x/" * 3000, "the " * 50_000, "x", 1), (12, "http://cat-the.net/blockedword/1", "x", "x", 1),
    (13, "http://org/a", "x", "x", 1), (14, "://x.com/fr/://y", "x", "x", 1),
]


def test_odd_rows(spark):
    out = judge_urls(spark.createDataFrame(ODD, SCHEMA), queries.URL_RULES)
    assert out.columns == ["page_id", "url", "html", "host", "path", "rule", "verdict", "score"]
    same(out.collect(), plain(ODD, queries.URL_RULES))


@pytest.mark.parametrize("rules", [[], [Rule("block", "x.com", "/")]])
def test_few_rules(spark, rules):
    same(judge_urls(spark.createDataFrame(ODD, SCHEMA), rules).collect(), plain(ODD, rules))


def test_empty(spark):
    assert judge_urls(spark.createDataFrame([], SCHEMA), queries.URL_RULES).count() == 0


def cuts(name):
    for bits in itertools.product([0, 1], repeat=len(name) - 1):
        at = [0, *[i + 1 for i, b in enumerate(bits) if b], len(name)]
        yield [name[a:b] for a, b in zip(at, at[1:])]


def test_viterbi_is_best(spark):
    draw = random.Random(4)
    counts = {"a": 9, "ab": 5, "ba": 4, "bab": 2, "c": 3, "abc": 1, "cab": 6, "bc": 2}
    total = sum(counts.values())

    def chance(words):
        return sum(math.log(counts[w] / total) if w in counts else math.log(10 / total) - len(w) * math.log(10) for w in words)

    found = ["".join(draw.choice("abcx") for _ in range(draw.randrange(1, 10))) for _ in range(60)]
    table = spark.createDataFrame([(w, n) for w, n in counts.items()], "word string, n long")
    got = {r.name: r.words for r in segmented(spark.createDataFrame([(n,) for n in set(found)], "name string"), table).collect()}
    for name in found:
        assert "".join(got[name]) == name
        assert math.isclose(chance(got[name]), max(map(chance, cuts(name))))


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{sf}/pages.parquet").collect()]
    got = queries.op1_url_filter(spark, sf).collect()
    same(got, plain(rows, queries.URL_RULES))
    assert {r.rule for r in got} >= {None, "org/", "example.org/es/"}


def test_long_words_are_words(spark):
    long = "donaudampfschifffahrtsgesellschaft"
    rows = [(1, f"http://{long}verein.org/", f"{long} verein " * 50)]
    counts = spark.createDataFrame([(long, 50), ("verein", 50)], "word string, n long")
    names = spark.createDataFrame([(f"{long}verein",), ("q" * 60,), ("",)], "name string")
    got = {r.name: r.words for r in segmented(names, counts).collect()}
    assert got == {f"{long}verein": [long, "verein"], "q" * 60: ["q" * 60], "": []}
    judged = judge_urls(spark.createDataFrame([(*r, None, None) for r in rows], SCHEMA), [Rule("allow", "org", "/")]).collect()
    assert len(judged) == 1 and judged[0].host == f"{long}verein.org"
