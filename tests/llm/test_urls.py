"""URL verdicts: parts and written rules against plain code, mined rules against a count of all combinations."""

import random
from collections import Counter
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from compare import check, connect
from siltstone.llm import urls
from siltstone.llm.urls import GROWN_ITEMS, OP12_SQL, RULES, Mining, Rule, matched, mine, op12_url_filters, url_parts, url_tokens, url_verdicts, written_rule

ODD = [
    (None, "", ""), ("", "", ""), ("example.org/es/", "", ""), ("://", "", ""), ("http://", "", ""), ("HTTP://A.Example.ORG", "a.example.org", ""),
    ("https://example.org?x=/es/", "example.org", ""), ("https://example.org#/es/", "example.org", ""), ("https://example.org/es/?a#b", "example.org", "/es/"),
    ("a://b://c/d", "b:", "//c/d"), ("https://É.example.org/En/1é", "É.example.org", "/En/1é"), ("https://user@x.org:80/\n/a", "user@x.org:80", "/\n/a"),
]


def plain_rule(host, path, rules):
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: (len(r.host) + len(r.path), len(r.host)), default=None)


def test_parts(spark):
    scheme, host, path, tail = url_parts(F.col("url"))
    found = spark.createDataFrame([(u,) for u, _, _ in ODD], "url string").select("url", host.alias("h"), path.alias("p"), tail.alias("t"), url_tokens(scheme, host, path, tail).alias("tokens")).collect()
    assert [(r.url, r.h, r.p) for r in found] == ODD
    assert [r.t for r in found][6:9] == ["?x=/es/", "#/es/", "?a#b"]
    assert found[0].tokens == [] and found[2].tokens == []
    assert sorted(found[8].tokens) == ["h:example", "h:org", "p:es", "q:a", "q:b", "s:https"]
    assert sorted(found[10].tokens) == ["h:example", "h:org", "h:É", "p:1é", "p:en", "s:https"]


def test_written(spark):
    rules = (*RULES, Rule("b.example.org", "/es/a", "allow"), Rule("org", "/es/aaaaaaaaaaaaaaa", "allow"), Rule("net", "", "block"))
    rng = random.Random(1)
    cases = [(rng.choice(["org", "example.org", "a.b.example.org", "notexample.org", "x.com", "com", "x.net", "net.x", ""]), rng.choice(["", "/", "/es/", "/es/aaaaaaaaaaaaaaab", "/en/12", "/fr/1", "/de/", "/fr"])) for _ in range(300)]
    found = spark.createDataFrame(cases, "h string, p string").select("h", "p", written_rule(F.col("h"), F.col("p"), rules).alias("r")).collect()
    for r in found:
        want = plain_rule(r.h, r.p, rules)
        assert (r.r.rule, r.r.verdict) == (want.host + want.path, want.verdict) if want else r.r is None


def plain_mine(labelled, m):
    labelled = [(set(t), v) for t, v in labelled if v in ("allow", "block")]
    least = max(m.least_rows, -(-len(labelled) * m.percent // 100))
    sizes = Counter(v for _, v in labelled)
    n, blocked = Counter(t for ts, _ in labelled for t in ts), Counter(t for ts, v in labelled for t in ts if v == "block")
    differs = {t: abs(blocked[t] / max(sizes["block"], 1) - (n[t] - blocked[t]) / max(sizes["allow"], 1)) for t in n if n[t] >= least}
    every, held = Counter(), Counter()
    for ts, v in labelled:
        items = sorted(sorted((t for t in ts if t in differs), key=lambda t: (-differs[t], t))[: m.most_items])
        for k in range(1, m.longest + 1):
            for c in combinations(items, k):
                every[c] += 1
                held[c, v] += 1
    sure = {(c, v): (h / every[c], h) for (c, v), h in held.items() if h >= least and h / every[c] >= m.least_confidence}
    kept = {(c, v): x for (c, v), x in sure.items() if not any(sure.get((tuple(t for t in c if t != out), v), (-1,))[0] >= x[0] for out in c)}
    order = sorted(kept, key=lambda r: (-kept[r][0], -kept[r][1], len(r[0]), " ".join(r[0])))
    return [(list(c), min(c, key=lambda t: (n[t], t)), v, kept[c, v][1], kept[c, v][0], place) for place, (c, v) in enumerate(order, 1)]


@pytest.mark.parametrize("mining", [Mining(), Mining(least_rows=2, percent=3, least_confidence=0.6, most_items=4, longest=2)])
def test_mined(spark, mining):
    rng = random.Random(6)
    labelled = []
    for _ in range(250):
        tokens = sorted(set(rng.choices([f"t{i}" for i in range(15)], k=rng.randint(0, 9))))
        bad = "t1" in tokens and "t2" in tokens or "t3" in tokens and rng.random() < 0.9
        labelled.append((tokens, "block" if bad else rng.choice(["allow", "allow", None, "other"])))
    rules = mine(spark.createDataFrame(labelled, "tokens array<string>, label string"), mining)
    want = plain_mine(labelled, mining)
    assert [tuple(r) for r in rules.orderBy("place").collect()] == want
    urls = [(i, sorted(set(rng.choices([f"t{i}" for i in range(15)], k=rng.randint(0, 9))))) for i in range(100)]
    found = {r.row: r.place for r in matched(spark.createDataFrame(urls, "row long, tokens array<string>"), rules).collect()}
    for row, tokens in urls:
        assert found.get(row) == next((place for needed, _, _, _, _, place in want if set(needed) <= set(tokens)), None)


@pytest.mark.parametrize("mining", [Mining(), Mining(least_rows=3, percent=2, least_confidence=0.7, longest=2)])
def test_mined_of_urls_with_many_frequent_tokens(spark, mining):
    """What tells a URL's label may be any of its tokens, however many are frequent."""
    rng = random.Random(8)
    labelled = []
    for _ in range(120):
        tokens = sorted(set(rng.choices([f"t{i:02d}" for i in range(24)], k=rng.randint(0, 22))))
        bad = {"t01", "t02", "t03"} <= set(tokens) or "t04" in tokens and rng.random() < 0.8
        labelled.append((tokens, "block" if bad else rng.choice(["allow", "allow", None])))
    assert max(len(t) for t, _ in labelled) > GROWN_ITEMS
    rules = mine(spark.createDataFrame(labelled, "tokens array<string>, label string"), mining)
    want = plain_mine(labelled, mining)
    assert [tuple(r) for r in rules.orderBy("place").collect()] == want and len(want) > 20


def test_counting_tells_what_fp_growth_does(spark, monkeypatch):
    rng = random.Random(9)
    labelled = spark.createDataFrame([(sorted(set(rng.choices("abcdefgh", k=rng.randint(0, 8)))), rng.choice(["allow", "block", "block"])) for _ in range(150)], "tokens array<string>, label string")
    loose = Mining(least_confidence=0.6)
    grown = [tuple(r) for r in mine(labelled, loose).orderBy("place").collect()]
    monkeypatch.setattr(urls, "GROWN_ITEMS", 0)
    assert [tuple(r) for r in mine(labelled, loose).orderBy("place").collect()] == grown and grown


PAGES = "page_id long, url string, host string, row string, tokens int, mined int"


def test_whole(spark):
    odd = [(i, u, "x", "y", 1, 2) for i, (u, _, _) in enumerate(ODD)] + [(None, "https://x.com/de/1", "", "", 1, 1), (3, "https://x.com/de/1", "", "", 1, 1), (3, "https://x.com/de/1", "", "", 1, 1)]
    found = url_verdicts(spark.createDataFrame(odd, PAGES))
    assert found.columns == ["page_id", "host", "path", "rule", "mined", "verdict"] and found.count() == len(odd)
    assert {tuple(r)[3:] for r in found.where("host = 'x.com'").collect()} == {("com/de/", None, "block")}
    assert found.where("host = ''").select("rule", "verdict").distinct().collect() == [(None, "allow")]
    assert url_verdicts(spark.createDataFrame([], PAGES)).collect() == []
    # given labels are learnt from instead
    labelled = spark.createDataFrame([(f"https://{'bad' if i % 2 else 'good'}{i}.net/{'pills' if i % 2 else 'news'}/{i}", "block" if i % 2 else "allow", 1) for i in range(40)], "url string, label string, row int")
    pages = spark.createDataFrame([(1, "https://z.net/pills/x"), (2, "https://z.net/news/y"), (3, "https://z.com/de/news"), (4, "ftp://unknown/")], "page_id long, url string")
    got = {r.page_id: (r.rule, r.mined, r.verdict) for r in url_verdicts(pages, labelled=labelled).collect()}
    assert got == {1: (None, "p:pills", "block"), 2: (None, "p:news", "allow"), 3: ("com/de/", None, "block"), 4: (None, None, "allow")}


def test_held_out(spark):
    """Mined rules tell what the written ones say of URLs that they were not mined from."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    scheme, host, path, tail = url_parts(F.col("url"))
    rows = pages.select("page_id", url_tokens(scheme, host, path, tail).alias("tokens"), written_rule(host, path, RULES)["verdict"].alias("label")).where("label is not null")
    held = F.crc32(F.col("page_id").cast("string").cast("binary")) % 5 == 0
    rules = mine(rows.where(~held))
    told = rows.where(held).withColumnRenamed("page_id", "row").join(matched(rows.where(held).withColumnRenamed("page_id", "row"), rules), "row", "left").join(rules.select("place", "verdict"), "place", "left")
    right, n = told.select(F.avg((F.coalesce("verdict", F.lit("allow")) == F.col("label")).cast("int")), F.count("*")).first()
    assert n > 150 and right >= 0.97, (right, n)


def test_sql(spark):
    sf_dir = "/root/testdata/sf0.01"
    assert check(spark, connect(sf_dir), op12_url_filters, OP12_SQL, sf_dir) == 250
