"""SimHash against a plain computation, links against all pairs."""

import random
import re

import numpy as np
import pytest
import xxhash

from siltstone.llm import simhash
from siltstone.llm.components import components


def plain_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(values, most=3):
    parent = {v: v for v in values}

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v

    distinct = sorted(set(values))
    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if (a ^ b).bit_count() <= most:
                parent[root(a)] = root(b)
    return {v: root(v) for v in distinct}


TEXTS = [None, "", " \t\n", "one", "One two", "one TWO three", "one two  three\nfour", "é ü ÀB cd", "x " * 4000, "one two three four", "ONE two three four", "a\x1cb c d e"]


def by_hand(rows):
    prints = [(doc, plain_print(text)) for doc, text in rows]
    roots = plain_components([p for _, p in prints])
    first = {}
    for doc, p in prints:
        if doc is not None:
            first[roots[p]] = min(first.get(roots[p], doc), doc)
    return sorted(((doc, f"{p:016x}", first.get(roots[p])) for doc, p in prints), key=repr)


def test_small(spark, rows):
    data = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "one two three"), (None, "lonely words here"), (4, "One two")]
    docs = spark.createDataFrame([(d, t, "x", 1) for d, t in data], "doc_id long, text string, fingerprint string, root int")
    assert rows(simhash.near_duplicates(docs)) == by_hand(data)


def test_near_copies(spark, rows):
    rng = random.Random(3)
    vocabulary = ["w%d" % i for i in range(500)]
    data = []
    for i in range(120):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(3, 300))]
        for _ in range(rng.randint(1, 4)):
            copy = list(base)
            for _ in range(rng.randint(0, 2)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            data.append((len(data), " ".join(copy)))
    got = rows(simhash.near_duplicates(spark.createDataFrame(data, "doc_id long, text string")))
    assert got == by_hand(data)
    assert len({r[2] for r in got}) < len(got)


@pytest.mark.parametrize("most", [0, 1, 3])
@pytest.mark.parametrize("compared", [4096, 8])
def test_links(spark, monkeypatch, most, compared):
    """Dense groups around a centre; with the low limit, large lists are looked up by flipped bits."""
    monkeypatch.setattr(simhash, "COMPARED", compared)
    rng = random.Random(most)
    values = set()
    for _ in range(6):
        centre = rng.getrandbits(64)
        for _ in range(60):
            v = centre
            for _ in range(rng.randint(0, 5)):
                v ^= 1 << rng.choice([*range(20), rng.randrange(64)])
            values.add(v)
    signed = np.array(sorted(values), np.uint64).view(np.int64)
    edges = simhash.links(spark.createDataFrame([(int(v),) for v in signed], "fingerprint long"), most)
    found = [(a % (1 << 64), b % (1 << 64)) for a, b in edges.collect()]
    assert all((a ^ b).bit_count() <= most and a != b for a, b in found)
    parent = {v: v for v in values}

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for a, b in found:
        parent[root(a)] = root(b)
    want = plain_components(values, most)
    assert len({root(v) for v in values}) == len(set(want.values()))
    assert all(root(v) == root(want[v]) for v in values)


def test_forest_looked_up():
    rng = random.Random(9)
    members = np.unique(np.array([rng.getrandbits(24) | 7 << 40 for _ in range(300)] + [b ^ 1 << rng.randrange(24) for b in [5 | 7 << 40] * 30], np.uint64))
    free = list(range(24))
    few = list(simhash._forest(members, free, 5, 3))
    simhash.COMPARED, old = 8, simhash.COMPARED
    try:
        many = list(simhash._forest(members, free, 5, 3))
    finally:
        simhash.COMPARED = old
    assert sum(len(b) for _, b in few) == sum(len(b) for _, b in many) > 0


def test_components(spark):
    chain = [(i, i + 1) for i in range(100)]
    edges = chain + [(200, 201), (201, 200), (300, 300), (None, 1), (-5, 400), (400, 7_000)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 101)} | {201: 200, 400: -5, 7_000: -5}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_empty_and_stage(spark, rows):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert rows(simhash.near_duplicates(empty)) == []
    docs = spark.createDataFrame([(1, "a b c d", "s"), (2, "a b c d", "s"), (1, "a b c d", "s"), (3, "other words of this", "s"), (None, "none at all", "t")], "doc_id long, text string, source string")
    assert [r[0] for r in rows(simhash.keep_first(docs))] == [1, 3, None]
    assert simhash.keep_first(docs).columns == docs.columns


def test_keep_first_by_row(spark):
    """Null and repeated ids: one row of each group of texts stays, whatever its id."""
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(60)) for x in "pqrs")
    data = [(None, a), (None, b), (None, b), (1, c), (None, c), (2, c), (2, d), (3, d), (5, a + " "), (7, b), (7, " ".join(f"t{i}" for i in range(60)))]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    got = sorted((r.doc_id, r.text[0]) for r in simhash.keep_first(docs).collect())
    assert got == [(1, "r"), (2, "s"), (5, "p"), (7, "q"), (7, "t")]
    got = sorted(r.text[0] for r in simhash.keep_first(docs.where("doc_id is null")).collect())
    assert got == ["p", "q", "r"]
