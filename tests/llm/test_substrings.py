"""Removed words against all windows, and SQL over the small tables."""

import hashlib
import random
import re

import pytest

from compare import check, connect
from siltstone.llm.substrings import OP3_SQL, op3_substring_dedup, remove_repeats


def plain(rows, length):
    first = {}
    texts = [(d, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in rows]
    for doc, words in texts:
        for i in range(len(words) - length + 1):
            if doc is not None:
                key = tuple(words[i : i + length])
                first[key] = min(first.get(key, doc), doc)
    out = []
    for doc, words in texts:
        gone = {p for i in range(len(words) - length + 1) if doc is not None and first[tuple(words[i : i + length])] < doc for p in range(i, i + length)}
        kept = " ".join(w for p, w in enumerate(words) if p not in gone)
        out.append((doc, len(words), len(gone), kept, hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def made(seed, n, length):
    """Copies, near copies, shared passages, periodic texts, passages at the very threshold, mixed white space."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)] + ["é", "ü-x", "A"]
    passages = [[rng.choice(vocabulary) for _ in range(rng.choice([length - 1, length, length + 1, 3 * length]))] for _ in range(6)]
    texts = []
    for _ in range(n):
        kind = rng.randrange(7)
        words = [rng.choice(vocabulary) for _ in range(rng.randint(0, 4 * length))]
        if kind == 1 and texts:
            words = list(rng.choice(texts))
        elif kind == 2 and texts:
            words = list(rng.choice(texts))
            for _ in range(2):
                if words:
                    words[rng.randrange(len(words))] = rng.choice(vocabulary)
        elif kind == 3:
            words = [rng.choice(["a", "b"])] * rng.randint(0, 3 * length)
        elif kind == 4:
            words = ["p", "q", "r"] * rng.randint(0, length)
        elif kind >= 5:
            words[len(words) // 2 : len(words) // 2] = rng.choice(passages)
        texts.append(words)
    ids = list(range(n))
    rng.shuffle(ids)
    rows = [(i, rng.choice([" ", "\n", " \t"]).join(t)) for i, t in zip(ids, texts, strict=True)]
    return rows + [(None, rows[0][1]), (None, None), (n, ""), (n + 1, " \n"), rows[1], (rows[2][0], rows[3][1])]


@pytest.mark.parametrize(("seed", "length", "max_bits"), [(1, 50, 1 << 28), (2, 16, 1 << 28), (3, 20, 1 << 20), (4, 13, 1 << 20)])
def test_made(spark, seed, length, max_bits):
    rows = made(seed, 250, length)
    docs = spark.createDataFrame([(d, t, "x", 1, 2) for d, t in rows], "doc_id long, text string, spans string, first int, row int")
    got = remove_repeats(docs, length, max_bits=max_bits).collect()
    assert sorted(((r.doc_id, r.n_words, sum(s.end - s["first"] for s in r.spans), r.kept, r.kept_sha256) for r in got), key=repr) == plain(rows, length)
    for r in got:
        assert all(a.end < b["first"] for a, b in zip(r.spans, r.spans[1:], strict=False))


def test_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert remove_repeats(none).collect() == []


def test_sql(spark):
    sf_dir = "/root/testdata/sf0.001"
    assert check(spark, connect(sf_dir), op3_substring_dedup, OP3_SQL, sf_dir) == 200
