"""Contamination against a plain search, and its SQL over the small tables."""

import random
import re

import pytest
from pyspark.sql import functions as F

from compare import check, connect
from siltstone.llm.decontaminate import OP10_SQL, clean, contamination, op10_benchmark_decontamination

LOWER = {c: c + 32 for c in range(65, 91)}


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def plain(docs, items):
    out = []
    for doc, text in docs:
        words = words_of(text)
        hit, found = set(), set()
        for item, content in items:
            parts = words_of(content)
            size = min(13, len(parts))
            windows = {tuple(parts[i : i + size]) for i in range(len(parts) - size + 1)} if parts else set()
            for i in range(len(words) - size + 1):
                if windows and tuple(words[i : i + size]) in windows:
                    hit.update(range(i, i + size))
                    found.add(item)
        out.append((doc, len(words), len(hit), sorted(str(i) for i in found if i is not None), bool(hit) and 20 * len(hit) >= len(words)))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def data():
    rng = random.Random(5)
    vocabulary = ["ab", "cd", "É", "x1", "Q", "the"]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 40)))) for i in range(12)]
    items += [(12, None), (13, "..."), (14, "Short item"), (None, "nameless words of an item"), (3, items[3][1]), (15, items[4][1])]
    docs = [(0, None), (1, ""), (2, "short, ITEM! short-item"), (3, "nameless words: of an item"), (None, "short item"), (2, "short, ITEM! short-item")]
    for i in range(60):
        filler = [rng.choice([*vocabulary, "other", "words"]) for _ in range(rng.randint(0, 400))]
        if i % 2:
            part = words_of(rng.choice(items[:12])[1])
            filler[5:5] = part[rng.randint(0, 3) :]
        docs.append((10 + i, rng.choice([" ", ", ", "\n"]).join(filler)))
    return docs, items


@pytest.mark.parametrize("max_windows", [100_000, 20])
def test_small(spark, data, max_windows):
    docs, items = data
    frame = spark.createDataFrame([(d, t, "x", 1) for d, t in docs], "doc_id long, text string, contamination string, found int")
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int")
    got = contamination(frame, bench, max_windows=max_windows).collect()
    assert sorted(((r.doc_id, r.contamination.n_words, r.contamination.n_hit, r.contamination["items"], r.contamination.contaminated) for r in got), key=repr) == plain(docs, items)
    for r in got:
        inside = [w for a, b in r.contamination.spans for w in words_of(r.text[a:b])]
        assert len(inside) == r.contamination.n_hit
    kept = clean(frame, bench)
    assert kept.columns == frame.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == [d for d, _, _, _, bad in plain(docs, items) if not bad]


def test_blocks(spark, data, monkeypatch):
    """With several blocks the driver has one at a time, and texts are written once."""
    from siltstone.llm import decontaminate

    docs, items = data
    frame, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    windows = sum(max(len(words_of(t)) - 12, 1) for _, t in set(items) if words_of(t))
    staged, sizes, plain_stage, plain_automaton = [], [], decontaminate.stage, decontaminate.Automaton
    monkeypatch.setattr(decontaminate, "stage", lambda df, label: staged.append((label, df.columns)) or plain_stage(df, label))
    blocks = decontaminate._blocks(bench, "item_id", "text", 13, windows // 3 + 1)
    for n in blocks.groupBy("block").count().collect():
        rows = [(r["item"], r["text"]) for r in blocks.where(F.col("block") == n.block).collect()]
        sizes.append(sum(max(len(words_of(t)) - 12, 1) for _, t in rows))
    assert len(sizes) >= 3 and max(sizes) <= windows // 3 + 1
    staged.clear()
    got = contamination(frame, bench, max_windows=windows // 3 + 1).collect()
    assert sorted(((r.doc_id, r.contamination.n_words, r.contamination.n_hit, r.contamination["items"], r.contamination.contaminated) for r in got), key=repr) == plain(docs, items)
    assert [label for label, columns in staged if "scanned" in columns] == ["keyed"]


def test_long_text(spark):
    item = " ".join(f"w{i}" for i in range(13))
    docs = [(1, "filler words " * 400_000 + item), (2, item.upper())]
    got = {r.doc_id: r.contamination for r in contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(7, item)], "item_id long, text string"), carry=["doc_id"]).collect()}
    assert (got[1].n_words, got[1].n_hit, got[1].contaminated) == (800_013, 13, False) and got[2].contaminated
    assert [tuple(s) for s in got[1].spans] == [(5_200_000, 5_200_000 + len(item))]


def test_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "some words")], "doc_id long, text string")
    assert contamination(none, items).collect() == []
    assert [tuple(r.contamination) for r in contamination(some, items).collect()] == [(2, 0, [], [], False)]


def test_sql(spark):
    sf_dir = "/root/testdata/sf0.001"
    assert check(spark, connect(sf_dir), op10_benchmark_decontamination, OP10_SQL, sf_dir) == 200
