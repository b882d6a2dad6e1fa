"""Statistics and trees against plain computations; held-out accuracy."""

import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltstone.llm.quality import STATISTICS, Trees, accepted, fit, op9_quality_classifier, scored, statistics, train


def measured(texts):
    parts = [t.encode() for t in texts]
    return statistics(np.frombuffer(b"".join(parts), np.uint8), np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64))


TEXTS = ["", " \n ", "one", "A bb CCC!! d? x|y", "same line\nsame line\nother line here", "é ü ABC 123 %%% a%%%", "w " * 3000]


def test_statistics():
    got = measured(TEXTS)
    assert got.shape == (len(TEXTS), len(STATISTICS)) and np.isfinite(got).all()
    at = {name: i for i, name in enumerate(STATISTICS)}
    for text, row in zip(TEXTS, got, strict=True):
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        lines = [x for x in text.split("\n") if x]
        n = max(len(words), 1)
        assert row[at["log_words"]] == pytest.approx(np.log1p(len(words)))
        assert row[at["word_bytes"]] == pytest.approx(sum(len(w.encode()) for w in words) / n)
        assert row[at["distinct_words"]] == pytest.approx(len(set(words)) / n)
        assert row[at["top_word"]] == pytest.approx(max((words.count(w) for w in words), default=0) / n)
        assert row[at["repeated_lines"]] == pytest.approx(1 - len(set(lines)) / max(len(lines), 1))
        assert row[at["digits"]] == pytest.approx(len(re.findall("[0-9]", text)) / max(len(text.encode()), 1))


def test_batches_do_not_matter():
    assert np.array_equal(measured(TEXTS), np.vstack([measured([t]) for t in TEXTS]))


def test_trees():
    rng = np.random.default_rng(1)
    values = rng.normal(size=(3000, 4))
    labels = ((values[:, 0] > 0.3) ^ (values[:, 2] < -0.2)).astype(float)
    model = train(values[:2000], labels[:2000], trees=40, depth=3)
    assert ((model.score(values[2000:]) >= 0.5) == labels[2000:]).mean() > 0.97

    def walk(row):
        total = model.base
        for feature, threshold, leaf in zip(model.feature, model.threshold, model.leaf, strict=True):
            node = 0
            while node < len(feature):
                node = 2 * node + 1 + int(row[feature[node]] > threshold[node])
            total += leaf[node - len(feature)]
        return total

    assert np.allclose(model.raw(values[:50]), [walk(r) for r in values[:50]])
    assert train(values[:0], labels[:0]).score(values[:2]).tolist() == [0.5, 0.5]
    one_class = train(values[:8], np.ones(8))
    assert isinstance(one_class, Trees) and one_class.score(values[:1]) == pytest.approx(0.9)


def test_held_out(spark):
    sf_dir = "/root/testdata/sf0.01"
    got = op9_quality_classifier(spark, sf_dir)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    found = {r.doc_id: r for r in got.collect()}
    assert len(found) == 1000
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for d, r in found.items())
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    held = [(found[d].predicted, y) for d, y in truth.items() if d in found and found[d].held_out]
    assert np.mean([a == b for a, b in held]) > 0.97


def test_rows_and_edges(spark):
    docs = spark.createDataFrame([(1, "good text of words", "x"), (1, "good text of words", "x"), (2, None, "y"), (None, "", "z"), (3, "BAD!! BAD!!", "q")], "doc_id long, text string, quality_score string")
    labels = spark.createDataFrame([(1, 1, 0), (3, 0, 0), (2, 1, 0), (2, 0, 0), (None, 1, 1), (4, None, 1)], "doc_id long, quality int, toxic int")
    model = fit(docs, labels, folds=1, held=5)
    out = scored(docs, model)
    assert out.columns == ["doc_id", "text", "quality_score"] and out.count() == 5
    assert out.where("quality_score is null or quality_score < 0 or quality_score > 1").count() == 0
    assert scored(docs.limit(0), model).count() == 0
    none = fit(docs, labels.limit(0))
    assert {r.quality_score for r in scored(docs, none).collect()} == {0.5}
    kept = accepted(docs, labels)
    assert kept.columns == docs.columns and kept.where(F.col("doc_id") == 1).count() in (0, 2)
