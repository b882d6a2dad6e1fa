"""Nearest examples against all cosines; terms against a plain count; held-out accuracy."""

import random
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np

from siltstone.llm.toxicity import build, calibration, choose_terms, op8_toxicity, term_hashes, toxicity


def hashed(text):
    data = text.encode()
    return term_hashes(np.frombuffer(data, np.uint8), np.array([0, len(data)], np.int64))[1].tolist()


def test_terms():
    text = "Ab éèçàù-xyz ABCDE abcdefg  one"
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate({c: c + 32 for c in range(65, 91)}))
    assert len(hashed(text)) == len(words) == len(set(hashed(text)))
    assert hashed("ABCD é") == hashed("abcd é") and not hashed(" .;")
    whole = " ".join(["alpha beta", "gammas"])
    assert sorted(hashed(whole)) == sorted(hashed("alpha beta") + hashed("gammas"))


def some_index(rng, n=300, width=40):
    terms, counts = [], []
    for _ in range(n):
        chosen = sorted(rng.sample(range(width), rng.randint(0, 6)))
        terms.append(np.array(chosen, np.int64))
        counts.append(np.array([rng.randint(1, 4) for _ in chosen], float))
    labels = np.array([float(rng.random() < 0.3) for _ in range(n)])
    holding = np.array([sum(t in x for x in terms) for t in range(width)], float)
    return terms, counts, labels, build(terms, counts, labels, holding, n)


def test_nearest():
    rng = random.Random(4)
    terms, counts, _, index = some_index(rng)
    dense = np.zeros((300, 40))
    for k in range(300):
        if len(terms[k]):
            dense[k, terms[k]] = index.weigh(terms[k], counts[k])
    for k in range(0, 300, 7):
        found, similarity = index.nearest(terms[k], counts[k], 15, without=k)
        cosines = np.round(dense @ dense[k], 12)
        cosines[k] = 0
        want = sorted((j for j in range(300) if cosines[j] > 0), key=lambda j: (-cosines[j], j))[:15]
        assert np.allclose(similarity, cosines[want])
        assert [round(float(cosines[j]), 9) for j in index.number[found]] == [round(float(cosines[j]), 9) for j in want]


def test_calibration():
    rng = np.random.default_rng(2)
    votes = rng.random(4000)
    at, share = calibration(votes, (rng.random(4000) < votes**2).astype(float))
    assert (np.diff(share) >= 0).all() and 0 < share[0] and share[-1] < 1
    assert abs(np.interp(0.7, at, share) - 0.49) < 0.1


def test_chosen_terms(spark):
    rng = random.Random(1)
    rows = []
    for i in range(200):
        words = [rng.choice(["alpha", "beta", "gamma", "delta"]) for _ in range(20)]
        if i % 4 == 0:
            words.append("nasty")
        rows.append((i, " ".join(words) + f" u{i}", int(i % 4 == 0)))
    chosen = choose_terms(spark.createDataFrame(rows, "doc_id long, text string, label int"))
    assert set(hashed("nasty")) <= set(chosen.tolist())
    assert not set(hashed("alpha")) & set(chosen.tolist())


def test_held_out(spark):
    sf_dir = "/root/testdata/sf0.1"
    found = {r.doc_id: r for r in op8_toxicity(spark, sf_dir).collect()}
    assert len(found) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for d, r in found.items())
    held = [(found[r.doc_id].predicted, r.toxic) for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect() if found[r.doc_id].held_out]
    assert np.mean([a == b for a, b in held]) > 0.97


def test_edges(spark):
    docs = spark.createDataFrame([(1, "plain words", "x"), (1, "plain words", "x"), (2, None, "y"), (None, "", "z"), (3, "nasty words", "q")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(1, 0), (3, 1), (2, 1), (2, 0), (None, 1), (4, None)], "doc_id long, toxic int")
    got = toxicity(docs, labels)
    assert got.columns == ["doc_id", "score", "evidence"]
    assert len(got.collect()) == 5 and all(0 <= r.score <= 1 for r in got.collect())
    assert toxicity(docs.limit(0), labels).count() == 0
    assert {r.score for r in toxicity(docs, labels.limit(0)).collect()} == {0.5}


def test_whole_texts(spark):
    """Evidence by the cosine of all terms against plain counts, for texts of common or untelling words too."""
    rng = random.Random(6)
    vocabulary = [f"{a}{b}" for a in ("ab", "cd", "efgh", "ijklm", "nopqrs") for b in ("", "tu", "vwx", "yz")]
    rows = [(i, " ".join(rng.choices(vocabulary, range(1, 21), k=rng.randint(1, 30)) + [f"only{i}"] * (i % 3))) for i in range(60)] + [(60, "!"), (None, "ab cd ab")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(40)], "doc_id long, toxic int")
    counts = [Counter(hashed(t)) for _, t in rows]
    holding = Counter(t for c in counts for t in c)
    weights = [{t: (1 + np.log(n)) * (np.log((len(rows) + 1) / (holding[t] + 1)) + 1) for t, n in c.items()} for c in counts]
    known = [i for i in range(40) if zlib.crc32(str(i).encode()) % 5]
    norm = lambda x: np.sqrt(sum(w * w for w in x.values()))
    got = {r.doc_id: r for r in toxicity(docs, labels).collect()}
    for k, (doc, _) in enumerate(rows):
        cosines = sorted((sum(w * weights[e].get(t, 0) for t, w in weights[k].items()) / norm(weights[k]) / norm(weights[e]) for e in known if weights[k]), reverse=True)
        assert np.allclose([e.similarity for e in got[doc].evidence], cosines[:3])
        assert all(e.label == int(e.doc_id % 4 == 0) for e in got[doc].evidence)
    assert len(got[None].evidence) == 3 and not got[60].evidence


def test_long_texts_together():
    """What long texts of many listed terms need at once does not grow with how many are searched together."""
    rng = np.random.default_rng(8)
    terms = [np.sort(rng.choice(6000, 150, replace=False)) for _ in range(1500)]  # a term in about 38 examples
    counts = [np.ones(len(x)) for x in terms]
    index = build(terms, counts, (rng.random(1500) < 0.3).astype(float), np.bincount(np.concatenate(terms), minlength=6000).astype(float), 1500)
    texts = [(np.sort(rng.choice(6000, 2000, replace=False)), np.ones(2000)) for _ in range(64)]
    alone = [index.nearest(*x, 15) for x in texts]
    tracemalloc.start()
    together = index.nearest_all(texts, 15)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 32 << 20
    assert all(np.array_equal(a, b) and np.array_equal(x, y) for (a, x), (b, y) in zip(alone, together, strict=True))
