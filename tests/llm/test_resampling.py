"""Resampling against a plain computation, CRCs against zlib's, and the SQL over the small tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from compare import check, connect
from siltstone.llm import common
from siltstone.llm.resampling import OP13_SQL, hashed_features, op13_importance_resampling, range_crc, resample, running_crc

LOWER = {c: c + 32 for c in range(65, 91)}
DOCS = "doc_id long, text string, rank string, row int, features string, weight int"


def features(text, longest=2, buckets=10_000):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    runs = [" ".join(words[i : i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1)]
    return len(words), [zlib.crc32(r.encode()) % buckets for r in runs]


def plain(docs, target):
    found = [(doc, *features(text)) for doc, text in docs]
    s, t = Counter(b for _, _, f in found for b in f), Counter(b for x in target for b in features(x)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (all_s + 10_000) / ((s[b] + 1) * (all_t + 10_000))))
    rows = []
    for doc, n, f in found:
        weight = sum(map(gain, f)) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        rows.append((doc, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    may = sorted((r for r in rows if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    ranks = Counter()
    for place, r in enumerate(may[: 25 * len(may) // 100], 1):
        ranks[(r, place)] += 1
    drawn = sorted(ranks.elements(), key=repr)
    left = Counter(rows) - Counter(r for r, _ in drawn)
    return sorted([(*r, place) for r, place in drawn] + [(*r, None) for r in left.elements()], key=repr)


def got(df):
    assert df.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def data():
    rng = random.Random(2)
    vocabulary = ["ab", "Cd", "É", "x1", "the", "of", "naïve", "日本"]
    docs = [(0, None), (1, ""), (2, " .,"), (3, "One"), (None, "a null id has noise too"), (5, "w" * 700 + " tail")]
    docs += [(10 + i, rng.choice([" ", ", ", "\n--"]).join(rng.choice(vocabulary) for _ in range(rng.randint(1, 60)))) for i in range(120)]
    docs += [docs[40]] * 30 + [(500 + i, docs[50][1]) for i in range(20)]
    return docs, ["the of the", "É x1 the", None, "", "the of the"]


def test_crc():
    rng = np.random.default_rng(3)
    for n in (0, 1, 63, 64, 65, 4097):
        data = rng.integers(0, 256, n, dtype=np.uint8)
        bounds = np.sort(rng.integers(0, n + 1, (40, 2)), axis=1)
        want = [zlib.crc32(data[a:b].tobytes()) for a, b in bounds]
        assert range_crc(running_crc(data), bounds[:, 0], bounds[:, 1]).tolist() == want


def test_small(spark, data):
    docs, target = data
    frame = spark.createDataFrame([(d, t, "x", 1, "y", 2) for d, t in docs], DOCS)
    items = spark.createDataFrame([(t, 1) for t in target], "text string, doc_id int")
    assert got(resample(frame, items)) == plain(docs, target)


def test_empty(spark, data):
    docs, target = data
    none, items = spark.createDataFrame([], DOCS), spark.createDataFrame([(t,) for t in target], "text string")
    assert got(resample(none, items)) == []
    frame = spark.createDataFrame([(d, t, "x", 1, "y", 2) for d, t in docs[:30]], DOCS)
    assert got(resample(frame, items.where("false"))) == plain(docs[:30], [])


@pytest.mark.parametrize("longest", [1, 2, 4])
def test_long_texts_in_pieces(longest):
    """Pieces of a text give the features of the whole."""
    rng = random.Random(4)
    text = "".join(rng.choice(["a", "bc", "É", " ", ".", "longer" * 9]) for _ in range(3000)).encode()
    data = np.frombuffer(text, np.uint8)
    from siltstone.llm.resampling import _runs

    words = crcs = 0
    found = []
    for piece, known in common.text_pieces(data, common.MARKS, longest - 1, piece_bytes=100):
        n, crcs, _ = _runs(piece, np.array([0, len(piece)]), longest, known)
        words += int(n[0]) - known
        found += (crcs % np.uint32(10_000)).tolist()
    want = features(text.decode(), longest)
    assert (words, sorted(found)) == (want[0], sorted(want[1]))


def test_long_text(spark):
    text = "word, " * 1_500_000 + "end"
    row = hashed_features(spark.createDataFrame([(1, text), (2, "short")], "doc_id long, text string").coalesce(1)).where("doc_id = 1").first()
    assert row["n_words"] == 1_500_001 and len(row["features"]) == 3_000_001


def test_sql(spark):
    sf_dir = "/root/testdata/sf0.001"
    assert check(spark, connect(sf_dir), op13_importance_resampling, OP13_SQL, sf_dir) == 200
