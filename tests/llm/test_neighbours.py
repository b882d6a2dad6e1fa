"""Neighbours against all cosines: recall, exact scores, ties, few or unusable vectors."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltstone.llm import neighbours
from siltstone.llm.neighbours import lay_out, nearest, op2_nearest_neighbours


def by_force(data, is_query, k=5):
    """(query, [(id, cosine)]) over rows of (id, vector); the vectors are all usable and ids differ."""
    ids = np.array([i for i, _ in data])
    x = np.array([v for _, v in data], float)
    norms = np.sqrt((x * x).sum(axis=1))
    out = {}
    for i, q, norm in zip(ids, x, norms, strict=True):
        if is_query(i):
            scores = (x * q).sum(axis=1) / (norms * norm)
            best = sorted((j for j in range(len(ids)) if ids[j] != i), key=lambda j: (-scores[j], ids[j]))[:k]
            out[int(i)] = [(int(ids[j]), scores[j]) for j in best]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert len(out[r.query_id]) == r["rank"]
    return out


@pytest.mark.parametrize("sf", ["0.01", "0.1"])
def test_recall(spark, sf):
    sf_dir = f"/root/testdata/sf{sf}"
    want = by_force([(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()], lambda i: i % 50 == 0)
    got = found(op2_nearest_neighbours(spark, sf_dir))
    assert set(got) == set(want) and all(len(x) == 5 for x in got.values())
    hits = [(q, i) for q, x in got.items() for i, _ in x if i in dict(want[q])]
    assert len(hits) / sum(map(len, want.values())) >= 0.95
    assert all(abs(s - dict(want[q])[i]) < 1e-15 for q, x in got.items() for i, s in x if i in dict(want[q]))


def test_graph_finds_nearest():
    rng = np.random.default_rng(3)
    x = neighbours._unit(rng.normal(size=(4000, 16)))
    lists = lay_out(x, 4000)
    ids, cosines = lists.nearest(x[:200], 32)
    every = x[:200] @ lists.centroids.T
    assert (ids[:, 0] == every.argmax(axis=1)).mean() > 0.99
    assert np.allclose(cosines, np.take_along_axis(every, ids, axis=1))
    assert (np.sort(ids, axis=1)[:, 1:] != np.sort(ids, axis=1)[:, :-1]).all()


def test_parts_are_balanced():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(1000, 8))
    parts = list(neighbours._halved(x, np.arange(1000), 64, rng))
    assert sorted(np.concatenate(parts)) == list(range(1000)) and max(map(len, parts)) <= 64 and min(map(len, parts)) >= 31
    same = np.ones((500, 8))
    assert [len(p) for p in neighbours._halved(same, np.arange(500), 64, rng)] == [500]


def test_ties_copies_and_small_tiles(spark, monkeypatch):
    """A third of all vectors equal, in many tiles; equal scores go to the smaller id."""
    monkeypatch.setattr(neighbours, "TILE_VECTORS", 50)
    monkeypatch.setattr(neighbours, "TILE_QUERIES", 7)
    rng = np.random.default_rng(7)
    base = rng.normal(size=6)
    data = [(i, base.tolist() if i % 3 == 0 else rng.normal(size=6).tolist()) for i in range(900)]
    got = found(nearest(spark.createDataFrame(data, "vec_id long, embedding array<double>"), F.col("vec_id") % 50 == 0))
    want = by_force(data, lambda i: i % 50 == 0)
    assert set(got) == set(want)
    for q in want:
        if q % 3 == 0:
            assert got[q] == want[q]
    assert sum(i in dict(want[q]) for q in want for i, _ in got[q]) >= 0.9 * 5 * len(want)


def test_unusable_and_few(spark):
    nan, inf = float("nan"), float("inf")
    data = [(0, [1.0, 2.0]), (1, [2.0, 4.0]), (2, [0.0, 0.0]), (3, None), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [1.0, 2.0, 3.0]), (None, [1.0, 0.0]), (8, [-1.0, 0.0]), (9, []), (50, [0.5, 1.0])]
    df = spark.createDataFrame([(i, v, "l", 1) for i, v in data], "vec_id long, embedding array<float>, list string, rank int")
    got = found(nearest(df, F.col("vec_id") % 50 == 0))
    assert {q: [i for i, _ in x] for q, x in got.items()} == {0: [1, 50, 8], 50: [0, 1, 8]}
    assert found(nearest(df.where("vec_id = 0"), F.col("vec_id") % 50 == 0)) == {}
    empty = nearest(df.limit(0), F.col("vec_id") % 50 == 0)
    assert empty.columns == ["query_id", "rank", "vec_id", "score"] and empty.count() == 0
    twice = spark.createDataFrame([(0, [1.0, 0.0]), (0, [0.0, 1.0]), (1, [1.0, 1.0]), (1, [1.0, 0.1]), (2, [-1.0, 0.3])], "vec_id long, embedding array<double>")
    assert [i for i, _ in found(nearest(twice, F.col("vec_id") % 50 == 0))[0]] == [1, 2]


def test_short_answers_look_everywhere(spark, monkeypatch):
    """Lists so far apart that a query's own holds too few."""
    monkeypatch.setattr(neighbours, "LIST_SIZE", 3)
    monkeypatch.setattr(neighbours, "LIST_SAMPLE", 3)
    data = [(i, np.eye(8)[i % 8] + np.full(8, 0.001 * i)) for i in range(24)]
    got = found(nearest(spark.createDataFrame([(i, v.tolist()) for i, v in data], "vec_id long, embedding array<double>"), F.col("vec_id") % 5 == 0, query_ratio=1.0))
    assert all(len(x) == 5 for x in got.values()) and len(got) == 5


def test_all_lists_within_ratio():
    """However many lists lie within the ratio of a query, it visits all of them."""
    rng = np.random.default_rng(11)
    x = neighbours._unit(rng.normal(size=(40_000, 64)))
    lists = lay_out(x, 40_000)
    row, number, _ = neighbours._chosen(lists, x[:50], neighbours.QUERY_BEAM, neighbours.QUERY_RATIO, None, False)
    distance = np.sqrt(2 - 2 * (x[:50] @ lists.centroids.T))
    want = set(zip(*map(np.ndarray.tolist, np.nonzero(distance <= neighbours.QUERY_RATIO * distance.min(axis=1, keepdims=True))), strict=True))
    assert max(np.bincount(row)) > neighbours.QUERY_BEAM and len(row) == len(set(zip(row.tolist(), number.tolist(), strict=True)))
    assert len(want & set(zip(row.tolist(), number.tolist(), strict=True))) >= 0.999 * len(want)
