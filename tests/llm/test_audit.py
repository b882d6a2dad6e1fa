"""The audit against a plain simulation of all orders, the matrix against its words, and the SQL."""

import random
import re
import tracemalloc
from collections import Counter
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from compare import check, connect
from siltstone.llm import audit as module
from siltstone.llm.audit import OP11_SQL, audit, failures, op11_filter_audit, shards, term_matrix

COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
DOCS = "doc_id long, text string, lang string, digest int, shard string, n_words string, first_id int"


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def failing(docs):
    out = []
    for doc, text, lang in docs:
        t, w = text or "", words_of(text)
        copy = doc is not None and any(d is not None and d < doc and (x or "") == t for d, x, _ in docs)
        tests = [len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * len(re.findall("[A-Z]", t)) > 3 * len(t), bool(re.search("[#$%&*|]", t)), copy]
        out.append((doc, lang or "", sum(1 << k for k, x in enumerate(tests) if x)))
    return out


def plain(docs, labels):
    good, toxic = ({d for d, *x in labels if d is not None and x[k] == 1} for k in (0, 1))
    rows, shapley = [], Counter()
    failed = failing(docs)
    for part in {p for _, p, _ in failed}:
        mine = [(d, f) for d, p, f in failed if p == part]
        for order in permutations("ABCDE"):
            there = list(mine)
            gone = []
            for step, letter in enumerate(order, 1):
                bit = 1 << "ABCDE".index(letter)
                here, there, before = [x for x in there if x[1] & bit], [x for x in there if not x[1] & bit], list(gone)
                gone += here
                shapley[part, letter] += len(here)
                rows.append([part, "".join(order), step, len(there), len(here), sum(bool(f & bit) for _, f in before), sum(f == bit for _, f in mine),
                             sum(d in good for d, _ in here), sum(d in toxic for d, _ in here)])
    return sorted((tuple([*r, shapley[r[0], r[1][r[2] - 1]]]) for r in rows), key=repr)


@pytest.fixture(scope="module")
def data():
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(400)] + ["É", "日本", "Word", "x#y"]
    docs = [(0, None, "en"), (1, "", "en"), (2, " \t", None), (None, "", "en"), (None, "null id", ""), (3, "null id", "de"), (3, "null id", "de")]
    for i in range(80):
        some = vocabulary[: rng.choice([3, 150, 400, 404])]
        docs.append((10 + i, rng.choice([" ", "\n\n"]).join(rng.choice(some) for _ in range(rng.choice([0, 5, 199, 200, 350]))) + rng.choice(["", "ABCDEFGHIJ" * 9]), rng.choice(["en", "de", None])))
    docs += [(200 + i, docs[20 + i % 3][1], "en") for i in range(30)]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 230, 2)] + [(None, 1, 1), (10, 1, 0), (10, 0, 1)]
    return docs, labels


def frames(spark, docs, labels):
    docs = spark.createDataFrame([(*d, 1, "x", "y", 2) for d in docs], DOCS)
    return docs, spark.createDataFrame([(*x, "z", 1) for x in labels], "doc_id long, quality int, toxic int, part string, fails int")


def test_small(spark, data):
    docs, labels = frames(spark, *data)
    failed = failures(docs)
    assert sorted((tuple(r) for r in failed.collect()), key=repr) == sorted(failing(data[0]), key=repr)
    found = audit(failed, labels, F.col("quality") == 1, F.col("toxic") == 1)
    assert sorted((tuple(r[c] for c in COLUMNS) for r in found.collect()), key=repr) == plain(*data)


def test_empty(spark, data):
    docs, labels = frames(spark, *data)
    assert audit(failures(docs.where("false")), labels, F.col("quality") == 1, F.col("toxic") == 1).count() == 0
    found = audit(failures(docs), labels.where("false"), F.col("quality") == 1, F.col("toxic") == 1).select(COLUMNS)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == plain(data[0], [])


@pytest.mark.parametrize("shard_bytes", [1, 500, 1 << 22])
def test_matrix(spark, data, shard_bytes):
    """However it is cut, the matrix holds each text's words with their counts."""
    docs, _ = frames(spark, *data)
    matrix, dictionary = term_matrix(shards(docs, ["doc_id", "shard"], shard_bytes=shard_bytes))
    names = {r.id: r.word for r in dictionary.collect()}
    assert dictionary.count() == len(names) == len(set(names.values()))
    got = []
    for s in matrix.collect():
        for k, row in enumerate(s.docs):
            a, b = s.indptr[k : k + 2]
            got.append((row.doc_id, row.shard, sorted((names[i], n) for i, n in zip(s.indices[a:b], s.counts[a:b], strict=True))))
    assert sorted(got, key=repr) == sorted(((d, "x", sorted(Counter(words_of(t)).items())) for d, t, _ in data[0]), key=repr)


def test_long_text(spark):
    text = "some words again " * 600_000
    found = failures(spark.createDataFrame([(1, text, "en"), (2, text, "en"), (3, "A", "en")], "doc_id long, text string, lang string").coalesce(1))
    assert sorted(map(tuple, found.collect())) == [(1, "en", 2), (2, "en", 18), (3, "en", 5)]


def test_memory_of_a_task(spark, monkeypatch):
    """However much text a task has, shards are read one by one and rows go to Python some megabytes at a time."""
    keys, used, staged = ("spark.sql.execution.arrow.maxBytesPerBatch", "parquet.block.row.count.limit"), [], []

    def stage(df, label):
        used.append(int(spark.conf.get(keys[0]).rstrip("b")))
        staged.append(module_stage(df, label))
        return staged[-1]

    module_stage, before = module.stage, [spark.conf.get(k, None) for k in keys]
    monkeypatch.setattr(module, "stage", stage)
    texts = spark.range(0, 12, 1, 1).selectExpr("id doc_id", "repeat(concat('word', id, ' of many '), 100000) text", "'en' lang")
    assert sorted(map(tuple, failures(texts).collect())) == [(i, "en", 2) for i in range(12)]
    assert max(used[:2]) <= 4 << 20 and [spark.conf.get(k, None) for k in keys] == before
    (file,) = (pq.ParquetFile(f.removeprefix("file://")) for f in staged[0].inputFiles())
    assert [file.metadata.row_group(k).num_rows for k in range(file.num_row_groups)] == [1] * staged[0].count() and staged[0].count() > 3


def test_batches(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["n"])

    rows = spark.range(0, 1000, 1, 1).selectExpr("repeat('x', 10000) text")
    with module.settings(spark, module.SMALL_BATCHES):
        found = [r.n for r in rows.mapInArrow(sizes, "n long").collect()]
    assert max(found) < 5 << 20 < sum(found)
    assert rows.mapInArrow(sizes, "n long").count() == 1


def test_pieces(monkeypatch):
    """A shard is the same whatever is handled together, and its flags are counted in little memory."""
    rng = random.Random(3)
    texts = ["".join(rng.choice(["a", "B ", "é", "\n", "日本", " Word#", "zz" * 30, " "]) for _ in range(rng.choice([0, 1, 60]))).encode() for _ in range(40)]
    for some in (texts, texts[2:3], [b"".join(texts)], [b""], [b"", b""]):
        data, offsets = np.frombuffer(b"".join(some), np.uint8), np.cumsum([0, *map(len, some)])
        found = []
        for together in (1, 7, 100, 1 << 20):
            monkeypatch.setattr(module, "WORDS_BYTES", together)
            monkeypatch.setattr(module, "HASHED_WORDS", together)
            *shard, words, bounds = module._shard(data, offsets, 5)
            found.append([*map(list, shard), words.to_pylist(), list(bounds), *[list(f(data, offsets)) for f in module.MEASURES.values()]])
        assert all(x == found[0] for x in found)
        assert found[0][-3] == [sum(65 <= b <= 90 for b in t) for t in some] and found[0][-2] == [len(t.decode()) for t in some]
    monkeypatch.undo()
    data, offsets = np.frombuffer(b"Some Words. " * 400_000, np.uint8), np.array([0, 1_000_000, 4_800_000])
    tracemalloc.start()
    try:
        for measure in module.MEASURES.values():
            measure(data, offsets)
        assert tracemalloc.get_traced_memory()[1] < 4 * len(data)
    finally:
        tracemalloc.stop()


def test_sql(spark):
    sf_dir = "/root/testdata/sf0.001"
    assert check(spark, connect(sf_dir), op11_filter_audit, OP11_SQL, sf_dir) % 600 == 0
