"""Each stage against what its operator says by plain means, on its own input."""

import re
import zlib

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from siltstone.sources.stage import stage
from test_decontaminate import plain as contaminated
from test_secrets import plain as secret_spans
from test_simhash import by_hand as grouped

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def written(spark):
    """The input of the first stage and the output of each."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    out = [docs]
    for name, apply in corpus_pipeline.STAGES:
        out.append(stage(apply(spark, out[-1], SF_DIR), name))
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_columns(written):
    for df in written[1:-1]:
        assert df.schema == written[0].schema


def test_quality(spark, written):
    kept = texts(written[1])
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    held = [(d in kept, y) for d, y in labels.items() if zlib.crc32(str(d).encode()) % 3 == 1]
    assert sum(a == bool(y) for a, y in held) / len(held) > 0.97
    assert all(k for k, y in held if y)  # nothing clean goes


def test_near_dedup(written):
    before, after = texts(written[1]), texts(written[2])
    assert set(after) == {doc for doc, _, first in grouped(list(before.items())) if doc == first}
    assert all(after[d] == before[d] for d in after)


def test_decontamination(spark, written):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    before, after = texts(written[2]), texts(written[3])
    some = dict(list(before.items())[::4]) | {d: t for d, t in before.items() if d not in after}
    assert {r[0] for r in contaminated(list(some.items()), items) if not r[4]} == set(some) & set(after)


def test_secrets(written):
    before, after = texts(written[3]), texts(written[4])
    assert set(before) == set(after)
    changed = [d for d in before if before[d] != after[d]]
    assert changed and all(bool(secret_spans(before[d])) == (d in changed) for d in before)
    for d in changed:
        assert not secret_spans(after[d]) and "[secret]" in after[d]
        found = sorted(tuple(map(int, s.split(":")[1:])) for s in secret_spans(before[d]))
        parts = re.split(r"\[secret\]", after[d])
        assert before[d].startswith(parts[0]) and before[d].endswith(parts[-1]) and len(parts[0]) == found[0][0]
    assert all(r.n_chars == len(r.text) for r in written[4].collect())


def test_packing(written):
    tokenizer = Tokenizer.from_file(str(public_tokenizers.path("word_bpe_49k.json")))
    lengths = {d: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for d, t in list(texts(written[4]).items())[:100]}
    got = {}
    for r in written[5].collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + r.length
    assert all(got[d] == n for d, n in lengths.items())


def test_run(spark, written):
    found = corpus_pipeline.run(spark, SF_DIR)
    assert found.columns == written[-1].columns and found.count() == written[-1].count()


def test_odd_rows_through_all_stages(spark):
    """Null ids, null, empty and very long texts, repeated rows, and columns with the names that stages use inside."""
    good = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(40).collect()
    long = " ".join(f"word{i} of a long text." for i in range(200_000))
    rows = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in good]
    rows += [(None, None, "en", "s", 0), (None, "", "en", "s", 0), (None, good[0].text + " password = hunter22secret", None, None, None), (9_001, long, "en", "s", len(long)), rows[5], rows[5], (9_002, None, None, None, None)]
    names = ["merged", "clean_text", "found_digest", "__row", "row", "key", "content", "scanned", "contamination", "x.y", "score", "digest", "document", "quality_score"]
    kind = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` string" for n in names)
    docs = spark.createDataFrame([(*r, *[f"{n} of {i}" for n in names]) for i, r in enumerate(rows)], kind)
    stages = dict(corpus_pipeline.STAGES)
    by_row = lambda df: {r["merged"]: r for r in df.collect()}
    before = by_row(docs)
    for name in ("quality_classifier", "simhash_near_dedup", "benchmark_decontamination", "secret_scans"):
        out = stage(stages[name](spark, docs, SF_DIR), name)
        assert out.schema.fieldNames() == docs.columns, name
        after = by_row(out)
        assert after and len(after) == out.count()
        for key, row in after.items():
            same = [c for c in docs.columns if c not in ("text", "n_chars")] if name == "secret_scans" else docs.columns
            assert all(row[c] == before[key][c] for c in same), (name, key)
        if name == "simhash_near_dedup":
            # one row for the texts without words, and one for the three repeated
            assert sum(r.text in (None, "") for r in after.values()) == 1 and sum(r.text == rows[5][1] for r in after.values()) == 1
        if name == "secret_scans":
            assert len(after) == len(rows) and sum("[secret]" in (r.text or "") for r in after.values()) >= 1
    packed = stages["best_fit_packing"](spark, docs, SF_DIR).collect()
    assert sum(r.piece == 0 for r in packed) == len(rows) and sum(r.doc_id == 9_001 for r in packed) > 300


def test_empty(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0)
    for _, apply in corpus_pipeline.STAGES:
        docs = apply(spark, docs, SF_DIR) if docs.columns[0] == "doc_id" else docs
        assert docs.count() == 0
