"""Packing: ids against the tokenizer itself, the plan by its own conditions."""

import struct
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from siltstone.llm.common import SPACES, text_pieces
from siltstone.llm.packing import WordIds, best_fit, pack, pack_documents, tokenize

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    None, "", " \n", "Hello, World! it's 12'34 don't", "a<|endoftext|>b <|startoftext|> <|x|>", "Straße ÉCOLE école ΣΑΣ σας İstanbul", "a b c \x1c d\x0be",
    "日本語 テキスト 😀😀 á̂", "ﬁx ½ ² ª", "x" * 5000, "word " * 3000, "Ĳ Ŀ ŉ ſ K",
]


@pytest.fixture(scope="module")
def words():
    return WordIds(open(PATH, encoding="utf-8").read()), Tokenizer.from_file(str(PATH))


def direct(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [0]


@given(st.lists(st.text(max_size=40), min_size=50, max_size=80))
@settings(max_examples=20, deadline=None)
def test_ids_of_any_text(words, texts):
    encoder, tokenizer = words
    data = "".join(texts).encode()
    ids, bounds = encoder.texts(np.frombuffer(data, np.uint8), np.cumsum([0, *(len(t.encode()) for t in texts)]))
    for k, text in enumerate(texts):
        assert ids[bounds[k] : bounds[k + 1]].tolist() == direct(tokenizer, text)[:-1]


LETTERS = st.sampled_from([*"abstrevmldSTRÉéßñÀ×÷ÿ'.-,;:_<|> \n\x1c0129½ª日", "'s", "'ll", "'re", "<|endoftext|>", "<|ENDOFTEXT|>", "İ"])


@given(st.lists(st.lists(LETTERS, max_size=60).map("".join), min_size=20, max_size=30))
@settings(max_examples=60, deadline=None)
def test_ids_of_pieces(words, texts):
    test_ids_of_any_text.hypothesis.inner_test(words, texts)


def test_texts_in_parts(words):
    encoder, tokenizer = words
    text = " ".join(f"Wörd{k}, isn't" for k in range(3000))
    data = np.frombuffer(text.encode(), np.uint8)
    parts = [encoder.texts(x, np.array([0, len(x)]))[0] for x, _ in text_pieces(data, SPACES, piece_bytes=500)]
    assert len(parts) > 50 and np.concatenate(parts).tolist() == direct(tokenizer, text)[:-1]


@given(st.dictionaries(st.integers(1, 50), st.integers(1, 400), max_size=50))
@settings(max_examples=60, deadline=None)
def test_plan(counts):
    runs = best_fit(counts, 50)
    filled = defaultdict(list)
    ranks = defaultdict(list)
    for run in runs:
        for rank in range(run.first_rank, run.end_rank):
            at = rank - run.first_rank
            filled[run.first_sequence + at // run.per_sequence].append((run.offset + at % run.per_sequence * run.length, run.length))
            ranks[run.length].append(rank)
    assert {k: sorted(v) for k, v in ranks.items()} == {k: list(range(n)) for k, n in counts.items()}
    for slots in filled.values():
        end = 0
        for offset, length in sorted(slots):
            assert offset == end
            end += length
        assert end <= 50
    assert sorted(filled) == list(range(len(filled)))
    # one best-fit pass over single documents opens as many
    rooms = []
    for length in sorted((n for n, c in counts.items() for _ in range(c)), reverse=True):
        fits = [r for r in rooms if r >= length]
        if fits:
            rooms.remove(min(fits))
        rooms.append((min(fits) if fits else 50) - length)
    assert len(filled) == len(rooms)


def test_documents(spark, words):
    _, tokenizer = words
    docs = spark.createDataFrame([(i, t, "x", i) for i, t in enumerate(TEXTS)] + [(None, "a", "x", 1), (3, TEXTS[3], "x", 3)], "doc_id long, text string, length string, sequence_id int")
    got = pack_documents(docs, PATH).collect()
    assert set(got[0].asDict()) == {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"}
    want = []
    for row in docs.collect():
        ids = direct(tokenizer, row.text)
        for piece, at in enumerate(range(0, len(ids), 2048)):
            part = ids[at : at + 2048]
            want.append((row.doc_id, piece, at, len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part))))
    assert sorted((tuple(r)[:5] for r in got), key=repr) == sorted(want, key=repr)
    by = defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
    for slots in by.values():
        end = 0
        for offset, length in sorted(slots):
            assert offset == end
            end += length
        assert end <= 2048


def test_empty_and_bad(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert pack_documents(docs, PATH).collect() == []
    assert tokenize(docs, PATH).collect() == []
    with pytest.raises(ValueError):
        pack(spark.createDataFrame([(None,)], "length long"))
