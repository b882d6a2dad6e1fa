"""Best-fit packing of tokenized documents into sequences of bounded length.

The plan is made over counts of lengths, not over documents.  One row per length (never more than the
capacity) reaches the driver, best-fit decreasing fills whole groups of equal sequences at a time, and the
planned runs of slots go back as a small table.  Documents take slots by their rank within their length.
"""

from __future__ import annotations

import bisect
import os
import zlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siltstone.llm.common import LOWER, SPACES, row_bounds, steps, table, text_pieces, word_spans
from siltstone.sources.stage import stage

CAPACITY = 2048
#: Bytes of text whose different word pieces are looked up together.
TOGETHER_BYTES = 2 << 20
#: Word pieces that a Python worker keeps with their ids; a full cache starts again.
CACHE_PIECES = 500_000


# --- tokens

_SPACE, _LETTER, _DIGIT, _OTHER, _RARE = range(5)


def _kinds() -> np.ndarray:
    """Kinds of bytes.  Rare ones are beyond ASCII, or white space to the vocabulary though not to `SPACES`."""
    kinds = np.full(256, _RARE, np.uint8)
    kinds[:0x80] = _OTHER
    kinds[0x1C:0x20] = _RARE
    kinds[SPACES] = _SPACE
    kinds[ord("0") : ord("9") + 1] = _DIGIT
    kinds[ord("a") : ord("z") + 1] = _LETTER
    return kinds


_KINDS = _kinds()
#: What the vocabulary's split pattern takes off behind an apostrophe.
_SHORT = (b"s", b"t", b"re", b"ve", b"m", b"ll", b"d")


class WordIds:
    """Ids of texts by a vocabulary that lower-cases, drops white space, and never crosses it with a piece.

    Texts are cut as its split pattern does: runs of letters, single digits, runs of other characters, and the
    short forms behind an apostrophe.  For letters of ASCII and Latin-1 that is done for all words at once; a word
    with any other character, or with a special token, goes through the tokenizer whole.  Each different piece is
    encoded once.
    """

    def __init__(self, definition: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_str(definition)
        self.model = self.tokenizer.model
        self.to_letters = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.known: dict[str, bytes] = {}
        self.asked = self.missed = 0

    def _piece(self, piece: str) -> bytes:
        letters = piece if piece.isascii() and piece.isalnum() else self.to_letters.pre_tokenize_str(piece)[0][0]
        return np.array([token.id for token in self.model.tokenize(letters)], np.uint32).tobytes()

    def _word(self, word: str) -> bytes:
        return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, np.uint32).tobytes()

    def _cut(self, data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """All pieces in a row, lower-cased; which are whole words of rare characters; and the row of each."""
        low = LOWER[data]
        kinds = _KINDS[low]
        # two bytes of a letter of Latin-1, but for the signs of multiplication and division
        lead = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)) if len(data) else np.zeros(0, np.int64)
        capital = lead[data[lead + 1] < 0x9F]
        low[capital + 1] += 0x20
        kinds[lead] = kinds[lead + 1] = _LETTER
        bars = np.flatnonzero((data[:-1] == ord("<")) & (data[1:] == ord("|"))) if len(data) else lead
        kinds[bars] = _RARE
        starts, ends, rows = word_spans(data, offsets, SPACES)
        inside = kinds != _SPACE
        place = np.cumsum(inside, dtype=np.int32 if len(inside) < 1 << 31 else np.int64) - 1  # without the white space
        low, kinds, plain = low[inside], kinds[inside], data[inside]
        starts = place[starts] if len(starts) else starts
        sizes = np.diff(starts, append=len(low))
        rare = np.add.reduceat(kinds == _RARE, starts) > 0 if len(starts) else np.zeros(0, bool)
        in_rare = np.repeat(rare, sizes)
        first = np.ones(len(low), bool)
        first[1:] = (kinds[1:] != kinds[:-1]) | (kinds[1:] == _DIGIT)
        first[starts] = True
        marks = np.flatnonzero(first & (low == ord("'")) & ~in_rare)
        words = np.searchsorted(starts, marks, side="right") - 1
        for mark, end in zip(marks.tolist(), (starts[words] + sizes[words]).tolist(), strict=True):
            size = next((len(x) for x in _SHORT if mark + len(x) < end and low[mark + 1 : mark + 1 + len(x)].tobytes() == x), 0)
            if size:
                first[mark + 1] = False
                if mark + 1 + size < end:
                    first[mark + 1 + size] = True
        first[in_rare] = False
        first[starts] = True
        text = np.where(in_rare, plain, low)
        at = np.flatnonzero(first)
        bounds = np.append(at, len(text))
        row = np.repeat(rows, sizes)[at] if len(at) else at
        return pa.Array.from_buffers(pa.large_string(), len(at), [None, pa.py_buffer(bounds), pa.py_buffer(text)]), in_rare[at], row

    def texts(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where those of each begin; one more bound than texts."""
        pieces, rare, rows = self._cut(data, offsets)
        pieces = pieces.dictionary_encode()
        which = pieces.indices.to_numpy()
        whole = np.zeros(len(pieces.dictionary), bool)
        whole[which[rare]] = True
        if len(self.known) + len(whole) > CACHE_PIECES:
            self.known.clear()
        found = []
        for piece, is_word in zip(pieces.dictionary.to_pylist(), whole.tolist(), strict=True):
            ids = self.known.get(piece)
            if ids is None:
                ids = self.known[piece] = self._word(piece) if is_word else self._piece(piece)
                self.missed += 1
            found.append(ids)
        self.asked += len(which)
        ids = np.frombuffer(b"".join(found), np.uint32)
        n = np.fromiter(map(len, found), np.int64, len(found)) // 4
        sizes = n[which]
        ends = np.cumsum(sizes)
        places = np.repeat((np.cumsum(n) - n)[which] - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)
        return ids[places], np.concatenate([[0], ends])[row_bounds(rows, len(offsets) - 1)]


_LOADED: dict[str, WordIds] = {}


def _encoder(definition: str) -> WordIds:
    """One encoder a worker, kept over tasks."""
    key = str(hash(definition))
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = WordIds(definition)
    return _LOADED[key]


def tokenize(docs: DataFrame, tokenizer: str, limit: int = CAPACITY, doc_id: str = "doc_id", text: str = "text", end_id: int = 0, with_ids: bool = True) -> DataFrame:
    """Pieces of at most `limit` tokens: `doc_id`, `piece` (from 0), `start` (the document's ids before it),
    `length`, `ids_crc32`, and `ids`, its token ids as little-endian unsigned 32-bit numbers, unless `with_ids` is
    false.

    Every document ends with `end_id`, so a null or empty text is one piece of one token, and every row
    gives at least one piece.  Repeated rows and null ids are kept as they are.  Other columns of `docs` are
    ignored.  An empty table gives no pieces.  A very long text is encoded in parts of some megabytes.
    `tokenizer` is the path of a vocabulary file on the driver; its vocabulary must drop white space and have a
    special token.
    """
    with open(tokenizer, encoding="utf-8") as file:
        definition = docs.sparkSession.sparkContext.broadcast(file.read())
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = narrow.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(definition.value)
        for batch in batches:
            for part, data, offsets in steps(batch, step_bytes=TOGETHER_BYTES):
                if part.num_rows == 1:
                    ids = np.concatenate([encoder.texts(x, np.array([0, len(x)]))[0] for x, _ in text_pieces(data, SPACES)])
                    bounds = np.array([0, len(ids)])
                else:
                    ids, bounds = encoder.texts(data, offsets)
                # one more id at the end of each text
                ids = np.insert(ids, bounds[1:], np.uint32(end_id)).astype("<u4")
                bounds = bounds + np.arange(len(bounds))
                pieces = -(-np.diff(bounds) // limit)
                rows = np.repeat(np.arange(part.num_rows), pieces)
                piece = np.arange(len(rows)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = piece * limit
                length = np.minimum(limit, np.diff(bounds)[rows] - start)
                first = bounds[rows] + start
                packed = memoryview(ids).cast("B")
                parts = [packed[4 * a : 4 * b] for a, b in zip(first.tolist(), (first + length).tolist(), strict=True)]
                columns = [part.column("doc_id").take(pa.array(rows)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array([zlib.crc32(x) for x in parts], pa.int64())]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    held = pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer((4 * np.append(first, len(ids))).astype(np.int32)), pa.py_buffer(ids)])
                    columns, names = [*columns, held], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return narrow.mapInArrow(cut, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + (", ids binary" if with_ids else ""))


# --- plan


class Run(NamedTuple):
    """Ranks from `first_rank` to before `end_rank` of one length fill `per_sequence` slots, from `offset`
    on, of each sequence from `first_sequence` on."""

    length: int
    first_rank: int
    end_rank: int
    first_sequence: int
    per_sequence: int
    offset: int


def best_fit(counts: dict[int, int], capacity: int) -> list[Run]:
    """Best-fit decreasing over a histogram of lengths.

    Sequences with equal room form groups that are filled together.  A length either exhausts a group, whose
    room at least halves by that, or ends in it.  So there are at most a few groups a length, each taken
    at most log2(capacity) times: the number of runs depends on the capacity, not on the documents.
    """
    rooms: list[int] = []  # ascending
    groups: dict[int, list[tuple[int, int]]] = {}  # room: first sequence, number of sequences
    runs: list[Run] = []
    opened = 0

    def put(room: int, first: int, n: int) -> None:
        if room and n:
            if room not in groups:
                bisect.insort(rooms, room)
                groups[room] = []
            groups[room].append((first, n))

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        if not 0 < length <= capacity:
            raise ValueError(f"a length of {length} does not fit a capacity of {capacity}")
        while left:
            at = bisect.bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                first, n = groups[room].pop()
                if not groups[room]:
                    del groups[room], rooms[at]
            else:
                room, first, n = capacity, opened, -(-left // (capacity // length))
                opened += n
            each = room // length
            full = min(n, left // each)
            if full:
                runs.append(Run(length, rank, rank + full * each, first, each, capacity - room))
                put(room - each * length, first, full)
                rank, left, first, n = rank + full * each, left - full * each, first + full, n - full
            if n and left:  # fewer than fill one sequence
                runs.append(Run(length, rank, rank + left, first, left, capacity - room))
                put(room - left * length, first, 1)
                first, n, left = first + 1, n - 1, 0
            put(room, first, n)
    return runs


def pack(pieces: DataFrame, capacity: int = CAPACITY, length: str = "length") -> DataFrame:
    """`pieces` with `sequence_id` (from 0) and `offset`: no sequence holds more than `capacity`, and the
    offsets in each are gapless from 0.  Columns of those two names are replaced; all others are kept.

    Runs jobs: the pieces are written once to the shared folder, so pass narrow rows.  Lengths must be from
    1 to the capacity; a null length or another value is an error.  Equal rows take separate slots.  An empty
    table gives an empty result.
    """
    spark = pieces.sparkSession
    kept = [c for c in pieces.columns if c.lower() not in ("sequence_id", "offset")]
    size = F.coalesce(F.col(length).cast("long"), F.lit(-1))
    written = stage(
        pieces.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), size.alias("length"), F.spark_partition_id().alias("part"),
                      F.monotonically_increasing_id().alias("at")),
        "pieces",
    )
    by_part = written.groupBy("length", "part").agg(F.count("*").alias("n"))
    counts = {r["length"]: r["n"] for r in by_part.groupBy("length").agg(F.sum("n").alias("n")).orderBy("length").limit(capacity + 1).collect()}
    runs = best_fit(counts, capacity)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = by_part.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    ranked = (
        written.withColumn("rank", F.row_number().over(Window.partitionBy("length", "part").orderBy("at")) - 1)
        .join(offsets, ["length", "part"])
        .withColumn("rank", F.col("rank") + F.col("before"))
    )
    plan = spark.createDataFrame(runs, "length long, first_rank long, end_rank long, first_sequence long, per_sequence long, start long").alias("plan")
    # the plan's size is bounded by the capacity alone, see best_fit
    slots = ranked.join(
        F.broadcast(plan),
        (ranked["length"] == F.col("plan.length")) & (ranked["rank"] >= F.col("plan.first_rank")) & (ranked["rank"] < F.col("plan.end_rank")),
    )
    place = F.col("rank") - F.col("first_rank")
    return slots.select(
        *[F.col("row").getField(c).alias(c) for c in kept],
        (F.col("first_sequence") + F.floor(place / F.col("per_sequence")).cast("long")).alias("sequence_id"),
        (F.col("start") + (place % F.col("per_sequence")) * ranked["length"]).alias("offset"),
    )


# --- query


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """Each piece with the CRC of its ids and its place.  The ids themselves are `tokenize`'s; only narrow rows are
    packed.  Nulls, repeated rows, long texts and empty tables are as `tokenize` and `pack` have them."""
    return pack(tokenize(docs, tokenizer, capacity, with_ids=False), capacity)


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack_documents(table(spark, sf_dir, "documents"), os.fspath(public_tokenizers.path("word_bpe_49k.json")))
