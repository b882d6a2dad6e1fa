"""Benchmark passages in documents, found by one Aho-Corasick automaton over words.

Benchmark items are normalised to word sequences.  Their windows are the automaton's patterns, over word
numbers instead of characters, so a match always begins and ends with a word and the automaton has at most
13 states a window.  Each text is read once; matched words are mapped back to places in the original text.

Automata hold a bounded number of windows.  A benchmark beyond that is cut to blocks on Spark.  One block at a
time reaches the driver and is sent to the executors, which scan the texts for it; only the narrow findings of
the scans are brought together.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from functools import reduce
from itertools import repeat

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from siltstone.llm.common import LOWER, MARKS, table, text_bytes
from siltstone.sources.stage import stage

WINDOW = 13
#: A document is contaminated when one word in so many is hit.
SHARE = 20
#: Windows of one automaton: what is sent to every executor at once.
MAX_WINDOWS = 100_000

#: Bytes of a word lower-cased, all others a space.
_NORMAL = np.where(MARKS, np.uint8(0x20), LOWER).astype(np.uint8).tobytes()
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

#: An occurrence of a window: its words, its item, and its place in the text.
_FOUND = T.ArrayType(T.StructType([*[T.StructField(c, T.LongType()) for c in ("first", "end", "start", "stop")], T.StructField("item", T.StringType())]))
_RESULT = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("n_hit", T.LongType()),
    T.StructField("items", T.ArrayType(T.StringType())),
    T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
    T.StructField("contaminated", T.BooleanType()),
])


def normal_words(text: bytes) -> list[bytes]:
    return text.translate(_NORMAL).split()


class Automaton:
    """The automaton of some items' windows."""

    def __init__(self, items: list[tuple[str | None, str]], window: int):
        self.numbers: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set] = {}
        for item, text in items:
            words = [self.numbers.setdefault(w, len(self.numbers) + 1) for w in normal_words(text.encode())]
            size = min(window, len(words))
            for first in range(len(words) - size + 1 if words else 0):
                owners.setdefault(tuple(words[first : first + size]), set()).add(item)
        self.matcher = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for words, found in owners.items():
            self.matcher.add_word(words, (len(words), sorted(found, key=repr)))
        if owners:
            self.matcher.make_automaton()
        self.empty = not owners

    def matches(self, words: list[bytes]) -> list[tuple[int, int, str | None]]:
        """First word, end word and item of every occurrence of a window."""
        if self.empty or not words:
            return []
        numbers = tuple(map(self.numbers.get, words, repeat(0)))
        return [(last - size + 1, last + 1, item) for last, (size, items) in self.matcher.iter(numbers) for item in items]


_BUILT: dict[str, Automaton] = {}


def _automaton(items: list[tuple[str | None, str]], window: int) -> Automaton:
    """One automaton a worker, kept over tasks."""
    key = hashlib.sha256(repr((window, items)).encode()).hexdigest()
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = Automaton(items, window)
    return _BUILT[key]


Found = tuple[int, int, int, int, "str | None"]  # as in _FOUND


def _found(text: bytes, matches: list[tuple[int, int, str | None]]) -> list[Found]:
    """Occurrences with their places as code points."""
    if not matches:
        return []
    places = [m.span() for m in _WORD.finditer(text.decode())]
    return [(first, end, places[first][0], places[end - 1][1], item) for first, end, item in matches]


def _summary(n_words: int, found: list[Found], share: int) -> dict:
    """Words hit, items, and spans, of the occurrences of all blocks."""
    ranges: list[list[int]] = []  # unions of occurrences that overlap or touch
    for first, end, start, stop, _ in sorted(found, key=lambda x: x[:2]):
        if ranges and first <= ranges[-1][1]:
            ranges[-1][1], ranges[-1][3] = max(ranges[-1][1], end), max(ranges[-1][3], stop)
        else:
            ranges.append([first, end, start, stop])
    n_hit = sum(end - first for first, end, _, _ in ranges)
    items = sorted({x[4] for x in found if x[4] is not None})
    return {"n_words": n_words, "n_hit": n_hit, "items": items, "spans": [{"start": x[2], "end": x[3]} for x in ranges], "contaminated": n_hit > 0 and share * n_hit >= n_words}


def _blocks(benchmark: DataFrame, item_id: str, text: str, window: int, max_windows: int) -> DataFrame:
    """Written rows `block`, `item`, `text`: the words of items, in parts that lose no window, dealt to blocks of at
    most `max_windows` windows.  An item that stands there several times is taken once."""
    items = benchmark.select(F.col(item_id).cast("string").alias("item"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")).distinct()

    def parts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for item, content in zip(batch.column("item").to_pylist(), batch.column("text").to_pylist(), strict=True):
                words = normal_words(content.encode())
                for first in range(0, max(len(words) - window + 1, 1) if words else 0, max_windows):
                    some = words[first : first + max_windows + window - 1]
                    rows.append({"item": item, "text": b" ".join(some).decode(), "n": max(len(some) - window + 1, 1)})
            yield pa.RecordBatch.from_pylist(rows, pa.schema([("item", pa.string()), ("text", pa.string()), ("n", pa.int64())]))

    def dealt(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, room = TaskContext.get().partitionId() << 33, max_windows
        for batch in batches:
            blocks = []
            for n in batch.column("n").to_pylist():
                if n > room:
                    block, room = block + 1, max_windows
                blocks.append(block)
                room -= n
            yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int64()), batch.column("item"), batch.column("text")], names=["block", "item", "text"])

    cut = stage(items.mapInArrow(parts, "item string, text string, n long"), "benchmark-parts")
    total = cut.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    return stage(cut.repartition(max(1, -(-total // max_windows))).mapInArrow(dealt, "block long, item string, text string"), "benchmark-blocks")


def contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: int = SHARE, carry: list[str] | None = None,
    text: str = "text", item_id: str = "item_id", item_text: str = "text", max_windows: int = MAX_WINDOWS,
) -> DataFrame:
    """The `carry` columns of `docs` (all by default), and `contamination`: `n_words`, `n_hit` (words inside an
    occurrence of a window of `window` words, or of a shorter item), `items` (whose windows occur, sorted as
    text), `spans` (of the hit words, as code points of the original text, end exclusive) and `contaminated`:
    at least one word in `share` is hit.

    Null and empty texts have no words and are clean; null, empty and wordless items have no windows.  An item
    with a null id hits words but is not listed; repeated items count once.  Every row of `docs` is returned,
    repeated ones too; empty tables give none.  A long text is scanned as one.  A column of `docs` named
    `contamination` is replaced.  The driver and the executors have one block of at most `max_windows` windows at a
    time.  With one block texts are scanned as they are read; with more, rows are written once and each block
    scans their texts.  Runs jobs.
    """
    spark = docs.sparkSession
    carry = [c for c in (docs.columns if carry is None else carry) if c.lower() != "contamination"]
    blocks = _blocks(benchmark, item_id, item_text, window, max_windows)
    numbers = [r["block"] for r in blocks.select("block").distinct().orderBy("block").collect()]  # one a block
    frame = docs.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("scanned"))

    def items(block: int) -> list[tuple[str | None, str]]:
        return sorted(((r["item"], r["text"]) for r in blocks.where(F.col("block") == block).collect()), key=repr)

    def scanned(block: list[tuple[str | None, str]]) -> Callable[[pa.RecordBatch], Iterator[tuple[int, list[Found]]]]:
        sent = spark.sparkContext.broadcast(block)

        def scan(batch: pa.RecordBatch) -> Iterator[tuple[int, list[Found]]]:
            automaton = _automaton(sent.value, window)
            data, offsets = text_bytes(batch.column("scanned"))
            data = data.tobytes()
            for row in range(batch.num_rows):
                content = data[offsets[row] : offsets[row + 1]]
                words = normal_words(content)
                yield len(words), _found(content, automaton.matches(words))

        return scan

    if len(numbers) <= 1:
        scan = scanned(items(numbers[0]) if numbers else [])

        def whole(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                out = [_summary(n, found, share) for n, found in scan(batch)]
                yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(out, to_arrow_type(_RESULT))], names=["row", "contamination"])

        return frame.mapInArrow(whole, T.StructType([frame.schema["row"], T.StructField("contamination", _RESULT)])).select("row.*", "contamination")

    keyed = stage(frame.withColumn("key", F.monotonically_increasing_id()), "keyed")
    narrow = T.StructType([T.StructField("key", T.LongType()), T.StructField("n_words", T.LongType()), T.StructField("found", _FOUND)])
    scans = []
    for k, number in enumerate(numbers):

        def part(batches: Iterable[pa.RecordBatch], scan=scanned(items(number)), every=k == 0) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = [{"key": key, "n_words": n, "found": [dict(zip(("first", "end", "start", "stop", "item"), x, strict=True)) for x in found]}
                        for key, (n, found) in zip(batch.column("key").to_pylist(), scan(batch), strict=True) if found or every]
                yield pa.RecordBatch.from_pylist(rows, pa.schema([(f.name, to_arrow_type(f.dataType)) for f in narrow]))

        scans.append(stage(keyed.select("key", "scanned").mapInArrow(part, narrow), "scan"))

    def summed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[(x["first"], x["end"], x["start"], x["stop"], x["item"]) for x in xs] for xs in batch.column("found").to_pylist()]
            out = [_summary(n, xs, share) for n, xs in zip(batch.column("n_words").to_pylist(), found, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(out, to_arrow_type(_RESULT))], names=["key", "contamination"])

    together = reduce(DataFrame.union, scans).groupBy("key").agg(F.max("n_words").alias("n_words"), F.flatten(F.collect_list("found")).alias("found"))  # of one text
    results = together.mapInArrow(summed, T.StructType([T.StructField("key", T.LongType()), T.StructField("contamination", _RESULT)]))
    return keyed.select("key", "row").join(results.hint("shuffle_hash"), "key").select("row.*", "contamination")


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, unchanged and with all their columns, whatever their names; see
    `contamination` for nulls, repeated rows, long texts and empty tables."""
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("document"), F.col("text"))
    return contamination(whole, benchmark, carry=["document"]).where(~F.col("contamination.contaminated")).select("document.*")


# --- query


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), carry=["doc_id"])
    return found.select(
        "doc_id", "contamination.n_words", "contamination.n_hit", F.size("contamination.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("contamination.items", ",").cast("binary"), 256).alias("items_sha256"), "contamination.contaminated",
    )


OP10_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), i AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), iw AS (
  SELECT DISTINCT item_id, size, array_to_string(w[s:s + size - 1], ' ') AS k
  FROM (SELECT item_id, w, least(13, len(w)) AS size, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS s FROM i WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT size FROM iw),
dw AS (
  SELECT doc_id, s, size, array_to_string(w[s:s + size - 1], ' ') AS k
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS s FROM d, sizes WHERE len(w) >= size)
), hit AS (SELECT DISTINCT doc_id, s, size, item_id FROM dw JOIN iw USING (size, k)),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + size)) AS p FROM hit) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""
