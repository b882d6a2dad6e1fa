"""Word sequences that an earlier document has too, found by seeds and extended to their full length.

Seeds are winnowed anchors: of every window of `length` words the least hash of its `SEED`-word sequences, the
last among equals.  Equal windows choose equal anchors at equal places, so no repeat without a shared anchor.

1. Anchors are counted; those that occur once are out.  A Bloom filter of the others, of bounded size, goes to
   the executors.  Where it errs or is full, more seeds pass it and are sorted out later; none is lost.
2. The windows that chose one occurrence of an anchor are extended both ways to one stretch of words.  Occurrences
   with equal stretches form a class, and its members agree with the one in the smallest document all the
   way: no pairs among them are formed.
3. Only where an anchor has several classes, one member of each is compared window by window, by the smallest
   document of each window.
4. Overlapping stretches and windows join to maximal repeats.

Texts are shuffled only if they have a seed.  Keys that many documents share are aggregated before shuffles, and
joined as rows to small written tables, where skewed partitions are split.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm.common import SPACES, byte_hash, mix, row_bounds, sequence_hash, sequence_sums, sliding_min, steps, table, word_spans
from siltstone.sources.stage import stage

LENGTH = 50
SEED = 12
#: Bits of the filter of repeated anchors, at most: 32 MB for any number of documents.
MAX_BITS = 1 << 28
_PAGE = 18  # bits of a filter page, as a power of two
_PLACE = 28  # bits of a word's place in a step, for the choice among equal hashes


class _Words:
    """Words of some texts, their hashes, and the anchors that their windows choose."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, length: int, seeds: bool = True):
        self.starts, self.ends, self.rows = word_spans(data, offsets, SPACES)
        self.bounds = row_bounds(self.rows, len(offsets) - 1)
        self.length, total = length, len(self.rows)
        self.sums = sequence_sums(byte_hash(data, self.starts, self.ends))
        self.row = self.first = self.count = self.anchor = self.place = np.zeros(0, np.int64)
        if not seeds or total < length:
            return
        grams = sequence_hash(self.sums, np.arange(total - SEED + 1), SEED)
        low = np.uint64((1 << _PLACE) - 1)
        keys = (grams & ~low) | (low - np.arange(len(grams), dtype=np.uint64))
        chosen = (low - (sliding_min(keys, length - SEED + 1) & low)).astype(np.int64)  # of the window from each word
        window = np.flatnonzero(np.arange(length, total + 1) <= self.bounds[1:][self.rows[: total - length + 1]])
        chosen = chosen[window]
        # windows of one text that follow each other and choose the same anchor: one seed
        cut = np.flatnonzero(np.concatenate([[True], (chosen[1:] != chosen[:-1]) | (window[1:] != window[:-1] + 1)])) if len(window) else window
        self.first, self.place = window[cut], chosen[cut]
        self.count = np.diff(np.append(cut, len(window)))
        self.row, self.anchor = self.rows[self.first], grams[self.place]

    def classes(self) -> np.ndarray:
        """A hash of the stretch of each seed, and of where its anchor stands in it."""
        up_to = self.first + self.count + self.length - 1
        out = np.zeros(len(self.first), np.uint64)
        for size in np.unique(self.count):  # at most length - SEED + 1 sizes
            some = np.flatnonzero(self.count == size)
            out[some] = sequence_hash(self.sums, self.first[some], int(up_to[some[0]] - self.first[some[0]]))
        return mix(out ^ (self.place - self.first).astype(np.uint64))

    def windows(self, first: np.ndarray) -> np.ndarray:
        return sequence_hash(self.sums, first, self.length)


def _filter(repeated: DataFrame, n: int, max_bits: int) -> np.ndarray:
    """A Bloom filter with two bits an anchor, put together in pages by bits, so no task or group is large."""
    bits = min(max(1 << 20, 1 << int(16 * n).bit_length()), max_bits)
    word = F.col("anchor")
    pages = (
        repeated.select(F.explode(F.array(word.bitwiseAND(bits - 1), F.shiftright(word, 32).bitwiseAND(bits - 1))).alias("bit"))
        .select(F.shiftright("bit", _PAGE).alias("page"), F.col("bit").bitwiseAND((1 << _PAGE) - 1).alias("at")).distinct().repartition("page")
    )

    def collect(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            page, at = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("page", "at"))
            for p in np.unique(page).tolist():
                held.setdefault(p, np.zeros(1 << _PAGE, bool))[at[page == p]] = True
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int64()), pa.array([np.packbits(x, bitorder="little").tobytes() for x in held.values()], pa.binary())], names=["page", "bits"])

    out = np.zeros(bits // 8, np.uint8)
    for row in pages.mapInArrow(collect, "page long, bits binary").collect():  # max_bits / 8 bytes at most
        out[row["page"] << _PAGE - 3 : row["page"] + 1 << _PAGE - 3] = np.frombuffer(row["bits"], np.uint8)
    return out


def _passes(bloom: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    bits = np.uint64(8 * len(bloom) - 1)
    out = np.ones(len(anchors), bool)
    for at in (anchors & bits, (anchors >> np.uint64(32)) & bits):
        out &= (bloom[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
    return out


def _seeds(docs: DataFrame, length: int, max_bits: int, texts: bool) -> DataFrame:
    """Every row with its words and, if it has anchors that occur elsewhere, its seeds and text; else its digest."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in steps(batch):
                words = _Words(data, offsets, length)
                known = ~np.asarray(part.column("doc_id").is_null().to_numpy(zero_copy_only=False))
                some = known[words.row]
                order = np.lexsort((words.anchor[some], words.row[some]))
                row, anchor = words.row[some][order], words.anchor[some][order]
                new = np.concatenate([[True], (row[1:] != row[:-1]) | (anchor[1:] != anchor[:-1])]) if len(row) else np.zeros(0, bool)
                yield pa.RecordBatch.from_arrays([pa.array(anchor[new].view(np.int64))], names=["anchor"])

    repeated = stage(docs.mapInArrow(count, "anchor long").groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor"), "anchors")
    bloom = docs.sparkSession.sparkContext.broadcast(_filter(repeated, repeated.count(), max_bits))

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in steps(batch):
                words = _Words(data, offsets, length)
                known = ~np.asarray(part.column("doc_id").is_null().to_numpy(zero_copy_only=False))
                some = np.flatnonzero(_passes(bloom.value, words.anchor.view(np.uint64)) & known[words.row])
                of_row = np.searchsorted(words.row[some], np.arange(part.num_rows + 1))
                has = np.diff(of_row) > 0
                seeds = pa.StructArray.from_arrays(
                    [pa.array(words.anchor[some].view(np.int64)), pa.array(words.classes()[some].view(np.int64)),
                     pa.array((words.first - words.bounds[words.row])[some].astype(np.int64)), pa.array(words.count[some].astype(np.int64))],
                    names=["anchor", "class", "first", "count"],
                )
                raw = data.tobytes()
                digests = [None if h else hashlib.sha256(_joined(raw[offsets[k] : offsets[k + 1]])).hexdigest() for k, h in enumerate(has.tolist())]
                kept = part.column("text") if texts else pa.array(np.where(has, np.array(part.column("text").to_pylist(), object), None), pa.string())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(np.diff(words.bounds)), pa.array(digests, pa.string()), kept, pa.ListArray.from_arrays(pa.array(of_row.astype(np.int32)), seeds)],
                    names=["doc_id", "n_words", "digest", "text", "seeds"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    found = docs.mapInArrow(find, f"doc_id {kind}, n_words long, digest string, text string, seeds array<struct<anchor:bigint,class:bigint,first:bigint,count:bigint>>")
    return stage(found.withColumn("row", F.monotonically_increasing_id()), "seeded")


def _joined(text: bytes) -> bytes:
    """The words with one space between them; bytes.split parts at the same bytes as the words here."""
    return b" ".join(text.split())


def _windows(wanted: DataFrame, length: int) -> DataFrame:
    """The windows of the wanted seeds: columns row, doc_id, text and seeds become row, doc_id, anchor, window, first."""
    kind = wanted.schema["doc_id"].dataType.simpleString()

    def spell(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in steps(batch):
                words = _Words(data, offsets, length, seeds=False)
                seeds = part.column("seeds")
                row = np.repeat(np.arange(part.num_rows), np.asarray(seeds.value_lengths()))
                anchor, first, count = (seeds.flatten().field(c).to_numpy() for c in range(3))
                each = np.repeat(np.arange(len(row)), count)
                at = first[each] + np.arange(len(each)) - np.repeat(np.cumsum(count) - count, count)
                hashes = words.windows(words.bounds[row[each]] + at)
                rows = pa.array(row[each])
                yield pa.RecordBatch.from_arrays(
                    [part.column("row").take(rows), part.column("doc_id").take(rows), pa.array(anchor[each]), pa.array(hashes.view(np.int64)), pa.array(at)],
                    names=["row", "doc_id", "anchor", "window", "first"],
                )

    return wanted.select("row", "doc_id", "text", "seeds").mapInArrow(spell, f"row long, doc_id {kind}, anchor long, window long, first long")


def remove_repeats(docs: DataFrame, length: int = LENGTH, texts: bool = True, doc_id: str = "doc_id", text: str = "text", max_bits: int = MAX_BITS) -> DataFrame:
    """For every row of `docs`: `doc_id`, `n_words`, `spans` (first and end word of each maximal repeat, by first),
    `kept` (the other words, one space between them; left out without `texts`) and `kept_sha256`.

    A word is in a span if a window of `length` words over it also starts in a document with a smaller id.
    Windows are those of the texts as they came.  Words are runs of anything but ASCII white space, unchanged.  Null
    and short texts have no windows.  A row with a null id stays whole and makes no other row lose words.  Rows
    with equal ids do not affect each other.  Other columns are ignored.  Runs jobs.
    """
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    rows = _seeds(narrow, length, max_bits, texts)
    seeds = rows.where(F.size("seeds") > 0).select("row", "doc_id", F.inline("seeds"))

    # the written tables give each join an exchange of its own on both sides, whose hot partitions can be split
    classes = stage(seeds.groupBy("anchor", "class").agg(F.min("doc_id").alias("class_id")), "classes")
    anchors = stage(classes.groupBy("anchor").agg(F.count("*").alias("classes")).where("classes > 1"), "split-anchors")
    classes = stage(classes.join(anchors, "anchor", "left"), "all-classes")
    known = seeds.join(classes, ["anchor", "class"])
    whole = known.where("doc_id > class_id").select("row", "first", (F.col("first") + F.col("count") + (length - 1)).alias("end"))

    asked = known.where("doc_id = class_id and classes > 1").groupBy("row").agg(F.collect_list(F.struct("anchor", "first", "count")).alias("wanted"))  # of one text
    wanted = rows.select("row", "doc_id", "text").join(asked.withColumnRenamed("wanted", "seeds"), "row")
    windows = stage(_windows(wanted, length), "windows")
    least = stage(windows.groupBy("anchor", "window").agg(F.min("doc_id").alias("least_id"), F.max("doc_id").alias("most_id")).where("least_id < most_id").drop("most_id"), "least")
    single = windows.join(least, ["anchor", "window"]).where("doc_id > least_id").select("row", "first", (F.col("first") + length).alias("end"))

    ranges = whole.union(single).groupBy("row").agg(F.sort_array(F.collect_set(F.struct("first", "end"))).alias("ranges"))  # of one text
    touched = rows.where(F.size("seeds") > 0).select("row", "doc_id", "n_words", "text").join(ranges, "row", "left")
    touched = touched.select("doc_id", "n_words", "text", F.coalesce("ranges", F.array().cast("array<struct<first:bigint,end:bigint>>")).alias("ranges"))
    others = rows.where(F.size("seeds") == 0).select(
        "doc_id", "n_words", F.array().cast("array<struct<first:bigint,end:bigint>>").alias("spans"), F.col("text").alias("kept"), F.col("digest").alias("kept_sha256")
    )
    kind = narrow.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, kept, digests = [], [], []
            for content, ranges in zip(batch.column("text"), batch.column("ranges").to_pylist(), strict=True):
                words = content.as_py().encode().split()
                joined: list[dict] = []
                for r in ranges:
                    if joined and r["first"] <= joined[-1]["end"]:
                        joined[-1]["end"] = max(joined[-1]["end"], r["end"])
                    else:
                        joined.append(dict(r))
                bounds = [0, *[x for r in joined for x in (r["first"], r["end"])], len(words)]
                rest = b" ".join([w for a, b in zip(bounds[::2], bounds[1::2], strict=True) for w in words[a:b]])
                spans.append(joined)
                kept.append(rest.decode() if texts else None)
                digests.append(hashlib.sha256(rest).hexdigest())
            kinds = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_words"), pa.array(spans, kinds), pa.array(kept, pa.string()), pa.array(digests, pa.string())],
                names=["doc_id", "n_words", "spans", "kept", "kept_sha256"],
            )

    done = touched.mapInArrow(cut, f"doc_id {kind}, n_words long, spans array<struct<first:bigint,end:bigint>>, kept string, kept_sha256 string")
    if texts:  # untouched texts keep all words; only their white space is evened out
        plain = F.trim(F.regexp_replace("kept", r"[\x20\x09-\x0D]+", " "))
        others = others.withColumn("kept", plain)
    out = done.union(others)
    return out if texts else out.drop("kept")


# --- query


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(table(spark, sf_dir, "documents"), texts=False)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["first"])
    return found.select("doc_id", "n_words", removed.alias("n_removed"), "kept_sha256")


OP3_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, s, md5(array_to_string(w[s + 1:s + 50], ' ')) AS k
  FROM (SELECT doc_id, w, unnest(range(0, len(w) - 49)) AS s FROM d WHERE len(w) >= 50)
), least AS (SELECT k, min(doc_id) AS least_id FROM windows GROUP BY k HAVING min(doc_id) < max(doc_id)),
hits AS (SELECT DISTINCT doc_id, unnest(range(s, s + 50)) AS p FROM windows JOIN least USING (k) WHERE doc_id > least_id),
removed AS (SELECT doc_id, list(p) AS ps, count(*) AS n FROM hits GROUP BY doc_id),
kept AS (
  SELECT doc_id, string_agg(w[p + 1], ' ' ORDER BY p) AS kept
  FROM (SELECT doc_id, w, unnest(range(0, len(w))) AS p FROM d WHERE doc_id IN (SELECT doc_id FROM removed)) x
  WHERE NOT EXISTS (SELECT 1 FROM hits h WHERE h.doc_id = x.doc_id AND h.p = x.p) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n, 0) AS n_removed,
  sha256(CASE WHEN n IS NULL THEN array_to_string(w, ' ') ELSE coalesce(kept, '') END) AS kept_sha256
FROM d LEFT JOIN removed USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
