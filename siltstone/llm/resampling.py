"""Importance resampling towards a target: documents that look like the target's texts are drawn more often.

A text's features are its runs of consecutive words, hashed by CRC-32 to buckets.  The words of a text are laid
out with one space between them and scanned once, which leaves the running CRC after every byte.  The CRC of any
run of words then follows from two of these: advancing the earlier one over the run's bytes is a linear map over
GF(2), and adding it cancels all that came before the run.  So no run is built or scanned on its own, however
long runs are.

The share of each bucket among the target's features against its share among all features is the bucket's
gain.  A document's weight is the mean of its features' gains; Gumbel noise, fixed by its id, is added, and the
highest scores are drawn, which samples without replacement in proportion to the weights' exponentials.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm.common import LOWER, MARKS, row_bounds, steps, table, text_pieces, word_spans
from siltstone.sources.stage import stage

LONGEST = 2  # words of a feature
BUCKETS = 10_000
LEAST_WORDS = 20  # of a document that may be drawn
PERCENT = 25  # of those that are
SEED = 7

# --- running CRCs

#: Fixed value: the polynomial of CRC-32, its highest power in the lowest bit.
_POLYNOMIAL = 0xEDB88320
_ONES = np.uint32(0xFFFFFFFF)
#: Bytes that are scanned one after the other; blocks of them are scanned side by side.
_BLOCK_BITS = 6


def _byte_table() -> np.ndarray:
    x = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        x = np.where(x & 1, x >> np.uint32(1) ^ np.uint32(_POLYNOMIAL), x >> np.uint32(1))
    return x


_BYTE = _byte_table()


class _Shifts:
    """Advancing a register over `2**k` zero bytes, for each k a linear map kept as four tables of a byte each."""

    def __init__(self):
        self.tables: list[np.ndarray] = []
        basis = np.uint32(1) << np.arange(32, dtype=np.uint32)
        self.images = _BYTE[basis & np.uint32(255)] ^ basis >> np.uint32(8)

    def _table(self, k: int) -> np.ndarray:
        while len(self.tables) <= k:
            bits = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(bool)
            found = np.stack([np.bitwise_xor.reduce(np.where(bits, self.images[8 * j : 8 * j + 8], np.uint32(0)), axis=1) for j in range(4)])
            self.tables.append(found)
            self.images = self.once(len(self.tables) - 1, self.images)
        return self.tables[k]

    def once(self, k: int, x: np.ndarray) -> np.ndarray:
        t = self._table(k)
        return t[0][x & np.uint32(255)] ^ t[1][x >> np.uint32(8) & np.uint32(255)] ^ t[2][x >> np.uint32(16) & np.uint32(255)] ^ t[3][x >> np.uint32(24)]

    def by(self, x: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Each register advanced over as many bytes as its size says."""
        x = x.copy()
        for k in range(int(sizes.max(initial=0)).bit_length()):
            chosen = np.flatnonzero(sizes >> k & 1)
            x[chosen] = self.once(k, x[chosen])
        return x


_SHIFTS = _Shifts()


def running_crc(data: np.ndarray) -> np.ndarray:
    """The CRC register, begun at zero and not inverted, before the first byte and after each."""
    block = 1 << _BLOCK_BITS
    n = -(-len(data) // block)
    columns = np.zeros(n * block, np.uint8)
    columns[: len(data)] = data
    columns = np.ascontiguousarray(columns.reshape(n, block).T)

    def scan(register: np.ndarray) -> Iterator[np.ndarray]:
        for column in columns:
            register = _BYTE[register.astype(np.uint8) ^ column] ^ register >> np.uint32(8)
            yield register

    through = np.zeros(n, np.uint32)  # registers after each block, first by the block alone
    for through in scan(through):  # noqa: B020
        pass
    k = 0
    while 1 << k < n:  # then by all blocks before it
        reach = 1 << k
        through = np.concatenate([through[:reach], through[reach:] ^ _SHIFTS.once(_BLOCK_BITS + k, through[:-reach])])
        k += 1
    out = np.empty((n, block), np.uint32)
    for j, register in enumerate(scan(np.concatenate([np.zeros(min(n, 1), np.uint32), through[:-1]]))):
        out[:, j] = register
    return np.concatenate([np.zeros(1, np.uint32), out.ravel()[: len(data)]])


def range_crc(running: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 as commonly defined of each byte range, from the running registers alone."""
    return running[ends] ^ _SHIFTS.by(running[starts] ^ _ONES, ends - starts) ^ _ONES


# --- features


def _runs(data: np.ndarray, offsets: np.ndarray, longest: int, known: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of words of each row, and the CRCs of all runs of 1 to `longest` words, by row, with the bounds of
    the rows.  Runs inside the first `known` words of the first row are left out."""
    n = len(offsets) - 1
    starts, ends, rows = word_spans(data, offsets, MARKS)
    inside = ~MARKS[data]
    inside[ends[ends < len(data)]] = True  # one separator after each word
    text = np.where(MARKS[data], np.uint8(0x20), LOWER[data])[inside]
    place = np.cumsum(inside) - 1
    sizes = ends - starts
    starts = place[starts] if len(starts) else starts
    ends = starts + sizes
    running = running_crc(text)
    words = np.diff(row_bounds(rows, n))
    counts = np.stack([np.maximum(words - k, 0) for k in range(longest)])
    if known:
        counts[:, 0] -= np.maximum(known - np.arange(longest), 0)
    counts = np.maximum(counts, 0)
    bounds = np.concatenate([[0], np.cumsum(counts.sum(axis=0))])
    begins = bounds[:-1] + np.cumsum(counts, axis=0) - counts  # where a row's runs of each length go
    out = np.empty(bounds[-1], np.uint32)
    for k in range(longest):
        first = np.flatnonzero(rows[: max(len(rows) - k, 0)] == rows[k:])
        first = first[(rows[first] > 0) | (first + k >= known)]
        row = rows[first]
        within = np.arange(len(first)) - np.searchsorted(row, row)
        out[begins[k][row] + within] = range_crc(running, starts[first], ends[first + k])
    return words, out, bounds


def hashed_features(docs: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`doc_id`, `n_words` and `features`, the buckets of all runs of 1 to `longest` words, repeats included.

    A-Z are lower-cased; words are runs of ASCII letters, digits and all other characters beyond ASCII.  Null
    and empty texts have none.  Every row of `docs` is returned, repeated ones too; other columns are ignored.
    Very long texts are scanned in pieces of some megabytes, which end between words.
    """
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))

    def features(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in steps(batch):
                if part.num_rows > 1:
                    words, crcs, bounds = _runs(data, offsets, longest)
                else:
                    found = [
                        (*_runs(piece, np.array([0, len(piece)]), longest, known)[:2], known) for piece, known in text_pieces(data, MARKS, longest - 1)
                    ]
                    words = np.array([sum(int(w[0]) - known for w, _, known in found)])
                    crcs = np.concatenate([np.zeros(0, np.uint32), *[c for _, c, _ in found]])
                    bounds = np.array([0, len(crcs)])
                lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array((crcs % np.uint32(buckets)).astype(np.int32)))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(words.astype(np.int64)), lists], names=["doc_id", "n_words", "features"])

    return narrow.mapInArrow(features, f"doc_id {narrow.schema['doc_id'].dataType.simpleString()}, n_words long, features array<int>")


def bucket_counts(features: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """`bucket` and `n`, for buckets that have features.  Each task sends one row a bucket at most."""

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            total += np.bincount(batch.column("features").flatten().to_numpy(zero_copy_only=False), minlength=buckets)
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(total[there])], names=["bucket", "n"])

    return features.select("features").mapInArrow(counted, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """`bucket` and `gain`, a thousand times the logarithm of the bucket's share among the target's features over
    that among the source's, floored, with one more feature in every bucket of either.  Takes `bucket_counts` of
    both; every bucket has a row."""
    every = source.sparkSession.range(buckets).select(F.col("id").alias("bucket"))
    both = every.join(F.broadcast(source.withColumnRenamed("n", "s")), "bucket", "left").join(F.broadcast(target.withColumnRenamed("n", "t")), "bucket", "left")
    sums = [df.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"] for df in (source, target)]
    s, t = (F.coalesce(F.col(c), F.lit(0)).cast("double") for c in ("s", "t"))
    all_s, all_t = (F.lit(float(n + buckets)) for n in sums)
    return both.select("bucket", F.floor(1000 * F.ln((t + 1) * all_s / ((s + 1) * all_t))).alias("gain"))


def weights(features: DataFrame, gain: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """`doc_id`, `n_words`, `n_features` and `weight`, the floored mean of the gains of a row's features; 0 without
    any.  The gains, one number a bucket, are sent to all tasks."""
    found = np.zeros(buckets, np.int64)
    for row in gain.collect():  # as many as buckets
        found[row["bucket"]] = row["gain"]
    sent = features.sparkSession.sparkContext.broadcast(found)

    def weighed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("features")
            bounds = lists.offsets.to_numpy()
            sums = np.concatenate([[0], np.cumsum(sent.value[lists.flatten().to_numpy(zero_copy_only=False)])])
            bounds = bounds - bounds[0]
            n = np.diff(bounds)
            mean = np.where(n > 0, (sums[bounds[1:]] - sums[bounds[:-1]]) // np.maximum(n, 1), 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_words"), pa.array(n.astype(np.int64)), pa.array(mean)], names=["doc_id", "n_words", "n_features", "weight"]
            )

    return features.mapInArrow(weighed, f"doc_id {features.schema['doc_id'].dataType.simpleString()}, n_words long, n_features long, weight long")


# --- drawing


def draw(weighed: DataFrame, least_words: int = LEAST_WORDS, percent: int = PERCENT, seed: int = SEED) -> DataFrame:
    """The rows of `weights` with `score`, weight and noise together, and `rank`, from 1 on, of those drawn: of
    rows with at least `least_words` words, `percent` in a hundred, rounded down, with the highest scores.

    Ties go to the smaller id, null ids last; rows that are equal in that too are taken in the order they were
    written.  The noise depends on the id and the seed alone, a null id counting as empty text.  Rows are dealt by
    ranges of score, id and a number of their own, so no key is too large for a task.  Runs jobs.
    """
    spark = weighed.sparkSession
    noise = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256), 1, 8), 16, 10).cast("double")
    gumbel = F.floor(-1000 * F.ln(-F.ln((noise + 0.5) / 4294967296.0)))
    scored = stage(weighed.withColumns({"score": F.col("weight") + gumbel, "may": F.col("n_words") >= least_words, "row": F.monotonically_increasing_id()}), "scored")
    most = scored.where("may").count() * percent // 100
    order = [F.desc("may"), F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("row")]
    # the number says which range a row is in, in its upper bits, and how many of the range come before it
    placed = stage(scored.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()), "placed")
    ranges = placed.groupBy(F.shiftright("at", 33).alias("range")).agg(F.count("*").alias("n")).orderBy("range").collect()  # as many as partitions
    before, places = 0, []
    for r in ranges:
        places.append((r["range"], before))
        before += r["n"]
    known = F.broadcast(spark.createDataFrame(places, "range long, before long"))
    rank = F.col("before") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return (
        placed.withColumn("range", F.shiftright("at", 33)).join(known, "range")
        .select("doc_id", "n_words", "n_features", "weight", "score", F.when(F.col("may") & (rank <= most), rank).alias("rank"))
    )


def resample(
    docs: DataFrame, target: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS, least_words: int = LEAST_WORDS, percent: int = PERCENT, seed: int = SEED,
    doc_id: str = "doc_id", text: str = "text", target_text: str = "text",
) -> DataFrame:
    """Every row of `docs` by id, with `n_words`, `n_features`, `weight`, `score` and `rank` (null if not drawn); see
    `hashed_features`, `gains`, `weights` and `draw`.

    An empty target or an empty corpus has no features, which leaves the gains to the added ones.  Each text is
    read once; its features, four bytes each, are written to the shared folder.  Runs jobs.
    """
    features = stage(hashed_features(docs, longest, buckets, doc_id, text), "features")
    wanted = target.select(F.lit(0).alias("target"), F.col(target_text).alias("text"))
    found = stage(bucket_counts(features, buckets), "source-counts")
    aimed = stage(bucket_counts(hashed_features(wanted, longest, buckets, "target"), buckets), "target-counts")
    return draw(weights(features, gains(found, aimed, buckets), buckets), least_words, percent, seed)


# --- query


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


def _sql() -> str:
    """The same in SQL.  CRCs are taken of whole runs there, four bits at a time."""

    def four(x: int) -> int:
        for _ in range(4):
            x = x >> 1 ^ (_POLYNOMIAL if x & 1 else 0)
        return x

    step = "c >> 4"  # the register is linear in each of the four bits that leave it
    for k in range(4):
        step = f"xor({step}, (xor(c, v) >> {k} & 1) * {four(1 << k)})"

    def split(relation: str, key: str) -> str:
        return f"""SELECT {key} AS id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM {relation}"""

    def runs(relation: str) -> str:
        nexts = " || ' ' || ".join(["word", *[f"lead(word, {k}) OVER along" for k in range(1, LONGEST)]])
        shorter = [f"SELECT id, {' || '.join(nexts.split(' || ')[: 2 * k - 1])} AS run FROM words WINDOW along AS (PARTITION BY id ORDER BY i)" for k in range(1, LONGEST + 1)]
        return f"""WITH words AS (SELECT id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM {relation})
  SELECT id, run FROM ({" UNION ALL ".join(shorter)}) WHERE run IS NOT NULL"""

    return f"""
WITH d AS MATERIALIZED ({split("documents", "doc_id")}), b AS MATERIALIZED ({split("benchmark", "item_id")}),
source_runs AS MATERIALIZED ({runs("d")}), target_runs AS MATERIALIZED ({runs("b")}),
every_run AS MATERIALIZED (SELECT run FROM source_runs UNION SELECT run FROM target_runs),
halves AS MATERIALIZED (
  SELECT run, list_transform(range(length(h)), lambda i: (instr('0123456789ABCDEF', h[i + 2 - 2 * (i % 2)]) - 1)::BIGINT) AS x FROM (SELECT run, hex(encode(run)) AS h FROM every_run)
), buckets AS MATERIALIZED (
  SELECT run, xor(list_reduce(list_prepend(4294967295::BIGINT, x), lambda c, v: {step}), 4294967295) % {BUCKETS} AS bucket FROM halves
), source AS (SELECT bucket, count(*) AS s FROM source_runs JOIN buckets USING (run) GROUP BY bucket),
target AS (SELECT bucket, count(*) AS t FROM target_runs JOIN buckets USING (run) GROUP BY bucket),
sums AS (SELECT coalesce((SELECT sum(s) FROM source), 0)::DOUBLE AS all_s, coalesce((SELECT sum(t) FROM target), 0)::DOUBLE AS all_t),
gains AS (
  SELECT bucket, floor(1000 * ln((coalesce(t, 0)::DOUBLE + 1) * (all_s + {BUCKETS}) / ((s::DOUBLE + 1) * (all_t + {BUCKETS}))))::BIGINT AS gain
  FROM source LEFT JOIN target USING (bucket), sums
), means AS (
  SELECT id, count(*) AS n_features, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight FROM source_runs JOIN buckets USING (run) JOIN gains USING (bucket) GROUP BY id
), scored AS (
  SELECT d.id AS doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('{SEED}:' || d.id), 1, 8))::BIGINT::DOUBLE + 0.5) / 4294967296)))::BIGINT AS score
  FROM d LEFT JOIN means USING (id)
), ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM scored WHERE n_words >= {LEAST_WORDS})
SELECT doc_id, n_features, weight, score, CASE WHEN place <= {PERCENT} * n // 100 THEN place END AS rank FROM scored LEFT JOIN ranked USING (doc_id)
"""


OP13_SQL = _sql()
