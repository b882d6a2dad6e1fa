"""How filters act on each other: what each removes, given which others came before it, over all orders.

Words are counted in a sparse document-term matrix in compressed rows.  A task cuts its documents to shards of some
megabytes of text and numbers the words of each shard.  The shards' vocabularies, far smaller than the texts, are
dealt by slices of a hash of the words; each slice numbers its words in one dictionary, and the numbers go back to
the shards, whose columns they are in the whole matrix.  The sums of the matrix's rows are the numbers of words,
their non-zero entries the numbers of different words.

Which filters a document fails is a pattern of bits.  Documents are counted by pattern, part and label first; the
effect of every filter in every order follows from these few counts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from siltstone.llm.common import SPACES, byte_hash, table, text_bytes, text_pieces, word_spans
from siltstone.sources.stage import stage

FILTERS = "ABCDE"
SHARD_BYTES = 4 << 20  # of text; a longer text is a shard of its own
WORDS_BYTES = 512 << 10  # of text whose words are found together
HASHED_WORDS = 1 << 14  # together
#: Rows go to Python some megabytes at a time, a longer row alone; by default 10,000 texts or 64 MB go together.
SMALL_BATCHES = {"spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20)}
#: Each row is written as a row group: Spark's reader unpacks all rows of a row group that fit in a batch of 4,096.
ONE_A_GROUP = {"parquet.block.row.count.limit": "1"}


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """For the jobs that are run inside; then the session's are as they were."""
    before = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


# --- the matrix


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The words, numbered in the order they are met, and their rows."""
    starts, ends, rows = word_spans(data, offsets, SPACES)
    bounds = np.concatenate([[0], np.cumsum(ends - starts)])
    kind, width = (pa.string(), np.int32) if bounds[-1] < 1 << 31 else (pa.large_string(), np.int64)
    words = pa.Array.from_buffers(kind, len(starts), [None, pa.py_buffer(bounds.astype(width)), pa.py_buffer(data[~SPACES[data]])])
    return words.dictionary_encode(), rows


def _found(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[pa.DictionaryArray, np.ndarray]]:
    """The words and their rows of one piece of the texts after the other, so that little memory is needed at a time."""
    first = 0
    while first < len(offsets) - 1:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + WORDS_BYTES, side="right")) - 1)
        texts = data[offsets[first] : offsets[last]]
        if last == first + 1:
            pieces = ((piece, np.array([0, len(piece)])) for piece, _ in text_pieces(texts, SPACES, piece_bytes=WORDS_BYTES))
        else:
            pieces = ((texts, offsets[first : last + 1] - offsets[first]),)
        for piece, bounds in pieces:
            words, rows = _words(piece, bounds)
            yield words.cast(pa.dictionary(pa.int32(), pa.string())), (rows + first).astype(np.int32)
        first = last


def _shard(data: np.ndarray, offsets: np.ndarray, slices: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array, np.ndarray]:
    """Row bounds, columns, counts and vocabulary of the texts of one shard; the vocabulary by slices, with their bounds."""
    n = len(offsets) - 1
    found = list(_found(data, offsets))
    chunks = pa.chunked_array([w for w, _ in found]).unify_dictionaries().chunks
    vocabulary = chunks[0].dictionary
    letters, bounds = text_bytes(vocabulary)
    hashes = [byte_hash(letters[b[0] : b[-1]], b[:-1] - b[0], b[1:] - b[0]) for k in range(0, len(vocabulary), HASHED_WORDS) for b in [bounds[k : k + HASHED_WORDS + 1]]]
    sliced = (np.concatenate([np.zeros(0, np.uint64), *hashes]) % np.uint64(slices)).astype(np.int64)
    order = np.argsort(sliced, kind="stable")
    number = np.empty(len(order), np.int64)
    number[order] = np.arange(len(order))
    width = max(len(order), 1)
    cells = np.concatenate([np.zeros(0, np.int64), *[rows.astype(np.int64) * width + number[c.indices.to_numpy()] for c, (_, rows) in zip(chunks, found, strict=True)]])
    cells.sort()
    firsts = np.flatnonzero(np.diff(cells, prepend=-1))
    counts = np.diff(firsts, append=len(cells))
    rows, columns = np.divmod(cells[firsts], width)
    return np.searchsorted(rows, np.arange(n + 1)), columns, counts, vocabulary.take(pa.array(order)), np.searchsorted(sliced[order], np.arange(slices + 1))


_INTS = T.ArrayType(T.IntegerType())
_SHARDS = {"indptr": _INTS, "gaps": _INTS, "counts": _INTS, "words": T.ArrayType(T.StringType())}


def _list(values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


Measure = Callable[[np.ndarray, np.ndarray], np.ndarray]


def shards(docs: DataFrame, carry: list[str], text: str = "text", measures: dict[str, Measure] | None = None, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Compressed rows of the words (runs of anything but ASCII white space) of each shard: `shard`, `docs` (a struct
    a row, of the columns `carry` and of the `measures`, whole numbers a text), `indptr`, `gaps` (each index less
    the one before, small numbers that pack well), `counts` and `words`, the words that the indices number, one text of
    words with a space between them for each of as many slices as shuffles have partitions.  Null texts are empty rows.  No row of `docs` is left out."""
    measures = measures or {}
    slices = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    narrow = docs.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    kind = T.StructType([*narrow.schema["row"].dataType.fields, *[T.StructField(m, T.LongType()) for m in measures]])
    schema = T.StructType([T.StructField("shard", T.LongType()), T.StructField("docs", T.ArrayType(kind)), *[T.StructField(c, t) for c, t in _SHARDS.items()]])

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        for part, data, offsets in _of_bytes(batches, shard_bytes):
            indptr, indices, counts, words, bounds = _shard(data, offsets, slices)
            row = part.column("row")
            values = [*row.flatten(), *[pa.array(measure(data, offsets).astype(np.int64)) for measure in measures.values()]]
            rows = pa.StructArray.from_arrays(values, fields=list(to_arrow_type(kind)))
            columns = [pa.array([number]), _list(rows), *[_list(pa.array(x.astype(np.int32))) for x in (indptr, np.diff(indices, prepend=0), counts)], _list(pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), words), " "))]
            yield pa.RecordBatch.from_arrays([c.cast(to_arrow_type(f.dataType)) for c, f in zip(columns, schema, strict=True)], names=schema.names)
            number += 1

    return narrow.mapInArrow(cut, schema)


def _of_bytes(batches: Iterable[pa.RecordBatch], most: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Rows of one or several batches together, up to `most` bytes of text or one row, with bytes and offsets."""
    held: list[pa.RecordBatch] = []
    size = 0

    def joined() -> tuple[pa.RecordBatch, np.ndarray, np.ndarray]:
        batch = held[0] if len(held) == 1 else pa.concat_batches(held)
        return batch, *text_bytes(batch.column("text"))

    for batch in batches:
        sizes = np.diff(text_bytes(batch.column("text"))[1])
        first = 0
        for row, n in enumerate(sizes.tolist()):
            if size + n > most and (held or row > first):
                if row > first:
                    held.append(batch.slice(first, row - first))
                yield joined()
                held, size, first = [], 0, row
            size += n
        if first < batch.num_rows:
            held.append(batch.slice(first))
    if held:
        yield joined()


def _numbered(with_words: bool) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Numbers of the words of each row, from one dictionary a slice; rows come by slice.  Or, `with_words`, the words
    that no row of the slice before has, and the number of the first."""

    def number(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, known = None, {}
        for batch in batches:
            numbers, firsts, new = [], [], []
            for at, words in zip(batch.column("slice").to_pylist(), batch.column("words").to_pylist(), strict=True):
                if at != current:
                    current, known = at, {}
                firsts.append(len(known))
                words = words.split(" ")
                numbers.append(np.array([known.setdefault(w, len(known)) for w in words], np.int32))
                if with_words:
                    new.append([w for w, n in zip(words, numbers[-1].tolist(), strict=True) if n >= firsts[-1]])
            if with_words:
                yield pa.RecordBatch.from_arrays([batch.column("slice"), pa.array(firsts, pa.int64()), pa.array(new, pa.list_(pa.string()))], names=["slice", "first", "new"])
            else:
                bounds = pa.array(np.cumsum([0, *map(len, numbers)]).astype(np.int32))
                lists = pa.ListArray.from_arrays(bounds, pa.array(np.concatenate([np.zeros(0, np.int32), *numbers])))
                yield pa.RecordBatch.from_arrays([batch.column("shard"), batch.column("slice"), lists], names=["shard", "slice", "numbers"])

    return number


def term_matrix(cut: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Written `shards` as shards of one matrix, and its dictionary.

    The dictionary has each `word` of all texts once with its `id`; slices are of about one size, so hardly any
    numbers are left out.  The matrix has `shard`, `docs`, `indptr`, `indices` (ids) and `counts`.  A shard's
    vocabulary brings each word once however often it stands there, so a word that is everywhere comes once a
    shard.  A task holds the different words of one slice.
    """
    words = cut.select("shard", F.posexplode("words").alias("slice", "words")).where("words <> ''")
    slices = int(cut.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = words.repartition(slices, "slice").sortWithinPartitions("slice", "shard")
    new = dealt.mapInArrow(_numbered(True), "slice int, first long, new array<string>").select("slice", "first", F.posexplode("new").alias("at", "word"))
    dictionary = new.select("word", ((F.col("first") + F.col("at")) * slices + F.col("slice")).alias("id"))
    numbered = dealt.mapInArrow(_numbered(False), "shard long, slice int, numbers array<int>")
    parts = numbered.groupBy("shard").agg(F.array_sort(F.collect_list(F.struct("slice", "numbers"))).alias("parts"))  # of one shard
    ids = F.transform("parts", lambda p: F.transform(p["numbers"], lambda n: n.cast("long") * slices + p["slice"]))
    renumbered = parts.select("shard", F.flatten(ids).alias("ids"))
    joined = cut.drop("words").join(renumbered.hint("shuffle_hash"), "shard", "left")  # which spares sorting the rows of the matrix
    matrix_type = T.StructType([cut.schema["shard"], cut.schema["docs"], cut.schema["indptr"], T.StructField("indices", T.ArrayType(T.LongType())), cut.schema["counts"]])

    def named(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                one = batch.slice(k, 1)
                ids = one.column("ids").flatten()
                at = np.cumsum(one.column("gaps").flatten().to_numpy(), dtype=np.int64)
                indices = _list(pa.array(ids.to_numpy()[at] if len(at) else at))
                columns = [one.column("shard"), one.column("docs"), one.column("indptr"), indices, one.column("counts")]
                yield pa.RecordBatch.from_arrays([c.cast(to_arrow_type(f.dataType)) for c, f in zip(columns, matrix_type, strict=True)], names=matrix_type.names)

    return joined.mapInArrow(named, matrix_type), dictionary


def row_totals(matrix: DataFrame) -> DataFrame:
    """The columns of `docs`, one row a document, with `n_words` (its row's sum) and `n_different` (its entries)."""
    kind = matrix.schema["docs"].dataType.elementType
    schema = T.StructType([*kind.fields, T.StructField("n_words", T.LongType()), T.StructField("n_different", T.LongType())])

    def totals(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                one = batch.slice(k, 1)
                bounds = one.column("indptr").flatten().to_numpy()
                sums = np.concatenate([[0], np.cumsum(one.column("counts").flatten().to_numpy().astype(np.int64))])
                columns = [*one.column("docs").flatten().flatten(), pa.array(sums[bounds[1:]] - sums[bounds[:-1]]), pa.array(np.diff(bounds).astype(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return matrix.select("docs", "indptr", "counts").mapInArrow(totals, schema)


# --- filters


def _sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many flags are set in each row."""
    sums = np.zeros(len(offsets), np.int64)
    total = 0
    for begin in range(0, len(flags), WORDS_BYTES):  # the running sum of all flags would take four or eight bytes for each
        some = np.cumsum(flags[begin : begin + WORDS_BYTES], dtype=np.int32)
        here = slice(*np.searchsorted(offsets, [begin, begin + len(some)], side="right"))
        sums[here] = total + some[offsets[here] - begin - 1]
        total += int(some[-1])
    return np.diff(sums)


#: Fixed value: the symbols of filter D.
_SYMBOL = np.isin(np.arange(256), np.frombuffer(b"#$%&*|", np.uint8))
_CAPITAL = np.isin(np.arange(256), np.arange(ord("A"), ord("Z") + 1))

MEASURES: dict[str, Measure] = {
    "n_capitals": lambda data, offsets: _sums(_CAPITAL[data], offsets),
    "n_points": lambda data, offsets: _sums(data & 0xC0 != 0x80, offsets),  # bytes that begin a character
    "n_symbols": lambda data, offsets: _sums(_SYMBOL[data], offsets),
}


def failures(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """`doc_id`, `part` (null as empty text) and `fails` for every row of `docs`: bit 0 for A to bit 4 for E.

    A: under 200 words; B: under half of the words different; C: over 3 % of the characters in A-Z; D: one of
    ``#$%&*|``; E: a smaller id has the same text, anywhere in the table.  Null texts are empty; a null id is
    neither smaller than any other nor has it smaller ones.  Repeated rows are each counted.  Runs jobs.
    """
    content = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    narrow = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"), F.sha2(content.cast("binary"), 256).alias("digest"), content.alias("text")
    )
    with settings(docs.sparkSession, SMALL_BATCHES | ONE_A_GROUP):
        cut = stage(shards(narrow, ["doc_id", "part", "digest"], measures=MEASURES), "shards")
    with settings(docs.sparkSession, SMALL_BATCHES):
        found = stage(row_totals(term_matrix(cut)[0]), "row-totals")
    # written, so that the join has an exchange on either side and the partition of a text with many copies can be split
    firsts = stage(found.groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n")).where("n > 1").select(F.col("digest").alias("copied"), "first_id"), "first-ids")
    words, different, capitals, points, symbols = (F.col(c) for c in ("n_words", "n_different", "n_capitals", "n_points", "n_symbols"))
    fails = [words < 200, 100 * different < 50 * words, 100 * capitals > 3 * points, symbols > 0, F.coalesce(F.col("doc_id") > F.col("first_id"), F.lit(False))]
    bits = [F.when(f, 1 << k).otherwise(0) for k, f in enumerate(fails)]
    return found.join(firsts, F.col("digest") == F.col("copied"), "left").select("doc_id", "part", sum(bits[1:], bits[0]).alias("fails"))


def audit(failed: DataFrame, labels: DataFrame, good: Column, toxic: Column, filters: str = FILTERS) -> DataFrame:
    """One row, zeros included, per `part`, `filter_order` (all orders of the filters) and `step` (from 1 on; its filter
    is that letter of the order), from `failures`: `kept` (after this step), `removed` (here), `redundant` (failing
    its filter, removed earlier), `unique_fails` (failing it alone), `good_lost` and `toxic_lost` (removed here,
    with such a label), `shapley` (removed by its filter in all orders together).

    A document has a label if one of its rows in `labels` has; null ids have none.  Without documents there are
    no rows.
    """
    told = labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("labelled")).agg(
        F.max(F.coalesce(good, F.lit(False))).alias("good"), F.max(F.coalesce(toxic, F.lit(False))).alias("toxic")).where("good or toxic")
    rows = failed.join(told, F.col("doc_id") == F.col("labelled"), "left").select("part", "fails", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"))
    # parts times patterns times labels: few rows, whatever the documents are
    patterns = rows.groupBy("part", "fails").agg(F.count("*").alias("n"), F.count_if("good").alias("n_good"), F.count_if("toxic").alias("n_toxic"))

    steps = []
    for order in permutations(filters):
        before = 0
        for k, letter in enumerate(order):
            bit = 1 << filters.index(letter)
            steps.append(f"struct('{''.join(order)}' AS filter_order, {k + 1} AS step, {bit} AS bit, {before} AS before)")
            before |= bit
    each = patterns.select("part", "fails", "n", "n_good", "n_toxic", F.expr(f"inline(array({', '.join(steps)}))"))
    earlier = F.col("fails").bitwiseAND(F.col("before")) != 0
    here = F.col("fails").bitwiseAND(F.col("bit")) != 0

    def total(condition: Column, n: str = "n") -> Column:
        return F.sum(F.when(condition, F.col(n)).otherwise(0))

    counted = each.groupBy("part", "filter_order", "step", "bit").agg(
        total(~earlier & ~here).alias("kept"), total(~earlier & here).alias("removed"), total(earlier & here).alias("redundant"),
        total(F.col("fails") == F.col("bit")).alias("unique_fails"), total(~earlier & here, "n_good").alias("good_lost"), total(~earlier & here, "n_toxic").alias("toxic_lost"),
    )
    shares = each.groupBy("part", "bit").agg(total(~earlier & here).alias("shapley"))
    return counted.join(shares, ["part", "bit"]).drop("bit")


# --- query


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed = stage(failures(table(spark, sf_dir, "documents")), "failures")
    return audit(failed, table(spark, sf_dir, "labels"), F.col("quality") == 1, F.col("toxic") == 1)


def _sql() -> str:
    """The same in SQL, every document taken through every order."""
    bit = lambda letter: 1 << FILTERS.index(letter)
    steps = []
    for order in permutations(FILTERS):
        before = 0
        for k, letter in enumerate(order):
            steps.append(f"('{''.join(order)}', {k + 1}, {bit(letter)}, {before})")
            before |= bit(letter)
    return rf"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), firsts AS (SELECT t, min(doc_id) AS first_id FROM d GROUP BY t),
f AS (
  SELECT part, (len(w) < 200)::INT + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::INT + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t))::INT
      + 8 * regexp_matches(t, '[#$%&*|]')::INT + 16 * (doc_id > first_id)::INT AS fails, coalesce(quality = 1, false) AS good, coalesce(toxic = 1, false) AS toxic
  FROM d JOIN firsts USING (t) LEFT JOIN labels USING (doc_id)
), steps AS (SELECT * FROM (VALUES {", ".join(steps)}) s(filter_order, step, bit, before)),
counted AS (
  SELECT part, filter_order, step, bit, count(*) FILTER (fails & (before | bit) = 0) AS kept, count(*) FILTER (fails & before = 0 AND fails & bit <> 0) AS removed,
    count(*) FILTER (fails & before <> 0 AND fails & bit <> 0) AS redundant, count(*) FILTER (fails = bit) AS unique_fails,
    count(*) FILTER (fails & before = 0 AND fails & bit <> 0 AND good) AS good_lost, count(*) FILTER (fails & before = 0 AND fails & bit <> 0 AND toxic) AS toxic_lost
  FROM f, steps GROUP BY part, filter_order, step, bit
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley FROM counted
"""


OP11_SQL = _sql()
