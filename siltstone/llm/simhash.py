"""SimHash near-duplicates through an inverted index of positional bytes.

Fingerprints that differ in at most 3 of 64 bits differ in at most 3 of 8 bytes: they share at least 5
bytes at their positions.  A list for every single byte would bring nearly all pairs together, so the lists
are those of 5 positional bytes at a time, 56 for each fingerprint: whoever shares the guaranteed minimum
meets in one of them.  In a list the shared bytes of a pair are tallied and its bits are verified.
Members of a list differ in 3 bytes only, so a list holds at most 2**24 different fingerprints, however
many documents there are; in a large list neighbours are looked up by flipping bits, not by comparing pairs.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm.common import LOWER, SPACES, row_bounds, steps, table, word_spans
from siltstone.llm.components import components
from siltstone.sources.stage import stage

SHINGLE = 3
MAX_BITS = 3
SEED = 42
#: Beyond so many fingerprints, flipping bits is cheaper than comparing a list's members.
COMPARED = 4096


# --- fingerprints


def _shingle_hashes(data: np.ndarray, offsets: np.ndarray, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles, and the bounds of each row's."""
    data = LOWER[data]
    starts, ends, rows = word_spans(data, offsets, SPACES)
    keep = ~SPACES[data]
    text = np.where(keep, data, np.uint8(0x20))
    keep[ends[ends < len(data)]] = True  # one space after each word
    place = np.cumsum(keep) - 1
    sizes = ends - starts
    starts = place[starts] if len(starts) else starts
    ends = starts + sizes
    text = text[keep].tobytes()
    n = len(offsets) - 1
    words = row_bounds(rows, n)
    counts = np.diff(words)
    shingles = np.where(counts >= shingle, counts - shingle + 1, np.minimum(counts, 1))
    bounds = np.concatenate([[0], np.cumsum(shingles)])
    row = np.repeat(np.arange(n), shingles)
    first = words[:-1][row] + np.arange(bounds[-1]) - bounds[:-1][row]
    last = np.minimum(first + shingle, words[1:][row]) - 1
    digest = xxhash.xxh64_intdigest
    hashes = [digest(text[a:b], SEED) for a, b in zip(starts[first].tolist(), ends[last].tolist(), strict=True)]
    return np.array(hashes, np.uint64), bounds


def _majority(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    out = np.zeros(len(bounds) - 1, np.uint64)
    full = np.flatnonzero(np.diff(bounds))
    if len(full):
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones = np.add.reduceat(bits, bounds[full], axis=0, dtype=np.int32)
        above = 2 * ones > np.diff(bounds)[full][:, None]
        out[full] = np.packbits(above, axis=1, bitorder="little").view("<u8").ravel()
    return out


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`doc_id` and `fingerprint`, a long of 64 bits, of every row of `docs`.

    A-Z are lower-cased and words are runs of anything but ASCII white space.  A text of fewer words than
    a shingle is one shingle; a null text or one without words has fingerprint 0.  A long text is taken whole, which
    needs about a hundred bytes for each of its shingles in the worker.
    """
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))

    def prints(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in steps(batch):
                found = _majority(*_shingle_hashes(data, offsets, shingle))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(found.view(np.int64))], names=["doc_id", "fingerprint"])

    return narrow.mapInArrow(prints, f"doc_id {narrow.schema['doc_id'].dataType.simpleString()}, fingerprint long")


# --- links


def _flips(free: list[int], most: int) -> np.ndarray:
    """All numbers with 1 to `most` bits set, of the bits given."""
    return np.array([sum(1 << b for b in chosen) for k in range(1, most + 1) for chosen in combinations(free, k)], np.uint64)


def _forest(members: np.ndarray, free: list[int], least: int, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links that connect whoever is connected among the members of one list; at most one less than they are."""
    looked_up = len(members) > COMPARED
    if looked_up:  # dense numbers of the free bits, at most 2**24
        small = np.zeros(len(members), np.int64)
        for k, bit in enumerate(free):
            small |= (members >> np.uint64(bit) & np.uint64(1)).astype(np.int64) << k
        at = np.full(1 << len(free), -1, np.int32)
        at[small] = np.arange(len(members), dtype=np.int32)
        flips = _flips(list(range(len(free))), most).astype(np.int64)
    rest = np.arange(len(members))
    while len(rest):
        todo, rest = [int(rest[0])], rest[1:]
        if looked_up:
            at[small[todo[0]]] = -1
        while todo:
            node = todo.pop()
            if looked_up:
                near = at[small[node] ^ flips]
                near = near[near >= 0]
                at[small[near]] = -1
            else:
                differs = members[rest] ^ members[node]
                shared = sum((differs >> np.uint64(8 * k) & np.uint64(255)) == 0 for k in range(8))
                is_near = (shared >= least) & (np.bitwise_count(differs) <= most)
                near, rest = rest[is_near], rest[~is_near]
            if len(near):
                yield np.full(len(near), members[node]), members[near]
                todo += near.tolist()
        if looked_up:
            rest = rest[at[small[rest]] >= 0]


def links(prints: DataFrame, most: int = MAX_BITS) -> DataFrame:
    """Pairs `a`, `b` of different fingerprints at `most` bits or fewer (3 at most), enough of them to connect
    all that such pairs connect.  `prints` has the long column `fingerprint`, without repetitions or nulls."""
    if not 0 <= most <= 3:
        raise ValueError("the byte lists are complete for 0 to 3 bits")
    least = 8 - most
    lists = list(combinations(range(8), least))
    masks = [sum(255 << 8 * k for k in chosen) for chosen in lists]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    postings = prints.select(
        F.explode(F.array(*[F.struct(F.lit(k).cast("short").alias("list"), F.col("fingerprint").bitwiseAND(F.lit(m).cast("long")).alias("bytes")) for k, m in enumerate(signed)])).alias("p"),
        "fingerprint",
    ).select("p.list", "p.bytes", "fingerprint")

    def verified(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64)] * 3

        def linked(columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            which, key, value = columns
            bounds = np.concatenate([[0], np.flatnonzero((which[1:] != which[:-1]) | (key[1:] != key[:-1])) + 1, [len(key)]])
            pairs = []
            for k in np.flatnonzero(np.diff(bounds) > 1):
                free = [b for b in range(64) if b // 8 not in lists[which[bounds[k]]]]
                pairs += _forest(value[bounds[k] : bounds[k + 1]].view(np.uint64), free, least, most)
            if pairs:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).view(np.int64)) for x in zip(*pairs, strict=True)], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            new = [batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("list", "bytes", "fingerprint")]
            last = np.flatnonzero((new[0] != new[0][-1]) | (new[1] != new[1][-1]))
            cut = last[-1] + 1 if len(last) else 0  # the last list of a batch may go on in the next
            if cut or (len(held[0]) and (held[0][-1], held[1][-1]) != (new[0][0], new[1][0])):
                yield from linked([np.concatenate([h, c[:cut]]) for h, c in zip(held, new, strict=True)])
                held = [c[cut:] for c in new]
            else:
                held = [np.concatenate([h, c]) for h, c in zip(held, new, strict=True)]
        if len(held[0]):
            yield from linked(held)

    return postings.repartition("list", "bytes").sortWithinPartitions("list", "bytes").mapInArrow(verified, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, most: int = MAX_BITS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`doc_id`, `fingerprint` (16 hex digits) and `component_id`, the smallest id that links of `most` bits
    reach, of every row of `docs`.

    Equal texts have equal fingerprints and meet before any pairs are formed.  Texts without words have
    fingerprint 0 and are linked like any other.  A null id is never the smallest; a component of null ids
    alone has a null id.  Repeated rows are returned as often as they come.  Other columns are ignored.
    Runs jobs.
    """
    prints = stage(fingerprints(docs, shingle, doc_id, text), "prints")
    distinct = stage(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id")), "distinct-prints")
    roots = components(links(distinct.select("fingerprint"), most))
    rooted = distinct.join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))
    # written, so that the join has an exchange on either side and the partition of a large component can be split
    ids = stage(rooted.groupBy("root").agg(F.min("first_id").alias("component_id")), "component-ids")
    named = rooted.join(ids, "root").select("fingerprint", "component_id")
    return prints.join(named, "fingerprint").select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


# --- query and stage


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def keep_first(docs: DataFrame) -> DataFrame:
    """The row with the smallest id of each near-duplicate group, with all its columns, whatever their names.

    Null ids are the largest; where several rows of a group have the smallest id, one of them stays, as of repeated
    rows.  Ids say nothing else: rows of one id in different groups all stay.  Texts without words, null and empty
    ones too, are one group.  An empty table stays empty.  The rows are written once to the shared folder, with
    keys of their own.
    """
    # the row travels as one struct, since its columns may have any names
    keyed = stage(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.monotonically_increasing_id().alias("key")), "keyed")
    doc_id, text = F.col("row").getField("doc_id"), F.col("row").getField("text")
    order = F.struct(doc_id.isNull().alias("absent"), doc_id.alias("id"), F.col("key").alias("row"))
    found = near_duplicates(keyed.select(order.alias("doc_id"), text.alias("text")))
    kept = stage(found.where("doc_id.row = component_id.row").select(F.col("doc_id.row").alias("key")), "kept-rows")
    # the rows grow with the documents, so they are never broadcast; hashing them spares sorting the texts
    return keyed.join(kept.hint("shuffle_hash"), "key", "left_semi").select("row.*")
