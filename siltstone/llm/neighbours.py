"""Approximate nearest neighbours by balanced posting lists.

A bounded sample is halved again and again, each time at the median between two means, until the parts
have the size of a list; their centroids form a graph that is searched in memory.  Every vector goes to its
nearest list and, near a boundary, to further ones.  A query visits the lists whose centroids are not much
farther than the nearest, the nearest first and in rounds, each of several times more lists than the one before.
Lists and their queries meet in tiles of bounded size, and every candidate there is measured exactly, on the
vectors as they came; a tile gives those that are no worse than the query's k-th best of the rounds before.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from siltstone.llm.common import table
from siltstone.sources.stage import stage

#: Vectors that the lists are laid out by, at most (fewer, if they would take more than SAMPLE_BYTES).
MAX_SAMPLE, SAMPLE_BYTES = 65_536, 64 << 20
#: Vectors of a list, without replicas, as far as the sample allows so many lists.
LIST_SIZE = 128
#: Least sampled vectors of a list.
LIST_SAMPLE = 8
DEGREE, LONG_LINKS, ENTRIES = 20, 4, 64
#: Lists kept while a vector or a query searches the graph; a query with more lists within its ratio measures all.
REPLICA_BEAM, QUERY_BEAM = 32, 96
REPLICAS = 4
#: How much farther than the nearest centroid those of other lists may be: for a vector's replicas, for queries.
REPLICA_RATIO, QUERY_RATIO = 1.15, 1.3
#: Lists that a query visits in the first round, and how many times more it has visited after each further one.
FIRST_LISTS, GROWTH = 8, 4
#: Vectors and queries of a tile, about.
TILE_VECTORS, TILE_QUERIES = 4096, 1024


class Lists(NamedTuple):
    """Unit centroids and the links between them; entries are where searches begin."""

    centroids: np.ndarray
    links: np.ndarray
    entries: np.ndarray

    def nearest(self, vectors: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Of unit vectors, the numbers and cosines of the nearest centroids found, nearest first; -1 fills up."""
        n, (lists, degree) = len(vectors), self.links.shape
        row = np.arange(n)[:, None]
        seen = np.zeros((n, lists + 1), bool)
        seen[:, lists] = True  # where -1 points
        seen[:, self.entries] = True
        ids = np.full((n, beam), -1)
        cosines = np.full((n, beam), -np.inf)
        open_ = np.zeros((n, beam), bool)

        def merge(new: np.ndarray, found: np.ndarray) -> None:
            nonlocal ids, cosines, open_
            every, value = np.concatenate([ids, new], axis=1), np.concatenate([cosines, found], axis=1)
            is_open = np.concatenate([open_, found > -np.inf], axis=1)
            best = np.argsort(-value, axis=1, kind="stable")[:, :beam]
            ids, cosines, open_ = (np.take_along_axis(x, best, axis=1) for x in (every, value, is_open))

        merge(np.broadcast_to(self.entries, (n, len(self.entries))), vectors @ self.centroids[self.entries].T)
        while open_.any():
            pick = np.argsort(~open_, axis=1, kind="stable")[:, :4]  # the nearest four not looked at yet
            live = np.take_along_axis(open_, pick, axis=1)
            at = np.where(live, np.take_along_axis(ids, pick, axis=1), 0)
            np.put_along_axis(open_, pick, False, axis=1)
            near = np.where(np.repeat(live, degree, axis=1), self.links[at].reshape(n, -1), -1)
            near.sort(axis=1)
            near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
            near[seen[row, near]] = -1
            seen[row, near] = True
            found = np.einsum("nd,nkd->nk", vectors, self.centroids[near])
            merge(near, np.where(near >= 0, found, -np.inf))
        ids[cosines == -np.inf] = -1
        return ids, cosines


def _halved(vectors: np.ndarray, part: np.ndarray, size: int, rng: np.random.Generator) -> Iterator[np.ndarray]:
    """Parts of at most `size`, or of equal vectors: two means, then a cut at the median between them."""
    todo = [part]
    while todo:
        part = todo.pop()
        x = vectors[part]
        if len(part) <= size or (x == x[0]).all():
            yield part
            continue
        means = x[rng.choice(len(x), 2, replace=False)]
        for _ in range(6):
            side = ((x - means[0]) ** 2).sum(axis=1) > ((x - means[1]) ** 2).sum(axis=1)
            if side.all() or not side.any():
                break
            means = np.array([x[~side].mean(axis=0), x[side].mean(axis=0)])
        direction = means[1] - means[0]
        if not direction.any():
            direction = x[np.argmax(((x - x[0]) ** 2).sum(axis=1))] - x[0]
        order = np.argsort(x @ direction, kind="stable")
        half = len(order) // 2
        todo += [part[order[:half]], part[order[half:]]]


def lay_out(sample: np.ndarray, n: int, seed: int = 1) -> Lists:
    """Lists for n unit vectors, by a sample of them."""
    rng = np.random.default_rng(seed)
    lists = max(1, min(n // LIST_SIZE, len(sample) // LIST_SAMPLE))
    size = max(1, -(-len(sample) // lists))
    centroids = np.array([sample[p].mean(axis=0) for p in _halved(sample, np.arange(len(sample)), size, rng)])
    norms = np.sqrt((centroids**2).sum(axis=1, keepdims=True))
    centroids = centroids / np.where(norms > 0, norms, 1)
    lists = len(centroids)
    links = []
    for first in range(0, lists, 1024):
        cosines = centroids[first : first + 1024] @ centroids.T
        cosines[np.arange(len(cosines)), np.arange(first, first + len(cosines))] = -np.inf
        links.append(np.argsort(-cosines, axis=1, kind="stable")[:, :DEGREE])
    ring = (np.arange(lists)[:, None] + 1) % lists  # whatever the nearest are, the graph is connected
    far = rng.integers(0, lists, (lists, LONG_LINKS))
    return Lists(centroids, np.concatenate([*[np.concatenate(links)], ring, far], axis=1), np.unique(np.linspace(0, lists - 1, min(ENTRIES, lists)).astype(np.int64)))


def _chosen(lists: Lists, vectors: np.ndarray, beam: int, ratio: float, most: int | None, spread: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, list and place, the nearest list first: lists within `ratio` of the nearest centroid's distance, and of
    these, if `spread`, none that is nearer to a list already chosen than to the vector."""
    ids, cosines = lists.nearest(vectors, beam)
    distance = np.sqrt(np.maximum(2 - 2 * cosines, 0))
    take = (ids >= 0) & (distance <= ratio * distance[:, :1] + 1e-12)
    take[:, 0] = True
    if spread:
        for k in range(1, take.shape[1]):
            between = np.einsum("nkd,nd->nk", lists.centroids[ids[:, :k]], lists.centroids[ids[:, k]])
            hidden = (take[:, :k] & (np.sqrt(np.maximum(2 - 2 * between, 0)) < distance[:, k, None])).any(axis=1)
            take[:, k] &= ~hidden & (take[:, :k].sum(axis=1) < (most or k + 1))
    row, at = np.nonzero(take)
    ids, far = ids[row, at], distance[row, at]
    if not spread and beam < len(lists.centroids):  # the beam ends within the ratio: all lists are measured
        further = np.flatnonzero(take.all(axis=1))
        every = np.sqrt(np.maximum(2 - 2 * (vectors[further] @ lists.centroids.T), 0))
        more, number = np.nonzero(every <= ratio * every.min(axis=1, keepdims=True) + 1e-12)
        kept = ~take.all(axis=1)[row]
        row, ids, far = np.concatenate([row[kept], further[more]]), np.concatenate([ids[kept], number]), np.concatenate([far[kept], every[more, number]])
    order = np.lexsort((ids, far, row))
    row = row[order]
    return row, ids[order], np.arange(len(row)) - np.searchsorted(row, row)


# --- on Spark


def usable(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """`vec_id` and `vector` of the rows that take part: those with an id, and a vector of the commonest
    length (of equally common ones, the shorter) that is not zero and has finite components only.  Components
    that come as floats stay floats, which are half as large; others are doubles."""
    kind = vectors.select(F.col(embedding)).schema[0].dataType
    narrow = isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType)
    vector = F.col(embedding).cast("array<float>" if narrow else "array<double>")
    rows = vectors.select(F.col(vec_id).alias("vec_id"), vector.alias("vector")).where("vec_id is not null and size(vector) > 0")
    good = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = rows.where(F.forall("vector", good) & F.exists("vector", lambda x: x != 0))
    size = rows.groupBy(F.size("vector").alias("size")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "size").first()
    return rows.where(F.size("vector") == (size["size"] if size else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled**2).sum(axis=1, keepdims=True))


def _listed(rows: DataFrame, sent, beam: int, ratio: float, most: int | None, spread: bool) -> DataFrame:
    kind = rows.schema["vec_id"].dataType.simpleString()

    def choose(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, whole.num_rows, 512):
                batch = whole.slice(first, 512)
                row, number, place = _chosen(sent.value, _unit(_matrix(batch.column("vector"))), beam, ratio, most, spread)
                at = pa.array(row)
                yield pa.RecordBatch.from_arrays([pa.array(number), pa.array(place.astype(np.int32)), batch.column("vec_id").take(at), batch.column("vector").take(at)], names=["list", "place", "vec_id", "vector"])

    return rows.mapInArrow(choose, f"list long, place int, vec_id {kind}, vector {rows.schema['vector'].dataType.simpleString()}")


def _best(queries: pa.Table, candidates: pa.Table, k: int) -> pa.Table:
    """The k best candidates of each query of a tile, of those that reach its `least` cosine.  Every product is summed
    in the same order, so equal vectors have equal cosines wherever they are."""
    ids = candidates.column("vec_id").combine_chunks()
    order = pa.compute.sort_indices(ids)
    ids, vectors = ids.take(order), _matrix(candidates.column("vector").combine_chunks())[order.to_numpy()]
    norms = np.sqrt((vectors * vectors).sum(axis=1))
    query_ids = queries.column("vec_id").combine_chunks()
    own = pa.compute.index_in(query_ids, ids).to_numpy(zero_copy_only=False)
    count = pa.compute.value_counts(ids)
    repeated = len(count) < len(ids)
    out_query, out_row, out_score = [], [], []
    least_scores = queries.column("least").to_numpy()
    for k_query, q in enumerate(_matrix(queries.column("vector").combine_chunks())):
        scores = (vectors * q).sum(axis=1) / (norms * np.sqrt((q * q).sum()))
        if not np.isnan(own[k_query]):
            same = pa.compute.equal(ids, query_ids[k_query]).to_numpy(zero_copy_only=False) if repeated else int(own[k_query])
            scores[same] = -np.inf
        most = k * (1 + (int(pa.compute.max(count.field("counts")).as_py()) if repeated else 0))
        if len(scores) > most:
            least = np.partition(scores, len(scores) - most)[len(scores) - most]
            some = np.flatnonzero(scores >= least)
        else:
            some = np.arange(len(scores))
        some = some[(scores[some] > -np.inf) & (scores[some] >= least_scores[k_query])]
        some = some[np.argsort(-scores[some], kind="stable")][:most]  # ids ascend, so ties go to the smaller
        out_query += [k_query] * len(some)
        out_row += some.tolist()
        out_score += scores[some].tolist()
    return pa.table({"query_id": query_ids.take(pa.array(out_query, pa.int64())), "vec_id": ids.take(pa.array(out_row, pa.int64())), "score": pa.array(out_score, pa.float64())})


def _searched(queries: DataFrame, postings: DataFrame, k: int) -> DataFrame:
    """`query_id`, `vec_id` and `score`: candidates of every query in the lists it visits, among them the k best that reach
    its least cosine.  `queries` is list, vec_id, vector, least, and `postings` list, vec_id, vector."""
    kind = postings.schema["vec_id"].dataType.simpleString()
    # one row a list, and lists are bounded by the sample
    sizes = postings.groupBy("list").agg(F.ceil(F.count("*") / TILE_VECTORS).alias("slices")).join(
        queries.groupBy("list").agg(F.ceil(F.count("*") / TILE_QUERIES).alias("query_slices")), "list"
    )
    sizes = F.broadcast(stage(sizes, "list-sizes"))
    tile = lambda part, of, every: (F.pmod(F.xxhash64("vec_id"), F.col(of)).alias(part), F.explode(F.sequence(F.lit(0).cast("long"), F.col(every) - 1)))
    left, every = tile("query_slice", "query_slices", "slices")
    asked = queries.join(sizes, "list").select("list", left, every.alias("slice"), "vec_id", "vector", "least")
    right, every = tile("slice", "slices", "query_slices")
    held = postings.join(sizes, "list").select("list", right, every.alias("query_slice"), "vec_id", "vector")
    keys = ["list", "slice", "query_slice"]
    return asked.groupBy(*keys).cogroup(held.groupBy(*keys)).applyInArrow(lambda a, b: _best(a, b, k), f"query_id {kind}, vec_id {kind}, score double")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return once.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _in_rounds(queries: DataFrame, postings: DataFrame, k: int) -> DataFrame:
    """The k best of every query over all lists it visits.  After each round its k-th best so far is what others have
    to reach, so of several times more candidates about as many times k come through: their number grows with
    the logarithm of the lists.  No candidate that could be among the k best is left out."""
    far = queries.agg(F.max("place")).first()[0]
    found, first, end = None, 0, FIRST_LISTS
    while found is None or first <= (far or 0):
        some = queries.where((F.col("place") >= first) & (F.col("place") < end))
        if found is None:
            some = some.withColumn("least", F.lit(float("-inf")))
        else:
            least = found.groupBy(F.col("query_id").alias("asked")).agg(F.count("*").alias("n"), F.min("score").alias("kth")).where(F.col("n") == k)
            some = some.join(least, F.col("vec_id") == F.col("asked"), "left").withColumn("least", F.coalesce("kth", F.lit(float("-inf"))))
        new = _searched(some, postings, k)
        found = stage(_ranked(new if found is None else new.union(found.select("query_id", "vec_id", "score")), k), "found")
        first, end = end, end * GROWTH
    return found


def nearest(vectors: DataFrame, is_query, k: int = 5, vec_id: str = "vec_id", embedding: str = "embedding", query_ratio: float = QUERY_RATIO) -> DataFrame:
    """`query_id`, `rank` (from 1), `vec_id` and `score`, the cosine in double precision, of the k nearest found
    of each row that `is_query` (a condition on `vec_id`) holds for; ties go to the smaller id.

    All rows but those with the query's own id are candidates.  Rows that `usable` leaves out take no part.  An id
    that comes several times is one candidate, by its nearest vector, and its rows as queries answer
    together.  A query that finds fewer than k in its lists looks into all of them, so it returns k, or all
    candidates there are.  The lists are laid out by a bounded sample; every row is in one at least.  Other
    columns are ignored.  Runs jobs.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, vec_id, embedding)
    n = rows.count()
    kind = rows.schema["vec_id"].dataType.simpleString()
    if not n:
        return spark.createDataFrame([], f"query_id {kind}, rank int, vec_id {kind}, score double")
    width = rows.select(F.size("vector")).first()[0]
    sample = rows.orderBy(F.xxhash64("vec_id", "vector")).limit(max(1, min(MAX_SAMPLE, SAMPLE_BYTES // (8 * width)))).select("vector").toArrow()
    lists = lay_out(_unit(_matrix(sample.column("vector").combine_chunks())), n)
    sent = spark.sparkContext.broadcast(lists)
    postings = stage(_listed(rows, sent, REPLICA_BEAM, REPLICA_RATIO, REPLICAS, True), "postings")
    asked = rows.where(is_query)
    queries = stage(_listed(asked, sent, QUERY_BEAM, query_ratio, None, False), "queries")
    found = _in_rounds(queries, postings, k)
    counts = found.groupBy(F.col("query_id").alias("vec_id")).agg(F.count("*").alias("n"))
    short = stage(asked.join(counts, "vec_id", "left").where(F.coalesce("n", F.lit(0)) < min(k, n - 1)).select("vec_id", "vector"), "short")
    if short.limit(1).count():
        everywhere = short.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(len(lists.centroids) - 1).cast("long"))).alias("list"), "vec_id", "vector", F.lit(float("-inf")).alias("least"))
        again = _ranked(_searched(everywhere, postings, k), k)
        found = found.join(short.select(F.col("vec_id").alias("query_id")), "query_id", "left_anti").union(again)
    return found


# --- query


def op2_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)
