"""Toxicity scores: votes of the nearest labelled examples by exact TF-IDF cosine.

Terms are words; how many documents hold each is counted over all.  A bounded sample of labelled documents are the
examples, with all their terms, and a text's norm is taken over all of its own.  Examples stand in blocks of similar
ones.  Rare terms are looked up in inverted lists of the examples.  Of a frequent term each block has its largest
weight; what these and the lists add up to at most decides which blocks of a text are visited, the most promising
first, then all that may still hold one of the nearest.  The best are computed again in full precision: the
neighbours are exact.  In long prose a few telling words hardly move that cosine, so a second index has only the
terms that tell the labels apart, and the nearest by these vote too.  Votes weighted by similarity are joined and
calibrated on the examples' own votes, each without itself.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siltstone.llm.common import LOWER, MARKS, range_sums, steps, sums_hash, table, word_spans
from siltstone.llm.labelled import examples, fold, known
from siltstone.sources.stage import stage

#: Labelled documents in the index, with all their terms, and telling terms, at most.
MAX_EXAMPLES = 8192
MAX_TERMS = 1024
#: Different terms of all examples together, at most; what comes after in the order of the examples is left out.
MAX_ENTRIES = 4_000_000
#: Least documents with a term, and least chi-square of its counts, for it to be chosen.
LEAST_DOCS, LEAST_CHI2 = 4, 20.0
#: Texts that are multiplied with the examples at once.
TOGETHER = 64
#: A term that one example in so many holds is frequent, and a row of the blocks' matrices.
FREQUENT = 16
#: Examples of a block, and blocks that are visited before any is ruled out.
BLOCK, FIRST_BLOCKS = 32, 4
NEIGHBOURS = 15
FOLDS, HELD = 5, 0


# --- terms


def term_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of every term of every text, repetitions included."""
    data = LOWER[data]
    starts, ends, rows = word_spans(data, offsets, MARKS)
    return rows, sums_hash(range_sums(data), starts, ends) if len(starts) else np.zeros(0, np.uint64)


def _counted(rows: np.ndarray, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different (row, term) pairs in order, and how often each comes."""
    if not len(rows):
        return rows, terms, rows
    different, at = np.unique(terms, return_inverse=True)
    keys, counts = np.unique(rows * len(different) + at, return_counts=True)
    return keys // len(different), different[keys % len(different)], counts


def choose_terms(chosen: DataFrame, most: int = MAX_TERMS) -> np.ndarray:
    """Hashes of the terms that tell label 1 from 0 best by chi-square, ascending; at most `most`.

    `chosen` has the columns doc_id, text and label.  Equal texts count once.
    """

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in steps(batch):
                rows, terms, _ = _counted(*term_hashes(data, offsets))
                labels = part.column("label").to_numpy()[rows]
                different, at = np.unique(terms, return_inverse=True)
                ones = np.bincount(at, labels, len(different)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(different.view(np.int64)), pa.array(np.bincount(at, minlength=len(different))), pa.array(ones)], names=["term", "n", "ones"])

    single = chosen.groupBy(F.sha2(F.col("text").cast("binary"), 256)).agg(F.max("label").alias("label"), F.max("text").alias("text")).select("text", "label")
    single = stage(single, "examples")
    total = single.agg(F.count("*").alias("n"), F.coalesce(F.sum("label"), F.lit(0)).alias("ones")).first()
    n, ones = total["n"], total["ones"]
    if not 0 < ones < n:
        return np.zeros(0, np.uint64)
    expected = F.col("n") * ones / n
    chi2 = (F.col("ones") - expected) ** 2 / expected / (1 - ones / n) * n / (n - F.col("n") + 1e-9)
    counted = single.mapInArrow(count, "term long, n long, ones long").groupBy("term").agg(F.sum("n").alias("n"), F.sum("ones").alias("ones"))
    best = counted.where((F.col("n") >= LEAST_DOCS) & (chi2 >= LEAST_CHI2)).orderBy(chi2.desc(), "term").limit(most).select("term").collect()
    return np.sort(np.array([r["term"] for r in best], np.int64).view(np.uint64))


def _lists(rows: np.ndarray, n: int, *columns: np.ndarray) -> list[pa.Array]:
    bounds = pa.array(np.searchsorted(rows, np.arange(n + 1)).astype(np.int32))
    return [pa.ListArray.from_arrays(bounds, pa.array(x)) for x in columns]


def hashed(texts: DataFrame) -> DataFrame:
    """`doc_id`, `label`, and `hashes` of all terms with their `counts`, of every row of doc_id, text and label."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in steps(batch):
                rows, hashes, counts = _counted(*term_hashes(data, offsets))
                lists = _lists(rows, part.num_rows, hashes.view(np.int64), counts.astype(np.int32))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("label"), *lists], names=["doc_id", "label", "hashes", "counts"])

    return texts.select("doc_id", "text", "label").mapInArrow(count, f"doc_id {texts.schema['doc_id'].dataType.simpleString()}, label int, hashes array<long>, counts array<int>")


def _numbered(vocabulary: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places among the ascending hashes, and whether each is there."""
    at = np.searchsorted(vocabulary, hashes)
    return at, vocabulary[np.minimum(at, len(vocabulary) - 1)] == hashes if len(vocabulary) else np.zeros(len(at), bool)


def holding(narrow: DataFrame, vocabulary: np.ndarray) -> tuple[int, np.ndarray]:
    """Number of rows, and of the rows that hold each term; `narrow` has the column text."""
    sent = narrow.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, total = sent.value, 0
        held = np.zeros(len(vocabulary), np.int64)
        for batch in batches:
            for part, data, offsets in steps(batch):
                total += part.num_rows
                terms, counts = np.unique(_counted(*term_hashes(data, offsets))[1], return_counts=True)
                at, known = _numbered(vocabulary, terms)
                held[at[known]] += counts[known]
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(some, -1).astype(np.int32)), pa.array(np.append(held[some], total))], names=["term", "n"])

    found = narrow.select("text").mapInArrow(count, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(len(vocabulary) + 1)
    out[found.column("term").to_numpy()] = found.column("n").to_numpy()  # the rows are last
    return int(out[-1]), out[:-1]


def rests(found: DataFrame, n_docs: int) -> DataFrame:
    """`row` and `rest`, the sum of the squared weights of its `others`, of every row that has any."""
    pairs = found.select("row", F.explode(F.arrays_zip("others", "other_counts")).alias("x")).select("row", F.col("x.others").alias("term"), F.col("x.other_counts").alias("count"))
    # written, so that the join has an exchange on either side and the partition of a frequent term can be split
    holding = stage(pairs.groupBy("term").agg(F.count("*").alias("holding")), "holding")
    weight = (1 + F.log("count")) * (F.log(F.lit(n_docs + 1.0) / (F.col("holding") + 1)) + 1)
    return pairs.join(holding, "term").groupBy("row").agg(F.sum(weight * weight).alias("rest"))


# --- index


def _ranges(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one range after the other."""
    return np.repeat(first - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())


class Parts(NamedTuple):
    """What is searched.  Of the frequent terms: their rows by term (-1: none), a matrix of rows and examples for each
    block, the largest weight of each row in each block, and each example's rows and weights, those of example e from
    own_at[e].  Of the other terms: lists of examples and weights, those of term t from at[t]."""

    row: np.ndarray
    blocks: np.ndarray
    largest: np.ndarray
    own_at: np.ndarray
    own_row: np.ndarray
    own_weight: np.ndarray
    at: np.ndarray
    example: np.ndarray
    weight: np.ndarray


@dataclass
class Index:
    """Vectors of the examples that have terms: those of example e are from start[e] to start[e + 1]."""

    idf: np.ndarray
    start: np.ndarray
    term: np.ndarray
    count: np.ndarray
    label: np.ndarray
    number: np.ndarray  # of each example, as it was given
    blank: float  # share of 1 among examples without terms

    def __getstate__(self) -> dict:
        """Packed, as every executor writes what it is sent to its disk."""
        plain = {k: x for k, x in self.__dict__.items() if k not in ("term", "count", "parts")}
        return plain | {"packed": [zlib.compress(x.astype(np.int32).tobytes(), 1) for x in (np.diff(self.term, prepend=0), self.count)]}

    def __setstate__(self, state: dict) -> None:
        term, self.count = (np.frombuffer(zlib.decompress(x), np.int32) for x in state.pop("packed"))
        self.term = np.cumsum(term, dtype=np.int64).astype(np.int32)
        self.__dict__ |= state

    @cached_property
    def parts(self) -> Parts:
        """Built where it is used."""
        n, sizes = len(self.label), np.diff(self.start)
        weight = self.weights(self.term, self.count)
        weight /= np.repeat(np.sqrt(np.add.reduceat(weight**2, self.start[:-1])), sizes)
        example = np.repeat(np.arange(n, dtype=np.int32), sizes)
        frequent = np.bincount(self.term, minlength=len(self.idf)) * FREQUENT > n
        row = np.where(frequent, np.cumsum(frequent) - 1, -1).astype(np.int32)
        some = row[self.term] >= 0
        its, own_row, own_weight = example[some], row[self.term[some]], weight[some]
        blocks = np.zeros((-(-n // BLOCK), int(frequent.sum()), BLOCK), np.float32)
        blocks[its // BLOCK, own_row, its % BLOCK] = own_weight
        own_at = np.searchsorted(its, np.arange(n + 1))
        order = np.flatnonzero(~some)
        order = order[np.argsort(self.term[order], kind="stable")]
        at = np.searchsorted(self.term[order], np.arange(len(self.idf) + 1, dtype=np.int32))
        return Parts(row, blocks, np.ascontiguousarray(blocks.max(axis=2).T), own_at, own_row, own_weight, at, example[order], weight[order])

    def weights(self, terms: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return (1 + np.log(counts)) * self.idf[terms]

    def weigh(self, terms: np.ndarray, counts: np.ndarray, rest: float = 0.0) -> np.ndarray:
        """Weights, in a vector whose other terms have the squared weights `rest`."""
        weights = self.weights(terms, counts)
        return weights / np.sqrt((weights**2).sum() + rest)

    def _scores(self, texts: list[tuple[np.ndarray, np.ndarray]], queries: list[np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """By block, text and place in the block: cosines of every text with the examples of the blocks it visits, -1 for
        the others, in single precision; and what rare terms add to them, in full.  What one of the k nearest has at least."""
        row, blocks, largest, _, _, _, at, example, weight = self.parts
        frequent = np.zeros((len(texts), len(largest)), np.float32)
        listed = np.empty((len(blocks), len(texts), BLOCK))
        for text, ((terms, _), weights) in enumerate(zip(texts, queries, strict=True)):  # what one text needs stays in the processor's cache
            rows = row[terms]
            frequent[text, rows[rows >= 0]] = weights[rows >= 0]
            rare = terms[rows < 0]
            first = at[rare]
            sizes = at[rare + 1] - first
            postings = _ranges(first, sizes)
            listed[:, text] = np.bincount(example[postings], weight[postings] * np.repeat(weights[rows < 0], sizes), listed[:, text].size).reshape(-1, BLOCK)
        bounds = frequent @ largest + listed.max(axis=2).T
        scores = np.full(listed.shape, -1.0, np.float32)

        def visit(wanted: np.ndarray) -> None:
            for block in np.flatnonzero(wanted.any(axis=0)):
                rows = np.flatnonzero(wanted[:, block])
                rows = rows if 2 * len(rows) < len(texts) else slice(None)  # picking most texts takes longer than all
                scores[block, rows] = frequent[rows] @ blocks[block] + listed[block, rows]

        best = np.argpartition(-bounds, min(FIRST_BLOCKS, len(blocks)) - 1, axis=1)[:, :FIRST_BLOCKS]
        wanted = np.zeros(bounds.shape, bool)
        np.put_along_axis(wanted, best, True, axis=1)
        visit(wanted)
        # one more than k, as one may be left out
        seen = scores[best, np.arange(len(texts))[:, None]].reshape(len(texts), -1)
        least = np.partition(seen, -k - 1, axis=1)[:, -k - 1] if seen.shape[1] > k else np.full(len(texts), -1.0)
        # no example of a block is better than its bound; what single precision moves is far below 1e-5
        least = least - 1e-5
        visit((bounds >= least[:, None]) & (bounds > 0) & ~wanted)
        return scores, listed, least

    def nearest_all(self, texts: list[tuple[np.ndarray, np.ndarray]], k: int, without: list[int] | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
        """For every text of terms and counts, examples with the largest cosine above 0, and the cosines as if it had
        no other terms; ties go to the example given first.  `without` are numbers of examples that take no part."""
        none = np.zeros(0, np.int64), np.zeros(0)
        out = [none] * len(texts)
        some = [j for j, (t, _) in enumerate(texts) if len(t)] if len(self.label) else []
        if not some:
            return out
        queries = [self.weigh(*texts[j]) for j in some]
        scores, listed, least = self._scores([texts[j] for j in some], queries, k)
        row, _, largest, own_at, own_row, own_weight, *_ = self.parts
        for at, j in enumerate(some):
            its = scores[:, at].ravel()
            found = np.flatnonzero(its >= max(least[at], 1e-12))
            if len(found) > k + 1:
                its = its[found]
                found = found[its >= np.partition(its, -k - 1)[-k - 1] - 1e-5]
            if without is not None:
                found = found[self.number[found] != without[j]]
            # the frequent terms again, in full
            full, rows = np.zeros(len(largest)), row[texts[j][0]]
            full[rows[rows >= 0]] = queries[at][rows >= 0]
            sizes = own_at[found + 1] - own_at[found]
            own = _ranges(own_at[found], sizes)
            frequent = np.bincount(np.repeat(np.arange(len(found)), sizes), full[own_row[own]] * own_weight[own], len(found))
            exact = np.round(frequent + listed[found // BLOCK, at, found % BLOCK], 12)
            best = np.lexsort((self.number[found], -exact))[:k]
            best = best[exact[best] > 0]
            out[j] = found[best], exact[best]
        return out

    def nearest(self, terms: np.ndarray, counts: np.ndarray, k: int, without: int = -1) -> tuple[np.ndarray, np.ndarray]:
        return self.nearest_all([(terms, counts)], k, [without])[0]

    def vote(self, found: np.ndarray, similarity: np.ndarray) -> float:
        """Share of 1 among the nearest, weighted by squared similarity; with nothing near, that of examples without terms."""
        weights = similarity**2
        return float((weights @ self.label[found] + 0.1 * self.blank) / (weights.sum() + 0.1))


def _together(terms: list[np.ndarray], n_terms: int) -> np.ndarray:
    """An order in which similar examples are neighbours: by the nearest of a few centres over frequent terms, found in
    some rounds from examples spread over all, and within one by the number of terms."""
    n = len(terms)
    sizes = np.array([len(x) for x in terms])
    rows, columns = np.repeat(np.arange(n), sizes), np.concatenate(terms)
    frequent = np.bincount(columns, minlength=n_terms) * FREQUENT > n
    some = frequent[columns]
    matrix = np.zeros((n, int(frequent.sum())), np.float32)
    matrix[rows[some], (np.cumsum(frequent) - 1)[columns[some]]] = 1
    matrix /= np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), 1e-9)
    centres = matrix[np.linspace(0, n - 1, min(64, n)).astype(int)]
    for _ in range(4):
        nearest = np.argmax(matrix @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, matrix)
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9)
    return np.lexsort((sizes, nearest))


def build(terms: list[np.ndarray], counts: list[np.ndarray], labels: np.ndarray, holding: np.ndarray, n_docs: int) -> Index:
    """`holding` is the number of documents, of `n_docs`, with each term."""
    idf = np.log((n_docs + 1) / (holding + 1)) + 1.0
    full = np.array([k for k, x in enumerate(terms) if len(x)], np.int64)
    blank = np.setdiff1d(np.arange(len(terms)), full)
    if len(full):
        full = full[_together([terms[k] for k in full], len(holding))]
    share = float((labels[blank].sum() + 1) / (len(blank) + 2)) if len(blank) else float((labels.sum() + 1) / (len(labels) + 2))
    index = Index(idf, np.cumsum([0, *(len(terms[k]) for k in full)]), np.zeros(0, np.int32), np.zeros(0, np.int32), labels[full], full, share)
    if len(full):
        index.term = np.concatenate([terms[k] for k in full]).astype(np.int32)
        index.count = np.concatenate([counts[k] for k in full]).astype(np.int32)
    return index


def calibration(votes: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic regression of labels on votes, as points to interpolate.  Each pooled step counts one case of
    either label more, so no score is exactly 0 or 1."""
    order = np.argsort(votes, kind="stable")
    steps_: list[list[float]] = []  # ones, cases, sum of votes
    for vote, label in zip(votes[order], labels[order], strict=True):
        steps_.append([label, 1, vote])
        while len(steps_) > 1 and steps_[-2][0] * steps_[-1][1] >= steps_[-1][0] * steps_[-2][1]:
            last = steps_.pop()
            steps_[-1] = [a + b for a, b in zip(steps_[-1], last, strict=True)]
    if not steps_:
        return np.array([0.0, 1.0]), np.array([0.0, 1.0])
    pooled = np.array(steps_)
    smooth = np.maximum.accumulate((pooled[:, 0] + 0.5) / (pooled[:, 1] + 1))
    return pooled[:, 2] / pooled[:, 1], smooth


def joint(votes: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Weights of the log odds of each column of votes, and a constant, by logistic regression; none is negative."""
    x = np.column_stack([_log_odds(votes), np.ones(len(votes))])
    free = np.ones(x.shape[1], bool)
    while True:
        weights = np.zeros(x.shape[1])
        some, ridge = x[:, free], np.eye(free.sum())
        for _ in range(25):
            p = 1 / (1 + np.exp(-np.clip(some @ weights[free], -30, 30)))
            weights[free] -= np.linalg.solve(some.T @ (some * (p * (1 - p))[:, None]) + ridge, some.T @ (p - labels) + ridge @ weights[free])
        if (weights[:-1] >= 0).all():
            return weights
        free[:-1] &= weights[:-1] >= 0


def _log_odds(votes: np.ndarray) -> np.ndarray:
    votes = np.clip(votes, 1e-6, 1 - 1e-6)
    return np.log(votes / (1 - votes))


# --- on Spark


class Model(NamedTuple):
    vocabulary: np.ndarray  # hashes of the examples' terms, ascending
    whole: Index
    telling: Index
    place: np.ndarray  # of each term among the telling ones, or -1
    ids: list

    def near(self, texts: list[tuple[np.ndarray, np.ndarray]], without: Iterable[int] | None = None) -> list[tuple[np.ndarray, np.ndarray, float]]:
        """The nearest by all terms, their cosines as if a text had no other terms, and the vote of the nearest by
        the telling ones."""
        narrow = []
        for terms, counts in texts:
            told = self.place[terms] >= 0
            narrow.append((self.place[terms[told]], counts[told]))
        votes = [self.telling.vote(*x) for x in self.telling.nearest_all(narrow, NEIGHBOURS, without)]
        return [(*x, vote) for x, vote in zip(self.whole.nearest_all(texts, NEIGHBOURS, without), votes, strict=True)]


def _split(column: pa.ListArray) -> list[np.ndarray]:
    bounds = column.offsets.to_numpy()
    return np.split(column.flatten().to_numpy(), bounds[1:-1] - bounds[0]) if len(column) else []


def _model(learned: pa.Table, labels: np.ndarray, vocabulary: np.ndarray, telling: np.ndarray, holding: np.ndarray, n_docs: int) -> Model:
    terms = [np.searchsorted(vocabulary, x.view(np.uint64)) for x in _split(learned.column("hashes").combine_chunks())]
    counts = [x.astype(float) for x in _split(learned.column("counts").combine_chunks())]
    place = np.full(len(vocabulary), -1)
    chosen = np.searchsorted(vocabulary, telling)
    place[chosen] = np.arange(len(chosen))
    told = [place[x] >= 0 for x in terms]
    narrow = build([place[x[m]] for x, m in zip(terms, told, strict=True)], [x[m] for x, m in zip(counts, told, strict=True)], labels, holding[chosen], n_docs)
    return Model(vocabulary, build(terms, counts, labels, holding, n_docs), narrow, place, learned.column("doc_id").to_pylist())


def _own_votes(model):
    """Of the examples in the index, their numbers and votes, each without itself."""

    def vote(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learned = model.value
        index = learned.whole
        for batch in batches:
            for first in range(0, batch.num_rows, TOGETHER):
                some = batch.column("id").slice(first, TOGETHER).to_numpy()
                spans = [slice(index.start[e], index.start[e + 1]) for e in some]
                near = learned.near([(index.term[x], index.count[x].astype(float)) for x in spans], index.number[some])
                votes = [index.vote(found, similarity) for found, similarity, _ in near]
                yield pa.RecordBatch.from_arrays([pa.array(index.number[some]), pa.array(votes), pa.array([x[2] for x in near])], names=["number", "whole", "telling"])

    return vote


def _nearest(narrow: DataFrame, model) -> DataFrame:
    """`doc_id`, the nearest examples (`near`) and `cosines` as if the text had only terms of theirs, the sum of these
    terms' squared weights (`square`), the vote of the `telling` ones, and the `others` with `other_counts`."""

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learned = model.value
        earlier: dict[bytes, tuple] = {}
        for batch in batches:
            for part, data, offsets in steps(batch):
                rows, hashes, counts = _counted(*term_hashes(data, offsets))
                at, known = _numbered(learned.vocabulary, hashes)
                bounds = np.searchsorted(rows[known], np.arange(part.num_rows + 1))
                terms, their_counts = np.split(at[known], bounds[1:-1]), np.split(counts[known], bounds[1:-1])
                keys = [hashlib.blake2b(t.tobytes() + c.tobytes()).digest() for t, c in zip(terms, their_counts, strict=True)]
                if len(earlier) > 20_000:
                    earlier.clear()
                new = list({key: k for k, key in enumerate(keys) if key not in earlier}.values())
                for first in range(0, len(new), TOGETHER):
                    some = new[first : first + TOGETHER]
                    texts = [(terms[k], their_counts[k].astype(float)) for k in some]
                    for k, text, x in zip(some, texts, learned.near(texts), strict=True):
                        earlier[keys[k]] = (*x, (learned.whole.weights(*text) ** 2).sum())
                near = [earlier[key] for key in keys]
                sizes = pa.array(np.cumsum([0, *(len(x[0]) for x in near)]).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"), *[pa.ListArray.from_arrays(sizes, pa.array(np.concatenate([x[c] for x in near]), kind)) for c, kind in ((0, pa.int32()), (1, pa.float64()))],
                        pa.array([x[3] for x in near], pa.float64()), pa.array([x[2] for x in near], pa.float64()),
                        *_lists(rows[~known], part.num_rows, hashes[~known].view(np.int64), counts[~known].astype(np.int32)),
                    ],
                    names=["doc_id", "near", "cosines", "square", "telling", "others", "other_counts"],
                )

    kind = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.mapInArrow(search, f"doc_id {kind}, near array<int>, cosines array<double>, square double, telling double, others array<long>, other_counts array<int>")


def toxicity(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = FOLDS, held: int = HELD, most: int = MAX_EXAMPLES, doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """`doc_id`, `score` from 0 to 1, and `evidence`: the nearest examples (doc_id, similarity, label) by the cosine
    of all terms, nearest first, of every row of `docs`.

    Labels are learned outside the held-out fold only, from at most `most` labelled documents with at most
    `MAX_ENTRIES` different terms together; null and contradicting labels teach nothing.  A text that shares no term with any example, an empty or null one too,
    has the share of 1 among examples without terms.  With no examples, or of one label, every score is the
    smoothed share of 1.  A long text is taken whole, which needs some ten bytes for each of its own in the worker.
    Repeated rows are kept; other columns are ignored.  Runs jobs: the examples' texts and
    vectors, and narrow rows of all documents, are written once to the shared folder.
    """
    spark = docs.sparkSession
    chosen = known(labels, label, folds, held, most, doc_id)
    texts = stage(examples(docs, chosen, doc_id, text), "example-texts")
    telling = choose_terms(texts)
    single = texts.groupBy("doc_id").agg(F.min(F.struct("label", "text")).alias("x")).select("doc_id", "x.*")
    learned = stage(hashed(single).withColumn("order", F.xxhash64("doc_id")), "example-terms")
    before = F.sum(F.size("hashes")).over(Window.orderBy("order", "doc_id"))  # of `most` rows
    learned = learned.withColumn("before", before).where(F.col("before") <= MAX_ENTRIES).drop("before").toArrow()
    learned = learned.take(pa.compute.sort_indices(learned, [("order", "ascending"), ("doc_id", "ascending")])).combine_chunks()
    vocabulary = np.unique(learned.column("hashes").combine_chunks().flatten().to_numpy().view(np.uint64))
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    n_docs, held_by = holding(narrow, vocabulary)
    their_labels = learned.column("label").to_numpy().astype(float)
    model = spark.sparkContext.broadcast(_model(learned, their_labels, vocabulary, telling, held_by, n_docs))
    votes = spark.range(int((np.diff(learned.column("hashes").combine_chunks().offsets) > 0).sum())).mapInArrow(_own_votes(model), "number long, whole double, telling double").toArrow().sort_by("number")
    own = their_labels[votes.column("number").to_numpy()]
    votes = np.column_stack([votes.column(c).to_numpy() for c in ("whole", "telling")])
    weights = joint(votes, own)
    points = calibration(_log_odds(votes) @ weights[:-1] + weights[-1], own)
    n, ones = len(their_labels), their_labels.sum()
    if not 0 < ones < n:
        points = np.array([0.0, 1.0]), np.full(2, (ones + 1) / (n + 2))
    found = stage(_nearest(narrow, model).withColumn("row", F.monotonically_increasing_id()), "nearest")

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learned = model.value
        index = learned.whole
        for batch in batches:
            whole, evidence, any_near = [], [], []
            shares = np.sqrt(batch.column("square").to_numpy() / np.maximum(batch.column("square").to_numpy() + batch.column("rest").to_numpy(), 1e-300))
            for near, cosines, share in zip(_split(batch.column("near")), _split(batch.column("cosines")), shares, strict=True):
                similarity = np.round(cosines * share, 12)
                whole.append(index.vote(near, similarity))
                any_near.append(len(near) > 0)
                evidence.append([{"doc_id": learned.ids[index.number[e]], "similarity": float(s), "label": int(index.label[e])} for e, s in zip(near[:3], similarity[:3], strict=True)])
            odds = _log_odds(np.column_stack([whole, batch.column("telling").to_numpy()]))
            scores = np.interp(odds @ weights[:-1] + weights[-1], *points)
            scores = np.where(any_near, scores, index.blank) if 0 < ones < n else scores
            kind = pa.list_(pa.struct([("doc_id", batch.schema.field("doc_id").type), ("similarity", pa.float64()), ("label", pa.int32())]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64()), pa.array(evidence, kind)], names=["doc_id", "score", "evidence"])

    kind = found.schema["doc_id"].dataType.simpleString()
    whole = found.drop("others", "other_counts").join(rests(found, n_docs).hint("shuffle_hash"), "row", "left").withColumn("rest", F.coalesce("rest", F.lit(0.0)))
    return whole.drop("row").mapInArrow(score, f"doc_id {kind}, score double, evidence array<struct<doc_id:{kind},similarity:double,label:int>>")


# --- query


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", fold(F.col("doc_id"), FOLDS, HELD).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
