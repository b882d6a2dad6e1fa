"""Quality scores: gradient-boosted trees on histograms of document statistics.

The statistics come from the bytes of many texts at once.  Trees are trained on a bounded sample of labelled
documents and kept as flat arrays of complete trees, which numpy walks for all trees and rows of a batch
together.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.llm.common import SPACES, byte_hash, steps, table, word_spans
from siltstone.llm.labelled import examples, fold, known

#: Labelled documents that a model is trained on, at most.
MAX_EXAMPLES = 20_000
FOLDS, HELD = 3, 1


# --- statistics

#: Kinds of bytes: white space, lower, upper, digit, sentence marks, "!" and "?", bars, other marks, beyond ASCII
_KINDS = 9
_KIND = np.full(256, 7, np.int64)
for _kind, _bytes in enumerate((b" \t\n\r\x0b\x0c", b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".,;:'\"()-", b"!?", b"|")):
    _KIND[list(_bytes)] = _kind
_KIND[0x80:] = 8

STATISTICS = (
    "log_words", "log_bytes", "word_bytes", "spaces", "lower", "upper", "digits", "sentence_marks", "shouts", "bars", "other_marks", "beyond_ascii",
    "distinct_words", "top_word", "line_words", "repeated_lines", "longest_word", "short_words", "marked_words", "shouted_words",
)


def _runs(rows: np.ndarray, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each row, the number of different hashes and the count of the commonest."""
    distinct, most = np.zeros(n), np.zeros(n)
    if len(rows):
        order = np.lexsort((hashes, rows))
        rows, hashes = rows[order], hashes[order]
        first = np.flatnonzero(np.concatenate([[True], (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])]))
        counts = np.diff(np.append(first, len(rows)))
        distinct = np.bincount(rows[first], minlength=n).astype(float)
        np.maximum.at(most, rows[first], counts)
    return distinct, most


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of `STATISTICS` for each text."""
    n = len(offsets) - 1
    sizes = np.diff(offsets).astype(float)
    row = np.repeat(np.arange(n), np.diff(offsets))
    kinds = np.bincount(row * _KINDS + _KIND[data], minlength=n * _KINDS).reshape(n, _KINDS) / np.maximum(sizes, 1)[:, None]
    starts, ends, rows = word_spans(data, offsets, SPACES)
    lengths = ends - starts
    count = lambda chosen=None: np.bincount(rows if chosen is None else rows[chosen], minlength=n).astype(float)
    words = count()
    per_word = np.maximum(words, 1)
    hashes = byte_hash(data, starts, ends)
    distinct, top = _runs(rows, hashes, n)
    is_line = np.zeros(256, bool)
    is_line[0x0A] = True
    line_starts, line_ends, line_rows = word_spans(data, offsets, is_line)
    lines = np.bincount(line_rows, minlength=n).astype(float)
    different, _ = _runs(line_rows, byte_hash(data, line_starts, line_ends), n)
    longest = np.zeros(n)
    np.maximum.at(longest, rows, lengths)
    kind_first, kind_last = _KIND[data[starts]], _KIND[data[ends - 1]]
    kind_inner = _KIND[data[np.maximum(ends - 2, starts)]]
    return np.column_stack([
        np.log1p(words), np.log1p(sizes), np.bincount(rows, lengths, minlength=n) / per_word, kinds, distinct / per_word, top / per_word, words / np.maximum(lines, 1),
        1 - different / np.maximum(lines, 1), np.log1p(longest), count(lengths <= 3) / per_word, count(kind_last == 7) / per_word,
        count((kind_first == 2) & ((kind_inner == 2) | (kind_last == 5))) / per_word,
    ])


# --- trees


class Trees(NamedTuple):
    """Complete trees of one depth: node k of a tree has the children 2k + 1 and 2k + 2; `leaf` follows the
    inner nodes.  A row goes right where its value is above the threshold."""

    base: float
    feature: np.ndarray  # trees x inner nodes
    threshold: np.ndarray
    leaf: np.ndarray  # trees x leaves

    def raw(self, values: np.ndarray) -> np.ndarray:
        trees, inner = self.feature.shape
        if not trees:
            return np.full(len(values), self.base)
        tree = np.arange(trees)
        node = np.zeros((len(values), trees), np.int64)
        row = np.arange(len(values))[:, None]
        while node[0, 0] < inner if len(values) else False:
            right = values[row, self.feature[tree, node]] > self.threshold[tree, node]
            node = 2 * node + 1 + right
        return self.base + self.leaf[tree, node - inner].sum(axis=1)

    def score(self, values: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.raw(values)))


def train(values: np.ndarray, labels: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64, least: float = 2.0, ridge: float = 1.0) -> Trees:
    """Boosting with logistic loss.  Values are cut into `bins` quantile bins once; each level sums gradients
    per node and bin, and takes the split with the largest gain.  Without rows, or with one class, the
    score is the smoothed share of 1."""
    n, width = values.shape
    share = (labels.sum() + 1) / (n + 2)
    base, inner = float(np.log(share / (1 - share))), 2**depth - 1
    feature, threshold, leaf = np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, inner + 1))
    if not 0 < labels.sum() < n:
        return Trees(base, feature[:0], threshold[:0], leaf[:0])
    cuts = [np.unique(np.quantile(values[:, f], np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for f in range(width)]
    binned = np.column_stack([np.searchsorted(cuts[f], values[:, f], side="left") for f in range(width)])
    raw = np.full(n, base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-raw))
        gradient, weight = labels - p, p * (1 - p)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, here = 2**level - 1, 2**level
            at = node - first
            gain, choice = np.zeros(here), np.zeros((here, 2), np.int64)
            for f in range(width):
                key = at * bins + binned[:, f]
                g = np.bincount(key, gradient, here * bins).reshape(here, bins).cumsum(axis=1)
                h = np.bincount(key, weight, here * bins).reshape(here, bins).cumsum(axis=1)
                g_all, h_all = g[:, -1:], h[:, -1:]
                won = g**2 / (h + ridge) + (g_all - g) ** 2 / (h_all - h + ridge) - g_all**2 / (h_all + ridge)
                won = np.where((h >= least) & (h_all - h >= least), won, 0)[:, : len(cuts[f])]
                if won.shape[1]:
                    best = won.argmax(axis=1)
                    better = won[np.arange(here), best] > gain + 1e-12
                    gain[better] = won[np.arange(here), best][better]
                    choice[better] = np.column_stack([np.full(here, f), best])[better]
            for k in np.flatnonzero(gain > 0):
                feature[t, first + k], threshold[t, first + k] = choice[k, 0], cuts[choice[k, 0]][choice[k, 1]]
            node = 2 * node + 1 + (values[np.arange(n), feature[t, node]] > threshold[t, node])
        end = node - inner
        leaf[t] = rate * np.bincount(end, gradient, inner + 1) / (np.bincount(end, weight, inner + 1) + ridge)
        raw += leaf[t, end]
    return Trees(base, feature, threshold, leaf)


# --- on Spark


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = FOLDS, held: int = HELD, most: int = MAX_EXAMPLES) -> Trees:
    """Trees trained on at most `most` labelled documents outside the held-out fold.  Only their statistics,
    one row an id, come to the driver.  Runs a job."""
    chosen = examples(docs, known(labels, label, folds, held, most))

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in steps(batch):
                found = statistics(data, offsets)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("label"), pa.array(list(found), pa.list_(pa.float64()))], names=["doc_id", "label", "statistics"])

    kind = chosen.schema["doc_id"].dataType.simpleString()
    measured = chosen.mapInArrow(measure, f"doc_id {kind}, label int, statistics array<double>")
    one = measured.groupBy("doc_id").agg(F.min(F.struct("label", "statistics")).alias("x")).select("doc_id", "x.*").orderBy("doc_id").toArrow()
    values = np.array(one.column("statistics").to_pylist(), float).reshape(-1, len(STATISTICS))
    return train(values, one.column("label").to_numpy().astype(float))


def scored(docs: DataFrame, model: Trees, carry: list[str] | None = None, text: str = "text") -> DataFrame:
    """The `carry` columns of `docs` (all by default), and `quality_score`, from 0 to 1, by the text alone.

    Null texts are empty; empty texts are scored like any other.  A long text is taken whole, which needs some ten
    bytes for each of its own in the worker.  Repeated rows are kept.  A column of `docs`
    named `quality_score` is replaced.
    """
    carry = [c for c in (docs.columns if carry is None else carry) if c.lower() != "quality_score"]
    frame = docs.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in steps(batch):
                yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(sent.value.score(statistics(data, offsets)))], names=["row", "quality_score"])

    return frame.mapInArrow(score, T.StructType([frame.schema["row"], T.StructField("quality_score", T.DoubleType())])).select("row.*", "quality_score")


# --- query and stage


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return scored(docs, model, ["doc_id"]).select(
        "doc_id", fold(F.col("doc_id"), FOLDS, HELD).alias("held_out"), F.col("quality_score").alias("score"), (F.col("quality_score") >= 0.5).cast("int").alias("predicted")
    )


def accepted(docs: DataFrame, labels: DataFrame, least: float = 0.5) -> DataFrame:
    """The documents that score `least` or more, unchanged and with all their columns, whatever their names; see
    `scored` for nulls and repeated rows.  An empty table stays empty."""
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("document"), F.col("text"))
    return scored(whole, fit(docs, labels), ["document"]).where(F.col("quality_score") >= least).select("document.*")
