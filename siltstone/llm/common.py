"""What the operators share: table reads, Arrow text buffers, and words as numpy arrays.

Texts are handled as the bytes of an Arrow string column.  Words, their hashes and the hashes of word
sequences are computed for many documents at once, so no Python code runs per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Bytes of text that one vectorised step takes together; a longer text is a step of its own.
STEP_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def separators(spaces: bool) -> np.ndarray:
    """Which bytes part words: ASCII white space, or every ASCII character but letters and digits."""
    sep = np.zeros(256, bool)
    if spaces:
        sep[[0x20, *range(0x09, 0x0E)]] = True
    else:
        sep[:0x80] = True
        for first, last in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A)):
            sep[first : last + 1] = False
    return sep


#: `[^\x20\x09-\x0D]+`
SPACES = separators(True)
#: `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` of a text whose A-Z are lower-cased first
MARKS = separators(False)
#: A-Z to a-z, other bytes unchanged
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the n + 1 offsets of its rows; null rows are empty."""
    column = column.cast(pa.string()).fill_null("")
    width = np.dtype(np.int32)
    offsets = np.frombuffer(column.buffers()[1], width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and len(data) else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def steps(batch: pa.RecordBatch, text: str = "text", step_bytes: int = STEP_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of a batch with at most `step_bytes` of text (or one row), with their bytes and offsets."""
    data, offsets = text_bytes(batch.column(text))
    first = 0
    while first < batch.num_rows:
        last = int(np.searchsorted(offsets, offsets[first] + step_bytes, side="right")) - 1
        last = min(max(last, first + 1), batch.num_rows)
        yield batch.slice(first, last - first), data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def word_spans(data: np.ndarray, offsets: np.ndarray, sep: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte, end byte and row of every word."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = ~sep[data]
    border = offsets[offsets < len(data)]
    before = np.empty(len(data), bool)
    before[0], before[1:] = False, inside[:-1]
    before[border] = False
    after = np.empty(len(data), bool)
    after[-1], after[:-1] = False, inside[1:]
    after[border[border > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def text_pieces(data: np.ndarray, sep: np.ndarray, carried: int = 0, piece_bytes: int = 4 * STEP_BYTES) -> Iterator[tuple[np.ndarray, int]]:
    """One text in pieces that end between words, and how many of a piece's words the one before has had: the
    last `carried`, or fewer where there are fewer.  A word longer than a piece makes its piece longer."""
    first = begin = known = 0
    while True:
        end = begin + piece_bytes
        while end < len(data):
            window = np.flatnonzero(sep[data[end : end + piece_bytes]])
            if len(window):
                end += int(window[0])
                break
            end += piece_bytes
        if end >= len(data):
            yield data[first:], known
            return
        yield data[first:end], known
        starts, _, _ = word_spans(data[first:end], np.array([0, end - first]), sep)
        known = min(carried, len(starts))
        first, begin = (first + int(starts[len(starts) - known]) if known else end), end


def row_bounds(rows: np.ndarray, n: int) -> np.ndarray:
    """Of ascending row numbers, where each of the n rows starts; n + 1 entries."""
    return np.searchsorted(rows, np.arange(n + 1))


class _Powers:
    """Powers of an odd number and of its inverse modulo 2**64, extended as needed."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            for name, base in (("up", self.base), ("down", self.inverse)):
                powers = np.full(size, base, np.uint64)
                powers[0] = 1
                setattr(self, name, np.multiply.accumulate(powers))
        return self.up[:n], self.down[:n]


_BYTE_POWERS = _Powers(0x9E3779B97F4A7C15)
_WORD_POWERS = _Powers(0xD1342543DE82EF95)
_BYTE_CODES = np.random.Generator(np.random.PCG64(7)).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose every output bit depends on every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _sums(codes: np.ndarray, powers: _Powers) -> np.ndarray:
    up, _ = powers.get(len(codes) + 1)
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(codes * up[:-1], out=sums[1:])
    return sums


def _of_sums(sums: np.ndarray, powers: _Powers, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    _, down = powers.get(len(sums))
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def range_sums(data: np.ndarray) -> np.ndarray:
    """What `sums_hash` needs, computed once for all ranges of the same bytes."""
    return _sums(_BYTE_CODES[data], _BYTE_POWERS)


def sums_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte range, by its content alone."""
    return _of_sums(sums, _BYTE_POWERS, starts, ends)


def byte_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return sums_hash(range_sums(data), starts, ends)


def sequence_sums(words: np.ndarray) -> np.ndarray:
    """What `sequence_hash` needs, computed once for all lengths."""
    return _sums(words, _WORD_POWERS)


def sequence_hash(sums: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """A 64-bit hash of the `length` word hashes from each start."""
    return _of_sums(sums, _WORD_POWERS, starts, starts + length)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each `width` consecutive values, by doubling."""
    out, done = values, 1
    while done < width:
        step = min(done, width - done)
        out = np.minimum(out[:-step], out[step:])
        done += step
    return out
