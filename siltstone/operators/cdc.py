"""Latest record per key out of a change feed, as a batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def latest_struct(df: DataFrame, sequence: str | Column) -> Column:
    """Aggregate: the row with the highest sequence, as a struct.

    ``max`` of a struct compares the sequence first and then the remaining fields in column order, so
    tied sequences resolve the same way in every run.  Rows combine map-side, so a key with very many
    changes costs each map task one row; a window would bring them all to one task.
    """
    seq = F.col(sequence) if isinstance(sequence, str) else sequence
    return F.max(F.struct(seq.alias("__seq"), *df.columns))


def scd1_batch(df: DataFrame, keys: Sequence[str], sequence: str | Column) -> DataFrame:
    """One row per key: the one with the highest sequence.  Rows with a NULL sequence are ignored.

    A text sequence compares as text (``'9' > '10'``); pass a cast expression to compare numbers.
    """
    seq = F.col(sequence) if isinstance(sequence, str) else sequence
    top = df.where(seq.isNotNull()).groupBy(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)])
    return top.agg(latest_struct(df, sequence).alias("__top")).select(*[F.col(f"__top.`{c}`") for c in df.columns])
