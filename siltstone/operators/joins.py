"""Joins that need more than ``DataFrame.join``.

Inner, left and anti joins are written as plain joins: adaptive execution splits their hot shuffle
partitions at run time.  It cannot do so for a full outer join, nor for the right side of a left
join, so ``salted_join`` splits hot keys itself for these.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from siltstone.sources.stage import stage

HOT_ROWS = 1_000_000  # rows of one key that fill a task
BROADCAST_KEYS = 1_000_000  # hot keys to broadcast at most; more are joined
TRACKED = 1 << 14  # keys that a sketch tracks at first: whole for 4.6 billion rows at a million rows a hot key
MOST_TRACKED = 1_000_000

#: A sketch that tracks ``m`` keys of ``n`` rows misses no key with more than this times ``n / m`` rows.
_MISSED = 3.5
_SKETCHED = (T.BooleanType, T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType, T.StringType)


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_KEYS else df


class _Profile(NamedTuple):
    """What one scan tells of a key column."""

    keys: DataFrame | None  # hot keys ``k`` with about their rows ``n``; None where there are none
    n_keys: int
    nulls: int


def _counted(narrow: DataFrame, hot_rows: int) -> DataFrame:
    """Counts of all keys, for types that no sketch takes."""
    counts = narrow.groupBy("k").agg(F.count("*").alias("rows"))
    items = F.collect_list(F.when(F.col("k").isNotNull() & (F.col("rows") >= hot_rows), F.struct(F.col("k").alias("item"), F.col("rows").alias("count"))))
    return counts.agg(items.alias("items"), F.sum("rows").alias("n"), F.coalesce(F.sum(F.when(F.col("k").isNull(), F.col("rows"))), F.lit(0)).alias("nulls"))


def _sketched(narrow: DataFrame, hot_rows: int, tracked: int) -> DataFrame:
    """Sketches of map tasks, merged in as many groups as shuffles have partitions, and these in one."""
    spark = narrow.sparkSession
    slices = spark.conf.get("spark.sql.shuffle.partitions")
    parts = spark.sql(
        f"SELECT approx_top_k_accumulate(k, {tracked}) FILTER (WHERE k IS NOT NULL) AS sketch, count(*) AS n, count_if(k IS NULL) AS nulls"
        f" FROM {{keys}} GROUP BY spark_partition_id() % {slices}", keys=narrow)
    # grouped by a constant, since an empty partition has no sketch to give
    return spark.sql(
        f"SELECT filter(approx_top_k_estimate(approx_top_k_combine(sketch, {tracked}), {tracked}), x -> x.item IS NOT NULL AND x.count >= {hot_rows}) AS items,"
        " sum(n) AS n, sum(nulls) AS nulls FROM {parts} GROUP BY n IS NULL", parts=parts)


def _profile(df: DataFrame, key: str, hot_rows: int, tracked: int = TRACKED) -> _Profile:
    """Hot keys and NULLs of a column, in one scan.

    A frequent-items sketch combines map-side and merges to one row, so no key is shuffled.  It may count a key a
    little too high, but reports only keys that are there.  Should the frame turn out too large for what is
    tracked, the scan is repeated once with a sketch of the right size.
    """
    narrow = df.select(F.col(f"`{key}`").alias("k"))
    if not isinstance(narrow.schema["k"].dataType, _SKETCHED):
        found = stage(_counted(narrow, hot_rows), "key_counts")
    else:
        found = stage(_sketched(narrow, hot_rows, tracked), "key_sketch")
    facts = found.select("n", "nulls", F.size("items").alias("n_keys")).first()
    if facts is None or facts["n"] is None:
        return _Profile(None, 0, 0)
    needed = min(1 << math.ceil(math.log2(max(_MISSED * facts["n"] / hot_rows, 1))), MOST_TRACKED)
    if needed > tracked and isinstance(narrow.schema["k"].dataType, _SKETCHED):
        return _profile(df, key, hot_rows, needed)
    keys = found.select(F.explode("items").alias("x")).select(F.col("x.item").alias("k"), F.col("x.count").alias("n")) if facts["n_keys"] else None
    return _Profile(keys, facts["n_keys"], facts["nulls"])


class Skew(NamedTuple):
    """Hot keys of two sides, ``(__k, __nl, __nr)`` with about their rows on each side, 0 where a key is not hot
    there; their number at most; and the NULL keys of each side."""

    keys: DataFrame | None
    n_keys: int
    left_nulls: int
    right_nulls: int


def key_skew(left: DataFrame, right: DataFrame, left_on: str, right_on: str, hot_rows: int = HOT_ROWS) -> Skew:
    """Keys with ``hot_rows`` rows or more on either side, from one scan of each side's key column."""
    lhs, rhs = _profile(left, left_on, hot_rows), _profile(right, right_on, hot_rows)
    zero = F.lit(0).cast("bigint")
    sides = []
    if lhs.keys is not None:
        sides.append(lhs.keys.select(F.col("k").alias("__k"), F.col("n").alias("__nl"), zero.alias("__nr")))
    if rhs.keys is not None:
        sides.append(rhs.keys.select(F.col("k").alias("__k"), zero.alias("__nl"), F.col("n").alias("__nr")))
    if not sides:
        return Skew(None, 0, lhs.nulls, rhs.nulls)
    either = sides[0] if len(sides) == 1 else sides[0].union(sides[1])
    keys = stage(either.groupBy("__k").agg(F.max("__nl").alias("__nl"), F.max("__nr").alias("__nr")), "hot_keys")
    return Skew(keys, lhs.n_keys + rhs.n_keys, lhs.nulls, rhs.nulls)


def _has_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(_has_map(f.dataType) for f in kind.fields)
    return isinstance(kind, T.MapType) or isinstance(kind, T.ArrayType) and _has_map(kind.elementType)


def _slot(df: DataFrame, slices: Column) -> Column:
    """Where a row of a split key goes.  A re-run task places its rows as before.  The partition is part of
    the hash because very many equal rows would otherwise all go to one place.  Maps have no hash."""
    content = [F.col(f"`{f.name}`") for f in df.schema.fields if not _has_map(f.dataType)]
    return F.pmod(F.xxhash64(*content, F.spark_partition_id()), slices)


def salted_join(left: DataFrame, right: DataFrame, left_on: str, right_on: str, how: str = "full",
                hot_rows: int = HOT_ROWS, hot: DataFrame | None = None) -> DataFrame:
    """``left.join(right, left_on == right_on, how)`` for ``inner``, ``left`` and ``full``, with hot keys split.

    A key with ``n`` rows on one side is cut into ``ceil(n / hot_rows)`` slices, and the
    other side's rows of that key are copied to each slice, so every matching pair meets in one cell.
    A copied row may find its own cell empty although the key matches in another.  Rows are copied only where
    their key is hot on the other side, and such a key is surely there, so an unmatched copy is never a true outer
    row.  NULL keys are spread over as many places as they fill.  Without hot keys this is one plain join.
    ``hot`` gives hot keys with their rows, as ``key_skew`` does, where they are known.  Runs jobs that read the
    key column of either side once.
    """
    if how not in ("inner", "left", "full"):
        raise ValueError(f"unsupported join type: {how}")
    if hot is None:
        hot, n_hot, left_nulls, right_nulls = key_skew(left, right, left_on, right_on, hot_rows)
    else:
        n_hot = hot.count()
        left_nulls, right_nulls = (0 if how == "inner" else df.where(F.col(f"`{c}`").isNull()).count() for df, c in ((left, left_on), (right, right_on)))
    # only a full join keeps NULL keys of its right side; an inner join keeps none
    left_nulls = math.ceil(left_nulls / hot_rows) if how != "inner" else 0
    right_nulls = math.ceil(right_nulls / hot_rows) if how == "full" else 0
    if not n_hot and max(left_nulls, right_nulls) <= 1:
        lhs, rhs = left.withColumn("__left_key", F.col(f"`{left_on}`")), right.withColumn("__right_key", F.col(f"`{right_on}`"))
        return lhs.join(rhs, F.col("__left_key") == F.col("__right_key"), how).drop("__left_key", "__right_key")

    plan = None if not n_hot else hot.select(
        "*",
        F.greatest(F.ceil(F.col("__nl") / hot_rows), F.lit(1)).alias("__sl"),
        F.greatest(F.ceil(F.col("__nr") / hot_rows), F.lit(1)).alias("__sr"),
    )

    def cells(df: DataFrame, key: str, own: str, other: str, nulls: int, names: tuple[str, str, str, str, str]) -> DataFrame:
        mine, theirs, n_other, present, kept_key = names
        value = F.col(f"`{key}`")
        tagged = df.join(_small(plan, n_hot), value == F.col("__k"), "left") if n_hot else df.withColumns(
            {c: F.lit(None).cast("bigint") for c in ("__k", "__nl", "__nr", "__sl", "__sr")})
        slices = F.when(value.isNull(), F.lit(max(nulls, 1))).otherwise(F.coalesce(own, F.lit(1)))
        copies = F.sequence(F.lit(0).cast("bigint"), F.coalesce(other, F.lit(1)) - 1)
        return tagged.select(
            *[F.col(f"`{c}`") for c in df.columns],
            _slot(df, slices).alias(mine),
            F.explode(copies).alias(theirs),
            F.coalesce("__nr" if own == "__sl" else "__nl", F.lit(0)).alias(n_other),
            F.lit(True).alias(present),
            value.alias(kept_key),
        )

    lhs = cells(left, left_on, "__sl", "__sr", left_nulls, ("__i", "__j", "__right_n", "__in_left", "__left_key"))
    rhs = cells(right, right_on, "__sr", "__sl", right_nulls, ("__rj", "__ri", "__left_n", "__in_right", "__right_key"))
    joined = lhs.join(
        rhs,
        (F.col("__left_key") == F.col("__right_key")) & (F.col("__i") == F.col("__ri")) & (F.col("__j") == F.col("__rj")),
        how,
    )
    if how != "inner":
        joined = joined.where(
            (F.col("__in_left").isNotNull() & F.col("__in_right").isNotNull())
            | (F.col("__in_right").isNull() & (F.col("__right_n") == 0))
            | (F.col("__in_left").isNull() & (F.col("__left_n") == 0))
        )
    return joined.drop("__i", "__j", "__ri", "__rj", "__right_n", "__left_n", "__in_left", "__in_right", "__left_key", "__right_key")


def dimension_join(df: DataFrame, dimension: DataFrame, on: str, max_rows: int = 100_000, max_bytes: int = 64 << 20) -> DataFrame:
    """Left join to a dimension table, broadcast once its size is checked in rows and bytes (as JSON text), an
    ordinary join beyond that."""
    some = dimension.limit(max_rows + 1).select(F.length(F.to_json(F.struct("*"))).alias("size"))
    found = some.agg(F.count("*").alias("n"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes")).first()
    fits = found["n"] <= max_rows and found["bytes"] <= max_bytes
    return df.join(F.broadcast(dimension) if fits else dimension, on, "left")


def parent_lookup(df: DataFrame, parent_id: str, id_: str, bring: dict[str, str]) -> DataFrame:
    """Left self-join to the parent row; ``bring`` maps the parent's columns to new names."""
    parents = df.select(F.col(id_).alias("__parent"), *[F.col(s).alias(t) for s, t in bring.items()])
    return df.join(parents, F.col(parent_id) == F.col("__parent"), "left").drop("__parent")


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Pre-flight check: key values that occur more than once, with their counts."""
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).where("copies > 1")
