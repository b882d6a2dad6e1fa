"""Entity matching by name: exact, within an edit distance, and the cascade of both."""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from siltstone.operators.joins import salted_join
from siltstone.sources.files import children, exists
from siltstone.sources.stage import stage

NAMES_PER_TASK = 20_000  # when each grows to its deletion neighbourhood
BROADCAST_SEGMENTS = 1_000_000  # dense segments to broadcast at most, eight bytes each


class Rules(NamedTuple):
    """When two names are close, and what the search for them may cost."""

    threshold: int = 2            # edits at most
    min_length: int = 6           # shorter names are never matched by distance
    hot_bucket: int = 100_000     # names sharing one segment that fill a task
    neighbour_cost: float = 1.0   # of one deletion neighbour, in candidates; 0 avoids every shared segment


class Side(NamedTuple):
    """A matched source: its rows, their id column and their name column."""

    rows: DataFrame
    id: str
    name: str

    def with_rows(self, rows: DataFrame) -> Side:
        return self._replace(rows=rows)


def exact_match(left: Side, right: Side) -> DataFrame:
    """Row pairs whose names are equal but for case."""
    return left.rows.join(right.rows, F.lower(left.rows[left.name]) == F.lower(right.rows[right.name]), "inner")


def _has_name_in(side: Side, names: DataFrame) -> DataFrame:
    """Ids of the rows whose lower-case name occurs in ``names.name``."""
    return (
        side.rows.select(F.col(side.id).alias("__id"), F.lower(side.name).alias("__name"))
        .join(names, F.col("__name") == F.col("name"), "left_semi")
        .select("__id").distinct()
    )


def without_ids(side: Side, ids: DataFrame) -> DataFrame:
    """Rows whose id is not in ``ids.__id``; a NULL id is kept."""
    return side.rows.join(ids, F.col(side.id) == F.col("__id"), "left_anti")


def unmatched(side: Side, other: Side) -> DataFrame:
    """Rows of ``side`` whose id has no exact match.  Needs the names only, not the row pairs."""
    names = other.rows.select(F.lower(other.name).alias("name")).where("name is not null").distinct()
    return without_ids(side, _has_name_in(side, names))


def _long_enough(c: str, min_length: int) -> Column:
    return F.length(c) >= min_length


def _names(side: Side, out: str, min_length: int) -> DataFrame:
    return side.rows.where(_long_enough(side.name, min_length)).select(F.lower(side.name).alias(out)).distinct()


def _segment_keys(names: DataFrame, c: str, threshold: int, probing: bool) -> DataFrame:
    """Rows ``(c, seg)``: hashes of (length, position, text) of segments of each name.

    A name is cut into ``threshold + 1`` near-equal segments, the last ones longer by a character where
    the length is not a multiple.  For the indexed side these are its own segments.  The probing side
    takes, for every length a partner can have, the substrings at the shifts allowed by the
    multi-match-aware rule of the Pass-Join paper (Li, Deng, Wang, Feng, VLDB 2011).
    """
    m = threshold + 1
    cuts = [(0, i, 0) for i in range(m)]
    if probing:
        cuts = [
            (delta, i, shift)  # delta: own length minus the partner's
            for delta in range(-threshold, threshold + 1)
            for i in range(m)
            for shift in range(max(-i, delta - (threshold - i)), min(i, delta + (threshold - i)) + 1)
        ]
    table = ", ".join(f"struct({d} AS delta, {i} AS i, {s} AS shift)" for d, i, s in cuts)
    return (
        names.select(c, F.expr(f"inline(array({table}))"))
        .selectExpr(c, "i", "shift", f"length({c}) - delta AS len")
        .selectExpr(c, "i", "shift", "len", f"CAST(len DIV {m} AS INT) AS short", f"len % {m} AS longer")
        .selectExpr(
            c, "i", "len",
            f"short + IF(i >= {m} - longer, 1, 0) AS size",
            f"short * i + greatest(0, i - {m} + longer) + shift AS at",
        )
        .where(f"at >= 0 AND at + size <= length({c})")
        .selectExpr(c, f"xxhash64(len, i, substring({c}, at + 1, size)) AS seg")
    )


def _deletions(names: DataFrame, c: str, threshold: int) -> DataFrame:
    """Rows ``(c, rest)``: hashes of all texts left after deleting up to ``threshold`` characters.

    Deletions go left to right and take the first character of a run only, which reaches every text
    and hardly ever the same one twice.  ``p`` is where the next deletion may start, 0 when done.
    """
    rows = names.select(c, F.col(c).alias("v"), F.lit(1).alias("p"))
    for _ in range(threshold):
        rows = (
            rows.select(c, "v", F.explode_outer(F.expr(
                "IF(p BETWEEN 1 AND length(v), array(0) || sequence(p, length(v)), array(0))"
            )).alias("p"))
            .where("p <= 1 OR substring(v, p, 1) <> substring(v, p - 1, 1)")
            .selectExpr(c, "IF(p = 0, v, left(v, p - 1) || substring(v, p + 1)) AS v", "p")
        )
    return rows.selectExpr(c, "xxhash64(v) AS rest")


def _heavy_segments(index: DataFrame, probe: DataFrame, rules: Rules) -> DataFrame:
    """Segments that need care: ``(seg, na, nb, dense, giant)``, written once.

    A segment is dense when joining on it costs more candidates per name than the deletion neighbourhoods
    would, about ``length ** threshold / threshold!`` each.  It is a giant when one side of it alone would
    fill a task.
    """
    a_counts = index.groupBy("seg").agg(F.count("*").alias("na"), F.max(F.length("a")).alias("len"))
    b_counts = probe.groupBy("seg").agg(F.count("*").alias("nb"))
    counts = a_counts.join(b_counts, "seg", "full").na.fill(0, ["na", "nb", "len"])
    na, nb = F.col("na"), F.col("nb")
    neighbours = F.pow("len", F.lit(rules.threshold)) / math.factorial(rules.threshold) * rules.neighbour_cost
    heavy = counts.select(
        "seg", "na", "nb", (na * nb > neighbours * (na + nb)).alias("dense"),
        ((na > rules.hot_bucket) | (nb > rules.hot_bucket)).alias("giant"),
    )
    return stage(heavy.where("dense OR giant"), "heavy_segments")


class _Segments:
    """Takes segment keys apart; giants are taken out map-side, before anything is shuffled on them."""

    def __init__(self, heavy: DataFrame):
        found = heavy.groupBy("dense", "giant").agg(F.count("*").alias("n")).collect()  # four rows at most
        self.dense = any(r.dense for r in found)
        giants, rest = (sum(r.n for r in found if r.giant == g) for g in (True, False))

        def segs(condition: str, size: int) -> DataFrame:
            chosen = heavy.where(condition).select("seg")
            return F.broadcast(chosen) if size <= BROADCAST_SEGMENTS else chosen

        self.dense_giants = segs("giant AND dense", giants)
        self.idle_giants = segs("giant AND (dense OR na = 0 OR nb = 0)", giants)
        self.dense_rest = segs("dense AND NOT giant", rest)

    def joinable(self, keys: DataFrame) -> DataFrame:
        """Keys to join on: not the dense ones, nor giants without a partner."""
        return keys.join(self.idle_giants, "seg", "left_anti").join(self.dense_rest, "seg", "left_anti")

    def dense_only(self, keys: DataFrame) -> DataFrame:
        modest = keys.join(self.dense_giants, "seg", "left_anti").join(self.dense_rest, "seg", "left_semi")
        return keys.join(self.dense_giants, "seg", "left_semi").unionByName(modest)


def _neighbours(keys: DataFrame, c: str, threshold: int) -> DataFrame:
    names = stage(keys.select(c).distinct(), "dense_names")
    # Each name grows to hundreds of rows, so the size of the files is no guide to the work.
    default = int(names.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slices = max(default, names.count() // NAMES_PER_TASK)
    return _deletions(names.repartition(slices, c), c, threshold)


def name_pairs(left: Side, right: Side, rules: Rules = Rules()) -> DataFrame:
    """Distinct lower-case name pairs ``(a, b, distance)`` within the threshold, without a cross join.

    Two names within the threshold share an intact segment, so names are joined on segment keys and
    verified.  A segment that many names of both sides share would give all pairs within it.  Such a
    segment is not joined on; the names that have it are joined on their deletion neighbourhoods
    instead, where two names meet only if they are within ``2 * threshold`` edits of each other.
    A pair is found either way, so the result is whole.
    """
    _check(rules)
    a_names, b_names = _names(left, "a", rules.min_length), _names(right, "b", rules.min_length)
    index = _segment_keys(a_names, "a", rules.threshold, probing=False)
    return _close(index, _segment_keys(b_names, "b", rules.threshold, probing=True), rules)


def _check(rules: Rules) -> None:
    if rules.min_length <= 2 * rules.threshold:
        raise ValueError("min_length must exceed twice the threshold, or segments could be empty")


def _close(index: DataFrame, probe: DataFrame, rules: Rules) -> DataFrame:
    """Distinct pairs ``(a, b, distance)`` of the names behind the segment keys ``(a, seg)`` and ``(b, seg)``."""
    threshold = rules.threshold
    heavy = _heavy_segments(index, probe, rules)
    segments = _Segments(heavy)

    # giants that are not dense have few partners on the other side: slice them
    giants = heavy.where("giant AND NOT dense AND na > 0 AND nb > 0").select(
        F.col("seg").alias("__k"), F.col("na").alias("__nl"), F.col("nb").alias("__nr"))
    # Keys are many times the names that they are cut from, so files of names that look small enough to broadcast would
    # bring all keys to the driver; both joins are sorted on either side instead.
    by_segment = salted_join(
        segments.joinable(index).hint("merge"), segments.joinable(probe).withColumnRenamed("seg", "probe_seg"), "seg", "probe_seg",
        "inner", rules.hot_bucket,
        hot=giants,
    )
    candidates = by_segment.select("a", "b")
    if segments.dense:
        a_near = _neighbours(segments.dense_only(index), "a", threshold)
        b_near = _neighbours(segments.dense_only(probe), "b", threshold)
        candidates = candidates.unionByName(a_near.hint("merge").join(b_near, "rest").select("a", "b"))
    pairs = candidates.where(F.levenshtein("a", "b", threshold) >= 0).distinct()
    return pairs.withColumn("distance", F.levenshtein("a", "b", threshold))


class NameIndex:
    """Close names of two sources, kept from run to run under ``root``.

    Stored are the distinct names of either side, cut to segments, and the pairs found.  A run cuts and probes only
    names that no run has met: those of one side look up the other side's stored segments, and of these only the
    ones that they share are joined.  ``pairs`` gives what one run over all names would.  Names are never taken
    out; rows whose name is gone find nobody when pairs are joined back to them.  One run at a time may add, and a run
    counts once its pairs are written, so an interrupted one is done again.
    """

    def __init__(self, spark: SparkSession, root: str, rules: Rules = Rules()):
        _check(rules)
        self.spark, self.root, self.rules = spark, root, rules

    def _runs(self) -> list[int]:
        """Runs that have ended: those with pairs."""
        done = (n for n in children(self.spark, f"{self.root}/pairs") if n.isdigit() and exists(self.spark, f"{self.root}/pairs/{n}/_SUCCESS"))
        return sorted(map(int, done))

    def _stored(self, kind: str, schema: str) -> DataFrame:
        paths = [f"{self.root}/{kind}/{n}" for n in self._runs()]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def pairs(self) -> DataFrame:
        """``(a, b, distance)`` of all names so far, as ``name_pairs`` gives them."""
        return self._stored("pairs", "a string, b string, distance int")

    def add(self, left: Side, right: Side) -> tuple[int, int]:
        """Take in the names of both sides; how many of each were new."""
        run = max(self._runs(), default=-1) + 1
        known = {c: self._stored(c, f"{c} string, seg bigint") for c in "ab"}
        counts = []
        for side, c in ((left, "a"), (right, "b")):
            names = _names(side, c, self.rules.min_length).where(F.col(c).isNotNull())
            new = _segment_keys(names.join(known[c].select(c).distinct(), c, "left_anti"), c, self.rules.threshold, probing=False)
            new.write.mode("overwrite").parquet(f"{self.root}/{c}/{run}")
            counts.append(self._new(c, run).select(c).distinct().count())
        # new names of the left against all of the right, then new ones of the right against the old of the left
        found = self._met("a", run, known["b"].unionByName(self._new("b", run))) if counts[0] else None
        if counts[1]:
            others = self._met("b", run, known["a"])
            found = others if found is None else found.unionByName(others)
        if found is None:
            found = self.spark.createDataFrame([], "a string, b string, distance int")
        found.write.mode("overwrite").parquet(f"{self.root}/pairs/{run}")
        return counts[0], counts[1]

    def _new(self, c: str, run: int) -> DataFrame:
        return self.spark.read.schema(f"{c} string, seg bigint").parquet(f"{self.root}/{c}/{run}")

    def _met(self, c: str, run: int, other: DataFrame) -> DataFrame:
        """Pairs of the run's new names of one side with the stored names of the other."""
        o = "b" if c == "a" else "a"
        names = self._new(c, run).select(F.col(c).alias("b")).distinct()
        probe = stage(_segment_keys(names, "b", self.rules.threshold, probing=True), "probe")
        index = stage(other.join(probe.select("seg").distinct(), "seg", "left_semi").select(F.col(o).alias("a"), "seg"), "met_segments")
        return _close(index, probe, self.rules).select(F.col("b").alias(c), F.col("a").alias(o), "distance").select("a", "b", "distance")


def _expand(left: Side, right: Side, pairs: DataFrame, min_length: int) -> DataFrame:
    """Rows of both sides for every name pair, duplicates of a name included."""
    lhs = left.rows.where(_long_enough(left.name, min_length))
    rhs = right.rows.where(_long_enough(right.name, min_length))
    joined = lhs.join(pairs, F.lower(lhs[left.name]) == pairs["a"], "inner")
    joined = joined.join(rhs, pairs["b"] == F.lower(rhs[right.name]), "inner")
    return joined.drop("a", "b").withColumnRenamed("distance", "levenshtein_distance")


def fuzzy_match(left: Side, right: Side, rules: Rules = Rules()) -> DataFrame:
    """Row pairs within the threshold on lower-cased names, with ``levenshtein_distance``.

    Every pair is kept, also several per row.  The distinct names are written once, since the search
    reads them several times and the rows behind them may be dear.
    """
    def names(side: Side) -> Side:
        return side.with_rows(stage(side.rows.select(side.name).distinct(), "names"))

    return _expand(left, right, name_pairs(names(left), names(right), rules), rules.min_length)


class _Cascade(NamedTuple):
    """What the cascade knows of names and ids; all of it written and narrow, whatever the rows are."""

    links: DataFrame   # lower-case name pairs (a, b, match_quality): 0 or the distance
    left: DataFrame    # ids matched on the left (__id, exact): by an equal name, or by a close one only
    right: DataFrame


def _cascade(left: Side, right: Side, rules: Rules, index: NameIndex | None = None) -> _Cascade:
    """Each source is read once, for its ids and names."""
    def narrow(side: Side) -> DataFrame:
        return stage(side.rows.select(F.col(side.id).alias("__id"), F.col(side.name).alias("__name")), "names")

    def names(rows: DataFrame) -> DataFrame:
        return rows.select(F.lower("__name").alias("name")).where("name is not null").distinct()

    def ids(rows: DataFrame, found: DataFrame) -> DataFrame:
        return rows.join(found, F.lower("__name") == F.col("name"), "left_semi").where("__id is not null").select("__id").distinct()

    a, b = narrow(left), narrow(right)
    exact = stage(names(a).join(names(b), "name", "left_semi"), "exact_names")
    exact_a, exact_b = stage(ids(a, exact), "exact_ids"), stage(ids(b, exact), "exact_ids")
    # a NULL id never counts as matched
    rest_a, rest_b = stage(a.join(exact_a, "__id", "left_anti"), "rest"), stage(b.join(exact_b, "__id", "left_anti"), "rest")
    if index is None:
        pairs = name_pairs(Side(rest_a, "__id", "__name"), Side(rest_b, "__id", "__name"), rules)
    else:  # of all names; those of the rest are what is asked for
        index.add(Side(a, "__id", "__name"), Side(b, "__id", "__name"))
        pairs = index.pairs().join(names(rest_a).withColumnRenamed("name", "a"), "a", "left_semi").join(names(rest_b).withColumnRenamed("name", "b"), "b", "left_semi").select("a", "b", "distance")
    pairs = stage(pairs, "name_pairs")

    def matched(exact_ids: DataFrame, rest: DataFrame, c: str) -> DataFrame:
        guarded = rest.where(_long_enough("__name", rules.min_length))
        close = ids(guarded, pairs.select(F.col(c).alias("name")).distinct())
        return stage(exact_ids.withColumn("exact", F.lit(True)).unionByName(close.withColumn("exact", F.lit(False))), "matched_ids")

    links = exact.select(F.col("name").alias("a"), F.col("name").alias("b"), F.lit(0).alias("match_quality")).unionByName(
        pairs.select("a", "b", F.col("distance").alias("match_quality")))
    return _Cascade(stage(links, "links"), matched(exact_a, rest_a, "a"), matched(exact_b, rest_b, "b"))


def remaining(left: Side, right: Side, rules: Rules = Rules()) -> tuple[DataFrame, DataFrame]:
    """The rows of each side whose id has neither an exact nor a close match.  Runs jobs on ids and names;
    no row pairs are built."""
    known = _cascade(left, right, rules)
    return without_ids(left, known.left), without_ids(right, known.right)


def match_cascade(left: Side, right: Side, rules: Rules = Rules(), index: NameIndex | None = None) -> DataFrame:
    """Exact pairs, then close pairs of the rest, then the unmatched rows of each side.

    With ``index``, kept from run to run, close names are looked up there, and only names that it has not met are
    compared; its own rules hold.

    ``match_quality`` is 0, the distance, or NULL.  Ids and names decide everything beforehand and are written;
    then each side's rows are read once for the pairs of both kinds, and once for those left over.  Runs
    jobs.
    """
    rules = rules if index is None else index.rules
    known = _cascade(left, right, rules, index)
    none = F.lit(None).cast("int")

    def linked(side: Side, ids: DataFrame, c: str) -> tuple[DataFrame, Column]:
        """Rows with the name to link by, and whether a close link is open to them."""
        state = ids.select(F.col("__id").alias(f"__{c}_id"), F.col("exact").alias(f"__{c}_exact"))
        rows = side.rows.withColumn(f"__{c}", F.lower(side.name)).join(state, F.col(side.id) == F.col(f"__{c}_id"), "left")
        return rows, _long_enough(side.name, rules.min_length) & ~F.coalesce(f"__{c}_exact", F.lit(False))

    (lhs, left_open), (rhs, right_open) = linked(left, known.left, "a"), linked(right, known.right, "b")
    lhs, rhs = lhs.withColumn("__a_open", left_open), rhs.withColumn("__b_open", right_open)
    is_exact = F.col("match_quality") == 0
    pairs = lhs.join(known.links, (F.col("__a") == F.col("a")) & (is_exact | F.col("__a_open")))
    pairs = pairs.join(rhs, (F.col("b") == F.col("__b")) & (is_exact | F.col("__b_open")))
    pairs = pairs.drop("a", "b", *[f"__{c}{x}" for c in "ab" for x in ("", "_id", "_exact", "_open")])
    pairs = pairs.withColumn("levenshtein_distance", F.when(~is_exact, F.col("match_quality")))
    return (
        pairs.unionByName(without_ids(left, known.left).withColumn("match_quality", none), allowMissingColumns=True)
        .unionByName(without_ids(right, known.right).withColumn("match_quality", none), allowMissingColumns=True)
    )
