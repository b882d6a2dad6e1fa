"""Latest record per key, kept up to date by a stream."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from siltstone.operators.cdc import scd1_batch
from siltstone.sources.files import children, delete, exists, touch
from siltstone.streaming.generations import Generations

BUCKETS = 64  # of a table; a bucket is rewritten whole, so it should stay within a few hundred megabytes
_BUCKET = "__bucket"
_LAID_OUT = "_BUCKETS_"


class LatestTable(Generations):
    """Type 1 history: one row per key, the highest sequence wins, late lower sequences change nothing.

    Every micro-batch appends the winning row of each key it has to ``<generation>/changes/<batch id>``; it
    reads nothing of the table and keeps no state.  A replayed batch overwrites its own folder.  At its end a run
    folds its changes into the table, which lies in buckets of a hash of the key: buckets with changes are
    written anew to ``<generation>/base/<last batch id>/__bucket=<b>``, others are not touched.  The newest version
    of each bucket is the table, so a read is a scan.  Folding gives the same rows in any order and split.

    A version is seen once all of it is written.  Nothing is overwritten: dynamic partition overwrite deletes
    a bucket before the new one is in its place, and a session that dies between the two loses rows
    which the stream does not bring again.  ``vacuum`` deletes what is superseded.
    """

    def __init__(self, spark, root: str, keys: Sequence[str], sequence: str | Column, buckets: int = BUCKETS):
        super().__init__(spark, root)
        self.keys, self.sequence, self.buckets = keys, sequence, buckets

    def _written(self, folder: str, kind: str) -> list[int]:
        path = f"{folder}/{kind}"
        done = (n for n in children(self.spark, path) if n.isdigit() and exists(self.spark, f"{path}/{n}/_SUCCESS"))
        return sorted(int(n) for n in done)

    def _versions(self, folder: str) -> dict[str, str]:
        """Where the newest version of each bucket lies."""
        return {
            name: f"{folder}/base/{n}/{name}"
            for n in self._written(folder, "base") for name in children(self.spark, f"{folder}/base/{n}") if name.startswith(_BUCKET)
        }

    def run(self, changes: DataFrame, full_refresh: bool = False) -> LatestTable:
        """Apply everything that is new in the stream and stop."""
        generation = self.next_generation(full_refresh)
        folder = self.folder(generation)
        laid_out = [n for n in children(self.spark, folder) if n.startswith(_LAID_OUT)]
        if (laid_out or exists(self.spark, f"{folder}/changes")) and laid_out != [f"{_LAID_OUT}{self.buckets}"]:
            raise ValueError(f"the table does not lie in {self.buckets} buckets; use full_refresh")
        touch(self.spark, f"{folder}/{_LAID_OUT}{self.buckets}")

        def append(batch: DataFrame, batch_id: int) -> None:
            winners = scd1_batch(batch, self.keys, self.sequence)
            winners.write.mode("overwrite").parquet(f"{folder}/changes/{batch_id}")

        query = (
            changes.writeStream.option("checkpointLocation", f"{folder}/checkpoint")
            .foreachBatch(append).trigger(availableNow=True).start()
        )
        query.awaitTermination()
        self._fold(folder)
        self.finish(generation)
        return self

    def _fold(self, folder: str) -> None:
        """Bring buckets up to date with the changes after the newest version."""
        done = self._written(folder, "base")[-1:]
        new = [n for n in self._written(folder, "changes") if not done or n > done[0]]
        if not new:
            return
        bucket = F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in self.keys]), F.lit(self.buckets)).cast("int")
        rows = reduce(DataFrame.unionByName, [self.spark.read.parquet(f"{folder}/changes/{n}") for n in new]).withColumn(_BUCKET, bucket)
        touched = [f"{_BUCKET}={r[_BUCKET]}" for r in rows.select(_BUCKET).distinct().collect()]  # as many as buckets
        versions = self._versions(folder)
        before = [versions[name] for name in touched if name in versions]
        if before:
            rows = rows.unionByName(self.spark.read.parquet(*before).withColumn(_BUCKET, bucket))
        # winners of batches already: a key has one row a batch, so buckets may be gathered before they are folded
        folded = scd1_batch(rows.repartition(_BUCKET), [_BUCKET, *self.keys], self.sequence)
        folded.write.mode("overwrite").partitionBy(_BUCKET).parquet(f"{folder}/base/{new[-1]}")

    def read(self) -> DataFrame:
        folder = self.newest(lambda folder: bool(self._written(folder, "changes") or self._written(folder, "base")))
        paths = self._versions(folder)
        if not paths:  # no change so far has a sequence
            return self.spark.read.parquet(f"{folder}/changes/{self._written(folder, 'changes')[0]}").limit(0)
        return self.spark.read.parquet(*[paths[name] for name in sorted(paths)])

    def vacuum(self) -> None:
        """Delete superseded buckets and the changes taken in.  Readers that began before lose their files."""
        for generation in self._known():
            folder = self.folder(generation)
            current = set(self._versions(folder).values())
            done = self._written(folder, "base")
            for n in done:
                for name in children(self.spark, f"{folder}/base/{n}"):
                    if name.startswith(_BUCKET) and f"{folder}/base/{n}/{name}" not in current:
                        delete(self.spark, f"{folder}/base/{n}/{name}")
            for n in self._written(folder, "changes"):
                if done and n <= done[-1]:
                    delete(self.spark, f"{folder}/changes/{n}")
