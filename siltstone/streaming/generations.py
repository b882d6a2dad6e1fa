"""Folders of full-refresh generations."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import SparkSession

from siltstone.sources.files import children, exists, touch


class Generations:
    """A stream target under ``root/<generation>``.

    An incremental run continues the newest generation.  A full refresh starts a new one, checkpoint
    included, and so reads all input again; it never touches the rows of the generation before it.  A
    generation counts for readers once a run of it has ended well, which leaves a marker.  Until then they
    get the one before; the next run, of either kind, goes on with the unfinished one.
    """

    DONE = "_COMPLETE"

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def folder(self, generation: int) -> str:
        return f"{self.root}/{generation:06d}"

    def _known(self) -> list[int]:
        return sorted(int(n) for n in children(self.spark, self.root) if n.isdigit())

    def _whole(self, generation: int) -> bool:
        return exists(self.spark, f"{self.folder(generation)}/{self.DONE}")

    def next_generation(self, full_refresh: bool) -> int:
        newest = max(self._known(), default=0)
        return newest + 1 if newest == 0 or full_refresh and self._whole(newest) else newest

    def finish(self, generation: int) -> None:
        """Let readers see the generation."""
        touch(self.spark, f"{self.folder(generation)}/{self.DONE}")

    def newest(self, readable: Callable[[str], bool]) -> str:
        """The newest whole generation that has something to read."""
        for generation in reversed(self._known()):
            if self._whole(generation) and readable(self.folder(generation)):
                return self.folder(generation)
        raise FileNotFoundError(f"nothing to read under {self.root}")
