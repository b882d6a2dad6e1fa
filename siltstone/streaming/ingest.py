"""Incremental ingest of landing files into append tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from siltstone.operators.project import FILE, MALFORMED
from siltstone.sources.files import children, exists, rename, touch
from siltstone.streaming.generations import Generations

REJECTED = "_rejected"  # partition column of a landing table that keeps malformed rows
KEEPS = "_KEEPS_MALFORMED"  # marks a generation of such a table


def header_schema(spark: SparkSession, folder: str) -> StructType:
    """The columns named in the header of the files already there, all as text.  Reads one header line."""
    names = spark.read.option("header", True).csv(folder).columns
    return StructType([StructField(n, StringType()) for n in names])


def csv_stream(spark: SparkSession, folder: str, schema: StructType | str | None = None, max_files: int | None = None,
               keep_malformed: bool = False, archive: str | None = None) -> DataFrame:
    """A stream of the CSV files in a folder, each read once.

    Columns are text unless ``schema`` says otherwise; cast them with ``project``.  A file whose header
    does not agree with the schema fails the stream instead of landing values in the wrong columns.  So does a row
    with too many or too few fields, unless ``keep_malformed``: then each row comes with ``_malformed``, the text
    of a row that does not fit and NULL otherwise, and ``_file``, and a ``LandingTable`` keeps the two kinds apart.

    With ``archive``, a folder outside the landing folder, files that a later batch has left behind are moved
    there, under their own path.  So the landing folder has what is new and the last batch, and that is all a run
    lists.  ``restore_archived`` puts them back for a full refresh.
    """
    if schema is None:
        schema = header_schema(spark, folder)
    elif isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    reader = spark.readStream.format("csv").option("header", True).option("enforceSchema", False)
    if keep_malformed:
        schema = StructType([*schema.fields, StructField(MALFORMED, StringType())])
        reader = reader.option("columnNameOfCorruptRecord", MALFORMED)
    else:
        reader = reader.option("mode", "FAILFAST").option("columnPruning", False)  # all fields are counted
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if archive is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    stream = reader.schema(schema).load(folder)
    return stream.select("*", F.col("_metadata.file_path").alias(FILE)) if keep_malformed else stream


def restore_archived(spark: SparkSession, folder: str, archive: str) -> int:
    """Move a landing folder's archived files back, so that a full refresh reads them; how many there were.
    Interrupted, it goes on where it was when called again."""
    kept = f"{archive.rstrip('/')}/{folder.split('://')[-1].removeprefix('file:').strip('/')}"
    names = children(spark, kept)
    for name in names:
        rename(spark, f"{kept}/{name}", f"{folder}/{name}")
    return len(names)


class LandingTable(Generations):
    """An append table fed by a stream: rows in ``<generation>/data``, progress in ``<generation>/checkpoint``.

    A stream with the column ``_malformed`` (see ``csv_stream``) is written in two partitions by one query, so
    either kind of row is there exactly once: ``read`` gives the good rows as if the others had not been there,
    ``rejects`` the others, whole and with their file.
    """

    def run(self, stream: DataFrame, full_refresh: bool = False) -> LandingTable:
        """Read everything that is new and stop.  Without new files this writes nothing."""
        generation = self.next_generation(full_refresh)
        folder = self.folder(generation)
        keeps = MALFORMED in stream.columns
        if exists(self.spark, f"{folder}/data/_spark_metadata") and keeps != exists(self.spark, f"{folder}/{KEEPS}"):
            raise ValueError("a table keeps malformed rows from its first run on or not at all; use full_refresh")
        if keeps:
            touch(self.spark, f"{folder}/{KEEPS}")
            bad = F.col(MALFORMED).isNotNull()
            stream = stream.withColumns({FILE: F.when(bad, F.col(FILE)), REJECTED: bad.cast("int")})
        writer = (
            stream.writeStream.format("parquet").outputMode("append")
            .option("checkpointLocation", f"{folder}/checkpoint")
            .trigger(availableNow=True)
        )
        query = (writer.partitionBy(REJECTED) if keeps else writer).start(f"{folder}/data")
        query.awaitTermination()
        self.finish(generation)
        return self

    def _data(self) -> str:
        return self.newest(lambda folder: exists(self.spark, f"{folder}/data/_spark_metadata")) + "/data"

    @staticmethod
    def _good(df: DataFrame) -> DataFrame:
        return df.where(F.col(REJECTED) == 0).drop(MALFORMED, FILE, REJECTED) if REJECTED in df.columns else df

    def read(self) -> DataFrame:
        return self._good(self.spark.read.parquet(self._data()))

    def rejects(self) -> DataFrame:
        """``file`` and ``row``, the whole text, of every row that did not fit."""
        df = self.spark.read.parquet(self._data())
        if REJECTED not in df.columns:
            return self.spark.createDataFrame([], "file string, row string")
        return df.where(F.col(REJECTED) == 1).select(F.col(FILE).alias("file"), F.col(MALFORMED).alias("row"))

    def read_stream(self, max_files: int | None = None) -> DataFrame:
        """The table as a stream, for datasets built on it."""
        path = self._data()
        reader = self.spark.readStream.schema(self.spark.read.parquet(path).schema)
        if max_files is not None:
            reader = reader.option("maxFilesPerTrigger", max_files)
        return self._good(reader.parquet(path))
