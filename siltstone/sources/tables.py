"""Batch sources and the materialised sink."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession

from siltstone.sources.files import children, delete, exists


def _versions(spark: SparkSession, target: str) -> list[int]:
    """Versions that ``materialize`` has written whole, oldest first."""
    return sorted(int(n) for n in children(spark, target) if n.isdigit() and exists(spark, f"{target}/{n}/_SUCCESS"))


def read_table(spark: SparkSession, name: str, fmt: str = "parquet") -> DataFrame:
    """A catalog table, or files where the name is a path; of what ``materialize`` has written there, the newest."""
    if "/" not in name:
        return spark.read.table(name)
    versions = [] if "*" in name else _versions(spark, name.rstrip("/"))
    return spark.read.format(fmt).load(f"{name.rstrip('/')}/{versions[-1]:06d}" if versions else name)


def read_relational(spark: SparkSession, url: str, table: str, properties: Mapping[str, str] | None = None,
                    split_on: str | None = None, lower: int | None = None, upper: int | None = None,
                    partitions: int | None = None) -> DataFrame:
    """A table of another database.

    With ``split_on`` and its bounds the read runs as ``partitions`` range queries; rows outside the
    bounds fall into the first or last.  Filters and column selection reach the database.
    """
    return relational_reader(spark, url, table, properties, split_on, lower, upper, partitions).load()


def relational_reader(spark, url, table, properties=None, split_on=None, lower=None, upper=None, partitions=None):
    options = {"url": url, "dbtable": table, "pushDownPredicate": "true", **(properties or {})}
    split = {"partitionColumn": split_on, "lowerBound": lower, "upperBound": upper, "numPartitions": partitions}
    given = [k for k, v in split.items() if v is not None]
    if given and len(given) < len(split):
        raise ValueError(f"a split read needs all of {sorted(split)}, got {sorted(given)}")
    return spark.read.format("jdbc").options(**options, **{k: str(split[k]) for k in given})


def _published(spark: SparkSession, name: str, target: str) -> set[int]:
    """The version under ``target`` that a catalog table reads, if it is there and reads one."""
    if not spark.catalog.tableExists(name):
        return set()
    told = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    folder, _, version = told.get("Location", "").rstrip("/").rpartition("/")
    return {int(version)} if version.isdigit() and folder.split(":")[-1].lstrip("/") == target.split(":")[-1].lstrip("/") else set()


def _publish(df: DataFrame, name: str, folder: str, partitioned: bool) -> None:
    """Let the catalog table read a folder.  Where its columns stay as they are this is one change in the catalog;
    otherwise, and for a partitioned table, whose partitions the catalog lists, the table is declared anew."""
    spark = df.sparkSession
    if spark.catalog.tableExists(name):
        columns = [(f.name, f.dataType) for f in spark.read.table(name).schema]
        if not partitioned and columns == [(f.name, f.dataType) for f in df.schema]:
            quoted = folder.replace("\\", "\\\\").replace("'", "\\'")
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{quoted}'")
            return
        spark.sql(f"DROP TABLE {name}")
    spark.catalog.createTable(name, folder, "parquet")  # columns and partitions as written
    if partitioned:
        spark.catalog.recoverPartitions(name)


def materialize(df: DataFrame, target: str, name: str | None = None, quality: str | None = None,
                description: str | None = None, partition_by: tuple[str, ...] = (),
                cluster_by: tuple[str, ...] = (), order_by: Sequence[str | Column] = ()) -> DataFrame:
    """Write the frame as the next version under ``target`` and read it back.

    A version is a folder of its own, ``target/<number>``, and counts once it is written whole, so a reader finds
    the old rows or the new ones, never none: with ``name`` a catalog table is moved there, and ``read_table``
    finds the newest by path.  Nothing is renamed.  The version before stays for its readers; older ones are
    deleted.  A failed write leaves the old version.

    With ``name``, ``quality`` and ``description`` become table properties.  ``cluster_by`` sorts within files.
    ``order_by`` deals the rows in ranges first, so files do not overlap and, read in their order, are the
    whole in order; a filter on the first columns then skips files and row groups by their statistics.
    Column comments travel in the file schema.  One writer at a time may write to a target.
    """
    spark = df.sparkSession
    target = target.rstrip("/")
    if order_by:
        df = df.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    elif cluster_by:
        df = df.sortWithinPartitions(*cluster_by)
    before = _versions(spark, target)
    folder = f"{target}/{(before[-1] if before else 0) + 1:06d}"
    writer = df.write.format("parquet").mode("overwrite")  # of what a failed write has left there
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(folder)
    kept = set(before[-1:])
    if name is not None:
        kept |= _published(spark, name, target)
        _publish(df, name, folder, bool(partition_by))
    for version in before:
        if version not in kept:
            delete(spark, f"{target}/{version:06d}")
    if name is None:
        return spark.read.schema(df.schema).parquet(folder)
    given = {"quality": quality, "description": description}
    properties = ", ".join(
        "'{}' = '{}'".format(k, v.replace("\\", "\\\\").replace("'", "\\'")) for k, v in given.items() if v is not None
    )
    if properties:
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({properties})")
    return spark.read.table(name)
