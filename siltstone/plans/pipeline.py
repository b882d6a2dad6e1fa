"""From landed data to stored curated tables: ERP files, batch sources, curated tables.

Each step writes tables under a folder and returns them by name, so the steps chain by plain calls
and can run as separate jobs.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from siltstone.operators.bridge import AddressDictionary
from siltstone.plans import raw
from siltstone.plans.curated import Curated
from siltstone.sources.files import has_children
from siltstone.sources.tables import materialize
from siltstone.streaming.ingest import LandingTable, csv_stream, restore_archived
from siltstone.streaming.upsert import LatestTable


def load_erp(spark: SparkSession, landing: str, target: str, full_refresh: bool = False,
             max_files: int | None = None, archive: str | None = None) -> dict[str, DataFrame]:
    """Drain the CSV folders ``landing/<table>`` into append tables and bring the latest-record table up to date.

    Files have the declared columns in their order; one that has not fails the run.  Rows with too many or too
    few fields go to the ``LandingTable``'s rejects, whole.  Folders that never had files are skipped, and a run
    without new files changes nothing.  With ``archive`` drained files are moved there; see ``csv_stream``.  A full
    refresh moves them back first and reads them again.
    """
    tables = {}
    for landed, (name, _) in raw.ERP.items():
        folder, table = f"{landing}/{landed}", LandingTable(spark, f"{target}/{name}")
        if archive is not None and full_refresh:
            restore_archived(spark, folder, archive)
        if not has_children(spark, folder):
            continue
        stream = csv_stream(spark, folder, raw.declared_columns("erp", landed), max_files, keep_malformed=True, archive=archive)
        table.run(raw.raw_table("erp", landed, stream), full_refresh)
        tables[f"erp.{name}"] = table.read()
        if name == "company_person":
            latest = LatestTable(spark, f"{target}/company_person_last_change", ["_obj_id"], "_obj_version")
            latest.run(raw.company_person_changes(table.read_stream(max_files)), full_refresh)
            tables["erp.company_person_last_change"] = latest.read()
    return tables


def load_batch(system: str, landed: Mapping[str, DataFrame], target: str) -> dict[str, DataFrame]:
    """Write the raw tables of a batch source (``control`` or ``crm``)."""
    return {
        f"{system}.{raw.SYSTEMS[system][source][0]}": materialize(
            raw.raw_table(system, source, df), f"{target}/{raw.SYSTEMS[system][source][0]}"
        )
        for source, df in landed.items()
    }


def build_curated(tables: Mapping[str, DataFrame], target: str, names: Iterable[str] = Curated.TABLES,
                  database: str | None = None, addresses: str | None = None) -> Curated:
    """Write the curated tables; each is built from the stored form of those before it.  ``addresses`` is the folder
    of the dictionary of parsed addresses, if one is kept."""
    spark = SparkSession.active()
    curated = Curated(tables, None if addresses is None else AddressDictionary(spark, addresses))
    for name in names:
        curated.store(name, f"{target}/{name}", None if database is None else f"{database}.{name}")
    return curated
