"""What the plans must look like for the queries to hold at scale."""

import re

import pytest

import __spark_entry__ as entry_points
from compare import plan_text, staged_plans

SF_DIR = "/root/testdata/sf0.001"


def plan_of(spark, name):
    return plan_text(entry_points.queries()[name](spark, SF_DIR))


def scans(plan):
    return len(re.findall(r"(?m)^\W*(?:\+- |:- )?.*\bFileScan parquet", plan))


def test_filters_and_columns_reach_the_scan(spark):
    plan = plan_of(spark, "predicate_mix")
    assert re.search(r"PushedFilters: \[[^\]]*LessThanOrEqual\(l_discount,0.05\)", plan)
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert sorted(len(s.split(",")) for s in schemas) == [5, 5]


def test_projection_reads_its_columns_only(spark):
    assert re.findall(r"ReadSchema: struct<([^>]*)>", plan_of(spark, "scan_project")) == ["l_orderkey:bigint,l_linenumber:int,l_returnflag:string"]


@pytest.mark.parametrize("name", ["scd1_batch", "union_distinct", "hierarchy_rollup"])
def test_aggregates_combine_before_the_shuffle(spark, name):
    plan = plan_of(spark, name)
    assert "Window" not in plan
    assert len(re.findall(r"(Hash|Sort)Aggregate", plan)) >= 2


@pytest.mark.parametrize("name, shuffles", [("scd1_batch", 1), ("union_distinct", 1), ("ordered_output", 1), ("scan_project", 0), ("decimal_ratio", 0), ("raw_crm_opportunity", 0)])
def test_number_of_shuffles(spark, name, shuffles):
    assert len(re.findall(r"\bExchange ", plan_of(spark, name))) == shuffles


@pytest.mark.parametrize("name", ["address_standardize", "scd1_batch", "hierarchy_rollup", "parse_bool", "curated_equipment", "curated_location"])
def test_no_python_in_the_plan(spark, name):
    assert "EvalPython" not in plan_of(spark, name)


def test_cascade_reads_its_sources_once_for_pairs_and_once_for_the_rest(spark):
    with staged_plans() as plans:
        last = plan_of(spark, "match_cascade")
    assert scans(last) <= 9  # two of each source, the links, two of each side's ids
    sources = [len(re.findall(r"FileScan parquet[^\n]*(?:customer|supplier)\.parquet", p)) for p in plans]
    assert sum(sources) == 2  # ids and names of either side, once


@pytest.mark.parametrize("name", ["address_bridge", "curated_site"])
def test_rows_grow_with_the_tables(spark, name):
    """Tenfold tables give about tenfold rows: blank addresses make no pairs, and addresses grow with their keys."""
    query = entry_points.queries()[name]
    small, large = (query(spark, f"/root/testdata/{sf}").count() for sf in ("sf0.01", "sf0.1"))
    assert 8 < large / small < 12


def test_a_tenth_of_the_sites_match(spark):
    sites = entry_points.queries()["curated_site"](spark, "/root/testdata/sf0.01")
    matched = sites.where("ifs_site_id is not null and pc_site_id is not null and mapped_address <> ''")
    assert matched.select("pc_site_id").distinct().count() >= 0.1 * sites.where("pc_site_id is not null").select("pc_site_id").distinct().count()
