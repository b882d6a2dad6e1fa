"""Curated commercial tables: locations, equipment, opportunities, sites, opportunity teams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from siltstone.functions.columns import hashed_id, joined_text, sentinel_to_null, surrogate_key, survivorship
from siltstone.operators.bridge import address_bridge, address_table
from siltstone.operators.hierarchy import Hierarchy, hierarchy_rollup, resolved_owner
from siltstone.operators.joins import HOT_ROWS, dimension_join, salted_join
from siltstone.operators.project import project, to_contract
from siltstone.plans import contracts

# Fixed values of the source systems and of the lineage tags.
GENERATOR_LEVEL = "780-GenSets"
LOCATION_LEVEL = "120-Cust Location"
SERVICE_DIVISION = "700"
PROJECT_DIVISIONS = ("300", "600", "605")
INTERNAL_PARENTS = ("110", "200", "300", "600", "605", "700")
SCRAPPED = "Scrapped"
PS_GENERATORS, ERG_GENERATORS, PC_GENERATORS = "PS_Generators", "ERG_Generators", "PC_Generators"
PS_SITES, OPCO_SITES, PRE_IFS_SITES = "PS_Sites", "OPCO_Sites", "Pre_IFS_Sites"

EQUIPMENT_TREE = Hierarchy("mch_code", "sup_mch_code", "obj_level", "mch_name", LOCATION_LEVEL)

# Source columns and their names here.

# child column -> equipment column; also the grouping of the roll-up
GENERATOR_COLUMNS = """
mch_code -> ifs_object_id
_obj_id -> dw_equipment_id
contract -> division
obj_level -> object_level
sup_mch_code -> parent_object
cf_obj_class -> classification
cf_owner -> object_owner
cf_ownership -> ownership
location_id
cf_project_no -> project_id
operational_status -> equipment_status
identifier
"""

SITE_COLUMNS = """
mch_code -> ifs_site_id
_obj_id -> ifs_obj_id
mch_name -> site_name
contract -> division
obj_level -> object_level
sup_mch_code -> ifs_customer_no
location_id
address1 -> street
city
zip_code -> zip
state
country_code -> country
clean_address
identifier
"""

OPPORTUNITY_COLUMNS = """
opp_full_id__c -> dw_opportunity_id
ifs_opp_no__c -> opportunity_no
name -> opportunity_name
owner_id -> primary_sales_rep
account_id
record_type_id
amount
close_date
margin__c
rank__c -> rank
stage_name -> stage
desired_installation_date__c -> desired_installation_date
is_won -> closed_won
is_closed -> closed
company__c -> company
site__c -> division_id
project_type__c -> project_type
type_of_sale__c -> type_of_sale
created_date
last_modified_date
last_stage_change_date
"""


def erp_locations(location_party_address_pub: DataFrame) -> DataFrame:
    """Addresses with the ``NULL`` state text cleared and their parts joined to ``clean_address``."""
    return location_party_address_pub.withColumn("state", sentinel_to_null("state")).withColumn(
        "clean_address", joined_text("address1", "city", "state", "zip_code", "country_code")
    )


def control_sites(site: DataFrame, state: DataFrame) -> DataFrame:
    sites = dimension_join(site.withColumnRenamed("site_state_id", "state_id"), state, "state_id")
    return sites.withColumn(
        "clean_address", joined_text("site_address1", "site_city", "state_abbreviation", "site_zip")
    )


def location(sites: DataFrame, locations: DataFrame) -> DataFrame:
    """One row per distinct address of both sources with its standard form."""
    return address_table("clean_address", sites, locations)


def _generator_tag() -> Column:
    kind, project_no = F.col("cf_obj_class"), F.col("cf_project_no")
    erg = (kind == "ERG") | (kind.isNull() & project_no.isNull())
    return (
        F.when((kind == "PS") | (kind.isNull() & project_no.isNotNull()), PS_GENERATORS)
        .when(erg & (F.col("operational_status") != SCRAPPED), ERG_GENERATORS)
    )


def erp_generators(equipment_functional_cfv: DataFrame) -> DataFrame:
    """Generators of both kinds with power and engine count, parent and customer location.

    The two kinds exclude each other, so one tagged pass joins and aggregates both.
    """
    rows = equipment_functional_cfv
    chosen = rows.where((F.col("contract") == SERVICE_DIVISION) & (F.col("obj_level") == GENERATOR_LEVEL))
    chosen = chosen.withColumn("identifier", _generator_tag()).where("identifier IS NOT NULL")
    keys = [line.split()[0] for line in GENERATOR_COLUMNS.strip().splitlines()]
    rolled = hierarchy_rollup(
        chosen, rows, EQUIPMENT_TREE, keys, "cf_kw", "mch_code", "total_power", "no_of_engines"
    )
    code, name = resolved_owner(EQUIPMENT_TREE)
    measures = """
    parent_name -> description
    total_power
    no_of_engines
    customer_location
    customer_location_name
    """
    return project(
        rolled.withColumns({"customer_location": code, "customer_location_name": name}), GENERATOR_COLUMNS + measures
    )


def control_generators(generator: DataFrame) -> DataFrame:
    return generator.select(
        F.col("site_id").alias("pc_site_id"),
        hashed_id("generator_id").alias("dw_equipment_id"),
        F.col("generator_size").try_cast("double").alias("total_power"),
        F.lit(GENERATOR_LEVEL).alias("object_level"),
        F.lit("PC").alias("classification"),
        F.lit(PC_GENERATORS).alias("identifier"),
    )


def equipment(erp: DataFrame, control: DataFrame) -> DataFrame:
    return to_contract(erp.unionByName(control, allowMissingColumns=True), contracts.EQUIPMENT)


def opportunity(raw: DataFrame) -> DataFrame:
    """CRM opportunities; the margin percentage becomes a fraction, ``decimal(5,2)`` to ``decimal(9,6)``."""
    renamed = project(raw, OPPORTUNITY_COLUMNS)
    fraction = renamed.withColumn("margin_percentage", F.col("margin__c") / 100).drop("margin__c")
    return to_contract(fraction, contracts.OPPORTUNITY)


def _site_tag() -> Column:
    division, kind, project_no = F.col("contract"), F.col("cf_obj_class"), F.col("cf_project_no")
    service = division == SERVICE_DIVISION
    return (
        F.when(service & (kind == "ERG") & (F.col("operational_status") != SCRAPPED), PS_SITES)
        .when(division.isin(*PROJECT_DIVISIONS) & ~F.col("sup_mch_code").isin(*INTERNAL_PARENTS), OPCO_SITES)
        .when(service & ((kind == "PS") | kind.isNull()) & ~project_no.like("1%"), PRE_IFS_SITES)
    )


def erp_sites(equipment_functional_cfv: DataFrame, locations: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Sites of the three kinds with their addresses.

    The kinds exclude each other by division and class, so one pass tags them.  Project sites take any address
    of their location, in an inner join, whose hot partitions are split on either side.  The others take only
    its primary physical one, and those of the third kind are kept without an address; a location with very
    many addresses is split by the salted join.  Runs jobs that read the location ids.
    """
    sites = equipment_functional_cfv.where(F.col("obj_level") == LOCATION_LEVEL)
    sites = sites.withColumn("identifier", _site_tag()).where("identifier IS NOT NULL")
    addresses = locations.select(
        F.col("location_id").alias("__location"), "address1", "city", "state", "zip_code", "country_code", "clean_address",
        ((F.col("location_specific_address") == "TRUE") & (F.col("primary_address") == "TRUE")).alias("__primary"),
    )
    project_sites = sites.where(F.col("identifier") == OPCO_SITES)
    located = project_sites.join(addresses, project_sites["location_id"] == addresses["__location"])
    primary = salted_join(
        sites.where(F.col("identifier") != OPCO_SITES), addresses.where("__primary"), "location_id", "__location", "left", hot_rows)
    primary = primary.where(F.col("__location").isNotNull() | (F.col("identifier") == PRE_IFS_SITES))
    return project(located.unionByName(primary), SITE_COLUMNS)


def site(erp: DataFrame, control: DataFrame, bridge: DataFrame | None = None, keep_unlocated: bool = False,
         match_blank: bool = False, hot_rows: int = HOT_ROWS) -> DataFrame:
    """ERP and control-system sites matched on their standard addresses, ERP values first.

    Sites with a blank address match none, unless ``match_blank``; see ``address_bridge``.

    A site without an address record has no key to match on and is left out, unless ``keep_unlocated``.
    ``bridge`` is a stored ``location`` table; without it the standard form is computed in place.
    """
    other = control.withColumnsRenamed(
        {"customer_id": "pc_customer_id", "site_id": "pc_site_id", "site_name": "pc_site_name"}
    )
    joined = address_bridge(erp, other, "clean_address", bridge, match_blank, hot_rows)
    if keep_unlocated:
        joined = joined.unionByName(erp.where("clean_address IS NULL").drop("clean_address"), allowMissingColumns=True)
    merged = survivorship(joined, {
        "site_name": ["site_name", "pc_site_name"],
        "street": ["street", "site_address1"],
        "city": ["city", "site_city"],
        "zip": ["zip", "site_zip"],
        "project_id": ["ifs_project_code", "project_code"],
    })
    keyed = merged.withColumn("dw_site_id", surrogate_key("ifs_obj_id", hashed="pc_site_id"))
    return to_contract(keyed, contracts.SITE)


def opportunity_team_member(team: DataFrame, user: DataFrame, opportunities: DataFrame, employees: DataFrame) -> DataFrame:
    """Team rows with member and opportunity names.  ``team`` and ``user`` are the landed CRM tables."""
    users = user.select(F.col("Id").alias("__user"), F.col("IFS_PERSON_ID__c").alias("person_id"))
    named = employees.select(F.col("person_id").alias("__person"), F.col("full_name").alias("team_member_name"))
    deals = opportunities.select("dw_opportunity_id", "opportunity_no", "opportunity_name")
    members = team.select(
        F.col("Id").alias("opportunity_team_member_id"), F.col("UserId").alias("__member"),
        F.col("TeamMemberRole").alias("opportunity_role"), F.col("OpportunityID").alias("opportunity_id"),
        F.col("CreatedDate").alias("created_date"),
    )
    joined = (
        members.join(users, F.col("__member") == F.col("__user"))
        .join(named, F.col("person_id") == F.col("__person"))
        .join(deals, F.col("opportunity_id") == F.col("dw_opportunity_id"))
    )
    return joined.select(
        "opportunity_team_member_id", "person_id", "team_member_name", "opportunity_role", "opportunity_id",
        "opportunity_no", "opportunity_name", "created_date",
    )
