"""Rules of the curated tables on hand-built rows."""

import pytest

from siltstone.plans import commercial, party

ERP = "ifs_customer_name string, ifs_customer_id string, category string, ifs_created_date timestamp, ifs_obj_id string"
MATCHED = """sf_account_id string, sf_account_name string, pc_customer_id int, pc_customer_name string, ifs_customer_no string,
    parent_id string, person_id string, segment string, subsegment string, southern_opco boolean, created_date timestamp,
    last_modified_date timestamp, match_quality int"""


def matched_row(account=None, control=None, erp_no=None, quality=None):
    return (account, account and f"name {account}", control, control and f"control {control}", erp_no, *[None] * 7, quality)


@pytest.mark.parametrize("hot_rows", [1, 1_000_000])
def test_account_keeps_and_drops(spark, rows, hot_rows):
    matched = spark.createDataFrame([
        matched_row("A1", None, "E1"), matched_row("A2", 7, None, 0), matched_row(None, 8), matched_row("A3", None, "gone"),
    ], MATCHED)
    erp = spark.createDataFrame([
        ("e1", "E1", "Prospect", None, "O1"), ("e2", "E2", "Prospect", None, "O2"), ("e3", "E3", "Customer", None, "O3"),
        ("e4", "E4", None, None, "O4"), ("e5", None, "Prospect", None, "O5"),
    ], ERP)
    out = party.account(matched, erp, hot_rows).select("dw_account_id", "ifs_customer_id", "account_name", "pc_customer_id", "match_quality")
    assert rows(out) == sorted([
        ("A1", "E1", "name A1", None, None),        # matched, a prospect or not
        ("A2", None, "name A2", 7, 0),
        ("c9f0f895fb98ab9159f51fd0297e236d", None, "control 8", 8, None),
        ("A3", "gone", "name A3", None, None),
        ("O3", "E3", "e3", None, None),             # E2 is a prospect, E4 has no category: both go
        ("O5", "e5", "e5", None, None),             # no ERP number, so the rule does not apply
    ], key=repr)
    ordered = party.account(matched, erp).orderBy(*party.account_order()).select("match_quality").collect()
    assert ordered[0][0] == 0 and ordered[-1][0] is None


def test_customer_drops_unmatched_customers(spark, rows):
    columns = [line.split("->")[-1].strip() for line in party.CRM_ACCOUNTS.strip().splitlines()]
    types = {"southern_opco": "boolean", "latitude": "double", "longitude": "double", "created_date": "timestamp", "last_modified_date": "timestamp"}
    ddl = ", ".join(f"{c} {types.get(c, 'string')}" for c in columns)
    accounts = spark.createDataFrame([
        tuple({"sf_account_id": i, "parent_id": p, "ifs_customer_no": n}.get(c) for c in columns)
        for i, p, n in [("A1", "P", "E1"), ("A2", None, "E2"), ("A3", "P", None)]
    ], ddl)
    erp = spark.createDataFrame([
        ("e1", "E1", "Customer", None, "O1"), ("e2", "E2", "Customer", None, "O2"), ("e3", "E3", "Prospect", None, "O3"), ("e4", "E4", None, None, "O4"),
    ], ERP)
    out = party.customer(party.child_accounts(accounts), erp).select("dw_customer_id", "ifs_customer_no", "ifs_customer_name")
    assert rows(out) == [("A1", "E1", "e1"), ("A3", None, None), ("O3", None, "e3")]


def test_employee(spark, rows):
    users = spark.createDataFrame([
        ("u1", "1", "p1", "n", None, "r", True), ("u2", "2", "p2", "n", "u1", "r", False), ("u3", None, None, "n", "gone", "r", None),
    ], "user_id string, emp_no string, person_id string, full_name string, manager_id string, role_id string, active boolean")
    persons = spark.createDataFrame(
        [("e1", "p1", "Person 1", "org", "Active", "o", "1")],
        "employee_id string, person_id string, full_name string, org_code string, status string, _obj_id string, _obj_version string")
    out = party.employee(users, persons).select("dw_employee_id", "person_id", "manager_person_id", "full_name")
    assert rows(out) == [
        ("c4ca4238a0b923820dcc509a6f75849b", "p1", None, "Person 1"), ("c81e728d9d4c2f636f067f89cc14862c", "p2", "p1", None), (None, None, None, None),
    ]


CFV = "mch_code string, contract string, obj_level string, sup_mch_code string, cf_obj_class string, cf_project_no string, operational_status string, location_id string, mch_name string, _obj_id string, cf_owner string, cf_ownership string, cf_kw double"
LOCATIONS = "location_id string, address1 string, city string, state string, zip_code string, country_code string, location_specific_address string, primary_address string"


def location_row(code, contract, kind=None, project=None, status="Running", parent="C1", location="l1"):
    return (code, contract, "120-Cust Location", parent, kind, project, status, location, f"site {code}", f"o-{code}", None, None, None)


def test_site_kinds(spark, rows):
    sites = spark.createDataFrame([
        location_row("ps", "700", "ERG"), location_row("ps-scrapped", "700", "ERG", status="Scrapped"), location_row("ps-null", "700", "ERG", status=None),
        location_row("opco", "600", location="l2"), location_row("internal", "600", parent="605"), location_row("no parent", "300", parent=None),
        location_row("pre", "700", "PS", "2001"), location_row("pre-1", "700", None, "1001"), location_row("pre-null", "700", None, None),
        location_row("pre-unlocated", "700", None, "2", location=None), location_row("ps-secondary", "700", "ERG", location="l2"),
    ], CFV)
    places = spark.createDataFrame([
        ("l1", "1 Elm St", "Reno", "NULL", "89501", "US", "TRUE", "TRUE"), ("l2", "2 Elm St", "Reno", "NV", "89501", "US", "TRUE", "FALSE"),
    ], LOCATIONS)
    locations = commercial.erp_locations(places)
    found = commercial.erp_sites(sites, locations)
    assert rows(found.select("ifs_site_id", "identifier", "street", "state")) == [
        ("opco", "OPCO_Sites", "2 Elm St", "NV"), ("pre", "Pre_IFS_Sites", "1 Elm St", None),
        ("pre-unlocated", "Pre_IFS_Sites", None, None), ("ps", "PS_Sites", "1 Elm St", None),
    ]
    control = spark.createDataFrame([(5, "Plant", "2 Elm Street", "Reno", "89501", 1, None, "PC1", 9)], """site_id int, site_name string,
        site_address1 string, site_city string, site_zip string, site_state_id int, ifs_project_code string, project_code string, customer_id int""")
    states = spark.createDataFrame([(1, "NV")], "state_id int, state_abbreviation string")
    control_sites = commercial.control_sites(control, states)
    merged = commercial.site(found, control_sites)
    assert rows(merged.select("dw_site_id", "pc_site_id", "site_name", "project_id")) == [
        ("o-opco", 5, "site opco", "PC1"), ("o-pre", None, "site pre", None), ("o-ps", None, "site ps", None),
    ]
    assert commercial.site(found, control_sites, keep_unlocated=True).count() == 4
    stored = commercial.location(control_sites, locations)
    assert rows(commercial.site(found, control_sites, bridge=stored)) == rows(merged)


@pytest.mark.parametrize("hot_rows", [5, 1_000_000])
def test_locations_with_many_addresses(spark, rows, hot_rows):
    """Forty addresses of one location, on the right of the join, for each kind of site."""
    sites = spark.createDataFrame([
        location_row("ps", "700", "ERG"), location_row("opco", "600"), location_row("pre", "700", "PS", "2001"), location_row("gone", "700", "PS", "2", location="l9"),
    ], CFV)
    places = spark.createDataFrame([("l1", f"{i} Elm St", "Reno", "NV", "89501", "US", "TRUE", "TRUE" if i % 2 else "FALSE") for i in range(40)], LOCATIONS)
    found = rows(commercial.erp_sites(sites, commercial.erp_locations(places), hot_rows).select("ifs_site_id", "street"))
    odd = [f"{i} Elm St" for i in range(1, 40, 2)]
    assert found == sorted([("opco", f"{i} Elm St") for i in range(40)] + [(s, x) for s in ("ps", "pre") for x in odd] + [("gone", None)], key=repr)


@pytest.mark.parametrize("hot_rows", [5, 1_000_000])
def test_person_with_many_records(spark, hot_rows):
    users = spark.createDataFrame([("u1", "1", "p1", "n", None, "r", True), ("u2", "2", None, "n", "u1", "r", False)],
        "user_id string, emp_no string, person_id string, full_name string, manager_id string, role_id string, active boolean")
    persons = spark.createDataFrame([(f"e{i}", "p1", f"Person {i}", "org", "Active", "o", "1") for i in range(50)],
        "employee_id string, person_id string, full_name string, org_code string, status string, _obj_id string, _obj_version string")
    out = party.employee(users, persons, hot_rows)
    assert out.count() == 51 and out.where("person_id = 'p1'").select("full_name").distinct().count() == 50


def test_stored_datasets_leave_nothing_staged(spark, rows):
    from siltstone.plans.curated import Curated
    from siltstone.sources.files import exists
    from siltstone.sources.stage import scratch_path, staging

    users = [("u1", True, "1", "p1", "n", None, "r")]
    raw = {
        "crm.user": spark.createDataFrame(users, "user_id__c string, is_active boolean, employee_number string, ifs_person_id__c string, name string, manager_id string, role_id__c string"),
        "erp.company_person_last_change": spark.createDataFrame([("e1", "p1", "P", "o", "A", "i", "1")], "employee_id string, person_id string, full_name string, org_code string, status string, _obj_id string, _obj_version string"),
    }
    curated, target = Curated(raw), scratch_path(spark, "curated")
    with staging() as drop:
        stored = curated.store("employee", target)
        inside = scratch_path(spark, "kept")
        spark.range(3).write.parquet(inside)
        drop(spark)
    assert stored.count() == 1 and curated.employee.count() == 1 and set(curated.__dict__) == {"raw", "addresses", "employee"}
    assert not exists(spark, inside)


def test_generator_kinds(spark, rows):
    def gen(code, kind, project, status="Running"):
        return (code, "700", "780-GenSets", "L", kind, project, status, None, "g", f"o-{code}", None, None, 2.0)

    equipment = spark.createDataFrame([
        gen("ps", "PS", None, "Scrapped"), gen("ps2", None, "9"), gen("erg", "ERG", "9"), gen("erg2", None, None),
        gen("erg-scrapped", "ERG", None, "Scrapped"), gen("erg-null", "ERG", None, None), gen("other", "X", None), location_row("L", "700"),
    ], CFV)
    out = commercial.erp_generators(equipment).select("ifs_object_id", "identifier", "customer_location", "total_power", "no_of_engines")
    assert rows(out) == [
        ("erg", "ERG_Generators", "L", 2.0, 1), ("erg2", "ERG_Generators", "L", 2.0, 1), ("ps", "PS_Generators", "L", 2.0, 1), ("ps2", "PS_Generators", "L", 2.0, 1),
    ]
