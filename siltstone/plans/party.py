"""Curated party tables: accounts, customers, employees."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from siltstone.functions.columns import hashed_id, surrogate_key
from siltstone.operators.joins import HOT_ROWS, parent_lookup, salted_join
from siltstone.operators.match import Side, match_cascade, remaining
from siltstone.operators.project import project, to_contract
from siltstone.plans import contracts
from siltstone.sources.stage import stage

# Source columns and their names here.
USERS = """
user_id__c -> user_id
employee_number -> emp_no
ifs_person_id__c -> person_id
name -> full_name
manager_id
role_id__c -> role_id
is_active -> active
"""

ERP_CUSTOMERS = """
name -> ifs_customer_name
customer_id -> ifs_customer_id
customer_category -> category
creation_date -> ifs_created_date
_obj_id -> ifs_obj_id
"""

CONTROL_CUSTOMERS = """
customer_id -> pc_customer_id
customer_name -> pc_customer_name
"""

CRM_ACCOUNTS = """
account_full_id__c -> sf_account_id
name -> sf_account_name
ifs_customer_no__c -> ifs_customer_no
parent_id
person_id
segment__c -> segment
subsegment__c -> subsegment
soco_opco__c -> southern_opco
shipping_street -> street
shipping_city -> city
shipping_state_code -> state
shipping_postal_code -> zip
shipping_country_code -> country
shipping_latitude -> latitude
shipping_longitude -> longitude
created_date
last_modified_date
"""


def crm_users(user: DataFrame) -> DataFrame:
    return project(user, USERS)


def erp_customers(customer_info: DataFrame) -> DataFrame:
    return project(customer_info, ERP_CUSTOMERS)


def control_customers(customer: DataFrame) -> DataFrame:
    return project(customer, CONTROL_CUSTOMERS)


def crm_accounts(account: DataFrame, users: DataFrame) -> DataFrame:
    """Every CRM account with the person id of its owner."""
    owners = users.select("user_id", "person_id")
    return project(account.join(owners, account["owner_id"] == owners["user_id"], "left"), CRM_ACCOUNTS)


def top_accounts(accounts: DataFrame) -> DataFrame:
    return accounts.where("parent_id IS NULL")


def child_accounts(accounts: DataFrame) -> DataFrame:
    return accounts.where("parent_id IS NOT NULL")


def account_sides(top: DataFrame, control: DataFrame) -> tuple[Side, Side]:
    return Side(top, "sf_account_id", "sf_account_name"), Side(control, "pc_customer_id", "pc_customer_name")


def matched_accounts(top: DataFrame, control: DataFrame) -> DataFrame:
    return match_cascade(*account_sides(top, control))


def remaining_accounts(top: DataFrame, control: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Top-level accounts and control-system customers without a match."""
    return remaining(*account_sides(top, control))


def _erp_only(crm_key: str, erp_key: str) -> Column:
    return F.col(crm_key).isNull() & F.col(erp_key).isNotNull()


def account(matched: DataFrame, erp: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Matched accounts joined to the ERP's customers, with one id and one name per row.

    An ERP customer without an account is dropped when its category is Prospect, and also when the
    category is NULL: the negated condition is then NULL, not true.  Rows come in no order; ``account_order()``
    is the order that ``Curated.store`` writes them in.
    """
    kept = matched.select(
        "sf_account_id", "sf_account_name", "pc_customer_id", "pc_customer_name", "ifs_customer_no", "parent_id",
        "person_id", "segment", "subsegment", "southern_opco", "created_date", "last_modified_date", "match_quality",
    )
    joined = salted_join(
        stage(kept, "matched_accounts"), stage(erp.drop("ifs_created_date"), "erp_customers"),
        "ifs_customer_no", "ifs_customer_id", "full", hot_rows,
    )
    joined = joined.where(~(_erp_only("ifs_customer_no", "ifs_customer_id") & (F.col("category") == "Prospect")))
    return to_contract(joined.select(
        surrogate_key("sf_account_id", "ifs_obj_id", hashed="pc_customer_id").alias("dw_account_id"),
        "sf_account_id",
        F.coalesce("ifs_customer_id", "ifs_customer_no", "ifs_customer_name").alias("ifs_customer_id"),
        "ifs_obj_id",
        "pc_customer_id",
        F.coalesce("sf_account_name", "pc_customer_name", "ifs_customer_name").alias("account_name"),
        "category", "parent_id", "person_id", "segment", "subsegment", "southern_opco",
        "created_date", "last_modified_date", "match_quality",
    ), contracts.ACCOUNT)


def account_order() -> list[Column]:
    """Worst matches first, unmatched rows last."""
    return [F.desc("match_quality"), F.asc("sf_account_id"), F.asc("pc_customer_id"), F.asc("ifs_customer_id")]


def customer(children: DataFrame, erp: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Child accounts joined to the ERP's customers.

    ERP rows without an account are dropped when their category is Customer or NULL (as in ``account``).
    """
    crm = children.withColumnsRenamed({"sf_account_name": "sf_customer_name", "created_date": "sf_created_date"})
    joined = salted_join(stage(erp, "erp_customers"), stage(crm, "child_accounts"), "ifs_customer_id", "ifs_customer_no", "full", hot_rows)
    joined = joined.where(~(F.col("sf_account_id").isNull() & (F.col("category") == "Customer")))
    keyed = joined.withColumn("dw_customer_id", surrogate_key("sf_account_id", "ifs_obj_id"))
    return to_contract(keyed.drop("ifs_customer_id"), contracts.CUSTOMER)


def employee(users: DataFrame, company_person: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """CRM users with the person id of their manager and the ERP's current person record.

    A person id with very many records is split.  Runs jobs: both sides are written once.
    """
    people = users.drop("full_name")
    managed = parent_lookup(people, "manager_id", "user_id", {"person_id": "manager_person_id"})
    records = company_person.drop("_obj_id", "_obj_version").withColumnRenamed("person_id", "__person")
    joined = salted_join(stage(managed, "managed"), stage(records, "persons"), "person_id", "__person", "left", hot_rows).drop("user_id", "__person")
    return to_contract(joined.withColumn("dw_employee_id", hashed_id("emp_no")), contracts.EMPLOYEE)
