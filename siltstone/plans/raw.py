"""Raw layer: one conformed copy per landed table.

Every function takes the landed table, batch or stream, and returns the raw one.  The lists are the
fixed source columns and types of the landed tables; a target name is given where the naming rule of
``snake_name`` would give another.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from siltstone.operators.project import fields, normalize_headers, project

# --- ERP: CSV files, all text on arrival ---------------------------------------------------------

ERP_ROW = """
OBJID -> _obj_id
OBJVERSION -> _obj_version
"""

ERP_CUSTOMER_INFO = """
Name : string
CUSTOMER_ID : string
CUSTOMER_CATEGORY : string
CREATION_DATE : timestamp
""" + ERP_ROW

ERP_EQUIPMENT_FUNCTIONAL = """
MCH_CODE
CONTRACT
MCH_NAME
SUP_MCH_CODE
MCH_TYPE
LOCATION_ID
MANUFACTURER_NO
SERIAL_NO
OPERATIONAL_STATUS
""" + ERP_ROW

ERP_EQUIPMENT_FUNCTIONAL_CFV = """
MCH_CODE
CF$_OWNERSHIP
CF$_OWNER
CF$_PWS_EQUIPMENT_STATUS
CF$_MODEL_NO
CF$_KW : double
CF$_REGION
CF$_PROJECT_NO
CF$_ASSET_DESIGNATION
CONTRACT
OBJ_LEVEL
SUP_MCH_CODE
CF$_OBJ_CLASS
LOCATION_ID
OPERATIONAL_STATUS
MCH_NAME
""" + ERP_ROW

ERP_LOCATION_PARTY_ADDRESS_PUB = """
location_id
description
identity
address1
city
state
zip_code
country_code
location_specific_address
primary_address
""" + ERP_ROW

ERP_COMPANY_PERSON = """
emp_no
person_id
internal_display_name
org_code
employee_status
objid -> _obj_id
objversion -> _obj_version
"""

ERP_COMPANY_PERSON_CHANGE = """
emp_no -> employee_id
person_id
internal_display_name -> full_name
org_code
employee_status -> status
_obj_id
_obj_version
"""

# --- control system: relational tables -----------------------------------------------------------

CONTROL_CUSTOMER = """
customerid -> customer_id
customername -> customer_name
"""

CONTROL_SITE = """
SiteId
SiteName
SiteAddress1
SiteCity
SiteZip
SiteStateId
MobileSite
AssetOwned
SiteContract
SiteLive
ControlsDisabled
DisabledSite
SiteLiveDate
ControlsDisabledDate
DisabledDate
ProjectCode
IfsProjectCode
CustomerId
FuelMgmt
"""

CONTROL_STATE = """
stateid -> state_id
stateabbreviation -> state_abbreviation
"""

CONTROL_GENERATOR = """
GeneratorId
EquipmentId
UnitId
GeneratorNumber
GeneratorManufacturerId
GeneratorSize
SiteId
"""

CONTROL_GENERATOR_MANUFACTURER = """
generatormanufacturerid -> generator_manufacturer_id
generatormanufacturername -> generator_manufacturer_name
"""

# --- CRM: tables landed by a connector -----------------------------------------------------------

CRM_ACCOUNT = """
Account_Full_ID__c
Name
IFS_Customer_No__c
ParentId
OwnerId
Segment__c
Subsegment__c
SoCo_Opco__c -> soco_opco__c
ShippingCity
ShippingStreet
ShippingStateCode
ShippingPostalCode
ShippingCountryCode
ShippingLatitude
ShippingLongitude
CreatedDate
LastModifiedDate
"""

CRM_OPPORTUNITY = """
Opp_Full_ID__c : string
IFS_Opp_No__c : string
Name : string
OwnerId : string
AccountId : string
RecordTypeId : string
Amount : decimal(10,2)
CloseDate : date
Margin__c : decimal(5,2)
Rank__c : int
StageName : string
Desired_Installation_Date__c : date
IsWon : boolean
IsClosed : boolean
Company__c : string
Site__c : string
Project_Type__c : string
Type_of_Sale__c : string
CreatedDate : timestamp
LastModifiedDate : timestamp
LastStageChangeDate : date
"""

CRM_USER = """
UserID__c
IsActive
EmployeeNumber
IFS_PERSON_ID__c
Name
ManagerId
RoleID__c
CreatedDate
LastModifiedDate
"""

CRM_OPPORTUNITY_TEAM_MEMBER = """
Id
OpportunityID
UserId
TeamMemberRole
CreatedDate
"""

CRM_OPPORTUNITY_PRODUCT = """
Id
product2Id
OpportunityID
ProductCode
Product_Family__c
Quantity
CreatedDate
"""

CRM_PRODUCT = """
Id
Name
ProductCode
Product_Family__c
Product_Subcategory__c
Description
IsActive
CPQ_Product__c
LGK__IsConfigurable__c
CreatedDate
LastModifiedDate
"""

# landed table -> (raw table, columns), by source system
ERP = {
    "customer_info": ("customer_info", ERP_CUSTOMER_INFO),
    "equipment_functional": ("equipment_functional", ERP_EQUIPMENT_FUNCTIONAL),
    "equipment_functional_cfv": ("equipment_functional_cfv", ERP_EQUIPMENT_FUNCTIONAL_CFV),
    "location_party_address_pub": ("location_party_address_pub", ERP_LOCATION_PARTY_ADDRESS_PUB),
    "company_person": ("company_person", ERP_COMPANY_PERSON),
}
CONTROL = {
    "customers": ("customer", CONTROL_CUSTOMER),
    "sites": ("site", CONTROL_SITE),
    "states": ("state", CONTROL_STATE),
    "generators": ("generator", CONTROL_GENERATOR),
    "generatormanufacturers": ("generatormanufacturer", CONTROL_GENERATOR_MANUFACTURER),
}
CRM = {
    "account": ("account", CRM_ACCOUNT),
    "opportunity": ("opportunity", CRM_OPPORTUNITY),
    "user": ("user", CRM_USER),
    "opportunityteammember": ("opportunity_team_member", CRM_OPPORTUNITY_TEAM_MEMBER),
    "opportunitylineitem": ("opportunity_product", CRM_OPPORTUNITY_PRODUCT),
    "product2": ("product", CRM_PRODUCT),
}
SYSTEMS = {"erp": ERP, "control": CONTROL, "crm": CRM}


def declared_columns(system: str, landed: str) -> str:
    """The columns of a landed file in their order, all as text."""
    _, columns = SYSTEMS[system][landed]
    return ", ".join(f"`{f.source}` string" for f in fields(columns))


def raw_table(system: str, landed: str, df: DataFrame) -> DataFrame:
    """The raw form of one landed table."""
    _, columns = SYSTEMS[system][landed]
    if landed == "company_person":  # its files come with headers in any case
        df = normalize_headers(df)
    return project(df, columns)


def company_person_changes(company_person: DataFrame) -> DataFrame:
    """The change feed behind ``company_person_last_change``: key ``_obj_id``, sequence ``_obj_version``."""
    return project(company_person, ERP_COMPANY_PERSON_CHANGE)
