"""Landed tables derived from the given ones, whole, in SQL that Spark and DuckDB both run.

``{customer}`` and so on stand for the given tables.  NULLs, malformed text, repeated codes and address
variants are derived from key arithmetic, so every rule of the curated tables meets rows of both kinds.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

CITY = "CASE {n} % 5 WHEN 0 THEN 'Springfield' WHEN 1 THEN 'Dayton' WHEN 2 THEN 'Austin' WHEN 3 THEN 'Fresno' ELSE 'Albany' END"
STATE = "CASE {n} % 5 WHEN 0 THEN 'IL' WHEN 1 THEN 'OH' WHEN 2 THEN 'TX' WHEN 3 THEN 'CA' ELSE 'NY' END"
STATE_NAME = "CASE {n} % 5 WHEN 0 THEN 'Illinois' WHEN 1 THEN 'ohio' WHEN 2 THEN 'Texas' WHEN 3 THEN 'California' ELSE 'New York' END"


def _by_nation(text: str, column: str) -> str:
    return text.replace("{n}", column)


LANDING = {
    "crm_user": """
        SELECT concat('U', s_suppkey) AS Id, concat('U', s_suppkey) AS UserID__c, s_acctbal > 0 AS IsActive,
            concat('E', s_suppkey) AS EmployeeNumber,
            CASE WHEN s_suppkey % 7 > 0 THEN concat('P', s_suppkey) END AS IFS_PERSON_ID__c, s_name AS Name,
            CASE WHEN s_suppkey % 5 > 0 THEN concat('U', CAST(floor(s_suppkey / 5) AS BIGINT)) END AS ManagerId,
            concat('R', s_nationkey) AS RoleID__c,
            CAST('2024-01-02 03:04:05' AS TIMESTAMP) AS CreatedDate,
            CAST('2024-02-03 04:05:06' AS TIMESTAMP) AS LastModifiedDate
        FROM {supplier}""",
    "crm_account": """
        SELECT concat('A', c_custkey) AS Account_Full_ID__c, c_name AS Name,
            CASE WHEN c_custkey % 3 <> 1 THEN concat('C', c_custkey) END AS IFS_Customer_No__c,
            CASE WHEN c_custkey % 4 = 3 THEN concat('A', c_nationkey) END AS ParentId,
            concat('U', c_custkey % 120) AS OwnerId, c_mktsegment AS Segment__c,
            CASE WHEN c_custkey % 2 = 0 THEN concat('sub ', c_mktsegment) END AS Subsegment__c,
            c_acctbal < 0 AS SoCo_Opco__c, concat(c_custkey + 1, ' Main Street') AS ShippingStreet,
            """ + _by_nation(CITY, "c_nationkey") + """ AS ShippingCity,
            """ + _by_nation(STATE, "c_nationkey") + """ AS ShippingStateCode,
            concat('1', lpad(CAST(c_nationkey AS STRING), 4, '0')) AS ShippingPostalCode,
            'US' AS ShippingCountryCode, CAST(c_nationkey AS DOUBLE) AS ShippingLatitude,
            CAST(c_custkey % 90 AS DOUBLE) AS ShippingLongitude,
            CAST('2024-01-02 03:04:05' AS TIMESTAMP) AS CreatedDate,
            CAST('2024-02-03 04:05:06' AS TIMESTAMP) AS LastModifiedDate
        FROM {customer}""",
    "crm_opportunity": """
        SELECT concat('O', o_orderkey) AS Opp_Full_ID__c, CAST(o_orderkey AS STRING) AS IFS_Opp_No__c,
            concat('Deal ', o_orderkey) AS Name, concat('U', o_custkey % 120) AS OwnerId,
            concat('A', o_custkey) AS AccountId, o_orderstatus AS RecordTypeId,
            CASE WHEN o_orderkey % 50 = 0 THEN 'unknown' WHEN o_orderkey % 50 = 1 THEN '123456789012.5'
                ELSE concat(o_orderkey, '.25') END AS Amount,
            CASE WHEN o_orderkey % 40 = 7 THEN 'soon' ELSE concat('2024-', lpad(CAST(o_orderkey % 12 + 1 AS STRING), 2, '0'), '-11') END AS CloseDate,
            CASE WHEN o_orderkey % 30 = 4 THEN '12345.6' ELSE concat(o_orderkey % 100, '.', lpad(CAST(o_orderkey % 97 AS STRING), 2, '0')) END AS Margin__c,
            CASE WHEN o_orderkey % 20 = 3 THEN 'x' ELSE CAST(o_orderkey % 9 AS STRING) END AS Rank__c,
            o_orderpriority AS StageName, '2024-03-04' AS Desired_Installation_Date__c,
            CASE o_orderstatus WHEN 'F' THEN 'true' WHEN 'O' THEN 'false' END AS IsWon,
            CASE o_orderstatus WHEN 'F' THEN 'true' ELSE 'false' END AS IsClosed,
            'Co' AS Company__c, concat('S', o_custkey % 10) AS Site__c, 'New' AS Project_Type__c, 'Direct' AS Type_of_Sale__c,
            '2024-01-02 03:04:05' AS CreatedDate, '2024-02-03 04:05:06' AS LastModifiedDate, '2024-02-03' AS LastStageChangeDate
        FROM {orders}""",
    "crm_opportunityteammember": """
        SELECT concat('T', l_orderkey, '-', l_linenumber) AS Id, concat('O', l_orderkey) AS OpportunityID,
            concat('U', l_suppkey) AS UserId, l_returnflag AS TeamMemberRole, l_shipdate AS CreatedDate
        FROM {lineitem}""",
    "crm_opportunitylineitem": """
        SELECT concat('I', l_orderkey, '-', l_linenumber) AS Id, concat('D', l_partkey) AS product2Id,
            concat('O', l_orderkey) AS OpportunityID, concat('PC-', l_partkey) AS ProductCode,
            l_linestatus AS Product_Family__c, l_quantity AS Quantity, l_shipdate AS CreatedDate
        FROM {lineitem}""",
    "crm_product2": """
        SELECT concat('D', p_partkey) AS Id, p_name AS Name, concat('PC-', p_partkey) AS ProductCode, p_type AS Product_Family__c,
            p_brand AS Product_Subcategory__c, concat(p_name, ' of ', p_brand) AS Description, p_size > 10 AS IsActive,
            p_size > 20 AS CPQ_Product__c, p_size > 30 AS LGK__IsConfigurable__c,
            CAST('2024-01-02 03:04:05' AS TIMESTAMP) AS CreatedDate, CAST('2024-02-03 04:05:06' AS TIMESTAMP) AS LastModifiedDate
        FROM {part}""",
    "control_customers": """
        SELECT CAST(s_suppkey AS INT) AS customerid,
            concat(CASE WHEN s_suppkey % 10 = 9 THEN 'WHOLESALE#' ELSE 'CUSTOMER#' END,
                lpad(CAST(s_suppkey * 37 AS STRING), 9, '0')) AS customername
        FROM {supplier}""",
    "control_states": """
        SELECT n_nationkey AS stateid, """ + _by_nation(STATE, "n_nationkey") + """ AS stateabbreviation FROM {nation}""",
    # three of four sites stand where a customer does, in another spelling
    "control_sites": """
        SELECT CAST(s_suppkey AS INT) AS SiteId, concat('Plant ', s_suppkey) AS SiteName,
            CASE WHEN s_suppkey % 20 > 0 THEN concat(coalesce(c_custkey, s_suppkey) + 1, ' ',
                CASE WHEN c_custkey IS NULL THEN 'Works' WHEN s_suppkey % 2 = 0 THEN lower(c_mktsegment) ELSE c_mktsegment END,
                CASE s_suppkey % 3 WHEN 0 THEN ' St' WHEN 1 THEN ' Street,' ELSE ' STREET' END,
                CASE WHEN c_custkey % 6 = 0 THEN ' Ste #4' WHEN c_custkey % 6 = 1 THEN ' unit 9' ELSE '' END) END AS SiteAddress1,
            CASE WHEN s_suppkey % 20 > 0 THEN """ + _by_nation(CITY, "coalesce(c_nationkey, s_nationkey)") + """ END AS SiteCity,
            CASE WHEN s_suppkey % 20 > 0 THEN concat('1', lpad(CAST(coalesce(c_nationkey, s_nationkey) AS STRING), 4, '0')) END AS SiteZip,
            CASE WHEN s_suppkey % 20 > 0 THEN coalesce(c_nationkey, s_nationkey) END AS SiteStateId,
            s_suppkey % 2 = 0 AS MobileSite, s_suppkey % 3 = 0 AS AssetOwned, s_suppkey % 5 = 0 AS SiteContract,
            s_suppkey % 7 = 0 AS SiteLive, s_suppkey % 11 = 0 AS ControlsDisabled, s_suppkey % 13 = 0 AS DisabledSite,
            CAST('2024-01-02 03:04:05' AS TIMESTAMP) AS SiteLiveDate, CAST(NULL AS TIMESTAMP) AS ControlsDisabledDate,
            CAST('2024-02-03 04:05:06' AS TIMESTAMP) AS DisabledDate, concat('PR', s_suppkey) AS ProjectCode,
            CASE WHEN s_suppkey % 2 = 1 THEN concat('IP', s_suppkey) END AS IfsProjectCode,
            CAST(s_suppkey AS INT) AS CustomerId, s_suppkey % 17 = 0 AS FuelMgmt
        FROM {supplier} LEFT JOIN {customer} ON c_custkey = s_suppkey * 2 AND s_suppkey % 4 > 0""",
    "control_generators": """
        SELECT CAST(p_partkey AS INT) AS GeneratorId, CAST(p_partkey * 2 AS INT) AS EquipmentId, p_size AS UnitId,
            CAST(p_partkey % 8 AS INT) AS GeneratorNumber, CAST(p_partkey % 25 AS INT) AS GeneratorManufacturerId,
            CASE WHEN p_partkey % 15 = 2 THEN 'n/a' ELSE concat(p_size, '.5') END AS GeneratorSize,
            CAST(p_partkey % 100 AS INT) AS SiteId
        FROM {part}""",
    "control_generatormanufacturers": """
        SELECT CAST(s_suppkey AS INT) AS generatormanufacturerid, s_name AS generatormanufacturername FROM {supplier}""",
    "erp_customer_info": """
        SELECT concat('Erp ', c_name) AS Name, concat('C', c_custkey * 2) AS CUSTOMER_ID,
            CASE c_mktsegment WHEN 'BUILDING' THEN 'Prospect' WHEN 'MACHINERY' THEN NULL WHEN 'FURNITURE' THEN 'Vendor' ELSE 'Customer' END AS CUSTOMER_CATEGORY,
            CASE WHEN c_custkey % 9 = 0 THEN 'n/a' ELSE '2024-05-06 07:08:09' END AS CREATION_DATE,
            concat('OB', c_custkey) AS OBJID, CAST(c_custkey AS STRING) AS OBJVERSION
        FROM {customer}""",
    "erp_equipment_functional": """
        SELECT concat('G', o_orderkey) AS MCH_CODE, '700' AS CONTRACT, concat('Set ', o_orderkey) AS MCH_NAME,
            concat('M', o_custkey) AS SUP_MCH_CODE, o_orderstatus AS MCH_TYPE, concat('LOC', o_custkey) AS LOCATION_ID,
            concat('MF', o_custkey % 10) AS MANUFACTURER_NO, concat('SN', o_orderkey) AS SERIAL_NO,
            o_orderpriority AS OPERATIONAL_STATUS, concat('EG', o_orderkey) AS OBJID, CAST(o_orderkey AS STRING) AS OBJVERSION
        FROM {orders}""",
    # generators under groups or locations, groups under locations, locations; group codes repeat
    "erp_equipment_functional_cfv": """
        SELECT concat('G', o_orderkey) AS MCH_CODE, concat('own', o_orderkey % 3) AS CF$_OWNERSHIP, 'Owner' AS CF$_OWNER,
            'Up' AS CF$_PWS_EQUIPMENT_STATUS, concat('MOD', o_orderkey % 5) AS CF$_MODEL_NO,
            CASE WHEN o_orderkey % 33 = 5 THEN 'n/a' ELSE CAST(o_orderkey % 500 AS STRING) END AS CF$_KW, 'R1' AS CF$_REGION,
            CASE WHEN o_orderkey % 2 = 0 THEN concat('2', o_orderkey) END AS CF$_PROJECT_NO, 'AD' AS CF$_ASSET_DESIGNATION,
            CASE o_orderpriority WHEN '5-LOW' THEN '300' ELSE '700' END AS CONTRACT, '780-GenSets' AS OBJ_LEVEL,
            CASE o_orderstatus WHEN 'F' THEN concat('L', o_custkey) WHEN 'O' THEN concat('M', o_custkey) ELSE concat('none', o_custkey) END AS SUP_MCH_CODE,
            CASE o_orderkey % 4 WHEN 0 THEN 'PS' WHEN 1 THEN 'ERG' WHEN 2 THEN 'OTHER' END AS CF$_OBJ_CLASS,
            concat('LOC', o_custkey) AS LOCATION_ID,
            CASE o_orderkey % 7 WHEN 0 THEN 'Scrapped' WHEN 1 THEN NULL ELSE 'Running' END AS OPERATIONAL_STATUS,
            concat('Set ', o_orderkey) AS MCH_NAME, concat('EG', o_orderkey) AS OBJID, '1' AS OBJVERSION
        FROM {orders}
        UNION ALL
        SELECT concat('M', c_custkey), 'own', 'Owner', 'Up', 'MOD', '0', 'R1', NULL, 'AD', '700', '400-Group',
            concat('L', c_custkey), 'PS', concat('LOC', c_custkey), 'Running', concat('Group ', c_custkey), concat('EM', c_custkey), '1'
        FROM {customer}
        UNION ALL
        SELECT concat('M', s_suppkey), 'own', 'Owner', 'Up', 'MOD', '0', 'R1', NULL, 'AD', '700', '400-Group',
            concat('L', s_suppkey), 'PS', NULL, 'Running', concat('Group ', s_suppkey), concat('ES', s_suppkey), '1'
        FROM {supplier}
        UNION ALL
        SELECT concat('L', c_custkey), 'own', 'Owner', 'Up', 'MOD', NULL, 'R1',
            CASE c_custkey % 5 WHEN 0 THEN NULL WHEN 1 THEN concat('1', c_custkey) ELSE concat('7', c_custkey) END, 'AD',
            CASE c_custkey % 6 WHEN 0 THEN '300' WHEN 1 THEN '600' WHEN 2 THEN '605' WHEN 3 THEN '110' ELSE '700' END,
            '120-Cust Location',
            CASE c_custkey % 8 WHEN 0 THEN '600' WHEN 1 THEN NULL ELSE concat('C', c_custkey) END,
            CASE WHEN c_custkey % 9 = 1 THEN NULL WHEN c_mktsegment = 'BUILDING' THEN 'PS' ELSE 'ERG' END,
            CASE WHEN c_custkey % 11 > 0 THEN concat('LOC', c_custkey) END,
            CASE c_custkey % 7 WHEN 0 THEN 'Scrapped' WHEN 1 THEN NULL ELSE 'Running' END,
            concat('Location ', c_custkey), concat('EL', c_custkey), '1'
        FROM {customer}""",
    "erp_location_party_address_pub": """
        SELECT concat('LOC', c_custkey) AS location_id, concat('Desc ', c_custkey) AS description, concat('ID', c_custkey) AS identity,
            CASE WHEN c_custkey % 20 > 0 THEN concat(c_custkey + 1, ' ', c_mktsegment,
                CASE c_custkey % 3 WHEN 0 THEN ' Street' WHEN 1 THEN ' st.' ELSE ' ST ' END,
                CASE WHEN c_custkey % 6 = 0 THEN ' Suite 4' WHEN c_custkey % 6 = 1 THEN ' # 9' ELSE '' END) END AS address1,
            CASE WHEN c_custkey % 20 > 0 THEN """ + _by_nation(CITY, "c_nationkey") + """ END AS city,
            CASE WHEN c_custkey % 20 = 0 THEN 'NULL' WHEN c_custkey % 2 = 0 THEN """ + _by_nation(STATE, "c_nationkey") + """
                ELSE """ + _by_nation(STATE_NAME, "c_nationkey") + """ END AS state,
            CASE WHEN c_custkey % 20 = 0 THEN NULL WHEN c_custkey % 13 = 0 THEN 'K1A 0B1' WHEN c_custkey % 4 = 0 THEN concat('1', lpad(CAST(c_nationkey AS STRING), 4, '0'), '-1234')
                ELSE concat('1', lpad(CAST(c_nationkey AS STRING), 4, '0')) END AS zip_code,
            CASE WHEN c_custkey % 20 = 0 THEN NULL WHEN c_custkey % 2 = 0 THEN 'US' ELSE 'USA' END AS country_code,
            CASE WHEN c_custkey % 10 = 5 THEN 'FALSE' ELSE 'TRUE' END AS location_specific_address,
            CASE WHEN c_custkey % 14 = 6 THEN 'FALSE' ELSE 'TRUE' END AS primary_address,
            concat('EA', c_custkey) AS OBJID, '1' AS OBJVERSION
        FROM {customer}""",
    "erp_company_person": """
        SELECT concat('EMP', user_id) AS EMP_NO, concat('P', user_id) AS Person_Id, concat('Name ', event_id) AS internal_display_name,
            event_type AS ORG_CODE, CASE WHEN value > 10 THEN 'Active' ELSE 'Inactive' END AS Employee_Status,
            concat('X', user_id) AS OBJID, lpad(CAST(event_id AS STRING), 12, '0') AS OBJVERSION
        FROM {events}""",
}


def tables_of(text: str) -> set[str]:
    return set(re.findall(r"\{(\w+)\}", text))


def landed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The landed table as a DataFrame."""
    text = LANDING[name]
    text = re.sub(r"AS (CF\$\w+)", r"AS `\1`", text)
    return spark.sql(text, **{t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in tables_of(text)})


def duckdb_cte(*names: str) -> str:
    """``name AS (...)`` clauses for the landed tables, for DuckDB."""
    clauses = []
    for name in names:
        text = re.sub(r"AS (CF\$\w+)", r'AS "\1"', LANDING[name])
        clauses.append(f"{name} AS ({re.sub(r'{(\w+)}', r'\1', text)})")
    return ",\n".join(clauses)
