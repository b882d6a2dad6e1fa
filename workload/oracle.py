"""The same queries as ``workload.queries`` in plain SQL for DuckDB."""

from __future__ import annotations

from workload.landing import duckdb_cte

SIDES = """
    a AS (SELECT c_custkey, c_name, c_mktsegment FROM customer),
    b AS (SELECT s_suppkey, concat(CASE WHEN s_suppkey % 10 = 9 THEN 'WHOLESALE#' ELSE 'CUSTOMER#' END,
        lpad(CAST(s_suppkey * 37 AS VARCHAR), 9, '0')) AS b_name FROM supplier),
    exact AS (SELECT * FROM a JOIN b ON lower(c_name) = lower(b_name)),
    rest_a AS (SELECT * FROM a WHERE NOT EXISTS (SELECT 1 FROM exact e WHERE e.c_custkey = a.c_custkey)),
    rest_b AS (SELECT * FROM b WHERE NOT EXISTS (SELECT 1 FROM exact e WHERE e.s_suppkey = b.s_suppkey)),
    close AS (SELECT * FROM (
        SELECT *, CASE WHEN length(c_name) > 5 AND length(b_name) > 5 THEN CAST(levenshtein(lower(c_name), lower(b_name)) AS INT) END AS distance
        FROM rest_a CROSS JOIN rest_b) WHERE distance <= 2)
"""


def sides(select: str) -> str:
    return f"WITH {SIDES} {select}"


def _place(n: str) -> str:
    """City and state of a nation, as the landed tables have them; the state spelt as in a standard address."""
    return f"""CASE {n} % 5 WHEN 0 THEN 'SPRINGFIELD' WHEN 1 THEN 'DAYTON' WHEN 2 THEN 'AUSTIN' WHEN 3 THEN 'FRESNO' ELSE 'ALBANY' END AS std_city,
        CASE {n} % 5 WHEN 0 THEN 'IL' WHEN 1 THEN 'OH' WHEN 2 THEN 'TX' WHEN 3 THEN 'CA' ELSE 'NY' END AS std_state,
        concat('1', lpad(CAST({n} AS VARCHAR), 4, '0')) AS postal_code"""


#: Standard addresses without any parsing, from the keys that the landed addresses are made of.  A customer's
#: with key % 20 = 0 are blank, and those with key % 13 = 0 have a foreign code, so they stay as they are.
EXPECTED = f"""
    units AS (SELECT * FROM (VALUES (0, 'STE 4'), (1, 'UNIT 9')) u(six, unit)),
    left_parts AS (
        SELECT concat('LOC', c_custkey) AS location_id, c_custkey % 20 > 0 AND c_custkey % 13 > 0 AS valid,
            concat(c_custkey + 1, ' ', c_mktsegment, ' ST') AS line1, unit AS line2, {_place('c_nationkey')}
        FROM customer LEFT JOIN units ON c_custkey % 6 = six),
    right_parts AS (
        SELECT s_suppkey AS site_id, s_suppkey % 20 > 0 AS valid,
            concat(coalesce(c_custkey, s_suppkey) + 1, ' ', coalesce(c_mktsegment, 'WORKS'), ' ST') AS line1, unit AS line2,
            {_place('coalesce(c_nationkey, s_nationkey)')}
        FROM supplier LEFT JOIN customer ON c_custkey = s_suppkey * 2 AND s_suppkey % 4 > 0 LEFT JOIN units ON c_custkey % 6 = six),
    std AS (
        SELECT DISTINCT clean_address, CASE WHEN valid THEN line1 ELSE clean_address END AS address_line_1,
            CASE WHEN valid THEN line2 END AS address_line_2, CASE WHEN valid THEN std_city END AS std_city,
            CASE WHEN valid THEN std_state END AS std_state, CASE WHEN valid THEN postal_code END AS postal_code,
            CASE WHEN valid THEN concat_ws(', ', line1, line2, std_city, std_state, postal_code) ELSE clean_address END AS mapped_address
        FROM (SELECT clean_address, p.* FROM left_streets JOIN left_parts p USING (location_id)
            UNION ALL SELECT clean_address, p.* FROM right_streets JOIN right_parts p USING (site_id)))
"""


STREETS = duckdb_cte("erp_location_party_address_pub", "control_sites", "control_states") + """,
    left_streets AS (SELECT location_id, concat_ws(', ', address1, city, nullif(state, 'NULL'), zip_code, country_code) AS clean_address
        FROM erp_location_party_address_pub),
    right_streets AS (SELECT SiteId AS site_id, concat_ws(', ', SiteAddress1, SiteCity, stateabbreviation, SiteZip) AS clean_address
        FROM control_sites LEFT JOIN control_states ON SiteStateId = stateid)
"""

TURNS = """turns AS (SELECT concat_ws('-', conv_id, turn) AS node, concat_ws('-', conv_id, turn - 1) AS parent, role,
    CAST(length(text) AS INT) AS size, turn FROM conversations)"""

CSV_ORDERS = "SELECT o_orderkey AS order_key, o_totalprice AS cf_kw, o_orderpriority AS priority"

ORACLE = {
    "scan_project": "SELECT l_orderkey AS order_id, l_linenumber AS line, l_returnflag AS return_flag FROM lineitem",
    "typed_projection": """
        SELECT o_orderkey AS order_key,
            try_cast(CASE WHEN o_orderkey % 10 = 3 THEN 'n/a' WHEN o_orderkey % 10 = 4 THEN '123456789012.5' ELSE concat(o_orderkey, '.25') END AS DECIMAL(10,2)) AS amount,
            CAST(try_cast(CASE WHEN o_orderkey % 7 = 0 THEN 'soon' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS DATE) AS VARCHAR) AS close_date,
            try_cast(CASE WHEN o_orderkey % 5 = 0 THEN 'maybe' WHEN o_orderkey % 2 = 0 THEN 'true' ELSE 'false' END AS BOOLEAN) AS is_closed,
            try_cast(CASE WHEN o_orderkey % 9 = 1 THEN 'one' ELSE CAST(o_orderkey % 100 AS VARCHAR) END AS INT) AS rank
        FROM orders""",
    "ingest_csv_stream": f"{CSV_ORDERS}, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS creation_date FROM orders",
    "ingest_archived": f"{CSV_ORDERS}, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS creation_date FROM orders",
    "csv_rejects": """
        WITH cells AS (SELECT o_orderkey, o_totalprice, o_orderpriority, o_orderkey % 10 AS last,
            concat_ws(',', o_orderkey, CAST(o_totalprice AS DECIMAL(12,2))) AS short FROM orders)
        SELECT CASE WHEN last NOT IN (3, 7) THEN o_orderkey END AS order_key,
            CASE WHEN last NOT IN (3, 7) THEN CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) END AS cf_kw,
            CASE WHEN last NOT IN (3, 7) THEN o_orderpriority END AS priority,
            CASE last WHEN 3 THEN short WHEN 7 THEN concat_ws(',', short, o_orderpriority, 'more') END AS row FROM cells""",
    "refresh_full_vs_incremental": f"{CSV_ORDERS}, 'incremental' AS mode FROM orders UNION ALL {CSV_ORDERS}, 'full' AS mode FROM orders",
    "materialize_ranges": "SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders",
    "materialize_roundtrip": "SELECT s_suppkey AS supplier_id, s_name, s_nationkey, s_acctbal FROM supplier",
    "view_reuse": """
        WITH view AS (SELECT * FROM customer WHERE c_acctbal < 1000),
            by_nation AS (SELECT c_nationkey, count(*) AS n_customers FROM view GROUP BY 1)
        SELECT c_custkey, c_nationkey, n_customers FROM view JOIN by_nation USING (c_nationkey)""",
    "schema_contract": """
        SELECT c_name AS name, c_custkey AS customer_id, CAST(c_nationkey AS BIGINT) AS nation, c_acctbal AS balance,
            CAST(NULL AS VARCHAR) AS closed_date FROM customer""",
    "sql_over_dataframes": """
        SELECT o.o_orderkey, c.c_name, 'web' AS identifier FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
        WHERE o.o_orderstatus IN ('F', 'O') AND o.o_orderpriority NOT LIKE '5%'""",
    "normalize_headers": "SELECT p_partkey, p_brand FROM part",
    "rename_drop_star": "SELECT upper(p_brand) AS brand_code, p_partkey, p_name AS part_name, p_brand, p_size FROM part",
    "sentinel_to_null": "SELECT o_orderkey, nullif(o_orderpriority, '4-NOT SPECIFIED') AS priority FROM orders",
    "tagged_union": """
        SELECT c_name AS name, c_mktsegment AS segment, 'customer' AS identifier FROM customer
        UNION ALL BY NAME SELECT s_name AS name, 'supplier' AS identifier FROM supplier
        UNION ALL BY NAME SELECT p_name AS name, p_size AS size, 'part' AS identifier FROM part""",
    "null_split": """
        SELECT o_orderkey, nullif(o_orderpriority, '5-LOW') AS parent_id,
            CASE WHEN o_orderpriority = '5-LOW' THEN 'top' ELSE 'child' END AS part FROM orders""",
    "predicate_mix": """
        SELECT l_orderkey, l_linenumber, p_partkey, p_brand, p_size FROM lineitem JOIN part ON l_partkey = p_partkey
        WHERE l_discount <= 0.05 AND l_returnflag <> 'R' AND p_brand IN ('Brand#1', 'Brand#12', 'Brand#17', 'Brand#23', 'Brand#4')
            AND p_size NOT IN (1, 2, 3) AND p_name NOT LIKE 'small%'
            AND (p_type <> 'ECONOMY' OR (p_size > 20 AND p_name IS NOT NULL))""",
    "broadcast_left": """
        SELECT s_suppkey, s_nationkey AS n_nationkey, n_name FROM supplier
        LEFT JOIN (SELECT * FROM nation WHERE n_nationkey <> 7) n ON s_nationkey = n.n_nationkey""",
    "left_lookup": """
        SELECT c_custkey, n_name FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 2) n ON c_nationkey = n_nationkey""",
    "manager_lookup": f"WITH {TURNS} SELECT a.node, a.role, b.role AS parent_role FROM turns a LEFT JOIN turns b ON a.parent = b.node",
    "hierarchy_lookup": f"""
        WITH {TURNS} SELECT e.node, p.role AS parent_level, CAST(1 AS BIGINT) AS copies,
            CASE WHEN p.role = 'user' THEN p.node ELSE g.node END AS owner, CASE WHEN p.role = 'user' THEN p.role ELSE g.role END AS owner_name
        FROM turns e LEFT JOIN turns p ON e.parent = p.node LEFT JOIN turns g ON p.parent = g.node AND g.role = 'user'""",
    "hierarchy_rollup": f"""
        WITH {TURNS}, nodes AS (SELECT * FROM turns UNION ALL SELECT * FROM turns WHERE turn = 0)
        SELECT e.node, e.role, p.role AS parent_name, CAST(sum(e.size) AS BIGINT) AS total, count(e.node) AS n,
            CASE WHEN p.role = 'user' THEN p.node ELSE g.node END AS owner
        FROM turns e LEFT JOIN nodes p ON e.parent = p.node LEFT JOIN nodes g ON p.parent = g.node AND g.role = 'user'
        WHERE e.role <> 'system'
        GROUP BY e.node, e.role, e.parent, p.role, p.node, g.node, g.role""",
    "left_where_vs_on": """
        SELECT o_orderkey, c_name, 'where' AS form FROM orders LEFT JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment = 'BUILDING'
        UNION ALL
        SELECT o_orderkey, c_name, 'on' AS form FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND c_mktsegment = 'BUILDING'""",
    "inner_filtered": """
        SELECT o_orderkey, c_custkey, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey
        WHERE o_orderstatus IN ('F', 'P') AND c_mktsegment NOT IN ('BUILDING')""",
    "team_member_join": """
        SELECT l_orderkey, l_linenumber, l_partkey, o_orderpriority, c_name, n_name FROM lineitem
        JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
    "outer_three_valued": """
        WITH debtors AS (SELECT CASE WHEN c_custkey % 13 > 0 THEN c_custkey END AS cust, c_name FROM customer),
        urgent AS (SELECT CASE WHEN o_custkey % 17 > 0 THEN o_custkey END AS order_cust, nullif(o_orderstatus, 'P') AS status, count(*) AS n
            FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY ALL)
        SELECT cust, c_name, order_cust, status, n FROM debtors FULL JOIN urgent ON cust = order_cust
        WHERE NOT (cust IS NULL AND order_cust IS NOT NULL AND status = 'F')""",
    "survivorship_outer": """
        WITH c AS (SELECT CAST(floor(c_custkey / 2) AS BIGINT) AS slot, max(c_name) AS name, count(*) AS n_customers FROM customer GROUP BY 1),
        s AS (SELECT CAST(s_suppkey * 3 AS BIGINT) AS slot, max(s_name) AS supplier_name, count(*) AS n_suppliers FROM supplier GROUP BY 1)
        SELECT slot, coalesce(name, supplier_name) AS name, n_customers, n_suppliers FROM c FULL JOIN s USING (slot)""",
    "exact_match": sides("SELECT *, 0 AS match_quality FROM exact"),
    "unmatched_left": sides("SELECT * FROM rest_a"),
    "unmatched_right": sides("SELECT * FROM rest_b"),
    "fuzzy_match_blocked": sides("SELECT * RENAME (distance AS levenshtein_distance) FROM close"),
    "match_cascade": sides("""
        SELECT *, 0 AS match_quality FROM exact
        UNION ALL BY NAME SELECT * RENAME (distance AS match_quality) FROM close
        UNION ALL BY NAME SELECT * FROM rest_a WHERE NOT EXISTS (SELECT 1 FROM close x WHERE x.c_custkey = rest_a.c_custkey)
        UNION ALL BY NAME SELECT * FROM rest_b WHERE NOT EXISTS (SELECT 1 FROM close x WHERE x.s_suppkey = rest_b.s_suppkey)"""),
    "surrogate_keys": """
        SELECT c_custkey, s_suppkey, md5(CAST(s_suppkey AS VARCHAR)) AS hashed,
            coalesce(CASE WHEN c_custkey % 3 = 0 THEN c_name END, CASE WHEN s_suppkey % 2 = 0 THEN s_name END, md5(CAST(c_custkey AS VARCHAR))) AS key
        FROM customer FULL JOIN supplier ON c_custkey = s_suppkey * 2""",
    "union_distinct": "SELECT c_nationkey AS nationkey, c_custkey % 10 AS digit FROM customer UNION SELECT s_nationkey, s_suppkey % 10 FROM supplier",
    "ordered_output": "SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders ORDER BY o_orderpriority DESC, o_totalprice, o_orderkey",
    "address_concat": """
        SELECT c_custkey, concat_ws(', ', nullif(c_mktsegment, 'BUILDING'), CASE WHEN c_custkey % 3 > 0 THEN n_name END,
            CASE WHEN c_custkey % 2 > 0 THEN r_name END) AS clean_address
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""",
    "address_standardize": f"""WITH {STREETS}, {EXPECTED}
        SELECT clean_address, address_line_1, address_line_2, std_city AS city, std_state AS state, postal_code, mapped_address FROM std""",
    "address_bridge": f"""WITH {STREETS}, {EXPECTED},
        l AS (SELECT location_id, mapped_address FROM left_streets JOIN std USING (clean_address)),
        r AS (SELECT site_id, mapped_address FROM right_streets JOIN std USING (clean_address))
        SELECT coalesce(l.mapped_address, r.mapped_address) AS mapped_address, location_id, site_id
        FROM l FULL JOIN r ON nullif(l.mapped_address, '') = r.mapped_address""",
    "address_dictionary": f"""WITH {STREETS}, {EXPECTED}
        SELECT clean_address, address_line_1, address_line_2, std_city AS city, std_state AS state, postal_code, mapped_address FROM std""",
    "map_extract": """
        WITH s AS (SELECT p_partkey, p_name, string_split(p_name, ' ') AS w FROM part)
        SELECT p_partkey, p_name, CASE WHEN w[1] <> 'old' THEN w[1] END AS size, CASE WHEN w[1] <> 'old' THEN w[2] ELSE p_name END AS noun,
            CAST(NULL AS VARCHAR) AS colour FROM s""",
    "parse_bool": """
        WITH t AS (SELECT doc_id, quality = 1 AS quality,
            CASE WHEN toxic = 1 OR doc_id % 2 = 0 THEN NULL ELSE false END AS toxic, quality + doc_id % 2 AS number FROM labels)
        SELECT doc_id, quality, toxic, CASE WHEN toxic THEN 'True' ELSE 'False' END AS toxic_text,
            CASE WHEN quality THEN 'True' ELSE 'False' END AS quality_text,
            CASE WHEN number = 1 THEN 'True' ELSE 'False' END AS number_text FROM t""",
    "decimal_ratio": """
        SELECT l_orderkey, l_linenumber, l_partkey, CAST(CAST(l_discount * 100 AS DECIMAL(5,2)) / 100 AS DECIMAL(9,6)) AS fraction FROM lineitem""",
    "scd1_batch": """
        SELECT event_id, user_id, event_type, value, props FROM (
            SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id * 7919 % 1000003 DESC, event_id DESC) AS rn FROM events)
        WHERE rn = 1""",
    "scd1_stream": f"""
        WITH {duckdb_cte('erp_company_person')}
        SELECT EMP_NO AS employee_id, Person_Id AS person_id, internal_display_name AS full_name, ORG_CODE AS org_code,
            Employee_Status AS status, OBJID AS _obj_id, OBJVERSION AS _obj_version
        FROM (SELECT *, row_number() OVER (PARTITION BY OBJID ORDER BY OBJVERSION DESC) AS rn FROM erp_company_person) WHERE rn = 1""",
}

ORACLE["match_cascade_incremental"] = ORACLE["match_cascade"]

# --- whole datasets ---------------------------------------------------------------------------------

STAMP = "CAST({0} AS VARCHAR) AS {1}"
ACCOUNTS = duckdb_cte("crm_user", "crm_account", "control_customers", "erp_customer_info") + """,
    erp AS (SELECT Name AS ifs_customer_name, CUSTOMER_ID AS ifs_customer_id, CUSTOMER_CATEGORY AS category,
        CAST(try_cast(CREATION_DATE AS TIMESTAMP) AS VARCHAR) AS ifs_created_date, OBJID AS ifs_obj_id FROM erp_customer_info),
    accounts AS (SELECT Account_Full_ID__c AS sf_account_id, a.Name AS sf_account_name, IFS_Customer_No__c AS ifs_customer_no,
        ParentId AS parent_id, IFS_PERSON_ID__c AS person_id, Segment__c AS segment, Subsegment__c AS subsegment, SoCo_Opco__c AS southern_opco,
        ShippingStreet AS street, ShippingCity AS city, ShippingStateCode AS state, ShippingPostalCode AS zip, ShippingCountryCode AS country,
        ShippingLatitude AS latitude, ShippingLongitude AS longitude, CAST(a.CreatedDate AS VARCHAR) AS created_date,
        CAST(a.LastModifiedDate AS VARCHAR) AS last_modified_date
        FROM crm_account a LEFT JOIN crm_user u ON a.OwnerId = u.UserID__c)
"""

EMPLOYEES = duckdb_cte("crm_user", "erp_company_person") + """,
    person AS (SELECT EMP_NO AS employee_id, Person_Id AS person_id, internal_display_name AS full_name, ORG_CODE AS org_code, Employee_Status AS status
        FROM (SELECT *, row_number() OVER (PARTITION BY OBJID ORDER BY OBJVERSION DESC) AS rn FROM erp_company_person) WHERE rn = 1),
    employee AS (SELECT md5(u.EmployeeNumber) AS dw_employee_id, u.IFS_PERSON_ID__c AS person_id, u.EmployeeNumber AS emp_no,
        u.ManagerId AS manager_id, u.RoleID__c AS role_id, u.IsActive AS active, m.IFS_PERSON_ID__c AS manager_person_id,
        p.employee_id, p.full_name, p.org_code, p.status
        FROM crm_user u LEFT JOIN crm_user m ON u.ManagerId = m.UserID__c LEFT JOIN person p ON u.IFS_PERSON_ID__c = p.person_id)
"""

OPPORTUNITIES = duckdb_cte("crm_opportunity") + """,
    opportunity AS (SELECT Opp_Full_ID__c AS dw_opportunity_id, IFS_Opp_No__c AS opportunity_no, Name AS opportunity_name,
        OwnerId AS primary_sales_rep, AccountId AS account_id, RecordTypeId AS record_type_id,
        try_cast(Amount AS DECIMAL(10,2)) AS amount, CAST(try_cast(CloseDate AS DATE) AS VARCHAR) AS close_date,
        CAST(try_cast(Margin__c AS DECIMAL(5,2)) / 100 AS DECIMAL(9,6)) AS margin_percentage, try_cast(Rank__c AS INT) AS rank,
        StageName AS stage, CAST(CAST(Desired_Installation_Date__c AS DATE) AS VARCHAR) AS desired_installation_date,
        try_cast(IsWon AS BOOLEAN) AS closed_won, try_cast(IsClosed AS BOOLEAN) AS closed, Company__c AS company, Site__c AS division_id,
        Project_Type__c AS project_type, Type_of_Sale__c AS type_of_sale, CreatedDate AS created_date, LastModifiedDate AS last_modified_date,
        LastStageChangeDate AS last_stage_change_date FROM crm_opportunity)
"""

CFV = duckdb_cte("erp_equipment_functional_cfv")


GENERATORS = f"""{CFV},
    gensets AS (SELECT * FROM erp_equipment_functional_cfv WHERE OBJ_LEVEL = '780-GenSets' AND CONTRACT = '700'),
    tagged AS (
        SELECT *, 'PS_Generators' AS identifier FROM gensets
        WHERE "CF$_OBJ_CLASS" = 'PS' OR ("CF$_OBJ_CLASS" IS NULL AND "CF$_PROJECT_NO" IS NOT NULL)
        UNION ALL
        SELECT *, 'ERG_Generators' AS identifier FROM gensets
        WHERE ("CF$_OBJ_CLASS" = 'ERG' OR ("CF$_OBJ_CLASS" IS NULL AND "CF$_PROJECT_NO" IS NULL)) AND OPERATIONAL_STATUS <> 'Scrapped'),
    owners AS (SELECT MCH_CODE, MCH_NAME FROM erp_equipment_functional_cfv WHERE OBJ_LEVEL = '120-Cust Location'),
    placed AS (SELECT g.*, up.MCH_CODE AS up_code, up.MCH_NAME AS up_name, up.OBJ_LEVEL AS up_level, o.MCH_CODE AS o_code, o.MCH_NAME AS o_name
        FROM tagged g LEFT JOIN erp_equipment_functional_cfv up ON up.MCH_CODE = g.SUP_MCH_CODE
        LEFT JOIN owners o ON o.MCH_CODE = up.SUP_MCH_CODE),
    measured AS (SELECT * EXCLUDE ("CF$_KW", MCH_NAME, OBJVERSION), sum(try_cast("CF$_KW" AS DOUBLE)) AS total_power, count(MCH_CODE) AS no_of_engines
        FROM placed GROUP BY ALL)
"""


def _erp_sites(tag: str, join: str, where: str) -> str:
    return f"""
        SELECT ef.MCH_CODE AS ifs_site_id, ef.OBJID AS ifs_obj_id, ef.MCH_NAME AS site_name, ef.CONTRACT AS division, ef.OBJ_LEVEL AS object_level,
            ef.SUP_MCH_CODE AS ifs_customer_no, ef.LOCATION_ID AS location_id, l.address1 AS street, l.city, l.zip_code AS zip, l.state,
            l.country_code AS country, l.clean_address, '{tag}' AS identifier
        FROM erp_equipment_functional_cfv ef {join} WHERE ef.OBJ_LEVEL = '120-Cust Location' AND {where}"""


SITES = ",\n".join([
    duckdb_cte("erp_equipment_functional_cfv", "erp_location_party_address_pub", "control_sites", "control_states"),
    """loc AS (SELECT * REPLACE (nullif(state, 'NULL') AS state),
        concat_ws(', ', address1, city, nullif(state, 'NULL'), zip_code, country_code) AS clean_address FROM erp_location_party_address_pub)""",
    """pc AS (SELECT s.*, stateabbreviation, concat_ws(', ', SiteAddress1, SiteCity, stateabbreviation, SiteZip) AS clean_address
        FROM control_sites s LEFT JOIN control_states ON SiteStateId = stateid)""",
    "left_streets AS (SELECT location_id, clean_address FROM loc)",
    "right_streets AS (SELECT SiteId AS site_id, clean_address FROM pc)",
    EXPECTED.strip(),
    "erp_sites AS (" + " UNION ALL ".join([
        _erp_sites("PS_Sites", "LEFT JOIN loc l ON ef.LOCATION_ID = l.location_id", """ef.CONTRACT = '700' AND ef."CF$_OBJ_CLASS" = 'ERG'
            AND l.location_specific_address = 'TRUE' AND l.primary_address = 'TRUE' AND ef.OPERATIONAL_STATUS <> 'Scrapped'"""),
        _erp_sites("OPCO_Sites", "JOIN loc l ON ef.LOCATION_ID = l.location_id", """ef.CONTRACT IN ('300', '600', '605')
            AND ef.SUP_MCH_CODE NOT IN ('110', '200', '300', '600', '605', '700')"""),
        _erp_sites("Pre_IFS_Sites", """LEFT JOIN loc l ON ef.LOCATION_ID = l.location_id AND l.location_specific_address = 'TRUE'
            AND l.primary_address = 'TRUE'""", """ef."CF$_PROJECT_NO" IS NOT NULL AND ef.CONTRACT = '700'
            AND (ef."CF$_OBJ_CLASS" = 'PS' OR ef."CF$_OBJ_CLASS" IS NULL) AND ef."CF$_PROJECT_NO" NOT LIKE '1%'"""),
    ]) + ")",
    "e AS (SELECT erp_sites.*, mapped_address FROM erp_sites JOIN std USING (clean_address))",
    "p AS (SELECT pc.*, mapped_address FROM pc JOIN std USING (clean_address))",
])

ORACLE |= {
    "curated_employee": f"WITH {EMPLOYEES} SELECT * FROM employee",
    "curated_customer": f"""WITH {ACCOUNTS}
        SELECT coalesce(sf_account_id, ifs_obj_id) AS dw_customer_id, sf_account_id, ifs_obj_id, ifs_customer_no, ifs_customer_name,
            sf_account_name AS sf_customer_name, category, segment, subsegment, southern_opco, street, city, state, zip, country, latitude,
            longitude, parent_id, person_id, ifs_created_date, created_date AS sf_created_date, last_modified_date
        FROM erp FULL JOIN (SELECT * FROM accounts WHERE parent_id IS NOT NULL) c ON erp.ifs_customer_id = c.ifs_customer_no
        WHERE NOT (sf_account_id IS NULL AND category = 'Customer')""",
    "curated_account": f"""WITH {ACCOUNTS},
        a AS (SELECT * FROM accounts WHERE parent_id IS NULL),
        b AS (SELECT customerid AS pc_customer_id, customername AS pc_customer_name FROM control_customers),
        exact AS (SELECT * FROM a JOIN b ON lower(sf_account_name) = lower(pc_customer_name)),
        rest_a AS (SELECT * FROM a WHERE NOT EXISTS (SELECT 1 FROM exact e WHERE e.sf_account_id = a.sf_account_id)),
        rest_b AS (SELECT * FROM b WHERE NOT EXISTS (SELECT 1 FROM exact e WHERE e.pc_customer_id = b.pc_customer_id)),
        close AS (SELECT * FROM (SELECT *, CASE WHEN length(sf_account_name) > 5 AND length(pc_customer_name) > 5
            THEN CAST(levenshtein(lower(sf_account_name), lower(pc_customer_name)) AS INT) END AS match_quality FROM rest_a CROSS JOIN rest_b) WHERE match_quality <= 2),
        joined AS (SELECT *, 0 AS match_quality FROM exact UNION ALL BY NAME SELECT * FROM close
            UNION ALL BY NAME SELECT * FROM rest_a WHERE NOT EXISTS (SELECT 1 FROM close x WHERE x.sf_account_id = rest_a.sf_account_id)
            UNION ALL BY NAME SELECT * FROM rest_b WHERE NOT EXISTS (SELECT 1 FROM close x WHERE x.pc_customer_id = rest_b.pc_customer_id))
        SELECT coalesce(sf_account_id, ifs_obj_id, md5(CAST(pc_customer_id AS VARCHAR))) AS dw_account_id, sf_account_id,
            coalesce(ifs_customer_id, ifs_customer_no, ifs_customer_name) AS ifs_customer_id, ifs_obj_id, pc_customer_id,
            coalesce(sf_account_name, pc_customer_name, ifs_customer_name) AS account_name, category, parent_id, person_id, segment, subsegment,
            southern_opco, created_date, last_modified_date, match_quality
        FROM joined FULL JOIN erp ON ifs_customer_no = ifs_customer_id
        WHERE NOT (ifs_customer_no IS NULL AND erp.ifs_customer_id IS NOT NULL AND category = 'Prospect')""",
    "curated_remaining_accounts": f"""WITH {ACCOUNTS},
        a AS (SELECT * FROM accounts WHERE parent_id IS NULL),
        rest_a AS (SELECT * FROM a WHERE lower(sf_account_name) NOT IN (SELECT lower(customername) FROM control_customers)),
        rest_b AS (SELECT * FROM control_customers WHERE lower(customername) NOT IN (SELECT lower(sf_account_name) FROM a))
        SELECT * FROM rest_a WHERE NOT EXISTS (SELECT 1 FROM rest_b
            WHERE length(sf_account_name) > 5 AND length(customername) > 5 AND levenshtein(lower(sf_account_name), lower(customername)) <= 2)""",
    "curated_opco_sites": f"WITH {SITES} SELECT * FROM erp_sites WHERE identifier = 'OPCO_Sites'",
    "curated_equipment": f"""WITH {GENERATORS}, {duckdb_cte('control_generators')}
        SELECT OBJID AS dw_equipment_id, MCH_CODE AS ifs_object_id, CAST(NULL AS INT) AS pc_site_id, CONTRACT AS division, OBJ_LEVEL AS object_level,
            SUP_MCH_CODE AS parent_object, up_name AS description, "CF$_OBJ_CLASS" AS classification, "CF$_OWNER" AS object_owner,
            "CF$_OWNERSHIP" AS ownership, LOCATION_ID AS location_id, total_power, no_of_engines, "CF$_PROJECT_NO" AS project_id,
            OPERATIONAL_STATUS AS equipment_status, CASE WHEN up_level = '120-Cust Location' THEN up_code ELSE o_code END AS customer_location,
            CASE WHEN up_level = '120-Cust Location' THEN up_name ELSE o_name END AS customer_location_name, identifier
        FROM measured
        UNION ALL BY NAME
        SELECT SiteId AS pc_site_id, md5(CAST(GeneratorId AS VARCHAR)) AS dw_equipment_id, try_cast(GeneratorSize AS DOUBLE) AS total_power,
            '780-GenSets' AS object_level, 'PC' AS classification, 'PC_Generators' AS identifier FROM control_generators""",
    "curated_location": f"""WITH {STREETS}, {EXPECTED}
        SELECT clean_address, address_line_1, address_line_2, std_city AS city, std_state AS state, postal_code, mapped_address FROM std""",
    "curated_site": f"""WITH {SITES}
        SELECT coalesce(ifs_obj_id, md5(CAST(SiteId AS VARCHAR))) AS dw_site_id, ifs_site_id, ifs_obj_id, SiteId AS pc_site_id,
            coalesce(site_name, SiteName) AS site_name, coalesce(e.mapped_address, p.mapped_address) AS mapped_address, coalesce(street, SiteAddress1) AS street, coalesce(city, SiteCity) AS city,
            state, stateabbreviation AS state_abbreviation, coalesce(zip, SiteZip) AS zip, country, location_id, ifs_customer_no,
            CustomerId AS pc_customer_id, division, object_level, identifier, coalesce(IfsProjectCode, ProjectCode) AS project_id,
            SiteStateId AS state_id, MobileSite AS mobile_site, AssetOwned AS asset_owned, SiteContract AS site_contract, SiteLive AS site_live,
            ControlsDisabled AS controls_disabled, DisabledSite AS disabled_site, CAST(SiteLiveDate AS VARCHAR) AS site_live_date,
            CAST(ControlsDisabledDate AS VARCHAR) AS controls_disabled_date, CAST(DisabledDate AS VARCHAR) AS disabled_date, FuelMgmt AS fuel_mgmt
        FROM e FULL JOIN p ON nullif(e.mapped_address, '') = p.mapped_address""",
    "curated_opportunity": f"WITH {OPPORTUNITIES} SELECT * FROM opportunity",
    "curated_opportunity_team_member": f"""WITH {OPPORTUNITIES}, {EMPLOYEES}, {duckdb_cte('crm_opportunityteammember')}
        SELECT t.Id AS opportunity_team_member_id, u.IFS_PERSON_ID__c AS person_id, e.full_name AS team_member_name,
            t.TeamMemberRole AS opportunity_role, t.OpportunityID AS opportunity_id, o.opportunity_no, o.opportunity_name,
            strftime(t.CreatedDate, '%Y-%m-%d %H:%M:%S') AS created_date
        FROM crm_opportunityteammember t JOIN crm_user u ON t.UserId = u.Id JOIN opportunity o ON t.OpportunityID = o.dw_opportunity_id
        JOIN employee e ON u.IFS_PERSON_ID__c = e.person_id""",
}


ORACLE["site_from_files"] = ORACLE["curated_site"]


def _matched(select: str) -> str:
    return f"""WITH {ACCOUNTS},
        a AS (SELECT * FROM accounts WHERE parent_id IS NULL),
        b AS (SELECT customerid AS pc_customer_id, customername AS pc_customer_name FROM control_customers),
        exact AS (SELECT * FROM a JOIN b ON lower(sf_account_name) = lower(pc_customer_name)),
        rest_a AS (SELECT * FROM a WHERE NOT EXISTS (SELECT 1 FROM exact e WHERE e.sf_account_id = a.sf_account_id)),
        rest_b AS (SELECT * FROM b WHERE NOT EXISTS (SELECT 1 FROM exact e WHERE e.pc_customer_id = b.pc_customer_id)),
        close AS (SELECT * FROM (SELECT *, CASE WHEN length(sf_account_name) > 5 AND length(pc_customer_name) > 5
            THEN CAST(levenshtein(lower(sf_account_name), lower(pc_customer_name)) AS INT) END AS distance FROM rest_a CROSS JOIN rest_b) WHERE distance <= 2),
        left_a AS (SELECT * FROM rest_a WHERE NOT EXISTS (SELECT 1 FROM close x WHERE x.sf_account_id = rest_a.sf_account_id)),
        left_b AS (SELECT * FROM rest_b WHERE NOT EXISTS (SELECT 1 FROM close x WHERE x.pc_customer_id = rest_b.pc_customer_id))
        {select}"""


def _generators(tag: str) -> str:
    return f"""WITH {GENERATORS}
        SELECT MCH_CODE AS ifs_object_id, OBJID AS dw_equipment_id, CONTRACT AS division, OBJ_LEVEL AS object_level, SUP_MCH_CODE AS parent_object,
            "CF$_OBJ_CLASS" AS classification, "CF$_OWNER" AS object_owner, "CF$_OWNERSHIP" AS ownership, LOCATION_ID AS location_id,
            "CF$_PROJECT_NO" AS project_id, OPERATIONAL_STATUS AS equipment_status, identifier, up_name AS description, total_power, no_of_engines,
            CASE WHEN up_level = '120-Cust Location' THEN up_code ELSE o_code END AS customer_location,
            CASE WHEN up_level = '120-Cust Location' THEN up_name ELSE o_name END AS customer_location_name
        FROM measured WHERE identifier = '{tag}'"""


_CONTROL_SITES = """SiteId AS site_id, SiteName AS site_name, SiteAddress1 AS site_address1, SiteCity AS site_city, SiteZip AS site_zip,
    SiteStateId AS state_id, MobileSite AS mobile_site, AssetOwned AS asset_owned, SiteContract AS site_contract, SiteLive AS site_live,
    ControlsDisabled AS controls_disabled, DisabledSite AS disabled_site, CAST(SiteLiveDate AS VARCHAR) AS site_live_date,
    CAST(ControlsDisabledDate AS VARCHAR) AS controls_disabled_date, CAST(DisabledDate AS VARCHAR) AS disabled_date, ProjectCode AS project_code,
    IfsProjectCode AS ifs_project_code, CustomerId AS customer_id, FuelMgmt AS fuel_mgmt"""

ORACLE |= {
    "curated_users": f"""WITH {duckdb_cte('crm_user')} SELECT UserID__c AS user_id, EmployeeNumber AS emp_no, IFS_PERSON_ID__c AS person_id,
        Name AS full_name, ManagerId AS manager_id, RoleID__c AS role_id, IsActive AS active FROM crm_user""",
    "curated_erp_customers": f"WITH {ACCOUNTS} SELECT * FROM erp",
    "curated_control_customers": f"""WITH {duckdb_cte('control_customers')}
        SELECT customerid AS pc_customer_id, customername AS pc_customer_name FROM control_customers""",
    "curated_crm_accounts": f"WITH {ACCOUNTS} SELECT * FROM accounts",
    "curated_top_accounts": f"WITH {ACCOUNTS} SELECT * FROM accounts WHERE parent_id IS NULL",
    "curated_exact_matches": _matched("SELECT * FROM exact"),
    "curated_unmatched_accounts": _matched("SELECT * FROM rest_a"),
    "curated_unmatched_control_customers": _matched("SELECT * FROM rest_b"),
    "curated_close_matches": _matched("SELECT * RENAME (distance AS levenshtein_distance) FROM close"),
    "curated_remaining_control_customers": _matched("SELECT * FROM left_b"),
    "curated_matched_accounts": _matched("""SELECT *, 0 AS match_quality, CAST(NULL AS INT) AS levenshtein_distance FROM exact
        UNION ALL BY NAME SELECT * RENAME (distance AS match_quality), distance AS levenshtein_distance FROM close
        UNION ALL BY NAME SELECT * FROM left_a UNION ALL BY NAME SELECT * FROM left_b"""),
    "curated_erp_locations": f"WITH {SITES} SELECT * RENAME (OBJID AS _obj_id, OBJVERSION AS _obj_version) FROM loc",
    "curated_control_sites": f"WITH {SITES} SELECT {_CONTROL_SITES}, stateabbreviation AS state_abbreviation, clean_address FROM pc",
    "curated_control_generators": f"""WITH {duckdb_cte('control_generators')}
        SELECT SiteId AS pc_site_id, md5(CAST(GeneratorId AS VARCHAR)) AS dw_equipment_id, try_cast(GeneratorSize AS DOUBLE) AS total_power,
            '780-GenSets' AS object_level, 'PC' AS classification, 'PC_Generators' AS identifier FROM control_generators""",
    "curated_ps_generators": _generators("PS_Generators"),
    "curated_erg_generators": _generators("ERG_Generators"),
    "curated_ps_sites": f"WITH {SITES} SELECT * FROM erp_sites WHERE identifier = 'PS_Sites'",
    "curated_pre_erp_sites": f"WITH {SITES} SELECT * FROM erp_sites WHERE identifier = 'Pre_IFS_Sites'",
}


def _raw(name: str, *pairs: str) -> None:
    ORACLE[f"raw_{name}"] = f"WITH {duckdb_cte(name)} SELECT {', '.join(pairs)} FROM {name}"


ROW = ("OBJID AS _obj_id", "OBJVERSION AS _obj_version")
_raw("erp_customer_info", "Name AS name", "CUSTOMER_ID AS customer_id", "CUSTOMER_CATEGORY AS customer_category",
     "CAST(try_cast(CREATION_DATE AS TIMESTAMP) AS VARCHAR) AS creation_date", *ROW)
_raw("erp_equipment_functional", "MCH_CODE AS mch_code", "CONTRACT AS contract", "MCH_NAME AS mch_name", "SUP_MCH_CODE AS sup_mch_code",
     "MCH_TYPE AS mch_type", "LOCATION_ID AS location_id", "MANUFACTURER_NO AS manufacturer_no", "SERIAL_NO AS serial_no",
     "OPERATIONAL_STATUS AS operational_status", *ROW)
_raw("erp_equipment_functional_cfv", "MCH_CODE AS mch_code", '"CF$_OWNERSHIP" AS cf_ownership', '"CF$_OWNER" AS cf_owner',
     '"CF$_PWS_EQUIPMENT_STATUS" AS cf_pws_equipment_status', '"CF$_MODEL_NO" AS cf_model_no', 'try_cast("CF$_KW" AS DOUBLE) AS cf_kw',
     '"CF$_REGION" AS cf_region', '"CF$_PROJECT_NO" AS cf_project_no', '"CF$_ASSET_DESIGNATION" AS cf_asset_designation',
     "CONTRACT AS contract", "OBJ_LEVEL AS obj_level", "SUP_MCH_CODE AS sup_mch_code", '"CF$_OBJ_CLASS" AS cf_obj_class',
     "LOCATION_ID AS location_id", "OPERATIONAL_STATUS AS operational_status", "MCH_NAME AS mch_name", *ROW)
_raw("erp_location_party_address_pub", "* RENAME (OBJID AS _obj_id, OBJVERSION AS _obj_version)")
_raw("erp_company_person", "EMP_NO AS emp_no", "Person_Id AS person_id", "internal_display_name", "ORG_CODE AS org_code",
     "Employee_Status AS employee_status", *ROW)
_raw("control_customers", "customerid AS customer_id", "customername AS customer_name")
_raw("control_sites", "SiteId AS site_id", "SiteName AS site_name", "SiteAddress1 AS site_address1", "SiteCity AS site_city",
     "SiteZip AS site_zip", "SiteStateId AS site_state_id", "MobileSite AS mobile_site", "AssetOwned AS asset_owned",
     "SiteContract AS site_contract", "SiteLive AS site_live", "ControlsDisabled AS controls_disabled", "DisabledSite AS disabled_site",
     "CAST(SiteLiveDate AS VARCHAR) AS site_live_date", "CAST(ControlsDisabledDate AS VARCHAR) AS controls_disabled_date",
     "CAST(DisabledDate AS VARCHAR) AS disabled_date", "ProjectCode AS project_code", "IfsProjectCode AS ifs_project_code",
     "CustomerId AS customer_id", "FuelMgmt AS fuel_mgmt")
_raw("control_states", "stateid AS state_id", "stateabbreviation AS state_abbreviation")
_raw("control_generators", "GeneratorId AS generator_id", "EquipmentId AS equipment_id", "UnitId AS unit_id", "GeneratorNumber AS generator_number",
     "GeneratorManufacturerId AS generator_manufacturer_id", "GeneratorSize AS generator_size", "SiteId AS site_id")
_raw("control_generatormanufacturers", "generatormanufacturerid AS generator_manufacturer_id", "generatormanufacturername AS generator_manufacturer_name")
_raw("crm_account", "Account_Full_ID__c AS account_full_id__c", "Name AS name", "IFS_Customer_No__c AS ifs_customer_no__c", "ParentId AS parent_id",
     "OwnerId AS owner_id", "Segment__c AS segment__c", "Subsegment__c AS subsegment__c", "SoCo_Opco__c AS soco_opco__c",
     "ShippingCity AS shipping_city", "ShippingStreet AS shipping_street", "ShippingStateCode AS shipping_state_code",
     "ShippingPostalCode AS shipping_postal_code", "ShippingCountryCode AS shipping_country_code", "ShippingLatitude AS shipping_latitude",
     "ShippingLongitude AS shipping_longitude", "CAST(CreatedDate AS VARCHAR) AS created_date", "CAST(LastModifiedDate AS VARCHAR) AS last_modified_date")
_raw("crm_opportunity", "Opp_Full_ID__c AS opp_full_id__c", "IFS_Opp_No__c AS ifs_opp_no__c", "Name AS name", "OwnerId AS owner_id",
     "AccountId AS account_id", "RecordTypeId AS record_type_id", "try_cast(Amount AS DECIMAL(10,2)) AS amount",
     "CAST(try_cast(CloseDate AS DATE) AS VARCHAR) AS close_date", "try_cast(Margin__c AS DECIMAL(5,2)) AS margin__c",
     "try_cast(Rank__c AS INT) AS rank__c", "StageName AS stage_name", "Desired_Installation_Date__c AS desired_installation_date__c",
     "try_cast(IsWon AS BOOLEAN) AS is_won", "try_cast(IsClosed AS BOOLEAN) AS is_closed", "Company__c AS company__c", "Site__c AS site__c",
     "Project_Type__c AS project_type__c", "Type_of_Sale__c AS type_of_sale__c", "CreatedDate AS created_date",
     "LastModifiedDate AS last_modified_date", "LastStageChangeDate AS last_stage_change_date")
_raw("crm_user", "UserID__c AS user_id__c", "IsActive AS is_active", "EmployeeNumber AS employee_number", "IFS_PERSON_ID__c AS ifs_person_id__c",
     "Name AS name", "ManagerId AS manager_id", "RoleID__c AS role_id__c", "CAST(CreatedDate AS VARCHAR) AS created_date",
     "CAST(LastModifiedDate AS VARCHAR) AS last_modified_date")
_raw("crm_opportunityteammember", "Id AS id", "OpportunityID AS opportunity_id", "UserId AS user_id", "TeamMemberRole AS team_member_role",
     "strftime(CreatedDate, '%Y-%m-%d %H:%M:%S') AS created_date")
_raw("crm_opportunitylineitem", "Id AS id", "product2Id AS product2_id", "OpportunityID AS opportunity_id", "ProductCode AS product_code",
     "Product_Family__c AS product_family__c", "Quantity AS quantity", "strftime(CreatedDate, '%Y-%m-%d %H:%M:%S') AS created_date")
_raw("crm_product2", "Id AS id", "Name AS name", "ProductCode AS product_code", "Product_Family__c AS product_family__c",
     "Product_Subcategory__c AS product_subcategory__c", "Description AS description", "IsActive AS is_active", "CPQ_Product__c AS cpq_product__c",
     "LGK__IsConfigurable__c AS lgk__is_configurable__c", "CAST(CreatedDate AS VARCHAR) AS created_date",
     "CAST(LastModifiedDate AS VARCHAR) AS last_modified_date")

ORACLE |= {name.replace("raw_", "stream_"): text for name, text in ORACLE.items() if name.startswith("raw_erp_")}
