"""Declared schemas of the curated tables.  Names, types and order are fixed values."""

EQUIPMENT = """
dw_equipment_id STRING,
ifs_object_id STRING,
pc_site_id INT,
division STRING,
object_level STRING,
parent_object STRING,
description STRING,
classification STRING,
object_owner STRING,
ownership STRING,
location_id STRING,
total_power DOUBLE,
no_of_engines BIGINT,
project_id STRING,
equipment_status STRING,
customer_location STRING,
customer_location_name STRING,
identifier STRING
"""

OPPORTUNITY = """
dw_opportunity_id STRING,
opportunity_no STRING,
opportunity_name STRING,
primary_sales_rep STRING,
account_id STRING,
record_type_id STRING,
amount DECIMAL(10,2),
close_date DATE,
margin_percentage DECIMAL(9,6) COMMENT 'Margin as a fraction of one',
rank INT,
stage STRING,
desired_installation_date DATE,
closed_won BOOLEAN,
closed BOOLEAN,
company STRING,
division_id STRING,
project_type STRING,
type_of_sale STRING,
created_date TIMESTAMP,
last_modified_date TIMESTAMP,
last_stage_change_date DATE
"""

SITE = """
dw_site_id STRING,
ifs_site_id STRING,
ifs_obj_id STRING COMMENT 'First choice for dw_site_id',
pc_site_id INT COMMENT 'Second choice for dw_site_id, hashed',
site_name STRING,
mapped_address STRING,
street STRING,
city STRING,
state STRING,
state_abbreviation STRING,
zip STRING,
country STRING,
location_id STRING,
ifs_customer_no STRING,
pc_customer_id INT,
division STRING,
object_level STRING,
identifier STRING,
project_id STRING,
state_id INT,
mobile_site BOOLEAN,
asset_owned BOOLEAN,
site_contract BOOLEAN,
site_live BOOLEAN,
controls_disabled BOOLEAN,
disabled_site BOOLEAN,
site_live_date TIMESTAMP,
controls_disabled_date TIMESTAMP,
disabled_date TIMESTAMP,
fuel_mgmt BOOLEAN
"""

ACCOUNT = """
dw_account_id STRING,
sf_account_id STRING COMMENT 'First choice for dw_account_id',
ifs_customer_id STRING,
ifs_obj_id STRING COMMENT 'Second choice for dw_account_id',
pc_customer_id INT COMMENT 'Third choice for dw_account_id, hashed',
account_name STRING,
category STRING,
parent_id STRING,
person_id STRING,
segment STRING,
subsegment STRING,
southern_opco BOOLEAN,
created_date TIMESTAMP,
last_modified_date TIMESTAMP,
match_quality INT COMMENT '0 for an exact match, else the edit distance; NULL without a match'
"""

CUSTOMER = """
dw_customer_id STRING,
sf_account_id STRING COMMENT 'First choice for dw_customer_id',
ifs_obj_id STRING COMMENT 'Second choice for dw_customer_id',
ifs_customer_no STRING,
ifs_customer_name STRING,
sf_customer_name STRING,
category STRING,
segment STRING,
subsegment STRING,
southern_opco BOOLEAN,
street STRING,
city STRING,
state STRING,
zip STRING,
country STRING,
latitude DOUBLE,
longitude DOUBLE,
parent_id STRING,
person_id STRING,
ifs_created_date TIMESTAMP,
sf_created_date TIMESTAMP,
last_modified_date TIMESTAMP
"""

EMPLOYEE = """
dw_employee_id STRING,
person_id STRING,
emp_no STRING COMMENT 'Hashed into dw_employee_id',
manager_id STRING,
role_id STRING,
active BOOLEAN,
manager_person_id STRING,
employee_id STRING,
full_name STRING,
org_code STRING,
status STRING
"""
