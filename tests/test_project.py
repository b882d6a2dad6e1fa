import datetime as dt
from decimal import Decimal

import pytest

from siltstone.functions.columns import bool_text, joined_text, map_fields, parse_bool, sentinel_to_null, surrogate_key, survivorship
from siltstone.functions.udf import map_parser, parse_distinct
from siltstone.operators.project import normalize_headers, project, rejected_cells, snake_name, sql_over, to_contract


@pytest.mark.parametrize("source, target", [
    ("ShippingStateCode", "shipping_state_code"), ("IFS_Opp_No__c", "ifs_opp_no__c"), ("CF$_KW", "cf_kw"), ("OpportunityID", "opportunity_id"),
    ("product2Id", "product2_id"), ("SiteAddress1", "site_address1"), ("LGK__IsConfigurable__c", "lgk__is_configurable__c"), ("MCH_CODE", "mch_code"),
])
def test_snake_name(source, target):
    assert snake_name(source) == target


SPEC = """
    CF$_KW : double
    Amount : decimal(10,2)
    CloseDate : date
    Rank__c : int -> place
    Note
"""


def test_project_casts_what_fits(spark):
    df = spark.createDataFrame(
        [("1.5", "12.345", "2024-02-30", "7", "a"), ("x", "123456789012", "2024-02-03", None, None)],
        "`CF$_KW` string, Amount string, CloseDate string, Rank__c string, Note string",
    )
    out = project(df, SPEC)
    assert out.columns == ["cf_kw", "amount", "close_date", "place", "note"]
    assert [tuple(r) for r in out.collect()] == [(1.5, Decimal("12.35"), None, 7, "a"), (None, None, dt.date(2024, 2, 3), None, None)]
    assert tuple(rejected_cells(df, SPEC).first()) == (1, 1, 1, 0)


def test_normalize_headers(spark):
    assert normalize_headers(spark.createDataFrame([(1, 2)], "A int, bC int")).columns == ["a", "bc"]
    with pytest.raises(ValueError):
        normalize_headers(spark.createDataFrame([(1, 2)], "A int, a int"))


def test_contract(spark):
    df = spark.createDataFrame([("x", 1)], "name string, n int")
    out = to_contract(df, "n BIGINT COMMENT 'count', name STRING, extra DATE")
    assert [(f.name, f.dataType.simpleString()) for f in out.schema] == [("n", "bigint"), ("name", "string"), ("extra", "date")]
    assert out.schema["n"].metadata == {"comment": "count"}
    assert tuple(out.first()) == (1, "x", None)
    with pytest.raises(Exception, match="INVALID_COLUMN_OR_FIELD_DATA_TYPE|CANNOT"):
        to_contract(df, "name INT, n INT").collect()
    with pytest.raises(ValueError, match="outside the contract"):
        to_contract(df, "name STRING")


def test_boolean_text(spark):
    values = ["true", "T", "1", "false", "f", "0", "FALSE", "yes", "", " true", None]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    parsed = [r[0] for r in df.select(parse_bool("v", strict=False)).collect()]
    assert parsed == [True, True, True, False, False, False, False, None, None, None, None]
    assert [r[0] for r in df.select(bool_text(parse_bool("v", strict=False))).collect()] == ["True"] * 3 + ["False"] * 8
    assert df.limit(7).select(parse_bool("v")).count() == 7
    for bad in ("yes", "", None):
        with pytest.raises(Exception, match="invalid boolean text"):
            spark.createDataFrame([(bad,)], "v string").select(parse_bool("v")).collect()


def test_small_columns(spark):
    df = spark.createDataFrame([("NULL", None, None), ("TX", "Austin", 5)], "state string, city string, id int")
    out = df.select(sentinel_to_null("state"), joined_text("city", sentinel_to_null("state")), surrogate_key("city", hashed="id"))
    assert [tuple(r) for r in out.collect()] == [(None, "", None), ("TX", "Austin, TX", "Austin")]
    merged = survivorship(df, {"state": ["state", "city"]})
    assert merged.columns == ["state", "id"]


def test_map_parser_falls_back_and_sees_each_value_once(spark, rows):
    def parse(text):
        key, value = text.split("=")
        return {key: value}

    df = spark.createDataFrame([("a=1",), ("a=1",), ("nothing",), (None,)], "t string")
    out = parse_distinct(df, "t", map_parser(parse, "raw", (ValueError,)), ["a", "raw", "b"])
    assert rows(out) == [("a=1", "1", None, None), ("nothing", None, "nothing", None), (None, None, None, None)]
    assert len(map_fields("m", ["x", "y"])) == 2


def test_sql_over_leaves_no_view(spark, rows):
    df = spark.createDataFrame([(1,), (2,)], "v int")
    assert rows(sql_over('SELECT v, "tag" AS t FROM {d} WHERE v > 1;', d=df)) == [(2, "tag")]
    assert "d" not in [t.name for t in spark.catalog.listTables()]
