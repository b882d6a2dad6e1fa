import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from siltstone.functions.address import COLUMNS, standardize
from siltstone.operators.bridge import address_bridge, address_table
from siltstone.sources.stage import scratch_path


def mapped(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [tuple(r) for r in standardize(df, "t").orderBy("i").select(*COLUMNS).collect()]


VARIANTS = [
    "123 North Main Street Suite 5, Springfield, Illinois, 62704-1234, US",
    "123 N. main st.  STE 5, springfield, IL, 62704",
    "123 N Main St, Suite 5, Springfield IL 62704, USA",
    "123 N Main St, Ste 5, Springfield, IL 62704",
]


def test_variants_become_equal(spark):
    want = ("123 N MAIN ST", "STE 5", "SPRINGFIELD", "IL", "62704", "123 N MAIN ST, STE 5, SPRINGFIELD, IL, 62704")
    assert set(mapped(spark, VARIANTS)) == {want}


def test_parts_that_may_be_missing(spark):
    got = mapped(spark, [
        "7 Oak Court, 12345", "PO Box 12, Reno, NV, 89501", "7 Oak Ct # 9, Reno, 89501", "12-14 West Virginia Ave, Charleston, West Virginia, 25301",
    ])
    assert [g[-1] for g in got] == [
        "7 OAK CT, 12345", "PO BOX 12, RENO, NV, 89501", "7 OAK CT, UNIT 9, RENO, 89501", "12-14 W VIRGINIA AVE, CHARLESTON, WV, 25301",
    ]


def test_units_boxes_territories_and_military(spark):
    """Expected parts written by hand."""
    cases = {
        "12 Main St Suite #4, Reno, NV, 89501": ("12 MAIN ST", "STE 4", "RENO", "NV", "89501"),
        "12 Main St Ste 4, Reno, NV, 89501": ("12 MAIN ST", "STE 4", "RENO", "NV", "89501"),
        "12 Main St Apt. # 2, Reno, NV, 89501": ("12 MAIN ST", "APT 2", "RENO", "NV", "89501"),
        "12 Main St, Apartment #2, Reno, Nevada 89501": ("12 MAIN ST", "APT 2", "RENO", "NV", "89501"),
        "1 Calle Sol, San Juan, PR 00901": ("1 CALLE SOL", None, "SAN JUAN", "PR", "00901"),
        "1 Calle Sol, San Juan, Puerto Rico, 00901-1234, USA": ("1 CALLE SOL", None, "SAN JUAN", "PR", "00901"),
        "5 Marine Drive, Tamuning, Guam 96913": ("5 MARINE DR", None, "TAMUNING", "GU", "96913"),
        "P O Box 7, Reno, NV, 89501": ("PO BOX 7", None, "RENO", "NV", "89501"),
        "P.O. Box 7, Reno, NV, 89501": ("PO BOX 7", None, "RENO", "NV", "89501"),
        "Post Office Box 7, Reno, NV, 89501": ("PO BOX 7", None, "RENO", "NV", "89501"),
        "PSC 802 Box 74, APO, AE 09499": ("PSC 802 BOX 74", None, "APO", "AE", "09499"),
        "Unit 2050 Box 4190, APO AP 96278": ("UNIT 2050 BOX 4190", None, "APO", "AP", "96278"),
        "CMR 480 Box 100, FPO, AA, 34099": ("CMR 480 BOX 100", None, "FPO", "AA", "34099"),
        "5 Building Street, Dayton, OH, 45401": ("5 BUILDING ST", None, "DAYTON", "OH", "45401"),
        "5 Building St Bldg 3, Dayton, OH, 45401": ("5 BUILDING ST", "BLDG 3", "DAYTON", "OH", "45401"),
    }
    got = mapped(spark, list(cases))
    assert {text: g[:5] for text, g in zip(cases, got, strict=True)} == cases
    assert [g[:6] for g in mapped(spark, [g[5] for g in got])] == got


@pytest.mark.parametrize("text", ["", "Highway junction, TX, 75001", "1 Rue de la Paix, Paris", "12345", "US", ", ,", "10 Main St, K1A 0B1, CA"])
def test_what_is_no_address_stays_as_it_is(spark, text):
    assert mapped(spark, [text]) == [(text, None, None, None, None, text)]


WORDS = st.sampled_from(["12", "7A", "Main", "Street", "St.", "N", "Court", "CT", "AL", "Suite", "UNIT", "#", "5", "62704", "62704-1", "62704-1234", ",", ", ", "Illinois", "New", "York", "IL", "US", "PO", "Box", "FL"])


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(WORDS, min_size=1, max_size=12).map(" ".join), min_size=20, max_size=60))
def test_standardising_twice_changes_nothing(spark, texts):
    once = [g[-1] for g in mapped(spark, texts)]
    assert [g[-1] for g in mapped(spark, once)] == once


def test_bridge_forms_agree(spark, rows):
    left = spark.createDataFrame([(1, VARIANTS[0]), (2, ""), (3, "9 Elm St, Reno, NV, 89501"), (4, None)], "a int, addr string")
    right = spark.createDataFrame([(10, VARIANTS[1]), (11, VARIANTS[2]), (12, ""), (13, "5 Ash Rd, Reno, NV, 89501")], "b int, addr string")
    standard = "123 N MAIN ST, STE 5, SPRINGFIELD, IL, 62704"
    want = sorted([
        (standard, 1, 10), (standard, 1, 11), ("", 2, 12), ("9 ELM ST, RENO, NV, 89501", 3, None), ("5 ASH RD, RENO, NV, 89501", None, 13),
    ], key=repr)
    table = address_table("addr", left, right)
    for bridge in (None, table):
        for hot_rows in (1, 1000):
            assert rows(address_bridge(left, right, "addr", bridge, True, hot_rows).select("mapped_address", "a", "b")) == want
    unblanked = rows(address_bridge(left, right, "addr").select("mapped_address", "a", "b"))
    assert [r for r in unblanked if r[0] == ""] == [("", 2, None), ("", None, 12)]


def test_dictionary_parses_each_address_once(spark, rows, monkeypatch):
    from siltstone.operators import bridge

    left = spark.createDataFrame([("1 Main St, Dayton, OH 12345",), ("1 Main St, Dayton, OH 12345",), (None,), ("",)], "clean_address string")
    right = spark.createDataFrame([("1 MAIN STREET, DAYTON, OH, 12345",), ("2 Oak Ave, Austin, TX 78701",), ("",)], "clean_address string")
    known = bridge.AddressDictionary(spark, scratch_path(spark, "addresses"))
    assert rows(known.of(left.where("clean_address is null"))) == rows(bridge.address_table("clean_address", left.where("clean_address is null")))
    assert known.add(left) == 2 and known.add(left) == 0
    assert known.add(left, right) == 2
    assert known.read().count() == 4
    parsed = []
    monkeypatch.setattr(bridge, "standardize", lambda *a: parsed.append(a) or 1 / 0)
    again = known.of(left, right)
    assert not parsed
    monkeypatch.undo()
    assert rows(again) == rows(bridge.address_table("clean_address", left, right))
    bridged = lambda *extra: bridge.address_bridge(left.withColumn("l", F.lit(1)), right.withColumn("r", F.lit(2)), "clean_address", *extra)
    assert rows(bridged(known.read())) == rows(bridged())
